"""Report sinks and scans: result tables as JSON or parquet folders."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def write_report(report: DataFrame, path: str, fmt: str = "json") -> None:
    """One folder per report; refuses to replace an existing one."""
    report.write.format(fmt).mode("errorifexists").save(path)


def read_report(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """A missing report raises an analysis error."""
    return spark.read.format(fmt).load(path)


def work_folder(spark: SparkSession) -> str:
    """Shared folder that the session names; on one machine a temporary one takes its place."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    named = tempfile.mkdtemp(prefix="lurewatch-")
    spark.conf.set("spark.checkpoint.dir", named)
    return named


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the work folder and read it back.

    Iterative fits ship the whole lineage with every job; a stored table has none,
    and it outlives lost executors.
    """
    spark = df.sparkSession
    path = f"{work_folder(spark)}/{name}_{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.parquet(path)
