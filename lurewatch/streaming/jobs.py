"""Streaming scoring and drift windows; the same expressions as the batch jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery

from lurewatch.operators.scoring import Scorer, score_mail, triage
from lurewatch.schema import MAIL_JSON_SCHEMA
from lurewatch.sources.mail import coerce_json

SCORE_BINS = 10


def mail_stream(spark: SparkSession, path: str) -> DataFrame:
    """Arriving mails: JSON payload files dropped into a folder."""
    return coerce_json(spark.readStream.schema(MAIL_JSON_SCHEMA).json(path))


def scored_stream(mail: DataFrame, scorer: Scorer, keep: tuple[str, ...] = ("mail_id",)) -> DataFrame:
    """Stateless scoring: no shuffle, no state, identical to the batch job."""
    return triage(score_mail(mail, scorer, keep), scorer).select(
        *keep, "score", "verdict", "predicted", "confidence"
    )


def delivered_once(mail: DataFrame, late: str) -> DataFrame:
    """Of payloads with one ``mail_id`` only the first; a copy must follow within ``late``.

    A mail without ``received_at`` counts as received now.
    """
    stamped = mail.withColumn("received_at", F.coalesce("received_at", F.current_timestamp()))
    return stamped.withWatermark("received_at", late).dropDuplicatesWithinWatermark(["mail_id"])


def start_scoring(
    mail: DataFrame, scorer: Scorer, out: str, checkpoint: str, late: str | None = None
) -> StreamingQuery:
    """Scores what is there and stops.

    The sink lists its files by batch, so a batch that is run again, because the stream
    stopped between writing and committing, leaves one copy of its rows. With ``late`` a
    payload delivered twice within that time is scored once.
    """
    source = mail if late is None else delivered_once(mail, late)
    return (
        scored_stream(source, scorer)
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def start_drift(
    scores: DataFrame, baseline: DataFrame, out: str, checkpoint: str, late: str = "2 days", width: str = "1 day"
) -> StreamingQuery:
    """Stability index of every closed window of a score stream, written once each, and stops.

    A window closes when a row ``late`` after its end has come; rows of closed windows
    are dropped. ``baseline`` is read when the stream starts.
    """
    return (
        population_stability(drift_windows(scores, late, width), baseline)
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def drift_windows(scores: DataFrame, late: str = "2 days", width: str = "1 day") -> DataFrame:
    """Volume, mean score, alert rate and score histogram per window.

    ``scores`` holds ``received_at`` and ``score``; works on a stream (windows close
    behind the watermark) and on a table alike. State is one row per open window.
    """
    bin_of = F.least(F.floor(F.col("score") * SCORE_BINS), F.lit(SCORE_BINS - 1))
    counts = [F.count_if(bin_of == b).alias(f"bin_{b}") for b in range(SCORE_BINS)]
    source = scores.withWatermark("received_at", late) if scores.isStreaming else scores
    return source.groupBy(F.window("received_at", width).alias("w")).agg(
        F.count("*").alias("n"),
        F.avg("score").alias("mean_score"),
        F.avg((F.col("score") >= 0.7).cast("double")).alias("alert_rate"),
        *counts,
    ).select(F.col("w.start").alias("window_start"), "n", "mean_score", "alert_rate",
             *[f"bin_{b}" for b in range(SCORE_BINS)])


def baseline_histogram(scores: DataFrame) -> DataFrame:
    """``(bin, share)`` of a score table: ten rows to store and compare later windows with."""
    bin_of = F.least(F.floor(F.col("score") * SCORE_BINS), F.lit(SCORE_BINS - 1)).cast("int")
    counts = scores.groupBy(bin_of.alias("bin")).agg(F.count("*").alias("n"))
    every = scores.sparkSession.range(SCORE_BINS).select(F.col("id").cast("int").alias("bin"))
    total = F.sum("n").over(Window.partitionBy())  # ten rows
    return every.join(counts, "bin", "left").select("bin", F.coalesce(F.col("n") / total, F.lit(0.0)).alias("share"))


def population_stability(windows: DataFrame, baseline: DataFrame, floor: float = 1e-4) -> DataFrame:
    """Add ``psi`` of each window against a baseline's shares (ten numbers of the plan)."""
    shares = {r["bin"]: r["share"] for r in baseline.collect()}
    psi = F.lit(0.0)
    for b in range(SCORE_BINS):
        actual = F.greatest(F.col(f"bin_{b}") / F.col("n"), F.lit(floor))
        expected = max(shares.get(b, 0.0), floor)
        psi = psi + (actual - F.lit(expected)) * F.log(actual / F.lit(expected))
    return windows.withColumn("psi", psi)
