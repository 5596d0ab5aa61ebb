"""Splittable scans of delimited text whose records span lines, with a number for each record.

Spark cuts a big file into blocks of whole lines, but a line says nothing about
whether it starts inside a quoted field. What a block does to that state is a
function of two values (inside a field or not), so it is found without knowing
what came before:

1. Each block reports, for both states it may start in, the state it ends in and how
   many records start in it: one row for each input split of the scan.
2. The driver, which has planned those splits one by one already, chains the rows of
   each file. Every block then knows its state and the number of its first record.
3. Each block glues its lines to records. A record that runs over the end of a block
   leaves one piece in each block it touches; only those pieces are shuffled.

A record's number is its place in its file, whatever the block size.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

#: Numbers of one file; ids of the next file start behind them.
FILE_SPAN = 1 << 40

# After the last field that a line closes: a quoted field that stays open, from the
# start of a record and from inside a field. A quote counts only where a field begins;
# what follows a closing quote belongs to the field up to the next comma.
_FIELDS = r'(?:(?:"(?:[^"]|"")*+"[^,]*+|[^",][^,]*+)?,)*+'
_OPENS = re.compile(rf'{_FIELDS}"(?:[^"]|"")*+\Z')
_STAYS = re.compile(rf'(?:[^"]|"")*+(?:\Z|"[^,]*+,{_FIELDS}"(?:[^"]|"")*+\Z)')


def open_after(line: str, inside: bool) -> bool:
    """Whether the line ends inside a quoted field."""
    if '"' not in line:
        return inside
    return (_STAYS if inside else _OPENS).match(line) is not None


def _blank(line: str) -> bool:
    return line in ("", "\r")


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.coalesce("value", F.lit("")).alias("line"),
    )


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], Iterator[str]]]:
    """Lines of a task, block by block; a block's lines come one behind another."""
    from itertools import groupby

    def every():
        for batch in batches:
            for file, start, line in zip(*(c.to_pylist() for c in batch.columns)):
                yield (file, start), (line[1:] if start == 0 and line.startswith("\ufeff") else line)

    for block, rows in groupby(every(), key=lambda row: row[0]):
        yield block, (line for _, line in rows)


_KINDS = (pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64(), pa.bool_())


def _survey(quoted: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for (file, start), lines in _runs(batches):
            ends, records, pairs = [False, True], [0, 0], None
            for line in lines:
                if pairs is None:
                    pairs = line.endswith("\r")
                for k in (0, 1):
                    records[k] += not ends[k] and not _blank(line)
                    ends[k] = quoted and open_after(line, ends[k])
            out.append((file, start, *ends, *records, bool(pairs)))
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(zip(*out), _KINDS)],
                ["file", "start", "closed_ends", "open_ends", "closed_records", "open_records", "pairs"],
            )

    return run


def _glue(places: dict[tuple[str, int], tuple[bool, int, bool]], quoted: bool):
    """``(number, start, part, text)``: whole records have part 0, others 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, int, int, str]] = []

        def rows() -> pa.RecordBatch:
            columns = [pa.array(c, kind) for c, kind in zip(zip(*out), (pa.int64(), pa.int64(), pa.int32(), pa.string()))]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, ["number", "start", "part", "text"])

        for block, lines in _runs(batches):
            inside, number, pairs = places[block]
            number -= inside
            held, carried, size = [], inside, 0
            for line in lines:
                if not inside and _blank(line):
                    continue
                held.append(line.removesuffix("\r") if pairs else line)
                inside = quoted and open_after(line, inside)
                if not inside:
                    out.append((number, block[1], int(carried), "\n".join(held)))
                    size += sum(map(len, held))
                    held, carried, number = [], False, number + 1
                    if len(out) >= 10_000 or size > 1 << 24:
                        yield rows()
                        size = 0
            if held:
                out.append((number, block[1], 1, "\n".join(held)))
        if out:
            yield rows()

    return run


def read_records(spark: SparkSession, path: str | list[str], quoted: bool = True, header: bool = False) -> DataFrame:
    """``(record_id, record)``: every record of the files as text, blank lines left out.

    ``record_id`` is the number of the file, in the order of paths, times
    ``FILE_SPAN`` plus the number of the record in it: the same in every scan of the
    same files. ``header`` drops the first record of each file. Without ``quoted``
    each line is a record. Line ends inside a field are kept as they are, but where a
    file's first line ends in carriage return and line feed, all such pairs become line feeds.
    """
    lines = _lines(spark, path)
    survey = lines.mapInArrow(
        _survey(quoted),
        "file string, start long, closed_ends boolean, open_ends boolean, closed_records long, open_records long, pairs boolean",
    )
    places: dict[tuple[str, int], tuple[bool, int, bool]] = {}
    file, files, inside, number, torn, pairs = None, -1, False, 0, False, False
    for row in sorted(survey.collect(), key=lambda r: (r["file"], r["start"])):  # one row for each split
        if row["file"] != file:
            file, files, inside, number = row["file"], files + 1, False, 0
            pairs = row["pairs"]
        places[file, row["start"]] = (inside, files * FILE_SPAN + number, pairs)
        torn |= inside
        number += row["open_records" if inside else "closed_records"]
        inside = row["open_ends" if inside else "closed_ends"]
        torn |= inside
    glued = lines.mapInArrow(_glue(places, quoted), "number long, start long, part int, text string")
    records = glued.where("part = 0").select("number", "text") if torn else glued.select("number", "text")
    if torn:
        # at most two pieces of a block
        pieces = F.array_sort(F.collect_list(F.struct("start", "text")))
        joined = glued.where("part = 1").groupBy("number").agg(F.array_join(F.transform(pieces, lambda p: p["text"]), "\n").alias("text"))
        records = records.unionByName(joined)
    if header:
        records = records.where(F.col("number") % FILE_SPAN != 0)
    return records.select(F.col("number").alias("record_id"), F.col("text").alias("record"))


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType, header: bool = True) -> DataFrame:
    """``record_id`` and the columns of ``schema``, as the multi-line reader has them, by many tasks.

    Fields are quoted by ``"``, which is doubled inside them.
    """
    options = {"quote": '"', "escape": '"', "multiLine": "true", "mode": "PERMISSIVE"}
    parsed = F.from_csv("record", schema.simpleString()[len("struct<") : -1].replace(":", " "), options)
    return read_records(spark, path, True, header).select("record_id", parsed.alias("r")).select("record_id", "r.*")


def numbered_copies(df: DataFrame, name: str) -> DataFrame:
    """Add an id that follows from a row's content and, among equal rows, from a running number.

    Equal rows are counted map-side and written out again, so a row that fills a third
    of the table is one row of the shuffle for each task.
    """
    counted = df.groupBy(*df.columns).agg(F.count("*").alias("_copies"))
    runs = F.sequence(F.lit(0).cast("long"), F.expr("(_copies - 1) div 65536"))
    inside = F.sequence(F.lit(0).cast("long"), F.least(F.lit(65536), F.col("_copies") - F.col("_run") * 65536) - 1)
    rows = counted.withColumn("_run", F.explode(runs)).withColumn("_at", F.explode(inside))
    place = F.col("_run") * 65536 + F.col("_at")
    return rows.select(F.shiftrightunsigned(F.xxhash64(*df.columns, place), 1).alias(name), *df.columns)
