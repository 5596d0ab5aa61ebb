"""Exact duplicates: 128-bit content hash, smallest id stays, bytes compared inside groups.

Texts are equal when they are the same after every run of white space became one
space. Null text counts as empty, so empty texts form one group. A null id sorts
last: it stays only where its group has no other. Rows that repeat one id with
one text count one by one in ``group_size``; one of them is kept. An empty table
gives an empty result. Columns besides id and text are not read.

Text moves only where it must. A first pass hashes every row; small rows are
counted by hash. Hashes that occur more than once set bits in a bitmap of fixed
size, and only rows whose bit is set (every copy, and a few others) are then
grouped by their bytes, combined map-side, so that a group of a million copies
leaves each task as one row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from lurewatch.llm.common import SPACE, private, stored, text_of

#: The bitmap has 2**FILTER_BITS bits: 4 MB to broadcast, whatever the input.
FILTER_BITS = 25
_PAGE_BITS = 32768


def normalised(text: Column) -> Column:
    # single spaces, nearly all of the runs, are left out of the replacement
    return F.regexp_replace(text, rf"{SPACE}{{2,}}|[\x09-\x0D]", " ")


def md5_hash(text: Column) -> Column:
    return F.unhex(F.md5(text))


def maybe_in(rows: DataFrame, keys: DataFrame, column: str, bits: int = FILTER_BITS) -> DataFrame:
    """The rows whose key is among ``keys``, and few others.

    A bitmap of 2**bits bits in pages of 32768, broadcast: one is set for each key.
    """
    bit = F.pmod(F.xxhash64(column), F.lit(1 << bits))
    page, at = (bit / _PAGE_BITS).cast("int").alias("__page"), (bit % _PAGE_BITS).cast("int").alias("__at")
    bitmap = keys.select(page, at.cast("long")).groupBy("__page").agg(F.bitmap_construct_agg("__at").alias("__bits"))
    byte = F.conv(F.hex(F.expr("substring(__bits, cast(__at / 8 as int) + 1, 1)")), 16, 10).cast("int")
    return (
        rows.select("*", page, at)
        .join(F.broadcast(bitmap), "__page")
        .where(byte.bitwiseAND(F.expr("shiftleft(1, __at % 8)")) != 0)
        .drop("__page", "__at", "__bits")
    )


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    content_hash: Callable[[Column], Column] = md5_hash,
) -> DataFrame:
    """Per row: id, keep_id, group_size, kept, text_sha256."""
    texts = docs.select(docs[id_col].alias("id"), normalised(text_of(docs, text_col)).alias("norm"))
    hashed = stored(
        texts.select("id", content_hash(F.col("norm")).alias("h"), F.unhex(F.sha2("norm", 256)).alias("sha"))
        .groupBy("id", "h", "sha")
        .agg(F.count(F.lit(1)).alias("copies")),
        "exact-hashes",
    )
    shared = hashed.groupBy("h").agg(F.sum("copies").alias("n")).where("n > 1").select("h")
    rows = maybe_in(texts.withColumn("h", content_hash(F.col("norm"))), shared, "h")
    # grouping on the text itself compares bytes: a collision of h ends in two groups
    groups = (
        rows.groupBy("h", "norm")
        .agg(F.min("id").alias("keep"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("h", F.unhex(F.sha2("norm", 256)).alias("sha"), "keep", "n")
    )
    joined = hashed.join(groups, ["h", "sha"], "left")
    keep = F.when(F.col("n").isNull(), F.col("id")).otherwise(F.col("keep"))
    size = F.coalesce(F.col("n"), F.col("copies"))
    return joined.select(
        F.col("id"), keep.alias("keep_id"), size.alias("group_size"), F.col("sha"),
        F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"),
    ).select(
        F.col("id").alias(id_col), "keep_id", "group_size",
        (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns."""
    own, place = private(docs, "own_hash"), private(docs, "place")
    kept = exact_groups(docs, id_col, text_col).where("kept")
    kept = kept.select(F.col(id_col).alias("kept_id"), F.unhex("text_sha256").alias("kept_hash"))
    named = docs.withColumn(own, F.unhex(F.sha2(normalised(text_of(docs, text_col)), 256)))
    same = named[id_col].eqNullSafe(kept["kept_id"]) & (named[own] == kept["kept_hash"])
    stay = named.join(kept, same, "left_semi")
    # of rows with one id and one text the smallest by the other columns; maps have no order, their JSON does
    rest = [
        F.to_json(F.struct(F.col(f"`{f.name}`"))) if "map<" in f.dataType.simpleString() else F.col(f"`{f.name}`")
        for f in docs.schema if f.name not in (id_col, text_col)
    ]
    first = Window.partitionBy(f"`{id_col}`", own).orderBy(*rest, F.lit(0))
    return stay.withColumn(place, F.row_number().over(first)).where(F.col(place) == 1).drop(own, place)


SQL = r"""
WITH t AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
), g AS (
    SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm
)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(t.norm) AS text_sha256
FROM t JOIN g USING (norm)
"""
