"""Connected components of an edge list by alternating large and small stars.

Every step sends each vertex's neighbours to its smallest neighbour; a vertex with
very many edges is summed map-side, and the join that hands the minimum back is one
that adaptive execution splits. Edges are written to the shared folder after every
step, so nothing is computed twice and a lost executor loses nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lurewatch.llm.common import drop_stored, stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges: u, v without order. Large: larger neighbours meet the minimum; small: the others do."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    if not large:
        both = both.where("v < u")
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = both.join(low, "u")
    if large:
        return joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return moved.union(low.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """(u, c): the smallest vertex that each vertex of an edge reaches; roots are left out."""
    now = stored(edges.select("u", "v").where("u <> v").distinct(), "edges")
    mark = _mark(now)
    while True:
        large = stored(_star(now, True).distinct(), "edges")
        small = stored(_star(large, False).distinct(), "edges")
        after = _mark(small)
        drop_stored(now)
        drop_stored(large)
        now = small
        if after == mark:
            return now.select("u", F.col("v").alias("c"))
        mark = after


def _mark(edges: DataFrame) -> tuple:
    """Count and two sums of hashes: equal only for the same set of edges, for all that matters."""
    a, b = F.xxhash64("u", "v"), F.xxhash64("v", "u")
    big = "decimal(38,0)"
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(a.cast(big)), F.sum(b.cast(big))).first())
