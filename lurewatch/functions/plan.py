"""Helpers that keep the optimizer from evaluating an expensive column twice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def pinned(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns that filters and join keys cannot inline below their definition.

    A predicate on a projected column is pushed through the projection by copying
    the whole expression; on a generator's output it stays where it is. The
    generator here is a one-element array, so row count and order do not change.
    """
    pack = F.struct(*[c.alias(n) for n, c in columns.items()])
    return df.select("*", F.inline_outer(F.array(pack)))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body uses it.

    Inside a lambda, or across branches of a conditional, the engine does not share
    repeated subexpressions; a lambda variable is bound once.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
