"""Many literals in one pass over the texts of a batch.

Places whose first characters begin a literal are told by one table look-up a byte; only
those are compared further. A literal that overlaps itself is taken from left to right.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lurewatch import lexicons as lex
from lurewatch.functions import batches, text as tx
from lurewatch.functions.plan import let

KINDS = ("urgency", "credential", "lure", "greeting", "brand")


@lru_cache(maxsize=None)
def weights() -> dict[str, tuple[int, ...]]:
    """term -> how much one occurrence adds to each kind (repeated entries add up)."""
    out: dict[str, list[int]] = {}
    for pos, kind in enumerate(KINDS):
        for term in lex.FOLDED.get(kind, lex.BRANDS):
            out.setdefault(term, [0] * len(KINDS))[pos] += 1
    return {t: tuple(w) for t, w in out.items()}


def longest_of(terms) -> str:
    """Pattern of a prefix tree: the longest of the terms that begins here."""
    tree: dict = {}
    for term in terms:
        node = tree
        for c in term:
            node = node.setdefault(c, {})
        node[""] = {}

    def pattern(node: dict) -> str:
        ways = [re.escape(c) + pattern(below) for c, below in sorted(node.items()) if c]
        if not ways:
            return ""
        body = ways[0] if len(ways) == 1 and "" not in node else f"(?:{'|'.join(ways)})"
        return body + ("?" if "" in node else "")

    return pattern(tree)


def lexicon_hits(text: Column, letters: bool = False) -> Column:
    """Struct of term counts (urgency, credential, lure) and greeting / brand presence.

    A count is the sum over the terms of a kind of their non-overlapping occurrences in the
    folded text. ``letters`` adds the numbers of letters and of capitals, null for a text
    with characters that versions of Unicode may tell differently, and whether a look-alike
    is among its characters.
    """
    table = weights()
    terms, adds = tuple(table), np.array(list(table.values()))
    types = [f"{k} int" for k in KINDS[:3]] + [f"{k} boolean" for k in KINDS[3:]] + ["letters int", "capitals int", "homoglyph boolean"] * letters
    if not all(t.isascii() for t in terms):
        raise ValueError("a folded term holds ASCII only")
    # folded as ``tx.fold`` does it; no term holds the byte that stands for other characters
    foldings = tx.cased_foldings()
    alike = np.array(sorted(map(ord, lex.HOMOGLYPHS)), np.uint32)

    @F.arrow_udf(", ".join(types))
    def run(texts: pa.Array) -> pa.Array:
        sums, told = np.zeros((len(texts), len(KINDS)), np.int64), []
        for first, piece in batches.sliced(texts):
            points, ends = batches.characters(piece)
            last = first + len(piece)
            for term, row, _ in batches.find(*tx.spelled(points, ends, foldings, b"\x01"), terms):
                sums[first:last] += np.outer(np.bincount(row, minlength=len(piece)), adds[term])
            if letters:
                kind = tx.kinds()[points]
                none = piece.is_null().to_numpy(zero_copy_only=False)
                unknown = (tx.per_row((kind & tx.KNOWN) == 0, ends) > 0) | none
                told.append([pa.array(tx.per_row(kind & bit > 0, ends).astype(np.int32), mask=unknown) for bit in (tx.LETTER, tx.CAPITAL)])
                beyond = np.flatnonzero(points >= alike[0])
                row = np.searchsorted(ends, beyond[np.isin(points[beyond], alike)], "right") - 1
                told[-1].append(pa.array(np.bincount(row, minlength=len(piece)) > 0, mask=none))
        columns = [pa.array(sums[:, i].astype(np.int32)) for i in range(3)] + [pa.array(sums[:, i] > 0) for i in range(3, len(KINDS))]
        if letters:
            empty = [pa.array([], pa.int32()), pa.array([], pa.int32()), pa.array([], pa.bool_())]
            columns += [pa.concat_arrays(c) for c in zip(*(told or [empty]))]
        return pa.StructArray.from_arrays(columns, [*KINDS, *["letters", "capitals", "homoglyph"] * letters])

    return run(text)


def occurrences(folded: Column, terms) -> Column:
    """``(term, start)`` of the non-overlapping occurrences of every term, ``start`` from zero."""
    terms = tuple(dict.fromkeys(terms))

    @F.arrow_udf("array<struct<term:string,start:int>>")
    def run(texts: pa.Array) -> pa.Array:
        data, offsets = batches.flat(texts)
        names, rows, starts = [], [], []
        for first, last in batches.pieces(offsets):
            inside, bounds = data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
            before = np.append(0, np.cumsum((inside & 0xC0) != 0x80))  # characters before a byte
            for term, row, at in batches.find(inside, bounds, terms):
                names.append(np.full(len(at), term, np.int32))
                rows.append(row + first)
                starts.append((before[at] - before[bounds[row]]).astype(np.int32))
        joined = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int32)
        row = joined(rows)
        order = np.argsort(row, kind="stable")
        term = pa.array(terms, pa.string()).take(pa.array(joined(names)[order]))
        found = pa.StructArray.from_arrays([term, pa.array(joined(starts)[order])], ["term", "start"])
        return pa.ListArray.from_arrays(np.searchsorted(row[order], np.arange(len(texts) + 1)).astype(np.int32), found)

    return run(folded)


#: Terms that a lexicon table may hold: they become one pattern of the plan.
MAX_TERMS = 20_000


def coverage(mail: DataFrame, lexicon: DataFrame, kinds: tuple[str, ...] = tuple(lex.FOLDED)) -> DataFrame:
    """``(kind, term_norm, mails, hits)`` of every term of a lexicon table that some mail holds.

    The table is read when the query is planned. A mail counts its terms itself, so a
    term that a third of all mails hold is one row of the shuffle for each task.
    """
    rows = lexicon.where(F.col("kind").isin(*kinds)).select("kind", "term_norm").distinct().limit(MAX_TERMS + 1).collect()
    if len(rows) > MAX_TERMS:
        raise ValueError(f"more than {MAX_TERMS} terms")
    terms = sorted({r["term_norm"] for r in rows if r["term_norm"]})
    if not terms:
        return lexicon.select("kind", "term_norm", F.lit(0).cast("long").alias("mails"), F.lit(0).cast("long").alias("hits")).where("false")

    def counted(found: Column) -> Column:
        return F.transform(F.array_distinct(F.transform(found, lambda x: x["term"])), lambda t: F.struct(
            t.alias("term"), F.size(F.filter(found, lambda x: x["term"] == t)).alias("n")
        ))

    per_mail = mail.select(let(occurrences(tx.fold(tx.full_text()), terms), counted).alias("c"))
    held = per_mail.select(F.inline_outer("c")).where("term IS NOT NULL")
    sums = held.groupBy(F.col("term").alias("term_norm")).agg(F.count("*").alias("mails"), F.sum("n").alias("hits"))
    named = mail.sparkSession.createDataFrame([(r["kind"], r["term_norm"]) for r in rows], "kind string, term_norm string")
    return sums.join(F.broadcast(named), "term_norm").select("kind", "term_norm", "mails", "hits")
