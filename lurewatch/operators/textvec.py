"""Word and character TF-IDF with a vocabulary bounded by construction.

Fitting is one aggregation (terms counted inside the row, then combined map-side);
its result is at most ``max_features`` terms. Transforming is map-only.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, functions as F

from lurewatch.functions import grams
from lurewatch.functions.plan import let
from lurewatch.functions.text import clean_text, full_text
from lurewatch.functions.vectors import offsets


def words(clean: Column) -> Column:
    return F.regexp_extract_all(clean, F.lit("[^ ]{2,}"), F.lit(0))


def word_ngrams(clean: Column) -> Column:
    """Words of two characters or more, then pairs of neighbours among those."""
    pairs = F.lit(r"(?<![^ ])(?=([^ ]+ [^ ]+))")

    def with_pairs(tokens):
        return F.concat(
            tokens, F.regexp_extract_all(F.array_join(tokens, " "), pairs, F.lit(1))
        )

    return let(words(clean), with_pairs)


def char_ngrams(clean: Column, sizes: tuple[int, ...] = (3, 4, 5)) -> Column:
    """Character n-grams inside space-padded words.

    In text padded by single spaces these are the windows whose inner characters
    are not spaces; a word shorter than the window has none, so it is not repeated.
    """
    windows = [f"(?=(.[^ ]{{{n - 2}}}.))" for n in sizes]
    return let(
        F.concat(F.lit(" "), clean, F.lit(" ")),
        lambda padded: F.concat(
            *[F.regexp_extract_all(padded, F.lit(w), F.lit(1)) for w in windows]
        ),
    )


TOKENIZERS = {"word": word_ngrams, "char": char_ngrams}


def term_document_frequency(
    docs: DataFrame, kind: str = "word", among: pa.Array | None = None, pairs: bool = True
) -> DataFrame:
    """``(term, df, total_tf)`` over a ``clean`` column; tasks count their rows piece by piece first.

    ``among`` and ``pairs`` as in ``grams.tally``.
    """
    counted = docs.select("clean").mapInArrow(grams.tally(kind, among, pairs), "term string, df long, total_tf long")
    return counted.groupBy("term").agg(F.sum("df").alias("df"), F.sum("total_tf").alias("total_tf"))


@dataclass(frozen=True)
class TextSpace:
    """A fitted vocabulary in column order with its inverse document frequencies."""

    kind: str
    terms: list[str]
    idf: list[float]

    def vocabulary(self) -> grams.Vocabulary:
        return grams.Vocabulary(self.kind, tuple(self.terms))

    def transform(self, df: DataFrame, out: str) -> DataFrame:
        """Add the L2-normalised sublinear TF-IDF vector of the ``clean`` column."""
        return df.withColumn(out, _vectors(self.vocabulary(), np.array(self.idf))("clean"))

    def cells(self, df: DataFrame, key: str = "mail_id") -> DataFrame:
        """``(key, cells)``: the same vectors as arrays of ``(idx, tf, weight)``."""
        arrays = df.select(key, _cells(self.vocabulary(), np.array(self.idf))("clean").alias("c"))
        return arrays.select(key, F.arrays_zip("c.idx", "c.tf", "c.weight").alias("cells"))

    def names(self) -> Column:
        return F.split(F.lit("\x01".join(self.terms)), "\x01")

    def long_weights(self, df: DataFrame, key: str = "mail_id") -> DataFrame:
        """``(key, term, tf, weight)`` rows of the same vectors."""
        return (
            self.cells(df, key)
            .select(key, F.inline_outer("cells"))
            .where(F.col("idx").isNotNull())
            .select(key, F.get(self.names(), F.col("idx")).alias("term"), "tf", "weight")
        )

    def top_terms(
        self, df: DataFrame, weights: dict[str, float] | None = None, k: int = 8
    ) -> DataFrame:
        """``(mail_id, rank, term, contribution)``: the strongest terms of each mail.

        Without learnt weights every term weighs 1; a term missing from them weighs
        0. Ranked inside the row, ties by term; entries that cannot be among the first
        ``k`` stay in the kernel.
        """
        learnt = [1.0 if weights is None else weights.get(t, 0.0) for t in self.terms]
        coef = F.split(F.lit(",".join(map(repr, learnt))), ",").cast("array<double>")

        def scored(cell):
            # Rounded so that equal contributions tie whatever the arithmetic order.
            value = F.round(cell["weight"] * F.get(coef, cell["idx"]), 9)
            return F.struct(
                (-F.abs(value)).alias("o"),
                F.get(self.names(), cell["idx"]).alias("term"),
                value.alias("contribution"),
            )

        best = F.slice(F.sort_array(F.transform("cells", scored)), 1, k)
        strong = _cells(self.vocabulary(), np.array(self.idf), (np.array(learnt), k))("clean").alias("c")
        cells = df.select("mail_id", strong).select("mail_id", F.arrays_zip("c.idx", "c.tf", "c.weight").alias("cells"))
        ranked = cells.select("mail_id", F.posexplode_outer(best).alias("pos", "t"))
        return ranked.where(F.col("t").isNotNull()).select(
            "mail_id", (F.col("pos") + 1).alias("rank"), "t.term", "t.contribution"
        )


def _weights(row: np.ndarray, column: np.ndarray, counts: np.ndarray, idf: np.ndarray, rows: int) -> np.ndarray:
    """Sublinear, L2-normalised weights of the entries of a batch of rows."""
    raw = (1.0 + np.log(counts)) * idf[column]
    return raw / np.sqrt(np.bincount(row, weights=raw * raw, minlength=rows))[row]


def _vectors(terms: grams.Vocabulary, idf: np.ndarray):
    @F.pandas_udf(VectorUDT())
    def vectors(clean: pd.Series) -> pd.DataFrame:
        row, column, counts = terms.counts(pa.array(clean, pa.string(), from_pandas=True))
        weight = _weights(row, column, counts, idf, len(clean))
        at = offsets(row, len(clean))[1:-1]
        return pd.DataFrame({
            "type": np.zeros(len(clean), np.int8), "size": np.full(len(clean), len(idf), np.int32),
            "indices": _listed(np.split(column.astype(np.int32), at), clean.index),
            "values": _listed(np.split(weight, at), clean.index),
        }, index=clean.index)

    return vectors


def _listed(parts: list[np.ndarray], index) -> pd.Series:
    return pd.Series(parts[: len(index)], index=index, dtype=object)


#: Contributions this close to the last that counts may tie with it once rounded.
TIE = 1e-8


def strongest(row: np.ndarray, value: np.ndarray, k: int, rows: int) -> np.ndarray:
    """Entries as large as the k-th largest of their row, or nearly so; rows ascend."""
    start = offsets(row, rows)
    down = np.lexsort((-value, row))
    last = np.minimum(start[:-1] + k, start[1:]) - 1
    least = np.where(start[1:] > start[:-1], value[down][np.maximum(last, 0)] if len(value) else 0.0, 0.0)
    return value >= least[row] - TIE


def _cells(terms: grams.Vocabulary, idf: np.ndarray, best: tuple[np.ndarray, int] | None = None):
    """Entries of each row; with ``best`` (weights of the columns, k) those that may be the k strongest."""

    @F.arrow_udf("idx array<int>, tf array<int>, weight array<double>")
    def cells(clean: pa.Array) -> pa.Array:
        row, column, counts = terms.counts(clean)
        weight = _weights(row, column, counts, idf, len(clean))
        if best is not None:
            kept = strongest(row, np.abs(weight * best[0][column]), best[1], len(clean))
            row, column, counts, weight = row[kept], column[kept], counts[kept], weight[kept]
        at = pa.array(offsets(row, len(clean)))
        columns = [column.astype("int32"), counts.astype("int32"), weight]
        return pa.StructArray.from_arrays(
            [pa.ListArray.from_arrays(at, pa.array(c)) for c in columns], ["idx", "tf", "weight"]
        )

    return cells


#: min_df, max share of documents, vocabulary cap
LIMITS = {"word": (3, 0.9, 8000), "char": (3, 1.0, 6000)}


#: Words collected for each place of the vocabulary, to see which can be in it.
SPARE = 4


def _words_in_reach(docs: DataFrame) -> pa.Array | None:
    """Words that come as often as the last of the vocabulary would if it held single words only.

    A term of the vocabulary comes as often at least, and so does each word of a pair. None
    if all words may be in reach, or more words tie than are collected.
    """
    min_df, max_share, cap = LIMITS["word"]
    stats = term_document_frequency(docs, pairs=False).withColumn("n", docs.agg(F.count("*")).scalar())
    words = stats.orderBy(F.col("total_tf").desc(), "term").limit(SPARE * cap).collect()
    kept = [w["total_tf"] for w in words if min_df <= w["df"] <= max_share * w["n"]]
    if len(kept) < cap or (len(words) == SPARE * cap and words[-1]["total_tf"] >= kept[cap - 1]):
        return None
    return pa.array([w["term"] for w in words if w["total_tf"] >= kept[cap - 1]], pa.string())


def vocabulary(docs: DataFrame, kind: str = "word") -> DataFrame:
    """``(term, df, total_tf, idf)`` of the kept terms; ties at the cap go by term.

    Single words are counted first: most pairs hold a word too rare for the vocabulary
    and are not counted then.
    """
    min_df, max_share, cap = LIMITS[kind]
    n = docs.agg(F.count("*")).scalar()
    among = _words_in_reach(docs) if kind == "word" else None
    stats = term_document_frequency(docs, kind, among).withColumn("n", n)
    kept = stats.where((F.col("df") >= min_df) & (F.col("df") <= max_share * F.col("n")))
    top = kept.orderBy(F.col("total_tf").desc(), "term").limit(cap)
    idf = F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1
    return top.select("term", "df", "total_tf", idf.alias("idf"))


def fit_text_space(docs: DataFrame, kind: str = "word") -> TextSpace:
    """Collect the bounded vocabulary (at most 8000 words or 6000 n-grams)."""
    rows = sorted(vocabulary(docs, kind).select("term", "idf").collect())
    return TextSpace(kind, [r["term"] for r in rows], [r["idf"] for r in rows])


def with_clean_text(mail: DataFrame) -> DataFrame:
    return mail.withColumn("clean", clean_text(full_text()))
