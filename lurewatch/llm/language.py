"""Language identification by partial matching: per-language byte context trees.

1. Every training text adds, for its language, the bytes it holds and the ``ORDER``
   bytes before each (a text begins behind that many line feeds). Tasks merge
   these runs, Spark adds them up; shorter contexts are sums of longer ones.
2. A tree keeps, for each language and depth, the runs seen most: all of those seen
   at least as often as the least count for which they fit ``CELLS``. Counts are of
   all training texts; only how many runs a tree remembers is bounded.
3. The statistics are frozen. A byte seen n times in a context of total t with d
   kinds of next bytes has probability n / (t + d); any other byte escapes with
   d / (t + d) to the context shorter by one, and from the empty context to 1 / 256.
   A context that a tree does not hold costs nothing to leave.
4. The code length of a whole text under each tree is the sum over its bytes. The
   shortest one names the language (ties: the smallest name); ``score`` is its share
   of 2 to the minus code length over all languages.

Learned are only rows with text and language whose crc32(id as text) mod 3 is not 1;
a null id counts as the empty string. Predictions read the text alone. Null text and
text without a letter are ``und`` with score 0 and code length null; so is every text
if nothing was learned. Texts are read whole, rows that repeat are predicted one by
one (and learned as often as they occur), an empty table gives an empty result.
Columns besides id, text and language are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

#: Bytes of the longest context.
ORDER = 3
#: Code lengths that a model holds, 4 bytes each.
CELLS = 1 << 24
#: Runs a task holds before it merges and sends them.
TASK_RUNS = 1 << 23
#: Bytes of a long text that are scored at once.
SLICE = 1 << 20


def runs_of(raw: bytes, order: int = ORDER) -> np.ndarray:
    """For each byte the number made of it and the ``order`` bytes before."""
    padded = np.frombuffer(b"\n" * order + raw, dtype=np.uint8)
    out = np.zeros(len(raw), dtype=np.uint32)
    for k in range(order + 1):
        out = (out << np.uint32(8)) | padded[k : k + len(raw)]
    return out


def merged(runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct runs in order and how often each occurs."""
    runs = np.sort(runs)
    starts = np.flatnonzero(np.concatenate([[True], runs[1:] != runs[:-1]])) if len(runs) else np.zeros(0, np.int64)
    return runs[starts], np.diff(np.append(starts, len(runs)))


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 3 == 1


def count_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", order: int = ORDER
) -> DataFrame:
    """``(lang, depth, run, n)`` over all training texts; a run of depth k has k context bytes."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[np.ndarray]] = {}
        size = 0

        def rows() -> Iterator[pa.RecordBatch]:
            for lang, parts in held.items():
                runs, n = merged(np.concatenate(parts))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(runs), pa.string()), pa.array(runs.astype(np.int64)), pa.array(n.astype(np.int64))],
                    ["lang", "run", "n"],
                )
            held.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                runs = runs_of(text.as_py().encode(), order)
                held.setdefault(lang, []).append(runs)
                size += len(runs)
                if size >= TASK_RUNS:
                    yield from rows()
                    size = 0
        yield from rows()

    known = docs.where(~held_out(docs[id_col]) & docs[text_col].isNotNull() & docs[lang_col].isNotNull())
    texts = known.select(known[lang_col].cast("string").alias("lang"), known[text_col].cast("string").alias("text"))
    whole = texts.mapInArrow(count, "lang string, run long, n long").groupBy("lang", "run").agg(F.sum("n").alias("n"))
    cuts = F.array(*[F.struct(F.lit(k).alias("depth"), F.lit((1 << 8 * (k + 1)) - 1).cast("long").alias("mask")) for k in range(order + 1)])
    return (
        whole.select("lang", "run", "n", F.inline(cuts))
        .groupBy("lang", "depth", F.col("run").bitwiseAND(F.col("mask")).alias("run"))
        .agg(F.sum("n").alias("n"))
    )


def kept_runs(counts: DataFrame, limit: int) -> DataFrame:
    """For each language and depth the runs seen most: equal counts stay or go together, ``limit`` at most."""
    levels = counts.groupBy("lang", "depth", "n").agg(F.count("*").alias("kinds"))
    falling = Window.partitionBy("lang", "depth").orderBy(F.col("n").desc())
    least = (
        levels.withColumn("upto", F.sum("kinds").over(falling))
        .where(F.col("upto") <= limit)
        .groupBy("lang", "depth")
        .agg(F.min("n").alias("least"))
    )
    return counts.join(least, ["lang", "depth"]).where(F.col("n") >= F.col("least")).drop("least")


@dataclass(frozen=True)
class Trees:
    """Code lengths of all languages side by side, one table for each depth.

    ``runs[k]`` are the sorted runs of depth k that any language knows and ``bits[k]``
    what they cost in each; ``contexts[k]`` and ``escapes[k]`` are the contexts of that
    depth and what leaving them costs.
    """

    langs: list[str]
    runs: list[np.ndarray]
    bits: list[np.ndarray]
    contexts: list[np.ndarray]
    escapes: list[np.ndarray]

    @staticmethod
    def build(langs: list[str], lang: np.ndarray, depth: np.ndarray, run: np.ndarray, n: np.ndarray, order: int = ORDER) -> "Trees":
        trees = Trees(langs, [], [], [], [])
        for k in range(order + 1):
            at = depth == k
            runs, row = np.unique(run[at].astype(np.uint32), return_inverse=True)
            contexts, place = np.unique(runs >> np.uint32(8), return_inverse=True)
            counts = np.zeros((len(runs), len(langs)))
            counts[row, lang[at]] = n[at]
            total, kinds = np.zeros((2, len(contexts), len(langs)))
            np.add.at(total, place, counts)
            np.add.at(kinds, place, counts > 0)
            whole = np.maximum(total + kinds, 1)
            trees.contexts.append(contexts)
            trees.escapes.append(np.where(kinds > 0, np.log2(whole) - np.log2(np.maximum(kinds, 1)), 0).astype(np.float32))
            shorter = trees._bits(k - 1, runs & np.uint32((1 << 8 * k) - 1)) + trees.escapes[k][place]
            own = np.log2(whole)[place] - np.log2(np.maximum(counts, 1))
            trees.runs.append(runs)
            trees.bits.append(np.where(counts > 0, own, shorter).astype(np.float32))
        return trees

    def _bits(self, k: int, codes: np.ndarray) -> np.ndarray:
        """Code length of the last byte of each run behind its k context bytes, in each language."""
        if k < 0:
            return np.full((len(codes), len(self.langs)), 8.0, dtype=np.float32)
        at, known = _find(self.runs[k], codes)
        out = np.empty((len(codes), len(self.langs)), dtype=np.float32)
        out[known] = self.bits[k][at[known]]
        rest = codes[~known]
        if len(rest):
            at, met = _find(self.contexts[k], rest >> np.uint32(8))
            left = np.zeros((len(rest), len(self.langs)), dtype=np.float32)
            left[met] = self.escapes[k][at[met]]
            out[~known] = left + self._bits(k - 1, rest & np.uint32((1 << 8 * k) - 1))
        return out

    def code_lengths(self, texts: list[bytes]) -> np.ndarray:
        """Bits of each whole text under each tree."""
        total = np.zeros((len(texts), len(self.langs)))
        order, waiting, size = len(self.runs) - 1, [], 0

        def add() -> None:
            codes = np.concatenate([c for _, c, _ in waiting])
            weighed = self._bits(order, codes) * np.concatenate([n for _, _, n in waiting])[:, None]
            starts = np.cumsum([0, *[len(c) for _, c, _ in waiting[:-1]]])
            np.add.at(total, [i for i, _, _ in waiting], np.add.reduceat(weighed.astype(np.float64), starts, axis=0))
            waiting.clear()

        for i, raw in enumerate(texts):
            runs = runs_of(raw, order)
            for lo in range(0, len(runs), SLICE):
                codes, n = merged(runs[lo : lo + SLICE])
                waiting.append((i, codes, n))
                size += len(codes)
                if size >= SLICE:
                    add()
                    size = 0
        if waiting:
            add()
        return total


def _find(table: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(table):
        return np.zeros(len(codes), dtype=np.int64), np.zeros(len(codes), dtype=bool)
    at = np.minimum(np.searchsorted(table, codes), len(table) - 1)
    return at, table[at] == codes


def fit_languages(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", order: int = ORDER,
    cells: int = CELLS,
) -> Trees:
    """Trees of all languages; at most ``cells`` code lengths in all, some more for escapes."""
    from lurewatch.llm.common import stored

    counts = stored(count_runs(docs, id_col, text_col, lang_col, order), "runs")
    langs = sorted(r["lang"] for r in counts.where("depth = 0").select("lang").distinct().collect())
    if not langs:
        return Trees([], [], [], [], [])
    # a run of one language has a cell in every language
    limit = max(1, cells // ((order + 1) * len(langs) ** 2))
    rows = kept_runs(counts, limit).select("lang", "depth", "run", "n").toArrow().sort_by([("lang", "ascending"), ("depth", "ascending"), ("run", "ascending")])
    place = {lang: i for i, lang in enumerate(langs)}
    lang = np.asarray([place[x] for x in rows["lang"].to_pylist()], dtype=np.int64)
    return Trees.build(langs, lang, *(rows[c].to_numpy() for c in ("depth", "run", "n")), order)


def predict_languages(docs: DataFrame, trees: Trees, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, held_out, lang_pred, score, bits (code length of the text under its language)."""
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts = [t or "" for t in batch.column(2).to_pylist()]
            told = [i for i, t in enumerate(texts) if model.langs and any(map(str.isalpha, t))]
            pred, score, bits = ["und"] * len(texts), np.zeros(len(texts)), [None] * len(texts)
            if told:
                lengths = model.code_lengths([texts[i].encode() for i in told])
                best = lengths.argmin(axis=1)
                least = lengths[np.arange(len(told)), best]
                score[told] = 1 / np.exp2(np.maximum(least[:, None] - lengths, -1000)).sum(axis=1)
                for i, b, length in zip(told, best, least):
                    pred[i], bits[i] = model.langs[b], float(length)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(pred, pa.string()), pa.array(score), pa.array(bits, pa.float64())],
                [id_col, "held_out", "lang_pred", "score", "bits"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    chosen = docs.select(docs[id_col], held_out(docs[id_col]).alias("held_out"), docs[text_col].cast("string").alias("t"))
    return chosen.mapInArrow(run, f"`{id_col}` {kind}, held_out boolean, lang_pred string, score double, bits double")
