"""Quality classifier: random-indexing word vectors, pooled, and a small network.

1. Every word has a core (letters and digits, lowered) and a shape (kinds of
   characters); both are hashed to one of ``BUCKETS`` numbers. A number's index
   vector is sparse, ternary and follows from the number. One pass over all texts
   adds the index vectors of the neighbours to each number's context vector: tasks
   sum their own share, then blocks of numbers are summed in two levels, so no task
   ever holds more than a few such tables. These tables have a fixed size.
2. A document is the mean of its words' vectors, the mean of their shapes' vectors,
   the spread of the former, and three products of index vectors that tell of
   repetition: of neighbours, of the pooled index vector with itself for cores and
   for shapes.
3. A network of two layers is fitted on at most ``MAX_FIT`` labelled rows (those
   with the smallest hash of the id), four in five of them for the weights and the
   rest for the temperature that calibrates its probabilities.

Labels are learned only from rows whose crc32(id as text) mod 5 is not 0. Labels,
ids and every column but the text stay out of a score.

Null text is empty; an empty text has zero vectors and gets the score of those. A
null id counts as the empty string. Labels that contradict each other for an id
count as the smaller one; null labels are left out; without two classes to learn
from every score is the share of label 1 (one half without labels). Repeated rows
are scored one by one and an empty table gives an empty result. Texts are read
whole.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lurewatch.llm.bytebpe import Cache
from lurewatch.llm.common import text_of

BUCKETS, DIMS, NONZERO = 1 << 14, 64, 2
#: Numbers that describe a document.
WIDTH = 3 * DIMS + 3
#: Labelled rows that the network may learn from.
MAX_FIT = 20_000
HIDDEN, EPOCHS, BATCH, RATE, DECAY = 32, 40, 256, 3e-3, 1e-3
#: Deviation of a pooled entry as the network sees it; the few products of index vectors have 1.
POOLED = 0.1
THRESHOLD = 0.3
_BLOCK = 256


def word_numbers(raw: bytes) -> tuple[int, int]:
    """Bucket of the word's core and of its shape; shapes have their own hash."""
    word = raw.decode()
    core = "".join(c for c in word if c.isalnum()).lower()
    shape = re.sub(r"(.)\1+", r"\1\1", "".join("A" if c.isupper() else "a" if c.isalpha() else "9" if c.isdigit() else c for c in word))
    return zlib.crc32(core.encode()) % BUCKETS, zlib.crc32(b"shape:" + shape.encode()) % BUCKETS


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the nonzero entries of each number's index vector."""
    rng = np.random.default_rng(20)
    places = np.argsort(rng.random((BUCKETS, DIMS)), axis=1)[:, :NONZERO]
    return places.astype(np.int64), rng.choice([-1.0, 1.0], size=(BUCKETS, NONZERO))


class Numbers:
    """Cores and shapes of a text's words, with a bounded cache of words."""

    def __init__(self) -> None:
        self.known = Cache(lambda w: (lambda c, s: c * BUCKETS + s)(*word_numbers(w)))

    def of(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        both = np.fromiter(map(self.known.__getitem__, text.encode().split()), dtype=np.int64)
        return both // BUCKETS, both % BUCKETS


# ---- word vectors ----------------------------------------------------------


def _add_contexts(total: np.ndarray, at: list[np.ndarray], next_to: list[np.ndarray], places, signs) -> None:
    """total[a] += index vector of b, for all neighbours a, b."""
    a, b = np.concatenate(at), np.concatenate(next_to)
    for step in range(0, len(a), 1 << 19):
        x, y = a[step : step + (1 << 19)], b[step : step + (1 << 19)]
        for k in range(NONZERO):
            total += np.bincount(x * DIMS + places[y, k], weights=signs[y, k], minlength=BUCKETS * DIMS).astype(np.int64)


def _blocks(total: np.ndarray) -> pa.RecordBatch:
    rows = total.reshape(BUCKETS // _BLOCK, _BLOCK * DIMS)
    return pa.RecordBatch.from_arrays(
        [pa.array(range(len(rows)), pa.int32()), pa.array([r.astype("<i8").tobytes() for r in rows], pa.binary())],
        ["block", "sums"],
    )


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
            value = np.frombuffer(raw.as_py(), dtype="<i8")
            sums[block] = sums[block] + value if block in sums else value
    if sums:
        yield pa.RecordBatch.from_arrays(
            [pa.array(sums, pa.int32()), pa.array([v.tobytes() for v in sums.values()], pa.binary())], ["block", "sums"]
        )


def word_vectors(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Unit context vectors of all numbers, from all texts; zero where nothing was seen."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, (places, signs) = Numbers(), index_vectors()
        total = np.zeros(BUCKETS * DIMS, dtype=np.int64)
        at, next_to, held = [], [], 0
        for batch in batches:
            for text in batch.column(0):
                for seq in numbers.of(text.as_py()):
                    at += [seq[:-1], seq[1:]]
                    next_to += [seq[1:], seq[:-1]]
                    held += 2 * len(seq)
                if held >= 1 << 21:
                    _add_contexts(total, at, next_to, places, signs)
                    at, next_to, held = [], [], 0
        if at:
            _add_contexts(total, at, next_to, places, signs)
        yield _blocks(total)

    parts = docs.select(text_of(docs, text_col)).mapInArrow(count, "block int, sums binary")
    n = BUCKETS // _BLOCK
    level = parts.repartition(n, "block", F.floor(F.rand(7) * 16)).mapInArrow(_summed, "block int, sums binary")
    level = level.repartition(n, "block").mapInArrow(_summed, "block int, sums binary")
    vectors = np.zeros((BUCKETS, DIMS))
    for row in level.collect():  # BUCKETS x DIMS numbers in all
        vectors[row["block"] * _BLOCK : (row["block"] + 1) * _BLOCK] = np.frombuffer(row["sums"], dtype="<i8").reshape(_BLOCK, DIMS)
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    return (vectors / np.where(norms > 0, norms, 1.0)).astype(np.float32)


class Pooler:
    def __init__(self, vectors: np.ndarray):
        self.numbers, self.vectors, self.squares = Numbers(), vectors, vectors * vectors

    def pool(self, text: str) -> np.ndarray:
        cores, shapes = self.numbers.of(text)
        if not len(cores):
            return np.zeros(WIDTH, dtype=np.float32)
        kinds, n = np.unique(cores, return_counts=True)
        share = (n / len(cores)).astype(np.float32)
        mean = share @ self.vectors[kinds]
        spread = np.sqrt(np.maximum(share @ self.squares[kinds] - mean * mean, 0))
        forms, n = np.unique(shapes, return_counts=True)
        form_share = (n / len(shapes)).astype(np.float32)
        # index vectors of different numbers are nearly orthogonal
        repeated = np.mean(cores[1:] == cores[:-1]) if len(cores) > 1 else 0.0
        again = np.asarray([repeated, share @ share, form_share @ form_share], dtype=np.float32)
        return np.concatenate([mean, form_share @ self.vectors[forms], spread, again])


# ---- network ---------------------------------------------------------------


@dataclass(frozen=True)
class Network:
    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -50, 50)))


def constant(share: float) -> Network:
    share = min(max(share, 1e-6), 1 - 1e-6)
    zero = np.zeros(WIDTH)
    return Network(zero, zero + 1, np.zeros((WIDTH, 1)), np.zeros(1), np.zeros(1), float(np.log(share / (1 - share))), 1.0)


def fit_network(x: np.ndarray, y: np.ndarray, aside: np.ndarray) -> Network:
    """Adam on the cross-entropy of the rows not set aside; those give the temperature."""
    if not len(y) or y.min() == y.max():
        return constant(float(y.mean()) if len(y) else 0.5)
    if len(np.unique(y[~aside])) < 2 or not aside.any():
        aside = np.zeros(len(y), dtype=bool)
    tx, ty = x[~aside].astype(np.float64), y[~aside].astype(np.float64)
    mean, scale = tx.mean(0), np.where(tx.std(0) > 1e-6, tx.std(0), 1.0)
    scale[: 3 * DIMS] /= POOLED
    z, rng = (tx - mean) / scale, np.random.default_rng(3)
    params = [rng.normal(0, z.shape[1] ** -0.5, (z.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
    first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(z))
        for at in range(0, len(z), BATCH):
            rows = order[at : at + BATCH]
            w1, b1, w2, b2 = params
            hidden = np.tanh(z[rows] @ w1 + b1)
            error = (1 / (1 + np.exp(-np.clip(hidden @ w2 + b2[0], -50, 50))) - ty[rows]) / len(rows)
            back = error[:, None] * w2 * (1 - hidden**2)
            slopes = [z[rows].T @ back + DECAY * w1, back.sum(0), hidden.T @ error + DECAY * w2, np.asarray([error.sum()])]
            step += 1
            for k, g in enumerate(slopes):
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                params[k] = params[k] - RATE * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    net = Network(mean, scale, params[0], params[1], params[2], float(params[3][0]), 1.0)
    held = aside if aside.any() else ~aside
    logits, truth = net.logits(x[held]), y[held].astype(np.float64)
    # the temperature with the least cross-entropy on the rows set aside, on a fine grid
    grid = np.exp(np.linspace(np.log(0.25), np.log(8), 141))
    loss = [np.mean(np.logaddexp(0, logits / t) - truth * logits / t) for t in grid]
    return Network(net.mean, net.scale, net.w1, net.b1, net.w2, net.b2, float(grid[int(np.argmin(loss))]))


# ---- jobs ------------------------------------------------------------------


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def fit_classifier(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    max_fit: int = MAX_FIT,
) -> tuple[np.ndarray, Network]:
    vectors = word_vectors(docs, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(vectors)
    chosen = (
        labels.where(~held_out(labels[id_col]) & labels[label_col].isNotNull() & labels[id_col].isNotNull())
        .groupBy(labels[id_col].alias("__id"))
        .agg(F.min(labels[label_col]).cast("int").alias("y"))
        .withColumn("h", F.xxhash64("__id"))
        .orderBy("h", "__id")
        .limit(max_fit)
    )

    def pooled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pooler = Pooler(shared.value)
        for batch in batches:
            x = [pooler.pool(t.as_py()).astype("<f4").tobytes() for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()), batch.column(1), batch.column(2)], ["x", "y", "h"])

    # at most max_fit small rows
    few = docs.select(docs[id_col].alias("__id"), text_of(docs, text_col).alias("t")).join(F.broadcast(chosen), "__id")
    rows = few.select("t", "y", "h").mapInArrow(pooled, "x binary, y int, h long").toArrow()
    x = np.frombuffer(b"".join(rows["x"].to_pylist()), dtype="<f4").reshape(-1, WIDTH)
    y, h = np.asarray(rows["y"].to_pylist(), dtype=np.int64), np.asarray(rows["h"].to_pylist(), dtype=np.int64)
    order = np.lexsort([*x[:, :2].T, h])
    return vectors, fit_network(x[order], y[order], (h[order] >> 7) % 5 == 0)


def _scorer(model):
    pooler = Pooler(model[0])
    return lambda column: (
        model[1].scores(np.stack([pooler.pool(t.as_py() or "") for t in column])) if len(column) else np.zeros(0)
    )


def score_documents(
    docs: DataFrame, model: tuple[np.ndarray, Network], id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: id, held_out, score, predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = _scorer(shared.value)
        for batch in batches:
            s = score(batch.column(2))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(s, pa.float64()), pa.array((s >= THRESHOLD).astype(np.int32))],
                [id_col, "held_out", "score", "predicted"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    chosen = docs.select(docs[id_col].alias(id_col), held_out(docs[id_col]).alias("held_out"), text_of(docs, text_col).alias("t"))
    return chosen.mapInArrow(run, f"`{id_col}` {kind}, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, model: tuple[np.ndarray, Network], text_col: str = "text") -> DataFrame:
    """The rows with predicted = 1, with all their columns."""
    shared, place = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = _scorer(shared.value)
        for batch in batches:
            yield batch.filter(pa.array(score(batch.column(place)) >= THRESHOLD))

    return docs.mapInArrow(run, docs.schema)
