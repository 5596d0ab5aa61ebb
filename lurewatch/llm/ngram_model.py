"""Jobs of the hierarchical Pitman-Yor word model: trigrams, bigrams, words.

A word w after a, b is seated in the restaurant of the pair (a, b), whose parent is
the restaurant of b, whose parent is the root over single words; see ``pitman_yor``.
Before a text stand two ends.

1. Blocks of documents name their distinct (a, b, w) once, with training counts, and
   keep each document as sorted trigram numbers. Trigrams go to parts by b, so the
   restaurants of b and of all pairs (a, b) lie whole in one part. A b that fills more
   than one part (``_slices``, from a sample) is spread by w.
2. What parts share, the words at the root and the restaurants of spread contexts, is
   summed by owners of hashed keys and sent back to the parts that named it, once for
   the first seating and once after burn-in. Between these a part moves the sums by its
   own seating. Nothing that grows with the input passes the driver.
3. Parts answer the blocks with a probability for each trigram.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from lurewatch.llm import pitman_yor as py
from lurewatch.llm.common import SPACE, drop_stored, lower_ascii, stored, text_of

#: Tokens of a block: closing one holds some twenty numbers a token.
BLOCK_TOKENS = 1_000_000
#: Bytes of text from which the spread contexts are found.
SAMPLE_BYTES = 32 << 20
_END = py._END
_MESSAGE = "part int, owner int, payload binary, figures array<double>"


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays by byte planes, compressed."""
    planes = b"".join(np.ascontiguousarray(np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.itemsize).T).tobytes() for a in arrays)
    head = np.asarray([len(planes), *(a.nbytes for a in arrays)], dtype="<u4").tobytes()
    return head + pa.compress(planes, codec="zstd", asbytes=True)


def unpack(raw: bytes, *kinds: str) -> list[np.ndarray]:
    whole, *sizes = np.frombuffer(raw, "<u4", 1 + len(kinds)).tolist()
    planes = pa.decompress(raw[4 + 4 * len(kinds) :], whole, codec="zstd", asbytes=True) if whole else b""
    out, at = [], 0
    for size, kind in zip(sizes, kinds):
        wide = np.dtype(kind).itemsize
        out.append(np.ascontiguousarray(np.frombuffer(planes, np.uint8, size, at).reshape(wide, -1).T).reshape(-1).view(kind))
        at += size
    return out


def mix(*hashes) -> np.ndarray:
    out = np.uint64(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        for h in hashes:
            out = (out ^ h) * np.uint64(0xFF51AFD7ED558CCD)
            out = (out ^ (out >> np.uint64(32))) * np.uint64(0xC4CEB9FE1A85EC53)
            out = out ^ (out >> np.uint64(29))
    return out


def dealt(hashes: np.ndarray, parts: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def hashed(words: list[bytes]) -> np.ndarray:
    import xxhash

    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def slices_of(hashes: np.ndarray, slices: dict[int, int]) -> np.ndarray:
    if not slices:
        return np.ones(len(hashes), dtype=np.uint64)
    names = np.sort(np.fromiter(slices, dtype=np.uint64, count=len(slices)))
    at = np.minimum(np.searchsorted(names, hashes), len(names) - 1)
    counts = np.asarray([slices[int(n)] for n in names], dtype=np.uint64)
    return np.where(names[at] == hashes, counts[at], np.uint64(1))


def _bins(at: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    return np.bincount(at, weights=values, minlength=size).astype(np.int64)


# ---- blocks ----------------------------------------------------------------


class Block(py.Block):
    """Documents until BLOCK_TOKENS, closed into trigrams."""

    def close(self, parts: int, slices: dict[int, int]) -> tuple[list[tuple], list[tuple[int, bytes]]]:
        names = hashed(list(self.words))
        n = len(names)
        sizes = np.asarray([len(d[2]) for d in self.docs])
        w = np.concatenate([d[2] for d in self.docs])
        b, a = np.empty_like(w), np.empty_like(w)
        first = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        b[1:] = w[:-1]
        b[first] = self.end
        a[1:] = b[:-1]
        a[first] = self.end
        bigrams, number = np.unique(b * n + w, return_inverse=True)
        trigrams, number = np.unique(number * n + a, return_inverse=True)
        trained = np.repeat([not d[1] for d in self.docs], sizes)
        counts = np.bincount(number, weights=trained, minlength=len(trigrams)).astype("<u4")
        left, right = names[bigrams // n], names[bigrams % n]
        part = dealt(mix(left, right % slices_of(left, slices)), parts)
        order = np.argsort(part, kind="stable")  # of bigrams; their trigrams follow them
        fan = np.bincount(trigrams // n, minlength=len(bigrams))
        place = np.empty(len(bigrams), dtype=np.int64)
        place[order] = np.arange(len(bigrams))
        moved = np.argsort(place[trigrams // n], kind="stable")
        where = np.empty(len(trigrams), dtype=np.int64)
        where[moved] = np.arange(len(trigrams))
        bigrams, fan, part = bigrams[order], fan[order], part[order]
        before, counts, number = (trigrams % n)[moved], counts[moved], where[number]
        ends, requests = np.concatenate(([0], np.cumsum(fan))), []
        cut = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1], [True])))
        for x, y in zip(cut, cut[1:]):
            p, q = ends[x], ends[y]
            used, at = np.unique(np.concatenate((bigrams[x:y] // n, bigrams[x:y] % n, before[p:q])), return_inverse=True)
            at = at.astype("<u4")
            requests.append((int(part[x]), pack(names[used], np.diff(at[: y - x], prepend=np.uint32(0)), at[y - x : 2 * (y - x)], fan[x:y].astype("<u4"), at[2 * (y - x) :], counts[p:q])))
        docs, at = [], 0
        for key, held, own in self.docs:
            mine = np.sort(number[at : at + len(own)])
            docs.append((key, held, pack(np.diff(mine, prepend=0).astype("<u4"))))
            at += len(own)
        return docs, requests


# ---- seating ---------------------------------------------------------------


@dataclass(frozen=True)
class Model:
    """Figures of the whole corpus: training tokens and types, discounts, customers and tables of the root."""

    tokens: int
    types: int
    discounts: tuple[float, float, float]
    customers: float
    tables: float


class Part:
    """All trigrams of one part, merged over the blocks that named them."""

    def __init__(self, requests: list[bytes], slices: dict[int, int]):
        parts = [unpack(r, "<u8", "<u4", "<u4", "<u4", "<u4", "<u4") for r in requests]
        self.hashes, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        n, begin, left, right, before = len(self.hashes), 0, [], [], []
        for names, b, w, _, a, _ in parts:
            own = at[begin : begin + len(names)]
            begin += len(names)
            left.append(own[np.cumsum(b, dtype=np.uint32)])
            right.append(own[w])
            before.append(own[a])
        self.sizes, self.fans = [len(p[4]) for p in parts], [p[3].astype(np.int64) for p in parts]
        bigrams, asked = np.unique(np.concatenate(left) * n + np.concatenate(right), return_inverse=True)
        self.asked_bigrams = asked
        key = np.repeat(asked, np.concatenate(self.fans)) * n + np.concatenate(before)
        trigrams, self.asked = np.unique(key, return_inverse=True)
        self.customers = _bins(self.asked, np.concatenate([p[5] for p in parts]), len(trigrams))
        self.up = trigrams // n
        # both without a sort: bigrams ascend with their last word, and words are numbers below n
        left, right = np.divmod(bigrams, n)
        first = np.concatenate(([True], left[1:] != left[:-1]))
        lasts, self.last = left[first], np.cumsum(first) - 1
        words = np.flatnonzero(np.bincount(right, minlength=n))
        rank = np.empty(n, dtype=np.int64)
        rank[words] = np.arange(len(words))
        self.word = rank[right]
        contexts, self.context = np.unique(left[self.up] * n + trigrams % n, return_inverse=True)
        self.ends = (len(contexts), len(lasts), len(words))
        # every dish starts at one table; only one with more customers can get others
        self.t3 = np.minimum(self.customers, 1)
        self.many = np.flatnonzero(self.customers > 1)
        alone = self.customers == 1
        self.alone2, self.alone3 = _bins(self.up, alone, len(bigrams)), _bins(self.context, alone, len(contexts))
        self.c2 = self.met()
        self.t2 = np.minimum(self.c2, 1)
        # what other parts add: customers and tables of contexts and lasts; customers of words
        self.held = _bins(self.context, self.customers, len(contexts))
        self.more = [np.zeros(x, dtype=np.int64) for x in (len(contexts), len(lasts), len(lasts), len(words))]
        self.counts = _bins(self.word[self.up], self.customers, len(words))
        self.t0 = np.minimum(_bins(self.word, self.t2, len(words)), 1)
        spread = slices_of(self.hashes, slices) > 1
        self.open3, self.open2 = np.flatnonzero(spread[contexts // n]), np.flatnonzero(spread[lasts])
        of = self.hashes
        keys = [mix(of[words], np.uint64(1)), mix(of[lasts[self.open2]], np.uint64(2))]
        keys.append(mix(of[(contexts // n)[self.open3]], of[(contexts % n)[self.open3]], np.uint64(3)))
        kind = np.repeat(np.asarray([1, 0, 0], dtype="u1"), [len(k) for k in keys])
        keys = np.concatenate(keys)
        self.order = np.argsort(keys, kind="stable")
        self.keys, self.kind = keys[self.order], kind[self.order]
        self.own_held, self.own_counts = self.held.copy(), self.counts.copy()

    def met(self) -> np.ndarray:
        """Customers of the bigrams: the tables of their trigrams."""
        return self.alone2 + _bins(self.up[self.many], self.t3[self.many], len(self.alone2))

    def own(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of this part's dishes: tables by context, customers and tables by last, customers by word."""
        contexts, lasts, words = self.ends
        return (
            self.alone3 + _bins(self.context[self.many], self.t3[self.many], contexts), _bins(self.last, self.c2, lasts),
            _bins(self.last, self.t2, lasts), _bins(self.word, self.t2, words),
        )

    def shared(self) -> tuple[np.ndarray, np.ndarray]:
        """Two numbers for each key: counts and customers of words, customers and tables of contexts."""
        t3, c2, t2, c0 = self.own()
        one = np.concatenate((self.own_counts, c2[self.open2], self.own_held[self.open3]))
        two = np.concatenate((c0, t2[self.open2], t3[self.open3]))
        return one[self.order], two[self.order]

    def take(self, one: np.ndarray, two: np.ndarray, tables: np.ndarray) -> None:
        """Sums over all parts, as ``shared`` orders them, and the root's tables of the words."""
        back = np.empty(len(self.order), dtype=np.int64)
        back[self.order] = np.arange(len(back))
        one, two = one.astype(np.int64)[back], two.astype(np.int64)[back]
        x, y = self.ends[2], self.ends[2] + len(self.open2)
        t3, c2, t2, c0 = self.own()
        self.counts, self.t0 = one[:x], tables.astype(np.int64)[back][:x]
        self.more[3] = two[:x] - c0
        self.more[1][self.open2], self.more[2][self.open2] = one[x:y] - c2[self.open2], two[x:y] - t2[self.open2]
        self.held[self.open3], self.more[0][self.open3] = one[y:], two[y:] - t3[self.open3]
        self.begin = (int(c0.sum()), int(self.t0.sum()))

    def totals(self, model: Model) -> tuple:
        """Tables by context, customers and tables by last, customers by word; both figures of the root."""
        own = self.own()
        root = model.customers + own[3].sum() - self.begin[0], model.tables + self.t0.sum() - self.begin[1]
        return (*(x + y for x, y in zip(own, self.more)), *root)

    def _behind(self, model: Model, totals: tuple, at) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities of the words at the root, and of the bigrams at ``at`` after the last word."""
        _, d2, d0 = model.discounts
        _, c2, t2, c0, customers, tables = totals
        last = self.last[at]
        p0 = (c0 - d0 * self.t0 + (py.THETA + d0 * tables) / (model.types + 1)) / (py.THETA + customers)
        return p0, (self.c2[at] - d2 * self.t2[at] + (py.THETA + d2 * t2[last]) * p0[self.word[at]]) / (py.THETA + c2[last])

    def predict(self, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probabilities of the words at the root, after the last word, after the last two."""
        d3, totals = model.discounts[0], self.totals(model)
        p0, p1 = self._behind(model, totals, slice(None))
        p2 = self.customers - d3 * self.t3 + (py.THETA + d3 * totals[0][self.context]) * p1[self.up]
        return p0, p1, p2 / (py.THETA + self.held[self.context])

    def sweep(self, model: Model, logs, rng) -> None:
        (d3, d2, d0), totals = model.discounts, self.totals(model)
        at = self.many
        p0, p1 = self._behind(model, totals, self.up[at])
        self.t3[at] = py.draw_tables(self.customers[at], p1, totals[0][self.context[at]] - self.t3[at], d3, logs[0], rng)
        self.c2 = self.met()
        at = np.flatnonzero(self.c2 > 1)
        seated = np.minimum(self.c2, 1)
        seated[at] = py.draw_tables(self.c2[at], p0[self.word[at]], totals[2][self.last[at]] - self.t2[at], d2, logs[1], rng)
        self.t2 = seated
        c0 = _bins(self.word, self.t2, self.ends[2]) + self.more[3]
        self.t0 = py.draw_tables(c0, np.full(len(c0), 1 / (model.types + 1)), np.maximum(totals[5] - self.t0, 0), d0, logs[2], rng)

    def seats(self, rng) -> bytes:
        """What the next sums do not tell of a seating: tables of trigrams and bigrams, and where the draws stand."""
        state = np.frombuffer(json.dumps(rng.bit_generator.state).encode(), dtype="u1")
        return pack(self.t3[self.many].astype("<u4"), self.t2.astype("<u4"), state)

    def seat(self, raw: bytes) -> np.random.Generator:
        """Take the seating that ``seats`` told; its draws go on."""
        t3, t2, state = unpack(raw, "<u4", "<u4", "u1")
        self.t3[self.many], self.t2 = t3, t2.astype(np.int64)
        self.c2 = self.met()
        rng = np.random.default_rng()
        rng.bit_generator.state = json.loads(state.tobytes())
        return rng


def seen(customers: np.ndarray) -> list[float]:
    return [float(np.sum(customers == 1)), float(np.sum(customers == 2))]


# ---- jobs ------------------------------------------------------------------

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffles of the tables stored here leave the disk with them, not when the driver next collects garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def _slices(docs: DataFrame, size: int, parts: int, text_col: str) -> dict[int, int]:
    """Hash of each word that fills more than one part as the word before: number of its slices."""
    some = docs.select(text_of(docs, text_col).alias("t"))
    if size > SAMPLE_BYTES:
        some = some.sample(fraction=SAMPLE_BYTES / size, seed=5)
    words = some.select(F.explode(F.split(F.concat(F.lit("  "), lower_ascii(F.col("t"))), SPACE)).alias("w"))
    counted = words.groupBy("w").count()
    with _shuffles_dropped(docs.sparkSession):
        counted = stored(counted, "pitman-words")
    total = counted.where("w <> ''").agg(F.sum("count")).first()[0] or 0
    total += (ends := some.count())
    if not total:
        return {}
    found = [(r["w"].encode(), r["count"]) for r in counted.where(F.col("w") != "").where(F.col("count") * parts > total).collect()]
    found += [(_END, ends)] if ends * parts > total else []
    return {int(h): min(parts, math.ceil(c * parts / total)) for h, (_, c) in zip(hashed([w for w, _ in found]), found)}


def _blocks(docs: DataFrame, parts: int, slices: dict[int, int], id_col: str, text_col: str) -> DataFrame:
    """Rows of two kinds: documents (part null) and requests (part set)."""
    held = F.crc32(F.coalesce(docs[id_col].cast("string"), F.lit(""))) % 7 == 2

    def rows(name: str, part, ids, held_out, payload) -> pa.RecordBatch:
        n = len(payload)
        return pa.RecordBatch.from_arrays(
            [pa.array([name] * n), pa.array(part or [None] * n, pa.int32()), pa.array(ids or [None] * n, pa.string()), pa.array(held_out or [None] * n, pa.bool_()), pa.array(payload, pa.binary())],
            ["block", "part", "id", "held_out", "payload"],
        )

    def closed(block: Block, name: str) -> Iterator[pa.RecordBatch]:
        done, requests = block.close(parts, slices)
        for a in range(0, len(done), 1000):
            ids, held_out, payload = zip(*done[a : a + 1000])
            yield rows(name, None, list(ids), list(held_out), payload)
        part, payload = zip(*requests)
        yield rows(name, list(part), None, None, payload)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, n, block = TaskContext.get().partitionId(), 0, Block()
        for batch in batches:
            for key, held_out, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                block.add(key, held_out, text.as_py())
                if block.tokens >= BLOCK_TOKENS:
                    yield from closed(block, f"{task}-{n}")
                    n, block = n + 1, Block()
        if block.docs:
            yield from closed(block, f"{task}-{n}")

    # ids travel as text: data frames would turn integers with nulls into floats
    chosen = docs.select(docs[id_col].cast("string").alias("id"), held.alias("held_out"), text_of(docs, text_col).alias("t"))
    made = chosen.mapInArrow(run, "block string, part int, id string, held_out boolean, payload binary")
    return stored(made, "pitman-blocks")


def _messages(own: Part, part: int, parts: int, figures: list[float]) -> pd.DataFrame:
    """Keys and numbers for their owners; the figures travel with the first message."""
    one, two = (x.astype("<u4") for x in own.shared())
    owner = dealt(own.keys, parts)  # ascends with the key
    cut = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1], [True])))
    out = [(part, int(owner[a]), pack(own.keys[a:b], one[a:b], two[a:b], own.kind[a:b]), figures if a == 0 else []) for a, b in zip(cut, cut[1:])]
    return pd.DataFrame(out, columns=["part", "owner", "payload", "figures"])


def _owned(messages: DataFrame, name: str, model: Model | None) -> DataFrame:
    """Sums of each key for the parts that named it; one row without part holds the figures of an owner.

    Seats, messages of a part to itself, go through as they are.
    """

    def add_up(rows: pd.DataFrame) -> pd.DataFrame:
        if rows["owner"].iloc[0] < 0:
            return rows
        rows = rows.sort_values("part", kind="stable")
        got = [unpack(raw, "<u8", "<u4", "<u4", "u1") for raw in rows["payload"]]
        keys, at = np.unique(np.concatenate([g[0] for g in got]), return_inverse=True)
        one, two, word = (_bins(at, np.concatenate([g[k] for g in got]), len(keys)) for k in (1, 2, 3))
        tables, words = np.zeros(len(keys), dtype=np.int64), np.flatnonzero(word)
        tables[words] = np.minimum(two[words], 1)
        if model and len(words):
            rng, d = np.random.default_rng([int(rows["owner"].iloc[0]), 13]), model.discounts[2]
            base, others = np.full(len(words), 1 / (model.types + 1)), np.full(len(words), max(model.tables - 1, 0.0))
            tables[words] = py.draw_tables(two[words], base, others, d, py.stirling(d, py.EXACT), rng)
        sent = [f for f in rows["figures"] if len(f)]
        figures = list(np.sum(sent, axis=0)) if sent else [0.0] * 5
        figures += [*seen(two[words]), float(np.sum(one[words] > 0)), float(two[words].sum()), float(tables[words].sum())]
        owner, out, x = int(rows["owner"].iloc[0]), [], 0
        for part, g in zip(rows["part"], got):
            mine = at[x : x + len(g[0])]
            x += len(g[0])
            out.append((int(part), owner, pack(*(v[mine].astype("<u4") for v in (one, two, tables))), []))
        made = pd.DataFrame([*out, (None, owner, b"", [float(f) for f in figures])], columns=["part", "owner", "payload", "figures"])
        return made.astype({"part": "Int32"})

    with _shuffles_dropped(messages.sparkSession):
        return stored(messages.groupBy("owner").applyInPandas(add_up, _MESSAGE), name)


def _figures(sums: DataFrame) -> list[float]:
    picked = [F.coalesce(F.sum(F.col("figures")[k]), F.lit(0.0)) for k in range(10)]
    return list(sums.where("part is null").agg(*picked).first())


def _sums(rows: pd.DataFrame) -> list[np.ndarray]:
    mine = rows[rows["owner"] >= 0].sort_values("owner")
    return [np.concatenate(x) for x in zip(*(unpack(raw, "<u4", "<u4", "<u4") for raw in mine["payload"]))]


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    size = docs.agg(F.sum(F.octet_length(text_of(docs, text_col)))).first()[0] or 0
    parts = max(8, math.ceil(size / py.PART_BYTES))
    slices = _slices(docs, size, parts, text_col)
    blocks = _blocks(docs, parts, slices, id_col, text_col)
    asked = blocks.where("part is not null").select("part", "block", "payload")

    def gathered(rows: pd.DataFrame) -> tuple[Part, int, list[str]]:
        rows = rows.sort_values("block", kind="stable")
        return Part(list(rows["payload"]), slices), int(rows["part"].iloc[0]), list(rows["block"])

    def first_look(rows: pd.DataFrame) -> pd.DataFrame:
        own, part, _ = gathered(rows)
        return _messages(own, part, parts, [float(own.customers.sum()), *seen(own.customers), *seen(own.c2)])

    begun = _owned(asked.groupBy("part").applyInPandas(first_look, _MESSAGE), "pitman-first", None)
    tokens, *once, types, customers, tables = _figures(begun)
    discounts = tuple(py._discount(once[k : k + 2]) for k in (0, 2, 4))
    tokens, types = int(tokens), int(types)
    start = Model(tokens, types, discounts, customers, tables)

    logs = [py.stirling(d, py.EXACT) for d in discounts]

    def after_burn_in(rows: pd.DataFrame, sums: pd.DataFrame) -> pd.DataFrame:
        own, part, _ = gathered(rows)
        own.take(*_sums(sums))
        rng = np.random.default_rng([part, 11])
        for _ in range(py.BURN_IN):
            own.sweep(start, logs, rng)
        seats = pd.DataFrame([(part, -1 - part, own.seats(rng), [])], columns=["part", "owner", "payload", "figures"])
        return pd.concat([_messages(own, part, parts, [0.0] * 5), seats])

    def told(sums: DataFrame) -> DataFrame:
        return sums.where("part is not null").select("part", "owner", "payload")

    again = asked.groupBy("part").cogroup(told(begun).groupBy("part")).applyInPandas(after_burn_in, _MESSAGE)
    seated = _owned(again, "pitman-second", start)
    drop_stored(begun)
    customers, tables = _figures(seated)[-2:]
    model = Model(tokens, types, discounts, customers, tables)

    def answer(rows: pd.DataFrame, sums: pd.DataFrame) -> pd.DataFrame:
        own, part, names = gathered(rows)
        rng = own.seat(sums["payload"][sums["owner"] < 0].iloc[0])
        own.take(*_sums(sums))
        mean = np.zeros(len(own.customers))
        for _ in range(py.SAMPLES):
            own.sweep(model, logs, rng)
            mean += own.predict(model)[2] / py.SAMPLES
        scores, counts = np.log10(mean)[own.asked].astype("<f4"), own.counts[own.word][own.asked_bigrams].astype("<u4")
        out, x, y = [], 0, 0
        for name, n, fan in zip(names, own.sizes, own.fans):
            out.append((name, part, pack(scores[x : x + n], fan.astype("<u4"), counts[y : y + len(fan)])))
            x, y = x + n, y + len(fan)
        return pd.DataFrame(out, columns=["block", "part", "answer"])

    answers = asked.groupBy("part").cogroup(told(seated).groupBy("part")).applyInPandas(answer, "block string, part int, answer binary")

    def add_up(texts: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        score, base, known = [], [], []
        for raw in replies.sort_values("part")["answer"]:
            s, fan, counts = unpack(raw, "<f4", "<u4", "<u4")
            score.append(s.astype(np.float64))
            base.append(np.repeat(np.log10((counts + 1.0) / (tokens + types + 1)), fan))
            known.append(np.repeat(counts > 0, fan))
        score, base, known = map(np.concatenate, (score, base, known))
        out = []
        for raw in texts["payload"]:
            at = np.cumsum(unpack(raw, "<u4")[0], dtype=np.int64)
            out.append((len(at), int(known[at].sum()), tokens, float(base[at].sum()), float(score[at].sum())))
        names = ["n_tokens", "n_known", "train_tokens", "base_score", "score"]
        found = pd.DataFrame(out, columns=names, index=texts.index)
        return pd.concat([texts["id"].rename(id_col), texts["held_out"], found], axis=1)

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` string, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    texts = blocks.where("part is null").select("block", "id", "held_out", "payload")
    added = texts.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(add_up, schema)
    return added.withColumn(id_col, F.col(id_col).cast(kind))
