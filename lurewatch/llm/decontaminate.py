"""Benchmark decontamination by greedy string tiling.

Words (white space apart, A-Z lowered, punctuation at the ends removed) of every
benchmark item give seeds: runs of ``min_match`` words under a Karp-Rabin hash.
Documents meet the seeds by the same rolling hash, over the words that occur in
the benchmark at all. For a document and an item that share seeds, tiling marks
the longest common run, then the next longest that overlaps neither a marked word
of the document nor one of the item, until no run of ``min_match`` words is left.
The share of the item's words under tiles is its coverage, so passages whose
sentences were put in another order are found as well as whole ones. A long quote,
``QUOTED`` words in tiles of at least ``QUOTE``, counts under any share.

The benchmark is the query set: it is read in blocks of bounded size, each block is
broadcast, and one map-only pass over the documents meets all of it. Documents are
never shuffled, so a passage that a third of all documents share costs each of them
the same.

Null text is empty and matches nothing; so do null items. Items shorter than
``min_match`` words count only as a whole. Rows that repeat are judged one by one;
empty tables give empty results; columns besides ids and texts are not read
(``drop_contaminated`` hands them on). Texts are read whole.
"""

from __future__ import annotations

import heapq
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lurewatch.llm.bytebpe import Cache
from lurewatch.llm.common import text_of

MIN_MATCH = 5
#: Share of an item's words that must lie under tiles.
COVERAGE = 0.5
#: Words under tiles of at least QUOTE words that count whatever the item's length.
QUOTED, QUOTE = 50, 13
#: Bytes of benchmark text in a broadcast block, on average.
BLOCK_BYTES = 16 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_EDGES = re.compile(r"^[\W_]+|[\W_]+$")


def raw_words(text: str) -> list[bytes]:
    # on bytes: lower() changes A-Z only, split() cuts at the six ASCII spaces only
    return text.encode().lower().split()


def normal_words(text: str) -> list[str]:
    """Words that count; those without a letter or digit are left out."""
    return [w for w in (_EDGES.sub("", x.decode()) for x in raw_words(text)) if w]


def rolling(ids: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Karp-Rabin hash, modulo 2**64, of the runs of ``length`` ids that begin at ``at``."""
    value = np.zeros(len(at), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(length):
            x = ids[at + k].astype(np.uint64)
            value = value * _BASE + (x ^ (x >> np.uint64(7))) * np.uint64(0xC2B2AE3D27D4EB4F)
    return value


class Seeds:
    """One block of the benchmark: word ids, items as id arrays, seeds by length and hash."""

    def __init__(self, items: list[tuple[object, str]], min_match: int):
        self.words: dict[str, int] = {}
        self.names, self.items = [], []
        rows: dict[int, list[tuple[int, int]]] = {}
        for name, text in items:
            ids = [self.words.setdefault(w, len(self.words) + 1) for w in normal_words(text)]
            if not ids:
                continue
            length = min(min_match, len(ids))
            rows.setdefault(length, []).extend((len(self.items), p) for p in range(len(ids) - length + 1))
            self.names.append(name)
            self.items.append(np.asarray(ids, dtype=np.int64))
        self.tables = {}
        for length, places in rows.items():
            hashes = np.asarray(
                [rolling(self.items[i], np.asarray([p]), length)[0] for i, p in places], dtype=np.uint64
            )
            order = np.argsort(hashes, kind="stable")
            self.tables[length] = (hashes[order], np.asarray(places, dtype=np.int64)[order])

    def shared(self, ids: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(item, seed length, document positions, item positions) of the seeds that both hold."""
        known = np.concatenate(([0], np.cumsum(ids > 0)))
        for length, (hashes, places) in self.tables.items():
            if len(ids) < length:
                continue
            at = np.flatnonzero(known[length:] - known[:-length] == length)
            if not len(at):
                continue
            value = rolling(ids, at, length)
            first, last = np.searchsorted(hashes, value, "left"), np.searchsorted(hashes, value, "right")
            hit = np.flatnonzero(last > first)
            if not len(hit):
                continue
            n = last[hit] - first[hit]
            row = np.repeat(first[hit] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
            doc_at, found = np.repeat(at[hit], n), places[row]
            order = np.argsort(found[:, 0], kind="stable")
            doc_at, found = doc_at[order], found[order]
            bounds = np.flatnonzero(np.concatenate(([True], found[1:, 0] != found[:-1, 0], [True])))
            for a, b in zip(bounds, bounds[1:]):
                item, spots = int(found[a, 0]), found[a:b, 1]
                same = np.ones(b - a, dtype=bool)  # equal hashes are compared word by word
                for k in range(length):
                    same &= ids[doc_at[a:b] + k] == self.items[item][spots + k]
                if same.any():
                    yield item, length, doc_at[a:b][same], spots[same]


def tiles(doc_at: np.ndarray, item_at: np.ndarray, length: int) -> list[tuple[int, int, int]]:
    """Greedy tiling from all shared seeds: (document position, item position, words)."""
    order = np.lexsort((doc_at, doc_at - item_at))
    d, i = doc_at[order], item_at[order]
    breaks = np.flatnonzero(np.concatenate(([True], (np.diff(d) != 1) | (np.diff(i) != 1), [True])))
    runs = [(-(int(b - a) + length - 1), int(d[a]), int(i[a])) for a, b in zip(breaks, breaks[1:])]
    heapq.heapify(runs)
    doc_marks, item_marks, out = set(), set(), []
    while runs:
        size, x, y = heapq.heappop(runs)
        free = [x + k not in doc_marks and y + k not in item_marks for k in range(-size)]
        if all(free):
            out.append((x, y, -size))
            doc_marks.update(range(x, x - size))
            item_marks.update(range(y, y - size))
            continue
        start = None
        for k, ok in enumerate([*free, False]):
            if ok and start is None:
                start = k
            elif not ok and start is not None:
                if k - start >= length:
                    heapq.heappush(runs, (start - k, x + start, y + start))
                start = None
    return out


class Matcher:
    """Word ids of documents, with a bounded cache of words, against one block."""

    def __init__(self, seeds: Seeds, coverage: float):
        self.seeds, self.coverage = seeds, coverage
        self.ids = Cache(self._id)

    def _id(self, piece: bytes) -> int:
        """0: not in the benchmark; -1: no word."""
        raw = piece.decode()
        word = raw if raw.isalnum() else _EDGES.sub("", raw)
        return self.seeds.words.get(word, 0) if word else -1

    def find(self, text: str) -> list[tuple[object, float, int, int]]:
        """(item, coverage, tiles, longest tile) of each item that the text holds."""
        ids = np.fromiter(map(self.ids.__getitem__, raw_words(text)), dtype=np.int64)
        ids = ids[ids >= 0]
        out = []
        for item, length, doc_at, item_at in self.seeds.shared(ids):
            found = tiles(doc_at, item_at, length)
            covered = sum(n for _, _, n in found) / len(self.seeds.items[item])
            if covered >= self.coverage or sum(n for _, _, n in found if n >= QUOTE) >= QUOTED:
                out.append((self.seeds.names[item], covered, len(found), max(n for _, _, n in found)))
        return out


def benchmark_blocks(benchmark: DataFrame, min_match: int, id_col: str, text_col: str) -> Iterator[object]:
    """Broadcast blocks of the benchmark, each about BLOCK_BYTES of text."""
    spark = benchmark.sparkSession
    items = benchmark.select(benchmark[id_col].alias("id"), text_of(benchmark, text_col).alias("t"))
    total = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = max(1, math.ceil(total / BLOCK_BYTES))
    for block in range(n):
        rows = items.where(F.pmod(F.xxhash64("t"), F.lit(n)) == block).collect()
        if rows:
            yield spark.sparkContext.broadcast(Seeds([(r["id"], r["t"]) for r in rows], min_match))


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    min_match: int = MIN_MATCH,
    coverage: float = COVERAGE,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """One row for each document and item that it holds: id, item id, coverage, n_tiles, longest_tile."""
    kind, item_kind = docs.schema[id_col].dataType.simpleString(), benchmark.schema[item_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, `{item_col}` {item_kind}, coverage double, n_tiles int, longest_tile int"
    chosen = docs.select(docs[id_col].alias(id_col), text_of(docs, text_col).alias("t"))
    out = docs.sparkSession.createDataFrame([], schema)
    for block in benchmark_blocks(benchmark, min_match, item_col, item_text_col):

        def run(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(block.value, coverage)
            for batch in batches:
                rows, found = [], []
                for k, text in enumerate(batch.column(1)):
                    for hit in matcher.find(text.as_py()):
                        rows.append(k)
                        found.append(hit)
                if rows:
                    item, share, n, longest = zip(*found)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(rows)), pa.array(item), pa.array(share, pa.float64()), pa.array(n, pa.int32()), pa.array(longest, pa.int32())],
                        [id_col, item_col, "coverage", "n_tiles", "longest_tile"],
                    )

        out = out.unionByName(chosen.mapInArrow(run, schema))
    return out


def drop_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    min_match: int = MIN_MATCH,
    coverage: float = COVERAGE,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """The rows that hold no item, with all their columns."""
    place = docs.columns.index(text_col)
    for block in benchmark_blocks(benchmark, min_match, item_col, item_text_col):

        def run(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(block.value, coverage)
            for batch in batches:
                clean = [not matcher.find(t.as_py() or "") for t in batch.column(place)]
                yield batch.filter(pa.array(clean, pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
