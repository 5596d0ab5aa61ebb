"""Jaccard join of word shingles with adaptive multi-match prefixes.

A document is the set of its distinct runs of five words. All sets are sorted by one
order of shingles: those that come again and again inside single tasks' shares of the
corpus are frequent and come last (a sketch of fixed size sums their counts), others
by hash. Two sets with a Jaccard similarity of t or more share at least
``l`` shingles of their prefixes of length ``n - ceil(t n) + l``, for every l. A
longer prefix thus asks for more shared shingles, and each document chooses its l by
estimated cost: entries that its prefix meets, plus the sets that must be compared
if only those with l matches are.

1. Documents with equal sets become one node, named by half of a 128-bit hash of the
   sorted set. The other half is compared over all documents of a node; should it ever
   differ, the sets are hashed again with another seed.
2. Prefix shingles of the nodes are dealt by shingle and sorted; only entries whose
   shingle another node holds are kept. Shingles that the sketch takes for very
   frequent are dealt over several tasks.
3. Every node is compared with hubs of its shingles, if it meets one hub often enough;
   that is fewer comparisons than entries. The hub of a shingle is the node whose
   prefix others share most: of many variants of one text that is the least changed
   one, which is nearer to the others than they are to each other. Components of the
   links are formed, and groups of near copies, however large, collapse here.
4. What is left are pairs of nodes in different components. They are joined by
   shingle, counted, and those with enough matches are compared. So no pair that could
   add a link is left out, and no pair inside a component is formed.

A pair knows both its sizes and thus the smallest intersection ``c`` it needs; that is
more than ``ceil(t n)``. Its first ``l`` common shingles lie among the first
``n - c + l`` of either set, so step 4 joins only entries at those places: variants that
differ too much begin with shingles of their own and do not meet. In step 3 a pair of
prefixes of ``p`` and ``q`` shingles needs ``c - max(n - p, m - q)`` matches at least.

A node has a signature: 512 bits, each the parity of how many of its shingles fall to it.
Every bit that differs takes a shingle that only one of two sets holds, so sets whose
signatures differ in more than ``n + m - 2 c`` bits are not similar, and step 4 does
not join them. That keeps variants of one text, all a little too far from each other,
from meeting at every shingle that most of them share.

Comparison is exact on the 64-bit shingle hashes: 100 * intersection >= 75 * union.

Null and empty texts have no set and link with nothing: they are components of their
own. A text of fewer than five words is one shingle. Rows with equal ids count as
documents of their own that share a component id if their texts link; null ids never
name a component unless it has no other. An empty table gives an empty result;
columns besides id and text are not read. Texts are read whole.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from functools import reduce
from itertools import count
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lurewatch.llm.bytebpe import Cache
from lurewatch.llm.common import drop_stored, private, stored, text_of
from lurewatch.llm.components import components

WORDS, SIMILAR = 5, 75
#: Cells of the sketch: 16 MB to broadcast, whatever the input.
CELL_BITS = 22
#: Shingles that a task counts at a time, and the least count that makes one frequent.
CHUNK, FREQUENT = 2_000_000, 8
#: Matches that a document may ask for; each more is a row more for every pair that meets.
LEVELS = (1, 2, 3)
#: Share of shingles assumed to be held by one more document than the sketch can tell.
PRIOR = 0.02
#: Shingles estimated above this many documents are dealt over several tasks.
HOT = 20_000
#: Bits of a signature, and the columns of 64 of them each.
SIGN_BITS = 512
SIGNS = [f"s{k}" for k in range(SIGN_BITS // 64)]
_BLOCK = 1 << 16
_BASE = np.uint64(0x9E3779B97F4A7C15)


class Shingler:
    """Sorted distinct shingle hashes of a text; word hashes are kept in a bounded cache."""

    def __init__(self, words: int = WORDS):
        import xxhash

        self.words, self.known = words, Cache(xxhash.xxh3_64_intdigest, 150_000)

    def __call__(self, text: str) -> np.ndarray:
        # on bytes: lower() changes A-Z only, split() cuts at the six ASCII spaces only
        found = text.encode().lower().split()
        h = np.fromiter(map(self.known.__getitem__, found), dtype=np.uint64, count=len(found))
        if not len(h):
            return h
        k = min(self.words, len(h))
        value = np.full(len(h) - k + 1, k, dtype=np.uint64)
        for j in range(k):
            value = value * _BASE + h[j : len(h) - k + 1 + j]
        value ^= value >> np.uint64(29)
        value *= np.uint64(0xBF58476D1CE4E5B9)
        value ^= value >> np.uint64(32)
        return np.unique(value)


def _cell(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def set_key(shingles: np.ndarray, seed: int = 0) -> tuple[int, int]:
    """Key of a set's node, and a second hash that tells sets of one key apart; both signed."""
    import xxhash

    return struct.unpack("<qq", xxhash.xxh3_128_digest(shingles.tobytes(), seed))


def signature(shingles: np.ndarray) -> np.ndarray:
    """Parity of the shingles that fall to each bit."""
    bit = shingles >> np.uint64(65 - SIGN_BITS.bit_length())
    odd = np.bincount(bit.astype(np.int64), minlength=SIGN_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _needed(n: int) -> int:
    """Smallest possible intersection of a set of n with a similar one."""
    return -(-SIMILAR * n // 100)


# ---- documents and sketch ---------------------------------------------------


def _documents(docs: DataFrame, id_col: str, text_col: str, seed: int = 0) -> DataFrame:
    """id, text_hash, n, g (key of the set), h (its second hash), signature of each row, and the tasks' sketches: block, cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, cells, seen = Shingler(), np.zeros(1 << CELL_BITS, dtype=np.int32), set()
        held, size = [], 0
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                some = batch.slice(start, 500)
                found = [shingles(text.as_py()) for text in some.column(2)]
                keys = [set_key(s, seed) if len(s) else None for s in found]
                for key, s in zip(keys, found):
                    if key is not None and key not in seen:
                        seen.add(key)
                        held.append(s)
                        size += len(s)
                if size >= CHUNK:
                    _add_repeated(cells, held)
                    held, size, seen = [], 0, set()
                none = [None] * len(found)
                yield rows(some.column(0), some.column(1), list(map(len, found)), keys, none, none, np.stack(list(map(signature, found))))
        _add_repeated(cells, held)
        parts = [(k, p) for k, p in enumerate(cells.reshape(-1, _BLOCK)) if p.any()]
        if parts:
            none, blocks, raw = [None] * len(parts), [k for k, _ in parts], [p.astype("<i4").tobytes() for _, p in parts]
            signs = np.zeros((len(parts), len(SIGNS)), dtype=np.int64)
            yield rows(pa.nulls(len(parts), id_type), pa.nulls(len(parts), pa.int64()), none, none, blocks, raw, signs)

    def rows(ids, hashes, n, keys, blocks, cells, signs) -> pa.RecordBatch:
        g, h = (pa.array([k and k[i] for k in keys], pa.int64()) for i in (0, 1))
        return pa.RecordBatch.from_arrays(
            [ids, hashes, pa.array(n, pa.int64()), g, h, pa.array(blocks, pa.int32()), pa.array(cells, pa.binary())]
            + [pa.array(np.ascontiguousarray(column)) for column in signs.T],
            ["id", "text_hash", "n", "g", "h", "block", "cells", *SIGNS],
        )

    from pyspark.sql.pandas.types import to_arrow_type

    id_type = to_arrow_type(docs.schema[id_col].dataType)
    kind = docs.schema[id_col].dataType.simpleString()
    text = text_of(docs, text_col)
    chosen = docs.select(docs[id_col].alias("id"), F.xxhash64(text).alias("h"), text.alias("t"))
    signs = ", ".join(f"{s} long" for s in SIGNS)
    return stored(chosen.mapInArrow(run, f"id {kind}, text_hash long, n long, g long, h long, block int, cells binary, {signs}"), "jaccard-documents")


def _nodes(rows: DataFrame) -> DataFrame:
    """g, id (smallest of its documents), clash (whether different sets share the key)."""
    sets = rows.where("g is not null").groupBy("g")
    return sets.agg(F.min("id").alias("id"), (F.min("h") != F.max("h")).alias("clash"))


def _add_repeated(cells: np.ndarray, sets: list[np.ndarray]) -> None:
    """Count the shingles that several of the sets hold."""
    if sets:
        found = np.concatenate(sets)
        found.sort()
        starts = np.flatnonzero(np.concatenate(([True], found[1:] != found[:-1])))
        n = np.diff(starts, append=len(found)).astype(np.int32)
        np.add.at(cells, _cell(found[starts[n > 1]]), n[n > 1])


def _sum_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
            value = np.frombuffer(raw.as_py(), dtype="<i4")
            sums[block] = sums[block] + value if block in sums else value
    if sums:
        values = pa.array([v.tobytes() for v in sums.values()], pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(sums, pa.int32()), values], ["block", "cells"])


def _sketch(rows: DataFrame) -> np.ndarray:
    """Estimated documents of the shingles of each cell: one, unless it stands out as frequent."""
    parts = rows.where("block is not null").select("block", "cells")
    n = (1 << CELL_BITS) // _BLOCK
    for salt in (F.floor(F.rand(7) * 16), F.lit(0)):
        parts = parts.repartition(n, "block", salt).mapInArrow(_sum_cells, "block int, cells binary")
    cells = np.zeros(1 << CELL_BITS, dtype=np.int32)
    for row in parts.collect():  # 2**CELL_BITS numbers in all
        cells[row["block"] * _BLOCK : (row["block"] + 1) * _BLOCK] = np.frombuffer(row["cells"], dtype="<i4")
    return np.where(cells >= FREQUENT + 2 * cells.mean(), cells, 1).astype(np.int32)


# ---- prefixes ---------------------------------------------------------------


def prefix(shingles: np.ndarray, estimates: np.ndarray) -> tuple[np.ndarray, int]:
    """Prefix shingles in their order, and the document's level."""
    n = len(shingles)
    df = estimates[_cell(shingles)]
    order = np.argsort(np.floor(np.log2(df)), kind="stable")  # within a class by hash
    base = n - _needed(n)  # one less than the prefix of level 1
    held = np.cumsum(df[order].astype(np.float64))
    best, cost = 1, None
    for level in LEVELS:
        if level > _needed(n):
            break
        size = base + level
        compared = (held[size - 1] - size + PRIOR * size) / level
        total = held[size - 1] + compared * n
        if cost is None or total < cost:
            best, cost = level, total
    return shingles[order[: base + best]], best


def _prefixes(docs: DataFrame, estimates: np.ndarray, text_col: str, seed: int) -> DataFrame:
    """token, g, n, pos (place of the token in the prefix), level, salt."""
    shared = docs.sparkSession.sparkContext.broadcast(estimates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, estimates, seen = Shingler(), shared.value, set()
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                tokens, pos, keys, sizes, levels, salts = [], [], [], [], [], []
                for text in batch.column(0).slice(start, 500):
                    s = shingles(text.as_py())
                    if not len(s) or (key := set_key(s, seed)[0]) in seen:
                        continue
                    if len(seen) >= 1_000_000:
                        seen.clear()
                    seen.add(key)
                    token, level = prefix(s, estimates)
                    tokens.append(token)
                    pos.append(np.arange(len(token), dtype=np.int32))
                    keys.append(np.full(len(token), key, dtype=np.int64))
                    sizes.append(np.full(len(token), len(s), dtype=np.int64))
                    levels.append(np.full(len(token), level, dtype=np.int8))
                    parts = estimates[_cell(token)] // HOT + 1
                    salts.append(((key & 0xFFFFFF) % parts).astype(np.int32))
                if tokens:
                    cat = np.concatenate
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(cat(tokens).view(np.int64)), pa.array(cat(keys)), pa.array(cat(sizes)), pa.array(cat(pos)), pa.array(cat(levels)), pa.array(cat(salts))],
                        ["token", "g", "n", "pos", "level", "salt"],
                    )

    schema = "token long, g long, n long, pos int, level tinyint, salt int"
    return docs.select(text_of(docs, text_col)).mapInArrow(run, schema)


def _kept(shared, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of entries sorted by token and node: one for each node, if the token has another node or is hot."""
    hot, held = shared.value, None

    def edge(table: pa.Table, final: bool) -> tuple[pa.Table, pa.Table]:
        token, g = table["token"].to_numpy(), table["g"].to_numpy()
        same_token = np.concatenate(([False], token[1:] == token[:-1]))
        again = same_token.copy()
        again[1:] &= g[1:] == g[:-1]
        table, token, same = table.filter(pa.array(~again)), token[~again], same_token[~again]
        other = same.copy()
        other[:-1] |= same[1:]
        other |= hot[_cell(token.view(np.uint64))] >= HOT
        other |= table["more"].to_numpy(zero_copy_only=False)
        if final:
            return table.filter(pa.array(other)), None
        # the last entry waits for the next batch, and knows whether its token had another
        last = table.slice(len(table) - 1)
        last = last.set_column(last.column_names.index("more"), "more", pa.array([bool(other[-1])]))
        return table.slice(0, len(table) - 1).filter(pa.array(other[:-1])), last

    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = table.append_column("more", pa.array(np.zeros(len(table), dtype=bool)))
        if held is not None:
            table = pa.concat_tables([held, table])
        out, held = edge(table, False)
        yield from out.drop_columns(["more"]).combine_chunks().to_batches()
    if held is not None:
        yield from edge(held, True)[0].drop_columns(["more"]).combine_chunks().to_batches()


def _entries(docs: DataFrame, estimates: np.ndarray, text_col: str, seed: int) -> DataFrame:
    """token, g, n, pos, level, share (thousandths of the prefix that other nodes hold too)."""
    shared = docs.sparkSession.sparkContext.broadcast(estimates)
    dealt = _prefixes(docs, estimates, text_col, seed).repartition("token", "salt").sortWithinPartitions("token", "g")
    kept = dealt.drop("salt").mapInArrow(lambda b: _kept(shared, b), "token long, g long, n long, pos int, level tinyint")
    entries = stored(kept, "jaccard-entries")
    # a node needs as many shared shingles as some level asks for
    counts = [F.count_if(F.expr(f"pos < {_place('n', str(level))}")).alias(f"m{level}") for level in LEVELS]
    able = reduce(or_, [(F.col("level") >= level) & (F.col(f"m{level}") >= level) for level in LEVELS])
    share = F.expr(f"cast(1000 * held div {_place('n', 'level')} as int)").alias("share")
    nodes = entries.groupBy("g", "n", "level").agg(F.count(F.lit(1)).alias("held"), *counts).where(able).select("g", share)
    kept = stored(entries.join(nodes, "g"), "jaccard-able")
    drop_stored(entries)
    return kept


# ---- pairs ------------------------------------------------------------------


def _place(n: str, level: str) -> str:
    """SQL: length of the prefix of a set of n at a level."""
    return f"({n} - ({SIMILAR} * {n} + 99) div 100 + {level})"


def _common(n: str, m: str) -> str:
    """SQL: smallest intersection of similar sets of n and m."""
    return f"(({SIMILAR} * ({n} + {m}) + {99 + SIMILAR}) div {100 + SIMILAR})"


def _sizes_fit(a: str, b: str) -> str:
    return f"100 * least({a}, {b}) >= {SIMILAR} * greatest({a}, {b})"


def _hub_pairs(entries: DataFrame) -> DataFrame:
    """Each node with the hub of each of its tokens: a < b."""
    hub = F.struct((-F.col("share")).alias("last"), F.col("g").alias("hub"), F.col("n").alias("hub_n"), F.col("level").alias("hub_level"))
    hubs = entries.groupBy("token").agg(F.min(hub).alias("x")).select("token", "x.*")
    met = entries.join(hubs, "token").where(f"g <> hub and {_sizes_fit('n', 'hub_n')}")
    behind = f"greatest(n - {_place('n', 'level')}, hub_n - {_place('hub_n', 'hub_level')})"
    need = F.expr(f"greatest({_common('n', 'hub_n')} - {behind}, least(level, hub_level))")
    pairs = met.groupBy(F.least("g", "hub").alias("a"), F.greatest("g", "hub").alias("b"), need.alias("need"))
    # pairs that meet too seldom at hubs are left to the last step, which counts all matches
    return _enough(pairs)


def _enough(pairs) -> DataFrame:
    return pairs.agg(F.count(F.lit(1)).alias("matches")).where("matches >= need").select("a", "b")


def _rest_pairs(entries: DataFrame, labels: DataFrame, rows: DataFrame) -> DataFrame:
    """Pairs in different components with the matches that the smaller of their levels asks for."""
    signed = rows.where("g is not null").groupBy("g").agg(*[F.min(s).alias(s) for s in SIGNS])
    nodes = signed.join(labels.withColumnRenamed("u", "g"), "g", "left").withColumn("c", F.coalesce("c", "g"))
    named = entries.join(nodes, "g")
    mixed = named.groupBy("token").agg(F.min("c").alias("c0"), F.max("c").alias("c1")).where("c0 <> c1").select("token")
    open_ = named.join(mixed, "token", "left_semi")
    x = open_.select("token", *[F.col(k).alias(f"{k}_a") for k in ("g", "n", "pos", "level", "c", *SIGNS)])
    y = open_.select("token", *[F.col(k).alias(f"{k}_b") for k in ("g", "n", "pos", "level", "c", *SIGNS)])
    level, common = "least(level_a, level_b)", _common("n_a", "n_b")
    apart = " + ".join(f"bit_count({s}_a ^ {s}_b)" for s in SIGNS)
    pairs = (
        x.join(y, "token")
        .where(f"g_a < g_b and c_a <> c_b and {_sizes_fit('n_a', 'n_b')}")
        .where(f"pos_a < n_a - {common} + {level} and pos_b < n_b - {common} + {level}")
        .where(f"{apart} <= n_a + n_b - 2 * {common}")
        .groupBy(F.col("g_a").alias("a"), F.col("g_b").alias("b"), F.expr(level).alias("need"))
    )
    return _enough(pairs)


def _sets(docs: DataFrame, reps: DataFrame, id_col: str, text_col: str, seed: int) -> DataFrame:
    """g, s (shingles) of the wanted nodes, and of a few others; some may come twice.

    reps: id, g. Only rows that a bitmap of the wanted ids lets through are shingled.
    """
    from lurewatch.llm.exact_dedup import FILTER_BITS, maybe_in

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, seen = Shingler(), set()
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                found = {}
                for text in batch.column(0).slice(start, 500):
                    s = shingles(text.as_py())
                    if len(s) and (key := set_key(s, seed)[0]) not in seen:
                        found[key] = s.view(np.int64)
                if len(seen) >= 1_000_000:
                    seen.clear()
                seen.update(found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found, pa.int64()), pa.array(found.values(), pa.list_(pa.int64()))], ["g", "s"]
                )

    rows = docs.select(docs[id_col].alias("id"), text_of(docs, text_col).alias("t"))
    near = maybe_in(rows, reps.select("id"), "id", FILTER_BITS)
    return near.select("t").mapInArrow(run, "g long, s array<bigint>")


def _linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs whose sets are similar: u, v."""
    first = pairs.join(sets.select(F.col("g").alias("a"), F.col("s").alias("s_a")), "a")
    both = first.join(sets.select(F.col("g").alias("b"), F.col("s").alias("s_b")), "b")
    same = F.size(F.array_intersect("s_a", "s_b"))
    return (
        both.select("a", "b", same.alias("i"), (F.size("s_a") + F.size("s_b")).alias("n"))
        .where(f"100 * i >= {SIMILAR} * (n - i)")
        .select(F.col("a").alias("u"), F.col("b").alias("v"))
        .distinct()
    )


def _links(docs: DataFrame, pairs: DataFrame, reps: DataFrame, id_col: str, text_col: str, seed: int) -> DataFrame:
    wanted = pairs.select(F.col("a").alias("g")).union(pairs.select(F.col("b").alias("g"))).distinct()
    sets = stored(_sets(docs, wanted.join(reps, "g"), id_col, text_col, seed), "jaccard-sets")
    links = stored(_linked(pairs, sets), "jaccard-links")
    drop_stored(sets)
    return links


# ---- join -------------------------------------------------------------------


def similar_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_shingles, component_id (smallest id reachable by links), text_hash."""
    # whole texts go to Python a thousand at a time, not ten thousand
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 1000)
    for seed in count():
        rows = _documents(docs, id_col, text_col, seed)
        reps = stored(_nodes(rows), "jaccard-nodes")
        if reps.where("clash").isEmpty():
            break
        drop_stored(rows)
        drop_stored(reps)
    reps = reps.drop("clash")
    table = rows.where("block is null").select("id", "text_hash", "n", "g")
    entries = _entries(docs, _sketch(rows), text_col, seed)
    near_hubs = stored(_hub_pairs(entries), "jaccard-pairs")
    edges = _links(docs, near_hubs, reps, id_col, text_col, seed)
    rest = stored(_rest_pairs(entries, components(edges), rows).join(near_hubs, ["a", "b"], "left_anti"), "jaccard-pairs")
    drop_stored(entries)
    labels = components(edges.union(_links(docs, rest, reps, id_col, text_col, seed)))
    named = reps.join(labels.withColumnRenamed("u", "g"), "g", "left").withColumn("c", F.coalesce("c", "g"))
    lowest = named.groupBy("c").agg(F.min("id").alias("component_id"))
    by_set = named.join(lowest, "c").select("g", "component_id")
    out = table.join(by_set, "g", "left")
    return out.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("g").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
        "text_hash",
    )


def drop_similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that have the smallest id of their component, with all their columns."""
    found = similar_groups(docs, id_col, text_col)
    kept = found.where(F.col(id_col).eqNullSafe(F.col("component_id")))
    kept = kept.select(F.col(id_col).alias("kept_id"), F.col("text_hash").alias("kept_hash"))
    own = private(docs, "own_hash")
    named = docs.withColumn(own, F.xxhash64(text_of(docs, text_col)))
    same = named[id_col].eqNullSafe(kept["kept_id"]) & (named[own] == kept["kept_hash"])
    return named.join(kept, same, "left_semi").drop(own)
