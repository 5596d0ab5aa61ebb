"""Token ids in raw shard files with a minimal perfect hash index.

Documents are range-partitioned and sorted by id; each task encodes its share and
streams it into one shard file. An index maps each document key to its place:
keys are dealt to index parts by hash, and every part holds a minimal perfect hash
(hash and displace: a pilot for each bucket of keys sends them to free slots, so n
keys fill n slots), a 32-bit fingerprint for each slot that turns unknown keys
away, and the postings (shard, first record, copies). A lookup reads one bucket,
one slot and one posting, then seeks in the shard.

Files, all little-endian. Shard: payload (ids of ``width`` bytes), the records' token
offsets (u8, one more than records), then a footer: magic, width, records, tokens.
Part: header (magic, keys, buckets, postings), pilots u4, fingerprints u4, posting
starts u4 (one more than keys), shard u4, first record u8, copies u8.
Tasks write under a name of their own and rename when complete, so a task that
runs again after a lost executor leaves the same file.

Null text is empty: its record holds the end id alone. Rows that repeat an id stand
side by side (ordered by a hash of their text) and share one key; null ids come
first under a key of their own. An empty table gives no shards and an empty
result. Columns besides id and text are not read.
"""

from __future__ import annotations

import gc
import math
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lurewatch.functions.batches import flat, pieces
from lurewatch.llm.bytebpe import PIECE, Cache
from lurewatch.llm.common import stored, text_of, work_path

END_ID = 2
#: Bytes of text encoded at once; a longer text goes alone.
TEXT_BYTES = 1 << 21
#: Keys that an index part holds on average.
PART_KEYS = 8192
_BUCKET_KEYS = 4
#: Slots looked at in one step of the search for pilots.
_TRIALS = 1 << 14
_DIRECT = 0x80000000
_SHARD_MAGIC, _PART_MAGIC = b"LWSHARD1", b"LWINDEX1"
_FOOTER, _HEADER = "<8sIIQQ", "<8sIII"
_MIX = np.uint64(0x9E3779B97F4A7C15)
NULL_KEY = b"\x00null"


# ---- encoding -------------------------------------------------------------


class LibraryEncoder:
    """Ids of whole texts from the tokenizers library.

    The library encodes each piece that no merge or look-ahead crosses; pieces
    repeat, so a batch hands it only those that the worker does not hold yet.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.width = 2 if self.library.get_vocab_size() <= 1 << 16 else 4
        self.kind = f"<u{self.width}"
        self.specials = {t.content for t in self.library.get_added_tokens_decoder().values()}
        self.end = np.asarray([END_ID], dtype=self.kind).tobytes()
        self.known = Cache(lambda piece: self._many([piece])[0])

    def _many(self, pieces: list[str]) -> list[bytes]:
        coded = self.library.encode_batch_fast(pieces, add_special_tokens=False)
        return [np.asarray(c.ids, dtype=self.kind).tobytes() for c in coded]

    def batch(self, texts: list[str]) -> list[bytes]:
        # no cycles are made here; a collection would walk the lists of pieces again and again
        collects = gc.isenabled()
        gc.disable()
        try:
            return self._batch(texts)
        finally:
            if collects:
                gc.enable()

    def _batch(self, texts: list[str]) -> list[bytes]:
        get = self.known.get
        split = [None if any(s in t for s in self.specials) else PIECE.findall(t) for t in texts]
        coded = [list(map(get, pieces or ())) for pieces in split]
        gaps = [[i for i, c in enumerate(ids) if c is None] for ids in coded]
        wanted = {pieces[i] for pieces, own in zip(split, gaps) for i in own}
        found = {p: c for p in wanted if (c := self.known.old.get(p)) is not None}
        new = [p for p in wanted if p not in found]
        found.update(zip(new, self._many(new)))
        for pieces, ids, own in zip(split, coded, gaps):
            for i in own:
                ids[i] = found[pieces[i]]
        self.known.room(len(found))
        self.known.update(found)
        return [
            (self._many([t])[0] if pieces is None else b"".join(ids)) + self.end
            for t, pieces, ids in zip(texts, split, coded)
        ]


@lru_cache(maxsize=2)
def encoder(path: str) -> LibraryEncoder:
    return LibraryEncoder(path)


# ---- minimal perfect hash -------------------------------------------------


def key_bytes(key: object) -> bytes:
    return NULL_KEY if key is None or key is pd.NA else str(key).encode()


def key_hashes(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    import xxhash

    both = b"".join(xxhash.xxh3_128_digest(k) for k in keys)
    pairs = np.frombuffer(both, dtype="<u8").reshape(-1, 2)
    return pairs[:, 0], pairs[:, 1]


def _slot(hashes: np.ndarray, pilots: np.ndarray, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = hashes + pilots.astype(np.uint64) * _MIX
        x = (x ^ (x >> np.uint64(32))) * _MIX
        return (x ^ (x >> np.uint64(29))) % np.uint64(n)


def build_hash(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pilots by bucket, and the slot of each key; the n keys fill slots 0..n-1."""
    n = len(low)
    buckets = max(1, math.ceil(n / _BUCKET_KEYS))
    of = (low % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(of, kind="stable")
    sizes = np.bincount(of, minlength=buckets)
    starts = np.concatenate(([0], np.cumsum(sizes)))
    pilots, slots = np.zeros(buckets, dtype=np.uint32), np.zeros(n, dtype=np.int64)
    taken = np.zeros(n, dtype=bool)
    by_key = np.lexsort((high, low))
    if ((low[by_key][1:] == low[by_key][:-1]) & (high[by_key][1:] == high[by_key][:-1])).any():
        raise ValueError("keys must differ")
    # buckets of one size look for their pilots together, the largest first
    for size in range(int(sizes.max(initial=0)), 1, -1):
        left = np.flatnonzero(sizes == size)
        first = np.zeros(len(left), dtype=np.uint64)
        while len(left):
            members = order[starts[left][:, None] + np.arange(size)]
            trial = first[:, None] + np.arange(max(1, min(256, _TRIALS // (size * len(left)))), dtype=np.uint64)
            at = _slot(high[members][:, None, :], trial[:, :, None], n).astype(np.int64)
            apart = np.sort(at, axis=2)
            good = ~taken[at].any(axis=2) & (apart[:, :, 1:] != apart[:, :, :-1]).all(axis=2)
            found, which = good.any(axis=1), np.argmax(good, axis=1)
            here = np.flatnonzero(found)
            at = at[here, which[here]]
            # of buckets that want the same slot the first gets it
            owner = np.zeros(n, dtype=np.int64)
            owner[at[::-1]] = here[::-1, None]
            won = (owner[at] == here[:, None]).all(axis=1)
            done, at = here[won], at[won]
            pilots[left[done]] = trial[done, which[done]]
            slots[members[done]] = at
            taken[at] = True
            first = np.where(found, trial[np.arange(len(left)), which], trial[:, -1]) + np.uint64(1)
            rest = np.ones(len(left), dtype=bool)
            rest[done] = False
            left, first = left[rest], first[rest]
    # buckets of one key name a free slot outright
    single = np.flatnonzero(sizes == 1)
    free = np.flatnonzero(~taken)
    members = order[starts[single]]
    slots[members] = free[: len(single)]
    pilots[single] = (free[: len(single)] | _DIRECT).astype(np.uint32)
    return pilots, slots


def find_slots(low: np.ndarray, high: np.ndarray, pilots: np.ndarray, n: int) -> np.ndarray:
    pilot = pilots[(low % np.uint64(len(pilots))).astype(np.int64)]
    hashed = _slot(high, pilot, n).astype(np.int64)
    return np.where(pilot & np.uint32(_DIRECT), (pilot & np.uint32(_DIRECT - 1)).astype(np.int64), hashed)


def _fingerprints(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    return ((low ^ (high << np.uint64(1))) >> np.uint64(32)).astype("<u4")


# ---- files ----------------------------------------------------------------


def _open(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder)


class _Writer:
    """A file that appears under its name when it is complete."""

    def __init__(self, folder: str, name: str):
        self.fs, root = _open(folder)
        self.fs.create_dir(root, recursive=True)
        self.to, self.own = f"{root}/{name}", f"{root}/.{name}-{uuid.uuid4().hex}"
        self.out = self.fs.open_output_stream(self.own)

    def close(self) -> None:
        self.out.close()
        self.fs.move(self.own, self.to)


class Shard:
    def __init__(self, folder: str, shard: int):
        fs, root = _open(folder)
        self.file = fs.open_input_file(f"{root}/shard-{shard:06d}")
        end = self.file.size()
        magic, self.width, _, self.records, self.tokens = struct.unpack(
            _FOOTER,
            self.file.read_at(struct.calcsize(_FOOTER), end - struct.calcsize(_FOOTER))
        )
        if magic != _SHARD_MAGIC:
            raise ValueError(f"shard {shard} is not a shard file")
        size = 8 * (self.records + 1)
        self.offsets = np.frombuffer(self.file.read_at(size, end - struct.calcsize(_FOOTER) - size), dtype="<u8")

    def ids(self, record: int) -> np.ndarray:
        first, last = int(self.offsets[record]), int(self.offsets[record + 1])
        raw = self.file.read_at((last - first) * self.width, first * self.width)
        return np.frombuffer(raw, dtype=f"<u{self.width}")


class IndexPart:
    def __init__(self, folder: str, part: int):
        fs, root = _open(folder)
        with fs.open_input_file(f"{root}/index-{part:06d}") as file:
            raw = file.read()
        magic, self.keys, buckets, postings = struct.unpack_from(_HEADER, raw)
        if magic != _PART_MAGIC:
            raise ValueError(f"part {part} is not an index file")
        at = struct.calcsize(_HEADER)
        arrays = []
        for kind, n in (("<u4", buckets), ("<u4", self.keys), ("<u4", self.keys + 1), ("<u4", postings), ("<u8", postings), ("<u8", postings)):
            arrays.append(np.frombuffer(raw, dtype=kind, count=n, offset=at))
            at += arrays[-1].nbytes
        self.pilots, self.prints, self.starts, self.shards, self.firsts, self.copies = arrays

    def find(self, keys: list[bytes]) -> np.ndarray:
        """Slot of each key, -1 where the fingerprint differs."""
        low, high = key_hashes(keys)
        slots = find_slots(low, high, self.pilots, self.keys)
        return np.where(self.prints[slots] == _fingerprints(low, high), slots, -1)


def write_part(folder: str, part: int, rows: pd.DataFrame) -> int:
    """rows: key, shard, first, copies, in order of key and shard."""
    starts = np.flatnonzero(np.concatenate(([True], rows["key"].values[1:] != rows["key"].values[:-1])))
    low, high = key_hashes([bytes(k) for k in rows["key"].values[starts]])
    pilots, slots = build_hash(low, high)
    sizes = np.diff(np.concatenate((starts, [len(rows)])))
    by_slot = np.argsort(slots)
    take = np.concatenate([np.arange(starts[k], starts[k] + sizes[k]) for k in by_slot])
    arrays = [
        pilots.astype("<u4"), _fingerprints(low, high)[by_slot],
        np.concatenate(([0], np.cumsum(sizes[by_slot]))).astype("<u4"),
        rows["shard"].values[take].astype("<u4"), rows["first"].values[take].astype("<u8"),
        rows["copies"].values[take].astype("<u8"),
    ]
    file = _Writer(folder, f"index-{part:06d}")
    file.out.write(struct.pack(_HEADER, _PART_MAGIC, len(starts), len(pilots), len(rows)))
    for a in arrays:
        file.out.write(a.tobytes())
    file.close()
    return len(starts)


# ---- jobs -----------------------------------------------------------------


@dataclass(frozen=True)
class Store:
    folder: str
    parts: int
    #: Tokens before each shard; a number for each file.
    bases: dict[int, int]


def _key(column: Column) -> Column:
    return F.coalesce(F.encode(column.cast("string"), "UTF-8"), F.lit(NULL_KEY))


def _part(key: Column, parts: int) -> Column:
    return F.pmod(F.crc32(key), F.lit(parts)).cast("int")


def write_store(
    docs: DataFrame, path: str, shards: int | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> Store:
    spark = docs.sparkSession
    folder = work_path(spark, "token-store")
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = text_of(docs, text_col)
    ordered = (
        docs.select(docs[id_col].alias("id"), F.xxhash64(text).alias("tie"), text.alias("text"))
        .repartitionByRange(shards, F.col("id").asc_nulls_first(), "tie")
        .sortWithinPartitions(F.col("id").asc_nulls_first(), "tie")
        .select(_key(F.col("id")).alias("key"), "text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, own = TaskContext.get().partitionId(), encoder(path)
        file, counts, held = None, [], None
        entry = lambda k, first, n: (k, first, n)
        for batch in batches:
            done = []
            for first, last in pieces(flat(batch.column(1))[1], TEXT_BYTES):
                rows = batch.slice(first, last - first)
                file = file or _Writer(folder, f"shard-{shard:06d}")
                for key, ids in zip(rows.column(0).to_pylist(), own.batch(rows.column(1).to_pylist())):
                    if held is not None and held[0] == key:
                        held = entry(key, held[1], held[2] + 1)
                    else:
                        done += [held] if held else []
                        held = entry(key, len(counts), 1)
                    file.out.write(ids)
                    counts.append(len(ids) // own.width)
            if done:
                yield _rows(shard, done)
        if file is None:
            return
        offsets = np.concatenate(([0], np.cumsum(counts))).astype("<u8")
        file.out.write(offsets.tobytes())
        file.out.write(struct.pack(_FOOTER, _SHARD_MAGIC, own.width, 0, len(counts), int(offsets[-1])))
        file.close()
        yield _rows(shard, [held])
        # one row for the whole shard: no key, its tokens as first
        yield _rows(shard, [(None, int(offsets[-1]), 0)])

    def _rows(shard: int, rows: list) -> pa.RecordBatch:
        keys, firsts, copies = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.binary()), pa.array([shard] * len(rows), pa.int32()), pa.array(firsts, pa.int64()), pa.array(copies, pa.int64())],
            ["key", "shard", "first", "copies"],
        )

    entries = stored(ordered.mapInArrow(run, "key binary, shard int, first long, copies long"), "store-entries")
    totals = sorted((r["shard"], r["first"]) for r in entries.where("key is null").collect())
    bases, before = {}, 0
    for shard, tokens in totals:
        bases[shard], before = before, before + tokens
    keyed = entries.where("key is not null")
    parts = max(1, math.ceil(keyed.count() / PART_KEYS))

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        part = int(rows["part"].iloc[0])
        rows = rows.sort_values(["key", "shard"], kind="stable")
        return pd.DataFrame({"part": [part], "keys": [write_part(folder, part, rows)]})

    built = keyed.withColumn("part", _part(F.col("key"), parts)).groupBy("part").applyInPandas(build, "part int, keys long")
    built.agg(F.sum("keys")).collect()
    return Store(folder, parts, bases)


def look_up(keys: DataFrame, store: Store, id_col: str = "doc_id") -> DataFrame:
    """Places of each distinct key that the index holds: id, shard, first, copies."""
    kind, folder = keys.schema[id_col].dataType.simpleString(), store.folder

    def find(rows: pd.DataFrame) -> pd.DataFrame:
        part = IndexPart(folder, int(rows["part"].iloc[0]))
        slots = part.find([bytes(k) for k in rows["key"]])
        ids = rows[id_col].array[slots >= 0]
        slots = slots[slots >= 0]
        begin, end = part.starts[slots].astype(np.int64), part.starts[slots + 1].astype(np.int64)
        n = end - begin
        at = np.repeat(begin - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
        return pd.DataFrame(
            {id_col: ids.repeat(n), "shard": part.shards[at].astype(np.int32), "first": part.firsts[at].astype(np.int64), "copies": part.copies[at].astype(np.int64)}
        )

    # ids travel as text: data frames would turn integers with nulls into floats
    distinct = keys.select(F.col(id_col).cast("string").alias(id_col)).distinct().withColumn("key", _key(F.col(id_col)))
    dealt = distinct.withColumn("part", _part(F.col("key"), store.parts))
    found = dealt.groupBy("part").applyInPandas(find, f"`{id_col}` string, shard int, first long, copies long")
    return found.withColumn(id_col, F.col(id_col).cast(kind))


def read_records(places: DataFrame, store: Store, id_col: str = "doc_id", payload: bool = False) -> DataFrame:
    """Records at the places: id, start, n_tokens, ids_crc32 and, if asked for, ids (u4 bytes)."""
    kind = places.schema[id_col].dataType.simpleString()
    folder, bases = store.folder, store.bases

    def read(rows: pd.DataFrame) -> pd.DataFrame:
        number = int(rows["shard"].iloc[0])
        shard, base, out = Shard(folder, number), bases[number], []
        for key, first, copies in zip(rows[id_col].array, rows["first"].values, rows["copies"].values):
            for record in range(first, first + copies):
                ids = shard.ids(record).astype("<u4").tobytes()
                row = (key, base + int(shard.offsets[record]), len(ids) // 4, zlib.crc32(ids))
                out.append((*row, ids) if payload else row)
        names = [id_col, "start", "n_tokens", "ids_crc32", *(["ids"] if payload else [])]
        return pd.DataFrame(out, columns=names)

    schema = f"`{id_col}` string, start long, n_tokens long, ids_crc32 long" + ", ids binary" * payload
    named = places.withColumn(id_col, F.col(id_col).cast("string"))
    return named.groupBy("shard").applyInPandas(read, schema).withColumn(id_col, F.col(id_col).cast(kind))
