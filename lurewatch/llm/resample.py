"""Importance resampling towards the benchmark: hashed n-gram features, Gumbel top-k.

1. A document's features are its words and pairs of neighbouring words; each falls in
   bucket crc32(feature) mod ``BUCKETS``. Words are split into head and tail: the exact
   counts of all words and then of pairs of the ``PAIR_WORDS`` most frequent ones give
   the head, at most ``HEAD_WORDS`` words and ``HEAD_PAIRS`` pairs. Tasks get the CRC
   state of each head word and the bucket of each head pair; all other features take
   their CRC from their bytes, a pair starting from the state of its first word. The
   split changes no bucket, only the work.
2. Bucket totals of the documents and of the target texts are exact sums. A bucket's
   gain is floor(1000 * ln of the smoothed ratio of its shares); a document's weight is
   the floored mean of its features' gains.
3. The score adds Gumbel noise that follows from the id. The best quarter of the
   documents with ``MIN_WORDS`` words or more is drawn: scores are whole numbers within a
   fixed range, so a table of how many documents have each score gives the cut and the
   ranks above; only drawn documents are ordered, each score by itself.

Null text has no words; documents without features weigh 0. A null id is hashed as the
empty string and comes last among equal scores. Rows that repeat are counted, and ranked
one behind another. Empty tables give empty results; without target texts all shares of
the target are equal. Texts are read whole; columns besides id and text are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from lurewatch.llm.common import stored, text_of

BUCKETS = 10_000
#: Percent of the documents drawn, and words that a document needs for that.
DRAW, MIN_WORDS = 25, 20
SEED = 7
#: Sizes of the broadcast head: some 10 MB in a task.
HEAD_WORDS, HEAD_PAIRS, PAIR_WORDS = 50_000, 100_000, 512
#: Distinct words that a task counts before it sends them on.
TASK_WORDS = 1 << 19
#: Equal rows that are written out at once.
_RUN = 1 << 16

# bytes of UTF-8: capitals become small, other ASCII but digits and letters becomes a space
_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(_BYTES).split()


class Head(dict):
    """CRC states of words: held for the head, computed for the tail. Pairs: buckets of the head's."""

    def __init__(self, words: list[bytes], pairs: list[tuple[bytes, bytes]]):
        super().__init__((w, zlib.crc32(w)) for w in words)
        self.pairs = {(a, b): zlib.crc32(b" " + b, self[a]) % BUCKETS for a, b in pairs}

    def __missing__(self, word: bytes) -> int:
        return zlib.crc32(word)

    def buckets(self, words: list[bytes]) -> np.ndarray:
        """Buckets of all features of a text."""
        states = list(map(self.__getitem__, words))
        after, known = words[1:], self.pairs
        pairs = [
            zlib.crc32(b" " + b, state) if bucket is None else bucket
            for bucket, b, state in zip(map(known.get, zip(words, after), repeat(None)), after, states)
        ]
        return np.array(states + pairs, dtype=np.int64) % BUCKETS


def _texts(docs: DataFrame, text_col: str) -> DataFrame:
    return docs.select(text_of(docs, text_col).alias("t"))


def _rows(names: list[str], *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)


def _most_frequent(sums: DataFrame, limit: int) -> DataFrame:
    """The rows with the largest ``n``, ``limit`` at most: those of one count stay or go together."""
    # one row for each count that occurs, some square root of the words
    levels = sums.groupBy("n").agg(F.count("*").alias("kinds"))
    upto = F.sum("kinds").over(Window.orderBy(F.col("n").desc()))
    least = levels.withColumn("upto", upto).where(F.col("upto") <= limit).agg(F.min("n")).first()[0]
    return sums.where(F.col("n") >= least) if least is not None else sums.where("false")


def fit_head(
    docs: DataFrame, text_col: str = "text", head_words: int = HEAD_WORDS, head_pairs: int = HEAD_PAIRS,
    pair_words: int = PAIR_WORDS,
) -> Head:
    """The most frequent words of all documents, and pairs of the most frequent of those."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def rows() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())], ["word", "n"])
            counts.clear()
            return out

        for batch in batches:
            for text in batch.column(0):
                counts.update(words_of(text.as_py()))
                if len(counts) > TASK_WORDS:
                    yield rows()
        yield rows()

    texts = _texts(docs, text_col)
    sums = stored(texts.mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")), "word-counts")
    found = sorted(((r["n"], bytes(r["word"])) for r in _most_frequent(sums, head_words).collect()), reverse=True)
    words = [w for _, w in found]
    places, size = {w: i for i, w in enumerate(words[:pair_words])}, min(len(words), pair_words)

    def count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(size * size, dtype=np.int64)
        for batch in batches:
            at = np.array(
                [p for text in batch.column(0) for p in (*map(places.get, words_of(text.as_py()), repeat(-1)), -1)], dtype=np.int64
            )
            a, b = at[:-1], at[1:]
            met = (a >= 0) & (b >= 0)
            sums += np.bincount(a[met] * size + b[met], minlength=size * size)
        seen = np.flatnonzero(sums)
        yield _rows(["pair", "n"], seen, sums[seen])

    if not size:
        return Head([], [])
    # at most pair_words squared rows
    pairs = texts.mapInArrow(count_pairs, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect()
    best = sorted(((r["n"], r["pair"]) for r in pairs), reverse=True)[:head_pairs]
    return Head(words, [(words[p // size], words[p % size]) for _, p in best])


def bucket_totals(docs: DataFrame, head: Head, text_col: str = "text") -> np.ndarray:
    """How many features of all texts fall in each bucket."""
    shared = docs.sparkSession.sparkContext.broadcast(head)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            for text in batch.column(0):
                sums += np.bincount(shared.value.buckets(words_of(text.as_py())), minlength=BUCKETS)
        seen = np.flatnonzero(sums)
        yield _rows(["bucket", "n"], seen, sums[seen])

    parts = _texts(docs, text_col).mapInArrow(count, "bucket long, n long")
    totals = np.zeros(BUCKETS, dtype=np.int64)
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most BUCKETS rows
        totals[row["bucket"]] = row["n"]
    return totals


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    s, t = source.astype(np.float64), target.astype(np.float64)
    ratio = (t + 1) * (s.sum() + BUCKETS) / ((s + 1) * (t.sum() + BUCKETS))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weigh_documents(docs: DataFrame, head: Head, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_words, n_features, weight, score."""
    shared = docs.sparkSession.sparkContext.broadcast((head, gain))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, gain = shared.value
        for batch in batches:
            rows = []
            for text in batch.column(1):
                words = words_of(text.as_py())
                found = known.buckets(words)
                rows.append((len(words), len(found), int(gain[found].sum()) // len(found) if len(found) else 0))
            numbers = [pa.array(c, pa.int64()) for c in zip(*rows)] if rows else [pa.array([], pa.int64())] * 3
            yield pa.RecordBatch.from_arrays([batch.column(0), *numbers], [id_col, "n_words", "n_features", "weight"])

    kind = docs.schema[id_col].dataType.simpleString()
    chosen = docs.select(docs[id_col], text_of(docs, text_col).alias("t"))
    weighed = chosen.mapInArrow(run, f"`{id_col}` {kind}, n_words long, n_features long, weight long")
    name = F.concat(F.lit(f"{SEED}:"), F.coalesce(weighed[id_col].cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    return weighed.withColumn("score", F.col("weight") + noise)


def draw(weighed: DataFrame, id_col: str = "doc_id", percent: int = DRAW, min_words: int = MIN_WORDS) -> DataFrame:
    """Replace ``n_words`` by ``rank``: 1, 2, 3... by falling score for the rows drawn, null for the others.

    ``weighed`` is read three times and should be stored.
    """
    able = F.col("n_words") >= min_words
    # whole numbers between floor(1000 * ln) of ratios of counts, with noise from -3.2 to 22.9
    # thousand: at most some hundred thousand kinds, whatever the input
    kinds = sorted(((r["score"], r["n"]) for r in weighed.where(able).groupBy("score").agg(F.count("*").alias("n")).collect()), reverse=True)
    wanted = percent * sum(n for _, n in kinds) // 100
    above, rows = 0, []
    for score, n in kinds:
        if above >= wanted:
            break
        rows.append((score, above))
        above += n
    spark = weighed.sparkSession
    lowest = rows[-1][0] if rows else None
    picked = able & (F.col("score") >= lowest) if rows else F.lit(False)
    columns = [F.col(id_col), "n_features", "weight", "score"]
    rest = weighed.where(~picked).select(*columns, F.lit(None).cast("long").alias("rank"))
    if not rows:
        return rest
    ahead = spark.createDataFrame(rows, "score long, above long")
    tied = Window.partitionBy("score").orderBy(F.col(id_col).asc_nulls_last(), "n_features", "weight")
    before = F.sum("m").over(tied.rowsBetween(Window.unboundedPreceding, -1))
    # rows that say the same are counted first and written out again, a run at a time
    ranked = (
        weighed.where(picked)
        .groupBy(id_col, "n_features", "weight", "score").agg(F.count("*").alias("m"))
        .join(F.broadcast(ahead), "score")
        .withColumn("first", F.col("above") + F.coalesce(before, F.lit(0)) + 1)
        .withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(m - 1) div {_RUN}"))))
        .withColumn("in_run", F.explode(F.sequence(F.lit(0).cast("long"), F.least(F.lit(_RUN), F.col("m") - F.col("run") * _RUN) - 1)))
    )
    rank = F.col("first") + F.col("run") * _RUN + F.col("in_run")
    return ranked.select(*columns, F.when(rank <= wanted, rank).alias("rank")).unionByName(rest)


def resample(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text"
) -> DataFrame:
    """Per document: id, n_features, weight, score, rank."""
    head = fit_head(docs, text_col)
    gain = gains(bucket_totals(docs, head, text_col), bucket_totals(target, head, target_col))
    return draw(stored(weigh_documents(docs, head, gain, id_col, text_col), "weighed"), id_col)


SQL = rf"""
WITH RECURSIVE steps(b, k, c) AS (
  SELECT range::BIGINT, 0, range::BIGINT FROM range(256)
  UNION ALL SELECT b, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM steps WHERE k < 8),
crc AS (SELECT list(c ORDER BY b) AS of_byte FROM steps WHERE k = 8),
texts AS (
  SELECT 'd' AS side, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark),
words AS (
  SELECT side, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
features AS (
  SELECT side, id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS feature FROM words),
kinds AS (SELECT DISTINCT feature, hex(encode(feature)) AS raw FROM features),
hashed AS (
  SELECT feature, xor(list_reduce(
    list_concat([4294967295::BIGINT], list_transform(range(0, len(raw) // 2), lambda i: ('0x' || raw[2 * i + 1:2 * i + 2])::BIGINT)),
    lambda c, b: xor(c >> 8, of_byte[xor(c, b) % 256 + 1])), 4294967295) % {BUCKETS} AS bucket FROM kinds, crc),
found AS (SELECT side, id, bucket FROM features JOIN hashed USING (feature)),
totals AS (
  SELECT coalesce(s, 0) AS s, coalesce(t, 0) AS t, range AS bucket FROM range({BUCKETS}) LEFT JOIN (
    SELECT bucket, count(*) FILTER (WHERE side = 'd') AS s, count(*) FILTER (WHERE side = 'b') AS t FROM found GROUP BY bucket
  ) sums ON sums.bucket = range),
gains AS (
  SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * ((SELECT sum(s) FROM totals) + {BUCKETS})
    / ((s + 1)::DOUBLE * ((SELECT sum(t) FROM totals) + {BUCKETS}))))::BIGINT AS gain FROM totals),
sums AS (SELECT id, count(*) AS n, sum(gain) AS g FROM found JOIN gains USING (bucket) WHERE side = 'd' GROUP BY id),
weighed AS (
  SELECT id AS doc_id, len(w) AS n_words, coalesce(n, 0) AS n_features, coalesce(floor(g::DOUBLE / n), 0)::BIGINT AS weight,
    ('0x' || sha256('{SEED}:' || id)[1:8])::BIGINT AS h
  FROM words LEFT JOIN sums USING (id) WHERE side = 'd'),
scored AS (
  SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score FROM weighed),
ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS able FROM scored WHERE n_words >= {MIN_WORDS})
SELECT doc_id, n_features::BIGINT AS n_features, weight, score, CASE WHEN rank <= {DRAW} * able // 100 THEN rank END AS rank
FROM scored LEFT JOIN ranked USING (doc_id)
"""
