"""Collocations: phrases of two or three words from depth-truncated suffix subtrees.

The words of a corpus are a string over an alphabet of words, cut into pieces at
punctuation; its suffixes, truncated to three words, are what a phrase counts.

1. ``word_totals`` counts the words of each language. Phrases of ``MIN_COUNT`` or
   more occurrences hold only words of as many, so all other words cut suffixes off.
2. Vertical partitioning: a suffix belongs to the subtree of its first word. Words
   are dealt to as many groups as hold about ``GROUP_SUFFIXES`` suffixes each; the
   subtree of a word above an eighth of that budget is too large for one group, so
   its prefix is extended by the next word and its branches are dealt out apart. A
   pair counts no more than either word, so only a pair of two such words may still
   be too large; it is extended to three.
3. Tasks cut texts into suffixes, merge equal ones and send each group one block of
   them: a short table of words and rows of places in it.
4. Each group sorts its suffixes by itself: leaves are runs of equal ones, a node's
   count is the total of its leaves. Branches of one pair in several groups add up.
5. Small joins give every phrase the counts of its parts, its score and its longer
   phrases; the best of each language are kept.

Inside steps 3 and 4 words are 64-bit hashes of language and word. ``word_totals`` is
checked for collisions, and another seed is taken if a counted word has one, so counts
are exact.

Null text is empty, null language is ``und``. Words are whole, whatever their length;
texts are read whole. Repeated rows count again. Texts without words and empty tables
give no rows. A language with fewer phrases than ``TOP`` returns them all. Columns
besides text and language are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from lurewatch.llm.common import stored, text_of

#: Occurrences that make a phrase a candidate.
MIN_COUNT = 10
#: Percent of a phrase's occurrences inside one longer candidate that drop it.
INSIDE = 50
#: Phrases returned for each language.
TOP = 2000
#: Suffixes of one group: its memory budget, some 40 bytes each while it is sorted.
GROUP_SUFFIXES = 1 << 19
#: Suffixes that a task merges before it sends them on, and words it counts so.
TASK_SUFFIXES, TASK_WORDS = 1 << 22, 1 << 19
#: Bits of the table that tells frequent words: 4 MB to broadcast; others that slip
#: through it only add leaves that are dropped by their counts.
FILTER_BITS = 25
_PAGE_BITS = 32768

# Bytes of UTF-8: capitals become small, tab a space and the marks that end a piece 0xFF,
# which no text holds.
_BYTES = bytes(0xFF if b in b".,;:!?\n\x0b\x0c\r" else 0x20 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))
_END = b"\xff"


def words_and_ends(text: str) -> list[bytes]:
    """Words in order, with ``_END`` where a piece ends."""
    return text.encode().translate(_BYTES).replace(_END, b" \xff ").split()


def _corpus(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    lang = F.coalesce(docs[lang_col].cast("string"), F.lit("und")).alias("lang")
    return docs.select(lang, text_of(docs, text_col).alias("text"))


# ---- words -----------------------------------------------------------------


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, Counter] = {}

    def rows() -> Iterator[pa.RecordBatch]:
        for lang, counter in counts.items():
            counter.pop(_END, None)
            words = [w.decode() for w in counter]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(words), pa.string()), pa.array(words, pa.string()), pa.array(counter.values(), pa.int64())],
                ["lang", "word", "n"],
            )
        counts.clear()

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            counter = counts.setdefault(lang, Counter())
            counter.update(words_and_ends(text.as_py()))
            if len(counter) > TASK_WORDS or len(counts) > 1000:
                yield from rows()
    yield from rows()


def word_totals(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``(lang, word, f)``: all occurrences of every word."""
    parts = _corpus(docs, text_col, lang_col).mapInArrow(_count_words, "lang string, word string, n long")
    return parts.groupBy("lang", "word").agg(F.sum("n").alias("f"))


def _hash(seed: int):
    """64 bits of language and word, as tasks compute them too; 0 stands for no word."""
    return F.xxhash64(F.lit(seed).cast("long"), "lang", "word")


def _seed_of(lang: str, seed: int) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(lang.encode(), xxhash.xxh64_intdigest(seed.to_bytes(8, "little"), 42))


def counted_words(totals: DataFrame, min_count: int) -> tuple[int, DataFrame]:
    """A seed without collisions of words that matter, and ``(lang, word, f, h)`` of those."""
    for seed in range(64):
        hashed = totals.withColumn("h", _hash(seed))
        met = hashed.groupBy("h").agg(F.count("*").alias("n"), F.max("f").alias("f"))
        if met.where((F.col("f") >= min_count) & ((F.col("n") > 1) | (F.col("h") == 0))).isEmpty():
            return seed, hashed.where(F.col("f") >= min_count)
    raise RuntimeError("no seed keeps the words of this corpus apart")


def _bitmap(words: DataFrame) -> np.ndarray:
    """Bytes of a bit table in which the low bits of each word's hash are set."""
    bit = F.col("h").bitwiseAND((1 << FILTER_BITS) - 1)
    page, at = (bit / _PAGE_BITS).cast("int").alias("page"), (bit % _PAGE_BITS).alias("at")
    pages = words.select(page, at).groupBy("page").agg(F.bitmap_construct_agg("at").alias("bits"))
    table = np.zeros((1 << FILTER_BITS) // 8, dtype=np.uint8)
    for row in pages.collect():  # 2**FILTER_BITS bits in all
        start = row["page"] * _PAGE_BITS // 8
        table[start : start + _PAGE_BITS // 8] = np.frombuffer(row["bits"], dtype=np.uint8)
    return table


# ---- suffixes --------------------------------------------------------------


def _mix(*columns: np.ndarray) -> np.ndarray:
    """A hash of hashes, to deal prefixes to groups."""
    out = np.zeros(len(columns[0]), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for c in columns:
            out = (out ^ c) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
    return out


class _Ids(dict):
    """Place of each word of one language in the task's table; 0 for words that are not counted."""

    def __init__(self, seed: int, bits: np.ndarray, table: list[int]):
        import xxhash

        super().__init__({_END: 0})
        self.seed, self.bits, self.table, self.digest = seed, bits, table, xxhash.xxh64_intdigest

    def __missing__(self, word: bytes) -> int:
        h = self.digest(word, self.seed)
        bit = h & ((1 << FILTER_BITS) - 1)
        place = 0
        if self.bits[bit >> 3] >> (bit & 7) & 1:
            place = len(self.table)
            self.table.append(h)
        self[word] = place
        return place


def _merged(a: np.ndarray, b: np.ndarray, c: np.ndarray, n: np.ndarray):
    """Equal suffixes once, with the sum of their counts, in order."""
    order = np.lexsort((c, b, a))
    a, b, c, n = a[order], b[order], c[order], n[order]
    first = np.ones(len(a), dtype=bool)
    first[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (c[1:] != c[:-1])
    return a[first], b[first], c[first], np.add.reduceat(n, np.flatnonzero(first)) if len(n) else n


def _blocks(ids: np.ndarray, table: np.ndarray, large: np.ndarray, groups: int) -> Iterator[pa.RecordBatch]:
    """Truncated suffixes of a run of words, merged, in one block for each group."""
    a, b, c = ids[:-2], ids[1:-1], ids[2:]
    real = (a > 0) & (b > 0)
    a, b, c, n = _merged(a[real], b[real], c[real], np.ones(int(real.sum()), dtype=np.int64))
    if not len(a):
        return
    too_large = np.isin(table, large)
    longer, whole = too_large[a], too_large[a] & too_large[b]
    group = _mix(table[a])
    group[longer] = _mix(table[a[longer]], table[b[longer]])
    group[whole] = _mix(table[a[whole]], table[b[whole]], table[c[whole]])
    group = (group % np.uint64(groups)).astype(np.int64)
    order = np.argsort(group, kind="stable")
    starts = np.flatnonzero(np.diff(group[order], prepend=-1))
    for lo, hi in zip(starts, [*starts[1:], len(order)]):
        rows = order[lo:hi]
        used, places = np.unique(np.stack([a[rows], b[rows], c[rows]]), return_inverse=True)
        # rows are in order: first words are told by the lengths of their runs
        first, second, third = places.reshape(3, -1)
        runs = np.flatnonzero(np.diff(first, prepend=-1))
        kind = "<u2" if len(used) <= 1 << 16 else "<u4"
        columns = [first[runs], np.diff(np.append(runs, len(rows))), second, third]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([int(group[rows[0]])], pa.int32()),
                pa.array([table[used].tobytes()], pa.binary()),
                pa.array([len(runs)], pa.int32()),
                pa.array([columns[0].astype(kind).tobytes() + columns[1].astype("<u4").tobytes()], pa.binary()),
                pa.array([columns[2].astype(kind).tobytes() + columns[3].astype(kind).tobytes()], pa.binary()),
                pa.array([n[rows].astype("<u4").tobytes()], pa.binary()),
            ],
            ["group", "words", "runs", "firsts", "rests", "counts"],
        )


def _unpacked(words: bytes, runs: int, firsts: bytes, rests: bytes, counts: bytes) -> tuple[np.ndarray, ...]:
    """Hashes of the three words, and counts, of a block's suffixes."""
    hashes = np.frombuffer(words, dtype="<u8")
    kind = np.dtype("<u2" if len(hashes) <= 1 << 16 else "<u4")
    first = np.frombuffer(firsts, dtype=kind, count=runs)
    lengths = np.frombuffer(firsts, dtype="<u4", offset=runs * kind.itemsize)
    second, third = np.frombuffer(rests, dtype=kind).reshape(2, -1)
    return np.repeat(hashes[first], lengths), hashes[second], hashes[third], np.frombuffer(counts, dtype="<u4").astype(np.int64)


def _suffixes(bits, large, seed: int, groups: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, langs, held, size = [0], {}, [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            if held:
                hashes = np.asarray(table, dtype=np.uint64)
                yield from _blocks(np.concatenate([*held, np.zeros(2, np.uint32)]), hashes, large.value, groups)
            table[1:] = []
            langs.clear()
            held.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = langs.get(lang)
                if ids is None:
                    ids = langs[lang] = _Ids(_seed_of(lang, seed), bits.value, table)
                words = words_and_ends(text.as_py())
                words.append(_END)
                held.append(np.fromiter(map(ids.__getitem__, words), dtype=np.uint32, count=len(words)))
                size += len(words)
                if size >= TASK_SUFFIXES:
                    yield from flush()
                    size = 0
        yield from flush()

    return run


def _subtrees(large, min_count: int):
    """Nodes of a group's subtrees: two words (``c`` is 0) or three, with their counts."""

    def run(blocks: pa.Table) -> pa.Table:
        parts = [
            _unpacked(*(x.as_py() for x in row))
            for row in zip(*(blocks[c] for c in ("words", "runs", "firsts", "rests", "counts")))
        ]
        a, b, c, n = _merged(*map(np.concatenate, zip(*parts)))
        first = np.ones(len(a), dtype=bool)
        first[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        pairs = np.add.reduceat(n, np.flatnonzero(first))
        whole = (c != 0) & (n >= min_count)
        # branches of a pair that was extended meet in the sum over groups
        kept = (pairs >= min_count) | (np.isin(a[first], large.value) & np.isin(b[first], large.value))
        parts = [
            [a[first][kept], b[first][kept], np.zeros(int(kept.sum()), np.uint64), pairs[kept]],
            [a[whole], b[whole], c[whole], n[whole]],
        ]
        return pa.table([np.concatenate(x).astype(np.int64) for x in zip(*parts)], ["a", "b", "c", "f"])

    return run


def phrase_counts(
    docs: DataFrame, words: DataFrame, seed: int, min_count: int, text_col: str = "text", lang_col: str = "lang",
    group_suffixes: int = GROUP_SUFFIXES,
) -> DataFrame:
    """``(a, b, c, f)``: hashes of the words of all phrases with ``min_count`` occurrences; c is 0 in pairs."""
    context = docs.sparkSession.sparkContext
    total = words.agg(F.sum("f")).first()[0] or 0
    groups = max(1, -(-total // group_suffixes))
    # at most 8 * total / group_suffixes words
    above = words.where(F.col("f") > group_suffixes // 8).select("h").collect()
    large = context.broadcast(np.sort(np.asarray([r["h"] for r in above], dtype=np.int64).astype(np.uint64)))
    bits = context.broadcast(_bitmap(words))
    blocks = _corpus(docs, text_col, lang_col).mapInArrow(
        _suffixes(bits, large, seed, groups), "group int, words binary, runs int, firsts binary, rests binary, counts binary"
    )
    nodes = blocks.groupBy("group").applyInArrow(_subtrees(large, min_count), "a long, b long, c long, f long")
    return nodes.groupBy("a", "b", "c").agg(F.sum("f").alias("f")).where(F.col("f") >= min_count)


# ---- phrases ---------------------------------------------------------------


def _cut_score(whole, left, right):
    """floor(1000000 * whole^2 / (left * right)); decimals hold the products exactly."""
    a, l, r = (x.cast("decimal(14,0)") for x in (whole, left, right))
    return F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * a * a, l * r)


def collocations(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = MIN_COUNT, inside: int = INSIDE,
    top: int = TOP, group_suffixes: int = GROUP_SUFFIXES,
) -> DataFrame:
    """Per language its best phrases: lang, rank, phrase, a, l, r, n, score."""
    totals = stored(word_totals(docs, text_col, lang_col), "word-totals")
    seed, counted = counted_words(totals, min_count)
    words = stored(counted, "words")
    nodes = stored(phrase_counts(docs, words, seed, min_count, text_col, lang_col, group_suffixes), "phrases")
    sizes = totals.groupBy("lang").agg(F.sum("f").alias("n"))

    def word(key: str, *more: str) -> DataFrame:
        return words.select(F.col("h").alias(key), F.col("word").alias(f"w_{key}"), F.col("f").alias(f"f_{key}"), *more)

    pairs = nodes.where("c = 0").select("a", "b", F.col("f").alias("whole"))
    triples = nodes.where("c <> 0").select("a", "b", "c", F.col("f").alias("whole"))

    # a pair goes if one triple around it holds enough of its occurrences
    longest = (
        triples.select("whole", F.inline(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("c").alias("b")))))
        .groupBy("a", "b")
        .agg(F.max("whole").alias("longer"))
    )
    free = pairs.join(longest, ["a", "b"], "left").where(
        F.col("longer").isNull() | (100 * F.col("longer") < inside * F.col("whole"))
    )
    two = (
        free.join(word("a", "lang"), "a").join(word("b"), "b")
        .select(
            "lang", F.concat_ws(" ", "w_a", "w_b").alias("phrase"), F.col("whole").alias("a"),
            F.col("f_a").alias("l"), F.col("f_b").alias("r"),
        )
        .withColumn("score", _cut_score(F.col("a"), F.col("l"), F.col("r")))
    )
    ends = pairs.select(F.col("a").alias("b"), F.col("b").alias("c"), F.col("whole").alias("f_bc"))
    starts = pairs.select("a", "b", F.col("whole").alias("f_ab"))
    cut = lambda left, right: F.struct(
        _cut_score(F.col("whole"), F.col(left), F.col(right)).alias("score"), F.col(left).alias("l"), F.col(right).alias("r")
    )
    first, second = cut("f_a", "f_bc"), cut("f_ab", "f_c")
    three = (
        triples.join(starts, ["a", "b"]).join(ends, ["b", "c"])
        .join(word("a", "lang"), "a").join(word("b"), "b").join(word("c"), "c")
        .withColumn("cut", F.when(first["score"] <= second["score"], first).otherwise(second))
        .select(
            "lang", F.concat_ws(" ", "w_a", "w_b", "w_c").alias("phrase"), F.col("whole").alias("a"),
            "cut.l", "cut.r", "cut.score",
        )
    )
    best = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    return (
        two.unionByName(three)
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= top)
        .join(F.broadcast(sizes), "lang")  # at most as many rows as languages
        .select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score")
    )


SQL = rf"""
WITH pieces AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
grams AS (
  SELECT lang, 1 AS k, unnest(w) AS phrase FROM pieces
  UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM pieces
  UNION ALL SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM pieces),
counts AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY lang, k, phrase HAVING k = 1 OR count(*) >= {MIN_COUNT}),
sizes AS (SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE k = 1 GROUP BY lang),
candidates AS MATERIALIZED (SELECT lang, k, phrase, f, string_split(phrase, ' ') AS w FROM counts WHERE k > 1),
halves AS MATERIALIZED (
  SELECT lang, k, phrase, f, 1 AS cut, w[1] AS one, array_to_string(w[2:], ' ') AS rest FROM candidates
  UNION ALL SELECT lang, k, phrase, f, 2, w[1] || ' ' || w[2], w[3] FROM candidates WHERE k = 3),
lefts AS MATERIALIZED (SELECT h.*, x.f AS l FROM halves h JOIN counts x ON x.lang = h.lang AND x.phrase = h.one),
cuts AS (
  SELECT h.lang, h.k, h.phrase, h.f AS a, h.l, y.f AS r, h.cut,
    ((1000000::HUGEINT * h.f * h.f) // (h.l::HUGEINT * y.f))::BIGINT AS score
  FROM lefts h JOIN counts y ON y.lang = h.lang AND y.phrase = h.rest),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
parts AS (
  SELECT lang, phrase, max(f) AS longer FROM (
    SELECT lang, f, w[1] || ' ' || w[2] AS phrase FROM candidates WHERE k = 3
    UNION ALL SELECT lang, f, w[2] || ' ' || w[3] FROM candidates WHERE k = 3) AS inner_pairs
  GROUP BY lang, phrase),
kept AS (
  SELECT o.* FROM lowest o LEFT JOIN parts p ON p.lang = o.lang AND p.phrase = o.phrase
  WHERE o.k = 3 OR p.longer IS NULL OR 100 * p.longer < {INSIDE} * o.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, s.n, r.score FROM ranked r JOIN sizes s ON s.lang = r.lang WHERE r.rank <= {TOP}
"""
