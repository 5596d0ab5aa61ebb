"""Token counts at every prefix, by dynamic programming over a text's bytes.

The BPE encoding of a prefix ends in exactly one token: the one that, next to the
last token of what precedes it, is encoded as these two again. So, inside a word,

    count[i] = count[i - len(t)] + 1,  t the token that ends prefix i,

found from left to right with a memo of pairs that hold together. Words are
independent, so the count at any prefix of a text is the sum over whole words
plus one entry of the last word's table. ``prefix_counts`` stores the count at every
prefix of every text, as the steps from one to the next (a byte each, nearly always);
``with_tokens_at`` and ``with_longest_within`` answer truncation and budget questions
from that column alone, without the text or the vocabulary.

A prefix is counted as the library would encode it alone: white space at its end
is one run, however the text goes on.

Null text counts as empty: no bytes, no tokens. Rows are counted one by one; an
empty table gives an empty result; columns besides id and text are not read.
Texts are counted whole, whatever their length.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from lurewatch.llm.bytebpe import PIECE, Cache, vocabulary
from lurewatch.llm.common import text_of

#: Pairs of tokens that a worker remembers in each of two generations.
MEMO_PAIRS = 500_000


class PrefixCounter:
    def __init__(self, path: str):
        self.vocab = vocabulary(path)
        self.longest = max(map(len, self.vocab.ids))
        self.pairs = Cache(self._holds, MEMO_PAIRS)
        self.sizes = Cache(self._piece_size)

    def _holds(self, pair: tuple[int, int]) -> bool:
        a, b = pair
        tokens = self.vocab.tokens
        if a < 0:
            return b in self.vocab.direct
        return self.vocab.merge(tokens[a] + tokens[b]) == [a, b]

    def word_table(self, word: bytes) -> list[int]:
        """Tokens of word[:i] for each i, 0 included."""
        ids, pairs = self.vocab.ids, self.pairs
        counts, last = [0], [-1]
        for i in range(1, len(word) + 1):
            for j in range(max(0, i - self.longest), i):
                token = ids.get(word[j:i])
                if token is not None and pairs[last[j], token]:
                    counts.append(counts[j] + 1)
                    last.append(token)
                    break
        return counts

    def _piece_size(self, piece: str) -> int:
        return sum(self.word_table(w)[-1] for w in self.vocab.words(piece))

    def _parts(self, text: str) -> Iterator[tuple[str, int]]:
        """Pieces in order with their tokens."""
        for part, special in self.vocab.split_specials(text):
            if special:
                yield part, 1
            else:
                for piece in PIECE.findall(part):
                    yield piece, self.sizes[piece]

    def count(self, text: str) -> int:
        if any(s in text for s in self.vocab.specials):
            return sum(n for _, n in self._parts(text))
        return sum(map(self.sizes.__getitem__, PIECE.findall(text)))

    def piece_prefixes(self, piece: str) -> list[int]:
        """Tokens of piece[:k] alone for each k, 0 included, from the tables of its words."""
        out, done, base, space = [0], 0, 0, 0
        while space < len(piece) and PIECE.fullmatch(piece[: space + 1]) and piece[: space + 1].isspace():
            space += 1
            out.append(self.word_table(piece[:space].encode())[-1])
        for word in self.vocab.pattern.findall(piece):
            table, size = self.word_table(word.encode()), 0
            for k, char in enumerate(word, 1):
                size += len(char.encode())
                if done + k > space:
                    # 're and its like are one word only when whole
                    cut = word[:k] if word[0] == "'" and 1 < k < len(word) else ""
                    out.append(base + (self._piece_size(cut) if cut else table[size]))
            done, base = done + len(word), base + table[-1]
        return out

    def every_prefix(self, text: str) -> list[int]:
        """Tokens of text[:k] for each k, 0 included."""
        out, base, tail = [0], 0, ""
        for part, special in self.vocab.split_specials(text):
            if special:
                # until it is whole, a special string is text like the piece before it
                before = base - self.count(tail)
                out += [before + self.count(tail + part[:k]) for k in range(1, len(part))]
                base, tail = base + 1, ""
                out.append(base)
                continue
            for tail in PIECE.findall(part):
                inside = self.piece_prefixes(tail)
                out += [base + n for n in inside[1:]]
                base += inside[-1]
        return out

    def prefixes(self, text: str) -> tuple[list[int], list[int]]:
        """Ends of the pieces in code points, and tokens up to each."""
        parts = list(self._parts(text))
        return list(accumulate(len(p) for p, _ in parts)), list(accumulate(n for _, n in parts))

    def fitting(self, text: str, budget: int) -> int:
        """Code points of the longest prefix of whole pieces, and of the next, within the budget."""
        ends, counts = self.prefixes(text)
        k = bisect_right(counts, budget)
        if k == len(ends):
            return len(text)
        start, used = (ends[k - 1], counts[k - 1]) if k else (0, 0)
        if text[start : ends[k]] in self.vocab.specials:
            return start
        inside = self.piece_prefixes(text[start : ends[k]])
        return start + max(i for i, n in enumerate(inside) if used + n <= budget)

    def at(self, text: str, prefix: int) -> int:
        """Tokens of text[:prefix]."""
        ends, counts = self.prefixes(text)
        k = bisect_right(ends, prefix)
        start, used = (ends[k - 1], counts[k - 1]) if k else (0, 0)
        if start < prefix and text[start : ends[k]] in self.vocab.specials:
            return self.count(text[:prefix])  # part of a special string is text like what stands before it
        return used + (self.piece_prefixes(text[start : ends[k]])[prefix - start] if k < len(ends) else 0)


@lru_cache(maxsize=2)
def counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def token_counts(
    docs: DataFrame, path: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: id, n_bytes, n_tokens, over_limit, fit_chars (code points kept within the limit)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(path)
        for batch in batches:
            size, n, fit = [], [], []
            for scalar in batch.column(1):
                text = scalar.as_py()
                size.append(len(text.encode()))
                n.append(own.count(text))
                fit.append(len(text) if n[-1] <= limit else own.fitting(text, limit))
            columns = [
                batch.column(0), pa.array(size, pa.int64()), pa.array(n, pa.int64()),
                pa.array([x > limit for x in n], pa.bool_()), pa.array(fit, pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, [id_col, "n_bytes", "n_tokens", "over_limit", "fit_chars"])

    kind = docs.schema[id_col].dataType.simpleString()
    chosen = docs.select(docs[id_col].alias(id_col), text_of(docs, text_col).alias("t"))
    return chosen.mapInArrow(
        run, f"`{id_col}` {kind}, n_bytes long, n_tokens long, over_limit boolean, fit_chars long"
    )


def packed_counts(counts: list[int]) -> bytes:
    """Steps between counts at successive prefixes: small ones either way take one byte."""
    steps = np.diff(np.asarray(counts, dtype=np.int64))
    folded = np.where(steps < 0, -2 * steps - 1, 2 * steps)
    if not len(folded) or folded.max() < 128:
        return folded.astype(np.uint8).tobytes()
    out = bytearray()
    for n in folded.tolist():
        while n >= 128:
            out.append(n & 127 | 128)
            n >>= 7
        out.append(n)
    return bytes(out)


def unpacked_counts(raw: bytes) -> np.ndarray:
    """Counts at every prefix, 0 included."""
    parts = np.frombuffer(raw, dtype=np.uint8).astype(np.int64)
    ends = np.flatnonzero(parts < 128)
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(ends)]
    within = np.arange(len(parts)) - np.repeat(starts, np.diff(np.append(starts, len(parts))))
    folded = np.add.reduceat((parts & 127) << (7 * within), starts) if len(starts) else parts
    return np.concatenate(([0], np.cumsum(np.where(folded & 1, -(folded + 1) // 2, folded // 2))))


def prefix_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_tokens, counts (binary: the steps of the token counts at every code point)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(path)
        for batch in batches:
            counts = [own.every_prefix(text.as_py()) for text in batch.column(1)]
            columns = [batch.column(0), pa.array([c[-1] for c in counts], pa.int64()), pa.array(map(packed_counts, counts), pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, [id_col, "n_tokens", "counts"])

    kind = docs.schema[id_col].dataType.simpleString()
    chosen = docs.select(docs[id_col].alias(id_col), text_of(docs, text_col).alias("t"))
    return chosen.mapInArrow(run, f"`{id_col}` {kind}, n_tokens long, counts binary")


@F.arrow_udf(T.LongType())
def _tokens_at(counts: pa.Array, places: pa.Array) -> pa.Array:
    found = []
    for raw, place in zip(counts.to_pylist(), places.to_pylist()):
        known = raw is not None and place is not None and place >= 0
        table = unpacked_counts(raw) if known else None
        found.append(int(table[min(place, len(table) - 1)]) if known else None)
    return pa.array(found, pa.int64())


@F.arrow_udf(T.LongType())
def _longest_within(counts: pa.Array, budgets: pa.Array) -> pa.Array:
    found = []
    for raw, budget in zip(counts.to_pylist(), budgets.to_pylist()):
        fits = np.flatnonzero(unpacked_counts(raw) <= budget) if raw is not None and budget is not None else []
        found.append(int(fits[-1]) if len(fits) else None)
    return pa.array(found, pa.int64())


def with_tokens_at(stored_counts: DataFrame, place: Column | int, name: str = "tokens_at") -> DataFrame:
    """Add the tokens of each text's first ``place`` code points (all of it if it is shorter)."""
    return stored_counts.withColumn(name, _tokens_at("counts", (F.lit(place) if isinstance(place, int) else place).cast("long")))


def with_longest_within(stored_counts: DataFrame, budget: Column | int, name: str = "fit_chars") -> DataFrame:
    """Add the code points of the longest prefix of at most ``budget`` tokens (null below zero)."""
    return stored_counts.withColumn(name, _longest_within("counts", (F.lit(budget) if isinstance(budget, int) else budget).cast("long")))
