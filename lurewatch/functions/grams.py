"""Terms of cleaned texts (words and pairs, character n-grams) counted batch by batch.

Cleaned texts hold ``[a-z0-9_]`` words between single spaces. A word is encoded once a
piece; its n-grams are spelled once a piece too, however often it occurs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from lurewatch.functions.batches import flat, sliced

SIZES = (3, 4, 5)
#: Bytes of text counted at once; a character begins up to three n-grams.
BUDGET = {"word": 1 << 22, "char": 1 << 20}
#: N-grams that a task sums before it hands them on (24 bytes each), and rows handed on at once.
HELD, ROWS = 1 << 21, 1 << 16


def _encoded(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Row and code of every word, and the words by code."""
    texts = texts.fill_null("") if texts.null_count else texts
    parts = pc.split_pattern(texts, " ")
    row = np.repeat(np.arange(len(texts)), parts.value_lengths().to_numpy(zero_copy_only=False))
    words = parts.flatten().dictionary_encode()
    return row, words.indices.to_numpy(zero_copy_only=False).astype(np.int64), words.dictionary


def _runs(ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of a sorted array and how often each comes."""
    first = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])) if len(ordered) else np.zeros(0, np.int64)
    return ordered[first], np.diff(np.append(first, len(ordered)))


def _pairs(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """Row and code of the words of two characters or more, whether the next one is of the same row, words by code."""
    row, word, names = _encoded(texts)
    long = pc.utf8_length(names).to_numpy(zero_copy_only=False)[word] >= 2
    row, word = row[long], word[long]
    return row, word, row[1:] == row[:-1], names


def _spelled(names: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word and code of the n-grams of each padded word, ordered by word; a code is the n-gram's bytes."""
    data, offsets = flat(names)
    lengths = np.diff(offsets)
    full = np.flatnonzero(lengths)
    sizes = lengths[full] + 2
    ends = np.cumsum(sizes)
    padded = np.full(int(ends[-1]) if len(ends) else 0, 32, np.int64)
    owner = np.repeat(full, sizes)
    inner = np.ones(len(padded), bool)
    inner[ends - 1] = False
    inner[ends - sizes] = False
    padded[inner] = data
    left = np.repeat(ends, sizes) - np.arange(len(padded))  # characters up to the word's end
    words, codes = [], []
    for n in SIZES:
        at = np.flatnonzero(left >= n)
        code = np.zeros(len(at), np.int64)
        for j in range(n):
            code = (code << 8) | padded[at + j]
        words.append(owner[at])
        codes.append(code)
    word, code = np.concatenate(words), np.concatenate(codes)
    order = np.argsort(word, kind="stable")
    return word[order], code[order]


def _letters(codes: np.ndarray) -> pa.Array:
    """N-grams of codes."""
    chars = np.stack([(codes >> (8 * j)) & 255 for j in reversed(range(max(SIZES)))], axis=1).astype(np.uint8)
    used = chars != 0
    offsets = np.append(0, np.cumsum(used.sum(axis=1))).astype(np.int32)
    return pa.StringArray.from_buffers(len(codes), pa.py_buffer(offsets), pa.py_buffer(chars[used]))


def _dealt(word: np.ndarray, row: np.ndarray, owner: np.ndarray, value: np.ndarray, names: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and value of every occurrence of a word, once for each entry that the word owns."""
    bounds = np.searchsorted(owner, np.arange(names + 1))
    count = np.diff(bounds)[word]
    ends = np.cumsum(count)
    place = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(bounds[word] - (ends - count), count)
    return np.repeat(row, count), value[place]


def _counted(terms: pa.Array, df: np.ndarray, total: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([terms, pa.array(df.astype(np.int64)), pa.array(total.astype(np.int64))], ["term", "df", "total_tf"])


def _tallied_words(texts: pa.Array, among: pa.Array | None, pairs: bool) -> pa.RecordBatch:
    """``(term, df, total_tf)`` of one piece."""
    row, word, same, names = _pairs(texts)
    n = len(names)
    one = np.ones(len(word), bool) if among is None else (_places(names, among) >= 0)[word]
    two = same & one[:-1] & one[1:] & pairs
    code = np.concatenate([word[one], n + word[:-1][two] * n + word[1:][two]])
    row, span = np.concatenate([row[one], row[1:][two]]), n + n * n
    present, _ = _runs(np.sort(row * span + code))
    codes, total = _runs(np.sort(code))
    _, df = _runs(np.sort(present % max(span, 1)))
    single, pair = codes[codes < n], codes[codes >= n] - n
    first, second = (names.take(pa.array(x)) for x in (pair // max(n, 1), pair % max(n, 1)))
    terms = pa.concat_arrays([names.take(pa.array(single)), pc.binary_join_element_wise(first, second, " ")])
    return _counted(terms, df, total)


def _distinct(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes as they come, and the place of each code among them."""
    coded = pa.array(codes).dictionary_encode()
    return coded.dictionary.to_numpy(), coded.indices.to_numpy().astype(np.int64)


def _tallied_chars(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code, df and total count of the n-grams of one piece."""
    row, word, names = _encoded(texts)
    owner, code = _spelled(names)
    codes, place = _distinct(code)
    n, span = len(codes), max(len(names), 1)
    # a word that a row repeats adds to the total only
    total = np.bincount(place, weights=np.bincount(word, minlength=span)[owner], minlength=n)
    held, _ = _runs(np.sort(row * span + word))
    row, gram = _dealt(held % span, held // span, owner, place, len(names))
    present, _ = _runs(np.sort(row * max(n, 1) + gram))
    return codes, np.bincount(present % max(n, 1), minlength=n), total.astype(np.int64)


def _merged(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums of several tallies by code."""
    code, df, total = (np.concatenate(x) for x in zip(*parts))
    codes, place = _distinct(code)
    # sums of doubles are exact up to 2**53
    df, total = (np.bincount(place, weights=x, minlength=len(codes)).astype(np.int64) for x in (df, total))
    return codes, df, total


def tally(kind: str, among: pa.Array | None = None, pairs: bool = True):
    """Task function over a ``clean`` column: ``(term, df, total_tf)`` of its rows, some terms in several parts.

    Words may be held to those ``among`` some, with the pairs of these, or to single words.
    """

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in sliced(batch.column(0), BUDGET[kind]):
                yield _tallied_words(texts, among, pairs)

    def chars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        for batch in batches:
            for _, texts in sliced(batch.column(0), BUDGET[kind]):
                held.append(_tallied_chars(texts))
                if sum(len(codes) for codes, _, _ in held) > HELD:
                    held = [_merged(held)]
                    if len(held[0][0]) > HELD // 2:
                        yield from spelled(held.pop())
        if held:
            yield from spelled(_merged(held))

    def spelled(sums: tuple[np.ndarray, ...]) -> Iterator[pa.RecordBatch]:
        for start in range(0, len(sums[0]), ROWS):
            codes, df, total = (x[start : start + ROWS] for x in sums)
            yield _counted(_letters(codes), df, total)

    return words if kind == "word" else chars


@dataclass(frozen=True)
class Vocabulary:
    """Terms in column order, and the count of each in cleaned texts."""

    kind: str
    terms: tuple[str, ...]

    @cached_property
    def _singles(self) -> tuple[pa.Array, np.ndarray]:
        at = [i for i, t in enumerate(self.terms) if " " not in t]
        return pa.array([self.terms[i] for i in at], pa.string()), np.array([*at, -1], np.int64)

    @cached_property
    def _doubles(self) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """Words of pairs, codes of pairs in order, and the column of each."""
        pairs = {i: t.split(" ", 1) for i, t in enumerate(self.terms) if " " in t}
        words = sorted({w for p in pairs.values() for w in p})
        place = {w: k for k, w in enumerate(words)}
        codes = np.array([place[a] * len(words) + place[b] for a, b in pairs.values()], np.int64)
        order = np.argsort(codes)
        return pa.array(words, pa.string()), codes[order], np.array([*pairs], np.int64)[order]

    @cached_property
    def _grams(self) -> tuple[np.ndarray, np.ndarray]:
        codes = np.array([int.from_bytes(t.encode(), "big") for t in self.terms], np.int64)
        order = np.argsort(codes)
        return codes[order], order

    def counts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, column and count of every term of the texts, by row and column."""
        rows, columns, counts = [], [], []
        for first, part in sliced(texts, BUDGET[self.kind]):
            row, column = (self._words if self.kind == "word" else self._chars)(part)
            key, count = _runs(np.sort(row * max(len(self.terms), 1) + column))
            rows.append(key // max(len(self.terms), 1) + first)
            columns.append(key % max(len(self.terms), 1))
            counts.append(count)
        return tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in (rows, columns, counts))

    def _words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        row, word, same, names = _pairs(texts)
        single, column = self._singles
        known = column[_places(names, single)][word]
        parts, codes, columns = self._doubles
        part = _places(names, parts)[word]
        a, b = part[:-1], part[1:]
        both = same & (a >= 0) & (b >= 0)
        hit = _found(a[both] * max(len(parts), 1) + b[both], codes, columns)
        rows = np.concatenate([row[known >= 0], row[1:][both][hit >= 0]])
        return rows, np.concatenate([known[known >= 0], hit[hit >= 0]])

    def _chars(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        row, word, names = _encoded(texts)
        owner, code = _spelled(names)
        column = _found(code, *self._grams)
        return _dealt(word, row, owner[column >= 0], column[column >= 0], len(names))


def _places(names: pa.Array, known: pa.Array) -> np.ndarray:
    """Place of each name among the known ones, -1 where it is none."""
    return pc.index_in(names, value_set=known).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)


def _found(code: np.ndarray, codes: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Column of each code, -1 where it has none."""
    if not len(codes):
        return np.full(len(code), -1)
    at = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
    return np.where(codes[at] == code, columns[at], -1)
