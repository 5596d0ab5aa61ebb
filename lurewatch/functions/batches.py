"""Kernels over the bytes of a batch of texts, as Arrow hands them to a task.

A regular expression or a lambda costs hundreds of nanoseconds a character in the JVM;
here a batch is one array of bytes and every step a vector operation. Batches are worked
off in pieces of bounded size, so a task's memory does not depend on its rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text in a piece; a single longer text is a piece of its own.
PIECE = 1 << 21


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, and where each begins and the last one ends; null counts as empty."""
    texts = texts.fill_null("") if texts.null_count else texts
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, places, data = texts.buffers()
    offsets = np.frombuffer(places, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    whole = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def as_texts(data: np.ndarray, offsets: np.ndarray, like: pa.Array) -> pa.Array:
    """String column of bytes and offsets, null where ``like`` is."""
    out = pa.StringArray.from_buffers(len(like), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data)))
    return pc.if_else(like.is_valid(), out, pa.scalar(None, pa.string())) if like.null_count else out


def pieces(offsets: np.ndarray, budget: int = PIECE) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts fit the budget."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + budget, "right")) - 1)
        yield first, last
        first = last


def sliced(texts: pa.Array, budget: int = PIECE) -> Iterator[tuple[int, pa.Array]]:
    """First row and texts of each piece of a column."""
    for first, last in pieces(flat(texts)[1], budget):
        yield first, texts.slice(first, last - first)


# --- Words ------------------------------------------------------------------------------

_WORD = np.zeros(256, bool)
_WORD[np.frombuffer(b"abcdefghijklmnopqrstuvwxyz0123456789_", np.uint8)] = True


def only_words(texts: pa.Array) -> pa.Array:
    """Runs of ``[a-z0-9_]`` separated by single spaces."""
    data, offsets = flat(texts)
    parts, ends = [], [np.zeros(1, np.int64)]
    total = 0
    for first, last in pieces(offsets):
        out, at = _only_words(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
        parts.append(out)
        ends.append(at + total)
        total += len(out)
    return as_texts(np.concatenate(parts) if parts else data, np.concatenate(ends), texts)


def _only_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes left of one piece, and where each row ends in them."""
    word = _WORD[data]
    keep = word.copy()
    keep[1:] |= word[:-1]  # the first separator behind a word stays
    begins = offsets[:-1][offsets[1:] > offsets[:-1]]
    keep[begins] = word[begins]
    out = np.where(word, data, 32)[keep]
    count = np.append(0, np.cumsum(keep, dtype=np.int64))
    ends = count[offsets]
    # a row's last separator goes
    full = np.flatnonzero(ends[1:] > ends[:-1])
    last = ends[1:][full] - 1
    tail = out[last] == 32
    gone = np.zeros(len(ends) - 1, np.int64)
    gone[full[tail]] = 1
    return np.delete(out, last[tail]), (ends[1:] - np.cumsum(gone))


# --- Literals ---------------------------------------------------------------------------


@lru_cache(maxsize=8)
def _groups(terms: tuple[str, ...]) -> tuple[int, np.ndarray, list[list[tuple[int, bytes]]]]:
    """Length of the key, the group of each key (0: none), and each group's terms."""
    raw = [t.encode() for t in terms]
    size = min(3, min(map(len, raw)))
    table, groups = np.zeros(1 << (8 * size), np.uint16), []
    for i, term in enumerate(raw):
        key = int.from_bytes(term[:size], "little")
        if not table[key]:
            groups.append([])
            table[key] = len(groups)
        groups[table[key] - 1].append((i, term))
    return size, table, groups


def _apart(at: np.ndarray, length: int) -> np.ndarray:
    """Of places where a term begins those that follow each other from left to right."""
    if not (np.diff(at) < length).any():
        return at
    kept, free = [], 0
    for x in at.tolist():
        if x >= free:
            kept.append(x)
            free = x + length
    return np.array(kept, at.dtype)


def find(data: np.ndarray, offsets: np.ndarray, terms: tuple[str, ...]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(term, row, byte)`` of the non-overlapping occurrences of each term in the rows of a piece."""
    size, table, groups = _groups(terms)
    if len(data) < size:
        return
    key = data[: len(data) - size + 1].astype(np.uint32)
    for j in range(1, size):
        key |= data[j : len(data) - size + 1 + j].astype(np.uint32) << (8 * j)
    group = table[key]
    at = np.flatnonzero(group)
    which = group[at]
    order = np.argsort(which, kind="stable")
    at, which = at[order], which[order]
    bounds = np.searchsorted(which, np.arange(1, len(groups) + 2))
    for g, members in enumerate(groups):
        begun = at[bounds[g] : bounds[g + 1]]
        for term, text in members if len(begun) else ():
            p = begun[begun + len(text) <= len(data)]
            for j in range(size, len(text)):
                p = p[data[p + j] == text[j]]
            row = np.searchsorted(offsets, p, "right") - 1
            p = _apart(p[p + len(text) <= offsets[row + 1]], len(text))
            if len(p):
                yield term, np.searchsorted(offsets, p, "right") - 1, p


# --- Characters ---------------------------------------------------------------------------


def characters(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, and where each begins and the last one ends."""
    data, offsets = flat(texts)
    starts = np.append(0, np.cumsum((data & 0xC0) != 0x80, dtype=np.int64))
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    return points, starts[offsets]


def from_characters(points: np.ndarray, ends: np.ndarray, like: pa.Array) -> pa.Array:
    """String column of code points; ``ends`` holds where each row begins and the last one ends."""
    width = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
    offsets = np.append(0, np.cumsum(width))[ends]
    data = np.frombuffer(points.astype("<u4").tobytes().decode("utf-32-le").encode("utf-8"), np.uint8)
    return as_texts(data, offsets, like)
