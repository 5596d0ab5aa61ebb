"""BPE encoding and decoding with forced boundaries.

A token is a run of bytes, so where two neighbouring bytes occur next to each
other inside no token of the vocabulary, no token can span them: the text is cut
there, the fragments are encoded one by one, and their ids are concatenated. The
pairs are read off the vocabulary once (a 256 x 256 table); the cuts of a text are
one vectorised lookup. A cut is left out where the splitting pattern could look
across it: after white space, inside a character, and before an apostrophe that
does not follow a letter or digit. Special strings are taken out first, as the
library does.

Null text is empty: no ids, the digest of nothing. Rows are coded one by one, so
repeated ids and rows stay as they are; an empty table gives an empty result;
columns besides id and text are not read. Texts of any length are coded whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lurewatch.llm.bytebpe import Cache, Vocabulary, packed, vocabulary
from lurewatch.llm.common import text_of


def joined_pairs(vocab: Vocabulary) -> np.ndarray:
    """True where byte b follows byte a inside some token."""
    table = np.zeros((256, 256), dtype=bool)
    for token in vocab.ids:
        for a, b in zip(token, token[1:]):
            table[a, b] = True
    return table


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_WORD = np.zeros(256, dtype=bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True


class Codec:
    def __init__(self, path: str):
        self.vocab = vocabulary(path)
        self.pairs = joined_pairs(self.vocab).ravel()
        self.known = Cache(self._encode_fragment)

    def _encode_fragment(self, fragment: bytes) -> bytes:
        return packed([i for w in self.vocab.words(fragment.decode()) for i in self.vocab.merge(w)])

    def fragments(self, data: bytes) -> list[bytes]:
        b = np.frombuffer(data, dtype=np.uint8)
        if len(b) < 2:
            return [data] if data else []
        left, right = b[:-1], b[1:]
        cut = ~self.pairs[left.astype(np.uint16) * np.uint16(256) + right]
        cut &= (right & 0xC0) != 0x80
        cut &= ~_SPACE[left]
        cut &= (right != 0x27) | _WORD[left]
        # the last bytes of white space beyond ASCII: C2 85, C2 A0, and E1-E3 with 80, 81 or 9A inside
        at = np.flatnonzero(cut)
        far = at[left[at] >= 0x80]
        if len(far):
            one, two = b[far - 1], b[np.maximum(far - 2, 0)]
            white = (one == 0xC2) | ((two >= 0xE1) & (two <= 0xE3) & np.isin(one, (0x80, 0x81, 0x9A)))
            cut[far[white]] = False
            at = np.flatnonzero(cut)
        ends = (at + 1).tolist()
        return [data[i:j] for i, j in zip([0, *ends], [*ends, len(data)])]

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        out = []
        for part, special in self.vocab.split_specials(text):
            if special:
                out.append(packed([self.vocab.specials[part]]))
            else:
                out.extend(map(self.known.__getitem__, self.fragments(part.encode())))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        tokens = self.vocab.tokens
        return b"".join([tokens[i] for i in np.frombuffer(ids, dtype="<u4").tolist()]).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ids (binary: little-endian unsigned 32-bit)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = codec(path).encode
        for batch in batches:
            ids = [encode(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], [id_col, "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    chosen = docs.select(docs[id_col].alias(id_col), text_of(docs, text_col).alias("t"))
    return chosen.mapInArrow(run, f"`{id_col}` {kind}, ids binary")


def decode_documents(coded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Per row: id, text (null ids: null)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = codec(path).decode
        for batch in batches:
            texts = [None if (x := i.as_py()) is None else decode(x) for i in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], [id_col, "text"])

    kind = coded.schema[id_col].dataType.simpleString()
    return coded.select(id_col, ids_col).mapInArrow(run, f"`{id_col}` {kind}, text string")


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_tokens, ids_sha256, decoded_sha256; ids and texts never leave the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            n, ids_sha, text_sha = [], [], []
            for text in batch.column(1):
                ids = own.encode(text.as_py())
                n.append(len(ids) // 4)
                ids_sha.append(hashlib.sha256(ids).hexdigest())
                text_sha.append(hashlib.sha256(own.decode(ids).encode()).hexdigest())
            columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(ids_sha), pa.array(text_sha)]
            yield pa.RecordBatch.from_arrays(columns, [id_col, "n_tokens", "ids_sha256", "decoded_sha256"])
        own.known.forget()

    kind = docs.schema[id_col].dataType.simpleString()
    chosen = docs.select(docs[id_col].alias(id_col), text_of(docs, text_col).alias("t"))
    return chosen.mapInArrow(
        run, f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
