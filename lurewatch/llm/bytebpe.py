"""A byte-level BPE vocabulary file as tables, and text pieces that encode independently.

``pieces`` cuts text only where no merge and no look-ahead of the splitting
pattern can reach across, so the ids of a text are the ids of its pieces in a
row. Natural text repeats its pieces, so each worker keeps what it has encoded
in a cache of bounded size.
"""

from __future__ import annotations

import heapq
import json
import re
from functools import lru_cache

import numpy as np

#: Pieces that a worker keeps in each of two generations; about 100 MB each.
CACHE_PIECES = 500_000

# fixed values: the pattern of byte-level BPE files and Unicode's White_Space
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WHITE = r"\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

# A piece is white space with what follows it up to the next white space; letters
# that end before plain punctuation end a piece too. No apostrophe: 's is a token.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
PIECE = re.compile(
    rf'[{WHITE}]*[{_LETTERS}]+(?=[{WHITE}.,!?;:|%$&*#"()\-]|\Z)|[{WHITE}]*[^{WHITE}]+|[{WHITE}]+'
)


@lru_cache(maxsize=1)
def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in the file."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters, spare = {}, 0x100
    for b in range(256):
        if b in shown:
            letters[b] = chr(b)
        else:
            letters[b] = chr(spare)
            spare += 1
    return [letters[b] for b in range(256)]


class Vocabulary:
    """Tokens as bytes, merge ranks and special strings of one file."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        back = {c: b for b, c in enumerate(byte_letters())}
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        model = spec["model"]
        self.ids = {
            bytes(back[c] for c in token): i for token, i in model["vocab"].items() if token not in self.specials
        }
        self.size = max(max(self.ids.values()), *self.specials.values()) + 1
        self.tokens: list[bytes] = [b""] * self.size
        for token, i in self.ids.items():
            self.tokens[i] = token
        for token, i in self.specials.items():
            self.tokens[i] = token.encode()
        self.ranks: dict[tuple[int, int], int] = {}
        self.made: list[int] = []
        for rank, merge in enumerate(model["merges"]):
            a, b = (bytes(back[c] for c in x) for x in (merge.split(" ") if isinstance(merge, str) else merge))
            self.ranks[self.ids[a], self.ids[b]] = rank
            self.made.append(self.ids[a + b])
        self.bytes_of = [self.ids[bytes([b])] for b in range(256)]
        # tokens whose own bytes encode to them
        self.direct: set[int] = set()
        self.direct = {i for token, i in self.ids.items() if self.merge(token) == [i]}
        self.pattern = regex.compile(PATTERN)
        self._special = re.compile("(" + "|".join(map(re.escape, self.specials)) + ")") if self.specials else None

    def split_specials(self, text: str) -> list[tuple[str, bool]]:
        """Parts of the text, and whether each is a special string."""
        if self._special is None or not any(s in text for s in self.specials):
            return [(text, False)] if text else []
        return [(x, i % 2 == 1) for i, x in enumerate(self._special.split(text)) if x]

    def words(self, text: str) -> list[bytes]:
        return [w.encode() for w in self.pattern.findall(text)]

    def merge(self, word: bytes) -> list[int]:
        """Ids of one word: the best-ranked pair merges until none is left."""
        whole = self.ids.get(word)
        if whole is not None and whole in self.direct:
            return [whole]
        ids = [self.bytes_of[b] for b in word]
        if len(ids) > 256:
            return self._merge_long(ids)
        get, made = self.ranks.get, self.made
        ranks = [get(p, _NONE) for p in zip(ids, ids[1:])]
        while ranks:
            best = min(ranks)
            if best == _NONE:
                break
            i = ranks.index(best)
            ids[i : i + 2] = (made[best],)
            del ranks[i]
            if i:
                ranks[i - 1] = get((ids[i - 1], ids[i]), _NONE)
            if i < len(ranks):
                ranks[i] = get((ids[i], ids[i + 1]), _NONE)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same with a heap over linked positions, for very long words."""
        n, ranks = len(ids), self.ranks
        after, before, dead = [*range(1, n), -1], [-1, *range(n - 1)], [False] * n
        heap = [(r, i, *p) for i, p in enumerate(zip(ids, ids[1:])) if (r := ranks.get(p)) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if dead[i] or j < 0 or ids[i] != a or ids[j] != b:
                continue
            ids[i], dead[j], after[i] = self.made[ranks[a, b]], True, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y >= 0 and (r := ranks.get((ids[x], ids[y]))) is not None:
                    heapq.heappush(heap, (r, x, ids[x], ids[y]))
        return [t for t, gone in zip(ids, dead) if not gone]


_NONE = 1 << 60


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def packed(ids: list[int]) -> bytes:
    return np.asarray(ids, dtype="<u4").tobytes()


class Cache(dict):
    """What each piece became, in two generations of at most ``limit`` pieces.

    When the young one is full it becomes the old one; pieces that are met again
    come back from there, so the frequent ones are never made twice.
    """

    def __init__(self, make, limit: int = CACHE_PIECES):
        super().__init__()
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, piece):
        value = self.old.get(piece)
        if value is None:
            value = self.make(piece)
        self.room(1)
        self[piece] = value
        return value

    def forget(self) -> None:
        """Let go of all pieces: workers live on after a task."""
        self.clear()
        self.old = {}

    def room(self, n: int) -> None:
        if len(self) + n > self.limit:
            self.old = dict(self)
            self.clear()
