"""Column expressions for text, hosts and Unicode folding.

Everything here is a ``Column -> Column`` helper evaluated in the JVM. Tables of
Unicode characters are derived by rule from the Unicode database at import.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F

from lurewatch import lexicons
from lurewatch.functions.batches import as_texts, characters, only_words, sliced
from lurewatch.functions.plan import let

# Whitespace as the Unicode-aware regex class ``\s`` sees it, spelled out so the
# JVM regex needs no Unicode flag (the flag makes every class lookup slower).
SPACES = "".join(chr(cp) for cp in range(sys.maxunicode + 1) if chr(cp).isspace())
_SPACE_CLASS = (
    r"\x09-\x0d\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
#: One word character / anything else, with Unicode letters and numbers.
WORD = r"[\p{L}\p{N}_]"
NON_WORD_RUN = r"[^\p{L}\p{N}_]+"

# --- Fixed values: patterns. The scheme is spelled in both cases, with the long s that a
# Unicode-aware ignore-case match takes for s; the flag itself would slow every class. ---
URL = r"[hH][tT][tT][pP][sS\x{17f}]?://[^" + _SPACE_CLASS + r"<>\"')]+"
EMAIL = r"[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}"
HOST_IN_URL = r"https?://([^/" + _SPACE_CLASS + r":]+)"
ANCHOR = r"(?is)<a[^>]+href=[\"']([^\"']+)[\"'][^>]*>(.*?)</a>"
# --- End of fixed values. ---


def word_bounded(body: str) -> str:
    """``\\bbody\\b`` with Unicode word characters; ``body`` starts and ends on one."""
    return rf"(?<!{WORD})(?:{body})(?!{WORD})"


def full_text() -> Column:
    return F.concat(F.col("subject"), F.lit("\n"), F.col("body"))


def is_ascii(text: Column) -> Column:
    """Cheap test: as many bytes as characters."""
    return F.octet_length(text) == F.length(text)


def strip(text: Column, chars: str = SPACES) -> Column:
    return F.btrim(text, F.lit(chars))


def single_spaced(text: Column) -> Column:
    """Every run of white space as one space; single spaces are not touched."""
    other = _SPACE_CLASS.replace(r"\x1c-\x20", r"\x1c-\x1f")
    return F.regexp_replace(text, f"(?=[^!-~])(?:[{other}][{_SPACE_CLASS}]*| [{_SPACE_CLASS}]+)", " ")


# --- Unicode folding -------------------------------------------------------------------


@lru_cache(maxsize=None)
def _fold_tables() -> tuple[str, str, dict[str, str]]:
    """(from, to) for 1:1 and deletions, plus expansions that yield ASCII text.

    Only characters whose folding is empty or touches ASCII can reach a lexicon
    match or a cleaned token, so only those are kept.
    """
    drop, keep_from, keep_to, expand = [], [], [], {}
    for cp in range(0x80, sys.maxunicode + 1):
        if 0xD800 <= cp <= 0xDFFF:
            continue
        c = chr(cp)
        folded = "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x))
        if folded == c:
            continue
        if not folded:
            drop.append(c)
        elif len(folded) == 1:
            if folded.isascii():
                keep_from.append(c)
                keep_to.append(folded)
        elif any(x.isascii() for x in folded):
            expand[c] = folded
    return "".join(keep_from + drop), "".join(keep_to), expand


def _char_class(chars) -> str:
    """Character-class body (ranges merged) for a set of characters."""
    points, parts = sorted(map(ord, chars)), []
    start = prev = points[0]
    for cp in points[1:] + [None]:
        if cp is not None and cp == prev + 1:
            prev = cp
            continue
        parts.append(rf"\x{{{start:x}}}" + (rf"-\x{{{prev:x}}}" if prev > start else ""))
        start = prev = cp
    return "".join(parts)


def fold(text: Column) -> Column:
    """Lower-case and strip accents (compatibility decomposition minus combining marks)."""
    src, dst, expand = _fold_tables()
    # Two foldable arrays: the optimizer turns the map into one constant.
    table = F.map_from_arrays(
        F.split(F.lit("".join(expand)), ""), F.split(F.lit("\x01".join(expand.values())), "\x01")
    )
    latin = _char_class(c for c in expand if c <= "\xff")
    other = _char_class(c for c in expand if c > "\xff")
    expandable = rf"[{latin}]|(?=[^\x00-\xff])[{other}]"

    def spell(single):
        chars = F.transform(F.split(single, ""), lambda c: F.coalesce(F.element_at(table, c), c))
        return F.when(single.rlike(expandable), F.array_join(chars, "")).otherwise(single)

    def unaccent(low):
        return F.when(is_ascii(low), low).otherwise(let(F.translate(low, src, dst), spell))

    return let(F.lower(text), unaccent)


@lru_cache(maxsize=None)
def uneven_class() -> str:
    """Characters that ``fold`` drops or spells out as several."""
    src, dst, expand = _fold_tables()
    uneven = [*src[len(dst):], *expand]
    latin, other = _char_class(c for c in uneven if c <= "\xff"), _char_class(c for c in uneven if c > "\xff")
    return rf"[{latin}]|(?=[^\x00-\xff])[{other}]"


@lru_cache(maxsize=None)
def nfkc_stable_ranges() -> tuple[tuple[int, int], ...]:
    """First and last of the runs of characters that NFKC can never touch, alone or next to others."""
    composable = {
        unicodedata.decomposition(chr(cp)).split()[-1]
        for cp in range(sys.maxunicode + 1)
        if unicodedata.decomposition(chr(cp)) and "<" not in unicodedata.decomposition(chr(cp))
        and " " in unicodedata.decomposition(chr(cp))
    }
    composable = {int(x, 16) for x in composable} | set(range(0x1160, 0x1200))
    ranges, start = [], None
    for cp in range(sys.maxunicode + 2):
        ok = (
            cp <= sys.maxunicode
            and not 0xD800 <= cp <= 0xDFFF
            and cp not in composable
            and not unicodedata.combining(chr(cp))
            and unicodedata.is_normalized("NFKC", chr(cp))
        )
        if ok and start is None:
            start = cp
        elif not ok and start is not None:
            ranges.append((start, cp - 1))
            start = None
    return tuple(ranges)


@lru_cache(maxsize=None)
def nfkc_stable_class() -> str:
    """Class of ``nfkc_stable_ranges``.

    The widest ranges are enough: any other character only sends its row down
    the exact path.
    """
    ranges = nfkc_stable_ranges()
    low = [r for r in ranges if r[0] < 0x500]
    wide = sorted((r for r in ranges if r[0] >= 0x500), key=lambda r: r[0] - r[1])[:40]
    return "".join(rf"\x{{{a:x}}}-\x{{{b:x}}}" for a, b in low + sorted(wide))


# --- Hosts -----------------------------------------------------------------------------


def strip_www(host: Column) -> Column:
    return F.when(host.startswith("www."), F.substring(host, 5, 1 << 30)).otherwise(host)


def host_of_url(url: Column) -> Column:
    """Host of something already known to be a URL; stops at ``:``, keeps userinfo."""
    return strip_www(F.regexp_extract(F.lower(url), HOST_IN_URL, 1))


def domain_of(value: Column) -> Column:
    """Domain of an address or URL; empty when there is neither."""
    s = F.lower(strip(value))
    address = s.contains("@") & ~s.contains("://")
    after_at = strip(strip(F.substring_index(s, "@", -1)), ">")
    return F.when(address, after_at).otherwise(strip_www(F.regexp_extract(s, HOST_IN_URL, 1)))


def last_two_labels(host: Column) -> Column:
    return F.substring_index(host, ".", -2)


def registered_label(host: Column) -> Column:
    """First label of the last-two-labels domain."""
    return F.substring_index(last_two_labels(host), ".", 1)


def tld_of(host: Column) -> Column:
    return F.when(host.contains("."), F.substring_index(host, ".", -1)).otherwise(F.lit(""))


# --- Counting --------------------------------------------------------------------------


def count_of(text: Column, needle: str) -> Column:
    """Non-overlapping occurrences of a literal."""
    removed = F.octet_length(text) - F.octet_length(F.replace(text, F.lit(needle), F.lit("")))
    return (removed / len(needle.encode())).cast("int")


def homoglyph_class() -> str:
    # The lookahead rejects Latin text with one bitmap test per character.
    return r"(?=[^\x00-\xff])[" + _char_class(lexicons.HOMOGLYPHS) + "]"


def has_homoglyph(text: Column) -> Column:
    return ~is_ascii(text) & text.rlike(homoglyph_class())


def literal_alternation(values: list[str]) -> str:
    return "|".join(re.escape(v) for v in values)


# --- Cleaning for the text block --------------------------------------------------------


# An address begins where its run of characters does, or right behind the one before it:
# no other place of the run is tried, and a run that no @ follows is read once.
_EMAIL_ONCE = EMAIL.replace("+@", "++@", 1).join([r"(?:(?<![a-zA-Z0-9._%+\-])|\G)", ""])


#: The same patterns as the batch kernel spells them, for ASCII text; it finds them in linear time.
_ASCII_MASKS = (
    ("://", r"[hH][tT][tT][pP][sS]?://[^\x09-\x0d\x1c-\x20<>\"')]+", " URL_TOKEN "),
    ("@", EMAIL, " EMAIL_TOKEN "),
)


def _ascii_cleaned(texts: pa.Array) -> pa.Array:
    """ASCII texts masked and in lower case."""
    for needle, pattern, token in _ASCII_MASKS:
        hit = pc.match_substring(texts, needle)
        if pc.any(hit).as_py():
            masked = pc.replace_substring_regex(texts.filter(hit), pattern, token)
            texts = pc.replace_with_mask(texts, hit, masked)
    return pc.ascii_lower(texts)


@lru_cache(maxsize=1)
def _foldings() -> tuple[tuple[str, str], ...]:
    """Characters with their folding; found on the driver, as a look at every character takes its time."""
    src, dst, expand = _fold_tables()
    return tuple(({c: dst[i] if i < len(dst) else "" for i, c in enumerate(src)} | expand).items())


@lru_cache(maxsize=1)
def cased_foldings() -> tuple[tuple[str, str], ...]:
    """Characters in either case with the folding of their small letters."""
    table = dict(_foldings())
    small = {c: c.lower() for c in map(chr, range(sys.maxunicode + 1)) if c.lower() != c}
    return tuple((table | {c: "".join(table.get(x, x) for x in low) for c, low in small.items()}).items())


@lru_cache(maxsize=2)
def _spelling(foldings: tuple[tuple[str, str], ...], gap: bytes = b" ") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every character how many bytes its folding has, where they begin, and the bytes.

    ``gap`` stands for what is left beyond ASCII; a space separates words.
    """
    parts = [bytes(range(0x80)), gap]
    width, begin = np.ones(sys.maxunicode + 1, np.uint8), np.full(sys.maxunicode + 1, 0x80, np.int32)
    begin[:0x80] = np.arange(0x80)
    at = 0x81
    for c, spelled in foldings:
        parts.append(bytes(ord(x) if x.isascii() else gap[0] for x in spelled))
        width[ord(c)], begin[ord(c)] = len(spelled), at
        at += len(spelled)
    return width, begin, np.frombuffer(b"".join(parts), np.uint8)


def spelled(
    points: np.ndarray, ends: np.ndarray, foldings: tuple[tuple[str, str], ...], gap: bytes = b" "
) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the foldings of a piece's characters, and where each text begins and the last one ends."""
    width, begin, data = _spelling(foldings, gap)
    size, at = width[points], begin[points]
    if (size == 1).all():
        return data[at], ends
    offsets = np.append(0, np.cumsum(size, dtype=np.int64))
    out = np.empty(int(offsets[-1]), np.uint8)
    for j in range(int(size.max(initial=0))):
        held = np.flatnonzero(size > j)
        out[offsets[held] + j] = data[at[held] + j]
    return out, offsets[ends]


def _folded(texts: pa.Array, foldings: tuple[tuple[str, str], ...]) -> pa.Array:
    """Lower-case texts without accents; characters beyond ASCII that are left become spaces."""
    done = [as_texts(*spelled(*characters(piece), foldings), piece) for _, piece in sliced(texts)]
    return pa.concat_arrays(done) if done else texts


# --- Kinds of characters ------------------------------------------------------------------

#: Characters whose kind no version of Unicode that the engine or a worker may know has changed since.
SETTLED = (
    (0x00, 0x600), (0x1E00, 0x2C00), (0x4E00, 0x9FA6), (0xAC00, 0xD7A4), (0xFEFF, 0xFFE0), (0x1D400, 0x1D800),
    (0x1F300, 0x1F650),
)
LETTER, CAPITAL, NUMBER, KNOWN = 1, 2, 4, 8


@lru_cache(maxsize=1)
def kinds() -> np.ndarray:
    """Bits of every character: ``\\p{L}``, ``\\p{Lu}``, ``\\p{N}``, and whether it is settled; none of an unsettled one."""
    out = np.zeros(sys.maxunicode + 1, np.uint8)
    for first, last in SETTLED:
        for cp in range(first, last):
            kind = unicodedata.category(chr(cp))
            out[cp] = KNOWN | LETTER * (kind[0] == "L") | CAPITAL * (kind == "Lu") | NUMBER * (kind[0] == "N")
    return out


def unsettled_class() -> str:
    return "[^" + "".join(rf"\x{{{first:x}}}-\x{{{last - 1:x}}}" for first, last in SETTLED) + "]"


def per_row(hit: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Number of the characters of each row that are hit."""
    count = np.append(0, np.cumsum(hit, dtype=np.int64))[ends]
    return count[1:] - count[:-1]


def _words_of(text: Column, raw: Column) -> Column:
    """Words of ASCII text that is still raw, and of other text that is masked."""
    foldings = cased_foldings()

    @F.arrow_udf("string")
    def run(texts: pa.Array, raw: pa.Array) -> pa.Array:
        raw = raw.fill_null(True)
        if pc.any(raw).as_py():
            texts = pc.replace_with_mask(texts, raw, _ascii_cleaned(texts.filter(raw)))
        other = pc.invert(raw)
        if pc.any(other).as_py():
            texts = pc.replace_with_mask(texts, other, _folded(texts.filter(other), foldings))
        return only_words(texts)

    return run(text, raw)


def clean_text(text: Column) -> Column:
    """Mask URLs and addresses, fold, keep ``[a-z0-9_]`` words separated by single spaces."""

    def mask(t):
        no_urls = F.when(t.contains("://"), F.regexp_replace(t, URL, " URL_TOKEN ")).otherwise(t)
        return F.when(t.contains("@"), F.regexp_replace(no_urls, _EMAIL_ONCE, " EMAIL_TOKEN ")).otherwise(
            no_urls
        )

    # the engine's expressions cost several times the kernels'; only text beyond ASCII needs its patterns and letters
    return _words_of(F.when(is_ascii(text), text).otherwise(let(text, mask)), is_ascii(text))


def replace_urls(text: Column, rewrite) -> Column:
    """Apply ``rewrite(url, index)`` to every URL, leaving the text between them alone."""
    parts = F.split(text, URL, -1)
    urls = F.transform(F.regexp_extract_all(text, F.lit(URL), F.lit(0)), rewrite)
    glued = F.array_join(
        F.zip_with(parts, urls, lambda p, u: F.concat(p, F.coalesce(u, F.lit("")))), ""
    )
    return F.when(text.contains("://"), glued).otherwise(text)
