"""Evasion variants of a mail, used only to measure and harden the detector.

Every decision is a draw on (mail id, stream, position): the same rows come out
under any partitioning, and a retried task repeats its output.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lurewatch import lexicons as lex
from lurewatch.functions import batches, text as tx
from lurewatch.functions.draws import below, position_draw, position_draws, seed_of
from lurewatch.functions.plan import let

VARIANTS = [
    "char_spacing", "homoglyph", "leetspeak", "zero_width", "url_obfuscation", "image_only",
    "ia_polie", "composite_2026",
]
ATTACKS, FUTURE = VARIANTS[:6], VARIANTS[6:]


#: Stands for any letter.
_LETTER = "\x01"


def _seed(stream: int) -> Column:
    return seed_of(F.col("mail_id"), stream)


def _per_char(text: Column, change) -> Column:
    return F.array_join(F.transform(F.split(text, ""), change), "")


@dataclass(frozen=True)
class CharacterDraws:
    """``position_draw`` of the characters of a piece of texts."""

    starts: np.ndarray
    seeds: np.ndarray
    seeded: np.ndarray

    def below(self, at: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
        """Those of the characters at ``at`` whose draw is below the limit, and their draws."""
        row = np.searchsorted(self.starts, at, "right") - 1
        draw = position_draws(self.seeds[row], at - self.starts[row])
        hit = (draw < limit) & self.seeded[row]
        return at[hit], draw[hit]


def _aligned(texts: pa.Array, ends: np.ndarray) -> np.ndarray:
    """Code points of texts as long as those that ``ends`` tells, zeros for a null one."""
    points, _ = batches.characters(texts)
    if not texts.null_count:
        return points
    out = np.zeros(int(ends[-1]), np.uint32)
    out[np.repeat(texts.is_valid().to_numpy(zero_copy_only=False), np.diff(ends))] = points
    return out


def _by_character(change):
    """Column function of text, seed and further texts of as many characters.

    ``change`` gets the code points and draws of a piece, and returns new code points,
    places behind which a character is put in, and those characters. A further text may be
    null where ``change`` needs none; its characters are then zeros.
    """

    @F.arrow_udf("string")
    def run(*columns: pa.Array) -> pa.Array:
        texts, seeds, *others = columns
        seeded = seeds.is_valid().to_numpy(zero_copy_only=False)
        number = seeds.fill_null(0).to_numpy(zero_copy_only=False)
        out = []
        for first, part in batches.sliced(texts):
            rows = slice(first, first + len(part))
            points, ends = batches.characters(part)
            more = [_aligned(o.slice(first, len(part)), ends) for o in others]
            points, at, put = change(points, CharacterDraws(ends[:-1], number[rows], seeded[rows]), *more)
            out.append(batches.from_characters(np.insert(points, at + 1, put), ends + np.searchsorted(at, ends), part))
        return pa.concat_arrays(out) if out else texts

    return run


def _both_cases(table: dict[str, str], upper) -> tuple[str, str]:
    """Aligned (from, to) strings covering small and capital letters."""
    capitals = {k.upper(): upper(v) for k, v in table.items()}
    return "".join(table) + "".join(capitals), "".join(table.values()) + "".join(capitals.values())


def _swap(text: Column, seed: Column, probability: float, pairs: tuple[str, str]) -> Column:
    src, dst = pairs

    table = dict(zip(map(ord, src), map(ord, dst)))
    to = np.arange(max(table) + 1, dtype=np.uint32)
    to[[*table]] = [*table.values()]

    def change(points: np.ndarray, draw: CharacterDraws) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at = np.flatnonzero(points < len(to))
        at = at[to[points[at]] != points[at]]
        at, _ = draw.below(at, below(probability))
        out = points.copy()
        out[at] = to[points[at]]
        return out, np.zeros(0, np.int64), np.zeros(0, np.uint32)

    return _by_character(change)(text, seed)


def char_spacing(text: Column, seed: Column, probability: float = 0.75) -> Column:
    """Space out the letters of words of four characters or more."""

    def change(word, i):
        hit = (F.length(word) >= 4) & (position_draw(seed, i) < below(probability))
        return F.when(hit, F.array_join(F.split(word, ""), " ")).otherwise(word)

    return F.array_join(F.transform(F.split(text, " "), change), " ")


def homoglyph(text: Column, seed: Column, probability: float = 0.6) -> Column:
    return _swap(text, seed, probability, _both_cases(lex.LATIN_TO_HOMOGLYPH, str.upper))


def leetspeak(text: Column, seed: Column, probability: float = 0.5) -> Column:
    return _swap(text, seed, probability, _both_cases(lex.LEET, str))


def zero_width(text: Column, seed: Column, probability: float = 0.3) -> Column:
    """Insert an invisible character after letters."""
    marks = np.array([ord(z) for z in lex.ZERO_WIDTH], np.uint32)

    def change(points: np.ndarray, draw: CharacterDraws, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        # only letters draw; those of texts with unsettled characters are told by the engine
        known = np.where(letters == 0, (tx.kinds()[points] & tx.LETTER > 0) | (points == ord(_LETTER)), letters == ord(_LETTER))
        at, drawn = draw.below(np.flatnonzero(known), below(probability))
        return points, at, marks[drawn % len(marks)]

    told = F.when(text.rlike(tx.unsettled_class()), F.regexp_replace(F.replace(text, F.lit("\x00"), F.lit(" ")), r"\p{L}", _LETTER))
    return _by_character(change)(text, seed, told)


def _percent(text: Column, keep=None) -> Column:
    """Percent-encode letters by code point, except where ``keep(position)`` holds."""

    def change(c, k):
        letter = c.rlike(r"\p{L}")
        code = F.concat(F.lit("%"), F.lower(F.hex(F.ascii(c))))
        return F.when(letter if keep is None else letter & ~keep(k), code).otherwise(c)

    return _per_char(text, change)


def obfuscate_urls(body: Column, seed: Column) -> Column:
    """Rewrite every URL in one of four ways picked by its position in the mail."""

    def rewrite(url, i):
        part = lambda n: F.regexp_extract(url, r"^(https?://)([^/]+)(.*)", n)
        scheme, host, rest = part(1), part(2), part(3)
        pick = position_draw(seed, i) % 4
        number = (position_draw(seed, i + 1000) % 99 + 1).cast("string")
        skip = lambda k: position_draw(seed, k + 2000) >= below(0.5)
        changed = (
            F.when(pick == 0, F.concat(scheme, _percent(host), rest))
            .when(pick == 1, F.concat(scheme, host, F.lit("@evil-"), number, F.lit(".tk"), rest))
            .when(
                pick == 2,
                F.concat(scheme, F.lit("secure-login."), host, F.lit(".verify-account.xyz"), rest),
            )
            .otherwise(F.concat(scheme, _percent(host), _percent(rest, skip)))
        )
        return F.when(scheme == "", url).otherwise(changed)

    return tx.replace_urls(body, rewrite)


# --- Fixed values: what the polished variant looks for and puts in its place. ---
_GREETING = (
    rf"(?iu)(?<!{tx.WORD})(?:cher|chère)[{tx._SPACE_CLASS}]+"
    rf"(?:client|utilisateur|membre|abonné)e?(?!{tx.WORD})[ ,:]*"
)
_PRESSURE = "(?iu)" + tx.word_bounded(
    "urgent|immédiatement|tout de suite|sous 24h|maintenant"
)
_NEW_GREETING, _NEW_PRESSURE = "Bonjour Camille, ", "dans les meilleurs délais"
_SIGNED = " Cordialement, le service client."
# --- End of fixed values. ---

#: The same patterns; a place that no first letter (in any case) begins is left by one look-up.
_GREETING_ONCE = "(?=[cC])" + _GREETING
_PRESSURE_ONCE = "(?=[itsumITSUM\\x{130}\\x{131}\\x{17f}])" + _PRESSURE


def polish_body(body: Column) -> Column:
    """Remove the crude markers: generic greeting, pressure words, runs of ``!``."""
    out = F.regexp_replace(body, _GREETING_ONCE, _NEW_GREETING)
    out = F.regexp_replace(out, _PRESSURE_ONCE, _NEW_PRESSURE)
    out = F.regexp_replace(out, "!{2,}", ".")
    out = tx.strip(tx.single_spaced(out))

    def sign(t):
        signed = F.concat(t, F.lit(_SIGNED))
        return F.when(F.lower(t).contains("cordialement"), t).otherwise(signed)

    return let(out, sign)


def polish_subject(subject: Column) -> Column:
    bare = F.btrim(F.regexp_replace(subject, _PRESSURE_ONCE, ""), F.lit(" :-"))
    return F.when(bare == "", subject).otherwise(bare)


def _changes(variant: str, here: Column | None = None) -> dict[str, Column]:
    """New columns of a variant; where ``here`` does not hold its texts are null and cost nothing."""
    subject, body = (F.col(c) if here is None else F.when(here, F.col(c)) for c in ("subject", "body"))
    on_text = {
        "char_spacing": char_spacing, "homoglyph": homoglyph, "leetspeak": leetspeak,
        "zero_width": zero_width,
    }
    if variant in on_text:
        change = on_text[variant]
        return {"subject": change(subject, _seed(1)), "body": change(body, _seed(2))}
    if variant == "url_obfuscation":
        return {"body": obfuscate_urls(body, _seed(3))}
    if variant == "image_only":
        keep = position_draw(_seed(4), F.lit(0)) < below(0.5)
        bodies = F.array(F.lit(""), F.lit("Voir l'image ci-jointe."), F.lit("[image]"))
        pick = (position_draw(_seed(4), F.lit(1)) % 3).cast("int")
        return {
            "subject": F.when(keep, subject).otherwise(F.lit("")),
            "body": F.get(bodies, pick),
            "attachments": F.array_append("attachments", F.lit("message.png")),
            "has_html": F.lit(True),
        }
    if variant == "ia_polie":
        return {"subject": polish_subject(subject), "body": polish_body(body)}
    if variant == "composite_2026":
        lookalike = homoglyph(polish_body(body), _seed(5), 0.35)
        return {
            "subject": homoglyph(polish_subject(subject), _seed(6), 0.35),
            "body": zero_width(lookalike, _seed(7), 0.15),
        }
    raise ValueError(f"unknown variant: {variant}")


def perturb_mail(mail: DataFrame, variant: str) -> DataFrame:
    """The mail table under one named variant; an unknown name fails when planning."""
    return mail.withColumns(_changes(variant))


def perturb_all(mail: DataFrame, variants: list[str]) -> DataFrame:
    """Every mail under every variant: one scan, a ``variant`` column, lazy branches."""
    changes = {v: _changes(v, F.col("variant") == v) for v in variants}
    wide = mail.withColumn("variant", F.explode(F.array(*[F.lit(v) for v in variants])))
    out = {}
    for name in ("subject", "body", "attachments", "has_html"):
        value = None
        for v in variants:
            if name in changes[v]:
                is_v = F.col("variant") == v
                new = changes[v][name]
                value = F.when(is_v, new) if value is None else value.when(is_v, new)
        if value is not None:
            out[name] = value.otherwise(F.col(name))
    return wide.withColumns(out)
