"""Deterministic pseudo-random draws, independent of partitioning and engine.

Row draws hash a salted key with MD5 and keep 32 bits. Character draws mix the
row key and the position with integer arithmetic modulo a Mersenne prime: a
hash per character would dominate every perturbation job.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, functions as F

ROW_SPAN = 1 << 32
PRIME = 2147483647


def row_draw(salt: str, *keys: Column) -> Column:
    """Uniform integer in [0, 2**32) for a row."""
    text = F.concat_ws("|", F.lit(salt), *[k.cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("bigint")


def row_chance(salt: str, probability: float, *keys: Column) -> Column:
    return row_draw(salt, *keys) < int(probability * ROW_SPAN)


def row_pick(salt: str, choices: int, *keys: Column) -> Column:
    """Uniform integer in [0, choices)."""
    return (row_draw(salt, *keys) % choices).cast("int")


def row_choice(salt: str, values: list[str], *keys: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), row_pick(salt, len(values), *keys) + 1)


def seed_of(key: Column, stream: int) -> Column:
    """Per-row seed of one character stream, in [0, PRIME)."""
    return (F.pmod(key.cast("bigint"), F.lit(PRIME)) * 48271 + (stream * 69621 + 11)) % PRIME


def position_draw(seed: Column, position: Column) -> Column:
    """Uniform integer in [0, PRIME) for a position of the row behind ``seed``."""
    a = ((seed + position) * 16807 + 12345) % PRIME
    b = (a * a + seed) % PRIME
    return (b * 48271 + position) % PRIME


def position_draws(seed: np.ndarray, position: np.ndarray) -> np.ndarray:
    """``position_draw`` of arrays of 64-bit integers."""
    a = ((seed + position) * 16807 + 12345) % PRIME
    b = (a * a + seed) % PRIME
    return (b * 48271 + position) % PRIME


def below(probability: float) -> int:
    """Threshold of a position draw."""
    return int(probability * PRIME)
