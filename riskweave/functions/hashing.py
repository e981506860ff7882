"""Hash-based draws: the same rows and resamples on any partitioning and any engine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash32(text: Column) -> Column:
    """First 32 bits of the MD5 of ``text`` as a non-negative bigint."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def seeded_hash(seed: int, *parts: Column) -> Column:
    """``hash32`` of ``seed:part:part...``."""
    return hash32(F.concat_ws(":", F.lit(str(seed)), *[p.cast("string") for p in parts]))


def resample_index(seed: int, iteration: Column, draw: Column, size: Column) -> Column:
    """Zero-based row drawn, with replacement, by one draw of one bootstrap iteration."""
    return seeded_hash(seed, iteration, draw) % size


def in_fraction(seed: int, key: Column, fraction: float, grain: int = 1000) -> Column:
    """True for about ``fraction`` of the keys, always the same ones for a seed."""
    return seeded_hash(seed, key) % grain < round(fraction * grain)
