"""Numeric expressions shared by metrics and models."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sigmoid_clip(z: Column, bound: float = 500.0) -> Column:
    clipped = F.greatest(F.least(z, F.lit(bound)), F.lit(-bound))
    return 1.0 / (1.0 + F.exp(-clipped))


def ratio(top: Column, bottom: Column) -> Column:
    """top / bottom, 0 on a zero denominator."""
    return F.when(bottom != 0, top.cast("double") / bottom).otherwise(F.lit(0.0))


def hash_key(seed: int | str, *parts: Column) -> Column:
    """Hex digest of `seed:part:…`: a seeded order that does not depend on partitions."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[p.cast("string") for p in parts]))


def hash_int(digest: Column, start: int = 1, digits: int = 8) -> Column:
    return F.conv(F.substring(digest, start, digits), 16, 10).cast("bigint")


def hash_unit(digest: Column, start: int = 1, digits: int = 8) -> Column:
    """A number in [0, 1) from hex digits of a digest."""
    return hash_int(digest, start, digits) / F.lit(float(16**digits))
