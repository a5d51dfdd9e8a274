"""Seeded draws that do not depend on partitioning or on the engine."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def uniform(seed: int, *keys) -> Column:
    """A double in [0, 1) fixed by the seed and the keys (columns or names)."""
    parts = [F.lit(str(seed))]
    for key in keys:
        parts.append((key if isinstance(key, Column) else F.col(key)).cast("string"))
    head = F.substring(F.md5(F.concat_ws("|", *parts)), 1, 8)
    return F.conv(head, 16, 10).cast("bigint") / F.lit(4294967296.0)


def draw_int(u: Column, low, high) -> Column:
    """Integer in [low, high], both ends included."""
    low = low if isinstance(low, Column) else F.lit(low)
    high = high if isinstance(high, Column) else F.lit(high)
    return (low + F.floor(u * (high - low + 1))).cast("bigint")


def draw_item(u: Column, items: Column) -> Column:
    """Uniform element of an array; NULL when the array is empty."""
    return F.get(items, F.floor(u * F.size(items)).cast("int"))
