"""Decimal rounding that looks at the exact binary value."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def round_exact(x: Column, places: int) -> Column:
    """Round to ``places`` decimals, correct for the double's exact value; true
    ties go to even.

    2.675 is a little less than it looks and becomes 2.67. The built-in
    functions round the printed digits instead. The product x * 10^places is
    taken with its rounding error (splitting x in two halves of 26 bits), and
    the error decides what looks like a tie. Values beyond 2^52 at that scale
    have no such decimals and are returned as they are.
    """
    s = F.lit(float(10**places))
    p = x * s
    big = x * F.lit(134217729.0)
    high = big - (big - x)
    error = (high * s - p) + (x - high) * s
    even = F.rint(p)
    off = p - even
    # a half that is none: what was lost in the product lies on the other side of it
    moved = F.when((F.abs(off) == 0.5) & (off * error > 0), off * 2).otherwise(F.lit(0.0))
    return F.when(F.abs(p) < F.lit(4503599627370496.0), (even + moved) / s).otherwise(x)


def round_exact_sql(x: str, places: int) -> str:
    """The same in SQL text, for checking."""
    s = f"{10**places}::DOUBLE"
    p, big = f"(({x}) * {s})", f"(({x}) * 134217729.0::DOUBLE)"
    high = f"({big} - ({big} - ({x})))"
    err = f"(({high} * {s} - {p}) + (({x}) - {high}) * {s})"
    rest = f"({p} - floor({p}))"
    up = f"({rest} > 0.5 OR ({rest} = 0.5 AND ({err} > 0 OR ({err} = 0 AND floor({p})::BIGINT % 2 <> 0))))"
    return f"((floor({p}) + CASE WHEN {up} THEN 1 ELSE 0 END) / {s})"
