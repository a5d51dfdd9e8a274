"""Numbers and lists as answer text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .numbers import round_exact
from .rows import let


def render_number(x: Column, whole: Column | bool = False) -> Column:
    """Plain decimal text: ``25.0``, ``0.125``, ``12345678.9``; ``25`` when ``whole``.

    Never an exponent, whatever the magnitude: the digits are those of the
    shortest text that reads back as the same number, with the point moved.
    NULL is written ``nan``.
    """
    whole = F.lit(whole) if isinstance(whole, bool) else whole
    text = x.cast("string")
    moved = let(F.struct(text.alias("t"), whole.alias("w")), _without_exponent)
    # the usual text, with a point and no exponent, is told by plain searches
    shown = (
        F.when(text.contains("E"), moved).when(whole, F.substring_index(text, ".", 1)).when(text.contains("."), text)
        .when(text.rlike("^-?[0-9]+$"), F.concat(text, F.lit(".0"))).otherwise(F.lower(text))
    )
    return F.coalesce(shown, F.lit("nan"))


def _without_exponent(s: Column) -> Column:
    """``-1.25E-7`` as ``-0.000000125``; ``w``: without decimals."""
    mantissa = F.substring_index(F.ltrim(s["t"], F.lit("-")), "E", 1)
    after = F.regexp_replace(F.substring_index(mantissa, ".", -1), "0+$", "")
    parts = F.struct(
        F.when(s["t"].startswith("-"), F.lit("-")).otherwise(F.lit("")).alias("sign"),
        F.concat(F.substring_index(mantissa, ".", 1), after).alias("digits"),
        # digits before the point
        (F.substring_index(s["t"], "E", -1).cast("int") + 1).alias("point"),
        s["w"].alias("w"),
    )

    def joined(p):
        digits, point = p["digits"], p["point"]
        left = F.when(point <= 0, F.lit("0")).otherwise(F.rpad(F.left(digits, point), point, F.lit("0")))
        right = F.when(point <= 0, F.concat(F.repeat(F.lit("0"), -point), digits)).otherwise(F.substr(digits, point + 1))
        right = F.when(right == "", F.lit("0")).otherwise(right)
        return F.concat(p["sign"], left, F.when(p["w"], F.lit("")).otherwise(F.concat(F.lit("."), right)))

    return let(parts, joined)


def render_list(items: Column) -> Column:
    """``[a, b, c]`` from an array of text."""
    return F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]"))


def fixed(x: Column, places: int = 3) -> Column:
    """Fixed decimals, rounded for the exact value."""
    return F.when(x.isNotNull(), F.format_string(f"%.{places}f", round_exact(x, places)))
