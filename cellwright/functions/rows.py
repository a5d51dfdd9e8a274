"""Functions of one bounded array of numbers: a row of a table, or a column of
a table that the row budget has made small. No shuffle, no Python."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def present(a: Column) -> Column:
    return F.filter(a, lambda x: x.isNotNull())


def total(a: Column) -> Column:
    """Sum without NULLs; 0 when nothing is left."""
    return F.aggregate(present(a), F.lit(0.0), lambda s, x: s + x)


def mean(a: Column) -> Column:
    return F.try_divide(total(a), F.size(present(a)).cast("double"))


def highest(a: Column) -> Column:
    return F.array_max(a)


def lowest(a: Column) -> Column:
    return F.array_min(a)


def spread(a: Column) -> Column:
    return F.array_max(a) - F.array_min(a)


def empty_count(a: Column) -> Column:
    return (F.size(a) - F.size(present(a))).cast("bigint")


def has_empty(a: Column) -> Column:
    return F.exists(a, lambda x: x.isNull())


def contains(a: Column, value) -> Column:
    return F.coalesce(F.array_contains(a, value), F.lit(False))


def let(value: Column, fn) -> Column:
    """``fn(value)`` with ``value`` computed once, however often ``fn`` uses it."""
    return F.get(F.transform(F.array(value), fn), F.lit(0))


def lerp(low: Column, high: Column, t: Column) -> Column:
    """Between ``low`` (t = 0) and ``high`` (t = 1), measured from the nearer end."""
    gap = high - low
    return F.when(t < 0.5, low + gap * t).otherwise(high - gap * (1 - t))


def quantile(a: Column, p: float) -> Column:
    """Linear interpolation between the two closest ranks; NULL when empty."""

    def between(s):
        at = F.lit(p) * (F.size(s) - 1)
        low = F.get(s, F.floor(at).cast("int"))
        high = F.get(s, F.ceil(at).cast("int"))
        return lerp(low, high, at - F.floor(at))

    return let(F.array_sort(present(a)), between)


def median(a: Column) -> Column:
    """Middle value, or half the sum of the two middle ones."""

    def middle(s):
        n = F.size(s)
        return (F.get(s, ((n - 1) / 2).cast("int")) + F.get(s, (n / 2).cast("int"))) / 2.0

    return let(F.array_sort(present(a)), middle)


def mode(a: Column) -> Column:
    """Most frequent value, the smallest on ties; NULL when empty.

    One walk over the sorted values, keeping the current and the best run.
    """
    start = F.struct(
        F.lit(None).cast("double").alias("last"),
        F.lit(0).alias("run"),
        F.lit(None).cast("double").alias("best"),
        F.lit(0).alias("best_run"),
    )

    def step(s, x):
        run = F.when(s["last"].eqNullSafe(x), s["run"] + 1).otherwise(F.lit(1))
        return F.struct(
            x.alias("last"),
            run.alias("run"),
            F.when(run > s["best_run"], x).otherwise(s["best"]).alias("best"),
            F.greatest(run, s["best_run"]).alias("best_run"),
        )

    return F.aggregate(F.array_sort(present(a)), start, step, lambda s: s["best"])


def ascending(a: Column) -> Column:
    return F.array_sort(a)


def descending(a: Column) -> Column:
    return F.sort_array(a, asc=False)


def running(a: Column, start=0, end=None) -> Column:
    """Running sums at positions [start, end); NULL stays NULL."""
    end = F.size(a) if end is None else end
    start = F.lit(start) if isinstance(start, int) else start
    window = F.slice(a, start + 1, F.greatest(end - start, F.lit(0)))
    return F.transform(
        window,
        lambda x, i: F.when(x.isNotNull(), total(F.slice(a, F.lit(1), start + i + 1))),
    )


def differences(a: Column) -> Column:
    """Each value minus the one before; the first is NULL."""
    return F.transform(a, lambda x, i: F.when(i > 0, x - F.get(a, i - 1)))


def deviation(a: Column) -> Column:
    """Sample standard deviation; NULL below two values."""
    squares = let(
        mean(a),
        lambda m: F.aggregate(present(a), F.lit(0.0), lambda s, x: s + (x - m) * (x - m)),
    )
    n = F.size(present(a))
    return F.when(n > 1, F.sqrt(squares / (n - 1).cast("double")))
