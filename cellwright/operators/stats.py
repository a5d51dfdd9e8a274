"""Aggregates of columns: one pass where partial aggregation suffices, exact
distributed order statistics where it does not."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.rows import lerp
from ..session import store

BASICS = {
    "n_values": lambda c: F.count(c),
    "n_empty": lambda c: F.count_if(c.isNull()),
    "has_empty": lambda c: F.coalesce(F.bool_or(c.isNull()), F.lit(False)),
    "min_value": lambda c: F.min(c),
    "max_value": lambda c: F.max(c),
    "value_range": lambda c: F.max(c) - F.min(c),
    "sum_value": lambda c: F.coalesce(F.sum(c), F.lit(0.0)),
    "mean_value": lambda c: F.avg(c),
    "std_value": lambda c: F.stddev_samp(c),
}


def melt(df: DataFrame, columns, keys=()) -> DataFrame:
    """keys, col_id, col_name, v: the given numeric columns under each other."""
    cells = [
        F.struct(F.lit(i).alias("col_id"), F.lit(c).alias("col_name"), F.col(c).cast("double").alias("v"))
        for i, c in enumerate(columns)
    ]
    return df.select(*keys, F.inline(F.array(*cells)))


def column_aggregates(df: DataFrame, columns, measures=tuple(BASICS), keys=()) -> DataFrame:
    """The chosen measures of every column in one aggregate, one row per column (and key)."""
    aggs = [
        F.struct(
            F.lit(i).alias("col_id"),
            F.lit(c).alias("col_name"),
            *[BASICS[m](F.col(c).cast("double")).alias(m) for m in measures],
        ).alias(f"_{i}")
        for i, c in enumerate(columns)
    ]
    one = df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)
    return one.select(*keys, F.inline(F.array(*[F.col(f"_{i}") for i in range(len(columns))])))


def any_missing(df: DataFrame, columns) -> DataFrame:
    """col_id, col_name, n_empty, has_empty for columns of any type."""
    aggs = [
        F.struct(
            F.lit(i).alias("col_id"),
            F.lit(c).alias("col_name"),
            F.count_if(F.col(c).isNull()).alias("n_empty"),
            F.coalesce(F.bool_or(F.col(c).isNull()), F.lit(False)).alias("has_empty"),
        ).alias(f"_{i}")
        for i, c in enumerate(columns)
    ]
    return df.agg(*aggs).select(F.inline(F.array(*[F.col(f"_{i}") for i in range(len(columns))])))


def value_counts(values: DataFrame, keys, value="v") -> DataFrame:
    """keys, value, c: how often each present value occurs (combined before the shuffle)."""
    return (
        values.where(F.col(value).isNotNull())
        .groupBy(*keys, value)
        .agg(F.count(F.lit(1)).alias("c"))
    )


def distinct_and_mode(values: DataFrame, keys, value="v") -> DataFrame:
    """n_distinct and mode_value (smallest on ties) per group.

    Works on value counts, so no task ever holds the values of a whole group.
    """
    return _distinct_and_mode(_inner_names(value_counts(values, keys, value), keys, value), keys)


def _inner_names(counts: DataFrame, keys, value) -> DataFrame:
    """Names that no key has: ``_value`` and ``_count``."""
    return counts.toDF(*keys, "_value", "_count")


def _distinct_and_mode(counts: DataFrame, keys) -> DataFrame:
    best = F.min(F.struct((-F.col("_count")).alias("c"), F.col("_value").alias("v")))
    return (
        counts.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n_distinct"), best.alias("_best"))
        .withColumn("mode_value", F.col("_best.v"))
        .drop("_best")
    )


def exact_quantiles(values: DataFrame, keys, probs: dict[str, float], value="v") -> DataFrame:
    """Exact interpolated quantiles per group, one column per name in ``probs``.

    They are read off range-partitioned value counts, so no task sees a whole group.
    """
    return _quantiles_by_rank(ranked_counts(values, keys, value), list(keys), probs)


def ranked_counts(values: DataFrame, keys, value="v") -> DataFrame:
    """Value counts in ranges of (keys, ``_value``), stored; ``_part`` numbers the ranges."""
    return store(
        _inner_names(value_counts(values, list(keys), value), keys, value)
        .repartitionByRange(*keys, "_value")
        .withColumn("_part", F.spark_partition_id()),
        "ranked",
    )


def _quantiles_by_rank(placed: DataFrame, keys, probs) -> DataFrame:
    runs = placed.groupBy(*keys, "_part").agg(F.sum("_count").alias("_t"))
    by_group = Window.partitionBy(*keys)
    before = by_group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    wanted = F.array(
        *[
            F.struct(F.lit(name).alias("name"), F.lit(p).alias("p"))
            for name, p in probs.items()
        ]
    )
    runs = runs.select(
        *keys, "_part", "_t",
        F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_off"),
        F.sum("_t").over(by_group).alias("_n"),
    )
    # a step of its own: an explode beside window functions would run before them
    runs = runs.withColumn("w", F.explode(wanted))
    at = F.col("w.p") * (F.col("_n") - 1)
    ranks = runs.select(
        *keys, "_part", "_t", "_off", F.col("w.name").alias("name"),
        (at - F.floor(at)).alias("_frac"),
        F.explode(F.array(F.struct(F.lit("low").alias("end"), F.floor(at).alias("rank")),
                          F.struct(F.lit("high").alias("end"), F.ceil(at).alias("rank")))).alias("r"),
    ).where((F.col("r.rank") >= F.col("_off")) & (F.col("r.rank") < F.col("_off") + F.col("_t")))
    # only the few runs that hold a wanted rank are ordered
    hit = ranks.select(*keys, "_part", "_off").distinct()
    upto = Window.partitionBy(*keys, "_part").orderBy("_value").rowsBetween(Window.unboundedPreceding, 0)
    ordered = placed.join(hit, [*keys, "_part"]).withColumn(
        "_upto", F.col("_off") + F.sum("_count").over(upto)
    ).drop("_off")
    found = (
        ordered.join(ranks, [*keys, "_part"])
        .where((F.col("r.rank") < F.col("_upto")) & (F.col("r.rank") >= F.col("_upto") - F.col("_count")))
        .groupBy(*keys, "name", "_frac")
        .agg(
            F.max(F.when(F.col("r.end") == "low", F.col("_value"))).alias("_low"),
            F.max(F.when(F.col("r.end") == "high", F.col("_value"))).alias("_high"),
        )
        .withColumn("q", lerp(F.col("_low"), F.col("_high"), F.col("_frac")))
    )
    return found.groupBy(*keys).agg(
        *[F.max(F.when(F.col("name") == n, F.col("q"))).alias(n) for n in probs]
    )


def profile(df: DataFrame, columns, keys=()) -> DataFrame:
    """Count, empties, distinct, min, max, range, sum, mean, std, quartiles and
    mode of every numeric column, per key when keys are given."""
    group = [*keys, "col_id", "col_name"]
    values = melt(df, columns, keys)
    basics = column_aggregates(df, columns, tuple(BASICS), keys)
    counts = ranked_counts(values, group)
    tops = _distinct_and_mode(counts, group)
    probs = {"q1": 0.25, "median_value": 0.5, "q3": 0.75}
    quartiles = _quantiles_by_rank(counts, group, probs)
    return (
        basics.join(tops, group, "left")
        .join(quartiles, group, "left")
        .withColumn("n_distinct", F.coalesce("n_distinct", F.lit(0)))
    )


# ---------------------------------------------------------------- whole table
def table_sum(df: DataFrame, columns) -> DataFrame:
    total = F.lit(0.0)
    for c in columns:
        total = total + F.coalesce(F.sum(F.col(c).cast("double")), F.lit(0.0))
    return df.agg(total.alias("table_sum"))


def table_mean(df: DataFrame, columns) -> DataFrame:
    """Mean of the column means; columns without values do not count."""
    means = F.filter(F.array(*[F.avg(F.col(c).cast("double")) for c in columns]), lambda m: m.isNotNull())
    one = df.agg(means.alias("_m"))
    total = F.aggregate("_m", F.lit(0.0), lambda s, x: s + x)
    return one.select(F.try_divide(total, F.size("_m").cast("double")).alias("table_mean"))


# ---------------------------------------------------------------- correlation
def _pair_stats(x: Column, y: Column) -> Column:
    """Means, centred sums and Pearson r over rows where both are present; one pass."""
    both = x.isNotNull() & y.isNotNull()
    cx, cy = F.when(both, x.cast("double")), F.when(both, y.cast("double"))
    n = F.count_if(both)
    sxx, syy, sxy = F.var_pop(cx) * n, F.var_pop(cy) * n, F.covar_pop(cx, cy) * n
    return F.struct(
        n.alias("n_samples"),
        F.avg(cx).alias("x_mean"),
        F.avg(cy).alias("y_mean"),
        sxy.alias("sum_product_dev"),
        sxx.alias("sum_squared_dev_x"),
        syy.alias("sum_squared_dev_y"),
        F.try_divide(sxy, F.sqrt(sxx) * F.sqrt(syy)).alias("correlation"),
    )


def correlation_steps(df: DataFrame, x: str, y: str, keys=()) -> DataFrame:
    """The intermediate values and r; r is NULL when a column is constant."""
    s = _pair_stats(F.col(x), F.col(y)).alias("s")
    return (df.groupBy(*keys).agg(s) if keys else df.agg(s)).select(*keys, "s.*")


def correlation(df: DataFrame, x: str, y: str, keys=()) -> DataFrame:
    return correlation_steps(df, x, y, keys).select(*keys, "correlation")


def all_correlations(df: DataFrame, columns, keys=()) -> DataFrame:
    """r for every pair of columns in a single aggregate."""
    pairs = [(i, j) for i in range(len(columns)) for j in range(i + 1, len(columns))]
    aggs = [_pair_stats(F.col(columns[i]), F.col(columns[j])).alias(f"_{i}_{j}") for i, j in pairs]
    rows = [
        F.struct(
            F.lit(i).alias("col1"), F.lit(j).alias("col2"),
            F.col(f"_{i}_{j}.n_samples").alias("n_samples"),
            F.col(f"_{i}_{j}.correlation").alias("correlation"),
        )
        for i, j in pairs
    ]
    one = df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)
    return one.select(*keys, F.inline(F.array(*rows)))


# ---------------------------------------------------------------- scaling
METHODS = ("normalize", "standardize", "robust_scale")


def scaling_stats(df: DataFrame, value: str, method: str, keys=()) -> DataFrame:
    """The centre and the width that ``method`` subtracts and divides by."""
    v = F.col(value).cast("double")
    if method == "normalize":
        aggs = [F.min(v).alias("center"), (F.max(v) - F.min(v)).alias("width")]
    elif method == "standardize":
        aggs = [F.avg(v).alias("center"), F.stddev_samp(v).alias("width")]
    elif method == "robust_scale":
        q = exact_quantiles(
            df, keys, {"q1": 0.25, "center": 0.5, "q3": 0.75}, value
        )
        return q.select(*keys, "center", (F.col("q3") - F.col("q1")).alias("width"))
    else:
        raise ValueError(f"unknown method: {method}")
    return df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)


def scale(df: DataFrame, value: str, method: str, row_id="row_id", keys=()) -> DataFrame:
    """Scaled values; missing ones drop out, a zero width gives NULL.

    One table: the statistics enter as a scalar subquery. Many tables: an
    equi-join on the keys, which AQE turns into a broadcast when the
    statistics are small and splits when one table is huge.
    """
    keys = list(keys)
    stats = scaling_stats(df, value, method, keys)
    rows = df.where(F.col(value).isNotNull())
    v = F.col(value).cast("double")
    if keys:
        rows = rows.join(stats, keys)
        center, width = F.col("center"), F.col("width")
    else:
        one = stats.select(F.struct("center", "width")).scalar()
        center, width = one["center"], one["width"]
    return rows.select(*keys, row_id, F.try_divide(v - center, width).alias("value"))


def scale_steps(df: DataFrame, value: str, method: str) -> DataFrame:
    """One row: statistics before scaling, and the ones to check after it."""
    v = F.col(value).cast("double")
    before = df.agg(
        F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"),
        F.min(v).alias("min"), F.max(v).alias("max"),
    )
    probs = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    quart = exact_quantiles(df, [], probs, value)
    scaled = scale(df, value, method)
    s = F.col("value")
    if method == "normalize":
        after = scaled.agg(F.min(s).alias("after_min"), F.max(s).alias("after_max"), F.avg(s).alias("after_mean"))
    elif method == "standardize":
        after = scaled.agg(F.avg(s).alias("after_mean"), F.stddev_samp(s).alias("after_std"))
    else:
        q = exact_quantiles(scaled, [], probs, "value")
        after = q.select(F.col("median").alias("after_median"), (F.col("q3") - F.col("q1")).alias("after_iqr"))
    q, a = quart.select(F.struct("*")).scalar(), after.select(F.struct("*")).scalar()
    return before.select(
        "*", *[q[c].alias(c) for c in probs], (q["q3"] - q["q1"]).alias("iqr"),
        *[a[c].alias(c) for c in after.columns],
    )
