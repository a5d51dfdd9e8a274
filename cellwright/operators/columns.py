"""Column-axis questions whose answer is a list in row order or in value order.

``df`` carries an integer position (``row_id``); ``within`` names the keys of
the groups (tables, columns) that are answered at once. Lists come back as
rows with a ``position``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .positions import dense_position, number_rows, prefix_sum, previous_value


def non_empty(df: DataFrame, value: str, row_id="row_id", within=()) -> DataFrame:
    """Values that are present, renumbered in row order."""
    kept = df.select(*within, row_id, F.col(value).alias("value")).where(F.col("value").isNotNull())
    return dense_position(kept, row_id, within)


def unique_values(df: DataFrame, value: str, row_id="row_id", within=()) -> DataFrame:
    """Distinct values in the order first seen; NULL counts once."""
    firsts = df.groupBy(*within, F.col(value).alias("value")).agg(F.min(row_id).alias("first_row"))
    return dense_position(firsts, "first_row", within)


def value_present(df: DataFrame, value: str, requests: DataFrame, wanted: str) -> DataFrame:
    """Is ``wanted`` of each request in the column? NULL matches nothing."""
    seen = df.select(F.col(value).alias(wanted)).where(F.col(wanted).isNotNull()).distinct()
    return requests.join(seen.withColumn("_seen", F.lit(True)), wanted, "left").withColumn(
        "present", F.coalesce("_seen", F.lit(False))
    ).drop("_seen")


def extreme_n(
    df: DataFrame, value: str, n: int, largest: bool, row_id="row_id", within=()
) -> DataFrame:
    """The n largest or smallest values, ties in row order.

    Both forms keep at most n rows per task (and group) before any shuffle.
    """
    rows = df.select(*within, row_id, F.col(value).alias("value")).where(F.col("value").isNotNull())
    order = [F.desc("value") if largest else F.asc("value"), F.asc(row_id)]
    if not within:
        rows = rows.orderBy(*order).limit(n)
    rank = F.row_number().over(Window.partitionBy(*within).orderBy(*order))
    return (
        rows.withColumn("_rank", rank)
        .where(F.col("_rank") <= n)
        .withColumn("position", (F.col("_rank") - 1).cast("bigint"))
        .drop("_rank")
    )


def sorted_values(
    df: DataFrame, value: str, ascending=True, row_id="row_id", within=()
) -> DataFrame:
    """Every value with its place in sorted order, NULLs last in both directions."""
    c = F.col("value")
    rows = df.select(*within, row_id, F.col(value).alias("value"))
    order = [c.asc_nulls_last() if ascending else c.desc_nulls_last(), F.col(row_id)]
    return number_rows(rows, order, within, out="position")


def elementwise(df: DataFrame, value: str, fn, row_id="row_id", within=()) -> DataFrame:
    """One output value per cell; a projection."""
    return df.select(*within, row_id, fn(F.col(value)).alias("value"))


def add_constant(df, value, constant, row_id="row_id", within=()):
    return elementwise(df, value, lambda c: c + constant, row_id, within)


def fill_missing(df, value, filler, row_id="row_id", within=()):
    return elementwise(df, value, lambda c: F.coalesce(c, F.lit(filler)), row_id, within)


def square(df, value, row_id="row_id", within=()):
    return elementwise(df, value, lambda c: c * c, row_id, within)


def absolute(df, value, row_id="row_id", within=()):
    return elementwise(df, value, F.abs, row_id, within)


def _kept(df: DataFrame, value: str, keep: Column, fn, row_id, within) -> DataFrame:
    kept = df.where(keep).select(*within, row_id, fn(F.col(value)).alias("value"))
    return dense_position(kept, row_id, within)


def square_roots(df, value, row_id="row_id", within=()) -> DataFrame:
    """Roots of the values >= 0, renumbered; negative and missing values drop out."""
    return _kept(df, value, F.col(value) >= 0, F.sqrt, row_id, within)


def log_transform(df, value, row_id="row_id", within=()) -> DataFrame:
    """ln(|x| + 1e-10) of the present values, renumbered."""
    return _kept(
        df, value, F.col(value).isNotNull(), lambda c: F.ln(F.abs(c) + F.lit(1e-10)), row_id, within
    )


def cumulative_sum(df, value, row_id="row_id", within=()) -> DataFrame:
    rows = df.select(*within, row_id, F.col(value).alias("_v"))
    return prefix_sum(rows, row_id, "_v", within, out="value").drop("_v")


def differences(df, value, row_id="row_id", within=()) -> DataFrame:
    """Value minus the value one row earlier; NULL for the first row."""
    rows = df.select(*within, row_id, F.col(value).alias("_v"))
    return previous_value(rows, row_id, "_v", within, out="_p").select(
        *within, row_id, (F.col("_v") - F.col("_p")).alias("value")
    )


def slice_result(
    df: DataFrame, position: str, draw: Column, size: int = 5, within=()
) -> DataFrame:
    """A random run of at most ``size`` list entries per group, end exclusive.

    ``draw`` is uniform in [0, 1) and fixed per group.
    """
    within = list(within)
    lengths = df.groupBy(*within).agg(F.count(F.lit(1)).alias("_n"))
    bounds = lengths.select(
        *within,
        F.when(F.col("_n") <= size, F.lit(0))
        .otherwise(F.floor(draw * (F.col("_n") - size + 1)))
        .cast("bigint")
        .alias("slice_start"),
        F.least(F.col("_n"), F.lit(size)).alias("_len"),
    )
    end = F.col("slice_start") + F.col("_len")
    return (
        df.join(bounds, within)
        .withColumn("slice_end", end)
        .where((F.col(position) >= F.col("slice_start")) & (F.col(position) < F.col("slice_end")))
        .drop("_len")
    )
