"""Row-axis questions: every row answered from its own cells, without a shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import rows as R


def row_array(columns):
    return F.array(*[F.col(c).cast("double") for c in columns])


def row_answers(df: DataFrame, columns, answers: dict, keep=()) -> DataFrame:
    """``keep`` plus one column per entry of ``answers`` (a function of the row array)."""
    cells = df.select(*keep, row_array(columns).alias("_row"))
    return cells.select(*keep, *[fn(F.col("_row")).alias(n) for n, fn in answers.items()])


def spread_array(fn, width: int):
    """Turn a list answer into ``p0 .. p<width-1>``; missing places are NULL."""
    return {f"p{i}": (lambda a, i=i: F.get(fn(a), F.lit(i))) for i in range(width)}


def _sum(parts):
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return total


def row_basics(columns) -> dict:
    """Count, empties, min, max, range, sum, mean and deviation of a row as plain
    expressions over its columns, which stay inside generated code."""
    cells = [F.col(c).cast("double") for c in columns]
    both = cells * 2 if len(cells) == 1 else cells  # least and greatest want two
    n = _sum([c.isNotNull().cast("int") for c in cells])
    total = _sum([F.coalesce(c, F.lit(0.0)) for c in cells])
    mean = F.try_divide(total, n.cast("double"))
    squares = _sum([F.when(c.isNotNull(), (c - mean) * (c - mean)).otherwise(F.lit(0.0)) for c in cells])
    return {
        "n_values": n.cast("bigint"),
        "n_empty": (F.lit(len(cells)) - n).cast("bigint"),
        "has_missing": n < len(cells),
        "min_value": F.least(*both),
        "max_value": F.greatest(*both),
        "value_range": F.greatest(*both) - F.least(*both),
        "sum_value": total,
        "mean_value": mean,
        "std_value": F.when(n > 1, F.sqrt(squares / (n - 1).cast("double"))),
    }


def row_aggregates(df: DataFrame, columns, measures, keep=()) -> DataFrame:
    """The chosen measures of every row."""
    basics = row_basics(columns)
    return df.select(*keep, *[basics[m].alias(m) for m in measures])


def row_profile(df: DataFrame, columns, keep=()) -> DataFrame:
    basics = row_basics(columns)
    cells = row_array(columns)
    return df.select(
        *keep,
        *[basics[m].alias(m) for m in basics if m != "has_missing"],
        R.median(cells).alias("median_value"),
        R.mode(cells).alias("mode_value"),
    )
