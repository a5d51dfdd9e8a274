"""Wide tables, their long form (cells), and access by (row, column)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

#: every whole number up to this one is a double
HELD_WHOLE = 1 << 53
NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def is_numeric(field: T.StructField) -> bool:
    return isinstance(field.dataType, NUMERIC)


def numeric_columns(df: DataFrame, skip=()) -> list[str]:
    return [f.name for f in df.schema.fields if is_numeric(f) and f.name not in skip]


def nan_to_null(df: DataFrame) -> DataFrame:
    """Missing is NULL only: turn NaN in floating columns into NULL."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    return df.select(
        *[F.when(~F.isnan(c), F.col(c)).alias(c) if c in floats else F.col(c) for c in df.columns]
    )


def _num(df: DataFrame, name: str) -> Column:
    field = df.schema[name]
    if is_numeric(field) or isinstance(field.dataType, T.BooleanType):
        return F.col(name).cast("double")
    return F.lit(None).cast("double")


def _str(df: DataFrame, name: str) -> Column:
    field = df.schema[name]
    if is_numeric(field) or isinstance(field.dataType, T.BooleanType):
        return F.lit(None).cast("string")
    return F.col(name).cast("string")


def _exact(df: DataFrame, name: str) -> Column:
    """Digits of a whole or decimal number that no double holds, else NULL."""
    kind = df.schema[name].dataType
    if not isinstance(kind, (T.LongType, T.DecimalType)):
        return F.lit(None).cast("string")
    wide = "decimal(38,18)" if isinstance(kind, T.DecimalType) and kind.scale else "decimal(38,0)"
    back = F.col(name).cast("double").try_cast(wide)
    lost = ~F.coalesce(back == F.col(name).cast(wide), F.lit(False))
    if isinstance(kind, T.LongType):
        # a double holds whole numbers up to 2^53: only larger ones are tried
        lost = ~F.col(name).between(-HELD_WHOLE, HELD_WHOLE) & lost
    return F.when(lost, F.col(name).cast("string"))


def cell_struct(df: DataFrame, name: str) -> Column:
    """One cell as (v_num, v_str): numbers and booleans in v_num, the rest as text."""
    return F.struct(_num(df, name).alias("v_num"), _str(df, name).alias("v_str"))


def to_cells(df: DataFrame, table_id, row_id="row_id", columns=None) -> DataFrame:
    """Long form: table_id, row_id, col_id, col_name, col_type, v_num, v_str, v_exact. NULL cells are kept.

    ``v_exact`` has the digits of whole and decimal numbers beyond a double's
    precision, so that different numbers stay different. ``columns`` may be a list
    of names, or a dict of names to their ordinals.
    """
    key_cols = [c for c in (table_id, row_id) if isinstance(c, str)]
    columns = columns or [c for c in df.columns if c not in key_cols]
    cells = [
        F.struct(
            F.lit(i).alias("col_id"),
            F.lit(c).alias("col_name"),
            F.lit(df.schema[c].dataType.simpleString()).alias("col_type"),
            _num(df, c).alias("v_num"),
            _str(df, c).alias("v_str"),
            _exact(df, c).alias("v_exact"),
        )
        for c, i in (columns.items() if isinstance(columns, dict) else zip(columns, range(len(columns))))
    ]
    keys = [
        (k if isinstance(k, Column) else F.col(k)).alias(n)
        for k, n in ((table_id, "table_id"), (row_id, "row_id"))
        if k is not None
    ]
    return df.select(*keys, F.inline(F.array(*cells)))


def pick(df: DataFrame, columns, col_id: Column) -> Column:
    """The cell of this row in column number ``col_id`` (NULL when out of range)."""
    chosen = F.lit(None).cast("struct<v_num:double,v_str:string>")
    for i, c in reversed(list(enumerate(columns))):
        chosen = F.when(col_id == i, cell_struct(df, c)).otherwise(chosen)
    return chosen


def cell_lookup(df: DataFrame, requests: DataFrame, columns, row_id="row_id") -> DataFrame:
    """Cell per request (``row``, ``col``); out of range or missing gives NULL."""
    # only asked-for rows reach the outer join; few requests are broadcast here
    asked = requests.select("row").distinct()
    rows = df.select(F.col(row_id).alias("row"), *columns).join(asked, "row", "left_semi")
    cell = pick(df, columns, F.col("col"))
    return (
        requests.join(rows, "row", "left")
        .withColumn("_cell", cell)
        .withColumn("v_num", F.col("_cell.v_num"))
        .withColumn("v_str", F.col("_cell.v_str"))
        .drop("_cell", *columns)
    )


def neighbors(df: DataFrame, requests: DataFrame, columns, row_id="row_id") -> DataFrame:
    """Cells above, below, left and right of each request (``request_id, row, col``)."""
    sides = [("above", -1, 0), ("below", 1, 0), ("left", 0, -1), ("right", 0, 1)]
    asked = requests.select(
        "request_id",
        F.col("row").alias("at_row"),
        F.col("col").alias("at_col"),
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(s).alias("side"),
                        (F.col("row") + dr).alias("row"),
                        (F.col("col") + dc).alias("col"),
                    )
                    for s, dr, dc in sides
                ]
            )
        ),
    )
    found = cell_lookup(df, asked, columns, row_id)
    out = []
    for s, _, _ in sides:
        for v in ("v_num", "v_str"):
            out.append(F.max(F.when(F.col("side") == s, F.col(v))).alias(f"{s}_{v[2:]}"))
    return found.groupBy("request_id", F.col("at_row").alias("row"), F.col("at_col").alias("col")).agg(*out)


def cell_pairs(df: DataFrame, requests: DataFrame, columns, op: str, row_id="row_id") -> DataFrame:
    """Sum or difference of two numeric cells per request
    (``request_id, row1, col1, row2, col2``)."""
    ends = requests.select(
        "request_id",
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(k).alias("which"),
                        F.col(f"row{k}").alias("row"),
                        F.col(f"col{k}").alias("col"),
                    )
                    for k in (1, 2)
                ]
            )
        ),
    )
    found = cell_lookup(df, ends, columns, row_id)
    first = F.max(F.when(F.col("which") == 1, F.col("v_num")))
    second = F.max(F.when(F.col("which") == 2, F.col("v_num")))
    value = first + second if op == "+" else first - second
    answers = found.groupBy("request_id").agg(value.alias("result"))
    return requests.join(answers, "request_id", "left")


def find_cells(df: DataFrame, columns, value, row_id="row_id") -> DataFrame:
    """Every (row, col) whose number equals ``value``; only hits are expanded."""
    hits = F.filter(
        F.array(*[F.when(F.col(c) == value, F.lit(i)) for i, c in enumerate(columns)]),
        lambda i: i.isNotNull(),
    )
    any_hit = F.lit(False)
    for c in columns:
        any_hit = any_hit | F.coalesce(F.col(c) == value, F.lit(False))
    return df.where(any_hit).select(F.col(row_id).alias("row"), F.explode(hits).alias("col"))


def count_value(df: DataFrame, columns, value) -> DataFrame:
    """How often ``value`` occurs in the table, one pass."""
    per_column = [F.coalesce((F.col(c) == value).cast("bigint"), F.lit(0)) for c in columns]
    total = per_column[0]
    for c in per_column[1:]:
        total = total + c
    return df.agg(F.coalesce(F.sum(total), F.lit(0)).cast("bigint").alias("occurrences"))


def compare_columns(df: DataFrame, columns) -> DataFrame:
    """All column pairs: same declared type and same values, NULL equal to NULL; one pass."""
    dtypes = dict(df.dtypes)
    pairs, aggs = [], []
    for i, a in enumerate(columns):
        for j in range(i, len(columns)):
            b = columns[j]
            if dtypes[a] == dtypes[b]:
                aggs.append(F.coalesce(F.bool_and(F.col(a).eqNullSafe(F.col(b))), F.lit(True)).alias(f"p{i}_{j}"))
                pairs.append((i, j, F.col(f"p{i}_{j}")))
            else:
                pairs.append((i, j, F.lit(False)))
    rows = [
        F.struct(F.lit(i).alias("col1"), F.lit(j).alias("col2"), same.alias("identical"))
        for i, j, same in pairs
    ]
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def compare_rows(df: DataFrame, requests: DataFrame, columns, row_id="row_id") -> DataFrame:
    """Are rows ``row1`` and ``row2`` of each request identical? NULL equals NULL; NULL if one does not exist."""
    ends = requests.select(
        "request_id", "row1", "row2",
        F.explode(F.array("row1", "row2")).alias("row"),
    )
    asked = ends.select("row").distinct()
    rows = df.select(F.col(row_id).alias("row"), F.struct(*columns).alias("content")).join(asked, "row", "left_semi")
    # the struct of a row that exists is never NULL, so both must have been found
    same = F.when(F.count("content") == 2, F.min("content").eqNullSafe(F.max("content")))
    return ends.join(rows, "row", "left").groupBy("request_id", "row1", "row2").agg(same.alias("identical"))
