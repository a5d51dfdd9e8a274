"""Corpus profiling: table sizes, column kinds, label choice, metadata records.

Input is the cells form (table_id, col_id, col_name, col_type, v_num, v_str, v_exact),
so tables of any schema are profiled in one aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.draws import uniform
from ..functions.text import render_number
from ..session import store

WHOLE_TYPES = ("tinyint", "smallint", "int", "bigint")
NUMERIC_TYPES = (*WHOLE_TYPES, "float", "double")
TIME_TYPES = ("timestamp", "timestamp_ntz", "date", "interval day to second")
#: fixed values of the label heuristic
LONGEST_LABEL = 256
CATEGORICAL_SHARE = 0.1
CATEGORICAL_PREFERENCE = 0.9


def number_text(number: Column, kind: Column) -> Column:
    """A number of a column of this type as text; NULL stays NULL."""
    return F.when(number.isNotNull(), render_number(number, kind.isin(*WHOLE_TYPES) | kind.rlike(r"^decimal\(\d+,0\)$")))


def cell_text(col_type: str | Column = "col_type") -> Column:
    """A cell as text; NULL stays NULL."""
    kind = F.col(col_type) if isinstance(col_type, str) else col_type
    return F.coalesce("v_str", "v_exact", number_text(F.col("v_num"), kind))


def categorical_flag(col_type: Column) -> Column:
    """0 for numbers; 1 for booleans, text and everything else."""
    return F.when(col_type.isin(*NUMERIC_TYPES) | col_type.startswith("decimal"), F.lit(0)).otherwise(F.lit(1))


def _digest(text: Column) -> Column:
    """What tells texts apart when they are counted: short ones themselves, longer ones by their 128-bit digest."""
    raw = text.cast("binary")
    return F.when(F.octet_length(raw) < 16, raw).otherwise(F.unhex(F.md5(raw)))


def column_profile(cells: DataFrame) -> DataFrame:
    """One row per column: n_rows, n_distinct, max_len, active, categorical.

    Cells are reduced to the different values of each column first, numbers as numbers and texts as
    digests, so no long text is shuffled and numbers are written out once for each value.
    """
    if "v_exact" not in cells.columns:
        cells = cells.withColumn("v_exact", F.lit(None).cast("string"))
    column = ["table_id", "col_id", "col_name", "col_type"]
    text, number = F.coalesce("v_str", "v_exact"), F.col("v_num")
    keyed = cells.select(
        *column, F.when(text.isNull(), number).alias("_number"),
        # grouping takes both zeros for one, their texts differ
        F.when(text.isNull() & (number == 0), number.cast("string").startswith("-")).alias("_minus"),
        _digest(text).alias("_text"), F.length(text).alias("_length"),
        F.coalesce(number != 0, F.length("v_str") > 0, F.lit(False)).alias("_filled"),
    )
    values = keyed.groupBy(*column, "_number", "_minus", "_text").agg(
        F.count(F.lit(1)).alias("_n"), F.max("_length").alias("_length"), F.bool_or("_filled").alias("_filled"),
    )
    signed = F.when(F.col("_minus"), F.lit(-0.0)).otherwise(F.col("_number"))
    shown = values.withColumn("_shown", number_text(signed, F.col("col_type")))
    return shown.select(
        *column, "_n", "_filled", F.coalesce("_text", _digest(F.col("_shown"))).alias("_digest"),
        F.coalesce("_length", F.length("_shown")).alias("_length"),
    ).groupBy(*column).agg(
        F.sum("_n").alias("n_rows"),
        F.count_distinct("_digest").alias("n_distinct"),
        F.max("_length").alias("max_len"),
        F.coalesce(F.bool_or("_filled"), F.lit(False)).alias("active"),
    ).withColumn("categorical", categorical_flag(F.col("col_type")))


def table_dims(profile: DataFrame) -> DataFrame:
    return profile.groupBy("table_id").agg(
        F.max("n_rows").alias("num_rows"),
        F.count(F.lit(1)).alias("num_cols"),
        F.count_if("active").alias("active_cols"),
    )


def label_candidates(profile: DataFrame) -> DataFrame:
    """Columns that may serve as label, with their kind."""
    kept = profile.where(
        ~F.col("col_name").startswith("Unnamed:")
        & (F.col("n_distinct") != F.col("n_rows"))
        & ~F.col("col_type").isin(*TIME_TYPES)
        & (F.coalesce("max_len", F.lit(0)) <= LONGEST_LABEL)
    )
    few = F.col("n_distinct") < CATEGORICAL_SHARE * F.col("n_rows")
    return kept.withColumn("kind", F.when(few, F.lit("categorical")).otherwise(F.lit("continuous")))


def pick_label(candidates: DataFrame, tables: DataFrame, seed: int) -> DataFrame:
    """table_id, label_index, num_classes; -1 and 0 for tables without a candidate.

    A categorical column is preferred in nine of ten tables that have both
    kinds; within the kind the choice is uniform.
    """
    drawn = candidates.withColumn("_u", uniform(seed, "table_id", "col_id", F.lit("label")))
    best = F.struct("_u", "col_id", "n_distinct")
    is_cat = F.col("kind") == "categorical"
    picks = drawn.groupBy("table_id").agg(
        F.min(F.when(is_cat, best)).alias("_cat"), F.min(F.when(~is_cat, best)).alias("_con")
    )
    prefer = uniform(seed, "table_id", F.lit("kind")) < CATEGORICAL_PREFERENCE
    use_cat = F.col("_cat").isNotNull() & (F.col("_con").isNull() | prefer)
    return tables.select("table_id").join(picks, "table_id", "left").select(
        "table_id",
        F.coalesce(F.when(use_cat, F.col("_cat.col_id")).otherwise(F.col("_con.col_id")), F.lit(-1)).alias("label_index"),
        F.when(use_cat, F.col("_cat.n_distinct")).otherwise(F.lit(0)).cast("bigint").alias("num_classes"),
    )


def table_number(name: Column) -> Column:
    """First run of digits in a file name; NULL without digits."""
    return F.regexp_extract(name, r"\d+", 0).try_cast("bigint")


def is_causal_name(name: Column) -> Column:
    return name.startswith("Causal_Table")


def causal_list(records: DataFrame, order: str) -> DataFrame:
    """Number the causal records from 1 by ``order`` (their index in the source list)."""
    return records.select((F.col(order) + 1).cast("bigint").alias("_number"), "causal_info")


def attach_causal(tables: DataFrame, causal: DataFrame) -> DataFrame:
    """has_causal and causal_info for ``Causal_Table<k>`` names: the k-th causal record."""
    keyed = tables.withColumn(
        "_number", F.when(is_causal_name(F.col("table_id")) & F.col("table_id").endswith(".csv"), table_number(F.col("table_id")))
    )
    return keyed.join(causal, "_number", "left").withColumn(
        "has_causal", F.col("_number").isNotNull()
    ).drop("_number")


def label_stats(profile: DataFrame, seed: int) -> DataFrame:
    """label_index, num_classes and is_classification per table.

    CSV tables are synthetic: their last column is the label and they are
    always classification. Others go through the label heuristic.
    """
    synthetic = F.col("table_id").endswith(".csv")
    dims = table_dims(profile)
    real = pick_label(label_candidates(profile).where(~synthetic), dims.where(~synthetic), seed)
    real = real.withColumn("is_classification", F.col("num_classes") != 0)
    last = F.max(F.struct("col_id", "n_distinct"))
    made = profile.where(synthetic).groupBy("table_id").agg(last.alias("_l")).select(
        "table_id", F.col("_l.col_id").alias("label_index"),
        F.col("_l.n_distinct").cast("bigint").alias("num_classes"),
        F.lit(True).alias("is_classification"),
    )
    return real.unionByName(made)


def build_metadata(cells: DataFrame, seed: int, causal: DataFrame | None = None) -> DataFrame:
    """The metadata record of every table of the corpus."""
    # one row per column, used several times below
    profile = store(column_profile(cells), "profile")
    synthetic = F.col("table_id").endswith(".csv")
    flags = F.transform(
        F.array_sort(F.collect_list(F.struct("col_id", "categorical"))), lambda c: c["categorical"]
    )
    per_table = profile.groupBy("table_id").agg(
        F.max("n_rows").alias("num_rows"),
        F.count(F.lit(1)).alias("_cols"),
        F.count_if("active").alias("_active"),
        flags.alias("_flags"),
    )
    meta = per_table.select(
        "table_id",
        synthetic.alias("is_synthetic_data"),
        "num_rows",
        F.when(synthetic, F.col("_active")).otherwise(F.col("_cols")).cast("int").alias("num_cols"),
        F.when(synthetic, F.array_repeat(F.lit(0), F.col("_active").cast("int")))
        .otherwise(F.col("_flags"))
        .alias("categorical_columns"),
    ).join(label_stats(profile, seed), "table_id")
    if causal is None:
        return meta.withColumn("has_causal", F.lit(False)).withColumn(
            "causal_info",
            F.lit(None).cast("array<struct<source_feature:string,sink_feature:string,is_causal:boolean>>"),
        )
    return attach_causal(meta, causal)
