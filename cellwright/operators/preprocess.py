"""Table preprocessing on wide DataFrames.

``keys`` names the table column(s): () for one table, ("table_id",) for a
corpus of tables that share a schema.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.draws import uniform
from ..functions.numbers import round_exact
from ..functions.text import render_number
from .cells import is_numeric
from .metadata import categorical_flag
from .positions import group_sizes, number_rows, take_lowest


@dataclass(frozen=True)
class Options:
    """Settings of the corpus job; the defaults are the fixed values of the source configuration."""

    encoded: bool = False            # encoded profile (numbers only) or raw text
    max_cols: int = 101
    apply_mask: bool = True
    mask_fraction: float = 0.15
    mask_token: str = "missing"
    decimals: int = 2
    context_length: int = 250_000
    tokens_per_cell: int = 10
    keep_all_rows: bool = True       # False: the row budget of question making
    seed: int = 11


def features_of(df: DataFrame, keys=(), row_id="row_id") -> list[str]:
    return [c for c in df.columns if c not in (*keys, row_id)]


def categorical_flags(df: DataFrame, columns) -> list[int]:
    """1 for text, booleans, times; 0 for numbers. Read off the schema."""
    return [0 if is_numeric(df.schema[c]) else 1 for c in columns]


def categorical_flags_df(df: DataFrame, columns) -> DataFrame:
    """The same per column, with the number of rows it was found over."""
    rows = [
        F.struct(
            F.lit(i).alias("col_id"), F.lit(c).alias("col_name"),
            categorical_flag(F.lit(df.schema[c].dataType.simpleString())).alias("categorical"),
        )
        for i, c in enumerate(columns)
    ]
    return df.agg(F.count(F.lit(1)).alias("num_rows")).select("num_rows", F.inline(F.array(*rows)))


def move_target_last(df: DataFrame, target: str) -> DataFrame:
    return df.select(*[c for c in df.columns if c != target], target)


def pad_columns(df: DataFrame, n_cols: int, max_cols: int) -> DataFrame:
    """Zero columns ``padded_i`` for i in [n_cols, max_cols)."""
    return df.select("*", *[F.lit(0).alias(f"padded_{i}") for i in range(n_cols, max_cols)])


def drop_columns(columns: list[str], keep: int, seed: int) -> list[str]:
    """A seeded choice of ``keep`` column names in their original order (schema work only)."""

    def draw(name):
        head = hashlib.md5(f"{seed}|{name}|column".encode()).hexdigest()[:8]
        return int(head, 16), name

    chosen = set(sorted(columns, key=draw)[:keep])
    return [c for c in columns if c in chosen]


def trim_padding(columns: list[str], num_cols: int) -> list[str]:
    """The first ``num_cols - 1`` features of a zero-padded synthetic table."""
    return columns[: num_cols - 1]


def bool_to_int(df: DataFrame) -> DataFrame:
    return df.select(
        *[
            F.col(f.name).cast("int").alias(f.name) if isinstance(f.dataType, T.BooleanType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def label_codes(df: DataFrame, columns, keys=()) -> DataFrame:
    """keys, col_name, value, code: distinct values of each column numbered in sorted order."""
    pairs = F.array(*[F.struct(F.lit(c).alias("col_name"), F.col(c).cast("string").alias("value")) for c in columns])
    distinct = df.select(*keys, F.inline(pairs)).where(F.col("value").isNotNull()).distinct()
    return number_rows(distinct, ["value"], [*keys, "col_name"], out="code")


def label_encode(df: DataFrame, columns, keys=()) -> DataFrame:
    """Replace the columns by their codes; missing values get the code after the last.

    Codes are found with one range-partitioned pass over the distinct values
    and joined back; the stored code table's size decides how.
    """
    keys = list(keys)
    codes = label_codes(df, columns, keys)
    out = df
    for c in columns:
        mine = codes.where(F.col("col_name") == c).select(
            *keys, F.col("value").alias(c), F.col("code").cast("int").alias("_code")
        )
        sizes = mine.groupBy(*keys).agg((F.max("_code") + 1).alias("_next"))
        out = out.withColumn(c, F.col(c).cast("string")).join(mine, [*keys, c], "left")
        if keys:
            out = out.join(sizes, keys, "left")
            after = F.coalesce("_next", F.lit(0))
        else:
            after = F.coalesce(sizes.select("_next").scalar(), F.lit(0))
        out = out.withColumn(c, F.coalesce("_code", after)).drop("_code", "_next")
    return out.select(*df.columns)


def mask_target(
    df: DataFrame, target: str, fraction: float, token: str, seed: int, keys=(), row_id="row_id",
    sizes: DataFrame | None = None,
) -> DataFrame:
    """Replace ``int(n * fraction)`` labels per table by ``token``.

    Adds ``original``: the text of a masked label, NULL elsewhere; the ledger
    is the rows where it is set.
    """
    draw = uniform(seed, *keys, row_id, F.lit("mask"))
    # a hair above, so that n * fraction does not fall just short of a whole number
    how_many = F.floor(F.col("n") * F.lit(fraction) + F.lit(1e-9))
    marked = take_lowest(df, draw, [row_id], how_many, keys, out="_masked", sizes=sizes)
    kind = df.schema[target].dataType
    text = F.col(target).cast("string")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        text = F.when(F.col(target).isNotNull(), render_number(F.col(target)))
    return marked.withColumn("original", F.when(F.col("_masked"), F.coalesce(text, F.lit("nan")))).withColumn(
        target, F.when(F.col("_masked"), F.lit(token)).otherwise(text)
    ).select(*df.columns, "original")


def masked_info(masked: DataFrame, keys=(), row_id="row_id") -> DataFrame:
    return masked.where(F.col("original").isNotNull()).select(*keys, row_id, "original")


def updated_metadata(processed: DataFrame, target: str, keys=("table_id",), row_id="row_id") -> DataFrame:
    """Metadata of processed tables: measured rows, flags in the new column order, the label last.

    ``target_masked`` tells whether labels were masked and ``n_masked`` how many;
    which ones is the ledger, ``masked_info``.
    """
    columns = [c for c in processed.columns if c not in (*keys, row_id, "original")]
    return processed.groupBy(*keys).agg(F.count(F.lit(1)).alias("num_rows"), F.count("original").alias("n_masked")).select(
        *keys, "num_rows", F.lit(len(columns)).alias("num_cols"), F.lit(columns.index(target)).alias("label_index"),
        F.array(*[F.lit(f) for f in categorical_flags(processed, columns)]).alias("categorical_columns"),
        (F.col("n_masked") > 0).alias("target_masked"), "n_masked",
    )


def round_floats(df: DataFrame, places: int) -> DataFrame:
    """Round floating columns the way decimal rounding of their exact value does."""
    return df.select(
        *[
            round_exact(F.col(f.name).cast("double"), places).alias(f.name) if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def row_budget(n_cols, context_length=250_000, tokens_per_cell=10):
    """Rows that fit: ceil((context / tokens per cell) / columns)."""
    cells = context_length / tokens_per_cell
    if isinstance(n_cols, Column):
        return F.ceil(F.lit(cells) / n_cols)
    return math.ceil(cells / n_cols)


def downsample(
    df: DataFrame, n: int, seed: int, keys=(), row_id="row_id", sizes: DataFrame | None = None
) -> DataFrame:
    """At most ``n`` rows per table, a seeded choice without replacement."""
    sizes = group_sizes(df, keys) if sizes is None else sizes
    draw = uniform(seed, *keys, row_id, F.lit("rows"))
    kept = take_lowest(df, draw, [row_id], F.least(F.col("n"), F.lit(n)), keys, out="_kept", sizes=sizes)
    return kept.where("_kept").select(*df.columns)


def preprocess(df: DataFrame, target: str, opts: Options, keys=("table_id",), row_id="row_id") -> DataFrame:
    """A corpus of equally shaped tables, ready for questions.

    Encoded profile: features padded or dropped to ``max_cols``, text encoded.
    Raw profile: labels masked. Both: label last, floats rounded, row budget.
    ``original`` holds masked labels (raw profile).
    """
    keys = list(keys)
    features = [c for c in features_of(df, keys, row_id) if c != target]
    out = df
    # masking and the row budget need the same row counts
    sizes = group_sizes(df, keys) if not (opts.encoded and opts.keep_all_rows) else None
    if opts.encoded:
        n_cols = len(features) + 1
        if n_cols > opts.max_cols:
            features = drop_columns(features, opts.max_cols - 1, opts.seed)
        out = bool_to_int(out.select(*keys, row_id, *features, target))
        text = [c for c in [*features, target] if not is_numeric(out.schema[c])]
        if text:
            out = label_encode(out, text, keys)
        if n_cols <= opts.max_cols - 1:
            out = pad_columns(out, n_cols, opts.max_cols)
            features += [f"padded_{i}" for i in range(n_cols, opts.max_cols)]
        out = out.withColumn("original", F.lit(None).cast("string"))
    elif opts.apply_mask:
        out = mask_target(out, target, opts.mask_fraction, opts.mask_token, opts.seed, keys, row_id, sizes)
    else:
        out = out.withColumn("original", F.lit(None).cast("string"))
    out = round_floats(out.select(*keys, row_id, *features, target, "original"), opts.decimals)
    if not opts.keep_all_rows:
        budget = row_budget(len(features) + 1, opts.context_length, opts.tokens_per_cell)
        out = downsample(out, budget, opts.seed, keys, row_id, sizes)
    if "table_id" in keys:
        ends = F.col("table_id").endswith(".parquet")
        stem = F.substring("table_id", F.lit(1), F.length("table_id") - len(".parquet"))
        # the pattern is for what the plain comparison leaves: an end before a line break
        other = F.regexp_replace("table_id", r"\.parquet$", ".csv")
        out = out.withColumn("table_id", F.when(ends, F.concat(stem, F.lit(".csv"))).otherwise(other))
    return out
