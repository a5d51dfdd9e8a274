"""Random questions about the tables of a corpus, answered in one job.

1. ``plan_prompts``: every draw of every prompt (table, function, axis,
   indices, constants), as columns computed from md5 of seed and prompt id.
2. ``answers.answer``: the plan joined, by family of functions, to the cells of the asked tables.
3. ``render``: question and answer text; prompts that cannot be asked of
   their table come out NULL and are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.draws import draw_int, draw_item, uniform
from ..functions.numbers import round_exact
from ..functions.text import fixed, render_number
from ..operators.cells import is_numeric, to_cells
from ..operators.positions import number_rows
from .answers import AXIS_FNS, PAIR_COLUMN_FNS, VALUE_FNS, CustomFunction, answer  # noqa: F401
from .templates import (
    CAUSAL, DRAWABLE, SCALING_PROPERTIES, SCALING_STATS, SCALING_STEPS, choose, fill, fill_pieces, templates,
)

#: fixed values of the question sampler
TOP_N = (1, 15)
CONSTANT_RANGE = (1.0, 100.0)
FILL_RANGE = (0, 100)
METHODS = ("normalize", "standardize", "robust_scale")

#: pieces of the prompts for each core
SPREAD = 3

TABLE_TOTAL_FNS = ("sum_table_values", "average_table_values")


# ------------------------------------------------------------------ plan
def column_roles(meta: DataFrame) -> DataFrame:
    """numeric_cols and categorical_cols of each table, the label left out."""
    places = F.sequence(F.lit(0), F.size("categorical_columns") - 1)

    def with_flag(flag):
        return F.filter(
            places, lambda i: (F.get("categorical_columns", i) == flag) & (i != F.col("label_index"))
        )

    return meta.withColumns({"numeric_cols": with_flag(0), "categorical_cols": with_flag(1)})


def draw_tables(prompts: DataFrame, meta: DataFrame, seed: int) -> DataFrame:
    """A uniform table per prompt, found by its number in table_id order."""
    how_many = meta.count()
    numbered = number_rows(meta, ["table_id"], out="ordinal")
    drawn = prompts.withColumn("ordinal", F.floor(uniform(seed, "prompt_id", F.lit("table")) * how_many))
    # ids are few bytes, often one file: the draws to come are the work, so prompts are dealt to all cores
    pieces = SPREAD * prompts.sparkSession.sparkContext.defaultParallelism
    return drawn.join(numbered, "ordinal").drop("ordinal").repartition(pieces)


def draw_functions(planned: DataFrame, seed: int, functions=None) -> DataFrame:
    names = F.array(*[F.lit(f) for f in (functions or DRAWABLE)])
    is_causal = F.col("has_causal") & F.col("table_id").startswith("Causal_Table")
    drawn = draw_item(uniform(seed, "prompt_id", F.lit("function")), names)
    return planned.withColumn("fn", F.when(is_causal, F.lit(CAUSAL)).otherwise(drawn))


def draw_axis_index(planned: DataFrame, seed: int) -> DataFrame:
    """axis (0 row, 1 column) and an index on it; the label column is never drawn."""
    planned = planned.withColumn("axis", draw_int(uniform(seed, "prompt_id", F.lit("axis")), 0, 1))
    top = F.when(F.col("axis") == 0, F.col("num_rows") - 1).otherwise(F.col("num_cols") - 2)
    return planned.withColumn("axis_index", draw_int(uniform(seed, "prompt_id", F.lit("index")), F.lit(0), top))


def draw_numeric(planned: DataFrame, seed: int) -> DataFrame:
    """A numeric column, and two cells in numeric columns; NULL without any."""

    def column(key):
        return draw_item(uniform(seed, "prompt_id", F.lit(key)), F.col("numeric_cols"))

    def row(key):
        return draw_int(uniform(seed, "prompt_id", F.lit(key)), F.lit(0), F.col("num_rows") - 1)

    return planned.withColumns(
        {
            "numeric_col": column("column"),
            "row1": row("row1"), "cell_col1": column("cell_col1"),
            "row2": row("row2"), "cell_col2": column("cell_col2"),
        }
    )


def draw_pair(planned: DataFrame, seed: int) -> DataFrame:
    """Two different numeric columns; NULL when there are fewer."""
    k = F.size("numeric_cols")
    first = F.floor(uniform(seed, "prompt_id", F.lit("pair1")) * k)
    other = F.floor(uniform(seed, "prompt_id", F.lit("pair2")) * (k - 1))
    second = other + F.when(other >= first, F.lit(1)).otherwise(F.lit(0))
    enough = k >= 2
    return planned.withColumns(
        {
            "pair_col1": F.when(enough, F.get("numeric_cols", first.cast("int"))),
            "pair_col2": F.when(enough, F.get("numeric_cols", second.cast("int"))),
        }
    )


def draw_scalars(planned: DataFrame, seed: int) -> DataFrame:
    """n, sort direction, constant (two decimals), filler, scaling method, any cell."""

    def u(key):
        return uniform(seed, "prompt_id", F.lit(key))

    low, high = CONSTANT_RANGE
    size = F.when(F.col("axis") == 0, F.col("num_rows")).otherwise(F.col("num_cols"))
    return planned.withColumns(
        {
            "n": draw_int(u("n"), *TOP_N),
            "ascending": u("order") < 0.5,
            "constant": F.floor((low + u("constant") * (high - low)) * 100) / 100.0,
            "filler": draw_int(u("filler"), *FILL_RANGE),
            "method": draw_item(u("method"), F.array(*[F.lit(m) for m in METHODS])),
            "any_row": draw_int(u("any_row"), F.lit(0), F.col("num_rows") - 1),
            "any_col": draw_int(u("any_col"), F.lit(0), F.col("num_cols") - 2),
            # the value to look for may come from the label column, and so may the second index
            "value_col": draw_int(u("value_col"), F.lit(0), F.col("num_cols") - 1),
            "index2": draw_int(u("index2"), F.lit(0), size - 1),
            "u_value": u("value"),
            "u_slice": u("slice"),
            "u_causal": u("causal"),
        }
    )


def plan_prompts(prompts: DataFrame, meta: DataFrame, seed: int, functions=None) -> DataFrame:
    """All draws of all prompts. ``prompts`` has prompt_id, ``meta`` one row per table."""
    planned = draw_functions(draw_tables(prompts, column_roles(meta), seed), seed, functions)
    planned = draw_pair(draw_numeric(draw_axis_index(planned, seed), seed), seed)
    return draw_scalars(planned, seed)


# ------------------------------------------------------------------ tables
def corpus_meta(df: DataFrame, target: str, columns) -> DataFrame:
    """Metadata of equally shaped processed tables: sizes are measured, flags read off the schema."""
    flags = [0 if is_numeric(df.schema[c]) else 1 for c in columns]
    return df.groupBy("table_id").agg(F.count(F.lit(1)).alias("num_rows")).select(
        "table_id", "num_rows",
        F.lit(len(columns)).alias("num_cols"),
        F.array(*[F.lit(f) for f in flags]).alias("categorical_columns"),
        F.lit(columns.index(target)).alias("label_index"),
        F.lit(False).alias("has_causal"),
        F.lit(None).cast("array<struct<source_feature:string,sink_feature:string,is_causal:boolean>>").alias("causal_info"),
    )


# ------------------------------------------------------------------ text
def _three(v: Column) -> Column:
    return F.when(v.isNotNull(), render_number(round_exact(v, 3)))


def render(answered: DataFrame, custom: dict[str, CustomFunction] | None = None) -> DataFrame:
    """prompt_id, table_id, fn, question, answer.

    Prompts that their table cannot answer are dropped; ids keep their gaps.
    """
    text = lambda c: F.col(c).cast("string")
    whole = F.col("whole")
    is_three = lambda c: F.coalesce(fixed(F.col(c)), F.lit("nan"))
    params = {
        "row": text("any_row"), "col": text("any_col"),
        "axis_name": F.when(F.col("on_row"), F.lit("row")).otherwise(F.lit("column")),
        "index": text("index"), "index1": text("index"), "index2": text("index2"),
        "slice_start": text("slice_start"), "slice_end": text("slice_end"),
        "result": F.col("result"), "presence": F.col("presence"), "value": F.col("value"),
        "n": text("n"), "order": F.when(F.col("ascending"), F.lit("ascending")).otherwise(F.lit("descending")),
        "max_val": F.when(F.col("index").isNotNull(), render_number(F.col("high"), whole)),
        "min_val": F.when(F.col("index").isNotNull(), render_number(F.col("low"), whole)),
        "cell1": F.concat(F.lit("("), text("row1"), F.lit(", "), text("cell_col1"), F.lit(")")),
        "cell2": F.concat(F.lit("("), text("row2"), F.lit(", "), text("cell_col2"), F.lit(")")),
        "constant": render_number(F.col("constant")),
        "rows": text("num_rows"), "cols": text("num_cols"),
        "col1": text("pair_col1"), "col2": text("pair_col2"),
        "method": F.col("method"),
        "correlation": _three(F.col("correlation")),
        "n_samples": F.when(F.col("correlation").isNotNull(), F.col("pair.n").cast("string")),
        "x_mean": _three(F.col("pair.x_mean")), "y_mean": _three(F.col("pair.y_mean")),
        "sum_product_dev": _three(F.col("pair.s.xy")),
        "sum_squared_dev_x": _three(F.col("pair.s.xx")), "sum_squared_dev_y": _three(F.col("pair.s.yy")),
        **{s: is_three(f"stat_{s}") for s in ("mean", "std", "min", "max", "median", "q1", "q3")},
        "iqr": F.coalesce(fixed(F.col("stat_q3") - F.col("stat_q1")), F.lit("nan")),
        **{f"after_{s}": is_three(f"after_{s}") for s in ("min", "max", "mean", "std", "median", "iqr")},
        "source_feature": F.col("cause.source_feature"), "sink_feature": F.col("cause.sink_feature"),
        "is_causal": F.when(F.col("cause.is_causal"), F.lit("Yes")).otherwise(F.lit("No")),
        "sentence_filler": F.when(F.col("cause.is_causal"), F.lit("a")).otherwise(F.lit("no")),
    }
    for key, by_method in (
        ("transformation_steps", SCALING_STEPS), ("transformed_stats", SCALING_STATS), ("properties", SCALING_PROPERTIES),
    ):
        params[key] = choose(F.col("method"), {m: fill(s, params) for m, s in by_method.items()})
    params["col"] = F.when(
        F.col("fn").isin("transform_column", "stepwise_transform_column", "log_transform_column"), params["index"]
    ).otherwise(params["col"])
    pairs = F.create_map(*[e for k, v in params.items() for e in (F.lit(k), v)])
    if custom:
        # keys of a custom function replace built-in ones of the same name
        theirs = F.coalesce("custom", F.create_map().cast("map<string,string>"))
        pairs = F.map_concat(F.map_filter(pairs, lambda k, v: ~F.map_contains_key(theirs, k)), theirs)
    wording = templates(
        answered.sparkSession, {n: (c.question, c.answer_text) for n, c in (custom or {}).items()}
    ).drop("question", "answer")
    # the wording table has a few dozen rows whatever the data
    worded = answered.join(F.broadcast(wording), "fn").withColumn("_params", pairs)
    texts = F.struct(
        fill_pieces(F.col("question_pieces"), F.col("_params")).alias("question"),
        fill_pieces(F.col("answer_pieces"), F.col("_params")).alias("answer"),
    )
    # inline over the kept ones, so the condition is not pushed into the computations above
    kept = F.filter(F.array(texts), lambda t: t["question"].isNotNull() & t["answer"].isNotNull())
    return worded.select("prompt_id", "table_id", "fn", F.inline(kept))


def prompt_records(rendered: DataFrame) -> DataFrame:
    """id, table, conversations with one question and its answer."""

    def turn(who, what):
        return F.struct(F.lit(who).alias("from"), F.col(what).alias("value"))

    return rendered.select(
        F.col("prompt_id").cast("string").alias("id"),
        F.col("table_id").alias("table"),
        F.array(turn("human", "question"), turn("gpt", "answer")).alias("conversations"),
    )


def generate_prompts(
    prompts: DataFrame, processed: DataFrame, meta: DataFrame, columns, seed: int,
    digits: int | None = None, encoded: bool = False, custom: dict[str, CustomFunction] | None = None,
) -> DataFrame:
    """The whole job up to rendered questions and answers (see ``prompt_records`` for the record form).

    ``processed`` holds wide rows of equally shaped tables with these ``columns``,
    or, with ``columns`` None, cells of tables of any mix of schemas.
    """
    functions = sorted([*DRAWABLE, *(custom or {})])
    planned = plan_prompts(prompts, meta, seed, functions)
    cells = processed if columns is None else to_cells(processed, "table_id", columns=columns)
    return render(answer(planned, cells, digits, encoded, custom), custom)
