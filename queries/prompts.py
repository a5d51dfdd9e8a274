"""Question plans, answers and prompt records, each with checking SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellwright.functions.draws import draw_int, uniform
from cellwright.functions.numbers import round_exact_sql
from cellwright.functions.text import render_number
from cellwright.operators import columns as K
from cellwright.operators.cells import to_cells
from cellwright.plans import prompts as Q
from cellwright.plans.answers import exact_sum
from cellwright.plans.templates import (
    DRAWABLE, SCALING_PROPERTIES, SCALING_STATS, SCALING_STEPS, TEMPLATES, pieces, templates,
)

from .base import ORDERS_N, query
from .corpus import CAUSAL, PROCESSED, SEED, causal_records, draw_sql, processed
from .mixed import ENCODED, ENCODED_SQL, RAW, RAW_SQL, processed_corpus

COLUMNS = ["l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linestatus", "l_returnflag"]
#: decimals of computed numbers in the compared texts
DIGITS = 4


# ------------------------------------------------------------------ Spark side
def meta(t):
    """Processed supplier tables, plus causal tables whose answers come from metadata alone."""
    tables = Q.corpus_meta(processed(t), "l_returnflag", COLUMNS)
    causal = causal_records(t).select(
        F.concat(F.lit("Causal_Table"), F.col("n_nationkey") + 1, F.lit(".csv")).alias("table_id"),
        F.lit(None).cast("bigint").alias("num_rows"), F.lit(3).alias("num_cols"),
        F.array(F.lit(0), F.lit(0), F.lit(0)).alias("categorical_columns"), F.lit(2).alias("label_index"),
        F.lit(True).alias("has_causal"), "causal_info",
    )
    return tables.unionByName(causal)


def prompt_ids(t):
    return t.table("customer").select(F.col("c_custkey").alias("prompt_id"))


def planned(t):
    return Q.plan_prompts(prompt_ids(t), meta(t), SEED)


def generated(t, only=None, custom=None):
    """The prompt job; ``only`` plans every prompt on the given functions."""
    if only is None:
        return Q.generate_prompts(prompt_ids(t), processed(t), meta(t), COLUMNS, SEED, digits=DIGITS, custom=custom)
    return generated_from_cells(t, only)


def processed_cells(t):
    return to_cells(processed(t), "table_id", columns=COLUMNS)


def generated_from_cells(t, only):
    plan = Q.plan_prompts(prompt_ids(t), meta(t), SEED, only)
    return Q.render(Q.answer(plan, processed_cells(t), DIGITS))


# ------------------------------------------------------------------ the same in SQL
def u(key: str) -> str:
    return draw_sql("prompt_id", f"'{key}'")


def d_int(key: str, low: str, high: str) -> str:
    return f"({low} + floor({u(key)} * ({high} - ({low}) + 1)))::BIGINT"


#: the equally shaped supplier tables: what they are read from, their metadata, their columns as lists
SUPPLIERS = (
    PROCESSED,
    """SELECT table_id, count(*) AS num_rows, 7 AS num_cols, [0,0,0,0,0,1,1] AS flags, 6 AS label_index, false AS has_causal, NULL AS info
  FROM processed GROUP BY 1 UNION ALL
  SELECT 'Causal_Table' || number || '.csv', NULL, 3, [0,0,0], 2, true, info FROM causal""",
    """SELECT table_id, [""" + ", ".join(f"list({c}::DOUBLE ORDER BY row_id)" for c in COLUMNS[:5]) + """, NULL, NULL] AS nums,
  [NULL, NULL, NULL, NULL, NULL, list(l_linestatus ORDER BY row_id), list(l_returnflag ORDER BY row_id)] AS texts,
  ['int', 'double', 'double', 'double', 'double', 'string', 'string'] AS kinds,
  [count(l_linenumber) = count(*), false, false, false, false, false, false] AS wholes FROM processed GROUP BY 1""",
)


def cells_corpus(base: str, source: str):
    """The same for tables that are cells in ``source``, defined by ``base``; flags and labels come with the cells."""
    number = "kind IN ('int', 'bigint', 'double')"
    return (
        base,
        f"""SELECT table_id, max(n) AS num_rows, count(*) AS num_cols, list(flag ORDER BY col_id) AS flags, max(col_id) AS label_index,
  table_id LIKE 'Causal_Table%' AS has_causal, any_value(info) AS info FROM
  (SELECT table_id, col_id, any_value(flag) AS flag, count(*) AS n FROM {source} GROUP BY 1, 2)
  LEFT JOIN causal ON table_id LIKE 'Causal_Table%' AND number = TRY_CAST(nullif(regexp_extract(table_id, '\\d+'), '') AS BIGINT) GROUP BY 1""",
        f"""SELECT table_id, list(CASE WHEN {number} THEN nums END ORDER BY col_id) AS nums, list(CASE WHEN NOT {number} THEN texts END ORDER BY col_id) AS texts,
  list(kind ORDER BY col_id) AS kinds, list(kind IN ('int', 'bigint') AND filled ORDER BY col_id) AS wholes FROM
  (SELECT table_id, col_id, any_value(col_type) AS kind, list(v_num ORDER BY row_id) AS nums, list(v_str ORDER BY row_id) AS texts,
   count(v_num) = count(*) AS filled FROM {source} GROUP BY 1, 2) GROUP BY 1""",
    )


def plan_sql(functions, corpus=SUPPLIERS) -> str:
    names = ", ".join(f"'{f}'" for f in functions)
    numeric = "roles.numeric_cols"
    pick = lambda key: f"{numeric}[floor({u(key)} * len({numeric}))::BIGINT + 1]"
    return f"""{CAUSAL}, {corpus[0]}, meta AS ({corpus[1]}),
roles AS (SELECT *, row_number() OVER (ORDER BY table_id) - 1 AS ordinal,
  list_filter(range(0, len(flags)), lambda i: flags[i + 1] = 0 AND i <> label_index) AS numeric_cols,
  list_filter(range(0, len(flags)), lambda i: flags[i + 1] = 1 AND i <> label_index) AS categorical_cols FROM meta),
ids AS (SELECT c_custkey AS prompt_id, floor({draw_sql('c_custkey', "'table'")} * (SELECT count(*) FROM meta))::BIGINT AS ordinal FROM customer),
asked AS (SELECT prompt_id, roles.*, CASE WHEN has_causal THEN 'infer_feature_causality' ELSE [{names}][floor({u('function')} * {len(functions)})::BIGINT + 1] END AS fn,
  {d_int('axis', '0', '1')} AS axis, {pick('column')} AS numeric_col,
  {d_int('row1', '0', 'num_rows - 1')} AS row1, {pick('cell_col1')} AS cell_col1,
  {d_int('row2', '0', 'num_rows - 1')} AS row2, {pick('cell_col2')} AS cell_col2,
  floor({u('pair1')} * len({numeric}))::BIGINT AS pa, floor({u('pair2')} * (len({numeric}) - 1))::BIGINT AS pb,
  {d_int('n', '1', '15')} AS n, {u('order')} < 0.5 AS ascending, floor((1 + {u('constant')} * 99) * 100) / 100.0::DOUBLE AS constant,
  {d_int('filler', '0', '100')} AS filler, ['normalize', 'standardize', 'robust_scale'][floor({u('method')} * 3)::BIGINT + 1] AS method,
  {d_int('any_row', '0', 'num_rows - 1')} AS any_row, {d_int('any_col', '0', 'num_cols - 2')} AS any_col,
  {d_int('value_col', '0', 'num_cols - 1')} AS value_col, {u('value')} AS u_value, {u('slice')} AS u_slice, {u('causal')} AS u_causal
  FROM ids JOIN roles USING (ordinal)),
plan AS (SELECT *, {d_int('index', '0', 'CASE WHEN axis = 0 THEN num_rows - 1 ELSE num_cols - 2 END')} AS axis_index,
  {d_int('index2', '0', 'CASE WHEN axis = 0 THEN num_rows ELSE num_cols END - 1')} AS index2,
  CASE WHEN len(numeric_cols) >= 2 THEN numeric_cols[pa + 1] END AS pair_col1,
  CASE WHEN len(numeric_cols) >= 2 THEN numeric_cols[pb + CASE WHEN pb >= pa THEN 1 ELSE 0 END + 1] END AS pair_col2 FROM asked)"""


def _in(names) -> str:
    return "fn IN (" + ", ".join(f"'{n}'" for n in names) + ")"


def dec(v: str, places: int = 6) -> str:
    """Decimal text without exponent; at least one decimal."""
    return f"regexp_replace(regexp_replace(printf('%.{places}f', {v} + 0.0::DOUBLE), '0+$', ''), '\\.$', '.0')"


def nt(v: str, whole: str = "false") -> str:
    return f"CASE WHEN ({v}) IS NULL THEN 'nan' WHEN {whole} THEN ({v})::BIGINT::VARCHAR ELSE {dec(f'round(({v}), {DIGITS})', DIGITS)} END"


def quote(s: str) -> str:
    return f"(CASE WHEN contains({s}, '''') THEN '\"' || {s} || '\"' ELSE '''' || {s} || '''' END)"


def cell(r: str, c: str, quoted: bool) -> str:
    text = f"texts[{c} + 1][{r} + 1]"
    number = f"nums[{c} + 1][{r} + 1]"
    return f"coalesce(CASE WHEN {number} IS NOT NULL THEN {nt(number, f'wholes[{c} + 1]')} END, {quote(text) if quoted else text})"


def row_texts(r: str) -> str:
    return f"list_transform(range(0, len(kinds)), lambda c: {cell(r, 'c', True)})"


def fill_sql(template: str, params: dict[str, str]) -> str:
    out = []
    for part, is_name in pieces(template):
        out.append(f"({params[part]})" if is_name else "'" + part.replace("'", "''") + "'")
    return " || ".join(out)


def _by_fn(options: dict[str, str]) -> str:
    return "CASE fn " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in options.items()) + " END"


def prompts_sql(functions, corpus=SUPPLIERS, encoded=False) -> str:
    def q(p, a):
        """The quantile of a sorted list (sn, sz), interpolated from the nearer end."""
        a = {"nn": "sn", "numbers": "sz"}[a]
        s, at = a, f"({p}::DOUBLE * (len({a}) - 1))"
        if p == 0.5:
            return f"({s}[(len({a}) + 1) // 2] + {s}[len({a}) // 2 + 1]) / 2"
        low, high, t = f"{s}[floor({at})::BIGINT + 1]", f"{s}[ceil({at})::BIGINT + 1]", f"({at} - floor({at}))"
        return f"(CASE WHEN {t} < 0.5 THEN {low} + ({high} - {low}) * {t} ELSE {high} - ({high} - {low}) * (1 - {t}) END)"

    # sums as decimals, so that they do not depend on order
    total = lambda a: f"coalesce(list_sum(list_transform({a}, lambda v: v::DECIMAL(28,10)))::DOUBLE, 0)"
    mean = lambda a: f"({total(a)} / nullif(len({a}), 0))"
    center = f"CASE method WHEN 'normalize' THEN list_min(nn) WHEN 'standardize' THEN {mean('nn')} ELSE {q(0.5, 'nn')} END"

    def centred(a, ma, b, mb):
        """Sum of products around the means: around rounded means as decimals, then moved."""
        off = lambda v, m: f"({v}::DECIMAL(18,6) - round({m}, 2)::DECIMAL(18,6))::DECIMAL(19,6)"
        return (f"(list_sum(list_transform({a}, lambda v, i: {off('v', ma)} * {off(f'{b}[i]', mb)}))::DOUBLE - list_sum(list_transform({a}, lambda v: {off('v', ma)}))::DOUBLE "
                f"* list_sum(list_transform({b}, lambda v: {off('v', mb)}))::DOUBLE / len({a}))")

    width = f"CASE method WHEN 'normalize' THEN list_max(nn) - list_min(nn) WHEN 'standardize' THEN list_aggregate(nn, 'stddev_samp') ELSE {q(0.75, 'nn')} - {q(0.25, 'nn')} END"
    scaled = "list_transform(nn, lambda v: (v - center) / nullif(width, 0))"
    first_seen = lambda a: f"list_transform(list_filter(list_transform({a}, lambda v, i: {{'v': v, 'i': i, 'p': list_position({a}, v)}}), lambda s: s.p = s.i), lambda s: s.v)"
    numbers = _by_fn({
        "square_values": "list_transform(x, lambda v: v * v)",
        "sqrt_values": "list_transform(list_filter(x, lambda v: v >= 0), lambda v: sqrt(v))",
        "abs_values": "list_transform(x, lambda v: abs(v))",
        "add_constant": "list_transform(x, lambda v: v + constant)",
        "cumulative_sum": "list_transform(x, lambda v, i: CASE WHEN v IS NOT NULL THEN list_sum(x[1:i]) END)",
        "successive_differences": "list_filter(list_transform(x, lambda v, i: CASE WHEN i > 1 THEN v - x[i - 1] END), lambda v: v IS NOT NULL)",
        "sort_values": "CASE WHEN ascending THEN list_sort(x, 'ASC', 'NULLS LAST') ELSE list_sort(x, 'DESC', 'NULLS LAST') END",
        "top_n_values": "list_sort(nn, 'DESC')[1:n]",
        "bottom_n_values": "list_sort(nn, 'ASC')[1:n]",
        "transform_column": scaled, "stepwise_transform_column": scaled,
        "log_transform_column": "list_transform(nn, lambda v: ln(abs(v) + 1e-10::DOUBLE))",
        "non_empty_cells": "nn", "unique_values": first_seen("x"),
        "fill_missing_values": "list_transform(x, lambda v: coalesce(v, filler::DOUBLE))",
    })
    base = "coalesce(cells, quoted)"
    strings = _by_fn({
        "non_empty_cells": f"list_filter({base}, lambda v: v IS NOT NULL)",
        "unique_values": first_seen(base),
        "fill_missing_values": f"list_transform({base}, lambda v: coalesce(v, filler::VARCHAR))",
    })
    keeps = "(whole AND " + _in(["square_values", "abs_values", "cumulative_sum", "sort_values", "top_n_values", "bottom_n_values",
                                 "non_empty_cells", "unique_values", "fill_missing_values"]) + ")"
    flat = "list_filter(flatten(list_filter(nums, lambda c: c IS NOT NULL)), lambda v: v IS NOT NULL)"
    all_whole = "(len(list_filter(nums, lambda c, i: c IS NOT NULL AND NOT wholes[i])) = 0)"
    seek = f"coalesce(CASE WHEN seek_number IS NOT NULL THEN {nt('seek_number', all_whole)} END, seek_text)"
    hits = """flatten(list_transform(range(0, num_rows), lambda r: list_filter(list_transform(range(0, len(kinds)), lambda c:
      CASE WHEN nums[c + 1][r + 1] = seek_number OR texts[c + 1][r + 1] = seek_text THEN '(' || r || ', ' || c || ')' END), lambda p: p IS NOT NULL)))"""
    side = lambda n, when, r, c: f"CASE WHEN {when} THEN '''{n}'': ' || coalesce({cell(r, c, True)}, 'nan') END"
    around = "'{' || concat_ws(', ', " + ", ".join([
        side("above", "any_row > 0", "(any_row - 1)", "any_col"), side("below", "any_row < num_rows - 1", "(any_row + 1)", "any_col"),
        side("left", "any_col > 0", "any_row", "(any_col - 1)"), side("right", "any_col < num_cols - 1", "any_row", "(any_col + 1)"),
    ]) + ") || '}'"
    c1, c2 = "nums[cell_col1 + 1][row1 + 1]", "nums[cell_col2 + 1][row2 + 1]"
    pw = "(wholes[cell_col1 + 1] AND wholes[cell_col2 + 1])"
    has_x = lambda e: f"CASE WHEN x IS NOT NULL THEN {e} END"
    mode = "list_sort(list_transform(list_distinct(nn), lambda v: {'c': -len(list_filter(nn, lambda w: w = v)), 'v': v}))[1].v"
    result = _by_fn({
        "find_value": f"coalesce({cell('any_row', 'any_col', False)}, 'nan')", "fetch_neighbors": around,
        "add_cells": f"CASE WHEN cell_col1 IS NOT NULL THEN {nt(f'{c1} + {c2}', pw)} END",
        "subtract_cells": f"CASE WHEN cell_col1 IS NOT NULL THEN {nt(f'{c1} - {c2}', pw)} END",
        "sum_values": has_x(nt(total("nn"), "whole")), "value_range": has_x(nt("list_max(nn) - list_min(nn)", "whole")),
        "mean_value": has_x(nt(mean("nn"))), "median_value": has_x(nt(q(0.5, "nn"))), "mode_value": has_x(nt(mode, "whole")),
        "count_empty_cells": has_x("(len(x) - len(nn))::VARCHAR"),
        "find_all_cells_with_value": "'[' || array_to_string(hits, ', ') || ']'", "count_value_occurrences": "len(hits)::VARCHAR",
        **({"sum_table_values": nt(total(flat)), "average_table_values": nt(f"list_avg(list_transform(list_filter(nums, lambda c: len(list_filter(c, lambda v: v IS NOT NULL)) > 0), lambda c: {mean('list_filter(c, lambda v: v IS NOT NULL)')}))")}
           if encoded else {}),
    })
    any_number, any_text = "nums[value_col + 1][any_row + 1]", "texts[value_col + 1][any_row + 1]"
    found = f"""CASE WHEN {any_number} IS NOT NULL THEN
      coalesce(list_contains(CASE WHEN on_row THEN list_transform(nums, lambda c: c[index + 1]) ELSE x END, {any_number}), false)
      ELSE coalesce(list_contains(CASE WHEN on_row THEN list_transform(texts, lambda c: c[index + 1]) ELSE t END, {any_text}), false) END"""
    presence = _by_fn({
        "has_missing_values": "CASE WHEN len(list_filter(coalesce(cells, x::VARCHAR[], t), lambda v: v IS NULL)) > 0 THEN 'are' ELSE 'are no' END",
        "compare_rows_or_columns": f"""CASE WHEN CASE WHEN on_row THEN cells IS NOT DISTINCT FROM {row_texts('index2')} ELSE
          kinds[index + 1] = kinds[index2 + 1] AND x IS NOT DISTINCT FROM nums[index2 + 1] AND t IS NOT DISTINCT FROM texts[index2 + 1] END THEN '' ELSE ' not' END""",
        "value_present": f"CASE WHEN {found} THEN '' ELSE ' not' END",
    })
    value = _by_fn({
        "value_present": f"coalesce({cell('any_row', 'value_col', False)}, 'nan')", "fill_missing_values": "filler::VARCHAR",
        "find_all_cells_with_value": seek, "count_value_occurrences": seek,
    })
    three = lambda v: f"CASE WHEN ({v}) IS NOT NULL THEN {dec(round_exact_sql(v, 3), 3)} END"
    fixed3 = lambda v: f"coalesce(printf('%.3f', {round_exact_sql(v, 3)} + 0.0::DOUBLE), 'nan')"
    params = {
        "row": "any_row::VARCHAR", "axis_name": "CASE WHEN on_row THEN 'row' ELSE 'column' END",
        "col": "CASE WHEN " + _in(["transform_column", "stepwise_transform_column", "log_transform_column"]) + " THEN index ELSE any_col END::VARCHAR",
        "index": "index::VARCHAR", "index1": "index::VARCHAR", "index2": "index2::VARCHAR",
        "slice_start": "slice_start::VARCHAR", "slice_end": "slice_end::VARCHAR",
        "result": "result", "presence": "presence", "value": "value_text", "n": "n::VARCHAR",
        "order": "CASE WHEN ascending THEN 'ascending' ELSE 'descending' END",
        "max_val": has_x(nt("list_max(nn)", "whole")), "min_val": has_x(nt("list_min(nn)", "whole")),
        "cell1": "'(' || row1 || ', ' || cell_col1 || ')'", "cell2": "'(' || row2 || ', ' || cell_col2 || ')'",
        "constant": dec("constant", 2), "rows": "num_rows::VARCHAR", "cols": "num_cols::VARCHAR",
        "col1": "pair_col1::VARCHAR", "col2": "pair_col2::VARCHAR", "method": "method",
        "correlation": three("sxy / nullif(sqrt(sxx) * sqrt(syy), 0)"),
        "n_samples": "CASE WHEN sxx * syy > 0 THEN len(px)::VARCHAR END",
        "x_mean": three("mx"), "y_mean": three("my"), "sum_product_dev": three("sxy"),
        "sum_squared_dev_x": three("sxx"), "sum_squared_dev_y": three("syy"),
        "mean": fixed3(mean("nn")), "std": fixed3("list_aggregate(nn, 'stddev_samp')"), "min": fixed3("list_min(nn)"),
        "max": fixed3("list_max(nn)"), "median": fixed3(q(0.5, "nn")), "q1": fixed3(q(0.25, "nn")), "q3": fixed3(q(0.75, "nn")),
        "iqr": fixed3(f"({q(0.75, 'nn')} - {q(0.25, 'nn')})"),
        "after_min": fixed3("list_min(numbers)"), "after_max": fixed3("list_max(numbers)"), "after_mean": fixed3("list_avg(numbers)"),
        "after_std": fixed3("list_aggregate(numbers, 'stddev_samp')"), "after_median": fixed3(q(0.5, "numbers")),
        "after_iqr": fixed3(f"({q(0.75, 'numbers')} - {q(0.25, 'numbers')})"),
        "source_feature": "cause.source_feature", "sink_feature": "cause.sink_feature",
        "is_causal": "CASE WHEN cause.is_causal THEN 'Yes' ELSE 'No' END",
        "sentence_filler": "CASE WHEN cause.is_causal THEN 'a' ELSE 'no' END",
    }
    for key, by_method in (("transformation_steps", SCALING_STEPS), ("transformed_stats", SCALING_STATS), ("properties", SCALING_PROPERTIES)):
        params[key] = "CASE method " + " ".join(f"WHEN '{m}' THEN {fill_sql(s, params)}" for m, s in by_method.items()) + " END"
    questions = _by_fn({f: fill_sql(TEMPLATES[f][0], params) for f in TEMPLATES})
    answers = _by_fn({f: fill_sql(TEMPLATES[f][1], params) for f in TEMPLATES})
    return f"""WITH {plan_sql(functions, corpus)}, packed AS ({corpus[2]}),
a0 AS (SELECT *, CASE WHEN {_in(Q.AXIS_FNS)} THEN axis_index WHEN {_in(Q.PAIR_COLUMN_FNS)} THEN pair_col1 ELSE numeric_col END AS index,
  {_in(Q.AXIS_FNS)} AND axis = 0 AS on_row FROM plan LEFT JOIN packed USING (table_id)),
a1 AS (SELECT *, CASE WHEN NOT on_row THEN nums[index + 1] END AS x, CASE WHEN NOT on_row THEN texts[index + 1] END AS t,
  CASE WHEN {_in(Q.PAIR_COLUMN_FNS)} THEN nums[pair_col2 + 1] END AS y,
  CASE WHEN on_row THEN {row_texts('index')} END AS cells, NOT on_row AND coalesce(wholes[index + 1], false) AS whole FROM a0),
a2 AS (SELECT *, list_filter(x, lambda v: v IS NOT NULL) AS nn, list_transform(t, lambda s: {quote('s')}) AS quoted,
  list_filter(list_transform(x, lambda v, i: CASE WHEN y[i] IS NOT NULL THEN v END), lambda v: v IS NOT NULL) AS px,
  list_filter(list_transform(y, lambda v, i: CASE WHEN x[i] IS NOT NULL THEN v END), lambda v: v IS NOT NULL) AS py,
  CASE WHEN {_in(Q.VALUE_FNS)} THEN list_sort(list_distinct(list_filter({flat}, lambda v: v <> 0))) END AS vn,
  CASE WHEN {_in(Q.VALUE_FNS)} THEN list_sort(list_distinct(list_filter(flatten(list_filter(texts, lambda c: c IS NOT NULL)), lambda v: v IS NOT NULL))) END AS vt FROM a1),
a2b AS (SELECT *, list_sort(nn) AS sn FROM a2),
a3 AS (SELECT *, {center} AS center, {width} AS width, {mean('px')} AS mx, {mean('py')} AS my,
  floor(u_value * (len(vn) + len(vt)))::BIGINT AS vat FROM a2b),
a4 AS (SELECT *, CASE WHEN vat < len(vn) THEN vn[vat + 1] END AS seek_number, CASE WHEN vat >= len(vn) THEN vt[vat - len(vn) + 1] END AS seek_text,
  {numbers} AS numbers, CASE WHEN x IS NULL THEN {strings} END AS strings,
  {centred('px', 'mx', 'py', 'my')} AS sxy, {centred('px', 'mx', 'px', 'mx')} AS sxx, {centred('py', 'my', 'py', 'my')} AS syy FROM a3),
a4b AS (SELECT *, list_sort(numbers) AS sz FROM a4),
a5 AS (SELECT *, coalesce(len(numbers), len(strings)) AS length, CASE WHEN {_in(Q.VALUE_FNS)} THEN {hits} END AS hits,
  coalesce(CASE WHEN len(list_filter(info, lambda i: i.is_causal)) > 0 THEN list_filter(info, lambda i: i.is_causal) END, info) AS pool FROM a4b),
a6 AS (SELECT *, CASE WHEN {_in(['top_n_values', 'bottom_n_values'])} OR length <= 5 THEN 0 ELSE floor(u_slice * (length - 4))::BIGINT END AS slice_start,
  pool[floor(u_causal * len(pool))::BIGINT + 1] AS cause FROM a5),
a7 AS (SELECT *, CASE WHEN {_in(['top_n_values', 'bottom_n_values'])} THEN length ELSE least(length, slice_start + 5) END AS slice_end FROM a6),
a8 AS (SELECT *, coalesce({result}, '[' || array_to_string(coalesce(list_transform(numbers[slice_start + 1:slice_end], lambda v: {nt('v', keeps)}),
  list_transform(strings[slice_start + 1:slice_end], lambda s: coalesce(s, 'nan'))), ', ') || ']') AS result, {presence} AS presence, {value} AS value_text FROM a7),
a9 AS (SELECT prompt_id, table_id, fn, {questions} AS question, {answers} AS answer FROM a8)
SELECT * FROM a9 WHERE question IS NOT NULL AND answer IS NOT NULL"""


PLAN = plan_sql(DRAWABLE)


@query("generate_prompts", prompts_sql(DRAWABLE))
def generate_prompts(t):
    return generated(t)


# ------------------------------------------------------------------ the plan, draw by draw
@query("plan_prompts", f"WITH {PLAN} SELECT prompt_id, table_id FROM plan")
def plan_prompts(t):
    return Q.draw_tables(prompt_ids(t), meta(t), SEED).select("prompt_id", "table_id")


@query("plan_functions", f"WITH {PLAN} SELECT prompt_id, table_id, fn FROM plan")
def plan_functions(t):
    return Q.draw_functions(Q.draw_tables(prompt_ids(t), meta(t), SEED), SEED).select("prompt_id", "table_id", "fn")


@query("column_roles", f"""WITH {PLAN} SELECT table_id, array_to_string(numeric_cols, ',') AS numeric_cols,
  array_to_string(categorical_cols, ',') AS categorical_cols FROM roles""")
def column_roles(t):
    text = lambda c: F.array_join(F.transform(c, lambda i: i.cast("string")), ",").alias(c)
    return Q.column_roles(meta(t)).select("table_id", text("numeric_cols"), text("categorical_cols"))


@query("draw_axis_index", f"WITH {PLAN} SELECT prompt_id, table_id, axis, axis_index FROM plan")
def draw_axis_index(t):
    return planned(t).select("prompt_id", "table_id", "axis", "axis_index")


@query("draw_numeric", f"WITH {PLAN} SELECT prompt_id, numeric_col::INT AS numeric_col, row1, cell_col1::INT AS cell_col1, row2, cell_col2::INT AS cell_col2 FROM plan")
def draw_numeric(t):
    return planned(t).select("prompt_id", "numeric_col", "row1", "cell_col1", "row2", "cell_col2")


@query("draw_pair", f"WITH {PLAN} SELECT prompt_id, pair_col1::INT AS pair_col1, pair_col2::INT AS pair_col2 FROM plan")
def draw_pair(t):
    return planned(t).select("prompt_id", "pair_col1", "pair_col2")


@query("draw_scalars", f"WITH {PLAN} SELECT prompt_id, n, ascending, constant, filler, method FROM plan")
def draw_scalars(t):
    return planned(t).select("prompt_id", "n", "ascending", "constant", "filler", "method")


@query("draw_value", prompts_sql(list(Q.VALUE_FNS)))
def draw_value(t):
    """Values drawn from the table, and where and how often they occur."""
    return generated(t, list(Q.VALUE_FNS))


@query("skipped_prompts", f"""WITH p AS ({prompts_sql(DRAWABLE)})
SELECT c_custkey AS prompt_id FROM customer WHERE c_custkey NOT IN (SELECT prompt_id FROM p)""")
def skipped_prompts(t):
    return prompt_ids(t).join(generated(t), "prompt_id", "left_anti")


@query("slice_result", f"""WITH {ORDERS_N}, s AS (SELECT o_custkey, row_id, o_totalprice AS value,
    row_number() OVER (PARTITION BY o_custkey ORDER BY row_id) - 1 AS position, count(*) OVER (PARTITION BY o_custkey) AS n
  FROM orders_n WHERE o_totalprice IS NOT NULL), b AS (SELECT *, CASE WHEN n <= 5 THEN 0 ELSE
    floor({draw_sql('o_custkey', "'slice'")} * (n - 4)) END::BIGINT AS slice_start FROM s)
SELECT o_custkey, row_id, value, position, slice_start, slice_start + least(n, 5) AS slice_end FROM b
WHERE position >= slice_start AND position < slice_start + least(n, 5)""")
def slice_result(t):
    values = K.non_empty(t.orders_n(), "o_totalprice", within=["o_custkey"])
    return K.slice_result(values, "position", uniform(SEED, "o_custkey", F.lit("slice")), 5, ["o_custkey"])


# ------------------------------------------------------------------ wording
@query("templates", f"WITH {PLAN}, w AS (SELECT * FROM (VALUES " + ", ".join(
    "(" + ", ".join("'" + s.replace("'", "''") + "'" for s in (f, *TEMPLATES[f])) + ")" for f in TEMPLATES)
    + ") v(fn, question, answer)) SELECT fn, question, answer, count(*) AS n_prompts FROM plan JOIN w USING (fn) GROUP BY ALL")
def templates_q(t):
    """The wording used by the plan, with how many prompts use it."""
    used = planned(t).groupBy("fn").agg(F.count(F.lit(1)).alias("n_prompts"))
    return used.join(templates(t.spark).select("fn", "question", "answer"), "fn")


QA = ["mean_value", "has_missing_values", "compare_rows_or_columns", "sort_values", "fetch_neighbors", "value_present"]
_STEPS = [("render_qa", QA), ("render_corr_steps", ["stepwise_correlation_between_columns"]),
          ("render_scale_steps", ["stepwise_transform_column"])]


def _family(name, functions):
    @query(name, prompts_sql(functions))
    def run(t):
        return generated(t, functions)


for _name, _functions in _STEPS:
    _family(_name, _functions)


@query("prompt_records", f"""WITH p AS ({prompts_sql(['table_shape', 'mean_value'])})
SELECT prompt_id::VARCHAR AS id, table_id AS table_name, 'human' AS from0, question AS value0, 'gpt' AS from1, answer AS value1 FROM p""")
def prompt_records(t):
    out = Q.prompt_records(generated(t, ["table_shape", "mean_value"]))
    turn = lambda i, f: F.col("conversations")[i][f].alias(f"{f}{i}")
    return out.select("id", F.col("table").alias("table_name"), turn(0, "from"), turn(0, "value"), turn(1, "from"), turn(1, "value"))


@query("render_number", f"""SELECT o_orderkey, {dec('o_totalprice')} AS price, {dec('round(o_totalprice / 1e6, 6)')} AS millions,
  o_orderkey::VARCHAR AS whole, printf('%.1f', o_orderkey * 1e9::DOUBLE) AS large,
  '1' || repeat('0', 20 + (o_orderkey % 3)::INT) || '.0' AS huge, '0.' || repeat('0', 20 + (o_orderkey % 3)::INT) || '1' AS tiny FROM orders""")
def render_number_q(t):
    price = F.col("o_totalprice")
    return t.table("orders").select(
        "o_orderkey", render_number(price).alias("price"), render_number(F.round(price / 1e6, 6)).alias("millions"),
        render_number(F.col("o_orderkey").cast("double"), True).alias("whole"),
        render_number(F.col("o_orderkey") * F.lit(1e9)).alias("large"),
        render_number(F.concat(F.lit("1e"), 20 + F.col("o_orderkey") % 3).cast("double")).alias("huge"),
        render_number(F.concat(F.lit("1e-"), 21 + F.col("o_orderkey") % 3).cast("double")).alias("tiny"),
    )


@query("t_causality", f"""WITH p AS ({prompts_sql(DRAWABLE)}) SELECT * FROM p WHERE fn = 'infer_feature_causality'""")
def t_causality(t):
    return generated(t, ["table_shape"]).where(F.col("fn") == "infer_feature_causality")


@query("registry_custom_fn", f"""WITH {plan_sql(sorted([*DRAWABLE[:2], 'value_gap']))},
x AS (SELECT table_id, c, max(v) AS hi, sum(v::DECIMAL(28,10))::DOUBLE / count(v) AS mean FROM (""" + " UNION ALL ".join(
    f"SELECT table_id, {i} AS c, {c}::DOUBLE AS v FROM processed" for i, c in enumerate(COLUMNS[:5])) + f""") GROUP BY 1, 2)
SELECT prompt_id, plan.table_id, fn, 'How far is the largest value of column ' || numeric_col || ' above its mean?' AS question,
  'It is ' || {dec('round(hi - mean, 4)')} || ' above.' AS answer
FROM plan JOIN x ON x.table_id = plan.table_id AND c = numeric_col WHERE fn = 'value_gap'""")
def registry_custom_fn(t):
    """A question type the user adds: two wordings and an expression."""

    def gaps(prompts, cells):
        asked = prompts.withColumnRenamed("index", "col_id")
        per_column = cells.groupBy("table_id", "col_id").agg((F.max("x") - exact_sum(F.col("x")) / F.count("x")).alias("gap"))
        found = asked.join(per_column.where("gap IS NOT NULL"), ["table_id", "col_id"])
        return found.select("prompt_id", F.create_map(F.lit("gap"), render_number(F.round("gap", 4))).alias("params"))

    gap = Q.CustomFunction("How far is the largest value of column {index} above its mean?", "It is {gap} above.", gaps)
    return custom_prompts(t, "value_gap", gap)


def custom_prompts(t, name, function):
    plan = Q.plan_prompts(prompt_ids(t), meta(t), SEED, sorted([*DRAWABLE[:2], name]))
    out = Q.render(Q.answer(plan, processed_cells(t), DIGITS, custom={name: function}), {name: function})
    return out.where(F.col("fn") == name)


@query("registry_custom_pair", f"""WITH {plan_sql(sorted([*DRAWABLE[:2], 'mean_gap']))},
x AS (SELECT table_id, c, sum(v::DECIMAL(28,10))::DOUBLE / count(v) AS mean FROM (""" + " UNION ALL ".join(
    f"SELECT table_id, {i} AS c, {c}::DOUBLE AS v FROM processed" for i, c in enumerate(COLUMNS[:5])) + f""") GROUP BY 1, 2),
f AS (SELECT *, {d_int('factor', '1', '9')} AS factor FROM plan WHERE fn = 'mean_gap')
SELECT prompt_id, f.table_id, fn, 'By how much do the means of columns ' || pair_col1 || ' and ' || pair_col2 || ' differ, ' || factor || ' times?' AS question,
  'By ' || {dec('round((a.mean - b.mean) * factor, 4)')} || '.' AS answer
FROM f JOIN x a ON a.table_id = f.table_id AND a.c = pair_col1 JOIN x b ON b.table_id = f.table_id AND b.c = pair_col2""")
def registry_custom_pair(t):
    """A question type on two columns with a draw of its own."""

    def gaps(prompts, cells):
        means = cells.groupBy("table_id", "col_id").agg((exact_sum(F.col("x")) / F.count("x")).alias("mean"))
        of = lambda c, m: means.select("table_id", F.col("col_id").alias(c), F.col("mean").alias(m))
        both = prompts.join(of("index", "a"), ["table_id", "index"]).join(of("pair_col2", "b"), ["table_id", "pair_col2"])
        gap = render_number(F.round((F.col("a") - F.col("b")) * F.col("factor"), 4))
        text = lambda c: F.col(c).cast("string")
        return both.select("prompt_id", F.create_map(
            F.lit("gap"), gap, F.lit("second"), text("pair_col2"), F.lit("factor"), text("factor")).alias("params"))

    gap = Q.CustomFunction(
        "By how much do the means of columns {index} and {second} differ, {factor} times?", "By {gap}.", gaps,
        draws=lambda: {"factor": draw_int(uniform(SEED, "prompt_id", F.lit("factor")), 1, 9)}, columns=2,
    )
    return custom_prompts(t, "mean_gap", gap)


FROM_CELLS = ["find_value", "count_empty_cells", "unique_values", "compare_rows_or_columns", "sort_values", "value_present", "add_cells"]


@query("prompts_from_cells", f"WITH p AS ({prompts_sql(FROM_CELLS)}) SELECT * FROM p")
def prompts_from_cells(t):
    """The same questions asked of tables that come as cells."""
    return generated_from_cells(t, FROM_CELLS)


MIXED_RAW = cells_corpus(RAW_SQL, "raw")
MIXED_ENCODED = cells_corpus(ENCODED_SQL, "enc")


@query("prompts_of_mixed_tables", prompts_sql(DRAWABLE, MIXED_RAW))
def prompts_of_mixed_tables(t):
    """The whole run over a folder of different tables: metadata, preprocessing, then questions about all of them."""
    cells, tables = processed_corpus(t, RAW)
    return Q.generate_prompts(prompt_ids(t), cells, tables, None, SEED, digits=DIGITS)


@query("prompts_of_encoded_tables", prompts_sql(DRAWABLE, MIXED_ENCODED, encoded=True))
def prompts_of_encoded_tables(t):
    """The same over the encoded profile, which is also asked for table totals."""
    cells, tables = processed_corpus(t, ENCODED)
    return Q.generate_prompts(prompt_ids(t), cells, tables, None, SEED, digits=DIGITS, encoded=True)
