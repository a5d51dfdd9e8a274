"""Aggregates, quantiles, correlation and scaling."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellwright.operators import stats as S
from cellwright.operators.rows import row_profile

from .base import CORPUS_LI, FLAT, ORDERS_N, ORDERS_PAIR, ROW_LIST, ROWS_NUM, query
from .table_functions import ORDER_COLS, ROW_COLS, ROW_KEYS

NUMS = ["o_orderkey", "o_custkey", "o_totalprice"]


def _stack(expr: str, columns=NUMS, source="orders_n", extra="") -> str:
    """One row per column; ``{c}`` in ``expr`` is the column as DOUBLE."""
    return " UNION ALL ".join(
        f"SELECT {i} AS col_id, '{c}' AS col_name, {expr.replace('{c}', f'{c}::DOUBLE')} FROM {source}{extra}"
        for i, c in enumerate(columns)
    )


def _rounded(df, *names, n=4):
    for c in names:
        df = df.withColumn(c, F.round(c, n))
    return df


def _simple(name, measures, expr):
    @query(name, f"WITH {ORDERS_N} " + _stack(expr))
    def run(t):
        out = S.column_aggregates(t.orders_n(), NUMS, measures)
        return _rounded(out, *[m for m in measures if m in ("sum_value", "mean_value", "value_range")])


_simple("t_sum", ("sum_value",), "round(coalesce(sum({c}), 0), 4) AS sum_value")
_simple("t_mean", ("mean_value",), "round(avg({c}), 4) AS mean_value")
_simple("t_range", ("value_range",), "round(max({c}) - min({c}), 4) AS value_range")
_simple("t_max_min", ("max_value", "min_value"), "max({c}) AS max_value, min({c}) AS min_value")


def _missing(name, column, expr):
    @query(name, f"WITH {ORDERS_N} " + " UNION ALL ".join(
        f"SELECT {i} AS col_id, '{c}' AS col_name, {expr.replace('{c}', c)} FROM orders_n"
        for i, c in enumerate(ORDER_COLS)))
    def run(t):
        return S.any_missing(t.orders_n(), ORDER_COLS).select("col_id", "col_name", column)


_missing("t_has_missing", "has_empty", "bool_or({c} IS NULL) AS has_empty")
_missing("t_count_empty", "n_empty", "count(*) - count({c}) AS n_empty")


@query("t_shape", f"WITH {ORDERS_N} SELECT count(*) AS n_rows, 6 AS n_cols FROM orders_n")
def t_shape(t):
    return t.orders_n().agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(ORDER_COLS)).alias("n_cols"))


@query("t_table_sum", f"""WITH {ROWS_NUM} SELECT round(sum(l_quantity) + sum(l_extendedprice) + sum(l_discount)
  + sum(l_tax), 2) AS table_sum FROM rows_num""")
def t_table_sum(t):
    return S.table_sum(t.rows_num(), ROW_COLS).select(F.round("table_sum", 2).alias("table_sum"))


@query("t_table_mean", f"""WITH {FLAT} SELECT round((avg(s_suppkey) + avg(s_nationkey) + avg(s_acctbal) + avg(five)) / 4, 6)
  AS table_mean FROM flat""")
def t_table_mean(t):
    cols = ["s_suppkey", "s_nationkey", "s_acctbal", "five", "nothing"]
    return S.table_mean(t.flat(), cols).select(F.round("table_mean", 6).alias("table_mean"))


@query("t_median", f"WITH {ORDERS_N} " + _stack("round(quantile_cont({c}, 0.5), 4) AS median_value"))
def t_median(t):
    values = S.melt(t.orders_n(), NUMS)
    out = S.exact_quantiles(values, ["col_id", "col_name"], {"median_value": 0.5})
    return _rounded(out, "median_value")


def _mode_sql(c: str, source: str) -> str:
    return f"(SELECT v FROM (SELECT {c}::DOUBLE AS v, count(*) AS n FROM {source} WHERE {c} IS NOT NULL GROUP BY 1) ORDER BY n DESC, v LIMIT 1)"


@query("t_mode", f"WITH {ORDERS_N} " + " UNION ALL ".join(
    f"SELECT {i} AS col_id, '{c}' AS col_name, {_mode_sql(c, 'orders_n')} AS mode_value" for i, c in enumerate(NUMS)))
def t_mode(t):
    values = S.melt(t.orders_n(), NUMS)
    return S.distinct_and_mode(values, ["col_id", "col_name"]).drop("n_distinct")


_PROFILE = """count({c}) AS n_values, count(*) - count({c}) AS n_empty, bool_or({c} IS NULL) AS has_empty,
 min({c}) AS min_value, max({c}) AS max_value, round(max({c}) - min({c}), 4) AS value_range,
 round(coalesce(sum({c}), 0), 2) AS sum_value, round(avg({c}), 4) AS mean_value,
 round(stddev_samp({c}), 4) AS std_value, count(DISTINCT {c}) AS n_distinct,
 round(quantile_cont({c}, 0.25), 4) AS q1, round(quantile_cont({c}, 0.5), 4) AS median_value,
 round(quantile_cont({c}, 0.75), 4) AS q3"""


def _profile_rounded(df):
    df = _rounded(df, "value_range", "mean_value", "std_value", "q1", "median_value", "q3")
    return _rounded(df, "sum_value", n=2)


_FLAT_COLS = ["s_suppkey", "s_nationkey", "s_acctbal", "five", "nothing"]


@query("profile_all", f"WITH {ORDERS_N}, {FLAT} " + " UNION ALL ".join(
    f"SELECT '{src}' AS table_id, {i} AS col_id, '{c}' AS col_name, "
    + _PROFILE.replace("{c}", f"{c}::DOUBLE") + f", {_mode_sql(c, src)} AS mode_value FROM {src}"
    for src, cols in (("orders_n", NUMS), ("flat", _FLAT_COLS)) for i, c in enumerate(cols)))
def profile_all(t):
    a = S.profile(t.orders_n(), NUMS).withColumn("table_id", F.lit("orders_n"))
    b = S.profile(t.flat(), _FLAT_COLS).withColumn("table_id", F.lit("flat"))
    return _profile_rounded(a.unionByName(b))


#: the values have two decimals: a mean to four, from whole numbers, depends on no order of adding
_EXACT_MEAN = "((round(sum(v) * 100)::BIGINT * 200 + count(v)) // (2 * count(v))) / 10000"
_CORPUS_COLS = ["l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("corpus_profile", f"WITH {CORPUS_LI}, " + "m AS (" + " UNION ALL ".join(
    f"SELECT table_id, {i} AS col_id, '{c}' AS col_name, {c}::DOUBLE AS v FROM corpus_li" for i, c in enumerate(_CORPUS_COLS))
    + """), best AS (SELECT table_id, col_id, v AS mode_value, row_number() OVER (PARTITION BY table_id, col_id ORDER BY n DESC, v) AS k
  FROM (SELECT table_id, col_id, v, count(*) AS n FROM m WHERE v IS NOT NULL GROUP BY ALL)), p AS (
  SELECT table_id, col_id, col_name, """ + _PROFILE.replace("{c}", "v").replace("round(avg(v), 4)", _EXACT_MEAN) + """ FROM m GROUP BY ALL)
SELECT p.*, mode_value FROM p LEFT JOIN best USING (table_id, col_id) WHERE k = 1""")
def corpus_profile(t):
    out = _profile_rounded(S.profile(t.corpus_li(), _CORPUS_COLS, ["table_id"]))
    return out.withColumn("mean_value", F.expr("(cast(round(sum_value * 100) as bigint) * 200 + n_values) div (2 * n_values) / 10000"))


@query("row_profile", f"""WITH {ROW_LIST} SELECT l_orderkey, l_partkey, l_linenumber, len(nn) AS n_values,
  4 - len(nn) AS n_empty, list_min(nn) AS min_value, list_max(nn) AS max_value,
  round(list_max(nn) - list_min(nn), 4) AS value_range, round(list_sum(nn), 4) AS sum_value,
  round(list_sum(nn) / len(nn), 4) AS mean_value, round(list_aggregate(nn, 'stddev_samp'), 4) AS std_value,
  round((list_sort(nn)[(len(nn) + 1) // 2] + list_sort(nn)[len(nn) // 2 + 1]) / 2, 4) AS median_value,
  list_sort(list_transform(nn, lambda x: {{'c': -len(list_filter(nn, lambda y: y = x)), 'v': x}}))[1].v AS mode_value
FROM row_list""")
def row_profile_q(t):
    out = row_profile(t.rows_num(), ROW_COLS, ROW_KEYS)
    return _rounded(out, "value_range", "sum_value", "mean_value", "std_value", "median_value")


# ------------------------------------------------------------------ correlation
@query("t_corr", f"""WITH {ORDERS_PAIR} SELECT 'x,y' AS pair, round(corr(x, y), 6) AS correlation FROM orders_pair
UNION ALL SELECT 'x,c', NULL::DOUBLE""")
def t_corr(t):
    p = t.orders_pair()
    a = S.correlation(p, "x", "y").select(F.lit("x,y").alias("pair"), F.round("correlation", 6).alias("correlation"))
    b = S.correlation(p, "x", "c").select(F.lit("x,c").alias("pair"), F.round("correlation", 6).alias("correlation"))
    return a.unionByName(b)


_CORR = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("t_corr_all_pairs", f"WITH {ROWS_NUM} " + " UNION ALL ".join(
    f"SELECT {i} AS col1, {j} AS col2, count_if({a} IS NOT NULL AND {_CORR[j]} IS NOT NULL)::BIGINT AS n_samples, "
    f"round(corr({a}, {_CORR[j]}), 6) AS correlation FROM rows_num"
    for i, a in enumerate(_CORR) for j in range(i + 1, 4)))
def t_corr_all_pairs(t):
    return _rounded(S.all_correlations(t.rows_num(), _CORR), "correlation", n=6)


@query("t_corr_steps", f"""WITH {ORDERS_PAIR}, b AS (SELECT x, y FROM orders_pair WHERE x IS NOT NULL AND y IS NOT NULL)
SELECT count(*) AS n_samples, round(avg(x), 3) AS x_mean, round(avg(y), 3) AS y_mean,
  round(covar_pop(x, y) * count(*) / 1e6, 3) AS sum_product_dev, round(var_pop(x) * count(*) / 1e6, 3) AS sum_squared_dev_x,
  round(var_pop(y) * count(*) / 1e6, 3) AS sum_squared_dev_y, round(corr(x, y), 3) AS correlation FROM b""")
def t_corr_steps(t):
    out = S.correlation_steps(t.orders_pair(), "x", "y")
    for c in ("sum_product_dev", "sum_squared_dev_x", "sum_squared_dev_y"):
        out = out.withColumn(c, F.col(c) / 1e6)  # so that three decimals are well inside double precision
    return _rounded(out, "x_mean", "y_mean", "sum_product_dev", "sum_squared_dev_x", "sum_squared_dev_y", "correlation", n=3)


# ------------------------------------------------------------------ scaling
_CENTER = {
    "normalize": ("min({c})", "max({c}) - min({c})"),
    "standardize": ("avg({c})", "stddev_samp({c})"),
    "robust_scale": ("quantile_cont({c}, 0.5)", "quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)"),
}


def _scale(name, method):
    center, width = (e.replace("{c}", "o_totalprice") for e in _CENTER[method])

    @query(f"t_{name}", f"""WITH {ORDERS_N}, s AS (SELECT {center} AS a, {width} AS b FROM orders_n)
SELECT row_id, round((o_totalprice - a) / b, 6) AS value FROM orders_n, s WHERE o_totalprice IS NOT NULL""")
    def values(t):
        return _rounded(S.scale(t.orders_n(), "o_totalprice", method), "value", n=6)

    after = {
        "normalize": "round(min(z), 3) AS after_min, round(max(z), 3) AS after_max, round(avg(z), 3) AS after_mean",
        "standardize": "round(abs(avg(z)), 3) AS after_mean, round(stddev_samp(z), 3) AS after_std",
        "robust_scale": "round(quantile_cont(z, 0.5), 3) AS after_median, round(quantile_cont(z, 0.75) - quantile_cont(z, 0.25), 3) AS after_iqr",
    }[method]

    @query(f"t_{name}_steps", f"""WITH {ORDERS_N}, s AS (SELECT {center} AS a, {width} AS b FROM orders_n),
z AS (SELECT o_totalprice AS v, (o_totalprice - a) / b AS z FROM orders_n, s WHERE o_totalprice IS NOT NULL)
SELECT round(avg(v), 3) AS mean, round(stddev_samp(v), 3) AS std, min(v) AS min, max(v) AS max,
  round(quantile_cont(v, 0.25), 3) AS q1, round(quantile_cont(v, 0.5), 3) AS median, round(quantile_cont(v, 0.75), 3) AS q3,
  round(quantile_cont(v, 0.75) - quantile_cont(v, 0.25), 3) AS iqr, {after} FROM z""")
    def steps(t):
        out = S.scale_steps(t.orders_n(), "o_totalprice", method)
        out = _rounded(out, *[c for c in out.columns if c not in ("min", "max")], n=3)
        # the mean after standardising is zero up to the sign of a rounding error
        return out.withColumn("after_mean", F.abs("after_mean")) if method == "standardize" else out


_scale("normalize", "normalize")
_scale("standardize", "standardize")
_scale("robust", "robust_scale")


@query("corpus_scale", f"WITH {CORPUS_LI} " + " UNION ALL ".join(
    f"""SELECT c.table_id, row_id, {i} AS col_id, '{c}' AS col_name,
  round(({c} - a) / nullif(b, 0), 6) AS value FROM corpus_li c
  JOIN (SELECT table_id, avg({c}) AS a, stddev_samp({c}) AS b FROM corpus_li GROUP BY 1) s ON s.table_id = c.table_id
  WHERE {c} IS NOT NULL""" for i, c in enumerate(_CORPUS_COLS)))
def corpus_scale(t):
    values = S.melt(t.corpus_li(), _CORPUS_COLS, ["table_id", "row_id"])
    out = S.scale(values, "v", "standardize", keys=["table_id", "col_id", "col_name"])
    return _rounded(out, "value", n=6)
