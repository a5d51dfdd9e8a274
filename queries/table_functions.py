"""Table functions on cells, columns and rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellwright.functions import rows as R
from cellwright.operators import cells as C, columns as K
from cellwright.operators.rows import row_aggregates, row_answers, spread_array

from .base import (
    CELL_REQUESTS, CORPUS_LI, ORDER_CELLS, ORDERS_N, ROW_LIST, SIGNED, TIES, query,
)

ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
ROW_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
ROW_KEYS = ["l_orderkey", "l_partkey", "l_linenumber"]


# ------------------------------------------------------------------ cells
@query("t_find_value", f"""WITH {ORDER_CELLS}, {CELL_REQUESTS}
SELECT request_id, r.row, r.col, v_num, v_str FROM cell_requests r
LEFT JOIN order_cells c ON c.row_id = r.row AND c.col = r.col""")
def t_find_value(t):
    return C.cell_lookup(t.orders_n(), t.cell_requests(), ORDER_COLS)


#: the cell of orders_n in the row that is joined and column number ``place_col``
PICKED = """CASE place_col WHEN 0 THEN o_orderkey::DOUBLE WHEN 1 THEN o_custkey::DOUBLE WHEN 3 THEN o_totalprice END AS v_num,
  CASE place_col WHEN 2 THEN o_orderstatus WHEN 4 THEN o_orderdate::VARCHAR WHEN 5 THEN o_orderpriority END AS v_str"""
SIDES = ("above", "below", "left", "right")


@query("t_neighbors", f"""WITH {ORDERS_N}, {CELL_REQUESTS}, asked AS (
  SELECT request_id, row, col, side, row + dr AS place, col + dc AS place_col FROM cell_requests,
    (VALUES ('above', -1, 0), ('below', 1, 0), ('left', 0, -1), ('right', 0, 1)) s(side, dr, dc)),
found AS (SELECT request_id, row, col, side, {PICKED} FROM asked LEFT JOIN orders_n ON row_id = place)
SELECT request_id, row, col, """ + ", ".join(
    f"max(v_num) FILTER (side = '{s}') AS {s}_num, max(v_str) FILTER (side = '{s}') AS {s}_str" for s in SIDES
) + " FROM found GROUP BY request_id, row, col")
def t_neighbors(t):
    return C.neighbors(t.orders_n(), t.cell_requests(), ORDER_COLS)


PAIR_REQUESTS = """pair_requests AS (SELECT c_custkey AS request_id, c_custkey AS row1,
  CASE WHEN c_custkey % 2 = 0 THEN 3 ELSE 1 END AS col1, c_custkey * 7 AS row2,
  CASE WHEN c_custkey % 3 = 0 THEN 3 ELSE 0 END AS col2 FROM customer)"""


def pair_requests(t):
    k = F.col("c_custkey")
    return t.table("customer").select(
        k.alias("request_id"), k.alias("row1"),
        F.when(k % 2 == 0, F.lit(3)).otherwise(F.lit(1)).alias("col1"),
        (k * 7).alias("row2"),
        F.when(k % 3 == 0, F.lit(3)).otherwise(F.lit(0)).alias("col2"),
    )


def _pair_query(name, op):
    @query(name, f"""WITH {ORDERS_N}, {PAIR_REQUESTS}, asked AS (
  SELECT pair_requests.*, which, CASE which WHEN 1 THEN row1 ELSE row2 END AS place, CASE which WHEN 1 THEN col1 ELSE col2 END AS place_col
  FROM pair_requests, (VALUES (1), (2)) w(which)),
found AS (SELECT request_id, row1, col1, row2, col2, which, {PICKED} FROM asked LEFT JOIN orders_n ON row_id = place)
SELECT request_id, row1, col1, row2, col2,
  round(max(v_num) FILTER (which = 1) {op} max(v_num) FILTER (which = 2), 4) AS result FROM found GROUP BY request_id, row1, col1, row2, col2""")
    def run(t):
        out = C.cell_pairs(t.orders_n(), pair_requests(t), ORDER_COLS, op)
        return out.withColumn("result", F.round("result", 4))


_pair_query("t_add_cells", "+")
_pair_query("t_subtract_cells", "-")


@query("t_find_cells", f"""WITH {TIES}
SELECT row_id AS row, 0 AS col FROM ties WHERE p_partkey = 25
UNION ALL SELECT row_id, 1 FROM ties WHERE p_size = 25
UNION ALL SELECT row_id, 2 FROM ties WHERE p_retailprice = 25""")
def t_find_cells(t):
    return C.find_cells(t.ties(), ["p_partkey", "p_size", "p_retailprice"], F.lit(25))


@query("t_count_value", f"""WITH {ROW_LIST}
SELECT sum(len(list_filter(nn, lambda x: x = 0.05)))::BIGINT AS occurrences FROM row_list""")
def t_count_value(t):
    return C.count_value(t.rows_num(), ROW_COLS, F.lit(0.05))


# ------------------------------------------------------------------ comparison
_LI = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
       "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
_LI_TYPE = ["long"] * 3 + ["int"] + ["double"] * 4 + ["str"] * 2 + ["ts"]


def _compare_sql():
    parts = []
    for i, a in enumerate(_LI):
        for j in range(i, len(_LI)):
            same = (
                f"bool_and({a} IS NOT DISTINCT FROM {_LI[j]})" if _LI_TYPE[i] == _LI_TYPE[j] else "false"
            )
            parts.append(f"SELECT {i} AS col1, {j} AS col2, {same} AS identical FROM lineitem")
    return " UNION ALL ".join(p if "bool_and" in p else p.replace(" FROM lineitem", "") for p in parts)


@query("t_compare_cols", _compare_sql())
def t_compare_cols(t):
    return C.compare_columns(t.table("lineitem"), _LI)


@query("t_compare_rows", f"""WITH {TIES}, s AS (SELECT row_id, p_size FROM ties),
r AS (SELECT p_partkey AS request_id, CASE WHEN p_partkey % 17 = 0 THEN -1 ELSE p_partkey END AS row1,
  CASE WHEN p_partkey % 13 = 0 THEN p_partkey + 1000000000 ELSE (p_partkey * 7) % 50 END AS row2 FROM part)
SELECT request_id, row1, row2, CASE WHEN a.row_id IS NOT NULL AND b.row_id IS NOT NULL THEN a.p_size IS NOT DISTINCT FROM b.p_size END AS identical
FROM r LEFT JOIN s a ON a.row_id = row1 LEFT JOIN s b ON b.row_id = row2""")
def t_compare_rows(t):
    k = F.col("p_partkey")
    requests = t.table("part").select(
        k.alias("request_id"), F.when(k % 17 == 0, F.lit(-1).cast("bigint")).otherwise(k).alias("row1"),
        F.when(k % 13 == 0, k + 1_000_000_000).otherwise((k * 7) % 50).alias("row2"),
    )
    return C.compare_rows(t.ties(), requests, ["p_size"])


# ------------------------------------------------------------------ lists of a column
@query("t_non_empty", f"""WITH {ORDERS_N}
SELECT row_id, o_totalprice AS value, row_number() OVER (ORDER BY row_id) - 1 AS position
FROM orders_n WHERE o_totalprice IS NOT NULL""")
def t_non_empty(t):
    return K.non_empty(t.orders_n(), "o_totalprice")


@query("t_unique", f"""WITH {ORDERS_N},
p AS (SELECT o_orderpriority AS value, min(row_id) AS first_row FROM orders_n GROUP BY 1),
c AS (SELECT o_custkey::VARCHAR AS value, min(row_id) AS first_row FROM orders_n GROUP BY 1)
SELECT 'o_orderpriority' AS col_name, value, first_row, row_number() OVER (ORDER BY first_row) - 1 AS position FROM p
UNION ALL SELECT 'o_custkey', value, first_row, row_number() OVER (ORDER BY first_row) - 1 FROM c""")
def t_unique(t):
    o = t.orders_n()
    parts = [
        K.unique_values(o.withColumn("_v", F.col(c).cast("string")), "_v").withColumn("col_name", F.lit(c))
        for c in ("o_orderpriority", "o_custkey")
    ]
    return parts[0].unionByName(parts[1]).select("col_name", "value", "first_row", "position")


@query("t_value_present", f"""WITH {ORDERS_N}
SELECT c_custkey AS request_id, c_custkey * 2 AS wanted,
  c_custkey * 2 IN (SELECT o_custkey FROM orders_n) AS present FROM customer""")
def t_value_present(t):
    k = F.col("c_custkey")
    requests = t.table("customer").select(k.alias("request_id"), (k * 2).alias("wanted"))
    return K.value_present(t.orders_n(), "o_custkey", requests, "wanted")


def _extreme(name, largest):
    d = "DESC" if largest else "ASC"

    @query(name, f"""WITH {TIES}, {CORPUS_LI}, p AS (
  SELECT 'part' AS table_id, row_id, p_size::DOUBLE AS value, row_number() OVER (ORDER BY p_size {d}, row_id) - 1 AS position
  FROM ties), c AS (
  SELECT table_id, row_id, l_quantity AS value,
    row_number() OVER (PARTITION BY table_id ORDER BY l_quantity {d}, row_id) - 1 AS position
  FROM corpus_li WHERE l_quantity IS NOT NULL)
SELECT * FROM p WHERE position < 15 UNION ALL SELECT * FROM c WHERE position < 5""")
    def run(t):
        one = K.extreme_n(t.ties(), "p_size", 15, largest).select(
            F.lit("part").alias("table_id"), "row_id", F.col("value").cast("double"), "position"
        )
        return one.unionByName(K.extreme_n(t.corpus_li(), "l_quantity", 5, largest, within=["table_id"]))


_extreme("t_top_n", True)
_extreme("t_bottom_n", False)


@query("t_sort", f"""WITH {ORDERS_N}
SELECT 'ascending' AS direction, row_id, o_totalprice AS value,
  row_number() OVER (ORDER BY o_totalprice ASC NULLS LAST, row_id) - 1 AS position FROM orders_n
UNION ALL SELECT 'descending', row_id, o_totalprice,
  row_number() OVER (ORDER BY o_totalprice DESC NULLS LAST, row_id) - 1 FROM orders_n""")
def t_sort(t):
    o = t.orders_n()
    up = K.sorted_values(o, "o_totalprice", True).withColumn("direction", F.lit("ascending"))
    down = K.sorted_values(o, "o_totalprice", False).withColumn("direction", F.lit("descending"))
    return up.unionByName(down).select("direction", "row_id", "value", "position")


@query("t_add_constant", f"WITH {ORDERS_N} SELECT row_id, o_totalprice + 12.5::DOUBLE AS value FROM orders_n")
def t_add_constant(t):
    return K.add_constant(t.orders_n(), "o_totalprice", 12.5)


@query("t_fill_missing", f"WITH {ORDERS_N} SELECT row_id, coalesce(o_totalprice, 42.0::DOUBLE) AS value FROM orders_n")
def t_fill_missing(t):
    return K.fill_missing(t.orders_n(), "o_totalprice", 42.0)


@query("t_square", f"WITH {SIGNED} SELECT row_id, round(balance * balance, 4) AS value FROM signed")
def t_square(t):
    return K.square(t.signed(), "balance").withColumn("value", F.round("value", 4))


@query("t_abs", f"WITH {SIGNED} SELECT row_id, abs(balance) AS value FROM signed")
def t_abs(t):
    return K.absolute(t.signed(), "balance")


@query("t_sqrt", f"""WITH {SIGNED} SELECT row_id, round(sqrt(balance), 6) AS value,
  row_number() OVER (ORDER BY row_id) - 1 AS position FROM signed WHERE balance >= 0""")
def t_sqrt(t):
    return K.square_roots(t.signed(), "balance").withColumn("value", F.round("value", 6))


@query("t_log", f"""WITH {SIGNED} SELECT row_id, round(ln(abs(balance) + 1e-10::DOUBLE), 6) AS value,
  row_number() OVER (ORDER BY row_id) - 1 AS position FROM signed WHERE balance IS NOT NULL""")
def t_log(t):
    return K.log_transform(t.signed(), "balance").withColumn("value", F.round("value", 6))


@query("t_cumsum", f"""WITH {ORDERS_N} SELECT row_id, CASE WHEN o_totalprice IS NOT NULL THEN
  round(sum(o_totalprice) OVER (ORDER BY row_id ROWS UNBOUNDED PRECEDING), 2) END AS value FROM orders_n""")
def t_cumsum(t):
    return K.cumulative_sum(t.orders_n(), "o_totalprice").withColumn("value", F.round("value", 2))


@query("t_diffs", f"""WITH {ORDERS_N}
SELECT row_id, round(o_totalprice - lag(o_totalprice) OVER (ORDER BY row_id), 2) AS value FROM orders_n""")
def t_diffs(t):
    return K.differences(t.orders_n(), "o_totalprice").withColumn("value", F.round("value", 2))


# ------------------------------------------------------------------ rows
def _row_query(name, answers, sql_columns):
    @query(name, f"WITH {ROW_LIST} SELECT l_orderkey, l_partkey, l_linenumber, {sql_columns} FROM row_list")
    def run(t):
        return row_answers(t.rows_num(), ROW_COLS, answers, ROW_KEYS)


def _row_measures(name, measures, sql_columns, digits=None):
    @query(name, f"WITH {ROW_LIST} SELECT l_orderkey, l_partkey, l_linenumber, {sql_columns} FROM row_list")
    def run(t):
        out = row_aggregates(t.rows_num(), ROW_COLS, measures, ROW_KEYS)
        for m in measures:
            if digits is not None:
                out = out.withColumn(m, F.round(m, digits))
        return out


def _p(expr, width=4):
    return ", ".join(f"({expr})[{i + 1}] AS p{i}" for i in range(width))


def _rounded(fn, n=6):
    return lambda a: F.round(fn(a), n)


_SORTED = "list_sort(nn)"
_row_query("t_non_empty_rows", spread_array(R.present, 4), _p("nn"))
_row_query(
    "t_unique_rows", spread_array(F.array_distinct, 4),
    _p("list_filter(a, lambda x, i: i = 1 OR NOT list_has_any([coalesce(x, -1)], list_transform(a[1:i-1], lambda y: coalesce(y, -1))))"),
)
_row_query("t_value_present_rows", {"present": lambda a: R.contains(a, F.lit(0.05))},
           "len(list_filter(nn, lambda x: x = 0.05)) > 0 AS present")
_row_query(
    "t_sort_rows",
    {**spread_array(R.ascending, 4), **{f"d{i}": (lambda a, i=i: F.get(R.descending(a), F.lit(i))) for i in range(4)}},
    _p("list_sort(nn)") + ", " + _p("list_reverse_sort(nn)").replace("AS p", "AS d"),
)
_row_measures("t_max_min_rows", ["max_value", "min_value"],
           "list_max(nn) AS max_value, list_min(nn) AS min_value")
_row_measures("t_sum_rows", ["sum_value"], "round(coalesce(list_sum(nn), 0), 6) AS sum_value", 6)
_row_measures("t_has_missing_rows", ["has_missing"], "len(nn) < 4 AS has_missing")
_row_measures("t_count_empty_rows", ["n_empty"], "(4 - len(nn))::BIGINT AS n_empty")
_row_query(
    "t_fill_missing_rows",
    spread_array(lambda a: F.transform(a, lambda x: F.coalesce(x, F.lit(42.0))), 4),
    _p("list_transform(a, lambda x: coalesce(x, 42.0::DOUBLE))"),
)
_row_query(
    "t_cumsum_rows", spread_array(lambda a: F.transform(R.running(a), lambda x: F.round(x, 4)), 4),
    _p("list_transform(a, lambda x, i: CASE WHEN x IS NOT NULL THEN round(list_sum(list_filter(a[1:i], lambda y: y IS NOT NULL)), 4) END)"),
)
_row_query(
    "t_diffs_rows", spread_array(lambda a: F.transform(R.differences(a), lambda x: F.round(x, 4)), 4),
    _p("list_transform(a, lambda x, i: CASE WHEN i > 1 THEN round(x - a[i-1], 4) END)"),
)
_row_measures("t_range_rows", ["value_range"], "round(list_max(nn) - list_min(nn), 4) AS value_range", 4)
_row_measures("t_mean_rows", ["mean_value"], "round(list_sum(nn) / len(nn), 6) AS mean_value", 6)
_row_query("t_median_rows", {"median_value": _rounded(R.median)}, f"""round(({_SORTED}[(len(nn) + 1) // 2]
  + {_SORTED}[len(nn) // 2 + 1]) / 2, 6) AS median_value""")
_row_query(
    "t_mode_rows", {"mode_value": R.mode},
    "list_sort(list_transform(nn, lambda x: {'c': -len(list_filter(nn, lambda y: y = x)), 'v': x}))[1].v AS mode_value",
)
