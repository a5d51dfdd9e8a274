"""Edge rows: gaps, ties, empty and one-row columns."""

import pytest
from pyspark.sql import functions as F

from cellwright.functions import rows as R
from cellwright.operators import cells as C, columns as K, stats as S

EDGE = [3.0, 1.0, None, 3.0, 1.0, 2.0]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(list(enumerate(EDGE)), "row_id long, v double").repartition(3)


def listed(df, by="position", value="value"):
    return [r[value] for r in df.orderBy(by).collect()]


def test_lists(edge):
    assert listed(K.non_empty(edge, "v")) == [3, 1, 3, 1, 2]
    assert listed(K.unique_values(edge, "v")) == [3, 1, None, 2]
    assert listed(K.cumulative_sum(edge, "v"), "row_id") == [3, 4, None, 7, 8, 10]
    assert listed(K.differences(edge, "v"), "row_id") == [None, -2, None, None, -2, 1]
    assert listed(K.sorted_values(edge, "v", True)) == [1, 1, 2, 3, 3, None]
    assert listed(K.sorted_values(edge, "v", False)) == [3, 3, 2, 1, 1, None]
    assert listed(K.extreme_n(edge, "v", 3, True), value="row_id") == [0, 3, 5]
    assert listed(K.extreme_n(edge, "v", 3, False), value="row_id") == [1, 4, 5]


def test_top_is_head_of_sort_and_diff_of_cumsum_is_identity(edge):
    assert listed(K.extreme_n(edge, "v", 4, True)) == listed(K.sorted_values(edge, "v", False))[:4]
    full = edge.fillna(0.0)
    sums = K.cumulative_sum(full, "v").withColumnRenamed("value", "v")
    assert listed(K.differences(sums, "v"), "row_id")[1:] == [x or 0.0 for x in EDGE][1:]


def test_row_functions_match_column_semantics(spark):
    df = spark.createDataFrame([(EDGE,), ([None, None],), ([5.0],)], "a array<double>")
    got = df.select(
        R.total(F.col("a")).alias("s"), R.mean(F.col("a")).alias("m"), R.median(F.col("a")).alias("md"),
        R.mode(F.col("a")).alias("mo"), R.deviation(F.col("a")).alias("sd"), R.running(F.col("a")).alias("r"),
        R.empty_count(F.col("a")).alias("e"), R.contains(F.col("a"), F.lit(3.0)).alias("c"),
    ).collect()
    assert (got[0].s, got[0].m, got[0].md, got[0].mo, got[0].e, got[0].c) == (10, 2, 2, 1, 1, True)
    assert got[0].r == [3, 4, None, 7, 8, 10]
    assert (got[1].s, got[1].m, got[1].md, got[1].mo, got[1].sd, got[1].c) == (0, None, None, None, None, False)
    assert (got[2].sd, got[2].mo) == (None, 5)


def test_quantiles(spark):
    rows = [("a", x) for x in (1.0, 2.0, 4.0, 10.0)] + [("hot", float(i % 50)) for i in range(1000)] + [("one", 7.0), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(4)
    got = {r.g: (r.q1, r.q2, r.q3) for r in S.exact_quantiles(df, ["g"], {"q1": 0.25, "q2": 0.5, "q3": 0.75}).collect()}
    assert got == {"a": (1.75, 3.0, 5.5), "hot": (12.0, 24.5, 37.0), "one": (7.0, 7.0, 7.0)}


def test_profile_of_constant_and_empty_columns(spark):
    df = spark.createDataFrame([(5.0, None, x) for x in (2.0, 2.0, 1.0, 1.0)], "five double, nothing double, tie double")
    got = {r.col_name: r for r in S.profile(df, df.columns).collect()}
    assert (got["five"].value_range, got["five"].std_value, got["five"].mode_value) == (0, 0, 5)
    assert (got["nothing"].sum_value, got["nothing"].mean_value, got["nothing"].mode_value, got["nothing"].n_distinct) == (0, None, None, 0)
    assert got["tie"].mode_value == 1


def test_correlation_is_null_for_a_constant_column(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (None, 5.0)], "x double, c double")
    row = S.correlation_steps(df, "x", "c").first()
    assert row.correlation is None and row.n_samples == 2 and row.x_mean == 1.5


def test_scaling_properties(spark):
    df = spark.range(100).select(F.col("id").alias("row_id"), (F.col("id") * 1.5 - 3).alias("v"), F.lit(2.0).alias("c"))
    z = S.scale(df, "v", "normalize").agg(F.min("value"), F.max("value")).first()
    assert tuple(z) == (0, 1)
    m, s = S.scale(df, "v", "standardize").agg(F.avg("value"), F.stddev("value")).first()
    assert m == pytest.approx(0) and s == pytest.approx(1)
    assert S.scale(df, "c", "robust_scale").where("value is not null").count() == 0
    with pytest.raises(ValueError):
        S.scale(df, "v", "log")


def test_cells_out_of_range_and_comparisons(spark):
    df = spark.createDataFrame([(0, 1, "a"), (1, None, "b"), (2, 1, "a")], "row_id long, n int, s string")
    asked = spark.createDataFrame([(0, 0), (1, 0), (2, 1), (3, 0), (-1, 0), (0, 2)], "row long, col int")
    got = {(r.row, r.col): (r.v_num, r.v_str) for r in C.cell_lookup(df, asked, ["n", "s"]).collect()}
    assert got == {(0, 0): (1, None), (1, 0): (None, None), (2, 1): (None, "a"), (3, 0): (None, None), (-1, 0): (None, None), (0, 2): (None, None)}
    pairs = spark.createDataFrame([(1, 0, 2), (2, 0, 1), (3, 1, 1)], "request_id long, row1 long, row2 long")
    same = {r.request_id: r.identical for r in C.compare_rows(df, pairs, ["n", "s"]).collect()}
    assert same == {1: True, 2: False, 3: True}
    assert all(r.identical for r in C.compare_columns(df, ["n", "s"]).where("col1 = col2").collect())


def test_table_mean_is_the_mean_of_column_means(spark):
    df = spark.createDataFrame([(1.0, 1.0), (None, 5.0)], "a double, b double")
    assert S.table_mean(df, ["a", "b"]).first()[0] == 2.0


def test_rows_that_do_not_exist_are_not_compared(spark):
    df = spark.createDataFrame([(0, 5), (1, 5)], "row_id long, v int")
    asked = spark.createDataFrame([(1, 0, 1), (2, 0, 9), (3, 8, 9), (4, 1, 1)], "request_id int, row1 long, row2 long")
    got = {r.request_id: r.identical for r in C.compare_rows(df, asked, ["v"]).collect()}
    assert got == {1: True, 2: None, 3: None, 4: True}
