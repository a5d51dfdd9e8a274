"""Rounding and number text agree with decimal arithmetic on the exact value."""

import random

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from cellwright.functions.draws import uniform
from cellwright.functions.numbers import round_exact
from cellwright.functions.text import fixed, render_number


def test_round_exact_on_ties_and_near_ties(spark):
    r = random.Random(5)
    values = [2.675, 0.125, 0.375, 1.005, 8.345, -2.675, -0.125, 0.0625, 1e15, 66.76 / 8]
    values += [round(r.uniform(-1000, 1000), 3) for _ in range(3000)] + [r.randint(0, 10**6) / 8 for _ in range(1000)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = df.select("v", round_exact(F.col("v"), 2).alias("r"), fixed(F.col("v")).alias("f")).collect()
    for row in got:
        assert row.r == round(row.v, 2), row.v
        assert float(row.f) == float(f"{row.v:.3f}"), row.v


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(-1e9, 1e9), min_size=200, max_size=200))
def test_round_exact_on_any_doubles(spark, values):
    got = spark.createDataFrame([(v,) for v in values], "v double").select("v", round_exact(F.col("v"), 2).alias("r")).collect()
    assert all(row.r == round(row.v, 2) for row in got)


def test_render_number(spark):
    cases = [(25.0, False, "25.0"), (25.0, True, "25"), (0.125, False, "0.125"), (1e7, False, "10000000.0"), (-3.5, False, "-3.5"), (None, False, "nan"), (100.0, False, "100.0"), (1e20, False, "100000000000000000000.0"), (-1.25e-7, False, "-0.000000125"), (1.5e300, True, "15" + "0" * 299), (12345678.5, False, "12345678.5"), (5e20, True, "5" + "0" * 20), (0.0, True, "0"), (1e-19, False, "0.0000000000000000001")]
    df = spark.createDataFrame([(v, w) for v, w, _ in cases], "v double, w boolean")
    assert [r[0] for r in df.select(render_number(F.col("v"), F.col("w"))).collect()] == [c for *_, c in cases]


def test_draws_do_not_depend_on_partitions(spark):
    a = {r.id: r.u for r in spark.range(100).select("id", uniform(1, "id").alias("u")).collect()}
    b = {r.id: r.u for r in spark.range(100).repartition(7).select("id", uniform(1, "id").alias("u")).collect()}
    assert a == b and all(0 <= u < 1 for u in a.values())


def test_rounding_seven_columns_stays_compiled(spark):
    """Methods of more than 8,000 bytes are interpreted by the JVM: rounding a table's columns has to stay below."""
    df = spark.range(10).select(*[(F.col("id") / (i + 3)).alias(f"c{i}") for i in range(7)]).where("c0 IS NOT NULL")
    rounded = df.select(*[round_exact(F.col(c), 2).alias(c) for c in df.columns])
    parts = rounded._jdf.queryExecution().debug().codegenToSeq()
    assert max(parts.apply(i)._3().maxMethodCodeSize() for i in range(parts.size())) < 8000


def test_rounding_of_halves_zeros_and_values_without_decimals(spark):
    values = [2.675, 1.005, 0.125, 0.375, -0.125, -2.675, 1e17, -0.0, -0.001, float("inf"), None, 2.5, 0.005, 8.345]
    df = spark.createDataFrame([(v,) for v in values], "x double").select(round_exact(F.col("x"), 2).cast("string").alias("t"))
    assert [r.t for r in df.collect()] == [
        "2.67", "1.0", "0.12", "0.38", "-0.12", "-2.67", "1.0E17", "0.0", "0.0", "Infinity", None, "2.5", "0.01", "8.35",
    ]
