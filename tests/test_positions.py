"""Ordered work on blocks gives what one global pass would give."""

import random

import pytest
from pyspark.sql import functions as F

from cellwright.functions.draws import uniform
from cellwright.operators import positions
from cellwright.operators.positions import (
    dense_position, number_rows, prefix_sum, previous_value, take_lowest,
)

R = random.Random(1)
#: one group holds most rows
ROWS = [("hot" if i % 3 else f"g{i % 7}", i * 3, None if i % 5 == 0 else float(R.randint(-9, 9))) for i in range(600)]


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(ROWS, "g string, pos long, v double").repartition(5)


def groups():
    out = {}
    for g, p, v in sorted(ROWS):
        out.setdefault(g, []).append((p, v))
    return out


def test_number_rows_is_dense_per_group(df):
    got = {(r.g, r.pos): r.row_id for r in number_rows(df, ["pos"], ["g"]).collect()}
    want = {(g, p): i for g, rows in groups().items() for i, (p, _) in enumerate(rows)}
    assert got == want


def test_number_rows_with_ties_in_the_leading_key(spark):
    rows = spark.range(500).select((F.col("id") % 2).alias("k"), "id")
    got = [r.id for r in number_rows(rows, ["k", F.desc("id")]).orderBy("row_id").collect()]
    assert got == sorted(range(500), key=lambda i: (i % 2, -i))


@pytest.mark.parametrize("block", [7, 100, 1 << 18])
def test_blocks(df, block):
    kept = df.where("v is not null")
    dense = {(r.g, r.pos): r.position for r in dense_position(kept, "pos", ["g"], block=block).collect()}
    sums = {(r.g, r.pos): r.running for r in prefix_sum(df, "pos", "v", ["g"], block=block).collect()}
    prev = {(r.g, r.pos): r.previous for r in previous_value(df, "pos", "v", ["g"], block=block).collect()}
    for g, rows in groups().items():
        total, n, before = 0.0, 0, None
        for p, v in rows:
            assert prev[g, p] == before
            before = v
            if v is None:
                assert sums[g, p] is None and (g, p) not in dense
                continue
            total += v
            assert sums[g, p] == pytest.approx(total)
            assert dense[g, p] == n
            n += 1


@pytest.mark.parametrize("bits", [1, 3, 12])
def test_take_lowest_is_exact_and_independent_of_partitions(df, bits, monkeypatch):
    monkeypatch.setattr("cellwright.operators.positions._BITS", bits)

    def chosen(frame):
        drawn = frame.withColumn("u", uniform(3, "g", "pos"))
        out = take_lowest(drawn, "u", ["pos"], F.floor(F.col("n") * 0.2), ["g"])
        return {(r.g, r.pos) for r in out.where("chosen").collect()}, drawn

    got, drawn = chosen(df)
    draws = {}
    for r in drawn.collect():
        draws.setdefault(r.g, []).append((r.u, r.pos))
    want = {(g, p) for g, d in draws.items() for _, p in sorted(d)[: int(len(d) * 0.2)]}
    assert got == want
    assert chosen(df.repartition(2))[0] == want


def test_take_lowest_with_equal_draws_and_without_groups(spark):
    df = spark.range(100).select("id", (F.floor(F.col("id") / 10) / 16).alias("u"))
    flagged = take_lowest(df, "u", ["id"], F.lit(37))
    assert sorted(r.id for r in flagged.where("chosen").collect()) == list(range(37))
    assert take_lowest(df, "u", ["id"], F.lit(0)).where("chosen").count() == 0
    assert take_lowest(df, "u", ["id"], F.lit(1000)).where("chosen").count() == 100
    assert take_lowest(df.limit(0), "u", ["id"], F.lit(5)).count() == 0


def test_small_groups_are_ranked_without_histograms(spark, monkeypatch):
    from cellwright.operators import positions

    stored = []
    plain = positions.store
    monkeypatch.setattr(positions, "store", lambda df, label: stored.append(label) or plain(df, label))
    df = spark.range(300).select((F.col("id") % 3).alias("g"), "id", (F.col("id") / 300).alias("u"))
    flagged = take_lowest(df, "u", ["id"], F.when(F.col("g") == 0, F.lit(500)).otherwise(F.lit(7)), ["g"])
    got = sorted(r.id for r in flagged.where("chosen").collect())
    assert got == sorted([*range(0, 300, 3), *range(1, 21, 3), *range(2, 21, 3)])
    assert "cut_bins" not in stored


@pytest.mark.parametrize("last", [2, 20, 100])
def test_cut_points_of_groups_of_different_sizes(spark, last, monkeypatch):
    monkeypatch.setattr("cellwright.operators.positions._LAST", last)
    monkeypatch.setattr("cellwright.operators.positions._BITS", 3)
    sizes = {"a": 1, "b": 5, "c": 90, "d": 1500}
    rows = [(g, i, (i * 7919 % n) / n) for g, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame(rows, "g string, id int, u double")
    flagged = take_lowest(df, "u", ["id"], F.ceil(F.col("n") * 0.4), ["g"])
    got = {(r.g, r.id) for r in flagged.where("chosen").collect()}
    want = set()
    for g, n in sizes.items():
        mine = sorted((u, i) for h, i, u in rows if h == g)
        want |= {(g, i) for _, i in mine[: -(-n * 2 // 5)]}
    assert got == want


def test_rows_are_numbered_with_the_wanted_columns_only(spark, monkeypatch):
    """Order columns that nothing needs afterwards are not written; groups with names that begin alike stay apart."""
    written = []
    real = positions.store
    monkeypatch.setattr(positions, "store", lambda df, label: written.append((label, df.columns)) or real(df, label))
    df = spark.createDataFrame([(f"same_beginning_{i % 7}", i * 37 % 100, i) for i in range(100)], "g string, pos int, x int")
    out = number_rows(df, ["pos"], ["g"], keep=["g", (F.col("x") + 1).alias("y")])
    assert out.columns == ["g", "y", "row_id"] and ("numbered", ["g", "y", "_at"]) in written
    for g in range(7):
        want = [i + 1 for i in sorted(range(g, 100, 7), key=lambda i: i * 37 % 100)]
        assert [r.y for r in out.where(F.col("g") == f"same_beginning_{g}").orderBy("row_id").collect()] == want


@pytest.mark.parametrize("low, high", [(0.0, 0.001), (0.9, 1.0), (0.0, 1.0)])
def test_lowest_draws_unlike_uniform_ones(spark, low, high):
    """Only rows near the expected cut are ranked; where they are too few the whole group is."""
    draw = F.lit(low) + (F.col("id") * 7919 % 1000) / 1000 * (high - low)
    df = spark.range(1000).select("id", (F.col("id") % 3).alias("g"), draw.alias("u")).localCheckpoint()
    rows = df.collect()
    for within in (["g"], []):
        flagged = {r.id for r in take_lowest(df, F.col("u"), ["id"], F.floor(F.col("n") * 0.2), within).where("chosen").collect()}
        groups = {}
        for r in rows:
            groups.setdefault(r.g if within else 0, []).append((r.u, r.id))
        assert flagged == {i for x in groups.values() for _, i in sorted(x)[: len(x) // 5]}
