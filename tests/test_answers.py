"""What answers read: only what the prompts ask for."""

import pytest
from pyspark.sql import functions as F

from cellwright.operators.cells import to_cells
from cellwright.plans import answers as A, chat as H, prompts as Q

COLUMNS = ["a", "b", "same", "word"]


@pytest.fixture(scope="module")
def tables(spark):
    rows = [(f"t{k}.csv", i, float(i % 7), float(i % 5) if i % 3 else None, float(i % 7), f"w{i % 4}") for k in range(3) for i in range(30)]
    return spark.createDataFrame(rows, "table_id string, row_id long, a double, b double, same double, word string")


def planned(spark, tables, functions):
    ids = spark.range(60).withColumnRenamed("id", "prompt_id")
    return Q.plan_prompts(ids, Q.corpus_meta(tables, "word", COLUMNS), 7, functions)


def test_shapes_read_no_cells(spark, tables):
    broken = to_cells(tables, "table_id", columns=COLUMNS).withColumn("v_num", F.raise_error(F.lit("cells were read")).cast("double"))
    out = Q.render(A.answer(planned(spark, tables, ["table_shape"]), broken, 4)).collect()
    assert len(out) == 60 and {r["answer"] for r in out} == {"The table has 30 rows and 4 columns"}


def test_only_columns_whose_figures_agree_are_compared_by_row(spark, tables, monkeypatch):
    stored = {}
    store = A.store
    monkeypatch.setattr(A, "store", lambda df, label: stored.setdefault(label, store(df, label)))
    plan = planned(spark, tables, ["compare_rows_or_columns"])
    out = Q.render(A.answer(plan, to_cells(tables, "table_id", columns=COLUMNS), 4))
    asked = plan.where("axis = 1").join(out, "prompt_id").collect()
    twins = {0: 0, 1: 1, 2: 0, 3: 3}
    assert asked
    for r in asked:
        alike = twins[r["axis_index"]] == twins[r["index2"]]
        assert ("are identical" in r["answer"]) == alike, r
    left = {(r["index"], r["index2"]) for r in stored["compared_pairs"].collect()}
    assert left <= {(0, 2), (2, 0)} and stored["column_pairs"].count() > len(left)


def test_cells_kept_for_rows_are_those_asked_for(spark, tables, monkeypatch):
    stored = {}
    store = A.store
    monkeypatch.setattr(A, "store", lambda df, label: stored.setdefault(label, store(df, label)))
    plan = planned(spark, tables, ["find_value"]).where("prompt_id < 5")
    out = Q.render(A.answer(plan, to_cells(tables, "table_id", columns=COLUMNS), 4)).collect()
    assert len(out) == 5
    rows = plan.select("table_id", "any_row").distinct().count()
    assert stored["picked"].count() == rows * len(COLUMNS)


def test_ragged_columns_are_compared_by_row(spark):
    """A column without cells in some rows is judged by the rows both have."""
    cells = spark.createDataFrame(
        [("t", i, c, "double", float(i), None) for c in (0, 1) for i in range(4)] + [("t", i, 2, "double", float(i), None) for i in (0, 1, 2)],
        "table_id string, row_id long, col_id int, kind string, x double, t string",
    )
    one = A.Answers.__new__(A.Answers)
    one.values, one.figures = cells, A.column_figures(cells)
    pairs = spark.createDataFrame([("t", 0, 1), ("t", 0, 2), ("t", 2, 2)], "table_id string, index int, index2 int")
    assert {(r["index"], r["index2"]): r["same"] for r in one.same_columns(pairs).collect()} == {(0, 1): True, (0, 2): True, (2, 2): True}


def test_tables_no_turn_names_are_not_written_out(spark, tables):
    turns = spark.createDataFrame(
        [(1, 0, "user", H.TABLE_MARK + "\nhi", "t0.csv"), (1, 1, "assistant", "yes", "t0.csv")], "conv_id long, turn long, role string, text string, table_id string"
    )
    broken = tables.withColumn("word", F.when(F.col("table_id") == "t0.csv", F.col("word")).otherwise(F.raise_error(F.lit("written out")).cast("string")))
    texts, spans = H.build_training_text(turns, broken, COLUMNS)
    assert "Row 30 - " in texts.first()["text"] and spans.count() == 1


def test_pairs_of_columns_are_added_up_without_a_row_for_each_pair(spark, monkeypatch):
    stored = {}
    store = A.store
    monkeypatch.setattr(A, "store", lambda df, label: stored.setdefault(label, store(df, label)))
    # no decimals, two, six, missing ones; column 4 has numbers that are no millionths in one table
    number = lambda t, i, c: [float(i % 7) - 3, i * 1.25 - 1e5, None if i % 5 == 0 else i / 8 + 0.000001, None if i < 30 else 9e8 - i, i / 3 if t else 0.5][c]
    rows = [(f"t{t}", i, c, "double", number(t, i, c), None) for t in range(2) for i in range(A.PAIR_BLOCK + 20) for c in range(5)]
    values = spark.createDataFrame(rows, "table_id string, row_id long, col_id int, kind string, x double, t string").repartition(5)
    pairs = [(f"t{t}", a, b) for t in range(2) for a in range(5) for b in range(5) if a != b] + [("t2", 0, 1)]
    asked = spark.createDataFrame(pairs, "table_id string, pair_col1 int, pair_col2 int")
    got = {tuple(r)[:3]: r["pair"] for r in A.pair_figures(values, asked).collect()}
    # pairs are the exception: only those that have such numbers are joined by row
    most = {label: df.count() for label, df in stored.items()}
    assert most.pop("pairs", 0) <= 8 * (A.PAIR_BLOCK + 20) and max(most.values()) <= len(pairs)
    stored.clear()
    want = {tuple(r)[:3]: r["pair"] for r in A._joined_pairs(values, asked).collect()}
    assert set(got) == set(want) == set(pairs[:-1])
    for key, pair in want.items():
        if key[0] == "t1" and 4 in key:
            assert got[key]["n"] == pair["n"] and got[key]["s"]["xy"] == pytest.approx(pair["s"]["xy"])
        else:
            assert got[key] == pair, key


def test_only_columns_of_many_decimals_are_added_as_decimals(spark, monkeypatch):
    columns = [lambda i: round(i * 0.01 - 7, 2), lambda i: 999_999_999.999999 if i else None, lambda i: -(i / 1e6), lambda i: i / 3, lambda i: 1e9 + i, lambda i: None]
    rows = [(f"t{t}", i, c, "double", f(i), None) for t in range(2) for i in range(70) for c, f in enumerate(columns)]
    values = spark.createDataFrame(rows, "table_id string, row_id long, col_id int, kind string, x double, t string").repartition(3)
    want = {(r["table_id"], r["col_id"]): r["total"] for r in values.groupBy("table_id", "col_id").agg(
        F.coalesce(A.exact_sum(F.col("x")), F.lit(0.0)).alias("total")).collect()}
    stored = {}
    store = A.store
    monkeypatch.setattr(A, "store", lambda df, label: stored.setdefault(label, store(df, label)))
    figures = A.column_figures(values).collect()
    odd = {(t, c) for t in ("t0", "t1") for c in (3, 4)}
    assert {(r["table_id"], r["col_id"]) for r in stored["odd_columns"].collect()} == odd
    for r in figures:
        key = (r["table_id"], r["col_id"])
        assert r["total"] == (pytest.approx(want[key]) if key in odd else want[key]), key
        assert (r["n"], r["n_x"], r["top"]) == (70, {1: 69, 5: 0}.get(r["col_id"], 70), 69)


def test_cells_are_told_by_the_number_of_their_column(spark, tables, monkeypatch):
    joined = []
    inner = A.numbered_list
    monkeypatch.setattr(A, "numbered_list", lambda values, kind: joined.append((kind, inner(values, kind))) or joined[-1][1])
    out = Q.render(A.answer(planned(spark, tables, ["sort_values", "cumulative_sum", "unique_values"]), to_cells(tables, "table_id", columns=COLUMNS), 4))
    assert out.count() > 40
    assert {k for k, _ in joined} == {"sorted", "running", "unique"}
    # no text of a table's name is looked at for each cell
    assert all("table_id" not in df.columns and "c" in df.columns for _, df in joined)
