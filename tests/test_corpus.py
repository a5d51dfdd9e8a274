"""Reading corpora, label choice, preprocessing."""

import json

import pytest
from pyspark.sql import functions as F

from cellwright.operators import metadata as M, preprocess as P
from cellwright.sources import files as IO


def test_read_corpus_mixes_formats_and_isolates_bad_files(spark, tmp_path):
    import pandas as pd

    pd.DataFrame({"a": [1, 2, 3], "s": ["x", None, "z"]}).to_parquet(tmp_path / "one.parquet")
    pd.DataFrame({"a": [4.5, float("nan")]}).to_parquet(tmp_path / "two.parquet")
    (tmp_path / "broken.parquet").write_text("no parquet here")
    (tmp_path / "Causal_Table1.csv").write_text("0.5,1,0\n0.25,2\nx,3,0\n")
    (tmp_path / "wide.csv").write_text("1,2\n1,2,3\n")
    (tmp_path / "notes.txt").write_text("skipped")
    cells, rejects = IO.read_corpus(spark, str(tmp_path))
    got = {(r.table_id, r.row_id, r.col_id): (r.v_num, r.v_str) for r in cells.collect()}
    assert got["one.parquet", 1, 1] == (None, None) and got["one.parquet", 2, 1] == (None, "z")
    assert got["two.parquet", 1, 0] == (None, None)
    assert got["Causal_Table1.csv", 1, 2] == (None, None) and got["Causal_Table1.csv", 2, 0] == (None, "x")
    assert got["Causal_Table1.csv", 1, 0] == (None, "0.25") and got["Causal_Table1.csv", 1, 1] == (2.0, None)
    assert {t for t, *_ in got} == {"one.parquet", "two.parquet", "Causal_Table1.csv"}
    assert {r.table_id for r in rejects.collect()} == {"broken.parquet", "wide.csv"}


def test_csv_header_quotes_and_part_files(spark, tmp_path):
    (tmp_path / "city.csv").write_text('city,n\n"x, ""y""",2\nz,NA\n\n"",3\n')
    (tmp_path / "table_id=parts.csv").mkdir()
    (tmp_path / "table_id=parts.csv" / "part-0.csv").write_text("k\n1\n2\n")
    (tmp_path / "table_id=parts.csv" / "part-1.csv").write_text("3\n")
    cells, rejects = IO.read_corpus(spark, str(tmp_path), header=True)
    got = {(r.table_id, r.row_id, r.col_name): (r.v_num, r.v_str) for r in cells.collect()}
    assert got == {
        ("city.csv", 0, "city"): (None, 'x, "y"'), ("city.csv", 0, "n"): (2.0, None), ("city.csv", 1, "city"): (None, "z"),
        ("city.csv", 1, "n"): (None, None), ("city.csv", 2, "city"): (None, None), ("city.csv", 2, "n"): (3.0, None),
        ("parts.csv", 0, "k"): (1.0, None), ("parts.csv", 1, "k"): (2.0, None), ("parts.csv", 2, "k"): (3.0, None),
    }
    assert rejects.collect() == []


def test_row_ids_go_on_from_file_to_file(spark, tmp_path):
    spark.range(40).repartitionByRange(4, "id").sortWithinPartitions("id").write.parquet(str(tmp_path / "t"))
    got = IO.read_table(spark, str(tmp_path / "t"), row_id=True).collect()
    assert sorted((r.id, r.row_id) for r in got) == [(i, i) for i in range(40)]


def test_causal_json_array(spark, tmp_path):
    records = [{"causal_info": [{"source_feature": "a", "sink_feature": "b", "is_causal": True}]}, {"causal_info": []}]
    (tmp_path / "causal.json").write_text(json.dumps(records))
    back = IO.read_records(spark, str(tmp_path / "causal.json"), IO.CAUSAL_SCHEMA, array_file=True)
    assert sorted(len(r.causal_info) for r in back.collect()) == [0, 1]


def _cells(spark, rows):
    return spark.createDataFrame(rows, "table_id string, row_id long, col_id int, col_name string, col_type string, v_num double, v_str string")


def test_label_rules(spark):
    rows = []
    for i in range(40):
        rows += [
            ("t.parquet", i, 0, "key", "bigint", float(i), None),
            ("t.parquet", i, 1, "Unnamed: 0", "bigint", 1.0, None),
            ("t.parquet", i, 2, "when", "timestamp_ntz", None, "2020"),
            ("t.parquet", i, 3, "long", "string", None, "x" * (257 if i else 1)),
            ("t.parquet", i, 4, "few", "string", None, "ab"[i % 2]),
            ("t.parquet", i, 5, "many", "double", float(i // 2), None),
            ("none.parquet", i, 0, "key", "bigint", float(i), None),
        ]
    profile = M.column_profile(_cells(spark, rows))
    kinds = {r.col_name: r.kind for r in M.label_candidates(profile).collect()}
    assert kinds == {"few": "categorical", "many": "continuous"}
    label = {r.table_id: (r.label_index, r.num_classes, r.is_classification) for r in M.label_stats(profile, 3).collect()}
    assert label["none.parquet"] == (-1, 0, False)
    assert label["t.parquet"] in {(4, 2, True), (5, 0, False)}


def test_synthetic_tables_drop_zero_padding(spark):
    rows = [("Causal_Table9.csv", i, c, str(c), "double", float(v), None) for i in range(3) for c, v in enumerate((i, 0, 1))]
    meta = M.build_metadata(_cells(spark, rows), 1).first()
    assert (meta.num_cols, meta.categorical_columns, meta.label_index, meta.is_classification) == (2, [0, 0], 2, True)


def test_mask_ledger_restores_the_original(spark):
    df = spark.range(97).select(F.lit("t").alias("table_id"), F.col("id").alias("row_id"), (F.col("id") % 3).alias("y"))
    masked = P.mask_target(df, "y", 0.15, "missing", 5, ["table_id"])
    assert masked.where("y = 'missing'").count() == int(97 * 0.15)
    restored = {r.row_id: r.original or r.y for r in masked.collect()}
    assert restored == {i: str(i % 3) for i in range(97)}


def test_label_encode_sorts_and_puts_missing_last(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",), ("c",), ("a",)], "s string")
    codes = {(s.s, e.s) for s, e in zip(df.collect(), P.label_encode(df.withColumn("k", F.monotonically_increasing_id()), ["s"]).orderBy("k").collect())}
    assert codes == {("a", 0), ("b", 1), ("c", 2), (None, 3)}


def test_preprocess_profiles(spark):
    df = spark.range(60).select(
        F.concat(F.lit("t"), F.col("id") % 2, F.lit(".parquet")).alias("table_id"), F.floor(F.col("id") / 2).alias("row_id"),
        (F.col("id") / 7).alias("x"), (F.col("id") % 2 == 0).alias("b"), F.concat(F.lit("k"), F.col("id") % 5).alias("y"),
    )
    raw = P.preprocess(df, "y", P.Options(context_length=300, tokens_per_cell=10, keep_all_rows=False))
    assert raw.groupBy("table_id").count().where("count = 10").count() == 2
    assert {r.table_id for r in raw.collect()} == {"t0.csv", "t1.csv"}
    enc = P.preprocess(df, "y", P.Options(encoded=True, max_cols=6))
    assert enc.columns == ["table_id", "row_id", "x", "b", "padded_3", "padded_4", "padded_5", "y", "original"]
    assert {r.b for r in enc.collect()} == {0, 1} and {r.y for r in enc.collect()} == set(range(5))
    assert P.row_budget(7) == 3572 and P.row_budget(101) == 248


def test_drop_columns_keeps_order():
    names = [f"c{i}" for i in range(20)]
    kept = P.drop_columns(names, 7, 3)
    assert len(kept) == 7 and kept == sorted(kept, key=names.index) and kept == P.drop_columns(names, 7, 3)
    assert P.trim_padding(names, 4) == ["c0", "c1", "c2"]


def test_profile_writes_numbers_out_once_for_each_value(spark):
    """Rendering comes after the values are reduced; zeros of both signs and exact digits stay apart."""
    rows = spark.createDataFrame(
        [("t", 0, "a", "double", v, None, None) for v in (0.0, -0.0, 1.5, 1.5, None)]
        + [("t", 1, "b", "bigint", float(1 << 60), None, e) for e in (None, str((1 << 60) + 1), str((1 << 60) + 1))]
        + [("t", 2, "c", "string", None, s, None) for s in ("", "x" * 40, "x" * 40, "y", None)],
        "table_id string, col_id int, col_name string, col_type string, v_num double, v_str string, v_exact string",
    )
    out = M.column_profile(rows)
    got = {r.col_id: (r.n_rows, r.n_distinct, r.max_len, r.active) for r in out.collect()}
    assert got == {0: (5, 3, 4, True), 1: (3, 2, 19, True), 2: (5, 3, 40, True)}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.rindex("Aggregate"):].split("\n", 1)[1]
    assert "substring_index" in plan and "substring_index" not in below


def test_csv_lines_are_read_once_and_not_dealt_anew(spark, tmp_path, monkeypatch):
    for t in range(3):
        (tmp_path / f"t{t}.csv").write_text("".join(f"{i},{i if t else 'x'},\"a,{i}\"\n" + "\n" * (i % 9 == 0) for i in range(300)))
    stored = []
    store = IO.store
    monkeypatch.setattr(IO, "store", lambda df, label: stored.append((label, df)) or store(df, label))
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        # pieces of files
        spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
        spark.conf.set("spark.sql.files.openCostInBytes", "10")
        cells, rejected = IO.read_corpus(spark, str(tmp_path))
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert rejected.count() == 0
    got = {(r["table_id"], r["row_id"], r["col_id"]): (r["v_num"], r["v_str"]) for r in cells.collect()}
    assert got == {
        (f"t{t}.csv", i, c): [(float(i), None), (float(i), None) if t else (None, "x"), (None, f"a,{i}")][c]
        if c != 1 or t else (None, "x") for t in range(3) for i in range(300) for c in range(3)
    }
    text = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert sum("FileScan text" in text(df) for _, df in stored) == 1
    assert "Exchange hashpartitioning" not in text(cells) and "Exchange rangepartitioning" not in text(cells)


def test_tables_written_by_tasks_are_those_spark_writes(spark, tmp_path):
    from queries.corpus import _write_lines

    lines = [(f"t{i % 40}.csv", i // 40, None if i % 7 == 0 else f'{i},"é, {i}"') for i in range(20_000)]
    rows = spark.createDataFrame(lines, "table_id string, row_id long, line string").repartition("table_id")
    rows = rows.sortWithinPartitions("table_id", "row_id").select("table_id", "line")
    _write_lines(rows, f"file:{tmp_path}/ours")
    rows.write.partitionBy("table_id").text(f"{tmp_path}/theirs")
    told = lambda folder: {p.name: "".join(f.read_text() for f in sorted(p.glob("part-*.txt"))) for p in (tmp_path / folder).glob("table_id=*")}
    assert len(told("ours")) == 40 and told("ours") == told("theirs")
