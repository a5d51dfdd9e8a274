"""Preprocessing of cells by actions, against the wide form, and answers from cells."""

from pyspark.sql import functions as F

from cellwright.operators import corpus_preprocess as CP, metadata as M, preprocess as P
from cellwright.operators.cells import to_cells
from cellwright.plans import answers, prompts as Q

COLUMNS = ["id", "size", "flag", "colour", "label"]


def corpus(spark):
    """Two tables of one schema, with gaps, booleans and ties."""
    k = F.col("k")
    return spark.range(60).withColumnRenamed("id", "k").select(
        F.concat(F.lit("t"), k % 2, F.lit(".parquet")).alias("table_id"), F.floor(k / 2).alias("row_id"), k.alias("id"),
        F.when(k % 7 != 0, k / 8).alias("size"), (k % 3 == 0).alias("flag"),
        F.when(k % 5 != 0, F.concat(F.lit("c"), k % 4)).alias("colour"), F.concat(F.lit("l"), k % 3).alias("label"),
    )


def meta_of(df, label):
    ids = df.select("table_id").distinct()
    none = F.lit(None).cast("array<struct<source_feature:string,sink_feature:string,is_causal:boolean>>")
    return ids.select(
        "table_id", F.lit(label).alias("label_index"), F.lit(len(COLUMNS)).alias("num_cols"), F.lit(False).alias("is_synthetic_data"),
        F.lit(False).alias("has_causal"), none.alias("causal_info"),
    )


def shown(v):
    return None if v is None else f"{float(v):.6f}" if isinstance(v, (int, float)) else v


def compare(spark, opts):
    df = corpus(spark)
    wide = P.preprocess(df, "label", opts)
    names = [c for c in wide.columns if c not in ("table_id", "row_id", "original")]
    want = {}
    for r in wide.collect():
        for i, c in enumerate(names):
            want[r.table_id, r.row_id, i] = (c, shown(r[c]))
    cells, meta = CP.preprocess_corpus(to_cells(df, "table_id", columns=COLUMNS), meta_of(df, 4), opts)
    got = {(r.table_id, r.row_id, r.col_id): (r.col_name, shown(r.v_num if r.v_str is None else r.v_str)) for r in cells.collect()}
    return want, got, meta.collect(), wide


def test_encoded_profile_equals_the_wide_form(spark):
    for max_cols in (5, 8):
        want, got, meta, _ = compare(spark, P.Options(encoded=True, max_cols=max_cols))
        assert got == want
        assert all(m.num_cols == max_cols and m.label_index == max_cols - 1 and m.num_rows == 30 and not m.target_masked for m in meta)


def test_surplus_columns_are_left_out_by_a_draw_of_their_table(spark):
    df = corpus(spark)
    cells, meta = CP.preprocess_corpus(to_cells(df, "table_id", columns=COLUMNS), meta_of(df, 4), P.Options(encoded=True, max_cols=3))
    names = {}
    for r in cells.select("table_id", "col_id", "col_name").distinct().collect():
        names.setdefault(r.table_id, {})[r.col_id] = r.col_name
    for found in names.values():
        assert sorted(found) == [0, 1, 2] and found[2] == "label"
        assert COLUMNS.index(found[0]) < COLUMNS.index(found[1])


def test_raw_profile_equals_the_wide_form(spark):
    opts = P.Options(mask_fraction=0.3, keep_all_rows=False, context_length=1000)
    want, got, meta, wide = compare(spark, opts)
    # text of booleans is written as a number in cells
    flag = lambda d: {k: (c, v if c != "flag" else shown(float(v)) if v is not None else None) for k, (c, v) in d.items()}
    assert flag(got) == flag(want)
    masked = {r.table_id: r.n for r in wide.groupBy("table_id").agg(F.count("original").alias("n")).collect()}
    assert {m.table_id: m.n_masked for m in meta} == masked and all(m.num_rows == 20 for m in meta)


def test_tables_without_a_label_and_empty_corpora(spark):
    df = corpus(spark)
    meta = meta_of(df, 4).withColumn("label_index", F.when(F.col("table_id") == "t0.parquet", -1).otherwise(4))
    cells, out = CP.preprocess_corpus(to_cells(df, "table_id", columns=COLUMNS), meta, P.Options())
    assert {r.table_id for r in cells.select("table_id").distinct().collect()} == {"t1.csv"} == {r.table_id for r in out.collect()}
    none = df.limit(0)
    cells, out = CP.preprocess_corpus(to_cells(none, "table_id", columns=COLUMNS), meta_of(none, 4), P.Options())
    assert cells.count() == 0 and out.count() == 0


def test_rows_of_sampled_tables_count_from_zero(spark):
    df = corpus(spark)
    cells = to_cells(df.where("row_id % 3 = 1"), "table_id", columns=COLUMNS)
    rows = answers.value_cells(cells).select("table_id", "row_id").distinct().collect()
    assert sorted(tuple(r) for r in rows) == [(f"t{t}.parquet", i) for t in range(2) for i in range(10)]


def test_exact_sums_do_not_depend_on_order_and_fall_back(spark):
    df = spark.createDataFrame([(1, 0.1), (1, 0.2), (1, 0.3), (2, 1e300), (2, -1e300), (3, 1e-15), (3, None), (4, None)], "g int, x double")
    got = {r.g: r.s for r in df.groupBy("g").agg(answers.exact_sum(F.col("x")).alias("s")).collect()}
    assert got == {1: 0.6, 2: 0.0, 3: 1e-15, 4: None}


def test_questions_that_a_table_cannot_answer_are_dropped(spark):
    texts = spark.createDataFrame([("only.csv", 0, "a", "x"), ("only.csv", 1, "b's", "y")], "table_id string, row_id long, one string, two string")
    cells = to_cells(texts, "table_id", columns=["one", "two"])
    meta = spark.createDataFrame(
        [("only.csv", 2, 2, [1, 1], 1, False)], "table_id string, num_rows long, num_cols int, categorical_columns array<int>, label_index int, has_causal boolean"
    ).withColumn("causal_info", F.lit(None).cast("array<struct<source_feature:string,sink_feature:string,is_causal:boolean>>"))
    prompts = spark.range(120).withColumnRenamed("id", "prompt_id")
    out = Q.generate_prompts(prompts, cells, meta, None, 5).collect()
    numeric = {"mean_value", "sort_values", "sum_values", "direct_correlation_between_columns", "add_cells", "square_values"}
    assert out and not numeric & {r.fn for r in out}
    assert any('"b\'s"' in r.answer for r in out if r.fn in ("non_empty_cells", "unique_values", "fill_missing_values"))


def test_rows_that_do_not_stay_are_not_encoded_or_masked(spark, monkeypatch):
    """Only the draws and the texts to number are taken of all rows; the cells that are worked on are those that stay."""
    stored = {}
    plain = CP.store
    monkeypatch.setattr(CP, "store", lambda df, label: stored.setdefault(label, plain(df, label)))
    df = corpus(spark)
    cells = to_cells(df, "table_id", columns=COLUMNS)
    for encoded in (False, True):
        stored.clear()
        opts = P.Options(encoded=encoded, max_cols=8, seed=3, keep_all_rows=False, context_length=400)
        out = CP.preprocess_corpus(cells, meta_of(df, 4), opts)[0]
        rows = out.select("table_id", "row_id").distinct().count()
        assert rows < 60
        assert stored["kept_cells"].count() == rows * len(COLUMNS)
        assert stored["row_draws"].count() == 60


def test_prompts_of_one_file_are_planned_by_many_tasks(spark):
    prompts = spark.range(1000).withColumnRenamed("id", "prompt_id").coalesce(1)
    drawn = Q.draw_tables(prompts, meta_of(corpus(spark), 4), 3).where("prompt_id >= 0")
    assert drawn.rdd.getNumPartitions() > 1
    assert drawn.count() == 1000
