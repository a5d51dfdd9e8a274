"""Prompts, chat text and synthetic data."""

import re

import pytest
from pyspark.sql import functions as F

from cellwright.operators.cells import to_cells
from cellwright.operators.positions import number_rows
from cellwright.plans import chat as H, prompts as Q, synth as D
from cellwright.plans.templates import DRAWABLE, TEMPLATES

COLUMNS = ["a", "b", "y"]


@pytest.fixture(scope="module")
def tables(spark):
    return spark.range(80).select(
        F.concat(F.lit("t"), F.col("id") % 4, F.lit(".csv")).alias("table_id"), F.floor(F.col("id") / 4).alias("row_id"),
        (F.col("id") * 37 % 11).cast("int").alias("a"), F.when(F.col("id") % 9 != 0, F.col("id") / 4).alias("b"),
        (F.col("id") % 3).cast("int").alias("y"),
    )


def _meta(tables):
    return Q.corpus_meta(tables, "y", COLUMNS)


@pytest.mark.parametrize("encoded", [True, False])
def test_every_function_is_answered(spark, tables, encoded):
    ids = spark.range(400).select(F.col("id").alias("prompt_id"))
    out = Q.generate_prompts(ids, tables, _meta(tables), COLUMNS, 3, encoded=encoded).collect()
    totals = {"sum_table_values", "average_table_values"}
    assert {r.fn for r in out} == set(DRAWABLE) - (set() if encoded else totals)
    assert all(r.question.endswith("\n<table>") for r in out)
    assert not any(re.search(r"\{\w+\}", r.question + r.answer) for r in out)
    again = Q.generate_prompts(ids.repartition(3), tables.repartition(5), _meta(tables), COLUMNS, 3, encoded=encoded)
    assert sorted(map(tuple, out)) == sorted(map(tuple, again.collect()))


def test_answers_against_plain_python(spark, tables):
    ids = spark.range(300).select(F.col("id").alias("prompt_id"))
    data = {}
    for r in sorted(tables.collect(), key=lambda r: r.row_id):
        data.setdefault(r.table_id, []).append(r)
    checked = 0
    for r in Q.generate_prompts(ids, tables, _meta(tables), COLUMNS, 3).collect():
        if r.fn == "top_n_values":
            n, col = map(int, re.match(r"What are the top (\d+) values in column (\d+)", r.question).groups())
            values = sorted((x[COLUMNS[col]] for x in data[r.table_id] if x[COLUMNS[col]] is not None), reverse=True)[:n]
            assert r.answer.endswith(": " + repr(values))
        elif r.fn == "cumulative_sum":
            col, a, b = map(int, re.search(r"column (\d+)\? .* index (\d+) to (\d+)", r.question).groups())
            total, sums = 0, []
            for x in data[r.table_id]:
                v = x[COLUMNS[col]]
                total += v or 0
                sums.append("nan" if v is None else repr(total))
            assert r.answer.endswith("[" + ", ".join(sums[a:b]) + "]")
        elif r.fn == "find_value":
            row, col = map(int, re.search(r"row (\d+) column (\d+)", r.question).groups())
            v = data[r.table_id][row][COLUMNS[col]]
            assert r.answer.endswith("is " + ("nan" if v is None else repr(v)))
        elif r.fn == "count_value_occurrences":
            value, n = re.search(r"value (\S+) appears (\d+) times", r.answer).groups()
            assert int(n) == sum(x[c] == float(value) for x in data[r.table_id] for c in COLUMNS) > 0
        else:
            continue
        checked += 1
    assert checked > 15


def test_cells_of_mixed_schemas_give_the_same_answers(spark, tables):
    """Tables as cells, beside a table of another schema, answer like the wide form."""
    ids = spark.range(150).select(F.col("id").alias("prompt_id"))
    meta = Q.corpus_meta(tables, COLUMNS[-1], COLUMNS)
    wide = {tuple(r) for r in Q.generate_prompts(ids, tables, meta, COLUMNS, 3).collect()}
    other = spark.createDataFrame([(i, "x" * (i % 7), i % 2 == 0) for i in range(30_000)], "row_id long, s string, b boolean")
    cells = to_cells(tables, "table_id", columns=COLUMNS).unionByName(to_cells(other, F.lit("z_other.csv")))
    assert {tuple(r) for r in Q.generate_prompts(ids, cells, meta, None, 3).collect()} == wide
    long = meta.where("false").unionByName(spark.createDataFrame([("z_other.csv", 30_000, 2, [1, 1], 1, False, None)], meta.schema))
    out = Q.generate_prompts(ids.limit(25), cells, long, None, 3).collect()
    assert out and {r.table_id for r in out} == {"z_other.csv"}


def test_no_numeric_columns_skips_instead_of_failing(spark):
    df = spark.createDataFrame([("t.csv", 0, "x", "y"), ("t.csv", 1, "x", "z")], "table_id string, row_id long, s string, y string")
    meta = Q.corpus_meta(df, "y", ["s", "y"])
    ids = spark.range(120).select(F.col("id").alias("prompt_id"))
    out = Q.generate_prompts(ids, df, meta, ["s", "y"], 3).collect()
    assert {r.fn for r in out} <= {"find_value", "fetch_neighbors", "table_shape", *Q.AXIS_FNS, *Q.VALUE_FNS} and out


def test_causal_prefers_positive_entries_and_skips_empty_ones(spark, tables):
    info = "array<struct<source_feature:string,sink_feature:string,is_causal:boolean>>"
    rows = [("Causal_Table1.csv", [("p", "q", False), ("r", "s", True)]), ("Causal_Table2.csv", [])]
    meta = spark.createDataFrame(rows, f"table_id string, causal_info {info}").select(
        "table_id", F.lit(5).cast("bigint").alias("num_rows"), F.lit(3).alias("num_cols"),
        F.array(*[F.lit(0)] * 3).alias("categorical_columns"), F.lit(2).alias("label_index"), F.lit(True).alias("has_causal"), "causal_info",
    )
    ids = spark.range(40).select(F.col("id").alias("prompt_id"))
    out = Q.generate_prompts(ids, tables, meta, COLUMNS, 3).collect()
    assert {(r.table_id, r.answer) for r in out} == {("Causal_Table1.csv", "Yes, there is a causal relationship between feature r and feature s.")}


def test_wording_is_complete():
    assert len(TEMPLATES) == 37 and len(DRAWABLE) == 36


TURNS = [
    (1, 0, "system", "be brief"), (1, 1, "user", "hi <table>"), (1, 2, "assistant", "yes"), (1, 3, "user", "and?"), (1, 4, "assistant", "no\nmore"), (1, 5, "user", "bye"),
    (2, 0, "assistant", "early"), (2, 1, "user", "q"), (2, 2, "assistant", "a"),
    (3, 0, "user", "q"), (3, 1, "user", "q"), (3, 2, "assistant", "a"),
]


@pytest.fixture(scope="module")
def turns(spark):
    return spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string")


@pytest.mark.parametrize("name", ["llama_3", "single", "llama_2"])
def test_spans_cut_the_answers(turns, name):
    text = {r.conv_id: r.text for r in H.render_chat(turns, name).collect()}
    assert set(text) == {1, 2}  # the third breaks the order of roles
    cut = [text[r.conv_id][r.start:r.end].strip() for r in H.supervised_spans(turns, name).orderBy("conv_id", "i").collect()]
    assert cut == ["yes", "no\nmore", "a"]
    assert "be brief" in text[1] and "bye" not in text[1] and "early" not in text[2]


def test_rendered_formats(turns):
    two = {r.conv_id: r.text for r in H.render_chat(turns, "two").collect()}[1]
    assert two == "be brief\nHuman: hi <table>\nAssistant: yes</s>Human: and?\nAssistant: no\nmore</s>"
    old = {r.conv_id: r.text for r in H.render_chat(turns, "llama_2").collect()}[1]
    assert old == "[INST] <<SYS>>\nbe brief\n<</SYS>>\n\nhi <table> [/INST] yes </s><s>[INST] and? [/INST] no\nmore </s>"
    new = {r.conv_id: r.text for r in H.render_chat(turns, "llama_3").collect()}[2]
    assert new.endswith("<|start_header_id|>user<|end_header_id|>q<|eot_id|><|start_header_id|>assistant<|end_header_id|>a<|eot_id|>")
    with pytest.raises(ValueError):
        H.render_chat(turns, "plain")


def test_training_text_spans_survive_the_table(spark, turns, tables):
    texts, spans = H.build_training_text(turns.withColumn("table_id", F.lit("t1.csv")), tables, COLUMNS)
    text = {r.conv_id: r.text for r in texts.collect()}
    assert "<tb_start>Row 1 - column 1: " in text[1] and ".<tb_end>" in text[1] and "<table>" not in text[1]
    assert [text[r.conv_id][r.start:r.end] for r in spans.orderBy("conv_id", "i").collect()] == ["yes", "no\nmore", "a"]


def test_blocks_of_table_text_are_the_text(spark):
    tables = spark.createDataFrame([(t, i, f"v{i}") for t, n in (("t", 7), ("u", 1), ("w", 6)) for i in range(n)], "table_id string, row_id long, v string")
    whole = {t: ". ".join(f"Row {i + 1} - column 1: v{i}" for i in range(n)) + "." for t, n in (("t", 7), ("u", 1), ("w", 6))}
    joined = {}
    for b in H.table_text_blocks(tables, ["v"], rows=3, find="v4").orderBy("table_id", "block").collect():
        assert b.start == len(joined.get(b.table_id, "")) and b.n_chars == len(b.text)
        assert b.found_at == (whole[b.table_id].index("v4") if "v4" in b.text else None)
        joined[b.table_id] = joined.get(b.table_id, "") + b.text
    assert joined == whole


@pytest.mark.parametrize("name", ["llama_3", "single", "llama_2"])
def test_spans_cut_the_answers(turns, name):
    text = {r.conv_id: r.text for r in H.render_chat(turns, name).collect()}
    assert set(text) == {1, 2}  # the third breaks the order of roles
    cut = [text[r.conv_id][r.start:r.end].strip() for r in H.supervised_spans(turns, name).orderBy("conv_id", "i").collect()]
    assert cut == ["yes", "no\nmore", "a"]
    assert "be brief" in text[1] and "bye" not in text[1] and "early" not in text[2]


def test_rendered_formats(turns):
    two = {r.conv_id: r.text for r in H.render_chat(turns, "two").collect()}[1]
    assert two == "be brief\nHuman: hi <table>\nAssistant: yes</s>Human: and?\nAssistant: no\nmore</s>"
    old = {r.conv_id: r.text for r in H.render_chat(turns, "llama_2").collect()}[1]
    assert old == "[INST] <<SYS>>\nbe brief\n<</SYS>>\n\nhi <table> [/INST] yes </s><s>[INST] and? [/INST] no\nmore </s>"
    new = {r.conv_id: r.text for r in H.render_chat(turns, "llama_3").collect()}[2]
    assert new.endswith("<|start_header_id|>user<|end_header_id|>q<|eot_id|><|start_header_id|>assistant<|end_header_id|>a<|eot_id|>")
    with pytest.raises(ValueError):
        H.render_chat(turns, "plain")


def test_training_text_spans_survive_the_table(spark, turns, tables):
    texts, spans = H.build_training_text(turns.withColumn("table_id", F.lit("t1.csv")), tables, COLUMNS)
    text = {r.conv_id: r.text for r in texts.collect()}
    assert "<tb_start>Row 1 - column 1: " in text[1] and ".<tb_end>" in text[1] and "<table>" not in text[1]
    assert [text[r.conv_id][r.start:r.end] for r in spans.orderBy("conv_id", "i").collect()] == ["yes", "no\nmore", "a"]


@pytest.mark.parametrize("rows", [1, 2, 3, 100])
def test_blocks_of_table_text_are_the_text(spark, tables, rows):
    whole = {r.table_id: r.table_text for r in H.table_text(tables, COLUMNS).collect()}
    blocks = H.table_text_blocks(tables, COLUMNS, rows=rows, find="column 2").orderBy("table_id", "block").collect()
    joined, found = {}, {}
    for b in blocks:
        assert b.start == len(joined.get(b.table_id, "")) and b.n_chars == len(b.text)
        joined[b.table_id] = joined.get(b.table_id, "") + b.text
        if b.found_at is not None:
            found.setdefault(b.table_id, b.found_at)
    assert joined == whole and found == {t: x.index("column 2") for t, x in whole.items()}
    sizes = {r.table_id: (r.n_chars, r.found_at) for r in H.text_sizes(H.table_text_blocks(tables, COLUMNS, rows=rows, find="column 2")).collect()}
    assert sizes == {t: (len(x), x.index("column 2")) for t, x in whole.items()}
    assert H.table_text_blocks(tables.where("false"), COLUMNS).count() == 0


@pytest.mark.parametrize("name", ["llama_3"])
def test_spans_from_lengths_equal_spans_of_filled_text(spark, name):
    """Marks in every role, marks twice, separators before, in and after a table, tables that do not exist."""
    s = H.STYLES[name]
    cells = ["a", f"b{s.sep}c", None]
    tables = spark.createDataFrame([("t", i, x) for i, x in enumerate(cells)] + [("u", 0, "x")], "table_id string, row_id long, v string")
    said = ["<table> ok", f"a<table>b{s.sep}c", f"{s.sep}<table>", "<table><table>", "", "plain", None, f"<table>{s.sep}"]
    rows = []
    for c, (table, system) in enumerate([("t", None), ("u", "see <table>"), ("none", None), (None, "x")]):
        if system:
            rows.append((c, -1, "system", system, table))
        rows += [(c, i, "user" if i % 2 == 0 else "assistant", said[(i * 3 + c) % 8], table) for i in range(16)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, table_id string").where("text IS NOT NULL OR role = 'user'")
    turns = turns.withColumn("text", F.coalesce("text", F.lit("")))
    texts, spans = H.build_training_text(turns, tables, ["v"], name)
    pieces = H.prepare(H.inject_table(turns, H.table_text(tables, ["v"])), s)
    want = {(r.conv_id, r.text) for r in H.join_pieces(pieces, ["table_id"]).collect()}
    assert {(r.conv_id, r.text) for r in texts.collect()} == want and want
    order = ["conv_id", "i"]
    assert spans.orderBy(*order).collect() == H.spans_of(pieces, s).orderBy(*order).collect()


def test_mask_labels_edges(spark):
    rows = [(1, [7, 1, 2, 5, 6, 9, 3, 1, 2, 8, 9]), (2, [1]), (3, []), (4, [1, 2, 4])]
    df = spark.createDataFrame(rows, "k int, ids array<int>")
    got = {r.k: r.labels for r in H.mask_labels(df, "ids", [1, 2], 9).collect()}
    n = H.IGNORE
    assert got == {1: [n, n, n, 5, 6, n, n, n, n, 8, n], 2: [n], 3: [], 4: [n, n, 4]}
    out = {r.k: r for r in H.collate(H.mask_labels(df, "ids", [1, 2], 9).withColumnRenamed("ids", "input_ids"), ["k"], 2, 0, 4).collect()}
    assert out[2].input_ids == [1, 0, 0, 0] and out[2].attention_mask == [True, False, False, False]
    assert out[1].labels == [n, n, n, 5] and out[3].input_ids == [0, 0, 0]


def test_synthetic_data(spark):
    n = 3000
    numbered = number_rows(spark.range(n), ["id"], out="number").drop("id")
    ids = D.unique_ids(numbered, "number", n, 3)
    assert ids.select("id").distinct().count() == n
    assert ids.where("id < 10000 or id > 99998").count() == 0
    assert D.id_space(89_999) == (10_000, 89_999) and D.id_space(90_000)[0] == 100_000
    lengths = {r[0] for r in D.manifest(ids.select("id"), 3).select(F.size("conversations")).distinct().collect()}
    assert lengths == {2, 4, 6, 8}
    parts = {r.part: r["count"] for r in D.split_exact(ids, 0.7, 3, "id").groupBy("part").count().collect()}
    assert parts == {"train": 2100, "eval": 900}


def test_rows_of_a_table_text_move_once(spark, monkeypatch):
    """Nothing is written on the way, and rows with and without neighbours in their block give one text."""
    monkeypatch.setattr(H, "store", lambda df, label: pytest.fail(f"{label} was stored"))
    ids = [0, 5, 4095, 4096, 9000, 20000]
    tables = spark.createDataFrame([(t, i, float(i) if i else None) for t in ("t", "u") for i in ids] + [(None, 1, 1.0)], "table_id string, row_id long, v double")
    out = H.table_text(tables, ["v"])
    want = ". ".join(f"Row {k} - column 1: {float(i) if i else 'nan'}" for k, i in enumerate(ids, 1)) + "."
    assert {(r.table_id, r.table_text) for r in out.collect()} == {("t", want), ("u", want)}
