"""Sources, corpus profiling, label choice and preprocessing."""

from __future__ import annotations

import os
import uuid
from urllib.parse import unquote, urlsplit

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from cellwright.functions.numbers import round_exact_sql
from cellwright.operators import metadata as M, preprocess as P
from cellwright.operators.cells import to_cells
from cellwright.operators.positions import number_rows
from cellwright.sources import files as IO
from cellwright.session import scratch_folder, store

from .base import CORPUS_LI, query

SEED = 7


def draw_sql(*keys: str, seed: int = SEED) -> str:
    """The seeded uniform draw in SQL; ``keys`` are SQL expressions."""
    parts = ", ".join([f"'{seed}'", *[f"({k})::VARCHAR" for k in keys]])
    return f"(('0x' || substr(md5(concat_ws('|', {parts})), 1, 8))::BIGINT / 4294967296.0::DOUBLE)"


# ------------------------------------------------------------------ a corpus of different tables
MIXED = {
    "region": [("r_regionkey", "int"), ("r_name", "string")],
    "nation": [("n_nationkey", "int"), ("n_name", "string"), ("n_regionkey", "int")],
    "customer": [("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"), ("c_acctbal", "double"), ("c_mktsegment", "string")],
    "supplier": [("s_suppkey", "bigint"), ("s_name", "string"), ("s_nationkey", "int"), ("s_acctbal", "double")],
    "part": [("p_partkey", "bigint"), ("p_name", "string"), ("p_brand", "string"), ("p_type", "string"), ("p_size", "int"), ("p_retailprice", "double")],
    "orders": [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"), ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string")],
    "lineitem": [("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"), ("l_linenumber", "int"), ("l_quantity", "double"),
                 ("l_extendedprice", "double"), ("l_discount", "double"), ("l_tax", "double"), ("l_returnflag", "string"), ("l_linestatus", "string"),
                 ("l_shipdate", "timestamp_ntz")],
    "events": [("event_id", "bigint"), ("ts", "timestamp_ntz"), ("user_id", "bigint"), ("event_type", "string"), ("value", "double"), ("props", "string")],
    "documents": [("doc_id", "bigint"), ("text", "string"), ("lang", "string"), ("source", "string"), ("n_chars", "bigint")],
    "embeddings": [("vec_id", "bigint"), ("embedding", "array<float>"), ("label", "int")],
    "pages": [("page_id", "bigint"), ("url", "string"), ("html", "string")],
    "benchmark": [("item_id", "bigint"), ("text", "string")],
    "labels": [("doc_id", "bigint"), ("quality", "int"), ("toxic", "int")],
    "conversations": [("conv_id", "bigint"), ("turn", "bigint"), ("role", "string"), ("text", "string")],
}


def _cells_sql(table_id, source, columns, row="row_number() OVER () - 1", order=None):
    parts = []
    for i, (c, ty) in enumerate(columns):
        if ty.startswith("array"):  # reported by the reader, no cells
            continue
        number = ty in ("int", "bigint", "double")
        num = f"{c}::DOUBLE" if number else "NULL::DOUBLE"
        text = "NULL::VARCHAR" if number else f"{c}::VARCHAR"
        parts.append(
            f"SELECT '{table_id}' AS table_id, {row} AS row_id, {i} AS col_id, '{c}' AS col_name, "
            f"'{ty}' AS col_type, {num} AS v_num, {text} AS v_str, NULL::VARCHAR AS v_exact FROM {source}"
        )
    return " UNION ALL ".join(parts)


MIXED_CELLS = "mixed AS (" + " UNION ALL ".join(
    _cells_sql(f"{t}.parquet", t, cols, "row_number() OVER () - 1") for t, cols in MIXED.items()
) + ")"
#: the suppliers as a zero-padded synthetic table
PADDED = [("s_suppkey", "bigint"), ("s_nationkey", "int"), ("s_acctbal", "double"), ("z0", "int"), ("z1", "int"), ("s_label", "int")]
PADDED_SQL = ("padded AS (SELECT s_suppkey, s_nationkey, s_acctbal, 0 AS z0, 0 AS z1, (s_suppkey % 4)::INT AS s_label FROM supplier)")
CORPUS_CELLS = MIXED_CELLS + ", " + PADDED_SQL + ", corpus AS (SELECT * FROM mixed UNION ALL " + _cells_sql(
    "Causal_Table2.csv", "padded", PADDED) + ")"
TEXT_SQL = ("coalesce(v_str, CASE WHEN col_type IN ('int', 'bigint') THEN v_num::BIGINT::VARCHAR ELSE v_num::VARCHAR END)")
PROFILE = CORPUS_CELLS + f""", profile AS (SELECT table_id, col_id, col_name, col_type, count(*) AS n_rows,
  count(DISTINCT {TEXT_SQL}) AS n_distinct, max(length({TEXT_SQL})) AS max_len,
  bool_or(coalesce(v_num <> 0, length(v_str) > 0, false)) AS active,
  CASE WHEN col_type IN ('int', 'bigint', 'double') THEN 0 ELSE 1 END AS categorical
  FROM corpus GROUP BY 1, 2, 3, 4)"""
CANDIDATES = PROFILE + """, cand AS (SELECT *, CASE WHEN n_distinct < 0.1 * n_rows THEN 'categorical' ELSE 'continuous' END AS kind
  FROM profile WHERE col_name NOT LIKE 'Unnamed:%' AND n_distinct <> n_rows AND col_type <> 'timestamp_ntz' AND max_len <= 256)"""
LABELS = CANDIDATES + f""", drawn AS (SELECT *, row_number() OVER (PARTITION BY table_id, kind ORDER BY
    {draw_sql('table_id', 'col_id', "'label'")}, col_id) AS k FROM cand WHERE table_id NOT LIKE '%.csv'),
  picks AS (SELECT t.table_id, a.col_id AS cat, b.col_id AS con, a.n_distinct AS cat_n,
    a.col_id IS NOT NULL AND (b.col_id IS NULL OR {draw_sql('t.table_id', "'kind'")} < 0.9) AS use_cat
    FROM (SELECT DISTINCT table_id FROM corpus WHERE table_id NOT LIKE '%.csv') t
    LEFT JOIN (SELECT * FROM drawn WHERE kind = 'categorical' AND k = 1) a ON a.table_id = t.table_id
    LEFT JOIN (SELECT * FROM drawn WHERE kind = 'continuous' AND k = 1) b ON b.table_id = t.table_id),
  labels_real AS (SELECT table_id, coalesce(CASE WHEN use_cat THEN cat ELSE con END, -1) AS label_index,
    CASE WHEN use_cat THEN cat_n ELSE 0 END::BIGINT AS num_classes FROM picks)"""
STATS = LABELS + """, label_stats AS (SELECT *, num_classes <> 0 AS is_classification FROM labels_real
  UNION ALL SELECT table_id, max(col_id), arg_max(n_distinct, col_id), true FROM profile WHERE table_id LIKE '%.csv' GROUP BY 1)"""


def mixed_cells(t):
    return IO.read_corpus(t.spark, t.dir)[0]


def corpus_cells(t):
    s = t.table("supplier")
    padded = s.select(
        "s_suppkey", "s_nationkey", "s_acctbal", F.lit(0).alias("z0"), F.lit(0).alias("z1"),
        (F.col("s_suppkey") % 4).cast("int").alias("s_label"),
    )
    made = to_cells(padded, F.lit("Causal_Table2.csv"), F.col("s_suppkey"), [c for c, _ in PADDED])
    return mixed_cells(t).unionByName(made)


def profile(t):
    return t.once("profile", lambda: store(M.column_profile(corpus_cells(t)), "profile"))


# ------------------------------------------------------------------ sources and sinks
@query("scan_parquet", "SELECT *, o_orderkey AS row_id FROM orders")
def scan_parquet(t):
    return IO.read_table(t.spark, f"{t.dir}/orders.parquet", row_id=True)


@query("scan_many_files", "SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_orderkey) - 1 AS row_id FROM orders")
def scan_many_files(t):
    """The same table in several files, in order."""
    path = _fresh(t, "parts")
    t.table("orders").select("o_orderkey", "o_totalprice").repartitionByRange(7, "o_orderkey").sortWithinPartitions("o_orderkey").write.parquet(path)
    return IO.read_table(t.spark, path, row_id=True)


@query("corpus_column_rejects", "SELECT 'embeddings.parquet' AS table_id, 'column embedding: no cells for array<float>' AS problem FROM (SELECT 1 FROM embeddings LIMIT 1)")
def corpus_column_rejects(t):
    return IO.read_corpus(t.spark, t.dir)[1]


BIG = """big AS (SELECT c_custkey, 1152921504606846976 + c_custkey % 97 AS near, (9007199254740993 + c_custkey)::DECIMAL(20,0) AS wide FROM customer)"""


@query("exact_distinct", f"""WITH {BIG} SELECT 0 AS col_id, count(DISTINCT near) AS n_distinct, max(length(near::VARCHAR))::INT AS max_len FROM big
UNION ALL SELECT 1, count(DISTINCT wide), max(length(wide::VARCHAR))::INT FROM big""")
def exact_distinct(t):
    """Distinct counts of whole numbers that a double does not tell apart."""
    k = F.col("c_custkey")
    big = t.table("customer").select(
        k, (F.lit(1 << 60) + k % 97).alias("near"), (F.lit(9007199254740993) + k).cast("decimal(20,0)").alias("wide"))
    out = M.column_profile(to_cells(big, F.lit("big"), "c_custkey", ["near", "wide"]))
    return out.select("col_id", "n_distinct", "max_len")


@query("corpus_cells", f"WITH {MIXED_CELLS} SELECT * FROM mixed")
def corpus_cells_q(t):
    return mixed_cells(t)


def _fresh(t, label):
    return f"{scratch_folder(t.spark)}/{label}-{uuid.uuid4().hex}"


@query("scan_csv_roundtrip", "SELECT * FROM part")
def scan_csv_roundtrip(t):
    part, path = t.table("part"), _fresh(t, "csv")
    IO.write_csv(part, path)
    return IO.read_csv(t.spark, path, header=True, schema=part.schema)


@query("sink_roundtrip", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority AS table_id, format FROM orders, (VALUES ('parquet'), ('csv')) f(format)")
def sink_roundtrip(t):
    o = t.table("orders").select("o_orderkey", "o_custkey", "o_totalprice", F.col("o_orderpriority").alias("table_id"))
    out = []
    for fmt in ("parquet", "csv"):
        path = _fresh(t, fmt)
        IO.write_tables(o, path, fmt)
        out.append(IO.read_tables(t.spark, path, o.schema, fmt).withColumn("format", F.lit(fmt)))
    return out[0].unionByName(out[1])


@query("json_roundtrip", "SELECT c_custkey::VARCHAR AS id, c_mktsegment AS table_name, c_name AS turn0, c_nationkey::VARCHAR AS turn1 FROM customer")
def json_roundtrip(t):
    turn = lambda who, what: F.struct(F.lit(who).alias("from"), what.cast("string").alias("value"))
    records = t.table("customer").select(
        F.col("c_custkey").cast("string").alias("id"), F.col("c_mktsegment").alias("table"),
        F.array(turn("human", F.col("c_name")), turn("gpt", F.col("c_nationkey"))).alias("conversations"),
    )
    path = _fresh(t, "json")
    IO.write_records(records, path)
    back = IO.read_records(t.spark, path, IO.PROMPT_SCHEMA)
    return back.select("id", F.col("table").alias("table_name"), F.col("conversations")[0]["value"].alias("turn0"),
                       F.col("conversations")[1]["value"].alias("turn1"))


@query("json_records", "SELECT n_regionkey, count(*) AS n_records, count_if(n_nationkey % 2 = 0)::BIGINT AS n_causal FROM nation GROUP BY 1")
def json_records(t):
    """A JSON array file of causal records, one record per nation."""
    n = t.table("nation")
    rec = F.struct(
        F.col("n_regionkey").cast("string").alias("source_feature"), F.col("n_name").alias("sink_feature"),
        (F.col("n_nationkey") % 2 == 0).alias("is_causal"),
    )
    path = _fresh(t, "causal")
    n.select(F.to_json(F.array(F.struct(F.array(rec).alias("causal_info")))).alias("value")).write.text(path)
    back = IO.read_records(t.spark, path, IO.CAUSAL_SCHEMA, array_file=False)
    one = back.select(F.explode("causal_info").alias("c")).select("c.*")
    return one.groupBy(F.col("source_feature").cast("int").alias("n_regionkey")).agg(
        F.count(F.lit(1)).alias("n_records"), F.count_if("is_causal").alias("n_causal"))


LINES = """lines AS (SELECT 'supplier_' || l_suppkey || '.csv' AS table_id,
  row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity,
    l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) - 1 AS row_id,
  l_suppkey % 10 = 3 AS bad, l_linenumber::DOUBLE AS c0, CASE WHEN l_orderkey % 5 <> 0 THEN l_quantity END AS c1, l_tax AS c2 FROM lineitem)"""


def corpus_lines(t):
    """CSV lines per supplier; in one table of ten some lines have a field too many."""
    def build():
        li = t.table("lineitem")
        quantity = F.when(F.col("l_orderkey") % 5 != 0, F.col("l_quantity").cast("string")).otherwise(F.lit("n/a"))
        line = F.concat(F.col("l_linenumber"), F.lit(","), quantity, F.lit(","), F.col("l_tax").cast("string"))
        numbered = number_rows(li, li.columns, ["l_suppkey"], keep=["l_suppkey", line.alias("line")])
        extra = F.when((F.col("l_suppkey") % 10 == 3) & (F.col("row_id") % 4 == 1), F.lit(",1")).otherwise(F.lit(""))
        return numbered.select(
            F.concat(F.lit("supplier_"), F.col("l_suppkey"), F.lit(".csv")).alias("table_id"), "row_id", F.concat("line", extra).alias("line"),
        )

    return t.once("corpus_lines", build)


def csv_folder(t):
    """The lines as CSV tables on disk, one more with quoted text, and a damaged Parquet table."""
    def build():
        k, balance = F.col("c_custkey"), F.col("c_acctbal").cast("string")
        said = F.concat(F.lit('"'), F.col("c_name"), F.lit(', ""the"" one",'), F.when(k % 4 != 0, balance).otherwise(F.lit("NA")), F.lit(", x "))
        quoted = t.table("customer").select(F.lit("quoted.csv").alias("table_id"), k.alias("row_id"), said.alias("line"))
        damaged = t.table("region").select(F.lit("damaged.parquet").alias("table_id"), F.col("r_regionkey").cast("bigint").alias("row_id"), F.lit("no table").alias("line"))
        path = _fresh(t, "lines")
        rows = corpus_lines(t).unionByName(quoted).unionByName(damaged)
        _write_lines(rows.repartition("table_id").sortWithinPartitions("table_id", "row_id").select("table_id", "line"), path)
        return path

    return t.once("csv_folder", build)


def _write_lines(rows, path):
    """One folder of text per table. ``rows`` has the lines of a table together and in order.

    Hadoop's local file system starts processes for the permissions of each new file, some milliseconds a
    table; files in a local folder are written by the tasks themselves.
    """
    where = urlsplit(path)
    if where.scheme not in ("", "file"):
        rows.write.partitionBy("table_id").text(path)
        return
    folder = unquote(where.path) if where.scheme else path
    os.makedirs(folder)

    def written(batches):
        at, out, made = None, None, []
        for batch in batches:
            # rows of one table that follow each other are one text; a missing line is an empty one, as Spark writes it
            runs = pc.run_end_encode(batch.column(0))
            ends = runs.run_ends.to_numpy()
            lines = pc.fill_null(batch.column(1), "").cast(pa.string())
            texts = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, *ends], pa.int32()), lines), "\n")
            for name, text in zip(runs.values.to_pylist(), texts.to_pylist()):
                if name != at:
                    if out:
                        out.close()
                    place = f"{folder}/table_id={name}"
                    os.makedirs(place, exist_ok=True)
                    made.append((f"{place}/.{uuid.uuid4().hex}", f"{place}/part-00000.txt"))
                    at, out = name, open(made[-1][0], "w", encoding="utf-8", newline="")
                out.write(f"{text}\n")
        if out:
            out.close()
        # a task that is run again, or twice, leaves one file
        for begun, place in made:
            os.replace(begun, place)
        yield pa.RecordBatch.from_pydict({"n": [len(made)]})

    rows.mapInArrow(written, "n bigint").agg(F.sum("n")).collect()


CSV_CELLS = LINES + """, quoted AS (SELECT 'quoted.csv' AS table_id, row_number() OVER (ORDER BY c_custkey) - 1 AS row_id,
  c_name || ', "the" one' AS a, CASE WHEN c_custkey % 4 <> 0 THEN c_acctbal END AS b FROM customer)"""


@query("corpus_csv_cells", f"""WITH {CSV_CELLS} SELECT table_id, row_id, 0 AS col_id, c0 AS v_num, NULL AS v_str FROM lines WHERE NOT bad
UNION ALL SELECT table_id, row_id, 1, c1, NULL FROM lines WHERE NOT bad UNION ALL SELECT table_id, row_id, 2, c2, NULL FROM lines WHERE NOT bad
UNION ALL SELECT table_id, row_id, 0, NULL, a FROM quoted UNION ALL SELECT table_id, row_id, 1, b, NULL FROM quoted
UNION ALL SELECT table_id, row_id, 2, NULL, 'x' FROM quoted""")
def corpus_csv_cells(t):
    return IO.read_corpus(t.spark, csv_folder(t))[0].select("table_id", "row_id", "col_id", "v_num", "v_str")


@query("corpus_rejects", f"""WITH {LINES} SELECT DISTINCT table_id, 'line longer than the first' AS problem FROM lines WHERE bad
UNION ALL SELECT DISTINCT 'damaged.parquet', 'unreadable footer' FROM region""")
def corpus_rejects(t):
    return IO.read_corpus(t.spark, csv_folder(t))[1]


@query("missing_tables", f"""WITH {CORPUS_LI}, meta AS (SELECT 'supplier_' || c_custkey || '.parquet' AS table_id FROM customer)
SELECT table_id FROM meta WHERE table_id NOT IN (SELECT table_id FROM corpus_li)""")
def missing_tables(t):
    meta = t.table("customer").select(F.concat(F.lit("supplier_"), F.col("c_custkey"), F.lit(".parquet")).alias("table_id"))
    return IO.missing_tables(meta, t.corpus_li())


@query("labelled_tables", f"WITH {STATS} SELECT * FROM label_stats WHERE label_index <> -1")
def labelled_tables(t):
    return IO.labelled_tables(M.label_stats(profile(t), SEED))


@query("sample_table_join", f"""WITH {CORPUS_LI}, s AS (SELECT o_orderkey AS id, 'supplier_' || (o_custkey % 150) || '.parquet' AS table_id FROM orders),
d AS (SELECT table_id, count(*) AS num_rows FROM corpus_li GROUP BY 1) SELECT id, s.table_id, num_rows FROM s JOIN d USING (table_id)""")
def sample_table_join(t):
    samples = t.table("orders").select(
        F.col("o_orderkey").alias("id"), F.concat(F.lit("supplier_"), F.col("o_custkey") % 150, F.lit(".parquet")).alias("table_id"))
    tables = t.corpus_li().groupBy("table_id").agg(F.count(F.lit(1)).alias("num_rows"))
    return IO.attach_tables(samples, tables)


# ------------------------------------------------------------------ profiling
@query("table_dims", f"WITH {PROFILE} SELECT table_id, max(n_rows) AS num_rows, count(*) AS num_cols FROM profile GROUP BY 1")
def table_dims(t):
    return M.table_dims(profile(t)).drop("active_cols")


@query("active_cols", f"WITH {PROFILE} SELECT table_id, count_if(active)::BIGINT AS active_cols FROM profile GROUP BY 1")
def active_cols(t):
    return M.table_dims(profile(t)).select("table_id", "active_cols")


@query("categorical_flags", "SELECT num_rows, col_id, col_name, categorical FROM (SELECT count(*) AS num_rows FROM orders), (VALUES "
       "(0, 'o_orderkey', 0), (1, 'o_custkey', 0), (2, 'o_orderstatus', 1), (3, 'o_totalprice', 0), (4, 'o_orderdate', 1), "
       "(5, 'o_orderpriority', 1), (6, 'is_open', 1)) v(col_id, col_name, categorical)")
def categorical_flags(t):
    o = t.table("orders").withColumn("is_open", F.col("o_orderstatus") == "O")
    return P.categorical_flags_df(o, o.columns)


@query("col_nunique", f"WITH {PROFILE} SELECT table_id, col_id, col_name, n_distinct FROM profile")
def col_nunique(t):
    return profile(t).select("table_id", "col_id", "col_name", "n_distinct")


@query("col_max_len", f"WITH {PROFILE} SELECT table_id, col_id, col_name, max_len::INT AS max_len FROM profile")
def col_max_len(t):
    return profile(t).select("table_id", "col_id", "col_name", "max_len")


@query("label_candidates", f"WITH {CANDIDATES} SELECT table_id, col_id, col_name FROM cand")
def label_candidates(t):
    return M.label_candidates(profile(t)).select("table_id", "col_id", "col_name")


@query("candidate_kind", f"WITH {CANDIDATES} SELECT table_id, col_id, n_distinct, n_rows, kind FROM cand")
def candidate_kind(t):
    return M.label_candidates(profile(t)).select("table_id", "col_id", "n_distinct", "n_rows", "kind")


@query("pick_label", f"WITH {LABELS} SELECT table_id, label_index, num_classes FROM labels_real")
def pick_label(t):
    p = profile(t).where(~F.col("table_id").endswith(".csv"))
    return M.pick_label(M.label_candidates(p), M.table_dims(p), SEED)


@query("label_stats", f"WITH {STATS} SELECT table_id, label_index, num_classes, is_classification FROM label_stats")
def label_stats(t):
    return M.label_stats(profile(t), SEED)


@query("table_number", """SELECT c_custkey, TRY_CAST(nullif(regexp_extract(c_name, '\\d+'), '') AS BIGINT) AS number,
  NULL::BIGINT AS none FROM customer""")
def table_number(t):
    return t.table("customer").select("c_custkey", M.table_number(F.col("c_name")).alias("number"),
                                      M.table_number(F.lit("no digits.csv")).alias("none"))


CAUSAL = """causal AS (SELECT n_nationkey + 1 AS number, CASE WHEN n_nationkey % 3 = 2 THEN [] ELSE
  [{'source_feature': n_name, 'sink_feature': 'a', 'is_causal': n_nationkey % 2 = 0},
   {'source_feature': n_name, 'sink_feature': 'b', 'is_causal': n_nationkey % 4 = 0},
   {'source_feature': n_name, 'sink_feature': 'c', 'is_causal': n_nationkey % 4 = 0}] END AS info FROM nation)"""


def causal_records(t):
    """The causal list: one record per nation, some empty, some without a positive entry."""
    k = F.col("n_nationkey")
    entry = lambda sink, yes: F.struct(F.col("n_name").alias("source_feature"), F.lit(sink).alias("sink_feature"), yes.alias("is_causal"))
    full = F.array(entry("a", k % 2 == 0), entry("b", k % 4 == 0), entry("c", k % 4 == 0))
    return t.table("nation").select(k, F.when(k % 3 == 2, F.slice(full, 1, 0)).otherwise(full).alias("causal_info"))


@query("attach_causal", f"""WITH {CAUSAL}, s AS (SELECT CASE WHEN s_suppkey % 2 = 0 THEN 'Causal_Table' || (s_suppkey % 30 + 1) || '.csv'
  ELSE 'supplier_' || s_suppkey || '.parquet' END AS table_id, s_suppkey FROM supplier)
SELECT s_suppkey, table_id, table_id LIKE 'Causal_Table%' AS has_causal, len(info)::INT AS n_entries FROM s
LEFT JOIN causal ON table_id LIKE 'Causal_Table%' AND number = regexp_extract(table_id, '\\d+')::BIGINT""")
def attach_causal(t):
    k = F.col("s_suppkey")
    tables = t.table("supplier").select(
        k, F.when(k % 2 == 0, F.concat(F.lit("Causal_Table"), k % 30 + 1, F.lit(".csv")))
        .otherwise(F.concat(F.lit("supplier_"), k, F.lit(".parquet"))).alias("table_id"))
    out = M.attach_causal(tables, M.causal_list(causal_records(t), "n_nationkey"))
    return out.select("s_suppkey", "table_id", "has_causal", F.array_size("causal_info").alias("n_entries"))


@query("build_metadata", f"""WITH {STATS}, {CAUSAL}, d AS (SELECT table_id, max(n_rows) AS num_rows, count(*) AS n,
  count_if(active) AS a, string_agg(categorical::VARCHAR, ',' ORDER BY col_id) AS flags FROM profile GROUP BY 1)
SELECT d.table_id, d.table_id LIKE '%.csv' AS is_synthetic_data, num_rows,
  CASE WHEN d.table_id LIKE '%.csv' THEN a ELSE n END::INT AS num_cols,
  CASE WHEN d.table_id LIKE '%.csv' THEN rtrim(repeat('0,', a::BIGINT), ',') ELSE flags END AS categorical_columns,
  label_index, num_classes, is_classification, d.table_id LIKE 'Causal_Table%' AS has_causal, len(info)::INT AS n_causal
FROM d JOIN label_stats USING (table_id) LEFT JOIN causal ON d.table_id LIKE 'Causal_Table%'
  AND number = TRY_CAST(nullif(regexp_extract(d.table_id, '\\d+'), '') AS BIGINT)""")
def build_metadata(t):
    meta = M.build_metadata(corpus_cells(t), SEED, M.causal_list(causal_records(t), "n_nationkey"))
    return meta.withColumn("categorical_columns", F.array_join(F.transform("categorical_columns", lambda x: x.cast("string")), ",")).withColumn(
        "n_causal", F.array_size("causal_info")).drop("causal_info")


# ------------------------------------------------------------------ preprocessing
@query("target_last", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority, o_orderstatus, 5 AS label_index FROM orders")
def target_last(t):
    out = P.move_target_last(t.table("orders"), "o_orderstatus")
    return out.withColumn("label_index", F.lit(len(out.columns) - 1))


@query("pad_columns", "SELECT *, 0 AS padded_4, 0 AS padded_5, 0 AS padded_6 FROM supplier")
def pad_columns(t):
    return P.pad_columns(t.table("supplier"), 4, 7)


_LI_FEATURES = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_KEPT = P.drop_columns(_LI_FEATURES, 4, SEED)


@query("drop_columns", f"""WITH names AS (SELECT name FROM (VALUES {', '.join(f"('{c}')" for c in _LI_FEATURES)}) v(name)
  ORDER BY md5(concat_ws('|', '{SEED}', name, 'column')) LIMIT 4)
SELECT l_returnflag, """ + ", ".join(f"CASE WHEN '{c}' IN (SELECT name FROM names) THEN {c} END AS {c}" for c in _KEPT) + " FROM lineitem")
def drop_columns(t):
    return t.table("lineitem").select(*P.drop_columns(_LI_FEATURES, 4, SEED), "l_returnflag")


@query("trim_padding", f"WITH {PADDED_SQL} SELECT s_suppkey, s_nationkey, s_acctbal FROM padded")
def trim_padding(t):
    s = t.table("supplier").select("s_suppkey", "s_nationkey", "s_acctbal", F.lit(0).alias("z0"), F.lit(0).alias("z1"))
    return s.select(*P.trim_padding(s.columns, 4))


@query("label_encode", f"""WITH n AS (SELECT o_orderkey, CASE WHEN o_orderkey % 11 <> 0 THEN o_orderpriority END AS p, o_orderstatus AS s FROM orders)
SELECT o_orderkey, CASE WHEN p IS NULL THEN (SELECT count(DISTINCT p) FROM n) ELSE
  dense_rank() OVER (ORDER BY p NULLS LAST) - 1 END::INT AS p, (dense_rank() OVER (ORDER BY s) - 1)::INT AS s FROM n""")
def label_encode(t):
    o = t.table("orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 11 != 0, F.col("o_orderpriority")).alias("p"), F.col("o_orderstatus").alias("s"))
    return P.label_encode(o, ["p", "s"])


@query("bool_to_int", "SELECT o_orderkey, (o_orderstatus = 'O')::INT AS is_open FROM orders")
def bool_to_int(t):
    return P.bool_to_int(t.table("orders").select("o_orderkey", (F.col("o_orderstatus") == "O").alias("is_open")))


MASKED = f"""masked AS (SELECT *, row_number() OVER (PARTITION BY table_id ORDER BY {draw_sql('table_id', 'row_id', "'mask'")}, row_id)
  <= floor(count(*) OVER (PARTITION BY table_id) * 0.15 + 1e-9) AS hit FROM corpus_li)"""


@query("mask_target", f"""WITH {CORPUS_LI}, {MASKED} SELECT table_id, row_id, CASE WHEN hit THEN 'missing' ELSE l_returnflag END AS l_returnflag,
  CASE WHEN hit THEN l_returnflag END AS original FROM masked""")
def mask_target(t):
    li = t.corpus_li().select("table_id", "row_id", "l_returnflag")
    return P.mask_target(li, "l_returnflag", 0.15, "missing", SEED, ["table_id"])


@query("masked_info", f"WITH {CORPUS_LI}, {MASKED} SELECT table_id, row_id, l_returnflag AS original FROM masked WHERE hit")
def masked_info(t):
    return P.masked_info(mask_target(t), ["table_id"])


@query("masked_balances", f"""WITH b AS (SELECT c_custkey AS row_id, abs(c_acctbal) * 100000 AS v FROM customer), m AS (SELECT *,
  row_number() OVER (ORDER BY {draw_sql('row_id', "'mask'")}, row_id) <= floor(count(*) OVER () * 0.15 + 1e-9) AS hit FROM b)
SELECT row_id, v::VARCHAR AS original FROM m WHERE hit""")
def masked_balances(t):
    """Masked numbers beyond 1e7 are kept as plain digits."""
    b = t.table("customer").select(F.col("c_custkey").alias("row_id"), (F.abs("c_acctbal") * 100000).alias("v"))
    return P.masked_info(P.mask_target(b, "v", 0.15, "missing", SEED))


@query("round_floats", f"""SELECT c_custkey, {round_exact_sql('c_acctbal', 2)} AS c_acctbal,
  {round_exact_sql('c_acctbal / 8', 2)} AS eighth FROM customer""")
def round_floats(t):
    c = t.table("customer").select("c_custkey", "c_acctbal", (F.col("c_acctbal") / 8).alias("eighth"))
    return P.round_floats(c, 2)


@query("row_budget", f"WITH {PROFILE} SELECT table_id, count(*) AS num_cols, ceil(25000.0 / count(*))::BIGINT AS budget FROM profile GROUP BY 1")
def row_budget(t):
    return M.table_dims(profile(t)).select("table_id", "num_cols", P.row_budget(F.col("num_cols")).alias("budget"))


@query("downsample", f"""WITH {CORPUS_LI}, r AS (SELECT *, row_number() OVER (PARTITION BY table_id ORDER BY
  {draw_sql('table_id', 'row_id', "'rows'")}, row_id) AS k FROM corpus_li) SELECT * EXCLUDE (k) FROM r WHERE k <= 120""")
def downsample(t):
    return P.downsample(t.corpus_li(), 120, SEED, ["table_id"])


OPTS = P.Options(seed=SEED, keep_all_rows=False)
ENCODED = P.Options(encoded=True, max_cols=9, seed=SEED, keep_all_rows=False)
_BUDGET = P.row_budget(7)
Q2, P2, D2, X2 = (round_exact_sql(c, 2) for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax"))
PROCESSED = CORPUS_LI + ", " + MASKED + f""", processed AS (SELECT replace(table_id, '.parquet', '.csv') AS table_id, row_id, l_linenumber,
  {Q2} AS l_quantity, {P2} AS l_extendedprice, {D2} AS l_discount,
  {X2} AS l_tax, l_linestatus, CASE WHEN hit THEN 'missing' ELSE l_returnflag END AS l_returnflag,
  CASE WHEN hit THEN l_returnflag END AS original FROM masked
  QUALIFY row_number() OVER (PARTITION BY table_id ORDER BY {draw_sql('table_id', 'row_id', "'rows'")}, row_id) <= {_BUDGET})"""


def processed(t):
    return t.once("processed", lambda: store(P.preprocess(t.corpus_li(), "l_returnflag", OPTS), "processed"))


@query("updated_metadata", f"""WITH {PROCESSED} SELECT table_id, count(*) AS num_rows, 7 AS num_cols, 6 AS label_index,
  '0,0,0,0,0,1,1' AS categorical_columns, count(original) > 0 AS target_masked, count(original) AS n_masked FROM processed GROUP BY 1""")
def updated_metadata(t):
    out = P.updated_metadata(processed(t), "l_returnflag")
    return out.withColumn("categorical_columns", F.array_join(F.transform("categorical_columns", lambda x: x.cast("string")), ","))


@query("preprocess_corpus", f"""WITH {PROCESSED}, e AS (SELECT replace(table_id, '.parquet', '.csv') AS table_id, row_id, l_linenumber,
  {Q2} AS l_quantity, l_extendedprice, l_discount, l_tax,
  (dense_rank() OVER (PARTITION BY table_id ORDER BY l_linestatus) - 1)::INT AS l_linestatus,
  (dense_rank() OVER (PARTITION BY table_id ORDER BY l_returnflag) - 1)::INT AS l_returnflag FROM corpus_li)
SELECT 'raw' AS profile, * FROM processed UNION ALL
SELECT 'encoded', table_id, row_id, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_linestatus::VARCHAR,
  l_returnflag::VARCHAR, (0)::VARCHAR FROM e""")
def preprocess_corpus(t):
    raw = P.preprocess(t.corpus_li(), "l_returnflag", OPTS).withColumn("profile", F.lit("raw"))
    enc = P.preprocess(t.corpus_li(), "l_returnflag", ENCODED)
    enc = enc.select(
        F.lit("encoded").alias("profile"), "table_id", "row_id", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
        "l_tax", F.col("l_linestatus").cast("string"), F.col("l_returnflag").cast("string"),
        (F.col("padded_7") + F.col("padded_8")).cast("string").alias("original"),
    )
    return raw.unionByName(enc)
