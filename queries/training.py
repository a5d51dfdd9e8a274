"""Chat rendering, supervised spans, training text, token arrays, synthetic data."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from cellwright.operators.positions import number_rows
from cellwright.plans import chat as H, synth as D
from cellwright.session import scratch_folder
from cellwright.sources import files as IO

from .base import query
from .corpus import PROCESSED, SEED, draw_sql, processed
from .prompts import COLUMNS, dec

CONV = """conv AS (SELECT * FROM conversations)"""
#: one turn is missing in every tenth conversation, which breaks the order there
GAPS = """conv AS (SELECT * FROM conversations WHERE NOT (turn = 1 AND conv_id % 10 = 0))"""
TRIM = CONV + """, talk AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k,
  count(*) OVER (PARTITION BY conv_id) AS m FROM conv WHERE role <> 'system'),
trimmed AS (SELECT conv_id, turn, role, text FROM talk
  WHERE NOT (k = 1 AND role <> 'user') AND NOT (k = m AND role <> 'assistant')),
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS i FROM trimmed),
report AS (SELECT conv_id, count(*) AS n_turns, bool_and(role = CASE WHEN i % 2 = 0 THEN 'user' ELSE 'assistant' END) AS alternates
  FROM numbered GROUP BY 1)"""


def gaps(t):
    """Conversations with one turn missing in every tenth, beside the whole ones."""
    return t.table("conversations").where(~((F.col("turn") == 1) & (F.col("conv_id") % 10 == 0)))


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def pieces_sql(s: H.Style, source="numbered", conv_src="conv", key="") -> str:
    """piece and lead per turn of the sound conversations, written from the format."""
    name = f"CASE WHEN role = 'user' THEN {lit(s.user)} ELSE {lit(s.assistant)} END"
    if s.kind in ("single", "two"):
        head = f"CASE WHEN i = 0 THEN system || {lit(s.sep)} ELSE '' END"
        end = lit(s.sep) if s.kind == "single" else f"CASE WHEN i % 2 = 0 THEN {lit(s.sep)} ELSE {lit(s.sep2)} END"
        piece = f"{head} || CASE WHEN text <> '' THEN {name} || ': ' || text || {end} ELSE {name} || ':' END"
        lead = f"length({head}) + length({name}) + 2"
    elif s.kind == "llama_2":
        before = f"(CASE WHEN i = 0 THEN '[INST] ' || CASE WHEN system <> '' THEN '<<SYS>>\n' || system || '\n<</SYS>>\n\n' ELSE '' END ELSE '<s>[INST] ' END)"
        piece = f"CASE WHEN text = '' THEN '' WHEN i % 2 = 0 THEN {before} || text || ' [/INST]' ELSE ' ' || text || ' </s>' END"
        lead = f"CASE WHEN i % 2 = 0 THEN length({before}) ELSE 1 END"
    else:
        head = "CASE WHEN i = 0 THEN '<|begin_of_text|><|start_header_id|>system<|end_header_id|>' || system || '<|eot_id|>' ELSE '' END"
        mine = f"'<|start_header_id|>' || {name} || '<|end_header_id|>'"
        piece = f"{head} || {mine} || text || '<|eot_id|>'"
        lead = f"length({head}) + length({mine})"
    return f"""sys AS (SELECT conv_id, arg_min(text, turn) AS own FROM {conv_src} WHERE role = 'system' GROUP BY 1),
sound AS (SELECT n.*, coalesce(own, {lit(s.system)}) AS system FROM {source} n JOIN report USING (conv_id) LEFT JOIN sys USING (conv_id) WHERE alternates),
pieces AS (SELECT *, {piece} AS piece, {lead} AS lead FROM sound),
placed AS (SELECT *, sum(length(piece)) OVER (PARTITION BY conv_id ORDER BY i) AS upto, max(i) OVER (PARTITION BY conv_id) AS last_i FROM pieces),
texts AS (SELECT conv_id, string_agg(piece, '' ORDER BY i) AS text FROM pieces GROUP BY 1)"""


SPAN = {
    "llama_3": ("upto - length(piece) + lead", "upto - length(piece) + lead + CASE WHEN instr(text, '<|eot_id|>') > 0 THEN instr(text, '<|eot_id|>') - 1 ELSE length(text) END"),
    "single": ("upto - length(piece) + lead - 1", "CASE WHEN i = last_i THEN upto ELSE upto - 1 END"),
    "llama_2": ("upto - length(piece) + lead", "upto - length(piece) + lead + length(text)"),
}


BROKEN = TRIM.replace(CONV, GAPS)


@query("trim_turns", f"WITH {BROKEN} SELECT conv_id, turn, role, text FROM trimmed")
def trim_turns(t):
    return H.trim_turns(gaps(t))


@query("rejected_conversations", f"WITH {BROKEN} SELECT conv_id, n_turns FROM report WHERE NOT alternates")
def rejected_conversations(t):
    return H.rejected(gaps(t))


@query("alternation_report", f"WITH {BROKEN} SELECT * FROM report")
def alternation_report(t):
    return H.alternation_report(H.trim_turns(gaps(t)))


@query("mark_table", """SELECT conv_id, turn, role, CASE WHEN turn = min(turn) OVER (PARTITION BY conv_id)
  THEN '<table>\n' || text ELSE text END AS text FROM conversations""")
def mark_table(t):
    return H.mark_table(t.table("conversations"))


def _render(name):
    @query(f"render_{name.replace('_', '')}" if name.startswith("llama") else f"render_{name}",
           f"WITH {TRIM}, {pieces_sql(H.STYLES[name])} SELECT * FROM texts")
    def run(t):
        return H.render_chat(t.table("conversations"), name)


for _n in H.STYLES:
    _render(_n)


def _spans(name):
    start, end = SPAN[name]

    @query(f"spans_{name.replace('_', '')}", f"""WITH {TRIM}, {pieces_sql(H.STYLES[name])}
SELECT conv_id, i, ({start})::BIGINT AS start, ({end})::BIGINT AS "end" FROM placed WHERE role = 'assistant'""")
    def run(t):
        return H.supervised_spans(t.table("conversations"), name)


for _n in SPAN:
    _spans(_n)


# ------------------------------------------------------------------ tables in text
def _cell_sql(c: str) -> str:
    if c == "l_linenumber":
        return f"coalesce({c}::VARCHAR, 'nan')"
    return f"coalesce({dec(c)}, 'nan')" if c in COLUMNS[:5] else f"coalesce({c}, 'nan')"


ROW_TEXT = "'Row ' || rn || ' - ' || " + " || ', ' || ".join(f"'column {i + 1}: ' || {_cell_sql(c)}" for i, c in enumerate(COLUMNS))
TABLE_TEXT = PROCESSED + f""", tt AS (SELECT table_id, string_agg({ROW_TEXT}, '. ' ORDER BY rn) || '.' AS table_text
  FROM (SELECT *, row_number() OVER (PARTITION BY table_id ORDER BY row_id) AS rn FROM processed) GROUP BY 1)"""


@query("table_text", f"WITH {TABLE_TEXT} SELECT * FROM tt")
def table_text(t):
    return H.table_text(processed(t), COLUMNS)


CONV_TABLE = """conv AS (SELECT conv_id, turn, role, CASE WHEN turn = min(turn) OVER (PARTITION BY conv_id) THEN '<table>\n' || text ELSE text END AS text,
  'supplier_' || conv_id % 120 || '.csv' AS table_id FROM conversations)"""


def conv_table(t):
    marked = H.mark_table(t.table("conversations"))
    return marked.withColumn("table_id", F.concat(F.lit("supplier_"), F.col("conv_id") % 120, F.lit(".csv")))


INJECTED = f"""{TABLE_TEXT}, {CONV_TABLE}, injected AS (SELECT conv_id, turn, role, table_id,
  CASE WHEN table_text IS NOT NULL THEN replace(text, '<table>', '<tb_start>' || table_text || '<tb_end>') ELSE text END AS text
  FROM conv LEFT JOIN tt USING (table_id))"""


@query("inject_table", f"WITH {INJECTED} SELECT conv_id, turn, role, table_id, length(text) AS n_chars, md5(text) AS digest FROM injected")
def inject_table(t):
    out = H.inject_table(conv_table(t), H.table_text(processed(t), COLUMNS))
    return out.select("conv_id", "turn", "role", "table_id", F.length("text").cast("bigint").alias("n_chars"), F.md5("text").alias("digest"))


_L3 = H.STYLES["llama_3"]


@query("training_text", f"""WITH {INJECTED.replace('conv AS (', 'conv0 AS (').replace('FROM conv LEFT', 'FROM conv0 LEFT')},
{TRIM.replace(CONV, 'conv AS (SELECT * FROM injected)')}, {pieces_sql(_L3)},
s AS (SELECT conv_id, count(*) AS n_spans, sum(({SPAN['llama_3'][1]}) - ({SPAN['llama_3'][0]}))::BIGINT AS supervised,
  sum({SPAN['llama_3'][0]})::BIGINT AS start_sum FROM placed WHERE role = 'assistant' GROUP BY 1)
SELECT conv_id, 'supplier_' || conv_id % 120 || '.csv' AS table_id, length(text) AS n_chars, md5(text) AS digest, n_spans, supervised, start_sum
FROM texts JOIN s USING (conv_id)""")
def training_text(t):
    texts, spans = H.build_training_text(conv_table(t), processed(t), COLUMNS)
    per = spans.groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("n_spans"), F.sum(F.col("end") - F.col("start")).alias("supervised"), F.sum("start").alias("start_sum"))
    return texts.select("conv_id", "table_id", F.length("text").cast("bigint").alias("n_chars"), F.md5("text").alias("digest")).join(per, "conv_id")


# ------------------------------------------------------------------ token arrays
LEAD = "<|end_header_id|>"
STOP = ord("\x03")
TOK = f"""{TRIM}, {pieces_sql(_L3)}, tok AS (SELECT conv_id, list_transform(string_split(replace(text, '<|eot_id|>', chr(3)), ''),
  lambda c: unicode(c)) AS ids FROM texts)"""
LABELS = TOK + f""", lead AS (SELECT *, list_transform(list_filter(range(0, len(ids) - {len(LEAD)} + 1), lambda i:
  ids[i + 1:i + {len(LEAD)}] = [{', '.join(str(ord(c)) for c in LEAD)}]), lambda i: i + {len(LEAD)}) AS starts,
  list_filter(range(0, len(ids)), lambda i: ids[i + 1] = {STOP}) AS stops FROM tok),
labelled AS (SELECT conv_id, ids, list_transform(ids, lambda x, i: CASE WHEN len(list_filter(starts, lambda b: i - 1 >= b AND i - 1 <
  coalesce(list_min(list_filter(stops, lambda e: e >= b)), len(ids)))) > 0 THEN x ELSE -100 END) AS labels FROM lead)"""


def tokens(t):
    """Character codes of the rendered conversations; the end mark is one code."""
    text = F.replace("text", F.lit("<|eot_id|>"), F.lit("\x03"))
    codes = F.transform(F.split(text, ""), lambda c: F.ascii(c))
    return H.render_chat(t.table("conversations"), "llama_3").select("conv_id", codes.alias("input_ids"))


def labelled(t):
    return H.mask_labels(tokens(t), "input_ids", [ord(c) for c in LEAD], STOP)


def _digest(c):
    return F.md5(F.array_join(F.transform(c, lambda x: x.cast("int").cast("string")), ","))


@query("mask_labels", f"""WITH {LABELS} SELECT conv_id, len(ids)::INT AS n_ids, len(list_filter(labels, lambda x: x <> -100))::INT AS n_kept,
  md5(array_to_string(labels, ',')) AS digest FROM labelled""")
def mask_labels(t):
    return labelled(t).select("conv_id", F.size("input_ids").alias("n_ids"),
                              F.size(F.filter("labels", lambda x: x != -100)).alias("n_kept"), _digest("labels").alias("digest"))


@query("collate", f"""WITH {LABELS}, b AS (SELECT *, (row_number() OVER (ORDER BY conv_id) - 1) // 8 AS batch_id FROM labelled),
w AS (SELECT *, max(len(ids)) OVER (PARTITION BY batch_id) AS width FROM b),
p AS (SELECT batch_id, conv_id, (ids || list_transform(range(0, width - len(ids)), lambda i: 0))[1:1500] AS ids,
  (labels || list_transform(range(0, width - len(ids)), lambda i: -100))[1:1500] AS labels FROM w)
SELECT batch_id, conv_id, len(ids)::INT AS width, md5(array_to_string(ids, ',')) AS ids_digest, md5(array_to_string(labels, ',')) AS labels_digest,
  len(list_filter(ids, lambda x: x <> 0))::INT AS attended FROM p""")
def collate(t):
    out = H.collate(labelled(t), ["conv_id"], 8, 0, 1500)
    return out.select("batch_id", "conv_id", F.size("input_ids").alias("width"), _digest("input_ids").alias("ids_digest"),
                      _digest("labels").alias("labels_digest"), F.size(F.filter("attention_mask", lambda x: x)).alias("attended"))


# ------------------------------------------------------------------ synthetic data
def _two(expr):
    from cellwright.functions.numbers import round_exact_sql

    return round_exact_sql(expr, 2)


def samples(t):
    """One sample per customer, with its id."""
    n = t.table("customer").count()
    numbered = t.once("customers_numbered", lambda: number_rows(t.table("customer").select("c_custkey"), ["c_custkey"], out="number"))
    return D.unique_ids(numbered, "number", n, SEED)


_LOW, _SIZE = D.id_space(1)
IDS = f"""ids AS (SELECT c_custkey, {_LOW} + ((row_number() OVER (ORDER BY c_custkey) - 1)::HUGEINT * {D.id_step(_SIZE, SEED)} + {SEED}) % {_SIZE} AS id FROM customer)"""
IDS = IDS.replace(f"{_LOW} + (", f"({_LOW} + (").replace(f"% {_SIZE} AS id", f"% {_SIZE})::BIGINT AS id")
CHAT_TURNS = IDS + f""", turns AS (SELECT id, k, floor({draw_sql('id', "'pairs'")} * 4)::BIGINT + 1 AS pairs,
  floor({draw_sql('id', 'k', "'digit'")} * 10)::BIGINT AS digit FROM ids, range(0, 4) r(k))"""


@query("random_tables", "WITH g AS (SELECT s_suppkey AS table_id, r.row_id FROM supplier, range(0, 20) r(row_id)) SELECT table_id, row_id::INT AS row_id, "
       + ", ".join(f"{_two(draw_sql('table_id', 'row_id', str(c)))} AS c{c}" for c in range(6)) + " FROM g")
def random_tables(t):
    return D.random_tables(t.table("supplier").select(F.col("s_suppkey").alias("table_id")), 20, 6, SEED)


@query("unique_ids", f"WITH {IDS} SELECT c_custkey, id FROM ids")
def unique_ids(t):
    return samples(t).select("c_custkey", "id")


@query("random_chats", f"""WITH {CHAT_TURNS} SELECT id, 2 * k AS pos, 'human' AS "from", 'what is the class?' AS value FROM turns WHERE k < pairs
UNION ALL SELECT id, 2 * k + 1, 'gpt', digit::VARCHAR FROM turns WHERE k < pairs""")
def random_chats(t):
    out = D.random_chats(samples(t).select("id"), SEED)
    return out.select("id", F.posexplode("conversations").alias("pos", "c")).select("id", F.col("pos").cast("bigint").alias("pos"), "c.*")


_SPLIT = draw_sql("o_orderkey", "'split'")


@query("split_exact", f"""SELECT o_orderkey, CASE WHEN row_number() OVER (ORDER BY {_SPLIT}, o_orderkey) <= floor(count(*) OVER () * 0.7 + 1e-9)
  THEN 'train' ELSE 'eval' END AS part FROM orders""")
def split_exact(t):
    return D.split_exact(t.table("orders").select("o_orderkey"), 0.7, SEED, "o_orderkey")


@query("split_hash", f"SELECT o_orderkey, CASE WHEN {_SPLIT} < 0.7 THEN 'train' ELSE 'eval' END AS part FROM orders")
def split_hash(t):
    return D.split_hash(t.table("orders").select("o_orderkey"), 0.7, SEED, "o_orderkey")


@query("manifest", f"""WITH {CHAT_TURNS} SELECT id, id || '.csv' AS table_name, 2 * max(pairs) AS n_turns, '<table>\nwhat is the class?' AS first_turn,
  arg_max(digit, k)::VARCHAR AS last_turn FROM turns WHERE k < pairs GROUP BY id""")
def manifest(t):
    """Written as JSON lines and read back."""
    path = f"{scratch_folder(t.spark)}/manifest-{uuid.uuid4().hex}"
    IO.write_records(D.manifest(samples(t).select("id"), SEED), path)
    back = IO.read_records(t.spark, path, IO.PROMPT_SCHEMA.replace("id string", "id bigint"))
    return back.select("id", F.col("table").alias("table_name"), F.size("conversations").cast("bigint").alias("n_turns"),
                       F.col("conversations")[0]["value"].alias("first_turn"), F.element_at("conversations", -1)["value"].alias("last_turn"))
