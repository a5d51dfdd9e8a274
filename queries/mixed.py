"""Preprocessing of a folder of different tables from its metadata."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellwright.functions.numbers import round_exact_sql
from cellwright.operators import corpus_preprocess as CP, metadata as M, preprocess as P
from cellwright.session import store

from .base import query
from .corpus import MIXED_CELLS, PADDED, PADDED_SQL, SEED, STATS, CORPUS_CELLS, _cells_sql, causal_records, corpus_cells, draw_sql

RAW = P.Options(seed=SEED, keep_all_rows=False, context_length=5000)
#: tables of five columns and more lose some, others are padded
ENCODED = P.Options(encoded=True, max_cols=6, seed=SEED, keep_all_rows=False, context_length=5000)
BUDGET = 500.0


def processed_corpus(t, opts):
    def build():
        # read several times: the cells of fourteen schemas become one stored table
        cells = t.once("stored_cells", lambda: store(corpus_cells(t), "cells"))
        meta = store(M.build_metadata(cells, SEED, M.causal_list(causal_records(t), "n_nationkey")), "meta")
        return CP.preprocess_corpus(cells, meta, opts)

    return t.once(f"processed_corpus_{opts.encoded}", build)


# rows of the padded table are numbered by its key here, as its cells are
_KEYED = CORPUS_CELLS.replace(_cells_sql("Causal_Table2.csv", "padded", PADDED), _cells_sql("Causal_Table2.csv", "padded", PADDED, "s_suppkey"))
assert _KEYED != CORPUS_CELLS
BASE = STATS.replace(CORPUS_CELLS, _KEYED) + """, sized AS (SELECT table_id, count(*) AS n_cols, count_if(active) AS n_active FROM profile GROUP BY 1),
columns AS (SELECT p.*, p.table_id LIKE '%.csv' AS synthetic, p.col_id = l.label_index AS is_label,
    CASE WHEN p.table_id LIKE '%.csv' THEN n_active ELSE n_cols END AS given
  FROM profile p JOIN label_stats l USING (table_id) JOIN sized USING (table_id) WHERE l.label_index <> -1),
placed AS (SELECT *, row_number() OVER (PARTITION BY table_id, is_label ORDER BY col_id) - 1 AS nth FROM columns)"""
TEXT = "coalesce(v_str, CASE WHEN col_type IN ('int', 'bigint') THEN v_num::BIGINT::VARCHAR ELSE v_num::VARCHAR END)"
ROUNDED = f"CASE WHEN col_type = 'double' THEN {round_exact_sql('v_num', 2)} ELSE v_num END"
NEW_NAME = "regexp_replace(table_id, '\\.parquet$', '.csv')"
KEPT_ROWS = f"""row_number() OVER (PARTITION BY table_id ORDER BY {draw_sql('table_id', 'row_id', "'rows'")}, row_id)"""

RAW_SQL = BASE + f""", kept AS (SELECT *, count_if(NOT is_label) OVER (PARTITION BY table_id) AS n_feat FROM placed
  WHERE is_label OR NOT synthetic OR nth < given - 1),
labels AS (SELECT c.table_id, c.row_id, k.n_rows, k.n_feat FROM corpus c JOIN kept k USING (table_id, col_id) WHERE is_label),
marked AS (SELECT table_id, row_id, {KEPT_ROWS} <= ceil({BUDGET} / (n_feat + 1)) AS stays,
  row_number() OVER (PARTITION BY table_id ORDER BY {draw_sql('table_id', 'row_id', "'mask'")}, row_id) <= floor(n_rows * 0.15 + 1e-9) AS hit FROM labels),
raw AS (SELECT {NEW_NAME} AS table_id, c.row_id, CASE WHEN is_label THEN n_feat ELSE nth END::INT AS col_id, k.col_name,
  CASE WHEN is_label THEN 'string' ELSE k.col_type END AS col_type, CASE WHEN NOT is_label THEN {ROUNDED.replace('col_type', 'k.col_type')} END AS v_num,
  CASE WHEN NOT is_label THEN v_str WHEN hit THEN 'missing' ELSE {TEXT.replace('col_type', 'k.col_type')} END AS v_str,
  CASE WHEN is_label AND hit THEN coalesce({TEXT.replace('col_type', 'k.col_type')}, 'nan') END AS original,
  CASE WHEN synthetic THEN 0 ELSE categorical END AS flag, is_label, k.table_id AS old
  FROM corpus c JOIN kept k USING (table_id, col_id) JOIN marked m ON m.table_id = c.table_id AND m.row_id = c.row_id WHERE stays)"""

ENCODED_SQL = BASE + f""", by_draw AS (SELECT *, row_number() OVER (PARTITION BY table_id, is_label ORDER BY
    {draw_sql('table_id', 'col_id', "'column'")}, col_id) AS d FROM columns),
kept0 AS (SELECT * FROM by_draw WHERE is_label OR synthetic OR given <= 6 OR d <= 5),
kept AS (SELECT *, row_number() OVER (PARTITION BY table_id, is_label ORDER BY col_id) - 1 AS nth,
  count_if(NOT is_label) OVER (PARTITION BY table_id) AS n_feat, NOT synthetic AND given < 6 AS pads FROM kept0),
labels AS (SELECT c.table_id, c.row_id, k.n_feat, k.pads FROM corpus c JOIN kept k USING (table_id, col_id) WHERE is_label),
marked AS (SELECT table_id, row_id, {KEPT_ROWS} <= ceil({BUDGET} / CASE WHEN pads THEN 6 ELSE n_feat + 1 END) AS stays FROM labels),
acted AS (SELECT c.table_id, c.row_id, c.v_num, c.v_str, k.* EXCLUDE (table_id), NOT synthetic AND categorical = 1 AS encodes, {TEXT.replace('col_type', 'k.col_type')} AS value
  FROM corpus c JOIN kept k USING (table_id, col_id)),
coded AS (SELECT *, CASE WHEN value IS NULL THEN count(DISTINCT value) OVER (PARTITION BY table_id, col_id)
  ELSE dense_rank() OVER (PARTITION BY table_id, col_id ORDER BY value NULLS LAST) - 1 END AS code FROM acted),
enc AS (SELECT {NEW_NAME} AS table_id, row_id, CASE WHEN NOT is_label THEN nth WHEN pads THEN 5 ELSE n_feat END::INT AS col_id, col_name,
  CASE WHEN encodes THEN 'int' ELSE col_type END AS col_type, CASE WHEN encodes THEN code::DOUBLE ELSE {ROUNDED} END AS v_num,
  CASE WHEN NOT encodes THEN v_str END AS v_str, NULL::VARCHAR AS original, CASE WHEN synthetic THEN 0 ELSE categorical END AS flag, is_label, table_id AS old
  FROM coded JOIN marked USING (table_id, row_id) WHERE stays
  UNION ALL SELECT {NEW_NAME}, row_id, i::INT, 'padded_' || (i + 1), 'int', 0.0::DOUBLE, NULL, NULL, 0, false, table_id
  FROM labels JOIN marked USING (table_id, row_id), range(0, 5) r(i) WHERE stays AND pads AND i >= n_feat)"""

OUT = "table_id, row_id, col_id, col_name, col_type, v_num, v_str, original"


@query("preprocess_mixed", f"WITH {RAW_SQL} SELECT {OUT} FROM raw")
def preprocess_mixed(t):
    """Raw profile over every table of the folder and a padded one: labels last and masked, floats rounded, row budget."""
    return processed_corpus(t, RAW)[0].drop("v_exact")


@query("preprocess_mixed_encoded", f"WITH {ENCODED_SQL} SELECT {OUT} FROM enc")
def preprocess_mixed_encoded(t):
    """Encoded profile: columns dropped or padded to six, all text columns through one dictionary."""
    return processed_corpus(t, ENCODED)[0].drop("v_exact")


def _meta_sql(name, source):
    return f"""SELECT '{name}' AS profile, table_id, any_value(old) LIKE '%.csv' AS is_synthetic_data, count_if(is_label)::BIGINT AS num_rows,
  (max(col_id) + 1)::INT AS num_cols, max(col_id) AS label_index, count(original) > 0 AS target_masked, count(original)::BIGINT AS n_masked,
  (SELECT string_agg(flag::VARCHAR, ',' ORDER BY col_id) FROM (SELECT DISTINCT s.col_id, s.flag FROM {source} s WHERE s.table_id = o.table_id)) AS categorical_columns
  FROM {source} o GROUP BY table_id"""


@query("mixed_metadata", f"WITH {RAW_SQL} {_meta_sql('raw', 'raw')}")
def mixed_metadata(t):
    """Metadata of the processed tables of the raw profile."""
    return _shown(t, RAW, "raw")


@query("mixed_metadata_encoded", f"WITH {ENCODED_SQL} {_meta_sql('encoded', 'enc')}")
def mixed_metadata_encoded(t):
    """Metadata of the processed tables of the encoded profile."""
    return _shown(t, ENCODED, "encoded")


def _shown(t, opts, name):
    meta = processed_corpus(t, opts)[1]
    flags = F.array_join(F.transform("categorical_columns", lambda x: x.cast("string")), ",")
    return meta.select(
        F.lit(name).alias("profile"), "table_id", "is_synthetic_data", "num_rows", "num_cols", "label_index", "target_masked", "n_masked",
        flags.alias("categorical_columns"),
    )
