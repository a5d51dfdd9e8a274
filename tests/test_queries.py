"""Registered queries against their SQL, and the shape of their plans.

A sample by default; set ALL_QUERIES=1 for every query.
"""

import os
import re
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
import queries
from tools.check import norm

FOLDER = "/root/testdata/sf0.001"
SAMPLE = [
    "t_find_value", "t_neighbors", "t_unique", "t_top_n", "t_sort", "t_cumsum", "t_diffs", "t_sum_rows", "t_mode",
    "profile_all", "t_corr_steps", "t_robust_steps", "corpus_cells", "build_metadata", "preprocess_corpus", "label_encode",
    "generate_prompts", "slice_result", "spans_single", "training_text", "collate", "split_exact", "manifest",
]
NAMES = list(queries.ORACLE) if os.environ.get("ALL_QUERIES") else SAMPLE


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in Path(FOLDER).glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from '{p}'")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, duck, name):
    df = entry.queries()[name](spark, FOLDER)
    rel = duck.sql(entry.oracle_sql()[name])
    columns = sorted(df.columns)
    assert columns == sorted(rel.columns)
    got = Counter(tuple(norm(r[c]) for c in columns) for r in df.collect())
    at = [rel.columns.index(c) for c in columns]
    assert got == Counter(tuple(norm(r[i]) for i in at) for r in rel.fetchall())


def test_every_query_has_sql():
    # questions about tables of many schemas: see test_text_jobs
    assert set(queries.QUERIES) - set(queries.ORACLE) == {"prompts_of_mixed_tables"}


@pytest.mark.parametrize("name", ["t_cumsum", "t_diffs", "t_sort", "mask_target", "corpus_scale", "spans_llama3", "generate_prompts", "profile_all"])
def test_plans_stay_distributed(spark, name):
    plan = entry.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|CartesianProduct|BroadcastNestedLoop", plan)
