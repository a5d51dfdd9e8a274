"""The pipeline on the smallest tables, each stage against a brute-force version."""

import corpus_pipeline
from cellwright.llm import decontam, langid, simhash, toxicity
from cellwright.llm.queries import QUERIES, table
from cellwright.session import store

from test_search_ops import brute_contained, brute_groups, plain_fingerprint

FOLDER = "/root/testdata/sf0.001"


def test_stages_do_their_whole_job(spark, tmp_path):
    docs = table(spark, FOLDER, "documents")
    columns = docs.columns
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    tables = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, FOLDER).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        tables.append(docs)
    assert all(t.columns == columns for t in tables[:-1])
    kept = [{r["doc_id"] for r in t.select("doc_id").collect()} for t in tables]
    judged = {r["doc_id"]: r for r in QUERIES["op2_language"](spark, FOLDER).collect()}
    assert kept[0] == {d for d, r in judged.items() if r["lang_pred"] != "und" and r["score"] >= langid.least_score(4)}
    scored = toxicity.score_toxicity(tables[0], table(spark, FOLDER, "labels")).collect()
    assert kept[1] == {r["doc_id"] for r in scored if r["score"] < toxicity.TOXIC}
    groups = brute_groups([(d, plain_fingerprint(rows[d])) for d in sorted(kept[1])])
    assert kept[2] == {d for d, root in groups.items() if d == root}
    items = [(r["item_id"], r["text"]) for r in table(spark, FOLDER, "benchmark").collect()]
    bad = {d for d, _ in brute_contained([(d, rows[d]) for d in kept[2]], items)}
    assert kept[3] == kept[2] - bad
    assert kept[4] == kept[3]
    whole = tables[4].selectExpr("sum(length) n").first()["n"]
    assert whole == tables[4].select("doc_id", "doc_tokens").distinct().selectExpr("sum(doc_tokens) n").first()["n"]


def test_run_keeps_the_documents_of_the_stages(spark):
    out = corpus_pipeline.run(spark, FOLDER)
    assert {"doc_id", "start", "length", "sequence_id", "offset"} <= set(out.columns) and out.count() > 0


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def run_stages(spark, rows, folder=FOLDER):
    docs = spark.createDataFrame(rows, DOCS)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = store(stage(spark, docs, folder), "stage")
    return docs


def test_stages_on_an_empty_table(spark):
    assert run_stages(spark, []).count() == 0
    _, pack = corpus_pipeline.STAGES[-1]
    assert pack(spark, spark.createDataFrame([], DOCS), FOLDER).count() == 0


def test_without_languages_nothing_is_rejected_as_unidentified(spark):
    docs = spark.createDataFrame([(1, "some words", None, "s", 1), (None, None, None, None, None)], DOCS)
    assert langid.keep_identified(docs).count() == 2


def test_repeated_and_null_ids(spark):
    same = "one two three four five six seven eight nine ten " * 3
    other = "an entirely different text about rivers and mountains and the towns between them"
    rows = [(1, same), (1, same), (2, same), (None, same), (None, same), (None, other), (None, other), (7, None), (8, "")]
    kept = simhash.drop_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r.doc_id, r.text) for r in kept), key=repr) == sorted([(1, same), (None, other), (7, None)], key=repr)
    only_null = simhash.drop_duplicates(spark.createDataFrame([(None, same), (None, same)], "doc_id long, text string"))
    assert only_null.count() == 1
    items = spark.createDataFrame([(1, other)], "item_id long, text string")
    clean = decontam.drop_contaminated(spark.createDataFrame(rows, "doc_id long, text string"), items).collect()
    assert len(clean) == 7 and all(r.text != other for r in clean)


def test_texts_stay_where_they_are_when_duplicates_leave(spark, monkeypatch):
    words = ["amber", "bridge", "copper", "dune", "ember", "fjord", "granite", "harbor", "island", "juniper"]
    texts = [" ".join(words[(k * j + j) % 10] + str(k) for j in range(1, 30)) for k in range(60)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(100 + i, t) for i, t in enumerate(texts[::3])] + [(5, texts[5])] * 2 + [(None, texts[7])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    groups = brute_groups([(d, plain_fingerprint(t)) for d, t in rows if d is not None])
    want = sorted((d, texts[d]) for d, root in groups.items() if d == root)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for bits in (simhash.MARK_BITS, 6):  # 64 bits: many rows share a bit with one that leaves
            monkeypatch.setattr(simhash, "MARK_BITS", bits)
            kept = simhash.drop_duplicates(docs)
            assert sorted(map(tuple, kept.collect())) == want
            # all rows were shuffled to the keys that leave as soon as those were too many to send out
            assert "LeftAnti" not in kept._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
