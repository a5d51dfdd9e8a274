"""The trained networks: gradients, held-out accuracy, defined cases."""

import numpy as np
import pyarrow as pa

from cellwright.llm import gru, langid, toxicity
from cellwright.llm.queries import QUERIES
from cellwright.llm.textbytes import text_bytes

DOCS = "doc_id long, text string, lang string"


def test_backpropagation_matches_differences():
    rng = np.random.default_rng(0)
    x, u = rng.standard_normal((5, 9, 4)) * 0.4, gru.start(3, rng).astype(np.float64)
    x[:, :6] += 0.5
    want = rng.standard_normal((5, 3, 4))

    def loss(x, u):
        h, out = np.zeros((3, 4)), []
        for t in range(5):
            zr = np.clip(x[t, :6] + u[:6] @ h, 0, 1)
            c = np.clip(x[t, 6:] + u[6:] @ (zr[3:] * h), -1, 1)
            h = h + zr[:3] * (c - h)
            out.append(h)
        return float((np.stack(out) * want).sum())

    states, saved = gru.forward(lambda t: x[t], u, 5, keep=True)
    assert abs(float((states * want).sum()) - loss(x, u)) < 1e-4
    dx, du = gru.backward(want, [tuple(np.asarray(s, np.float64) for s in row) for row in saved], u)
    for array, grad in ((x, dx), (u, du)):
        for _ in range(25):
            at = tuple(rng.integers(0, n) for n in array.shape)
            kept, eps = array[at], 1e-5
            array[at] = kept + eps
            high = loss(x, u)
            array[at] = kept - eps
            low = loss(x, u)
            array[at] = kept
            assert abs((high - low) / (2 * eps) - grad[at]) < 2e-3


def test_padding_leaves_the_state():
    rng = np.random.default_rng(1)
    u = gru.start(4, rng)
    x = rng.standard_normal((6, 12, 2)).astype(np.float32)
    x[4:, :4] = gru.PAD
    states = gru.forward(lambda t: x[t], u, 6)
    assert (states[5] == states[3]).all()


def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang").collect()
    lang = {r["doc_id"]: r["lang"] for r in docs}
    out = QUERIES["op2_language"](spark, "/root/testdata/sf0.01").collect()
    assert len(out) == len(docs)
    held = [r for r in out if r["held_out"]]
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in held]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in out)


def test_language_cases(spark):
    rows = [(i, t, lang) for i in range(60) for t, lang in (("the of and thing", "en"), ("der die und schön", "de"))]
    rows = [(k, t, lang) for k, (_, t, lang) in enumerate(rows)]
    rows += [(500, None, "en"), (501, "", "en"), (502, "12 34 !!", None), (503, "the and of", None), (503, "the and of", None)]
    rows += [(504, "schön und die " * 20_000, None), (None, "the thing", None)]
    df = spark.createDataFrame([(*r, 1.0, None) for r in rows], DOCS + ", lang_score double, lang_pred string")
    out = {}
    for r in langid.identify(df).collect():
        out.setdefault(r["doc_id"], []).append((r["lang_pred"], r["score"]))
    assert out[500] == out[501] == out[502] == [("und", 0.0)]
    assert [x[0] for x in out[503]] == ["en", "en"] and out[504][0][0] == "de" and out[None][0][0] == "en"
    kept = langid.keep_identified(df)
    assert kept.columns == df.columns and kept.count() == len(rows) - 3
    bare = langid.identify(spark.createDataFrame([(1, "some text", None)], DOCS)).collect()
    assert [(r["lang_pred"], r["score"]) for r in bare] == [("und", 0.0)]
    assert langid.identify(df.where("false")).collect() == []


def test_all_bytes_of_a_text_are_labelled():
    net = langid.train([("abc abd aba", "x"), ("zyz zzy yyz", "y")] * 5, steps=40)
    rng = np.random.default_rng(5)
    texts = ["ab" * n for n in (1, 100, 128, 129, 700)] + ["", "".join(rng.choice(list("abyz "), 3000))]
    got = langid.document_probabilities(net, *text_bytes(pa.array(texts)))
    assert np.allclose(got.sum(axis=1), [1, 1, 1, 1, 1, 0, 1], atol=1e-4)
    alone = [langid.document_probabilities(net, *text_bytes(pa.array([t])))[0] for t in texts]
    assert np.allclose(got, alone, atol=1e-5)


def test_toxicity_of_held_out_documents(spark):
    folder = "/root/testdata/sf0.1"
    label = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    out = QUERIES["op6_toxicity"](spark, folder).collect()
    assert len({r["doc_id"] for r in out}) == len(out) == 10_000
    held = [(r["score"], label[r["doc_id"]], r["predicted"]) for r in out if r["held_out"] and r["doc_id"] in label]
    score, y, predicted = map(np.array, zip(*held))
    order = score.argsort().argsort()
    n1, n0 = (y == 1).sum(), (y == 0).sum()
    assert (order[y == 1].sum() - n1 * (n1 - 1) / 2) / (n1 * n0) > 0.95
    assert predicted[y == 0].mean() < 0.02 and predicted[y == 1].mean() > 0.8


def test_toxicity_cases(spark):
    clean, bad = "good calm words of the day and night " * 8, "good calm words of the vile fool and night " * 8
    rows = [(i, bad if i % 2 else clean, "en") for i in range(80)]
    rows += [(100, None, "en"), (101, "", "en"), (102, "?!", "en"), (103, clean * 50 + "vile fool " + clean * 50, "en"), (103, clean, "en"), (None, bad, "en")]
    df = spark.createDataFrame([(*r, 7, 7) for r in rows], DOCS + ", toxic int, toxicity int")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(80)] + [(999, 1, 0), (100, None, 0), (None, 1, 0)], "doc_id long, toxic int, text int")
    out = {}
    for r in toxicity.score_toxicity(df, labels).collect():
        out.setdefault(r["doc_id"], []).append(r["score"])
    assert out[100] == out[101] == out[102] == [0.0]
    assert sorted(x >= toxicity.TOXIC for x in out[103]) == [False, True] and out[None][0] >= toxicity.TOXIC
    kept = toxicity.drop_toxic(df, labels)
    assert kept.columns == df.columns and kept.where("doc_id < 80").count() == 40
    one_class = toxicity.score_toxicity(df, labels.where("toxic = 0")).collect()
    assert {r["score"] for r in one_class} == {0.0}
    assert toxicity.score_toxicity(df.where("false"), labels).collect() == []


def test_every_word_lies_in_a_window():
    texts = ["w " * n for n in (0, 1, 31, 32, 33, 48, 49, 1000)]
    words = toxicity.Words(*text_bytes(pa.array(texts)))
    at = words.places(np.arange(len(words.doc)))
    seen = np.bincount(at[at < len(words.hashes)], minlength=len(words.hashes))
    assert (seen >= 1).all() and words.texts == len(texts)


def test_toxicity_memory_does_not_grow_with_the_sample():
    """Beside what words are kept as, scoring holds the vectors of the windows in hand only."""
    import tracemalloc

    rng = np.random.default_rng(3)
    params = {"word": rng.standard_normal((1, toxicity.SIZE)).astype(np.float32), "char": rng.standard_normal((toxicity.PAIRS, toxicity.SIZE)).astype(np.float32)}
    for way in "fb":
        params |= {f"in_{way}": rng.standard_normal((3 * toxicity.UNITS, 2 * toxicity.SIZE)).astype(np.float32), f"u_{way}": gru.start(toxicity.UNITS, rng)}
        params[f"b_{way}"] = np.zeros(3 * toxicity.UNITS, np.float32)
    params |= {"look": np.ones(2 * toxicity.UNITS, np.float32), "out": np.ones(2 * toxicity.UNITS, np.float32), "bias": np.zeros(1, np.float32)}
    net = toxicity.ToxicityNet(np.zeros(0, np.uint64), params)
    text = "some words of a text that goes on and on, " * 120
    buf, offsets = text_bytes(pa.array([text] * 800))
    tracemalloc.start()
    words = toxicity.Words(buf, offsets)
    made = tracemalloc.get_traced_memory()[1]
    tracemalloc.reset_peak()
    before = tracemalloc.get_traced_memory()[0]
    logits = net.document_logits(words)
    scoring = tracemalloc.get_traced_memory()[1] - before
    tracemalloc.stop()
    one = net.document_logits(toxicity.Words(*text_bytes(pa.array([text]))))
    assert np.allclose(logits, one[0], atol=1e-4)
    assert made < 90 * len(buf) and scoring < 150 << 20
