"""Operators that are column expressions: URL rules, chat examples, shards, weighted fingerprints."""

import hashlib
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cellwright.llm import chatfmt, fingerprints, sharding, urls

DOCS = "doc_id long, text string"


# ------------------------------------------------------------------ URL rules
def brute_verdict(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = rest
    for c in "/?#":
        host = host.split(c)[0]
    path = rest[len(host) :].split("?")[0].split("#")[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [
        (-len(h + p), h + p, v) for h, p, v in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = min(fits, default=(0, None, urls.DEFAULT))
    return host, path, best[1], best[2]


def test_url_rules(spark):
    cases = [
        None, "", "no scheme", "http://", "https://EXAMPLE.org/en/12", "https://a.b.example.org/es/x?y#z", "http://example.org",
        "http://example.orgx/es/", "http://org/", "http://com/fr/", "http://x.com/fr", "http://x.com/de/?q=/fr/", "http://x.com#/fr/",
        "a://b://example.org/en/1", "http://notexample.org/en/1", "http://.com/fr/", "http://é.com/fr/é", "http://x.com:80/fr/",
        "http://example.org/en/1", "http://example.org/en/1", "http://example.org/\n/en/1",
    ]
    pages = spark.createDataFrame([(i, u, "x", "clash") for i, u in enumerate(cases)], "page_id long, url string, token string, rule string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urls.judge_urls(pages, urls.rule_table(spark)).collect()}
    assert got == {i: brute_verdict(u) for i, u in enumerate(cases)}
    assert urls.judge_urls(pages.where("false"), urls.rule_table(spark)).collect() == []
    none = urls.judge_urls(pages, urls.rule_table(spark).where("false")).collect()
    assert len(none) == len(cases) and {r["verdict"] for r in none} == {urls.DEFAULT}


def test_rules_without_whole_tokens_and_regular_signs(spark):
    rules = spark.createDataFrame([("", "/a", "block"), ("x.y", "/(b", "allow"), ("x.y", "/a", "allow")], "rule_host string, rule_path string, rule_verdict string")
    pages = spark.createDataFrame([(1, "z://q/abc"), (2, "z://xay/(b"), (3, "z://x.y/(b+"), (4, "z://x.y/a")], "page_id long, url string")
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in urls.judge_urls(pages, rules).collect()}
    assert got == {1: (None, "allow"), 2: (None, "allow"), 3: ("x.y/(b", "allow"), 4: ("x.y/a", "allow")}


# ------------------------------------------------------------------ chat
def test_chat_round_trip(spark):
    rng = random.Random(3)
    bits = ["\\", "\\\\", "###", "####", "</turn>", "</turn>\n", "\\h", "\\e", "\\c", ": ", ":", "a", "é😀", "\n", "### user: ", "<", "/turn>", "#"]
    made = {}
    for conv in range(60):
        roles = [rng.choice(["user", "assistant", "system", "a: b\\", None, "###"]) for _ in range(rng.randint(1, 6))]
        made[conv] = [(t, r, rng.choice([None, "".join(rng.choice(bits) for _ in range(rng.randint(0, 7)))])) for t, r in enumerate(roles)]
    rows = [(c, *t, 0) for c, turns in made.items() for t in turns]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, example int")
    out = chatfmt.format_examples(df).withColumn("turns", chatfmt.read_turns(F.col("formatted"))).withColumn(
        "loss", chatfmt.read_loss(F.col("formatted"), F.col("loss_start"), F.col("loss_end"))
    ).collect()
    seen = {}
    for r in out:
        seen.setdefault(r["conv_id"], []).append(r)
    for conv, turns in made.items():
        plain = [(r or "", t or "") for _, r, t in turns]
        examples = sorted(seen[conv], key=lambda r: r["example"])
        ends = [i + 1 for i, (r, _) in enumerate(plain) if r == "assistant"]
        ends += [] if ends and ends[-1] == len(plain) else [len(plain)]
        assert [[tuple(t) for t in e["turns"]] for e in examples] == [plain[:k] for k in ends]
        assert [e["loss"] for e in examples if e["loss_start"] is not None] == [t for r, t in plain if r == "assistant"]
    assert chatfmt.format_examples(df.where("false")).collect() == []


def test_chat_keeps_null_conversations_ties_and_repeats(spark):
    rows = [(None, 0, "user", "x"), (None, 0, "user", "x"), (None, None, "assistant", "y")]
    out = chatfmt.format_examples(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert sorted(r["formatted"] for r in out) == [
        "### assistant: y</turn>\n", "### assistant: y</turn>\n### user: x</turn>\n### user: x</turn>\n",
    ]


# ------------------------------------------------------------------ shards
def check_shards(rows, out, shards):
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "") for r in out) == sorted((d is None, d or 0, t or "") for d, t in rows)
    for s in {r["shard"] for r in out}:
        assert sorted(r["slot"] for r in out if r["shard"] == s) == list(range(sum(r["shard"] == s for r in out)))
    size = Counter()
    for r in out:
        assert r["size"] == len((r["text"] or "").encode()) + 8
        size[r["shard"]] += r["size"]
    assert set(size) <= set(range(shards))
    return [size[s] for s in range(shards)]


def test_shards_have_near_equal_bytes_with_a_hot_group(spark):
    rng = random.Random(5)
    rows = [(i, "copy of one text " * 5) for i in range(700)] + [(1000 + i, "é" * rng.randint(0, 200)) for i in range(1400)]
    rows += [(None, None), (5000, None), (5000, None), (5001, "long " * 300)]
    df = spark.createDataFrame([(*r, 1) for r in rows], DOCS + ", shard int")
    sizes = check_shards(rows, sharding.shard_by_bytes(df, 5, 2).collect(), 5)
    assert max(sizes) - min(sizes) <= 0.03 * sum(sizes)


def test_equal_texts_stay_together_when_they_fit(spark):
    rows = [(i, f"text {i % 400} " * 3) for i in range(1600)]
    out = sharding.shard_by_bytes(spark.createDataFrame(rows, DOCS), 4, 1, tolerance=0.02).collect()
    where = {}
    for r in out:
        where.setdefault(r["text"], set()).add(r["shard"])
    assert all(len(w) == 1 for w in where.values())


def test_shards_of_little_or_nothing(spark):
    assert sharding.shard_by_bytes(spark.createDataFrame([], DOCS), 4).collect() == []
    rows = [(1, "only")]
    check_shards(rows, sharding.shard_by_bytes(spark.createDataFrame(rows, DOCS), 4).collect(), 4)


# ------------------------------------------------------------------ weighted fingerprints
def jaccard(a, b):
    a, b = Counter(a.lower().split()), Counter(b.lower().split())
    whole = sum((a | b).values())
    return sum((a & b).values()) / whole if whole else 1.0


def test_collision_rate_is_generalised_jaccard(spark):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(60)]
    texts = []
    for _ in range(40):
        base = [rng.choice(words[: rng.randint(3, 60)]) for _ in range(rng.randint(1, 80))]
        other = [w if rng.random() < 0.7 else rng.choice(words) for w in base] + [rng.choice(words)] * rng.randint(0, 9)
        texts.append((" ".join(base), " ".join(other)))
    rows = [(i, side, t) for i, pair in enumerate(texts) for side, t in enumerate(pair)]
    samples = 512
    got = fingerprints.signatures(spark.createDataFrame(rows, "i int, side int, text string"), ["i", "side"], samples=samples).collect()
    sig = {(r["i"], r["side"]): r["signature"] for r in got}
    errors = []
    for i, (a, b) in enumerate(texts):
        rate = sum(x == y for x, y in zip(sig[i, 0], sig[i, 1])) / samples
        errors.append(rate - jaccard(a, b))
    # samples are independent: a standard deviation of at most 0.022
    assert max(map(abs, errors)) < 0.1 and abs(sum(errors) / len(errors)) < 0.02


def test_two_texts_of_a_row_are_sampled_like_one_at_a_time(spark):
    rng = random.Random(3)
    rows = []
    for i in range(60):
        base = [f"w{rng.randint(0, 12)}" for _ in range(rng.randint(0, 25))]
        rows.append((i, rng.choice([" ".join(base), None, ""]), " ".join(w for w in base if rng.random() < 0.7)))
    df = spark.createDataFrame(rows, "i int, a string, b string")
    both = fingerprints.signatures(df, ["i"], ("a", "b"), 16)
    alone = {n: {r.i: r.signature for r in fingerprints.signatures(df, ["i"], (c,), 16).collect()} for n, c in (("signature", "a"), ("edited_signature", "b"))}
    for r in both.collect():
        assert r.signature == alone["signature"][r.i] and r.edited_signature == alone["edited_signature"][r.i]
    assert both.count() == len(rows)


def test_likeness_at_production_samples_errs_like_independent_samples(spark):
    rng = random.Random(17)
    pairs = []
    for i in range(400):
        base = [f"{i}-{rng.randint(0, 40)}" for _ in range(60)]
        pairs.append((" ".join(base), " ".join(w if rng.random() < 0.75 else f"{i}-{rng.randint(0, 40)}" for w in base)))
    rows = [(i, side, t) for i, pair in enumerate(pairs) for side, t in enumerate(pair)]
    got = fingerprints.signatures(spark.createDataFrame(rows, "i int, side int, text string"), ["i", "side"]).collect()
    sig = {(r["i"], r["side"]): r["signature"] for r in got}
    samples = len(sig[0, 0])
    wrong, scaled = [], []
    for i, (a, b) in enumerate(pairs):
        true = jaccard(a, b)
        error = sum(x == y for x, y in zip(sig[i, 0], sig[i, 1])) / samples - true
        wrong.append(error**2)
        scaled.append(error**2 / (true * (1 - true) / samples))
    assert samples >= 64 and math.sqrt(sum(wrong) / len(wrong)) < 0.07
    # 1 when samples do not depend on one another
    assert math.sqrt(sum(scaled) / len(scaled)) < 1.12


def test_samples_are_not_computed_under_a_condition(spark):
    # Spark shares repeated parts of expressions (here hashes and logarithms) only outside of conditions
    rows = [(1, "a b b", "a c"), (2, None, ""), (3, "", "x")]
    texts = spark.createDataFrame(rows, "k long, text string, edited string")
    best = fingerprints._term_rows(texts, ["k"], ["text", "edited"]).groupBy("k", "_in").agg(F.min(fingerprints._sample(0)).alias("s"))
    assert {(r.k, r._in): r.s is None for r in best.collect()}[2, 1]
    found = fingerprints.signatures(texts, ["k"], ("text", "edited"), 2)
    update = [x for x in found._jdf.queryExecution().optimizedPlan().toString().splitlines() if "xxhash64(_term" in x]
    assert update and not any("CASE" in x[: x.index("xxhash64(_term")] for x in update)
    out = {r.k: (list(r.signature), list(r.edited_signature)) for r in found.collect()}
    assert out[2] == ([0, 0], [0, 0]) and out[3][0] == [0, 0] and out[3][1] != [0, 0]


def test_edited_texts_and_defined_cases(spark):
    texts = {1: "Ab cd ef gh ij kl", 2: None, 3: "", 5: "é😀 " * 9, 8: "Ab cd ef gh ij kl", 9: "x", 11: "many words " * 4000}
    rows = [(k, t, 0) for k, t in texts.items()] + [(5, texts[5], 0)]
    out = fingerprints.compare_edited(spark.createDataFrame(rows, DOCS + ", h int")).collect()
    assert Counter(r["doc_id"] for r in out) == Counter([*texts, 5])
    ids = sorted(texts)
    by = {r["doc_id"]: r for r in out}
    for k, i in enumerate(ids):
        text, following = texts[i] or "", texts[ids[(k + 1) % len(ids)]] or ""
        q = math.floor(len(text) / 4)
        edited = text[: len(text) - q] + following[:q]
        assert by[i]["n_chars"] == len(text) and by[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert by[i]["next_signature"] == by[ids[(k + 1) % len(ids)]]["signature"]
    assert by[1]["signature"] == by[8]["signature"] and set(by[2]["signature"]) == {0} == set(by[3]["signature"])
    one = fingerprints.compare_edited(spark.createDataFrame([(1, "a b c d")], DOCS)).collect()
    assert one[0]["next_signature"] == one[0]["signature"]
    assert fingerprints.compare_edited(spark.createDataFrame([], DOCS)).collect() == []


@pytest.mark.parametrize("name", ["op7_weighted_fingerprints", "op8_url_rules"])
def test_native_operators_run_no_python(spark, name):
    from cellwright.llm.queries import QUERIES

    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Arrow", "Pandas", "CartesianProduct", "BroadcastNestedLoop"))
