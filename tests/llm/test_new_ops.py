"""Hard negatives, spelling variants and repeated strings against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellwright.llm import negatives, spelling, suffixes
from cellwright.llm.queries import QUERIES

DOCS = "doc_id long, text string"


# ------------------------------------------------------------------ 13 repeated strings
def covered(texts, length):
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        out.append(gone)
    return out


def plain_removal(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    out = []
    for (key, _), t, gone in zip(rows, texts, covered(texts, length)):
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((key, len(t), sum(gone), len(re.findall(b"\x01+", bytes(gone))), kept))
    return sorted(out, key=repr)


def removal(spark, rows, length, **options):
    out = suffixes.remove_repeats(spark.createDataFrame(rows, DOCS), length=length, **options)
    return sorted([(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in out.collect()], key=repr)


@pytest.mark.parametrize("alphabet", [1, 2, 3, 7, 300])
def test_suffix_order(alphabet):
    rng = random.Random(alphabet)
    for _ in range(300):
        s = [rng.randint(1, alphabet) for _ in range(rng.randint(0, 40))] + [0]
        assert suffixes.lyndon_suffix_array(s) == sorted(range(len(s)), key=lambda i: s[i:])


@pytest.mark.parametrize("seed", range(5))
def test_repeated_starts(seed):
    rng = random.Random(seed)
    for _ in range(60):
        length = rng.choice([5, 12, 20])
        alphabet = rng.choice([b"ab ", b"a", b"ab cd.", bytes([200, 201, 32, 97])])
        base = bytes(rng.choice(alphabet) for _ in range(60))
        pieces, owns = [], []
        for _ in range(rng.randint(1, 6)):
            at = rng.randint(0, 20)
            piece = bytearray(base[at : at + rng.randint(length, 40)] + bytes(rng.choice(alphabet) for _ in range(length)))
            if rng.random() < 0.5:
                piece[rng.randrange(len(piece))] = rng.choice(alphabet)
            pieces.append(bytes(piece))
            owns.append(rng.randint(1, len(piece) - length + 1))
        seen = Counter(p[i : i + length] for p, o in zip(pieces, owns) for i in range(o))
        for p, o, hit in zip(pieces, owns, suffixes.repeated_starts(pieces, owns, length)):
            assert [seen[p[i : i + length]] > 1 for i in range(o)] == hit.tolist()


def repeat_texts(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    sentence = lambda n: " ".join(rng.choice(words) for _ in range(n))
    shared = [sentence(20) for _ in range(4)]
    rows = [(1, None), (2, ""), (3, "short"), (None, sentence(30)), (4, "a" * 700), (5, "ab" * 300), (6, "é" * 200 + " x"), (7, "." * 333)]
    for i in range(10, 40):
        parts = [sentence(rng.randint(0, 12)) for _ in range(3)]
        rows.append((i, rng.choice(shared).join(parts)))
    rows += [rows[12], rows[12], (99, rows[13][1]), (None, rows[14][1])]
    # a line in many surroundings, and the same cut at its edges
    rows += [(200 + i, sentence(3) + shared[0] + sentence(3)) for i in range(20)]
    rows += [(300 + i, shared[1][i:] + str(i)) for i in range(20)]
    return rows


@pytest.mark.parametrize("length,options", [(60, {"gram": 20}), (60, {"gram": 20, "group": 400, "bucket": 100}), (48, {"gram": 16, "group": 1}), (40, {"gram": 40})])
def test_removal_equals_brute_force(spark, length, options):
    rows = repeat_texts(length)
    assert removal(spark, rows, length, **options) == plain_removal(rows, length)


def test_removal_in_blocks(spark, monkeypatch):
    rows = repeat_texts(3)
    monkeypatch.setattr(suffixes, "BLOCK", 100)
    segments = suffixes.window_segments(np.frombuffer(rows[20][1].encode(), np.uint8), np.array([0, len(rows[20][1].encode())]), 60, 20)
    assert segments[1].sum() == len(rows[20][1].encode()) - 59
    assert removal(spark, rows, 60, gram=20) == plain_removal(rows, 60)


def test_removal_of_empty_tables_and_other_columns(spark):
    assert removal(spark, [], 50, gram=10) == []
    docs = spark.createDataFrame([(1, "x" * 90, "a", {"k": 1}), (2, "y" * 90, None, None)], "row long, body string, kept string, n map<string,int>")
    out = suffixes.remove_repeats(docs, "body", 50, 10)
    assert out.columns == ["row", "body", "n", "n_bytes", "n_removed", "n_spans", "kept"]
    assert [(r.row, r.n_removed, r.n) for r in out.orderBy("row").collect()] == [(1, 90, {"k": 1}), (2, 90, None)]


def test_repeated_strings_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    want = [(k, n, gone, spans, hashlib.sha256(kept).hexdigest()) for k, n, gone, spans, kept in plain_removal(rows, 400)]
    got = QUERIES["op13_repeated_strings"](spark, folder).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert sorted(map(tuple, got)) == sorted(want)
    assert sum(w[2] for w in want) > 0


# ------------------------------------------------------------------ 12 spelling variants
def plain_words(rows, damage=None, shortest=6, least=5):
    total = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if c.isascii() else c for c in run)
            if damage:
                h = zlib.crc32(f"{'' if key is None else key}:{word}".encode())
                if h % damage == 0:
                    at = h % len(word)
                    word = word[:at] + word[at + 1 :]
            total[word] += 1
    return {w: n for w, n in total.items() if len(w) >= shortest and n >= least}


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain_variants(words, ratio=5):
    near = {w: [u for u in words if abs(len(u) - len(w)) < 2 and one_edit(u, w)] for w in words}
    form = {}
    for w, some in near.items():
        best = min(some, key=lambda u: (-words[u], u), default=None)
        form[w] = best if best and words[best] >= ratio * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out)


def variants(spark, words, **options):
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    out = spelling.group_variants(df, **options)
    return sorted(tuple(r) for r in out.select("word", "form", "root", "n", "n_near", "form_n").collect())


def test_variants_equal_brute_force(spark):
    rng = random.Random(4)
    stems = ["kitten", "aaaaaa", "straße", "banana", "ababab", "écoles"]
    words = {}
    for _ in range(250):
        w = rng.choice(stems) + rng.choice(["", "s", "er", "aa"])
        for _ in range(rng.randint(0, 2)):
            at = rng.randrange(len(w))
            w = w[:at] + rng.choice(["", "a", "b", "é", w[at] * 2]) + w[at + 1 :]
        words[w] = 5 ** rng.randint(1, 6) + rng.randint(0, 2)
    for at in range(40):
        long = "ab" * 20 + "c" * 25
        words[long[:at] + rng.choice(["", "a", "z", "c"]) + long[at + 1 :]] = 10 ** rng.randint(1, 4)
    words["q" * 300] = words["q" * 299 + "r"] = words["q" * 301] = 7
    words["q" * 302] = 100
    want = plain_variants(words)
    assert variants(spark, words) == want
    assert variants(spark, words, longest=6) == want
    assert any(w[1] and w[2] != w[1] for w in want)


def test_counting_words(spark, monkeypatch):
    rng = random.Random(1)
    bits = ["Étude", "étude", "kitten", "KITTEN", "sittin", "x", "naïveté", "×÷×÷×÷", "straße", "ǅungla", "abcdef1ghijkl", "don't", "ﬁnesse"]
    rows = [(rng.choice([None, 1, 2, 3]), " ".join(rng.choice(bits) for _ in range(30))) for _ in range(40)]
    rows += [(1, None), (2, ""), (4, "kitten" * 50), (4, "kitten" * 50)] * 3
    for part in (1 << 20, 7):
        monkeypatch.setattr(spelling, "PART", part)
        got = spelling.count_words(spark.createDataFrame(rows, DOCS), damage=3)
        assert {r.word: r.n for r in got.collect()} == plain_words(rows, 3)
    assert list(spelling._parts("ab cdefghijk l", re.compile("[a-z]"))) == ["ab cdefghijk", " l"]
    assert variants(spark, {"lonely": 9}) == [("lonely", None, "lonely", 9, 0, None)]
    empty = spelling.count_words(spark.createDataFrame([], DOCS))
    assert spelling.group_variants(empty).collect() == []


def test_spelling_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op12_spelling_variants"](spark, folder).select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert sorted(map(tuple, got)) == plain_variants(plain_words(rows, 199))


# ------------------------------------------------------------------ 11 hard negatives
VECTORS = "vec_id long, embedding array<float>, label int"


def plain_mining(rows, is_anchor, positives=5, negatives_=10):
    fit = {}
    for key, x, label in rows:
        if key is None or label is None or x is None or any(v is None or not np.isfinite(v) for v in x):
            continue
        q = [int(np.floor(256 * float(np.float32(v)))) for v in x]
        fit[key] = min(fit.get(key, (label, q)), (label, q))
    score = lambda a, b: sum(u * v for u, v in zip(fit[a][1], fit[b][1]))
    out = []
    for a in fit:
        if not is_anchor(a):
            continue
        scored = [(score(a, b), b) for b in fit if b != a]
        same = sorted([(-s, b) for s, b in scored if fit[b][0] == fit[a][0]])[:positives]
        for p, pid in same:
            p = -p
            hits = sorted((-s, b) for s, b in scored if fit[b][0] != fit[a][0] and 30 * p <= 100 * s <= 90 * p)
            out += [(a, pid, k, b, p, -s) for k, (s, b) in enumerate(hits[:negatives_], 1)]
    return sorted(out)


def mining(spark, rows, **options):
    found = negatives.mine_negatives(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 10 == 0, **options)
    return sorted(tuple(r) for r in found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def mining_rows(seed):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(300):
        centre = np.eye(6)[i % 3] * (3 if seed % 2 else 0.2)
        x = (centre + rng.normal(size=6) * 0.3).round(1)
        rows.append((i, [float(v) for v in x], int(i % 4)))
    rows += [rows[7], rows[7], (8, [9.0] * 6, 0), (400, None, 1), (410, [1.0, None], 1), (420, [1.0, float("nan")], 1), (430, [float("inf")], 2),
             (440, [], 1), (450, [0.0] * 6, 2), (460, [1.0, 2.0], 3), (470, [1.0] * 6, None), (None, [1.0] * 6, 1)]
    rows += [(500 + i, [1.0, 1.0, 0.0, 0.0, 0.0, 0.0], int(i % 2)) for i in range(40)]
    return rows


@pytest.mark.parametrize("seed,options", [(0, {}), (1, {"small": 16, "group": 16}), (2, {"small": 64, "group": 64})])
def test_mining_equals_brute_force(spark, seed, options):
    rows = mining_rows(seed)
    assert mining(spark, rows, **options) == plain_mining(rows, lambda a: a % 10 == 0)


def test_mining_with_several_copies_of_groups(spark, monkeypatch):
    monkeypatch.setattr(negatives, "ANCHORS", 7)
    monkeypatch.setattr(negatives, "SAMPLE", 5)
    rows = mining_rows(5)
    assert mining(spark, rows, small=32, group=32) == plain_mining(rows, lambda a: a % 10 == 0)


def test_score_bounds_hold_and_leave_out():
    rng = np.random.default_rng(3)
    q = np.concatenate([rng.integers(-300, 300, (200, 8)), np.zeros((1, 8), int), [[1, 0, 0, 0, 0, 0, 0, 0]] * 3])
    centres = rng.integers(-300, 300, (5, 8))
    q = np.concatenate([q, centres[rng.integers(0, 5, 400)] + rng.integers(-5, 5, (400, 8))])
    directions = negatives.references(q, 12)
    norms, angles = negatives.norms_and_angles(q, directions)
    out = 0
    for i in range(len(q)):
        low, high = negatives.score_bounds(norms[i], angles[i], norms, angles)
        scores = q @ q[i]
        assert (low <= scores).all() and (scores <= high).all()
        out += (high < 0.8 * norms[i] * norms).sum()
    assert out > 0.1 * len(q) ** 2


def test_mining_of_nothing(spark):
    assert mining(spark, []) == []
    assert mining(spark, [(0, [1.0], 1), (10, [1.0], 2)]) == []
    with pytest.raises(Exception, match="2\\^52"):
        mining(spark, [(0, [1e30], 1), (1, [1.0], 1)])
