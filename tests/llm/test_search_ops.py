"""Decontamination, SimHash groups and components against brute force."""

import random
import re
from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import functions as F

from cellwright.llm import decontam, graphs, simhash
from cellwright.llm.textbytes import shingles, text_bytes, text_slices, word_hashes, word_spans

DOCS = "doc_id long, text string"


def plain_shingles(text, size=5):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[0-9a-z\x80-\U0010ffff]+", low)
    if not words:
        return set()
    return {" ".join(words[i : i + size]) for i in range(max(len(words) - size + 1, 1))}


def brute_contained(docs, items):
    by = {}
    for d, t in docs:
        by.setdefault(d, set()).update(plain_shingles(t))
    out = {}
    for i, t in items:
        need = plain_shingles(t)
        for d, have in by.items():
            if need and len(need & have) >= 0.8 * len(need) - 1e-9:
                out[d, i] = (len(need), len(need & have))
    return out


def test_contained_items_match_brute_force(spark):
    rng = random.Random(1)
    word = lambda: rng.choice(["Alpha", "beta", "é", "the", "x1", "of"]) + str(rng.randint(0, 40))
    items = [(i, " ".join(word() for _ in range(rng.choice([1, 3, 4, 5, 9, 20, 60])))) for i in range(30)]
    items += [(90, None), (91, " .,! "), (92, items[5][1])]
    docs = []
    for d in range(150):
        words = [word() for _ in range(rng.randint(0, 300))]
        if rng.random() < 0.6:
            own = rng.choice(items)[1] or ""
            own = own.split()
            for k in range(len(own)):
                if rng.random() < 0.03:
                    own[k] = "changed"
            at = rng.randint(0, len(words))
            words[at:at] = own
        docs.append((d, rng.choice([" ", ",\n", "! "]).join(words).upper() if d % 9 == 0 else " ".join(words)))
    # shingles of an item apart from each other, in a very long document, and over two rows of one id
    long = items[29][1].split()
    pieces = [" ".join(long[i : i + 5]) for i in range(max(len(long) - 4, 1))]
    docs += [(200, " filler ".join(pieces) + " pad" * 30_000), (201, None), (202, ""), (203, items[3][1])]
    docs += [(204, " filler ".join(pieces[::2])), (204, " filler ".join(pieces[1::2])), (None, items[20][1])]
    # two rows of one id, each with fewer shingles than the item needs
    items += [(93, " ".join(f"half{i}" for i in range(24)))]
    docs += [(205, " ".join(f"half{i}" for i in range(14))), (205, " ".join(f"half{i}" for i in range(10, 24)))]
    df = spark.createDataFrame([(*d, "x") for d in docs], DOCS + ", shingle string")
    it = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): (r["n_shingles"], r["n_found"]) for r in decontam.find_contained(df, it).collect()}
    assert got == brute_contained(docs, items) and len(got) > 40
    kept = decontam.drop_contaminated(df, it).collect()
    bad = {d for d, _ in got if d is not None}
    assert (205, 93) in got
    # the row without an id holds an item, too
    assert sorted(r["doc_id"] for r in kept) == sorted(d for d, _ in docs if d is not None and d not in bad)
    assert kept[0].asDict().keys() == {"doc_id", "text", "shingle"}
    assert decontam.find_contained(df.where("false"), it).collect() == []
    assert decontam.find_contained(df, it.where("false")).collect() == []


def test_words_over_slices(spark):
    import pyarrow as pa

    texts = ["ab cd", None, "", "é1!é2", " x ", "ab cd"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    assert sum(p.num_rows for p in text_slices([batch], limit=4)) == len(texts)
    buf, offsets = text_bytes(batch.column(0))
    starts, ends, doc = word_spans(buf, offsets)
    assert [bytes(buf[s:e]).decode() for s, e in zip(starts, ends)] == ["ab", "cd", "é1", "é2", "x", "ab", "cd"]
    assert doc.tolist() == [0, 0, 3, 3, 4, 5, 5]
    h = word_hashes(buf, starts, ends)
    assert h[0] == h[5] and h[1] == h[6] and len(set(h.tolist())) == 5
    s, at, n = shingles(h, doc, 5)
    assert sorted(zip(at.tolist(), n.tolist())) == [(0, 2), (2, 2), (4, 1), (5, 2)]


# ------------------------------------------------------------------ SimHash
def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0d]+", low)
    if not words:
        return 0
    hashes = [xxhash.xxh64(" ".join(words[i : i + 3]).encode(), seed=42).intdigest() for i in range(max(len(words) - 2, 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints):
    """doc -> smallest id, by comparing all pairs of (doc, fingerprint) rows."""
    parent = {}

    def top(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for d, f in prints:
        top(("d", d)), top(("f", f))
        parent[max(top(("d", d)), top(("f", f)))] = min(top(("d", d)), top(("f", f)))
    for a, b in combinations(sorted({f for _, f in prints}), 2):
        if (a ^ b).bit_count() <= 3:
            parent[max(top(("f", a)), top(("f", b)))] = min(top(("f", a)), top(("f", b)))
    return {d: top(("d", d))[1] for d, _ in prints}


def test_fingerprints_follow_the_definition(spark):
    texts = [None, "", " \t\n", "One", "one two", "One TWO three", "É é \u00a0 x y", "a b c d e f g " * 3, "w " * 70_000]
    got = {r["doc_id"]: r["fp"] & (1 << 64) - 1 for r in simhash.fingerprints(spark.createDataFrame(list(enumerate(texts)), DOCS)).collect()}
    assert got == {i: plain_fingerprint(t) for i, t in enumerate(texts)}
    # the same hash as the engine's own function
    one = spark.createDataFrame([("one two three",)], "t string").select(F.xxhash64("t")).first()[0]
    assert one & (1 << 64) - 1 == xxhash.xxh64(b"one two three", seed=42).intdigest()


def test_anchors_bring_every_near_pair_together():
    rng = np.random.default_rng(2)
    for extra in (0, 2, 5):
        base = rng.integers(0, 1 << 63, 200, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, 200).astype(np.uint64)
        near = base.copy()
        for _ in range(3):
            near ^= np.uint64(1) << rng.integers(0, 64, 200).astype(np.uint64)
        fps = np.concatenate([base, near])
        home, all_ = {}, {}
        for rows, anchors, own in simhash.anchors_of(fps, extra):
            for r, a, h in zip(rows.tolist(), anchors.tolist(), own.tolist()):
                all_.setdefault(r, set()).add(a)
                if h:
                    home[r] = a
        assert len(home) == 400
        for i in range(200):
            assert home[i] in all_[i + 200] or home[i + 200] in all_[i]
        # no fingerprint is farther from the code than its covering radius
        cosets, linear = simhash._code(extra)
        sums = np.abs(((simhash._signs(fps)[:, None, :] * cosets[None]) @ linear)).max(axis=(1, 2))
        assert (64 - sums.min()) / 2 <= 28


def test_links_of_random_and_dense_fingerprints(spark):
    rng = np.random.default_rng(4)
    centre = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    prints = [int(c) for c in centre]
    for c in centre[:40]:
        f = int(c)
        for _ in range(int(rng.integers(1, 6))):
            for _ in range(int(rng.integers(1, 5))):
                f ^= 1 << int(rng.integers(0, 64))
            prints.append(f)
    dense = int(rng.integers(0, 1 << 62))
    prints += [dense ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 64, (250, 2))]
    prints = sorted(set(prints))
    signed = [(p - (1 << 64) if p >> 63 else p) for p in prints]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(signed)], "node long, fp long")
    for block in (4096, 32):  # small blocks cut the dense anchor into many groups
        links = simhash.link_classes(df, block=block)
        roots = {r["node"]: r["root"] for r in graphs.components(links).collect()}
        brute = brute_groups(list(enumerate(prints)))
        assert {i: roots.get(i, i) for i in range(len(prints))} == brute


def test_groups_of_texts(spark):
    rng = random.Random(8)
    base = [" ".join(f"w{rng.randint(0, 5000)}" for _ in range(150)) for _ in range(30)]
    docs = [(i, t) for i, t in enumerate(base)]
    for i, t in enumerate(base[:20]):
        words = t.split()
        words[rng.randint(0, 149)] = "other"
        docs += [(100 + i, " ".join(words)), (200 + i, t)]
    docs += [(300, None), (301, ""), (302, " "), (303, "word"), (303, base[0]), (None, base[1]), (None, "lonely text")]
    out = simhash.near_duplicates(spark.createDataFrame([(*d, 0) for d in docs], DOCS + ", fp int")).collect()
    assert len(out) == len(docs)
    named = [(d, plain_fingerprint(t)) for d, t in docs if d is not None]
    brute = brute_groups(named)
    for r in out:
        if r["doc_id"] is not None:
            assert r["component_id"] == brute[r["doc_id"]]
    assert sorted((r["component_id"] is None, r["component_id"] or 0) for r in out if r["doc_id"] is None) == [(False, 1), (True, 0)]
    kept = simhash.drop_duplicates(spark.createDataFrame(docs, DOCS)).collect()
    assert sorted(r["doc_id"] for r in kept if r["doc_id"] is not None) == sorted(d for d, _ in named if brute[d] == d)
    assert simhash.near_duplicates(spark.createDataFrame([], DOCS)).collect() == []


def test_components_of_a_long_chain(spark):
    n = 400
    order = list(range(n))
    random.Random(1).shuffle(order)
    links = [(order[i], order[i + 1]) for i in range(n - 1)] + [(1000, 1001), (1001, 1000), (7, 7)]
    roots = {r["node"]: r["root"] for r in graphs.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert roots == {i: 0 for i in range(n)} | {1000: 1000, 1001: 1000}
    assert graphs.components(spark.createDataFrame([], "a long, b long")).collect() == []
