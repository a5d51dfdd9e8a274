"""Packing and token counts against the tokenizer library."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellwright.llm import packing, tokencount
from cellwright.llm.queries import QUERIES, tokenizer_path

DOCS = "doc_id long, text string"
HARD = [
    None, "", " ", "\n\n\t  x", "don't I'll WE'VE 'tis '''s s's \n's !'s", "  two  spaces   end   ", "a b c\u0085d e",
    "x\x1cy\x1d \x1ez", "<|endoftext|>", "a<|endoftext|> b<|endoftext|><|endoftext|>", "<|startoftext|>hi", "É é é İ ß Σς",
    "漢字かな交じり文 한국어", "😀😀👩‍👩‍👧 x", "12345 6.7e-9 ٣٤", "!!!???--- ... ''' \"\"\"", "\\### </turn>", "a" * 5000, "word " * 9000,
    "=" * 300 + " " * 300 + "\n" * 40, "nowhitespaceatall,andpunctuation;" * 200, "é" * 50, "\u0000\u0001 ﻿x", "ab\r\ncd\r\n",
]


def library(name):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path(name))


def random_texts(n, seed):
    rng = random.Random(seed)
    bits = ["the", "ing", " ", "  ", "\n", "'s", "'", "é", "ß", "漢", "1", "23", "!", "?!", "THE", "on", "tion", "<|endoftext|>", " ", "_", "x"]
    return ["".join(rng.choice(bits) for _ in range(rng.randint(0, 60))) for _ in range(n)]


# ------------------------------------------------------------------ token counts
@pytest.mark.parametrize("chunk", [1 << 14, 64, 7, 1])
def test_counts_equal_the_library(chunk):
    lib, own = library("byte_bpe_50k.json"), tokencount.Counter(tokenizer_path("byte_bpe_50k.json"), chunk)
    texts = [t or "" for t in HARD] + random_texts(400, 1)
    if chunk < 100:
        texts = [t[:3000] for t in texts]
    for t in texts:
        assert own.count(t) == len(lib.encode(t, add_special_tokens=False).ids), t[:80]


def test_machine_counts_every_prefix_of_a_piece():
    machine = tokencount.Transducer(tokenizer_path("byte_bpe_50k.json"))
    for word in [b" thoughtfulness", b"Donaudampfschifffahrt", b"ofthheesndtionouble", "ñciónmente".encode(), b"-" * 70, b"\xf0\x9f\x98\x80\xf0\x9f"]:
        for n in range(1, len(word) + 1):
            assert machine.count(word[:n]) == len(machine.merge(word[:n]))


def test_dead_places_are_not_looked_up():
    """Once no token starts at a place with the bytes from it, longer ones are not tried."""
    class Seen(dict):
        asked = 0

        def get(self, key, default=None):
            Seen.asked += 1
            return super().get(key, default)

    machine = tokencount.Transducer(tokenizer_path("byte_bpe_50k.json"))
    machine.kinds = Seen(machine.kinds)
    word, steps = b" thoqxzthoqxzthoqxzj", 0
    state = machine.start
    for byte in word:
        steps += 0 if byte in state else sum(x is not False for x in state.lasts)
        state, _ = state[byte]
    assert Seen.asked == steps and machine.count(word) == len(machine.merge(word))


def test_runs_of_letters_and_a_mark_count_as_the_library():
    lib, own = library("byte_bpe_50k.json"), tokencount.Counter(tokenizer_path("byte_bpe_50k.json"))
    rng = random.Random(12)
    ends = [*".,;:!?'\"-)", "", "..", "?!", "'s", ".a", "é", "é.", "1", "1.", "²", "ª,", "\u0085", "ﬁ;", "Ⅷ"]
    for _ in range(300):
        word = lambda: "".join(rng.choice("etaoinshrdluTHéß") for _ in range(rng.randint(0, 9))) + rng.choice(ends)
        text = " ".join(word() for _ in range(6))
        assert own.count(text) == len(lib.encode(text, add_special_tokens=False).ids), text


def test_flushed_states_count_the_same():
    machine = tokencount.Transducer(tokenizer_path("byte_bpe_50k.json"))
    before = machine.count(b"unbelievableness")
    machine.flush()
    assert machine.count(b"unbelievableness") == before


def test_composition_is_associative():
    own = tokencount.Counter(tokenizer_path("byte_bpe_50k.json"), 16)
    rng = random.Random(6)
    for t in random_texts(60, 9):
        cuts = sorted(rng.randint(0, len(t)) for _ in range(2))
        a, b, c = (own.map_of(x) for x in (t[: cuts[0]], t[cuts[0] : cuts[1]], t[cuts[1] :]))
        assert own.compose(own.compose(a, b), c) == own.compose(a, own.compose(b, c))


def test_counts_of_rows(spark):
    rows = [(i, t) for i, t in enumerate(HARD)] + [(None, "x"), (1, ""), (1, "")]
    out = tokencount.count_tokens(spark.createDataFrame([(*r, 5) for r in rows], DOCS + ", n_tokens int"), tokenizer_path("byte_bpe_50k.json")).collect()
    lib = library("byte_bpe_50k.json")
    want = [(d, len((t or "").encode()), len(lib.encode(t or "", add_special_tokens=False).ids)) for d, t in rows]
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    assert sorted(map(tuple, out), key=key) == sorted(want, key=key)
    assert tokencount.count_tokens(spark.createDataFrame([], DOCS), tokenizer_path("byte_bpe_50k.json")).collect() == []


# ------------------------------------------------------------------ packing
def check_packed(pieces, want):
    """Every id of every document in exactly one piece; sequences without gaps; little padding."""
    sequences, docs = {}, {}
    for p in pieces:
        assert len(p["ids"]) == 4 * p["length"] > 0
        sequences.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
        docs.setdefault(p["doc_id"], []).append((p["start"], p["ids"], p["doc_tokens"]))
    padding = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
        padding += 0 if at & (at - 1) == 0 else 4096 - at
    assert padding == 0
    for doc, ids in want.items():
        got = b"".join(x[1] for x in sorted(docs[doc]))
        assert np.frombuffer(got, "<u4").tolist() == ids and {x[2] for x in docs[doc]} == {len(ids)}
        at = 0
        for start, part, _ in sorted(docs[doc]):
            assert start == at
            at += len(part) // 4
    assert set(docs) == set(want)


def test_packed_ids_are_the_librarys(spark):
    lib = library("word_bpe_49k.json")
    texts = HARD + random_texts(300, 2) + ["long text here " * 6000]
    df = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], DOCS + ", offset int")
    out = packing.pack_documents(df, tokenizer_path("word_bpe_49k.json")).collect()
    check_packed(out, {i: lib.encode(t or "", add_special_tokens=False).ids + [2] for i, t in enumerate(texts)})
    assert packing.pack_documents(df.where("false"), tokenizer_path("word_bpe_49k.json")).collect() == []
    twice = packing.pack_documents(spark.createDataFrame([(None, "x"), (None, "x")], DOCS), tokenizer_path("word_bpe_49k.json")).collect()
    assert sum(p["length"] for p in twice) == 4


def brute_level(counts, size, window):
    def after(h):
        c = counts.copy()
        if h:
            c[h] -= 1
        if h + size < window:
            c[h + size] += 1
        return int((c[1:window] ** 2).sum())

    options = [h for h in range(1, window - size + 1) if counts[h]] + [0]
    low = min(map(after, options))
    return max(h for h in options if after(h) == low)


def test_level_minimises_the_sum_of_squares():
    rng = np.random.default_rng(3)
    for _ in range(300):
        packer = packing.Packer(0, window=24)
        packer.counts[1:24] = rng.integers(0, 4, 23) * (rng.random(23) < 0.4)
        size = int(rng.integers(1, 24))
        assert packer.best_level(size) == brute_level(packer.counts, size, 24)


@pytest.mark.parametrize("sizes", [[13] * 500, [24] * 5, [1] * 100, [23, 2] * 200, [7, 100, 3, 3, 50]])
def test_any_sizes_pack_without_padding(sizes):
    packer = packing.Packer(10, window=24)
    for d, n in enumerate(sizes):
        packer.add(d, np.arange(n, dtype="<u4").tobytes())
    packer.close()
    fill, got = {}, {}
    for doc, start, ids, sequence, offset in packer.done:
        assert offset == fill.get(sequence, 0)
        fill[sequence] = offset + len(ids) // 4
        got.setdefault(doc, []).append((start, ids))
    assert all(f == 24 or f & (f - 1) == 0 for f in fill.values())
    for d, n in enumerate(sizes):
        assert np.frombuffer(b"".join(x[1] for x in sorted(got[d])), "<u4").tolist() == list(range(n))


def test_packed_query_on_documents(spark):
    out = QUERIES["op9_packed_sequences"](spark, "/root/testdata/sf0.001")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    lib = library("word_bpe_49k.json")
    import zlib

    ids = {r["doc_id"]: np.array(lib.encode(r["text"] or "", add_special_tokens=False).ids + [2], "<u4") for r in docs}
    rows = out.collect()
    assert sum(r["length"] for r in rows) == sum(map(len, ids.values()))
    for r in rows:
        assert r["ids_crc32"] == zlib.crc32(ids[r["doc_id"]][r["start"] : r["start"] + r["length"]].tobytes())
    assert out.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 4096").count() == 0


def test_words_seen_before_are_not_split_again():
    own = tokencount.Counter(tokenizer_path("byte_bpe_50k.json"))
    lib, split = library("byte_bpe_50k.json"), own.pieces
    text = "it's a word, and it's (the) same\n\nword " * 500
    assert own.count(text) == len(lib.encode(text, add_special_tokens=False).ids)
    seen = []
    own.pieces = lambda t: seen.append(len(t)) or split(t)
    assert own.count(text) == len(lib.encode(text, add_special_tokens=False).ids)
    assert sum(seen) < 100  # each word was taken apart anew before


def test_white_space_after_white_space_is_counted_with_what_follows():
    own, lib = tokencount.Counter(tokenizer_path("byte_bpe_50k.json")), library("byte_bpe_50k.json")
    rng = random.Random(4)
    bits = [" ", " ", " ", "\n", "\t", "\u0085", "　", "\x1c", "​", "a", "word,", "it's", "7"]
    for _ in range(2000):
        t = "".join(rng.choice(bits) for _ in range(rng.randint(0, 25)))
        assert own.count(t) == len(lib.encode(t, add_special_tokens=False).ids), repr(t)


def test_border_of_two_tokens_by_halves_equals_merging():
    machine = tokencount.Transducer(tokenizer_path("byte_bpe_50k.json"))
    assert machine.ordered
    rng = random.Random(8)
    tokens = sorted(machine.tokens)
    texts = [t.encode() for t in random_texts(300, 5)] + [b"a" * 40, b"-" * 70, b" " * 50]
    near = [t for text in texts for t in machine.merge(text)]
    pairs = [(rng.choice(near), rng.choice(near)) for _ in range(4000)] + [(rng.choice(tokens), rng.choice(tokens)) for _ in range(2000)]
    # a token cut in two at any place: the border that merging goes over
    pairs += [(t[:n], t[n:]) for t in rng.sample(tokens, 1500) for n in range(1, len(t)) if {t[:n], t[n:]} <= machine.tokens]
    pairs += [(b"a" * i, b"a" * j) for i in range(1, 9) for j in range(1, 9) if {b"a" * i, b"a" * j} <= machine.tokens]
    for a, b in pairs:
        if machine.stays(None, a):
            assert machine.stays(a, b) == (machine.merge(a + b) == [a, b]), (a, b)
