"""Words of a corpus and the more frequent words they are one edit away from.

``count_words`` counts the words of all texts; ``near_words`` finds every pair of
words that differ by one inserted, deleted or replaced code point;
``group_variants`` turns them into forms and roots.

Near words are found by walking all words through a trie of themselves. The trie
is a distributed table of edges (node, symbol, child), a node being named by its
prefix. A state is (word, position, node, edits). Each round joins all states with the
edges and goes one level down: a state without edit follows its own symbol, or
spends its edit on another symbol, an inserted one or a left out one; a state with
an edit can only follow its word. A word's state that ends on a node where a
word ends, with one edit, is a pair of neighbours. Rounds are stored, and there are as
many as the longest word has code points.

Near the root a node has very many words below it, and an edit there leads into all of them. So
words are walked twice, from their begins and from their ends, and spend their edit in the half
they come to last. Each edge has a summary of the words below it (64 bits of their last symbols and
lengths), and a state with an edit stops where no word below can end as its own does.

The first two levels have few nodes and all the words, so their edges are copied to
``SPREAD`` keys and the states dealt over them. Words of more than ``LONGEST`` code
points do not go through the trie (a text without a blank would take a round for each
of its letters): they are matched by hashes of themselves with one code point
left out, and each match is verified. The result is the same.

Defined results: null text has no words, a null id counts as empty text in the damage hash; a word
is counted at each of its occurrences, repeated rows included; ties between forms go
to the smaller word in code-point order; an empty table has no words. Other columns of the
input are not looked at.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import store

LETTERS = "a-zÀ-ÿ"
#: words of this many code points go through the trie, longer ones are matched by hashes
LONGEST = 64
#: keys that an edge near the root is copied to
SPREAD = 64
#: words, and code points of words, that a task counts before it hands them on
HELD_WORDS = 200_000
HELD_CHARS = 8_000_000
#: code points of a text looked at together
PART = 1 << 20


# ------------------------------------------------------------------ counting
def _parts(text: str, inside: re.Pattern) -> Iterator[str]:
    """The text in parts of about ``PART`` code points that cut no word."""
    low = 0
    while low < len(text):
        high = low + PART
        while high < len(text) and inside.match(text, high):
            high += 1
        yield text[low:high]
        low = high


def _word_rows(shortest: int, damage: int | None):
    def rows(total):
        return pa.RecordBatch.from_pydict({"word": pa.array(list(total), pa.string()), "n": pa.array(list(total.values()), pa.int64())})

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, inside = re.compile(f"[{LETTERS}]{{{shortest},}}"), re.compile(f"[{LETTERS}]")
        total: dict[str, int] = {}
        chars = 0
        for batch in batches:
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist()):
                if not text:
                    continue
                seed = zlib.crc32(f"{key or ''}:".encode())
                text = text.encode().lower().decode()  # bytes lower only A-Z
                for part in (text,) if len(text) <= PART else _parts(text, inside):
                    for word, n in Counter(words.findall(part)).items():
                        if damage is not None:
                            h = zlib.crc32(word.encode(), seed)
                            if h % damage == 0:
                                at = h % len(word)
                                word = word[:at] + word[at + 1 :]
                                if len(word) < shortest:
                                    continue
                        had = total.get(word)
                        if had is None:
                            chars += len(word)
                            total[word] = n
                        else:
                            total[word] = had + n
                    if len(total) > HELD_WORDS or chars > HELD_CHARS:
                        yield rows(total)
                        total, chars = {}, 0
        if total:
            yield rows(total)

    return run


def count_words(
    docs: DataFrame, text: str = "text", key: str = "doc_id", shortest: int = 6, least: int = 5, damage: int | None = None
) -> DataFrame:
    """word, n: words of at least ``shortest`` code points that occur at least ``least`` times.

    With ``damage`` each word whose hash with its document's id it divides has lost one code point.
    """
    given = docs.select(F.col(key).cast("string").alias("key"), F.col(text).cast("string").alias("text"))
    counted = given.mapInArrow(_word_rows(shortest, damage), "word string, n long")
    return store(counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least), "words")


# ------------------------------------------------------------------ neighbours through the trie
def _spread(node: Column, word: Column) -> Column:
    return F.when(F.length(node) <= 1, F.pmod(F.xxhash64(word), F.lit(SPREAD)).cast("int")).otherwise(F.lit(0))


def _ending(word: Column, left: Column) -> Column:
    """One bit of 64 for the last three symbols of a word and how many of its symbols are left."""
    at = F.pmod(F.xxhash64(F.right(word, F.lit(3)), left.cast("int")), F.lit(64)).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), at)


def trie_edges(words: DataFrame) -> DataFrame:
    """node, symbol, child, ends (a word ends at the child), below, part: the edges of the trie of ``words``.

    ``below`` has the bits (``_ending``) of all words that go through the edge.
    """
    steps = words.select("word", F.explode(F.sequence(F.lit(1), F.length("word"))).alias("i"))
    edges = steps.groupBy(
        F.substring("word", F.lit(1), F.col("i") - 1).alias("node"), F.substring("word", F.col("i"), F.lit(1)).alias("symbol")
    ).agg(
        F.max(F.col("i") == F.length("word")).alias("ends"), F.bit_or(_ending(F.col("word"), F.length("word") - F.col("i"))).alias("below")
    )
    copies = F.when(F.length("node") <= 1, F.sequence(F.lit(0), F.lit(SPREAD - 1))).otherwise(F.array(F.lit(0)))
    return edges.select("node", "symbol", F.concat("node", "symbol").alias("child"), "ends", "below", F.explode(copies).alias("part"))


def _walk(words: DataFrame, backwards: bool) -> DataFrame:
    """word, near: pairs one edit apart whose edit lies in the second half of ``word``, or in the first half if
    ``backwards``, by one join with the edges for each level. Backwards both are walked from their ends."""
    if backwards:
        words = words.select(F.reverse("word").alias("word"))
    edges = store(trie_edges(words), "edges").withColumnRenamed("ends", "_ends")
    states = words.select("word", F.lit(0).alias("pos"), F.lit("").alias("node"), F.lit(0).alias("edits"), F.lit(False).alias("ends"))
    half = F.floor(F.length("word") / 2).cast("int")
    first = F.length("word") - half if backwards else half
    at_end = F.col("pos") == F.length("word")
    own = F.substring("word", F.col("pos") + 1, F.lit(1))
    step, child, ends = F.col("pos") + 1, F.col("child"), F.col("_ends")
    open_ = (F.col("edits") == 0) & (F.col("pos") >= first)
    pairs = []

    def leads(pos, node):
        """Can a word below ``node`` end as the rest of the own word has it?"""
        rest = F.substring("word", pos + 1, F.length("word"))
        return F.col("below").bitwiseAND(_ending(F.concat(node, rest), F.length("word") - pos)) != 0

    def state(pos, node, edits, ends):
        return F.when((edits == 0) | leads(pos, node), F.struct(pos.alias("pos"), node.alias("node"), edits.alias("edits"), ends.alias("ends")))

    while True:
        states = states.withColumn("part", _spread(F.col("node"), F.col("word")))
        # every move: follow or replace the own symbol, or insert one
        free = states.where(open_)
        down = free.drop("ends").join(edges, ["node", "part"]).select(
            "word",
            F.inline(F.filter(
                F.array(
                    F.when(~at_end, state(step, child, F.when(own == F.col("symbol"), F.lit(0)).otherwise(F.lit(1)), ends)),
                    state(F.col("pos"), child, F.lit(1), ends),
                ),
                lambda s: s.isNotNull(),
            )),
        )
        left_out = free.where(~at_end).select("word", step.alias("pos"), "node", F.lit(1).alias("edits"), "ends")
        # no move but the own symbol: the edit is not due yet, or is spent
        bound = states.where(~open_ & ~at_end).drop("ends").withColumn("symbol", own)
        followed = bound.join(edges, ["node", "symbol", "part"]).where((F.col("edits") == 0) | leads(step, child)).select(
            "word", step.alias("pos"), child.alias("node"), "edits", ends.alias("ends")
        )
        states = store(down.unionByName(left_out).unionByName(followed), "states")
        pairs.append(states.where(at_end & F.col("ends") & (F.col("edits") == 1)).select("word", F.col("node").alias("near")))
        if states.isEmpty():
            break
    out = pairs[0]
    for p in pairs[1:]:
        out = out.unionByName(p)
    return out.select(F.reverse("word").alias("word"), F.reverse("near").alias("near")) if backwards else out


# ------------------------------------------------------------------ neighbours of very long words
def _left_out_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of each word (place -1) and of the word without the code point at each place."""
    base = 0x9E3779B97F4A7C15
    back = pow(base, -1, 1 << 64)
    for batch in batches:
        for key, word in zip(batch.column("id").to_pylist(), batch.column("word").to_pylist()):
            codes = np.frombuffer(word.encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)
            n = len(codes)
            powers = np.full(n, base, np.uint64)
            powers[0] = 1
            sums = np.append(np.uint64(0), np.cumsum(codes * np.multiply.accumulate(powers)))
            short = sums[:-1] + (sums[n] - sums[1:]) * np.uint64(back)
            hashes = np.append(sums[n], short).view(np.int64)
            places = np.arange(-1, n)
            for low in range(0, n + 1, PART):
                part = slice(low, low + PART)
                if len(places[part]):
                    yield pa.RecordBatch.from_pydict({
                        "id": pa.array(np.full(len(places[part]), key)), "v": pa.array(hashes[part]), "place": pa.array(places[part].astype(np.int64)),
                    })


def _match_long(words: DataFrame, longest: int) -> DataFrame:
    """word, near: pairs one edit apart of which at least one word has more than ``longest`` code points."""
    some = store(words.where(F.length("word") >= longest).select(F.monotonically_increasing_id().alias("id"), "word"), "long")
    if some.isEmpty():
        return some.select("word", F.col("word").alias("near"))
    hashes = store(some.mapInArrow(_left_out_rows, "id long, v long, place long"), "left_out")
    shorter = hashes.where("place >= 0")
    whole = hashes.where("place < 0").select("v", F.col("id").alias("other"))
    # taking a code point out of one word gives the other
    once = shorter.groupBy("id", "v").agg(F.min("place").alias("place"))
    cut = once.join(whole, "v").select("id", "other", "place", F.lit(True).alias("cut"))
    # taking the one at the same place out of both gives the same: at most one word for each letter
    same = shorter.join(shorter.select("v", "place", F.col("id").alias("other")), ["v", "place"]).where("id < other")
    found = cut.unionByName(same.select("id", "other", "place", F.lit(False).alias("cut")))
    texts = found.join(some, "id").join(some.select(F.col("id").alias("other"), F.col("word").alias("near")), "other")

    def without(c):
        return F.concat(F.substring(c, F.lit(1), F.col("place").cast("int")), F.substring(c, F.col("place").cast("int") + 2, F.length(c)))

    right = F.when(F.col("cut"), without("word") == F.col("near")).otherwise(without("word") == without("near"))
    pairs = texts.where(right & (F.greatest(F.length("word"), F.length("near")) > longest)).select("word", "near")
    return pairs.unionByName(pairs.select(F.col("near").alias("word"), F.col("word").alias("near")))


def near_words(words: DataFrame, longest: int = LONGEST) -> DataFrame:
    """word, near: all ordered pairs of the distinct words in ``words`` that are one edit apart."""
    short = words.where(F.length("word") <= longest).select("word")
    found = _walk(short, False).unionByName(_walk(short, True))
    return found.unionByName(_match_long(words, longest)).distinct()


# ------------------------------------------------------------------ forms and roots
def follow(links: DataFrame) -> DataFrame:
    """word, root: where each word's chain of forms ends. ``links`` has word and form; each round doubles the way."""
    reached = links.select("word", F.col("form").alias("root"))
    while True:
        ahead = reached.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        stepped = store(reached.join(ahead, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")), "roots")
        reached = stepped.select("word", "root")
        if stepped.where("_moved").isEmpty():
            return reached


def group_variants(words: DataFrame, ratio: int = 5, longest: int = LONGEST) -> DataFrame:
    """word, form, root, n, n_near, form_n for every word of ``words`` (word, n).

    The form is the near word that occurs most often, if at least ``ratio`` times as often as the word.
    """
    near = near_words(words, longest).join(words.select(F.col("word").alias("near"), F.col("n").alias("_n")), "near")
    best = near.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("_n")).alias("n"), "near")).alias("_best"))
    most = -F.col("_best.n")
    strong = most >= F.lit(ratio) * F.col("n")
    formed = store(
        words.join(best, "word", "left").select(
            "word", F.when(strong, F.col("_best.near")).alias("form"), "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(strong, most).alias("form_n"),
        ), "forms",
    )
    roots = follow(formed.where("form IS NOT NULL").select("word", "form"))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
