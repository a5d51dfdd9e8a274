"""SimHash near-duplicates, found by anchor points of a covering code.

Fingerprint: words are runs of bytes other than ASCII white space, A-Z
lower-cased; shingles are three words, repeats included (fewer words: the whole
sequence); bit i is set if it is set in over half of the shingles' XXH64
(seed 42). No words: zero.

Search: the anchors are the words of a linear code of length 64, the first-order
Reed-Muller code (covering radius 28) widened by as many quadratic
generators as the number of fingerprints asks for. Every fingerprint is at home
at one nearest anchor, at distance r, and copied to every anchor within r plus
the threshold (r is at most the covering radius). Of two fingerprints that
differ in at most that many bits, take the one whose r is not larger: the other
is within r plus the threshold of its home anchor, so they meet there. At each
anchor, home fingerprints are compared with all that are copied to it. Anchors
with many fingerprints are cut into blocks, each pair of blocks a task's group,
so no group grows with the data. A group returns a spanning forest of its links.

Equal fingerprints are one class from the start, however many documents have
it. Component labels are the smallest doc_id.

Defined results
    null or wordless text   fingerprint zero, linked like any other
    null doc_id             fingerprinted and returned, but never names a component; a
                            component of such rows alone has the id null
    equal doc_ids           rows of one document: their fingerprints are linked
    empty table             no rows
    other columns           kept out; doc_id and text are read
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from ..session import store
from .graphs import components
from .langid import free_name
from .textbytes import text_slices

WORDS = 3
SEED = 42
MAX_BITS = 3
#: fingerprints an anchor should have at home on average
PER_ANCHOR = 256
#: bits of the map of keys by which rows stay without being moved: 2^17 words of 64
MARK_BITS = 23
#: rows of either side in one group of comparisons
BLOCK = 4096


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """64-bit SimHash of one text."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(len(parts) - words + 1, 1)
    first, last = starts[:n].tolist(), (ends[words - 1 :] if len(parts) >= words else ends[-1:]).tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for k in range(0, n, 1 << 16):
        h = np.array([digest(joined[s:e], SEED) for s, e in zip(first[k : k + (1 << 16)], last[k : k + (1 << 16)])], np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, keep=("doc_id",)) -> DataFrame:
    """The columns of ``keep`` and fp (the fingerprint as a signed long) of every row."""

    def run(batches):
        for part in text_slices(batches):
            found = np.array([fingerprint(t) for t in part.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), pa.array(found.view(np.int64))], [*keep, "fp"])

    kinds = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select(*keep, F.col("text").cast("string").alias("text")).mapInArrow(run, f"{kinds}, fp bigint")


def _signs(fps: np.ndarray) -> np.ndarray:
    """(n, 64) array of +1 for a zero bit and -1 for a one."""
    bits = np.unpackbits(fps.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return 1.0 - 2.0 * bits.astype(np.float32)


def _code(extra: int) -> tuple[np.ndarray, np.ndarray]:
    """(cosets, linear): signs of 2^extra coset leaders, and of the 64 linear words (their complements follow)."""
    place = (np.arange(64)[:, None] >> np.arange(6)) & 1
    linear = 1.0 - 2.0 * ((place @ place.T) & 1)
    pairs = [(i, j) for i in range(6) for j in range(i)][:extra]
    leaders = np.zeros((1 << extra, 64), np.int64)
    for k, (i, j) in enumerate(pairs):
        leaders ^= ((np.arange(1 << extra) >> k) & 1)[:, None] * (place[:, i] & place[:, j])
    return (1.0 - 2.0 * leaders).astype(np.float32), linear.astype(np.float32)


def anchors_of(fps: np.ndarray, extra: int, bits: int = MAX_BITS):
    """(row, anchor, home) for every anchor that a fingerprint is copied to."""
    cosets, linear = _code(extra)
    signs = _signs(fps)
    step = max(1, (1 << 20) // (64 << extra))
    for low in range(0, len(fps), step):
        own = signs[low : low + step]
        # agreement minus difference with each linear word, for every coset
        sums = ((own[:, None, :] * cosets[None]) @ linear).reshape(len(own), -1)
        apart = np.concatenate([(64 - sums) / 2, (64 + sums) / 2], axis=1)
        nearest = apart.argmin(axis=1)
        row, anchor = np.nonzero(apart <= apart[np.arange(len(own)), nearest][:, None] + bits)
        yield row + low, anchor, anchor == nearest[row]


def _forest(a: np.ndarray, b: np.ndarray, parent: np.ndarray) -> None:
    """Unite the pairs (a, b) in ``parent``, whose entries point to the smallest index of their set."""

    def top(x):
        up = parent[x]
        while (more := parent[up] != up).any():
            up = np.where(more, parent[up], up)
        return up

    while len(a):
        ra, rb = top(a), top(b)
        open_ = ra != rb
        a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
        np.minimum.at(parent, np.maximum(ra, rb), np.minimum(ra, rb))


def links_in_group(home: np.ndarray, home_node: np.ndarray, all_: np.ndarray, all_node: np.ndarray, bits: int):
    """Spanning forest (node, node) of the pairs at most ``bits`` apart."""
    nodes, place = np.unique(np.concatenate([home_node, all_node]), return_inverse=True)
    at, to = place[: len(home)], place[len(home) :]
    parent = np.arange(len(nodes))
    for low in range(0, len(home), 64):
        near = np.bitwise_count(home[low : low + 64, None] ^ all_[None, :]) <= bits
        i, j = np.nonzero(near)
        other = at[low + i] != to[j]
        _forest(at[low + i][other], to[j][other], parent)
    while (parent[parent] != parent).any():
        parent = parent[parent]
    moved = parent != np.arange(len(nodes))
    return nodes[moved], nodes[parent[moved]]


def link_classes(classes: DataFrame, bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """a, b: links that connect the classes (node, fp) at most ``bits`` apart, as a spanning forest of each group."""
    count = classes.count()
    extra = min(15, max(0, math.ceil(math.log2(max(count, 1) / PER_ANCHOR / 128)))) if count else 0

    def replicate(batches):
        for batch in batches:
            fps = np.ascontiguousarray(batch.column("fp").to_numpy(zero_copy_only=False)).view(np.uint64)
            node = batch.column("node").to_numpy(zero_copy_only=False)
            for row, anchor, home in anchors_of(fps, extra, bits):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor.astype(np.int32)), pa.array(fps[row].view(np.int64)), pa.array(node[row]), pa.array(home)],
                    ["anchor", "fp", "node", "home"],
                )

    copies = store(classes.select("node", "fp").mapInArrow(replicate, "anchor int, fp bigint, node bigint, home boolean"), "anchored")
    # one row per anchor: at most 2^22, by the code
    sizes = copies.groupBy("anchor").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    dealt = copies.join(sizes, "anchor").withColumn("own", F.pmod(F.xxhash64("fp"), "blocks").cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    as_member = dealt.select("anchor", every.alias("i"), F.col("own").alias("j"), "fp", "node", F.lit(False).alias("home"))
    as_home = dealt.where("home").select("anchor", F.col("own").alias("i"), every.alias("j"), "fp", "node", "home")

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        fps, node, home = group["fp"].to_numpy().view(np.uint64), group["node"].to_numpy(), group["home"].to_numpy(bool)
        a, b = links_in_group(fps[home], node[home], fps[~home], node[~home], bits)
        return pd.DataFrame({"a": a, "b": b})

    return as_member.unionByName(as_home).groupBy("anchor", "i", "j").applyInPandas(compare, "a bigint, b bigint")


def _groups(prints: DataFrame, bits: int) -> DataFrame:
    """fp, root: the component of every fingerprint. Rows of one doc_id are linked."""
    # nodes are the fingerprints themselves, whatever the ids
    classes = store(prints.select("fp").distinct(), "classes")
    links = store(link_classes(classes.select("fp", F.col("fp").alias("node")), bits), "class_links")
    # a document with several rows links their fingerprints
    many = prints.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("fp").alias("a"), F.max("fp").alias("b")).where("a <> b")
    same = many.select("doc_id", "a").join(prints, "doc_id").select("a", F.col("fp").alias("b")).where("a <> b")
    roots = components(links.unionByName(same))
    return classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fp, component_id (the smallest doc_id reachable over links) for every row."""
    prints = store(fingerprints(docs.withColumn("doc_id", F.col("doc_id").cast("bigint"))), "fingerprints")
    grouped = store(_groups(prints, bits), "groups")
    least = prints.groupBy("fp").agg(F.min("doc_id").alias("doc"))
    smallest = least.join(grouped, "fp").groupBy("root").agg(F.min("doc").alias("component_id"))
    labels = store(grouped.join(smallest, "root").select("fp", "component_id"), "labels")
    return prints.join(labels, "fp").select("doc_id", "fp", "component_id")


def key_marks(keys: DataFrame, key: str) -> DataFrame:
    """word, bits: a bitmap with the low places of all keys set, 64 of them in a row; its size does not grow with the data."""
    place = F.col(key).bitwiseAND(F.lit((1 << MARK_BITS) - 1))
    return (
        keys.select(place.alias("p")).groupBy(F.shiftright("p", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("bits"))
    )


def marked(rows: DataFrame, key: str, marks: DataFrame, is_set: bool) -> DataFrame:
    """Rows whose key's bit is set in ``marks``, or those where it is not. No row is moved."""
    at, bits = free_name(rows, "mark_word"), free_name(rows, "mark_bits")
    word = F.shiftright(F.col(key).bitwiseAND(F.lit((1 << MARK_BITS) - 1)), 6)
    hit = F.coalesce(F.col(bits).bitwiseAND(F.expr(f"shiftleft(1L, cast(`{key}` & 63 as int))")) != 0, F.lit(False))
    # at most 2^(MARK_BITS - 6) rows of 16 bytes, whatever the tables
    found = rows.join(F.broadcast(marks.toDF(at, bits)), word == F.col(at), "left")
    return found.where(hit if is_set else ~hit).select(*rows.columns)


def drop_duplicates(docs: DataFrame, bits: int = MAX_BITS) -> DataFrame:
    """One row of each component, with all its columns.

    It is the one with the smallest doc_id, rows without an id last, and of equal ids the one with the smallest hash
    of its text; of rows equal in both any one.
    """
    k1, k2 = free_name(docs, "row_key"), free_name(docs, "row_key_2")
    text, none = F.col("text").cast("string"), F.col("doc_id").isNull()
    keyed = docs.withColumns({k1: F.xxhash64(text, "doc_id", none), k2: F.xxhash64(none, "doc_id", F.lit(1), text)})
    named = keyed.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(k1).alias("k1"), F.col(k2).alias("k2"), "text")
    prints = store(fingerprints(named, ("doc_id", "k1", "k2")), "fingerprints")
    grouped = store(_groups(prints, bits), "groups")
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "k1", "k2")
    # the first row of each fingerprint, then of each component: no component is gathered
    heads = prints.groupBy("fp").agg(F.min(rank).alias("head")).join(grouped, "fp")
    best = heads.groupBy("root").agg(F.min("head").alias("best"))
    kept = store(grouped.join(best, "root").select("fp", "best.k1", "best.k2"), "kept")
    other = prints.join(kept.withColumnsRenamed({"k1": "_1", "k2": "_2"}), "fp").where("k1 <> _1 OR k2 <> _2")
    # rows that are repeated in id and text share a key: one of them stays
    repeated = prints.groupBy("k1", "k2").count().where("count > 1").select("k1", "k2")
    extra = store(other.select("k1", "k2").distinct(), "duplicates")
    again = store(repeated.join(extra, ["k1", "k2"], "left_anti"), "repeated")
    # texts do not move to the keys: a row whose bit is not set stays where it is
    marks = store(key_marks(extra.unionByName(again), "k1"), "marks")
    once = marked(keyed, k1, marks, False)
    # of the others only those stay whose key is set by another one's bit, or is repeated
    spared = marked(prints.select("k1", "k2"), "k1", marks, True).distinct().join(extra, ["k1", "k2"], "left_anti")
    spared = store(spared.withColumnsRenamed({"k1": k1, "k2": k2}), "spared")
    first = marked(keyed, k1, marks, True).join(spared, [k1, k2], "left_semi").dropDuplicates([k1, k2])
    return once.unionByName(first).select(*docs.columns)
