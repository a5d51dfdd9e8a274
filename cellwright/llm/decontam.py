"""Benchmark decontamination: size-partitioned MinHash containment search, verified exactly.

Texts are lower-cased in A-Z; words are maximal runs of ASCII letters, digits
and characters beyond ASCII; shingles are five words (fewer words: the whole
sequence). A document contains an item if at least ``threshold`` of the item's
different shingles occur in it, anywhere.

The search sketches the short side. Items are partitioned by size (number of
different shingles, in powers of two). A partition up to size u keeps the
k = floor((1 - threshold) u) + 1 smallest shingle hashes of each item, its
bottom-k MinHash sketch. A document that contains the item misses at most
k - 1 of its shingles, so it holds at least one of these k: however long the
document is, and over however many rows of its id it is spread, no containing document is
missed. A fixed bitmap of the sketch and
item hashes (its size does not depend on the data) keeps other shingles from leaving
the task that reads a document. Candidates are then verified by counting equal
shingle texts.

Defined results
    null or wordless item      no shingles, found nowhere
    null or wordless document  contains nothing
    equal items                each reported
    equal doc_ids              one document with the shingles of all its rows
    null doc_id                treated as an id of its own
    empty tables               no rows
    other columns              kept out; doc_id, text and item_id, text are read
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import store
from .langid import free_name
from .textbytes import LOWER, shingles, text_bytes, text_slices, word_hashes, word_spans

WORDS = 5
THRESHOLD = 0.8
#: 2^23 bits: 1 MB, whatever the number of items
MAP_BITS = 23


def _shingle_rows(id_column: str, bitmap: np.ndarray | None, size: int):
    """mapInArrow function: id, n (shingles of the row), h, shingle; only hashes of the bitmap."""

    def run(batches):
        for part in text_slices(batches):
            buf, offsets = text_bytes(part.column("text"))
            buf = LOWER[buf]
            starts, ends, doc = word_spans(buf, offsets)
            h, at, n = shingles(word_hashes(buf, starts, ends), doc, size)
            owner = doc[at]
            per_text = np.bincount(owner, minlength=part.num_rows)
            if bitmap is not None:
                place = h & np.uint64((1 << MAP_BITS) - 1)
                keep = (bitmap[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1
                keep = np.flatnonzero(keep)
            else:
                keep = np.arange(len(h))
            if len(keep):  # one row for each text and hash
                pair = np.lexsort((h[keep], owner[keep]))
                keep = keep[pair]
                new = np.ones(len(keep), bool)
                new[1:] = (h[keep][1:] != h[keep][:-1]) | (owner[keep][1:] != owner[keep][:-1])
                keep = keep[new]
            raw = buf.tobytes()
            found = [
                b" ".join(raw[starts[w] : ends[w]] for w in range(a, a + k)).decode()
                for a, k in zip(at[keep].tolist(), n[keep].tolist())
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(id_column).take(pa.array(owner[keep])),
                    pa.array(per_text[owner[keep]].astype(np.int64)),
                    pa.array(h[keep].view(np.int64)),
                    pa.array(found, pa.string()),
                ],
                [id_column, "n", "h", "shingle"],
            )

    return run


def _rows(df: DataFrame, id_column: str, bitmap, size: int) -> DataFrame:
    kind = df.schema[id_column].dataType.simpleString()
    return df.select(id_column, F.col("text").cast("string").alias("text")).mapInArrow(
        _shingle_rows(id_column, bitmap, size), f"{id_column} {kind}, n bigint, h bigint, shingle string"
    )


def _bitmap(hashes: DataFrame) -> np.ndarray:
    """Bits of the hashes' low places; at most 2^(MAP_BITS - 6) longs reach the driver."""
    place = F.col("h").bitwiseAND(F.lit((1 << MAP_BITS) - 1))
    words = (
        hashes.select(place.alias("p")).distinct()
        .groupBy(F.shiftright("p", 6).cast("int").alias("w"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("bits"))
    )
    out = np.zeros(1 << (MAP_BITS - 6), np.int64)
    for r in words.collect():
        out[r["w"]] = r["bits"]
    return out.view(np.uint8)


def sketch_items(shingled: DataFrame, threshold: float) -> DataFrame:
    """item_id, n_item, h: the bottom-k sketch of every item, k by size partition."""
    sizes = shingled.groupBy("item_id").agg(F.count(F.lit(1)).alias("n_item"))
    upper = F.pow(F.lit(2), F.floor(F.log2("n_item")) + 1) - 1
    k = (F.floor(upper * F.lit(1 - threshold) + F.lit(1e-9)) + 1).alias("k")
    by_hash = Window.partitionBy("item_id").orderBy("h")
    return (
        shingled.join(sizes.select(F.col("item_id").alias("_item"), "n_item", k), F.col("item_id").eqNullSafe(F.col("_item")))
        .withColumn("at", F.row_number().over(by_hash))
        .where("at <= k").select("item_id", "n_item", "h")
    )


def find_contained(
    docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, words: int = WORDS
) -> DataFrame:
    """doc_id, item_id, n_shingles, n_found, containment for each item that a document contains."""
    shingled = store(_rows(items, "item_id", None, words).dropDuplicates(["item_id", "shingle"]), "item_shingles")
    sketch = store(sketch_items(shingled, threshold), "item_sketches")
    hits = store(_rows(docs, "doc_id", _bitmap(shingled), words), "document_hits")

    def needed(n: Column) -> Column:
        return F.ceil(n * F.lit(threshold) - F.lit(1e-9))

    near = hits.join(sketch, "h")
    candidates = near.select("doc_id", "item_id", "n_item").distinct()
    wanted = candidates.join(
        shingled.select(F.col("item_id").alias("_item"), "shingle"), F.col("item_id").eqNullSafe(F.col("_item"))
    )
    own = hits.select(F.col("doc_id").alias("_doc"), F.col("shingle").alias("_shingle")).distinct()
    found = wanted.join(own, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("shingle") == F.col("_shingle")))
    return (
        found.groupBy("doc_id", "item_id", "n_item").agg(F.count(F.lit(1)).alias("n_found"))
        .where(F.col("n_found") >= needed(F.col("n_item")))
        .select(
            "doc_id", "item_id", F.col("n_item").alias("n_shingles"), "n_found",
            (F.col("n_found") / F.col("n_item")).alias("containment"),
        )
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Documents that contain no item, with all their columns.

    Rows of one id go or stay together; a row without an id is a document of its own, named by its text.
    """
    name = free_name(docs, "contained_key")
    text = F.col("text").cast("string")
    own = F.concat(F.lit("text "), F.xxhash64(text), F.lit(" "), F.coalesce(F.length(text), F.lit(0)))
    keyed = docs.withColumn(name, F.coalesce(F.concat(F.lit("id "), F.col("doc_id").cast("string")), own))
    found = find_contained(keyed.select(F.col(name).alias("doc_id"), "text"), items, threshold)
    contaminated = store(found.select(F.col("doc_id").alias(name)).distinct(), "contaminated")
    return keyed.join(contaminated, name, "left_anti").select(*docs.columns)
