"""Histogram sort: shards of near equal bytes, cut in the order of a text hash.

The sort key of a row is (64-bit hash of its text, doc_id), so equal texts lie
side by side and stay in one shard unless a group of them is larger than a
shard's tolerance; such a group is cut by doc_id. Splitters are found by
counting: a round sums, over all partitions, the exact bytes of rows in the
bins between the probes of the splitters that are still open, and each
splitter keeps the bin its target lies in. Bins narrow by 2^12 a round, until
every splitter is within tolerance or its bin is a single key. Only these sums
(at most splitters x 4096 numbers) reach the driver. Then rows move once.

Each shard is cut into pieces the same way, as many as its bytes ask for, so that
no task gets a whole shard; slots count on from piece to piece.

Defined results
    null text        size 8, hash of the empty string, as an empty text
    null doc_id      sorts before all ids
    repeated rows    rows equal in text and doc_id have one key: neighbours, in one shard
    empty table      no rows
    other columns    kept out; doc_id and text are read
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import store

BITS = 12
#: bits of the rounds after the first: at most 32 driver rows for each open splitter
FINE_BITS = 5
ROW_BYTES = 8
PIECE_BYTES = 64 << 20


def row_size(text: Column) -> Column:
    return (F.octet_length(F.coalesce(text, F.lit(""))) + ROW_BYTES).cast("bigint")


def _refine(rows: DataFrame, wanted: list[tuple[int, int, int]], tolerance: int) -> list[tuple[int, int | None]]:
    """Splitters of the long column ``k`` of ``rows`` (group, k, size).

    ``wanted`` holds (group, target bytes, bytes before the group). For each the
    answer is (splitter, below): the splitter whose bytes below come nearest to the
    target, and None; or a single key of many rows that straddles the target by
    more than the tolerance, and the bytes below it.
    """
    def parent(k: int, width: int) -> int:
        return 0 if width == 64 else k >> width

    state = {i: (g, -(1 << 63), 64, before) for i, (g, _, before) in enumerate(wanted)}
    done: dict[int, tuple[int, int | None]] = {}
    while state:
        # all open splitters are equally far: their bins are 2^width keys wide
        width = next(iter(state.values()))[2]
        step = max(width - (BITS if width == 64 else FINE_BITS), 0)
        some = rows
        if width < 64:
            some = rows.where(F.shiftright("k", width).isin(sorted({low >> width for _, low, _, _ in state.values()})))
        bins: dict[tuple[int, int], list] = {}
        counted = some.groupBy("group", F.shiftright("k", step).alias("bin")).agg(
            F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"), F.min("k").alias("low"), F.max("k").alias("high")
        )
        for r in counted.collect():
            bins.setdefault((r["group"], parent(r["bin"] << step, width)), []).append(r)
        for found in bins.values():
            found.sort(key=lambda r: r["bin"])
        following = {}
        for i, (group, low, _, below) in state.items():
            target = wanted[i][1]
            done[i] = (low, None)
            for r in bins.get((group, parent(low, width)), []):
                upto = below + r["bytes"]
                if upto < target:
                    below = upto
                    done[i] = (r["high"] + 1, None)
                    continue
                first, miss = ((r["low"], target - below) if target - below <= upto - target else (r["high"] + 1, upto - target))
                done[i] = (first, None)
                if miss > tolerance and r["low"] < r["high"]:
                    following[i] = (group, r["bin"] << step, step, below)
                elif miss > tolerance and r["n"] > 1:
                    done[i] = (r["low"], below)
                break
        state = following
    return [done[i] for i in range(len(wanted))]


def find_splitters(keys: DataFrame, parts: int, tolerance: float) -> list[tuple[int, int | None]]:
    """Lower bounds (hash, doc_id) of parts 1 .. parts-1; without an id: from the hash's first row on."""
    total = keys.agg(F.sum("size")).first()[0] or 0
    allowed = int(total / parts * tolerance)
    targets = [total * p // parts for p in range(1, parts)]
    rows = keys.select(F.lit(0).cast("bigint").alias("group"), F.col("key").alias("k"), "size")
    cuts: list[tuple[int, int | None]] = []
    inside: list[tuple[int, int, int]] = []
    places: list[int] = []
    for p, (k, below) in enumerate(_refine(rows, [(0, t, 0) for t in targets], allowed)):
        cuts.append((k, None))
        if below is not None:  # a group of equal texts wider than the tolerance: cut it by id
            places.append(p)
            inside.append((k, targets[p], below))
    if inside:
        group = keys.where(F.col("key").isin(sorted({g for g, _, _ in inside})))
        ids = group.select(F.col("key").alias("group"), F.col("id").alias("k"), "size")
        for p, (i, _) in zip(places, _refine(ids, inside, allowed), strict=True):
            cuts[p] = (cuts[p][0], i)
    return cuts


def shard_by_bytes(docs: DataFrame, shards: int = 24, pieces: int | None = None, tolerance: float = 0.005) -> DataFrame:
    """doc_id, text, size, shard, slot: every row of ``docs`` in one of ``shards`` shards of near equal bytes.

    ``tolerance`` is the share of a piece by which a cut may miss its target;
    a single row larger than that moves the cut by up to its own size. ``pieces``
    of a shard: by default one for each ``PIECE_BYTES``, 8 at least.
    """
    lowest = -(1 << 63)
    text = F.coalesce("text", F.lit(""))
    keyed = docs.select(
        "doc_id", "text", row_size(F.col("text")).alias("size"),
        F.xxhash64(text).alias("key"), F.coalesce(F.col("doc_id").cast("bigint"), F.lit(lowest)).alias("id"),
    )
    keys = store(keyed.select("key", "id", "size"), "shard_keys")
    if pieces is None:
        total = keys.agg(F.sum("size")).first()[0] or 0
        pieces = max(8, -(-total // (shards * PIECE_BYTES)))
    cuts = find_splitters(keys, shards * pieces, tolerance)

    def piece_of(key: Column, ident: Column) -> Column:
        """Number of cuts at or below a row's key, by a search tree of comparisons."""

        def pick(low: int, high: int) -> Column:
            if low == high:
                return F.lit(low)
            mid = (low + high) // 2
            k, i = cuts[mid]
            above = key > k if i is not None else key >= k
            if i is not None:
                above = above | ((key == k) & (ident >= i))
            return F.when(above, pick(mid + 1, high)).otherwise(pick(low, mid))

        return pick(0, len(cuts))

    piece = piece_of(F.col("key"), F.col("id")).cast("int")
    sizes = keys.groupBy(piece.alias("piece")).agg(F.count(F.lit(1)).alias("n"))
    # one row per piece: shards x pieces rows at most
    counted = {r["piece"]: r["n"] for r in sizes.collect()}
    starts, at = [], 0
    for p in range(shards * pieces):
        at = 0 if p % pieces == 0 else at
        starts.append(at)
        at += counted.get(p, 0)
    order = Window.partitionBy("piece").orderBy("key", "id")
    start = F.element_at(F.array(*[F.lit(s).cast("bigint") for s in starts]), F.col("piece") + 1)
    return keyed.withColumn("piece", piece).select(
        "doc_id", "text", "size",
        F.floor(F.col("piece") / pieces).cast("int").alias("shard"),
        (F.row_number().over(order) - 1 + start).cast("bigint").alias("slot"),
    )
