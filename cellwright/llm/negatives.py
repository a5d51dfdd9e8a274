"""Hard negatives of anchor vectors: other-label vectors in a window of scores below each positive's.

Scores are exact integer inner products of components scaled by ``SCALE`` and
rounded down. Most pairs should not need one: every row stores its norm and its
angles to a few reference directions. By the triangle inequality on the sphere the
angle between an anchor and a row lies between the largest difference of their
angles to a reference and the smallest sum, so its cosine lies in an interval; times
both norms, widened by more than the rounding errors, it bounds the score. Only
pairs whose interval overlaps a wanted window are scored.

The job:

1. A sample of at most ``SAMPLE`` rows gives the reference directions (each next one
   farthest from those before) and, for each anchor, scores that the wanted ones have to
   beat. It decides no result.
2. Rows are put in groups of at most ``GROUP`` by their nearest reference. Anchors are copied to the
   groups in blocks; a task holds one group and takes the blocks one by one. Anchors beyond
   ``ANCHORS`` go to further copies of the groups, so neither side grows with the data.
3. First pass: the ``n_positives`` best rows of the anchor's label. Second pass: for each
   positive the ``n_negatives`` best rows of other labels in its window.

How much is left out depends on the data: vectors without clusters in many dimensions have nearly equal
angles to everything, and most pairs are scored.

Defined results: rows with a null id, label or vector, or with a null or non-finite component, take no part.
Rows of one id are one: the smallest by label, then vector. Vectors of different lengths are
filled with zeros. Components whose scaled value is beyond 2^52, and vectors whose scores would not fit a
long, raise an error. An anchor without positives, or a positive without negatives, has no rows.
An empty table gives an empty result. Columns other than id, label and vector are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import store

SCALE = 256
SAMPLE = 4096
REFERENCES = 12
#: most rows in a group, and least rows worth one
GROUP, SMALL = 1 << 15, 512
#: anchors in a block, and anchors that one copy of a group meets
ANCHOR_BLOCK, ANCHORS = 256, 1 << 16
#: radians and score units that cover rounding of angles, norms and products
SLACK_ANGLE, SLACK = 1e-6, 1e-9


# ------------------------------------------------------------------ rows
def usable_rows(vectors: DataFrame, key: str, label: str, vector: str) -> DataFrame:
    """id, label, q: whole components, one row for each id."""
    x = F.col(vector)
    fit = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    kept = vectors.where(F.col(key).isNotNull() & F.col(label).isNotNull() & x.isNotNull() & F.coalesce(fit, F.lit(False)))
    scaled = F.transform(x, lambda v: v.cast("double") * SCALE)
    near = F.forall(scaled, lambda v: F.abs(v) <= float(1 << 52))
    whole = F.when(near, F.transform(scaled, lambda v: F.floor(v).cast("bigint"))).otherwise(
        F.raise_error(F.lit("a scaled component is beyond 2^52")).cast("array<bigint>")
    )
    rows = kept.select(F.col(key).cast("bigint").alias("id"), F.col(label).cast("bigint").alias("label"), whole.alias("q"))
    return rows.groupBy("id").agg(F.min(F.struct("label", "q")).alias("_r")).select("id", "_r.label", "_r.q")


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of whole components, filled with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), width), np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(column)), sizes)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out


def references(rows: np.ndarray, how_many: int) -> np.ndarray:
    """Unit directions of some of the rows, each next one as far as can be from those before."""
    norms = np.linalg.norm(rows.astype(float), axis=1)
    unit = rows[norms > 0] / norms[norms > 0][:, None]
    if not len(unit):
        return np.zeros((0, rows.shape[1]))
    chosen = [0]
    nearest = unit @ unit[0]
    while len(chosen) < min(how_many, len(unit)):
        chosen.append(int(np.argmin(nearest)))
        nearest = np.maximum(nearest, unit @ unit[chosen[-1]])
    return unit[chosen]


def norms_and_angles(q: np.ndarray, directions: np.ndarray):
    """Norm of each row and its angles to the directions; a zero row is taken to be at right angles."""
    x = q.astype(float)
    norms = np.sqrt((x * x).sum(axis=1))
    cosines = (x @ directions.T) / np.where(norms > 0, norms, 1.0)[:, None]
    return norms, np.arccos(np.clip(cosines, -1.0, 1.0))


def score_bounds(norm, angles, norms, all_angles):
    """Lower and upper bounds of the scores of one vector with many, safe against rounding."""
    if not all_angles.shape[1]:
        top = norm * norms * (1 + SLACK) + SLACK
        return -top, top
    apart = np.abs(all_angles - angles).max(axis=1)
    around = all_angles + angles
    around = np.minimum(around, 2 * np.pi - around).min(axis=1)
    size = norm * norms
    least, most = np.maximum(apart - SLACK_ANGLE, 0.0), np.minimum(around + SLACK_ANGLE, np.pi)
    wide = SLACK * size + SLACK
    return size * np.cos(most) - wide, size * np.cos(least) + wide


def _best(ids, scores, how_many):
    """Places of the highest scores, ties by smaller id."""
    if len(scores) > how_many:
        cut = np.partition(scores, len(scores) - how_many)[len(scores) - how_many]
        near = np.flatnonzero(scores >= cut)
    else:
        near = np.arange(len(scores))
    return near[np.lexsort((ids[near], -scores[near]))][:how_many]


# ------------------------------------------------------------------ passes
def _packed(groups: pa.RecordBatch, width: int):
    return groups.column("id").to_numpy(), groups.column("label").to_numpy(), _matrix(groups.column("q"), width)


class Windows:
    """Wanted scores of an anchor: any at or over ``least``, or within [low, high] of each positive."""

    def __init__(self, n_positives: int, n_negatives: int, low: int, high: int):
        self.n_positives, self.n_negatives, self.low, self.high = n_positives, n_negatives, low, high

    def between(self, positive: np.ndarray, scores: np.ndarray) -> np.ndarray:
        """low * positive <= 100 * score <= high * positive, in whole numbers."""
        return (self.low * positive <= 100 * scores) & (100 * scores <= self.high * positive)


def _first_pass(width, directions, sample, windows: Windows):
    """Candidates for an anchor's positives among the rows of one group."""

    def seeds(ids, labels, q, own, label, anchor):
        mine = (labels == label) & (ids != own)
        scores = q[mine] @ anchor
        k = windows.n_positives
        return np.sort(scores)[-k] if len(scores) >= k else None

    def score(group, block):
        ids, labels, q, norms, angles = group
        for own, label, anchor, norm, angle, least in block:
            mine = np.flatnonzero((labels == label) & (ids != own))
            if least is not None and len(mine):
                _, top = score_bounds(norm, angle, norms[mine], angles[mine])
                mine = mine[top >= least]
            if not len(mine):
                continue
            scores = q[mine] @ anchor
            for at in _best(ids[mine], scores, windows.n_positives):
                if least is None or scores[at] >= least:
                    yield int(own), int(ids[mine[at]]), int(scores[at])

    def prepare(ids, labels, q, extra):
        norms, angles = norms_and_angles(q, directions)
        return [
            (ids[i], labels[i], q[i], norms[i], angles[i], seeds(*sample, ids[i], labels[i], q[i])) for i in range(len(ids))
        ]

    return prepare, score


def _second_pass(width, directions, sample, windows: Windows):
    """Candidates for the negatives of each of an anchor's positives among the rows of one group."""

    def score(group, block):
        ids, labels, q, norms, angles = group
        for own, label, anchor, norm, angle, wanted in block:
            other = np.flatnonzero(labels != label)
            if not len(other):
                continue
            low, high = score_bounds(norm, angle, norms[other], angles[other])
            overlap = np.zeros(len(other), bool)
            for _, positive, least in wanted:
                floor = windows.low * positive / 100 if least is None else least
                overlap |= (high >= floor - SLACK) & (low <= windows.high * positive / 100 + SLACK)
            other = other[overlap]
            if not len(other):
                continue
            scores = q[other] @ anchor
            for positive_id, positive, least in wanted:
                inside = windows.between(positive, scores)
                if least is not None:
                    inside &= scores >= least
                hit = np.flatnonzero(inside)
                for at in _best(ids[other[hit]], scores[hit], windows.n_negatives):
                    yield int(own), int(positive_id), int(positive), int(ids[other[hit[at]]]), int(scores[hit[at]])

    def prepare(ids, labels, q, extra):
        norms, angles = norms_and_angles(q, directions)
        s_ids, s_labels, s_q = sample
        out = []
        for i in range(len(ids)):
            scores = s_q[s_labels != labels[i]] @ q[i]
            wanted = []
            for p in extra[i] or ():
                inside = np.sort(scores[windows.between(p["score"], scores)])
                k = windows.n_negatives
                wanted.append((p["id"], p["score"], inside[-k] if len(inside) >= k else None))
            out.append((ids[i], labels[i], q[i], norms[i], angles[i], wanted))
        return out

    return prepare, score


def _meet(width, directions, make_pass, names):
    """Rows of a group, then its anchors block by block, in the order of (place, kind)."""
    prepare, score = make_pass

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, parts, group = None, [], None
        for batch in batches:
            places, kinds = batch.column("place").to_numpy(), batch.column("kind").to_numpy()
            cut = np.flatnonzero((np.diff(places) != 0) | (np.diff(kinds) != 0)) + 1
            for low, high in zip([0, *cut.tolist()], [*cut.tolist(), batch.num_rows]):
                part = batch.slice(low, high - low)
                if places[low] != place:
                    place, parts, group = places[low], [], None
                if kinds[low] == 0:
                    parts.append(_packed(part, width))
                    continue
                if not parts:
                    continue
                if group is None:
                    ids, labels, q = (np.concatenate(x) for x in zip(*parts))
                    group = (ids, labels, q, *norms_and_angles(q, directions))
                for begin in range(0, part.num_rows, ANCHOR_BLOCK):
                    some = part.slice(begin, ANCHOR_BLOCK)
                    block = prepare(*_packed(some, width), some.column("wanted").to_pylist())
                    found = list(score(group, block))
                    if found:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names)

    return run


def _run_pass(placed, anchors, n_groups, n_copies, width, directions, make_pass, names):
    """Copies of anchors to all groups, and what each group has for them."""
    copy = F.pmod(F.xxhash64("id"), F.lit(n_copies)).cast("int")
    rows = placed.select(
        F.explode(F.sequence(F.lit(0), F.lit(n_copies - 1))).alias("copy"), "group", F.lit(0).alias("kind"), "id", "label", "q",
        F.lit(None).cast("array<struct<id:bigint,score:bigint>>").alias("wanted"),
    )
    asked = anchors.select(
        copy.alias("copy"), F.explode(F.sequence(F.lit(0), F.lit(n_groups - 1))).alias("group"), F.lit(1).alias("kind"),
        "id", "label", "q", "wanted",
    )
    place = (F.col("copy") * F.lit(n_groups) + F.col("group")).cast("bigint").alias("place")
    both = rows.unionByName(asked).select(place, "kind", "id", "label", "q", "wanted")
    return both.repartition("place").sortWithinPartitions("place", "kind").mapInArrow(
        _meet(width, directions, make_pass, names), ", ".join(f"{n} long" for n in names)
    )


def mine_negatives(
    vectors: DataFrame, anchors: Column, key: str = "vec_id", label: str = "label", vector: str = "embedding",
    n_positives: int = 5, n_negatives: int = 10, low: int = 30, high: int = 90, group: int = GROUP, small: int = SMALL,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``anchors`` is a condition on the id column. A negative's score is at least ``low`` and at most
    ``high`` hundredths of the positive's.
    """
    named = vectors.select(F.col(key).alias(key), F.col(label).alias(label), F.col(vector).alias(vector))
    rows = store(usable_rows(named, key, label, vector), "vectors")
    spark = rows.sparkSession
    n, width, large = rows.agg(
        F.count(F.lit(1)), F.coalesce(F.max(F.size("q")), F.lit(0)),
        F.coalesce(F.max(F.array_max(F.transform("q", F.abs))), F.lit(0)),
    ).first()
    if width * large * large * 100 >= 1 << 63:
        raise ValueError("scores of these vectors do not fit a long")
    # a bounded sample, the same whatever the partitions are
    picked = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).toArrow()
    sample = (picked.column("id").to_numpy(), picked.column("label").to_numpy(), _matrix(picked.column("q"), width))
    directions = references(sample[2], REFERENCES)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    most = max(small, min(group, -(-n // (4 * tasks))))

    def nearest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, angles = norms_and_angles(_matrix(batch.column("q"), width), directions)
            cell = angles.argmin(axis=1) if angles.shape[1] else np.zeros(len(angles), np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), batch.column("q"), pa.array(cell, pa.int32())], ["id", "label", "q", "cell"]
            )

    celled = store(rows.mapInArrow(nearest, "id long, label long, q array<long>, cell int"), "cells")
    # slices of a cell, numbered through: one row for each reference at most
    sizes = celled.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / most).alias("slices")).collect()
    first, n_groups, cells = {}, 0, {}
    for s in sorted(sizes):
        first[s["cell"]], cells[s["cell"]] = n_groups, s["slices"]
        n_groups += s["slices"]
    if not n_groups:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")

    def by_cell(values):
        return F.element_at(F.create_map(*[F.lit(x) for kv in values.items() for x in kv]), F.col("cell"))

    placed = celled.select(
        (by_cell(first) + F.pmod(F.xxhash64("id"), by_cell(cells))).cast("int").alias("group"), "id", "label", "q"
    )
    asked = store(rows.withColumnRenamed("id", key).where(anchors).withColumnRenamed(key, "id"), "anchors")
    copies = max(1, -(-asked.count() // ANCHORS))
    windows = Windows(n_positives, n_negatives, low, high)
    none = asked.withColumn("wanted", F.lit(None).cast("array<struct<id:bigint,score:bigint>>"))
    found = _run_pass(
        placed, none, n_groups, copies, width, directions, _first_pass(width, directions, sample, windows),
        ["anchor_id", "positive_id", "positive_score"],
    )
    order = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    best = found.withColumn("_k", F.row_number().over(order)).where(F.col("_k") <= n_positives)
    wanted = best.groupBy(F.col("anchor_id").alias("id")).agg(
        F.collect_list(F.struct(F.col("positive_id").alias("id"), F.col("positive_score").alias("score"))).alias("wanted")
    )
    ready = store(asked.join(wanted, "id"), "positives")
    found = _run_pass(
        placed, ready, n_groups, copies, width, directions, _second_pass(width, directions, sample, windows),
        ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"],
    )
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n_negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
