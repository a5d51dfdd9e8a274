"""Removing bytes covered by strings that occur more than once (suffix sorting by Lyndon groups).

A byte goes if a string of ``length`` bytes that covers it also starts at
another place of any document. How it is found:

1. Each window of ``length`` bytes picks the gram of ``GRAM`` bytes with the
   smallest hash in it, the leftmost of equals. Equal windows pick equal grams,
   so windows are compared only under the same gram. Neighbouring windows that
   pick the same gram form one segment: about one per 140 bytes, and only its
   hashes leave the task.
2. Grams with one segment end there. Segments of equal content are one, with
   a count; a content that occurs twice is repeated in all its windows.
3. Where a gram has different contents, each content is cut out of one document
   and they are suffix sorted together: symbols are tokens (a run of letters and
   digits with what follows it), suffixes are grouped by Lyndon prefix from the
   largest group down, then every group's order is read off
   (``lyndon_suffix_array``). Windows that share ``length`` bytes stand next to
   each other in that order; windows that start inside a token take the bytes
   before the next token along.
4. Repeated starts go back to all documents with that content, and their bytes
   are cut out.

A gram with more than ``GROUP`` bytes of different contents (a line that very many
documents have in different surroundings) is dealt anew by the bytes its windows
share, first for windows that start within 32 bytes, then for single windows,
so no task sorts more than about ``GROUP`` bytes at once.

Segments are told apart by two 64-bit hashes, of the gram and of the content.

Defined results: null text counts as empty; texts shorter than ``length`` keep all
bytes; rows equal in id and text are two documents (and so repeat each other);
rows with null ids are documents; an empty table gives an empty result. Matches
never cross documents. A text is worked on in blocks, so its length is bounded
only by one row. Columns that have the names of the added ones are replaced.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ..session import store
from .textbytes import mix, text_bytes, text_slices, word_hashes

LENGTH = 400
GRAM = 128
#: bytes of different contents under one gram that are sorted at once
GROUP = 8 << 20
#: bytes put together for one sort
BUCKET = 1 << 18
#: window starts worked on at once
BLOCK = 1 << 20

_SEGMENTS = "k1 long, k2 long, start long, own int, lead int, h long, c long, n long"


# ------------------------------------------------------------------ windows and their grams
def _gram_hashes(buf: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` bytes from each place; longer grams are put together from halves."""
    part, width, factor = buf.astype(np.uint64) + np.uint64(1), 1, 0x2545F4914F6CDD1D
    whole, done = None, 0
    while True:
        if size & width:
            if whole is None:
                whole, done = part, width
            else:
                m = len(buf) - done - width + 1
                whole = whole[:m] * np.uint64(factor) + part[done : done + m]
                done += width
        if done == size:
            return mix(whole)
        part = part[: len(part) - width] * np.uint64(factor) + part[width:]
        width, factor = 2 * width, factor * factor % (1 << 64)


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours."""
    n, size = len(values) - width + 1, 1
    while 2 * size <= width:
        values = np.minimum(values[: len(values) - size], values[size:])
        size *= 2
    return np.minimum(values[:n], values[width - size : width - size + n])


def window_segments(buf: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """(start, own, lead, h, c) of the segments of several texts: ``own`` neighbouring windows under
    gram ``h``, which stands ``lead`` bytes after the first one's start."""
    out = []
    for low in range(0, max(len(buf) - length + 1, 0), BLOCK):
        part = buf[low : low + BLOCK + length - 1]
        n = len(part) - length + 1
        starts = np.arange(low, low + n)
        text = np.searchsorted(offsets, starts, "right") - 1
        whole = starts + length <= offsets[text + 1]
        if not whole.any():
            continue
        hashes = _gram_hashes(part, gram)
        places = np.arange(len(hashes), dtype=np.uint64)
        bits = np.uint64(max(int(len(hashes)).bit_length(), 1))
        picked = _smallest((hashes >> bits << bits) | places, length - gram + 1)
        at = (picked & np.uint64((1 << int(bits)) - 1)).astype(np.int64)
        edge = np.ones(n, bool)
        edge[1:] = (at[1:] != at[:-1]) | (whole[1:] != whole[:-1])
        first = np.flatnonzero(edge)
        own = np.diff(np.append(first, n))
        first, own = first[whole[first]], own[whole[first]]
        content = word_hashes(part, first, first + own + length - 1)
        out.append((first + low, own, at[first] - first, hashes[at[first]].view(np.int64), content.view(np.int64)))
    if not out:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    return tuple(np.concatenate(x) for x in zip(*out))


def _merged(doc: np.ndarray, h: np.ndarray, c: np.ndarray):
    """How many segments of its document have this content, at the first of them; 0 at later ones."""
    order = np.lexsort((np.arange(len(doc)), c, h, doc))
    new = np.ones(len(order), bool)
    new[1:] = (doc[order[1:]] != doc[order[:-1]]) | (h[order[1:]] != h[order[:-1]]) | (c[order[1:]] != c[order[:-1]])
    heads = np.flatnonzero(new)
    counts = np.diff(np.append(heads, len(order)))
    n = np.zeros(len(order), np.int64)
    n[order[heads]] = counts
    return n


def _emit(k1, k2, start, own, lead, h, c, n, known=None) -> pa.RecordBatch:
    hidden = np.zeros(len(start), bool) if known is None else known
    return pa.RecordBatch.from_pydict({
        "k1": pa.array(k1), "k2": pa.array(k2), "start": pa.array(start), "own": pa.array(own.astype(np.int32)),
        "lead": pa.array(lead.astype(np.int32)), "h": pa.array(h, mask=hidden), "c": pa.array(c, mask=hidden), "n": pa.array(n),
    })


def _segment_rows(length: int, gram: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            buf, offsets = text_bytes(batch.column("text"))
            start, own, lead, h, c = window_segments(buf, offsets, length, gram)
            if not len(start):
                continue
            doc = np.searchsorted(offsets, start, "right") - 1
            k1, k2 = (batch.column(k).to_numpy() for k in ("k1", "k2"))
            n = _merged(doc, h, c)
            place = start - offsets[doc]
            keep = n > 0
            yield _emit(k1[doc[keep]], k2[doc[keep]], place[keep], own[keep], lead[keep], h[keep], c[keep], n[keep])
            # a content seen before in its document is repeated; neighbouring ones are one range
            late = np.flatnonzero(~keep)
            if len(late):
                cut = np.ones(len(late), bool)
                cut[1:] = (doc[late[1:]] != doc[late[:-1]]) | (place[late[1:]] != place[late[:-1]] + own[late[:-1]])
                head = np.flatnonzero(cut)
                total = np.add.reduceat(own[late], head)
                d = doc[late[head]]
                zero = np.zeros(len(head), np.int64)
                yield _emit(k1[d], k2[d], place[late[head]], total, zero, zero, zero, zero, np.ones(len(head), bool))

    return run


def _split_rows(length: int, width: int):
    """Segments dealt anew: blocks of ``width`` windows under the bytes that all of them share."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            buf, offsets = text_bytes(batch.column("text"))
            for row in range(batch.num_rows):
                text = buf[offsets[row] : offsets[row + 1]]
                k1, k2 = batch.column("k1")[row].as_py(), batch.column("k2")[row].as_py()
                for s in batch.column("segs")[row].as_py():
                    piece = text[s["start"] : s["start"] + s["own"] + length - 1]
                    # blocks are counted from the gram, at the same place for all contents
                    low = np.arange(s["own"])
                    block = (s["lead"] - low) // width
                    first = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
                    own = np.diff(np.append(first, s["own"]))
                    # the shared bytes: from the block's last start to the end of its first window
                    begin = s["lead"] - block[first] * width
                    end = s["lead"] - (block[first] + 1) * width + 1 + length
                    core = word_hashes(piece, begin, end)
                    h = mix(core + np.uint64(s["h"] % (1 << 64)) + block[first].astype(np.uint64)).view(np.int64)
                    c = word_hashes(piece, first, first + own + length - 1).view(np.int64)
                    m = len(first)
                    yield _emit(np.full(m, k1), np.full(m, k2), first + s["start"], own, s["lead"] - first, h, c, np.full(m, s["n"]))

    return run


# ------------------------------------------------------------------ suffix sorting
def lyndon_suffix_array(symbols: list[int]) -> list[int]:
    """Starts of the suffixes of ``symbols`` in ascending order; the last symbol must be the only smallest one.

    Suffixes are grouped by their longest Lyndon prefix. Groups are settled from the
    largest down: each place before a settled suffix, found by previous-smaller
    pointers, has its prefix extended by the settled one as often as it follows,
    and goes to the end of its group as a group of its own. Then one sweep in
    ascending order puts every suffix that ends at the swept one at the front of
    what is left of its group. Linear in steps, no names and no recursion.
    """
    n = len(symbols)
    order = sorted(range(n), key=symbols.__getitem__)
    group, size, where = [0] * n, [0] * n, [0] * n
    head = 0
    for at, i in enumerate(order):
        if symbols[i] != symbols[order[head]]:
            head = at
        group[i], where[i] = head, at
        size[head] += 1
    before = [-1] * n
    high = n
    while high:
        i = order[high - 1]
        low = group[i]
        if high - low == 1:
            j = i - 1
            while j >= 0 and group[j] >= low:
                j = before[j]
            before[i] = j
            if j >= 0 and size[g := group[j]] > 1:
                _split_off(order, group, size, where, g, (j,))
        else:
            follows: dict[int, int] = {}
            for i in sorted(order[low:high]):
                j = i - 1
                while j >= 0 and group[j] >= low:
                    j = before[j]
                before[i] = j
                if j >= 0:
                    follows[j] = follows.get(j, 0) + 1
            by_count: dict[int, dict[int, list[int]]] = {}
            for j, k in follows.items():
                by_count.setdefault(k, {}).setdefault(group[j], []).append(j)
            for k in sorted(by_count, reverse=True):
                for g, places in by_count[k].items():
                    if size[g] > len(places):
                        _split_off(order, group, size, where, g, places)
        high = low
    free = list(range(n))
    placed = [False] * n
    order[0] = n - 1
    placed[n - 1] = True
    for at in range(n):
        j = order[at] - 1
        while j >= 0 and not placed[j]:
            g = group[j]
            order[free[g]] = j
            free[g] += 1
            placed[j] = True
            j = before[j]
    return order


def _split_off(order, group, size, where, g, places) -> None:
    """Move ``places`` to the end of group ``g`` as a group of their own."""
    size[g] -= len(places)
    new = g + size[g]
    size[new] = len(places)
    for at, j in enumerate(places, new):
        other, old = order[at], where[j]
        order[at], order[old] = j, other
        where[j], where[other] = at, old
        group[j] = new


#: letters, digits and bytes of longer characters; a token begins where they begin
_INSIDE = np.zeros(256, bool)
for _low, _high in ((48, 58), (65, 91), (97, 123), (128, 256)):
    _INSIDE[_low:_high] = True


def _same_prefix(buf: np.ndarray, a: np.ndarray, b: np.ndarray, longest: int, words: np.ndarray) -> np.ndarray:
    """Equal bytes from ``a`` and from ``b``, counted up to ``longest``; eight at a time."""
    found = np.full(len(a), longest, np.int64)
    live = np.arange(len(a))
    for step in range(0, longest, 8):
        x = words[a[live] + step] ^ words[b[live] + step]
        off = x != 0
        if off.any():
            first = live[off]
            low = x[off] & (~x[off] + np.uint64(1))  # lowest set bit
            found[first] = np.minimum(step + np.log2(low.astype(np.float64)).astype(np.int64) // 8, longest)
            live = live[~off]
        if not len(live):
            break
    return found


def repeated_starts(pieces: list[bytes], owns: list[int], length: int) -> list[np.ndarray]:
    """For each piece, which of its first ``owns`` starts have ``length`` bytes that also start at another one.

    Starts past ``owns`` only lend their bytes.
    """
    sizes = np.array([len(p) for p in pieces])
    ends = np.cumsum(sizes)
    buf = np.frombuffer(b"".join(pieces) + bytes(length + 8), np.uint8)
    total = int(ends[-1])
    base = ends - sizes
    # tokens: cut where a run of word bytes begins, and at every piece's begin
    inside = _INSIDE[buf[:total]]
    cut = np.zeros(total, bool)
    cut[1:] = inside[1:] & ~inside[:-1]
    cut[base] = True
    begins = np.flatnonzero(cut)
    bounds = np.append(begins, total)
    tokens = [buf[a:b].tobytes() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
    piece_of = np.searchsorted(ends, begins, "right")
    # symbols: an end mark of its own after each piece, smaller than every token; the last mark is the smallest
    rank = {t: r for r, t in enumerate(sorted(set(tokens)), len(pieces))}
    symbols, place = [], []
    marks = iter(range(len(pieces) - 1, -1, -1))
    last = 0
    for t, p, b in zip(tokens, piece_of.tolist(), begins.tolist()):
        if p != last:
            symbols.append(next(marks))
            place.append(-1)
            last = p
        symbols.append(rank[t])
        place.append(b)
    symbols.append(next(marks))
    place.append(-1)
    order = np.array(place)[lyndon_suffix_array(symbols)]
    order = order[order >= 0]
    # bytes that neighbours in the order share
    words = np.ndarray(len(buf) - 7, "<u8", buf.tobytes(), strides=(1,)) if len(buf) >= 8 else np.zeros(0, np.uint64)
    shared = np.zeros(len(order), np.int64)
    shared[1:] = _same_prefix(buf, order[:-1], order[1:], length, words)
    at = np.full(total + 1, -1)
    at[order] = np.arange(len(order))
    # each wanted start s: the first token begin t in (s, s + length), or s + length; a piece's own
    # begin does not count, as it says nothing about the bytes around it
    starts = np.concatenate([b + np.arange(o) for b, o in zip(base, owns)])
    cut[base] = False
    natural = np.flatnonzero(cut)
    t = np.append(natural, total + length)[np.searchsorted(natural, starts, "right")]
    lead = np.minimum(t - starts, length)
    hit = np.zeros(len(starts), bool)
    sort = np.argsort(lead, kind="stable")
    edges = np.flatnonzero(np.diff(lead[sort])) + 1
    for mine in np.split(sort, edges):
        if not len(mine):
            continue
        d = int(lead[mine[0]])
        s = starts[mine]
        # suffixes that share length - d bytes are neighbours and form one class
        label = np.zeros(len(s), np.int64)
        if d < length:
            label = np.cumsum(shared < length - d)[at[s + d]]
        left = _head_numbers(s, d, words)
        key = np.lexsort((s, left, label))
        same = (label[key[1:]] == label[key[:-1]]) & (left[key[1:]] == left[key[:-1]])
        if d > 8:  # more than one word: the hash is only a hint
            a, b = s[key[1:]][same], s[key[:-1]][same]
            same[same] = _same_prefix(buf, a, b, d, words) >= d
        both = np.zeros(len(s), bool)
        both[1:] |= same
        both[:-1] |= same
        hit[mine[key]] = both
    return np.split(hit, np.cumsum(owns)[:-1])


def _head_numbers(starts: np.ndarray, size: int, words: np.ndarray) -> np.ndarray:
    """A number for the ``size`` bytes from each start: the bytes themselves up to eight, else a hash."""
    h = np.zeros(len(starts), np.uint64)
    step = 0
    while size - step >= 8:
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + words[starts + step])
        step += 8
    if size > step:
        tail = words[starts + step] & np.uint64((1 << 8 * (size - step)) - 1)
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + tail) if step else tail
    return h


def _sort_rows(length: int, bucket: int):
    """Rows (h, c, own, piece) in order of h: the ranges of repeated starts of each content."""

    def answer(rows):
        hits = repeated_starts([r[3] for r in rows], [r[2] for r in rows], length)
        h, c, low, high = [], [], [], []
        for r, hit in zip(rows, hits):
            edge = np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0]))))
            for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
                h.append(r[0])
                c.append(r[1])
                low.append(a)
                high.append(b)
        return pa.RecordBatch.from_pydict({
            "h": pa.array(h, pa.int64()), "c": pa.array(c, pa.int64()),
            "low": pa.array(low, pa.int32()), "high": pa.array(high, pa.int32()),
        })

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in ("h", "c", "own", "piece"))):
                if held >= bucket and row[0] != rows[-1][0]:
                    yield answer(rows)
                    rows, held = [], 0
                rows.append(row)
                held += len(row[3])
        if rows:
            yield answer(rows)

    return run


def _cut_rows(length: int):
    """The contents to sort, cut out of the documents that stand for them."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            buf, offsets = text_bytes(batch.column("text"))
            raw, h, c, own, piece = buf.tobytes(), [], [], [], []
            for begin, segs in zip(offsets[:-1].tolist(), batch.column("segs").to_pylist()):
                for s in segs:
                    low = begin + s["start"]
                    h.append(s["h"])
                    c.append(s["c"])
                    own.append(s["own"])
                    piece.append(raw[low : low + s["own"] + length - 1])
            yield pa.RecordBatch.from_pydict({
                "h": pa.array(h, pa.int64()), "c": pa.array(c, pa.int64()), "own": pa.array(own, pa.int32()),
                "piece": pa.array(piece, pa.binary()),
            })

    return run


# ------------------------------------------------------------------ the job
def _keyed(docs: DataFrame, text: str) -> DataFrame:
    """k1, k2 (128 bits of all columns), text and the columns of ``docs`` as a struct.

    Rows equal in all columns share a key; they are alike in everything that follows.
    """
    kinds = dict(docs.dtypes)
    whole = [F.to_json(F.struct(c)) if "map<" in kinds[c] else F.col(c) for c in docs.columns]
    nulls = F.concat(*[F.col(c).isNull().cast("string") for c in docs.columns])
    return docs.select(
        F.xxhash64(nulls, *whole).alias("k1"), F.xxhash64(*reversed(whole), F.lit(1), nulls).alias("k2"),
        F.col(text).alias("text"), F.struct(*[c for c in docs.columns if c != text], F.lit(0).alias("_")).alias("row"),
    )


def repeated_ranges(keyed: DataFrame, length: int = LENGTH, gram: int = GRAM, group: int = GROUP, bucket: int = BUCKET) -> DataFrame:
    """k1, k2, low, high: ranges of starts (bytes) in the texts whose ``length`` bytes also start elsewhere.

    ``keyed`` has k1, k2 and text. The result still has to be computed, so a query that joins it
    to ``keyed`` shuffles the texts only once.
    """
    hashed = keyed.select("k1", "k2", "text").mapInArrow(_segment_rows(length, gram), _SEGMENTS)
    segments = store(hashed, "segments")
    found = segments.where("h IS NULL").select("k1", "k2", F.col("start").alias("low"), (F.col("start") + F.col("own")).alias("high"))
    rows = segments.where("h IS NOT NULL")
    for width in (32, 1, None):
        common = rows.groupBy("h").agg(F.sum("n").alias("_n")).where("_n > 1").select("h")
        rows = store(rows.join(common, "h", "left_semi"), "common")
        contents = store(
            rows.groupBy("h", "c").agg(F.sum("n").alias("n"), F.min(F.struct("k1", "k2", "start", "own")).alias("rep")), "contents"
        )
        grams = contents.groupBy("h").agg(F.count(F.lit(1)).alias("m"), F.sum(F.col("rep.own") + length - 1).alias("bytes"))
        grams = store(grams.where("m > 1"), "grams")
        # a content that occurs twice is repeated in all its windows
        whole = contents.where("n > 1").select("h", "c", F.lit(0).alias("low"), F.col("rep.own").alias("high"))
        sortable = grams.where(F.col("bytes") <= group).select("h")
        per_doc = contents.join(sortable, "h", "left_semi").groupBy("rep.k1", "rep.k2").agg(
            F.collect_list(F.struct("rep.start", "rep.own", "h", "c")).alias("segs")
        )
        pieces = keyed.join(per_doc, ["k1", "k2"]).mapInArrow(_cut_rows(length), "h long, c long, own int, piece binary")
        dealt = pieces.repartition("h").sortWithinPartitions("h", "c")
        ordered = dealt.mapInArrow(_sort_rows(length, bucket), "h long, c long, low int, high int")
        once = contents.where("n = 1").select("h", "c")
        ranges = whole.unionByName(ordered.join(once, ["h", "c"], "left_semi"))
        found = found.unionByName(
            rows.join(ranges, ["h", "c"]).select(
                "k1", "k2", (F.col("start") + F.col("low")).alias("low"), (F.col("start") + F.col("high")).alias("high")
            )
        )
        large = grams.where(F.col("bytes") > group).select("h")
        if width is None or large.isEmpty():
            return found
        # deal the windows of large groups anew by more of their bytes
        again = rows.join(large, "h", "left_semi").groupBy("k1", "k2").agg(
            F.collect_set(F.struct("start", "own", "lead", "h", "n")).alias("segs")
        )
        split = keyed.select("k1", "k2", "text").join(again, ["k1", "k2"]).mapInArrow(_split_rows(length, width), _SEGMENTS)
        rows = store(split, "segments")
    raise AssertionError("single windows have one content")


ADDED = T.StructType([
    T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType()),
    T.StructField("kept", T.BinaryType()),
])


def _remove_rows(length: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            buf, offsets = text_bytes(batch.column("text"))
            sizes, removed, spans, kept = [], [], [], []
            for low, high, found in zip(offsets[:-1].tolist(), offsets[1:].tolist(), batch.column("spans")):
                text = buf[low:high]
                sizes.append(high - low)
                flat = found.values
                if flat is None or not len(flat):
                    removed.append(0)
                    spans.append(0)
                    kept.append(text.tobytes())
                    continue
                begin = flat.field("low").to_numpy(zero_copy_only=False)
                end = flat.field("high").to_numpy(zero_copy_only=False) + length - 1
                depth = np.zeros(high - low + 1, np.int32)
                np.add.at(depth, begin, 1)
                np.add.at(depth, end, -1)
                gone = np.cumsum(depth[:-1]) > 0
                removed.append(int(gone.sum()))
                spans.append(int((gone & ~np.append(False, gone[:-1])).sum()))
                kept.append(text[~gone].tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("text"), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(spans, pa.int64()), pa.array(kept, pa.binary())],
                ["row", "text", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    return run


def remove_repeats(
    docs: DataFrame, text: str = "text", length: int = LENGTH, gram: int = GRAM, group: int = GROUP, bucket: int = BUCKET
) -> DataFrame:
    """``docs`` with n_bytes, n_removed, n_spans (maximal removed runs) and kept: the bytes that stay, as binary."""
    if not 1 <= gram <= length:
        raise ValueError("a gram has between one byte and the repeat's length")
    keyed = _keyed(docs, text)
    found = repeated_ranges(keyed, length, gram, group, bucket)
    spans = found.groupBy("k1", "k2").agg(F.collect_set(F.struct("low", "high")).alias("spans"))
    shape = T.StructType([keyed.schema["row"], keyed.schema["text"], *ADDED.fields])
    out = keyed.join(spans, ["k1", "k2"], "left").mapInArrow(_remove_rows(length), shape)
    added = ADDED.names
    own = [(F.col("text") if c == text else F.col("row").getField(c)).alias(c) for c in docs.columns if c not in added]
    return out.select(*own, *added)
