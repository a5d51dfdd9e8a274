"""Toxicity by a bidirectional gated recurrent network with attention pooling.

A step is a word (A-Z lower-cased; runs of ASCII letters, digits and characters beyond
ASCII). Its input joins a word vector, the sum of what training knows of the whole
word, of its first four and six and of its last four bytes, with a
character vector, the mean of the vectors of its byte pairs. Two gated recurrent
layers read a window of words forwards and backwards, attention over their states pools
the window into one vector and that gives the window's score. Windows of 32 words
start at every 16th word, so every word of a text lies in two windows; a document's
score is that of its highest window.

Trained in numpy by backpropagation through time. A label says only that
something in a document is toxic, so after a first phase on random windows the
positive examples are each toxic document's highest window so far, the negative
ones random and highest windows of the others.

What is learned from: at most ``PER_CLASS`` labelled documents of either class (chosen
by a hash of their id), and ``CLEAN_MORE`` times as many clean ones to set the scores' scale, and of each a passage of at most ``PASSAGE`` characters.

Defined results
    null or wordless text   score 0
    nothing to learn from, or one class only   score 0 for every row
    null label              not learned from
    null doc_id, repeats    each row is scored by its text
    empty table             no rows
    other columns           kept out by ``score_toxicity``, passed on by ``drop_toxic``
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from . import gru
from .langid import free_name, held_out
from .textbytes import LOWER, text_bytes, text_slices, word_hashes, word_spans

UNITS = 8
SIZE = 8  # of a word vector and of a character vector
SPAN, STRIDE = 32, 16
LANES = 2048
#: words whose vectors are held at once; a slice of texts to be scored has fewer
RUN = 1 << 18
PAIRS = 4096
#: bytes of a word's beginnings and of its ending that are looked up like words
BEGINNINGS, ENDING = (4, 6), 4
PER_CLASS = 600
PASSAGE = 6000
#: training documents that hold a word of the vocabulary, at least
LEAST_SEEN = 6
#: of the sample, every so many-th document is kept from training, to set the scores' scale,
#: and so many clean ones for each of ``PER_CLASS`` are only for that
CALIBRATE, CLEAN_MORE = 4, 2
DECAY = 0.02
TOXIC = 0.7


def training_rows(docs: DataFrame, labels: DataFrame) -> list[tuple[str, int]]:
    """(passage, label): the bounded sample that is learned from."""
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    # a label may be of a document that is not here
    known = known.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    label = {}
    for y in (0, 1):  # the first so many of a class by hash, found in each task before they meet
        first = known.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(PER_CLASS * (1 if y else 1 + CLEAN_MORE))
        label |= {r["doc_id"]: y for r in first.collect()}
    if len(set(label.values())) < 2:
        return []
    span = F.greatest(F.length("text") - PASSAGE, F.lit(1))
    at = F.pmod(F.xxhash64("doc_id", F.lit(2)), span).cast("int") + 1
    rows = docs.where(F.col("doc_id").isin(list(label)) & F.col("text").isNotNull()).select(
        "doc_id", F.substring("text", at, F.lit(PASSAGE)).alias("text")
    )
    found = sorted((r["doc_id"], r["text"]) for r in rows.limit(2 * len(label)).collect())
    return [(t, label[d]) for d, t in found]


class Words:
    """Words of some texts: hash, byte pairs, and the windows over them."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray):
        buf = LOWER[buf]
        starts, ends, doc = word_spans(buf, offsets)
        self.texts = len(offsets) - 1
        self.hashes = word_hashes(buf, starts, ends)
        # the word, its beginnings, its ending: (4, words)
        self.marks = np.stack([
            self.hashes,
            *(word_hashes(buf, starts, np.minimum(starts + n, ends)) ^ np.uint64(0x5BD1E995 + n) for n in BEGINNINGS),
            word_hashes(buf, np.maximum(ends - ENDING, starts), ends) ^ np.uint64(0x1B873593),
        ])
        # byte pairs of each word: (mark, first), (first, second), ..., (last, mark)
        sizes = ends - starts
        self.first = np.cumsum(sizes + 1) - (sizes + 1)
        inside = np.zeros(len(buf) + 1, np.int8)
        inside[starts] += 1
        inside[ends] -= 1
        # the bytes of all words, a zero after each: a pair's right byte, and the left one of the next pair
        right = np.zeros(int(sizes.sum()) + len(sizes), np.uint8)
        own = np.ones(len(right), bool)
        own[self.first + sizes] = False
        right[own] = buf[np.cumsum(inside, dtype=np.int8)[:-1] == 1]
        pairs = right.astype(np.int32) * 31
        pairs[1:] += right[:-1].astype(np.int32) * 263
        self.pairs = (pairs % PAIRS).astype(np.uint16)
        self.sizes = sizes + 1
        counts = np.bincount(doc, minlength=self.texts)
        self.begin = begin = np.cumsum(counts) - counts
        windows = np.where(counts > 0, 1 + np.maximum(-(-(counts - SPAN) // STRIDE), 0), 0)
        self.doc = np.repeat(np.arange(self.texts), windows)
        nth = np.arange(len(self.doc)) - np.repeat(np.cumsum(windows) - windows, windows)
        self.low = begin[self.doc] + nth * STRIDE
        self.high = np.minimum(self.low + SPAN, begin[self.doc] + counts[self.doc])

    def places(self, windows: np.ndarray) -> np.ndarray:
        """(SPAN, windows): word numbers, or the number of words where a window has ended."""
        at = self.low[windows] + np.arange(SPAN)[:, None]
        return np.where(at < self.high[windows], at, len(self.hashes))


class ToxicityNet:
    def __init__(self, vocabulary: np.ndarray, params: dict[str, np.ndarray], scale: tuple[float, float] = (1.0, 0.0)):
        self.vocabulary, self.params, self.scale = vocabulary, params, scale

    def word_ids(self, marks: np.ndarray) -> np.ndarray:
        """(4, words): places in the vocabulary, its size for what is not in it."""
        n = len(self.vocabulary)
        if not n:
            return np.zeros(marks.shape, np.int64)
        at = np.searchsorted(self.vocabulary, marks)
        return np.where(self.vocabulary[np.minimum(at, n - 1)] == marks, at, n)

    def vectors(self, words: Words, start: int, stop: int) -> np.ndarray:
        """(2 SIZE, stop - start + 1): joined word and character vectors; the last column is for ended windows."""
        p = self.params
        out = np.zeros((2 * SIZE, stop - start + 1), np.float32)
        if stop > start:
            for ids in self.word_ids(words.marks[:, start:stop]):
                out[:SIZE, :-1] += p["word"][ids].T
            low = words.first[start]
            pairs = words.pairs[low : words.first[stop - 1] + words.sizes[stop - 1]]
            sums = np.add.reduceat(p["char"][pairs], words.first[start:stop] - low)
            out[SIZE:, :-1] = (sums / words.sizes[start:stop, None]).T
        return out

    def inputs(self, vectors: np.ndarray, way: str) -> np.ndarray:
        x = self.params[f"in_{way}"] @ vectors + self.params[f"b_{way}"][:, None]
        x[:UNITS, -1] = gru.PAD
        return x

    def pool(self, states: np.ndarray, ended: np.ndarray):
        """Attention weights (steps, lanes), pooled states, logits."""
        p = self.params
        e = np.matmul(p["look"], states)
        e[ended] = -1e9
        e -= e.max(axis=0)
        np.exp(e, out=e)
        e /= e.sum(axis=0)
        pooled = np.einsum("tb,thb->hb", e, states)
        return e, pooled, p["out"] @ pooled + p["bias"][0]

    def window_logits(self, words: Words) -> np.ndarray:
        out = np.empty(len(words.doc), np.float32)
        upto = 0
        for low in range(0, len(out), LANES):
            at = words.places(np.arange(low, min(low + LANES, len(out))))
            ended = at == len(words.hashes)
            if low == upto:  # vectors of a run of words: however many texts, as much is held at once
                start = words.low[low]
                upto = int(np.searchsorted(words.high, start + RUN, "right"))
                upto = len(out) if upto == len(out) else max(upto - upto % LANES, low + LANES)
                stop = words.high[min(upto, len(out)) - 1]
                vectors = self.vectors(words, start, stop)
                x_f, x_b = self.inputs(vectors, "f"), self.inputs(vectors, "b")
            at = np.where(ended, stop, at) - start
            back_at = at[::-1]
            there = gru.forward(lambda t: x_f.take(at[t], axis=1), self.params["u_f"], SPAN)
            back = gru.forward(lambda t: x_b.take(back_at[t], axis=1), self.params["u_b"], SPAN)[::-1]
            states = np.concatenate([there, back], axis=1)
            out[low : low + LANES] = self.pool(states, ended)[2]
        return out

    def document_logits(self, words: Words, windows: np.ndarray | None = None) -> np.ndarray:
        """Highest window of each text; -inf without words."""
        out = np.full(words.texts, -np.inf)
        np.maximum.at(out, words.doc, self.window_logits(words) if windows is None else windows)
        return out

    def scores(self, words: Words) -> np.ndarray:
        a, b = self.scale
        return 1 / (1 + np.exp(-np.clip(a * self.document_logits(words) + b, -60, 60))) * (np.bincount(words.doc, minlength=words.texts) > 0)


def train(rows: list[tuple[str, int]], steps: int = 320, half: int = 64) -> ToxicityNet | None:
    """Fit a network to (passage, label) rows; None without both labels."""
    rows = [r for r in rows if r[0]]
    bad, good = ([r for r in rows if r[1] == y] for y in (1, 0))
    own, more = good[:PER_CLASS], good[PER_CLASS:]
    apart = [*bad[::CALIBRATE], *own[::CALIBRATE], *more]
    learned = [r for part in (bad, own) for k, r in enumerate(part) if k % CALIBRATE]
    if len({y for _, y in apart}) == 2 == len({y for _, y in learned}):
        rows = learned
    else:  # too few to keep any from training
        apart = rows
    words = Words(*text_bytes(pa.array([t for t, _ in rows], pa.string())))
    label = np.array([y for _, y in rows], np.int64)
    toxic = label[words.doc] == 1 if len(words.doc) else np.zeros(0, bool)
    if not toxic.any() or toxic.all():
        return None
    rng = np.random.default_rng(11)
    ends = np.append(words.begin[1:], len(words.hashes))
    known, times = np.unique(
        np.concatenate([np.unique(words.marks[:, low:high]) for low, high in zip(words.begin, ends)]), return_counts=True
    )
    vocabulary = known[times >= LEAST_SEEN]
    normal = lambda *shape, by=0.3: (rng.standard_normal(shape) * by).astype(np.float32)
    params = {"word": normal(len(vocabulary) + 1, SIZE, by=0.1), "char": normal(PAIRS, SIZE, by=0.2)}
    params["word"][-1] = 0  # unknown words speak by their characters only
    for way in "fb":
        params |= {f"in_{way}": normal(3 * UNITS, 2 * SIZE), f"u_{way}": gru.start(UNITS, rng)}
        params[f"b_{way}"] = np.repeat(np.array([0.5, 0.5, 0], np.float32), UNITS)
    params |= {"look": normal(2 * UNITS), "out": normal(2 * UNITS), "bias": np.zeros(1, np.float32)}
    net = ToxicityNet(vocabulary, params)
    optimizer = gru.Adam(params, 0.02)
    ids = net.word_ids(words.marks)
    positive, negative = np.flatnonzero(toxic), np.flatnonzero(~toxic)
    hard = negative
    for step in range(steps):
        optimizer.rate = 0.02 * (1 - step / steps) + 0.002
        if step >= steps // 3 and (step - steps // 3) % 40 == 0:
            logits = net.window_logits(words)
            order = np.lexsort((-logits, words.doc))
            top = order[np.unique(words.doc[order], return_index=True)[1]]
            positive, hard = top[toxic[top]], top[~toxic[top]]
        chosen = np.concatenate([rng.choice(positive, half), rng.choice(negative, half // 2), rng.choice(hard, half // 2)])
        y = toxic[chosen].astype(np.float32)
        at = words.places(chosen)
        # only the words of these windows
        used, local = np.unique(at, return_inverse=True)
        local = local.reshape(at.shape)
        ended = at == len(words.hashes)
        real = used[used < len(words.hashes)]
        spots = np.repeat(words.first[real], words.sizes[real]) + (
            np.arange(words.sizes[real].sum()) - np.repeat(np.cumsum(words.sizes[real]) - words.sizes[real], words.sizes[real])
        )
        pairs, owner = words.pairs[spots], np.repeat(np.arange(len(real)), words.sizes[real])
        share = (1 / words.sizes[real]).astype(np.float32)
        vectors = np.zeros((2 * SIZE, len(used) + (not ended.any())), np.float32)
        vectors[:SIZE, : len(real)] = params["word"][ids[:, real]].sum(axis=0).T
        sums = np.zeros((len(real), SIZE), np.float32)
        np.add.at(sums, owner, params["char"][pairs])
        vectors[SIZE:, : len(real)] = (sums * share[:, None]).T
        kept, states = {}, []
        for way, order in (("f", local), ("b", local[::-1])):
            x = net.inputs(vectors, way)
            found, saved = gru.forward(lambda t, x=x, order=order: x.take(order[t], axis=1), params[f"u_{way}"], SPAN, keep=True)
            kept[way] = saved
            states.append(found if way == "f" else found[::-1])
        states = np.concatenate(states, axis=1)
        look, pooled, logit = net.pool(states, ended)
        d = (1 / (1 + np.exp(-logit)) - y) / len(y)
        d = d.astype(np.float32)
        dpooled = params["out"][:, None] * d
        dlook = np.einsum("hb,thb->tb", dpooled, states)
        de = look * (dlook - (look * dlook).sum(axis=0))
        dstates = look[:, None, :] * dpooled[None] + de[:, None, :] * params["look"][None, :, None]
        grads = {"out": pooled @ d, "bias": np.array([d.sum()], np.float32), "look": np.einsum("tb,thb->h", de, states)}
        dvectors = np.zeros_like(vectors)
        for way, down, order in (("f", dstates[:, :UNITS], local), ("b", dstates[::-1, UNITS:], local[::-1])):
            dx, grads[f"u_{way}"] = gru.backward(down, kept[way], params[f"u_{way}"])
            per_word = np.zeros((vectors.shape[1], 3 * UNITS), np.float32)
            np.add.at(per_word, order.ravel(), dx.transpose(0, 2, 1).reshape(order.size, -1))
            per_word[len(real) :] = 0
            grads[f"in_{way}"], grads[f"b_{way}"] = per_word.T @ vectors.T, per_word.sum(axis=0)
            dvectors += params[f"in_{way}"].T @ per_word.T
        grads["word"], grads["char"] = np.zeros_like(params["word"]), np.zeros_like(params["char"])
        for mark in ids[:, real]:
            np.add.at(grads["word"], mark, dvectors[:SIZE, : len(real)].T)
        grads["word"][-1] = 0
        np.add.at(grads["char"], pairs, (dvectors[SIZE:, : len(real)].T * share[:, None])[owner])
        optimizer.step(grads)
        for name in ("word", "char"):  # what rarely occurs stays small
            params[name] *= 1 - DECAY * optimizer.rate
    del words, ids  # what is learned from is no longer needed
    held = Words(*text_bytes(pa.array([t for t, _ in apart], pa.string())))
    net.scale = _calibrate(net.document_logits(held), np.array([y for _, y in apart]))
    return net


def _calibrate(logits: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and shift: a logistic fit of the documents' highest windows gives the slope.

    The shift puts ``TOXIC`` in the middle of the cuts that err least, a clean
    document above the cut counting as much as six toxic ones below it: the sample
    has as many of either, but most documents are clean.
    """
    ok = np.isfinite(logits)
    x, y = np.clip(logits[ok], -20, 20), label[ok].astype(float)
    a, b = 1.0, 0.0
    for _ in range(500):
        p = 1 / (1 + np.exp(-(a * x + b)))
        a -= 0.05 * (((p - y) * x).mean() + 0.001 * (a - 1))
        b -= 0.05 * (p - y).mean()
    a = max(a, 0.1)
    order = np.argsort(x)
    x, y = x[order], y[order]
    missed = np.concatenate([[0], np.cumsum(y)]) / max(y.sum(), 1)
    wrong = ((1 - y).sum() - np.concatenate([[0], np.cumsum(1 - y)])) / max((1 - y).sum(), 1)
    cost = missed + 6 * wrong
    best = np.flatnonzero(cost <= cost.min() + 1e-9)
    edges = np.concatenate([[x[0] - 1], x, [x[-1] + 1]])
    cut = (edges[best[0]] + edges[best[-1] + 1]) / 2
    return float(a), float(np.log(TOXIC / (1 - TOXIC)) - a * cut)


def _predict(docs: DataFrame, net: ToxicityNet | None, score: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, limit=1 << 20):
            texts = pc.cast(part.column("text"), pa.string())
            scores = np.zeros(len(texts)) if net is None else net.scores(Words(*text_bytes(texts)))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scores, pa.float64())], [*part.schema.names, score])

    return docs.mapInArrow(run, StructType(list(docs.schema.fields)).add(score, "double"))


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, score of every row."""
    net = train(training_rows(docs, labels))
    return _predict(docs.select("doc_id", "text"), net, "score").drop("text")


def drop_toxic(docs: DataFrame, labels: DataFrame, least: float = TOXIC) -> DataFrame:
    """Documents scored below ``least``, with all their columns."""
    net = train(training_rows(docs, labels))
    score = free_name(docs, "toxicity")
    return _predict(docs, net, score).where(F.col(score) < least).drop(score)
