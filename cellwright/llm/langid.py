"""Language identification by a bidirectional gated recurrent network over bytes.

Two gated recurrent layers read the bytes of a text forwards and backwards; at
every byte their states give probabilities of the languages, and a document's
probabilities are the means over its bytes. The network is trained in numpy by
backpropagation through time on the labels of every position of short windows.

Letters of ASCII and Latin-1 are read in lower case. Texts are read in windows of 256 bytes with 16 bytes of context on either side,
so all bytes of a text are labelled, whatever its length, and many windows are worked
on side by side.

What is learned from: of each language, at most ``PER_LANGUAGE`` documents with a
known language (chosen by a hash of their id) and of each of these a passage of
at most ``PASSAGE`` characters. Only texts and languages are used.

Defined results
    null text, or no letter   ``und``, score 0
    nothing to learn from     ``und``, score 0, for every row
    one language only         that language
    null doc_id, repeats      each row is judged by its text
    empty table               no rows
    other columns             kept out by ``identify``, passed on by ``keep_identified``
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import StructType

from . import gru
from .textbytes import LOWER, text_bytes, text_slices

UNKNOWN = "und"
UNITS = 8
CORE, CONTEXT = 256, 16
LANES = 1024
PER_LANGUAGE = 150
PASSAGE = 1024
#: how far from chance to certainty a score has to come before the pipeline counts a language as identified
LEAST_SHARE = 1 / 15
_LETTER = regex.compile(r"\p{L}")


def held_out(doc_id: Column) -> Column:
    """Rows that nothing is learned from: crc32 of the id's digits, modulo 3, is 1."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_rows(docs: DataFrame) -> list[tuple[str, str]]:
    """(passage, language): the bounded sample that is learned from."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    ids = known.select("doc_id", "lang").withColumn("_at", F.row_number().over(order)).where(F.col("_at") <= PER_LANGUAGE)
    chosen = [r["doc_id"] for r in ids.select("doc_id").collect()]
    if not chosen:
        return []
    span = F.greatest(F.length("text") - PASSAGE, F.lit(1))
    at = F.pmod(F.xxhash64("doc_id", F.lit(1)), span).cast("int") + 1
    rows = known.where(F.col("doc_id").isin(chosen)).select(F.substring("text", at, F.lit(PASSAGE)).alias("text"), "lang")
    # an id may have many rows: as many as there are ids are enough
    return [(r["text"], r["lang"]) for r in rows.limit(2 * len(chosen)).collect()]


def fold_case(buf: np.ndarray) -> np.ndarray:
    """Lower case for A-Z and for the two-byte letters from À to Þ."""
    out = LOWER[buf]
    if len(out) > 1:
        second = out[1:]
        second[(out[:-1] == 0xC3) & (second >= 0x80) & (second < 0x9F) & (second != 0x97)] += 32
    return out


class LanguageNet:
    """Byte tables, recurrent weights and position labels of both directions."""

    def __init__(self, languages: list[str], params: dict[str, np.ndarray]):
        self.languages, self.params = languages, params

    @staticmethod
    def _inputs(table: np.ndarray, symbols: np.ndarray):
        return lambda t: table.take(symbols[t], axis=1)

    def states(self, symbols: np.ndarray, keep: bool = False):
        """Both directions' states for symbols (steps, lanes); 256 is no byte."""
        n = len(symbols)
        p = self.params
        there = gru.forward(self._inputs(p["in_f"], symbols), p["u_f"], n, keep)
        back = gru.forward(self._inputs(p["in_b"], symbols[::-1]), p["u_b"], n, keep)
        return there, back

    def label(self, symbols: np.ndarray) -> np.ndarray:
        """Probabilities (steps, languages, lanes) at every position."""
        there, back = self.states(symbols)
        p = self.params
        logits = np.matmul(p["out_f"], there)
        logits += np.matmul(p["out_b"], back[::-1])
        logits += p["bias"][:, None]
        logits -= logits.max(axis=1, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=1, keepdims=True)
        return logits


def train(rows: list[tuple[str, str]], units: int = UNITS, steps: int = 260, length: int = 64, lanes: int = 192) -> LanguageNet | None:
    """Fit a network to (passage, language) rows; None without rows."""
    languages = sorted({lang for _, lang in rows})
    by = [[fold_case(np.frombuffer(t.encode(), np.uint8)) for t, own in rows if own == lang and t] for lang in languages]
    if not any(by):
        return None
    rng = np.random.default_rng(7)
    n = len(languages)

    def table():
        x = rng.standard_normal((3 * units, 257)) * 0.3
        x[: 2 * units] += 0.5
        x[:, 256] = 0
        x[:units, 256] = gru.PAD
        return x.astype(np.float32)

    params = {"in_f": table(), "u_f": gru.start(units, rng), "in_b": table(), "u_b": gru.start(units, rng)}
    params |= {k: (rng.standard_normal((n, units)) * 0.3).astype(np.float32) for k in ("out_f", "out_b")}
    params["bias"] = np.zeros(n, np.float32)
    net = LanguageNet(languages, params)
    optimizer = gru.Adam(params, 0.02)
    usable = [i for i in range(n) if by[i]]
    for step in range(steps):
        optimizer.rate = 0.02 * (1 - step / steps) + 0.001
        symbols = np.full((length, lanes), 256)
        target = rng.choice(usable, lanes)
        for lane, lang in enumerate(target):
            text = by[lang][rng.integers(len(by[lang]))]
            at = rng.integers(max(len(text) - length, 0) + 1)
            symbols[: min(length, len(text)), lane] = text[at : at + length]
        (there, saved_f), (back, saved_b) = net.states(symbols, keep=True)
        back = back[::-1]
        logits = params["out_f"] @ there + params["out_b"] @ back + params["bias"][:, None]
        logits -= logits.max(axis=1, keepdims=True)
        e = np.exp(logits)
        d = e / e.sum(axis=1, keepdims=True)
        d[:, target, np.arange(lanes)] -= 1
        d *= (symbols != 256)[:, None, :] / max((symbols != 256).sum(), 1)
        d = d.astype(np.float32)
        grads = {
            "out_f": np.einsum("tcb,thb->ch", d, there), "out_b": np.einsum("tcb,thb->ch", d, back), "bias": d.sum(axis=(0, 2)),
        }
        for way, dstates, saved, order in (
            ("f", params["out_f"].T @ d, saved_f, symbols), ("b", (params["out_b"].T @ d)[::-1], saved_b, symbols[::-1]),
        ):
            dx, grads[f"u_{way}"] = gru.backward(dstates, saved, params[f"u_{way}"])
            flat, dtable = order.ravel(), np.zeros((257, 3 * units), np.float32)
            np.add.at(dtable, flat, dx.transpose(0, 2, 1).reshape(len(flat), -1))
            dtable[256] = 0
            grads[f"in_{way}"] = np.ascontiguousarray(dtable.T)
        optimizer.step(grads)
    return net


def document_probabilities(net: LanguageNet, buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(texts, languages): means of the probabilities at all bytes of each text."""
    sizes = np.diff(offsets)
    windows = -(-sizes // CORE)
    doc = np.repeat(np.arange(len(sizes)), windows)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(windows) - windows, windows)
    first = offsets[doc] + nth * CORE
    totals = np.zeros((len(sizes), len(net.languages)))
    steps = np.arange(-CONTEXT, CORE + CONTEXT)[:, None]
    # beyond the ends of the slice lies no byte
    padded = np.full(len(buf) + CORE + 2 * CONTEXT, 256, np.int16)
    padded[CONTEXT : CONTEXT + len(buf)] = fold_case(buf)
    for low in range(0, len(doc), LANES):
        own, at = doc[low : low + LANES], first[low : low + LANES] + steps
        inside = (at >= offsets[own]) & (at < offsets[own + 1])
        symbols = padded[at + CONTEXT]
        symbols[~inside] = 256
        found = net.label(symbols)[CONTEXT : CONTEXT + CORE]
        # only whole-window sums leave the positions
        weight = inside[CONTEXT : CONTEXT + CORE].astype(np.float32)
        np.add.at(totals, own, np.einsum("tcb,tb->bc", found, weight))
    return totals / np.maximum(sizes, 1)[:, None]


def _judge(net: LanguageNet | None, texts: pa.Array) -> tuple[list[str], np.ndarray]:
    if net is None:
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    letters = [bool(t) and _LETTER.search(t) is not None for t in texts.to_pylist()]
    p = document_probabilities(net, *text_bytes(texts))
    best = p.argmax(axis=1)
    score = np.where(letters, np.clip(p[np.arange(len(p)), best], 0, 1), 0.0)
    return [net.languages[b] if ok else UNKNOWN for b, ok in zip(best, letters)], score


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column is called so."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name = "_" + name
    return name


def _predict(docs: DataFrame, net: LanguageNet | None, lang: str, score: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            langs, scores = _judge(net, pc.cast(part.column("text"), pa.string()))
            columns = [*part.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, [*part.schema.names, lang, score])

    schema = StructType(list(docs.schema.fields)).add(lang, "string").add(score, "double")
    return docs.mapInArrow(run, schema)


def identify(docs: DataFrame, learn_from: DataFrame | None = None) -> DataFrame:
    """doc_id, lang_pred, score of every row; trained on ``learn_from`` (default: the labelled rows of ``docs``)."""
    net = train(training_rows(docs if learn_from is None else learn_from))
    return _predict(docs.select("doc_id", "text"), net, "lang_pred", "score").drop("text")


def least_score(languages: int, share: float = LEAST_SHARE) -> float:
    """The score that is ``share`` of the way from chance (one in ``languages``) to certainty: 0.3 for four languages."""
    return 1 / languages + share * (1 - 1 / languages)


def keep_identified(docs: DataFrame, share: float = LEAST_SHARE) -> DataFrame:
    """Documents in an identified language, with all their columns; all of them if no row has a language to learn."""
    net = train(training_rows(docs))
    if net is None:
        return docs
    lang, score = free_name(docs, "lang_pred"), free_name(docs, "lang_score")
    judged = _predict(docs, net, lang, score)
    return judged.where((F.col(lang) != UNKNOWN) & (F.col(score) >= least_score(len(net.languages), share))).drop(lang, score)
