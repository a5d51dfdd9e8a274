"""Words of many texts at once, as numpy arrays over their UTF-8 bytes."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: bytes of text worked on at a time; a longer text is a slice of its own
SLICE = 2 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: letters and digits of ASCII and every byte of a longer character
WORD_BYTES = np.zeros(256, bool)
for _low, _high in ((48, 58), (65, 91), (97, 123), (128, 256)):
    WORD_BYTES[_low:_high] = True

_P = 0x9E3779B97F4A7C15
_P_INVERSE = pow(_P, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}


def text_slices(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = SLICE) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most about ``limit`` bytes of text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        cut = np.flatnonzero(np.diff((np.cumsum(sizes) - sizes) // limit)) + 1
        edges = [0, *cut.tolist(), batch.num_rows]
        for low, high in zip(edges, edges[1:]):
            yield batch.slice(low, high - low)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string array; null counts as empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    if data is None or offsets[0] == offsets[-1]:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_spans(buf: np.ndarray, offsets: np.ndarray, table: np.ndarray = WORD_BYTES):
    """(start, end, text number) of each maximal run of ``table`` bytes; no word goes over a text's end."""
    inside = table[buf]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    begins = offsets[:-1][offsets[:-1] < offsets[1:]]
    finals = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    first[begins] = inside[begins]
    last[finals] = inside[finals]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def _power(kind: str, base: int, n: int) -> np.ndarray:
    known = _powers.get(kind)
    if known is None or len(known) < n:
        steps = np.full(max(n, SLICE + 1), base, np.uint64)
        steps[0] = 1
        known = np.multiply.accumulate(steps)
        if n <= SLICE + 1:
            _powers[kind] = known
    return known[:n]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of ``buf``, the same wherever the span stands."""
    n = len(buf)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * _power("up", _P, n + 1)[:n], out=sums[1:])
    h = (sums[ends] - sums[starts]) * _power("down", _P_INVERSE, n + 1)[starts]
    return mix(h + (ends - starts).astype(np.uint64))


def shingles(words: np.ndarray, texts: np.ndarray, size: int):
    """(hash, first word, words) of each run of ``size`` words of a text; of all words where a text has fewer."""
    out = []
    for n in range(1, size + 1):
        if len(words) < n:
            break
        ok = texts[: len(texts) - n + 1] == texts[n - 1 :]
        if n < size:  # only whole texts of n words
            ok[1:] &= texts[1 : len(ok)] != texts[: len(ok) - 1]
            ok[: len(texts) - n] &= texts[: len(texts) - n] != texts[n:]
        at = np.flatnonzero(ok)
        h = words[at]
        for j in range(1, n):
            h = h * np.uint64(0x2545F4914F6CDD1D) + words[at + j]
        out.append((mix(h + np.uint64(n)), at, np.full(len(at), n)))
    if not out:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*out))
