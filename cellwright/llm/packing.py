"""Sum-of-squares online packing of documents into token windows.

Every document is tokenized whole and closed with an end id. Full windows are
cut off its front; the rest (less than a window) is placed into the open window
whose fill level makes the sum of squared level counts smallest: with N(h) open
windows at level h, moving one from h to h + s changes the sum by
2 (N(h+s) - N(h) + 1), filling one up by 1 - 2 N(h), opening one by 2 N(s) + 1.
The counts are kept in one array by level; of equal choices the fullest window
is taken. Each partition packs its own documents as they come, so no text moves.

Documents may be cut anywhere: at the end of a partition the windows still open, and
only those, are made full by pouring the emptiest into the gaps of the fullest. What is
left, less than one window a partition, becomes sequences of lengths that are powers of two, which
need no padding. A task holds the ids of its open windows, 16 kB each at most: no more than
the ids of its partition, and few of them where rests of all sizes occur.

Defined results
    null or empty text   only the end id
    null doc_id          packed like any other
    repeated rows        each is packed
    empty table          no rows
    other columns        kept out; doc_id and text are read

Sequence ids are unique, not consecutive. A task that runs again packs the same rows in
the same order, so its sequences are the same, as long as the input is read
from files; store a shuffled input before packing it.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .textbytes import text_slices

WINDOW = 4096
END_ID = 2
#: different words whose ids a worker remembers, before those of one more slice of texts, and the bytes of the longest
REMEMBERED, LONG = 500_000, 48


class WordIds:
    """Ids of texts under a tokenizer of words: lower case, white space dropped, ends of words marked.

    Texts of Latin-1 characters are cut at ASCII white space into pieces, many texts at once; a new
    piece is cut into words by the tokenizer's own pattern, and new words are given
    to the library many at a time: the tokens that end a word tell their ids
    apart. Any other text, or one with a special string, is cut at white space only, and
    the library gets these pieces one by one. Ids of words and pieces of up to ``LONG`` bytes are
    remembered, so what a worker holds is bounded in bytes.
    """

    #: fixed value: how the tokenizer cuts texts into words
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.words_of = regex.compile(self.PATTERN).findall
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.words: dict[str, bytes] = {}
        self.plain: dict[str, bytes] = {}  # pieces of Latin-1 texts, lower-cased
        self.pieces: dict[bytes, bytes] = {}  # pieces of other texts, as they are

    def plain_form(self, text: str) -> str | None:
        """The lower-cased text; None if the library has to see it as it is."""
        if any(s[:2] in text for s in self.special):
            return None
        text = text.lower()
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return None
        return text

    def learn(self, pieces: list[str]) -> None:
        # a piece of letters alone is one word
        cut = [(p,) if p.isalpha() else self.words_of(p) for p in pieces]
        if len(self.words) > REMEMBERED:
            self.words.clear()
        words = list(set(itertools.chain.from_iterable(cut)) - self.words.keys())
        for low in range(0, len(words), 5000):
            part = words[low : low + 5000]
            ids = np.array(self.tokenizer.encode(" ".join(part), add_special_tokens=False).ids, "<u4")
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) != len(part):
                raise ValueError("the tokenizer does not mark the ends of words")
            raw, at = ids.tobytes(), 0
            for word, stop in zip(part, (4 * stops).tolist()):
                self.words[word] = raw[at:stop]
                at = stop
        get = self.words.__getitem__
        self.plain.update((p, get(c[0]) if len(c) == 1 else b"".join(map(get, c))) for p, c in zip(pieces, cut))
        for word in words:
            if len(word) > LONG:
                del self.words[word]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        forms = [self.plain_form(t or "") for t in texts]
        found = iter(self.by_distinct_pieces([f for f in forms if f is not None]))
        return [self.by_pieces(t) if f is None else next(found) for t, f in zip(texts, forms)]

    def by_distinct_pieces(self, texts: list[str]) -> list[bytes]:
        """Ids of lower-cased Latin-1 texts: each different piece is looked up once, its ids copied to every place."""
        if not texts:
            return []
        split = pc.ascii_split_whitespace(pa.array(texts, pa.large_string()))
        coded = split.flatten().dictionary_encode()
        pieces = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.plain) > REMEMBERED:
            self.plain.clear()
        new = [p for p in pieces if p not in self.plain]
        self.learn(new)
        known = [self.plain[p] for p in pieces]
        for piece in new:
            if len(piece) > LONG:
                del self.plain[piece]
        pool = np.frombuffer(b"".join(known), "<u4")
        sizes = np.fromiter(map(len, known), np.int64, len(known)) // 4
        codes = coded.indices.to_numpy()
        lengths, starts = sizes[codes], (np.cumsum(sizes) - sizes)[codes]
        upto = np.concatenate([[0], np.cumsum(lengths)])
        ids = pool[np.repeat(starts - upto[:-1], lengths) + np.arange(upto[-1])]
        edges = upto[split.offsets.to_numpy()].tolist()
        return [ids[low:high].tobytes() for low, high in zip(edges, edges[1:])]

    def by_pieces(self, text: str) -> bytes:
        pieces = text.encode().split()
        new = list(set(pieces) - self.pieces.keys())
        if len(self.pieces) + len(new) > REMEMBERED:
            self.pieces.clear()
            new = list(set(pieces))
        encoded = self.tokenizer.encode_batch_fast([p.decode() for p in new], add_special_tokens=False)
        self.pieces.update((p, np.array(e.ids, "<u4").tobytes()) for p, e in zip(new, encoded))
        found = b"".join(map(self.pieces.__getitem__, pieces))
        for piece in new:
            if len(piece) > LONG:
                del self.pieces[piece]
        return found


_kept: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """The tokenizer of a worker process: read once, and its words stay known from task to task."""
    if path not in _kept:
        _kept.clear()
        _kept[path] = WordIds(path)
    return _kept[path]


class Packer:
    """Places pieces (document, start, ids) into windows of one partition."""

    def __init__(self, first_id: int, window: int = WINDOW):
        self.window, self.next_id = window, first_id
        self.counts = np.zeros(window + 1, np.int64)
        self.open: dict[int, list] = {}  # level -> [(sequence, pieces)]
        self.done: list = []

    def _new(self) -> int:
        self.next_id += 1
        return self.next_id - 1

    def _finish(self, sequence: int, pieces: list) -> None:
        at = 0
        for doc, start, ids in pieces:
            self.done.append((doc, start, ids, sequence, at))
            at += len(ids) // 4

    def _keep(self, level: int, sequence: int, pieces: list) -> None:
        if level == self.window:
            self._finish(sequence, pieces)
        else:
            self.open.setdefault(level, []).append((sequence, pieces))
            self.counts[level] += 1

    def _take(self, level: int):
        self.counts[level] -= 1
        return self.open[level].pop()

    def best_level(self, size: int) -> int:
        """Level of the window to place ``size`` tokens in; 0 opens a new one."""
        counts, top = self.counts, self.window - size
        levels = np.flatnonzero(counts[1 : top + 1])[::-1] + 1
        if not len(levels):
            return 0
        change = 2 * (counts[levels + size] - counts[levels] + 1)
        if levels[0] == top:
            change[0] = 1 - 2 * counts[top]
        best = int(change.argmin())
        return int(levels[best]) if change[best] <= 2 * counts[size] + 1 else 0

    def add(self, doc, ids: bytes) -> None:
        whole = len(ids) // (4 * self.window) * self.window
        for start in range(0, whole, self.window):
            self._finish(self._new(), [(doc, start, ids[4 * start : 4 * (start + self.window)])])
        rest = ids[4 * whole :]
        if not rest:
            return
        size = len(rest) // 4
        level = self.best_level(size)
        sequence, pieces = self._take(level) if level else (self._new(), [])
        pieces.append((doc, whole, rest))
        self._keep(level + size, sequence, pieces)

    def pour(self, most: int) -> None:
        """Empty the lowest windows into the gaps of the highest until at most ``most`` are open."""
        waiting = [(level, *w) for level in sorted(self.open) for w in self.open[level]]
        self.open, self.counts = {}, np.zeros(self.window + 1, np.int64)
        low, high = 0, len(waiting) - 1
        while high - low + 1 > most and low < high:
            level, sequence, pieces = waiting[low]
            to_level, to_sequence, to_pieces = waiting[high]
            doc, start, ids = pieces.pop()
            moved = min(len(ids) // 4, self.window - to_level)
            cut = len(ids) - 4 * moved
            if cut:
                pieces.append((doc, start, ids[:cut]))
            to_pieces.append((doc, start + cut // 4, ids[cut:]))
            waiting[low] = (level - moved, sequence, pieces)
            waiting[high] = (to_level + moved, to_sequence, to_pieces)
            low += level == moved
            high -= to_level + moved == self.window
            if to_level + moved == self.window:
                self._finish(to_sequence, to_pieces)
        for level, sequence, pieces in waiting[low : high + 1]:
            self._keep(level, sequence, pieces)

    def close(self) -> None:
        """Finish every window; the last partial one as sequences of power-of-two lengths."""
        self.pour(1)
        for level in sorted(self.open):
            for _, pieces in self.open[level]:
                queue = list(pieces)
                for bit in reversed(range(level.bit_length())):
                    room, mine = (1 << bit) & level, []
                    while room:
                        doc, start, ids = queue.pop(0)
                        n = min(room, len(ids) // 4)
                        mine.append((doc, start, ids[: 4 * n]))
                        if len(ids) > 4 * n:
                            queue.insert(0, (doc, start + n, ids[4 * n :]))
                        room -= n
                    if mine:
                        self._finish(self._new(), mine)
        self.open, self.counts = {}, np.zeros(self.window + 1, np.int64)


def pack_documents(docs: DataFrame, path: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """doc_id, start, length, ids (little-endian 32-bit), doc_tokens, sequence_id, offset: one row per piece."""
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, packer = word_ids(path), Packer(TaskContext.get().partitionId() << 33, window)
        end, id_type = end_id.to_bytes(4, "little"), None

        def placed() -> pa.RecordBatch:
            rows, packer.done = packer.done, []
            longs = lambda values: pa.array(values, pa.int64())
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0][0] for r in rows], id_type), longs([r[1] for r in rows]),
                    longs([len(r[2]) // 4 for r in rows]), pa.array([r[2] for r in rows], pa.binary()),
                    longs([r[0][1] for r in rows]), longs([r[3] for r in rows]), longs([r[4] for r in rows]),
                ],
                names,
            )

        for part in text_slices(batches):
            id_type = part.column("doc_id").type
            encoded = ids_of.encode(part.column("text").to_pylist())
            for doc, ids in zip(part.column("doc_id").to_pylist(), encoded):
                packer.add((doc, len(ids) // 4 + 1), ids + end)
            if packer.done:
                yield placed()
        packer.close()
        if packer.done:
            yield placed()

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        run, f"doc_id {kind}, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"
    )
