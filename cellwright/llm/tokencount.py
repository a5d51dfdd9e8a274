"""Token counts by a finite-state transducer compiled from a byte-level BPE vocabulary.

Merging is a left-to-right machine: the encoding of a prefix ends in exactly one
token t, and it is the encoding of the prefix without t, followed by t, where t
and the token before it form a pair that merging leaves apart. What follows
can only depend on the longest suffix that some token still starts with, and on
the token ending at each place in it where a token could start. These make the (finitely many) states; a transition on
a byte carries the change of the number of tokens. States and transitions are
compiled when first needed and flushed when too many.

A text is cut into chunks. A chunk's state map takes whatever is pending
before it to what is pending after it and the tokens counted between: it
keeps the chunk's head up to its first synchronizing place (white space after
something else, where every machine state meets), the count up to the last such
place, and its tail. Maps of neighbours compose, and a document's total is their
composition by a parallel scan (pairs, pairs of pairs, ...).

Defined results
    null or empty text   0 tokens, 0 bytes
    special strings      one token each, as the library counts them by default
    repeated rows        each is returned
    empty table          no rows
    other columns        kept out; doc_id and text are read
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from .textbytes import text_slices

#: fixed value: the public pattern that splits text before merging
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CHUNK = 1 << 14
MOST_STATES = 400_000
#: pieces and words whose count a worker remembers, and the characters of the longest
MOST_WORDS, LONG = 500_000, 48
#: marks that are a piece of their own after letters at the end of a run
MARKS = frozenset(".,;:!?")
#: stands for the count of a run that does not end at a synchronizing place; more than any text has tokens
OPEN = 1 << 48


_BYTES = [bytes((b,)) for b in range(256)]


def _byte_letters() -> dict[str, int]:
    """The letter a byte is written as in the vocabulary file: itself if printable, else 256 and up."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in plain}
    rest = [b for b in range(256) if b not in set(plain)]
    return out | {chr(256 + i): b for i, b in enumerate(rest)}


class State(dict):
    """byte -> (next state, change of the number of tokens); compiled on first use."""

    __slots__ = ("machine", "tail", "lasts", "counts")

    def __missing__(self, byte: int):
        found = self.machine.compile(self, byte)
        self[byte] = found
        return found


class Transducer:
    """Counts tokens of one piece of the split pattern, byte by byte."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = _byte_letters()
        raw = lambda s: bytes(letters[c] for c in s)
        special = {t["content"] for t in spec["added_tokens"]}
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.tokens = {raw(t) for t in spec["model"]["vocab"] if t not in special}
        pairs = (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"])
        self.ranks = {(raw(a), raw(b)): i for i, (a, b) in enumerate(pairs)}
        #: every beginning of a token, and whether it is one itself
        self.kinds = {t[:n]: False for t in self.tokens for n in range(1, len(t))}
        self.kinds.update(dict.fromkeys(self.tokens, True))
        self.apart: dict[tuple[bytes, bytes], bool] = {}
        # the merge that makes a token, and its rank; single bytes are made by none
        self.halves = {a + b: (a, b) for a, b in self.ranks}
        self.made = {a + b: i for (a, b), i in self.ranks.items()}
        made = self.made.get
        #: every token is made by one merge, after those that make its halves
        self.ordered = len(self.halves) == len(self.ranks) and all(
            (len(a) == 1 or made(a, 1 << 60) < i) and (len(b) == 1 or made(b, 1 << 60) < i) for (a, b), i in self.ranks.items()
        )
        self.flush()

    def flush(self) -> None:
        self.states: dict[tuple, State] = {}
        self.start = self.state(b"", (None,), (0,))

    def merge(self, text: bytes) -> list[bytes]:
        """Tokens of a short text by the merge rules; used to compile, not to count."""
        parts = [text[i : i + 1] for i in range(len(text))]
        while len(parts) > 1:
            ranked = [self.ranks.get(p, 1 << 60) for p in zip(parts, parts[1:])]
            low = min(ranked)
            if low == 1 << 60:
                break
            i, merged = 0, []
            while i < len(parts):
                if i < len(ranked) and ranked[i] == low and self.ranks.get((parts[i], parts[i + 1])) == low:
                    merged.append(parts[i] + parts[i + 1])
                    i += 2
                else:
                    merged.append(parts[i])
                    i += 1
            parts = merged
        return parts

    def stays(self, before: bytes | None, token: bytes) -> bool:
        """Whether ``token`` can follow ``before`` (None: begin a piece) in an encoding."""
        key = (before or b"", token)
        known = self.apart.get(key)
        if known is None:
            if before and self.ordered:
                known = self.stays(None, token) and not self.joins(before, token)
            else:
                known = self.merge(key[0] + token) == ([before, token] if before else [token])
            self.apart[key] = known
        return known

    def joins(self, a: bytes, b: bytes) -> bool:
        """Whether a merge goes over the border of two tokens that are each their own encoding.

        Merges go by rank, so taking the later made of the two parts at the border apart, again and again, gives the
        parts that meet there at any time. These are merged if that comes before either is merged on its own side;
        of equal merges the left one comes first.
        """
        made, least_a, least_b = self.made, 1 << 60, 1 << 60
        while True:
            rank = self.ranks.get((a, b))
            if rank is not None and rank < least_a and rank <= least_b:
                return True
            ra, rb = made.get(a, -1), made.get(b, -1)
            if ra > rb:
                least_a, a = ra, self.halves[a][1]
            elif rb >= 0:
                least_b, b = rb, self.halves[b][0]
            else:
                return False

    def state(self, tail: bytes, lasts: tuple, counts: tuple) -> State:
        key = (tail, lasts, counts)
        found = self.states.get(key)
        if found is None:
            found = State()
            found.machine, found.tail, found.lasts, found.counts = self, tail, lasts, counts
            self.states[key] = found
        return found

    def compile(self, state: State, byte: int) -> tuple[State, int]:
        text = state.tail + _BYTES[byte]
        n, kind, apart, old = len(text), self.kinds.get, self.apart.get, state.lasts
        token, keep, live = None, n, []
        for p in range(n):
            before = old[p]
            if before is False:  # no token starts there, so no longer one does
                continue
            part = text[p:]
            found = kind(part)
            if found is not None:
                if keep == n:
                    keep = p
                live.append(p)
                if found and token is None:
                    known = apart((before or b"", part))
                    if known or (known is None and self.stays(before, part)):
                        token, count = part, state.counts[p] + 1
        if token is None:
            token, count = text[n - 1 :], state.counts[n - 1] + 1
        # places where no token can start any more are all alike
        lasts, counts = [False] * (n - keep), [0] * (n - keep)
        for p in live:
            lasts[p - keep] = old[p]
            counts[p - keep] = state.counts[p] - count
        return self.state(text[keep:], (*lasts, token), (*counts, 0)), count

    def count(self, piece: bytes) -> int:
        if len(self.states) > MOST_STATES:
            self.flush()
        if len(self.apart) > 4 * MOST_WORDS:
            self.apart.clear()
        state, n = self.start, 0
        for byte in piece:
            state, change = state[byte]
            n += change
        return n


@dataclass(frozen=True, slots=True)
class ChunkMap:
    """State map of a chunk; without a synchronizing place all of it is ``head`` and ``tail`` is None."""

    head: str
    count: int
    tail: str | None


class Counter:
    """Counts of texts: split pattern, transducer, chunk maps."""

    def __init__(self, path: str, chunk: int = CHUNK):
        self.machine, self.chunk = Transducer(path), chunk
        self.pieces = regex.compile(PATTERN).findall
        self.first = regex.compile(r"\S(?=\s)").search
        self.last = regex.compile(r".*\S(?=\s)", regex.S).match
        self.special = regex.compile("|".join(map(regex.escape, self.machine.special))) if self.machine.special else None

        machine = self.machine

        class Known(dict):
            def __missing__(self, piece: str) -> int:
                found = machine.count(piece.encode())
                if len(piece) <= LONG:
                    self[piece] = found
                return found

        self.known = known = Known()
        pieces = self.pieces

        class Words(dict):
            """Tokens of a space and the run up to the next one; OPEN if white space follows white space there."""

            def __missing__(self, run: str) -> int:
                if run.isascii() and run.isalpha():
                    found = known[" " + run]
                elif run[:-1].isascii() and run[:-1].isalpha() and run[-1] in MARKS:
                    found = known[" " + run[:-1]] + known[run[-1]]
                elif not run or run[-1].isspace():
                    found = OPEN
                else:
                    found = sum(map(known.__getitem__, pieces(" " + run)))
                if len(run) <= LONG:
                    self[run] = found
                return found

        self.words = Words()

    def settled(self, text: str) -> int:
        """Tokens of a text between synchronizing places.

        A space after something else is such a place, so what stands between two of them is counted once and remembered.
        """
        if len(self.known) > MOST_WORDS:
            self.known.clear()
        if len(self.words) > MOST_WORDS:
            self.words.clear()
        first, *runs = text.split(" ")
        counts = list(map(self.words.__getitem__, runs))
        # where white space follows white space, the runs go on to the next synchronizing place
        total = sum(counts)
        if total >= OPEN or first[-1:].isspace():
            return self._joined(first, runs, counts)
        return sum(map(self.known.__getitem__, self.pieces(first))) + total

    def _joined(self, first: str, runs: list[str], counts: list[int]) -> int:
        """Tokens of runs of which some end in white space: these are taken together with the next."""
        total, held = 0, [first]
        for run, n in zip(runs, counts):
            if held and (not held[-1] or held[-1][-1].isspace()):
                held.append(run)
                continue
            if held:
                total += sum(map(self.known.__getitem__, self.pieces(" ".join(held))))
                held = []
            if n < OPEN:
                total += n
            else:
                held = ["", run]
        return total + sum(map(self.known.__getitem__, self.pieces(" ".join(held)))) if held else total

    def map_of(self, chunk: str) -> ChunkMap:
        first = self.first(chunk)
        if first is None:
            return ChunkMap(chunk, 0, None)
        low, high = first.end(), self.last(chunk).end()
        return ChunkMap(chunk[:low], self.settled(chunk[low:high]), chunk[high:])

    def compose(self, a: ChunkMap, b: ChunkMap) -> ChunkMap:
        if a.tail is None:
            return ChunkMap(a.head + b.head, b.count, b.tail)
        if b.tail is None:
            return ChunkMap(a.head, a.count, a.tail + b.head)
        return ChunkMap(a.head, a.count + self.settled(a.tail + b.head) + b.count, b.tail)

    def count_plain(self, text: str) -> int:
        maps = [self.map_of(text[i : i + self.chunk]) for i in range(0, len(text), self.chunk)]
        while len(maps) > 1:
            maps = [self.compose(*maps[i : i + 2]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
        if not maps:
            return 0
        return self.settled(maps[0].head) + maps[0].count + self.settled(maps[0].tail or "")

    def count(self, text: str) -> int:
        if self.special is None:
            return self.count_plain(text)
        if not any(map(text.__contains__, self.machine.special)):
            return self.count_plain(text)
        parts = self.special.split(text)
        return sum(map(self.count_plain, parts)) + len(parts) - 1


_kept: dict[tuple[str, int], Counter] = {}


def counter(path: str, chunk: int) -> Counter:
    """The counter of a worker process: its states and counts stay known from task to task."""
    if (path, chunk) not in _kept:
        _kept.clear()
        _kept[path, chunk] = Counter(path, chunk)
    return _kept[path, chunk]


def count_tokens(docs: DataFrame, path: str, chunk: int = CHUNK) -> DataFrame:
    """doc_id, n_bytes, n_tokens of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(path, chunk)
        for part in text_slices(batches):
            found = [own.count(t or "") for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("n_bytes"), pa.array(found, pa.int64())], ["doc_id", "n_bytes", "n_tokens"]
            )

    text = F.col("text").cast("string")
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint")
    return docs.select("doc_id", text.alias("text"), size.alias("n_bytes")).mapInArrow(
        run, f"doc_id {kind}, n_bytes bigint, n_tokens bigint"
    )
