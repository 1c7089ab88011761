"""Byte-level BPE: encoding by a lazily determinised transducer, decoding by an incremental UTF-8 machine.

The merges decide, for each prefix of a piece of text, which token its encoding ends with. A transducer that reads the piece
byte by byte therefore needs to remember only the bytes that a later token can still reach back to, and the token before
them. Those two are its state; states and transitions are made when first met. A token is emitted as soon as every
continuation agrees on it, which is after at most the length of the longest token.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laborlens.llm.frames import map_arrow

#: States and cached strings that a worker holds at most; beyond it they are made anew when needed.
MOST_STATES = 300_000
MOST_CACHED = 300_000
#: Longer strings are not cached.
CACHED_LENGTH = 40
_NEVER = 1 << 62


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f)}


class Merges:
    """Which two tokens may stand side by side, by the merges' ranks."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {i: t for t, i in ranks.items()}
        #: The pair of tokens whose merge makes a token, and the reverse.
        self.parts: dict[int, tuple[int, int]] = {}
        for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
            if len(token) > 1:
                halves = self._merge(token, rank)
                if len(halves) == 2:
                    self.parts[rank] = (halves[0], halves[1])
        self.pairs = {pair: rank for rank, pair in self.parts.items()}
        self._spines: tuple[dict, dict] = ({}, {})
        self._fits: dict[tuple[int, int], bool] = {}

    def _merge(self, piece: bytes, below: int = _NEVER) -> list[int]:
        """Ids after all merges with a rank under ``below``, the lowest first and leftmost among equals."""
        parts = [bytes([b]) for b in piece]
        while len(parts) > 1:
            best, at = below, -1
            for i in range(len(parts) - 1):
                rank = self.ranks.get(parts[i] + parts[i + 1], below)
                if rank < best:
                    best, at = rank, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def _spine(self, token: int, side: int) -> list[tuple[int, int]]:
        """The pieces of ``token`` at its left (0) or right (1) edge, smallest first, each with the rank that consumes it."""
        known = self._spines[side].get(token)
        if known is None:
            known, parent = [], _NEVER
            while True:
                known.append((token, parent))
                if token not in self.parts:
                    break
                parent, token = token, self.parts[token][side]
            known.reverse()
            self._spines[side][known[-1][0]] = known
        return known

    def fits(self, left: int, right: int) -> bool:
        """Whether the encoding of the two tokens' bytes is these two tokens.

        Replays the merges at the seam: pieces grow on both sides in order of rank, and the tokens fit unless the two
        pieces at the seam would merge first. Among equal ranks the leftmost merge goes first.
        """
        key = (left, right)
        known = self._fits.get(key)
        if known is None:
            if len(self._fits) > 500_000:
                self._fits.clear()
            a, b, i, j = self._spine(left, 1), self._spine(right, 0), 0, 0
            while True:
                (x, grow_left), (y, grow_right) = a[i], b[j]
                seam = self.pairs.get((x, y), _NEVER)
                if seam < grow_left and seam <= grow_right and seam != _NEVER:
                    known = False
                    break
                if grow_left == grow_right == _NEVER:
                    known = True
                    break
                if grow_left <= grow_right:
                    i += 1
                else:
                    j += 1
            self._fits[key] = known
        return known


class Transducer:
    """Encodes one piece at a time. ``step`` and ``flush`` are what a stream would call."""

    def __init__(self, merges: Merges):
        self.merges = merges
        #: Every proper prefix of a token, and whether it can grow: how far a later token may reach back.
        self.stems: set[bytes] = set()
        for token in merges.ranks:
            for k in range(1, len(token)):
                self.stems.add(token[:k])
        self.longest = max(map(len, merges.ranks))
        self._reset()

    def _reset(self) -> None:
        #: Of each state: the bytes not settled, and for each length of them the token that the encoding ends with and
        #: where it begins. At 0 stands the last settled token, -1 for none; -2 marks a length whose encoding doesn't
        #: pass the settled point, so that no later token begins there.
        self.pending: list[bytes] = [b""]
        self.last: list[tuple[tuple[int, int], ...]] = [((-1, -1),)]
        self.numbers: dict[tuple, int] = {}
        self.next: dict[int, tuple[int, tuple[int, ...]]] = {}
        self.ends: dict[int, tuple[int, ...]] = {}

    def _make(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        ranks, stems = self.merges.ranks, self.stems
        pending, last = self.pending[state] + bytes([byte]), self.last[state]
        n = len(pending)
        low = max(0, n - self.longest)
        for begin in range(low, n):
            token = ranks.get(pending[begin:])
            if token is not None:
                left = last[begin][0]
                if left == -1 or left != -2 and self.merges.fits(left, token):
                    last += ((token, begin),)
                    break
        else:
            last += ((-2, -1),)
        # Later tokens begin where the rest is a stem, or behind all of it. What all those places share is settled.
        live = [i for i in range(low, n) if pending[i:] in stems and last[i][0] != -2]
        live.append(n)
        while len(live) > 1:
            back = last[live.pop()][1]
            if back not in live:
                live.append(back)
                live.sort()
        settled = live[0]
        out = self._path(last, settled)
        if settled:
            moved = [(last[settled][0], -1)]
            for token, begin in last[settled + 1 :]:
                whole = begin >= settled and moved[begin - settled][0] != -2
                moved.append((token, begin - settled) if whole else (-2, -1))
            pending, last = pending[settled:], tuple(moved)
        # The settled token matters only if a later token can begin right behind it.
        key = (pending, last[0][0] if not pending or pending in stems else last[1:])
        number = self.numbers.get(key)
        if number is None:
            number = self.numbers[key] = len(self.pending)
            self.pending.append(pending)
            self.last.append(last)
        return number, out

    @staticmethod
    def _path(last: tuple[tuple[int, int], ...], at: int) -> tuple[int, ...]:
        out = []
        while at > 0:
            token, at = last[at]
            out.append(token)
        return tuple(reversed(out))

    def flush(self, state: int) -> tuple[int, ...]:
        ends = self.ends.get(state)
        if ends is None:
            last = self.last[state]
            ends = self.ends[state] = self._path(last, len(last) - 1)
        return ends

    def encode(self, piece: bytes) -> list[int]:
        whole = self.merges.ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(self.pending) > MOST_STATES:
            self._reset()
        state, out, known = 0, [], self.next
        for byte in piece:
            key = state << 8 | byte
            found = known.get(key)
            if found is None:
                found = known[key] = self._make(state, byte)
            state, emitted = found
            if emitted:
                out.extend(emitted)
        out.extend(self.flush(state))
        return out


class Encoder:
    """Ids of whole texts. A text is cut where a single space stands between two other characters: the pattern always
    begins a match there, so each part can be encoded, and remembered, by itself."""

    def __init__(self, path: str, pattern: str):
        self.transducer = Transducer(Merges(load_ranks(path)))
        self.find = regex.compile(pattern).findall
        self.safe = regex.compile(r"(?<=[^\s\x1c-\x1f]) (?=[^\s\x1c-\x1f])").split
        self.gaps = regex.compile(r"[\s\x1c-\x1f]{2}|^ | $").search
        # Two generations each: a full cache becomes the old one, what is still in use moves on.
        self.first: dict[str, bytes] = {}
        self.later: dict[str, bytes] = {}
        self.old: dict[str, dict[str, bytes]] = {"": {}, " ": {}}
        self.names = [str(i) for i in range(max(self.transducer.merges.tokens) + 1)]
        self.bytes_of = [self.transducer.merges.tokens.get(i, b"") for i in range(len(self.names))]

    def _part(self, part: str, cache: dict[str, bytes], space: str) -> bytes:
        out = self.old[space].get(part)
        if out is None:
            ids: list[int] = []
            for piece in self.find(space + part):
                ids.extend(self.transducer.encode(piece.encode()))
            out = np.array(ids, "<u4").tobytes()
        if len(part) <= CACHED_LENGTH:
            cache[part] = out
        return out

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit numbers."""
        if not text:
            return b""
        if len(self.first) + len(self.later) > MOST_CACHED:
            self.old, self.first, self.later = {"": self.first, " ": self.later}, {}, {}
        parts = self.safe(text) if self.gaps(text) else text.split(" ")
        out = [self._part(parts[0], self.first, "")]
        get, make, later = self.later.get, self._part, self.later
        out.extend([get(p) or make(p, later, " ") for p in parts[1:]])
        return b"".join(out)


class Utf8Stream:
    """Bytes in, whole characters out: holds back an unfinished character until its rest arrives."""

    def __init__(self) -> None:
        self.held = b""

    def feed(self, data: bytes) -> bytes:
        data = self.held + data
        cut = len(data)
        for back in range(1, min(3, len(data)) + 1):
            byte = data[-back]
            if byte & 0xC0 == 0x80:  # continues a character: look further back for its first byte
                continue
            size = 4 if byte >= 0xF0 else 3 if byte >= 0xE0 else 2 if byte >= 0xC0 else 1
            if size > back:
                cut = len(data) - back
            break
        self.held = data[cut:]
        return data[:cut]

    def finish(self) -> bytes:
        """What is left: empty if the bytes were whole characters."""
        held, self.held = self.held, b""
        return held


#: One encoder a worker process and vocabulary, as its tables take a second to make.
_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, pattern: str) -> Encoder:
    if (path, pattern) not in _ENCODERS:
        _ENCODERS[path, pattern] = Encoder(path, pattern)
    return _ENCODERS[path, pattern]


def decode(ids: list[int], bytes_of: list[bytes], block: int = 8192) -> Iterator[bytes]:
    """Whole characters of the text, block of ids by block."""
    stream = Utf8Stream()
    for i in range(0, len(ids), block):
        yield stream.feed(b"".join([bytes_of[x] for x in ids[i : i + block]]))
    yield stream.finish()


def encode_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and ``ids`` (array of int) of each row of ``docs``.

    Null text is empty and has no ids. Rows are independent: repeated ones give the same ids, extra columns are ignored.
    ``path``, a rank file, must be readable on the executors.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = encoder(path, pattern)
        for batch in batches:
            ids = [np.frombuffer(made.encode(t.as_py() or ""), "<u4").astype(np.int32) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return map_arrow(docs.select("doc_id", "text"), run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode_documents(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and ``text`` of rows with doc_id and ids; bytes that are no whole character become U+FFFD."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = encoder(path, pattern)
        for batch in batches:
            texts = [
                "".join(b.decode("utf-8", "replace") for b in decode(x.as_py() or [], made.bytes_of)) for x in batch.column(1)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return map_arrow(encoded.select("doc_id", "ids"), run, f"doc_id {kind}, text string")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of each row: encoding and decoding in one pass over the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = encoder(path, pattern)
        names, bytes_of = made.names, made.bytes_of
        for batch in batches:
            n, ids_sha, text_sha = [], [], []
            for text in batch.column(1):
                ids = np.frombuffer(made.encode(text.as_py() or ""), "<u4").tolist()
                n.append(len(ids))
                ids_sha.append(hashlib.sha256(" ".join([names[i] for i in ids]).encode()).hexdigest())
                digest = hashlib.sha256()
                for part in decode(ids, bytes_of):
                    digest.update(part)
                text_sha.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_arrow(rows, run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
