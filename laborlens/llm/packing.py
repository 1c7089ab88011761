"""Packing documents into sequences along a space-filling curve.

A document's hashed word counts are projected to a few dimensions and become a position on a Hilbert curve. Documents are
range-partitioned and sorted by that key, so that neighbours on the curve share sequences, and each task lays the tokens of
its range end to end.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laborlens.llm import bytesops as B
from laborlens.llm.frames import map_arrow, row_hash

#: Size of the hashed vectors, dimensions they are projected to, and bits a dimension.
BUCKETS, DIMENSIONS, BITS = 256, 4, 12
#: Strings whose ids a worker remembers at most, and the longest among them.
MOST_CACHED, CACHED_LENGTH = 400_000, 40

_signs = np.random.RandomState(7).choice([-1.0, 1.0], (BUCKETS, DIMENSIONS))


def hilbert_index(points: np.ndarray, bits: int) -> np.ndarray:
    """Distance along the Hilbert curve of each row of ``points``, integers below 2**bits (Skilling's transform)."""
    x = points.astype(np.int64).T.copy()
    d = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(d):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, swap)
            x[i] ^= swap if i else 0
        q >>= 1
    for i in range(1, d):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        turn ^= np.where((x[d - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= turn
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(d):
            out = out << 1 | (x[i] >> b & 1)
    return out


def curve_keys(docs: B.Docs) -> np.ndarray:
    """Hilbert key of each document; those without words have the key of the zero vector."""
    data = docs.joined(lower=True)
    start, end = B.word_spans(data)
    owner = np.searchsorted(docs.starts, start, side="right") - 1
    bucket = (B.Prefix(data).spans(start, end) % np.uint64(BUCKETS)).astype(np.int64)
    counts = np.bincount(owner * BUCKETS + bucket, minlength=len(docs) * BUCKETS).reshape(len(docs), BUCKETS)
    norm = np.sqrt((counts.astype(float) ** 2).sum(1, keepdims=True))
    points = counts @ _signs / np.maximum(norm, 1)
    scaled = 1 / (1 + np.exp(-1.7 * points))
    return hilbert_index(np.minimum((scaled * (1 << BITS)).astype(np.int64), (1 << BITS) - 1), BITS)


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for docs in B.documents(batches):
        yield pa.RecordBatch.from_arrays(
            [*(docs.rows.column(i) for i in range(3)), pa.array(curve_keys(docs))], ["doc_id", "h", "text", "curve"]
        )


class Tokens:
    """Ids of a byte-level BPE file of the ``tokenizers`` library.

    A text is cut where a single space stands between two other characters, where the pattern always begins a new match,
    and the ids of each part are remembered. New parts without white space are encoded many at a time, a line each, by
    the faster ``tiktoken`` from the same vocabulary; first parts, others with white space and texts that name a special
    token go through ``tokenizers`` itself.
    """

    def __init__(self, path: str, pattern: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task on each core
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            config = json.load(f)
        self.special = [x["content"] for x in config["added_tokens"]]
        spelled = _byte_spelling()
        ranks = {
            bytes(spelled[c] for c in token): i for token, i in config["model"]["vocab"].items() if token not in self.special
        }
        self.fast = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.newline = ranks[b"\n"]
        self.safe = re.compile(r"(?<=\S) (?=\S)").split
        self.gaps = re.compile(r"\s\s|^ | $").search
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text, without special tokens added."""
        if len(self.known) > MOST_CACHED // 2:
            self.old, self.known = self.known, {}
        get, old = self.known.get, self.old
        heads, found, holes, missing = [], [], [], {}
        for text in texts:
            if any(s in text for s in self.special):
                heads.append(text)
                found.append([])
                holes.append([])
                continue
            cut = self.safe(text) if self.gaps(text) else text.split(" ")
            heads.append(cut[0])
            cut[0] = ""
            ids = list(map(get, cut))
            ids[0] = b""
            hole = [(i, cut[i]) for i, x in enumerate(ids) if x is None]
            for i, p in hole:
                if p in old:
                    self.known[p] = old[p]
                else:
                    missing[p] = b""
            found.append(ids)
            holes.append(hole)
        self._learn(missing)
        out = []
        for head, ids, hole in zip(self._ids(heads), found, holes, strict=True):
            for i, p in hole:
                ids[i] = get(p) or missing[p]
            out.append(head + b"".join(ids))
        return out

    def _learn(self, missing: dict[str, bytes]) -> None:
        """Fill in the ids of the keys, each with a space before it, and remember those of the short ones."""
        plain = [p for p in missing if p.split() == [p]]
        other = [p for p in missing if p.split() != [p]]
        missing.update(zip(other, self._ids([" " + p for p in other]), strict=True))
        ids = np.array(self.fast("".join([f" {p}\n" for p in plain])), "<u4")
        ends = np.flatnonzero(ids == self.newline).tolist()
        data, begin = ids.tobytes(), 0
        for p, end in zip(plain, ends, strict=True):
            missing[p] = data[4 * begin : 4 * end]
            begin = end + 1
        self.known.update({p: x for p, x in missing.items() if len(p) <= CACHED_LENGTH})

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def _byte_spelling() -> dict[str, int]:
    """Byte-level vocabularies spell a byte as its Latin-1 character if that is printable, others as U+0100 onwards."""
    printable = [b for b in range(256) if chr(b).isprintable() and b != 0x20]
    rest = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


_TOKENS: dict[str, Tokens] = {}


class _Sequences:
    """Lays ids end to end; holds the pieces of one unfinished sequence."""

    def __init__(self, base: int, size: int):
        self.number, self.size = base, size
        self.open: list[tuple] = []
        self.fill = 0
        self.rows: list[tuple] = []

    def add(self, doc: tuple, ids: bytes) -> None:
        total = len(ids) // 4
        at = 0
        while at < total:
            n = min(total - at, self.size - self.fill)
            self.open.append((doc, at, ids[4 * at : 4 * (at + n)], total))
            self.fill += n
            at += n
            if self.fill == self.size:
                self._close(self.open)
                self.open, self.fill = [], 0

    def _close(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc, start, ids, total in pieces:
            self.rows.append((doc, start, ids, total, self.number, offset))
            offset += len(ids) // 4
        self.number += 1

    def finish(self) -> None:
        """The rest goes into sequences whose lengths are powers of two, which need no padding."""
        rest, left = self.open, self.fill
        while left:
            room = 1 << (left.bit_length() - 1)
            left -= room
            pieces = []
            while room:
                doc, start, ids, total = rest[0]
                n = min(room, len(ids) // 4)
                pieces.append((doc, start, ids[: 4 * n], total))
                room -= n
                if 4 * n == len(ids):
                    rest = rest[1:]
                else:
                    rest = [(doc, start + n, ids[4 * n :], total), *rest[1:]]
            self._close(pieces)
        self.open, self.fill = [], 0


def pack(docs: DataFrame, path: str, pattern: str, size: int = 1024, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """Pieces of documents in sequences of ``size`` tokens: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document's ids are those of ``path``, a byte-level file of the ``tokenizers`` library that executors can read and
    whose pattern is ``pattern``, then ``end_id``.
    Documents follow the curve, ties go by id and then by a hash of the row, so that copies spread over tasks. Each
    sequence is full but for the last of a task, which is cut into powers of two. ``with_ids`` adds the ids themselves.
    Null text is empty and has its end only; repeated rows are packed one by one; extra columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_hash().alias("h"), "text")
    keyed = map_arrow(rows, _keyed, "doc_id long, h long, text string, curve long")
    placed = keyed.repartitionByRange("curve", "doc_id", "h").sortWithinPartitions("curve", "doc_id", "h")
    last = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _TOKENS:
            _TOKENS[path] = Tokens(path, pattern)
        tokens = _TOKENS[path]
        packed = _Sequences(TaskContext.get().partitionId() << 33, size)
        for group in B.documents(batches):
            ids = tokens.encode([t.decode() for t in group.texts])
            for doc, x in zip(group.rows.column(0).to_pylist(), ids, strict=True):
                packed.add(doc, x + last)
            yield _table(packed, with_ids)
        packed.finish()
        yield _table(packed, with_ids)

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return map_arrow(placed.select("doc_id", "text"), run, schema + (", ids array<int>" if with_ids else ""))


def _table(packed: _Sequences, with_ids: bool) -> pa.RecordBatch:
    rows, packed.rows = packed.rows, []
    doc, start, ids, total, number, offset = zip(*rows, strict=True) if rows else ((),) * 6
    columns = {
        "doc_id": doc, "start": start, "length": [len(x) // 4 for x in ids], "ids_crc32": [zlib.crc32(x) for x in ids],
        "doc_tokens": total, "sequence_id": number, "offset": offset,
    }
    arrays = [pa.array(list(v), pa.int64()) for v in columns.values()]
    if with_ids:
        arrays.append(pa.array([np.frombuffer(x, "<u4").astype(np.int32) for x in ids], pa.list_(pa.int32())))
    return pa.RecordBatch.from_arrays(arrays, [*columns, *["ids"] * with_ids])
