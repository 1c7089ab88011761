"""Substring deduplication by content-defined chunks.

A gear hash rolls over the bytes; a chunk ends where the hash is the smallest within a fixed distance on both sides. That
depends on the bytes around the place alone, so chunks of equal passages are equal again soon after an insertion. What is
compared by digest are pieces of as many neighbouring chunks as make up a shortest length: the first of equal pieces, by
document and place, stays. So whatever goes stands earlier as one piece of that length, never as chunks from here and there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laborlens.llm import bytesops as B
from laborlens.llm.frames import map_arrow, same, stage
from laborlens.llm.spans import KEY, cut, keyed, packed

#: Bytes that the rolling hash remembers, those that decide on cuts, distance within which a cut is the only one, and the
#: longest chunk. Cuts inside a passage are the same everywhere from CUT_BYTES + NEAR after its start to NEAR before its end.
GEAR_BYTES, CUT_BYTES, NEAR, LONGEST = 32, 12, 14, 1024

_GEAR = (B.BYTE_VALUE >> np.uint64(32)).astype(np.uint32)


def gear_hashes(data: np.ndarray, memory: int = GEAR_BYTES) -> np.ndarray:
    """Rolling hash after each byte: h = (h << 1) + gear[byte], of which 32 bits remember 32 bytes; of ``memory`` bytes.

    Summed by doubling: the hash of 2n bytes is that of the last n plus that of the n before, shifted by n.
    """
    h, out = _GEAR[data], None
    span, done = 1, 0
    while True:
        if memory & span:
            if out is None:
                out = h.copy()
            else:
                out[done:] += h[:-done] << np.uint32(done)
            done += span
        if 2 * span > memory:
            return out
        longer = h.copy()
        longer[span:] += h[:-span] << np.uint32(span)
        h = longer
        span *= 2


def chunk_checks(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """31 bits of each chunk's length and gear hash, without what the hash remembers from before a short chunk."""
    h = gear_hashes(data)
    size = end - start
    before = np.where(start > 0, h[start - 1], np.uint32(0)) << np.minimum(size, 31).astype(np.uint32)
    own = h[end - 1] - np.where(size < GEAR_BYTES, before, np.uint32(0))
    return (own.astype(np.uint64) * np.uint64(31) + size.astype(np.uint64)) & np.uint64(0x7FFFFFFF)


def boundaries(docs: B.Docs, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the chunks of all documents, in order."""
    h = gear_hashes(data, CUT_BYTES).astype(np.uint64) << np.uint64(32) | np.arange(len(data), dtype=np.uint64)
    least = np.full(len(h), np.iinfo(np.uint64).max, np.uint64)
    n = len(h) - 2 * NEAR
    if n > 0:
        span, low = 1, h
        while 2 * span <= 2 * NEAR + 1:
            low = np.minimum(low[:-span], low[span:])
            span *= 2
        least[NEAR : NEAR + n] = np.minimum(low[:n], low[2 * NEAR + 1 - span : 2 * NEAR + 1 - span + n])
    cuts = np.flatnonzero(least == h) + 1
    # A cut's surroundings lie in one document, or the cut would depend on what follows it in the buffer.
    owner = np.searchsorted(docs.starts, cuts - 1, side="right") - 1
    warm = CUT_BYTES + NEAR
    inside = (cuts - warm >= docs.starts[owner]) & (cuts + NEAR <= docs.ends[owner])
    full = np.flatnonzero(docs.lengths > 0)
    edges = np.unique(np.concatenate([docs.starts[full], cuts[inside]]))
    ends = np.append(edges[1:], docs.ends[-1])
    which = np.searchsorted(docs.starts, edges, side="right") - 1
    ends = np.minimum(ends, docs.ends[which])
    # Long stretches without a cut are cut evenly.
    extra = (ends - edges - 1) // LONGEST
    if extra.any():
        times = extra + 1
        step = (np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)) * LONGEST
        edges = np.repeat(edges, times) + step
        ends = np.minimum(edges + LONGEST, np.repeat(ends, times))
    return edges, ends


def pieces(docs: B.Docs, data: np.ndarray, shortest: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the pieces of all documents: from each chunk's start to the first end of a chunk that lies
    ``shortest`` bytes on, and the one that closes the document. A document shorter than that is a piece as a whole."""
    start, end = boundaries(docs, data)
    owner = np.searchsorted(docs.starts, start, side="right") - 1
    to = np.searchsorted(end, start + shortest)
    long = to < len(end)
    long[long] = owner[to[long]] == owner[long]
    last = np.flatnonzero(np.r_[owner[1:] != owner[:-1], True])
    back = np.searchsorted(start, end[last] - shortest, side="right") - 1
    back = np.maximum(back, np.searchsorted(owner, owner[last]))
    spans = np.r_[start[long] << 16 | (end[to[long]] - start[long]), start[back] << 16 | (end[last] - start[back])]
    spans = np.unique(spans)
    return spans >> 16, (spans >> 16) + (spans & 0xFFFF)


def _pieces(shortest: int, whole: bool):
    """doc_id, tag, place (start << 16 | length), digest in two parts; the first of equal pieces in a document only, and
    where the others stand as rows without a digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for docs in B.documents(batches):
            data = docs.joined()
            if not docs.lengths.any():
                continue
            start, end = pieces(docs, data, shortest)
            if not whole:
                start, end = start[end - start >= shortest], end[end - start >= shortest]
            owner = np.searchsorted(docs.starts, start, side="right") - 1
            digest = B.Prefix(data).spans(start, end)
            check = chunk_checks(data, start, end)
            in_document = B.mix(digest + B.mix(owner.astype(np.uint64) + np.uint64(3)))
            again = np.ones(len(start), bool)
            again[np.unique(in_document, return_index=True)[1]] = False
            take = pa.array(owner)
            place = (start - docs.starts[owner]) << 16 | (end - start)
            yield pa.RecordBatch.from_arrays(
                [docs.rows.column(0).take(take), docs.rows.column(1).take(take), pa.array(place),
                 pa.array(digest.view(np.int64), mask=again), pa.array(check.astype(np.int32))],
                [*KEY, "place", "digest", "check"],
            )

    return run


def repeated_pieces(docs: DataFrame, shortest: int = 80, whole: bool = False) -> DataFrame:
    """key, start, end and first (the doc_id where it stays) of the pieces that an earlier one equals."""
    found = map_arrow(docs, _pieces(shortest, whole), "doc_id long, tag int, place long, digest long, check int")
    within = found.filter("digest is null").select(*KEY, "place", F.col("doc_id").alias("first"))
    once = found.filter("digest is not null")
    # A digest in a third of all documents is combined in each task before it moves; the join, which reads the owners from
    # a table, can split it.
    owners = once.groupBy("digest", "check").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).filter("n > 1")
    shared = once.join(stage(owners.drop("n")), ["digest", "check"]).select(*KEY, "place", "first")
    later = shared.filter(~same(F.col("doc_id"), F.col("first"))).unionByName(within)
    start = F.shiftright("place", 16)
    return later.select(*KEY, start.alias("start"), (start + F.col("place").bitwiseAND(0xFFFF)).alias("end"), "first")


def deduplicate(docs: DataFrame, shortest: int = 80, with_text: bool = False, whole: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and shared_with.

    A piece is what lies between two cuts ``shortest`` bytes apart or little more. Of equal pieces the first stays: that of the
    smallest doc_id and place. Bytes of the others go, so that everything that goes stands earlier within ``shortest`` equal
    bytes or more, and a phrase in common costs no document its text. With ``whole`` a shorter document also goes if it equals
    an earlier one. A passage goes without up to about 60 bytes at its ends, whose cuts its surroundings decide. shared_with
    lists the doc_ids where what was removed stays.

    Null text is empty. Rows of one id are one document: what they share among each other stays; rows without an id keep what
    they share with rows that have none. Pieces are told apart by 95 bits. with_text adds kept_text. Extra columns are ignored.
    """
    if not 0 < shortest <= 1 << 15:
        raise ValueError("shortest: 1 to 32768 bytes")
    rows = keyed(docs)
    out = cut(packed(rows), repeated_pieces(rows, shortest, whole), shortest, with_text, whole)
    return out.drop("tag")
