"""Spans of documents that are to go: texts packed for a shuffle, and cutting them."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laborlens.llm.frames import map_arrow

#: Rows are told apart by id and by 32 bits of a hash of id and text.
KEY = ["doc_id", "tag"]


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, tag and text."""
    tag = F.hash(F.col("doc_id"), F.coalesce(F.col("text"), F.lit("")))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), tag.alias("tag"), "text")


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    squeeze = zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        texts = [squeeze((t.as_py() or "").encode()) for t in batch.column(2)]
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(texts, pa.binary())], [*KEY, "packed"])


def packed(rows: DataFrame) -> DataFrame:
    """:func:`keyed` rows with the text compressed, less than half as large on the way."""
    return map_arrow(rows, _pack, "doc_id long, tag int, packed binary")


def unpack(value: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(value)


def union(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The disjoint, not touching spans that cover the same places."""
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    new = np.r_[True, starts[1:] > reach[:-1]]
    first = np.flatnonzero(new)
    return starts[first], reach[np.r_[first[1:] - 1, len(starts) - 1]]


def cut(
    texts: DataFrame, spans: DataFrame, shortest: int = 0, with_text: bool = False, whole: bool = False
) -> DataFrame:
    """Rows of ``texts`` (packed) without the bytes that ``spans`` (key, start, end) cover.

    doc_id, tag, n_bytes, n_removed, n_spans and kept_sha256; with_text adds kept_text, in which a character that lost some
    of its bytes goes as a whole. Runs of spans shorter than ``shortest`` bytes stay, unless ``whole`` is set and the run is all of the text. Spans with a column ``first``, an
    id, add shared_with: the ids of what is cut, without the row's own.
    """
    linked = "first" in spans.columns
    parts = ["start", "end", *["first"] * linked]
    lists = spans.groupBy(*KEY).agg(F.collect_list(F.struct(*parts)).alias("s"))
    firsts = F.col("s.first") if linked else F.lit(None).cast("array<bigint>")
    lists = lists.select(*KEY, F.col("s.start").alias("starts"), F.col("s.end").alias("ends"), firsts.alias("firsts"))
    renamed = lists.withColumnsRenamed({c: f"_{c}" for c in KEY})
    on = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("tag") == F.col("_tag"))
    joined = texts.join(renamed, on, "left").select(*KEY, "packed", "starts", "ends", "firsts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, removed, n, digests, kept, shared = [], [], [], [], [], []
            for own, data, starts, ends, first in zip(*(batch.column(i) for i in (0, 2, 3, 4, 5)), strict=True):
                data = unpack(data.as_py())
                parts, at, gone = [], 0, 0
                if starts.is_valid and len(starts):
                    a, b = union(starts.values.to_numpy(), ends.values.to_numpy())
                    long = (b - a >= shortest) | (whole & (b - a == len(data)))
                    if linked:
                        within = long[np.searchsorted(a, starts.values.to_numpy(), side="right") - 1]
                        # A row without an id that repeats itself names no document.
                        ids = np.unique(first.values.filter(pa.array(within)).drop_null().to_numpy())
                    a, b = a[long].tolist(), b[long].tolist()
                else:
                    a, b, ids = [], [], np.zeros(0, np.int64)
                for start, end in zip(a, b, strict=True):
                    parts.append(data[at:start])
                    gone += end - start
                    at = end
                parts.append(data[at:])
                rest = b"".join(parts)
                size.append(len(data))
                removed.append(gone)
                n.append(len(a))
                digests.append(hashlib.sha256(rest).hexdigest())
                if linked:
                    shared.append(ids[ids != own.as_py()] if own.is_valid else ids)
                if with_text:
                    kept.append(b"".join(p.decode("utf-8", "ignore").encode() for p in parts).decode())
            arrays = [*batch.columns[:2], *(pa.array(x, pa.int64()) for x in (size, removed, n)), pa.array(digests, pa.string())]
            if linked:
                arrays.append(pa.array(shared, pa.list_(pa.int64())))
            if with_text:
                arrays.append(pa.array(kept, pa.string()))
            yield pa.RecordBatch.from_arrays(arrays, [x.split()[0] for x in columns])

    columns = ["doc_id long", "tag int", "n_bytes long", "n_removed long", "n_spans long", "kept_sha256 string"]
    columns += ["shared_with array<long>"] * linked + ["kept_text string"] * with_text
    return map_arrow(joined, run, ", ".join(columns))
