"""Token ids in binary files of directly addressable codes.

An id is split into chunks, lowest bits first. Chunks of one level lie side by side, all of one width; a bitmap says which ids
go on in the next level, and a directory of its set bits tells where. So any id of a file is read by one step a level, without
decoding what lies before it. The widths of a file are those that make it smallest.

A file holds one segment, followed by a line feed, and is written by Spark's own text writer, which takes any bytes: files go
wherever Spark can write, and those of tasks that fail are never seen. Segments hold whole documents in ascending order and
are closed at a number of ids, so that files have a bounded size unless a single document is longer. Numbers are little-endian:

    magic (4 bytes), task, number in task, documents, ids, levels (five u64),
    for each level: first bit, width, ids, set bits (four u64), then the chunks, the bitmap and the directory, each padded to
    8 bytes, and for each document: id (i64), whether it has one (u8), number of ids (u64), as three arrays.

``manifest`` beside the files is a table with one row a file: what its header says and the number of ids before it.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from laborlens.llm import bytesops as B
from laborlens.llm.frames import map_arrow, row_hash
from laborlens.llm.packing import Tokens

MAGIC = b"DAC1"
#: Ids after which a segment ends with its document, bits of a bitmap between entries of its directory, the widths of chunks.
SEGMENT_IDS, RANK_BITS, WIDTHS = 1 << 22, 256, (4, 8, 12, 16)
#: Global positions in a cell by which positions and files find each other.
CELL_BITS = 22

#: White space on which the two libraries' patterns might not agree.
_ODD_SPACE = re.compile("[\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")

_TOKENS: dict[str, Tokens] = {}


def text_ids(tokens: Tokens, texts: list[str]) -> list[bytes]:
    """Ids of each text, little-endian unsigned 32 bits, as the ``tokenizers`` library gives them.

    ``tiktoken`` makes them from the same vocabulary, whole texts at a time, which needs no memory of words; texts that name a
    special token or hold unusual white space go through ``tokenizers`` itself.
    """
    odd = [i for i, t in enumerate(texts) if _ODD_SPACE.search(t) or any(s in t for s in tokens.special)]
    out = dict(zip(odd, tokens._ids([texts[i] for i in odd]), strict=True))
    return [out[i] if i in out else np.array(tokens.fast(t), "<u4").tobytes() for i, t in enumerate(texts)]


def level_widths(ids: np.ndarray) -> list[int]:
    """Chunk widths that take the fewest bits for ``ids``, bitmaps and directories counted."""
    most = int(ids.max(initial=0))
    bits = max(4, -(-most.bit_length() // 4) * 4)
    # longer[s]: ids that need more than s bits; all of them stand in the first level.
    if most < 1 << 20:
        below = np.cumsum(np.bincount(ids, minlength=1))
        longer = {s: int(below[-1] - below[min((1 << s) - 1, most)]) for s in range(4, bits, 4)}
    else:
        longer = {s: int((ids >= np.uint32(1 << s)).sum()) for s in range(4, bits, 4)}
    longer[0] = len(ids)
    best: dict[int, tuple[float, list[int]]] = {bits: (0.0, [])}
    for s in range(bits - 4, -1, -4):
        options = []
        for w in WIDTHS:
            if s + w <= bits:
                mark = 1 + 32 / RANK_BITS if s + w < bits else 0
                options.append((longer[s] * (w + mark) + best[s + w][0], [w, *best[s + w][1]]))
        best[s] = min(options)
    return best[0][1]


def _padded(data: bytes) -> bytes:
    return data + bytes(-len(data) % 8)


def _packed(chunks: np.ndarray, width: int) -> bytes:
    """The low ``width`` bits of each chunk, end to end."""
    if width in (8, 16):
        return chunks.astype(np.uint8 if width == 8 else "<u2").tobytes()
    n = width // 4
    halves = np.zeros(len(chunks) * n + (len(chunks) * n & 1), np.uint8)
    for k in range(n):
        halves[k : len(chunks) * n : n] = (chunks >> np.uint32(4 * k)) & np.uint32(15)
    return (halves[0::2] | halves[1::2] << np.uint8(4)).tobytes()


def _unpacked(packed: np.ndarray, width: int, n: int) -> np.ndarray:
    if width in (8, 16):
        return packed.view(np.uint8 if width == 8 else "<u2")[:n]
    halves = np.empty(2 * len(packed), np.uint8)
    halves[0::2] = packed & np.uint8(15)
    halves[1::2] = packed >> np.uint8(4)
    k = width // 4
    out = halves[0 : n * k : k].astype(np.uint16)
    for i in range(1, k):
        out |= halves[i : n * k : k].astype(np.uint16) << np.uint16(4 * i)
    return out


def encode(ids: np.ndarray, doc_ids: list, counts: list[int], task: int = 0, number: int = 0) -> bytes:
    """The bytes of a segment: ``ids`` (unsigned 32 bits) of all documents end to end, ``counts`` of them a document."""
    widths = level_widths(ids)
    out = [MAGIC, struct.pack("<5Q", task, number, len(doc_ids), len(ids), len(widths))]
    rest, first = ids.astype(np.uint32, copy=False), 0
    for width in widths:
        more = rest >= np.uint32(1 << width)
        bitmap = np.packbits(more, bitorder="little")
        blocks = np.arange(0, len(bitmap), RANK_BITS // 8)
        ones = np.add.reduceat(np.bitwise_count(bitmap), blocks, dtype=np.int64) if len(blocks) else np.zeros(0, np.int64)
        directory = (np.cumsum(ones) - ones).astype("<u4")
        out.append(struct.pack("<4Q", first, width, len(rest), int(ones.sum())))
        chunks = _packed(rest & np.uint32((1 << width) - 1), width)
        out += [_padded(chunks), _padded(bitmap.tobytes()), _padded(directory.tobytes())]
        rest = rest[more] >> np.uint32(width)
        first += width
    out.append(np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes())
    out.append(bytes(d is not None for d in doc_ids))
    out.append(np.array(counts, "<u8").tobytes())
    return b"".join(out)


class Segment:
    """A segment's bytes, read in place."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("these are no bytes of a segment")
        self.task, self.number, self.n_docs, self.n_ids, levels = struct.unpack_from("<5Q", data, 4)
        at, self.levels = 44, []
        for _ in range(levels):
            first, width, n, _ones = struct.unpack_from("<4Q", data, at)
            at += 32
            sizes = -(-n * width // 8), -(-n // 8), 4 * -(-n // RANK_BITS)
            parts = []
            for size in sizes:
                parts.append(np.frombuffer(data, np.uint8, size, at))
                at += size + -size % 8
            self.levels.append((first, width, n, parts[0], parts[1], parts[2].view("<u4")))
        self._at, self._data = at, data

    def documents(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Id, whether there is one, and number of ids of each document."""
        at, n = self._at, self.n_docs
        ids = np.frombuffer(self._data, "<i8", n, at)
        known = np.frombuffer(self._data, np.uint8, n, at + 8 * n).astype(bool)
        return ids, known, np.frombuffer(self._data, "<u8", n, at + 9 * n).astype(np.int64)

    @staticmethod
    def _chunks(packed: np.ndarray, width: int, at: np.ndarray) -> np.ndarray:
        bit = at * width
        byte, out = bit >> 3, np.zeros(len(at), np.uint32)
        for k in range(3):  # 16 bits that begin within a byte reach into the third
            inside = byte + k < len(packed)
            out |= np.where(inside, packed[np.minimum(byte + k, len(packed) - 1)], 0).astype(np.uint32) << np.uint32(8 * k)
        return (out >> (bit & 7).astype(np.uint32)) & np.uint32((1 << width) - 1)

    @staticmethod
    def _rank(bitmap: np.ndarray, directory: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Set bits before each place: the directory's entry, then at most a block of bits."""
        out = directory[at // RANK_BITS].astype(np.int64)
        begin = at // RANK_BITS * (RANK_BITS // 8)
        for k in range(RANK_BITS // 8):
            byte = begin + k
            left = np.clip(at - 8 * byte, 0, 8)
            some = left > 0
            if not some.any():
                break
            mask = (np.uint32(1) << left[some].astype(np.uint32)) - np.uint32(1)
            out[some] += np.bitwise_count(bitmap[byte[some]] & mask.astype(np.uint8))
        return out

    def at(self, places: np.ndarray) -> np.ndarray:
        """The ids at ``places`` (from 0), in any order; one step a level for each."""
        places = np.asarray(places, np.int64)
        if len(places) and not (0 <= places.min() and places.max() < self.n_ids):
            raise IndexError("a place outside the segment")
        out = np.zeros(len(places), np.uint32)
        who, at = np.arange(len(places)), places
        for first, width, _, packed, bitmap, directory in self.levels:
            if not len(who):
                break
            out[who] |= self._chunks(packed, width, at) << np.uint32(first)
            more = (bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0
            who, at = who[more], self._rank(bitmap, directory, at[more])
        return out

    def all(self) -> np.ndarray:
        """All ids in order: each level's chunks, spread over the ids that go on in it."""
        out = np.zeros(0, np.uint32)
        for first, width, n, packed, bitmap, _ in reversed(self.levels):
            longer, out = out, _unpacked(packed, width, n).astype(np.uint32)
            if len(longer):
                out[np.unpackbits(bitmap, count=n, bitorder="little").view(bool)] |= longer << np.uint32(width)
        return out


def write(
    docs: DataFrame, path: str, tokenizer: str, pattern: str, end_id: int = 0, segment_ids: int = SEGMENT_IDS
) -> None:
    """Write the ids of all documents, each followed by ``end_id``, to the new folder ``path``, in ascending order of doc_id.

    Ids are those of ``tokenizer``, a byte-level file of the ``tokenizers`` library that executors can read and whose pattern
    is ``pattern``, no special tokens added. Rows without an id come first, rows of one id in an order that only their texts
    decide, repeated rows one after the other. Null text is empty and has its end only. An empty table leaves an empty
    manifest. Extra columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_hash().alias("h"), "text")
    placed = rows.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h")
    last = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer not in _TOKENS:
            _TOKENS[tokenizer] = Tokens(tokenizer, pattern)
        number, fill, owners, parts = 0, 0, [], []

        def close() -> pa.RecordBatch:
            nonlocal number, fill, owners, parts
            ids = np.frombuffer(b"".join(parts), "<u4")
            data = encode(ids, owners, [len(x) // 4 for x in parts], TaskContext.get().partitionId(), number)
            number, fill, owners, parts = number + 1, 0, [], []
            return pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], ["segment"])

        for group in B.documents(batches):
            found = text_ids(_TOKENS[tokenizer], [t.decode() for t in group.texts])
            for owner, ids in zip(group.rows.column(0).to_pylist(), found, strict=True):
                owners.append(owner)
                parts.append(ids + last)
                fill += len(ids) // 4 + 1
                if fill >= segment_ids:
                    yield close()
        if parts:
            yield close()

    segments = map_arrow(placed.select("doc_id", "text"), run, "segment binary")
    segments.select(F.col("segment").cast("string").alias("value")).write.option("maxRecordsPerFile", 1).text(f"{path}/segments")
    spark = docs.sparkSession
    heads = map_arrow(_files(spark, path), _headers, "file string, task long, number long, n_docs long, n_ids long")
    before = F.sum("n_ids")
    # Ids before a file: in its task, and in the tasks before, of which there is one row each.
    in_task = before.over(Window.partitionBy("task").orderBy("number").rowsBetween(Window.unboundedPreceding, -1))
    tasks = heads.groupBy("task").agg(before.alias("n_ids")).select(
        F.col("task").alias("_task"),
        before.over(Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)).alias("_base"),
    )
    start = F.coalesce("_base", F.lit(0)) + F.coalesce(in_task, F.lit(0))
    manifest = heads.join(tasks, F.col("task") == F.col("_task")).withColumn("base", start)
    manifest.select("file", "task", "number", "n_docs", "n_ids", "base").write.parquet(f"{path}/manifest")


def _files(spark: SparkSession, path: str) -> DataFrame:
    """file (its name without the folder) and content."""
    files = spark.read.format("binaryFile").load(f"{path}/segments").filter("length > 1")
    return files.select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")


def _headers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        heads = [struct.unpack_from("<4Q", x.as_buffer(), 4) for x in batch.column(1)]
        columns = [batch.column(0), *(pa.array([h[k] for h in heads], pa.int64()) for k in range(4))]
        yield pa.RecordBatch.from_arrays(columns, ["file", "task", "number", "n_docs", "n_ids"])


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """file, task, number, n_docs, n_ids and base (the ids in all files before) of each file."""
    return spark.read.parquet(f"{path}/manifest")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (the ids of all documents before), n_tokens and ids of each document in the files of ``path``.

    ids are binary, unsigned 32 bits little-endian each, with the end. Files are decoded one by one. Documents come back as
    often and under the id (or null) with which they were written. An empty folder gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for base, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                segment = Segment(content.as_py())
                owner, known, counts = segment.documents()
                ends = np.cumsum(counts)
                data = segment.all().astype("<u4").tobytes()
                ids = [data[4 * (e - n) : 4 * e] for e, n in zip(ends.tolist(), counts.tolist(), strict=True)]
                for k in range(0, len(ids), 4096):
                    s = slice(k, k + 4096)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(owner[s], mask=~known[s]), pa.array((base + ends - counts)[s]), pa.array(counts[s]),
                         pa.array(ids[s], pa.binary())],
                        ["doc_id", "start", "n_tokens", "ids"],
                    )

    files = _files(spark, path).join(manifest(spark, path).select("file", "base"), "file").select("base", "content")
    return map_arrow(files, run, "doc_id long, start long, n_tokens long, ids binary")


def tokens_at(positions: DataFrame, path: str, position: str = "position") -> DataFrame:
    """The rows of ``positions`` with token_id, the id at the global ``position`` (from 0 over all files); null where it is null or outside.

    Positions and files meet by cells of the position, so none meets all of the other. A file is read once for all positions in
    it, each by one step a level. Repeated positions give repeated rows. A column token_id is replaced, others stay.
    """
    spark = positions.sparkSession
    wanted = positions.drop("token_id")
    names = wanted.columns
    place = F.col(position).cast("long")
    files = manifest(spark, path).filter("n_ids > 0").select("file", "base", "n_ids")
    cells = F.explode(F.sequence(F.shiftright("base", CELL_BITS), F.shiftright(F.col("base") + F.col("n_ids") - 1, CELL_BITS)))
    asked = wanted.select(place.alias("_place")).filter("_place is not null").distinct()
    asked = asked.withColumn("_cell", F.shiftright("_place", CELL_BITS))
    met = asked.join(files.withColumn("_cell", cells), "_cell").filter("_place >= base and _place < base + n_ids")
    # One row a file and 65,536 of its positions, so that a file that all ask for is shared out.
    lists = met.groupBy("file", "base", F.shiftright(F.col("_place") - F.col("base"), 16).alias("_part")).agg(
        F.collect_list(F.col("_place") - F.col("base")).alias("_at")
    )
    held = lists.join(_files(spark, path), "file").select("base", "_at", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for base, at, content in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                at = at.values.to_numpy()
                ids = Segment(content.as_py()).at(at)
                yield pa.RecordBatch.from_arrays([pa.array(base + at), pa.array(ids.astype(np.int64))], ["_at", "token_id"])

    found = map_arrow(held, run, "_at long, token_id long")
    return wanted.join(found, place == F.col("_at"), "left").select(*[wanted[c] for c in names], "token_id")
