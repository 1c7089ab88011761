"""Near-duplicate documents by HyperMinHash.

Each shingle hash falls into one of a document's buckets; a bucket keeps its smallest hash as a register of 16 bits, the
number of leading zeros and the bits that follow. Documents that agree in a band of registers are candidates. Candidates are
filtered by the similarity that their registers show, corrected for registers that agree by chance, and what is left is
confirmed on the full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laborlens.llm import bytesops as B
from laborlens.llm.components import connected_components
from laborlens.llm.frames import map_arrow, row_hash, split_join, stage
from laborlens.llm.spans import unpack

#: Bands and registers in a band. A pair of similarity 0.8 is missed with a chance of 3e-6, one of 0.85 with 7e-9.
BANDS, ROWS = 32, 5
REGISTERS = BANDS * ROWS
MANTISSA = 10
EMPTY = 0xFFFF
#: Documents compared in one task, by their registers and by their full sets; larger groups are cut into blocks that
#: meet two by two.
BUCKET_BLOCK, BLOCK = 2048, 512


def shingle_sets(docs: B.Docs, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all documents, by document and ascending, and where each document's begin.

    A document with fewer words has its whole sequence as one shingle, one without words has none.
    """
    data = docs.joined(lower=True)
    start, end = B.word_spans(data)
    owner = np.searchsorted(docs.starts, start, side="right") - 1
    word = B.Prefix(data).spans(start, end)
    first = np.searchsorted(owner, np.arange(len(docs) + 1))

    def fold(at: np.ndarray, n: int) -> np.ndarray:
        out = np.full(len(at), n, np.uint64)
        for k in range(n):
            out = B.mix(out + word[at + k])
        return out

    count = np.diff(first)
    at = np.arange(max(0, len(word) - words + 1))
    at = at[owner[at] == owner[at + words - 1]] if len(at) else at
    full = fold(at, words)
    bounds = np.searchsorted(owner[at], np.arange(len(docs) + 1))
    short = {}
    for n in range(1, words):
        which = np.flatnonzero(count == n)
        short.update(zip(which.tolist(), fold(first[which], n), strict=True))
    sets = []
    for i, n in enumerate(count.tolist()):
        sets.append(np.unique(full[bounds[i] : bounds[i + 1]]) if n >= words else np.array([short[i]] if n else [], np.uint64))
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    return (np.concatenate(sets) if sets else np.zeros(0, np.uint64)), np.r_[0, np.cumsum(sizes)]


def registers(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A row of registers for each set; ``values`` ascend within a set."""
    n = len(bounds) - 1
    out = np.full((n, REGISTERS), EMPTY, np.uint16)
    if not len(values):
        return out
    owner = np.repeat(np.arange(n), np.diff(bounds))
    scaled = (values >> np.uint64(32)) * np.uint64(REGISTERS)
    bucket = (scaled >> np.uint64(32)).astype(np.int64)
    cell = owner * REGISTERS + bucket
    first = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
    rest = (scaled[first] << np.uint64(32)) | (values[first] & np.uint64(0xFFFFFFFF))
    fraction, exponent = np.frexp(rest.astype(np.float64) + 1.0)
    zeros = np.clip(65 - exponent, 0, 62).astype(np.uint16)
    mantissa = ((fraction * 2 - 1) * (1 << MANTISSA)).astype(np.uint16)
    out.ravel()[cell[first]] = (zeros << np.uint16(MANTISSA)) | mantissa
    return out


def similarity_estimate(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimated similarity of one row of registers to each row of ``b``, and the number of registers it rests on.

    Two different minima fall on one register with a chance of about 2**-MANTISSA / 3 (same leading zeros, same bits), on
    one byte of :func:`shortened` with 1 / 255; what agrees by that chance is taken off.
    """
    short = b.dtype == np.uint8
    empty, chance = (0, 1 / 255) if short else (EMPTY, 1 / (3 << MANTISSA))
    used = (a != empty) | (b != empty)
    n = used.sum(axis=1)
    agree = ((a == b) & used).sum(axis=1)
    return np.clip((agree / np.maximum(n, 1) - chance) / (1 - chance), 0, 1), n


def shortened(rows: np.ndarray) -> np.ndarray:
    """A byte of each register, 0 for an empty one: enough to estimate, and half as much to send."""
    mixed = (rows.astype(np.uint32) * np.uint32(0x9E3779B1)) >> np.uint32(8)
    return np.where(rows == EMPTY, 0, 1 + mixed % 255).astype(np.uint8)


def band_hashes(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and hashes of all bands with a filled register; the hash names the band."""
    bands = rows.reshape(len(rows), BANDS, ROWS)
    out = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), (len(rows), BANDS)).copy()
    for k in range(ROWS):
        out = B.mix(out * np.uint64(0x9E3779B97F4A7C15) + bands[:, :, k].astype(np.uint64) + np.uint64(1))
    filled = (bands != EMPTY).any(axis=2)
    return np.nonzero(filled)[0], out[filled]


def _sketch(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for docs in B.documents(batches):
            values, bounds = shingle_sets(docs, words)
            rows = registers(values, bounds)
            size = np.diff(bounds)
            sums = np.zeros((2, len(values) + 1), np.uint64)
            np.cumsum(values, out=sums[0, 1:])
            np.cumsum(B.mix(values ^ np.uint64(0x5851F42D4C957F2D)), out=sums[1, 1:])
            digest = sums[:, bounds[1:]] - sums[:, bounds[:-1]]
            yield pa.RecordBatch.from_arrays(
                [
                    *docs.rows.columns[:2], pa.array(size), B.as_signed(digest[0].copy()), B.as_signed(digest[1].copy()),
                    pa.array([r.tobytes() for r in rows], pa.binary()),
                ],
                ["doc_id", "h", "n_shingles", "d1", "d2", "registers"],
            )

    return run


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for begin in range(0, batch.num_rows, 4096):
            part = batch.slice(begin, 4096)
            rows = np.frombuffer(b"".join(part.column(1).to_pylist()), np.uint16).reshape(-1, REGISTERS)
            row, band = band_hashes(rows)
            yield pa.RecordBatch.from_arrays([B.as_signed(band), part.column(0).take(pa.array(row))], ["band", "node"])


def _short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint16).reshape(-1, REGISTERS)
        short = pa.array([r.tobytes() for r in shortened(rows)], pa.binary())
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], short], ["node", "n_shingles", "short"])


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([unpack(x.as_py()) for x in batch.column(5)], pa.binary())
            names = ["node", "cluster", "blocks", "n_shingles", "d1", "text"]
            for docs in B.documents(iter([pa.RecordBatch.from_arrays([*batch.columns[:5], texts], names)])):
                values, bounds = shingle_sets(docs, words)
                parts = [values[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                # Another row of the same id may have another text.
                same = [int(p.sum(dtype=np.uint64).view(np.int64)) == d for p, d in zip(parts, docs.rows[4].to_pylist(), strict=True)]
                sets = pa.array([p.tobytes() for p in parts], pa.binary())
                out = pa.RecordBatch.from_arrays([*docs.rows.columns[:4], sets], [*names[:4], "shingles"])
                yield out.filter(pa.array(same, pa.bool_()))

    return run


def _plausible(rows: np.ndarray, size: np.ndarray, similarity: int, side: np.ndarray | None) -> np.ndarray:
    """Pairs (upper half of a matrix) whose registers and sizes allow the similarity, by a margin of five deviations."""
    n, limit = len(rows), similarity / 100
    maybe = np.zeros((n, n), bool)
    for i in range(n - 1):
        smaller, larger = np.minimum(size[i], size[i + 1 :]), np.maximum(size[i], size[i + 1 :])
        near = 100 * smaller >= similarity * larger
        if side is not None:
            near &= side[i + 1 :] != side[i]
        at = np.flatnonzero(near) + i + 1
        if len(at):
            estimate, used = similarity_estimate(rows[i], rows[at])
            margin = 5 * np.sqrt(limit * (1 - limit) / np.maximum(used, 1)) + 1 / np.maximum(used, 1)
            maybe[i, at] = estimate >= limit - margin
    return maybe


def _forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """Links that join as many rows as all of a matrix do."""
    parent = list(range(len(linked)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for a, b in zip(*(x.tolist() for x in np.nonzero(linked)), strict=True):
        ra, rb = root(a), root(b)
        if ra != rb:
            parent[ra] = rb
            out.append((a, b))
    return out


def _confirmed(sets: list[np.ndarray], similarity: int, side: np.ndarray | None) -> np.ndarray:
    """Pairs of sets that have the similarity."""
    size = np.array([len(s) for s in sets])
    rows = registers(np.concatenate(sets), np.r_[0, np.cumsum(size)])
    maybe = _plausible(rows, size, similarity, side)
    involved = np.flatnonzero(maybe.any(axis=0) | maybe.any(axis=1))
    if not len(involved):
        return maybe
    # Sizes of intersections: products of 0/1 columns, one column a shingle that two sets share.
    index = np.repeat(np.arange(len(involved)), size[involved])
    shingle = np.concatenate([sets[i] for i in involved])
    _, column, times = np.unique(shingle, return_inverse=True, return_counts=True)
    rank, useful = np.cumsum(times > 1) - 1, times[column] > 1
    column, index = rank[column[useful]], index[useful]
    order = np.argsort(column, kind="stable")
    column, index = column[order], index[order]
    m, step = len(involved), 8192
    both = np.zeros((m, m), np.float32)
    total = int(column[-1]) + 1 if len(column) else 0
    for begin in range(0, total, step):
        lo, hi = np.searchsorted(column, [begin, begin + step])
        part = np.zeros((m, min(step, total - begin)), np.float32)
        part[index[lo:hi], column[lo:hi] - begin] = 1
        both += part @ part.T
    inter = both.astype(np.int64)
    total = size[involved][:, None] + size[involved][None, :] - inter
    maybe[np.ix_(involved, involved)] &= 100 * inter >= similarity * total
    return maybe


def _links(similarity: int, exact: bool):
    """Links in each group of rows (group, i, j, block, rep, size, content), as a spanning forest.

    The content is a set, and links are confirmed on it, or short registers, and links are plausible ones. A group (i, j) with
    two different blocks holds both, and only pairs across are compared.
    """

    def found(reps: list[int], sizes: list[int], contents: list[bytes], side: np.ndarray | None) -> list[tuple[int, int]]:
        if exact:
            return _forest(_confirmed([np.frombuffer(c, np.uint64) for c in contents], similarity, side))
        rows = np.frombuffer(b"".join(contents), np.uint8).reshape(-1, REGISTERS)
        return _forest(_plausible(rows, np.array(sizes), similarity, side))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, out = None, [], []

        def finish() -> None:
            if len(held) > 1:
                blocks, reps, sizes, contents = zip(*held, strict=True)
                side = np.array(blocks) if key[1] != key[2] else None
                out.extend((reps[a], reps[b]) for a, b in found(reps, sizes, contents, side))

        def flush() -> pa.RecordBatch:
            arrays = [pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)]
            out.clear()
            return pa.RecordBatch.from_arrays(arrays, ["a", "b"])

        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(7)]
            for group, i, j, *row in zip(*columns, strict=True):
                if key != (group, i, j):
                    finish()
                    key, held = (group, i, j), []
                held.append(row)
            yield flush()
        finish()
        yield flush()

    return run


def _tiles(rows: DataFrame, group: str, content: str) -> DataFrame:
    """Rows with ``blocks``, the number of blocks of their group, dealt out so that any two of a group meet once."""
    block = F.pmod(F.xxhash64("node"), F.col("blocks").cast("long")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = rows.select(group, "node", "n_shingles", content, block.alias("block"), other.alias("other"))
    i, j = F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")
    dealt = dealt.select(group, i, j, "block", "node", "n_shingles", content)
    return dealt.repartition(group, "i", "j").sortWithinPartitions(group, "i", "j")


def _blocks(rows: int) -> Column:
    return F.ceil(F.count("*") / rows).cast("int").alias("blocks")


def _grouped(docs: DataFrame, words: int, similarity: int) -> DataFrame:
    """doc_id, h, n_shingles, root and least of each row: its group (null without shingles) and the smallest id in it.

    A node is a set of shingles, whatever rows have it, so that rows of one id with unlike texts are nodes of their own.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_hash().alias("h"), "text")
    schema = "doc_id long, h long, n_shingles long, d1 long, d2 long, registers binary"
    sketches = stage(map_arrow(rows, _sketch(words), schema))
    node = F.xxhash64("n_shingles", "d1", "d2")
    filled = sketches.filter("n_shingles > 0 and doc_id is not null")
    nodes = stage(filled.groupBy(node.alias("node"), "n_shingles", "d1").agg(
        F.min("doc_id").alias("rep"), F.first("registers").alias("registers")
    ))

    # Candidates: nodes of one bucket whose registers are close enough.
    bands = map_arrow(nodes.select("node", "registers"), _bands, "band long, node long")
    buckets = bands.groupBy("band").agg(F.count("*").alias("n"), _blocks(BUCKET_BLOCK)).filter("n > 1")
    short = map_arrow(nodes.select("node", "n_shingles", "registers"), _short, "node long, n_shingles long, short binary")
    met = split_join(bands, buckets.drop("n"), "band", cut=stage).join(short.hint("merge"), "node")
    near = map_arrow(_tiles(met, "band", "short"), _links(similarity, exact=False), "a long, b long")
    clusters = stage(connected_components(near).withColumnRenamed("component", "cluster"))

    # Their full sets, by cluster of candidates.
    sizes = clusters.groupBy("cluster").agg(_blocks(BLOCK))
    members = split_join(clusters, sizes, "cluster", cut=stage).join(nodes.drop("registers").hint("merge"), "node")
    packed = map_arrow(rows.filter("doc_id is not null").select("doc_id", "text"), _pack, "doc_id long, packed binary")
    texts = members.join(packed, F.col("rep") == F.col("doc_id"))
    texts = texts.select("node", "cluster", "blocks", "n_shingles", "d1", "packed")
    sets = map_arrow(texts, _sets(words), "node long, cluster long, blocks int, n_shingles long, shingles binary")
    links = map_arrow(_tiles(sets, "cluster", "shingles"), _links(similarity, exact=True), "a long, b long")
    groups = connected_components(links)

    named = stage(
        nodes.select("node", "rep").join(groups, "node", "left").select("node", "rep", F.coalesce("component", "node").alias("root"))
    )
    least = named.groupBy("root").agg(F.min("rep").alias("least"))
    named = split_join(named.drop("rep"), least, "root", cut=stage)
    own = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), node)
    found = sketches.drop("registers").withColumn("node", own)
    return found.join(named, "node", "left").select("doc_id", "h", "n_shingles", "root", "least")


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    squeeze = zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        texts = [squeeze((t.as_py() or "").encode()) for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary())], ["doc_id", "packed"])


def near_duplicates(docs: DataFrame, words: int = 5, similarity: int = 80) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id and kept.

    Documents are linked when ``100 * intersection >= similarity * union`` of their sets of distinct word shingles, lower
    case in A-Z. component_id is the smallest doc_id that links reach; kept where that is the row's own. Null and empty
    texts have no shingles and are linked with nothing, like rows without an id, which are kept under a null component.
    Documents with equal sets are one node, whatever their number, so copies are never paired. Rows of one id with different
    texts are linked by their texts alone, each with its own component_id. Extra columns are ignored.
    """
    found = _grouped(docs, words, similarity)
    return found.select("doc_id", "n_shingles", F.coalesce("least", "doc_id").alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )


def keep_one(docs: DataFrame, words: int = 5, similarity: int = 80) -> DataFrame:
    """``docs`` with one document of each group of near-duplicates, that of the smallest id; columns stay as they are.

    Of several rows of that id in the group the one with the smallest hash of its text stays. Rows of one id with unlike texts
    are in different groups, and one of each stays; rows that repeat both id and text are one. Rows without an id or without
    words are linked with nothing and stay, repeats of an id and text apart.
    """
    found = _grouped(docs, words, similarity).filter("doc_id is not null")
    first = found.filter("root is not null and doc_id = least").groupBy("root", "doc_id").agg(F.min("h").alias("h"))
    alone = found.filter("root is null").select("doc_id", "h")
    kept = first.select("doc_id", "h").unionByName(alone).distinct()
    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_hash().alias("h"), F.struct(*docs.columns).alias("row"))
    named = whole.filter("doc_id is not null").join(kept, ["doc_id", "h"], "left_semi").dropDuplicates(["doc_id", "h"])
    return named.select("row.*").unionByName(docs.filter("doc_id is null"))
