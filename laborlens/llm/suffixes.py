"""Removal of strings that stand more than once, by sorting suffixes.

A string of ``length`` bytes is repeated if two suffixes share that many bytes. Sorting every suffix of a corpus moves it
many times over, so suffixes that can't have a partner go first: each window of ``length`` bytes has an anchor, the
place of its smallest hash, and equal windows have equal anchors. Anchors that stand once have no partner, and anchors
whose whole surroundings stand twice need no sort. The suffixes in between are sorted deep-shallow: multikey quicksort on the
first bytes, then a blind trie for each group that still agrees.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laborlens.llm import bytesops as B
from laborlens.llm.frames import map_arrow, stage
from laborlens.llm.spans import KEY, cut, keyed, packed, unpack

#: Bytes of an anchor; bytes that the quicksort looks at; windows of an anchor that are sorted together.
ANCHOR, SHALLOW, BLOCK = 32, 32, 32
#: With more different surroundings than this, the windows of an anchor are counted by digest instead of sorted.
CROWD = 4096


class BlindTrie:
    """A trie that keeps branching bytes only. Inserting compares a string with one leaf, wherever the blind descent ends."""

    def __init__(self, length: int):
        self.length = length
        self.root = None

    def insert(self, text: bytes, name: int) -> None:
        if self.root is None:
            self.root = (text, [name])
            return
        node = self.root
        while isinstance(node[0], int):
            node = node[1].get(text[node[0]]) or next(iter(node[1].values()))
        other, names = node
        if other == text:
            names.append(name)
            return
        differ = int.from_bytes(other, "big") ^ int.from_bytes(text, "big")
        depth = self.length - (differ.bit_length() + 7) // 8
        parent, node = None, self.root
        while isinstance(node[0], int) and node[0] < depth:
            parent, node = node, node[1][text[node[0]]]
        if isinstance(node[0], int) and node[0] == depth:
            node[1][text[depth]] = (text, [name])
            return
        branch = (depth, {other[depth]: node, text[depth]: (text, [name])})
        if parent is None:
            self.root = branch
        else:
            parent[1][text[parent[0]]] = branch

    def leaves(self) -> Iterator[list[int]]:
        """Names of equal strings, in the order of the strings."""
        stack = [self.root] if self.root else []
        while stack:
            node = stack.pop()
            if isinstance(node[0], int):
                stack.extend(node[1][c] for c in sorted(node[1], reverse=True))
            else:
                yield node[1]


def repeated(data: bytes, starts: np.ndarray, length: int) -> np.ndarray:
    """Which of the suffixes at ``starts`` share ``length`` bytes with another of them. ``data`` reaches that far."""
    flags = np.zeros(len(starts), bool)
    padded = data + bytes(8)
    words = np.ndarray(len(data) + 1, dtype=">u8", buffer=padded, strides=(1,))
    active, group = np.arange(len(starts)), np.zeros(len(starts), np.int64)
    for depth in range(0, min(SHALLOW, length - 7), 8):  # a pass of the quicksort takes eight bytes as one letter
        letter = words[starts[active] + depth].astype(np.uint64)
        order = np.lexsort((letter, group))
        active, letter, group = active[order], letter[order], group[order]
        group = np.cumsum(np.r_[True, (group[1:] != group[:-1]) | (letter[1:] != letter[:-1])]) - 1 if len(group) else group
        crowded = np.bincount(group)[group] > 1 if len(group) else group > 0
        active, group = active[crowded], group[crowded]
    if not len(active):
        return flags
    cut_at = np.flatnonzero(np.r_[True, group[1:] != group[:-1], True])
    names, at = active.tolist(), starts[active].tolist()
    for lo, hi in zip(cut_at[:-1].tolist(), cut_at[1:].tolist(), strict=True):
        if hi - lo == 2:
            if data[at[lo] : at[lo] + length] == data[at[lo + 1] : at[lo + 1] + length]:
                flags[names[lo]] = flags[names[lo + 1]] = True
            continue
        trie = BlindTrie(length)
        for i in range(lo, hi):
            trie.insert(data[at[i] : at[i] + length], names[i])
        for equal in trie.leaves():
            if len(equal) > 1:
                flags[equal] = True
    return flags


def _window_minimum(keys: np.ndarray, size: int) -> np.ndarray:
    span = 1
    while 2 * span <= size:
        keys = np.minimum(keys[:-span], keys[span:])
        span *= 2
    return np.minimum(keys[: len(keys) - (size - span)], keys[size - span :]) if span < size else keys


def _anchors(length: int):
    """doc_id, tag, place, print and surroundings of each anchor.

    ``place`` packs the first window that has the anchor, how many more follow, and where in that window it lies.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for docs in B.documents(batches):
            data = docs.joined()
            long = np.flatnonzero(docs.lengths >= length)
            if not len(long):
                continue
            prefix = B.Prefix(data)
            hashes = prefix.windows(ANCHOR)
            order = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)
            anchor = (_window_minimum(order, length - ANCHOR + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
            windows = docs.lengths[long] - length + 1
            base = np.repeat(docs.starts[long] - (np.cumsum(windows) - windows), windows)
            start = base + np.arange(len(base))
            owner = np.repeat(long, windows)
            at = anchor[start]
            first = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (owner[1:] != owner[:-1])])
            begin, last = start[first], start[np.r_[first[1:] - 1, len(start) - 1]]
            at, owner = at[first], owner[first]
            more, inside = last - begin, at - begin
            print_ = hashes[at]
            around = prefix.spans(begin, last + length) ^ B.mix(inside.astype(np.uint64) + np.uint64(9))
            place = (begin - docs.starts[owner]) << 16 | more << 8 | inside
            take = pa.array(owner)
            yield pa.RecordBatch.from_arrays(
                [docs.rows.column(0).take(take), docs.rows.column(1).take(take), pa.array(place),
                 B.as_signed(print_.copy()), B.as_signed(around.copy())],
                [*KEY, "place", "print", "around"],
            )

    return run


def _blocks(length: int, by_digest: bool):
    """Windows of the anchors of a document: in blocks with their bytes, or one by one with a digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                part = batch.slice(i, 64)
                keys, ids, tags, starts, counts, texts = [], [], [], [], [], []
                for doc_id, tag, text, places in zip(*(part.column(c).to_pylist() for c in range(4)), strict=True):
                    data = unpack(text)
                    prefix = B.Prefix(np.frombuffer(data, np.uint8)) if data else None
                    lo, hi, core_lo, core_hi = [], [], [], []
                    for place in places:
                        begin, more, inside = place >> 16, place >> 8 & 255, place & 255
                        at, last = begin + inside, begin + more
                        if by_digest:
                            lo += range(begin, last + 1)
                            hi += range(begin, last + 1)
                            continue
                        # Blocks lie at fixed distances before the anchor, so that equal windows fall into equal blocks.
                        for b in range((at - last) // BLOCK, (at - begin) // BLOCK + 1):
                            first, final = max(begin, at - BLOCK * b - BLOCK + 1), min(last, at - BLOCK * b)
                            lo.append(first)
                            hi.append(final)
                            core_lo.append(at - BLOCK * b)
                            core_hi.append(at - BLOCK * b - BLOCK + 1 + length)
                    if by_digest:
                        core_lo, core_hi = lo, [x + length for x in lo]
                    n = len(lo)
                    keys.append(prefix.spans(np.array(core_lo), np.array(core_hi)))
                    ids += [doc_id] * n
                    tags += [tag] * n
                    starts += lo
                    counts += [b - a + 1 for a, b in zip(lo, hi, strict=True)]
                    texts += [b""] * n if by_digest else [data[a : b + length] for a, b in zip(lo, hi, strict=True)]
                if keys:
                    yield pa.RecordBatch.from_arrays(
                        [B.as_signed(np.concatenate(keys)), pa.array(ids, pa.int64()), pa.array(tags, pa.int32()),
                         pa.array(starts, pa.int64()), pa.array(counts, pa.int64()), pa.array(texts, pa.binary())],
                        ["core", *KEY, "start", "n", "bytes"],
                    )

    return run


def _sort(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: list[tuple] = []
        texts: list[bytes] = []
        size = 0

        def finish() -> pa.RecordBatch:
            counts = np.array([n[3] for n in names])
            lengths = np.array([len(t) for t in texts])
            base = np.cumsum(lengths) - lengths
            within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            flags = repeated(b"".join(texts), np.repeat(base, counts) + within, length)
            row = np.repeat(np.arange(len(names)), counts)[flags]
            start = np.array([n[2] for n in names])[row] + within[flags]
            first = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (start[1:] != start[:-1] + 1)]) if len(row) else row
            last = np.r_[first[1:] - 1, len(row) - 1] if len(row) else row
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([names[r][0] for r in row[first]], pa.int64()),
                    pa.array([names[r][1] for r in row[first]], pa.int32()),
                    pa.array(start[first], pa.int64()), pa.array(start[last] + length, pa.int64()),
                ],
                [*KEY, "start", "end"],
            )

        key, held = None, []
        for batch in batches:
            for core, *name, text in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                if core != key:
                    if len(held) > 1:
                        names += [h[0] for h in held]
                        texts += [h[1] for h in held]
                        size += sum(len(h[1]) for h in held)
                    if size > B.BUFFER:
                        yield finish()
                        names, texts, size = [], [], 0
                    key, held = core, []
                held.append((tuple(name), text))
        if len(held) > 1:
            names += [h[0] for h in held]
            texts += [h[1] for h in held]
        if names:
            yield finish()

    return run


def repeated_spans(docs: DataFrame, texts: DataFrame, length: int = 200) -> DataFrame:
    """key, start and end of spans that cover each byte of every repeated string of ``length`` bytes.

    ``docs`` are :func:`spans.keyed` rows and ``texts`` the same ones packed.
    """
    anchors = map_arrow(docs, _anchors(length), "doc_id long, tag int, place long, print long, around long")
    # Counting combines in each task before it moves. Joins read their aggregates from tables: only then can Spark split
    # a print that very many rows share.
    prints = anchors.groupBy("print").agg(F.count("*").alias("n"), F.min("around").alias("lo"), F.max("around").alias("hi"))
    prints = stage(prints.filter("n > 1").select("print", (F.col("lo") != F.col("hi")).alias("mixed")))
    unmixed = lambda c: F.when(F.col("mixed"), F.col(c)).alias(c)  # noqa: E731  what is settled needs no hashes
    shared = stage(anchors.join(prints, "print").select(*KEY, "place", "mixed", unmixed("print"), unmixed("around")))

    mixed = shared.filter("mixed").drop("mixed")
    around = stage(mixed.groupBy("print", "around").agg(F.count("*").alias("n"), F.min("doc_id").alias("first")))
    crowds = stage(around.groupBy("print").agg(F.count("*").alias("m")))
    around = stage(around.join(crowds, "print"))
    known = mixed.join(around, ["print", "around"])
    begin, more = F.shiftright("place", 16), F.shiftright("place", 8).bitwiseAND(255)
    spans = lambda df: df.select(*KEY, begin.alias("start"), (begin + more + length).alias("end"))
    settled = spans(shared.filter("not mixed")).unionByName(spans(known.filter("n > 1")))

    # One row for each surroundings, or those of one document, stands for all of them in the sort.
    asked = known.filter((F.col("n") == 1) | F.col("doc_id").eqNullSafe(F.col("first")))

    def windows(which: DataFrame, by_digest: bool) -> DataFrame:
        places = which.groupBy(*KEY).agg(F.collect_list("place").alias("places"))
        named = places.withColumnsRenamed({c: f"_{c}" for c in KEY})
        on = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("tag") == F.col("_tag"))
        fetched = texts.join(named, on).select(*KEY, "packed", "places")
        schema = "core long, doc_id long, tag int, start long, n long, bytes binary"
        return map_arrow(fetched, _blocks(length, by_digest), schema)

    blocks = windows(asked.filter(F.col("m") <= CROWD), by_digest=False)
    dealt = blocks.repartition("core").sortWithinPartitions("core")
    out = settled.unionByName(map_arrow(dealt, _sort(length), "doc_id long, tag int, start long, end long"))
    if around.filter(F.col("m") > CROWD).limit(1).count():
        single = windows(asked.filter(F.col("m") > CROWD), by_digest=True).drop("bytes")
        twice = single.groupBy("core").agg(F.count("*").alias("k")).filter("k > 1").select("core")
        crowd = single.join(twice, "core").select(*KEY, "start", (F.col("start") + length).alias("end"))
        out = out.unionByName(crowd)
    return out


def remove_repeats(docs: DataFrame, length: int = 200, with_text: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans and kept_sha256.

    Each byte goes that a string of ``length`` bytes covers which also starts anywhere else, in the same row or another,
    as UTF-8; strings never cross rows and overlapping ones count. Null text is empty. Rows that repeat id and text are
    copies of each other. with_text adds kept_text. Extra columns are ignored. ``length`` is at least 64 and at most 255.
    """
    if not 2 * ANCHOR <= length <= 255:
        raise ValueError(f"length must be from {2 * ANCHOR} to 255: {length}")
    rows = keyed(docs)
    # The filter drops nothing. The join in repeated_spans would add it; with it here, both joins share one exchange.
    texts = packed(rows).filter("tag is not null")
    return cut(texts, repeated_spans(rows, texts, length), with_text=with_text).drop("tag")
