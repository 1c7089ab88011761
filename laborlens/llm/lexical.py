"""Ranked lexical search, half term-at-a-time and half document-at-a-time.

Documents are indexed in segments. An item's short lists (rare terms) are summed into accumulators, a term at a time; these
accumulators are then one more list, with a bound of its own, beside the item's long lists. All of these are walked together
in order of documents: where the bounds of a block of documents add up to less than the tenth best score known, the block is
skipped in every list. The accumulators of all segments give the first such score, before any long list is touched.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from laborlens.llm import bytesops as B
from laborlens.llm.frames import map_arrow, stage

#: Bytes of text and documents in a segment, documents in a block that is skipped or read, and documents between two looks at
#: the tenth best score.
SEGMENT_BYTES, SEGMENT_DOCS, BLOCK, STRIDE = 8 << 20, 16_384, 128, 4096
#: Pairs of item and term that one pass over the documents takes; items beyond it take further passes.
PASS_PAIRS = 1 << 18
#: Lists are short while all of an item's shorter ones together name at most this share of all documents; the shortest always is.
SHORT_SHARE = 1 / 16

#: Bytes of terms: digits, letters, and all bytes of characters beyond ASCII.
IS_TERM = np.zeros(256, bool)
IS_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def term_hashes(docs: B.Docs) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each term of a group of documents, and which of them it stands in."""
    data = docs.joined(lower=True)
    solid = np.zeros(len(data) + 2, bool)
    solid[1:-1] = IS_TERM[data]
    edge = np.flatnonzero(solid[1:] != solid[:-1])
    start, end = edge[0::2], edge[1::2]
    return B.Prefix(data).spans(start, end), np.searchsorted(docs.starts, start, side="right") - 1


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for docs in B.documents(batches):
        term, owner = term_hashes(docs)
        _, once = np.unique(B.mix(term + B.mix(owner.astype(np.uint64))), return_index=True)
        take = pa.array(owner[once])
        yield pa.RecordBatch.from_arrays([docs.rows.column(0).take(take), B.as_signed(term[once])], ["item", "term"])


class Query:
    """The items of a pass: for each the numbers of its terms in ``terms``, ascending hashes."""

    def __init__(self, pairs: list[tuple]):
        hashes = np.array([t for _, t in pairs], np.int64).view(np.uint64)
        self.terms, number = np.unique(hashes, return_inverse=True)
        self.items = sorted({i for i, _ in pairs}, key=lambda i: (i is not None, i or 0))
        of = {i: k for k, i in enumerate(self.items)}
        item = np.array([of[i] for i, _ in pairs], np.int64)
        order = np.argsort(item, kind="stable")
        self.term = number[order].astype(np.int64)
        self.bounds = np.searchsorted(item[order], np.arange(len(self.items) + 1))

    def weigh(self, df: np.ndarray, n: int) -> None:
        """Integer weights of all terms, and each item's terms from rare to frequent with the number of short ones."""
        self.weight = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * f + 1))) for f in df.tolist()], np.int64)
        self.short = np.zeros(len(self.items), np.int64)
        for k in range(len(self.items)):
            a, b = self.bounds[k], self.bounds[k + 1]
            own = self.term[a:b][np.argsort(df[self.term[a:b]], kind="stable")]
            self.term[a:b] = own
            self.short[k] = max(1, int((np.cumsum(df[own]) <= SHORT_SHARE * n).sum()))


def _segments(terms: np.ndarray):
    """Index segments: documents in order of their ids, their lengths, and the postings of the terms asked for."""
    # Most terms of a document are told by 16 bits not to be among them.
    likely = np.zeros(1 << 16, bool)
    likely[(terms >> np.uint64(48)).astype(np.int64)] = True

    def one(docs: B.Docs) -> pa.RecordBatch:
        term, owner = term_hashes(docs)
        known = docs.rows.column(0)
        order = np.lexsort((known.fill_null(0).to_numpy(), known.is_null().to_numpy(zero_copy_only=False)))
        place = np.empty(len(docs), np.int64)
        place[order] = np.arange(len(docs))
        length = np.bincount(place[owner], minlength=len(docs)).astype(np.int64) if len(owner) else np.zeros(len(docs), np.int64)
        maybe = np.flatnonzero(likely[(term >> np.uint64(48)).astype(np.int64)])
        number = np.searchsorted(terms, term[maybe])
        hit = terms[np.minimum(number, len(terms) - 1)] == term[maybe] if len(terms) else np.zeros(0, bool)
        cell, tf = np.unique(number[hit] * len(docs) + place[owner[maybe[hit]]], return_counts=True)
        lists, size = np.unique(cell // len(docs), return_counts=True)
        columns = {
            "n_docs": pa.array([int((length > 0).sum())], pa.int64()), "n_terms": pa.array([int(length.sum())], pa.int64()),
            "doc_ids": pa.array([known.take(pa.array(order)).to_pylist()], pa.list_(pa.int64())),
            "lengths": pa.array([length.tobytes()], pa.binary()), "terms": pa.array([lists.astype("<i4").tobytes()], pa.binary()),
            "sizes": pa.array([size.astype("<i4").tobytes()], pa.binary()),
            "docs": pa.array([(cell % len(docs)).astype("<i4").tobytes()], pa.binary()),
            "tfs": pa.array([tf.astype("<i4").tobytes()], pa.binary()),
        }
        return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        small = (b.slice(k, SEGMENT_DOCS) for b in batches for k in range(0, b.num_rows, SEGMENT_DOCS))
        for docs in B.documents(small, limit=SEGMENT_BYTES):
            yield one(docs)

    return run


_SEGMENT = "n_docs long, n_terms long, doc_ids array<long>, lengths binary, terms binary, sizes binary, docs binary, tfs binary"


def _frequencies(n: int):
    """Documents of the segments of a task by term, as rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(n, np.int64)
        for batch in batches:
            for terms, sizes in zip(batch.column(0), batch.column(1), strict=True):
                df[np.frombuffer(terms.as_py(), "<i4")] += np.frombuffer(sizes.as_py(), "<i4")
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(df[some])], ["term", "df"])

    return run


class Index:
    """A segment's lists with their scores, and bounds by list and block."""

    def __init__(self, row: dict, query: Query, n: int, total: int):
        self.n = len(row["doc_ids"])
        length, tf = np.frombuffer(row["lengths"], np.int64), np.frombuffer(row["tfs"], "<i4").astype(np.int64)
        terms = np.frombuffer(row["terms"], "<i4")
        self.docs = np.frombuffer(row["docs"], "<i4").astype(np.int64)
        self.edges = np.r_[0, np.cumsum(np.frombuffer(row["sizes"], "<i4").astype(np.int64))]
        if 90 * n * int(length.max(initial=0)) < 1 << 63:
            norm = 10 + (90 * n * length) // max(total, 1)
        else:  # Python's own integers where 64 bits don't hold the product
            norm = np.array([10 + 90 * n * x // total for x in length.tolist()], np.int64)
        of = np.repeat(np.arange(len(terms)), np.diff(self.edges))
        self.scores = query.weight[terms[of]] * ((1_000_000_000 * tf) // (1000 * tf + 8 * norm[self.docs]))
        self.blocks = -(-self.n // BLOCK)
        self.block_bounds = np.zeros((len(terms), self.blocks), np.int64)
        if len(of):
            cell = of * self.blocks + self.docs // BLOCK
            first = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
            self.block_bounds.ravel()[cell[first]] = np.maximum.reduceat(self.scores, first)
        self.bounds = self.block_bounds.max(axis=1, initial=0)
        # Where each pair of item and term has its list here, or -1.
        at = np.full(len(query.terms), -1)
        at[terms] = np.arange(len(terms))
        self.of_pair = at[query.term]

    def item_bounds(self, query: Query) -> np.ndarray:
        """What a document here can score at most for each item."""
        each = np.where(self.of_pair >= 0, self.bounds[np.maximum(self.of_pair, 0)], 0) if len(self.bounds) else 0 * self.of_pair
        sums = np.r_[0, np.cumsum(each)]
        return sums[query.bounds[1:]] - sums[query.bounds[:-1]]

    def lists(self, query: Query, item: int, short: bool) -> np.ndarray:
        a, b, cut = query.bounds[item], query.bounds[item + 1], query.bounds[item] + query.short[item]
        pairs = self.of_pair[a:cut] if short else self.of_pair[cut:b]
        return pairs[pairs >= 0]

    def accumulate(self, lists: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents of some lists and their sums, a term at a time."""
        sums = np.zeros(self.n, np.int64)
        for k in lists.tolist():
            s = slice(self.edges[k], self.edges[k + 1])
            sums[self.docs[s]] += self.scores[s]
        docs = np.flatnonzero(sums)
        return docs, sums[docs]

    def best(self, query: Query, item: int, most: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """The documents that may be among the ``most`` best: all that score as much as the last of them, and ``least`` or more."""
        docs, sums = self.accumulate(self.lists(query, item, short=True))
        bound = np.zeros(self.blocks, np.int64)
        if len(docs):
            np.maximum.at(bound, docs // BLOCK, sums)
        # The accumulators are one more list; long ones go by their bounds, the highest first.
        iterators, limits = [(docs, sums)], [bound]
        long = self.lists(query, item, short=False)
        for k in long[np.argsort(-self.bounds[long], kind="stable")].tolist():
            s = slice(self.edges[k], self.edges[k + 1])
            iterators.append((self.docs[s], self.scores[s]))
            limits.append(self.block_bounds[k])
        left = np.cumsum(np.array(limits)[::-1], axis=0)[::-1]  # bounds of an iterator and those after it, by block
        found_docs, found = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for begin in range(0, self.n, STRIDE):
            end = min(self.n, begin + STRIDE)
            some = slice(begin // BLOCK, -(-end // BLOCK))
            if left[0, some].max(initial=0) < least:
                continue
            scores, alive = np.zeros(end - begin, np.int64), np.repeat(left[0, some] >= least, BLOCK)[: end - begin]
            for k, (d, x) in enumerate(iterators):
                rest = np.repeat(left[k, some], BLOCK)[: end - begin]
                alive &= scores + rest >= least
                if not alive.any():
                    break
                a, b = np.searchsorted(d, [begin, end])
                at = d[a:b] - begin
                keep = alive[at]
                scores[at[keep]] += x[a:b][keep]
            at = np.flatnonzero(alive & (scores >= least))
            found_docs, found = np.r_[found_docs, at + begin], np.r_[found, scores[at]]
            if len(found) >= most:
                least = max(least, int(np.partition(found, -most)[-most]))
                found_docs, found = found_docs[found >= least], found[found >= least]
        return found_docs, found


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for k in range(batch.num_rows):
            row = {name: batch.column(i)[k] for i, name in enumerate(batch.schema.names)}
            yield {name: x.values if name == "doc_ids" else x.as_py() for name, x in row.items()}


def _accumulators(query: Query, n: int, total: int, most: int):
    """The best sums of short lists alone of a task's segments, by item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [np.zeros(0, np.int64)] * len(query.items)
        for row in _rows(batches):
            index = Index(row, query, n, total)
            for k in range(len(query.items)):
                lists = index.lists(query, k, short=True)
                if len(lists):
                    best[k] = np.sort(np.r_[best[k], index.accumulate(lists)[1]])[-most:]
        item = np.repeat(np.arange(len(best)), list(map(len, best)))
        sums = np.concatenate(best) if best else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(item), pa.array(sums)], ["item", "score"])

    return run


def _candidates(query: Query, n: int, total: int, most: int, floor: np.ndarray):
    """The best documents of a task's segments, by item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = np.maximum(floor, 1)
        held: list[list[tuple]] = [[] for _ in query.items]
        for row in _rows(batches):
            index = Index(row, query, n, total)
            for k in np.flatnonzero(index.item_bounds(query) >= least).tolist():
                docs, scores = index.best(query, k, most, int(least[k]))
                ids = row["doc_ids"].take(pa.array(docs)).to_pylist()
                # Highest first, then the smaller id; rows without an id last.
                held[k] += zip((-scores).tolist(), [i is None for i in ids], [i or 0 for i in ids], strict=True)
                if len(held[k]) > most:
                    held[k] = sorted(held[k])[:most]
                    least[k] = max(least[k], -held[k][-1][0])
        out = [(query.items[k], None if none else i, -s) for k, rows in enumerate(held) for s, none, i in rows]
        columns = zip(*out, strict=True) if out else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], ["item_id", "doc_id", "score"])

    return run


def search(docs: DataFrame, items: DataFrame, most: int = 10) -> DataFrame:
    """The ``most`` highest-scoring documents (doc_id, text) for each of ``items`` (item_id, text): item_id, rank, doc_id, score.

    Terms are stretches of digits, letters and characters beyond ASCII, A-Z in lower case, told apart by 64 bits. With N
    documents that have a term, L terms in all, n in a document, df documents with a term and tf occurrences in one: a term
    weighs w = floor(1000 ln((2N+2) / (2df+1))), a document's norm is m = 10 + 90nN div L, its score the sum of
    w * (10^9 tf div (1000 tf + 8m)) over the item's terms, in whole numbers. Only scores above 0 count; equal ones go by
    ascending doc_id, rows without an id last. rank runs from 1.

    The result is exact: blocks are skipped only where no document can reach the score of the last rank. Null and empty texts
    have no terms: such items find nothing, such documents are never found. Rows of one item_id are one item with the terms of
    all of them; rows of documents are told apart, so a repeated row is found twice. Extra columns are ignored. Items are taken
    in passes of about PASS_PAIRS pairs of item and term, chosen by a hash; tasks hold the terms of one pass.
    """
    asked = items.select(F.col("item_id").cast("long").alias("item"), "text")
    pairs = stage(map_arrow(asked, _item_terms, "item long, term long").distinct())
    passes = max(1, math.ceil(pairs.count() / PASS_PAIRS))
    out = None
    for number in range(passes):
        own = pairs.filter(F.pmod(F.xxhash64("item"), F.lit(passes)) == number).collect()
        if own or out is None:
            part = _one_pass(docs, Query([(r.item, r.term) for r in own]), most)
            out = part if out is None else out.unionByName(part)
    return out


def _one_pass(docs: DataFrame, query: Query, most: int) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    segments = stage(map_arrow(rows, _segments(query.terms), _SEGMENT))
    n, total = (x or 0 for x in segments.agg(F.sum("n_docs"), F.sum("n_terms")).first())
    counted = map_arrow(segments.select("terms", "sizes"), _frequencies(len(query.terms)), "term long, df long")
    df = np.zeros(len(query.terms), np.int64)
    for r in counted.groupBy("term").agg(F.sum("df").alias("df")).toLocalIterator():
        df[r.term] = r.df
    query.weigh(df, n)
    # The last rank's score is at least that of the accumulators alone.
    sums = map_arrow(segments, _accumulators(query, n, total, most), "item long, score long")
    nth = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score")))
    floor = np.zeros(len(query.items), np.int64)
    for r in sums.withColumn("nth", nth).filter(F.col("nth") <= most).filter(F.col("nth") == most).collect():
        floor[r.item] = r.score
    found = map_arrow(segments, _candidates(query, n, total, most, floor), "item_id long, doc_id long, score long")
    by = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= most)
    return ranked.select("item_id", "rank", "doc_id", "score")
