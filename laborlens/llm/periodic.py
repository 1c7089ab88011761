"""Runs of periodic words inside documents, by maximal pairs.

Suffixes of a document that start alike are the leaves of an LCP-interval tree, which is walked bottom-up. A node of depth L
holds the places where one string of L words stands, each under the class of the word on its left. Two places from different
children whose classes differ are a maximal pair: the string can be extended to neither side at both. If they lie at most L
words apart, what they cover together is a stretch with their distance as period that no neighbour extends, so such pairs are
the runs, and nothing is extended afterwards. Of the pairs that cover one stretch the closest has its smallest period.

A node's lists are kept in order of place, the shorter one going into the longer. Only neighbours in that order are compared:
between the two places of a smallest period no third of the same node can lie, as it would make the period smaller.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laborlens.llm import bytesops as B
from laborlens.llm.frames import map_arrow


def _same(values: np.ndarray) -> np.ndarray:
    """Dense ranks."""
    return np.unique(values, return_inverse=True)[1].astype(np.int64)


def suffix_order(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of ``symbols`` in order, and the length of the prefix that each shares with the one before.

    By doubling: suffixes ranked by 2k symbols are ranked by their first k and by the k that follow. The ranks by 1, 2, 4, ...
    symbols then give the common prefixes from long to short.
    """
    n = len(symbols)
    ranks, span = [_same(symbols)], 1
    while ranks[-1].max(initial=0) + 1 < n:
        following = np.zeros(n, np.int64)
        following[: n - span] = ranks[-1][span:] + 1
        ranks.append(_same(ranks[-1] * (n + 1) + following))
        span *= 2
    order = np.argsort(ranks[-1], kind="stable")
    shared = np.zeros(n, np.int64)
    a, b = order[:-1].copy(), order[1:].copy()
    for k in range(len(ranks) - 1, -1, -1):
        inside = np.maximum(a, b) + (1 << k) <= n
        at = np.flatnonzero(inside)
        at = at[ranks[k][a[at]] == ranks[k][b[at]]]
        shared[1:][at] += 1 << k
        a[at] += 1 << k
        b[at] += 1 << k
        # What has reached the end shares no more.
        np.minimum(a, n - 1, out=a)
        np.minimum(b, n - 1, out=b)
    return order, shared


def maximal_pairs(order: list[int], shared: list[int], left: list[int], least: int) -> list[tuple[int, int, int]]:
    """(place, distance, shared length) of maximal pairs that lie no farther apart than they agree.

    ``order`` and ``shared`` are neighbouring suffixes and their common prefixes, ``left`` the class of the word before each
    place. Pairs that cover fewer than ``least`` places are left out.
    """
    found = []

    def unite(one: list[int], other: list[int], depth: int) -> list[int]:
        """Leaves of two children of a node, and the pairs between them."""
        if len(one) < len(other):
            one, other = other, one
        size = len(one)
        for p in other:
            k = bisect_left(one, p)
            if k < size:
                d = one[k] - p
                if d <= depth and d + depth >= least and left[p] != left[one[k]]:
                    found.append((p, d, depth))
            if k:
                d = p - one[k - 1]
                if d <= depth and d + depth >= least and left[p] != left[one[k - 1]]:
                    found.append((one[k - 1], d, depth))
        for p in other:
            insort(one, p)
        return one

    depths: list[int] = []
    leaves: list[list[int]] = []
    done = [order[0]]
    for place, depth in zip([*order[1:], None], [*shared[1:], -1], strict=True):
        while depths and depths[-1] > depth:
            done = unite(leaves.pop(), done, depths.pop())
        if depths and depths[-1] == depth:
            leaves[-1] = unite(leaves[-1], done, depth)
        else:
            depths.append(depth)
            leaves.append(done)
        done = [place]
    return found


def runs_of(word: np.ndarray, owner: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and smallest period of every run, by start and period; none crosses from one owner to the next.

    ``word`` holds a number for each word, ``owner`` the document of each, ascending.
    """
    none = np.zeros(0, np.int64)
    # The second copy of a run's first period agrees with the first over half of the least length or more.
    half = (least + 1) // 2
    own = B.mix(word + B.mix(owner.astype(np.uint64) + np.uint64(1)))
    n = len(own) - half + 1
    if n <= 0:
        return none, none, none
    window = np.zeros(n, np.uint64)
    for k in range(half):
        window = B.mix(window + own[k : k + n])
    _, which, times = np.unique(window, return_inverse=True, return_counts=True)
    again = np.flatnonzero((times > 1)[which] & (owner[:n] == owner[half - 1 :]))
    if not len(again):
        return none, none, none
    # Words of windows that stand twice in a document, each stretch of them followed by a symbol of its own.
    covered = np.zeros(len(own) + 1, np.int64)
    np.add.at(covered, again, 1)
    np.add.at(covered, again + half, -1)
    at = np.flatnonzero(np.cumsum(covered)[:-1] > 0)
    breaks = np.r_[np.flatnonzero((np.diff(at) > 1) | (owner[at[1:]] != owner[at[:-1]])), len(at) - 1]
    ids = _same(own[at])
    symbols = np.insert(ids, breaks + 1, len(ids) + np.arange(len(breaks)))
    where = np.insert(at, breaks + 1, -1)
    order, shared = suffix_order(symbols)
    before = np.where(where > 0, where - 1, 0)
    opens = (where <= 0) | (owner[before] != owner[where])
    left = np.where(opens, -1 - np.arange(len(where)), _same(own)[before]).tolist()
    # Trees of suffixes that agree over half the length.
    deep = shared >= half
    edges = np.flatnonzero(np.diff(np.r_[False, deep, False].astype(np.int8)))
    found = []
    for first, last in zip(edges[0::2].tolist(), edges[1::2].tolist(), strict=True):
        found += maximal_pairs(order[first - 1 : last].tolist(), shared[first - 1 : last].tolist(), left, least)
    if not found:
        return none, none, none
    place, period, agree = np.array(found).T
    start = where[place]
    end = start + period + agree
    by = np.lexsort((period, end, start))
    start, end, period = start[by], end[by], period[by]
    smallest = np.r_[True, (start[1:] != start[:-1]) | (end[1:] != end[:-1])]
    start, end, period = start[smallest], end[smallest], period[smallest]
    by = np.lexsort((period, start))
    return start[by], end[by], period[by]


def _documents(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for docs in B.documents(batches):
            data = docs.joined()
            first, last = B.word_spans(data)
            owner = np.searchsorted(docs.starts, first, side="right") - 1
            start, end, period = runs_of(B.Prefix(data).spans(first, last), owner, least)
            # Words after the first period of a run go; each that stays takes along one separator.
            gone = np.zeros(len(first) + 1, np.int64)
            np.add.at(gone, start + period, 1)
            np.add.at(gone, end, -1)
            stays = np.cumsum(gone)[:-1] == 0
            out = data.copy()
            out[last] = 0x20
            take = np.zeros(len(data) + 1, np.int64)
            take[first[stays]] += 1
            take[last[stays] + 1] -= 1
            kept = np.cumsum(take)[:-1] > 0
            size = np.bincount(owner[stays], weights=(last - first + 1)[stays], minlength=len(docs)).astype(np.int64)
            offsets = np.r_[0, np.cumsum(size)]
            text = out[kept].tobytes()
            texts = [text[a : max(a, b - 1)].decode() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            begin = np.searchsorted(owner, np.arange(len(docs) + 1))
            rows = np.searchsorted(owner[start] if len(start) else start, np.arange(len(docs) + 1)).astype(np.int32)
            base = begin[owner[start]] if len(start) else start
            numbers = pa.StructArray.from_arrays(
                [pa.array(x.astype(np.int64)) for x in (start - base, end - start, period)], ["start", "length", "period"]
            )
            lists = pa.ListArray.from_arrays(pa.array(rows), numbers)
            yield pa.RecordBatch.from_arrays(
                [docs.rows.column(0), pa.array(np.diff(begin).astype(np.int64)), lists, pa.array(texts, pa.string())],
                ["doc_id", "n_words", "runs", "collapsed_text"],
            )

    return run


def find_runs(docs: DataFrame, least: int = 12) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, runs and collapsed_text.

    Words are what white space (space, tab to carriage return) separates, compared exactly (by 64 bits of a hash). A run is a
    stretch of ``max(least, 2 * period)`` or more consecutive words with its smallest period, which no neighbouring word
    extends. runs lists start (a word's number, from 0), length and period, by start and period; runs may overlap.
    collapsed_text holds the words that no run contains after its first period, joined by single spaces.

    Null text is empty: no words, no runs, an empty collapsed_text. Each row is handled alone, so rows that repeat an id or a
    text have equal results and an id may be null. A text of any length is one task's work, in memory in proportion to it.
    An empty table gives no rows; extra columns are ignored.
    """
    if least < 2:
        raise ValueError("a run has two words at least")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    runs = "array<struct<start:long,length:long,period:long>>"
    return map_arrow(rows, _documents(least), f"doc_id long, n_words long, runs {runs}, collapsed_text string")


def make_periodic(docs: DataFrame) -> DataFrame:
    """``docs`` with every tenth document, by the CRC of its id, made periodic from some word on: doc_id and text.

    With h the unsigned CRC-32 of the decimal id and g = h div 10, a document of n words with h mod 10 = 0 has from word
    a = g mod n on the words a to a + p - 1 over and over, p = 1 + (n - a) div (3 + g mod 8). Other texts stay; a null id
    counts as an empty string, whose CRC is 0.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            marks = batch.column(2).to_numpy()
            if not (marks % 10 == 0).any():
                yield batch.select(["doc_id", "text"])
                continue
            out = texts.to_pylist()
            for i in np.flatnonzero(marks % 10 == 0).tolist():
                words = (out[i] or "").encode().split()
                if words:
                    n, g = len(words), int(marks[i]) // 10
                    a = g % n
                    p = 1 + (n - a) // (3 + g % 8)
                    times = -(-(n - a) // p)
                    out[i] = b" ".join([*words[:a], *(words[a : a + p] * times)[: n - a]]).decode()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], ["doc_id", "text"])

    doc_id = F.col("doc_id").cast("long")
    crc = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    return map_arrow(docs.select(doc_id.alias("doc_id"), "text", crc.alias("crc")), run, "doc_id long, text string")


def report(docs: DataFrame, least: int = 12) -> DataFrame:
    """doc_id, n_runs, the longest run (ties: smallest start, then period; nulls without a run) and digests of all runs and
    of the collapsed text. Nulls, ties, repeated rows and extra columns as in :func:`find_runs`."""
    found = find_runs(docs, least)
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(line, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    rows = found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.col2")).alias("start"),
        F.col("best.length").alias("length"), (-F.col("best.col3")).alias("period"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed_text", 256).alias("collapsed_sha256"),
    )
    exponent = F.expr("(1000 * length) div period").alias("exponent_milli")
    return rows.select("doc_id", "n_runs", "start", "length", "period", exponent, "runs_sha256", "collapsed_sha256")
