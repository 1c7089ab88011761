"""Nearest neighbours by multiprobe p-stable hashing.

Vectors are hashed by Gaussian projections cut into cells; a bucket is one cell of each projection of a table. A query
visits buckets in the order of their estimated success, the chance that a neighbour at the expected distance lies there,
until the chances add up to the target; if it met too few candidates, it is compared with all. Candidates of all tables
are ranked by the exact measure.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from laborlens.llm.frames import checkpoint, map_arrow


@dataclass(frozen=True)
class Probing:
    """Parameters of the index.

    ``target``: chance of a neighbour to be visited in each table. ``sample``: vectors that the expected similarity of
    the last neighbour wanted is fitted on; nothing else is sampled. ``bucket_rows`` sets the number of projections.
    """

    tables: int = 2
    target: float = 0.82
    width: float = 2.0
    bucket_rows: int = 400
    block_rows: int = 4096
    sample: int = 2048
    seed: int = 11


@dataclass(frozen=True)
class _Index:
    probing: Probing
    projections: int
    similarity: float
    largest: float
    dimension: int

    def tables(self) -> list[tuple[np.ndarray, np.ndarray]]:
        rng = np.random.RandomState(self.probing.seed)
        return [
            (rng.randn(self.dimension + 1, self.projections), rng.rand(self.projections) * self.probing.width)
            for _ in range(self.probing.tables)
        ]

    def lifted(self, x: np.ndarray, query: bool) -> np.ndarray:
        """Unit vectors with one more component, on which the order by angle is that by inner product."""
        if query:
            unit = x / np.linalg.norm(x, axis=1, keepdims=True)
            return np.hstack([unit, np.zeros((len(x), 1))])
        x = x / self.largest
        return np.hstack([x, np.sqrt(np.maximum(0, 1 - (x**2).sum(1, keepdims=True)))])

    @staticmethod
    def code(table: int, cells: np.ndarray) -> np.ndarray:
        """One number for the cells (rows) of a table."""
        out = np.full(len(cells), table + 1, np.uint64)
        for c in cells.T:
            out = out * np.uint64(0x9E3779B97F4A7C15) + (c + 1000).astype(np.uint64)
        return (out ^ (out >> np.uint64(29))).view(np.int64)

    def buckets(self, x: np.ndarray) -> list[np.ndarray]:
        lifted = self.lifted(x, query=False)
        width = self.probing.width
        return [self.code(t, np.floor((lifted @ a + b) / width).astype(np.int64)) for t, (a, b) in enumerate(self.tables())]

    def probes(self, x: np.ndarray) -> list[list[np.ndarray]]:
        """For each table and query, codes of the buckets to visit, best first."""
        lifted = self.lifted(x, query=True)
        out = []
        for t, (a, b) in enumerate(self.tables()):
            at = lifted @ a
            out.append([self.code(t, self._visit(row, b)) for row in at])
        return out

    def _visit(self, at: np.ndarray, shift: np.ndarray) -> np.ndarray:
        """Cells in falling order of success until the target is reached.

        A neighbour at similarity s to a query projected to f is projected to about s * f with variance 1 - s**2.
        """
        s, width = self.similarity, self.probing.width
        spread = math.sqrt(max(1 - s * s, 1e-6))
        choices = []
        for f, b in zip(at.tolist(), shift.tolist(), strict=True):
            mean = s * f
            first = math.floor((mean - 4 * spread + b) / width)
            last = math.floor((mean + 4 * spread + b) / width)
            edge = [_normal((c * width - b - mean) / spread) for c in range(first, last + 2)]
            choices.append(sorted(((edge[i + 1] - edge[i], first + i) for i in range(last - first + 1)), reverse=True))
        start = (0,) * len(choices)
        heap, seen, cells, mass = [(-math.prod(c[0][0] for c in choices), start)], {start}, [], 0.0
        while heap and mass < self.probing.target:
            p, index = heapq.heappop(heap)
            mass -= p
            cells.append([c[i][1] for c, i in zip(choices, index, strict=True)])
            for m, i in enumerate(index):
                if i + 1 < len(choices[m]):
                    later = (*index[:m], i + 1, *index[m + 1 :])
                    if later not in seen:
                        seen.add(later)
                        heapq.heappush(heap, (-math.prod(c[k][0] for c, k in zip(choices, later, strict=True)), later))
        return np.array(cells, np.int64).reshape(len(cells), len(choices))


def _normal(z: float) -> float:
    return 0.5 * (1 + math.erf(z / math.sqrt(2)))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _usable(vector: Column) -> Column:
    """Not null, not zero, all components finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def _fit(classes: DataFrame, probing: Probing, k: int) -> _Index | None:
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    total = classes.agg(F.count("*").alias("n"), F.max(norm).alias("largest"), F.max(F.size("v")).alias("d")).first()
    if not total["n"]:
        return None
    # A bounded sample, always the same one: the lowest hashes.
    some = [r["v"] for r in classes.select("v").orderBy(F.xxhash64("v")).limit(probing.sample).collect()]
    x = np.array(some)
    blank = _Index(probing, 1, 0.0, total["largest"], total["d"])
    sims = blank.lifted(x[:256], query=True) @ blank.lifted(x, query=False).T
    np.fill_diagonal(sims, -2)
    rank = max(1, round(k * len(x) / total["n"]))
    expected = np.sort(sims, axis=1)[:, -min(rank, sims.shape[1])]
    similarity = float(np.clip(np.percentile(expected, 25), 0.0, 0.999))
    projections = max(1, round(math.log(max(1, total["n"] / probing.bucket_rows), 3)))
    return _Index(probing, projections, similarity, total["largest"], total["d"])


class _Best:
    """The k best candidates of each query met in a task."""

    def __init__(self, k: int):
        self.k, self.parts, self.rows = k, [], 0

    def add(self, query: np.ndarray, score: np.ndarray, vec: np.ndarray) -> None:
        self.parts.append((query, score, vec))
        self.rows += len(query)
        if self.rows > 300_000:
            self.shrink()

    def shrink(self) -> None:
        query, score, vec = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        order = np.lexsort((vec, -score, query))
        query, score, vec = query[order], score[order], vec[order]
        new = np.ones(len(query), bool)
        new[1:] = (query[1:] != query[:-1]) | (vec[1:] != vec[:-1])
        query, score, vec = query[new], score[new], vec[new]
        first = np.flatnonzero(np.r_[True, query[1:] != query[:-1]])
        rank = np.arange(len(query)) - np.repeat(first, np.diff(np.r_[first, len(query)]))
        keep = rank < self.k
        self.parts, self.rows = [(query[keep], score[keep], vec[keep])], int(keep.sum())

    def batch(self) -> pa.RecordBatch | None:
        if not self.parts:
            return None
        self.shrink()
        arrays = [pa.array(x) for x in self.parts[0]]
        self.parts, self.rows = [], 0
        return pa.RecordBatch.from_arrays(arrays, ["query_id", "score", "vec_id"])


def _rank(queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, members: list[np.ndarray], k: int, best: _Best) -> None:
    """Exact ranking of one block of candidates for some queries."""
    rough = queries @ vectors.T
    n = vectors.shape[0]
    if n > k + 1:
        # The k+1 best classes, as one may be the query alone; near ties are kept for the exact sums.
        bound = np.partition(rough, n - k - 1, axis=1)[:, n - k - 1] - 1e-9 * (1 + np.abs(rough).max(axis=1))
        row, col = np.nonzero(rough >= bound[:, None])
    else:
        row, col = (x.ravel() for x in np.indices(rough.shape))
    # Summed in one fixed order, so that equal vectors have equal scores wherever they stand.
    score = (queries[row] * vectors[col]).sum(axis=1)
    size = np.array([len(m) for m in members])
    ids = np.concatenate(members)
    begin = np.cumsum(size) - size
    count = size[col]
    spread = np.repeat(begin[col] - (np.cumsum(count) - count), count) + np.arange(count.sum())
    query, score, vec = np.repeat(query_ids[row], count), np.repeat(score, count), ids[spread]
    other = query != vec
    best.add(query[other], score[other], vec[other])


def search(vectors: DataFrame, queries: Column, k: int = 20, probing: Probing = Probing()) -> DataFrame:
    """The ``k`` best candidates found for each row that ``queries`` selects: query_id, rank, vec_id, score.

    ``vectors`` has vec_id and embedding; a shorter embedding counts as having zeros at its end. Score is the inner product in
    double precision; ties go to the smaller vec_id; a row is no candidate of its own. Vectors that are null, zero or hold null or non-finite
    components take no part; repeated rows count once; an empty table gives an empty result; extra columns are ignored.
    Equal vectors are one candidate that stands for its k+1 smallest ids, which is all a result can hold of them. Large
    buckets are dealt out in blocks, each of which meets all queries that visit the bucket. A query whose buckets hold
    fewer than ``k`` candidates, or than there are, is compared with all vectors.
    """
    spark = vectors.sparkSession
    double = F.transform("embedding", lambda x: x.cast("double"))
    clean = vectors.filter(_usable(F.col("embedding"))).select(
        F.col("vec_id").cast("long").alias("vec_id"), double.alias("v"), queries.alias("asks")
    ).filter("vec_id is not null")
    shortest, longest = clean.agg(F.min(F.size("v")), F.max(F.size("v"))).first()
    if shortest != longest:
        clean = clean.withColumn("v", F.concat("v", F.array_repeat(F.lit(0.0), longest - F.size("v"))))
    order = Window.partitionBy("v").orderBy("vec_id")
    lowest = clean.withColumn("nth", F.dense_rank().over(order)).filter(F.col("nth") <= k + 1)
    classes = checkpoint(lowest.groupBy("v").agg(F.sort_array(F.collect_set("vec_id")).alias("ids")))
    index = _fit(classes, probing, k)
    schema = "query_id long, rank int, vec_id long, score double"
    if index is None:
        return spark.createDataFrame([], schema)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                codes = index.buckets(_matrix(batch.column(0)))
                for code in codes:
                    yield pa.RecordBatch.from_arrays([pa.array(code), *batch.columns], ["bucket", "v", "ids"])

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 64):  # a query comes out once for each bucket it visits
                part = batch.slice(begin, 64)
                visits = [v for table in index.probes(_matrix(part.column(0))) for v in enumerate(table)]
                take = pa.array(np.repeat([i for i, _ in visits], [len(c) for _, c in visits]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([c for _, c in visits])), *(c.take(take) for c in part.columns)],
                    ["bucket", "v", "ids"],
                )

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(k)
        now, blocks, members, full = None, [], [], None
        for batch in batches:
            bucket = batch.column(0).to_numpy()
            block, kind = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            edge = np.flatnonzero((np.diff(bucket) != 0) | (np.diff(block) != 0) | (np.diff(kind) != 0)) + 1
            for lo, hi in zip(np.r_[0, edge], np.r_[edge, len(bucket)], strict=True):
                if lo == hi:
                    continue
                part = batch.slice(lo, hi - lo)
                if now != (bucket[lo], block[lo]):
                    now, blocks, members, full = (bucket[lo], block[lo]), [], [], None
                matrix = _matrix(part.column(3))
                if kind[lo] == 0:
                    blocks.append(matrix)
                    members.extend(np.array(x, np.int64) for x in part.column(4).to_pylist())
                elif blocks:
                    full = np.concatenate(blocks) if full is None else full
                    ids = part.column(4).flatten().to_numpy()
                    for i in range(0, len(ids), 512):
                        _rank(matrix[i : i + 512], ids[i : i + 512], full, members, k, best)
            if best.rows > 250_000 and (out := best.batch()) is not None:
                yield out
        if (out := best.batch()) is not None:
            yield out

    dtype = "v array<double>, ids array<long>"
    placed = map_arrow(classes.select("v", "ids"), place, f"bucket long, {dtype}")
    asked = clean.filter("asks").select("v", F.array("vec_id").alias("ids")).distinct()
    probed = map_arrow(asked, probe, f"bucket long, {dtype}")
    blocks = placed.groupBy("bucket").agg(F.ceil(F.count("*") / probing.block_rows).cast("int").alias("blocks"))
    place_of = F.pmod(F.xxhash64("v"), F.col("blocks").cast("long")).cast("int")
    dealt = placed.join(blocks, "bucket").select("bucket", place_of.alias("block"), F.lit(0).alias("kind"), "v", "ids")
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    asking = probed.join(blocks, "bucket").select("bucket", every.alias("block"), F.lit(1).alias("kind"), "v", "ids")

    def ranked(dealt: DataFrame, asking: DataFrame) -> DataFrame:
        """query_id and its k best among the candidates of the blocks that it is dealt to."""
        together = dealt.unionByName(asking).repartition("bucket", "block").sortWithinPartitions("bucket", "block", "kind")
        found = map_arrow(together, meet, "query_id long, score double, vec_id long")
        return found.groupBy("query_id").agg(
            F.slice(F.array_sort(F.collect_set(F.struct((-F.col("score")).alias("s"), "vec_id", "score"))), 1, k).alias("top")
        )

    best = checkpoint(ranked(dealt, asking))
    # Queries that met fewer candidates than there are, and than k, meet all classes, in blocks as well.
    total = classes.agg(F.sum(F.size("ids")).alias("ids"), F.count("*").alias("n")).first()
    enough = best.filter(F.size("top") >= min(k, total["ids"] - 1))
    short = checkpoint(asked.join(enough.select("query_id").hint("merge"), F.get("ids", F.lit(0)) == F.col("query_id"), "left_anti"))
    if total["ids"] > 1 and not short.isEmpty():
        blocks = -(-total["n"] // probing.block_rows)
        bucket, place_of = F.lit(0).cast("long").alias("bucket"), F.pmod(F.xxhash64("v"), F.lit(blocks)).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
        dealt = classes.select(bucket, place_of.alias("block"), F.lit(0).alias("kind"), "v", "ids")
        asking = short.select(bucket, every.alias("block"), F.lit(1).alias("kind"), "v", "ids")
        best = enough.unionByName(ranked(dealt, asking))
    return best.select("query_id", F.posexplode("top").alias("pos", "x")).select(
        "query_id", (F.col("pos") + 1).alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score")
    )
