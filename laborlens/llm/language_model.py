"""Scoring of texts with a hashed maximum-entropy model.

A token's probability is that of its class in the context, times that of its slot in the class in the same context, times its
share of the slot. Classes have a bounded size, 32 slots: the most frequent tokens have a slot each, dealt to the classes by
rank, so that the classes weigh about the same; all other tokens share slots by their hash, each with its exact smoothed share of
the slot's counts. Both distributions are softmaxes over hashed features of the context: the token before, the two before, and
the one before that alone (a skip); features of the second are hashed together with the class. They start from the exact counts
and are trained by gradient updates in every task, over all training documents; weights are averaged by how often each feature
was seen. The probabilities of all tokens seen in training and of an unseen one in each shared slot add up to one.

The number of hashed rows grows with the root of the number of training tokens (:func:`feature_rows`), and so do the weights that
each task holds; their bound is MOST_FEATURES, about 200 MB. Counts of tokens are exact and grow with the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laborlens.llm import bytesops as B
from laborlens.llm.frames import checkpoint, map_arrow

#: Classes, and slots in each: those of one token, then those that tokens share by hash.
CLASSES = 32
OWN = 16
SHARED = CLASSES - OWN
#: Bounds on the hashed features of each of the three templates.
FEWEST_FEATURES, MOST_FEATURES = 1 << 12, 1 << 18
#: Tokens of a gradient update, the step, and the squared gradient that a row starts with: rows seen seldom move little.
BATCH, STEP, ENERGY = 8192, 0.3, 4.0
#: Rows of weights that travel together, and tokens that a training task has for each hashed row: what tasks send grows with
#: the number of tokens then, and not with that of rows besides.
SLAB, TOKENS_A_ROW = 1024, 64
#: Most frequent tokens whose counts every task holds; the counts of all others are joined.
FREQUENT = 1 << 17
END, BEGIN = np.uint64(0xE17D5EED), np.uint64(0xBE61A5EED)


def token_hashes(docs: B.Docs) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, an end after the words of each document, and the documents' first tokens."""
    data = docs.joined(lower=True)
    start, end = B.word_spans(data)
    owner = np.searchsorted(docs.starts, start, side="right") - 1
    counts = np.bincount(owner, minlength=len(docs))
    first = np.r_[0, np.cumsum(counts + 1)]
    out = np.full(first[-1], END, np.uint64)
    out[np.arange(len(owner)) + owner] = B.Prefix(data).spans(start, end)
    return out, first


@dataclass(frozen=True)
class Model:
    """Leaves of the tokens (a leaf is a slot of a class), exact counts of the most frequent ones, and totals."""

    total: int
    distinct: int
    #: Tokens with a slot of their own, sorted, and their leaves.
    own: np.ndarray
    own_leaf: np.ndarray
    #: Smoothed count of each leaf.
    mass: np.ndarray
    #: Tokens whose counts are held, sorted, and the counts.
    token: np.ndarray
    n: np.ndarray
    #: Hashed rows of each template, a power of two.
    features: int

    @property
    def rows(self) -> int:
        """Rows of weights: for each softmax its templates, and what is always on: one row, or one a class."""
        return 6 * self.features + 1 + CLASSES

    def leaves(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Leaf of each token, and whether the token has it for itself."""
        group = (tokens % np.uint64(CLASSES * SHARED)).astype(np.int64)
        leaf = group // SHARED * CLASSES + OWN + group % SHARED
        at, alone = _find(self.own, tokens)
        leaf[alone] = self.own_leaf[at[alone]]
        return leaf, alone

    def class_rows(self, context: np.ndarray) -> np.ndarray:
        """Rows that are on for the class of each token, a column a template and one that is always on."""
        return self._rows(context, 0, np.zeros(len(context), np.int64))

    def slot_rows(self, context: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """Rows that are on for the slot of each token in its class."""
        salted = B.mix(context ^ B.mix(classes.astype(np.uint64) + np.uint64(77))[:, None])
        return self._rows(salted, 3 * self.features + 1, classes)

    def _rows(self, hashes: np.ndarray, base: int, always: np.ndarray) -> np.ndarray:
        out = np.empty((len(hashes), 4), np.int32)
        out[:, :3] = hashes & np.uint64(self.features - 1)
        out[:, 3] = always
        return out + (base + self.features * np.arange(4)).astype(np.int32)

    def start(self) -> np.ndarray:
        """Weights before training: the logarithms of the counts, so that the model starts as the counts have it."""
        weights = np.zeros((self.rows, CLASSES), np.float32)
        mass = self.mass.reshape(CLASSES, CLASSES)
        weights[3 * self.features] = np.log(mass.sum(axis=1))
        weights[-CLASSES:] = np.log(mass)
        return weights


def feature_rows(total: int) -> int:
    """Hashed rows of a template: the power of two next to eight times the root of the number of training tokens."""
    power = 1 << int(np.rint(np.log2(8 * max(total, 1) ** 0.5)))
    return min(max(power, FEWEST_FEATURES), MOST_FEATURES)


def _find(table: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each token stands in the sorted table, and whether it does."""
    if not len(table):
        return np.zeros(len(tokens), np.int64), np.zeros(len(tokens), bool)
    at = np.minimum(np.searchsorted(table, tokens), len(table) - 1)
    return at, table[at] == tokens


def contexts(tokens: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Hashes of what stands before each token, a column a template."""
    before = np.empty((2, len(tokens)), np.uint64)
    for k in (1, 2):
        before[k - 1, k:] = tokens[:-k] if len(tokens) > k else tokens[:0]
        for i in range(k):
            at = first[:-1] + i
            before[k - 1, at[at < first[1:]]] = BEGIN
    one, two = before
    out = np.empty((len(tokens), 3), np.uint64)
    out[:, 0] = B.mix(one + np.uint64(11))
    out[:, 1] = B.mix(B.mix(one + np.uint64(22)) + two)
    out[:, 2] = B.mix(two + np.uint64(33))
    return out


def _softmax(weights: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums of the weights that are on, less the largest of each token; their exponentials; and the sums of these."""
    z = weights.take(rows[:, 0], axis=0)
    for column in rows.T[1:]:
        z += weights[column[0]] if _constant(column) else weights.take(column, axis=0)
    z -= z.max(axis=1, keepdims=True)
    e = np.exp(z)
    return z, e, e.sum(axis=1, keepdims=True)


def _constant(column: np.ndarray) -> bool:
    return column[0] == column[-1] and bool((column == column[0]).all())


def log_probability(weights: np.ndarray, model: Model, context: np.ndarray, leaf: np.ndarray) -> np.ndarray:
    """Natural logarithm of the probability of a leaf in its context."""
    class_, slot = np.divmod(leaf, CLASSES)
    out = np.zeros(len(leaf))
    for rows, outcome in ((model.class_rows(context), class_), (model.slot_rows(context, class_), slot)):
        z, _, total = _softmax(weights, rows)
        out += z[np.arange(len(leaf)), outcome] - np.log(total[:, 0])
    return out


class _Trainer:
    def __init__(self, weights: np.ndarray):
        self.weights = weights.copy()
        self.energy = np.full(len(weights), ENERGY, np.float32)
        self.seen = np.zeros(len(weights), np.int64)

    def learn(self, rows: np.ndarray, target: np.ndarray) -> None:
        """One update: the gradient of each row that is on, scaled by what its gradients were so far."""
        _, gradient, total = _softmax(self.weights, rows)
        gradient /= total
        gradient[np.arange(len(target)), target] -= 1
        for column in rows.T:
            if _constant(column):
                self._move(column[:1], gradient.sum(axis=0, keepdims=True), len(column))
                continue
            order = np.argsort(column, kind="stable")
            sorted_ = column[order]
            begin = np.flatnonzero(np.r_[True, sorted_[1:] != sorted_[:-1]])
            which, times = sorted_[begin], np.diff(np.r_[begin, len(column)])
            total, once = gradient.take(order[begin], axis=0), times == 1  # most rows are on once in an update
            if not once.all():
                often = order[np.repeat(~once, times)]
                total[~once] = np.add.reduceat(gradient.take(often, axis=0), np.cumsum(times[~once]) - times[~once], axis=0)
            self._move(which, total, times)

    def _move(self, which: np.ndarray, total: np.ndarray, times: np.ndarray | int) -> None:
        self.energy[which] += (total**2).mean(axis=1)
        self.weights[which] -= total * (STEP / np.sqrt(self.energy[which]))[:, None]
        self.seen[which] += times


def _train(weights, shared) -> callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer, model = _Trainer(weights.value), shared.value
        for docs in B.documents(batches):
            tokens, first = token_hashes(docs)
            context, (leaf, _) = contexts(tokens, first), model.leaves(tokens)
            for i in range(0, len(tokens), BATCH):
                on, (class_, slot) = context[i : i + BATCH], np.divmod(leaf[i : i + BATCH], CLASSES)
                trainer.learn(model.class_rows(on), class_)
                trainer.learn(model.slot_rows(on, class_), slot)
        for i in range(0, model.rows, SLAB):
            seen = trainer.seen[i : i + SLAB]
            if seen.any():
                mean = np.where(seen[:, None] > 0, trainer.weights[i : i + SLAB], 0)
                yield _slab(i // SLAB, mean.astype(np.float16), seen)

    return run


def _slab(number: int, mean: np.ndarray, seen: np.ndarray) -> pa.RecordBatch:
    values = [pa.array([number]), pa.array([mean.tobytes()], pa.binary()), pa.array([seen.tobytes()], pa.binary())]
    return pa.RecordBatch.from_arrays(values, ["slab", "mean", "seen"])


def _average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Averages of the slabs of a task, in the order in which they come: sorted, so that a retry gives the same."""

    def finish() -> pa.RecordBatch:
        mean = total / np.maximum(seen, 1)[:, None]
        return _slab(now, mean.astype(np.float32), seen)

    now, total, seen = None, None, None
    for batch in batches:
        for number, m, s in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            s = np.frombuffer(s, np.int64)
            m = np.frombuffer(m, np.float16).reshape(-1, CLASSES).astype(np.float64) * s[:, None]
            if number != now:
                if now is not None:
                    yield finish()
                now, total, seen = number, m, s.copy()
            else:
                total += m
                seen += s
    if now is not None:
        yield finish()


def train(documents: DataFrame, model: Model, rounds: int = 1) -> np.ndarray:
    """Weights of both softmaxes; each round starts from the averages of the round before."""
    context = documents.sparkSession.sparkContext
    weights, known = model.start(), context.broadcast(model)
    texts = documents.select("text").coalesce(max(1, -(-model.total // (TOKENS_A_ROW * model.features))))
    for _ in range(rounds):
        shared = context.broadcast(weights)
        slabs = map_arrow(texts, _train(shared, known), "slab long, mean binary, seen binary")
        slabs = slabs.repartition("slab").sortWithinPartitions("slab", "seen", "mean")
        averaged = map_arrow(slabs, _average, "slab long, mean binary, seen binary").collect()  # model.rows rows in all
        for row in averaged:
            seen = np.frombuffer(row["seen"], np.int64)
            mean = np.frombuffer(row["mean"], np.float32).reshape(-1, CLASSES)
            at, on = row["slab"] * SLAB, seen > 0
            weights[at : at + len(seen)][on] = mean[on]
        shared.destroy()
    known.destroy()
    return weights


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def merged() -> tuple[np.ndarray, np.ndarray]:
        token, n = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(token)
        token = token[order]
        begin = np.flatnonzero(np.r_[True, token[1:] != token[:-1]])
        return token[begin], np.add.reduceat(n[order], begin)

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([B.as_signed(parts[0][0].copy()), pa.array(parts[0][1])], ["token", "n"])

    parts, rows = [], 0
    for docs in B.documents(batches):
        token, n = np.unique(token_hashes(docs)[0], return_counts=True)
        parts.append((token, n))
        rows += len(token)
        if rows > 2_000_000:
            parts = [merged()]
            rows = len(parts[0][0])
            if rows > 1_000_000:
                yield batch()
                parts, rows = [], 0
    if parts:
        parts = [merged()]
        yield batch()


def token_counts(documents: DataFrame) -> DataFrame:
    """token (hash) and n, over all ``documents``."""
    return map_arrow(documents.select("text"), _count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))


def fit_leaves(counts: DataFrame) -> Model:
    """Leaves and totals of ``counts``: token and n."""
    group = F.pmod(F.col("token"), F.lit(CLASSES * SHARED)).alias("g")
    totals = np.zeros((2, CLASSES * SHARED), np.int64)
    for row in counts.groupBy(group).agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect():  # a row a shared slot
        totals[:, row["g"]] = row["n"], row["v"]
    total, distinct = int(totals[0].sum()), int(totals[1].sum())
    # The lowest power of two as a bound on counts that few enough tokens reach.
    power = F.floor(F.log2("n")).cast("int").alias("p")
    levels = {r["p"]: r["k"] for r in counts.groupBy(power).agg(F.count("*").alias("k")).collect()}
    held, bound = 0, 1 << 62
    for p in sorted(levels, reverse=True):
        held += levels[p]
        if held > FREQUENT:
            break
        bound = 1 << p
    top = counts.filter(F.col("n") >= bound).toPandas()  # FREQUENT rows at most
    token, n = top["token"].to_numpy(np.int64).view(np.uint64), top["n"].to_numpy(np.int64)

    ranked = np.lexsort((token, -n))[: CLASSES * OWN]
    rank = np.arange(len(ranked))
    leaf = rank % CLASSES * CLASSES + rank // CLASSES
    group = (token[ranked] % np.uint64(CLASSES * SHARED)).astype(np.int64)
    np.subtract.at(totals[0], group, n[ranked])
    np.subtract.at(totals[1], group, 1)
    mass = np.full((CLASSES, CLASSES), 0.5)  # of a slot that no token has: never met
    mass[:, OWN:] = (totals[0] + 0.5 * (totals[1] + 1)).reshape(CLASSES, SHARED)
    mass = mass.reshape(-1)
    mass[leaf] = n[ranked] + 0.5
    by_hash, order = np.argsort(token[ranked]), np.argsort(token)
    return Model(total, distinct, token[ranked][by_hash], leaf[by_hash], mass, token[order], n[order], feature_rows(total))


def _score(weights, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, k = weights.value, shared.value
        log_base = np.log10(k.total + 0.5 * (k.distinct + 1))
        log_mass, log_count = np.log10(k.mass), np.log10(k.n + 0.5)
        for docs in B.documents(batches):
            tokens, first = token_hashes(docs)
            n_tokens = np.diff(first)
            owner = np.repeat(np.arange(len(docs)), n_tokens)
            context, (leaf, alone) = contexts(tokens, first), k.leaves(tokens)
            model = np.empty(len(tokens))
            for i in range(0, len(tokens), BATCH):
                part = slice(i, i + BATCH)
                model[part] = log_probability(w, k, context[part], leaf[part])
            model /= np.log(10)
            at, held = _find(k.token, tokens)
            count = np.zeros(len(tokens))
            count[held] = log_count[at[held]]
            # Where tokens share a slot, each has its share; what is not held here is added from the table of counts.
            model[~alone] += (count - log_mass[leaf])[~alone]
            n = len(docs)
            # What is not held is looked up in the table of all counts, by document and token.
            rare_owner, rare = owner[~held], tokens[~held]
            order = np.lexsort((rare, rare_owner))
            rare_owner, rare = rare_owner[order], rare[order]
            begin = np.flatnonzero(np.r_[True, (rare[1:] != rare[:-1]) | (rare_owner[1:] != rare_owner[:-1])]) if len(rare) else order
            times = np.diff(np.r_[begin, len(rare)])
            bounds = np.searchsorted(rare_owner[begin], np.arange(n + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    docs.rows.column(0), docs.rows.column(1), pa.array(n_tokens.astype(np.int64)),
                    pa.array(np.bincount(owner[held], minlength=n).astype(np.int64)),
                    pa.array(np.bincount(owner, weights=count - log_base, minlength=n)),
                    pa.array(np.bincount(owner, weights=model, minlength=n)),
                    pa.ListArray.from_arrays(pa.array(bounds), B.as_signed(rare[begin].copy())),
                    pa.ListArray.from_arrays(pa.array(bounds), pa.array(times.astype(np.int32))),
                ],
                ["doc_id", "held_out", "n_tokens", "n_known", "base", "model", "rare", "times"],
            )

    return run


def score(docs: DataFrame, held_out: Column, rounds: int = 1) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of each row of ``docs``.

    The model learns from the rows where ``held_out`` is false. Null text is empty and has its end only; a corpus without
    training rows gives all tokens the same count, none. Repeated rows train and are scored one by one; extra columns
    are ignored. Tokens are told apart by 64-bit hashes.
    """
    context = docs.sparkSession.sparkContext
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), "text")
    training = rows.filter("not held_out")
    counts = checkpoint(token_counts(training))
    held = fit_leaves(counts)
    schema = (
        "doc_id long, held_out boolean, n_tokens long, n_known long, base double, model double, "
        "rare array<long>, times array<int>"
    )
    weights, shared = context.broadcast(train(training, held, rounds)), context.broadcast(held)
    scored = checkpoint(map_arrow(rows, _score(weights, shared), schema))
    numbered = scored.withColumn("row", F.monotonically_increasing_id())  # stable: read from the checkpoint
    rare = numbered.select("row", F.explode(F.arrays_zip("rare", "times")).alias("r")).select(
        "row", F.col("r.rare").alias("token"), F.col("r.times").alias("times")
    )
    looked_up = rare.join(counts, "token", "left")
    log_count = F.log10(F.coalesce("n", F.lit(0)) + 0.5) * F.col("times")
    sums = looked_up.groupBy("row").agg(
        F.sum(log_count).alias("more"), F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("known")
    )
    joined = numbered.drop("rare", "times").join(sums, "row", "left")
    more = F.coalesce("more", F.lit(0.0))
    return joined.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(held.total).cast("long").alias("train_tokens"), (F.col("base") + more).alias("base_score"),
        (F.col("model") + more).alias("score"),
    )
