"""Quality rules by document and by host.

Each document gets counts and a list of failed rules. Failures are then summed by host, the failure rate of each host is
shrunk towards the rate of all hosts with a beta prior fitted to the hosts themselves, and the host's verdict is joined
back: on a host that fails, documents are held to the strict limits, elsewhere to the loose ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laborlens.llm import bytesops as B
from laborlens.llm.frames import checkpoint, map_arrow, row_hash, same

SYMBOLS = b"#*$%&|<>"

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]


@dataclass(frozen=True)
class Limits:
    """Limits of the rules; the strict ones hold on hosts that fail."""

    symbols_per_word: float = 0.3
    dup_line_share: float = 0.5
    chars_per_word: tuple[float, float] = (2.0, 15.0)
    strict_symbols_per_word: float = 0.1
    strict_dup_line_share: float = 0.3
    strict_chars_per_word: tuple[float, float] = (3.0, 10.0)
    #: A host fails when its shrunk failure rate is above this.
    host_rate: float = 0.5


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS)] = True
    for docs in B.documents(batches):
        data, n = docs.joined(), len(docs)
        start, end = B.word_spans(data)
        owner = np.searchsorted(docs.starts, start, side="right") - 1
        prefix = B.Prefix(data)
        words = prefix.spans(start, end)

        repeated = np.zeros(len(words), bool)
        if len(words) > 2:
            whole = owner[:-2] == owner[2:]
            key = words[:-2] + B.mix(words[1:-1] + np.uint64(1)) + B.mix(words[2:] + np.uint64(2))
            key = B.mix(key + B.mix(owner[:-2].astype(np.uint64) + np.uint64(77)))[whole]
            at = np.flatnonzero(whole)
            order = np.argsort(key)
            equal = key[order][1:] == key[order][:-1]
            hit = np.zeros(len(key), bool)
            hit[order[1:]] |= equal
            hit[order[:-1]] |= equal
            for k in range(3):
                repeated[at[hit] + k] = True

        # Lines: split at \n and at the ends of documents; those without a word don't count.
        cut = np.flatnonzero(data == 0x0A)
        ends = np.sort(np.concatenate([cut, docs.ends]))
        begins = np.empty_like(ends)
        begins[0] = 0
        begins[1:] = ends[:-1] + 1
        line_owner = np.searchsorted(docs.starts, begins, side="right") - 1
        filled = np.searchsorted(start, ends) > np.searchsorted(start, begins)
        begins, ends, line_owner = begins[filled], ends[filled], line_owner[filled]
        line = B.mix(prefix.spans(begins, ends) + B.mix(line_owner.astype(np.uint64) + np.uint64(5)))
        again = np.ones(len(line), bool)
        again[np.unique(line, return_index=True)[1]] = False

        chars = ~B.IS_SPACE[data] & ((data & 0xC0) != 0x80)
        counts = {
            "n_words": np.bincount(owner, minlength=n).astype(np.int64),
            "word_chars": B.count_by_document(chars, docs),
            "n_symbols": B.count_by_document(symbol[data], docs),
            "n_dup_lines": B.per_document(again, line_owner, n),
            "n_repeat_words": B.per_document(repeated, owner, n),
            "n_lines": np.bincount(line_owner, minlength=n).astype(np.int64),
        }
        yield pa.RecordBatch.from_arrays(
            [docs.rows.column(i) for i in range(3)] + [pa.array(counts[c]) for c in COUNTS],
            names=["doc_id", "host", "h", *COUNTS],
        )


def document_counts(docs: DataFrame, host: str = "source") -> DataFrame:
    """doc_id, host, h (row hash) and the counts of each document; null text has no words.

    Words are runs without ASCII white space; ``n_lines`` counts lines with a word.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col(host).cast("string").alias("host"), row_hash().alias("h"), "text"
    )
    return map_arrow(rows, _count, "doc_id long, host string, h long, " + ", ".join(f"{c} long" for c in COUNTS))


def _broken(symbols: float, dup: float, chars: tuple[float, float]) -> Column:
    n = F.greatest(F.col("n_words"), F.lit(1))
    return (
        (F.col("n_symbols") > symbols * n)
        | (F.col("n_dup_lines") > dup * F.greatest(F.col("n_lines"), F.lit(1)))
        | (F.col("word_chars") < chars[0] * n)
        | (F.col("word_chars") > chars[1] * n)
    )


def host_rates(counts: DataFrame) -> DataFrame:
    """host, n_docs, n_failed, rate: the failure rate under an empirical beta prior.

    The prior's mean and strength are those that match mean and spread of the hosts' own rates. ``counts`` needs
    ``host`` and ``failed``.
    """
    hosts = counts.groupBy("host").agg(F.count("*").alias("n_docs"), F.sum(F.col("failed").cast("long")).alias("n_failed"))
    hosts = checkpoint(hosts)  # read twice; and joined from a checkpoint, a large host can be split
    p = F.col("n_failed") / F.col("n_docs")
    # One row, whatever the number of hosts.
    m = hosts.agg(
        F.count("*").alias("k"), F.avg(p).alias("mean"), F.var_pop(p).alias("spread"), F.avg(1 / F.col("n_docs")).alias("inverse")
    ).first()
    mean = min(max(m["mean"] or 0.0, 1e-4), 1 - 1e-4)
    noise = mean * (1 - mean) * (m["inverse"] or 0.0)
    between = max((m["spread"] or 0.0) - noise, mean * (1 - mean) / 1e4)
    strength = min(max(mean * (1 - mean) / between - 1, 2.0), 1e4)
    rate = (F.col("n_failed") + mean * strength) / (F.col("n_docs") + strength)
    return hosts.withColumn("rate", rate)


def judge(docs: DataFrame, host: str = "source", limits: Limits = Limits()) -> DataFrame:
    """One row per row of ``docs``: doc_id, h, the counts, base_failed, host_rate, host_failed and kept.

    ``base_failed``: fewer than 50 words, or more than half of them in repeated three-word windows. Such documents and
    those that break a loose limit count as failures of their host. On hosts whose shrunk rate is above
    ``limits.host_rate``, documents that break a strict limit go too. Null text is empty and fails; rows without a host
    form a host of their own; ties need no rule; repeated rows each get the same verdict; extra columns are ignored.
    """
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    loose = _broken(limits.symbols_per_word, limits.dup_line_share, limits.chars_per_word)
    strict = _broken(limits.strict_symbols_per_word, limits.strict_dup_line_share, limits.strict_chars_per_word)
    counts = document_counts(docs, host).withColumns({"base_failed": base, "failed": base | loose, "strict": strict})
    counts = checkpoint(counts)  # counts of numbers only, read by both sides of the join
    rates = host_rates(counts).withColumnRenamed("host", "its_host")
    joined = counts.join(rates, same(F.col("host"), F.col("its_host")))
    host_failed = F.col("rate") > limits.host_rate
    return joined.select(
        "doc_id", "h", *COUNTS, "base_failed", F.col("rate").alias("host_rate"), host_failed.alias("host_failed"),
        (~F.col("failed") & ~(host_failed & F.col("strict"))).alias("kept"),
    )


def keep_good(docs: DataFrame, host: str = "source", limits: Limits = Limits()) -> DataFrame:
    """The rows of ``docs`` that :func:`judge` keeps, with their columns as they are."""
    good = judge(docs, host, limits).filter("kept").select(F.col("doc_id").alias("_id"), F.col("h").alias("_h")).distinct()
    keyed = docs.withColumn("_row", row_hash())
    return keyed.join(good, same(F.col("doc_id"), F.col("_id")) & (F.col("_row") == F.col("_h")), "left_semi").drop("_row")
