"""Registered queries of the operators, each over its whole table, and their check SQL where there is one."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laborlens.llm import (
    bpe, check_sql, chunks, language_model, lexical, lines, minhash, neighbours, packing, periodic, quality, secrets, suffixes,
    token_store,
)
from laborlens.llm.frames import read_table, scratch

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
#: The others have hashes, tokens, trained weights or recall below one in their results, or are too slow in SQL.
ORACLES: dict[str, str] = {
    "op2_line_dedup": check_sql.LINE_DEDUP,
    "op3_secret_scans": check_sql.secret_scans(secrets.ASSIGN, secrets.ACCESS, secrets.HEX, secrets.OPAQUE),
    "op6_quality_rules": check_sql.QUALITY_RULES,
    "op10_minhash": check_sql.MINHASH,
    "op11_lexical_search": check_sql.LEXICAL_SEARCH,
}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays of each document when chunks that stand earlier go, and the documents where they stay."""
    return chunks.deduplicate(read_table(spark, sf_dir, "documents"), whole=True)


@query
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays of each document when later repeated runs of two or more lines go."""
    return lines.report(read_table(spark, sf_dir, "documents"))


@query
def op3_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of each document; its owner is its source."""
    return secrets.report(read_table(spark, sf_dir, "documents"))


@query
def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of each document's ids and of what they decode to."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.round_trip(read_table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


@query
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 1024 tokens along the curve."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack(read_table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


@query
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of each document; its host is its source."""
    judged = quality.judge(read_table(spark, sf_dir, "documents")).drop("h", "n_lines")
    return judged.withColumn("host_rate", F.round("host_rate", 6))


@query
def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest found of every row whose id is divisible by 20, among all rows."""
    return neighbours.search(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query
def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays of each document when each string of 200 bytes that stands more than once goes."""
    return suffixes.remove_repeats(read_table(spark, sf_dir, "documents"), length=200)


@query
def op9_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents; those whose CRC leaves 1 modulo 5 are held out."""
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 1
    return language_model.score(read_table(spark, sf_dir, "documents"), held_out)


@query
def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose sets of three-word shingles have a similarity of 0.85 or more."""
    return minhash.near_duplicates(read_table(spark, sf_dir, "documents"), words=3, similarity=85)


@query
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten highest-scoring documents of each benchmark item, among all documents."""
    return lexical.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of periodic words of each document, a tenth of which are made periodic first."""
    return periodic.report(periodic.make_periodic(read_table(spark, sf_dir, "documents")))


@query
def op13_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, number and checksum of each document's ids, as read from the files that hold those of all documents."""
    path = f"{scratch(spark)}/tokens-{uuid.uuid4().hex}"
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    token_store.write(read_table(spark, sf_dir, "documents"), path, tokenizer, public_tokenizers.PATTERN)
    found = token_store.read_documents(spark, path)
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
