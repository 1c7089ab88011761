"""Five stages from raw documents to packed sequences. Each is written as Parquet and read again as the next one's input.

All stages but the last return the columns of their input, whatever others there are and whatever their names. Null texts are
empty. Rows are told apart by id and text; a null id is an id of its own in all stages but near_dedup, which keeps such rows.
An empty table goes through all stages.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laborlens.llm import lines, minhash, packing, quality, secrets
from laborlens.llm.frames import read_table, scratch


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go: null and empty texts too, as they have too few words; repeated rows are judged alike."""
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeated runs of lines go, with documents of which nothing is left; n_chars is counted anew.

    Earlier means a smaller doc_id (null first), then a hash of the row, then the line; rows that repeat id and text keep the
    same lines.
    """
    out = lines.keep_first(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: five-word shingles, similarity of 0.8 or more.

    It is that of the smallest doc_id, ties by a hash of the row; rows of one id with unlike texts are different documents.
    """
    return minhash.keep_one(docs, words=5, similarity=80)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by marks, overlapping ones by that of the first; n_chars is counted anew, null texts stay null."""
    out = secrets.redact(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 1024 tokens, with their ids; repeated rows are packed one by one."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack(docs, path, public_tokenizers.PATTERN, with_ids=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("secret_scan", secret_scan),
    ("packing", pack),
]

#: The stages' joint result has tokens and Hilbert keys, which SQL doesn't express; it is tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed sequences of ``documents``; intermediate tables lie in the cluster's shared folder."""
    root = f"{scratch(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{name}")
        docs = spark.read.parquet(f"{root}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
