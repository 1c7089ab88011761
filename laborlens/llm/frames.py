"""Helpers shared by the operators: row keys, checkpoints and defaults for absent columns."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_hash(text: str = "text", doc_id: str = "doc_id") -> Column:
    """Tells apart rows that share an id; repeated rows have the same one and get the same result."""
    return F.xxhash64(F.col(doc_id), F.coalesce(F.col(text), F.lit("")))


def scratch(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, which the cluster shares. A session without it (tests, local runs) gets one
    under its warehouse."""
    return spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/_checkpoints"


#: Shuffle files of a query go when it ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def without_leftovers(spark: SparkSession) -> Iterator[None]:
    """What runs inside leaves no shuffle files behind, which would else stay until the driver collects its garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in :func:`scratch`."""
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(scratch(df.sparkSession))
    return df.checkpoint(eager=True)


def split_join(big: DataFrame, small: DataFrame, on, how: str = "inner", cut=checkpoint) -> DataFrame:
    """Join with the result of an aggregation on the same key, so that Spark can split a key that very many rows share.

    It splits a join only where both sides come straight from a shuffle, which an aggregate's result doesn't; from what
    ``cut`` writes, a checkpoint or a table, it does. The hint keeps the driver from building a broadcast for each of many
    small joins.
    """
    return big.join(cut(small).hint("merge"), on, how)


def stage(df: DataFrame) -> DataFrame:
    """Like :func:`checkpoint`, but a compressed table, for many rows; it goes when the driver ends."""
    spark = df.sparkSession
    path = f"{scratch(spark)}/staged-{uuid.uuid4().hex}"
    with without_leftovers(spark):
        df.write.parquet(path)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return spark.read.schema(df.schema).parquet(path)


def same(left: Column, right: Column) -> Column:
    """Equality that also joins null ids."""
    return left.eqNullSafe(right)


def map_arrow(df: DataFrame, function, schema: str) -> DataFrame:
    """``mapInArrow`` whose workers find this package where the driver has it, besides what --py-files gave them."""
    environment = df.sparkSession.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if _ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([p for p in paths if p] + [_ROOT])
    return df.mapInArrow(function, schema)
