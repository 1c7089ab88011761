"""Bundles: named tables, one directory per name."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from laborlens.sources import tables as T


def write_bundle(tables: dict[str, DataFrame], root: str, fmt: str = "parquet") -> None:
    """Write each table under its name, whatever its size. Tables of one source are better written by :func:`write_long`."""
    for name, df in tables.items():
        df.write.mode("overwrite").option("header", True).format(fmt).save(f"{root}/{name}")


def write_long(long: DataFrame, root: str, order: list[str | Column], key: str = "tabla", fmt: str = "parquet") -> None:
    """Write every table of a long table, named by ``key``, in one job, each in the order in which it is published.

    The rows are computed once, then ranged over tasks by name and ``order``, so that a large table is the work of many tasks
    and its files, by name, follow that order as their rows do. Rows without a name are not published. The folder is replaced.
    """
    rows = T.stage(long.filter(F.col(key).isNotNull()))
    placed = rows.repartitionByRange(key, *order).sortWithinPartitions(key, *order)
    write = placed.write.mode("overwrite").option("partitionOverwriteMode", "static").option("header", True)
    write.partitionBy(key).format(fmt).save(root)


def names(spark: SparkSession, root: str, key: str = "tabla") -> list[str]:
    """Names of the tables that :func:`write_long` left below ``root``, in order, from its folders."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    found = files.select(F.regexp_extract("path", f"/{key}=([^/]+)/[^/]*$", 1).alias("name")).filter("name <> ''").distinct()
    return sorted(r.name for r in found.select(F.url_decode(F.replace("name", F.lit("+"), F.lit("%2B"))).alias("name")).collect())


def read_long(
    spark: SparkSession, root: str, wanted: list[str] | None = None, schema=None, key: str = "tabla", fmt: str = "parquet"
) -> DataFrame:
    """The tables below ``root`` as one long table; with ``wanted`` only those names, whose folders alone are read.

    A name that is not there fails at once. Text files have the types of ``schema``, or strings.
    """
    reader = spark.read.option("header", True).format(fmt)
    df = (reader.schema(schema) if schema is not None else reader).load(root)
    df = df.withColumn(key, F.col(key).cast("string"))
    if wanted is None:
        return df
    missing = set(wanted) - set(names(spark, root, key))
    if missing:
        raise ValueError(f"no such tables: {sorted(missing)}")
    return df.filter(F.col(key).isin(list(wanted)))


def as_long(tables: dict[str, DataFrame], key: str = "tabla") -> DataFrame:
    """Named tables as one long table; columns that a table lacks are null."""
    parts = [df.withColumn(key, F.lit(name)) for name, df in tables.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_bundle(
    spark: SparkSession, root: str, names: list[str], fmt: str = "parquet"
) -> dict[str, DataFrame]:
    """Read tables back by name, never by position."""
    return {
        n: spark.read.option("header", True).format(fmt).load(f"{root}/{n}") for n in names
    }


def common_names(a: dict[str, DataFrame], b: dict[str, DataFrame]) -> list[str]:
    return [n for n in a if n in b]


def split(long: DataFrame, names: list[str], key: str = "tabla") -> dict[str, DataFrame]:
    """Named tables of a long table (one filter each, pruned when partitioned by ``key``)."""
    return {n: long.filter(long[key] == n).drop(key) for n in names}
