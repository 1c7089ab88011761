"""Reading and writing monthly panels and single tables (parquet)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from laborlens import schema as S
from laborlens.functions import periods as P

MONTH_IN_PATH = r"anno=(\d+)/mes=(\d+)"
MONTH_IN_NAME = r"_(\d{4})(\d{2})\.parquet$"


def scratch_dir(spark: SparkSession) -> str:
    """A new, unused path below ``spark.checkpoint.dir``, or below the warehouse where that is unset.

    Both are folders that the cluster shares.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch"
    return f"{base.rstrip('/')}/laborlens-{uuid.uuid4().hex}"


def open_table(spark: SparkSession, root: str, merge_schema: bool = False, schema=None) -> DataFrame:
    """Parquet directory with ``anno=/mes=`` discovery; optional schema union."""
    reader = spark.read.option("mergeSchema", merge_schema)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(root)


def month_files(spark: SparkSession, root: str) -> DataFrame:
    """Files of a monthly layout with their month, from directory listing alone.

    The month comes from the ``anno=/mes=`` directories or, failing that, from a
    ``name_YYYYMM.parquet`` file name. File contents are not read.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", True)
        .load(root)
        .select("path")
    )

    def part(i: int):
        by_dir = F.regexp_extract("path", MONTH_IN_PATH, i)
        by_name = F.regexp_extract("path", MONTH_IN_NAME, i)
        return F.when(by_dir != "", by_dir).when(by_name != "", by_name).cast("int")

    return (
        files.select("path", part(1).alias("anno"), part(2).alias("mes"))
        .filter(F.col("anno").isNotNull())
        .withColumn("pidx", P.pidx("anno", "mes"))
        .withColumn("fecha", P.month_start("pidx"))
    )


def write_periods(df: DataFrame, root: str, by: tuple[str, ...] = ("anno", "mes")) -> None:
    """Overwrite the months present in ``df``, and only those, in one job.

    The rebalance hint groups a month's rows into files and lets AQE split a
    month that is larger than the advisory partition size, so that a month is
    never the work of one task.
    """
    (
        df.hint("rebalance", *by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(root)
    )


def replace_periods(df: DataFrame, root: str, by: tuple[str, ...] = ("anno", "mes")) -> None:
    """Like :func:`write_periods`, but months that ``df`` lacks go: a stage of one run holds that run's months only."""
    (
        df.hint("rebalance", *by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(*by)
        .parquet(root)
    )


def replace_some(df: DataFrame, root: str, months: set[int], by: tuple[str, ...] = ("anno", "mes")) -> None:
    """Replace exactly ``months`` (indexes) of a table stored by month; those of which ``df`` has no row go, all others stay.

    The months written are counted by the job that writes them.
    """
    index = F.col("pidx") if by == ("pidx",) else P.pidx("anno", "mes")
    found = Observation()
    write_periods(df.observe(found, F.collect_set(index).alias("months")), root, by)
    place = df.sparkSession._jvm.org.apache.hadoop.fs.Path
    for m in sorted(months - set(found.get["months"])):
        folder = f"pidx={m}" if by == ("pidx",) else f"anno={m // 12}/mes={m % 12 + 1}"
        gone = place(f"{root}/{folder}")
        gone.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(gone, True)


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def stage(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The same rows, computed once and kept as a table in the shared scratch folder until the driver ends.

    For results that several readers use, and to cut lineage between stages.
    """
    path = scratch_dir(df.sparkSession)
    place = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).deleteOnExit(place)
    if by:
        df.hint("rebalance", *by).write.partitionBy(*by).parquet(path)
    else:
        df.write.parquet(path)
    return open_table(df.sparkSession, path, schema=df.schema)


def write_sorted(df: DataFrame, path: str, keys: list[str]) -> None:
    """Range-partitioned and sorted: row-group statistics serve key lookups."""
    df.repartitionByRange(*keys).sortWithinPartitions(*keys).write.mode("overwrite").parquet(path)


def write_bucketed(df: DataFrame, table: str, buckets: int, keys: list[str] | None = None) -> None:
    """Catalog table bucketed by job, so that gap and flow windows need no shuffle.

    Rows meet in their bucket before the write, which gives one file per bucket.
    """
    keys = keys or S.JOB
    df.repartition(buckets, *keys).write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys, "pidx").saveAsTable(table)


def keep_first(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key: the first in the order of all the other columns.

    The rank filter is applied before the shuffle too, so copies of one key are
    dropped where they are read.
    """
    rest = [F.col(c).asc_nulls_last() for c in df.columns if c not in keys]
    w = W.partitionBy(*keys).orderBy(*(rest or [F.col(keys[0])]))
    return df.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def eligible(size: str = "tamano", section: str = "seccion"):
    """Firms of more than one person, outside sections T and U (unknown section stays)."""
    in_scope = ~F.col(section).isin(S.EXCLUDED_SECTIONS) | F.col(section).isNull()
    return (F.col(size) != S.SINGLE_PERSON) & in_scope


def read_jobs(
    panel: DataFrame,
    cols: list[str],
    size: str | None = "tamano",
    section: str = "seccion",
    unique_key: bool = False,
) -> DataFrame:
    """Eligible jobs of all months, projected, one row per (worker, firm, month).

    ``unique_key`` skips the de-duplication for panels whose key is unique by
    construction (the output of ``consolidate_jobs`` and what follows it).
    """
    keep = eligible(size, section) if size else (
        ~F.col(section).isin(S.EXCLUDED_SECTIONS) | F.col(section).isNull()
    )
    keys = S.JOB + ["pidx"]
    jobs = P.with_pidx(panel).filter(keep).select(*keys, *[c for c in cols if c not in keys])
    return jobs if unique_key else keep_first(jobs, keys)
