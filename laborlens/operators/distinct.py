"""Exact distinct counts that roll up: bitmaps of ids in place of a distinct per table.

An id is a bit of a bucket. Bits are set in each task, buckets of one cell are united, and any coarser breakdown unites those
of its cells, so ids are read and shuffled once for all breakdowns. A bucket has 32,768 ids and takes four kilobytes, so ids
should be dense, as registry numbers are; for sparse ids, number them first (:func:`dense`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from laborlens.operators.stocks import _name_of
from laborlens.sources.tables import stage

#: Ids of a bucket.
BUCKET = 32_768


def partials(df: DataFrame, keys: list[str], id_col: str, sums: list[str] | None = None) -> DataFrame:
    """Cells (keys, bucket) with the bitmap of their ids and the sums of measures. Null ids are not counted, their sums are.

    Bits are set map-side, so a cell that a third of all rows share moves as a row a task and bucket.
    """
    number = F.col(id_col).cast("long")
    bit = F.when(number.isNotNull(), F.bitmap_bit_position(number))
    grouped = df.groupBy(*keys, F.bitmap_bucket_number(number).alias("_bucket"))
    return grouped.agg(F.bitmap_construct_agg(bit).alias("_ids"), *[F.sum(c).alias(c) for c in sums or []])


def roll_up(
    parts: DataFrame, sets: dict[str, list[str]], always: list[str], classes: list[str], sums: list[str], name: str = "n_distinct"
) -> DataFrame:
    """Distinct ids and sums of every named set of classes: tabla, always, classes, sums and ``name``.

    ``tabla`` comes from the grouping id, so NULL classes stay categories. Grouping sets expand cells of bitmaps, not rows;
    first by bucket, so that no task holds all bitmaps of a breakdown, then over buckets as plain numbers.
    """
    keys = [*always, "_bucket", *classes]
    grouped = parts.groupingSets([[F.col(c) for c in [*always, "_bucket", *cols]] for cols in sets.values()], *[F.col(c) for c in keys])
    united = grouped.agg(
        F.bitmap_or_agg("_ids").alias("_ids"), *[F.sum(c).alias(c) for c in sums], F.grouping_id().alias("_gid")
    )
    named = united.withColumn("tabla", _name_of(sets, keys))
    counted = named.groupBy("tabla", *always, *classes).agg(
        *[F.sum(c).alias(c) for c in sums], F.sum(F.bitmap_count("_ids")).alias(name)
    )
    return counted.select("tabla", *always, *classes, *sums, name)


def count_distinct(df: DataFrame, id_col: str, sets: dict[str, list[str]], always: list[str] | None = None) -> DataFrame:
    """Distinct ids of every breakdown, from one read and one shuffle of ``df``."""
    always = always or []
    classes = sorted({c for cols in sets.values() for c in cols})
    return roll_up(partials(df, [*always, *classes], id_col), sets, always, classes, [])


def dense(df: DataFrame, id_col: str, by: Column | None = None) -> DataFrame:
    """Ids numbered from 1 without gaps within ranges: id and ``numero``, for ids too sparse for bitmaps.

    Distinct ids are ranged over tasks and numbered inside each; a task's numbers begin at a multiple of the bucket size after
    those of the tasks before, of which there is one row each.
    """
    ids = df.select(id_col).filter(F.col(id_col).isNotNull()).distinct()
    placed = ids.repartitionByRange(by if by is not None else F.col(id_col)).withColumn("_task", F.spark_partition_id())
    placed = stage(placed)  # ranges come from a sample: drawn once
    sizes = placed.groupBy("_task").agg(F.count("*").alias("_n"))
    buckets = F.ceil(F.col("_n") / BUCKET) * BUCKET
    before = F.sum(buckets).over(W.orderBy("_task").rowsBetween(W.unboundedPreceding, -1))
    starts = sizes.select("_task", F.coalesce(before, F.lit(0)).alias("_start"))
    own = F.row_number().over(W.partitionBy("_task").orderBy(id_col))
    return placed.withColumn("_own", own).join(starts, "_task").select(id_col, (F.col("_start") + F.col("_own")).cast("long").alias("numero"))
