"""Headcount per firm and month, static size, 12-month moving size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from laborlens.functions import periods as P
from laborlens.functions import scalars as X


def headcount(panel: DataFrame, unique_key: bool = False) -> DataFrame:
    """Distinct workers per firm and month.

    With a unique panel key a plain count is the same number and costs one
    shuffle instead of two.
    """
    n = F.count("worker_id") if unique_key else F.countDistinct("worker_id")
    return P.with_pidx(panel).groupBy("firm_id", "pidx").agg(n.alias("n_trabajadores"))


def static_size(heads: DataFrame) -> DataFrame:
    """Mean headcount over the months a firm is seen, and its band."""
    return (
        heads.groupBy("firm_id")
        .agg(F.sum("n_trabajadores").alias("pt"), F.countDistinct("pidx").alias("t"))
        .withColumn("media_pt", F.col("pt") / F.col("t"))
        .withColumn("tamano", X.static_size_band("media_pt"))
    )


def previous_month(heads: DataFrame) -> DataFrame:
    """Month in which the firm was last seen before each month."""
    w = W.partitionBy("firm_id").orderBy("pidx")
    return heads.withColumn("pidx_anterior", F.lag("pidx").over(w))


def segments(heads: DataFrame, max_gap: int = 12) -> DataFrame:
    """Running number of the firm's spells; a gap over ``max_gap`` months starts a new one."""
    w = W.partitionBy("firm_id").orderBy("pidx")
    starts = F.col("pidx_anterior").isNull() | (F.col("pidx") - F.col("pidx_anterior") > max_gap)
    return previous_month(heads).withColumn("grupo", F.sum(F.when(starts, 1).otherwise(0)).over(w))


def moving_size(heads: DataFrame, months: int = 12) -> DataFrame:
    """Mean headcount of the last ``months`` calendar months, and its band.

    A break of more than ``months`` months lies outside the look-back by itself,
    so the frame restarts without a segment column.
    """
    w = W.partitionBy("firm_id").orderBy("pidx").rangeBetween(-(months - 1), 0)
    return heads.select(
        "firm_id",
        "pidx",
        F.col("n_trabajadores").alias("pt"),
        F.avg("n_trabajadores").over(w).alias("media_movil_12m"),
        F.count("pidx").over(w).alias("n_meses_utilizados"),
    ).withColumn("tamano_empresa_movil", X.moving_size_band("media_movil_12m"))


def with_moving_size(panel: DataFrame, moving: DataFrame) -> DataFrame:
    """Panel with the moving size of its firm in its month."""
    sizes = moving.select("firm_id", "pidx", "pt", "media_movil_12m", "tamano_empresa_movil")
    return P.with_pidx(panel).join(sizes, ["firm_id", "pidx"], "left")
