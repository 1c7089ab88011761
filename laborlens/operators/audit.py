"""Audit of imputed attributes against the registries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laborlens import schema as S
from laborlens.functions import periods as P
from laborlens.functions import scalars as X


def registry_attributes(
    demographic: DataFrame, geographic: DataFrame, registry25: DataFrame
) -> DataFrame:
    """Nationality and region of each person in each registry extract."""
    demo = demographic.select(
        F.col("person_id").alias("worker_id"),
        X.nationality_2024("nacionalidad").alias("nacionalidad_rep_2024"),
    )
    geo = geographic.select(
        F.col("person_id").alias("worker_id"), F.col("codigo_region").alias("region_rep_2024")
    )
    late = registry25.select(
        F.col("person_id").alias("worker_id"),
        X.nationality_2025("nacionalidad_rc").alias("nacionalidad_rep_2025"),
        F.col("codigo_region_rc").alias("region_rep_2025"),
    )
    return demo.join(geo, "worker_id", "full").join(late, "worker_id", "full")


def compare_attributes(panel: DataFrame, registries: DataFrame, anno: int, mes: int) -> DataFrame:
    """Distinct workers' final attributes in one month next to the registries'."""
    month = (
        panel.filter((F.col("anno") == anno) & (F.col("mes") == mes))
        .select("worker_id", "nacionalidad_final", "region_final")
        .distinct()
    )
    return month.join(registries, "worker_id", "left")


def contingency(df: DataFrame, a: str, b: str) -> DataFrame:
    """Two-way counts; unknown is a level of its own."""
    return df.groupBy(a, b).agg(F.count("*").alias("n"))


# The four published cross tables.
CROSS_TABLES = [
    ("region_rep_2024", "region_rep_2025"),
    ("region_rep_2024", "region_final"),
    ("nacionalidad_rep_2024", "nacionalidad_rep_2025"),
    ("nacionalidad_rep_2024", "nacionalidad_final"),
]


def cross_tables(compared: DataFrame) -> DataFrame:
    """All four cross tables from one pass over the compared workers.

    The pairs are the grouping sets of one aggregation; ``tabla`` names each.
    """
    attrs = list(dict.fromkeys(c for pair in CROSS_TABLES for c in pair))
    cells = compared.groupBy(*attrs).agg(F.count("*").alias("n"))
    rows = [
        F.struct(
            F.lit(f"{a} x {b}").alias("tabla"),
            F.col(a).cast("string").alias("a"),
            F.col(b).cast("string").alias("b"),
            F.col("n").alias("n"),
        )
        for a, b in CROSS_TABLES
    ]
    long = cells.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    return long.groupBy("tabla", "a", "b").agg(F.sum("n").alias("n"))


def with_registry(panel: DataFrame, registries: DataFrame) -> DataFrame:
    """Distinct job-months with the first registry's attributes."""
    jobs = P.with_pidx(panel).select(*S.JOB, "pidx").distinct()
    attrs = registries.select("worker_id", "nacionalidad_rep_2024", "region_rep_2024")
    return jobs.join(attrs, "worker_id", "left")


def missing(df: DataFrame, attribute: str) -> DataFrame:
    return df.filter(F.col(attribute).isNull())


def missing_jobs_per_month(df: DataFrame, attribute: str) -> DataFrame:
    return missing(df, attribute).groupBy("pidx").agg(F.countDistinct(*S.JOB).alias("pt"))


def missing_months_per_job(df: DataFrame, attribute: str, anno: int | None = None) -> DataFrame:
    rows = missing(df, attribute)
    if anno is not None:
        rows = rows.filter(P.anno_of("pidx") == anno)
    return rows.groupBy(*S.JOB).agg(F.countDistinct("pidx").alias("tt"))


def imputation_audit(panel: DataFrame, registries: DataFrame, attribute: str) -> dict[str, DataFrame]:
    """Missing before and after imputation, per month and per job.

    ``attribute`` is 'nacionalidad' or 'region'.
    """
    before = with_registry(panel, registries)
    source, final = f"{attribute}_rep_2024", f"{attribute}_final"
    after = P.with_pidx(panel).select(*S.JOB, "pidx", final)
    return {
        "before_per_month": missing_jobs_per_month(before, source),
        "before_per_job": missing_months_per_job(before, source),
        "after_per_month": missing_jobs_per_month(after, final),
    }
