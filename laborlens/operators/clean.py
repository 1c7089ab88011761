"""From raw contributions to one row per worker, firm and month."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laborlens import schema as S
from laborlens.functions import periods as P
from laborlens.functions import scalars as X

JOB_PERIOD = S.JOB + S.PERIOD + ["tipo_trabajador"]


def _job_period(df: DataFrame) -> list[str]:
    """Job-period key; the worker type is part of it unless it has been dropped."""
    return [c for c in JOB_PERIOD if c in df.columns]


def of_type(df: DataFrame, tipo: int = 1) -> DataFrame:
    return df.filter(F.col("tipo_trabajador") == tipo)


def join_dates(df: DataFrame, persons: DataFrame) -> DataFrame:
    """Birth and death dates of each worker; nothing else travels."""
    dates = persons.select(
        F.col("person_id").alias("worker_id"),
        X.date_of(persons, "fecha_nac"),
        X.date_of(persons, "fecha_def_cor_rc"),
    )
    return df.join(dates, "worker_id", "left")


def of_age(df: DataFrame, low: int = 15, high: int = 90, birth="fecha_nac") -> DataFrame:
    """Age in [low, high) years at the month of accrual, or unknown."""
    age = X.months_since(birth, "anno", "mes")
    return df.filter(((age >= low * 12) & (age < high * 12)) | age.isNull())


def alive(df: DataFrame, death="fecha_def_cor_rc") -> DataFrame:
    """Not dead before the month of accrual."""
    return df.filter(F.col(death).isNull() | (X.months_since(death, "anno", "mes") <= 0))


def max_declaration(df: DataFrame) -> DataFrame:
    """Highest declaration type of each job-period, one row per job-period."""
    return df.groupBy(*JOB_PERIOD).agg(F.max("tipo_declaracion").alias("max_tipo_declaracion"))


def distinct_payments(df: DataFrame) -> DataFrame:
    """Drop exact repeats of a payment, whatever its declaration type."""
    keys = _job_period(df) + ["tipo_pago", "monto", "dias", "codigo_mutual"]
    return df.withColumn("tipo_pago", X.payment_type("tipo_pago")).select(*keys).distinct()


def sum_payments(df: DataFrame) -> DataFrame:
    """Pay and days per job-period: leave counts zero, days stop at 30."""
    keys = _job_period(df)
    amounts = df.select(
        *keys,
        X.zero_on_leave("monto", "tipo_pago").cast("double").alias("monto"),
        X.zero_on_leave(F.col("dias").cast("int"), "tipo_pago").alias("dias"),
    )
    return amounts.groupBy(*keys).agg(
        F.sum("monto").alias("monto"),
        X.at_most(F.sum("dias"), 30).cast("int").alias("dias"),
    )


def consolidate_jobs(df: DataFrame) -> DataFrame:
    """One row per (worker, firm, period, worker type).

    Two aggregations, both combined map-side: the first is keyed by the whole
    payment, the second by job-period, so copies of one payment or one job that
    fills a third of the input shrink to a row per task before any shuffle.
    """
    return sum_payments(distinct_payments(df))


def drop_excluded(df: DataFrame, exclusions: DataFrame) -> DataFrame:
    return df.join(exclusions.select(*S.JOB, *S.PERIOD), S.JOB + S.PERIOD, "left_anti")


def preprocess(
    raw: DataFrame,
    persons: DataFrame,
    exclusions: DataFrame,
    desde: tuple[int, int] = S.START_PERIOD,
    low: int = 15,
    high: int = 90,
    tipo: int = 1,
) -> DataFrame:
    """Clean panel from raw contributions.

    Age and death depend on (worker, period) alone, which is part of the
    consolidation key, so the demographic join runs after the consolidation, on
    one row per job-period instead of every payment row. With a single worker
    type left, the consolidation is keyed like the exclusions and both share a
    shuffle.
    """
    raw = of_type(raw, tipo).filter(P.from_period(desde)).drop("tipo_trabajador")
    jobs = drop_excluded(consolidate_jobs(raw), exclusions)
    kept = alive(of_age(join_dates(jobs, persons), low, high))
    return kept.withColumn("tipo_trabajador", F.lit(tipo)).drop("fecha_nac", "fecha_def_cor_rc")


def cap_pay(df: DataFrame, caps: DataFrame, missing_cap: str = "null") -> DataFrame:
    """Limit pay to the cap of its month. ``caps`` holds one row per month, or the job fails."""
    months = P.one_per_month(caps.select(*S.PERIOD, "tope"), S.PERIOD)
    return df.join(P.by_month(months), S.PERIOD, "left").withColumn(
        "monto", X.capped("monto", "tope", missing_cap)
    ).drop("tope")
