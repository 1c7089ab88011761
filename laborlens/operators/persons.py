"""Persons table from three registry extracts and a sex donor."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laborlens.functions import scalars as X
from laborlens.functions.periods import yyyymm

FIELDS = ["sexo", "nacionalidad", "fecha_nac", "fecha_def_cor_rc", "codigo_region", "codigo_comuna"]


def consistent_sex(raw: DataFrame) -> DataFrame:
    """Months in which all of a worker's records give the same sex."""
    return (
        raw.groupBy("worker_id", "anno", "mes")
        .agg(F.min("sexo").alias("sexo_final"), F.max("sexo").alias("_max"))
        .filter(F.col("sexo_final") == F.col("_max"))
        .select("worker_id", yyyymm("anno", "mes").alias("periodo"), "sexo_final")
    )


def last_consistent_sex(raw: DataFrame) -> DataFrame:
    """Sex in the last month that is free of contradiction, per worker."""
    return (
        consistent_sex(raw)
        .groupBy("worker_id")
        .agg(F.max("periodo").alias("periodo"), F.max_by("sexo_final", "periodo").alias("sexo_final"))
    )


def registry_2024(demographic: DataFrame, geographic: DataFrame) -> DataFrame:
    """Both tables of the first registry on the person id; either side may lack a person."""
    demo = demographic.select(
        "person_id", "sexo", X.nationality_2024("nacionalidad").alias("nacionalidad"),
        "fecha_nac", "fecha_def_cor_rc",
    )
    geo = geographic.select("person_id", "codigo_region", "codigo_comuna")
    return demo.join(geo, "person_id", "full")


def registry_2025(registry: DataFrame) -> DataFrame:
    """Second registry under the names and nationality codes of the first."""
    return registry.select(
        F.col("person_id"),
        F.col("sexo_rc").alias("sexo"),
        X.nationality_2025("nacionalidad_rc").alias("nacionalidad"),
        F.col("fecha_nac_cor_rc").alias("fecha_nac"),
        "fecha_def_cor_rc",
        F.col("codigo_region_rc").alias("codigo_region"),
        F.col("codigo_comuna_rc").alias("codigo_comuna"),
    )


def only_in_second(second: DataFrame, first: DataFrame) -> DataFrame:
    return second.join(first.select("person_id"), "person_id", "left_anti")


def persons(
    demographic: DataFrame, geographic: DataFrame, registry25: DataFrame, sex_donor: DataFrame
) -> DataFrame:
    """One row per person of any source; the first registry wins over the second.

    The sources are stacked and folded by person: one shuffle in place of the
    two full joins, the anti join and the union it stands for. Rows without an
    id match nothing, and each stays a row of its own.
    """
    record = F.struct(*FIELDS)

    def tagged(df: DataFrame, source: str, **cols) -> DataFrame:
        values = [cols.get(c, F.lit(None)).alias(c) for c in FIELDS]
        typed = df.select("person_id", *values).select(
            "person_id",
            F.col("sexo").cast("int").alias("sexo"),
            F.col("nacionalidad").cast("int").alias("nacionalidad"),
            *[F.col(c).cast("string").alias(c) for c in FIELDS[2:]],
        )
        return typed.select("person_id", F.lit(source).alias("source"), record.alias("rec"))

    demo = tagged(
        demographic, "demo",
        sexo=F.col("sexo"), nacionalidad=X.nationality_2024("nacionalidad"),
        fecha_nac=F.col("fecha_nac"), fecha_def_cor_rc=F.col("fecha_def_cor_rc"),
    )
    geo = tagged(
        geographic, "geo",
        codigo_region=F.col("codigo_region"), codigo_comuna=F.col("codigo_comuna"),
    )
    r25 = registry_2025(registry25)
    late = tagged(r25, "late", **{c: F.col(c) for c in FIELDS})
    donor = tagged(
        sex_donor.withColumnRenamed("worker_id", "person_id"), "donor", sexo=F.col("sexo_final")
    )

    def of(source: str):
        return F.max(F.when(F.col("source") == source, F.col("rec"))).alias(source)

    sources = ["demo", "geo", "late", "donor"]
    stacked = demo.unionByName(geo).unionByName(late).unionByName(donor)
    nobody = stacked.filter("person_id is null").select(
        "person_id", *[F.when(F.col("source") == s, F.col("rec")).alias(s) for s in sources]
    )
    folded = stacked.filter("person_id is not null").groupBy("person_id").agg(*[of(s) for s in sources]).unionByName(nobody)
    in_first = F.col("demo").isNotNull() | F.col("geo").isNotNull()

    def pick(field: str, first: str):
        return F.when(in_first, F.col(f"{first}.{field}")).otherwise(F.col(f"late.{field}"))

    return folded.select(
        "person_id",
        pick("fecha_nac", "demo").alias("fecha_nac"),
        pick("fecha_def_cor_rc", "demo").alias("fecha_def_cor_rc"),
        X.valid_sex(pick("sexo", "demo"), F.col("donor.sexo")).alias("sexo"),
        pick("nacionalidad", "demo").alias("nacionalidad"),
        pick("codigo_region", "geo").alias("codigo_region"),
        pick("codigo_comuna", "geo").alias("codigo_comuna"),
    )
