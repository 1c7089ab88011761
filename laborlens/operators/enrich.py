"""Demographic, economic and institutional attributes on the panel."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laborlens import schema as S
from laborlens.functions import scalars as X


def firm_lookup(*tables: DataFrame) -> DataFrame:
    """All firm attributes in one table (each input has one row per firm)."""
    return reduce(lambda a, b: a.join(b, "firm_id", "full"), tables)


def worker_lookup(persons: DataFrame, nationality_mode: DataFrame) -> DataFrame:
    renamed = persons.withColumnRenamed("person_id", "worker_id")
    return renamed.join(nationality_mode, "worker_id", "full")


def enrich(
    panel: DataFrame,
    persons: DataFrame,
    firm_master: DataFrame,
    public_sector: DataFrame,
    static_size: DataFrame,
    nationality_mode: DataFrame,
    region_donor: DataFrame,
) -> DataFrame:
    """Panel with every derived class.

    The six lookups are first folded into one table per key, so the panel takes
    part in two joins, each the only consumer of its shuffle: AQE may broadcast
    a small lookup after measuring it, or split a hot worker or firm.
    """
    workers = worker_lookup(persons, nationality_mode)
    firms = firm_lookup(firm_master, public_sector, static_size, region_donor)
    joined = panel.join(workers, "worker_id", "left").join(firms, "firm_id", "left")
    return derive(joined)


def derive(joined: DataFrame) -> DataFrame:
    """Age, age bands, public flag and final nationality and region."""
    return joined.withColumns(
        {
            "edad_meses": X.months_since("fecha_nac", "anno", "mes"),
            "ep": F.coalesce("ep", F.lit(0)),
            "nacionalidad_depurada": X.known_code("nacionalidad", S.NATIONALITY_UNKNOWN),
            "codigo_region_depurada": X.known_code("codigo_region", S.REGION_UNKNOWN),
            "nacionalidad_final": X.code_with_donor(
                "nacionalidad", "nc_moda", S.NATIONALITY_UNKNOWN, S.NATIONALITY_UNKNOWN
            ),
            "region_final": X.code_with_donor(
                "codigo_region", "region_trabajador", S.REGION_UNKNOWN, S.REGION_DONOR_UNKNOWN
            ),
        }
    ).withColumns(
        {
            "tramo_edad": X.age_band_7("edad_meses"),
            "tramo_edad_2": X.age_band_13("edad_meses"),
        }
    )
