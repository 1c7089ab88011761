"""Literal tables, parameter tables and lookup projections."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laborlens import schema as S
from laborlens.functions import periods as P
from laborlens.functions.scalars import cap_pesos, date_of

# Monthly value of the inflation-linked unit (UF), January to December.
UF_BY_MONTH = {
    2016: [25629.09, 25629.09, 25721.82, 25814.55, 25910.25, 25995.56,
           26053.81, 26145.01, 26210.79, 26224.30, 26263.20, 26315.28],
    2017: [26348.83, 26316.51, 26396.79, 26473.65, 26564.95, 26632.70,
           26665.98, 26593.89, 26605.81, 26658.56, 26633.18, 26736.45],
    2018: [26799.01, 26825.81, 26928.49, 26966.89, 27006.43, 27080.94,
           27161.48, 27203.36, 27291.08, 27359.27, 27434.76, 27536.46],
    2019: [27565.79, 27545.34, 27557.89, 27565.76, 27666.77, 27765.23,
           27908.86, 27953.42, 27994.89, 28050.40, 28065.35, 28229.83],
    2020: [28310.86, 28339.17, 28469.54, 28601.15, 28693.59, 28716.52,
           28695.46, 28666.51, 28680.37, 28708.80, 28844.20, 29036.92],
    2021: [29069.39, 29126.55, 29294.68, 29396.67, 29498.06, 29617.07,
           29712.80, 29758.60, 29942.78, 30092.38, 30392.22, 30776.05],
    2022: [30996.73, 31220.68, 31552.64, 31730.80, 32196.69, 32694.20,
           33099.99, 33426.92, 33851.69, 34271.85, 34610.35, 34817.58],
    2023: [35122.26, 35290.91, 35519.79, 35574.33, 35851.62, 36036.37,
           36090.68, 36046.72, 36134.97, 36198.73, 36396.26, 36568.74],
    2024: [36797.64, 36727.10, 36865.37, 37100.68, 37266.94, 37444.94,
           37575.61, 37577.74, 37762.97, 37914.20, 37972.65, 38260.61],
    2025: [39485.65] * 12,
}

# Yearly pay cap, in UF.
CAP_UF_BY_YEAR = {
    2016: 74.3, 2017: 75.7, 2018: 78.3, 2019: 79.3, 2020: 80.2,
    2021: 81.7, 2022: 81.6, 2023: 81.6, 2024: 84.3, 2025: 87.8,
}


def pay_caps(spark: SparkSession) -> DataFrame:
    """(anno, mes, tope): the 120 monthly caps in pesos."""
    rows = [
        (year, month, cap_pesos(uf, CAP_UF_BY_YEAR[year]))
        for year, values in UF_BY_MONTH.items()
        for month, uf in enumerate(values, start=1)
    ]
    return spark.createDataFrame(rows, "anno int, mes int, tope int")


def year_months(df: DataFrame) -> DataFrame:
    """All twelve months of every year present in ``df``."""
    years = df.select("anno").distinct()
    return years.select("anno", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("mes"))


def parameters(spark: SparkSession, path: str, schema=S.PARAMETERS) -> DataFrame:
    """Monthly parameters from CSV with a declared schema, plus ``pidx``."""
    df = spark.read.schema(schema).option("header", True).csv(path)
    return df.withColumn("pidx", P.pidx_of_date("fecha"))


# --- lookup projections ---------------------------------------------------------


def persons_lookup(df: DataFrame) -> DataFrame:
    return df.select(
        "person_id", "sexo", "nacionalidad",
        date_of(df, "fecha_nac"), date_of(df, "fecha_def_cor_rc"),
        "codigo_region", "codigo_comuna",
    )


def firm_master_lookup(df: DataFrame) -> DataFrame:
    return df.select("firm_id", "seccion", "division", "comuna_cut")


def public_sector_lookup(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("firm_id").cast("long").alias("firm_id"),
        "razon_social_unidad_legal", "seccion_ciiu4cl_prin",
        "sector_institucional", "subsector_institucional",
        F.lit(1).alias("ep"),
    )


def static_size_lookup(df: DataFrame) -> DataFrame:
    return df.select("firm_id", "tamano")


def nationality_mode_lookup(df: DataFrame) -> DataFrame:
    return df.select("worker_id", F.col("moda").alias("nc_moda"))


def region_donor_lookup(df: DataFrame) -> DataFrame:
    return df.select("firm_id", "region_trabajador")


def require_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """The table itself; raises when two rows share a key.

    Meant for lookup tables, where a repeated key would multiply panel rows. The
    check counts per key with map-side combine, so a hot key costs no more.
    """
    known = df.dropna(subset=keys)  # a null key matches no row
    repeated = known.groupBy(*keys).count().filter("count > 1")
    if not repeated.isEmpty():
        raise ValueError(f"keys {keys} are not unique")
    return df
