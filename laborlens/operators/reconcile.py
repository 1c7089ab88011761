"""Comparison of two independent sources of the same indicators."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laborlens.functions import scalars as X
from laborlens.operators.reshape import recode_indicators

Transform = Callable[[DataFrame], DataFrame]


def drop_missing(df: DataFrame, dims: list[str]) -> DataFrame:
    return df.na.drop(subset=["valor", *dims])


def age_codes(df: DataFrame) -> DataFrame:
    """Age labels of the second source as codes; rows without a label are dropped."""
    return df.filter(F.col("edad").isNotNull()).withColumn("edad", X.age_label_code("edad"))


def dims_as_text(*names: str) -> Transform:
    return lambda df: df.withColumns({n: F.col(n).cast("string") for n in names})


# Label -> (own table, reference table, own dimension -> reference dimension).
CATALOGUE = {
    "general": ("total", "indicadores_general", {}),
    "sexo": ("sx", "indicadores_sexo", {"sexo": "sexo"}),
    "nacionalidad": ("nc", "indicadores_nacionalidad", {"nacionalidad_final": "nacionalidad"}),
    "region": ("re", "indicadores_region", {"region_final": "region_trabajador"}),
    "edad": ("te", "indicadores_edad", {"tramo_edad": "edad"}),
    "seccion": ("sector", "indicadores_seccion", {"seccion": "seccion"}),
    "tamano": ("tamano", "indicadores_tamano", {"tamano_empresa_movil": "tamano"}),
    "sexo_seccion": (
        "sx_sector", "indicadores_seccion_sexo", {"sexo": "sexo", "seccion": "seccion"},
    ),
    "sexo_tamano": (
        "sx_tamano", "indicadores_sexo_tamano", {"sexo": "sexo", "tamano_empresa_movil": "tamano"},
    ),
    "tamano_seccion": (
        "tamano_sector", "indicadores_seccion_tamano",
        {"tamano_empresa_movil": "tamano", "seccion": "seccion"},
    ),
    "sexo_edad": ("sx_te", "indicadores_sexo_edad", {"sexo": "sexo", "tramo_edad": "edad"}),
    "sexo_tamano_seccion": (
        "sx_tamano_sector", "indicadores_seccion_tamano_sexo",
        {"sexo": "sexo", "tamano_empresa_movil": "tamano", "seccion": "seccion"},
    ),
}


def compare(
    own: DataFrame,
    reference: DataFrame,
    dims: dict[str, str],
    rename_time: bool = True,
    drop_null_dims: bool = True,
    own_first: Transform | None = None,
    reference_first: Transform | None = None,
) -> DataFrame:
    """Rows both sources have, with ``valor_ad``, ``valor_rp`` and their difference ``d``.

    ``dims`` maps own dimension names to those of the reference.
    """
    a = recode_indicators(own.filter(F.col("valor").isNotNull()).drop("fecha"))
    if drop_null_dims:
        a = a.na.drop(subset=list(dims)) if dims else a
    a = a.transform(own_first) if own_first else a
    b = reference.filter(F.col("valor").isNotNull())
    b = b.transform(reference_first) if reference_first else b
    renames = {rp: ad for ad, rp in dims.items() if ad != rp}
    if rename_time:
        renames |= {"anno_dev.cur": "anno", "mes_dev.cur": "mes"}
    b = b.withColumnsRenamed(renames)
    keys = ["anno", "mes", *dims, "indicador"]
    a = a.withColumnRenamed("valor", "valor_ad").alias("a")
    b = b.select(*keys, F.col("valor").alias("valor_rp")).alias("b")
    same = reduce(lambda x, y: x & y, [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys])
    joined = a.join(b, keys) if drop_null_dims else a.join(b, same).select("a.*", "b.valor_rp")
    return joined.withColumn("d", F.col("valor_ad") - F.col("valor_rp"))


def own_names(reference: DataFrame) -> DataFrame:
    """A long table of the second source under the first one's names and codes.

    Columns that a source lacks stay away. Ages come as labels and regions as text, as :func:`age_codes` and
    :func:`dims_as_text` say; rows with an age that is no label have no code.
    """
    renames = {rp: ad for _, _, dims in CATALOGUE.values() for ad, rp in dims.items()}
    out = reference.withColumnsRenamed({k: v for k, v in renames.items() if k in reference.columns})
    out = out.withColumnsRenamed({"anno_dev.cur": "anno", "mes_dev.cur": "mes"})
    return out.withColumn("tramo_edad", X.age_label_code("tramo_edad")) if "tramo_edad" in out.columns else out


def fold(both: DataFrame, catalogue: dict | None = None) -> DataFrame:
    """Every comparison from one stack of the two sources: comparacion, anno, mes, classes, indicador, values and ``d``.

    ``both`` has tabla, anno, mes, the class columns, indicador, valor and ``own`` (whose row it is), with one row of
    each source per cell. A cell is the rows that agree on all keys, so one shuffle takes the place of a join for each
    table. Rows without a value or with an unknown class of their table take no part.
    """
    catalogue = catalogue or CATALOGUE
    classes = list(dict.fromkeys(d for _, _, dims in catalogue.values() for d in dims))
    label = F.lit(None).cast("string")
    for name, (table, _, dims) in catalogue.items():
        known = reduce(lambda a, d: a & F.col(d).isNotNull(), dims, F.col("tabla") == table)
        label = F.when(known, name).otherwise(label)
    named = recode_indicators(both.filter("valor is not null")).withColumn("comparacion", label)
    cells = named.filter("comparacion is not null").groupBy("comparacion", "anno", "mes", *classes, "indicador")
    side = lambda own, name: F.max(F.when(F.col("own") == own, F.col("valor"))).alias(name)
    met = cells.agg(side(True, "valor_ad"), side(False, "valor_rp"))
    met = met.filter("valor_ad is not null and valor_rp is not null")
    return met.withColumn("d", F.col("valor_ad") - F.col("valor_rp"))


def compare_all(own: DataFrame, reference: DataFrame, catalogue: dict | None = None) -> DataFrame:
    """Every comparison of two long tables, the second under its own names; see :func:`fold`."""
    second = own_names(reference).withColumn("own", F.lit(False))
    first = own.drop("fecha").withColumn("own", F.lit(True))
    return fold(first.unionByName(second.drop("fecha")), catalogue)


def summary(compared: DataFrame, labels: list[str]) -> DataFrame:
    """Rows, nonzero differences, largest and mean absolute difference per comparison.

    A label without rows is listed with 0 rows and unknown differences.
    """
    spark = compared.sparkSession
    listed = spark.createDataFrame([(name, None, 0) for name in labels], "comparacion string, d double, row int")
    d = F.abs("d")
    rows = compared.select("comparacion", "d", F.lit(1).alias("row")).unionByName(listed)
    return rows.groupBy("comparacion").agg(
        F.sum("row").alias("n_filas"),
        F.count_if(F.col("d") != 0).alias("n_dif_nz"),
        F.max(d).alias("max_abs_d"),
        F.avg(d).alias("mean_abs_d"),
    )
