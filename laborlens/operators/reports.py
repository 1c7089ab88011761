"""Publication extracts and summaries from long indicator tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from laborlens.functions import periods as P
from laborlens.functions import scalars as X
from laborlens.operators.reshape import to_wide

# Indicators of each bulletin table.
GENERAL = [
    "t_ent", "var1_t_ent", "var12_t_ent", "t_sal", "var1_t_sal", "var12_t_sal",
    "t_rot", "var1_t_rot", "var12_t_rot", "t_rot_neta", "t_per", "var1_t_per", "var12_t_per",
]
BY_CLASS = [
    "t_ent", "var12_t_ent", "t_sal", "var12_t_sal", "t_rot", "var12_t_rot",
    "t_rot_neta", "inc_rot_neta", "t_per", "var12_t_per",
]
PUBLIC = ["pt", "var1_pt", "var12_pt"]

# Bulletin table -> (its breakdown, sort column, indicators, only public).
BULLETIN = {
    "general": ("total", None, GENERAL, False),
    "seccion": ("sector", "seccion", BY_CLASS, False),
    "tamano": ("tamano", "tamano_empresa_movil", BY_CLASS, False),
    "sexo": ("sx", "sexo", BY_CLASS, False),
    "nacionalidad": ("nc", "nacionalidad_final", BY_CLASS, False),
    "region": ("re", "region_final", BY_CLASS, False),
    "tramos": ("te", "tramo_edad", BY_CLASS, False),
    "ep": ("ep", None, PUBLIC, True),
}


def bulletin_table(
    long: DataFrame, indicators: list[str], sort: str | None = None, public: bool = False
) -> DataFrame:
    """Published indicators with a value, in order of month (and class)."""
    keep = F.col("indicador").isin(indicators) & F.col("valor").isNotNull()
    if public:
        keep &= F.col("ep") == 1
    order = ["anno", "mes"] + ([sort] if sort else [])
    return long.filter(keep).orderBy(*order)


def in_order(long: DataFrame, classes: list[str]) -> DataFrame:
    """A long indicator table in the order of publication: table, month, classes (unknown first), indicator."""
    return long.orderBy("tabla", "anno", "mes", *classes, "indicador")


def bulletin(long: DataFrame, catalogue: dict | None = None) -> DataFrame:
    """All bulletin tables from one long table, in one pass: cuadro, anno, mes, clase (as text), indicador, valor.

    ``long`` has ``tabla`` and the class columns of the catalogue; a column that is absent fails.
    """
    catalogue = catalogue or BULLETIN
    listed = [(t, source, i, public) for t, (source, _, indicators, public) in catalogue.items() for i in indicators]
    # A row for each published indicator: its size is that of the catalogue.
    wanted = long.sparkSession.createDataFrame(listed, "cuadro string, tabla string, indicador string, public boolean")
    rows = long.filter(F.col("valor").isNotNull()).join(F.broadcast(wanted), ["tabla", "indicador"])
    label = F.lit(None).cast("string")
    for table, (_, sort, _, _) in catalogue.items():
        if sort:
            label = F.when(F.col("cuadro") == table, F.col(sort).cast("string")).otherwise(label)
    if any(public for *_, public in listed):
        rows = rows.filter(~F.col("public") | (F.col("ep") == 1))
    return rows.select("cuadro", "anno", "mes", label.alias("clase"), "indicador", "valor")


def last_and_year_before(df: DataFrame) -> DataFrame:
    """Rows of the last month and of the same month a year before."""
    last = df.agg(F.max("fecha").alias("last"))
    two = last.select(F.explode(F.array("last", F.add_months("last", -12))).alias("fecha"))
    return df.join(P.by_month(two), "fecha", "left_semi")


def group_summary(long: DataFrame, group: str | list[str]) -> DataFrame:
    """Level now and a year before, yearly growth and incidence of each group (of one column, or of all breakdowns by a list)."""
    wide = to_wide(long, group, ["pt", "var12_pt", "inc12_pt"])
    now = last_and_year_before(wide).groupBy(*(["grupo"] if isinstance(group, str) else group))
    return now.agg(
        F.bround(F.max_by("pt", "fecha"), 0).alias("nivel_actual"),
        F.bround(F.min_by("pt", "fecha"), 0).alias("nivel_12_meses"),
        F.bround(F.max_by("var12_pt", "fecha"), 1).alias("var_anual"),
        F.bround(F.max_by("inc12_pt", "fecha"), 2).alias("incidencia"),
    )


def selected_months(df: DataFrame, years: tuple[int, int], months: list[int]) -> DataFrame:
    chosen = df.filter(F.col("anno").between(*years) & F.col("mes").isin(months))
    return chosen.withColumn("periodo", X.month_label("anno", "mes"))


def at_last_period(df: DataFrame) -> DataFrame:
    last = df.agg(F.max("periodo").alias("periodo"))
    return df.join(P.by_month(last), "periodo", "left_semi")


def leaders(df: DataFrame, value: str, by: list[str]) -> DataFrame:
    """Rows with the largest value in each group; ties all stay."""
    w = W.partitionBy(*by).orderBy(F.col(value).desc())
    return df.filter(F.col(value).isNotNull()).withColumn("_r", F.rank().over(w)).filter("_r = 1").drop("_r")


def latest_total_and_leader(df: DataFrame, category: str, value: str) -> DataFrame:
    """Total of the last period, as number and text, with its leading category."""
    last = at_last_period(df)
    total = last.groupBy("periodo").agg(F.sum(value).alias("total"))
    top = leaders(last, value, ["periodo"]).select("periodo", F.col(category).alias("lider"))
    return total.join(top, "periodo", "left").withColumn("total_texto", X.magnitude("total"))
