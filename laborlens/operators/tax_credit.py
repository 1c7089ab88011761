"""Tax credit on low pay: credit per job and firm, shares per class."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from laborlens import schema as S
from laborlens.functions import periods as P
from laborlens.functions import scalars as X
from laborlens.operators import distinct
from laborlens.operators.stocks import roll_up
from laborlens.sources.tables import eligible, keep_first

JOB_CLASSES = [
    "sexo", "nacionalidad", "codigo_region", "tramo_edad", "tamano_empresa_movil", "seccion",
]
FIRM_CLASSES = ["tamano_empresa_movil", "seccion"]


def with_parameters(panel: DataFrame, params: DataFrame) -> DataFrame:
    """Tax unit and dollar of the month; a month without parameters gets NULL."""
    months = params.select("pidx", "utm", "usd")
    return P.with_pidx(panel).join(P.by_month(P.one_per_month(months, ["pidx"])), "pidx", "left")


def credits(panel: DataFrame, params: DataFrame) -> DataFrame:
    """Private jobs paid within the credit's bounds, with their credit."""
    low, high = X.credit_bounds("utm")
    scope = panel.filter((F.col("ep") == 0) & eligible())
    return (
        with_parameters(scope, params)
        .withColumns({"li": low, "ls": high})
        .filter(F.col("monto").between(F.col("li"), F.col("ls")))
        .withColumn("tasa_ct", X.credit_rate("monto", "li", "ls"))
        .withColumn("ct", F.col("monto") * F.col("tasa_ct"))
        .withColumns({"monto_usd": X.ratio("monto", "usd"), "ct_usd": X.ratio("ct", "usd")})
    )


def credit_by_class(credit: DataFrame, unique_key: bool = False) -> DataFrame:
    """Jobs (one per worker and firm) and credit per class and month."""
    cols = [*S.JOB, "pidx", *JOB_CLASSES, "ct", "ct_usd"]
    jobs = credit.select(*cols)
    jobs = jobs if unique_key else keep_first(jobs, S.JOB + ["pidx"])
    return jobs.groupBy("pidx", *JOB_CLASSES).agg(
        F.count("*").alias("puestos_de_trabajo"),
        F.sum("ct").alias("ct_total_clp"),
        F.sum("ct_usd").alias("ct_total_usd"),
    )


def credit_by_firm(credit: DataFrame) -> DataFrame:
    """Labour cost and credit per firm and month, in pesos and dollars."""
    return credit.groupBy("pidx", "firm_id", *FIRM_CLASSES).agg(
        F.sum("monto").alias("cl_clp"),
        F.sum("ct").alias("ct_clp"),
        F.sum("monto_usd").alias("cl_usd"),
        F.sum("ct_usd").alias("ct_usd"),
    )


def share(df: DataFrame, value: str, name: str, by=("anno", "mes")) -> DataFrame:
    """Share of each class in the month's sum. ``df`` holds one row per class and month."""
    total = F.sum(value).over(W.partitionBy(*by))
    return df.withColumn(name, X.ratio(value, total))


# Published tables of jobs, and breakdowns of firms, with their classes.
JOB_TABLES = {"pt_sx_nc": ["sexo", "nacionalidad"], "pt_tamano": ["tamano_empresa_movil"], "pt_sector": ["seccion"]}
FIRM_SETS = {"tamano": ["tamano_empresa_movil"], "sector": ["seccion"]}
MEASURES = ["n", "monto_clp", "monto_usd"]


def job_cells(by_class: DataFrame) -> DataFrame:
    """Jobs of the three job tables: tabla, pidx, classes and the measures, of which the amounts are null."""
    rolled = roll_up(by_class, JOB_TABLES, ["puestos_de_trabajo"])
    none = F.lit(None).cast("double")
    return rolled.withColumnRenamed("puestos_de_trabajo", "n").withColumns({"monto_clp": none, "monto_usd": none})


def firm_cells(by_firm: DataFrame) -> DataFrame:
    """The four firm tables, of the same columns: firms by size and by section, counted exactly from bitmaps that roll up, and
    labour cost and credit by size, from the same grouping."""
    sums = ["cl_clp", "ct_clp", "cl_usd", "ct_usd"]
    parts = distinct.partials(by_firm, ["pidx", *FIRM_CLASSES], "firm_id", sums)
    rolled = distinct.roll_up(parts, FIRM_SETS, ["pidx"], FIRM_CLASSES, sums, "n_e")

    def row(table: str, n=None, clp=None, usd=None):
        values = zip(MEASURES, (n, clp, usd), ("long", "double", "double"), strict=True)
        return F.struct(F.lit(table).alias("tabla"), *[(F.col(v) if v else F.lit(None)).cast(t).alias(m) for m, v, t in values])

    size = F.array(row("ee_tamano", "n_e"), row("cl_tamano", None, "cl_clp", "cl_usd"), row("ct_tamano", None, "ct_clp", "ct_usd"))
    rows = F.when(F.col("tabla") == "tamano", size).otherwise(F.array(row("ee_sector", "n_e")))
    return rolled.select("pidx", *FIRM_CLASSES, F.explode(rows).alias("r")).select("r.tabla", "pidx", *FIRM_CLASSES, *[f"r.{m}" for m in MEASURES])


def with_shares(cells: DataFrame) -> DataFrame:
    """Cells of any tables with the share of each in its table's month, dated."""
    names = {"n": "participacion", "monto_clp": "participacion_clp", "monto_usd": "participacion_usd"}
    for m in MEASURES:
        cells = share(cells, m, names[m], ("tabla", "pidx"))
    return cells.withColumns({"anno": P.anno_of("pidx"), "mes": P.mes_of("pidx")}).drop("pidx")


def participation_long(by_class: DataFrame, by_firm: DataFrame) -> DataFrame:
    """All seven published tables as one: tabla, anno, mes, classes (null where a table has none), n, amounts and shares.

    Each of the two inputs is grouped once for all of its tables, and one window gives all shares.
    """
    return with_shares(job_cells(by_class).unionByName(firm_cells(by_firm), allowMissingColumns=True))


def participation_tables(by_class: DataFrame, by_firm: DataFrame) -> dict[str, DataFrame]:
    """The seven published tables by name, each with its own classes and measures."""
    jobs, firms = with_shares(job_cells(by_class)), with_shares(firm_cells(by_firm))
    count, amounts = ["n", "participacion"], ["monto_clp", "participacion_clp", "monto_usd", "participacion_usd"]
    sets = {
        **{t: (jobs, c, count) for t, c in JOB_TABLES.items()},
        **{f"ee_{t}": (firms, c, count) for t, c in FIRM_SETS.items()},
        **{t: (firms, FIRM_SETS["tamano"], amounts) for t in ("cl_tamano", "ct_tamano")},
    }
    return {t: df.filter(F.col("tabla") == t).select("anno", "mes", *c, *m) for t, (df, c, m) in sets.items()}
