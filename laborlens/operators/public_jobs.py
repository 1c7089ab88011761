"""Public employment: jobs, persons, variations and incidences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from laborlens import schema as S
from laborlens.functions import periods as P
from laborlens.functions import scalars as X
from laborlens.operators import reshape
from laborlens.operators.stocks import roll_up


def public_job_cells(panel: DataFrame, unique_key: bool = False) -> DataFrame:
    """Distinct public jobs per month and classes."""
    jobs = P.with_pidx(panel).filter("ep = 1").groupBy("pidx", *S.PUBLIC_CLASSES)
    n = F.count("*") if unique_key else F.countDistinct(*S.JOB)
    return jobs.agg(n.alias("pt"))


def main_jobs(panel: DataFrame) -> DataFrame:
    """Each worker's main job of the month: most pay, then days, then lowest firm.

    Rows without pay, days or firm are not ranked. The rank limit runs before
    the shuffle as well, so a worker with very many jobs is cut down per task.
    """
    panel = P.with_pidx(panel).dropna(subset=["monto", "dias", "firm_id"])
    w = W.partitionBy("worker_id", "pidx").orderBy(
        F.col("monto").desc(), F.col("dias").desc(), F.col("firm_id").asc()
    )
    return panel.withColumn("_r", F.rank().over(w)).filter("_r = 1").drop("_r")


def public_person_cells(panel: DataFrame) -> DataFrame:
    """Public workers per month and classes of their main public job."""
    chosen = main_jobs(P.with_pidx(panel).filter("ep = 1"))
    return chosen.groupBy("pidx", *S.PUBLIC_CLASSES).agg(F.count("*").alias("pt"))


def public_tables(cells: DataFrame, sets: dict[str, list[str]] | None = None) -> DataFrame:
    """All breakdowns of cell counts, as one long table."""
    return roll_up(cells, sets or S.PUBLIC_BREAKDOWNS, ["pt"])


def variations(df: DataFrame, by: list[str], calendar: bool = False) -> DataFrame:
    """12-month and 1-month growth of ``pt`` in each series."""
    return df.withColumns(
        {
            "var12_pt": X.growth("pt", P.shifted("pt", 12, by, calendar)),
            "var1_pt": X.growth("pt", P.shifted("pt", 1, by, calendar)),
        }
    )


def with_total(df: DataFrame, total: DataFrame) -> DataFrame:
    totals = total.select("pidx", F.col("pt").alias("pt_tot"))
    return df.join(P.by_month(P.one_per_month(totals, ["pidx"])), "pidx", "left")


def incidences(df: DataFrame, total: DataFrame, by: list[str]) -> DataFrame:
    """Own growth weighted by the lagged share in the total, at 12 and 1 months."""

    def weight(k: int) -> Column:
        return X.ratio(P.shifted("pt", k, by), P.shifted("pt_tot", k, by))

    return (
        with_total(df, total)
        .withColumns({"_w12": weight(12), "_w1": weight(1)})
        .withColumns(
            {
                "inc_var_12": F.col("var12_pt") * F.col("_w12"),
                "inc_var_01": F.col("var1_pt") * F.col("_w1"),
            }
        )
        .drop("_w12", "_w1", "pt_tot")
    )


# Published names of the incidence indicators.
INCIDENCE_NAMES = {"inc_var_12": "inc12_pt", "inc_var_01": "inc1_pt"}


def public_indicators(tables: DataFrame) -> DataFrame:
    """Variations and incidences of all breakdowns, in long form."""
    by = [c for c in tables.columns if c not in ("pidx", "pt")]
    total = tables.filter("tabla = 'total'")
    parts = variations(tables.filter("tabla <> 'total'"), by)
    return reshape.to_long(incidences(parts, total, by), renames=INCIDENCE_NAMES)


def parent_total(df: DataFrame, parent: str) -> DataFrame:
    """Sum over the parent category in the month (cells, not jobs)."""
    w = W.partitionBy("pidx", parent)
    return df.withColumn("pt_seccion", F.sum("pt").over(w))


def conditional_incidence(
    df: DataFrame,
    group: str = "subsector_institucional",
    parent: str = "seccion_ciiu4cl_prin",
) -> DataFrame:
    """Growth of a group weighted by its lagged share inside the parent category."""
    by = [group, parent]
    lags = {
        "pt_lag12": P.shifted("pt", 12, by),
        "pt_seccion_lag12": P.shifted("pt_seccion", 12, by),
        "pt_lag1": P.shifted("pt", 1, by),
        "pt_seccion_lag1": P.shifted("pt_seccion", 1, by),
    }
    wide = parent_total(df, parent).withColumns(lags)
    wide = wide.withColumns(
        {"var12_pt": X.growth("pt", "pt_lag12"), "var1_pt": X.growth("pt", "pt_lag1")}
    )
    return wide.withColumns(
        {
            "wi_12": X.ratio("pt_lag12", "pt_seccion_lag12"),
            "wi_01": X.ratio("pt_lag1", "pt_seccion_lag1"),
        }
    ).withColumns(
        {
            "inc_var_12": F.col("var12_pt") * F.col("wi_12"),
            "inc_var_01": F.col("var1_pt") * F.col("wi_01"),
        }
    )


def conditional_incidence_long(df: DataFrame, group: str, parent: str) -> DataFrame:
    wide = conditional_incidence(df, group, parent).drop("wi_12", "wi_01")
    long = reshape.to_long(wide, pattern=r"^pt|^var|^inc_")
    return long.select("anno", "mes", group, parent, "indicador", "valor")
