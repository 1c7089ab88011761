"""One-month gaps of a job, filled from the months on either side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from laborlens import schema as S
from laborlens.functions import periods as P
from laborlens.functions import scalars as X
from laborlens.operators.clean import cap_pay


def impute_gaps(
    panel: DataFrame, periods: DataFrame | None = None, calendar: bool = False
) -> DataFrame:
    """Panel plus one row per single-period gap, flagged ``is_imputed``.

    Needs a unique (worker, firm, period). Rows of months that ``periods`` lacks come out as they are. A gap is a job seen at positions p
    and p+2 and not at p+1; edge periods come out as they are. One shuffle by
    job: each observed row carries its successor and is exploded into itself and
    the row that follows it. A job has at most one row per month, so a window
    partition never exceeds the number of months.
    """
    panel = P.with_pidx(panel)
    links = P.period_links(panel if periods is None else periods, calendar, lag=1)
    links = links.select("pidx", "pos", F.col("pidx_next").alias("gap_pidx"))
    has_type = "tipo_trabajador" in panel.columns
    carried = ["tipo_trabajador"] if has_type else []

    w = W.partitionBy(*S.JOB).orderBy("pos")
    seen = (
        panel.select(*S.JOB, "pidx", *carried, "monto", "dias")
        .join(P.by_month(links), "pidx", "left")
        .select(
            "*",
            F.lead("pos").over(w).alias("next_pos"),
            F.lead("monto").over(w).alias("next_monto"),
            F.lead("dias").over(w).alias("next_dias"),
        )
    )

    def row(pidx, monto, dias, imputed: bool):
        return F.struct(
            pidx.alias("pidx"),
            monto.cast("double").alias("monto"),
            dias.cast("int").alias("dias"),
            F.lit(imputed).alias("is_imputed"),
        )

    observed = row(F.col("pidx"), F.col("monto"), F.col("dias"), False)
    filled = row(
        F.col("gap_pidx"),
        X.between_neighbours("monto", "next_monto"),
        X.between_neighbours_days("dias", "next_dias"),
        True,
    )
    gap = F.col("next_pos") - F.col("pos") == 2
    rows = F.when(gap, F.array(observed, filled)).otherwise(F.array(observed))
    out = seen.select(*S.JOB, *carried, F.explode(rows).alias("r"))
    return out.select(
        *S.JOB,
        P.anno_of("r.pidx").alias("anno"),
        P.mes_of("r.pidx").alias("mes"),
        F.col("r.pidx").alias("pidx"),
        *carried,
        "r.monto",
        "r.dias",
        "r.is_imputed",
    )


def cap_and_impute(
    panel: DataFrame, caps: DataFrame, missing_cap: str = "null", calendar: bool = False
) -> DataFrame:
    """Cap pay, then fill gaps with the capped pay of the neighbours."""
    panel = P.with_pidx(panel)
    return impute_gaps(cap_pay(panel, caps, missing_cap), panel, calendar)
