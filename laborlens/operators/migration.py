"""Net migration of jobs between classes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laborlens import schema as S
from laborlens.functions import scalars as X
from laborlens.operators.flows import year_apart
from laborlens.operators.reshape import with_calendar

COUNTS = ["In", "Em", "L_t12", "L_t"]


def migration_rates(
    jobs: DataFrame,
    combos: list[list[str]] | None = None,
    periods: DataFrame | None = None,
    calendar: bool = False,
) -> DataFrame:
    """Arrivals, departures and stocks of every class of every combination.

    A stayer counts for a combination when one of its variables changed over the
    year. Jobs are first counted by (classes now, classes a year back); the
    combinations expand those counts, so each job is shuffled once.
    """
    combos = combos or S.MIGRATION_COMBOS
    attrs = list(dict.fromkeys(c for combo in combos for c in combo))
    state = year_apart(jobs, attrs, periods, calendar, with_before=True)
    stayed = F.col("was_here") & F.col("has_past")
    cells = state.groupBy(
        "pidx", "pidx_next", "has_past", *attrs,
        stayed.alias("stayed"), F.when(stayed, F.col("before")).alias("before"),
    ).agg(F.count("*").alias("n"))

    # Written as SQL text: four counts for each combination, of any number of columns.
    rows = []
    for combo in combos:
        differs = " OR ".join(f"coalesce({v} <> before.{v}, false)" for v in combo)
        moved = f"stayed AND ({differs})"
        for measure, pidx, source, cond in (
            ("L_t", "pidx", "", "has_past"),
            ("L_t12", "pidx_next", "", "pidx_next IS NOT NULL"),
            ("In", "pidx", "", moved),
            ("Em", "pidx", "before.", moved),
        ):
            fields = [f"'{' x '.join(combo)}' AS desagregacion", f"{pidx} AS pidx"]
            fields += [f"{source + v if v in combo else 'NULL'} AS {v}" for v in attrs]
            fields += [f"{'n' if m == measure else '0L'} AS {m}" for m in COUNTS]
            rows.append(f"CASE WHEN {cond} THEN struct({', '.join(fields)}) END")
    counted = (
        cells.select(F.explode(F.expr(f"array({', '.join(rows)})")).alias("e"))
        .filter("e is not null")
        .select("e.*")
        .groupBy("desagregacion", "pidx", *attrs)
        .agg(*[F.sum(m).alias(m) for m in COUNTS])
    )
    return with_rates(with_calendar(counted))


def with_rates(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "tasa_inmigracion": X.ratio_if_positive("In", "L_t12"),
            "tasa_emigracion": X.ratio_if_positive("Em", "L_t12"),
            "tmn": X.ratio_if_positive(F.col("In") - F.col("Em"), "L_t12"),
            "var_12": X.ratio_if_positive(F.col("L_t") - F.col("L_t12"), "L_t12"),
        }
    )
