"""Entries, exits and reclassifications against the same month of the year before."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from laborlens import schema as S
from laborlens.functions import periods as P
from laborlens.operators.stocks import roll_up


def year_apart(
    jobs: DataFrame,
    attrs: list[str],
    periods: DataFrame | None = None,
    calendar: bool = False,
    with_before: bool = False,
) -> DataFrame:
    """Each job row with its state one year back and one year on.

    Adds ``has_past`` and ``pidx_next`` (whether those periods exist),
    ``was_here`` and ``stays`` (whether the job exists there) and, on request,
    ``before``: the job's attributes a year back. Needs unique (worker, firm,
    period). Rows of months that ``periods`` lacks stay, without past or future.

    This takes the place of a self join of the panel with itself: one shuffle by
    job, with value frames on the period position. A window partition is one
    job, at most one row per month.
    """
    jobs = P.with_pidx(jobs)
    links = P.period_links(jobs if periods is None else periods, calendar)
    w = W.partitionBy(*S.JOB).orderBy("pos")
    back, ahead = w.rangeBetween(-12, -12), w.rangeBetween(12, 12)
    extra = [F.max("pos").over(back).isNotNull().alias("was_here")]
    if with_before:
        extra.append(F.first(F.struct(*attrs)).over(back).alias("before"))
    return (
        jobs.select(*S.JOB, "pidx", *attrs)
        .join(P.by_month(links), "pidx", "left")
        .select(
            *S.JOB,
            "pidx",
            "pidx_next",
            "has_past",
            *attrs,
            *extra,
            F.max("pos").over(ahead).isNotNull().alias("stays"),
        )
    )


def is_entry() -> Column:
    return F.col("has_past") & ~F.col("was_here")


def is_exit() -> Column:
    return F.col("pidx_next").isNotNull() & ~F.col("stays")


def changed(attrs: list[str], before: str = "before") -> Column:
    """Some attribute differs from a year back; an unknown value is no change."""
    tests = [F.coalesce(F.col(a) != F.col(f"{before}.{a}"), F.lit(False)) for a in attrs]
    return reduce(lambda a, b: a | b, tests)


def flow_events(
    jobs: DataFrame,
    classes: list[str],
    reclass_vars: list[str] | None = None,
    periods: DataFrame | None = None,
    calendar: bool = False,
) -> DataFrame:
    """One row per flow: (pidx, tipo_flujo, classes).

    Entries carry this month's classes; exits are shown a year on with the
    classes the job had. With ``reclass_vars``, a stayer whose attributes changed
    gives two rows, one with the old and one with the new classes.
    """
    state = year_apart(jobs, classes, periods, calendar, with_before=bool(reclass_vars))

    def event(kind: str, pidx: str, source: str | None = None) -> Column:
        cols = [F.col(f"{source}.{c}" if source else c).alias(c) for c in classes]
        return F.struct(F.lit(kind).alias("tipo_flujo"), F.col(pidx).alias("pidx"), *cols)

    branches = [
        (is_entry(), event("entrada", "pidx")),
        (is_exit(), event("salida", "pidx_next")),
    ]
    if reclass_vars:
        moved = F.col("has_past") & F.col("was_here") & changed(reclass_vars)
        branches += [
            (moved, event("reclasif_entrada", "pidx")),
            (moved, event("reclasif_salida", "pidx", "before")),
        ]
    rows = F.array(*[F.when(cond, struct) for cond, struct in branches])
    return state.select(F.explode(rows).alias("e")).filter("e is not null").select("e.*")


def flows_fixed(
    jobs: DataFrame,
    classes: list[str] | None = None,
    periods: DataFrame | None = None,
    calendar: bool = False,
) -> DataFrame:
    """Entries and exits per month and classes; an absent side is 0."""
    classes = S.CLASSES if classes is None else classes
    events = flow_events(jobs, classes, None, periods, calendar)
    kind = F.col("tipo_flujo")
    return events.groupBy("pidx", *classes).agg(
        F.count_if(kind == "entrada").alias("pt_ent_12"),
        F.count_if(kind == "salida").alias("pt_sal_12"),
    )


def flows_mobile(
    jobs: DataFrame,
    classes: list[str] | None = None,
    reclass_vars: list[str] | None = None,
    periods: DataFrame | None = None,
    calendar: bool = False,
) -> DataFrame:
    """Entries, exits and reclassifications per month and classes, one row per flow type."""
    classes = S.CLASSES if classes is None else classes
    reclass_vars = S.RECLASS_VARS if reclass_vars is None else reclass_vars
    events = flow_events(jobs, classes, reclass_vars, periods, calendar)
    return events.groupBy("pidx", "tipo_flujo", *classes).agg(F.count("*").alias("n"))


def turnover_cells(
    jobs: DataFrame,
    classes: list[str] | None = None,
    periods: DataFrame | None = None,
    calendar: bool = False,
) -> DataFrame:
    """Stock, entries and exits per month and classes, from one pass over the jobs.

    The rows of ``stock_cells`` and ``flows_fixed`` side by side, without a
    second read of the panel and without a join.
    """
    classes = S.CLASSES if classes is None else classes
    state = year_apart(jobs, classes, periods, calendar)
    one, none = F.lit(1).cast("byte"), F.lit(0).cast("byte")

    def row(pidx: str, pt: Column, ent: Column, sal: Column) -> Column:
        return F.struct(
            F.col(pidx).alias("pidx"), pt.alias("pt"), ent.alias("ent"), sal.alias("sal")
        )

    here = row("pidx", one, F.when(is_entry(), one).otherwise(none), none)
    gone = row("pidx_next", none, none, one)
    rows = F.array(here, F.when(is_exit(), gone))
    return (
        state.select(*classes, F.explode(rows).alias("e"))
        .filter("e is not null")
        .groupBy(F.col("e.pidx").alias("pidx"), *classes)
        .agg(
            F.sum("e.pt").alias("pt"),
            F.sum("e.ent").alias("pt_ent_12"),
            F.sum("e.sal").alias("pt_sal_12"),
        )
    )


def roll_up_turnover(
    cells: DataFrame, sets: dict[str, list[str]] | None = None, fill_flows: bool = True
) -> DataFrame:
    """Stock and flows of every breakdown.

    A cell without jobs has no stock (NULL). Flows are NULL where neither kind
    occurs; a single absent kind is 0 with ``fill_flows`` (fixed domain) and
    NULL without (mobile domain).
    """
    ent, sal = F.col("pt_ent_12"), F.col("pt_sal_12")
    flows = {"pt": F.nullif("pt", F.lit(0))}
    if fill_flows:
        some = ent + sal > 0
        flows |= {"pt_ent_12": F.when(some, ent), "pt_sal_12": F.when(some, sal)}
    else:
        flows |= {"pt_ent_12": F.nullif(ent, F.lit(0)), "pt_sal_12": F.nullif(sal, F.lit(0))}
    rolled = roll_up(cells, sets or S.BREAKDOWNS, ["pt", "pt_ent_12", "pt_sal_12"])
    return rolled.withColumns(flows)


def roll_up_fixed(cells: DataFrame, sets: dict[str, list[str]] | None = None) -> DataFrame:
    return roll_up(cells, sets or S.BREAKDOWNS, ["pt_ent_12", "pt_sal_12"])


def roll_up_mobile(cells: DataFrame, sets: dict[str, list[str]] | None = None) -> DataFrame:
    return roll_up(cells, sets or S.BREAKDOWNS, ["n"], always=["pidx", "tipo_flujo"])
