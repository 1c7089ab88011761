"""Job stocks: finest cells first, then all breakdowns in one pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laborlens import schema as S
from laborlens.functions import periods as P


def stock_cells(jobs: DataFrame, classes: list[str] | None = None) -> DataFrame:
    """Jobs per month and full set of classes."""
    classes = S.CLASSES if classes is None else classes
    return P.with_pidx(jobs).groupBy("pidx", *classes).agg(F.count("*").alias("pt"))


def roll_up(
    cells: DataFrame,
    sets: dict[str, list[str]],
    measures: list[str],
    always: list[str] | None = None,
) -> DataFrame:
    """Sums of ``measures`` for every named set of classes.

    ``tabla`` names the set of each row; it comes from ``grouping_id``, never
    from NULL classes, which are categories of their own. Expand works on cells,
    not on jobs.
    """
    always = ["pidx"] if always is None else always
    classes = [c for c in cells.columns if any(c in s for s in sets.values())]
    keys = always + classes
    grouped = cells.groupingSets(
        [[F.col(c) for c in always + cols] for cols in sets.values()],
        *[F.col(c) for c in keys],
    )
    gid = F.grouping_id().alias("_gid")
    sums = grouped.agg(*[F.sum(m).alias(m) for m in measures], gid)
    return sums.withColumn("tabla", _name_of(sets, keys)).select(
        "tabla", *always, *classes, *measures
    )


def _name_of(sets: dict[str, list[str]], keys: list[str]) -> Column:
    """Name of a grouping set from its id (a bit is 1 where the key is absent)."""
    optional = _optional(sets)
    whens = []
    for name, cols in sets.items():
        absent = [k in optional and k not in cols for k in keys]
        bits = sum(1 << (len(keys) - 1 - i) for i, out in enumerate(absent) if out)
        whens.append(f"WHEN {bits} THEN '{name}'")
    return F.expr(f"CASE _gid {' '.join(whens)} END")


def _optional(sets: dict[str, list[str]]) -> set[str]:
    return {c for cols in sets.values() for c in cols}


def stocks(jobs: DataFrame, sets: dict[str, list[str]] | None = None) -> DataFrame:
    """Job stocks of all months and breakdowns, as one long table."""
    sets = S.BREAKDOWNS if sets is None else sets
    classes = [c for c in S.CLASSES if any(c in s for s in sets.values())]
    return roll_up(stock_cells(jobs, classes), sets, ["pt"])
