"""The monthly chain for some months: new, corrected or withdrawn ones.

A run reads the raw rows of those months and, of each stored stage, the months that what it changes rests on: one on either
side for gaps, eleven back for the moving size, twelve back for flows. It replaces exactly the months that can change: the
neighbours of a changed month (their gaps), the eleven after these (moving size), and the twelfth after (exits and entries).
The tables are then those that :func:`laborlens.plans.monthly.run_month_chain` makes from all raw rows.

Months are few (a list of the calendar), so they are worked out on the driver and become filters on partition columns.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laborlens import schema as S
from laborlens.functions import periods as P
from laborlens.operators import clean, enrich, firm_size, flows, impute, stocks
from laborlens.plans import monthly
from laborlens.plans.session import tune
from laborlens.sources import lookups, tables


def of_months(df: DataFrame, months: Iterable[int]) -> DataFrame:
    """Rows of some month indexes; a filter on partition columns alone where the table is stored by month."""
    index = F.col("anno") * 12 + F.col("mes") - 1 if "anno" in df.columns else F.col("pidx")
    return df.filter(index.isin(sorted(months)))


def stored_months(spark: SparkSession, path: str) -> list[int]:
    """Month indexes of a stage, from its folders."""
    rows = tables.month_files(spark, path).select("pidx").distinct().collect()
    return sorted(r.pidx for r in rows)


def steps_from(order: list[int], months: Iterable[int], steps: Iterable[int]) -> set[int]:
    """Months that stand some positions after (or before, if negative) others in a list of months."""
    at = {m: i for i, m in enumerate(order)}
    found = {at[m] + k for m in months if m in at for k in steps}
    return {order[i] for i in found if 0 <= i < len(order)}


def with_neighbours(before: list[int], after: list[int], months: Iterable[int]) -> set[int]:
    """``months`` and what stands next to them in the old or in the new list of months, as far as it is in the new one."""
    months = set(months)
    near = steps_from(before, months, (-1, 1)) | steps_from(after, months, (-1, 1))
    return (months | near) & set(after)


def moving_months(after: list[int], months: Iterable[int]) -> set[int]:
    """Months whose moving size a changed headcount reaches: it and the eleven calendar months after it."""
    reached = {m + k for m in months for k in range(12)}
    return reached & set(after)


def flow_months(before: list[int], after: list[int], months: Iterable[int]) -> set[int]:
    """Months whose flows change with the jobs of ``months``: their own and those a year (twelve positions) on; also all whose
    year before is another month now, as a month came or went in between."""
    own = set(months) & set(after)
    out = own | steps_from(after, own, (12,))
    back = dict(zip(after[12:], after, strict=False))
    old = dict(zip(before[12:], before, strict=False))
    return out | {m for m in after if back.get(m) != old.get(m)}


def changed_bands(old: DataFrame, new: DataFrame, heads: DataFrame) -> set[int]:
    """Months in which firms have jobs whose static size band is another one now."""
    a, b = old.select("firm_id", F.col("tamano").alias("old")), new.select("firm_id", F.col("tamano").alias("new"))
    moved = a.join(b, "firm_id", "full").filter(~F.col("old").eqNullSafe(F.col("new"))).select("firm_id")
    return {r.pidx for r in heads.join(moved, "firm_id", "left_semi").select("pidx").distinct().collect()}


def update_months(
    spark: SparkSession,
    root: str,
    months: Iterable[tuple[int, int]],
    raw: DataFrame,
    exclusions: DataFrame,
    persons: DataFrame,
    firm_master: DataFrame,
    public_sector: DataFrame,
    nationality_mode: DataFrame,
    region_donor: DataFrame,
    caps: DataFrame | None = None,
    missing_cap: str = "null",
    mobile: bool = False,
) -> DataFrame:
    """Bring the tables below ``root`` to the state of ``raw`` in ``months``, (year, month) pairs; returns the indicators.

    ``raw`` may hold other months too, which are not read; a month without rows in it is withdrawn. Lookups and caps are those
    of the earlier run: rows of untouched months keep what they were given then. Firms whose static size band moves have their
    other months rewritten as well, since the band decides on eligibility in all of them. Raw rows and exclusions may have the
    administrative column names and ids of any numeric type. A run that broke off is repeated with the same months.
    """
    tune(spark)
    raw, exclusions = monthly.canonical_ids(raw), monthly.canonical_ids(exclusions)
    monthly.require_lookups(persons, firm_master, public_sector, nationality_mode, region_donor)
    caps = lookups.pay_caps(spark) if caps is None else caps
    asked = {12 * int(a) + int(m) - 1 for a, m in months}

    def stored(name: str) -> DataFrame:
        return tables.open_table(spark, f"{root}/{name}")

    def replace(df: DataFrame, name: str, which: set[int], by: tuple[str, ...] = ("anno", "mes")) -> None:
        tables.replace_some(of_months(df, which), f"{root}/{name}", which, by)

    before = stored_months(spark, f"{root}/preprocessed")
    fresh = clean.preprocess(of_months(raw, asked), persons, exclusions, (0, 1))
    replace(fresh, "preprocessed", asked)
    after = stored_months(spark, f"{root}/preprocessed")
    periods = monthly.month_table(spark, after)

    # Gaps: a month and its neighbours, each with its own neighbours to look at.
    gaps = with_neighbours(before, after, asked)
    seen = of_months(stored("preprocessed"), gaps | steps_from(after, gaps, (-1, 1)))
    gone = asked - set(after)
    replace(impute.impute_gaps(clean.cap_pay(P.with_pidx(seen), caps, missing_cap), periods), "imputed", gaps | gone)
    heads = firm_size.headcount(of_months(stored("imputed"), gaps), unique_key=True)
    replace(heads, "headcount", gaps | gone, ("pidx",))

    # Sizes: firm-month counts are small beside jobs; the static band needs all of them.
    heads = stored("headcount")
    static = tables.stage(firm_size.static_size(heads))
    sizes = moving_months(after, gaps | gone) | gaps | (changed_bands(stored("static_size"), static, heads) & set(after))
    tables.write_table(static, f"{root}/static_size")
    moving = firm_size.moving_size(of_months(heads, {m - k for m in sizes for k in range(12)}))
    sized = firm_size.with_moving_size(of_months(stored("imputed"), sizes), moving)
    full = enrich.enrich(
        sized,
        lookups.persons_lookup(persons),
        lookups.firm_master_lookup(firm_master),
        lookups.public_sector_lookup(public_sector),
        lookups.static_size_lookup(static),
        lookups.nationality_mode_lookup(nationality_mode),
        lookups.region_donor_lookup(region_donor),
    )
    replace(full, "enriched", sizes | gone)

    # Flows: a month and the one a year before it.
    moved = flow_months(before, after, sizes)
    jobs = tables.read_jobs(of_months(stored("enriched"), moved | steps_from(after, moved, (-12,))), S.CLASSES, unique_key=True)
    replace(stocks.stock_cells(of_months(jobs, sizes)), "stocks", sizes | gone, ("pidx",))
    for name, cells in (
        ("flows_fixed", flows.flows_fixed(jobs, periods=periods)),
        ("flows_mobile", flows.flows_mobile(jobs, periods=periods)),
        ("cells", flows.turnover_cells(jobs, periods=periods)),
    ):
        replace(cells, name, moved | gone, ("pidx",))
    return monthly.store_indicators(spark, root, mobile)
