"""The monthly production chain: raw contributions to published indicators.

Stages are tables, those of jobs by month, which also cut the lineage: a lost
executor costs the tasks of one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laborlens import schema as S
from laborlens.functions import periods as P
from laborlens.operators import clean, enrich, firm_size, flows, impute, indicators, stocks
from laborlens.plans.session import tune
from laborlens.sources import lookups, tables


def turnover_tables(
    enriched: DataFrame, periods: DataFrame | None = None, mobile: bool = False
) -> DataFrame:
    """Indicators of all breakdowns from an enriched panel, in long form."""
    jobs = tables.read_jobs(enriched, S.CLASSES, unique_key=True)
    cells = flows.turnover_cells(jobs, periods=periods)
    return indicators.indicators_of(flows.roll_up_turnover(cells, fill_flows=not mobile))


def canonical_ids(df: DataFrame) -> DataFrame:
    """Library column names and long ids, whatever the source's."""
    return S.canonical(df).withColumns({c: F.col(c).cast("long") for c in S.JOB})


def require_lookups(
    persons: DataFrame, firm_master: DataFrame, public_sector: DataFrame, nationality_mode: DataFrame, region_donor: DataFrame
) -> None:
    for table, key in (
        (persons, "person_id"), (firm_master, "firm_id"), (public_sector, "firm_id"),
        (nationality_mode, "worker_id"), (region_donor, "firm_id"),
    ):
        lookups.require_unique(table, [key])


def month_table(spark: SparkSession, months: list[int]) -> DataFrame:
    """A list of month indexes as a table: one row a calendar month."""
    return spark.createDataFrame([(m // 12, m % 12 + 1, m) for m in months], "anno int, mes int, pidx int")


def store_indicators(spark: SparkSession, root: str, mobile: bool = False) -> DataFrame:
    """Indicators of all breakdowns from the stored cells, without a look at the panel."""
    cells = tables.open_table(spark, f"{root}/cells")
    long = indicators.indicators_of(flows.roll_up_turnover(cells, fill_flows=not mobile))
    tables.write_table(long, f"{root}/indicators")
    return tables.open_table(spark, f"{root}/indicators", schema=long.schema)


def run_month_chain(
    spark: SparkSession,
    root: str,
    raw: DataFrame,
    exclusions: DataFrame,
    persons: DataFrame,
    firm_master: DataFrame,
    public_sector: DataFrame,
    nationality_mode: DataFrame,
    region_donor: DataFrame,
    caps: DataFrame | None = None,
    desde: tuple[int, int] = S.START_PERIOD,
    missing_cap: str = "null",
    mobile: bool = False,
) -> DataFrame:
    """All stages, each written below ``root`` and read back by the next.

    Raw rows and exclusions may have the administrative column names and ids of
    any numeric type. A run replaces what an earlier one left below ``root``.
    Stored are preprocessed, imputed, headcount, static_size, enriched, stocks,
    flows_fixed, flows_mobile, cells (stock and fixed flows) and the indicators of
    the fixed or mobile domain. All but static_size and the indicators are stored
    by month, so that ``incremental.update_months`` can replace some of them.
    Returns the indicators. Lookups must have unique keys, caps unique months.
    """
    tune(spark)
    raw, exclusions = canonical_ids(raw), canonical_ids(exclusions)
    require_lookups(persons, firm_master, public_sector, nationality_mode, region_donor)
    caps = lookups.pay_caps(spark) if caps is None else caps

    def stored(df: DataFrame, name: str, by: tuple[str, ...] = ("anno", "mes")) -> DataFrame:
        if by:
            tables.replace_periods(df, f"{root}/{name}", by)
        else:
            tables.write_table(df, f"{root}/{name}")
        return tables.open_table(spark, f"{root}/{name}", schema=df.schema)

    jobs = stored(clean.preprocess(raw, persons, exclusions, desde), "preprocessed")
    panel = stored(impute.cap_and_impute(jobs, caps, missing_cap), "imputed")
    heads = stored(firm_size.headcount(panel, unique_key=True), "headcount", ("pidx",))
    sized = firm_size.with_moving_size(panel, firm_size.moving_size(heads))
    static = stored(firm_size.static_size(heads), "static_size", ())
    enriched = enrich.enrich(
        sized,
        lookups.persons_lookup(persons),
        lookups.firm_master_lookup(firm_master),
        lookups.public_sector_lookup(public_sector),
        lookups.static_size_lookup(static),
        lookups.nationality_mode_lookup(nationality_mode),
        lookups.region_donor_lookup(region_donor),
    )
    enriched = stored(enriched, "enriched")
    periods = P.available_periods(enriched, None)
    jobs = tables.read_jobs(enriched, S.CLASSES, unique_key=True)
    stored(stocks.stock_cells(jobs), "stocks", ("pidx",))
    stored(flows.flows_fixed(jobs, periods=periods), "flows_fixed", ("pidx",))
    stored(flows.flows_mobile(jobs, periods=periods), "flows_mobile", ("pidx",))
    stored(flows.turnover_cells(jobs, periods=periods), "cells", ("pidx",))
    return store_indicators(spark, root, mobile)
