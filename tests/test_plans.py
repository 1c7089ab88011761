"""The shape of the physical plans: what moves, what is broadcast, what splits."""

import re

import pytest
from pyspark.sql import functions as F

from catalog import QUERIES
from catalog import q_composites as Q
from catalog import roles
from laborlens.operators import clean, enrich, flows, public_jobs
from laborlens.sources import tables



def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_products_and_no_python(spark, sf, name):
    text = plan(QUERIES[name](spark, sf))
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|Python|Pandas", text)


@pytest.mark.parametrize("name", [
    "P04_columns_by_pattern", "P05_to_long", "P07_to_wide", "P08_append_rotation_change", "J15_stock_and_flows", "J16_shifted_total",
    "J20_breakdown_and_total", "W06_rates", "W07_rotation_incidence_change", "W10_public_variations", "W11_public_incidences",
    "O01_order_by_period", "F11_bulletin_filter", "D08_indicators_fixed", "D08b_incidence", "D14_wage_index", "D17_bulletin_tables",
    "D18_group_summary", "D19_latest_total_and_leader",
])
def test_two_passes_at_most(spark, sf, name):
    """All breakdowns, and the largest table read twice at most; cells are never gathered by month alone."""
    text = plan(QUERIES[name](spark, sf))
    assert len(re.findall(r"FileScan parquet[^\n]*lineitem", text)) <= 2
    if name == "D08_indicators_fixed":
        assert not re.search(r"hashpartitioning\(pidx#\d+, \d+\)", text)


def stored_jobs(spark, sf):
    """Jobs as they lie in storage, so that plans start at a scan."""
    return tables.stage(Q.jobs(spark, sf)), tables.stage(roles.periods(spark, sf))


def test_flows_shuffle_the_panel_once(spark, sf):
    jobs, periods = stored_jobs(spark, sf)
    for df in (flows.flows_fixed(jobs, periods=periods), flows.turnover_cells(jobs, periods=periods),
               flows.flows_mobile(jobs, periods=periods)):
        text = plan(df)
        by_job = re.findall(r"Exchange hashpartitioning\(worker_id#\d+L, firm_id#\d+L, \d+\)", text)
        assert len(by_job) == 1
        assert "SortMergeJoin" not in text


def test_ranks_are_limited_before_the_shuffle(spark, sf):
    for df in (
        public_jobs.main_jobs(roles.panel(spark, sf)),
        tables.keep_first(roles.raw(spark, sf), ["worker_id", "firm_id", "anno", "mes"]),
    ):
        assert re.search(r"WindowGroupLimit .*Partial", plan(df))


def test_consolidation_and_exclusion_share_a_shuffle(spark, sf):
    raw = tables.stage(roles.raw(spark, sf))
    excluded = tables.stage(roles.exclusions(spark, sf))
    key = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(key, "-1")
    try:
        text = plan(clean.preprocess(raw, roles.persons(spark, sf), excluded, (1996, 11)))
    finally:
        spark.conf.unset(key)
    by_period = re.findall(r"Exchange hashpartitioning\(worker_id#\d+L, firm_id#\d+L, anno#\d+, mes#\d+, \d+\)", text)
    assert len(by_period) == 2  # one for each side of the anti join


def test_bucketed_panel_needs_no_shuffle_for_flows(spark, sf):
    jobs, periods = stored_jobs(spark, sf)
    tables.write_bucketed(jobs, "jobs_by_job", 8)
    state = flows.year_apart(spark.table("jobs_by_job"), ["sexo"], periods)
    assert not re.search(r"Exchange hashpartitioning\(worker_id", plan(state))
    spark.sql("DROP TABLE jobs_by_job")


def test_scan_reads_needed_columns_and_pushes_filters(spark, sf):
    text = plan(roles.raw(spark, sf).filter("tipo_trabajador = 1").groupBy("anno").count())
    scan = re.search(r"FileScan parquet \[([^\]]*)\].*lineitem", text).group(1)
    assert {re.sub(r"#.*", "", c) for c in scan.split(",")} == {
        "l_orderkey", "l_suppkey", "l_shipdate", "l_returnflag"
    }


def test_hot_worker_is_split(spark):
    """One worker and one firm hold most rows: both enrichment joins are split at run time."""
    n = 200_000
    i = F.col("id")

    def hot(key):
        return F.when(i % 10 < 6, F.lit(7)).otherwise(key)

    def pad(name):
        return F.sha2(i.cast("string"), 256).alias(name)

    rows = spark.range(n)
    panel = rows.select(
        hot(i).alias("worker_id"), hot(i).alias("firm_id"), F.lit(2020).alias("anno"),
        F.lit(1).alias("mes"), pad("pad"),
    )
    workers = rows.select(
        i.alias("person_id"), F.lit(1).alias("sexo"), F.lit(1).alias("nacionalidad"),
        F.lit("1980-01-01").cast("date").alias("fecha_nac"), F.lit(None).cast("date").alias("fecha_def_cor_rc"),
        F.lit("13").alias("codigo_region"), pad("codigo_comuna"),
    )
    firms = rows.select(i.alias("firm_id"), pad("seccion"))
    public = rows.filter("id % 2 = 0").select(i.alias("firm_id"), F.lit(1).alias("ep"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        joined = enrich.enrich(
            panel, workers, firms, public,
            rows.select(i.alias("firm_id"), F.lit("micro").alias("tamano")),
            rows.select(i.alias("worker_id"), F.lit(1).alias("nc_moda")),
            rows.select(i.alias("firm_id"), F.lit(5).alias("region_trabajador")),
        )
        done = joined.select("worker_id", "seccion", "codigo_comuna", "pad")
        assert len(done.collect()) == n
        assert plan(done).count("skew=true") >= 2
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_enrichment_joins_the_panel_twice(spark, sf):
    panel = Q.gap_input(spark, sf)
    text = enrich.enrich(
        panel,
        roles.persons(spark, sf), roles.firm_master(spark, sf),
        roles.public_sector(spark, sf).withColumns({"firm_id": F.col("firm_id").cast("long"), "ep": F.lit(1)}),
        panel.groupBy("firm_id").agg(F.lit("micro").alias("tamano")),
        roles.nationality_mode(spark, sf).withColumnRenamed("moda", "nc_moda"),
        roles.region_donor(spark, sf),
    )._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall("Join LeftOuter", text)) == 2
