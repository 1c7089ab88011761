"""A run over some months leaves the tables that a run over all months makes, and touches no other month."""

import collections
import os

import pytest
from pyspark.sql import functions as F

from catalog import roles
from laborlens.plans import incremental, monthly
from laborlens.sources import tables

STAGES = ["preprocessed", "imputed", "headcount", "static_size", "enriched", "stocks", "flows_fixed", "flows_mobile", "cells", "indicators"]


@pytest.fixture(scope="module")
def inputs(spark, sf):
    """Raw rows of fifteen months, as a table, and the lookups."""
    raw = roles.raw(spark, sf).filter(F.expr("anno = 1996 or anno = 1997 and mes <= 3"))
    return tables.stage(raw), {
        "exclusions": roles.exclusions(spark, sf), "persons": roles.persons(spark, sf), "firm_master": roles.firm_master(spark, sf),
        "public_sector": roles.public_sector(spark, sf), "nationality_mode": roles.nationality_mode(spark, sf),
        "region_donor": roles.region_donor(spark, sf),
        "caps": roles.periods(spark, sf).select("anno", "mes", F.lit(60000).alias("tope")),
    }


def content(spark, root):
    out = {}
    for name in STAGES:
        df = tables.open_table(spark, f"{root}/{name}")
        rows = df.select(*sorted(df.columns)).collect()
        out[name] = collections.Counter(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows)
    return out


def files(root):
    found = collections.defaultdict(set)
    for folder, _, names in os.walk(root):
        found[folder[len(root) + 1 :]] |= {n for n in names if n.endswith(".parquet")}
    return {k: v for k, v in found.items() if v}


def full(spark, root, raw, lookups):
    monthly.run_month_chain(spark, root, raw=raw, desde=(1996, 1), **lookups)
    return content(spark, root)


def test_months_come_go_and_change(spark, inputs, tmp_path):
    raw, lookups = inputs
    root = str(tmp_path / "some")
    last = F.expr("anno = 1997 and mes = 3")
    full(spark, root, raw.filter(~last), lookups)

    # A new month at the end: only what can change is written.
    before = files(root)
    incremental.update_months(spark, root, [(1997, 3)], raw=raw, **lookups)
    after = files(root)
    want = full(spark, str(tmp_path / "all"), raw, lookups)
    assert content(spark, root) == want and want["indicators"] and want["flows_mobile"]
    touched = {k for k in after if after[k] != before.get(k)}
    months = {k.split("/", 1)[1] for k in touched if k.startswith("imputed")}
    assert months == {"anno=1997/mes=2", "anno=1997/mes=3"}
    assert {k for k in touched if k.startswith("preprocessed")} == {"preprocessed/anno=1997/mes=3"}

    # A month in the middle is withdrawn, and comes back with other pay and fewer rows.
    middle = F.expr("anno = 1996 and mes = 9")
    incremental.update_months(spark, root, [(1996, 9)], raw=raw.filter(~middle), **lookups)
    assert content(spark, root) == full(spark, str(tmp_path / "without"), raw.filter(~middle), lookups)
    other = raw.filter(~middle | (F.col("worker_id") % 3 > 0)).withColumn("monto", F.when(middle, F.col("monto") + 7).otherwise(F.col("monto")))
    incremental.update_months(spark, root, [(1996, 9)], raw=other, **lookups)
    assert content(spark, root) == full(spark, str(tmp_path / "changed"), other, lookups)


def test_only_months_needed_are_read(spark, inputs, tmp_path):
    path = str(tmp_path / "p")
    tables.write_periods(inputs[0].select("anno", "mes", "worker_id"), path)
    some = incremental.of_months(tables.open_table(spark, path), {1996 * 12 + 4, 1996 * 12 + 5})
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "Filter (" not in plan.split("PushedFilters")[0].split("FileScan")[0]
    names = some.select(F.input_file_name().alias("f")).distinct().collect()
    assert {r.f.split("/p/")[1].rsplit("/", 1)[0] for r in names} == {"anno=1996/mes=5", "anno=1996/mes=6"}


def test_month_lists():
    months = list(range(100, 130))
    assert incremental.with_neighbours(months[:-1], months, {129}) == {128, 129}
    assert incremental.with_neighbours(months, [m for m in months if m != 110], {110}) == {109, 111}
    assert incremental.moving_months(months, {125}) == {125, 126, 127, 128, 129}
    assert incremental.flow_months(months, months, {110}) == {110, 122}
    without = [m for m in months if m != 110]
    assert incremental.flow_months(months, without, set()) == set(range(112, 123))
