"""Identities that must hold on the driver tables."""

from pyspark.sql import functions as F

from catalog import q_composites as Q
from catalog import roles
from laborlens import schema as S
from laborlens.operators import firm_size, flows, impute, public_jobs, stocks


def test_stock_change_is_entries_minus_exits(spark, sf):
    rows = Q.turnover(spark, sf).filter("tabla = 'total'").select("pidx", "pt", "pt_ent_12", "pt_sal_12")
    by_month = {r.pidx: r for r in rows.collect()}
    checked = 0
    for p, r in by_month.items():
        if p - 12 in by_month and r.pt_ent_12 is not None:
            assert r.pt == by_month[p - 12].pt + r.pt_ent_12 - r.pt_sal_12
            checked += 1
    assert checked > 50


def test_mobile_flows_balance_in_every_class(spark, sf):
    """With reclassification over every class, each class balances."""
    classes = ["sexo", "tramo_edad"]
    jobs = Q.jobs(spark, sf, classes)
    cells = {
        (r.pidx, r.sexo, r.tramo_edad): r.pt for r in stocks.stock_cells(jobs, classes).collect()
    }
    sign = {"entrada": 1, "reclasif_entrada": 1, "salida": -1, "reclasif_salida": -1}
    net: dict = {}
    months = sorted({k[0] for k in cells})
    for r in flows.flows_mobile(jobs, classes, classes, roles.periods(spark, sf)).collect():
        k = (r.pidx, r.sexo, r.tramo_edad)
        net[k] = net.get(k, 0) + sign[r.tipo_flujo] * r.n
    assert months == list(range(months[0], months[-1] + 1))
    for (p, *c) in {*cells, *net}:
        if p - 12 >= months[0]:
            change = cells.get((p, *c), 0) - cells.get((p - 12, *c), 0)
            assert change == net.get((p, *c), 0)


def test_breakdowns_add_up_to_the_total(spark, sf):
    sums = Q.turnover(spark, sf).groupBy("tabla").agg(
        *[F.sum(c).alias(c) for c in ("pt", "pt_ent_12", "pt_sal_12")]
    ).collect()
    assert len(sums) == len(S.BREAKDOWNS)
    assert len({(r.pt, r.pt_ent_12, r.pt_sal_12) for r in sums}) == 1


def test_imputed_rows_have_observed_neighbours(spark, sf):
    panel = Q.gap_input(spark, sf)
    filled = impute.impute_gaps(panel, roles.periods(spark, sf))
    keys = {(r.worker_id, r.firm_id, r.pidx) for r in panel.collect()}
    rows = filled.filter("is_imputed").collect()
    assert rows and filled.count() == len(keys) + len(rows)
    for r in rows:
        assert (r.worker_id, r.firm_id, r.pidx) not in keys
        assert {(r.worker_id, r.firm_id, r.pidx + d) for d in (-1, 1)} <= keys


def test_moving_window_uses_at_most_a_year(spark, sf):
    n = firm_size.moving_size(Q.heads(spark, sf)).agg(
        F.min("n_meses_utilizados").alias("a"), F.max("n_meses_utilizados").alias("b")
    ).first()
    assert 1 <= n.a <= n.b <= 12


def test_incidences_add_up_to_the_growth_of_the_total(spark, sf):
    tables = Q.public_tables(spark, sf)
    total = public_jobs.variations(
        tables.filter("tabla = 'total'").select("pidx", "pt").withColumn("u", F.lit(0)), ["u"]
    )
    parts = tables.filter("tabla = 'sx'").select("pidx", "sexo", "pt")
    inc = public_jobs.incidences(public_jobs.variations(parts, ["sexo"]), tables.filter("tabla = 'total'"), ["sexo"])
    complete = inc.groupBy("pidx").agg(
        F.sum("inc_var_12").alias("s"), F.count("inc_var_12").alias("k")
    ).filter("k = 2")
    # Rows stand for months only where every month is present in both series.
    joined = complete.join(total, "pidx").filter("var12_pt is not null")
    worst = joined.agg(F.max(F.abs(F.col("s") - F.col("var12_pt")))).first()[0]
    months = parts.select("pidx").distinct().count()
    if parts.count() == 2 * months:
        assert worst < 1e-9
