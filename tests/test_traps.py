"""Hand-made rows for every semantic trap."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from laborlens import schema as S
from laborlens.functions import periods as P
from laborlens.functions import scalars as X
from laborlens.operators import (
    audit,
    clean,
    firm_size,
    flows,
    grouped_stats,
    impute,
    indicators,
    persons,
    public_jobs,
    reconcile,
    reports,
    reshape,
    stocks,
    tax_credit,
    wage_index,
)
from laborlens.sources import lookups, tables


def values(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


def test_date_placeholders(spark):
    df = spark.createDataFrame([("--",), ("",), (" ",), ("1980-05-01",), (None,)], "d string")
    got = [v for (v,) in values(df, X.parse_date("d"))]
    assert got == [None, None, None, dt.date(1980, 5, 1), None]


def test_age_limits(spark):
    period = dt.date(2020, 1, 1)

    def born(months):
        y, m = divmod(period.year * 12 + period.month - 1 - months, 12)
        return dt.date(y, m + 1, 28)

    rows = [(m, 2020, 1, None if m is None else born(m)) for m in (179, 180, 1079, 1080, None)]
    df = spark.createDataFrame(rows, "m int, anno int, mes int, fecha_nac date")
    assert [v for (v,) in values(clean.of_age(df), "m")] == [180, 1079, None]


def test_death(spark):
    rows = [(1, dt.date(2020, 3, 31)), (2, dt.date(2020, 2, 1)), (3, None)]
    df = spark.createDataFrame(rows, "i int, fecha_def_cor_rc date").withColumns(
        {"anno": F.lit(2020), "mes": F.lit(3)}
    )
    assert [v for (v,) in values(clean.alive(df), "i")] == [1, 3]


def contributions(spark, rows):
    full = [(1, 1, 2020, 1, 1, *r) for r in rows]
    return spark.createDataFrame(full, S.CONTRIBUTIONS)


def test_consolidation(spark):
    df = contributions(
        spark, [(None, 1, 100.0, 20, "a"), (1, 2, 50.0, 15, "b"), (2, 1, 70.0, 5, "c")]
    )
    assert values(clean.consolidate_jobs(df), "monto", "dias") == [(150.0, 30)]


def test_exact_repeat_counts_once_whatever_the_declaration(spark):
    df = contributions(spark, [(1, 1, 100.0, 10, "a"), (1, 2, 100.0, 10, "a")])
    assert values(clean.consolidate_jobs(df), "monto", "dias") == [(100.0, 10)]


def test_all_null_pay_stays_null(spark):
    df = contributions(spark, [(1, 1, None, None, "a")])
    assert values(clean.consolidate_jobs(df), "monto", "dias") == [(None, None)]


def test_preprocess_filters_and_excludes(spark):
    rows = [
        (w, 1, y, m, t, 1, 1, 100.0, 10, "a")
        for w, y, m, t in [(1, 2016, 11, 1), (1, 2016, 10, 1), (2, 2017, 1, 1), (3, 2017, 1, 2), (4, 2017, 1, 1), (5, 2017, 1, 1)]
    ]
    raw = spark.createDataFrame(rows, S.CONTRIBUTIONS)
    people = spark.createDataFrame(
        [(1, "1980-01-01", "--"), (2, "2015-01-01", None), (4, " ", "2016-12-31")],
        "person_id long, fecha_nac string, fecha_def_cor_rc string",
    )
    excluded = spark.createDataFrame([(5, 1, 2017, 1, 6)], "worker_id long, firm_id long, anno int, mes int, pred int")
    out = clean.preprocess(raw, people, excluded)
    assert values(out, "worker_id", "anno", "mes") == [(1, 2016, 11)]


def test_cap(spark):
    df = spark.createDataFrame(
        [(2025, 12, 9e9), (2025, 12, 5.0), (2026, 1, 7.0)], "anno int, mes int, monto double"
    )
    caps = lookups.pay_caps(spark)
    cap = float(X.cap_pesos(39485.65, 87.8))
    parity = values(clean.cap_pay(df, caps).orderBy("anno", F.desc("monto")), "monto")
    assert parity == [(cap,), (5.0,), (None,)]
    kept = values(clean.cap_pay(df, caps, missing_cap="keep").orderBy("anno", F.desc("monto")), "monto")
    assert kept == [(cap,), (5.0,), (7.0,)]
    assert caps.count() == 120


def panel_rows(spark, rows):
    df = spark.createDataFrame(rows, "worker_id long, firm_id long, pidx int, monto double, dias int")
    return df.withColumns({"anno": P.anno_of("pidx"), "mes": P.mes_of("pidx")})


@pytest.mark.parametrize(
    "days, filled", [((1, 2), 2), ((2, 3), 2), ((3, 4), 4), ((0, 7), 7), ((None, 7), 7)]
)
def test_gap_days_round_half_even(spark, days, filled):
    df = panel_rows(spark, [(1, 1, 24000, 1.0, days[0]), (1, 1, 24002, 1.0, days[1]), (9, 9, 24001, 1.0, 1)])
    out = impute.impute_gaps(df).filter("is_imputed")
    assert values(out, "pidx", "dias") == [(24001, filled)]


@pytest.mark.parametrize("pay, filled", [((100.0, 200.0), 150.0), ((0.0, 200.0), 200.0), ((None, None), 0.0)])
def test_gap_pay(spark, pay, filled):
    df = panel_rows(spark, [(1, 1, 24000, pay[0], 1), (1, 1, 24002, pay[1], 1), (9, 9, 24001, 1.0, 1)])
    assert values(impute.impute_gaps(df).filter("is_imputed"), "monto") == [(filled,)]


def test_two_month_gap_is_left(spark):
    df = panel_rows(spark, [(1, 1, 1, 1.0, 1), (1, 1, 4, 1.0, 1), (9, 9, 2, 1.0, 1), (9, 9, 3, 1.0, 1)])
    assert impute.impute_gaps(df).filter("is_imputed").count() == 0


def test_gap_neighbours_are_available_periods(spark):
    rows = [(1, 1, 10, 1.0, 1), (1, 1, 13, 1.0, 1), (9, 9, 11, 1.0, 1)]
    by_position = impute.impute_gaps(panel_rows(spark, rows)).filter("is_imputed")
    assert values(by_position, "worker_id", "pidx") == [(1, 11)]
    assert impute.impute_gaps(panel_rows(spark, rows), calendar=True).filter("is_imputed").count() == 0


def test_imputed_row_carries_worker_type(spark):
    df = panel_rows(spark, [(1, 1, 24000, 1.0, 1), (1, 1, 24002, 1.0, 1), (9, 9, 24001, 1.0, 1)])
    out = impute.impute_gaps(df.withColumn("tipo_trabajador", F.lit(1)))
    assert values(out.filter("is_imputed"), "tipo_trabajador", "anno", "mes") == [(1, 2000, 2)]


def test_static_bands(spark):
    df = spark.createDataFrame([(1.0,), (1.01,), (5.0,), (50.0,), (200.0,)], "m double")
    got = [v for (v,) in values(df, X.static_size_band("m"))]
    assert got == ["unipersonal", "micro", "pequena", "mediana", "grande"]


def test_moving_size_restarts_after_a_break(spark):
    heads = spark.createDataFrame(
        [(1, 0, 10), (1, 11, 20), (1, 12, 30), (1, 30, 40)], "firm_id long, pidx int, n_trabajadores long"
    )
    out = firm_size.moving_size(heads).orderBy("pidx")
    assert values(out, "media_movil_12m", "n_meses_utilizados") == [(10.0, 1), (15.0, 2), (25.0, 2), (40.0, 1)]
    assert [g for (g,) in values(firm_size.segments(heads).orderBy("pidx"), "grupo")] == [1, 1, 1, 2]


def test_headcount_of_repeated_rows(spark):
    df = panel_rows(spark, [(1, 1, 5, 1.0, 1), (1, 1, 5, 2.0, 1), (2, 1, 5, 1.0, 1)])
    assert values(firm_size.headcount(df), "n_trabajadores") == [(2,)]


def test_age_bands(spark):
    df = spark.createDataFrame([(None,), (179,), (180,), (779,), (780,), (839,), (840,)], "a int")
    assert values(df, X.age_band_7("a"), X.age_band_13("a")) == [
        (None, None), (0, 0), (1, 1), (5, 10), (6, 11), (6, 11), (6, 12),
    ]


def test_code_cast_and_donor(spark):
    df = spark.createDataFrame([("17.0",), ("13",), ("x",), (None,)], "c string").withColumn("d", F.lit(5))
    region = X.code_with_donor("c", "d", S.REGION_UNKNOWN, S.REGION_DONOR_UNKNOWN)
    assert values(df, X.int_code("c"), region) == [(17, 5), (13, 13), (None, 5), (None, 5)]


def test_donor_17_passes_and_99_does_not(spark):
    df = spark.createDataFrame([(17,), (99,), (None,)], "d int").withColumn("c", F.lit("99"))
    region = X.code_with_donor("c", "d", S.REGION_UNKNOWN, S.REGION_DONOR_UNKNOWN)
    assert [v for (v,) in values(df, region)] == [17, None, None]


def test_eligibility(spark):
    df = spark.createDataFrame(
        [(1, None, "A"), (2, "micro", None), (3, "micro", "T"), (4, "unipersonal", "A"), (5, "micro", "B")],
        "i int, tamano string, seccion string",
    )
    assert [v for (v,) in values(df.filter(tables.eligible()), "i")] == [2, 5]


def test_keep_first_is_deterministic(spark):
    df = spark.createDataFrame([(1, None), (1, "b"), (1, "a"), (2, None)], "k int, v string")
    assert sorted(values(tables.keep_first(df, ["k"]), "k", "v")) == [(1, "a"), (2, None)]


def job_rows(spark, rows):
    return spark.createDataFrame(
        rows, "worker_id long, firm_id long, pidx int, region_final int, tamano_empresa_movil string, tramo_edad int"
    )


def months(spark, n):
    return [(0, 0, p, 0, "x", 0) for p in range(n)]


def test_null_class_entries_and_exits_share_a_row(spark):
    rows = months(spark, 13)
    rows += [(w, 1, 12, None, "m", 1) for w in (1, 2, 3)] + [(w, 1, 0, None, "m", 1) for w in (4, 5)]
    out = flows.flows_fixed(job_rows(spark, rows), ["region_final"]).filter("region_final is null")
    assert values(out, "pidx", "pt_ent_12", "pt_sal_12") == [(12, 3, 2)]


def test_absent_side_is_zero_in_fixed_flows(spark):
    rows = months(spark, 13) + [(1, 1, 12, 7, "m", 1)]
    out = flows.flows_fixed(job_rows(spark, rows), ["region_final"]).filter("region_final = 7")
    assert values(out, "pt_ent_12", "pt_sal_12") == [(1, 0)]


def test_reclassification(spark):
    rows = months(spark, 13)
    rows += [(1, 1, 0, 1, "micro", 1), (1, 1, 12, 1, None, 1)]  # unknown size, same age: none
    rows += [(2, 1, 0, 1, "micro", 1), (2, 1, 12, 1, None, 2)]  # unknown size, other age: yes
    rows += [(3, 1, 0, 1, "micro", 1), (3, 1, 12, 1, "pequena", 1)]
    classes = ["region_final", "tamano_empresa_movil", "tramo_edad"]
    out = flows.flows_mobile(job_rows(spark, rows), classes).filter("region_final = 1")
    got = sorted(values(out, "tipo_flujo", "tamano_empresa_movil", "tramo_edad", "n"), key=str)
    assert got == sorted(
        [
            ("reclasif_entrada", None, 2, 1), ("reclasif_entrada", "pequena", 1, 1),
            ("reclasif_salida", "micro", 1, 2),
        ],
        key=str,
    )


def test_flows_count_periods_not_months(spark):
    """A missing month moves the year-ago period by position, not by calendar."""
    rows = [(0, 0, p, 0, "x", 0) for p in range(14) if p != 5] + [(1, 1, 0, 1, "m", 1), (1, 1, 13, 1, "m", 1)]
    by_position = flows.flows_fixed(job_rows(spark, rows), ["region_final"])
    assert by_position.filter("region_final = 1").count() == 0
    by_month = flows.flows_fixed(job_rows(spark, rows), ["region_final"], calendar=True)
    assert values(by_month.filter("region_final = 1"), "pidx", "pt_ent_12", "pt_sal_12") in (
        [(12, 0, 1), (13, 1, 0)], [(13, 1, 0), (12, 0, 1)],
    )


def test_one_pass_cells_equal_separate_stock_and_flows(spark):
    rows = months(spark, 20)
    rows += [(w, w % 3, p, (w * p) % 3 or None, "m" if w % 2 else None, w % 4) for w in range(1, 30) for p in range(20) if (w * 7 + p) % 5]
    jobs = job_rows(spark, rows)
    classes = ["region_final", "tamano_empresa_movil", "tramo_edad"]
    one = flows.turnover_cells(jobs, classes)
    stock = stocks.stock_cells(jobs, classes)
    flow = flows.flows_fixed(jobs, classes)
    both = indicators.join_stock_flows(stock, flow, ["pidx", *classes])
    cols = ["pidx", *classes, "pt", "pt_ent_12", "pt_sal_12"]
    filled = both.na.fill(0, ["pt", "pt_ent_12", "pt_sal_12"])
    assert sorted(values(one, *cols), key=str) == sorted(values(filled, *cols), key=str)


def test_grouping_sets_keep_null_classes_apart_from_totals(spark):
    cells = spark.createDataFrame([(1, None, 2), (1, 5, 3)], "pidx int, sexo int, pt long")
    out = stocks.roll_up(cells, {"total": [], "sx": ["sexo"]}, ["pt"])
    got = sorted(values(out, "tabla", "sexo", "pt"), key=str)
    assert got == sorted([("total", None, 5), ("sx", None, 2), ("sx", 5, 3)], key=str)


def test_zero_denominator_gives_null(spark):
    rows = [(p, 0 if p == 0 else 10, 1, 1) for p in range(13)]
    df = spark.createDataFrame(rows, "pidx int, pt long, pt_ent_12 long, pt_sal_12 long")
    out = indicators.rates(df).filter("pidx = 12")
    assert values(out, "t_ent", "var12_pt", "t_per") == [(None, None, None)]


def test_absent_stock_side_stays_null(spark):
    stock = spark.createDataFrame([(1, None, 5)], "pidx int, sexo int, pt long")
    flow = spark.createDataFrame([(1, None, 1, 2), (1, 3, 1, 0)], "pidx int, sexo int, pt_ent_12 long, pt_sal_12 long")
    out = indicators.join_stock_flows(stock, flow, ["pidx", "sexo"])
    got = sorted(values(out, "sexo", "pt", "pt_ent_12", "pt_sal_12"), key=str)
    assert got == sorted([(None, 5, 1, 2), (3, None, 1, 0)], key=str)


def test_appended_rows_have_dates_and_no_repeats(spark):
    df = spark.createDataFrame([(24000 + p, 0.1 * p) for p in range(13)], "pidx int, inc_rot double")
    long = reshape.to_long(df)
    change = indicators.rotation_incidence_change(long)
    out = indicators.append_rotation_change(long, change)
    assert out.filter("anno is null or mes is null").count() == 0
    assert out.filter("indicador = 'inc_rot'").count() == 13
    again = indicators.append_rotation_change(long, change, keep_duplicate_inc_rot=True)
    assert again.filter("indicador = 'inc_rot'").count() == 26


def test_pivot_keeps_null_and_fill_option(spark):
    df = spark.createDataFrame([(1, "entrada", 4), (1, "reclasif_entrada", 9)], "pidx int, tipo_flujo string, n long")
    assert values(reshape.flows_to_wide(df), "pt_ent_12", "pt_sal_12") == [(4, None)]
    assert values(reshape.flows_to_wide(df, fill=0), "pt_ent_12", "pt_sal_12") == [(4, 0)]


def test_main_job_ties_and_nulls(spark):
    rows = [(1, 5, 100.0, 30), (1, 3, 100.0, 30), (1, 9, None, 30), (2, 4, None, 30), (3, 1, 50.0, 10), (3, 2, 50.0, 20)]
    df = spark.createDataFrame(rows, "worker_id long, firm_id long, monto double, dias int").withColumn("pidx", F.lit(1))
    assert sorted(values(public_jobs.main_jobs(df), "worker_id", "firm_id")) == [(1, 3), (3, 2)]


def test_tax_credit_rate(spark):
    df = spark.createDataFrame([(78.0,), (120.0,), (99.0,), (None,), (10.0,)], "m double")
    got = [v for (v,) in values(df, X.credit_rate("m", F.lit(78.0), F.lit(120.0)))]
    assert got[0] == pytest.approx(0.15) and got[1] == 0 and got[2] == pytest.approx(0.075)
    assert got[3] is None and got[4] == pytest.approx(0.15)


def test_month_without_parameters(spark):
    df = spark.createDataFrame([(1, 1, 7, 100.0)], "worker_id long, firm_id long, pidx int, monto double")
    params = spark.createDataFrame([(8, 10.0, 1.0)], "pidx int, utm double, usd double")
    assert values(tax_credit.with_parameters(df, params), "utm", "usd") == [(None, None)]


def test_persons_precedence(spark):
    demo = spark.createDataFrame(
        [(1, 1, 3, "1980-01-01", "--"), (2, 9, 1, "1990-01-01", None)],
        "person_id long, sexo int, nacionalidad int, fecha_nac string, fecha_def_cor_rc string",
    )
    geo = spark.createDataFrame([(1, "13", "a"), (3, "5", "b")], "person_id long, codigo_region string, codigo_comuna string")
    late = spark.createDataFrame(
        [(1, 2, 3, "x", "x", "1", "z"), (4, 2, 3, "2000-01-01", None, "9", "y")],
        "person_id long, sexo_rc int, nacionalidad_rc int, fecha_nac_cor_rc string, fecha_def_cor_rc string,"
        " codigo_region_rc string, codigo_comuna_rc string",
    )
    donor = spark.createDataFrame([(2, 2), (5, 1)], "worker_id long, sexo_final int")
    out = persons.persons(demo, geo, late, donor).orderBy("person_id")
    assert values(out, "person_id", "sexo", "nacionalidad", "codigo_region") == [
        (1, 1, 1, "13"), (2, 2, 1, None), (3, None, None, "5"), (4, 2, 2, "9"), (5, 1, None, None),
    ]


def test_enrich_needs_unique_lookups(spark):
    df = spark.createDataFrame([(1,), (1,)], "k int")
    with pytest.raises(ValueError):
        lookups.require_unique(df, ["k"])
    assert lookups.require_unique(df.distinct(), ["k"]).count() == 1


def test_compare_null_dimensions(spark):
    own = spark.createDataFrame(
        [(2020, 1, None, "pt", 5.0), (2020, 1, 1, "pt", 6.0)], "anno int, mes int, sexo int, indicador string, valor double"
    )
    other = own.replace({"pt": "pt_cur"}, subset=["indicador"])
    assert reconcile.compare(own, other, {"sexo": "sexo"}, rename_time=False).count() == 1
    loose = reconcile.compare(own, other, {"sexo": "sexo"}, rename_time=False, drop_null_dims=False)
    assert loose.count() == 2


def test_empty_comparison_summary(spark):
    empty = spark.createDataFrame([], "comparacion string, d double")
    assert [tuple(r) for r in reconcile.summary(empty, ["x"]).collect()] == [("x", 0, 0, None, None)]


def test_exact_median_with_ties_and_unknown_months(spark):
    import random
    import statistics

    rng = random.Random(7)
    data = {1: [5.0] * 700 + [rng.random() * 10 for _ in range(800)], 2: [3.0], 3: [1.0, 2.0], 4: [None, None]}
    rows = [(w, 1, p, v, 30) for p, vs in data.items() for w, v in enumerate(vs)]
    df = spark.createDataFrame(rows, "worker_id long, firm_id long, pidx int, monto double, dias int")
    got = dict(values(wage_index.wage_mass(df, unique_key=True), "pidx", "salario_mediano"))
    assert got == {1: statistics.median(data[1]), 2: 3.0, 3: 1.5, 4: None}


def test_holdout_and_fit_recover_a_plane(spark):
    rows = [(s, p, 1.0 * p % 7, 1.0 * (p * p) % 11) for s in ("a", "b") for p in range(40)]
    df = spark.createDataFrame(rows, "s string, pidx int, x1 double, x2 double").withColumn(
        "y", F.when(F.col("pidx") < 38, 2 + 3 * F.col("x1") - F.col("x2"))
    )
    fit = grouped_stats.lagged_ols(df, "y", "x1", "x2", [0, 1], ["s"]).filter("lag = 0")
    for b0, b1, b2, r2 in values(fit, "b0", "b1", "b2", "r2"):
        assert (b0, b1, b2, r2) == pytest.approx((2, 3, -1, 1))
    predicted = grouped_stats.predict_holdout(df, "y", "x1", "x2", ["s"])
    assert predicted.filter("muestra = 'nowcast'").count() == 4
    for mae, rmse in values(grouped_stats.holdout_eval(predicted, "y", ["s"]), "mae", "rmse"):
        assert (mae, rmse) == pytest.approx((0, 0), abs=1e-9)


def test_collinear_regressors_give_null(spark):
    df = spark.createDataFrame([("a", p, 1.0 * p, 2.0 * p, 5.0 * p) for p in range(9)], "s string, pidx int, x1 double, x2 double, y double")
    assert values(grouped_stats.lagged_ols(df, "y", "x1", "x2", [0], ["s"]), "b1", "aic") == [(None, None)]


def test_master_table_drops_repeated_columns(spark):
    adjusted = spark.createDataFrame([(1, 2.0, 3.0)], "pidx int, iilf double, var_a_imacec_sa double")
    nowcast = spark.createDataFrame([(1, 3.0, 4.0)], "pidx int, var_a_imacec_sa double, imacec_nowcast double")
    out = wage_index.master_table(adjusted, nowcast)
    assert out.columns == ["pidx", "iilf", "var_a_imacec_sa", "imacec_nowcast"]


def test_leaders_keep_ties(spark):
    df = spark.createDataFrame([(1, "a", 5.0), (1, "b", 5.0), (1, "c", 1.0)], "p int, k string, v double")
    assert sorted(values(reports.leaders(df, "v", ["p"]), "k")) == [("a",), ("b",)]


def test_public_bulletin_table(spark):
    rows = [(2020, 1, 1, "pt", 5.0), (2020, 1, 0, "pt", 6.0), (2020, 1, 1, "t_ent", 1.0), (2020, 2, 1, "pt", None)]
    df = spark.createDataFrame(rows, "anno int, mes int, ep int, indicador string, valor double")
    df = df.withColumn("tabla", F.lit("ep"))
    out = reports.bulletin(df, {"ep": reports.BULLETIN["ep"]})
    assert values(out, "cuadro", "indicador", "valor") == [("ep", "pt", 5.0)]


def test_contingency_counts_unknown(spark):
    df = spark.createDataFrame([(1, None), (1, None), (None, 2)], "a int, b int")
    assert sorted(values(audit.contingency(df, "a", "b"), "a", "b", "n"), key=str) == sorted(
        [(1, None, 2), (None, 2, 1)], key=str
    )


def test_magnitude_text(spark):
    df = spark.createDataFrame([(2e12,), (1.55e9,), (1.25e6,), (1234.5,), (None,)], "x double")
    assert [v for (v,) in values(df, X.magnitude("x"))] == ["2 B", "1.6 MM", "1.2 M", "1,234", None]


def test_canonical_names(spark):
    df = spark.createDataFrame([(1, 2)], "id_ine_id_trabajador long, seccion_ciiu4cl int")
    assert S.canonical(df).columns == ["worker_id", "seccion"]


def test_bulletin_lists_every_indicator(spark, sf):
    """Each indicator of the catalogue occurs; a name that no result has would not."""
    from catalog import QUERIES

    rows = QUERIES["D17_bulletin_tables"](spark, sf).select("cuadro", "indicador").distinct().collect()
    found = {(r.cuadro, r.indicador) for r in rows}
    assert found == {(t, i) for t, (_, _, names, _) in reports.BULLETIN.items() for i in names}


def test_months_before_the_list_of_periods_stay(spark):
    rows = [(1, 1, 2015, 1, 10.0, 30), (1, 1, 2017, 1, 20.0, 30), (1, 1, 2017, 3, 40.0, 30)]
    panel = spark.createDataFrame(rows, "worker_id long, firm_id long, anno int, mes int, monto double, dias int")
    months = spark.createDataFrame([(2017, 1), (2017, 2), (2017, 3)], "anno int, mes int")
    listed = P.available_periods(months)
    out = impute.impute_gaps(panel, listed)
    assert sorted(values(out, "anno", "mes", "monto", "is_imputed")) == [
        (2015, 1, 10.0, False), (2017, 1, 20.0, False), (2017, 2, 30.0, True), (2017, 3, 40.0, False),
    ]
    cells = flows.turnover_cells(panel.withColumn("sexo", F.lit(1)), ["sexo"], listed)
    assert cells.agg(F.sum("pt")).first()[0] == 3


def test_a_month_given_twice_fails(spark):
    panel = spark.createDataFrame([(1, 1, 2020, 1, 10.0)], "worker_id long, firm_id long, anno int, mes int, monto double")
    twice = spark.createDataFrame([(2020, 1, 5), (2020, 1, 5)], "anno int, mes int, tope int")
    assert clean.cap_pay(panel, twice).count() == 1
    with pytest.raises(Exception, match="two different rows"):
        clean.cap_pay(panel, twice.unionByName(twice.withColumn("tope", F.lit(7)))).collect()


def test_persons_without_an_id_stay_apart(spark):
    demo = spark.createDataFrame(
        [(None, 1, 1, "2000-01-01", None), (None, 2, 1, "1990-01-01", None), (7, 1, 1, "1980-01-01", None)],
        "person_id long, sexo int, nacionalidad int, fecha_nac string, fecha_def_cor_rc string",
    )
    geo = spark.createDataFrame([(None, "13", "1"), (7, "5", "2")], "person_id long, codigo_region string, codigo_comuna string")
    late = spark.createDataFrame(
        [(None, 1, 1, None, None, "8", "3")],
        "person_id long, sexo_rc int, nacionalidad_rc int, fecha_nac_cor_rc string, fecha_def_cor_rc string, "
        "codigo_region_rc string, codigo_comuna_rc string",
    )
    donor = spark.createDataFrame([], "worker_id long, sexo_final int")
    out = persons.persons(demo, geo, late, donor)
    assert out.filter("person_id is null").count() == 4
    assert lookups.require_unique(out, ["person_id"]).count() == 5


def test_codes_round_half_away(spark):
    df = spark.createDataFrame([("17.6",), ("16.5",), ("17.0",), ("-1.5",), ("x",), (None,)], "c string")
    assert values(df.select(X.int_code("c").alias("c")), "c") == [(18,), (17,), (17,), (-2,), (None,), (None,)]


def test_median_survives_a_bracket_that_misses(spark, monkeypatch):
    """A bracket on the wrong side, above or below, is moved to the range that holds the median, for that month alone."""
    import random
    import statistics

    rng = random.Random(11)
    data = {p: [rng.lognormvariate(0, 2) for _ in range(501 + p)] for p in range(1, 5)} | {5: [4.0] * 30, 6: [None]}
    rows = [(w, 1, p, v, 30) for p, vs in data.items() for w, v in enumerate(vs)]
    df = spark.createDataFrame(rows, "worker_id long, firm_id long, pidx int, monto double, dias int")
    want = {p: statistics.median(vs) if vs[0] is not None else None for p, vs in data.items()}
    honest = wage_index.bracket

    def wrong(value):
        low = F.when(F.col("pidx") % 2 == 0, F.array(F.lit(1e-9), F.lit(2e-9))).otherwise(F.array(F.lit(900.0), F.lit(901.0)))
        return [*honest(value)[:3], F.first(low).alias("_q")]

    monkeypatch.setattr(wage_index, "bracket", wrong)
    got = dict(values(wage_index.wage_mass(df, unique_key=True), "pidx", "salario_mediano"))
    assert {p: v and round(v, 9) for p, v in got.items()} == {p: v and round(v, 9) for p, v in want.items()}
