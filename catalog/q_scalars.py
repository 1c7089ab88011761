"""X rows: scalar functions, over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import q_composites, roles  # noqa: F401  (defines CTEs)
from catalog.registry import R, query, rounded, sql
from laborlens.functions import periods as P
from laborlens.functions import scalars as X
from laborlens import schema as S
from laborlens.operators import reconcile, reshape, tax_credit

KEYS = ["worker_id", "firm_id", "pidx"]


@query(
    "X01_parse_date",
    sql(
        """SELECT person_id, CASE WHEN fecha_nac IN ('--', '', ' ') THEN NULL ELSE CAST(fecha_nac AS DATE) END AS nac,
  CASE WHEN fecha_def_cor_rc IN ('--', '', ' ') THEN NULL ELSE CAST(fecha_def_cor_rc AS DATE) END AS def
FROM demographic""",
        "demographic",
    ),
)
def parse_date(spark, sf):
    return roles.demographic(spark, sf).select(
        "person_id", X.parse_date("fecha_nac").alias("nac"), X.parse_date("fecha_def_cor_rc").alias("def")
    )


@query("X02_age_months", sql("SELECT worker_id, firm_id, pidx, edad_meses FROM panel", "panel"))
def age_months(spark, sf):
    age = X.months_since("fecha_nac", "anno", "mes").alias("edad_meses")
    return roles.panel(spark, sf).select(*KEYS, age)


@query(
    "X03_period_keys",
    sql(
        "SELECT worker_id, firm_id, anno * 100 + mes AS periodo_int, make_date(anno, mes, 1) AS fecha FROM panel",
        "panel",
    ),
)
def period_keys(spark, sf):
    return roles.panel(spark, sf).select(
        "worker_id", "firm_id", P.yyyymm("anno", "mes").alias("periodo_int"), P.month_start("pidx").alias("fecha")
    )


@query(
    "X04_date_parts",
    sql(
        """SELECT person_id, CAST(year(d) AS INT) AS anno, CAST(month(d) AS INT) AS mes,
  CAST(year(d) * 12 + month(d) - 1 AS INT) AS pidx FROM (SELECT person_id, TRY_CAST(fecha_nac AS DATE) AS d FROM demographic)""",
        "demographic",
    ),
)
def date_parts(spark, sf):
    d = X.parse_date("fecha_nac")
    return roles.demographic(spark, sf).select(
        "person_id", F.year(d).alias("anno"), F.month(d).alias("mes"), P.pidx_of_date(d).alias("pidx")
    )


@query(
    "X05_month_shift",
    sql(
        """SELECT worker_id, firm_id, CAST(make_date(anno, mes, 1) + INTERVAL 12 MONTHS AS DATE) AS mas,
  CAST(make_date(anno, mes, 1) - INTERVAL 12 MONTHS AS DATE) AS menos FROM panel""",
        "panel",
    ),
)
def month_shift(spark, sf):
    start = P.month_start("pidx")
    return roles.panel(spark, sf).select(
        "worker_id", "firm_id", F.add_months(start, 12).alias("mas"), P.month_start(F.col("pidx") - 12).alias("menos")
    )


@query(
    "X06_month_difference",
    sql(
        "SELECT worker_id, firm_id, pidx, CAST(datediff('month', DATE '1995-01-01', make_date(anno, mes, 1)) AS INT) AS meses FROM panel",
        "panel",
    ),
)
def month_difference(spark, sf):
    start = F.lit(1995 * 12)
    return roles.panel(spark, sf).select(*KEYS, (F.col("pidx") - start).alias("meses"))


@query(
    "X07_capped_pay",
    sql("SELECT worker_id, firm_id, pidx, round(monto, 2) + 0.0 AS monto FROM capped", "capped"),
)
def capped_pay(spark, sf):
    from catalog.q_composites import gap_input
    from laborlens.operators.clean import cap_pay

    return rounded(cap_pay(gap_input(spark, sf), roles.caps(spark, sf)), 2).select(*KEYS, "monto")


@query(
    "X07_capped_pay_keep",
    sql(
        """SELECT worker_id, firm_id, pidx, CASE WHEN monto > tope THEN tope ELSE monto END AS monto
FROM panel p LEFT JOIN caps c ON p.anno = c.anno AND p.mes = c.mes""",
        "panel", "caps",
    ),
)
def capped_pay_keep(spark, sf):
    from catalog.q_composites import gap_input
    from laborlens.operators.clean import cap_pay

    return cap_pay(gap_input(spark, sf), roles.caps(spark, sf), missing_cap="keep").select(*KEYS, "monto")


@query(
    "X08_cap_computation",
    sql(
        "SELECT anno, mes, CAST(trunc((CAST('25000.37' AS DOUBLE) + pidx) * CAST('74.3' AS DOUBLE)) AS INT) AS tope FROM periods",
        "periods",
    ),
)
def cap_computation(spark, sf):
    uf = F.lit(25000.37) + F.col("pidx")
    return roles.periods(spark, sf).select("anno", "mes", F.floor(uf * 74.3).cast("int").alias("tope"))


@query(
    "X09_payment_rules",
    sql(
        """SELECT worker_id, firm_id, COALESCE(tipo_pago, 1) AS tipo_pago,
  CASE WHEN COALESCE(tipo_pago, 1) IN (2, 3) THEN 0 ELSE monto END AS monto,
  CASE WHEN CASE WHEN COALESCE(tipo_pago, 1) IN (2, 3) THEN 0 ELSE dias END > 30 THEN 30
       ELSE CASE WHEN COALESCE(tipo_pago, 1) IN (2, 3) THEN 0 ELSE dias END END AS dias FROM raw""",
        "raw",
    ),
)
def payment_rules(spark, sf):
    rows = roles.raw(spark, sf).withColumn("tipo_pago", X.payment_type("tipo_pago"))
    return rows.select(
        "worker_id", "firm_id", "tipo_pago",
        X.zero_on_leave("monto", "tipo_pago").cast("double").alias("monto"),
        X.at_most(X.zero_on_leave("dias", "tipo_pago"), 30).alias("dias"),
    )


@query(
    "X10_imputed_value",
    sql(
        """SELECT worker_id, firm_id, pidx,
  CASE WHEN COALESCE(a, 0) > 0 AND COALESCE(b, 0) > 0 THEN CAST(CAST(a + b AS DOUBLE) / 2 AS INT)
       ELSE GREATEST(COALESCE(a, 0), COALESCE(b, 0)) END AS dias
FROM (SELECT *, NULLIF(dias, 30) AS a, CAST(firm_id % 7 AS INT) AS b FROM panel)""",
        "panel",
    ),
)
def imputed_value(spark, sf):
    a, b = F.nullif("dias", F.lit(30)), (F.col("firm_id") % 7).cast("int")
    return roles.panel(spark, sf).select(*KEYS, X.between_neighbours_days(a, b).alias("dias"))


@query(
    "X11_int_code",
    sql("SELECT person_id, codigo_region, TRY_CAST(codigo_region AS INT) AS codigo FROM geographic", "geographic"),
)
def int_code(spark, sf):
    return roles.geographic(spark, sf).select("person_id", "codigo_region", X.int_code("codigo_region").alias("codigo"))


@query(
    "X12_fallback_chain",
    sql(
        """SELECT person_id, CASE WHEN code NOT IN (17, 88, 99) AND codigo_region IS NOT NULL THEN code
  WHEN donor IN (88, 99) THEN NULL ELSE donor END AS region
FROM (SELECT *, TRY_CAST(codigo_region AS INT) AS code, CAST(CASE person_id % 5 WHEN 0 THEN 17 WHEN 1 THEN 99
        WHEN 2 THEN NULL ELSE 13 END AS INT) AS donor FROM geographic)""",
        "geographic",
    ),
)
def fallback_chain(spark, sf):
    geo = roles.geographic(spark, sf).withColumn(
        "donor", F.expr("CASE person_id % 5 WHEN 0 THEN 17 WHEN 1 THEN 99 WHEN 2 THEN NULL ELSE 13 END")
    )
    region = X.code_with_donor("codigo_region", "donor", S.REGION_UNKNOWN, S.REGION_DONOR_UNKNOWN)
    return geo.select("person_id", region.alias("region"))


@query(
    "X13_static_band",
    sql("SELECT firm_id, t, tamano FROM static_size", "static_size"),
)
def static_band(spark, sf):
    from catalog.q_composites import heads
    from laborlens.operators.firm_size import static_size

    return static_size(heads(spark, sf)).select("firm_id", "t", "tamano")


@query(
    "X14_moving_band",
    sql(
        """SELECT firm_id, pidx, CASE WHEN n_trabajadores < 5 THEN 'micro' WHEN n_trabajadores < 50 THEN 'pequena'
  WHEN n_trabajadores < 200 THEN 'mediana' ELSE 'grande' END AS banda FROM heads""",
        "heads",
    ),
)
def moving_band(spark, sf):
    from catalog.q_composites import heads

    return heads(spark, sf).select("firm_id", "pidx", X.moving_size_band("n_trabajadores").alias("banda"))


def _unknown_birth(spark, sf):
    return roles.panel(spark, sf).select(
        *KEYS, F.when(F.col("worker_id") % 9 != 0, F.col("edad_meses")).alias("edad")
    )


@query(
    "X15_age_band_7",
    sql(
        f"""SELECT worker_id, firm_id, pidx, {roles.age_case('edad', roles.AGE7)} AS tramo FROM
(SELECT *, CASE WHEN worker_id % 9 <> 0 THEN edad_meses END AS edad FROM panel)""",
        "panel",
    ),
)
def age_band_7(spark, sf):
    return _unknown_birth(spark, sf).select(*KEYS, X.age_band_7("edad").alias("tramo"))


@query(
    "X16_age_band_13",
    sql(
        f"""SELECT worker_id, firm_id, pidx, {roles.age_case('edad', roles.AGE13)} AS tramo FROM
(SELECT *, CASE WHEN worker_id % 9 <> 0 THEN edad_meses END AS edad FROM panel)""",
        "panel",
    ),
)
def age_band_13(spark, sf):
    return _unknown_birth(spark, sf).select(*KEYS, X.age_band_13("edad").alias("tramo"))


@query(
    "X17_nationality_recode",
    sql(
        """SELECT person_id, CASE WHEN nacionalidad_rc = 3 THEN 1 ELSE nacionalidad_rc END AS n2024,
  CASE nacionalidad_rc WHEN 2 THEN 1 WHEN 3 THEN 2 ELSE nacionalidad_rc END AS n2025 FROM registry25""",
        "registry25",
    ),
)
def nationality_recode(spark, sf):
    return roles.registry25(spark, sf).select(
        "person_id", X.nationality_2024("nacionalidad_rc").alias("n2024"), X.nationality_2025("nacionalidad_rc").alias("n2025")
    )


@query(
    "X18_valid_sex",
    sql(
        """SELECT person_id, CASE WHEN sexo IS NULL OR sexo NOT IN (1, 2) THEN sexo_final ELSE sexo END AS sexo
FROM demographic LEFT JOIN sex_donor ON person_id = worker_id""",
        "demographic", "sex_donor",
    ),
)
def valid_sex(spark, sf):
    donor = roles.sex_donor(spark, sf).withColumnRenamed("worker_id", "person_id")
    joined = roles.demographic(spark, sf).join(donor, "person_id", "left")
    return joined.select("person_id", X.valid_sex("sexo", "sexo_final").alias("sexo"))


def _flow_names(spark, sf):
    return roles.panel(spark, sf).groupBy("pidx").agg(
        F.count("*").alias("pt"), F.count_if(F.col("sexo") == 1).alias("pt_ent_12"),
        F.count_if(F.col("sexo") == 2).alias("pt_sal_12"), F.count("region_final").alias("inc_trln"),
    )


@query(
    "X19_recode_indicators",
    sql(
        " UNION ALL ".join(
            f"SELECT CAST(pidx // 12 AS INT) AS anno, CAST(pidx % 12 + 1 AS INT) AS mes, make_date(CAST(pidx // 12 AS INT), CAST(pidx % 12 + 1 AS INT), 1) AS fecha, '{new}' AS indicador, CAST({v} AS DOUBLE) AS valor FROM panel GROUP BY pidx"
            for new, v in (
                ("pt_cur", "COUNT(*)"), ("pt_ent", "COUNT(*) FILTER (sexo = 1)"),
                ("pt_sal", "COUNT(*) FILTER (sexo = 2)"), ("inc_rot_neta", "COUNT(region_final)"),
            )
        ),
        "panel",
    ),
)
def recode_indicators(spark, sf):
    return reshape.recode_indicators(reshape.to_long(_flow_names(spark, sf)))


@query(
    "X20_age_label_code",
    sql(
        "SELECT worker_id, firm_id, pidx, tramo_edad AS edad FROM panel WHERE tramo_edad IS NOT NULL",
        "panel",
    ),
)
def age_label_code(spark, sf):
    labels = F.array(*[F.lit(t) for t in X.AGE_LABELS])
    rows = roles.panel(spark, sf).select(*KEYS, F.element_at(labels, F.col("tramo_edad") + 1).alias("edad"))
    return reconcile.age_codes(rows)


@query(
    "X21_sex_label",
    sql(
        """SELECT person_id, CASE sexo WHEN 1 THEN 'Hombres' WHEN 2 THEN 'Mujeres' ELSE 'Sin información' END AS grupo
FROM demographic""",
        "demographic",
    ),
)
def sex_label(spark, sf):
    return roles.demographic(spark, sf).select("person_id", X.sex_label("sexo").alias("grupo"))


@query(
    "X22_distinct_pairs",
    sql(
        """SELECT pidx, COUNT(DISTINCT CAST(worker_id AS VARCHAR) || '_' || CAST(firm_id AS VARCHAR)) AS pt
FROM (SELECT *, anno * 12 + mes - 1 AS pidx FROM raw) GROUP BY pidx""",
        "raw",
    ),
)
def distinct_pairs(spark, sf):
    rows = P.with_pidx(roles.raw(spark, sf))
    return rows.groupBy("pidx").agg(F.countDistinct("worker_id", "firm_id").alias("pt"))


@query(
    "X23_zero_fill",
    sql("SELECT worker_id, firm_id, pidx, COALESCE(region_final, 0) AS region, ep FROM panel", "panel"),
)
def zero_fill(spark, sf):
    return roles.panel(spark, sf).select(
        *KEYS, F.coalesce("region_final", F.lit(0)).alias("region"), "ep"
    )


@query(
    "X24_guarded_ratio",
    sql(
        f"SELECT worker_id, firm_id, pidx, {R('CASE WHEN firm_id % 4 > 0 THEN dias / CAST(firm_id % 4 AS DOUBLE) END', 'razon')} FROM panel",
        "panel",
    ),
)
def guarded_ratio(spark, sf):
    den = F.col("firm_id") % 4
    return rounded(roles.panel(spark, sf).select(*KEYS, X.ratio_if_positive("dias", den).alias("razon")))


@query(
    "X25_wages",
    sql(
        f"""SELECT worker_id, firm_id, pidx, {R('CASE WHEN d > 0 THEN monto / d END', 'diario', 7)},
  {R('monto * (d / CAST(30 AS DOUBLE))', 'ajustado', 7)} FROM (SELECT *, NULLIF(dias, 30) AS d FROM panel)""",
        "panel",
    ),
)
def wages(spark, sf):
    rows = roles.panel(spark, sf).withColumn("d", F.nullif("dias", F.lit(30)))
    return rounded(
        rows.select(*KEYS, X.daily_wage("monto", "d").alias("diario"), X.day_adjusted("monto", "d").alias("ajustado")), 7
    )


@query(
    "X26_tax_credit_rate",
    sql(
        f"""SELECT worker_id, firm_id, panel.pidx AS pidx, {R('''CASE WHEN utm IS NULL THEN NULL ELSE greatest(0, least(0.15::DOUBLE,
  0.15::DOUBLE * (utm * 12 - monto) / (utm * 12 - utm * 7.8::DOUBLE))) END''', 'tasa_ct')}
FROM panel LEFT JOIN params ON panel.pidx = params.pidx""",
        "panel", "params",
    ),
)
def tax_credit_rate(spark, sf):
    jobs = tax_credit.with_parameters(
        roles.panel(spark, sf).select(*KEYS, "monto"), roles.parameters(spark, sf)
    )
    return rounded(jobs.select(*KEYS, X.credit_rate("monto", *X.credit_bounds("utm")).alias("tasa_ct")))


@query(
    "X27_deflation",
    sql(
        f"""SELECT worker_id, firm_id, panel.pidx AS pidx, {R('monto / ipc', 'real', 7)}, {R('monto / ipc * 100', 'real_100', 7)}
FROM panel LEFT JOIN prices ON panel.pidx = prices.pidx""",
        "panel", "prices",
    ),
)
def deflation(spark, sf):
    jobs = roles.panel(spark, sf).select(*KEYS, "monto").join(P.by_month(roles.prices(spark, sf)), "pidx", "left")
    return rounded(
        jobs.select(*KEYS, X.deflate("monto", "ipc").alias("real"), X.deflate("monto", "ipc", 100).alias("real_100")), 7
    )


@query(
    "X28_period_labels",
    sql("SELECT worker_id, firm_id, strftime(make_date(anno, mes, 1), '%Y-%m') AS periodo FROM panel", "panel"),
)
def period_labels(spark, sf):
    return roles.panel(spark, sf).select("worker_id", "firm_id", X.month_label("anno", "mes").alias("periodo"))


@query(
    "X29_date_from_name",
    sql(
        """SELECT worker_id, firm_id, CAST(strptime(substring(f, 5, 6) || '01', '%Y%m%d') AS DATE) AS fecha
FROM (SELECT *, 'job_' || CAST(anno * 100 + mes AS VARCHAR) || '.parquet' AS f FROM panel)""",
        "panel",
    ),
)
def date_from_name(spark, sf):
    name = F.concat(F.lit("job_"), P.yyyymm("anno", "mes").cast("string"), F.lit(".parquet"))
    return roles.panel(spark, sf).select("worker_id", "firm_id", X.digits_date(name).alias("fecha"))


@query(
    "X30_magnitude_text",
    sql(
        """SELECT worker_id, CASE
  WHEN v >= 1e12 THEN regexp_replace(CAST(round_even(v / 1e12, 1) AS VARCHAR), '\\.0$', '') || ' B'
  WHEN v >= 1e9 THEN regexp_replace(CAST(round_even(v / 1e9, 1) AS VARCHAR), '\\.0$', '') || ' MM'
  WHEN v >= 1e6 THEN regexp_replace(CAST(round_even(v / 1e6, 1) AS VARCHAR), '\\.0$', '') || ' M'
  ELSE format('{:,}', CAST(round_even(v, 0) AS BIGINT)) END AS texto
FROM (SELECT worker_id, round(SUM(monto), 2) * CASE worker_id % 3 WHEN 0 THEN 1 WHEN 1 THEN 1000 ELSE 1000000 END AS v
      FROM panel GROUP BY worker_id)""",
        "panel",
    ),
)
def magnitude_text(spark, sf):
    sums = roles.panel(spark, sf).groupBy("worker_id").agg(F.round(F.sum("monto"), 2).alias("v"))
    scale = F.expr("CASE worker_id % 3 WHEN 0 THEN 1 WHEN 1 THEN 1000 ELSE 1000000 END")
    return sums.select("worker_id", X.magnitude(F.col("v") * scale).alias("texto"))


@query(
    "X30_percent_text",
    sql(
        """SELECT firm_id, pidx, printf('%.1f', round_even(p * 100, 1)) || '%' AS texto FROM (
SELECT firm_id, pidx, COUNT(*) / CAST(SUM(COUNT(*)) OVER (PARTITION BY firm_id) AS DOUBLE) AS p FROM panel GROUP BY firm_id, pidx)""",
        "panel",
    ),
)
def percent_text(spark, sf):
    months = roles.panel(spark, sf).groupBy("firm_id", "pidx").agg(F.count("*").alias("n"))
    p = tax_credit.share(months, "n", "p", by=("firm_id",))
    return p.select("firm_id", "pidx", X.percent("p").alias("texto"))


@query(
    "X31_half_even",
    sql(
        """SELECT worker_id, firm_id, pidx, round_even(dias / 2.0::DOUBLE, 0) + 0.0 AS r0,
  round_even(dias / 4.0::DOUBLE, 1) + 0.0 AS r1 FROM panel""",
        "panel",
    ),
)
def half_even(spark, sf):
    d = F.col("dias")
    return roles.panel(spark, sf).select(
        *KEYS, (F.bround(d / 2, 0) + F.lit(0.0)).alias("r0"), (F.bround(d / 4, 1) + F.lit(0.0)).alias("r1")
    )


@query(
    "X32_dimension_as_text",
    sql("SELECT worker_id, firm_id, pidx, CAST(region_final AS VARCHAR) AS region_final FROM panel", "panel"),
)
def dimension_as_text(spark, sf):
    rows = roles.panel(spark, sf).select(*KEYS, "region_final")
    return rows.transform(reconcile.dims_as_text("region_final"))
