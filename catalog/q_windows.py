"""W rows: window functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import roles
from catalog.q_composites import (
    ALL,
    COND_COLS,
    RATE_COLS,
    heads,
    indicators_fixed,
    part_sql,
    credit,
    public_tables,
    ssi_rue,
    total_base,
    wage_indices,
)
from catalog.registry import R, query, rounded, sql
from laborlens import schema as S
from laborlens.operators import clean, firm_size, indicators, public_jobs, tax_credit, wage_index
from laborlens.sources import tables


@query(
    "W01_max_declaration",
    sql(
        """SELECT DISTINCT worker_id, firm_id, anno, mes, tipo_trabajador, MAX(tipo_declaracion) OVER (
  PARTITION BY worker_id, firm_id, anno, mes, tipo_trabajador) AS max_tipo_declaracion FROM raw""",
        "raw",
    ),
)
def max_declaration(spark, sf):
    return clean.max_declaration(roles.raw(spark, sf))


@query(
    "W02_keep_first",
    sql(
        """SELECT worker_id, firm_id, anno, mes, tipo_pago, monto, dias FROM (SELECT *, row_number() OVER (
  PARTITION BY worker_id, firm_id, anno, mes
  ORDER BY tipo_pago NULLS LAST, monto NULLS LAST, dias NULLS LAST) AS rn FROM raw) WHERE rn = 1""",
        "raw",
    ),
)
def keep_first(spark, sf):
    rows = roles.raw(spark, sf).select("worker_id", "firm_id", "anno", "mes", "tipo_pago", "monto", "dias")
    return tables.keep_first(rows, ["worker_id", "firm_id", "anno", "mes"])


@query(
    "W03_previous_month",
    sql(
        "SELECT *, LAG(pidx) OVER (PARTITION BY firm_id ORDER BY pidx) AS pidx_anterior FROM heads",
        "heads",
    ),
)
def previous_month(spark, sf):
    return firm_size.previous_month(heads(spark, sf))


@query(
    "W04_segments",
    sql(
        """SELECT firm_id, pidx, n_trabajadores, prev AS pidx_anterior, CAST(SUM(CASE WHEN prev IS NULL OR pidx - prev > 1 THEN 1 ELSE 0 END)
  OVER (PARTITION BY firm_id ORDER BY pidx) AS BIGINT) AS grupo
FROM (SELECT *, LAG(pidx) OVER (PARTITION BY firm_id ORDER BY pidx) AS prev FROM heads)""",
        "heads",
    ),
)
def segments(spark, sf):
    return firm_size.segments(heads(spark, sf), max_gap=1)


@query(
    "W05_moving_size",
    sql(
        f"SELECT firm_id, pidx, pt, {R('media_movil_12m')}, n_meses_utilizados, tamano_empresa_movil FROM moving_size",
        "moving_size",
    ),
)
def moving_size(spark, sf):
    return rounded(firm_size.moving_size(heads(spark, sf)))


@query(
    "W06_rates",
    sql(
        f"SELECT tabla, CAST(pidx AS INT) AS pidx, {ALL}, pt, pt_ent_12, pt_sal_12, {', '.join(R(c) for c in RATE_COLS)} FROM fx_rates",
        "fx_rates",
    ),
)
def rates(spark, sf):
    return rounded(indicators.rates(total_base(spark, sf)[0]))


@query(
    "W07_rotation_incidence_change",
    sql(
        f"""SELECT make_date(CAST(pidx // 12 AS INT), CAST(pidx % 12 + 1 AS INT), 1) AS fecha, tabla, {ALL},
  {R('inc_rot')}, {R('inc_rot_12')}, {R('inc_var_trl')} FROM fx_all""",
        "fx_all",
    ),
)
def rotation_incidence_change(spark, sf):
    return rounded(indicators.rotation_incidence_change(indicators_fixed(spark, sf)))


@query("W08_main_jobs", sql("SELECT worker_id, firm_id, pidx, monto, dias FROM main_jobs", "main_jobs"))
def main_jobs(spark, sf):
    public = roles.panel(spark, sf).filter("ep = 1")
    return public_jobs.main_jobs(public).select("worker_id", "firm_id", "pidx", "monto", "dias")


@query(
    "W09_share_of_month",
    sql(part_sql("credit_class", "sexo, nacionalidad", "SUM(puestos_de_trabajo)"), "credit_class"),
)
def share_of_month(spark, sf):
    by_class = tax_credit.credit_by_class(credit(spark, sf), unique_key=True)
    long = tax_credit.with_shares(tax_credit.job_cells(by_class)).filter("tabla = 'pt_sx_nc'")
    return rounded(long.select("anno", "mes", "sexo", "nacionalidad", F.col("n").alias("pt"), "participacion"))


@query(
    "W10_public_variations",
    sql(
        f"SELECT tabla, pidx, {', '.join(S.PUBLIC_CLASSES)}, pt, {R('var12_pt')}, {R('var1_pt')} FROM public_var",
        "public_var",
    ),
)
def public_variations(spark, sf):
    rows = public_tables(spark, sf).filter("tabla <> 'total'")
    return rounded(public_jobs.variations(rows, ["tabla", *S.PUBLIC_CLASSES]))


@query(
    "W11_public_incidences",
    sql(
        f"""SELECT tabla, pidx, {', '.join(S.PUBLIC_CLASSES)}, pt, {R('var12_pt')}, {R('var1_pt')}, {R('inc12_pt', 'inc_var_12')},
  {R('inc1_pt', 'inc_var_01')} FROM public_inc""",
        "public_inc",
    ),
)
def public_incidences(spark, sf):
    all_tables, by = public_tables(spark, sf), ["tabla", *S.PUBLIC_CLASSES]
    grown = public_jobs.variations(all_tables.filter("tabla <> 'total'"), by)
    return rounded(public_jobs.incidences(grown, all_tables.filter("tabla = 'total'"), by))


@query(
    "W12_conditional_incidence",
    sql(
        f"""SELECT pidx, subsector_institucional, seccion_ciiu4cl_prin, pt, CAST(pt_seccion AS BIGINT) AS pt_seccion, pt_lag12,
  CAST(pt_seccion_lag12 AS BIGINT) AS pt_seccion_lag12, pt_lag1, CAST(pt_seccion_lag1 AS BIGINT) AS pt_seccion_lag1,
  {', '.join(R(c) for c in COND_COLS[6:])} FROM cond_inc""",
        "cond_inc",
    ),
)
def conditional_incidence(spark, sf):
    return rounded(public_jobs.conditional_incidence(ssi_rue(spark, sf)).drop("wi_12", "wi_01"))


@query(
    "W13_index_variations",
    sql(
        f"""SELECT pidx, {', '.join(R(c) for c in [
            'var_mensual_iilf', 'var_mensual_payroll', 'var_anual_iilf', 'var_anual_payroll'])} FROM indexed_var""",
        "indexed_var",
    ),
)
def index_variations(spark, sf):
    return rounded(
        wage_indices(spark, sf).select(
            "pidx", "var_mensual_iilf", "var_mensual_payroll", "var_anual_iilf", "var_anual_payroll"
        )
    )


@query(
    "W13_adjusted_variations",
    sql(
        f"""SELECT pidx, seccion, pt_sa, {R('CAST(pt_sa AS DOUBLE) / LAG(pt_sa, 1) OVER w - 1', 'var_m_pt_sa')},
  {R('CAST(pt_sa AS DOUBLE) / LAG(pt_sa, 12) OVER w - 1', 'var_a_pt_sa')}
FROM (SELECT pidx, seccion, COUNT(*) AS pt_sa FROM panel GROUP BY ALL) WINDOW w AS (PARTITION BY seccion ORDER BY pidx)""",
        "panel",
    ),
)
def adjusted_variations(spark, sf):
    series = roles.panel(spark, sf).groupBy("pidx", "seccion").agg(F.count("*").alias("pt_sa"))
    return rounded(wage_index.adjusted_variations(series, ["pt_sa"], ["seccion"]))
