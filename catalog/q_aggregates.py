"""A, O and U rows: aggregations, order and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import roles
from catalog.q_composites import (
    DATED,
    MASS_COLS,
    MIG,
    audited,
    breakdowns,
    credit,
    fixed_cells,
    gap_input,
    heads,
    indicators_fixed,
    jobs,
    mass,
    mobile_cells,
    part_sql,
    registries,
    stock_long,
    wage_jobs,
)
from catalog.registry import R, query, rounded, sql
from laborlens import schema as S
from laborlens.functions import periods as P
from laborlens.operators import (
    audit,
    clean,
    firm_size,
    flows,
    grouped_stats,
    impute,
    migration,
    persons,
    public_jobs,
    reconcile,
    reports,
    stocks,
    tax_credit,
    wage_index,
)
from laborlens.sources import bundle

KEYS = ["worker_id", "firm_id", "pidx"]
PUB = ", ".join(S.PUBLIC_CLASSES)


@query(
    "A01_sum_payments",
    sql(
        f"""SELECT worker_id, firm_id, anno, mes, tipo_trabajador, {R('SUM(CASE WHEN COALESCE(tipo_pago, 1) IN (2, 3) THEN 0 ELSE monto END)', 'monto', 2)},
  CAST(LEAST(30, SUM(CASE WHEN COALESCE(tipo_pago, 1) IN (2, 3) THEN 0 ELSE dias END)) AS INT) AS dias FROM raw GROUP BY ALL""",
        "raw",
    ),
)
def sum_payments(spark, sf):
    return rounded(clean.sum_payments(roles.raw(spark, sf)), 2)


@query("A02_headcount", sql("SELECT * FROM heads", "heads"))
def headcount(spark, sf):
    return firm_size.headcount(roles.supplier_panel(spark, sf))


@query(
    "A03_static_size",
    sql(f"SELECT firm_id, pt, t, {R('media_pt')}, tamano FROM static_size", "static_size"),
)
def static_size(spark, sf):
    return rounded(firm_size.static_size(heads(spark, sf)))


@query("A04_stock_cells", sql("SELECT * FROM stock_cells", "stock_cells"))
def stock_cells(spark, sf):
    return stocks.stock_cells(jobs(spark, sf))


@query("A05_stock_breakdowns", sql("SELECT * FROM stock_long", "stock_long"))
def stock_breakdowns(spark, sf):
    return stock_long(spark, sf)


@query("A06_fixed_flow_breakdowns", sql("SELECT * FROM flow_long", "flow_long"))
def fixed_flow_breakdowns(spark, sf):
    return flows.roll_up_fixed(fixed_cells(spark, sf))


@query("A07_mobile_flow_breakdowns", sql("SELECT * FROM mobile_long", "mobile_long"))
def mobile_flow_breakdowns(spark, sf):
    return flows.roll_up_mobile(mobile_cells(spark, sf))


@query(
    "A08_min_max_per_key",
    sql(
        """SELECT worker_id, MIN(anno * 100 + mes) AS primero, MAX(anno * 100 + mes) AS ultimo, MIN(sexo) AS min_sexo,
  MAX(sexo) AS max_sexo FROM raw GROUP BY worker_id""",
        "raw",
    ),
)
def min_max_per_key(spark, sf):
    period = P.yyyymm("anno", "mes")
    return roles.raw(spark, sf).groupBy("worker_id").agg(
        F.min(period).alias("primero"), F.max(period).alias("ultimo"),
        F.min("sexo").alias("min_sexo"), F.max("sexo").alias("max_sexo"),
    )


@query(
    "A09_distinct_rows",
    sql("SELECT DISTINCT worker_id, firm_id, tipo_pago, codigo_mutual FROM raw", "raw"),
)
def distinct_rows(spark, sf):
    return roles.raw(spark, sf).select("worker_id", "firm_id", "tipo_pago", "codigo_mutual").distinct()


@query("A10_public_job_cells", sql("SELECT * FROM public_cells", "public_cells"))
def public_job_cells(spark, sf):
    return public_jobs.public_job_cells(roles.public_panel(spark, sf))


@query("A11_public_person_cells", sql("SELECT * FROM person_cells", "person_cells"))
def public_person_cells(spark, sf):
    return public_jobs.public_person_cells(roles.public_panel(spark, sf))


@query(
    "A12_public_breakdowns",
    sql(
        breakdowns("public_cells", S.PUBLIC_BREAKDOWNS, S.PUBLIC_CLASSES, ["pt"]),
        "public_cells",
    ),
)
def public_breakdowns(spark, sf):
    return public_jobs.public_tables(public_jobs.public_job_cells(roles.public_panel(spark, sf), unique_key=True))


@query(
    "A13_migration_counts",
    sql(
        f"""SELECT {DATED}, desagregacion, {', '.join(MIG)}, i AS "In", e AS "Em", l12 AS "L_t12", l AS "L_t"
FROM migr""",
        "migr",
    ),
)
def migration_counts(spark, sf):
    out = migration.migration_rates(jobs(spark, sf, MIG), periods=roles.periods(spark, sf))
    return out.drop("tasa_inmigracion", "tasa_emigracion", "tmn", "var_12")


@query(
    "A14_wage_summary",
    sql(f"SELECT pidx, empleo_formal, dias_totales, {', '.join(R(c, decimals=4) for c in MASS_COLS)} FROM mass", "mass"),
)
def wage_summary(spark, sf):
    return rounded(wage_index.wage_mass(wage_jobs(spark, sf)), 4)


@query(
    "A15_base_year_means",
    sql(
        f"""SELECT {R('b1', 'base_iilf', 4)}, {R('b2', 'base_iilf_ajustado', 4)}, {R('b3', 'base_payroll_index', 4)},
  {R('b4', 'base_wage_index', 4)}, {R('b5', 'base_wage_daily_index', 4)}, {R('b6', 'base_labor_intensity_index', 4)} FROM base""",
        "base",
    ),
)
def base_year_means(spark, sf):
    real = wage_index.deflated(mass(spark, sf), roles.prices(spark, sf))
    return rounded(wage_index.base_means(real, 1998), 4)


@query(
    "A16_credit_by_class",
    sql(
        f"""SELECT pidx, sexo, nacionalidad, codigo_region, tramo_edad, tamano_empresa_movil, seccion,
  puestos_de_trabajo, {R('ct_total_clp', decimals=4)}, {R('ct_total_usd', decimals=4)} FROM credit_class""",
        "credit_class",
    ),
)
def credit_by_class(spark, sf):
    return rounded(tax_credit.credit_by_class(credit(spark, sf)), 4)


@query(
    "A17_credit_by_firm",
    sql(
        f"""SELECT pidx, firm_id, tamano_empresa_movil, seccion, {R('cl_clp', decimals=4)}, {R('ct_clp', decimals=4)},
  {R('cl_usd', decimals=4)}, {R('ct_usd', decimals=4)} FROM credit_firm""",
        "credit_firm",
    ),
)
def credit_by_firm(spark, sf):
    return rounded(tax_credit.credit_by_firm(credit(spark, sf)), 4)


@query(
    "A18_distinct_firms",
    sql(part_sql("credit_firm", "seccion", "COUNT(DISTINCT firm_id)").replace("pt", "n_e"), "credit_firm"),
)
def distinct_firms(spark, sf):
    firms = tax_credit.with_shares(tax_credit.firm_cells(tax_credit.credit_by_firm(credit(spark, sf))))
    return rounded(firms.filter("tabla = 'ee_sector'").select("anno", "mes", "seccion", F.col("n").alias("n_e"), "participacion"))


def _two_panels(spark, sf):
    a = roles.panel(spark, sf).select("worker_id", "seccion", "monto", "mes")
    d = F.when(F.col("mes") == 6, F.col("monto")).otherwise(F.lit(0.0)).alias("d")
    label = F.when(F.col("worker_id") % 2 == 0, "sexo").otherwise("otros")
    return a.select(label.alias("comparacion"), d)


@query(
    "A19_difference_summary",
    sql(
        f"""SELECT CASE worker_id % 2 WHEN 0 THEN 'sexo' ELSE 'otros' END AS comparacion, COUNT(*) AS n_filas,
  COUNT(*) FILTER (mes = 6 AND monto <> 0) AS n_dif_nz, {R('MAX(CASE WHEN mes = 6 THEN monto ELSE 0 END)', 'max_abs_d', 4)},
  {R('AVG(CASE WHEN mes = 6 THEN monto ELSE 0 END)', 'mean_abs_d', 4)} FROM panel GROUP BY worker_id % 2""",
        "panel",
    ),
)
def difference_summary(spark, sf):
    return rounded(reconcile.summary(_two_panels(spark, sf), ["sexo", "otros"]), 4)


_NO_REGION = """panel p LEFT JOIN registries r ON p.worker_id = r.worker_id WHERE region_rep_2024 IS NULL"""


@query(
    "A20_missing_months_per_job",
    sql(
        f"SELECT p.worker_id, firm_id, COUNT(DISTINCT pidx) AS tt FROM {_NO_REGION} GROUP BY p.worker_id, firm_id",
        "panel", "registries",
    ),
)
def missing_months_per_job(spark, sf):
    rows = audit.with_registry(roles.panel(spark, sf), registries(spark, sf))
    return audit.missing_months_per_job(rows, "region_rep_2024")


@query(
    "A20_missing_jobs_per_month",
    sql(
        f"SELECT pidx, COUNT(DISTINCT (p.worker_id, firm_id)) AS pt FROM {_NO_REGION} GROUP BY pidx",
        "panel", "registries",
    ),
)
def missing_jobs_per_month(spark, sf):
    rows = audit.with_registry(roles.panel(spark, sf), registries(spark, sf))
    return audit.missing_jobs_per_month(rows, "region_rep_2024")


@query(
    "A21_contingency",
    sql("SELECT region_rep_2024, region_final, COUNT(*) AS n FROM audited GROUP BY ALL", "audited"),
)
def contingency(spark, sf):
    return audit.contingency(audited(spark, sf), "region_rep_2024", "region_final")


@query(
    "A22_first_and_last",
    sql(
        """SELECT seccion, CAST(first(pt ORDER BY pidx) AS BIGINT) AS primero, CAST(last(pt ORDER BY pidx) AS BIGINT) AS ultimo
FROM (SELECT pidx, seccion, COUNT(*) AS pt FROM panel GROUP BY ALL) GROUP BY seccion""",
        "panel",
    ),
)
def first_and_last(spark, sf):
    cells = roles.panel(spark, sf).groupBy("pidx", "seccion").agg(F.count("*").alias("pt"))
    return cells.groupBy("seccion").agg(
        F.min_by("pt", "pidx").alias("primero"), F.max_by("pt", "pidx").alias("ultimo")
    )


@query(
    "A23_latest_total",
    sql("SELECT SUM(monto) AS total FROM panel WHERE pidx = (SELECT MAX(pidx) FROM panel)", "panel").replace(
        "SUM(monto) AS total", "round(SUM(monto), 2) + 0.0 AS total"
    ),
)
def latest_total(spark, sf):
    rows = roles.panel(spark, sf).select(F.col("pidx").alias("periodo"), "monto")
    return rounded(reports.at_last_period(rows).agg(F.sum("monto").alias("total")), 2)


# --- order and set operations ---------------------------------------------------------


@query("O01_order_by_period", sql("SELECT * FROM fx_long", "fx_long"))
def order_by_period(spark, sf):
    return reports.in_order(rounded(indicators_fixed(spark, sf)), S.CLASSES)


@query(
    "O02_leader",
    sql(
        f"""SELECT pidx, seccion, {R('valor', decimals=2)} FROM (SELECT *, rank() OVER (PARTITION BY pidx ORDER BY valor DESC) AS r
FROM (SELECT pidx, seccion, round(SUM(monto), 2) AS valor FROM panel GROUP BY ALL)) WHERE r = 1""",
        "panel",
    ),
)
def leader(spark, sf):
    sums = roles.panel(spark, sf).groupBy("pidx", "seccion").agg(F.round(F.sum("monto"), 2).alias("valor"))
    return rounded(reports.leaders(sums, "valor", ["pidx"]), 2)


@query(
    "O03_arg_min",
    sql(
        "SELECT seccion, arg_min(pidx, pt * 100000 + pidx) AS pidx FROM (SELECT pidx, seccion, COUNT(*) AS pt FROM panel GROUP BY ALL) GROUP BY seccion",
        "panel",
    ),
)
def arg_min(spark, sf):
    cells = roles.panel(spark, sf).groupBy("pidx", "seccion").agg(F.count("*").alias("aic"))
    fits = cells.withColumnRenamed("pidx", "lag")
    return grouped_stats.best_lag(fits, ["seccion"]).select("seccion", F.col("lag").alias("pidx"))


@query(
    "O04_order_by_count",
    sql(
        """SELECT p.worker_id, firm_id, COUNT(DISTINCT pidx) AS tt FROM panel p LEFT JOIN registries r ON p.worker_id = r.worker_id
WHERE nacionalidad_rep_2024 IS NULL AND anno = 1999 GROUP BY p.worker_id, firm_id ORDER BY tt DESC""",
        "panel", "registries",
    ),
)
def order_by_count(spark, sf):
    rows = audit.with_registry(roles.panel(spark, sf), registries(spark, sf))
    return audit.missing_months_per_job(rows, "nacionalidad_rep_2024", 1999).orderBy(F.col("tt").desc())


@query(
    "U01_union_registries",
    sql(
        """SELECT person_id, sexo, codigo_region FROM r24 UNION ALL
SELECT person_id, sexo_rc, codigo_region_rc FROM registry25 WHERE person_id NOT IN (SELECT person_id FROM r24)""",
        "r24", "registry25",
    ),
)
def union_registries(spark, sf):
    first = persons.registry_2024(roles.demographic(spark, sf), roles.geographic(spark, sf))
    late = persons.registry_2025(roles.registry25(spark, sf))
    both = first.unionByName(persons.only_in_second(late, first))
    return both.select("person_id", "sexo", "codigo_region")


@query(
    "U02_observed_and_imputed",
    sql("SELECT is_imputed, CAST(pidx AS INT) AS pidx, COUNT(*) AS n FROM imputed GROUP BY ALL", "imputed"),
)
def observed_and_imputed(spark, sf):
    rows = impute.impute_gaps(gap_input(spark, sf), roles.periods(spark, sf))
    return rows.groupBy("is_imputed", "pidx").agg(F.count("*").alias("n"))


@query(
    "U03_union_with_missing_columns",
    sql(
        """SELECT pidx, sexo, NULL AS seccion, COUNT(*) AS pt FROM panel GROUP BY pidx, sexo
UNION ALL SELECT pidx, NULL, seccion, COUNT(*) FROM panel GROUP BY pidx, seccion""",
        "panel",
    ),
)
def union_with_missing_columns(spark, sf):
    panel = roles.panel(spark, sf)
    by_sex = panel.groupBy("pidx", "sexo").agg(F.count("*").alias("pt"))
    by_section = panel.groupBy("pidx", "seccion").agg(F.count("*").alias("pt"))
    return by_sex.unionByName(by_section, allowMissingColumns=True)


@query(
    "U04_common_names",
    sql(
        """SELECT 'seccion' AS tabla, COUNT(*) AS n FROM panel WHERE ep = 1 UNION ALL SELECT 'sexo', COUNT(*) FROM panel""",
        "panel",
    ),
)
def common_names(spark, sf):
    panel = roles.panel(spark, sf)
    first = {"sexo": panel, "seccion": panel.filter("ep = 1")}
    second = {"seccion": panel, "region": panel, "sexo": panel}
    one, other = [
        first[n].agg(F.count("*").alias("n")).withColumn("tabla", F.lit(n))
        for n in bundle.common_names(first, second)
    ]
    return one.unionByName(other)
