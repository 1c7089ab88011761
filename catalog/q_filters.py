"""F rows: filters and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import roles
from catalog.q_composites import BULLETIN_SQL, bulletin_source
from catalog.registry import query, rounded, sql
from laborlens.functions import periods as P
from laborlens.functions import scalars as X
from laborlens import schema as S
from laborlens.operators import audit, clean, persons, reconcile, reports, tax_credit
from laborlens.sources import tables

JOB_KEYS = ["worker_id", "firm_id", "pidx"]


@query("F01_worker_type", sql("SELECT worker_id, firm_id, anno, mes, monto FROM raw WHERE tipo_trabajador = 1", "raw"))
def worker_type(spark, sf):
    return clean.of_type(roles.raw(spark, sf), 1).select("worker_id", "firm_id", "anno", "mes", "monto")


@query(
    "F02_from_period",
    sql("SELECT worker_id, anno, mes, monto FROM raw WHERE anno > 1998 OR (anno = 1998 AND mes >= 11)", "raw"),
)
def from_period(spark, sf):
    rows = roles.raw(spark, sf).filter(P.from_period((1998, 11)))
    return rows.select("worker_id", "anno", "mes", "monto")


def _with_dates(spark, sf):
    jobs = roles.panel(spark, sf).select("worker_id", "firm_id", "anno", "mes", "pidx")
    return clean.join_dates(jobs, roles.persons(spark, sf))


@query(
    "F03_age_range",
    sql(
        """SELECT worker_id, firm_id, p.pidx FROM panel p LEFT JOIN persons r ON worker_id = person_id
WHERE ((anno - year(r.fecha_nac)) * 12 + (mes - month(r.fecha_nac)) >= 180
  AND (anno - year(r.fecha_nac)) * 12 + (mes - month(r.fecha_nac)) < 1080)
  OR r.fecha_nac IS NULL""",
        "panel", "persons",
    ),
)
def age_range(spark, sf):
    return clean.of_age(_with_dates(spark, sf), 15, 90).select(*JOB_KEYS)


@query(
    "F04_alive",
    sql(
        """SELECT worker_id, firm_id, pidx FROM panel LEFT JOIN persons ON worker_id = person_id
WHERE fecha_def_cor_rc IS NULL
  OR (anno - year(fecha_def_cor_rc)) * 12 + (mes - month(fecha_def_cor_rc)) <= 0""",
        "panel", "persons",
    ),
)
def alive(spark, sf):
    return clean.alive(_with_dates(spark, sf)).select(*JOB_KEYS)


@query(
    "F05_valid_code",
    sql(
        """SELECT person_id, codigo_region, CASE WHEN code NOT IN (17, 88, 99) AND codigo_region IS NOT NULL
  THEN code END AS region FROM (SELECT *, TRY_CAST(codigo_region AS INT) AS code FROM geographic)""",
        "geographic",
    ),
)
def valid_code(spark, sf):
    return roles.geographic(spark, sf).select(
        "person_id", "codigo_region", X.known_code("codigo_region", S.REGION_UNKNOWN).alias("region")
    )


@query(
    "F06_eligible_jobs",
    sql(
        """SELECT worker_id, firm_id, pidx, tamano, seccion FROM panel
WHERE tamano <> 'unipersonal' AND (seccion NOT IN ('T', 'U') OR seccion IS NULL)""",
        "panel",
    ),
)
def eligible_jobs(spark, sf):
    return roles.panel(spark, sf).filter(tables.eligible()).select(*JOB_KEYS, "tamano", "seccion")


@query("F07_public_flag", sql("SELECT worker_id, firm_id, pidx FROM panel WHERE ep = 1", "panel"))
def public_flag(spark, sf):
    return roles.panel(spark, sf).filter("ep = 1").select(*JOB_KEYS)


@query("F07_private_flag", sql("SELECT worker_id, firm_id, pidx FROM panel WHERE ep = 0", "panel"))
def private_flag(spark, sf):
    return roles.panel(spark, sf).filter("ep = 0").select(*JOB_KEYS)


@query(
    "F08_pay_interval",
    sql(
        """SELECT worker_id, firm_id, panel.pidx, monto FROM panel JOIN params USING (pidx)
WHERE monto >= 7.8 * utm AND monto <= 12 * utm""",
        "panel", "params",
    ),
)
def pay_interval(spark, sf):
    jobs = roles.panel(spark, sf).select(*JOB_KEYS, "monto")
    low, high = X.credit_bounds("utm")
    paid = tax_credit.with_parameters(jobs, roles.parameters(spark, sf))
    return paid.filter(F.col("monto").between(low, high)).select(*JOB_KEYS, "monto")


@query(
    "F09_consistent_sex",
    sql(
        """SELECT worker_id, anno * 100 + mes AS periodo, MIN(sexo) AS sexo_final FROM raw
GROUP BY worker_id, anno, mes HAVING MIN(sexo) = MAX(sexo)""",
        "raw",
    ),
)
def consistent_sex(spark, sf):
    return persons.consistent_sex(roles.raw(spark, sf))


def _pay_long(spark, sf):
    jobs = roles.panel(spark, sf).select(
        "worker_id", "firm_id", "pidx", "region_final", "tamano_empresa_movil",
        F.when(F.col("monto") > 20000, F.col("monto")).alias("valor"),
    )
    return jobs


@query(
    "F10_drop_missing",
    sql(
        """SELECT worker_id, firm_id, pidx, region_final, tamano_empresa_movil, monto AS valor FROM panel
WHERE monto > 20000 AND region_final IS NOT NULL AND tamano_empresa_movil IS NOT NULL""",
        "panel",
    ),
)
def drop_missing(spark, sf):
    return reconcile.drop_missing(_pay_long(spark, sf), ["region_final", "tamano_empresa_movil"])


@query(
    "F11_bulletin_filter",
    BULLETIN_SQL,
)
def bulletin_filter(spark, sf):
    """The eight publication tables one by one, each with its own indicators, classes and order."""
    long, out = tables.stage(rounded(bulletin_source(spark, sf))), None
    for name, (source, column, indicators, public) in reports.BULLETIN.items():
        rows = reports.bulletin_table(long.filter(F.col("tabla") == source), indicators, column, public)
        group = F.col(column).cast("string") if column else F.lit(None).cast("string")
        part = rows.select(F.lit(name).alias("cuadro"), "anno", "mes", group.alias("clase"), "indicador", "valor")
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "F12_flow_subset",
    sql("SELECT * FROM flows_mobile WHERE tipo_flujo IN ('entrada', 'salida')", "flows_mobile"),
)
def flow_subset(spark, sf):
    from catalog.q_composites import mobile_cells

    return mobile_cells(spark, sf).filter(F.col("tipo_flujo").isin("entrada", "salida"))


@query(
    "F13_missing_attribute",
    sql(
        """SELECT worker_id, firm_id, pidx FROM panel LEFT JOIN geographic ON worker_id = person_id
WHERE codigo_region IS NULL""",
        "panel", "geographic",
    ),
)
def missing_attribute(spark, sf):
    jobs = roles.panel(spark, sf).select(*JOB_KEYS)
    geo = roles.geographic(spark, sf).select(
        F.col("person_id").alias("worker_id"), F.col("codigo_region").alias("region_rep_2024")
    )
    return audit.missing(jobs.join(geo, "worker_id", "left"), "region_rep_2024").select(*JOB_KEYS)


@query(
    "F14_years_and_months",
    sql(
        """SELECT anno, mes, worker_id, firm_id, CAST(anno AS VARCHAR) || '-' || lpad(CAST(mes AS VARCHAR), 2, '0')
  AS periodo FROM panel WHERE anno BETWEEN 1996 AND 1999 AND mes IN (1, 6, 12)""",
        "panel",
    ),
)
def years_and_months(spark, sf):
    jobs = roles.panel(spark, sf).select("anno", "mes", "worker_id", "firm_id")
    return reports.selected_months(jobs, (1996, 1999), [1, 6, 12])


@query(
    "F15_last_and_year_before",
    sql(
        """SELECT make_date(anno, mes, 1) AS fecha, seccion, count(*) AS pt FROM panel
WHERE pidx IN ((SELECT max(pidx) FROM panel), (SELECT max(pidx) - 12 FROM panel)) GROUP BY anno, mes, seccion""",
        "panel",
    ),
)
def last_and_year_before(spark, sf):
    cells = roles.panel(spark, sf).groupBy("pidx", "seccion").agg(F.count("*").alias("pt"))
    dated = cells.select(P.month_start("pidx").alias("fecha"), "seccion", "pt")
    return reports.last_and_year_before(dated)


@query(
    "F16_single_period",
    sql("SELECT worker_id, firm_id, monto FROM panel WHERE anno = 1999 AND mes = 12", "panel"),
)
def single_period(spark, sf):
    return roles.panel(spark, sf).filter("anno = 1999 AND mes = 12").select("worker_id", "firm_id", "monto")
