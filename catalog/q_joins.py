"""J rows: joins, each as its own query in the shape the library uses."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from catalog import roles
from catalog.q_composites import (
    ALL,
    audited,
    both_sources,
    compared_sql,
    enriched,
    gap_input,
    heads,
    jobs,
    mass,
    public_tables,
    total_base,
)
from catalog.registry import R, query, rounded, sql
from laborlens import schema as S
from laborlens.functions import periods as P
from laborlens.functions import scalars as X
from laborlens.operators import (
    clean,
    firm_size,
    flows,
    impute,
    indicators,
    migration,
    persons,
    public_jobs,
    reconcile,
    tax_credit,
    wage_index,
)
from laborlens.sources import lookups

KEYS = ["worker_id", "firm_id", "pidx"]


@query(
    "J01_dates_left",
    sql(
        """SELECT worker_id, firm_id, anno, mes, monto, r.fecha_nac, r.fecha_def_cor_rc FROM raw
LEFT JOIN persons r ON worker_id = person_id""",
        "raw", "persons",
    ),
)
def dates_left(spark, sf):
    rows = roles.raw(spark, sf).select("worker_id", "firm_id", "anno", "mes", "monto")
    return clean.join_dates(rows, roles.persons(spark, sf))


@query(
    "J02_caps_left",
    sql(
        "SELECT worker_id, firm_id, pidx, tope FROM panel p LEFT JOIN caps c ON p.anno = c.anno AND p.mes = c.mes",
        "panel", "caps",
    ),
)
def caps_left(spark, sf):
    joined = gap_input(spark, sf).join(P.by_month(roles.caps(spark, sf)), ["anno", "mes"], "left")
    return joined.select(*KEYS, "tope")


@query(
    "J03_star_enrichment",
    sql(
        """SELECT worker_id, firm_id, pidx, sexo, nacionalidad, seccion, division, comuna_cut, sector_institucional,
  tamano, nc_moda, region_trabajador FROM enriched""",
        "enriched",
    ),
)
def star_enrichment(spark, sf):
    return enriched(spark, sf).select(
        *KEYS, "sexo", "nacionalidad", "seccion", "division", "comuna_cut", "sector_institucional",
        "tamano", "nc_moda", "region_trabajador",
    )


@query("J04_registries_full", sql("SELECT * FROM r24", "r24"))
def registries_full(spark, sf):
    return persons.registry_2024(roles.demographic(spark, sf), roles.geographic(spark, sf))


@query(
    "J05_donor_full",
    sql(
        """SELECT COALESCE(person_id, worker_id) AS person_id,
  CASE WHEN sexo IS NULL OR sexo NOT IN (1, 2) THEN sexo_final ELSE sexo END AS sexo
FROM demographic FULL JOIN sex_donor ON person_id = worker_id""",
        "demographic", "sex_donor",
    ),
)
def donor_full(spark, sf):
    donor = roles.sex_donor(spark, sf).withColumnRenamed("worker_id", "person_id")
    joined = roles.demographic(spark, sf).join(donor, "person_id", "full")
    return joined.select("person_id", X.valid_sex("sexo", "sexo_final").alias("sexo"))


def _late(spark, sf):
    return persons.registry_2025(roles.registry25(spark, sf))


@query(
    "J06_only_in_second",
    sql(
        """SELECT person_id, sexo_rc AS sexo FROM registry25
WHERE NOT EXISTS (SELECT 1 FROM demographic d WHERE d.person_id = registry25.person_id)""",
        "registry25", "demographic",
    ),
)
def only_in_second(spark, sf):
    return persons.only_in_second(_late(spark, sf), roles.demographic(spark, sf)).select("person_id", "sexo")


@query(
    "J07_drop_excluded",
    sql(
        """SELECT worker_id, firm_id, pidx, monto, dias FROM panel p WHERE NOT EXISTS (SELECT 1 FROM exclusions x
WHERE x.worker_id = p.worker_id AND x.firm_id = p.firm_id AND x.anno = p.anno AND x.mes = p.mes)""",
        "panel", "exclusions",
    ),
)
def drop_excluded(spark, sf):
    kept = clean.drop_excluded(gap_input(spark, sf), roles.exclusions(spark, sf))
    return kept.select(*KEYS, "monto", "dias")


@query(
    "J08_neighbours_inner",
    sql(
        """SELECT a.worker_id, a.firm_id, CAST(a.pidx AS INT) AS pidx, a.dias AS dias_ant, b.dias AS dias_sig
FROM panel a JOIN panel b ON a.worker_id = b.worker_id AND a.firm_id = b.firm_id AND b.pidx = a.pidx + 2""",
        "panel",
    ),
)
def neighbours_inner(spark, sf):
    w = W.partitionBy(*S.JOB).orderBy("pidx").rangeBetween(2, 2)
    rows = gap_input(spark, sf).select(*KEYS, F.col("dias").alias("dias_ant"), F.max("dias").over(w).alias("dias_sig"))
    return rows.filter("dias_sig is not null")


@query(
    "J09_absent_between",
    sql("SELECT worker_id, firm_id, CAST(pidx AS INT) AS pidx FROM imputed_rows", "imputed_rows"),
)
def absent_between(spark, sf):
    filled = impute.impute_gaps(gap_input(spark, sf), roles.periods(spark, sf))
    return filled.filter("is_imputed").select(*KEYS)


@query(
    "J10_range_look_back",
    sql(
        """SELECT a.firm_id, a.pidx, COUNT(*) AS meses, CAST(SUM(b.n_trabajadores) AS BIGINT) AS suma
FROM heads a JOIN heads b ON a.firm_id = b.firm_id AND b.pidx > a.pidx - 12 AND b.pidx <= a.pidx
GROUP BY a.firm_id, a.pidx""",
        "heads",
    ),
)
def range_look_back(spark, sf):
    w = W.partitionBy("firm_id").orderBy("pidx").rangeBetween(-11, 0)
    return heads(spark, sf).select(
        "firm_id", "pidx", F.count("*").over(w).alias("meses"), F.sum("n_trabajadores").over(w).alias("suma")
    )


@query(
    "J11_moving_size_left",
    sql(
        f"""SELECT p.worker_id, p.firm_id, p.pidx, pt, {R('media_movil_12m')}, tamano_empresa_movil
FROM supplier_panel p LEFT JOIN moving_size m
  ON p.firm_id = m.firm_id AND p.pidx = m.pidx""",
        "supplier_panel", "moving_size",
    ),
)
def moving_size_left(spark, sf):
    moving = firm_size.moving_size(heads(spark, sf))
    sized = firm_size.with_moving_size(roles.supplier_panel(spark, sf), moving)
    return rounded(sized.drop("anno", "mes"))


@query(
    "J12_entries_and_exits",
    sql(
        """SELECT 'entrada' AS tipo_flujo, CAST(pidx_t AS INT) AS pidx, sexo, COUNT(*) AS n FROM entries GROUP BY ALL
UNION ALL SELECT 'salida', CAST(pidx_t AS INT), sexo, COUNT(*) FROM exits GROUP BY ALL""",
        "entries", "exits",
    ),
)
def entries_and_exits(spark, sf):
    events = flows.flow_events(jobs(spark, sf), ["sexo"], periods=roles.periods(spark, sf))
    return events.groupBy("tipo_flujo", "pidx", "sexo").agg(F.count("*").alias("n"))


@query(
    "J13_stayers",
    sql(
        """SELECT CAST(pidx_t AS INT) AS pidx, tamano_empresa_movil_t AS ahora, tamano_empresa_movil_t12 AS antes,
  COUNT(*) AS n FROM stayers GROUP BY ALL""",
        "stayers",
    ),
)
def stayers(spark, sf):
    state = flows.year_apart(
        jobs(spark, sf), ["tamano_empresa_movil"], roles.periods(spark, sf), with_before=True
    )
    kept = state.filter("was_here AND has_past")
    return kept.groupBy(
        "pidx", F.col("tamano_empresa_movil").alias("ahora"), F.col("before.tamano_empresa_movil").alias("antes")
    ).agg(F.count("*").alias("n"))


@query(
    "J14_null_safe_classes",
    sql(
        """SELECT COALESCE(e.pidx, s.pidx) AS pidx, COALESCE(e.region_final, s.region_final) AS region_final,
  COALESCE(e.tamano_empresa_movil, s.tamano_empresa_movil) AS tamano_empresa_movil,
  COALESCE(pt_ent_12, 0) AS pt_ent_12, COALESCE(pt_sal_12, 0) AS pt_sal_12
FROM (SELECT CAST(pidx_t AS INT) AS pidx, region_final, tamano_empresa_movil, COUNT(*) AS pt_ent_12 FROM entries GROUP BY ALL) e
FULL JOIN (SELECT CAST(pidx_t AS INT) AS pidx, region_final, tamano_empresa_movil, COUNT(*) AS pt_sal_12 FROM exits GROUP BY ALL) s
ON e.pidx = s.pidx AND e.region_final IS NOT DISTINCT FROM s.region_final
  AND e.tamano_empresa_movil IS NOT DISTINCT FROM s.tamano_empresa_movil""",
        "entries", "exits",
    ),
)
def null_safe_classes(spark, sf):
    classes = ["region_final", "tamano_empresa_movil"]
    return flows.flows_fixed(jobs(spark, sf), classes, roles.periods(spark, sf))


@query(
    "J15_stock_and_flows",
    sql(
        f"SELECT tabla, CAST(pidx AS INT) AS pidx, {ALL}, pt, pt_ent_12, pt_sal_12 FROM fx_base",
        "fx_base",
    ),
)
def stock_and_flows(spark, sf):
    return total_base(spark, sf)[0]


@query(
    "J16_shifted_total",
    sql(
        f"""SELECT b.tabla, CAST(b.pidx AS INT) AS pidx, {ALL}, b.pt, pt_ent_12, pt_sal_12, t.pt AS pt_total_12 FROM fx_base b
LEFT JOIN (SELECT pidx + 12 AS pidx, pt FROM stock_long WHERE tabla = 'total') t ON b.pidx = t.pidx""",
        "fx_base", "stock_long",
    ),
)
def shifted_total(spark, sf):
    base, total = total_base(spark, sf)
    return base.join(P.by_month(total), "pidx", "left")


@query("J17_two_sources_inner", sql(f"SELECT * FROM ({compared_sql()}) WHERE comparacion = 'sexo'", "fx_long"))
def two_sources_inner(spark, sf):
    """The comparison by sex alone, as an inner join of two tables would give it."""
    only = {"sexo": reconcile.CATALOGUE["sexo"]}
    both = both_sources(spark, sf)
    others = [F.lit(None).cast(t).alias(c) for c, t in both.dtypes if c in S.CLASSES and c != "sexo"]
    return rounded(reconcile.fold(both, only)).select("*", *others)


@query(
    "J18_four_counts",
    sql(
        """SELECT CAST(pidx // 12 AS INT) AS anno, CAST(pidx % 12 + 1 AS INT) AS mes, sexo, nacionalidad_final,
  i AS "In", e AS "Em", l12 AS "L_t12", l AS "L_t" FROM migr WHERE desagregacion = 'tramo_edad_2 x sexo x nacionalidad_final'""",
        "migr",
    ).replace("sexo, nacionalidad_final,\n", "tramo_edad_2, sexo, nacionalidad_final,\n"),
)
def four_counts(spark, sf):
    combo = ["tramo_edad_2", "sexo", "nacionalidad_final"]
    out = migration.migration_rates(jobs(spark, sf, combo), [combo], roles.periods(spark, sf))
    return out.select("anno", "mes", *combo, *migration.COUNTS)


@query(
    "J19_last_record_per_key",
    sql(
        """SELECT r.worker_id, r.pidx, MAX(r.monto) AS monto FROM panel r
JOIN (SELECT worker_id, MAX(pidx) AS pidx FROM panel GROUP BY worker_id) m
  ON r.worker_id = m.worker_id AND r.pidx = m.pidx GROUP BY r.worker_id, r.pidx""",
        "panel",
    ),
)
def last_record_per_key(spark, sf):
    best = F.max(F.struct("pidx", "monto")).alias("m")
    return roles.panel(spark, sf).groupBy("worker_id").agg(best).select("worker_id", "m.pidx", "m.monto")


@query(
    "J20_breakdown_and_total",
    sql(
        """SELECT d.*, t.pt AS pt_tot FROM public_long d
LEFT JOIN (SELECT pidx, pt FROM public_long WHERE tabla = 'total') t ON d.pidx = t.pidx""",
        "public_long",
    ),
)
def breakdown_and_total(spark, sf):
    tables = public_tables(spark, sf)
    return public_jobs.with_total(tables, tables.filter("tabla = 'total'"))


@query(
    "J21_price_index_left",
    sql(
        f"SELECT m.pidx, {R('ipc')}, {R('masa_salarial_real', decimals=4)} FROM real m",
        "real",
    ),
)
def price_index_left(spark, sf):
    real = wage_index.deflated(mass(spark, sf), roles.prices(spark, sf))
    return rounded(rounded(real.select("pidx", "ipc", "masa_salarial_real"), 4, skip=("ipc",)))


NATIONAL = ["iilf", "iilf_ajustado", "payroll_index", "wage_index", "labor_intensity_index",
            "var_mensual_iilf", "var_anual_iilf"]


@query(
    "J21_master_table",
    sql(
        f"""SELECT m.pidx, {', '.join(R('m.' + c, c, 4) for c in NATIONAL)}, {R('ipc')}, u.utm AS utm
FROM indexed_var m LEFT JOIN params u ON m.pidx = u.pidx""",
        "indexed_var", "params",
    ),
)
def master_table(spark, sf):
    prices = roles.prices(spark, sf)
    index = wage_index.wage_index(mass(spark, sf), prices, base_year=1998)
    params = roles.parameters(spark, sf).select("pidx", "utm")
    return rounded(rounded(wage_index.master_table(index, prices, params), 4, skip=("ipc", "utm")))


@query("J22_attributes_of_three_sources", sql("SELECT * FROM audited", "audited"))
def attributes_of_three_sources(spark, sf):
    return audited(spark, sf)


@query(
    "J23_year_month_grid",
    sql(
        "SELECT anno, CAST(m AS INT) AS mes FROM (SELECT DISTINCT anno FROM periods) CROSS JOIN range(1, 13) r(m)",
        "periods",
    ),
)
def year_month_grid(spark, sf):
    return lookups.year_months(roles.periods(spark, sf))


@query(
    "J24_parameter_lookup",
    sql(
        f"""SELECT worker_id, firm_id, panel.pidx AS pidx, {R('7.8 * utm', 'li')}, {R('12 * utm', 'ls')}
FROM panel LEFT JOIN params ON panel.pidx = params.pidx""",
        "panel", "params",
    ),
)
def parameter_lookup(spark, sf):
    low, high = X.credit_bounds("utm")
    rows = tax_credit.with_parameters(roles.panel(spark, sf).select(*KEYS), roles.parameters(spark, sf))
    return rounded(rows.select(*KEYS, low.alias("li"), high.alias("ls")))
