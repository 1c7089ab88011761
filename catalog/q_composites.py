"""D rows: domain operators, with check SQL written from their definitions."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import roles
from catalog.registry import R, cte, query, rounded, sql
from laborlens import schema as S
from laborlens.functions import scalars as X
from laborlens.operators import (
    audit,
    clean,
    enrich,
    firm_size,
    flows,
    impute,
    indicators,
    migration,
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

ALL = ", ".join(S.CLASSES)
JOB_COLS = ["worker_id", "firm_id", "pidx"]


def jobs(spark, sf, cols=None):
    """Eligible jobs of the panel (its key is unique)."""
    return tables.read_jobs(roles.panel(spark, sf), cols or S.CLASSES, unique_key=True)


cte(
    "jobs",
    """SELECT * FROM panel WHERE tamano <> 'unipersonal' AND (seccion NOT IN ('T', 'U') OR seccion IS NULL)""",
    "panel",
)

# --- persons -----------------------------------------------------------------------


@query(
    "D01_persons",
    sql(
        """, r24 AS (SELECT COALESCE(d.person_id, g.person_id) AS person_id, d.sexo,
    CASE WHEN nacionalidad = 3 THEN 1 ELSE nacionalidad END AS nacionalidad,
    fecha_nac, fecha_def_cor_rc, codigo_region, codigo_comuna
  FROM demographic d FULL JOIN geographic g ON d.person_id = g.person_id),
late AS (SELECT person_id, sexo_rc AS sexo,
    CASE nacionalidad_rc WHEN 2 THEN 1 WHEN 3 THEN 2 ELSE nacionalidad_rc END AS nacionalidad,
    fecha_nac_cor_rc AS fecha_nac, fecha_def_cor_rc, codigo_region_rc AS codigo_region,
    codigo_comuna_rc AS codigo_comuna
  FROM registry25 WHERE person_id NOT IN (SELECT person_id FROM r24)),
both_r AS (SELECT * FROM r24 UNION ALL SELECT * FROM late)
SELECT COALESCE(b.person_id, s.worker_id) AS person_id, fecha_nac, fecha_def_cor_rc,
  CASE WHEN sexo IS NULL OR sexo NOT IN (1, 2) THEN sexo_final ELSE sexo END AS sexo,
  nacionalidad, codigo_region, codigo_comuna
FROM both_r b FULL JOIN sex_donor s ON b.person_id = s.worker_id""",
        "demographic", "geographic", "registry25", "sex_donor",
    ).replace("\n, r24", ",\nr24"),
)
def d01(spark, sf):
    return persons.persons(
        roles.demographic(spark, sf), roles.geographic(spark, sf),
        roles.registry25(spark, sf), roles.sex_donor(spark, sf),
    )


cte(
    "consistent",
    """SELECT worker_id, anno * 100 + mes AS periodo, MIN(sexo) AS sexo_final FROM raw
GROUP BY worker_id, anno, mes HAVING MIN(sexo) = MAX(sexo)""",
    "raw",
)


@query(
    "D01b_last_consistent_sex",
    sql(
        """SELECT c.worker_id, c.periodo, c.sexo_final FROM consistent c
JOIN (SELECT worker_id, MAX(periodo) AS periodo FROM consistent GROUP BY worker_id) m
  ON c.worker_id = m.worker_id AND c.periodo = m.periodo""",
        "consistent",
    ),
)
def d01b(spark, sf):
    return persons.last_consistent_sex(roles.raw(spark, sf))


# --- panel ---------------------------------------------------------------------------

cte(
    "consolidated",
    """SELECT worker_id, firm_id, anno, mes, tipo_trabajador,
  SUM(CASE WHEN tp IN (2, 3) THEN 0 ELSE monto END) AS monto,
  CAST(CASE WHEN SUM(CASE WHEN tp IN (2, 3) THEN 0 ELSE dias END) > 30 THEN 30
       ELSE SUM(CASE WHEN tp IN (2, 3) THEN 0 ELSE dias END) END AS INT) AS dias
FROM (SELECT DISTINCT worker_id, firm_id, anno, mes, tipo_trabajador, COALESCE(tipo_pago, 1) AS tp,
        monto, dias, codigo_mutual FROM raw)
GROUP BY ALL""",
    "raw",
)


@query(
    "D02b_consolidate_jobs",
    sql(f"SELECT * REPLACE ({R('monto', decimals=2)}) FROM consolidated", "consolidated"),
)
def d02b(spark, sf):
    return rounded(clean.consolidate_jobs(roles.raw(spark, sf)), 2)


def preprocessed(spark, sf):
    return clean.preprocess(
        roles.raw(spark, sf), roles.persons(spark, sf), roles.exclusions(spark, sf), (1996, 11)
    )


cte(
    "consolidated_1",
    """SELECT worker_id, firm_id, anno, mes, tipo_trabajador,
  round(SUM(CASE WHEN tp IN (2, 3) THEN 0 ELSE monto END), 2) AS monto,
  CAST(LEAST(30, SUM(CASE WHEN tp IN (2, 3) THEN 0 ELSE dias END)) AS INT) AS dias
FROM (SELECT DISTINCT worker_id, firm_id, anno, mes, tipo_trabajador, COALESCE(tipo_pago, 1) AS tp,
        monto, dias, codigo_mutual
      FROM raw LEFT JOIN persons r ON worker_id = person_id
      WHERE tipo_trabajador = 1 AND (anno > 1996 OR (anno = 1996 AND mes >= 11))
        AND (r.fecha_nac IS NULL OR
             ((anno - year(r.fecha_nac)) * 12 + (mes - month(r.fecha_nac)) >= 180
              AND (anno - year(r.fecha_nac)) * 12 + (mes - month(r.fecha_nac)) < 1080))
        AND (fecha_def_cor_rc IS NULL
             OR (anno - year(fecha_def_cor_rc)) * 12 + (mes - month(fecha_def_cor_rc)) <= 0))
GROUP BY ALL""",
    "raw", "persons",
)
cte(
    "preprocessed",
    """SELECT c.* FROM consolidated_1 c WHERE NOT EXISTS (SELECT 1 FROM exclusions x
  WHERE x.worker_id = c.worker_id AND x.firm_id = c.firm_id AND x.anno = c.anno AND x.mes = c.mes)""",
    "consolidated_1", "exclusions",
)


@query("D02_preprocess", sql("SELECT * FROM preprocessed", "preprocessed"))
def d02(spark, sf):
    return rounded(preprocessed(spark, sf), 2)


def gap_input(spark, sf):
    return roles.panel(spark, sf).select("worker_id", "firm_id", "anno", "mes", "pidx", "monto", "dias")


def filled(value: str, later: str, whole: bool = False) -> str:
    """Value of a gap: half the sum of two positive neighbours, else the larger, an absent one counting 0."""
    half = f"({value} + {later}) / 2.0"
    half = f"CAST(round_even({half}, 0) AS INT)" if whole else half
    either = f"COALESCE({value}, 0), COALESCE({later}, 0)"
    return f"if(LEAST({either}) > 0, {half}, GREATEST({either}))"


def gap_rows(source: str, place: str) -> str:
    """Rows of ``source`` for the one step of ``place`` that a job leaves out, from its next row."""
    return f"""SELECT worker_id, firm_id, {place} + 1 AS step, {filled('monto', 'monto_b')} AS monto,
  {filled('dias', 'dias_b', whole=True)} AS dias
FROM (SELECT *, LEAD({place}) OVER job AS place_b, LEAD(monto) OVER job AS monto_b, LEAD(dias) OVER job AS dias_b
      FROM {source} WINDOW job AS (PARTITION BY worker_id, firm_id ORDER BY {place}))
WHERE place_b = {place} + 2"""


cte("placed", "SELECT panel.*, pos FROM panel JOIN numbered USING (pidx)", "panel", "numbered")
cte(
    "imputed_rows",
    f"SELECT g.worker_id, g.firm_id, n.pidx, g.monto, g.dias FROM ({gap_rows('placed', 'pos')}) g JOIN numbered n ON n.pos = g.step",
    "placed",
)
cte(
    "imputed",
    """SELECT worker_id, firm_id, pidx, monto, dias, FALSE AS is_imputed FROM panel
UNION ALL SELECT worker_id, firm_id, pidx, monto, dias, TRUE FROM imputed_rows""",
    "imputed_rows",
)
ANNO_MES = "CAST(pidx // 12 AS INT) AS anno, CAST(pidx % 12 + 1 AS INT) AS mes"


@query(
    "D03_impute_gaps",
    sql(
        f"""SELECT worker_id, firm_id, {ANNO_MES}, CAST(pidx AS INT) AS pidx, {R('monto', decimals=3)}, dias,
  is_imputed FROM imputed""",
        "imputed",
    ),
)
def d03(spark, sf):
    return rounded(impute.impute_gaps(gap_input(spark, sf), roles.periods(spark, sf)), 3)


cte(
    "capped",
    """SELECT p.worker_id, p.firm_id, p.anno, p.mes, p.pidx, p.dias,
  CASE WHEN monto > tope THEN CAST(tope AS DOUBLE) WHEN NOT monto > tope THEN monto END AS monto
FROM panel p LEFT JOIN caps c ON p.anno = c.anno AND p.mes = c.mes""",
    "panel", "caps",
)


@query(
    "D03_cap_and_impute",
    sql(
        f"""SELECT worker_id, firm_id, {ANNO_MES}, CAST(pidx AS INT) AS pidx, {R('monto', decimals=3)}, dias, is_imputed
FROM (SELECT worker_id, firm_id, pidx, monto, dias, FALSE AS is_imputed FROM capped
UNION ALL SELECT worker_id, firm_id, step, monto, dias, TRUE FROM ({gap_rows('capped', 'pidx')}))""",
        "capped",
    ),
)
def d03_capped(spark, sf):
    caps = roles.caps(spark, sf)
    panel = clean.cap_pay(gap_input(spark, sf), caps)
    return rounded(impute.impute_gaps(panel, roles.periods(spark, sf), calendar=True), 3)


# --- firm size -------------------------------------------------------------------------

cte(
    "heads",
    """SELECT firm_id, pidx, COUNT(DISTINCT worker_id) AS n_trabajadores FROM supplier_panel
GROUP BY firm_id, pidx""",
    "supplier_panel",
)
cte(
    "static_size",
    """SELECT firm_id, CAST(pt AS BIGINT) AS pt, t, pt * 1.0 / t AS media_pt,
  CASE WHEN pt * 1.0 / t = 1 THEN 'unipersonal' WHEN pt * 1.0 / t < 5 THEN 'micro'
       WHEN pt * 1.0 / t < 50 THEN 'pequena' WHEN pt * 1.0 / t < 200 THEN 'mediana' ELSE 'grande' END AS tamano
FROM (SELECT firm_id, SUM(n_trabajadores) AS pt, COUNT(DISTINCT pidx) AS t FROM heads GROUP BY firm_id)""",
    "heads",
)
cte(
    "firm_months",
    """SELECT firm_id, CAST(pidx AS INT) AS pidx, n_trabajadores
FROM (SELECT firm_id, unnest(range(first, last + 1)) AS pidx FROM
      (SELECT firm_id, MIN(pidx) AS first, MAX(pidx) AS last FROM heads GROUP BY firm_id))
LEFT JOIN heads USING (firm_id, pidx)""",
    "heads",
)
cte(
    "moving_size",
    """SELECT firm_id, pidx, n_trabajadores AS pt, mean AS media_movil_12m, months AS n_meses_utilizados,
  ['micro', 'pequena', 'mediana', 'grande'][1 + (mean >= 5)::INT + (mean >= 50)::INT + (mean >= 200)::INT] AS tamano_empresa_movil
FROM (SELECT *, AVG(n_trabajadores) OVER year AS mean, COUNT(n_trabajadores) OVER year AS months FROM firm_months
      WINDOW year AS (PARTITION BY firm_id ORDER BY pidx ROWS 11 PRECEDING))
WHERE n_trabajadores IS NOT NULL""",
    "firm_months",
)


def heads(spark, sf):
    return firm_size.headcount(roles.supplier_panel(spark, sf), unique_key=True)


@query(
    "D04_firm_size",
    sql(
        f"""SELECT m.firm_id, m.pidx, m.pt, {R('m.media_movil_12m', 'media_movil_12m')}, m.n_meses_utilizados,
  m.tamano_empresa_movil, s.tamano FROM moving_size m JOIN static_size s ON m.firm_id = s.firm_id""",
        "moving_size", "static_size",
    ),
)
def d04(spark, sf):
    h = heads(spark, sf)
    static = lookups.static_size_lookup(firm_size.static_size(h))
    return rounded(firm_size.moving_size(h).join(static, "firm_id"))


# --- flows -------------------------------------------------------------------------------

cte("jobs_n", "SELECT j.*, n.pos FROM jobs j JOIN numbered n ON j.pidx = n.pidx", "jobs", "numbered")
cte(
    "months_t",
    """SELECT t.pidx AS pidx, b.pidx AS pidx12 FROM numbered t JOIN numbered b ON b.pos = t.pos - 12""",
    "numbered",
)
cte(
    "entries",
    """SELECT m.pidx AS pidx_t, j.* FROM jobs j JOIN months_t m ON j.pidx = m.pidx
WHERE NOT EXISTS (SELECT 1 FROM jobs o WHERE o.worker_id = j.worker_id AND o.firm_id = j.firm_id
                  AND o.pidx = m.pidx12)""",
    "jobs", "months_t",
)
cte(
    "exits",
    """SELECT m.pidx AS pidx_t, j.* FROM jobs j JOIN months_t m ON j.pidx = m.pidx12
WHERE NOT EXISTS (SELECT 1 FROM jobs o WHERE o.worker_id = j.worker_id AND o.firm_id = j.firm_id
                  AND o.pidx = m.pidx)""",
    "jobs", "months_t",
)
cte(
    "stayers",
    "SELECT m.pidx AS pidx_t, "
    + ", ".join(f"a.{c} AS {c}_t, b.{c} AS {c}_t12" for c in S.CLASSES + ["tramo_edad_2"])
    + """ FROM jobs a JOIN months_t m ON a.pidx = m.pidx
JOIN jobs b ON b.worker_id = a.worker_id AND b.firm_id = a.firm_id AND b.pidx = m.pidx12""",
    "jobs", "months_t",
)
cte(
    "flows_fixed",
    f"""SELECT CAST(pidx AS INT) AS pidx, {ALL}, CAST(SUM(e) AS BIGINT) AS pt_ent_12, CAST(SUM(s) AS BIGINT) AS pt_sal_12
FROM (SELECT pidx_t AS pidx, {ALL}, COUNT(*) AS e, 0 AS s FROM entries GROUP BY ALL
UNION ALL SELECT pidx_t, {ALL}, 0, COUNT(*) FROM exits GROUP BY ALL) GROUP BY pidx, {ALL}""",
    "entries", "exits",
)
_T = ", ".join(f"{c}_t AS {c}" for c in S.CLASSES)
_T12 = ", ".join(f"{c}_t12 AS {c}" for c in S.CLASSES)
_MOVED = "tamano_empresa_movil_t <> tamano_empresa_movil_t12 OR tramo_edad_t <> tramo_edad_t12"
cte(
    "flows_mobile",
    f"""SELECT CAST(pidx AS INT) AS pidx, tipo_flujo, {ALL}, COUNT(*) AS n FROM (
SELECT pidx_t AS pidx, 'entrada' AS tipo_flujo, {ALL} FROM entries
UNION ALL SELECT pidx_t, 'salida', {ALL} FROM exits
UNION ALL SELECT pidx_t, 'reclasif_salida', {_T12} FROM stayers WHERE {_MOVED}
UNION ALL SELECT pidx_t, 'reclasif_entrada', {_T} FROM stayers WHERE {_MOVED}) GROUP BY ALL""",
    "entries", "exits", "stayers",
)


def fixed_cells(spark, sf):
    return flows.flows_fixed(jobs(spark, sf), S.CLASSES, roles.periods(spark, sf))


def mobile_cells(spark, sf):
    return flows.flows_mobile(jobs(spark, sf), periods=roles.periods(spark, sf))


@query("D05_flows_fixed", sql("SELECT * FROM flows_fixed", "flows_fixed"))
def d05(spark, sf):
    return fixed_cells(spark, sf)


@query("D06_flows_mobile", sql("SELECT * FROM flows_mobile", "flows_mobile"))
def d06(spark, sf):
    return mobile_cells(spark, sf)


# --- enrichment -----------------------------------------------------------------------------

cte("firm_static", """SELECT firm_id, CASE WHEN SUM(n) * 1.0 / COUNT(*) = 1 THEN 'unipersonal'
  WHEN SUM(n) * 1.0 / COUNT(*) < 5 THEN 'micro' WHEN SUM(n) * 1.0 / COUNT(*) < 50 THEN 'pequena'
  WHEN SUM(n) * 1.0 / COUNT(*) < 200 THEN 'mediana' ELSE 'grande' END AS tamano
FROM (SELECT firm_id, pidx, COUNT(*) AS n FROM panel GROUP BY ALL) GROUP BY firm_id""", "panel")
def known(code: str, unknown: str) -> str:
    return f"if({code} IN ({unknown}), NULL, {code})"


cte(
    "person_codes",
    f"""SELECT * EXCLUDE (person_id, region), person_id AS worker_id, {known('nacionalidad', '88, 99')} AS nacionalidad_depurada,
  {known('region', '17, 88, 99')} AS codigo_region_depurada
FROM (SELECT *, CAST(round(TRY_CAST(codigo_region AS DOUBLE)) AS INT) AS region FROM persons)""",
    "persons",
)
cte(
    "donor_codes",
    f"SELECT worker_id, moda AS nc_moda, {known('moda', '88, 99')} AS donated_nationality FROM nationality_mode",
    "nationality_mode",
)
cte(
    "firm_codes",
    f"""SELECT firm_id, firm_master.* EXCLUDE (firm_id), public_sector.* EXCLUDE (firm_id, ep), COALESCE(ep, 0) AS ep,
  tamano, region_trabajador, {known('region_trabajador', '88, 99')} AS donated_region
FROM (SELECT DISTINCT firm_id FROM panel) LEFT JOIN firm_master USING (firm_id) LEFT JOIN public_sector USING (firm_id)
LEFT JOIN firm_static USING (firm_id) LEFT JOIN region_donor USING (firm_id)""",
    "panel", "firm_master", "public_sector", "firm_static", "region_donor",
)
cte(
    "enriched0",
    """SELECT worker_id, firm_id, anno, mes, pidx, monto, dias, person_codes.* EXCLUDE (worker_id),
  CAST(date_diff('month', fecha_nac, make_date(anno, mes, 1)) AS INT) AS edad_meses, firm_codes.* EXCLUDE (firm_id, donated_region),
  nc_moda, COALESCE(nacionalidad_depurada, donated_nationality) AS nacionalidad_final,
  COALESCE(codigo_region_depurada, donated_region) AS region_final
FROM (SELECT worker_id, firm_id, anno, mes, pidx, monto, dias FROM panel) LEFT JOIN person_codes USING (worker_id) LEFT JOIN donor_codes USING (worker_id) LEFT JOIN firm_codes USING (firm_id)""",
    "panel", "person_codes", "donor_codes", "firm_codes",
)
cte(
    "enriched",
    f"""SELECT *, {roles.age_case('edad_meses', roles.AGE7)} AS tramo_edad,
  {roles.age_case('edad_meses', roles.AGE13)} AS tramo_edad_2 FROM enriched0""",
    "enriched0",
)


def enriched(spark, sf):
    base = gap_input(spark, sf)
    static = firm_size.static_size(firm_size.headcount(base, unique_key=True))
    return enrich.enrich(
        base,
        lookups.persons_lookup(roles.persons(spark, sf)),
        lookups.firm_master_lookup(roles.firm_master(spark, sf)),
        lookups.public_sector_lookup(roles.public_sector(spark, sf)),
        lookups.static_size_lookup(static),
        lookups.nationality_mode_lookup(roles.nationality_mode(spark, sf)),
        lookups.region_donor_lookup(roles.region_donor(spark, sf)),
    )


@query("D07_enrich", sql("SELECT * FROM enriched", "enriched"))
def d07(spark, sf):
    return enriched(spark, sf)


# --- indicators --------------------------------------------------------------------------------


def breakdowns(source: str, sets: dict, classes: list[str], sums: list[str], first: str = "pidx") -> str:
    """UNION ALL of one GROUP BY per breakdown."""
    parts = []
    for name, cols in sets.items():
        dims = ", ".join(c if c in cols else f"NULL AS {c}" for c in classes)
        agg = ", ".join(f"CAST(SUM({m}) AS BIGINT) AS {m}" for m in sums)
        by = ", ".join([first, *cols])
        parts.append(f"SELECT '{name}' AS tabla, {first}, {dims}, {agg} FROM {source} GROUP BY {by}")
    return "\nUNION ALL ".join(parts)


cte("stock_cells", f"SELECT pidx, {ALL}, COUNT(*) AS pt FROM jobs GROUP BY ALL", "jobs")
cte("stock_long", breakdowns("stock_cells", S.BREAKDOWNS, S.CLASSES, ["pt"]), "stock_cells")
cte(
    "flow_long",
    breakdowns("flows_fixed", S.BREAKDOWNS, S.CLASSES, ["pt_ent_12", "pt_sal_12"]),
    "flows_fixed",
)
cte(
    "mobile_long",
    breakdowns("flows_mobile", S.BREAKDOWNS, S.CLASSES, ["n"], "pidx, tipo_flujo"),
    "flows_mobile",
)
cte(
    "mobile_wide",
    f"""SELECT tabla, pidx, {ALL}, MAX(CASE WHEN tipo_flujo = 'entrada' THEN n END) AS pt_ent_12,
  MAX(CASE WHEN tipo_flujo = 'salida' THEN n END) AS pt_sal_12
FROM mobile_long WHERE tipo_flujo IN ('entrada', 'salida') GROUP BY tabla, pidx, {ALL}""",
    "mobile_long",
)


def indicator_ctes(prefix: str, flow: str) -> None:
    same = " AND ".join(f"s.{c} IS NOT DISTINCT FROM f.{c}" for c in ["tabla", "pidx", *S.CLASSES])
    either = ", ".join(f"COALESCE(s.{c}, f.{c}) AS {c}" for c in ["tabla", "pidx", *S.CLASSES])
    w = f"PARTITION BY tabla, {ALL} ORDER BY pidx"
    cte(
        f"{prefix}_base",
        f"SELECT {either}, s.pt, f.pt_ent_12, f.pt_sal_12 FROM stock_long s FULL JOIN {flow} f ON {same}",
        "stock_long", flow,
    )
    cte(
        f"{prefix}_r1",
        f"""SELECT *, CAST(pt_ent_12 AS DOUBLE) / NULLIF(LAG(pt, 12) OVER (w), 0) AS t_ent,
  CAST(pt_sal_12 AS DOUBLE) / NULLIF(LAG(pt, 12) OVER (w), 0) AS t_sal FROM {prefix}_base WINDOW w AS ({w})""",
        f"{prefix}_base",
    )
    cte(
        f"{prefix}_r2",
        f"SELECT *, (t_ent + t_sal) / 2 AS t_rot, t_ent - t_sal AS t_rot_neta, 1 - t_sal AS t_per FROM {prefix}_r1",
        f"{prefix}_r1",
    )
    variations = []
    for k in (12, 1):
        for name, col in (("pt", "pt"), ("pt_ent", "pt_ent_12"), ("pt_sal", "pt_sal_12")):
            variations.append(
                f"CAST({col} AS DOUBLE) / NULLIF(LAG({col}, {k}) OVER (w), 0) - 1 AS var{k}_{name}"
            )
        for name in ("t_ent", "t_rot_neta", "t_rot", "t_sal", "t_per"):
            variations.append(f"{name} - LAG({name}, {k}) OVER (w) AS var{k}_{name}")
    cte(
        f"{prefix}_rates",
        f"SELECT *, {', '.join(variations)} FROM {prefix}_r2 WINDOW w AS ({w})",
        f"{prefix}_r2",
    )
    cte(
        f"{prefix}_inc",
        f"""SELECT *, (inc_ent + inc_sal) / 2 AS inc_rot, inc_ent - inc_sal AS inc_rot_neta, 1 - inc_sal AS inc_per
FROM (SELECT r.*, t.pt_total_12, CAST(pt_ent_12 AS DOUBLE) / NULLIF(pt_total_12, 0) AS inc_ent,
  CAST(pt_sal_12 AS DOUBLE) / NULLIF(pt_total_12, 0) AS inc_sal FROM {prefix}_rates r
  LEFT JOIN (SELECT pidx + 12 AS pidx, pt AS pt_total_12 FROM stock_long WHERE tabla = 'total') t
  ON r.pidx = t.pidx)""",
        f"{prefix}_rates",
    )
    cte(
        f"{prefix}_all",
        f"""SELECT *, inc_rot - inc_rot_12 AS inc_var_trl FROM (SELECT *, LAG(inc_rot, 12) OVER ({w}) AS inc_rot_12
FROM {prefix}_inc)""",
        f"{prefix}_inc",
    )


indicator_ctes("fx", "flow_long")
indicator_ctes("mv", "mobile_wide")

RATE_COLS = ["t_ent", "t_sal", "t_rot", "t_rot_neta", "t_per"] + [
    f"var{k}_{c}"
    for k in (12, 1)
    for c in ("pt", "pt_ent", "pt_sal", "t_ent", "t_rot_neta", "t_rot", "t_sal", "t_per")
]
INC_COLS = ["inc_ent", "inc_sal", "inc_rot", "inc_rot_neta", "inc_per"]
INDICATOR_COLS = ["pt", "pt_ent_12", "pt_sal_12", *RATE_COLS, "pt_total_12", *INC_COLS, "inc_rot_12", "inc_var_trl"]
DATED = "CAST(pidx // 12 AS INT) AS anno, CAST(pidx % 12 + 1 AS INT) AS mes, make_date(CAST(pidx // 12 AS INT), CAST(pidx % 12 + 1 AS INT), 1) AS fecha"


def long_sql(source: str, cols: list[str], dims: str, where: str = "") -> str:
    """Wide to long, one SELECT per indicator."""
    return "\nUNION ALL ".join(
        f"SELECT {DATED}, {dims}, '{c}' AS indicador, round(CAST({c} AS DOUBLE), 6) + 0.0 AS valor FROM {source}{where}"
        for c in cols
    )


cte("fx_long", long_sql("fx_all", INDICATOR_COLS, f"tabla, {ALL}"), "fx_all")
cte("mv_long", long_sql("mv_all", INDICATOR_COLS, f"tabla, {ALL}"), "mv_all")


def stock_long(spark, sf):
    return stocks.stocks(jobs(spark, sf))


def fixed_long(spark, sf):
    return flows.roll_up_fixed(fixed_cells(spark, sf))


def turnover(spark, sf, fill_flows=True):
    """Stock and flows of all breakdowns from stored cells, as in the monthly chain."""
    cells = tables.stage(flows.turnover_cells(jobs(spark, sf), periods=roles.periods(spark, sf)))
    return flows.roll_up_turnover(cells, fill_flows=fill_flows)


def indicators_fixed(spark, sf):
    return indicators.indicators_of(turnover(spark, sf))


@query("D08_indicators_fixed", sql("SELECT * FROM fx_long", "fx_long"))
def d08(spark, sf):
    return rounded(indicators_fixed(spark, sf))


@query("D08_indicators_mobile", sql("SELECT * FROM mv_long", "mv_long"))
def d08_mobile(spark, sf):
    return rounded(indicators.indicators_of(turnover(spark, sf, fill_flows=False)))


@query("D08_indicators_from_tables", sql("SELECT * FROM mv_long", "mv_long"))
def d08_from_tables(spark, sf):
    """From separate stock and mobile flow tables, as they are stored between stages."""
    stock = stocks.stocks(jobs(spark, sf), S.BREAKDOWNS)
    wide = reshape.flows_to_wide(flows.roll_up_mobile(mobile_cells(spark, sf), S.BREAKDOWNS))
    return rounded(indicators.indicators(stock, wide))


def stock_and_flow_tables(spark, sf):
    """Stock and flows of all breakdowns as two long tables, from one stored table of cells."""
    base, keys = turnover(spark, sf), ["tabla", "pidx", *S.CLASSES]
    stock = base.filter("pt is not null").select(*keys, "pt")
    return stock, base.filter("pt_ent_12 is not null or pt_sal_12 is not null").select(*keys, "pt_ent_12", "pt_sal_12")


def total_base(spark, sf):
    """Stock and flows of all breakdowns side by side, and the national stock a year later."""
    stock, flow = stock_and_flow_tables(spark, sf)
    base = indicators.join_stock_flows(stock, flow, ["tabla", "pidx", *S.CLASSES])
    return base, indicators.shifted_total(stock.filter("tabla = 'total'"))


@query(
    "D08b_incidence",
    sql(
        f"""SELECT tabla, CAST(pidx AS INT) AS pidx, {ALL}, pt, pt_ent_12, pt_sal_12, pt_total_12, {', '.join(R(c) for c in INC_COLS)}
FROM fx_inc""",
        "fx_inc",
    ),
)
def d08b(spark, sf):
    return rounded(indicators.incidence(*total_base(spark, sf)))


# --- reconciliation --------------------------------------------------------------------------------

COMPARED = [(label, own, list(dims)) for label, (own, _, dims) in reconcile.CATALOGUE.items()]


def both_sources(spark, sf):
    """The indicators, and a second source made of each row: June values one higher, regions as text, ages as labels."""
    from laborlens.functions.scalars import AGE_LABELS

    long = rounded(indicators_fixed(spark, sf)).drop("fecha")
    long = reshape.recode_indicators(long.withColumn("first_name", F.col("indicador")))
    label = F.lit(None).cast("string")
    for code, text in enumerate(AGE_LABELS):
        label = F.when(F.col("tramo_edad") == code, text).otherwise(label)
    same = [c for c in long.columns if c not in ("valor", "tramo_edad", "indicador", "first_name")]
    raised = F.col("valor") + F.when(F.col("mes") == 6, 1).otherwise(0)
    sources = F.array(
        F.struct(F.lit(True).alias("own"), *same, F.col("first_name").alias("indicador"), F.lit(None).cast("string").alias("edad"), "tramo_edad", "valor"),
        F.struct(F.lit(False).alias("own"), *same, "indicador", label.alias("edad"),
                 F.lit(None).cast("int").alias("tramo_edad"), raised.alias("valor")),
    )
    both = long.select(F.explode(sources).alias("s")).select("s.*")
    age = F.coalesce("tramo_edad", X.age_label_code("edad"))
    return both.withColumn("tramo_edad", age.cast("int")).drop("edad")


def compared_sql() -> str:
    """Rows of all comparisons: each value with its June twin, where the table's classes are known."""
    parts = []
    for label, name, dims in COMPARED:
        live = "".join(f" AND {d} IS NOT NULL" for d in dims)
        parts.append(f"SELECT '{label}' AS comparacion, * FROM fx_long WHERE tabla = '{name}' AND valor IS NOT NULL{live}")
    return f"""SELECT comparacion, anno, mes, {ALL}, CASE indicador WHEN 'pt' THEN 'pt_cur' WHEN 'pt_ent_12' THEN 'pt_ent'
  WHEN 'pt_sal_12' THEN 'pt_sal' ELSE indicador END AS indicador, valor AS valor_ad,
  round(valor + (mes = 6)::INT, 6) + 0.0 AS valor_rp, round(valor - (valor + (mes = 6)::INT), 6) + 0.0 AS d
FROM ({" UNION ALL ".join(parts)})"""


@query("D09_compare", sql(compared_sql(), "fx_long"))
def d09(spark, sf):
    return rounded(reconcile.fold(both_sources(spark, sf)))


@query(
    "D09_summary",
    sql(
        "SELECT comparacion, COUNT(*) AS n_filas, COUNT(*) FILTER (d <> 0) AS n_dif_nz, "
        + R("MAX(abs(d))", "max_abs_d") + ", " + R("AVG(abs(d))", "mean_abs_d") + f" FROM ({compared_sql()}) GROUP BY comparacion",
        "fx_long",
    ),
)
def d09_summary(spark, sf):
    compared = reconcile.fold(both_sources(spark, sf))
    return rounded(reconcile.summary(compared, list(reconcile.CATALOGUE)))


# --- public employment --------------------------------------------------------------------------------

PUB = ", ".join(S.PUBLIC_CLASSES)
cte("public_rows", "SELECT *, nacionalidad_final AS nacionalidad FROM panel WHERE ep = 1", "panel")
cte(
    "public_cells",
    f"""SELECT pidx, {PUB}, COUNT(DISTINCT CAST(worker_id AS VARCHAR) || ' ' || CAST(firm_id AS VARCHAR)) AS pt
FROM public_rows GROUP BY pidx, {PUB}""",
    "public_rows",
)
cte(
    "main_jobs",
    """SELECT * FROM public_rows j WHERE NOT EXISTS (SELECT 1 FROM public_rows better
  WHERE better.worker_id = j.worker_id AND better.pidx = j.pidx
    AND ROW(better.monto, better.dias, -better.firm_id) > ROW(j.monto, j.dias, -j.firm_id))""",
    "public_rows",
)
cte("person_cells", f"SELECT pidx, {PUB}, COUNT(*) AS pt FROM main_jobs GROUP BY pidx, {PUB}", "main_jobs")
cte("public_long", breakdowns("public_cells", S.PUBLIC_BREAKDOWNS, S.PUBLIC_CLASSES, ["pt"]), "public_cells")
cte("person_long", breakdowns("person_cells", S.PUBLIC_BREAKDOWNS, S.PUBLIC_CLASSES, ["pt"]), "person_cells")


def public_tables(spark, sf):
    cells = public_jobs.public_job_cells(roles.public_panel(spark, sf), unique_key=True)
    return public_jobs.public_tables(cells)


@query("D10_public_jobs", sql("SELECT * FROM public_long", "public_long"))
def d10(spark, sf):
    return public_tables(spark, sf)


@query("D10_public_persons", sql("SELECT * FROM person_long", "person_long"))
def d10_persons(spark, sf):
    return public_jobs.public_tables(public_jobs.public_person_cells(roles.public_panel(spark, sf)))


_WP = f"PARTITION BY tabla, {PUB} ORDER BY pidx"
cte(
    "public_var",
    f"""SELECT *, CAST(pt AS DOUBLE) / NULLIF(LAG(pt, 12) OVER (w), 0) - 1 AS var12_pt,
  CAST(pt AS DOUBLE) / NULLIF(LAG(pt, 1) OVER (w), 0) - 1 AS var1_pt
FROM public_long WHERE tabla <> 'total' WINDOW w AS ({_WP})""",
    "public_long",
)
cte(
    "public_inc",
    f"""SELECT *, var12_pt * (LAG(pt, 12) OVER (w) / NULLIF(CAST(LAG(pt_tot, 12) OVER (w) AS DOUBLE), 0)) AS inc12_pt,
  var1_pt * (LAG(pt, 1) OVER (w) / NULLIF(CAST(LAG(pt_tot, 1) OVER (w) AS DOUBLE), 0)) AS inc1_pt
FROM (SELECT d.*, t.pt AS pt_tot FROM public_var d LEFT JOIN
  (SELECT pidx, pt FROM public_long WHERE tabla = 'total') t ON d.pidx = t.pidx) WINDOW w AS ({_WP})""",
    "public_var",
)
cte(
    "public_ind",
    long_sql("public_inc", ["pt", "var12_pt", "var1_pt", "inc12_pt", "inc1_pt"], f"tabla, {PUB}"),
    "public_inc",
)


@query("D11_public_indicators", sql("SELECT * FROM public_ind", "public_ind"))
def d11(spark, sf):
    return rounded(public_jobs.public_indicators(public_tables(spark, sf)))


def ssi_rue(spark, sf):
    rows = public_tables(spark, sf).filter("tabla = 'ssi_rue'")
    return rows.select("pidx", "subsector_institucional", "seccion_ciiu4cl_prin", "pt")


_WC = "PARTITION BY subsector_institucional, seccion_ciiu4cl_prin ORDER BY pidx"
cte(
    "cond",
    f"""SELECT pidx, subsector_institucional, seccion_ciiu4cl_prin, pt, pt_seccion,
  LAG(pt, 12) OVER (w) AS pt_lag12, LAG(pt_seccion, 12) OVER (w) AS pt_seccion_lag12,
  LAG(pt, 1) OVER (w) AS pt_lag1, LAG(pt_seccion, 1) OVER (w) AS pt_seccion_lag1
FROM (SELECT *, SUM(pt) OVER (PARTITION BY pidx, seccion_ciiu4cl_prin) AS pt_seccion
  FROM public_long WHERE tabla = 'ssi_rue') WINDOW w AS ({_WC})""",
    "public_long",
)
cte(
    "cond_inc",
    """SELECT *, var12_pt * (CAST(pt_lag12 AS DOUBLE) / NULLIF(pt_seccion_lag12, 0)) AS inc_var_12,
  var1_pt * (CAST(pt_lag1 AS DOUBLE) / NULLIF(pt_seccion_lag1, 0)) AS inc_var_01
FROM (SELECT *, CAST(pt AS DOUBLE) / NULLIF(pt_lag12, 0) - 1 AS var12_pt,
  CAST(pt AS DOUBLE) / NULLIF(pt_lag1, 0) - 1 AS var1_pt FROM cond)""",
    "cond",
)
COND_COLS = [
    "pt", "pt_seccion", "pt_lag12", "pt_seccion_lag12", "pt_lag1", "pt_seccion_lag1",
    "var12_pt", "var1_pt", "inc_var_12", "inc_var_01",
]


@query(
    "D12_conditional_incidence",
    sql(
        "SELECT * EXCLUDE (fecha) FROM ("
        + long_sql("cond_inc", COND_COLS, "subsector_institucional, seccion_ciiu4cl_prin") + ")",
        "cond_inc",
    ),
)
def d12(spark, sf):
    return rounded(
        public_jobs.conditional_incidence_long(
            ssi_rue(spark, sf), "subsector_institucional", "seccion_ciiu4cl_prin"
        )
    )


# --- migration -------------------------------------------------------------------------------------------

MIG = ["sexo", "nacionalidad_final", "region_final", "tramo_edad_2"]


def migration_sql() -> str:
    parts = []
    for combo in S.MIGRATION_COMBOS:
        def dims(suffix: str, combo=combo) -> str:
            return ", ".join(f"{c}{suffix} AS {c}" if c in combo else f"NULL AS {c}" for c in MIG)

        changed = " OR ".join(f"{c}_t <> {c}_t12" for c in combo)
        name = " x ".join(combo)
        for source, where, suffix, p, col in (
            ("stayers", f"WHERE {changed}", "_t", "pidx_t", "In"),
            ("stayers", f"WHERE {changed}", "_t12", "pidx_t", "Em"),
            ("jobs JOIN months_t m ON jobs.pidx = m.pidx12", "", "", "m.pidx", "L_t12"),
            ("jobs JOIN months_t m ON jobs.pidx = m.pidx", "", "", "m.pidx", "L_t"),
        ):
            ones = ", ".join(f"{1 if c == col else 0} AS {c}" for c in ("In_", "Em", "L_t12", "L_t"))
            ones = ones.replace("0 AS In_", "1 AS In_") if col == "In" else ones
            parts.append(f"SELECT '{name}' AS desagregacion, {p} AS pidx, {dims(suffix)}, {ones} FROM {source} {where}")
    return "\nUNION ALL ".join(parts)


cte("migr_events", migration_sql(), "stayers", "jobs", "months_t")
cte(
    "migr",
    f"""SELECT desagregacion, pidx, {', '.join(MIG)}, CAST(SUM(In_) AS BIGINT) AS i, CAST(SUM(Em) AS BIGINT) AS e,
  CAST(SUM(L_t12) AS BIGINT) AS l12, CAST(SUM(L_t) AS BIGINT) AS l FROM migr_events GROUP BY ALL""",
    "migr_events",
)


@query(
    "D13_migration_rates",
    sql(
        f"""SELECT {DATED}, desagregacion, {', '.join(MIG)}, i AS "In", e AS "Em", l12 AS "L_t12", l AS "L_t",
  {R('CASE WHEN l12 > 0 THEN i / CAST(l12 AS DOUBLE) END', 'tasa_inmigracion')},
  {R('CASE WHEN l12 > 0 THEN e / CAST(l12 AS DOUBLE) END', 'tasa_emigracion')},
  {R('CASE WHEN l12 > 0 THEN (i - e) / CAST(l12 AS DOUBLE) END', 'tmn')},
  {R('CASE WHEN l12 > 0 THEN (l - l12) / CAST(l12 AS DOUBLE) END', 'var_12')} FROM migr""",
        "migr",
    ),
)
def d13(spark, sf):
    return rounded(
        migration.migration_rates(jobs(spark, sf, MIG), periods=roles.periods(spark, sf))
    )


# --- wage index -------------------------------------------------------------------------------------------

cte(
    "mass",
    """SELECT pidx, COUNT(DISTINCT CAST(worker_id AS VARCHAR) || '_' || CAST(firm_id AS VARCHAR)) AS empleo_formal,
  SUM(monto) AS masa_salarial, SUM(monto * (dias / 30.0::DOUBLE)) AS masa_salarial_ajustada,
  AVG(monto) AS salario_promedio, MEDIAN(monto) AS salario_mediano,
  AVG(CASE WHEN dias > 0 THEN monto / dias END) AS salario_diario_promedio,
  AVG(dias) AS dias_promedio, CAST(SUM(dias) AS BIGINT) AS dias_totales
FROM panel WHERE seccion NOT IN ('T', 'U') OR seccion IS NULL GROUP BY pidx""",
    "panel",
)
MASS_COLS = [
    "masa_salarial", "masa_salarial_ajustada", "salario_promedio", "salario_mediano",
    "salario_diario_promedio", "dias_promedio",
]


def wage_jobs(spark, sf):
    return tables.read_jobs(roles.panel(spark, sf), ["monto", "dias"], size=None, unique_key=True)


def mass(spark, sf):
    return wage_index.wage_mass(wage_jobs(spark, sf), unique_key=True)


@query(
    "D14_wage_mass",
    sql(f"SELECT pidx, empleo_formal, dias_totales, {', '.join(R(c, decimals=4) for c in MASS_COLS)} FROM mass", "mass"),
)
def d14_mass(spark, sf):
    return rounded(mass(spark, sf), 4)


cte(
    "real",
    """SELECT m.*, ipc, masa_salarial / ipc AS masa_salarial_real, masa_salarial_ajustada / ipc AS masa_salarial_ajustada_real,
  salario_promedio / ipc AS salario_promedio_real, salario_mediano / ipc AS salario_mediano_real,
  salario_diario_promedio / ipc * 100 AS salario_diario_real
FROM mass m LEFT JOIN prices p ON m.pidx = p.pidx""",
    "mass", "prices",
)
cte(
    "base",
    """SELECT AVG(masa_salarial_real) AS b1, AVG(masa_salarial_ajustada_real) AS b2, AVG(empleo_formal) AS b3,
  AVG(salario_promedio_real) AS b4, AVG(salario_diario_real) AS b5, AVG(dias_totales) AS b6
FROM real WHERE pidx // 12 = 1998""",
    "real",
)
cte(
    "indexed",
    """SELECT real.*, masa_salarial_real / b1 * 100 AS iilf, masa_salarial_ajustada_real / b2 * 100 AS iilf_ajustado,
  empleo_formal / b3 * 100 AS payroll_index, salario_promedio_real / b4 * 100 AS wage_index,
  salario_diario_real / b5 * 100 AS wage_daily_index, dias_totales / b6 * 100 AS labor_intensity_index
FROM real, base""",
    "real", "base",
)
cte(
    "indexed_var",
    """SELECT *, iilf / LAG(iilf, 1) OVER w - 1 AS var_mensual_iilf,
  payroll_index / LAG(payroll_index, 1) OVER w - 1 AS var_mensual_payroll,
  iilf / LAG(iilf, 12) OVER w - 1 AS var_anual_iilf,
  payroll_index / LAG(payroll_index, 12) OVER w - 1 AS var_anual_payroll,
  iilf_ajustado - iilf AS brecha_ajuste FROM indexed WINDOW w AS (ORDER BY pidx)""",
    "indexed",
)
INDEX_COLS = [
    "ipc", "masa_salarial_real", "masa_salarial_ajustada_real", "salario_promedio_real", "salario_mediano_real",
    "salario_diario_real", "iilf", "iilf_ajustado", "payroll_index", "wage_index", "wage_daily_index",
    "labor_intensity_index", "var_mensual_iilf", "var_mensual_payroll", "var_anual_iilf", "var_anual_payroll",
    "brecha_ajuste",
]


def wage_indices(spark, sf):
    return wage_index.wage_index(mass(spark, sf), roles.prices(spark, sf), base_year=1998)


@query(
    "D14_wage_index",
    sql(
        f"SELECT pidx, empleo_formal, dias_totales, {', '.join(R(c, decimals=4) for c in MASS_COLS + INDEX_COLS)} FROM indexed_var",
        "indexed_var",
    ),
)
def d14(spark, sf):
    return rounded(wage_indices(spark, sf), 4)


# --- tax credit ------------------------------------------------------------------------------------------------

cte(
    "credit",
    """SELECT *, monto * tasa_ct AS ct, monto / usd AS monto_usd, monto * tasa_ct / usd AS ct_usd
FROM (SELECT j.*, nacionalidad_final AS nacionalidad, region_final AS codigo_region, utm, usd,
  utm * 7.8::DOUBLE AS li, utm * 12 AS ls,
  greatest(0, least(0.15::DOUBLE * (utm * 12 - monto) / (utm * 12 - utm * 7.8::DOUBLE), 0.15::DOUBLE)) AS tasa_ct
  FROM jobs j JOIN params p ON j.pidx = p.pidx WHERE ep = 0)
WHERE monto >= li AND monto <= ls""",
    "jobs", "params",
)
cte(
    "credit_class",
    """SELECT pidx, sexo, nacionalidad, codigo_region, tramo_edad, tamano_empresa_movil, seccion,
  COUNT(*) AS puestos_de_trabajo, SUM(ct) AS ct_total_clp, SUM(ct_usd) AS ct_total_usd FROM credit GROUP BY ALL""",
    "credit",
)
cte(
    "credit_firm",
    """SELECT pidx, firm_id, tamano_empresa_movil, seccion, SUM(monto) AS cl_clp, SUM(ct) AS ct_clp,
  SUM(monto_usd) AS cl_usd, SUM(ct_usd) AS ct_usd FROM credit GROUP BY ALL""",
    "credit",
)


def credit(spark, sf):
    panel = roles.panel(spark, sf).withColumns(
        {"nacionalidad": F.col("nacionalidad_final"), "codigo_region": F.col("region_final")}
    )
    return tax_credit.credits(panel, roles.parameters(spark, sf))


@query(
    "D15_tax_credit",
    sql(
        f"""SELECT pidx, sexo, nacionalidad, codigo_region, tramo_edad, tamano_empresa_movil, seccion,
  puestos_de_trabajo, {R('ct_total_clp', decimals=4)}, {R('ct_total_usd', decimals=4)} FROM credit_class""",
        "credit_class",
    ),
)
def d15(spark, sf):
    return rounded(tax_credit.credit_by_class(credit(spark, sf), unique_key=True), 4)


def participation_long(spark, sf):
    """The seven tables from two passes: one over job cells, one over firms."""
    c = credit(spark, sf)
    return tax_credit.participation_long(
        tax_credit.credit_by_class(c, unique_key=True),
        tax_credit.credit_by_firm(c),
    )


def part_sql(source: str, dim: str, value: str) -> str:
    return f"""SELECT {ANNO_MES}, {dim}, pt, {R('CAST(pt AS DOUBLE) / SUM(pt) OVER (PARTITION BY pidx)', 'participacion')}
FROM (SELECT pidx, {dim}, CAST({value} AS BIGINT) AS pt FROM {source} GROUP BY ALL)"""


@query("D15_participation_tables", sql(
    "SELECT 'pt_tamano' AS tabla, tamano_empresa_movil AS clase, * EXCLUDE (tamano_empresa_movil) FROM ("
    + part_sql("credit_class", "tamano_empresa_movil", "SUM(puestos_de_trabajo)")
    + ") UNION ALL SELECT 'pt_sector', seccion, * EXCLUDE (seccion) FROM ("
    + part_sql("credit_class", "seccion", "SUM(puestos_de_trabajo)")
    + ") UNION ALL SELECT 'ee_tamano', tamano_empresa_movil, * EXCLUDE (tamano_empresa_movil) FROM ("
    + part_sql("credit_firm", "tamano_empresa_movil", "COUNT(DISTINCT firm_id)")
    + ") UNION ALL SELECT 'ee_sector', seccion, * EXCLUDE (seccion) FROM ("
    + part_sql("credit_firm", "seccion", "COUNT(DISTINCT firm_id)") + ")",
    "credit_class", "credit_firm",
))
def d15_tables(spark, sf):
    long = participation_long(spark, sf).filter(F.col("tabla").isin("pt_tamano", "pt_sector", "ee_tamano", "ee_sector"))
    by_size = F.col("tabla").endswith("tamano")
    group = F.when(by_size, F.col("tamano_empresa_movil")).otherwise(F.col("seccion"))
    return rounded(long.select("tabla", group.alias("clase"), "anno", "mes", F.col("n").alias("pt"), "participacion"))


def amounts_sql(table: str, clp: str, usd: str) -> str:
    return f"""SELECT '{table}' AS tabla, {ANNO_MES}, tamano_empresa_movil, {R('monto_clp', decimals=4)}, {R('monto_usd', decimals=4)},
  {R('monto_clp / SUM(monto_clp) OVER (PARTITION BY pidx)', 'participacion_clp', 4)},
  {R('monto_usd / SUM(monto_usd) OVER (PARTITION BY pidx)', 'participacion_usd', 4)}
FROM (SELECT pidx, tamano_empresa_movil, SUM({clp}) AS monto_clp, SUM({usd}) AS monto_usd
      FROM credit_firm GROUP BY ALL)"""


@query(
    "D15_participation_amounts",
    sql(
        amounts_sql("cl_tamano", "cl_clp", "cl_usd") + " UNION ALL " + amounts_sql("ct_tamano", "ct_clp", "ct_usd"),
        "credit_firm",
    ),
)
def d15_amounts(spark, sf):
    amounts = tax_credit.with_shares(tax_credit.firm_cells(tax_credit.credit_by_firm(credit(spark, sf))))
    amounts = amounts.filter(F.col("tabla").isin("cl_tamano", "ct_tamano"))
    return rounded(
        amounts.select(
            "tabla", "anno", "mes", "tamano_empresa_movil", "monto_clp", "monto_usd", "participacion_clp", "participacion_usd"
        ),
        4,
    )


# --- audit -------------------------------------------------------------------------------------------------------

cte(
    "registries",
    """SELECT COALESCE(x.person_id, l.person_id) AS worker_id, nacionalidad_rep_2024, codigo_region AS region_rep_2024,
  CASE l.nacionalidad_rc WHEN 2 THEN 1 WHEN 3 THEN 2 ELSE l.nacionalidad_rc END AS nacionalidad_rep_2025,
  l.codigo_region_rc AS region_rep_2025
FROM (SELECT COALESCE(d.person_id, g.person_id) AS person_id, g.codigo_region,
        CASE WHEN d.nacionalidad = 3 THEN 1 ELSE d.nacionalidad END AS nacionalidad_rep_2024
      FROM demographic d FULL JOIN geographic g ON d.person_id = g.person_id) x
FULL JOIN registry25 l ON x.person_id = l.person_id""",
    "demographic", "geographic", "registry25",
)


def registries(spark, sf):
    return audit.registry_attributes(
        roles.demographic(spark, sf), roles.geographic(spark, sf), roles.registry25(spark, sf)
    )


cte(
    "audited",
    """SELECT m.*, nacionalidad_rep_2024, region_rep_2024, nacionalidad_rep_2025, region_rep_2025
FROM (SELECT DISTINCT worker_id, nacionalidad_final, region_final FROM panel WHERE anno = 1999 AND mes = 12) m
LEFT JOIN registries r ON m.worker_id = r.worker_id""",
    "panel", "registries",
)


def audited(spark, sf):
    return audit.compare_attributes(roles.panel(spark, sf), registries(spark, sf), 1999, 12)


@query(
    "D16_cross_tables",
    sql(
        " UNION ALL ".join(
            f"""SELECT '{a} x {b}' AS tabla, CAST({a} AS VARCHAR) AS a, CAST({b} AS VARCHAR) AS b, COUNT(*) AS n
FROM audited GROUP BY {a}, {b}"""
            for a, b in audit.CROSS_TABLES
        ),
        "audited",
    ),
)
def d16(spark, sf):
    return audit.cross_tables(audited(spark, sf))


@query(
    "D16_imputation_audit",
    sql(
        """SELECT 'antes' AS momento, pidx, COUNT(DISTINCT (worker_id, firm_id)) AS pt
FROM panel p LEFT JOIN registries r USING (worker_id) WHERE nacionalidad_rep_2024 IS NULL GROUP BY pidx
UNION ALL SELECT 'despues', pidx, COUNT(DISTINCT (worker_id, firm_id)) FROM panel
WHERE nacionalidad_final IS NULL GROUP BY pidx""",
        "panel", "registries",
    ),
)
def d16_audit(spark, sf):
    found = audit.imputation_audit(roles.panel(spark, sf), registries(spark, sf), "nacionalidad")
    before = found["before_per_month"].withColumn("momento", F.lit("antes"))
    return before.unionByName(found["after_per_month"].withColumn("momento", F.lit("despues")))


# --- reports -------------------------------------------------------------------------------------------------------


def _quoted(names) -> str:
    return ", ".join(f"'{n}'" for n in names)


# The published indicators of each table, listed here once more for the check.
_GENERAL = """t_ent var1_t_ent var12_t_ent t_sal var1_t_sal var12_t_sal t_rot var1_t_rot var12_t_rot t_rot_neta
t_per var1_t_per var12_t_per""".split()
_CLASSES = "t_ent var12_t_ent t_sal var12_t_sal t_rot var12_t_rot t_rot_neta inc_rot_neta t_per var12_t_per".split()
_CUADROS = [
    ("general", "total", "NULL", _GENERAL), ("seccion", "sector", "seccion", _CLASSES), ("tamano", "tamano", "tamano_empresa_movil", _CLASSES),
    ("sexo", "sx", "sexo", _CLASSES), ("nacionalidad", "nc", "nacionalidad_final", _CLASSES), ("region", "re", "region_final", _CLASSES),
    ("tramos", "te", "tramo_edad", _CLASSES),
]


BULLETIN_SQL = sql(
        " UNION ALL ".join(
            f"""SELECT '{name}' AS cuadro, anno, mes, CAST({clase} AS VARCHAR) AS clase, indicador, valor
FROM fx_long WHERE tabla = '{source}' AND indicador IN ({_quoted(ind)}) AND valor IS NOT NULL"""
            for name, source, clase, ind in _CUADROS
        )
        + f""" UNION ALL SELECT 'ep', CAST(pidx // 12 AS INT), CAST(pidx % 12 + 1 AS INT), NULL, indicador, {R('valor', 'valor')}
FROM (UNPIVOT (SELECT pidx, CAST(pt AS DOUBLE) AS pt,
  CAST(pt AS DOUBLE) / LAG(pt, 1) OVER (ORDER BY pidx) - 1 AS var1_pt, CAST(pt AS DOUBLE) / LAG(pt, 12) OVER (ORDER BY pidx) - 1 AS var12_pt
  FROM (SELECT pidx FROM jobs WHERE ep = 1 UNION SELECT pidx_t FROM entries WHERE ep = 1 UNION SELECT pidx_t FROM exits WHERE ep = 1)
  LEFT JOIN (SELECT pidx, COUNT(*) AS pt FROM jobs WHERE ep = 1 GROUP BY pidx) USING (pidx)) ON pt, var1_pt, var12_pt INTO NAME indicador VALUE valor)""",
        "fx_long", "jobs", "entries", "exits",
    )


@query("D17_bulletin_tables", BULLETIN_SQL)
def d17(spark, sf):
    """Seven tables from the classes' breakdowns, the eighth from that by public employer, of one pass."""
    return rounded(reports.bulletin(bulletin_source(spark, sf)))


def bulletin_source(spark, sf):
    classes = [*S.CLASSES, "ep"]
    cells = tables.stage(flows.turnover_cells(jobs(spark, sf, classes), classes, roles.periods(spark, sf)))
    return indicators.indicators_of(flows.roll_up_turnover(cells, S.BREAKDOWNS | {"ep": ["ep"]}))


cte(
    "public_wide",
    "SELECT * FROM public_inc",
    "public_inc",
)


@query(
    "D18_group_summary",
    sql(
        f"""SELECT tabla, {PUB}, round_even(CAST(last(pt ORDER BY pidx) AS DOUBLE), 0) + 0.0 AS nivel_actual,
  round_even(CAST(first(pt ORDER BY pidx) AS DOUBLE), 0) + 0.0 AS nivel_12_meses,
  round_even(last(var12_pt ORDER BY pidx), 1) + 0.0 AS var_anual,
  round_even(last(inc12_pt ORDER BY pidx), 2) + 0.0 AS incidencia
FROM public_wide WHERE pidx IN ((SELECT MAX(pidx) FROM public_wide), (SELECT MAX(pidx) - 12 FROM public_wide))
GROUP BY tabla, {PUB}""",
        "public_wide",
    ),
)
def d18(spark, sf):
    long = tables.stage(public_jobs.public_indicators(public_tables(spark, sf)))
    return rounded(reports.group_summary(long, ["tabla", *S.PUBLIC_CLASSES]), 6)


@query(
    "D19_latest_total_and_leader",
    sql(
        """, s AS (SELECT CAST(anno AS VARCHAR) || '-' || lpad(CAST(mes AS VARCHAR), 2, '0') AS periodo, seccion,
  round(SUM(monto), 2) AS valor FROM panel WHERE anno BETWEEN 1996 AND 2000 AND mes IN (3, 6, 9) GROUP BY ALL),
l AS (SELECT * FROM s WHERE periodo = (SELECT MAX(periodo) FROM s))
SELECT periodo, round(SUM(valor), 2) + 0.0 AS total,
  (SELECT MIN(seccion) FROM l WHERE valor = (SELECT MAX(valor) FROM l)) AS lider,
  CASE WHEN SUM(valor) >= 1e9 THEN regexp_replace(CAST(round_even(SUM(valor) / 1e9, 1) AS VARCHAR), '\\.0$', '') || ' MM'
       WHEN SUM(valor) >= 1e6 THEN regexp_replace(CAST(round_even(SUM(valor) / 1e6, 1) AS VARCHAR), '\\.0$', '') || ' M'
       ELSE format('{:,}', CAST(round_even(SUM(valor), 0) AS BIGINT)) END AS total_texto
FROM l GROUP BY periodo""",
        "panel",
    ).replace("\n, s AS", ",\ns AS"),
)
def d19(spark, sf):
    panel = roles.panel(spark, sf).select("anno", "mes", "seccion", "monto")
    chosen = reports.selected_months(panel, (1996, 2000), [3, 6, 9])
    sums = tables.stage(chosen.groupBy("periodo", "seccion").agg(F.round(F.sum("monto"), 2).alias("valor")))
    return rounded(reports.latest_total_and_leader(sums, "seccion", "valor"), 2)
