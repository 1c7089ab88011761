"""P rows: projections and reshaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import roles
from catalog.q_composites import (
    ALL,
    DATED,
    INC_COLS,
    RATE_COLS,
    long_sql,
    mobile_cells,
    public_tables,
    total_base,
    wage_indices,
)
from catalog.registry import R, query, rounded, sql
from laborlens import schema as S
from laborlens.operators import clean, flows, indicators, persons, public_jobs, reshape, wage_index


@query(
    "P01_drop_columns",
    sql("SELECT * EXCLUDE (tipo_declaracion, codigo_mutual, sexo) FROM raw", "raw"),
)
def drop_columns(spark, sf):
    return roles.raw(spark, sf).drop("tipo_declaracion", "codigo_mutual", "sexo")


@query(
    "P02_rename_registry",
    sql(
        """SELECT person_id, sexo_rc AS sexo,
  CASE nacionalidad_rc WHEN 2 THEN 1 WHEN 3 THEN 2 ELSE nacionalidad_rc END AS nacionalidad,
  fecha_nac_cor_rc AS fecha_nac, fecha_def_cor_rc, codigo_region_rc AS codigo_region,
  codigo_comuna_rc AS codigo_comuna FROM registry25""",
        "registry25",
    ),
)
def rename_registry(spark, sf):
    return persons.registry_2025(roles.registry25(spark, sf))


@query(
    "P03_minimal_join_side",
    sql(
        """SELECT worker_id, firm_id, pidx, r.fecha_nac, r.fecha_def_cor_rc FROM panel
LEFT JOIN persons r ON worker_id = person_id""",
        "panel", "persons",
    ),
)
def minimal_join_side(spark, sf):
    jobs = roles.panel(spark, sf).select("worker_id", "firm_id", "pidx")
    return clean.join_dates(jobs, roles.persons(spark, sf))


def _sector_rates(spark, sf):
    return indicators.rates(total_base(spark, sf)[0])


@query(
    "P04_columns_by_pattern",
    sql(
        f"SELECT tabla, CAST(pidx AS INT) AS pidx, {ALL}, pt, pt_ent_12, pt_sal_12, {', '.join(R(c) for c in RATE_COLS)} FROM fx_rates",
        "fx_rates",
    ),
)
def columns_by_pattern(spark, sf):
    df = _sector_rates(spark, sf)
    return rounded(df.select("tabla", "pidx", *S.CLASSES, *reshape.indicator_columns(df)))


@query(
    "P05_to_long",
    sql(
        long_sql("fx_rates", ["pt", "pt_ent_12", "pt_sal_12", *RATE_COLS], f"tabla, {ALL}"),
        "fx_rates",
    ),
)
def to_long(spark, sf):
    return rounded(reshape.to_long(_sector_rates(spark, sf)))


@query(
    "P06_flows_to_wide",
    sql(f"SELECT tabla, CAST(pidx AS INT) AS pidx, {ALL}, pt_ent_12, pt_sal_12 FROM mobile_wide", "mobile_wide"),
)
def flows_to_wide(spark, sf):
    return reshape.flows_to_wide(flows.roll_up_mobile(mobile_cells(spark, sf)))


@query(
    "P07_to_wide",
    sql(
        f"""SELECT make_date(CAST(pidx // 12 AS INT), CAST(pidx % 12 + 1 AS INT), 1) AS fecha, tabla, {', '.join(S.PUBLIC_CLASSES)},
  CAST(pt AS DOUBLE) AS pt, {R('var12_pt')}, {R('inc12_pt')} FROM public_inc""",
        "public_inc",
    ),
)
def to_wide(spark, sf):
    long = public_jobs.public_indicators(public_tables(spark, sf))
    return rounded(reshape.to_wide(long, ["tabla", *S.PUBLIC_CLASSES], ["pt", "var12_pt", "inc12_pt"]))


@query(
    "P08_append_rotation_change",
    sql(
        long_sql("fx_all", [*INC_COLS, "inc_rot_12", "inc_var_trl"], f"tabla, {ALL}"),
        "fx_all",
    ),
)
def append_rotation_change(spark, sf):
    inc = indicators.incidence(*total_base(spark, sf)).select("tabla", "pidx", *S.CLASSES, *INC_COLS)
    long = reshape.to_long(inc)
    return rounded(indicators.append_rotation_change(long, indicators.rotation_incidence_change(long)))


@query(
    "P09_column_order",
    sql(f"SELECT {DATED}, seccion, pt FROM (SELECT pidx, seccion, COUNT(*) AS pt FROM panel GROUP BY ALL)", "panel"),
)
def column_order(spark, sf):
    cells = roles.panel(spark, sf).groupBy("pidx", "seccion").agg(F.count("*").alias("pt"))
    return reshape.with_calendar(cells).select("anno", "mes", "fecha", "seccion", "pt")


@query(
    "P10_series_long",
    sql(
        " UNION ALL ".join(
            f"SELECT pidx, '{c}' AS componente, {R(c, 'indice', 4)} FROM indexed" for c in wage_index.COMPONENTS
        ),
        "indexed",
    ),
)
def series_long(spark, sf):
    return rounded(reshape.series_long(wage_indices(spark, sf), wage_index.COMPONENTS, "componente"), 4)


@query(
    "P11_columns_like",
    sql(
        f"""SELECT pidx, {', '.join(R(c, decimals=4) for c in [
            'iilf', 'iilf_ajustado', 'payroll_index', 'wage_index', 'wage_daily_index',
            'var_anual_iilf', 'var_anual_payroll'])} FROM indexed_var""",
        "indexed_var",
    ),
)
def columns_like(spark, sf):
    df = wage_indices(spark, sf)
    return rounded(reshape.columns_like(df, ["pidx"], ("iilf", "payroll", "wage"), ("var_anual",)), 4)
