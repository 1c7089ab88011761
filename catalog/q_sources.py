"""S rows: sources and sinks. Writers round-trip through a fresh scratch folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import roles
from catalog.q_composites import gap_input, heads, mass, MASS_COLS
from catalog.registry import R, query, rounded, sql
from laborlens import schema as S
from laborlens.functions import periods as P
from laborlens.operators import firm_size
from laborlens.sources import bundle, drift, lookups, tables


@query(
    "S01_open_table",
    """SELECT l_returnflag, l_linestatus, COUNT(*) AS n, COUNT(DISTINCT l_suppkey) AS firms, CAST(SUM(l_suppkey) AS BIGINT) AS firm_sum,
  MAX(CAST(l_linenumber AS VARCHAR)) AS last_line, COUNT(*) FILTER (year(l_shipdate) >= 1995) AS n_tax,
  round(SUM(l_quantity), 4) + 0.0 AS quantity FROM lineitem GROUP BY ALL""",
)
def open_table(spark, sf):
    """Months whose types drifted: ids LONG, then INT, then DOUBLE, line numbers INT, then text, a tax column later on only."""
    root = tables.scratch_dir(spark)
    lines = roles.table(spark, sf, "lineitem").withColumns(dict(zip(("anno", "mes"), roles._ship(), strict=True)))
    kept = ["anno", "mes", "l_returnflag", "l_linestatus", "l_quantity"]
    early = lines.filter("anno < 1994").select(*kept, "l_suppkey", "l_linenumber")
    middle = lines.filter("anno = 1994").select(*kept, F.col("l_suppkey").cast("int").alias("l_suppkey"), "l_linenumber")
    late = lines.filter("anno > 1994").select(
        *kept, F.col("l_suppkey").cast("double").alias("l_suppkey"), F.col("l_linenumber").cast("string").alias("l_linenumber"), "l_tax"
    )
    for part in (early, middle, late):
        tables.write_periods(part, root)
    return drift.open_unified(spark, root).groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("n"), F.countDistinct("l_suppkey").alias("firms"), F.sum("l_suppkey").cast("long").alias("firm_sum"),
        F.max("l_linenumber").alias("last_line"), F.count("l_tax").alias("n_tax"),
        (F.round(F.sum("l_quantity"), 4) + F.lit(0.0)).alias("quantity"),
    )


@query("S02_persons_lookup", sql("SELECT * FROM persons", "persons"))
def persons_lookup(spark, sf):
    return lookups.persons_lookup(roles.persons(spark, sf))


@query("S02_firm_master_lookup", sql("SELECT * FROM firm_master", "firm_master"))
def firm_master_lookup(spark, sf):
    return lookups.firm_master_lookup(roles.firm_master(spark, sf))


@query("S02_public_sector_lookup", sql("SELECT * FROM public_sector", "public_sector"))
def public_sector_lookup(spark, sf):
    return lookups.public_sector_lookup(roles.public_sector(spark, sf))


@query("S02_static_size_lookup", sql("SELECT firm_id, tamano FROM static_size", "static_size"))
def static_size_lookup(spark, sf):
    return lookups.static_size_lookup(firm_size.static_size(heads(spark, sf)))


@query(
    "S02_nationality_mode_lookup",
    sql("SELECT worker_id, moda AS nc_moda FROM nationality_mode", "nationality_mode"),
)
def nationality_mode_lookup(spark, sf):
    return lookups.nationality_mode_lookup(roles.nationality_mode(spark, sf))


@query("S02_region_donor_lookup", sql("SELECT * FROM region_donor", "region_donor"))
def region_donor_lookup(spark, sf):
    return lookups.region_donor_lookup(roles.region_donor(spark, sf))


@query(
    "S03_month_files",
    sql("SELECT anno, mes, pidx, make_date(anno, mes, 1) AS fecha FROM periods", "periods"),
)
def month_files(spark, sf):
    root = tables.scratch_dir(spark)
    tables.write_periods(roles.panel(spark, sf).select("anno", "mes", "worker_id", "firm_id"), root)
    return tables.month_files(spark, root).select("anno", "mes", "pidx", "fecha").distinct()


@query(
    "S04_read_jobs",
    sql(
        """SELECT worker_id, firm_id, pidx, tipo_trabajador, tipo_pago, monto FROM (
SELECT *, row_number() OVER (PARTITION BY worker_id, firm_id, pidx
  ORDER BY tipo_trabajador NULLS LAST, tipo_pago NULLS LAST, monto NULLS LAST) AS rn
FROM (SELECT *, anno * 12 + mes - 1 AS pidx, chr(CAST(65 + firm_id AS INT)) AS seccion FROM raw)
WHERE firm_id % 6 > 1 AND seccion NOT IN ('T', 'U')) WHERE rn = 1""",
        "raw",
    ),
)
def read_jobs(spark, sf):
    rows = roles.raw(spark, sf).selectExpr(
        "*", "char(firm_id + 65) AS seccion",
        "CASE firm_id % 6 WHEN 0 THEN NULL WHEN 1 THEN 'unipersonal' ELSE 'pequena' END AS tamano",
    )
    return tables.read_jobs(rows, ["tipo_trabajador", "tipo_pago", "monto"])


@query(
    "S05_available_periods",
    sql(
        """SELECT anno, mes, anno * 100 + mes AS periodo_int, pidx,
  CAST(row_number() OVER (ORDER BY anno, mes) AS INT) AS pos FROM periods
WHERE anno > 1996 OR (anno = 1996 AND mes >= 11)""",
        "periods",
    ),
)
def available_periods(spark, sf):
    lines = roles.table(spark, sf, "lineitem").select(*roles._ship())
    return P.available_periods(lines, (1996, 11))


@query(
    "S06_write_periods",
    sql("SELECT worker_id, firm_id, anno, mes, pidx, monto, dias FROM panel", "panel"),
)
def write_periods(spark, sf):
    root = tables.scratch_dir(spark)
    tables.write_periods(gap_input(spark, sf), root)
    return tables.open_table(spark, root)


@query("S07_write_table", sql("SELECT * FROM persons", "persons"))
def write_table(spark, sf):
    path = tables.scratch_dir(spark)
    tables.write_table(roles.persons(spark, sf), path)
    return tables.open_table(spark, path, schema=S.PERSONS)


@query("S08_write_sorted", sql("SELECT * FROM heads", "heads"))
def write_sorted(spark, sf):
    path = tables.scratch_dir(spark)
    tables.write_sorted(heads(spark, sf), path, ["firm_id", "pidx"])
    return tables.open_table(spark, path)


_UF = ", ".join(
    f"({y}, {m}, CAST('{uf}' AS DOUBLE), CAST('{lookups.CAP_UF_BY_YEAR[y]}' AS DOUBLE))"
    for y, values in lookups.UF_BY_MONTH.items()
    for m, uf in enumerate(values, start=1)
)


@query(
    "S09_pay_caps",
    sql(
        f"""SELECT p.anno, p.mes, CAST(trunc(uf * cap) AS INT) AS tope
FROM (SELECT anno + 22 AS anno, mes FROM periods) p
LEFT JOIN (VALUES {_UF}) c(anno, mes, uf, cap) ON p.anno = c.anno AND p.mes = c.mes""",
        "periods",
    ),
)
def pay_caps(spark, sf):
    months = roles.periods(spark, sf).select((F.col("anno") + 22).alias("anno"), "mes")
    return months.join(P.by_month(lookups.pay_caps(spark)), ["anno", "mes"], "left")


@query(
    "S10_parameters",
    sql("SELECT fecha, utm, usd, pidx FROM params", "params"),
)
def parameters(spark, sf):
    path = tables.scratch_dir(spark)
    params = roles.parameters(spark, sf).select("fecha", "utm", "usd")
    params.write.option("header", True).csv(path)
    return lookups.parameters(spark, path)


def _bundle(spark, sf):
    panel = roles.panel(spark, sf)
    return {
        "sexo": panel.groupBy("sexo").agg(F.count("*").alias("n")),
        "seccion": panel.groupBy("seccion").agg(F.count("*").alias("n")),
        "trabajadores": panel.groupBy("worker_id").agg(F.count("*").alias("n")),
    }


_BUNDLE_SQL = sql(
    """SELECT 'sexo' AS tabla, CAST(sexo AS VARCHAR) AS clase, COUNT(*) AS n FROM panel GROUP BY ALL
UNION ALL SELECT 'seccion', seccion, COUNT(*) FROM panel GROUP BY ALL
UNION ALL SELECT 'trabajadores', CAST(worker_id AS VARCHAR), COUNT(*) FROM panel GROUP BY ALL""",
    "panel",
)


def _read_all(spark, root, names, fmt):
    parts = [
        df.select(F.lit(name).alias("tabla"), F.col(df.columns[0]).cast("string").alias("clase"), F.col("n").cast("long").alias("n"))
        for name, df in bundle.read_bundle(spark, root, names, fmt).items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("S11_write_bundle", _BUNDLE_SQL)
def write_bundle(spark, sf):
    """Three tables of one panel from one pass, each in the order of its classes, and read back by name."""
    root = tables.scratch_dir(spark)
    kinds = {"sexo": "sexo", "seccion": "seccion", "trabajadores": "worker_id"}
    classes = [F.struct(F.lit(t).alias("tabla"), F.col(c).cast("string").alias("clase")) for t, c in kinds.items()]
    rows = roles.panel(spark, sf).select(F.explode(F.array(*classes)).alias("r")).select("r.*")
    bundle.write_long(rows.groupBy("tabla", "clase").agg(F.count("*").alias("n")), root, ["clase"])
    return bundle.read_long(spark, root, list(kinds)).select("tabla", "clase", "n")


@query("S12_read_bundle", _BUNDLE_SQL)
def read_bundle(spark, sf):
    """The same bundle as text files, read in another order."""
    root = tables.scratch_dir(spark)
    built = _bundle(spark, sf)
    bundle.write_bundle(built, root, "csv")
    return _read_all(spark, root, sorted(built), "csv")


@query(
    "S13_write_results",
    sql(f"SELECT pidx, empleo_formal, dias_totales, {', '.join(R(c, decimals=4) for c in MASS_COLS)} FROM mass", "mass"),
)
def write_results(spark, sf):
    path = tables.scratch_dir(spark)
    tables.write_table(mass(spark, sf), path)
    return rounded(tables.open_table(spark, path), 4)
