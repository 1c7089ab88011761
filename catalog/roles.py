"""The driver tables in the roles of a labour panel.

``panel``: customers are workers, supplier nations are firms, ship months are
months of accrual. Attributes that depend on a key alone are computed from the
key after the aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.registry import cte
from laborlens.functions import periods as P
from laborlens.functions import scalars as X


# Declared, so that opening a table starts no job to infer its columns.
COLUMNS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
    " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
    " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.schema(COLUMNS[name]).parquet(f"{sf}/{name}.parquet")


def _ship(col: str = "l_shipdate") -> tuple[Column, Column]:
    return F.year(col).cast("int").alias("anno"), F.month(col).cast("int").alias("mes")


def periods(spark: SparkSession, sf: str) -> DataFrame:
    """Months of the panel, from one column of one table."""
    return P.available_periods(table(spark, sf, "lineitem").select(*_ship()), desde=None)


def _shipments(spark: SparkSession, sf: str, firm: str, *cols: str) -> DataFrame:
    """Line items with worker and firm. Orders meet customers before line items do."""
    workers = table(spark, sf, "customer").select("c_custkey", "c_nationkey").join(
        table(spark, sf, "nation").select(
            F.col("n_nationkey").alias("c_nationkey"), F.col("n_regionkey").alias("regionkey")
        ),
        "c_nationkey",
    )
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey").join(
        workers, F.col("o_custkey") == F.col("c_custkey")
    )
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey", "l_shipdate", *cols)
    supplier = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    return (
        lines.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            F.col("o_custkey").alias("worker_id"),
            F.col(firm).cast("long").alias("firm_id"),
            *_ship(),
            "regionkey",
            *cols,
        )
    )


def panel(spark: SparkSession, sf: str) -> DataFrame:
    """One row per worker, firm and month, with its classes."""
    base = (
        _shipments(spark, sf, "s_nationkey", "l_extendedprice", "l_quantity")
        .groupBy("worker_id", "firm_id", "anno", "mes")
        .agg(
            F.round(F.sum("l_extendedprice"), 2).alias("monto"),
            F.least(F.lit(30.0), F.sum("l_quantity")).cast("int").alias("dias"),
            F.min("regionkey").cast("int").alias("regionkey"),
        )
    )
    return base.selectExpr(
        "worker_id", "firm_id", "anno", "mes",
        "anno * 12 + mes - 1 AS pidx",
        "monto", "dias",
        "CAST(worker_id % 2 + 1 AS INT) AS sexo",
        "CAST(NULLIF(worker_id % 3, 0) AS INT) AS nacionalidad_final",
        "NULLIF(regionkey, 4) AS region_final",
        "char(firm_id + 65) AS seccion",
        "CASE firm_id % 6 WHEN 0 THEN NULL WHEN 1 THEN 'unipersonal' ELSE 'pequena' END AS tamano",
        "CASE (firm_id + anno) % 4 WHEN 0 THEN NULL WHEN 1 THEN 'micro' WHEN 2 THEN 'pequena'"
        " ELSE 'mediana' END AS tamano_empresa_movil",
        "date_add(DATE '1920-01-01', CAST(worker_id * 37 % 25000 AS INT)) AS fecha_nac",
        "CASE WHEN firm_id % 5 = 0 THEN 1 ELSE 0 END AS ep",
        "concat('SI', firm_id % 2) AS sector_institucional",
        "concat('SSI', firm_id % 3) AS subsector_institucional",
        "char(firm_id % 4 + 65) AS seccion_ciiu4cl_prin",
        "concat('RS', firm_id) AS razon_social_unidad_legal",
    ).withColumn("edad_meses", X.months_since("fecha_nac", "anno", "mes")).withColumns(
        {"tramo_edad": X.age_band_7("edad_meses"), "tramo_edad_2": X.age_band_13("edad_meses")}
    )


def birth_date(worker: str) -> Column:
    return F.date_add(F.lit("1920-01-01").cast("date"), (F.col(worker) * 37 % 25000).cast("int"))


def public_panel(spark: SparkSession, sf: str) -> DataFrame:
    return panel(spark, sf).withColumn("nacionalidad", F.col("nacionalidad_final"))


def supplier_panel(spark: SparkSession, sf: str) -> DataFrame:
    """Worker, firm and month with suppliers as firms (size bands)."""
    return (
        _shipments(spark, sf, "l_suppkey").select("worker_id", "firm_id", "anno", "mes").distinct()
        .withColumn("pidx", P.pidx("anno", "mes"))
    )


def raw(spark: SparkSession, sf: str) -> DataFrame:
    """Contribution rows: several per worker, firm and month."""
    cols = [
        "l_returnflag", "l_linenumber", "l_extendedprice", "l_quantity", "l_partkey",
    ]
    return _raw_rows(spark, sf, cols).select(
        "worker_id",
        "firm_id",
        "anno",
        "mes",
        F.when(F.col("l_returnflag") == "R", 2).otherwise(1).alias("tipo_trabajador"),
        F.nullif(F.col("l_linenumber") % 4, F.lit(0)).alias("tipo_pago"),
        F.col("l_linenumber").alias("tipo_declaracion"),
        F.col("l_extendedprice").alias("monto"),
        F.col("l_quantity").cast("int").alias("dias"),
        (F.col("l_partkey") % 3).alias("codigo_mutual"),
        F.when(F.col("l_partkey") % 20 == 0, 2 - F.col("worker_id") % 2)
        .when(F.col("l_partkey") % 20 == 1, None)
        .otherwise(F.col("worker_id") % 2 + 1).cast("int").alias("sexo"),
    )


def _raw_rows(spark: SparkSession, sf: str, cols: list[str]) -> DataFrame:
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey", "l_shipdate", *cols)
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    supplier = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    return (
        lines.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            F.col("o_custkey").alias("worker_id"),
            F.col("s_nationkey").cast("long").alias("firm_id"),
            *_ship(),
            *cols,
        )
    )


# --- registries and lookups -------------------------------------------------------


def demographic(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col("c_custkey")
    return table(spark, sf, "customer").filter(c % 10 != 0).select(
        c.alias("person_id"),
        F.when(c % 7 == 0, 9).when(c % 7 == 1, None).otherwise(c % 2 + 1).cast("int").alias("sexo"),
        F.nullif(c % 4, F.lit(0)).cast("int").alias("nacionalidad"),
        _birth_text(c).alias("fecha_nac"),
        _death_text(c).alias("fecha_def_cor_rc"),
    )


def _birth_text(c: Column) -> Column:
    return (
        F.when(c % 13 == 0, "--").when(c % 13 == 1, "").when(c % 13 == 2, " ")
        .otherwise(birth_date("c_custkey").cast("string"))
    )


def _death_text(c: Column) -> Column:
    day = F.date_add(F.lit("1997-01-01").cast("date"), (c * 11 % 1500).cast("int"))
    return F.when(c % 5 == 0, day.cast("string")).when(c % 5 == 1, "--")


def geographic(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col("c_custkey")
    return table(spark, sf, "customer").filter(c % 10 != 1).select(
        c.alias("person_id"),
        _region_text(c).alias("codigo_region"),
        F.col("c_nationkey").cast("string").alias("codigo_comuna"),
    )


def _region_text(c: Column) -> Column:
    return (
        F.when(c % 9 == 0, "17.0").when(c % 27 == 4, "16.5").when(c % 27 == 5, "17.6").when(c % 9 == 1, "99").when(c % 9 == 2, "x").when(c % 9 == 3, None)
        .otherwise((F.col("c_nationkey") % 16).cast("string"))
    )


def registry25(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col("c_custkey")
    return table(spark, sf, "customer").filter(c % 6 != 0).select(
        c.alias("person_id"),
        (c % 2 + 1).cast("int").alias("sexo_rc"),
        (c % 3 + 1).cast("int").alias("nacionalidad_rc"),
        birth_date("c_custkey").cast("string").alias("fecha_nac_cor_rc"),
        F.lit(None).cast("string").alias("fecha_def_cor_rc"),
        (F.col("c_nationkey") % 16).cast("string").alias("codigo_region_rc"),
        F.col("c_nationkey").cast("string").alias("codigo_comuna_rc"),
    )


def sex_donor(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col("c_custkey")
    return table(spark, sf, "customer").filter(c % 8 != 3).select(
        c.alias("worker_id"), (c % 2 + 1).cast("int").alias("sexo_final")
    )


def persons(spark: SparkSession, sf: str) -> DataFrame:
    """A finished persons table, with parsed dates."""
    c = F.col("c_custkey")
    return table(spark, sf, "customer").select(
        c.alias("person_id"),
        X.parse_date(_birth_text(c)).alias("fecha_nac"),
        X.parse_date(_death_text(c)).alias("fecha_def_cor_rc"),
        (c % 2 + 1).cast("int").alias("sexo"),
        F.when(c % 12 == 0, 99).otherwise(c % 3).cast("int").alias("nacionalidad"),
        _region_text(c).alias("codigo_region"),
        F.col("c_nationkey").cast("string").alias("codigo_comuna"),
    )


def _firms(spark: SparkSession, sf: str) -> DataFrame:
    """Supplier nations, the firms of ``panel``."""
    used = table(spark, sf, "supplier").select(F.col("s_nationkey").alias("n_nationkey")).distinct()
    return table(spark, sf, "nation").join(used, "n_nationkey", "left_semi")


def firm_master(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("n_nationkey")
    return _firms(spark, sf).filter(k % 8 != 7).select(
        k.cast("long").alias("firm_id"),
        F.char(k + 65).alias("seccion"),
        (k * 10).alias("division"),
        (F.col("n_regionkey") * 100).alias("comuna_cut"),
    )


def public_sector(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("n_nationkey")
    return _firms(spark, sf).filter(k % 5 == 0).select(
        k.cast("string").alias("firm_id"),
        F.concat(F.lit("RS"), k.cast("string")).alias("razon_social_unidad_legal"),
        F.char(k % 4 + 65).alias("seccion_ciiu4cl_prin"),
        F.concat(F.lit("SI"), (k % 2).cast("string")).alias("sector_institucional"),
        F.concat(F.lit("SSI"), (k % 3).cast("string")).alias("subsector_institucional"),
    )


def nationality_mode(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col("c_custkey")
    return table(spark, sf, "customer").filter(c % 4 != 0).select(
        c.alias("worker_id"),
        F.when(c % 11 == 0, 99).otherwise(F.col("c_nationkey")).cast("int").alias("moda"),
    )


def region_donor(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("n_nationkey")
    return _firms(spark, sf).select(
        k.cast("long").alias("firm_id"),
        F.when(k % 7 == 0, 17).when(k % 7 == 1, 99).otherwise(F.col("n_regionkey")).cast("int")
        .alias("region_trabajador"),
    )


def exclusions(spark: SparkSession, sf: str) -> DataFrame:
    return panel(spark, sf).filter((F.col("worker_id") + F.col("pidx")) % 97 == 0).select(
        "worker_id", "firm_id", "anno", "mes", F.lit(1).alias("pred_tipo_6")
    )


def caps(spark: SparkSession, sf: str) -> DataFrame:
    """A cap for every month but those of the last year."""
    return periods(spark, sf).filter("anno < 2001").select(
        "anno", "mes", (40000 + 10 * (F.col("pidx") - 23940)).cast("int").alias("tope")
    )


def parameters(spark: SparkSession, sf: str) -> DataFrame:
    """Tax unit and dollar per month; one month has none."""
    return periods(spark, sf).filter("pidx <> 23960").select(
        "pidx",
        P.month_start("pidx").alias("fecha"),
        (F.lit(4000.0) + (F.col("pidx") - 23940) * 10).alias("utm"),
        (F.lit(503.7) + (F.col("pidx") - 23940) * 1.3).alias("usd"),
    )


def prices(spark: SparkSession, sf: str) -> DataFrame:
    return periods(spark, sf).filter("pidx <> 23970").select(
        "pidx", (F.lit(101.3) + (F.col("pidx") - 23940) * 0.7).alias("ipc")
    )


# --- the same roles in SQL ----------------------------------------------------------

SHIP_YM = "CAST(year(l_shipdate) AS INT) AS anno, CAST(month(l_shipdate) AS INT) AS mes"
BIRTH = "DATE '1920-01-01' + CAST(({k} * 37) % 25000 AS INT)"

cte(
    "panel0",
    f"""SELECT o_custkey AS worker_id, CAST(s_nationkey AS BIGINT) AS firm_id,
       CAST(year(l_shipdate) AS INT) AS anno, CAST(month(l_shipdate) AS INT) AS mes,
       CAST(year(l_shipdate) AS INT) * 12 + CAST(month(l_shipdate) AS INT) - 1 AS pidx,
       round(SUM(l_extendedprice), 2) AS monto,
       CAST(LEAST(30, SUM(l_quantity)) AS INT) AS dias,
       CAST(MIN(c_custkey % 2) AS INT) + 1 AS sexo,
       CAST(NULLIF(MIN(c_custkey % 3), 0) AS INT) AS nacionalidad_final,
       MIN(NULLIF(cn.n_regionkey, 4)) AS region_final,
       MIN(chr(65 + s_nationkey)) AS seccion,
       MIN({BIRTH.format(k='c_custkey')}) AS fecha_nac
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
JOIN supplier ON l_suppkey = s_suppkey
JOIN customer ON o_custkey = c_custkey
JOIN nation cn ON c_nationkey = cn.n_nationkey
GROUP BY o_custkey, s_nationkey, year(l_shipdate), month(l_shipdate)""",
)
cte(
    "panel1",
    """SELECT *,
  CASE WHEN firm_id % 6 = 0 THEN NULL WHEN firm_id % 6 = 1 THEN 'unipersonal' ELSE 'pequena' END AS tamano,
  CASE (firm_id + anno) % 4 WHEN 0 THEN NULL WHEN 1 THEN 'micro' WHEN 2 THEN 'pequena' ELSE 'mediana' END
    AS tamano_empresa_movil,
  CASE WHEN firm_id % 5 = 0 THEN 1 ELSE 0 END AS ep,
  'SI' || CAST(firm_id % 2 AS VARCHAR) AS sector_institucional,
  'SSI' || CAST(firm_id % 3 AS VARCHAR) AS subsector_institucional,
  chr(CAST(65 + firm_id % 4 AS INT)) AS seccion_ciiu4cl_prin,
  'RS' || CAST(firm_id AS VARCHAR) AS razon_social_unidad_legal,
  CAST((anno * 12 + mes) - (year(fecha_nac) * 12 + month(fecha_nac)) AS INT) AS edad_meses
FROM panel0""",
    "panel0",
)


def age_case(expr: str, cuts: list[int]) -> str:
    whens = " ".join(f"WHEN {expr} < {c} THEN {i}" for i, c in enumerate(cuts))
    return f"CASE WHEN {expr} IS NULL THEN NULL {whens} ELSE {len(cuts)} END"


AGE7 = [180, 300, 420, 540, 660, 780]
AGE13 = [180, 240, 300, 360, 420, 480, 540, 600, 660, 720, 780, 840]
cte(
    "panel",
    f"""SELECT *, {age_case('edad_meses', AGE7)} AS tramo_edad,
  {age_case('edad_meses', AGE13)} AS tramo_edad_2 FROM panel1""",
    "panel1",
)
cte("periods", "SELECT DISTINCT anno, mes, anno * 12 + mes - 1 AS pidx FROM panel", "panel")
cte(
    "numbered",
    "SELECT pidx, CAST(row_number() OVER (ORDER BY pidx) AS INT) AS pos FROM periods",
    "periods",
)
cte(
    "supplier_panel",
    """SELECT DISTINCT o_custkey AS worker_id, l_suppkey AS firm_id,
  CAST(year(l_shipdate) AS INT) * 12 + CAST(month(l_shipdate) AS INT) - 1 AS pidx
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey
JOIN customer ON o_custkey = c_custkey JOIN nation cn ON c_nationkey = cn.n_nationkey""",
)
cte(
    "raw",
    f"""SELECT o_custkey AS worker_id, CAST(s_nationkey AS BIGINT) AS firm_id, {SHIP_YM},
       CASE WHEN l_returnflag = 'R' THEN 2 ELSE 1 END AS tipo_trabajador,
       NULLIF(l_linenumber % 4, 0) AS tipo_pago, l_linenumber AS tipo_declaracion,
       l_extendedprice AS monto, CAST(l_quantity AS INT) AS dias, l_partkey % 3 AS codigo_mutual,
       CAST(CASE WHEN l_partkey % 20 = 0 THEN 2 - o_custkey % 2 WHEN l_partkey % 20 = 1 THEN NULL
            ELSE o_custkey % 2 + 1 END AS INT) AS sexo
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey""",
)
_BIRTH_TEXT = (
    "CASE c_custkey % 13 WHEN 0 THEN '--' WHEN 1 THEN '' WHEN 2 THEN ' ' "
    f"ELSE CAST(CAST({BIRTH.format(k='c_custkey')} AS DATE) AS VARCHAR) END"
)
_DEATH_TEXT = (
    "CASE c_custkey % 5 WHEN 0 THEN CAST(CAST(DATE '1997-01-01' + CAST(c_custkey * 11 % 1500 AS INT) "
    "AS DATE) AS VARCHAR) WHEN 1 THEN '--' END"
)
_REGION_TEXT = (
    "CASE WHEN c_custkey % 9 = 0 THEN '17.0' WHEN c_custkey % 27 = 4 THEN '16.5' WHEN c_custkey % 27 = 5 THEN '17.6' "
    "WHEN c_custkey % 9 = 1 THEN '99' WHEN c_custkey % 9 = 2 THEN 'x' WHEN c_custkey % 9 = 3 THEN NULL "
    "ELSE CAST(c_nationkey % 16 AS VARCHAR) END"
)
cte(
    "demographic",
    f"""SELECT c_custkey AS person_id,
  CAST(CASE c_custkey % 7 WHEN 0 THEN 9 WHEN 1 THEN NULL ELSE c_custkey % 2 + 1 END AS INT) AS sexo,
  CAST(NULLIF(c_custkey % 4, 0) AS INT) AS nacionalidad,
  {_BIRTH_TEXT} AS fecha_nac, {_DEATH_TEXT} AS fecha_def_cor_rc
FROM customer WHERE c_custkey % 10 <> 0""",
)
cte(
    "geographic",
    f"""SELECT c_custkey AS person_id, {_REGION_TEXT} AS codigo_region,
  CAST(c_nationkey AS VARCHAR) AS codigo_comuna FROM customer WHERE c_custkey % 10 <> 1""",
)
cte(
    "registry25",
    f"""SELECT c_custkey AS person_id, CAST(c_custkey % 2 + 1 AS INT) AS sexo_rc,
  CAST(c_custkey % 3 + 1 AS INT) AS nacionalidad_rc,
  CAST(CAST({BIRTH.format(k='c_custkey')} AS DATE) AS VARCHAR) AS fecha_nac_cor_rc,
  CAST(NULL AS VARCHAR) AS fecha_def_cor_rc, CAST(c_nationkey % 16 AS VARCHAR) AS codigo_region_rc,
  CAST(c_nationkey AS VARCHAR) AS codigo_comuna_rc FROM customer WHERE c_custkey % 6 <> 0""",
)
cte(
    "sex_donor",
    """SELECT c_custkey AS worker_id, CAST(c_custkey % 2 + 1 AS INT) AS sexo_final
FROM customer WHERE c_custkey % 8 <> 3""",
)
cte(
    "persons",
    f"""SELECT c_custkey AS person_id, TRY_CAST({_BIRTH_TEXT} AS DATE) AS fecha_nac,
  TRY_CAST({_DEATH_TEXT} AS DATE) AS fecha_def_cor_rc, CAST(c_custkey % 2 + 1 AS INT) AS sexo,
  CAST(CASE WHEN c_custkey % 12 = 0 THEN 99 ELSE c_custkey % 3 END AS INT) AS nacionalidad,
  {_REGION_TEXT} AS codigo_region, CAST(c_nationkey AS VARCHAR) AS codigo_comuna FROM customer""",
)
_FIRM = "FROM nation WHERE n_nationkey IN (SELECT s_nationkey FROM supplier)"
cte(
    "firm_master",
    f"""SELECT CAST(n_nationkey AS BIGINT) AS firm_id, chr(65 + n_nationkey) AS seccion,
  n_nationkey * 10 AS division, n_regionkey * 100 AS comuna_cut {_FIRM} AND n_nationkey % 8 <> 7""",
)
cte(
    "public_sector",
    f"""SELECT CAST(n_nationkey AS BIGINT) AS firm_id,
  'RS' || CAST(n_nationkey AS VARCHAR) AS razon_social_unidad_legal,
  chr(65 + n_nationkey % 4) AS seccion_ciiu4cl_prin,
  'SI' || CAST(n_nationkey % 2 AS VARCHAR) AS sector_institucional,
  'SSI' || CAST(n_nationkey % 3 AS VARCHAR) AS subsector_institucional, 1 AS ep
  {_FIRM} AND n_nationkey % 5 = 0""",
)
cte(
    "nationality_mode",
    """SELECT c_custkey AS worker_id,
  CAST(CASE WHEN c_custkey % 11 = 0 THEN 99 ELSE c_nationkey END AS INT) AS moda
FROM customer WHERE c_custkey % 4 <> 0""",
)
cte(
    "region_donor",
    f"""SELECT CAST(n_nationkey AS BIGINT) AS firm_id,
  CAST(CASE n_nationkey % 7 WHEN 0 THEN 17 WHEN 1 THEN 99 ELSE n_regionkey END AS INT)
    AS region_trabajador {_FIRM}""",
)
cte(
    "exclusions",
    "SELECT worker_id, firm_id, anno, mes FROM panel WHERE (worker_id + pidx) % 97 = 0",
    "panel",
)
cte(
    "caps",
    """SELECT anno, mes, CAST(40000 + 10 * (pidx - 23940) AS INT) AS tope FROM periods
WHERE anno < 2001""",
    "periods",
)
cte(
    "params",
    """SELECT pidx, make_date(anno, mes, 1) AS fecha,
  CAST(4000 AS DOUBLE) + (pidx - 23940) * 10 AS utm,
  CAST(503.7 AS DOUBLE) + (pidx - 23940) * CAST(1.3 AS DOUBLE) AS usd FROM periods WHERE pidx <> 23960""",
    "periods",
)
cte(
    "prices",
    """SELECT pidx, CAST(101.3 AS DOUBLE) + (pidx - 23940) * CAST(0.7 AS DOUBLE) AS ipc
FROM periods WHERE pidx <> 23970""",
    "periods",
)
cte(
    "r24",
    """SELECT COALESCE(d.person_id, g.person_id) AS person_id, sexo,
  CASE WHEN nacionalidad = 3 THEN 1 ELSE nacionalidad END AS nacionalidad, fecha_nac, fecha_def_cor_rc,
  codigo_region, codigo_comuna FROM demographic d FULL JOIN geographic g ON d.person_id = g.person_id""",
    "demographic", "geographic",
)
