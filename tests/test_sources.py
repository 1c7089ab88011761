"""Writers, readers and the whole chain, on fresh folders."""

from pyspark.sql import functions as F

from catalog import roles
from laborlens import schema as S
from laborlens.functions import periods as P
from laborlens.plans import monthly
from laborlens.sources import bundle, lookups, tables


def months_frame(spark, rows):
    return spark.createDataFrame(rows, "anno int, mes int, v int")


def test_overwrite_touches_only_the_months_written(spark, tmp_path):
    root = str(tmp_path / "panel")
    tables.write_periods(months_frame(spark, [(2020, 1, 1), (2020, 2, 2)]), root)
    tables.write_periods(months_frame(spark, [(2020, 2, 9)]), root)
    rows = sorted(tuple(r) for r in tables.open_table(spark, root).select("anno", "mes", "v").collect())
    assert rows == [(2020, 1, 1), (2020, 2, 9)]


def test_large_month_is_written_by_several_tasks(spark, tmp_path):
    root = str(tmp_path / "hot")
    rows = spark.range(200_000).select(
        F.lit(2020).alias("anno"), F.when(F.col("id") % 10 == 0, 2).otherwise(1).alias("mes"),
        F.sha2(F.col("id").cast("string"), 256).alias("v"),
    )
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(key, "500KB")
    try:
        tables.write_periods(rows.repartition(16), root)
    finally:
        spark.conf.unset(key)
    files = tables.month_files(spark, root).groupBy("mes").count()
    assert {r["mes"]: r["count"] for r in files.collect()}[1] > 1
    assert tables.open_table(spark, root).count() == 200_000


def test_months_from_directories_and_from_names(spark, tmp_path):
    root = str(tmp_path / "a")
    tables.write_periods(months_frame(spark, [(2020, 1, 1), (2021, 12, 2)]), root)
    assert {r.pidx for r in tables.month_files(spark, root).collect()} == {24240, 24263}
    named = tmp_path / "b"
    named.mkdir()
    import pyarrow as pa
    import pyarrow.parquet as pq

    pq.write_table(pa.table({"v": [1]}), named / "job_202003.parquet")
    found = tables.month_files(spark, str(named)).collect()
    assert [(r.anno, r.mes) for r in found] == [(2020, 3)]


def test_merge_schema(spark, tmp_path):
    root = str(tmp_path / "m")
    spark.range(1).withColumn("a", F.lit(1)).write.parquet(f"{root}/p=1")
    spark.range(1).withColumn("b", F.lit(2)).write.parquet(f"{root}/p=2")
    assert set(tables.open_table(spark, root, merge_schema=True).columns) == {"id", "a", "b", "p"}


def test_bundle_by_name(spark, tmp_path):
    root = str(tmp_path / "bundle")
    built = {"small": spark.range(3), "large": spark.range(11)}
    bundle.write_bundle(built, root)
    assert {n: df.count() for n, df in bundle.read_bundle(spark, root, ["large", "small"]).items()} == {"small": 3, "large": 11}
    assert bundle.common_names(built, {"large": None}) == ["large"]
    parts = bundle.split(spark.createDataFrame([("a", 1), ("b", 2)], "tabla string, v int"), ["a"])
    assert [tuple(r) for r in parts["a"].collect()] == [(1,)]


def test_scratch_follows_the_session(spark):
    assert tables.scratch_dir(spark).startswith(spark.conf.get("spark.checkpoint.dir"))
    assert tables.scratch_dir(spark) != tables.scratch_dir(spark)


def test_available_periods_lower_bound(spark):
    df = months_frame(spark, [(2016, 10, 1), (2016, 11, 1), (2016, 11, 2), (2017, 1, 1)])
    rows = P.available_periods(df).orderBy("pos").collect()
    assert [(r.periodo_int, r.pos) for r in rows] == [(201611, 1), (201701, 2)]


def test_year_month_grid(spark):
    assert lookups.year_months(months_frame(spark, [(2020, 1, 1), (2021, 5, 1)])).count() == 24


def test_conform_casts(spark):
    df = spark.createDataFrame([(1.0, 2.0, 2020.0, 1.0, 1.0, 5.0, 3.0)], [f.name for f in S.PANEL.fields])
    assert S.conform(df, S.PANEL).schema == S.PANEL


def test_whole_chain(spark, sf, tmp_path):
    """Raw rows to indicators; the final stock equals the eligible imputed jobs."""
    caps = roles.periods(spark, sf).select("anno", "mes", F.lit(60000).alias("tope"))
    root = str(tmp_path / "chain")
    out = monthly.run_month_chain(
        spark, root,
        raw=roles.raw(spark, sf),
        exclusions=roles.exclusions(spark, sf),
        persons=roles.persons(spark, sf),
        firm_master=roles.firm_master(spark, sf),
        public_sector=roles.public_sector(spark, sf),
        nationality_mode=roles.nationality_mode(spark, sf),
        region_donor=roles.region_donor(spark, sf),
        caps=caps, desde=(1996, 11),
    )
    enriched = tables.open_table(spark, f"{root}/enriched")
    eligible = enriched.filter(tables.eligible())
    stock = out.filter("tabla = 'total' AND indicador = 'pt'").agg(F.sum("valor")).first()[0]
    assert stock == eligible.count() > 0
    assert enriched.filter("is_imputed").count() > 0
    assert enriched.agg(F.max("monto")).first()[0] <= 60000
    keys = enriched.groupBy("worker_id", "firm_id", "anno", "mes").count()
    assert keys.filter("count > 1").isEmpty()
    assert set(S.BREAKDOWNS) == {r.tabla for r in out.select("tabla").distinct().collect()}
    for name in ("headcount", "stocks", "flows_fixed", "flows_mobile"):
        assert tables.open_table(spark, f"{root}/{name}").count() > 0


def test_chain_takes_administrative_names_and_leaves_no_stale_month(spark, sf, tmp_path):
    back = {v: k for k, v in S.SOURCE_NAMES.items()}
    raw = roles.raw(spark, sf).withColumn("worker_id", F.col("worker_id").cast("double"))
    raw = raw.withColumnsRenamed({c: back[c] for c in raw.columns if c in back})
    root = str(tmp_path / "rerun")

    def run(desde):
        return monthly.run_month_chain(
            spark, root, raw=raw, exclusions=roles.exclusions(spark, sf), persons=roles.persons(spark, sf),
            firm_master=roles.firm_master(spark, sf), public_sector=roles.public_sector(spark, sf),
            nationality_mode=roles.nationality_mode(spark, sf), region_donor=roles.region_donor(spark, sf),
            caps=roles.periods(spark, sf).select("anno", "mes", F.lit(60000).alias("tope")), desde=desde,
        )

    run((1996, 11))
    out = run((1998, 1))
    assert tables.open_table(spark, f"{root}/enriched").agg(F.min("anno")).first()[0] == 1998
    assert out.agg(F.min("anno")).first()[0] >= 1998


def test_drifted_types_are_read_as_one_table(spark, tmp_path):
    from laborlens.sources import drift

    root = str(tmp_path / "drift")
    tables.write_periods(spark.sql("SELECT 2020 anno, 1 mes, CAST(5 AS BIGINT) id, DATE '2020-01-02' d, 'a' c"), root)
    tables.write_periods(spark.sql("SELECT 2020 anno, 2 mes, CAST(6 AS INT) id, TIMESTAMP_NTZ '2020-02-03 04:00:00' d, 7 c"), root)
    tables.write_periods(spark.sql("SELECT 2020 anno, 3 mes, CAST(7.5 AS DOUBLE) id, CAST(NULL AS DATE) d, 'x' c, true late"), root)
    tables.write_periods(spark.sql("SELECT 2020 anno, 4 mes, CAST(8 AS BIGINT) id, DATE '2020-04-05' d, 'y' c"), root)
    # Two files of one month that differ.
    spark.sql("SELECT CAST(1 AS INT) id").write.mode("append").parquet(f"{root}/anno=2020/mes=5")
    spark.sql("SELECT 'z' c, CAST(2 AS BIGINT) id").write.mode("append").parquet(f"{root}/anno=2020/mes=5")
    df = drift.open_unified(spark, root)
    assert {n: t for n, t in df.dtypes if n not in ("anno", "mes")} == {"id": "double", "d": "timestamp_ntz", "c": "string", "late": "boolean"}
    rows = {(r.mes, r.id, str(r.d)[:10], r.c, r.late) for r in df.collect()}
    assert rows == {
        (1, 5.0, "2020-01-02", "a", None), (2, 6.0, "2020-02-03", "7", None), (3, 7.5, "None", "x", True),
        (4, 8.0, "2020-04-05", "y", None), (5, 1.0, "None", None, None), (5, 2.0, "None", "z", None),
    }
    plan = df.filter("mes = 4 and c = 'y'").select("id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") <= 4 and plan.count("PartitionFilters: [isnotnull(mes") == plan.count("FileScan parquet")
    assert dict(drift.open_unified(spark, root, {"id": "decimal(20,1)"}).dtypes)["id"] == "decimal(20,1)"


def test_common_types():
    from pyspark.sql import types as T

    from laborlens.sources.drift import common_type as wider

    kinds = {
        ("int", "bigint"): "bigint", ("bigint", "double"): "double", ("float", "int"): "double", ("boolean", "int"): "int",
        ("decimal(10,2)", "int"): "decimal(12,2)", ("decimal(10,2)", "double"): "double", ("decimal(38,30)", "bigint"): "double",
        ("date", "timestamp"): "timestamp", ("date", "int"): "string", ("string", "double"): "string", ("void", "date"): "date",
    }
    for (a, b), want in kinds.items():
        x, y = (T.NullType() if k == "void" else T._parse_datatype_string(k) for k in (a, b))
        assert wider(x, y).simpleString() == wider(y, x).simpleString() == want
    try:
        wider(T.ArrayType(T.IntegerType()), T.StringType())
    except ValueError:
        return
    raise AssertionError


def test_long_table_is_written_once_and_in_order(spark, tmp_path):
    """Any number of tables from one evaluation of the source; files follow the published order."""
    root, key = str(tmp_path / "long"), "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    count = spark.sparkContext.accumulator(0)
    source = spark.range(150_000).selectExpr("CASE id % 3 WHEN 0 THEN 'a b' WHEN 1 THEN 'c' END AS tabla", "id * 7919 % 150011 AS v", "sha2(string(id), 256) AS s")

    def seen(batches):
        for b in batches:
            count.add(b.num_rows)
            yield b

    spark.conf.set(key, "200KB")
    try:
        bundle.write_long(source.mapInArrow(seen, source.schema), root, ["v"])
    finally:
        spark.conf.unset(key)
    assert count.value == 150_000
    assert bundle.names(spark, root) == ["a b", "c"]
    for name in ("a b", "c"):
        one = bundle.read_long(spark, root, [name])
        parts = one.select("v", F.col("_metadata.file_name").alias("f"), F.monotonically_increasing_id().alias("i")).collect()
        assert len({r.f for r in parts}) > 1
        values = [r.v for r in sorted(parts, key=lambda r: (r.f, r.i))]
        assert values == sorted(values) and len(values) == 50_000
    again = bundle.split(bundle.read_long(spark, root), ["c"])["c"]
    assert again.count() == 50_000 and again.columns == ["v", "s"]
    try:
        bundle.read_long(spark, root, ["c", "d"])
    except ValueError as e:
        assert "d" in str(e)
        return
    raise AssertionError


def test_distinct_counts_roll_up(spark):
    from laborlens.operators import distinct

    rows = spark.range(40_000).selectExpr("id * 37 % 9001 * 10 AS f", "int(id % 5) AS a", "nullif(id % 4, 0) AS b", "id % 3 AS pidx")
    rows = rows.unionByName(spark.sql("SELECT CAST(NULL AS BIGINT) f, 1 a, 1L b, 0L pidx"))
    sets = {"total": [], "a": ["a"], "ab": ["a", "b"]}
    got = distinct.count_distinct(rows, "f", sets, ["pidx"]).collect()
    for name, cols in sets.items():
        want = rows.groupBy("pidx", *cols).agg(F.countDistinct("f").alias("n")).collect()
        mine = sorted(str((r.pidx, *(r[c] for c in cols), r.n_distinct)) for r in got if r.tabla == name)
        assert mine == sorted(str(tuple(r)) for r in want)
    numbered = distinct.dense(rows.withColumn("f", F.col("f") * 1_000_003), "f").collect()
    assert len({r.numero for r in numbered}) == len(numbered) == 9001 and max(r.numero for r in numbered) < 9001 + 32_768 * 8
