"""Reading months whose columns changed their types over the years."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from laborlens.sources import tables

INTEGERS = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]
#: Decimal digits of an integer type.
DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}


def common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type that holds the values of both: the wider number, a timestamp for dates, text for all other pairs.

    Nested types must agree.
    """
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    ranks = [INTEGERS.index(type(t)) if type(t) in INTEGERS else None for t in (a, b)]
    if None not in ranks:
        return (a, b)[ranks[1] > ranks[0]]
    numbers = (T.NumericType, T.BooleanType)
    if isinstance(a, numbers) and isinstance(b, numbers):
        if isinstance(a, T.BooleanType) or isinstance(b, T.BooleanType):
            return b if isinstance(a, T.BooleanType) else a
        if isinstance(a, T.DecimalType) or isinstance(b, T.DecimalType):
            exact = [t if isinstance(t, T.DecimalType) else T.DecimalType(DIGITS[type(t)], 0) for t in (a, b) if type(t) in DIGITS or isinstance(t, T.DecimalType)]
            if len(exact) == 2:
                scale = max(t.scale for t in exact)
                whole = max(t.precision - t.scale for t in exact)
                return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.DoubleType()
        return T.DoubleType()
    times = (T.DateType, T.TimestampType, T.TimestampNTZType)
    if isinstance(a, times) and isinstance(b, times):
        return T.TimestampType() if T.TimestampType() in (a, b) else T.TimestampNTZType()
    if any(isinstance(t, (T.StructType, T.ArrayType, T.MapType, T.BinaryType)) for t in (a, b)):
        raise ValueError(f"no common type of {a.simpleString()} and {b.simpleString()}")
    return T.StringType()


def _agree(a: T.StructType, b: T.StructType) -> bool:
    kinds = {f.name: f.dataType for f in b.fields}
    return all(kinds.get(f.name, f.dataType) == f.dataType for f in a.fields)


def schema_groups(spark: SparkSession, root: str, paths: list[str]) -> list[tuple[list[str], T.StructType]]:
    """Paths by schema: those of a group give each column one type (some may lack it).

    Spark merges the footers of many paths in one distributed job, and refuses where types differ; then each half is tried
    alone, down to the files of one folder. Few changes of type over many months take few tries. Groups that agree are put
    together again.
    """
    reader = spark.read.option("mergeSchema", True).option("basePath", root)

    def merged(some: list[str]) -> list[tuple[list[str], T.StructType]]:
        try:
            return [(some, reader.parquet(*some).schema)]
        except Exception as e:  # an analysis or a job error, by version
            if "CANNOT_MERGE" not in str(e):
                raise
            parts = some if len(some) > 1 else sorted(r.path for r in tables.month_files(spark, some[0]).select("path").collect())
            if len(parts) < 2:
                raise
        half = len(parts) // 2
        return merged(parts[:half]) + merged(parts[half:])

    groups: list[tuple[list[str], T.StructType]] = []
    for some, schema in merged(paths):
        for k, (others, known) in enumerate(groups):
            if _agree(known, schema):
                added = [f for f in schema.fields if f.name not in known.names]
                groups[k] = (others + some, T.StructType(known.fields + added))
                break
        else:
            groups.append((some, schema))
    return groups


def unified_schema(schemas: list[T.StructType], types: dict[str, T.DataType | str] | None = None) -> dict[str, T.DataType]:
    """Column -> type over all schemas, by name; ``types`` overrides."""
    out: dict[str, T.DataType] = {}
    for schema in schemas:
        for f in schema.fields:
            out[f.name] = common_type(out[f.name], f.dataType) if f.name in out else f.dataType
    for name, kind in (types or {}).items():
        if name in out:
            out[name] = T._parse_datatype_string(kind) if isinstance(kind, str) else kind
    return out


def open_unified(spark: SparkSession, root: str, types: dict[str, T.DataType | str] | None = None) -> DataFrame:
    """A table stored by month whose columns come and go and change their types, as one table by name.

    Files are grouped by schema and each group is one scan, cast to the types that hold all months; a column that a month
    lacks is null there. ``types`` sets types of one's own, for ids that some months hold as DOUBLE, say; values that do not
    fit make the query fail. Filters on columns that no group casts, and on anno and mes, reach the scans of all groups.
    Paths are the month folders; where files of one folder differ, its files.
    """
    files = tables.month_files(spark, root).select("path")
    folder = F.regexp_replace("path", r"/[^/]*$", "")
    folders = sorted(r.p for r in files.select(folder.alias("p")).distinct().collect())
    groups = schema_groups(spark, root, folders)
    wanted = unified_schema([s for _, s in groups], types)

    def scan(group: tuple[list[str], T.StructType]) -> DataFrame:
        own, schema = group
        df = spark.read.option("basePath", root).schema(schema).parquet(*own)

        def column(name: str, kind: T.DataType) -> Column:
            if name not in schema.names:
                return F.lit(None).cast(kind).alias(name)
            return F.col(name) if schema[name].dataType == kind else F.col(name).cast(kind).alias(name)

        return df.select(*[column(n, k) for n, k in wanted.items()])

    return reduce(DataFrame.unionByName, [scan(g) for g in groups])
