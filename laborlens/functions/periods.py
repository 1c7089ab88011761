"""Months as integers: ``pidx = 12*year + month - 1``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from laborlens import schema as S


def pidx(anno, mes) -> Column:
    """Integer month index of a (year, month) pair."""
    return (_c(anno) * 12 + _c(mes) - 1).cast("int")


def pidx_of_date(fecha) -> Column:
    return pidx(F.year(_c(fecha)), F.month(_c(fecha)))


def yyyymm(anno, mes) -> Column:
    return (_c(anno) * 100 + _c(mes)).cast("int")


def month_start(p) -> Column:
    """First day of a month index."""
    p = _c(p)
    return F.make_date(F.floor(p / 12).cast("int"), (p % 12 + 1).cast("int"), F.lit(1))


def anno_of(p) -> Column:
    return F.floor(_c(p) / 12).cast("int")


def mes_of(p) -> Column:
    return (_c(p) % 12 + 1).cast("int")


def from_period(desde: tuple[int, int] = S.START_PERIOD, anno="anno", mes="mes") -> Column:
    """Lower bound written on (year, month) so partition pruning applies."""
    y, m = desde
    return (_c(anno) > y) | ((_c(anno) == y) & (_c(mes) >= m))


def with_pidx(df: DataFrame) -> DataFrame:
    return df if "pidx" in df.columns else df.withColumn("pidx", pidx("anno", "mes"))


def available_periods(df: DataFrame, desde: tuple[int, int] | None = S.START_PERIOD) -> DataFrame:
    """Distinct periods from a lower bound, in order, with their position.

    Reads only (anno, mes): on a month-partitioned table no column is read from
    the files, otherwise two are, with a map-side distinct.
    """
    if desde is not None:
        df = df.filter(from_period(desde))
    months = df.select("anno", "mes").distinct()
    # One row per calendar month reaches this window, whatever the input size.
    order = W.orderBy("anno", "mes")
    return months.select(
        "anno",
        "mes",
        yyyymm("anno", "mes").alias("periodo_int"),
        pidx("anno", "mes").alias("pidx"),
        F.dense_rank().over(order).cast("int").alias("pos"),
    )


def by_month(df: DataFrame) -> DataFrame:
    """Broadcast a table with one row per calendar month; tables from outside go through :func:`one_per_month` first.

    Its size is bounded by the calendar (years 1 to 9999 are 120,000 rows of a
    few numbers, about 3 MB), not by the panel. Without the hint the panel would
    be shuffled on the month, a key of about a hundred values.
    """
    return F.broadcast(df)


def one_per_month(df: DataFrame, keys: list[str]) -> DataFrame:
    """A month table given by the caller, for :func:`by_month`: rows that repeat are one, two different rows of a month
    make the job fail, since each would multiply the panel's rows."""
    rest = [c for c in df.columns if c not in keys]
    months = df.distinct().groupBy(*keys).agg(F.count("*").alias("_n"), *[F.first(c).alias(c) for c in rest])
    clear = F.assert_true(F.col("_n") == 1, "a month has two different rows").isNull()
    return months.filter(clear).select(*df.columns)


def period_links(periods: DataFrame, calendar: bool = False, lag: int = 12) -> DataFrame:
    """One row per month: ``pidx``, ``pos`` and the month shown ``lag`` steps later.

    Steps count available periods, or calendar months when ``calendar`` is set.
    ``pidx_next`` is NULL where the panel ends first, ``has_past`` tells whether
    a period ``lag`` steps back can exist.
    """
    order = W.orderBy("pidx")
    months = periods.select("pidx").distinct()
    if calendar:
        later = F.max("pidx").over(order.rangeBetween(lag, lag))
        first = F.min("pidx").over(order)
        return months.select(
            "pidx",
            F.col("pidx").alias("pos"),
            later.alias("pidx_next"),
            (F.col("pidx") - lag >= first).alias("has_past"),
        )
    pos = F.row_number().over(order).cast("int")
    return months.select(
        "pidx",
        pos.alias("pos"),
        F.lead("pidx", lag).over(order).alias("pidx_next"),
        (pos > lag).alias("has_past"),
    )


def shifted(col, k: int, by: list[str], calendar: bool = False, order: str = "pidx") -> Column:
    """Value ``k`` steps back in a series: ``k`` rows, or ``k`` calendar months."""
    w = W.partitionBy(*by).orderBy(order)
    if calendar:
        return F.max(_c(col)).over(w.rangeBetween(-k, -k))
    return F.lag(_c(col), k).over(w)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x if isinstance(x, Column) else F.lit(x)
