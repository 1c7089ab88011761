"""Formal wage mass per month and its real indices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from laborlens import schema as S
from laborlens.functions import periods as P
from laborlens.functions import scalars as X
from laborlens.sources.tables import stage

ACCURACY = 10_000
MARGIN = 10 / ACCURACY
#: Ranges of equal width that a bracket is cut into.
RANGES = 1024


def bracket(value: str) -> list[Column]:
    """Aggregates ``exact_median`` needs: count, extremes, and two values around the median."""
    around = [0.5 - MARGIN, 0.5 + MARGIN]
    return [
        F.count(value).alias("_n"),
        F.min(value).alias("_min"),
        F.max(value).alias("_max"),
        F.percentile_approx(value, around, ACCURACY).alias("_q"),
    ]


def _counted(df: DataFrame, bounds: DataFrame, value: str, by: str) -> DataFrame:
    """Values inside each month's bracket with their number and range, and what lies below as one block (range -1)."""
    v = F.col("_v")
    counts = (
        df.select(by, F.col(value).alias("_v"))
        .join(P.by_month(bounds.select(by, "_n", "_lo", "_hi")), by)
        .filter(v <= F.col("_hi"))
        .groupBy(by, "_n", "_lo", "_hi", F.when(v >= F.col("_lo"), v).alias("_v"))
        .agg(F.count("*").alias("_k"))
    )
    step = (F.col("_hi") - F.col("_lo")) / RANGES
    place = F.when(step > 0, F.least(F.floor((v - F.col("_lo")) / step), F.lit(RANGES - 1))).otherwise(0)
    return counts.withColumn("_range", F.when(v.isNull(), -1).otherwise(place).cast("int"))


def _halves() -> tuple[Column, Column]:
    """Ranks (from 0) of the one or two values in the middle."""
    return F.floor((F.col("_n") - 1) / 2), F.floor(F.col("_n") / 2)


def _refined(df: DataFrame, bounds: DataFrame, counts: DataFrame, value: str, by: str) -> DataFrame | None:
    """New brackets for the months whose middle lies outside theirs, or None.

    What lies on the side where the middle is is counted by ranges of equal width, one number each; the range that holds the
    middle is the new bracket. Months are few, so their verdict comes to the driver.
    """
    first, second = _halves()
    seen = counts.groupBy(by).agg(F.sum("_k").alias("_upto"), F.sum(F.when(F.col("_range") < 0, F.col("_k"))).alias("_below"))
    joined = bounds.join(P.by_month(seen), by, "left").filter("_n > 0")
    below, upto = F.coalesce("_below", F.lit(0)), F.coalesce("_upto", F.lit(0))
    side = F.when(first < below, "low").when(second >= upto, "high")
    missed = joined.withColumn("_side", side).filter("_side is not null")
    missed = missed.select(
        by, "_n", "_min", "_max", first.alias("_first"), second.alias("_second"),
        F.when(F.col("_side") == "low", F.col("_min")).otherwise(F.least("_hi", "_lo")).cast("double").alias("_from"),
        F.when(F.col("_side") == "low", F.greatest("_lo", "_hi")).otherwise(F.col("_max")).cast("double").alias("_to"),
    )
    rows = missed.collect()
    if not rows:
        return None
    missed = df.sparkSession.createDataFrame(rows, missed.schema)
    v = F.col("_v")
    step = (F.col("_to") - F.col("_from")) / RANGES
    place = F.when(v < F.col("_from"), -1).when(step > 0, F.least(F.floor((v - F.col("_from")) / step), F.lit(RANGES - 1))).otherwise(0)
    wide = df.select(by, F.col(value).alias("_v")).join(P.by_month(missed), by).filter(v <= F.col("_to"))
    sums = wide.groupBy(by, place.cast("int").alias("_range")).agg(
        F.count("*").alias("_s"), F.min("_v").alias("_least"), F.max("_v").alias("_most")
    )
    # RANGES + 1 rows a month at most.
    end = F.sum("_s").over(W.partitionBy(by).orderBy("_range"))
    hit = sums.withColumn("_end", end).join(P.by_month(missed), by)
    hit = hit.filter((F.col("_end") - F.col("_s") <= F.col("_second")) & (F.col("_first") < F.col("_end")))
    return hit.groupBy(by).agg(
        F.first("_n").alias("_n"), F.first("_min").alias("_min"), F.first("_max").alias("_max"),
        F.min("_least").alias("_lo"), F.max("_most").alias("_hi"),
    )


def exact_median(
    df: DataFrame, summary: DataFrame, value: str, by: str = "pidx", name: str = "mediana"
) -> DataFrame:
    """``summary`` (one row per month, with ``bracket``) plus the median of each month.

    No month is sorted or ranked in one task. A quantile sketch has bracketed
    the median between two values ten times wider apart than its rank error.
    Values inside the bracket (about 0.2 % of the rows) are counted one by one,
    smaller ones as a block. Counts are summed over a fixed number of ranges of
    the bracket, whose running sum names the one or two ranges that hold the
    median, and only the values of those are ranked, each range by itself.
    Where a bracket misses all the same, the side on which the median lies is cut
    into ranges, and the range that holds it is the next bracket, for those months
    alone. Both passes over ``df`` run here; their results are small tables.
    """
    summary = stage(summary)
    carried = [c for c in summary.columns if c not in (by, "_q", "_min", "_max")]
    bounds = summary.select(by, "_n", "_min", "_max", F.col("_q")[0].alias("_lo"), F.col("_q")[1].alias("_hi"))
    counts = stage(_counted(df, bounds, value, by))
    while (again := _refined(df, bounds, counts, value, by)) is not None:
        again = stage(again)
        counts = stage(counts.join(P.by_month(again.select(by)), by, "left_anti").unionByName(_counted(df, again, value, by)))
        bounds = bounds.join(P.by_month(again.select(by)), by, "left_anti").unionByName(again)
    first, second = _halves()
    # RANGES + 1 rows a month at most reach this window.
    months = W.partitionBy(by).orderBy("_range")
    sums = counts.groupBy(by, "_n", "_range").agg(F.sum("_k").alias("_s")).withColumn("_end", F.sum("_s").over(months))
    start = F.col("_end") - F.col("_s")
    wanted = sums.filter((start <= second) & (first < F.col("_end"))).select(by, "_range", start.alias("_before"))
    v = F.col("_v")
    w = W.partitionBy(by, "_range").orderBy(v.asc_nulls_first())
    ranked = counts.join(P.by_month(wanted), [by, "_range"])
    ranked = ranked.withColumn("_to", F.col("_before") + F.sum("_k").over(w)).withColumn("_from", F.col("_to") - F.col("_k"))

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("_from") <= rank) & (rank < F.col("_to")), v))

    middle = ranked.groupBy(by).agg(at(first).alias("_a"), at(second).alias("_b"))
    return (
        summary.select(by, *carried)
        .join(P.by_month(middle), by, "left")
        .withColumn(name, (F.col("_a") + F.col("_b")) / 2)
        .drop("_a", "_b", "_n")
    )


def wage_mass(panel: DataFrame, unique_key: bool = False, median: str = "exact") -> DataFrame:
    """Jobs, wage mass, mean and median pay and days of every month.

    The exact median reads the panel a second time; ``median="approx"`` takes the
    sketch's answer instead.
    """
    jobs = P.with_pidx(panel).select("pidx", *S.JOB, "monto", "dias")
    zero = F.lit(0.0)
    sketch = (
        bracket("monto")
        if median == "exact"
        else [F.percentile_approx("monto", 0.5, ACCURACY).alias("salario_mediano")]
    )
    summary = jobs.groupBy("pidx").agg(
        F.count("*").alias("empleo_formal"),
        F.coalesce(F.sum("monto"), zero).alias("masa_salarial"),
        F.coalesce(F.sum(X.day_adjusted("monto", "dias")), zero).alias("masa_salarial_ajustada"),
        F.avg("monto").alias("salario_promedio"),
        F.avg(X.daily_wage("monto", "dias")).alias("salario_diario_promedio"),
        F.avg("dias").alias("dias_promedio"),
        F.coalesce(F.sum("dias"), F.lit(0)).alias("dias_totales"),
        *sketch,
    )
    if median == "exact":
        summary = exact_median(jobs, summary, "monto", name="salario_mediano")
    if unique_key:
        return summary
    # Kept apart: in one aggregation the distinct count would give every job its own sketch.
    distinct = jobs.groupBy("pidx").agg(F.countDistinct(*S.JOB).alias("empleo_formal"))
    return summary.drop("empleo_formal").join(P.by_month(distinct), "pidx")


# Real series -> (nominal series, multiplier after deflation).
REAL = {
    "masa_salarial_real": ("masa_salarial", 1),
    "masa_salarial_ajustada_real": ("masa_salarial_ajustada", 1),
    "salario_promedio_real": ("salario_promedio", 1),
    "salario_mediano_real": ("salario_mediano", 1),
    "salario_diario_real": ("salario_diario_promedio", 100),
}
# Index -> series it is built from.
INDICES = {
    "iilf": "masa_salarial_real",
    "iilf_ajustado": "masa_salarial_ajustada_real",
    "payroll_index": "empleo_formal",
    "wage_index": "salario_promedio_real",
    "wage_daily_index": "salario_diario_real",
    "labor_intensity_index": "dias_totales",
}
COMPONENTS = ["payroll_index", "wage_index", "labor_intensity_index"]


def deflated(mass: DataFrame, prices: DataFrame) -> DataFrame:
    """Real series; a month without a price index gives NULL."""
    joined = mass.join(P.by_month(P.one_per_month(prices.select("pidx", "ipc"), ["pidx"])), "pidx", "left")
    return joined.withColumns({r: X.deflate(n, "ipc", k) for r, (n, k) in REAL.items()})


def base_means(real: DataFrame, base_year: int) -> DataFrame:
    """Mean of each index's source series over the base year: one row."""
    return real.filter(P.anno_of("pidx") == base_year).agg(
        *[F.avg(src).alias(f"base_{name}") for name, src in INDICES.items()]
    )


def wage_index(mass: DataFrame, prices: DataFrame, base_year: int = 2018) -> DataFrame:
    """Indices (base-year mean = 100), their variations and the adjustment gap."""
    # One national series: as many rows as months.
    real = deflated(mass, prices).withColumn("_serie", F.lit(0))
    year = W.partitionBy("_serie")

    def base(src: str) -> Column:
        return F.avg(F.when(P.anno_of("pidx") == base_year, F.col(src))).over(year)

    indexed = real.withColumns(
        {name: X.ratio(src, base(src)) * 100 for name, src in INDICES.items()}
    ).drop("_serie")
    return index_variations(indexed).withColumn(
        "brecha_ajuste", F.col("iilf_ajustado") - F.col("iilf")
    )


def series_variations(df: DataFrame, names: dict[str, tuple[str, int]], by: list[str]) -> DataFrame:
    """``names``: new column -> (series, months back)."""
    grown = {new: X.growth(c, P.shifted(c, k, by)) for new, (c, k) in names.items()}
    return df.withColumns(grown)


def index_variations(df: DataFrame) -> DataFrame:
    names = {
        "var_mensual_iilf": ("iilf", 1),
        "var_mensual_payroll": ("payroll_index", 1),
        "var_anual_iilf": ("iilf", 12),
        "var_anual_payroll": ("payroll_index", 12),
    }
    # One national series: as many rows as months.
    return series_variations(df.withColumn("_serie", F.lit(0)), names, ["_serie"]).drop("_serie")


def adjusted_variations(df: DataFrame, series: list[str], by: list[str]) -> DataFrame:
    """Monthly and yearly growth of seasonally adjusted series (``x_sa`` columns)."""
    names = {f"var_m_{s}": (s, 1) for s in series} | {f"var_a_{s}": (s, 12) for s in series}
    return series_variations(df, names, by)


def join_monthly(df: DataFrame, *tables: DataFrame) -> DataFrame:
    """Left joins of monthly series (macro indicators, nowcasts, monthly product)."""
    for t in tables:
        df = df.join(P.by_month(P.one_per_month(t, ["pidx"])), "pidx", "left")
    return df


# Columns of the published master table.
MASTER = [
    "iilf", "iilf_sa", "iilf_ajustado", "payroll_index", "payroll_sa", "wage_index", "wage_sa",
    "labor_intensity_index", "var_mensual_iilf", "var_anual_iilf", "var_m_iilf_sa",
    "var_a_iilf_sa", "imacec", "imacec_sa", "var_m_imacec_sa", "var_a_imacec_sa", "iva",
]


def master_table(adjusted: DataFrame, *monthly: DataFrame) -> DataFrame:
    """Published columns of the adjusted series with further monthly series."""
    cols = [c for c in MASTER if c in adjusted.columns]
    known = {"pidx", *cols}
    extra = [m.select("pidx", *[c for c in m.columns if c not in known]) for m in monthly]
    return join_monthly(adjusted.select("pidx", *cols), *extra)
