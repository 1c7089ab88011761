"""Lagged correlation and two-regressor least squares, per group of series.

Sums of squares and products come from Spark's mergeable covariance aggregates,
so any number of groups and lags is one aggregation; coefficients follow in
closed form from column arithmetic.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from laborlens.functions import periods as P
from laborlens.functions import scalars as X


def _lagged(df: DataFrame, cols: list[str], lags, by: list[str], keep: list[str]) -> DataFrame:
    """One row per observation and lag; negative lags look ahead."""
    names = [(k, c, f"_{c}_{i}") for i, k in enumerate(lags) for c in cols]
    shifted = df.select(
        *by, *keep, *[P.shifted(c, k, by).alias(n) for k, c, n in names]
    )
    rows = [
        F.struct(
            F.lit(k).alias("lag"),
            *[F.col(n).alias(f"{c}_lag") for kk, c, n in names if kk == k],
        )
        for k in lags
    ]
    return shifted.select(*by, *keep, F.explode(F.array(*rows)).alias("l")).select(
        *by, *keep, "l.*"
    )


def lagged_corr(df: DataFrame, x: str, y: str, max_lag: int, by: list[str]) -> DataFrame:
    """Pearson correlation of ``y`` with ``x`` shifted by -max_lag..max_lag rows."""
    rows = df.dropna(subset=[x, y])
    lagged = _lagged(rows, [x], range(-max_lag, max_lag + 1), by, [y])
    pairs = lagged.dropna(subset=[f"{x}_lag"])
    return pairs.groupBy(*by, "lag").agg(F.corr(f"{x}_lag", y).alias("corr"), F.count("*").alias("n"))


def _moments(y: str, x1: str, x2: str) -> list[Column]:
    return [
        F.count("*").alias("n"),
        F.avg(y).alias("my"),
        F.avg(x1).alias("m1"),
        F.avg(x2).alias("m2"),
        F.var_pop(y).alias("syy"),
        F.var_pop(x1).alias("s11"),
        F.var_pop(x2).alias("s22"),
        F.covar_pop(x1, x2).alias("s12"),
        F.covar_pop(x1, y).alias("s1y"),
        F.covar_pop(x2, y).alias("s2y"),
    ]


def _coefficients(m: DataFrame) -> DataFrame:
    """b0, b1, b2 from (co)variances; collinear or too few observations give NULL."""
    det = F.col("s11") * F.col("s22") - F.col("s12") * F.col("s12")
    det = F.when(det > F.lit(1e-12) * F.col("s11") * F.col("s22"), det)
    b1 = X.ratio(F.col("s1y") * F.col("s22") - F.col("s2y") * F.col("s12"), det)
    b2 = X.ratio(F.col("s2y") * F.col("s11") - F.col("s1y") * F.col("s12"), det)
    return m.withColumns({"b1": b1, "b2": b2}).withColumn(
        "b0", F.col("my") - F.col("b1") * F.col("m1") - F.col("b2") * F.col("m2")
    )


def lagged_ols(df: DataFrame, y: str, x1: str, x2: str, lags: list[int], by: list[str]) -> DataFrame:
    """Fit of ``y`` on lagged ``x1`` and ``x2``, per group and lag."""
    rows = _lagged(df, [x1, x2], lags, by, [y]).dropna(subset=[y, f"{x1}_lag", f"{x2}_lag"])
    fit = _coefficients(
        rows.groupBy(*by, "lag").agg(*_moments(y, f"{x1}_lag", f"{x2}_lag"))
    )
    n, params = F.col("n").cast("double"), 3
    # A residual sum below zero is rounding on a perfect fit.
    mse = F.greatest(
        F.lit(0.0),
        F.col("syy") - F.col("b1") * F.col("s1y") - F.col("b2") * F.col("s2y"),
    )
    mse = F.when(F.col("b1").isNotNull() & (n > params), mse)
    r2 = 1 - X.ratio(mse, F.col("syy"))
    loglik2 = n * (math.log(2 * math.pi) + F.when(mse > 0, F.ln(mse)) + 1)
    return fit.select(
        *by,
        "lag",
        "n",
        "b0",
        "b1",
        "b2",
        r2.alias("r2"),
        (1 - (1 - r2) * X.ratio(n - 1, n - params)).alias("r2_adj"),
        (loglik2 + 2 * (params + 1)).alias("aic"),
        (loglik2 + F.ln(n) * (params + 1)).alias("bic"),
        F.sqrt(mse).alias("rmse"),
    )


def best_lag(fits: DataFrame, by: list[str]) -> DataFrame:
    """Lag of least AIC per group; the smaller lag wins a tie."""
    ranked = F.struct("aic", "lag")
    return (
        fits.filter(F.col("aic").isNotNull())
        .groupBy(*by)
        .agg(F.min(ranked).alias("m"))
        .select(*by, F.col("m.lag").alias("lag"), F.col("m.aic").alias("aic"))
    )


def predict_holdout(
    df: DataFrame, y: str, x1: str, x2: str, by: list[str], months: int = 12
) -> DataFrame:
    """Fit on all but the last months of a group, predict every row.

    ``muestra`` tells train rows from test rows and from those without a target
    (nowcast). The fit is one aggregation per group, joined back by group.
    """
    # Series rows: at most one per month in each group.
    last = F.max("pidx").over(W.partitionBy(*by))
    marked = df.select(*by, "pidx", y, x1, x2, last.alias("_last"))
    train = F.col("pidx") <= F.col("_last") - months
    sample = F.when(F.col(y).isNull(), "nowcast").when(train, "train").otherwise("test")
    marked = marked.withColumn("muestra", sample).drop("_last")
    fit = _coefficients(
        marked.filter("muestra = 'train'")
        .dropna(subset=[x1, x2])
        .groupBy(*by)
        .agg(*_moments(y, x1, x2))
    ).select(*by, "b0", "b1", "b2")
    pred = F.col("b0") + F.col("b1") * F.col(x1) + F.col("b2") * F.col(x2)
    return marked.join(fit, by, "left").withColumn("pred", pred).drop("b0", "b1", "b2")


def holdout_eval(predicted: DataFrame, y: str, by: list[str]) -> DataFrame:
    """Mean absolute and root mean squared error on the test rows."""
    e = F.col("pred") - F.col(y)
    return (
        predicted.filter("muestra = 'test'")
        .groupBy(*by)
        .agg(F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"))
    )
