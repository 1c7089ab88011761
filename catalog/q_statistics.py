"""R rows: grouped statistics. Series: monthly jobs, pay and days of each section."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import roles
from catalog.registry import R, cte, query, rounded, sql
from laborlens.operators import grouped_stats

BY = ["seccion"]
LAGS = [0, 1, 2, 3]


def series(spark, sf):
    """Target (jobs) unknown in the last two months of each section."""
    cells = roles.panel(spark, sf).groupBy("seccion", "pidx").agg(
        F.count("*").cast("double").alias("y0"),
        (F.sum("monto") / 10000).alias("x1"),
        F.sum("dias").cast("double").alias("x2"),
    )
    return cells.withColumn("y", F.when(F.col("pidx") <= 24020, F.col("y0"))).drop("y0")


cte(
    "series",
    """SELECT seccion, pidx, CASE WHEN pidx <= 24020 THEN y0 END AS y, x1, x2 FROM (
SELECT seccion, pidx, CAST(COUNT(*) AS DOUBLE) AS y0, SUM(monto) / 10000 AS x1, CAST(SUM(dias) AS DOUBLE) AS x2
FROM panel GROUP BY seccion, pidx)""",
    "panel",
)


def _lag(c: str, k: int) -> str:
    f = f"LAG({c}, {k})" if k >= 0 else f"LEAD({c}, {-k})"
    return f"{f} OVER (PARTITION BY seccion ORDER BY pidx)"


@query(
    "R01_lagged_corr",
    sql(
        f"SELECT seccion, lag, {R('corr(x, y)', 'corr')}, COUNT(*) AS n FROM ("
        + " UNION ALL ".join(
            f"SELECT seccion, {k} AS lag, {_lag('x1', k)} AS x, y FROM series WHERE y IS NOT NULL" for k in range(-6, 7)
        )
        + ") WHERE x IS NOT NULL GROUP BY seccion, lag",
        "series",
    ),
)
def lagged_corr(spark, sf):
    return rounded(grouped_stats.lagged_corr(series(spark, sf), "x1", "y", 6, BY))


cte(
    "lagged",
    " UNION ALL ".join(
        f"SELECT seccion, {k} AS lag, y, {_lag('x1', k)} AS a, {_lag('x2', k)} AS b FROM series" for k in LAGS
    ),
    "series",
)
# Normal equations on raw sums, centred on the means of each group.
cte(
    "moments",
    """SELECT seccion, lag, COUNT(*) AS n, SUM(dy * dy) AS syy, SUM(da * da) AS saa, SUM(db * db) AS sbb, SUM(da * db) AS sab,
  SUM(da * dy) AS say, SUM(db * dy) AS sby, MAX(my) AS my, MAX(ma) AS ma, MAX(mb) AS mb
FROM (SELECT *, y - my AS dy, a - ma AS da, b - mb AS db FROM (SELECT *, AVG(y) OVER w AS my, AVG(a) OVER w AS ma,
        AVG(b) OVER w AS mb FROM lagged WHERE y IS NOT NULL AND a IS NOT NULL AND b IS NOT NULL
        WINDOW w AS (PARTITION BY seccion, lag)))
GROUP BY seccion, lag""",
    "lagged",
)
cte(
    "fit",
    """SELECT *, syy - b1 * say - b2 * sby AS rss, my - b1 * ma - b2 * mb AS b0
FROM (SELECT *, (say * sbb - sby * sab) / (saa * sbb - sab * sab) AS b1,
        (sby * saa - say * sab) / (saa * sbb - sab * sab) AS b2 FROM moments)""",
    "moments",
)


@query(
    "R02_lagged_ols",
    sql(
        f"""SELECT seccion, lag, n, {R('b0', decimals=4)}, {R('b1', decimals=4)}, {R('b2', decimals=4)},
  {R('1 - rss / syy', 'r2', 4)}, {R('1 - (rss / syy) * (n - 1) / (n - 3)', 'r2_adj', 4)},
  {R('n * (ln(2 * pi()) + ln(rss / n) + 1) + 8', 'aic', 4)},
  {R('n * (ln(2 * pi()) + ln(rss / n) + 1) + 4 * ln(n)', 'bic', 4)}, {R('sqrt(rss / n)', 'rmse', 4)} FROM fit""",
        "fit",
    ),
)
def lagged_ols(spark, sf):
    return rounded(grouped_stats.lagged_ols(series(spark, sf), "y", "x1", "x2", LAGS, BY), 4)


@query(
    "R02_best_lag",
    sql(
        f"""SELECT seccion, arg_min(lag, aic) AS lag, {R('MIN(aic)', 'aic', 4)}
FROM (SELECT *, n * (ln(2 * pi()) + ln(rss / n) + 1) + 8 AS aic FROM fit) GROUP BY seccion""",
        "fit",
    ),
)
def best_lag(spark, sf):
    fits = grouped_stats.lagged_ols(series(spark, sf), "y", "x1", "x2", LAGS, BY)
    return rounded(grouped_stats.best_lag(fits, BY), 4)


cte(
    "marked",
    """SELECT *, CASE WHEN y IS NULL THEN 'nowcast' WHEN pidx <= MAX(pidx) OVER (PARTITION BY seccion) - 12 THEN 'train'
  ELSE 'test' END AS muestra FROM series""",
    "series",
)
cte(
    "train_fit",
    """SELECT *, my - b1 * ma - b2 * mb AS b0 FROM (
SELECT *, (say * sbb - sby * sab) / (saa * sbb - sab * sab) AS b1, (sby * saa - say * sab) / (saa * sbb - sab * sab) AS b2
FROM (SELECT seccion, SUM(da * da) AS saa, SUM(db * db) AS sbb, SUM(da * db) AS sab, SUM(da * dy) AS say, SUM(db * dy) AS sby,
        MAX(my) AS my, MAX(ma) AS ma, MAX(mb) AS mb
      FROM (SELECT *, y - my AS dy, x1 - ma AS da, x2 - mb AS db FROM (SELECT *, AVG(y) OVER w AS my, AVG(x1) OVER w AS ma,
              AVG(x2) OVER w AS mb FROM marked WHERE muestra = 'train' WINDOW w AS (PARTITION BY seccion)))
      GROUP BY seccion))""",
    "marked",
)
cte(
    "predicted",
    """SELECT m.seccion, pidx, y, x1, x2, muestra, b0 + b1 * x1 + b2 * x2 AS pred
FROM marked m LEFT JOIN train_fit f ON m.seccion = f.seccion""",
    "marked", "train_fit",
)


def predicted(spark, sf):
    return grouped_stats.predict_holdout(series(spark, sf), "y", "x1", "x2", BY)


@query(
    "R03_predict_holdout",
    sql(f"SELECT seccion, pidx, muestra, {R('y')}, {R('pred', decimals=4)} FROM predicted", "predicted"),
)
def predict_holdout(spark, sf):
    return rounded(predicted(spark, sf).drop("x1", "x2"), 4)


@query(
    "R03_holdout_eval",
    sql(
        f"""SELECT seccion, {R('AVG(abs(pred - y))', 'mae', 4)}, {R('sqrt(AVG((pred - y) * (pred - y)))', 'rmse', 4)}
FROM predicted WHERE muestra = 'test' GROUP BY seccion""",
        "predicted",
    ),
)
def holdout_eval(spark, sf):
    return rounded(grouped_stats.holdout_eval(predicted(spark, sf), "y", BY), 4)
