"""Turnover rates, variations and incidences of every breakdown at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laborlens.functions import periods as P
from laborlens.functions import scalars as X
from laborlens.operators import reshape

FLOW_COLS = ["pt", "pt_ent_12", "pt_sal_12"]
NOT_CLASSES = ["pidx", *FLOW_COLS, "pt_total_12"]


def _series_keys(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in NOT_CLASSES] or ["_all"]


def _with_key(df: DataFrame) -> DataFrame:
    """A single national series still gets a partition key."""
    return df.withColumn("_all", F.lit(0)) if _series_keys(df) == ["_all"] else df


def join_stock_flows(stock: DataFrame, flows: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer on keys where NULL equals NULL; an absent side stays NULL.

    Stacked and summed: no join, and NULL classes group like any other value.
    """
    both = stock.select(*keys, "pt").unionByName(
        flows.select(*keys, "pt_ent_12", "pt_sal_12"), allowMissingColumns=True
    )
    return both.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in FLOW_COLS])


def rates(df: DataFrame, calendar: bool = False) -> DataFrame:
    """Five rates and sixteen variations per series.

    Rates of earlier months are rebuilt from earlier stocks and flows, so all
    columns come from one window over stocks and flows.
    """
    df = _with_key(df)
    by = _series_keys(df)

    def back(c: str, k: int) -> Column:
        return P.shifted(c, k, by, calendar).alias(f"{c}_{k}")

    lags = [back("pt", k) for k in (1, 12, 13, 24)]
    lags += [back(c, k) for c in FLOW_COLS[1:] for k in (1, 12)]
    wide = df.select("*", *[c.alias(f"_{i}") for i, c in enumerate(lags)])
    pt1, pt12, pt13, pt24, ent1, ent12, sal1, sal12 = [F.col(f"_{i}") for i in range(8)]

    def five(ent: Column, sal: Column, den: Column) -> dict[str, Column]:
        t_ent, t_sal = X.ratio(ent, den), X.ratio(sal, den)
        return {
            "t_ent": t_ent,
            "t_sal": t_sal,
            "t_rot": (t_ent + t_sal) / 2,
            "t_rot_neta": t_ent - t_sal,
            "t_per": 1 - t_sal,
        }

    ent, sal = F.col("pt_ent_12"), F.col("pt_sal_12")
    now = five(ent, sal, pt12)
    past = {12: five(ent12, sal12, pt24), 1: five(ent1, sal1, pt13)}
    levels = {12: (pt12, ent12, sal12), 1: (pt1, ent1, sal1)}
    cols = dict(now)
    for k in (12, 1):
        for name, level, before in zip(("pt", "pt_ent", "pt_sal"), (F.col("pt"), ent, sal), levels[k]):
            cols[f"var{k}_{name}"] = X.growth(level, before)
        for name in ("t_ent", "t_rot_neta", "t_rot", "t_sal", "t_per"):
            cols[f"var{k}_{name}"] = now[name] - past[k][name]
    return wide.withColumns(cols).drop("_all", *[f"_{i}" for i in range(8)])


def shifted_total(stock: DataFrame) -> DataFrame:
    """Total stock shown twelve calendar months later."""
    return stock.select((F.col("pidx") + 12).alias("pidx"), F.col("pt").alias("pt_total_12"))


def own_total(df: DataFrame) -> DataFrame:
    """``pt_total_12`` from the 'total' rows of the long table itself.

    They are a branch of their own, one row a month, that all cells look up, so a
    month's cells never meet in one task. ``df`` is evaluated for both: it should
    start from stored cells, as in the monthly chain.
    """
    total = shifted_total(df.filter("tabla = 'total'"))
    return df.join(P.by_month(total), "pidx", "left")


def incidence(df: DataFrame, total_shifted: DataFrame | None = None) -> DataFrame:
    """Flows over the total stock of a year before."""
    if total_shifted is not None:
        df = df.join(P.by_month(P.one_per_month(total_shifted, ["pidx"])), "pidx", "left")
    inc_ent, inc_sal = X.ratio("pt_ent_12", "pt_total_12"), X.ratio("pt_sal_12", "pt_total_12")
    return df.withColumns(
        {
            "inc_ent": inc_ent,
            "inc_sal": inc_sal,
            "inc_rot": (inc_ent + inc_sal) / 2,
            "inc_rot_neta": inc_ent - inc_sal,
            "inc_per": 1 - inc_sal,
        }
    )


def rotation_incidence_change(long: DataFrame) -> DataFrame:
    """``inc_rot``, its value a year back and the difference, from the long form."""
    fixed = ["anno", "mes", "fecha", "indicador", "valor"]
    keys = [c for c in long.columns if c not in fixed]
    return (
        long.filter("indicador = 'inc_rot'")
        .withColumn("_all", F.lit(0))
        .select(
            "fecha",
            *keys,
            F.col("valor").alias("inc_rot"),
            P.shifted("valor", 12, keys + ["_all"], order="fecha").alias("inc_rot_12"),
        )
        .withColumn("inc_var_trl", F.col("inc_rot") - F.col("inc_rot_12"))
    )


def append_rotation_change(
    long: DataFrame, change: DataFrame, keep_duplicate_inc_rot: bool = False
) -> DataFrame:
    """Long table plus the rotation-incidence rows, with their year and month."""
    cols = ["inc_rot_12", "inc_var_trl"]
    if keep_duplicate_inc_rot:
        cols = ["inc_rot", *cols]
    else:
        change = change.drop("inc_rot")
    return long.unionByName(reshape.to_long(change, columns=cols))


def indicators_of(base: DataFrame) -> DataFrame:
    """All indicators in long form, from stock and flows of all breakdowns.

    ``tabla`` names the breakdown and is one more partition key of the windows,
    so all tables come from one pass.
    """
    by = [c for c in base.columns if c not in NOT_CLASSES]
    wide = incidence(rates(own_total(base)))
    wide = wide.withColumn("inc_rot_12", P.shifted("inc_rot", 12, by)).withColumn(
        "inc_var_trl", F.col("inc_rot") - F.col("inc_rot_12")
    )
    return reshape.to_long(wide)


def indicators(stock: DataFrame, flows: DataFrame) -> DataFrame:
    """The same from separate long tables of stocks and flows."""
    keys = [c for c in stock.columns if c != "pt"]
    return indicators_of(join_stock_flows(stock, flows, keys))
