"""Wide and long forms of indicator tables."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laborlens.functions import periods as P
from laborlens.functions import scalars as X

INDICATOR = r"^pt|^t_|^var|^inc_"


def indicator_columns(df: DataFrame, pattern: str = INDICATOR) -> list[str]:
    return [c for c in df.columns if re.search(pattern, c)]


def to_long(
    df: DataFrame,
    pattern: str = INDICATOR,
    renames: dict[str, str] | None = None,
    columns: list[str] | None = None,
) -> DataFrame:
    """One row per indicator: (anno, mes, fecha, other columns, indicador, valor)."""
    renames = renames or {}
    values = columns or indicator_columns(df, pattern)
    df = with_calendar(df)
    ids = ["anno", "mes", "fecha"] + [
        c for c in df.columns if c not in values and c not in ("anno", "mes", "fecha")
    ]
    wide = df.select(*ids, *[F.col(c).cast("double").alias(renames.get(c, c)) for c in values])
    return wide.unpivot(ids, [renames.get(c, c) for c in values], "indicador", "valor")


def with_calendar(df: DataFrame) -> DataFrame:
    """(anno, mes, fecha) from whichever of ``pidx`` and ``fecha`` is present."""
    if "fecha" in df.columns:
        df = df.withColumns({"anno": F.year("fecha"), "mes": F.month("fecha")})
    else:
        df = df.withColumns(
            {"anno": P.anno_of("pidx"), "mes": P.mes_of("pidx"), "fecha": P.month_start("pidx")}
        )
    return df.drop("pidx")


def flows_to_wide(mobile: DataFrame, fill: int | None = None) -> DataFrame:
    """Entries and exits of mobile flows as columns; an absent cell is NULL or ``fill``."""
    keys = [c for c in mobile.columns if c not in ("tipo_flujo", "n")]
    wide = (
        mobile.filter(F.col("tipo_flujo").isin("entrada", "salida"))
        .groupBy(*keys)
        .pivot("tipo_flujo", ["entrada", "salida"])
        .agg(F.first("n"))
        .withColumnsRenamed({"entrada": "pt_ent_12", "salida": "pt_sal_12"})
    )
    return wide if fill is None else wide.na.fill(fill, ["pt_ent_12", "pt_sal_12"])


def to_wide(long: DataFrame, group: str | list[str], indicators: list[str]) -> DataFrame:
    """(fecha, grupo) by indicator; with a list, of several breakdowns at once, its columns in place of grupo."""
    keys = [F.col(group).alias("grupo")] if isinstance(group, str) else [F.col(c) for c in group]
    return (
        long.groupBy("fecha", *keys)
        .pivot("indicador", indicators)
        .agg(F.first("valor"))
    )


def series_long(df: DataFrame, columns: list[str], name: str, value: str = "indice") -> DataFrame:
    cast = df.select("pidx", *[F.col(c).cast("double").alias(c) for c in columns])
    return cast.unpivot(["pidx"], columns, name, value)


def recode_indicators(df: DataFrame) -> DataFrame:
    return df.replace(X.INDICATOR_NAMES, subset=["indicador"])


def columns_like(df: DataFrame, keys: list[str], starts=(), contains=()) -> DataFrame:
    """Keys plus the columns whose name starts with, or contains, a given text."""
    named = [
        c
        for c in df.columns
        if c not in keys and (c.startswith(tuple(starts)) or any(t in c for t in contains))
    ]
    return df.select(*keys, *named)
