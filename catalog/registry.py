"""Name -> query and name -> check SQL; shared pieces of the SQL side."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    def add(fn):
        assert key not in QUERIES, key
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return add


def rounded(df: DataFrame, decimals: int = 6, skip: tuple[str, ...] = ()) -> DataFrame:
    """Doubles to a fixed number of decimals (sums depend on order); -0.0 becomes 0.0."""
    return df.select(
        [
            (F.round(c, decimals) + F.lit(0.0)).alias(c) if t == "double" and c not in skip else F.col(c)
            for c, t in df.dtypes
        ]
    )


def R(expr: str, alias: str | None = None, decimals: int = 6) -> str:
    """The same rounding in SQL."""
    return f"round(CAST({expr} AS DOUBLE), {decimals}) + 0.0 AS {alias or expr}"


# --- named CTEs, in the form of the original computation -------------------------

CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, body: str, *needs: str) -> None:
    CTES[name] = (needs, body)


def sql(body: str, *names: str) -> str:
    """``body`` preceded by the CTEs it names and those they need, in order."""
    ordered: list[str] = []

    def visit(n: str) -> None:
        for m in CTES[n][0]:
            visit(m)
        if n not in ordered:
            ordered.append(n)

    for n in names:
        visit(n)
    if not ordered:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n][1]})" for n in ordered) + "\n" + body
