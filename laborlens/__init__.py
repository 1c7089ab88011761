"""Labour panel analytics on Spark: DataFrame -> DataFrame operators."""

from laborlens import functions, operators, plans, sources

__all__ = ["functions", "operators", "plans", "sources"]
