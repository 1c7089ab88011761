from laborlens.operators import (
    audit,
    clean,
    enrich,
    firm_size,
    flows,
    grouped_stats,
    impute,
    indicators,
    migration,
    persons,
    public_jobs,
    reconcile,
    reports,
    reshape,
    stocks,
    tax_credit,
    wage_index,
)

__all__ = [
    "audit",
    "clean",
    "enrich",
    "firm_size",
    "flows",
    "grouped_stats",
    "impute",
    "indicators",
    "migration",
    "persons",
    "public_jobs",
    "reconcile",
    "reports",
    "reshape",
    "stocks",
    "tax_credit",
    "wage_index",
]
