from laborlens.sources import bundle, lookups, tables

__all__ = ["bundle", "lookups", "tables"]
