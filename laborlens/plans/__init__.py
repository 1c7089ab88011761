from laborlens.plans import monthly, session

__all__ = ["monthly", "session"]
