from laborlens.functions import periods, scalars

__all__ = ["periods", "scalars"]
