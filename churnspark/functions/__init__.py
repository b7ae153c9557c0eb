"""Column-expression helpers (all built-in Spark functions, codegen friendly)."""

from churnspark.functions.hashing import hash_key, uniform
from churnspark.functions.exprs import safe_div, round6

__all__ = ["hash_key", "uniform", "safe_div", "round6"]
