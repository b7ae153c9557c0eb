"""Small arithmetic helpers shared by metrics, impact and scoring."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_div(num: Column, den: Column, default: float = 0.0) -> Column:
    """``num / den`` with ``default`` when the denominator is 0 or NULL."""
    return F.when((den.isNull()) | (den == 0), F.lit(default)).otherwise(num / den)


def round6(c: Column) -> Column:
    """Reported doubles are rounded to 6 digits so engines compare equal."""
    return F.round(c.cast("double"), 6)
