"""Scoring helpers (J1-J9): default fill, alignment, probability repair, labels, tiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values that must equal the reference's scoring form.
# Defaults for missing request columns: month 6, year 2024, any other numeric 0;
# gender Male, district Hue, data_package BIG70, any other categorical Unknown.
# Label: churn probability > 0.5 -> "Likely to Churn", else "Likely to Stay".
# Risk tier: > 0.7 High, > 0.4 Medium, else Low (all comparisons strict).
NUMERIC_DEFAULTS = {"month": 6, "year": 2024}
CATEGORICAL_DEFAULTS = {"gender": "Male", "district": "Hue", "data_package": "BIG70"}
OTHER_NUMERIC_DEFAULT = 0
OTHER_CATEGORICAL_DEFAULT = "Unknown"
LABEL_EDGE = 0.5
TIER_EDGES = [(0.7, "High"), (0.4, "Medium")]


def fill_defaults(df: DataFrame, numeric: list[str], categorical: list[str],
                  numeric_defaults: dict | None = None, categorical_defaults: dict | None = None) -> DataFrame:
    """Add missing request *columns* as literals (present columns are untouched)."""
    nd = {**NUMERIC_DEFAULTS, **(numeric_defaults or {})}
    cd = {**CATEGORICAL_DEFAULTS, **(categorical_defaults or {})}
    out = df
    for c in numeric:
        if c not in df.columns:
            out = out.withColumn(c, F.lit(nd.get(c, OTHER_NUMERIC_DEFAULT)))
    for c in categorical:
        if c not in df.columns:
            out = out.withColumn(c, F.lit(cd.get(c, OTHER_CATEGORICAL_DEFAULT)))
    return out


def align_by_name(df: DataFrame, expected: list[str], keep: list[str] | None = None) -> DataFrame:
    """Exactly ``expected`` in order; missing -> 0.0, extras dropped."""
    keep = [c for c in (keep or []) if c in df.columns]
    return df.select(*keep, *[(F.col(c).cast("double") if c in df.columns else F.lit(0.0)).alias(c)
                              for c in expected])


def align_by_position(features: Column, n_expected: int) -> Column:
    """An array feature vector padded with zeros or truncated to ``n_expected``."""
    padded = F.concat(features, F.array_repeat(F.lit(0.0), F.lit(n_expected)))
    return F.slice(padded, 1, n_expected)


def repair_probabilities(p0: Column, p1: Column) -> tuple[Column, Column]:
    """Renormalise to sum 1, clip negatives at 0, renormalise again."""
    s = p0 + p1
    q0, q1 = F.when(s != 0, p0 / s).otherwise(p0), F.when(s != 0, p1 / s).otherwise(p1)
    c0, c1 = F.greatest(q0, F.lit(0.0)), F.greatest(q1, F.lit(0.0))
    t = c0 + c1
    return F.when(t != 0, c0 / t).otherwise(c0), F.when(t != 0, c1 / t).otherwise(c1)


def fallback_probability(p1: Column, prediction: Column) -> tuple[Column, Column]:
    """Missing probability -> one-hot of the predicted class, else 0.5; with a flag."""
    fixed = F.coalesce(p1, prediction.cast("double"), F.lit(0.5))
    return fixed, p1.isNull()


def unusable_input(numeric: list[str], categorical: list[str]) -> Column:
    """Whether a request lacks a usable value: NULL, NaN or infinite numbers, NULL categories."""
    out = F.lit(False)
    for c in numeric:
        x = F.col(c).cast("double")
        out = out | x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    for c in categorical:
        out = out | F.col(c).isNull()
    return out


def clamp01(p: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), p))


def decision_label(p: Column) -> Column:
    """J7."""
    return F.when(p > LABEL_EDGE, F.lit("Likely to Churn")).otherwise(F.lit("Likely to Stay"))


def risk_tier(p: Column) -> Column:
    """J8."""
    out = F.lit("Low")
    for edge, name in reversed(TIER_EDGES):
        out = F.when(p > edge, F.lit(name)).otherwise(out)
    return out


def label_and_tier(df: DataFrame, p: str = "p1") -> DataFrame:
    return df.withColumn("decision", decision_label(F.col(p))).withColumn("risk_tier", risk_tier(F.col(p)))


def tier_summary(scored: DataFrame, p: str = "p1") -> DataFrame:
    """Customers per tier with mean / min / max probability."""
    return scored.groupBy("risk_tier").agg(
        F.count(F.lit(1)).alias("customers"), F.round(F.avg(p), 6).alias("mean_p1"),
        F.round(F.min(p), 6).alias("min_p1"), F.round(F.max(p), 6).alias("max_p1"))


def campaign_targets(scored: DataFrame, k: int, key: str = "id", p: str = "p1") -> DataFrame:
    """Top-k customers by churn probability (a top-k report: the limit is the feature)."""
    return scored.orderBy(F.col(p).desc(), F.col(key)).limit(k)
