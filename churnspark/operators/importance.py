"""Feature importance from a node table.

Importance = total weighted impurity decrease of the splits on a feature,
normalised to sum 1. Inputs are the ``nodes`` table and the ``(feature_idx,
feature)`` dictionary; both have at most one row per node / feature, so the
global windows below run over bounded, tiny inputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _all():
    """Global window over <= n_features rows (the dictionary), never over data rows."""
    return Window.partitionBy()


def feature_importance(nodes: DataFrame, dictionary: DataFrame, model_id: int = 0) -> DataFrame:
    """``(feature_idx, feature, importance, importance_pct)``, zeros included."""
    dec = (nodes.filter((F.col("model_id") == model_id) & ~F.col("is_leaf"))
           .groupBy("feature_idx").agg(F.sum("decrease").alias("d")))
    joined = dictionary.join(dec, "feature_idx", "left").fillna(0.0, ["d"])
    total = F.sum("d").over(_all())
    imp = F.when(total > 0, F.col("d") / total).otherwise(F.lit(0.0))
    out = joined.select("feature_idx", "feature", imp.alias("importance"))
    tot_imp = F.sum("importance").over(_all())
    return out.select("feature_idx", "feature", F.col("importance").alias("importance"),
                      (F.when(tot_imp > 0, F.col("importance") / tot_imp * 100).otherwise(0.0)).alias("importance_pct"))


def _ranked(imp: DataFrame) -> DataFrame:
    return imp.withColumn("rank", F.row_number().over(_all().orderBy(F.col("importance").desc(), "feature_idx")))


def utilisation(imp: DataFrame) -> DataFrame:
    """Total / used / unused features and the share of the top 5."""
    r = _ranked(imp)
    return r.agg(F.count(F.lit(1)).alias("total_features"),
                 F.count_if(F.col("importance") > 0).alias("used_features"),
                 F.count_if(F.col("importance") == 0).alias("unused_features"),
                 F.sum(F.when(F.col("rank") <= 5, F.col("importance_pct")).otherwise(0.0)).alias("top5_cumulative_pct"))


def top_features(imp: DataFrame, n: int = 10, used_only: bool = False) -> DataFrame:
    """The ``n`` most important features (``used_only``: importance > 0)."""
    r = _ranked(imp.filter(F.col("importance") > 0) if used_only else imp)
    return r.filter(F.col("rank") <= n)


def importance_stats(imp: DataFrame) -> DataFrame:
    """Zero-importance features and min / max / mean of the importances."""
    return imp.agg(F.sort_array(F.collect_list(F.when(F.col("importance") == 0, F.col("feature")))).alias("zero_features"),
                   F.min("importance").alias("min_importance"),
                   F.max("importance").alias("max_importance"),
                   F.avg("importance").alias("mean_importance"))


def cumulative_selection(imp: DataFrame, threshold: float = 0.95) -> DataFrame:
    """The smallest prefix (by importance) whose cumulative importance reaches ``threshold``."""
    w = _all().orderBy(F.col("importance").desc(), "feature_idx").rowsBetween(Window.unboundedPreceding, 0)
    c = imp.withColumn("cumulative", F.sum("importance").over(w))
    prev = F.col("cumulative") - F.col("importance")
    return c.filter(prev < threshold - 1e-12).select("feature_idx", "feature", "importance",
                                                      F.col("cumulative").alias("cumulative"))
