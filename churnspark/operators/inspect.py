"""Tree analysis on the node table.

A node's ``path`` holds its steps from the root, so ancestors are its prefixes
and pre-order is its sort order -- no recursion, only joins on the node table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


CLASS_NAMES = ("No Churn", "Churn")
# Keywords that mark a rule as business-relevant in the insight rows (fixed values).
INSIGHT_KEYWORDS = ("age", "gender", "package", "spending")
IMPORTANT_SHARE = 0.05
HIGH_RISK_CONFIDENCE = 0.7


def _class_name(c: Column) -> Column:
    return F.when(c == 1, F.lit(CLASS_NAMES[1])).otherwise(F.lit(CLASS_NAMES[0]))


def _one(nodes: DataFrame, model_id: int) -> DataFrame:
    return nodes.filter(F.col("model_id") == model_id)


def tree_stats(nodes: DataFrame, total_features: int, model_id: int = 0) -> DataFrame:
    """H1: depth, nodes, leaves, features used (positive decrease) and total."""
    n = _one(nodes, model_id)
    return n.agg(F.max("depth").alias("max_depth"), F.count(F.lit(1)).alias("n_nodes"),
                 F.count_if("is_leaf").alias("n_leaves"),
                 F.count_distinct(F.when(~F.col("is_leaf") & (F.col("decrease") > 0), F.col("feature_idx"))).alias("n_features_used"),
                 F.lit(total_features).cast("long").alias("total_features"))


def rule_text(feature: Column, threshold: Column, left: Column) -> Column:
    return F.when(left, F.format_string("%s <= %.3f", feature, threshold)).otherwise(
        F.format_string("%s > %.3f", feature, threshold))


def node_table(nodes: DataFrame, model_id: int = 0) -> DataFrame:
    """H2: every node with its parent rule, counts, class shares, class and split rule."""
    n = _one(nodes, model_id)
    parent = n.select(F.col("node_id").alias("pid"), F.col("feature").alias("pf"), F.col("threshold").alias("pt"))
    j = n.join(parent, n.parent_id == parent.pid, "left")
    return j.select(
        "node_id", "depth",
        F.when(F.col("pid").isNull(), F.lit("Root")).otherwise(rule_text(F.col("pf"), F.col("pt"), F.col("side") == "left")).alias("parent_rule"),
        "n", F.col("w0").alias("w0"), F.col("w1").alias("w1"),
        (1 - F.col("p1")).alias("p0"), F.col("p1").alias("p1"),
        _class_name(F.col("prediction")).alias("predicted_class"), "is_leaf", "feature",
        F.col("threshold").alias("threshold"),
        F.when(~F.col("is_leaf"), F.format_string("%s <= %.3f", F.col("feature"), F.col("threshold"))).alias("split_rule"))


def depth_distribution(nodes: DataFrame, model_id: int = 0) -> DataFrame:
    """H3: nodes per depth."""
    return _one(nodes, model_id).groupBy("depth").agg(F.count(F.lit(1)).alias("nodes"))


def paths(nodes: DataFrame, model_id: int = 0) -> DataFrame:
    """H4: one row per leaf: ordered rules root->leaf, counts, share, class, confidence, DFS order."""
    n = _one(nodes, model_id)
    leaves = n.filter("is_leaf")
    steps = leaves.filter("depth > 0").select(
        F.col("node_id").alias("leaf"), F.col("path").alias("way"), F.explode(F.sequence(F.lit(0), F.col("depth") - 1)).alias("d"))
    # ancestor at depth d and the step taken there on the way to the leaf
    steps = steps.select("leaf", "d", F.expr("substring(way, 1, d)").alias("anc"), F.expr("substring(way, d + 1, 1) = 'L'").alias("left"))
    inner = n.filter(~F.col("is_leaf")).select(F.col("path").alias("anc"), "feature", "threshold")
    rules = steps.join(inner, "anc").select(
        "leaf", "d", rule_text(F.col("feature"), F.col("threshold"), F.col("left")).alias("rule"))
    grouped = rules.groupBy("leaf").agg(F.sort_array(F.collect_list(F.struct("d", "rule"))).alias("r"))
    root_n = n.filter(F.col("depth") == 0).select("n").scalar()
    out = leaves.join(grouped, leaves.node_id == grouped.leaf, "left")
    return out.select(
        F.col("node_id").alias("leaf_id"), "depth",
        F.coalesce(F.transform(F.col("r"), lambda s: s["rule"]), F.array().cast("array<string>")).alias("rules"),
        F.col("n").alias("samples"), (F.col("n") / root_n).alias("share"),
        _class_name(F.col("prediction")).alias("prediction"),
        F.greatest(F.col("p1"), 1 - F.col("p1")).alias("confidence"),
        F.col("path").alias("dfs_key"))


def important_paths(nodes: DataFrame, model_id: int = 0, min_share: float = IMPORTANT_SHARE) -> DataFrame:
    """H5 / H6: leaves holding more than ``min_share`` of the training rows, ranked by share."""
    p = paths(nodes, model_id)
    root_n = _one(nodes, model_id).filter(F.col("depth") == 0).select("n").scalar()
    imp = p.filter(F.col("samples") / root_n > min_share)
    return imp.withColumn("rank", F.row_number().over(
        Window.partitionBy().orderBy(F.col("samples").desc(), "dfs_key")))  # <= 1/min_share rows


def path_summary(nodes: DataFrame, total_features: int, model_id: int = 0) -> DataFrame:
    """H7: important paths by prediction, leaf ratio and feature usage share."""
    ip = important_paths(nodes, model_id)
    st = tree_stats(nodes, total_features, model_id)
    return st.select(
        ip.agg(F.count(F.lit(1))).scalar().alias("important_paths"),
        ip.agg(F.count_if(F.col("prediction") == CLASS_NAMES[1])).scalar().alias("churn_paths"),
        ip.agg(F.count_if(F.col("prediction") == CLASS_NAMES[0])).scalar().alias("retention_paths"),
        (F.col("n_leaves") / F.col("n_nodes")).alias("leaf_ratio"),
        (F.col("n_features_used") / F.greatest(F.col("total_features"), F.lit(1))).alias("feature_usage"))


def rule_listing(nodes: DataFrame, model_id: int = 0) -> DataFrame:
    """H8: indented rule lines in pre-order, ``(line_no, text)``, like a text tree export."""
    n = _one(nodes, model_id)
    parent = n.select(F.col("node_id").alias("pid"), F.col("feature").alias("pf"), F.col("threshold").alias("pt"))
    j = n.join(parent, n.parent_id == parent.pid, "left")
    split_line = j.filter(F.col("pid").isNotNull()).select(
        "path", F.lit(0).alias("kind"),
        F.concat(F.expr("repeat('|   ', depth - 1)"), F.lit("|--- "),
                 F.when(F.col("side") == "left", F.format_string("%s <= %.2f", F.col("pf"), F.col("pt")))
                 .otherwise(F.format_string("%s >  %.2f", F.col("pf"), F.col("pt")))).alias("text"))
    leaf_line = j.filter("is_leaf").select(
        "path", F.lit(1).alias("kind"),
        F.concat(F.expr("repeat('|   ', depth)"), F.lit("|--- "),
                 F.format_string("weights: [%.2f, %.2f] class: %s", F.col("w0"), F.col("w1"),
                                 _class_name(F.col("prediction")))).alias("text"))
    lines = split_line.unionByName(leaf_line)
    w = Window.partitionBy().orderBy("path", "kind")  # one row per node: bounded by tree size
    return lines.select(F.row_number().over(w).alias("line_no"), "text")


def insights(nodes: DataFrame, model_id: int = 0, per_class: int = 3, rules_per_path: int = 2,
             keywords: tuple[str, ...] | None = None) -> DataFrame:
    """For the first ``per_class`` important churn and stay paths (tree
    order), up to ``rules_per_path`` rules naming one of ``keywords`` (default: age, gender,
    package, spending); plus high-risk churn segments (confidence > 0.7)."""
    ip = important_paths(nodes, model_id)
    def has_kw(r):
        cond = F.lit(False)
        for k in keywords or INSIGHT_KEYWORDS:
            cond = cond | F.lower(r).contains(k)
        return cond
    ordered = ip.withColumn("pos", F.row_number().over(Window.partitionBy("prediction").orderBy("dfs_key")))
    keyed = ordered.withColumn("key_rules", F.slice(F.filter(F.col("rules"), has_kw), 1, rules_per_path))
    factors = keyed.filter((F.col("pos") <= per_class) & (F.size("key_rules") > 0)).select(
        F.when(F.col("prediction") == CLASS_NAMES[1], F.lit("churn_factor")).otherwise(F.lit("retention_factor")).alias("kind"),
        "leaf_id", "share", "confidence", "key_rules")
    risk = ip.filter((F.col("prediction") == CLASS_NAMES[1]) & (F.col("confidence") > HIGH_RISK_CONFIDENCE)).select(
        F.lit("high_risk_segment").alias("kind"), "leaf_id", "share", "confidence",
        F.array().cast("array<string>").alias("key_rules"))
    return factors.unionByName(risk)


def depth_limited(nodes: DataFrame, max_depth: int, model_id: int = 0) -> DataFrame:
    """Nodes down to ``max_depth``; internal nodes at the cut are marked truncated."""
    n = _one(nodes, model_id).filter(F.col("depth") <= max_depth)
    return n.select("node_id", "depth", "feature", "threshold", "n", "p1", "is_leaf",
                    ((F.col("depth") == max_depth) & ~F.col("is_leaf")).alias("truncated"))


def edges(nodes: DataFrame, model_id: int = 0) -> DataFrame:
    """``(parent_id, child_id, branch)``; the left branch is the True (<=) one."""
    n = _one(nodes, model_id).filter(F.col("parent_id").isNotNull())
    return n.select("parent_id", F.col("node_id").alias("child_id"), (F.col("side") == "left").alias("branch"))
