"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

They run the operators over the whole churn frame derived from the driver's
order tables. Stages shared by several queries (frame, outlier filter, split,
fitted encoder, trees) are memoised per session and folder, so a run of all
queries computes each stage once.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnspark.functions.exprs import round6
from churnspark.operators import impact as I
from churnspark.operators import importance as G
from churnspark.operators import inspect as H
from churnspark.operators import metrics as M
from churnspark.operators import profile as B
from churnspark.operators import score as J
from churnspark.operators import search as S
from churnspark.operators.balance import imbalance_table, knn, smote
from churnspark.operators.encode import Preprocessor
from churnspark.operators.outliers import bounds_table, iqr_bounds, remove_outliers
from churnspark.operators.split import stratified_folds, stratified_split
from churnspark.operators.tree import TreeParams, class_weight_table, class_weights, fit_tree
from churnspark.plans.oracle_search import GRID
from churnspark.plans.prepare import prepare
from churnspark.sources.tables import churn_frame
from churnspark.spec import FrameSpec
from churnspark.streaming.scoring import scoring_plan

_MEMO: dict = {}


def _memo(spark: SparkSession, sf_dir: str, name: str, build):
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _MEMO:
        _MEMO[key] = build()
    return _MEMO[key]


def frame(spark, d):
    return _memo(spark, d, "frame", lambda: churn_frame(spark, d).persist(StorageLevel.MEMORY_AND_DISK))


def spec(spark, d) -> FrameSpec:
    return FrameSpec.infer(frame(spark, d))


def cleaned(spark, d):
    return _memo(spark, d, "clean", lambda: remove_outliers(frame(spark, d), list(spec(spark, d).numeric)))


def split(spark, d):
    return _memo(spark, d, "split", lambda: stratified_split(cleaned(spark, d).frame, "churn").persist(
        StorageLevel.MEMORY_AND_DISK))


def prep(spark, d):
    return _memo(spark, d, "prep", lambda: Preprocessor(spec(spark, d)).fit(split(spark, d).filter(~F.col("is_test"))))


def encoded(spark, d) -> DataFrame:
    """id, label, is_test, encoded features (train-fitted)."""
    def build():
        pm = prep(spark, d)
        s = split(spark, d)
        return s.select(F.col("id"), F.col("churn").alias("label"), "is_test", *pm.feature_exprs()).persist(
            StorageLevel.MEMORY_AND_DISK)
    return _memo(spark, d, "encoded", build)


def train_enc(spark, d):
    return encoded(spark, d).filter(~F.col("is_test")).drop("is_test")


def test_enc(spark, d):
    return encoded(spark, d).filter(F.col("is_test")).drop("is_test")


def rule_predictions(spark, d) -> DataFrame:
    """A fixed scoring rule on the test split (no model): ``p1 = min(1, 2 / (1 + order_count))``."""
    s = split(spark, d).filter(F.col("is_test"))
    p1 = F.least(F.lit(1.0), F.lit(2.0) / (F.lit(1) + F.col("order_count")))
    return s.select("id", F.col("churn").alias("label"), p1.alias("p1"),
                    (p1 > 0.5).cast("int").alias("prediction"))


def rule_scores(spark, d) -> DataFrame:
    """The fixed scoring rule on every customer of the frame."""
    p1 = F.least(F.lit(1.0), F.lit(2.0) / (F.lit(1) + F.col("order_count")))
    return frame(spark, d).select("id", p1.alias("p1"))


def tree2(spark, d):
    return _memo(spark, d, "tree2", lambda: fit_tree(train_enc(spark, d), prep(spark, d).feature_names, "label",
                                                     TreeParams(max_depth=2)))


def tree2_nodes(spark, d):
    return _memo(spark, d, "tree2_nodes", lambda: tree2(spark, d).nodes_df(spark).persist())


def dictionary(spark, d):
    return prep(spark, d).dictionary(spark)


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(*[round6(F.col(f.name)).alias(f.name) if f.dataType.typeName() == "double" else F.col(f.name)
                       for f in df.schema.fields])


def _metrics_row(spark, d) -> DataFrame:
    return M.summary_row(rule_predictions(spark, d))


# ---------------------------------------------------------------- registry --
def q_frame(spark, d):
    return frame(spark, d)


def q_shape(spark, d):
    return B.shape(frame(spark, d))


def q_missing(spark, d):
    return B.missing_counts(frame(spark, d))


def q_numeric_summary(spark, d):
    return _rounded(B.numeric_summary(frame(spark, d), spec(spark, d)))


def q_class_distribution(spark, d):
    return _rounded(B.class_distribution(frame(spark, d), "churn"))


def q_cardinality(spark, d):
    return B.category_cardinality(frame(spark, d), spec(spark, d))


def q_iqr_bounds(spark, d):
    fr = frame(spark, d)
    return _rounded(bounds_table(spark, iqr_bounds(fr, list(spec(spark, d).numeric))))


def q_outlier_steps(spark, d):
    return _rounded(cleaned(spark, d).steps_table(spark))


def q_outlier_filter(spark, d):
    return cleaned(spark, d).frame


def q_outlier_summary(spark, d):
    return cleaned(spark, d).summary(spark)


def q_split(spark, d):
    return split(spark, d).select("id", "churn", "is_test")


def q_scaler(spark, d):
    return _rounded(prep(spark, d).scaler_table(spark))


def q_categories(spark, d):
    return prep(spark, d).categories_table(spark)


def q_encoded(spark, d):
    pm = prep(spark, d)
    e = encoded(spark, d)
    pairs = F.array(*[F.struct(F.lit(i).alias("feature_idx"), F.lit(f).alias("feature"), F.col(f).alias("value"))
                      for i, f in enumerate(pm.feature_names)])
    return e.select("id", "label", "is_test", F.inline(pairs)).select(
        "id", "label", "is_test", "feature_idx", "feature", round6(F.col("value")).alias("value"))


def q_dictionary(spark, d):
    return dictionary(spark, d)


def q_imbalance(spark, d):
    return imbalance_table(train_enc(spark, d), "label")


def q_class_weights(spark, d):
    cw = class_weights(train_enc(spark, d), "label")
    return _rounded(class_weight_table(spark, cw).select("class", "weight"))


def q_knn(spark, d):
    tr = train_enc(spark, d).filter(F.col("label") == 1)
    return _rounded(knn(tr, prep(spark, d).feature_names, 5, "id"))


def q_smote(spark, d):
    pm = prep(spark, d)
    res = smote(train_enc(spark, d), pm.feature_names, "label", "id")
    pairs = F.array(*[F.struct(F.lit(i).alias("feature_idx"), F.col(f).alias("value"))
                      for i, f in enumerate(pm.feature_names)])
    return res.select("id", "syn", "label", "is_synthetic", F.inline(pairs)).select(
        "id", "syn", "label", "is_synthetic", "feature_idx", round6(F.col("value")).alias("value"))


def q_tree_nodes(spark, d):
    n = tree2_nodes(spark, d)
    return _rounded(n.select("node_id", "parent_id", "depth", "feature", "threshold", "n", "w0", "w1",
                             "p1", "prediction", "is_leaf"))


def q_tree_predict(spark, d):
    pred = tree2(spark, d).predict(test_enc(spark, d))
    return _rounded(pred.select("id", "label", "node_id", "p1", "prediction"))


def q_confusion(spark, d):
    return M.confusion(rule_predictions(spark, d))


def q_rates(spark, d):
    return M.rates(M.confusion(rule_predictions(spark, d)))


def q_roc(spark, d):
    return _rounded(M.roc_curve(rule_predictions(spark, d)))


def q_auc_ap(spark, d):
    return M.auc_ap(rule_predictions(spark, d))


def q_pr(spark, d):
    return _rounded(M.pr_curve(rule_predictions(spark, d)))


def q_report(spark, d):
    return M.classification_report(M.confusion(rule_predictions(spark, d)))


def q_importance(spark, d):
    return G.feature_importance(tree2_nodes(spark, d), dictionary(spark, d))


def q_utilisation(spark, d):
    return G.utilisation(G.feature_importance(tree2_nodes(spark, d), dictionary(spark, d)))


def q_tree_stats(spark, d):
    return H.tree_stats(tree2_nodes(spark, d), len(prep(spark, d).feature_names))


def q_depth_distribution(spark, d):
    return H.depth_distribution(tree2_nodes(spark, d))


def q_paths(spark, d):
    p = H.paths(tree2_nodes(spark, d))
    return p.select("leaf_id", F.array_join("rules", " -> ").alias("path"), "samples", "share", "prediction",
                    "confidence")


def q_rules(spark, d):
    return H.rule_listing(tree2_nodes(spark, d))


def q_edges(spark, d):
    return H.edges(tree2_nodes(spark, d))


def q_campaign(spark, d):
    return I.campaign_counts(M.confusion(rule_predictions(spark, d)))


def q_financial(spark, d):
    return I.financial_impact(M.confusion(rule_predictions(spark, d)))


def q_rating(spark, d):
    return I.performance_rating(_metrics_row(spark, d))


def q_readiness(spark, d):
    return I.deployment_readiness(_metrics_row(spark, d))


def q_strengths(spark, d):
    return I.strengths_weaknesses(_metrics_row(spark, d))


def q_tiers(spark, d):
    p = rule_scores(spark, d)
    return _rounded(J.label_and_tier(p.select("id", J.clamp01(F.col("p1")).alias("p1"))))


def q_tier_summary(spark, d):
    p = rule_scores(spark, d)
    return J.tier_summary(J.label_and_tier(p.select("id", "p1")))


QUERIES = {
    "a1_frame": q_frame,
    "b1_shape": q_shape,
    "b3_missing": q_missing,
    "b4_numeric_summary": q_numeric_summary,
    "b5_class_distribution": q_class_distribution,
    "b7_cardinality": q_cardinality,
    "c1_iqr_bounds": q_iqr_bounds,
    "c2_outlier_steps": q_outlier_steps,
    "c3_outlier_filter": q_outlier_filter,
    "c4_outlier_summary": q_outlier_summary,
    "d3_split": q_split,
    "d4_scaler": q_scaler,
    "d5_categories": q_categories,
    "d6_encoded": q_encoded,
    "d7_dictionary": q_dictionary,
    "e1_imbalance": q_imbalance,
    "e3_knn": q_knn,
    "e4_smote": q_smote,
    "e5_class_weights": q_class_weights,
    "f1_tree_nodes": q_tree_nodes,
    "f3_tree_predict": q_tree_predict,
    "g1_confusion": q_confusion,
    "g2_rates": q_rates,
    "g4_roc": q_roc,
    "g5_auc_ap": q_auc_ap,
    "g6_pr": q_pr,
    "g8_report": q_report,
    "g10_importance": q_importance,
    "g12_utilisation": q_utilisation,
    "h1_tree_stats": q_tree_stats,
    "h3_depth_distribution": q_depth_distribution,
    "h4_paths": q_paths,
    "h8_rules": q_rules,
    "h13_edges": q_edges,
    "i1_campaign": q_campaign,
    "i2_financial": q_financial,
    "i4_rating": q_rating,
    "i6_readiness": q_readiness,
    "i8_strengths": q_strengths,
    "j8_tiers": q_tiers,
    "j9_tier_summary": q_tier_summary,
}


# ------------------------------------------------ rows-only registered queries --
def tree5(spark, d):
    """Depth-5 tree on the SMOTE-resampled train split (the reference's defaults)."""
    def build():
        from churnspark.operators.balance import smote as _smote
        pm = prep(spark, d)
        res = _smote(train_enc(spark, d), pm.feature_names, "label", "id").persist(StorageLevel.MEMORY_AND_DISK)
        return fit_tree(res, pm.feature_names, "label", TreeParams())
    return _memo(spark, d, "tree5", build)


def q_cross_validate(spark, d):
    return _rounded(S.cross_validate(train_enc(spark, d), prep(spark, d).feature_names, "label", TreeParams())["summary"])


def q_cross_validate_refit(spark, d):
    """F6 with preparation refitted in every fold, on raw train rows."""
    train = split(spark, d).filter(~F.col("is_test")).drop("is_test")
    return _rounded(S.cross_validate(train, label="churn", params=TreeParams(), refit_prep=spec(spark, d))["summary"])


def q_cv_score(spark, d):
    return _rounded(S.cv_score(train_enc(spark, d), prep(spark, d).feature_names, "label", TreeParams(), scoring="f1"))


def grid(spark, d):
    return _memo(spark, d, "grid", lambda: S.grid_search(train_enc(spark, d), prep(spark, d).feature_names, "label", GRID,
                                                         test=test_enc(spark, d)))


def q_grid_search(spark, d):
    """F9 over a grid of 24 points: every point's mean and std, the best marked."""
    found = grid(spark, d)
    p = found["best_params"]
    best = ((F.col("criterion") == p.criterion) & (F.col("max_depth") == p.max_depth) & (F.col("min_samples_leaf") == p.min_samples_leaf)
            & (F.col("min_samples_split") == p.min_samples_split))
    return _rounded(found["results"].drop("max_features").withColumn("best", best))


def q_grid_best_test(spark, d):
    """F9's refitted best tree on the test split."""
    return _rounded(grid(spark, d)["test_evaluation"])


def _fold_tree(spark, d):
    """Depth-2 tree on four folds of the train split, and the fifth fold."""
    def build():
        folded = stratified_folds(train_enc(spark, d), "label").persist(StorageLevel.MEMORY_AND_DISK)
        return fit_tree(folded.filter("fold > 0"), prep(spark, d).feature_names, "label", TreeParams(max_depth=2)), folded.filter("fold = 0")
    return _memo(spark, d, "fold_tree", build)


def q_pruning_path(spark, d):
    return _rounded(S.pruning_table(spark, _fold_tree(spark, d)[0]))


def q_pruning_choice(spark, d):
    """sampled alphas with their accuracy on the held-out fold, the chosen one marked."""
    model, held_out = _fold_tree(spark, d)
    res = S.optimise_pruning(model, held_out)
    rows = [(i, float(a), float(s), a == res["best_alpha"]) for i, (a, s) in enumerate(zip(res["alphas"], res["scores"]))]
    return _rounded(spark.createDataFrame(rows, "step int, alpha double, score double, best boolean"))


def q_pruning(spark, d):
    """grown on four folds of the train split, pruned by accuracy on the fifth; the test split is not looked at."""
    folded = stratified_folds(train_enc(spark, d), "label")
    features = prep(spark, d).feature_names
    m = fit_tree(smote(folded.filter("fold > 0").drop("fold"), features, "label", "id"), features, "label", TreeParams())
    res = S.optimise_pruning(m, folded.filter("fold = 0"))
    rows = [(i, float(a), float(imp), a in res["alphas"], a == res["best_alpha"])
            for i, (a, imp) in enumerate(S.pruning_path(m))]
    return spark.createDataFrame(rows, "step int, alpha double, impurity double, sampled boolean, best boolean")


def q_model_card(spark, d):
    return S.model_card(spark, tree5(spark, d), len(prep(spark, d).feature_names))


def q_top_features(spark, d):
    return G.top_features(G.feature_importance(tree5(spark, d).nodes_df(spark), dictionary(spark, d)), 10)


def q_importance_stats(spark, d):
    return G.importance_stats(G.feature_importance(tree5(spark, d).nodes_df(spark), dictionary(spark, d)))


def q_cumulative_selection(spark, d):
    return G.cumulative_selection(G.feature_importance(tree5(spark, d).nodes_df(spark), dictionary(spark, d)))


def q_important_paths(spark, d):
    p = H.important_paths(tree5(spark, d).nodes_df(spark))
    return p.select("rank", "leaf_id", F.array_join("rules", " -> ").alias("path"), "samples", "share",
                    "prediction", "confidence")


def q_path_summary(spark, d):
    return H.path_summary(tree5(spark, d).nodes_df(spark), len(prep(spark, d).feature_names))


def q_insights(spark, d):
    keywords = ("spend", "quantity", "order", "nation", "segment")  # what the frame's columns are called
    return H.insights(tree5(spark, d).nodes_df(spark), keywords=keywords).select(
        "kind", "leaf_id", "share", "confidence", F.array_join("key_rules", ", ").alias("key_rules"))


def q_depth_limited(spark, d):
    return H.depth_limited(tree5(spark, d).nodes_df(spark), 2)


def q_batch_scoring(spark, d):
    """Every customer of the frame, outliers included, scored by the depth-5 tree into tiers."""
    return scoring_plan(frame(spark, d), prep(spark, d), tree5(spark, d))


def q_key_metrics(spark, d):
    pred = tree5(spark, d).predict(test_enc(spark, d))
    return I.key_metrics(M.summary_row(pred), _tree5_stats(spark, d))


def _tree5_stats(spark, d) -> DataFrame:
    return H.tree_stats(tree5(spark, d).nodes_df(spark), len(pm_names(spark, d)))


def pm_names(spark, d):
    return prep(spark, d).feature_names


def q_deployment_report(spark, d):
    pred = tree5(spark, d).predict(test_enc(spark, d))
    return I.deployment_report(M.summary_row(pred), _tree5_stats(spark, d))


def q_campaign_targets(spark, d):
    """The 100 highest-risk customers (a top-k report)."""
    return J.campaign_targets(q_batch_scoring(spark, d), 100)


# ------------------------------------------------------- further operators --
def q_columns(spark, d):
    return B.column_types(frame(spark, d))


def q_feature_types(spark, d):
    return B.feature_type_counts(frame(spark, d))


def q_joint_filter(spark, d):
    """Bounds of all columns from the unfiltered rows."""
    return remove_outliers(frame(spark, d), list(spec(spark, d).numeric), mode="joint").frame


def q_prepared(spark, d):
    """The preparation pipeline in one call: resampled train rows and test rows, encoded."""
    p = _memo(spark, d, "prepared", lambda: prepare(frame(spark, d)))
    test = p.test.select("id", F.lit(-1).alias("syn"), "label", *p.features, F.lit(False).alias("is_synthetic"), F.lit(True).alias("is_test"))
    rows = p.resampled.withColumn("is_test", F.lit(False)).unionByName(test)
    pairs = F.array(*[F.struct(F.lit(i).alias("feature_idx"), F.col(f).alias("value")) for i, f in enumerate(p.features)])
    return rows.select("id", "syn", "label", "is_synthetic", "is_test", F.inline(pairs))


def q_folds(spark, d):
    return stratified_folds(train_enc(spark, d), "label").select("id", "label", "fold")


def q_compare(spark, d):
    """The depth-5 tree against the fixed rule (one input column) on the test split."""
    stats = _tree5_stats(spark, d).select("n_features_used").scalar()
    rows = [M.summary_row(p).select(F.lit(name).alias("model_id"), "accuracy", "roc_auc", n.cast("double").alias("n_features"))
            for name, p, n in (("tree", tree5(spark, d).predict(test_enc(spark, d)), stats), ("rule", rule_predictions(spark, d), F.lit(1)))]
    return M.compare_models(rows[0].unionByName(rows[1]), "tree", "rule")


def q_node_table(spark, d):
    return H.node_table(tree2_nodes(spark, d))


def q_used_features(spark, d):
    imp = G.feature_importance(tree5(spark, d).nodes_df(spark), dictionary(spark, d))
    return G.top_features(imp, len(pm_names(spark, d)), used_only=True)


def q_default_fill(spark, d):
    """Requests with some of the columns; the rest get their defaults."""
    requests = frame(spark, d).select("id", "acctbal", "segment")
    return J.fill_defaults(requests, ["acctbal", "month", "year", "spend"], ["segment", "gender", "district", "nation"])


def q_align_by_name(spark, d):
    return J.align_by_name(frame(spark, d), ["spend", "complaints", "order_count"], keep=["id"])


def q_align_by_position(spark, d):
    """A vector of three values brought to a length of five and of two."""
    v = F.array(*[F.col(c).cast("double") for c in ("acctbal", "spend", "tenure_days")])
    vectors = F.array(*[F.struct(F.lit(n).alias("n_expected"), J.align_by_position(v, n).alias("v")) for n in (5, 2)])
    return frame(spark, d).select("id", F.inline(vectors)).select("id", "n_expected", F.posexplode("v").alias("pos", "value"))


def q_repair(spark, d):
    """The rule's scores moved out of [0, 1] and off a sum of 1."""
    p1 = F.col("p1") * 1.5 - 0.25
    q0, q1 = J.repair_probabilities(F.lit(1.1) - p1, p1)
    return rule_scores(spark, d).select("id", q0.alias("p0"), q1.alias("p1"))


def q_fallback(spark, d):
    """Every customer scored, a part of them with values made unusable by the last digit of the id."""
    digit = F.col("id") % 10
    bad = (frame(spark, d).withColumn("acctbal", F.when(digit != 0, F.col("acctbal")))
           .withColumn("spend", F.when(digit == 1, F.lit(float("nan"))).otherwise(F.col("spend")))
           .withColumn("quantity", F.when(digit == 2, F.lit(float("inf"))).otherwise(F.col("quantity")))
           .withColumn("segment", F.when(digit != 3, F.col("segment"))))
    return scoring_plan(bad, prep(spark, d), tree5(spark, d))


QUERIES.update({
    "b2_columns": q_columns,
    "b8_feature_types": q_feature_types,
    "c5_joint_filter": q_joint_filter,
    "d8_prepared": q_prepared,
    "f5_folds": q_folds,
    "g16_compare": q_compare,
    "h2_node_table": q_node_table,
    "h9_used_features": q_used_features,
    "j1_default_fill": q_default_fill,
    "j2_align_by_name": q_align_by_name,
    "j3_align_by_position": q_align_by_position,
    "j4_repair": q_repair,
    "j5_fallback": q_fallback,
    "f6_cross_validate": q_cross_validate,
    "f6_cross_validate_refit": q_cross_validate_refit,
    "f7_cv_score": q_cv_score,
    "f9_grid_search": q_grid_search,
    "f9_best_test": q_grid_best_test,
    "f10_pruning_path": q_pruning_path,
    "f12_pruning_choice": q_pruning_choice,
    "f12_pruning": q_pruning,
    "f13_model_card": q_model_card,
    "g13_top_features": q_top_features,
    "g14_importance_stats": q_importance_stats,
    "g15_cumulative_selection": q_cumulative_selection,
    "h5_important_paths": q_important_paths,
    "h7_path_summary": q_path_summary,
    "h10_insights": q_insights,
    "h12_depth_limited": q_depth_limited,
    "i7_key_metrics": q_key_metrics,
    "i9_deployment_report": q_deployment_report,
    "j6_batch_scoring": q_batch_scoring,
    "j9_campaign_targets": q_campaign_targets,
})


def _reported(query):
    """Operators work on raw values; only what a query reports is rounded."""
    return lambda spark, d: _rounded(query(spark, d))


QUERIES = {name: _reported(query) for name, query in QUERIES.items()}
