import numpy as np
import pytest
from pyspark.sql import functions as F

from churnspark.operators import inspect as H
from churnspark.operators import search as S
from churnspark.operators.tree import TreeParams, fit_tree
from churnspark.streaming import score_stream, scoring_plan


def _signal(spark, n=600, seed=7):
    rng = np.random.default_rng(seed)
    a = np.round(rng.normal(size=n), 3)
    b = np.round(rng.normal(size=n), 3)
    y = ((a > 0.3) & (b < 0.5)).astype(int)
    flip = rng.random(n) < 0.05
    y = np.where(flip, 1 - y, y)
    return spark.createDataFrame([(i, float(a[i]), float(b[i]), int(y[i])) for i in range(n)],
                                 "id long, a double, b double, label int")


def test_tree_finds_planted_split(spark):
    df = _signal(spark)
    m = fit_tree(df, ["a", "b"], "label", TreeParams(max_depth=2, class_weight=None))
    root = [r for r in m.nodes if r["node_id"] == 1][0]
    assert root["feature"] in ("a", "b")
    assert abs(root["threshold"] - (0.3 if root["feature"] == "a" else 0.5)) < 0.05
    # child counts sum to the parent
    assert sorted(r["node_id"] for r in m.nodes) == list(range(1, len(m.nodes) + 1))
    for r in m.nodes:
        if not r["is_leaf"]:
            children = [c for c in m.nodes if c["parent_id"] == r["node_id"]]
            assert [c["side"] for c in children] == ["left", "right"]
            assert sum(c["n"] for c in children) == r["n"]
    pred = m.predict(df)
    acc = pred.select(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]
    assert acc > 0.9


def test_same_class_siblings_are_kept(spark):
    # 10 pure-0 rows and 10 rows at 30 % positives: a leaf-merging learner would join them
    rows = [(i, 0.0, 0) for i in range(10)] + [(10 + i, 1.0, int(i < 3)) for i in range(10)]
    df = spark.createDataFrame(rows, "id long, x double, label int")
    m = fit_tree(df, ["x"], "label", TreeParams(max_depth=1, min_samples_split=2, min_samples_leaf=1,
                                                 class_weight=None))
    leaves = sorted((r["n"], round(r["p1"], 2)) for r in m.nodes if r["is_leaf"])
    assert leaves == [(10, 0.0), (10, 0.3)]


def test_depth_has_no_cap(spark):
    # alternating labels: the best split takes one row off an end
    df = spark.createDataFrame([(i, float(i), i % 2) for i in range(40)], "id long, x double, label int").coalesce(1)
    m = fit_tree(df, ["x"], "label", TreeParams(max_depth=None, min_samples_split=2, min_samples_leaf=1, class_weight=None))
    assert m.depth > 30
    assert m.predict(df).filter("prediction <> label").count() == 0
    assert all(r["impurity"] == 0 for r in m.nodes if r["is_leaf"])
    paths = H.paths(m.nodes_df(spark))
    assert paths.filter("size(rules) <> depth").count() == 0 and paths.agg(F.sum("samples")).first()[0] == 40
    assert len(S.prune(m, 2.0).nodes) == 1


def test_binned_mode_routes_consistently(spark):
    df = _signal(spark)
    m = fit_tree(df, ["a", "b"], "label", TreeParams(max_depth=3, max_bins=16))
    pred = m.predict(df)
    # every leaf's training count equals the rows the scorer routes to it
    routed = {r["node_id"]: r["count"] for r in pred.groupBy("node_id").count().collect()}
    leaves = {r["node_id"]: r["n"] for r in m.nodes if r["is_leaf"]}
    assert routed == leaves


def test_grid_truncation_equals_direct_fit(spark):
    df = _signal(spark, n=300)
    grid = {"max_depth": [2], "min_samples_split": [40], "min_samples_leaf": [3], "criterion": ["gini"],
            "max_features": [None]}
    gs = S.grid_search(df, ["a", "b"], "label", grid, k=3)
    cv = S.cross_validate(df, ["a", "b"], "label", TreeParams(max_depth=2, min_samples_split=40, min_samples_leaf=3,
                                                              criterion="gini", class_weight=None), k=3)
    direct = cv["summary"].filter("split = 'test' AND metric = 'accuracy'").first()["mean"]
    assert gs["best_score"] == pytest.approx(direct, abs=1e-6)
    assert S.param_grid(spark).count() == 480


def test_pruning(spark):
    df = _signal(spark)
    m = fit_tree(df, ["a", "b"], "label", TreeParams(max_depth=6, min_samples_leaf=2, class_weight=None))
    path = S.pruning_path(m)
    alphas = [a for a, _ in path]
    assert alphas == sorted(alphas) and alphas[0] == 0.0
    assert path[-1][1] >= path[0][1]
    res = S.optimise_pruning(m, df)
    assert len(res["model"].nodes) <= len(m.nodes)
    assert len(S.prune(m, alphas[-1] + 1).nodes) == 1


def test_stream_equals_batch(spark, tmp_path):
    from churnspark.operators.encode import Preprocessor
    from churnspark.spec import FrameSpec
    rows = [(i, float(i % 13), ["x", "y", "z"][i % 3], int(i % 4 == 0)) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, v double, c string, churn int")
    spec = FrameSpec.infer(df)
    pm = Preprocessor(spec).fit(df)
    enc = pm.transform(df).withColumnRenamed("churn", "label")
    m = fit_tree(enc, pm.feature_names, "label", TreeParams(max_depth=3))
    src = tmp_path / "in"
    df.drop("churn").repartition(3).write.parquet(str(src))
    q = score_stream(spark, str(src), df.drop("churn").schema, pm, m, query_name="scored_t")
    q.processAllAvailable()
    q.stop()
    stream = sorted(tuple(r) for r in spark.sql("SELECT * FROM scored_t").collect())
    batch = sorted(tuple(r) for r in scoring_plan(df.drop("churn"), pm, m).collect())
    assert stream == batch and len(batch) == 200
