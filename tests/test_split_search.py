"""Two-level prefix sums: the same trees with and without value slices, no window over a whole feature."""

import numpy as np
import pytest

from churnspark.operators import tree as T


def rows(spark, n=900, seed=4):
    rng = np.random.default_rng(seed)
    a, b = rng.normal(size=n), np.round(rng.normal(size=n), 1)
    y = ((a + 0.5 * b + 0.4 * rng.normal(size=n)) > 0.4).astype(int)
    return spark.createDataFrame([(i, float(a[i]), float(b[i]), float(i % 3), int(y[i])) for i in range(n)],
                                 "id long, a double, b double, c double, label int").repartition(4)


def shown(model):
    return [(r["node_id"], r["feature"], r["threshold"], r["n"], r["w0"], r["w1"], r["is_leaf"]) for r in model.nodes]


@pytest.mark.parametrize("params", [T.TreeParams(max_depth=5), T.TreeParams(max_depth=4, criterion="gini", class_weight=None, min_samples_leaf=1)])
def test_slices_give_the_same_tree(spark, params, monkeypatch):
    df = rows(spark).cache()
    plain = T.fit_tree(df, ["a", "b", "c"], "label", params)
    assert len(plain.nodes) > 9
    assert T._slice_edges(df, ["a", "b", "c"]) == {}
    monkeypatch.setattr(T, "SLICE_VALUES", 25)
    edges = T._slice_edges(df, ["a", "b", "c"])
    assert set(edges) == {0, 1} and len(edges[0]) == 35
    assert shown(T.fit_tree(df, ["a", "b", "c"], "label", params)) == shown(plain)


def test_no_window_holds_a_whole_feature(spark, monkeypatch):
    monkeypatch.setattr(T, "SLICE_VALUES", 25)
    df = rows(spark)
    seen = {}
    running = T._running

    def spied(hist, where, sliced):
        if sliced and not seen:
            seen.update({tuple(r[c] for c in where): r["count"] for r in hist.groupBy(*where).count().collect()})
        return running(hist, where, sliced)
    monkeypatch.setattr(T, "_running", spied)
    T.fit_tree(df, ["a", "b", "c"], "label", T.TreeParams(max_depth=2))
    assert len([1 for k in seen if k[1] == 0]) > 25 and max(seen.values()) <= 60  # 900 values of a in 36 slices


def test_a_sliced_feature_is_shuffled_as_rows(spark, monkeypatch):
    monkeypatch.setattr(T, "SLICE_VALUES", 25)
    df = rows(spark)
    counted = []
    running = T._running

    def spied(hist, where, sliced):
        if sliced:
            counted.append("n" in hist.columns)
        return running(hist, where, sliced)
    monkeypatch.setattr(T, "_running", spied)
    T.fit_tree(df, ["a", "b", "c"], "label", T.TreeParams(max_depth=2))
    assert counted and not any(counted)


@pytest.mark.parametrize("slice_values", [25, 50_000])
def test_models_on_the_same_rows_share_their_sums(spark, monkeypatch, slice_values):
    monkeypatch.setattr(T, "SLICE_VALUES", slice_values)
    df = rows(spark).selectExpr("*", "int(id % 3) AS part").cache()
    own = {m: T.TreeParams(max_depth=3, criterion=("gini", "entropy")[m // 6], min_samples_leaf=(1, 60)[m // 3 % 2]) for m in range(12)}
    seen = []
    running = T._running

    def spied(hist, where, sliced):
        seen.append(hist.select("k").distinct().count())
        return running(hist, where, sliced)
    monkeypatch.setattr(T, "_running", spied)
    batch = T.fit_tree(df.selectExpr("*", "filter(sequence(0, 11), m -> m % 3 <> part) AS models"), ["a", "b", "c"], "label", T.TreeParams(max_depth=3),
                       models_col="models", model_params=own, same_rows={m: m % 3 for m in own})
    assert seen[0] == 3  # twelve roots, three sets of rows
    monkeypatch.setattr(T, "_running", running)
    for m in (0, 4, 11):
        alone = T.fit_tree(df.filter(f"part <> {m % 3}"), ["a", "b", "c"], "label", own[m])
        assert len(alone.nodes) > 3 and shown(batch.select_model(m)) == shown(alone)
