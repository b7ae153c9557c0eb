"""Pruning against its definition, per-fold preparation against a fit of each fold, grid search with refit and test."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnspark.operators import fold_prep
from churnspark.operators import search as S
from churnspark.operators.encode import Preprocessor
from churnspark.operators.split import stratified_folds
from churnspark.operators.tree import TreeModel, TreeParams, fit_tree
from churnspark.spec import FrameSpec


def _node(nid, up, side, depth, w0, w1, leaf):
    return {"model_id": 0, "node_id": nid, "parent_id": up, "depth": depth, "side": side, "feature_idx": None if leaf else 0,
            "feature": None if leaf else "a", "threshold": None if leaf else 0.0, "n": int(w0 + w1), "w0": float(w0), "w1": float(w1),
            "impurity": 0.0, "decrease": 0.0, "prediction": int(w1 > w0), "p1": w1 / (w0 + w1), "is_leaf": leaf}


def random_tree(seed, splits=6):
    rng = np.random.default_rng(seed)
    leaves, nodes, last = [1], {1: _node(1, None, "root", 0, *rng.integers(1, 60, 2), True)}, 1
    for _ in range(splits):
        if not leaves:
            break
        nid = leaves.pop(int(rng.integers(len(leaves))))
        r = nodes[nid]
        l0, l1 = int(rng.integers(0, r["w0"] + 1)), int(rng.integers(0, r["w1"] + 1))
        if l0 + l1 in (0, r["n"]):
            continue
        nodes[nid] = dict(r, is_leaf=False, feature_idx=0, feature="a", threshold=0.0)
        for side, w in (("left", (l0, l1)), ("right", (r["w0"] - l0, r["w1"] - l1))):
            last += 1
            nodes[last] = _node(last, nid, side, r["depth"] + 1, *w, True)
            leaves.append(last)
    return TreeModel(["a"], TreeParams(criterion="gini"), list(nodes.values()))


def prunings(model):
    """Leaf sets of all prunings."""
    kids = {}
    for r in model.nodes:
        kids.setdefault(r["parent_id"], []).append(r["node_id"])

    def under(nid):
        out = [frozenset([nid])]
        if nid in kids:
            out += [a | b for a, b in itertools.product(*(under(c) for c in kids[nid]))]
        return out
    return under(1)


def risks(model):
    by = {r["node_id"]: r for r in model.nodes}
    total = by[1]["w0"] + by[1]["w1"]
    return {n: (r["w0"] + r["w1"]) / total * S.impurity(r["w0"], r["w1"], "gini") for n, r in by.items()}


@pytest.mark.parametrize("seed", range(40))
def test_pruning_is_the_cheapest_smallest_subtree(seed):
    model = random_tree(seed)
    risk = risks(model)
    path = S.pruning_path(model)
    alphas = [a for a, _ in path]
    assert alphas[0] == 0.0 and alphas == sorted(alphas)
    between = [(a + b) / 2 for a, b in zip(alphas, alphas[1:])] + [alphas[-1] + 1]
    for a in between:
        cost = {t: sum(risk[n] for n in t) + a * len(t) for t in prunings(model)}
        best = min(cost.values())
        want = min((t for t, c in cost.items() if c <= best + 1e-12), key=len)
        got = frozenset(r["node_id"] for r in S.prune(model, a).nodes if r["is_leaf"])
        assert got == want
        impurity = path[max(i for i, x in enumerate(alphas) if x <= a)][1]
        assert impurity == pytest.approx(sum(risk[n] for n in want), abs=1e-12)


def _signal(spark, n=400):
    rng = np.random.default_rng(6)
    a, b = rng.normal(size=n), rng.normal(size=n)
    y = (a + 0.7 * rng.normal(size=n) > 0.3).astype(int)
    return spark.createDataFrame([(i, float(a[i]), float(b[i]), int(y[i])) for i in range(n)], "id long, a double, b double, label int").cache()


def test_alpha_scores_equal_scoring_each_pruned_tree(spark):
    df = _signal(spark)
    model = fit_tree(df.filter("id < 250"), ["a", "b"], "label", TreeParams(max_depth=4, min_samples_leaf=2, class_weight=None))
    rows = df.filter("id >= 250")
    alphas = [a for a, _ in S.pruning_path(model)]
    got = S.alpha_scores(model, rows, alphas)
    for i in (0, len(alphas) // 2, len(alphas) - 1):
        hits = S.prune(model, alphas[i]).predict(rows).agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]
        assert got[i] == pytest.approx(hits, abs=1e-12)
    res = S.optimise_pruning(model, rows)
    assert res["scores"][res["alphas"].index(res["best_alpha"])] == max(res["scores"])


def test_pruning_parity_grows_on_the_validation_rows(spark):
    df = _signal(spark, 160)
    params = TreeParams(max_depth=3, min_samples_leaf=4, class_weight=None)
    model = fit_tree(df.filter("id < 40"), ["a", "b"], "label", params)
    res = S.optimise_pruning(model, df, parity=True)
    own = fit_tree(df, ["a", "b"], "label", params)
    assert res["alphas"] == S.sample_alphas([a for a, _ in S.pruning_path(own)])
    assert res["scores"][0] == 1.0 and res["best_alpha"] == 0.0  # an unlimited tree knows its own rows
    assert len(res["model"].nodes) == len(S.prune(own, 0.0).nodes) and res["model"].nodes[0]["n"] == 160


def test_fold_preparation_equals_a_fit_of_each_fold(spark):
    rows = [(i, None if i % 17 == 0 else float(i * i % 31), 5.0, "rare" if i == 3 else "abc"[i % 3], None if i % 5 == 0 else "xy"[i % 2], int(i % 4 == 0)) for i in range(120)]
    df = spark.createDataFrame(rows, "id long, u double, constant double, c string, g string, label int")
    spec = FrameSpec.infer(df)
    folded = stratified_folds(df, "label", k=4).cache()
    wide = folded.select("*", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("m"))
    names, exprs = fold_prep.refit_features(folded, spec, 4, F.col("m"))
    got = {(r["id"], r["m"]): r for r in wide.select("id", "m", *exprs).collect()}
    for f in range(4):
        fitted = Preprocessor(spec).fit(folded.filter(F.col("fold") != f))
        for r in fitted.transform(folded, keep=["id"]).collect():
            mine = got[r["id"], f]
            for n in names:
                assert mine[n] == pytest.approx(r[n] if n in fitted.feature_names else 0.0, abs=2e-9)
            assert set(fitted.feature_names) <= set(names)


def test_states_merge_like_all_values():
    x = [[1.0, 2.0, 9.0], [], [4.0], [-3.0, 0.5]]
    states = [(len(v), float(np.mean(v)) if v else 0.0, float(np.var(v) * len(v)) if v else 0.0) for v in x]
    total = (0, 0.0, 0.0)
    for s in states:
        total = fold_prep.merge(total, s)
    whole = np.concatenate(x)
    assert total == pytest.approx((6, whole.mean(), whole.var() * 6))


def test_grid_search_refits_and_tests_the_best(spark):
    df = _signal(spark)
    grid = {"max_depth": [1, 2], "min_samples_split": [10, 20], "min_samples_leaf": [5], "criterion": ["gini"], "max_features": [None]}
    res = S.grid_search(df.filter("id < 300"), ["a", "b"], "label", grid, k=3, test=df.filter("id >= 300"))
    best = res["best_params"]
    direct = fit_tree(df.filter("id < 300"), ["a", "b"], "label", best)
    assert res["best_model"].nodes == direct.nodes
    hits = direct.predict(df.filter("id >= 300")).agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]
    assert res["test_evaluation"].first()["accuracy"] == pytest.approx(hits)
    scores = {r["combo_id"]: r["mean_test_score"] for r in res["results"].collect()}
    assert min(i for i, s in scores.items() if s == max(scores.values())) == next(
        r["combo_id"] for r in res["results"].collect() if (r["max_depth"], r["min_samples_split"]) == (best.max_depth, best.min_samples_split))
    assert math.isclose(res["best_score"], max(scores.values()))


def test_grouped_metrics_read_their_rows_once(spark):
    rows = [(g, float(i % 4) / 4, int(i % 4 > 2), int((i + g) % 3 == 0)) for g in (0, 1) for i in range(40)]
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b
    pred = spark.createDataFrame(rows, "g int, p1 double, prediction int, label int").mapInArrow(counted, "g int, p1 double, prediction int, label int")
    got = {r["g"]: r for r in S.grouped_metrics(pred, ["g"]).collect()}
    assert read.value == len(rows)
    for g, r in got.items():
        own = [x[1:] for x in rows if x[0] == g]
        pos, neg = [s for s, _, y in own if y], [s for s, _, y in own if not y]
        assert r["accuracy"] == pytest.approx(sum(p == y for _, p, y in own) / 40)
        assert r["roc_auc"] == pytest.approx(sum((a > b) + (a == b) / 2 for a in pos for b in neg) / (len(pos) * len(neg)))
