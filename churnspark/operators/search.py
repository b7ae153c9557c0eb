"""Cross-validation, grid search and cost-complexity pruning.

All folds (and all grid growths) are trees of one batched fit: rows are
replicated once per model they train, tagged with ``model_id``, and every
level of every tree is found by the same job sequence.

Grid search without one fit per combination: greedy growth with fixed tie
rules makes ``max_depth`` and ``min_samples_split`` pure truncations of a
deeper tree (they decide *whether* a node splits, never *where*). Only leaf
size x criterion x max_features need their own growth; each grid point is
then read off its growth by stopping every validation row at the first node
on its path that the truncation makes a leaf.
"""

from __future__ import annotations

import itertools
import math
from dataclasses import replace

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from churnspark.functions.exprs import safe_div
from churnspark.operators.fold_prep import refit_features
from churnspark.operators.split import stratified_folds
from churnspark.operators.node_arrays import NodeArrays, Routes
from churnspark.operators.tree import TreeModel, TreeParams, fit_tree, impurity
from churnspark.spec import FrameSpec

TIE_DIGITS = 12      # scores that agree to so many digits tie
SAME_ALPHA = 1e-12   # alphas closer than this are one
METRICS = ["accuracy", "precision", "recall", "f1", "roc_auc"]
# The reference's default search space (fixed values): 5 x 4 x 4 x 2 x 3 = 480 points.
DEFAULT_GRID = {
    "max_depth": [None, 5, 10, 15, 20],
    "min_samples_split": [2, 5, 10, 20],
    "min_samples_leaf": [1, 2, 4, 8],
    "criterion": ["gini", "entropy"],
    "max_features": [None, "sqrt", "log2"],
}


# ------------------------------------------------------------ grouped metrics --
def grouped_metrics(pred: DataFrame, groups: list[str], label: str = "label", score: str = "p1",
                    prediction: str = "prediction") -> DataFrame:
    """accuracy / precision / recall / f1 / roc_auc per group (one pass + one
    window over (group, distinct score) rows, which a tree keeps to <= leaves)."""
    y, p = F.col(label), F.col(prediction)
    # counted by score once: the rows are scored in one pass, and the confusion counts are sums over the scores
    sc = pred.groupBy(*groups, F.round(score, TIE_DIGITS).alias("s")).agg(
        F.count_if((y == 0) & (p == 0)).alias("tn"), F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 1) & (p == 1)).alias("tp"),
        F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg"))
    w = Window.partitionBy(*groups).orderBy(F.col("s").desc()).rowsBetween(Window.unboundedPreceding, 0)
    found = (sc.withColumn("tp_cum", F.sum("pos").over(w))
             .groupBy(*groups).agg(
                 *[F.sum(c).alias(c) for c in ("tn", "fp", "fn", "tp")], F.sum("pos").alias("P"), F.sum("neg").alias("N"),
                 F.sum(F.col("neg").cast("double") * ((F.col("tp_cum") - F.col("pos")) + F.col("pos") / 2.0)).alias("area")))
    auc = F.when((F.col("P") > 0) & (F.col("N") > 0), F.col("area") / (F.col("P") * F.col("N")))
    tn, fp, fn, tp = (F.col(c).cast("double") for c in ("tn", "fp", "fn", "tp"))
    return found.select(
        *groups,
        safe_div(tp + tn, tn + fp + fn + tp).alias("accuracy"), safe_div(tp, tp + fp).alias("precision"),
        safe_div(tp, tp + fn).alias("recall"), safe_div(2 * tp, 2 * tp + fp + fn).alias("f1"), auc.alias("roc_auc"))


def summarise(per_fold: DataFrame, groups: list[str]) -> DataFrame:
    """Mean and population std of each metric per group, on raw values."""
    long = per_fold.select(*groups, F.inline(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("v")) for m in METRICS])))
    return long.groupBy(*groups, "metric").agg(F.avg("v").alias("mean"), F.stddev_pop("v").alias("std"))


# --------------------------------------------------------------- CV (F5-F7) --
def cross_validate(df: DataFrame, features: list[str] | None = None, label: str = "label", params: TreeParams | None = None,
                   k: int = 5, seed: int = 42, key: str = "id", refit_prep: FrameSpec | None = None) -> dict:
    """stratified k-fold CV; all k trees grown together. Returns per-fold train/test metrics, their mean /
    population std, and the trees.

    ``df`` holds encoded ``features``; or, with ``refit_prep``, the raw columns of that spec, and each fold's model
    gets features whose moments and categories come from its own training folds alone (S8)."""
    params = params or TreeParams()
    folded = stratified_folds(df, label, key, k, seed).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        rows = folded.select("*", F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("model_id"))
        if refit_prep:
            features, exprs = refit_features(folded, refit_prep, k, F.col("model_id"))
            rows = rows.select(F.col(label), "fold", "model_id", *exprs)
        model = fit_tree(rows.filter(F.col("model_id") != F.col("fold")), features, label, params, model_col="model_id")
        scored = model.predict(rows, model_col="model_id").withColumn(
            "split", F.when(F.col("fold") == F.col("model_id"), F.lit("test")).otherwise(F.lit("train")))
        found = grouped_metrics(scored, ["model_id", "split"], label).collect()  # two rows a fold
    finally:
        folded.unpersist()
    per_fold = df.sparkSession.createDataFrame(found, "model_id int, split string, " + ", ".join(f"{m} double" for m in METRICS))
    return {"per_fold": per_fold, "summary": summarise(per_fold, ["split"]), "model": model}


def cv_score(df: DataFrame, features: list[str], label: str = "label", params: TreeParams | None = None,
             k: int = 5, scoring: str = "accuracy", seed: int = 42, key: str = "id") -> DataFrame:
    """one metric: each fold's test score, with the mean and the population std of all."""
    if scoring not in METRICS:
        raise ValueError(f"scoring must be one of {METRICS}")
    per_fold = cross_validate(df, features, label, params, k, seed, key)["per_fold"].filter("split = 'test'")
    whole = per_fold.agg(F.avg(scoring).alias("mean_score"), F.stddev_pop(scoring).alias("std_score"))
    return per_fold.select(F.col("model_id").alias("fold"), F.col(scoring).alias("score")).join(F.broadcast(whole))


# --------------------------------------------------------- grid (F8, F9) --
def grid_points(grid: dict | None = None) -> list[dict]:
    """F8: the cartesian product in sorted-key order, last key varying fastest."""
    grid = grid or DEFAULT_GRID
    names = sorted(grid)
    return [dict(zip(names, combo)) for combo in itertools.product(*[grid[n] for n in names])]


def param_grid(spark: SparkSession, grid: dict | None = None) -> DataFrame:
    pts = grid_points(grid)
    rows = [(i, p["criterion"], p["max_depth"], None if p["max_features"] is None else str(p["max_features"]),
             p["min_samples_leaf"], p["min_samples_split"]) for i, p in enumerate(pts)]
    return spark.createDataFrame(rows, "combo_id int, criterion string, max_depth int, max_features string, "
                                       "min_samples_leaf int, min_samples_split int")


def _paths_column(model: TreeModel, levels: int, x: Column, m: Column) -> Column:
    """Array of node ids from the root to the row's leaf (length levels + 1)."""
    routes = Routes(model.splits())

    def step(acc, _i):
        return F.concat(acc, F.array(routes.child(F.element_at(acc, -1), x)))
    slots = F.aggregate(F.sequence(F.lit(1), F.lit(max(levels, 1))), F.array(routes.root(m)), step)
    return F.transform(slots, lambda slot: routes.node(slot, m))


def grid_search(df: DataFrame, features: list[str], label: str = "label", grid: dict | None = None,
                k: int = 5, seed: int = 42, key: str = "id", class_weight: str | None = None,
                test: DataFrame | None = None) -> dict:
    """mean CV accuracy of every grid point; best = highest mean, first on ties; the best point is refitted on
    all rows of ``df`` and, with ``test``, evaluated there (``test_evaluation``: one row of metrics).

    Growths = distinct (criterion, max_features, min_samples_leaf); each is
    grown once per fold with the grid's loosest max_depth and min_samples_split, and
    the points are evaluated as truncations.
    """
    spark = df.sparkSession
    pts = grid_points(grid)
    growth_keys = sorted({(p["criterion"], str(p["max_features"]), p["min_samples_leaf"]) for p in pts})
    gid = {g: i for i, g in enumerate(growth_keys)}
    mf = {str(p["max_features"]): p["max_features"] for p in pts}
    depths = [p["max_depth"] for p in pts]
    deepest, smallest = None if None in depths else max(depths), min(p["min_samples_split"] for p in pts)
    model_params = {}
    for (crit, mfs, msl), g in gid.items():
        for f in range(k):
            model_params[g * k + f] = TreeParams(max_depth=deepest, min_samples_split=smallest, min_samples_leaf=msl,
                                                 criterion=crit, class_weight=class_weight,
                                                 max_features=mf[mfs], seed=seed)
    folded = stratified_folds(df, label, key, k, seed).persist(StorageLevel.MEMORY_AND_DISK)
    growth_ids = F.explode(F.sequence(F.lit(0), F.lit(len(growth_keys) - 1))).alias("g")
    trained = F.filter(F.sequence(F.lit(0), F.lit(len(growth_keys) * k - 1)), lambda m: m % k != F.col("fold"))
    # the growths of a fold train on the same rows
    model = fit_tree(folded.withColumn("model_ids", trained), features, label, TreeParams(max_depth=deepest, class_weight=class_weight),
                     models_col="model_ids", model_params=model_params, same_rows={m: m % k for m in model_params})
    # validation rows: each row once per growth, scored by its own fold's tree
    val = folded.select("*", growth_ids).withColumn("model_id", F.col("g") * k + F.col("fold"))
    x = F.array(*[F.col(c).cast("double") for c in features])
    val = val.withColumn("path", _paths_column(model, model.depth, x, F.col("model_id")))
    nodes = {(r["model_id"], r["node_id"]): r for r in model.nodes}
    places = NodeArrays(nodes)
    variants = sorted({(p["max_depth"] if p["max_depth"] is not None else 10 ** 6, p["min_samples_split"])
                       for p in pts})
    var_arr = F.array(*[F.struct(F.lit(md).alias("md"), F.lit(ms).alias("mss")) for md, ms in variants])
    v = val.select("model_id", "g", "fold", F.col(label).alias("y"), "path", F.explode(var_arr).alias("var"))
    stop = F.transform(F.col("path"), lambda node, i: (i >= F.col("var.md")) | (
        places.value({key: r["n"] for key, r in nodes.items()}, "bigint", F.col("model_id"), node) < F.col("var.mss")) | (
        i == F.size("path") - 1) | (node == F.element_at(F.col("path"), F.least(i + 2, F.size("path")))))
    leaf = F.element_at(F.col("path"), F.array_position(stop, True).cast("int"))
    p1 = places.value({key: r["p1"] for key, r in nodes.items()}, "double", F.col("model_id"), leaf)
    scored = v.select("g", "fold", F.col("var.md").alias("md"), F.col("var.mss").alias("mss"),
                      ((p1 > 0.5).cast("int") == F.col("y")).cast("double").alias("hit"))
    fold_acc = scored.groupBy("g", "md", "mss", "fold").agg(F.avg("hit").alias("acc"))
    # points x folds numbers; summed in fold order, so that equal scores give equal means
    accs: dict[tuple, list[float]] = {}
    for r in sorted(fold_acc.collect(), key=lambda r: r["fold"]):
        accs.setdefault((r["g"], r["md"], r["mss"]), []).append(r["acc"])
    res = {point: (float(np.mean(a)), float(np.std(a))) for point, a in accs.items()}
    table = []
    for i, p in enumerate(pts):
        g = gid[(p["criterion"], str(p["max_features"]), p["min_samples_leaf"])]
        md = p["max_depth"] if p["max_depth"] is not None else 10 ** 6
        mean, std = res[(g, md, p["min_samples_split"])]
        table.append((i, p["criterion"], p["max_depth"], None if p["max_features"] is None else str(p["max_features"]),
                      p["min_samples_leaf"], p["min_samples_split"], mean, std))
    best = max(table, key=lambda r: (r[6], -r[0]))
    results = spark.createDataFrame(
        table, "combo_id int, criterion string, max_depth int, max_features string, min_samples_leaf int, "
               "min_samples_split int, mean_test_score double, std_test_score double")
    best_params = TreeParams(max_depth=best[2], min_samples_split=best[5], min_samples_leaf=best[4],
                             criterion=best[1], class_weight=class_weight, max_features=mf[str(best[3])], seed=seed)
    folded.unpersist()
    refitted = fit_tree(df, features, label, best_params)
    out = {"results": results, "best_params": best_params, "best_score": best[6], "best_model": refitted}
    if test is not None:
        pred = refitted.predict(test).withColumn("split", F.lit("test"))
        out["test_evaluation"] = grouped_metrics(pred, ["split"], label).drop("split")
    return out


# -------------------------------------------------------- pruning (F10-F12) --
def collapse_alphas(model: TreeModel, model_id: int = 0) -> dict[int, dict]:
    """For every node its risk, the ``alpha`` at which it becomes a leaf (0 for leaves), and ``cap``, the alpha from
    which it is gone because a node above has become one. Node t is a leaf of the pruned tree at a when alpha <= a < cap.

    Bottom-up, one pass: the branches of t cost R(T) + a |T| at best, a concave function that is kept as sorted
    breakpoints (alpha, risk, leaves). t collapses once R(t) + a is no more, that is at
    the largest (R(t) - R(T)) / (|T| - 1) over the breakpoints' prunings T; later breakpoints below t are then void."""
    nodes = {r["node_id"]: r for r in model.nodes if r["model_id"] == model_id}
    root_w = nodes[1]["w0"] + nodes[1]["w1"]
    below: dict[int, list[int]] = {}
    for r in nodes.values():
        if r["parent_id"] is not None:
            below.setdefault(r["parent_id"], []).append(r["node_id"])
    out, steps = {}, {}
    for nid in sorted(nodes, reverse=True):  # children have larger ids
        r = nodes[nid]
        risk = (r["w0"] + r["w1"]) / root_w * impurity(r["w0"], r["w1"], model.params.criterion)
        if r["is_leaf"]:
            alpha, steps[nid] = 0.0, np.array([[0.0, risk, 1.0]])
        else:
            sides = [steps.pop(c) for c in below[nid]]
            at = np.unique(np.concatenate([s[:, 0] for s in sides]))
            joint = sum(s[np.searchsorted(s[:, 0], at, "right") - 1, 1:] for s in sides)
            alpha = max(0.0, float(((risk - joint[:, 0]) / (joint[:, 1] - 1.0)).max()))
            live = at < alpha
            steps[nid] = np.concatenate([np.column_stack([at, joint])[live], [[alpha, risk, 1.0]]])
        out[nid] = {"risk": risk, "alpha": alpha, "cap": math.inf}
    for nid in sorted(nodes):
        if (up := nodes[nid]["parent_id"]) is not None:
            out[nid]["cap"] = min(out[up]["cap"], out[up]["alpha"])
    return out


def _levels(found: dict[int, dict]) -> list[float]:
    """Alphas at which the pruned tree changes, 0 first; values closer than rounding are one."""
    at = [0.0]
    for a in sorted(v["alpha"] for v in found.values() if v["alpha"] < v["cap"]):
        if a > at[-1] + SAME_ALPHA:
            at.append(a)
    return at


def _is_leaf(v: dict, alpha: float) -> bool:
    return v["alpha"] <= alpha + SAME_ALPHA < v["cap"]


def pruning_path(model: TreeModel, model_id: int = 0) -> list[tuple[float, float]]:
    """``(alpha, total leaf impurity)`` from the full tree (alpha 0) down to the root alone; one entry for each
    alpha at which the tree changes."""
    found = collapse_alphas(model, model_id)
    at = _levels(found)
    change = np.zeros(len(at) + 1)
    for v in found.values():  # a node's risk counts from the level of its alpha to that of its cap
        lo = np.searchsorted(at, v["alpha"] - SAME_ALPHA)
        hi = len(at) if math.isinf(v["cap"]) else np.searchsorted(at, v["cap"] - SAME_ALPHA)
        if lo < hi:
            change[lo] += v["risk"]
            change[hi] -= v["risk"]
    return list(zip(at, np.cumsum(change)[:-1].tolist()))


def pruning_table(spark: SparkSession, model: TreeModel, model_id: int = 0) -> DataFrame:
    """F10 as a table: ``(step, alpha, impurity, n_leaves)``."""
    found = collapse_alphas(model, model_id)
    rows = [(i, float(a), float(imp), sum(1 for v in found.values() if _is_leaf(v, a))) for i, (a, imp) in enumerate(pruning_path(model, model_id))]
    return spark.createDataFrame(rows, "step int, alpha double, impurity double, n_leaves int")


def sample_alphas(alphas: list[float], n: int = 20) -> list[float]:
    """all alphas but the last (root-only tree); more than ``n`` -> ``n`` evenly spaced."""
    a = alphas[:-1]
    if len(a) > n:
        idx = [int(i * (len(a) - 1) / (n - 1)) for i in range(n)]
        a = [a[i] for i in idx]
    return a


def prune(model: TreeModel, alpha: float, model_id: int = 0) -> TreeModel:
    """The subtree kept at ``alpha``: nodes whose collapse alpha is at most ``alpha`` are leaves."""
    found = collapse_alphas(model, model_id)
    kept = []
    for r in model.nodes:
        if r["model_id"] == model_id and alpha + SAME_ALPHA < found[r["node_id"]]["cap"]:
            r = dict(r, model_id=0)
            if not r["is_leaf"] and found[r["node_id"]]["alpha"] <= alpha + SAME_ALPHA:
                r.update(is_leaf=True, feature_idx=None, feature=None, threshold=None, decrease=0.0)
            kept.append(r)
    return TreeModel(model.features, replace(model.params), kept)


def alpha_scores(model: TreeModel, rows: DataFrame, alphas: list[float], label: str = "label") -> list[float]:
    """Accuracy on ``rows`` of the tree pruned at each alpha, in one pass that copies no row.

    A row's prediction at an alpha depends only on the full tree's leaf it falls into, so rows are counted by (leaf,
    class), a table of the tree's size. Up the path from a leaf, the nodes that are leaves for some alpha hold
    intervals of alphas; each adds its hits where its interval begins and takes them back where it ends."""
    found = collapse_alphas(model)
    nodes = {r["node_id"]: r for r in model.nodes}
    counts = model.predict(rows).groupBy("node_id", F.col(label).cast("int").alias("y")).agg(F.count(F.lit(1)).alias("n")).collect()
    change, total = np.zeros(len(alphas) + 1), 0
    for c in counts:
        total += c["n"]
        nid = c["node_id"]
        while nid is not None:
            v = found[nid]
            if nodes[nid]["prediction"] == c["y"] and v["alpha"] < v["cap"]:
                lo = np.searchsorted(alphas, v["alpha"] - SAME_ALPHA)
                hi = len(alphas) if math.isinf(v["cap"]) else np.searchsorted(alphas, v["cap"] - SAME_ALPHA)
                if lo < hi:
                    change[lo] += c["n"]
                    change[hi] -= c["n"]
            nid = nodes[nid]["parent_id"]
    return (np.cumsum(change)[:-1] / max(1, total)).tolist()


def optimise_pruning(model: TreeModel, validation: DataFrame, label: str = "label", n_alphas: int = 20,
                     parity: bool = False) -> dict:
    """the sampled alpha with the best accuracy (first on ties) and the tree rebuilt at it with the model's parameters.

    By default alphas come from ``model`` and are scored on the validation rows; the rebuilt tree is ``model`` pruned, as
    the same rows would grow the same tree. ``parity=True`` follows the reference: the path comes from a tree with the
    model's parameters grown on the validation rows, candidates are unlimited Gini trees grown and scored on the same
    rows, and the chosen alpha prunes the former."""
    scored = model
    if parity:
        rows = validation.persist(StorageLevel.MEMORY_AND_DISK)
        model = fit_tree(rows, model.features, label, model.params)
        loose = TreeParams(max_depth=None, min_samples_split=2, min_samples_leaf=1, criterion="gini", class_weight=None, seed=model.params.seed)
        scored = fit_tree(rows, model.features, label, loose)
    alphas = sample_alphas([a for a, _ in pruning_path(model)], n_alphas) or [0.0]
    scores = alpha_scores(scored, validation, alphas, label)
    if parity:
        rows.unpersist()
    best = max(range(len(alphas)), key=lambda i: (scores[i], -i))
    return {"alphas": alphas, "scores": scores, "best_alpha": alphas[best], "model": prune(model, alphas[best])}


def model_card(spark: SparkSession, model: TreeModel, total_features: int) -> DataFrame:
    """model type, parameters and structure as ``(key, value)`` rows."""
    p = model.params
    used = len({r["feature_idx"] for r in model.nodes if not r["is_leaf"] and r["decrease"] > 0})
    rows = [("model_type", "DecisionTree"), ("criterion", p.criterion), ("max_depth", str(p.max_depth)),
            ("min_samples_split", str(p.min_samples_split)), ("min_samples_leaf", str(p.min_samples_leaf)),
            ("class_weight", str(p.class_weight)), ("max_features", str(p.max_features)),
            ("random_state", str(p.seed)), ("tree_depth", str(model.depth)), ("n_nodes", str(len(model.nodes))),
            ("n_leaves", str(sum(1 for r in model.nodes if r["is_leaf"]))), ("n_features_used", str(used)),
            ("total_features", str(total_features)), ("classes", "0,1"), ("n_classes", "2")]
    return spark.createDataFrame(rows, "key string, value string")
