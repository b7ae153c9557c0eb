"""Routing and node values by constant arrays: large trees, gaps between model ids, models without splits."""

import numpy as np
from pyspark.sql import functions as F

from churnspark.operators.node_arrays import NodeArrays, by_model, constant_array
from churnspark.operators.tree import TreeModel, TreeParams, route


def balanced(depth, model_id=0, width=4):
    """A full tree; node ``n`` has the children ``2n`` and ``2n + 1`` (consecutive breadth-first ids)."""
    rng, nodes = np.random.default_rng(depth), []
    for n in range(1, 2 ** (depth + 1)):
        leaf = n >= 2 ** depth
        nodes.append({"model_id": model_id, "node_id": n, "parent_id": n // 2 or None, "depth": n.bit_length() - 1,
                      "side": "root" if n == 1 else "right" if n % 2 else "left",
                      "feature_idx": None if leaf else int(rng.integers(width)), "feature": None,
                      "threshold": None if leaf else float(rng.random()), "n": 1, "w0": 0.0, "w1": 0.0, "impurity": 0.0,
                      "decrease": 0.0, "prediction": 0, "p1": float(rng.random()) if leaf else 0.0, "is_leaf": leaf})
    return nodes


def walked(nodes, x):
    by_id, n = {r["node_id"]: r for r in nodes}, 1
    while not by_id[n]["is_leaf"]:
        n = 2 * n + (x[by_id[n]["feature_idx"]] > by_id[n]["threshold"])
    return n, by_id[n]["p1"]


def test_constant_arrays(spark):
    one = spark.range(1)
    values = [0.1, None, float("inf"), -1e-300, 5e17 / 3]
    assert one.select(constant_array(values, "double").alias("a")).first()["a"] == values
    assert one.select(constant_array([True, None, False], "boolean").alias("a")).first()["a"] == [True, None, False]
    assert one.select(constant_array([], "int").alias("a")).first()["a"] == [None]
    got = spark.createDataFrame([(i,) for i in (-1, 0, 3, 4, 10 ** 7, 10 ** 12)], "m long")
    near, far = {0: 1.5, 3: 2.5}, {0: 1.5, 10 ** 12: 2.5}
    assert [r[0] for r in got.select(by_model(near, "double", F.col("m"))).collect()] == [1.5 if m == 0 else 2.5 if m == 3 else None for m in (-1, 0, 3, 4, 10 ** 7, 10 ** 12)]
    assert [r[0] for r in got.select(by_model(far, "double", F.col("m"))).collect()] == [None, 1.5, None, None, None, 2.5]


def test_values_stay_in_their_model(spark):
    values = {(0, 4): 1, (0, 5): 2, (2, 2): 3, (2, 4): 4}
    asked = [(m, n) for m in (0, 1, 2, 3) for n in range(1, 8)]
    df = spark.createDataFrame(asked, "m long, n long")
    got = df.select("m", "n", NodeArrays(values).value(values, "bigint", F.col("m"), F.col("n")).alias("v")).collect()
    assert {(r["m"], r["n"]): r["v"] for r in got} == {k: values.get(k) for k in asked}


def test_large_tree_scores(spark):
    nodes = balanced(12)
    model = TreeModel([f"f{i}" for i in range(4)], TreeParams(max_depth=None), nodes)
    xs = np.random.default_rng(1).random((500, 4))
    df = spark.createDataFrame([(i, *map(float, x)) for i, x in enumerate(xs)], "id long, f0 double, f1 double, f2 double, f3 double")
    got = {r["id"]: (r["node_id"], r["p1"]) for r in model.predict(df).collect()}
    assert got == {i: walked(nodes, x) for i, x in enumerate(xs)}


def test_batch_with_gaps_and_rootless_models(spark):
    small, large = balanced(2, 5), balanced(3, 9)
    only_root = [dict(balanced(0, 7)[0], p1=0.25)]
    model = TreeModel([f"f{i}" for i in range(4)], TreeParams(max_depth=None), small + only_root + large)
    xs = np.random.default_rng(2).random((60, 4))
    rows = [(m, i, *map(float, x)) for m in (5, 7, 9) for i, x in enumerate(xs)]
    df = spark.createDataFrame(rows, "m long, id long, f0 double, f1 double, f2 double, f3 double")
    got = {(r["m"], r["id"]): (r["node_id"], r["p1"]) for r in model.predict(df, "m").collect()}
    want = {(m, i): walked(t, x) for m, t in ((5, small), (7, only_root), (9, large)) for i, x in enumerate(xs)}
    assert got == want
    stays = route(df, {}, 3, F.array("f0"), F.col("m")).select("node").distinct().collect()
    assert [r["node"] for r in stays] == [1]
