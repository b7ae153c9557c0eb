"""Splits and ranks by hash prefix for any target type, exact neighbours against all pairs, SMOTE's even generation."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnspark.functions.hashing import hash_key
from churnspark.operators import neighbours
from churnspark.operators.balance import smote
from churnspark.operators.neighbours import nearest
from churnspark.operators.ranking import lowest_by_hash, rank_by_hash
from churnspark.operators.split import split_quotas, stratified_folds, stratified_split

TARGETS = {"int": [0, 1, 1, 0, 0], "boolean": [True, False, False], "string": ["no", "yes", "no", "maybe"],
           "boolean with nulls": [True, None, False, False], "string with nulls": [None, "a", "b", "b"], "int with nulls": [1, None, 0]}


def plain_order(ids, seed):
    return sorted(ids, key=lambda i: (hashlib.md5(f"{seed}:{i}".encode()).hexdigest()[:13], i))


@pytest.mark.parametrize("kind", TARGETS)
def test_split_and_folds_for_any_target(spark, kind):
    values = TARGETS[kind]
    rows = [(i, values[i % len(values)]) for i in range(331)]
    df = spark.createDataFrame(rows, f"id long, y {kind.split()[0]}").repartition(5)
    by = {}
    for i, y in rows:
        by.setdefault(y, []).append(i)
    quotas = split_quotas({y: len(v) for y, v in by.items()}, 0.2)
    split = stratified_split(df, "y")
    assert split.schema["is_test"].dataType.typeName() == "boolean" and split.columns == ["id", "y", "is_test"]
    got = split.collect()
    assert len(got) == 331 and {r["is_test"] for r in got} == {True, False}
    assert {r["id"] for r in got if r["is_test"]} == {i for y, v in by.items() for i in plain_order(v, 42)[:quotas[y]]}
    folds = {r["id"]: r["fold"] for r in stratified_folds(df, "y").collect()}
    assert folds == {i: k % 5 for v in by.values() for k, i in enumerate(plain_order(v, "42:fold"))}


def test_split_of_an_empty_table_and_extreme_sizes(spark):
    df = spark.createDataFrame([], "id long, y boolean")
    assert stratified_split(df, "y").collect() == [] and stratified_folds(df, "y").collect() == []
    df = spark.range(20).withColumn("y", F.col("id") % 2 == 0)
    assert stratified_split(df, "y", test_size=20).filter("is_test").count() == 20
    assert stratified_split(df, "y", test_size=0.0).filter("is_test").count() == 0


def test_ranks_inside_one_prefix(spark):
    df = spark.range(200).withColumn("h", F.lit("0000abcd"))  # all rows in one bucket: the order falls to the key
    assert {r["id"]: r["r"] for r in rank_by_hash(df, F.lit(1), F.col("h"), "id", "r").collect()} == {i: i for i in range(200)}
    low = lowest_by_hash(df, F.lit(1), F.col("h"), "id", {1: 7}, "low").filter("low").collect()
    assert {r["id"] for r in low} == set(range(7))


def test_split_moves_no_rows_but_the_boundary(spark):
    df = spark.range(1000).withColumn("y", F.col("id") % 2 == 0)
    plan = lowest_by_hash(df, F.col("y"), F.substring(hash_key(1, F.col("id")), 1, 13), "id", {True: 100, False: 100}, "t")
    shown = plan._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in shown and "SortMergeJoin" not in shown


def all_pairs(rows, k):
    x = np.array([v for _, v in rows], float).reshape(len(rows), -1)
    out = {}
    for i, (name, _) in enumerate(rows):
        total = np.zeros(len(rows))
        for j in range(x.shape[1]):
            total += (x[i, j] - x[:, j]) ** 2
        d = np.round(np.sqrt(total), 9)
        out[name] = sorted((float(d[j]), rows[j][0]) for j in range(len(rows)) if j != i)[:k]
    return out


def search(spark, rows, k, width, **how):
    df = spark.createDataFrame([(n, *map(float, v)) for n, v in rows], "id long, " + ", ".join(f"f{j} double" for j in range(width)))
    out = {n: [] for n, _ in rows}
    for r in nearest(df.repartition(3), [f"f{j}" for j in range(width)], k, "id", **how).orderBy("id", "nbr_rank").collect():
        out[r["id"]].append((r["dist"], r["nbr_id"]))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_neighbours_in_many_blocks_and_parts(spark, seed, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 16)
    monkeypatch.setattr(neighbours, "VISITS", 30)
    rng = np.random.default_rng(seed)
    x = np.concatenate([np.round(rng.normal(size=(220, 3)), 2), np.eye(4)[rng.integers(0, 4, 220)]], 1)
    rows = [(1000 - 3 * i, v.tolist()) for i, v in enumerate(x)]
    assert search(spark, rows, 5, 7, rows_per_cell=40) == all_pairs(rows, 5)


def test_neighbours_of_a_hot_vector_and_ties(spark):
    rng = random.Random(5)
    rows = [(i, [rng.randint(0, 3), rng.randint(0, 2)]) for i in range(90)] + [(i, [1, 1]) for i in range(200, 290)]
    assert search(spark, rows, 4, 2, rows_per_cell=5) == all_pairs(rows, 4)


def test_neighbours_of_few_rows(spark):
    assert search(spark, [(1, [0.5, 2.0])], 5, 2) == {1: []}
    few = [(1, [0.0, 1.0]), (2, [0.0, 1.0]), (3, [4.0, 1.0])]
    assert search(spark, few, 5, 2) == all_pairs(few, 5)
    assert nearest(spark.createDataFrame([], "id long, f0 double"), ["f0"]).collect() == []


def test_neighbours_form_few_pairs(spark):
    rng = np.random.default_rng(7)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(1500, 3)))]
    df = spark.createDataFrame([(n, *v) for n, v in rows], "id long, a double, b double, c double")
    stats = {}
    nearest(df, ["a", "b", "c"], 5, stats=stats).collect()
    assert stats["vectors"] == 1500 and stats["pairs"].first()["pairs"] < 0.05 * 1500 * 1500


def test_smote_with_a_tiny_minority_fills_all_tasks(spark):
    df = spark.range(20_002).select("id", (F.col("id") >= 20_000).cast("int").alias("label"), (F.col("id") % 97).cast("double").alias("a"),
                                    (F.col("id") % 11).cast("double").alias("b"))
    out = smote(df, ["a", "b"], "label", "id")
    synthetic = out.filter("is_synthetic")
    per_base = {r[0]: r[1] for r in synthetic.groupBy("id").count().collect()}
    assert per_base == {20_000: 9_999, 20_001: 9_999}
    sizes = [r["n"] for r in synthetic.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(sizes) > 1 and max(sizes) <= 1.1 * sum(sizes) / len(sizes)


def test_first_vectors_by_hash_send_few_rows(spark):
    """Each task's share of the first vectors is cut by hash before it is sent; a cut that leaves too few is not used."""
    vectors = spark.range(0, 4000, 1, 40).select(F.col("id").alias("q"), F.array(F.col("id").cast("double")).alias("x"))
    want = sorted(range(4000), key=lambda i: hashlib.md5(f"pivot:{i}".encode()).hexdigest())[:100]
    for n in (4000, 150, 400_000):  # cut, no cut needed, too few left
        assert [int(r["x"][0]) for r in neighbours._first_by_hash(vectors, n, 100)] == want
