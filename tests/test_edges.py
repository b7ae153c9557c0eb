"""Edges: decisions on raw values, unusable scoring rows, refused input."""

import pytest
from pyspark.sql import functions as F

from churnspark.operators import impact as I
from churnspark.operators import metrics as M
from churnspark.operators.encode import Preprocessor
from churnspark.operators.outliers import remove_outliers
from churnspark.operators.tree import TreeParams, fit_tree
from churnspark.plans.prepare import prepare
from churnspark.spec import FrameSpec
from churnspark.streaming import scoring_plan


def test_rating_uses_the_raw_accuracy(spark):
    row = spark.createDataFrame([(0.79999984, 0.75)], "accuracy double, roc_auc double")
    got = I.performance_rating(row).first()
    assert (got["accuracy_rating"], got["accuracy_score"]) == ("Fair", 3)


def test_rates_are_not_rounded(spark):
    cm = spark.createDataFrame([(2, 1, 0, 4)], "tn long, fp long, fn long, tp long")
    assert M.rates(cm).first()["accuracy"] == 6 / 7


def test_unusable_rows_are_flagged(spark):
    rows = [(i, float(i % 10), "a" if i % 3 else "b", int(i % 10 > 5)) for i in range(80)]
    df = spark.createDataFrame(rows, "id long, x double, k string, churn int")
    prep = Preprocessor(FrameSpec.infer(df, "churn", "id")).fit(df)
    enc = df.select("id", F.col("churn").alias("label"), *prep.feature_exprs())
    model = fit_tree(enc, prep.feature_names, "label", TreeParams(max_depth=2))
    bad = [(1, None, "a"), (2, float("nan"), "a"), (3, float("inf"), "a"), (4, float("-inf"), "b"), (5, 9.0, None), (6, 9.0, "a"), (7, 9.0, "unseen")]
    got = {r["id"]: r for r in scoring_plan(spark.createDataFrame(bad, "id long, x double, k string"), prep, model).collect()}
    assert all(got[i]["is_fallback"] and got[i]["p1"] == 0.5 and got[i]["risk_tier"] == "Medium" for i in range(1, 6))
    assert not got[6]["is_fallback"] and got[6]["p1"] > 0.9 and not got[7]["is_fallback"]


def test_prepare_refuses_missing_targets_and_keys(spark):
    df = spark.createDataFrame([(i, float(i), None if i == 3 else i % 2) for i in range(20)], "id long, x double, churn int")
    with pytest.raises(ValueError, match="1 rows have no churn"):
        prepare(df, "churn", "id")
    with pytest.raises(ValueError, match="key column"):
        prepare(df.drop("id"), "churn", None)


def test_outlier_chain_counts_with_nulls(spark):
    rows = [(i, float(i), float(i % 7)) for i in range(40)] + [(100, 1000.0, 1.0), (101, None, 2.0), (102, 5.0, 900.0)]
    res = remove_outliers(spark.createDataFrame(rows, "id long, x double, y double"), ["x", "y"])
    assert res.counts == {"x": 1, "y": 1} and res.rows_after == 40 == res.frame.count()
