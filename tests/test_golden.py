"""Recorded run: confusion 561/136/35/143, AUC .867 (fixed values from the reference's outputs)."""
import pytest

from churnspark.operators import impact as I
from churnspark.operators import metrics as M


@pytest.fixture()
def cm(spark):
    return spark.createDataFrame([(561, 136, 35, 143)], "tn long, fp long, fn long, tp long")


def test_rates(cm):
    r = M.rates(cm).first()
    assert r["accuracy"] == pytest.approx(0.804571, abs=1e-6)
    assert r["precision"] == pytest.approx(0.512545, abs=1e-6)
    assert r["recall"] == pytest.approx(0.803371, abs=1e-6)
    assert r["f1"] == pytest.approx(0.625821, abs=1e-6)
    assert r["specificity"] == pytest.approx(0.804878, abs=1e-6)
    assert r["fpr"] == pytest.approx(0.195122, abs=1e-6)
    assert r["fnr"] == pytest.approx(0.196629, abs=1e-6)


def test_financial_impact(cm):
    f = I.financial_impact(cm).first()
    assert f["net_value"] == 40050.0
    assert f["roi"] == pytest.approx(2.870968, abs=1e-6)
    c = I.campaign_counts(cm).first()
    assert (c["total_customers"], c["actual_churners"], c["predicted_churners"]) == (875, 178, 279)


def test_verdicts(spark, cm):
    m = M.rates(cm).selectExpr("*", "0.867 AS roc_auc")
    g = I.performance_rating(m).first()
    assert (g["auc_score"], g["accuracy_score"], g["overall_score"], g["overall_grade"], g["verdict"]) == (
        3, 4, 3.5, "B+", "APPROVED")
    assert (g["auc_rating"], g["accuracy_rating"]) == ("Good", "Good")
    rd = I.deployment_readiness(m).first()
    assert rd["status"] == "APPROVED" and rd["accuracy_threshold"] and rd["auc_threshold"] and rd["grade_acceptable"]
    sw = {r["label"] for r in I.strengths_weaknesses(m).collect()}
    assert {"High Recall", "Good AUC", "Good Accuracy", "Low Precision"} <= sw


def test_grade_edges(spark):
    m = spark.createDataFrame([(0.30, 0.40), (1.0, 1.0), (0.74, 0.79)], "accuracy double, roc_auc double")
    rows = I.performance_rating(m).collect()
    assert [r["overall_grade"] for r in rows] == ["D", "A", "B"]
    rd = I.deployment_readiness(m.limit(1)).first()
    assert rd["status"] == "NOT READY"


def test_tiers_strict_edges(spark):
    from churnspark.operators.score import label_and_tier
    df = spark.createDataFrame([(1, 0.4), (2, 0.5), (3, 0.7), (4, 0.71), (5, 0.41)], "id int, p1 double")
    got = {r["id"]: (r["decision"], r["risk_tier"]) for r in label_and_tier(df).collect()}
    assert got[1] == ("Likely to Stay", "Low")
    assert got[2] == ("Likely to Stay", "Medium")
    assert got[3] == ("Likely to Churn", "Medium")
    assert got[4] == ("Likely to Churn", "High")
    assert got[5][1] == "Medium"
