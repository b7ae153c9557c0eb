"""Round trips through the sinks and the stored model state."""
from pyspark.sql import functions as F

from churnspark.operators import impact as I
from churnspark.operators import importance as G
from churnspark.operators import inspect as H
from churnspark.operators import metrics as M
from churnspark.operators.encode import Preprocessor
from churnspark.sources import io
from churnspark.spec import FrameSpec
from tests.test_golden_tree import FEATURES, golden_model


def _predictions(spark):
    return spark.range(60).select("id", (F.col("id") % 3 == 0).cast("int").alias("label"), ((F.col("id") % 7) / 7.0).alias("p1"),
                                  (F.col("id") % 7 > 3).cast("int").alias("prediction"))


def test_evaluation_sink(spark, tmp_path):
    bundle = M.evaluate(_predictions(spark))
    io.write_evaluation(bundle, str(tmp_path / "e"), {"model_type": "DecisionTree", "test_rows": 60, "note": None})
    for name, df in bundle.items():
        back = spark.read.json(str(tmp_path / "e" / name))
        assert back.count() == df.count() and set(back.columns) <= set(df.columns)
    meta = {r["key"]: r["value"] for r in spark.read.schema("key string, value string").json(str(tmp_path / "e" / "metadata")).collect()}
    assert meta == {"model_type": "DecisionTree", "test_rows": "60", "note": None}


def test_curves_have_their_end_points(spark):
    pred = _predictions(spark)
    roc, pr = M.roc_curve(pred).collect(), M.pr_curve(pred).collect()
    assert [(r["tpr"], r["fpr"]) for r in roc if r["threshold"] == float("inf")] == [(0.0, 0.0)]
    assert [(r["precision"], r["recall"]) for r in pr if r["threshold"] is None] == [(1.0, 0.0)]
    assert len(roc) == len(pr) == 8
    none = pred.limit(0)
    assert M.roc_curve(none).count() == M.pr_curve(none).count() == 0


def test_summary_importance_and_rules(spark, tmp_path):
    pred, nodes = _predictions(spark), golden_model().nodes_df(spark)
    m, stats = M.summary_row(pred), H.tree_stats(nodes, 36)
    sections = {"performance": m, "impact": I.financial_impact(m), "complexity": stats, "readiness": I.deployment_readiness(m)}
    io.write_deployment_summary(sections, str(tmp_path / "s"))
    back = spark.read.json(str(tmp_path / "s"))
    assert back.count() == sum(len(df.columns) for df in sections.values())
    assert back.filter("section = 'complexity' AND metric = 'n_nodes'").first()["value"] == "33"
    imp = G.feature_importance(nodes, spark.createDataFrame(list(enumerate(FEATURES)), "feature_idx int, feature string"))
    io.write_importance_csv(imp, str(tmp_path / "i"))
    assert spark.read.option("header", "true").csv(str(tmp_path / "i")).first()["feature"] == "gender_Male"
    io.write_rules_text(H.rule_listing(nodes), str(tmp_path / "r"))
    assert [r["value"] for r in spark.read.text(str(tmp_path / "r")).collect()][0] == "|--- data_package_BIG90 <= 1.00"


def test_reports_read_one_row(spark):
    m = M.rates(spark.createDataFrame([(561, 136, 35, 143)], "tn long, fp long, fn long, tp long")).withColumn("roc_auc", F.lit(0.867))
    report = {(r["section"], r["metric"]): (r["value"], r["ok"]) for r in I.deployment_report(m).collect()}
    assert report[("status", "Deployment Status")] == ("APPROVED", True)
    assert report[("impact", "Net Value")] == ("40050.00", None)
    key = {(r["section"], r["metric"]): (r["value"], r["text"]) for r in I.key_metrics(m).collect()}
    assert key[("model_performance", "overall_grade")] == (None, "B+")
    assert key[("business_impact", "customers_to_target")] == (279.0, None)
    assert key[("deployment_readiness", "auc_threshold")] == (1.0, None)


def test_encoder_round_trip(spark, tmp_path):
    df = spark.range(40).select("id", (F.col("id") % 9).cast("double").alias("v"), F.element_at(F.array(F.lit("x"), F.lit("y")), (F.col("id") % 2 + 1).cast("int")).alias("c"),
                                (F.col("id") % 4 == 0).cast("int").alias("churn"))
    pm = Preprocessor(FrameSpec.infer(df)).fit(df)
    io.save_preprocessor(spark, pm, str(tmp_path / "p"))
    back = io.load_preprocessor(spark, str(tmp_path / "p"))
    assert sorted(map(tuple, back.transform(df).collect())) == sorted(map(tuple, pm.transform(df).collect()))
