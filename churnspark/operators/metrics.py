"""Binary-classifier evaluation on a predictions table.

Input: ``(id, label, p1, prediction)`` with label/prediction in {0, 1}.
Curves aggregate by distinct score first (a tree has at most one score per
leaf) and take running totals inside score buckets plus per-bucket offsets,
so no window ever holds more than one bucket -- also for continuous scores.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnspark.functions.exprs import safe_div


def confusion(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """G1: one row ``(tn, fp, fn, tp)``; positive class is 1."""
    y, p = F.col(label), F.col(prediction)
    return pred.agg(
        F.count_if((y == 0) & (p == 0)).alias("tn"), F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 1) & (p == 1)).alias("tp"))


def rates(cm: DataFrame) -> DataFrame:
    """G2 / G3 from a confusion row; every ratio is 0 on an empty denominator."""
    tn, fp, fn, tp = (F.col(c).cast("double") for c in ("tn", "fp", "fn", "tp"))
    precision = safe_div(tp, tp + fp)
    recall = safe_div(tp, tp + fn)
    return cm.select(
        "tn", "fp", "fn", "tp",
        safe_div(tp + tn, tn + fp + fn + tp).alias("accuracy"),
        precision.alias("precision"),
        recall.alias("recall"),
        safe_div(2 * tp, 2 * tp + fp + fn).alias("f1"),
        safe_div(tn, tn + fp).alias("specificity"),
        recall.alias("sensitivity"),
        safe_div(fp, fp + tn).alias("fpr"),
        safe_div(fn, fn + tp).alias("fnr"),
    )


def _score_counts(pred: DataFrame, label: str, score: str) -> DataFrame:
    return pred.groupBy(F.col(score).cast("double").alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg"))


def running_counts(pred: DataFrame, label: str = "label", score: str = "p1",
                   buckets: int = 256) -> DataFrame:
    """Per distinct score, descending: ``pos, neg`` at the score and cumulative
    ``tp, fp`` of all rows scoring at least that much."""
    counts = _score_counts(pred, label, score).persist()
    edges = counts.agg(F.percentile_approx("score", [i / buckets for i in range(1, buckets)], 10000)).first()[0]
    edges = sorted(set(e for e in (edges or []) if e is not None))
    bucket: Column = F.lit(0)
    for e in edges:  # ascending bucket index; few edges, evaluated on distinct scores only
        bucket = bucket + F.when(F.col("score") > F.lit(e), 1).otherwise(0)
    tagged = counts.withColumn("bucket", bucket)
    totals = sorted((r["bucket"], r["p"], r["n"]) for r in
                    tagged.groupBy("bucket").agg(F.sum("pos").alias("p"), F.sum("neg").alias("n")).collect())
    off_p, off_n, acc_p, acc_n = {}, {}, 0, 0
    for b, p, n in reversed(totals):  # higher buckets come first in descending order
        off_p[b], off_n[b] = acc_p, acc_n
        acc_p += p
        acc_n += n
    def lookup(d):
        if not d:
            return F.lit(0)
        return F.element_at(F.create_map(*[x for k, v in d.items() for x in (F.lit(k), F.lit(v))]), F.col("bucket"))
    w = Window.partitionBy("bucket").orderBy(F.col("score").desc()).rowsBetween(Window.unboundedPreceding, 0)
    out = (tagged.withColumn("tp", F.sum("pos").over(w) + lookup(off_p))
           .withColumn("fp", F.sum("neg").over(w) + lookup(off_n)))
    return out.select("score", "pos", "neg", F.col("tp").cast("long").alias("tp"), F.col("fp").cast("long").alias("fp"))


def roc_curve(pred: DataFrame, label: str = "label", score: str = "p1", rc: DataFrame | None = None) -> DataFrame:
    """``(threshold, tp, fp, tpr, fpr)`` one row per distinct score (all points kept), after the
    start point (0, 0) at an infinite threshold; no rows without predictions."""
    rc = running_counts(pred, label, score) if rc is None else rc
    P, N = rc.agg(F.sum("pos")).scalar(), rc.agg(F.sum("neg")).scalar()  # scalar subqueries
    points = rc.select(
        F.col("score").alias("threshold"), "tp", "fp",
        safe_div(F.col("tp"), P).alias("tpr"),
        safe_div(F.col("fp"), N).alias("fpr"))
    start = _if_any(rc).select(F.lit(float("inf")).alias("threshold"), F.lit(0).cast("long").alias("tp"),
                               F.lit(0).cast("long").alias("fp"), F.lit(0.0).alias("tpr"), F.lit(0.0).alias("fpr"))
    return points.unionByName(start)


def _if_any(rc: DataFrame) -> DataFrame:
    """One row if there are any points."""
    return rc.agg(F.count(F.lit(1)).alias("points")).filter("points > 0")


def pr_curve(pred: DataFrame, label: str = "label", score: str = "p1", rc: DataFrame | None = None) -> DataFrame:
    """``(threshold, precision, recall)`` per distinct score, and the end point
    (recall 0, precision 1), which has no threshold; no rows without predictions."""
    rc = running_counts(pred, label, score) if rc is None else rc
    P = rc.agg(F.sum("pos")).scalar()
    points = rc.select(
        F.col("score").alias("threshold"),
        safe_div(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        safe_div(F.col("tp"), P).alias("recall"))
    end = _if_any(rc).select(F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    return points.unionByName(end)


def auc_ap(pred: DataFrame, label: str = "label", score: str = "p1", rc: DataFrame | None = None) -> DataFrame:
    """One row ``(roc_auc, average_precision)``.

    AUC is the trapezoid area: sum over scores of ``neg * (tp_above + pos/2)``
    over ``P*N``; AP is ``sum(pos/P * precision)`` (step sum, not trapezoid).
    Both are plain sums over the running-count rows. NULL when a class is absent.
    """
    rc = running_counts(pred, label, score) if rc is None else rc
    agg = rc.agg(
        F.sum(F.col("pos")).alias("P"), F.sum(F.col("neg")).alias("N"),
        F.sum(F.col("neg").cast("double") * ((F.col("tp") - F.col("pos")) + F.col("pos") / 2.0)).alias("area"),
        F.sum(F.col("pos").cast("double") * (F.col("tp") / (F.col("tp") + F.col("fp")))).alias("ap"))
    valid = (F.col("P") > 0) & (F.col("N") > 0)
    return agg.select(
        F.when(valid, F.col("area") / (F.col("P") * F.col("N"))).alias("roc_auc"),
        F.when(F.col("P") > 0, F.col("ap") / F.col("P")).alias("average_precision"))


def classification_report(cm: DataFrame) -> DataFrame:
    """Per-class precision / recall / f1 / support, then macro and weighted averages."""
    tn, fp, fn, tp = (F.col(c).cast("double") for c in ("tn", "fp", "fn", "tp"))
    p1, r1 = safe_div(tp, tp + fp), safe_div(tp, tp + fn)
    p0, r0 = safe_div(tn, tn + fn), safe_div(tn, tn + fp)
    f1_1, f1_0 = safe_div(2 * tp, 2 * tp + fp + fn), safe_div(2 * tn, 2 * tn + fn + fp)
    s0, s1 = tn + fp, tp + fn
    n = s0 + s1
    def row(name, p, r, f, sup):
        return F.struct(F.lit(name).alias("class"), p.alias("precision"), r.alias("recall"),
                        f.alias("f1"), sup.alias("support"))
    acc = safe_div(tp + tn, n)
    rows = F.array(
        row("0", p0, r0, f1_0, s0),
        row("1", p1, r1, f1_1, s1),
        row("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f1_0 + f1_1) / 2, n),
        row("weighted avg", safe_div(p0 * s0 + p1 * s1, n), safe_div(r0 * s0 + r1 * s1, n),
            safe_div(f1_0 * s0 + f1_1 * s1, n), n),
        row("accuracy", acc, acc, acc, n),
    )
    out = cm.select(F.inline(rows))
    return out.select("class", *[F.col(c).alias(c) for c in ("precision", "recall", "f1")],
                      F.col("support").cast("long").alias("support"))


def evaluate(pred: DataFrame, label: str = "label", score: str = "p1",
             prediction: str = "prediction") -> dict[str, DataFrame]:
    """The evaluation bundle; the curves share one pass of running counts (``rc`` given by it is cached and small:
    a row per distinct score). With one class only, AUC is NULL."""
    cm, rc = confusion(pred, label, prediction), running_counts(pred, label, score).persist()
    return {"confusion": cm, "rates": rates(cm), "report": classification_report(cm),
            "roc": roc_curve(pred, label, score, rc), "pr": pr_curve(pred, label, score, rc),
            "auc": auc_ap(pred, label, score, rc)}


def summary_row(pred: DataFrame, label: str = "label", score: str = "p1",
                prediction: str = "prediction") -> DataFrame:
    """Accuracy, precision, recall, f1, roc_auc, average_precision and the confusion cells in one row."""
    r = rates(confusion(pred, label, prediction))
    areas = auc_ap(pred, label, score).select(F.struct("roc_auc", "average_precision")).scalar()
    return r.select("*", areas.alias("areas")).select(*r.columns, "areas.roc_auc", "areas.average_precision")


def compare_models(metrics: DataFrame, baseline: str, candidate: str) -> DataFrame:
    """Deltas of a candidate model against a baseline, from a long
    ``(model_id, accuracy, roc_auc, n_features)`` table (one aggregation, no join)."""
    def pick(model: str, c: str) -> Column:
        return F.max(F.when(F.col("model_id") == model, F.col(c)))
    wide = metrics.agg(pick(baseline, "accuracy").alias("b_acc"), pick(baseline, "roc_auc").alias("b_auc"),
                       pick(baseline, "n_features").alias("b_nf"), pick(candidate, "accuracy").alias("c_acc"),
                       pick(candidate, "roc_auc").alias("c_auc"), pick(candidate, "n_features").alias("c_nf"))
    return wide.select(
        F.lit(baseline).alias("baseline"), F.lit(candidate).alias("candidate"),
        (F.col("c_acc") - F.col("b_acc")).alias("accuracy_delta"),
        (F.col("c_auc") - F.col("b_auc")).alias("auc_delta"),
        (F.col("b_nf") - F.col("c_nf")).alias("features_removed"),
        safe_div(F.col("b_nf") - F.col("c_nf"), F.col("b_nf")).alias("feature_reduction"))
