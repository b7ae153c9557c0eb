"""Business impact, ratings and deployment verdicts.

All inputs are one-row tables (a confusion row, a metrics row); outputs are
one-row or long-form tables of built-in ``when`` expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnspark.functions.exprs import safe_div

# Fixed values that must equal the reference's rules.
# Financial defaults: cost of a lost customer 500, cost of one retention campaign 50.
# Rating bands (AUC and accuracy): >= 0.9 Excellent, >= 0.8 Good, >= 0.7 Fair, else Poor.
# Grade bands on the mean score: >= 4.5 A, >= 3.5 B+, >= 2.5 B, >= 1.5 C, else D.
# Evaluation verdict: mean score >= 3.5 APPROVED, >= 2.5 CONDITIONAL, else NOT RECOMMENDED.
# Readiness: accuracy >= 0.75 and AUC >= 0.8 and grade in (A, B+, B) -> APPROVED;
#            else accuracy >= 0.7 and AUC >= 0.75 -> CONDITIONAL; else NOT READY.
LOSS_PER_CUSTOMER = 500.0
CAMPAIGN_COST = 50.0
RATING_BANDS = [(0.9, "Excellent"), (0.8, "Good"), (0.7, "Fair")]
GRADE_BANDS = [(4.5, "A"), (3.5, "B+"), (2.5, "B"), (1.5, "C")]
ACCEPTABLE_GRADES = ["A", "B+", "B"]


def _campaign_columns() -> dict[str, Column]:
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    total, actual, predicted = tn + fp + fn + tp, tp + fn, tp + fp
    return {
        "total_customers": total, "actual_churners": actual, "predicted_churners": predicted,
        "correctly_identified": tp, "missed_churners": fn, "false_alarms": fp,
        "churn_rate": safe_div(actual.cast("double"), total),
        "identification_rate": safe_div(tp.cast("double"), actual),
        "false_alarm_rate": safe_div(fp.cast("double"), predicted)}


def _financial_columns(loss: float, campaign: float) -> dict[str, Column]:
    fp, fn, tp = (F.col(c).cast("double") for c in ("fp", "fn", "tp"))
    saved, cost, lost = tp * loss, (tp + fp) * campaign, fn * loss
    net = saved - cost - lost
    return {
        "cost_per_lost_customer": F.lit(float(loss)), "cost_per_retention_campaign": F.lit(float(campaign)),
        "value_saved": saved, "campaign_cost": cost, "lost_value": lost, "net_value": net, "roi": safe_div(net, cost)}


def _named(columns: dict[str, Column]) -> list[Column]:
    return [c.alias(name) for name, c in columns.items()]


def campaign_counts(cm: DataFrame) -> DataFrame:
    """Customers, actual / predicted churners, hits, misses, false alarms, three rates."""
    return cm.select(*_named(_campaign_columns()))


def financial_impact(cm: DataFrame, loss: float = LOSS_PER_CUSTOMER,
                     campaign: float = CAMPAIGN_COST) -> DataFrame:
    """saved = tp*loss, cost = (tp+fp)*campaign, lost = fn*loss, net, ROI = net/cost."""
    return cm.select(*_named(_financial_columns(loss, campaign)))


def rating(c: Column) -> Column:
    """Excellent / Good / Fair / Poor."""
    out = F.lit("Poor")
    for edge, name in reversed(RATING_BANDS):
        out = F.when(c >= edge, F.lit(name)).otherwise(out)
    return out


def _clamp_int(c: Column) -> Column:
    return F.least(F.lit(5), F.greatest(F.lit(1), c.cast("int")))  # cast truncates toward zero


def _rating_columns(acc: Column, a: Column) -> dict[str, Column]:
    auc_score = _clamp_int((a - 0.5) * 10)
    acc_score = _clamp_int(acc * 5)
    score = (auc_score + acc_score) / 2.0
    grade = F.lit("D")
    for edge, name in reversed(GRADE_BANDS):
        grade = F.when(score >= edge, F.lit(name)).otherwise(grade)
    verdict = (F.when(score >= 3.5, F.lit("APPROVED"))
               .when(score >= 2.5, F.lit("CONDITIONAL")).otherwise(F.lit("NOT RECOMMENDED")))
    return {"auc_rating": rating(a), "accuracy_rating": rating(acc), "auc_score": auc_score,
            "accuracy_score": acc_score, "overall_score": score, "overall_grade": grade, "verdict": verdict}


def _readiness_columns(acc: Column, auc: Column, grade: Column) -> dict[str, Column]:
    acc_ok, auc_ok, grade_ok = acc >= 0.75, auc >= 0.8, grade.isin(ACCEPTABLE_GRADES)
    status = (F.when(acc_ok & auc_ok & grade_ok, F.lit("APPROVED"))
              .when((acc >= 0.7) & (auc >= 0.75), F.lit("CONDITIONAL")).otherwise(F.lit("NOT READY")))
    # Recommendation sentences: fixed values that must equal the reference's.
    recommendation = (F.when(status == "APPROVED", F.lit("Model is ready for production deployment"))
                      .when(status == "CONDITIONAL", F.lit("Model can be deployed with close monitoring"))
                      .otherwise(F.lit("Model needs improvement before deployment")))
    return {"status": status, "recommendation": recommendation, "accuracy_threshold": acc_ok,
            "auc_threshold": auc_ok, "grade_acceptable": grade_ok}


def performance_rating(m: DataFrame, accuracy: str = "accuracy", auc: str = "roc_auc") -> DataFrame:
    """Ratings, integer scores, mean score, grade and evaluation verdict."""
    return m.select(*_named(_rating_columns(F.col(accuracy), F.col(auc))))


def deployment_readiness(m: DataFrame, grade: DataFrame | None = None) -> DataFrame:
    """Status and the three criteria flags. ``m`` has accuracy and roc_auc;
    the grade is derived as in :func:`performance_rating` unless given."""
    acc, auc = F.col("accuracy"), F.col("roc_auc")
    given = _rating_columns(acc, auc)["overall_grade"] if grade is None else grade.select("overall_grade").scalar()
    return m.select(*_named(_readiness_columns(acc, auc, given)))


def _with_stats(m: DataFrame, tree_stats: DataFrame | None) -> DataFrame:
    """The metrics row with the tree statistics (NULL without them) as the struct ``tree``."""
    fields = ("max_depth", "n_nodes", "n_features_used", "total_features")
    if tree_stats is None:
        return m.withColumn("tree", F.struct(*[F.lit(None).cast("long").alias(k) for k in fields]))
    return m.withColumn("tree", tree_stats.select(F.struct(*[F.col(k).cast("long").alias(k) for k in fields])).scalar())


def key_metrics(m: DataFrame, tree_stats: DataFrame | None = None, loss: float = LOSS_PER_CUSTOMER,
                campaign: float = CAMPAIGN_COST) -> DataFrame:
    """Long-form ``(section, metric, value, text)`` from one metrics row (with its confusion cells).

    Numbers stand in ``value`` (flags as 0 / 1; missing: 0), the grade, status and recommendation in ``text``."""
    acc, auc = F.col("accuracy"), F.col("roc_auc")
    fin, camp, rated = _financial_columns(loss, campaign), _campaign_columns(), _rating_columns(acc, auc)
    ready = _readiness_columns(acc, auc, rated["overall_grade"])

    def row(section: str, metric: str, value: Column | None = None, text: Column | None = None) -> Column:
        number = F.lit(None).cast("double") if value is None else F.coalesce(value.cast("double"), F.lit(0.0))
        words = F.lit(None).cast("string") if text is None else text
        return F.struct(F.lit(section).alias("section"), F.lit(metric).alias("metric"), number.alias("value"), words.alias("text"))

    rows = [row("model_performance", k, F.col(k)) for k in ("accuracy", "precision", "recall", "f1", "roc_auc")]
    rows += [row("model_performance", "overall_grade", text=rated["overall_grade"]),
             row("business_impact", "net_value", fin["net_value"]),
             row("business_impact", "roi_percentage", fin["roi"] * 100),
             row("business_impact", "customers_at_risk", camp["actual_churners"]),
             row("business_impact", "customers_to_target", camp["predicted_churners"])]
    if tree_stats is not None:
        rows += [row("model_complexity", k, F.col(f"tree.{k}")) for k in ("max_depth", "n_nodes", "n_features_used", "total_features")]
    rows += [row("deployment_readiness", k, text=ready[k]) for k in ("status", "recommendation")]
    rows += [row("deployment_readiness", k, ready[k]) for k in ("accuracy_threshold", "auc_threshold", "grade_acceptable")]
    return _with_stats(m, tree_stats).select(F.inline(F.array(*rows)))


def strengths_weaknesses(m: DataFrame) -> DataFrame:
    """I8: ``(kind, label, value)`` rows for recall, AUC, accuracy, precision and FPR."""
    rec, auc, acc, prec = (F.col(c) for c in ("recall", "roc_auc", "accuracy", "precision"))
    def row(kind, label, value):
        return F.struct(F.lit(kind).alias("kind"), label.alias("label"), value.cast("double").alias("value"))
    arr = F.array(
        row("strength", F.when(rec > 0.75, F.lit("High Recall")).otherwise(F.lit("Moderate Recall")), rec),
        row("strength", F.when(auc > 0.8, F.lit("Good AUC")).otherwise(F.lit("Fair AUC")), auc),
        row("strength", F.when(acc > 0.8, F.lit("Good Accuracy")).otherwise(F.lit("Moderate Accuracy")), acc),
        row("weakness", F.when(prec < 0.6, F.lit("Low Precision")).otherwise(F.lit("Good Precision")), prec),
        row("weakness", F.lit("False Positive Rate"), F.col("fpr")),
    )
    out = m.select(F.inline(arr))
    return out.select("kind", "label", F.col("value").alias("value"))


def deployment_report(m: DataFrame, tree_stats: DataFrame | None = None, loss: float = LOSS_PER_CUSTOMER,
                      campaign: float = CAMPAIGN_COST) -> DataFrame:
    """``(section, metric, value, ok)``: status, performance, impact, complexity and the criteria;
    grade, accuracy, AUC and the criteria carry a flag."""
    acc, auc = F.col("accuracy"), F.col("roc_auc")
    fin, camp, rated = _financial_columns(loss, campaign), _campaign_columns(), _rating_columns(acc, auc)
    ready = _readiness_columns(acc, auc, rated["overall_grade"])

    def row(section: str, metric: str, value: Column, ok: Column | None = None) -> Column:
        flag = F.lit(None).cast("boolean") if ok is None else ok
        return F.struct(F.lit(section).alias("section"), F.lit(metric).alias("metric"), value.cast("string").alias("value"), flag.alias("ok"))

    def number(c: Column, digits: int) -> Column:
        return F.format_string(f"%.{digits}f", c.cast("double"))

    rows = [
        row("status", "Deployment Status", ready["status"], ready["status"] == "APPROVED"),
        row("status", "Recommendation", ready["recommendation"]),
        row("performance", "Overall Grade", rated["overall_grade"], ready["grade_acceptable"]),
        row("performance", "Accuracy", number(acc, 6), ready["accuracy_threshold"]),
        row("performance", "ROC AUC", number(auc, 6), ready["auc_threshold"]),
        row("performance", "Precision", number(F.col("precision"), 6)),
        row("performance", "Recall", number(F.col("recall"), 6)),
        row("performance", "F1-Score", number(F.col("f1"), 6)),
        row("impact", "Net Value", number(fin["net_value"], 2)),
        row("impact", "ROI Percent", number(fin["roi"] * 100, 4)),
        row("impact", "Customers at Risk", camp["actual_churners"]),
        row("impact", "Target for Campaigns", camp["predicted_churners"])]
    if tree_stats is not None:
        rows += [row("complexity", "Tree Depth", F.col("tree.max_depth")), row("complexity", "Total Nodes", F.col("tree.n_nodes")),
                 row("complexity", "Features Used", F.col("tree.n_features_used")),
                 row("complexity", "Total Features", F.col("tree.total_features"))]
    rows += [row("criteria", k, ready[k], ready[k]) for k in ("accuracy_threshold", "auc_threshold", "grade_acceptable")]
    return _with_stats(m, tree_stats).select(F.inline(F.array(*rows)))
