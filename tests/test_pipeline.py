import numpy as np
import pytest
from pyspark.sql import functions as F

from churnspark.operators import metrics as M
from churnspark.operators.balance import knn, smote
from churnspark.operators.encode import Preprocessor
from churnspark.operators.split import stratified_folds, stratified_split, split_quotas
from churnspark.spec import FrameSpec


def test_quota_arithmetic():
    q = split_quotas({0: 3779 - 500, 1: 1092}, 0.2)
    assert sum(q.values()) == 875  # ceil(0.2 * 4371)
    assert split_quotas({0: 5, 1: 5}, 0.2) == {0: 1, 1: 1}


def test_split_exact_and_partition_independent(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 7 == 0).cast("int").alias("y"))
    a = stratified_split(df, "y", "id", 0.2, 42)
    b = stratified_split(df.repartition(13), "y", "id", 0.2, 42)
    ta = {r["id"] for r in a.filter("is_test").collect()}
    tb = {r["id"] for r in b.filter("is_test").collect()}
    assert ta == tb and len(ta) == 200
    per = {r[0]: r[1] for r in a.filter("is_test").groupBy("y").count().collect()}
    assert per == {0: 171, 1: 29}
    folds = stratified_folds(df, "y", "id", 5, 42).groupBy("fold", "y").count().collect()
    sizes = {}
    for r in folds:
        sizes.setdefault(r["y"], []).append(r["count"])
    assert all(max(v) - min(v) <= 1 for v in sizes.values())


def test_encoder(spark):
    df = spark.createDataFrame([(1, 1.0, "b", 0), (2, 2.0, "a", 1), (3, 4.0, "c", 0), (4, 10.0, "a", 1)],
                               "id long, x double, cat string, y int")
    spec = FrameSpec.infer(df)
    pm = Preprocessor(spec).fit(df)
    assert pm.feature_names == ["x", "cat_b", "cat_c"]
    assert pm.stds["x"] == pytest.approx(3.491060010942235)  # population std of 1,2,4,10
    new = spark.createDataFrame([(9, 4.25, "zzz", 0)], "id long, x double, cat string, y int")
    r = pm.transform(new).first()
    assert (r["x"], r["cat_b"], r["cat_c"]) == (0.0, 0.0, 0.0)  # mean maps to 0, unknown to zeros
    z = np.array([row["x"] for row in pm.transform(df).collect()])
    assert abs(z.mean()) < 1e-9 and abs(z.std() - 1) < 1e-8


def _points(spark, n=300, p=4, seed=3):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, p)), 3)
    rows = [(int(i), *map(float, x[i])) for i in range(n)]
    cols = [f"f{j}" for j in range(p)]
    return spark.createDataFrame(rows, "id long, " + ", ".join(f"{c} double" for c in cols)), x, cols


def test_knn_exact_against_brute_force(spark):
    df, x, cols = _points(spark)
    got = {}
    for r in knn(df, cols, 5, "id", rows_per_cell=16).collect():
        got.setdefault(r["id"], []).append((r["nbr_rank"], r["nbr_id"]))
    d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(-1))
    for i in range(len(x)):
        order = sorted((round(d[i, j], 9), j) for j in range(len(x)) if j != i)[:5]
        assert [j for _, j in order] == [j for _, j in sorted(got[i])]


def test_smote_parity_and_segments(spark):
    df, x, cols = _points(spark, n=200)
    lab = df.withColumn("label", (F.col("id") % 4 == 0).cast("int"))
    out = smote(lab, cols, "label", "id", 5, 42)
    counts = {r[0]: r[1] for r in out.groupBy("label").count().collect()}
    assert counts[0] == counts[1] == 150
    syn = out.filter("is_synthetic").collect()
    assert len(syn) == 100
    base = {int(i): x[i] for i in range(len(x))}
    minority = range(0, 200, 4)
    for r in syn[:20]:
        v, own = np.array([r[c] for c in cols]), base[r["id"]]
        # lies on the segment from its base row to one of that row's five nearest minority rows
        near = sorted((j for j in minority if j != r["id"]), key=lambda j: (round(np.linalg.norm(base[j] - own), 9), j))[:5]
        detours = [np.linalg.norm(v - own) + np.linalg.norm(base[j] - v) - np.linalg.norm(base[j] - own) for j in near]
        assert min(detours) == pytest.approx(0, abs=1e-9)


def test_smote_refuses_a_single_minority_row(spark):
    df, _, cols = _points(spark, n=20)
    with pytest.raises(ValueError, match="two rows"):
        smote(df.withColumn("label", (F.col("id") == 0).cast("int")), cols, "label", "id")


def test_auc_and_ap_against_brute_force(spark):
    rng = np.random.default_rng(1)
    y = rng.integers(0, 2, 400)
    s = np.round(rng.random(400) * 0.5 + y * 0.3, 2)  # ties on purpose
    pred = spark.createDataFrame([(i, int(y[i]), float(s[i]), int(s[i] > 0.5)) for i in range(400)],
                                 "id long, label int, p1 double, prediction int")
    got = M.auc_ap(pred).first()
    pos, neg = s[y == 1], s[y == 0]
    auc = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))
    assert got["roc_auc"] == pytest.approx(auc, abs=1e-6)
    ap, prev_r = 0.0, 0.0
    for t in sorted(set(s), reverse=True):
        tp = ((s >= t) & (y == 1)).sum()
        fp = ((s >= t) & (y == 0)).sum()
        r = tp / (y == 1).sum()
        ap += (r - prev_r) * tp / (tp + fp)
        prev_r = r
    assert got["average_precision"] == pytest.approx(ap, abs=1e-6)
    roc = M.roc_curve(pred).orderBy(F.desc("threshold")).collect()
    assert roc[-1]["tpr"] == 1.0 and roc[-1]["fpr"] == 1.0
