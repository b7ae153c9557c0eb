"""The recorded depth-5 tree (33 nodes, 17 leaves) rebuilt as a node table.

Structure and leaf class weights are the reference's recorded output
(fixed values); internal weights are the sums of their children.
"""
import pytest

from churnspark.operators import importance as G
from churnspark.operators import inspect as H
from churnspark.operators.tree import TreeModel, TreeParams, impurity

# (node_id, feature, threshold) of internal nodes, heap numbering; then leaf (node_id, w0, w1)
INTERNAL = [(1, "data_package_BIG90", 1.00), (2, "gender_Male", 1.00), (4, "gender_Male", 0.00),
            (8, "data_spending", -1.01), (16, "age", 0.56), (17, "data_spending", -0.46),
            (5, "data_package_DMAX100", 0.03), (10, "age", 0.37), (20, "data_package_D120", 0.02),
            (21, "district_Phu Vang", 0.98), (11, "age", 0.56), (22, "data_volume", 1.87),
            (23, "data_package_DMAX100", 0.87), (3, "age", 2.38), (6, "age", -1.83), (12, "voice_duration", -0.15)]
LEAVES = [(32, 0, 289), (33, 38, 48), (34, 381, 121), (35, 211, 622), (9, 0, 462), (40, 1260, 176),
          (41, 2, 151), (42, 274, 627), (43, 181, 44), (44, 0, 219), (45, 1, 4), (46, 0, 8), (47, 18, 1),
          (24, 2, 5), (25, 7, 0), (13, 408, 0), (7, 0, 6)]
NUMERIC = ["age", "month", "year", "data_volume", "data_spending", "sms_volume", "sms_spending",
           "voice_duration", "voice_spending"]
FEATURES = NUMERIC + ["gender_Male", "district_Phu Loc", "district_Phu Nhuan", "district_Phu Vang",
                      "district_Vinh hoi"] + ["data_package_BIG90", "data_package_D120", "data_package_DMAX100"] + [
                          f"data_package_other{i}" for i in range(19)]


def golden_model() -> TreeModel:
    w = {nid: (a, b) for nid, a, b in LEAVES}
    internal = {nid: (f, t) for nid, f, t in INTERNAL}

    def fill(nid):
        if nid in w:
            return w[nid]
        l, r = fill(2 * nid), fill(2 * nid + 1)
        w[nid] = (l[0] + r[0], l[1] + r[1])
        return w[nid]
    fill(1)
    nodes = []
    for nid, (w0, w1) in w.items():
        depth = nid.bit_length() - 1
        leaf = nid not in internal
        dec = 0.0
        if not leaf:
            (l0, l1), (r0, r1) = w[2 * nid], w[2 * nid + 1]
            dec = (w0 + w1) * impurity(w0, w1, "entropy") - (l0 + l1) * impurity(l0, l1, "entropy") - (
                r0 + r1) * impurity(r0, r1, "entropy")
        f, t = internal.get(nid, (None, None))
        nodes.append({"model_id": 0, "node_id": nid, "parent_id": nid // 2 if nid > 1 else None, "depth": depth,
                      "side": "root" if nid == 1 else ("left" if nid % 2 == 0 else "right"),
                      "feature_idx": FEATURES.index(f) if f else None, "feature": f, "threshold": t,
                      "n": int(w0 + w1), "w0": float(w0), "w1": float(w1), "impurity": impurity(w0, w1, "entropy"),
                      "decrease": dec, "prediction": int(w1 / (w0 + w1) > 0.5), "p1": w1 / (w0 + w1), "is_leaf": leaf})
    return TreeModel(FEATURES, TreeParams(), nodes)


@pytest.fixture(scope="module")
def nodes(spark):
    return golden_model().nodes_df(spark)


def test_stats(spark, nodes):
    st = H.tree_stats(nodes, 36).first()
    assert (st["max_depth"], st["n_nodes"], st["n_leaves"], st["n_features_used"], st["total_features"]) == (5, 33, 17, 9, 36)
    root = nodes.filter("node_id = 1").first()
    assert (root["w0"], root["w1"]) == (2783.0, 2783.0)
    dd = {r["depth"]: r["nodes"] for r in H.depth_distribution(nodes).collect()}
    assert sum(dd.values()) == 33 and dd[0] == 1


def test_importances_match_recorded(spark, nodes):
    dic = spark.createDataFrame(list(enumerate(FEATURES)), "feature_idx int, feature string")
    imp = {r["feature"]: r["importance"] for r in G.feature_importance(nodes, dic).collect()}
    recorded = {"gender_Male": 0.222630002821875, "age": 0.2009940164239212, "data_package_D120": 0.14362941945938845,
                "data_package_BIG90": 0.14292955493842766, "data_spending": 0.13861921945904848,
                "data_package_DMAX100": 0.09448171998671238, "district_Phu Vang": 0.05188382571185587,
                "voice_duration": 0.0026973167858241327, "data_volume": 0.0021349244129468072}
    for f, v in recorded.items():
        assert imp[f] == pytest.approx(v, abs=1e-6)
    assert imp["month"] == 0.0
    util = G.utilisation(G.feature_importance(nodes, dic)).first()
    assert (util["used_features"], util["unused_features"]) == (9, 27)
    sel = G.cumulative_selection(G.feature_importance(nodes, dic), 0.95).count()
    assert sel == 7


def test_important_paths(spark, nodes):
    ip = H.important_paths(nodes).orderBy("rank").collect()
    got = [(r["samples"], round(r["confidence"], 4), r["prediction"]) for r in ip]
    assert got == [(1436, 0.8774, "No Churn"), (901, 0.6959, "Churn"), (833, 0.7467, "Churn"),
                   (502, 0.759, "No Churn"), (462, 1.0, "Churn"), (408, 1.0, "No Churn"), (289, 1.0, "Churn")]
    p289 = [r for r in ip if r["samples"] == 289][0]
    assert p289["rules"] == ["data_package_BIG90 <= 1.000", "gender_Male <= 1.000", "gender_Male <= 0.000",
                             "data_spending <= -1.010", "age <= 0.560"]
    risk = H.insights(nodes).filter("kind = 'high_risk_segment'").count()
    assert risk == 3  # 462, 289 (conf 1.0) and 833 (0.7467); 901 has 0.6959


def test_rule_listing_and_edges(spark, nodes):
    lines = [r["text"] for r in H.rule_listing(nodes).orderBy("line_no").collect()]
    assert lines[0] == "|--- data_package_BIG90 <= 1.00"
    assert lines[1] == "|   |--- gender_Male <= 1.00"
    assert lines[5] == "|   |   |   |   |   |--- weights: [0.00, 289.00] class: Churn"
    assert lines[-1] == "|   |   |--- weights: [0.00, 6.00] class: Churn"
    assert len(lines) == 32 + 17
    e = H.edges(nodes)
    assert e.count() == 32 and e.filter("branch").count() == 16
    assert H.depth_limited(nodes, 2).filter("truncated").count() == 3


def test_model_io_roundtrip(spark, tmp_path):
    m = golden_model()
    m.save(spark, str(tmp_path / "m"))
    back = TreeModel.load(spark, str(tmp_path / "m"))
    assert len(back.nodes) == 33 and back.features == FEATURES
