"""SQL twins of the queries on the depth-5 tree (grown on the SMOTE-resampled train split) and on single operators.

The tree is grown anew in SQL, level by level, on the rows that the SMOTE twin
makes; paths, reports and scores are then read off its ``nodes``.
"""

from __future__ import annotations

import re

from churnspark.plans.oracle import (CAT, CONFUSION, ENC, FRAME, IMPORTANCE, KNN, MIN_LEAF, MIN_SPLIT, NUM, RULE_PRED, RUNNING, SCORES, SEED,
                                     SMOTE, SPLIT, TREE_ALL, _bounds, _md5_prefix, _paths_sql, clean_ctes, r6, tree_levels, with_)

DEPTH = 5
IMPORTANT_SHARE = 0.05
KEYWORDS = ("spend", "quantity", "order", "nation", "segment")

RESAMPLED = """
tenc AS MATERIALIZED (
  SELECT id * 1000000 AS id, label, feature_idx AS fidx, value FROM realr
  UNION ALL SELECT id * 1000000 + syn + 1, label, feature_idx, value FROM synth),
fnames AS MATERIALIZED (SELECT DISTINCT fidx, feature FROM enc WHERE NOT is_test),
trows AS MATERIALIZED (SELECT DISTINCT id, label FROM tenc),
wts AS (SELECT label, CAST((SELECT count(*) FROM trows) AS DOUBLE) / (2 * count(*)) AS w FROM trows GROUP BY label),
cw AS MATERIALIZED (SELECT max(CASE WHEN label = 0 THEN w END) AS c0, max(CASE WHEN label = 1 THEN w END) AS c1 FROM wts)"""


def materialised(sql: str) -> str:
    """Keep the level tables of a tree: each is read by several later ones."""
    for lv in range(DEPTH + 1):
        for name in (f"r{lv}", f"ns{lv}", f"bs{lv}"):
            sql = sql.replace(f"{name} AS (", f"{name} AS MATERIALIZED (", 1)
    return sql.replace("nodes AS (", "nodes AS MATERIALIZED (", 1)


BLOCKS = (FRAME, clean_ctes(), SPLIT, ENC.replace("enc AS (", "enc AS MATERIALIZED (", 1), KNN.replace("knn AS (", "knn AS MATERIALIZED (", 1),
          SMOTE, RESAMPLED, materialised(tree_levels(DEPTH)))
TREE5 = with_(*BLOCKS)

# The frame of every customer, encoded by the moments and categories of the train split.
EVERYONE = ("fenc AS MATERIALIZED (" + " UNION ALL ".join(
    [f"SELECT s.id, m.fidx, COALESCE(ROUND((CAST(s.{c} AS DOUBLE) - m.mu) / (CASE WHEN m.sd IS NULL OR m.sd = 0 THEN 1.0 ELSE m.sd END), 9), 0.0) "
     f"AS value FROM frame s, mom m WHERE m.feature = '{c}'" for c in NUM]
    + ["SELECT s.id, f.fidx, CASE WHEN " + " OR ".join(f"(f.cpos = {j} AND CAST(s.{c} AS VARCHAR) = f.v)" for j, c in enumerate(CAT))
       + " THEN 1.0 ELSE 0.0 END AS value FROM frame s, ohf f"]) + ")")


def walk(rows: str, enc: str) -> str:
    """CTEs ``w0 .. w5``: the node that each row of ``rows`` (id) has reached after so many steps."""
    parts = [f"w0 AS (SELECT id, CAST(1 AS BIGINT) AS node FROM {rows})"]
    for lv in range(DEPTH):
        parts.append(f"""w{lv + 1} AS MATERIALIZED (
  SELECT w.id, CASE WHEN b.node IS NULL THEN w.node WHEN e.value <= b.thr THEN 2 * w.node ELSE 2 * w.node + 1 END AS node
  FROM w{lv} w LEFT JOIN allbs b ON b.node = w.node LEFT JOIN {enc} e ON e.id = w.id AND e.fidx = b.fidx)""")
    return ",\n".join(parts)


TEST_PRED = "te AS (SELECT DISTINCT id, label FROM enc WHERE is_test),\n" + walk("te", "enc") + """,
pred AS (SELECT te.id, te.label, n.p1, n.prediction FROM te JOIN w5 USING (id) JOIN nodes n ON n.node_id = w5.node)"""

UNUSABLE = " OR ".join(f"f.{c} IS NULL" for c in [*NUM, *CAT])
SCORED = EVERYONE + ",\n" + walk("frame", "fenc") + f""",
scored AS (SELECT f.id, CASE WHEN {UNUSABLE} THEN 0.5 ELSE 1 - (1 - n.p1) END AS p1, ({UNUSABLE}) AS is_fallback
           FROM frame f JOIN w5 ON w5.id = f.id JOIN nodes n ON n.node_id = w5.node),
tiers AS (SELECT id, p1, is_fallback, CASE WHEN p1 > 0.5 THEN 'Likely to Churn' ELSE 'Likely to Stay' END AS decision,
                 CASE WHEN p1 > 0.7 THEN 'High' WHEN p1 > 0.4 THEN 'Medium' ELSE 'Low' END AS risk_tier FROM scored)"""

# The reports decide on raw rates.
RAW_RATES = """
mt AS (SELECT tn, fp, fn, tp,
  CASE WHEN tn + fp + fn + tp = 0 THEN 0.0 ELSE CAST(tp + tn AS DOUBLE) / (tn + fp + fn + tp) END AS accuracy,
  CASE WHEN tp + fp = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fp) END AS precision,
  CASE WHEN tp + fn = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fn) END AS recall,
  CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn) END AS f1,
  CASE WHEN fp + tn = 0 THEN 0.0 ELSE CAST(fp AS DOUBLE) / (fp + tn) END AS fpr,
  (SELECT CASE WHEN sum(pos) > 0 AND sum(neg) > 0
               THEN sum(CAST(neg AS DOUBLE) * ((tp - pos) + pos / 2.0)) / (CAST(sum(pos) AS DOUBLE) * sum(neg)) END FROM rc) AS roc_auc
  FROM cm)"""

STATS = """
st AS (SELECT max(depth) AS max_depth, count(*) AS n_nodes, count(*) FILTER (WHERE is_leaf) AS n_leaves,
              (SELECT count(DISTINCT feature_idx) FROM dec WHERE decrease > 0) AS n_features_used,
              (SELECT count(*) FROM fnames) AS total_features FROM nodes)"""

VERDICT = """
vd AS (SELECT gr2.*, mt.tn, mt.fp AS fp_, mt.fn, mt.tp,
         CASE WHEN gr2.accuracy >= 0.75 AND gr2.roc_auc >= 0.8 AND overall_grade IN ('A', 'B+', 'B') THEN 'APPROVED'
              WHEN gr2.accuracy >= 0.7 AND gr2.roc_auc >= 0.75 THEN 'CONDITIONAL' ELSE 'NOT READY' END AS status,
         gr2.accuracy >= 0.75 AS a_ok, gr2.roc_auc >= 0.8 AS u_ok, overall_grade IN ('A', 'B+', 'B') AS g_ok,
         mt.tp * 500.0 - (mt.tp + mt.fp) * 50.0 - mt.fn * 500.0 AS net, (mt.tp + mt.fp) * 50.0 AS cost
       FROM gr2, mt),
ve AS (SELECT vd.*, CASE WHEN cost = 0 THEN 0.0 ELSE net / cost END AS roi,
         CASE status WHEN 'APPROVED' THEN 'Model is ready for production deployment'
                     WHEN 'CONDITIONAL' THEN 'Model can be deployed with close monitoring'
                     ELSE 'Model needs improvement before deployment' END AS recommendation FROM vd)"""


def _paths() -> str:
    return _paths_sql() + f""",
full_paths AS (SELECT lv.node_id AS leaf_id, lv.seq, COALESCE(p.path, '') AS path, lv.n AS samples, lv.n / (SELECT n FROM nodes WHERE node_id = 1) AS share,
                      CASE WHEN lv.prediction = 1 THEN 'Churn' ELSE 'No Churn' END AS prediction, GREATEST(lv.p1, 1 - lv.p1) AS confidence,
                      lv.node_id << CAST((SELECT max(depth) FROM nodes) - lv.depth AS BIGINT) AS dfs
               FROM leaves lv LEFT JOIN pth p ON p.leaf = lv.node_id),
ip AS (SELECT *, row_number() OVER (ORDER BY samples DESC, dfs) AS rank FROM full_paths WHERE share > {IMPORTANT_SHARE})"""


def _insights() -> str:
    named = " OR ".join(f"contains(lower(rule), '{k}')" for k in KEYWORDS)
    return f""",
keyed AS (SELECT leaf, rule, row_number() OVER (PARTITION BY leaf ORDER BY d) AS k FROM rl WHERE {named}),
kr AS (SELECT leaf, string_agg(rule, ', ' ORDER BY k) AS key_rules FROM keyed WHERE k <= 2 GROUP BY leaf),
pos AS (SELECT ip.*, row_number() OVER (PARTITION BY prediction ORDER BY dfs) AS pos FROM ip)
SELECT CASE WHEN prediction = 'Churn' THEN 'churn_factor' ELSE 'retention_factor' END AS kind, CAST(seq AS BIGINT) AS leaf_id,
       {r6('share')} AS share, {r6('confidence')} AS confidence, key_rules
FROM pos JOIN kr ON kr.leaf = pos.leaf_id WHERE pos <= 3
UNION ALL SELECT 'high_risk_segment', CAST(seq AS BIGINT), {r6('share')}, {r6('confidence')}, '' FROM ip
WHERE prediction = 'Churn' AND confidence > 0.7"""


def _rules() -> str:
    """Rule lines of the depth-2 tree in pre-order."""
    return TREE_ALL + """,
deepest AS (SELECT max(depth) AS d FROM nodes),
lines AS (
  SELECT c.node_id << CAST(deepest.d - c.depth AS BIGINT) AS k, c.depth AS d, 0 AS kind,
         repeat('|   ', CAST(c.depth - 1 AS BIGINT)) || '|--- ' || CASE WHEN c.side = 'left' THEN printf('%s <= %.2f', p.feature, p.threshold)
                                                        ELSE printf('%s >  %.2f', p.feature, p.threshold) END AS text
  FROM nodes c JOIN nodes p ON p.node_id = c.parent_id, deepest
  UNION ALL
  SELECT c.node_id << CAST(deepest.d - c.depth AS BIGINT), c.depth, 1,
         repeat('|   ', CAST(c.depth AS BIGINT)) || '|--- ' || printf('weights: [%.2f, %.2f] class: %s', c.w0, c.w1,
                CASE WHEN c.prediction = 1 THEN 'Churn' ELSE 'No Churn' END)
  FROM nodes c, deepest WHERE c.is_leaf)
SELECT CAST(row_number() OVER (ORDER BY k, d, kind) AS INTEGER) AS line_no, text FROM lines"""


def _report_rows(rows: list[tuple[str, str, str, str]], source: str, columns: tuple[str, str]) -> str:
    return "\nUNION ALL ".join(f"SELECT '{s}' AS section, '{m}' AS metric, {v} AS {columns[0]}, {t} AS {columns[1]} FROM {source}"
                               for s, m, v, t in rows)


def _key_metrics() -> str:
    def num(section, metric, value):
        return section, metric, r6(f"COALESCE(CAST({value} AS DOUBLE), 0.0)"), "CAST(NULL AS VARCHAR)"

    def text(section, metric, value):
        return section, metric, "CAST(NULL AS DOUBLE)", value

    rows = [num("model_performance", k, k) for k in ("accuracy", "precision", "recall", "f1", "roc_auc")]
    rows += [text("model_performance", "overall_grade", "overall_grade"), num("business_impact", "net_value", "net"),
             num("business_impact", "roi_percentage", "roi * 100"), num("business_impact", "customers_at_risk", "tp + fn"),
             num("business_impact", "customers_to_target", "tp + fp_")]
    rows += [num("model_complexity", k, k) for k in ("max_depth", "n_nodes", "n_features_used", "total_features")]
    rows += [text("deployment_readiness", k, k) for k in ("status", "recommendation")]
    rows += [num("deployment_readiness", k, v) for k, v in (("accuracy_threshold", "a_ok"), ("auc_threshold", "u_ok"), ("grade_acceptable", "g_ok"))]
    return _report_rows(rows, "ve, st", ("value", "text"))


def _deployment_report() -> str:
    none = "CAST(NULL AS BOOLEAN)"
    rows = [("status", "Deployment Status", "status", "status = 'APPROVED'"), ("status", "Recommendation", "recommendation", none),
            ("performance", "Overall Grade", "overall_grade", "g_ok"),
            ("performance", "Accuracy", "printf('%.6f', accuracy)", "a_ok"), ("performance", "ROC AUC", "printf('%.6f', roc_auc)", "u_ok"),
            ("performance", "Precision", "printf('%.6f', precision)", none), ("performance", "Recall", "printf('%.6f', recall)", none),
            ("performance", "F1-Score", "printf('%.6f', f1)", none), ("impact", "Net Value", "printf('%.2f', CAST(net AS DOUBLE))", none),
            ("impact", "ROI Percent", "printf('%.4f', CAST(roi * 100 AS DOUBLE))", none),
            ("impact", "Customers at Risk", "CAST(tp + fn AS VARCHAR)", none),
            ("impact", "Target for Campaigns", "CAST(tp + fp_ AS VARCHAR)", none),
            ("complexity", "Tree Depth", "CAST(max_depth AS VARCHAR)", none), ("complexity", "Total Nodes", "CAST(n_nodes AS VARCHAR)", none),
            ("complexity", "Features Used", "CAST(n_features_used AS VARCHAR)", none),
            ("complexity", "Total Features", "CAST(total_features AS VARCHAR)", none)]
    rows += [("criteria", k, f"CAST({v} AS VARCHAR)", v) for k, v in
             (("accuracy_threshold", "a_ok"), ("auc_threshold", "u_ok"), ("grade_acceptable", "g_ok"))]
    return _report_rows(rows, "ve, st", ("value", "ok"))


def _model_card() -> str:
    fixed = [("model_type", "DecisionTree"), ("criterion", "entropy"), ("max_depth", str(DEPTH)), ("min_samples_split", str(MIN_SPLIT)),
             ("min_samples_leaf", str(MIN_LEAF)), ("class_weight", "balanced"), ("max_features", "None"), ("random_state", str(SEED)),
             ("classes", "0,1"), ("n_classes", "2")]
    found = [("tree_depth", "max_depth"), ("n_nodes", "n_nodes"), ("n_leaves", "n_leaves"), ("n_features_used", "n_features_used"),
             ("total_features", "total_features")]
    return "\nUNION ALL ".join([f"SELECT '{k}' AS key, '{v}' AS value" for k, v in fixed]
                               + [f"SELECT '{k}', CAST({c} AS VARCHAR) FROM st" for k, c in found])


def _renamed(sql: str, names: tuple[str, ...], prefix: str) -> str:
    return re.sub(rf"\b({'|'.join(names)})\b", rf"{prefix}\1", sql)


def _columns() -> str:
    return f"""
SELECT CAST(row_number() OVER () - 1 AS INTEGER) AS ordinal, column_name AS "column",
       CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' END AS dtype,
       CASE WHEN column_name = 'id' THEN 'id' WHEN column_name = 'churn' THEN 'target' WHEN column_type = 'VARCHAR' THEN 'categorical'
            WHEN column_type IN ('BIGINT', 'DOUBLE', 'INTEGER') THEN 'numeric' ELSE 'ignored' END AS role
FROM (DESCRIBE {with_(FRAME)} SELECT * FROM frame)"""


def _further() -> dict[str, str]:
    """Twins of the queries on single operators."""
    joint = ",\n".join(f"b{i} AS ({_bounds('frame', c)})" for i, c in enumerate(NUM))
    inside = " AND ".join(f"frame.{c} >= b{i}.lo AND frame.{c} <= b{i}.hi" for i, c in enumerate(NUM))
    names = ("pred", "cm", "sc", "rc", "mt")
    compare = with_(*BLOCKS, TEST_PRED, CONFUSION, RUNNING, RAW_RATES, STATS,
                    *[_renamed(b, names, "rule_") for b in (RULE_PRED, CONFUSION, RUNNING, RAW_RATES)])
    bad = {"acctbal": "f.id % 10 = 0", "spend": "f.id % 10 = 1", "quantity": "f.id % 10 = 2", "segment": "f.id % 10 = 3"}
    flagged = " OR ".join(f"f.{c} IS NULL OR {bad.get(c, 'false')}" for c in [*NUM, *CAT])
    p1 = "(LEAST(1.0, 2.0 / (1 + order_count)) * 1.5 - 0.25)"
    rule = "CASE WHEN c.side = 'left' THEN printf('%s <= %.3f', p.feature, p.threshold) ELSE printf('%s > %.3f', p.feature, p.threshold) END"
    vector = {5: "[CAST(acctbal AS DOUBLE), spend, tenure_days, 0, 0]", 2: "[CAST(acctbal AS DOUBLE), spend]"}
    return {
        "b2_columns": _columns(),
        "b8_feature_types": f"""WITH c AS ({_columns()})
SELECT role, (SELECT count(*) FROM c WHERE c.role = r.role OR (r.role = 'total' AND c.role IN ('numeric', 'categorical'))) AS n
FROM (VALUES ('numeric'), ('categorical'), ('ignored'), ('total')) AS r(role)""",
        "c5_joint_filter": with_(FRAME, joint) + "\nSELECT frame.* FROM frame, " + ", ".join(f"b{i}" for i in range(len(NUM))) + f" WHERE {inside}",
        "d8_prepared": with_(FRAME, clean_ctes(), SPLIT, ENC, KNN, SMOTE) + f"""
SELECT id, syn, label, is_synthetic, FALSE AS is_test, CAST(feature_idx AS INTEGER) AS feature_idx, {r6('value')} AS value FROM realr
UNION ALL SELECT id, syn, label, is_synthetic, FALSE, CAST(feature_idx AS INTEGER), {r6('value')} FROM synth
UNION ALL SELECT id, -1, label, FALSE, TRUE, CAST(fidx AS INTEGER), {r6('value')} FROM enc WHERE is_test""",
        "f5_folds": with_(FRAME, clean_ctes(), SPLIT) + f"""
SELECT id, churn AS label, CAST((row_number() OVER (PARTITION BY churn ORDER BY {_md5_prefix(f'{SEED}:fold', 'id')}, id) - 1) % 5 AS INTEGER) AS fold
FROM train""",
        "g16_compare": compare + f"""
SELECT 'tree' AS baseline, 'rule' AS candidate, {r6('r.accuracy - t.accuracy')} AS accuracy_delta, {r6('r.roc_auc - t.roc_auc')} AS auc_delta,
       CAST(n_features_used - 1 AS DOUBLE) AS features_removed, {r6('CASE WHEN n_features_used = 0 THEN 0 ELSE (n_features_used - 1) / n_features_used END')}
       AS feature_reduction FROM mt t, rule_mt r, st""",
        "h2_node_table": TREE_ALL + f"""
SELECT CAST(c.seq AS BIGINT) AS node_id, CAST(c.depth AS INTEGER) AS depth, CASE WHEN p.node_id IS NULL THEN 'Root' ELSE {rule} END AS parent_rule,
       CAST(c.n AS BIGINT) AS n, {r6('c.w0')} AS w0, {r6('c.w1')} AS w1, {r6('1 - c.p1')} AS p0, {r6('c.p1')} AS p1,
       CASE WHEN c.prediction = 1 THEN 'Churn' ELSE 'No Churn' END AS predicted_class, c.is_leaf, c.feature, {r6('c.threshold')} AS threshold,
       CASE WHEN NOT c.is_leaf THEN printf('%s <= %.3f', c.feature, c.threshold) END AS split_rule
FROM nodes c LEFT JOIN nodes p ON p.node_id = c.parent_id""",
        "h9_used_features": with_(*BLOCKS, IMPORTANCE) + f"""
SELECT CAST(feature_idx AS INTEGER) AS feature_idx, feature, {r6('importance')} AS importance, {r6('importance_pct')} AS importance_pct,
       CAST(row_number() OVER (ORDER BY importance DESC, feature_idx) AS INTEGER) AS rank FROM fi3 WHERE importance > 0""",
        "j1_default_fill": with_(FRAME) + """
SELECT id, acctbal, segment, CAST(6 AS INTEGER) AS month, CAST(2024 AS INTEGER) AS year, CAST(0 AS INTEGER) AS spend, 'Male' AS gender,
       'Hue' AS district, 'Unknown' AS nation FROM frame""",
        "j2_align_by_name": with_(FRAME) + f"""
SELECT id, {r6('spend')} AS spend, CAST(0 AS DOUBLE) AS complaints, CAST(order_count AS DOUBLE) AS order_count FROM frame""",
        "j3_align_by_position": with_(FRAME) + "\n" + "\nUNION ALL ".join(
            f"SELECT id, CAST({n} AS INTEGER) AS n_expected, CAST(unnest(range({n})) AS INTEGER) AS pos, {r6(f'unnest({v})')} AS value FROM frame"
            for n, v in vector.items()),
        "j4_repair": with_(FRAME) + f""",
moved AS (SELECT id, 1.1 - {p1} AS a, {p1} AS b FROM frame),
cut AS (SELECT id, GREATEST(a / (a + b), 0.0) AS a, GREATEST(b / (a + b), 0.0) AS b FROM moved)
SELECT id, {r6('a / (a + b)')} AS p0, {r6('b / (a + b)')} AS p1 FROM cut""",
        "j5_fallback": with_(*BLOCKS, SCORED.replace(UNUSABLE, flagged)) + f"""
SELECT id, {r6('p1')} AS p1, is_fallback, decision, risk_tier FROM tiers""",
    }


def oracle_sql() -> dict[str, str]:
    importance = with_(*BLOCKS, IMPORTANCE)
    paths = with_(*BLOCKS, _paths())
    report = with_(*BLOCKS, TEST_PRED, CONFUSION, RUNNING, RAW_RATES, SCORES, VERDICT, STATS)
    scored = with_(*BLOCKS, SCORED)
    by_importance = "ORDER BY importance DESC, feature_idx"
    return {
        **_further(),
        "f13_model_card": with_(*BLOCKS, STATS) + "\n" + _model_card(),
        "g13_top_features": importance + f"""
SELECT * FROM (SELECT CAST(feature_idx AS INTEGER) AS feature_idx, feature, {r6('importance')} AS importance, {r6('importance_pct')} AS importance_pct,
                      CAST(row_number() OVER ({by_importance}) AS INTEGER) AS rank FROM fi3) WHERE rank <= 10""",
        "g14_importance_stats": importance + f"""
SELECT list(feature ORDER BY feature) FILTER (WHERE importance = 0) AS zero_features, {r6('min(importance)')} AS min_importance,
       {r6('max(importance)')} AS max_importance, {r6('avg(importance)')} AS mean_importance FROM fi3""",
        "g15_cumulative_selection": importance + f""",
cum AS (SELECT *, sum(importance) OVER ({by_importance} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cumulative FROM fi3)
SELECT CAST(feature_idx AS INTEGER) AS feature_idx, feature, {r6('importance')} AS importance, {r6('cumulative')} AS cumulative
FROM cum WHERE cumulative - importance < 0.95 - 1e-12""",
        "h5_important_paths": paths + f"""
SELECT CAST(rank AS INTEGER) AS rank, CAST(seq AS BIGINT) AS leaf_id, path, CAST(samples AS BIGINT) AS samples, {r6('share')} AS share,
       prediction, {r6('confidence')} AS confidence FROM ip""",
        "h7_path_summary": with_(*BLOCKS, _paths(), STATS) + f"""
SELECT (SELECT count(*) FROM ip) AS important_paths, (SELECT count(*) FROM ip WHERE prediction = 'Churn') AS churn_paths,
       (SELECT count(*) FROM ip WHERE prediction = 'No Churn') AS retention_paths, {r6('n_leaves / n_nodes')} AS leaf_ratio,
       {r6('n_features_used / GREATEST(total_features, 1)')} AS feature_usage FROM st""",
        "h8_rules": _rules(),
        "h10_insights": paths + _insights(),
        "h12_depth_limited": TREE5 + f"""
SELECT CAST(seq AS BIGINT) AS node_id, CAST(depth AS INTEGER) AS depth, feature, {r6('threshold')} AS threshold, CAST(n AS BIGINT) AS n,
       {r6('p1')} AS p1, is_leaf, depth = 2 AND NOT is_leaf AS truncated FROM nodes WHERE depth <= 2""",
        "i7_key_metrics": report + "\n" + _key_metrics(),
        "i9_deployment_report": report + "\n" + _deployment_report(),
        "j6_batch_scoring": scored + f"\nSELECT id, {r6('p1')} AS p1, is_fallback, decision, risk_tier FROM tiers",
        "j9_campaign_targets": scored + f"""
SELECT id, {r6('p1')} AS p1, is_fallback, decision, risk_tier FROM tiers ORDER BY tiers.p1 DESC, id LIMIT 100""",
    }
