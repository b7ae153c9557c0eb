"""SQL twins of cross-validation, grid search and pruning: many trees grown side by side, a model number on every row.

``mp`` holds a model's parameters, ``mr`` the rows it is grown on; every grid point and fold is grown on its own here,
without the truncations, batches and sweeps of the Spark side.
"""

from __future__ import annotations

from churnspark.plans.oracle import CAT, ENC, FRAME, NUM, SEED, SPLIT, _md5_prefix, clean_ctes, r6, with_

K = 5
METRICS = ("accuracy", "precision", "recall", "f1", "roc_auc")
GRID = {"criterion": ["gini", "entropy"], "max_depth": [1, 2, 3], "max_features": [None], "min_samples_leaf": [5, 40],
        "min_samples_split": [10, 300]}

FOLDS = f"""
folds AS MATERIALIZED (SELECT id, churn AS label, (row_number() OVER (PARTITION BY churn ORDER BY {_md5_prefix(f'{SEED}:fold', 'id')}, id) - 1) % {K} AS fold
                       FROM train)"""


def _entropy(a: str, b: str) -> str:
    def term(x):
        return f"CASE WHEN {x} > 0 THEN -({x} / ({a} + {b})) * log2({x} / ({a} + {b})) ELSE 0.0 END"
    return f"({term(f'({a})')} + {term(f'({b})')})"


def _impurity(a: str, b: str) -> str:
    w = f"(({a}) + ({b}))"
    return f"CASE WHEN mp.crit = 'gini' THEN 1.0 - (({a}) / {w}) * (({a}) / {w}) - (({b}) / {w}) * (({b}) / {w}) ELSE {_entropy(f'({a})', f'({b})')} END"


def grown(depth: int, enc: str) -> str:
    """CTEs of all models' trees: ``bs`` (m, node, fidx, thr) and ``ns`` (m, node, n, w0, w1); nodes are heap numbers.
    ``enc`` joins the encoded values ``t (id, fidx, value)`` of a row ``r (m, id)``."""
    parts = ["""mc AS (SELECT m, label, count(*) AS n FROM mr GROUP BY ALL),
cw AS MATERIALIZED (SELECT m, max(CASE WHEN label = 0 THEN w END) AS c0, max(CASE WHEN label = 1 THEN w END) AS c1 FROM (
    SELECT mc.m, label, CASE WHEN mp.bal THEN CAST(sum(n) OVER (PARTITION BY mc.m) AS DOUBLE) / (count(*) OVER (PARTITION BY mc.m) * n) ELSE 1.0 END AS w
    FROM mc JOIN mp ON mp.m = mc.m) GROUP BY m),
r0 AS (SELECT m, id, label, CAST(1 AS BIGINT) AS node FROM mr)"""]
    for lv in range(depth + 1):
        parts.append(f"""ns{lv} AS MATERIALIZED (SELECT r.m, r.node, count(*) AS n, count(*) FILTER (WHERE r.label = 0) * cw.c0 AS w0,
    count(*) FILTER (WHERE r.label = 1) * cw.c1 AS w1 FROM r{lv} r JOIN cw ON cw.m = r.m GROUP BY r.m, r.node, cw.c0, cw.c1)""")
        if lv == depth:
            break
        parts.append(f"""h{lv} AS (SELECT r.m, r.node, t.fidx, t.value AS v, count(*) AS n, count(*) FILTER (WHERE r.label = 0) AS n0,
    count(*) FILTER (WHERE r.label = 1) AS n1 FROM r{lv} r {enc} GROUP BY ALL),
cu{lv} AS (SELECT h.m, h.node, h.fidx, v, sum(n) OVER w AS ln, sum(n0) OVER w AS ln0, sum(n1) OVER w AS ln1, lead(v) OVER o AS nv FROM h{lv} h
    WINDOW w AS (PARTITION BY m, node, fidx ORDER BY v ROWS UNBOUNDED PRECEDING), o AS (PARTITION BY m, node, fidx ORDER BY v)),
ca{lv} AS (SELECT cu.m, cu.node, cu.fidx, CASE WHEN v / 2.0 + nv / 2.0 = nv THEN v ELSE v / 2.0 + nv / 2.0 END AS thr, cu.ln0 * cw.c0 AS lw0,
    cu.ln1 * cw.c1 AS lw1, ns.w0 AS pw0, ns.w1 AS pw1 FROM cu{lv} cu JOIN ns{lv} ns ON ns.m = cu.m AND ns.node = cu.node
    JOIN cw ON cw.m = cu.m JOIN mp ON mp.m = cu.m WHERE cu.nv > cu.v + 1e-7 AND cu.ln >= mp.msl AND ns.n - cu.ln >= mp.msl AND ns.n >= mp.mss
    AND ns.n >= 2 * mp.msl AND mp.md > {lv} AND {_impurity('ns.w0', 'ns.w1')} > 2.220446049250313e-16),
bs{lv} AS MATERIALIZED (SELECT m, node, fidx, thr FROM (SELECT ca.m, ca.node, ca.fidx, ca.thr, {_impurity('pw0', 'pw1')}
    - (lw0 + lw1) / (pw0 + pw1) * {_impurity('lw0', 'lw1')} - ((pw0 - lw0) + (pw1 - lw1)) / (pw0 + pw1) * {_impurity('pw0 - lw0', 'pw1 - lw1')} AS gain
    FROM ca{lv} ca JOIN mp ON mp.m = ca.m) QUALIFY row_number() OVER (PARTITION BY m, node ORDER BY round(gain, 12) DESC, fidx, thr) = 1),
r{lv + 1} AS MATERIALIZED (SELECT r.m, r.id, r.label, CASE WHEN t.value <= b.thr THEN 2 * r.node ELSE 2 * r.node + 1 END AS node
    FROM r{lv} r JOIN bs{lv} b ON b.m = r.m AND b.node = r.node {enc} AND t.fidx = b.fidx)""")
    parts.append("bs AS MATERIALIZED (" + " UNION ALL ".join(f"SELECT * FROM bs{lv}" for lv in range(depth)) + ")")
    parts.append("ns AS MATERIALIZED (" + " UNION ALL ".join(f"SELECT * FROM ns{lv}" for lv in range(depth + 1)) + ")")
    return ",\n".join(parts)


def routed(depth: int, enc: str) -> str:
    """CTEs ``x0 ..``: rows ``ar`` (m, id, label, split) down their model's tree; ``pred`` at the end."""
    parts = ["x0 AS (SELECT m, id, label, split, CAST(1 AS BIGINT) AS node FROM ar)"]
    for lv in range(depth):
        parts.append(f"""x{lv + 1} AS MATERIALIZED (SELECT r.m, r.id, r.label, r.split, CASE WHEN b.node IS NULL THEN r.node WHEN t.value <= b.thr THEN 2 * r.node
    ELSE 2 * r.node + 1 END AS node FROM x{lv} r LEFT JOIN bs b ON b.m = r.m AND b.node = r.node {enc.replace('JOIN', 'LEFT JOIN', 1)} AND t.fidx = b.fidx)""")
    parts.append(f"""pred AS MATERIALIZED (SELECT x.m, x.id, x.label, x.split, ns.w1 / (ns.w0 + ns.w1) AS p1,
    CASE WHEN ns.w1 / (ns.w0 + ns.w1) > 0.5 THEN 1 ELSE 0 END AS prediction FROM x{depth} x JOIN ns ON ns.m = x.m AND ns.node = x.node)""")
    return ",\n".join(parts)


MEASURED = """
cm AS (SELECT m, split, count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn, count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp,
    count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn, count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp FROM pred GROUP BY ALL),
sg AS (SELECT m, split, round(p1, 12) AS p1, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg FROM pred GROUP BY ALL),
sc AS (SELECT *, sum(pos) OVER (PARTITION BY m, split ORDER BY p1 DESC ROWS UNBOUNDED PRECEDING) AS up FROM sg),
au AS (SELECT m, split, CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN sum(CAST(neg AS DOUBLE) * (up - pos + pos / 2.0)) / (CAST(sum(pos) AS DOUBLE) * sum(neg)) END AS roc_auc
    FROM sc GROUP BY ALL),
mt AS MATERIALIZED (SELECT cm.m, cm.split, CASE WHEN tn + fp + fn + tp = 0 THEN 0.0 ELSE CAST(tp + tn AS DOUBLE) / (tn + fp + fn + tp) END AS accuracy,
    CASE WHEN tp + fp = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fp) END AS precision, CASE WHEN tp + fn = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fn) END AS recall,
    CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn) END AS f1, roc_auc FROM cm JOIN au USING (m, split))"""

SUMMARY = "\nSELECT split, metric, " + r6("avg(v)") + " AS mean, " + r6("stddev_pop(v)") + " AS std FROM (" + " UNION ALL ".join(
    f"SELECT split, '{m}' AS metric, {m} AS v FROM mt" for m in METRICS) + ") GROUP BY split, metric"

ENCODED = ENC.replace("enc AS (", "enc AS MATERIALIZED (", 1)
BY_ID = "JOIN enc t ON t.id = r.id"
BY_MODEL = "JOIN fenc t ON t.m = r.m AND t.id = r.id"
DEFAULTS = f"mp AS (SELECT m, 'entropy' AS crit, 5 AS md, 10 AS mss, 5 AS msl, true AS bal FROM range({K}) AS u(m))"
CV_ROWS = """mr AS (SELECT m, id, label FROM mp JOIN folds ON fold <> m),
ar AS (SELECT m, id, label, CASE WHEN fold = m THEN 'test' ELSE 'train' END AS split FROM mp, folds)"""


def _refit() -> str:
    """``fenc`` (m, id, fidx, value): train rows encoded by the moments and categories of all folds but the model's."""
    raw = "fr AS MATERIALIZED (SELECT train.*, fold FROM train JOIN folds USING (id))"
    moments = " UNION ALL ".join(f"SELECT m, {i} AS fidx, avg(CAST({c} AS DOUBLE)) AS mu, stddev_pop(CAST({c} AS DOUBLE)) AS sd FROM mp JOIN fr ON fold <> m GROUP BY m"
                                 for i, c in enumerate(NUM))
    cats = " UNION ALL ".join(f"SELECT DISTINCT m, {j} AS cpos, CAST({c} AS VARCHAR) AS v FROM mp JOIN fr ON fold <> m WHERE {c} IS NOT NULL" for j, c in enumerate(CAT))
    values = " UNION ALL ".join(f"SELECT o.m, s.id, o.fidx, COALESCE(ROUND((CAST(s.{c} AS DOUBLE) - o.mu) / (CASE WHEN o.sd IS NULL OR o.sd = 0 THEN 1.0 ELSE o.sd END), 9), 0.0) AS value "
                                f"FROM fr s, fmom o WHERE o.fidx = {i}" for i, c in enumerate(NUM))
    held = " OR ".join(f"(o.cpos = {j} AND CAST(s.{c} AS VARCHAR) = o.v)" for j, c in enumerate(CAT))
    return f"""{raw},
fmom AS MATERIALIZED ({moments}),
fcat AS (SELECT *, row_number() OVER (PARTITION BY m, cpos ORDER BY v) AS slot FROM ({cats})),
fone AS MATERIALIZED (SELECT m, cpos, v, {len(NUM)} + row_number() OVER (PARTITION BY m ORDER BY cpos, v) - 1 AS fidx FROM fcat WHERE slot > 1),
fenc AS MATERIALIZED ({values} UNION ALL SELECT o.m, s.id, o.fidx, CASE WHEN {held} THEN 1.0 ELSE 0.0 END FROM fr s, fone o)"""


def _points() -> str:
    rows, i = [], 0
    for crit in GRID["criterion"]:
        for md in GRID["max_depth"]:
            for msl in GRID["min_samples_leaf"]:
                for mss in GRID["min_samples_split"]:
                    rows.append(f"({i}, '{crit}', {md}, {msl}, {mss})")
                    i += 1
    return "pts AS (SELECT * FROM (VALUES " + ", ".join(rows) + ") AS v(combo_id, crit, md, msl, mss))"


# Models 0 .. 5 * points - 1 are a point and a fold; from 1000 on a point on all train rows.
GRID_MODELS = f"""mp AS MATERIALIZED (SELECT combo_id * {K} + f AS m, crit, md, mss, msl, false AS bal, combo_id, f FROM pts, range({K}) AS u(f)
    UNION ALL SELECT 1000 + combo_id, crit, md, mss, msl, false, combo_id, -1 FROM pts),
te AS (SELECT DISTINCT id, label FROM enc WHERE is_test),
mr AS (SELECT m, id, label FROM mp JOIN folds ON fold <> f),
ar AS (SELECT m, id, label, 'test' AS split FROM mp JOIN folds ON fold = f UNION ALL SELECT m, id, label, 'test' FROM mp, te WHERE f = -1)"""
SCORED = """
cs AS (SELECT pts.combo_id, avg(accuracy) AS mean, stddev_pop(accuracy) AS std FROM pts JOIN mp USING (combo_id) JOIN mt ON mt.m = mp.m WHERE f >= 0 GROUP BY ALL),
bp AS (SELECT combo_id FROM cs ORDER BY mean DESC, combo_id LIMIT 1)"""

# One tree of depth 2 on four folds; the fifth chooses among its prunings. Node t collapses at the largest
# (R(t) - R(T)) / (|T| - 1) over all prunings T of its branches.
PRUNED = """
mp AS (SELECT 0 AS m, 'entropy' AS crit, 2 AS md, 10 AS mss, 5 AS msl, true AS bal),
mr AS (SELECT 0 AS m, id, label FROM folds WHERE fold > 0)"""
COLLAPSE = f"""
rk AS MATERIALIZED (SELECT ns.node, (ns.w0 + ns.w1) / (SELECT w0 + w1 FROM ns WHERE node = 1) * {_entropy('ns.w0', 'ns.w1')} AS risk,
    bs.node IS NULL AS is_leaf, CASE WHEN ns.w1 / (ns.w0 + ns.w1) > 0.5 THEN 1 ELSE 0 END AS prediction FROM ns LEFT JOIN bs ON bs.node = ns.node),
side AS (SELECT p.node // 2 AS up, p.node, p.risk AS s, 1 AS l FROM rk p WHERE p.node > 1
    UNION ALL SELECT p.node // 2, p.node, a.risk + b.risk, 2 FROM rk p JOIN rk a ON a.node = 2 * p.node JOIN rk b ON b.node = 2 * p.node + 1 WHERE p.node > 1),
al AS MATERIALIZED (SELECT rk.node, rk.risk, rk.prediction, CASE WHEN rk.is_leaf THEN 0.0 ELSE greatest(0.0, (
    SELECT max((rk.risk - a.s - b.s) / (a.l + b.l - 1)) FROM side a JOIN side b ON a.node = 2 * rk.node AND b.node = 2 * rk.node + 1)) END AS alpha FROM rk),
lf AS MATERIALIZED (SELECT al.*, least(coalesce((SELECT min(u.alpha) FROM al u WHERE u.node = al.node // 2 OR u.node = al.node // 4), 'inf'::DOUBLE), 'inf'::DOUBLE) AS cap FROM al),
st AS MATERIALIZED (SELECT a, row_number() OVER (ORDER BY a) - 1 AS step, lead(a) OVER (ORDER BY a) IS NULL AS root_only
    FROM (SELECT DISTINCT alpha AS a FROM lf WHERE alpha < cap UNION SELECT 0.0))"""
ROUTED_FOLD = "ar AS (SELECT 0 AS m, id, label, 'test' AS split FROM folds WHERE fold = 0)"


def oracle_sql() -> dict[str, str]:
    start = (FRAME, clean_ctes(), SPLIT, ENCODED, FOLDS)
    cv = with_(*start, DEFAULTS, CV_ROWS, grown(5, BY_ID), routed(5, BY_ID), MEASURED)
    refit = with_(FRAME, clean_ctes(), SPLIT, FOLDS, DEFAULTS, CV_ROWS, _refit(), grown(5, BY_MODEL), routed(5, BY_MODEL), MEASURED)
    grid = with_(*start, _points(), GRID_MODELS, grown(3, BY_ID), routed(3, BY_ID), MEASURED, SCORED)
    pruned = with_(*start, PRUNED, grown(2, BY_ID), COLLAPSE)
    return {
        "f6_cross_validate": cv + SUMMARY,
        "f6_cross_validate_refit": refit + SUMMARY,
        "f7_cv_score": cv + f"""
SELECT CAST(m AS INTEGER) AS fold, {r6('f1')} AS score, {r6('avg(f1) OVER ()')} AS mean_score, {r6('stddev_pop(f1) OVER ()')} AS std_score FROM mt WHERE split = 'test'""",
        "f9_grid_search": grid + f"""
SELECT CAST(combo_id AS INTEGER) AS combo_id, crit AS criterion, md AS max_depth, msl AS min_samples_leaf, mss AS min_samples_split,
       {r6('mean')} AS mean_test_score, {r6('std')} AS std_test_score, combo_id = (SELECT combo_id FROM bp) AS best FROM cs JOIN pts USING (combo_id)""",
        "f9_best_test": grid + "\nSELECT " + ", ".join(f"{r6(m)} AS {m}" for m in METRICS) + " FROM mt JOIN mp ON mp.m = mt.m JOIN bp USING (combo_id) WHERE f = -1",
        "f10_pruning_path": pruned + f"""
SELECT CAST(step AS INTEGER) AS step, {r6('a')} AS alpha, {r6('sum(risk)')} AS impurity, CAST(count(*) AS INTEGER) AS n_leaves
FROM st JOIN lf ON lf.alpha <= a AND a < lf.cap GROUP BY step, a""",
        "f12_pruning_choice": with_(*start, PRUNED, ROUTED_FOLD, grown(2, BY_ID), COLLAPSE, routed(2, BY_ID)) + f""",
hit AS (SELECT st.step, st.a, avg(CAST(lf.prediction = x.label AS INT)) AS score FROM st JOIN x2 x ON NOT st.root_only
        JOIN lf ON (lf.node = x.node OR lf.node = x.node // 2 OR lf.node = x.node // 4) AND lf.alpha <= a AND a < lf.cap GROUP BY ALL)
SELECT CAST(step AS INTEGER) AS step, {r6('a')} AS alpha, {r6('score')} AS score, step = (SELECT step FROM hit ORDER BY score DESC, step LIMIT 1) AS best FROM hit""",
    }
