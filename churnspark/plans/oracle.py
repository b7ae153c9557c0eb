"""SQL twins of the registered queries, for a DuckDB value check.

Each string is plain SQL over the driver's tables and recomputes the query
from scratch (frame, sequential IQR chain, hash split, encoder fit, tree
levels). They are generated from the same parameters the Spark queries use.
"""

from __future__ import annotations

NUM = ["acctbal", "order_count", "spend", "urgent_count", "tenure_days", "quantity", "returned_count"]
CAT = ["segment", "nation"]
SEED = 42
TEST_SIZE = "0.2"
IQR_T = 1.5
MIN_LEAF = 5
MIN_SPLIT = 10


def r6(x: str) -> str:
    return f"ROUND(CAST({x} AS DOUBLE), 6)"


FRAME = """
o AS (
  SELECT o_orderkey, o_custkey, CAST(o_totalprice AS DECIMAL(18,2)) AS price,
         CAST(o_orderdate AS DATE) AS d, o_orderpriority = '1-URGENT' AS urgent
  FROM orders),
cutoff AS (SELECT max(d) - 365 AS cut FROM o),
l AS (SELECT l_orderkey, sum(CAST(l_quantity AS DECIMAL(18,2))) AS qty,
             count(*) FILTER (WHERE l_returnflag = 'R') AS ret
      FROM lineitem GROUP BY l_orderkey),
pc AS (
  SELECT o.o_custkey,
    count(*) FILTER (WHERE o.d < c.cut) AS order_count,
    sum(o.price) FILTER (WHERE o.d < c.cut) AS spend,
    count(*) FILTER (WHERE o.d < c.cut AND o.urgent) AS urgent_count,
    date_diff('day', min(o.d) FILTER (WHERE o.d < c.cut), max(o.d) FILTER (WHERE o.d < c.cut)) AS tenure_days,
    sum(l.qty) FILTER (WHERE o.d < c.cut) AS quantity,
    sum(l.ret) FILTER (WHERE o.d < c.cut) AS returned_count,
    count(*) FILTER (WHERE o.d >= c.cut) AS after_count
  FROM o CROSS JOIN cutoff c LEFT JOIN l ON l.l_orderkey = o.o_orderkey
  GROUP BY o.o_custkey),
frame AS (
  SELECT CAST(c.c_custkey AS BIGINT) AS id, CAST(c.c_acctbal AS DOUBLE) AS acctbal,
    CAST(pc.order_count AS BIGINT) AS order_count, CAST(pc.spend AS DOUBLE) AS spend,
    CAST(pc.urgent_count AS BIGINT) AS urgent_count, CAST(pc.tenure_days AS BIGINT) AS tenure_days,
    COALESCE(CAST(pc.quantity AS DOUBLE), 0.0) AS quantity,
    CAST(COALESCE(pc.returned_count, 0) AS BIGINT) AS returned_count,
    c.c_mktsegment AS segment, n.n_name AS nation,
    CAST(CASE WHEN pc.after_count = 0 THEN 1 ELSE 0 END AS INTEGER) AS churn
  FROM customer c JOIN pc ON c.c_custkey = pc.o_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  WHERE pc.order_count > 0)"""


def _bounds(src: str, col: str) -> str:
    return (f"SELECT quantile_cont({col}, 0.25) - {IQR_T} * (quantile_cont({col}, 0.75) - quantile_cont({col}, 0.25)) AS lo, "
            f"quantile_cont({col}, 0.75) + {IQR_T} * (quantile_cont({col}, 0.75) - quantile_cont({col}, 0.25)) AS hi FROM {src}")


def clean_ctes() -> str:
    parts = ["s0 AS (SELECT * FROM frame)"]
    for k, c in enumerate(NUM, start=1):
        parts.append(f"b{k} AS ({_bounds(f's{k - 1}', c)})")
        parts.append(f"s{k} AS (SELECT s{k - 1}.* FROM s{k - 1}, b{k} WHERE s{k - 1}.{c} >= b{k}.lo AND s{k - 1}.{c} <= b{k}.hi)")
    parts.append(f"clean AS (SELECT * FROM s{len(NUM)})")
    return ",\n".join(parts)


def _md5_prefix(seed: str, key: str) -> str:
    return f"substr(md5('{seed}' || ':' || CAST({key} AS VARCHAR)), 1, 13)"


def uniform_sql(seed: str, *parts: str) -> str:
    inner = " || ':' || ".join([f"'{seed}'"] + [f"CAST({p} AS VARCHAR)" for p in parts])
    return f"(CAST(('0x' || substr(md5({inner}), 1, 8)) AS UBIGINT) / 4294967296.0)"


SPLIT = f"""
cc AS (SELECT churn, count(*) AS n_c FROM clean GROUP BY churn),
tot AS (SELECT CAST(sum(n_c) AS BIGINT) AS n, CAST(ceil({TEST_SIZE} * sum(n_c)) AS BIGINT) AS n_test FROM cc),
q0 AS (SELECT cc.churn, (tot.n_test * cc.n_c) // tot.n AS base, (tot.n_test * cc.n_c) % tot.n AS rem FROM cc, tot),
q1 AS (SELECT churn, base + CASE WHEN row_number() OVER (ORDER BY rem DESC, churn)
                                  <= (SELECT n_test FROM tot) - (SELECT sum(base) FROM q0) THEN 1 ELSE 0 END AS quota
       FROM q0),
ranked AS (SELECT clean.*, row_number() OVER (PARTITION BY churn ORDER BY {_md5_prefix(str(SEED), 'id')}, id) - 1 AS r
           FROM clean),
split AS (SELECT ranked.* EXCLUDE (r), ranked.r < q1.quota AS is_test FROM ranked JOIN q1 USING (churn)),
train AS (SELECT * FROM split WHERE NOT is_test)"""


def _mom() -> str:
    rows = [f"SELECT '{c}' AS feature, {i} AS fidx, avg(CAST({c} AS DOUBLE)) AS mu, stddev_pop(CAST({c} AS DOUBLE)) AS sd FROM train"
            for i, c in enumerate(NUM)]
    return "mom AS (" + " UNION ALL ".join(rows) + ")"


def _cats() -> str:
    rows = [f"SELECT '{c}' AS col, {j} AS cpos, CAST({c} AS VARCHAR) AS v FROM train WHERE {c} IS NOT NULL GROUP BY {c}"
            for j, c in enumerate(CAT)]
    return ("cats AS (" + " UNION ALL ".join(rows) + "),\n"
            "cats1 AS (SELECT col, cpos, v, row_number() OVER (PARTITION BY col ORDER BY v) - 1 AS slot FROM cats),\n"
            f"ohf AS (SELECT col, cpos, v, col || '_' || v AS feature, {len(NUM)} + row_number() OVER (ORDER BY cpos, v) - 1 AS fidx "
            "FROM cats1 WHERE slot > 0)")


def _enc() -> str:
    num = [f"SELECT s.id, s.churn AS label, s.is_test, m.fidx, m.feature, "
           f"COALESCE(ROUND((CAST(s.{c} AS DOUBLE) - m.mu) / (CASE WHEN m.sd IS NULL OR m.sd = 0 THEN 1.0 ELSE m.sd END), 9), 0.0) AS value "
           f"FROM split s, mom m WHERE m.feature = '{c}'" for c in NUM]
    cat_case = " OR ".join(f"(f.cpos = {j} AND CAST(s.{c} AS VARCHAR) = f.v)" for j, c in enumerate(CAT))
    cat = (f"SELECT s.id, s.churn AS label, s.is_test, f.fidx, f.feature, "
           f"CASE WHEN {cat_case} THEN 1.0 ELSE 0.0 END AS value FROM split s, ohf f")
    return "enc AS (" + " UNION ALL ".join(num + [cat]) + ")"


ENC = ",\n".join([_mom(), _cats(), _enc()])


def with_(*blocks: str) -> str:
    return "WITH " + ",\n".join(b.strip() for b in blocks if b.strip())


BASE = with_(FRAME)
CLEAN = with_(FRAME, clean_ctes())
SPLIT_ALL = with_(FRAME, clean_ctes(), SPLIT)
ENC_ALL = with_(FRAME, clean_ctes(), SPLIT, ENC)

RULE_PRED = """
pred AS (SELECT id, churn AS label, LEAST(1.0, 2.0 / (1 + order_count)) AS p1,
                CASE WHEN LEAST(1.0, 2.0 / (1 + order_count)) > 0.5 THEN 1 ELSE 0 END AS prediction
         FROM split WHERE is_test)"""

CONFUSION = """
cm AS (SELECT count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn,
              count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp,
              count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn,
              count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp FROM pred)"""


def _sd(num: str, den: str) -> str:
    return f"(CASE WHEN ({den}) = 0 THEN 0.0 ELSE CAST({num} AS DOUBLE) / ({den}) END)"


RATES_SEL = f"""SELECT tn, fp, fn, tp,
  {r6(_sd('tp + tn', 'tn + fp + fn + tp'))} AS accuracy, {r6(_sd('tp', 'tp + fp'))} AS precision,
  {r6(_sd('tp', 'tp + fn'))} AS recall, {r6(_sd('2 * tp', '2 * tp + fp + fn'))} AS f1,
  {r6(_sd('tn', 'tn + fp'))} AS specificity, {r6(_sd('tp', 'tp + fn'))} AS sensitivity,
  {r6(_sd('fp', 'fp + tn'))} AS fpr, {r6(_sd('fn', 'fn + tp'))} AS fnr FROM cm"""

RUNNING = """
sc AS (SELECT CAST(p1 AS DOUBLE) AS score, count(*) FILTER (WHERE label = 1) AS pos,
              count(*) FILTER (WHERE label = 0) AS neg FROM pred GROUP BY p1),
rc AS (SELECT score, pos, neg,
              sum(pos) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
              sum(neg) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp FROM sc)"""

AUC_SEL = f"""SELECT {r6("CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN sum(CAST(neg AS DOUBLE) * ((tp - pos) + pos / 2.0)) / (CAST(sum(pos) AS DOUBLE) * sum(neg)) END")} AS roc_auc,
  {r6("CASE WHEN sum(pos) > 0 THEN sum(CAST(pos AS DOUBLE) * (CAST(tp AS DOUBLE) / (tp + fp))) / sum(pos) END")} AS average_precision FROM rc"""

METRICS = f"""
mrow AS ({RATES_SEL.replace('SELECT tn, fp, fn, tp,', 'SELECT tn, fp, fn, tp,', 1)}),
arow AS ({AUC_SEL}),
mt AS (SELECT * FROM mrow, arow)"""


def _rating(c: str) -> str:
    return f"CASE WHEN {c} >= 0.9 THEN 'Excellent' WHEN {c} >= 0.8 THEN 'Good' WHEN {c} >= 0.7 THEN 'Fair' ELSE 'Poor' END"


SCORES = """
sco AS (SELECT accuracy, roc_auc, precision, recall, f1, fpr,
          LEAST(5, GREATEST(1, CAST(trunc((roc_auc - 0.5) * 10) AS INTEGER))) AS auc_score,
          LEAST(5, GREATEST(1, CAST(trunc(accuracy * 5) AS INTEGER))) AS accuracy_score FROM mt),
gr AS (SELECT sco.*, (auc_score + accuracy_score) / 2.0 AS overall_score FROM sco),
gr2 AS (SELECT gr.*, CASE WHEN overall_score >= 4.5 THEN 'A' WHEN overall_score >= 3.5 THEN 'B+'
                          WHEN overall_score >= 2.5 THEN 'B' WHEN overall_score >= 1.5 THEN 'C' ELSE 'D' END AS overall_grade
        FROM gr)"""

# ----------------------------------------------------------- tree (depth 2) --
TREE_BASE = f"""
trows AS (SELECT DISTINCT id, label FROM enc WHERE NOT is_test),
wts AS (SELECT label, CAST((SELECT count(*) FROM trows) AS DOUBLE) / (2 * count(*)) AS w FROM trows GROUP BY label),
cw AS (SELECT max(CASE WHEN label = 0 THEN w END) AS c0, max(CASE WHEN label = 1 THEN w END) AS c1 FROM wts),
tenc AS (SELECT id, label, fidx, feature, value FROM enc WHERE NOT is_test),
fnames AS (SELECT DISTINCT fidx, feature FROM tenc)"""


def _ent(w0: str, w1: str) -> str:
    def t(p):
        return f"(CASE WHEN {p} > 0 THEN -({p}) * log2({p}) ELSE 0.0 END)"
    w = f"(({w0}) + ({w1}))"
    return f"({t(f'({w0}) / {w}')} + {t(f'({w1}) / {w}')})"


def _level(L: int, node_src: str) -> str:
    """CTEs for one level: node stats ns{L}, best split bs{L}. ``node_src``: CTE (id, node)."""
    return f"""
ns{L} AS (SELECT r.node, count(*) AS n, count(*) FILTER (WHERE r.label = 0) * cw.c0 AS w0,
                 count(*) FILTER (WHERE r.label = 1) * cw.c1 AS w1
          FROM {node_src} r, cw GROUP BY r.node, cw.c0, cw.c1),
h{L} AS (SELECT r.node, t.fidx, t.value AS v, count(*) AS n, count(*) FILTER (WHERE t.label = 0) AS n0,
                count(*) FILTER (WHERE t.label = 1) AS n1
         FROM {node_src} r JOIN tenc t ON t.id = r.id GROUP BY r.node, t.fidx, t.value),
cu{L} AS (SELECT h.*, sum(n) OVER w AS ln, sum(n0) OVER w AS ln0, sum(n1) OVER w AS ln1, lead(v) OVER w2 AS nv
          FROM h{L} h
          WINDOW w AS (PARTITION BY node, fidx ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                 w2 AS (PARTITION BY node, fidx ORDER BY v)),
ca{L} AS (SELECT cu.node, cu.fidx,
                 CASE WHEN v / 2.0 + nv / 2.0 = nv THEN v ELSE v / 2.0 + nv / 2.0 END AS thr,
                 cu.ln, cu.ln0 * cw.c0 AS lw0, cu.ln1 * cw.c1 AS lw1, ns.n AS pn, ns.w0 AS pw0, ns.w1 AS pw1
          FROM cu{L} cu JOIN ns{L} ns ON ns.node = cu.node, cw
          WHERE cu.nv > cu.v + 1e-7 AND cu.ln >= {MIN_LEAF} AND ns.n - cu.ln >= {MIN_LEAF}
            AND ns.n >= {MIN_SPLIT} AND ns.n >= {2 * MIN_LEAF} AND {_ent('ns.w0', 'ns.w1')} > 2.220446049250313e-16),
cg{L} AS (SELECT ca.*, {_ent('pw0', 'pw1')}
                 - (lw0 + lw1) / (pw0 + pw1) * {_ent('lw0', 'lw1')}
                 - ((pw0 - lw0) + (pw1 - lw1)) / (pw0 + pw1) * {_ent('pw0 - lw0', 'pw1 - lw1')} AS gain FROM ca{L} ca),
bs{L} AS (SELECT * FROM (SELECT cg.*, row_number() OVER (PARTITION BY node ORDER BY round(gain, 12) DESC, fidx, thr) AS rk
                         FROM cg{L} cg) WHERE rk = 1)"""


def tree_levels(depth: int) -> str:
    """CTEs of a whole tree of ``depth`` levels over ``trows`` and ``tenc``: nodes, impurities, decreases."""
    parts = ["r0 AS (SELECT id, label, CAST(1 AS BIGINT) AS node FROM trows)"]
    for lv in range(depth):
        parts.append(_level(lv, f"r{lv}").strip())
        parts.append(f"""r{lv + 1} AS (SELECT r.id, r.label, CASE WHEN t.value <= b.thr THEN 2 * r.node ELSE 2 * r.node + 1 END AS node
       FROM r{lv} r JOIN bs{lv} b ON b.node = r.node JOIN tenc t ON t.id = r.id AND t.fidx = b.fidx)""")
    parts.append(f"""ns{depth} AS (SELECT r.node, count(*) AS n, count(*) FILTER (WHERE r.label = 0) * cw.c0 AS w0,
               count(*) FILTER (WHERE r.label = 1) * cw.c1 AS w1 FROM r{depth} r, cw GROUP BY r.node, cw.c0, cw.c1)""")
    stats = " UNION ALL ".join(f"SELECT node, {lv} AS depth, n, w0, w1 FROM ns{lv}" for lv in range(depth + 1))
    splits = " UNION ALL ".join(f"SELECT node, fidx, thr FROM bs{lv}" for lv in range(depth))
    parts.append(f"allns AS ({stats}),\nallbs AS ({splits})")
    # ids count the nodes in breadth-first order; node_id here is the heap number that the steps need
    parts.append("seqs AS (SELECT node, row_number() OVER (ORDER BY depth, node) AS seq FROM allns)")
    parts.append("""nodes AS (SELECT a.node AS node_id, sq.seq, up.seq AS parent_seq, CASE WHEN a.node = 1 THEN NULL ELSE a.node // 2 END AS parent_id, a.depth,
                 f.feature AS feature, b.fidx AS feature_idx, b.thr AS threshold, a.n, a.w0, a.w1,
                 a.w1 / (a.w0 + a.w1) AS p1, CASE WHEN a.w1 / (a.w0 + a.w1) > 0.5 THEN 1 ELSE 0 END AS prediction,
                 b.node IS NULL AS is_leaf,
                 CASE WHEN a.node % 2 = 0 THEN 'left' ELSE 'right' END AS side
          FROM allns a LEFT JOIN allbs b ON b.node = a.node LEFT JOIN fnames f ON f.fidx = b.fidx
          JOIN seqs sq ON sq.node = a.node LEFT JOIN seqs up ON up.node = a.node // 2),
ent AS (SELECT nodes.*, """ + _ent("w0", "w1") + """ AS imp FROM nodes),
dec AS (SELECT p.node_id, p.feature_idx, p.feature,
               (p.w0 + p.w1) * p.imp - (l.w0 + l.w1) * l.imp - (r.w0 + r.w1) * r.imp AS decrease
        FROM ent p JOIN ent l ON l.node_id = 2 * p.node_id JOIN ent r ON r.node_id = 2 * p.node_id + 1
        WHERE NOT p.is_leaf)""")
    return ",\n".join(parts)


TREE = TREE_BASE + ",\n" + tree_levels(2)

TREE_ALL = with_(FRAME, clean_ctes(), SPLIT, ENC, TREE)

IMPORTANCE = """
fi AS (SELECT fn.fidx AS feature_idx, fn.feature, COALESCE(sum(d.decrease), 0.0) AS d
       FROM fnames fn LEFT JOIN dec d ON d.feature_idx = fn.fidx GROUP BY fn.fidx, fn.feature),
fi2 AS (SELECT feature_idx, feature, CASE WHEN sum(d) OVER () > 0 THEN d / sum(d) OVER () ELSE 0.0 END AS importance FROM fi),
fi3 AS (SELECT feature_idx, feature, importance,
               CASE WHEN sum(importance) OVER () > 0 THEN importance / sum(importance) OVER () * 100 ELSE 0.0 END AS importance_pct
        FROM fi2)"""


def _paths_sql() -> str:
    return """
leaves AS (SELECT * FROM nodes WHERE is_leaf),
steps AS (SELECT lv.node_id AS leaf, s.d, lv.node_id >> (lv.depth - s.d) AS anc, lv.node_id >> (lv.depth - s.d - 1) AS child
          FROM leaves lv, LATERAL (SELECT unnest(range(0, lv.depth)) AS d) s),
rl AS (SELECT st.leaf, st.d, CASE WHEN st.child % 2 = 0 THEN printf('%s <= %.3f', n.feature, n.threshold)
                                  ELSE printf('%s > %.3f', n.feature, n.threshold) END AS rule
       FROM steps st JOIN nodes n ON n.node_id = st.anc),
pth AS (SELECT leaf, string_agg(rule, ' -> ' ORDER BY d) AS path FROM rl GROUP BY leaf)"""


def _q(sql: str) -> str:
    return sql.strip()


def _num_summary() -> str:
    cols = ["id"] + NUM + ["churn"]
    rows = []
    for c in cols:
        x = f"CAST({c} AS DOUBLE)"
        rows.append(f"SELECT '{c}' AS \"column\", CAST(count({c}) AS BIGINT) AS count, {r6(f'avg({x})')} AS mean, "
                    f"{r6(f'stddev_samp({x})')} AS std, {r6(f'min({x})')} AS min, {r6(f'quantile_cont({x}, 0.25)')} AS q25, "
                    f"{r6(f'quantile_cont({x}, 0.5)')} AS q50, {r6(f'quantile_cont({x}, 0.75)')} AS q75, {r6(f'max({x})')} AS max FROM frame")
    return BASE + "\n" + " UNION ALL ".join(rows)


def _missing() -> str:
    cols = ["id"] + NUM + CAT + ["churn"]
    return BASE + "\n" + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS missing FROM frame" for c in cols)


def _joint_bounds() -> str:
    return BASE + "\n" + " UNION ALL ".join(
        f"SELECT {i} AS ordinal, '{c}' AS \"column\", {r6('lo')} AS lower, {r6('hi')} AS upper FROM ({_bounds('frame', c)})"
        for i, c in enumerate(NUM))


def _steps() -> str:
    rows = []
    for k, c in enumerate(NUM, start=1):
        rows.append(f"SELECT {k - 1} AS ordinal, '{c}' AS \"column\", {r6(f'b{k}.lo')} AS lower, {r6(f'b{k}.hi')} AS upper, "
                    f"(SELECT CAST(count(*) AS BIGINT) FROM s{k - 1}, b{k} bb WHERE s{k - 1}.{c} < bb.lo OR s{k - 1}.{c} > bb.hi) AS outliers, "
                    f"(SELECT CAST(count(*) AS BIGINT) FROM s{k}) AS rows_after FROM b{k}")
    return CLEAN + "\n" + " UNION ALL ".join(rows)


def _cardinality() -> str:
    return BASE + "\n" + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST(count(DISTINCT {c}) AS BIGINT) AS distinct_values FROM frame" for c in CAT)


KNN = """
mino AS (SELECT id, fidx, value FROM enc WHERE NOT is_test AND label = 1),
pairs AS (SELECT a.id, b.id AS nbr_id, ROUND(sqrt(sum((a.value - b.value) * (a.value - b.value))), 9) AS dist
          FROM mino a JOIN mino b ON a.fidx = b.fidx AND a.id <> b.id GROUP BY a.id, b.id),
knn AS (SELECT * FROM (SELECT id, CAST(row_number() OVER (PARTITION BY id ORDER BY dist, nbr_id) AS INTEGER) AS nbr_rank,
                              nbr_id, dist FROM pairs) WHERE nbr_rank <= 5)"""

SMOTE = f"""
tcounts AS (SELECT label, count(*) AS n FROM (SELECT DISTINCT id, label FROM enc WHERE NOT is_test) GROUP BY label),
mm AS (SELECT max(n) FILTER (WHERE label = 0) AS n0, max(n) FILTER (WHERE label = 1) AS n1 FROM tcounts),
alloc AS (SELECT m.id, row_number() OVER (ORDER BY {_md5_prefix(f'{SEED}:a', 'm.id')}, m.id) - 1 AS r
          FROM (SELECT DISTINCT id FROM mino) m),
cnts AS (SELECT a.id, (mm.n0 - mm.n1) // mm.n1 + CASE WHEN a.r < (mm.n0 - mm.n1) % mm.n1 THEN 1 ELSE 0 END AS cnt
         FROM alloc a, mm),
samp AS (SELECT c.id, s.syn FROM cnts c, LATERAL (SELECT unnest(range(0, c.cnt)) AS syn) s),
samp2 AS (SELECT id, syn, CAST(floor({uniform_sql(f'{SEED}:n', 'id', 'syn')} * 5) + 1 AS INTEGER) AS nbr_rank,
                 {uniform_sql(f'{SEED}:g', 'id', 'syn')} AS gap FROM samp),
synth AS (SELECT s.id, CAST(s.syn AS INTEGER) AS syn, 1 AS label, TRUE AS is_synthetic, x.fidx AS feature_idx,
                 x.value + s.gap * (y.value - x.value) AS value
          FROM samp2 s JOIN knn k ON k.id = s.id AND k.nbr_rank = s.nbr_rank
          JOIN mino x ON x.id = s.id JOIN mino y ON y.id = k.nbr_id AND y.fidx = x.fidx),
realr AS (SELECT id, -1 AS syn, label, FALSE AS is_synthetic, fidx AS feature_idx, value FROM enc WHERE NOT is_test)"""


def oracle_sql() -> dict[str, str]:
    pred = with_(FRAME, clean_ctes(), SPLIT, RULE_PRED)
    everyone = with_(FRAME, "\npred AS (SELECT id, LEAST(1.0, 2.0 / (1 + order_count)) AS p1 FROM frame)")
    cm = with_(FRAME, clean_ctes(), SPLIT, RULE_PRED, CONFUSION)
    run = with_(FRAME, clean_ctes(), SPLIT, RULE_PRED, RUNNING)
    mt = with_(FRAME, clean_ctes(), SPLIT, RULE_PRED, CONFUSION, RUNNING, METRICS)
    grade = with_(FRAME, clean_ctes(), SPLIT, RULE_PRED, CONFUSION, RUNNING, METRICS, SCORES)
    imp = with_(FRAME, clean_ctes(), SPLIT, ENC, TREE, IMPORTANCE)
    paths = with_(FRAME, clean_ctes(), SPLIT, ENC, TREE, _paths_sql())
    knn = with_(FRAME, clean_ctes(), SPLIT, ENC, KNN)
    smote = with_(FRAME, clean_ctes(), SPLIT, ENC, KNN, SMOTE)
    return {
        "a1_frame": BASE + "\nSELECT * FROM frame",
        "b1_shape": BASE + "\nSELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(11 AS BIGINT) AS n_columns FROM frame",
        "b3_missing": _missing(),
        "b4_numeric_summary": _num_summary(),
        "b5_class_distribution": BASE + f"""
SELECT churn AS class, CAST(count(*) AS BIGINT) AS count, {r6('count(*) / sum(count(*)) OVER ()')} AS share
FROM frame WHERE churn IS NOT NULL GROUP BY churn""",
        "b7_cardinality": _cardinality(),
        "c1_iqr_bounds": _joint_bounds(),
        "c2_outlier_steps": _steps(),
        "c3_outlier_filter": CLEAN + "\nSELECT * FROM clean",
        "c4_outlier_summary": CLEAN + f"""
SELECT CAST((SELECT count(*) FROM frame) AS BIGINT) AS rows_before, CAST((SELECT count(*) FROM clean) AS BIGINT) AS rows_after,
       CAST((SELECT count(*) FROM frame) - (SELECT count(*) FROM clean) AS BIGINT) AS rows_removed,
       {r6('((SELECT count(*) FROM frame) - (SELECT count(*) FROM clean)) / (SELECT count(*) FROM frame)')} AS percent_removed""",
        "d3_split": SPLIT_ALL + "\nSELECT id, churn, is_test FROM split",
        "d4_scaler": with_(FRAME, clean_ctes(), SPLIT, _mom()) + f"""
SELECT feature, {r6('mu')} AS mean, {r6('CASE WHEN sd IS NULL OR sd = 0 THEN 1.0 ELSE sd END')} AS std_pop FROM mom""",
        "d5_categories": with_(FRAME, clean_ctes(), SPLIT, _cats()) + """
SELECT col AS "column", v AS category, CAST(slot AS INTEGER) AS slot FROM cats1""",
        "d6_encoded": ENC_ALL + f"""
SELECT id, label, is_test, CAST(fidx AS INTEGER) AS feature_idx, feature, {r6('value')} AS value FROM enc""",
        "d7_dictionary": ENC_ALL + """
SELECT DISTINCT CAST(fidx AS INTEGER) AS feature_idx, feature FROM enc""",
        "e1_imbalance": SPLIT_ALL + f"""
SELECT max(n) AS n_majority, min(n) AS n_minority, {r6('max(n) / min(n)')} AS ratio, max(n) / min(n) > 1.5 AS resample
FROM (SELECT churn, CAST(count(*) AS BIGINT) AS n FROM train GROUP BY churn)""",
        "e3_knn": knn + f"\nSELECT id, nbr_rank, nbr_id, {r6('dist')} AS dist FROM knn",
        "e4_smote": smote + f"""
SELECT id, syn, label, is_synthetic, CAST(feature_idx AS INTEGER) AS feature_idx, {r6('value')} AS value FROM realr
UNION ALL SELECT id, syn, label, is_synthetic, CAST(feature_idx AS INTEGER) AS feature_idx, {r6('value')} AS value FROM synth""",
        "e5_class_weights": SPLIT_ALL + f"""
SELECT churn AS class, {r6('CAST((SELECT count(*) FROM train) AS DOUBLE) / (2 * count(*))')} AS weight FROM train GROUP BY churn""",
        "f1_tree_nodes": TREE_ALL + f"""
SELECT CAST(seq AS BIGINT) AS node_id, CAST(parent_seq AS BIGINT) AS parent_id, CAST(depth AS INTEGER) AS depth, feature,
       {r6('threshold')} AS threshold, CAST(n AS BIGINT) AS n, {r6('w0')} AS w0, {r6('w1')} AS w1, {r6('p1')} AS p1,
       CAST(prediction AS INTEGER) AS prediction, is_leaf FROM nodes""",
        "f3_tree_predict": with_(FRAME, clean_ctes(), SPLIT, ENC, TREE) + f""",
te AS (SELECT DISTINCT id, label FROM enc WHERE is_test),
p1r AS (SELECT te.id, te.label, CASE WHEN e.value <= b.thr THEN 2 ELSE 3 END AS node FROM te JOIN bs0 b ON b.node = 1
        JOIN enc e ON e.id = te.id AND e.fidx = b.fidx),
p2r AS (SELECT p.id, p.label, CASE WHEN b.node IS NULL THEN p.node WHEN e.value <= b.thr THEN 2 * p.node ELSE 2 * p.node + 1 END AS node
        FROM p1r p LEFT JOIN bs1 b ON b.node = p.node LEFT JOIN enc e ON e.id = p.id AND e.fidx = b.fidx)
SELECT p.id, p.label, CAST(n.seq AS BIGINT) AS node_id, {r6('n.p1')} AS p1, CAST(n.prediction AS INTEGER) AS prediction
FROM p2r p JOIN nodes n ON n.node_id = p.node""",
        "g1_confusion": cm + "\nSELECT * FROM cm",
        "g2_rates": cm + "\n" + RATES_SEL,
        "g4_roc": run + f"""
SELECT {r6('score')} AS threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp,
       {r6(_sd('tp', '(SELECT sum(pos) FROM sc)'))} AS tpr, {r6(_sd('fp', '(SELECT sum(neg) FROM sc)'))} AS fpr FROM rc
UNION ALL SELECT CAST('inf' AS DOUBLE), 0, 0, 0.0, 0.0 WHERE EXISTS (SELECT * FROM rc)""",
        "g5_auc_ap": run + "\n" + AUC_SEL,
        "g6_pr": run + f"""
SELECT {r6('score')} AS threshold, {r6(_sd('tp', 'tp + fp'))} AS precision, {r6(_sd('tp', '(SELECT sum(pos) FROM sc)'))} AS recall FROM rc
UNION ALL SELECT NULL, 1.0, 0.0 WHERE EXISTS (SELECT * FROM rc)""",
        "g8_report": cm + f""",
rp AS (SELECT '0' AS class, {_sd('tn', 'tn + fn')} AS precision, {_sd('tn', 'tn + fp')} AS recall,
              {_sd('2 * tn', '2 * tn + fn + fp')} AS f1, tn + fp AS support,
              {_sd('tp', 'tp + fp')} AS p1_, {_sd('tp', 'tp + fn')} AS r1_, {_sd('2 * tp', '2 * tp + fp + fn')} AS f1_,
              tp + fn AS s1_, tn, tp FROM cm)
SELECT class, {r6('precision')} AS precision, {r6('recall')} AS recall, {r6('f1')} AS f1, CAST(support AS BIGINT) AS support FROM rp
UNION ALL SELECT '1', {r6('p1_')}, {r6('r1_')}, {r6('f1_')}, CAST(s1_ AS BIGINT) FROM rp
UNION ALL SELECT 'macro avg', {r6('(precision + p1_) / 2')}, {r6('(recall + r1_) / 2')}, {r6('(f1 + f1_) / 2')}, CAST(support + s1_ AS BIGINT) FROM rp
UNION ALL SELECT 'weighted avg', {r6(_sd('precision * support + p1_ * s1_', 'support + s1_'))}, {r6(_sd('recall * support + r1_ * s1_', 'support + s1_'))},
                 {r6(_sd('f1 * support + f1_ * s1_', 'support + s1_'))}, CAST(support + s1_ AS BIGINT) FROM rp
UNION ALL SELECT 'accuracy', {r6(_sd('tp + tn', 'support + s1_'))}, {r6(_sd('tp + tn', 'support + s1_'))}, {r6(_sd('tp + tn', 'support + s1_'))},
                 CAST(support + s1_ AS BIGINT) FROM rp""",
        "g10_importance": imp + f"""
SELECT CAST(feature_idx AS INTEGER) AS feature_idx, feature, {r6('importance')} AS importance, {r6('importance_pct')} AS importance_pct FROM fi3""",
        "g12_utilisation": imp + f""",
rk AS (SELECT fi3.*, row_number() OVER (ORDER BY ROUND(importance, 6) DESC, feature_idx) AS rank FROM fi3)
SELECT CAST(count(*) AS BIGINT) AS total_features, CAST(count(*) FILTER (WHERE ROUND(importance, 6) > 0) AS BIGINT) AS used_features,
       CAST(count(*) FILTER (WHERE ROUND(importance, 6) = 0) AS BIGINT) AS unused_features,
       {r6('sum(CASE WHEN rank <= 5 THEN ROUND(importance_pct, 6) ELSE 0.0 END)')} AS top5_cumulative_pct FROM rk""",
        "h1_tree_stats": TREE_ALL + """
SELECT CAST(max(n.depth) AS INTEGER) AS max_depth, CAST(count(*) AS BIGINT) AS n_nodes,
       CAST(count(*) FILTER (WHERE n.is_leaf) AS BIGINT) AS n_leaves,
       CAST((SELECT count(DISTINCT feature_idx) FROM dec WHERE decrease > 0) AS BIGINT) AS n_features_used,
       CAST((SELECT count(*) FROM fnames) AS BIGINT) AS total_features FROM nodes n""",
        "h3_depth_distribution": TREE_ALL + "\nSELECT CAST(depth AS INTEGER) AS depth, CAST(count(*) AS BIGINT) AS nodes FROM nodes GROUP BY depth",
        "h4_paths": paths + f"""
SELECT CAST(lv.seq AS BIGINT) AS leaf_id, COALESCE(p.path, '') AS path, CAST(lv.n AS BIGINT) AS samples,
       {r6('lv.n / (SELECT n FROM nodes WHERE node_id = 1)')} AS share,
       CASE WHEN lv.prediction = 1 THEN 'Churn' ELSE 'No Churn' END AS prediction,
       {r6('GREATEST(lv.p1, 1 - lv.p1)')} AS confidence
FROM leaves lv LEFT JOIN pth p ON p.leaf = lv.node_id""",
        "h13_edges": TREE_ALL + """
SELECT CAST(parent_seq AS BIGINT) AS parent_id, CAST(seq AS BIGINT) AS child_id, side = 'left' AS branch FROM nodes WHERE parent_id IS NOT NULL""",
        "i1_campaign": cm + f"""
SELECT CAST(tn + fp + fn + tp AS BIGINT) AS total_customers, CAST(tp + fn AS BIGINT) AS actual_churners,
       CAST(tp + fp AS BIGINT) AS predicted_churners, CAST(tp AS BIGINT) AS correctly_identified,
       CAST(fn AS BIGINT) AS missed_churners, CAST(fp AS BIGINT) AS false_alarms,
       {r6(_sd('tp + fn', 'tn + fp + fn + tp'))} AS churn_rate, {r6(_sd('tp', 'tp + fn'))} AS identification_rate,
       {r6(_sd('fp', 'tp + fp'))} AS false_alarm_rate FROM cm""",
        "i2_financial": cm + f"""
SELECT 500.0 AS cost_per_lost_customer, 50.0 AS cost_per_retention_campaign, tp * 500.0 AS value_saved,
       (tp + fp) * 50.0 AS campaign_cost, fn * 500.0 AS lost_value, tp * 500.0 - (tp + fp) * 50.0 - fn * 500.0 AS net_value,
       {r6(_sd('tp * 500.0 - (tp + fp) * 50.0 - fn * 500.0', '(tp + fp) * 50.0'))} AS roi FROM cm""",
        "i4_rating": grade + f"""
SELECT {_rating('roc_auc')} AS auc_rating, {_rating('accuracy')} AS accuracy_rating, auc_score, accuracy_score,
       overall_score, overall_grade,
       CASE WHEN overall_score >= 3.5 THEN 'APPROVED' WHEN overall_score >= 2.5 THEN 'CONDITIONAL' ELSE 'NOT RECOMMENDED' END AS verdict
FROM gr2""",
        "i6_readiness": grade + """
SELECT CASE WHEN accuracy >= 0.75 AND roc_auc >= 0.8 AND overall_grade IN ('A', 'B+', 'B') THEN 'APPROVED'
            WHEN accuracy >= 0.7 AND roc_auc >= 0.75 THEN 'CONDITIONAL' ELSE 'NOT READY' END AS status,
       CASE WHEN accuracy >= 0.75 AND roc_auc >= 0.8 AND overall_grade IN ('A', 'B+', 'B') THEN 'Model is ready for production deployment'
            WHEN accuracy >= 0.7 AND roc_auc >= 0.75 THEN 'Model can be deployed with close monitoring'
            ELSE 'Model needs improvement before deployment' END AS recommendation,
       accuracy >= 0.75 AS accuracy_threshold, roc_auc >= 0.8 AS auc_threshold, overall_grade IN ('A', 'B+', 'B') AS grade_acceptable
FROM gr2""",
        "i8_strengths": mt + f"""
SELECT 'strength' AS kind, CASE WHEN recall > 0.75 THEN 'High Recall' ELSE 'Moderate Recall' END AS label, {r6('recall')} AS value FROM mt
UNION ALL SELECT 'strength', CASE WHEN roc_auc > 0.8 THEN 'Good AUC' ELSE 'Fair AUC' END, {r6('roc_auc')} FROM mt
UNION ALL SELECT 'strength', CASE WHEN accuracy > 0.8 THEN 'Good Accuracy' ELSE 'Moderate Accuracy' END, {r6('accuracy')} FROM mt
UNION ALL SELECT 'weakness', CASE WHEN precision < 0.6 THEN 'Low Precision' ELSE 'Good Precision' END, {r6('precision')} FROM mt
UNION ALL SELECT 'weakness', 'False Positive Rate', {r6('fpr')} FROM mt""",
        "j8_tiers": everyone + f"""
SELECT id, {r6('GREATEST(0.0, LEAST(1.0, p1))')} AS p1,
       CASE WHEN GREATEST(0.0, LEAST(1.0, p1)) > 0.5 THEN 'Likely to Churn' ELSE 'Likely to Stay' END AS decision,
       CASE WHEN GREATEST(0.0, LEAST(1.0, p1)) > 0.7 THEN 'High' WHEN GREATEST(0.0, LEAST(1.0, p1)) > 0.4 THEN 'Medium' ELSE 'Low' END AS risk_tier
FROM pred""",
        "j9_tier_summary": everyone + f"""
SELECT CASE WHEN p1 > 0.7 THEN 'High' WHEN p1 > 0.4 THEN 'Medium' ELSE 'Low' END AS risk_tier,
       CAST(count(*) AS BIGINT) AS customers, ROUND(avg(p1), 6) AS mean_p1, ROUND(min(p1), 6) AS min_p1, ROUND(max(p1), 6) AS max_p1
FROM pred GROUP BY 1""",
    }
