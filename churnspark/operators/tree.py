"""Level-wise decision-tree trainer and scorer on DataFrames.

Training keeps the rows in Spark; per level:

1. route every row from the root through the splits found so far (the splits
   are a few constant arrays; each level is a fresh projection of the cached
   input, so lineage does not grow with depth);
2. ``posexplode`` the feature vector and aggregate ``(model, node, feature,
   value) -> n, w0, w1`` (partial aggregation before the shuffle; with
   ``max_bins`` the values are pre-bucketed, so the histogram is bounded by
   nodes x features x bins whatever the row count);
3. prefix sums ordered by value give left/right statistics of every candidate
   threshold; impurity gains are built-in arithmetic. The sums have two levels: a
   feature with many values is cut into value slices, windows run inside
   ``(model, node, feature, slice)``, and the slices' totals (a row each) are summed
   into offsets, so no task holds a feature's whole histogram. Such a feature's rows go to
   their slice as they are, in one shuffle a level: a histogram of nearly distinct values
   would be as long, wider, and shuffled again for the windows;
4. ``max_by`` per node picks the winner (ties: larger gain rounded to 12
   digits, then smaller feature index, then smaller threshold). Nodes of several models
   that hold the same rows (same training rows, same splits above) share their sums, and each
   model judges them by its own criterion, leaf size and weights;
5. only the winners (one row per open node) reach the driver.

Semantics: thresholds are midpoints ``v/2 + next/2`` between distinct values
further apart than 1e-7, rows with ``x <= t`` go left, ``min_samples_leaf``
counts rows, impurity uses class weights, a node splits while it is impure,
has at least ``min_samples_split`` and ``2 * min_samples_leaf`` rows, and is
above ``max_depth`` (``None``: no limit). Sibling leaves with the same class are kept apart.

Node ids count a model's nodes in breadth-first order from 1, so siblings have
consecutive ids and a child's id is larger than its parent's; a tree may be as deep as
it needs. The node table also has each node's ``path`` from the root (``L`` / ``R`` per
step): prefixes are ancestors and sorting by it is the pre-order.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import math
from dataclasses import asdict, dataclass, field

from pyspark import StorageLevel
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from churnspark.functions.hashing import hash_key
from churnspark.operators.node_arrays import NodeArrays, Routes, by_model, constant_array

FEATURE_THRESHOLD = 1e-7    # values closer than this are not split apart
GAIN_DIGITS = 12
KEY_SHIFT = 32              # key of a node = model_id << 32 | node_id
SLICE_VALUES = 50_000       # rows of a feature beyond which its histogram is cut into value slices
MAX_SLICES = 256

NODE_SCHEMA = T.StructType([
    T.StructField("model_id", T.LongType()), T.StructField("node_id", T.LongType()),
    T.StructField("parent_id", T.LongType()), T.StructField("depth", T.IntegerType()),
    T.StructField("side", T.StringType()), T.StructField("feature_idx", T.IntegerType()),
    T.StructField("feature", T.StringType()), T.StructField("threshold", T.DoubleType()),
    T.StructField("n", T.LongType()), T.StructField("w0", T.DoubleType()),
    T.StructField("w1", T.DoubleType()), T.StructField("impurity", T.DoubleType()),
    T.StructField("decrease", T.DoubleType()), T.StructField("prediction", T.IntegerType()),
    T.StructField("p1", T.DoubleType()), T.StructField("is_leaf", T.BooleanType()),
    T.StructField("path", T.StringType()),
])


@dataclass(frozen=True)
class TreeParams:
    max_depth: int | None = 5
    min_samples_split: int = 10
    min_samples_leaf: int = 5
    criterion: str = "entropy"            # or "gini"
    class_weight: str | None = "balanced"  # or None
    max_features: str | int | None = None  # None, "sqrt", "log2" or a count
    min_impurity_decrease: float = 0.0
    max_bins: int | None = None           # None: exact thresholds; k: k quantile bins per feature
    seed: int = 42

    @property
    def depth_limit(self) -> float:
        return math.inf if self.max_depth is None else self.max_depth


def impurity(w0: float, w1: float, criterion: str) -> float:
    w = w0 + w1
    if w <= 0:
        return 0.0
    p0, p1 = w0 / w, w1 / w
    if criterion == "gini":
        return 1.0 - p0 * p0 - p1 * p1
    return -sum(p * math.log2(p) for p in (p0, p1) if p > 0)


def _impurity_expr(w0: Column, w1: Column, criterion: str) -> Column:
    w = w0 + w1
    p0, p1 = w0 / w, w1 / w
    if criterion == "gini":
        return F.lit(1.0) - p0 * p0 - p1 * p1
    def term(p):
        return F.when(p > 0, -p * F.log2(p)).otherwise(F.lit(0.0))
    return term(p0) + term(p1)


def _n_max_features(max_features, p: int) -> int:
    if max_features is None:
        return p
    if max_features == "sqrt":
        return max(1, int(math.sqrt(p)))
    if max_features == "log2":
        return max(1, int(math.log2(p)))
    if isinstance(max_features, float):
        return max(1, int(max_features * p))
    return max(1, min(p, int(max_features)))


def _key(model: Column, node: Column) -> Column:
    return F.shiftleft(model.cast("bigint"), KEY_SHIFT) + node.cast("bigint")


def route(df: DataFrame, splits: dict[tuple[int, int], tuple[int, float, int]], levels: int,
          x: Column, model: Column, out: str = "node") -> DataFrame:
    """Add ``out`` = node id reached after ``levels`` steps from the root (stops at leaves).

    One ``aggregate`` over the level sequence: the slot is a lambda variable, so the expression
    stays linear in depth and the plan shape does not depend on the tree (splits are constant
    arrays passed by reference); a step takes three reads by position, whatever the number of nodes.
    """
    if levels <= 0 or not splits:
        return df.withColumn(out, F.lit(1).cast("bigint"))
    routes = Routes(splits)
    slot = F.aggregate(F.sequence(F.lit(1), F.lit(levels)), routes.root(model), lambda slot, _level: routes.child(slot, x))
    return df.withColumn(out, routes.node(slot, model))


@dataclass
class TreeModel:
    """A fitted tree (or a batch of trees keyed by ``model_id``) as a node table."""

    features: list[str]
    params: TreeParams
    nodes: list[dict] = field(default_factory=list)

    # ---- structure -------------------------------------------------------
    def splits(self) -> dict[tuple[int, int], tuple[int, float, int]]:
        left = {(r["model_id"], r["parent_id"]): r["node_id"] for r in self.nodes if r["side"] == "left"}
        return {key: (r["feature_idx"], r["threshold"], left[key]) for r in self.nodes
                if not r["is_leaf"] and (key := (r["model_id"], r["node_id"]))}

    def node_paths(self) -> dict[tuple[int, int], str]:
        """``L`` / ``R`` steps from the root to each node."""
        out: dict[tuple[int, int], str] = {}
        for r in sorted(self.nodes, key=lambda r: r["depth"]):
            above = "" if r["parent_id"] is None else out[(r["model_id"], r["parent_id"])] + r["side"][0].upper()
            out[(r["model_id"], r["node_id"])] = above
        return out

    def leaf_p1(self) -> dict[tuple[int, int], float]:
        return {(r["model_id"], r["node_id"]): r["p1"] for r in self.nodes if r["is_leaf"]}

    @property
    def depth(self) -> int:
        return max((r["depth"] for r in self.nodes), default=0)

    def model_ids(self) -> list[int]:
        return sorted({r["model_id"] for r in self.nodes})

    def nodes_df(self, spark: SparkSession) -> DataFrame:
        paths = self.node_paths()
        named = [dict(r, path=paths[(r["model_id"], r["node_id"])]) for r in self.nodes]
        rows = [tuple(r[f.name] for f in NODE_SCHEMA.fields) for r in sorted(named, key=lambda r: (r["model_id"], r["node_id"]))]
        return spark.createDataFrame(rows, NODE_SCHEMA)

    def select_model(self, model_id: int) -> "TreeModel":
        return TreeModel(self.features, self.params,
                         [dict(r, model_id=0) for r in self.nodes if r["model_id"] == model_id])

    # ---- scoring -----------------------------------------------------------
    def predict(self, df: DataFrame, model_col: str | None = None, levels: int | None = None) -> DataFrame:
        """Add ``node_id``, ``p1`` (leaf weighted churn share) and
        ``prediction`` (``p1 > 0.5``). Map-only: no shuffle, no join."""
        x = F.array(*[F.col(c).cast("double") for c in self.features])
        model = F.col(model_col) if model_col else F.lit(0)
        scored = route(df, self.splits(), self.depth if levels is None else levels, x, model, "node_id")
        leaves = self.leaf_p1()
        p1 = NodeArrays(leaves).value(leaves, "double", model, F.col("node_id"))
        return (scored.withColumn("p1", p1)
                .withColumn("prediction", (F.col("p1") > 0.5).cast("int")))

    # ---- persistence (A2 / A3) --------------------------------------------
    def save(self, spark: SparkSession, path: str) -> None:
        self.nodes_df(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        meta = [(json.dumps({"features": self.features, "params": asdict(self.params)}),)]
        spark.createDataFrame(meta, "meta string").coalesce(1).write.mode("overwrite").text(f"{path}/meta")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "TreeModel":
        meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
        nodes = [r.asDict() for r in spark.read.parquet(f"{path}/nodes").collect()]
        return TreeModel(meta["features"], TreeParams(**meta["params"]), nodes)


def class_weights(df: DataFrame, label: str = "label", model_col: str | None = None,
                  mode: str | None = "balanced") -> dict[tuple[int, int], float]:
    """E5: balanced weight ``n / (n_classes * n_c)`` per (model, class)."""
    m = F.col(model_col) if model_col else F.lit(0)
    counts = df.groupBy(m.alias("m"), F.col(label).alias("y")).count().collect()
    per_model: dict[int, dict[int, int]] = {}
    for r in counts:
        per_model.setdefault(r["m"], {})[r["y"]] = r["count"]
    out = {}
    for mid, cc in per_model.items():
        n = sum(cc.values())
        for y, c in cc.items():
            out[(mid, y)] = (n / (len(cc) * c)) if mode == "balanced" else 1.0
    return out


def class_weight_table(spark: SparkSession, weights: dict[tuple[int, int], float]) -> DataFrame:
    return spark.createDataFrame([(m, y, w) for (m, y), w in sorted(weights.items())],
                                 "model_id long, class int, weight double")


def _bin_edges(df: DataFrame, features: list[str], max_bins: int) -> dict[int, list[float]]:
    probs = [i / max_bins for i in range(1, max_bins)]
    row = df.agg(*[F.percentile_approx(F.col(c).cast("double"), probs, 10000).alias(f"e{i}")
                   for i, c in enumerate(features)]).first()
    mx = df.agg(*[F.max(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(features)]).first()
    edges = {}
    for i in range(len(features)):
        vals = sorted(set([v for v in (row[f"e{i}"] or []) if v is not None] + [mx[f"m{i}"]]))
        edges[i] = vals
    return edges


def _binned_vector(features: list[str], edges: dict[int, list[float]]) -> Column:
    """Each value replaced by the smallest bin edge >= it (so ``x <= edge`` routes identically)."""
    out = []
    for i, c in enumerate(features):
        x = F.col(c).cast("double")
        e = edges[i]
        # binary-search tree of when() over the sorted edges: O(log bins) per value
        def build(lo, hi):
            if lo == hi:
                return F.lit(e[lo])
            mid = (lo + hi) // 2
            return F.when(x <= F.lit(e[mid]), build(lo, mid)).otherwise(build(mid + 1, hi))
        out.append(build(0, len(e) - 1))
    return F.array(*out)


def _slice_edges(df: DataFrame, features: list[str]) -> dict[int, list[float]]:
    """Inner edges of the value slices of each feature that has more than ``SLICE_VALUES`` values."""
    cols = [F.col(c).cast("double") for c in features]
    n = df.count()
    if n <= SLICE_VALUES:  # no feature has more values than rows
        return {}
    kinds = df.select(F.posexplode(F.array(*cols)).alias("f", "v")).groupBy("f").agg(F.approx_count_distinct("v", 0.02).alias("kinds"))
    many = sorted(r["f"] for r in kinds.filter(F.col("kinds") > SLICE_VALUES).collect())
    if not many:
        return {}
    slices = min(MAX_SLICES, -(-n // SLICE_VALUES))
    probs = [i / slices for i in range(1, slices)]
    row = df.agg(*[F.percentile_approx(cols[i], probs, 10000).alias(f"e{i}") for i in many]).first()
    return {i: sorted(set(row[f"e{i}"])) for i in many}


def fit_tree(df: DataFrame, features: list[str], label: str = "label", params: TreeParams | None = None,
             model_col: str | None = None, weight_col: str | None = None,
             model_params: dict[int, TreeParams] | None = None, models_col: str | None = None,
             same_rows: dict[int, int] | None = None) -> TreeModel:
    """grow one tree per distinct ``model_col`` value (or a single tree).

    ``model_params`` gives a model its own criterion / leaf size / feature
    subset / depth; all models still grow together, one job sequence per level.
    ``models_col`` names an array of the models that a row trains, in place of ``model_col``:
    rows are then kept once and copied in each pass. Models to which ``same_rows``
    gives the same number train on the same rows.
    """
    params = params or TreeParams()
    p = len(features)
    if models_col:
        model = F.col(models_col).cast("array<bigint>")
    else:
        model = (F.col(model_col) if model_col else F.lit(0)).cast("bigint")
    y = F.col(label).cast("int")
    if weight_col:
        w = F.col(weight_col).cast("double")
        cw = None
    else:
        by = df.select(F.col(label), F.explode(models_col).alias("m")) if models_col else df
        cw = class_weights(by, label, "m" if models_col else model_col, params.class_weight)
        w = F.lit(1.0)
    tag = [model.alias("m"), y.alias("y"), w.alias("w")]
    if params.max_bins:
        edges = _bin_edges(df, features, params.max_bins)
        base = df.select(*tag, _binned_vector(features, edges).alias("x"))
    else:
        base = df.select(*tag, *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)])
        edges = _slice_edges(df, features)
        if edges:
            ids = sorted(edges)
            base = Bucketizer(splitsArray=[[-math.inf, *edges[i], math.inf] for i in ids], inputCols=[f"x{i}" for i in ids],
                              outputCols=[f"b{i}" for i in ids], handleInvalid="keep").transform(base)
        slices = [F.array(*[F.col(f"b{i}").cast("int") if i in edges else F.lit(0) for i in range(p)]).alias("b")] if edges else []
        base = base.select("m", "y", "w", F.array(*[F.col(f"x{i}") for i in range(p)]).alias("x"), *slices)
    base = base.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        rows = base.select(F.explode("m").alias("m"), *[c for c in base.columns if c != "m"]) if models_col else base
        many = [] if params.max_bins else sorted(edges)
        return _grow(rows, features, params, p, cw, model_params or {}, same_rows or {}, many)
    finally:
        base.unpersist()


def _weighted(cw, m: Column, n0: Column, n1: Column, s0: Column, s1: Column) -> tuple[Column, Column]:
    """Class-weighted sums: count x weight of the (model, class) (exact); or summed row weights."""
    if cw is None:
        return s0, s1
    c0, c1 = (by_model({mm: v for (mm, c), v in cw.items() if c == cls}, "double", m) for cls in (0, 1))
    return n0 * F.coalesce(c0, F.lit(0.0)), n1 * F.coalesce(c1, F.lit(0.0))


def _grow(base: DataFrame, features: list[str], params: TreeParams, p: int, cw, model_params: dict, same_rows: dict,
          many: list[int]) -> TreeModel:
    agg = base.groupBy("m").agg(F.count(F.lit(1)).alias("n"),
                                F.count_if(F.col("y") == 0).alias("n0"), F.count_if(F.col("y") == 1).alias("n1"),
                                F.sum(F.when(F.col("y") == 0, F.col("w")).otherwise(0.0)).alias("s0"),
                                F.sum(F.when(F.col("y") == 1, F.col("w")).otherwise(0.0)).alias("s1"))
    w0, w1 = _weighted(cw, F.col("m"), F.col("n0"), F.col("n1"), F.col("s0"), F.col("s1"))
    root = agg.select("m", "n", w0.alias("w0"), w1.alias("w1")).collect()

    def pp(m: int) -> TreeParams:
        return model_params.get(m, params)

    nodes: dict[tuple[int, int], dict] = {}
    for r in root:
        nodes[(r["m"], 1)] = _node(r["m"], 1, None, 0, "root", r["n"], r["w0"], r["w1"], pp(r["m"]).criterion)
    splits: dict[tuple[int, int], tuple[int, float, int]] = {}
    path = {key: "" for key in nodes}
    # what a node's rows depend on: the model's training rows and the splits above
    held: dict[tuple[int, int], tuple] = {(m, n): (m in same_rows, same_rows.get(m, m)) for m, n in nodes}
    last_id = {m: 1 for m, _ in nodes}
    frontier = list(nodes)
    limit = max([params.depth_limit] + [q.depth_limit for q in model_params.values()])
    for depth in itertools.count():
        active = [k for k in frontier if depth < pp(k[0]).depth_limit and _splittable(nodes[k], pp(k[0]))]
        if not active:
            break
        # Levels to route through: few different numbers, so that few plans are compiled.
        levels = 8
        while levels < depth:
            levels *= 2
        best = _best_splits(base, splits, active, nodes, params, p, cw, model_params, path, int(min(levels, limit)), held, many)
        frontier = []
        for (m, nid), b in sorted(best.items()):
            q = pp(m)
            parent = nodes[(m, nid)]
            W = parent["w0"] + parent["w1"]
            lw0, lw1 = b["lw0"], b["lw1"]
            rw0, rw1 = parent["w0"] - lw0, parent["w1"] - lw1
            ln, rn = b["ln"], parent["n"] - b["ln"]
            li, ri = impurity(lw0, lw1, q.criterion), impurity(rw0, rw1, q.criterion)
            decrease = W * parent["impurity"] - (lw0 + lw1) * li - (rw0 + rw1) * ri
            root_w = nodes[(m, 1)]["w0"] + nodes[(m, 1)]["w1"]
            if decrease / root_w + 1e-16 < q.min_impurity_decrease:
                continue
            left, right = last_id[m] + 1, last_id[m] + 2
            last_id[m] = right
            splits[(m, nid)] = (b["fidx"], b["thr"], left)
            parent.update(is_leaf=False, feature_idx=b["fidx"], feature=features[b["fidx"]],
                          threshold=b["thr"], decrease=decrease)
            nodes[(m, left)] = _node(m, left, nid, depth + 1, "left", ln, lw0, lw1, q.criterion)
            nodes[(m, right)] = _node(m, right, nid, depth + 1, "right", rn, rw0, rw1, q.criterion)
            path[(m, left)], path[(m, right)] = path[(m, nid)] + "L", path[(m, nid)] + "R"
            held[(m, left)], held[(m, right)] = [(*held[(m, nid)], b["fidx"], b["thr"], side) for side in "LR"]
            frontier += [(m, left), (m, right)]
    return TreeModel(list(features), params, list(nodes.values()))


def _node(m, nid, parent, depth, side, n, w0, w1, crit) -> dict:
    w0, w1 = float(w0 or 0.0), float(w1 or 0.0)
    p1 = w1 / (w0 + w1) if (w0 + w1) > 0 else 0.0
    return {"model_id": int(m), "node_id": int(nid), "parent_id": parent, "depth": depth, "side": side,
            "feature_idx": None, "feature": None, "threshold": None, "n": int(n), "w0": w0, "w1": w1,
            "impurity": impurity(w0, w1, crit), "decrease": 0.0, "prediction": int(p1 > 0.5),
            "p1": p1, "is_leaf": True}


def _splittable(node: dict, params: TreeParams) -> bool:
    return (node["n"] >= params.min_samples_split and node["n"] >= 2 * params.min_samples_leaf
            and node["impurity"] > 2.220446049250313e-16)


SUMS = ("n", "n0", "n1", "s0", "s1")


def _running(hist: DataFrame, where: list[str], sliced: bool) -> DataFrame:
    """Rows with the sums ``l*`` up to their value and the next value ``nv`` of the node and feature.

    ``hist`` is a histogram; or, if ``sliced``, the rows ``(k, f, b, v, y, w)`` themselves: where a value repeats there,
    the last row's sums are the value's, and the others' next value is their own, before which nothing splits."""
    win = Window.partitionBy(*where).orderBy("v")
    cum = win.rowsBetween(Window.unboundedPreceding, 0)
    if not sliced:
        return hist.select("k", "f", "v", *[F.sum(c).over(cum).alias(f"l{c}") for c in SUMS], F.lead("v").over(win).alias("nv"))
    y = F.col("y")
    own = [F.lit(1).cast("bigint"), (y == 0).cast("bigint"), (y == 1).cast("bigint"),
           F.when(y == 0, F.col("w")).otherwise(0.0), F.when(y == 1, F.col("w")).otherwise(0.0)]
    cand = hist.select(*where, "v", *[F.coalesce(F.sum(e).over(cum), F.lit(0)).alias(f"l{c}") for c, e in zip(SUMS, own)],
                       F.lead("v").over(win).alias("nv"))
    over = Window.partitionBy("k", "f").orderBy("b")
    before = over.rowsBetween(Window.unboundedPreceding, -1)
    totals = hist.groupBy(*where).agg(*[F.coalesce(F.sum(e), F.lit(0)).alias(c) for c, e in zip(SUMS, own)], F.min("v").alias("v"))
    offsets = totals.select(*where, *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"o{c}") for c in SUMS],
                            F.lead("v").over(over).alias("next"))
    return cand.join(offsets, where).select("k", "f", "v", *[(F.col(f"l{c}") + F.col(f"o{c}")).alias(f"l{c}") for c in SUMS],
                                            F.coalesce("nv", "next").alias("nv"))


def _best_splits(base, splits, active, nodes, params, p, cw, model_params, path, levels, held, many) -> dict:
    def pp(m):
        return model_params.get(m, params)
    subset = {(m, n): _n_max_features(pp(m).max_features, p) for m, n in active}
    drawn = any(v < p for v in subset.values())
    # nodes with the same rows share the sums of the first of them, unless each has features of its own
    sharing: dict[tuple, list[tuple[int, int]]] = {}
    for key in active:
        sharing.setdefault(key if drawn else held[key], []).append(key)
    first = [keys[0] for keys in sharing.values()]
    # Same plan shape at every level (the splits and the open nodes are constant
    # arrays passed by reference), so the generated code is reused by later levels.
    opened = NodeArrays(active)
    sharers = {m for m, _ in first}
    kept = base.filter(by_model({m: True for m in sharers}, "boolean", F.col("m")).isNotNull())
    routed = route(kept, splits, levels, F.col("x"), F.col("m"))
    is_open = opened.value({k: True for k in first}, "boolean", F.col("m"), F.col("node"))
    routed = routed.filter(is_open.isNotNull()).withColumn("k", _key(F.col("m"), F.col("node")))

    def values(ids: list[int], *columns: str) -> DataFrame:
        each = F.array(*[F.struct(F.lit(i).alias("f"), *[F.get(c, F.lit(i)).alias(n) for c, n in zip(columns, ("v", "b"))]) for i in ids])
        return routed.select("k", "y", "w", F.inline(each))

    def allowed_only(long: DataFrame) -> DataFrame:
        return long
    if drawn:
        # per-node feature subset: the k features with the smallest md5(seed:model:path:f)
        allowed = [False] * (opened.size * p)
        for (m, n), kf in subset.items():
            ranked = sorted(range(p), key=lambda f: hashlib.md5(f"{pp(m).seed}:{m}:{path[(m, n)]}:{f}".encode()).hexdigest())
            for f in ranked[:kf]:
                allowed[(opened.start[m] + n) * p + f] = True
        slot = opened.slot(F.shiftright(F.col("k"), KEY_SHIFT), F.col("k").bitwiseAND((1 << KEY_SHIFT) - 1))
        is_allowed = F.get(constant_array(allowed, "boolean"), slot * p + F.col("f"))

        def allowed_only(long: DataFrame) -> DataFrame:
            return long.filter(is_allowed)
    few = [i for i in range(p) if i not in set(many)]
    long = values(few, "x") if many else routed.select("k", "y", "w", F.posexplode("x").alias("f", "v"))
    hist = allowed_only(long).groupBy("k", "f", "v").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("y") == 0).alias("n0"), F.count_if(F.col("y") == 1).alias("n1"),
        F.sum(F.when(F.col("y") == 0, F.col("w")).otherwise(0.0)).alias("s0"),
        F.sum(F.when(F.col("y") == 1, F.col("w")).otherwise(0.0)).alias("s1"))
    model = F.shiftright(F.col("k"), KEY_SHIFT)
    node = F.col("k").bitwiseAND((1 << KEY_SHIFT) - 1)

    def total(name: str, kind: str) -> Column:
        return F.get(opened.array({k: nodes[k][name] for k in first}, kind), F.col("slot"))
    parts = ([_running(hist, ["k", "f"], False)] if few else []) + ([_running(allowed_only(values(many, "x", "b")), ["k", "f", "b"], True)] if many else [])
    cand = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    cand = cand.withColumn("slot", opened.slot(model, node))
    lw0c, lw1c = _weighted(cw, model, F.col("ln0"), F.col("ln1"), F.col("ls0"), F.col("ls1"))
    cand = cand.withColumn("lw0", lw0c).withColumn("lw1", lw1c)
    N, W0, W1 = total("n", "bigint"), total("w0", "double"), total("w1", "double")
    rn, rw0, rw1 = N - F.col("ln"), W0 - F.col("lw0"), W1 - F.col("lw1")
    if params.max_bins:
        thr = F.col("v")
        gap_ok = F.col("nv").isNotNull()
    else:
        thr = F.col("v") / 2.0 + F.col("nv") / 2.0
        thr = F.when((thr == F.col("nv")) | F.isnan(thr), F.col("v")).otherwise(thr)
        gap_ok = F.col("nv") > F.col("v") + FEATURE_THRESHOLD
    lw, rw = F.col("lw0") + F.col("lw1"), rw0 + rw1
    def gain_for(criterion):
        own = F.get(opened.array({k: impurity(nodes[k]["w0"], nodes[k]["w1"], criterion) for k in first}, "double"), F.col("slot"))
        return (own
                - lw / (W0 + W1) * _impurity_expr(F.col("lw0"), F.col("lw1"), criterion)
                - rw / (W0 + W1) * _impurity_expr(rw0, rw1, criterion))
    # every way to judge a node that a model has; nodes that share sums are judged in one pass
    judges = sorted({(q.criterion, q.min_samples_leaf) for q in [params, *model_params.values()]})
    gains = {c: F.col(f"gain_{c}") for c, _ in judges}
    scored = cand.filter(gap_ok).select("k", F.struct("f", thr.alias("thr"), "ln", "lw0", "lw1").alias("b"), F.least("ln", rn).alias("side"),
                                        *[gain_for(c).alias(f"gain_{c}") for c in gains])

    def order(criterion: str, leaf: int) -> Column:
        by = F.struct(F.round(gains[criterion], GAIN_DIGITS), -F.col("b.f"), -F.col("b.thr"))
        return F.when(F.col("side") >= leaf, by)
    best = scored.filter(F.col("side") >= min(leaf for _, leaf in judges)).groupBy("k").agg(
        *[F.max_by("b", order(*judge)).alias(f"b{i}") for i, judge in enumerate(judges)])
    found = {(r["k"] >> KEY_SHIFT, r["k"] & ((1 << KEY_SHIFT) - 1)): r for r in best.collect()}
    out = {}
    for keys in sharing.values():
        for m, n in keys if keys[0] in found else []:
            b = found[keys[0]][f"b{judges.index((pp(m).criterion, pp(m).min_samples_leaf))}"]
            if b is not None:
                out[(m, n)] = {"fidx": b["f"], "thr": b["thr"], "ln": b["ln"], "lw0": b["lw0"], "lw1": b["lw1"]}
    return out
