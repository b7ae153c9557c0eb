"""Preparation refitted for every cross-validation fold (S8, F6 with ``refit_prep``).

One aggregation gives each fold's states: count, mean and squared deviations of the
numeric columns, and the categories it holds. States merge, so model f's moments and
categories are those of all folds but f without another look at the rows: k states of
the size of the schema reach the driver whatever the number of rows. The encoded
features then are one projection whose constants are picked by the row's model.

Feature names are the numeric columns and every category of any fold but the
smallest of the column; in a model whose folds lack a category, or whose own
smallest category it is, the feature is constant 0, as drop-first demands.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnspark.operators.encode import Z_DIGITS
from churnspark.spec import FrameSpec

State = tuple[int, float, float]  # count, mean, sum of squared deviations


def merge(a: State, b: State) -> State:
    """The state of both sets of values together."""
    n = a[0] + b[0]
    if not n:
        return 0, 0.0, 0.0
    gap = b[1] - a[1]
    return n, a[1] + gap * b[0] / n, a[2] + b[2] + gap * gap * a[0] * b[0] / n


def fold_states(folded: DataFrame, spec: FrameSpec, k: int) -> dict[str, list[State]]:
    """Per numeric column the state of each fold."""
    aggs = []
    for i, c in enumerate(spec.numeric):
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"m{i}"), F.var_pop(x).alias(f"v{i}")]
    rows = {r["fold"]: r for r in folded.groupBy("fold").agg(F.count(F.lit(1)).alias("rows"), *aggs).collect()}
    return {c: [(r[f"n{i}"], r[f"m{i}"] or 0.0, (r[f"v{i}"] or 0.0) * r[f"n{i}"]) if (r := rows.get(f)) else (0, 0.0, 0.0)
                for f in range(k)] for i, c in enumerate(spec.numeric)}


def fold_categories(folded: DataFrame, spec: FrameSpec, max_categories: int) -> dict[str, dict[str, set[int]]]:
    """Per categorical column its categories, each with the folds that hold it."""
    out: dict[str, dict[str, set[int]]] = {c: {} for c in spec.categorical}
    if not spec.categorical:
        return out
    pairs = F.array(*[F.struct(F.lit(i).alias("ci"), F.col(c).cast("string").alias("v")) for i, c in enumerate(spec.categorical)])
    held = folded.select("fold", F.inline(pairs)).filter(F.col("v").isNotNull()).groupBy("ci", "v").agg(F.collect_set("fold").alias("folds"))
    held = held.persist()
    try:
        sizes = {r["ci"]: r["count"] for r in held.groupBy("ci").count().collect()}
        for i, c in enumerate(spec.categorical):
            if sizes.get(i, 0) > max_categories:
                raise ValueError(f"column {c!r} has {sizes[i]} categories (> {max_categories})")
        for r in held.collect():
            out[spec.categorical[r["ci"]]][r["v"]] = set(r["folds"])
    finally:
        held.unpersist()
    return out


def refit_features(folded: DataFrame, spec: FrameSpec, k: int, model: Column, max_categories: int = 1000) -> tuple[list[str], list[Column]]:
    """Feature names, and expressions over raw columns that encode a row for its ``model`` (fitted on all folds but that)."""
    def picked(values: list[float]) -> Column:
        return F.element_at(F.array(*[F.lit(float(v)) for v in values]), model.cast("int") + 1)

    names, exprs = [], []
    for c, states in fold_states(folded, spec, k).items():
        means, stds = [], []
        for f in range(k):
            n, mean, squares = 0, 0.0, 0.0
            for g, s in enumerate(states):
                if g != f:
                    n, mean, squares = merge((n, mean, squares), s)
            means.append(mean)
            stds.append(math.sqrt(squares / n) if n and squares > 0 else 1.0)
        z = (F.col(c).cast("double") - picked(means)) / picked(stds)
        names.append(c)
        exprs.append(F.coalesce(F.round(z, Z_DIGITS), F.lit(0.0)).alias(c))
    for c, held in fold_categories(folded, spec, max_categories).items():
        present = {v: [bool(folds - {f}) for f in range(k)] for v, folds in held.items()}
        first = [min((v for v, on in present.items() if on[f]), default=None) for f in range(k)]
        for v in sorted(held):
            on = [float(present[v][f] and first[f] != v) for f in range(k)]
            if any(on):
                names.append(f"{c}_{v}")
                exprs.append(F.when(F.col(c).cast("string") == v, picked(on)).otherwise(F.lit(0.0)).alias(f"{c}_{v}"))
    return names, exprs
