"""Exact quantiles (linear interpolation) without gathering a column in one task.

Spark's built-in ``percentile`` keeps a value->count map of the whole column in
the final aggregation task, which does not survive 100 TB. Here each pass is a
plain grouped count over value buckets (map-side combined, result size bounded
by ``buckets`` per open window): pass 0 gets count/min/max per column, every
further pass splits the window holding each wanted rank into ``buckets``
equal-width buckets and keeps the one bucket that holds the rank, with its
actual min and max as the next window. A window whose min equals its max is
the answer. Integer-like columns finish in one refinement pass, doubles in
two or three.
"""

from __future__ import annotations

import math
import sys

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _long_form(df: DataFrame, cols: list[str]) -> DataFrame:
    arr = F.array(*[F.col(c).cast("double") for c in cols])
    return (df.select(F.posexplode(arr).alias("c", "x"))
            .filter(F.col("x").isNotNull() & ~F.isnan("x")))


def _start(df: DataFrame, cols: list[str], probs: list[float], accuracy: int) -> tuple[dict, dict, int]:
    """One pass: per column (rows, least, greatest) and a first window for each wanted rank.

    The windows come from a sketch whose rank error is below ``rows / accuracy``; the
    first refinement counts the rows below each window, so a window that misses its
    rank is noticed and widened to the whole column."""
    margin = 2.0 / accuracy
    grid = sorted({min(1.0, max(0.0, q)) for p in probs for q in (p - margin, p + margin)})
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(cols):
        x = F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
        aggs += [F.count(x).alias(f"n{i}"), F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}"),
                 F.percentile_approx(x, grid, accuracy).alias(f"q{i}")]
    row = df.agg(*aggs).first()
    stats = {i: (row[f"n{i}"], row[f"lo{i}"], row[f"hi{i}"]) for i in range(len(cols)) if row[f"n{i}"]}
    wanted: dict[tuple[int, int], list] = {}
    for i, (n, lo, hi) in stats.items():
        at = dict(zip(grid, row[f"q{i}"]))
        for p in probs:
            a = at[min(1.0, max(0.0, p - margin))] if p > margin else lo
            b = at[min(1.0, max(0.0, p + margin))] if p < 1 - margin else hi
            for r in {math.floor(p * (n - 1)), math.ceil(p * (n - 1))}:
                wanted[(i, r)] = [a, b, None]  # window [a, b]; rows below a: not counted yet
    return stats, wanted, row["rows"]


def _bucket(x, a: float, b: float, buckets: int):
    """Bucket of x in [a, b]: infinities are end buckets of their own, finite values share the rest evenly."""
    lo = a if math.isfinite(a) else -sys.float_info.max
    hi = b if math.isfinite(b) else sys.float_info.max
    span = hi / 2.0 - lo / 2.0
    inner = F.least(F.floor((x / 2.0 - lo / 2.0) / span * buckets), F.lit(buckets - 1)) if span > 0 else F.lit(0)
    return (F.when(x < a, -2).when(x == -math.inf, -1).when(x == math.inf, buckets).otherwise(inner)).cast("int")


def exact_quantiles(df: DataFrame, cols: list[str], probs: list[float], buckets: int = 2048, max_rounds: int = 200,
                    accuracy: int = 10_000) -> dict[str, list[float | None]]:
    """The values of :func:`quantiles_and_counts`."""
    return quantiles_and_counts(df, cols, probs, buckets, max_rounds, accuracy)[0]


def quantiles_and_counts(df: DataFrame, cols: list[str], probs: list[float], buckets: int = 2048, max_rounds: int = 200,
                         accuracy: int = 10_000) -> tuple[dict[str, list[float | None]], int, dict[str, int]]:
    """``{col: [q(p) for p in probs]}`` equal to SQL ``quantile_cont`` / pandas ``quantile``; NULL and NaN are left out,
    infinities are ordinary end values. The same passes at any size; raises if a rank stays unresolved.
    With them the number of rows and of each column's values, which the first pass counts anyway."""
    cols = list(cols)
    if not cols:
        return {}, df.count(), {}
    long = _long_form(df, cols)
    stats, wanted, n_rows = _start(df, cols, probs, accuracy)
    resolved: dict[tuple[int, int], float] = {}
    for _ in range(max_rounds):
        for k, (a, b, below) in wanted.items():
            if k not in resolved and a == b and below is not None:
                resolved[k] = a
        open_ = {k: v for k, v in wanted.items() if k not in resolved}
        if not open_:
            break
        wid = {w: i for i, w in enumerate(sorted({(k[0], v[0], v[1]) for k, v in open_.items()}))}
        x, c = F.col("x"), F.col("c")
        tagged = [F.when((c == ci) & (x <= b), F.struct(F.lit(i).alias("w"), _bucket(x, a, b, buckets).alias("b")))
                  for (ci, a, b), i in wid.items()]
        hist = (long.filter(F.col("c").isin([w[0] for w in wid])).select(F.explode(F.array(*tagged)).alias("t"), "x")
                .filter(F.col("t").isNotNull()).groupBy(F.col("t.w").alias("w"), F.col("t.b").alias("b"))
                .agg(F.count("*").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")).collect())
        per_window: dict[int, list] = {}
        for r in hist:
            per_window.setdefault(r["w"], []).append((r["b"], r["n"], r["lo"], r["hi"]))
        for k, (a, b, _below) in open_.items():
            rows = sorted(per_window.get(wid[(k[0], a, b)], []))
            cum, found = 0, None
            for bucket, n, lo, hi in rows:
                if cum + n > k[1]:
                    found = None if bucket == -2 else [lo, hi, cum]
                    break
                cum += n
            # the sketch's window missed the rank: start again from the whole column
            wanted[k] = found or [stats[k[0]][1], stats[k[0]][2], None]
    if len(resolved) < len(wanted):
        raise RuntimeError(f"{len(wanted) - len(resolved)} quantile ranks unresolved after {max_rounds} rounds")
    out: dict[str, list[float | None]] = {}
    for ci, name in enumerate(cols):
        if ci not in stats:
            out[name] = [None for _ in probs]
            continue
        vals = []
        for p in probs:
            pos = p * (stats[ci][0] - 1)
            lo, hi = resolved[(ci, math.floor(pos))], resolved[(ci, math.ceil(pos))]
            vals.append(lo if lo == hi else lo + (hi - lo) * (pos - math.floor(pos)))
        out[name] = vals
    return out, n_rows, {name: stats[i][0] if i in stats else 0 for i, name in enumerate(cols)}


def approx_quantiles(df: DataFrame, cols: list[str], probs: list[float],
                     accuracy: int = 10000) -> dict[str, list[float | None]]:
    """One-pass Greenwald-Khanna sketch (``percentile_approx``); rank error <= n/accuracy."""
    if not cols:
        return {}
    row = df.agg(*[F.percentile_approx(F.col(c).cast("double"), list(probs), accuracy).alias(c)
                   for c in cols]).first()
    return {c: (list(row[c]) if row[c] is not None else [None for _ in probs]) for c in cols}


def quantiles(df: DataFrame, cols: list[str], probs: list[float], approx: bool = False):
    """Exact quantiles (default), or the sketch if the caller asks for it."""
    return approx_quantiles(df, cols, probs) if approx else exact_quantiles(df, cols, probs)
