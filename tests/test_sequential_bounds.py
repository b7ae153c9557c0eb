"""Sequential IQR bounds side by side against one column after the other."""

import math

import numpy as np
import pandas as pd
import pytest

from churnspark.operators import outliers


def one_by_one(pdf, cols, t=1.5):
    rows, steps = pdf, []
    for c in cols:
        x = rows[c].dropna()
        if len(x):
            q1, q3 = np.quantile(x, 0.25), np.quantile(x, 0.75)
            lo, hi = q1 - t * (q3 - q1), q3 + t * (q3 - q1)
            after = rows[(rows[c] >= lo) & (rows[c] <= hi)]
        else:
            lo = hi = None
            after = rows.iloc[:0]
        steps.append((c, lo, hi, len(x) - len(after), len(after)))
        rows = after
    return steps


def frame(seed, n, width, ties=False):
    """Columns that hang together, so that every bound depends on the filters before it."""
    rng = np.random.default_rng(seed)
    common = rng.standard_t(2, n)
    data = {f"c{i}": common * rng.random() + rng.standard_t(2, n) for i in range(width)}
    pdf = pd.DataFrame(data)
    if ties:
        pdf = pdf.round(0)
    for c in pdf.columns[::3]:
        pdf.loc[rng.random(n) < 0.05, c] = np.nan
    return pdf


def run(spark, pdf, **kw):
    rows = [tuple(None if math.isnan(v) else float(v) for v in r) for r in pdf.itertuples(index=False)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in pdf.columns))
    return outliers.remove_outliers(df, list(pdf.columns), **kw)


def close(a, b):
    return a == b or (a is not None and b is not None and abs(a - b) <= 1e-9 * max(1.0, abs(a)))


@pytest.mark.parametrize("seed,n,width,ties", [(1, 800, 6, False), (2, 800, 6, True), (3, 40, 5, False), (4, 1, 2, False), (5, 3000, 12, False)])
def test_equal_to_one_by_one(spark, seed, n, width, ties):
    pdf = frame(seed, n, width, ties)
    got = run(spark, pdf)
    want = one_by_one(pdf, list(pdf.columns))
    assert [(s["column"], s["outliers"], s["rows_after"]) for s in got.steps] == [(w[0], w[3], w[4]) for w in want]
    assert all(close(s["lower"], w[1]) and close(s["upper"], w[2]) for s, w in zip(got.steps, want))
    assert got.frame.count() == got.rows_after == want[-1][4]
    got.frame.unpersist()


def test_rounds_do_not_grow_with_columns(spark, monkeypatch):
    calls = []
    plain = outliers.quantiles
    monkeypatch.setattr(outliers, "quantiles", lambda *a, **k: calls.append(k["approx"]) or plain(*a, **k))
    pdf = frame(7, 1500, 24)
    got = run(spark, pdf)
    assert [s["rows_after"] for s in got.steps] == [w[4] for w in one_by_one(pdf, list(pdf.columns))]
    assert calls.count(False) <= 6


def test_empty_and_all_null(spark):
    empty = spark.createDataFrame([], "a double, b double")
    got = outliers.remove_outliers(empty, ["a", "b"])
    assert got.rows_after == 0 and got.bounds == {"a": (None, None), "b": (None, None)}
    nulls = spark.createDataFrame([(1.0, None), (2.0, None)], "a double, b double")
    got = outliers.remove_outliers(nulls, ["a", "b"])
    assert got.counts == {"a": 0, "b": 0} and got.rows_after == 0


def test_infinities_stay(spark):
    df = spark.createDataFrame([(float(i), float("inf") if i % 2 else 1.0) for i in range(20)], "a double, b double")
    got = outliers.remove_outliers(df, ["b", "a"])
    assert got.rows_after == 20 and got.bounds["b"] == (-float("inf"), float("inf"))


def test_sketches_only(spark):
    pdf = frame(9, 500, 5)
    got = run(spark, pdf, approx=True)
    rows = pdf
    for s in got.steps:
        rows = rows[(rows[s["column"]] >= s["lower"]) & (rows[s["column"]] <= s["upper"])]
        assert len(rows) == s["rows_after"]
