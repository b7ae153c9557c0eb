"""IQR outlier bounds, counts and the sequential filter."""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnspark.operators.quantiles import quantiles
from churnspark.sources.tables import normalise_nan

GUESSES = 3  # passes of sketches before the first exact bounds


def iqr_bounds(df: DataFrame, cols: list[str], threshold: float = 1.5,
               approx: bool = False) -> dict[str, tuple[float, float]]:
    """``(Q1 - t*IQR, Q3 + t*IQR)`` per column, all columns in the same passes.

    Infinite quartiles give infinite bounds, so they remove nothing on that side.
    """
    qs = quantiles(df, cols, [0.25, 0.75], approx=approx)
    return {c: _bounds(*qs[c], threshold) for c in cols}


def _bounds(q1: float | None, q3: float | None, threshold: float) -> tuple[float | None, float | None]:
    if q1 is None:
        return None, None
    iqr = q3 - q1 if q1 != q3 else 0.0
    return (q1 - threshold * iqr if math.isfinite(q1) else q1, q3 + threshold * iqr if math.isfinite(q3) else q3)


def bounds_table(spark: SparkSession, bounds: dict[str, tuple[float, float]]) -> DataFrame:
    rows = [(i, c, lo, hi) for i, (c, (lo, hi)) in enumerate(bounds.items())]
    return spark.createDataFrame(rows, "ordinal int, column string, lower double, upper double")


def outlier_counts(df: DataFrame, bounds: dict[str, tuple[float, float]]) -> dict[str, int]:
    """Rows strictly outside the bounds, per column, in one aggregation."""
    if not bounds:
        return {}
    row = df.agg(*[F.count_if((F.col(c) < lo) | (F.col(c) > hi)).alias(c)
                   for c, (lo, hi) in bounds.items()]).first()
    return {c: int(row[c]) for c in bounds}


@dataclass
class OutlierResult:
    frame: DataFrame
    bounds: dict[str, tuple[float, float]]
    counts: dict[str, int]
    rows_before: int
    rows_after: int
    steps: list[dict] = field(default_factory=list)

    @property
    def rows_removed(self) -> int:
        return self.rows_before - self.rows_after

    @property
    def percent_removed(self) -> float:
        return self.rows_removed / self.rows_before if self.rows_before else 0.0

    def summary(self, spark: SparkSession) -> DataFrame:
        """C4: one row of before / after / removed / fraction."""
        return spark.createDataFrame(
            [(self.rows_before, self.rows_after, self.rows_removed, round(self.percent_removed, 6))],
            "rows_before long, rows_after long, rows_removed long, percent_removed double")

    def steps_table(self, spark: SparkSession) -> DataFrame:
        """Per-column row: ordinal, bounds, outliers counted, rows surviving."""
        rows = [(s["ordinal"], s["column"], s["lower"], s["upper"], s["outliers"], s["rows_after"])
                for s in self.steps]
        return spark.createDataFrame(
            rows, "ordinal int, column string, lower double, upper double, outliers long, rows_after long")


def _first_failing(cols: list[str], bounds: list[tuple[float | None, float | None]]) -> Column:
    """Ordinal of the first column whose bounds a row is not in; ``len(cols)`` for a row that passes all."""
    inside = [F.col(c).between(lo, hi) if lo is not None else F.lit(False) for c, (lo, hi) in zip(cols, bounds)]
    fails = [F.when(~F.coalesce(x, F.lit(False)), i) for i, x in enumerate(inside)]
    return F.coalesce(*fails, F.lit(len(cols)))


def _reached(base: DataFrame, cols: list[str], bounds: list, start: int) -> DataFrame:
    """Each column from ``start`` on, with values only in the rows that pass the ``bounds`` of all columns before it."""
    # the columns keep their names here: the optimizer would double its constraints with each renamed one
    tagged = base.withColumn("__first", _first_failing(cols, bounds))
    return tagged.select(*[F.when(F.col("__first") >= i, F.col(cols[i])).alias(f"x{i}") for i in range(start, len(cols))])


def sequential_bounds(base: DataFrame, cols: list[str], threshold: float, approx: bool = False) -> tuple[list, list[int], list[int]]:
    """Bounds of each column from the rows that pass all columns before it, with the numbers of those rows and of
    their values; one more number of rows for the survivors of all columns.

    All columns are computed side by side under guessed bounds (sketches first, then the last round's results). A
    pass compares the rows that reach each column by the guess and by the result: up to the first column that other
    rows reach, the results are the sequential ones and stay. Every round settles at least one column, usually
    most of them, as a guess need not be exact, only select the same rows."""
    n = len(cols)

    def found(guess: list, start: int, sketch: bool) -> list:
        names = [f"x{i}" for i in range(start, n)]
        qs = quantiles(_reached(base, cols, guess, start), names, [0.25, 0.75], approx=sketch)
        return guess[:start] + [_bounds(*qs[x], threshold) for x in names]

    guess = [(-math.inf, math.inf)] * n
    for _ in range(GUESSES if n > 1 else 0):
        guess = found(guess, 0, True)
    settled = 0
    while True:
        result = found(guess, settled, approx)
        both = base.withColumns({"__guess": _first_failing(cols, guess), "__first": _first_failing(cols, result)})
        at = [F.col("__first") >= i for i in range(n + 1)]
        row = both.agg(*[F.count_if(at[i]).alias(f"rows{i}") for i in range(n + 1)],
                       *[F.count(F.when(at[i], F.col(cols[i]))).alias(f"values{i}") for i in range(n)],
                       *[F.count_if((F.col("__guess") >= i) != at[i]).alias(f"other{i}") for i in range(n)]).first()
        settled = next((i for i in range(n) if row[f"other{i}"]), n)
        if settled == n:
            return result, [row[f"rows{i}"] for i in range(n + 1)], [row[f"values{i}"] for i in range(n)]
        guess = result


def remove_outliers(df: DataFrame, cols: list[str], method: str = "iqr", threshold: float = 1.5,
                    mode: str = "sequential", approx: bool = False,
                    enabled: bool = True) -> OutlierResult:
    """Keep rows inside ``[lower, upper]`` for every column.

    ``mode='sequential'`` (reference semantics): bounds of column k come from
    the rows that survived columns 1..k-1 (:func:`sequential_bounds`); the
    input is persisted once for its passes, and the chained filters fuse into
    one predicate in the final plan.
    ``mode='joint'``: all bounds from the unfiltered rows in one set of passes.
    Any method other than 'iqr', or ``enabled=False``, passes rows through.
    A NULL or NaN in a checked column fails both comparisons: dropped, not counted.
    """
    base = normalise_nan(df).persist(StorageLevel.MEMORY_AND_DISK)
    rows_before = base.count()
    if not enabled or method != "iqr" or not cols:
        return OutlierResult(base, {}, {}, rows_before, rows_before)
    bounds, counts, steps = {}, {}, []
    current = base
    if mode == "joint":
        bounds = iqr_bounds(base, cols, threshold, approx)
        counts = outlier_counts(base, bounds)
        for c in cols:
            lo, hi = bounds[c]
            current = current.filter(F.col(c).between(lo, hi))
    else:
        found, rows, values = sequential_bounds(base, cols, threshold, approx)
        for i, (c, (lo, hi)) in enumerate(zip(cols, found)):
            bounds[c], counts[c] = (lo, hi), values[i] - rows[i + 1]
            steps.append({"ordinal": i, "column": c, "lower": lo, "upper": hi, "outliers": counts[c], "rows_after": rows[i + 1]})
            current = current.filter(F.col(c).between(lo, hi) if lo is not None else F.lit(False))
    rows_after = steps[-1]["rows_after"] if steps else current.count()
    return OutlierResult(current, bounds, counts, rows_before, rows_after, steps)
