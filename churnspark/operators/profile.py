"""Dataset profiling (B1-B9): each result is a small DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnspark.operators.quantiles import quantiles
from churnspark.spec import FrameSpec


def shape(df: DataFrame) -> DataFrame:
    """B1: one row ``(n_rows, n_columns)``."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select("n_rows", F.lit(len(df.columns)).cast("long").alias("n_columns"))


def column_types(df: DataFrame, spec: FrameSpec | None = None) -> DataFrame:
    """``(ordinal, column, dtype, role)`` from the schema."""
    spec = spec or FrameSpec.infer(df)
    rows = [(i, f.name, f.dataType.simpleString(), spec.role_of(f.name)) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "ordinal int, column string, dtype string, role string")


def feature_type_counts(df: DataFrame, spec: FrameSpec | None = None) -> DataFrame:
    """``(role, n)`` for numeric / categorical / ignored features and the total."""
    spec = spec or FrameSpec.infer(df)
    rows = [("numeric", len(spec.numeric)), ("categorical", len(spec.categorical)),
            ("ignored", len(spec.ignored)), ("total", len(spec.features))]
    return df.sparkSession.createDataFrame(rows, "role string, n long")


def missing_counts(df: DataFrame) -> DataFrame:
    """NULLs per column in one aggregation, unpivoted to ``(column, missing)``."""
    cols = df.columns
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"m{i}") for i, c in enumerate(cols)])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("missing"))
                      for i, c in enumerate(cols)])
    return wide.select(F.inline(pairs))


def numeric_summary(df: DataFrame, spec: FrameSpec | None = None, approx: bool = False) -> DataFrame:
    """describe() of numeric columns: count, mean, sample std, min, q25, q50, q75, max.

    Moments come from one aggregation; quartiles from the exact (or sketch)
    quantile passes shared by all columns.
    """
    spec = spec or FrameSpec.infer(df)
    cols = [c for c in df.columns if c in spec.numeric or c == spec.id or
            (c == spec.target and spec.role_of(c) == "target" and
             dict(df.dtypes)[c] not in ("string",))]
    cols = [c for c in cols if dict(df.dtypes)[c] not in ("string", "boolean")]
    agg = df.agg(*[e for i, c in enumerate(cols) for e in (
        F.count(c).alias(f"n{i}"), F.avg(F.col(c).cast("double")).alias(f"a{i}"),
        F.stddev_samp(F.col(c).cast("double")).alias(f"s{i}"),
        F.min(F.col(c).cast("double")).alias(f"lo{i}"), F.max(F.col(c).cast("double")).alias(f"hi{i}"))]).first()
    qs = quantiles(df, cols, [0.25, 0.5, 0.75], approx=approx)
    rows = [(c, agg[f"n{i}"], agg[f"a{i}"], agg[f"s{i}"], agg[f"lo{i}"], qs[c][0], qs[c][1], qs[c][2], agg[f"hi{i}"])
            for i, c in enumerate(cols)]
    return df.sparkSession.createDataFrame(
        rows, "column string, count long, mean double, std double, min double, q25 double, "
              "q50 double, q75 double, max double")


def class_distribution(df: DataFrame, target: str | None = None) -> DataFrame:
    """``(class, count, share)``; NULL targets excluded (value_counts)."""
    target = target or df.columns[-1]
    counts = df.filter(F.col(target).isNotNull()).groupBy(F.col(target).alias("class")).agg(
        F.count(F.lit(1)).alias("count"))
    # the window runs over one row per class, after the aggregation
    return counts.withColumn("share", F.col("count") / F.sum("count").over(Window.partitionBy()))


def category_cardinality(df: DataFrame, spec: FrameSpec | None = None, approx: bool = False) -> DataFrame:
    """Distinct values per categorical column (HyperLogLog++ with ``approx``)."""
    spec = spec or FrameSpec.infer(df)
    cols = list(spec.categorical)
    if not cols:
        return df.sparkSession.createDataFrame([], "column string, distinct_values long")
    fn = F.approx_count_distinct if approx else F.count_distinct
    wide = df.agg(*[fn(F.col(c)).alias(f"d{i}") for i, c in enumerate(cols)])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"d{i}").cast("long").alias("distinct_values"))
                      for i, c in enumerate(cols)])
    return wide.select(F.inline(pairs))
