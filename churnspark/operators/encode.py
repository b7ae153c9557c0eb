"""Feature preparation (D1, D2, D4-D7): z-scores and drop-first one-hot.

``Preprocessor.fit`` runs one aggregation for the moments and one for the
category lists (both tiny results); ``PreprocessorModel.transform`` is a
single projection of built-in expressions with the fitted values as
literals -- map-only, no shuffle, whole-stage codegen.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnspark.spec import FrameSpec

Z_DIGITS = 9  # z-scores rounded so split thresholds agree across engines


@dataclass(frozen=True)
class PreprocessorModel:
    spec: FrameSpec
    means: dict[str, float]
    stds: dict[str, float]          # population std, 0 replaced by 1
    categories: dict[str, tuple[str, ...]]  # sorted; the first is dropped

    @property
    def feature_names(self) -> list[str]:
        names = list(self.spec.numeric)
        for c in self.spec.categorical:
            names += [f"{c}_{v}" for v in self.categories[c][1:]]
        return names

    def feature_exprs(self) -> list[Column]:
        out = []
        for c in self.spec.numeric:
            z = (F.col(c).cast("double") - F.lit(self.means[c])) / F.lit(self.stds[c])
            out.append(F.coalesce(F.round(z, Z_DIGITS), F.lit(0.0)).alias(c))
        for c in self.spec.categorical:
            for v in self.categories[c][1:]:
                out.append(F.when(F.col(c) == v, F.lit(1.0)).otherwise(F.lit(0.0)).alias(f"{c}_{v}"))
        return out

    def transform(self, df: DataFrame, keep: list[str] | None = None) -> DataFrame:
        """Encoded features after ``keep`` columns (default: id and target if present).

        Unknown categories encode as all zeros; a NULL numeric becomes 0 (the
        training mean) so trees and distances never see NULL.
        """
        if keep is None:
            keep = [c for c in (self.spec.id, self.spec.target) if c and c in df.columns]
        return df.select(*keep, *self.feature_exprs())

    def dictionary(self, spark: SparkSession) -> DataFrame:
        """``(feature_idx, feature)``."""
        return spark.createDataFrame(list(enumerate(self.feature_names)), "feature_idx int, feature string")

    def scaler_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(c, self.means[c], self.stds[c]) for c in self.spec.numeric],
                                     "feature string, mean double, std_pop double")

    def categories_table(self, spark: SparkSession) -> DataFrame:
        rows = [(c, v, i) for c in self.spec.categorical for i, v in enumerate(self.categories[c])]
        return spark.createDataFrame(rows, "column string, category string, slot int")


class Preprocessor:
    """Numeric block (z-score, population std) then categorical block (one-hot, drop first)."""

    def __init__(self, spec: FrameSpec, max_categories: int = 1000):
        self.spec = spec
        self.max_categories = max_categories

    def fit(self, df: DataFrame) -> PreprocessorModel:
        spec = self.spec
        means, stds = {}, {}
        if spec.numeric:
            row = df.agg(*[e for i, c in enumerate(spec.numeric) for e in (
                F.avg(F.col(c).cast("double")).alias(f"m{i}"),
                F.stddev_pop(F.col(c).cast("double")).alias(f"s{i}"))]).first()
            for i, c in enumerate(spec.numeric):
                m, s = row[f"m{i}"], row[f"s{i}"]
                means[c] = 0.0 if m is None else float(m)
                stds[c] = 1.0 if (s is None or s == 0.0) else float(s)
        cats = {c: () for c in spec.categorical}
        if spec.categorical:
            pairs = F.array(*[F.struct(F.lit(i).alias("ci"), F.col(c).cast("string").alias("v"))
                              for i, c in enumerate(spec.categorical)])
            distinct = (df.select(F.inline(pairs)).filter(F.col("v").isNotNull()).distinct())
            distinct = distinct.persist()
            sizes = {r["ci"]: r["n"] for r in distinct.groupBy("ci").agg(F.count(F.lit(1)).alias("n")).collect()}
            for i, c in enumerate(spec.categorical):
                if sizes.get(i, 0) > self.max_categories:
                    distinct.unpersist()
                    raise ValueError(f"column {c!r} has {sizes[i]} categories (> {self.max_categories})")
            # only bounded category lists ever reach the driver
            capped = distinct.collect()
            distinct.unpersist()
            found: dict[int, list[str]] = {}
            for r in capped:
                found.setdefault(r["ci"], []).append(r["v"])
            for i, c in enumerate(spec.categorical):
                cats[c] = tuple(sorted(found.get(i, [])))
        return PreprocessorModel(spec, means, stds, cats)
