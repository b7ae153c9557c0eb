"""Sinks and persisted model state.

Fitted state is stored as small tables next to each other so a scoring job
reloads it without refitting: ``nodes`` + ``meta`` (tree), ``scaler`` and
``categories`` (encoder). Reports are written with Spark writers.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnspark.operators.encode import PreprocessorModel
from churnspark.spec import FrameSpec


def save_preprocessor(spark: SparkSession, model: PreprocessorModel, path: str) -> None:
    """A2: scaler and category tables plus the column roles."""
    model.scaler_table(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/scaler")
    model.categories_table(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/categories")
    s = model.spec
    meta = json.dumps({"target": s.target, "id": s.id, "numeric": list(s.numeric),
                       "categorical": list(s.categorical), "ignored": list(s.ignored)})
    spark.createDataFrame([(meta,)], "meta string").coalesce(1).write.mode("overwrite").text(f"{path}/spec")


def load_preprocessor(spark: SparkSession, path: str) -> PreprocessorModel:
    """A3."""
    meta = json.loads(spark.read.text(f"{path}/spec").first()[0])
    spec = FrameSpec(meta["target"], meta["id"], tuple(meta["numeric"]), tuple(meta["categorical"]),
                     tuple(meta["ignored"]))
    sc = {r["feature"]: (r["mean"], r["std_pop"]) for r in spark.read.parquet(f"{path}/scaler").collect()}
    cats: dict[str, list] = {c: [] for c in spec.categorical}
    for r in spark.read.parquet(f"{path}/categories").orderBy("column", "slot").collect():
        cats[r["column"]].append(r["category"])
    return PreprocessorModel(spec, {k: v[0] for k, v in sc.items()}, {k: v[1] for k, v in sc.items()},
                             {k: tuple(v) for k, v in cats.items()})


def write_json(df: DataFrame, path: str) -> None:
    """A result table as JSON lines (one file: these tables are small)."""
    df.coalesce(1).write.mode("overwrite").json(path)


def write_evaluation(results: dict[str, DataFrame], path: str, metadata: dict[str, object]) -> None:
    """A4: every table of an evaluation bundle as JSON lines under its name, and ``metadata``
    (model type, row counts, shape, ...) as ``(key, value)`` rows. Curves keep their own partitions."""
    for name, df in results.items():
        if name in ("roc", "pr"):
            df.write.mode("overwrite").json(f"{path}/{name}")
        else:
            write_json(df, f"{path}/{name}")
    spark = next(iter(results.values())).sparkSession
    rows = [(k, None if v is None else str(v)) for k, v in metadata.items()]
    write_json(spark.createDataFrame(rows, "key string, value string"), f"{path}/metadata")


def write_deployment_summary(sections: dict[str, DataFrame], path: str) -> None:
    """The one-row section tables assembled into one ``(section, metric, value)`` file."""
    write_json(summary_rows(sections), path)


def write_importance_csv(imp: DataFrame, path: str) -> None:
    """A5: ``feature, importance, importance_pct`` sorted by importance, with header."""
    (imp.orderBy(F.col("importance").desc(), "feature_idx").select("feature", "importance", "importance_pct")
     .coalesce(1).write.mode("overwrite").option("header", "true").csv(path))


def write_rules_text(rules: DataFrame, path: str) -> None:
    """The rule listing as a text file in line order."""
    rules.orderBy("line_no").select("text").coalesce(1).write.mode("overwrite").text(path)


def summary_rows(sections: dict[str, DataFrame]) -> DataFrame:
    """Union of one-row tables into long-form ``(section, metric, value)`` strings."""
    out = None
    for name, df in sections.items():
        pairs = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("string").alias("value"))
                          for c in df.columns])
        part = df.select(F.lit(name).alias("section"), F.inline(pairs))
        out = part if out is None else out.unionByName(part)
    return out
