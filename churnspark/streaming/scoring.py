"""Stateless stream scoring (J10): request rows in, scored rows out.

The same projection as batch scoring (J1 fill, encoder, tree, clamp, label,
tier) applied to a ``readStream`` source; it is map-only, so it needs no
state store, watermark or shuffle. Stream output equals batch output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from churnspark.operators import score as J
from churnspark.operators.encode import PreprocessorModel
from churnspark.operators.tree import TreeModel
from churnspark.session import ensure_checkpoint_dir


def scoring_plan(requests: DataFrame, prep: PreprocessorModel, model: TreeModel, key: str = "id") -> DataFrame:
    """J6-J8 on any DataFrame (batch or streaming): ``key, p1, decision, risk_tier, is_fallback``.

    A row with an unusable input (NULL, NaN or infinite number, NULL category) gets
    p1 = 0.5 and ``is_fallback``: its encoded features would mean something else."""
    spec = prep.spec
    filled = J.fill_defaults(requests, list(spec.numeric), list(spec.categorical))
    unusable = J.unusable_input(list(spec.numeric), list(spec.categorical))
    enc = filled.select(F.col(key), unusable.alias("unusable_input"), *prep.feature_exprs())
    scored = model.predict(enc)
    p1, fallback = J.fallback_probability(F.when(~F.col("unusable_input"), F.col("p1")),
                                          F.when(~F.col("unusable_input"), F.col("prediction")))
    _, p1 = J.repair_probabilities(F.lit(1.0) - p1, p1)
    out = scored.select(F.col(key), J.clamp01(p1).alias("p1"), fallback.alias("is_fallback"))
    return J.label_and_tier(out)


def score_stream(spark: SparkSession, source_dir: str, schema: T.StructType, prep: PreprocessorModel,
                 model: TreeModel, sink: str = "memory", query_name: str = "scored",
                 output_dir: str | None = None, checkpoint_dir: str | None = None,
                 fmt: str = "parquet", finish: bool = False, files_per_batch: int | None = None) -> StreamingQuery:
    """Start a streaming query scoring every file that lands in ``source_dir``.

    ``sink='memory'`` registers ``query_name`` as a table (tests). Any other sink is a file format at
    ``output_dir``: the query can be stopped or lost at any time and started again by the same call. Offsets
    and commits lie in ``checkpoint_dir`` (by default a folder of ``query_name`` in the session's shared checkpoint
    folder), and the sink's own log names the files of each batch, so that a batch run twice counts once. Read
    the output with :func:`stream_output`. ``finish`` ends the query when all present files are scored.
    """
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    writer = scoring_plan(reader.load(source_dir), prep, model).writeStream.outputMode("append")
    if finish:
        writer = writer.trigger(availableNow=True)
    if sink == "memory":
        return writer.format("memory").queryName(query_name).start()
    if not output_dir:
        raise ValueError("a file sink needs output_dir")
    place = checkpoint_dir or f"{ensure_checkpoint_dir(spark).rstrip('/')}/stream-{query_name}"
    return writer.format(sink).queryName(query_name).option("path", output_dir).option("checkpointLocation", place).start()


def stream_output(spark: SparkSession, output_dir: str, sink: str = "parquet") -> DataFrame:
    """The committed rows of a file sink: files that its log does not name are not read."""
    return spark.read.format(sink).load(output_dir)
