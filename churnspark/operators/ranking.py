"""Exact ranks by hash inside groups, without a global sort or a one-task window.

Rows are ordered inside their group by ``(h, key)``, ``h`` a hexadecimal hash of
the key. Its first ``PREFIX`` digits cut every group into up to 65,536 buckets of
nearly equal size whatever the keys look like, and a histogram of the buckets
(one partially aggregated count) says how many rows come before each. So

* ``lowest_by_hash`` marks a group's first rows: whole buckets are decided by
  their prefix alone, map-side; only the one bucket that holds the boundary is
  ranked, about a 65,536th of the group;
* ``rank_by_hash`` adds a bucket's offset to the rank inside the bucket: one
  shuffle on (group, prefix), no range sampling, no checkpoint.

Groups are compared as values of their own type, null as a group of its own, so
integer, boolean, string and null groups behave alike. Rows with equal keys have
equal hashes; their order among themselves is undefined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PREFIX = 4


def _named(df: DataFrame, group: Column, h: Column, key: str) -> DataFrame:
    return df.select("*", group.alias("__g"), h.alias("__h"), F.col(key).alias("__k")).withColumn(
        "__p", F.substring("__h", 1, PREFIX))


def _histogram(keyed: DataFrame) -> DataFrame:
    """``(hg, hp, n, before)``: rows of each bucket and of the group's buckets before it."""
    w = Window.partitionBy("hg").orderBy("hp").rowsBetween(Window.unboundedPreceding, -1)
    counts = keyed.groupBy(F.col("__g").alias("hg"), F.col("__p").alias("hp")).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("before", F.coalesce(F.sum("n").over(w), F.lit(0)))


def rank_by_hash(df: DataFrame, group: Column, h: Column, key: str, name: str = "rank") -> DataFrame:
    """Add 0-based ``name`` = position of the row inside its ``group`` by ``(h, key)``."""
    keyed = _named(df, group, h, key)
    offsets = _histogram(keyed)
    joined = keyed.join(offsets, F.col("__g").eqNullSafe(F.col("hg")) & (F.col("__p") == F.col("hp")))
    w = Window.partitionBy("__g", "__p").orderBy("__h", "__k")
    return joined.select(*df.columns, (F.col("before") + F.row_number().over(w) - 1).alias(name))


def lowest_by_hash(df: DataFrame, group: Column, h: Column, key: str, quotas: dict, name: str) -> DataFrame:
    """Add boolean ``name``: the row is among the ``quotas[group]`` first of its ``group`` by ``(h, key)``."""
    keyed = _named(df, group, h, key)
    spark, kind = df.sparkSession, keyed.schema["__g"].dataType.simpleString()
    wanted = spark.createDataFrame([(g, int(q)) for g, q in quotas.items()], f"qg {kind}, quota long")
    edge = _histogram(keyed).join(F.broadcast(wanted), F.col("hg").eqNullSafe(F.col("qg"))).filter(
        (F.col("before") < F.col("quota")) & (F.col("quota") <= F.col("before") + F.col("n")))
    edge = edge.select("hg", F.col("hp").alias("ep"), (F.col("quota") - F.col("before")).alias("need"))
    # one row a group: groups are classes, whose quotas came from the driver
    met = keyed.join(F.broadcast(edge), F.col("__g").eqNullSafe(F.col("hg")), "left")
    at_edge = F.coalesce(F.col("__p") == F.col("ep"), F.lit(False))
    sure = met.filter(~at_edge).select(*df.columns, F.coalesce(F.col("__p") < F.col("ep"), F.lit(False)).alias(name))
    w = Window.partitionBy("__g").orderBy("__h", "__k")
    ranked = met.filter(at_edge).select(*df.columns, (F.row_number().over(w) <= F.col("need")).alias(name))
    return sure.unionByName(ranked)
