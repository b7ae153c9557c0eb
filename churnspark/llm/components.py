"""Connected components of an edge table by alternating star contraction.

Large star: every node sends its larger neighbours to its smallest neighbour
(itself included). Small star: every node sends its smaller neighbours and
itself to the smallest of them. Both keep components and shorten paths; after
O(log n) rounds all edges point at their component's smallest node. A node's
minimum is a map-side combined aggregation; nothing is gathered per node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnspark.llm.common import cut_lineage


def _pairs(df: DataFrame, *pairs: tuple[str, str]) -> DataFrame:
    """Rows ``(u, v)`` from pairs of columns."""
    return df.select(F.inline(F.array(*[F.struct(F.col(a).alias("u"), F.col(b).alias("v")) for a, b in pairs])))


def _star(edges: DataFrame) -> DataFrame:
    """One large star and one small star over ``(u, v)`` with u > v."""
    both = _pairs(edges, ("u", "v"), ("v", "u"))
    least = both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("m"))
    least = least.select("node", F.least("node", "m").alias("m"))
    large = _pairs(both.filter("v > u").join(least, F.col("u") == F.col("node")), ("v", "m")).filter("u > v").distinct()
    low = large.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("m"))
    small = large.join(low, F.col("u") == F.col("node"))
    return _pairs(small, ("v", "m"), ("u", "m")).filter("u > v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges (u, v)``; root is the component's smallest node."""
    now = cut_lineage(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u > v").distinct())
    state = None
    while True:
        now = cut_lineage(_star(now))
        # Finished when all edges point from a node straight at a root: no edge ends where another begins, one edge a node.
        seen = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("u").cast("decimal(38,0)")).alias("su"),
                       F.sum(F.col("v").cast("decimal(38,0)")).alias("sv")).first()
        if not seen["n"] or seen == state:
            break
        state = seen
    return _pairs(now, ("u", "v"), ("v", "v")).distinct().select(F.col("u").alias("node"), F.col("v").alias("root"))
