"""Class imbalance (E1-E4): ratio gate, exact minority kNN, SMOTE synthesis.

``knn`` is :func:`churnspark.operators.neighbours.nearest`: exact, without all pairs.

SMOTE: ``n_syn = n_major - n_minor`` synthetic rows, spread evenly over the
minority rows (each gets ``n_syn // m``, the ``n_syn % m`` rows with the
smallest ``md5(seed:a:id)`` one more). Sample ``j`` of row ``i`` uses
neighbour slot ``floor(u(seed:n:i:j) * k)`` and gap ``u(seed:g:i:j)``:
``x_i + gap * (x_nbr - x_i)``. All draws are hashes of keys.

The synthetic rows come from a range that Spark splits evenly: number ``s`` is
sample ``s div m`` of the minority row with hash rank ``s mod m``, so two minority
rows against millions still fill every task. A minority row carries its own and
its neighbours' features, so the range is joined once, by rank: broadcast while the
minority is small (``BROADCAST_VALUES`` numbers), else by a shuffle in which each rank
has its even share.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnspark.functions.hashing import hash_key, uniform
from churnspark.operators.neighbours import nearest as knn
from churnspark.operators.ranking import rank_by_hash
from churnspark.session import ensure_checkpoint_dir

BROADCAST_VALUES = 4_000_000


def imbalance(df: DataFrame, label: str = "label") -> dict:
    """Class counts, majority / minority class and ``max / min`` ratio."""
    counts = {r[0]: r[1] for r in df.groupBy(label).count().collect()}
    if not counts:
        return {"counts": {}, "ratio": None, "majority": None, "minority": None}
    major = max(counts, key=lambda c: (counts[c], -c))
    minor = min(counts, key=lambda c: (counts[c], c))
    return {"counts": counts, "majority": major, "minority": minor,
            "ratio": counts[major] / counts[minor]}


def imbalance_table(df: DataFrame, label: str = "label", threshold: float = 1.5) -> DataFrame:
    """E1 / E2 as a one-row table computed in Spark."""
    c = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return c.agg(F.max("n").alias("n_majority"), F.min("n").alias("n_minority")).select(
        "n_majority", "n_minority", F.round(F.col("n_majority") / F.col("n_minority"), 6).alias("ratio"),
        (F.col("n_majority") / F.col("n_minority") > threshold).alias("resample"))


def smote(df: DataFrame, features: list[str], label: str = "label", key: str = "id", k: int = 5,
          seed: int = 42, threshold: float = 1.5, method: str = "smote") -> DataFrame:
    """Resampled training rows ``(key, syn, label, features..., is_synthetic)``.

    Passes rows through (``syn = -1``) unless ``method == 'smote'`` and the
    class ratio exceeds ``threshold``; otherwise adds synthetic minority rows up
    to parity.
    """
    info = imbalance(df, label)
    real = df.select(F.col(key), F.lit(-1).alias("syn"), F.col(label), *[F.col(c).cast("double") for c in features],
                     F.lit(False).alias("is_synthetic"))
    if method != "smote" or info["ratio"] is None or len(info["counts"]) < 2 or info["ratio"] <= threshold:
        return real
    minority = df.filter(F.col(label) == info["minority"]).select(key, *features)
    m = info["counts"][info["minority"]]
    n_syn = info["counts"][info["majority"]] - m
    k_eff = min(k, m - 1)
    if k_eff < 1:
        raise ValueError(f"SMOTE needs two rows of the minority class, there is {m}")
    base = _bases(minority, features, key, k_eff, seed)
    if m * (k_eff + 1) * len(features) <= BROADCAST_VALUES:
        base = F.broadcast(base)
    numbers = df.sparkSession.range(n_syn).select((F.col("id") % m).alias("base_rank"), F.expr(f"id div {m}").cast("int").alias("syn"))
    joined = numbers.join(base, "base_rank")
    slot = (F.floor(uniform(f"{seed}:n", F.col("base_id"), F.col("syn")) * k_eff) + 1).cast("int")
    joined = joined.withColumn("gap", uniform(f"{seed}:g", F.col("base_id"), F.col("syn"))).withColumn("nbr", F.element_at("nbrs", slot)["x"])
    synthetic = joined.select(
        F.col("base_id").alias(key), "syn", F.lit(info["minority"]).cast(df.schema[label].dataType).alias(label),
        *[(F.col("x")[i] + F.col("gap") * (F.col("nbr")[i] - F.col("x")[i])).alias(c) for i, c in enumerate(features)],
        F.lit(True).alias("is_synthetic"))
    return real.unionByName(synthetic)


def _bases(minority: DataFrame, features: list[str], key: str, k: int, seed: int) -> DataFrame:
    """``(base_rank, base_id, x, nbrs)``: each minority row by hash rank with its features and its ``k`` neighbours' features in order."""
    rows = minority.select(F.col(key).alias("base_id"), F.array(*[F.col(c).cast("double") for c in features]).alias("x"))
    ranked = rank_by_hash(rows, F.lit(1), F.substring(hash_key(f"{seed}:a", F.col("base_id")), 1, 13), "base_id", "base_rank")
    nn = knn(minority, features, k, key).select(F.col(key).alias("base_id"), "nbr_rank", "nbr_id")
    # tables of the minority's size meet by shuffles: packed vectors pass for small ones, which would go through the driver
    nn = nn.join(rows.select(F.col("base_id").alias("nbr_id"), "x").hint("merge"), "nbr_id")
    nbrs = nn.groupBy("base_id").agg(F.sort_array(F.collect_list(F.struct("nbr_rank", "x"))).alias("nbrs"))  # k entries a row
    # cuts the search's lineage: a lost executor repeats none of it, and later plans stay small
    ensure_checkpoint_dir(minority.sparkSession)
    return ranked.join(nbrs.hint("merge"), "base_id").checkpoint()
