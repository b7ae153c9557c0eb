"""Stratified hash split (D3) and stratified k-fold assignment.

Which rows go to test is decided by ``md5(seed:key)``, so the same rows are
chosen on any cluster, at any partition count, and by a SQL engine. The target
may be numeric, boolean or a string; rows without a target are a class of their own.
"""

from __future__ import annotations

import math
from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnspark.functions.hashing import hash_key
from churnspark.operators.ranking import lowest_by_hash, rank_by_hash

HASH_DIGITS = 13  # 52 bits: ordering by this prefix, then by key, is the rank order


def class_counts(df: DataFrame, target: str) -> dict:
    return {r[0]: r[1] for r in df.groupBy(target).count().collect()}


def split_quotas(counts: dict, test_size: float = 0.2) -> dict:
    """Per-class test rows: ``n_test = ceil(test_size * n)`` shared by largest remainder.

    Each class gets ``floor(n_test * n_c / n)``; the leftover rows go to the
    classes with the largest fractional parts (ties: smaller class value, null first).
    """
    n = sum(counts.values())
    if n == 0:
        return {c: 0 for c in counts}
    frac = Fraction(str(test_size))
    n_test = math.ceil(frac * n) if test_size < 1 else int(test_size)
    quota = {c: n_test * k // n for c, k in counts.items()}
    rem = {c: n_test * k % n for c, k in counts.items()}  # same denominator n: integer remainders order them
    left = n_test - sum(quota.values())
    for c in sorted(counts, key=lambda c: (-rem[c], c is not None, c))[:left]:
        quota[c] += 1
    return quota


def stratified_split(df: DataFrame, target: str, key: str = "id", test_size: float = 0.2,
                     seed: int = 42) -> DataFrame:
    """Return ``df`` plus boolean ``is_test``; exactly ``quota[c]`` test rows per class."""
    quotas = split_quotas(class_counts(df, target), test_size)
    h = F.substring(hash_key(seed, F.col(key)), 1, HASH_DIGITS)
    return lowest_by_hash(df, F.col(target), h, key, quotas, "is_test")


def stratified_folds(df: DataFrame, target: str, key: str = "id", k: int = 5,
                     seed: int = 42, name: str = "fold") -> DataFrame:
    """Fold ``0..k-1``: rank inside the class by hash, modulo ``k`` (sizes differ by <= 1)."""
    h = F.substring(hash_key(f"{seed}:fold", F.col(key)), 1, HASH_DIGITS)
    ranked = rank_by_hash(df, F.col(target), h, key, "__r")
    return ranked.withColumn(name, (F.col("__r") % k).cast("int")).drop("__r")
