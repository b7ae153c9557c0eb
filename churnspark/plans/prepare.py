"""Full preparation pipeline (D8): scan -> profile -> outliers -> split -> encode -> resample."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnspark.operators.balance import imbalance, smote
from churnspark.operators.encode import Preprocessor, PreprocessorModel
from churnspark.operators.outliers import OutlierResult, remove_outliers
from churnspark.operators.split import stratified_split
from churnspark.spec import FrameSpec


@dataclass
class Prepared:
    spec: FrameSpec
    outliers: OutlierResult
    split: DataFrame          # cleaned rows + is_test
    model: PreprocessorModel
    train: DataFrame          # encoded: id, label, features
    test: DataFrame           # encoded: id, label, features
    resampled: DataFrame      # encoded train after SMOTE: id, syn, label, features, is_synthetic
    imbalance: dict

    @property
    def features(self) -> list[str]:
        return self.model.feature_names


def prepare(df: DataFrame, target: str | None = None, id_col: str | None = "id", test_size: float = 0.2,
            handle_outliers: bool = True, seed: int = 42, resample: str = "smote",
            imbalance_threshold: float = 1.5, k_neighbors: int = 5, outlier_mode: str = "sequential",
            max_categories: int = 1000) -> Prepared:
    """The reference's preparation order, each fitted step on the rows it should see:
    outlier bounds on all rows, categories and moments on the train split only,
    resampling on the encoded train split only."""
    spec = FrameSpec.infer(df, target, id_col)
    if spec.id is None:
        raise ValueError("a key column is needed: split and resampling are hashes of it")
    if missing := df.filter(F.col(spec.target).isNull()).count():
        raise ValueError(f"{missing} rows have no {spec.target}; remove or label them first")
    # prune to the columns any step uses before anything is cached
    df = df.select(spec.id, *spec.numeric, *spec.categorical, spec.target)
    out = remove_outliers(df, list(spec.numeric), enabled=handle_outliers, mode=outlier_mode)
    split = stratified_split(out.frame, spec.target, spec.id,
                             test_size, seed).persist(StorageLevel.MEMORY_AND_DISK)
    train_raw = split.filter(~F.col("is_test"))
    pm = Preprocessor(spec, max_categories).fit(train_raw)
    enc_cols = [F.col(spec.id).alias("id"), F.col(spec.target).cast("int").alias("label")]
    train = train_raw.select(*enc_cols, *pm.feature_exprs()).persist(StorageLevel.MEMORY_AND_DISK)
    test = split.filter(F.col("is_test")).select(*enc_cols, *pm.feature_exprs())
    info = imbalance(train, "label")
    resampled = smote(train, pm.feature_names, "label", "id", k_neighbors, seed, imbalance_threshold,
                      resample).persist(StorageLevel.MEMORY_AND_DISK)
    return Prepared(spec, out, split, pm, train, test, resampled, info)
