"""Column roles of a customer table (id, target, numeric, categorical, ignored)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType,
                 T.FloatType, T.DoubleType, T.DecimalType)


@dataclass(frozen=True)
class FrameSpec:
    """Roles derived from the schema: target defaults to the last column,
    ``id`` is dropped from the features whatever its type, boolean and
    temporal columns are ignored (they are neither numeric nor categorical)."""

    target: str
    id: str | None
    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    ignored: tuple[str, ...] = ()

    @property
    def features(self) -> tuple[str, ...]:
        return self.numeric + self.categorical

    @staticmethod
    def infer(df: DataFrame, target: str | None = None, id_col: str | None = "id") -> "FrameSpec":
        fields = df.schema.fields
        target = target or fields[-1].name
        if id_col is not None and id_col not in df.columns:
            id_col = None
        numeric, categorical, ignored = [], [], []
        for f in fields:
            if f.name in (target, id_col):
                continue
            if isinstance(f.dataType, NUMERIC_TYPES):
                numeric.append(f.name)
            elif isinstance(f.dataType, T.StringType):
                categorical.append(f.name)
            else:
                ignored.append(f.name)
        return FrameSpec(target, id_col, tuple(numeric), tuple(categorical), tuple(ignored))

    def role_of(self, name: str) -> str:
        if name == self.target:
            return "target"
        if name == self.id:
            return "id"
        if name in self.numeric:
            return "numeric"
        if name in self.categorical:
            return "categorical"
        return "ignored"
