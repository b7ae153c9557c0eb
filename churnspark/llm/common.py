"""Small helpers shared by the text operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnspark.session import ensure_checkpoint_dir

#: A-Z and their lower-case forms; other letters keep their case.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` does not have (compared without case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def col(name: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def cut_lineage(df: DataFrame) -> DataFrame:
    """``checkpoint()`` into the shared folder that ``spark.checkpoint.dir`` names."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read again: cuts lineage like a checkpoint and is smaller."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Let Arrow batches to Python hold at most ``rows`` documents, so that a batch of long texts fits a worker."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) <= 0 or int(spark.conf.get(key)) > rows:
        spark.conf.set(key, str(rows))


def crc32_of_id(doc_id: Column) -> Column:
    """crc32 of the id's decimal text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` as UTF-8; ``bytes.split`` cuts at exactly those six characters."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def per_text(spark: SparkSession, schema: str,
             f: Callable[[str | None], tuple]) -> Callable[[Column], Column]:
    """A column function that applies ``f`` to each text and gives a struct of ``schema`` (``"a long, b string"``).

    Texts travel in Arrow batches of bounded size; ``f`` sees one whole text at a time."""
    small_batches(spark)
    kinds = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "double": pa.float64()}
    fields = [(name, kinds[kind]) for name, kind in (x.split() for x in schema.split(", "))]

    @F.arrow_udf(schema)
    def applied(texts: pa.Array) -> pa.Array:
        rows = [f(x.as_py()) for x in texts]
        columns = zip(*rows) if rows else [()] * len(fields)
        return pa.StructArray.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, fields)], [n for n, _ in fields])

    # "nondeterministic" keeps the optimizer from running it twice, once for a filter on the result and once for the rest
    return applied.asNondeterministic()


_BUILT: dict[Callable, tuple] = {}


def built(make: Callable, value: object) -> object:
    """``make(value)``, kept in the worker process for later tasks with the same (broadcast) ``value``.

    ``make`` is a name in a module. Tasks reach this cache by this function's name; a dict that the task's own
    function names would be copied with it, empty, to every task."""
    have = _BUILT.get(make)
    if have is None or have[0] is not value:
        have = _BUILT[make] = (value, make(value))
    return have[1]
