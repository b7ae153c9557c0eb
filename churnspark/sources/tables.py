"""Table scans and the customer churn frame derived from the order tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """Parquet scan; selecting ``columns`` here lets the reader prune the rest."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def normalise_nan(df: DataFrame) -> DataFrame:
    """NaN -> NULL in floating columns.

    Spark orders NaN above every number, so ``NaN > upper_bound`` would be TRUE
    and the outlier filter would count it; as NULL it fails both comparisons
    and is dropped uncounted, like a missing value.
    """
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(F.nanvl(F.col(f.name), F.lit(None).cast(f.dataType)).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def load_frame(spark: SparkSession, path: str, fmt: str = "parquet",
               schema: T.StructType | str | None = None, **options) -> DataFrame:
    """Generic customer-table scan (A1): parquet / csv / json / orc, NaN normalised.

    CSV without a schema is inferred (header on); pass ``schema`` in production.
    """
    reader = spark.read.format(fmt).options(**options)
    if fmt == "csv":
        reader = reader.option("header", options.get("header", "true"))
        if schema is None:
            reader = reader.option("inferSchema", "true")
    if schema is not None:
        reader = reader.schema(schema)
    return normalise_nan(reader.load(path))


FRAME_COLUMNS = ["id", "acctbal", "order_count", "spend", "urgent_count", "tenure_days",
                 "quantity", "returned_count", "segment", "nation", "churn"]


def churn_frame(spark: SparkSession, sf_dir: str, horizon_days: int = 365) -> DataFrame:
    """One row per customer with an order before ``cut = max(order date) - horizon``.

    Features use only orders before the cut, the label only orders from the
    cut on. Plan shape: lineitem is pre-aggregated per order (partial
    aggregation before the shuffle), joined to orders on the same key (the
    aggregate's partitioning is reused), aggregated once per customer in a
    single pass that yields both features and label, then joined to customer
    and the 25-row nation dimension (broadcast by Catalyst's size check). Lines
    and customers are joined by shuffles at any size: Catalyst judges them by
    file size, and their rows would go through the driver.
    """
    orders = read_table(spark, sf_dir, "orders",
                        ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority"])
    orders = orders.select(
        "o_orderkey", "o_custkey",
        F.col("o_totalprice").cast("decimal(18,2)").alias("price"),
        F.to_date("o_orderdate").alias("d"),
        (F.col("o_orderpriority") == "1-URGENT").alias("urgent"),
    )
    cut = orders.select(F.date_sub(F.max("d"), horizon_days)).scalar()

    lines = (read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_quantity", "l_returnflag"])
             .groupBy("l_orderkey")
             .agg(F.sum(F.col("l_quantity").cast("decimal(18,2)")).alias("qty"),
                  F.count_if(F.col("l_returnflag") == "R").alias("ret")))

    # the cut-off flag is projected once, so the scalar subquery runs once
    orders = orders.withColumn("before", F.col("d") < cut)
    before = F.col("before")
    per_customer = (
        orders.join(lines.hint("merge"), orders.o_orderkey == lines.l_orderkey, "left")
        .groupBy("o_custkey")
        .agg(
            F.count_if(before).alias("order_count"),
            F.sum(F.when(before, F.col("price"))).alias("spend"),
            F.count_if(before & F.col("urgent")).alias("urgent_count"),
            F.datediff(F.max(F.when(before, F.col("d"))), F.min(F.when(before, F.col("d")))).alias("tenure_days"),
            F.sum(F.when(before, F.col("qty"))).alias("quantity"),
            F.sum(F.when(before, F.col("ret"))).alias("returned_count"),
            F.count_if(~before).alias("after_count"),
        )
        .filter(F.col("order_count") > 0)
    )
    customer = read_table(spark, sf_dir, "customer", ["c_custkey", "c_acctbal", "c_mktsegment", "c_nationkey"])
    nation = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name"])
    frame = (
        customer.join(per_customer.hint("merge"), customer.c_custkey == per_customer.o_custkey, "inner")
        .join(nation, customer.c_nationkey == nation.n_nationkey, "left")
        .select(
            F.col("c_custkey").cast("long").alias("id"),
            F.col("c_acctbal").cast("double").alias("acctbal"),
            F.col("order_count").cast("long").alias("order_count"),
            F.col("spend").cast("double").alias("spend"),
            F.col("urgent_count").cast("long").alias("urgent_count"),
            F.col("tenure_days").cast("long").alias("tenure_days"),
            F.coalesce(F.col("quantity").cast("double"), F.lit(0.0)).alias("quantity"),
            F.coalesce(F.col("returned_count"), F.lit(0)).cast("long").alias("returned_count"),
            F.col("c_mktsegment").alias("segment"),
            F.col("n_name").alias("nation"),
            F.when(F.col("after_count") == 0, 1).otherwise(0).cast("int").alias("churn"),
        )
    )
    return normalise_nan(frame)
