from pyspark.sql import functions as F

from churnspark.operators.outliers import remove_outliers
from churnspark.operators.quantiles import exact_quantiles
from churnspark.sources import churn_frame
from churnspark.spec import FrameSpec
from conftest import SF001, SF01


def test_frame_and_sequential_outliers_match_fixture(spark):
    fr = churn_frame(spark, SF001)
    spec = FrameSpec.infer(fr)
    assert fr.columns[-1] == "churn" and spec.id == "id"
    assert spec.numeric == ("acctbal", "order_count", "spend", "urgent_count", "tenure_days", "quantity", "returned_count")
    res = remove_outliers(fr, list(spec.numeric))
    assert res.rows_before == 150
    assert fr.filter("churn = 1").count() == 32
    assert list(res.counts.values()) == [0, 0, 1, 11, 6, 2, 0]
    after = {r[0]: r[1] for r in res.frame.groupBy("churn").count().collect()}
    assert after == {0: 102, 1: 28}
    assert sum(res.counts.values()) == res.rows_removed  # no NULLs in the frame


def test_joint_mode_and_switch(spark):
    fr = churn_frame(spark, SF001)
    spec = FrameSpec.infer(fr)
    off = remove_outliers(fr, list(spec.numeric), enabled=False)
    assert off.rows_after == off.rows_before == 150
    other = remove_outliers(fr, list(spec.numeric), method="zscore")  # unknown method: pass-through
    assert other.rows_after == 150
    joint = remove_outliers(fr, list(spec.numeric), mode="joint")
    assert joint.rows_after <= 150


def test_refinement_quantiles_equal_duckdb(spark):
    import duckdb
    fr = churn_frame(spark, SF01)
    cols = ["acctbal", "spend", "order_count", "tenure_days"]
    probs = [0.0, 0.25, 0.5, 0.75, 1.0]
    refined = exact_quantiles(fr, cols, probs, buckets=16)  # small buckets force several passes
    pdf = fr.select(*cols).toPandas()
    for c in cols:
        ddb = duckdb.sql(f"SELECT quantile_cont({c}, {probs}) FROM pdf").fetchall()[0][0]
        for a, d in zip(refined[c], ddb):
            assert abs(a - d) <= 1e-9 * max(1.0, abs(d))


def test_nan_is_dropped_not_counted(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(20)] + [(99, float("nan"))], "id long, x double")
    from churnspark.sources import normalise_nan
    res = remove_outliers(normalise_nan(df), ["x"])
    assert res.counts["x"] == 0 and res.rows_after == 20


def test_infinity_and_nan_are_ordered_ends_and_missing(spark):
    values = [float(i) for i in range(1, 40)] + [float("inf")]
    df = spark.createDataFrame(list(enumerate(values)), "id long, x double")
    res = remove_outliers(df, ["x"])
    assert res.bounds["x"] == (-18.5, 59.5) and res.rows_after == 39
    ends = spark.createDataFrame([(float("-inf"),), (float("inf"),), (2.0,)], "x double")
    assert exact_quantiles(ends, ["x"], [0.0, 0.5, 1.0])["x"] == [float("-inf"), 2.0, float("inf")]
    some = spark.createDataFrame([(i, float(i)) for i in range(1, 40)] + [(100 + i, float("nan")) for i in range(4)], "id long, x double")
    res = remove_outliers(some, ["x"])
    assert res.bounds["x"] == (-18.0, 58.0) and res.rows_after == 39


def test_a_sketch_window_that_misses_is_widened(spark):
    df = spark.range(5000).selectExpr("cast(id * id % 4999 as double) as x")
    got = exact_quantiles(df, ["x"], [0.25, 0.9], accuracy=3)["x"]
    values = sorted(i * i % 4999 for i in range(5000))
    assert got == [values[1249] + 0.75 * (values[1250] - values[1249]), values[4499] + 0.1 * (values[4500] - values[4499])] or \
        all(abs(a - b) < 1e-6 for a, b in zip(got, [values[1249] + 0.75 * (values[1250] - values[1249]), values[4499] + 0.1 * (values[4500] - values[4499])]))


def test_customers_and_lines_do_not_pass_the_driver(spark, tmp_path):
    """Only the nations are broadcast, however small the files of the other tables are."""
    tables = {
        "customer": ([(i, 10.0 * i, "BUILDING", i % 2) for i in range(1, 7)], "c_custkey long, c_acctbal double, c_mktsegment string, c_nationkey int"),
        "nation": ([(0, "PERU"), (1, "CHINA")], "n_nationkey int, n_name string"),
        "orders": ([(10 * c + k, c, 100.0 + k, f"199{k}-01-01", "1-URGENT") for c in range(1, 6) for k in range(c % 3 + 1)] + [(99, 1, 5.0, "1997-01-01", "5-LOW")],
                   "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate string, o_orderpriority string"),
        "lineitem": ([(10 * c, 2.0 * c, "R") for c in range(1, 6)] + [(10, 1.0, "N")], "l_orderkey long, l_quantity double, l_returnflag string")}
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / f"{name}.parquet"))
    fr = churn_frame(spark, str(tmp_path))
    got = {r["id"]: (r["order_count"], r["quantity"], r["returned_count"], r["nation"], r["churn"]) for r in fr.collect()}
    assert got == {1: (2, 3.0, 1, "CHINA", 0), 2: (3, 4.0, 1, "PERU", 1), 3: (1, 6.0, 1, "CHINA", 1),
                   4: (2, 8.0, 1, "PERU", 1), 5: (3, 10.0, 1, "CHINA", 1)}
    final = fr._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("BroadcastHashJoin") == 1 and final.count("SortMergeJoin") == 2
