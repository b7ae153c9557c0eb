"""The scoring stream is stopped, loses its last commit and is started again: each row comes out once."""

import glob
import os

import pytest

from churnspark.operators.encode import Preprocessor
from churnspark.operators.tree import TreeParams, fit_tree
from churnspark.spec import FrameSpec
from churnspark.streaming import score_stream, scoring_plan, stream_output


@pytest.fixture(scope="module")
def fitted(spark):
    rows = [(i, float(i % 13), ["x", "y", "z"][i % 3], int(i % 4 == 0)) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, v double, c string, churn int")
    prep = Preprocessor(FrameSpec.infer(df)).fit(df)
    model = fit_tree(prep.transform(df).withColumnRenamed("churn", "label"), prep.feature_names, "label", TreeParams(max_depth=3))
    return df.drop("churn"), prep, model


def add(requests, src, low, high):
    requests.filter(f"id >= {low} and id < {high}").coalesce(1).write.mode("append").parquet(src)


def run(spark, fitted, src, out, place=None, name="restart"):
    requests, prep, model = fitted
    query = score_stream(spark, src, requests.schema, prep, model, sink="parquet", query_name=name, output_dir=out,
                         checkpoint_dir=place, finish=True, files_per_batch=1)
    assert query.awaitTermination(120)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_each_row_once_over_restarts(spark, fitted, tmp_path):
    requests, prep, model = fitted
    src, out, place = (str(tmp_path / x) for x in ("in", "out", "state"))
    for low in (0, 50, 100):
        add(requests, src, low, low + 50)
    run(spark, fitted, src, out, place)
    first = rows_of(stream_output(spark, out))
    assert first == rows_of(scoring_plan(requests.filter("id < 150"), prep, model))
    # the query was lost after its sink wrote the last batch and before the commit: that batch runs again
    last = max(glob.glob(f"{place}/commits/[0-9]*"), key=lambda f: int(os.path.basename(f)))
    os.remove(last)
    crc = os.path.join(os.path.dirname(last), f".{os.path.basename(last)}.crc")
    if os.path.exists(crc):
        os.remove(crc)
    run(spark, fitted, src, out, place)
    assert rows_of(stream_output(spark, out)) == first
    add(requests, src, 150, 300)
    run(spark, fitted, src, out, place)
    got = stream_output(spark, out)
    assert rows_of(got) == rows_of(scoring_plan(requests, prep, model)) and got.count() == 300
    run(spark, fitted, src, out, place)
    assert stream_output(spark, out).count() == 300


def test_files_without_a_commit_are_not_read(spark, fitted, tmp_path):
    requests, prep, model = fitted
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    add(requests, src, 0, 40)
    run(spark, fitted, src, out, str(tmp_path / "state"))
    # what a task of a lost batch left behind
    scoring_plan(requests.filter("id >= 40"), prep, model).coalesce(1).write.parquet(str(tmp_path / "lost"))
    for f in glob.glob(str(tmp_path / "lost" / "part-*")):
        with open(f, "rb") as a, open(os.path.join(out, os.path.basename(f)), "wb") as b:
            b.write(a.read())
    assert stream_output(spark, out).count() == 40


def test_state_lies_in_the_shared_folder(spark, fitted, tmp_path):
    requests, _, _ = fitted
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    add(requests, src, 0, 20)
    name = f"shared_{os.path.basename(str(tmp_path))}_{os.getpid()}"
    run(spark, fitted, src, out, None, name)
    add(requests, src, 20, 30)
    run(spark, fitted, src, out, None, name)
    assert stream_output(spark, out).count() == 30
    with pytest.raises(ValueError):
        score_stream(spark, src, requests.schema, fitted[1], fitted[2], sink="parquet")
