import random

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerline.operators.groups import latest_per_key
from ledgerline.operators.ntile import with_ntile
from ledgerline.session import materialise


def _brute(df, column):
    return F.ntile(5).over(W.orderBy(F.col(column).asc_nulls_first(), "id"))


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 6, 7, 9, 10, 11, 59])
def test_ntile_small_sizes(spark, n):
    df = spark.range(n).select(F.format_string("C%04d", "id").alias("id"), (F.col("id") * 7 % 3).alias("v"))
    df = materialise(df, "small")
    got = with_ntile(df, 5, {"tile": "v"}, "id").withColumn("want", _brute(df, "v"))
    assert got.filter("tile <> want").count() == 0
    assert got.count() == n


def test_ntile_empty(spark):
    df = spark.createDataFrame([], "id string, v int")
    assert with_ntile(df, 5, {"tile": "v"}, "id").count() == 0


def test_ntile_narrows_through_heavy_ties(spark):
    """A third of the rows share one value; ranges must narrow on the tie column."""
    rng = random.Random(5)
    rows = [
        (f"C{i:06d}", 7 if rng.random() < 0.34 else rng.randrange(13), rng.randrange(10**6) / 100,
         None if rng.random() < 0.3 else rng.randrange(50))
        for i in rng.sample(range(10**6), 6_007)
    ]
    df = materialise(
        spark.createDataFrame(rows, "id string, months int, money double, gaps int")
        .withColumn("money", F.col("money").cast("decimal(18,2)")), "ties")
    columns = {"a": "months", "b": "money", "c": "gaps"}
    got = with_ntile(df, 5, columns, "id", sort_limit=60, sample_rows=150)
    for name, source in columns.items():
        got = got.withColumn(f"want_{name}", _brute(df, source))
    assert got.filter(" or ".join(f"{c} <> want_{c}" for c in columns)).count() == 0
    for name in columns:
        sizes = [r["count"] for r in got.groupBy(name).count().collect()]
        assert max(sizes) - min(sizes) <= 1


def test_ntile_plan_has_no_single_partition(spark):
    df = materialise(spark.range(1000).selectExpr("cast(id as string) id", "id % 13 v"), "plan")
    plan = with_ntile(df, 5, {"tile": "v"}, "id")._jdf.queryExecution().toString()
    assert "SinglePartition" not in plan and "Exchange" not in plan


def test_latest_per_key(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 3, "y"), ("a", 2, "z"), ("b", 1, None)], "k string, ts int, v string")
    got = {r.k: (r.ts, r.v) for r in latest_per_key(df, ["k"], ["ts"]).collect()}
    assert got == {"a": (3, "y"), "b": (1, None)}


def test_ntile_refuses_a_repeated_tie(spark):
    df = materialise(spark.range(3000).selectExpr("'same' as id", "1 as v"), "same")
    with pytest.raises(ValueError, match="id must be unique"):
        with_ntile(df, 3, {"t": "v"}, tie="id", sort_limit=500, sample_rows=100)
