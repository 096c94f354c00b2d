import hashlib
from datetime import date
from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerline.functions import distinct_months, hash_bucket, round_ratio, safe_ratio, years_apart
from ledgerline.functions.dates import months_before


def test_months_before_clamps():
    assert months_before(date(2024, 12, 31), 6) == date(2024, 6, 30)
    assert months_before(date(2024, 3, 31), 1) == date(2024, 2, 29)
    assert months_before(date(2024, 12, 31), 12) == date(2023, 12, 31)
    assert months_before(date(2024, 1, 15), 25) == date(2021, 12, 15)


def test_round_ratio_is_exact(spark):
    pairs = [(n, d) for n in (-1005, -25, -5, -1, 0, 1, 5, 25, 333, 1005, 10**12 + 5) for d in (-8, 1, 3, 8, 20, 160, 1000)]
    df = spark.createDataFrame(pairs, "n bigint, d bigint")
    for digits in (1, 2, 3):
        unit = Decimal(1).scaleb(-digits)
        for r in df.withColumn("q", round_ratio(F.col("n"), F.col("d"), digits)).collect():
            assert r.q == (Decimal(r.n) / Decimal(r.d)).quantize(unit, ROUND_HALF_UP), (r, digits)


def test_ratios_by_zero(spark):
    df = spark.createDataFrame([(1, 0), (1, None), (None, 1)], "n bigint, d bigint")
    for r in df.select(round_ratio(F.col("n"), F.col("d"), 2).alias("a"), safe_ratio(F.col("n"), F.col("d")).alias("b")).collect():
        assert r.a is None and r.b is None


def test_years_apart_counts_boundaries(spark):
    df = spark.createDataFrame([(date(2024, 1, 1), date(2023, 12, 31)), (date(2024, 12, 31), date(2024, 1, 1))], "a date, b date")
    assert [r[0] for r in df.select(years_apart(F.col("a"), F.col("b"))).collect()] == [1, 0]


def test_hash_bucket_is_md5(spark):
    got = spark.range(200).select("id", hash_bucket(F.col("id"), 97).alias("b")).collect()
    for r in got:
        assert r.b == int(hashlib.md5(str(r.id).encode()).hexdigest()[:15], 16) % 97


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.dates(date(1900, 1, 1), date(2300, 1, 1))), min_size=1, max_size=60))
def test_distinct_months_equals_count_distinct(spark, rows):
    df = spark.createDataFrame(rows, "k int, d date")
    got = df.groupBy("k").agg(
        distinct_months(F.col("d")).alias("a"),
        F.count_distinct(F.trunc("d", "MM")).alias("b"))
    assert got.filter("a <> b").count() == 0


def test_distinct_months_has_no_last_month(spark):
    df = spark.createDataFrame([(date(2023, 11, 30),), (date(2035, 1, 1),), (date(9999, 12, 31),), (date(2035, 1, 9),), (None,)], "d date")
    assert df.agg(distinct_months(F.col("d"))).first()[0] == 3
