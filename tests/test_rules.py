"""Rule tables at their edges."""

import itertools
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerline import rules
from ledgerline.plans import aml, churn_model, rfm


def _by_hand(r, f, m):
    if r == 5 and f >= 4 and m >= 4:
        return "Champions"
    if f >= 4 and m >= 3:
        return "Loyal Customers"
    if r >= 4:
        if f in (2, 3):
            return "Potential Loyalists"
        if f == 1:
            return "New Customers" if r == 5 else "Promising"
        return "Others"  # f >= 4 with little spend
    if r == 3 and f >= 3 and m >= 3:
        return "Need Attention"
    if r in (2, 3) and f <= 2:
        return "About To Sleep"
    if r <= 2 and f >= 3 and m >= 3:
        return "At Risk"
    if r == 1 and f <= 2:
        return "Hibernating"
    return "Others"


def test_all_125_scores(spark):
    triples = list(itertools.product(range(1, 6), repeat=3))
    df = spark.createDataFrame(triples, "r int, f int, m int").withColumn(
        "label", rfm.segment_label(F.col("r"), F.col("f"), F.col("m")))
    got = {(x.r, x.f, x.m): x.label for x in df.collect()}
    assert got == {t: _by_hand(*t) for t in triples}
    assert "Cannot Lose Them" not in got.values()
    assert [s[0] for s in rules.RFM_SEGMENTS if s[0] not in got.values()] == ["Cannot Lose Them"]


def test_structuring_severity(spark):
    rows = [(5, "40000.01", "Critical"), (5, "40000.00", "High"), (4, "90000.00", "High"), (3, "25000.01", "High"),
            (3, "25000.00", "Medium"), (2, "15000.01", "Medium"), (2, "15000.00", "Low"), (1, "50000.00", "Low")]
    df = spark.createDataFrame([(n, Decimal(t), w) for n, t, w in rows], "n int, t decimal(18,2), want string")
    got = df.withColumn("got", aml.structuring_severity(F.col("n"), F.col("t")))
    assert got.filter("got <> want").count() == 0


def test_churn_tiers(spark):
    rows = [(0.75, "Imminent (75%+)"), (0.7499, "High Risk (50-75%)"), (0.5, "High Risk (50-75%)"),
            (0.25, "At Risk (25-50%)"), (0.2499, "Low Risk (<25%)"), (0.0, "Low Risk (<25%)")]
    df = spark.createDataFrame(rows, "p double, want string")
    assert df.filter(churn_model.churn_tier(F.col("p")) != F.col("want")).count() == 0
