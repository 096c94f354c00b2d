from datetime import date

from frames import AS_OF
from pyspark.sql import functions as F

from ledgerline import rules, schemas
from ledgerline.sources import dimensions


def test_calendar(spark):
    df = dimensions.dim_date(spark)
    assert df.schema.names == schemas.DATES.schema.names
    assert df.count() == 1096 == df.select("date_id").distinct().count()
    assert df.filter("is_uk_bank_holiday").count() == len(rules.UK_BANK_HOLIDAYS) == 27
    for r in df.collect():
        d = r.date_id
        assert (r.year, r.quarter, r.month) == (d.year, (d.month + 2) // 3, d.month)
        assert (r.week_of_year, r.day_of_week) == (d.isocalendar().week, d.isoweekday() % 7 + 1)
        assert (r.month_name, r.day_name, r.is_weekend) == (d.strftime("%B"), d.strftime("%A"), d.isoweekday() >= 6)
        assert (r.fiscal_year, r.fiscal_quarter) == (d.year, f"FY{d.year}-Q{r.quarter}")


def test_catalogue(spark):
    df = dimensions.dim_products(spark)
    assert df.schema.names == schemas.PRODUCTS.schema.names and df.count() == 11
    by_type = {r.product_type: r["count"] for r in df.groupBy("product_type").count().collect()}
    assert by_type == {"Current Account": 2, "Savings": 3, "Credit Card": 2, "Loan": 2, "Mortgage": 2}
    assert df.filter("is_active").count() == 11 and df.filter("retired_date is not null").count() == 0


def test_customer_build(spark):
    n = 100_000
    df = dimensions.build_customers(dimensions.customer_ids(spark, n), AS_OF)
    assert df.schema.names == schemas.CUSTOMERS.schema.names

    def share(c):
        return F.avg(c.cast("double"))

    r = df.agg(
        F.count_distinct("customer_id").alias("n"),
        share(F.col("customer_segment") == "Retail").alias("retail"), share(F.col("customer_segment") == "Private").alias("private"),
        share(F.col("risk_rating") == "Low").alias("low"), share(F.col("risk_rating") == "High").alias("high"),
        share(F.col("region") == "London").alias("london"), share(F.col("gender") == "F").alias("female"),
        share(F.col("is_student")).alias("student"),
        F.min("nps_score").alias("nps_lo"), F.max("nps_score").alias("nps_hi"),
        F.min("date_of_birth").alias("oldest"), F.max("date_of_birth").alias("youngest"),
        F.min("customer_since").alias("first"), F.max("customer_since").alias("last"),
        F.count_if(F.col("is_student") & (F.col("customer_segment") != "Retail")).alias("odd_students"),
        F.count_distinct("relationship_mgr").alias("managers"),
    ).first()
    assert r.n == n and r.managers == 500 and r.odd_students == 0
    for got, want in [(r.retail, .70), (r.private, .08), (r.low, .75), (r.high, .07), (r.london, .25), (r.female, .5), (r.student, .15)]:
        assert abs(got - want) < 0.01
    assert (r.nps_lo, r.nps_hi) == (-100, 100)
    assert (r.oldest, r.youngest, r.first, r.last) == (
        date(1960, 12, 31), date(2004, 12, 31), date(2009, 12, 31), date(2023, 12, 31))


def test_customer_build_is_repeatable_and_keeps_long_ids(spark):
    ids = spark.createDataFrame([(1,), (99_999_999,), (123_456_789,)], "id bigint")
    a = dimensions.build_customers(ids, AS_OF)
    b = dimensions.build_customers(ids.repartition(3), AS_OF)
    assert a.exceptAll(b).count() == 0
    assert [r.customer_id for r in a.orderBy("customer_id").collect()] == ["CUST00000001", "CUST123456789", "CUST99999999"]


def test_age_bands_by_completed_years(spark):
    days = [("2006-12-31", 18), ("2007-01-01", 17), ("1999-12-31", 25), ("2000-01-01", 24)]
    df = spark.createDataFrame([(date.fromisoformat(d), a) for d, a in days], "d date, want int")
    assert df.filter(dimensions.whole_years(AS_OF, F.col("d")) != F.col("want")).count() == 0
