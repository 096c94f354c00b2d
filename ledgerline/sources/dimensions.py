"""Calendar, product catalogue and customer dimension builders."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline import rules, schemas
from ledgerline.functions import first_match, hash_bucket


def date_range(spark: SparkSession, start: date, end: date) -> DataFrame:
    """One row per day, both ends included."""
    return spark.range(1).select(
        F.explode(F.sequence(F.lit(start), F.lit(end), F.expr("interval 1 day"))).alias("date_id")
    )


def calendar_columns(days: DataFrame, holidays: list[date] = rules.UK_BANK_HOLIDAYS) -> DataFrame:
    """Calendar attributes for every ``date_id``."""
    d = F.col("date_id")
    weekday = F.dayofweek(d)  # 1 = Sunday
    return schemas.DATES.conform(days.select(
        d,
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.weekofyear(d).alias("week_of_year"),
        weekday.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        weekday.isin(1, 7).alias("is_weekend"),
        d.isin(*holidays).alias("is_uk_bank_holiday"),
        F.year(d).alias("fiscal_year"),
        F.concat(F.lit("FY"), F.year(d).cast("string"), F.lit("-Q"), F.quarter(d).cast("string"))
        .alias("fiscal_quarter"),
    ))


def dim_date(
    spark: SparkSession,
    start: date = rules.CALENDAR_START,
    end: date = rules.CALENDAR_END,
    holidays: list[date] = rules.UK_BANK_HOLIDAYS,
) -> DataFrame:
    return calendar_columns(date_range(spark, start, end), holidays)


def calendar_for(facts: DataFrame, day: str) -> DataFrame:
    """The calendar from the first to the last ``day`` found in a fact table."""
    bounds = facts.agg(F.min(day).alias("lo"), F.max(day).alias("hi")).filter(F.col("lo").isNotNull())
    return calendar_columns(bounds.select(
        F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("date_id")
    ))


def dim_products(spark: SparkSession) -> DataFrame:
    """The product catalogue.

    Inline values rather than a parallelised list: the optimizer then knows how small the
    table is and joins it without shuffling the other side.
    """
    names = ["product_id", "product_code", "product_name", "product_type", "product_family",
             "interest_rate", "fee_monthly", "credit_limit_max", "launch_date"]
    rows = ", ".join(
        "(" + ", ".join("NULL" if v is None else f"'{v}'" for v in row) + ")" for row in rules.PRODUCT_CATALOGUE
    )
    return schemas.PRODUCTS.conform(spark.sql(f"SELECT * FROM VALUES {rows} AS p({', '.join(names)})"))


def whole_years(as_of: date, day: Column) -> Column:
    """Completed years between ``day`` and ``as_of``."""
    return F.floor(F.months_between(F.lit(as_of), day) / 12)


def build_customers(ids: DataFrame, as_of: date, run_ts: Column | None = None) -> DataFrame:
    """Customers derived from a numeric ``id`` column, the same for the same ids every time.

    Every attribute is a hash bucket of a multiple of the id, so rows are independent:
    no shuffle, and a lost task rebuilds exactly its own rows.
    """
    i = F.col("id").cast("bigint")

    def bucket(multiplier: int, size: int) -> Column:
        return hash_bucket(i * multiplier, size)

    def years_ago(n: Column) -> Column:
        return F.add_months(F.lit(as_of), (n * -12).cast("int"))

    regions = F.array(*[
        F.struct(F.lit(r).alias("region"), F.lit(p).alias("postcode")) for r, p in rules.GEN_REGIONS
    ])
    place = F.get(regions, bucket(7, len(rules.GEN_REGIONS)).cast("int"))

    base = ids.select(
        i.alias("id"),
        place.alias("place"),
        years_ago(20 + bucket(1, 45)).alias("date_of_birth"),
        years_ago(1 + bucket(3, 15)).alias("customer_since"),
        bucket(11, 100).alias("segment_bucket"),
        bucket(13, 100).alias("risk_bucket"),
        bucket(17, 2).alias("gender_bucket"),
        (bucket(23, 201) - 100).alias("nps_score"),
    )
    age = whole_years(as_of, F.col("date_of_birth"))
    text_id = F.col("id").cast("string")
    return schemas.CUSTOMERS.conform(base.select(
        F.concat(F.lit("CUST"), F.lpad(text_id, F.greatest(F.lit(8), F.length(text_id)), F.lit("0"))).alias("customer_id"),
        F.concat(F.lit("First"), text_id).alias("first_name"),
        F.concat(F.lit("Last"), text_id).alias("last_name"),
        "date_of_birth",
        first_match([(age.between(lo, hi), label) for lo, hi, label in rules.GEN_AGE_BANDS],
                    rules.GEN_AGE_OTHER).alias("age_band"),
        F.when(F.col("gender_bucket") == 0, "M").otherwise("F").alias("gender"),
        F.col("place.postcode").alias("postcode_district"),
        F.col("place.region").alias("region"),
        F.lit("GB").alias("country"),
        "customer_since",
        first_match([(F.col("segment_bucket") < b, s) for b, s in rules.GEN_SEGMENTS],
                    rules.GEN_SEGMENT_OTHER).alias("customer_segment"),
        (F.col("segment_bucket") < rules.GEN_STUDENT_BELOW).alias("is_student"),
        F.lit(False).alias("is_business"),
        F.lit("Verified").alias("kyc_status"),
        first_match([(F.col("risk_bucket") < b, s) for b, s in rules.GEN_RISKS],
                    rules.GEN_RISK_OTHER).alias("risk_rating"),
        F.concat(F.lit("RM_"), F.lpad((F.col("id") % 500).cast("string"), 4, "0")).alias("relationship_mgr"),
        "nps_score",
        F.col("customer_since").cast("timestamp").alias("created_at"),
        (F.lit(as_of).cast("timestamp") if run_ts is None else run_ts).alias("updated_at"),
    ))


def customer_ids(spark: SparkSession, n: int = 100_000) -> DataFrame:
    return spark.range(1, n + 1)
