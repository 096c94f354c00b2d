"""The banking star schema read out of an orders-and-lineitems data set.

The test tables hold orders, not bank transactions. This module maps them: a lineitem is
a transaction, an order fixes its customer and product, and twelve month-end snapshots
are derived for each customer and product pair. All mapping constants belong to the test
data set; money goes through whole pence.
"""

from __future__ import annotations

from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.sources.dimensions import dim_products

AS_OF = date(2024, 12, 31)


# declared, so that opening a table reads no file footers on the driver
_RAW = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
}


class Star:
    """The tables, each read when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def customers(self) -> DataFrame:
        return customers(self.spark, self.sf_dir)

    @cached_property
    def products(self) -> DataFrame:
        return dim_products(self.spark)

    @cached_property
    def transactions(self) -> DataFrame:
        return transactions(self.spark, self.sf_dir)

    @cached_property
    def accounts(self) -> DataFrame:
        return accounts(self.spark, self.sf_dir)

    @cached_property
    def merchant_categories(self) -> DataFrame:
        return merchant_categories(self.spark, self.sf_dir)


def raw_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_RAW[name]).parquet(f"{sf_dir}/{name}.parquet")


def _pence(column: str) -> str:
    return f"cast(round({column} * 100) as bigint)"


def _money(pence: str) -> str:
    return f"cast(cast({pence} as decimal(18,0)) * cast(0.01 as decimal(3,2)) as decimal(18,2))"


def _pick(items: list[str], index: str) -> str:
    """1-based choice from a list."""
    return f"element_at(array({', '.join(repr(i) for i in items)}), cast({index} as int))"


_AS_OF = f"DATE '{AS_OF}'"
# eight digits, more when the number needs them: lpad alone would cut a longer number short
_DIGITS = "lpad(cast(k as string), greatest(8, length(cast(k as string))), '0')"
_CUSTOMER_ID = f"concat('CUST', {_DIGITS})"
_ACCOUNT_ID = f"concat('ACC', {_DIGITS}, '-', lpad(cast({{}} as string), 2, '0'))"


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = raw_table(spark, sf_dir, "nation").join(
        raw_table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    ).select("n_nationkey", F.col("r_name").alias("region"))
    base = (
        raw_table(spark, sf_dir, "customer")
        .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(F.col("c_custkey").alias("k"), "region")
        .withColumn("date_of_birth", F.expr(f"date_sub({_AS_OF}, cast(6570 + (k * 7919) % 20000 as int))"))
        .withColumn("age", F.expr(f"{AS_OF.year} - year(date_of_birth)"))
    )
    return schemas.CUSTOMERS.conform(base.selectExpr(
        f"{_CUSTOMER_ID} as customer_id",
        "date_of_birth",
        "case when age between 18 and 24 then '18-24' when age between 25 and 34 then '25-34' "
        "when age between 35 and 44 then '35-44' when age between 45 and 54 then '45-54' "
        "when age between 55 and 64 then '55-64' else '65+' end as age_band",
        "region",
        f"date_sub({_AS_OF}, cast(30 + (k * 104729) % 5400 as int)) as customer_since",
        "case when (k * 11) % 100 < 60 then 'Retail' when (k * 11) % 100 < 85 then 'Premier' "
        "else 'Private' end as customer_segment",
        "case when (k * 29) % 20 = 0 then 'Pending' else 'Verified' end as kyc_status",
        "case when (k * 13) % 100 < 75 then 'Low' when (k * 13) % 100 < 93 then 'Medium' "
        "else 'High' end as risk_rating",
        "(k * 23) % 201 - 100 as nps_score",
    ))


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = raw_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_shipdate"
    )
    orders = raw_table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("k"))
    joined = (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .withColumn("d", F.expr("datediff(cast(l_shipdate as date), DATE '1995-01-01')"))
        .withColumn("planted", F.expr("k % 25 = 0 and l_linenumber <= 4"))
        .withColumn("age", F.expr("case when planted then d % 31 else d % 365 end"))
    )
    pence = (
        # 999.60 rounds to a round amount and is none: the two round-amount reports differ
        "case when planted and (k div 25) % 7 = 6 then 99960 when planted then 100000 * (1 + (k div 25) % 9) "
        f"when k % 20 = 1 and age > 7 then {_pence('l_extendedprice')} div 200 "
        f"else {_pence('l_extendedprice')} div 10 end"
    )
    kinds = _pick(["Debit", "Debit", "Debit", "Credit", "Transfer", "ATM"], "1 + (l_partkey + l_linenumber) % 6")
    categories = _pick(["Groceries", "Utilities", "Transport", "Entertainment", "Mortgage/Rent", "FX"], "1 + l_partkey % 6")
    return schemas.TRANSACTIONS.conform(joined.selectExpr(
        "concat('TXN', l_orderkey, '-', l_linenumber, '-', l_partkey, '-', l_suppkey, '-', d) as transaction_id",
        f"{_CUSTOMER_ID} as customer_id",
        f"{_ACCOUNT_ID.format('o_orderkey % 11 + 1')} as account_id",
        "concat('PRD', lpad(cast(o_orderkey % 11 + 1 as string), 3, '0')) as product_id",
        f"date_sub({_AS_OF}, age) as transaction_date",
        f"cast(date_sub({_AS_OF}, age) as timestamp) as transaction_timestamp",
        f"case when k % 50 = 49 then 'Transfer' else {kinds} end as transaction_type",
        f"case when k % 15 = 2 then 'International' when k % 6 = 1 then 'Mortgage/Rent' "
        f"else {categories} end as transaction_category",
        "concat('Merchant_', l_suppkey % 50) as merchant_name",
        "lpad(cast(5000 + l_partkey % 12 as string), 4, '0') as merchant_category_code",
        "case when l_suppkey % 10 = 0 then 'FR' else 'GB' end as merchant_country",
        f"{_money(pence)} as amount_gbp",
        _pick(["Mobile", "Online", "Branch", "ATM", "POS"], "1 + l_partkey % 5") + " as channel",
        "l_suppkey % 10 = 0 as is_international",
        "l_suppkey % 20 = 7 and l_linenumber = 7 as is_flagged",
    ))


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = (
        raw_table(spark, sf_dir, "orders")
        .selectExpr("o_custkey as k", "o_orderkey % 11 as pr", "o_orderkey % 2 as parity")
        # every ordered product is an account; one ordered by odd numbers only lies dormant, so holdings vary
        .groupBy("k", "pr").agg((F.min("parity") == 1).alias("odd"))
    )
    owners = raw_table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    # each row becomes twelve wide ones in the task that holds it, which the narrow rows' bytes don't show:
    # a number of partitions that is asked for isn't merged into a few large tasks
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    base = (
        pairs.join(owners, F.col("c_custkey") == F.col("k"))
        .repartition(parts, F.xxhash64("k", "pr"))
        # what the twelve have in common is made once
        .selectExpr(
            "k", "pr", "odd", f"{_CUSTOMER_ID} as customer_id", f"{_ACCOUNT_ID.format('pr + 1')} as account_id",
            "concat('PRD', lpad(cast(pr + 1 as string), 3, '0')) as product_id", f"{_pence('c_acctbal')} as held")
        .withColumn("m", F.explode(F.sequence(F.lit(0), F.lit(11))))
        .withColumn("h", F.expr("k * 31 + pr * 17 + m"))
        .withColumn("status", F.expr(
            "case when m = 11 and (k * 7 + pr * 3) % 20 = 0 then 'Closed' when h % 20 = 0 or pr >= 2 and odd then 'Dormant' "
            "when h % 20 = 1 then 'Overdrawn' else 'Active' end"))
    )
    balance = (
        "case when status = 'Overdrawn' then -100 * (h % 500) "
        "else held + (h % 97) * 15000 end"
    )
    return schemas.ACCOUNTS.conform(base.selectExpr(
        "account_id",
        "customer_id",
        "product_id",
        "cast(add_months(DATE '2024-01-01', m) as date) as snapshot_month",
        "status as account_status",
        f"{_money(balance)} as balance_gbp",
        f"case when pr in (5, 6) then {_money('100 * (h % 101)')} end as utilisation_pct",
        "case when h % 13 = 0 then 30 + h % 60 else 0 end as days_in_arrears",
        "case when h % 17 = 0 then 1 + h % 3 else 0 end as missed_payments_3m",
        f"case when pr >= 5 then {_money('(h % 97) * 325')} else 0 end as interest_charged_gbp",
        f"case when pr between 2 and 4 then {_money('(h % 89) * 115')} else 0 end as interest_earned_gbp",
        "case when h % 4 = 0 then cast(12.95 as decimal(18,2)) else 0 end as fees_charged_gbp",
        f"case when status = 'Closed' then date_add({_AS_OF}, cast(k % 120 as int)) end as closed_date",
    ))


def merchant_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The codes that occur in the parts table, with an invented category for each."""
    codes = raw_table(spark, sf_dir, "part").selectExpr("p_partkey % 12 as c").distinct()
    names = _pick(["Groceries", "Utilities", "Transport", "Entertainment", "Mortgage/Rent", "FX"], "1 + c % 6")
    return schemas.MERCHANT_CATEGORIES.conform(codes.selectExpr(
        "lpad(cast(5000 + c as string), 4, '0') as mcc_code",
        "concat('Merchant category ', 5000 + c) as mcc_description",
        f"{names} as spending_category",
        "c % 6 = 5 as is_high_risk",
    ))


def load(spark: SparkSession, sf_dir: str) -> Star:
    return Star(spark, sf_dir)
