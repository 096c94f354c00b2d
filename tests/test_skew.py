"""One customer holds a third of all transactions and accounts: same answers, whole results."""

from types import SimpleNamespace

import duckdb
import pytest
from pyspark.sql import functions as F

from ledgerline.checks import compare, oracle, registry
from ledgerline import schemas
from ledgerline.session import scratch_path
from ledgerline.sources import order_star

HOT = "CUST00000007"
SMALL_PARTITIONS = {
    "spark.sql.autoBroadcastJoinThreshold": "4096",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "4096",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "65536",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "65536",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
}
NAMES = [
    "rfm_segments", "churn_labels", "churn_txn_features", "churn_account_features", "ml_churn_features",
    "product_holdings", "cross_sell", "structuring_daily", "structuring_transaction_ids", "aml_structuring_alerts",
    "aml_structuring_calendar", "aml_layering_daily", "geo_transitions", "aml_geographic_anomaly", "aml_velocity_alerts", "aml_round_amount_alerts", "aml_high_risk_exposure",
    "pnl_net_interest", "pnl_fee_income", "pnl_fee_income_dedup", "pnl_account_counts", "v_monthly_pnl",
    "executive_summary_from_base", "mcc_category",
]


@pytest.fixture(scope="module")
def hot_star(spark, sf_dir):
    star = order_star.load(spark, sf_dir)

    def a_third_to_hot(df, key):
        return df.withColumn("customer_id", F.when(F.pmod(F.xxhash64(key), F.lit(3)) == 0, HOT).otherwise(F.col("customer_id")))

    frames = {
        "dim_customers": star.customers,
        "dim_products": star.products,
        "fact_transactions": a_third_to_hot(star.transactions, "transaction_id"),
        "fact_accounts": a_third_to_hot(star.accounts, "account_id"),
        "ref_merchant_categories": star.merchant_categories,
    }
    con, tables = duckdb.connect(), {}
    for name, df in frames.items():
        path = scratch_path(spark, f"hot_{name}")
        df.coalesce(1).write.parquet(path)
        tables[name] = spark.read.schema(schemas.STAR[name].schema).parquet(path)
        extra = ", 2024 - year(customer_since) AS tenure_years" if name == "dim_customers" else ""
        con.execute(f"CREATE VIEW {name} AS SELECT *{extra} FROM '{path}/*.parquet'")
    shares = tables["fact_transactions"].agg(F.avg((F.col("customer_id") == HOT).cast("double"))).first()[0]
    assert shares > 0.32
    old = {k: spark.conf.get(k, None) for k in SMALL_PARTITIONS}
    for k, v in SMALL_PARTITIONS.items():
        spark.conf.set(k, v)
    yield con, SimpleNamespace(
        spark=spark, sf_dir=sf_dir, customers=tables["dim_customers"], products=tables["dim_products"],
        transactions=tables["fact_transactions"].repartition(16), accounts=tables["fact_accounts"].repartition(16),
        merchant_categories=tables["ref_merchant_categories"])
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("name", NAMES)
def test_hot_customer(hot_star, name):
    con, star = hot_star
    got = registry.comparable(registry.star_queries()[name](star))
    assert compare.difference(got, con, oracle.oracle_sql(star_given=True)[name]) is None


def test_skewed_join_is_split(hot_star):
    """Adaptive execution splits the hot customer's partition in the account-to-customer join."""
    from ledgerline.plans import pnl

    _, star = hot_star
    df = pnl.net_interest(star.accounts, star.products, star.customers)
    df.collect()
    assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
