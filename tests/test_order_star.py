"""The mapping from the test tables gives the documented row counts and sums."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerline.sources import order_star

EXPECTED = {
    "sf0.001": dict(
        customers=150, customer_sum=29_682, nps=-180, txns=6_000, txn_customers=150,
        amount="30447054.79", weighted="1232639284.70", accounts=11_988, account_ids=999,
        account_customers=150, balance="133150991.35", charged="1024871.25", earned="161764.75",
        fees="38811.15", status={"Active": 7206, "Closed": 56, "Dormant": 4307, "Overdrawn": 419}),
    "sf0.01": dict(
        customers=1_500, customer_sum=343_451, nps=-351, txns=60_000, txn_customers=1_500,
        amount="301751335.56", weighted="14174027935.02", accounts=118_608, account_ids=9_884,
        account_customers=1_500, balance="1332777215.88", charged="9991767.50", earned="1659432.75",
        fees="383993.40", status={"Active": 72408, "Closed": 497, "Dormant": 41690, "Overdrawn": 4013}),
    "sf0.1": dict(
        customers=15_000, customer_sum=3_494_216, nps=-315, txns=600_000, txn_customers=14_999,
        amount="3018316379.79", weighted="144847073701.32", accounts=1_182_576, account_ids=98_548,
        account_customers=14_999, balance="13402396193.39", charged="100467848.00", earned="16283311.15",
        fees="3828589.80", status={"Active": 723011, "Closed": 4930, "Dormant": 414708, "Overdrawn": 39927}),
}


@pytest.mark.parametrize("sf", EXPECTED)
def test_checksums(spark, sf):
    want = EXPECTED[sf]
    star = order_star.load(spark, f"/root/testdata/{sf}")
    k = F.substring("customer_id", 5, 20).cast("bigint") % 97

    c = star.customers.agg(
        F.count("*").alias("n"),
        F.sum(k * F.length("age_band") + F.lit(2024) - F.year("customer_since")).alias("s"),
        F.sum("nps_score").alias("nps"),
    ).first()
    assert (c.n, c.s, c.nps) == (want["customers"], want["customer_sum"], want["nps"])

    t = star.transactions.agg(
        F.count("*").alias("n"), F.count_distinct("transaction_id").alias("ids"),
        F.count_distinct("customer_id").alias("customers"), F.sum("amount_gbp").alias("amount"),
        F.sum(F.col("amount_gbp") * k).alias("weighted"),
        F.min("transaction_date").cast("string").alias("lo"), F.max("transaction_date").cast("string").alias("hi"),
    ).first()
    assert (t.n, t.ids, t.customers) == (want["txns"], want["txns"], want["txn_customers"])
    assert (t.amount, t.weighted) == (Decimal(want["amount"]), Decimal(want["weighted"]))
    assert (t.lo, t.hi) == ("2024-01-02", "2024-12-31")

    a = star.accounts.agg(
        F.count("*").alias("n"), F.count_distinct("account_id").alias("ids"),
        F.count_distinct("customer_id").alias("customers"), F.sum("balance_gbp").alias("balance"),
        F.sum("interest_charged_gbp").alias("charged"), F.sum("interest_earned_gbp").alias("earned"),
        F.sum("fees_charged_gbp").alias("fees"),
    ).first()
    assert (a.n, a.ids, a.customers) == (want["accounts"], want["account_ids"], want["account_customers"])
    for name in ("balance", "charged", "earned", "fees"):
        assert a[name] == Decimal(want[name])
    by_status = {r.account_status: r["count"] for r in star.accounts.groupBy("account_status").count().collect()}
    assert by_status == want["status"]


def test_every_transaction_has_its_account(spark, sf_small):
    star = order_star.load(spark, sf_small)
    assert star.transactions.join(star.accounts, "account_id", "left_anti").count() == 0
