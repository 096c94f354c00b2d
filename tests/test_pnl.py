import re
from datetime import date
from decimal import Decimal

import pytest
from frames import AS_OF, accounts, customers, transactions
from pyspark.sql import functions as F

from ledgerline.plans import churn, pnl
from ledgerline.sources import order_star
from ledgerline.sources.dimensions import dim_products
from ledgerline.sources.staging import families_per_type

M = [date(2024, m, 1) for m in range(1, 13)]


def _view(spark, acct, txn, **kw):
    return pnl.monthly_pnl(accounts(spark, acct), dim_products(spark), customers(spark, [{}]), transactions(spark, txn), **kw)


def test_fees_per_transaction_and_once(spark):
    acct = [dict(snapshot_month=M[0], fees_charged_gbp="2.50"), dict(snapshot_month=M[0], account_id="A2", fees_charged_gbp=1),
            dict(snapshot_month=M[1], fees_charged_gbp=7)]
    txn = [dict(transaction_date=d) for d in (date(2024, 1, 1), date(2024, 1, 31), date(2024, 1, 31))]
    args = accounts(spark, acct), dim_products(spark), customers(spark, [{}]), transactions(spark, txn)
    assert [(r.snapshot_month, r.fee_income_gbp) for r in pnl.fee_income(*args).collect()] == [(M[0], Decimal("10.50"))]
    assert [r.fee_income_gbp for r in pnl.fee_income(*args, per_transaction=False).collect()] == [Decimal("3.50")]


def test_fee_total_and_bound(spark, sf_dir):
    star = order_star.load(spark, sf_dir)
    args = star.accounts, star.products, star.customers, star.transactions
    each = pnl.fee_income(*args).agg(F.sum("fee_income_gbp")).first()[0]
    once = pnl.fee_income(*args, per_transaction=False).agg(F.sum("fee_income_gbp")).first()[0]
    assert each == Decimal("1365253.75") and once <= each


def test_no_transactions_means_no_fee_income(spark):
    r = _view(spark, [dict(snapshot_month=M[0], fees_charged_gbp=9, interest_charged_gbp=100, balance_gbp=1200)],
              [dict(transaction_date=M[5])]).first()
    assert (r.fee_income_gbp, r.total_revenue_gbp, r.nim_annualised_pct) == (0, 100, 100)


def test_change_compares_the_previous_row(spark):
    """March is missing: April is compared with February."""
    acct = [dict(snapshot_month=M[i], interest_charged_gbp=v, balance_gbp=1) for i, v in [(0, 10), (1, 30), (3, 100)]]
    got = {r.snapshot_month: r.mom_revenue_delta_gbp for r in _view(spark, acct, [{}]).collect()}
    assert got == {M[0]: None, M[1]: 20, M[3]: 70}
    args = accounts(spark, acct), dim_products(spark), customers(spark, [{}])
    compared = pnl.months_to_compare(*args, date(2024, 4, 17))
    assert compared == [M[1]]
    one = _view(spark, acct, [{}], report_month=date(2024, 4, 17), compared=compared).collect()
    assert [(r.snapshot_month, r.mom_revenue_delta_gbp) for r in one] == [(M[3], 70)]


def test_groups_may_compare_with_different_months(spark):
    acct = [dict(snapshot_month=M[i], product_id=p, interest_charged_gbp=v) for i, p, v in [
        (0, "PRD001", 1), (3, "PRD001", 5), (2, "PRD003", 7), (3, "PRD003", 9), (3, "PRD006", 2)]]
    args = accounts(spark, acct), dim_products(spark), customers(spark, [{}])
    compared = pnl.months_to_compare(*args, M[3])
    assert compared == [M[0], M[2]]
    txn = transactions(spark, [{}])
    whole = pnl.monthly_pnl(*args, txn).filter(F.col("snapshot_month") == F.lit(M[3])).collect()
    assert sorted(whole) == sorted(pnl.monthly_pnl(*args, txn, report_month=M[3], compared=compared).collect())
    assert {r.product_type: r.mom_revenue_delta_gbp for r in whole} == {"Current Account": 4, "Savings": 2, "Credit Card": None}


def test_two_families_in_a_group_stop_the_view(spark, sf_small):
    """Joined on four keys such a group would have its rows multiplied."""
    star = order_star.load(spark, sf_small)
    split = star.products.withColumn("product_family", F.when(F.col("product_id") == "PRD003", "Payments").otherwise(F.col("product_family")))
    with pytest.raises(Exception, match="one family: Savings"):
        pnl.monthly_pnl(star.accounts, split, star.customers, star.transactions).collect()


def test_view_scans_the_accounts_once(spark, sf_small):
    star = order_star.load(spark, sf_small)
    args = star.accounts, star.products, star.customers
    plan = pnl.monthly_pnl(*args, star.transactions)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("o_custkey") and plan.count("c_acctbal#") and len(re.findall(r"ReadSchema: struct<c_custkey:bigint,c_acctbal", plan)) == 1
    for df in (pnl.monthly_pnl(*args, star.transactions), pnl.account_counts(*args),
               pnl.executive_summary_from_base(*args, star.transactions, AS_OF), churn.churn_txn_features(star.transactions, AS_OF)):
        assert "Expand" not in df._jdf.queryExecution().executedPlan().toString()


def test_group_without_active_accounts(spark):
    r = _view(spark, [dict(snapshot_month=M[0], account_status="Dormant", interest_earned_gbp=4)], [{}]).first()
    assert r.active_accounts is None and r.arrears_rate_pct is None and r.nim_annualised_pct is None
    assert r.net_interest_income_gbp == -4


def test_zero_book_and_rounding(spark):
    acct = [dict(account_id=f"A{i}", snapshot_month=M[0], balance_gbp=0, interest_charged_gbp="0.50",
                 days_in_arrears=int(i == 0)) for i in range(3)]
    r = _view(spark, acct, [{}]).first()
    assert (r.nim_annualised_pct, r.arrears_rate_pct, r.net_interest_income_gbp) == (None, Decimal("33.33"), 2)


def test_view_columns_and_order(spark, sf_small):
    star = order_star.load(spark, sf_small)
    df = pnl.monthly_pnl(star.accounts, star.products, star.customers, star.transactions, run_ts=F.current_timestamp())
    assert len(df.columns) == 19
    keys = [(r.snapshot_month, r.total_revenue_gbp) for r in df.collect()]
    assert keys == sorted(keys, reverse=True) and len(keys) == 900


def test_one_month_without_change_gives_the_same_summary(spark, sf_small):
    star = order_star.load(spark, sf_small)
    args = star.accounts, star.products, star.customers, star.transactions
    run = date(2024, 7, 31)
    short = pnl.monthly_pnl(*args, report_month=run)
    assert "mom_revenue_delta_gbp" not in short.columns
    assert pnl.executive_summary(short, run).collect() == pnl.executive_summary(pnl.monthly_pnl(*args), run).collect()


def test_executive_summary_keeps_one_row_per_month(spark, sf_small, tmp_path):
    star = order_star.load(spark, sf_small)
    view = pnl.monthly_pnl(star.accounts, star.products, star.customers, star.transactions)
    path, stamp = str(tmp_path / "exec"), F.lit(AS_OF).cast("timestamp")
    pnl.store_executive_summary(view, date(2024, 11, 30), path, stamp)
    both = pnl.store_executive_summary(view, AS_OF, path, stamp)
    assert sorted(r.report_month for r in both.collect()) == [date(2024, 11, 30), AS_OF]
    assert len(both.columns) == 10
    again = pnl.store_executive_summary(view, AS_OF, path, F.lit(AS_OF).cast("timestamp") + F.expr("interval 1 hour"))
    assert sorted((r.report_month, r.inserted_at.hour) for r in again.collect()) == [(date(2024, 11, 30), 0), (AS_OF, 1)]


def test_each_type_has_one_family(spark):
    assert families_per_type(dim_products(spark)).count() == 0
    assert families_per_type(dim_products(spark).withColumn(
        "product_family", F.when(F.col("product_id") == "PRD001", "Payments").otherwise(F.col("product_family")))).count() == 1


def test_view_equals_its_parts_joined(spark, sf_small):
    """Also for customers of unknown region, whose groups match nothing in a join on equal keys."""
    star = order_star.load(spark, sf_small)
    who = star.customers.withColumn("region", F.when(F.col("region") != "ASIA", F.col("region")))
    args = star.accounts, star.products, who
    parts = (
        pnl.net_interest(*args).join(pnl.fee_income(*args, star.transactions).drop("product_family"), pnl.GROUP, "left")
        .join(pnl.account_counts(*args), pnl.GROUP, "left")
        .select(*pnl.GROUP_FAMILY, "active_accounts", "active_customers", F.col("accounts_in_arrears").cast("bigint"),
                F.round("total_book_gbp", 0).alias("book"), F.round(F.coalesce("fee_income_gbp", F.lit(0)), 0).alias("fee"))
    )
    view = pnl.monthly_pnl(*args, star.transactions).select(
        *pnl.GROUP_FAMILY, "active_accounts", "active_customers", "accounts_in_arrears",
        F.col("total_book_gbp").alias("book"), F.col("fee_income_gbp").alias("fee"))
    assert view.exceptAll(parts).count() == 0 and parts.exceptAll(view).count() == 0
    unknown = view.filter("region is null")
    assert unknown.count() > 0 and unknown.filter("active_accounts is not null or fee <> 0").count() == 0


def test_repeated_account_rows_count_once(spark):
    """An account that was landed twice is still one account of one customer, in every report."""
    once = [dict(account_id="A1", balance_gbp=10, days_in_arrears=5), dict(account_id="A2", balance_gbp=20),
            dict(account_id="A3", account_status="Dormant")]
    for rows in (once, once + once[:1] * 3, once * 2):
        args = accounts(spark, rows), dim_products(spark), customers(spark, [{}])
        txn = transactions(spark, [{}])
        [counts] = pnl.account_counts(*args).collect()
        [view] = pnl.monthly_pnl(*args, txn).collect()
        [base] = pnl.executive_summary_from_base(*args, txn, AS_OF).collect()
        assert (counts.active_accounts, counts.active_customers) == (2, 1)
        assert (view.active_accounts, view.active_customers) == (2, 1)
        assert (base.total_active_accounts, base.total_active_customers) == (2, 1)
    plan = pnl.account_counts(*args)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "ObjectHash" not in plan
