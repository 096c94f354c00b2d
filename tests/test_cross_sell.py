from datetime import date

from frames import AS_OF, accounts, customers, transactions

from ledgerline.plans import cross_sell
from ledgerline.sources.dimensions import dim_products


def _run(spark, who, acct, txn=()):
    return {r.customer_id: r for r in cross_sell.cross_sell(
        customers(spark, who), accounts(spark, acct), dim_products(spark), transactions(spark, list(txn) or [dict(customer_id="-")]),
        AS_OF).collect()}


def _spend(customer, amount, n=1, **kw):
    return [dict(customer_id=customer, amount_gbp=amount, **kw) for _ in range(n)]


def test_holdings(spark):
    rows = [dict(product_id="PRD001", account_id="A1", balance_gbp=-5), dict(product_id="PRD002", account_id="A2", balance_gbp=3),
            dict(product_id="PRD006", account_id="A3", account_status="Dormant"),
            dict(product_id="PRD010", account_id="A4", snapshot_month=date(2024, 11, 1)), dict(product_id="PRD004", account_id="A5")]
    r = cross_sell.product_holdings(accounts(spark, rows), dim_products(spark), AS_OF).first()
    assert (r.held_products, r.product_count, r.total_balance_gbp) == ("Current Account,Savings", 2, 8)
    assert (r.has_current_account, r.has_savings, r.has_credit_card, r.has_mortgage, r.has_loan) == (True, True, False, False, False)


def test_eligibility(spark):
    who = [dict(customer_id="ok"), dict(customer_id="high", risk_rating="High"), dict(customer_id="kyc", kyc_status="Failed"),
           dict(customer_id="none")]
    acct = [dict(customer_id=c, balance_gbp=5000) for c in ("ok", "high", "kyc")] + [
        dict(customer_id="none", product_id="PRD006", balance_gbp=5000)]
    assert set(_run(spark, who, acct)) == {"ok"}


def test_savings_edges(spark):
    who = [dict(customer_id="at"), dict(customer_id="over"), dict(customer_id="private", customer_segment="Private")]
    acct = [dict(customer_id="at", balance_gbp=2000), dict(customer_id="over", balance_gbp="2000.01"),
            dict(customer_id="private", balance_gbp=9000)]
    got = _run(spark, who, acct)
    assert set(got) == {"over"} and got["over"].recommended_product == "Fixed Rate Bond 12M"
    assert got["over"].total_spend_6m is None  # no transactions: unknown, and not an offer


def test_card_edges(spark):
    base = dict(customer_segment="Private")
    who = [dict(customer_id="yes", **base), dict(customer_id="at", **base), dict(customer_id="young", age_band="18-24", **base),
           dict(customer_id="new", customer_since=date(2024, 1, 1), **base), dict(customer_id="medium", risk_rating="Medium", **base)]
    acct = [dict(customer_id=w["customer_id"]) for w in who]
    txn = [t for w in who for t in _spend(w["customer_id"], 1500 if w["customer_id"] == "at" else "1500.01")]
    got = _run(spark, who, acct, txn)
    assert set(got) == {"yes"} and got["yes"].recommended_product == "Cashback Credit Card"


def test_mortgage_and_travel(spark):
    who = [dict(customer_id="m"), dict(customer_id="t", risk_rating="Medium"), dict(customer_id="t10", risk_rating="Medium")]
    acct = [dict(customer_id="m", balance_gbp=10001), dict(customer_id="t"), dict(customer_id="t10")]
    txn = (_spend("m", 1, 4, transaction_category="Mortgage/Rent") + _spend("t", 1, 5, transaction_category="FX")
           + _spend("t", 1, 6, transaction_category="International") + _spend("t10", 1, 10, transaction_category="FX"))
    got = _run(spark, who, acct, txn)
    assert set(got) == {"m", "t"}
    assert (got["m"].opportunity_mortgage, got["m"].opportunity_savings, got["m"].opportunity_count) == (True, True, 2)
    assert got["m"].recommended_product == "Residential Mortgage"
    assert got["t"].recommended_product == "Platinum Credit Card"


def test_order(spark):
    who = [dict(customer_id=c) for c in "abc"]
    acct = [dict(customer_id="a", balance_gbp=3000), dict(customer_id="b", balance_gbp=4000), dict(customer_id="c", balance_gbp=2500)]
    txn = _spend("c", 2000)
    got = cross_sell.cross_sell(customers(spark, who), accounts(spark, acct), dim_products(spark), transactions(spark, txn), AS_OF)
    assert [r.customer_id for r in got.collect()] == ["c", "b", "a"]
