"""Small star tables written by hand; unnamed columns take plain defaults."""

from datetime import date, datetime
from decimal import Decimal

from ledgerline import schemas

AS_OF = date(2024, 12, 31)


def _frame(spark, table, rows, defaults):
    full = [{**defaults, **r} for r in rows]
    data = [tuple(r.get(n) for n in table.schema.names) for r in full]
    return spark.createDataFrame(data, table.schema)


def money(x):
    return None if x is None else Decimal(str(x)).quantize(Decimal("0.01"))


def transactions(spark, rows):
    """Rows of ``customer_id, transaction_date, amount_gbp`` and whatever else matters."""
    out = []
    for i, r in enumerate(rows):
        r = dict(r)
        r["amount_gbp"] = money(r.get("amount_gbp", 10))
        r.setdefault("transaction_date", AS_OF)
        r.setdefault("transaction_id", f"T{i:05d}")
        out.append(r)
    return _frame(spark, schemas.TRANSACTIONS, out, dict(
        customer_id="C1", account_id="A1", transaction_timestamp=datetime(2024, 1, 1), transaction_type="Debit",
        transaction_category="Groceries", merchant_name="M1", merchant_country="GB", channel="POS",
        is_international=False, is_recurring=False, is_flagged=False))


def accounts(spark, rows):
    out = []
    for r in rows:
        r = dict(r)
        for c in ("balance_gbp", "utilisation_pct", "interest_charged_gbp", "fees_charged_gbp", "interest_earned_gbp"):
            if c in r:
                r[c] = money(r[c])
        out.append(r)
    zero = money(0)
    return _frame(spark, schemas.ACCOUNTS, out, dict(
        account_id="A1", customer_id="C1", product_id="PRD001", snapshot_month=date(2024, 12, 1),
        account_status="Active", balance_gbp=zero, days_in_arrears=0, missed_payments_3m=0,
        interest_charged_gbp=zero, fees_charged_gbp=zero, interest_earned_gbp=zero))


def customers(spark, rows):
    return _frame(spark, schemas.CUSTOMERS, rows, dict(
        customer_id="C1", date_of_birth=date(1990, 6, 15), age_band="25-34", region="North",
        customer_since=date(2020, 1, 1), customer_segment="Premier", kyc_status="Verified", risk_rating="Low",
        nps_score=0))
