"""Churn features: one row per verified customer."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline import rules
from ledgerline.functions import deviation_of_sums, mean_of, safe_ratio, square_sums, years_apart
from ledgerline.functions.dates import MASK_MONTHS, month_bit, month_number, months_before


def closes_soon(as_of: date) -> Column:
    """Closed within the horizon after ``as_of``."""
    return (F.col("account_status") == "Closed") & F.col("closed_date").between(
        F.lit(as_of), F.lit(as_of + timedelta(days=rules.CHURN_HORIZON_DAYS)))


def churn_labels(accounts: DataFrame, as_of: date) -> DataFrame:
    """1 when any of the customer's accounts closes within the horizon."""
    return accounts.groupBy("customer_id").agg(
        F.max(F.when(closes_soon(as_of), 1).otherwise(0)).cast("bigint").alias("churned"))


def churn_labels_all_closed(accounts: DataFrame, as_of: date) -> DataFrame:
    """1 only when every account of the customer closes within the horizon."""
    per_account = accounts.groupBy("customer_id", "account_id").agg(
        F.max(F.when(closes_soon(as_of), 1).otherwise(0)).alias("closing"))
    return per_account.groupBy("customer_id").agg(F.min("closing").cast("bigint").alias("churned"))


def _txn_items(rows: DataFrame, start: date) -> DataFrame:
    """The rows under what is counted of them by distinct values: each comes once under its merchant and, carrying
    nothing else, once under its category, and under its month when that is too far off to be a bit of ``months``.
    """
    month = month_number(F.col("transaction_date"), start)
    near = month < MASK_MONTHS
    values = {f.name: f.dataType for f in rows.schema if f.name not in ("customer_id", "merchant_name", "transaction_category")}
    nothing = F.lit(None)

    def item(own: bool, **counted: Column) -> Column:
        return F.struct(
            *[counted.get(c, nothing).cast(kind).alias(c)
              for c, kind in {"merchant_name": "string", "category": "string", "far_month": "int"}.items()],
            *[(F.col(c) if own else nothing).cast(kind).alias(c) for c, kind in values.items()],
            (month_bit(month) if own else F.lit(0).cast("bigint")).alias("months"),
            F.lit(int(own)).cast("bigint").alias("n"))

    own, category = item(True, merchant_name=F.col("merchant_name")), item(False, category=F.col("transaction_category"))
    items = F.when(near, F.array(own, category)).otherwise(F.array(own, category, item(False, far_month=month)))
    return rows.select("customer_id", F.inline(items))


def churn_txn_features(txn: DataFrame, as_of: date) -> DataFrame:
    """Six months of unflagged debits per customer.

    Two groupings, by customer and counted value, then by customer. All that they hold has a
    fixed width, so both stay hash aggregations however many customers a task has; sets of
    values would make them sort their rows.
    """
    start = months_before(as_of, rules.CHURN_MONTHS)
    day, amount = F.col("transaction_date"), F.col("amount_gbp")
    is_late = day >= F.lit(months_before(as_of, rules.CHURN_TREND_MONTHS))
    channel = F.col("channel")
    rows = txn.filter(
        (day >= F.lit(start)) & (F.col("transaction_type") == "Debit") & (F.col("is_flagged") == F.lit(False))
    ).select(
        "customer_id", "merchant_name", "transaction_category", "transaction_date", amount.cast("decimal(18,2)").alias("amount_gbp"),
        *[condition.cast("int").alias(c) for c, condition in {
            "mobile": channel == "Mobile", "branch": channel == "Branch", "atm": channel == "ATM",
            "intl": F.col("is_international")}.items()])
    items = _txn_items(rows, start).groupBy("customer_id", "merchant_name", "category", "far_month").agg(
        F.sum("n").alias("n"),
        F.count(amount).alias("amounts"),
        F.sum(amount).alias("spend"),
        F.sum(F.when(F.col("n") == 1, F.when(is_late, amount).otherwise(0))).alias("late"),
        F.sum(F.when(F.col("n") == 1, F.when(is_late, 0).otherwise(amount))).alias("prior"),
        *[F.count_if(F.col(c) == 1).alias(c) for c in ("mobile", "branch", "atm", "intl")],
        F.max(day).alias("last"),
        F.bit_or("months").alias("months"),
        *square_sums(amount))

    def total(column: str) -> Column:
        return F.sum(column).cast("decimal(28,2)")

    return items.groupBy("customer_id").agg(
        F.sum("n").alias("txn_count_6m"),
        total("spend").alias("total_spend_6m"),
        safe_ratio(total("spend"), F.sum("amounts")).alias("avg_txn_amount_6m"),
        deviation_of_sums(F.sum("amounts"), total("spend")).alias("stddev_txn_amount"),
        F.count("category").alias("unique_categories"),
        F.count("merchant_name").alias("unique_merchants"),
        (F.bit_count(F.bit_or("months")) + F.count("far_month")).cast("bigint").alias("active_months"),
        F.sum("mobile").alias("mobile_txns"),
        F.sum("branch").alias("branch_txns"),
        F.sum("atm").alias("atm_txns"),
        F.sum("intl").alias("intl_txns"),
        F.datediff(F.lit(as_of), F.max("last")).alias("days_since_last_txn"),
        total("late").alias("spend_last_3m"),
        total("prior").alias("spend_prior_3m"),
    )


def churn_account_features(accounts: DataFrame, as_of: date) -> DataFrame:
    """Six months of account health per customer, closed accounts left out."""
    status = F.col("account_status")
    return (
        accounts.filter(
            (F.col("snapshot_month") >= F.lit(months_before(as_of, rules.CHURN_MONTHS))) & (status != "Closed")
        )
        .groupBy("customer_id")
        .agg(
            F.count_distinct("account_id").alias("product_count"),
            mean_of(F.col("utilisation_pct")).alias("avg_credit_utilisation"),
            F.max("days_in_arrears").alias("max_days_in_arrears"),
            F.sum("missed_payments_3m").alias("total_missed_payments_3m"),
            F.sum("fees_charged_gbp").alias("total_fees_charged_6m"),
            mean_of(F.col("balance_gbp")).alias("avg_balance"),
            F.count_if(status == "Overdrawn").alias("overdrawn_accounts"),
            F.count_if(status == "Dormant").alias("dormant_accounts"),
        )
    )


def churn_features(
    customers: DataFrame, txn: DataFrame, accounts: DataFrame, as_of: date, run_ts: Column | None = None
) -> DataFrame:
    """The feature table, defaults filled in.

    The label only needs accounts that close soon: everyone else is 0 anyway, so that
    filter reaches the scan instead of reading every account of every month.
    """
    closing = accounts.filter(closes_soon(as_of)).select("customer_id").distinct().withColumn(
        "churned", F.lit(1).cast("bigint"))
    trend = safe_ratio(
        F.col("spend_last_3m") - F.col("spend_prior_3m"), F.nullif(F.col("spend_prior_3m"), F.lit(0)))

    def filled(column: str, default: object = 0) -> Column:
        return F.coalesce(F.col(column), F.lit(default))

    out = (
        customers.filter(F.col("kyc_status") == "Verified")
        .join(churn_txn_features(txn, as_of), "customer_id", "left")
        .join(churn_account_features(accounts, as_of), "customer_id", "left")
        .join(closing, "customer_id", "left")
        .select(
            "customer_id",
            years_apart(F.lit(as_of), F.col("date_of_birth")).alias("age"),
            years_apart(F.lit(as_of), F.col("customer_since")).alias("tenure_years"),
            "customer_segment", "region", "risk_rating",
            filled("txn_count_6m").alias("txn_count_6m"),
            filled("total_spend_6m").alias("total_spend_6m"),
            filled("avg_txn_amount_6m", 0.0).alias("avg_txn_amount_6m"),
            filled("unique_categories").alias("unique_categories"),
            filled("unique_merchants").alias("unique_merchants"),
            filled("active_months").alias("active_months_6m"),
            filled("days_since_last_txn", rules.CHURN_NO_TRANSACTION_DAYS).alias("days_since_last_txn"),
            filled("mobile_txns").alias("mobile_txns"),
            filled("branch_txns").alias("branch_txns"),
            filled("intl_txns").alias("intl_txns"),
            F.coalesce(trend, F.lit(0.0)).alias("spend_trend_pct"),
            filled("product_count").alias("product_count"),
            filled("avg_credit_utilisation", 0.0).alias("avg_credit_utilisation"),
            filled("max_days_in_arrears").alias("max_days_in_arrears"),
            filled("total_missed_payments_3m").alias("total_missed_payments_3m"),
            filled("total_fees_charged_6m").alias("total_fees_charged_6m"),
            filled("avg_balance", 0.0).alias("avg_balance"),
            filled("overdrawn_accounts").alias("overdrawn_accounts"),
            filled("dormant_accounts").alias("dormant_accounts"),
            "nps_score",
            filled("churned").alias("churned"),
        )
    )
    return out if run_ts is None else out.withColumn("feature_date", run_ts)
