"""Which customers to offer which product."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline import rules
from ledgerline.functions import first_match, mean_of, years_apart
from ledgerline.functions.dates import months_before

HOLDING_FLAGS = {
    "has_current_account": "Current Account",
    "has_savings": "Savings",
    "has_credit_card": "Credit Card",
    "has_mortgage": "Mortgage",
    "has_loan": "Loan",
}


def product_holdings(accounts: DataFrame, products: DataFrame, as_of: date) -> DataFrame:
    """Active products of each customer this month.

    Accounts are summed per customer and product type first, so the second grouping
    meets each type once: the distinct count is a plain count, and the list of held
    types is as short as the catalogue.
    """
    kind = F.col("product_type")
    per_type = (
        accounts.filter(
            (F.col("account_status") == "Active") & (F.col("snapshot_month") == F.lit(as_of.replace(day=1)))
        )
        .join(products.select("product_id", "product_type"), "product_id")
        .groupBy("customer_id", "product_type")
        .agg(F.sum(F.abs("balance_gbp")).alias("balance"))
    )
    return per_type.groupBy("customer_id").agg(
        F.array_join(F.sort_array(F.collect_list(kind)), ",").alias("held_products"),
        *[F.coalesce(F.bool_or(kind == label), F.lit(False)).alias(name) for name, label in HOLDING_FLAGS.items()],
        F.count(kind).alias("product_count"),
        F.sum("balance").alias("total_balance_gbp"),
    )


def behaviour(txn: DataFrame, as_of: date) -> DataFrame:
    """Six months of debit spending per customer."""
    category = F.col("transaction_category")
    return (
        txn.filter(
            (F.col("transaction_date") >= F.lit(months_before(as_of, rules.CROSS_SELL_MONTHS)))
            & (F.col("transaction_type") == "Debit")
            & (F.col("is_flagged") == F.lit(False))
        )
        .groupBy("customer_id")
        .agg(
            F.sum("amount_gbp").alias("total_spend_6m"),
            mean_of(F.col("amount_gbp")).alias("avg_txn_amount"),
            F.count_if(category == rules.RENT_CATEGORY).alias("rent_payments"),
            F.count_if(category.isin(*rules.INTERNATIONAL_CATEGORIES)).alias("intl_transactions"),
            F.count_if(F.col("merchant_country") != rules.HOME_COUNTRY).alias("foreign_txns"),
            F.count(F.lit(1)).alias("total_txns"),
        )
    )


def eligible_customers(
    customers: DataFrame, accounts: DataFrame, products: DataFrame, txn: DataFrame, as_of: date
) -> DataFrame:
    """Verified low and medium risk customers with a current account, holdings and behaviour attached."""
    who = customers.filter(
        (F.col("kyc_status") == "Verified") & F.col("risk_rating").isin("Low", "Medium")
    ).select(
        "customer_id", "customer_segment", "age_band", "region", "risk_rating",
        years_apart(F.lit(as_of), F.col("customer_since")).alias("tenure_years"),
    )
    held = product_holdings(accounts, products, as_of).filter("has_current_account")
    return who.join(held, "customer_id").join(behaviour(txn, as_of), "customer_id", "left")


def opportunity_flags(enriched: DataFrame) -> DataFrame:
    """Four flags per customer. A rule that meets a NULL counts as not met."""
    segment, band = F.col("customer_segment"), F.col("age_band")
    no_card = ~F.col("has_credit_card")
    flags = {
        "opportunity_savings":
            ~F.col("has_savings")
            & (F.col("total_balance_gbp") > rules.SAVINGS_MIN_BALANCE)
            & segment.isin("Premier", "Retail"),
        "opportunity_credit_card":
            no_card
            & (F.col("total_spend_6m") > rules.CARD_MIN_SPEND)
            & (F.col("tenure_years") >= 1)
            & ~band.isin("18-24")
            & (F.col("risk_rating") == "Low"),
        "opportunity_mortgage":
            ~F.col("has_mortgage")
            & (F.col("rent_payments") >= rules.MORTGAGE_MIN_RENT)
            & band.isin("25-34", "35-44")
            & segment.isin("Premier", "Private")
            & (F.col("total_balance_gbp") > rules.MORTGAGE_MIN_BALANCE),
        "opportunity_travel_card":
            (F.col("intl_transactions") > rules.TRAVEL_MIN_INTERNATIONAL) & no_card,
    }
    return enriched.withColumns({name: F.coalesce(rule, F.lit(False)) for name, rule in flags.items()})


def cross_sell(
    customers: DataFrame, accounts: DataFrame, products: DataFrame, txn: DataFrame, as_of: date
) -> DataFrame:
    """The outreach list, most opportunities first."""
    flagged = opportunity_flags(eligible_customers(customers, accounts, products, txn, as_of))
    flags = ["opportunity_savings", "opportunity_credit_card", "opportunity_mortgage", "opportunity_travel_card"]
    count = sum((F.col(f).cast("bigint") for f in flags[1:]), F.col(flags[0]).cast("bigint"))
    return (
        flagged.select(
            "customer_id", "customer_segment", "region", "age_band", "risk_rating", "product_count",
            F.round("total_balance_gbp", 0).alias("total_balance_gbp"),
            F.round("total_spend_6m", 0).alias("total_spend_6m"),
            *flags,
            count.alias("opportunity_count"),
            first_match([(F.col(f), product) for f, product in rules.NEXT_BEST_PRODUCT],
                        rules.NEXT_BEST_OTHER).alias("recommended_product"),
        )
        .filter(F.col("opportunity_count") > 0)
        .orderBy(F.desc("opportunity_count"), F.desc("total_balance_gbp"), "customer_id")
    )
