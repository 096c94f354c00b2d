"""Stored state that can be merged: bitmaps for exact distinct counts, sketches for estimates.

Each state is computed once from the facts and stored; figures for any coarser group or
longer period come from merging it, without reading the facts again.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ledgerline.plans.pnl import spread_account_star
from ledgerline.session import materialise

#: windows that order the new customers to be numbered
NUMBERING_PARTS = 1024


def customer_numbers(customers: DataFrame, known: DataFrame | None = None, parts: int = NUMBERING_PARTS) -> DataFrame:
    """``customer_id, customer_number``: each customer's own number, from 1 without gaps. Runs a job.

    Customers are dealt by hash into ``parts`` ordered windows; a part starts where the ones
    before it end, so no task orders all of them. Numbers in ``known`` stay as they are and
    new customers go on from there, so stored bitmaps stay valid. Repeated ids get one
    number, a missing id none.
    """
    ids = customers.select("customer_id").filter(F.col("customer_id").isNotNull()).distinct()
    if known is not None:
        ids = ids.join(known, "customer_id", "left_anti")
    dealt = materialise(ids.withColumn("part", F.pmod(F.xxhash64("customer_id"), F.lit(parts))), "customer_parts")
    taken = known.agg(F.max("customer_number")).first()[0] if known is not None else None
    # at most `parts` rows: one window over all of them is small
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    starts = dealt.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    last = 0 if taken is None else taken
    rank = F.row_number().over(W.partitionBy("part").orderBy("customer_id"))
    new = dealt.withColumn("rank", rank).join(F.broadcast(starts), "part").select(
        "customer_id", (F.col("start") + F.col("rank") + F.lit(last)).cast("bigint").alias("customer_number"))
    return new if known is None else known.select("customer_id", "customer_number").unionByName(new)


def active_customer_bitmaps(
    accounts: DataFrame, products: DataFrame, customers: DataFrame, numbers: DataFrame
) -> DataFrame:
    """The customers with an active account per month, product type, region and segment, as bitmaps.

    A row holds 32,768 neighbouring numbers in 4 KB, so a group has as many rows as the
    customers need, and its members are never gathered in one place.
    """
    number = F.col("customer_number")
    return (
        spread_account_star(
            accounts.filter(F.col("account_status") == "Active"), products, customers, ("product_id", "snapshot_month"))
        .select("snapshot_month", "product_type", "region", "customer_segment", "customer_id").distinct()
        .join(numbers, "customer_id")
        .groupBy("snapshot_month", "product_type", "region", "customer_segment", F.bitmap_bucket_number(number).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bitmap"))
    )


def active_customer_totals(bitmaps: DataFrame) -> DataFrame:
    """Exact distinct active customers of each month per group, region and the bank, from the stored bitmaps."""
    keys = ["product_type", "region", "customer_segment"]

    def level(name: str, *kept: str) -> Column:
        return F.struct(F.lit(name).alias("level"),
                        *[(F.col(k) if k in kept else F.lit(None).cast("string")).alias(k) for k in keys])

    levels = F.array(level("group", *keys), level("region", "region"), level("bank"))
    return (
        bitmaps.select("snapshot_month", "bucket", "bitmap", F.inline(levels))
        .groupBy("snapshot_month", "level", *keys, "bucket")
        .agg(F.bitmap_count(F.bitmap_or_agg("bitmap")).alias("customers"))
        .groupBy("snapshot_month", "level", *keys).agg(F.sum("customers").alias("active_customers"))
    )


#: periods that end on the as-of date, in days
PERIODS = (7, 30, 90, 365)
#: 2 to this power registers a sketch; three standard errors of a union are below the bound
HLL_LG_K, HLL_BOUND = 12, 0.05
#: size of a quantile sketch, and the rank error that it stays below (0.5 % at 99 % confidence)
KLL_K, KLL_BOUND = 800, 0.02


def periods_of(as_of: date) -> Column:
    """The periods that ``transaction_date`` lies in, as an array."""
    day = F.col("transaction_date")
    return F.array_compact(F.array(*[
        F.when(day.between(F.lit(as_of - timedelta(days=n - 1)), F.lit(as_of)), F.lit(n)) for n in PERIODS]))


def account_sketches(txn: DataFrame) -> DataFrame:
    """Per day and channel a sketch of the accounts that paid; a few KB whatever the number of rows."""
    return txn.groupBy("transaction_date", "channel").agg(F.hll_sketch_agg("account_id", HLL_LG_K).alias("accounts"))


def accounts_by_period(sketches: DataFrame, as_of: date) -> DataFrame:
    """Estimated distinct accounts per channel and period, with bounds, from the stored sketches."""
    estimate = F.hll_sketch_estimate(F.hll_union_agg("accounts"))
    return sketches.select("channel", "accounts", F.explode(periods_of(as_of)).alias("period_days")).groupBy(
        "period_days", "channel").agg(estimate.alias("estimate")).withColumns({
            "at_least": F.floor(F.col("estimate") * (1 - HLL_BOUND)), "at_most": F.ceil(F.col("estimate") * (1 + HLL_BOUND))})


def daily_spend(txn: DataFrame, customers: DataFrame) -> DataFrame:
    """Each customer's debits per day, with the segment."""
    spend = txn.filter(F.col("transaction_type") == "Debit").groupBy("customer_id", "transaction_date").agg(
        F.sum("amount_gbp").cast("double").alias("spend"))
    return spend.join(customers.select("customer_id", "customer_segment"), "customer_id")


def spend_sketches(spend: DataFrame) -> DataFrame:
    """Per day and segment a quantile sketch of the customers' daily spend."""
    return spend.groupBy("transaction_date", "customer_segment").agg(
        F.kll_sketch_agg_double("spend", F.lit(KLL_K)).alias("spends"), F.count(F.lit(1)).alias("customer_days"))


def spend_baselines(sketches: DataFrame, as_of: date, quantiles: tuple[float, ...] = (0.5, 0.75, 0.95)) -> DataFrame:
    """Quantiles of daily spend per segment and period, from the stored sketches; the rank is off by ``KLL_BOUND`` at most."""
    merged = sketches.select("customer_segment", "spends", "customer_days", F.explode(periods_of(as_of)).alias("period_days")).groupBy(
        "period_days", "customer_segment").agg(
        F.kll_merge_agg_double("spends", F.lit(KLL_K)).alias("merged"), F.sum("customer_days").alias("customer_days"))
    rows = F.array(*[F.struct(F.lit(q).alias("quantile"), F.kll_sketch_get_quantile_double("merged", F.lit(q)).alias("spend"))
                     for q in quantiles])
    return merged.select("period_days", "customer_segment", "customer_days", F.inline(rows))
