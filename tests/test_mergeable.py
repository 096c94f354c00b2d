"""Stored bitmaps and sketches: numbering, merging, bounds."""

from datetime import date, timedelta

from frames import AS_OF, accounts, customers, transactions
from pyspark.sql import functions as F

from ledgerline.plans import mergeable
from ledgerline.session import materialise
from ledgerline.sources.dimensions import dim_products


def _ids(spark, n, start=0):
    return spark.range(start, start + n).select(F.format_string("CUST%08d", "id").alias("customer_id"))


def test_numbers_are_dense_and_stay(spark):
    twice = _ids(spark, 500).unionByName(_ids(spark, 300)).unionByName(spark.sql("select cast(null as string) as customer_id"))
    first = materialise(mergeable.customer_numbers(twice, parts=7), "numbers")
    given = {r.customer_id: r.customer_number for r in first.collect()}
    assert len(given) == 500 and sorted(given.values()) == list(range(1, 501))
    later = {r.customer_id: r.customer_number for r in mergeable.customer_numbers(_ids(spark, 800), first, parts=7).collect()}
    assert sorted(later.values()) == list(range(1, 801)) and all(later[c] == n for c, n in given.items())
    assert mergeable.customer_numbers(_ids(spark, 0)).count() == 0
    assert mergeable.customer_numbers(_ids(spark, 500), first).count() == 500


def test_totals_over_several_bitmap_buckets(spark):
    """More customers than one bitmap holds; some in two product types, regions count them once."""
    n = 40_000
    who = _ids(spark, n).select("customer_id", F.when(F.crc32("customer_id") % 3 == 0, "North").otherwise("South").alias("region"),
                                F.lit("Retail").alias("customer_segment"))
    numbers = materialise(mergeable.customer_numbers(who), "numbers")
    held = who.select("customer_id", F.explode(F.array(F.lit("PRD001"), F.lit("PRD003"), F.lit("PRD003"))).alias("product_id")).filter(
        "product_id = 'PRD001' or crc32(customer_id) % 2 = 0")
    acct = held.select("customer_id", "product_id", F.lit(date(2024, 12, 1)).alias("snapshot_month"), F.lit("Active").alias("account_status"))
    dormant = acct.limit(50).withColumn("account_status", F.lit("Dormant")).withColumn("snapshot_month", F.lit(date(2024, 11, 1)))
    bitmaps = mergeable.active_customer_bitmaps(acct.unionByName(dormant), dim_products(spark), who, numbers)
    assert bitmaps.select("bucket").distinct().count() == 2
    got = {(r.level, r.product_type, r.region): r.active_customers for r in mergeable.active_customer_totals(bitmaps).collect()}
    count = {r.region: (r.n, r.half) for r in who.groupBy("region").agg(
        F.count("*").alias("n"), F.count_if(F.crc32("customer_id") % 2 == 0).alias("half")).collect()}
    wanted = {("bank", None, None): n}
    for region, (all_of, half) in count.items():
        wanted |= {("region", None, region): all_of, ("group", "Current Account", region): all_of, ("group", "Savings", region): half}
    assert got == wanted


def test_unknown_groups_and_no_accounts(spark):
    who = customers(spark, [dict(customer_id="C1", region=None), dict(customer_id="C2")])
    numbers = materialise(mergeable.customer_numbers(who), "numbers")
    args = dim_products(spark), who, numbers
    rows = accounts(spark, [dict(customer_id="C1"), dict(customer_id="C2"), dict(customer_id="C9")])
    got = mergeable.active_customer_totals(mergeable.active_customer_bitmaps(rows, *args)).collect()
    assert {(r.level, r.region): r.active_customers for r in got} == {
        ("group", None): 1, ("region", None): 1, ("group", "North"): 1, ("region", "North"): 1, ("bank", None): 2}
    none = mergeable.active_customer_bitmaps(rows.filter("false"), *args)
    assert mergeable.active_customer_totals(none).collect() == []


def test_sketches_of_days_merge_into_periods(spark):
    rows = spark.range(120_000).select(
        F.lit("POS").alias("channel"), F.lit("Debit").alias("transaction_type"),
        F.concat(F.lit("A"), F.col("id") % 30_000).alias("account_id"), F.concat(F.lit("C"), F.col("id") % 30_000).alias("customer_id"),
        F.date_sub(F.lit(AS_OF), (F.col("id") / 30_000).cast("int") * 6).alias("transaction_date"),
        (F.col("id") % 1000 + 1).cast("decimal(18,2)").alias("amount_gbp"))
    late = rows.limit(10).withColumn("transaction_date", F.lit(AS_OF + timedelta(days=1)))
    txn = materialise(rows.unionByName(late), "txn")
    found = {r.period_days: r for r in mergeable.accounts_by_period(mergeable.account_sketches(txn), AS_OF).collect()}
    assert set(found) == set(mergeable.PERIODS)
    assert all(r.at_least <= 30_000 <= r.at_most for r in found.values())
    who = txn.select("customer_id").distinct().withColumn("customer_segment", F.lit("Retail"))
    got = mergeable.spend_baselines(mergeable.spend_sketches(mergeable.daily_spend(txn, who)), AS_OF).collect()
    assert {(r.period_days, r.quantile): r.customer_days for r in got} == {
        (p, q): 30_000 * n for p, n in ((7, 2), (30, 4), (90, 4), (365, 4)) for q in (0.5, 0.75, 0.95)}
    assert all(abs(r.spend / 1000 - r.quantile) <= mergeable.KLL_BOUND for r in got)


def test_no_transactions(spark):
    txn, who = transactions(spark, []), customers(spark, [{}])
    assert mergeable.accounts_by_period(mergeable.account_sketches(txn), AS_OF).collect() == []
    assert mergeable.spend_baselines(mergeable.spend_sketches(mergeable.daily_spend(txn, who)), AS_OF).collect() == []
