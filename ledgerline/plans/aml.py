"""Money-laundering detectors."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ledgerline import rules
from ledgerline.functions import first_match, round_ratio, safe_ratio
from ledgerline.plans.geography import aml_geographic_anomaly

# ---------------------------------------------------------------- structuring


def sub_threshold_credits(txn: DataFrame) -> DataFrame:
    return txn.filter(
        (F.col("transaction_type") == "Credit")
        & F.col("amount_gbp").between(rules.STRUCTURING_LOW, rules.STRUCTURING_HIGH)
    )


def structuring_daily(txn: DataFrame) -> DataFrame:
    """Sub-threshold credits per customer and day."""
    return sub_threshold_credits(txn).groupBy("customer_id", "transaction_date").agg(
        F.count(F.lit(1)).alias("txn_count"),
        F.sum("amount_gbp").alias("daily_total_gbp"),
        F.max("amount_gbp").alias("largest_txn_gbp"),
        F.min("amount_gbp").alias("smallest_txn_gbp"),
    )


def structuring_transaction_ids(txn: DataFrame) -> DataFrame:
    """The transactions behind each customer-day, one row each: no group is gathered, whatever its size."""
    return sub_threshold_credits(txn).select("customer_id", "transaction_date", "transaction_id")


def structuring_rolling(txn: DataFrame, calendar: bool = False) -> DataFrame:
    """Totals over the last seven active days, or with ``calendar`` the last seven days.

    The window sees one row per customer and day, so a very active customer is at most
    as long as the retention period.
    """
    frame = W.partitionBy("customer_id")
    span = rules.STRUCTURING_FRAME - 1
    if calendar:
        frame = frame.orderBy(F.unix_date("transaction_date")).rangeBetween(-span, 0)
    else:
        frame = frame.orderBy("transaction_date").rowsBetween(-span, 0)
    return structuring_daily(txn).withColumns({
        "rolling_7d_total_gbp": F.sum("daily_total_gbp").over(frame),
        "rolling_7d_txn_count": F.sum("txn_count").over(frame),
    })


def structuring_severity(count: Column, total: Column) -> Column:
    return first_match(
        [((count >= n) & (total > t), label) for n, t, label in rules.STRUCTURING_SEVERITY],
        rules.SEVERITY_OTHER,
    )


def aml_structuring(
    txn: DataFrame, customers: DataFrame, calendar: bool = False, run_ts: Column | None = None, sort: bool = True
) -> DataFrame:
    """Repeated credits just below the reporting threshold."""
    n, total = F.col("rolling_7d_txn_count"), F.col("rolling_7d_total_gbp")
    hits = structuring_rolling(txn, calendar).filter(
        (n >= rules.STRUCTURING_MIN_COUNT) & (total > rules.STRUCTURING_MIN_TOTAL)
    )
    who = customers.select("customer_id", "customer_segment", "risk_rating", "region")
    out = hits.join(who, "customer_id").select(
        "customer_id", "customer_segment", "risk_rating", "region", "transaction_date", "txn_count",
        F.round("daily_total_gbp", 2).alias("daily_total_gbp"),
        F.round("rolling_7d_total_gbp", 2).alias("rolling_7d_total_gbp"),
        "rolling_7d_txn_count",
        structuring_severity(n, total).alias("alert_severity"),
        F.lit(rules.STRUCTURING_ALERT).alias("alert_type"),
    )
    return _finish(out, run_ts, sort, "alert_severity", F.desc("rolling_7d_total_gbp"), "customer_id", "transaction_date")


# ------------------------------------------------------------------- velocity


def _days_before(as_of: date, n: int) -> Column:
    return F.lit(as_of - timedelta(days=n))


def velocity_daily(txn: DataFrame, as_of: date) -> DataFrame:
    """Debit spend per customer and day over the whole window, history and recent days alike."""
    day = F.col("transaction_date")
    return (
        txn.filter(
            (F.col("transaction_type") == "Debit")
            & day.between(_days_before(as_of, rules.VELOCITY_HISTORY_DAYS), F.lit(as_of))
        )
        .groupBy("customer_id", "transaction_date")
        .agg(F.sum("amount_gbp").alias("daily_spend"), F.count(F.lit(1)).alias("txn_count"))
    )


def _is_history(as_of: date) -> Column:
    return F.col("transaction_date") < _days_before(as_of, rules.VELOCITY_RECENT_DAYS)


def velocity_baseline(txn: DataFrame, as_of: date) -> DataFrame:
    """Each customer's usual daily spend, over days with spend."""
    history = velocity_daily(txn, as_of).filter(_is_history(as_of))
    spend = F.col("daily_spend")
    return history.groupBy("customer_id").agg(
        safe_ratio(F.sum(spend), F.count(spend)).alias("avg_daily_spend"),
        F.stddev_samp(spend.cast("double")).alias("stddev_daily_spend"),
        F.percentile_approx(spend, 0.75).alias("p75_daily_spend"),
        F.percentile_approx(spend, 0.95).alias("p95_daily_spend"),
    )


def aml_velocity(txn: DataFrame, as_of: date, run_ts: Column | None = None, sort: bool = True) -> DataFrame:
    """Recent days far above the customer's own history.

    One scan serves history and recent days. Daily rows are few per customer (at most 91),
    so the history figures are computed in the customer's window and no join is needed;
    a customer without history has NULL figures and drops out.
    """
    spend, history = F.col("daily_spend"), _is_history(as_of)
    own = W.partitionBy("customer_id")
    past = F.when(history, spend)
    days = velocity_daily(txn, as_of).withColumns({
        "past_total": F.sum(past).over(own),
        "past_days": F.count(past).over(own),
        "stddev_daily_spend": F.stddev_samp(past.cast("double")).over(own),
        "p95_daily_spend": F.percentile_approx(past, 0.95).over(own),
    })
    avg = safe_ratio(F.col("past_total"), F.col("past_days"))
    amount = spend.cast("double")
    ratio = safe_ratio(amount, avg)
    hits = days.filter(~history).filter(
        (spend > F.col("p95_daily_spend")) & (amount > avg * rules.VELOCITY_MULTIPLE) & (avg > 0)
    )
    pence, past_pence = spend * 100, F.col("past_total") * 100
    out = hits.select(
        "customer_id", "transaction_date",
        F.round(spend, 2).alias("todays_spend_gbp"),
        round_ratio(past_pence, F.col("past_days") * 100, 2).alias("avg_daily_spend_gbp"),
        F.round("p95_daily_spend", 2).alias("p95_daily_spend_gbp"),
        "txn_count",
        F.round(safe_ratio(amount - avg, F.col("stddev_daily_spend")), 2).alias("z_score"),
        round_ratio(pence.cast("decimal(38,0)") * F.col("past_days").cast("decimal(10,0)"), past_pence, 1)
        .alias("spend_multiplier"),
        first_match([(ratio > floor, label) for floor, label in rules.VELOCITY_SEVERITY],
                    rules.SEVERITY_OTHER).alias("alert_severity"),
        F.lit(rules.VELOCITY_ALERT).alias("alert_type"),
    )
    return _finish(out, run_ts, sort, F.desc("spend_multiplier"), "customer_id", "transaction_date")


# -------------------------------------------------------------- round amounts


def is_round_amount(amount: Column, exact: bool = False) -> Column:
    """Whole hundreds. By default pence are rounded off first, so 999.60 counts; ``exact`` refuses it."""
    if exact:
        return amount % rules.ROUND_STEP == 0
    return F.round(amount, 0).cast("bigint") % rules.ROUND_STEP == 0


def aml_round_amount(
    txn: DataFrame, as_of: date, exact: bool = False, run_ts: Column | None = None, sort: bool = True
) -> DataFrame:
    """The same round amount at least five times in thirty days."""
    amount, n, total = F.col("amount_gbp"), F.col("frequency_30d"), F.col("total_exposure_gbp")
    repeats = (
        txn.filter(
            (F.col("transaction_date") >= _days_before(as_of, rules.ROUND_DAYS))
            & (amount >= rules.ROUND_LOW) & (amount < rules.ROUND_HIGH)
            & is_round_amount(amount, exact)
        )
        .groupBy("customer_id", "amount_gbp")
        .agg(
            F.count(F.lit(1)).alias("frequency_30d"),
            F.min("transaction_date").alias("first_seen"),
            F.max("transaction_date").alias("last_seen"),
            F.sum("amount_gbp").alias("total_exposure_gbp"),
            F.count_distinct("merchant_name").alias("distinct_merchants"),
        )
        .filter(n >= rules.ROUND_MIN_COUNT)
    )
    out = repeats.withColumns({
        "alert_type": F.lit(rules.ROUND_ALERT),
        "alert_severity": first_match(
            [((n >= c) & (total > t), label) for c, t, label in rules.ROUND_SEVERITY], rules.SEVERITY_OTHER),
    })
    return _finish(out, run_ts, sort, F.desc("total_exposure_gbp"), "customer_id", "amount_gbp")


# ------------------------------------------------------------------- layering


def layering_daily(txn: DataFrame, days: int = rules.LAYERING_DAYS) -> DataFrame:
    """Per customer and day with credits: how much of them was paid on within ``days`` days, oldest money first.

    A customer's flows are first summed by day, a day's credits before its debits, so a
    customer has at most as many rows as the calendar, whatever the number of transactions.
    Running totals turn each day's credits into an interval of the money ever received. What
    debits have used of it by a day is the total paid out, lowered by what exceeded the money
    there was: the least running balance so far, where that is negative. So each day's debits
    are an interval of the same line. Both kinds of interval follow one another, so the ends
    of all of them cut the line into pieces that belong to the last credit and the last debit
    begun before: one ordered window, without forming pairs of credits and debits.

    Rows without a positive amount or with another type are left out.
    """
    amount, kind, day = F.col("amount_gbp"), F.col("transaction_type"), F.col("transaction_date")

    def total(of: str) -> Column:
        return F.sum(F.when(kind == of, amount).otherwise(0)).cast("decimal(28,2)")

    flows = txn.filter(kind.isin("Credit", "Debit") & (amount > 0)).groupBy("customer_id", "transaction_date").agg(
        total("Credit").alias("credits"), total("Debit").alias("debits"))
    own = W.partitionBy("customer_id")
    by_day = own.orderBy("transaction_date")
    upto = by_day.rowsBetween(W.unboundedPreceding, 0)
    running = flows.withColumns({
        "paid_in": F.sum("credits").over(upto).cast("decimal(28,2)"),
        "paid_out": F.sum("debits").over(upto).cast("decimal(28,2)"),
    })
    lowest = F.min(F.col("paid_in") - F.col("paid_out")).over(upto)
    used = running.withColumn("used", (F.col("paid_out") + F.least(lowest, F.lit(0))).cast("decimal(28,2)")).withColumns({
        "used_before": F.coalesce(F.lag("used").over(by_day), F.lit(0).cast("decimal(28,2)")),
        "used_in_all": F.max("used").over(own),
    })

    def cut(at: Column, credit_day: Column, debit_day: Column, received: Column, where: Column) -> Column:
        return F.when(where, F.struct(at.cast("decimal(28,2)").alias("at"), credit_day.alias("credit_day"),
                                      debit_day.alias("debit_day"), received.alias("received")))

    no_day, nothing = F.lit(None).cast("date"), F.lit(None).cast("decimal(28,2)")
    spent = F.col("used") > F.col("used_before")
    cuts = F.array_compact(F.array(
        cut(F.col("paid_in") - F.col("credits"), day, no_day, F.col("credits"), F.col("credits") > 0),
        cut(F.col("used_before"), no_day, day, nothing, spent),
        cut(F.col("used"), no_day, no_day, nothing, spent),
    ))
    line = own.orderBy("at")
    pieces = used.select("customer_id", "used_in_all", F.inline(cuts)).withColumns({
        "credit_day": F.max("credit_day").over(line),
        "debit_day": F.max("debit_day").over(line),
        "size": F.lead("at").over(line) - F.col("at"),
    })
    in_time = (F.col("at") < F.col("used_in_all")) & (F.datediff("debit_day", "credit_day") <= days)
    return pieces.groupBy("customer_id", F.col("credit_day").alias("transaction_date")).agg(
        F.sum("received").cast("decimal(38,2)").alias("credits_gbp"),
        F.sum(F.when(in_time, F.col("size")).otherwise(0)).cast("decimal(38,2)").alias("passed_on_gbp"),
    ).withColumn("passed_on_pct", round_ratio(F.col("passed_on_gbp") * 100 * 100, F.col("credits_gbp") * 100, 2))


def aml_layering(
    txn: DataFrame, customers: DataFrame, days: int = rules.LAYERING_DAYS, run_ts: Column | None = None, sort: bool = True
) -> DataFrame:
    """Days whose large credits were mostly paid on within a few days."""
    credits, passed = F.col("credits_gbp"), F.col("passed_on_gbp")
    hits = layering_daily(txn, days).filter(
        (credits >= rules.LAYERING_MIN_CREDITS) & (passed * 100 >= credits * rules.LAYERING_MIN_SHARE_PCT))
    who = customers.select("customer_id", "customer_segment", "risk_rating", "region")
    out = hits.join(who, "customer_id").select(
        "customer_id", "customer_segment", "risk_rating", "region", "transaction_date", "credits_gbp", "passed_on_gbp",
        "passed_on_pct", F.lit(rules.LAYERING_ALERT).alias("alert_type"))
    return _finish(out, run_ts, sort, F.desc("passed_on_gbp"), "customer_id", "transaction_date")


# ------------------------------------------------------- documented extensions


def high_risk_exposure(txn: DataFrame, categories: DataFrame, as_of: date, sort: bool = True) -> DataFrame:
    """Thirty days of foreign and high-risk-category activity per customer."""
    foreign = F.col("merchant_country") != rules.HOME_COUNTRY
    risky = F.coalesce(F.col("is_high_risk"), F.lit(False))
    codes = categories.select(F.col("mcc_code").alias("merchant_category_code"), "is_high_risk")
    money = F.col("amount_gbp")
    out = (
        txn.filter(F.col("transaction_date") >= _days_before(as_of, rules.ROUND_DAYS))
        .join(codes, "merchant_category_code", "left")
        .filter(foreign | risky)
        .groupBy("customer_id")
        .agg(
            F.count_if(foreign).alias("foreign_txns"),
            F.sum(F.when(foreign, money).otherwise(0)).alias("foreign_gbp"),
            F.count_if(risky).alias("high_risk_category_txns"),
            F.sum(F.when(risky, money).otherwise(0)).alias("high_risk_category_gbp"),
            F.count_if(foreign & risky).alias("foreign_high_risk_txns"),
        )
    )
    return _finish(out, None, sort, F.desc("foreign_gbp"), "customer_id")


def aml_flag_summary(txn: DataFrame, customers: DataFrame, as_of: date) -> DataFrame:
    """Alerts, transactions and value of each alert type over the last thirty days. Runs the job of the geographic scores."""
    since = _days_before(as_of, rules.ROUND_DAYS)
    structuring = aml_structuring(txn, customers, sort=False).filter(F.col("transaction_date") >= since).select(
        "alert_type", F.col("txn_count").alias("n"), F.col("daily_total_gbp").alias("value"))
    velocity = aml_velocity(txn, as_of, sort=False).select(
        "alert_type", F.col("txn_count").alias("n"), F.col("todays_spend_gbp").alias("value"))
    rounded = aml_round_amount(txn, as_of, sort=False).select(
        "alert_type", F.col("frequency_30d").alias("n"), F.col("total_exposure_gbp").alias("value"))
    abroad = aml_geographic_anomaly(txn, customers, as_of, sort=False).select(
        "alert_type", F.col("payments").alias("n"), F.col("amount_gbp").alias("value"))
    return (
        structuring.unionByName(velocity).unionByName(rounded).unionByName(abroad)
        .groupBy("alert_type")
        .agg(F.count(F.lit(1)).alias("alerts"), F.sum("n").alias("transactions"), F.sum("value").alias("value_gbp"))
        .orderBy("alert_type")
    )


def _finish(df: DataFrame, run_ts: Column | None, sort: bool, *order: Column | str) -> DataFrame:
    """Detection time and report order; a caller that aggregates further needs neither."""
    if run_ts is not None:
        df = df.withColumn("detected_at", run_ts)
    return df.orderBy(*order) if sort else df
