"""Payments from places that a customer is unlikely to have gone to next."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ledgerline import rules
from ledgerline.functions import first_match
from ledgerline.session import materialise

STATE = ["customer_segment", "gap", "previous_country"]
MOVE = [*STATE, "merchant_country"]


def _since(as_of: date, days: int) -> Column:
    return F.lit(as_of - timedelta(days=days))


def _gap(days: Column) -> Column:
    return first_match([(days <= upto, label) for upto, label in rules.GEO_GAPS], rules.GEO_GAP_OTHER)


def country_moves(txn: DataFrame, customers: DataFrame, as_of: date) -> DataFrame:
    """A customer's payments by day and country, each with the country before it and the time since then.

    Payments are summed by customer, day and country where they lie, so the ordered window
    sees at most a row per day and country, however many payments a customer makes. Within a
    day countries follow one another by their first payment, then by name. The first row of a
    customer has no previous country. Payments without a country, or of unknown customers,
    are left out; a customer without a segment is in segment ``Unknown``.
    """
    cells = txn.filter(
        (F.col("transaction_date") >= _since(as_of, rules.GEO_HISTORY_DAYS)) & F.col("merchant_country").isNotNull()
    ).groupBy("customer_id", "transaction_date", "merchant_country").agg(
        F.min("transaction_timestamp").alias("first_at"),
        F.count(F.lit(1)).alias("payments"),
        F.sum("amount_gbp").alias("amount_gbp"),
    )
    who = customers.select("customer_id", F.coalesce("customer_segment", F.lit(rules.GEO_NO_SEGMENT)).alias("customer_segment"))
    order = W.partitionBy("customer_id").orderBy("transaction_date", "first_at", "merchant_country")
    before = F.lag("transaction_date").over(order)
    return cells.join(who, "customer_id").withColumns({
        "previous_country": F.lag("merchant_country").over(order),
        "days_since": F.datediff("transaction_date", before),
    }).withColumn("gap", F.when(F.col("days_since").isNotNull(), _gap(F.col("days_since")))).drop("first_at")


def transition_counts(moves: DataFrame) -> DataFrame:
    """How often each segment went from one country to another after each gap, and how often it paid in each.

    Further payments in the same country on the same day are moves to that country itself.
    At most one row per segment, gap and pair of countries.
    """
    gone = moves.filter(F.col("previous_country").isNotNull()).groupBy(*MOVE).agg(F.count(F.lit(1)).alias("moves"))
    stayed = moves.filter("payments > 1").groupBy("customer_segment", "merchant_country").agg(
        F.sum(F.col("payments") - 1).alias("moves")).select(
        "customer_segment", F.lit(rules.GEO_GAPS[0][1]).alias("gap"), F.col("merchant_country").alias("previous_country"),
        "merchant_country", "moves")
    return gone.unionByName(stayed).groupBy(*MOVE).agg(F.sum("moves").alias("moves"))


def move_probabilities(asked: DataFrame, past: DataFrame) -> DataFrame:
    """The probability of each different move in ``asked``, learned from the moves in ``past``.

    The counts of a state (segment, gap, country before) are smoothed towards the segment's
    shares of payments by country, which weigh as much as ``GEO_PRIOR`` moves; the shares in
    turn are smoothed towards one payment spread over all countries there are. So a state or
    country never seen before has a probability too. Only moves that differ are joined with
    the counts, never the customers' rows.
    """
    counts = transition_counts(past)
    states = counts.groupBy(*STATE).agg(F.sum("moves").alias("state_moves"))
    paid = past.groupBy("customer_segment", "merchant_country").agg(F.sum("payments").alias("country_payments"))
    segments = paid.groupBy("customer_segment").agg(F.sum("country_payments").alias("segment_payments"))

    def known(column: str) -> Column:
        return F.coalesce(F.col(column), F.lit(0)).cast("double")

    countries, prior = F.lit(float(rules.GEO_COUNTRIES)), F.lit(float(rules.GEO_PRIOR))
    share = (known("country_payments") * countries + 1.0) / ((known("segment_payments") + 1.0) * countries)
    return (
        asked.select(*MOVE).distinct()
        .join(counts, MOVE, "left").join(states, STATE, "left")
        .join(paid, ["customer_segment", "merchant_country"], "left").join(segments, "customer_segment", "left")
        .select(*MOVE, ((known("moves") + prior * share) / (known("state_moves") + prior)).alias("probability"))
    )


def geographic_scores(txn: DataFrame, customers: DataFrame, as_of: date) -> DataFrame:
    """The last thirty days' moves with their probabilities, learned from the time before. Runs a job.

    A customer's first payment of all has no move and no row.
    """
    moves = materialise(country_moves(txn, customers, as_of), "country_moves")
    recent = F.col("transaction_date") >= _since(as_of, rules.GEO_RECENT_DAYS)
    asked = moves.filter(recent & F.col("previous_country").isNotNull())
    return asked.join(move_probabilities(asked, moves.filter(~recent)), MOVE)


def aml_geographic_anomaly(
    txn: DataFrame, customers: DataFrame, as_of: date, run_ts: Column | None = None, sort: bool = True
) -> DataFrame:
    """Payments in a country that the customer's segment rarely goes to from the one before, after such a time."""
    out = geographic_scores(txn, customers, as_of).filter(F.col("probability") < rules.GEO_MAX_PROBABILITY).select(
        "customer_id", "customer_segment", "transaction_date", "previous_country", "merchant_country", "gap",
        "payments", "amount_gbp", "probability", F.lit(rules.GEO_ALERT).alias("alert_type"))
    if run_ts is not None:
        out = out.withColumn("detected_at", run_ts)
    return out.orderBy("probability", F.desc("amount_gbp"), "customer_id", "transaction_date", "merchant_country") if sort else out
