"""Customer value segmentation: recency, frequency, monetary."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline import rules
from ledgerline.functions import first_match, years_apart
from ledgerline.functions.dates import months_before
from ledgerline.operators.ntile import with_ntile
from ledgerline.schemas import ACTIVITY
from ledgerline.session import materialise
from ledgerline.sources.storage import replace_partitions, replace_snapshot


#: months from the window's start that one long holds as bits
_MASK_MONTHS = 63


def _unflagged(txn: DataFrame, as_of: date) -> DataFrame:
    """The window's transactions as ``customer_id, transaction_date, merchant_name, spend, n``."""
    spend = F.when(F.col("transaction_type") == "Debit", F.col("amount_gbp")).otherwise(0)
    return txn.filter(
        (F.col("transaction_date") >= F.lit(_window_start(as_of))) & (F.col("is_flagged") == F.lit(False))
    ).select("customer_id", "transaction_date", "merchant_name", spend.cast("decimal(18,2)").alias("spend"),
             F.lit(1).cast("bigint").alias("n"))


def _window_start(as_of: date) -> date:
    return months_before(as_of, rules.RFM_WINDOW_MONTHS)


def rfm_raw(txn: DataFrame, as_of: date) -> DataFrame:
    """Activity per customer over the last twelve months, flagged transactions left out.

    Recency counts from the day before ``as_of``, so a customer active on ``as_of`` has -1.
    """
    return _per_customer(_unflagged(txn, as_of), as_of)


def _per_customer(rows: DataFrame, as_of: date) -> DataFrame:
    """The figures of :func:`rfm_raw` from transactions or from sums of them by day and merchant.

    Rows are first grouped by customer and merchant, then by customer, each step a hash
    aggregation. Months are bits of a long, which groups merge. The window has no end, so a
    month more than five years past its start is possible: such a row comes a second time,
    carrying nothing but that month, and its months are counted as merchants are.
    """
    start, day = _window_start(as_of), F.col("transaction_date")
    month = (F.year(day) - start.year) * 12 + F.month(day) - start.month
    fits = month < _MASK_MONTHS
    nothing = F.lit(None)
    types = {f.name: f.dataType for f in rows.schema}

    def part(far_month: Column, own: bool) -> Column:
        names = ("merchant_name", "transaction_date", "spend", "n")
        return F.struct(
            *[(F.col(c) if own else nothing).cast(types[c]).alias(c) for c in names],
            far_month.cast("int").alias("far_month"),
            # the shift is by the low six bits only, so months that don't fit set no bit at all
            F.when(F.lit(own) & fits, F.call_function("shiftleft", F.lit(1).cast("bigint"), month)).otherwise(
                F.lit(0).cast("bigint")).alias("months"))

    own = part(nothing, True)
    parts = F.when(fits, F.array(own)).otherwise(F.array(own, part(month, False)))
    visits = rows.select("customer_id", F.inline(parts)).groupBy("customer_id", "merchant_name", "far_month").agg(
        F.sum("n").alias("n"), F.sum("spend").alias("spend"), F.bit_or("months").alias("months"),
        F.max("transaction_date").alias("last"), F.min("transaction_date").alias("first"))
    return visits.groupBy("customer_id").agg(
        F.datediff(F.lit(as_of - timedelta(days=1)), F.max("last")).alias("recency_days"),
        (F.bit_count(F.bit_or("months")) + F.count("far_month")).cast("bigint").alias("frequency_months"),
        F.round(F.sum("spend").cast("decimal(28,2)"), 2).alias("monetary_gbp"),
        F.sum("n").alias("total_transactions"),
        F.count("merchant_name").alias("unique_merchants"),
        F.max("last").alias("last_transaction_date"),
        F.min("first").alias("first_transaction_date"),
    )


def refresh_activity(txn: DataFrame, as_of: date, path: str, since: date | None = None) -> DataFrame:
    """Bring the stored sums by customer, day and merchant up to date; returns all of them.

    Only days after ``since``, the as-of date of the refresh before, are read from the facts
    and replaced; ``None`` reads the whole window. Days that were changed later than that are
    read again by passing an earlier ``since``. Expired days stay until
    :func:`ledgerline.sources.storage.expire_path` removes them; readers filter by day.
    """
    rows = _unflagged(txn, as_of)
    if since is not None:
        rows = rows.filter(F.col("transaction_date") > F.lit(since))
    daily = rows.groupBy("customer_id", "transaction_date", "merchant_name").agg(
        F.sum("spend").alias("spend"), F.sum("n").alias("n"))
    return replace_partitions(daily, ACTIVITY, path)


def rfm_raw_from_activity(activity: DataFrame, as_of: date) -> DataFrame:
    """:func:`rfm_raw` from the stored sums: days that have left the window are pruned, no fact is read."""
    return _per_customer(activity.filter(F.col("transaction_date") >= F.lit(_window_start(as_of))), as_of)


def rfm_scored(raw: DataFrame) -> DataFrame:
    """Quintile scores 1 to 5; ties go by ``customer_id``. The most recent customers score 5.

    ``raw`` is read more than once: pass a stored table (:func:`rfm_segments` does).
    """
    q = rules.RFM_QUANTILES
    scored = with_ntile(
        raw, q,
        {"r_score": "recency_days", "f_score": "frequency_months", "m_score": "monetary_gbp"},
        tie="customer_id",
    )
    return scored.withColumn("r_score", q + 1 - F.col("r_score"))


def segment_label(r: Column, f: Column, m: Column) -> Column:
    return first_match(
        [
            (r.between(*r_range) & f.between(*f_range) & m.between(*m_range), label)
            for label, r_range, f_range, m_range in rules.RFM_SEGMENTS
        ],
        rules.RFM_OTHER,
    )


def rfm_labelled(scored: DataFrame) -> DataFrame:
    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    return scored.withColumns({
        "rfm_composite_score": F.round((r + f + m) / F.lit(3.0), 2),
        "rfm_segment": segment_label(r, f, m),
    })


def rfm_profiles(scored: DataFrame, customers: DataFrame, as_of: date) -> DataFrame:
    """Labels plus customer attributes, value tier and churn risk. Not sorted."""
    r, f, composite = F.col("r_score"), F.col("f_score"), F.col("rfm_composite_score")
    attributes = customers.select(
        "customer_id", "customer_segment", "region", "age_band", "risk_rating", "customer_since"
    )
    return rfm_labelled(scored).join(attributes, "customer_id", "left").withColumns({
        "tenure_years": years_apart(F.lit(as_of), F.col("customer_since")),
        "clv_tier": first_match([(composite >= floor, tier) for floor, tier in rules.CLV_TIERS], rules.CLV_OTHER),
        "churn_risk": first_match([((r <= 2) & (f <= 2), "High"), (r <= 3, "Medium")], "Low"),
    })


def prepare_rfm(txn: DataFrame, as_of: date, folder: str | None = None) -> DataFrame:
    """The scored activity, stored below ``folder``. Runs the jobs: the tiles' ends are looked up in stored rows."""
    return _prepared(rfm_raw(txn, as_of), folder)


def _prepared(raw: DataFrame, folder: str | None = None) -> DataFrame:
    return materialise(rfm_scored(materialise(raw, "rfm_raw", folder)), "rfm_scored", folder)


def rfm_segments(
    txn: DataFrame, customers: DataFrame, as_of: date, run_ts: Column | None = None, sort: bool = True,
    scored: DataFrame | None = None,
) -> DataFrame:
    """The segmentation report, best customers first.

    Lazy when ``scored`` comes from :func:`prepare_rfm`; without it that step runs first.
    """
    out = rfm_profiles(prepare_rfm(txn, as_of) if scored is None else scored, customers, as_of)
    if run_ts is not None:
        out = out.withColumn("computed_at", run_ts)
    return out.orderBy(F.desc("rfm_composite_score"), "customer_id") if sort else out


def refresh_mv_customer_rfm(
    txn: DataFrame, customers: DataFrame, as_of: date, name: str, run_ts: Column | None = None,
    activity_path: str | None = None, since: date | None = None,
) -> DataFrame:
    """Daily snapshot of the segmentation behind the view ``name``, so readers need not scan twelve months again.

    With ``activity_path`` the refresh doesn't either: sums by day are kept there, and only
    the days after ``since`` are read from the facts (see :func:`refresh_activity`).
    """
    scored = None
    if activity_path is not None:
        scored = _prepared(rfm_raw_from_activity(refresh_activity(txn, as_of, activity_path, since), as_of))
    return replace_snapshot(rfm_segments(txn, customers, as_of, run_ts, sort=False, scored=scored), name)


def rfm_segment_summary(segments: DataFrame) -> DataFrame:
    """Customers, average spend and the most common churn risk of each segment."""
    per_risk = segments.groupBy("rfm_segment", "churn_risk").agg(
        F.count(F.lit(1)).alias("n"), F.sum("monetary_gbp").alias("spend")
    )
    # the largest group wins; equal sizes go to the alphabetically first label
    modal = F.min(F.struct((-F.col("n")).alias("rank"), "churn_risk"))["churn_risk"]
    return per_risk.groupBy("rfm_segment").agg(
        F.sum("n").alias("customers"),
        (F.sum("spend").cast("double") / F.sum("n")).alias("avg_monetary_gbp"),
        modal.alias("churn_risk"),
    ).orderBy("rfm_segment")
