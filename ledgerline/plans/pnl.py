"""Monthly profit and loss."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ledgerline.functions import mean_of, month_of, round_ratio, safe_ratio
from ledgerline.schemas import EXECUTIVE_SUMMARY
from ledgerline.sources.storage import replace_partitions

GROUP = ["snapshot_month", "product_type", "region", "customer_segment"]
GROUP_FAMILY = ["snapshot_month", "product_type", "product_family", "region", "customer_segment"]


def account_star(accounts: DataFrame, products: DataFrame, customers: DataFrame) -> DataFrame:
    """Account snapshots with product and customer attributes.

    No join hints: Spark broadcasts a dimension that is known to be small, otherwise it
    sort-merge joins, and adaptive execution splits a customer with very many accounts.
    """
    kinds = products.select("product_id", "product_type", "product_family")
    owners = customers.select("customer_id", "region", "customer_segment")
    return accounts.join(kinds, "product_id").join(owners, "customer_id")


#: shares that a customer's accounts are dealt into, so one with very many fills no single task
SHARES = 8


def spread_account_star(
    accounts: DataFrame, products: DataFrame, customers: DataFrame, by: tuple[str, ...] = ("account_id",)
) -> DataFrame:
    """:func:`account_star` with each row's ``share``, by hash of the columns ``by``, over as many tasks as the session has shuffle partitions.

    For steps that keep a row per account. Account rows compress so well that adaptive execution
    takes many for little and merges them into a few tasks that hold gigabytes; a number that is
    asked for isn't merged. A skewed task isn't split then either, so rows are dealt into shares
    and each customer meets every share. Grouping by customer, account and share needs no further shuffle.
    """
    parts = int(accounts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kinds = products.select("product_id", "product_type", "product_family")
    owners = customers.select(
        "customer_id", "region", "customer_segment", F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1))).alias("share"))
    dealt = accounts.join(kinds, "product_id").withColumn(
        "share", F.pmod(F.xxhash64(*by), F.lit(SHARES)).cast("int")).repartition(parts, "customer_id", "share")
    return dealt.join(owners, ["customer_id", "share"])


def monthly_transaction_counts(txn: DataFrame) -> DataFrame:
    """Transactions per customer and month; all the fee rule needs to know about them."""
    return txn.groupBy("customer_id", month_of(F.col("transaction_date")).alias("snapshot_month")).agg(
        F.count(F.lit(1)).alias("txn_count")
    )


def _interest_sums() -> list[Column]:
    charged, earned = F.sum("interest_charged_gbp"), F.sum("interest_earned_gbp")
    return [
        charged.alias("interest_income_gbp"),
        earned.alias("interest_cost_gbp"),
        (charged - earned).alias("net_interest_gbp"),
    ]


def _fee_sum(per_transaction: bool) -> Column:
    fee = F.col("fees_charged_gbp")
    if per_transaction:
        fee = fee * F.col("txn_count").cast("decimal(18,0)")
    return F.sum(fee).alias("fee_income_gbp")


def net_interest(accounts: DataFrame, products: DataFrame, customers: DataFrame) -> DataFrame:
    return account_star(accounts, products, customers).groupBy(*GROUP_FAMILY).agg(*_interest_sums())


def fee_income(
    accounts: DataFrame, products: DataFrame, customers: DataFrame, txn: DataFrame, per_transaction: bool = True
) -> DataFrame:
    """Account fees in months in which the customer made a transaction.

    ``per_transaction`` (the default) counts an account's fee once for each transaction of
    its customer in the month; otherwise once. Either way transactions are first reduced
    to a count per customer and month, so the pairs of accounts and transactions are
    never formed.
    """
    star = account_star(accounts, products, customers)
    return (
        star.join(monthly_transaction_counts(txn), ["customer_id", "snapshot_month"])
        .groupBy(*GROUP_FAMILY).agg(_fee_sum(per_transaction))
    )


#: what a group adds up; sums of money keep the type that a sum over the rows has
_MONEY_SUM = "decimal(28,2)"


def _per_account(star: DataFrame, keys: list[str], counted: Column, paid: Column) -> DataFrame:
    """One row per group, customer and account, with its sums; the account figures only over rows where ``counted`` holds.

    Repeated rows of an account meet here, while rows are still combined where they lie, so
    the next step can count accounts and customers without a second copy of every row.
    """
    def of(value: Column) -> Column:
        return F.when(counted, value)

    balance = F.col("balance_gbp")
    return star.groupBy(*keys, "customer_id", "account_id").agg(
        F.sum("interest_charged_gbp").alias("charged"),
        F.sum("interest_earned_gbp").alias("earned"),
        F.sum(paid).alias("paid"),
        F.max(counted).alias("counted"),
        F.sum(of(F.when(F.col("days_in_arrears") > 0, 1).otherwise(0))).alias("in_arrears"),
        F.sum(of(balance)).alias("balance"),
        F.count(of(balance)).alias("balances"),
        F.sum(of(F.abs(balance))).alias("book"),
    )


def _total(column: str) -> Column:
    return F.sum(column).cast(_MONEY_SUM)


def _count_columns() -> list[Column]:
    """Account figures from :func:`_per_account`; NULL when the group has no counted row.

    An account that two customers share in a month counts for each of them.
    """
    none = F.lit(0)
    return [
        F.nullif(F.count(F.when(F.col("counted"), F.col("account_id"))), none).alias("active_accounts"),
        F.nullif(F.count_distinct(F.when(F.col("counted"), F.col("customer_id"))), none).alias("active_customers"),
        F.sum("in_arrears").alias("accounts_in_arrears"),
        _total("balance").alias("balance_total_gbp"),
        F.sum("balances").alias("balance_count"),
        _total("book").alias("total_book_gbp"),
    ]


def account_counts(accounts: DataFrame, products: DataFrame, customers: DataFrame) -> DataFrame:
    """Active accounts and customers, arrears, average balance and book."""
    active = accounts.filter(F.col("account_status") == "Active")
    star = spread_account_star(active, products, customers)
    each = _per_account(star, [*GROUP, "share"], F.lit(True), F.lit(None).cast("decimal(18,2)"))
    counts = each.groupBy(*GROUP).agg(*_count_columns())
    return counts.withColumn(
        "avg_balance_gbp", safe_ratio(F.col("balance_total_gbp"), F.col("balance_count"))
    ).drop("balance_total_gbp", "balance_count")


def months_to_compare(accounts: DataFrame, products: DataFrame, customers: DataFrame, report_month: date) -> list[date]:
    """The earlier months that the change column of ``report_month`` compares with: each group's last one.

    Runs a job that reads the groups' keys only, no amounts and no transactions. It is nearly
    always a single month.
    """
    earlier = accounts.filter(F.col("snapshot_month") < F.lit(report_month.replace(day=1))).select(
        "customer_id", "product_id", "snapshot_month").distinct()
    last = account_star(earlier, products, customers).groupBy("product_type", "region", "customer_segment").agg(
        F.max("snapshot_month").alias("month"))
    return sorted(r.month for r in last.select("month").distinct().collect())


def monthly_pnl(
    accounts: DataFrame,
    products: DataFrame,
    customers: DataFrame,
    txn: DataFrame,
    report_month: date | None = None,
    compared: list[date] | None = None,
    run_ts: Column | None = None,
) -> DataFrame:
    """The profit and loss view, newest month first.

    One pass over the accounts gives interest, account figures and fees: the fee rule only
    needs each customer's number of transactions in the month, which is joined to the
    account before anything is summed up.

    Fees and account figures meet the interest of a group on month, product type, region
    and segment. That says the same as the pass above while a product type has one family
    in the group; two would multiply rows, so the view stops with an error there. As in a
    join on equal keys, groups of unknown region or segment have no account figures and no
    fees.

    ``report_month`` keeps one month. Only that month and the months in ``compared`` (see
    :func:`months_to_compare`) are read; without ``compared`` there is no change column.
    """
    months = None if report_month is None else sorted({report_month.replace(day=1), *(compared or ())})
    if months is not None:
        accounts = accounts.filter(F.col("snapshot_month").isin(months))
        day = F.col("transaction_date")
        txn = txn.filter(_any([day.between(F.lit(m), F.lit(_month_end(m))) for m in months]))
    known = F.lit(True)
    for key in GROUP:
        known = known & F.col(key).isNotNull()
    paid = F.when(known, F.col("fees_charged_gbp") * F.coalesce("txn_count", F.lit(0)).cast("decimal(18,0)"))
    star = account_star(accounts, products, customers).join(
        monthly_transaction_counts(txn), ["customer_id", "snapshot_month"], "left")
    each = _per_account(star, GROUP_FAMILY, (F.col("account_status") == "Active") & known, paid)
    book_side = each.groupBy(*GROUP_FAMILY).agg(
        _total("charged").alias("interest_income_gbp"), _total("earned").alias("interest_cost_gbp"),
        (_total("charged") - _total("earned")).alias("net_interest_gbp"),
        F.coalesce(F.sum("paid"), F.lit(0)).alias("fee_income_gbp"), *_count_columns())
    net, fee, book = F.col("net_interest_gbp"), F.col("fee_income_gbp"), F.col("total_book_gbp")
    history = W.partitionBy("product_type", "region", "customer_segment").orderBy("snapshot_month", "product_family")
    two_families = F.lag("snapshot_month").over(history) == F.col("snapshot_month")
    joined = book_side.withColumn("revenue", net + fee).withColumns({
        "previous_revenue": F.lag("revenue").over(history), "two_families": F.coalesce(two_families, F.lit(False))})
    revenue = F.when(F.col("two_families"), F.raise_error(F.concat(
        F.lit("a product type must lie in one family: "), F.col("product_type"))).cast("decimal(38,2)")).otherwise(F.col("revenue"))
    view = joined.select(
        *GROUP_FAMILY,
        "active_accounts",
        "active_customers",
        F.round(book, 0).alias("total_book_gbp"),
        round_ratio(F.col("balance_total_gbp") * 100, F.col("balance_count") * 100, 2).alias("avg_balance_gbp"),
        F.round(net, 0).alias("net_interest_income_gbp"),
        F.round("interest_income_gbp", 0).alias("gross_interest_income_gbp"),
        F.round("interest_cost_gbp", 0).alias("interest_cost_gbp"),
        F.round(fee, 0).alias("fee_income_gbp"),
        F.round(revenue, 0).alias("total_revenue_gbp"),
        "accounts_in_arrears",
        round_ratio(F.col("accounts_in_arrears") * 100, F.col("active_accounts"), 2).alias("arrears_rate_pct"),
        round_ratio(net * 100 * 1200, book * 100, 3).alias("nim_annualised_pct"),
        F.round(F.col("revenue") - F.col("previous_revenue"), 0).alias("mom_revenue_delta_gbp"),
    )
    if report_month is not None:
        view = view.filter(F.col("snapshot_month") == F.lit(report_month.replace(day=1)))
        if compared is None:
            view = view.drop("mom_revenue_delta_gbp")
    if run_ts is not None:
        view = view.withColumn("refreshed_at", run_ts)
    return view.orderBy(F.desc("snapshot_month"), F.desc("total_revenue_gbp"), *GROUP_FAMILY[1:])


def _any(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out | c
    return out


def _month_end(first: date) -> date:
    return date(first.year + first.month // 12, first.month % 12 + 1, 1) - timedelta(days=1)


def executive_summary(pnl: DataFrame, run_date: date, run_ts: Column | None = None) -> DataFrame:
    """One row of headline figures for the month of ``run_date``.

    ``pnl`` may be the whole view, but ``monthly_pnl(..., run_date)`` reads just the month.

    Customers are added up over the groups, so one with several product types counts
    several times, and the ratios are plain averages over groups;
    :func:`executive_summary_from_base` gives the unduplicated, weighted figures.
    """
    month = pnl.filter(F.col("snapshot_month") == F.lit(run_date.replace(day=1)))
    out = month.agg(
        F.lit(run_date).alias("report_month"),
        F.sum("total_revenue_gbp").alias("total_revenue_gbp"),
        F.sum("net_interest_income_gbp").alias("total_nii_gbp"),
        F.sum("fee_income_gbp").alias("total_fee_income_gbp"),
        F.sum("active_customers").alias("total_active_customers"),
        F.sum("active_accounts").alias("total_active_accounts"),
        F.sum("total_book_gbp").alias("total_book_gbp"),
        mean_of(F.col("nim_annualised_pct")).alias("avg_nim_pct"),
        mean_of(F.col("arrears_rate_pct")).alias("avg_arrears_rate_pct"),
    )
    return out if run_ts is None else out.withColumn("inserted_at", run_ts)


def store_executive_summary(pnl: DataFrame, run_date: date, path: str, run_ts: Column) -> DataFrame:
    """Store the month's row, in place of one from an earlier run; returns the stored table."""
    return replace_partitions(executive_summary(pnl, run_date, run_ts), EXECUTIVE_SUMMARY, path)


def executive_summary_from_base(
    accounts: DataFrame, products: DataFrame, customers: DataFrame, txn: DataFrame, run_date: date
) -> DataFrame:
    """The same headline figures computed from the accounts: customers once, ratios on totals, fees once."""
    first = run_date.replace(day=1)
    month = accounts.filter(F.col("snapshot_month") == F.lit(first))
    active_in_month = monthly_transaction_counts(
        txn.filter(month_of(F.col("transaction_date")) == F.lit(first)))
    star = account_star(month, products, customers).join(
        active_in_month, ["customer_id", "snapshot_month"], "left")
    fee = F.when(F.col("txn_count").isNotNull(), F.col("fees_charged_gbp"))
    each = _per_account(star, [], F.col("account_status") == "Active", fee)
    sums = each.agg(
        _total("charged").alias("charged"), _total("earned").alias("earned"),
        F.coalesce(_total("paid"), F.lit(0)).alias("fees"),
        F.count_distinct(F.when(F.col("counted"), F.col("customer_id"))).alias("customers"),
        F.count(F.when(F.col("counted"), F.col("account_id"))).alias("accounts"),
        _total("book").alias("book"),
        F.sum("in_arrears").alias("arrears"),
    )
    net = F.col("charged") - F.col("earned")
    return sums.select(
        F.lit(run_date).alias("report_month"),
        F.round(net + F.col("fees"), 0).alias("total_revenue_gbp"),
        F.round(net, 0).alias("total_nii_gbp"),
        F.round("fees", 0).alias("total_fee_income_gbp"),
        F.col("customers").alias("total_active_customers"),
        F.col("accounts").alias("total_active_accounts"),
        F.round("book", 0).alias("total_book_gbp"),
        round_ratio(net * 100 * 1200, F.col("book") * 100, 3).alias("nim_pct"),
        round_ratio(F.col("arrears") * 100, F.col("accounts"), 2).alias("arrears_rate_pct"),
    )
