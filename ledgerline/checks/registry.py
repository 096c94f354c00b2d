"""Every query by name, over a folder of the raw test tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline import schemas
from ledgerline.operators.groups import latest_per_key
from ledgerline.plans import aml, churn, churn_model, cross_sell, geography, mergeable, pnl, rfm
from ledgerline.session import materialise, scratch_copies, scratch_path, settled, shuffles_removed
from ledgerline.sources import dimensions, order_star, staging, storage
from ledgerline.sources.order_star import AS_OF, Star

Query = Callable[[SparkSession, str], DataFrame]


def run_stamp() -> Column:
    """The time of the run, fixed for the checks."""
    return F.lit(AS_OF).cast("timestamp")


def comparable(df: DataFrame) -> DataFrame:
    """Types two engines print the same way: money as double, dates as ISO text, counts as bigint."""
    out = []
    for f in df.schema:
        c = F.col(f.name)
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, T.TimestampType):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, T.IntegerType):
            c = c.cast("bigint")
        elif isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c, ",")
        out.append(c.alias(f.name))
    return df.select(*out)


def _on_star(query: Callable[[Star], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(query(order_star.load(spark, sf_dir)))

    return run


def _rounded(df: DataFrame, column: str, digits: int) -> DataFrame:
    return df.withColumn(column, F.round(column, digits))


def _features(s: Star) -> DataFrame:
    return churn.churn_features(s.customers, s.transactions, s.accounts, AS_OF)


def _one_month(s: Star) -> DataFrame:
    month = AS_OF.replace(month=11, day=1)
    return _pnl(s, report_month=month, compared=pnl.months_to_compare(s.accounts, s.products, s.customers, month))


def _pnl(s: Star, **kw) -> DataFrame:
    return pnl.monthly_pnl(s.accounts, s.products, s.customers, s.transactions, **kw)


def _mv_customer_rfm(s: Star) -> DataFrame:
    return rfm.refresh_mv_customer_rfm(s.transactions, s.customers, AS_OF, "mv_customer_rfm", run_stamp())


def _mv_customer_rfm_next_day(s: Star) -> DataFrame:
    """Refreshed for the day before, then for the day itself, which reads that day's transactions only."""
    kept, before = scratch_path(s.spark, "customer_activity"), AS_OF - timedelta(days=1)
    for day, since in ((before, None), (AS_OF, before)):
        out = rfm.refresh_mv_customer_rfm(
            s.transactions, s.customers, day, "mv_customer_rfm_daily", run_stamp(), kept, since)
    return out


def _rfm_scored(s: Star) -> DataFrame:
    return rfm.rfm_scored(materialise(rfm.rfm_raw(s.transactions, AS_OF), "rfm_raw"))


def _dim_products(s: Star) -> DataFrame:
    held = s.accounts.groupBy("product_id").agg(F.count_distinct("account_id").alias("accounts"))
    return s.products.drop("retired_date").join(held, "product_id")


def _executive_summary(s: Star) -> DataFrame:
    path = scratch_path(s.spark, "monthly_executive_summary")
    stamp = run_stamp()
    return pnl.store_executive_summary(_pnl(s, report_month=AS_OF), AS_OF, path, stamp)


def _customers_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order stands for a change record of its customer."""
    customers = order_star.customers(spark, sf_dir)
    orders = order_star.raw_table(spark, sf_dir, "orders").selectExpr(
        "concat('CUST', lpad(cast(o_custkey as string), greatest(8, length(cast(o_custkey as string))), '0')) as customer_id",
        "concat('RM_', lpad(cast(o_orderkey % 500 as string), 4, '0')) as relationship_mgr",
        "cast(o_orderdate as timestamp) as updated_at")
    # reduce the records to the newest of each customer before attaching the other columns
    newest = latest_per_key(orders, ["customer_id"], ["updated_at"])
    changes = schemas.CUSTOMERS.conform(
        customers.drop("relationship_mgr", "updated_at").join(newest, "customer_id"))
    merged = staging.upsert_latest(customers, changes, schemas.CUSTOMERS)
    return comparable(merged.select("customer_id", "region", "customer_segment", "relationship_mgr", "updated_at"))


def _mcc_category(s: Star) -> DataFrame:
    return staging.with_mcc_category(s.transactions, s.merchant_categories).groupBy("transaction_category").agg(
        F.count(F.lit(1)).alias("transactions"), F.sum("amount_gbp").alias("amount_gbp"))


#: the estimates' relative standard error
APPROX_ERROR = 0.01


def _distinct_per_channel(txn: DataFrame, column: str) -> DataFrame:
    """Exact and estimated number of values per channel.

    Values are reduced to one row each first: an exact count beside the estimate in one step
    would keep a sketch for every value. A repeated value doesn't change a sketch.
    """
    return txn.select("channel", column).distinct().groupBy("channel").agg(
        F.count(column).alias("exact"), F.approx_count_distinct(column, APPROX_ERROR).alias("approx"))


def _approx_distinct_merchants(s: Star) -> DataFrame:
    exact, approx = F.col("exact"), F.col("approx")
    return _distinct_per_channel(s.transactions, "merchant_name").select(
        "channel", exact.alias("exact_merchants"), (F.abs(approx - exact) <= exact * 3 * APPROX_ERROR).alias("within_error"))


def _approx_distinct_accounts(s: Star) -> DataFrame:
    """The estimate of thousands of accounts per channel, held against three standard errors."""
    exact, bound = F.col("exact"), F.floor(F.col("exact") * 3 * APPROX_ERROR)
    return _distinct_per_channel(s.transactions, "account_id").select(
        "channel", exact.alias("exact_accounts"), bound.alias("bound"),
        (F.abs(F.col("approx") - exact) <= bound).alias("within_bound"))


def _active_customer_totals(s: Star) -> DataFrame:
    """Half of the customers are numbered first, the others later, as they would be when they join."""
    early = s.customers.filter(F.pmod(F.xxhash64("customer_id"), F.lit(2)) == 0)
    first = materialise(mergeable.customer_numbers(early), "customer_numbers")
    numbers = materialise(mergeable.customer_numbers(s.customers, first), "customer_numbers")
    stored = materialise(
        mergeable.active_customer_bitmaps(s.accounts, s.products, s.customers, numbers), "active_customer_bitmaps")
    return mergeable.active_customer_totals(stored)


def _accounts_by_period(s: Star) -> DataFrame:
    """Exact distinct accounts per period and channel, and whether they lie within the sketches' bounds."""
    stored = materialise(mergeable.account_sketches(s.transactions), "account_sketches")
    exact = s.transactions.select("channel", "account_id", F.explode(mergeable.periods_of(AS_OF)).alias("period_days")).groupBy(
        "period_days", "channel").agg(F.count_distinct("account_id").alias("exact_accounts"))
    inside = F.col("exact_accounts").between(F.col("at_least"), F.col("at_most"))
    return mergeable.accounts_by_period(stored, AS_OF).join(exact, ["period_days", "channel"]).select(
        "period_days", "channel", "exact_accounts", inside.alias("within_bounds"))


def _spend_baselines(s: Star) -> DataFrame:
    """Customer days per period and segment, and whether each quantile's rank is within the sketches' bound."""
    spend = materialise(mergeable.daily_spend(s.transactions, s.customers), "daily_spend")
    stored = materialise(mergeable.spend_sketches(spend), "spend_sketches")
    found = mergeable.spend_baselines(stored, AS_OF).withColumnRenamed("spend", "estimate")
    rows = spend.select("customer_segment", "spend", F.explode(mergeable.periods_of(AS_OF)).alias("period_days"))
    keys = ["period_days", "customer_segment", "quantile", "customer_days"]
    ranked = found.join(rows, ["period_days", "customer_segment"]).groupBy(*keys).agg(
        (F.count_if(F.col("spend") < F.col("estimate")) / F.col("customer_days")).alias("below"),
        (F.count_if(F.col("spend") <= F.col("estimate")) / F.col("customer_days")).alias("upto"))
    off = F.col("quantile").between(F.col("below") - mergeable.KLL_BOUND, F.col("upto") + mergeable.KLL_BOUND)
    return ranked.select(*keys, off.alias("within_bound"))


def _dim_date(s: Star) -> DataFrame:
    """The whole calendar with each day's number of transactions."""
    daily = s.transactions.groupBy(F.col("transaction_date").alias("date_id")).agg(F.count(F.lit(1)).alias("transactions"))
    return dimensions.dim_date(s.spark).join(daily, "date_id", "left").withColumn(
        "transactions", F.coalesce("transactions", F.lit(0)))


def _staging_validate(s: Star) -> DataFrame:
    """The landed rows keyed by order and line number only, which the test data repeats."""
    landed = s.transactions.withColumn("transaction_id", F.substring_index("transaction_id", "-", 2))
    return staging.validate(landed, schemas.TRANSACTIONS)


def _storage_accounts(s: Star) -> DataFrame:
    path = scratch_path(s.spark, "fact_accounts")
    stored = storage.write_table(s.accounts, schemas.ACCOUNTS, path)
    return stored.filter("snapshot_month >= DATE '2024-10-01'").groupBy("snapshot_month").agg(
        F.count(F.lit(1)).alias("accounts"), F.sum("balance_gbp").alias("balance_gbp"))


#: gzip files are read whole by one task
LANDED_FILE_ROWS = 1_000_000


def _land(accounts: DataFrame) -> str:
    """Accounts as files that are to be loaded, compressed as files usually arrive."""
    landed = scratch_path(accounts.sparkSession, "landed_accounts")
    with shuffles_removed(accounts.sparkSession):
        accounts.select(schemas.ACCOUNTS.schema.names).write.option("header", True).option("compression", "gzip").option(
            "maxRecordsPerFile", LANDED_FILE_ROWS).csv(landed)
    return landed


def _staging_to_core(s: Star) -> DataFrame:
    """The accounts land as CSV, some of them spoilt, and are loaded: rows per stored month and per broken rule."""
    arrears, missed = F.col("days_in_arrears"), F.col("missed_payments_3m")
    spoilt = s.accounts.withColumns({
        "account_status": F.when(arrears > 80, "Lost").otherwise(F.col("account_status")),
        "balance_gbp": F.when(missed == 3, F.lit("12.345")).otherwise(F.col("balance_gbp").cast("string")),
        "days_in_arrears": F.when((missed == 2) & (arrears == 0), "none").otherwise(arrears.cast("string")),
        "customer_id": F.when(~((missed == 1) & (arrears > 60)), F.col("customer_id")),
    })
    earlier = scratch_copies()
    stored, rejected = staging.load(s.spark, schemas.ACCOUNTS, _land(spoilt), scratch_path(s.spark, "core_accounts"))
    core = stored.groupBy(F.col("snapshot_month").cast("string").alias("what"))
    broken = rejected.select(F.explode("broken_rules").alias("what")).groupBy("what")
    counted = [g.agg(F.count(F.lit(1)).alias("rows")).withColumn("outcome", F.lit(o)) for g, o in ((core, "stored"), (broken, "rejected"))]
    return settled(counted[0].unionByName(counted[1]), "staging_to_core", earlier)


def _staging_reload(s: Star) -> DataFrame:
    """The accounts land with one month twice and are loaded two times over: what each load stores and rejects."""
    before = scratch_copies()
    again = s.accounts.filter("snapshot_month = DATE '2024-11-01'")
    landed, core = _land(s.accounts.unionByName(again)), scratch_path(s.spark, "core_accounts")
    out = []
    for load in (1, 2):
        earlier = scratch_copies()
        stored, rejected = staging.load(s.spark, schemas.ACCOUNTS, landed, core, append=load == 2)
        months = stored.groupBy(F.col("snapshot_month").cast("string").alias("what")).count()
        rules = rejected.select(F.explode("broken_rules").alias("rule")).groupBy(F.concat(F.lit("rejected "), "rule").alias("what")).count()
        counted = months.unionByName(rules).select(F.lit(load).alias("load"), "what", F.col("count").alias("rows"))
        out.append(settled(counted, "load_counts", earlier))
    return settled(out[0].unionByName(out[1]), "staging_reload", before)


def _retention(s: Star) -> DataFrame:
    kept = storage.retained(s.transactions, schemas.TRANSACTIONS, date(2029, 6, 30))
    return kept.groupBy("transaction_date").agg(F.count(F.lit(1)).alias("transactions"))


_models: dict[tuple[str, ...], tuple] = {}


def _stored_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = order_star.load(spark, sf_dir)
    stamp = F.lit(AS_OF).cast("timestamp")
    return materialise(
        churn.churn_features(s.customers, s.transactions, s.accounts, AS_OF, stamp), "ml_churn_features")


def _model(spark: SparkSession, sf_dir: str):
    """Feature snapshot and stored model, made once per application and data folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _models:
        features = _stored_features(spark, sf_dir)
        path = scratch_path(spark, "mdl_churn_logistic")
        churn_model.save_model(churn_model.train_churn(features, as_of=AS_OF), path)
        _models[key] = features, path
    features, path = _models[key]
    return features, churn_model.load_model(path)


#: weights as a report might declare them
DECLARED = {
    "__intercept__": -1.5, "age": 0.01, "tenure_years": -0.08, "days_since_last_txn": 0.02, "txn_count_6m": -0.05,
    "product_count": -0.2, "max_days_in_arrears": 0.03, "nps_score": -0.004,
    "customer_segment_Retail": 0.3, "customer_segment_Private": -0.4, "region_ASIA": 0.25, "region_EUROPE": -0.15,
}
#: a light penalty under which the planted signal survives, beside the default one
LIGHT = churn_model.ChurnConfig(l1=0.002, l2=0.002, max_iter=200)
#: how near to the optimum a fit must come
NEAR = 0.001


def _with_signal(features: DataFrame) -> DataFrame:
    """The test labels are noise; these follow the customer's age and tenure."""
    return features.withColumn("churned", (F.col("age") > 2 * F.col("tenure_years") + 30).cast("bigint"))


def _fits(spark: SparkSession, sf_dir: str) -> list[tuple[str, churn_model.ChurnConfig, DataFrame, PipelineModel]]:
    """A model of the planted signal under a light penalty, and one of the real labels under the default one."""
    features, default = _model(spark, sf_dir)
    key = (spark.sparkContext.applicationId, sf_dir, "signal")
    if key not in _models:
        planted = _with_signal(features)
        _models[key] = planted, churn_model.train_churn(planted, LIGHT, as_of=AS_OF)
    planted, light = _models[key]
    return [("default", churn_model.ChurnConfig(), features, default), ("light", LIGHT, planted, light)]


def _churn_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For both fits: inputs, whether it found weights, and whether they are optimal."""
    rows = []
    for name, cfg, features, model in _fits(spark, sf_dir):
        worst = churn_model.optimality(model, features, cfg).agg(F.max("slack")).first()[0]
        found = any(w != 0 for w in model.stages[-1].coefficients)
        rows.append((name, model.stages[-1].numFeatures, found if name == "light" else None, bool(worst <= NEAR)))
    return spark.createDataFrame(rows, "penalty string, inputs bigint, found_weights boolean, optimal boolean")


def _churn_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each input's weight in the fit of the planted signal, as its sign where that is planted, and whether it is optimal."""
    _, cfg, features, model = _fits(spark, sf_dir)[1]
    sign = F.when(F.col("processed_input").isin("age", "tenure_years"), F.signum("weight").cast("bigint"))
    return churn_model.optimality(model, features, cfg).select(
        "processed_input", sign.alias("planted_sign"), (F.col("slack") <= NEAR).alias("optimal"))


def _churn_evaluate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For both fits, whether each metric equals that of scores made from the stored weights."""
    out = []
    for name, cfg, features, model in _fits(spark, sf_dir):
        formula = churn_model.score_formula(model, features).select("customer_id", "churn_probability")
        wanted = churn_model.evaluate_scores(churn_model.with_split(features, cfg).join(formula, "customer_id"))
        got = churn_model.evaluate_churn(model, features, cfg, as_of=AS_OF)
        metrics = [c for c in got.columns if c != "rows"]
        paired = got.join(wanted.select("rows", *[F.col(c).alias(f"formula_{c}") for c in metrics]), "rows")
        out.append(paired.select(F.lit(name).alias("penalty"), "rows", *[
            (F.abs(F.col(c) - F.col(f"formula_{c}")) <= 1e-6).alias(f"{c}_agrees") for c in metrics]))
    return out[0].unionByName(out[1])


def _churn_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer's score by both fits, with whether it equals the logistic formula of the stored weights."""
    out = []
    for name, _, features, model in _fits(spark, sf_dir):
        formula = churn_model.score_formula(model, features).select(
            "customer_id", F.col("churn_probability").alias("formula"), F.col("predicted_churned").alias("formula_class"),
            F.col("churn_tier").alias("formula_tier"))
        scored = churn_model.score_churn(model, features, sort=False).join(formula, "customer_id")
        same = (F.col("predicted_churned") == F.col("formula_class")) & (F.col("churn_tier") == F.col("formula_tier"))
        out.append(scored.select(
            F.lit(name).alias("penalty"), "customer_id", "customer_segment", "region", "tenure_years", "days_since_last_txn",
            "product_count", (F.abs(F.col("churn_probability") - F.col("formula")) <= 1e-9).alias("probability_agrees"),
            same.alias("decision_agrees")))
    return out[0].unionByName(out[1])


def _scores_declared(s: Star) -> DataFrame:
    return _rounded(churn_model.score_weights(DECLARED, _features(s), sort=False), "churn_probability", 9).orderBy(
        F.desc("churn_probability"), "customer_id")


def _evaluate_declared(s: Star) -> DataFrame:
    features = materialise(_features(s), "ml_churn_features")
    scored = churn_model.score_weights(DECLARED, features, sort=False).select("customer_id", F.round("churn_probability", 9).alias("churn_probability"))
    out = churn_model.evaluate_scores(churn_model.with_split(features).join(scored, "customer_id"))
    return out.withColumns({c: F.round(c, 6) for c in out.columns if c != "rows"}).orderBy("rows")


def star_queries() -> dict[str, Callable[[Star], DataFrame]]:
    """The queries that read nothing but the star tables."""
    return {
        # tables
        "dim_date": _dim_date,
        "dim_products": _dim_products,
        "star_customers": lambda s: s.customers.select(
            "customer_id", "date_of_birth", "age_band", "region", "customer_since", "customer_segment",
            "kyc_status", "risk_rating", "nps_score"),
        "star_transactions": lambda s: s.transactions.select(
            "transaction_id", "customer_id", "account_id", "product_id", "transaction_date", "transaction_type",
            "transaction_category", "merchant_name", "merchant_category_code", "merchant_country", "amount_gbp",
            "channel", "is_international", "is_flagged"),
        "star_accounts": lambda s: s.accounts.select(
            "account_id", "customer_id", "product_id", "snapshot_month", "account_status", "balance_gbp",
            "utilisation_pct", "days_in_arrears", "missed_payments_3m", "interest_charged_gbp",
            "interest_earned_gbp", "fees_charged_gbp", "closed_date"),
        # segmentation
        "rfm_raw": lambda s: rfm.rfm_raw(s.transactions, AS_OF),
        "rfm_scored": _rfm_scored,
        "rfm_segments": lambda s: rfm.rfm_segments(s.transactions, s.customers, AS_OF),
        "mv_customer_rfm": _mv_customer_rfm,
        "mv_customer_rfm_next_day": _mv_customer_rfm_next_day,
        "rfm_segment_summary": lambda s: rfm.rfm_segment_summary(
            rfm.rfm_segments(s.transactions, s.customers, AS_OF, sort=False)),
        # churn
        "churn_labels": lambda s: churn.churn_labels(s.accounts, AS_OF),
        "churn_labels_all_closed": lambda s: churn.churn_labels_all_closed(s.accounts, AS_OF),
        "churn_txn_features": lambda s: _rounded(churn.churn_txn_features(s.transactions, AS_OF), "stddev_txn_amount", 4),
        "churn_account_features": lambda s: churn.churn_account_features(s.accounts, AS_OF),
        "ml_churn_features": _features,
        "churn_training_set": lambda s: churn_model.training_set(materialise(_features(s), "ml_churn_features")).select(
            "customer_id", "churned", "held_out", "class_weight"),
        "churn_scores_declared": _scores_declared,
        "churn_evaluate_declared": _evaluate_declared,
        # cross-sell
        "product_holdings": lambda s: cross_sell.product_holdings(s.accounts, s.products, AS_OF),
        "cross_sell_behaviour": lambda s: cross_sell.behaviour(s.transactions, AS_OF),
        "cross_sell_eligible": lambda s: cross_sell.eligible_customers(
            s.customers, s.accounts, s.products, s.transactions, AS_OF),
        "cross_sell": lambda s: cross_sell.cross_sell(s.customers, s.accounts, s.products, s.transactions, AS_OF),
        # money laundering
        "structuring_daily": lambda s: aml.structuring_daily(s.transactions),
        "structuring_transaction_ids": lambda s: aml.structuring_transaction_ids(s.transactions),
        "rolling_7d_sum": lambda s: aml.structuring_rolling(s.transactions).select(
            "customer_id", "transaction_date", "rolling_7d_total_gbp", "rolling_7d_txn_count"),
        "aml_structuring_alerts": lambda s: aml.aml_structuring(s.transactions, s.customers),
        "aml_structuring_calendar": lambda s: aml.aml_structuring(s.transactions, s.customers, calendar=True),
        "aml_layering_daily": lambda s: aml.layering_daily(s.transactions),
        "aml_layering": lambda s: aml.aml_layering(s.transactions, s.customers),
        "velocity_baseline": lambda s: _rounded(aml.velocity_baseline(s.transactions, AS_OF), "stddev_daily_spend", 4),
        "aml_velocity_alerts": lambda s: aml.aml_velocity(s.transactions, AS_OF),
        "aml_round_amount_alerts": lambda s: aml.aml_round_amount(s.transactions, AS_OF),
        "aml_round_amount_exact": lambda s: aml.aml_round_amount(s.transactions, AS_OF, exact=True),
        "aml_high_risk_exposure": lambda s: aml.high_risk_exposure(s.transactions, s.merchant_categories, AS_OF),
        "geo_transitions": lambda s: geography.transition_counts(geography.country_moves(s.transactions, s.customers, AS_OF)),
        "geo_scores": lambda s: geography.geographic_scores(s.transactions, s.customers, AS_OF),
        "aml_geographic_anomaly": lambda s: geography.aml_geographic_anomaly(s.transactions, s.customers, AS_OF),
        "aml_flag_summary": lambda s: aml.aml_flag_summary(s.transactions, s.customers, AS_OF),
        # profit and loss
        "pnl_net_interest": lambda s: pnl.net_interest(s.accounts, s.products, s.customers),
        "pnl_fee_income": lambda s: pnl.fee_income(s.accounts, s.products, s.customers, s.transactions),
        "pnl_fee_income_dedup": lambda s: pnl.fee_income(
            s.accounts, s.products, s.customers, s.transactions, per_transaction=False),
        "pnl_account_counts": lambda s: pnl.account_counts(s.accounts, s.products, s.customers),
        "v_monthly_pnl": _pnl,
        "monthly_pnl_one_month": _one_month,
        "monthly_executive_summary": _executive_summary,
        "executive_summary_from_base": lambda s: pnl.executive_summary_from_base(
            s.accounts, s.products, s.customers, s.transactions, AS_OF),
        # staging and storage
        "mcc_category": _mcc_category,
        "approx_distinct_merchants": _approx_distinct_merchants,
        "approx_distinct_accounts": _approx_distinct_accounts,
        "active_customer_totals": _active_customer_totals,
        "accounts_by_period": _accounts_by_period,
        "spend_baselines": _spend_baselines,
        "staging_validate": _staging_validate,
        "storage_accounts": _storage_accounts,
        "staging_to_core": _staging_to_core,
        "staging_reload": _staging_reload,
        "retention_transactions": _retention,
    }


def queries() -> dict[str, Query]:
    out = {name: _on_star(query) for name, query in star_queries().items()}
    out["dim_customers"] = lambda spark, sf_dir: comparable(dimensions.build_customers(
        order_star.raw_table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id")), AS_OF, run_stamp()))
    out["customers_upsert"] = _customers_upsert
    out["churn_train"] = _churn_train
    out["churn_weights"] = _churn_weights
    out["churn_evaluate"] = _churn_evaluate
    out["churn_scores"] = _churn_scores
    return out
