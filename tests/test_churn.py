from datetime import date, timedelta
from decimal import Decimal, localcontext
from statistics import stdev

import pytest
from frames import AS_OF, accounts, customers, transactions
from pyspark.sql import functions as F

from ledgerline import rules
from ledgerline.plans import churn, churn_model
from ledgerline.session import materialise
from ledgerline.sources import order_star


def _closed(day, **kw):
    return dict(account_status="Closed", closed_date=day, **kw)


def test_label_edges(spark):
    rows = [
        _closed(AS_OF, customer_id="today"), _closed(AS_OF + timedelta(days=90), customer_id="last"),
        _closed(AS_OF + timedelta(days=91), customer_id="late"), _closed(AS_OF - timedelta(days=1), customer_id="past"),
        dict(customer_id="open", closed_date=AS_OF), _closed(AS_OF, customer_id="half", account_id="A1"),
        dict(customer_id="half", account_id="A2"),
    ]
    acct = accounts(spark, rows)
    any_closed = {r.customer_id: r.churned for r in churn.churn_labels(acct, AS_OF).collect()}
    assert any_closed == {"today": 1, "last": 1, "late": 0, "past": 0, "open": 0, "half": 1}
    every = {r.customer_id: r.churned for r in churn.churn_labels_all_closed(acct, AS_OF).collect()}
    assert every == {**any_closed, "half": 0}


def test_feature_defaults(spark):
    """A verified customer with nothing, one with spend in the last three months only, one not verified."""
    who = customers(spark, [dict(customer_id="none"), dict(customer_id="late"), dict(customer_id="pending", kyc_status="Pending")])
    txn = transactions(spark, [dict(customer_id="late", amount_gbp="30"), dict(customer_id="late", amount_gbp="10")])
    acct = accounts(spark, [dict(customer_id="late", balance_gbp="7.50"), _closed(AS_OF, customer_id="late", account_id="A2")])
    got = {r.customer_id: r for r in churn.churn_features(who, txn, acct, AS_OF).collect()}
    assert set(got) == {"none", "late"}
    none, late = got["none"], got["late"]
    assert (none.days_since_last_txn, none.txn_count_6m, none.avg_balance, none.churned, none.age) == (999, 0, 0.0, 0, 34)
    assert (late.spend_trend_pct, late.avg_txn_amount_6m, late.total_spend_6m, late.days_since_last_txn) == (
        0.0, 20.0, Decimal("40.00"), 0)
    assert (late.product_count, late.avg_credit_utilisation, late.avg_balance, late.churned) == (1, 0.0, 7.5, 1)


def test_feature_columns(spark):
    df = churn.churn_features(customers(spark, [{}]), transactions(spark, [{}]), accounts(spark, [{}]), AS_OF,
                              F.lit(AS_OF).cast("timestamp"))
    assert len(df.columns) == 28 and df.columns[-1] == "feature_date"
    assert set(rules.CHURN_NUMERIC + rules.CHURN_CATEGORICAL) < set(df.columns)
    assert len(rules.CHURN_NUMERIC + rules.CHURN_CATEGORICAL) == 19


def test_trend_splits_at_three_months(spark):
    rows = [dict(transaction_date=date(2024, 9, 30), amount_gbp=5), dict(transaction_date=date(2024, 9, 29), amount_gbp=2),
            dict(transaction_date=date(2024, 6, 30), amount_gbp=2), dict(transaction_date=date(2024, 6, 29), amount_gbp=50)]
    r = churn.churn_txn_features(transactions(spark, rows), AS_OF).first()
    assert (r.spend_last_3m, r.spend_prior_3m, r.active_months, r.txn_count_6m) == (5, 4, 2, 3)


def test_txn_features_count_every_value_once(spark):
    """Repeats, no value at all, and a month too far off for a bit: against counts by distinct rows."""
    rows = [
        dict(customer_id=f"c{i % 3}", merchant_name=[None, "m1", "m2", "m3"][i % 4], transaction_category=[None, "m1", "x", "y", "z"][i % 5],
             transaction_date=[AS_OF, AS_OF - timedelta(days=40), date(2031, 5, 5), date(2031, 5, 9), date(2300, 1, 1)][i % 7 % 5],
             channel=["Mobile", None, "ATM", "Branch"][i % 4], is_international=[None, True, False][i % 3], amount_gbp=i % 11 + 1)
        for i in range(60)] + [dict(customer_id="none", merchant_name=None, transaction_category=None)]
    txn = transactions(spark, rows)
    got = {r.customer_id: r for r in churn.churn_txn_features(txn, AS_OF).collect()}
    amount = F.col("amount_gbp")
    want = txn.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("transaction_category").alias("c"), F.count_distinct("merchant_name").alias("m"),
        F.count_distinct(F.trunc("transaction_date", "MM")).alias("months"), F.sum(amount).alias("spend"), F.stddev_samp(amount.cast("double")).alias("sd"),
        F.count_if(F.col("channel") == "ATM").alias("atm"), F.count_if("is_international").alias("intl"),
        F.max("transaction_date").alias("last")).collect()
    assert got.keys() == {r.customer_id for r in want} and len(got) == 4
    for w in want:
        g = got[w.customer_id]
        assert (g.txn_count_6m, g.unique_categories, g.unique_merchants, g.active_months, g.total_spend_6m, g.atm_txns, g.intl_txns,
                g.days_since_last_txn) == (w.n, w.c, w.m, w.months, w.spend, w.atm, w.intl, (AS_OF - w["last"]).days)
        assert g.stddev_txn_amount == (w.sd and pytest.approx(w.sd))


@pytest.mark.parametrize("amounts", [
    ["1.10", "1.10", "1.10"], ["7.00"], ["9000000.01", "9000000.02", "9000000.04"], ["9999999999999999.99", "0.01"], ["9999999999999999.99"] * 200,
    ["9999999999999999.99"] * 150 + ["9999999999999000.00"] * 150])
def test_deviation_of_large_and_equal_amounts(spark, amounts):
    txn = transactions(spark, [dict(merchant_name=f"m{i % 3}", amount_gbp=a) for i, a in enumerate(amounts)])
    got = churn.churn_txn_features(txn, AS_OF).first().stddev_txn_amount
    with localcontext(prec=80):
        want = float(stdev(map(Decimal, amounts))) if len(amounts) > 1 else None
    assert got == want if not want else got == pytest.approx(want, abs=1e-8 * float(max(map(Decimal, amounts))))


def test_features_keep_no_sets(spark, sf_small):
    """Every grouping is a hash aggregation over buffers of fixed width; sets make Spark sort the rows of larger tasks."""
    star = order_star.load(spark, sf_small)
    features = churn.churn_features(star.customers, star.transactions, star.accounts, AS_OF)
    for df in (features, churn.churn_txn_features(star.transactions, AS_OF)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "HashAggregate" in plan and "ObjectHashAggregate" not in plan and "SortAggregate" not in plan


def test_latest_snapshot_compares_dates(spark):
    df = spark.createDataFrame([("2024-12-30 00:00:01",), ("2024-12-29 23:59:59",)], "t string").select(
        F.col("t").cast("timestamp").alias("feature_date"))
    assert churn_model.latest_snapshot(df, AS_OF).count() == 1


def test_training_uses_the_latest_snapshot(spark, sf_small):
    star = order_star.load(spark, sf_small)
    now, before = (F.lit(d).cast("timestamp") for d in (AS_OF, AS_OF - timedelta(days=30)))
    features = churn.churn_features(star.customers, star.transactions, star.accounts, AS_OF)
    today = materialise(features.withColumn("feature_date", now), "today")
    stale = today.withColumns({"feature_date": before, "churned": 1 - F.col("churned")})
    got = churn_model.train_churn(today.unionByName(stale), as_of=AS_OF).stages[-1].coefficients
    assert list(got) == pytest.approx(list(churn_model.train_churn(today).stages[-1].coefficients))


@pytest.fixture(scope="module")
def trained(spark, sf_dir):
    star = order_star.load(spark, sf_dir)
    features = materialise(churn.churn_features(star.customers, star.transactions, star.accounts, AS_OF), "features")
    return features, churn_model.train_churn(features)


def test_split_is_about_a_fifth(trained):
    features, _ = trained
    share = churn_model.with_split(features).agg(F.avg(F.col("held_out").cast("int"))).first()[0]
    assert 0.17 < share < 0.23


def test_class_weights_balance(trained):
    features, _ = trained
    rows = churn_model.training_set(features).filter("not held_out").groupBy("churned").agg(F.sum("class_weight")).collect()
    assert rows[0][1] == pytest.approx(rows[1][1])


def test_training_is_repeatable(trained):
    features, model = trained
    again = churn_model.train_churn(features.repartition(5))
    assert list(again.stages[-1].coefficients) == pytest.approx(list(model.stages[-1].coefficients), abs=1e-9)


def test_scores(trained, tmp_path, spark):
    features, model = trained
    path = str(tmp_path / "model")
    churn_model.save_model(model, path)
    churn_model.save_model(model, path)  # replaces
    scores = churn_model.score_churn(churn_model.load_model(path), features, F.lit(AS_OF).cast("timestamp"))
    assert scores.columns == ["customer_id", "customer_segment", "region", "tenure_years", "days_since_last_txn",
                              "product_count", "churn_probability", "predicted_churned", "churn_tier", "scored_at"]
    assert scores.count() == features.count()
    p = [r.churn_probability for r in scores.collect()]
    assert p == sorted(p, reverse=True) and 0 <= p[-1] <= p[0] <= 1
    assert scores.filter("(churn_probability > 0.5) <> (predicted_churned = 1)").count() == 0


def test_evaluation_and_weights(trained):
    features, model = trained
    rows = {r.rows: r for r in churn_model.evaluate_churn(model, features).collect()}
    assert set(rows) == {"all", "held_out"}
    for r in rows.values():
        assert all(0 <= r[c] <= 1 for c in ("precision", "recall", "accuracy", "f1_score", "roc_auc"))
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator

    scored = model.transform(churn_model._as_double(features))
    for column, metric in [("precision", "precisionByLabel"), ("recall", "recallByLabel"), ("accuracy", "accuracy"),
                           ("f1_score", "fMeasureByLabel"), ("log_loss", "logLoss")]:
        want = MulticlassClassificationEvaluator(labelCol="churned", metricName=metric, metricLabel=1.0).evaluate(scored)
        assert rows["all"][column] == pytest.approx(want)
    weights = churn_model.churn_weights(model).collect()
    assert len(weights) == model.stages[-1].numFeatures + 1
    size = [abs(r.weight) for r in weights]
    assert size == sorted(size, reverse=True)
    named = {r.processed_input for r in weights}
    assert {"age", "region_ASIA", "customer_segment_Retail", "region___unknown", "__intercept__"} <= named


def test_model_finds_a_planted_driver(trained):
    """The test data's labels are noise and the penalty removes every weight; a label that follows age must survive it."""
    features, _ = trained
    planted = materialise(features.withColumn("churned", (F.col("age") > 50).cast("bigint")), "planted")
    model = churn_model.train_churn(planted)
    weights = {r.processed_input: r.weight for r in churn_model.churn_weights(model).collect()}
    assert weights["age"] > 0
    assert max(weights, key=lambda n: abs(weights[n]) if n != "__intercept__" else -1) == "age"
    assert {r.rows: r.roc_auc for r in churn_model.evaluate_churn(model, planted).collect()}["held_out"] > 0.8
    classes = {r[0] for r in churn_model.score_churn(model, planted).select("predicted_churned").distinct().collect()}
    assert classes == {0, 1}


def test_unseen_category_is_scored(trained):
    features, model = trained
    odd = features.withColumn("region", F.lit("ATLANTIS"))
    assert churn_model.score_churn(model, odd).filter("churn_probability is null").count() == 0


def test_formula_of_the_stored_weights_gives_the_models_scores(trained):
    """Also for a text value or region that the model hasn't seen, none at all, and missing numbers."""
    features, _ = trained
    planted = features.withColumn("churned", (F.col("age") > 2 * F.col("tenure_years") + 30).cast("bigint"))
    model = churn_model.train_churn(planted, churn_model.ChurnConfig(l1=0.002, l2=0.002, max_iter=50))
    assert any(model.stages[-1].coefficients)
    n = F.pmod(F.crc32("customer_id"), F.lit(4))
    odd = planted.withColumns({
        "region": F.when(n == 0, "ATLANTIS").when(n == 1, F.lit(None)).otherwise(F.col("region")),
        "age": F.when(n != 2, F.col("age")), "nps_score": F.when(n != 3, F.col("nps_score"))})
    got = {r.customer_id: r for r in churn_model.score_churn(model, odd).collect()}
    wanted = {r.customer_id: r for r in churn_model.score_formula(model, odd).collect()}
    assert got.keys() == wanted.keys() and len(got) > 100
    assert all(abs(got[c].churn_probability - w.churn_probability) < 1e-9 and got[c].churn_tier == w.churn_tier
               for c, w in wanted.items())
