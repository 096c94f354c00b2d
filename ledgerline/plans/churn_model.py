"""Churn model: elastic-net logistic regression with ``pyspark.ml``."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import Imputer, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ledgerline import rules
from ledgerline.functions import first_match, hash_bucket

LABEL, WEIGHT, HELD_OUT = "churned", "class_weight", "held_out"
_SPLIT_BUCKETS = 1000


@dataclass(frozen=True)
class ChurnConfig:
    eval_fraction: float = rules.CHURN_EVAL_FRACTION
    max_iter: int = rules.CHURN_MAX_ITER
    l1: float = rules.CHURN_L1
    l2: float = rules.CHURN_L2
    balance_classes: bool = True


def latest_snapshot(features: DataFrame, as_of: date) -> DataFrame:
    """Rows of a stored feature table computed yesterday or later."""
    return features.filter(F.col("feature_date").cast("date") >= F.lit(as_of - timedelta(days=1)))


def with_split(features: DataFrame, cfg: ChurnConfig = ChurnConfig()) -> DataFrame:
    """Mark the evaluation rows by a hash of the customer, so a rerun splits the same way."""
    cut = round(cfg.eval_fraction * _SPLIT_BUCKETS)
    return features.withColumn(HELD_OUT, hash_bucket(F.col("customer_id"), _SPLIT_BUCKETS) < cut)


def class_weights(rows: DataFrame) -> dict[int, float]:
    """``rows / (2 * rows of the class)``, so both classes weigh the same in total."""
    sizes = {r[LABEL]: r["count"] for r in rows.groupBy(LABEL).count().collect()}
    total = sum(sizes.values())
    return {label: total / (2 * n) for label, n in sizes.items()}


def training_set(features: DataFrame, cfg: ChurnConfig = ChurnConfig()) -> DataFrame:
    """Features with the split mark and the class weight taken from the training rows."""
    split = with_split(features, cfg)
    weight = F.lit(1.0)
    if cfg.balance_classes:
        weight = first_match(
            [(F.col(LABEL) == label, w) for label, w in sorted(class_weights(split.filter(~F.col(HELD_OUT))).items())],
            1.0)
    return split.withColumn(WEIGHT, weight)


def pipeline(cfg: ChurnConfig = ChurnConfig()) -> Pipeline:
    """Index and encode the two text columns, impute, assemble, fit.

    The penalty is ``reg * (a * L1 + (1 - a) / 2 * L2)`` in Spark's terms, with
    ``reg = l1 + l2`` and ``a = l1 / (l1 + l2)``.
    """
    texts, numbers = rules.CHURN_CATEGORICAL, rules.CHURN_NUMERIC
    penalty = cfg.l1 + cfg.l2
    return Pipeline(stages=[
        StringIndexer(inputCols=texts, outputCols=[f"{c}_index" for c in texts],
                      stringOrderType="alphabetAsc", handleInvalid="keep"),
        OneHotEncoder(inputCols=[f"{c}_index" for c in texts], outputCols=[f"{c}_vec" for c in texts], dropLast=False),
        Imputer(inputCols=numbers, outputCols=[f"{c}_filled" for c in numbers], strategy="mean"),
        VectorAssembler(inputCols=[f"{c}_filled" for c in numbers] + [f"{c}_vec" for c in texts], outputCol="features"),
        LogisticRegression(
            labelCol=LABEL, featuresCol="features", weightCol=WEIGHT, maxIter=cfg.max_iter,
            regParam=penalty, elasticNetParam=cfg.l1 / penalty if penalty else 0.0),
    ])


def _as_double(features: DataFrame) -> DataFrame:
    return features.withColumns({c: F.col(c).cast("double") for c in [*rules.CHURN_NUMERIC, LABEL]})


def train_churn(
    features: DataFrame, cfg: ChurnConfig = ChurnConfig(), as_of: date | None = None
) -> PipelineModel:
    """Fit on the rows that are not held out; with ``as_of`` on the latest snapshot only.

    ``features`` is read several times: pass a stored table.
    """
    if as_of is not None:
        features = latest_snapshot(features, as_of)
    return pipeline(cfg).fit(_as_double(training_set(features, cfg).filter(~F.col(HELD_OUT))))


def save_model(model: PipelineModel, path: str) -> None:
    """Store the model under a name, replacing an earlier one."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def predicted(probability: Column) -> Column:
    """The class: 1 above one half. Exactly one half, within rounding errors, is class 0."""
    return F.when(F.round(probability, 9) > 0.5, 1).otherwise(0).cast("bigint")


def evaluate_churn(
    model: PipelineModel, features: DataFrame, cfg: ChurnConfig = ChurnConfig(), as_of: date | None = None
) -> DataFrame:
    """The metrics of :func:`evaluate_scores` for a fitted model. Runs the jobs that order the scores."""
    if as_of is not None:
        features = latest_snapshot(features, as_of)
    scored = model.transform(_as_double(with_split(features, cfg)))
    return evaluate_scores(scored.select(LABEL, HELD_OUT, vector_to_array("probability")[1].alias("churn_probability")))


def evaluate_scores(scored: DataFrame) -> DataFrame:
    """Precision, recall, accuracy, F1, log loss and ROC AUC for class 1, on all and on held-out rows.

    ``scored`` has the label, ``held_out`` and ``churn_probability``. All counts come from
    one pass; only the AUC needs the rows in order of score, which Spark's evaluator does,
    every score being a point of its curve.
    """
    scored = scored.withColumn(LABEL, F.col(LABEL).cast("double"))
    parts = {"all": scored, "held_out": scored.filter(HELD_OUT)}
    auc = {
        name: BinaryClassificationEvaluator(
            rawPredictionCol="churn_probability", labelCol=LABEL, metricName="areaUnderROC", numBins=0).evaluate(part)
        for name, part in parts.items()
    }
    p = F.col("churn_probability")
    actual, guess = F.col(LABEL) == 1, predicted(p) == 1
    p_actual = F.when(actual, p).otherwise(1 - p)
    membership = F.array_compact(F.array(F.lit("all"), F.when(F.col(HELD_OUT), F.lit("held_out"))))
    counts = scored.select(
        F.explode(membership).alias("rows"), actual.alias("actual"), guess.alias("guess"),
        (-F.ln(F.greatest(p_actual, F.lit(1e-15)))).alias("loss"),
    ).groupBy("rows").agg(
        F.count_if(F.col("actual") & F.col("guess")).alias("hit"),
        F.count_if("guess").alias("guessed"),
        F.count_if("actual").alias("positive"),
        F.count_if(F.col("actual") == F.col("guess")).alias("right"),
        F.count(F.lit(1)).alias("n"),
        F.avg("loss").alias("log_loss"),
    )
    hit = F.col("hit")
    return counts.select(
        "rows",
        F.coalesce(F.try_divide(hit, F.col("guessed")), F.lit(0.0)).alias("precision"),
        F.coalesce(F.try_divide(hit, F.col("positive")), F.lit(0.0)).alias("recall"),
        F.try_divide(F.col("right"), F.col("n")).alias("accuracy"),
        F.coalesce(F.try_divide(2 * hit, F.col("guessed") + F.col("positive")), F.lit(0.0)).alias("f1_score"),
        "log_loss",
        first_match([(F.col("rows") == name, area) for name, area in auc.items()], None).alias("roc_auc"),
    ).orderBy("rows")


def churn_tier(probability: Column) -> Column:
    """The action tier; probabilities count to nine digits, so a rounding error decides no tier."""
    p = F.round(probability, 9)
    return first_match([(p >= floor, tier) for floor, tier in rules.CHURN_TIERS], rules.CHURN_TIER_OTHER)


_SCORE_COLUMNS = ["customer_id", "customer_segment", "region", "tenure_years", "days_since_last_txn", "product_count"]


def _report(scored: DataFrame, run_ts: Column | None, sort: bool) -> DataFrame:
    p = F.col("churn_probability")
    out = scored.select(
        *[F.col(c).cast("bigint").alias(c) if c in rules.CHURN_NUMERIC else c for c in _SCORE_COLUMNS],
        p, predicted(p).alias("predicted_churned"), churn_tier(p).alias("churn_tier"))
    if run_ts is not None:
        out = out.withColumn("scored_at", run_ts)
    return out.orderBy(F.desc("churn_probability"), "customer_id") if sort else out


def score_weights(
    weights: dict[str, float], features: DataFrame, run_ts: Column | None = None, sort: bool = True
) -> DataFrame:
    """The score report from declared weights, named as :func:`churn_weights` names them: one expression, no model file.

    A text value without a weight takes that of ``<column>___unknown``; without one, and for
    a missing number, nothing is added.
    """
    texts, terms = rules.CHURN_CATEGORICAL, F.lit(weights.get("__intercept__", 0.0))
    for name in rules.CHURN_NUMERIC:
        if name in weights:
            terms = terms + F.lit(weights[name]) * F.coalesce(F.col(name).cast("double"), F.lit(0.0))
    for column in texts:
        own = [(F.col(column) == n.removeprefix(f"{column}_"), w) for n, w in weights.items() if n.startswith(f"{column}_")]
        if own:
            terms = terms + first_match(own, weights.get(f"{column}___unknown", 0.0))
    return _report(features.withColumn("churn_probability", 1 / (1 + F.exp(-terms))), run_ts, sort)


def score_churn(
    model: PipelineModel, features: DataFrame, run_ts: Column | None = None, sort: bool = True
) -> DataFrame:
    """Churn probability, predicted class and action tier per customer, most likely first.

    The model passes its input columns through, so no join back to the features is needed.
    """
    scored = model.transform(_as_double(features)).withColumn("churn_probability", vector_to_array("probability")[1])
    return _report(scored, run_ts, sort)


def score_formula(model: PipelineModel, features: DataFrame) -> DataFrame:
    """The score report of a fitted model from its stored weights and means alone, by :func:`score_weights`. Not sorted."""
    weights = {r.processed_input: r.weight for r in named_weights(model)}
    means = model.stages[2].surrogateDF.first().asDict()
    return score_weights(weights, _as_double(features).na.fill(means), sort=False)


def optimality(model: PipelineModel, features: DataFrame, cfg: ChurnConfig = ChurnConfig()) -> DataFrame:
    """How far each weight is from the optimum of the penalised loss: ``processed_input``, ``weight``, ``slack``.

    On inputs scaled to unit deviation, the loss's slope at a weight that isn't zero must
    equal the penalty's, and at a zero weight stay within the L1 penalty; ``slack`` is what
    is missing. The slopes are one aggregation over the training rows.
    """
    rows = model.transform(_as_double(training_set(features, cfg).filter(~F.col(HELD_OUT))))
    weight, p = F.col(WEIGHT), vector_to_array("probability")[1]
    total, deviation = rows.agg(
        F.sum(weight).alias("total"), Summarizer.metrics("std").summary(F.col("features"), weight).alias("s")).select(
        "total", "s.std").first()
    error = weight * (p - F.col(LABEL)) / total
    slopes = rows.select(error.alias("error"), F.posexplode(vector_to_array("features")).alias("i", "x")).groupBy("i").agg(
        F.sum(F.col("error") * F.col("x")).alias("slope")).collect()
    at = {r.i: r.slope for r in slopes}
    names = [r.processed_input for r in named_weights(model)]
    out = []
    for i, (name, w) in enumerate(zip(names, model.stages[-1].coefficients, strict=False)):
        d = float(deviation[i])
        scaled, slope = float(w) * d, (at.get(i, 0.0) / d if d else 0.0)
        slack = abs(slope + cfg.l2 * scaled + (cfg.l1 if scaled > 0 else -cfg.l1)) if scaled else max(0.0, abs(slope) - cfg.l1)
        out.append((name, float(w), slack))
    intercept = rows.agg(F.sum(error)).first()[0]
    out.append(("__intercept__", float(model.stages[-1].intercept), abs(intercept)))
    return SparkSession.active().createDataFrame(out, "processed_input string, weight double, slack double")


def named_weights(model: PipelineModel) -> list[Row]:
    """Each model input with its weight, in the model's order; the intercept is ``__intercept__``."""
    fitted: LogisticRegressionModel = model.stages[-1]
    names = list(rules.CHURN_NUMERIC)
    for column, labels in zip(rules.CHURN_CATEGORICAL, model.stages[0].labelsArray, strict=True):
        names += [f"{column}_{v}" for v in (*labels, "__unknown")]
    assert len(names) == fitted.numFeatures
    return [Row(processed_input=n, weight=float(w)) for n, w in [*zip(names, fitted.coefficients, strict=True), ("__intercept__", fitted.intercept)]]


def churn_weights(model: PipelineModel) -> DataFrame:
    """One row per model input with its weight, largest first, then by name."""
    rows = SparkSession.active().createDataFrame(named_weights(model), "processed_input string, weight double")
    return rows.orderBy(F.desc(F.abs("weight")), "processed_input")
