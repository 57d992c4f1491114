"""Metrics, distributions, business effect and the deployment gate."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from vitalmart.functions.bands import first_match
from vitalmart.functions.numeric import pct, ratio, rnd
from vitalmart.functions.scores import tag_text
from vitalmart.operators.aggregate import confusion_counts, mean, n, sd, share_of_total
from vitalmart.rules import clinical as R

from .training import LABEL, classifier_of

C = F.col


def positive_probability(probability: Column | str = "probability") -> Column:
    """P(class 1) out of the probability vector, without a Python UDF."""
    return vector_to_array(F.col(probability) if isinstance(probability, str) else probability)[1]


def weighted_metrics(confusion: DataFrame, digits: int = 6) -> DataFrame:
    """Accuracy and class-weighted precision, recall and F1 from a confusion row."""
    tp, tn, fp, fn = (C(c).cast("double") for c in ("tp", "tn", "fp", "fn"))
    total, pos, neg = tp + tn + fp + fn, tp + fn, tn + fp
    zero = F.lit(0.0)
    part = lambda a, b: F.coalesce(ratio(a, b), zero)
    weigh = lambda p, q: rnd(ratio(p * pos + q * neg, total), digits)
    return confusion.select(
        *confusion.columns, rnd(ratio(tp + tn, total), digits).alias("accuracy"),
        weigh(part(tp, tp + fp), part(tn, tn + fn)).alias("precision"),
        weigh(part(tp, pos), part(tn, neg)).alias("recall"),
        weigh(part(2 * tp, 2 * tp + fp + fn), part(2 * tn, 2 * tn + fp + fn)).alias("f1_score"))


def evaluate(predictions: DataFrame, label: str = LABEL) -> DataFrame:
    """One metrics row: areas under ROC and PR, accuracy, weighted precision/recall, F1.

    Rows without prediction or label have nothing to compare and are left out. The curves
    have a point per score (no bins). Predictions feed three passes, so they are kept while
    the metrics are made.
    """
    kept = predictions.where(C("prediction").isNotNull() & C(label).isNotNull()).select(label, "rawPrediction", "prediction").persist()
    try:
        areas = {name: BinaryClassificationEvaluator(labelCol=label, metricName=metric, numBins=0).evaluate(kept)
                 for name, metric in (("auc_roc", "areaUnderROC"), ("auc_pr", "areaUnderPR"))}
        row = weighted_metrics(confusion_counts(kept, label, "prediction")).first()
    finally:
        kept.unpersist()
    values = {**row.asDict(), **{k: round(v, 6) for k, v in areas.items()}}
    return predictions.sparkSession.createDataFrame([Row(**values)])


def penalised_gradient(model: PipelineModel, scored: DataFrame, label: str = LABEL) -> DataFrame:
    """How far a logistic fit is from the optimum of its loss, over the rows it was fitted to: one row with the rows
    fitted, the positives and the largest absolute (sub)gradient of the mean penalised loss.

    Features must have deviation one, as ``feature_pipeline`` makes them. A coefficient of zero
    may have any slope up to its share of the absolute penalty.
    """
    fit = classifier_of(model)
    weights, reg, mix = fit.coefficients.toArray(), fit.getRegParam(), fit.getElasticNetParam()
    miss = positive_probability() - C(label)
    x = vector_to_array("features")
    slopes = scored.where(C("prediction").isNotNull() & C(label).isNotNull()).agg(
        n().alias("fitted"), F.sum(label).cast("bigint").alias("positives"), F.avg(miss).alias("_b"),
        *[F.avg(miss * x[i]).alias(f"_{i}") for i in range(len(weights))])
    parts = [F.abs("_b")]
    for i, w in enumerate(weights):
        smooth = C(f"_{i}") + F.lit(reg * (1 - mix) * float(w))
        edge = reg * mix
        parts.append(F.abs(smooth + F.lit(edge if w > 0 else -edge)) if w else F.greatest(F.abs(smooth) - F.lit(edge), F.lit(0.0)))
    return slopes.select("fitted", "positives", F.greatest(*parts).alias("gradient"))


def prediction_distribution(predictions: DataFrame, predicted: str = "prediction") -> DataFrame:
    """Rows and percentage per predicted class."""
    counted = predictions.groupBy(C(predicted).cast("bigint").alias("class_label")).agg(n().alias("count"))
    return counted.withColumn("percentage", share_of_total("count", 4))


def confidence_statistics(predictions: DataFrame, probability: Column) -> DataFrame:
    return predictions.agg(mean(probability, 6).alias("avg_positive_probability"), sd(probability, 6).alias("std_positive_probability"))


def business_metrics(confusion: DataFrame, denominator: str = "actual") -> DataFrame:
    """Error rates and their cost. Rates are per actual class, or over all rows."""
    tp, tn, fp, fn = (C(c) for c in ("tp", "tn", "fp", "fn"))
    everyone = tp + tn + fp + fn
    if denominator not in ("actual", "all"):
        raise ValueError("denominator is 'actual' or 'all'")
    fp_base, fn_base = (fp + tn, fn + tp) if denominator == "actual" else (everyone, everyone)
    return confusion.select(
        *confusion.columns, F.coalesce(pct(fp, fp_base, 4), F.lit(0.0)).alias("false_positive_rate"),
        F.coalesce(pct(fn, fn_base, 4), F.lit(0.0)).alias("false_negative_rate"),
        F.coalesce(pct(tp, tp + fn, 4), F.lit(0.0)).alias("early_detection_rate"),
        pct(tp + fp, everyone, 4).alias("high_risk_identification_rate"), fp.alias("unnecessary_interventions"),
        fn.alias("missed_cases"), (fn * F.lit(R.MISSED_CASE_COST)).alias("cost_of_false_negatives"),
        (fp * F.lit(R.FALSE_ALARM_COST)).alias("cost_of_false_positives"))


def model_gate(metrics: DataFrame) -> DataFrame:
    """Quality label, readiness and advice from a row with accuracy, f1_score, auc_roc, false_negative_rate."""
    ok = {k: (C(k) <= limit if k == "false_negative_rate" else C(k) >= limit) for k, limit in R.GATE.items()}
    ready = ok["accuracy"] & ok["f1_score"] & ok["auc_roc"] & ok["false_negative_rate"]
    quality = first_match([((C("accuracy") >= a) & (C("f1_score") >= f), name) for name, a, f in R.GATE_LADDER], R.GATE_DEFAULT)
    return metrics.select("*", quality.alias("model_quality"), ready.alias("deployment_ready"),
                          tag_text([(~ok[k], R.GATE_ADVICE[k]) for k in R.GATE], "; ").alias("improvement_suggestions"))


def strict_gate(metrics: DataFrame) -> DataFrame:
    """The older, stricter gate; also needs false_positive_rate."""
    limit = R.STRICT_GATE
    best = ((C("accuracy") >= limit["accuracy"]) & (C("f1_score") >= limit["f1_score"])
            & (C("false_negative_rate") <= limit["false_negative_rate"]))
    steps = [(best, "EXCELLENT", True)] + [((C("accuracy") >= a) & (C("f1_score") >= f), name, go)
                                           for name, a, f, go in R.STRICT_GATE_LADDER]
    advice = [(C("accuracy") < limit["accuracy"], R.STRICT_GATE_ADVICE["accuracy"]),
              (C("false_negative_rate") > limit["false_negative_rate"], R.STRICT_GATE_ADVICE["false_negative_rate"]),
              (C("false_positive_rate") > limit["false_positive_rate"], R.STRICT_GATE_ADVICE["false_positive_rate"])]
    return metrics.select("*", first_match([(c, name) for c, name, _ in steps], "POOR").alias("model_quality"),
                          first_match([(c, go) for c, _, go in steps], False).alias("deployment_ready"),
                          tag_text(advice, "; ").alias("improvement_suggestions"))


def feature_importances(model: PipelineModel, columns: list[str], spark) -> DataFrame:
    """Importance per feature name, largest first (one row per feature column)."""
    last = classifier_of(model)
    vector = last.featureImportances if hasattr(last, "featureImportances") else last.coefficients
    rows = sorted(zip(columns, (float(v) for v in vector.toArray())), key=lambda r: -abs(r[1]))
    return spark.createDataFrame([(i, c, round(v, 6)) for i, (c, v) in enumerate(rows, 1)], "place int, feature string, importance double")


def registry_row(metrics: DataFrame, name: str, version: str, kind: str, deployed: Column, status: str = "Active") -> DataFrame:
    """A metrics row in the shape of the model registry table."""
    return metrics.select(
        F.lit(name).alias("model_name"), F.lit(version).alias("model_version"), F.lit(kind).alias("model_type"), "accuracy",
        C("precision").alias("precision_score"), "recall", "f1_score", "auc_roc", "auc_pr", C("total").alias("test_samples"),
        deployed.alias("deployment_date"), F.lit(status).alias("model_status"))


def drift(df: DataFrame, baselines: dict[str, float], digits: int = 6) -> DataFrame:
    """|mean - baseline| per column."""
    return df.agg(*[rnd(F.abs(F.avg(c) - F.lit(b)), digits).alias(f"{c}_drift") for c, b in baselines.items()])
