"""Operational tables (predictions, registry, run log, checks) derived from the sample tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalmart.functions.numeric import ratio, rnd
from vitalmart.operators.aggregate import mean, n, n_if, report
from vitalmart.operators.quality import pass_rule

C = F.col


def predictions(gold: DataFrame) -> DataFrame:
    """Rule predictions in the shape of a prediction table."""
    p = C("prediction_probability")
    return gold.select(C("id").alias("patient_id"), F.lit("threshold_rules").alias("model_name"),
                       F.concat(F.lit("v"), (C("pregnancies") % 3).cast("string")).alias("model_version"), p,
                       C("prediction").alias("prediction_binary"), (F.abs(p - 0.5) * 2.0).alias("confidence_score"))


def model_performance(gold: DataFrame) -> DataFrame:
    """One evaluation per parity group and month: accuracy, F1 and test rows."""
    hit, yes = C("prediction") == 1, C("diabetes") == 1
    tp, fp, fn = n_if(hit & yes), n_if(hit & ~yes), n_if(~hit & yes)
    keys = {"model_id": "pregnancies_category", "evaluation_date": F.date_trunc("month", "processed_timestamp").cast("date")}
    return report(gold, keys, {
        "accuracy": rnd(ratio(n_if(C("prediction") == C("diabetes")), n()), 6),
        "f1_score": rnd(ratio(2 * tp, 2 * tp + fp + fn), 6), "test_samples": n()})


def model_registry(gold: DataFrame) -> DataFrame:
    """One registered rule model per age group."""
    hit, yes = C("prediction") == 1, C("diabetes") == 1
    acc = rnd(ratio(n_if(C("prediction") == C("diabetes")), n()), 6)
    return report(gold, {"model_name": "age_group"}, {
        "accuracy": acc, "precision_score": rnd(ratio(n_if(hit & yes), n_if(hit)), 6),
        "recall": rnd(ratio(n_if(hit & yes), n_if(yes)), 6), "deployment_date": F.min("processing_date"),
        "model_status": F.when(acc >= 0.5, F.lit("Active")).otherwise(F.lit("Testing"))})


def run_log(events: DataFrame) -> DataFrame:
    """Finished runs: one per event type, user and day."""
    kinds = {"click": "bronze_to_silver", "view": "silver_to_gold"}
    stage = F.when(C("event_type") == "click", kinds["click"]).when(C("event_type") == "view", kinds["view"]).otherwise(
        "analytics_refresh")
    keys = {"pipeline_stage": stage, "event_type": "event_type", "user_id": "user_id", "day": C("ts").cast("date")}
    runs = report(events, keys, {"start_time": F.min("ts"), "end_time": F.max("ts"), "records_processed": n(),
                                 "records_failed": n_if(C("event_type") == "error")})
    micros = F.unix_micros(C("end_time").cast("timestamp")) - F.unix_micros(C("start_time").cast("timestamp"))
    return runs.withColumns({
        "job_type": C("pipeline_stage"), "pipeline_name": F.concat(F.lit("pipeline_"), C("event_type")),
        "status": F.when(C("records_failed") > 0, F.lit("ERROR")).otherwise(F.lit("SUCCESS")),
        "duration_seconds": micros / F.lit(1e6)})


def event_checks(events: DataFrame, thresholds: dict[str, float]) -> DataFrame:
    """Daily quality checks per event type, with the pass rule applied."""
    daily = report(events, {"check_timestamp": F.date_trunc("day", "ts").cast("timestamp_ntz"), "table_name": "event_type"}, {
        "row_count": n().cast("double"), "avg_value": mean("value", 4)})
    long = daily.unpivot(["check_timestamp", "table_name"], ["row_count", "avg_value"], "metric_name", "metric_value")
    limit = F.element_at(F.create_map(*[x for k, v in thresholds.items() for x in (F.lit(k), F.lit(v))]), C("metric_name"))
    return long.withColumns({"schema_name": F.lit("events"), "threshold_value": limit}).withColumn(
        "is_passed", pass_rule(C("metric_name"), C("metric_value"), C("threshold_value")))
