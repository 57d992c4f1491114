"""Monitoring views, alerts and dashboard panels."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from vitalmart.functions.numeric import ratio, rnd
from vitalmart.operators.aggregate import mean, n, n_if, rate
from vitalmart.plans import reports, samples
from vitalmart.rules import clinical as R

from . import sql as S
from .base import EARLY, EARLY_TS, MIDDLE, cut, query
from .reports_clinical import JOBS
from .reports_gold import DEEP, DEMOGRAPHIC, HIGH, PREVENT, SICK, _is, _level, _prio, _share, _since, _stamp, _text

C = F.col
AS_OF = dt.datetime(1998, 7, 15, 12)
_NOW = "TIMESTAMP '1998-07-15 12:00:00'"


def _after(span: str, now: str = f"TIMESTAMP '{EARLY} 00:00:00'") -> str:
    return f"(SELECT * FROM gold WHERE processed_timestamp > {now} - INTERVAL {span})"


@query("v37_system_health", S.WITH_GOLD + S.select({
    "category": "'System Health'",
    "data_pipeline_status": f"CASE WHEN MAX(processed_timestamp) > {_NOW} - INTERVAL 1 HOUR THEN 'Healthy' WHEN MAX(processed_timestamp) >"
                            f" {_NOW} - INTERVAL 6 HOUR THEN 'Warning' ELSE 'Critical' END",
    "data_age_hours": S.r(f"(epoch_us({_NOW}) - epoch_us(MAX(processed_timestamp))) / 3.6e9", 6),
    "records_last_hour": S.cnt(f"processed_timestamp > {_NOW} - INTERVAL 1 HOUR"),
    "records_last_day": S.cnt(f"processed_timestamp > {_NOW} - INTERVAL 1 DAY"),
    "avg_quality_score": S.r("AVG(quality_score) * 1e2", 2), "low_quality_count": S.cnt("quality_score < 0.8"),
    "avg_prediction_confidence": S.avg("prediction_probability", 4), "missing_predictions": S.cnt("prediction_probability IS NULL"),
    "critical_risk_alerts": _level("Critical"), "high_risk_alerts": _level("High"), "immediate_interventions": _prio("Immediate"),
    "glucose_anomalies": S.cnt("glucose > 400 OR glucose < 0"), "bmi_anomalies": S.cnt("bmi > 60 OR bmi < 10"),
    "age_anomalies": S.cnt("age > 120 OR age < 0")}, "gold"))
def _(t):
    return reports.system_health(t.gold, AS_OF)


def _grade(x: str, op: str, crit: float, warn: float) -> str:
    return f"CASE WHEN {x} {op} {crit} THEN 'Critical' WHEN {x} {op} {warn} THEN 'Warning' ELSE 'Normal' END"


_HOT, _RISKY = S.cnt("glucose > 200"), S.cnt(HIGH)
ALERTS = {
    "High Glucose Patients": (f"CAST({_HOT} AS DOUBLE)", "50e0", _grade(_HOT, ">", 100, 50)),
    "Data Quality Degradation": (S.r("AVG(quality_score) * 1e2", 2), "85e0", _grade("AVG(quality_score)", "<", 0.7, 0.85)),
    "Low Model Confidence": (S.r("AVG(prediction_probability) * 1e2", 2), "70e0", _grade("AVG(prediction_probability)", "<", 0.5, 0.7)),
    "High Risk Patient Surge": (f"CAST({_RISKY} AS DOUBLE)", "100e0", _grade(_RISKY, ">", 200, 100))}


@query("v38_alert_threshold_monitoring", S.WITH_GOLD + "SELECT * FROM (" + S.rows("alert_type", {
    k: {"current_value": v, "threshold_value": limit, "alert_level": grade, "alert_message": S.q(R.ALERT_TEXT[k][0]),
        "recommendation": S.q(R.ALERT_TEXT[k][1]), "last_triggered": _stamp("MAX(processed_timestamp)")}
    for k, (v, limit, grade) in ALERTS.items()}, _after("24 HOUR")) + ") WHERE alert_level <> 'Normal'")
def _(t):
    return reports.alert_threshold_monitoring(t.gold, EARLY_TS)


@query("v39_etl_pipeline_performance", S.report({"processing_hour": _stamp("date_trunc('hour', processed_timestamp)")}, {
    "records_processed": S.cnt(), "records_per_second": S.r("COUNT(*) / 3600e0", 6), "high_quality_records": S.cnt("quality_score >= 0.9"),
    "low_quality_records": S.cnt("quality_score < 0.8"), "avg_quality_score": S.r("AVG(quality_score) * 1e2", 2),
    "successful_predictions": "COUNT(prediction_probability)", "failed_predictions": "COUNT(*) - COUNT(prediction_probability)",
    "prediction_success_rate": S.pct("COUNT(prediction_probability)", "COUNT(*)", 2),
    "feature_engineering_success": "COUNT(glucose_bmi_interaction)", "risk_scoring_success": "COUNT(risk_score)",
    "missing_data_errors": S.cnt("glucose IS NULL OR bmi IS NULL OR age IS NULL"), "outlier_errors": S.cnt("glucose < 0 OR glucose > 600"),
    "processing_duration_seconds": S.r("(epoch_us(MAX(processed_timestamp)) - epoch_us(MIN(processed_timestamp))) / 1e6", 3)},
    _after("7 DAY"), S.WITH_GOLD))
def _(t):
    return reports.etl_pipeline_performance(t.gold, EARLY_TS)


@query("v40_model_drift_detection", S.report({"analysis_date": "CAST(processed_timestamp AS DATE)"}, {
    **{k: v for c in ("glucose", "bmi", "age") for k, v in ((f"avg_{c}", S.avg(c, 2)), (f"stddev_{c}", S.sd(c, 2)))},
    **{k: v for c, o in (("prediction_probability", "prediction_prob"), ("risk_score", "risk_score"))
       for k, v in ((f"avg_{o}", S.avg(c, 4)), (f"stddev_{o}", S.sd(c, 4)))},
    "high_risk_percentage": S.rate(_is("health_risk_level", "High"), 6), "critical_risk_percentage": S.rate(_is("health_risk_level", "Critical"), 6),
    "diabetes_rate": S.rate(SICK, 6), "daily_volume": S.cnt(), "glucose_drift_magnitude": S.r("abs(AVG(glucose) - 120)", 6),
    "bmi_drift_magnitude": S.r("abs(AVG(bmi) - 30)", 6), "prediction_drift_magnitude": S.r("abs(AVG(prediction_probability) - 0.5e0)", 6)},
    _after("30 DAY"), S.WITH_GOLD))
def _(t):
    return reports.model_drift_detection(t.gold, EARLY_TS)


@query("v41_healthcare_impact_metrics", S.report({"week_start": "CAST(date_trunc('week', processed_timestamp) AS DATE)"}, {
    "total_patients_screened": S.cnt(), "high_risk_patients_identified": S.cnt(HIGH),
    "prevention_opportunities": S.cnt("diabetes = 0 AND risk_score > 0.6"), "immediate_interventions_needed": _prio("Immediate"),
    "soon_interventions_needed": _prio("Soon"),
    **{f"estimated_{k.lower()}_cost_impact": f"{S.cnt(_is('estimated_cost_category', k))} * {v}" for k, v in R.IMPACT_COST.items()},
    "potential_cost_savings_prevention": f"{S.cnt('diabetes = 0 AND risk_score > 0.7')} * 25000",
    "population_health_index": S.r("AVG(CASE WHEN diabetes = 0 THEN (1e0 - risk_score) * 1e2 ELSE 0e0 END)", 2),
    "screening_effectiveness_score": S.r("AVG(prediction_probability) * 1e2", 2), "age_groups_covered": "COUNT(DISTINCT age_group)",
    "bmi_categories_covered": "COUNT(DISTINCT bmi_category)", "data_quality_score": S.r("AVG(quality_score) * 1e2", 2),
    "data_quality_issues": S.cnt("quality_score < 0.8")}, _after("84 DAY"), S.WITH_GOLD))
def _(t):
    return reports.healthcare_impact_metrics(t.gold, EARLY_TS)


def _newer(span: str) -> str:
    return f"MAX(processed_timestamp) > TIMESTAMP '{EARLY} 00:00:00' - INTERVAL {span}"


_HOUR = S.cnt(f"processed_timestamp > TIMESTAMP '{EARLY} 00:00:00' - INTERVAL 1 HOUR")


def _tiers(x: str, a: float, b: float, c: float) -> str:
    return f"CASE WHEN {x} >= {a} THEN 'Exceeded' WHEN {x} >= {b} THEN 'Met' WHEN {x} >= {c} THEN 'Warning' ELSE 'Breached' END"


@query("v42_sla_monitoring", S.WITH_GOLD + S.select({
    "sla_type": "'Data Processing SLA'",
    "availability_percentage": f"CASE WHEN {_newer('1 HOUR')} THEN 99.9e0 WHEN {_newer('4 HOUR')} THEN 95e0 ELSE 90e0 END",
    "data_freshness_sla": f"CASE WHEN {_newer('30 MINUTE')} THEN 'Met' WHEN {_newer('2 HOUR')} THEN 'Warning' ELSE 'Breached' END",
    "data_quality_sla": _tiers("AVG(quality_score)", 0.95, 0.9, 0.85),
    "volume_processing_sla": f"CASE WHEN {_HOUR} >= 100 THEN 'Met' WHEN {_HOUR} >= 50 THEN 'Warning' ELSE 'Breached' END",
    "model_performance_sla": _tiers("AVG(prediction_probability)", 0.8, 0.7, 0.6),
    "avg_processing_time_per_record": S.r("(epoch_us(MAX(processed_timestamp)) - epoch_us(MIN(processed_timestamp))) / 1e6 / COUNT(*)", 6)},
    _after("24 HOUR")))
def _(t):
    return reports.sla_monitoring(t.gold, EARLY_TS)


# ---- panels ----------------------------------------------------------------
@query("v43_summary_panel", S.rows("metric", {
    "Total Patients": {"value": "CAST(COUNT(*) AS VARCHAR)", "unit": "'count'"},
    "Diabetes Cases": {"value": f"CAST({S.cnt(SICK)} AS VARCHAR)", "unit": "'count'"},
    "Diabetes Rate": {"value": _text("AVG(diabetes) * 1e2", 1) + " || '%'", "unit": "'percentage'"},
    "High Risk Patients": {"value": f"CAST({S.cnt(HIGH)} AS VARCHAR)", "unit": "'count'"},
    "Average Risk Score": {"value": _text("AVG(risk_score) * 1e2", 1) + " || '%'", "unit": "'percentage'"},
    "Immediate Interventions": {"value": f"CAST({_prio('Immediate')} AS VARCHAR)", "unit": "'count'"},
    "Estimated Annual Cost": {"value": "'$' || " + _text("SUM(annual_cost) / 1e6", 1) + " || 'M'", "unit": "'currency'"}},
    _since(30), S.WITH_GOLD))
def _(t):
    return reports.summary_panel(t.gold, EARLY)


@query("v44_daily_panel", S.report({"time": "processing_date"}, {
    "total_patients": S.cnt(), "diabetes_cases": S.cnt(SICK), "avg_risk_score": S.r("AVG(risk_score) * 1e2", 6),
    "data_quality_score": S.r("AVG(quality_score) * 1e2", 6)}, _since(90), S.WITH_GOLD))
def _(t):
    return reports.daily_panel(t.gold, EARLY)


@query("v44_hourly_panel", S.report({"time": _stamp("date_trunc('hour', processed_timestamp)")}, {
    "records_processed": S.cnt(), "quality_score": S.r("AVG(quality_score) * 1e2", 6), "diabetes_positive": S.cnt(SICK),
    "risk_levels_found": "COUNT(DISTINCT health_risk_level)"}, _after("24 HOUR"), S.WITH_GOLD))
def _(t):
    return reports.hourly_panel(t.gold, EARLY_TS)


@query("v45_risk_share_panel", S.report({"risk_level": "health_risk_level"}, {"patient_count": S.cnt(), "percentage": _share(1)},
                                        _since(30), S.WITH_GOLD))
def _(t):
    return reports.risk_share_panel(t.gold, EARLY)


_SUM = "CAST(SUM(annual_cost) AS BIGINT)"


@query("v45_priority_cost_panel", S.report({"priority": "intervention_priority"}, {
    "count": S.cnt(), "avg_cost": S.avg("annual_cost", 6), "total_cost": _SUM}, _since(30), S.WITH_GOLD))
def _(t):
    return reports.priority_cost_panel(t.gold, EARLY)


@query("v46_age_panel", S.report({"age_group": "age_group"}, {
    "total_patients": S.cnt(), "diabetes_cases": S.cnt(SICK), "diabetes_rate": S.rate(SICK, 1),
    "avg_risk_score": S.r("AVG(risk_score) * 1e2", 6), "avg_bmi": S.avg("bmi", 6), "avg_glucose": S.avg("glucose", 6)}, _since(30), S.WITH_GOLD))
def _(t):
    return reports.age_panel(t.gold, EARLY)


@query("v46_bmi_panel", S.report({"bmi_category": "bmi_category"}, {
    "patient_count": S.cnt(), "avg_bmi": S.avg("bmi", 1), "diabetes_cases": S.cnt(SICK), "diabetes_rate": S.rate(SICK, 1),
    "high_risk_count": S.cnt(HIGH)}, _since(30), S.WITH_GOLD))
def _(t):
    return reports.bmi_panel(t.gold, EARLY)


@query("v47_glucose_histogram", S.report({"glucose_range": S.ladder("glucose", R.GLUCOSE_HISTOGRAM)}, {
    "patient_count": S.cnt(), "avg_glucose": S.avg("glucose", 6), "diabetes_rate": S.rate(SICK, 1)},
    f"(SELECT * FROM {_since(30)} WHERE glucose > 0)", S.WITH_GOLD))
def _(t):
    return reports.glucose_histogram(t.gold, EARLY)


def _pair(a: str, b: str, where: str) -> dict[str, str]:
    return {"correlation_coefficient": S.r(f"CORR({a}, {b}) FILTER (WHERE {where})", 3)}


@query("v48_correlation_panel", S.rows("correlation_pair", {
    "Glucose vs BMI": _pair("glucose", "bmi", "glucose > 0 AND bmi > 0"), "Glucose vs Age": _pair("glucose", "age", "glucose > 0"),
    "BMI vs Blood Pressure": _pair("bmi", "blood_pressure", "bmi > 0 AND blood_pressure > 0"),
    "Age vs Risk Score": _pair("age", "risk_score", "TRUE")}, _since(30), S.WITH_GOLD))
def _(t):
    return reports.correlation_panel(t.gold, EARLY)


@query("v49_accuracy_panel", S.WITH_GOLD + ", m AS (SELECT " + ", ".join(
    f"{S.cnt(f'diabetes = {a} AND risk_score {op} 0.5')} AS {k}" for k, a, op in (
        ("tp", 1, ">="), ("tn", 0, "<"), ("fp", 0, ">="), ("fn", 1, "<"))) + f" FROM {_since(30)}) " + S.rows("metric", {
            "Accuracy": {"value": S.pct("tp + tn", "tp + tn + fp + fn", 1), "unit": "'%'"},
            "Precision": {"value": S.pct("tp", "tp + fp", 1), "unit": "'%'"}, "Recall": {"value": S.pct("tp", "tp + fn", 1), "unit": "'%'"},
            "F1 Score": {"value": S.pct("2 * tp", "2 * tp + fp + fn", 1), "unit": "'%'"}}, "m"))
def _(t):
    return reports.accuracy_panel(t.gold, EARLY)


@query("v50_feature_panel", S.rows("feature_name", {
    label: {"importance_score": f"{w}e0", "clinical_significance": S.q(text), "correlation_with_diabetes": S.corr(c, "diabetes", 3)}
    for label, c, w, text in R.PANEL_FEATURES}, _since(30), S.WITH_GOLD))
def _(t):
    return reports.feature_panel(t.gold, EARLY)


@query("v51_cost_by_risk_panel", S.report({"health_risk_level": "health_risk_level"}, {
    "patient_count": S.cnt(), "total_cost": _SUM, "avg_cost_per_patient": S.avg("annual_cost", 6),
    "cost_per_patient": S.r("SUM(annual_cost) / COUNT(*)", 6)}, _since(30), S.WITH_GOLD))
def _(t):
    return reports.cost_by_risk_panel(t.gold, EARLY)


@query("v51_recommendation_panel", S.report({"treatment_recommendation": "treatment_recommendation"}, {
    "patient_count": S.cnt(), "percentage": _share(1), "avg_cost": S.avg("annual_cost", 6), "total_cost": _SUM}, _since(30), S.WITH_GOLD))
def _(t):
    return reports.recommendation_panel(t.gold, EARLY)


@query("v52_quality_panel", S.rows("metric", {
    "Overall Data Quality": {"value": S.r("AVG(quality_score) * 1e2", 1), "unit": "'%'"},
    "Records with High Quality (≥80%)": {"value": S.rate("quality_score >= 0.8", 1), "unit": "'%'"},
    "Complete Records (No Missing Values)": {"value": S.rate("quality_score = 1", 1), "unit": "'%'"}}, _since(30), S.WITH_GOLD))
def _(t):
    return reports.quality_panel(t.gold, EARLY)


@query("v52_anomaly_panel", S.report({"processing_date": "processing_date"}, {
    "total_records": S.cnt(), "records_with_anomalies": S.cnt(S.ANY_ANOMALY), "anomaly_rate": S.rate(S.ANY_ANOMALY, 2),
    "avg_quality_score": S.avg("quality_score", 6)}, _since(7), S.WITH_GOLD))
def _(t):
    return reports.anomaly_panel(t.gold, EARLY)


_LOG_NOW = "TIMESTAMP '2024-01-02 00:00:00'"
LOG_NOW = dt.datetime(2024, 1, 2)


@query("v53_pipeline_status_panel", JOBS + "SELECT stage AS pipeline_stage, status, COUNT(*) AS execution_count, "
       + _stamp("MAX(end_time)") + " AS last_execution, " + S.avg("duration_seconds", 6) + " AS avg_duration_seconds FROM jobs"
       f" WHERE start_time >= {_LOG_NOW} - INTERVAL 24 HOUR GROUP BY stage, status")
def _(t):
    return reports.pipeline_status_panel(samples.run_log(t.events), LOG_NOW)


@query("v53_latest_processing_panel", JOBS + ", " + S.WITH_GOLD[5:] + "SELECT 'Last ETL Run' AS metric, " + _stamp("MAX(end_time)")
       + " AS value, 'timestamp' AS unit FROM jobs WHERE status = 'SUCCESS' UNION ALL SELECT 'Records Processed Today', CAST(COUNT(*) AS"
       " VARCHAR), 'count' FROM gold WHERE processing_date = DATE '2000-01-03' UNION ALL SELECT 'Active Alerts', CAST(COUNT(*) AS VARCHAR),"
       " 'count' FROM jobs WHERE status = 'ERROR' AND start_time >= TIMESTAMP '2000-01-03 00:00:00' - INTERVAL 24 HOUR")
def _(t):
    return reports.latest_processing_panel(samples.run_log(t.events), t.gold, dt.datetime(2000, 1, 3))


# ---- single-value and chart panels -----------------------------------------
@query("v59_single_values", S.WITH_GOLD + S.select({
    "total_patients": S.cnt(), "diabetes_rate": S.rate(SICK, 1), "avg_glucose": S.avg("glucose", 1), "avg_bmi": S.avg("bmi", 1),
    "avg_risk_score": S.avg("risk_score", 3), "high_risk_rate": S.rate(HIGH, 1), "prevention_candidates": S.cnt(PREVENT),
    "avg_quality": S.avg("quality_score", 3)}, "gold"))
def _(t):
    return t.gold.agg(n().alias("total_patients"), rate(reports.sick(), 1).alias("diabetes_rate"), mean("glucose", 1).alias("avg_glucose"),
                      mean("bmi", 1).alias("avg_bmi"), mean("risk_score", 3).alias("avg_risk_score"),
                      rate(reports.high_risk(), 1).alias("high_risk_rate"), n_if(reports.preventable()).alias("prevention_candidates"),
                      mean("quality_score", 3).alias("avg_quality"))


@query("v59_sensitivity_specificity", "WITH deep AS (" + DEEP + ") SELECT analysis_date AS time, estimated_accuracy, avg_confidence, "
       + S.pct("true_positives", "true_positives + false_negatives", 6) + " AS sensitivity, "
       + S.pct("true_negatives", "true_negatives + false_positives", 6) + " AS specificity FROM deep")
def _(t):
    d = reports.model_performance_deep_analysis(t.gold)
    tp, fn, tn, fp = (C(c) for c in ("true_positives", "false_negatives", "true_negatives", "false_positives"))
    return d.select(C("analysis_date").alias("time"), "estimated_accuracy", "avg_confidence",
                    rnd(ratio(tp * 100.0, tp + fn), 6).alias("sensitivity"), rnd(ratio(tn * 100.0, tn + fp), 6).alias("specificity"))


@query("v59_top_demographics", "WITH prof AS (" + DEMOGRAPHIC + ") SELECT age_group || ' - ' || bmi_category AS category, glucose_category,"
       " avg_glucose, avg_bmi, avg_blood_pressure, diabetes_rate FROM prof ORDER BY diabetes_rate DESC, age_group, bmi_category,"
       " glucose_category LIMIT 20")
def _(t):
    p = reports.demographic_health_profile(t.gold)
    return p.orderBy(C("diabetes_rate").desc(), "age_group", "bmi_category", "glucose_category").limit(20).select(
        F.concat_ws(" - ", "age_group", "bmi_category").alias("category"), "glucose_category", "avg_glucose", "avg_bmi",
        "avg_blood_pressure", "diabetes_rate")


@query("v59_confidence_levels", "WITH deep AS (" + DEEP + "), last AS (SELECT * FROM deep ORDER BY analysis_date DESC LIMIT 1) "
       + " UNION ALL ".join(f"SELECT '{k}' AS confidence_level, {c} AS count FROM last" for k, c in (
           ("Very High", "very_high_confidence"), ("High", "high_confidence"), ("Medium", "medium_confidence"), ("Low", "low_confidence"))))
def _(t):
    names = {"very_high_confidence": "Very High", "high_confidence": "High", "medium_confidence": "Medium", "low_confidence": "Low"}
    last = reports.model_performance_deep_analysis(t.gold).orderBy(C("analysis_date").desc()).limit(1)
    return last.select(*[C(c).alias(k) for c, k in names.items()]).unpivot([], list(names.values()), "confidence_level", "count")


@query("v59_risk_scatter", S.WITH_GOLD + "SELECT risk_score, diabetes, age_group FROM gold WHERE risk_score IS NOT NULL AND diabetes IS NOT NULL"
       " ORDER BY risk_score DESC, id DESC, diabetes, age_group LIMIT 1000")
def _(t):
    """Top 1000 points; an explicit order makes the sample repeatable."""
    rows = t.gold.where(C("risk_score").isNotNull() & C("diabetes").isNotNull())
    return rows.orderBy(C("risk_score").desc(), C("id").desc(), "diabetes", "age_group").limit(1000).select(
        "risk_score", "diabetes", "age_group")


cut("v38_alert_threshold_monitoring", reports.alert_threshold_monitoring, dt.datetime.combine(MIDDLE, dt.time()))
