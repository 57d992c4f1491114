"""Reports on the gold layer."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from vitalmart.operators.aggregate import mean, n, report
from vitalmart.plans import reports, samples
from vitalmart.rules import clinical as R

from . import sql as S
from .base import EARLY, MIDDLE, cut, query

C = F.col
SICK = "diabetes = 1"
HIGH = "health_risk_level IN ('High', 'Critical')"
NOW = "health_risk_level"
PREVENT = "diabetes = 0 AND glucose_category = 'Prediabetic'"


def _is(column: str, value: str) -> str:
    return f"{column} = '{value}'"


def _level(v: str) -> str:
    return S.cnt(_is("health_risk_level", v))


def _prio(v: str) -> str:
    return S.cnt(_is("intervention_priority", v))


def _stamp(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S')"


def _since(days: int) -> str:
    return f"(SELECT * FROM gold WHERE processing_date >= DATE '{EARLY}' - {days})"


def _share(n: int) -> str:
    return S.pct("COUNT(*)", "SUM(COUNT(*)) OVER ()", n)


# ---- daily, level, priority ------------------------------------------------
@query("v6_enhanced_daily_stats", S.report({"date": "processing_date"}, {
    "total_records": S.cnt(), "diabetic_count": S.cnt(SICK), "non_diabetic_count": S.cnt("diabetes = 0"),
    **{f"avg_{c}": S.avg(c, 2) for c in ("glucose", "bmi", "age", "risk_score")},
    "avg_prediction_confidence": S.avg("prediction_probability", 2), "high_risk_count": _level("High"),
    "critical_risk_count": _level("Critical"), "immediate_intervention_count": _prio("Immediate"),
    "avg_data_quality": S.avg("quality_score", 2)}, "gold", S.WITH_GOLD))
def _(t):
    return reports.enhanced_daily_stats(t.gold)


@query("v7_risk_level_analysis", S.report({"health_risk_level": "health_risk_level"}, {
    "patient_count": S.cnt(), "percentage": _share(2), "diabetic_count": S.cnt(SICK), "diabetes_rate": S.rate(SICK, 2),
    **{f"avg_{c}": S.avg(c, 2) for c in ("glucose", "bmi", "age", "risk_score")},
    "avg_prediction_confidence": S.avg("prediction_probability", 2)}, "gold", S.WITH_GOLD))
def _(t):
    return reports.risk_level_analysis(t.gold)


@query("v8_intervention_priority_analysis", S.report({"intervention_priority": "intervention_priority"}, {
    "patient_count": S.cnt(), "percentage": _share(2), "diabetic_count": S.cnt(SICK), "avg_risk_score": S.avg("risk_score", 2),
    "avg_prediction_confidence": S.avg("prediction_probability", 2),
    "cost_categories": "string_agg(DISTINCT estimated_cost_category, ', ' ORDER BY estimated_cost_category)"}, "gold", S.WITH_GOLD))
def _(t):
    return reports.intervention_priority_analysis(t.gold)


@query("v9_feature_correlation_insights", S.rows("feature_pair", {
    label: {"avg_interaction": S.avg(c, 4), "correlation_with_diabetes": S.corr(c, "diabetes", 4)} for label, c in [
        ("Glucose-BMI Interaction", "glucose_bmi_interaction"), ("Age-Glucose Interaction", "age_glucose_interaction"),
        ("Insulin-Glucose Interaction", "insulin_glucose_interaction")]}, "gold", S.WITH_GOLD))
def _(t):
    return reports.feature_correlation_insights(t.gold)


@query("v10_model_performance_tracking", S.WITH_GOLD + ", reg AS (" + S.select({
    "model_name": "age_group", "accuracy": S.r("COUNT(*) FILTER (WHERE prediction = diabetes) / COUNT(*)", 6),
    "precision_score": S.r("COUNT(*) FILTER (WHERE prediction = 1 AND diabetes = 1) / NULLIF(COUNT(*) FILTER (WHERE prediction = 1), 0)", 6),
    "recall": S.r("COUNT(*) FILTER (WHERE prediction = 1 AND diabetes = 1) / NULLIF(COUNT(*) FILTER (WHERE diabetes = 1), 0)", 6),
    "deployment_date": "MIN(processing_date)"}, "gold", ["model_name"]) + ") SELECT *, 'Active' AS model_status,"
    " CAST(DATE '2002-01-01' - deployment_date AS BIGINT) AS days_since_deployment FROM reg WHERE accuracy >= 0.5")
def _(t):
    return reports.model_performance_tracking(samples.model_registry(t.gold), dt.date(2002, 1, 1))


def _text(x: str, digits: int) -> str:
    return f"printf('%.{digits}f', {S.r(x, digits)})"


@query("v11_latest_comprehensive_metrics", S.rows("metric_name", {
    "total_patients": {"metric_value": "CAST(COUNT(*) AS VARCHAR)", "metric_type": "'count'"},
    "diabetic_patients": {"metric_value": f"CAST({S.cnt(SICK)} AS VARCHAR)", "metric_type": "'count'"},
    "high_risk_patients": {"metric_value": f"CAST({S.cnt(HIGH)} AS VARCHAR)", "metric_type": "'count'"},
    "immediate_interventions": {"metric_value": f"CAST({_prio('Immediate')} AS VARCHAR)", "metric_type": "'count'"},
    "avg_prediction_confidence": {"metric_value": _text("AVG(prediction_probability)", 3), "metric_type": "'percentage'"},
    "avg_data_quality": {"metric_value": _text("AVG(quality_score)", 3), "metric_type": "'score'"}}, "gold", S.WITH_GOLD))
def _(t):
    return reports.latest_comprehensive_metrics(t.gold)


# ---- advanced analytics ----------------------------------------------------
@query("v20_temporal_health_trends", S.report({
    "week_start": "CAST(date_trunc('week', processed_timestamp) AS DATE)",
    "month_start": "CAST(date_trunc('month', processed_timestamp) AS DATE)"}, {
    "total_patients": S.cnt(), "diabetes_prevalence_pct": S.rate(SICK, 2), "avg_risk_score": S.avg("risk_score", 3),
    "avg_prediction_confidence": S.avg("prediction_probability", 3), "avg_glucose": S.avg("glucose", 2), "avg_bmi": S.avg("bmi", 2),
    "avg_age": S.avg("age", 1), "avg_blood_pressure": S.avg("blood_pressure", 2), "avg_insulin": S.avg("insulin", 2),
    **{f"{v.lower()}_risk_count": _level(v) for v in ("Critical", "High", "Medium", "Low")},
    **{f"{v.lower()}_interventions": _prio(v) for v in ("Immediate", "Soon", "Routine")},
    "avg_data_quality": S.avg("quality_score", 3), "low_quality_records": S.cnt("quality_score < 0.8")}, "gold", S.WITH_GOLD))
def _(t):
    return reports.temporal_health_trends(t.gold)


_PROFILE = {k: k for k in ("age_group", "bmi_category", "glucose_category")}
DEMOGRAPHIC = S.report(_PROFILE, {
    "population_count": S.cnt(), "population_percentage": _share(2), "diabetic_cases": S.cnt(SICK), "diabetes_rate": S.rate(SICK, 2),
    "avg_risk_score": S.avg("risk_score", 3), "risk_score_stddev": S.sd("risk_score", 3), "high_risk_individuals": S.cnt("risk_score > 0.7"),
    **{f"avg_{c}": S.avg(c, 2) for c in ("glucose", "bmi", "blood_pressure", "insulin")},
    "immediate_care_needed": _prio("Immediate"), "soon_care_needed": _prio("Soon"),
    **{f"{v.lower()}_cost_cases": S.cnt(_is("estimated_cost_category", v)) for v in ("High", "Medium", "Low")},
    "cardiovascular_risk_cases": S.cnt("cardiovascular_risk > 0.5"), "metabolic_syndrome_cases": S.cnt("metabolic_syndrome_risk > 0.5")},
    "gold", S.WITH_GOLD)


@query("v21_demographic_health_profile", DEMOGRAPHIC)
def _(t):
    return reports.demographic_health_profile(t.gold)


_TP, _TN, _FP, _FN = ("prediction = 1 AND diabetes = 1", "prediction = 0 AND diabetes = 0", "prediction = 1 AND diabetes = 0",
                      "prediction = 0 AND diabetes = 1")
DEEP = S.report({"analysis_date": "CAST(processed_timestamp AS DATE)"}, {
    "total_predictions": S.cnt(), "avg_confidence": S.avg("prediction_probability", 4),
    "confidence_stddev": S.sd("prediction_probability", 4), "very_high_confidence": S.cnt("prediction_probability >= 0.9"),
    "high_confidence": S.cnt("prediction_probability >= 0.7 AND prediction_probability < 0.9"),
    "medium_confidence": S.cnt("prediction_probability >= 0.5 AND prediction_probability < 0.7"),
    "low_confidence": S.cnt("prediction_probability < 0.5"), "correct_predictions": S.cnt("prediction = diabetes"),
    "estimated_accuracy": S.rate("prediction = diabetes", 2), "false_positives": S.cnt(_FP), "false_negatives": S.cnt(_FN),
    "true_positives": S.cnt(_TP), "true_negatives": S.cnt(_TN),
    **{f"{v.lower()}_risk_avg_confidence": S.r(f"AVG(prediction_probability) FILTER (WHERE health_risk_level = '{v}')", 4)
       for v in ("Critical", "High", "Medium", "Low")}}, "gold", S.WITH_GOLD)


@query("v22_model_performance_deep_analysis", DEEP)
def _(t):
    return reports.model_performance_deep_analysis(t.gold)


@query("v23_clinical_feature_insights", S.WITH_GOLD + S.select({
    "analysis_type": "'Feature Interactions'",
    **{k: S.corr(a, b, 4) for k, (a, b) in {
        "glucose_bmi_correlation": ("glucose", "bmi"), "age_glucose_correlation": ("age", "glucose"), "age_bmi_correlation": ("age", "bmi"),
        "age_diabetes_correlation": ("age", "diabetes"), "insulin_glucose_correlation": ("insulin", "glucose"),
        "bp_bmi_correlation": ("blood_pressure", "bmi"), "bp_diabetes_correlation": ("blood_pressure", "diabetes"),
        "pregnancy_diabetes_correlation": ("pregnancies", "diabetes")}.items()},
    **{f"avg_{c}": S.avg(c, 4) for c in ("glucose_bmi_interaction", "insulin_glucose_interaction", "pregnancy_risk_factor")}}, "gold"))
def _(t):
    return reports.clinical_feature_insights(t.gold)


@query("v24_clinical_threshold_analysis", S.rows("threshold_type", {
    label: {"threshold_value": f"CAST({limit} AS BIGINT)", "population_above_threshold": S.cnt(f"{c} >= {limit}"),
            "diabetes_cases_above_threshold": S.cnt(f"{c} >= {limit} AND diabetes = 1"),
            "diabetes_rate_above_threshold": S.pct(S.cnt(f"{c} >= {limit} AND diabetes = 1"), S.cnt(f"{c} >= {limit}"), 2),
            "avg_risk_score_above_threshold": S.r(f"AVG(risk_score) FILTER (WHERE {c} >= {limit})", 3),
            "intervention_recommendations": S.q(text)} for label, c, limit, text in R.CLINICAL_THRESHOLDS}, "gold", S.WITH_GOLD))
def _(t):
    return reports.clinical_threshold_analysis(t.gold)


_GAPS = {"Bronze Layer": ("glucose IS NULL OR bmi IS NULL OR age IS NULL",
                          "glucose < 0 OR glucose > 400 OR bmi < 10 OR bmi > 60 OR age < 0 OR age > 120"),
         "Gold Layer": ("prediction_probability IS NULL OR risk_score IS NULL",
                        "prediction_probability < 0 OR prediction_probability > 1 OR risk_score < 0 OR risk_score > 1")}


@query("v25_data_quality_comprehensive", S.rows("layer_name", {
    name: {"total_records": S.cnt(), "data_completeness_score": S.pct(f"COUNT(*) - {S.cnt(gap)}", "COUNT(*)", 2),
           "data_accuracy_score": S.pct(f"COUNT(*) - {S.cnt(wrong)}", "COUNT(*)", 2),
           "data_consistency_score": f"{R.LAYER_CONSISTENCY[name]}e0", "overall_quality_score": S.r("AVG(quality_score) * 1e2", 2),
           "quality_issues": S.cnt(f"{gap} OR {wrong}"), "last_quality_check": _stamp("MAX(processed_timestamp)"),
           "recommendations": S.q(R.LAYER_ADVICE[name])} for name, (gap, wrong) in _GAPS.items()}, "gold", S.WITH_GOLD))
def _(t):
    return reports.data_quality_comprehensive(t.gold)


_SAVE = f"CAST(15000 * {S.cnt(PREVENT)} AS BIGINT)"
_COST = "CAST(SUM(annual_cost) AS BIGINT)"


@query("v26_executive_kpi_dashboard", S.WITH_GOLD + S.select({
    "total_patients": S.cnt(), "high_risk_patients": S.cnt(HIGH), "immediate_care_needed": _prio("Immediate"),
    "diabetes_prevention_opportunities": S.cnt(PREVENT), "estimated_cost_savings": _SAVE, "estimated_total_cost": _COST,
    "population_health_score": S.r("AVG(risk_score) * 1e2", 1),
    "system_efficiency_score": S.pct(f"COUNT(*) - {_prio('Immediate')}", "COUNT(*)", 1),
    "data_quality_score": S.r("AVG(quality_score) * 1e2", 1)}, _since(7)))
def _(t):
    return reports.executive_kpi_dashboard(t.gold, EARLY)


@query("v26_executive_kpi_snapshot", S.WITH_GOLD + S.select({
    "kpi_category": "'Healthcare Impact'", "total_patients": S.cnt(), "high_risk_patients": S.cnt(HIGH),
    "immediate_care_needed": _prio("Immediate"), "diabetes_prevention_opportunities": S.cnt("diabetes = 0 AND risk_score > 0.5"),
    "estimated_cost_savings": "CAST(SUM(" + S.lookup("estimated_cost_category", R.KPI_COST, 0) + ") AS BIGINT)",
    "population_health_score": S.r("1e2 - AVG(risk_score) * 1e2", 2), "system_efficiency_score": S.r("AVG(prediction_probability) * 1e2", 2),
    "data_quality_score": S.r("AVG(quality_score) * 1e2", 2), "last_updated": _stamp("MAX(processed_timestamp)")}, "gold"))
def _(t):
    return reports.executive_kpi_snapshot(t.gold)


# ---- comprehensive views ---------------------------------------------------
@query("v27_clinical_risk_distribution", S.report({k: k for k in ("health_risk_level", "intervention_priority")}, {
    "patient_count": S.cnt(), "percentage": _share(1), "avg_risk_score": S.avg("risk_score", 3),
    **{f"avg_{c}": S.avg(c, 1) for c in ("glucose", "bmi", "age")}, "diabetic_patients": S.cnt(SICK), "diabetes_rate": S.rate(SICK, 1)},
    _since(30), S.WITH_GOLD))
def _(t):
    return reports.clinical_risk_distribution(t.gold, EARLY)


@query("v28_demographic_health_analysis", S.report({k: k for k in ("age_group", "bmi_category")}, {
    "total_patients": S.cnt(), "diabetic_patients": S.cnt(SICK), "diabetes_prevalence": S.rate(SICK, 1),
    "high_risk_patients": S.cnt(HIGH), "high_risk_prevalence": S.rate(HIGH, 1),
    **{f"avg_{c}": S.avg(c, 1) for c in ("glucose", "bmi", "blood_pressure")}, "avg_risk_score": S.avg("risk_score", 3),
    "avg_metabolic_risk": S.avg("metabolic_syndrome_risk", 3), "avg_cardiovascular_risk": S.avg("cardiovascular_risk", 3)},
    _since(30), S.WITH_GOLD))
def _(t):
    return reports.demographic_health_analysis(t.gold, EARLY)


@query("v29_glucose_analysis_trends", S.report({"glucose_category": "glucose_category"}, {
    "patient_count": S.cnt(), "distribution_percentage": _share(1), "avg_glucose": S.avg("glucose", 1), "glucose_stddev": S.sd("glucose", 1),
    "min_glucose": "MIN(glucose)", "max_glucose": "MAX(glucose)",
    **{k: S.r(f"quantile_cont(glucose, {p})", 1) for k, p in (("glucose_q1", 0.25), ("glucose_median", 0.5), ("glucose_q3", 0.75))},
    "confirmed_diabetic": S.cnt(SICK), "diabetes_confirmation_rate": S.rate(SICK, 1),
    "clinical_recommendation": S.lookup("glucose_category", R.GLUCOSE_ADVICE, R.GLUCOSE_ADVICE_OTHER)}, _since(30), S.WITH_GOLD))
def _(t):
    return reports.glucose_analysis_trends(t.gold, EARLY)


_L = R.LIFESTYLE_TEXT


@query("v30_bmi_lifestyle_analysis", S.report({"bmi_category": "bmi_category"}, {
    "patient_count": S.cnt(), "distribution_percentage": _share(1),
    **{f"avg_{c}": S.avg(c, 1) for c in ("bmi", "age", "glucose", "blood_pressure")}, "diabetic_patients": S.cnt(SICK),
    "diabetes_rate": S.rate(SICK, 1), "high_risk_patients": S.cnt(HIGH), "high_risk_rate": S.rate(HIGH, 1),
    "avg_metabolic_risk": S.avg("metabolic_syndrome_risk", 3), "avg_cardiovascular_risk": S.avg("cardiovascular_risk", 3),
    "avg_lifestyle_risk": S.avg("lifestyle_risk_score", 3),
    "lifestyle_recommendation": f"CASE WHEN contains(bmi_category, 'Underweight') THEN {S.q(_L['underweight'])} WHEN bmi_category = 'Normal Weight'"
    f" THEN {S.q(_L['normal'])} WHEN bmi_category = 'Overweight' THEN {S.q(_L['overweight'])} WHEN contains(bmi_category, 'Obese') THEN"
    f" {S.q(_L['obese'])} ELSE {S.q(_L['default'])} END"}, _since(30), S.WITH_GOLD))
def _(t):
    return reports.bmi_lifestyle_analysis(t.gold, EARLY)


@query("v31_prediction_accuracy_analysis", S.WITH_GOLD + ", g AS (" + S.select({
    "prediction": "prediction", "actual_outcome": "diabetes", "case_count": S.cnt(),
    "avg_prediction_probability": S.avg("prediction_probability", 3), "avg_risk_score": S.avg("risk_score", 3),
    "avg_glucose": S.avg("glucose", 1), "avg_bmi": S.avg("bmi", 1)}, _since(30), ["prediction", "actual_outcome"]) + "), m AS (SELECT "
    + ", ".join(f"CAST(COALESCE(SUM(case_count) FILTER (WHERE prediction = {p} AND actual_outcome = {a}), 0) AS BIGINT) AS {k}" for k, p, a in (
        ("true_positive", 1, 1), ("true_negative", 0, 0), ("false_positive", 1, 0), ("false_negative", 0, 1)))
    + ", CAST(SUM(case_count) AS BIGINT) AS total_cases FROM g) SELECT g.*, m.*, "
    + S.pct("true_positive + true_negative", "total_cases", 2) + " AS accuracy_percentage, "
    + S.pct("true_positive", "true_positive + false_negative", 2) + " AS sensitivity_recall, "
    + S.pct("true_positive", "true_positive + false_positive", 2) + " AS precision, "
    + S.pct("true_negative", "true_negative + false_positive", 2) + " AS specificity FROM g, m")
def _(t):
    return reports.prediction_accuracy_analysis(t.gold, EARLY)


_ADVICE = S.lookup("intervention_priority", R.PRIORITY_TEXT, R.PRIORITY_TEXT_OTHER)


@query("v32_treatment_intervention_analysis", S.report({k: k for k in ("intervention_priority", "followup_frequency")}, {
    "patient_count": S.cnt(), "distribution_percentage": _share(1), "referral_needed": S.cnt("specialist_referral_needed"),
    "referral_rate": S.rate("specialist_referral_needed", 1), "avg_risk_score": S.avg("risk_score", 3), "avg_glucose": S.avg("glucose", 1),
    "avg_bmi": S.avg("bmi", 1), "estimated_total_cost": _COST, "avg_cost_per_patient": "CAST(SUM(annual_cost) // COUNT(*) AS DOUBLE)",
    "clinical_recommendations": f"string_agg(DISTINCT {_ADVICE}, '; ')"}, _since(30), S.WITH_GOLD))
def _(t):
    return reports.treatment_intervention_analysis(t.gold, EARLY)


_OVER = "OVER (ORDER BY processing_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"


def _ma(x: str, n: int) -> str:
    return S.r(f"AVG({x}) {_OVER}", n)


def _trend(x: str) -> str:
    lag = f"LAG({x}) OVER (ORDER BY processing_date)"
    return f"CASE WHEN {x} > {lag} THEN 'Increasing' WHEN {x} < {lag} THEN 'Decreasing' ELSE 'Stable' END"


@query("v33_trends_timeseries", S.WITH_GOLD + ", d AS (" + S.select({
    "processing_date": "processing_date", "daily_patients": S.cnt(), "daily_diabetic_cases": S.cnt(SICK),
    "daily_avg_glucose": S.avg("glucose", 1), "daily_avg_bmi": S.avg("bmi", 1), "daily_avg_risk": S.avg("risk_score", 3),
    "daily_high_risk": S.cnt(HIGH), "daily_immediate_care": _prio("Immediate")}, _since(30), ["processing_date"])
    + "), m AS (SELECT *, " + S.pct("daily_diabetic_cases", "daily_patients", 1) + " AS daily_diabetes_rate, "
    + f"{_ma('daily_avg_glucose', 1)} AS glucose_7day_ma, {_ma('daily_avg_bmi', 1)} AS bmi_7day_ma, {_ma('daily_avg_risk', 3)}"
    f" AS risk_7day_ma, {_ma('daily_diabetic_cases * 1e2 / daily_patients', 1)} AS diabetes_rate_7day_ma FROM d) SELECT *, "
    + f"{_trend('glucose_7day_ma')} AS glucose_trend, {_trend('risk_7day_ma')} AS risk_trend FROM m")
def _(t):
    return reports.trends_timeseries(t.gold, EARLY)


@query("v34_feature_importance_analysis", S.rows("feature_name", {
    c: {"mean_value": S.avg(c, 1), "std_value": S.sd(c, 1), "min_value": f"CAST(MIN({c}) AS DOUBLE)", "max_value": f"CAST(MAX({c}) AS DOUBLE)",
        "null_count": S.cnt(f"{c} IS NULL"), "total_count": S.cnt(), "null_percentage": S.rate(f"{c} IS NULL", 1),
        "diabetes_correlation": S.corr(c, "diabetes", 3), "clinical_significance": S.q(text)} for c, text in R.SIGNIFICANCE_TEXT.items()},
    _since(30), S.WITH_GOLD))
def _(t):
    return reports.feature_importance_analysis(t.gold, EARLY)


@query("v35_data_quality_monitoring", S.WITH_GOLD + ", d AS (" + S.select({
    "processing_date": "processing_date", "total_records": S.cnt(), "avg_quality_score": S.avg("quality_score", 3),
    "low_quality_records": S.cnt("quality_score < 0.8"), "low_quality_percentage": S.rate("quality_score < 0.8", 1),
    "records_with_anomalies": S.cnt(S.ANY_ANOMALY), "anomaly_percentage": S.rate(S.ANY_ANOMALY, 1),
    **{f"{x}_count": S.cnt(f"a_{x}") for x in ("zero_glucose", "extreme_glucose", "zero_bmi", "extreme_bmi")}}, _since(30),
    ["processing_date"]) + ") SELECT *, CASE WHEN avg_quality_score >= 0.95 THEN 'Excellent' WHEN avg_quality_score >= 0.85 THEN 'Good'"
    " WHEN avg_quality_score >= 0.7 THEN 'Acceptable' ELSE 'Needs Improvement' END AS quality_rating, CASE WHEN low_quality_percentage > 20"
    " THEN 'High' WHEN low_quality_percentage > 10 THEN 'Medium' ELSE 'Low' END AS data_quality_risk FROM d")
def _(t):
    return reports.data_quality_monitoring(t.gold, EARLY)


@query("v36_population_health_dashboard", S.WITH_GOLD + ", p AS (" + S.select({
    "total_population": S.cnt(), "diabetic_population": S.cnt(SICK), "diabetes_prevalence_rate": S.rate(SICK, 1),
    "prediabetic_population": S.cnt(PREVENT), "prediabetes_prevalence_rate": S.rate(PREVENT, 1), "high_risk_population": S.cnt(HIGH),
    "high_risk_prevalence_rate": S.rate(HIGH, 1), "immediate_intervention_needed": _prio("Immediate"),
    "specialist_referrals_needed": S.cnt("specialist_referral_needed"), "population_avg_risk": S.avg("risk_score", 3),
    "population_avg_glucose": S.avg("glucose", 1), "population_avg_bmi": S.avg("bmi", 1),
    "population_metabolic_risk": S.avg("metabolic_syndrome_risk", 3), "population_cardiovascular_risk": S.avg("cardiovascular_risk", 3),
    "total_estimated_cost": _COST, "preventable_cost": _SAVE, "avg_cost_per_person": "CAST(SUM(annual_cost) // COUNT(*) AS DOUBLE)",
    "cost_prevention_potential": S.pct(_SAVE, _COST, 1)}, _since(7)) + ") SELECT *, "
    + S.ladder("population_avg_risk", R.POPULATION_RISK) + " AS population_risk_category FROM p")
def _(t):
    return reports.population_health_dashboard(t.gold, EARLY)


# ---- lake views ------------------------------------------------------------
@query("v54_health_summary_by_demographics", S.report({k: k for k in ("age_group", "bmi_category")}, {
    "patient_count": S.cnt(), "avg_risk_score": S.avg("risk_score", 6), "diabetes_cases": S.cnt(SICK),
    "diabetes_rate_percent": S.rate(SICK, 2), "immediate_intervention_needed": _prio("Immediate")}, "gold", S.WITH_GOLD))
def _(t):
    return reports.health_summary_by_demographics(t.gold)


PERFORMANCE = (S.WITH_GOLD + ", perf AS (" + S.select({
    "model_id": "pregnancies_category", "evaluation_date": "CAST(date_trunc('month', processed_timestamp) AS DATE)",
    "accuracy": S.r("COUNT(*) FILTER (WHERE prediction = diabetes) / COUNT(*)", 6),
    "f1_score": S.r(f"2 * {S.cnt(_TP)} / NULLIF(2 * {S.cnt(_TP)} + {S.cnt(_FP)} + {S.cnt(_FN)}, 0)", 6), "test_samples": S.cnt()},
    "gold", ["model_id", "evaluation_date"]) + ") ")


@query("v55_model_performance_trends", PERFORMANCE + ", l AS (SELECT *, LAG(accuracy) OVER (PARTITION BY model_id ORDER BY evaluation_date)"
       " AS prev_accuracy FROM perf) SELECT evaluation_date AS eval_date, model_id, accuracy, f1_score, test_samples, prev_accuracy, "
       + S.r("accuracy - prev_accuracy", 6) + " AS accuracy_change FROM l")
def _(t):
    return reports.model_performance_trends(samples.model_performance(t.gold))


@query("v58_model_monitor", PERFORMANCE + "SELECT model_id, COUNT(*) AS evaluation_count, " + S.avg("accuracy", 6)
       + " AS avg_accuracy, MAX(evaluation_date) AS latest_evaluation FROM perf GROUP BY model_id")
def _(t):
    return report(samples.model_performance(t.gold), ["model_id"], {
        "evaluation_count": n(), "avg_accuracy": mean("accuracy", 6), "latest_evaluation": F.max("evaluation_date")})


for _name, _report in (("v27_clinical_risk_distribution", reports.clinical_risk_distribution), ("v33_trends_timeseries", reports.trends_timeseries),
                       ("v36_population_health_dashboard", reports.population_health_dashboard)):
    cut(_name, _report, MIDDLE)
