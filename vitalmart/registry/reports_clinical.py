"""Reports on the feature, category, raw and wearable tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from vitalmart.functions.bands import band
from vitalmart.functions.numeric import rnd
from vitalmart.operators.aggregate import most_common, value_distribution
from vitalmart.plans import daily, jobs, reports, samples
from vitalmart.rules import clinical as R
from vitalmart.sources.writers import staged

from . import sql as S
from .base import query

C = F.col
SICK = "outcome = 1"


def _text(x: str, digits: int) -> str:
    return f"printf('%.{digits}f', {S.r(x, digits)})"


# ---- compact feature table -------------------------------------------------
def _cohort(key_name: str, key: str, averages: list[str]) -> str:
    return S.report({key_name: key}, {
        "total_count": S.cnt(), "diabetic_count": S.cnt(SICK), "diabetes_rate": S.rate(SICK, 2),
        **{f"avg_{c}": S.avg(c, 2) for c in averages}}, "features", S.WITH_FEATURES)


@query("v1_daily_stats", S.report({"date": "processing_date"}, {
    "total_records": S.cnt(), "diabetic_count": S.cnt(SICK), "non_diabetic_count": S.cnt("outcome = 0"),
    **{f"avg_{c}": S.avg(c, 2) for c in ("glucose", "bmi", "age", "risk_score")}, "high_risk_count": S.cnt("high_risk_flag")},
    "features", S.WITH_FEATURES))
def _(t):
    return reports.daily_stats(t.features)


@query("v2_age_group_analysis", _cohort("age_group", "age_group", ["glucose", "bmi", "risk_score"]))
def _(t):
    return reports.age_group_analysis(t.features)


@query("v3_bmi_category_analysis", _cohort("bmi_category", "bmi_category", ["glucose", "age"]))
def _(t):
    return reports.bmi_category_analysis(t.features)


@query("v4_risk_analysis", _cohort("risk_category", S.ladder("risk_score", R.RISK_THREE_TEXT), ["glucose", "bmi", "age"]))
def _(t):
    return reports.risk_analysis(t.features)


@query("v5_latest_metrics", S.rows("metric_name", {
    "total_records": {"metric_value": "CAST(COUNT(*) AS VARCHAR)"},
    "diabetic_count": {"metric_value": f"CAST({S.cnt(SICK)} AS VARCHAR)"},
    "avg_glucose": {"metric_value": _text("AVG(glucose)", 2)}, "avg_bmi": {"metric_value": _text("AVG(bmi)", 2)},
    "high_risk_count": {"metric_value": f"CAST({S.cnt('high_risk_flag')} AS VARCHAR)"}}, "features", S.WITH_FEATURES))
def _(t):
    return reports.latest_metrics(t.features)


# ---- categorised silver table ----------------------------------------------
@query("v12_executive_kpis", S.rows("metric_name", {
    "total_patients": {"metric_value": "CAST(COUNT(*) AS VARCHAR)", "description": "'Total Patients in Database'"},
    "diabetic_rate": {"metric_value": _text("AVG(outcome) * 1e2", 2) + " || '%'", "description": "'Overall Diabetes Rate'"},
    "high_risk_patients": {"metric_value": "CAST(COUNT(*) FILTER (WHERE risk_category = 'High') AS VARCHAR)",
                           "description": "'High Risk Patients'"},
    "avg_glucose": {"metric_value": _text("AVG(glucose)", 1) + " || ' mg/dL'", "description": "'Average Glucose Level'"},
    "avg_bmi": {"metric_value": _text("AVG(bmi)", 1), "description": "'Average BMI'"}}, "categories", S.WITH_CATEGORIES))
def _(t):
    return reports.executive_kpis(t.categories)


@query("v13_daily_trend_analysis", S.WITH_CATEGORIES + ", d AS (SELECT processing_date AS time, COUNT(*) AS n, "
       + S.cnt(SICK) + " AS s FROM categories GROUP BY 1) SELECT time, 'total_patients' AS metric, CAST(n AS DOUBLE) AS value FROM d"
       " UNION ALL SELECT time, 'diabetic_patients', CAST(s AS DOUBLE) FROM d UNION ALL SELECT time, 'diabetic_rate_pct', "
       + S.r(S.r("s / n", 6) + " * 1e2", 2) + " FROM d")
def _(t):
    return reports.daily_trend_analysis(daily.outcome_stats().full(t.categories))


@query("v14_risk_distribution", S.report({"category": "risk_category"}, {
    "patient_count": S.cnt(), "percentage": S.pct("COUNT(*)", "SUM(COUNT(*)) OVER ()", 2)}, "categories", S.WITH_CATEGORIES))
def _(t):
    return reports.risk_distribution(t.categories)


@query("v15_demographic_analysis", S.report({"age_group": "age_group", "bmi_category": "bmi_category"}, {
    "total_patients": S.cnt(), "diabetic_patients": S.cnt(SICK), "diabetic_rate_pct": S.r("AVG(outcome) * 1e2", 2),
    "avg_glucose": S.avg("glucose", 1), "avg_bmi": S.avg("bmi", 1)}, "categories", S.WITH_CATEGORIES))
def _(t):
    return reports.demographic_analysis(t.categories)


@query("v16_glucose_distribution", S.report({"category": "glucose_category"}, {
    "patient_count": S.cnt(), "percentage": S.pct("COUNT(*)", "SUM(COUNT(*)) OVER ()", 2),
    "diabetic_rate_pct": S.r("AVG(outcome) * 1e2", 2)}, "categories", S.WITH_CATEGORIES))
def _(t):
    return reports.glucose_distribution(t.categories)


PREDICTIONS = (", predictions AS (SELECT id AS patient_id, 'threshold_rules' AS model_name, 'v' || CAST(pregnancies % 3 AS VARCHAR)"
               " AS model_version, prediction_probability, prediction AS prediction_binary, abs(prediction_probability - 0.5e0) * 2e0"
               " AS confidence_score FROM gold) ")


@query("v17_model_performance_summary", S.WITH_GOLD.rstrip() + PREDICTIONS + S.report(
    {"model_name": "model_name", "model_version": "model_version"}, {
        "total_predictions": S.cnt(), "avg_prediction_prob": S.avg("prediction_probability", 4),
        "predicted_diabetic": S.cnt("prediction_binary = 1"), "predicted_diabetic_rate": S.rate("prediction_binary = 1", 2),
        "avg_confidence": S.avg("confidence_score", 3)}, "predictions"))
def _(t):
    return reports.model_performance_summary(samples.predictions(t.gold))


def _bad(c: str) -> str:
    return S.cnt(f"{c} IS NULL OR {c} <= 0")


@query("v18_data_quality_summary", S.WITH_CATEGORIES + "SELECT 'bronze' AS table_name, COUNT(*) AS total_records, "
       + ", ".join(f"{_bad(c)} AS invalid_{c}" for c in ("glucose", "bmi", "age"))
       + ", CAST(NULL AS DOUBLE) AS avg_quality_score FROM clinical UNION ALL SELECT 'silver', COUNT(*), 0, 0, 0, "
       + S.avg("data_quality_score", 3) + " FROM categories")
def _(t):
    return reports.data_quality_summary(t.clinical, t.categories)


@query("v19_available_dates", S.WITH_CLINICAL + "SELECT DISTINCT processing_date AS value FROM clinical")
def _(t):
    return reports.distinct_values(t.clinical, "processing_date")


@query("v19_risk_categories", S.WITH_CATEGORIES + "SELECT DISTINCT risk_category AS value, CAST(CASE risk_category WHEN 'High' THEN 1"
       " WHEN 'Medium' THEN 2 WHEN 'Low' THEN 3 ELSE 4 END AS BIGINT) AS position FROM categories")
def _(t):
    return reports.distinct_values(t.categories, "risk_category", R.CATEGORY_ORDER)


@query("v19_age_groups", S.WITH_CATEGORIES + "SELECT DISTINCT age_group AS value, CAST(CASE " + " ".join(
    f"WHEN age_group = {S.q(v)} THEN {i}" for i, v in enumerate(R.AGE_RANGES.labels, 1)) + " ELSE 5 END AS BIGINT) AS position FROM categories")
def _(t):
    return reports.distinct_values(t.categories, "age_group", list(R.AGE_RANGES.labels))


# ---- logs and checks -------------------------------------------------------
# the run log: one run per user and day, derived from the event stream
RUNS = """runs AS (
  SELECT CASE event_type WHEN 'click' THEN 'bronze_to_silver' WHEN 'view' THEN 'silver_to_gold' ELSE 'analytics_refresh' END AS stage,
         event_type, user_id, CAST(ts AS DATE) AS day, MIN(ts) AS start_time, MAX(ts) AS end_time, COUNT(*) AS records_processed,
         COUNT(*) FILTER (WHERE event_type = 'error') AS records_failed
  FROM events GROUP BY 1, 2, 3, 4)"""
JOBS = ("WITH " + RUNS + ", jobs AS (SELECT *, stage AS job_type, CASE WHEN records_failed > 0 THEN 'ERROR' ELSE 'SUCCESS' END AS status,"
        " (epoch_us(end_time) - epoch_us(start_time)) / 1e6 AS duration_seconds FROM runs) ")


@query("v56_etl_job_summary", JOBS + "SELECT job_type, status, COUNT(*) AS job_count, " + S.avg("duration_seconds", 6)
       + " AS avg_duration_seconds, strftime(MAX(end_time), '%Y-%m-%d %H:%M:%S') AS last_execution, CAST(SUM(records_processed) AS BIGINT)"
       " AS total_records_processed, CAST(SUM(records_failed) AS BIGINT) AS total_records_failed FROM jobs"
       " WHERE start_time >= CAST(DATE '2024-01-08' - 7 AS TIMESTAMP) GROUP BY job_type, status")
def _(t):
    return reports.etl_job_summary(samples.run_log(t.events), dt.date(2024, 1, 8))


_CHECKS = ("WITH c AS (SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS check_timestamp, event_type AS table_name, COUNT(*) AS row_count, "
           + S.avg("value", 4) + " AS avg_value FROM events GROUP BY 1, 2), l AS (SELECT *, 'row_count' AS metric_name, CAST(row_count AS DOUBLE)"
           " AS metric_value, 70e0 AS threshold_value FROM c UNION ALL SELECT *, 'avg_value', avg_value, 49e0 FROM c) ")


@query("v56_data_quality_dashboard", _CHECKS + "SELECT 'events' AS schema_name, table_name, metric_name, metric_value, threshold_value,"
       " CASE WHEN metric_name LIKE '%\\_count' ESCAPE '\\' THEN metric_value <= threshold_value ELSE metric_value >= threshold_value END"
       " AS is_passed, strftime(check_timestamp, '%Y-%m-%d %H:%M:%S') AS check_timestamp, CASE WHEN CASE WHEN metric_name LIKE '%\\_count'"
       " ESCAPE '\\' THEN metric_value <= threshold_value ELSE metric_value >= threshold_value END THEN 'PASS' ELSE 'FAIL' END AS status"
       " FROM l WHERE check_timestamp >= CAST(DATE '2024-01-02' - 1 AS TIMESTAMP)")
def _(t):
    out = reports.data_quality_dashboard(samples.event_checks(t.events, {"row_count": 70.0, "avg_value": 49.0}), dt.date(2024, 1, 2))
    return out.withColumn("check_timestamp", F.date_format("check_timestamp", "yyyy-MM-dd HH:mm:ss"))


@query("v56_system_health", "SELECT event_type AS metric_type, " + S.avg("value", 6) + " AS avg_value, MAX(value) AS max_value, MIN(value)"
       " AS min_value, COUNT(*) AS measurement_count, strftime(MAX(ts), '%Y-%m-%d %H:%M:%S') AS last_recorded FROM events"
       " WHERE ts >= TIMESTAMP '2024-01-01 01:00:00' - INTERVAL 1 HOUR GROUP BY event_type")
def _(t):
    rows = t.events.select(C("event_type").alias("metric_type"), C("value").alias("metric_value"), C("ts").alias("recorded_at"))
    return reports.resource_health(rows, dt.datetime(2024, 1, 1, 1))


# ---- raw table -------------------------------------------------------------
@query("v57_glucose_bmi_cross", S.report({"glucose_category": S.ladder("glucose", R.GLUCOSE_140),
                                          "bmi_category": S.ladder("bmi", R.BMI_SIMPLE)}, {
    "count": S.cnt(), "diabetic_cases": S.cnt(SICK), "diabetes_rate": S.rate(SICK, 2)},
    "(SELECT * FROM clinical WHERE glucose > 0 AND bmi > 0)", S.WITH_CLINICAL))
def _(t):
    return reports.glucose_bmi_cross(t.clinical)


@query("v57_high_risk_summary", S.WITH_CLINICAL + f"SELECT COUNT(*) AS high_risk_count, {S.cnt(SICK)} AS confirmed_diabetic, "
       f"{S.avg('age', 2)} AS avg_age, {S.avg('pregnancies', 2)} AS avg_pregnancies FROM clinical WHERE glucose > 140 AND bmi > 30")
def _(t):
    return reports.high_risk_summary(t.clinical)


@query("v57_pregnancy_impact", S.report({"pregnancy_group": S.ladder("pregnancies", R.PREGNANCY_GROUPS)}, {
    "total": S.cnt(), "diabetic": S.cnt(SICK), "diabetes_rate": S.rate(SICK, 2)}, "clinical", S.WITH_CLINICAL))
def _(t):
    return reports.pregnancy_impact(t.clinical)


@query("v58_layer_validation", S.WITH_GOLD + "SELECT 'bronze' AS layer, COUNT(*) AS record_count FROM clinical UNION ALL SELECT 'silver',"
       " COUNT(*) FROM silver UNION ALL SELECT 'gold', COUNT(*) FROM gold")
def _(t):
    return reports.layer_counts({"bronze": t.clinical, "silver": t.silver, "gold": t.gold})


@query("v58_feature_coverage", S.WITH_GOLD + "SELECT COUNT(*) AS total_records, COUNT(glucose_bmi_interaction) AS interaction_features,"
       " COUNT(health_risk_level) AS risk_assessments, COUNT(treatment_recommendation) AS recommendations FROM gold")
def _(t):
    return reports.feature_coverage(t.gold)


# ---- wearable --------------------------------------------------------------
# fences of the approximate quartiles never cut between 55..99 and the 230 spikes, so exact ones select the same rows
CLEAN_WEARABLE = S.WITH_WEARABLE.rstrip() + """, f AS (
  SELECT quantile_disc(heart_rate, 0.25) AS q1, quantile_disc(heart_rate, 0.75) AS q3 FROM wearable),
b AS (SELECT * REPLACE (CASE WHEN heart_rate < q1 - 1.5e0 * (q3 - q1) OR heart_rate > q3 + 1.5e0 * (q3 - q1) THEN NULL
        ELSE heart_rate END AS heart_rate) FROM wearable, f),
m AS (SELECT AVG(heart_rate) AS hr, AVG(health_score) AS hs FROM b),
people AS (SELECT person_id, age, height, weight, sleep_duration, steps_daily,
   CASE trim(lower(gender)) WHEN 'male' THEN 'Male' WHEN 'female' THEN 'Female' ELSE 'Other' END AS gender,
   CASE WHEN trim(lower(medical_conditions)) <> 'none' THEN medical_conditions END AS medical_conditions,
   COALESCE(heart_rate, hr) AS heart_rate, COALESCE(health_score, hs) AS health_score,
   CASE WHEN health_score >= 80 THEN 'Low_Risk' WHEN health_score >= 60 THEN 'Medium_Risk' WHEN health_score >= 40 THEN 'High_Risk'
        ELSE 'Critical_Risk' END AS health_risk_category,
   COALESCE(stress_level, 'Unknown') AS stress_level, COALESCE(mood, 'Unknown') AS mood,
   CAST(ROUND(CAST(weight / ((height / 100e0) * (height / 100e0)) AS DECIMAL(28,12)), 2) AS DOUBLE) AS bmi_calculated,
   CAST(ROUND(CAST((deep_sleep_duration + rem_sleep_duration) / sleep_duration * 100e0 AS DECIMAL(28,12)), 2) AS DOUBLE)
     AS sleep_efficiency, strptime("timestamp", '%Y-%m-%d %H:%M:%S') AS timestamp_parsed
   FROM b, m) """


_RISKY = "health_risk_category IN ('High_Risk', 'Critical_Risk')"


@query("v60_wearable_insights", CLEAN_WEARABLE + S.report({"gender": "gender", "health_risk_category": "health_risk_category"}, {
    "total_population": S.cnt(), "avg_health_score": S.avg("health_score", 2), "avg_heart_rate": S.avg("heart_rate", 2),
    "avg_sleep_efficiency": S.avg("sleep_efficiency", 2), "avg_steps_daily": S.avg("steps_daily", 2),
    "stddev_heart_rate": S.sd("heart_rate", 2), "avg_bmi": S.avg("bmi_calculated", 2), "high_risk_count": S.cnt(_RISKY),
    "high_risk_percentage": S.rate(_RISKY, 2), "median_heart_rate": S.r("quantile_cont(heart_rate, 0.5)", 6)}, "people"))
def _(t):
    people = staged(jobs.clean_wearable(t.wearable), "wearable")  # read three times
    out = reports.wearable_insights(people, ["gender", "health_risk_category"])
    return out.withColumn("median_heart_rate", rnd("median_heart_rate", 6))


@query("v60_distribution_maps", CLEAN_WEARABLE + "SELECT gender, string_agg(stress_level || '=' || CAST(c AS VARCHAR), ',' ORDER BY stress_level)"
       " AS stress_distribution FROM (SELECT gender, stress_level, COUNT(*) AS c FROM people GROUP BY ALL) GROUP BY gender")
def _(t):
    m = value_distribution(jobs.clean_wearable(t.wearable), ["gender"], "stress_level", "m")
    pairs = F.transform(F.map_entries("m"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")))
    return m.select("gender", F.array_join(pairs, ",").alias("stress_distribution"))


@query("v60_common_condition", CLEAN_WEARABLE + ", c AS (SELECT health_risk_category, mood, COUNT(*) AS k FROM people GROUP BY ALL),"
       " r AS (SELECT *, row_number() OVER (PARTITION BY health_risk_category ORDER BY k DESC, mood) AS rn FROM c)"
       " SELECT health_risk_category, mood AS common_mood FROM r WHERE rn = 1")
def _(t):
    return most_common(jobs.clean_wearable(t.wearable), ["health_risk_category"], "mood", "common_mood")


@query("v60_period_trends", CLEAN_WEARABLE + ", p AS (SELECT CAST(date_trunc('year', timestamp_parsed) AS DATE) AS period_start, "
       + S.ladder("age", R.AGE_THREE) + " AS age_group, gender, COUNT(*) AS total_population, " + S.avg("health_score", 2)
       + " AS avg_health_score FROM people GROUP BY ALL), l AS (SELECT *, LAG(avg_health_score) OVER (PARTITION BY age_group, gender"
       " ORDER BY period_start) AS prev_health_score FROM p) SELECT *, " + S.r("avg_health_score - prev_health_score", 2)
       + " AS health_score_change, CASE WHEN avg_health_score > prev_health_score THEN 'Increasing' WHEN avg_health_score <"
       " prev_health_score THEN 'Decreasing' ELSE 'Stable' END AS health_trend FROM l")
def _(t):
    people = jobs.clean_wearable(t.wearable).withColumn("age_group", band("age", R.AGE_THREE))
    return reports.wearable_period_trends(people, F.date_trunc("year", "timestamp_parsed").cast("date"), ["age_group", "gender"])
