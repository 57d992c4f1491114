"""Reporting views over the gold layer.

Each function takes the table(s) it reports on and, where the view looks back in
time, the report time ``as_of``; none reads the clock. Sorting, shares and
windows run on report rows (one per group), never on detail rows.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitalmart.functions.bands import band, first_match, order_rank, recode
from vitalmart.functions.numeric import pct, ratio, rnd
from vitalmart.operators.aggregate import (confusion_counts, corr, joined_labels, mean, mean_if,
                                           metric_rows, n, n_if, rate, report, sd, struct_rows,
                                           text_number, total)
from vitalmart.operators.quantiles import exact_percentiles
from vitalmart.operators.windows import previous, trailing_mean, trend_label
from vitalmart.rules import clinical as R

from . import daily
from .layers import annual_cost, has_anomaly

C = F.col


def sick() -> Column:
    return C("diabetes") == 1


def high_risk() -> Column:
    return C("health_risk_level").isin("High", "Critical")


def preventable() -> Column:
    return (C("diabetes") == 0) & (C("glucose_category") == "Prediabetic")


def level(name: str) -> Column:
    return C("health_risk_level") == name


def urgent(name: str = "Immediate") -> Column:
    return C("intervention_priority") == name


def cost_is(name: str) -> Column:
    return C("estimated_cost_category") == name


def recent(df: DataFrame, as_of: date, days: int, column: str = "processing_date") -> DataFrame:
    """Rows of the last ``days`` days before ``as_of``, and anything later."""
    return df.where(C(column) >= F.date_sub(F.lit(as_of), days))


def within(df: DataFrame, as_of: datetime, column: str = "processed_timestamp", **span: int) -> DataFrame:
    """Rows newer than ``as_of`` minus the span."""
    return df.where(C(column) > _at(as_of, **span))


def _at(as_of: datetime, **ago: int) -> Column:
    t = F.lit(as_of).cast("timestamp_ntz")
    if not ago:
        return t
    return t - F.make_dt_interval(days=F.lit(ago.get("days", 0) + 7 * ago.get("weeks", 0)),
                                  hours=F.lit(ago.get("hours", 0)), mins=F.lit(ago.get("minutes", 0)))


def seconds_between(later: Column, earlier: Column) -> Column:
    micros = F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))
    return micros / F.lit(1e6)


def day_of(ts: str) -> Column:
    return C(ts).cast("date")


def period_of(unit: str, ts: str) -> Column:
    return F.date_trunc(unit, C(ts)).cast("date")


def hour_text(ts: str) -> Column:
    return F.date_format(F.date_trunc("hour", C(ts)), "yyyy-MM-dd HH:mm:ss")


# ---- compact feature table -------------------------------------------------
def daily_stats(features: DataFrame, day: str = "processing_date") -> DataFrame:
    return daily.daily_stats(day).full(features).orderBy(C("date").desc())


def _cohort(features: DataFrame, keys, averages: list[str]) -> DataFrame:
    sick = C("outcome") == 1
    return report(features, keys, {"total_count": n(), "diabetic_count": n_if(sick), "diabetes_rate": rate(sick, 2),
                                   **{f"avg_{c}": mean(c, 2) for c in averages}})


def age_group_analysis(features: DataFrame) -> DataFrame:
    return _cohort(features, ["age_group"], ["glucose", "bmi", "risk_score"]).orderBy("age_group")


def bmi_category_analysis(features: DataFrame) -> DataFrame:
    return _cohort(features, ["bmi_category"], ["glucose", "age"]).orderBy(C("diabetes_rate").desc())


def risk_analysis(features: DataFrame) -> DataFrame:
    keys = {"risk_category": band("risk_score", R.RISK_THREE_TEXT)}
    return _cohort(features, keys, ["glucose", "bmi", "age"]).orderBy(C("diabetes_rate").desc())


def latest_metrics(features: DataFrame) -> DataFrame:
    return metric_rows(features, {
        "total_records": n(), "diabetic_count": n_if(C("outcome") == 1),
        "avg_glucose": text_number(F.avg("glucose"), 2), "avg_bmi": text_number(F.avg("bmi"), 2),
        "high_risk_count": n_if(C("high_risk_flag"))}, as_text=True)


# ---- gold: daily, level and priority ---------------------------------------
def enhanced_daily_stats(gold: DataFrame) -> DataFrame:
    return daily.enhanced_daily_stats().full(gold).orderBy(C("date").desc())


def risk_level_analysis(gold: DataFrame) -> DataFrame:
    return report(gold, ["health_risk_level"], {
        "patient_count": n(), "diabetic_count": n_if(sick()), "diabetes_rate": rate(sick(), 2),
        **{f"avg_{c}": mean(c, 2) for c in ("glucose", "bmi", "age", "risk_score")},
        "avg_prediction_confidence": mean("prediction_probability", 2)},
        {"percentage": ("patient_count", 2)}).orderBy(order_rank("health_risk_level", R.RISK_ORDER))


def intervention_priority_analysis(gold: DataFrame) -> DataFrame:
    return report(gold, ["intervention_priority"], {
        "patient_count": n(), "diabetic_count": n_if(sick()), "avg_risk_score": mean("risk_score", 2),
        "avg_prediction_confidence": mean("prediction_probability", 2),
        "cost_categories": joined_labels("estimated_cost_category", ", ")},
        {"percentage": ("patient_count", 2)}).orderBy(order_rank("intervention_priority", R.PRIORITY_ORDER))


def feature_correlation_insights(gold: DataFrame) -> DataFrame:
    pairs = {"Glucose-BMI Interaction": "glucose_bmi_interaction", "Age-Glucose Interaction": "age_glucose_interaction",
             "Insulin-Glucose Interaction": "insulin_glucose_interaction"}
    return struct_rows(gold, {
        label: {"avg_interaction": mean(c, 4), "correlation_with_diabetes": corr(c, "diabetes", 4)}
        for label, c in pairs.items()}, "feature_pair")


def model_performance_tracking(registry: DataFrame, as_of: date) -> DataFrame:
    return (registry.where(C("model_status") == "Active")
            .withColumn("days_since_deployment", F.datediff(F.lit(as_of), C("deployment_date")).cast("bigint"))
            .orderBy(C("deployment_date").desc()))


def latest_comprehensive_metrics(gold: DataFrame) -> DataFrame:
    kinds = {"total_patients": "count", "diabetic_patients": "count", "high_risk_patients": "count",
             "immediate_interventions": "count", "avg_prediction_confidence": "percentage", "avg_data_quality": "score"}
    rows = metric_rows(gold, {
        "total_patients": n(), "diabetic_patients": n_if(sick()), "high_risk_patients": n_if(high_risk()),
        "immediate_interventions": n_if(urgent()),
        "avg_prediction_confidence": text_number(F.avg("prediction_probability"), 3),
        "avg_data_quality": text_number(F.avg("quality_score"), 3)}, as_text=True)
    return rows.withColumn("metric_type", recode("metric_name", kinds))


# ---- categorised silver table ----------------------------------------------
def executive_kpis(silver: DataFrame) -> DataFrame:
    text = {"total_patients": "Total Patients in Database", "diabetic_rate": "Overall Diabetes Rate",
            "high_risk_patients": "High Risk Patients", "avg_glucose": "Average Glucose Level",
            "avg_bmi": "Average BMI"}
    rows = metric_rows(silver, {
        "total_patients": n(),
        "diabetic_rate": F.concat(text_number(F.avg("outcome") * 100, 2), F.lit("%")),
        "high_risk_patients": n_if(C("risk_category") == "High"),
        "avg_glucose": F.concat(text_number(F.avg("glucose"), 1), F.lit(" mg/dL")),
        "avg_bmi": text_number(F.avg("bmi"), 1)}, as_text=True)
    return rows.withColumn("description", recode("metric_name", text))


def daily_trend_analysis(daily: DataFrame) -> DataFrame:
    """Daily rows turned into (time, metric, value)."""
    wide = daily.select(C("date_key").alias("time"), C("total_patients").cast("double").alias("total_patients"),
                        C("diabetic_patients").cast("double").alias("diabetic_patients"),
                        rnd(C("diabetic_rate") * 100, 2).alias("diabetic_rate_pct"))
    return wide.unpivot(["time"], ["total_patients", "diabetic_patients", "diabetic_rate_pct"], "metric", "value").orderBy(
        C("time").desc())


def risk_distribution(silver: DataFrame) -> DataFrame:
    return report(silver, {"category": "risk_category"}, {"patient_count": n()}, {"percentage": ("patient_count", 2)})


def demographic_analysis(silver: DataFrame) -> DataFrame:
    return report(silver, ["age_group", "bmi_category"], {
        "total_patients": n(), "diabetic_patients": n_if(C("outcome") == 1),
        "diabetic_rate_pct": rnd(F.avg("outcome") * 100, 2), "avg_glucose": mean("glucose", 1),
        "avg_bmi": mean("bmi", 1)}).orderBy("age_group", "bmi_category")


def glucose_distribution(silver: DataFrame) -> DataFrame:
    return report(silver, {"category": "glucose_category"}, {
        "patient_count": n(), "diabetic_rate_pct": rnd(F.avg("outcome") * 100, 2)},
        {"percentage": ("patient_count", 2)}).orderBy(order_rank("category", R.GLUCOSE_FOUR_ORDER))


def model_performance_summary(predictions: DataFrame) -> DataFrame:
    hit = C("prediction_binary") == 1
    return report(predictions, ["model_name", "model_version"], {
        "total_predictions": n(), "avg_prediction_prob": mean("prediction_probability", 4),
        "predicted_diabetic": n_if(hit), "predicted_diabetic_rate": rate(hit, 2),
        "avg_confidence": mean("confidence_score", 3)}).orderBy("model_name", "model_version")


def data_quality_summary(bronze: DataFrame, silver: DataFrame) -> DataFrame:
    """Invalid key measures in the raw table, next to the cleaned one."""
    bad = lambda c: n_if(C(c).isNull() | (C(c) <= 0))
    zero = F.lit(0).cast("bigint")
    raw = bronze.agg(n().alias("total_records"), bad("glucose").alias("invalid_glucose"), bad("bmi").alias("invalid_bmi"),
                     bad("age").alias("invalid_age"), F.lit(None).cast("double").alias("avg_quality_score"))
    clean = silver.agg(n().alias("total_records"), zero.alias("invalid_glucose"), zero.alias("invalid_bmi"),
                       zero.alias("invalid_age"), mean("data_quality_score", 3).alias("avg_quality_score"))
    return raw.withColumn("table_name", F.lit("bronze")).unionByName(clean.withColumn("table_name", F.lit("silver")))


def distinct_values(df: DataFrame, column: str, order: list[str] | None = None) -> DataFrame:
    """Values of a category for selection lists, in a custom or natural order."""
    values = df.where(C(column).isNotNull()).select(C(column).alias("value")).distinct()
    if order is None:
        return values.orderBy(C("value").desc())
    return values.withColumn("position", order_rank("value", order).cast("bigint")).orderBy("position", "value")


# ---- gold: advanced analytics ----------------------------------------------
def temporal_health_trends(gold: DataFrame) -> DataFrame:
    """Per week and month."""
    t = "processed_timestamp"
    return report(gold.where(C(t).isNotNull()), {"week_start": period_of("week", t), "month_start": period_of("month", t)}, {
        "total_patients": n(), "diabetes_prevalence_pct": rate(sick(), 2), "avg_risk_score": mean("risk_score", 3),
        "avg_prediction_confidence": mean("prediction_probability", 3), "avg_glucose": mean("glucose", 2),
        "avg_bmi": mean("bmi", 2), "avg_age": mean("age", 1), "avg_blood_pressure": mean("blood_pressure", 2),
        "avg_insulin": mean("insulin", 2),
        **{f"{v.lower()}_risk_count": n_if(level(v)) for v in R.RISK_ORDER},
        **{f"{v.lower()}_interventions": n_if(urgent(v)) for v in ("Immediate", "Soon", "Routine")},
        "avg_data_quality": mean("quality_score", 3),
        "low_quality_records": n_if(C("quality_score") < 0.8)}).orderBy(C("week_start").desc())


def demographic_health_profile(gold: DataFrame) -> DataFrame:
    return report(gold, ["age_group", "bmi_category", "glucose_category"], {
        "population_count": n(), "diabetic_cases": n_if(sick()), "diabetes_rate": rate(sick(), 2),
        "avg_risk_score": mean("risk_score", 3), "risk_score_stddev": sd("risk_score", 3),
        "high_risk_individuals": n_if(C("risk_score") > 0.7),
        **{f"avg_{c}": mean(c, 2) for c in ("glucose", "bmi", "blood_pressure", "insulin")},
        "immediate_care_needed": n_if(urgent()), "soon_care_needed": n_if(urgent("Soon")),
        **{f"{v.lower()}_cost_cases": n_if(cost_is(v)) for v in ("High", "Medium", "Low")},
        "cardiovascular_risk_cases": n_if(C("cardiovascular_risk") > 0.5),
        "metabolic_syndrome_cases": n_if(C("metabolic_syndrome_risk") > 0.5)},
        {"population_percentage": ("population_count", 2)}).orderBy(C("diabetes_rate").desc(), C("population_count").desc())


def model_performance_deep_analysis(gold: DataFrame) -> DataFrame:
    p, yes = C("prediction_probability"), C("prediction") >= 0.5
    well = C("diabetes") == 0
    right = (yes & sick()) | (~yes & well)
    return report(gold.where(p.isNotNull()), {"analysis_date": day_of("processed_timestamp")}, {
        "total_predictions": n(), "avg_confidence": mean(p, 4), "confidence_stddev": sd(p, 4),
        "very_high_confidence": n_if(p >= 0.9), "high_confidence": n_if((p >= 0.7) & (p < 0.9)),
        "medium_confidence": n_if((p >= 0.5) & (p < 0.7)), "low_confidence": n_if(p < 0.5),
        "correct_predictions": n_if(right), "estimated_accuracy": rate(right, 2),
        "false_positives": n_if(yes & well), "false_negatives": n_if(~yes & sick()),
        "true_positives": n_if(yes & sick()), "true_negatives": n_if(~yes & well),
        **{f"{v.lower()}_risk_avg_confidence": mean_if(level(v), p, 4) for v in R.RISK_ORDER},
    }).orderBy(C("analysis_date").desc())


def clinical_feature_insights(gold: DataFrame) -> DataFrame:
    pairs = {"glucose_bmi_correlation": ("glucose", "bmi"), "age_glucose_correlation": ("age", "glucose"),
             "age_bmi_correlation": ("age", "bmi"), "age_diabetes_correlation": ("age", "diabetes"),
             "insulin_glucose_correlation": ("insulin", "glucose"), "bp_bmi_correlation": ("blood_pressure", "bmi"),
             "bp_diabetes_correlation": ("blood_pressure", "diabetes"),
             "pregnancy_diabetes_correlation": ("pregnancies", "diabetes")}
    return gold.where(C("glucose").isNotNull() & C("bmi").isNotNull()).agg(
        F.lit("Feature Interactions").alias("analysis_type"),
        *[corr(a, b, 4).alias(k) for k, (a, b) in pairs.items()],
        *[mean(c, 4).alias(f"avg_{c}") for c in ("glucose_bmi_interaction", "insulin_glucose_interaction",
                                                 "pregnancy_risk_factor")])


def clinical_threshold_analysis(gold: DataFrame) -> DataFrame:
    rows = {}
    for label, c, limit, text in R.CLINICAL_THRESHOLDS:
        above = C(c) >= limit
        rows[label] = {
            "threshold_value": F.lit(limit).cast("bigint"), "population_above_threshold": n_if(above),
            "diabetes_cases_above_threshold": n_if(above & sick()),
            "diabetes_rate_above_threshold": pct(n_if(above & sick()), n_if(above), 2),
            "avg_risk_score_above_threshold": mean_if(above, "risk_score", 3),
            "intervention_recommendations": F.lit(text)}
    return struct_rows(gold, rows, "threshold_type").orderBy(C("diabetes_rate_above_threshold").desc())


def data_quality_comprehensive(gold: DataFrame) -> DataFrame:
    g, b, a = C("glucose"), C("bmi"), C("age")
    p, r = C("prediction_probability"), C("risk_score")
    problems = {
        "Bronze Layer": (g.isNull() | b.isNull() | a.isNull(),
                         (g < 0) | (g > 400) | (b < 10) | (b > 60) | (a < 0) | (a > 120)),
        "Gold Layer": (p.isNull() | r.isNull(), (p < 0) | (p > 1) | (r < 0) | (r > 1))}
    return struct_rows(gold, {
        name: {"total_records": n(), "data_completeness_score": pct(n() - n_if(gap), n(), 2),
               "data_accuracy_score": pct(n() - n_if(wrong), n(), 2),
               "data_consistency_score": F.lit(R.LAYER_CONSISTENCY[name]),
               "overall_quality_score": rnd(F.avg("quality_score") * 100, 2), "quality_issues": n_if(gap | wrong),
               "last_quality_check": F.date_format(F.max("processed_timestamp"), "yyyy-MM-dd HH:mm:ss"),
               "recommendations": F.lit(R.LAYER_ADVICE[name])}
        for name, (gap, wrong) in problems.items()}, "layer_name")


def executive_kpi_dashboard(gold: DataFrame, as_of: date) -> DataFrame:
    """One-row KPIs of the last seven days, with cost estimates."""
    return recent(gold, as_of, 7).agg(
        n().alias("total_patients"), n_if(high_risk()).alias("high_risk_patients"), n_if(urgent()).alias("immediate_care_needed"),
        n_if(preventable()).alias("diabetes_prevention_opportunities"),
        (n_if(preventable()) * F.lit(R.PREVENTION_SAVING)).alias("estimated_cost_savings"),
        total(annual_cost()).alias("estimated_total_cost"),
        rnd(F.avg("risk_score") * 100, 1).alias("population_health_score"),
        pct(n() - n_if(urgent()), n(), 1).alias("system_efficiency_score"),
        rnd(F.avg("quality_score") * 100, 1).alias("data_quality_score"))


def executive_kpi_snapshot(gold: DataFrame) -> DataFrame:
    """One-row KPIs of the whole table, the older definition."""
    cost = sum((n_if(cost_is(k)) * F.lit(v) for k, v in R.KPI_COST.items()), F.lit(0))
    return gold.agg(
        F.lit("Healthcare Impact").alias("kpi_category"), n().alias("total_patients"),
        n_if(high_risk()).alias("high_risk_patients"), n_if(urgent()).alias("immediate_care_needed"),
        n_if((C("diabetes") == 0) & (C("risk_score") > 0.5)).alias("diabetes_prevention_opportunities"),
        cost.alias("estimated_cost_savings"), rnd(F.lit(100.0) - F.avg("risk_score") * 100, 2).alias("population_health_score"),
        rnd(F.avg("prediction_probability") * 100, 2).alias("system_efficiency_score"),
        rnd(F.avg("quality_score") * 100, 2).alias("data_quality_score"),
        F.date_format(F.max("processed_timestamp"), "yyyy-MM-dd HH:mm:ss").alias("last_updated"))


# ---- gold: comprehensive views ---------------------------------------------
def clinical_risk_distribution(gold: DataFrame, as_of: date) -> DataFrame:
    return report(recent(gold, as_of, 30), ["health_risk_level", "intervention_priority"], {
        "patient_count": n(), "avg_risk_score": mean("risk_score", 3),
        **{f"avg_{c}": mean(c, 1) for c in ("glucose", "bmi", "age")},
        "diabetic_patients": n_if(sick()), "diabetes_rate": rate(sick(), 1)}, {"percentage": ("patient_count", 1)}).orderBy(
        order_rank("health_risk_level", R.RISK_ORDER[:3]), order_rank("intervention_priority", R.PRIORITY_ORDER[:3]))


def demographic_health_analysis(gold: DataFrame, as_of: date) -> DataFrame:
    return report(recent(gold, as_of, 30), ["age_group", "bmi_category"], {
        "total_patients": n(), "diabetic_patients": n_if(sick()), "diabetes_prevalence": rate(sick(), 1),
        "high_risk_patients": n_if(high_risk()), "high_risk_prevalence": rate(high_risk(), 1),
        **{f"avg_{c}": mean(c, 1) for c in ("glucose", "bmi", "blood_pressure")},
        "avg_risk_score": mean("risk_score", 3), "avg_metabolic_risk": mean("metabolic_syndrome_risk", 3),
        "avg_cardiovascular_risk": mean("cardiovascular_risk", 3)}).orderBy("age_group", "bmi_category")


def glucose_analysis_trends(gold: DataFrame, as_of: date) -> DataFrame:
    rows = recent(gold, as_of, 30)
    key = "glucose_category"
    base = report(rows, [key], {
        "patient_count": n(), "avg_glucose": mean("glucose", 1), "glucose_stddev": sd("glucose", 1),
        "min_glucose": F.min("glucose"), "max_glucose": F.max("glucose"), "confirmed_diabetic": n_if(sick()),
        "diabetes_confirmation_rate": rate(sick(), 1)}, {"distribution_percentage": ("patient_count", 1)}, {
        "clinical_recommendation": recode(key, R.GLUCOSE_ADVICE, R.GLUCOSE_ADVICE_OTHER)})
    names = {"glucose_q1": 0.25, "glucose_median": 0.5, "glucose_q3": 0.75}
    quartiles = exact_percentiles(rows, [key], "glucose", names).select(
        key, *[rnd(q, 1).alias(q) for q in names])
    return base.join(quartiles, key, "left").orderBy(order_rank(key, R.GLUCOSE_ORDER))


def bmi_lifestyle_analysis(gold: DataFrame, as_of: date) -> DataFrame:
    c, t = C("bmi_category"), R.LIFESTYLE_TEXT
    kinds = [(c.like("%Underweight%"), "underweight"), (c == "Normal Weight", "normal"), (c == "Overweight", "overweight"),
             (c.like("%Obese%"), "obese")]
    return report(recent(gold, as_of, 30), ["bmi_category"], {
        "patient_count": n(), **{f"avg_{x}": mean(x, 1) for x in ("bmi", "age", "glucose", "blood_pressure")},
        "diabetic_patients": n_if(sick()), "diabetes_rate": rate(sick(), 1), "high_risk_patients": n_if(high_risk()),
        "high_risk_rate": rate(high_risk(), 1), "avg_metabolic_risk": mean("metabolic_syndrome_risk", 3),
        "avg_cardiovascular_risk": mean("cardiovascular_risk", 3), "avg_lifestyle_risk": mean("lifestyle_risk_score", 3)},
        {"distribution_percentage": ("patient_count", 1)},
        {"lifestyle_recommendation": first_match([(k, t[v]) for k, v in kinds], t["default"])}).orderBy(
        first_match([(k, i) for i, (k, _) in enumerate(kinds, 1)], 5))


def prediction_accuracy_analysis(gold: DataFrame, as_of: date) -> DataFrame:
    """(prediction, outcome) groups with the confusion totals repeated on each.

    The totals are sums over the at most four group rows.
    """
    groups = report(recent(gold, as_of, 30), {"prediction": "prediction", "actual_outcome": "diabetes"}, {
        "case_count": n(), "avg_prediction_probability": mean("prediction_probability", 3),
        "avg_risk_score": mean("risk_score", 3), "avg_glucose": mean("glucose", 1), "avg_bmi": mean("bmi", 1)})
    everything = Window.partitionBy()
    cell = lambda p, a: F.sum(F.when((C("prediction") == p) & (C("actual_outcome") == a), C("case_count"))
                              .otherwise(0)).over(everything)
    out = groups.withColumns({"true_positive": cell(1, 1), "true_negative": cell(0, 0), "false_positive": cell(1, 0),
                              "false_negative": cell(0, 1), "total_cases": F.sum("case_count").over(everything)})
    tp, tn, fp, fn = (C(x) for x in ("true_positive", "true_negative", "false_positive", "false_negative"))
    return out.withColumns({"accuracy_percentage": pct(tp + tn, "total_cases", 2), "sensitivity_recall": pct(tp, tp + fn, 2),
                            "precision": pct(tp, tp + fp, 2), "specificity": pct(tn, tn + fp, 2)})


def treatment_intervention_analysis(gold: DataFrame, as_of: date) -> DataFrame:
    refer = C("specialist_referral_needed")
    text = recode("intervention_priority", R.PRIORITY_TEXT, R.PRIORITY_TEXT_OTHER)
    return report(recent(gold, as_of, 30), ["intervention_priority", "followup_frequency"], {
        "patient_count": n(), "referral_needed": n_if(refer), "referral_rate": rate(refer, 1),
        "avg_risk_score": mean("risk_score", 3), "avg_glucose": mean("glucose", 1), "avg_bmi": mean("bmi", 1),
        "estimated_total_cost": total(annual_cost()), "avg_cost_per_patient": F.floor(total(annual_cost()) / n()).cast("double"),
        "clinical_recommendations": joined_labels(text, "; ")}, {"distribution_percentage": ("patient_count", 1)}).orderBy(
        order_rank("intervention_priority", R.PRIORITY_ORDER[:3]), order_rank("followup_frequency", R.FOLLOWUP_ORDER))


def trends_timeseries(gold: DataFrame, as_of: date, days: int = 30) -> DataFrame:
    """Daily measures, seven-row trailing means and their direction.

    The windows are unpartitioned: they run over one row per day.
    """
    d = "processing_date"
    daily = report(recent(gold, as_of, days), [d], {
        "daily_patients": n(), "daily_diabetic_cases": n_if(sick()), "daily_avg_glucose": mean("glucose", 1),
        "daily_avg_bmi": mean("bmi", 1), "daily_avg_risk": mean("risk_score", 3), "daily_high_risk": n_if(high_risk()),
        "daily_immediate_care": n_if(urgent())})
    raw_rate = ratio(C("daily_diabetic_cases") * 100.0, "daily_patients")
    smooth = daily.withColumns({
        "daily_diabetes_rate": rnd(raw_rate, 1), "glucose_7day_ma": trailing_mean("daily_avg_glucose", d, 7, 1),
        "bmi_7day_ma": trailing_mean("daily_avg_bmi", d, 7, 1), "risk_7day_ma": trailing_mean("daily_avg_risk", d, 7, 3),
        "diabetes_rate_7day_ma": trailing_mean(raw_rate, d, 7, 1)})
    return smooth.withColumns({"glucose_trend": trend_label("glucose_7day_ma", d),
                               "risk_trend": trend_label("risk_7day_ma", d)}).orderBy(d)


def feature_importance_analysis(gold: DataFrame, as_of: date) -> DataFrame:
    rows = recent(gold, as_of, 30)
    names = list(R.SIGNIFICANCE_TEXT)
    profile = struct_rows(rows, {
        c: {"mean_value": mean(c, 1), "std_value": sd(c, 1), "min_value": F.min(c).cast("double"),
            "max_value": F.max(c).cast("double"), "null_count": n_if(C(c).isNull()), "total_count": n(),
            "diabetes_correlation": corr(c, "diabetes", 3)} for c in names}, "feature_name")
    return profile.withColumns({
        "null_percentage": pct("null_count", "total_count", 1),
        "clinical_significance": recode("feature_name", R.SIGNIFICANCE_TEXT)}).orderBy(
        F.abs("diabetes_correlation").desc())


def data_quality_monitoring(gold: DataFrame, as_of: date) -> DataFrame:
    f = C("anomaly_flags")
    low = C("quality_score") < 0.8
    out = report(recent(gold, as_of, 30), ["processing_date"], {
        "total_records": n(), "avg_quality_score": mean("quality_score", 3), "low_quality_records": n_if(low),
        "low_quality_percentage": rate(low, 1), "records_with_anomalies": n_if(has_anomaly()),
        "anomaly_percentage": rate(has_anomaly(), 1),
        **{f"{x}_count": n_if(f.getField(x)) for x in ("zero_glucose", "extreme_glucose", "zero_bmi", "extreme_bmi")}})
    share = C("low_quality_percentage")
    return out.withColumns({
        "quality_rating": band("avg_quality_score", R.QUALITY_RATING),
        "data_quality_risk": first_match([(share > 20, "High"), (share > 10, "Medium")], "Low")}).orderBy(
        C("processing_date").desc())


def population_health_dashboard(gold: DataFrame, as_of: date) -> DataFrame:
    everyone = n()
    cost, avoidable = total(annual_cost()), n_if(preventable()) * F.lit(R.PREVENTION_SAVING)
    out = recent(gold, as_of, 7).agg(
        everyone.alias("total_population"), n_if(sick()).alias("diabetic_population"),
        rate(sick(), 1).alias("diabetes_prevalence_rate"), n_if(preventable()).alias("prediabetic_population"),
        rate(preventable(), 1).alias("prediabetes_prevalence_rate"), n_if(high_risk()).alias("high_risk_population"),
        rate(high_risk(), 1).alias("high_risk_prevalence_rate"), n_if(urgent()).alias("immediate_intervention_needed"),
        n_if(C("specialist_referral_needed")).alias("specialist_referrals_needed"),
        mean("risk_score", 3).alias("population_avg_risk"), mean("glucose", 1).alias("population_avg_glucose"),
        mean("bmi", 1).alias("population_avg_bmi"), mean("metabolic_syndrome_risk", 3).alias("population_metabolic_risk"),
        mean("cardiovascular_risk", 3).alias("population_cardiovascular_risk"), cost.alias("total_estimated_cost"),
        avoidable.alias("preventable_cost"), F.floor(cost / everyone).cast("double").alias("avg_cost_per_person"),
        pct(avoidable, cost, 1).alias("cost_prevention_potential"))
    return out.withColumn("population_risk_category", band("population_avg_risk", R.POPULATION_RISK))


# ---- monitoring ------------------------------------------------------------
def system_health(gold: DataFrame, as_of: datetime) -> DataFrame:
    t, newest = C("processed_timestamp"), F.max("processed_timestamp")
    p, g, b, a = C("prediction_probability"), C("glucose"), C("bmi"), C("age")
    return gold.agg(
        F.lit("System Health").alias("category"),
        first_match([(newest > _at(as_of, hours=1), "Healthy"), (newest > _at(as_of, hours=6), "Warning")], "Critical")
        .alias("data_pipeline_status"),
        rnd(seconds_between(_at(as_of), newest) / 3600.0, 6).alias("data_age_hours"),
        n_if(t > _at(as_of, hours=1)).alias("records_last_hour"), n_if(t > _at(as_of, days=1)).alias("records_last_day"),
        rnd(F.avg("quality_score") * 100, 2).alias("avg_quality_score"), n_if(C("quality_score") < 0.8).alias("low_quality_count"),
        mean(p, 4).alias("avg_prediction_confidence"), n_if(p.isNull()).alias("missing_predictions"),
        n_if(level("Critical")).alias("critical_risk_alerts"), n_if(level("High")).alias("high_risk_alerts"),
        n_if(urgent()).alias("immediate_interventions"), n_if((g > 400) | (g < 0)).alias("glucose_anomalies"),
        n_if((b > 60) | (b < 10)).alias("bmi_anomalies"), n_if((a > 120) | (a < 0)).alias("age_anomalies"))


def alert_threshold_monitoring(gold: DataFrame, as_of: datetime, hours: int = 24) -> DataFrame:
    """Alerts that are not Normal, from one pass over the last ``hours`` hours."""
    return alerts_of(within(gold, as_of, hours=hours))


def alert_cells() -> dict[str, dict[str, Column]]:
    """Aggregates of the four alerts."""
    hot, risky = n_if(C("glucose") > 200), n_if(high_risk())
    quality, belief = F.avg("quality_score"), F.avg("prediction_probability")
    over = lambda x, crit, warn: first_match([(x > crit, "Critical"), (x > warn, "Warning")], "Normal")
    under = lambda x, crit, warn: first_match([(x < crit, "Critical"), (x < warn, "Warning")], "Normal")
    found = {
        "High Glucose Patients": (hot.cast("double"), 50.0, over(hot, 100, 50)),
        "Data Quality Degradation": (rnd(quality * 100, 2), 85.0, under(quality, 0.7, 0.85)),
        "Low Model Confidence": (rnd(belief * 100, 2), 70.0, under(belief, 0.5, 0.7)),
        "High Risk Patient Surge": (risky.cast("double"), 100.0, over(risky, 200, 100)),
    }
    return {name: {"current_value": v, "threshold_value": F.lit(limit), "alert_level": lv,
                   "alert_message": F.lit(R.ALERT_TEXT[name][0]),
                   "recommendation": F.lit(R.ALERT_TEXT[name][1]),
                   "last_triggered": F.date_format(F.max("processed_timestamp"), "yyyy-MM-dd HH:mm:ss")}
            for name, (v, limit, lv) in found.items()}


def alerts_of(rows: DataFrame) -> DataFrame:
    return struct_rows(rows, alert_cells(), "alert_type").where(C("alert_level") != "Normal").orderBy(
        order_rank("alert_level", ["Critical", "Warning"]))


def etl_pipeline_performance(gold: DataFrame, as_of: datetime, days: int = 7) -> DataFrame:
    t, q, p, g = C("processed_timestamp"), C("quality_score"), C("prediction_probability"), C("glucose")
    return report(within(gold, as_of, days=days), {"processing_hour": hour_text("processed_timestamp")}, {
        "records_processed": n(), "records_per_second": rnd(n() / 3600.0, 6), "high_quality_records": n_if(q >= 0.9),
        "low_quality_records": n_if(q < 0.8), "avg_quality_score": rnd(F.avg(q) * 100, 2),
        "successful_predictions": n_if(p.isNotNull()), "failed_predictions": n_if(p.isNull()),
        "prediction_success_rate": rate(p.isNotNull(), 2),
        "feature_engineering_success": n_if(C("glucose_bmi_interaction").isNotNull()),
        "risk_scoring_success": n_if(C("risk_score").isNotNull()),
        "missing_data_errors": n_if(g.isNull() | C("bmi").isNull() | C("age").isNull()),
        "outlier_errors": n_if((g < 0) | (g > 600)),
        "processing_duration_seconds": rnd(seconds_between(F.max(t), F.min(t)), 3)}).orderBy(C("processing_hour").desc())


def model_drift_detection(gold: DataFrame, as_of: datetime, days: int = 30) -> DataFrame:
    spread = {"glucose": 2, "bmi": 2, "age": 2}
    m = {}
    for c, k in spread.items():
        m |= {f"avg_{c}": mean(c, k), f"stddev_{c}": sd(c, k)}
    for c, name in (("prediction_probability", "prediction_prob"), ("risk_score", "risk_score")):
        m |= {f"avg_{name}": mean(c, 4), f"stddev_{name}": sd(c, 4)}
    m |= {"high_risk_percentage": rate(level("High"), 6), "critical_risk_percentage": rate(level("Critical"), 6),
          "diabetes_rate": rate(sick(), 6), "daily_volume": n()}
    for c, base in R.DRIFT_BASELINE.items():
        m[f"{c.split('_')[0]}_drift_magnitude"] = rnd(F.abs(F.avg(c) - F.lit(base)), 6)
    return report(within(gold, as_of, days=days), {"analysis_date": day_of("processed_timestamp")}, m).orderBy(
        C("analysis_date").desc())


def healthcare_impact_metrics(gold: DataFrame, as_of: datetime, weeks: int = 12) -> DataFrame:
    well, r = C("diabetes") == 0, C("risk_score")
    return report(within(gold, as_of, weeks=weeks), {"week_start": period_of("week", "processed_timestamp")}, {
        "total_patients_screened": n(), "high_risk_patients_identified": n_if(high_risk()),
        "prevention_opportunities": n_if(well & (r > 0.6)), "immediate_interventions_needed": n_if(urgent()),
        "soon_interventions_needed": n_if(urgent("Soon")),
        **{f"estimated_{k.lower()}_cost_impact": n_if(cost_is(k)) * F.lit(v) for k, v in R.IMPACT_COST.items()},
        "potential_cost_savings_prevention": n_if(well & (r > 0.7)) * F.lit(R.IMPACT_PREVENTION_SAVING),
        "population_health_index": rnd(F.avg(F.when(well, (F.lit(1.0) - r) * 100).otherwise(F.lit(0.0))), 2),
        "screening_effectiveness_score": rnd(F.avg("prediction_probability") * 100, 2),
        # a handful of labels per week: set sizes, cheaper than the expand that two count-distincts need
        "age_groups_covered": F.size(F.collect_set("age_group")).cast("bigint"),
        "bmi_categories_covered": F.size(F.collect_set("bmi_category")).cast("bigint"),
        "data_quality_score": rnd(F.avg("quality_score") * 100, 2),
        "data_quality_issues": n_if(C("quality_score") < 0.8)}).orderBy(C("week_start").desc())


def sla_monitoring(gold: DataFrame, as_of: datetime, hours: int = 24) -> DataFrame:
    newest, oldest = F.max("processed_timestamp"), F.min("processed_timestamp")
    last_hour = n_if(C("processed_timestamp") > _at(as_of, hours=1))
    q, p = F.avg("quality_score"), F.avg("prediction_probability")
    tiers = lambda x, *cuts: first_match(
        [(x >= c, s) for c, s in zip(cuts, ("Exceeded", "Met", "Warning"))], "Breached")
    return within(gold, as_of, hours=hours).agg(
        F.lit("Data Processing SLA").alias("sla_type"),
        first_match([(newest > _at(as_of, hours=1), 99.9), (newest > _at(as_of, hours=4), 95.0)], 90.0)
        .alias("availability_percentage"),
        first_match([(newest > _at(as_of, minutes=30), "Met"), (newest > _at(as_of, hours=2), "Warning")], "Breached")
        .alias("data_freshness_sla"),
        tiers(q, 0.95, 0.90, 0.85).alias("data_quality_sla"),
        first_match([(last_hour >= 100, "Met"), (last_hour >= 50, "Warning")], "Breached").alias("volume_processing_sla"),
        tiers(p, 0.8, 0.7, 0.6).alias("model_performance_sla"),
        rnd(ratio(seconds_between(newest, oldest), n()), 6).alias("avg_processing_time_per_record"))


# ---- dashboard panels ------------------------------------------------------
def summary_panel(gold: DataFrame, as_of: date) -> DataFrame:
    units = {"Total Patients": "count", "Diabetes Cases": "count", "Diabetes Rate": "percentage",
             "High Risk Patients": "count", "Average Risk Score": "percentage", "Immediate Interventions": "count",
             "Estimated Annual Cost": "currency"}
    percent = lambda x: F.concat(text_number(x * 100, 1), F.lit("%"))
    rows = metric_rows(recent(gold, as_of, 30), {
        "Total Patients": n(), "Diabetes Cases": n_if(sick()), "Diabetes Rate": percent(F.avg("diabetes")),
        "High Risk Patients": n_if(high_risk()), "Average Risk Score": percent(F.avg("risk_score")),
        "Immediate Interventions": n_if(urgent()),
        "Estimated Annual Cost": F.concat(F.lit("$"), text_number(total(annual_cost()) / 1e6, 1), F.lit("M"))},
        "metric", "value", as_text=True)
    return rows.withColumn("unit", recode("metric", units))


def daily_panel(gold: DataFrame, as_of: date) -> DataFrame:
    return report(recent(gold, as_of, 90), {"time": "processing_date"}, {
        "total_patients": n(), "diabetes_cases": n_if(sick()), "avg_risk_score": rnd(F.avg("risk_score") * 100, 6),
        "data_quality_score": rnd(F.avg("quality_score") * 100, 6)}).orderBy("time")


def hourly_panel(gold: DataFrame, as_of: datetime, hours: int = 24) -> DataFrame:
    rows = gold.where(C("processed_timestamp") >= _at(as_of, hours=hours))
    return report(rows, {"time": hour_text("processed_timestamp")}, {
        "records_processed": n(), "quality_score": rnd(F.avg("quality_score") * 100, 6), "diabetes_positive": n_if(sick()),
        "risk_levels_found": F.size(F.collect_set("health_risk_level")).cast("bigint")}).orderBy("time")


def risk_share_panel(gold: DataFrame, as_of: date) -> DataFrame:
    return report(recent(gold, as_of, 30), {"risk_level": "health_risk_level"}, {"patient_count": n()},
                  {"percentage": ("patient_count", 1)}).orderBy(C("patient_count").desc())


def priority_cost_panel(gold: DataFrame, as_of: date) -> DataFrame:
    return report(recent(gold, as_of, 30), {"priority": "intervention_priority"}, {
        "count": n(), "avg_cost": mean(annual_cost(), 6), "total_cost": total(annual_cost())}).orderBy(
        order_rank("priority", ["Immediate", "High", "Medium", "Low"]))


def age_panel(gold: DataFrame, as_of: date) -> DataFrame:
    return report(recent(gold, as_of, 30), ["age_group"], {
        "total_patients": n(), "diabetes_cases": n_if(sick()), "diabetes_rate": rate(sick(), 1),
        "avg_risk_score": rnd(F.avg("risk_score") * 100, 6), "avg_bmi": mean("bmi", 6), "avg_glucose": mean("glucose", 6)})


def bmi_panel(gold: DataFrame, as_of: date) -> DataFrame:
    return report(recent(gold, as_of, 30), ["bmi_category"], {
        "patient_count": n(), "avg_bmi": mean("bmi", 1), "diabetes_cases": n_if(sick()), "diabetes_rate": rate(sick(), 1),
        "high_risk_count": n_if(high_risk())})


def glucose_histogram(gold: DataFrame, as_of: date) -> DataFrame:
    return report(recent(gold, as_of, 30).where(C("glucose") > 0), {"glucose_range": band("glucose", R.GLUCOSE_HISTOGRAM)}, {
        "patient_count": n(), "avg_glucose": mean("glucose", 6), "diabetes_rate": rate(sick(), 1)}).orderBy(
        order_rank("glucose_range", list(R.GLUCOSE_HISTOGRAM.labels)))


def correlation_panel(gold: DataFrame, as_of: date) -> DataFrame:
    """Four pairs, each over its own rows, out of one pass."""
    g, b, p = C("glucose") > 0, C("bmi") > 0, C("blood_pressure") > 0
    on = lambda cond, c: F.when(cond, C(c))
    return metric_rows(recent(gold, as_of, 30), {
        "Glucose vs BMI": corr(on(g & b, "glucose"), on(g & b, "bmi"), 3),
        "Glucose vs Age": corr(on(g, "glucose"), on(g, "age"), 3),
        "BMI vs Blood Pressure": corr(on(b & p, "bmi"), on(b & p, "blood_pressure"), 3),
        "Age vs Risk Score": corr("age", "risk_score", 3)}, "correlation_pair", "correlation_coefficient")


def accuracy_panel(gold: DataFrame, as_of: date, cut: float = 0.5) -> DataFrame:
    guess = F.when(C("risk_score") >= cut, 1).otherwise(0)
    m = confusion_counts(recent(gold, as_of, 30), "diabetes", guess)
    tp, tn, fp, fn = (C(x) for x in ("tp", "tn", "fp", "fn"))
    wide = m.select(pct(tp + tn, tp + tn + fp + fn, 1).alias("Accuracy"), pct(tp, tp + fp, 1).alias("Precision"),
                    pct(tp, tp + fn, 1).alias("Recall"), pct(2 * tp, 2 * tp + fp + fn, 1).alias("F1 Score"))
    return wide.unpivot([], wide.columns, "metric", "value").withColumn("unit", F.lit("%"))


def feature_panel(gold: DataFrame, as_of: date) -> DataFrame:
    return struct_rows(recent(gold, as_of, 30), {
        label: {"importance_score": F.lit(w), "clinical_significance": F.lit(text),
                "correlation_with_diabetes": corr(c, "diabetes", 3)}
        for label, c, w, text in R.PANEL_FEATURES}, "feature_name").orderBy(C("importance_score").desc())


def cost_by_risk_panel(gold: DataFrame, as_of: date) -> DataFrame:
    return report(recent(gold, as_of, 30), ["health_risk_level"], {
        "patient_count": n(), "total_cost": total(annual_cost()), "avg_cost_per_patient": mean(annual_cost(), 6),
        "cost_per_patient": rnd(total(annual_cost()) / n(), 6)}).orderBy(
        order_rank("health_risk_level", ["Low", "Moderate", "High", "Critical"]))


def recommendation_panel(gold: DataFrame, as_of: date) -> DataFrame:
    rows = recent(gold, as_of, 30).where(C("treatment_recommendation").isNotNull())
    return report(rows, ["treatment_recommendation"], {
        "patient_count": n(), "avg_cost": mean(annual_cost(), 6), "total_cost": total(annual_cost())},
        {"percentage": ("patient_count", 1)}).orderBy(C("patient_count").desc())


def quality_panel(gold: DataFrame, as_of: date) -> DataFrame:
    q = C("quality_score")
    return metric_rows(recent(gold, as_of, 30), {
        "Overall Data Quality": rnd(F.avg(q) * 100, 1), "Records with High Quality (≥80%)": rate(q >= 0.8, 1),
        "Complete Records (No Missing Values)": rate(q == 1.0, 1)}, "metric", "value").withColumn("unit", F.lit("%"))


def anomaly_panel(gold: DataFrame, as_of: date) -> DataFrame:
    return report(recent(gold, as_of, 7), ["processing_date"], {
        "total_records": n(), "records_with_anomalies": n_if(has_anomaly()), "anomaly_rate": rate(has_anomaly(), 2),
        "avg_quality_score": mean("quality_score", 6)}).orderBy(C("processing_date").desc())


def pipeline_status_panel(log: DataFrame, as_of: datetime, hours: int = 24) -> DataFrame:
    took = seconds_between(C("end_time"), C("start_time"))
    rows = log.where(C("start_time") >= _at(as_of, hours=hours))
    return report(rows, ["pipeline_stage", "status"], {
        "execution_count": n(), "last_execution": F.date_format(F.max("end_time"), "yyyy-MM-dd HH:mm:ss"),
        "avg_duration_seconds": rnd(F.avg(took), 6)}).orderBy("pipeline_stage", "status")


def latest_processing_panel(log: DataFrame, gold: DataFrame, as_of: datetime, hours: int = 24) -> DataFrame:
    done, failed = C("status") == "SUCCESS", C("status") == "ERROR"
    today = gold.where(C("processing_date") == F.lit(as_of.date())).agg(n().cast("string").alias("value")).select(
        F.lit("Records Processed Today").alias("metric"), "value", F.lit("count").alias("unit"))
    runs = struct_rows(log, {
        "Last ETL Run": {"value": F.date_format(F.max(F.when(done, C("end_time"))), "yyyy-MM-dd HH:mm:ss"),
                         "unit": F.lit("timestamp")},
        "Active Alerts": {"value": n_if(failed & (C("start_time") >= _at(as_of, hours=hours))).cast("string"),
                          "unit": F.lit("count")}}, "metric")
    return runs.unionByName(today)


# ---- lake views ------------------------------------------------------------
def health_summary_by_demographics(gold: DataFrame) -> DataFrame:
    return report(gold, ["age_group", "bmi_category"], {
        "patient_count": n(), "avg_risk_score": mean("risk_score", 6), "diabetes_cases": n_if(sick()),
        "diabetes_rate_percent": rate(sick(), 2), "immediate_intervention_needed": n_if(urgent())}).orderBy(
        C("avg_risk_score").desc())


def latest_predictions(gold: DataFrame, columns: list[str]) -> DataFrame:
    """Rows carrying the newest time stamp, with a risk label."""
    newest = gold.agg(F.max("processed_timestamp").alias("t")).scalar()
    return gold.where(C("processed_timestamp") == newest).select(
        *columns, band("risk_score", R.RISK_SNAPSHOT).alias("risk_assessment"))


def model_performance_trends(performance: DataFrame) -> DataFrame:
    before = previous("accuracy", "evaluation_date", ["model_id"])
    return performance.select(
        C("evaluation_date").cast("date").alias("eval_date"), "model_id", "accuracy", "f1_score", "test_samples",
        before.alias("prev_accuracy"), rnd(C("accuracy") - before, 6).alias("accuracy_change")).orderBy(
        "model_id", C("eval_date").desc())


def etl_job_summary(jobs: DataFrame, as_of: date) -> DataFrame:
    rows = jobs.where(C("start_time") >= F.date_sub(F.lit(as_of), 7).cast("timestamp_ntz"))
    return report(rows, ["job_type", "status"], {
        "job_count": n(), "avg_duration_seconds": mean("duration_seconds", 6),
        "last_execution": F.date_format(F.max("end_time"), "yyyy-MM-dd HH:mm:ss"),
        "total_records_processed": total("records_processed"), "total_records_failed": total("records_failed")})


def data_quality_dashboard(checks: DataFrame, as_of: date) -> DataFrame:
    rows = checks.where(C("check_timestamp") >= F.date_sub(F.lit(as_of), 1).cast("timestamp_ntz"))
    return rows.withColumn("status", F.when(C("is_passed"), F.lit("PASS")).otherwise(F.lit("FAIL"))).orderBy(
        C("check_timestamp").desc())


def resource_health(samples: DataFrame, as_of: datetime, hours: int = 1) -> DataFrame:
    rows = samples.where(C("recorded_at") >= _at(as_of, hours=hours))
    return report(rows, ["metric_type"], {
        "avg_value": mean("metric_value", 6), "max_value": F.max("metric_value"), "min_value": F.min("metric_value"),
        "measurement_count": n(), "last_recorded": F.date_format(F.max("recorded_at"), "yyyy-MM-dd HH:mm:ss")})


def glucose_bmi_cross(raw: DataFrame) -> DataFrame:
    sick = C("outcome") == 1
    return report(raw.where((C("glucose") > 0) & (C("bmi") > 0)),
                  {"glucose_category": band("glucose", R.GLUCOSE_140), "bmi_category": band("bmi", R.BMI_SIMPLE)},
                  {"count": n(), "diabetic_cases": n_if(sick), "diabetes_rate": rate(sick, 2)}).orderBy(
        C("diabetes_rate").desc())


def high_risk_summary(raw: DataFrame) -> DataFrame:
    return raw.where((C("glucose") > 140) & (C("bmi") > 30)).agg(
        n().alias("high_risk_count"), n_if(C("outcome") == 1).alias("confirmed_diabetic"), mean("age", 2).alias("avg_age"),
        mean("pregnancies", 2).alias("avg_pregnancies"))


def pregnancy_impact(raw: DataFrame) -> DataFrame:
    sick = C("outcome") == 1
    return report(raw, {"pregnancy_group": band("pregnancies", R.PREGNANCY_GROUPS)}, {
        "total": n(), "diabetic": n_if(sick), "diabetes_rate": rate(sick, 2)}).orderBy(C("diabetes_rate").desc())


def layer_counts(layers: dict[str, DataFrame]) -> DataFrame:
    parts = [df.agg(n().alias("record_count")).select(F.lit(name).alias("layer"), "record_count")
             for name, df in layers.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def feature_coverage(gold: DataFrame) -> DataFrame:
    return gold.agg(n().alias("total_records"), F.count("glucose_bmi_interaction").alias("interaction_features"),
                    F.count("health_risk_level").alias("risk_assessments"),
                    F.count("treatment_recommendation").alias("recommendations"))


# ---- wearable insights -----------------------------------------------------
def wearable_insights(people: DataFrame, keys: list[str]) -> DataFrame:
    """Averages, medians, spread and prevalence per cohort."""
    base = report(people, keys, {
        "total_population": n(), "avg_health_score": mean("health_score", 2), "avg_heart_rate": mean("heart_rate", 2),
        "avg_sleep_efficiency": mean("sleep_efficiency", 2), "avg_steps_daily": mean("steps_daily", 2),
        "stddev_heart_rate": sd("heart_rate", 2), "avg_bmi": mean("bmi_calculated", 2),
        "high_risk_count": n_if(C("health_risk_category").isin("High_Risk", "Critical_Risk")),
        "high_risk_percentage": rate(C("health_risk_category").isin("High_Risk", "Critical_Risk"), 2)})
    middle = exact_percentiles(people, keys, "heart_rate", {"median_heart_rate": 0.5})
    cond = [base[k].eqNullSafe(middle[k]) for k in keys]
    return base.join(middle, cond, "left").select(*[base[c] for c in base.columns], middle["median_heart_rate"])


def wearable_period_trends(people: DataFrame, period: Column, keys: list[str]) -> DataFrame:
    """Cohort averages per period and the change against the period before."""
    base = report(people, {"period_start": period, **{k: k for k in keys}}, {
        "total_population": n(), "avg_health_score": mean("health_score", 2)})
    before = previous("avg_health_score", "period_start", keys)
    return base.withColumns({"prev_health_score": before,
                             "health_score_change": rnd(C("avg_health_score") - before, 2),
                             "health_trend": trend_label("avg_health_score", "period_start", keys)})
