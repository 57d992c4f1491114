"""Daily report tables that grow by loads.

Two Parquet tables belong to a report. ``parts`` holds what each load kept of its rows per day and group,
partitioned by period (a day, or a coarser unit where days are small) and load; a load writes only files
of its own, and the same load given again replaces them, so a retried job counts nothing twice. ``report`` holds
the finished rows, partitioned by period; a load merges the parts of the days it brought and upserts these days.
Neither the source rows of earlier loads nor the partitions of other periods are read.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vitalmart.functions.bands import recode
from vitalmart.operators.aggregate import text_number
from vitalmart.operators.partials import Measure, count, figures, full_report, kept_parts, mean, merged_parts, rate

from .incremental import rebuild_partitions

_PERIOD, _LOAD = "period", "load_id"


@dataclass(frozen=True)
class DailyReport:
    """One row per day and group. ``day`` names the output column and what it is computed from; ``unit`` is the
    ``date_trunc`` unit of a partition."""

    day: tuple[str, str]
    measures: dict[str, Measure]
    groups: dict[str, Column | str] = field(default_factory=dict)
    unit: str = "day"

    @property
    def keys(self) -> dict[str, Column | str]:
        return {self.day[0]: F.col(self.day[1]).cast("date"), **self.groups}

    def period(self) -> Column:
        return F.date_trunc(self.unit, F.col(self.day[0])).cast("date")

    def full(self, df: DataFrame) -> DataFrame:
        return full_report(df, self.keys, self.measures)


def load(rows: DataFrame, report: DailyReport, path: str, load_id: str) -> None:
    """Add the rows of one load to the tables below path. A NULL day has a period of its own."""
    parts = kept_parts(rows, report.keys, report.measures).withColumns({_PERIOD: report.period(), _LOAD: F.lit(load_id)})
    (parts.hint("rebalance", _PERIOD).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(_PERIOD, _LOAD).parquet(f"{path}/parts"))
    refresh(read_parts(rows.sparkSession, path, parts.schema), report, path, load_id)


def read_parts(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """What all loads kept, per day and group."""
    return (spark.read.schema(schema) if schema else spark.read).parquet(f"{path}/parts")


def _among(column: str, values: list) -> Column:
    named = F.col(column).isin([v for v in values if v is not None])
    return named | F.col(column).isNull() if None in values else named


def refresh(parts: DataFrame, report: DailyReport, path: str, load_id: str) -> None:
    """Merge the days a load brought, from all loads, and put them in place of these days in the report table."""
    day, keys, target = report.day[0], list(report.keys), f"{path}/report"
    brought = parts.where(F.col(_LOAD) == load_id)
    # periods are bounded by the calendar; as literals they prune partitions before anything is read
    periods = [r[_PERIOD] for r in brought.select(_PERIOD).distinct().collect()]
    days = brought.select(F.col(day).alias("_day")).distinct()
    same = F.col(day).eqNullSafe(F.col("_day"))
    touched = parts.where(_among(_PERIOD, periods)).join(days, same, "left_semi")
    changes = figures(merged_parts(touched, [_PERIOD, *keys], report.measures), [_PERIOD, *keys], report.measures)
    changes.limit(0).write.mode("ignore").partitionBy(_PERIOD).parquet(target)
    old = parts.sparkSession.read.schema(changes.schema).parquet(target).where(_among(_PERIOD, periods))
    rows = old.join(days, same, "left_anti").unionByName(changes)
    rebuild_partitions(rows.hint("rebalance", _PERIOD), target, [_PERIOD])


def read_report(spark: SparkSession, report: DailyReport, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/report").select(*report.keys, *report.measures)


def combined(parts: DataFrame, keys: list[str], measures: dict[str, Measure]) -> DataFrame:
    """A report over all kept days by other keys (or none), without the rows."""
    return figures(merged_parts(parts, keys, measures), keys, measures)


# ---- the reports -----------------------------------------------------------
_c = F.col


def _high() -> Column:
    return _c("health_risk_level").isin("High", "Critical")


def outcome_stats(day: str = "processing_date", unit: str = "day") -> DailyReport:
    cat = lambda v: count(_c("risk_category") == v)
    return DailyReport(("date_key", day), {
        "total_patients": count(), "diabetic_patients": count(_c("outcome") == 1), "non_diabetic_patients": count(_c("outcome") == 0),
        "diabetic_rate": mean("outcome", 6), "avg_glucose": mean("glucose", 6), "avg_bmi": mean("bmi", 6), "avg_age": mean("age", 6),
        "high_risk_patients": cat("High"), "medium_risk_patients": cat("Medium"), "low_risk_patients": cat("Low")}, unit=unit)


def risk_by_demographics(day: str = "processing_date", unit: str = "day") -> DailyReport:
    ordinal = recode("risk_category", {"High": 3, "Medium": 2}, 1)
    return DailyReport(("date_key", day), {
        "total_patients": count(), "diabetic_patients": count(_c("outcome") == 1), "diabetic_rate": mean("outcome", 6),
        "avg_risk_score": mean(ordinal, 6), "avg_glucose": mean("glucose", 6), "avg_bmi": mean("bmi", 6)},
        {"age_group": "age_group", "bmi_category": "bmi_category"}, unit)


def health_insights(day: str = "processing_date", unit: str = "day") -> DailyReport:
    return DailyReport(("report_date", day), {
        "total_patients": count(), "diabetic_patients": count(_c("diabetes") == 1), "high_risk_patients": count(_high()),
        "avg_bmi": mean("bmi", 2), "avg_glucose": mean("glucose", 2), "avg_age": mean("age", 2), "avg_risk_score": mean("risk_score", 3),
        "high_risk_count": count(_high()), "high_risk_percentage": rate(_high(), 2)},
        {"age_group": "age_group", "health_risk_category": "health_risk_level", "bmi_category": "bmi_category"}, unit)


def daily_statistics(day: str = "processing_date", unit: str = "day") -> DailyReport:
    """Daily totals, means and category shares."""
    return DailyReport(("stat_date", day), {
        "total_records": count(), "diabetic_cases": count(_c("diabetes") == 1), "high_risk_cases": count(_high()),
        "avg_glucose": mean("glucose", 2), "avg_bmi": mean("bmi", 2), "avg_age": mean("age", 1), "avg_risk_score": mean("risk_score", 4),
        "glucose_normal_pct": rate(_c("glucose_category") == "Normal", 1),
        "glucose_prediabetic_pct": rate(_c("glucose_category") == "Prediabetic", 1),
        "glucose_diabetic_pct": rate(_c("glucose_category").isin("Diabetic", "Severely Diabetic"), 1),
        "bmi_normal_pct": rate(_c("bmi_category") == "Normal Weight", 1), "bmi_overweight_pct": rate(_c("bmi_category") == "Overweight", 1),
        "bmi_obese_pct": rate(_c("bmi_category").like("Obese%"), 1), "age_young_pct": rate(_c("age") < 35, 1),
        "age_middle_pct": rate((_c("age") >= 35) & (_c("age") < 55), 1), "age_senior_pct": rate(_c("age") >= 55, 1),
        "immediate_care_needed": count(_c("intervention_priority") == "Immediate"),
        "routine_monitoring_needed": count(_c("intervention_priority") == "Monitor")}, unit=unit)


def insight_rates(day: str = "processing_date", unit: str = "day") -> DailyReport:
    """Daily counts and rates of the insight table."""
    level = lambda v: count(_c("risk_category") == v)
    return DailyReport(("aggregation_date", day), {
        "total_patients": count(), "high_risk_count": level("HIGH_RISK"), "moderate_risk_count": level("MODERATE_RISK"),
        "low_risk_count": level("LOW_RISK"), "avg_diabetes_risk_score": mean("diabetes_risk_score", 4),
        "obesity_rate": rate(_c("bmi_category").like("obese%"), 6), "diabetes_rate": rate(_c("glucose_category") == "diabetic", 6),
        "hypertension_rate": rate(_c("blood_pressure_category").like("%hypertension%"), 6)}, unit=unit)


def daily_stats(day: str = "processing_date", unit: str = "day") -> DailyReport:
    return DailyReport(("date", day), {
        "total_records": count(), "diabetic_count": count(_c("outcome") == 1), "non_diabetic_count": count(_c("outcome") == 0),
        "avg_glucose": mean("glucose", 2), "avg_bmi": mean("bmi", 2), "avg_age": mean("age", 2), "avg_risk_score": mean("risk_score", 2),
        "high_risk_count": count(_c("high_risk_flag"))}, unit=unit)


def enhanced_daily_stats(day: str = "processing_date", unit: str = "day") -> DailyReport:
    level = lambda v: count(_c("health_risk_level") == v)
    return DailyReport(("date", day), {
        "total_records": count(), "diabetic_count": count(_c("diabetes") == 1), "non_diabetic_count": count(_c("diabetes") == 0),
        **{f"avg_{c}": mean(c, 2) for c in ("glucose", "bmi", "age", "risk_score")},
        "avg_prediction_confidence": mean("prediction_probability", 2), "high_risk_count": level("High"),
        "critical_risk_count": level("Critical"), "immediate_intervention_count": count(_c("intervention_priority") == "Immediate"),
        "avg_data_quality": mean("quality_score", 2)}, unit=unit)


def snapshot_metrics(day: str = "processing_date", unit: str = "day") -> DailyReport:
    sick = _c("diabetes") == 1
    return DailyReport(("stat_date", day), {
        "total_patients": count(), "diabetic_patients": count(sick), "high_risk_patients": count(_high()), "avg_glucose": mean("glucose", 1),
        "avg_bmi": mean("bmi", 1), "diabetes_rate": rate(sick, 1), "high_risk_rate": rate(_high(), 1)}, unit=unit)


def snapshot(parts: DataFrame, report: DailyReport) -> DataFrame:
    """Long latest-metrics rows out of the kept parts of all days: counts, averages and percentages as text."""
    kinds = {name: "count" if set(m.keep) == {"n"} else "percentage" if "hits" in m.keep else "average" for name, m in report.measures.items()}
    wide = combined(parts, [], report.measures)
    text = {name: _c(name).cast("string") if kind == "count" else text_number(_c(name), 1) for name, kind in kinds.items()}
    rows = wide.select(*[c.alias(name) for name, c in text.items()]).unpivot([], list(kinds), "metric_name", "metric_value")
    return rows.withColumn("metric_type", recode("metric_name", kinds))
