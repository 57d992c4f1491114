"""I*: incremental loads, upserts, retention, run logs, jobs; U4-U5: table functions and procedures."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from vitalmart.functions.bands import recode
from vitalmart.functions.numeric import rnd
from vitalmart.operators import quality as Q
from vitalmart.operators.aggregate import n, report
from vitalmart.plans import incremental as I
from vitalmart.plans import daily, jobs, layers, reports, retention, runner, samples
from vitalmart.rules import clinical as R
from vitalmart.sources import writers
from vitalmart.sources.keystore import KeyStore

from . import sql as S
from .base import ORACLES, query
from .features import _TIGHT
from .reports_clinical import CLEAN_WEARABLE, JOBS
from .reports_gold import HIGH, SICK, _is, _stamp, _text

C = F.col
AT = dt.datetime(2024, 1, 15, 12)


@query("i1_insert_new_only", "SELECT o_orderkey, o_orderstatus FROM orders")
def _(t):
    """The table starts with the finished orders; the load adds the rest and nothing twice."""
    path = writers.scratch_path(t.spark, "i1")
    rows = t.orders.select("o_orderkey", "o_orderstatus")
    rows.where(C("o_orderstatus") == "F").write.parquet(path)
    I.append_new(rows, path, "o_orderkey")
    return t.spark.read.parquet(path)


@query("i1_insert_new_by_key_store", "SELECT o_orderkey, o_orderstatus FROM orders")
def _(t):
    """The same with the target's keys in a store; the second load is given twice."""
    path = writers.scratch_path(t.spark, "i1")
    rows = t.orders.select("o_orderkey", "o_orderstatus")
    store = KeyStore(t.spark, writers.scratch_name("i1_keys"), "o_orderkey", int(t.spark.conf.get("spark.sql.shuffle.partitions")))
    for load in (rows.where(C("o_orderstatus") == "F"), rows, rows):
        I.append_new(load, path, "o_orderkey", store=store)
    store.drop()
    return t.spark.read.parquet(path)


_CHANGES = ("SELECT o_orderkey, o_orderstatus, 0e0 AS o_totalprice FROM orders WHERE o_orderpriority = '1-URGENT' UNION ALL SELECT -1 - o_orderkey,"
            " o_orderstatus, o_totalprice FROM orders WHERE o_orderpriority = '5-LOW'")


def _order_changes(t):
    base = ["o_orderkey", "o_orderstatus", "o_totalprice"]
    free = t.orders.where(C("o_orderpriority") == "1-URGENT").select("o_orderkey", "o_orderstatus", F.lit(0.0).alias("o_totalprice"))
    new = t.orders.where(C("o_orderpriority") == "5-LOW").select((F.lit(-1) - C("o_orderkey")).alias("o_orderkey"), *base[1:])
    return free.unionByName(new)


_UPSERTED = f"WITH ch AS ({_CHANGES}) SELECT * FROM ch UNION ALL SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM ch)"


@query("i2_upsert_by_key", _UPSERTED)
def _(t):
    return I.upsert(t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice"), _order_changes(t), ["o_orderkey"])


@query("i2_upsert_partitions", _UPSERTED)
def _(t):
    """The same on a written table: only the touched partitions are rewritten."""
    path = writers.scratch_path(t.spark, "i2")
    writers.write_partitioned(t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus"), path, ["o_orderstatus"])
    I.upsert_partitions(_order_changes(t), path, ["o_orderstatus", "o_orderkey"], ["o_orderstatus"])
    return t.spark.read.parquet(path)


@query("i2_newest_change_wins", "WITH r AS (SELECT user_id, event_id, event_type, value, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC)"
       " AS rn FROM events) SELECT user_id, event_id, event_type, value FROM r WHERE rn = 1")
def _(t):
    """Several changes per key reduced to the newest before an upsert."""
    return I.newest_per_key(t.events.select("user_id", "event_id", "event_type", "value"), ["user_id"], "event_id")


@query("i3_insert_ignore", "SELECT p_brand FROM part WHERE p_size > 25 GROUP BY p_brand UNION SELECT 'Brand#99' UNION SELECT DISTINCT p_brand FROM part")
def _(t):
    target = t.part.where(C("p_size") > 25).select("p_brand").distinct()
    extra = t.part.select(F.explode(F.array("p_brand", F.lit("Brand#99"))).alias("p_brand"))
    return I.insert_ignore(target, extra, ["p_brand"])


@query("i4_rebuild_partition", "SELECT CAST(year(o_orderdate) AS BIGINT) AS y, COUNT(*) AS orders, " + S.r(
    "SUM(CASE WHEN year(o_orderdate) = 1997 THEN 2 ELSE 1 END * o_totalprice)", 2) + " AS total FROM orders GROUP BY 1")
def _(t):
    """Delete-and-insert of one report year."""
    path = writers.scratch_path(t.spark, "i4")
    rows = t.orders.select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("y"))
    I.rebuild_partitions(rows, path, ["y"])
    I.rebuild_partitions(rows.where(C("y") == 1997).withColumn("o_totalprice", C("o_totalprice") * 2), path, ["y"])
    return report(t.spark.read.parquet(path), {"y": C("y").cast("bigint")}, {"orders": n(), "total": rnd(F.sum("o_totalprice"), 2)})


_CUT = "DATE '2024-01-31' - 14"


@query("i5_retention", f"SELECT 'kept' AS part, event_id FROM events WHERE CAST(ts AS DATE) >= {_CUT} UNION ALL"
       f" SELECT 'archived', event_id FROM events WHERE CAST(ts AS DATE) < {_CUT}")
def _(t):
    """The table after the delete, and its archive: one month, cut within it."""
    return _after_retention(t, "month", [0])


@query("i5_retention_by_day", f"SELECT 'kept' AS part, event_id FROM events WHERE CAST(ts AS DATE) >= {_CUT} UNION ALL"
       f" SELECT 'archived', event_id FROM events WHERE CAST(ts AS DATE) < {_CUT}")
def _(t):
    """Daily partitions, cut on two days in turn: whole folders leave, none is rewritten."""
    return _after_retention(t, "day", [5, 0])


def _after_retention(t, unit, days_before):
    table, root = writers.scratch_name("i5_events"), writers.scratch_path(t.spark, "i5")
    retention.create_by_period(t.events.select("event_id", "ts"), table, "ts", unit, f"{root}/table")
    for back in days_before:
        retention.expire(t.spark, table, "ts", dt.date(2024, 1, 31) - dt.timedelta(back), 14, unit, f"{root}/archive")
    t.spark.sql(f"DROP TABLE {table}")
    kept = t.spark.read.parquet(f"{root}/table").select(F.lit("kept").alias("part"), "event_id")
    return kept.unionByName(retention.archived(t.spark, f"{root}/archive", ["event_id"]).withColumn("part", F.lit("archived")))


_STATUS = {"view": "running", "click": "running", "purchase": "completed", "error": "failed"}


def _run_events(t):
    return t.events.select(
        C("user_id").cast("string").alias("execution_id"), F.lit("clinical").alias("pipeline_name"), F.lit("load").alias("pipeline_stage"),
        recode("event_type", _STATUS, "running").alias("status"), C("ts").alias("event_time"), C("event_id").alias("records_processed"),
        F.when(C("event_type") == "error", F.lit("failed step")).alias("error_message"))


@query("i6_run_log_states", "WITH e AS (SELECT CAST(user_id AS VARCHAR) AS execution_id, " + S.lookup("event_type", _STATUS, "running")
       + " AS status, ts, event_id, CASE WHEN event_type = 'error' THEN 'failed step' END AS error_message FROM events) SELECT execution_id,"
       " arg_max(status, ts) AS status, arg_max(event_id, ts) AS records_processed, arg_max(COALESCE(error_message, ''), ts) AS error_message,"
       + _stamp("MIN(ts)") + " AS start_time, " + S.r("(epoch_us(MAX(ts) FILTER (WHERE status IN ('completed', 'failed'))) - epoch_us(MIN(ts))) / 1e6", 6)
       + " AS duration_seconds FROM e GROUP BY execution_id")
def _(t):
    s = I.run_states(_run_events(t))
    return s.select("execution_id", "status", "records_processed", F.coalesce("error_message", F.lit("")).alias("error_message"),
                    F.date_format("start_time", "yyyy-MM-dd HH:mm:ss").alias("start_time"), rnd("duration_seconds", 6).alias("duration_seconds"))


@query("i7_pipeline_statistics", JOBS + "SELECT 'pipeline_' || event_type AS pipeline_name, COUNT(*) AS total_executions, "
       + S.cnt("status = 'SUCCESS'") + " AS successful_executions, " + S.cnt("status = 'ERROR'") + " AS failed_executions, CAST(SUM(records_processed)"
       " AS BIGINT) AS total_records_processed, " + S.avg("duration_seconds", 6) + " AS average_processing_seconds, " + _stamp("MAX(start_time)")
       + " AS last_execution_time, " + S.rate("status = 'SUCCESS'", 2) + " AS success_rate FROM jobs GROUP BY 1")
def _(t):
    return I.pipeline_statistics(samples.run_log(t.events), "SUCCESS", "ERROR")


_LAYERS = (S.WITH_GOLD + "SELECT 'bronze' AS layer_name, 'clinical_raw' AS table_name, COUNT(*) AS record_count, " + _stamp("MAX(processed_timestamp)")
           + " AS latest_update, CAST(NULL AS DOUBLE) AS data_quality_avg FROM clinical UNION ALL SELECT 'silver', 'clinical_cleaned', COUNT(*), "
           + _stamp("MAX(processed_timestamp)") + ", " + S.avg("quality_score", 3) + " FROM silver UNION ALL SELECT 'gold', 'clinical_gold', COUNT(*), "
           + _stamp("MAX(processed_timestamp)") + ", " + S.avg("quality_score", 3) + " FROM gold")


@query("u4_layer_statistics_function", _LAYERS)
def _(t):
    at = "processed_timestamp"
    return I.layer_statistics([("bronze", "clinical_raw", t.clinical, at, None), ("silver", "clinical_cleaned", t.silver, at, "quality_score"),
                               ("gold", "clinical_gold", t.gold, at, "quality_score")])


def _two_loads(t, rows, spec):
    """Path of a daily table after two loads: rows up to a day and most later ones, then late rows of many days."""
    path = writers.scratch_path(t.spark, "i8")
    late = (C(spec.day[1]) >= F.lit(dt.date(1996, 7, 1))) & (F.pmod(F.xxhash64("glucose"), F.lit(4)) == 0)
    for load_id, part in (("first", F.coalesce(~late, F.lit(True))), ("late", late)):
        daily.load(rows.where(part), spec, path, load_id)
    return path


def _loaded(t, rows, spec):
    return daily.read_report(t.spark, spec, _two_loads(t, rows, spec))


@query("i8_daily_outcome_stats", S.report({"date_key": "processing_date"}, {
    "total_patients": S.cnt(), "diabetic_patients": S.cnt("outcome = 1"), "non_diabetic_patients": S.cnt("outcome = 0"),
    "diabetic_rate": S.avg("outcome", 6), "avg_glucose": S.avg("glucose", 6), "avg_bmi": S.avg("bmi", 6), "avg_age": S.avg("age", 6),
    **{f"{v.lower()}_risk_patients": S.cnt(_is("risk_category", v)) for v in ("High", "Medium", "Low")}}, "categories", S.WITH_CATEGORIES))
def _(t):
    return _loaded(t, t.categories, daily.outcome_stats(unit="year"))


@query("i8_risk_by_demographics", S.report({"date_key": "processing_date", "age_group": "age_group", "bmi_category": "bmi_category"}, {
    "total_patients": S.cnt(), "diabetic_patients": S.cnt("outcome = 1"), "diabetic_rate": S.avg("outcome", 6),
    "avg_risk_score": S.avg("CASE risk_category WHEN 'High' THEN 3 WHEN 'Medium' THEN 2 ELSE 1 END", 6), "avg_glucose": S.avg("glucose", 6),
    "avg_bmi": S.avg("bmi", 6)}, "categories", S.WITH_CATEGORIES))
def _(t):
    return _loaded(t, t.categories, daily.risk_by_demographics(unit="year"))


_GLU = {"normal": "glucose_category = 'Normal'", "prediabetic": "glucose_category = 'Prediabetic'",
        "diabetic": "glucose_category IN ('Diabetic', 'Severely Diabetic')"}


@query("i8_daily_statistics", S.report({"stat_date": "processing_date"}, {
    "total_records": S.cnt(), "diabetic_cases": S.cnt(SICK), "high_risk_cases": S.cnt(HIGH), "avg_glucose": S.avg("glucose", 2),
    "avg_bmi": S.avg("bmi", 2), "avg_age": S.avg("age", 1), "avg_risk_score": S.avg("risk_score", 4),
    **{f"glucose_{k}_pct": S.rate(v, 1) for k, v in _GLU.items()}, "bmi_normal_pct": S.rate("bmi_category = 'Normal Weight'", 1),
    "bmi_overweight_pct": S.rate("bmi_category = 'Overweight'", 1), "bmi_obese_pct": S.rate("starts_with(bmi_category, 'Obese')", 1),
    "age_young_pct": S.rate("age < 35", 1), "age_middle_pct": S.rate("age BETWEEN 35 AND 54", 1), "age_senior_pct": S.rate("age > 54", 1),
    "immediate_care_needed": S.cnt(_is("intervention_priority", "Immediate")),
    "routine_monitoring_needed": S.cnt(_is("intervention_priority", "Monitor"))}, "gold", S.WITH_GOLD))
def _(t):
    return _loaded(t, t.gold, daily.daily_statistics(unit="year"))


@query("i8_health_insights", S.report({"report_date": "processing_date", "age_group": "age_group", "health_risk_category": "health_risk_level",
                                       "bmi_category": "bmi_category"}, {
    "total_patients": S.cnt(), "diabetic_patients": S.cnt(SICK), "high_risk_patients": S.cnt(HIGH), "avg_bmi": S.avg("bmi", 2),
    "avg_glucose": S.avg("glucose", 2), "avg_age": S.avg("age", 2), "avg_risk_score": S.avg("risk_score", 3), "high_risk_count": S.cnt(HIGH),
    "high_risk_percentage": S.rate(HIGH, 2)}, "gold", S.WITH_GOLD))
def _(t):
    return _loaded(t, t.gold, daily.health_insights(unit="year"))


_RISKCAT = ("CASE WHEN outcome = 1 THEN 'HIGH_RISK' WHEN glucose > 126 OR bmi > 30 THEN 'MODERATE_RISK' WHEN glucose > 100 OR bmi > 25 THEN"
            " 'LOW_RISK' ELSE 'MINIMAL_RISK' END")


def _cat(v: str) -> str:
    return S.cnt(f"{_RISKCAT} = '{v}'")


@query("i8_insight_rates", _TIGHT + S.report({"aggregation_date": "processing_date"}, {
    "total_patients": S.cnt(), "high_risk_count": _cat("HIGH_RISK"), "moderate_risk_count": _cat("MODERATE_RISK"),
    "low_risk_count": _cat("LOW_RISK"), "avg_diabetes_risk_score": S.avg(S.r("100e0 / (1e0 + exp(-(" + f"{R.LOGISTIC_BIAS}e0 + " + " + ".join(
        f"{w}e0 * COALESCE({c}, {d})" for c, w, d in R.LOGISTIC_TERMS) + ")))", 2), 4),
    "obesity_rate": S.rate("bmi >= 30", 6), "diabetes_rate": S.rate("glucose >= 126", 6), "hypertension_rate": S.rate("blood_pressure >= 140", 6)},
    "(SELECT * FROM tight WHERE is_valid)"))
def _(t):
    return _loaded(t, layers.gold_insights(layers.silver_tagged(t.clinical)), daily.insight_rates(unit="year"))


# ---- whole jobs ------------------------------------------------------------
_CAPPED = ["glucose", "blood_pressure", "bmi", "insulin"]
_SILVER_JOB = S.WITH_CLINICAL + ", z AS (SELECT id, pregnancies, diabetes_pedigree_function, age, outcome, " + ", ".join(
    f"NULLIF({c}, 0) AS {c}" for c in R.ZERO_IS_MISSING) + " FROM clinical), q AS (SELECT " + ", ".join(
    f"quantile_cont({c}, 0.25) AS {c}_q1, quantile_cont({c}, 0.75) AS {c}_q3" for c in _CAPPED) + " FROM z), c AS (SELECT z.* REPLACE (" + ", ".join(
    f"CASE WHEN {c} < {c}_q1 - 1.5e0 * ({c}_q3 - {c}_q1) THEN {c}_q1 - 1.5e0 * ({c}_q3 - {c}_q1) WHEN {c} > {c}_q3 + 1.5e0 * ({c}_q3 - {c}_q1)"
    f" THEN {c}_q3 + 1.5e0 * ({c}_q3 - {c}_q1) ELSE {c} END AS {c}" for c in _CAPPED) + ") FROM z, q), m AS (SELECT " + ", ".join(
    f"AVG({c}) AS {c}_m" for c in R.ZERO_IS_MISSING) + " FROM c), silver AS (SELECT c.* EXCLUDE (outcome) REPLACE (" + ", ".join(
    f"COALESCE({c}, {c}_m) AS {c}" for c in R.ZERO_IS_MISSING) + "), outcome AS diabetes, 'COMPLETE' AS data_quality_flag FROM c, m) "


@query("i9_bronze_to_silver", _SILVER_JOB + "SELECT id, " + ", ".join(f"{S.r(c, 6)} AS {c}" for c in R.ZERO_IS_MISSING)
       + ", diabetes, data_quality_flag FROM silver")
def _(t):
    s = jobs.bronze_to_silver(t.clinical, exact_fences=True)
    return s.select("id", *[rnd(c, 6).alias(c) for c in R.ZERO_IS_MISSING], "diabetes", "data_quality_flag")


_G = _SILVER_JOB + ", mm AS (SELECT " + ", ".join(f"MIN({c}) AS {c}_lo, MAX({c}) AS {c}_hi" for c in ("glucose", "bmi", "age")) + " FROM silver) "
_LIN = "(" + " + ".join(f"{c} * {w}e0" for c, w in R.LINEAR_SCORE) + ") / 100e0"


@query("i9_silver_to_gold", _G + ", g AS (SELECT *, " + _LIN + f" AS risk_score, {S.ladder('bmi', R.BMI_SIMPLE)} AS bmi_category,"
       f" {S.ladder('glucose', R.GLUCOSE_THREE)} AS glucose_category FROM silver, mm), l AS (SELECT *, {S.ladder('risk_score', R.RISK_THREE)} AS lv FROM g)"
       " SELECT id, " + S.r("risk_score", 6) + " AS risk_score, bmi_category, glucose_category, lv AS health_risk_level, lv || '_Cost' AS"
       " estimated_cost_category, CASE WHEN glucose_category = 'Diabetic' OR bmi_category = 'Obese' THEN 'Immediate' WHEN glucose_category ="
       " 'Prediabetic' OR bmi_category = 'Overweight' THEN 'Soon' ELSE 'Routine' END AS intervention_priority, " + ", ".join(
           S.r(f"({c} - {c}_lo) / NULLIF(CAST({c}_hi - {c}_lo AS DOUBLE), 0)", 6) + f" AS {c}_normalized" for c in ("glucose", "bmi", "age")) + " FROM l")
def _(t):
    """The silver table is written first, as the job does, so each layer is computed once."""
    path = writers.scratch_path(t.spark, "i9-silver")
    jobs.bronze_to_silver(t.clinical, exact_fences=True).write.parquet(path)
    g = jobs.silver_to_gold(t.spark.read.parquet(path))
    return g.select("id", rnd("risk_score", 6).alias("risk_score"), "bmi_category", "glucose_category", "health_risk_level",
                    "estimated_cost_category", "intervention_priority",
                    *[rnd(f"{c}_normalized", 6).alias(f"{c}_normalized") for c in ("glucose", "bmi", "age")])


@query("i9_full_medallion", S.WITH_CLINICAL + "SELECT layer_name, CAST(COUNT(*) AS DOUBLE) AS metric_value, 'total_records' AS metric_name FROM clinical,"
       " (VALUES ('bronze'), ('silver'), ('gold')) v(layer_name) GROUP BY layer_name")
def _(t):
    """CSV in, three written layers out; the row count of each layer from its quality report."""
    root = writers.scratch_path(t.spark, "i9")
    t.clinical.select(*[C(new).alias(old) for old, new in R.COLUMN_NAMES.items()]).write.option("header", True).csv(f"{root}/source")
    out = jobs.medallion(t.spark, f"{root}/source", root, AT)
    return out.where(C("metric_name") == "total_records").select("layer_name", "metric_name", "metric_value")


@query("i9_clean_and_band", S.WITH_CLINICAL + ", z AS (SELECT id, pregnancies, age, " + ", ".join(
    f"NULLIF({c}, 0) AS {c}" for c in R.ZERO_IS_MISSING) + " FROM clinical), f AS (SELECT id, pregnancies, age, COALESCE(glucose, (SELECT AVG(glucose)"
    " FROM z)) AS glucose, COALESCE(bmi, (SELECT AVG(bmi) FROM z)) AS bmi FROM z) SELECT id, " + S.r("glucose", 6) + " AS glucose, " + S.r("bmi", 6)
    + f" AS bmi, {S.ladder('bmi', R.BMI_SIMPLE)} AS bmi_category, {S.ladder('age', R.AGE_THREE)} AS age_group,"
    f" {S.ladder('glucose', R.GLUCOSE_THREE)} AS glucose_category, {S.ladder('pregnancies', R.PREGNANCY_RISK)} AS pregnancy_risk FROM f")
def _(t):
    d = jobs.clean_diabetes(t.clinical)
    return d.select("id", rnd("glucose", 6).alias("glucose"), rnd("bmi", 6).alias("bmi"), "bmi_category", "age_group", "glucose_category",
                    "pregnancy_risk")


@query("i10_metric_snapshot", S.rows("metric_name", {
    "total_patients": {"metric_value": "CAST(COUNT(*) AS VARCHAR)", "metric_type": "'count'"},
    "diabetic_patients": {"metric_value": f"CAST({S.cnt(SICK)} AS VARCHAR)", "metric_type": "'count'"},
    "high_risk_patients": {"metric_value": f"CAST({S.cnt(HIGH)} AS VARCHAR)", "metric_type": "'count'"},
    "avg_glucose": {"metric_value": _text("AVG(glucose)", 1), "metric_type": "'average'"},
    "avg_bmi": {"metric_value": _text("AVG(bmi)", 1), "metric_type": "'average'"},
    "diabetes_rate": {"metric_value": _text(f"{S.cnt(SICK)} * 1e2 / COUNT(*)", 1), "metric_type": "'percentage'"},
    "high_risk_rate": {"metric_value": _text(f"{S.cnt(HIGH)} * 1e2 / COUNT(*)", 1), "metric_type": "'percentage'"}}, "gold", S.WITH_GOLD))
def _(t):
    """Upserted over an older snapshot that held two of the metrics."""
    new = I.metric_snapshot(t.gold)
    old = new.where(C("metric_type") == "average").withColumn("metric_value", F.lit("stale"))
    return I.upsert(old, new, ["metric_name"])


@query("i10_metric_snapshot_from_parts", ORACLES["i10_metric_snapshot"])
def _(t):
    """The same metrics refreshed from what two loads kept, without their rows."""
    spec = daily.snapshot_metrics(unit="year")
    return daily.snapshot(daily.read_parts(t.spark, _two_loads(t, t.gold, spec)), spec)


@query("i11_wearable_cleaning_job", CLEAN_WEARABLE + "SELECT person_id, gender, medical_conditions, " + S.r("heart_rate", 6) + " AS heart_rate, "
       + S.r("health_score", 6) + " AS health_score, health_risk_category, stress_level, mood, bmi_calculated, sleep_efficiency,"
       " CAST(timestamp_parsed AS DATE) AS day FROM people")
def _(t):
    path = writers.scratch_path(t.spark, "i11")
    writers.write_partitioned(jobs.clean_wearable(t.wearable), path, ["health_risk_category"])
    p = t.spark.read.parquet(path)
    return p.select("person_id", "gender", "medical_conditions", rnd("heart_rate", 6).alias("heart_rate"), rnd("health_score", 6).alias("health_score"),
                    "health_risk_category", "stress_level", "mood", "bmi_calculated", "sleep_efficiency", C("timestamp_parsed").cast("date").alias("day"))


@query("i12_load_clean_export", S.WITH_FEATURES + "SELECT bmi_category, COUNT(*) AS total_count, " + S.rate("outcome = 1", 2)
       + " AS diabetes_rate FROM features GROUP BY bmi_category")
def _(t):
    """Append to bronze, clean, build features, export the report as JSON, read it back."""
    root = writers.scratch_path(t.spark, "i12")
    writers.append(t.clinical, f"{root}/bronze")
    features = layers.gold_features(layers.silver_basic(t.spark.read.parquet(f"{root}/bronze")))
    writers.write_json(reports.bmi_category_analysis(features), f"{root}/report")
    return t.spark.read.schema("bmi_category string, total_count bigint, diabetes_rate double").json(f"{root}/report")


def _resumed_load(t):
    """Bronze, features and report as a job whose second stage fails at first and which is then started again."""
    tries, ticks = [], iter(range(1000))

    def features(done):
        tries.append(1)
        if len(tries) == 1:
            raise RuntimeError("no space left")
        return layers.gold_features(layers.silver_basic(done["bronze"]))

    stages = [("bronze", lambda _: t.clinical), ("features", features), ("report", lambda done: reports.bmi_category_analysis(done["features"]))]
    job = runner.Job(t.spark, writers.scratch_path(t.spark, "i12-job"), "load", stages, lambda: AT + dt.timedelta(seconds=next(ticks)))
    try:
        job.run("run-1")
    except RuntimeError:
        pass
    return job, job.run("run-1")


@query("i12_resumed_load", ORACLES["i12_load_clean_export"])
def _(t):
    return _resumed_load(t)[1].select("bmi_category", "total_count", "diabetes_rate")


@query("i6_run_log_of_a_resumed_job", S.WITH_FEATURES + "SELECT 'bronze' AS stage, 'completed' AS status, COUNT(*) AS records, 1 AS starts, 0 AS failures,"
       " 1e0 AS duration_seconds FROM clinical UNION ALL SELECT 'features', 'completed', COUNT(*), 2, 1, 3e0 FROM features UNION ALL"
       " SELECT 'report', 'completed', COUNT(DISTINCT bmi_category), 1, 0, 1e0 FROM features")
def _(t):
    """What the job wrote about itself: the finished first stage was started once, the failed one twice."""
    log = _resumed_load(t)[0].log()
    states = I.run_states(log).select(C("pipeline_stage").alias("stage"), "status", C("records_processed").alias("records"), "duration_seconds")
    counts = report(log, {"stage": "pipeline_stage"}, {"starts": F.count_if(C("status") == "running").cast("int"),
                                                       "failures": F.count_if(C("status") == "failed").cast("int")})
    return states.join(counts, "stage")


@query("i13_processing_report", S.WITH_GOLD + "SELECT 0 AS section, 'Processing report 2024-01-15 12:00:00' AS line FROM gold GROUP BY 1 UNION ALL SELECT 1,"
       " 'bronze: ' || COUNT(*) || ' records' FROM clinical UNION ALL SELECT 1, 'gold: ' || COUNT(*) || ' records' FROM gold UNION ALL SELECT 2,"
       " 'records: ' || COUNT(*) || '.0 (ok)' FROM gold")
def _(t):
    counts = reports.layer_counts({"bronze": t.clinical, "gold": t.gold})
    checks = Q.threshold_rows(t.gold.agg(n().alias("n")), [("records", C("n"), C("n") > 0, "fail")])
    return jobs.processing_report(counts, checks, AT)


@query("v1_daily_stats_loaded", ORACLES["v1_daily_stats"])
def _(t):
    return _loaded(t, t.features, daily.daily_stats(unit="year"))


@query("v6_enhanced_daily_stats_loaded", ORACLES["v6_enhanced_daily_stats"])
def _(t):
    return _loaded(t, t.gold, daily.enhanced_daily_stats(unit="year"))


@query("u5_refresh_procedure", S.WITH_GOLD + "SELECT COUNT(DISTINCT processing_date) AS days, COUNT(*) AS patients FROM gold")
def _(t):
    """Refresh of the daily table as a job: aggregate, rewrite its partitions, read back."""
    path = writers.scratch_path(t.spark, "u5")
    stats = daily.daily_statistics().full(t.gold).withColumn("stat_year", F.year("stat_date"))
    I.rebuild_partitions(stats, path, ["stat_year"])
    return t.spark.read.parquet(path).agg(n().alias("days"), F.sum("total_records").alias("patients"))
