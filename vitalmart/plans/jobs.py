"""End-to-end jobs: ingest, medallion, wearable cleaning."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalmart.functions.bands import band, first_match, recode_text
from vitalmart.functions.numeric import plain_text, ratio, rnd
from vitalmart.operators import quality as Q
from vitalmart.operators.clean import rename, zero_to_null
from vitalmart.operators.statistics import cap_outliers, impute, min_max, outliers_to_null
from vitalmart.rules import clinical as R
from vitalmart.sources.readers import read_csv, read_parquet
from vitalmart.sources.schemas import CLINICAL_RAW
from vitalmart.sources.writers import add_lineage, ingest_metadata, write_bronze, write_partitioned

C = F.col


def ingest(spark: SparkSession, source: str, target: str, dataset: str, at: datetime, required: list[str]) -> DataFrame:
    """CSV to bronze (Parquet and CSV copies) with lineage; returns the metadata row."""
    raw = read_csv(spark, source, CLINICAL_RAW)
    Q.require_rows(Q.require_columns(raw, required))
    stamped = add_lineage(raw, F.lit(at), dataset)
    write_bronze(stamped, f"{target}/parquet", f"{target}/csv")
    meta = ingest_metadata(read_parquet(spark, f"{target}/parquet"), dataset, source, target, F.lit(at))
    meta.write.mode("overwrite").json(f"{target}/metadata")
    return meta


def bronze_to_silver(raw: DataFrame, exact_fences: bool = False) -> DataFrame:
    """Zeros to NULL, outliers capped at the fences, gaps filled by the mean, completeness flag.

    All statistics of a step come from one aggregate over the step's input.
    """
    capped = cap_outliers(zero_to_null(rename(raw, R.COLUMN_NAMES), R.ZERO_IS_MISSING),
                          ["glucose", "blood_pressure", "bmi", "insulin"], exact=exact_fences)
    filled = impute(capped, mean=R.ZERO_IS_MISSING).withColumnRenamed("outcome", "diabetes")
    return filled.withColumn("data_quality_flag", completeness_flag(["glucose", "blood_pressure", "bmi"]))


def completeness_flag(columns: list[str]) -> Column:
    whole = C(columns[0]).isNotNull()
    for c in columns[1:]:
        whole = whole & C(c).isNotNull()
    return F.when(whole, F.lit("COMPLETE")).otherwise(F.lit("INCOMPLETE"))


def clean_diabetes(raw: DataFrame) -> DataFrame:
    """Earlier cleaning: zeros to NULL, means (median for insulin), bands."""
    filled = impute(zero_to_null(rename(raw, R.COLUMN_NAMES), R.ZERO_IS_MISSING),
                    mean=["glucose", "blood_pressure", "skin_thickness", "bmi"], median=["insulin"])
    return filled.withColumns({
        "bmi_category": band("bmi", R.BMI_SIMPLE), "age_group": band("age", R.AGE_THREE),
        "glucose_category": band("glucose", R.GLUCOSE_THREE), "pregnancy_risk": band("pregnancies", R.PREGNANCY_RISK)})


def silver_to_gold(silver: DataFrame) -> DataFrame:
    """Bands, linear risk score, interactions, data-range scaling and business labels."""
    featured = silver.withColumns({
        "bmi_category": band("bmi", R.BMI_SIMPLE), "age_group": band("age", R.AGE_THREE),
        "glucose_category": band("glucose", R.GLUCOSE_THREE), "bp_category": band("blood_pressure", R.PRESSURE_THREE),
        "risk_score": sum((C(c) * F.lit(w) for c, w in R.LINEAR_SCORE[1:]), C(R.LINEAR_SCORE[0][0]) * F.lit(R.LINEAR_SCORE[0][1]))
                      / F.lit(100.0),
        "glucose_bmi_interaction": C("glucose") * C("bmi"), "age_glucose_interaction": C("age") * C("glucose")})
    scaled = min_max(featured, ["glucose", "bmi", "age"])
    either = lambda g, b: (C("glucose_category") == g) | (C("bmi_category") == b)
    levelled = scaled.withColumns({
        "health_risk_level": band("risk_score", R.RISK_THREE),
        "intervention_priority": first_match([(either("Diabetic", "Obese"), "Immediate"),
                                              (either("Prediabetic", "Overweight"), "Soon")], "Routine")})
    return levelled.withColumn("estimated_cost_category", F.concat(C("health_risk_level"), F.lit("_Cost")))


def medallion(spark: SparkSession, source_csv: str, root: str, at: datetime) -> DataFrame:
    """Bronze, silver and gold in order, each written before the next reads it; returns quality rows."""
    ingest(spark, source_csv, f"{root}/bronze", "clinical", at, ["Glucose", "Outcome"])
    bronze = read_parquet(spark, f"{root}/bronze/parquet")
    keep = list(R.COLUMN_NAMES)
    silver = bronze_to_silver(bronze.select(*keep)).withColumns(
        {"processed_timestamp": F.lit(at), "data_source": F.lit("bronze_layer"), "processing_version": F.lit("1.0")})
    silver.write.mode("overwrite").parquet(f"{root}/silver")
    gold = silver_to_gold(read_parquet(spark, f"{root}/silver"))
    write_partitioned(gold.withColumn("processing_date", C("processed_timestamp").cast("date")), f"{root}/gold",
                      ["processing_date"])
    meta = ["processed_timestamp", "data_source", "processing_version", "ingestion_timestamp", "dataset_name",
            "ingestion_version"]
    layers = {"bronze": bronze, "silver": read_parquet(spark, f"{root}/silver"), "gold": read_parquet(spark, f"{root}/gold")}
    reports = [Q.layer_report(df, name, skip=meta) for name, df in layers.items()]
    return reports[0].unionByName(reports[1]).unionByName(reports[2])


def clean_wearable(raw: DataFrame) -> DataFrame:
    """Recode texts, drop impossible heart rates, ratios, risk band, time stamp, fill gaps."""
    recoded = raw.withColumns({
        "gender": recode_text("gender", {"male": "Male", "female": "Female"}, "Other"),
        "medical_conditions": recode_text("medical_conditions", {"none": None}, C("medical_conditions"))})
    bounded = outliers_to_null(recoded, ["heart_rate"])
    derived = bounded.withColumns({
        "bmi_calculated": rnd(ratio("weight", (C("height") / 100.0) * (C("height") / 100.0)), 2),
        "sleep_efficiency": rnd(ratio(C("deep_sleep_duration") + C("rem_sleep_duration"), "sleep_duration") * 100, 2),
        "health_risk_category": band("health_score", R.HEALTH_SCORE),
        "timestamp_parsed": F.try_to_timestamp(C("timestamp"), F.lit("yyyy-MM-dd HH:mm:ss"))})
    return impute(derived, mean=["health_score", "heart_rate"], constant={"stress_level": "Unknown", "mood": "Unknown"})


def processing_report(counts: DataFrame, checks: DataFrame, at: datetime) -> DataFrame:
    """Text lines of one run: rows per layer and the check results (both are small reports)."""
    head = counts.sparkSession.createDataFrame([(0, f"Processing report {at:%Y-%m-%d %H:%M:%S}")], "section int, line string")
    layers = counts.select(F.lit(1).alias("section"),
                           F.format_string("%s: %d records", C("layer"), C("record_count")).alias("line"))
    results = checks.select(F.lit(2).alias("section"), F.format_string(
        "%s: %s (%s)", C("check_name"), plain_text("value"), F.when(C("passed"), F.lit("ok")).otherwise(C("severity")))
        .alias("line"))
    return head.unionByName(layers).unionByName(results).orderBy("section", "line")
