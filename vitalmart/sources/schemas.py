"""Declared schemas and the clinical shape of the sample star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalmart.functions.reuse import per_context

_D, _I, _S = T.DoubleType(), T.IntegerType(), T.StringType()

CLINICAL_RAW = T.StructType([
    T.StructField("Pregnancies", _I), T.StructField("Glucose", _D), T.StructField("BloodPressure", _D),
    T.StructField("SkinThickness", _D), T.StructField("Insulin", _D), T.StructField("BMI", _D),
    T.StructField("DiabetesPedigreeFunction", _D), T.StructField("Age", _I), T.StructField("Outcome", _I),
])

WEARABLE_RAW = T.StructType([
    T.StructField("Person_ID", _S), T.StructField("Age", _I), T.StructField("Gender", _S),
    T.StructField("Height", _D), T.StructField("Weight", _D), T.StructField("Heart_Rate", _D),
    T.StructField("Blood_Pressure_Systolic", _D), T.StructField("Blood_Pressure_Diastolic", _D),
    T.StructField("Sleep_Duration", _D), T.StructField("Deep_Sleep_Duration", _D),
    T.StructField("REM_Sleep_Duration", _D), T.StructField("Steps_Daily", _I),
    T.StructField("Exercise_Minutes", _D), T.StructField("Stress_Level", _S), T.StructField("Mood", _S),
    T.StructField("Health_Score", _D), T.StructField("Medical_Conditions", _S), T.StructField("Timestamp", _S),
])


def clinical_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """The nine clinical measures plus key and dates, computed from order lines."""
    return lineitem.select(*_clinical_columns())


@per_context
def _clinical_columns() -> list[Column]:
    qty, price = F.col("l_quantity"), F.col("l_extendedprice")
    return [
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("bigint").alias("id"),
        (F.col("l_partkey") % 18).cast("int").alias("pregnancies"),
        F.when(qty == 1, F.lit(0.0)).otherwise(F.floor(price / 500.0).cast("double")).alias("glucose"),
        F.when(F.col("l_linenumber") == 7, F.lit(0.0))
         .otherwise(F.lit(60.0) + F.round(F.col("l_tax") * 1000.0)).alias("blood_pressure"),
        F.round(F.col("l_discount") * 1000.0).alias("skin_thickness"),
        (F.col("l_orderkey") % 847).cast("double").alias("insulin"),
        F.when((F.col("l_returnflag") == "A") & (F.col("l_linenumber") == 1), F.lit(0.0))
         .otherwise(qty + 15.5).alias("bmi"),
        (F.lit(0.078) + (F.col("l_partkey") % 235) * F.lit(0.01)).alias("diabetes_pedigree_function"),
        (F.lit(21) + F.col("l_orderkey") % 61).cast("int").alias("age"),
        (F.col("l_returnflag") == "R").cast("int").alias("outcome"),
        F.col("l_shipdate").cast("date").alias("processing_date"),
        (F.col("l_shipdate") + F.make_dt_interval(hours=F.col("l_orderkey") % 24, mins=F.col("l_partkey") % 60))
        .alias("processed_timestamp"),
    ]


def wearable_from_orders(orders: DataFrame) -> DataFrame:
    """A wearable-device reading per order: the personal-health shape on driver tables."""
    key, cust, price = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_totalprice")
    return orders.select(
        key.cast("string").alias("person_id"),
        (F.lit(18) + cust % 70).cast("int").alias("age"),
        F.element_at(F.array(*[F.lit(v) for v in (" Male", "FEMALE ", "other")]), (key % 3 + 1).cast("int"))
         .alias("gender"),
        (F.lit(150.0) + key % 50).alias("height"),
        (F.lit(45.0) + cust % 80).alias("weight"),
        F.when(key % 101 == 0, F.lit(230.0)).otherwise(F.lit(55.0) + cust % 45).alias("heart_rate"),
        (F.lit(6.0) + key % 4).alias("sleep_duration"),
        (F.lit(1.0) + cust % 3).alias("deep_sleep_duration"),
        (F.lit(1.0) + key % 2).alias("rem_sleep_duration"),
        (F.lit(2000) + cust % 9000).cast("int").alias("steps_daily"),
        F.when(key % 7 == 0, F.lit(None).cast("double")).otherwise(F.floor(price / 5000.0).cast("double"))
         .alias("health_score"),
        F.when(key % 11 == 0, F.lit(None).cast("string")).otherwise(F.col("o_orderpriority")).alias("stress_level"),
        F.when(key % 13 == 0, F.lit(None).cast("string")).otherwise(F.col("o_orderstatus")).alias("mood"),
        F.when(key % 5 == 0, F.lit("None ")).otherwise(F.lit("Asthma")).alias("medical_conditions"),
        F.date_format(F.col("o_orderdate"), "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
    )
