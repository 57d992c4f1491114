"""Projections that give tables their older column names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Current name -> older name
BRONZE_OLD_NAMES = {
    "pregnancies": "pregnancies", "glucose": "glucose", "blood_pressure": "bloodpressure",
    "skin_thickness": "skinthickness", "insulin": "insulin", "bmi": "bmi",
    "diabetes_pedigree_function": "diabetespedigreefunction", "age": "age", "outcome": "outcome",
}
GOLD_COLUMNS = [
    "pregnancies", "glucose", "blood_pressure", "skin_thickness", "insulin", "bmi", "diabetes_pedigree_function", "age",
    "diabetes", "bmi_category", "age_group", "glucose_category", "bp_category", "risk_score", "prediction",
    "prediction_probability", "glucose_bmi_interaction", "age_glucose_interaction", "insulin_glucose_interaction",
    "age_bmi_interaction", "glucose_normalized", "bmi_normalized", "age_normalized", "bp_normalized",
    "insulin_normalized", "health_risk_level", "intervention_priority", "estimated_cost_category",
    "metabolic_syndrome_risk", "cardiovascular_risk", "pregnancy_risk_factor", "lifestyle_risk_score", "quality_score",
    "processing_date",
]


def project(df: DataFrame, names: dict[str, str] | list[str]) -> DataFrame:
    pairs = names.items() if isinstance(names, dict) else [(c, c) for c in names]
    return df.select(*[F.col(old).alias(new) for old, new in pairs])
