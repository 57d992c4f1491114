"""Clinical rule pack.

Everything here is a fixed value that results depend on: band edges and labels,
validity bounds, score weights, texts and thresholds. Logic lives in
``functions`` and ``plans``.
"""

from __future__ import annotations

from typing import NamedTuple

from vitalmart.functions.bands import Ladder


class Bounds(NamedTuple):
    lo: float
    hi: float
    lo_open: bool  # True: x must be above lo, False: lo itself is fine


MEASURES = ["pregnancies", "glucose", "blood_pressure", "skin_thickness", "insulin", "bmi",
            "diabetes_pedigree_function", "age"]

# CamelCase source names -> column names
COLUMN_NAMES = {
    "Pregnancies": "pregnancies",
    "Glucose": "glucose",
    "BloodPressure": "blood_pressure",
    "SkinThickness": "skin_thickness",
    "Insulin": "insulin",
    "BMI": "bmi",
    "DiabetesPedigreeFunction": "diabetes_pedigree_function",
    "Age": "age",
    "Outcome": "outcome",
}

WEARABLE_COLUMN_NAMES = {
    "Person_ID": "person_id",
    "Age": "age",
    "Gender": "gender",
    "Height": "height",
    "Weight": "weight",
    "Heart_Rate": "heart_rate",
    "Blood_Pressure_Systolic": "blood_pressure_systolic",
    "Blood_Pressure_Diastolic": "blood_pressure_diastolic",
    "Sleep_Duration": "sleep_duration",
    "Deep_Sleep_Duration": "deep_sleep_duration",
    "REM_Sleep_Duration": "rem_sleep_duration",
    "Steps_Daily": "steps_daily",
    "Exercise_Minutes": "exercise_minutes",
    "Stress_Level": "stress_level",
    "Mood": "mood",
    "Health_Score": "health_score",
    "Medical_Conditions": "medical_conditions",
    "Timestamp": "timestamp",
}

# Measurements where 0 means "not measured"
ZERO_IS_MISSING = ["glucose", "blood_pressure", "skin_thickness", "insulin", "bmi"]

# ---- validity bounds -------------------------------------------------------
STANDARD_BOUNDS = {
    "glucose": Bounds(0, 400, True),
    "blood_pressure": Bounds(0, 250, True),
    "skin_thickness": Bounds(0, 100, False),
    "insulin": Bounds(0, 1000, False),
    "bmi": Bounds(0, 80, True),
}
STANDARD_VALIDITY = {
    "glucose": Bounds(0, 400, True),
    "bmi": Bounds(0, 80, True),
    "age": Bounds(0, 120, True),
    "blood_pressure": Bounds(0, 250, True),
    "pregnancies": Bounds(0, 20, False),
}
TIGHT_BOUNDS = {
    "glucose": Bounds(0, 400, True),
    "blood_pressure": Bounds(0, 250, True),
    "skin_thickness": Bounds(0, 100, False),
    "insulin": Bounds(0, 1000, False),
    "bmi": Bounds(0, 70, True),
    "diabetes_pedigree_function": Bounds(0, 3, False),
    "age": Bounds(18, 120, False),
}
TIGHT_VALIDITY = {
    "glucose": Bounds(0, 400, True),
    "blood_pressure": Bounds(0, 250, True),
    "bmi": Bounds(0, 70, True),
    "age": Bounds(18, 120, False),
}
# Ranges a whole table is checked against (inclusive on both ends)
EXPECTED_RANGES = {
    "pregnancies": (0, 20),
    "glucose": (0, 300),
    "blood_pressure": (0, 200),
    "skin_thickness": (0, 100),
    "insulin": (0, 1000),
    "bmi": (0, 80),
    "diabetes_pedigree_function": (0, 5),
    "age": (0, 120),
    "outcome": (0, 1),
}
# Points per in-range field in the 0..100 quality score
COMPOSITE_QUALITY = {
    "glucose": (Bounds(0, 400, True), 20),
    "blood_pressure": (Bounds(0, 250, True), 20),
    "bmi": (Bounds(0, 80, True), 20),
    "age": (Bounds(0, 120, False), 20),
    "skin_thickness": (Bounds(0, 100, False), 10),
    "insulin": (Bounds(0, 1000, False), 10),
}

# ---- band ladders ----------------------------------------------------------
BMI_SIMPLE = Ladder((18.5, 25, 30), ("Underweight", "Normal", "Overweight", "Obese"))
BMI_WHO = Ladder((16, 18.5, 25, 30, 35, 40),
                 ("Severely Underweight", "Underweight", "Normal Weight", "Overweight",
                  "Obese Class I", "Obese Class II", "Obese Class III"), null=None)
BMI_SNAKE = Ladder((18.5, 25, 30, 35, 40),
                   ("underweight", "normal", "overweight", "obese_class_1", "obese_class_2", "obese_class_3"),
                   null=None)
BMI_CUT = Ladder((18.5, 25, 30), ("Underweight", "Normal", "Overweight", "Obese"),
                 closed="right", null="nan", floor=0.0)

AGE_THREE = Ladder((30, 50), ("Young", "Middle", "Senior"))
AGE_THREE_HYPHEN = Ladder((30, 50), ("Young", "Middle-aged", "Senior"), null=None)
AGE_DETAILED = Ladder((25, 35, 45, 55, 65),
                      ("Young Adult (18-24)", "Adult (25-34)", "Middle-aged (35-44)", "Mature (45-54)",
                       "Pre-senior (55-64)", "Senior (65+)"), null=None)
AGE_SNAKE = Ladder((30, 45, 60), ("young_adult", "adult", "middle_aged", "senior"), null=None)
AGE_RANGES = Ladder((30, 50, 65), ("Young (< 30)", "Middle (30-49)", "Mature (50-64)", "Senior (65+)"))
AGE_DECADES = Ladder((30, 40, 50, 60), ("20-29", "30-39", "40-49", "50-59", "60+"), null=None)
AGE_CUT = Ladder((25, 35, 45, 55), ("18-25", "26-35", "36-45", "46-55", "55+"),
                 closed="right", null="nan", floor=0.0)

GLUCOSE_THREE = Ladder((100, 126), ("Normal", "Prediabetic", "Diabetic"))
GLUCOSE_ADA = Ladder((70, 100, 126, 200),
                     ("Hypoglycemic", "Normal", "Prediabetic", "Diabetic", "Severely Diabetic"), null=None)
GLUCOSE_SNAKE = Ladder((70, 100, 126), ("hypoglycemic", "normal", "prediabetic", "diabetic"), null=None)
GLUCOSE_FOUR = Ladder((70, 100, 126), ("Low", "Normal", "Pre-diabetic", "Diabetic"))
GLUCOSE_140 = Ladder((100, 140), ("Normal (<100)", "Pre-diabetic (100-139)", "Diabetic (140+)"))
GLUCOSE_HISTOGRAM = Ladder((70, 100, 126),
                           ("Hypoglycemic (<70)", "Normal (70-99)", "Pre-diabetic (100-125)", "Diabetic (≥126)"),
                           null=None)
GLUCOSE_CUT = Ladder((100, 125, 200), ("Normal", "Prediabetic", "Diabetic", "Severe"),
                     closed="right", null="nan", floor=0.0)

PRESSURE_THREE = Ladder((80, 90), ("Normal", "High_Normal", "High"))
PRESSURE_AHA = Ladder((80, 120, 130, 140, 180),
                      ("Low", "Normal", "Elevated", "High Stage 1", "High Stage 2", "Hypertensive Crisis"), null=None)
PRESSURE_SNAKE = Ladder((90, 120, 140, 160),
                        ("hypotensive", "normal", "elevated", "stage_1_hypertension", "stage_2_hypertension"),
                        null=None)
PRESSURE_ELEVATED = Ladder((120, 140), ("Normal", "Elevated", "High"), null=None)
PRESSURE_CUT = Ladder((80, 90, 140), ("Normal", "Elevated", "High", "Very High"),
                      closed="right", null="nan", floor=0.0)
PRESSURE_CUT_100 = Ladder((80, 90, 100), ("Normal", "Elevated", "High", "Very High"),
                          closed="right", null="nan", floor=0.0)

# insulin 0 is "not measured"; the ladder below starts after that test
INSULIN_NOT_MEASURED = "Not Measured"
INSULIN_LEVELS = Ladder((16, 25), ("Normal", "Elevated", "High"), null=None)

PREGNANCY_RISK = Ladder((0, 2, 5), ("No_Pregnancy", "Low_Risk", "Medium_Risk", "High_Risk"), closed="right")
PREGNANCY_PARITY = Ladder((0, 2, 4), ("Nulliparous", "Low Parity", "Moderate Parity", "High Parity"),
                          closed="right", null=None)
PREGNANCY_GROUPS = Ladder((0, 2, 5), ("No Pregnancy", "1-2 Pregnancies", "3-5 Pregnancies", "6+ Pregnancies"),
                          closed="right", null=None)

RISK_THREE = Ladder((0.3, 0.6), ("Low", "Medium", "High"))
RISK_THREE_TEXT = Ladder((0.3, 0.6), ("Low Risk", "Medium Risk", "High Risk"), null=None)
RISK_CUT = Ladder((0.3, 0.6, 0.8), ("Low", "Medium", "High", "Critical"), closed="right")
RISK_SNAPSHOT = Ladder((0.3, 0.5, 0.7), ("Low", "Medium", "High", "Critical"), closed="right", null="Low")
POPULATION_RISK = Ladder((0.3, 0.5, 0.7), ("Low Risk Population", "Moderate Risk Population",
                                           "High Risk Population", "Critical Risk Population"), null=None)
HEALTH_SCORE = Ladder((40, 60, 80), ("Critical_Risk", "High_Risk", "Medium_Risk", "Low_Risk"), null="Critical_Risk")
QUALITY_RATING = Ladder((0.70, 0.85, 0.95), ("Needs Improvement", "Acceptable", "Good", "Excellent"),
                        null="Needs Improvement")

# Band tables: name, lowest, highest (both inclusive as published), extra value
RISK_TABLE = [("Low Risk", 0.00, 0.30, "#28a745"), ("Moderate Risk", 0.31, 0.60, "#ffc107"),
              ("High Risk", 0.61, 0.80, "#fd7e14"), ("Critical Risk", 0.81, 1.00, "#dc3545")]
BMI_TABLE = [("Underweight", 0.0, 18.4, 1.1), ("Normal Weight", 18.5, 24.9, 1.0), ("Overweight", 25.0, 29.9, 1.3),
             ("Obese Class I", 30.0, 34.9, 1.6), ("Obese Class II", 35.0, 39.9, 2.0),
             ("Obese Class III", 40.0, 99.9, 2.5)]

# ---- custom orders ---------------------------------------------------------
RISK_ORDER = ["Critical", "High", "Medium", "Low"]
PRIORITY_ORDER = ["Immediate", "Soon", "Routine", "Monitor"]
FOLLOWUP_ORDER = ["Weekly", "Monthly", "Quarterly"]
GLUCOSE_ORDER = ["Hypoglycemic", "Normal", "Prediabetic", "Diabetic"]
GLUCOSE_FOUR_ORDER = ["Low", "Normal", "Pre-diabetic", "Diabetic"]
CATEGORY_ORDER = ["High", "Medium", "Low"]

# ---- scores ----------------------------------------------------------------
# divisor and weight of the clamped-ratio score
RATIO_SCORE = [("glucose", 200.0, 0.25), ("bmi", 50.0, 0.20), ("age", 100.0, 0.15), ("blood_pressure", 200.0, 0.15),
               ("diabetes_pedigree_function", 2.0, 0.15), ("pregnancies", 15.0, 0.10)]
# weight per raw unit, total divided by 100
LINEAR_SCORE = [("glucose", 0.3), ("bmi", 0.2), ("age", 0.1), ("blood_pressure", 0.1),
                ("diabetes_pedigree_function", 20.0), ("pregnancies", 0.5)]
# bias; column, weight, value used for NULL
LOGISTIC_BIAS = -8.4
LOGISTIC_TERMS = [("pregnancies", 0.12, 0), ("glucose", 0.04, 120), ("blood_pressure", 0.01, 80),
                  ("skin_thickness", 0.001, 20), ("insulin", 0.001, 80), ("bmi", 0.09, 25),
                  ("diabetes_pedigree_function", 0.95, 0.5), ("age", 0.02, 35)]
# divisor and weight of the capped score (0 when glucose, bmi or age is NULL)
CAPPED_SCORE = [("glucose", 200.0, 0.4), ("bmi", 50.0, 0.3), ("age", 100.0, 0.2), ("pregnancies", 10.0, 0.1)]
# fixed scaling ranges and weights of the normalised score
SCALING_RANGES = {"glucose": (50, 300), "bmi": (15, 50), "age": (18, 80), "blood_pressure": (40, 180),
                  "insulin": (0, 500)}
NORMALISED_WEIGHTS = {"glucose": 0.25, "bmi": 0.20, "age": 0.15, "blood_pressure": 0.15, "insulin": 0.10}
NORMALISED_TAIL = [("diabetes_pedigree_function", 3.0, 0.10), ("pregnancies", 15.0, 0.05)]
# column, divisor, weight of the compact score; the pedigree term has no divisor
COMPACT_SCORE = [("glucose", 200.0, 0.3), ("bmi", 50.0, 0.2), ("age", 100.0, 0.2), ("blood_pressure", 200.0, 0.1),
                 ("diabetes_pedigree_function", 1.0, 0.2)]
# column, divisor, value used for NULL; summed and times 100
UNWEIGHTED_SCORE = [("glucose", 200.0, 120), ("bmi", 50.0, 25), ("age", 100.0, 35)]
# centre and weight of the deviation score
DEVIATION_TERMS = [("glucose", 120.0, 0.3), ("bmi", 25.0, 0.3), ("age", 35.0, 0.2), ("blood_pressure", 80.0, 0.2)]
# population mean and standard deviation
POPULATION = {"glucose": (120.89, 31.97), "bmi": (31.99, 7.88), "age": (33.24, 11.76),
              "blood_pressure": (69.11, 19.36), "insulin": (79.8, 115.24)}
DIVISOR_SCALING = {"glucose": 200.0, "bmi": 50.0, "age": 100.0, "blood_pressure": 200.0, "insulin": 500.0}

# two factors and the scale of each interaction feature
INTERACTIONS_GOLD = {
    "glucose_bmi_interaction": ("glucose", "bmi", 3000.0),
    "age_glucose_interaction": ("age", "glucose", 5000.0),
    "insulin_glucose_interaction": ("insulin", "glucose", 50000.0),
    "age_bmi_interaction": ("age", "bmi", 2000.0),
    "bp_bmi_interaction": ("blood_pressure", "bmi", 3000.0),
    "pregnancy_glucose_interaction": ("pregnancies", "glucose", 500.0),
}
INTERACTIONS_SCALED = {
    "glucose_bmi_interaction": ("glucose", "bmi", 1000.0),
    "age_glucose_interaction": ("age", "glucose", 100.0),
    "insulin_glucose_interaction": ("insulin", "glucose", 1000.0),
    "age_bmi_interaction": ("age", "bmi", 100.0),
}
INTERACTIONS_COMPACT = {
    "glucose_bmi_interaction": ("glucose", "bmi", 1000.0),
    "age_glucose_interaction": ("age", "glucose", 1000.0),
    "insulin_glucose_interaction": ("insulin", "glucose", 10000.0),
    "age_bmi_interaction": ("age", "bmi", 1000.0),
}
FEATURE_IMPORTANCE = {"glucose": 0.25, "bmi": 0.20, "age": 0.15, "blood_pressure": 0.15,
                      "diabetes_pedigree_function": 0.15, "pregnancies": 0.10}

# ---- costs -----------------------------------------------------------------
ANNUAL_COST = {"Very High": 50000, "High": 25000, "Medium": 10000}
ANNUAL_COST_OTHER = 3000
PREVENTION_SAVING = 15000
KPI_COST = {"High": 10000, "Medium": 5000, "Low": 2000}
IMPACT_COST = {"High": 15000, "Medium": 8000, "Low": 3000}
IMPACT_PREVENTION_SAVING = 25000
LEVEL_TO_COST = {"Critical": "Very High", "High": "High", "Medium": "Medium", "Low": "Low"}

# ---- rules over several measures -------------------------------------------
# Fixed values. A level holds when any of its rules does, a rule when all its limits do:
# (measure, comparison, limit). The first level that holds counts.
PREDICTION = [[("glucose", ">=", 126)],
              [("bmi", ">=", 30), ("glucose", ">=", 100)],
              [("age", ">=", 45), ("glucose", ">=", 110), ("bmi", ">=", 25)]]
HEALTH_RISK = [
    ("Critical", [[("glucose", ">=", 200)], [("bmi", ">=", 40)], [("glucose", ">=", 180), ("bmi", ">=", 35)], [("blood_pressure", ">=", 180)]]),
    ("High", [[("glucose", ">=", 140)], [("bmi", ">=", 30)], [("glucose", ">=", 126), ("bmi", ">=", 25)], [("age", ">=", 60), ("glucose", ">=", 110)]]),
    ("Medium", [[("glucose", ">=", 110)], [("bmi", ">=", 25)], [("age", ">=", 45), ("glucose", ">=", 100)]]),
]
HEALTH_RISK_DEFAULT = "Low"
INTERVENTION = [
    ("Immediate", [[("glucose", ">=", 200)], [("bmi", ">=", 40)], [("blood_pressure", ">=", 180)]]),
    ("Soon", [[("glucose", ">=", 140)], [("bmi", ">=", 30)], [("blood_pressure", ">=", 160)]]),
    ("Routine", [[("glucose", ">=", 110)], [("bmi", ">=", 25)], [("blood_pressure", ">=", 140)]]),
]
INTERVENTION_DEFAULT = "Monitor"
COST = [
    ("Very High", [[("glucose", ">=", 200)], [("bmi", ">=", 40)]]),
    ("High", [[("glucose", ">=", 140)], [("bmi", ">=", 30)]]),
    ("Medium", [[("glucose", ">=", 110)], [("bmi", ">=", 25)]]),
]
COST_DEFAULT = "Low"
FOLLOWUP = [
    ("Weekly", [[("glucose", ">=", 200)], [("bmi", ">=", 40)]]),
    ("Monthly", [[("glucose", ">=", 140)], [("bmi", ">=", 30)]]),
    ("Quarterly", [[("glucose", ">=", 110)], [("bmi", ">=", 25)]]),
]
FOLLOWUP_DEFAULT = "Annually"
REFERRAL = [[("glucose", ">=", 140)], [("bmi", ">=", 35)], [("blood_pressure", ">=", 160)], [("glucose", ">=", 126), ("pregnancies", ">", 0)]]
HIGH_RISK = [[("glucose", ">", 140), ("bmi", ">", 30)], [("glucose", ">", 160)], [("bmi", ">", 35)], [("age", ">", 60), ("glucose", ">", 120)]]
# Points of the first step that holds, per measure.
POINT_STEPS = [
    ("glucose", [(">=", 126, 3), (">=", 100, 2)]),
    ("bmi", [(">=", 30, 2), (">=", 25, 1)]),
    ("age", [(">=", 65, 2), (">=", 50, 1)]),
    ("pregnancies", [(">", 5, 1)]),
    ("diabetes_pedigree_function", [(">", 0.5, 1)]),
]

# ---- texts -----------------------------------------------------------------
TREATMENT = [
    ("Immediate endocrinologist referral, insulin therapy consideration", [[("glucose", ">=", 200)]]),
    ("Diabetes medication, lifestyle intervention, regular monitoring", [[("glucose", ">=", 140)]]),
    ("Lifestyle modification, diet counseling, exercise program", [[("glucose", ">=", 110)]]),
    ("Weight management program, nutritionist consultation", [[("bmi", ">=", 30)]]),
]
TREATMENT_DEFAULT = "Preventive care, annual screening, healthy lifestyle maintenance"
CARE_TEXT = {
    "critical": "Immediate medical consultation required",
    "critical_plan": "Comprehensive diabetes management plan",
    "bmi": "Weight management program",
    "glucose": "Blood glucose monitoring and medication review",
    "pressure": "Blood pressure management",
    "age": "Regular health screenings",
    "insulin": "Insulin resistance evaluation",
    "default": "Maintain healthy lifestyle and regular check-ups",
}
PRIORITY_TEXT = {
    "Immediate": "Emergency diabetes care, immediate medication adjustment",
    "Soon": "Diabetes management consultation within 2 weeks",
    "Routine": "Regular diabetes monitoring and lifestyle counseling",
}
PRIORITY_TEXT_OTHER = "Preventive care and annual screening"
GLUCOSE_ADVICE = {"Normal": "Low Risk", "Prediabetic": "Prevention Opportunity", "Diabetic": "Management Required"}
GLUCOSE_ADVICE_OTHER = "Critical Care"
LIFESTYLE_TEXT = {
    "underweight": "Nutritional counseling, weight gain program",
    "normal": "Maintain current lifestyle, regular monitoring",
    "overweight": "Weight management, increased physical activity",
    "obese": "Comprehensive weight loss program, medical supervision",
    "default": "Clinical evaluation required",
}
SIGNIFICANCE_TEXT = {
    "glucose": "Primary diagnostic indicator - most important feature",
    "bmi": "Strong lifestyle indicator - key modifiable risk factor",
    "age": "Non-modifiable risk factor - important for risk stratification",
    "blood_pressure": "Cardiovascular comorbidity indicator",
}
# label, column, published importance, text
PANEL_FEATURES = [
    ("Glucose", "glucose", 0.35, "Primary diagnostic indicator"),
    ("BMI", "bmi", 0.25, "Strong obesity indicator"),
    ("Age", "age", 0.20, "Age-related risk factor"),
    ("Blood Pressure", "blood_pressure", 0.12, "Cardiovascular indicator"),
    ("Pregnancies", "pregnancies", 0.08, "Gestational diabetes risk"),
]
# label, column, threshold, text
CLINICAL_THRESHOLDS = [
    ("Glucose", "glucose", 140, "Monitor glucose levels, consider glucose tolerance test"),
    ("BMI", "bmi", 30, "Weight management program, nutritional counseling"),
    ("Age", "age", 45, "Annual diabetes screening, lifestyle modification"),
    ("Blood Pressure", "blood_pressure", 140, "Blood pressure management, cardiovascular screening"),
]
ALERT_TEXT = {
    "High Glucose Patients": ("High number of patients with glucose > 200 mg/dL detected",
                              "Investigate data quality and consider immediate medical review"),
    "Data Quality Degradation": ("Data quality score below acceptable threshold",
                                 "Review data ingestion process and data sources"),
    "Low Model Confidence": ("Model prediction confidence below acceptable level",
                             "Consider model retraining or feature engineering review"),
    "High Risk Patient Surge": ("Unusual increase in high-risk patients detected",
                                "Alert healthcare teams and prepare additional resources"),
}
LAYER_ADVICE = {
    "Bronze Layer": "Monitor data ingestion process, validate source data quality",
    "Gold Layer": "Monitor ML model performance, validate feature engineering",
}
LAYER_CONSISTENCY = {"Bronze Layer": 95.0, "Gold Layer": 98.0}
DRIFT_BASELINE = {"glucose": 120.0, "bmi": 30.0, "prediction_probability": 0.5}

# ---- model gates -----------------------------------------------------------
GATE = {"accuracy": 0.75, "f1_score": 0.70, "auc_roc": 0.80, "false_negative_rate": 15.0}
GATE_LADDER = [("Excellent", 0.85, 0.80), ("Good", 0.80, 0.75), ("Acceptable", 0.75, 0.70)]
GATE_DEFAULT = "Needs Improvement"
GATE_ADVICE = {
    "accuracy": "Improve model accuracy through feature engineering or algorithm tuning",
    "f1_score": "Balance precision and recall to improve F1-score",
    "auc_roc": "Enhance model's ability to distinguish between classes",
    "false_negative_rate": "Reduce false negative rate to avoid missing diabetes cases",
}
STRICT_GATE = {"accuracy": 0.85, "f1_score": 0.80, "false_negative_rate": 5.0, "false_positive_rate": 15.0}
STRICT_GATE_LADDER = [("GOOD", 0.75, 0.70, True), ("FAIR", 0.65, 0.0, False)]
STRICT_GATE_ADVICE = {
    "accuracy": "Consider feature engineering or different algorithms",
    "false_negative_rate": "Reduce false negative rate - adjust classification threshold",
    "false_positive_rate": "High false positive rate - may need more training data",
}
MISSED_CASE_COST = 1000
FALSE_ALARM_COST = 100
