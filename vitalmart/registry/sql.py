"""Small SQL text helpers for the oracle side, written apart from the Column code."""

from __future__ import annotations

from vitalmart.functions.bands import Ladder
from vitalmart.rules import clinical as R


def r(x: str, n: int) -> str:
    """Numeric rounding half away from zero, as double."""
    return f"CAST(ROUND(CAST({x} AS DECIMAL(28,12)), {n}) AS DOUBLE)"


def avg(x: str, n: int) -> str:
    return r(f"AVG({x})", n)


def sd(x: str, n: int) -> str:
    return r(f"STDDEV_SAMP({x})", n)


def cnt(cond: str | None = None) -> str:
    return "COUNT(*)" if cond is None else f"COUNT(*) FILTER (WHERE {cond})"


def pct(a: str, b: str, n: int) -> str:
    return r(f"({a}) * 1e2 / NULLIF({b}, 0)", n)


def rate(cond: str, n: int) -> str:
    return pct(cnt(cond), "COUNT(*)", n)


def corr(x: str, y: str, n: int) -> str:
    c = f"CORR({x}, {y})"
    return r(f"CASE WHEN isnan({c}) THEN NULL ELSE {c} END", n)


def share(x: str, n: int) -> str:
    return pct(x, f"SUM({x}) OVER ()", n)


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def ladder(x: str, steps: Ladder) -> str:
    op = "<" if steps.closed == "left" else "<="
    arms = []
    if steps.null is not None:
        arms.append(f"WHEN {x} IS NULL THEN {q(steps.null)}")
    if steps.floor is not None:
        arms.append(f"WHEN {x} <= {steps.floor} THEN {q(steps.outside)}")
    arms += [f"WHEN {x} {op} {edge} THEN {q(label)}" for edge, label in zip(steps.edges, steps.labels)]
    return f"CASE {' '.join(arms)} ELSE {q(steps.labels[-1])} END"


def lookup(x: str, table: dict, other: object = None) -> str:
    show = lambda v: q(v) if isinstance(v, str) else ("NULL" if v is None else str(v))
    arms = " ".join(f"WHEN {q(k)} THEN {show(v)}" for k, v in table.items())
    return f"CASE {x} {arms} ELSE {show(other)} END"


def select(columns: dict[str, str], source: str, group: list[str] | None = None) -> str:
    """SELECT from name -> expression; group lists the key expressions' names."""
    body = ", ".join(f"{e} AS {n}" for n, e in columns.items())
    tail = " GROUP BY " + ", ".join(columns[g] for g in group) if group else ""
    return f"SELECT {body} FROM {source}{tail}"


def report(keys: dict[str, str], measures: dict[str, str], source: str, prefix: str = "") -> str:
    return prefix + select({**keys, **measures}, source, list(keys))


def rows(name_col: str, table: dict[str, dict[str, str]], source: str, prefix: str = "") -> str:
    """One SELECT per report row, glued by UNION ALL."""
    parts = []
    for name, cells in table.items():
        parts.append(select({name_col: q(name), **cells}, source))
    return prefix + " UNION ALL ".join(parts)


def inside(x: str, b: R.Bounds) -> str:
    return f"({x} {'>' if b.lo_open else '>='} {b.lo} AND {x} <= {b.hi})"


def clean(x: str, b: R.Bounds) -> str:
    return f"CASE WHEN {inside(x, b)} THEN {x} END"


def points(pairs: list[tuple[str, float]]) -> str:
    return " + ".join(f"(CASE WHEN {c} THEN {float(p)}e0 ELSE 0e0 END)" for c, p in pairs)


def rules(alternatives: list[list[tuple[str, str, float]]]) -> str:
    """Rules kept as data, as SQL."""
    return " OR ".join("(" + " AND ".join(f"{c} {op} {limit}" for c, op, limit in rule) + ")" for rule in alternatives)


def levels(ladder: list[tuple[str, list]], default: str) -> str:
    return "CASE " + " ".join(f"WHEN {rules(alternatives)} THEN {q(label)}" for label, alternatives in ladder) + f" ELSE {q(default)} END"


# ---- the clinical table and its layers -------------------------------------
CLINICAL = """clinical AS (
  SELECT l_orderkey * 8 + l_linenumber AS id,
         CAST(l_partkey % 18 AS INTEGER) AS pregnancies,
         CASE WHEN l_quantity = 1 THEN 0e0 ELSE floor(l_extendedprice / 500e0) END AS glucose,
         CASE WHEN l_linenumber = 7 THEN 0e0 ELSE 60e0 + round(l_tax * 1000e0) END AS blood_pressure,
         round(l_discount * 1000e0) AS skin_thickness,
         CAST(l_orderkey % 847 AS DOUBLE) AS insulin,
         CASE WHEN l_returnflag = 'A' AND l_linenumber = 1 THEN 0e0 ELSE l_quantity + 15.5e0 END AS bmi,
         0.078e0 + (l_partkey % 235) * 0.01e0 AS diabetes_pedigree_function,
         CAST(21 + l_orderkey % 61 AS INTEGER) AS age,
         CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS outcome,
         CAST(l_shipdate AS DATE) AS processing_date,
         l_shipdate + to_hours(CAST(l_orderkey % 24 AS INTEGER)) + to_minutes(CAST(l_partkey % 60 AS INTEGER))
           AS processed_timestamp
  FROM lineitem)"""

_flags = {
    "zero_glucose": "glucose <= 0", "extreme_glucose": "glucose > 300", "zero_blood_pressure": "blood_pressure <= 0",
    "extreme_blood_pressure": "blood_pressure > 200", "zero_bmi": "bmi <= 0", "extreme_bmi": "bmi > 60",
    "extreme_age": "age > 100", "zero_insulin": "insulin = 0", "extreme_insulin": "insulin > 500",
    "inconsistent_pregnancy": "pregnancies > 15"}
_outliers = {
    "glucose_outlier": "glucose > 250 OR glucose < 50", "bmi_outlier": "bmi > 50 OR bmi < 15",
    "age_outlier": "age > 80 OR age < 18", "bp_outlier": "blood_pressure > 180 OR blood_pressure < 60",
    "insulin_outlier": "insulin > 400"}
_valid = {c: inside(c, b) for c, b in R.STANDARD_VALIDITY.items()}
_keep = "id, pregnancies, diabetes_pedigree_function, age, outcome, processing_date, processed_timestamp"


def silver_columns(bounds: dict[str, R.Bounds], extra: dict[str, str], keep: str) -> str:
    body = [keep] + [f"{clean(c, b)} AS {c}" for c, b in bounds.items()] + [f"{e} AS {n}" for n, e in extra.items()]
    return "SELECT " + ", ".join(body) + " FROM clinical"


_present = {"pregnancies": "pregnancies IS NOT NULL", "glucose": "glucose > 0", "blood_pressure": "blood_pressure > 0",
            "skin_thickness": "skin_thickness IS NOT NULL", "insulin": "insulin IS NOT NULL", "bmi": "bmi > 0",
            "diabetes_pedigree_function": "diabetes_pedigree_function IS NOT NULL", "age": "age > 0",
            "outcome": "outcome IS NOT NULL"}
SILVER = "silver AS (" + silver_columns(R.STANDARD_BOUNDS, {
    "is_valid": "COALESCE(" + " AND ".join(_valid.values()) + ", FALSE)",
    "quality_score": r(points([(v, 0.2) for v in _valid.values()]), 3),
    "completeness_score": r(f"({points([(c, 1) for c in _present.values()])}) / 9e0", 3),
    **{f"a_{n}": f"COALESCE({c}, FALSE)" for n, c in _flags.items()},
    **{f"o_{n}": f"COALESCE({c}, FALSE)" for n, c in _outliers.items()},
    "glucose_valid": _valid["glucose"], "bmi_valid": _valid["bmi"], "age_valid": _valid["age"],
    "bp_valid": _valid["blood_pressure"]}, _keep) + ")"

ANY_ANOMALY = "(" + " OR ".join(f"a_{n}" for n in _flags) + ")"

_ratio = " + ".join(f"GREATEST(0e0, LEAST(1e0, {c} / {d}e0)) * {w}e0" for c, d, w in R.RATIO_SCORE)
_gold = {
    "bmi_category": ladder("bmi", R.BMI_WHO), "age_group": ladder("age", R.AGE_DETAILED),
    "glucose_category": ladder("glucose", R.GLUCOSE_ADA), "bp_category": ladder("blood_pressure", R.PRESSURE_AHA),
    "insulin_category": f"CASE WHEN insulin = 0 THEN {q(R.INSULIN_NOT_MEASURED)} ELSE {ladder('insulin', R.INSULIN_LEVELS)} END",
    "pregnancies_category": ladder("pregnancies", R.PREGNANCY_PARITY),
    "risk_score": r(_ratio, 4),
    "prediction": f"CASE WHEN {rules(R.PREDICTION)} THEN 1 ELSE 0 END",
    "prediction_probability": r(
        "LEAST(1e0, glucose / 126e0 * 0.3e0 + (CASE WHEN bmi > 25 THEN (bmi - 25) / 15e0 * 0.25e0 ELSE 0e0 END)"
        " + age / 100e0 * 0.2e0 + diabetes_pedigree_function * 0.15e0"
        " + (CASE WHEN blood_pressure > 140 THEN 0.1e0 ELSE 0e0 END))", 4),
    "health_risk_level": levels(R.HEALTH_RISK, R.HEALTH_RISK_DEFAULT),
    "intervention_priority": levels(R.INTERVENTION, R.INTERVENTION_DEFAULT),
    "estimated_cost_category": levels(R.COST, R.COST_DEFAULT),
    "treatment_recommendation": levels(R.TREATMENT, R.TREATMENT_DEFAULT),
    "followup_frequency": levels(R.FOLLOWUP, R.FOLLOWUP_DEFAULT),
    "specialist_referral_needed": f"({rules(R.REFERRAL)})",
    "metabolic_syndrome_risk": r("(bmi / 50e0 + glucose / 200e0 + blood_pressure / 200e0"
                                 " + (CASE WHEN insulin = 0 THEN 0.2e0 ELSE 0e0 END)) / 4e0", 4),
    "cardiovascular_risk": r("(age / 100e0 + blood_pressure / 200e0 + bmi / 50e0 + diabetes_pedigree_function) / 4e0", 4),
    "pregnancy_risk_factor": r("(CASE WHEN pregnancies > 0 THEN pregnancies / 10e0 + glucose / 200e0 ELSE 0e0 END) / 2e0", 4),
    "lifestyle_risk_score": r("(bmi / 50e0 + age / 100e0 + (CASE WHEN glucose > 100 THEN 0.2e0 ELSE 0e0 END)) / 3e0", 4),
    "insulin_resistance_score": r("((CASE WHEN insulin = 0 THEN 0.5e0 ELSE insulin / 200e0 END) + glucose / 200e0"
                                  " + bmi / 50e0) / 3e0", 4),
    "age_percentile": r("age / 100e0", 4),
    "risk_percentile": r("LEAST(1e0, (glucose / 126e0 + bmi / 40e0) / 2e0)", 4),
    **{n: r(f"{'COALESCE(insulin, 0)' if a == 'insulin' else a} * {b} / {s}e0", 4)
       for n, (a, b, s) in R.INTERACTIONS_GOLD.items()},
    **{("bp" if c == "blood_pressure" else c) + "_normalized":
       r(f"({'COALESCE(insulin, 79.8e0)' if c == 'insulin' else c} - {m}e0) / {s}e0", 4)
       for c, (m, s) in R.POPULATION.items()},
    **{f"{c}_zscore": r(f"({c} - {R.POPULATION[c][0]}e0) / {R.POPULATION[c][1]}e0", 4) for c in ("glucose", "bmi")},
}
GOLD_NAMES = list(_gold)
GOLD = ("gold AS (SELECT *, outcome AS diabetes, " + ", ".join(f"{e} AS {n}" for n, e in _gold.items())
        + ", " + lookup(f"({levels(R.COST, R.COST_DEFAULT)})",
                        R.ANNUAL_COST, R.ANNUAL_COST_OTHER) + " AS annual_cost FROM silver WHERE is_valid)")

WITH_CLINICAL = f"WITH {CLINICAL} "
WITH_SILVER = f"WITH {CLINICAL}, {SILVER} "
WITH_GOLD = f"WITH {CLINICAL}, {SILVER}, {GOLD} "

_basic_limits = {"glucose": 300, "blood_pressure": 200, "bmi": 60, "age": 120}
BASIC = ("basic AS (SELECT " + _keep + ", "
         + ", ".join(f"CASE WHEN {c} > 0 THEN {c} END AS {c}" for c in R.ZERO_IS_MISSING)
         + ", COALESCE(" + " AND ".join(f"{c} > 0 AND {c} < {hi}" for c, hi in _basic_limits.items()) + ", FALSE) AS is_valid"
         + ", CASE WHEN " + " AND ".join(f"{c} > 0" for c in R.ZERO_IS_MISSING) + " THEN 1e0 ELSE 0.8e0 END AS quality_score"
         + ", glucose <= 0 AS zero_glucose, blood_pressure <= 0 AS zero_blood_pressure, bmi <= 0 AS zero_bmi"
         + ", glucose > 250 AS extreme_glucose, bmi > 50 AS extreme_bmi FROM clinical)")
_capped = " + ".join(f"{c} / {d}e0 * {w}e0" for c, d, w in R.CAPPED_SCORE)
FEATURES = (f"features AS (SELECT *, {ladder('age', R.AGE_DECADES)} AS age_group, {ladder('bmi', R.BMI_SIMPLE)} AS bmi_category,"
            f" {ladder('glucose', R.GLUCOSE_140)} AS glucose_category,"
            f" CASE WHEN glucose IS NULL OR bmi IS NULL OR age IS NULL THEN 0e0 ELSE {r(f'LEAST(1e0, {_capped})', 2)} END AS risk_score,"
            f" COALESCE({rules(R.HIGH_RISK)}, FALSE) AS high_risk_flag FROM basic WHERE is_valid)")
WITH_FEATURES = f"WITH {CLINICAL}, {BASIC}, {FEATURES} "

_pts = "(" + " + ".join("CASE " + " ".join(f"WHEN {c} {op} {limit} THEN {p}" for op, limit, p in rungs) + " ELSE 0 END"
                         for c, rungs in R.POINT_STEPS) + ")"
RISK_POINTS = _pts
CATEGORIES = (f"categories AS (SELECT *, CASE WHEN {_pts} >= 6 THEN 'High' WHEN {_pts} >= 3 THEN 'Medium' ELSE 'Low' END"
              f" AS risk_category, {ladder('bmi', R.BMI_SIMPLE)} AS bmi_category, {ladder('age', R.AGE_RANGES)} AS age_group,"
              f" {ladder('glucose', R.GLUCOSE_FOUR)} AS glucose_category, 0.8e0 AS data_quality_score FROM clinical)")
WITH_CATEGORIES = f"WITH {CLINICAL}, {CATEGORIES} "

WEARABLE = """wearable AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS person_id, CAST(18 + o_custkey % 70 AS INTEGER) AS age,
         CASE o_orderkey % 3 WHEN 0 THEN ' Male' WHEN 1 THEN 'FEMALE ' ELSE 'other' END AS gender,
         150e0 + o_orderkey % 50 AS height, 45e0 + o_custkey % 80 AS weight,
         CASE WHEN o_orderkey % 101 = 0 THEN 230e0 ELSE 55e0 + o_custkey % 45 END AS heart_rate,
         6e0 + o_orderkey % 4 AS sleep_duration, 1e0 + o_custkey % 3 AS deep_sleep_duration,
         1e0 + o_orderkey % 2 AS rem_sleep_duration, CAST(2000 + o_custkey % 9000 AS INTEGER) AS steps_daily,
         CASE WHEN o_orderkey % 7 <> 0 THEN floor(o_totalprice / 5000e0) END AS health_score,
         CASE WHEN o_orderkey % 11 <> 0 THEN o_orderpriority END AS stress_level,
         CASE WHEN o_orderkey % 13 <> 0 THEN o_orderstatus END AS mood,
         CASE WHEN o_orderkey % 5 = 0 THEN 'None ' ELSE 'Asthma' END AS medical_conditions,
         strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS "timestamp"
  FROM orders)"""
WITH_WEARABLE = f"WITH {WEARABLE} "
