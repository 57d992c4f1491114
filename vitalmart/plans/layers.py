"""Silver and gold projections of the clinical table.

All are narrow: no shuffle, no statistics. Reports built on them read only the
source columns their expressions need.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalmart.functions.bands import band, first_match, holds, level, recode, step_points
from vitalmart.functions.numeric import clamp, clamp_ignoring_null, col, fold_sum, rnd_pos
from vitalmart.functions.reuse import per_context
from vitalmart.functions.scores import (additive_quality, all_hold, any_flag, completeness, deviation_score,
                                        fixed_zscore, flag_struct, joined_tags, logistic_score, penalty_quality,
                                        points, scaled_product, tags, weighted_score)
from vitalmart.operators.clean import in_bounds, nonpositive_to_null, out_of_bounds_to_null
from vitalmart.operators.statistics import fixed_min_max, zero_to_positive_median
from vitalmart.rules import clinical as R

C = F.col

ANOMALY_NAMES = ["zero_glucose", "extreme_glucose", "zero_blood_pressure", "extreme_blood_pressure", "zero_bmi",
                 "extreme_bmi", "extreme_age", "zero_insulin", "extreme_insulin", "inconsistent_pregnancy"]


def _measured(cols: list[str], positive: tuple[str, ...]) -> list[Column]:
    return [C(c).isNotNull() & (C(c) > 0) if c in positive else C(c).isNotNull() for c in cols]


# ---- silver ----------------------------------------------------------------
def silver_standard(df: DataFrame) -> DataFrame:
    """Range-cleaned measures with validity, quality, completeness and flag structs."""
    return out_of_bounds_to_null(df.withColumns(_standard_checks()), R.STANDARD_BOUNDS)


@per_context
def _standard_checks() -> dict[str, Column]:
    valid = {c: in_bounds(c, b) for c, b in R.STANDARD_VALIDITY.items()}
    return {
        "is_valid": all_hold(list(valid.values())),
        "quality_score": additive_quality([(v, 0.2) for v in valid.values()], digits=3),
        "completeness_score": completeness(
            _measured([*R.MEASURES, "outcome"], ("glucose", "blood_pressure", "bmi", "age"))),
        "anomaly_flags": flag_struct({
            "zero_glucose": C("glucose") <= 0, "extreme_glucose": C("glucose") > 300,
            "zero_blood_pressure": C("blood_pressure") <= 0, "extreme_blood_pressure": C("blood_pressure") > 200,
            "zero_bmi": C("bmi") <= 0, "extreme_bmi": C("bmi") > 60, "extreme_age": C("age") > 100,
            "zero_insulin": C("insulin") == 0, "extreme_insulin": C("insulin") > 500,
            "inconsistent_pregnancy": C("pregnancies") > 15}),
        "outlier_flags": flag_struct({
            "glucose_outlier": ~C("glucose").between(50, 250), "bmi_outlier": ~C("bmi").between(15, 50),
            "age_outlier": ~C("age").between(18, 80), "bp_outlier": ~C("blood_pressure").between(60, 180),
            "insulin_outlier": C("insulin") > 400}),
        "glucose_valid": valid["glucose"], "bmi_valid": valid["bmi"], "age_valid": valid["age"],
        "bp_valid": valid["blood_pressure"],
    }


def silver_tagged(df: DataFrame) -> DataFrame:
    """Tighter bounds, 0..100 scores and flag arrays."""
    valid = {c: in_bounds(c, b) for c, b in R.TIGHT_VALIDITY.items()}
    pedigree = in_bounds("diabetes_pedigree_function", R.TIGHT_BOUNDS["diabetes_pedigree_function"])
    checks = {
        "is_valid": all_hold(list(valid.values())),
        "quality_score": additive_quality([(v, 20) for v in [*valid.values(), pedigree]], cap=100),
        "completeness_score": completeness(_measured(R.MEASURES, ()), unit=12.5, digits=2),
        "anomaly_flags": tags([(C("glucose") > 300, "high_glucose"), (C("blood_pressure") > 200, "high_bp"),
                               (C("bmi") > 50, "extreme_obesity"), (C("age") > 100, "extreme_age")]),
        "outlier_flags": tags([(~C("glucose").between(60, 180), "glucose_outlier"),
                               (~C("bmi").between(15, 45), "bmi_outlier"),
                               (~C("age").between(20, 80), "age_outlier")]),
    }
    return out_of_bounds_to_null(df.withColumns(checks), R.TIGHT_BOUNDS)


def silver_fraction(df: DataFrame) -> DataFrame:
    """Tight bounds with a 0..1 score and a flag struct."""
    valid = {c: in_bounds(c, b) for c, b in R.TIGHT_VALIDITY.items()}
    pedigree = in_bounds("diabetes_pedigree_function", R.TIGHT_BOUNDS["diabetes_pedigree_function"])
    return out_of_bounds_to_null(df.withColumns({
        "is_valid": all_hold(list(valid.values())),
        "quality_score": additive_quality([(v, 0.2) for v in [*valid.values(), pedigree]], digits=2, cap=1.0),
        "anomaly_flags": flag_struct({"high_glucose": C("glucose") > 300, "high_bp": C("blood_pressure") > 200,
                                      "extreme_obesity": C("bmi") > 50, "extreme_age": C("age") > 100}),
    }), R.TIGHT_BOUNDS)


def silver_scored(df: DataFrame) -> DataFrame:
    """Standard bounds with the composite 0..100 score, flag array and deviation score."""
    ok = {c: in_bounds(c, b) for c, (b, _) in R.COMPOSITE_QUALITY.items()}
    names = {"glucose": "invalid_glucose", "blood_pressure": "invalid_bp", "bmi": "invalid_bmi", "age": "invalid_age",
             "skin_thickness": "invalid_skin_thickness", "insulin": "invalid_insulin"}
    deviation = [(F.coalesce(C(c), F.lit(80)) if c == "blood_pressure" else c, m, w) for c, m, w in R.DEVIATION_TERMS]
    return out_of_bounds_to_null(df.withColumns({
        "is_valid": all_hold([ok[c] for c in ("glucose", "blood_pressure", "bmi", "age")]),
        "data_quality_score": additive_quality([(ok[c], p) for c, (_, p) in R.COMPOSITE_QUALITY.items()], digits=2),
        "quality_flags": tags([(~ok[c], name) for c, name in names.items()]),
        "anomaly_score": deviation_score(deviation),
    }), R.STANDARD_BOUNDS)


def silver_basic(df: DataFrame) -> DataFrame:
    """Non-positive to NULL, strict upper limits, two-step score."""
    upper = {"glucose": 300, "blood_pressure": 200, "bmi": 60, "age": 120}
    measured = [C(c) > 0 for c in R.ZERO_IS_MISSING]
    checked = df.withColumns({
        "is_valid": all_hold([(C(c) > 0) & (C(c) < hi) for c, hi in upper.items()]),
        "quality_score": F.when(all_hold(measured), F.lit(1.0)).otherwise(F.lit(0.8)),
        "anomaly_flags": flag_struct({
            "zero_glucose": C("glucose") <= 0, "zero_blood_pressure": C("blood_pressure") <= 0,
            "zero_bmi": C("bmi") <= 0, "extreme_glucose": C("glucose") > 250, "extreme_bmi": C("bmi") > 50}),
    })
    return nonpositive_to_null(checked, R.ZERO_IS_MISSING)


def silver_binary(df: DataFrame) -> DataFrame:
    """No cleaning; validity, 1.0 or 0.5, and one outlier marker."""
    limits = {"glucose": 300, "bmi": 100, "age": 120}
    fields = [(C(c) > 0) & (C(c) < hi) for c, hi in limits.items()]
    pressure = (C("blood_pressure") > 0) & (C("blood_pressure") < 250)
    odd = (C("glucose") > 250) | (C("bmi") > 60) | (C("age") > 100)
    return df.withColumns({
        "is_valid": all_hold(fields),
        "quality_score": F.when(all_hold([*fields, pressure]), F.lit(1.0)).otherwise(F.lit(0.5)),
        "anomaly_flags": tags([(odd, "outlier_detected")]),
    })


def silver_categories(df: DataFrame) -> DataFrame:
    """Categories on unchanged measures, with the points-based risk category."""
    return df.withColumns({
        "risk_category": risk_category(), "bmi_category": band("bmi", R.BMI_SIMPLE),
        "age_group": band("age", R.AGE_RANGES), "glucose_category": band("glucose", R.GLUCOSE_FOUR),
        "data_quality_score": F.lit(0.8)})


def risk_points() -> Column:
    return step_points(R.POINT_STEPS)


def risk_category() -> Column:
    return first_match([(risk_points() >= 6, "High"), (risk_points() >= 3, "Medium")], "Low")


# ---- gold ------------------------------------------------------------------
def gold_full(silver: DataFrame) -> DataFrame:
    """Wide gold features of valid silver rows; ``outcome`` becomes ``diabetes``."""
    base = silver.where("is_valid").withColumnRenamed("outcome", "diabetes")
    return base.withColumns(gold_columns())


@per_context
def gold_columns() -> dict[str, Column]:
    g, b, a, p = C("glucose"), C("bmi"), C("age"), C("blood_pressure")
    preg, ins, dpf = C("pregnancies"), C("insulin"), C("diabetes_pedigree_function")
    features: dict[str, Column] = {
        "bmi_category": band(b, R.BMI_WHO), "age_group": band(a, R.AGE_DETAILED),
        "glucose_category": band(g, R.GLUCOSE_ADA), "bp_category": band(p, R.PRESSURE_AHA),
        "insulin_category": F.when(ins == 0, F.lit(R.INSULIN_NOT_MEASURED)).otherwise(band(ins, R.INSULIN_LEVELS)),
        "pregnancies_category": band(preg, R.PREGNANCY_PARITY),
        "risk_score": weighted_score([(clamp_ignoring_null(C(c) / F.lit(d)), w) for c, d, w in R.RATIO_SCORE], digits=4),
        "prediction": F.when(holds(R.PREDICTION), F.lit(1)).otherwise(F.lit(0)),
        "prediction_probability": prediction_probability(),
        "health_risk_level": level(R.HEALTH_RISK, R.HEALTH_RISK_DEFAULT),
        "intervention_priority": level(R.INTERVENTION, R.INTERVENTION_DEFAULT),
        "estimated_cost_category": level(R.COST, R.COST_DEFAULT),
        "treatment_recommendation": level(R.TREATMENT, R.TREATMENT_DEFAULT),
        "followup_frequency": level(R.FOLLOWUP, R.FOLLOWUP_DEFAULT),
        "specialist_referral_needed": holds(R.REFERRAL),
        **sub_scores(),
        "age_percentile": rnd_pos(a / F.lit(100.0), 4),
        "risk_percentile": rnd_pos(F.least(F.lit(1.0), (g / 126.0 + b / 40.0) / 2), 4),
    }
    for name, (x, y, scale) in R.INTERACTIONS_GOLD.items():
        x_col = F.coalesce(C(x), F.lit(0.0)) if x == "insulin" else C(x)
        features[name] = scaled_product([x_col, y], scale, 4)
    short = {"blood_pressure": "bp"}
    for c, (mu, s) in R.POPULATION.items():
        x_col = F.coalesce(C(c), F.lit(mu)) if c == "insulin" else C(c)
        features[f"{short.get(c, c)}_normalized"] = fixed_zscore(x_col, mu, s)
    for c in ("glucose", "bmi"):
        features[f"{c}_zscore"] = fixed_zscore(c, *R.POPULATION[c])
    return features


def prediction_probability() -> Column:
    g, b = C("glucose"), C("bmi")
    parts = (g / 126.0 * 0.30 + F.when(b > 25, (b - 25) / 15.0 * 0.25).otherwise(F.lit(0.0)) + C("age") / 100.0 * 0.20
             + C("diabetes_pedigree_function") * 0.15 + F.when(C("blood_pressure") > 140, F.lit(0.10)).otherwise(F.lit(0.0)))
    return rnd_pos(F.least(F.lit(1.0), parts), 4)


def sub_scores() -> dict[str, Column]:
    g, b, a, p = C("glucose") / 200.0, C("bmi") / 50.0, C("age") / 100.0, C("blood_pressure") / 200.0
    ins, preg = C("insulin"), C("pregnancies")
    return {
        "metabolic_syndrome_risk": rnd_pos((b + g + p + F.when(ins == 0, F.lit(0.2)).otherwise(F.lit(0.0))) / 4, 4),
        "cardiovascular_risk": rnd_pos((a + p + b + C("diabetes_pedigree_function")) / 4, 4),
        "pregnancy_risk_factor": rnd_pos(F.when(preg > 0, preg / 10.0 + g).otherwise(F.lit(0.0)) / 2, 4),
        "lifestyle_risk_score": rnd_pos((b + a + F.when(C("glucose") > 100, F.lit(0.2)).otherwise(F.lit(0.0))) / 3, 4),
        "insulin_resistance_score": rnd_pos((F.when(ins == 0, F.lit(0.5)).otherwise(ins / 200.0) + g + b) / 3, 4),
    }


def gold_features(silver: DataFrame) -> DataFrame:
    """Compact features: decade ages, capped score, high-risk flag."""
    g, b, a = C("glucose"), C("bmi"), C("age")
    capped = weighted_score([(C(c) / F.lit(d), w) for c, d, w in R.CAPPED_SCORE])
    return silver.where("is_valid").withColumns({
        "age_group": band(a, R.AGE_DECADES), "bmi_category": band(b, R.BMI_SIMPLE),
        "glucose_category": band(g, R.GLUCOSE_140),
        "risk_score": F.when(g.isNull() | b.isNull() | a.isNull(), F.lit(0.0))
                       .otherwise(rnd_pos(F.least(F.lit(1.0), capped), 2)),
        "high_risk_flag": F.coalesce(holds(R.HIGH_RISK), F.lit(False)),
    })


def gold_insights(silver: DataFrame) -> DataFrame:
    """Health insights: levels, bounded health points, logistic risk, tag arrays."""
    g, b, a, p = C("glucose"), C("bmi"), C("age"), C("blood_pressure")
    dpf = C("diabetes_pedigree_function")
    return silver.where("is_valid").withColumns({
        "risk_category": first_match([(C("outcome") == 1, "HIGH_RISK"), ((g > 126) | (b > 30), "MODERATE_RISK"),
                                      ((g > 100) | (b > 25), "LOW_RISK")], "MINIMAL_RISK"),
        "bmi_category": band(b, R.BMI_SNAKE), "glucose_category": band(g, R.GLUCOSE_SNAKE),
        "blood_pressure_category": band(p, R.PRESSURE_SNAKE), "age_group": band(a, R.AGE_SNAKE),
        "overall_health_score": points([(b.between(18.5, 25), 15, -10), (g.between(70, 100), 15, -15),
                                        (p.between(90, 120), 10, -10), (a < 60, 10, 0), (dpf < 0.5, 10, -5)],
                                       base=50, bounds=(0, 100)),
        "diabetes_risk_score": logistic_score(R.LOGISTIC_BIAS, R.LOGISTIC_TERMS),
        "metabolic_syndrome_risk": first_match([((b > 30) & (g > 100) & (p > 130), "HIGH"),
                                                ((b > 25) & ((g > 100) | (p > 120)), "MODERATE")], "LOW"),
        "cardiovascular_risk": first_match([((a > 55) & (p > 140), "HIGH"),
                                            ((a > 45) & ((p > 120) | (b > 30)), "MODERATE")], "LOW"),
        "recommendations": tags([(b > 25, "weight_management"), (g > 100, "glucose_monitoring"),
                                 (p > 120, "bp_monitoring"), (a > 45, "regular_checkups")]),
        "risk_factors": tags([(b > 30, "obesity"), (g > 126, "diabetes"), (p > 140, "hypertension"),
                              (a > 65, "advanced_age"), (dpf > 1.0, "family_history")]),
        "protective_factors": tags([(b.between(18.5, 25), "healthy_weight"), (g < 100, "normal_glucose"),
                                    (p < 120, "normal_bp"), (a < 45, "young_age")]),
        "high_risk_flag": F.coalesce((C("outcome") == 1) | (g > 126) | (b > 30), F.lit(False)),
    })


def gold_compact(silver: DataFrame) -> DataFrame:
    """Divisor-scaled features, compact score and threshold levels."""
    g, b, a, p, ins = C("glucose"), C("bmi"), C("age"), C("blood_pressure"), C("insulin")
    steps = [(g > 180) & (b > 35), (g > 140) | (b > 30), (g > 100) | (b > 25)]
    ladder = lambda names: first_match(list(zip(steps, names)), names[-1])
    out = {
        "bmi_category": band(b, R.BMI_SIMPLE), "age_group": band(a, R.AGE_THREE_HYPHEN),
        "glucose_category": band(g, R.GLUCOSE_THREE), "bp_category": band(p, R.PRESSURE_ELEVATED),
        "risk_score": weighted_score([(C(c) / F.lit(d), w) for c, d, w in R.COMPACT_SCORE], digits=3),
        "health_risk_level": ladder(["Critical", "High", "Medium", "Low"]),
        "intervention_priority": ladder(["Immediate", "Soon", "Routine", "Monitor"]),
        "estimated_cost_category": ladder(["Very High", "High", "Medium", "Low"]),
        "metabolic_syndrome_risk": rnd_pos((b / 50.0 + g / 200.0 + p / 200.0) / 3, 3),
        "cardiovascular_risk": rnd_pos((a / 100.0 + p / 200.0 + b / 50.0) / 3, 3),
        "pregnancy_risk_factor": rnd_pos((C("pregnancies") / 10.0 + g / 200.0) / 2, 3),
        "lifestyle_risk_score": rnd_pos((b / 50.0 + a / 100.0) / 2, 3),
    }
    for name, (x, y, scale) in R.INTERACTIONS_COMPACT.items():
        out[name] = scaled_product([x, y], scale)
    for c, d in R.DIVISOR_SCALING.items():
        out[("bp" if c == "blood_pressure" else c) + "_normalized"] = C(c) / F.lit(d)
    return silver.where("is_valid").withColumns(out)


def quality_penalties(with_zero_rule: bool = True) -> tuple[Column, Column]:
    """Penalty-based quality score and the names of the rules that hit."""
    g, b, a, p = C("glucose"), C("bmi"), C("age"), C("blood_pressure")
    rules = [(g == 0, 0.15, "zero_glucose"), (p == 0, 0.15, "zero_blood_pressure"), (b == 0, 0.15, "zero_bmi")]
    rules = rules if with_zero_rule else []
    rules += [((g > 0) & ~g.between(50, 250), 0.2, "glucose_outlier"), ((b > 0) & ~b.between(15, 50), 0.2, "bmi_outlier"),
              (~a.between(18, 100), 0.2, "age_outlier"),
              ((C("pregnancies") > 0) & (a < 18), 0.3, "pregnancy_age_inconsistent")]
    nulls = [C(c).isNull() for c in [*R.MEASURES, "outcome"]]
    score = penalty_quality([(c, w) for c, w, _ in rules], missing=nulls)
    gaps = fold_sum([F.when(m, 1).otherwise(0) for m in nulls])
    named = [(gaps > 0, F.concat(F.lit("missing_values_"), gaps.cast("string")))]
    return score, tags([*named, *[(c, name) for c, _, name in rules]])


def gold_normalised(df: DataFrame, impute_zero: bool = True) -> DataFrame:
    """Right-closed bands, clipped fixed-range scaling and the normalised score.

    Zeros are first replaced by the median of the positive values (exact,
    distributed).
    """
    score, hits = quality_penalties()
    scored = df.withColumns({"quality_score": score, "anomaly_flags": hits})
    filled = zero_to_positive_median(scored, R.ZERO_IS_MISSING) if impute_zero else scored
    short = {"blood_pressure": "bp"}
    scaled = filled.withColumns({
        "bmi_category": band("bmi", R.BMI_CUT), "age_group": band("age", R.AGE_CUT),
        "glucose_category": band("glucose", R.GLUCOSE_CUT), "bp_category": band("blood_pressure", R.PRESSURE_CUT),
        **{name: scaled_product([x, y], s) for name, (x, y, s) in R.INTERACTIONS_SCALED.items()},
        **{f"{short.get(c, c)}_normalized": fixed_min_max(c, lo, hi) for c, (lo, hi) in R.SCALING_RANGES.items()}})
    terms = [(f"{short.get(c, c)}_normalized", w) for c, w in R.NORMALISED_WEIGHTS.items()]
    terms += [(clamp(C(c) / F.lit(d)), w) for c, d, w in R.NORMALISED_TAIL]
    rated = scaled.withColumn("risk_score", weighted_score(terms, digits=6, bounds=(0, 1)))
    levelled = rated.withColumn("health_risk_level", band("risk_score", R.RISK_CUT))
    return levelled.withColumns(care_columns())


def care_columns() -> dict[str, Column]:
    """Prediction, priority, cost and care text from level and measures."""
    level, b, g, p, a = C("health_risk_level"), C("bmi"), C("glucose"), C("blood_pressure"), C("age")
    priority = dict(zip(R.RISK_ORDER, R.PRIORITY_ORDER))
    t = R.CARE_TEXT
    return {
        "prediction": F.when(C("risk_score") > 0.5, F.lit(1)).otherwise(F.lit(0)),
        "prediction_probability": C("risk_score"),
        "intervention_priority": recode(level, priority),
        "estimated_cost_category": recode(level, R.LEVEL_TO_COST),
        "metabolic_syndrome_risk": points([(b > 30, 0.35, 0), (g > 100, 0.35, 0), (p > 130, 0.30, 0)], bounds=(0, 1)),
        "cardiovascular_risk": clamp(points([(a > 45, 0.25, 0), (p > 140, 0.30, 0), (b > 30, 0.25, 0)])
                                     + C("outcome") * F.lit(0.20)),
        "pregnancy_risk_factor": C("pregnancies") * F.lit(0.1),
        "lifestyle_risk_score": (C("bmi_normalized") + C("glucose_normalized")) / 2,
        "treatment_recommendation": joined_tags([
            (level == "Critical", t["critical"]), (level == "Critical", t["critical_plan"]), (b > 30, t["bmi"]),
            (g > 140, t["glucose"]), (p > 140, t["pressure"]), (a > 50, t["age"]), (C("insulin") > 200, t["insulin"])],
            t["default"]),
    }


def annual_cost() -> Column:
    return recode("estimated_cost_category", R.ANNUAL_COST, R.ANNUAL_COST_OTHER).cast("bigint")


def has_anomaly(struct_col: Column | str = "anomaly_flags", names: list[str] | None = None) -> Column:
    """Any flag of the struct is true (not merely: the struct is non-empty)."""
    return any_flag(col(struct_col), names or ANOMALY_NAMES)
