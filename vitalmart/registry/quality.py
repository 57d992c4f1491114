"""D*: data-quality and validation."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from vitalmart.operators import quality as Q
from vitalmart.operators.aggregate import mean, metric_rows, n, n_if, rate, report
from vitalmart.operators.clean import zero_to_null
from vitalmart.operators.joins import attach_scalars
from vitalmart.operators.statistics import scalar_struct
from vitalmart.rules import clinical as R

from . import sql as S
from .base import query

C = F.col


def _union(name: str, table: dict[str, tuple], columns: list[str]) -> str:
    return " UNION ALL ".join(S.select({name: S.q(k), **dict(zip(columns, cells))}, "customer") for k, cells in table.items())


@query("d1_required_columns", _union("column_name", {
    "c_custkey": ("TRUE", "'ok'", "COUNT(c_custkey)"), "c_phone": ("FALSE", "'error'", "0 * COUNT(*)"),
    "c_acctbal": ("TRUE", "'ok'", "COUNT(c_acctbal)"), "c_comment": ("FALSE", "'warning'", "0 * COUNT(*)")},
    ["present", "status", "filled_rows"]))
def _(t):
    return Q.column_check(t.customer, ["c_custkey", "c_phone"], ["c_acctbal", "c_comment"])


@query("d2_non_empty_gate", "SELECT COUNT(*) AS row_count FROM customer")
def _(t):
    return Q.require_rows(t.customer).agg(n().alias("row_count"))


_Z = ", ".join(f"NULLIF({c}, 0) AS {c}" for c in R.ZERO_IS_MISSING)
_CELLS = " + ".join(f"COUNT(*) - COUNT({c})" for c in R.ZERO_IS_MISSING)


@query("d3_missing_share_gate", S.WITH_CLINICAL + f", z AS (SELECT {_Z} FROM clinical), m AS (SELECT COUNT(*) AS total_records, {_CELLS} AS missing_cells"
       " FROM z) SELECT *, " + S.r("missing_cells * 1e2 / (total_records * 5)", 4) + " AS missing_percentage, CASE WHEN missing_cells * 1e2 /"
       " (total_records * 5) < 5 THEN 'ok' WHEN missing_cells * 1e2 / (total_records * 5) < 15 THEN 'warning' ELSE 'fail' END AS tier,"
       " missing_cells <= total_records * 0.3 AS gate_passed FROM m")
def _(t):
    return Q.missing_share_gate(zero_to_null(t.clinical, R.ZERO_IS_MISSING), R.ZERO_IS_MISSING)


_TIGHT = {**R.EXPECTED_RANGES, "insulin": (0, 600), "bmi": (16, 80)}


@query("d4_range_violations", S.rows("column_name", {
    c: {"violations": S.cnt(f"{c} < {lo} OR {c} > {hi}"), "total_records": S.cnt(),
        "within_tolerance": f"{S.cnt(f'{c} < {lo} OR {c} > {hi}')} < COUNT(*) * 0.01"} for c, (lo, hi) in _TIGHT.items()},
    "clinical", S.WITH_CLINICAL))
def _(t):
    return Q.range_violations(t.clinical, _TIGHT)


_RULES = {"outcome_not_binary": "outcome NOT IN (0, 1)", "low_bmi_thick_skin": "bmi < 18 AND skin_thickness > 30",
          "young_many_pregnancies": "age < 20 AND pregnancies > 5", "young_adult_many_pregnancies": "age < 25 AND pregnancies > 5"}


@query("d5_consistency_rules", S.rows("rule_name", {
    k: {"violations": S.cnt(v), "passed": f"{S.cnt(v)} = 0"} for k, v in _RULES.items()}, "clinical", S.WITH_CLINICAL))
def _(t):
    return Q.rule_counts(t.clinical, {
        "outcome_not_binary": ~C("outcome").isin(0, 1), "low_bmi_thick_skin": (C("bmi") < 18) & (C("skin_thickness") > 30),
        "young_many_pregnancies": (C("age") < 20) & (C("pregnancies") > 5),
        "young_adult_many_pregnancies": (C("age") < 25) & (C("pregnancies") > 5)})


@query("d6_duplicate_rows", "WITH g AS (SELECT l_orderkey, l_linenumber, COUNT(*) AS c FROM lineitem GROUP BY ALL) SELECT CAST(SUM(c) AS BIGINT)"
       " AS total_records, CAST(SUM(c - 1) AS BIGINT) AS duplicate_records FROM g")
def _(t):
    return Q.duplicate_rows(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("d6_duplicate_full_rows", S.WITH_CLINICAL + ", g AS (SELECT *, COUNT(*) AS c FROM clinical GROUP BY ALL) SELECT CAST(SUM(c) AS BIGINT) AS"
       " total_records, CAST(SUM(c - 1) AS BIGINT) AS duplicate_records FROM g")
def _(t):
    return Q.duplicate_rows(t.clinical)


@query("d7_empty_rows_columns", S.WITH_CLINICAL + f", z AS (SELECT {_Z}, CAST(NULL AS DOUBLE) AS unused FROM clinical) SELECT "
       + S.cnt(" AND ".join(f"{c} IS NULL" for c in [*R.ZERO_IS_MISSING, "unused"])) + " AS empty_rows, CAST("
       + " + ".join(f"(CASE WHEN COUNT({c}) = 0 THEN 1 ELSE 0 END)" for c in [*R.ZERO_IS_MISSING, "unused"]) + " AS BIGINT) AS empty_columns FROM z")
def _(t):
    z = zero_to_null(t.clinical, R.ZERO_IS_MISSING).withColumn("unused", F.lit(None).cast("double"))
    return Q.empty_rows_and_columns(z, [*R.ZERO_IS_MISSING, "unused"])


@query("d8_column_types", _union("column_name", {
    "c_acctbal": ("'double'", "TRUE", "COUNT(c_acctbal)"), "c_name": ("'string'", "FALSE", "COUNT(TRY_CAST(c_name AS DOUBLE))"),
    "c_phone": ("'absent'", "FALSE", "0 * COUNT(*)")}, ["data_type", "is_numeric", "convertible_rows"]))
def _(t):
    return Q.type_check(t.customer, ["c_acctbal", "c_name", "c_phone"])


_LAYER = ["id", "pregnancies", "glucose", "bmi", "age", "outcome", "insulin"]


@query("d9_layer_quality_report", S.WITH_SILVER + " UNION ALL ".join(
    f"SELECT 'silver' AS layer_name, '{k}' AS metric_name, CAST({v} AS DOUBLE) AS metric_value FROM silver" for k, v in {
        "total_records": "COUNT(*)", "total_columns": "7 + 0 * COUNT(*)", **{f"{c}_missing_pct": S.rate(f"{c} IS NULL", 2) for c in _LAYER},
        **{f"{c}_mean": S.avg(c, 4) for c in _LAYER}}.items()))
def _(t):
    return Q.layer_report(t.silver.select(*_LAYER), "silver")


_NOW = dt.datetime(2002, 1, 1)
_MCOLS = ["glucose", "blood_pressure", "bmi", "processed_timestamp"]


@query("d10_layer_metrics", S.WITH_SILVER + ", m AS (SELECT COUNT(*) AS n, " + S.r("(" + " + ".join(
    f"(COUNT(*) - COUNT({c})) * 1e2 / COUNT(*)" for c in _MCOLS[:3]) + ") / 3e0", 4) + " AS p, " + S.r(
    "(epoch_us(TIMESTAMP '2002-01-01 00:00:00') - epoch_us(MAX(processed_timestamp))) / 3.6e9", 4) + " AS a FROM silver) SELECT"
    " 'silver_total_records' AS metric_name, CAST(n AS DOUBLE) AS metric_value FROM m UNION ALL SELECT 'silver_total_columns', 4e0 FROM m UNION ALL"
    " SELECT 'silver_avg_missing_pct', p FROM m UNION ALL SELECT 'silver_data_age_hours', a FROM m")
def _(t):
    now = F.lit(_NOW).cast("timestamp_ntz")
    return Q.layer_metrics(t.silver.select(*_MCOLS), "silver", now, "processed_timestamp", skip=["processed_timestamp"])


@query("d11_layer_checks", S.WITH_GOLD + "SELECT (SELECT COUNT(*) FROM clinical) AS bronze_records, (SELECT " + S.cnt("COALESCE(glucose, 0) = 0")
       + " FROM clinical) AS missing_glucose, (SELECT " + S.cnt("is_valid") + " FROM silver) AS valid_records, (SELECT " + S.avg("quality_score", 6)
       + " FROM silver) AS avg_quality_score, (SELECT MIN(quality_score) FROM silver) AS min_quality_score, COUNT(DISTINCT health_risk_level) AS"
       " risk_levels, COUNT(DISTINCT age_group) AS age_groups, COUNT(DISTINCT bmi_category) AS bmi_categories, " + S.avg("risk_score", 6)
       + " AS avg_risk_score FROM gold")
def _(t):
    levels = lambda c: F.size(F.collect_set(c)).cast("bigint")
    gold = t.gold.agg(levels("health_risk_level").alias("risk_levels"), levels("age_group").alias("age_groups"),
                      levels("bmi_category").alias("bmi_categories"), mean("risk_score", 6).alias("avg_risk_score"))
    bronze = scalar_struct(t.clinical.agg(n().alias("n"), n_if(F.coalesce("glucose", F.lit(0.0)) == 0).alias("g")))
    silver = scalar_struct(t.silver.agg(n_if(C("is_valid")).alias("v"), mean("quality_score", 6).alias("a"), F.min("quality_score").alias("m")))
    return attach_scalars(gold, bronze_records=bronze["n"], missing_glucose=bronze["g"], valid_records=silver["v"],
                          avg_quality_score=silver["a"], min_quality_score=silver["m"])


@query("d12_post_load_thresholds", S.WITH_GOLD + ", m AS (SELECT AVG(quality_score) AS q, COUNT(*) AS n, COUNT(DISTINCT health_risk_level) AS lv"
       " FROM gold) SELECT 'average_quality' AS check_name, " + S.r("q", 6) + " AS value, q >= 0.7 AS passed, 'fail' AS severity FROM m UNION ALL"
       " SELECT 'records', CAST(n AS DOUBLE), n > 0, 'fail' FROM m UNION ALL SELECT 'risk_levels', CAST(lv AS DOUBLE), lv >= 3, 'warn' FROM m")
def _(t):
    stats = t.gold.agg(mean("quality_score", 6).alias("q"), n().alias("n"), F.size(F.collect_set("health_risk_level")).alias("lv"))
    return Q.threshold_rows(stats, [("average_quality", C("q"), C("q") >= 0.7, "fail"), ("records", C("n"), C("n") > 0, "fail"),
                                    ("risk_levels", C("lv"), C("lv") >= 3, "warn")])


@query("d13_metric_log_pass_rule", "WITH m AS (SELECT 'row_count' AS metric_name, CAST(COUNT(*) AS DOUBLE) AS metric_value, 1000000e0 AS threshold_value"
       " FROM orders UNION ALL SELECT 'avg_price', " + S.avg("o_totalprice", 4) + ", 1000e0 FROM orders UNION ALL SELECT 'max_price',"
       " MAX(o_totalprice), NULL FROM orders) SELECT 'orders' AS table_name, 'sales' AS schema_name, metric_name, metric_value, threshold_value,"
       " threshold_value IS NULL OR CASE WHEN metric_name = 'row_count' THEN metric_value <= threshold_value ELSE metric_value >= threshold_value"
       " END AS is_passed FROM m")
def _(t):
    rows = metric_rows(t.orders, {"row_count": n(), "avg_price": mean("o_totalprice", 4), "max_price": F.max("o_totalprice")})
    log = Q.log_metrics(rows, "sales", "orders", {"row_count": 1e6, "avg_price": 1000.0}, F.lit(_NOW))
    return log.drop("check_timestamp")


@query("d14_layer_completeness_accuracy", S.WITH_CLINICAL + "SELECT " + S.pct(S.cnt("glucose > 0 AND bmi > 0"), "COUNT(*)", 2) + " AS completeness, "
       + S.pct(S.cnt("glucose >= 0 AND glucose <= 400 AND bmi >= 10 AND bmi <= 60 AND age >= 0 AND age <= 120"), "COUNT(*)", 2)
       + " AS accuracy FROM clinical")
def _(t):
    ok = C("glucose").between(0, 400) & C("bmi").between(10, 60) & C("age").between(0, 120)
    return t.clinical.agg(rate((C("glucose") > 0) & (C("bmi") > 0), 2).alias("completeness"), rate(ok, 2).alias("accuracy"))


_CHECKS = {"glucose_positive": "glucose > 0", "bmi_range": "bmi > 0 AND bmi < 60", "age_range": "age BETWEEN 21 AND 80",
           "outcome_binary": "outcome IN (0, 1)"}


@query("d15_constraint_split", S.WITH_CLINICAL + ", c AS (SELECT *, concat_ws(',', " + ", ".join(
    f"CASE WHEN NOT ({v}) THEN '{k}' END" for k, v in _CHECKS.items()) + ") AS reject_reasons FROM clinical) SELECT reject_reasons, COUNT(*) AS n_rows"
    " FROM c GROUP BY 1")
def _(t):
    rules = {"glucose_positive": C("glucose") > 0, "bmi_range": (C("bmi") > 0) & (C("bmi") < 60), "age_range": C("age").between(21, 80),
             "outcome_binary": C("outcome").isin(0, 1)}
    good, bad = Q.split_by_constraints(t.clinical, rules)
    kept = good.agg(n().alias("n_rows")).select(F.lit("").alias("reject_reasons"), "n_rows")
    return report(bad, {"reject_reasons": F.array_join("reject_reasons", ",")}, {"n_rows": n()}).unionByName(kept)


@query("d16_completeness_between_layers", S.WITH_GOLD + "SELECT COUNT(*) AS part_records, (SELECT COUNT(*) FROM clinical) AS whole_records, "
       + S.pct("COUNT(*)", "(SELECT COUNT(*) FROM clinical)", 2) + " AS completeness_pct FROM gold")
def _(t):
    return Q.completeness_between(t.gold, t.clinical)


@query("d17_column_counts", S.rows("column_name", {
    c: {"null_count": S.cnt(f"{c} IS NULL"), "zero_count": S.cnt(f"{c} = 0"), "outlier_count": S.cnt(f"{c} < {lo} OR {c} > {hi}"),
        "record_count": S.cnt()} for c, (lo, hi) in R.EXPECTED_RANGES.items()}, "clinical", S.WITH_CLINICAL))
def _(t):
    return Q.column_quality_counts(t.clinical, R.EXPECTED_RANGES)
