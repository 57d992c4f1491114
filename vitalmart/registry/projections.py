"""P*: cleaning, banding, recoding, predicates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from vitalmart.functions.bands import band, first_match, holds, order_rank, recode, recode_text
from vitalmart.functions.numeric import rnd
from vitalmart.operators import clean, joins
from vitalmart.operators.aggregate import mean, n, n_if, rate, report, text_number
from vitalmart.plans import layers, reports
from vitalmart.plans.jobs import completeness_flag
from vitalmart.rules import clinical as R

from . import sql as S
from .base import MIDDLE, query

C = F.col


@query("p1_rename_map", "SELECT c_custkey AS customer_id, c_acctbal AS balance, c_mktsegment AS segment FROM customer")
def _(t):
    names = {"c_custkey": "customer_id", "c_acctbal": "balance", "c_mktsegment": "segment", "not_there": "ignored"}
    return clean.rename(t.customer.select("c_custkey", "c_acctbal", "c_mktsegment"), names)


@query("p2_zero_as_missing", S.WITH_CLINICAL + "SELECT id, " + ", ".join(
    f"NULLIF({c}, 0) AS {c}" for c in R.ZERO_IS_MISSING) + " FROM clinical")
def _(t):
    return clean.zero_to_null(t.clinical, R.ZERO_IS_MISSING).select("id", *R.ZERO_IS_MISSING)


@query("p3_range_to_null", S.WITH_CLINICAL + "SELECT id, " + ", ".join(
    f"{S.clean(c, b)} AS {c}" for c, b in R.TIGHT_BOUNDS.items()) + " FROM clinical")
def _(t):
    return clean.out_of_bounds_to_null(t.clinical, R.TIGHT_BOUNDS).select("id", *R.TIGHT_BOUNDS)


@query("p3_range_to_null_native", "SELECT c_custkey, CASE WHEN c_acctbal >= 0 AND c_acctbal <= 5000 THEN c_acctbal END"
       " AS c_acctbal FROM customer")
def _(t):
    return clean.out_of_bounds_to_null(t.customer.select("c_custkey", "c_acctbal"), {"c_acctbal": R.Bounds(0, 5000, False)})


@query("p4_nonpositive_to_null", "SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS c_acctbal FROM customer")
def _(t):
    return clean.nonpositive_to_null(t.customer.select("c_custkey", "c_acctbal"), ["c_acctbal"])


_LEFT = {"bmi_who": ("bmi", R.BMI_WHO), "bmi_simple": ("bmi", R.BMI_SIMPLE), "bmi_snake": ("bmi", R.BMI_SNAKE),
         "age_three": ("age", R.AGE_THREE), "age_detailed": ("age", R.AGE_DETAILED), "age_snake": ("age", R.AGE_SNAKE),
         "age_ranges": ("age", R.AGE_RANGES), "age_decades": ("age", R.AGE_DECADES),
         "age_hyphen": ("age", R.AGE_THREE_HYPHEN), "glucose_three": ("glucose", R.GLUCOSE_THREE),
         "glucose_ada": ("glucose", R.GLUCOSE_ADA), "glucose_four": ("glucose", R.GLUCOSE_FOUR),
         "glucose_snake": ("glucose", R.GLUCOSE_SNAKE), "glucose_140": ("glucose", R.GLUCOSE_140),
         "pressure_three": ("blood_pressure", R.PRESSURE_THREE), "pressure_aha": ("blood_pressure", R.PRESSURE_AHA),
         "pressure_snake": ("blood_pressure", R.PRESSURE_SNAKE),
         "pressure_elevated": ("blood_pressure", R.PRESSURE_ELEVATED), "insulin_levels": ("insulin", R.INSULIN_LEVELS)}


@query("p5_band_left_closed", S.WITH_CLINICAL + "SELECT id, " + ", ".join(
    f"{S.ladder(c, b)} AS {k}" for k, (c, b) in _LEFT.items()) + " FROM clinical")
def _(t):
    return t.clinical.select("id", *[band(c, b).alias(k) for k, (c, b) in _LEFT.items()])


_RIGHT = {"bmi_cut": ("bmi", R.BMI_CUT), "age_cut": ("age", R.AGE_CUT), "glucose_cut": ("glucose", R.GLUCOSE_CUT),
          "pressure_cut": ("blood_pressure", R.PRESSURE_CUT), "pressure_cut_100": ("blood_pressure", R.PRESSURE_CUT_100),
          "pregnancy_risk": ("pregnancies", R.PREGNANCY_RISK), "parity": ("pregnancies", R.PREGNANCY_PARITY),
          "pregnancy_groups": ("pregnancies", R.PREGNANCY_GROUPS)}


@query("p6_band_right_closed", S.WITH_CLINICAL + "SELECT id, " + ", ".join(
    f"{S.ladder(c, b)} AS {k}" for k, (c, b) in _RIGHT.items()) + " FROM clinical")
def _(t):
    return t.clinical.select("id", *[band(c, b).alias(k) for k, (c, b) in _RIGHT.items()])


@query("p7_band_from_table", S.WITH_CLINICAL + "SELECT id, bmi, " + "CASE " + " ".join(
    f"WHEN bmi >= {lo} AND bmi < {nxt} THEN {S.q(name)}" for (name, lo, _, _), nxt in
    zip(R.BMI_TABLE, [b[1] for b in R.BMI_TABLE[1:]] + [99.900000001])) + " END AS category_name, CASE " + " ".join(
    f"WHEN bmi >= {lo} AND bmi < {nxt} THEN {f}e0" for (_, lo, _, f), nxt in
    zip(R.BMI_TABLE, [b[1] for b in R.BMI_TABLE[1:]] + [99.900000001])) + " END AS risk_factor FROM clinical")
def _(t):
    table = joins.half_open(R.BMI_TABLE, ["category_name", "bmi_min", "bmi_next", "risk_factor"], t.spark)
    return joins.band_join(t.clinical.select("id", "bmi"), table, "bmi", "bmi_min", "bmi_next").select(
        "id", "bmi", "category_name", "risk_factor")


@query("p8_exact_match_recode", "SELECT o_orderkey, CASE trim(lower(o_orderpriority)) WHEN '1-urgent' THEN 'Urgent'"
       " WHEN '5-low' THEN NULL ELSE o_orderpriority END AS priority FROM orders")
def _(t):
    return t.orders.select("o_orderkey", recode_text(
        "o_orderpriority", {"1-urgent": "Urgent", "5-low": None}, C("o_orderpriority")).alias("priority"))


@query("p9_map_recode", S.WITH_GOLD + f"SELECT id, {S.lookup('health_risk_level', R.LEVEL_TO_COST)} AS cost FROM gold")
def _(t):
    return t.gold.select("id", recode("health_risk_level", R.LEVEL_TO_COST).alias("cost"))


@query("p10_ordinal_in_aggregate", S.report({"age_group": "age_group"}, {
    "avg_risk_score": S.avg("CASE risk_category WHEN 'High' THEN 3 WHEN 'Medium' THEN 2 ELSE 1 END", 6)},
    "categories", S.WITH_CATEGORIES))
def _(t):
    return report(t.categories, ["age_group"], {
        "avg_risk_score": mean(recode("risk_category", {"High": 3, "Medium": 2}, 1), 6)})


@query("p11_cost_recode", S.WITH_GOLD + "SELECT id, CAST(annual_cost AS BIGINT) AS annual_cost, CAST(CASE WHEN diabetes = 0"
       " AND glucose_category = 'Prediabetic' THEN 15000 ELSE 0 END AS BIGINT) AS saving,"
       f" CAST({S.lookup('estimated_cost_category', R.KPI_COST, 0)} AS BIGINT) AS kpi_cost,"
       f" CAST({S.lookup('estimated_cost_category', R.IMPACT_COST, 0)} AS BIGINT) AS impact_cost FROM gold")
def _(t):
    return t.gold.select(
        "id", layers.annual_cost().alias("annual_cost"),
        F.when(reports.preventable(), R.PREVENTION_SAVING).otherwise(0).cast("bigint").alias("saving"),
        recode("estimated_cost_category", R.KPI_COST, 0).cast("bigint").alias("kpi_cost"),
        recode("estimated_cost_category", R.IMPACT_COST, 0).cast("bigint").alias("impact_cost"))


@query("p12_compound_flags", S.WITH_CLINICAL + f"SELECT id, COALESCE({S.rules(R.HIGH_RISK)}, FALSE) AS high_risk_flag, ({S.rules(R.REFERRAL)}) AS referral"
       " FROM clinical")
def _(t):
    return t.clinical.select("id", F.coalesce(holds(R.HIGH_RISK), F.lit(False)).alias("high_risk_flag"), holds(R.REFERRAL).alias("referral"))


@query("p13_multi_rule_validity", S.WITH_SILVER + "SELECT id, is_valid, glucose_valid, bmi_valid, age_valid, bp_valid FROM silver")
def _(t):
    return t.silver.select("id", "is_valid", "glucose_valid", "bmi_valid", "age_valid", "bp_valid")


@query("p13_strict_validity", S.WITH_CLINICAL + "SELECT id, COALESCE(glucose > 0 AND glucose < 300 AND blood_pressure > 0 AND"
       " blood_pressure < 200 AND bmi > 0 AND bmi < 60 AND age > 0 AND age < 120, FALSE) AS is_valid FROM clinical")
def _(t):
    return layers.silver_basic(t.clinical).select("id", "is_valid")


@query("p14_completeness_flag", S.WITH_CLINICAL + "SELECT id, CASE WHEN NULLIF(glucose, 0) IS NULL OR NULLIF(blood_pressure, 0)"
       " IS NULL OR NULLIF(bmi, 0) IS NULL THEN 'INCOMPLETE' ELSE 'COMPLETE' END AS data_quality_flag FROM clinical")
def _(t):
    marked = clean.zero_to_null(t.clinical, R.ZERO_IS_MISSING)
    return marked.select("id", completeness_flag(["glucose", "blood_pressure", "bmi"]).alias("data_quality_flag"))


@query("p15_relative_date_windows", """
    SELECT event_type, COUNT(*) FILTER (WHERE CAST(ts AS DATE) >= DATE '2024-01-20' - 7) AS last_7_days,
           COUNT(*) FILTER (WHERE CAST(ts AS DATE) >= DATE '2024-01-20' - 30) AS last_30_days,
           COUNT(*) FILTER (WHERE CAST(ts AS DATE) >= DATE '2024-01-20' - 90) AS last_90_days,
           COUNT(*) FILTER (WHERE ts > TIMESTAMP '2024-01-20 00:00:00' - INTERVAL 24 HOUR) AS last_24_hours
    FROM events GROUP BY event_type""")
def _(t):
    day, now = dt.date(2024, 1, 20), dt.datetime(2024, 1, 20)
    on = C("ts").cast("date")
    return report(t.events, ["event_type"], {
        **{f"last_{d}_days": n_if(on >= F.date_sub(F.lit(day), d)) for d in (7, 30, 90)},
        "last_24_hours": n_if(C("ts") > reports._at(now, hours=24))})


@query("p15_recent_rows", f"SELECT o_orderpriority, COUNT(*) AS orders, {S.r('SUM(o_totalprice)', 2)} AS total FROM orders"
       " WHERE CAST(o_orderdate AS DATE) >= DATE '1998-07-15' - 90 GROUP BY o_orderpriority")
def _(t):
    rows = reports.recent(t.orders.withColumn("day", C("o_orderdate").cast("date")), MIDDLE, 90, "day")
    return report(rows, ["o_orderpriority"], {"orders": n(), "total": rnd(F.sum("o_totalprice"), 2)})


@query("p16_equality_to_day", f"SELECT l_returnflag, COUNT(*) AS n_rows, {S.avg('l_quantity', 4)} AS avg_qty FROM lineitem"
       " WHERE CAST(l_shipdate AS DATE) = DATE '1998-07-15' GROUP BY l_returnflag")
def _(t):
    rows = t.lineitem.where(C("l_shipdate").cast("date") == F.lit(MIDDLE))
    return report(rows, ["l_returnflag"], {"n_rows": n(), "avg_qty": mean("l_quantity", 4)})


@query("p17_predicates", S.WITH_GOLD + "SELECT bmi_category, COUNT(*) AS patients FROM gold WHERE health_risk_level IN"
       " ('High', 'Critical') AND bmi_category LIKE 'Obese%' AND glucose BETWEEN 70 AND 180 AND insulin IS NOT NULL"
       " GROUP BY bmi_category")
def _(t):
    rows = t.gold.where(reports.high_risk() & C("bmi_category").like("Obese%") & C("glucose").between(70, 180) & C("insulin").isNotNull())
    return report(rows, ["bmi_category"], {"patients": n()})


@query("p18_drop_sparse_rows", S.WITH_CLINICAL + ", z AS (SELECT id, " + ", ".join(
    f"NULLIF({c}, 0) AS {c}" for c in R.ZERO_IS_MISSING) + " FROM clinical) SELECT * FROM z WHERE (" + " + ".join(
    f"CASE WHEN {c} IS NULL THEN 0 ELSE 1 END" for c in ["id", *R.ZERO_IS_MISSING]) + ") >= 5")
def _(t):
    z = clean.zero_to_null(t.clinical, R.ZERO_IS_MISSING).select("id", *R.ZERO_IS_MISSING)
    return clean.drop_sparse_rows(z, 0.9)


@query("p19_numeric_columns", "SELECT " + ", ".join(
    f"{S.avg(c, 4)} AS {c}" for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                                      "l_discount", "l_tax")) + " FROM lineitem")
def _(t):
    names = clean.numeric_columns(t.lineitem, exclude=["l_returnflag", "l_shipdate"])
    return t.lineitem.agg(*[mean(c, 4).alias(c) for c in names])


@query("p20_cast_to_double", "SELECT p_partkey, CAST(p_size AS DOUBLE) AS p_size, p_retailprice FROM part")
def _(t):
    return clean.as_double(t.part.select("p_partkey", "p_size", "p_retailprice"), ["p_size", "p_retailprice"])


@query("p21_custom_order_key", "SELECT o_orderpriority, COUNT(*) AS orders, CAST(CASE o_orderpriority WHEN '2-HIGH' THEN 1"
       " WHEN '1-URGENT' THEN 2 ELSE 3 END AS BIGINT) AS place FROM orders GROUP BY o_orderpriority")
def _(t):
    place = order_rank("o_orderpriority", ["2-HIGH", "1-URGENT"]).cast("bigint")
    return report(t.orders, ["o_orderpriority"], {"orders": n()}, derived={"place": place}).orderBy("place")


@query("p22_label_concat", S.WITH_GOLD + "SELECT age_group || ' - ' || bmi_category AS label, '$' || printf('%.1f', "
       + S.r("SUM(annual_cost) / 1e6", 1) + ") || 'M' AS cost, printf('%.2f', " + S.rate("diabetes = 1", 2)
       + ") || '%' AS rate FROM gold GROUP BY age_group, bmi_category")
def _(t):
    out = report(t.gold, ["age_group", "bmi_category"], {"c": F.sum(layers.annual_cost()), "p": rate(reports.sick(), 2)})
    return out.select(F.concat_ws(" - ", "age_group", "bmi_category").alias("label"),
                      F.concat(F.lit("$"), text_number(C("c") / 1e6, 1), F.lit("M")).alias("cost"),
                      F.concat(text_number(C("p"), 2), F.lit("%")).alias("rate"))


@query("p23_status_from_threshold", "SELECT event_type, CASE WHEN MAX(ts) > TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 1 HOUR THEN"
       " 'Healthy' WHEN MAX(ts) > TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 6 HOUR THEN 'Warning' ELSE 'Critical' END AS status,"
       " CASE WHEN AVG(value) >= 51 THEN 'Exceeded' WHEN AVG(value) >= 50 THEN 'Met' WHEN AVG(value) >= 49 THEN 'Warning'"
       " ELSE 'Breached' END AS value_sla FROM events GROUP BY event_type")
def _(t):
    now = dt.datetime(2024, 1, 30, 12)
    newest, v = F.max("ts"), F.avg("value")
    return report(t.events, ["event_type"], {
        "status": first_match([(newest > reports._at(now, hours=1), "Healthy"), (newest > reports._at(now, hours=6), "Warning")],
                              "Critical"),
        "value_sla": first_match([(v >= 51, "Exceeded"), (v >= 50, "Met"), (v >= 49, "Warning")], "Breached")})


@query("p24_latest_snapshot", S.WITH_GOLD + "SELECT id, risk_score, CASE WHEN risk_score > 0.7 THEN 'Critical' WHEN risk_score >"
       " 0.5 THEN 'High' WHEN risk_score > 0.3 THEN 'Medium' ELSE 'Low' END AS risk_assessment FROM gold"
       " WHERE processed_timestamp = (SELECT MAX(processed_timestamp) FROM gold)")
def _(t):
    return reports.latest_predictions(t.gold, ["id", "risk_score"])


@query("p25_lateral_alias", "WITH a AS (SELECT o_orderpriority, COUNT(*) AS total, COUNT(*) FILTER (WHERE o_totalprice < 50000)"
       f" AS low FROM orders GROUP BY o_orderpriority) SELECT *, {S.pct('low', 'total', 2)} AS low_pct,"
       f" CASE WHEN {S.pct('low', 'total', 2)} > 20 THEN 'High' WHEN {S.pct('low', 'total', 2)} > 10 THEN 'Medium' ELSE 'Low'"
       " END AS risk FROM a")
def _(t):
    t.orders.createOrReplaceTempView("vitalmart_orders")
    return t.spark.sql("""
        SELECT o_orderpriority, count(1) AS total, count_if(o_totalprice < 50000) AS low,
               cast(round(cast(low * 100.0d / nullif(total, 0) AS decimal(28,12)), 2) AS double) AS low_pct,
               CASE WHEN low_pct > 20 THEN 'High' WHEN low_pct > 10 THEN 'Medium' ELSE 'Low' END AS risk
        FROM vitalmart_orders GROUP BY o_orderpriority""")
