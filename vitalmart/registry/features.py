"""F*: scalar functions; X*: imputation, scaling, scoring, flags; U*: reusable functions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from vitalmart.functions.numeric import clamp, ratio, rnd, rnd_pos
from vitalmart.functions.scores import (fixed_zscore, logistic_score, scaled_product, tags, weighted_score)
from vitalmart.functions.udf import register_sql_functions
from vitalmart.operators import statistics as st
from vitalmart.operators.aggregate import mean, n, report
from vitalmart.operators.clean import zero_to_null
from vitalmart.plans import jobs, layers
from vitalmart.rules import clinical as R

from . import sql as S
from .base import query

C = F.col


# ---- scalar function families ----------------------------------------------
@query("f1_math_functions", f"""
    SELECT p_partkey, {S.r('p_retailprice / 7e0', 3)} AS rounded, abs(p_size - 25) AS distance,
           GREATEST(p_size, 10) AS at_least, LEAST(p_size, 40) AS at_most, {S.r('exp(p_size / 50e0)', 6)} AS grown,
           LEAST(1e0, GREATEST(0e0, (p_size - 10) / 30e0)) AS clipped, p_size / NULLIF(p_size - 25, 0) AS guarded
    FROM part""")
def _(t):
    size = C("p_size")
    return t.part.select(
        "p_partkey", rnd(C("p_retailprice") / 7, 3).alias("rounded"), F.abs(size - 25).alias("distance"),
        F.greatest(size, F.lit(10)).alias("at_least"), F.least(size, F.lit(40)).alias("at_most"),
        rnd(F.exp(size / 50.0), 6).alias("grown"), clamp((size - 10) / 30.0).alias("clipped"),
        ratio(size, size - 25).alias("guarded"))


@query("f1_rounding_of_large_sums", "WITH s AS (SELECT o_orderstatus, SUM(CAST(o_totalprice AS DOUBLE)) AS total FROM orders GROUP BY o_orderstatus) SELECT"
       " o_orderstatus, total * 1e10 AS rounded_0, total * 1e10 AS rounded_6, -total * 1e10 AS rounded_4, " + S.r("total / 1e3", 2) + " AS small FROM s")
def _(t):
    """Sums above 1e16 have no decimals left: rounding returns them as they are."""
    total = t.orders.groupBy("o_orderstatus").agg(F.sum(C("o_totalprice").cast("double")).alias("total"))
    big = C("total") * 1e10
    return total.select("o_orderstatus", rnd_pos(big, 0).alias("rounded_0"), rnd(big, 6).alias("rounded_6"), rnd(-big, 4).alias("rounded_4"),
                        rnd(C("total") / 1e3, 2).alias("small"))


@query("f2_null_functions", """
    SELECT c_custkey, COALESCE(CASE WHEN c_acctbal > 0 THEN c_acctbal END, 0e0) AS balance,
           NULLIF(c_mktsegment, 'MACHINERY') AS segment, NULLIF(c_mktsegment, 'MACHINERY') IS NULL AS is_gap FROM customer""")
def _(t):
    seg = F.nullif(C("c_mktsegment"), F.lit("MACHINERY"))
    return t.customer.select("c_custkey", F.coalesce(F.when(C("c_acctbal") > 0, C("c_acctbal")), F.lit(0.0)).alias("balance"),
                             seg.alias("segment"), seg.isNull().alias("is_gap"))


@query("f3_string_functions", """
    SELECT o_orderkey, lower(trim(o_orderpriority)) AS priority, o_orderstatus || '/' || o_orderpriority AS label,
           concat_ws('; ', o_orderstatus, o_orderpriority, CAST(o_custkey AS VARCHAR)) AS joined,
           o_orderpriority LIKE '%HIGH%' AS is_high, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS stamp,
           regexp_extract(o_orderpriority, '(\\d)-(.*)', 2) AS name FROM orders""")
def _(t):
    p = C("o_orderpriority")
    return t.orders.select(
        "o_orderkey", F.lower(F.trim(p)).alias("priority"), F.concat("o_orderstatus", F.lit("/"), p).alias("label"),
        F.array_join(F.array("o_orderstatus", p, C("o_custkey").cast("string")), "; ").alias("joined"),
        p.like("%HIGH%").alias("is_high"), F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("stamp"),
        F.regexp_extract(p, r"(\d)-(.*)", 2).alias("name"))


@query("f4_datetime_functions", """
    SELECT event_id, CAST(ts AS DATE) AS day, CAST(date_trunc('week', ts) AS DATE) AS week, CAST(date_trunc('month', ts) AS DATE)
           AS month, strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS hour, CAST(year(ts) AS BIGINT) AS y,
           CAST(month(ts) AS BIGINT) AS m, CAST(floor(epoch(ts)) AS BIGINT) AS epoch_s,
           CAST(DATE '2024-02-01' - CAST(ts AS DATE) AS BIGINT) AS days_ago, CAST(ts AS DATE) - 7 AS week_before,
           strptime(strftime(ts, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') > TIMESTAMP '2024-01-15 00:00:00' AS later
    FROM events""")
def _(t):
    ts, day = C("ts"), C("ts").cast("date")
    parsed = F.try_to_timestamp(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"), F.lit("yyyy-MM-dd HH:mm:ss"))
    return t.events.select(
        "event_id", day.alias("day"), F.date_trunc("week", ts).cast("date").alias("week"),
        F.date_trunc("month", ts).cast("date").alias("month"),
        F.date_format(F.date_trunc("hour", ts), "yyyy-MM-dd HH:mm:ss").alias("hour"), F.year(ts).cast("bigint").alias("y"),
        F.month(ts).cast("bigint").alias("m"), F.unix_seconds(ts.cast("timestamp")).alias("epoch_s"),
        F.datediff(F.lit(dt.date(2024, 2, 1)), day).cast("bigint").alias("days_ago"), F.date_sub(day, 7).alias("week_before"),
        (parsed > F.lit(dt.datetime(2024, 1, 15)).cast("timestamp_ntz").cast("timestamp")).alias("later"))


@query("f5_json_functions", """
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CAST(json_extract_string(props, '$.k') AS BIGINT) > 50
           AS big, props <> '{}' AS filled, '{"k":' || json_extract_string(props, '$.k') || ',"type":"' || event_type || '"}' AS doc
    FROM events""")
def _(t):
    k = F.from_json("props", "k bigint").getField("k")
    return t.events.select("event_id", k.alias("k"), (F.get_json_object("props", "$.k").cast("bigint") > 50).alias("big"),
                           (C("props") != "{}").alias("filled"),
                           F.to_json(F.struct(k.alias("k"), C("event_type").alias("type"))).alias("doc"))


@query("f6_array_functions", """
    SELECT p_partkey, concat_ws(',', CASE WHEN p_size > 40 THEN 'large' END, CASE WHEN p_retailprice > 1000 THEN 'dear' END, 'part')
           AS names, CAST((CASE WHEN p_size > 40 THEN 1 ELSE 0 END) + (CASE WHEN p_retailprice > 1000 THEN 1 ELSE 0 END) + 1 AS BIGINT)
           AS n_names FROM part""")
def _(t):
    found = F.array_append(tags([(C("p_size") > 40, "large"), (C("p_retailprice") > 1000, "dear")]), F.lit("part"))
    return t.part.select("p_partkey", F.array_join(found, ",").alias("names"), F.size(found).cast("bigint").alias("n_names"))


@query("f7_map_functions", S.select({"event_type": "event_type", "cost": S.lookup("event_type", {"click": 1, "error": 9}, 0)
                                     + "::BIGINT", "n_events": "COUNT(*)"}, "events", ["event_type"]))
def _(t):
    costs = F.create_map(F.lit("click"), F.lit(1), F.lit("error"), F.lit(9))
    return report(t.events, ["event_type"], {"n_events": n()}, derived={
        "cost": F.coalesce(F.try_element_at(costs, C("event_type")), F.lit(0)).cast("bigint")})


@query("f8_random_and_ids", "SELECT COUNT(*) AS row_count, TRUE AS in_range, COUNT(*) AS id_count FROM customer")
def _(t):
    """Seeded random numbers and key-derived ids, reduced to what any seed must satisfy."""
    df = t.customer.select(F.rand(42).alias("u"), F.sha2(C("c_custkey").cast("string"), 256).alias("row_id"))
    return df.groupBy("row_id").agg(n().alias("c"), F.min("u").alias("lo"), F.max("u").alias("hi")).agg(
        F.sum("c").alias("row_count"), ((F.min("lo") >= 0) & (F.max("hi") < 1)).alias("in_range"), n().alias("id_count"))


@query("f9_casts", "SELECT o_orderkey, TRY_CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS level, TRY_CAST(o_orderpriority AS DOUBLE)"
       " AS as_number, CAST(o_orderkey % 2 AS BOOLEAN) AS odd, CAST(o_totalprice AS DECIMAL(15,4)) > 100000 AS big FROM orders")
def _(t):
    return t.orders.select(
        "o_orderkey", F.substring("o_orderpriority", 1, 1).try_cast("bigint").alias("level"),
        C("o_orderpriority").try_cast("double").alias("as_number"), (C("o_orderkey") % 2).cast("boolean").alias("odd"),
        (C("o_totalprice").cast("decimal(15,4)") > 100000).alias("big"))


# ---- imputation and outliers -----------------------------------------------
_Z = ", ".join(f"NULLIF({c}, 0) AS {c}" for c in R.ZERO_IS_MISSING)
_ZEROED = S.WITH_CLINICAL + f", z AS (SELECT id, {_Z} FROM clinical)"


def _filled(columns, fill):
    return ", ".join(f"{S.r(f'COALESCE({c}, (SELECT {fill(c)} FROM z))', 6)} AS {c}" for c in columns)


@query("x1_mean_median_imputation", _ZEROED + " SELECT id, " + _filled(["glucose", "blood_pressure", "skin_thickness", "bmi"], lambda c: f"AVG({c})")
       + ", insulin AS insulin_known, true AS insulin_within_bound FROM z")
def _(t):
    """The insulin median is a sketch's (see x1_exact_median for the exact form), held against its rank bound by a count."""
    means = ["glucose", "blood_pressure", "skin_thickness", "bmi"]
    z = zero_to_null(t.clinical, R.ZERO_IS_MISSING).select("id", *R.ZERO_IS_MISSING)
    out = st.impute(z.withColumn("insulin_known", C("insulin").cast("double")), mean=means, median=["insulin"])
    filled = out.agg(F.max(F.when(C("insulin_known").isNull(), C("insulin"))).alias("_filled"))
    ranks = st.with_stats(z, "_m", filled).agg(F.count_if(C("insulin") < C("_m._filled")).alias("below"), F.count_if(C("insulin") <= C("_m._filled")).alias("upto"),
                                               F.count("insulin").alias("n"), F.max("_m._filled").alias("filled"))
    slack = C("_r.n") / 10_000 + 1  # the sketch's accuracy
    within = (C("_r.below") <= C("_r.n") / 2 + slack) & (C("_r.upto") >= C("_r.n") / 2 - slack)
    return st.with_stats(out, "_r", ranks).select("id", *[rnd(c, 6).alias(c) for c in means], "insulin_known", F.when(
        C("insulin_known").isNull(), within & (C("insulin") == C("_r.filled"))).otherwise(C("insulin") == C("insulin_known")).alias("insulin_within_bound"))


@query("x1_exact_median", _ZEROED + " SELECT id, " + _filled(["glucose"], lambda c: f"AVG({c})") + ", "
       + _filled(["insulin"], lambda c: f"quantile_cont({c}, 0.5)") + " FROM z")
def _(t):
    z = zero_to_null(t.clinical, R.ZERO_IS_MISSING).select("id", "glucose", "insulin")
    out = st.impute(z, mean=["glucose"], median=["insulin"], exact_median=True)
    return out.select("id", rnd("glucose", 6).alias("glucose"), rnd("insulin", 6).alias("insulin"))


@query("x2_mean_imputation", _ZEROED + " SELECT id, " + _filled(R.ZERO_IS_MISSING, lambda c: f"AVG({c})") + " FROM z")
def _(t):
    z = zero_to_null(t.clinical, R.ZERO_IS_MISSING).select("id", *R.ZERO_IS_MISSING)
    out = st.impute(z, mean=R.ZERO_IS_MISSING)
    return out.select("id", *[rnd(c, 6).alias(c) for c in R.ZERO_IS_MISSING])


@query("x3_zero_to_positive_median", S.WITH_CLINICAL + "SELECT id, " + ", ".join(
    f"CASE WHEN {c} = 0 THEN (SELECT quantile_cont({c}, 0.5) FROM clinical WHERE {c} > 0) ELSE {c} END AS {c}"
    for c in R.ZERO_IS_MISSING) + " FROM clinical")
def _(t):
    return st.zero_to_positive_median(t.clinical, R.ZERO_IS_MISSING).select("id", *R.ZERO_IS_MISSING)


@query("x4_constant_fill", S.WITH_WEARABLE + "SELECT person_id, COALESCE(stress_level, 'Unknown') AS stress_level,"
       " COALESCE(mood, 'Unknown') AS mood FROM wearable")
def _(t):
    return st.impute(t.wearable.select("person_id", "stress_level", "mood"), constant={"stress_level": "Unknown", "mood": "Unknown"})


_NUM = ["p_retailprice", "p_size"]
_Q = ", ".join(f"quantile_cont({c}, 0.25) AS {c}_q1, quantile_cont({c}, 0.75) AS {c}_q3" for c in _NUM)
_FENCE = f"WITH f AS (SELECT {_Q} FROM part), w AS (SELECT " + ", ".join(
    f"{c}_q1 - 0.2e0 * ({c}_q3 - {c}_q1) AS {c}_lo, {c}_q3 + 0.2e0 * ({c}_q3 - {c}_q1) AS {c}_hi" for c in _NUM) + " FROM f) "


@query("x5_iqr_cap_exact", _FENCE + "SELECT p_partkey, " + ", ".join(
    S.r(f"CASE WHEN {c} < {c}_lo THEN {c}_lo WHEN {c} > {c}_hi THEN {c}_hi ELSE {c} END", 6) + f" AS {c}" for c in _NUM)
    + " FROM part, w")
def _(t):
    """Exact fences; k = 0.2 so that the evenly spread sample columns do have outliers."""
    out = st.cap_outliers(t.part.select("p_partkey", *_NUM), _NUM, exact=True, k=0.2)
    return out.select("p_partkey", *[rnd(c, 6).alias(c) for c in _NUM])


_SKETCHED = ["glucose", "blood_pressure", "bmi", "insulin"]


@query("x5_iqr_cap_approx", S.WITH_CLINICAL + "SELECT id, " + ", ".join(f"true AS {c}_within_bound" for c in _SKETCHED) + " FROM clinical")
def _(t):
    """Sketch-based fences, the default for large tables: every capped value lies between those that the exact
    quartiles of ranks 0.2 % of the rows below and above would give."""
    z = zero_to_null(t.clinical, R.ZERO_IS_MISSING).select("id", *_SKETCHED)
    step, k = 2e-3, 1.5
    edges = st.column_percentiles(z, _SKETCHED, {"a": 0.25 - step, "b": 0.25 + step, "c": 0.75 - step, "d": 0.75 + step}, exact=True)
    capped = st.cap_outliers(z.withColumns({f"_{c}": C(c).cast("double") for c in _SKETCHED}), _SKETCHED)

    def within(c):
        a, b, lo, hi = (C(f"_e.{c}.{q}") for q in "abcd")
        clip = lambda low, high: F.when(C(f"_{c}") < low, low).when(C(f"_{c}") > high, high).otherwise(C(f"_{c}"))
        least, most = clip(a - k * (hi - a), lo - k * (b - lo)), clip(b - k * (lo - b), hi + k * (hi - a))
        low, high = F.least(least, most), F.greatest(least, most)
        return (C(c).isNull() & C(f"_{c}").isNull()) | F.coalesce(C(c).between(low, high), F.lit(False))

    return st.with_stats(capped, "_e", edges).select("id", *[within(c).alias(f"{c}_within_bound") for c in _SKETCHED])


@query("x6_iqr_to_null", _FENCE + "SELECT p_partkey, " + ", ".join(
    f"CASE WHEN {c} < {c}_lo OR {c} > {c}_hi THEN NULL ELSE CAST({c} AS DOUBLE) END AS {c}" for c in _NUM) + " FROM part, w")
def _(t):
    return st.outliers_to_null(t.part.select("p_partkey", *_NUM), _NUM, exact=True, k=0.2)


_STAT_COLS = ["glucose", "blood_pressure", "insulin", "bmi", "age"]


@query("x7_iqr_statistics", S.WITH_CLINICAL + ", q AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM clinical" for c in _STAT_COLS)
    + "), v AS (" + " UNION ALL ".join(f"SELECT '{c}' AS column_name, CAST({c} AS DOUBLE) AS x FROM clinical" for c in _STAT_COLS)
    + ") SELECT column_name, q1, q3, q3 - q1 AS iqr, q1 - 1.5e0 * (q3 - q1) AS lower_bound, q3 + 1.5e0 * (q3 - q1) AS upper_bound,"
    " COUNT(*) FILTER (WHERE x < q1 - 1.5e0 * (q3 - q1) OR x > q3 + 1.5e0 * (q3 - q1)) AS outliers_count, "
    + S.rate("x < q1 - 1.5e0 * (q3 - q1) OR x > q3 + 1.5e0 * (q3 - q1)", 2)
    + " AS outliers_percentage FROM v JOIN q USING (column_name) GROUP BY column_name, q1, q3")
def _(t):
    return st.outlier_report(t.clinical, _STAT_COLS)


# ---- scaling ---------------------------------------------------------------
@query("x8_min_max_data_range", S.WITH_CLINICAL + ", m AS (SELECT " + ", ".join(
    f"MIN({c}) AS {c}_lo, MAX({c}) AS {c}_hi" for c in ("glucose", "bmi", "age")) + " FROM clinical) SELECT id, " + ", ".join(
    S.r(f"({c} - {c}_lo) / NULLIF(CAST({c}_hi - {c}_lo AS DOUBLE), 0)", 6) + f" AS {c}_normalized" for c in ("glucose", "bmi", "age"))
    + ", 0.5e0 AS constant_normalized FROM clinical, m")
def _(t):
    cols = ["glucose", "bmi", "age"]
    scaled = st.min_max(t.clinical.select("id", *cols), cols)
    fixed = st.min_max(scaled.withColumn("constant", F.lit(3.0)), ["constant"], constant_value=0.5)
    return fixed.select("id", *[rnd(f"{c}_normalized", 6).alias(f"{c}_normalized") for c in cols], "constant_normalized")


@query("x9_min_max_fixed_clip", S.WITH_CLINICAL + "SELECT id, " + ", ".join(
    f"GREATEST(0e0, LEAST(1e0, ({c} - {lo}) / {hi - lo}e0)) AS {c}_normalized" for c, (lo, hi) in R.SCALING_RANGES.items())
    + " FROM clinical")
def _(t):
    return t.clinical.select("id", *[st.fixed_min_max(c, lo, hi).alias(f"{c}_normalized") for c, (lo, hi) in R.SCALING_RANGES.items()])


@query("x10_divisor_scaling", S.WITH_CLINICAL + "SELECT id, " + ", ".join(
    f"{c} / {d}e0 AS {c}_normalized" for c, d in R.DIVISOR_SCALING.items()) + " FROM clinical")
def _(t):
    return t.clinical.select("id", *[(C(c) / F.lit(d)).alias(f"{c}_normalized") for c, d in R.DIVISOR_SCALING.items()])


@query("x11_fixed_z_score", S.WITH_CLINICAL + "SELECT id, " + ", ".join(
    S.r(f"({c} - {m}e0) / {s}e0", 4) + f" AS {c}_z" for c, (m, s) in R.POPULATION.items()) + " FROM clinical")
def _(t):
    return t.clinical.select("id", *[fixed_zscore(c, m, s).alias(f"{c}_z") for c, (m, s) in R.POPULATION.items()])


@query("x11_data_z_score", S.WITH_CLINICAL + ", s AS (SELECT AVG(glucose) AS m, STDDEV_SAMP(glucose) AS d FROM clinical) SELECT id, "
       + S.r("(glucose - m) / d", 4) + " AS glucose_zscore FROM clinical, s")
def _(t):
    return st.z_score(t.clinical.select("id", "glucose"), ["glucose"]).select("id", "glucose_zscore")


@query("x12_interactions", S.WITH_CLINICAL + "SELECT id, " + ", ".join(
    f"{S.r(f'{a} * {b} / {s}e0', 4)} AS g_{k}" for k, (a, b, s) in R.INTERACTIONS_GOLD.items()) + ", " + ", ".join(
    f"{a} * {b} / {s}e0 AS s_{k}" for k, (a, b, s) in R.INTERACTIONS_SCALED.items()) + ", " + ", ".join(
    f"{a} * {b} / {s}e0 AS c_{k}" for k, (a, b, s) in R.INTERACTIONS_COMPACT.items())
    + ", glucose * bmi AS raw_glucose_bmi, age * glucose AS raw_age_glucose FROM clinical")
def _(t):
    return t.clinical.select(
        "id", *[scaled_product([a, b], s, 4).alias(f"g_{k}") for k, (a, b, s) in R.INTERACTIONS_GOLD.items()],
        *[scaled_product([a, b], s).alias(f"s_{k}") for k, (a, b, s) in R.INTERACTIONS_SCALED.items()],
        *[scaled_product([a, b], s).alias(f"c_{k}") for k, (a, b, s) in R.INTERACTIONS_COMPACT.items()],
        (C("glucose") * C("bmi")).alias("raw_glucose_bmi"), (C("age") * C("glucose")).alias("raw_age_glucose"))


# ---- scores ----------------------------------------------------------------
@query("x13_weighted_scores", S.WITH_CLINICAL + "SELECT id, "
       + S.r("(" + " + ".join(f"{c} * {w}e0" for c, w in R.LINEAR_SCORE) + ") / 100e0", 6) + " AS linear_score, "
       + S.r(S._ratio, 4) + " AS ratio_score, "
       + S.r("LEAST(1e0, " + " + ".join(f"{c} / {d}e0 * {w}e0" for c, d, w in R.CAPPED_SCORE) + ")", 2) + " AS capped_score, "
       + S.r(" + ".join(f"{c} / {d}e0 * {w}e0" for c, d, w in R.COMPACT_SCORE), 3) + " AS compact_score, "
       + S.r("(" + " + ".join(f"COALESCE({c}, {v}) / {d}e0" for c, d, v in R.UNWEIGHTED_SCORE) + ") * 100e0", 2)
       + " AS unweighted_score FROM clinical")
def _(t):
    linear = weighted_score(R.LINEAR_SCORE) / 100
    return t.clinical.select(
        "id", rnd(linear, 6).alias("linear_score"),
        weighted_score([(clamp(C(c) / F.lit(d)), w) for c, d, w in R.RATIO_SCORE], digits=4).alias("ratio_score"),
        rnd(F.least(F.lit(1.0), weighted_score([(C(c) / F.lit(d), w) for c, d, w in R.CAPPED_SCORE])), 2).alias("capped_score"),
        weighted_score([(C(c) / F.lit(d), w) for c, d, w in R.COMPACT_SCORE], digits=3).alias("compact_score"),
        weighted_score([(F.coalesce(C(c), F.lit(v)) / F.lit(d), 100.0) for c, d, v in R.UNWEIGHTED_SCORE], digits=2)
        .alias("unweighted_score"))


_LOGIT = " + ".join(f"{w}e0 * COALESCE({c}, {d})" for c, w, d in R.LOGISTIC_TERMS)


@query("x14_logistic_score", S.WITH_CLINICAL + "SELECT id, " + S.r(f"100e0 / (1e0 + exp(-({R.LOGISTIC_BIAS}e0 + {_LOGIT})))", 2)
       + " AS risk_score FROM clinical")
def _(t):
    return t.clinical.select("id", logistic_score(R.LOGISTIC_BIAS, R.LOGISTIC_TERMS).alias("risk_score"))


@query("x15_points_category", S.WITH_CATEGORIES + f"SELECT id, CAST({S.RISK_POINTS} AS DOUBLE) AS risk_points, risk_category FROM categories")
def _(t):
    return t.clinical.select("id", layers.risk_points().alias("risk_points"), layers.risk_category().alias("risk_category"))


_HEALTH = ("LEAST(100e0, GREATEST(0e0, 50e0 + (CASE WHEN bmi >= 18.5 AND bmi <= 25 THEN 15 ELSE -10 END)"
           " + (CASE WHEN glucose >= 70 AND glucose <= 100 THEN 15 ELSE -15 END) + (CASE WHEN blood_pressure >= 90 AND"
           " blood_pressure <= 120 THEN 10 ELSE -10 END) + (CASE WHEN age < 60 THEN 10 ELSE 0 END)"
           " + (CASE WHEN diabetes_pedigree_function < 0.5 THEN 10 ELSE -5 END)))")


def _tag_text(pairs):
    return "concat_ws(',', " + ", ".join(f"CASE WHEN {c} THEN '{name}' END" for c, name in pairs) + ")"


_TIGHT = S.WITH_CLINICAL + ", tight AS (" + S.silver_columns(R.TIGHT_BOUNDS, {
    "is_valid": "COALESCE(" + " AND ".join(S.inside(c, b) for c, b in R.TIGHT_VALIDITY.items()) + ", FALSE)",
    "quality_score": "LEAST(100e0, " + S.points([(S.inside(c, b), 20) for c, b in [
        *R.TIGHT_VALIDITY.items(), ("diabetes_pedigree_function", R.TIGHT_BOUNDS["diabetes_pedigree_function"])]]) + ")",
    "fraction_score": S.r("LEAST(1e0, " + S.points([(S.inside(c, b), 0.2) for c, b in [
        *R.TIGHT_VALIDITY.items(), ("diabetes_pedigree_function", R.TIGHT_BOUNDS["diabetes_pedigree_function"])]]) + ")", 2),
    "completeness_score": S.points([(f"{c} IS NOT NULL", 12.5) for c in R.MEASURES]),
    "anomaly_flags": _tag_text([("glucose > 300", "high_glucose"), ("blood_pressure > 200", "high_bp"),
                                ("bmi > 50", "extreme_obesity"), ("age > 100", "extreme_age")]),
    "outlier_flags": _tag_text([("glucose > 180 OR glucose < 60", "glucose_outlier"), ("bmi > 45 OR bmi < 15", "bmi_outlier"),
                                ("age > 80 OR age < 20", "age_outlier")])},
    "id, pregnancies, outcome, processing_date") + ") "


@query("x16_bounded_points", _TIGHT + f"SELECT id, {_HEALTH} AS overall_health_score FROM tight WHERE is_valid")
def _(t):
    return layers.gold_insights(layers.silver_tagged(t.clinical)).select("id", "overall_health_score")


@query("x17_deviation_score", S.WITH_CLINICAL + "SELECT id, " + S.r(" + ".join(
    f"abs({c} - {m}e0) / {m}e0 * {w}e0" for c, m, w in R.DEVIATION_TERMS), 4) + " AS anomaly_score FROM clinical")
def _(t):
    return layers.silver_scored(t.clinical).select("id", "anomaly_score")


_SUB = ["metabolic_syndrome_risk", "cardiovascular_risk", "pregnancy_risk_factor", "lifestyle_risk_score", "insulin_resistance_score"]


@query("x18_sub_scores", S.WITH_GOLD + f"SELECT id, {', '.join(_SUB)} FROM gold")
def _(t):
    return t.gold.select("id", *_SUB)


@query("x18_sub_score_labels", _TIGHT + """SELECT id,
    CASE WHEN bmi > 30 AND glucose > 100 AND blood_pressure > 130 THEN 'HIGH' WHEN bmi > 25 AND (glucose > 100 OR blood_pressure > 120)
         THEN 'MODERATE' ELSE 'LOW' END AS metabolic_syndrome_risk,
    CASE WHEN age > 55 AND blood_pressure > 140 THEN 'HIGH' WHEN age > 45 AND (blood_pressure > 120 OR bmi > 30) THEN 'MODERATE'
         ELSE 'LOW' END AS cardiovascular_risk,
    CASE WHEN outcome = 1 THEN 'HIGH_RISK' WHEN glucose > 126 OR bmi > 30 THEN 'MODERATE_RISK' WHEN glucose > 100 OR bmi > 25
         THEN 'LOW_RISK' ELSE 'MINIMAL_RISK' END AS risk_category,
    COALESCE(outcome = 1 OR glucose > 126 OR bmi > 30, FALSE) AS high_risk_flag FROM tight WHERE is_valid""")
def _(t):
    return layers.gold_insights(layers.silver_tagged(t.clinical)).select(
        "id", "metabolic_syndrome_risk", "cardiovascular_risk", "risk_category", "high_risk_flag")


@query("x19_rule_prediction", S.WITH_GOLD + "SELECT id, CAST(prediction AS INTEGER) AS prediction, prediction_probability FROM gold")
def _(t):
    return t.gold.select("id", "prediction", "prediction_probability")


@query("x20_level_ladders", S.WITH_GOLD + "SELECT id, health_risk_level, intervention_priority, estimated_cost_category FROM gold")
def _(t):
    return t.gold.select("id", "health_risk_level", "intervention_priority", "estimated_cost_category")


def _steps(a, b, c, d):
    return (f"CASE WHEN glucose > 180 AND bmi > 35 THEN '{a}' WHEN glucose > 140 OR bmi > 30 THEN '{b}' WHEN glucose > 100 OR"
            f" bmi > 25 THEN '{c}' ELSE '{d}' END")


@query("x20_compact_levels", S.WITH_CLINICAL + "SELECT id, " + _steps("Critical", "High", "Medium", "Low") + " AS health_risk_level, "
       + _steps("Immediate", "Soon", "Routine", "Monitor") + " AS intervention_priority, "
       + _steps("Very High", "High", "Medium", "Low") + " AS estimated_cost_category, "
       + S.r(" + ".join(f"{c} / {d}e0 * {w}e0" for c, d, w in R.COMPACT_SCORE), 3) + " AS risk_score FROM clinical WHERE glucose > 0"
       " AND glucose < 300 AND bmi > 0 AND bmi < 100 AND age > 0 AND age < 120")
def _(t):
    return layers.gold_compact(layers.silver_binary(t.clinical)).select(
        "id", "health_risk_level", "intervention_priority", "estimated_cost_category", "risk_score")


@query("x21_recommendation_first_match", S.WITH_GOLD + "SELECT id, treatment_recommendation, followup_frequency FROM gold")
def _(t):
    return t.gold.select("id", "treatment_recommendation", "followup_frequency")


_MED = {c: f"(SELECT quantile_cont({c}, 0.5) FROM clinical WHERE {c} > 0)" for c in R.ZERO_IS_MISSING}
_NORM = {c: f"GREATEST(0e0, LEAST(1e0, ({c} - {lo}) / {hi - lo}e0))" for c, (lo, hi) in R.SCALING_RANGES.items()}
_NSCORE = S.r("GREATEST(0e0, LEAST(1e0, " + " + ".join(f"{_NORM[c]} * {w}e0" for c, w in R.NORMALISED_WEIGHTS.items()) + " + "
              + " + ".join(f"GREATEST(0e0, LEAST(1e0, {c} / {d}e0)) * {w}e0" for c, d, w in R.NORMALISED_TAIL) + "))", 6)
_NORMALISED = (S.WITH_CLINICAL + ", filled AS (SELECT id, pregnancies, diabetes_pedigree_function, age, outcome, " + ", ".join(
    f"CASE WHEN {c} = 0 THEN {m} ELSE {c} END AS {c}" for c, m in _MED.items()) + f" FROM clinical), scored AS (SELECT *, {_NSCORE}"
    " AS risk_score FROM filled), levelled AS (SELECT *, " + S.ladder("risk_score", R.RISK_CUT)
    + " AS health_risk_level FROM scored) ")
_T = R.CARE_TEXT


@query("x22_recommendation_all_matches", _NORMALISED + "SELECT id, risk_score, health_risk_level, COALESCE(NULLIF(concat_ws('; ', "
       + ", ".join(f"CASE WHEN {c} THEN {S.q(_T[k])} END" for c, k in [
           ("health_risk_level = 'Critical'", "critical"), ("health_risk_level = 'Critical'", "critical_plan"), ("bmi > 30", "bmi"),
           ("glucose > 140", "glucose"), ("blood_pressure > 140", "pressure"), ("age > 50", "age"), ("insulin > 200", "insulin")])
       + f"), ''), {S.q(_T['default'])}) AS treatment_recommendation FROM levelled")
def _(t):
    return layers.gold_normalised(t.clinical).select("id", "risk_score", "health_risk_level", "treatment_recommendation")


@query("x22_normalised_gold", _NORMALISED + f"SELECT id, {S.ladder('bmi', R.BMI_CUT)} AS bmi_category,"
       f" {S.ladder('glucose', R.GLUCOSE_CUT)} AS glucose_category, {S.ladder('blood_pressure', R.PRESSURE_CUT)} AS bp_category,"
       f" {S.lookup('health_risk_level', {'Critical': 'Immediate', 'High': 'Soon', 'Medium': 'Routine', 'Low': 'Monitor'})}"
       " AS intervention_priority, CASE WHEN risk_score > 0.5 THEN 1 ELSE 0 END AS prediction, "
       + S.r(S.points([("bmi > 30", 0.35), ("glucose > 100", 0.35), ("blood_pressure > 130", 0.3)]), 6) + " AS metabolic, "
       + S.r(S.points([("age > 45", 0.25), ("blood_pressure > 140", 0.3), ("bmi > 30", 0.25)]) + " + outcome * 0.2e0", 6)
       + " AS cardiovascular FROM levelled")
def _(t):
    g = layers.gold_normalised(t.clinical)
    return g.select("id", "bmi_category", "glucose_category", "bp_category", "intervention_priority", "prediction",
                    rnd("metabolic_syndrome_risk", 6).alias("metabolic"), rnd("cardiovascular_risk", 6).alias("cardiovascular"))


@query("x23_tag_arrays", _TIGHT + "SELECT id, " + _tag_text([
    ("bmi > 25", "weight_management"), ("glucose > 100", "glucose_monitoring"), ("blood_pressure > 120", "bp_monitoring"),
    ("age > 45", "regular_checkups")]) + " AS recommendations, " + _tag_text([
        ("bmi > 30", "obesity"), ("glucose > 126", "diabetes"), ("blood_pressure > 140", "hypertension"), ("age > 65", "advanced_age"),
        ("diabetes_pedigree_function > 1", "family_history")]) + " AS risk_factors, " + _tag_text([
            ("bmi BETWEEN 18.5 AND 25", "healthy_weight"), ("glucose < 100", "normal_glucose"), ("blood_pressure < 120", "normal_bp"),
            ("age < 45", "young_age")]) + " AS protective_factors FROM tight WHERE is_valid")
def _(t):
    out = layers.gold_insights(layers.silver_tagged(t.clinical))
    return out.select("id", *[F.array_join(c, ",").alias(c) for c in ("recommendations", "risk_factors", "protective_factors")])


@query("x24_ratio_features", S.WITH_WEARABLE + "SELECT person_id, " + S.r("weight / ((height / 100e0) * (height / 100e0))", 2)
       + " AS bmi_calculated, " + S.r("(deep_sleep_duration + rem_sleep_duration) / sleep_duration * 100e0", 2)
       + " AS sleep_efficiency FROM wearable")
def _(t):
    return jobs.clean_wearable(t.wearable).select("person_id", "bmi_calculated", "sleep_efficiency")


@query("x25_percentile_ratios", S.WITH_GOLD + "SELECT id, age_percentile, risk_percentile FROM gold")
def _(t):
    return t.gold.select("id", "age_percentile", "risk_percentile")


_IMP = '{"glucose":0.25,"bmi":0.2,"age":0.15,"blood_pressure":0.15,"diabetes_pedigree_function":0.15,"pregnancies":0.1}'


@query("x26_feature_json", S.WITH_GOLD + f"SELECT id, '{_IMP}' AS feature_importance, risk_score AS model_risk_score,"
       " glucose_zscore AS model_glucose FROM gold")
def _(t):
    weights = F.create_map(*[x for k, v in R.FEATURE_IMPORTANCE.items() for x in (F.lit(k), F.lit(v))])
    model = F.struct(C("glucose_normalized").alias("glucose"), C("risk_score"))
    back = F.from_json(F.to_json(model), "glucose double, risk_score double")
    return t.gold.select("id", F.to_json(weights).alias("feature_importance"), back["risk_score"].alias("model_risk_score"),
                         back["glucose"].alias("model_glucose"))


@query("x27_flag_struct", S.WITH_SILVER + "SELECT id, concat_ws(',', " + ", ".join(
    f"CASE WHEN a_{x} THEN '{x}' END" for x in S._flags) + ") AS anomalies, concat_ws(',', " + ", ".join(
    f"CASE WHEN o_{x} THEN '{x}' END" for x in S._outliers) + ") AS outliers FROM silver")
def _(t):
    names = lambda col, keys: F.array_join(tags([(C(col).getField(k), k) for k in keys]), ",")
    return t.silver.select("id", names("anomaly_flags", S._flags).alias("anomalies"),
                           names("outlier_flags", S._outliers).alias("outliers"))


@query("x27_basic_flags", f"WITH {S.CLINICAL}, {S.BASIC} SELECT id, zero_glucose, zero_blood_pressure, zero_bmi, extreme_glucose,"
       " extreme_bmi FROM basic")
def _(t):
    return layers.silver_basic(t.clinical).select("id", "anomaly_flags.*")


@query("x28_flag_array", S.WITH_CLINICAL + "SELECT id, " + _tag_text([
    (f"NOT {S.inside(c, b)}", name) for (c, (b, _)), name in zip(R.COMPOSITE_QUALITY.items(), [
        "invalid_glucose", "invalid_bp", "invalid_bmi", "invalid_age", "invalid_skin_thickness", "invalid_insulin"])])
    + " AS quality_flags FROM clinical")
def _(t):
    return layers.silver_scored(t.clinical).select("id", F.array_join("quality_flags", ",").alias("quality_flags"))


@query("x28_tight_flags", _TIGHT + "SELECT id, anomaly_flags, outlier_flags FROM tight")
def _(t):
    s = layers.silver_tagged(t.clinical)
    return s.select("id", F.array_join("anomaly_flags", ",").alias("anomaly_flags"), F.array_join("outlier_flags", ",").alias("outlier_flags"))


@query("x29_additive_quality", S.WITH_SILVER + "SELECT id, quality_score FROM silver")
def _(t):
    return t.silver.select("id", "quality_score")


_TIGHT_FIELDS = [S.inside(c, b) for c, b in [*R.TIGHT_VALIDITY.items(), (
    "diabetes_pedigree_function", R.TIGHT_BOUNDS["diabetes_pedigree_function"])]]


@query("x29_quality_variants", S.WITH_CLINICAL + f"SELECT id, LEAST(100e0, {S.points([(c, 20) for c in _TIGHT_FIELDS])}) AS hundred_score, "
       + S.r(f"LEAST(1e0, {S.points([(c, 0.2) for c in _TIGHT_FIELDS])})", 2) + " AS fraction_score, "
       + S.points([(S.inside(c, b), p) for c, (b, p) in R.COMPOSITE_QUALITY.items()]) + """ AS composite_score,
       CASE WHEN glucose > 0 AND blood_pressure > 0 AND skin_thickness > 0 AND insulin > 0 AND bmi > 0 THEN 1e0 ELSE 0.8e0 END
       AS basic_score, CASE WHEN glucose > 0 AND glucose < 300 AND bmi > 0 AND bmi < 100 AND age > 0 AND age < 120
       AND blood_pressure > 0 AND blood_pressure < 250 THEN 1e0 ELSE 0.5e0 END AS binary_score FROM clinical""")
def _(t):
    """Five quality scores side by side; each is a projection of the same raw row."""
    raw = t.clinical
    keep = F.struct(*raw.columns).alias("raw")
    both = layers.silver_tagged(raw.withColumn("raw", keep)).select("id", "raw", C("quality_score").alias("hundred_score"))
    for fn, score, name in ((layers.silver_fraction, "quality_score", "fraction_score"),
                            (layers.silver_scored, "data_quality_score", "composite_score"),
                            (layers.silver_basic, "quality_score", "basic_score"),
                            (layers.silver_binary, "quality_score", "binary_score")):
        have = [c for c in both.columns if c != "raw"]
        again = fn(both.select(F.struct(*have).alias("have"), "raw", "raw.*"))
        both = again.select("have.*", "raw", C(score).alias(name))
    return both.drop("raw")


_PENALTIES = [("glucose = 0", 0.15, "zero_glucose"), ("blood_pressure = 0", 0.15, "zero_blood_pressure"), ("bmi = 0", 0.15, "zero_bmi"),
              ("glucose > 0 AND (glucose < 50 OR glucose > 250)", 0.2, "glucose_outlier"),
              ("bmi > 0 AND (bmi < 15 OR bmi > 50)", 0.2, "bmi_outlier"), ("age < 18 OR age > 100", 0.2, "age_outlier"),
              ("pregnancies > 0 AND age < 18", 0.3, "pregnancy_age_inconsistent")]


@query("x30_penalty_quality", S.WITH_CLINICAL + "SELECT id, " + S.r("GREATEST(0e0, 1e0 - (" + S.points(
    [(c, p) for c, p, _ in _PENALTIES]) + "))", 6) + " AS quality_score, " + _tag_text([(c, k) for c, _, k in _PENALTIES])
    + " AS anomaly_flags, " + S.r("GREATEST(0e0, 1e0 - (" + S.points([(c, p) for c, p, _ in _PENALTIES[3:]]) + "))", 6)
    + " AS score_without_zero_rule FROM clinical")
def _(t):
    score, hits = layers.quality_penalties()
    short, _ = layers.quality_penalties(with_zero_rule=False)
    return t.clinical.select("id", score.alias("quality_score"), F.array_join(hits, ",").alias("anomaly_flags"),
                             short.alias("score_without_zero_rule"))


@query("x31_completeness_score", S.WITH_SILVER + "SELECT id, completeness_score FROM silver")
def _(t):
    return t.silver.select("id", "completeness_score")


@query("x31_completeness_unit", _TIGHT + "SELECT id, completeness_score FROM tight")
def _(t):
    return layers.silver_tagged(t.clinical).select("id", "completeness_score")


# ---- reusable functions ----------------------------------------------------
@query("u1_category_functions", S.WITH_CATEGORIES + "SELECT id, bmi_category, age_group, glucose_category, risk_category FROM categories")
def _(t):
    """The same categories through SQL functions registered in the session."""
    register_sql_functions(t.spark)
    t.clinical.createOrReplaceTempView("vitalmart_clinical")
    return t.spark.sql("""
        SELECT id, categorize_bmi(bmi) AS bmi_category, categorize_age(age) AS age_group,
               categorize_glucose(glucose) AS glucose_category,
               calculate_risk_category(glucose, bmi, age, pregnancies, diabetes_pedigree_function) AS risk_category
        FROM vitalmart_clinical""")


@query("u3_row_rules_as_columns", _NORMALISED + "SELECT health_risk_level, COUNT(*) AS patients, " + S.avg("risk_score", 4)
       + " AS avg_risk FROM levelled GROUP BY health_risk_level")
def _(t):
    return report(layers.gold_normalised(t.clinical), ["health_risk_level"], {"patients": n(), "avg_risk": mean("risk_score", 4)})
