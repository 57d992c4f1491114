"""A*: aggregations; K*: metrics shaping; O*: sorting, limits, set operations."""

from __future__ import annotations

import datetime as dt
from functools import reduce
from operator import and_

from pyspark.sql import Window
from pyspark.sql import functions as F

from vitalmart.functions.bands import band
from vitalmart.functions.numeric import pct, ratio, rnd
from vitalmart.operators import aggregate as A
from vitalmart.operators import metrics as K
from vitalmart.operators import sketches as SK
from vitalmart.operators.quantiles import exact_percentiles, percentiles_of_columns
from vitalmart.plans.reports import seconds_between
from vitalmart.rules import clinical as R
from vitalmart.sources.writers import scratch_path

from . import sql as S
from .base import query

C = F.col
# days of a report over kept sketches, and the day between two loads
_FIRST, _LAST, _SPLIT = dt.date(2024, 1, 5), dt.date(2024, 1, 24), dt.date(2024, 1, 15)


@query("a1_global_kpis", S.WITH_CLINICAL + S.select({
    "total_records": S.cnt(), "diabetic_count": S.cnt("outcome = 1"), "non_diabetic_count": S.cnt("outcome = 0"),
    **{f"avg_{c}": S.avg(c, 2) for c in ("glucose", "bmi", "age", "blood_pressure")}}, "clinical"))
def _(t):
    return t.clinical.agg(A.n().alias("total_records"), A.n_if(C("outcome") == 1).alias("diabetic_count"),
                          A.n_if(C("outcome") == 0).alias("non_diabetic_count"),
                          *[A.mean(c, 2).alias(f"avg_{c}") for c in ("glucose", "bmi", "age", "blood_pressure")])


@query("a2_grouped_rates", S.report({"l_linestatus": "l_linestatus", "l_linenumber": "l_linenumber"}, {
    "rows_in_group": S.cnt(), "returned": S.cnt("l_returnflag = 'R'"), "return_rate": S.rate("l_returnflag = 'R'", 2),
    "avg_quantity": S.avg("l_quantity", 3), "avg_price": S.avg("l_extendedprice", 2)}, "lineitem"))
def _(t):
    back = C("l_returnflag") == "R"
    return A.report(t.lineitem, ["l_linestatus", "l_linenumber"], {
        "rows_in_group": A.n(), "returned": A.n_if(back), "return_rate": A.rate(back, 2), "avg_quantity": A.mean("l_quantity", 3),
        "avg_price": A.mean("l_extendedprice", 2)})


@query("a3_conditional_counts", """
    SELECT o_orderstatus, COUNT(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS by_filter,
           COUNT(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 END) AS by_case,
           CAST(SUM(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS BIGINT) AS by_sum FROM orders GROUP BY o_orderstatus""")
def _(t):
    """The three spellings of a conditional count, in Spark SQL."""
    t.orders.createOrReplaceTempView("vitalmart_orders")
    return t.spark.sql("""
        SELECT o_orderstatus, count(1) FILTER (WHERE o_orderpriority = '1-URGENT') AS by_filter,
               count(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 END) AS by_case,
               sum(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS by_sum
        FROM vitalmart_orders GROUP BY o_orderstatus""")


@query("a4_conditional_average", S.report({"o_orderstatus": "o_orderstatus"}, {
    f"avg_{i}": S.r(f"AVG(o_totalprice) FILTER (WHERE o_orderpriority = '{p}')", 2) for i, p in (
        ("urgent", "1-URGENT"), ("low", "5-LOW"))}, "orders"))
def _(t):
    return A.report(t.orders, ["o_orderstatus"], {
        "avg_urgent": A.mean_if(C("o_orderpriority") == "1-URGENT", "o_totalprice", 2),
        "avg_low": A.mean_if(C("o_orderpriority") == "5-LOW", "o_totalprice", 2)})


@query("a5_rate_with_zero_guard", "SELECT p_brand, " + S.pct(S.cnt("p_size > 45"), S.cnt("p_retailprice > 1000000"), 2) + " AS never, "
       + S.pct(S.cnt("p_size > 45"), S.cnt("p_size > 25"), 2) + " AS share FROM part GROUP BY p_brand")
def _(t):
    big = A.n_if(C("p_size") > 45)
    return A.report(t.part, ["p_brand"], {"never": pct(big, A.n_if(C("p_retailprice") > 1_000_000), 2),
                                          "share": pct(big, A.n_if(C("p_size") > 25), 2)})


@query("a6_distinct_count", "SELECT event_type, COUNT(DISTINCT user_id) AS users, COUNT(DISTINCT CAST(ts AS DATE)) AS days FROM events"
       " GROUP BY event_type")
def _(t):
    return A.report(t.events, ["event_type"], {"users": F.count_distinct("user_id"), "days": F.count_distinct(C("ts").cast("date"))})


@query("a6_distinct_count_approx", "SELECT event_type, COUNT(DISTINCT user_id) AS users, true AS within_error FROM events GROUP BY event_type")
def _(t):
    """The sketch (3 % standard error) for columns too wide for exact counting, held against the exact count at four deviations."""
    out = A.report(t.events, ["event_type"], {"users": F.count_distinct("user_id"), "_sketch": F.approx_count_distinct("user_id", 0.03)})
    return out.select("event_type", "users", (F.abs(C("_sketch") - C("users")) <= F.ceil(C("users") * 0.12)).alias("within_error"))


def _kept_event_days(t, name):
    """Day sketches of the events in three loads: early days, late days, and one of the early days once more."""
    path = scratch_path(t.spark, name)
    events = t.events.select(C("ts").cast("date").alias("day"), "event_type", "user_id", "value")
    for days in (C("day") < F.lit(_SPLIT), C("day") >= F.lit(_SPLIT), C("day") == F.lit(_SPLIT) - F.make_interval(days=F.lit(1))):
        sketches = SK.day_sketches(events.where(days), "day", ["event_type"], {"users": "user_id"}, {"value": "value"})
        SK.add_days(sketches, path, "day")
    return path


@query("a6_distinct_from_day_sketches", "SELECT event_type, COUNT(*) AS n_rows, COUNT(DISTINCT user_id) AS users, true AS within_error FROM events"
       f" WHERE CAST(ts AS DATE) BETWEEN DATE '{_FIRST}' AND DATE '{_LAST}' GROUP BY event_type")
def _(t):
    """Distinct users of a range of days from the kept sketches of those days alone."""
    kept = SK.kept_days(t.spark, _kept_event_days(t, "a6"), "day", _FIRST, _LAST)
    out = SK.merged(kept, ["event_type"], distinct=["users"])
    exact = A.report(t.events.where(C("ts").cast("date").between(_FIRST, _LAST)), ["event_type"], {"users": F.count_distinct("user_id")})
    return out.join(exact, "event_type").select("event_type", "n_rows", "users", SK.distinct_within("users", "users").alias("within_error"))


@query("a7_sample_deviation", S.report({"l_returnflag": "l_returnflag"}, {
    "sd_quantity": S.sd("l_quantity", 6), "sd_price": S.sd("l_extendedprice", 4)}, "lineitem"))
def _(t):
    return A.report(t.lineitem, ["l_returnflag"], {"sd_quantity": A.sd("l_quantity", 6), "sd_price": A.sd("l_extendedprice", 4)})


_CORR = [("glucose", "bmi"), ("age", "glucose"), ("age", "outcome"), ("insulin", "glucose"), ("blood_pressure", "bmi"),
         ("pregnancies", "outcome"), ("diabetes_pedigree_function", "outcome")]


@query("a8_correlations", S.WITH_CLINICAL + "SELECT " + ", ".join(f"{S.corr(a, b, 6)} AS {a}_{b}" for a, b in _CORR) + " FROM clinical")
def _(t):
    return t.clinical.agg(*[A.corr(a, b, 6).alias(f"{a}_{b}") for a, b in _CORR])


_P = {"q1": 0.25, "median": 0.5, "q3": 0.75, "p99": 0.99}


@query("a9_exact_percentiles", "SELECT l_returnflag, " + ", ".join(
    f"{S.r(f'quantile_cont(l_extendedprice, {p})', 6)} AS {k}" for k, p in _P.items()) + " FROM lineitem GROUP BY l_returnflag")
def _(t):
    out = exact_percentiles(t.lineitem, ["l_returnflag"], "l_extendedprice", _P)
    return out.select("l_returnflag", *[rnd(k, 6).alias(k) for k in _P])


@query("a9_exact_percentiles_signed", "SELECT " + ", ".join(
    f"{S.r(f'quantile_cont(c_acctbal, {p})', 6)} AS {k}" for k, p in _P.items()) + " FROM customer")
def _(t):
    """Without key, over a column with negative values."""
    out = exact_percentiles(t.customer, [], "c_acctbal", _P)
    return out.select(*[rnd(k, 6).alias(k) for k in _P])


@query("a9_exact_percentiles_of_times", "SELECT event_type, " + S.r("quantile_cont(CAST(floor(epoch(ts)) AS DOUBLE), 0.5)", 3) + " AS median_second, "
       + S.r("quantile_cont(CAST(floor(epoch(ts)) AS DOUBLE), 0.9)", 3) + " AS late_second FROM events GROUP BY event_type")
def _(t):
    """Epoch seconds: a narrow range of large numbers."""
    seconds = t.events.select("event_type", F.unix_seconds(C("ts").cast("timestamp")).alias("s"))
    out = exact_percentiles(seconds, ["event_type"], "s", {"median_second": 0.5, "late_second": 0.9}, narrow=True)
    return out.select("event_type", rnd("median_second", 3).alias("median_second"), rnd("late_second", 3).alias("late_second"))


@query("a10_approx_percentiles", "SELECT l_returnflag, " + ", ".join(f"true AS {k}_within_bound" for k in _P) + " FROM lineitem GROUP BY l_returnflag")
def _(t):
    """Sketch percentiles, each held against its rank bound (1 / accuracy of the rows) by a count."""
    accuracy, value = 10_000, C("l_extendedprice")
    sketch = A.report(t.lineitem, ["l_returnflag"], {"q": F.percentile_approx(value, list(_P.values()), accuracy)})
    counts = t.lineitem.join(sketch, "l_returnflag").groupBy("l_returnflag").agg(A.n().alias("total"), *[
        c for i, k in enumerate(_P) for c in (F.count_if(value < C("q")[i]).alias(f"{k}_below"), F.count_if(value <= C("q")[i]).alias(f"{k}_upto"))])
    slack = C("total") / accuracy + 1
    return counts.select("l_returnflag", *[((C(f"{k}_below") <= C("total") * p + slack) & (C(f"{k}_upto") >= C("total") * p - slack)).alias(
        f"{k}_within_bound") for k, p in _P.items()])


@query("a10_percentiles_from_month_sketches", "SELECT o_orderpriority, COUNT(*) AS n, " + ", ".join(f"true AS {k}_within_bound" for k in _P)
       + f" FROM orders WHERE o_orderdate >= DATE '1995-01-01' GROUP BY o_orderpriority")
def _(t):
    """Percentiles from 1995 on, merged from sketches kept per month and held against their rank bound by a count."""
    path = scratch_path(t.spark, "a10")
    orders = t.orders.withColumn("month", F.trunc("o_orderdate", "month"))
    SK.add_days(SK.day_sketches(orders, "month", ["o_orderpriority"], ranked={"price": "o_totalprice"}), path, "month")
    kept = SK.merged(SK.kept_days(t.spark, path, "month", dt.date(1995, 1, 1)), ["o_orderpriority"], ranked=["price"])
    found = kept.select("o_orderpriority", C("price_n").alias("n"), *[SK.percentile("price", p).alias(k) for k, p in _P.items()])
    late = t.orders.where(C("o_orderdate") >= F.lit(dt.date(1995, 1, 1)))
    counts = late.join(found, "o_orderpriority").groupBy("o_orderpriority", "n").agg(*[
        c for k in _P for c in (F.count_if(C("o_totalprice") < C(k)).alias(f"{k}_below"), F.count_if(C("o_totalprice") <= C(k)).alias(f"{k}_upto"))])
    return counts.select("o_orderpriority", "n", *[SK.rank_within(f"{k}_below", f"{k}_upto", "n", p).alias(f"{k}_within_bound") for k, p in _P.items()])


_PROF = ["glucose", "bmi", "age", "blood_pressure"]


@query("a11_column_profile", S.rows("feature_name", {
    c: {"mean_value": S.avg(c, 1), "std_value": S.sd(c, 1), "min_value": f"CAST(MIN({c}) AS DOUBLE)", "max_value": f"CAST(MAX({c}) AS DOUBLE)",
        "null_count": S.cnt(f"{c} IS NULL"), "total_count": S.cnt()} for c in _PROF}, "silver", S.WITH_SILVER))
def _(t):
    return A.column_profile(t.silver, _PROF)


@query("a12_string_aggregation", "SELECT o_orderstatus, string_agg(DISTINCT o_orderpriority, '; ' ORDER BY o_orderpriority) AS priorities"
       " FROM orders GROUP BY o_orderstatus")
def _(t):
    return A.joined_values(t.orders, ["o_orderstatus"], "o_orderpriority", "; ", "priorities")


@query("a13_value_distribution", "SELECT o_orderstatus, '{' || string_agg('\"' || o_orderpriority || '\":' || CAST(c AS VARCHAR), ','"
       " ORDER BY o_orderpriority) || '}' AS distribution FROM (SELECT o_orderstatus, o_orderpriority, COUNT(*) AS c FROM orders GROUP BY ALL)"
       " GROUP BY o_orderstatus")
def _(t):
    m = A.value_distribution(t.orders, ["o_orderstatus"], "o_orderpriority", "m")
    return m.select("o_orderstatus", F.to_json("m").alias("distribution"))


@query("a13_value_counts", "SELECT o_orderstatus, o_custkey, COUNT(*) AS n_rows FROM orders GROUP BY ALL")
def _(t):
    """Values and counts as rows, for a column with as many values as there are customers."""
    return A.value_counts(t.orders, ["o_orderstatus"], "o_custkey")


@query("a14_most_common", "WITH c AS (SELECT o_orderstatus, o_orderpriority, COUNT(*) AS k FROM orders GROUP BY ALL), r AS (SELECT *,"
       " row_number() OVER (PARTITION BY o_orderstatus ORDER BY k DESC, o_orderpriority) AS rn FROM c) SELECT o_orderstatus,"
       " o_orderpriority AS common_priority FROM r WHERE rn = 1")
def _(t):
    return A.most_common(t.orders, ["o_orderstatus"], "o_orderpriority", "common_priority")


_LABELLED = "(SELECT quality, CASE WHEN n_chars >= 1000 THEN 1 ELSE 0 END AS guess FROM labels JOIN documents USING (doc_id))"


def _labelled(t):
    docs = t.documents.select("doc_id", F.when(C("n_chars") >= 1000, 1).otherwise(0).alias("guess"))
    return t.labels.select("doc_id", "quality").join(docs, "doc_id")


@query("a15_confusion_matrix", S.select({
    "tp": S.cnt("quality = 1 AND guess = 1"), "tn": S.cnt("quality = 0 AND guess = 0"), "fp": S.cnt("quality = 0 AND guess = 1"),
    "fn": S.cnt("quality = 1 AND guess = 0"), "total": S.cnt()}, _LABELLED))
def _(t):
    return A.confusion_counts(_labelled(t), "quality", "guess")


@query("a16_classification_metrics", "WITH m AS (" + S.select({
    "tp": S.cnt("quality = 1 AND guess = 1"), "tn": S.cnt("quality = 0 AND guess = 0"), "fp": S.cnt("quality = 0 AND guess = 1"),
    "fn": S.cnt("quality = 1 AND guess = 0"), "total": S.cnt()}, _LABELLED) + ") SELECT *, " + ", ".join(
        f"{S.r(f'({a}) / NULLIF({b}, 0)', 6)} AS {k}" for k, a, b in (
            ("accuracy", "tp + tn", "total"), ("precision", "tp", "tp + fp"), ("recall", "tp", "tp + fn"), ("specificity", "tn", "tn + fp"),
            ("npv", "tn", "tn + fn"), ("f1_score", "2 * tp", "2 * tp + fp + fn"))) + " FROM m")
def _(t):
    return A.classification_metrics(A.confusion_counts(_labelled(t), "quality", "guess"))


_MISS = ["glucose", "blood_pressure", "skin_thickness", "insulin", "bmi"]


@query("a17_missing_values", S.rows("column_name", {
    c: {"missing_count": S.cnt(f"{c} IS NULL"), "missing_pct": S.rate(f"{c} IS NULL", 2)} for c in _MISS}, "silver", S.WITH_SILVER))
def _(t):
    return A.missing_report(t.silver, _MISS)


@query("a18_describe", "SELECT 'count' AS summary, COUNT(p_size)::VARCHAR AS p_size FROM part UNION ALL SELECT 'min', MIN(p_size)::VARCHAR"
       " FROM part UNION ALL SELECT 'max', MAX(p_size)::VARCHAR FROM part")
def _(t):
    return t.part.select("p_size").summary("count", "min", "max")


_FULL = ["glucose", "bmi", "age"]


@query("a18_describe_full", S.WITH_CLINICAL + " UNION ALL ".join(f"SELECT '{name}' AS summary, " + ", ".join(
    f"{S.r(f'{f}({c})', 6)} AS {c}" for c in _FULL) + " FROM clinical" for name, f in (
    ("count", "COUNT"), ("mean", "AVG"), ("stddev", "stddev_samp"), ("min", "MIN"), ("max", "MAX"))))
def _(t):
    """The printed summary, its texts read as numbers."""
    out = t.clinical.select(*_FULL).summary("count", "mean", "stddev", "min", "max")
    return out.select("summary", *[rnd(C(c).cast("double"), 6).alias(c) for c in _FULL])


@query("a18_profile_from_day_sketches", "SELECT event_type, COUNT(value) AS n, MIN(value) AS min, MAX(value) AS max, " + S.avg("value", 6)
       + " AS mean, " + S.sd("value", 6) + " AS std, true AS quartiles_within_bound FROM events WHERE CAST(ts AS DATE) BETWEEN"
       f" DATE '{_FIRST}' AND DATE '{_LAST}' GROUP BY event_type")
def _(t):
    """A profile of a range of days without their rows: exact extremes, mean and deviation, quartiles within their bound."""
    kept = SK.merged(SK.kept_days(t.spark, _kept_event_days(t, "a18"), "day", _FIRST, _LAST), ["event_type"], ranked=["value"])
    quartiles = {"q1": 0.25, "q2": 0.5, "q3": 0.75}
    found = kept.select("event_type", C("value_n").alias("n"), C("value_min").alias("min"), C("value_max").alias("max"),
                        rnd(F.try_divide("value_sum", "value_n"), 6).alias("mean"), rnd(SK.deviation("value"), 6).alias("std"),
                        *[SK.percentile("value", p).alias(q) for q, p in quartiles.items()])
    rows = t.events.where(C("ts").cast("date").between(_FIRST, _LAST)).select("event_type", "value")
    counts = rows.join(found, "event_type").groupBy("event_type", "n", "min", "max", "mean", "std").agg(*[
        c for q in quartiles for c in (F.count_if(C("value") < C(q)).alias(f"{q}_below"), F.count_if(C("value") <= C(q)).alias(f"{q}_upto"))])
    within = reduce(and_, [SK.rank_within(f"{q}_below", f"{q}_upto", "n", p) for q, p in quartiles.items()])
    return counts.select("event_type", "n", "min", "max", "mean", "std", within.alias("quartiles_within_bound"))


_SHAPE = ["glucose", "bmi", "insulin", "age"]


@query("a19_skewness_kurtosis", S.WITH_CLINICAL + ", x AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {S.avg(c, 6)} AS mean, {S.sd(c, 6)} AS std, CAST(MIN({c}) AS DOUBLE) AS min, CAST(MAX({c}) AS DOUBLE)"
    f" AS max, {S.r(f'skewness({c})', 6)} AS skewness, {S.r(f'kurtosis({c})', 6)} AS kurtosis, {S.r(f'quantile_cont({c}, 0.5)', 6)} AS median"
    f" FROM clinical" for c in _SHAPE) + ") SELECT * FROM x")
def _(t):
    middle = percentiles_of_columns(t.clinical, _SHAPE, {"median": 0.5}).select("column_name", rnd("median", 6).alias("median"))
    return A.moments(t.clinical, _SHAPE).join(middle, "column_name")


@query("a20_class_balance", S.select({
    "class_0_count": S.cnt("toxic = 0"), "class_1_count": S.cnt("toxic = 1"),
    "class_balance_ratio": S.r(f"{S.cnt('toxic = 1')} / NULLIF({S.cnt('toxic = 0')}, 0)", 6),
    "is_balanced": f"COALESCE({S.cnt('toxic = 1')} / NULLIF({S.cnt('toxic = 0')}, 0) BETWEEN 0.2 AND 5, FALSE)"}, "labels"))
def _(t):
    return A.class_balance(t.labels, "toxic")


@query("a21_multi_statistic_group_by", S.report({"p_brand": "p_brand", "p_type": "p_type"}, {
    k: v for c in ("p_size", "p_retailprice") for k, v in ((f"{c}_mean", S.avg(c, 4)), (f"{c}_std", S.sd(c, 4)), (
        f"{c}_min", f"CAST(MIN({c}) AS DOUBLE)"), (f"{c}_max", f"CAST(MAX({c}) AS DOUBLE)"))}, "part"))
def _(t):
    m = {}
    for c in ("p_size", "p_retailprice"):
        m |= {f"{c}_mean": A.mean(c, 4), f"{c}_std": A.sd(c, 4), f"{c}_min": F.min(c).cast("double"), f"{c}_max": F.max(c).cast("double")}
    return A.report(t.part, ["p_brand", "p_type"], m)


@query("a22_count_of_levels", "SELECT c_mktsegment, COUNT(*) AS row_count, " + S.pct("COUNT(*)", "SUM(COUNT(*)) OVER ()", 6)
       + " AS share_pct FROM customer GROUP BY c_mktsegment")
def _(t):
    return K.pivot_free_counts(t.customer, "c_mktsegment")


@query("a23_duration_and_latency", "SELECT event_type, " + S.r("(epoch_us(MAX(ts)) - epoch_us(MIN(ts))) / 1e6", 3) + " AS duration_seconds, "
       + S.r("(epoch_us(MAX(ts)) - epoch_us(MIN(ts))) / 1e6 / COUNT(*)", 6) + " AS seconds_per_record, " + S.r("COUNT(*) / 3600e0", 6)
       + " AS records_per_second FROM events GROUP BY event_type")
def _(t):
    span = seconds_between(F.max("ts"), F.min("ts"))
    return A.report(t.events, ["event_type"], {"duration_seconds": rnd(span, 3), "seconds_per_record": rnd(ratio(span, A.n()), 6),
                                               "records_per_second": rnd(A.n() / 3600.0, 6)})


@query("a24_success_rate_per_group", "SELECT event_type, COUNT(*) AS runs, " + S.rate("value >= 20", 2) + " AS success_rate, "
       + S.avg("value", 4) + " AS avg_duration FROM events GROUP BY event_type")
def _(t):
    return A.report(t.events, ["event_type"], {"runs": A.n(), "success_rate": A.rate(C("value") >= 20, 2), "avg_duration": A.mean("value", 4)})


@query("a25_group_by_expression", S.report({"age_band": S.ladder("age", R.AGE_DECADES), "glucose_band": S.ladder("glucose", R.GLUCOSE_140)}, {
    "patients": S.cnt(), "rate": S.rate("outcome = 1", 2)}, "clinical", S.WITH_CLINICAL))
def _(t):
    return A.report(t.clinical, {"age_band": band("age", R.AGE_DECADES), "glucose_band": band("glucose", R.GLUCOSE_140)},
                    {"patients": A.n(), "rate": A.rate(C("outcome") == 1, 2)})


# ---- metrics shaping -------------------------------------------------------
_LEVELS = ["Critical", "High", "Medium", "Low"]
_BUSINESS = {
    "total_patients": S.cnt(), "avg_risk_score": S.avg("risk_score", 6), "high_risk_patients": S.cnt("intervention_priority = 'Immediate'"),
    "high_risk_percentage": S.rate("intervention_priority = 'Immediate'", 4),
    **{lv: S.cnt(f"health_risk_level = '{lv}'") for lv in _LEVELS}, **{f"diabetes_{v}": S.cnt(f"diabetes = {v}") for v in (0, 1)}}


@query("k1_business_metrics", S.WITH_GOLD + S.select(_BUSINESS, "gold"))
def _(t):
    return K.business_metrics(t.gold, _LEVELS)


@query("k2_wide_to_long", S.WITH_GOLD + ", b AS (" + S.select(_BUSINESS, "gold") + ") " + " UNION ALL ".join(
    f"SELECT '{k}' AS metric_name, CAST({k} AS DOUBLE) AS metric_value FROM b" for k in _BUSINESS))
def _(t):
    return K.to_long(K.business_metrics(t.gold, _LEVELS))


@query("k3_exposition_lines", "SELECT 'orders_' || lower(o_orderstatus) || '{job=\"orders\"} ' || CAST(COUNT(*) AS VARCHAR) || '.0 1704067200000'"
       " AS line FROM orders GROUP BY o_orderstatus")
def _(t):
    counts = A.report(t.orders, {"metric_name": F.concat(F.lit("orders_"), F.lower("o_orderstatus"))}, {"metric_value": A.n().cast("double")})
    return K.exposition_lines(counts, "orders", F.lit(dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)))


@query("k4_metric_normalisation", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS model_score, 0e0 AS model_auc FROM events")
def _(t):
    return K.pick_keys(t.events.select("event_id", "props"), "props", {"model_score": "k", "model_auc": "auc"})


# ---- sorting, limits, sets -------------------------------------------------
@query("o1_sort", "SELECT o_orderpriority, CAST(row_number() OVER (ORDER BY COUNT(*) DESC, o_orderpriority) AS BIGINT) AS place, COUNT(*) AS orders"
       " FROM orders GROUP BY o_orderpriority")
def _(t):
    groups = A.report(t.orders, ["o_orderpriority"], {"orders": A.n()})
    place = F.row_number().over(Window.orderBy(C("orders").desc(), "o_orderpriority")).cast("bigint")
    return groups.withColumn("place", place).orderBy("place")


@query("o2_sort_by_expression", "WITH d AS (SELECT event_type, " + S.r("AVG(value) - 50", 6) + " AS deviation FROM events GROUP BY event_type)"
       " SELECT *, CAST(row_number() OVER (ORDER BY abs(deviation) DESC) AS BIGINT) AS place FROM d")
def _(t):
    d = A.report(t.events, ["event_type"], {"deviation": rnd(F.avg("value") - 50, 6)})
    return d.withColumn("place", F.row_number().over(Window.orderBy(F.abs("deviation").desc())).cast("bigint")).orderBy(
        F.abs("deviation").desc())


@query("o3_top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def _(t):
    return t.orders.orderBy(C("o_totalprice").desc(), "o_orderkey").limit(10).select("o_orderkey", "o_totalprice")


@query("o3_latest_one", "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at FROM events ORDER BY ts DESC, event_id DESC LIMIT 1")
def _(t):
    return t.events.orderBy(C("ts").desc(), C("event_id").desc()).limit(1).select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("at"))


@query("o4_sample_rows", "SELECT COUNT(*) AS sampled FROM (SELECT * FROM customer LIMIT 500)")
def _(t):
    """LIMIT without order: only the number of rows is defined."""
    return t.customer.limit(500).agg(A.n().alias("sampled"))


@query("o5_distinct", "SELECT DISTINCT p_brand, p_type FROM part")
def _(t):
    return t.part.select("p_brand", "p_type").distinct()


@query("o6_union_all", "SELECT 'orders' AS source, o_orderstatus AS value, COUNT(*) AS n FROM orders GROUP BY 2 UNION ALL SELECT 'lineitem',"
       " l_linestatus, COUNT(*) FROM lineitem GROUP BY 2")
def _(t):
    parts = [A.report(df, {"value": c}, {"n": A.n()}).select(F.lit(name).alias("source"), "value", "n")
             for name, df, c in (("orders", t.orders, "o_orderstatus"), ("lineitem", t.lineitem, "l_linestatus"))]
    return parts[0].unionByName(parts[1])


@query("o7_schema_difference", "SELECT 'missing' AS kind, 'o_comment' AS column_name, COUNT(*) AS table_rows FROM orders UNION ALL SELECT 'extra',"
       " 'o_orderpriority', COUNT(*) FROM orders")
def _(t):
    """Expected against actual columns, with the table's row count."""
    want = {"o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_comment"}
    have = set(t.orders.columns)
    rows = [("missing", c) for c in sorted(want - have)] + [("extra", c) for c in sorted(have - want)]
    total = t.orders.agg(A.n().alias("c")).scalar()
    return t.spark.createDataFrame(rows, "kind string, column_name string").withColumn("table_rows", total)
