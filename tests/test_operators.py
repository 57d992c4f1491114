import datetime as dt
import decimal
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitalmart.operators import aggregate as A
from vitalmart.operators import clean, joins, quality, windows
from vitalmart.operators import statistics as S
from vitalmart.operators.quantiles import exact_percentiles, percentiles_of_columns
from vitalmart.plans import jobs, layers
from vitalmart.rules import clinical as R

C = F.col


def table(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


# ---- clean -----------------------------------------------------------------
def test_zero_and_range_cleaning(patients):
    z = {r["id"]: r for r in clean.zero_to_null(patients, R.ZERO_IS_MISSING).collect()}
    assert z[3]["blood_pressure"] is None and z[4]["bmi"] is None and z[6]["insulin"] == 1000.0
    c = {r["id"]: r for r in clean.out_of_bounds_to_null(patients, R.TIGHT_BOUNDS).collect()}
    assert c[7]["glucose"] is None and c[7]["age"] is None and c[6]["skin_thickness"] == 100.0
    assert c[8]["age"] is None and c[4]["bmi"] is None and c[1]["insulin"] == 0.0


def test_sparse_rows_and_numeric_columns(spark, patients):
    assert clean.drop_sparse_rows(patients, 0.5).count() == 7
    named = patients.withColumn("made_timestamp", F.lit(1)).withColumn("note", F.lit("x"))
    assert "note" not in clean.numeric_columns(named) and "made_timestamp" not in clean.numeric_columns(named)
    assert clean.numeric_columns(named, exclude=["outcome"])[-1] == "age"


# ---- statistics ------------------------------------------------------------
def test_imputation(spark):
    df = table(spark, [(1, 1, "a"), (2, None, None), (3, 4, "b"), (4, 7, "c")], "i int, x int, s string")
    got = {r["i"]: r for r in S.impute(df, mean=["x"], constant={"s": "?"}).collect()}
    assert got[2]["x"] == 4.0 and got[2]["s"] == "?"
    odd = table(spark, [(1, 1), (2, None), (3, 2)], "i int, x int")
    assert {r["x"] for r in S.impute(odd, mean=["x"]).collect()} == {1.0, 1.5, 2.0}
    assert {r["x"] for r in S.impute(odd, median=["x"], exact_median=True).collect()} == {1.0, 1.5, 2.0}


def test_imputation_of_empty_column_stays_null(spark):
    df = table(spark, [(None,), (None,)], "x double")
    assert [r["x"] for r in S.impute(df, mean=["x"]).collect()] == [None, None]


def test_outliers(spark):
    xs = [10.0, 11.0, 12.0, 13.0, 14.0, 100.0, None]
    df = table(spark, [(x,) for x in xs], "x double")
    q1, q3 = np.percentile(xs[:-1], [25, 75])
    hi = q3 + 1.5 * (q3 - q1)
    capped = [r["x"] for r in S.cap_outliers(df, ["x"], exact=True).collect()]
    assert max(v for v in capped if v is not None) == pytest.approx(hi) and None in capped
    assert [r["x"] for r in S.outliers_to_null(df, ["x"], exact=True).collect()].count(None) == 2
    row = S.outlier_report(df, ["x"]).first()
    assert row["outliers_count"] == 1 and row["upper_bound"] == pytest.approx(hi)


def test_min_max_of_constant_column(spark):
    df = table(spark, [(3.0,), (3.0,)], "x double")
    assert [r[1] for r in S.min_max(df, ["x"]).collect()] == [None, None]
    assert [r[1] for r in S.min_max(df, ["x"], constant_value=0.5).collect()] == [0.5, 0.5]


def test_zero_to_positive_median(spark):
    df = table(spark, [(0.0,), (2.0,), (4.0,), (9.0,), (None,)], "x double")
    assert sorted(r["x"] for r in S.zero_to_positive_median(df, ["x"]).collect() if r["x"] is not None) == [2.0, 4.0, 4.0, 9.0]


# ---- percentiles -----------------------------------------------------------
def test_exact_percentiles_match_numpy_with_a_hot_key(spark):
    rng = random.Random(7)
    rows = [("hot", rng.gauss(0, 1000)) for _ in range(2000)] + [(f"k{i % 20}", rng.uniform(-1, 1)) for i in range(3000)]
    rows += [("tie", 5.0)] * 500 + [("none", None), ("one", -3.25)]
    probs = {"p0": 0.0, "q1": 0.25, "p50": 0.5, "q3": 0.75, "p99": 0.99, "p100": 1.0}
    got = {r["k"]: r for r in exact_percentiles(table(spark, rows, "k string, x double"), ["k"], "x", probs).collect()}
    assert "none" not in got and got["tie"]["p50"] == 5.0
    for k in ("hot", "k3", "one"):
        xs = [x for key, x in rows if key == k]
        for name, p in probs.items():
            assert got[k][name] == pytest.approx(np.quantile(xs, p), rel=1e-12, abs=1e-12)


def test_percentiles_of_narrow_values(spark):
    xs = [1.7e15 + i * 37 % 1001 for i in range(1001)]
    df = table(spark, [(x,) for x in xs], "x double")
    for narrow in (False, True):
        row = exact_percentiles(df, [], "x", {"q1": 0.25, "p50": 0.5}, narrow).first()
        assert (row["q1"], row["p50"]) == (np.quantile(xs, 0.25), np.quantile(xs, 0.5))


def test_percentiles_with_null_key(spark):
    df = table(spark, [(None, 1.0), (None, 3.0), ("a", 2.0)], "k string, x double")
    got = {r["k"]: r["m"] for r in exact_percentiles(df, ["k"], "x", {"m": 0.5}).collect()}
    assert got == {None: 2.0, "a": 2.0}


def test_percentiles_of_columns_with_filter(spark):
    df = table(spark, [(0, 5.0), (2, 7.0), (4, None)], "a int, b double")
    got = {r["column_name"]: r["m"] for r in percentiles_of_columns(df, ["a", "b"], {"m": 0.5}, {"a": C("a") > 0}).collect()}
    assert got == {"a": 3.0, "b": 6.0}


def test_percentiles_with_nan_and_infinities(spark):
    inf, nan = float("inf"), float("nan")
    for xs in ([1, 2, 4, 8, nan], [-inf, 1, 2, inf, inf], [inf] * 3, [nan, nan, 1], [-inf, -inf, 5, nan], [-0.0, 0.0, -1, 1e-320, 1e308]):
        df = table(spark, [(float(x),) for x in xs], "x double")
        got = exact_percentiles(df, [], "x", {"a": 0.25, "b": 0.5, "c": 0.75, "d": 1.0}).first()
        want = df.select(*[F.expr(f"percentile(x, {p})").alias(c) for c, p in zip("abcd", (0.25, 0.5, 0.75, 1.0))]).first()
        assert [str(v) for v in got] == [str(v) for v in want], xs


def test_only_wanted_buckets_are_shuffled_by_value(spark):
    """Of 20,000 different values, only those in the buckets of the ranks reach a count by value."""
    df = spark.range(20_000).select((C("id") * 1.5 + 1).alias("x"))
    out = exact_percentiles(df, [], "x", {"q1": 0.25, "m": 0.5})
    out.collect()
    plan = out._jdf.queryExecution().executedPlan()
    sizes = []

    def walk(node):
        kids = [node.executedPlan()] if node.nodeName() == "AdaptiveSparkPlan" else [node.plan()] if "QueryStage" in node.nodeName() else None
        if "Exchange" in node.nodeName() and "_v" in node.output().toString() and node.metrics().contains("shuffleRecordsWritten"):
            sizes.append(node.metrics().apply("shuffleRecordsWritten").value())
        if kids is None:
            seq = node.children()
            kids = [seq.apply(i) for i in range(seq.size())]
        for k in kids:
            walk(k)

    walk(plan)
    assert sizes and max(sizes) < 100


# ---- aggregates ------------------------------------------------------------
def test_report_shares_and_rates(spark):
    df = table(spark, [("a", 1), ("a", 0), ("b", 1), ("b", None)], "k string, hit int")
    out = A.report(df, ["k"], {"n": A.n(), "p": A.rate(C("hit") == 1, 1)}, {"share": ("n", 1)})
    assert {r["k"]: (r["n"], r["p"], r["share"]) for r in out.collect()} == {"a": (2, 50.0, 50.0), "b": (2, 50.0, 50.0)}


def test_moments_run_as_compiled_code(spark):
    """Columns share the code that updates their sums; that of six columns at once was too long to be compiled."""
    names = [f"c{i}" for i in range(6)]
    df = spark.range(200).select(*[(C("id") % (i + 3)).cast("double").alias(c) for i, c in enumerate(names)])
    out = A.moments(df, names)
    assert {r["column_name"]: (r["min"], r["max"]) for r in out.collect()} == {c: (0.0, i + 2.0) for i, c in enumerate(names)}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("kurtosis(") <= 4  # as for one column; rounding names it several times
    nothing = A.moments(df.where("false"), names[:2]).collect()
    assert sorted(r["column_name"] for r in nothing) == names[:2] and all(r["mean"] is None and r["kurtosis"] is None for r in nothing)


def test_metric_and_struct_rows_on_empty_input(spark):
    empty = spark.createDataFrame([], "x double")
    assert {r["metric_name"]: r["metric_value"] for r in A.metric_rows(empty, {"n": A.n(), "m": A.mean("x", 1)}).collect()} == {"n": 0.0, "m": None}
    row = A.struct_rows(empty, {"x": {"n": A.n(), "p": A.rate(C("x") > 0, 1)}}, "name").first()
    assert (row["name"], row["n"], row["p"]) == ("x", 0, None)


def test_moments_match_textbook(spark):
    xs = [1.0, 2.0, 2.0, 3.0, 9.0, 4.0]
    row = A.moments(table(spark, [(x,) for x in xs], "x double"), ["x"]).first()
    n, m = len(xs), statistics.fmean(xs)
    m2, m3, m4 = (sum((x - m) ** p for x in xs) / n for p in (2, 3, 4))
    g1, g2 = m3 / m2 ** 1.5, m4 / m2 ** 2 - 3
    assert row["skewness"] == pytest.approx(g1 * (n * (n - 1)) ** 0.5 / (n - 2), abs=1e-6)
    assert row["kurtosis"] == pytest.approx((n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6), abs=1e-6)


def test_missing_counts_nan_and_null(spark):
    df = table(spark, [(1.0, "a"), (float("nan"), None), (None, "b")], "x double, s string")
    assert {r["column_name"]: r["missing_count"] for r in A.missing_report(df).collect()} == {"x": 2, "s": 1}


def test_confusion_with_zero_denominators(spark):
    df = table(spark, [(0, 0), (0, 0)], "a int, p int")
    row = A.classification_metrics(A.confusion_counts(df, "a", "p")).first()
    assert row["accuracy"] == 1.0 and row["precision"] is None and row["recall"] is None


def test_most_common_breaks_ties_by_value(spark):
    df = table(spark, [("k", "b"), ("k", "a"), ("k", None)], "k string, v string")
    assert A.most_common(df, ["k"], "v", "m").first()["m"] == "a"
    assert A.value_distribution(df, ["k"], "v", "d").first()["d"] == {"a": 1, "b": 1}


# ---- joins and windows -----------------------------------------------------
def test_new_rows_ignores_null_target_keys(spark):
    src = table(spark, [(1,), (2,), (None,)], "id int")
    tgt = table(spark, [(1,), (None,)], "id int")
    assert [r["id"] for r in joins.new_rows(src, tgt, "id").collect()] == [2]


@pytest.mark.parametrize("how", ["inner", "left", "left_anti", "left_semi"])
def test_salted_join_equals_plain_join(spark, how):
    left = table(spark, [(1 if i % 3 else i, i) for i in range(300)] + [(None, 1000), (None, 1001)], "k int, v int")
    right = table(spark, [(k, k * 10) for k in range(0, 200, 2)] + [(1, 7)], "k int, w int")
    plain, salted = (sorted(map(tuple, joins.salted_join(left, right, ["k"], how, s).collect()), key=repr) for s in (1, 5))
    assert plain == salted
    with pytest.raises(ValueError):
        joins.salted_join(left, right, ["k"], "right", 4)


@pytest.mark.parametrize("bins", [128, 2, 1])
def test_band_join_with_few_and_many_bins(spark, bins):
    df = table(spark, [(0.0,), (0.305,), (0.31,), (1.0,), (1.5,), (None,)], "x double")
    bands = joins.half_open(R.RISK_TABLE, ["name", "lo", "hi", "color"], spark)
    got = {r["x"]: r["name"] for r in joins.band_join(df, bands, "x", "lo", "hi", bins=bins).collect()}
    assert got == {0.0: "Low Risk", 0.305: "Low Risk", 0.31: "Moderate Risk", 1.0: "Critical Risk", 1.5: None, None: None}


def test_band_join_of_many_bands_with_open_ends(spark):
    inf = float("inf")
    bands = spark.range(10_001).select(F.when(C("id") == 0, -inf).otherwise(C("id") * 2.0).alias("lo"),
                                       F.when(C("id") == 10_000, inf).otherwise((C("id") + 1) * 2.0).alias("hi"), C("id").alias("band"))
    df = table(spark, [(-1e300,), (0.5,), (2.0,), (9999.0,), (20000.0,), (1e308,), (inf,), (float("nan"),), (None,)], "x double")
    got = {str(r["x"]): r["band"] for r in joins.band_join(df, bands, "x", "lo", "hi").collect()}
    assert got == {"-1e+300": 0, "0.5": 0, "2.0": 1, "9999.0": 4999, "20000.0": 10000, "1e+308": 10000, "inf": None, "nan": None, "None": None}


def test_missing_parents_counts_rows(spark):
    child = table(spark, [(9,)] * 500 + [(1,), (None,)], "k int")
    got = joins.missing_parents(child, "k", table(spark, [(1,)], "id int"), "id").collect()
    assert [(r["missing_key"], r["row_count"]) for r in got] == [(9, 500)]


def test_missing_parents_counts_before_the_join(spark):
    child = spark.range(1000).select((C("id") % 5).alias("k"))
    out = joins.missing_parents(child, "k", spark.range(3), "id")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("Aggregate [k")


def test_row_numbers_across_buckets(spark):
    rows = [("f", x) for x in (-5, 0, 3, 1000000, 7, -2)] + [("g", 4), (None, 8), (None, None)]
    got = windows.number_rows(table(spark, rows, "f string, x int"), ["f"], ["x"]).collect()
    assert {(r["f"], r["x"]): r["row_number"] for r in got} == {
        ("f", -5): 1, ("f", -2): 2, ("f", 0): 3, ("f", 3): 4, ("f", 7): 5, ("f", 1000000): 6, ("g", 4): 1, (None, None): 1, (None, 8): 2}


@pytest.mark.parametrize("kind, values", [
    ("string", ["b", "", None, "a", "ab", "é"]), ("double", [1.5, float("nan"), None, float("-inf"), -0.5, float("inf")]),
    ("decimal(20,2)", [None, *map(decimal.Decimal, ("1.10", "-3.00", "7.25", "0.00"))])])
def test_row_numbers_of_any_sortable_type(spark, kind, values):
    df = table(spark, [("f", v) for v in values], f"f string, x {kind}")
    got = [str(r["x"]) for r in windows.number_rows(df, ["f"], ["x"]).orderBy("row_number").collect()]
    assert got == [str(r["x"]) for r in df.orderBy("x").collect()]


def test_row_numbers_of_one_day_are_made_by_several_tasks(spark):
    df = spark.range(4000).select(F.lit("f").alias("f"), F.lit(dt.date(2024, 1, 1)).alias("day"), ((C("id") * 7) % 4000).alias("i"))
    got = windows.number_rows(df, ["f"], ["day", "i"])
    assert got.where("row_number <> i + 1").count() == 0
    dealt = df.withColumn("_tie", F.xxhash64(*df.columns)).repartitionByRange(8, "f", "day", "i", "_tie")
    assert dealt.select(F.spark_partition_id().alias("p")).distinct().count() > 1


def test_row_numbers_by_time_use_many_buckets(spark):
    t0 = dt.datetime(2024, 1, 1)
    df = table(spark, [("f", t0 + dt.timedelta(seconds=(i * 17) % 500), i) for i in range(500)], "f string, at timestamp_ntz, i int")
    got = [(r["at"], r["row_number"]) for r in windows.number_rows(df, ["f"], ["at", "i"]).collect()]
    assert [n for _, n in sorted(got)] == list(range(1, 501))


def test_trend_starts_stable_and_days_are_filled(spark):
    d = lambda k: dt.date(2024, 1, k)
    df = table(spark, [(d(1), 1.0), (d(2), 3.0), (d(4), 2.0)], "day date, v double")
    got = [r["t"] for r in df.withColumn("t", windows.trend_label("v", "day")).orderBy("day").collect()]
    assert got == ["Stable", "Increasing", "Decreasing"]
    assert [r["v"] for r in windows.fill_days(df, "day").orderBy("day").collect()] == [1.0, 3.0, None, 2.0]


# ---- quality ---------------------------------------------------------------
def test_gates(spark, patients):
    with pytest.raises(ValueError):
        quality.require_columns(patients, ["id", "nope"])
    with pytest.raises(ValueError):
        quality.require_rows(patients.limit(0))
    gate = quality.missing_share_gate(patients, ["glucose", "bmi"]).first()
    assert gate["missing_cells"] == 2 and gate["tier"] == "warning" and gate["gate_passed"]


def test_constraint_split_keeps_unknown_rows(patients):
    good, bad = quality.split_by_constraints(patients, {"glucose": C("glucose") <= 400, "bmi": (C("bmi") > 0) & (C("bmi") < 80)})
    assert sorted(r["id"] for r in good.collect()) == [1, 2, 3, 5, 6, 8]
    assert {r["id"]: r["reject_reasons"] for r in bad.collect()} == {4: ["bmi"], 7: ["glucose", "bmi"]}


def test_duplicates(spark):
    row = quality.duplicate_rows(table(spark, [(1, None), (1, None), (1, 2), (1, None)], "a int, b int")).first()
    assert (row["total_records"], row["duplicate_records"]) == (4, 2)
    assert quality.duplicate_rows(table(spark, [], "a int")).first()["duplicate_records"] == 0


def test_pass_rule(spark):
    df = table(spark, [("a_count", 5.0, 4.0), ("avg", 5.0, 4.0), ("avg", 5.0, None)], "n string, v double, t double")
    assert [r[0] for r in df.select(quality.pass_rule(C("n"), C("v"), C("t"))).collect()] == [False, True, True]


# ---- layers on hand-made rows ----------------------------------------------
def test_silver_and_gold_on_hand_made_rows(patients):
    s = {r["id"]: r for r in layers.silver_standard(patients).collect()}
    assert s[1]["is_valid"] and s[1]["quality_score"] == 1.0 and s[1]["completeness_score"] == 1.0
    assert not s[3]["is_valid"] and s[3]["quality_score"] == 0.8 and s[3]["anomaly_flags"]["zero_blood_pressure"]
    assert not s[5]["is_valid"] and s[5]["completeness_score"] == 0.0 and not s[5]["anomaly_flags"]["zero_glucose"]
    g = {r["id"]: r for r in layers.gold_full(layers.silver_standard(patients)).collect()}
    assert set(g) == {1, 2, 6, 8}
    assert (g[1]["bmi_category"], g[1]["glucose_category"], g[1]["insulin_category"]) == ("Obese Class I", "Diabetic", "Not Measured")
    assert (g[6]["health_risk_level"], g[6]["intervention_priority"], g[6]["followup_frequency"]) == ("Critical", "Immediate", "Weekly")
    want = 152.5 / 200 * .25 + 33.1 / 50 * .2 + 47 / 100 * .15 + 81 / 200 * .15 + .55 / 2 * .15 + 4 / 15 * .1
    assert g[1]["risk_score"] == pytest.approx(round(want, 4))


def test_penalties_name_the_rules(patients):
    score, hits = layers.quality_penalties()
    got = {r["id"]: r for r in patients.select("id", score.alias("q"), hits.alias("h")).collect()}
    assert got[4]["h"] == ["zero_bmi"] and got[4]["q"] == 0.85
    assert got[5]["h"] == ["missing_values_9"] and got[5]["q"] == pytest.approx(0.1)
    assert got[8]["h"] == ["age_outlier", "pregnancy_age_inconsistent"] and got[8]["q"] == 0.5


def test_bronze_to_silver_fills_everything_measured(patients):
    raw = patients.withColumnsRenamed({v: k for k, v in R.COLUMN_NAMES.items()})
    out = jobs.bronze_to_silver(raw)
    assert out.where(C("glucose").isNull() | C("bmi").isNull()).count() == 0
    assert {r["data_quality_flag"] for r in out.collect()} == {"COMPLETE"}
