"""Operators whose plan follows the size of the data: selection by levels, interval joins, sketches, daily tables."""

import datetime as dt
import math
import os
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitalmart.functions.numeric import sort_key
from vitalmart.operators import joins, partials, sketches
from vitalmart.operators.quantiles import exact_percentiles, wanted_buckets
from vitalmart.plans import daily

C = F.col


def busy_tasks(df, by):
    """Partitions of the last shuffle that hold rows of df."""
    return df.groupBy(F.spark_partition_id().alias("p")).agg(F.count(by).alias("n")).where("n > 0").count()


# ---- percentiles -----------------------------------------------------------
def test_sort_key_is_the_order_of_doubles(spark):
    rng = random.Random(2)
    xs = [0.0, -0.0, 1.0, -1.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308, math.inf, -math.inf,
          math.nan, 0.1, 2 - 2 ** -52, 2.0, 1024 - 2 ** -43, 1024.0]
    xs += [math.ldexp(1.0, e) * f for e in range(-1070, 1024, 37) for f in (1.0, 1 - 2 ** -53, 1 + 2 ** -52)]
    xs += [rng.choice([-1, 1]) * rng.random() * 10.0 ** rng.randrange(-320, 308) for _ in range(2000)]
    rows = spark.createDataFrame([(x,) for x in xs], "x double").select("x", sort_key("x").alias("k")).collect()
    bits = np.array([r.x for r in rows]).view(np.int64)
    for r, b in zip(rows, bits.tolist()):
        if not math.isnan(r.x):
            assert r.k == (b if b >= 0 else ~(b & (2 ** 63 - 1))), r.x
    assert max(rows, key=lambda r: r.k).x != max(rows, key=lambda r: r.k).x  # NaN


@pytest.mark.parametrize("keys", [[], ["g"]], ids=["no key", "key"])
def test_a_crowded_bucket_is_narrowed_until_a_task_can_rank_it(spark, keys):
    """A million different values of one octave part: the first level sees one bucket."""
    n, most = 1_000_000, 500
    df = spark.range(n, numPartitions=8).select(F.lit("a").alias("g"), (1.0 + C("id") * 2.0 ** -36).alias("x"))
    probs = {"q1": 0.25, "m": 0.5, "q3": 0.75, "top": 1.0}
    rows = df.select("g", C("x").alias("_v"), sort_key("x").alias("_k"))
    assert rows.select(F.shiftright("_k", 40)).distinct().count() <= 70
    buckets = wanted_buckets(rows, keys, probs, most)
    assert buckets[0][0] < 40 and all(r["_n"] <= most or shift == 0 for shift, wanted, _ in buckets for r in wanted.collect())
    got = exact_percentiles(df, keys, "x", probs, most=most).first()
    xs = 1.0 + np.arange(n) * 2.0 ** -36
    assert [got[q] for q in probs] == [np.quantile(xs, p) for p in probs.values()]


def test_levels_of_many_keys_and_copies(spark):
    rng = random.Random(9)
    rows = [(rng.choice(["a", "b", None]), rng.choice([rng.gauss(0, 1), 7.0, -0.0, 1e-9 * rng.randrange(9), None])) for _ in range(6000)]
    rows += [("hot", 3.25)] * 9000 + [("hot", 3.25 + 2.0 ** -40)] * 3
    df = spark.createDataFrame(rows, "g string, x double")
    probs = {"low": 0.05, "m": 0.5, "high": 0.99}
    for most in (1, 40):
        for r in exact_percentiles(df, ["g"], "x", probs, most=most).collect():
            xs = sorted(x for g, x in rows if g == r["g"] and x is not None)
            assert [r[q] for q in probs] == pytest.approx([np.quantile(xs, p) for p in probs.values()], rel=1e-12, abs=1e-300)


def test_buckets_of_one_value_end_the_levels(spark):
    """Whole numbers held by more rows than a task shall rank: the first level has the answer, no row is read again."""
    values = [*range(5), -0.0, 7.5, math.inf, math.nan]
    df = spark.range(9000, numPartitions=4).select(F.element_at(F.array(*[F.lit(float(v)) for v in values]), (C("id") % 9 + 1).cast("int")).alias("x"))
    probs = {"low": 0.01, "q1": 0.25, "m": 0.5, "high": 0.8, "top": 1.0}
    rows = df.select(C("x").alias("_v"), sort_key("x").alias("_k"))
    assert [(shift, few) for shift, _, few in wanted_buckets(rows, [], probs, 100)] == [(40, None)]
    got = exact_percentiles(df, [], "x", probs, most=100).first()
    assert [str(got[q]) for q in probs] == ["-0.0", "1.0", "3.0", "inf", "nan"]


# ---- interval join ---------------------------------------------------------
def plain_bands(xs, bands):
    return sorted((str(x), b) for x in xs for lo, hi, b in bands if x is not None and lo is not None and hi is not None and lo <= x < hi)


@pytest.mark.parametrize("small", [0, 10_000], ids=["shuffled", "broadcast"])
@pytest.mark.parametrize("bins", [None, 1, 3])
def test_overlapping_bands(spark, small, bins):
    rng = random.Random(1)
    inf = math.inf
    bands = [(a := rng.uniform(-50, 50), a + rng.choice([0.0, 1.0, 5.0, 60.0]), i) for i in range(60)]
    bands += [(-inf, -40.0, 100), (40.0, inf, 101), (-inf, inf, 102), (None, 3.0, 103), (2.0, None, 104), (5.0, 1.0, 105), (7.0, 7.0, 106)]
    xs = [rng.uniform(-60, 60) for _ in range(200)] + [bands[0][0], bands[0][1], math.nan, None, inf, -inf] + [12.5] * 300
    df = spark.createDataFrame([(x, i) for i, x in enumerate(xs)], "x double, i int")
    table = spark.createDataFrame(bands, "lo double, hi double, b int")
    got = joins.band_join(df, table, "x", "lo", "hi", "inner", bins, small).collect()
    assert sorted((str(r["x"]), r["b"]) for r in got) == plain_bands([x for x in xs if x is None or x == x], bands)
    left = joins.band_join(df, table, "x", "lo", "hi", "left", bins, small)
    assert left.select("i").distinct().count() == len(xs) and left.where("b is null").count() == 3
    assert joins.band_join(df, table, "x", "lo", "hi", "left_anti", bins, small).count() == 3
    assert joins.band_join(df, table.limit(0), "x", "lo", "hi", "left", bins, small).where("b is null").count() == len(xs)


def test_few_bands_leave_the_rows_where_they_are(spark):
    bands = spark.createDataFrame([(0.0, 5.0, "a"), (5.0, 9.0, "b")], "lo double, hi double, name string")
    plan = joins.band_join(spark.range(100).select(C("id").cast("double").alias("x")), bands, "x", "lo", "hi")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_many_bands_keep_many_tasks_busy(spark):
    """200,000 bands and 2,000,000 rows, a third of them one value."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        bands = spark.range(200_000).select((C("id") * 3.0).alias("lo"), (C("id") * 3.0 + 3.0).alias("hi"), C("id").alias("band"))
        rows = spark.range(2_000_000).select("id", F.when(C("id") % 3 == 0, 777.5).otherwise((C("id") * 7919 % 600_000).cast("double")).alias("x"))
        out = joins.band_join(rows, bands, "x", "lo", "hi", "inner")
        sizes = [r["n"] for r in out.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
        assert sum(sizes) == 2_000_000 and len(sizes) > 129
        assert max(sizes) < 100_000  # the one value alone has 666,667 rows
        assert out.where(C("band") != F.floor(C("x") / 3)).count() == 0
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


# ---- sketches --------------------------------------------------------------
def test_sketches_of_days_merge_within_their_error(spark, tmp_path):
    n = 60_000
    rows = spark.range(n).select(F.date_add(F.lit(dt.date(2024, 3, 1)), (C("id") % 10).cast("int")).alias("day"), F.when(C("id") % 5 == 0, "b").otherwise("a").alias("g"),
                                 (C("id") * 7919 % 20_011).alias("user"), F.when(C("id") % 7 > 0, (C("id") * 31 % 1009).cast("double")).alias("v"))
    path = f"{tmp_path}/days"
    for part in (rows.where("day < '2024-03-06'"), rows.where("day >= '2024-03-05'")):  # one day comes twice
        sketches.add_days(sketches.day_sketches(part, "day", ["g"], {"users": "user"}, {"v": "v"}), path, "day")
    first, last = dt.date(2024, 3, 3), dt.date(2024, 3, 8)
    kept = sketches.kept_days(spark, path, "day", first, last)
    got = {r["g"]: r for r in sketches.merged(kept, ["g"], ["users"], ["v"]).select(
        "g", "n_rows", sketches.distinct_count("users").alias("users"), sketches.percentile("v", 0.5).alias("m"), sketches.deviation("v").alias("sd"),
        "v_n", "v_min", "v_max", sketches.share_below("v", 500.0).alias("share")).collect()}
    local = [r for r in rows.collect() if first <= r["day"] <= last]
    for g, r in got.items():
        mine = [x for x in local if x["g"] == g]
        vs = sorted(x["v"] for x in mine if x["v"] is not None)
        users = len({x["user"] for x in mine})
        assert r["n_rows"] == len(mine) and (r["v_n"], r["v_min"], r["v_max"]) == (len(vs), vs[0], vs[-1])
        assert abs(r["users"] - users) <= sketches.distinct_error() * users
        assert abs(np.searchsorted(vs, r["m"]) / len(vs) - 0.5) <= sketches.rank_error()
        assert abs(sum(v <= 500 for v in vs) / len(vs) - r["share"]) <= sketches.rank_error()
        assert r["sd"] == pytest.approx(statistics.stdev(vs), rel=1e-9)
    assert kept.count() == 6  # every sixth id is of another day, and each day here has one group
    empty = sketches.merged(sketches.day_sketches(rows.withColumn("v", F.lit(None).cast("double")), "day", [], {}, {"v": "v"}), [], ranked=["v"])
    assert empty.select(sketches.percentile("v", 0.5).alias("m")).first()["m"] is None


def test_a_wrong_estimate_is_told(spark):
    one = spark.range(100_000).agg(F.hll_sketch_agg(C("id"), F.lit(sketches.LG_K)).alias("u_hll"))
    said = [one.select(sketches.distinct_within(F.lit(n), "u").alias("ok")).first()["ok"] for n in (100_000, 110_000, 90_000)]
    assert said == [True, False, False]


# ---- daily tables ----------------------------------------------------------
def spec(unit="month"):
    return daily.DailyReport(("d", "day"), {"n": partials.count(), "big": partials.count(C("v") > 5), "share": partials.rate(C("v") > 5, 3),
                                            "avg": partials.mean("v", 6), "sd": partials.deviation("v", 6, near=5.0), "least": partials.least("v"),
                                            "most": partials.most("v"), "total": partials.total("v", 6)}, {"g": "g"}, unit)


def day_rows(spark, n=3000):
    rng = random.Random(6)
    rows = [(dt.date(2024, 1, 1) + dt.timedelta(rng.randrange(100)), rng.choice(["x", "y", None]), rng.choice([None, rng.uniform(0, 10)])) for _ in range(n)]
    rows += [(None, "x", 3.0), (None, None, None)]
    return spark.createDataFrame(rows, "day date, g string, v double").cache()


def as_set(df):
    return sorted((tuple(round(v, 5) if isinstance(v, float) else v for v in r) for r in df.collect()), key=str)


@pytest.mark.parametrize("unit", ["month", "year"])
def test_loads_equal_one_computation(spark, tmp_path, unit):
    rows, report = day_rows(spark), spec(unit)
    first, second = rows.where("pmod(xxhash64(v), 3) > 0 or day is null"), rows.where("pmod(xxhash64(v), 3) = 0 and day is not null")
    daily.load(first.where("day < '2024-03-01'"), report, str(tmp_path), "a")
    daily.load(first.where("day >= '2024-03-01' or day is null"), report, str(tmp_path), "b")
    assert as_set(daily.read_report(spark, report, str(tmp_path))) == as_set(report.full(first))
    for _ in range(2):  # a load given again counts nothing twice
        daily.load(second, report, str(tmp_path), "c")
        assert as_set(daily.read_report(spark, report, str(tmp_path))) == as_set(report.full(rows))
    parts = daily.read_parts(spark, str(tmp_path))
    by_group = daily.combined(parts, ["g"], report.measures)
    assert as_set(by_group) == as_set(partials.full_report(rows, {"g": "g"}, report.measures))


def test_a_load_leaves_other_periods_alone(spark, tmp_path):
    rows, report, path = day_rows(spark), spec("month"), str(tmp_path)
    daily.load(rows.where("day < '2024-04-01'"), report, path, "a")
    stamp = lambda: {f: os.stat(os.path.join(at, f)).st_mtime_ns for at, _, fs in os.walk(f"{path}/report") if "2024-03" not in at for f in fs
                     if f.endswith(".parquet")}
    before = stamp()
    for at, _, files in os.walk(path):  # neither parts nor report of January and February can be read any more
        if "2024-01" in at or "2024-02" in at:
            for f in files:
                with open(os.path.join(at, f), "wb"):
                    pass
    daily.load(rows.where("day between '2024-03-10' and '2024-03-12'").limit(5), report, path, "b")
    assert set(stamp()) == set(before)
    march = spark.read.parquet(f"{path}/report/period=2024-03-01")
    assert march.agg(F.sum("n")).first()[0] == rows.where("day between '2024-03-01' and '2024-03-31'").count() + 5


def test_measures_of_groups_without_values(spark):
    df = spark.createDataFrame([("a", None), ("b", 2.0)], "g string, v double")
    m = {"avg": partials.mean("v", 2), "sd": partials.deviation("v", 2), "share": partials.rate(C("v") > 1, 1), "n": partials.count()}
    got = {r["g"]: tuple(r)[1:] for r in partials.full_report(df, {"g": "g"}, m).collect()}
    assert got == {"a": (None, None, 0.0, 1), "b": (2.0, None, 100.0, 1)}


# ---- gathered levels -------------------------------------------------------
def test_levels_are_counted_before_they_are_gathered(spark):
    from vitalmart.operators import aggregate as A
    from vitalmart.sources.writers import report_document
    df = spark.range(300).select((C("id") % 2).alias("g"), F.when(C("id") > 5, (C("id") % 100).cast("string")).alias("v"))
    assert {r["g"]: r["t"].count("-") for r in A.joined_values(df, ["g"], "v", "-", "t").collect()} == {0: 49, 1: 49}
    for gather in (A.joined_values, lambda d, k, x, s, out, most: A.value_distribution(d, k, x, out, most)):
        with pytest.raises(ValueError, match="value_counts"):
            gather(df, ["g"], "v", "-", "t", 49)
    with pytest.raises(ValueError, match="write_json"):
        report_document({"all": df}, F.lit("now"), 299)
    assert report_document({"all": df}, F.lit("now"), 300).count() == 1
