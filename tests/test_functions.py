import math
from datetime import datetime
from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vitalmart.functions.bands import Ladder, band, order_rank, recode, recode_text
from vitalmart.functions.numeric import clamp, clamp_ignoring_null, plain_text, ratio, rnd, rnd_pos, sort_bucket
from vitalmart.functions.scores import (additive_quality, all_hold, completeness, flag_struct, joined_tags, logistic_score,
                                        penalty_quality, tag_text, tags)
from vitalmart.plans.jobs import processing_report
from vitalmart.rules import clinical as R

C = F.col


def values(spark, xs, expr, kind="double"):
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], f"i int, x {kind}")
    return [r[0] for r in rows.orderBy("i").select(expr).collect()]


@pytest.mark.parametrize("digits", [0, 1, 2, 4])
def test_rounding_is_decimal_half_up(spark, digits):
    xs = [0.17325, 0.125, 2.5, -2.5, 1.005, -1.005, 0.0, 123.45, 99999.99995, -0.00005, 1e-9]
    want = [float(Decimal(repr(x)).quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP)) for x in xs]
    assert values(spark, xs, rnd("x", digits)) == want
    assert values(spark, [abs(x) for x in xs], rnd_pos("x", digits)) == [abs(w) for w in want]


@pytest.mark.parametrize("digits", range(7))
def test_rounding_leaves_values_without_decimals(spark, digits):
    inf = math.inf
    xs = [1e13, 5e16, -1e13, -5e16, 1e300, inf, -inf, 2.0 ** 53, 4503599627370495.5]
    got = values(spark, xs, rnd("x", digits))
    assert got[:-1] == xs[:-1]
    assert got[-1] == (xs[-1] if digits else 4503599627370496.0)
    assert values(spark, [x for x in xs if x > 0], rnd_pos("x", digits)) == [g for g, x in zip(got, xs) if x > 0]
    assert all(math.isnan(v) for f in (rnd, rnd_pos) for v in values(spark, [math.nan], f("x", digits)))


def test_rounding_keeps_null(spark):
    assert values(spark, [None], rnd("x", 2)) == [None]


def test_guarded_division_and_clamp(spark):
    assert values(spark, [0.0, 4.0, None], ratio(F.lit(8), "x")) == [None, 2.0, None]
    assert values(spark, [-1.0, 0.5, 7.0, None], clamp("x")) == [0.0, 0.5, 1.0, None]
    assert values(spark, [None], clamp_ignoring_null("x")) == [1.0]


@given(st.lists(st.floats(allow_nan=False, allow_infinity=False, width=64).filter(lambda v: v == 0 or 1e-300 < abs(v) < 1e300),
                min_size=2, max_size=60))
@settings(max_examples=15, deadline=None)
def test_sort_bucket_keeps_order(spark, xs):
    xs = sorted([*xs, 1.0, math.nextafter(1.0, 0), 2.0, math.nextafter(2.0, 0), 1024.0, math.nextafter(1024.0, 0)])
    got = values(spark, xs, sort_bucket("x"))
    assert got == sorted(got)


def test_band_edges(spark):
    ladder = Ladder((10, 20), ("low", "mid", "high"))
    assert values(spark, [9.99, 10.0, 19.99, 20.0, None], band("x", ladder)) == ["low", "mid", "mid", "high", "Unknown"]
    right = Ladder((10, 20), ("low", "mid", "high"), closed="right", floor=0.0, null="nan")
    assert values(spark, [-1.0, 0.0, 10.0, 20.0, 20.1, None], band("x", right)) == ["nan", "nan", "low", "mid", "high", "nan"]
    through = Ladder((10,), ("low", "high"), null=None)
    assert values(spark, [None], band("x", through)) == ["high"]


def test_ladder_is_validated():
    with pytest.raises(ValueError):
        Ladder((1, 2), ("a", "b"))
    with pytest.raises(ValueError):
        Ladder((2, 1), ("a", "b", "c"))


def test_recodes(spark):
    assert values(spark, ["a", "z", None], recode("x", {"a": 1}, 0), "string") == [1, 0, 0]
    assert values(spark, [" MALE", "None ", "x"], recode_text("x", {"male": "Male", "none": None}, C("x")), "string") == ["Male", None, "x"]
    assert values(spark, ["b", "a", "q"], order_rank("x", ["a", "b"]), "string") == [2, 1, 3]


def test_tags_have_no_holes(spark):
    rules = [(C("x") > 1, "one"), (C("x") > 2, "two"), (C("x") > 3, "three")]
    assert values(spark, [0.0, 2.5, None], tags(rules)) == [[], ["one", "two"], []]
    assert values(spark, [0.0, 2.5], tag_text(rules)) == ["", "one,two"]
    assert values(spark, [0.0, 9.0], joined_tags(rules, "none")) == ["none", "one; two; three"]


def test_unknown_flags_read_false(spark):
    got = values(spark, [None, 5.0], flag_struct({"big": C("x") > 1}))
    assert [r["big"] for r in got] == [False, True]
    assert values(spark, [None, 5.0], all_hold([C("x") > 1])) == [False, True]


def test_quality_scores(spark):
    assert values(spark, [None, 0.0, 5.0], additive_quality([(C("x") > 0, 0.2), (C("x") > 1, 0.3)], digits=2)) == [0.0, 0.0, 0.5]
    assert values(spark, [None, 0.0], penalty_quality([(C("x") == 0, 0.15)], missing=[C("x").isNull()])) == [0.9, 0.85]
    assert values(spark, [0.0], penalty_quality([(C("x") == 0, 0.7), (C("x") < 1, 0.7)])) == [0.0]
    assert values(spark, [None, 1.0], completeness([C("x").isNotNull(), C("x") > 5])) == [0.0, 0.5]


def test_logistic_score_uses_defaults(spark):
    z = -1.0 + 0.5 * 4
    want = round(100 / (1 + math.exp(-z)), 2)
    assert values(spark, [None, 4.0], logistic_score(-1.0, [("x", 0.5, 4)])) == [want, want]


def test_published_ladders_are_complete():
    ladders = [v for v in vars(R).values() if isinstance(v, Ladder)]
    assert len(ladders) >= 25


def test_large_numbers_have_plain_text(spark):
    xs = [36000000.0, 9999999.0, 12345678.9, -2.5e8, 4e15, 0.25, 0.0, None, float("inf"), 1e30]
    assert values(spark, xs, plain_text("x")) == ["36000000.0", "9999999.0", "12345678.9", "-250000000.0", "4000000000000000.0", "0.25", "0.0", None, "Infinity", "1.0E30"]


def test_report_lines_of_large_tables(spark):
    counts = spark.createDataFrame([("gold", 36000000)], "layer string, record_count bigint")
    checks = spark.createDataFrame([("records", 36000000.0, True, "fail")], "check_name string, value double, passed boolean, severity string")
    lines = [r["line"] for r in processing_report(counts, checks, datetime(2024, 1, 15, 12)).collect()]
    assert lines[1:] == ["gold: 36000000 records", "records: 36000000.0 (ok)"]
