import math
import random
from fractions import Fraction

import numpy as np
import pytest

from vitalmart.llm import whitening


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id bigint, embedding array<double>, n int, w string")


def usable(rows):
    return [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]


def exact(rows):
    """Distinct x vectors, their sums, and the covariance by cross products of fractions."""
    xs = sorted({tuple(math.floor(64 * c) + 1_000_000 for c in v) for _, v in rows})
    n, dims = len(xs), len(xs[0])
    sums = [sum(x[k] for x in xs) for k in range(dims)]
    cov = [[sum((x[a] - Fraction(sums[a], n)) * (x[b] - Fraction(sums[b], n)) for x in xs) / n for b in range(dims)] for a in range(dims)]
    return xs, n, sums, np.array([[float(c) for c in row] for row in cov])


@pytest.mark.parametrize("scale", [1.0, 3e7, 1e12], ids=["8 bit", "32 bit", "64 bit"])
def test_covariance_is_exact(spark, scale):
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0.3, 1) * scale * (k + 1) for k in range(5)]) for i in range(150)]
    _, n, sums, want = exact(rows)
    fit = whitening.distinct_vectors(table(spark, rows).selectExpr("embedding as vector"), 5)
    size, moved = whitening.moments(fit, 5)
    assert size == n and [m + n * 1_000_000 for m in moved] == sums
    assert (whitening.covariance(fit, 5, n, moved) == want).all()  # to the last bit


def test_squares_in_parts():
    rng = np.random.default_rng(3)
    for bits in (8, 30, 33, 44, 49, 55, 61):
        t = rng.integers(-2 ** bits, 2 ** bits, (200, 7))
        want = [sum(int(v) ** 2 for v in t[:, k]) for k in range(7)]
        assert whitening._squares(t) == want == whitening._squares(t.astype(object))
        assert whitening._squares_of_rows(t) == [sum(int(v) ** 2 for v in row) for row in t]


def test_against_a_plain_version(spark):
    rng = random.Random(7)
    base = [[rng.gauss(0, 0.2 + 0.1 * k) for k in range(20)] for _ in range(300)]
    rows = [(i, [v[0] + 0.5 * v[1], *v[1:]]) for i, v in enumerate(base)]
    rows += [(5, rows[5][1]), (None, rows[6][1]), *[(1000 + i, rows[7][1]) for i in range(400)]]  # copies weigh once
    rows += [(2000, None), (2001, []), (2002, [None] * 20), (2003, [math.nan] * 20), (2004, [math.inf] + [0.0] * 19),
             (2005, [0.0] * 19 + [-math.inf]), (2006, [1.0] * 19), (2007, [1e300] * 20), (2008, [0.1] * 19 + [None])]
    good = [(i, v) for i, v in usable(rows) if len(v) == 20 and max(map(abs, v)) < 1e17]
    xs, n, sums, cov = exact(good)
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    got = whitening.whiten(table(spark, rows).repartition(7)).collect()
    assert len(got) == 16 * len(good)
    assert sorted({str(r.vec_id) for r in got}) == sorted({str(i) for i, _ in good})
    assert {r.n for r in got} == {n} and len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9
    wanted = {}
    for i, v in good:
        x = [math.floor(64 * c) + 1_000_000 for c in v]
        deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums))
        w = np.array([float(a - Fraction(s, n)) for a, s in zip(x, sums)]) @ vectors / np.sqrt(values)
        wanted[i] = (deviation, w)
    signs = [0] * 16
    for r in got:
        deviation, w = wanted[r.vec_id]
        k = r.component - 1
        assert int(r.deviation) == deviation and math.isclose(r.explained, values[k] / np.trace(cov), rel_tol=1e-12)
        signs[k] = signs[k] or round(r.whitened / w[k])
        assert math.isclose(r.whitened, signs[k] * w[k], rel_tol=1e-6, abs_tol=1e-9)
    assert set(map(abs, signs)) == {1}


def test_fewer_directions_than_components(spark):
    rows = [(i, [float(i), 2.0 * i, 5.0]) for i in range(9)]  # one direction varies
    got = whitening.whiten(table(spark, rows)).collect()
    assert len(got) == 27 and {r.component for r in got if r.whitened is None} == {2, 3}
    assert got[0].identity_error < 1e-12 and math.isclose(max(r.explained for r in got), 1.0)
    same = whitening.whiten(table(spark, rows[:1] * 4)).collect()  # nothing varies
    assert len(same) == 12 and all(r.whitened is None and r.explained is None and r.identity_error is None and r.deviation == 0 for r in same)


def test_no_usable_rows(spark):
    for rows in ([], [(1, None), (2, []), (3, [math.nan, 1.0])]):
        assert whitening.whiten(table(spark, rows)).count() == 0
