"""Rounding, guarded division and order-preserving bucketing of numbers."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

# Half of 1e-12: decimal ties that binary doubles store just below the tie
# (0.17325 -> 0.1732499...) still round up, as SQL numeric rounding does.
_TIE_SLACK = 5e-13


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# From here on a scaled double has no fraction left to round.
_WHOLE = float(2 ** 53)


def rnd(x: Column | str, digits: int) -> Column:
    """Round half away from zero to ``digits`` decimals, as double.

    Plain double arithmetic instead of ``round``: Spark's ``round`` on doubles
    builds a BigDecimal from the printed number for every row. Values too large to
    have such decimals, infinities and NaN stay as they are.
    """
    x = col(x).cast("double")
    scale = float(10 ** digits)
    size = F.abs(x) * F.lit(scale)
    return F.when(size < F.lit(_WHOLE), F.signum(x) * F.floor(size + F.lit(0.5 + _TIE_SLACK * scale)) / F.lit(scale)).otherwise(x)


def rnd_pos(x: Column | str, digits: int) -> Column:
    """rnd for x >= 0, in fewer operations: wide projections must stay below the size HotSpot
    still compiles (8000 bytes of bytecode per method)."""
    x = col(x).cast("double")
    scale = float(10 ** digits)
    return F.when(x < F.lit(_WHOLE / scale), F.floor(x * F.lit(scale) + F.lit(0.5 + _TIE_SLACK * scale)) / F.lit(scale)).otherwise(x)


def ratio(a: Column | str, b: Column | str) -> Column:
    """a / b as double, NULL when b is zero."""
    return F.try_divide(col(a).cast("double"), col(b).cast("double"))


def pct(a: Column | str, b: Column | str, digits: int) -> Column:
    return rnd(ratio(col(a) * F.lit(100.0), b), digits)


def plain_text(x: Column | str) -> Column:
    """A double as text, digit by digit from 10 million up too, where a plain cast writes 1.0E7."""
    x = col(x).cast("double")
    digits = F.regexp_replace(x.try_cast("decimal(38,16)").cast("string"), r"(\.\d+?)0*$", "$1")
    return F.when((F.abs(x) >= 1e7) & (F.abs(x) < 1e21), digits).otherwise(x.cast("string"))


def clamp(x: Column | str, lo: float = 0.0, hi: float = 1.0) -> Column:
    """Bound x to [lo, hi]; NULL stays NULL."""
    x = col(x)
    return F.when(x.isNotNull(), F.greatest(F.lit(float(lo)), F.least(F.lit(float(hi)), x.cast("double"))))


def clamp_ignoring_null(x: Column | str, lo: float = 0.0, hi: float = 1.0) -> Column:
    """Bound x the way SQL GREATEST/LEAST do: a NULL x is skipped, leaving hi."""
    return F.greatest(F.lit(float(lo)), F.least(F.lit(float(hi)), col(x).cast("double")))


def flag(cond: Column) -> Column:
    """Condition as 0/1 bigint; an unknown condition counts as 0."""
    return F.when(cond, F.lit(1).cast("bigint")).otherwise(F.lit(0).cast("bigint"))


def fold_sum(columns: list[Column]) -> Column:
    return reduce(add, columns)


def sort_bucket(x: Column | str, per_octave: int = 4096) -> Column:
    """Map a number to a bigint bucket that never breaks the order of x.

    Buckets follow the double's own exponent and leading mantissa bits, so they
    need no statistics, are the same on every retry, and split any value range
    into at least ``per_octave`` parts per doubling. log2 may be off by one step
    next to a power of two; the piecewise-linear form gives the same bucket then.
    Both infinities have buckets of their own, and NaN has the highest, as in sorting.
    """
    x = col(x).cast("double")
    size = F.abs(x)
    exponent = F.floor(F.log2(size))
    mantissa = size / F.pow(F.lit(2.0), exponent.cast("double"))
    bucket = ((exponent + F.lit(1100)) * F.lit(per_octave)
              + F.floor((mantissa - F.lit(1.0)) * F.lit(float(per_octave)))).cast("bigint")
    edge = lambda v: F.lit(v).cast("bigint")
    infinite = float("inf")
    return (F.when(F.isnan(x), edge(2 ** 62)).when(x == infinite, edge(2 ** 61)).when(x == -infinite, edge(-2 ** 61))
            .when(x > 0, bucket).when(x < 0, -bucket).when(x == 0, edge(0)))


def sort_key(x: Column | str) -> Column:
    """A double as the bigint that sorts like it: exponent and mantissa of its size, and below zero the complement.

    Different values have different keys (-0.0 has -1, 0.0 has 0), NaN has the largest. Any leading
    bits of the key are a bucket that keeps the order.
    """
    x = col(x).cast("double")
    size = F.abs(x)
    guess = F.greatest(F.floor(F.log2(size)), F.lit(-1022)).cast("double")
    # log2 may be off by one step next to a power of two
    exponent = F.when(size >= F.pow(F.lit(2.0), guess + 1), guess + 1).when(
        (size < F.pow(F.lit(2.0), guess)) & (guess > -1022), guess - 1).otherwise(guess)
    mantissa = size / F.pow(F.lit(2.0), exponent)  # below 1 for the smallest numbers only
    scale = F.lit(float(2 ** 52))
    bits = ((exponent + 1022).cast("bigint") * F.lit(2 ** 52) + (mantissa * scale).cast("bigint"))
    whole = (F.when(size == float("inf"), F.lit(2047 * 2 ** 52)).when(size == 0, F.lit(0).cast("bigint")).otherwise(bits))
    below = (x < 0) | ((x == 0) & (F.pow(x, F.lit(-1.0)) < 0))  # of the zeros, -0.0 has a negative inverse
    return F.when(x.isNull(), F.lit(None)).when(F.isnan(x), F.lit(2 ** 63 - 1)).when(below, F.bitwise_not(whole)).otherwise(whole)
