"""Measures that can be summed later: what a load keeps of its rows, and reports made of it.

A measure names what it keeps of a group (counts, sums, sums of squares, extremes), how kept
parts merge, and the figure they give in the end. One dictionary of measures so serves both a report
over all rows and a daily table that grows by loads and never reads old rows again.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalmart.functions.numeric import col, pct, ratio, rnd


@dataclass(frozen=True)
class Measure:
    """``keep``: aggregates over rows by suffix; ``merge``: the aggregate that merges each; ``figure``: from the merged columns."""

    keep: dict[str, Column]
    merge: dict[str, Callable[[Column], Column]]
    figure: Callable[[dict[str, Column]], Column]


def _present(x: Column | str) -> Column:
    return col(x).cast("double")


def count(cond: Column | None = None) -> Measure:
    kept = F.count(F.lit(1)) if cond is None else F.count_if(cond)
    return Measure({"n": kept}, {"n": F.sum}, lambda p: p["n"])


def rate(cond: Column, digits: int) -> Measure:
    """Share of the rows that meet cond, in percent."""
    return Measure({"hits": F.count_if(cond), "n": F.count(F.lit(1))}, {"hits": F.sum, "n": F.sum}, lambda p: pct(p["hits"], p["n"], digits))


def total(x: Column | str, digits: int | None = None) -> Measure:
    return Measure({"sum": F.sum(_present(x))}, {"sum": F.sum}, lambda p: p["sum"] if digits is None else rnd(p["sum"], digits))


def mean(x: Column | str, digits: int) -> Measure:
    return Measure({"sum": F.sum(_present(x)), "n": F.count(col(x))}, {"sum": F.sum, "n": F.sum}, lambda p: rnd(ratio(p["sum"], p["n"]), digits))


def deviation(x: Column | str, digits: int, near: float = 0.0) -> Measure:
    """Sample standard deviation. ``near`` is any value near the mean: squares are summed as distances from it,
    so that little is lost where the mean is large against the deviation."""
    d = _present(x) - F.lit(float(near))

    def figure(p: dict[str, Column]) -> Column:
        spread = p["squares"] - ratio(p["sum"] * p["sum"], p["n"])
        return rnd(F.sqrt(F.greatest(ratio(spread, F.when(p["n"] > 1, p["n"] - 1)), F.lit(0.0))), digits)

    return Measure({"sum": F.sum(d), "squares": F.sum(d * d), "n": F.count(col(x))}, {"sum": F.sum, "squares": F.sum, "n": F.sum},
                   lambda p: F.when(p["n"] > 1, figure(p)))


def least(x: Column | str) -> Measure:
    return Measure({"least": F.min(col(x))}, {"least": F.min}, lambda p: p["least"])


def most(x: Column | str) -> Measure:
    return Measure({"most": F.max(col(x))}, {"most": F.max}, lambda p: p["most"])


def kept_parts(df: DataFrame, keys: dict[str, Column | str], measures: dict[str, Measure]) -> DataFrame:
    """One row per group of rows with what every measure keeps, in columns ``<measure>__<part>``."""
    return df.groupBy(*[col(c).alias(k) for k, c in keys.items()]).agg(
        *[c.alias(f"{name}__{part}") for name, m in measures.items() for part, c in m.keep.items()])


def merged_parts(parts: DataFrame, keys: list[str], measures: dict[str, Measure]) -> DataFrame:
    """Parts of the same group merged into one row. Merging again, or in another order, gives the same."""
    return parts.groupBy(*keys).agg(
        *[merge(F.col(f"{name}__{part}")).alias(f"{name}__{part}") for name, m in measures.items() for part, merge in m.merge.items()])


def figures(parts: DataFrame, keys: list[str], measures: dict[str, Measure]) -> DataFrame:
    """The report columns of merged parts."""
    return parts.select(*keys, *[m.figure({part: F.col(f"{name}__{part}") for part in m.keep}).alias(name) for name, m in measures.items()])


def full_report(df: DataFrame, keys: dict[str, Column | str], measures: dict[str, Measure]) -> DataFrame:
    """The report computed from all rows at once."""
    return figures(kept_parts(df, keys, measures), list(keys), measures)
