"""Scores, flags, tags and recommendation texts as Column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import clamp, col, fold_sum, rnd, rnd_pos


def weighted_score(terms: list[tuple[Column | str, float]], *, digits: int | None = None,
                   bounds: tuple[float, float] | None = None) -> Column:
    """Sum of weight * term, optionally bounded; ``digits`` rounds a non-negative sum."""
    score = fold_sum([col(t).cast("double") * F.lit(float(w)) for t, w in terms])
    if bounds:
        score = clamp(score, *bounds)
    return score if digits is None else rnd_pos(score, digits)


def logistic_score(bias: float, terms: list[tuple[str, float, float]], digits: int = 2) -> Column:
    """100 / (1 + exp(-z)); each term is (column, weight, value used for NULL)."""
    z = F.lit(float(bias)) + fold_sum(
        [F.coalesce(col(c).cast("double"), F.lit(float(d))) * F.lit(float(w)) for c, w, d in terms])
    return rnd_pos(F.lit(100.0) / (F.lit(1.0) + F.exp(-z)), digits)


def points(rules: list[tuple[Column, float, float]], base: float = 0.0,
           bounds: tuple[float, float] | None = None) -> Column:
    """base + points of every rule; (condition, points if true, points otherwise)."""
    total = F.lit(float(base)) + fold_sum(
        [F.when(c, F.lit(float(p))).otherwise(F.lit(float(q))) for c, p, q in rules])
    return clamp(total, *bounds) if bounds else total


def deviation_score(terms: list[tuple[Column | str, float, float]], digits: int = 4) -> Column:
    """Sum of weight * |x - centre| / centre."""
    return rnd_pos(fold_sum([F.abs(col(c) - F.lit(float(m))) / F.lit(float(m)) * F.lit(float(w))
                         for c, m, w in terms]), digits)


def fixed_zscore(x: Column | str, mean: float, sd: float, digits: int = 4) -> Column:
    return rnd((col(x) - F.lit(float(mean))) / F.lit(float(sd)), digits)


def scaled_product(columns: list[Column | str], scale: float = 1.0, digits: int | None = None) -> Column:
    out = reduce(lambda a, b: a * b, [col(c).cast("double") for c in columns]) / F.lit(float(scale))
    return out if digits is None else rnd_pos(out, digits)


def tags(rules: list[tuple[Column, str | Column]]) -> Column:
    """Names of all rules that hold, in rule order, without holes."""
    # array_except drops the NULL holes in generated code; array_compact is an interpreted filter
    return F.array_except(F.array(*_names(rules)), F.array(F.lit(None).cast("string")))


def _names(rules: list[tuple[Column, str | Column]]) -> list[Column]:
    return [F.when(c, name if isinstance(name, Column) else F.lit(name)) for c, name in rules]


def tag_text(rules: list[tuple[Column, str | Column]], sep: str = ",") -> Column:
    """The tags as one text; empty when no rule holds."""
    return F.concat_ws(sep, *_names(rules))


def joined_tags(rules: list[tuple[Column, str]], default: str, sep: str = "; ") -> Column:
    return F.coalesce(F.nullif(tag_text(rules, sep), F.lit("")), F.lit(default))


def flag_struct(rules: dict[str, Column]) -> Column:
    """One boolean field per rule; an unknown rule reads false."""
    return F.struct(*[F.coalesce(c, F.lit(False)).alias(name) for name, c in rules.items()])


def any_flag(struct_col: Column | str, names: list[str]) -> Column:
    s = col(struct_col)
    return reduce(lambda a, b: a | b, [s.getField(n) for n in names])


def all_hold(rules: list[Column]) -> Column:
    """True only when every rule is known and true."""
    return F.coalesce(reduce(lambda a, b: a & b, rules), F.lit(False))


def additive_quality(rules: list[tuple[Column, float]], digits: int | None = None,
                     cap: float | None = None) -> Column:
    total = points([(c, p, 0.0) for c, p in rules])
    if cap is not None:
        total = F.least(F.lit(float(cap)), total)
    return total if digits is None else rnd_pos(total, digits)


def penalty_quality(penalties: list[tuple[Column, float]], missing: list[Column] | None = None,
                    per_missing: float = 0.1, digits: int = 6) -> Column:
    """1 minus the penalties that apply, never below 0."""
    lost = points([(c, p, 0.0) for c, p in penalties])
    for m in missing or []:
        lost = lost + F.when(m, F.lit(per_missing)).otherwise(F.lit(0.0))
    return rnd_pos(F.greatest(F.lit(0.0), F.lit(1.0) - lost), digits)


def completeness(present: list[Column], unit: float | None = None, digits: int = 3) -> Column:
    """Share of the conditions that hold, or ``unit`` per condition."""
    hits = points([(c, 1.0, 0.0) for c in present])
    return rnd_pos(hits / F.lit(float(len(present))) if unit is None else hits * F.lit(unit), digits)
