"""Banding: numeric value -> label, from a ladder kept as data."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import col


@dataclass(frozen=True)
class Ladder:
    """``labels[i]`` covers the i-th interval cut by ``edges``.

    closed   "left": [edge, next), "right": (previous, edge].
    floor    lowest accepted value, exclusive; at or below it -> ``outside``.
    null     label of NULL. ``None`` sends NULL to the last label, which is what
             an ELSE branch does.
    """

    edges: tuple[float, ...]
    labels: tuple[str, ...]
    closed: str = "left"
    null: str | None = "Unknown"
    floor: float | None = None
    outside: str = "nan"

    def __post_init__(self) -> None:
        if len(self.labels) != len(self.edges) + 1:
            raise ValueError("a ladder needs one label more than edges")
        if list(self.edges) != sorted(self.edges):
            raise ValueError("ladder edges must ascend")
        if self.closed not in ("left", "right"):
            raise ValueError("closed is 'left' or 'right'")


def band(x: Column | str, ladder: Ladder) -> Column:
    """First interval of the ladder that holds x."""
    x = col(x)
    steps: list[tuple[Column, str]] = []
    if ladder.null is not None:
        steps.append((x.isNull(), ladder.null))
    if ladder.floor is not None:
        steps.append((x <= F.lit(ladder.floor), ladder.outside))
    for edge, label in zip(ladder.edges, ladder.labels):
        steps.append((x < F.lit(edge) if ladder.closed == "left" else x <= F.lit(edge), label))
    return first_match(steps, ladder.labels[-1])


def first_match(rules: list[tuple[Column, object]], default: object) -> Column:
    """Value of the first rule that holds (a CASE chain built from data)."""
    (cond, value), *rest = rules
    chain = reduce(lambda acc, rule: acc.when(rule[0], _lit(rule[1])), rest, F.when(cond, _lit(value)))
    return chain if default is None else chain.otherwise(_lit(default))


_COMPARE = {">=": Column.__ge__, ">": Column.__gt__, "<=": Column.__le__, "<": Column.__lt__}


def holds(rules: list[list[tuple[str, str, float]]]) -> Column:
    """Any rule holds, a rule being limits that all hold; unknown ones do not count beside a true one."""
    one = lambda rule: reduce(and_, [_COMPARE[op](F.col(c), F.lit(limit)) for c, op, limit in rule])
    return reduce(or_, [one(rule) for rule in rules])


def level(ladder: list[tuple[str, list]], default: str) -> Column:
    """Label of the first level whose rules hold."""
    return first_match([(holds(rules), label) for label, rules in ladder], default)


def step_points(steps: list[tuple[str, list[tuple[str, float, float]]]]) -> Column:
    """Sum over measures of the points of the first step that holds, as double."""
    parts = [first_match([(_COMPARE[op](F.col(c), F.lit(limit)), float(p)) for op, limit, p in rungs], 0.0) for c, rungs in steps]
    return reduce(lambda x, y: x + y, parts)


def _lit(value: object) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def order_rank(x: Column | str, order: list[str]) -> Column:
    """1-based place of x in a custom order; everything else comes last."""
    x = col(x)
    return first_match([(x == F.lit(v), i) for i, v in enumerate(order, 1)], len(order) + 1)


def recode(x: Column | str, mapping: dict[str, object], default: object = None) -> Column:
    x = col(x)
    return first_match([(x == F.lit(k), v) for k, v in mapping.items()], default)


def recode_text(x: Column | str, mapping: dict[str, str | None], default: Column | str | None) -> Column:
    """Recode on the trimmed lower-case text; a None target gives NULL."""
    key = F.lower(F.trim(col(x)))
    rules = [(key == F.lit(k), F.lit(None).cast("string") if v is None else v) for k, v in mapping.items()]
    return first_match(rules, default)
