"""Reuse of expression sets between calls."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark import SparkContext


def per_context(build: Callable):
    """Remember what ``build()`` returns for the active SparkContext.

    Columns name their inputs and are bound to no table, so a set that takes
    thousands of calls to the JVM can be made once and used for every table.
    """
    made: dict[int, tuple[SparkContext, object]] = {}

    @functools.wraps(build)
    def cached():
        context = SparkContext._active_spark_context
        kept = made.get(id(context))
        if kept is None or kept[0] is not context:
            made.clear()
            kept = made[id(context)] = (context, build())
        return kept[1]

    return cached
