"""Query registration and access to the tables a query runs on."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from vitalmart.plans import layers
from vitalmart.session import tune
from vitalmart.sources.schemas import clinical_from_lineitem, wearable_from_orders

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Report times. EARLY makes every look-back window cover the whole table;
# MIDDLE falls inside it.
EARLY = dt.date(1995, 1, 2)
EARLY_TS = dt.datetime(1995, 1, 2)
MIDDLE = dt.date(1998, 7, 15)


class Tables:
    """Lazy access to the Parquet tables and the layers derived from them."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.dir = tune(spark), sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    @cached_property
    def clinical(self) -> DataFrame:
        return clinical_from_lineitem(self.lineitem)

    @cached_property
    def wearable(self) -> DataFrame:
        return wearable_from_orders(self.orders)

    @cached_property
    def silver(self) -> DataFrame:
        return layers.silver_standard(self.clinical)

    @cached_property
    def gold(self) -> DataFrame:
        return layers.gold_full(self.silver)

    @cached_property
    def features(self) -> DataFrame:
        return layers.gold_features(layers.silver_basic(self.clinical))

    @cached_property
    def categories(self) -> DataFrame:
        return layers.silver_categories(self.clinical)


def cut(name: str, report: Callable[..., DataFrame], as_of: object) -> None:
    """Register ``name`` once more at MIDDLE, where its look-back window leaves rows out."""
    query(f"{name}_cut", ORACLES[name].replace(str(EARLY), str(MIDDLE)))(lambda t: report(t.gold, as_of))


def query(name: str, sql: str | None = None):
    """Register fn(Tables) under name, with its oracle SQL if SQL can say it."""

    def register(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        QUERIES[name].__doc__ = fn.__doc__
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register
