"""Mergeable sketches kept per day: distinct counts and percentiles of any range of days.

A day's rows are read once, when they arrive; what is kept of them are a HyperLogLog sketch per
column counted and a KLL sketch per column ranked, a few kilobytes per day and group whatever the number of
rows. A report over any days merges their sketches and never goes back to the rows. Errors do not
grow with the number of sketches merged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalmart.functions.numeric import col

LG_K = 14  # 2^14 registers: 0.8 % standard error
KLL_K = 400  # 0.7 % of the rows as rank error


def distinct_error(lg_k: int = LG_K, deviations: float = 4.0) -> float:
    """Relative error of a distinct count, at so many standard deviations (4: one count in 15,000 is beyond)."""
    return deviations * 1.04 / 2 ** (lg_k / 2)


def rank_error(k: int = KLL_K, factor: float = 2.0) -> float:
    """Share of the rows by which the rank of a KLL percentile may be off. The published bound holds with
    99 % confidence at factor 1; twice that bound is far beyond any run."""
    return factor * 2.296 / k ** 0.9723


def day_sketches(df: DataFrame, day: str, keys: list[str], distinct: dict[str, Column | str] | None = None,
                 ranked: dict[str, Column | str] | None = None) -> DataFrame:
    """Per day and keys: ``n_rows``, an HLL sketch per entry of ``distinct``, and per entry of ``ranked`` a KLL
    sketch, the smallest and largest value and exact sums (count, sum, sum of squares).

    NULL values are not counted. Sketches merge map-side, so a hot day or group is one row per task.
    A group of a day without values has NULL sketches.
    """
    measures = [F.count(F.lit(1)).alias("n_rows")]
    measures += [F.hll_sketch_agg(col(c), F.lit(LG_K)).alias(f"{name}_hll") for name, c in (distinct or {}).items()]
    for name, c in (ranked or {}).items():
        x = col(c).cast("double")
        x = F.when(~F.isnan(x), x)
        measures += [F.kll_sketch_agg_double(x, F.lit(KLL_K)).alias(f"{name}_kll"), F.min(x).alias(f"{name}_min"), F.max(x).alias(f"{name}_max"),
                     F.count(x).alias(f"{name}_n"), F.sum(x).alias(f"{name}_sum"), F.sum(x * x).alias(f"{name}_squares")]
    return df.groupBy(day, *keys).agg(*measures)


def add_days(sketches: DataFrame, path: str, day: str) -> None:
    """Write the sketches of whole days; a day given again replaces the kept one, others stay."""
    sketches.hint("rebalance", day).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)


def kept_days(spark: SparkSession, path: str, day: str, first: object = None, last: object = None) -> DataFrame:
    """The kept sketches of the days from first to last; the other days' files are not opened."""
    kept = spark.read.parquet(path)
    if first is not None:
        kept = kept.where(F.col(day) >= F.lit(first))
    return kept.where(F.col(day) <= F.lit(last)) if last is not None else kept


def merged(sketches: DataFrame, keys: list[str], distinct: list[str] = (), ranked: list[str] = ()) -> DataFrame:
    """One row per keys with the sketches of all its days merged, in the columns of ``day_sketches``."""
    measures = [F.sum("n_rows").alias("n_rows")]
    measures += [F.hll_union_agg(f"{name}_hll").alias(f"{name}_hll") for name in distinct]
    for name in ranked:
        measures += [F.kll_merge_agg_double(f"{name}_kll").alias(f"{name}_kll"), F.min(f"{name}_min").alias(f"{name}_min"),
                     F.max(f"{name}_max").alias(f"{name}_max"), *[F.sum(f"{name}_{s}").alias(f"{name}_{s}") for s in ("n", "sum", "squares")]]
    return sketches.groupBy(*keys).agg(*measures)


def distinct_count(name: str) -> Column:
    return F.coalesce(F.hll_sketch_estimate(f"{name}_hll"), F.lit(0).cast("bigint"))


def percentile(name: str, p: float) -> Column:
    """A value of the data whose rank is ``p`` within ``rank_error``; NULL without values."""
    return F.when(F.col(f"{name}_n") > 0, F.kll_sketch_get_quantile_double(F.col(f"{name}_kll"), F.lit(float(p))))


def share_below(name: str, x: Column | float) -> Column:
    """Share of the values <= x within ``rank_error``; NULL without values."""
    x = x if isinstance(x, Column) else F.lit(float(x))
    return F.when(F.col(f"{name}_n") > 0, F.kll_sketch_get_rank_double(F.col(f"{name}_kll"), x))


def deviation(name: str) -> Column:
    """Sample standard deviation from the exact sums."""
    n, total, squares = (F.col(f"{name}_{s}") for s in ("n", "sum", "squares"))
    return F.sqrt(F.greatest(F.try_divide(squares - F.try_divide(total * total, n), n - 1), F.lit(0.0)))


def distinct_within(exact: Column | str, name: str, lg_k: int = LG_K) -> Column:
    """Whether the estimate lies within its error of the exact count."""
    return F.abs(distinct_count(name) - col(exact)) <= F.ceil(col(exact) * F.lit(distinct_error(lg_k)))


def rank_within(below: Column | str, upto: Column | str, n: Column | str, p: float, k: int = KLL_K) -> Column:
    """Whether a value with ``below`` values less and ``upto`` values not greater has rank p within the error (and one row)."""
    slack = col(n) * F.lit(rank_error(k)) + 1
    return (col(below) <= col(n) * F.lit(float(p)) + slack) & (col(upto) >= col(n) * F.lit(float(p)) - slack)
