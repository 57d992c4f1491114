"""Imputation, outlier handling and scaling from whole-table statistics.

Statistics are one aggregate row that a broadcast join adds to every row: the plan stays
lazy, all statistics of a step cost one pass, nothing visits the driver program, and no
expression repeats the plan that makes them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalmart.functions.numeric import clamp, col, pct, ratio, rnd

from .quantiles import percentiles_of_columns


def scalar_struct(stats: DataFrame) -> Column:
    """A one-row table as a struct-valued scalar subquery, for expressions that name it once."""
    return stats.select(F.struct(*[F.col(c) for c in stats.columns]).alias("s")).scalar()


def with_stats(df: DataFrame, name: str, stats: DataFrame) -> DataFrame:
    """df with the one row of ``stats`` as a struct column."""
    return df.crossJoin(F.broadcast(stats.select(F.struct(*stats.columns).alias(name))))


def global_stats(df: DataFrame, **measures: Column) -> DataFrame:
    return df.agg(*[c.alias(n) for n, c in measures.items()])


def column_percentiles(df: DataFrame, columns: list[str], probs: dict[str, float], *, exact: bool,
                       accuracy: int = 10000, where: dict[str, Column] | None = None) -> DataFrame:
    """One row with a field per column, each holding a struct of percentiles.

    exact=False uses the mergeable sketch (bounded memory, returns members of
    the data); exact=True the distributed interpolated percentiles.
    """
    if exact:
        rows = percentiles_of_columns(df, columns, probs, where)
        return rows.agg(*[F.max(F.when(F.col("column_name") == c, F.struct(*probs))).alias(c) for c in columns])
    where = where or {}
    parts = []
    for c in columns:
        x = F.when(where[c], F.col(c)) if c in where else F.col(c)
        q = F.percentile_approx(x, list(probs.values()), accuracy)
        parts.append(F.struct(*[q[i].alias(n) for i, n in enumerate(probs)]).alias(c))
    return df.agg(*parts)


def impute(df: DataFrame, mean: list[str] = (), median: list[str] = (), constant: dict[str, object] | None = None,
           exact_median: bool = False) -> DataFrame:
    """Fill NULL by column mean, column median or a constant. Measures become double."""
    new: dict[str, Column] = {}
    out = df
    if mean:
        out = with_stats(out, "_means", global_stats(df, **{c: F.avg(c) for c in mean}))
        new |= {c: F.coalesce(F.col(c).cast("double"), F.col("_means").getField(c)) for c in mean}
    if median:
        out = with_stats(out, "_medians", column_percentiles(df, list(median), {"p50": 0.5}, exact=exact_median))
        new |= {c: F.coalesce(F.col(c).cast("double"), F.col(f"_medians.{c}.p50").cast("double")) for c in median}
    for c, v in (constant or {}).items():
        new[c] = F.coalesce(F.col(c), F.lit(v))
    return out.withColumns(new).drop("_means", "_medians")


def zero_to_positive_median(df: DataFrame, columns: list[str]) -> DataFrame:
    """Replace 0 by the exact median of the positive values of the column."""
    q = column_percentiles(df, columns, {"p50": 0.5}, exact=True, where={c: F.col(c) > 0 for c in columns})
    return with_stats(df, "_medians", q).withColumns({
        c: F.when(F.col(c) == 0, F.col(f"_medians.{c}.p50")).otherwise(F.col(c).cast("double"))
        for c in columns}).drop("_medians")


def _with_fences(df: DataFrame, columns: list[str], exact: bool, k: float) -> DataFrame:
    """Adds _fences: per column the struct (lo, hi)."""
    q = column_percentiles(df, columns, {"q1": 0.25, "q3": 0.75}, exact=exact)
    quartiled = with_stats(df, "_quartiles", q)
    pairs = []
    for c in columns:
        q1, q3 = (F.col(f"_quartiles.{c}.{n}").cast("double") for n in ("q1", "q3"))
        pairs.append(F.struct((q1 - F.lit(k) * (q3 - q1)).alias("lo"), (q3 + F.lit(k) * (q3 - q1)).alias("hi")).alias(c))
    return quartiled.withColumn("_fences", F.struct(*pairs)).drop("_quartiles")


def cap_outliers(df: DataFrame, columns: list[str], exact: bool = False, k: float = 1.5) -> DataFrame:
    """Clip to [Q1 - k*IQR, Q3 + k*IQR]; NULL stays NULL, unknown fences change nothing."""
    new = {}
    for c in columns:
        lo, hi = F.col(f"_fences.{c}.lo"), F.col(f"_fences.{c}.hi")
        new[c] = F.when(F.col(c) < lo, lo).when(F.col(c) > hi, hi).otherwise(F.col(c).cast("double"))
    return _with_fences(df, columns, exact, k).withColumns(new).drop("_fences")


def outliers_to_null(df: DataFrame, columns: list[str], exact: bool = False, k: float = 1.5) -> DataFrame:
    new = {}
    for c in columns:
        lo, hi = F.col(f"_fences.{c}.lo"), F.col(f"_fences.{c}.hi")
        new[c] = F.when((F.col(c) < lo) | (F.col(c) > hi), F.lit(None)).otherwise(F.col(c).cast("double"))
    return _with_fences(df, columns, exact, k).withColumns(new).drop("_fences")


def outlier_report(df: DataFrame, columns: list[str], k: float = 1.5, digits: int = 2) -> DataFrame:
    """One row per column: quartiles, fences, outlier count and percentage.

    Rows are counted against the fences where they are read; no value is shuffled for it.
    """
    quartiles = percentiles_of_columns(df, columns, {"q1": 0.25, "q3": 0.75})
    long = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot([], columns, "column_name", "v")
    iqr = F.col("q3") - F.col("q1")
    lo, hi = F.col("q1") - F.lit(k) * iqr, F.col("q3") + F.lit(k) * iqr
    outside = F.count_if((F.col("v") < lo) | (F.col("v") > hi))
    # quartiles has one row per column name: bounded by the schema, safe to broadcast
    return (long.join(F.broadcast(quartiles), "column_name")
            .groupBy("column_name", "q1", "q3").agg(outside.alias("outliers_count"), F.count(F.lit(1)).alias("rows"))
            .select("column_name", "q1", "q3", iqr.alias("iqr"), lo.alias("lower_bound"), hi.alias("upper_bound"),
                    "outliers_count", pct("outliers_count", "rows", digits).alias("outliers_percentage")))


def min_max(df: DataFrame, columns: list[str], suffix: str = "_normalized", constant_value: float | None = None) -> DataFrame:
    """(x - min) / (max - min) over the table; a constant column gives ``constant_value`` (NULL by default)."""
    s = global_stats(df, **{f"{c}_{n}": f(c) for c in columns for n, f in (("min", F.min), ("max", F.max))})
    new = {}
    for c in columns:
        lo, hi = F.col(f"_range.{c}_min").cast("double"), F.col(f"_range.{c}_max").cast("double")
        scaled = ratio(F.col(c) - lo, hi - lo)
        new[c + suffix] = scaled if constant_value is None else F.when(hi > lo, scaled).otherwise(F.lit(constant_value))
    return with_stats(df, "_range", s).withColumns(new).drop("_range")


def fixed_min_max(x: Column | str, lo: float, hi: float) -> Column:
    """(x - lo) / (hi - lo), clipped to [0, 1]."""
    return clamp((col(x) - F.lit(float(lo))) / F.lit(float(hi - lo)))


def z_score(df: DataFrame, columns: list[str], suffix: str = "_zscore", digits: int = 4) -> DataFrame:
    s = global_stats(df, **{f"{c}_{n}": f(c) for c in columns for n, f in (("mean", F.avg), ("sd", F.stddev_samp))})
    return with_stats(df, "_moments", s).withColumns({
        c + suffix: rnd(ratio(F.col(c) - F.col(f"_moments.{c}_mean"), F.col(f"_moments.{c}_sd")), digits)
        for c in columns}).drop("_moments")
