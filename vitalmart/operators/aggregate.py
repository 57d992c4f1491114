"""Grouped reports, long metric rows, profiles and confusion tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitalmart.functions.numeric import col, fold_sum, pct, ratio, rnd


# levels of a category that may be gathered into one value
LEVELS = 10_000


# ---- measures --------------------------------------------------------------
def n() -> Column:
    return F.count(F.lit(1))


def n_if(cond: Column) -> Column:
    return F.count_if(cond)


def rate(cond: Column, digits: int) -> Column:
    """Share of rows that meet cond, in percent."""
    return pct(F.count_if(cond), F.count(F.lit(1)), digits)


def mean(x: Column | str, digits: int) -> Column:
    return rnd(F.avg(col(x)), digits)


def mean_if(cond: Column, x: Column | str, digits: int) -> Column:
    return rnd(F.avg(F.when(cond, col(x))), digits)


def sd(x: Column | str, digits: int) -> Column:
    return rnd(F.stddev_samp(col(x)), digits)


def corr(x: Column | str, y: Column | str, digits: int) -> Column:
    """Pearson correlation over rows where both are known; NULL where one is constant."""
    c = F.corr(col(x).cast("double"), col(y).cast("double"))
    return rnd(F.when(F.isnan(c), F.lit(None)).otherwise(c), digits)


def total(x: Column | str) -> Column:
    return F.sum(col(x))


def share_of_total(x: Column | str, digits: int) -> Column:
    """x as percent of its sum over all report rows (use after grouping).

    The window is unpartitioned on purpose: it runs over report rows, one per
    group, never over the detail table.
    """
    return pct(x, F.sum(col(x)).over(Window.partitionBy()), digits)


# ---- reports ---------------------------------------------------------------
def report(df: DataFrame, keys: dict[str, Column | str] | list[str], measures: dict[str, Column],
           shares: dict[str, tuple[str, int]] | None = None, derived: dict[str, Column] | None = None) -> DataFrame:
    """Group, aggregate, then add shares (name -> measure, digits) and derived columns."""
    named = keys if isinstance(keys, dict) else {k: k for k in keys}
    out = df.groupBy(*[col(c).alias(k) for k, c in named.items()]).agg(*[c.alias(m) for m, c in measures.items()])
    for name, (measure, digits) in (shares or {}).items():
        out = out.withColumn(name, share_of_total(measure, digits))
    return out.withColumns(derived) if derived else out


def metric_rows(df: DataFrame, metrics: dict[str, Column], name_col: str = "metric_name",
                value_col: str = "metric_value", as_text: bool = False) -> DataFrame:
    """All metrics in one pass, then one row per metric.

    Values are double, or text when ``as_text``. This replaces one scan per
    UNION ALL branch.
    """
    kind = "string" if as_text else "double"
    wide = df.agg(*[c.cast(kind).alias(m) for m, c in metrics.items()])
    return wide.unpivot([], list(metrics), name_col, value_col)


def struct_rows(df: DataFrame, rows: dict[str, dict[str, Column]], name_col: str) -> DataFrame:
    """Several multi-column report rows out of one aggregate pass.

    ``rows`` maps a row name to its columns (same column names in each row).
    """
    wide = df.agg(*[F.struct(*[c.alias(k) for k, c in cells.items()]).alias(f"r{i}")
                    for i, cells in enumerate(rows.values())])
    tagged = F.array(*[F.struct(F.lit(name).alias(name_col), *[F.col(f"r{i}.{k}").alias(k) for k in cells])
                       for i, (name, cells) in enumerate(rows.items())])
    return wide.select(F.inline(tagged))


def text_number(x: Column, digits: int) -> Column:
    """Fixed number of decimals, no grouping."""
    return F.format_string(f"%.{digits}f", rnd(x, digits))


# ---- profiles --------------------------------------------------------------
def column_profile(df: DataFrame, columns: list[str], digits: int = 1) -> DataFrame:
    return struct_rows(df, {
        c: {"mean_value": mean(c, digits), "std_value": sd(c, digits), "min_value": F.min(c).cast("double"),
            "max_value": F.max(c).cast("double"), "null_count": n_if(F.col(c).isNull()), "total_count": n()}
        for c in columns}, "feature_name")


def moments(df: DataFrame, columns: list[str], bias_corrected: bool = True, digits: int = 6) -> DataFrame:
    """Mean, deviation, extremes, skewness and excess kurtosis per column.

    bias_corrected gives the sample versions that data-frame libraries print.
    """
    x = F.col("x")
    k = F.count(x).cast("double")
    skew, kurt = F.skewness(x), F.kurtosis(x)
    if bias_corrected:
        skew = ratio(skew * F.sqrt(k * (k - 1.0)), k - 2.0)
        kurt = ratio((k - 1.0) * ((k + 1.0) * kurt + 6.0), (k - 2.0) * (k - 3.0))
    # grouped by name, the update code of one column serves all; that of all columns at once is too long to be compiled
    long = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot([], columns, "column_name", "x")
    found = long.groupBy("column_name").agg(rnd(F.avg(x), digits).alias("mean"), rnd(F.stddev_samp(x), digits).alias("std"), F.min(x).alias("min"),
                                            F.max(x).alias("max"), rnd(skew, digits).alias("skewness"), rnd(kurt, digits).alias("kurtosis"))
    names = df.sparkSession.createDataFrame([(c,) for c in columns], "column_name string")
    return names.join(F.broadcast(found), "column_name", "left")  # an empty table has its rows, too


def missing(x: str, dtype: str) -> Column:
    """NULL, or NaN for floating-point columns."""
    c = F.col(x)
    return c.isNull() | F.isnan(c) if dtype in ("double", "float") else c.isNull()


def missing_report(df: DataFrame, columns: list[str] | None = None, digits: int = 2) -> DataFrame:
    types = dict(df.dtypes)
    columns = columns or df.columns
    return struct_rows(df, {
        c: {"missing_count": n_if(missing(c, types[c])), "missing_pct": rate(missing(c, types[c]), digits)}
        for c in columns}, "column_name")


def value_counts(df: DataFrame, keys: list[str], x: str, out: str = "n_rows") -> DataFrame:
    """One row per key and value with its count: the form for columns of any width, as no task
    holds a whole group. NULL values are left out."""
    return df.where(F.col(x).isNotNull()).groupBy(*keys, x).agg(n().alias(out))


def few_levels(levels: DataFrame, keys: list[str], most: int = LEVELS) -> DataFrame:
    """``levels`` (one row per key and value) unchanged, once it is known that no key has more than ``most`` of them.

    Gathering makes one value of a key's levels, in one task. More levels than a reader can use are an error
    that names the form for them.
    """
    widest = levels.groupBy(*keys).agg(n().alias("_n")).agg(F.max("_n").alias("m")).first()["m"] or 0
    if widest > most:
        raise ValueError(f"a group has {widest} different values, more than {most}: take value_counts, which lists them as rows")
    return levels


def value_distribution(df: DataFrame, keys: list[str], x: str, out: str, most: int = LEVELS) -> DataFrame:
    """Map value -> count per key, for categories: the map is one value and holds all levels
    of a group, at most ``most``. Counts are made before they are gathered. Wide columns take ``value_counts``."""
    counted = few_levels(value_counts(df, keys, x, "_n"), keys, most)
    entries = F.array_sort(F.collect_list(F.struct(F.col(x).alias("key"), F.col("_n").alias("value"))))
    return counted.groupBy(*keys).agg(F.map_from_entries(entries).alias(out))


def most_common(df: DataFrame, keys: list[str], x: str, out: str) -> DataFrame:
    """Most frequent value per key; the smallest value wins a tie.

    Count, then max_by: unlike ``mode`` no buffer grows with the values.
    """
    counted = df.where(F.col(x).isNotNull()).groupBy(*keys, x).agg(n().alias("_n"))
    best = F.min(F.struct((-F.col("_n")).alias("neg"), F.col(x).alias("v")))
    return counted.groupBy(*keys).agg(best.getField("v").alias(out))


def joined_values(df: DataFrame, keys: list[str], x: str, sep: str, out: str, most: int = LEVELS) -> DataFrame:
    """Per key the different values of a category as sorted text, at most ``most`` of them.
    Values are made distinct by all tasks before a group is gathered."""
    levels = few_levels(df.where(F.col(x).isNotNull()).select(*keys, x).distinct(), keys, most)
    return levels.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_list(x)), sep).alias(out))


def joined_labels(label: Column | str, sep: str) -> Column:
    """The same as a measure, for labels that a rule gives: their number is bounded by the rule, not by the data."""
    return F.array_join(F.array_sort(F.collect_set(col(label))), sep)


# ---- classification --------------------------------------------------------
def confusion_counts(df: DataFrame, actual: Column | str, predicted: Column | str) -> DataFrame:
    """tp, tn, fp, fn and the row count in one pass."""
    a, p = col(actual), col(predicted)
    return df.agg(n_if((a == 1) & (p == 1)).alias("tp"), n_if((a == 0) & (p == 0)).alias("tn"),
                  n_if((a == 0) & (p == 1)).alias("fp"), n_if((a == 1) & (p == 0)).alias("fn"),
                  n().alias("total"))


def classification_metrics(confusion: DataFrame, digits: int = 6) -> DataFrame:
    """Rates from a confusion row; a zero denominator gives NULL."""
    tp, tn, fp, fn = (F.col(c) for c in ("tp", "tn", "fp", "fn"))
    return confusion.select(
        *confusion.columns,
        rnd(ratio(tp + tn, fold_sum([tp, tn, fp, fn])), digits).alias("accuracy"),
        rnd(ratio(tp, tp + fp), digits).alias("precision"), rnd(ratio(tp, tp + fn), digits).alias("recall"),
        rnd(ratio(tn, tn + fp), digits).alias("specificity"), rnd(ratio(tn, tn + fn), digits).alias("npv"),
        rnd(ratio(2 * tp, 2 * tp + fp + fn), digits).alias("f1_score"))


def class_balance(df: DataFrame, label: str) -> DataFrame:
    r = rnd(ratio(n_if(F.col(label) == 1), n_if(F.col(label) == 0)), 6)
    return df.agg(n_if(F.col(label) == 0).alias("class_0_count"), n_if(F.col(label) == 1).alias("class_1_count"),
                  r.alias("class_balance_ratio"),
                  F.coalesce(r.between(0.2, 5.0), F.lit(False)).alias("is_balanced"))
