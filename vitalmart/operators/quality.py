"""Table-level data-quality checks: every check set is one aggregate pass."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalmart.functions.numeric import fold_sum, pct, ratio, rnd
from vitalmart.functions.scores import tags

from .aggregate import mean, missing, n, n_if, rate, struct_rows
from .clean import NUMERIC_TYPES


def column_check(df: DataFrame, required: list[str], optional: list[str] = ()) -> DataFrame:
    """One row per expected column: present or not, hard failure or warning, filled rows."""
    rows = {}
    for names, level in ((required, "error"), (optional, "warning")):
        for c in names:
            there = c in df.columns
            rows[c] = {"present": F.lit(there), "status": F.lit("ok" if there else level),
                       "filled_rows": F.count(F.col(c)) if there else F.lit(0).cast("bigint")}
    return struct_rows(df, rows, "column_name")


def require_columns(df: DataFrame, required: list[str]) -> DataFrame:
    gone = [c for c in required if c not in df.columns]
    if gone:
        raise ValueError(f"missing columns: {', '.join(gone)}")
    return df


def type_check(df: DataFrame, numeric: list[str]) -> DataFrame:
    """Declared type of columns that should be numeric, and how many values would convert."""
    kinds = dict(df.dtypes)
    rows = {}
    for c in numeric:
        kind = kinds.get(c, "absent")
        usable = F.count(F.col(c).try_cast("double")) if c in kinds else F.lit(0).cast("bigint")
        rows[c] = {"data_type": F.lit(kind), "is_numeric": F.lit(kind in NUMERIC_TYPES or kind.startswith("decimal")),
                   "convertible_rows": usable}
    return struct_rows(df, rows, "column_name")


def require_rows(df: DataFrame) -> DataFrame:
    if df.isEmpty():
        raise ValueError("table is empty")
    return df


def missing_share_gate(df: DataFrame, columns: list[str], fail_over: float = 0.30) -> DataFrame:
    """All missing cells against the row count, and the tier of the cell share."""
    types = dict(df.dtypes)
    cells = fold_sum([n_if(missing(c, types[c])) for c in columns])
    share = ratio(cells, n() * F.lit(len(columns))) * 100
    return df.agg(
        n().alias("total_records"), cells.alias("missing_cells"), rnd(share, 4).alias("missing_percentage"),
        F.when(share < 5, F.lit("ok")).when(share < 15, F.lit("warning")).otherwise(F.lit("fail")).alias("tier"),
        (cells <= n() * F.lit(fail_over)).alias("gate_passed"))


def range_violations(df: DataFrame, ranges: dict[str, tuple[float, float]], tolerated: float = 0.01) -> DataFrame:
    bad = {c: n_if(~F.col(c).between(lo, hi)) for c, (lo, hi) in ranges.items()}
    return struct_rows(df, {
        c: {"violations": v, "total_records": n(), "within_tolerance": v < n() * F.lit(tolerated)}
        for c, v in bad.items()}, "column_name")


def rule_counts(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows that break each named rule."""
    return struct_rows(df, {name: {"violations": n_if(c), "passed": n_if(c) == 0} for name, c in rules.items()},
                       "rule_name")


def duplicate_rows(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Number of rows beyond the first of each identical group."""
    counted = df.groupBy(*(columns or df.columns)).agg(n().alias("_n"))
    return counted.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("total_records"),
                       F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_records"))


def empty_rows_and_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    all_null = reduce(lambda a, b: a & b, [F.col(c).isNull() for c in columns])
    filled = fold_sum([F.when(F.count(c) == 0, 1).otherwise(0) for c in columns])
    return df.agg(n_if(all_null).alias("empty_rows"), filled.cast("bigint").alias("empty_columns"))


def layer_report(df: DataFrame, layer: str, skip: list[str] = ()) -> DataFrame:
    """Long quality rows of a layer: rows, columns, missing % per column, mean of each numeric column."""
    types = dict(df.dtypes)
    watched = [c for c in df.columns if c not in skip]
    numeric = [c for c in watched if types[c] in ("int", "bigint", "double", "float")]
    metrics = {"total_records": n(), "total_columns": F.lit(len(df.columns))}
    metrics |= {f"{c}_missing_pct": rate(missing(c, types[c]), 2) for c in watched}
    metrics |= {f"{c}_mean": mean(c, 4) for c in numeric}
    wide = df.agg(*[c.cast("double").alias(m) for m, c in metrics.items()])
    return wide.unpivot([], list(metrics), "metric_name", "metric_value").select(
        F.lit(layer).alias("layer_name"), "metric_name", "metric_value")


def layer_metrics(df: DataFrame, layer: str, as_of: Column, time_col: str | None, skip: list[str] = ()) -> DataFrame:
    """Records, columns, average missing % over columns and age of the newest row in hours."""
    watched = [c for c in df.columns if c not in skip]
    shares = fold_sum([ratio(n_if(F.col(c).isNull()) * 100.0, n()) for c in watched])
    cells = {"total_records": n().cast("double"), "total_columns": F.lit(float(len(df.columns))),
             "avg_missing_pct": rnd(shares / F.lit(float(len(watched))), 4)}
    if time_col:
        age = F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(F.max(F.col(time_col).cast("timestamp")))
        cells["data_age_hours"] = rnd(age / F.lit(3.6e9), 4)
    wide = df.agg(*[c.alias(f"{layer}_{m}") for m, c in cells.items()])
    return wide.unpivot([], [f"{layer}_{m}" for m in cells], "metric_name", "metric_value")


def threshold_rows(stats: DataFrame, checks: list[tuple[str, Column, Column, str]]) -> DataFrame:
    """Assertion rows from a one-row statistics table: (name, value, passed, severity)."""
    rows = F.array(*[F.struct(F.lit(name).alias("check_name"), v.cast("double").alias("value"),
                              F.coalesce(ok, F.lit(False)).alias("passed"), F.lit(sev).alias("severity"))
                     for name, v, ok, sev in checks])
    return stats.select(F.inline(rows))


def pass_rule(name: Column, value: Column, threshold: Column) -> Column:
    """Counts pass at or below the threshold, other metrics at or above; no threshold passes."""
    return (F.when(threshold.isNull(), F.lit(True))
            .when(name.like("%\\_count"), value <= threshold).otherwise(value >= threshold))


def log_metrics(metrics: DataFrame, schema_name: str, table_name: str, thresholds: dict[str, float],
                at: Column) -> DataFrame:
    """Metric rows with threshold and pass flag, in the quality-log shape."""
    limit = F.element_at(F.create_map(*[x for k, v in thresholds.items() for x in (F.lit(k), F.lit(float(v)))]),
                         F.col("metric_name")) if thresholds else F.lit(None).cast("double")
    return metrics.select(
        F.lit(table_name).alias("table_name"), F.lit(schema_name).alias("schema_name"), "metric_name",
        F.col("metric_value").cast("double").alias("metric_value"), limit.alias("threshold_value"),
        at.alias("check_timestamp")).withColumn(
        "is_passed", pass_rule(F.col("metric_name"), F.col("metric_value"), F.col("threshold_value")))


def split_by_constraints(df: DataFrame, constraints: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Accepted rows, and rejected rows with the names of the broken constraints.

    As in SQL, an unknown constraint does not reject a row.
    """
    broken = tags([(~c, name) for name, c in constraints.items()])
    marked = df.withColumn("reject_reasons", broken)
    return (marked.where(F.size("reject_reasons") == 0).drop("reject_reasons"),
            marked.where(F.size("reject_reasons") > 0))


def column_quality_counts(df: DataFrame, ranges: dict[str, tuple[float, float]]) -> DataFrame:
    """Per column: nulls, zeros and out-of-range values."""
    return struct_rows(df, {
        c: {"null_count": n_if(F.col(c).isNull()), "zero_count": n_if(F.col(c) == 0),
            "outlier_count": n_if(~F.col(c).between(lo, hi)), "record_count": n()}
        for c, (lo, hi) in ranges.items()}, "column_name")


def completeness_between(part: DataFrame, whole: DataFrame, digits: int = 2) -> DataFrame:
    """Rows of one layer as percent of another."""
    base = whole.agg(n().alias("n")).scalar()
    return part.agg(n().alias("part_records")).select(
        "part_records", base.alias("whole_records"), pct("part_records", base, digits).alias("completeness_pct"))
