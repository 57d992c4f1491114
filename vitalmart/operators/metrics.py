"""Business metrics and their long, text and JSON shapes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalmart.functions.numeric import rnd

from .aggregate import mean, n, n_if, rate, report


def business_metrics(gold: DataFrame, levels: list[str], outcome: str = "diabetes") -> DataFrame:
    """Wide one-row metrics: totals, level counts, outcome counts, urgent share."""
    urgent = F.col("intervention_priority") == "Immediate"
    return gold.agg(
        n().alias("total_patients"), F.coalesce(mean("risk_score", 6), F.lit(0.0)).alias("avg_risk_score"),
        n_if(urgent).alias("high_risk_patients"),
        F.coalesce(rate(urgent, 4), F.lit(0.0)).alias("high_risk_percentage"),
        *[n_if(F.col("health_risk_level") == lv).alias(lv) for lv in levels],
        *[n_if(F.col(outcome) == v).alias(f"{outcome}_{v}") for v in (0, 1)])


def to_long(wide: DataFrame) -> DataFrame:
    """Numeric columns of a metric row as (metric_name, metric_value)."""
    numeric = [c for c, t in wide.dtypes if t in ("int", "bigint", "double", "float")]
    return wide.select(*[F.col(c).cast("double").alias(c) for c in numeric]).unpivot(
        [], numeric, "metric_name", "metric_value")


def exposition_lines(metrics: DataFrame, job: str, at: Column) -> DataFrame:
    """Text lines ``name{job="..."} value epoch_ms``, sorted by nothing."""
    ms = F.unix_millis(at.cast("timestamp"))
    return metrics.select(F.format_string(f'%s{{job="{job}"}} %s %d', F.col("metric_name"),
                                          F.col("metric_value").cast("string"), ms).alias("line"))


def pick_keys(docs: DataFrame, json_col: str, picks: dict[str, str]) -> DataFrame:
    """Named numbers out of a JSON document; absent keys read 0."""
    schema = ", ".join(f"`{k}` double" for k in dict.fromkeys(picks.values()))
    parsed = F.from_json(F.col(json_col), schema)
    return docs.select(*[c for c in docs.columns if c != json_col],
                       *[F.coalesce(parsed.getField(src), F.lit(0.0)).alias(out) for out, src in picks.items()])


def pivot_free_counts(df: DataFrame, key: str, digits: int = 6) -> DataFrame:
    """Counts of a category with its share, one row per level."""
    return report(df, [key], {"row_count": n()}, {"share_pct": ("row_count", digits)})
