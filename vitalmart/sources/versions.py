"""Picking the newest saved version of things named ``<type>_<yyyymmdd>_<hhmmss>``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed pattern: type, date, time
_STAMPED = r"([A-Za-z_]+)_(\d{8}_\d{6})$"


def parse_versions(paths: DataFrame, path_col: str = "path") -> DataFrame:
    parsed = paths.select(path_col, F.regexp_extract(path_col, _STAMPED, 1).alias("kind"),
                          F.regexp_extract(path_col, _STAMPED, 2).alias("stamp"))
    return parsed.where(F.col("stamp") != "")


def latest_versions(paths: DataFrame, path_col: str = "path") -> DataFrame:
    """Newest path per kind, and only kinds that share the newest stamp of all."""
    versions = parse_versions(paths, path_col)
    newest: Column = versions.agg(F.max("stamp").alias("s")).scalar()
    return (versions.groupBy("kind").agg(F.max_by(path_col, "stamp").alias(path_col), F.max("stamp").alias("stamp"))
            .where(F.col("stamp") == newest))


def versioned_name(kind: str, at: Column) -> Column:
    return F.concat(F.lit(kind + "_"), F.date_format(at, "yyyyMMdd_HHmmss"))
