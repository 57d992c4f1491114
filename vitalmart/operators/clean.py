"""Row-wise cleaning: pure projections, so they fuse with the scan."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalmart.functions.numeric import col

NUMERIC_TYPES = {"tinyint", "smallint", "int", "bigint", "float", "double"}


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Old name -> new name; names not in the table are ignored."""
    return df.withColumnsRenamed(dict(mapping))


def zero_to_null(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({c: F.nullif(F.col(c), F.lit(0).cast(df.schema[c].dataType)) for c in columns})


def nonpositive_to_null(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({c: F.when(F.col(c) > 0, F.col(c)) for c in columns})


def in_bounds(x: Column | str, bounds: tuple[float, float, bool]) -> Column:
    x = col(x)
    lo, hi, lo_open = bounds
    return ((x > F.lit(lo)) if lo_open else (x >= F.lit(lo))) & (x <= F.lit(hi))


def out_of_bounds_to_null(df: DataFrame, bounds: Mapping[str, tuple[float, float, bool]]) -> DataFrame:
    return df.withColumns({c: F.when(in_bounds(c, b), F.col(c)) for c, b in bounds.items()})


def drop_sparse_rows(df: DataFrame, min_share: float = 0.5) -> DataFrame:
    """Keep rows with at least ``min_share`` of all columns filled."""
    return df.dropna(thresh=int(len(df.columns) * min_share))


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Numeric columns that are not excluded and carry no time stamp."""
    skip = set(exclude)
    return [c for c, t in df.dtypes if t in NUMERIC_TYPES and c not in skip and not c.endswith("_timestamp")]


def as_double(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    wanted = set(columns)
    return df.select(*[F.col(c).cast("double").alias(c) if c in wanted else F.col(c) for c in df.columns])


def since(time_col: Column | str, as_of: Column, **ago: int) -> Column:
    """time_col is no older than ``as_of`` minus days/hours/weeks."""
    return col(time_col) >= as_of - F.make_dt_interval(
        days=F.lit(ago.get("days", 0) + 7 * ago.get("weeks", 0)), hours=F.lit(ago.get("hours", 0)),
        mins=F.lit(ago.get("minutes", 0)))
