"""Trailing means, change labels and numbering."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from vitalmart.functions.numeric import rnd
from vitalmart.sources.writers import staged


def trailing_mean(x: Column | str, order: str, rows: int, digits: int, by: list[str] | None = None) -> Column:
    """Mean of this and the previous rows-1 report rows (rows, not days)."""
    w = Window.partitionBy(*(by or [])).orderBy(order).rowsBetween(-(rows - 1), 0)
    return rnd(F.avg(x).over(w), digits)


def previous(x: Column | str, order: str, by: list[str] | None = None) -> Column:
    return F.lag(x).over(Window.partitionBy(*(by or [])).orderBy(order))


def trend_label(x: str, order: str, by: list[str] | None = None) -> Column:
    """Increasing / Decreasing / Stable against the previous report row."""
    before = previous(x, order, by)
    return (F.when(F.col(x) > before, F.lit("Increasing")).when(F.col(x) < before, F.lit("Decreasing"))
            .otherwise(F.lit("Stable")))


def fill_days(daily: DataFrame, day: str) -> DataFrame:
    """Add the missing days between first and last, so 7 rows are 7 days."""
    span = daily.agg(F.sequence(F.min(day), F.max(day)).alias("d")).select(F.explode("d").alias(day))
    return span.join(daily, day, "left")


def number_rows(df: DataFrame, by: list[str], order: list[str], out: str = "row_number") -> DataFrame:
    """1-based row number per ``by`` in the given order, of columns of any sortable type.

    Rows are dealt by ranges of (by, order, hash of the row), so one huge file, one day or one
    NULL is numbered by many tasks. The dealt rows are written once; the rows of a file
    before each range are then added to the numbers inside it. NULL comes first, NaN last; rows
    equal in all order columns follow their hash, so a retry numbers them alike.
    """
    tie = F.xxhash64(*df.columns)
    dealt = df.withColumn("_tie", tie).repartitionByRange(*by, *order, "_tie").withColumn("_part", F.spark_partition_id())
    dealt = staged(dealt, "numbered")
    # one row per file and range
    sizes = dealt.groupBy(*by, "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select(*[F.col(c).alias(f"_by_{c}") for c in by], F.col("_part").alias("_of_part"), (
        F.sum("_n").over(Window.partitionBy(*by).orderBy("_part")) - F.col("_n")).alias("_before"))
    inside = F.row_number().over(Window.partitionBy(*by, "_part").orderBy(*order, "_tie"))
    # NULL is a file of its own, so keys are compared NULL-safe
    same = [F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by] + [F.col("_part") == F.col("_of_part")]
    return (dealt.withColumn("_rn", inside).join(before, same)
            .withColumn(out, (F.col("_before") + F.col("_rn")).cast("bigint"))
            .select(*df.columns, out))


def series_windows(df: DataFrame, by: list[str], order: list[str], reach: int, columns: dict[str, Callable[[WindowSpec], Column]],
                   chunk: int = 100_000) -> DataFrame:
    """Window columns that look at most ``reach`` rows back, over series of any length.

    A plain window sorts a whole series in one task, and all rows if there is no ``by``. Here rows are numbered
    along the series (by ranges, see ``number_rows``) and cut into pieces of ``chunk`` rows; the last ``reach``
    rows of a piece also stand before the next one, where they are looked at and left out. Each entry
    of ``columns`` gets the window, ordered and cut so that ``lag`` and trailing frames are right.
    """
    if not 0 < reach <= chunk:
        raise ValueError("the rows looked back to must lie in the piece before")
    numbered = number_rows(df, by, order, "_nth")
    own = F.floor((F.col("_nth") - 1) / chunk)
    ahead = (F.col("_nth") - 1) % chunk >= chunk - reach
    copies = F.when(ahead, F.array(own, own + 1)).otherwise(F.array(own))
    window = Window.partitionBy(*by, "_piece").orderBy("_nth")
    rows = numbered.withColumn("_own", own).withColumn("_piece", F.explode(copies))
    return rows.withColumns({name: make(window) for name, make in columns.items()}).where("_piece = _own").select(*df.columns, *columns)


def trailing_mean_of(x: Column | str, rows: int, digits: int) -> Callable[[WindowSpec], Column]:
    return lambda w: rnd(F.avg(x).over(w.rowsBetween(-(rows - 1), 0)), digits)


def change_of(x: str) -> Callable[[WindowSpec], Column]:
    """Increasing / Decreasing / Stable against the row before."""
    def label(w: WindowSpec) -> Column:
        before = F.lag(x).over(w)
        return F.when(F.col(x) > before, F.lit("Increasing")).when(F.col(x) < before, F.lit("Decreasing")).otherwise(F.lit("Stable"))

    return label
