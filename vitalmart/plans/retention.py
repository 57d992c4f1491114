"""Retention by partitions: old periods leave a table as whole folders.

The table is a catalog table partitioned by the first day of a period. Periods that end before the cut are
archived and dropped without reading the others; only the period the cut falls in is rewritten, and only if it
holds older rows. Every step can be repeated: the archive keeps the rows of each cut in partitions of its
own, which a repeated run replaces before anything is dropped.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_STEPS = {"day": lambda d: d + dt.timedelta(1), "month": lambda d: (d.replace(day=28) + dt.timedelta(4)).replace(day=1),
          "year": lambda d: d.replace(year=d.year + 1)}


def create_by_period(df: DataFrame, table: str, time_col: str, unit: str, path: str, period: str = "period") -> None:
    """df as catalog table at path, partitioned by the first day of the unit (day, month, year) of ``time_col``."""
    if unit not in _STEPS:
        raise ValueError(f"unit must be one of {', '.join(_STEPS)}")
    rows = df.withColumn(period, F.date_trunc(unit, F.col(time_col)).cast("date"))
    rows.hint("rebalance", period).write.partitionBy(period).option("path", path).saveAsTable(table)


def periods_of(spark: SparkSession, table: str, period: str = "period") -> list[dt.date]:
    """First days of the table's periods, from the catalog; rows without time are in none."""
    names = (r[0].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {table}").collect())
    return sorted(dt.date.fromisoformat(n) for n in names if n != "__HIVE_DEFAULT_PARTITION__")


def _remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder wherever the table lies (an external table keeps the files of a dropped partition)."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def expire(spark: SparkSession, table: str, time_col: str, as_of: dt.date, days: int, unit: str, archive: str | None = None,
           period: str = "period") -> dict[str, int]:
    """Remove rows older than ``days`` before ``as_of``; with ``archive``, a path, they are kept there.

    Returns the number of periods dropped and rewritten. Rows without time stay.
    """
    cut = as_of - dt.timedelta(days)
    before = [p for p in periods_of(spark, table, period) if p < cut]
    whole = [p for p in before if _STEPS[unit](p) <= cut]
    edge = [p for p in before if p not in whole]
    rows = spark.table(table)
    old = F.col(time_col) < F.lit(cut)
    expired = rows.where(F.col(period).isin(whole) | (F.col(period).isin(edge) & old))
    if archive and before:
        # rows of a period may leave at several cuts; those of one cut are replaced as a whole
        (expired.withColumn("cut", F.lit(cut)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("cut", period).parquet(archive))
    rewritten = [p for p in edge if not rows.where((F.col(period) == F.lit(p)) & old).isEmpty()]
    about = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    location, provider = about["Location"], about["Provider"]
    for p in rewritten:
        kept = rows.where((F.col(period) == F.lit(p)) & ~F.coalesce(old, F.lit(False)))
        # by path, not insertInto: that minds the writer's option only in a session set to dynamic
        kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(period).format(provider).save(location)
        spark.catalog.refreshTable(table)
        if spark.table(table).where((F.col(period) == F.lit(p)) & old).head(1):  # every row was old: nothing was written over it
            whole = [*whole, p]
    for p in whole:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({period} = DATE '{p}')")
        _remove(spark, f"{location}/{period}={p}")
    spark.catalog.refreshTable(table)
    return {"dropped": len(whole), "rewritten": len(rewritten)}


def archived(spark: SparkSession, archive: str, columns: list[str]) -> DataFrame:
    """All rows that ever left, from every cut."""
    return spark.read.parquet(archive).select(*columns)
