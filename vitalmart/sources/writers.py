"""Sinks. None gathers data to one task except the one-row reports."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalmart.session import ensure_checkpoint_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """Fresh path below the shared checkpoint folder, for written intermediate tables."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/vitalmart/{name}-{uuid.uuid4().hex[:12]}"


def scratch_name(name: str) -> str:
    """Fresh name for a catalog table."""
    return f"{name}_{uuid.uuid4().hex[:12]}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """df written below the shared checkpoint folder and read back: a step others read several times."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def held(df: DataFrame, name: str, most: int) -> DataFrame:
    """A result computed once: kept by the driver up to ``most`` rows, else written like ``staged``.

    For small tables steered by (cut points, thresholds, wanted buckets), where a file costs more than the rows.
    """
    rows = df.limit(most + 1).toArrow()
    if rows.num_rows > most:
        return staged(df, name)
    return df.sparkSession.createDataFrame(rows, schema=df.schema)


def write_bronze(df: DataFrame, parquet_path: str, csv_path: str | None = None) -> None:
    df.write.mode("overwrite").parquet(parquet_path)
    if csv_path:
        df.write.mode("overwrite").option("header", True).csv(csv_path)


def write_partitioned(df: DataFrame, path: str, partition_by: list[str], rows_per_file: int | None = 5_000_000) -> None:
    """Overwrite the partitions present in df.

    Rows are not gathered per partition value: one value can hold a third of the
    table. Tasks write their own files, and file size is bounded by row count.
    """
    writer = df.write.mode("overwrite").partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.parquet(path)


def append(df: DataFrame, path: str, partition_by: list[str] = ()) -> None:
    writer = df.write.mode("append")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_jdbc(df: DataFrame, url: str, table: str, batch: int = 10_000, **options: str) -> None:
    df.write.format("jdbc").option("url", url).option("dbtable", table).option("batchsize", batch).options(
        **options).mode("append").save()


def write_bucketed(df: DataFrame, table: str, keys: list[str], buckets: int) -> DataFrame:
    """Bucketed and sorted catalog table, read back: joins and groupings on the keys need no
    shuffle when both sides have the same number of buckets."""
    writer = df.write.mode("overwrite").format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
    writer.option("path", scratch_path(df.sparkSession, table)).saveAsTable(table)
    return df.sparkSession.table(table)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def report_document(sets: dict[str, DataFrame], at: Column, most: int = 100_000) -> DataFrame:
    """Several small result sets as one JSON document (a one-row table).

    The sets are reports (one row per group). One of more than ``most`` rows is no report and an error:
    ``write_json`` writes it as lines.
    """
    cells = {}
    for name, df in sets.items():
        if df.limit(most + 1).count() > most:
            raise ValueError(f"{name} has more than {most} rows, too many for one document: take write_json")
        cells[name] = df.agg(F.array_sort(F.collect_list(F.struct(*df.columns))).alias("rows")).scalar()
    spark = next(iter(sets.values())).sparkSession
    one = spark.range(1).select(*[c.alias(n) for n, c in cells.items()], at.cast("string").alias("timestamp"))
    return one.select(F.to_json(F.struct(*one.columns)).alias("value"))


def write_text_report(document: DataFrame, path: str) -> None:
    """One-row text table; the only place a single output file is wanted."""
    document.select("value").coalesce(1).write.mode("overwrite").text(path)


def ingest_metadata(df: DataFrame, dataset: str, source: str, target: str, at: Column) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(dataset).alias("dataset_name"), at.alias("ingestion_timestamp"), "row_count",
        F.lit(len(df.columns)).cast("bigint").alias("column_count"), F.lit(",".join(df.columns)).alias("columns"),
        F.lit(source).alias("source_path"), F.lit(target).alias("target_path"))


def add_lineage(df: DataFrame, at: Column, dataset: str, version: str = "1.0") -> DataFrame:
    return df.withColumns({"ingestion_timestamp": at, "dataset_name": F.lit(dataset), "data_source": F.lit(dataset),
                           "ingestion_version": F.lit(version)})
