"""Incremental loads, upserts, retention and run logs on plain Parquet.

Parquet has no row-level MERGE. Tables partitioned by (part of) their key are
changed with dynamic partition overwrite, which stages the new files and swaps
only the partitions written; anything else is written to a new path that the
caller switches to. One writer per table is assumed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitalmart.functions.bands import recode
from vitalmart.functions.numeric import rnd
from vitalmart.operators.aggregate import metric_rows, n, n_if, rate, report, text_number
from vitalmart.operators.joins import new_rows
from vitalmart.sources.keystore import KeyStore
from vitalmart.sources.writers import staged


def newest_per_key(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One row per key, the one with the largest ``order``; partial aggregation runs map-side."""
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(order, *[c for c in rest if c != order])).alias("_r")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col("_r").getField(c).alias(c) for c in rest]).select(*df.columns)


def one_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """df unchanged; the job fails if a key has several rows."""
    rows = df.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*keys)))
    alone = F.assert_true(F.col("_n") == 1, F.lit(f"several changes of one key ({', '.join(keys)}): name their order"))
    return rows.where(alone.isNull()).drop("_n")


def upsert(target: DataFrame, changes: DataFrame, keys: list[str], order: str | None = None) -> DataFrame:
    """Target with changed rows replaced and new rows added.

    Of several changes of one key the one with the largest ``order`` counts; without an
    order such changes are an error, as none of them is the right one.
    """
    changes = newest_per_key(changes, keys, order) if order else one_per_key(changes, keys)
    untouched = target.join(changes.select(*keys), keys, "left_anti")
    return untouched.unionByName(changes.select(*target.columns))


def insert_ignore(target: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Target plus the rows whose key it lacks; of new rows with one key the smallest counts,
    column by column, so a retry keeps the same."""
    rest = [c for c in rows.columns if c not in keys]
    first = rows.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_r")).select(*keys, *[F.col("_r")[c].alias(c) for c in rest]) if rest \
        else rows.distinct()
    fresh = first.join(target.select(*keys).distinct(), keys, "left_anti")
    return target.unionByName(fresh.select(*target.columns))


def append_new(source: DataFrame, target_path: str, key: str, partition_by: list[str] = (), store: KeyStore | None = None) -> None:
    """Insert rows with unseen keys into the Parquet table at target_path.

    With a ``store`` of the target's keys the target is not read: the store answers which rows are new, and
    learns their keys when they are inserted. After a run that ended between the two, add the target's keys to
    the store before the next load.
    """
    spark = source.sparkSession
    fresh = store.unseen(source, key) if store else new_rows(source, spark.read.parquet(target_path), key)
    if store:
        fresh = staged(fresh, "fresh-rows")  # written to the target and asked for its keys
    writer = fresh.write.mode("append")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(target_path)
    if store:
        store.add(fresh.select(key))


def upsert_partitions(changes: DataFrame, target_path: str, keys: list[str], partition_by: list[str], schema=None) -> None:
    """Upsert into a Parquet table partitioned by part of its key.

    Reads only the partitions the changes touch (a semi-join Spark turns into
    partition pruning) and rewrites only those. ``schema`` is that of a table that may
    still be empty.
    """
    if not set(partition_by) <= set(keys):
        raise ValueError("partition columns must be part of the key, or a changed row could stay in two partitions")
    spark = changes.sparkSession
    old = (spark.read.schema(schema) if schema else spark.read).parquet(target_path)
    if old.inputFiles():
        touched = changes.select(*partition_by).distinct()
        merged = upsert(old.join(touched, partition_by, "left_semi"), changes, keys)
    else:
        merged = one_per_key(changes, keys)  # nothing to merge with
    # one file per partition rather than one per task; adaptive execution splits a large one
    merged.hint("rebalance", *partition_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(target_path)


def rebuild_partitions(rows: DataFrame, target_path: str, partition_by: list[str]) -> None:
    """Delete-and-insert of whole partitions (for example one report day)."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(target_path)


def retain(df: DataFrame, time_col: str, as_of: Column, days: int) -> DataFrame:
    """Rows not older than ``days``; on a partitioned table this prunes partitions."""
    return df.where(F.col(time_col) >= F.date_sub(as_of, days))


def archive_split(df: DataFrame, time_col: str, as_of: Column, days: int) -> tuple[DataFrame, DataFrame]:
    old = F.col(time_col) < F.date_sub(as_of, days)
    return df.where(~old), df.where(old)


# ---- run log ---------------------------------------------------------------
def run_states(events: DataFrame) -> DataFrame:
    """Current state per execution from the append-only event log."""
    seen, done = F.col("event_time"), F.col("status").isin("completed", "failed")
    last = F.max_by(F.struct("status", "records_processed", "error_message"), "event_time").alias("_last")
    return events.groupBy("execution_id", "pipeline_name", "pipeline_stage").agg(
        F.min(seen).alias("start_time"), F.max(F.when(done, seen)).alias("end_time"), last).select(
        "execution_id", "pipeline_name", "pipeline_stage", "start_time", "end_time", "_last.*").withColumn(
        "duration_seconds", (F.unix_micros(F.col("end_time").cast("timestamp"))
                             - F.unix_micros(F.col("start_time").cast("timestamp"))) / F.lit(1e6))


def pipeline_statistics(log: DataFrame, success: str = "completed", failure: str = "failed") -> DataFrame:
    """Per pipeline: runs, successes, failures, records, mean seconds, last start, success rate."""
    ok = F.col("status") == success
    return report(log, ["pipeline_name"], {
        "total_executions": n(), "successful_executions": n_if(ok), "failed_executions": n_if(F.col("status") == failure),
        "total_records_processed": F.sum(F.coalesce("records_processed", F.lit(0))),
        "average_processing_seconds": rnd(F.avg("duration_seconds"), 6),
        "last_execution_time": F.date_format(F.max("start_time"), "yyyy-MM-dd HH:mm:ss"),
        "success_rate": rate(ok, 2)}).orderBy(F.col("last_execution_time").desc())


def layer_statistics(layers: list[tuple[str, str, DataFrame, str, str | None]]) -> DataFrame:
    """(layer, table, rows, newest time stamp, mean quality) per layer table."""
    parts = [df.agg(n().alias("record_count"), F.date_format(F.max(t), "yyyy-MM-dd HH:mm:ss").alias("latest_update"),
                    (rnd(F.avg(q), 3) if q else F.lit(None).cast("double")).alias("data_quality_avg"))
             .select(F.lit(layer).alias("layer_name"), F.lit(table).alias("table_name"), "record_count", "latest_update",
                     "data_quality_avg") for layer, table, df, t, q in layers]
    return reduce(DataFrame.unionByName, parts)


def metric_snapshot(gold: DataFrame) -> DataFrame:
    """Long latest-metrics rows, every metric out of one pass."""
    high = F.col("health_risk_level").isin("High", "Critical")
    sick = F.col("diabetes") == 1
    kinds = {"total_patients": "count", "diabetic_patients": "count", "high_risk_patients": "count",
             "avg_glucose": "average", "avg_bmi": "average", "diabetes_rate": "percentage", "high_risk_rate": "percentage"}
    rows = metric_rows(gold, {
        "total_patients": n(), "diabetic_patients": n_if(sick), "high_risk_patients": n_if(high),
        "avg_glucose": text_number(F.avg("glucose"), 1), "avg_bmi": text_number(F.avg("bmi"), 1),
        "diabetes_rate": text_number(n_if(sick) * 100.0 / n(), 1), "high_risk_rate": text_number(n_if(high) * 100.0 / n(), 1)},
        as_text=True)
    return rows.withColumn("metric_type", recode("metric_name", kinds))
