"""Streams over arriving Parquet files.

The same code runs once over what has arrived (availableNow) or continuously
(processingTime). Sinks are written per micro-batch with content that does not
depend on how often a batch is retried.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vitalmart.functions.bands import first_match
from vitalmart.functions.numeric import pct, rnd
from vitalmart.operators.aggregate import n, n_if
from vitalmart.operators.clean import out_of_bounds_to_null
from vitalmart.plans.incremental import upsert_partitions
from vitalmart.rules import clinical as R


def open_stream(spark: SparkSession, folder: str, schema, glob: str | None = None, files_per_batch: int | None = None,
                event_time: str | None = None) -> DataFrame:
    """File stream with a declared schema; event_time is cast to timestamp, which watermarks need."""
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    df = reader.parquet(folder)
    return df.withColumn(event_time, F.col(event_time).cast("timestamp")) if event_time else df


def tumbling(df: DataFrame, ts: str, every: str, measures: dict[str, Column], keys: list[str] = (), lateness: str = "1 hour",
             start: str | None = None) -> DataFrame:
    """Aggregates per fixed window; weekly windows that begin on Monday need start="4 days"."""
    window = F.window(ts, every, every, start) if start else F.window(ts, every)
    grouped = df.withWatermark(ts, lateness).groupBy(window.alias("w"), *keys)
    return grouped.agg(*[c.alias(m) for m, c in measures.items()]).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, *measures)


def daily(df: DataFrame, ts: str, measures: dict[str, Column], keys: list[str], lateness: str = "2 days") -> DataFrame:
    """Aggregates per day and keys; days older than the watermark leave the state."""
    return tumbling(df, ts, "1 day", measures, keys, lateness).select(
        F.col("window_start").cast("date").alias("day"), *keys, *measures)


def with_heartbeat(events: DataFrame, beats: DataFrame, ts: str) -> DataFrame:
    """Events and the time stamps of a clock as one stream, ``is_beat`` telling them apart.

    A watermark moves with what arrives, so windows of a source that fell silent would never close. Rows of
    ``beats`` (column ``ts``) move it; they count in no measure of ``counted``.
    """
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in events.schema if f.name != ts]
    beat = beats.select(F.col(ts).cast("timestamp").alias(ts), *empty, F.lit(True).alias("is_beat"))
    return events.withColumn("is_beat", F.lit(False)).unionByName(beat)


def counted(measures: dict[str, Column]) -> dict[str, Column]:
    """Count of the real rows of a stream with heartbeats, and the measures (which skip NULL)."""
    return {"events": n_if(~F.col("is_beat")), **measures}


def sliding_alerts(df: DataFrame, ts: str, size: str, slide: str, bad: Column, crit: float, warn: float, lateness: str = "1 hour",
                   digits: int = 4) -> DataFrame:
    """Alert level of the share of bad rows (percent) over overlapping windows, Normal ones left out.

    Windows are kept in the stream's state as two counts each. In append mode a window's alert goes out
    once, when the watermark closes the window; a restarted stream continues from its state and repeats none.
    Rows with ``is_beat`` (see ``with_heartbeat``) only move time.
    """
    real = ~F.col("is_beat") if "is_beat" in df.columns else F.lit(True)
    slid = df.withWatermark(ts, lateness).groupBy(F.window(ts, size, slide).alias("w")).agg(
        n_if(real).alias("events"), n_if(real & bad).alias("_bad"))
    found = slid.where(F.col("events") > 0).withColumn("current_value", pct("_bad", "events", digits))
    v = F.col("current_value")
    level = first_match([(v > crit, "Critical"), (v > warn, "Warning")], "Normal")
    return found.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "events", "current_value",
                        level.alias("alert_level")).where(F.col("alert_level") != "Normal")


def clean_stream(df: DataFrame, key: str, ts: str, bounds: dict, lateness: str = "1 hour") -> DataFrame:
    """Range cleaning of arriving rows; a key seen again within the lateness is dropped."""
    return out_of_bounds_to_null(df.withWatermark(ts, lateness).dropDuplicatesWithinWatermark([key]), bounds)


def freshness(df: DataFrame, ts: str, as_of: Column, keys: list[str] = ()) -> DataFrame:
    """Newest event per key and its lag behind as_of in seconds."""
    newest = df.groupBy(*keys).agg(F.max(ts).alias("newest"))
    lag = F.unix_micros(as_of.cast("timestamp")) - F.unix_micros("newest")
    return newest.select(*keys, "newest", rnd(lag / F.lit(1e6), 3).alias("lag_seconds"))


# ---- running ---------------------------------------------------------------
@dataclass
class Run:
    """A started stream and its sink. The same target and checkpoint, given again, resume it."""

    query: StreamingQuery
    read: Callable[[], DataFrame]

    def finished(self) -> DataFrame:
        """Wait for the end of the stream (availableNow, or stopped elsewhere) and read the sink."""
        self.query.awaitTermination()
        return self.read()

    def stop(self) -> DataFrame:
        """Stop between or within batches; a batch cut off is run again on resuming."""
        self.query.stop()
        return self.read()


def _start(writer, target: str, checkpoint: str | None, every: str | None, read: Callable[[], DataFrame]) -> Run:
    writer = writer.option("checkpointLocation", checkpoint or f"{target.rstrip('/')}-checkpoint")
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return Run(writer.start(), read)


def _prepared(df: DataFrame, target: str, partition_by: list[str] = ()) -> Callable[[], DataFrame]:
    """Make the sink if it is not there yet, so that it can be read before the first batch."""
    spark, schema = df.sparkSession, df.schema
    empty = spark.createDataFrame([], schema).write.mode("ignore")
    (empty.partitionBy(*partition_by) if partition_by else empty).parquet(target)
    return lambda: spark.read.schema(schema).parquet(target).select(*schema.names)


def run_append(df: DataFrame, target: str, checkpoint: str | None = None, every: str | None = None) -> Run:
    """Rows added to a Parquet folder, each batch exactly once."""
    read = lambda: df.sparkSession.read.schema(df.schema).parquet(target)
    writer = df.writeStream.format("parquet").option("path", target).outputMode("append")
    return _start(writer, target, checkpoint, every, read)


def run_complete(df: DataFrame, target: str, checkpoint: str | None = None, every: str | None = None) -> Run:
    """The whole result replaced by each batch: for results of a few rows without event time."""
    read = _prepared(df, target)

    def replace(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").parquet(target)

    return _start(df.writeStream.foreachBatch(replace).outputMode("complete"), target, checkpoint, every, read)


def run_upsert(df: DataFrame, target: str, keys: list[str], partition_by: list[str], checkpoint: str | None = None,
               every: str | None = None) -> Run:
    """Changed totals of a stateful aggregate upserted by key.

    The state holds running totals, so a batch writes final values for its keys and repeating it
    changes nothing. Only the partitions a batch touches are read and rewritten; old versions
    of them are not kept.
    """
    read = _prepared(df, target, partition_by)

    def merge(batch: DataFrame, _: int) -> None:
        kept = batch.persist()  # read three times: touched partitions, untouched rows, new rows
        try:
            upsert_partitions(kept, target, keys, partition_by, df.schema)
        finally:
            kept.unpersist()

    return _start(df.writeStream.foreachBatch(merge).outputMode("update"), target, checkpoint, every, read)


def run_metrics_collection(df: DataFrame, target: str, collect: Callable[[DataFrame], DataFrame], schema: str,
                           checkpoint: str | None = None, every: str | None = None) -> Run:
    """Metric rows of each batch, kept under the batch's own partition (a retry overwrites it)."""
    spark = df.sparkSession
    spark.createDataFrame([], f"{schema}, batch_id bigint").write.mode("ignore").partitionBy("batch_id").parquet(target)

    def write(batch: DataFrame, batch_id: int) -> None:
        collect(batch).write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")

    read = lambda: spark.read.schema(f"{schema}, batch_id bigint").parquet(target)
    return _start(df.writeStream.foreachBatch(write), target, checkpoint, every, read)


# Measures of the event stream used by the registered streams
def event_measures() -> dict[str, Column]:
    return {"events": n(), "errors": n_if(F.col("event_type") == "error"), "avg_value": rnd(F.avg("value"), 6)}


# for windows closed by heartbeats, which have no event type
def closed_measures() -> dict[str, Column]:
    return counted({"errors": n_if(F.col("event_type") == "error"), "avg_value": rnd(F.avg("value"), 6)})


PRESSURE_LIMITS = {"value": R.Bounds(1, 200, False)}
