"""T*: streams over the event files; each result equals the batch SQL."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from vitalmart import streaming as T
from vitalmart.functions.numeric import rnd
from vitalmart.operators.aggregate import mean, metric_rows, n, n_if
from vitalmart.sources.writers import scratch_path
from vitalmart.streaming.jobs import PRESSURE_LIMITS, closed_measures, event_measures

from . import sql as S
from .base import query

C = F.col
STAMP = "yyyy-MM-dd HH:mm:ss"


def _events(t):
    return T.open_stream(t.spark, t.dir, t.events.schema, "events.parquet", event_time="ts")


def _text(df, *cols):
    return df.withColumns({c: F.date_format(c, STAMP) for c in cols})


def _window(unit: str) -> str:
    return f"date_trunc('{unit}', ts)"


def _tumbling_sql(unit: str, span: str) -> str:
    return S.report({"window_start": f"strftime({_window(unit)}, '%Y-%m-%d %H:%M:%S')",
                     "window_end": f"strftime({_window(unit)} + INTERVAL {span}, '%Y-%m-%d %H:%M:%S')"}, {
        "events": S.cnt(), "errors": S.cnt("event_type = 'error'"), "avg_value": S.avg("value", 6)}, "events")


def _target(t, name):
    return scratch_path(t.spark, name)


def _with_end(t, after):
    """The event stream and a clock that stands ``after`` the newest event, so that every window closes."""
    path = _target(t, "clock")
    t.events.agg((F.max("ts").cast("timestamp") + after).alias("ts")).write.parquet(path)
    return T.with_heartbeat(_events(t), T.open_stream(t.spark, path, "ts timestamp"), "ts")


def _windows(t, every, name, start=None):
    """Windows appended once, when the watermark closes them."""
    windows = T.tumbling(_with_end(t, F.make_dt_interval(days=F.lit(9))), "ts", every, closed_measures(), start=start)
    run = T.run_append(windows.where("events > 0"), _target(t, name))
    return _text(run.finished(), "window_start", "window_end")


@query("t1_tumbling_hourly", _tumbling_sql("hour", "1 HOUR"))
def _(t):
    return _windows(t, "1 hour", "t1-hour")


@query("t1_tumbling_daily", _tumbling_sql("day", "1 DAY"))
def _(t):
    return _windows(t, "1 day", "t1-day")


@query("t1_tumbling_weekly", _tumbling_sql("week", "7 DAY"))
def _(t):
    return _windows(t, "7 days", "t1-week", start="4 days")


@query("t1_tumbling_hourly_upserted", _tumbling_sql("hour", "1 HOUR"))
def _(t):
    """Windows that may still change, upserted in partitions by day."""
    windows = T.tumbling(_events(t), "ts", "1 hour", event_measures()).withColumn("day", C("window_start").cast("date"))
    run = T.run_upsert(windows, _target(t, "t1-upsert"), ["day", "window_start"], ["day"])
    return _text(run.finished().drop("day"), "window_start", "window_end")


@query("t2_sliding_alerts", "WITH x AS (SELECT ts, event_type, unnest(range(24)) AS back FROM events), w AS (SELECT date_trunc('hour', ts) -"
       " to_hours(CAST(back AS INTEGER)) AS s, event_type FROM x), a AS (SELECT s, COUNT(*) AS events, " + S.rate("event_type = 'error'", 4)
       + " AS current_value FROM w GROUP BY s) SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS window_start, strftime(s + INTERVAL 24 HOUR,"
       " '%Y-%m-%d %H:%M:%S') AS window_end, events, current_value, CASE WHEN current_value > 22 THEN 'Critical' ELSE 'Warning' END AS alert_level"
       " FROM a WHERE current_value > 20")
def _(t):
    """Windows, rates and levels are made in the stream; the sink holds the alerts."""
    alerts = T.sliding_alerts(_with_end(t, F.make_dt_interval(days=F.lit(2))), "ts", "24 hours", "1 hour", C("event_type") == "error", 22.0, 20.0)
    return _text(T.run_append(alerts, _target(t, "t2")).finished(), "window_start", "window_end")


@query("t3_metrics_collection", "SELECT 'events' AS metric_name, CAST(COUNT(*) AS DOUBLE) AS metric_value FROM events UNION ALL SELECT 'avg_value', "
       + S.avg("value", 6) + " FROM events UNION ALL SELECT 'errors', CAST(" + S.cnt("event_type = 'error'") + " AS DOUBLE) FROM events")
def _(t):
    collect = lambda batch: metric_rows(batch, {"events": n(), "avg_value": mean("value", 6),
                                                "errors": n_if(C("event_type") == "error")})
    run = T.run_metrics_collection(_events(t), _target(t, "t3"), collect, "metric_name string, metric_value double")
    return run.finished().select("metric_name", "metric_value")


@query("t4_streaming_cleaning", "SELECT event_id, event_type, CASE WHEN value >= 1 AND value <= 200 THEN value END AS value FROM events")
def _(t):
    """Every event arrives twice; the copy is dropped inside the watermark."""
    twice = _events(t).unionByName(_events(t))
    return T.run_append(T.clean_stream(twice, "event_id", "ts", PRESSURE_LIMITS), _target(t, "t4")).finished().select(
        "event_id", "event_type", "value")


@query("t5_streaming_upsert", "SELECT CAST(ts AS DATE) AS day, event_type, COUNT(*) AS events, " + S.r("SUM(value)", 4) + " AS total FROM events GROUP BY ALL")
def _(t):
    totals = T.daily(_events(t), "ts", {"events": n(), "total": rnd(F.sum("value"), 4)}, ["event_type"])
    return T.run_upsert(totals, _target(t, "t5"), ["day", "event_type"], ["day"]).finished()


@query("t6_freshness_and_lag", "SELECT event_type, strftime(MAX(ts), '%Y-%m-%d %H:%M:%S') AS newest, " + S.r(
    "(epoch_us(TIMESTAMP '2024-02-01 00:00:00') - epoch_us(MAX(ts))) / 1e6", 3) + " AS lag_seconds FROM events GROUP BY event_type")
def _(t):
    now = F.lit(dt.datetime(2024, 2, 1)).cast("timestamp_ntz")
    return _text(T.run_complete(T.freshness(_events(t), "ts", now, ["event_type"]), _target(t, "t6")).finished(), "newest")


_SILENT = 6 * 3600


@query("t6_silence_alerts", "WITH e AS (SELECT CAST(user_id AS VARCHAR) AS key, ts, COUNT(*) OVER (PARTITION BY user_id ORDER BY ts) AS events_before,"
       " LEAD(ts) OVER (PARTITION BY user_id ORDER BY ts) AS next FROM events) SELECT key, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS silent_since,"
       f" events_before FROM e WHERE next IS NULL OR epoch_us(next) - epoch_us(ts) > {_SILENT * 1_000_000}")
def _(t):
    """Users without an event for six hours; nobody sends any after the end, which only the clock tells."""
    alerts = T.silences(_with_end(t, F.make_dt_interval(days=F.lit(2))), "user_id", "ts", _SILENT)
    out = T.run_append(alerts, _target(t, "t6-silence")).finished()
    return out.withColumn("silent_since", F.date_format("silent_since", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
