"""Alerts raised inside a stream: windows closed by the watermark, late rows, restarts, keys that fall silent."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from vitalmart import streaming as T

C = F.col
DAY = dt.datetime(2024, 5, 1)
SCHEMA = "user string, ts timestamp_ntz, kind string"


def at(hours):
    return DAY + dt.timedelta(hours=hours)


@pytest.fixture
def inbox(spark, tmp_path):
    """A folder that events are dropped into, and a clock's."""
    class Inbox:
        target = f"{tmp_path}/alerts"

        def send(self, rows, name="events"):
            schema = SCHEMA if name == "events" else "ts timestamp_ntz"
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/{name}")

        def stream(self):
            events = T.open_stream(spark, f"{tmp_path}/events", SCHEMA, event_time="ts")
            return T.with_heartbeat(events, T.open_stream(spark, f"{tmp_path}/clock", "ts timestamp_ntz"), "ts")

        def run(self, df):
            return T.run_append(df, self.target).finished()

    return Inbox()


def alerts(inbox):
    return T.sliding_alerts(inbox.stream(), "ts", "2 hours", "1 hour", C("kind") == "error", 50.0, 20.0, lateness="1 hour")


def rows_of(df):
    return sorted(((r["window_start"] - DAY).total_seconds() / 3600, r["events"], r["current_value"], r["alert_level"]) for r in df.collect())


def test_alerts_leave_the_stream_once_per_closed_window(spark, inbox):
    inbox.send([(at(0),)], "clock")
    inbox.send([("a", at(0.5), "error"), ("a", at(0.6), "view"), ("a", at(0.7), "view"), ("b", at(4.2), "view")])
    first = rows_of(inbox.run(alerts(inbox)))
    # the watermark stands at 3.2: windows up to [1, 3) are closed
    assert first == [(-1.0, 3, 33.3333, "Warning"), (0.0, 3, 33.3333, "Warning")]
    assert rows_of(inbox.run(alerts(inbox))) == first  # started again without news
    inbox.send([("c", at(0.8), "error"), ("c", at(3.5), "error"), ("c", at(3.6), "error")])  # too late, and in time
    inbox.send([(at(9),)], "clock")
    second = rows_of(inbox.run(alerts(inbox)))
    assert second == [*first, (2.0, 2, 100.0, "Critical"), (3.0, 3, 66.6667, "Critical")]
    assert rows_of(inbox.run(alerts(inbox))) == second


def test_windows_of_a_silent_source_are_closed_by_the_clock(spark, inbox):
    inbox.send([("a", at(0.5), "error")])
    inbox.send([(at(0),)], "clock")
    assert rows_of(inbox.run(alerts(inbox))) == []
    inbox.send([(at(5),)], "clock")
    assert rows_of(inbox.run(alerts(inbox))) == [(-1.0, 1, 100.0, "Critical"), (0.0, 1, 100.0, "Critical")]


def silent(inbox, limit=3600):
    df = T.silences(inbox.stream(), "user", "ts", limit, lateness="10 minutes")
    return sorted((r["key"], (r["silent_since"] - DAY).total_seconds() / 3600, r["events_before"]) for r in inbox.run(df).collect())


def test_a_key_that_sends_nothing_is_reported_without_a_row_of_its_own(spark, inbox):
    inbox.send([(at(0),)], "clock")
    inbox.send([("a", at(0), "view"), ("a", at(0.25), "view"), ("b", at(0.5), "view")])
    assert silent(inbox) == []
    inbox.send([("b", at(1.4), "view")])  # time goes on for b only; the watermark is not yet an hour past a
    assert silent(inbox) == []
    inbox.send([("b", at(2.0), "view")])
    assert silent(inbox) == [("a", 0.25, 2)]
    assert silent(inbox) == [("a", 0.25, 2)]  # told once, also after a restart
    inbox.send([("a", at(2.5), "view"), ("a", at(4.0), "view"), ("a", at(4.1), "view")])  # back, with a gap inside the batch
    assert silent(inbox) == [("a", 0.25, 2), ("a", 2.5, 3), ("b", 2.0, 3)]
    inbox.send([(at(9),)], "clock")
    assert silent(inbox) == [("a", 0.25, 2), ("a", 2.5, 3), ("a", 4.0 + 0.1, 5), ("b", 2.0, 3)]


def test_gaps_do_not_depend_on_batches_and_gaps_in_the_input_are_ignored(spark, inbox):
    inbox.send([(at(20),)], "clock")
    inbox.send([("a", at(3), "x"), ("a", at(0), "x"), (None, at(0), "x"), ("a", None, "x"), ("a", at(0.9), "x"), ("a", at(0.9), "x")])
    assert silent(inbox) == [("a", 0.9, 3), ("a", 3.0, 4)]
