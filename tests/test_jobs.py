"""Long series in pieces, key stores, retention by partitions, jobs that resume."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from vitalmart.operators import windows as W
from vitalmart.plans import incremental, retention, runner
from vitalmart.sources.keystore import KeyStore
from vitalmart.sources.writers import scratch_name

C = F.col


# ---- long series -----------------------------------------------------------
@pytest.mark.parametrize("chunk", [6, 7, 50, 10_000])
def test_series_in_pieces_equal_a_plain_window(spark, chunk):
    rng = random.Random(chunk)
    rows = [(rng.choice(["a", "a", "a", "b", None]), i, rng.choice([None, 1.0 * rng.randrange(9)])) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, i int, v double")
    for by in ([], ["g"]):
        got = W.series_windows(df, by, ["i"], 6, {"ma": W.trailing_mean_of("v", 7, 6), "prev": lambda w: F.lag("v", 3).over(w), "trend": W.change_of("v")}, chunk)
        want = df.withColumns({"ma": W.trailing_mean("v", "i", 7, 6, by), "prev": F.lag("v", 3).over(W.Window.partitionBy(*by).orderBy("i")),
                               "trend": W.trend_label("v", "i", by)})
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_one_series_keeps_several_tasks_busy(spark):
    df = spark.range(40_000).select("id", (C("id") * 7 % 11).cast("double").alias("v"))
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = W.series_windows(df, [], ["id"], 6, {"ma": W.trailing_mean_of("v", 7, 4)}, 2_000)
        sizes = [r["n"] for r in out.groupBy(F.spark_partition_id().alias("p")).agg(F.count("ma").alias("n")).collect()]
        assert sum(sizes) == 40_000 and len(sizes) > 4 and max(sizes) <= 20_000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    with pytest.raises(ValueError, match="piece before"):
        W.series_windows(df, [], ["id"], 6, {}, 5)


# ---- key stores ------------------------------------------------------------
def test_the_keys_of_the_target_stay_where_they_lie(spark, tmp_path):
    store = KeyStore(spark, scratch_name("keys"), "k", 8, f"{tmp_path}/keys")
    rows = spark.createDataFrame([(i % 40, i) for i in range(60)] + [(None, 1)], "id bigint, v int")
    assert store.unseen(rows, "id").count() == 60  # an empty store has seen nothing; NULL is never new
    store.add(spark.range(30))
    store.add(spark.range(20, 35))
    assert spark.table(store.table).count() == 35
    fresh = store.unseen(rows, "id")
    assert sorted(r["id"] for r in fresh.collect()) == [35, 36, 37, 38, 39]
    plan = fresh._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    target = plan[plan.index("SortMergeJoin"):].split("Exchange hashpartitioning(id")[1]
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in target  # the one exchange is the source's
    store.drop()


def test_loads_through_a_store_insert_nothing_twice(spark, tmp_path):
    store, path = KeyStore(spark, scratch_name("keys"), "id", 8, f"{tmp_path}/keys"), f"{tmp_path}/target"
    for n in (10, 25, 25):
        incremental.append_new(spark.range(n), path, "id", store=store)
    assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == list(range(25))
    store.drop()


# ---- retention -------------------------------------------------------------
def files(path):
    return {os.path.join(at, f): os.stat(os.path.join(at, f)).st_mtime_ns for at, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def test_old_periods_leave_as_folders_and_kept_files_stay(spark, tmp_path):
    days = [dt.date(2024, 1, 1) + dt.timedelta(i) for i in range(0, 150, 3)]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(days)] + [(-1, None)], "id int, d date")
    table, path, archive = scratch_name("kept"), f"{tmp_path}/t", f"{tmp_path}/a"
    retention.create_by_period(df, table, "d", "month", path)
    assert retention.periods_of(spark, table) == [dt.date(2024, m, 1) for m in range(1, 6)]
    before = files(path)
    for n in range(2):  # the second run finds nothing left to do
        done = retention.expire(spark, table, "d", dt.date(2024, 4, 20), 30, "month", archive)  # cut: March 21
        assert done == ({"dropped": 2, "rewritten": 1} if n == 0 else {"dropped": 0, "rewritten": 0})
        kept = {i for i, d in enumerate(days) if d >= dt.date(2024, 3, 21)}
        assert {r["id"] for r in spark.table(table).collect()} == kept | {-1}
        assert {r["id"] for r in spark.read.parquet(path).collect()} == kept | {-1}
        assert sorted(r["id"] for r in retention.archived(spark, archive, ["id"]).collect()) == sorted(set(range(len(days))) - kept)
    after = files(path)
    same = {f for f in before if not any(m in f for m in ("2024-01", "2024-02", "2024-03"))}
    assert {f: after[f] for f in same} == {f: before[f] for f in same} and not any("2024-02" in f for f in after)
    retention.expire(spark, table, "d", dt.date(2024, 6, 30), 40, "month", archive)  # cut: May 21, in the last period
    assert {r["id"] for r in spark.table(table).collect()} == {i for i, d in enumerate(days) if d >= dt.date(2024, 5, 21)} | {-1}
    assert retention.archived(spark, archive, ["id"]).count() + spark.table(table).count() == len(days) + 1
    retention.expire(spark, table, "d", dt.date(2025, 6, 30), 1, "month")  # without archive
    assert [r["id"] for r in spark.table(table).collect()] == [-1]
    spark.sql(f"DROP TABLE {table}")


def test_a_cut_period_without_young_rows_is_dropped(spark, tmp_path):
    table = scratch_name("kept")
    retention.create_by_period(spark.createDataFrame([(1, dt.date(2024, 1, 2)), (2, dt.date(2024, 2, 9))], "id int, d date"), table, "d", "month", f"{tmp_path}/t")
    assert retention.expire(spark, table, "d", dt.date(2024, 1, 20), 1, "month") == {"dropped": 1, "rewritten": 1}
    assert [r["id"] for r in spark.table(table).collect()] == [2]
    spark.sql(f"DROP TABLE {table}")
    with pytest.raises(ValueError, match="unit"):
        retention.create_by_period(spark.range(1), table, "id", "decade", f"{tmp_path}/u")


def test_a_period_is_rewritten_in_a_session_with_static_overwrite(spark, tmp_path):
    table, mode = scratch_name("kept"), "spark.sql.sources.partitionOverwriteMode"
    retention.create_by_period(spark.createDataFrame([(i, dt.date(2024, 1 + i // 20, 1 + i % 20)) for i in range(40)], "id int, d date"),
                               table, "d", "month", f"{tmp_path}/t")
    before = spark.conf.get(mode)
    spark.conf.set(mode, "static")
    try:
        assert retention.expire(spark, table, "d", dt.date(2024, 1, 11), 0, "month", f"{tmp_path}/a") == {"dropped": 0, "rewritten": 1}
    finally:
        spark.conf.set(mode, before)
    assert sorted(r["id"] for r in spark.table(table).collect()) == list(range(10, 40))
    assert sorted(r["id"] for r in retention.archived(spark, f"{tmp_path}/a", ["id"]).collect()) == list(range(10))
    spark.sql(f"DROP TABLE {table}")


# ---- jobs ------------------------------------------------------------------
def test_finished_stages_are_not_computed_again(spark, tmp_path):
    calls, broken, ticks = [], [True], iter(range(100))

    def stage(name, make):
        def run(done):
            calls.append(name)
            return make(done)

        return name, run

    def middle(done):
        if broken:
            raise ValueError("disk is full\nmore text")
        return done["a"].where("id > 2")

    job = runner.Job(spark, str(tmp_path), "j", [stage("a", lambda _: spark.range(10)), stage("b", middle), stage("c", lambda d: d["b"].unionAll(d["a"]))],
                     lambda: dt.datetime(2024, 1, 1) + dt.timedelta(minutes=next(ticks)))
    with pytest.raises(ValueError, match="disk is full"):
        job.run("x")
    assert calls == ["a", "b"] and job.finished("x") == {"a"}
    states = {r["pipeline_stage"]: r for r in incremental.run_states(job.log()).collect()}
    assert states["b"]["status"] == "failed" and states["b"]["error_message"] == "ValueError: disk is full" and states["b"]["duration_seconds"] == 60
    assert (states["a"]["status"], states["a"]["records_processed"]) == ("completed", 10)
    broken.clear()
    assert job.run("x").count() == 17 and calls == ["a", "b", "b", "c"]
    assert job.run("x").count() == 17 and calls == ["a", "b", "b", "c"]  # nothing left to do
    assert job.run("y").count() == 17 and calls[4:] == ["a", "b", "c"]  # another execution shares nothing
    states = {(r["execution_id"], r["pipeline_stage"]): r["status"] for r in incremental.run_states(job.log()).collect()}
    assert set(states.values()) == {"completed"} and len(states) == 6
