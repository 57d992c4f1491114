"""Sources, sinks, incremental loads, streams and models."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from vitalmart import streaming as T
from vitalmart.ml import evaluation as E
from vitalmart.ml import training as M
from vitalmart.operators import windows
from vitalmart.operators.aggregate import confusion_counts, n
from vitalmart.plans import incremental as I
from vitalmart.plans import jobs, reports
from vitalmart.registry import QUERIES
from vitalmart.registry.base import Tables
from vitalmart.sources import readers, versions, writers

C = F.col
DATA = "/root/testdata/sf0.001"


# ---- sources ---------------------------------------------------------------
def test_unknown_format_is_refused(spark):
    with pytest.raises(ValueError):
        readers.read_table(spark, "/data/file.xlsx")


def test_files_are_routed_by_name():
    got = readers.route_files(["/a/Diabetes.csv", "/b/personal_health_2.csv", "/c/readme.md"],
                              {"*diabetes*": "clinical", "personal_health*": "personal"})
    assert got == {"clinical": ["/a/Diabetes.csv"], "personal": ["/b/personal_health_2.csv"]}


def test_latest_versions_need_the_newest_stamp(spark):
    paths = spark.createDataFrame([("/m/forest_20240101_000000",), ("/m/forest_20240301_101010",), ("/m/logistic_20240301_101010",),
                                   ("/m/old_20231231_235959",), ("/m/readme",)], "path string")
    assert sorted(r["path"] for r in versions.latest_versions(paths).collect()) == [
        "/m/forest_20240301_101010", "/m/logistic_20240301_101010"]


def test_projection_reaches_the_scan(spark):
    t = Tables(spark, DATA)
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    plan = reports.risk_share_panel(t.gold, dt.date(1995, 1, 2))._jdf.queryExecution().explainString(mode)
    schema = [line for line in plan.splitlines() if "ReadSchema" in line][0].split("ReadSchema:")[1]
    assert "l_returnflag" in schema and "l_suppkey" not in schema and "l_linestatus" not in schema


def test_filter_reaches_the_scan(spark):
    plan = spark.read.parquet(f"{DATA}/lineitem.parquet").where(C("l_quantity") > 45).select("l_orderkey")
    assert "GreaterThan(l_quantity,45.0)" in plan._jdf.queryExecution().executedPlan().toString()


# ---- incremental -----------------------------------------------------------
def test_upsert_partitions_rewrites_only_touched_ones(spark):
    path = writers.scratch_path(spark, "test-upsert")
    base = spark.createDataFrame([("a", 1, 10), ("a", 2, 20), ("b", 3, 30)], "p string, k int, v int")
    writers.write_partitioned(base.select("k", "v", "p"), path, ["p"])
    before = {r[0] for r in spark.read.parquet(path).where("p = 'b'").select(F.input_file_name()).collect()}
    I.upsert_partitions(spark.createDataFrame([("a", 2, 99), ("c", 4, 40)], "p string, k int, v int"), path, ["p", "k"], ["p"])
    got = {(r["p"], r["k"]): r["v"] for r in spark.read.parquet(path).collect()}
    assert got == {("a", 1): 10, ("a", 2): 99, ("b", 3): 30, ("c", 4): 40}
    assert {r[0] for r in spark.read.parquet(path).where("p = 'b'").select(F.input_file_name()).collect()} == before
    with pytest.raises(ValueError):
        I.upsert_partitions(base, path, ["k"], ["p"])


def test_newest_change_wins(spark):
    df = spark.createDataFrame([(1, 1, "old"), (1, 3, "new"), (1, 2, "mid"), (2, 1, None)], "k int, at int, v string")
    assert {r["k"]: r["v"] for r in I.newest_per_key(df, ["k"], "at").collect()} == {1: "new", 2: None}


def test_run_states(spark):
    at = lambda s: dt.datetime(2024, 1, 1, 0, 0, s)
    rows = [("x", "p", "s", "running", at(0), 0, None), ("x", "p", "s", "completed", at(9), 5, None),
            ("y", "p", "s", "running", at(1), 0, None), ("z", "p", "s", "failed", at(3), 0, "boom")]
    log = spark.createDataFrame(rows, "execution_id string, pipeline_name string, pipeline_stage string, status string, event_time timestamp,"
                                      " records_processed bigint, error_message string")
    got = {r["execution_id"]: r for r in I.run_states(log).collect()}
    assert got["x"]["status"] == "completed" and got["x"]["duration_seconds"] == 9.0 and got["x"]["records_processed"] == 5
    assert got["y"]["end_time"] is None and got["z"]["error_message"] == "boom"


def test_report_window_is_inclusive(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, d),) for d in (1, 2, 9, 20)], "processing_date date")
    assert reports.recent(df, dt.date(2024, 1, 9), 7).count() == 3


def test_snapshot_returns_all_newest_rows(spark):
    t = dt.datetime(2024, 1, 2)
    df = spark.createDataFrame([(1, 0.2, t), (2, 0.75, t), (3, 0.9, dt.datetime(2024, 1, 1))], "id int, risk_score double, processed_timestamp timestamp_ntz")
    assert {r["id"]: r["risk_assessment"] for r in reports.latest_predictions(df, ["id"]).collect()} == {1: "Low", 2: "Critical"}


def test_wearable_insights_read_the_cleaned_table_at_most_four_times(spark):
    plan = QUERIES["v60_wearable_insights"](spark, DATA)._jdf.queryExecution().optimizedPlan().toString()
    assert 0 < plan.count("Relation [") <= 4 and "scalar-subquery" not in plan
    cleaning = jobs.clean_wearable(Tables(spark, DATA).wearable)._jdf.queryExecution().optimizedPlan().toString()
    assert cleaning.count("Relation [") <= 4 and "scalar-subquery" not in cleaning


def test_several_changes_of_one_key(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "k int, v string, at int")
    new = spark.createDataFrame([(2, "x", 5), (2, "y", 7), (3, "z", 2)], "k int, v string, at int")
    with pytest.raises(Exception, match="several changes of one key"):
        I.upsert(old, new, ["k"]).collect()
    got = {(r["k"], r["v"]) for r in I.upsert(old, new, ["k"], "at").collect()}
    assert got == {(1, "a"), (2, "y"), (3, "z")}
    kept = {(r["k"], r["v"]) for r in I.insert_ignore(old, new.union(spark.createDataFrame([(3, "c", 9)], new.schema)), ["k"]).collect()}
    assert kept == {(1, "a"), (2, "b"), (3, "c")}


def test_missing_days_are_filled(spark):
    days = spark.createDataFrame([(dt.date(2024, 1, d), 1) for d in (1, 2, 9)], "day date, v int")
    filled = windows.fill_days(days, "day")
    assert filled.count() == 9 and filled.where("v is null").count() == 6


def test_bucketed_tables_join_without_a_shuffle(spark):
    a = writers.write_bucketed(spark.range(500).withColumnRenamed("id", "k"), "vm_test_a", ["k"], 8)
    b = writers.write_bucketed(spark.range(300).withColumnRenamed("id", "k"), "vm_test_b", ["k"], 8)
    joined = a.hint("merge").join(b, "k")
    assert joined.count() == 300
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan


# ---- streams ---------------------------------------------------------------
@pytest.fixture(scope="module")
def event_files(spark):
    path = writers.scratch_path(spark, "test-events")
    spark.read.parquet(f"{DATA}/events.parquet").repartitionByRange(5, "ts").write.parquet(path)
    return path, spark.read.parquet(path).schema


def _daily(spark, folder, schema, every=1):
    stream = T.open_stream(spark, folder, schema, files_per_batch=every, event_time="ts")
    return T.daily(stream, "ts", {"events": n()}, ["event_type"], lateness="60 days")  # files come in any order


def _want_daily(spark, path):
    rows = spark.read.parquet(path).groupBy(C("ts").cast("date").alias("day"), "event_type").count().collect()
    return {(r["day"], r["event_type"], r["count"]) for r in rows}


def _rows(df):
    return {(r["day"], r["event_type"], r["events"]) for r in df.collect()}


def test_stream_in_several_batches_equals_batch(spark, event_files):
    path, schema = event_files
    run = T.run_upsert(_daily(spark, path, schema), writers.scratch_path(spark, "t-upsert"), ["day", "event_type"], ["day"])
    assert _rows(run.finished()) == _want_daily(spark, path)


def test_stopped_stream_resumes_where_it_was(spark, event_files):
    path, schema = event_files
    files = sorted(spark.read.parquet(path).inputFiles())
    inbox, target, checkpoint = (writers.scratch_path(spark, x) for x in ("t-inbox", "t-target", "t-checkpoint"))
    move = lambda some: spark.read.schema(schema).parquet(*some).write.mode("append").parquet(inbox)
    start = lambda: T.run_upsert(_daily(spark, inbox, schema), target, ["day", "event_type"], ["day"], checkpoint)
    move(files[:2])
    first = _rows(start().finished())
    move(files[2:])
    run = start()
    second = _rows(run.finished())
    assert first < second or len(first) < len(second)
    assert second == _want_daily(spark, path)
    assert run.query.lastProgress is None or run.query.lastProgress["batchId"] > 1


def test_interval_run_can_be_read_and_stopped(spark, event_files):
    path, schema = event_files
    stream = T.open_stream(spark, path, schema, event_time="ts")
    collect = lambda b: b.agg(n().alias("events"))
    run = T.run_metrics_collection(stream, writers.scratch_path(spark, "t-interval"), collect, "events bigint", every="1 second")
    assert run.read().count() >= 0 and run.query.isActive
    run.query.processAllAvailable()
    assert run.stop().agg(F.sum("events")).first()[0] == spark.read.parquet(path).count()
    assert not run.query.isActive


def test_windows_beyond_the_watermark_ignore_late_rows(spark):
    inbox, target = writers.scratch_path(spark, "t-late"), writers.scratch_path(spark, "t-late-out")
    at = lambda d, h: dt.datetime(2024, 1, d, h)
    add = lambda rows: spark.createDataFrame(rows, "ts timestamp_ntz, v int").coalesce(1).write.mode("append").parquet(inbox)

    def run():
        stream = T.open_stream(spark, inbox, "ts timestamp_ntz, v int", event_time="ts")
        return T.run_append(T.tumbling(stream, "ts", "1 hour", {"n": n()}, lateness="2 hours"), target).finished()

    add([(at(1, 0), 1), (at(1, 1), 1)])
    run()
    add([(at(1, 0), 2), (at(1, 9), 1)])  # late by less than two hours against what was seen
    run()
    add([(at(1, 1), 3), (at(1, 20), 1)])  # its window is closed
    got = {(r["window_start"].hour, r["n"]) for r in run().collect()}
    assert {x for x in got if x[0] < 2} == {(0, 2), (1, 1)}


def test_metrics_collection_keeps_one_set_per_batch(spark, event_files):
    path, schema = event_files
    stream = T.open_stream(spark, path, schema, files_per_batch=1, event_time="ts")
    out = T.run_metrics_collection(stream, writers.scratch_path(spark, "t-metrics"), lambda b: b.agg(n().alias("events")), "events bigint").finished()
    files = len(spark.read.parquet(path).inputFiles())
    assert out.count() == files and out.agg(F.sum("events")).first()[0] == spark.read.parquet(path).count()


def test_copies_inside_the_watermark_are_dropped(spark, event_files):
    path, schema = event_files
    s = lambda: T.open_stream(spark, path, schema, event_time="ts")
    out = T.run_append(T.clean_stream(s().unionByName(s()), "event_id", "ts", {}), writers.scratch_path(spark, "t-dedupe")).finished()
    assert out.count() == spark.read.parquet(path).count()


# ---- models ----------------------------------------------------------------
@pytest.fixture(scope="module")
def learnable(spark):
    df = spark.range(3000).select("id", F.rand(1).alias("a"), F.rand(2).alias("b")).withColumn(
        "y", F.when(C("a") + C("b") * 0.2 > 0.6, 1).otherwise(0))
    return M.labelled(df, "y", ["a", "b"], "id")


def test_split_is_complete_disjoint_and_repeatable(spark, learnable):
    parts = M.split(learnable, "id", [0.8, 0.1, 0.1])
    ids = [{r["id"] for r in p.select("id").collect()} for p in parts]
    assert sum(map(len, ids)) == 3000 == len(set.union(*ids))
    assert 0.75 < len(ids[0]) / 3000 < 0.85
    again = M.split(learnable.repartition(7), "id", [0.8, 0.1, 0.1])
    assert {r["id"] for r in again[0].select("id").collect()} == ids[0]


def test_stratified_split_keeps_class_shares(learnable):
    train, test = M.stratified_split(learnable, M.LABEL, "id")
    share = lambda d: d.agg(F.avg(M.LABEL)).first()[0]
    assert train.count() + test.count() == 3000 and abs(share(train) - share(test)) < 0.02


def test_rows_with_gaps_are_counted_and_keep_their_place(spark, learnable):
    gaps = learnable.withColumn("a", F.when(C("id") % 10 == 0, F.lit(None)).when(C("id") % 10 == 1, F.lit(float("nan"))).otherwise(C("a")))
    row = M.incomplete_counts(gaps, ["a", "b"]).first()
    assert (row["n_rows"], row["incomplete_rows"], row["a_missing"], row["b_missing"]) == (3000, 600, 600, 0)
    model = M.train(M.logistic_regression(), gaps, ["a", "b"])
    scored = M.score(model, gaps)
    assert scored.count() == 3000 and scored.where("prediction is null").count() == 600
    assert E.evaluate(scored).first()["total"] == 2400


def test_stratified_split_keeps_rows_without_label(spark, learnable):
    some = learnable.withColumn(M.LABEL, F.when(C("id") % 5 > 0, C(M.LABEL)))
    train, test = M.stratified_split(some, M.LABEL, "id")
    assert train.count() + test.count() == 3000
    assert 400 < train.where(C(M.LABEL).isNull()).count() < 560


def test_single_classifiers_are_saved_and_loaded(spark, learnable):
    model = M.train(M.random_forest(numTrees=3, maxDepth=3), learnable, ["a", "b"])
    from pyspark.ml.feature import VectorAssembler
    alone = M.random_forest(numTrees=3, maxDepth=3).fit(VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(learnable))
    for one, columns in ((model, None), (alone, ["a", "b"])):
        path = writers.scratch_path(spark, "test-single")
        M.save_model(one, path)
        back = M.load_model(path)
        assert type(back) is type(one)
        assert E.evaluate(M.score(back, learnable, columns)).first()["auc_roc"] > 0.9


def test_bounded_sample(learnable):
    assert M.bounded(learnable, "id", 5000).count() == 3000
    assert 380 < M.bounded(learnable, "id", 500).count() < 620


def test_training_scoring_and_metrics(spark, learnable):
    train, test = M.split(learnable, "id", [0.8, 0.2])
    for clf in (M.logistic_regression(), M.random_forest(numTrees=5, maxDepth=4)):
        model = M.train(clf, train, ["a", "b"])
        row = E.evaluate(M.score(model, test)).first()
        assert row["auc_roc"] > 0.9 and 0 <= row["precision"] <= 1 and row["tp"] + row["tn"] + row["fp"] + row["fn"] == row["total"]
    top = E.feature_importances(model, ["a", "b"], spark).first()
    assert top["feature"] == "a"
    path = writers.scratch_path(spark, "test-model")
    M.save_model(model, path)
    assert M.score(M.load_model(path), test).count() == test.count()


def test_weighted_metrics_match_the_evaluator(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    df = spark.createDataFrame([(1.0, 1.0)] * 7 + [(1.0, 0.0)] * 3 + [(0.0, 0.0)] * 11 + [(0.0, 1.0)] * 2, "label double, prediction double")
    row = E.weighted_metrics(confusion_counts(df, "label", "prediction")).first()
    for ours, theirs in (("accuracy", "accuracy"), ("precision", "weightedPrecision"), ("recall", "weightedRecall"), ("f1_score", "f1")):
        want = MulticlassClassificationEvaluator(labelCol="label", metricName=theirs).evaluate(df)
        assert row[ours] == pytest.approx(want, abs=1e-6)


def test_gates(spark):
    row = lambda *v: spark.createDataFrame([v], "accuracy double, f1_score double, auc_roc double, false_negative_rate double, false_positive_rate double")
    good = E.model_gate(row(0.9, 0.85, 0.9, 10.0, 3.0)).first()
    assert good["deployment_ready"] and good["model_quality"] == "Excellent" and good["improvement_suggestions"] == ""
    poor = E.model_gate(row(0.6, 0.5, 0.9, 20.0, 3.0)).first()
    assert not poor["deployment_ready"] and poor["model_quality"] == "Needs Improvement" and poor["improvement_suggestions"].count(";") == 2
    assert E.strict_gate(row(0.8, 0.75, 0.9, 9.0, 30.0)).first()["model_quality"] == "GOOD"


def test_business_metric_denominators(spark):
    cm = spark.createDataFrame([(8, 80, 10, 2, 100)], "tp bigint, tn bigint, fp bigint, fn bigint, total bigint")
    by_class, over_all = E.business_metrics(cm).first(), E.business_metrics(cm, "all").first()
    assert by_class["false_negative_rate"] == 20.0 and over_all["false_negative_rate"] == 2.0
    assert by_class["cost_of_false_negatives"] == 2000 and by_class["cost_of_false_positives"] == 1000


def test_a_constant_classifier_fails_the_model_queries(spark):
    """The rows of m4 to m7 tell a fit that learned nothing."""
    from pyspark.ml.classification import DecisionTreeClassifier
    from vitalmart.registry import base, models
    t = base.Tables(spark, "/root/testdata/sf0.001")
    stump = DecisionTreeClassifier(featuresCol="features", labelCol="label", maxDepth=0)
    row = models._evaluated(t, stump, 0.93, 0.93).first()
    assert (row["ranks_right"], row["decides_right"], row["beats_constant"]) == (False, False, False)
    early = models._optimal(t, maxIter=0).first()
    assert not early["gradient_vanishes"]
