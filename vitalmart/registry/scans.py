"""S*: sources, sinks, layout. Round trips go through the shared scratch folder."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from vitalmart.functions.numeric import rnd
from vitalmart.operators.aggregate import mean, n, report
from vitalmart.operators.windows import number_rows
from vitalmart.plans import reports
from vitalmart.rules import clinical as R
from vitalmart.sources import compat, readers, versions, writers
from vitalmart.sources.schemas import CLINICAL_RAW, WEARABLE_RAW

from . import sql as S
from .base import query

C = F.col
AT = dt.datetime(2024, 1, 15, 12)


def _raw(t):
    """The clinical table under its CamelCase source names."""
    return t.clinical.select(*[C(new).alias(old) for old, new in R.COLUMN_NAMES.items()])


_PLAIN = S.WITH_CLINICAL + "SELECT " + ", ".join(f"{c}" for c in R.COLUMN_NAMES.values()) + " FROM clinical"


@query("s1_csv_inferred", "SELECT c_custkey, c_name, CAST(c_nationkey AS INTEGER) AS c_nationkey, c_acctbal, c_mktsegment FROM customer")
def _(t):
    path = writers.scratch_path(t.spark, "s1")
    t.customer.write.option("header", True).csv(path)
    df = readers.read_csv(t.spark, path)
    return df.withColumn("c_custkey", C("c_custkey").cast("bigint"))


@query("s2_csv_declared", "SELECT c_custkey, CAST(NULL AS BIGINT) AS c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def _(t):
    """A value that does not fit the declared type becomes NULL."""
    path = writers.scratch_path(t.spark, "s2")
    t.customer.write.option("header", True).csv(path)
    return readers.read_csv(t.spark, path, "c_custkey bigint, c_name bigint, c_nationkey int, c_acctbal double, c_mktsegment string")


@query("s3_parquet_scan", "SELECT l_orderkey, l_quantity FROM lineitem WHERE l_quantity > 45")
def _(t):
    return readers.read_parquet(t.spark, f"{t.dir}/lineitem.parquet", ["l_orderkey", "l_quantity"]).where(C("l_quantity") > 45)


@query("s4_format_dispatch", "SELECT p_partkey, p_brand, p_size FROM part UNION ALL SELECT p_partkey, p_brand, p_size FROM part")
def _(t):
    path = writers.scratch_path(t.spark, "s4") + ".csv"
    cols = ["p_partkey", "p_brand", "p_size"]
    t.part.select(*cols).write.option("header", True).csv(path)
    csv = readers.read_table(t.spark, path, "p_partkey bigint, p_brand string, p_size int")
    return readers.read_table(t.spark, f"{t.dir}/part.parquet").select(*cols).unionByName(csv)


@query("s5_multi_file_routing", S.WITH_CLINICAL + "SELECT 'clinical' AS target, COUNT(*) AS n_rows, 'diabetes_batch.csv' AS folder FROM clinical UNION ALL"
       " SELECT 'personal_health', COUNT(*), 'personal_health_batch.csv' FROM orders")
def _(t):
    """Files routed to a table by name, renamed to column names, each with its file of origin."""
    root = writers.scratch_path(t.spark, "s5")
    paths = [f"{root}/diabetes_batch.csv", f"{root}/personal_health_batch.csv", f"{root}/notes.txt"]
    _raw(t).write.option("header", True).csv(paths[0])
    wide = t.wearable.select(*[(C(new) if new in t.wearable.columns else F.lit(None).cast("string")).alias(old)
                               for old, new in R.WEARABLE_COLUMN_NAMES.items()])
    wide.write.option("header", True).csv(paths[1])
    tables = readers.read_routed(t.spark, paths, {"*diabetes*": "clinical", "*personal_health*": "personal_health"},
                                 {"clinical": CLINICAL_RAW, "personal_health": WEARABLE_RAW},
                                 {"clinical": R.COLUMN_NAMES, "personal_health": R.WEARABLE_COLUMN_NAMES})
    folder = {"clinical": "diabetes_batch.csv", "personal_health": "personal_health_batch.csv"}
    parts = [df.agg(n().alias("n_rows")).select(
        F.lit(name).alias("target"), "n_rows", F.lit(folder[name]).alias("folder")) for name, df in sorted(tables.items())]
    return parts[0].unionByName(parts[1])


@query("s6_literal_rows", "SELECT c_mktsegment, CASE c_mktsegment WHEN 'MACHINERY' THEN 'industry' WHEN 'BUILDING' THEN 'industry' END AS kind,"
       " COUNT(*) AS customers FROM customer GROUP BY 1")
def _(t):
    kinds = readers.literal_rows(t.spark, [("MACHINERY", "industry"), ("BUILDING", "industry")], "c_mktsegment string, kind string")
    # two literal rows: the size of the broadcast side is fixed
    return report(t.customer, ["c_mktsegment"], {"customers": n()}).join(F.broadcast(kinds), "c_mktsegment", "left")


@query("s7_sequence_source", "SELECT CAST(unnest(generate_series(0, (SELECT MAX(o_orderkey) FROM orders))) AS BIGINT) AS id EXCEPT SELECT l_orderkey"
       " FROM lineitem")
def _(t):
    """Order numbers of the whole key range that no line uses."""
    last = t.orders.agg(F.max("o_orderkey")).first()[0]  # one number; the range itself is generated by the tasks
    ids = readers.sequence(t.spark, 0, last)
    return ids.join(t.lineitem.select(C("l_orderkey").alias("id")).distinct(), "id", "left_anti")


@query("s9_dual_format_sink", "SELECT 'csv' AS format, COUNT(*) AS n_rows, " + S.r("SUM(o_totalprice)", 2) + " AS total FROM orders UNION ALL"
       " SELECT 'parquet', COUNT(*), " + S.r("SUM(o_totalprice)", 2) + " FROM orders")
def _(t):
    root = writers.scratch_path(t.spark, "s9")
    writers.write_bronze(t.orders.select("o_orderkey", "o_totalprice"), f"{root}/parquet", f"{root}/csv")
    both = {"parquet": readers.read_parquet(t.spark, f"{root}/parquet"),
            "csv": readers.read_csv(t.spark, f"{root}/csv", "o_orderkey bigint, o_totalprice double")}
    parts = [df.agg(n().alias("n_rows"), rnd(F.sum("o_totalprice"), 2).alias("total")).select(F.lit(k).alias("format"), "n_rows", "total")
             for k, df in both.items()]
    return parts[0].unionByName(parts[1])


@query("s10_partitioned_silver_sink", "SELECT o_orderstatus, COUNT(*) AS orders, " + S.avg("o_totalprice", 2) + " AS avg_price FROM orders GROUP BY 1")
def _(t):
    path = writers.scratch_path(t.spark, "s10")
    writers.write_partitioned(t.orders, path, ["o_orderstatus"])
    return report(readers.read_parquet(t.spark, path), ["o_orderstatus"], {"orders": n(), "avg_price": mean("o_totalprice", 2)})


@query("s11_gold_sink_overwrite", "SELECT o_orderstatus, COUNT(*) AS orders, CAST(SUM(CASE WHEN o_orderstatus = 'F' THEN 2 ELSE 1 END) AS BIGINT) AS"
       " versions FROM orders GROUP BY 1")
def _(t):
    """Rewriting one partition leaves the others alone."""
    path = writers.scratch_path(t.spark, "s11")
    rows = t.orders.select("o_orderkey", "o_orderstatus")
    writers.write_partitioned(rows.withColumn("version", F.lit(1)), path, ["o_orderstatus"])
    writers.write_partitioned(rows.where(C("o_orderstatus") == "F").withColumn("version", F.lit(2)), path, ["o_orderstatus"])
    return report(readers.read_parquet(t.spark, path), ["o_orderstatus"], {"orders": n(), "versions": F.sum("version")})


@query("s12_append_sink", "SELECT c_mktsegment, 2 * COUNT(*) AS customers FROM customer GROUP BY 1")
def _(t):
    path = writers.scratch_path(t.spark, "s12")
    rows = t.customer.select("c_custkey", "c_mktsegment")
    writers.append(rows, path)
    writers.append(rows, path)
    return report(readers.read_parquet(t.spark, path), ["c_mktsegment"], {"customers": n()})


@query("s13_json_metrics_sink", S.WITH_FEATURES + "SELECT age_group, COUNT(*) AS total_count, " + S.rate("outcome = 1", 2)
       + " AS diabetes_rate FROM features GROUP BY age_group")
def _(t):
    path = writers.scratch_path(t.spark, "s13")
    writers.write_json(reports.age_group_analysis(t.features), path)
    return t.spark.read.schema("age_group string, total_count bigint, diabetes_rate double").json(path)


@query("s14_text_report_sink", S.WITH_FEATURES + "SELECT '{\"ages\":' || COUNT(DISTINCT age_group) || ',\"bands\":' || COUNT(DISTINCT bmi_category) || '}' AS line"
       " FROM features")
def _(t):
    """A JSON document as a one-row text file, read back and reduced to its set sizes."""
    path = writers.scratch_path(t.spark, "s14")
    doc = writers.report_document({"ages": reports.age_group_analysis(t.features).select("age_group", "total_count"),
                                   "bands": reports.bmi_category_analysis(t.features).select("bmi_category", "total_count")}, F.lit(AT))
    writers.write_text_report(doc, path)
    parsed = F.from_json("value", "ages array<struct<age_group:string>>, bands array<struct<bmi_category:string>>")
    back = t.spark.read.text(path).select(parsed.alias("d"))
    return back.select(F.format_string('{"ages":%d,"bands":%d}', F.size("d.ages"), F.size("d.bands")).alias("line"))


@query("s15_ingest_metadata", "SELECT 'customer' AS dataset_name, COUNT(*) AS row_count, CAST(5 + 0 * COUNT(*) AS BIGINT) AS column_count,"
       " 'c_custkey,c_name,c_nationkey,c_acctbal,c_mktsegment' AS columns FROM customer")
def _(t):
    return writers.ingest_metadata(t.customer, "customer", "source", "target", F.lit(AT)).select(
        "dataset_name", "row_count", "column_count", "columns")


@query("s16_lineage_columns", "SELECT o_orderkey, 'orders' AS data_source, '1.0' AS ingestion_version, '2024-01-15 12:00:00' AS ingested,"
       " CAST(row_number() OVER (ORDER BY o_orderkey) AS BIGINT) AS row_number FROM orders")
def _(t):
    stamped = writers.add_lineage(t.orders.select("o_orderkey"), F.lit(AT).cast("timestamp_ntz"), "orders")
    numbered = number_rows(stamped, ["data_source"], ["o_orderkey"])
    return numbered.select("o_orderkey", "data_source", "ingestion_version",
                           F.date_format("ingestion_timestamp", "yyyy-MM-dd HH:mm:ss").alias("ingested"), "row_number")


@query("s17_model_save_load", S.WITH_CLINICAL + "SELECT COUNT(*) AS scaled_rows FROM clinical")
def _(t):
    """A feature pipeline fitted, saved under a time-stamped name, loaded by newest version, applied to all rows."""
    from vitalmart.ml.training import feature_pipeline, load_model, save_model
    root = writers.scratch_path(t.spark, "s17")
    measures = t.clinical.select("id", "glucose", "bmi")
    path = f"{root}/features_20240115_120000"
    save_model(feature_pipeline(["glucose", "bmi"]).fit(measures), path)
    newest = versions.latest_versions(t.spark.createDataFrame([(path,), (f"{root}/features_20230101_000000",)], "path string"))
    return load_model(newest.first()["path"]).transform(measures).agg(n().alias("scaled_rows"))


@query("s18_latest_version", "WITH v AS (SELECT CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'forest' ELSE 'logistic' END AS kind,"
       " strftime(o_orderdate, '%Y%m%d_%H%M%S') AS stamp FROM orders), m AS (SELECT kind, MAX(stamp) AS stamp FROM v GROUP BY kind) SELECT kind,"
       " '/models/' || kind || '_' || stamp AS path, stamp FROM m WHERE stamp = (SELECT MAX(stamp) FROM m)")
def _(t):
    kind = F.when(C("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.lit("forest")).otherwise(F.lit("logistic"))
    named = F.when(kind == "forest", versions.versioned_name("forest", C("o_orderdate"))).otherwise(
        versions.versioned_name("logistic", C("o_orderdate")))
    return versions.latest_versions(t.orders.select(F.concat(F.lit("/models/"), named).alias("path")))


@query("s19_compatibility_projection", S.WITH_CLINICAL + "SELECT " + ", ".join(f"{c} AS {o}" for c, o in compat.BRONZE_OLD_NAMES.items()) + " FROM clinical")
def _(t):
    return compat.project(t.clinical, compat.BRONZE_OLD_NAMES)


@query("s19_gold_compatibility", S.WITH_GOLD + "SELECT " + ", ".join(compat.GOLD_COLUMNS) + " FROM gold")
def _(t):
    return compat.project(t.gold, compat.GOLD_COLUMNS)


@query("s20_bucketed_layout", "SELECT c_mktsegment, COUNT(*) AS orders FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1")
def _(t):
    """Two tables bucketed on the join key into as many buckets as a shuffle has partitions: the
    join needs no shuffle. Writing again replaces the tables."""
    buckets = int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    o = writers.write_bucketed(t.orders.select("o_custkey"), "vitalmart_orders_by_customer", ["o_custkey"], buckets)
    c = writers.write_bucketed(t.customer.select("c_custkey", "c_mktsegment"), "vitalmart_customer_by_key", ["c_custkey"], buckets)
    return report(o.join(c, o["o_custkey"] == c["c_custkey"]), ["c_mktsegment"], {"orders": n()})


@query("s21_layer_row_counts", S.WITH_GOLD + "SELECT 'bronze' AS layer, COUNT(*) AS record_count FROM clinical UNION ALL SELECT 'gold', COUNT(*) FROM gold"
       " UNION ALL SELECT 'orders', COUNT(*) FROM orders")
def _(t):
    return reports.layer_counts({"bronze": t.clinical, "gold": t.gold, "orders": t.orders})
