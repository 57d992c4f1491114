"""J*: joins and subqueries; W*: window functions."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from vitalmart.functions.numeric import pct, rnd
from vitalmart.operators import aggregate as A
from vitalmart.operators import joins as J
from vitalmart.operators import windows as W
from vitalmart.plans import samples
from vitalmart.rules import clinical as R
from vitalmart.sources.keystore import KeyStore
from vitalmart.sources.writers import scratch_name, staged

from . import sql as S
from .base import ORACLES, query
from .reports_gold import PERFORMANCE

C = F.col


@query("j1_incremental_anti_join", "SELECT o_orderkey, o_orderstatus FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE"
       " l.l_orderkey = o.o_orderkey)")
def _(t):
    """Orders without lines yet: the target holds each key many times and is reduced to keys first."""
    return J.new_rows(t.orders, t.lineitem, "o_orderkey", "l_orderkey").select("o_orderkey", "o_orderstatus")


@query("j1_incremental_by_key_store", ORACLES["j1_incremental_anti_join"])
def _(t):
    """The target's keys stand bucketed in a store, filled by two loads: only the asking side moves."""
    store = KeyStore(t.spark, scratch_name("j1_keys"), "l_orderkey", int(t.spark.conf.get("spark.sql.shuffle.partitions")))
    for part in (C("l_linenumber") < 3, F.lit(True)):
        store.add(t.lineitem.where(part).select("l_orderkey"))
    out = staged(store.unseen(t.orders.select("o_orderkey", "o_orderstatus"), "o_orderkey"), "j1")
    store.drop()
    return out


@query("j2_one_row_aggregates", S.select({"patients": S.cnt("TRUE"), "share_of_orders": S.pct("COUNT(*)", "(SELECT COUNT(*) FROM orders)", 4),
                                          "avg_balance": S.avg("c_acctbal", 4)}, "customer"))
def _(t):
    base = t.customer.agg(A.n().alias("patients"), A.mean("c_acctbal", 4).alias("avg_balance"))
    total = t.orders.agg(A.n().alias("c")).scalar()
    return base.select("patients", pct("patients", total, 4).alias("share_of_orders"), "avg_balance")


@query("j3_totals_on_detail_groups", "WITH g AS (SELECT o_orderstatus, o_orderpriority, COUNT(*) AS orders FROM orders GROUP BY ALL) SELECT *,"
       " CAST(SUM(orders) OVER () AS BIGINT) AS all_orders, CAST(SUM(orders) OVER (PARTITION BY o_orderstatus) AS BIGINT) AS status_orders FROM g")
def _(t):
    g = A.report(t.orders, ["o_orderstatus", "o_orderpriority"], {"orders": A.n()})
    return g.withColumns({"all_orders": F.sum("orders").over(Window.partitionBy()),
                          "status_orders": F.sum("orders").over(Window.partitionBy("o_orderstatus"))})


@query("j4_scalar_subquery_filter", "SELECT o_orderkey, o_totalprice, " + S.r("o_totalprice - (SELECT AVG(o_totalprice) FROM orders)", 4)
       + " AS above FROM orders WHERE o_orderdate = (SELECT MAX(o_orderdate) FROM orders)")
def _(t):
    newest = t.orders.agg(F.max("o_orderdate").alias("d")).scalar()
    mean = t.orders.agg(F.avg("o_totalprice").alias("m")).scalar()
    return t.orders.where(C("o_orderdate") == newest).select("o_orderkey", "o_totalprice", rnd(C("o_totalprice") - mean, 4).alias("above"))


@query("j4_scalar_subquery_projection", "SELECT o_orderstatus, COUNT(*) AS orders, (SELECT COUNT(*) FROM customer) AS customers, "
       + S.r("(SELECT AVG(l_quantity) FROM lineitem)", 6) + " AS avg_quantity FROM orders GROUP BY o_orderstatus")
def _(t):
    groups = A.report(t.orders, ["o_orderstatus"], {"orders": A.n()})
    return J.attach_scalars(groups, customers=t.customer.agg(A.n().alias("c")).scalar(),
                            avg_quantity=t.lineitem.agg(A.mean("l_quantity", 6).alias("m")).scalar())


def _intervals(rows):
    edges = [r[1] for r in rows[1:]] + [rows[-1][2] + 1e-9]
    return [(r[0], float(r[1]), float(e)) for r, e in zip(rows, edges)]


@query("j5_range_join", S.WITH_GOLD + "SELECT CASE " + " ".join(
    f"WHEN risk_score >= {lo} AND risk_score < {hi} THEN '{name}'" for name, lo, hi in _intervals(R.RISK_TABLE))
    + " END AS category_name, CASE " + " ".join(
    f"WHEN risk_score >= {lo} AND risk_score < {hi} THEN '{c}'" for (name, lo, hi), (_, _, _, c) in zip(_intervals(R.RISK_TABLE), R.RISK_TABLE))
    + " END AS color_code, COUNT(*) AS patients FROM gold GROUP BY 1, 2")
def _(t):
    bands = J.half_open(R.RISK_TABLE, ["category_name", "risk_min", "risk_next", "color_code"], t.spark)
    joined = J.band_join(t.gold.select("risk_score"), bands, "risk_score", "risk_min", "risk_next")
    return A.report(joined, ["category_name", "color_code"], {"patients": A.n()})


@query("j5_range_join_binned", "SELECT p_size, p_retailprice, floor(p_retailprice / 50e0) * 50e0 AS band_lo FROM part")
def _(t):
    """A band table derived from the data, met on shared bins."""
    size = t.part.agg(F.min("p_retailprice").alias("lo"), F.max("p_retailprice").alias("hi"))
    bands = size.select(F.explode(F.sequence(F.floor(C("lo") / 50), F.floor(C("hi") / 50))).alias("b")).select(
        (C("b") * 50.0).alias("band_lo"), (C("b") * 50.0 + 50.0).alias("band_hi"))
    out = J.band_join(t.part.select("p_size", "p_retailprice"), bands, "p_retailprice", "band_lo", "band_hi", "inner")
    return out.select("p_size", "p_retailprice", "band_lo")


@query("j6_referential_check", "SELECT l_partkey AS missing_key, COUNT(*) AS row_count FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey"
       " FROM part WHERE p_size > 1) GROUP BY 1")
def _(t):
    """Lines whose part is not among the parts larger than size 1 (the full part table has no gaps)."""
    return J.missing_parents(t.lineitem, "l_partkey", t.part.where(C("p_size") > 1), "p_partkey")


@query("j7_predictions_with_actuals", S.WITH_CLINICAL + ", a AS (SELECT id, MAX(outcome) AS actual FROM clinical GROUP BY id), p AS (SELECT id,"
       " CASE WHEN glucose >= 126 THEN 1 ELSE 0 END AS predicted FROM clinical) SELECT predicted, actual, COUNT(*) AS cases,"
       " CAST(SUM(CASE WHEN predicted = actual THEN 1 ELSE 0 END) AS BIGINT) AS correct FROM p JOIN a USING (id) GROUP BY ALL")
def _(t):
    c = t.clinical
    actuals = c.groupBy("id").agg(F.max("outcome").alias("actual"))
    predicted = c.select("id", "glucose", F.when(C("glucose") >= 126, 1).otherwise(0).alias("predicted"))
    joined = J.predictions_with_actuals(predicted, actuals, "id", salts=4)
    return A.report(joined, ["predicted", "actual"], {"cases": A.n(), "correct": F.sum("is_correct")})


# ---- windows ---------------------------------------------------------------
@query("w1_share_of_total", "SELECT c_mktsegment, COUNT(*) AS customers, " + S.pct("COUNT(*)", "SUM(COUNT(*)) OVER ()", 4) + " AS pct_rows, "
       + S.pct("SUM(c_acctbal)", "SUM(SUM(c_acctbal)) OVER ()", 4) + " AS pct_balance FROM customer GROUP BY c_mktsegment")
def _(t):
    return A.report(t.customer, ["c_mktsegment"], {"customers": A.n(), "b": F.sum("c_acctbal")},
                    {"pct_rows": ("customers", 4), "pct_balance": ("b", 4)}).drop("b")


@query("w2_trailing_mean", "WITH d AS (SELECT CAST(ts AS DATE) AS day, " + S.avg("value", 4) + " AS v FROM events GROUP BY 1) SELECT day, v, "
       + S.r("AVG(v) OVER (ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)", 4) + " AS ma7 FROM d")
def _(t):
    d = A.report(t.events, {"day": C("ts").cast("date")}, {"v": A.mean("value", 4)})
    return d.withColumn("ma7", W.trailing_mean("v", "day", 7, 4))


@query("w2_trailing_mean_calendar", "WITH d AS (SELECT CAST(o_orderdate AS DATE) AS day, COUNT(*) AS v FROM orders GROUP BY 1), s AS (SELECT CAST(unnest(generate_series((SELECT MIN(day) FROM d)::TIMESTAMP, (SELECT MAX(day) FROM d)::TIMESTAMP,"
       " INTERVAL 1 DAY)) AS DATE) AS day), f AS (SELECT day, COALESCE(v, 0) AS v FROM s LEFT JOIN d USING (day)) SELECT day, v, "
       + S.r("AVG(v) OVER (ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)", 4) + " AS ma7 FROM f")
def _(t):
    """Missing days filled first, so seven rows are seven days."""
    d = A.report(t.orders, {"day": C("o_orderdate").cast("date")}, {"v": A.n()})
    full = W.fill_days(d, "day").withColumn("v", F.coalesce("v", F.lit(0).cast("bigint")))
    return full.withColumn("ma7", W.trailing_mean("v", "day", 7, 4))


@query("w3_lag_trend", PERFORMANCE + ", l AS (SELECT model_id, evaluation_date, accuracy, LAG(accuracy) OVER (PARTITION BY model_id ORDER BY"
       " evaluation_date) AS prev FROM perf) SELECT *, CASE WHEN accuracy > prev THEN 'Increasing' WHEN accuracy < prev THEN 'Decreasing' ELSE"
       " 'Stable' END AS trend FROM l")
def _(t):
    p = samples.model_performance(t.gold).select("model_id", "evaluation_date", "accuracy")
    return p.withColumns({"prev": W.previous("accuracy", "evaluation_date", ["model_id"]),
                          "trend": W.trend_label("accuracy", "evaluation_date", ["model_id"])})


_LINE = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"]
_LINES = "ORDER BY " + ", ".join(_LINE)


@query("w2_trailing_mean_of_lines", "SELECT l_orderkey, l_linenumber, " + S.r(f"AVG(l_quantity) OVER ({_LINES} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)", 4)
       + " AS ma7 FROM lineitem")
def _(t):
    """One series over all order lines, in pieces."""
    rows = t.lineitem.select(*_LINE, "l_quantity")
    out = W.series_windows(rows, [], _LINE, 6, {"ma7": W.trailing_mean_of("l_quantity", 7, 4)}, 5_000)
    return out.select("l_orderkey", "l_linenumber", "ma7")


@query("w3_change_between_lines", f"WITH l AS (SELECT l_orderkey, l_linenumber, l_quantity, LAG(l_quantity) OVER (PARTITION BY l_returnflag {_LINES}) AS prev"
       " FROM lineitem) SELECT l_orderkey, l_linenumber, prev, CASE WHEN l_quantity > prev THEN 'Increasing' WHEN l_quantity < prev THEN 'Decreasing'"
       " ELSE 'Stable' END AS trend FROM l")
def _(t):
    """Three long series (one per flag), each in pieces."""
    rows = t.lineitem.select("l_returnflag", *_LINE, "l_quantity")
    out = W.series_windows(rows, ["l_returnflag"], _LINE, 1,
                           {"prev": lambda w: F.lag("l_quantity").over(w), "trend": W.change_of("l_quantity")}, 5_000)
    return out.select("l_orderkey", "l_linenumber", "prev", "trend")


@query("w4_row_number_per_file", "SELECT o_orderstatus, o_orderkey, CAST(row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) AS BIGINT)"
       " AS row_number FROM orders")
def _(t):
    return W.number_rows(t.orders.select("o_orderstatus", "o_orderkey"), ["o_orderstatus"], ["o_orderkey"])


@query("w4_row_number_by_date", "SELECT o_orderkey, CAST(row_number() OVER (ORDER BY CAST(o_orderdate AS DATE), o_orderkey) AS BIGINT) AS row_number FROM orders")
def _(t):
    rows = t.orders.select("o_orderkey", C("o_orderdate").cast("date").alias("day"), F.lit("orders").alias("file_name"))
    return W.number_rows(rows, ["file_name"], ["day", "o_orderkey"]).select("o_orderkey", "row_number")


@query("w4_row_number_by_time", "SELECT event_id, event_type, CAST(row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS BIGINT) AS row_number"
       " FROM events")
def _(t):
    return W.number_rows(t.events.select("event_id", "event_type", "ts"), ["event_type"], ["ts", "event_id"]).drop("ts")
