"""Exact percentiles that no single task has to hold.

``percentile`` keeps every distinct value of a group in one buffer. Here values are
selected by rank in several levels: the first pass counts buckets of leading bits of an
order-preserving key, which partial sums shrink to a few thousand rows per task before
the shuffle. Only buckets that hold a wanted rank are looked into; while one has more rows
than a task shall rank, its rows alone are counted again by the next bits, with the rank at
which the bucket starts carried along. All bits of the key are one value, so the levels end;
a bucket whose least and largest values are equal is one value already and ends at once.
A group holding a third of all rows is spread like any other.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitalmart.functions.numeric import sort_key
from vitalmart.sources.writers import held

RANKED = 100_000  # rows of a bucket one task ranks by value
_SHIFTS = (40, 27, 14, 0)  # bits of the key a level leaves out
_BUCKET = ("_n", "_v", "_top", "_k")
_BROADCAST = 20_000  # wanted buckets sent to all tasks; more meet the rows in a shuffled join


def _edges(probs: dict[str, float]) -> list[Column]:
    """The two neighbouring ranks (0-based) of each percentile."""
    return [f(_rank(p)).cast("bigint") for p in probs.values() for f in (F.floor, F.ceil)]


def _rank(p: float) -> Column:
    return F.col("_total").cast("double").__sub__(1.0) * F.lit(float(p))


def _inside(rows: DataFrame, wanted: DataFrame, keys: list[str], shift: int, few: bool) -> DataFrame:
    """The rows that lie in a wanted bucket, with its ``_b``, ``_before`` and ``_total``."""
    named = wanted.select(*[F.col(k).alias(f"_of_{k}") for k in keys], F.col("_b").alias("_of_b"), "_before", "_total")
    same = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys]
    found = rows.withColumn("_b", F.shiftright("_k", shift))
    found = found.join(F.broadcast(named) if few else named, reduce(lambda a, b: a & b, [*same, F.col("_b") == F.col("_of_b")]))
    return found.select(*keys, "_v", "_k", "_b", "_before", "_total")


def _counted(rows: DataFrame, *by: Column | str) -> DataFrame:
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_v"), F.max("_v").alias("_top"), F.min("_k").alias("_k"))


def wanted_buckets(rows: DataFrame, keys: list[str], probs: dict[str, float], most: int = RANKED) -> list[tuple[int, DataFrame, bool | None]]:
    """Buckets that hold a wanted rank, narrowed until each has at most ``most`` rows or is one value.

    Rows need ``_v`` and its ``_k``. Each entry is the shift that makes its ``_b`` of a key, the buckets
    (keys, _b, _n, _before, _total), and whether they are few enough to broadcast; or None where each bucket is
    one value (then also _v, _k), so that its rows need not be read again.
    """
    holds = F.exists(F.array(*_edges(probs)), lambda r: (r >= F.col("_before")) & (r < F.col("_before") + F.col("_n")))
    counts = _counted(rows, *keys, F.shiftright("_k", _SHIFTS[0]).alias("_b"))
    buckets = counts.select(*keys, "_b", *_BUCKET, (F.sum("_n").over(Window.partitionBy(*keys).orderBy("_b")) - F.col("_n")).alias("_before"),
                            F.sum("_n").over(Window.partitionBy(*keys)).alias("_total"))
    found = []
    for shift, finer in zip(_SHIFTS, (*_SHIFTS[1:], None)):
        every = held(buckets.where(holds), "percentile-buckets", _BROADCAST)
        one = F.col("_v") == F.col("_top")
        found.append((shift, every.where(one).select(*keys, "_b", "_v", "_k", "_n", "_before", "_total"), None))
        wanted = every.where(~one).select(*keys, "_b", "_n", "_before", "_total")
        size = wanted.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("_n") > most).alias("wide")).first()
        if not size["n"]:
            break
        few = size["n"] <= _BROADCAST
        if finer is None or not size["wide"]:
            found.append((shift, wanted, few))
            break
        if size["wide"] < size["n"]:
            found.append((shift, wanted.where(F.col("_n") <= most), few))
        inside = _inside(rows, wanted.where(F.col("_n") > most), keys, shift, few)
        counts = _counted(inside, *keys, F.col("_b").alias("_in"), "_before", "_total", F.shiftright("_k", finer).alias("_b"))
        start = F.sum("_n").over(Window.partitionBy(*keys, "_in").orderBy("_b")) - F.col("_n")
        buckets = counts.select(*keys, "_b", *_BUCKET, (F.col("_before") + start).alias("_before"), "_total")
    return [entry for entry in found if entry[2] is not None or entry[1].head(1)] or found


def exact_percentiles(df: DataFrame, keys: list[str], value: str, probs: dict[str, float],
                      narrow: bool = False, few_keys: bool = False, most: int = RANKED) -> DataFrame:
    """Interpolated percentiles of ``value`` per key, one column per entry of ``probs``.

    NULL values are ignored; keys without any value do not appear. NaN counts as the
    largest value and -0.0 as less than 0.0, as in sorting. ``narrow`` is for values whose range is
    small against their size (epoch times): buckets are then taken from the distance to the smallest
    value, which spares a level at the price of one more pass over the column. ``few_keys`` says that the keys
    are bounded by code, not by data (names of columns or bands). The levels are counted when
    the function is called; the result is a plan over the buckets found.
    """
    rows = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("_v"))
    place = F.col("_v")
    if narrow:
        rows = rows.crossJoin(F.broadcast(df.agg(F.min(F.col(value).cast("double")).alias("_least"))))
        place = F.when(F.col("_least") > float("-inf"), place - F.col("_least")).otherwise(place)
    rows = rows.select(*keys, "_v", sort_key(place).alias("_k"))
    order = Window.partitionBy(*keys, "_b").orderBy("_v", "_k")
    parts = []
    for shift, wanted, few in wanted_buckets(rows, keys, probs, most):
        if few is None:  # the sum makes one value of both zeros, as grouping does
            parts.append(wanted.select(*keys, "_b", (F.col("_v") + F.lit(0.0)).alias("_v"), "_k", "_before", "_total", "_n",
                                       (F.col("_before") + F.col("_n")).alias("_end"), F.col("_before").alias("_start")))
            continue
        inside = _inside(rows, wanted, keys, shift, few or few_keys or not keys)
        counted = inside.groupBy(*keys, "_b", "_v", "_k", "_before", "_total").agg(F.count(F.lit(1)).alias("_n"))
        parts.append(counted.withColumn("_end", F.col("_before") + F.sum("_n").over(order)).withColumn("_start", F.col("_end") - F.col("_n")))
    ranked = reduce(DataFrame.unionByName, parts)
    if not narrow:  # grouping makes one key of both zeros
        ranked = ranked.withColumn("_v", F.when(F.col("_k") == -1, F.lit(-0.0)).otherwise(F.col("_v")))

    def at(rank: Column) -> Column:
        return F.max(F.when((rank >= F.col("_start")) & (rank < F.col("_end")), F.col("_v")))

    measures = []
    for name, p in probs.items():
        r = _rank(p)
        measures += [at(F.floor(r).cast("bigint")).alias(f"_{name}_lo"), at(F.ceil(r).cast("bigint")).alias(f"_{name}_hi"),
                     F.max(r - F.floor(r)).alias(f"_{name}_w")]
    picked = ranked.groupBy(*keys).agg(*measures)
    # differences of infinities are undefined, so they are weighed; equal ends need neither
    lo, hi, w = ((lambda n, e=e: F.col(f"_{n}_{e}")) for e in ("lo", "hi", "w"))
    endless = lambda n: (F.abs(lo(n)) == float("inf")) | (F.abs(hi(n)) == float("inf"))
    return picked.select(*keys, *[
        F.when((lo(n) == hi(n)) | (w(n) == 0), lo(n)).when(endless(n), lo(n) * (1 - w(n)) + hi(n) * w(n))
        .otherwise(lo(n) + (hi(n) - lo(n)) * w(n)).alias(n) for n in probs])


def percentiles_of_columns(df: DataFrame, columns: list[str], probs: dict[str, float],
                           where: dict[str, Column] | None = None, most: int = RANKED) -> DataFrame:
    """exact_percentiles for several columns at once: one row per column name.

    ``where`` optionally restricts which rows of a column count.
    """
    where = where or {}
    picked = df.select(*[F.when(where[c], F.col(c)).otherwise(F.lit(None)).cast("double").alias(c) if c in where
                         else F.col(c).cast("double").alias(c) for c in columns])
    long = picked.unpivot([], columns, "column_name", "_value")
    return exact_percentiles(long, ["column_name"], "_value", probs, few_keys=True, most=most)
