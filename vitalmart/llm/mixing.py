"""Mixing sources to target weights by thresholds on a hash of each document.

Every document has a place in a fixed pseudo-random order: a hash of its id, then one of its text,
then the number of its row in a written table, which only tells apart rows that are equal in both. A source
whose target is f times its size and a rest takes all its documents floor(f) times and once more
those that come first in that order until the rest is used up. The threshold is found without sorting:
sizes are summed by source and leading bits of the hash, the bucket in which the budget ends is found
in those sums, and only its documents are summed again by the next bits, until it holds one document.
Larger budgets give larger thresholds of the same order, so a larger mix contains every smaller one.

Edge cases: a NULL or empty text has size 0 and nothing is taken from it. A NULL source is a source of
its own, last in order. NULL ids and repeated rows are documents like any other; of equal rows it is
only defined how many are taken once more. A source without words has target 0. An empty table gives
an empty result. Columns other than those named are not read unless asked for by ``carry``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitalmart.operators.windows import number_rows

from .common import stored, words_of

WEIGHTS = (5, 2, 1)
REPEATS = 3
DIGIT = 12  # bits of the hash a round of refinement looks at
SMALL_PLAN = 100_000  # sources up to which their thresholds are sent to all tasks
_LEVELS = 5  # digits in 60 bits of hash


def place_hash(id_col: str) -> Column:
    """60 bits of the MD5 of the id's decimal text, as every SQL engine can compute them."""
    text = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint")


def _digit(level: int) -> Column:
    """The bits of a round: five rounds look at the id's hash, five at the text's, five at the row's number."""
    part, place = divmod(level, _LEVELS)
    return F.shiftright(F.col(("_h", "_t", "_r")[part]), DIGIT * (_LEVELS - 1 - place)).bitwiseAND((1 << DIGIT) - 1).cast("int")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS, share: float = 1.0) -> DataFrame:
    """Per source (column ``source``, with ``source_size``): weight, and the target its share comes to.

    Targets divide ``share`` of all sizes by weight. A source that would need more than ``repeats`` times
    its size stops there and what is left is divided among the others again, until no target is above.
    Each round is one aggregate over the sources; what reaches the driver are three sums.
    """
    wheel = F.array(*[F.lit(int(w)) for w in weights])
    last = sizes.select("source", "source_size", F.col("source").isNull().alias("_last"))
    ranked = number_rows(last, [], ["_last", "source"], "_rank").select(
        "source", "source_size", wheel[((F.col("_rank") - 1) % len(weights)).cast("int")].alias("weight"))
    ranked = stored(ranked, "source-weights")
    total = (ranked.agg(F.sum("source_size").alias("s")).first()["s"] or 0) * share
    most, capped = F.col("source_size") * repeats, F.lit(False)
    while True:
        sums = ranked.where(capped).agg(F.sum(most).alias("size"), F.count(F.lit(1)).alias("n")).first()
        weight = ranked.where(~capped).agg(F.sum("weight").alias("w")).first()["w"]
        rest = float(total - (sums["size"] or 0))
        fair = F.lit(rest) * F.col("weight") / F.lit(float(weight or 1))
        now = capped | (fair > most)
        if ranked.where(now).count() == sums["n"]:
            return ranked.withColumn("target", F.when(capped, most.cast("double")).otherwise(fair))
        # the set of capped sources only grows; as a column of a written table it needs no nested expression
        ranked = stored(ranked.select("source", "source_size", "weight", now.alias("_capped")), "source-weights")
        capped = F.col("_capped")


def _joined(rows: DataFrame, plan: DataFrame, small: bool) -> DataFrame:
    plan = plan.withColumnRenamed("source", "_of")
    return rows.join(F.broadcast(plan) if small else plan, F.col("source").eqNullSafe(F.col("_of"))).drop("_of")


def thresholds(rows: DataFrame, plan: DataFrame, small: bool) -> DataFrame:
    """Per source the digits ``_path`` of the order at which its rest budget ``_rest`` ends.

    A round sums size and rows of the sources still open by the next digit. The rest ends in the last
    bucket that starts before it is used up; while that bucket holds more than one row, it alone is
    looked into. ``_with`` tells whether the last bucket is taken as well: if that comes nearer to the rest.
    """
    bits = F.array(*[_digit(i) for i in range(3 * _LEVELS)])
    open_, settled = stored(plan.where("_rest > 0").select("source", "_rest", F.array().cast("array<int>").alias("_path")), "mix-open"), []
    for level in range(3 * _LEVELS):
        inside = _joined(rows, open_, small).where(F.slice(bits, 1, level) == F.col("_path")) if level else _joined(rows, open_, small)
        buckets = inside.groupBy("source", "_rest", "_path", _digit(level).alias("_d")).agg(F.sum("size").alias("_size"), F.count(F.lit(1)).alias("_n"))
        order = Window.partitionBy("source").orderBy("_d")
        ends = buckets.withColumn("_before", F.sum("_size").over(order) - F.col("_size"))
        # the last bucket that starts before the rest is used up
        ends = ends.where(F.col("_before") < F.col("_rest")).withColumn("_nth", F.row_number().over(Window.partitionBy("source").orderBy(F.desc("_d"))))
        found = stored(ends.where("_nth = 1").select(
            "source", (F.col("_rest") - F.col("_before")).alias("_rest"), F.concat("_path", F.array("_d")).alias("_path"), "_size", "_n"), "mix-bucket")
        one = (F.col("_n") == 1) | F.lit(level == 3 * _LEVELS - 1)
        settled.append(found.where(one).select("source", "_path", (F.col("_rest") >= F.col("_size") / 2).alias("_with")))
        open_ = found.where(~one).select("source", "_rest", "_path")
        if open_.isEmpty():
            break
    out = settled[0]
    for part in settled[1:]:
        out = out.unionByName(part)
    return out


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", *,
        weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS, share: float = 1.0, carry: tuple[str, ...] = ()) -> DataFrame:
    """Per row: doc_id, source, size, source_size, target, times (how often the mix holds it), taken
    (size times that), and the columns of ``carry`` as they are.

    A source's taken words differ from its target by half a document at most. Texts are read once;
    the rounds read ids, sizes and hashes. A hot source is summed in all tasks before anything is
    shuffled. The same table gives the same mix on every run.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                       F.size(words_of(F.col(text_col))).cast("bigint").alias("size"), place_hash(id_col).alias("_h"),
                       F.shiftrightunsigned(F.xxhash64(F.col(text_col)), 4).alias("_t"),
                       F.monotonically_increasing_id().alias("_id"),
                       *([F.struct(*[F.col(c) for c in carry]).alias("_carried")] if carry else []))
    rows = stored(rows, "mix-rows").withColumn("_r", F.shiftrightunsigned(F.xxhash64("_id"), 4))
    sources = stored(rows.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sources")
    small = sources.limit(SMALL_PLAN + 1).count() <= SMALL_PLAN
    plan = source_targets(sources, weights, repeats, share)
    whole = F.coalesce(F.floor(F.try_divide(F.col("target"), F.col("source_size"))), F.lit(0)).cast("bigint")
    plan = plan.withColumn("_whole", whole).withColumn("_rest", F.col("target") - F.col("_whole") * F.col("source_size"))
    plan = stored(plan, "mix-plan")
    ends = thresholds(rows, plan, small).withColumnRenamed("source", "_of")
    plan = plan.join(ends, F.col("source").eqNullSafe(F.col("_of")), "left").select(
        "source", "source_size", "target", "_whole", "_path", "_with")
    bits = F.array(*[_digit(i) for i in range(3 * _LEVELS)])
    head = F.slice(bits, 1, F.size("_path"))
    extra = F.col("_path").isNotNull() & ((head < F.col("_path")) | ((head == F.col("_path")) & F.col("_with")))
    times = F.col("_whole") + F.when(extra, 1).otherwise(0)
    return _joined(rows, plan, small).select(
        "doc_id", "source", "size", "source_size", "target", times.alias("times"), (times * F.col("size")).alias("taken"),
        *[F.col("_carried")[c].alias(c) for c in carry])
