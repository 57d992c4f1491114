"""Incremental, referential and range joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalmart.functions.numeric import col, flag
from vitalmart.sources.writers import held

from .windows import number_rows

BANDS_PER_BIN = 4  # of bands that do not overlap
MOST_BINS = 65_536  # their cuts reach every task as one row
SMALL_BANDS = 20_000  # bands sent to all tasks
PIECES = 256  # tasks that at least share the rows, whatever the values


def new_rows(source: DataFrame, target: DataFrame, key: str, target_key: str | None = None) -> DataFrame:
    """Rows whose key the target does not have yet.

    Target keys are reduced to distinct non-NULL ones first. A source row with a
    NULL key is never new, as in NOT IN.
    """
    seen = (target.select(F.col(target_key or key).alias("_k")).where(F.col("_k").isNotNull()).distinct())
    return source.where(F.col(key).isNotNull()).join(seen, F.col(key) == F.col("_k"), "left_anti")


def missing_parents(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child keys without parent, with the number of rows that use them.

    Children are counted per key before the join, so a key that owns a large
    part of the table is one row in the shuffle.
    """
    used = (child.where(F.col(child_key).isNotNull()).groupBy(F.col(child_key).alias("missing_key"))
            .agg(F.count(F.lit(1)).alias("row_count")))
    known = parent.select(F.col(parent_key).alias("_k")).distinct()
    # an outer join, not an anti join: the optimizer moves anti joins below the
    # count and would shuffle the uncounted rows
    return used.join(known, F.col("missing_key") == F.col("_k"), "left").where(F.col("_k").isNull()).drop("_k")


def salted_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner", salts: int = 1,
                spread: list[str] | None = None, hot_share: float = 0.01) -> DataFrame:
    """Equi-join; with salts > 1 the hot left keys are spread over that many tasks.

    A key is hot when it owns more than ``hot_share`` of the left rows, so there
    are at most 1 / hot_share hot keys: that bounds the broadcast lists and the
    right rows that are repeated. Left rows with a NULL key match nothing and are
    spread as well. ``spread`` are left columns that differ between rows of one
    key. AQE splits skewed partitions at run time; salts are for keys known to be
    hot beyond that.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError("salting repeats the right side, so the left side must drive the join")
    if salts <= 1:
        return left.join(right, keys, how)
    counts = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n").alias("t")).scalar()
    hot = counts.where(F.col("_n") > total * F.lit(hot_share)).select(*keys, F.lit(True).alias("_hot"))
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in (spread or left.columns)]), F.lit(salts)).cast("int")
    marked = left.join(F.broadcast(hot), keys, "left").withColumn(
        "_salt", F.when(F.col("_hot") | any_null, salt).otherwise(F.lit(0))).drop("_hot")
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    repeated = right.join(F.broadcast(hot), keys, "left").withColumn("_salt", F.explode(copies)).drop("_hot")
    return marked.join(repeated, [*keys, "_salt"], how).drop("_salt")


def _bin_of(value: Column, cuts: Column, n: int) -> Column:
    """Number of cuts <= value by binary search in the sorted array ``cuts`` of n doubles; NULL is in bin 0.

    The comparisons are Spark's: NaN is the largest value.
    """
    top = 1 << max(0, n.bit_length() - 1)
    steps = F.array(*[F.lit(top >> i) for i in range(top.bit_length())])

    def step(at: Column, by: Column) -> Column:
        return F.when((at + by <= n) & (F.try_element_at(cuts, at + by) <= value), at + by).otherwise(at)

    return F.aggregate(steps, F.lit(0), step)


def _cuts(bands: DataFrame, low: Column, bins: int, n_bands: int, small: bool) -> tuple[Column, int]:
    """Every so many-th of the bands' lower ends in order, as one array, and their number. The array is a constant of
    the plan: every task has it once, where a joined column would be copied from row to row."""
    ends, every = bands.select(low.alias("_end")), -(-n_bands // bins) or 1
    if small:
        cuts = sorted(r["_end"] for r in ends.collect())[::every]
    else:
        cuts = [r["_end"] for r in number_rows(ends, [], ["_end"], "_nth").where(F.col("_nth") % every == 1 % every).orderBy("_end").collect()]
    cuts = list(dict.fromkeys(cuts))
    # one text is one call to the JVM; the optimizer reads it once
    return F.split(F.lit(",".join(map(repr, cuts))), ",").try_cast("array<double>"), len(cuts)


def band_join(df: DataFrame, bands: DataFrame, x: str, lo: str, hi: str, how: str = "left", bins: int | None = None,
              small: int = SMALL_BANDS) -> DataFrame:
    """Rows with every band [lo, hi) that holds x; bands may overlap and have open ends.

    Bins are cut at quantiles of the bands' lower ends, a few bands to a bin, so the number of bins
    follows the number of bands. A band stands in every bin it touches, a row in one, and
    the exact test follows on equal bins. A band table counted to have at most ``small`` rows is sent
    to all tasks and df is not shuffled. Beyond, both sides are shuffled by bin; the rows of every bin
    are counted first, and a bin with more than its share of them is dealt over several tasks, each with the
    bands of that bin. NULL and NaN values, and bands with NULL ends, match nothing.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError("bands are repeated per bin, so the rows must drive the join")
    value = F.col(x).cast("double")
    low, high = F.col(lo).cast("double"), F.col(hi).cast("double")
    inside = (value >= F.col(lo)) & (value < F.col(hi))
    bands = held(bands.where(low.isNotNull() & high.isNotNull()), "bands", small)
    n_bands = bands.count()
    cuts, n = _cuts(bands, low, bins or min(MOST_BINS, 1 + n_bands // BANDS_PER_BIN), n_bands, n_bands <= small)
    first = _bin_of(low, cuts, n)
    binned = bands.withColumn("_band_bin", F.explode(F.sequence(first, F.greatest(first, _bin_of(high, cuts, n)))))
    rows = df.withColumn("_row_bin", _bin_of(value, cuts, n))
    same = F.col("_row_bin") == F.col("_band_bin")
    if n_bands <= small:
        return rows.join(F.broadcast(binned), same & inside, how).drop("_band_bin", "_row_bin")
    counts = rows.groupBy("_row_bin").agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n").alias("t")).first()["t"] or 0
    # at most PIECES bins are above their share, in at most 2 * PIECES pieces
    hot = held(counts.select(F.col("_row_bin").alias("_hot_bin"), F.ceil(F.col("_n") * PIECES / F.lit(max(total, 1))).cast("int").alias("_pieces"))
               .where("_pieces > 1"), "hot-bins", PIECES)
    piece = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.coalesce("_pieces", F.lit(1))).cast("int")
    rows = rows.join(F.broadcast(hot), F.col("_row_bin") == F.col("_hot_bin"), "left").withColumn("_row_piece", piece).drop("_hot_bin", "_pieces")
    binned = binned.join(F.broadcast(hot), F.col("_band_bin") == F.col("_hot_bin"), "left").withColumn(
        "_band_piece", F.explode(F.sequence(F.lit(0), F.coalesce("_pieces", F.lit(1)) - 1))).drop("_hot_bin", "_pieces")
    return rows.join(binned, same & (F.col("_row_piece") == F.col("_band_piece")) & inside, how).drop(
        "_band_bin", "_row_bin", "_band_piece", "_row_piece")


def half_open(bands: list[tuple], names: list[str], spark) -> DataFrame:
    """Inclusive (label, lo, hi, ...) rows as [lo, next lo) intervals without gaps.

    The last band keeps its published upper end, made inclusive.
    """
    rows = []
    for i, (label, lo, hi, *rest) in enumerate(bands):
        upper = float(bands[i + 1][1]) if i + 1 < len(bands) else float(hi) + 1e-9
        rows.append((label, float(lo), upper, *rest))
    return spark.createDataFrame(rows, names)


def predictions_with_actuals(predictions: DataFrame, actuals: DataFrame, key: str, salts: int = 1) -> DataFrame:
    """Predictions joined to the known outcome, plus a hit flag."""
    joined = salted_join(predictions, actuals, [key], "inner", salts)
    return joined.withColumn("is_correct", flag(F.col("predicted") == F.col("actual")))


def attach_scalars(df: DataFrame, **scalars: Column) -> DataFrame:
    """Single values from other tables (scalar subqueries) as columns."""
    return df.withColumns({n: col(c) for n, c in scalars.items()})
