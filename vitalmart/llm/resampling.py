"""Data selection by importance resampling over hashed n-gram models."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import chunks, flat, record_batch, stored, text_rows

BUCKETS = 10_000
_REMEMBERED = 500_000


class _Hasher:
    """Buckets of a text's words and word pairs; word hashes are remembered per task."""

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All buckets of the texts one after the other, and how many each text has."""
        words = [t.lower().split() for t in texts]
        new = set().union(*words) - self.known.keys()
        if len(self.known) + len(new) > _REMEMBERED:
            self.known, new = {}, set().union(*words)
        self.known.update((w, xxhash.xxh32_intdigest(w)) for w in new)
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        h = np.fromiter(map(self.known.__getitem__, flat(words)), dtype=np.uint64, count=int(sizes.sum()))
        pairs = (h[:-1] * np.uint64(0x9E3779B1) + h[1:]) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)
        last = np.zeros(len(h), dtype=bool)
        last[np.cumsum(sizes)[sizes > 0] - 1] = True  # a text's last word starts no pair
        inside = ~last[:-1]
        doc = np.repeat(np.arange(len(words)), sizes)
        buckets = np.concatenate([h % np.uint64(BUCKETS), pairs[inside] % np.uint64(BUCKETS)]).astype(np.int32)
        docs = np.concatenate([doc, doc[:-1][inside]])
        order = np.argsort(docs, kind="stable")
        return buckets[order], np.bincount(docs, minlength=len(words))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher, sums = _Hasher(), np.zeros((2, BUCKETS), dtype=np.int64)
    for batch in chunks(batches, 4 << 20):
        buckets, sizes = hasher(batch.column("text").to_pylist())
        target = np.repeat(np.array(batch.column("target").to_pylist(), dtype=bool), sizes)
        sums[0] += np.bincount(buckets, minlength=BUCKETS)
        sums[1] += np.bincount(buckets[target], minlength=BUCKETS)
    used = np.flatnonzero(sums.any(axis=0))
    yield record_batch(pa.schema([("bucket", pa.int32()), ("raw", pa.int64()), ("target", pa.int64())]),
                       [used.astype(np.int32), sums[0, used], sums[1, used]])


def _weigh(ratio: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher = _Hasher()
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n_grams", pa.int64()), ("log_weight", pa.float64())])
    for batch in chunks(batches, 4 << 20):
        texts = batch.column("text").to_pylist()
        buckets, sizes = hasher(texts)
        sums = np.concatenate([[0.0], np.cumsum(ratio[buckets])])
        ends = np.cumsum(sizes)
        hashes = np.array([xxhash.xxh64_intdigest(t) for t in texts], dtype=np.uint64).view(np.int64)
        yield record_batch(schema, [batch.column("doc_id"), hashes, sizes, sums[ends] - sums[ends - sizes]])


def _gumbel(seed: int) -> Column:
    """Gumbel noise fixed by the row's id and text, so that a repeated task draws the same."""
    uniform = (F.xxhash64(F.lit(seed), "doc_id", "text_hash").bitwiseAND(F.lit((1 << 53) - 1)).cast("double") + 0.5) / float(1 << 53)
    return -F.log(-F.log(uniform))


def _key_bucket(key: Column) -> Column:
    """Order-preserving bucket of a finite double: sign times a logarithmic step of its size."""
    step = F.floor(F.log1p(F.abs(key)) * 4096).cast("bigint")
    return F.when(key < 0, -step - 1).otherwise(step)


def top_k(rows: DataFrame, key: str, k: int, ties: list[str]) -> DataFrame:
    """rows with boolean ``kept`` for the k largest keys; equal keys go by the ``ties`` columns.

    Keys are counted in a bounded number of order-preserving buckets; buckets above the one that
    holds the k-th key are kept, only that bucket is ranked row by row. Whatever k is, no
    more than one bucket meets in a task. Rows equal in all of these columns are ranked
    in any order.
    """
    rows = rows.withColumn("_bucket", _key_bucket(F.col(key)))
    counts = rows.groupBy("_bucket").agg(F.count("*").alias("n"))
    # a few hundred thousand buckets at most: log1p of a double is below 710
    above = counts.withColumn("upto", F.sum("n").over(Window.orderBy(F.desc("_bucket"))))
    cut = above.where(F.col("upto") >= k).agg(F.max("_bucket").alias("b")).first()["b"] if k > 0 else None
    if k <= 0:
        return rows.withColumn("kept", F.lit(False)).drop("_bucket")
    if cut is None:
        return rows.withColumn("kept", F.lit(True)).drop("_bucket")
    before = above.where(F.col("_bucket") > cut).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy(F.desc(key), *ties))
    edge = rows.where(F.col("_bucket") == cut).withColumn("kept", rank <= k - before)
    rest = rows.where(F.col("_bucket") != cut).withColumn("kept", F.col("_bucket") > cut)
    return edge.unionByName(rest).drop("_bucket")


def resample(docs: DataFrame, target_ids: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             share: float = 0.85, seed: int = 17, smoothing: float = 1.0) -> DataFrame:
    """One row per input row: doc_id, n_grams, log_weight, key, kept.

    Two bag models of hashed words and word pairs are counted over all texts: raw (every row)
    and target (rows whose id is in ``target_ids``). log_weight is the log ratio of their
    probabilities of the text; key adds Gumbel noise. Keeping the largest keys (a share of
    all rows, rounded) draws that many rows without replacement in proportion to their weights.

    NULL and word-less texts have weight 0, like all texts when there is no target. Repeated
    rows draw the same noise. NULL ids are never targets. Equal keys go by doc_id, then text.
    """
    named = target_ids.select(F.col(target_ids.columns[0]).cast("bigint").alias("doc_id")).where("doc_id is not null").distinct()
    rows = text_rows(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    # The one shuffle of texts, at any size of the target; adaptive execution splits an id that holds many rows.
    both = rows.join(named.withColumn("target", F.lit(True)).hint("merge"), "doc_id", "left").select(
        "text", F.coalesce("target", F.lit(False)).alias("target"))
    sums = both.mapInArrow(_count, "bucket int, raw bigint, target bigint").groupBy("bucket").agg(
        F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    sums = stored(sums, "ngrams").toArrow()  # at most BUCKETS rows
    counts = np.zeros((2, BUCKETS))
    counts[:, sums["bucket"].to_numpy()] = sums["raw"].to_numpy(), sums["target"].to_numpy()
    raw, target = ((c + smoothing) / (c.sum() + smoothing * BUCKETS) for c in counts)
    ratio = np.log(target) - np.log(raw) if counts[1].sum() else np.zeros(BUCKETS)
    weights = rows.mapInArrow(partial(_weigh, ratio), "doc_id bigint, text_hash bigint, n_grams bigint, log_weight double")
    weights = stored(weights.withColumn("key", F.col("log_weight") + _gumbel(seed)), "weights")
    k = round(share * weights.count())
    return top_k(weights, "key", k, ["doc_id", "text_hash"]).select("doc_id", "n_grams", "log_weight", "key", "kept")

