"""SimHash near-duplicates found through tables of Hamming distances to pivots."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import record_batch, stored, text_rows
from .components import connected_components

BITS, GROUPS, PER_GROUP = 64, 4, 8
WIDTH = BITS // GROUPS
# A bucket of more members has more pairs than its members have neighbouring points.
PAIRED = 128

_FP = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """64-bit SimHash as a signed integer; 0 for a text without words."""
    words = text.lower().split()  # bytes: A-Z only, cut at \x20 and \x09-\x0D
    if not words:
        return 0
    rows = [words] if len(words) <= shingle else zip(*(words[i:] for i in range(shingle)))
    hashes = np.fromiter((xxhash.xxh64_intdigest(b" ".join(r), 42) for r in rows), dtype="<u8")
    counts = sum(np.unpackbits(hashes[i:i + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
        axis=0, dtype=np.int64) for i in range(0, len(hashes), 65536))
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<i8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text")
        yield record_batch(_FP, [batch.column("doc_id"), [fingerprint(t.as_py()) for t in texts]])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id bigint, fp bigint) for every input row; NULL and word-less texts get 0."""
    rows = text_rows(docs, id_col, text_col)
    return rows.withColumn("doc_id", F.col("doc_id").cast("bigint")).mapInArrow(_fingerprints, "doc_id bigint, fp bigint")


def pivots() -> list[int]:
    """The reference fingerprints: a base, and PER_GROUP for each group of bits that differ
    from it inside that group only. The difference of two distances then depends on the
    bits of one group, so a change elsewhere leaves it alone."""
    base = xxhash.xxh64_intdigest(b"pivot")
    patterns = [xxhash.xxh64_intdigest(b"pivot", seed) % ((1 << WIDTH) - 1) + 1 for seed in range(1, PER_GROUP * GROUPS + 1)]
    return [base] + [base ^ (p << (WIDTH * (i // PER_GROUP))) for i, p in enumerate(patterns)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def pivot_table(fps: DataFrame) -> DataFrame:
    """Distinct fingerprints with ``d``: their Hamming distances to all pivots."""
    return fps.select("fp", F.array(*(F.bit_count(F.col("fp").bitwiseXOR(F.lit(_signed(p)))).cast("tinyint")
                                      for p in pivots())).alias("d"))


def _keys(limit: int) -> Column:
    """One bucket key per way to keep GROUPS - limit groups: the pivot coordinates of these groups."""
    coordinate = lambda g: [F.col("d")[1 + g * PER_GROUP + i] - F.col("d")[0] for i in range(PER_GROUP)]
    keep = list(combinations(range(GROUPS), GROUPS - limit))
    return F.array(*(F.struct(F.lit(i).alias("way"),
                              F.xxhash64(F.lit(i), *(c for g in groups for c in coordinate(g))).alias("key"))
                     for i, groups in enumerate(keep)))


def near_links(fps: DataFrame, limit: int = 2) -> DataFrame:
    """Links (a, b) between distinct fingerprints, enough to connect all within ``limit`` bits.

    ``limit`` changed bits touch at most ``limit`` of the groups, so two near fingerprints
    agree in all pivot coordinates of the other groups and meet in that bucket. Inside a
    bucket pairs whose distances to any pivot differ by more than ``limit`` are discarded
    (triangle inequality); what is left is verified by its own Hamming distance. A bucket
    with more than PAIRED members is not paired: there each member is linked to the
    smallest member sharing a point one bit away (limit 2) or at hand (limit 0 or 1), which
    is exact and linear.
    """
    if not 0 <= limit < GROUPS - 1 or limit > 2:
        raise ValueError("limit must be 0, 1 or 2")
    keyed = pivot_table(fps).select("fp", "d", F.explode(_keys(limit)).alias("k")).select("fp", "d", "k.way", "k.key")
    sizes = keyed.groupBy("way", "key").agg(F.count("*").alias("n")).where("n > 1")
    keyed = stored(keyed.join(sizes, ["way", "key"]), "buckets")
    small = keyed.where(F.col("n") <= PAIRED)
    a, b = small.alias("x"), small.alias("y")
    apart = F.greatest(*(F.abs(F.col("x.d")[i] - F.col("y.d")[i]) for i in range(1 + PER_GROUP * GROUPS)))
    pairs = a.join(b, (F.col("x.way") == F.col("y.way")) & (F.col("x.key") == F.col("y.key")) & (F.col("x.fp") < F.col("y.fp"))
                   & (apart <= limit)
                   & (F.bit_count(F.col("x.fp").bitwiseXOR(F.col("y.fp"))) <= limit))
    pairs = pairs.select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b"))
    flips = F.array(F.lit(0).cast("bigint"), *(F.lit(_signed(1 << i)) for i in range(BITS)))
    points = keyed.where(F.col("n") > PAIRED).select("way", "key", "fp", F.explode(flips).alias("flip")).select(
        "way", "key", "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("point"), F.when(F.col("flip") == 0, F.col("fp")).alias("own"))
    # at most 65 fingerprints lie one bit from a point, so no window grows with the group
    around = Window.partitionBy("way", "key", "point")
    if limit == 2:
        stars = points.withColumn("a", F.min("fp").over(around))
    else:
        stars = points.withColumn("a", F.min("own").over(around))
    stars = stars.where("a is not null").select("a", F.col("fp").alias("b"))
    if limit == 0:
        stars = stars.where("false")
    return pairs.unionByName(stars.where("a <> b").dropDuplicates())


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = 2) -> DataFrame:
    """(doc_id bigint, fp bigint, component_id bigint), one row per input row.

    component_id is the smallest doc_id reachable over links of ``limit`` or fewer differing
    bits. Equal fingerprints are one node, so copies are never paired. NULL and word-less
    texts share fingerprint 0 and are linked like any other; rows with NULL doc_id belong to
    their class but name it only if no other id does (then component_id is NULL). Repeated
    rows stay. An empty table gives an empty result.
    """
    base = stored(fingerprints(docs, id_col, text_col), "fingerprints")
    firsts = base.groupBy("fp").agg(F.min("doc_id").alias("first"))
    classes = connected_components(near_links(firsts.select("fp"), limit))
    members = classes.select(F.col("node").alias("fp"), "root")
    named = members.join(firsts, "fp").groupBy("root").agg(F.min("first").alias("least"))
    linked = members.join(named, "root").select("fp", "least")
    component = firsts.join(linked, "fp", "left").select("fp", F.coalesce("least", "first").alias("component_id"))
    return base.join(component, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = 2) -> DataFrame:
    """The input's rows, one document per class: that with the smallest id.

    All columns and rows of kept ids stay as they are; rows with NULL id stay, as nothing
    names them. Only classes with a later member reach the anti-join's right side.
    """
    rows = near_duplicates(docs, id_col, text_col, limit)
    gone = rows.where(F.col("doc_id") > F.col("component_id")).select(F.col("doc_id").alias(id_col)).distinct()
    return docs.join(gone, id_col, "left_anti")
