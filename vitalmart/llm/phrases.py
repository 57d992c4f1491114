"""Benchmark decontamination on a positional inverted index."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, flat, record_batch, row_key, stored, text_rows, without_rows

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")  # on lower-cased UTF-8: the complement of \x00-\x2F \x3A-\x60 \x7B-\x7F
SEGMENT_BYTES = 4 << 20
WINDOWS_PER_PASS = 200_000
# Parquet's writer first looks at its buffer after 100 rows, and readers take a row group's rows at once: blocks are megabytes each.
_ONE_BY_ONE = {"parquet.block.row.count.limit": 1}

_SEGMENT = pa.schema([("segment", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("n_words", pa.list_(pa.int32())),
                      ("terms", pa.list_(pa.binary())), ("ends", pa.list_(pa.int32())), ("positions", pa.list_(pa.int32()))])
_MATCH = pa.schema([("segment", pa.int64()), ("ordinal", pa.int32()), ("item_id", pa.int64()), ("near", pa.bool_()),
                    ("first", pa.int32()), ("last", pa.int32())])
_MATCH_SQL = "segment bigint, ordinal int, item_id bigint, near boolean, first int, last int"


def words(text: bytes) -> list[bytes]:
    return _WORD.findall(text.lower())


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    task = TaskContext.get().partitionId() << 32
    for number, batch in enumerate(chunks(batches, SEGMENT_BYTES)):
        found = [words(t.as_py()) for t in batch.column("text")]
        sizes = np.fromiter(map(len, found), dtype=np.int64)
        ids: dict[bytes, int] = defaultdict()
        ids.default_factory = ids.__len__
        tokens = np.fromiter(map(ids.__getitem__, flat(found)), dtype=np.int32, count=int(sizes.sum()))
        # one free position after each document keeps phrases from running into the next
        places = np.arange(len(tokens), dtype=np.int32) + np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        order = np.argsort(tokens, kind="stable")
        ends = np.cumsum(np.bincount(tokens, minlength=len(ids)), dtype=np.int32)
        yield record_batch(_SEGMENT, [[task + number], [batch.column("doc_id").to_pylist()], [sizes.astype(np.int32)],
                                      [list(ids)], [ends], [places[order]]])


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The positional inverted index, split by documents: one row per block of documents.

    terms[i] occurs at positions[ends[i-1]:ends[i]], ascending; documents lie one after the
    other with one free position between. Every word of every text is in it. A block holds
    about SEGMENT_BYTES of text, or one longer document. Segment numbers follow partitions,
    so write the index before use.
    """
    rows = text_rows(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    return rows.mapInArrow(_segments, "segment bigint, doc_ids array<bigint>, n_words array<int>, "
                                      "terms array<binary>, ends array<int>, positions array<int>")


def _hits(lists: list[tuple[int, np.ndarray]]) -> np.ndarray:
    """Starts of a phrase: position lists by offset, met from the shortest list on."""
    lists = sorted(lists, key=lambda x: len(x[1]))
    offset, starts = lists[0]
    starts = starts - offset
    for offset, places in lists[1:]:
        if not len(starts):
            break
        at = np.searchsorted(places, starts + offset)
        starts = starts[places[np.minimum(at, len(places) - 1)] == starts + offset]
    return starts


def _around(places: np.ndarray, lists: list[np.ndarray], begins: np.ndarray, ends: np.ndarray, reach: int) -> np.ndarray:
    """Those of ``places`` that have a place of every list within ``reach`` words in the same document."""
    for other in lists:
        if not len(places):
            break
        doc = np.searchsorted(begins, places, side="right") - 1
        low, high = np.maximum(places - reach, begins[doc]), np.minimum(places + reach, ends[doc] - 1)
        at = np.searchsorted(other, low)
        places = places[(at < len(other)) & (other[np.minimum(at, len(other) - 1)] <= high)]
    return places


def _near(lists: list[np.ndarray], begins: np.ndarray, ends: np.ndarray, reach: int) -> np.ndarray:
    """Places of any of the terms with every other term within ``reach`` words in the same document.

    Around such a place the block's rarest term has all others within twice the reach, so its
    places choose the documents; that every term may be the middle makes the outcome of a
    document the same whatever lies in its block.
    """
    lists = sorted(lists, key=len)
    found = _around(lists[0], lists[1:], begins, ends, 2 * reach)
    if not len(found):
        return found
    docs = np.unique(np.searchsorted(begins, found, side="right") - 1)
    cut = [x[np.isin(np.searchsorted(begins, x, side="right") - 1, docs)] for x in lists]
    return np.concatenate([_around(x, cut[:i] + cut[i + 1:], begins, ends, reach) for i, x in enumerate(cut)])


def _search(terms: pa.Array, windows: np.ndarray, items: np.ndarray, reach: int,
            batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """windows: rows of term numbers, -1 beyond the end of a short one; items: the item of each."""
    for batch in batches:
        for row in range(batch.num_rows):
            get = lambda name: batch.column(name)[row].values  # noqa: E731, B023
            if not len(get("terms")):
                continue
            own = pc.fill_null(pc.index_in(terms, value_set=get("terms")), -1).to_numpy(zero_copy_only=False)
            ends, positions = get("ends").to_numpy(), get("positions").to_numpy()
            sizes = get("n_words").to_numpy().astype(np.int64)
            begins = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
            there = np.append(own, 0) >= 0  # the last stands for -1: nothing asked
            out: list[tuple] = []
            for w in np.flatnonzero(there[windows].all(axis=1)):
                asked = windows[w][windows[w] >= 0]
                lists = [positions[ends[t - 1] if t else 0:ends[t]] for t in own[asked]]
                starts = _hits(list(enumerate(lists)))
                if len(starts):
                    out.append((starts, starts + len(asked) - 1, items[w], False))
                if reach:
                    places = _near([positions[ends[t - 1] if t else 0:ends[t]] for t in set(own[asked].tolist())], begins, begins + sizes, reach)
                    if len(places) and len(starts):  # a document with the phrase itself is no near one
                        of = lambda x: np.searchsorted(begins, x, side="right")  # noqa: E731, B023
                        places = places[~np.isin(of(places), of(starts))]
                    if len(places):
                        out.append((places, places, items[w], True))
            if out:
                counts = [len(x[0]) for x in out]
                first, last = (np.concatenate([x[i] for x in out]) for i in (0, 1))
                doc = np.searchsorted(begins, first, side="right") - 1
                yield record_batch(_MATCH, [
                    np.full(len(first), batch.column("segment")[row].as_py()), doc.astype(np.int32),
                    np.repeat([x[2] for x in out], counts), np.repeat([x[3] for x in out], counts),
                    (first - begins[doc]).astype(np.int32), (last - begins[doc]).astype(np.int32)])


def windows_of(items: DataFrame, id_col: str = "item_id", text_col: str = "text", size: int = 10) -> DataFrame:
    """(item_id, words array<binary>): each item's distinct runs of ``size`` words; a shorter
    item is one run; an item without words has none."""
    def cut(batches):
        schema = pa.schema([("item_id", pa.int64()), ("words", pa.list_(pa.binary()))])
        for batch in batches:
            for item, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                w = words(text)
                found = list(dict.fromkeys(tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1)))) if w else []
                if found:
                    yield record_batch(schema, [[item] * len(found), [list(x) for x in found]])

    rows = text_rows(items, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    return rows.mapInArrow(cut, "item_id bigint, words array<binary>").distinct()


def search(index: DataFrame, windows: DataFrame, reach: int = 0) -> DataFrame:
    """Matches (segment, ordinal, item_id, near, first, last) of the windows in a written index.

    Exact phrases have near = false and the words first..last of the ordinal-th document of
    the segment. With ``reach``, a window also gives its proximity matches (near = true) in
    documents that do not hold it exactly: places of one of its terms that have all other
    terms within ``reach`` words of the same document, in any order. Whether a document
    matches depends on its own words alone, not on its block.

    The windows go over the index in blocks of at most WINDOWS_PER_PASS, so what tasks get
    at once is bounded whatever the benchmark's size; the index is not shuffled.
    """
    spark = index.sparkSession
    total = windows.count()
    blocks = -(-total // WINDOWS_PER_PASS)
    found = spark.createDataFrame([], _MATCH_SQL)
    for block in range(blocks):
        part = windows if blocks == 1 else windows.where(F.pmod(F.xxhash64("words", "item_id"), F.lit(blocks)) == block)
        rows = part.toArrow()
        if not rows.num_rows:
            continue
        lists = rows["words"].combine_chunks()
        coded = pc.dictionary_encode(lists.flatten())
        sizes = pc.list_value_length(lists).to_numpy()
        grid = np.full((rows.num_rows, int(sizes.max())), -1, dtype=np.int32)
        grid[np.arange(grid.shape[1]) < sizes[:, None]] = coded.indices.to_numpy()
        items = np.array(rows["item_id"].fill_null(-1).to_pylist(), dtype=np.int64)
        found = found.unionByName(index.mapInArrow(partial(_search, coded.dictionary, grid, items, reach), _MATCH_SQL))
    return found


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id_col: str = "item_id", item_text_col: str = "text", size: int = 10, reach: int = 15) -> DataFrame:
    """One row per input row: doc_id, n_words, n_hit, items (ids of items with a window in the
    text, sorted as strings), near_items (ids of items with only proximity matches).

    Words are runs of [0-9a-z] and non-ASCII characters after lower-casing A-Z. A word inside
    any occurrence of a window is hit, counted once however many windows cover it. NULL and
    word-less texts have no words; repeated rows and repeated or NULL doc_ids stay rows of
    their own. NULL item_ids read as -1. No items: nothing is hit.
    """
    index = stored(build_index(docs, id_col, text_col), "postings", **_ONE_BY_ONE)
    found = search(index, windows_of(items, item_id_col, item_text_col, size), reach)
    spans = F.array_sort(F.collect_set(F.when(~F.col("near"), F.struct("first", "last"))))
    covered = F.aggregate("spans", F.struct(F.lit(0).alias("n"), F.lit(-1).alias("end")), lambda acc, s: F.struct(
        (acc["n"] + F.greatest(F.lit(0), s["last"] - F.greatest(acc["end"], s["first"] - 1))).alias("n"),
        F.greatest(acc["end"], s["last"]).alias("end")), lambda acc: acc["n"])
    exact, near = F.collect_set(F.when(~F.col("near"), F.col("item_id"))), F.collect_set(F.when(F.col("near"), F.col("item_id")))
    per_doc = found.groupBy("segment", "ordinal").agg(spans.alias("spans"), exact.alias("items"), near.alias("near")).select(
        "segment", "ordinal", covered.alias("n_hit"), "items", F.array_except("near", "items").alias("near"))
    as_text = lambda c: F.array_sort(F.transform(F.coalesce(F.col(c), F.array().cast("array<bigint>")), lambda i: i.cast("string")))
    rows = index.select("segment", F.posexplode(F.arrays_zip("doc_ids", "n_words")).alias("ordinal", "doc"))
    return rows.join(per_doc, ["segment", "ordinal"], "left").select(
        F.col("doc.doc_ids").alias("doc_id"), F.col("doc.n_words").cast("bigint").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"), as_text("items").alias("items"),
        as_text("near").alias("near_items"))


def without_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         by_row: bool = False, **more) -> DataFrame:
    """The input's rows whose text holds no window of an item. With ``by_row`` every row follows
    its own verdict, also where ids are NULL or repeated. Otherwise ids are dropped: rows with
    NULL id cannot be named and stay; of rows sharing an id all go if one is contaminated."""
    if by_row:
        rows = docs.select(row_key(id_col, text_col).alias("key"), F.col(text_col).alias("text"))
        hit = contamination(rows, items, "key", reach=0, **more).where("n_hit > 0")
        return without_rows(docs, hit.select("doc_id"), id_col, text_col)
    hit = contamination(docs, items, id_col, text_col, reach=0, **more).where("n_hit > 0")
    return docs.join(hit.select(F.col("doc_id").alias(id_col)).distinct(), id_col, "left_anti")
