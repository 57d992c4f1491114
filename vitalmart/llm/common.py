"""Helpers the operators share: scratch tables, batch access, stable keys."""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from functools import reduce
from operator import or_

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalmart.sources.writers import scratch_path

# Bytes split() without arguments cuts at exactly these: \x20 and \x09-\x0D.
SPACES = "[\\x20\\x09-\\x0D]"
_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str, **options: object) -> DataFrame:
    """Write df below the shared checkpoint folder and read it back.

    Cuts the lineage with files every executor can reach, so a lost executor costs
    no recomputation of what came before. The shuffle files of the write have no reader
    after it and are removed at its end. ``options`` go to the writer.
    """
    path, conf = scratch_path(df.sparkSession, name), df.sparkSession.conf
    before = conf.get(_FREE_SHUFFLES, "false")
    conf.set(_FREE_SHUFFLES, "true")
    try:
        df.write.options(**options).parquet(path)
    finally:
        conf.set(_FREE_SHUFFLES, before)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.scratch = path
    return table


def discard(*tables: DataFrame) -> None:
    """Remove tables that ``stored`` wrote, once nothing that is still to run reads them: a later
    step then has their disk."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table.scratch)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def text_rows(docs: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    """Only the id, the UTF-8 bytes of the text, and what the caller names: other columns
    of the input cannot clash with the operator's own. NULL text reads as empty."""
    return docs.select(F.col(id_col).alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("binary"), F.lit("").cast("binary")).alias("text"), *more)


def row_key(id_col: str, text_col: str) -> Column:
    """64-bit hash of id and text that also tells NULL from a value: a name for rows whose id is NULL or repeated."""
    return F.xxhash64(F.col(id_col).isNull(), F.col(id_col), F.col(text_col).isNull(), F.col(text_col))


def without_rows(docs: DataFrame, keys: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of docs whose ``row_key`` is not in the one column of ``keys``."""
    name = "rejected"
    while name in docs.columns:  # of whatever columns the input has
        name += "_"
    return docs.join(keys.toDF(name).distinct(), row_key(id_col, text_col) == F.col(name), "left_anti")


def ascii_lower(column: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(column, upper, upper.lower())


def split_at_spaces(column: Column) -> Column:
    """Parts between \\x20 and \\x09-\\x0D, empty ones included. Where the space is the only
    separator, the split needs no regular expression, which takes half the time."""
    others = reduce(or_, [column.contains(c) for c in "\t\n\x0b\x0c\r"])
    return F.when(others, F.split(column, SPACES + "+")).otherwise(F.split(column, " "))


def words_of(column: Column) -> Column:
    """The words [^\\x20\\x09-\\x0D]+ of a text as an array; NULL has none."""
    return F.array_remove(split_at_spaces(F.coalesce(column, F.lit(""))), "")


def record_batch(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, f.type)
                                       for c, f in zip(columns, schema)], schema=schema)


def chunks(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about ``limit`` bytes of text, one row at least."""
    for batch in batches:
        sizes = pc.binary_length(batch.column("text")).to_pylist()
        begin = total = 0
        for i, size in enumerate(sizes):
            if total and total + size > limit:
                yield batch.slice(begin, i - begin)
                begin, total = i, 0
            total += size
        if begin < batch.num_rows:
            yield batch.slice(begin)


def flat(lists: list) -> itertools.chain:
    return itertools.chain.from_iterable(lists)
