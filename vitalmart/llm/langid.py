"""Language identification by error-correcting output codes over byte n-gram classifiers."""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import chunks, record_batch, row_key, stored, text_rows, without_rows

UNKNOWN = "und"
BUCKETS = 1 << 14
SIZES = (2, 3, 4)
MAX_LANGUAGES = 1000
_PIECE = 1 << 18
# ASCII letters in lower case and all bytes of other characters; the rest separates words
_LETTERS = bytes(c | 32 if chr(c).isalpha() and c < 128 else c if c >= 128 else 32 for c in range(256))
_FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], dtype=np.uint32)


def has_letter(text: bytes) -> bool:
    return bool(re.search(rb"[A-Za-z]", text)) or (not text.isascii() and any(map(str.isalpha, text.decode())))


def grams(text: bytes) -> Iterator[np.ndarray]:
    """Buckets of all byte n-grams of the words, in pieces so that any text length fits."""
    whole = np.frombuffer(b" " + b" ".join(text.translate(_LETTERS).split()) + b" ", dtype=np.uint8)
    for begin in range(0, len(whole) - 1, _PIECE):
        piece = whole[begin:begin + _PIECE + max(SIZES) - 1].astype(np.uint32)
        for n in SIZES:
            count = min(len(piece) - n + 1, _PIECE)
            if count > 0:
                h = np.full(count, n * 0x2545F491 & 0xFFFFFFFF, dtype=np.uint32)
                for i in range(n):
                    h = (h ^ piece[i:i + count]) * _FACTORS[i]
                    h ^= h >> np.uint32(15)
                yield (h & np.uint32(BUCKETS - 1)).astype(np.int32)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(BUCKETS, dtype=np.int64))
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
            for found in grams(text.as_py()):
                totals[lang] += np.bincount(found, minlength=BUCKETS)
    schema = pa.schema([("lang", pa.string()), ("bucket", pa.int32()), ("n", pa.int64())])
    for lang, counts in totals.items():
        used = np.flatnonzero(counts)
        yield record_batch(schema, [[lang] * len(used), used.astype(np.int32), counts[used]])


def code_matrix(n: int) -> np.ndarray:
    """n codewords of +1/-1. Up to 7 languages: every split once. Beyond: 10 log2 n columns, the
    widest apart of 50 seeded draws."""
    if n < 2:
        return np.zeros((n, 0), dtype=np.int8)
    if n <= 7:
        columns = [[1] + [1 if c >> i & 1 else -1 for i in range(n - 1)] for c in range(2 ** (n - 1) - 1)]
        return np.array(columns, dtype=np.int8).T
    best, apart = None, -1
    for seed in range(50):
        drawn = np.random.default_rng(seed).choice(np.array([-1, 1], dtype=np.int8), (n, math.ceil(10 * math.log2(n))))
        drawn = drawn[:, np.abs(drawn.sum(axis=0)) < n]
        distance = min_distance(drawn)
        if distance > apart:
            best, apart = drawn, distance
    return best


def min_distance(code: np.ndarray) -> int:
    products = code.astype(np.int32) @ code.T.astype(np.int32)
    np.fill_diagonal(products, -code.shape[1])
    return int((code.shape[1] - products.max()) // 2)


class Model:
    """languages, code (language x bit) and weights (bucket x bit); ``fit_decoder`` adds the decoder."""

    def __init__(self, counts: dict[str, np.ndarray], smoothing: float = 0.5) -> None:
        self.languages = sorted(counts)
        self.code = code_matrix(len(self.languages))
        p = np.array([(counts[x] + smoothing) / (counts[x].sum() + smoothing * BUCKETS) for x in self.languages])
        p = p.reshape(len(self.languages), BUCKETS)
        sides = [[p[self.code[:, b] == s].mean(axis=0) for s in (1, -1)] for b in range(self.code.shape[1])]
        self.weights = np.array([np.log(a) - np.log(b) for a, b in sides], dtype=np.float32).reshape(-1, BUCKETS).T.copy()

    def margins(self, text: bytes) -> np.ndarray:
        """Mean log-odds per n-gram of each bit's classifier."""
        total, n = np.zeros(self.code.shape[1]), 0
        for found in grams(text):
            total += self.weights[found].sum(axis=0, dtype=np.float64)
            n += len(found)
        return total / max(n, 1)


def _margins(model: Model, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang", pa.string()), ("letter", pa.bool_()),
                        ("margins", pa.list_(pa.float64()))])
    for batch in chunks(batches, 8 << 20):
        texts = batch.column("text").to_pylist()
        yield record_batch(schema, [batch.column("doc_id"), batch.column("held_out"), batch.column("lang"),
                                    [has_letter(t) for t in texts], [model.margins(t) for t in texts]])


def _decode(languages: list[str], code: np.ndarray, scale: np.ndarray, trust: np.ndarray, gap: float,
            batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64()),
                        ("bit_errors", pa.int32()), ("ambiguous", pa.bool_())])
    radius = (min_distance(code) - 1) // 2 if code.shape[1] else 0
    for batch in batches:
        letter = np.array(batch.column("letter").to_pylist(), dtype=bool)
        m = np.array(batch.column("margins").to_pylist(), dtype=np.float64).reshape(batch.num_rows, code.shape[1]) / scale
        loss = np.stack([np.logaddexp(0, -3 * m * row) @ w for row, w in zip(code, trust)], axis=1)
        share = np.exp(-3 * (loss - loss.min(axis=1, keepdims=True)))
        share /= share.sum(axis=1, keepdims=True)
        best = loss.argmin(axis=1)
        top = share[np.arange(len(best)), best]
        rest = share.copy()
        rest[np.arange(len(best)), best] = 0
        errors = (np.where(m >= 0, 1, -1) != code[best]).sum(axis=1)
        unclear = (top - rest.max(axis=1) < gap) | (errors > radius)
        yield record_batch(schema, [
            batch.column("doc_id"), batch.column("held_out"),
            [languages[b] if ok else UNKNOWN for b, ok in zip(best, letter)], np.where(letter, top, 0.0),
            np.where(letter, errors, 0).astype(np.int32), unclear & letter])


def held_out_column(id_col: str, parts: int = 5) -> Column:
    """crc32 of the id as text leaves no remainder; rows without an id are never learnt from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % parts == 0, F.lit(True))


def predict(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
            held_out: Column | None = None, gap: float = 0.1) -> DataFrame:
    """One row per input row: doc_id, held_out, lang_pred, score (0 to 1), bit_errors, ambiguous.

    Learns from all rows that are not held out and have a language: n-gram counts per language
    give, for each column of the code, a classifier of its two sides. Loss-weighted decoding
    takes the codeword of least logistic loss, bits weighted by how often they are right on
    the language's training texts. ambiguous: the two nearest codewords score within ``gap``, or
    more bits differ from the chosen one than the code can correct.

    NULL texts and texts without a letter are ``und`` with score 0 and not ambiguous. Without any
    training row everything is ``und``. With one language all texts with a letter are of
    it. Equal losses go to the first language by name. Repeated rows stay. Prediction reads the
    text alone. Label sets beyond MAX_LANGUAGES are refused: the model goes through the driver.
    """
    held_out = held_out_column(id_col) if held_out is None else held_out
    rows = text_rows(docs, id_col, text_col, F.col(lang_col).cast("string").alias("lang"), held_out.alias("held_out"))
    rows = rows.withColumn("doc_id", F.col("doc_id").cast("bigint"))
    result = "doc_id bigint, held_out boolean, lang_pred string, score double, bit_errors int, ambiguous boolean"
    counted = rows.where(~F.col("held_out") & F.col("lang").isNotNull()).select("lang", "text").mapInArrow(
        _count, "lang string, bucket int, n bigint")
    counted = stored(counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")), "ngrams")
    if counted.select("lang").distinct().limit(MAX_LANGUAGES + 1).count() > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    counts: dict[str, np.ndarray] = {}
    table = counted.toArrow()  # at most MAX_LANGUAGES x BUCKETS rows
    for lang, bucket, n in zip(table["lang"].to_pylist(), table["bucket"].to_pylist(), table["n"].to_pylist()):
        counts.setdefault(lang, np.zeros(BUCKETS, dtype=np.int64))[bucket] = n
    if not counts:
        return rows.select("doc_id", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"),
                           F.lit(0).alias("bit_errors"), F.lit(False).alias("ambiguous"))
    model = Model(counts)
    rows = stored(rows.mapInArrow(partial(_margins, model), "doc_id bigint, held_out boolean, lang string, letter boolean, "
                                                            "margins array<double>"), "margins")
    bits = model.code.shape[1]
    scale, trust = np.ones(bits), np.full(model.code.shape, 1.0 / max(bits, 1))
    if bits:
        m = [F.col("margins")[b] for b in range(bits)]
        learnt = rows.where(~F.col("held_out") & F.col("lang").isNotNull() & F.col("letter"))
        seen = learnt.groupBy("lang").agg(F.count("*").alias("n"), F.array(*(F.sum(F.abs(x)) for x in m)).alias("size"),
                                          F.array(*(F.avg((x >= 0).cast("int")) for x in m)).alias("plus")).collect()
        if seen:
            scale = np.maximum(sum(np.array(r["size"]) for r in seen) / sum(r["n"] for r in seen), 1e-9)
        for r in seen:
            k = model.languages.index(r["lang"])
            plus = np.array(r["plus"])
            trust[k] = np.maximum(np.where(model.code[k] > 0, plus, 1 - plus), 1e-3)
            trust[k] /= trust[k].sum()
    return rows.mapInArrow(partial(_decode, model.languages, model.code, scale, trust, gap), result)


def keep_identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                    held_out: Column | None = None, **more) -> DataFrame:
    """The input's rows without those that are ``und`` or ambiguous. Every row follows its own
    verdict, also where ids are NULL or repeated."""
    held_out = held_out_column(id_col) if held_out is None else held_out
    rows = docs.select(row_key(id_col, text_col).alias("key"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"),
                       held_out.alias("held_out"))
    out = predict(rows, "key", held_out=F.col("held_out"), **more).where((F.col("lang_pred") == UNKNOWN) | F.col("ambiguous"))
    return without_rows(docs, out.select("doc_id"), id_col, text_col)
