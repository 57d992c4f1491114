"""Byte-level BPE in two tiers: a minimal perfect hash for whole pre-tokens, a heap for the rest."""

from __future__ import annotations

import base64
import hashlib
import heapq
import uuid
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, record_batch, text_rows

_U = np.uint64
BATCH_BYTES = 4 << 20
# Pre-tokens a Python worker remembers over its tasks; a full store starts anew, which changes speed only.
REMEMBERED = 600_000
_WORKER: dict = {}


def load_ranks(path: str) -> dict[bytes, int]:
    """A .tiktoken file: one base64 token and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def _mix(h: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Hash h anew for displacement d (the finaliser of splitmix64)."""
    with np.errstate(over="ignore"):
        z = h ^ (d * _U(0x9E3779B97F4A7C15))
        z = (z ^ (z >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> _U(27))) * _U(0x94D049BB133111EB)
    return z ^ (z >> _U(31))


class PerfectHash:
    """Minimal perfect hash over byte strings (hash and displace): n keys, n slots.

    A key's bucket holds a displacement d >= 0, which hashes the key to its own slot, or -1 - slot
    for a bucket of one key placed at the end. An unknown key lands on some slot; comparing
    the slot's key tells.
    """

    def __init__(self, keys: list[bytes]) -> None:
        n = len(keys)
        hashes = self._hash(keys)
        bucket = (hashes % _U(max(1, n // 4 + 1))).astype(np.int64)
        self.displacement = np.zeros(max(1, n // 4 + 1), dtype=np.int64)
        free = np.ones(n, dtype=bool)
        slots = np.empty(n, dtype=np.int64)
        order = np.argsort(bucket, kind="stable")
        groups = np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1) if n else []
        groups.sort(key=len, reverse=True)
        last = [g for g in groups if len(g) == 1]
        for g in groups[:len(groups) - len(last)]:
            tried, width, fits = 0, 16, np.empty(0, dtype=np.int64)
            while not len(fits):
                d = np.arange(tried, tried + width, dtype=_U)
                at = (_mix(hashes[g][:, None], d) % _U(n)).astype(np.int64)
                apart = (np.diff(np.sort(at, axis=0), axis=0) > 0).all(axis=0)
                fits = np.flatnonzero(free[at].all(axis=0) & apart)
                tried, width = tried + width, min(4 * width, 4096)
            at, d = at[:, fits[0]], int(d[fits[0]])
            free[at], slots[g], self.displacement[bucket[g[0]]] = False, at, d
        for g, slot in zip(last, np.flatnonzero(free)):
            slots[g], self.displacement[bucket[g[0]]] = slot, -1 - slot
        self.keys: list[bytes] = [b""] * n
        for slot, key in zip(slots.tolist(), keys):
            self.keys[slot] = key

    @staticmethod
    def _hash(keys: list[bytes]) -> np.ndarray:
        return np.fromiter(map(xxhash.xxh64_intdigest, keys), dtype=_U, count=len(keys))

    def slots(self, keys: list[bytes]) -> np.ndarray:
        """Each key's slot, -1 for a key that is not one of the n."""
        if not self.keys or not keys:
            return np.full(len(keys), -1)
        hashes = self._hash(keys)
        d = self.displacement[(hashes % _U(len(self.displacement))).astype(np.int64)]
        at = np.where(d < 0, -1 - d, (_mix(hashes, np.maximum(d, 0).astype(_U)) % _U(len(self.keys))).astype(np.int64))
        same = np.fromiter((self.keys[s] == k for s, k in zip(at.tolist(), keys)), dtype=bool, count=len(keys))
        return np.where(same, at, -1)


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: the lowest-ranked neighbouring pair, leftmost first, is joined until none has a rank.

    Bytes are linked by the start of the next part; a heap holds the pairs. An entry is stale
    when its left part is gone or either part has grown since.
    """
    n, get = len(piece), ranks.get
    width = n.bit_length()  # an entry is one integer: rank, start, stop
    mask = (1 << width) - 1
    end = list(range(1, n + 1))      # of the part that starts here, -1 when gone
    before = list(range(-1, n - 1))  # start of the part on the left
    heap = []
    for i in range(n - 1):
        rank = get(piece[i:i + 2])
        if rank is not None:
            heap.append((rank << width | i) << width | i + 2)
    heapq.heapify(heap)
    push, pop = heapq.heappush, heapq.heappop
    while heap:
        entry = pop(heap)
        stop, i = entry & mask, entry >> width & mask
        middle = end[i]
        if middle < 0 or middle >= n or end[middle] != stop:
            continue
        end[i], end[middle] = stop, -1
        if stop < n:
            before[stop] = i
            rank = get(piece[i:end[stop]])
            if rank is not None:
                push(heap, (rank << width | i) << width | end[stop])
        left = before[i]
        if left >= 0:
            rank = get(piece[left:stop])
            if rank is not None:
                push(heap, (rank << width | left) << width | stop)
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i:end[i]]])
        i = end[i]
    return ids


class Tokenizer:
    """Encodes and decodes with given ranks and pre-token pattern; no special tokens."""

    def __init__(self, ranks: dict[bytes, int], perfect: PerfectHash, pattern: str) -> None:
        self.ranks, self.perfect, self.pattern = ranks, perfect, regex.compile(pattern)
        self.slot_ids = [ranks[k] for k in perfect.keys]
        self.tokens = {i: t for t, i in ranks.items()}
        self.known: dict[str, tuple[int, ...]] = {}

    def learn(self, pieces: set[str]) -> None:
        """Resolve pre-tokens not seen before: the hash for whole ones, the heap for misses."""
        new = list(pieces - self.known.keys())
        if len(self.known) + len(new) > REMEMBERED:
            self.known = {}
            new = list(pieces)
        coded = [p.encode() for p in new]
        for piece, raw, slot in zip(new, coded, self.perfect.slots(coded).tolist()):
            self.known[piece] = (self.slot_ids[slot],) if slot >= 0 else tuple(merge(raw, self.ranks))

    def encode_batch(self, texts: list[str]) -> Iterator[list[int]]:
        cut = [self.pattern.findall(t) for t in texts]
        self.learn(set().union(*cut))
        for pieces in cut:
            yield [i for p in map(self.known.__getitem__, pieces) for i in p]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def tables(path: str) -> tuple[dict[bytes, int], PerfectHash]:
    """Ranks and the perfect hash over their tokens, made once on the driver."""
    ranks = load_ranks(path)
    if any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError("the ranks must hold all single bytes")
    return ranks, PerfectHash(list(ranks))


def _run(shared, pattern: str, row, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ranks, perfect, key = shared.value
    tokenizer = _WORKER.get(key)
    if tokenizer is None:
        _WORKER.clear()
        tokenizer = _WORKER[key] = Tokenizer(ranks, perfect, pattern)
    for batch in chunks(batches, BATCH_BYTES):
        texts = [t.decode() for t in batch.column("text").to_pylist()]
        yield row(tokenizer, batch, tokenizer.encode_batch(texts))


def _encoded(tokenizer, batch, encoded):
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])
    return record_batch(schema, [batch.column("doc_id"), list(encoded)])


def _digests(tokenizer, batch, encoded):
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
                        ("decoded_sha256", pa.string()), ("round_trip", pa.bool_())])
    rows = []
    for text, ids in zip(batch.column("text"), encoded):
        decoded = tokenizer.decode(ids)
        rows.append((len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(decoded).hexdigest(), decoded == text.as_py()))
    return record_batch(schema, [batch.column("doc_id"), *([r[i] for r in rows] for i in range(4))])


def _both(tokenizer, batch, encoded):
    listed = list(encoded)
    digest = _digests(tokenizer, batch, listed)
    ids = pa.array(listed, pa.list_(pa.int32()))
    return pa.RecordBatch.from_arrays([*digest.columns, ids], schema=digest.schema.append(pa.field("ids", ids.type)))


def _decoded(ranks, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tokens = {i: t for t, i in ranks.value.items()}
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])
    for batch in batches:
        texts = [None if ids is None else b"".join(map(tokens.__getitem__, ids)).decode("utf-8", "replace")
                 for ids in batch.column("ids").to_pylist()]
        yield record_batch(schema, [batch.column("doc_id"), texts])


def _mapped(docs: DataFrame, path: str, pattern: str, row, schema: str, id_col: str, text_col: str) -> DataFrame:
    # the driver reads the vocabulary, whose size is bounded, and sends it once to each executor
    shared = docs.sparkSession.sparkContext.broadcast((*tables(path), (path, pattern, uuid.uuid4().hex)))
    rows = text_rows(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    return rows.mapInArrow(partial(_run, shared, pattern, row), schema)


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id bigint, ids array<int>), one row per input row; NULL and empty texts have no ids.
    Ties between equal pairs go to the leftmost. No shuffle."""
    return _mapped(docs, path, pattern, _encoded, "doc_id bigint, ids array<int>", id_col, text_col)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id bigint, text string) from (doc_id, ids); NULL ids give NULL, bytes that are no
    UTF-8 become U+FFFD. An id outside the vocabulary is an error."""
    ranks = encoded.sparkSession.sparkContext.broadcast(load_ranks(path))
    return encoded.select(F.col("doc_id").cast("bigint"), "ids").mapInArrow(partial(_decoded, ranks), "doc_id bigint, text string")


def digests(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per input row: doc_id, n_tokens, SHA-256 of the comma-joined ids and of the bytes decoded
    from them, and whether these bytes are the text's. NULL texts read as empty."""
    return _mapped(docs, path, pattern, _digests, "doc_id bigint, n_tokens bigint, ids_sha256 string, "
                                                  "decoded_sha256 string, round_trip boolean", id_col, text_col)


def encode_with_digests(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The columns of ``digests`` and ``encode`` in one pass."""
    return _mapped(docs, path, pattern, _both, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string, "
                                               "round_trip boolean, ids array<int>", id_col, text_col)
