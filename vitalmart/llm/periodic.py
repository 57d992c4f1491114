"""Periodic runs of words, by recursive frequency splitting and a lag scan.

A run is a stretch of words that repeats itself with a period and holds two whole periods
or more, so each of its words stands in it twice at least. A word that occurs once within a
segment therefore lies in no run: it splits the segment, its parts are counted again, until
every word left occurs twice in its segment or the segment is too short. Only surviving
segments are scanned lag by lag.

Edge cases: a NULL or empty text has no words and no runs. A NULL id gives a row like any
other, never altered by ``periodic_tail``. Repeated rows each give a row. Words are byte strings,
so a text that is not valid UTF-8 is handled like any other. Columns of the input other than id
and text are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import chunks, record_batch, text_rows

LEAST = 12  # words of the shortest run
BLOCK = 4 << 20  # bytes of text a task works on at a time
SAMPLES = 1 << 20  # sampled word pairs compared in one vector operation
_LONG = 256  # words from which a found run is taken off all samples of a vector operation at once
_BASE = 0x9E3779B97F4A7C15  # odd factor of the polynomial word hash


def periodic_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words as they are or, for one id in ten, with everything after some place repeating
    the words found there: a repetition whose place and period follow from the id alone."""
    h = 0 if doc_id is None else zlib.crc32(b"%d" % doc_id)
    if doc_id is None or h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    start = g % n
    period = 1 + (n - start) // (3 + g % 8)
    return words[:start] + [words[start + i % period] for i in range(n - start)]


def segments(ids: list[int], least: int = LEAST) -> list[tuple[int, int]]:
    """Stretches [lo, hi) of at least ``least`` words in which every word occurs twice or more.

    Each segment keeps the count and the sum of places of its words. When it is split, only
    the shorter parts are counted anew and taken off the longest part's counts, so each word is
    counted at most log2(n) times; a word left with count one stands at its sum of places.
    """
    done = []
    counts, places = Counter(ids), {}
    for i, word in enumerate(ids):
        places[word] = places.get(word, 0) + i
    todo = [(0, len(ids), counts, places, sorted(places[w] for w, c in counts.items() if c == 1))]
    while todo:
        lo, hi, counts, places, cuts = todo.pop()
        if hi - lo < least:
            continue
        if not cuts:
            done.append((lo, hi))
            continue
        edges = [lo - 1, *cuts, hi]
        parts = [(a + 1, b) for a, b in zip(edges, edges[1:]) if b - a - 1 >= least]
        if not parts:
            continue
        biggest = max(parts, key=lambda part: part[1] - part[0])
        if 2 * (biggest[1] - biggest[0]) <= hi - lo:
            keep = None  # nothing to save: count every part
        else:
            keep = biggest
            touched = set()
            for a, b in ((lo, biggest[0]), (biggest[1], hi)):
                for i, word in enumerate(ids[a:b], a):
                    counts[word] -= 1
                    places[word] -= i
                    touched.add(word)
            rare = sorted(places[w] for w in touched if counts[w] == 1)
            todo.append((*biggest, counts, places, rare))
        for a, b in parts:
            if (a, b) == keep:
                continue
            own, at = Counter(ids[a:b]), {}
            for i, word in enumerate(ids[a:b], a):
                at[word] = at.get(word, 0) + i
            todo.append((a, b, own, at, sorted(at[w] for w, c in own.items() if c == 1)))
    return sorted(done)


def _common(x: np.ndarray, i: int, j: int, step: int) -> int:
    """Number of equal words from places i and j on, forward or backward, in doubling strides."""
    n, stride, room = 0, 16, (len(x) - j if step > 0 else i + 1)
    while n < room:
        k = min(stride, room - n)
        if step > 0:
            differ = x[i + n:i + n + k] != x[j + n:j + n + k]
        else:
            differ = (x[i - n - k + 1:i - n + 1] != x[j - n - k + 1:j - n + 1])[::-1]
        first = int(differ.argmax())
        if differ[first]:
            return n + first
        n, stride = n + k, 2 * stride
    return n


def lag_scan(x: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """All runs (start, end, period) of a segment: the maximal stretches with that smallest period.

    At lag q a run shows as ``need = max(q, least - q)`` or more neighbouring places equal to the
    place q later. Half that many places are compared at once by a rolling hash, at every
    half ``need``-th place, so no run is missed and all lags together take n log n comparisons.
    What agrees is confirmed word by word and widened to its ends. A stretch inside an earlier
    run whose period divides q repeats with that period already and is passed over.
    """
    n = len(x)
    lags = np.arange(1, n // 2 + 1)
    need = np.maximum(lags, least - lags)
    width = (need + 1) // 2
    stride = need - width + 1
    tries = (n - lags - width) // stride + 1
    fits = tries > 0
    lags, width, stride, tries = lags[fits], width[fits], stride[fits], tries[fits]
    if not len(lags):
        return []
    with np.errstate(over="ignore"):
        powers = np.ones(n + 1, np.uint64)
        powers[1:] = _BASE
        powers = np.multiply.accumulate(powers)
        # the sum of word i times base^i up to each place; equal stretches agree after shifting
        mixed = (x.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
        mixed ^= mixed >> np.uint64(32)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed * powers[:n], dtype=np.uint64)])
    runs: list[tuple[int, int, int]] = []
    known = np.zeros((0, 3), np.int64)
    ends = np.cumsum(tries)
    begin = 0
    size = SAMPLES >> 8
    while begin < len(lags):
        done = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, done + size, "right")))
        size = min(2 * size, SAMPLES)
        count = tries[begin:end]
        of = np.repeat(np.arange(begin, end), count)
        nth = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
        a, q, w = nth * stride[of], lags[of], width[of]
        with np.errstate(over="ignore"):
            same = (sums[a + w] - sums[a]) * powers[q] == sums[a + q + w] - sums[a + q]
        a, q, w = a[same], q[same], w[same]
        for start, stop, period in runs:
            if stop - start >= _LONG and len(a):
                new = (a < start) | (a + q + w > stop) | (q % period > 0)
                a, q, w = a[new], q[new], w[new]
        beyond, lag = -1, 0
        for i, (place, period, wide) in enumerate(zip(a.tolist(), q.tolist(), w.tolist())):
            if period != lag:
                lag, beyond = period, -1
                if len(known) != len(runs):
                    known = np.array(runs, np.int64).reshape(-1, 3)
                inner = known[period % known[:, 2] == 0] if len(known) else known
            if place < beyond:
                continue
            if len(inner) and ((inner[:, 0] <= place) & (inner[:, 1] >= place + period + wide)).any():
                continue
            ahead = _common(x, place, place + period, 1)
            if ahead < wide:  # equal hashes of different words
                continue
            behind = _common(x, place - 1, place + period - 1, -1) if place else 0
            beyond = place + ahead
            start, stop = place - behind, beyond + period
            if stop - start < max(least, 2 * period):
                continue
            if len(inner) and ((inner[:, 0] <= start) & (inner[:, 1] >= stop)).any():
                continue
            runs.append((start, stop, period))
        begin = end
    return runs


def runs_of(words: list, least: int = LEAST) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of a word sequence, by start, then period."""
    numbers: dict = {}
    ids = [numbers.setdefault(w, len(numbers)) for w in words]
    found = []
    for lo, hi in segments(ids, least):
        part = np.asarray(ids[lo:hi], np.int64)
        found += [(lo + start, stop - start, period) for start, stop, period in lag_scan(part, least)]
    return sorted(found, key=lambda run: (run[0], run[2]))


def collapsed(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words that no run holds after its first period."""
    if not runs:
        return words
    depth = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        depth[start + period] += 1
        depth[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(depth[:-1]) == 0).tolist()]


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_SCHEMA = pa.schema([("n_words", pa.int64()), ("runs", pa.list_(_RUN)), ("runs_sha256", pa.string()),
                     ("text", pa.binary()), ("collapsed_sha256", pa.string())])


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, least: int = LEAST,
                  planted_tails: bool = False, texts: bool = True) -> DataFrame:
    """Per row: id, number of words, all runs (start, length, period), the digest of their listing,
    the text without repeated periods (words joined by one space, as bytes; NULL if ``texts`` is
    off) and its digest. ``planted_tails`` alters one document in ten by ``periodic_tail`` first.

    One pass without shuffle; a task holds a few megabytes of text, or one document.
    """
    rows = text_rows(docs, id_col, text_col)
    name = rows.schema["doc_id"].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(iter([batch]), BLOCK):
                out: list[list] = [[] for _ in _SCHEMA]
                for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text")):
                    words = text.as_py().split()
                    if planted_tails:
                        words = periodic_tail(doc_id, words)
                    runs = runs_of(words, least)
                    listing = "".join("%d,%d,%d\n" % run for run in runs)
                    kept = b" ".join(collapsed(words, runs))
                    for column, cell in zip(out, (len(words), [dict(zip(("start", "length", "period"), run)) for run in runs],
                                                  hashlib.sha256(listing.encode()).hexdigest(), kept if texts else None,
                                                  hashlib.sha256(kept).hexdigest())):
                        column.append(cell)
                schema = pa.schema([part.schema.field("doc_id"), *_SCHEMA])
                yield record_batch(schema, [part.column("doc_id"), *out])

    return rows.mapInArrow(scan, f"doc_id {name}, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, "
                                 "runs_sha256 string, text binary, collapsed_sha256 string")
