"""Secret scans: certain forms, and weak candidates linked with their complementary parts."""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from functools import partial
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, record_batch, text_rows

# The certain forms, in the order in which spans of equal start are listed.
ASSIGN = r"""(?ai:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
BASE = ("assign", "access", "hex")

# Weak candidates: (kind, part they are, pattern with the span in its last group).
WEAK = (
    ("account", "identifier", r"""(?ai:\b(?:access[_-]?key(?:[_-]?id)?|client[_-]?id|user(?:name)?|login|account)["']?\x20*[:=]\x20*["']?([A-Za-z0-9_.@-]{3,}))"""),
    ("blob", "secret", r"(?a:(?<![A-Za-z0-9+/=_-])([A-Za-z0-9+/_-]{20,}={0,2})(?![A-Za-z0-9+/=_-]))"),
    ("endpoint", "endpoint", r"(?a:(\b(?:https?|ftp|s3|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[^\s\"'<>]+|\b(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?::[0-9]+)?\b))"),
)
PART_OF_BASE = {"assign": "secret", "hex": "secret", "access": "identifier"}
# Parts that must lie near a weak candidate: for an endpoint both others, for these the other one
# or an endpoint.
NEEDS = {"identifier": (("secret",),), "secret": (("identifier",), ("endpoint",)), "endpoint": (("identifier", "secret"),)}

_ASSIGN, _ACCESS, _HEX = (re.compile(p) for p in (ASSIGN, r"AKIA[A-Z0-9]{12,}", r"[0-9a-f]{32,}"))
_WEAK = tuple((kind, part, re.compile(p)) for kind, part, p in WEAK)
_BLANK = re.compile(r"\n[\x20\t\r]*\n")
_ENTROPY = 3.5
_RANK = {k: i for i, k in enumerate(BASE + tuple(w[0] for w in WEAK))}

Span = tuple[int, int, str]


def base_spans(text: str) -> list[Span]:
    """(start, end, kind) of the certain forms: leftmost, non-overlapping per kind, too short ones dropped.

    For access and hex, runs of the full length are found at once: a run that is too short
    holds no long one. An assignment that is too short is passed over as a whole.
    """
    spans = [(*m.span(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    spans += [(*m.span(), "access") for m in _ACCESS.finditer(text)]
    spans += [(*m.span(), "hex") for m in _HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[0], _RANK[s[2]]))


def _entropy(value: str) -> float:
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values())


class _Parts:
    """The parts of one kind; questions about those wholly in [low, start) or [end, high) of a candidate.

    A part counts if it touches the scope [low, high) and does not overlap [start, end): it
    ends in (low, start] or starts in [end, high).
    """

    def __init__(self, spans: list[tuple[int, int]]) -> None:
        by_end, by_start = sorted(spans, key=lambda s: s[1]), sorted(spans)
        self.ends, self.starts = [e for _, e in by_end], [s for s, _ in by_start]
        self.latest = list(accumulate((s for s, _ in by_end), max))             # largest start up to an end
        self.earliest = list(accumulate((e for _, e in reversed(by_start)), min))[::-1]  # smallest end from a start on

    def before(self, low: int, start: int) -> tuple[int, int] | None:
        """(smallest end, largest start) of the parts before the candidate."""
        i, j = bisect_right(self.ends, low), bisect_right(self.ends, start)
        return (self.ends[i], self.latest[j - 1]) if i < j else None

    def after(self, end: int, high: int) -> tuple[int, int] | None:
        """(smallest end, largest start) of the parts after the candidate."""
        i, j = bisect_left(self.starts, end), bisect_left(self.starts, high)
        return (self.earliest[i], self.starts[j - 1]) if i < j else None


def _inside(spans: list[tuple[int, int]], outer: list[tuple[int, int]]) -> list[bool]:
    """Does each span lie in one of the outer ones?"""
    outer = sorted(outer)
    first, last = [s for s, _ in outer], list(accumulate((e for _, e in outer), max))
    return [(at := bisect_right(first, s)) > 0 and last[at - 1] >= e for s, e in spans]


def linked_spans(text: str, base: list[Span], reach: int) -> list[Span]:
    """Weak candidates that complete each other.

    Parts are intervals; a scope is a paragraph (up to a blank line), narrowed to ``reach``
    code points on either side of the candidate. A part counts only if it shares no character
    with the candidate, and an endpoint needs an identifier and a secret that share none
    either. A blob inside a certain span or an endpoint is that span's text and completes nothing;
    in an endpoint it is itself reported only beside an identifier. Sorted starts and ends
    answer all of it, so a text of n parts costs n log n.
    """
    weak = []
    for kind, part, pattern in _WEAK:
        for m in pattern.finditer(text):
            start, end = m.span(1)
            if kind == "blob" and not (re.search("[0-9]", m[1]) and re.search("[A-Za-z]", m[1]) and _entropy(m[1]) >= _ENTROPY):
                continue
            weak.append((start, end, kind, part))
    if not weak:
        return []
    places = [(s, e) for s, e, *_ in weak]
    in_base = _inside(places, [(s, e) for s, e, _ in base])
    in_endpoint = _inside(places, [(s, e) for s, e, kind, _ in weak if kind == "endpoint"])
    spans: dict[str, list[tuple[int, int]]] = {"identifier": [], "secret": [], "endpoint": []}
    for start, end, kind in base:
        spans[PART_OF_BASE[kind]].append((start, end))
    for (start, end, kind, part), certain, held in zip(weak, in_base, in_endpoint):
        if kind != "blob" or not (certain or held):
            spans[part].append((start, end))
    parts = {k: _Parts(v) for k, v in spans.items()}
    breaks = [m.start() for m in _BLANK.finditer(text)]

    def near(needed: tuple[str, ...], low: int, start: int, end: int, high: int) -> bool:
        """Are parts of these kinds (one or two) in the scope, apart from the candidate and from each other?"""
        sides = [(parts[p].before(low, start), parts[p].after(end, high)) for p in needed]
        if not all(any(s) for s in sides):
            return False
        if len(sides) == 1:
            return True
        (a, b), (c, d) = sides
        return bool((a and d) or (b and c)) or any(x[0] <= y[1] or y[0] <= x[1] for x, y in ((a, c), (b, d)) if x and y)

    found = []
    for (start, end, kind, part), held in zip(weak, in_endpoint):
        at = bisect_left(breaks, start)
        low = max(start - reach, breaks[at - 1] if at else 0)
        at = bisect_left(breaks, end)
        high = min(end + reach, breaks[at] if at < len(breaks) else len(text))
        if any(near(needed, low, start, end, high) for needed in NEEDS[part] if not (held and kind == "blob" and needed == ("endpoint",))):
            found.append((start, end, kind))
    covered = sorted((s, e) for s, e, _ in base)
    first = [s for s, _ in covered]
    longest, top = [], 0
    for _, e in covered:
        longest.append(top := max(top, e))

    def known(start: int, end: int) -> bool:  # already inside or across a certain span
        at = bisect_left(first, end)
        return at > 0 and longest[at - 1] > start

    return [s for s in found if not known(s[0], s[1])]


def listed(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in sorted(spans, key=lambda x: (x[0], _RANK[x[2]], x[1])))


_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()),
                     ("n_linked", pa.int64()), ("base_sha256", pa.string()), ("spans", pa.string())])


def _scan(reach: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches, 4 << 20):
        rows = []
        for raw in batch.column("text"):
            text = raw.as_py().decode()
            base = base_spans(text)
            more = linked_spans(text, base, reach)
            count = Counter(k for _, _, k in base)
            rows.append((*(count[k] for k in BASE), len(more), hashlib.sha256(listed(base).encode()).hexdigest(), listed(base + more)))
        yield record_batch(_SCHEMA, [batch.column("doc_id"), *([r[i] for r in rows] for i in range(6))])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", reach: int = 300) -> DataFrame:
    """Per input row: doc_id, n_assign, n_access, n_hex, n_linked, base_sha256, spans.

    spans lists kind:start:end by start, in code points, end exclusive; base_sha256 is the
    digest of the certain ones alone. Weak candidates (account, blob, endpoint) are listed only
    with a complementary part in their scope, made of other characters, and outside certain spans. NULL and empty texts
    have no spans; each row stands for itself, so repeated rows and NULL ids stay. The work is
    one pass over each text, without a shuffle.
    """
    rows = text_rows(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    return rows.mapInArrow(partial(_scan, reach), "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, "
                                                  "n_linked bigint, base_sha256 string, spans string")
