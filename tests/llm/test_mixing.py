import hashlib
import random
from collections import defaultdict
from fractions import Fraction

import pytest

from vitalmart.llm import mixing


def plain_targets(sizes, weights=(5, 2, 1), repeats=3, share=1):
    """Water filling by fractions: stop whoever is above, divide the rest again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = Fraction(sum(sizes.values())) * Fraction(share), set()
    while True:
        rest = total - sum(repeats * sizes[s] for s in capped)
        free = sum(weight[s] for s in names if s not in capped) or 1
        above = {s for s in names if s not in capped and rest * weight[s] / free > repeats * sizes[s]}
        if not above:
            return {s: Fraction(repeats * sizes[s]) if s in capped else rest * weight[s] / free for s in names}
        capped |= above


def plain_mix(rows, targets):
    """Times per row index, by sorting; rows equal in id and text are told apart by nothing."""
    out, groups = {}, defaultdict(list)
    for i, (doc_id, source, text) in enumerate(rows):
        groups[source].append((int(hashlib.md5(("" if doc_id is None else str(doc_id)).encode()).hexdigest()[:15], 16), i, len((text or "").split(" ")) if text else 0))
    for source, docs in groups.items():
        size = sum(d[2] for d in docs)
        whole = int(targets[source] // size) if size else 0
        rest, before = targets[source] - whole * size, 0
        for _, i, n in sorted(docs):
            out[i] = whole + (before < rest and rest - before >= Fraction(n, 2))
            before += n
    return out


def docs_of(spark, rows):
    return spark.createDataFrame([(*r, 1.5, 7) for r in rows], "doc_id bigint, source string, text string, target double, size int")


@pytest.mark.parametrize("share", [1.0, 0.25, 2.5])
def test_against_sorting(spark, share):
    rng = random.Random(4)
    rows = [(i, rng.choice(["a", "a", "a", "a", "b", "Z", "é", "\U0001f600", None, "rare"][: 10 - (i % 2)]),
             " ".join("w" * rng.randrange(1, 5) for _ in range(rng.choice([0, 1, 5, 30, 400])))) for i in range(1500)]
    rows += [(5000, "void", None), (5001, "void", ""), (None, "b", "only one")]
    sizes = defaultdict(int)
    for _, s, t in rows:
        sizes[s] += len(t.split(" ")) if t else 0
    targets = plain_targets(sizes, share=share)
    times = plain_mix(rows, targets)
    got = mixing.mix(docs_of(spark, rows).repartition(5), share=share).collect()
    assert len(got) == len(rows)
    want = {rows[i][0]: (rows[i][1], sizes[rows[i][1]], t) for i, t in times.items()}
    taken = defaultdict(int)
    for r in got:
        source, total, t = want[r.doc_id]
        assert (r.source, r.source_size, r.times, r.taken) == (source, total, t, t * r.size) and r.taken <= 3 * r.size
        assert abs(r.target - float(targets[source])) <= 1e-9 * max(1.0, r.target)
        taken[source] += r.taken
    assert all(abs(taken[s] - float(targets[s])) <= 200 for s in targets)


def test_targets_stop_at_three_sizes(spark):
    sizes = {"a": 10, "b": 1000, "c": 0, "d": 500, "e": 1, None: 3}
    table = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    got = {r.source: r.target for r in mixing.source_targets(table).collect()}
    want = plain_targets(sizes)
    assert got == {s: pytest.approx(float(t)) for s, t in want.items()}
    assert got["a"] == 30 and got["e"] == 3 and got["c"] == 0 and sum(got.values()) == pytest.approx(1514)


def test_larger_mixes_contain_smaller_ones(spark):
    rows = [(i, f"s{i % 3}", "w " * (i % 17) + "w") for i in range(900)]
    before = None
    for share in (0.1, 0.5, 1.0, 1.7):
        now = {r.doc_id: r.times for r in mixing.mix(docs_of(spark, rows), share=share).collect()}
        assert before is None or all(now[i] >= t for i, t in before.items())
        before = now


def test_equal_rows_are_taken_in_part(spark):
    rows = [(None, "a", "same words here")] * 1000 + [(1, "b", "w " * 2999 + "w")]
    for partitions in (1, 7):
        got = mixing.mix(docs_of(spark, rows).repartition(partitions)).collect()
        times = sorted(r.times for r in got if r.source == "a")
        target = next(r.target for r in got if r.source == "a")
        assert abs(sum(times) * 3 - target) <= 1.5 and set(times) == {1, 2}
        assert len(got) == 1001


def test_carried_columns_and_empty_table(spark):
    docs = docs_of(spark, [(1, "a", "x y"), (2, "a", None)])
    got = {r.doc_id: (r.text, r.taken) for r in mixing.mix(docs, carry=("text",)).collect()}
    assert got == {1: ("x y", 2), 2: (None, 0)}
    assert mixing.mix(docs.limit(0)).count() == 0
    assert mixing.mix(docs.where("doc_id = 2")).first().taken == 0
