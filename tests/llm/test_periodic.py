import hashlib
import random
import zlib

import pytest

from vitalmart.llm import periodic, queries


def plain_runs(words, least=12):
    n, out = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            start, stop = i, j + q
            if j > i and stop - start >= max(least, 2 * q):
                if q == next(p for p in range(1, q + 1) if words[start:stop - p] == words[start + p:stop]):
                    out.append((start, stop - start, q))
            i = j + 1
    return sorted(out, key=lambda run: (run[0], run[2]))


def plain_row(doc_id, text):
    words = (text or "").encode().split()
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if words and h is not None and h % 10 == 0:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    gone = {k for s, length, q in runs for k in range(s + q, s + length)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
    listing = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    return (doc_id, len(runs), *best, None if best[1] is None else 1000 * best[1] // best[2],
            hashlib.sha256(listing.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_runs_of_random_words():
    rng = random.Random(3)
    for _ in range(1500):
        n, kinds = rng.randrange(80), rng.choice([1, 2, 3, 5, 9, 40])
        words = [rng.randrange(kinds) for _ in range(n)]
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(words) + 1)
            block = [rng.randrange(60) for _ in range(rng.randrange(1, 9))]
            words[at:at] = (block * 9)[:rng.randrange(10, 40)]
        for least in (12, 5):
            assert periodic.runs_of(words, least) == plain_runs(words, least), words


def test_segments_are_stable_and_hold_every_run():
    rng = random.Random(5)
    for _ in range(300):
        words = [rng.choice("abcdefghijklmnopqrst") for _ in range(rng.randrange(90))]
        parts = periodic.segments(words)
        for lo, hi in parts:
            assert hi - lo >= 12 and all(words[lo:hi].count(w) >= 2 for w in words[lo:hi])
        assert all(any(lo <= s and s + length <= hi for lo, hi in parts) for s, length, _ in plain_runs(words))


@pytest.mark.parametrize("words", [
    ["a"] * 60000,
    [w for k in range(30000) for w in (k, k - 1)],  # one word less at each end per split
    ["a b c d e f g h i j k l m".split()[i % 13] for i in range(60000)],
], ids=["one word", "peeling", "one period"])
def test_long_texts_take_no_square_time(words):
    runs = periodic.runs_of(words)
    assert runs == ([] if len(set(words)) > 100 else [(0, 60000, len(set(words)))])


def test_query_against_plain_rows(spark, tmp_path):
    rng = random.Random(8)
    rows = [(None, "x " * 20), (None, None), (3, ""), (4, " \t\n"), (5, "one"), (6, "a b c " * 4), (6, "a b c " * 4), (7, "  b c " * 30),
            (8, "w " * 11), (9, "w " * 12), (-10, "u v " * 6 + "z " + "u v " * 6)]
    rows += [(100 + i, " ".join(rng.choice("abcdefghij") * rng.randrange(1, 4) for _ in range(rng.randrange(120)))) for i in range(120)]
    rows.append((999, " ".join(str(i % 700) for i in range(3000))))
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id bigint, text string, runs string, n_words int")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in queries.op11_periodic_runs(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted((plain_row(*r) for r in rows), key=str)
    assert sum(zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in rows if r[0] is not None) >= 5  # some were altered
    texts = {r.doc_id: r.text.decode() for r in periodic.periodic_runs(docs.where("doc_id in (6, 9)")).collect()}
    assert texts == {6: "a b c", 9: "w"}


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert queries.op11_periodic_runs(spark, str(tmp_path)).count() == 0
