import random
import re

from vitalmart.llm import phrases

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def plain(docs, items, size):
    out = []
    for doc_id, text, *_ in docs:
        w, hit, found = words(text), set(), set()
        for item, t in items:
            v = words(t)
            for win in {tuple(v[i:i + size]) for i in range(max(1, len(v) - size + 1))} if v else ():
                for i in range(len(w) - len(win) + 1):
                    if tuple(w[i:i + len(win)]) == win:
                        hit |= set(range(i, i + len(win)))
                        found.add(str(item))
        out.append((doc_id, len(w), len(hit), sorted(found)))
    return out


def test_against_all_windows(spark, monkeypatch):
    rng = random.Random(1)
    make = lambda n: " ".join(rng.choice(["a", "b", "É", "Zz", "9"]) for _ in range(n))
    items = [(i, make(n)) for i, n in enumerate([0, 1, 3, 4, 9, 12, 4, 30])] + [(8, None), (10, "É b"), (9, "nowhere to be seen"), (3, "a b a 9")]
    docs = [(i, make(rng.randrange(60)), 1, 2) for i in range(60)] + [(None, "a b", 1, 2), (61, None, 1, 2), (62, "", 1, 2), (63, ".,-", 1, 2),
            (5, "a_b:a;9 É", 1, 2), (5, "a_b:a;9 É", 1, 2), (64, make(30000), 1, 2), (65, items[7][1].upper().lower(), 1, 2)]
    d = spark.createDataFrame(docs, "doc_id bigint, text string, item_id int, segment int")
    b = spark.createDataFrame(items, "item_id bigint, text string")
    for size in (4, 10):
        key = lambda r: (str(r[0]), r[1:3], r[3])
        got = [(r.doc_id, r.n_words, r.n_hit, r["items"]) for r in phrases.contamination(d, b, size=size).collect()]
        assert sorted(got, key=key) == sorted(plain(docs, items, size), key=key)
    monkeypatch.setattr(phrases, "WINDOWS_PER_PASS", 7)
    got = [(r.doc_id, r.n_words, r.n_hit, r["items"]) for r in phrases.contamination(d, b, size=4).collect()]
    assert sorted(got, key=key) == sorted(plain(docs, items, 4), key=key)
    hit = {r[0] for r in plain(docs, items, 4) if r[2]}
    left = phrases.without_contaminated(d, b, size=4)
    assert left.columns == d.columns and {r.doc_id for r in left.collect()} == ({r[0] for r in docs} - hit) | {None}


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "some words here")], "doc_id bigint, text string")
    b = spark.createDataFrame([], "item_id bigint, text string")
    assert [tuple(r) for r in phrases.contamination(d, b).collect()] == [(1, 3, 0, [], [])]
    assert phrases.contamination(d.limit(0), b).count() == 0


def test_proximity(spark):
    b = spark.createDataFrame([(1, "red fox jumps high"), (2, "red owl")], "item_id bigint, text string")
    d = spark.createDataFrame([(1, "high it jumps the fox so red"), (2, "red fox jumps high"), (3, "red " + "x " * 20 + "owl"),
                               (4, "red"), (5, "owl")], "doc_id bigint, text string")
    got = {r.doc_id: (r["items"], r.near_items) for r in phrases.contamination(d, b, reach=6).collect()}
    assert got == {1: ([], ["1"]), 2: (["1"], []), 3: ([], []), 4: ([], []), 5: ([], [])}


def plain_near(docs, items, size, reach):
    """Items with a window whose words all lie around one of them, and no window in the text itself."""
    out = []
    for doc_id, text, *_ in docs:
        w, exact, near = words(text), set(), set()
        for item, t in items:
            v = words(t)
            for win in {tuple(v[i:i + size]) for i in range(max(1, len(v) - size + 1))} if v else ():
                if any(tuple(w[i:i + len(win)]) == win for i in range(len(w))):
                    exact.add(str(item))
                elif any(x in win and set(win) <= set(w[max(0, i - reach):i + reach + 1]) for i, x in enumerate(w)):
                    near.add(str(item))
        out.append((doc_id, sorted(near - exact)))
    return out


def test_proximity_is_decided_per_document(spark):
    """A near document in one block with an exact one, and random texts in one and in many blocks."""
    b = spark.createDataFrame([(1, "red fox jumps high")], "item_id bigint, text string")
    d = spark.createDataFrame([(1, "high it jumps the fox so red"), (2, "red fox jumps high")], "doc_id bigint, text string")
    got = {r.doc_id: (r["items"], r.near_items) for r in phrases.contamination(d.coalesce(1), b, reach=6).collect()}
    assert got == {1: ([], ["1"]), 2: (["1"], [])}
    rng = random.Random(4)
    make = lambda n: " ".join(rng.choice("abcdefghijkl") for _ in range(n))
    items = [(i, make(n)) for i, n in enumerate([1, 2, 4, 5, 6, 7, 8, 12])]
    docs = [(i, make(rng.randrange(50))) for i in range(120)]
    want = sorted(plain_near(docs, items, 5, 6))
    assert sum(bool(near) for _, near in want) > 20
    d, b = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    for parts in (1, 40):
        assert sorted((r.doc_id, r.near_items) for r in phrases.contamination(d.repartition(parts), b, size=5, reach=6).collect()) == want


def test_registered_query_returns_both_halves(spark, tmp_path):
    from vitalmart.llm.queries import QUERIES

    spark.createDataFrame([(1, "red fox jumps high")], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(1, "high it jumps the fox so red"), (2, "red fox jumps high")], "doc_id bigint, text string").coalesce(1).write.parquet(
        f"{tmp_path}/documents.parquet")
    exact = QUERIES["op9_decontamination_index"](spark, str(tmp_path))
    both = QUERIES["op9_decontamination_proximity"](spark, str(tmp_path))
    assert both.columns == [*exact.columns, "near_items"]
    assert {r.doc_id: (r.contaminated, r.near_items) for r in both.collect()} == {1: (False, "1"), 2: (True, "")}


def test_pipeline_stage_drops_rows_by_their_own_verdict(spark, tmp_path):
    import corpus_pipeline

    spark.createDataFrame([(1, "red fox jumps high")], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(None, "a red fox jumps high"), (None, "clean"), (3, "red fox jumps high"), (3, "clean too"), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    left = corpus_pipeline.decontaminate(spark, docs, str(tmp_path))
    assert {(r.doc_id, r.text) for r in left.collect()} == {(None, "clean"), (3, "clean too"), (4, None)}


def test_blocks_of_the_index_are_written_one_by_one(spark, monkeypatch):
    """Parquet's writer held up to 100 blocks of megabytes in memory, and their readers got them at once."""
    import glob

    import pyarrow.parquet as pq
    kept, stored = [], phrases.stored
    monkeypatch.setattr(phrases, "stored", lambda df, name, **options: kept.append(stored(df, name, **options)) or kept[-1])
    long = " ".join(f"w{i % 5000}" for i in range(500_000))
    docs = spark.createDataFrame([(i, f"{i} {long}") for i in range(4)], "doc_id bigint, text string").coalesce(1)
    items = spark.createDataFrame([(7, "w1 w2 w3")], "item_id bigint, text string")
    out = phrases.contamination(docs, items, reach=0).collect()
    assert sorted((r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in out) == [(i, 500_001, 300, ["7"]) for i in range(4)]
    files = [pq.ParquetFile(f).metadata for f in glob.glob(kept[0].scratch.removeprefix("file:") + "/*.parquet")]
    groups = [m.row_group(i).num_rows for m in files for i in range(m.num_row_groups)]
    assert len(groups) >= 3 and set(groups) == {1}
