import random

from vitalmart.llm import lines


def cut(text):
    return (text or "").split("\n")


def token_set(line):
    return frozenset(w for w in __import__("re").split("[\x20\x09-\x0d]+", line.lower()) if w)


def plain(rows, num=4, den=5):
    """Every line against all earlier lines."""
    docs = sorted({(r[0] is None, r[0], lines_hash(r[1]), r[1]) for r in rows if r[1] is not None}, key=lambda x: (x[0], x[1] or 0, x[2]))
    seen, gone = [], {}
    for _, doc, _, text in docs:
        for ln, line in enumerate(cut(text)):
            s = token_set(line)
            if s:
                gone[doc, text, ln] = any(len(s & o) * (num + den) >= num * (len(s) + len(o)) for o in seen)
                seen.append(s)
    out = []
    for doc, text, *_ in rows:
        if text is None:
            out.append((doc, None, 0, 0))
            continue
        flags = [gone.get((doc, text, ln), False) for ln in range(len(cut(text)))]
        worded = sum(bool(token_set(x)) for x in cut(text))
        out.append((doc, "\n".join(x for x, g in zip(cut(text), flags) if not g), worded, sum(flags)))
    return out


def lines_hash(text):
    import xxhash
    h = xxhash.xxh64_intdigest((text or "").encode(), 42)
    return h - (1 << 64) if h >> 63 else h


def key(r):
    return (str(r[0]), str(r[1]), r[2], r[3])


def test_against_all_earlier_lines(spark):
    rng = random.Random(11)
    base = [[f"w{rng.randrange(400)}" for _ in range(rng.randrange(1, 40))] for _ in range(60)]

    def vary():
        line = list(rng.choice(base))
        for _ in range(rng.randrange(4)):
            line[rng.randrange(len(line))] = f"w{rng.randrange(400)}"
        rng.random() < 0.3 and rng.shuffle(line)
        return " ".join(w.upper() if rng.random() < 0.1 else w for w in line)

    rows = [(i, "\n".join(vary() for _ in range(rng.randrange(1, 8))), i, "x") for i in range(70)]
    rows += [(100, None, 1, "x"), (101, "", 1, "x"), (102, " \n\t\n", 1, "x"), (103, "one\n\nOne\none two three four\nfour three two one", 1, "x"),
             (5, rows[5][1], 9, "again"), (5, "a different text of five", 9, "x"), (None, rows[3][1], 1, "x"), (104, "a b c d\na b c d e\nb c d e f", 2, "x"),
             (105, "\n".join(f"w{i % 300} line {i % 700}" for i in range(3000)), 1, "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_lines int, row string")
    got = [(r["row"].doc_id, r.text, r.n_lines, r.n_removed) for r in lines.dedup(docs).collect()]
    assert sorted(got, key=key) == sorted(plain(rows), key=key)
    kept = lines.without_repeats(docs)
    assert kept.columns == docs.columns
    want = sorted((str(d), str(t)) for d, t, n, g in plain(rows) if n == 0 or g < n)
    assert sorted((str(r.doc_id), str(r.text)) for r in kept.collect()) == want
    assert lines.dedup(docs.limit(0)).count() == 0


def test_no_python_in_the_plan(spark, capsys):
    docs = spark.createDataFrame([(1, "a b\nc")], "doc_id bigint, text string")
    lines.dedup(docs).explain()
    assert "Python" not in capsys.readouterr().out


def test_lines_of_one_template_give_pairs_in_proportion(spark):
    """20 common words and one of its own: every two lines are alike, yet each line meets one earlier line per token."""
    from pyspark.sql import functions as F
    common = " ".join(f"c{i}" for i in range(20))
    for n in (300, 600):
        table = spark.range(n).select("id", F.concat(F.lit(common + " own"), F.col("id").cast("string")).alias("line"))
        hashed = table.select("id", lines._hashes(F.col("line")).alias("hashes"))
        rows = lines.prefix_rows(hashed, lines.rarity(hashed.select(F.explode("hashes").alias("h"))), 4, 5).cache()
        pairs = lines.earliest_candidates(rows, 4, 5)
        assert {(r.early, r.late) for r in pairs.collect()} == {(0, i) for i in range(1, n)}
        rest = rows.where("id = 0")  # all others are settled
        assert lines.candidates(rows, rest, 4, 5).count() == 0
        out = lines.dedup(table.select(F.col("id").alias("doc_id"), F.col("line").alias("text")))
        assert {r["row"].doc_id for r in out.where("n_removed = 0").collect()} == {0}


def test_words_travel_as_one_string(spark, monkeypatch):
    """Arrays of strings filled the disk when pairs carried both lines' words into verification."""
    seen, stored = [], lines.stored
    monkeypatch.setattr(lines, "stored", lambda df, name: seen.append((name, dict(df.dtypes))) or stored(df, name))
    docs = spark.createDataFrame([(1, "a B\tc d e\nf"), (2, "E d c  b a x"), (3, "a b c d x\ny")], "doc_id bigint, text string")
    out = {r["row"].doc_id: r.text for r in lines.dedup(docs).collect()}
    assert out == {1: "a B\tc d e\nf", 2: "", 3: "y"}
    words = [types for name, types in seen if name == "words"]
    assert words and all(types == {"id": "bigint", "n": "int", "words": "string"} for types in words)


def test_signatures_are_made_once_per_line(spark, capsys):
    """Made behind the explode, they were made again for each token of a prefix."""
    from pyspark.sql import functions as F
    hashed = spark.createDataFrame([(1, list(range(40)))], "id bigint, hashes array<bigint>")
    rows = lines.prefix_rows(hashed, lines.rarity(hashed.select(F.explode("hashes").alias("h"))), 4, 5)
    assert rows.count() == 9
    rows.explain()
    plan = capsys.readouterr().out.splitlines()
    assert next(i for i, x in enumerate(plan) if "Generate posexplode" in x) < min(i for i, x in enumerate(plan) if "aggregate(" in x)


def test_long_lines_that_are_not_alike_give_few_pairs(spark):
    """Lines of 160 tokens, drawn from 240: 64 parities pass more than four pairs in ten."""
    from pyspark.sql import functions as F
    rng = random.Random(5)
    sets = [(i, rng.sample(range(240), 160)) for i in range(300)]
    table = spark.createDataFrame(sets, "id bigint, tokens array<bigint>").select("id", F.transform("tokens", lambda t: F.xxhash64(t)).alias("hashes"))
    assert all(len(set(a) ^ set(b)) > 72 for i, (_, a) in enumerate(sets) for _, b in sets[:i])
    ranks = spark.createDataFrame([([0] * (1 << lines.SKETCH_BITS),)], "ranks array<bigint>")
    signed = lines.prefixes(table, ranks, 4, 5).withColumn("at", F.lit(0)).cache()
    x, y = (lambda c: F.col(f"x.{c}")), (lambda c: F.col(f"y.{c}"))
    pairs = signed.alias("x").join(signed.alias("y"), F.expr("x.id < y.id"))
    assert pairs.where(F.bit_count(x("sig").bitwiseXOR(x("sig2")).bitwiseXOR(y("sig")).bitwiseXOR(y("sig2"))) <= 35).count() > 20000
    assert pairs.where(lines._close(x, y, 4, 5)).count() < 4485  # a tenth of 300 * 299 / 2


def test_scratch_tables_go_when_nothing_reads_them(spark, monkeypatch):
    """All stayed on disk until the session's end, under every later stage of the pipeline."""
    import os
    seen, stored = [], lines.stored

    def noted(df, name):
        seen.append((name, stored(df, name)))
        return seen[-1][1]

    monkeypatch.setattr(lines, "stored", noted)
    docs = spark.createDataFrame([(1, "a b c d e f\ng"), (2, "a b c d e x\ng"), (3, "f e d c b a")], "doc_id bigint, text string")
    out = lines.dedup(docs)
    there = lambda t: os.path.exists(t.scratch.removeprefix("file:"))
    left = {name for name, t in seen if there(t)}
    assert not left & {"heads", "prefixes", "rarity", "words"} and {"lines", "settled", "others"} <= left
    assert {r["row"].doc_id: r.n_removed for r in out.collect()} == {1: 0, 2: 1, 3: 1}
