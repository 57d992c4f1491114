import math
import random
import re

from pyspark.sql import functions as F

from vitalmart.llm import quality


def plain_counts(text):
    text = text or ""
    words = [w for w in re.split("[\x20\x09-\x0d]+", text) if w]
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    runs = {}
    for i in range(len(words) - 4):
        runs.setdefault(tuple(words[i:i + 5]), []).append(i)
    hit = {k for v in runs.values() if len(v) > 1 for i in v for k in range(i, i + 5)}
    return (len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text)), len(lines), len(lines) - len(set(lines)), len(hit),
            len(re.findall("[A-Z]", text)), len(re.findall("[!?]", text)))


def test_counts_against_loops(spark):
    rng = random.Random(8)
    texts = [None, "", " \t\n", "a b c d e", "a b c d e a b c d e", "x " * 40, "é🙂 # | <b>\r\n\r\nÉ!?", "l1\nl1\n l1\nl1", "word " * 30000]
    texts += [" ".join(rng.choice("abc") + rng.choice(["", "\n", "#"]) for _ in range(rng.randrange(80))) for _ in range(150)]
    docs = spark.createDataFrame([(i, t, 1, "c") for i, t in enumerate(texts)] + [(None, "no id", 1, "c"), (3, texts[3], 1, "c")],
                                 "doc_id bigint, text string, n_words int, stratum string")
    got = quality.features(docs).collect()
    assert len(got) == len(texts) + 2
    for r in got:
        want = plain_counts("no id" if r.doc_id is None else texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_lines, r.n_dup_lines, r.n_repeat_words, r.n_upper, r.n_marks) == want
        assert r.base_failed == (want[0] < 10 or 100 * want[5] > 20 * want[0])


def test_allowed_is_the_exact_binomial_bound(spark):
    def plain(n, risk, error):
        tail, best = 0.0, -1
        for k in range(int(n * risk) + 1):
            tail += math.exp(math.log(math.comb(n, k)) + k * math.log(risk) + (n - k) * math.log1p(-risk))
            best = k if tail <= error else best
        return best

    sizes = [0, 1, 10, 100, 460, 1000, 3000]
    rows = spark.createDataFrame([(n,) for n in sizes], "n bigint")
    for risk, error in ((0.01, 0.05), (0.05, 0.001), (0.3, 0.1)):
        got = [r.k for r in rows.orderBy("n").select(quality.allowed(F.col("n"), risk, F.lit(error)).alias("k")).collect()]
        assert got == [plain(n, risk, error) for n in sizes]
    big = spark.createDataFrame([(10_000_000,)], "n bigint").select(quality.allowed(F.col("n"), 1e-3, F.lit(1e-3)).alias("k")).first().k
    assert 9_600 < big < 9_950  # 10,000 less about three deviations


def sample():
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(6000):
        bad = i % 10 == 0
        words = [f"w{rng.randrange(5000)}" for _ in range(60)]
        text = " ".join(w + ("##" if bad or rng.random() < 0.01 else "") for w in words)
        rows.append((i, text, "en" if i % 5 else "de" if i % 2 else None))
        if i % 3 == 0:
            labels.append((i, 0 if bad else 1, 0))
    return rows, labels


def test_cutoffs_keep_good_texts_and_reject_junk(spark):
    rows, labels = sample()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    marks = spark.createDataFrame(labels + [(None, 1, 0), (99999, 1, 0), (3, 0, 1), (6, None, None)], "doc_id bigint, quality int, toxic int")
    got = {r.doc_id: r for r in quality.quality_rules(docs, marks, stratum=F.col("lang")).collect()}
    good, junk = [r for i, r in got.items() if i % 10], [r for i, r in got.items() if i % 10 == 0 and r.stratum == "en"]
    assert sum(not r.kept for r in good) <= 0.03 * len(good)
    assert not junk or all("symbol_share" in r.rejected_by for r in junk)
    counts = quality.features(docs, stratum=F.col("lang"))
    cutoffs = quality.certify(counts, marks).collect()
    assert {r.stratum for r in cutoffs} == {"en"}  # the others have too few labels for a guarantee
    assert all(r.rejected <= 0.03 / 6 * r.n_good for r in cutoffs)
    none = quality.quality_rules(docs, marks.limit(0))
    assert none.where("kept = base_failed").count() == 0
    assert quality.quality_rules(docs.limit(0), marks).count() == 0


def test_no_python_in_the_plan(spark, capsys):
    rows, labels = sample()
    docs = spark.createDataFrame(rows[:5], "doc_id bigint, text string, lang string")
    quality.quality_rules(docs, spark.createDataFrame(labels[:5], "doc_id bigint, quality int, toxic int")).explain()
    assert "Python" not in capsys.readouterr().out
