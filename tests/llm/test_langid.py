import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from vitalmart.llm import langid

SYLLABLES = {"aa": ["ba", "lo", "mi", "ra"], "bb": ["tzu", "kro", "vex", "shu"], "cc": ["ñe", "éo", "ção", "ü"], "dd": ["wh", "th", "ly", "ing"],
             "ee": ["по", "ка", "же", "ли"]}


def text(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def rows(langs, n=200):
    rng = random.Random(6)
    return [(i, text(rng, lang := langs[i % len(langs)], rng.randrange(4, 60)), lang) for i in range(n)]


def test_held_out_accuracy_and_edge_cases(spark):
    data = rows(list(SYLLABLES))
    odd = [(1000, None, "aa"), (1001, "", "bb"), (1002, "123 ### 4!", None), (1003, "ba lo mi ra lo", None), (None, "tzu kro vex", "aa"), (7, data[7][1], data[7][2]),
           (1004, text(random.Random(1), "dd", 90000), None)]
    docs = spark.createDataFrame([(*r, 1) for r in data + odd], "doc_id bigint, text string, lang string, score int")
    got = langid.predict(docs).collect()
    assert len(got) == len(data + odd)
    truth = {i: lang for i, _, lang in data}
    out = [r for r in got if r.doc_id in truth and r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None)
    assert len(out) > 20 and sum(r.lang_pred == truth[r.doc_id] for r in out) >= 0.97 * len(out)
    by_id = {r.doc_id: r for r in got}
    assert [by_id[i].lang_pred for i in (1000, 1001, 1002, 1003, 1004, None)] == ["und", "und", "und", "aa", "dd", "bb"]
    assert by_id[1000].score == 0 and by_id[None].held_out and all(0 <= r.score <= 1 for r in got)
    kept = langid.keep_identified(docs)
    assert kept.columns == docs.columns and not {1000, 1001, 1002} & {r.doc_id for r in kept.collect()}


def test_mixed_text_is_ambiguous(spark):
    rng = random.Random(3)
    mixed = [(5000 + i, text(rng, "aa", 30) + " " + text(rng, "bb", 21), None) for i in range(6)]
    docs = spark.createDataFrame(rows(["aa", "bb", "dd"]) + mixed, "doc_id bigint, text string, lang string")
    got = {r.doc_id: r for r in langid.predict(docs, gap=0.2).collect()}
    clear = [r for i, r in got.items() if i < 5000]
    assert sum(r.ambiguous for r in clear) <= 0.03 * len(clear)
    assert all(got[i].score < 0.95 for i, _, _ in mixed)


def test_few_languages_and_no_rows(spark):
    docs = spark.createDataFrame(rows(["aa"], 20), "doc_id bigint, text string, lang string")
    assert {r.lang_pred for r in langid.predict(docs).collect()} == {"aa"}
    assert {(r.lang_pred, r.score) for r in langid.predict(docs, held_out=F.lit(True)).collect()} == {("und", 0.0)}
    assert langid.predict(docs.limit(0)).count() == 0


def test_code_matrix():
    for n in (2, 3, 4, 7, 8, 40):
        code = langid.code_matrix(n)
        assert code.shape[0] == n and set(np.unique(code)) == {-1, 1}
        assert len({tuple(c) for c in code}) == n and langid.min_distance(code) >= 1
    assert langid.min_distance(langid.code_matrix(4)) == 4


def test_pieces_of_a_long_text_give_all_ngrams(monkeypatch):
    sample = ("éa" * 50 + " the end ").encode() * 20
    whole = np.bincount(np.concatenate(list(langid.grams(sample))), minlength=langid.BUCKETS)
    monkeypatch.setattr(langid, "_PIECE", 64)
    assert (np.bincount(np.concatenate(list(langid.grams(sample))), minlength=langid.BUCKETS) == whole).all()


def test_every_row_follows_its_own_verdict(spark):
    data = [(*r, 1) for r in rows(list(SYLLABLES))]
    odd = [(None, "123 ### 4!", None, 1), (None, data[1][1], "bb", 1), (3, "### 5", None, 1), (3, None, None, 1)]
    docs = spark.createDataFrame(data + odd, "doc_id bigint, text string, lang string, score int")
    found = {(r.doc_id, r.text) for r in langid.keep_identified(docs).collect()}
    assert not found & {(i, t) for i, t, _, _ in (odd[0], odd[2], odd[3])}
    assert {(None, data[1][1]), (3, data[3][1])} <= found


def test_stage_with_a_clashing_column(spark):
    """Columns named like the operator's own neither break nor change the verdicts."""
    docs = spark.createDataFrame([(i, "the cat sat on the mat and the dog" if i % 2 else "der Hund und die Katze auf der Matte", "en" if i % 2 else "de", 7)
                                  for i in range(60)] + [(60, "12345", "en", 7)], "doc_id bigint, text string, lang string, rejected int")
    clashing = docs.withColumn("rejected_", docs.rejected).withColumn("key", docs.rejected)
    kept = langid.keep_identified(clashing)
    assert kept.columns == clashing.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in langid.keep_identified(docs.drop("rejected")).collect())
    assert 60 not in {r.doc_id for r in kept.collect()}
