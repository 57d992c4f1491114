import math
import random
from collections import Counter

import xxhash

from vitalmart.llm import resampling


def plain_buckets(text):
    words = (text or "").encode().lower().split()
    h = [xxhash.xxh32_intdigest(w) for w in words]
    mask = (1 << 64) - 1
    pairs = [((((a * 0x9E3779B1) + b) & mask) * 0x9E3779B97F4A7C15 & mask) >> 32 for a, b in zip(h, h[1:])]
    return [x % resampling.BUCKETS for x in h + pairs]


def test_weights_and_draw(spark):
    rng = random.Random(2)
    rows = []
    for i in range(400):
        words = [rng.choice(["sun", "sea", "sky"]) if i % 4 else rng.choice(["###", "!!!", "sun"]) for _ in range(rng.randrange(0, 40))]
        rows.append((i, " ".join(words)))
    rows += [(400, None), (401, ""), (None, "sun sea"), (7, rows[7][1]), (402, "!!! " * 20000)]
    target = [(i,) for i in range(400) if i % 4 and i % 2] + [(None,), (7,), (7,), (12345,)]
    docs = spark.createDataFrame([(*r, 1.0, True) for r in rows], "doc_id bigint, text string, key double, target boolean")
    ids = spark.createDataFrame(target, "doc_id bigint")
    named = {i for i, in target if i is not None}
    raw, aim = Counter(), Counter()
    for i, t in rows:
        raw.update(plain_buckets(t))
        if i in named:
            aim.update(plain_buckets(t))
    n, m = sum(raw.values()), sum(aim.values())
    ratio = lambda b: math.log((aim[b] + 1) / (m + resampling.BUCKETS)) - math.log((raw[b] + 1) / (n + resampling.BUCKETS))
    got = resampling.resample(docs, ids, share=0.7).collect()
    assert sorted((str(r.doc_id), r.n_grams, round(r.log_weight, 6)) for r in got) == sorted(
        (str(i), len(b := plain_buckets(t)), round(sum(map(ratio, b)), 6) + 0.0) for i, t in rows)
    assert sum(r.kept for r in got) == round(0.7 * len(rows))
    assert min(r.key for r in got if r.kept) >= max(r.key for r in got if not r.kept)
    long = [r for r in got if r.doc_id is not None and r.doc_id < 400 and r.n_grams > 20]
    assert all(r.kept for r in long if r.doc_id % 4) and not any(r.kept for r in long if r.doc_id % 4 == 0)
    again = {(r.doc_id, r.key) for r in resampling.resample(docs, ids, share=0.7).collect()}
    assert again == {(r.doc_id, r.key) for r in got}
    assert {r.log_weight for r in resampling.resample(docs, ids.limit(0)).collect()} == {0.0}
    assert resampling.resample(docs.limit(0), ids).count() == 0


def test_top_k_with_ties_and_all_sizes(spark):
    rng = random.Random(4)
    keys = [rng.choice([-3.5, 0.0, -0.0, 2.25, 1e9, -1e-9, rng.gauss(0, 1)]) for _ in range(300)]
    rows = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "i int, k double")
    for k in (0, 1, 7, 150, 299, 300, 500):
        got = sorted(r.i for r in resampling.top_k(rows, "k", k, ["i"]).where("kept").collect())
        assert got == sorted(sorted(range(300), key=lambda i: (-keys[i], i))[:k])


def test_gumbel_noise_draws_in_proportion(spark):
    rows = spark.range(40000).selectExpr("id as doc_id", "id * 7 as text_hash", "case when id % 2 = 0 then 3.0D else 1.0D end as w")
    keyed = rows.withColumn("key", __import__("pyspark.sql.functions").sql.functions.log("w") + resampling._gumbel(17))
    kept = resampling.top_k(keyed, "key", 400, ["doc_id"]).where("kept")
    assert abs(kept.where("w = 3").count() - 300) < 40
