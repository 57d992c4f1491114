"""Fingerprints and classes against plain loops over all pairs."""

import random

import xxhash
from pyspark.sql import functions as F

from vitalmart.llm import simhash
from vitalmart.llm.components import connected_components


def plain_fingerprint(text):
    words = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", words) if w]
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_classes(nodes, near):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(nodes):
        for b in nodes[i + 1:]:
            if near(a, b):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {n: find(n) for n in nodes}


def test_documents_edge_cases(spark):
    rng = random.Random(3)
    base = [f"w{rng.randrange(50)}" for _ in range(400)]
    texts = [None, "", " \t\n", "One", "one", "one two", "ONE TWO", "É a b c d", "é a b c d", "x\x0by\x0cz q"]
    texts += [" ".join(base)] * 4 + [" ".join(base[:i] + ["new"] + base[i + 1:]) for i in (5, 90, 200)]
    texts += [" ".join(base[i:]) for i in range(1, 5)] + ["long " * 70000]
    rows = [(i * 3, t, "extra", 7) for i, t in enumerate(texts)] + [(9, "one", "extra", 7), (None, "one", "e", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, fp string, component_id int")
    got = simhash.near_duplicates(docs).collect()
    fps = {(r[0], r[1]): plain_fingerprint(r[1]) for r in rows}
    root = plain_classes(sorted({v for v in fps.values()}), lambda a, b: (a ^ b).bit_count() <= 2)
    least = {}
    for (i, _), f in fps.items():
        if i is not None:
            least[root[f]] = min(i, least.get(root[f], 1 << 60))
    want = sorted((-1 if r[0] is None else r[0], fps[r[0], r[1]], least[root[fps[r[0], r[1]]]]) for r in rows)
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.fp % (1 << 64), r.component_id) for r in got) == want
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} - {None} == set(least.values())
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_links_of_random_and_crowded_fingerprints(spark):
    rng = random.Random(5)
    crowd = rng.getrandbits(64)
    nodes = {crowd} | {crowd ^ (1 << i) ^ (1 << rng.randrange(64)) for i in range(64) for _ in range(6)}
    for _ in range(150):
        x = rng.getrandbits(64)
        nodes |= {x, x ^ 1 << rng.randrange(64), x ^ 3 << rng.randrange(62), x ^ 7 << rng.randrange(60)}
    nodes = sorted(nodes)
    fps = spark.createDataFrame([(simhash._signed(n),) for n in nodes], "fp bigint")
    for limit in (2, 1, 0):
        links = [(r.a % (1 << 64), r.b % (1 << 64)) for r in simhash.near_links(fps, limit).collect()]
        want = plain_classes(nodes, lambda a, b: (a ^ b).bit_count() <= limit)
        linked = {frozenset(x) for x in links}
        assert len(linked) < 60000
        assert plain_classes(nodes, lambda a, b: frozenset((a, b)) in linked) == want


def test_hot_bucket_is_linked_without_pairs(spark):
    fps = spark.range(4096).select((F.col("id") * 16).alias("fp"))  # 12 free bits: one class, one hot bucket
    links = simhash.near_links(fps)
    assert links.count() < 4096 * 66
    assert connected_components(links).select("root").distinct().count() == 1


def test_components_of_a_long_chain_and_a_star(spark):
    chain = spark.range(1, 300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    star = spark.range(1001, 1400).select(F.lit(1000).cast("bigint").alias("a"), F.col("id").alias("b"))
    odd = spark.createDataFrame([(5, 5), (None, 7), (7, None)], "a bigint, b bigint")
    got = connected_components(chain.union(star).union(star).union(odd))
    sizes = sorted(r["count"] for r in got.groupBy("root").count().collect())
    assert sizes == [300, 400] and got.count() == 700
    assert connected_components(odd).count() == 0
