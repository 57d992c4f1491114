"""Each stage of the pipeline against plain loops over its own input."""

import hashlib

import corpus_pipeline
import tiktoken
from test_lines import plain as plain_lines
from test_phrases import plain as plain_phrases
from test_shingles import plain_components

from vitalmart.llm import bpe, langid
from vitalmart.llm.common import stored
from vitalmart.llm.queries import vocabulary

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages_and_run(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language ID", "line dedup", "SimHash near-dedup", "benchmark decontamination", "byte-level BPE"]
    columns = spark.read.parquet(f"{SF}/documents.parquet").columns
    given = [stored(spark.read.parquet(f"{SF}/documents.parquet"), "given")]
    for _, stage in corpus_pipeline.STAGES:
        given.append(stored(stage(spark, given[-1], SF), "stage"))
    assert all(d.columns == columns for d in given[:-1])
    docs, spoken, cut, single, clean, coded = map(rows_of, given)

    found = rows_of(langid.predict(given[0]))
    assert set(spoken) == {i for i, r in found.items() if r.lang_pred != "und" and not r.ambiguous}
    assert len(spoken) >= 0.97 * len(docs) and all(spoken[i] == docs[i] for i in spoken)

    want = {i: t for i, t, n, gone in plain_lines([(i, r.text) for i, r in spoken.items()]) if n == 0 or gone < n}
    assert {i: r.text for i, r in cut.items()} == want and all(r.n_chars == len(r.text) for r in cut.values())

    assert set(single) == {i for i, least in plain_components([(i, r.text) for i, r in cut.items()]) if i == least}

    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    hit = {i for i, _, n, _ in plain_phrases([(i, r.text) for i, r in single.items()], items, 10) if n}
    assert hit and set(clean) == set(single) - hit

    path, pattern = vocabulary()
    reference = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.load_ranks(path), special_tokens={})
    assert {i: r.ids for i, r in coded.items()} == {i: reference.encode_ordinary(r.text) for i, r in clean.items()}
    assert all(r.round_trip and r.decoded_sha256 == hashlib.sha256(clean[i].text.encode()).hexdigest() for i, r in coded.items())

    whole = corpus_pipeline.run(spark, SF)
    assert rows_of(whole) == coded


def test_stages_on_gaps_repeats_and_clashing_columns(spark):
    """NULL texts and ids, repeated rows and ids, columns named like the operators' own, and no rows at all."""
    words = "the quick brown fox jumps over the lazy dog and runs into the deep green forest where it sleeps".split()
    line = lambda k: " ".join(words[k:] + words[:k])
    rows = [(1, line(0), "en"), (2, line(3), "en"), (2, line(3), "en"), (2, line(6), "en"), (None, line(9), "en"), (None, line(9), "en"), (3, None, "en"),
            (4, "", None), (5, "12 34", "en"), (6, line(0) + " once more", "en"), (7, line(12) + "\n" + line(12), None)]
    rows = [(*r, "src", 5, "mine", 1, 2, 3) for r in rows]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, rejected string, key int, node int, row int"
    for given in (rows, []):
        docs = stored(spark.createDataFrame(given, schema), "given")
        columns, sizes = docs.columns, []
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stored(stage(spark, docs, SF), "stage")
            assert docs.columns == columns
            sizes.append(docs.count())
        coded = stored(corpus_pipeline.STAGES[-1][1](spark, docs, SF), "coded")
        assert coded.count() == sizes[-1]
        if given:
            assert sizes == sorted(sizes, reverse=True) and sizes[0] == 8  # NULL, empty and letterless texts are gone
            assert all(r.round_trip for r in coded.collect())
        else:
            assert sizes == [0] * 4
