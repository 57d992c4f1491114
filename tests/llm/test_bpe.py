import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from vitalmart.llm import bpe
from vitalmart.llm.queries import vocabulary

PATH, PATTERN = vocabulary()


@pytest.fixture(scope="module")
def ranks():
    return bpe.load_ranks(PATH)


@pytest.fixture(scope="module")
def reference(ranks):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_perfect_hash_is_minimal(ranks):
    table = bpe.PerfectHash(list(ranks))
    assert sorted(table.slots(list(ranks)).tolist()) == list(range(len(ranks)))
    assert (table.slots([b"no such token at all", b""]) == -1).all()
    assert bpe.PerfectHash([]).slots([b"x"]).tolist() == [-1]


def test_merge_of_random_pieces(ranks, reference):
    rng = random.Random(4)
    for _ in range(400):
        piece = "".join(rng.choice("abcdeinorst éßñ") for _ in range(rng.randrange(1, 40))).replace(" ", "")
        if piece and piece.encode() not in ranks:
            assert bpe.merge(piece.encode(), ranks) == reference._encode_single_piece(piece.encode())


def test_documents(spark, reference):
    rng = random.Random(9)
    texts = [None, "", " ", "\n\n  \t", "The quick brown fox's 12345 tests!!", "<|endoftext|> plain", "日本語 テキスト 🙂🙂", "a\u0000b",
             "x" * 20000, "ab" * 9000 + " é" * 500, "Überprüfung ciónmente l'été", " ".join(
                 "".join(rng.choice("etaoinsh") for _ in range(rng.randrange(1, 12))) for _ in range(3000))]
    rows = [(i, t, "clash") for i, t in enumerate(texts)] + [(4, texts[4], "again"), (None, "no id", "n")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, ids string")
    want = sorted((str(i), reference.encode_ordinary(t or "")) for i, t, _ in rows)
    got = bpe.encode(docs, PATH, PATTERN)
    assert sorted((str(r.doc_id), r.ids) for r in got.collect()) == want
    back = {(str(r.doc_id), r.text) for r in bpe.decode(got, PATH).collect()}
    assert back == {(str(i), t or "") for i, t, _ in rows}
    sha = lambda x: hashlib.sha256(x).hexdigest()
    got = sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.digests(docs, PATH, PATTERN).collect())
    assert got == sorted((str(i), len(e := reference.encode_ordinary(t or "")), sha(",".join(map(str, e)).encode()),
                          sha((t or "").encode())) for i, t, _ in rows)
    assert bpe.encode(docs.limit(0), PATH, PATTERN).count() == 0


def test_small_memory_changes_nothing(ranks, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    tokenizer = bpe.Tokenizer(*bpe.tables(PATH), public_tokenizers.PATTERN)
    assert [tokenizer.decode(x) for x in tokenizer.encode_batch(["one two three four", "two five six"])] == [
        b"one two three four", b"two five six"]
    assert [tokenizer.decode(x) for x in tokenizer.encode_batch(["seven one"])] == [b"seven one"]
