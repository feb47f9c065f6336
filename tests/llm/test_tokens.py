import hashlib
import random

import numpy as np
import pytest

from kinweave.llm import bpe

tiktoken = pytest.importorskip("tiktoken")


@pytest.fixture(scope="module")
def public():
    return bpe.public_vocabulary()


@pytest.fixture(scope="module")
def vocabulary(public):
    return bpe.Vocabulary.from_lines(public[0])


def test_same_ids_as_the_library(public, vocabulary, docs):
    known = tiktoken.Encoding("own", pat_str=public[1], mergeable_ranks=vocabulary.ranks, special_tokens={})
    enc = bpe.TextEncoder(vocabulary, public[1])
    texts = [r[0] or "" for r in docs.select("text").collect()]
    texts += ["", " ", "\n\n x \t", "a" * 3000, "日本語テキスト" * 50, "don't 've", "é" * 400, "=-" * 300, "<|endoftext|>"]
    for t in texts:
        packed = enc.encode(t)
        assert np.frombuffer(packed, "<u4").tolist() == known.encode_ordinary(t)
        assert enc.decode(packed) == t.encode()


def test_pairs_by_definition(vocabulary):
    r = random.Random(1)
    for _ in range(20000):
        a, b = r.randrange(4000), r.randrange(4000)
        x, y = vocabulary.tokens[a], vocabulary.tokens[b]
        assert vocabulary.follows(a, b) == (vocabulary.merge(x + y) == [x, y])


def test_appends_and_edits(vocabulary):
    r = random.Random(2)
    enc = bpe.PrefixEncoder(vocabulary, b"the quick brown fox jumps " * 20)
    for _ in range(40):
        if r.random() < 0.3:
            enc.append(bytes(r.choice(b"aeth ") for _ in range(r.randrange(4))))
        else:
            at = r.randrange(len(enc.data))
            enc.edit(at, min(len(enc.data), at + r.randrange(5)), bytes(r.choice(b"abc the") for _ in range(r.randrange(6))))
        assert enc.ids() == [vocabulary.ranks[x] for x in vocabulary.merge(enc.data)]


def test_edit_redoes_only_what_is_near(vocabulary):
    enc = bpe.PrefixEncoder(vocabulary, b"some words here " * 200)
    assert enc.edit(10, 11, b"x") < 400


def test_odd_rows(spark, public, odd):
    rows = bpe.digests(odd, *public, ids=True).collect()
    assert len(rows) == 10
    none = hashlib.sha256(b"").hexdigest()
    for r in rows:
        if r["doc_id"] in (2, 3):
            assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (0, none, none)
    texts = {r["text"] or "" for r in odd.collect()}
    assert {r["decoded_sha256"] for r in rows} == {hashlib.sha256(t.encode()).hexdigest() for t in texts}
    assert bpe.digests(odd.limit(0), *public).count() == 0


def test_columns_round_trip(spark, public):
    df = spark.createDataFrame([(1, "héllo wörld"), (2, None)], "doc_id long, text string")
    out = bpe.decode(bpe.encode(df, *public), *public).orderBy("doc_id").collect()
    assert [bytes(r["decoded"]) for r in out] == ["héllo wörld".encode(), b""]
