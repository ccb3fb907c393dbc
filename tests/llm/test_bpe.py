"""Byte-level BPE against the library's encoder, and exact round trips."""

import hashlib
import random

import pytest
import tiktoken

from linfit.llm import bpe


@pytest.fixture(scope="module")
def codec(vocabulary):
    return bpe.TextCodec(bpe.BytePairs(bpe.read_ranks(vocabulary[0])), vocabulary[1])


@pytest.fixture(scope="module")
def library(vocabulary):
    ranks = bpe.read_ranks(vocabulary[0])
    return tiktoken.Encoding("own", pat_str=vocabulary[1], mergeable_ranks=ranks, special_tokens={})


def test_random_texts(codec, library):
    rng = random.Random(3)
    signs = "ab \n\t é日本1½²'s.!-—  🙂the  \x1c"
    for _ in range(3000):
        text = "".join(rng.choice(signs) for _ in range(rng.randrange(40)))
        ids = codec.encode(text)
        assert ids == library.encode_ordinary(text), repr(text)
        assert codec.decode(ids) == text.encode()
    assert codec.encode(None) == [] and codec.encode("") == []


def test_appends_and_edits(codec):
    rng = random.Random(4)
    word = lambda n: bytes(rng.choice(b"abcthein ") for _ in range(n))
    for _ in range(40):
        data = word(150)
        p = bpe.Prefixes(codec.pairs, data[:90])
        p.append(data[90:])
        assert p.ids == codec.pairs.encode(data)
        a = rng.randrange(140)
        b, new = a + rng.randrange(8), word(rng.randrange(6))
        p.replace(a, b, new)
        assert p.data == data[:a] + new + data[b:]
        assert p.ids == codec.pairs.encode(p.data)


def test_an_edit_is_local(codec):
    p = bpe.Prefixes(codec.pairs, b"the cat sat on the mat. " * 400)
    assert p.replace(5, 6, b"b") < 1000


def test_every_token_encodes_to_itself(codec):
    assert all(codec.pairs.encode(t) == [r] for t, r in list(codec.pairs.ranks.items())[::50])


def test_table(documents, vocabulary, library, spark):
    found = bpe.token_digests(documents, *vocabulary).collect()
    rows = documents.select("doc_id", "text").collect()
    want = []
    for r in rows:
        ids = library.encode_ordinary(r.text or "")
        sha = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        want.append((str(r.doc_id), len(ids), sha, hashlib.sha256((r.text or "").encode()).hexdigest()))
    assert sorted((str(a), *b) for a, *b in found) == sorted(want)
    coded = bpe.encode_documents(documents, *vocabulary)
    back = bpe.decode_documents(coded, *vocabulary)
    assert all(bytes(r.decoded) == (r.text or "").encode() for r in back.collect())
    none = spark.createDataFrame([], "doc_id long, text string, source string")
    assert bpe.token_digests(none, *vocabulary).collect() == []
    assert bpe.token_documents(none, *vocabulary).collect() == []


def test_slices_long_texts_and_forgotten_pieces(codec, library, monkeypatch):
    rng = random.Random(6)
    texts = [" ".join("".join(rng.choice("abcdehinst.\n") for _ in range(rng.randrange(9))) for _ in range(rng.randrange(300))) for _ in range(40)]
    texts += [None, "", "x" * 40_000, "é" * 5000 + " 12"]
    want = [library.encode_ordinary(t or "") for t in texts]
    for remembered, together, pieces in ((0, 10, 7), (50, 1000, 100), (10**6, 10**6, 10**6)):
        for name, n in (("REMEMBERED", remembered), ("TOGETHER", together), ("PIECES", pieces)):
            monkeypatch.setattr(bpe, name, n)
        own = bpe.TextCodec(codec.pairs, codec.pattern.pattern)
        coded = own.coded(texts)
        assert [bpe.ids_of(d).tolist() for d, _ in coded] == want
        assert [b for _, b in coded] == [(t or "").encode() for t in texts]
        assert len(own.decimals) == len(own.decoded) <= max(remembered, 0)


def test_another_pattern(library, vocabulary):
    pattern = r"[a-z]+|[^a-z]+"
    own = bpe.TextCodec(bpe.BytePairs(bpe.read_ranks(vocabulary[0])), pattern)
    other = tiktoken.Encoding("other", pat_str=pattern, mergeable_ranks=own.pairs.ranks, special_tokens={})
    for text in ("a  b c 12 the cat, sat", "  lead and trail  ", "ünder wörld\n\n x"):
        assert own.encode(text) == other.encode_ordinary(text)
