"""BPE against the tokenizers library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from readloom.llm import bpe as B


@pytest.fixture(scope="module")
def theirs():
    made = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    made.no_truncation()
    made.no_padding()
    return made


@pytest.fixture(scope="module")
def ours():
    return B.Bpe(B.public_vocabulary())


def odd_texts() -> list[str]:
    rng = random.Random(5)
    ranges = [(32, 127), (0, 64), (0xA0, 0x250), (0x370, 0x500), (0x2000, 0x2070), (0x3000, 0x3100), (0x4E00, 0x4F00), (0x1F600, 0x1F640), (0x300, 0x370), (0xAC00, 0xAD00)]
    made = ["", " ", "It's WE'LL 'S don't", "a<|endoftext|>B <|startoftext|><|endoftext|>", "&" * 500, "x" * 3000, "ab" * 700, "ΑΣ ΣΑΣ.", "İI", "é Å", "1234 ½ ²"]
    for _ in range(400):
        low, high = rng.choice(ranges)
        made.append("".join(chr(rng.randrange(low, high)) if rng.random() < 0.8 else rng.choice(" '\n\x85 aZ") for _ in range(rng.randrange(1, 120))))
    return made


def test_same_ids_and_text(theirs, ours):
    for text in odd_texts():
        ids = theirs.encode(text, add_special_tokens=False).ids
        got = ours.encode(text)
        assert np.frombuffer(got, "<u4").tolist() == ids, text
        assert ours.decode(got) == theirs.decode(ids, skip_special_tokens=False)


def test_long_words_merge_alike(ours):
    rng = random.Random(1)
    for _ in range(200):
        parts = [ours.inner[ord(c)] for c in rng.choices("abcdetinoh", k=rng.randrange(1, 60))] + [ours.last[ord("s")]]
        assert ours.merge_short(parts[:]) == ours.merge_long(parts[:])


def test_table(spark, theirs):
    rows = [(1, None, "x"), (1, "", "y"), (2, "Same", "z"), (2, "Same", "z"), (None, "no id", None), (3, "w " * 30000, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    spec = B.public_vocabulary()
    got = B.bpe_decode(B.bpe_encode(docs, spec), spec).collect()
    assert len(got) == 6
    for r in got:
        if not r.n_tokens:
            assert (r.doc_id, r.ids, r.decoded) == (1, b"", "")
    assert {r.n_tokens for r in got if r.doc_id == 3} == {30000}
    both = B.bpe_round_trip(docs, spec)
    assert sorted(both.collect(), key=str) == sorted(got, key=str)
    assert B.bpe_encode(docs.limit(0), spec).count() == B.bpe_round_trip(docs.limit(0), spec).count() == 0


def test_query(spark, theirs):
    sf = "/root/testdata/sf0.001"
    for r, d in zip(
        B.op2_bpe(spark, sf).orderBy("doc_id").collect(), spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    ):
        ids = theirs.encode(d.text, add_special_tokens=False).ids
        assert (r.doc_id, r.n_tokens) == (d.doc_id, len(ids))
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(theirs.decode(ids, skip_special_tokens=False).encode()).hexdigest()
