"""The pipeline's stages against plain versions of what they do."""

from collections import Counter

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as C
from tests.llm.test_repeats import plain as cut_plain
from tests.llm.test_simhash import components
from tests.llm.test_simhash import plain as simhash_plain

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def near_groups(found):
    """Smallest id reachable over fingerprints that differ in at most three bits."""
    return components({i: simhash_plain(t) for i, t in found.items()})


def test_near_duplicates(spark, docs):
    got = C.drop_near_duplicates(spark, docs, SF)
    assert got.columns == docs.columns
    groups = near_groups(texts(docs))
    assert sorted(r.doc_id for r in got.collect()) == sorted(set(groups.values()))
    twice = C.drop_near_duplicates(spark, docs.union(docs), SF)
    assert sorted(r.doc_id for r in twice.collect()) == sorted(set(groups.values()))


def test_repeats(spark, docs):
    before = texts(docs)
    got = C.cut_repeats(spark, docs, SF)
    assert got.columns == docs.columns and got.schema == docs.schema
    want = {i: kept.decode("utf-8", "ignore") for i, (*_, kept) in zip(before, cut_plain([t.encode() for t in before.values()], 200))}
    assert texts(got) == want
    assert all(r.n_chars == len(r.text) for r in got.collect())


def test_odd_rows(spark, docs):
    odd = spark.createDataFrame([(None, None, None, None, None), (1, None, "en", "s", 0), (1, None, "en", "s", 0), (2, "", None, None, 0)], docs.schema)
    for _, stage in C.STAGES:
        assert stage(spark, odd, SF).count() <= 12
        assert stage(spark, odd.limit(0), SF).count() == 0
    assert C.cut_repeats(spark, odd, SF).count() == 4
    assert C.drop_near_duplicates(spark, odd, SF).count() == 1


def test_whole_run(spark, docs):
    made = C.run(spark, SF).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    kept = C.drop_near_duplicates(spark, C.drop_toxic(spark, docs, SF), SF)
    final = texts(C.cut_repeats(spark, kept, SF))
    assert {r.doc_id for r in made} <= set(final) and max(Counter(r.doc_id for r in made).values()) <= 3
    for r in made:
        ids = tokenizer.encode(final[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.decoded == tokenizer.decode(ids, skip_special_tokens=False)
