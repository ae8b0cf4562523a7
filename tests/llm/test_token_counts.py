"""Token counts against the unigram model of the tokenizers library."""

import random

from tokenizers import Tokenizer, models, pre_tokenizers

from readloom.llm import token_counts as T


def theirs(vocab, unk):
    made = Tokenizer(models.Unigram(vocab, unk, False))
    made.pre_tokenizer = pre_tokenizers.Metaspace("▁", "always", True)
    return lambda text: len(made.encode(text, add_special_tokens=False).ids)


def test_ties_and_unknowns():
    rng = random.Random(4)
    for _ in range(120):
        pieces = sorted({"".join(rng.choices("ab▁c", k=rng.randrange(1, 5))) for _ in range(14)})
        vocab = [("<unk>", 0.0)] + [(p, -float(rng.randrange(1, 4))) for p in pieces]
        ours, other = T.Counter(vocab, 0), theirs(vocab, 0)
        for _ in range(40):
            text = "".join(rng.choices("abcxy\n ", k=rng.randrange(1, 14)))
            assert sum(map(ours, T.words(text))) == other(text), (vocab, text)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    count = theirs(*T.public_pieces())
    want = {r.doc_id: count(r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert {r.doc_id: r.n_tokens for r in T.op4_token_counts(spark, sf).collect()} == want


def test_table(spark):
    vocab = [("<unk>", 0.0), ("▁", -1.0), ("a", -1.0), ("▁a", -1.5)]
    rows = [(1, None, 5), (1, "", 5), (None, "a a", 5), (2, "a" * 50_000, 5), (2, "a" * 50_000, 5), (3, "é\né", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = sorted((r.doc_id or 0, r.n_tokens) for r in T.token_counts(docs, vocab).collect())
    assert got == [(0, 2), (1, 0), (1, 0), (2, 50_000), (2, 50_000), (3, 2)]
    assert T.token_counts(docs.limit(0), vocab).count() == 0
