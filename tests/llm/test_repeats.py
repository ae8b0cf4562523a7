"""Repeated passages against counting every window."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from readloom.llm import repeats as R


def plain(texts: list[bytes], length: int) -> list[tuple]:
    times = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - length + 1):
            if times[t[i : i + length]] > 1:
                gone[i : i + length] = True
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((len(t), int(gone.sum()), runs, kept))
    return out


def some_texts(seed: int, letters: str) -> list[str]:
    rng = random.Random(seed)
    word = lambda n: "".join(rng.choices(letters, k=n))
    passages = [word(rng.randrange(10, 90)) for _ in range(6)]
    made = ["", "ab", word(19), word(20), "a" * 300, "ab" * 200, "abc" * 90 + "x" + "abc" * 90]
    for _ in range(40):
        parts = [word(rng.randrange(0, 60)) if rng.random() < 0.5 else rng.choice(passages) for _ in range(rng.randrange(1, 6))]
        made.append("".join(parts))
        if rng.random() < 0.3:
            at = rng.randrange(len(made[-1]) + 1)
            made.append(made[-1][:at] + "é" + made[-1][at:])
        if rng.random() < 0.2:
            made.append(made[-1])
    return made


@pytest.mark.parametrize("seed, letters, limit, block", [(1, "ab", 1 << 16, 50), (2, "abcdefgh", 1 << 16, 1 << 18), (3, "abcdefghijklmnop", 3, 64)])
def test_against_all_windows(spark, monkeypatch, seed, letters, limit, block):
    texts = some_texts(seed, letters)
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, digest string, copies int")
    monkeypatch.setattr(R, "BLOCK", block)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in R.without_repeats(docs, length=20, gram=8, limit=limit).collect()}
    want = dict(enumerate(plain([t.encode() for t in texts], 20)))
    assert got == want


def test_reaches_sees_all_partners():
    rng = random.Random(9)
    for _ in range(300):
        n = rng.randrange(2, 14)
        items = sorted({("".join(rng.choices("ab", k=rng.randrange(0, 7))).encode(), "".join(rng.choices("ab", k=rng.randrange(0, 7))).encode()) for _ in range(n)})
        got = R.reaches([r for r, _ in items], [x for _, x in items], 6)
        for i, (r, x) in enumerate(items):
            pairs = [(R.common(x, y), R.common(r, s)) for j, (s, y) in enumerate(items) if j != i]
            good = [p for p in pairs if sum(p) >= 6]
            assert got[i] == [max((p[0] for p in good), default=0), max((p[1] for p in good), default=0)]


def test_table(spark):
    text = "".join(random.Random(1).choices("abcdefghij klmnop", k=300))
    rows = [(1, text), (1, text), (None, "zz" + text[:250]), (2, None), (2, ""), (3, "y" * 100_000)]
    got = R.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.n_bytes, r.n_removed, r.n_spans) for r in got) == [
        (0, 252, 250, 1), (1, 300, 300, 1), (1, 300, 300, 1), (2, 0, 0, 0), (2, 0, 0, 0), (3, 100_000, 100_000, 1)
    ]
    assert R.without_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_names(spark):
    text = "".join(random.Random(2).choices("abcdefghij klmnop", k=300))
    docs = spark.createDataFrame([(1, text, "x", 1), (2, "zz" + text, "y", 2), (3, None, None, 3)], "doc_id long, text string, text_digest string, text_spans int")
    got = R.documents_without_repeats(docs)
    assert got.columns == docs.columns
    assert sorted(map(tuple, got.collect())) == [(1, "", "x", 1), (2, "zz", "y", 2), (3, None, None, 3)]


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = {r.doc_id: r.text.encode() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    want = {i: (n, gone, runs, hashlib.sha256(kept).hexdigest()) for i, (n, gone, runs, kept) in zip(rows, plain(list(rows.values()), 200))}
    assert {r.doc_id: tuple(r)[1:] for r in R.op10_repeats(spark, sf).collect()} == want
