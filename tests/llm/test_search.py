"""Ranked search against plain scoring of every document."""

import math
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from readloom.llm import search as S

SF = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def cut(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, items, size):
    counts = [(i, Counter(cut(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n_docs, n_terms = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = set()
    for item, text in items:
        scored = []
        for i, c in counts:
            m = 50 + 50 * sum(c.values()) * n_docs // n_terms
            asked = [t for t in set(cut(text)) if t in c]
            w = lambda t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
            score = sum(w(t) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in asked)
            if score > 0:
                scored.append((-score, i is None, i))
        scored.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out |= {(item, k + 1, i, -s) for k, (s, _, i) in enumerate(scored[:size])}
    return out


def rows_of(df):
    return {(r.item_id, r.rank, r.doc_id, r.score) for r in df.collect()}


def test_terms():
    text = "Aé-b_C9 ÄÖ\x00x\x7fy İ x'Y \t1.5"
    assert [t.decode() for part in S.terms(text.encode()) for t in part] == cut(text)
    long = ("word " * 5 + "x" * 77 + ".") * 40_000
    assert [t.decode() for part in S.terms(long.encode()) for t in part] == cut(long)


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = S.op11_search(spark, SF)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert rows_of(got) == plain(docs, items, S.BEST)


def test_sql(spark):
    db = duckdb.connect()
    for name in ("documents", "benchmark"):
        db.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    assert set(db.execute(S.ORACLE).fetchall()) == rows_of(S.op11_search(spark, SF))


def words(rng, n, top=60):
    return " ".join(f"w{int(k)}" for k in np.minimum(rng.zipf(1.3, n), top))


@pytest.mark.parametrize("shard,seeds,block", [(16, 3, 40), (50, 1, 1 << 20), (8192, 1000, 200)])
def test_settings(spark, shard, seeds, block):
    """Many shards, ties, floors from seeds and several blocks of items change no result."""
    rng = np.random.default_rng(4)
    docs = [(int(i), words(rng, int(rng.integers(1, 60)))) for i in rng.permutation(300)]
    docs += [(400 + i, "w3 w5 w7 same text") for i in range(60)] + [(500, None), (501, "... !"), (None, "w3 w5"), (7, "w3 w5"), (7, "w3 w5")]
    items = [(k, words(rng, 12)) for k in range(12)] + [(90, "w3 w5 w7 SAME"), (91, None), (92, "?"), (93, "nowhere"), (90, "w3 w5 w7 SAME"), (94, "w3 w5 w7 SAME")]
    table = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, rank int, item string").repartition(4)
    asked = spark.createDataFrame(items, "item_id long, text string")
    got = rows_of(S.ranked(table, asked, 10, shard=shard, seeds=seeds, block=block))
    assert got == plain(docs, set(items), 10)


def test_empty(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "b")], "item_id long, text string")
    assert S.ranked(docs.limit(0), items).count() == S.ranked(docs, items.limit(0)).count() == 0
    assert rows_of(S.ranked(docs, items)) == plain([(1, "a b")], [(1, "b")], 50)


def test_range_maxima():
    values = np.random.default_rng(0).integers(0, 99, 37)
    table = S.sparse_table(values)
    for a in range(37):
        for b in range(a + 1, 38):
            level = (b - a).bit_length() - 1
            assert max(table[level, a], table[level, b - (1 << level)]) == values[a:b].max()


def test_bounds_save_work():
    """A shard with one clear winner is searched through few intervals."""
    rng = np.random.default_rng(9)
    lists = [rng.choice(200, 40, replace=False).tolist() for _ in range(4000)]
    lists[1234] = list(range(12)) + lists[1234][:5]
    rows = [(i, 40, sorted(set(x)), [1] * len(set(x))) for i, x in enumerate(lists)]
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("tfs", pa.list_(pa.int64()))])
    shard = S.Shard([pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)], {t: 900 for t in range(200)}, 4000, 160000)
    best = S.Best(1)
    assert S.search(shard, list(range(12)), best, front=16) < 2500 and best.id.tolist() == [1234]
