"""Mixing: targets against a loop, sums near targets, fair rounding, odd rows."""

import random
import re
from collections import Counter, defaultdict

import pytest

from readloom.llm import mixing as M


def plain_targets(size: dict) -> dict:
    """Share by weight and reshare the excess until no source is above three times its size."""
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: 1 + k % 3 for k, s in enumerate(order)}
    total, full = sum(size.values()), {}
    while True:
        free = [s for s in order if s not in full]
        left = total - sum(full.values())
        share = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        above = [s for s in free if share[s] >= 3 * size[s]]
        if not above:
            return full | share
        full |= {s: 3 * size[s] for s in above}
        if len(full) == len(order):
            return full


def docs_of(spark, n, seed, sources):
    rng = random.Random(seed)
    rows = [(i, "w " * rng.choice([0, 1, 3, 20, 90]), rng.choice(sources)) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)


@pytest.mark.parametrize("seed", [1, 2])
def test_mix(spark, monkeypatch, seed):
    monkeypatch.setattr(M, "BUCKET", 40)
    monkeypatch.setattr(M, "FAN", 3)
    docs = docs_of(spark, 700, seed, ["a", "b", "B", None, "z"] + ["a"] * 4)
    got = M.mix(docs).collect()
    assert len(got) == 700 and sorted(r.doc_id for r in got) == list(range(700))
    size, taken = defaultdict(int), defaultdict(int)
    for r in got:
        size[r.source] += r.size
        taken[r.source] += r.copies * r.size
        assert 0 <= r.copies <= 3 and r.copies in (int(r.target / r.source_size), int(r.target / r.source_size) + 1)
    want = plain_targets(size)
    for r in got:
        assert r.source_size == size[r.source] and r.target == pytest.approx(want[r.source])
    assert all(abs(taken[s] - want[s]) <= 90 for s in size)
    again = {r.doc_id: r.copies for r in M.mix(docs.repartition(7)).collect()}
    assert again == {r.doc_id: r.copies for r in got}


def test_transfer_is_fair():
    rng, ups, n = random.Random(4), 0.0, 40000
    for _ in range(n):
        a, b = [10, 0.3], [4, 0.9]
        M.transfer(a, b, rng.random())
        assert a[1] * 10 + b[1] * 4 == pytest.approx(6.6) and (a[1] in (0, 1) or b[1] in (0, 1))
        ups += a[1]
    assert ups / n == pytest.approx(0.3, abs=0.01)


def test_table(spark):
    rows = [(1, None, "a", 7), (1, None, "a", 7), (2, "x y", None, 7), (None, "x", "a", 7), (2, "x y", None, 7), (3, "z " * 5000, "a", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, copies int").selectExpr("*", "1 as target", "2 as size")
    got = M.mix(docs).collect()
    assert sorted(r.size for r in got) == [0, 0, 1, 2, 2, 5000]
    kept = M.mixed_documents(docs)
    assert kept.columns == docs.columns and kept.count() == sum(r.copies for r in got)
    assert M.mix(docs.limit(0)).count() == 0 and M.mixed_documents(docs.limit(0)).count() == 0


def test_names_and_nulls(spark):
    """Columns of any name stay, a null differs from a value, and equal rows are taken as often as all of them."""
    rows = [(1, None, "a b c", 1), (1, "a b c", None, 2), (1, "a b c", None, 2), (2, "d e", "s", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, key_id int")
    docs = docs.selectExpr("*", "key_id as key_tag", "key_id as times_taken", "'x' as copy_no", "key_id as other_id", "key_id as tag", "key_id as no", "key_id as rows", "key_id as times")
    assert len({(r.tag, r.no) for r in M.sizes(docs).collect()}) == 4
    want = Counter()
    for r in M.mix(docs).collect():
        want[r.doc_id, r.source, r.size] += r.copies
    got = M.mixed_documents(docs)
    assert got.columns == docs.columns
    assert Counter((r.doc_id, r.source, len((r.text or "").split())) for r in got.collect()) == +want


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = M.op6_mixing(spark, sf).collect()
    size = {i: len(re.findall(M.WORD, r.text)) for i, r in rows.items()}
    sums, taken = defaultdict(int), defaultdict(int)
    for r in got:
        assert r.size == size[r.doc_id] and r.taken <= 3 * r.size
        sums[r.source] += r.size
        taken[r.source] += r.taken
    want = plain_targets(sums)
    assert len(got) == len(rows)
    for s in sums:
        assert abs(taken[s] - want[s]) <= max(size.values())
