"""SimHash fingerprints and components against brute force."""

import re

import numpy as np
import pytest
import xxhash

from readloom.llm import simhash as S


def plain(text: str, k: int = 3) -> int:
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(items: dict) -> dict:
    """Smallest key reachable over values that differ in at most three bits."""
    keys, out = sorted(items), {}
    for k in keys:
        todo = [k] if k not in out else []
        while todo:
            a = todo.pop()
            if a in out:
                continue
            out[a] = k
            todo += [b for b in keys if b not in out and (items[a] ^ items[b]).bit_count() <= 3]
    return out


def test_fingerprint():
    for text in ["", "  \t\n", "One", "a b", "A b c d e f", "ÄÖ ß " * 50, "x " * 9, None, "\x1c \x1d a"]:
        assert S.simhash(text or "") == plain(text)


@pytest.mark.parametrize("limit", [2, 1024])
def test_components(spark, limit):
    rng = np.random.default_rng(3)
    fps = []
    for _ in range(40):
        at = int(rng.integers(0, 1 << 63)) * 2 + 1
        for _ in range(12):
            fps.append(at)
            for _ in range(int(rng.integers(0, 5))):
                at ^= 1 << int(rng.integers(0, 64))
    tight = [7 ^ (1 << a) ^ (1 << b) for a in range(12) for b in range(12)]
    values = sorted(set(fps + tight))
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    nodes = spark.createDataFrame([(signed(v),) for v in values], "fp long")
    edges = S.links(nodes, limit)
    assert edges.count() < 24 * 56 * len(values)
    from readloom.llm.common import connected_components

    got = {r.node: r.root for r in connected_components(edges).collect()}
    want = components({signed(v): v for v in values})
    assert {k: got.get(k, k) for k in want} == want


def test_table(spark):
    text = "the quick brown fox jumps over the lazy dog again and again"
    rows = [(5, text), (3, text.upper()), (3, text), (9, None), (8, ""), (None, text), (None, "only here"), (1, "zz top")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as fp", "2 as component_id")
    got = sorted(((r.doc_id, r.component_id) for r in S.simhash_components(docs).collect()), key=str)
    assert got == sorted([(5, 3), (3, 3), (3, 3), (9, 8), (8, 8), (None, 3), (None, None), (1, 1)], key=str)
    assert S.simhash_components(docs.limit(0)).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    want = components({i: plain(t) for i, t in texts.items()})
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in S.op5_simhash(spark, sf).collect()}
    assert got == {i: (f"{plain(t):016x}", want[i]) for i, t in texts.items()}


def test_one_per_group(spark):
    """The first document of each component stays, once, whatever the other columns are called."""
    found = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    want = sorted(set(components({i: plain(t) for i, t in found}).values()))
    rows = [(i, t, "x", None, 1) for i, t in found]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key_id string, KEY_TAG string, fp int").repartition(3)
    got = S.one_per_group(docs.union(docs))
    assert got.columns == docs.columns and sorted(r.doc_id for r in got.collect()) == want


def test_one_per_group_odd_rows(spark):
    text = "the quick brown fox jumps over the lazy dog again and again"
    rows = [(5, text), (3, text.upper()), (3, text), (3, text), (9, None), (9, ""), (8, ""), (None, text), (None, "only here"), (None, "only here"), (1, "zz top"), (1, "other words now")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.text and r.text.lower()) for r in S.one_per_group(docs).collect()), key=str)
    assert got == sorted([(3, text), (8, ""), (None, "only here"), (1, "zz top"), (1, "other words now")], key=str)
    assert S.one_per_group(docs.limit(0)).count() == 0
    many = docs.where("doc_id = 3").crossJoin(spark.range(40)).select("doc_id", "text")
    assert S.one_per_group(many).count() == 1
