"""The Jaccard join against comparing every pair."""

import re

import numpy as np
import pytest

from readloom.llm import common
from readloom.llm import jaccard as J

SF = "/root/testdata/sf0.001"


def plain_set(text, k=4):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} or ({tuple(words)} if words else set())


def plain(docs):
    """Rows (doc_id, n_shingles, component_id) of whole documents, by all pairs of distinct sets."""
    sets = [frozenset(plain_set(t)) for _, t in docs]
    kinds = list(dict.fromkeys(s for s in sets if s))
    top = list(range(len(kinds)))

    def root(k):
        while top[k] != k:
            k = top[k]
        return k

    for a in range(len(kinds)):
        for b in range(a):
            small, large = sorted((len(kinds[a]), len(kinds[b])))
            if 100 * small >= 85 * large and 100 * len(kinds[a] & kinds[b]) >= 85 * len(kinds[a] | kinds[b]):
                top[root(a)] = root(b)
    number = {s: root(k) for k, s in enumerate(kinds)}
    least = {}
    for (i, _), s in zip(docs, sets):
        if s and i is not None:
            least[number[s]] = min(i, least.get(number[s], i))
    return sorted(((i, len(s), least.get(number[s]) if s else i) for (i, _), s in zip(docs, sets)), key=str)


def rows_of(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


def test_shingles():
    for text in ["", " \t\n", "One", "a b c", "A b c D e a b c d", "ÄÖ ß ä " * 9, "x " * 30]:
        assert len(J.shingles(text.encode())) == len(plain_set(text))
    assert J.shingles(b"a B  c\td").tolist() == J.shingles(b"A b c d").tolist() != J.shingles(b"b a c d").tolist()


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = J.op12_jaccard(spark, sf)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert rows_of(got) == plain(docs)


def edited(rng, words, n):
    out = list(words)
    for at in rng.choice(len(out), n, replace=False):
        out[at] = f"e{rng.integers(1 << 30)}"
    return " ".join(out)


@pytest.mark.parametrize("limit, few", [(8, 0), (2048, 1 << 18)])
def test_near_the_limit(spark, monkeypatch, limit, few):
    """Chains and clusters just above and below the similarity, a hot cluster dealt to several tasks, short texts."""
    monkeypatch.setattr(J, "if_few", lambda table: common.if_few(table, few))
    rng = np.random.default_rng(11)
    docs = []
    for g in range(12):
        base = [f"w{rng.integers(300)}" for _ in range(int(rng.integers(60, 160)))]
        docs.append((g * 1000, " ".join(base)))
        docs += [(g * 1000 + k, edited(rng, base, int(rng.integers(1, 5)))) for k in range(1, 14)]
        for k in range(20, 26):
            base = edited(rng, base, 2).split()
            docs.append((g * 1000 + k, " ".join(base)))
        docs += [(g * 1000 + 40 + k, " ".join(base[: len(base) - 3 * k])) for k in range(6)]
    hot = [f"h{k}" for k in range(120)]
    docs += [(50_000 + k, edited(rng, hot, int(rng.integers(0, 4)))) for k in range(250)]
    docs += [(70_000 + k, "same words in every copy of this one") for k in range(40)]
    docs += [(80_000 + k, " ".join(rng.choice(["a", "b", "c"], int(rng.integers(1, 7))))) for k in range(60)]
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert rows_of(J.alike(table, limit=limit)) == plain(docs)


def test_many_copies(spark, monkeypatch):
    monkeypatch.setattr(common, "MANY", 5)
    docs = [(k, "one text that many documents have in common") for k in range(30)] + [(90, "another text that only this document has")]
    assert rows_of(J.alike(spark.createDataFrame(docs, "doc_id long, text string"))) == plain(docs)


def test_table(spark):
    docs = [(5, "a b c d e f"), (3, "A B c d e  f"), (3, "a b c d e f"), (9, None), (8, ""), (8, " \n"), (None, "a b c d e f"), (None, "only here now"), (None, None), (1, "zz top"), (2, "ZZ\ttop"), (4, "top zz")]
    table = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, n int, tag string")
    assert rows_of(J.alike(table)) == plain(docs)
    assert J.alike(table.limit(0)).count() == 0
    long = " ".join(f"w{k}" for k in range(60_000))
    two = [(1, long), (2, long + " tail end"), (3, long[: len(long) // 2])]
    assert rows_of(J.alike(spark.createDataFrame(two, "doc_id long, text string"))) == plain(two)


def test_prefixes_suffice():
    """Two linked sets share a token among those they ask with and are found by, whatever the order."""
    rng = np.random.default_rng(5)
    for _ in range(3000):
        a = int(rng.integers(1, 80))
        b = int(rng.integers(a, min(100, a * 20 // 17) + 1))
        both = -(-17 * (a + b) // 37)
        if both > a:
            continue
        order = rng.permutation(a + b - both)
        small, large = np.sort(order[:a]), np.sort(np.concatenate([order[:both], order[a:]]))
        assert set(small[: J.found_by(a)]) & set(large[: J.asking(b)])


def test_shared_tokens_suffice():
    """The prefixes of two linked sets share as many tokens as ``in_common`` says, whatever the order."""
    rng = np.random.default_rng(6)
    least = set()
    for _ in range(3000):
        m = int(rng.integers(1, 200))
        n = int(rng.integers(m, m * 20 // 17 + 1))
        both = int(rng.integers(-(-17 * (n + m) // 37), m + 1)) if -(-17 * (n + m) // 37) <= m else None
        if both is None:
            continue
        order = rng.permutation(n + m - both)
        if rng.random() < 0.5:  # tokens of one set alone come first: the worst order
            order = np.concatenate([order[order >= both], order[order < both]])
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            order = place
        small, large = np.sort(order[:m]), np.sort(np.concatenate([order[:both], order[m:]]))
        shared = len(set(small[: J.asking(m)]) & set(large[: J.asking(n)]))
        assert shared >= max(1, J.in_common(n, m))
        least.add(shared - J.in_common(n, m))
    assert 0 in least


@pytest.mark.parametrize("near", [2, 64])
def test_few_shared_tokens(spark, monkeypatch, near):
    """Sets that share a passage too short for a link are not sent to a group; those that are linked are, whatever ``NEAR``."""
    monkeypatch.setattr(J, "NEAR", near)
    # An order that tells nothing, as that of counters which very many tokens share.
    monkeypatch.setattr(J, "frequencies", lambda slices: np.zeros(1 << J.BITS, np.uint8))
    rng = np.random.default_rng(12)
    docs = []
    for g in range(60):
        passage = [f"p{g}_{k}" for k in range(9)]
        for k in range(4):
            words = [f"w{rng.integers(1 << 30)}" for _ in range(190 + k)]
            docs.append((g * 10 + k, " ".join(words[:90] + passage + words[90:])))
    base = [f"b{k}" for k in range(200)]
    docs += [(9000 + k, edited(rng, base, 3)) for k in range(12)]
    sizes, kept = {}, J.stored

    def counted(df, name):
        out = kept(df, name)
        sizes[name] = out.count()
        return out

    monkeypatch.setattr(J, "stored", counted)
    assert rows_of(J.alike(spark.createDataFrame(docs, "doc_id long, text string").repartition(4))) == plain(docs)
    assert sizes["units"] == len(docs) and 12 <= sizes["active"] and (near == 2 or sizes["active"] < 40)
