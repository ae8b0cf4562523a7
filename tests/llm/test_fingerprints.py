"""Merkle fingerprints: equality, edits, neighbours and the query against plain Python."""

import hashlib
import random
import re
from collections import Counter

import xxhash
from pyspark.sql import functions as F

from readloom.llm import fingerprints as P


def trees(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    return {r.i: r for r in df.select("i", P.tree(F.col("text")).alias("t"), P.fingerprint(F.col("text")).alias("f")).collect()}


def phrases_of(text):
    """Digits of each phrase, by a plain loop over the words."""
    out = []
    for line in text.split("\n"):
        phrase = ""
        for word in re.findall(r"[^ \t-\r]+[ \t-\r]*", line):
            phrase += word
            # Spark's hash is signed.
            signed = (xxhash.xxh64_intdigest(word, seed=42) + (1 << 63)) % (1 << 64) - (1 << 63)
            if signed % P.PHRASE == 0:
                out.append(phrase)
                phrase = ""
        out += [phrase] if phrase else []
    return Counter(xxhash.xxh64_hexdigest(p, seed=42)[8:] for p in out)


def dice(a, b):
    one, two = phrases_of(a), phrases_of(b)
    return 1.0 if a == b else 2 * (one & two).total() / max(1, one.total() + two.total())


def test_equal_texts_alone_have_equal_roots(spark):
    rng = random.Random(3)
    texts = ["", " ", "\n", "\n\n", "a", " a", "a ", "a\n", "a\nb", "a b", "b\na"]
    texts += ["\n".join(" ".join(rng.choices("abcd", k=5)) for _ in range(rng.randrange(1, 60))) for _ in range(40)]
    got = trees(spark, texts)
    assert len({r.t.root for r in got.values()}) == len(set(texts)) == len({r.f for r in got.values()})
    for i, text in enumerate(texts):
        hashes = [h for s in got[i].t.sections for h in s.split(",")]
        assert hashes == [hashlib.sha256(line.encode()).hexdigest() for line in text.split("\n")]
        sections = "".join(hashlib.sha256(s.encode()).hexdigest() for s in got[i].t.sections)
        assert got[i].t.root == hashlib.sha256(sections.encode()).hexdigest()
        assert Counter(re.findall("[0-9a-f]{8}", got[i].f[65:])) == phrases_of(text)


def test_edits_are_located(spark):
    lines = [f"line {i} of the text" for i in range(200)]
    edited = lines[:50] + ["new"] + lines[50:120] + ["changed"] + lines[121:]
    df = spark.createDataFrame([("\n".join(lines), "\n".join(edited))], "a string, b string")
    df = df.select(P.tree(F.col("a")).alias("a"), P.tree(F.col("b")).alias("b"))
    row = df.select(P.edited_paragraphs(F.col("a"), F.col("b")).alias("ab"), P.edited_paragraphs(F.col("a"), F.col("a")).alias("aa")).first()
    assert row.ab == [50, 121] and row.aa == []
    shared = df.select(F.size(F.array_intersect("a.sections", "b.sections")).alias("n"), F.size("a.sections").alias("all")).first()
    assert shared.n >= shared.all - 4


def likenesses(spark, pairs):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    rows = df.select("i", P.likeness(P.fingerprint(F.col("a")), P.fingerprint(F.col("b"))).alias("v")).collect()
    return [r.v for r in sorted(rows)]


def test_likeness_of_edits(spark):
    words = [f"w{i}" for i in range(600)]
    line, lines = " ".join(words), "\n".join(" ".join(words[i : i + 12]) for i in range(0, 600, 12))
    other = " ".join(f"x{i}" for i in range(600))
    pairs = [
        (line, line), (line, " ".join(words[:300] + [f"x{i}" for i in range(300)])), (line, other), ("", ""), ("", line), ("", " "),
        (line, "new " + line), (line, " ".join(words[:300] + ["new"] + words[300:])), (lines, "\n".join(lines.split("\n")[::-1])),
        (line, line + "\n" + line), (lines, lines + "\nnew line"), (lines, lines.replace("w300 ", "")),
    ]
    got = likenesses(spark, pairs)
    assert got[0] == got[3] == 1 and got[2] == got[4] == got[5] == 0
    assert 0.4 < got[1] < 0.6 and min(got[6], got[7], got[10], got[11]) > 0.95
    assert got[8] > 0.99 and abs(got[9] - 2 / 3) < 0.02


def test_likeness_is_that_of_all_phrases(spark):
    """What the walk down the trees counts, with repeated sections, paragraphs and phrases, is what a plain count finds."""
    rng = random.Random(7)
    lines = ["", " ", "a", "a b c", "a b c", *(" ".join(rng.choices("abcdefghijklmnop", k=rng.randrange(1, 30))) for _ in range(12))]
    texts = ["\n".join(rng.choices(lines, k=rng.randrange(0, 60))) for _ in range(60)] + ["a " * 5000, "a " * 5001 + "b", "a b c d " * 3000]
    pairs = [(rng.choice(texts), rng.choice(texts)) for _ in range(150)] + list(zip(texts[-3:], texts[-2:])) + [(texts[-2], texts[-1])]
    for (a, b), got in zip(pairs, likenesses(spark, pairs)):
        assert abs(got - dice(a, b)) < 1e-12


def test_next(spark):
    rng = random.Random(1)
    ids = rng.sample(range(-(10**12), 10**15), 150) + [5] * 4 + [None] * 3
    rows = [(i, rng.choice(["same", None, f"t{k}"]), k, "x") for k, i in enumerate(ids)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, range int, key string").repartition(5)
    order = sorted(((i, t or "") for i, t, *_ in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]), reverse=True)
    want = [(i, t, order[(k + 1) % len(order)][1]) for k, (i, t) in enumerate(order)]
    assert sorted(map(tuple, P.with_next(docs).collect()), key=str) == sorted(want, key=str)
    assert P.with_next(docs.limit(0)).count() == 0
    assert P.with_next(docs.where("doc_id = 5").limit(1)).count() == 1


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = sorted(((r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()), reverse=True)
    got = P.op1_fingerprints(spark, sf)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|SinglePartition", plan)
    by = {r.doc_id: r for r in got.collect()}
    assert len(by) == len(rows)
    for k, (i, text) in enumerate(rows):
        half, after = len(text) // 2, rows[(k + 1) % len(rows)][1]
        edited = text[: len(text) - half] + after[:half]
        assert by[i].n_chars == len(text) and by[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert abs(by[i].near_edited - dice(text, edited)) < 1e-12 and abs(by[i].near_next - dice(text, after)) < 1e-12
    prints = [r.fingerprint for r in by.values()]
    assert len(set(prints)) == len({t for _, t in rows})
