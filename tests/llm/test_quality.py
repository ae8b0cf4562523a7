"""Text statistics against plain Python, and the learned decision list."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from readloom.llm import quality as Q


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    times, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if times[w] > 1:
            covered.update(range(i, i + 8))
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def odd_texts():
    rng = random.Random(7)
    made = [None, "", " \t\n\x0b\x0c\r", "a", "\x1c a\xa0b \x85", "é#*$ <>\n\né#*$ <>\n", "a b c d e f g h " * 3, "a " * 500, "x\n" * 40, "w" * 5000]
    for _ in range(60):
        words = rng.choices("abc", k=rng.randrange(5, 80)) if rng.random() < 0.5 else [str(rng.randrange(50)) for _ in range(90)]
        made.append("".join(w + rng.choice([" ", "  ", "\n", "\t"]) for w in words))
    return made


def test_statistics(spark):
    made = odd_texts()
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(made)], "doc_id long, text string, words int, lines string")
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in Q.statistics(docs).collect()}
    assert got == {i: plain(t) for i, t in enumerate(made)}


def test_learn_list():
    rng = np.random.default_rng(1)
    x = rng.random((3000, 4))
    bad = (x[:, 1] > 0.8) & (x[:, 2] < 0.5) | (x[:, 0] > 0.95)
    rules = Q.learn_list(x, bad)
    said = np.any([Q._holds(x, r) for r in rules], axis=0)
    assert (said == bad).mean() > 0.97 and 2 <= len(rules) <= 8
    assert Q.learn_list(x, np.zeros(3000, bool)) == [] and Q.learn_list(x[:0], bad[:0]) == []


def test_verdict_follows_the_list(spark):
    rows = [(n, c, s, 0, 0, 1, 0, 0) for n in (1, 10, 0) for c in (5, 50) for s in (0, 4)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} long" for c in ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks"]))
    rules = [[(1, True, 0.5)], [(0, False, 1.0), (0, True, 0.5)]]
    for r in df.withColumn("kept", Q.verdict(rules)).collect():
        x = np.array([Q.rates(r)])
        assert r.kept == (not any(Q._holds(x, rule)[0] for rule in rules))


def test_table(spark):
    words = " ".join(f"w{i}" for i in range(40))
    rows = [(1, words, 9), (1, words, 9), (2, None, 9), (None, words, 9), (3, words + " one" * 30000, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    labels = spark.createDataFrame([(1, 1), (1, None), (None, 0), (77, 0)], "doc_id long, quality int")
    got = Q.judged(docs, labels).collect()
    assert sorted((r.doc_id or 0, r.base_failed, r.kept) for r in got) == [(0, False, True), (1, False, True), (1, False, True), (2, True, False), (3, True, False)]
    assert Q.judged(docs.limit(0), labels.limit(0)).count() == 0
    plan = Q.judged(docs, labels)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)


@pytest.mark.parametrize("sf, right", [("sf0.001", 0.8), ("sf0.1", 0.95)])
def test_query(spark, sf, right):
    sf = f"/root/testdata/{sf}"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = Q.op9_quality(spark, sf).collect()
    assert len(got) == len(docs)
    for r in got if len(got) < 1000 else []:
        assert tuple(r)[:6] == (r.doc_id, *plain(docs[r.doc_id]))
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
    assert not any(r.kept and r.base_failed for r in got)
    judged = [r for r in got if r.doc_id in quality and not r.base_failed]
    assert sum(r.kept == quality[r.doc_id] for r in judged) / len(judged) > right
    clean = [r.kept for r in judged if quality[r.doc_id] == 1]
    assert np.mean(clean) > 0.97


def test_sample_bounds_rows(spark, monkeypatch):
    """Thousands of rows of one labelled id are one row of the fit."""
    text = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame([(0, f"{text} {i % 7}") for i in range(8000)] + [(1, text), (None, text)], "doc_id long, text string")
    labels = spark.createDataFrame([(0, 0), (0, 2), (1, 1), (2, 1), (None, 1)], "doc_id long, quality int")
    monkeypatch.setattr(Q, "learn_list", lambda x, bad: bad.tolist())
    assert Q.learn(docs, labels) == [True, False]
    assert len(Q.learn(docs, labels, sample=1)) <= 1
