"""The toxicity classifier: held-out accuracy, the counterfactual penalty, odd rows."""

import random
import zlib

import numpy as np

from readloom.llm import toxicity as T

TERMS = {"women": "men", "men": "women"}


def feats(text):
    return np.sort(T.features(set(T.TOKEN.findall(text.lower())), {}))


def rows_of(n, seed=1):
    """Texts in which one group is mentioned mostly in toxic rows."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        toxic = i % 3 == 0
        words = [f"w{chr(97 + rng.randrange(26))}{chr(97 + rng.randrange(26))}" for _ in range(20)]
        if toxic:
            words += rng.choices(["awful", "nasty", "vile"], k=2)
        if rng.random() < (0.7 if toxic else 0.05):
            words.append("women")
        elif rng.random() < 0.3:
            words.append("men")
        rng.shuffle(words)
        out.append((i, " ".join(words), int(toxic)))
    return out


def test_counterfactual_penalty():
    rows = rows_of(900)
    own = [feats(t) for _, t, _ in rows]
    swapped = [feats(" ".join(TERMS.get(w, w) for w in t.split())) if {"men", "women"} & set(t.split()) else None for _, t, _ in rows]
    toxic = np.array([y for *_, y in rows], float)

    def gap(fair):
        kinds, w, b = T.fit(own, swapped, toxic, fair=fair)
        at = dict(zip(kinds.tolist(), w))
        return abs(sum(at.get(f, 0) for f in feats("women").tolist()) - sum(at.get(f, 0) for f in feats("men").tolist()))

    assert gap(10.0) < 0.3 * gap(0.0) and gap(0.0) > 0.5


def test_fit_is_the_minimum():
    rows = rows_of(300, 2)
    own = [feats(t) for _, t, _ in rows]
    toxic = np.array([y for *_, y in rows], float)
    kinds, w, b = T.fit(own, [None] * len(own), toxic)
    row, col = T.sparse(own, kinds)
    p = 1 / (1 + np.exp(-(np.bincount(row, weights=w[col], minlength=len(own)) + b)))
    assert abs((p - toxic).sum()) < 0.05
    assert ((p >= T.THRESHOLD) == toxic).mean() > 0.98


def test_table(spark):
    rows = [(i, t, "x", 3) for i, t, _ in rows_of(200)] + [(500, None, "x", 1), (500, "", "x", 1), (None, "awful nasty", None, 1), (501, "vile " * 20000, "", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string, toxic int")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows_of(200)] + [(None, 1), (7, None), (9999, 1)], "doc_id long, toxic int")
    got = T.scored(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got if r.doc_id is not None)
    by = {r.doc_id: r for r in got}
    assert by[501].predicted == by[None].predicted == 1 and by[500].predicted == 0
    right = [by[i].predicted == y for i, _, y in rows_of(200) if by[i].held_out]
    assert np.mean(right) > 0.9
    assert T.scored(docs.limit(0), labels).count() == 0
    assert {r.score for r in T.scored(docs, labels.limit(0)).collect()} == {0.5}
    kept = T.without_toxic(docs.drop("toxic"), labels)
    assert kept.columns == ["doc_id", "text", "score"] and 0 < kept.count() < len(rows)


def test_query(spark):
    sf = "/root/testdata/sf0.1"
    got = T.op3_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").toPandas()
    hit, said = ((got.predicted == 1) & (got.toxic == 1)).sum(), (got.predicted == 1).sum()
    assert hit / (got.toxic == 1).sum() > 0.88 and hit / said > 0.93


def test_sample_bounds_rows(spark, monkeypatch):
    """Thousands of rows of one labelled id are one row of the fit."""
    docs = spark.createDataFrame([(0, f"text {i % 7}") for i in range(8000)] + [(1, None), (3, "c"), (None, "d")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(12)] + [(0, 0)] * 3, "doc_id long, toxic int")
    monkeypatch.setattr(T, "fit", lambda own, swapped, toxic: (len(own), len(swapped), toxic.tolist()))
    kept = len([i for i in (0, 1, 3) if zlib.crc32(str(i).encode()) % 4 != 2])
    assert T.learn(docs, labels) == (kept, kept, [1.0] * kept)
    rows = T.learn(docs, labels, sample=2)[0]
    assert rows <= 2


def test_derived_swaps(spark):
    """Two words of the same contexts and of both labels are swapped; toxic words, and words of other contexts, are not."""
    rows = []
    for i in range(400):
        insult = ["you awful", "you nasty"][i // 4 % 2] if i % 4 == 0 else "my friend"
        rows.append((int(i % 4 == 0), f"the {['red', 'blue'][i // 4 % 2]} house stands here {insult}"))
    frame = spark.createDataFrame([*rows, (0, ""), (1, None)], "toxic int, text string")
    got = T.derived_swaps(frame)
    assert got["red"] == "blue" and got["blue"] == "red" and not {"awful", "nasty"} & {*got, *got.values()}
    assert T.derived_swaps(frame.limit(0)) == T.derived_swaps(frame.where("toxic = 1")) == {}


def test_counterfactuals_of_the_given_tables(spark, monkeypatch):
    """Swapped texts exist in the given tables, their scores come closer by the penalty, held-out accuracy stays."""
    sf, taken = "/root/testdata/sf0.01", []
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    fit = T.fit
    monkeypatch.setattr(T, "fit", lambda *a: taken.append(a) or fit(*a))
    T.learn(docs, labels)
    own, swapped, toxic = taken[0]
    pairs = [(o.tolist(), s.tolist()) for o, s in zip(own, swapped) if s is not None]
    assert len(pairs) > 20

    def gap(fair):
        kinds, w, _ = fit(own, swapped, toxic, fair=fair)
        at = dict(zip(kinds.tolist(), w))
        return np.mean([(sum(at.get(f, 0) for f in s) - sum(at.get(f, 0) for f in o)) ** 2 for o, s in pairs])

    assert gap(T.FAIR) < 0.5 * gap(0.0)


def test_fit_gets_what_it_uses(spark, monkeypatch):
    """The driver gets the chosen features and those of swapped terms alone, and fits on them what all features give."""
    rows = rows_of(600, 3)
    long = [" ".join(f"{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + k % 26)}{chr(97 + k // 26)}q" for k in range(300)) for i in range(600)]
    docs = spark.createDataFrame([(i, f"{t} {more}") for (i, t, _), more in zip(rows, long)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    taken, fit = [], T.fit
    monkeypatch.setattr(T, "FEATURES", 40)
    monkeypatch.setattr(T.choose, "__defaults__", (40, T.LEAST))
    monkeypatch.setattr(T, "fit", lambda *a: taken.append(a) or fit(*a))
    kinds, weights, bias = T.learn(docs, labels, terms=TERMS)
    own, swapped, _ = taken[0]
    assert len(np.unique(np.concatenate(own))) <= 40 + 2 * (1 + len(T.PREFIXES))
    kept = [i for i, *_ in rows if zlib.crc32(str(i).encode()) % 4 != 2]
    words = [set(T.TOKEN.findall(f"{rows[i][1]} {long[i]}".lower())) for i in kept]
    turned = [{TERMS.get(w, w) for w in s} for s in words]
    everything = [T.features(s, {}) for s in words], [T.features(t, {}) if t != s else None for s, t in zip(words, turned)]
    assert sum(map(len, own)) < sum(map(len, everything[0])) / 4 and sum(s is not None for s in swapped) > 50
    plain = fit(*everything, np.array([rows[i][2] for i in kept], float))
    assert kinds.tolist() == plain[0].tolist() and np.allclose(weights, plain[1]) and np.isclose(bias, plain[2])
