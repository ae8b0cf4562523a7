"""Toxicity by a counterfactual-regularised linear classifier.

Features are the distinct words of a text and the prefixes of these words, so that compounds and endings of
a stem share a weight. Weights minimise the logistic loss over labelled texts, a ridge term, and
the squared change of the score when identity terms are swapped within their group ("women" for "men").
A group's mention alone then moves no score, whatever labels its texts happen to have.

Groups come from a list of terms and from the labelled texts: two words that stand between the same neighbours, and
that toxic and other texts hold equally often, are swapped for each other. A text gets a counterfactual where the
swap changes its words.

Tasks turn labelled texts into hashed features, at most ``SAMPLE`` rows of them, the first by a hash of their id. Features
are chosen by the difference of their shares among toxic and other rows; tasks count them, and the driver fits on the
chosen ones and those of swapped terms alone, so that it holds no more of longer texts. All documents are scored in their
partitions without a shuffle; a text's length has no say but by its words.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.llm.common import documents, one_per_id, stored, texts

SAMPLE = 10_000
PREFIXES = (4, 5, 6, 7)
FEATURES, LEAST = 4_000, 3
RIDGE, FAIR, STEPS = 2.0, 1.0, 60
THRESHOLD = 0.3
# Derived groups: so many frequent words are looked at; words of a group differ by at most so many standard errors between
# the labels, stand in so many rows of either label, and have contexts of at least this cosine.
FREQUENT, EVEN, BOTH, ALIKE = 512, 1.0, 5, 0.5
TOKEN = re.compile(r"[^\W\d_]+")

# Identity terms; a term is swapped for the next of its line.
IDENTITY = """
women men
woman man
girls boys
muslims christians jews hindus buddhists atheists
muslim christian jewish hindu buddhist
islam christianity judaism hinduism buddhism
gay straight
lesbian heterosexual
homosexuals heterosexuals
transgender cisgender
blacks whites asians latinos
black white
african european asian american
mexicans germans chinese russians turks indians
immigrants refugees natives
disabled deaf blind
frauen männer
muslime christen juden
ausländer einheimische
schwule lesben
femmes hommes
musulmans chrétiens juifs
étrangers français
mujeres hombres
musulmanes cristianos judíos
extranjeros españoles
"""


def swaps(lines: str = IDENTITY) -> dict[str, str]:
    groups = [line.split() for line in lines.strip().splitlines()]
    return {term: group[(i + 1) % len(group)] for group in groups for i, term in enumerate(group)}


def derived_swaps(rows: DataFrame) -> dict[str, str]:
    """Pairs of words to swap, from ``toxic, text``: neutral ones, the likest by their neighbours first.

    Of the ``FREQUENT`` words that most rows hold, those that are neither in more than half of the rows nor in one label
    more than in the other are compared by the frequent words before and after them. Only counts of these words come to
    the driver.
    """
    words = rows.select("toxic", F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0)).alias("words"))
    n, n1 = rows.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    held = words.select("toxic", F.explode(F.array_distinct("words")).alias("word")).groupBy("word")
    top = held.agg(F.count("*").alias("n"), F.sum("toxic").alias("n1")).orderBy(F.desc("n"), "word").limit(FREQUENT).collect()

    def even(r) -> bool:
        c0, p = r.n - r.n1, r.n / n
        error = np.sqrt(p * (1 - p) * (1 / n1 + 1 / (n - n1))) if 0 < n1 < n else 0
        return r.n <= n / 2 and min(r.n1, c0) >= BOTH and abs(r.n1 / n1 - c0 / (n - n1)) <= EVEN * error

    neutral = [r.word for r in top if even(r)]
    if len(neutral) < 2:
        return {}
    spark = rows.sparkSession
    kept = F.broadcast(spark.createDataFrame([(w, i) for i, w in enumerate(neutral)], "word string, i int"))
    near = F.broadcast(spark.createDataFrame([(r.word, j) for j, r in enumerate(top)], "near string, j int"))
    around = lambda w, i: F.struct(w.alias("word"), F.array(F.get("words", i - 1), F.get("words", i + 1)).alias("both"))
    placed = words.select(F.explode(F.transform("words", around)).alias("at")).select("at.word", "at.both").join(kept, "word")
    sides = placed.select("i", F.posexplode("both").alias("side", "near")).join(near, "near")
    seen = np.zeros((len(neutral), 2 * len(top)))
    for r in sides.groupBy("i", "side", "j").agg(F.count("*").alias("n")).collect():
        seen[r.i, r.side * len(top) + r.j] = np.sqrt(r.n)
    seen /= np.maximum(np.linalg.norm(seen, axis=1, keepdims=True), 1e-12)
    alike = seen @ seen.T
    pairs: dict[str, str] = {}
    for at in np.argsort(-alike, axis=None, kind="stable"):
        a, b = divmod(int(at), len(neutral))
        if alike[a, b] < ALIKE:
            break
        if a < b and not {neutral[a], neutral[b]} & pairs.keys():
            pairs |= {neutral[a]: neutral[b], neutral[b]: neutral[a]}
    return pairs


def word_features(word: str) -> list[int]:
    parts = [f"={word}", *(word[:n] for n in PREFIXES if len(word) >= n)]
    return [xxhash.xxh64_intdigest(p) >> 1 for p in parts]


def features(words: set[str], known: dict[str, list[int]], of_word: Callable[[str], list[int]] = word_features) -> np.ndarray:
    found: set[int] = set()
    for w in words:
        if w not in known:
            if len(known) > 1 << 15:
                known.clear()
            known[w] = of_word(w)
        found.update(known[w])
    return np.fromiter(found, np.int64, len(found))


def chosen_features(rows: DataFrame) -> np.ndarray:
    """The features that ``choose`` takes, of ``toxic, text``: tasks count them, only the chosen ones come to the driver."""
    schema = pa.schema([("kind", pa.int64()), ("c", pa.int64()), ("c1", pa.int64())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, list[int]] = {}
        for part in parts:
            for at in range(0, part.num_rows, 256):
                some = part.slice(at, 256)
                own = [features(set(TOKEN.findall(t.as_py().lower())), known) for t in some["text"]]
                toxic = np.repeat(some["toxic"].to_numpy() == 1, [len(o) for o in own])
                kinds, of, c = np.unique(np.concatenate(own), return_inverse=True, return_counts=True)
                c1 = np.bincount(of[toxic], minlength=len(kinds))
                yield pa.record_batch([pa.array(x, pa.int64()) for x in (kinds, c, c1)], schema=schema)

    n, n1 = rows.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    n1, n0 = max(1, n1), max(1, n - n1)
    counts = rows.select("toxic", "text").mapInArrow(run, "kind long, c long, c1 long")
    counts = counts.groupBy("kind").agg(F.sum("c").alias("c"), F.sum("c1").alias("c1")).where(F.col("c") >= LEAST)
    c, c1, p = F.col("c"), F.col("c1"), F.col("c") / float(n1 + n0)
    z = F.abs(c1 / float(n1) - (c - c1) / float(n0)) / F.sqrt(F.greatest(p * (1 - p), F.lit(1e-12)) * F.lit(1 / n1 + 1 / n0))
    top = counts.select("kind", z.alias("z")).where("z > 0").orderBy(F.desc("z"), "kind").limit(FEATURES)
    return np.sort(np.array([r.kind for r in top.select("kind").collect()], np.int64))


def labelled_features(rows: DataFrame, terms: dict[str, str], kinds: np.ndarray) -> DataFrame:
    """``toxic, own, swapped``: the places in sorted ``kinds`` of the features of ``text`` and of its counterfactual, null if a swap changes no word of it."""
    schema = pa.schema([("toxic", pa.int32()), ("own", pa.list_(pa.int32())), ("swapped", pa.list_(pa.int32()))])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, list[int]] = {}
        place = {f: k for k, f in enumerate(kinds.tolist())}
        places = lambda words: features(words, known, lambda w: [place[f] for f in word_features(w) if f in place]).astype(np.int32)
        for part in parts:
            own, other = [], []
            for text in map(pa.StringScalar.as_py, part["text"]):
                words = set(TOKEN.findall(text.lower()))
                own.append(places(words))
                turned = {terms.get(w, w) for w in words}
                other.append(places(turned) if turned != words else None)
            columns = [part["toxic"], pa.array(own, pa.list_(pa.int32())), pa.array(other, pa.list_(pa.int32()))]
            yield pa.record_batch(columns, schema=schema)

    return rows.select("toxic", "text").mapInArrow(run, "toxic int, own array<int>, swapped array<int>")


def choose(own: list[np.ndarray], toxic: np.ndarray, most: int = FEATURES, least: int = LEAST) -> tuple[np.ndarray, np.ndarray]:
    """Sorted features whose shares differ most, in standard errors, of those in ``least`` rows or more; the errors."""
    flat = lambda wanted: np.concatenate([*(o for o, y in zip(own, toxic) if y == 1 or not wanted), np.empty(0, np.int64)])
    kinds, c = np.unique(flat(False), return_counts=True)
    of_toxic, times = np.unique(flat(True), return_counts=True)
    c1 = np.zeros(len(kinds))
    c1[np.searchsorted(kinds, of_toxic)] = times
    n1, n0 = max(1, toxic.sum()), max(1, len(toxic) - toxic.sum())
    p1, p0, p = c1 / n1, (c - c1) / n0, c / (n1 + n0)
    z = np.abs(p1 - p0) / np.sqrt(np.maximum(p * (1 - p), 1e-12) * (1 / n1 + 1 / n0))
    z[c < least] = -1
    top = np.argsort(-z, kind="stable")[:most]
    top = np.sort(top[z[top] > 0])
    return kinds[top], z[top]


def sparse(lists: list[np.ndarray], kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and column numbers of the chosen features."""
    # List by list: few features are chosen, and the others never stand in one array.
    columns = [np.flatnonzero(np.isin(kinds, x, assume_unique=True)) for x in lists]
    rows = np.repeat(np.arange(len(lists)), [len(c) for c in columns])
    return rows, np.concatenate([*columns, np.empty(0, np.int64)])


def fit(own: list, swapped: list, toxic: np.ndarray, ridge: float = RIDGE, fair: float = FAIR, steps: int = STEPS):
    """``kinds, weights, bias`` by Newton steps with conjugate gradients.

    The ridge of a feature falls with the square of its standard errors, so that few clear signs take the
    weight before many faint ones do.
    """
    own = [np.asarray(o, np.int64) for o in own]
    # Only what a swap takes and brings matters for the change of a score.
    swapped = [None if s is None else np.asarray(s, np.int64) for s in swapped]
    pairs = [(np.setdiff1d(o, s), np.setdiff1d(s, o)) for o, s in zip(own, swapped) if s is not None]
    kinds, z = choose(own, toxic)
    firm = ridge * (np.median(z) / z) ** 2 if len(z) else z
    if pairs:
        chosen, kinds = kinds, np.union1d(kinds, np.concatenate([f for pair in pairs for f in pair]))
        all_firm = np.full(len(kinds), firm.max() if len(firm) else ridge)
        all_firm[np.searchsorted(kinds, chosen)] = firm
        firm = all_firm
    n, k = len(own), len(kinds)
    row, col = sparse(own, kinds)
    gained, lost = sparse([s for _, s in pairs], kinds), sparse([o for o, _ in pairs], kinds)
    score = lambda w: np.bincount(row, weights=w[col], minlength=n) + w[k]
    back = lambda r: np.append(np.bincount(col, weights=r[row], minlength=k), r.sum())

    def gap(w):
        return np.bincount(gained[0], weights=w[gained[1]], minlength=len(pairs)) - np.bincount(lost[0], weights=w[lost[1]], minlength=len(pairs))

    def gap_back(r):
        change = np.bincount(gained[1], weights=r[gained[0]], minlength=k) - np.bincount(lost[1], weights=r[lost[0]], minlength=k)
        return np.append(change, 0.0)

    keep = np.append(firm, 1e-6)
    w = np.zeros(k + 1)
    rate = np.clip(toxic.mean() if n else 0.5, 1e-3, 1 - 1e-3)
    w[k] = np.log(rate / (1 - rate))

    def loss(w):
        s = score(w)
        return np.logaddexp(0, s).sum() - toxic @ s + (keep * w * w).sum() / 2 + fair * (gap(w) ** 2).sum() / 2

    now = loss(w)
    for _ in range(12):
        p = 1 / (1 + np.exp(-score(w)))
        grad = back(p - toxic) + keep * w + fair * gap_back(gap(w))
        curve = np.maximum(p * (1 - p), 1e-6)
        turn = lambda v: back(curve * score(v)) + keep * v + fair * gap_back(gap(v))
        step, r = np.zeros(k + 1), -grad
        d, rr = r.copy(), r @ r
        for _ in range(steps):
            if rr < 1e-8 * (grad @ grad) or rr == 0:
                break
            h = turn(d)
            a = rr / (d @ h)
            step, r = step + a * d, r - a * h
            rr, old = r @ r, rr
            d = r + rr / old * d
        size = 1.0
        while size > 1e-4 and loss(w + size * step) > now:
            size /= 2
        w = w + size * step
        new = loss(w)
        if now - new < 1e-5 * abs(now):
            break
        now = new
    return kinds, w[:k], float(w[k])


def held_out(doc_id):
    """The rows that no label is learned from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", terms: dict[str, str] | None = None):
    """Fit on at most ``sample`` labelled rows that are not held out.

    A document with several labels is toxic if one says so; of repeated rows of an id one counts.
    """
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).where(~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    # Only as many ids as the sample has are broadcast.
    chosen = F.broadcast(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    whole = one_per_id(texts(docs, id_col, text_col).join(chosen, "doc_id", "left_semi")).join(chosen, "doc_id")
    whole = stored(whole.select("toxic", "text"), "labelled")
    if terms is None:
        terms = derived_swaps(whole) | swaps()
    # What a swap takes and brings are features of its terms: with these, the fit is that on all features.
    swapped = [f for w in {*terms, *terms.values()} for f in word_features(w)]
    kinds = np.union1d(chosen_features(whole), np.array(swapped, np.int64))
    got = labelled_features(whole, terms, kinds).toArrow()
    return fit(list(_lists(got["own"], kinds)), list(_lists(got["swapped"], kinds)), got["toxic"].to_numpy().astype(float))


def _lists(column: pa.ChunkedArray, kinds: np.ndarray) -> Iterator[np.ndarray | None]:
    for chunk in column.chunks:
        valid, offsets, values = chunk.is_valid().to_pylist(), chunk.offsets.to_numpy(), chunk.values.to_numpy()
        yield from (kinds[values[a:b]] if ok else None for ok, a, b in zip(valid, offsets, offsets[1:]))


class Scorer:
    """Scores of texts; a task keeps the known features of up to 131,072 words."""

    def __init__(self, model):
        kinds, weights, self.bias = model
        self.weight = dict(zip(kinds.tolist(), weights.tolist()))
        self.known: dict[str, tuple[int, ...]] = {}

    def hits(self, word: str) -> tuple[int, ...]:
        found = self.known.get(word)
        if found is None:
            if len(self.known) >= 1 << 17:
                self.known.clear()
            found = self.known[word] = tuple(f for f in word_features(word) if f in self.weight)
        return found

    def __call__(self, texts: Iterable[str]) -> np.ndarray:
        raw = []
        for text in texts:
            found = set().union(*map(self.hits, set(TOKEN.findall(text.lower()))))
            raw.append(self.bias + sum(map(self.weight.__getitem__, sorted(found))))
        return 1 / (1 + np.exp(-np.clip(np.array(raw, float), -500, 500)))


def score(docs: DataFrame, model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score`` of every row; null and empty texts score by the bias alone."""
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for part in parts:
            found = scorer(t.as_py() for t in part["text"])
            yield pa.record_batch([part["doc_id"], pa.array(found)], schema=schema)

    return texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, score double")


def scored(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs``.

    Without labels of both kinds the score is the share of toxic rows, or one half without any label.
    """
    found = score(docs, learn(docs, labels, sample))
    predicted = F.when(F.col("score") >= THRESHOLD, 1).otherwise(0)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted.alias("predicted"))


def op3_toxicity(spark, sf_dir: str) -> DataFrame:
    return scored(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def without_toxic(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score below the threshold; their columns stay as they are."""
    model = learn(docs, labels, sample, id_col, text_col)
    schema = docs.schema

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for part in parts:
            found = scorer(t.as_py() or "" for t in part.column(part.schema.get_field_index(text_col)))
            yield part.filter(pa.array(found < THRESHOLD))

    return docs.mapInArrow(run, schema)
