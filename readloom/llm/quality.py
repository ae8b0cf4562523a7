"""Quality rules: statistics of texts and a decision list learned from labelled ones.

Statistics are Spark expressions over a text's words and lines; nothing leaves the JVM. Repeated eight-word
windows are found by their hashes: a text whose hashes all differ, as of most texts, is done after one hash set,
and only the others are sorted.

Learning. Sequential covering on the statistics of at most ``SAMPLE`` labelled documents: a rule grows by the
threshold that gains most about rejected documents, until it covers no other, on two thirds of what is not
yet covered; the last third prunes its end. Rules follow until one is not precise enough. Applying the
list is one Spark conditional expression, its rules in the order they were learned.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readloom.llm.common import documents, one_per_id, texts

SAMPLE, WINDOW = 10_000, 8
LEAST_WORDS, MOST_REPEATED = 20, 30
PRECISION, SUPPORT, CONDITIONS, RULES, CUTS = 0.85, 4, 4, 16, 64
BLANKS = " \t\n\x0b\x0c\r"
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
COUNTED = [*BASE, "n_lines", "n_upper", "n_marks"]
# Statistics that rules may use: numerator over denominator.
RATES = {
    "word_length": ("word_chars", "n_words"),
    "symbols": ("n_symbols", "word_chars"),
    "repeated": ("n_repeat_words", "n_words"),
    "dup_lines": ("n_dup_lines", "n_lines"),
    "line_words": ("n_words", "n_lines"),
    "upper": ("n_upper", "word_chars"),
    "marks": ("n_marks", "n_words"),
}


def _repeat_words(h: Column) -> Column:
    """Words in windows whose hash occurs twice or more, from the hashes of all windows."""
    pairs = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

    def twins(sorted_pairs: Column) -> Column:
        same = lambda a, b: F.coalesce(F.get(sorted_pairs, a)["h"] == F.get(sorted_pairs, b)["h"], F.lit(False))
        at = F.transform(sorted_pairs, lambda x, k: F.when(same(k - 1, k) | same(k, k + 1), x["i"]))
        return F.array_sort(F.filter(at, lambda i: i.isNotNull()))

    def more(acc: Column, i: Column) -> Column:
        return F.struct((i + WINDOW).alias("end"), (acc["n"] + i + WINDOW - F.greatest(acc["end"], i)).alias("n"))

    # Naming the sorted array once keeps it from being sorted for every element.
    positions = F.flatten(F.transform(F.array(pairs), twins))
    return F.aggregate(positions, F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")), more, lambda acc: acc["n"])


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and the counts of each text, one row per row; null and empty texts count nothing."""
    rows = texts(docs, id_col, text_col)
    inner = F.btrim("text", F.lit(BLANKS))
    rows = rows.select(
        "doc_id", "text",
        F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, r"[\x20\x09-\x0D]+")).alias("words"),
        F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    rows = rows.select(
        "doc_id",
        F.size("words").alias("n_words"),
        F.length(F.array_join("words", "")).alias("word_chars"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        F.size("lines").alias("n_lines"),
        F.regexp_count("text", F.lit(r"[A-Z]")).alias("n_upper"),
        F.regexp_count("text", F.lit(r"[!?.,;:]")).alias("n_marks"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
    )
    first = F.sequence(F.lit(0), F.col("n_words") - WINDOW)
    window = F.transform(first, lambda i: F.xxhash64(*(F.get("hashes", i + k) for k in range(WINDOW))))
    windows = F.when(F.col("n_words") >= WINDOW, window).otherwise(F.array().cast("array<bigint>"))
    rows = rows.select("*", windows.alias("windows")).drop("hashes")
    repeats = F.when(F.size(F.array_distinct("windows")) < F.size("windows"), _repeat_words(F.col("windows"))).otherwise(0)
    counts = [F.col(c).cast("long").alias(c) for c in COUNTED if c != "n_repeat_words"]
    row = F.struct("doc_id", *counts, repeats.cast("long").alias("n_repeat_words"))
    # A filter on the counts stays above the generator; below it, each use would hash all windows anew.
    return rows.select(F.inline(F.array(row)))


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def rates(row) -> list[float]:
    return [row[a] / row[b] if row[b] else 0.0 for a, b in RATES.values()]


def rate(name: str) -> Column:
    a, b = RATES[name]
    return F.when(F.col(b) != 0, F.col(a) / F.col(b)).otherwise(0.0)


def _holds(x: np.ndarray, rule: list[tuple]) -> np.ndarray:
    out = np.ones(len(x), bool)
    for k, above, cut in rule:
        out &= (x[:, k] >= cut) if above else (x[:, k] < cut)
    return out


def _grow(x: np.ndarray, bad: np.ndarray) -> list[tuple]:
    """Add the condition of the largest information gain until only rejected rows are covered."""
    rule: list[tuple] = []
    inside = np.ones(len(x), bool)
    while len(rule) < CONDITIONS and (~bad & inside).any():
        p0, n0 = (bad & inside).sum(), (~bad & inside).sum()
        best, best_gain = None, 1e-9
        for k in range(x.shape[1]):
            for cut in np.unique(np.quantile(x[inside, k], np.linspace(0, 1, CUTS), method="nearest")):
                for above in (True, False):
                    now = inside & ((x[:, k] >= cut) if above else (x[:, k] < cut))
                    p, n = (bad & now).sum(), (~bad & now).sum()
                    gain = p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))) if p else 0.0
                    if gain > best_gain:
                        best, best_gain = (k, above, float(cut)), gain
        if best is None:
            break
        rule.append(best)
        inside &= _holds(x, [best])
    return rule


def learn_list(x: np.ndarray, bad: np.ndarray) -> list[list[tuple]]:
    """Rules in order, each a list of (statistic, at least or below, threshold); all reject."""
    rules: list[list[tuple]] = []
    left = np.ones(len(x), bool)
    third = np.arange(len(x)) % 3 == 2
    while len(rules) < RULES and (bad & left & ~third).sum() >= SUPPORT:
        rule = _grow(x[left & ~third], bad[left & ~third])
        worth = lambda r: (lambda c: ((bad & c).sum() - (~bad & c).sum()) / max(1, c.sum()))(_holds(x, r) & left & third)
        if rule:
            rule = max((rule[:n] for n in range(len(rule), 0, -1)), key=worth)
        covered = _holds(x, rule) & left
        if not rule or (bad & covered).sum() < SUPPORT or (bad & covered).sum() < PRECISION * covered.sum():
            break
        rules.append(rule)
        left &= ~covered
    return rules


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> list[list[tuple]]:
    """The rules from at most ``sample`` labelled rows that pass the base.

    The lowest of several labels counts, and one of repeated rows of an id.
    """
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min(F.col("quality").cast("int")).alias("quality"))
    # Only as many ids as the sample has are broadcast.
    chosen = F.broadcast(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    rows = statistics(one_per_id(texts(docs, id_col, text_col).join(chosen, "doc_id", "left_semi")))
    rows = rows.join(chosen, "doc_id").where(~base_failed()).collect()
    rows.sort(key=lambda r: (r.doc_id, *r))
    x = np.array([rates(r) for r in rows], float).reshape(-1, len(RATES))
    return learn_list(x, np.array([r.quality == 0 for r in rows], bool))


def verdict(rules: list[list[tuple]]) -> Column:
    """The list as one conditional expression: the first rule that holds rejects, otherwise the row is kept."""
    names, out = list(RATES), None
    for rule in rules:
        holds = F.lit(True)
        for k, above, cut in rule:
            holds &= (rate(names[k]) >= cut) if above else (rate(names[k]) < cut)
        out = F.when(holds, False) if out is None else out.when(holds, False)
    return F.lit(True) if out is None else out.otherwise(True)


def judged(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, the base counts, ``base_failed`` and ``kept`` of every row; without labels the base alone decides."""
    rules = learn(docs, labels, sample, id_col, text_col)
    kept = ~base_failed() & verdict(rules)
    return statistics(docs, id_col, text_col).select("doc_id", *BASE, base_failed().alias("base_failed"), kept.alias("kept"))


def op9_quality(spark, sf_dir: str) -> DataFrame:
    return judged(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
