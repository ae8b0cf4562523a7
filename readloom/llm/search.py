"""Ranked lexical search: best-first document intervals, bounded by range-maximum tables of the posting lists.

Index. Texts are cut into terms once; of the terms that the items ask for, each document keeps a row of numbers and
counts. Document frequencies and lengths are added up over all rows. The items come in blocks of bounded
size, each with its own vocabulary, so that what travels with a job does not grow with them.

Search. A task holds ``SHARD`` documents at a time, in the order of their ids. The posting lists of an item's terms lie
end to end, with a sparse table above them: the maximum of any run of a list is that of two entries. The score of
a document in an interval is at most the sum of the terms' maxima there. Intervals are opened by falling bound,
``FRONT`` at once: each is split at the document of its largest single contribution, which is scored, and both sides are
bounded anew; one of at most ``LEAF`` documents is scored whole. What can't beat the last of the best is dropped.

The last of the best of one document in ``SEEDS`` is found first. All shards start from it, which loses nothing, as the
final list can only be better, and so a task sends few rows, however many tasks there are.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from readloom.llm.common import documents, stored

BEST = 50
ITEM_BYTES, PIECE = 4 << 20, 1 << 20
BITS = 13
SHARD, FRONT, LEAF, SEEDS = 1 << BITS, 256, 32, 64
LAST_ID = (1 << 63) - 1
# Equal contributions are told apart by scattered numbers, lest an interval be cut off document by document.
SCATTER = 0x9E3779B1 % SHARD
GATHER = pow(SCATTER, -1, SHARD)
# Letters, digits and all beyond ASCII stay, A-Z become a-z, the rest are blanks.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or chr(b).isalnum() else 32 for b in range(256))

_TERM = r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ORACLE = rf"""
WITH words AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, {_TERM}) AS ws FROM documents),
docs AS (SELECT r, doc_id, ws, len(ws) AS n FROM words WHERE len(ws) > 0),
totals AS (SELECT count(*) AS all_docs, sum(n)::BIGINT AS all_terms FROM docs),
lengths AS (SELECT r, doc_id, 100 - 50 + (50 * n * all_docs) // all_terms AS m FROM docs, totals),
asked AS (SELECT DISTINCT item_id, unnest(regexp_extract_all({_LOWER}, {_TERM})) AS term FROM benchmark),
counts AS (
    SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(ws) AS term FROM docs)
    WHERE term IN (SELECT term FROM asked) GROUP BY r, term
),
weights AS (
    SELECT term, floor(1000 * ln((2 * all_docs + 2) / (2 * df + 1)))::BIGINT AS w
    FROM (SELECT term, count(*) AS df FROM counts GROUP BY term), totals
),
scores AS (
    SELECT item_id, doc_id, r, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
    FROM counts JOIN weights USING (term) JOIN lengths USING (r) JOIN asked USING (term) GROUP BY item_id, doc_id, r
),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id, r)::INTEGER AS rank FROM scores WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= {BEST}
"""


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, in lists of about ``PIECE`` bytes."""
    plain = text.translate(LETTERS)
    start = 0
    while start < len(plain):
        end = plain.find(b" ", start + PIECE)
        end = len(plain) if end < 0 else end
        yield plain[start:end].split()
        start = end


def weight(df: int, n_docs: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def postings(docs: DataFrame, known: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """``doc_id, n, terms, tfs`` of each text with a term: how many it has, and numbers and counts of the ``known`` ones."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("tfs", pa.list_(pa.int64()))])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for at in range(0, part.num_rows, 1024):
                rows = []
                for doc_id, text in zip(*(part.column(c).slice(at, 1024) for c in (0, 1))):
                    n, found = 0, Counter()
                    for words in terms(text.as_py()):
                        n += len(words)
                        found.update(map(known.get, words))
                    if n:
                        found.pop(None, None)
                        rows.append((doc_id.as_py(), n, list(found), list(found.values())))
                if rows:
                    yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    whole = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    return whole.where("text is not null").mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<long>")


class Shard:
    """Posting lists of some documents, which are numbered in the order of their ids."""

    def __init__(self, rows: list[pa.RecordBatch], weights: dict[int, int], n_docs: int, n_terms: int):
        got = pa.Table.from_batches(rows).combine_chunks()
        ids = got["doc_id"].combine_chunks()
        order_by = np.array([LAST_ID if i is None else i for i in ids.to_pylist()], np.int64)
        order = np.argsort(order_by, kind="stable")
        self.ids, self.unknown = order_by[order], ids.is_null().to_numpy(zero_copy_only=False)[order]
        number = np.empty(len(order), np.int64)
        number[order] = np.arange(len(order))
        m = np.array([50 + 50 * n * n_docs // n_terms for n in got["n"].to_pylist()], np.int64)
        lists = got["terms"].combine_chunks()
        of = np.repeat(np.arange(len(order)), np.diff(lists.offsets.to_numpy()))
        term, tf = lists.flatten().to_numpy(), got["tfs"].combine_chunks().flatten().to_numpy()
        impact = 1_000_000_000 * tf // (1000 * tf + 20 * m[of])
        by = np.lexsort((number[of], term))
        self.doc, impact, term = number[of][by], impact[by], term[by]
        self.starts = dict(zip(*(x.tolist() for x in np.unique(term, return_index=True))))
        self.ends = dict(zip(self.starts, [*list(self.starts.values())[1:], len(term)]))
        w = np.zeros(max(weights, default=0) + 1, np.int64)
        w[list(weights)] = list(weights.values())
        self.gain = w[term] * impact if len(term) else impact


class Best:
    """The best documents of an item so far; ``floor`` is a score and id that the last of the best reaches at least."""

    def __init__(self, size: int, floor: tuple[int, int] | None = None):
        self.size, self.floor = size, floor or (1, LAST_ID)
        self.score, self.id, self.unknown = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)

    def open(self, bound: np.ndarray, first_id: np.ndarray) -> np.ndarray:
        """Which bounds, of documents of ``first_id`` or later, can still matter."""
        score, last = self.floor
        return (bound > score) | ((bound == score) & (first_id <= last))

    def offer(self, score: np.ndarray, ids: np.ndarray, unknown: np.ndarray) -> None:
        good = self.open(score, ids)
        if not good.any():
            return
        self.score = np.concatenate([self.score, score[good]])
        self.id, self.unknown = np.concatenate([self.id, ids[good]]), np.concatenate([self.unknown, unknown[good]])
        order = np.lexsort((self.id, -self.score))[: self.size]
        self.score, self.id, self.unknown = self.score[order], self.id[order], self.unknown[order]
        if len(order) == self.size:
            self.floor = max(self.floor, (int(self.score[-1]), int(self.id[-1])), key=lambda f: (f[0], -f[1]))


def sparse_table(values: np.ndarray) -> np.ndarray:
    """Row j holds the maximum of 2^j values from each place on; short rows end in zeros."""
    out = [values]
    while 2 << len(out) - 1 <= len(values):
        step, last = 1 << len(out) - 1, out[-1]
        row = np.zeros(len(values), np.int64)
        n = len(values) - 2 * step + 1
        np.maximum(last[:n], last[step : step + n], out=row[:n])
        out.append(row)
    return np.stack(out)


def search(shard: Shard, asked: list[int], best: Best, front: int = FRONT, leaf: int = LEAF) -> int:
    """Bring the best documents of a shard for the terms ``asked`` into ``best``; how many intervals were bounded."""
    lists = [slice(shard.starts[t], shard.ends[t]) for t in asked if t in shard.starts]
    if not lists:
        return 0
    docs, gains = (np.concatenate([x[s] for s in lists]) for x in (shard.doc, shard.gain))
    width = len(shard.ids) + 1
    key = docs + np.repeat(np.arange(len(lists)), [s.stop - s.start for s in lists]) * width
    # A contribution and the document it comes from, so that a maximum tells both.
    table = sparse_table(gains << BITS | docs * SCATTER % SHARD)
    rows = (np.arange(len(lists)) * width)[:, None]

    def bounded(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """For each interval its ends, the sum of the lists' maxima, and the document of the largest of these."""
        a, b = np.searchsorted(key, rows + lo), np.searchsorted(key, rows + hi)
        some = b > a
        level = np.frexp(np.maximum(b - a, 1))[1] - 1
        top = np.maximum(table[level, np.where(some, a, 0)], table[level, np.where(some, b - (1 << level), 0)])
        top = np.where(some, top, 0)
        return np.stack([lo, hi, (top >> BITS).sum(0), top.max(0) % SHARD * GATHER % SHARD])

    def offer(numbers: np.ndarray, scores: np.ndarray) -> None:
        best.offer(scores, shard.ids[numbers], shard.unknown[numbers])

    found = bounded(np.array([0]), np.array([len(shard.ids)]))
    n = 1
    while found.shape[1]:
        found = found[:, best.open(found[2], shard.ids[found[0]])]
        if found.shape[1] > front:
            order = np.argpartition(-found[2], front)
            now, found = found[:, order[:front]], found[:, order[front:]]
        else:
            now, found = found, found[:, :0]
        short = now[1] - now[0] <= leaf
        lo, hi = now[0, short], now[1, short]
        if len(lo):
            a, b = np.searchsorted(key, rows + lo).ravel(), np.searchsorted(key, rows + hi).ravel()
            at = np.repeat(a - np.concatenate([[0], np.cumsum(b - a)[:-1]]), b - a) + np.arange((b - a).sum())
            total = np.zeros(len(shard.ids), np.int64)
            np.add.at(total, docs[at], gains[at])
            scored = np.flatnonzero(total)
            offer(scored, total[scored])
        lo, hi, _, pivot = now[:, ~short]
        if len(lo):
            parts = bounded(np.concatenate([pivot, lo, pivot + 1]), np.concatenate([pivot + 1, pivot, hi]))
            n += parts.shape[1]
            offer(pivot, parts[2, : len(lo)])
            parts = parts[:, len(lo) :]
            found = np.concatenate([found, parts[:, parts[2] > 0]], axis=1)
    return n


def _searched(rows: DataFrame, asked: dict[int, list[int]], weights: dict[int, int], n_docs: int, n_terms: int, size: int, floors: dict[int, tuple[int, int]], shard: int) -> DataFrame:
    """``item, doc_id, score``: the best of each task, none that ``floors`` excludes."""
    schema = pa.schema([("item", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def shards(parts: Iterator[pa.RecordBatch]) -> Iterator[Shard]:
        held, n = [], 0
        for part in parts:
            at = 0
            while at < part.num_rows:
                held.append(part.slice(at, shard - n))
                at, n = at + held[-1].num_rows, n + held[-1].num_rows
                if n == shard:
                    yield Shard(held, weights, n_docs, n_terms)
                    held, n = [], 0
        if n:
            yield Shard(held, weights, n_docs, n_terms)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {item: Best(size, floors.get(item)) for item in asked}
        for some in shards(parts):
            for item, numbers in asked.items():
                search(some, numbers, best[item])
        for item, b in best.items():
            ids = pa.array(b.id, mask=b.unknown)
            yield pa.record_batch([pa.array(np.full(len(ids), item)), ids, pa.array(b.score)], schema=schema)

    return rows.mapInArrow(run, "item long, doc_id long, score long")


def _ranked(found: DataFrame) -> DataFrame:
    order = W.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order))


def ranked(
    docs: DataFrame, items: DataFrame, size: int = BEST, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", query_col: str = "text", block: int = ITEM_BYTES, shard: int = SHARD, seeds: int = SEEDS,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``size`` best documents of each item with a score above 0.

    Equal scores go by ascending id, null ids last. Repeated rows of ``docs`` are documents of their own; repeated rows
    of an item are one, items of equal id and different text each have ranks of their own, and a null item id stays.
    Null and empty texts hold no term, so such items have no rows. Empty tables give an empty result. Items are taken in
    blocks of about ``block`` bytes of text; one item has to fit a task.
    """
    spark = docs.sparkSession
    each = items.select(F.col(item_col).alias("item_id"), F.col(query_col).cast("string").alias("query")).where("query is not null").distinct()
    queries = stored(each.select("query").distinct().withColumn("item", F.monotonically_increasing_id()), "items")
    total = queries.agg(F.sum(F.octet_length("query"))).first()[0] or 0
    blocks = max(1, math.ceil(total / block))
    out = spark.createDataFrame([], "item long, doc_id long, score long, rank int")
    for number in range(blocks):
        asked: dict[int, list[bytes]] = {}
        for row in queries.where(F.pmod(F.xxhash64("query"), F.lit(blocks)) == number).collect():
            asked[row.item] = list(dict.fromkeys(t for part in terms(row.query.encode()) for t in part))
        known = {t: k for k, t in enumerate(dict.fromkeys(t for some in asked.values() for t in some))}
        if not known:
            continue
        rows = stored(postings(docs, known, id_col, text_col), "postings")
        n_docs, n_terms = rows.agg(F.count("*"), F.sum("n")).first()
        if not n_docs:
            continue
        counts = rows.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).collect()
        weights = {r.term: weight(r.df, n_docs) for r in counts}
        numbers = {item: [known[t] for t in some if known[t] in weights] for item, some in asked.items()}
        few = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(seeds)) == 0)
        run = lambda some, floors: _searched(some, numbers, weights, n_docs, n_terms, size, floors, shard)
        last = _ranked(run(few, {})).where(F.col("rank") == size).collect()
        floors = {r.item: (r.score, LAST_ID if r.doc_id is None else r.doc_id) for r in last}
        out = out.union(_ranked(run(rows, floors)).where(F.col("rank") <= size).select("item", "doc_id", "score", "rank"))
    named = each.join(queries, "query").select("item_id", "item")
    return named.join(out, "item").select("item_id", "rank", "doc_id", "score")


def op11_search(spark, sf_dir: str) -> DataFrame:
    return ranked(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
