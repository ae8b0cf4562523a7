"""Repeated passages of ``LENGTH`` bytes or more, found on a sparse enhanced suffix array.

Equal texts are one text with a number of copies. In the others, every window of ``LENGTH`` bytes marks
its smallest hash of ``GRAM`` bytes; equal windows mark equal places, so a repeated window holds an anchor
whose hash occurs again, in any text or the same one. Only suffixes that start at such anchors are sorted:
Spark sorts them by hash, by the bytes to the right and by the bytes to the left, read backwards.

In a group of equal hash a stack scan of the common prefixes of neighbours walks the interval tree. Where two
intervals meet, each occurrence of the smaller is put among the left sides of the larger, in order; its
neighbours there have the longest common left extension. If that and the common prefix make ``LENGTH`` bytes,
both occurrences repeat as far as they agree. The smaller goes into the larger, so all partners of all
occurrences are covered in n log n steps, not only neighbours in the array.

An occurrence whose both sides are the same as another's repeats as a whole and is passed on at once, so copies
of a passage take no memory. A hash with more than ``LIMIT`` occurrences is replaced by the windows around it,
each a group of its own whose members are all equal. No group is held that can grow with the input.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readloom.llm.common import documents, stored, texts, unused

LENGTH, GRAM, LIMIT = 200, 40, 1 << 16
BLOCK = 1 << 18
_rng = np.random.default_rng(10)
LETTERS = _rng.integers(1, 1 << 63, 256).astype(np.uint64)
FACTOR, MIX = 0x9E3779B97F4A7C15, np.uint64(0xD6E8FEB86659FD93)


def _slide(x: np.ndarray, width: int, best: np.ufunc, empty: int) -> np.ndarray:
    """``best`` of every ``width`` neighbours, by runs from both ends of blocks of that width."""
    n = len(x) - width + 1
    padded = np.full(-(-len(x) // width) * width, empty, np.uint64)
    padded[: len(x)] = x
    rows = padded.reshape(-1, width)
    ahead = best.accumulate(rows, axis=1).ravel()
    back = best.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return best(back[:n], ahead[width - 1 : width - 1 + n])


class Anchors:
    """Places and hashes of the anchors of a text."""

    def __init__(self, length: int = LENGTH, gram: int = GRAM):
        self.length, self.gram, self.wide = length, gram, length - gram + 1
        size = BLOCK + length
        step = np.full(size, FACTOR, np.uint64)
        step[0] = 1
        self.power = np.cumprod(step)
        step[1:] = pow(FACTOR, -1, 1 << 64)
        self.inverse = np.cumprod(step)

    def _block(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(data)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(LETTERS[data] * self.power[:n], out=sums[1:])
        h = (sums[self.gram :] - sums[: -self.gram]) * self.inverse[: n - self.gram + 1]
        h ^= h >> np.uint64(32)
        h *= MIX
        h ^= h >> np.uint64(29)
        least = _slide(h, self.wide, np.minimum, (1 << 64) - 1)
        # A place is marked if it is the least of some window that holds it.
        around = np.concatenate([np.zeros(self.wide - 1, np.uint64), least, np.zeros(self.wide - 1, np.uint64)])
        at = np.flatnonzero(_slide(around, self.wide, np.maximum, 0) == h)
        return at, h[at]

    def __call__(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        data = np.frombuffer(text, np.uint8)
        found = [
            (at + start, h)
            for start in range(0, len(data) - self.length + 1, BLOCK)
            for at, h in [self._block(data[start : start + BLOCK + self.length - 1])]
        ]
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        at, first = np.unique(np.concatenate([a for a, _ in found]), return_index=True)
        return at, np.concatenate([h for _, h in found])[first].view(np.int64)


def common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    if a == b:
        return len(a)
    n = min(len(a), len(b))
    differ = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (differ.bit_length() + 7) // 8


def reaches(rights: list[bytes], lefts: list[bytes], length: int = LENGTH) -> list[list[int]]:
    """``[left, right]`` bytes that repeat around each of the sorted occurrences, ``[0, 0]`` if none do."""
    out = [[0, 0] for _ in rights]

    def meet(a: list, b: list, depth: int) -> list:
        """One interval of two: the smaller one's occurrences look for the longest left extension in the larger."""
        small, large = (a, b) if len(a) < len(b) else (b, a)
        for item in small:
            at = bisect_left(large, item)
            for other in large[max(0, at - 1) : at + 1]:
                left = common(item[0], other[0])
                if left + depth >= length:
                    for i in (item[1], other[1]):
                        out[i] = [max(out[i][0], left), max(out[i][1], depth)]
            large.insert(at, item)
        return large

    stack: list[tuple[int, list]] = []
    node = [(lefts[0], 0)]
    for i in range(1, len(rights)):
        depth = common(rights[i - 1], rights[i])
        while stack and stack[-1][0] > depth:
            deeper, members = stack.pop()
            node = meet(members, node, deeper)
        if stack and stack[-1][0] == depth:
            stack[-1] = (depth, meet(stack[-1][1], node, depth))
        else:
            stack.append((depth, node))
        node = [(lefts[i], i)]
    while stack:
        deeper, members = stack.pop()
        node = meet(members, node, deeper)
    return out


def text_digest(text: Column) -> Column:
    """128 bits of SHA-256, as texts of strangers must not collide by intent.

    It is never null, and says so: a filter on nulls would set one use of the texts apart from the others, and
    they would no longer share one exchange.
    """
    return F.coalesce(F.substring(F.unhex(F.sha2(text.cast("binary"), 256)), 1, 16), F.lit(b""))


def distinct_texts(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """``doc_id, digest`` of each row, and ``digest, text, copies`` of each text."""
    rows = texts(docs, id_col, text_col).withColumn("digest", text_digest(F.col("text")))
    one = rows.groupBy("digest").agg(F.first("text").alias("text"), F.count("*").alias("copies"))
    return rows.select("doc_id", "digest"), one


def anchor_counts(one: DataFrame, length: int, gram: int) -> DataFrame:
    """``digest, h, n``: how often each anchor hash stands in each text."""
    schema = pa.schema([("digest", pa.binary()), ("h", pa.int64()), ("n", pa.int64())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = Anchors(length, gram)
        for part in parts:
            names, hashes, counts = [], [], []
            for digest, text in zip(part["digest"].to_pylist(), part["text"].to_pylist()):
                h, n = np.unique(anchors(text.encode())[1], return_counts=True)
                names += [digest] * len(h)
                hashes.append(h)
                counts.append(n)
            columns = [np.concatenate([*x, np.empty(0, np.int64)]) for x in (hashes, counts)]
            yield pa.record_batch([pa.array(names, pa.binary()), *map(pa.array, columns)], schema=schema)

    # All columns, so that every use of the texts is the same plan and shares one exchange.
    return one.select("digest", "text", "copies").mapInArrow(run, "digest binary, h long, n long")


def occurrences(one: DataFrame, repeated: DataFrame, length: int, gram: int) -> DataFrame:
    """``h, right, left, digest, places``: the sides of each repeated anchor, once for equal sides in a text."""
    schema = pa.schema([("h", pa.int64()), ("right", pa.binary()), ("left", pa.binary()), ("digest", pa.binary()), ("places", pa.list_(pa.int32()))])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = Anchors(length, gram)
        held: list[tuple] = []
        for part in parts:
            for digest, text, wanted, hot in zip(*(part[c].to_pylist() for c in ("digest", "text", "hs", "hot"))):
                data, hot = text.encode(), set(hot)
                at, h = anchors(data)
                chosen = np.isin(h, np.array(wanted, np.int64))
                sides: dict[tuple, list[int]] = {}
                starts: set[int] = set()  # of windows around hot anchors, which may share them
                for p, x in zip(at[chosen].tolist(), h[chosen].tolist()):
                    if x in hot:
                        for start in {*range(max(0, p + gram - length), min(p, len(data) - length) + 1)} - starts:
                            starts.add(start)
                            window = data[start : start + length]
                            key = int.from_bytes(hashlib.blake2b(window, digest_size=8).digest(), "big", signed=True)
                            sides.setdefault((key, window, b""), []).append(start)
                    else:
                        left = data[max(0, p + gram - length) : p][::-1]
                        sides.setdefault((x, data[p : p + length], left), []).append(p)
                held += [(*side, digest, places) for side, places in sides.items()]
                if len(held) > 8192:
                    yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
                    held = []
        if held:
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)

    rows = one.join(repeated, "digest").select("digest", "text", "copies", "hs", "hot")
    return rows.mapInArrow(run, "h long, right binary, left binary, digest binary, places array<int>")


def spans(sides: DataFrame, length: int) -> DataFrame:
    """``digest, spans``: starts and ends of repeated bytes in each text, not yet joined."""
    schema = pa.schema([("digest", pa.binary()), ("places", pa.list_(pa.int32())), ("lo", pa.int32()), ("hi", pa.int32())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        group, single = None, []  # of the group, the occurrences whose sides no other shares
        last, seen = None, 0

        def whole(right: bytes, left: bytes, digest, places) -> None:
            if len(left) + len(right) >= length:
                out.append((digest, places, len(left), len(right)))

        def close() -> None:
            # A shared side takes part once, so that the single ones find it.
            if len(single) > 1:
                found = reaches([s[0] for s in single], [s[1] for s in single], length)
                for (_, _, digest, places), (lo, hi) in zip(single, found):
                    if digest is not None and hi:
                        out.append((digest, places, lo, hi))
            single.clear()

        for part in parts:
            for h, right, left, digest, places in zip(*(part[c].to_pylist() for c in ("h", "right", "left", "digest", "places"))):
                if h != group:
                    close()
                    group, last = h, None
                if (right, left) == last:
                    if not seen:
                        whole(*single[-1])
                        single[-1] = (right, left, None, None)
                    seen = 1
                    whole(right, left, digest, places)
                else:
                    last, seen = (right, left), 0
                    single.append((right, left, digest, places))
                    if len(places) > 1:
                        seen = 1
                        single[-1] = (right, left, None, None)
                        whole(right, left, digest, places)
            if len(out) > 8192:
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
                out.clear()
        close()
        if out:
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    placed = sides.repartition("h").sortWithinPartitions("h", "right", "left")
    found = placed.mapInArrow(run, "digest binary, places array<int>, lo int, hi int")
    found = found.select("digest", F.explode("places").alias("p"), "lo", "hi")
    span = F.struct((F.col("p") - F.col("lo")).alias("start"), (F.col("p") + F.col("hi")).alias("end"))
    return found.groupBy("digest").agg(F.collect_set(span).alias("spans"))


def cut(text: bytes, found: list[tuple[int, int]]) -> tuple[bytes, int]:
    """The text without the union of spans, and the number of runs removed."""
    kept, runs, end = [], 0, -1
    for start, stop in sorted(found):
        if start > end:
            kept.append(text[max(end, 0) : start])
            runs += 1
        end = max(end, stop)
    return b"".join(kept) + text[max(end, 0) :], runs


def repeated_spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, limit: int = LIMIT
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``doc_id, digest`` of each row, ``digest, text, copies`` of each distinct text, and ``digest, spans`` of those with repeats.

    Texts with copies repeat as a whole, if they are long enough, and have no spans here.
    """
    ids, one = distinct_texts(docs, id_col, text_col)
    counts = anchor_counts(one, length, gram)
    often = counts.groupBy("h").agg(F.sum("n").alias("n")).where("n > 1")
    again = counts.select("digest", "h").join(often, "h")
    hot = F.when(F.col("n") > limit, F.col("h"))
    again = again.groupBy("digest").agg(F.collect_list("h").alias("hs"), F.collect_list(hot).alias("hot"))
    return ids, one, spans(occurrences(one, again, length, gram), length)


def cut_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, **options) -> tuple[DataFrame, DataFrame]:
    """``doc_id, digest`` of each row, and for each distinct text ``digest, n_bytes, n_removed, n_spans, kept``."""
    ids, one, found = repeated_spans(docs, id_col, text_col, length, **options)
    schema = pa.schema([("digest", pa.binary()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            rows = []
            for digest, text, copies, repeats in zip(*(part[c].to_pylist() for c in ("digest", "text", "copies", "spans"))):
                data = text.encode()
                whole = copies > 1 and len(data) >= length
                kept, runs = cut(data, [(0, len(data))] if whole else [(s["start"], s["end"]) for s in repeats or []])
                rows.append((digest, len(data), len(data) - len(kept), runs, kept))
            if rows:
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    results = one.join(found, "digest", "left").mapInArrow(run, "digest binary, n_bytes long, n_removed long, n_spans long, kept binary")
    return ids, results


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``doc_id, digest, n_bytes, n_removed, n_spans, kept``: each text without bytes of repeated passages.

    A byte goes if a string of ``length`` bytes that holds it starts at another place as well, in any row or the
    same; all occurrences go. Rows of equal text, also repeated rows, repeat each other. Null texts count as
    empty; a text shorter than ``length`` stays as it is. ``kept`` is binary, as a cut may split a character.
    """
    ids, results = cut_texts(docs, id_col, text_col, **options)
    return ids.join(results, "digest").select("doc_id", "digest", "n_bytes", "n_removed", "n_spans", "kept")


def documents_without_repeats(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` with their texts cut; half characters at a cut go, null texts stay null.

    All other columns stay, whatever they are called.
    """
    _, one, found = repeated_spans(docs, docs.columns[0], text_col, **options)
    size = F.octet_length("text")
    whole = one.where((F.col("copies") > 1) & (size >= options.get("length", LENGTH)))
    whole = whole.select("digest", F.array(F.struct(F.lit(0).alias("start"), size.alias("end"))).alias("spans"))
    # Spans go to the texts; kept texts would be a second shuffle of these.
    marks = stored(found.join(whole.select("digest"), "digest", "left_anti").union(whole), "spans")
    key, span_col = unused(docs, "text_digest"), unused(docs, "text_spans")
    marks = marks.withColumnsRenamed({"digest": key, "spans": span_col})
    joined = docs.withColumn(key, text_digest(F.coalesce(F.col(text_col), F.lit("")))).join(marks, key, "left")
    fields, at = docs.columns, docs.columns.index(text_col)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            columns, texts_cut = part.columns, []
            for text, repeats in zip(columns[at], columns[-1]):
                places = repeats.as_py()
                if places:
                    kept, _ = cut(text.as_py().encode(), [(s["start"], s["end"]) for s in places])
                    texts_cut.append(kept.decode("utf-8", "ignore"))
                else:
                    texts_cut.append(text.as_py())
            columns[at] = pa.array(texts_cut, pa.string())
            yield pa.record_batch(columns[:-1], names=fields)

    return joined.select(*(F.col(f"`{c}`") for c in fields), span_col).mapInArrow(run, docs.schema)


def op10_repeats(spark, sf_dir: str) -> DataFrame:
    ids, results = cut_texts(documents(spark, sf_dir))
    digests = results.select("digest", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
    return ids.join(digests, "digest").drop("digest")
