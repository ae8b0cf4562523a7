"""SimHash near-duplicates: 64-bit fingerprints linked within three bits by pigeonring filtering.

Fingerprint. The set bits of the XXH64 hashes of all word shingles are counted; a bit of the fingerprint
is one if it is set in over half of them.

Candidates. The fingerprint is a ring of eight bytes. If two fingerprints differ in at most three bits,
some byte starts a chain whose first l bytes differ in at most floor(3 l / 8) bits, for every l up to 8.
The first two bytes are then equal and at most one of the next three differs, so one of three choices of
four bytes is equal: 24 keys of 32 bits per fingerprint hold every link. A key with more than ``LIMIT``
fingerprints is cut further: at most three of the eight half bytes left can differ, so 56 keys of 52 bits
hold its links, each with 4,096 fingerprints at the very most. Each bucket is then small by proof.

Verification. A task walks the fingerprints of a bucket breadth first: what is linked leaves the rest, so
a cluster yields one edge for each member, not all its pairs. A pair must keep the chain's budgets before
its full distance is counted.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readloom.llm.common import connected_components, documents, joined_apart, stored, texts, unused

SEED, DISTANCE, BYTES = 42, 3, 8
# Bits that the first l bytes of a chain may differ in.
BUDGETS = [DISTANCE * length // BYTES for length in range(1, BYTES + 1)]
# Equal bytes of a chain, as masks over the rotated fingerprint.
KINDS = [0x00FFFFFFFF, 0xFF00FFFFFF, 0xFFFF00FFFF]
LIMIT = 1024
BLOCK = 1 << 16


def shingle_hashes(text: str, words: int) -> tuple[Iterator[int], int]:
    """The hash of each word shingle, and how many there are; the whole text where it has fewer words."""
    parts = text.encode("utf-8", "surrogatepass").lower().split()
    if len(parts) < words:
        shingles, n = iter([b" ".join(parts)] if parts else []), min(1, len(parts))
    else:
        shingles, n = map(b" ".join, zip(*(parts[i:] for i in range(words)))), len(parts) - words + 1
    return map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), n


def simhash(text: str, words: int = 3) -> int:
    """The fingerprint of one text; zero without a word."""
    hashes, n = shingle_hashes(text, words)
    if not n:
        return 0
    counts = np.zeros(64, np.int64)
    for at in range(0, n, BLOCK):
        counts += set_bits(np.fromiter(hashes, "<u8", min(BLOCK, n - at)))
    return majority(counts, n)


def set_bits(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit set."""
    return np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)


def majority(counts: np.ndarray, n: int) -> int:
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, text_col: str = "text", words: int = 3, name: str = "fp") -> DataFrame:
    """``docs`` with the fingerprint of each row as its last column."""
    made = docs.withColumn(name, F.lit(0).cast("long"))
    fields, at = [f.name for f in made.schema], docs.columns.index(text_col)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            found = np.array([simhash(t.as_py() or "", words) for t in part.column(at)], np.uint64)
            yield pa.record_batch([*part.columns, pa.array(found.view(np.int64))], names=fields)

    return docs.mapInArrow(run, made.schema)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """``doc_id, fp``, one row per document. Null and empty texts have the fingerprint zero."""
    return with_fingerprints(texts(docs, id_col, text_col), "text", words).select("doc_id", "fp")


def _turned(fp: Column, start: int) -> Column:
    """The fingerprint with byte ``start`` lowest."""
    if not start:
        return fp
    return F.shiftrightunsigned(fp, 8 * start).bitwiseOR(F.shiftleft(fp, 64 - 8 * start))


def _signed(mask: int) -> Column:
    return F.lit(mask - (1 << 64) if mask >> 63 else mask).cast("long")


def ring_keys(nodes: DataFrame) -> DataFrame:
    """The 24 keys of each fingerprint: ``tag, part, fp``."""
    keys = [
        F.struct(F.lit(start * len(KINDS) + kind).alias("tag"), _turned(F.col("fp"), start).bitwiseAND(_signed(mask)).alias("part"))
        for start in range(BYTES)
        for kind, mask in enumerate(KINDS)
    ]
    return nodes.select("fp", F.explode(F.array(*keys)).alias("k")).select("k.tag", "k.part", "fp")


def _finer_masks(tag: int) -> list[int]:
    """Masks of the 56 keys below a key: three half bytes outside its equal bytes stay open."""
    mask = KINDS[tag % len(KINDS)]
    free = [0xF << (4 * i) for i in range(16) if not mask >> (4 * i) & 1]
    return [(1 << 64) - 1 & ~(a | b | c) for a, b, c in combinations(free, 3)]


def _buckets(keyed: DataFrame, limit: int) -> DataFrame:
    """Keys whose buckets are small: those above ``limit`` are replaced by finer ones."""
    sizes = keyed.groupBy("tag", "part").agg(F.count("*").alias("n"))
    marked = keyed.join(sizes.where(F.col("n") > 1), ["tag", "part"])
    signed = lambda mask: f"{mask - (1 << 64) if mask >> 63 else mask}L"
    masks = F.expr("array(" + ", ".join(f"array({', '.join(map(signed, _finer_masks(tag)))})" for tag in range(24)) + ")")
    start = "8 * cast(tag DIV 3 AS int)"
    turned = F.expr(f"shiftrightunsigned(fp, {start}) | shiftleft(fp, 64 - {start})")
    large = F.col("n") > limit
    small = marked.where(~large).select("tag", "part", "fp")
    cut = marked.where(large).select("tag", "fp", F.posexplode(F.element_at(masks, F.col("tag") + 1)).alias("i", "mask"))
    cut = cut.select(
        (24 + F.col("tag") * 56 + F.col("i")).alias("tag"),
        turned.bitwiseAND(F.col("mask")).alias("part"),
        "fp",
    )
    return small.union(cut)


def near(fp: int, others: np.ndarray, start: int) -> np.ndarray:
    """Which of ``others`` keep the budgets of the chain from byte ``start`` on, the full distance last."""
    differ = np.bitwise_count((others ^ np.uint64(fp)).view(np.uint8)).reshape(-1, BYTES)
    chain = np.roll(differ, -start, axis=1)
    kept = np.flatnonzero((np.cumsum(chain[:, :5], axis=1) <= BUDGETS[:5]).all(axis=1))
    full = (np.cumsum(chain[kept], axis=1, dtype=np.int64) <= BUDGETS).all(axis=1)
    out = np.zeros(len(others), bool)
    out[kept[full]] = True
    return out


def _forest(tag: int, fps: np.ndarray) -> Iterator[tuple[int, int]]:
    """Edges that join the linked fingerprints of a bucket, one for each but the first of a cluster."""
    start = (tag if tag < 24 else (tag - 24) // 56) // len(KINDS)
    rest = fps
    while len(rest) > 1:
        root, rest = rest[0], rest[1:]
        todo = [root]
        while todo and len(rest):
            hit = near(todo.pop(), rest, start)
            for fp in rest[hit]:
                yield int(root), int(fp)
                todo.append(fp)
            rest = rest[~hit]


def links(nodes: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Edges ``a, b`` between distinct fingerprints ``fp``; their components are those of all links."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for part in parts:
            tag, key = part["tag"].to_numpy(zero_copy_only=False), part["part"].to_numpy(zero_copy_only=False)
            fp = part["fp"].to_numpy(zero_copy_only=False).view(np.uint64)
            if held is not None:
                tag, key, fp = (np.concatenate(x) for x in zip(held, (tag, key, fp)))
            cuts = np.flatnonzero((np.diff(tag) != 0) | (np.diff(key) != 0)) + 1
            last = cuts[-1] if len(cuts) else 0
            yield from _edges(tag, fp, np.concatenate([[0], cuts]))
            held = tag[last:], key[last:], fp[last:]
        if held is not None:
            yield from _edges(held[0], held[2], np.array([0, len(held[0])]))

    def _edges(tag, fp, bounds):
        found = []
        for i in np.flatnonzero(np.diff(bounds) > 1):
            found += _forest(int(tag[bounds[i]]), fp[bounds[i] : bounds[i + 1]])
        if found:
            pairs = np.array(found, np.uint64).view(np.int64)
            yield pa.record_batch([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], schema=schema)

    buckets = _buckets(ring_keys(nodes), limit)
    placed = buckets.repartition("tag", "part").sortWithinPartitions("tag", "part", "fp")
    return placed.mapInArrow(run, "a long, b long").distinct()


def simhash_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, limit: int = LIMIT
) -> DataFrame:
    """``doc_id, fp, component_id``: the smallest id that links of three bits or fewer reach.

    Documents of equal fingerprint are one node, however many they are. Repeated rows stay rows. A null
    id counts for no smallest id, but its document links others; a component of null ids alone has a null.
    Null and empty texts share the fingerprint zero. An empty table gives an empty result.
    """
    each = stored(fingerprints(docs, id_col, text_col, words), "simhash")
    nodes, found = _linked(each, limit)
    ids = found.join(nodes, found.node == nodes.fp).select("node", "root", "least")
    least = ids.groupBy("root").agg(F.min("least").alias("component_id"))
    linked = found.join(least, "root").select(F.col("node").alias("fp"), "component_id")
    whole = nodes.join(linked, "fp", "left").select("fp", "copies", F.coalesce("component_id", "least").alias("component_id"))
    return joined_apart(each, whole, ["fp"], each.count()).select("doc_id", "fp", "component_id")


def _linked(each: DataFrame, limit: int) -> tuple[DataFrame, DataFrame]:
    """``fp, least, copies`` of each fingerprint, and ``node, root`` of the linked ones."""
    nodes = each.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies"))
    return nodes, stored(connected_components(links(nodes.select("fp"), limit)), "components")


def one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, limit: int = LIMIT) -> DataFrame:
    """The rows of ``docs`` with one row of each component of linked fingerprints: that of its smallest id.

    Of rows that share this id, or where all ids are null, the one with the smallest hash of its text stays; of
    repeated rows one stays. Only ids, hashes and fingerprints are grouped; texts move only where the rows that go
    are too many to be broadcast, by Spark's own threshold, and for repeated rows.
    """
    tag = F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    rows = texts(docs, id_col, text_col).withColumn("tag", F.xxhash64("text"))
    each = stored(with_fingerprints(rows, "text", words).select("doc_id", "tag", "fp"), "simhash")
    nodes, found = _linked(each, limit)
    roots = nodes.join(found, nodes.fp == found.node, "left").select("fp", "least", "copies", F.coalesce("root", "fp").alias("root"))
    groups = roots.groupBy("root").agg(F.min("least").alias("best"), F.sum("copies").alias("size")).where("size > 1")
    grouped = stored(roots.join(groups, "root").select("fp", "root", "best", "copies"), "groups")
    members = stored(joined_apart(each, grouped, ["fp"], each.count()).distinct(), "members")
    first = members.where(F.col("doc_id").eqNullSafe(F.col("best"))).groupBy("root").agg(F.min("tag").alias("first"))
    gone = members.join(first, "root").where(~F.col("doc_id").eqNullSafe(F.col("best")) | (F.col("tag") != F.col("first")))
    keys = [unused(docs, "key_id"), unused(docs, "key_tag")]
    named = lambda df: df.select(F.col("doc_id").alias("other_id"), F.col("tag").alias("other_tag")).distinct()
    # Written first, so that Spark knows their size before it shuffles texts.
    gone = stored(named(gone), "gone")
    twice = stored(named(each.groupBy("doc_id", "tag").agg(F.count("*").alias("n")).where("n > 1")), "twice")
    marked = docs.withColumns({keys[0]: F.col(id_col).cast("long"), keys[1]: tag})

    def kept(df: DataFrame, other: DataFrame, how: str) -> DataFrame:
        return df.join(other, F.col(keys[0]).eqNullSafe(other["other_id"]) & (F.col(keys[1]) == other["other_tag"]), how)

    whole = kept(marked, gone, "left_anti")
    out = kept(whole, twice, "left_anti").union(kept(whole, twice, "left_semi").dropDuplicates(keys))
    return out.drop(*keys)


def op5_simhash(spark, sf_dir: str) -> DataFrame:
    found = simhash_components(documents(spark, sf_dir))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
