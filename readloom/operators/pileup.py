"""Aligned columns, reference lookup and locus counts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readloom.functions.bases import CALLED
from readloom.functions.batches import alike, cigar_steps, codes, single_bytes
from readloom.functions.cigar import ALIGNED, USES_READ, USES_REF, cigar_items, reference_span
from readloom.sources.reference import OVERLAP, TILE, reference_tiles

LOCUS_BIN = 1 << 10
COUNTS = ["total", *(b.lower() for b in CALLED), "n"]
LOCI = ", ".join(["chrom string", "pos int", *(f"{c} long" for c in COUNTS)])
# Class of each character: that of a called base, any other, and of a base that a read lacks though it has its quality.
OTHER, ABSENT, KINDS = len(CALLED), len(CALLED) + 1, len(CALLED) + 2
KIND = np.full(256, OTHER, np.int8)
KIND[[ord(b) for b in CALLED]] = range(OTHER)


def cigar_ops(alignments: DataFrame) -> DataFrame:
    """One row per CIGAR operation, with the read and reference bases used before it."""
    items = alignments.select("*", F.posexplode(cigar_items(F.col("cigar"))).alias("op_index", "item"))
    return items.select(*alignments.columns, "op_index", "item.len", "item.op", "item.read_off", "item.ref_off")


def with_reference(
    alignments: DataFrame, ref: DataFrame, tile: int = TILE, overlap: int = OVERLAP, gather: bool = False
) -> DataFrame:
    """Add ``ref_seq``, the reference under each alignment; one whose start no tile covers is left out.

    The genome is cut into tiles that run ``overlap`` bases into the next one. An alignment of no longer span finds
    all its bases in the tile of its start, by one equi-join. A longer one, as a spliced read, is cut at the tile
    borders: each distinct start and span looks up its stretches in the same tiles, which are put together in order,
    and its alignments join the result. No row holds more of the genome than one alignment spans. Spark broadcasts
    the tiles when they measure small and shuffles them by tile, once, when they do not.

    The alignments are read three times: short ones, the spots of long ones, and these. With ``gather`` they are shuffled by
    ``gather_by_locus`` first and all three read that one exchange, so that what leads to the alignments runs once.
    """
    tiles = reference_tiles(ref, tile, overlap)
    placed = alignments.withColumn("_span", reference_span(F.col("cigar")))
    if gather:
        # As one value a row keeps its columns and filters on this side of the exchange, which is then the same for all.
        placed = gather_by_locus(placed)
        placed = placed.select(F.explode(F.array(F.struct(*placed.columns))).alias("_row")).select("_row.*")
    long = F.coalesce(F.col("_span") > overlap, F.lit(False))
    start = F.col("pos") - 1
    number = lambda at: F.floor(at / tile).cast("int")

    short = placed.where(~long).withColumn("tile", number(start)).join(tiles, ["chrom", "tile"])
    bases = F.substring("tile_seq", F.pmod(start, F.lit(tile)) + 1, F.col("_span")).alias("ref_seq")
    found = short.select(*alignments.columns, bases)

    spot = ["chrom", "pos", "_span"]
    end = start + F.col("_span")
    crossed = placed.where(long).select(*spot).distinct().withColumn("tile", F.explode(F.sequence(number(start), number(end - 1))))
    low = F.col("tile") * tile
    first, last = F.greatest(start, low), F.least(end, low + tile)
    pieces = crossed.join(tiles, ["chrom", "tile"]).select(
        *spot, F.struct("tile", F.substring("tile_seq", first - low + 1, last - first).alias("seq")).alias("piece")
    )
    whole = pieces.groupBy(*spot).agg(F.array_sort(F.collect_list("piece")).alias("pieces"))
    whole = whole.where(F.col("pieces")[0]["tile"] == number(start))
    spanned = placed.where(long).join(whole, spot)
    return found.unionByName(spanned.select(*alignments.columns, F.array_join("pieces.seq", "").alias("ref_seq")))


def gapped_alignments(referenced: DataFrame) -> DataFrame:
    """Add ``read_gapped``, ``ref_gapped`` and ``ops``: equally long, ``_`` where a side is absent.

    Clipped bases take no part.
    """
    shown = F.filter(
        cigar_items(F.col("cigar")), lambda it: it["op"].isin("I", *USES_REF)
    )

    def side(text: str, uses: tuple[str, ...], off: str):
        part = lambda it: F.when(
            it["op"].isin(*uses), F.substring(F.col(text), it[off] + 1, it["len"])
        ).otherwise(F.repeat(F.lit("_"), it["len"]))
        return F.array_join(F.transform("_items", part), "")

    ops = F.array_join(F.transform("_items", lambda it: F.repeat(it["op"], it["len"])), "")
    return referenced.withColumn("_items", shown).select(
        *referenced.columns,
        side("bases", USES_READ, "read_off").alias("read_gapped"),
        side("ref_seq", USES_REF, "ref_off").alias("ref_gapped"),
        ops.alias("ops"),
    )


def aligned_columns(referenced: DataFrame, *keep: str) -> DataFrame:
    """One row per alignment column: ``col`` from 0, ``op``, ``ref``, ``base``."""
    chars = lambda c: F.split(c, "").alias(c)
    zipped = F.arrays_zip(chars("ops"), chars("ref_gapped"), chars("read_gapped"))
    columns = gapped_alignments(referenced).select(*keep, F.posexplode(zipped).alias("col", "c"))
    return columns.select(
        *keep, "col",
        F.col("c.ops").alias("op"), F.col("c.ref_gapped").alias("ref"), F.col("c.read_gapped").alias("base"),
    )


def has_bases() -> Column:
    """False for the ``*`` that stands for bases left out."""
    return F.col("bases") != "*"


def has_quality() -> Column:
    """False for the ``*`` that stands for qualities left out; the quality of a single base may be ``*``."""
    return (F.col("qual") != "*") | (F.length("bases") == 1)


def gather_by_locus(alignments: DataFrame, width: int = LOCUS_BIN) -> DataFrame:
    """Bring reads of one region together before they are exploded into bases.

    Shuffling reads is far cheaper than shuffling the bases they explode into. Afterwards partial
    aggregation meets every position of a region in one task and leaves a row per position.
    REBALANCE lets adaptive execution split a crowded region over several tasks, and merge
    sparse ones.
    """
    keyed = alignments.withColumn("_bin", F.floor(F.col("pos") / width))
    return keyed.hint("rebalance", "chrom", "_bin").drop("_bin")


def _tally(least: int):
    """Counts per position of the bases of a batch whose quality character reaches ``least``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield _tallied(batch, least)

    return run


def _tallied(batch: pa.RecordBatch, least: int) -> pa.RecordBatch:
    chroms = batch["chrom"].dictionary_encode()
    names = len(chroms.dictionary) + 1
    owner = pc.fill_null(chroms.indices, names - 1).to_numpy(zero_copy_only=False).astype(np.int64)
    placed = batch["pos"].is_valid().to_numpy(zero_copy_only=False)
    pos = pc.fill_null(batch["pos"], 0).to_numpy(zero_copy_only=False).astype(np.int64)
    bases, quals = single_bytes(batch["bases"]), single_bytes(batch["qual"])
    sizes = [pc.binary_length(x).to_numpy(zero_copy_only=False) for x in (bases, quals)]

    found = []
    for cigar, rows in alike(batch["cigar"], *sizes, placed):
        l, n = (int(x[rows[0]]) for x in sizes)
        kinds = np.full((len(rows), n), ABSENT, np.int8)
        kinds[:, :l] = KIND[codes(bases.take(pa.array(rows)), l)[:, :n]]
        columns = np.full(n, -1)
        for op, size, read_off, ref_off in cigar_steps(cigar):
            if op in ALIGNED and read_off < n:
                columns[read_off : read_off + size] = ref_off + np.arange(min(size, n - read_off))
                if read_off >= l:
                    kinds[:, read_off] = OTHER
        on = np.flatnonzero(columns >= 0)
        good = (codes(quals.take(pa.array(rows)), n) >= least)[:, on]
        # A read without a position counts at none.
        at = pos[rows][:, None] + (columns[on] if placed[rows[0]] else np.zeros(len(on), np.int64))
        name = owner[rows] + (0 if placed[rows[0]] else names)
        found.append((np.broadcast_to(name[:, None], at.shape)[good], at[good], kinds[:, on][good]))

    name, at, kind = (np.concatenate(x) for x in zip(*found)) if found else (np.empty(0, np.int64),) * 3
    return loci_of(chroms, name, at, kind)


def loci_of(chroms: pa.DictionaryArray, name: np.ndarray, at: np.ndarray, kind: np.ndarray) -> pa.RecordBatch:
    """``chrom, pos`` and counts of bases: the number of their name, their position and their class.

    The number after the names stands for no name; from the next one on they count again, for no position.
    """
    names = len(chroms.dictionary) + 1
    low = at.min() if len(at) else 0
    span = int(at.max() - low) + 1 if len(at) else 1
    key = ((name * span) + (at - low)) * KINDS + kind
    if 2 * names * span * KINDS <= max(1 << 16, 4 * len(key)):
        counts = np.bincount(key, minlength=2 * names * span * KINDS).reshape(-1, KINDS)
        loci = np.flatnonzero(counts.any(1))
        counts = counts[loci]
    else:
        kept, times = np.unique(key, return_counts=True)
        loci, row = np.unique(kept // KINDS, return_inverse=True)
        counts = np.zeros((len(loci), KINDS), np.int64)
        counts[row, kept % KINDS] = times
    name, where = loci // span, loci % span + low
    known = pa.array(name % names, mask=name % names == names - 1)
    columns = [chroms.dictionary.take(known), pa.array(where.astype(np.int32), mask=name >= names), counts.sum(1)]
    return pa.record_batch([*columns, *(counts[:, k] for k in range(OTHER + 1))], names=["chrom", "pos", *COUNTS])


def summed_loci(tallied: DataFrame) -> DataFrame:
    """One row for each position of counts that tasks took."""
    return tallied.groupBy("chrom", "pos").agg(*(F.sum(c).alias(c) for c in COUNTS))


def with_reference_base(loci: DataFrame, ref: DataFrame, tile: int = TILE) -> DataFrame:
    """Add ``ref`` after counting: one lookup per position instead of one per base.

    Positions that the reference does not have stay, with a null.
    """
    at = F.pmod(F.col("pos") - 1, F.lit(tile))
    keyed = loci.withColumn("tile", F.floor((F.col("pos") - 1) / tile).cast("int"))
    found = keyed.join(reference_tiles(ref, tile), ["chrom", "tile"], "left")
    counts = [c for c in loci.columns if c not in ("chrom", "pos")]
    base = F.nullif(F.substring("tile_seq", at + 1, F.lit(1)), F.lit(""))
    return found.select("chrom", "pos", base.alias("ref"), *counts)


def pileup_counts(
    alignments: DataFrame, ref: DataFrame | None = None, min_q: int = 0, offset: int = 33, gather: bool = True
) -> DataFrame:
    """Counts per position of aligned bases with quality at least ``min_q``.

    ``gather=False`` skips the shuffle of reads, for input already in coordinate order. A read without
    stored qualities counts with quality 0, a read without stored bases not at all. Tasks count the bases of
    a batch of reads at a time, as arrays, so that no row stands for a single base.
    """
    stored = alignments.where(has_bases()).withColumn(
        "qual", F.when(has_quality(), F.col("qual")).otherwise(F.repeat(F.lit(chr(offset)), F.length("bases")))
    )
    rows = (gather_by_locus(stored) if gather else stored).select("chrom", "pos", "cigar", "bases", "qual")
    loci = summed_loci(rows.mapInArrow(_tally(offset + min_q), LOCI))
    return loci if ref is None else with_reference_base(loci, ref)
