"""Base alignment quality: how sure each aligned base is of its reference column.

Spark joins reads to their reference, spreads them over tasks and aggregates the result. Inside a
task, reads of equal shape in an Arrow batch go through one array computation together: the
forward-backward recurrences of a profile HMM with match, insertion and deletion states, in a band
of diagonals that is proven wide enough. Clipped bases stay out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from readloom.functions.batches import alike, cigar_steps, codes, single_bytes
from readloom.functions.cigar import ALIGNED, CIGAR_ITEM, USES_REF
from readloom.operators.pileup import KIND, LOCI, has_bases, has_quality, loci_of, summed_loci, with_reference, with_reference_base

# Gap opening, gap extension, chance of an inserted base.
GAP_OPEN, GAP_EXTEND, INSERTED = 0.001, 0.1, 0.25

# Cells per array step, so that its arrays stay in the processor cache; rows between rescalings.
CELLS, RESCALE = 1 << 16, 8
# Rows up to which the recurrence along the reference is a plain loop.
LOOPED = 96
# Bases of the reads that are scored together.
BASES = 1 << 21

# The paths outside a band have at most this share of the probability; the first band tried, in diagonals to either side.
OUTSIDE, NARROW = 1e-12, 8
# Reference spans up to which the whole matrix is no slower than a band.
SHORT = 32
# Bands of up to so many diagonals to either side come in steps of ``STEP``, wider ones in powers of two.
STEPPED, STEP = 32, 2
# Weights of an inserted base in the bound on what is outside; an insertion goes on with less than 1 in 40.
TILTS = np.array([2.0, 4, 8, 16, 32])

BAQ_SCHEMA = "chrom string, pos int, ref string, base string, q int, baq double"


def posteriors(
    reads: np.ndarray, quals: np.ndarray, refs: np.ndarray, columns: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Match posterior of each base at its column, and log10 of the forward and backward totals.

    ``reads, quals, columns`` are (batch, l), ``refs`` is (batch, L); columns count from 0 and
    are negative for bases that align to none. Rows are rescaled to avoid underflow.
    """
    batch, l = reads.shape
    width = refs.shape[1]
    end = 1 / (2 * l)
    stay, gap, close = (1 - 2 * GAP_OPEN) * (1 - end), GAP_OPEN * (1 - end), (1 - GAP_EXTEND) * (1 - end)
    start_m, start_i = (1 - GAP_OPEN) / width, GAP_OPEN / width * INSERTED
    # Insertion and deletion states are kept as their share of the next match, in units of ``stay``.
    # Opening and extending them then takes the same factors in both directions.
    open_i, more_i = gap * INSERTED * close / stay, GAP_EXTEND * (1 - end) * INSERTED
    open_d, more_d = gap * (1 - GAP_EXTEND) / stay, GAP_EXTEND

    # One row per reference column, so that a step along the reference is a plain slice.
    refs, reads = np.ascontiguousarray(refs.T), np.ascontiguousarray(reads.T)
    miss = 10.0 ** (-np.ascontiguousarray(quals.T) / 10.0) / 3
    gain, miss = (1 - 4 * miss) * stay, miss * stay
    at, each = np.maximum(columns, 0).T, np.arange(batch)
    fwd, bwd, scale = np.empty((l, batch)), np.empty((l, batch)), np.ones((l, batch))
    # Every step writes into the same few arrays; fresh ones would cost more than the arithmetic.
    spare, emitted = np.empty((width, batch)), np.empty((width, batch))

    def emission(i: int, out: np.ndarray) -> np.ndarray:
        """``miss`` where read and reference differ, ``miss + gain`` where they agree."""
        out[...] = refs == reads[i]
        out *= gain[i]
        out += miss[i]
        return out

    def insertion(m: np.ndarray, ins: np.ndarray) -> np.ndarray:
        ins *= more_i
        ins += np.multiply(m, open_i, out=spare)
        return ins

    m = emission(0, emitted) * (start_m / stay)
    ins = np.full((width, batch), start_i * close / stay)
    dele = np.zeros((width, batch))
    for i in range(l):
        if i:
            into = dele
            into += m
            into += ins
            ins = insertion(m, ins)
            m = emission(i, m)
            m[1:] *= into[:-1]
            m[0] = 0
        if i % RESCALE == 0:
            scale[i] = m.sum(0) + ins.sum(0)
            m /= scale[i]
            ins /= scale[i]
        dele[0] = 0
        np.multiply(m[:-1], open_d, out=dele[1:])
        _carry(dele, more_d)
        fwd[i] = m[at[i], each]
    total = (m.sum(0) + ins.sum(0) * (stay / close)) * end

    m = np.full((width, batch), end)
    ins = np.full((width, batch), end * gap * INSERTED)
    match = np.zeros((width, batch))
    bwd[l - 1] = end
    for i in range(l - 2, -1, -1):
        np.multiply(emission(i + 1, emitted)[1:], m[1:], out=match[:-1])
        np.multiply(match, open_d, out=dele)
        _carry(dele[::-1], more_d)
        np.add(match, ins, out=m)
        m[:-1] += dele[1:]
        ins = insertion(match, ins)
        if (i + 1) % RESCALE == 0:
            m /= scale[i + 1]
            ins /= scale[i + 1]
        bwd[i] = m[at[i], each]
    first = (emission(0, emitted) * m).sum(0) * (start_m / stay)
    back_total = (first + ins.sum(0) * (start_i / gap / INSERTED)) / scale[0]
    logs = np.log10(scale).sum(0)
    return (fwd * bwd / total).T, logs + np.log10(total), logs + np.log10(back_total)


def banded(
    reads: np.ndarray, quals: np.ndarray, refs: np.ndarray, columns: np.ndarray, half: int, forward_only: bool = False
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``posteriors`` over the paths that keep to a band of diagonals.

    A cell's diagonal is its column less its row. The band holds those between 0 and ``L - l``, and ``half`` more on
    either side. An array row is a diagonal, so a match stays in its row and an insertion moves down by one; memory is
    linear in the band. Bases whose column is outside it get 0. ``forward_only`` leaves out all but the forward total.
    """
    batch, l = reads.shape
    width = refs.shape[1]
    low, high = min(0, width - l) - half, max(0, width - l) + half
    wide = high - low + 1
    end = 1 / (2 * l)
    stay, gap, close = (1 - 2 * GAP_OPEN) * (1 - end), GAP_OPEN * (1 - end), (1 - GAP_EXTEND) * (1 - end)
    start_m, start_i = (1 - GAP_OPEN) / width, GAP_OPEN / width * INSERTED
    open_i, more_i = gap * INSERTED * close / stay, GAP_EXTEND * (1 - end) * INSERTED
    open_d, more_d = gap * (1 - GAP_EXTEND) / stay, GAP_EXTEND

    # Row 0 of the padded reference is column ``low``.
    padded = np.zeros((l + wide, batch), np.uint8)
    padded[-low : width - low] = refs.T[: l + wide + low]
    reads = np.ascontiguousarray(reads.T)
    miss = 10.0 ** (-np.ascontiguousarray(quals.T) / 10.0) / 3
    gain, miss = (1 - 4 * miss) * stay, miss * stay
    at, each = columns.T - np.arange(l)[:, None] - low, np.arange(batch)
    inside = (columns.T >= 0) & (at >= 0) & (at < wide)
    at = np.where(inside, at, 0)
    scale = np.ones((l, batch))
    spare, emitted = np.empty((wide, batch)), np.empty((wide, batch))

    def emission(i: int, out: np.ndarray) -> np.ndarray:
        """As in ``posteriors``, and 0 where the reference has no such column."""
        out[...] = padded[i : i + wide] == reads[i]
        out *= gain[i]
        out += miss[i]
        out[: max(0, -low - i)] = 0
        out[max(0, width - low - i) :] = 0
        return out

    columns_of_first = slice(max(0, -low), max(0, width - low))
    m = emission(0, emitted) * (start_m / stay)
    ins = np.zeros((wide, batch))
    ins[columns_of_first] = start_i * close / stay
    dele = np.zeros((wide, batch))
    fwd = np.empty((0 if forward_only else l, batch))
    for i in range(l):
        if i:
            into = dele
            into += m
            into += ins
            # What an insertion adds comes from the diagonal above.
            np.multiply(ins[1:], more_i, out=spare[:-1])
            spare[-1] = 0
            ins, spare = spare, ins
            np.multiply(m[1:], open_i, out=spare[:-1])
            ins[:-1] += spare[:-1]
            m = emission(i, m)
            m *= into
        if i % RESCALE == 0:
            scale[i] = m.sum(0) + ins.sum(0)
            m /= scale[i]
            ins /= scale[i]
        dele[0] = 0
        np.multiply(m[:-1], open_d, out=dele[1:])
        _carry(dele, more_d)
        if not forward_only:
            fwd[i] = m[at[i], each]
    total = (m.sum(0) + ins.sum(0) * (stay / close)) * end
    logs = np.log10(scale).sum(0)
    if forward_only:
        return fwd.T, logs + np.log10(total), logs

    bwd = np.empty((l, batch))
    m = np.full((wide, batch), end)
    ins = np.full((wide, batch), end * gap * INSERTED)
    bwd[l - 1] = end
    for i in range(l - 2, -1, -1):
        match = emission(i + 1, emitted)
        match *= m
        np.multiply(match, open_d, out=dele)
        _carry(dele[::-1], more_d)
        m[0] = match[0]
        np.add(match[1:], ins[:-1], out=m[1:])
        m[:-1] += dele[1:]
        np.multiply(ins[:-1], more_i, out=spare[1:])
        spare[0] = 0
        ins, spare = spare, ins
        ins += np.multiply(match, open_i, out=spare)
        if (i + 1) % RESCALE == 0:
            m /= scale[i + 1]
            ins /= scale[i + 1]
        bwd[i] = m[at[i], each]
    first = (emission(0, emitted) * m).sum(0) * (start_m / stay)
    back_total = (first + ins[columns_of_first].sum(0) * (start_i / gap / INSERTED)) / scale[0]
    return np.where(inside, fwd * bwd / total, 0).T, logs + np.log10(total), logs + np.log10(back_total)


def halves_needed(reads: np.ndarray, quals: np.ndarray, refs: np.ndarray, total: np.ndarray) -> np.ndarray:
    """How many diagonals on either side a band needs, given log10 of a lower bound of all paths' probability.

    Paths start on diagonal 0 or above and end on ``L - l`` or below, and only an insertion leads down. So a path that
    leaves a band has more than ``half + max(0, l - L)`` inserted bases. The probability of all paths with n of them or
    more is at most that of all paths with inserted bases counted z-fold, over z^n, for each z above 1. That needs no
    column: a match is at most as good as the base's best one. Infinite where the total is unknown.
    """
    batch, l = reads.shape
    width = refs.shape[1]
    go = 1 - 1 / (2 * l)
    wrong = 10.0 ** (-quals / 10.0)
    found = np.zeros(reads.shape, bool)
    for base in np.unique(reads):
        found |= (reads == base) & (refs == base).any(1)[:, None]
    best = np.ascontiguousarray(np.where(found, np.maximum(1 - wrong, wrong / 3), wrong / 3).T)
    extra = (INSERTED * TILTS)[:, None]
    after_m = after_i = np.full((len(TILTS), batch), 1 / (2 * l))
    logs = np.zeros((len(TILTS), batch))
    for i in range(l - 1, 0, -1):
        matched, inserted = best[i] * after_m, extra * after_i
        after_m = go * ((1 - GAP_OPEN) * matched + GAP_OPEN * inserted)
        after_i = go * ((1 - GAP_EXTEND) * matched + GAP_EXTEND * inserted)
        if i % RESCALE == 0:
            size = after_m + after_i
            after_m, after_i = after_m / size, after_i / size
            logs += np.log10(size)
    logs += np.log10((1 - GAP_OPEN) * best[0] * after_m + GAP_OPEN * extra * after_i)
    inserts = (logs - total - np.log10(OUTSIDE)) / np.log10(TILTS)[:, None]
    half = np.ceil(inserts.min(0)) - max(0, l - width)
    return np.where(np.isfinite(total) & np.isfinite(half), np.maximum(half, 1), np.inf)


def path_total(reads: np.ndarray, quals: np.ndarray, refs: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """log10 of the probability of the one path that takes each base to its column, others as inserted.

    Minus infinity or not a number where the model has no such path.
    """
    l, width = reads.shape[1], refs.shape[1]
    go = 1 - 1 / (2 * l)
    on = columns >= 0
    same = reads == np.take_along_axis(refs, np.maximum(columns, 0), 1)
    low = int(quals.min())
    wrong = 10.0 ** (-np.arange(low, int(quals.max()) + 1) / 10.0)
    with np.errstate(divide="ignore", invalid="ignore"):
        emits = np.concatenate([[np.log10(INSERTED)], np.log10(wrong / 3), np.log10(1 - wrong)])
    found = emits[np.where(on, quals - low + 1 + same * len(wrong), 0)].sum(1)
    if (columns == columns[:1]).all():
        columns, on = columns[:1], on[:1]
    # Steps from base to base: on, over deleted columns, into, along and out of inserted bases.
    before, after = on[:, :-1], on[:, 1:]
    last = np.maximum.accumulate(columns, axis=1)[:, :-1]
    jump = columns[:, 1:] - last
    steps = np.log10([(1 - 2 * GAP_OPEN) * go, GAP_OPEN * go, GAP_EXTEND * go, (1 - GAP_EXTEND) * go])
    taken = np.where(before, np.where(after, 0, 1), np.where(after, 3, 2))
    deleted = np.where(before & after, jump - 1, 0)
    over = np.log10(GAP_OPEN * go * (1 - GAP_EXTEND)) - steps[0] + (deleted - 1) * np.log10(GAP_EXTEND)
    found = found + (steps[taken] + np.where(deleted > 0, over, 0)).sum(1)
    # Inserted bases lead on to the next column alone; the first column has none before it.
    broken = after & np.where(before, jump < 1, np.where(last < 0, columns[:, 1:] < 1, jump != 1))
    found = np.where(broken.any(1), -np.inf, found)
    return found + np.where(on[:, 0], np.log10((1 - GAP_OPEN) / width), np.log10(GAP_OPEN / width)) + np.log10(1 / (2 * l))


def match_posteriors(reads: np.ndarray, quals: np.ndarray, refs: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Match posterior of each base at its column, with an error of at most ``OUTSIDE``.

    The path of the alignment itself, or a narrow band, gives a lower bound of the total, which tells how wide a band leaves
    out too little to matter. Bands are rounded up, so that reads share them; where one is no smaller than the matrix, that
    is computed.
    """
    batch, l = reads.shape
    width = refs.shape[1]
    post, half = np.empty((batch, l)), np.full(batch, np.inf)
    bound = lambda h: 2 * h + 1 + abs(width - l)
    if width > SHORT and bound(1) < width:
        total = path_total(reads, quals, refs, columns)
        half = halves_needed(reads, quals, refs, total)
        # Where the alignment itself says little, as with many errors, a narrow band may say more.
        weak = np.flatnonzero(bound(half) >= min(width, 2 * bound(NARROW)))
        if len(weak) and bound(NARROW) < width:
            rows = (reads[weak], quals[weak], refs[weak])
            # A band without any path has no total.
            with np.errstate(divide="ignore", invalid="ignore"):
                total = np.fmax(total[weak], banded(*rows, columns[weak], NARROW, forward_only=True)[1])
            half[weak] = halves_needed(*rows, total)
        wide = half > STEPPED
        half[~wide] = np.ceil(half[~wide] / STEP) * STEP
        half[wide] = 2.0 ** np.ceil(np.log2(half[wide]))
    half[bound(half) >= width] = np.inf
    for h in np.unique(half):
        members = np.flatnonzero(half == h)
        step = max(1, int(CELLS // min(bound(h), width)))
        for first in range(0, len(members), step):
            some = members[first : first + step]
            rows = (reads[some], quals[some], refs[some], columns[some])
            post[some] = (posteriors(*rows) if np.isinf(h) else banded(*rows, int(h)))[0]
    return post


def _carry(x: np.ndarray, rate: float) -> None:
    """In place, row by row: x[k] += rate * x[k-1].

    Few rows are taken one by one. Many are done by doubling: after the step of s rows each row holds the
    sum over the last 2 s, until the rate is too small for any number.
    """
    if len(x) <= LOOPED:
        spare = np.empty(x.shape[1])
        for k in range(1, len(x)):
            np.multiply(x[k - 1], rate, out=spare)
            x[k] += spare
        return
    spare, step = np.empty(x.shape), 1
    while step < len(x) and rate > 0:
        np.multiply(x[:-step], rate, out=spare[step:])
        x[step:] += spare[step:]
        step, rate = 2 * step, rate * rate


def cap_quality(post: np.ndarray, quals: np.ndarray) -> np.ndarray:
    """The smaller of the base quality and the alignment quality; the base quality when certain."""
    wrong = 1 - post
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(wrong <= 0, quals, np.minimum(-10 * np.log10(wrong), quals))


def _chars(codes: np.ndarray) -> pa.Array:
    """One-character strings from character codes."""
    flat = np.ascontiguousarray(codes, np.uint8).ravel()
    ends = np.arange(len(flat) + 1, dtype=np.int32)
    return pa.StringArray.from_buffers(len(flat), pa.py_buffer(ends), pa.py_buffer(flat))


def base_columns(shape: str, l: int, width: int) -> np.ndarray:
    """Reference column of each of the l bases of an unclipped CIGAR, -1 where there is none."""
    columns, at = [], 0
    for size, op in re.findall(CIGAR_ITEM, shape):
        n = int(size)
        if op in ALIGNED:
            columns.append(np.arange(at, at + n))
        elif op == "I":
            columns.append(np.full(n, -1))
        at += n if op in USES_REF else 0
    found = np.concatenate(columns)[:l] if columns else np.empty(0, np.int64)
    return np.where(found < width, found, -1)


def _score(offset: int, min_baq: float | None = None):
    """Scored bases, or their counts per position when a threshold is given."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _enough(batches):
            chroms = batch["chrom"].dictionary_encode()
            pos = pc.fill_null(batch["pos"], 0).to_numpy(zero_copy_only=False).astype(np.int64)
            tallied = []
            for rows, *arrays in _unclipped(batch):
                on, at, ref, base, q, baq = _score_alike(pos[rows], *arrays, offset)
                name = chroms.indices.to_numpy(zero_copy_only=False)[rows][np.nonzero(on)[0]].astype(np.int64)
                if min_baq is None:
                    columns = [chroms.dictionary.take(pa.array(name)), at.astype(np.int32), _chars(ref), _chars(base), q.astype(np.int32), baq]
                    yield pa.record_batch(columns, names=["chrom", "pos", "ref", "base", "q", "baq"])
                else:
                    good = baq >= min_baq
                    tallied.append((name[good], at[good], KIND[base[good]]))
            if tallied:
                yield loci_of(chroms, *(np.concatenate(x) for x in zip(*tallied)))

    return run


def _enough(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches put together until they have ``BASES`` bases or more, so that many reads share a shape and a band."""
    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += pc.sum(pc.binary_length(batch["bases"])).as_py() or 0
        if size >= BASES:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _unclipped(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, ...]]:
    """Rows of equal length and reference span, whatever their CIGARs: their numbers, bases, quality characters, reference
    and columns, without what is clipped; as many as are scored together."""
    texts = {c: single_bytes(batch[c]) for c in ("bases", "qual", "ref_seq")}
    sizes = [pc.fill_null(pc.binary_length(x), 0).to_numpy(zero_copy_only=False) for x in texts.values()]
    shapes: dict[tuple[int, int], list[tuple[np.ndarray, ...]]] = {}
    for cigar, rows in alike(batch["cigar"], *sizes):
        has, rated, width = (int(x[rows[0]]) for x in sizes)
        used = [np.arange(off, min(off + n, has, rated)) for op, n, off, _ in cigar_steps(cigar) if op == "I" or op in ALIGNED]
        kept = np.concatenate([*used, np.empty(0, np.int64)]).astype(np.int64)
        if len(kept) and width:
            columns = np.broadcast_to(base_columns(cigar, len(kept), width), (len(rows), len(kept)))
            bases, quals, refs = (codes(x.take(pa.array(rows)), n) for x, n in zip(texts.values(), (has, rated, width)))
            shapes.setdefault((len(kept), width), []).append((rows, bases[:, kept], quals[:, kept], refs, columns))
    for (l, width), parts in shapes.items():
        together = [np.concatenate(x) for x in zip(*parts)]
        step = max(1, BASES // max(l, width))
        for first in range(0, len(together[0]), step):
            yield tuple(x[first : first + step] for x in together)


def _score_alike(
    pos: np.ndarray, reads: np.ndarray, quals: np.ndarray, refs: np.ndarray, columns: np.ndarray, offset: int
) -> tuple[np.ndarray, ...]:
    """Which bases have a column; position, reference, base, quality and capped quality of these."""
    quals = quals.astype(np.int64) - offset
    post = match_posteriors(reads, quals, refs, columns)
    on = columns >= 0
    ref = np.take_along_axis(refs, np.maximum(columns, 0), 1)
    return on, (pos[:, None] + columns)[on], ref[on], reads[on], quals[on], cap_quality(post, quals)[on]


def _scored(alignments: DataFrame, ref: DataFrame, seen: Observation | None = None) -> DataFrame:
    """What the scoring of alignments takes; those without stored bases or qualities cannot be scored and stay out."""
    columns = ["chrom", "pos", "cigar", "bases", "qual"]
    referenced = with_reference(alignments.select(*columns), ref, gather=True)
    if seen is not None:
        referenced = referenced.observe(seen, F.count(F.lit(1)).alias("referenced"))
    return referenced.where(has_bases() & has_quality() & F.col("cigar").isNotNull())


def baq_bases(alignments: DataFrame, ref: DataFrame, offset: int = 33) -> DataFrame:
    """``chrom, pos, ref, base, q, baq``, one row per aligned base."""
    return _scored(alignments, ref).mapInArrow(_score(offset), BAQ_SCHEMA)


def baq_pileup(
    alignments: DataFrame, ref: DataFrame, min_baq: int = 20, offset: int = 33, seen: Observation | None = None
) -> DataFrame:
    """Locus counts of bases whose ``baq`` reaches ``min_baq``.

    Tasks count what they score before it leaves Python, so a region's reads come back as one row
    per position and base. ``seen`` gets ``referenced``, the alignments that the reference has a tile for.
    """
    counted = _scored(alignments, ref, seen).mapInArrow(_score(offset, min_baq), LOCI)
    return with_reference_base(summed_loci(counted), ref)
