"""End-to-end jobs: quality control, trim and pair, external alignment, SNP counts, full chain.

Jobs compose operators and write with sinks. The only eager step before a sink is the search for the
first read that proves the Phred offset, in every input; Spark stops it at the first hit.

Jobs that write return what they counted on the way, by ``DataFrame.observe`` in the pass that writes. Where a lost
executor makes Spark run a task again, its rows may be counted again; what is written is not affected. A count is None
where Spark leaves the step out, as it sees that an input is empty.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from readloom.functions.quality import decides_offset, decisive_offset
from readloom.operators import baq, coordinates, external, pairing, pileup
from readloom.operators import qc as stats
from readloom.operators.trim import trim_reads
from readloom.session import fresh_path
from readloom.sinks import text as sinks
from readloom.sources.alignments import is_valid, read_alignments, valid_alignments
from readloom.sources.fastq import read_fastq
from readloom.sources.fastq_ranges import read_fastq_ranges
from readloom.sources.reference import read_reference
from readloom.sources.sam import parse_sam, sam_header

READERS = {"text": read_fastq, "ranges": read_fastq_ranges}


def _observed(df: DataFrame, **counts: Column) -> tuple[DataFrame, Observation]:
    """``df``, and the observation of ``counts`` over its rows in the next pass over it."""
    seen = Observation()
    return df.observe(seen, *(F.coalesce(c, F.lit(0)).alias(n) for n, c in counts.items())), seen


def _counts(seen: Observation, *names: str) -> dict[str, int | None]:
    """What an observation counted, after the write."""
    try:
        return seen.get
    except Py4JJavaError:
        # An observation that was planned away is completed without a row.
        return dict.fromkeys(names)


def learn_offset(*inputs: DataFrame) -> int:
    """The Phred offset that the reads of all inputs prove; no prefix of a file decides.

    Raises ``ValueError`` if two inputs contradict each other or no read of any input decides, in
    which case the caller has to state the offset.
    """
    found = {
        row.offset
        for reads in inputs
        for row in reads.where(decides_offset(F.col("qual"))).select(decisive_offset(F.col("qual")).alias("offset")).take(1)
    }
    if len(found) > 1:
        raise ValueError("the inputs have different Phred offsets")
    if not found:
        raise ValueError("no read proves a Phred offset; state it with offset=33 or offset=64")
    return found.pop()


def qc(spark: SparkSession, path: str, report_path: str, reader: str = "text", offset: int | None = None) -> None:
    """Write the QC report of a FASTQ file."""
    reads = READERS[reader](spark, path).select("bases", "qual")
    _write_qc(spark, reads, path, report_path, offset or learn_offset(reads))


def _write_qc(spark: SparkSession, reads: DataFrame, path: str, report_path: str, offset: int) -> None:
    # The histogram has a few rows per cycle. Stored, it costs one pass over the reads, though both
    # the average and the box plot use it.
    hist = stats.cycle_quality_hist(reads, offset).persist()
    try:
        boxplot = stats.qc_boxplot(stats.cycle_quantiles(hist))
        report = stats.qc_report_lines(path.rstrip("/"), stats.qc_summary(reads), stats.avg_quality(hist), boxplot)
        sinks.write_report(report, report_path)
    finally:
        hist.unpersist()


def trim_pair(
    spark: SparkSession,
    path1: str,
    path2: str,
    out1: str,
    out2: str,
    min_q: int = 20,
    min_len: int = 30,
    method: str = "group",
    reader: str = "text",
    strict_len: bool = False,
    offset: int | None = None,
    sep: str | None = None,
) -> dict[str, int | None]:
    """Trim both files, pair the mates, write them as two matching FASTQ folders.

    Each header decides its separator unless ``sep`` states one for all. Returns ``reads1, reads2``, those of each file,
    ``kept1, kept2``, those that the trim leaves, and ``pairs``.
    """
    first, second = (READERS[reader](spark, p).select("header", "bases", "qual") for p in (path1, path2))
    offset = offset or learn_offset(first, second)
    trimmed, seen = [], []
    for mate, reads in enumerate((first, second), 1):
        reads, all_of = _observed(reads, **{f"reads{mate}": F.count(F.lit(1))})
        kept, some_of = _observed(
            trim_reads(reads, offset, min_q, min_len, strict_len), **{f"kept{mate}": F.count(F.lit(1))}
        )
        trimmed.append(kept)
        seen += [(all_of, f"reads{mate}"), (some_of, f"kept{mate}")]
    pairs, paired = _observed(pairing.pair_mates(*trimmed, method, sep), pairs=F.count(F.lit(1)))
    sinks.write_paired_fastq(pairs, out1, out2)
    return {name: n for each in [*seen, (paired, "pairs")] for name, n in _counts(*each).items()}


def qc_and_trim(
    spark: SparkSession,
    path1: str,
    path2: str,
    out1: str,
    out2: str,
    report_path: str,
    reader: str = "text",
    offset: int | None = None,
    **options,
) -> dict[str, int | None]:
    """QC of the first file, then ``trim_pair`` and its counts; the offset is looked up once."""
    offset = offset or learn_offset(*(READERS[reader](spark, p) for p in (path1, path2)))
    qc(spark, path1, report_path, reader, offset)
    return trim_pair(spark, path1, path2, out1, out2, reader=reader, offset=offset, **options)


def align_external(pairs: DataFrame, command: str) -> DataFrame:
    """SAM lines printed by an aligner that reads interleaved FASTQ; one process per partition."""
    return external.pipe_lines(pairing.interleave(pairs), command)


def sam_pileup(
    lines: DataFrame,
    ref: DataFrame | None = None,
    command: str | None = None,
    min_q: int = 0,
    offset: int = 33,
    region: int | None = coordinates.REGION,
    sums: bool = False,
) -> DataFrame:
    """Pileup of SAM lines: native locus counts, or the output lines of a command.

    A command gets the sorted header and one stretch of ``region`` bases at a time, in coordinate
    order; ``region=None`` gives it whole reference names. ``sums`` states that it prints counts that add up over
    reads, so that the reads of a stretch may be dealt to several runs.
    """
    body = coordinates.mapped_reads(parse_sam(lines))
    if command is None:
        return pileup.pileup_counts(as_alignments(body), ref, min_q, offset)
    if region is not None:
        return coordinates.pileup_by_region(sam_header(lines), body, command, region, sums)
    return external.pipe_lines(coordinates.sam_partition_blocks(sam_header(lines), body), command)


def as_alignments(sam: DataFrame) -> DataFrame:
    """The native alignment columns of SAM rows."""
    return sam.selectExpr("rname as chrom", "pos", "mapq", "cigar", "seq as bases", "qual")


def snp_counts(alignments: DataFrame, ref: DataFrame, min_baq: int = 20, offset: int = 33) -> DataFrame:
    """Locus counts of valid alignments over bases with enough base alignment quality."""
    return baq.baq_pileup(valid_alignments(alignments), ref, min_baq, offset)


def call_snps(
    spark: SparkSession, alignments_path: str, ref_path: str, out: str, min_baq: int = 20, offset: int = 33, ordered: bool = True
) -> dict[str, int | None]:
    """Locus lines of an alignment file and a reference file, in the order of the loci unless ``ordered`` is false.

    Returns ``alignments``, the lines read, ``unplaced``, those that are not valid alignments, and ``unscored``, valid
    ones left out as the reference has no tile for them.
    """
    rows, read = _observed(
        read_alignments(spark, alignments_path),
        alignments=F.count(F.lit(1)),
        unplaced=F.count_if(~F.coalesce(is_valid(), F.lit(False))),
    )
    found = Observation()
    ref = read_reference(spark, ref_path)
    loci = baq.baq_pileup(valid_alignments(rows), ref, min_baq, offset, found)
    sinks.write_locus_counts(loci, out, ordered=ordered)
    counts = _counts(read, "alignments", "unplaced")
    each = (*counts.values(), _counts(found, "referenced")["referenced"])
    return counts | {"unscored": None if None in each else each[0] - each[1] - each[2]}


def ngs(
    spark: SparkSession,
    path1: str,
    path2: str,
    report_path: str,
    aligner: str,
    ref: DataFrame | None = None,
    pileup_command: str | None = None,
    trim: bool = True,
    min_q: int = 20,
    min_len: int = 30,
    reader: str = "text",
    offset: int | None = None,
    sep: str | None = None,
    region: int | None = coordinates.REGION,
) -> DataFrame:
    """Full chain: QC report, trim, pair, align, then pileup.

    The aligner's output is kept in the shared folder, so it runs once even though header and
    alignments are both read from it, and a lost executor does not run it again.
    """
    first, second = (READERS[reader](spark, p).select("header", "bases", "qual") for p in (path1, path2))
    offset = offset or learn_offset(first, second)
    qc(spark, path1, report_path, reader, offset)
    mates = [trim_reads(reads, offset, min_q, min_len) if trim else reads for reads in (first, second)]
    pairs = pairing.pair_mates(*mates, "group", sep)
    stored = _store_lines(spark, align_external(pairs, aligner))
    return sam_pileup(stored, ref, pileup_command, offset=offset, region=region)


def _store_lines(spark: SparkSession, lines: DataFrame) -> DataFrame:
    path = fresh_path(spark, "sam")
    sinks.write_lines(lines, path)
    return spark.read.text(path)
