"""Text outputs. Each is a folder of part files, as Spark writes them."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.operators.pairing import PAIR_COLUMNS, fastq_text

# Fixed value: the columns of a locus line, in order.
LOCUS_COLUMNS = ["chrom", "pos", "ref", "total", "a", "t", "c", "g", "n"]


def write_lines(lines: DataFrame, path: str, mode: str = "error") -> None:
    lines.select("value").write.mode(mode).text(path)


def write_report(report: DataFrame, path: str, mode: str = "error") -> None:
    """The QC report in one file; it has one line per group of cycles."""
    report.coalesce(1).sortWithinPartitions("line_no").select("line").write.mode(mode).text(path)


def write_fastq(reads: DataFrame, path: str, mode: str = "error") -> None:
    reads.select(fastq_text("header", "bases", "qual").alias("value")).write.mode(mode).text(path)


def mate_lines(pairs: DataFrame, mate: int) -> DataFrame:
    """FASTQ text of one mate per pair, as ``value``."""
    return pairs.select(fastq_text(f"header{mate}", f"bases{mate}", f"qual{mate}").alias("value"))


def write_paired_fastq(pairs: DataFrame, out1: str, out2: str, mode: str = "error") -> None:
    """Mate 1 to ``out1`` and mate 2 to ``out2``; row i of part k is the same pair in both.

    The pairs are stored once under a total order inside each partition, so both outputs follow
    the same rows even where a lost block has to be computed again.
    """
    ordered = pairs.select(*PAIR_COLUMNS).sortWithinPartitions(*PAIR_COLUMNS).persist(StorageLevel.DISK_ONLY)
    try:
        mate_lines(ordered, 1).write.mode(mode).text(out1)
        mate_lines(ordered, 2).write.mode(mode).text(out2)
    finally:
        ordered.unpersist()


def locus_lines(loci: DataFrame) -> DataFrame:
    columns = [F.col(c).cast("string") for c in LOCUS_COLUMNS if c in loci.columns]
    return loci.select(F.concat_ws(" ", *columns).alias("value"))


def write_locus_counts(loci: DataFrame, path: str, mode: str = "error", ordered: bool = False) -> None:
    """``chrom pos ref total A T C G N`` lines; ``ordered`` sorts them by locus over all parts."""
    write_lines(locus_lines(loci.orderBy("chrom", "pos") if ordered else loci), path, mode)
