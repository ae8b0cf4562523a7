"""Native alignment text: ``chrom pos mapq cigar bases quals``, space separated."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_alignments(spark: SparkSession, path: str) -> DataFrame:
    return parse_alignments(spark.read.text(path))


def parse_alignments(lines: DataFrame) -> DataFrame:
    """Typed columns from a ``value`` column. Plain split, as qualities may hold quote characters.

    Fields that a broken line lacks are null, as are numbers that are none.
    """
    part = lambda n: F.get(F.split("value", " "), F.lit(n))
    return lines.select(
        part(0).alias("chrom"),
        part(1).try_cast("int").alias("pos"),
        part(2).try_cast("int").alias("mapq"),
        part(3).alias("cigar"),
        part(4).alias("bases"),
        part(5).alias("qual"),
    )


def is_valid() -> Column:
    """True for alignments to a ``chr`` sequence with a known CIGAR; a ``*`` in the qualities is no matter."""
    placed = F.contains("chrom", F.lit("chr")) & ~F.contains("chrom", F.lit("*"))
    return placed & ~F.contains("cigar", F.lit("*"))


def valid_alignments(alignments: DataFrame) -> DataFrame:
    return alignments.where(is_valid())
