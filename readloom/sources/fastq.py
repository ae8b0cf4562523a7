"""FASTQ text into one row per read, exact for any file split.

Columns: ``file, block, seq, header, bases, qual``. ``(file, block, seq)`` orders the reads as
they stand in the file; ``number_records`` turns that order into a dense number when wanted.

The text source is told that a row ends before every line that starts with ``@``. A read then
arrives as one whole four-line chunk, and Spark's own split handling keeps chunks whole across
file splits. That covers all reads but those whose quality line itself starts with ``@``: they
arrive as a three-line head and a one-line tail. Only these fragments are shuffled, by file
block, and joined to their neighbour; a head that ends a block meets the tail that begins the
next one in a second step over at most two rows per block.

One file cannot be told from a truncated one and loses its last read: a file without a final line
end whose last quality line is a lone ``@``. A header that starts with ``@@`` keeps one of them. The
byte-range source reads both as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

READ_COLUMNS = ["file", "block", "seq", "header", "bases", "qual"]

_PLACE = ["file", "block", "seq"]

# Kinds of chunk; blank lines may follow at the end of a file. Bases and qualities of a whole read
# are both there or both empty, which tells a read without bases from a truncated one.
WHOLE = r"\A[^\n]*\n(?:[^\n]+\n\+[^\n]*\n[^\n]+|\n\+[^\n]*\n)\n*\z"
HEAD = r"\A[^\n]*\n[^\n]*\n\+[^\n]*\z"
TAIL = r"\A[^\n]*\n*\z"


def read_fastq(spark: SparkSession, paths: str | list[str], partitions: int | None = None) -> DataFrame:
    """Reads of one or more FASTQ files. ``+name`` separators and CRLF line ends are accepted.

    ``partitions`` asks for a minimum number of partitions, useful after gzip files, which Spark
    cannot split.
    """
    chunks = _chunks(spark, paths)
    reads = _whole_reads(chunks).unionByName(_stitched_reads(chunks))
    return reads.repartition(partitions) if partitions else reads


def _chunks(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    text = spark.read.option("lineSep", "\n@").text(paths)
    return text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
        F.replace(F.col("value"), F.lit("\r")).alias("chunk"),
    )


def _header(line: Column) -> Column:
    """Restore the ``@`` that the row separator took; only the first row of a file still has it."""
    return F.when(F.startswith(line, F.lit("@")), line).otherwise(F.concat(F.lit("@"), line))


def _whole_reads(chunks: DataFrame) -> DataFrame:
    line = F.split("chunk", "\n")
    return chunks.where(F.rlike("chunk", F.lit(WHOLE))).select(
        *_PLACE, _header(line[0]).alias("header"), line[1].alias("bases"), line[3].alias("qual")
    )


def _stitched_reads(chunks: DataFrame) -> DataFrame:
    line = F.split("chunk", "\n")
    is_head = F.rlike("chunk", F.lit(HEAD))
    parts = chunks.where(F.rlike("chunk", F.lit(f"{HEAD}|{TAIL}"))).select(
        *_PLACE,
        F.when(is_head, F.struct(_header(line[0]).alias("header"), line[1].alias("bases"))).alias("head"),
        F.when(~is_head, F.concat(F.lit("@"), line[0])).alias("tail"),
    )
    in_block = W.partitionBy("file", "block").orderBy("seq")
    near = parts.select(
        "*",
        F.lead("tail").over(in_block).alias("next_tail"),
        F.lead("seq").over(in_block).alias("next_seq"),
        F.lag("head").over(in_block).alias("prev_head"),
        F.lag("seq").over(in_block).alias("prev_seq"),
    )
    heads = F.col("head").isNotNull()
    inside = near.where(heads & F.col("next_tail").isNotNull() & (F.col("next_seq") == F.col("seq") + 1))
    # What is left at the edges of a block: a head that is its last chunk, a tail that is its first. They
    # belong together only in neighbouring blocks, so every block with a chunk takes part.
    ends = chunks.groupBy("file", "block").agg(F.min("seq").alias("first"), F.max("seq").alias("last"))
    edges = parts.join(ends, ["file", "block"])
    at_edge = edges.groupBy("file", "block").agg(
        F.max(F.when(heads & (F.col("seq") == F.col("last")), F.struct("seq", "head"))).alias("end"),
        F.max(F.when(F.col("seq") == F.col("first"), F.col("tail"))).alias("start"),
    )
    over_edge = W.partitionBy("file").orderBy("block")
    crossing = (
        ends.join(at_edge, ["file", "block"], "left")
        .select(
            "file", "block", F.col("end.seq").alias("seq"), F.col("end.head").alias("head"),
            F.lead("start").over(over_edge).alias("next_tail"),
        )
        .where(heads & F.col("next_tail").isNotNull())
    )

    out = [*_PLACE, F.col("head.header").alias("header"), F.col("head.bases").alias("bases"), F.col("next_tail").alias("qual")]
    stitched = inside.select(*out).unionByName(crossing.select(*out))
    return stitched.where(F.length("bases") == F.length("qual"))


def number_records(reads: DataFrame) -> DataFrame:
    """Add ``record_no``, counted from 0 in file order.

    Rows are numbered inside their block; the blocks, one row each, get a running total per file.
    """
    in_block = W.partitionBy("file", "block").orderBy("seq")
    before = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    starts = (
        reads.groupBy("file", "block")
        .count()
        .select("file", "block", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first_no"))
    )
    numbered = reads.withColumn("in_block", F.row_number().over(in_block).cast("long") - 1)
    return numbered.join(starts, ["file", "block"]).select(
        *reads.columns, (F.col("first_no") + F.col("in_block")).alias("record_no")
    )
