"""Reads, reference, alignments and SAM lines that Spark derives from the given tables.

They grow with ``lineitem``. ``(l_orderkey, l_linenumber)`` repeats, so read names do too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from readloom.session import fresh_path, spread
from readloom.sinks.text import write_fastq

HEX = "0123456789abcdef"
# Letters that stand for the sixteen hex digits.
READ_BASES, REF_BASES = "ACGTACGTACGTACGN", "ACGTACGTACGTACGT"
QUALITIES, AT_QUALITIES = "4:>?ABCDEFGHIIII", "4:>@ABCDEFGHIIII"
SECOND_FILE = "l_linenumber <= 2"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _letters(tag: str, letters: str) -> Column:
    key = F.concat(F.col("l_orderkey").cast("string"), F.lit("/"), F.col("l_linenumber").cast("string"))
    digest = lambda i: F.md5(F.concat(F.lit(f"{tag}{i}"), key))
    return F.translate(F.concat(digest(0), digest(1)), HEX, letters)


def _name(mates: bool) -> list[Column]:
    order, line = F.col("l_orderkey").cast("string"), F.col("l_linenumber")
    if not mates:
        return [order, F.lit("/"), line.cast("string")]
    number = F.floor(line / 2).cast("string")
    return [order, F.lit("."), number, F.lit("/"), (1 + line % 2).cast("string")]


def settled(df: DataFrame) -> DataFrame:
    """Evaluate each row once. Otherwise the optimizer copies the derivation into every expression
    that uses it, which a read that comes from a file does not suffer."""
    return df.select(F.explode(F.array(F.struct(*df.columns))).alias("row")).select("row.*")


def reads(
    spark: SparkSession,
    sf_dir: str,
    where: str = "true",
    varied: bool = False,
    qualities: str = QUALITIES,
    mates: bool = False,
    own_bases: bool = True,
) -> DataFrame:
    """``header, bases, qual`` and the keys; ``varied`` gives lengths from 24 to 64.

    With ``mates`` neighbouring lines of an order are the two mates of a name. Without ``own_bases`` the column
    ``bases`` is not derived, for reads that take theirs from the reference.
    """
    rows = spread(
        table(spark, sf_dir, "lineitem")
        .select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey")
        .where(where)
    )
    size = (24 + F.col("l_partkey") % 41).cast("int")
    cut = (lambda c: F.substring(c, F.lit(1), size)) if varied else (lambda c: c)
    derived = rows.select(
        F.concat(F.lit("@R"), *_name(mates)).alias("header"),
        *([cut(_letters("b", READ_BASES)).alias("bases")] if own_bases else []),
        cut(_letters("q", qualities)).alias("qual"),
        "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey",
    )
    return settled(derived)


def reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    region = F.col("r_regionkey").cast("string")
    part = lambda i: F.md5(F.concat(F.lit("r"), region, F.lit("/"), i.cast("string")))
    parts = F.transform(F.sequence(F.lit(0), F.lit(19)), part)
    return table(spark, sf_dir, "region").select(
        F.concat(F.lit("chr"), (F.col("r_regionkey") + 1).cast("string")).alias("chrom"),
        F.translate(F.array_join(parts, ""), HEX, REF_BASES).alias("seq"),
    )


def alignments(spark: SparkSession, sf_dir: str, where: str = "true") -> DataFrame:
    """Alignments of four CIGAR kinds, with the keys of their read."""
    placed = reads(spark, sf_dir, where, own_bases=False).select(
        F.concat(F.lit("chr"), (1 + F.col("l_suppkey") % 5).cast("string")).alias("chrom"),
        (1 + (F.col("l_partkey") * 7 + F.col("l_linenumber")) % 500).cast("int").alias("pos"),
        (F.col("l_orderkey") % 4).alias("v"),
        "header", "qual", "l_orderkey", "l_linenumber",
    )
    at = lambda off, n: F.substring("seq", F.col("pos") + off, F.lit(n))
    v = F.col("v")
    cigar = F.when(v == 0, "64M").when(v == 1, "30M2I32M").when(v == 2, "30M3D34M").otherwise("4S60M")
    bases = (
        F.when(v == 0, F.concat(at(0, 20), F.translate(at(20, 1), "ACGT", "CGTA"), at(21, 43)))
        .when(v == 1, F.concat(at(0, 30), F.lit("GT"), at(30, 32)))
        .when(v == 2, F.concat(at(0, 30), at(33, 34)))
        .otherwise(F.concat(F.lit("NNNN"), at(0, 60)))
    )
    aligned = placed.join(reference(spark, sf_dir), "chrom").select(
        "header", "chrom", "pos", F.lit(60).alias("mapq"), cigar.alias("cigar"), bases.alias("bases"), "qual",
        "l_orderkey", "l_linenumber",
    )
    return settled(aligned)


def _unplaced(chrom: str = "chrom") -> Column:
    return F.when(F.col("l_orderkey") % 17 == 0, "*").otherwise(F.col(chrom))


def alignment_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Native alignment text; every 17th order is unplaced."""
    fields = [_unplaced(), F.col("pos").cast("string"), F.col("mapq").cast("string"), "cigar", "bases", "qual"]
    return alignments(spark, sf_dir).select(F.concat_ws(" ", *fields).alias("value"))


def sam_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SAM text: one ``@SQ`` per reference row and the alignments, with one optional field."""
    top = reference(spark, sf_dir).select(
        F.explode(
            F.array(
                F.lit("@HD\tVN:1.4\tSO:unsorted"),
                F.concat(F.lit("@SQ\tSN:"), F.col("chrom"), F.lit("\tLN:"), F.length("seq").cast("string")),
            )
        ).alias("value")
    )
    text = lambda c: F.col(c).cast("string")
    fields = [
        F.expr("substring(header, 2)"), F.lit("0"), _unplaced(), text("pos"), text("mapq"), "cigar",
        F.lit("*"), F.lit("0"), F.lit("0"), "bases", "qual",
        F.concat(F.lit("XO:i:"), text("l_orderkey")),
    ]
    body = alignments(spark, sf_dir).select(F.concat_ws("\t", *fields).alias("value"))
    return top.unionByName(settled(body))


def fastq_files(spark: SparkSession, sf_dir: str, where: str = "true", name: str = "fastq") -> str:
    """Derived reads as FASTQ text in the shared folder; some quality lines begin with ``@``."""
    path = fresh_path(spark, name)
    write_fastq(reads(spark, sf_dir, where, varied=True, qualities=AT_QUALITIES), path)
    return path
