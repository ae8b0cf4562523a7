"""SAM text: ``@`` header lines, then tab-separated alignments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The eleven mandatory fields of the SAM format, in order.
SAM_FIELDS = {
    "qname": "string",
    "flag": "int",
    "rname": "string",
    "pos": "int",
    "mapq": "int",
    "cigar": "string",
    "rnext": "string",
    "pnext": "int",
    "tlen": "int",
    "seq": "string",
    "qual": "string",
}


def _is_header():
    return F.startswith(F.col("value"), F.lit("@"))


def read_sam(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(header lines, alignments) of SAM text."""
    lines = spark.read.text(path)
    return sam_header(lines), parse_sam(lines)


def sam_header(lines: DataFrame) -> DataFrame:
    """``line, tag`` of the header lines of a ``value`` column."""
    return lines.where(_is_header()).select(
        F.col("value").alias("line"), F.substring_index("value", "\t", 1).alias("tag")
    )


def parse_sam(lines: DataFrame) -> DataFrame:
    """Typed alignments of a ``value`` column; optional fields end up in ``tags``."""
    parts = F.split("value", "\t")
    fields = [
        (parts[i] if kind == "string" else parts[i].try_cast(kind)).alias(name)
        for i, (name, kind) in enumerate(SAM_FIELDS.items())
    ]
    tags = F.slice(parts, len(fields) + 1, F.greatest(F.size(parts) - len(fields), F.lit(0)))
    return lines.where(~_is_header()).select(*fields, tags.alias("tags"))
