"""Read names, mate pairing and interleaving."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.functions.headers import header_sep, mate_number, read_name

PAIR_COLUMNS = ["read_name", "header1", "bases1", "qual1", "header2", "bases2", "qual2"]
_RECORD = ["header", "bases", "qual"]


def with_read_keys(reads: DataFrame, sep: str | None = None) -> DataFrame:
    """Add ``read_name`` and ``mate``; ``sep`` fixes the separator, else each header decides."""
    header = F.col("header")
    return reads.withColumns({"read_name": read_name(header, sep), "mate": mate_number(header, sep)})


def header_separator(reads: DataFrame, *order: str) -> DataFrame:
    """One row ``sep``: the separator in the header of the first read under ``order``."""
    first = F.min_by("header", F.struct(*order)) if order else F.first("header")
    return reads.agg(first.alias("header")).select(header_sep(F.col("header")).alias("sep"))


def reads_union(first: DataFrame, second: DataFrame) -> DataFrame:
    return first.unionByName(second)


def reads_per_name(reads: DataFrame, sep: str | None = None) -> DataFrame:
    return with_read_keys(reads, sep).groupBy("read_name").agg(F.count("*").alias("n"))


def pair_mates(
    first: DataFrame, second: DataFrame | None = None, method: str = "group", sep: str | None = None
) -> DataFrame:
    """Pairs of mate 1 and mate 2.

    ``group`` keeps names that occur exactly twice over both inputs, once as each mate. It
    aggregates before it shuffles, so a name with very many reads shrinks to one row per task.
    ``join`` takes mate 1 from the first input and mate 2 from the second and multiplies repeated
    names; adaptive skew-join handling splits a hot name.
    """
    if method == "group":
        reads = first if second is None else reads_union(first.select(*_RECORD), second.select(*_RECORD))
        return _grouped(reads, sep)
    if method == "join":
        return _joined(first, first if second is None else second, sep)
    raise ValueError(f"unknown pairing method: {method}")


def _grouped(reads: DataFrame, sep: str | None) -> DataFrame:
    record = F.struct(*_RECORD)
    mate = lambda m: F.max(F.when(F.col("mate") == m, record)).alias(f"m{m}")
    groups = (
        with_read_keys(reads.select(*_RECORD), sep)
        .groupBy("read_name")
        .agg(F.count("*").alias("n"), mate(1), mate(2))
    )
    pairs = groups.where((F.col("n") == 2) & F.col("m1").isNotNull() & F.col("m2").isNotNull())
    fields = [F.col(f"m{m}.{name}").alias(f"{name}{m}") for m in (1, 2) for name in _RECORD]
    return pairs.select("read_name", *fields)


def _joined(first: DataFrame, second: DataFrame, sep: str | None) -> DataFrame:
    def side(reads: DataFrame, mate: int) -> DataFrame:
        keyed = with_read_keys(reads.select(*_RECORD), sep).where(F.col("mate") == mate)
        return keyed.select("read_name", *[F.col(c).alias(f"{c}{mate}") for c in _RECORD])

    return side(first, 1).join(side(second, 2), "read_name").select(*PAIR_COLUMNS)


def fastq_text(header: str, bases: str, qual: str):
    return F.concat_ws("\n", F.col(header), F.col(bases), F.lit("+"), F.col(qual))


def interleave(pairs: DataFrame) -> DataFrame:
    """``read_name, value``: both mates as FASTQ text, mate 1 first."""
    both = [fastq_text(f"header{m}", f"bases{m}", f"qual{m}") for m in (1, 2)]
    return pairs.select("read_name", F.concat_ws("\n", *both).alias("value"))


def fastq_compare(first: DataFrame, second: DataFrame) -> DataFrame:
    """One row: reads in each input, and reads of the first that the second also holds.

    Both inputs are counted per distinct record in one aggregation, so copies collapse before
    the shuffle and no join is needed.
    """
    tagged = first.select(*_RECORD, F.lit(1).alias("a"), F.lit(0).alias("b")).unionByName(
        second.select(*_RECORD, F.lit(0).alias("a"), F.lit(1).alias("b"))
    )
    counts = tagged.groupBy(*_RECORD).agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return counts.agg(
        total("a").alias("reads_first"),
        total("b").alias("reads_second"),
        total(F.when(F.col("b") > 0, F.col("a"))).alias("reads_common"),
    )
