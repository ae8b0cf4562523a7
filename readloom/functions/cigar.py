"""CIGAR strings, under the SAM rules for which operation uses up read and reference bases."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values from the SAM specification.
CIGAR_ITEM = r"(\d+)([MIDNSHPX=])"
USES_READ = ("M", "I", "S", "=", "X")
USES_REF = ("M", "D", "N", "=", "X")
ALIGNED = ("M", "=", "X")

_OP_TYPE = "array<struct<len:int,op:string,read_off:int,ref_off:int>>"


def _lengths(cigar: Column) -> Column:
    return F.transform(F.regexp_extract_all(cigar, F.lit(CIGAR_ITEM), F.lit(1)), lambda n: n.cast("int"))


def _letters(cigar: Column) -> Column:
    return F.regexp_extract_all(cigar, F.lit(CIGAR_ITEM), F.lit(2))


def cigar_items(cigar: Column) -> Column:
    """``array<struct<len, op, read_off, ref_off>>``, offsets counted before each operation.

    Offsets accumulate inside the array of one alignment, so no window and no shuffle is needed.
    """
    start = F.struct(
        F.lit(0).alias("read_at"), F.lit(0).alias("ref_at"), F.array().cast(_OP_TYPE).alias("items")
    )

    def step(acc: Column, item: Column) -> Column:
        here = F.struct(
            item["len"].alias("len"),
            item["op"].alias("op"),
            acc["read_at"].alias("read_off"),
            acc["ref_at"].alias("ref_off"),
        )
        used = lambda ops: F.when(item["op"].isin(*ops), item["len"]).otherwise(0)
        return F.struct(
            (acc["read_at"] + used(USES_READ)).alias("read_at"),
            (acc["ref_at"] + used(USES_REF)).alias("ref_at"),
            F.concat(acc["items"], F.array(here)).alias("items"),
        )

    pairs = F.arrays_zip(_lengths(cigar).alias("len"), _letters(cigar).alias("op"))
    return F.aggregate(pairs, start, step, lambda acc: acc["items"])


def reference_span(cigar: Column) -> Column:
    """Number of reference bases an alignment covers."""
    spans = F.regexp_extract_all(cigar, F.lit(r"(\d+)[MDN=X]"), F.lit(1))
    return F.aggregate(spans, F.lit(0), lambda total, n: total + n.cast("int"))
