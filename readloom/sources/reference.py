"""Reference genome text: one ``chrom seq`` line per chromosome."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Bases of a tile, and how many of the next one an alignment may need.
TILE, OVERLAP = 1 << 12, 1 << 10


def read_reference(spark: SparkSession, path: str) -> DataFrame:
    """``chrom, seq``. The text source ends lines at LF, CR and CRLF alike."""
    parts = F.split("value", " ")
    lines = spark.read.text(path).where(F.contains("value", F.lit(" ")))
    return lines.select(parts[0].alias("chrom"), parts[1].alias("seq"))


def reference_tiles(ref: DataFrame, tile: int = TILE, overlap: int = 0) -> DataFrame:
    """``chrom, tile, tile_seq``: tile t starts at base ``t * tile + 1`` and runs ``overlap``
    bases into the next one. One pass over the sequence cuts all tiles."""
    pattern = f"(?=(.{{1,{tile + overlap}}})).{{1,{tile}}}"
    cut = F.regexp_extract_all("seq", F.lit(pattern), F.lit(1))
    return ref.select("chrom", F.posexplode(cut).alias("tile", "tile_seq"))


def reference_bases(ref: DataFrame, tile: int = TILE) -> DataFrame:
    """``chrom, pos, ref``, one row per base, exploded tile by tile to keep rows small."""
    tiles = reference_tiles(ref, tile)
    bases = tiles.select("chrom", "tile", F.posexplode(F.split("tile_seq", "")).alias("i", "ref"))
    return bases.select("chrom", (F.col("tile") * tile + F.col("i") + 1).alias("pos"), "ref")
