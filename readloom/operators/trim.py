"""Quality trim."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.functions.quality import good_prefix, survives_trim


def trim_reads(
    reads: DataFrame, offset: int = 33, min_q: int = 20, min_len: int = 30, strict_len: bool = False
) -> DataFrame:
    """Cut each read at its first base below ``min_q``; drop reads left too short.

    A narrow projection and filter. By default a read without any low base must be one base
    longer than ``min_len``; ``strict_len=True`` uses ``min_len`` for both.
    """
    survivors = reads.where(survives_trim(F.col("qual"), offset, min_q, min_len, strict_len))
    kept = F.length(good_prefix(F.col("qual"), offset, min_q))
    cut = lambda text: F.substring(F.col(text), F.lit(1), kept)
    return survivors.withColumns({"bases": cut("bases"), "qual": cut("qual"), "kept_len": kept})
