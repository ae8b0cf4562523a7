"""Read names and mate numbers from FASTQ headers (``@id/1``, ``@id_1``, ``@id 1:N:0:X``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The separators a header may use, in the order they are looked for.
UNDERLINE, SLASH, SPACE = "_", "/", " "


def header_sep(header: Column) -> Column:
    return (
        F.when(F.contains(header, F.lit(UNDERLINE)), UNDERLINE)
        .when(F.contains(header, F.lit(SLASH)), SLASH)
        .otherwise(SPACE)
    )


def _per_sep(header: Column, sep: str | None, pick) -> Column:
    """Apply ``pick(sep)`` with a file-wide separator, or with the one each header uses."""
    if sep is not None:
        return pick(sep)
    return (
        F.when(F.contains(header, F.lit(UNDERLINE)), pick(UNDERLINE))
        .when(F.contains(header, F.lit(SLASH)), pick(SLASH))
        .otherwise(pick(SPACE))
    )


def read_name(header: Column, sep: str | None = None) -> Column:
    return _per_sep(header, sep, lambda s: F.substring_index(header, s, 1))


def mate_number(header: Column, sep: str | None = None) -> Column:
    """The digit right after the first separator; null when there is none."""
    after = _per_sep(header, sep, lambda s: F.split_part(header, F.lit(s), F.lit(2)))
    return F.substring(after, 1, 1).try_cast("int")
