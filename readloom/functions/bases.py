"""Base strings and base classes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The base classes that locus counts report, in report order; the rest is N.
CALLED = ("A", "T", "C", "G")


def gc_count(bases: Column) -> Column:
    """Uppercase G and C only."""
    return F.length(bases) - F.length(F.replace(F.replace(bases, F.lit("G")), F.lit("C")))
