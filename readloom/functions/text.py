"""Number formats of the text report."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: two decimals, HALF_EVEN, no leading zero.
TWO_DECIMALS = "#.00"


def two_decimals(x: Column) -> Column:
    return F.call_function("format_number", x, F.lit(TWO_DECIMALS))


def rounded(x: Column) -> Column:
    """The double that ``two_decimals`` prints."""
    return two_decimals(x).cast("double")


def basename(path: Column) -> Column:
    return F.regexp_extract(path, "[^/]*$", 0)
