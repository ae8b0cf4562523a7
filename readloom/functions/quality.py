"""Phred quality strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A character below '5' proves Phred+33, one above 'T' proves Phred+64.
PHRED33, PHRED64 = 33, 64
DECISIVE = r"[\x00-\x34\x55-\x7e]"


def phred(ch: Column, offset: int) -> Column:
    return F.ascii(ch) - F.lit(offset)


def phred_array(qual: Column, offset: int) -> Column:
    return F.transform(F.split(qual, ""), lambda ch: phred(ch, offset))


def decides_offset(qual: Column) -> Column:
    """True when some character proves the Phred offset."""
    return F.rlike(qual, F.lit(DECISIVE))


def decisive_offset(qual: Column) -> Column:
    """Phred offset proved by the first decisive character of a string that has one."""
    first = F.regexp_extract(qual, DECISIVE, 0)
    return F.when(first < "5", PHRED33).otherwise(PHRED64)


def _low(offset: int, min_q: int) -> str:
    return rf"\x00-\x{offset + min_q - 1:02x}"


def survives_trim(qual: Column, offset: int, min_q: int, min_len: int, strict_len: bool) -> Column:
    """True when the prefix before the first base below ``min_q`` is long enough.

    A read that is cut needs ``min_len`` good bases. A read without a low base needs one more,
    unless ``strict_len`` asks for the same of both. In other words ``min_len`` good bases have to
    be followed by one more base of any quality, which one anchored pattern tests.
    """
    pattern = f"^[^{_low(offset, min_q)}]{{{max(min_len, 1)}}}"
    if min_len >= 1 and not strict_len:
        pattern += "."
    return F.rlike(qual, F.lit(pattern))


def good_prefix(qual: Column, offset: int, min_q: int) -> Column:
    """The qualities before the first base below ``min_q``."""
    return F.regexp_extract(qual, f"^[^{_low(offset, min_q)}]*", 0)
