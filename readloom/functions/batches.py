"""Alignments of an Arrow batch as arrays: rows of one CIGAR and equal lengths go together."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from readloom.functions.cigar import CIGAR_ITEM, USES_READ, USES_REF


def cigar_steps(cigar: str) -> Iterator[tuple[str, int, int, int]]:
    """``op, len, read_off, ref_off`` of each operation, as ``cigar_items`` has them."""
    read_at = ref_at = 0
    for size, op in re.findall(CIGAR_ITEM, cigar):
        n = int(size)
        yield op, n, read_at, ref_at
        read_at += n if op in USES_READ else 0
        ref_at += n if op in USES_REF else 0


def single_bytes(texts: pa.Array) -> pa.Array:
    """Texts with DEL for each character that is not ASCII, so that a byte is a character."""
    if pc.all(pc.string_is_ascii(texts)).as_py() is False:
        return pc.replace_substring_regex(texts, "[^\\x00-\\x7F]", "\x7f")
    return texts


def codes(texts: pa.Array, width: int) -> np.ndarray:
    """Characters of equally long strings as a (rows, width) array."""
    data = texts.buffers()[2]
    flat = np.frombuffer(data, np.uint8) if len(texts) and data is not None else np.empty(0, np.uint8)
    first = texts.offset * width
    return flat[first : first + len(texts) * width].reshape(len(texts), width)


def alike(cigars: pa.Array, *numbers: np.ndarray) -> Iterator[tuple[str, np.ndarray]]:
    """Each CIGAR with the rows that have it and agree in all ``numbers``; rows without a CIGAR are left out."""
    known = cigars.dictionary_encode()
    key = pc.fill_null(known.indices, -1).to_numpy(zero_copy_only=False)
    place = np.lexsort((*numbers, key))
    sides = [x[place] for x in (key, *numbers)]
    new = np.flatnonzero(np.any([x[1:] != x[:-1] for x in sides], axis=0)) + 1
    for rows in np.split(place, new):
        if len(rows) and key[rows[0]] >= 0:
            yield known.dictionary[int(key[rows[0]])].as_py(), rows
