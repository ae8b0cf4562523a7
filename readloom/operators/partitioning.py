"""Placement of rows by an integer key."""

from __future__ import annotations

from pyspark.sql import DataFrame


def partition_by_id(df: DataFrame, n: int, col: str) -> DataFrame:
    """Row with key k goes to partition k modulo n; a null key goes to partition 0."""
    return df.repartitionById(n, col)
