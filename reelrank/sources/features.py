"""Reads of feature tables and ordered lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelrank.operators.lookup import default_zero, lookup


def read_default_zero(
    ids: DataFrame, features: DataFrame, key: str, columns: Sequence[str] = ("pos_cnt", "neg_cnt")
) -> DataFrame:
    """Features of the given ids; what was never emitted reads 0.0."""
    return default_zero(lookup(ids, features.select(key, *columns), key), *columns)


def read_ordered(table: DataFrame, start: int = 0, stop: int | None = None) -> DataFrame:
    """Entries ``start`` .. ``stop`` (inclusive) of a list table in order."""
    kept = table.where(F.col("pos") >= start)
    if stop is not None:
        kept = kept.where(F.col("pos") <= stop)
    return kept.orderBy("pos")
