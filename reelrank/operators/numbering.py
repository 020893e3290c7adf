"""Positions over a whole frame, without gathering it in one task.

Rows are dealt out by ranges of the order and sorted within each; a row's position is its place in its range
plus the sizes of the ranges before. Only those sizes, one a range, are looked at outside the tasks.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelrank.session import stage

#: The bits of ``monotonically_increasing_id`` that count within a partition.
PLACE_BITS = 33


def numbered(rows: DataFrame, *order: str, pos: str = "i") -> DataFrame:
    """``rows`` with a 0-based position by ``order``, which must be total; null comes first."""
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id()
    # Written once: the ranges come from a sample, and must be the same for sizes and rows.
    placed = stage(
        dealt.withColumns(
            {
                "_range": F.shiftright(place, PLACE_BITS),
                "_place": place.bitwiseAND(F.lit((1 << PLACE_BITS) - 1)),
            }
        ),
        "numbered",
    )
    sizes = sorted(tuple(r) for r in placed.groupBy("_range").count().collect())
    starts = accumulate((n for _, n in sizes), initial=0)
    before = [(which, start) for (which, _), start in zip(sizes, starts, strict=False)]
    # One row for each range.
    offsets = rows.sparkSession.createDataFrame(before, "_range long, _before long")
    return (
        placed.join(F.broadcast(offsets), "_range")
        .withColumn(pos, F.col("_before") + F.col("_place"))
        .drop("_range", "_place", "_before")
    )
