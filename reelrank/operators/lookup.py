"""Key lookups.

``lookup`` gives no broadcast hint: Catalyst broadcasts the table only while
its size is below ``spark.sql.autoBroadcastJoinThreshold`` (checked from file
statistics and again by AQE from real shuffle sizes) and otherwise sort-merges,
where AQE splits hot keys.

``bounded_lookup`` is for few ids (those of a 200-record buffer, of the at most
220 hot movies). The big table is first cut to the ids by a semi join, so with
a broadcast it is scanned but never shuffled, and what is left is as small as
the ids. The hint is given only after the ids were counted; a larger set gets
none and Catalyst shuffles both sides.

``of_ids`` is for tables that are looked up again and again, once a micro-batch.
File statistics say nothing about rows: a well compressed table of millions is
below the threshold, and each lookup would gather all of it on the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 10_000


def lookup(df: DataFrame, table: DataFrame, *keys: str, how: str = "left") -> DataFrame:
    return df.join(table, list(keys), how)


@dataclass(frozen=True)
class IdSet:
    """Distinct ids of one key column; ``small`` if counted within the bound."""

    key: str
    frame: DataFrame
    small: bool

    @classmethod
    def of(cls, df: DataFrame, key: str, bound: int = BROADCAST_ROWS) -> IdSet:
        """Counts the ids, so ``df`` should be a stored or otherwise cheap frame."""
        frame = df.select(key).distinct()
        return cls(key, frame, frame.limit(bound + 1).count() <= bound)

    @classmethod
    def counted(cls, df: DataFrame, key: str, ids: int, bound: int = BROADCAST_ROWS) -> IdSet:
        """For a frame whose number of distinct ids is known."""
        return cls(key, df.select(key).distinct(), ids <= bound)

    def hint(self, df: DataFrame) -> DataFrame:
        """Broadcast hint for a frame with at most one row per id."""
        return F.broadcast(df) if self.small else df

    def keys(self) -> DataFrame:
        return self.hint(self.frame)


def only_keys(table: DataFrame, ids: IdSet) -> DataFrame:
    """Rows of ``table`` whose key is among the ids."""
    return table.join(ids.keys(), ids.key, "left_semi")


def bounded_lookup(df: DataFrame, table: DataFrame, ids: IdSet) -> DataFrame:
    """Left join to a table that is unique on the key; ``ids`` are those of ``df``.

    They are given separately so that chained lookups cut every table by the
    same small frame instead of by the joins made so far.
    """
    return df.join(ids.hint(only_keys(table, ids)), ids.key, "left")


def of_ids(table: DataFrame, ids: IdSet) -> DataFrame:
    """``table`` as the right side of a ``lookup`` for a frame whose ids are ``ids``.

    It is never broadcast whole: few ids cut it first, for more of them both
    sides are shuffled, whatever size Catalyst takes it for.
    """
    return ids.hint(only_keys(table, ids)) if ids.small else table.hint("merge")


def default_zero(df: DataFrame, *columns: str) -> DataFrame:
    """Absent features read as 0.0."""
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns})
