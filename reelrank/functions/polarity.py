"""When a rating counts as positive or as negative.

Three rules are in use:

* ``exact``: 1.0 is positive, 0.0 is negative, anything else counts as neither;
* ``else``: 1.0 is positive, anything else is negative;
* ``truncating``: the rating is cut to an integer first, so 1.5 is positive
  and everything that does not cut to 1 is negative.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RULES = ("exact", "else", "truncating")


def is_positive(rating: Column, rule: str = "exact") -> Column:
    if rule == "truncating":
        return rating.cast("float").cast("int") == 1
    if rule in RULES:
        return rating == F.lit(1.0)
    raise ValueError(f"unknown polarity rule {rule!r}, expected one of {RULES}")


def is_negative(rating: Column, rule: str = "exact") -> Column:
    if rule == "exact":
        return rating == F.lit(0.0)
    return ~is_positive(rating, rule)


def emitted(count: Column) -> Column:
    """A count as stored: zero means the metric was never emitted."""
    return F.nullif(count, F.lit(0))


def pos_count(rating: Column, rule: str = "exact") -> Column:
    return emitted(F.count_if(is_positive(rating, rule)))


def neg_count(rating: Column, rule: str = "exact") -> Column:
    return emitted(F.count_if(is_negative(rating, rule)))
