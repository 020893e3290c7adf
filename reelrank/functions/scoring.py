"""Linear score and logistic link."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def linear_score(
    features: Sequence[Column], coefficients: Sequence[Column | float], intercept: Column | float
) -> Column:
    total = intercept if isinstance(intercept, Column) else F.lit(float(intercept))
    for feature, weight in zip(features, coefficients, strict=True):
        weight = weight if isinstance(weight, Column) else F.lit(float(weight))
        total = total + feature.cast("double") * weight
    return total


def logistic(x: Column) -> Column:
    """1 / (1 + e^-x): saturates to 0 or 1 instead of overflowing to NaN."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))
