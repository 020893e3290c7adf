"""Keyed tables: last write wins, and per-metric merges."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelrank.operators.topk import bounded_tail, top_per_group


def latest_by_key(rows: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Newest row per key. Each map task keeps one row per key before the
    shuffle, so a key written very often costs one row per task."""
    return top_per_group(rows, keys, order, 1, pos="_n").drop("_n")


def latest_metrics(
    versions: DataFrame,
    keys: Sequence[str],
    metrics: Sequence[str],
    version: str,
    required: Sequence[str] = ("pos_cnt", "neg_cnt"),
) -> DataFrame:
    """Per key and per metric, the value of the highest version that has one.

    A version that did not emit a metric (null) leaves the older value alone.
    ``max_by`` keeps fixed-width state, so this is a hash aggregation with
    map-side combine. A key needs one of the ``required`` metrics to exist;
    genre ratios never come without a positive count.
    """
    newest = [
        F.expr(f"max_by({m}, IF({m} IS NOT NULL, {version}, NULL)) AS {m}") for m in metrics
    ]
    return versions.groupBy(*keys).agg(*newest).where(any_emitted(required))


def any_emitted(metrics: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, (F.col(m).isNotNull() for m in metrics))


def upsert_metrics(
    old: DataFrame, new: DataFrame, keys: Sequence[str], metrics: Sequence[str]
) -> DataFrame:
    """New values replace old ones metric by metric; both are unique on ``keys``."""
    columns = [*keys, *metrics]
    both = (
        old.select(*columns)
        .withColumn("_v", F.lit(0))
        .unionByName(new.select(*columns).withColumn("_v", F.lit(1)))
    )
    return latest_metrics(both, keys, metrics, "_v")


def replace_lists(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Lists present in ``new`` replace the old list of that key; others stay."""
    return old.join(new.select(key).distinct(), key, "left_anti").unionByName(new)


def append_bounded(
    old: DataFrame, new: DataFrame, order: Sequence[str], size: int
) -> DataFrame:
    """Push ``new`` behind ``old`` and keep the last ``size`` entries."""
    return bounded_tail(old.unionByName(new), order, size)
