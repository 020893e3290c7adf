"""Features and models as stored tables, which training and serving read.

Feature tables are keyed: new metrics replace old ones user by user, and a reader of some users opens their
buckets only. A model is a set of parameter rows under a version; which version is in use is a table of
its own, so a release or a way back is one commit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelrank.operators.upsert import upsert_metrics
from reelrank.plans import serving
from reelrank.plans.feature_tables import FeatureTables
from reelrank.schemas import TOP_K
from reelrank.streaming.live import Append, LiveTables, Replace, Upsert

MODELS, IN_USE = "models", "model_in_use"


def metrics_change(rows: DataFrame, key: str) -> Upsert:
    """Metrics by key; those that are null leave the stored ones alone."""
    metrics = [c for c in rows.columns if c != key]
    return Upsert(rows, key, lambda old, new: upsert_metrics(old, new, [key], metrics))


def store_features(
    tables: LiveTables, run: str, version: int, scopes: dict[str, FeatureTables]
) -> None:
    """Users and movies of all scopes, in one commit."""
    changes = {}
    for scope, features in scopes.items():
        changes[f"{scope}_users"] = metrics_change(features.users, "userId")
        changes[f"{scope}_movies"] = metrics_change(features.movies, "movieId")
    tables.commit(run, version, changes)


def features_of(
    tables: LiveTables,
    scope: str,
    users: DataFrame | None = None,
    movies: DataFrame | None = None,
) -> FeatureTables:
    """Stored features, of all ids or of those in the one column of ``users`` and ``movies``."""

    def part(name: str, ids: DataFrame | None) -> DataFrame:
        found = tables.read(name) if ids is None else tables.read_keys(name, ids)
        if found is None:
            raise ValueError(f"nothing is stored under {name!r}")
        return found

    return FeatureTables(part(f"{scope}_users", users), part(f"{scope}_movies", movies))


def publish_model(tables: LiveTables, run: str, version: int, params: DataFrame) -> None:
    """Stores the parameters (idx, coefficient) under ``version`` and takes them into use."""
    rows = params.select(F.lit(version).alias("version"), "idx", "coefficient").coalesce(1)
    tables.commit(
        run,
        version,
        {MODELS: Append(rows, lambda kept: kept), IN_USE: Replace(lambda _: _version(tables, version))},
    )


def use_model(tables: LiveTables, run: str, step: int, version: int) -> None:
    """Takes a stored version into use again; ``step`` numbers the switches of ``run``."""
    stored = tables.read(MODELS)
    if stored is None or stored.where(F.col("version") == version).isEmpty():
        raise ValueError(f"there is no model of version {version}")
    tables.commit(run, step, {IN_USE: Replace(lambda _: _version(tables, version))})


def _version(tables: LiveTables, version: int) -> DataFrame:
    return tables.spark.range(1).select(F.lit(version).alias("version"))


def params_of(tables: LiveTables, version: int | None = None) -> DataFrame:
    """(idx, coefficient) of a version, by default of the one in use."""
    pointer = tables.pointer()
    if IN_USE not in pointer.tables:
        raise ValueError("no model was published")
    if version is None:
        version = tables.read(IN_USE, pointer).first()["version"]
    rows = tables.read(MODELS, pointer).where(F.col("version") == version)
    return rows.select("idx", "coefficient")


def recommend_for(
    tables: LiveTables,
    requests: DataFrame,
    movies: DataFrame,
    popular: DataFrame,
    hot: DataFrame,
    version: int | None = None,
    k: int = TOP_K,
) -> DataFrame:
    """Titles for the requested users (userId), by the stored features and model.

    A user who is asked for several times gets one answer, one without features the popular list and
    the first genre's; a request without an id gets none.
    """
    users = requests.select("userId").where("userId IS NOT NULL").distinct()
    listed = popular.select("movieId").union(hot.select("movieId")).distinct()
    weights, intercept = serving.param_columns(params_of(tables, version))
    return serving.recommend(
        popular,
        hot,
        movies,
        features_of(tables, "batch", users, listed),
        features_of(tables, "streaming", users, listed),
        weights,
        intercept,
        users,
        k,
    )
