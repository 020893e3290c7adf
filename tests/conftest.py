import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from reelrank.schemas import MOVIES, RATINGS  # noqa: E402
from reelrank.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "reelrank-tests",
        "local[8]",
        **{
            "spark.driver.memory": "8g",
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.showConsoleProgress": "false",
            "spark.log.level": "ERROR",
        },
    )
    yield session
    session.stop()


@pytest.fixture
def ratings(spark):
    """Build a ratings frame from (userId, movieId, rating) or full tuples."""

    def build(rows):
        full = []
        for i, row in enumerate(rows):
            user, movie, rating, *rest = row
            timestamp = rest[0] if rest else f"2024-01-01 00:00:{i % 60:02d}"
            full.append((str(i), user, movie, float(rating), timestamp))
        return spark.createDataFrame(full, RATINGS)

    return build


@pytest.fixture
def movies(spark):
    return spark.createDataFrame(
        [
            (1, "one", [0, 3]),
            (2, "two", [3]),
            (3, "three", []),
            (4, "four", [18]),
        ],
        MOVIES,
    )


def rows(df, *columns):
    """Sorted tuples of the given columns."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
