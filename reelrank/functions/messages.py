"""JSON text of rating messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelrank.schemas import CELL, ENVELOPE, RATING_BODY


def parse_once(df: DataFrame, parsed: Column, name: str) -> DataFrame:
    """Adds a parsed struct as a generated column.

    A plain computed column would be inlined into every filter and field
    access above it, parsing the same text again each time; optimizer rules do
    not move expressions across a generator.
    """
    return df.select("*", F.explode(F.array(parsed)).alias(name))


def parse_body(text: Column) -> Column:
    """Rating body; every field is read as text first, so numbers may be quoted."""
    as_text = ", ".join(f"{f.name} string" for f in RATING_BODY.fields)
    return F.from_json(text, as_text)


def parse_envelope(line: Column) -> Column:
    return F.from_json(line, ENVELOPE)


def parse_cell(text: Column) -> Column:
    return F.from_json(text, CELL)


def body_json(user: Column, movie: Column, rating: Column, timestamp: Column) -> Column:
    """Message body with typed numbers."""
    return F.to_json(
        F.struct(
            user.alias("userId"),
            movie.alias("movieId"),
            rating.alias("rating"),
            timestamp.alias("timestamp"),
        )
    )


def record_json(user: Column, movie: Column, rating: Column, timestamp: Column) -> Column:
    """Buffered record: the four fields as text, without the message key."""
    return body_json(*(c.cast("string") for c in (user, movie, rating, timestamp)))
