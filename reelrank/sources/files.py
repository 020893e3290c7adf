"""File sources: envelopes, one-hot movies, keyed ratings, cell rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelrank import schemas
from reelrank.functions.genres import flags_to_genres
from reelrank.functions.messages import parse_body, parse_envelope, parse_once

ON_BAD = ("fail", "drop", "quarantine")


def decode_ratings(messages: DataFrame, on_bad: str = "fail") -> DataFrame:
    """(key, value JSON) -> typed ratings.

    A message is bad when its JSON does not parse or a field is missing or
    mistyped. ``fail`` raises on it, as no message may vanish unasked; ``quarantine``
    keeps it with ``bad`` true and its text in ``value``; ``drop`` skips it.
    """
    if on_bad not in ON_BAD:
        raise ValueError(f"unknown on_bad {on_bad!r}, expected one of {ON_BAD}")
    fields = schemas.RATING_BODY.fields
    rest = [c for c in messages.columns if c not in ("key", "value")]
    typed = (
        parse_once(messages, parse_body(F.col("value")), "body")
        .select(
            "key",
            *(F.col(f"body.{f.name}").try_cast(f.dataType).alias(f.name) for f in fields),
            "value",
            *rest,
        )
        .withColumn("bad", F.expr(" OR ".join(f"{f.name} IS NULL" for f in fields)))
    )
    if on_bad == "quarantine":
        return typed.withColumns(
            {f.name: F.when(~F.col("bad"), F.col(f.name)) for f in fields}
        )
    if on_bad == "fail":
        message = F.concat(F.lit("malformed rating message: "), F.coalesce("value", F.lit("null")))
        typed = typed.where(F.when(F.col("bad"), F.raise_error(message)).otherwise(F.lit(True)))
    else:
        typed = typed.where(~F.col("bad"))
    return typed.drop("value", "bad")


def open_envelopes(lines: DataFrame) -> DataFrame:
    """JSON lines -> (key, value); the body may be a JSON string or an object."""
    envelopes = parse_once(lines, parse_envelope(F.col("value")), "envelope")
    return envelopes.select(
        F.col("envelope.headers.key").alias("key"), F.col("envelope.body").alias("value")
    )


def read_envelopes(
    spark: SparkSession, path: str, on_bad: str = "fail"
) -> DataFrame:
    """Envelope file -> typed ratings."""
    return decode_ratings(open_envelopes(spark.read.text(path)), on_bad)


def read_movies_onehot(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV: id, title, two unused columns, then one flag per genre.

    The header says how many flags there are; flags are whole numbers in any notation.
    Rows that don't fit, and flags that are no numbers, raise.
    """
    read = spark.read.option("header", True).option("mode", "FAILFAST")
    count = len(read.csv(path).columns)
    fixed = schemas.MOVIES_ONEHOT.fieldNames()[:4]
    flags = [f"g{i}" for i in range(max(count - len(fixed), len(schemas.GENRE_FLAGS)))]
    names = [*fixed, *flags]
    text = read.csv(path, schema=", ".join(f"`{c}` string" for c in names[:count]))
    return text.select(
        F.col("movieId").cast("int").alias("movieId"),
        *fixed[1:],
        *(
            (F.col(g).cast("double") if g in text.columns else F.lit(None)).cast("int").alias(g)
            for g in flags
        ),
    )


def movies_from_onehot(onehot: DataFrame) -> DataFrame:
    flags = [F.col(c) for c in onehot.columns[4:]]
    return onehot.select("movieId", "title", flags_to_genres(flags).alias("genres"))


def read_movies(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.MOVIES).parquet(path)


def scan_keyed_ratings(spark: SparkSession, path: str) -> DataFrame:
    """Full scan of the keyed rating table, typed.

    Columns are stored as text; only those a query uses are read.
    """
    return decode_stored(spark.read.schema(schemas.STORED_RATINGS).parquet(path))


def decode_stored(stored: DataFrame, binary: bool = False, strict: bool = True) -> DataFrame:
    """Text (or UTF-8 bytes) columns -> typed ratings.

    ``strict`` raises on text that is no number; otherwise it reads as null.
    """

    def text(name: str):
        return F.decode(name, "UTF-8") if binary else F.col(name)

    def number(name: str, to: str):
        return text(name).cast(to) if strict else text(name).try_cast(to)

    return stored.select(
        text("key").alias("key"),
        number("userId", "int").alias("userId"),
        number("movieId", "int").alias("movieId"),
        number("rating", "float").alias("rating"),
        text("timestamp").alias("timestamp"),
    )


def read_cell_rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.CELL_ROWS).parquet(path)
