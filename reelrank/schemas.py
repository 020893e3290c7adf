"""Row shapes of every table the engine reads or writes.

Schemas are always stated, never inferred.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Genre id (list position) -> name.
GENRE_NAMES = [
    "Documentary",
    "Mystery",
    "Fantasy",
    "Action",
    "Children",
    "Comedy",
    "Film-Noir",
    "Adventure",
    "Drama",
    "Thriller",
    "Musical",
    "War",
    "IMAX",
    "Animation",
    "Romance",
    "Western",
    "Sci-Fi",
    "Crime",
    "Horror",
]
NUM_GENRES = len(GENRE_NAMES)

# List bounds, topic and missing-cell marker.
RECENT_SIZE = 200
POPULAR_SIZE = 30
TOP_K = 10
TOPIC = "movie_rating_records"
MISSING_CELL = "Null"

# The four stored columns of a keyed rating row, in stored order.
CELL_COLUMNS = ["movieId", "rating", "timestamp", "userId"]
CELL_FAMILY = "details"

FEATURE_COLUMNS = [f"f{i}" for i in range(10)]

SCOPES = ("batch", "streaming")

RATING_BODY = T.StructType(
    [
        T.StructField("userId", T.IntegerType()),
        T.StructField("movieId", T.IntegerType()),
        T.StructField("rating", T.FloatType()),
        T.StructField("timestamp", T.StringType()),
    ]
)

RATINGS = T.StructType([T.StructField("key", T.StringType()), *RATING_BODY.fields])

MESSAGES = T.StructType(
    [T.StructField("key", T.StringType()), T.StructField("value", T.StringType())]
)

# ``body`` is declared a string: from_json then accepts both a JSON string and
# a nested object (which it hands over as its JSON text).
ENVELOPE = T.StructType(
    [
        T.StructField("headers", T.StructType([T.StructField("key", T.StringType())])),
        T.StructField("body", T.StringType()),
    ]
)

CELL = T.StructType(
    [T.StructField("qualifier", T.StringType()), T.StructField("value", T.StringType())]
)

CELL_ROWS = T.StructType(
    [T.StructField("row_key", T.StringType()), T.StructField("value", T.StringType())]
)

STORED_RATINGS = T.StructType(
    [T.StructField("key", T.StringType())]
    + [T.StructField(c, T.StringType()) for c in CELL_COLUMNS]
)

MOVIES = T.StructType(
    [
        T.StructField("movieId", T.IntegerType()),
        T.StructField("title", T.StringType()),
        T.StructField("genres", T.ArrayType(T.IntegerType())),
    ]
)

GENRE_FLAGS = [f"g{i}" for i in range(NUM_GENRES)]

MOVIES_ONEHOT = T.StructType(
    [
        T.StructField("movieId", T.IntegerType()),
        T.StructField("title", T.StringType()),
        T.StructField("unused1", T.StringType()),
        T.StructField("unused2", T.StringType()),
    ]
    + [T.StructField(g, T.IntegerType()) for g in GENRE_FLAGS]
)

GENRES = T.StructType(
    [T.StructField("genreId", T.IntegerType()), T.StructField("name", T.StringType())]
)

MODEL_PARAMS = T.StructType(
    [T.StructField("idx", T.IntegerType()), T.StructField("coefficient", T.DoubleType())]
)
INTERCEPT_IDX = -1
