import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import rows
from reelrank.functions.genres import flags_to_genres, genre_mask, masked_sum
from reelrank.functions.polarity import is_negative, is_positive
from reelrank.functions.scoring import logistic
from reelrank.operators.cells import (
    cell_rows,
    explode_cells,
    pivot_cells,
    pivot_cells_as_stored,
    unpivot_cells,
)
from reelrank.schemas import CELL_ROWS, GENRE_FLAGS, MESSAGES
from reelrank.sinks.messages import to_messages, write_envelopes
from reelrank.sinks.tables import stored_ratings, write_keyed_ratings
from reelrank.session import new_path
from reelrank.sources.files import (
    decode_ratings,
    decode_stored,
    movies_from_onehot,
    read_envelopes,
    read_movies_onehot,
    scan_keyed_ratings,
)
from reelrank.sources.streams import kafka_options


@pytest.mark.parametrize(
    "rule, positive, negative",
    [
        ("exact", {1.0}, {0.0}),
        ("else", {1.0}, {0.0, 0.5, 1.5, 2.0, -1.0}),
        ("truncating", {1.0, 1.5}, {0.0, 0.5, 2.0, -1.0}),
    ],
)
def test_polarity_rules(spark, rule, positive, negative):
    values = [0.0, 0.5, 1.0, 1.5, 2.0, -1.0]
    df = spark.createDataFrame([(v,) for v in values], "rating float")
    rating = F.col("rating")
    assert {r[0] for r in df.where(is_positive(rating, rule)).collect()} == positive
    assert {r[0] for r in df.where(is_negative(rating, rule)).collect()} == negative


def test_unknown_polarity_rule():
    with pytest.raises(ValueError):
        is_positive(None, "fuzzy")


def test_genre_masks_and_flags(spark):
    df = spark.createDataFrame([(1, [0, 18]), (2, []), (3, [5])], "id int, genres array<int>")
    masks = df.select("id", genre_mask(F.col("genres")).alias("mask"))
    assert rows(masks) == [(1, 1 | 1 << 18), (2, 0), (3, 32)]
    values = masks.select("id", "mask", *(F.lit(float(g)).alias(f"v{g}") for g in range(18)))
    values = values.withColumn("v18", F.lit(None).cast("double"))
    total = masked_sum([f"v{g}" for g in range(19)])
    assert rows(values.select("id", total)) == [(1, 0.0), (2, 0.0), (3, 5.0)]
    flags = spark.createDataFrame([(1, 0, 1)], "a int, b int, c int")
    picked = flags.select(flags_to_genres([F.col(c) for c in "abc"]))
    assert picked.first()[0] == [0, 2]


def test_logistic_saturates(spark):
    df = spark.createDataFrame([(-1000.0,), (0.0,), (1000.0,)], "x double")
    assert [r[0] for r in df.select(logistic(F.col("x"))).collect()] == [0.0, 0.5, 1.0]


GOOD = '{"userId":"7","movieId":1,"rating":"1","timestamp":12}'
BAD = [
    '{"userId":7,"movieId":1,"rating":1}',
    '{"userId":"x","movieId":1,"rating":1,"timestamp":"t"}',
    "not json",
    None,
]


def messages(spark, values):
    return spark.createDataFrame([(str(i), v) for i, v in enumerate(values)], MESSAGES)


def test_decode_modes(spark):
    df = messages(spark, [GOOD, *BAD])
    assert rows(decode_ratings(df, "drop")) == [("0", 7, 1, 1.0, "12")]
    kept = decode_ratings(df, "quarantine")
    assert [r["key"] for r in kept.where("bad").orderBy("key").collect()] == ["1", "2", "3", "4"]
    assert kept.where("bad AND userId IS NOT NULL").count() == 0
    with pytest.raises(PySparkException):
        decode_ratings(df, "fail").collect()
    assert decode_ratings(messages(spark, [GOOD]), "fail").count() == 1
    with pytest.raises(ValueError):
        decode_ratings(df, "ignore")


@pytest.mark.parametrize("nested", [False, True])
def test_envelope_round_trip(spark, ratings, nested):
    source = ratings([(1, 2, 1.0, 'quote " and \\ slash'), (3, 4, 0.5)])
    path = new_path(spark, "test-envelopes")
    write_envelopes(source, path, nested)
    assert rows(read_envelopes(spark, path, "fail")) == rows(source)


def test_messages_round_trip(ratings):
    source = ratings([(1, 2, 1.5), (3, 4, 0.0)])
    assert rows(decode_ratings(to_messages(source), "fail")) == rows(source)


def test_keyed_table_round_trip(spark, ratings):
    source = ratings([(1, 2, 1.0), (3, 4, 0.0)])
    path = new_path(spark, "test-keyed")
    write_keyed_ratings(source, path)
    assert rows(scan_keyed_ratings(spark, path)) == rows(source)
    stored = stored_ratings(source).withColumn("userId", F.lit("Null"))
    with pytest.raises(PySparkException):
        decode_stored(stored).collect()
    assert {r["userId"] for r in decode_stored(stored, strict=False).collect()} == {None}


def test_onehot_csv_quotes_titles(spark):
    path = new_path(spark, "test-csv")
    header = ",".join(["movieId", "title", "a", "b", *GENRE_FLAGS])
    flags = ["0"] * 19
    flags[2] = flags[18] = "1"
    line = ",".join(["5", '"Good, Bad"', "x", "y", *flags])
    spark.createDataFrame([(header + "\n" + line,)], "value string").coalesce(1).write.text(path)
    got = movies_from_onehot(read_movies_onehot(spark, path)).collect()
    assert [tuple(r) for r in got] == [(5, "Good, Bad", [2, 18])]


def test_cells(spark, ratings):
    source = ratings([(1, 2, 1.0, "t0"), (3, 4, 0.0, "t1")])
    gaps = source.withColumn("rating", F.when(F.col("userId") == 1, F.col("rating")))
    text = cell_rows(gaps)
    assert explode_cells(text).count() == 7
    columns = ["row_key", "movieId", "rating", "timestamp", "userId"]
    assert rows(pivot_cells(text), *columns) == [
        ("0", "2", "1.0", "t0", "1"),
        ("1", "4", None, "t1", "3"),
    ]
    assert rows(pivot_cells_as_stored(text), *columns)[1] == ("1", "4", "Null", "t1", "3")
    cells = rows(unpivot_cells(source))
    assert len(cells) == 8 and ("0", "details:rating", "1.0") in cells
    empty = spark.createDataFrame([("k", "")], CELL_ROWS)
    assert rows(pivot_cells(empty)) == [("k", None, None, None, None)]


def test_kafka_options():
    options = kafka_options("host:9092", "topic", "earliest")
    assert options["startingOffsets"] == "earliest" and options["subscribe"] == "topic"
    with pytest.raises(ValueError):
        kafka_options("host:9092", "topic", "middle")
