"""Inputs that must not be lost silently: genre ids, flags, messages, days, arrival order."""

import os
import shutil

import duckdb
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import rows
from reelrank.catalog import ORACLES, QUERIES
from reelrank.catalog.registry import Inputs
from reelrank.functions.genres import genre_mask
from reelrank.plans.serving import param_columns
from reelrank.session import new_path
from reelrank.sources.files import decode_ratings, movies_from_onehot, read_movies_onehot
from reelrank.schemas import MESSAGES
from reelrank.sinks.messages import publish_files
from reelrank.sources.streams import file_messages
from reelrank.streaming.jobs import BAD, ratings_of, start
from reelrank.streaming.live import Append, LiveTables, Replace
from reelrank.streaming.outputs import all_rows, kept_rows

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("genre", [19, 32, -1])
def test_genre_ids_outside_the_domain_raise(spark, genre):
    df = spark.createDataFrame([([0, genre],)], "genres array<int>")
    with pytest.raises(PySparkException, match=f"{genre}"):
        df.select(genre_mask(F.col("genres"))).collect()


def write_csv(spark, lines):
    path = new_path(spark, "test-csv")
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    return path


def test_flags_in_any_notation(spark):
    head = "id,title,a,b," + ",".join(f"f{i}" for i in range(19))
    body = ["1,one,x,y," + ",".join("1.0" if i in (0, 18) else "0" for i in range(19))]
    movies = movies_from_onehot(read_movies_onehot(spark, write_csv(spark, [head, *body])))
    assert rows(movies) == [(1, "one", [0, 18])]


def test_a_twentieth_flag_is_not_cut_off(spark):
    head = "id,title,a,b," + ",".join(f"f{i}" for i in range(20))
    clear, set_flag = "1,one,x,y" + ",0" * 20, "2,two,x,y" + ",0" * 19 + ",1"
    fine = movies_from_onehot(read_movies_onehot(spark, write_csv(spark, [head, clear])))
    assert rows(fine) == [(1, "one", [])]
    with pytest.raises(PySparkException, match="19"):
        movies_from_onehot(read_movies_onehot(spark, write_csv(spark, [head, set_flag]))).collect()


def test_malformed_messages_raise_by_default(spark):
    df = spark.createDataFrame([("1", "{")], '`key` string, value string')
    with pytest.raises(PySparkException, match="malformed"):
        decode_ratings(df).collect()


def test_arrival_order_of_epochs_and_any_key(spark):
    body = '{{"userId": "1", "movieId": "2", "rating": "1.0", "timestamp": "{}"}}'
    stamps = ["1704067200", "1704067200500", "2024-01-01 00:00:01", "never"]
    df = spark.createDataFrame(
        [(f"7-{k}", body.format(t)) for k, t in enumerate(stamps)], "`key` string, value string"
    )
    got = {r["key"]: r for r in ratings_of(df).collect()}
    assert [str(got[f"7-{k}"]["ts"]) for k in range(4)] == [
        "2024-01-01 00:00:00",
        "2024-01-01 00:00:00.500000",
        "2024-01-01 00:00:01",
        "1970-01-01 00:00:00",
    ]
    assert len({r["seq"] for r in got.values()}) == 4 and None not in {
        r["seq"] for r in got.values()
    }


def test_missing_parameters_raise(spark):
    full = [(i, float(i)) for i in range(-1, 10)]
    for params in (full[:-1], full + [(3, 1.0)]):
        df = spark.createDataFrame(params, "idx int, coefficient double")
        with pytest.raises(Exception, match="idx"):
            weights, intercept = param_columns(df)
            spark.range(1).select(*weights, intercept).collect()


def test_reopened_state_reads_its_files(spark):
    root = new_path(spark, "test-state")
    df = spark.createDataFrame([(1, "a")], "id int, name string")
    both = {"log": Append(df, all_rows), "list": Replace(lambda old: df)}
    LiveTables(spark, root).commit("run", 0, both)
    for name in both:
        assert rows(LiveTables(spark, root).read(name), "id", "name") == [(1, "a")]


@pytest.fixture(scope="module")
def shifted(tmp_path_factory):
    """The test tables, half of the events forty days later: a gap, and days beyond a month."""
    folder = tmp_path_factory.mktemp("shifted")
    for name in os.listdir(SF):
        if name != "events.parquet":
            shutil.copy(f"{SF}/{name}", folder)
    duckdb.sql(
        f"COPY (SELECT * REPLACE (CASE WHEN event_id % 2 = 0 THEN ts + INTERVAL 40 DAY ELSE ts END "
        f"AS ts) FROM '{SF}/events.parquet') TO '{folder}/events.parquet' (FORMAT parquet)"
    )
    return str(folder)


@pytest.mark.parametrize("name", ["stream_recent_buffer", "stream_popular", "stream_genre_hot", "microbatch_feature_counts"])
def test_streams_of_any_days(spark, shifted, name):
    connection = duckdb.connect()
    for table in ("events", "part"):
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{shifted}/{table}.parquet'")
    want = connection.sql(ORACLES[name])
    got = QUERIES[name](spark, shifted).select(*want.columns)
    plain = lambda found: sorted(tuple(map(str, r)) for r in found)
    assert plain(got.collect()) == plain(want.fetchall())


def test_stream_keeps_malformed_messages_apart(spark):
    root = new_path(spark, "test-bad")
    body = '{"userId": "1", "movieId": "2", "rating": "1.0", "timestamp": "2024-01-01 00:00:01"}'
    messages = spark.createDataFrame([("1", body), ("2", "{oops")], MESSAGES)
    publish_files(messages, f"{root}/topic")
    tables = LiveTables(spark, f"{root}/tables")
    source = ratings_of(file_messages(spark, f"{root}/topic"))
    keep = {"ratings": kept_rows("key", "userId")}
    start(source, keep, tables, f"{root}/checkpoint", {"availableNow": True}).awaitTermination()
    assert rows(tables.read("ratings")) == [("1", 1)]
    assert rows(tables.read(BAD)) == [("2", "{oops")]
