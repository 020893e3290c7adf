import glob
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import rows
from reelrank.operators.topk import number_rows
from reelrank.plans.feature_tables import cumulative_metrics, metrics_long
from reelrank.session import new_path
from reelrank.sinks.messages import publish_files, to_messages
from reelrank.sources.streams import file_messages
from reelrank.streaming import jobs, outputs
from reelrank.streaming.live import Append, LiveTables, Replace
from test_features import GENRES, expected_metrics

NOW = {"availableNow": True}


def make_data(n, seed=2, days=3):
    """(user, movie, rating, time) in order of time, over several days."""
    rnd = random.Random(seed)
    return [
        (rnd.randint(1, 4), rnd.randint(1, 6), rnd.randint(0, 1),
         f"2024-01-{1 + i * days // n:02d} 00:{i // 60:02d}:{i % 60:02d}")
        for i in range(n)
    ]


def by_day(data):
    found = {}
    for row in data:
        found.setdefault(row[3][:10], []).append(row)
    return [found[day] for day in sorted(found)]


@pytest.fixture
def feed(spark, ratings):
    """Publish slices one by one; after each, run the outputs to the end."""

    def run(data, cuts, kept, root, checkpoint=lambda n: "checkpoint", files=1):
        frame = ratings(data).withColumn("n", F.col("key").cast("int"))
        tables = LiveTables(spark, f"{root}/tables")
        for n, (lo, hi) in enumerate(zip([0, *cuts], [*cuts, len(data)])):
            part = frame.where((F.col("n") >= lo) & (F.col("n") < hi)).repartition(3)
            topic = f"{root}/topic" if checkpoint(n) == "checkpoint" else f"{root}/topic-{n}"
            publish_files(to_messages(part), topic)
            source = jobs.ratings_of(file_messages(spark, topic, files))
            jobs.start(source, kept, tables, f"{root}/{checkpoint(n)}", NOW).awaitTermination()
        return tables

    return run


def last_wins(data):
    want = {}
    for day in by_day(data):
        want.update(expected_metrics([(u, m, float(r)) for u, m, r, _ in day]))
    return want


def hot_lists(data):
    want = {}
    for day in by_day(data):
        counts = {}
        for _, movie, _, _ in day:
            for genre in GENRES.get(movie, []):
                counts.setdefault(genre, {}).setdefault(movie, 0)
                counts[genre][movie] += 1
        for genre, by_movie in counts.items():
            want[genre] = sorted(by_movie, key=lambda m: (-by_movie[m], m))[:10]
    return want


def check_outputs(tables, data):
    spark = tables.spark
    got = metrics_long(outputs.last_metrics_of(tables.read("features")))
    assert {tuple(r)[:3]: r["value"] for r in got.collect()} == last_wins(data)
    ratings = outputs.newest_ratings(tables.read("ratings"))
    assert rows(ratings, "key", "userId", "movieId") == sorted(
        ((str(k), u, m) for k, (u, m, _, _) in enumerate(data)), key=repr
    )
    buffer = number_rows(tables.read("recent"), F.asc("ts"), F.asc("seq"))
    size = min(15, len(data))
    wanted = list(range(len(data) - size, len(data)))
    assert [r["seq"] for r in buffer.orderBy("pos").collect()] == wanted
    fifo = []
    for day in by_day(data):
        ids = [m for _, m, _, _ in day]
        fifo = (fifo + sorted(set(ids), key=lambda m: (-ids.count(m), m))[:2])[-3:]
    top = outputs.popular(k=2, size=3)
    counts = top(spark.createDataFrame([], "day date, movieId int")).merge(tables.read("popular"))
    tops = counts.withColumn(
        "rank", F.expr("row_number() OVER (PARTITION BY day ORDER BY cnt DESC, movieId)")
    ).where("rank <= 2").orderBy("day", "rank")
    assert [r["movieId"] for r in tops.collect()][-3:] == fifo
    lists = {}
    for r in outputs.genre_lists(tables.read("genre_hot")).orderBy("genreId", "pos").collect():
        lists.setdefault(r["genreId"], []).append(r["movieId"])
    assert lists == hot_lists(data)


def small_outputs(movies):
    return {
        **outputs.every_output(movies),
        "recent": outputs.recent(size=15),
        "popular": outputs.popular(k=2, size=3),
    }


@pytest.mark.parametrize("cuts, files", [([], 1), ([1, 20], None), ([7, 8, 33], 2)])
def test_all_outputs_for_any_split(spark, movies, feed, cuts, files):
    """Restarts between slices continue from the checkpoint; no cut changes a result."""
    data = make_data(40)
    tables = feed(data, cuts, small_outputs(movies), new_path(spark, "test-stream"), files=files)
    check_outputs(tables, data)


def test_a_new_checkpoint_goes_on_with_the_tables(spark, movies, feed):
    """Two runs with checkpoints of their own equal one run."""
    data = make_data(40)
    root = new_path(spark, "test-two-runs")
    tables = feed(data, [17], small_outputs(movies), root, lambda n: f"checkpoint-{n}", None)
    check_outputs(tables, data)
    assert len(tables.pointer().runs) == 2


def test_a_crash_between_two_outputs_shows_nothing_of_the_batch(spark, movies, feed):
    data = make_data(40)
    root = new_path(spark, "test-crash")
    kept, broken = small_outputs(movies), {"now": False}
    whole = kept["popular"]

    def fails(batch):
        if broken["now"]:
            raise RuntimeError("lost")
        return whole(batch)

    kept["popular"] = fails
    tables = feed(data[:25], [], kept, root, files=None)
    before = tables.pointer()
    broken["now"] = True
    frame = spark.createDataFrame(
        [(str(k), *row[:2], float(row[2]), row[3]) for k, row in enumerate(data) if k >= 25],
        "key string, userId int, movieId int, rating float, timestamp string",
    )
    publish_files(to_messages(frame), f"{root}/topic")
    source = jobs.ratings_of(file_messages(spark, f"{root}/topic", None))
    with pytest.raises(Exception, match="lost"):
        jobs.start(source, kept, tables, f"{root}/checkpoint", NOW).awaitTermination()
    assert tables.pointer() == before
    check_outputs(tables, data[:25])
    broken["now"] = False
    jobs.start(source, kept, tables, f"{root}/checkpoint", NOW).awaitTermination()
    check_outputs(tables, data)


def test_totals_come_from_the_state_store_after_restarts(spark, movies, ratings):
    data = make_data(30)
    root = new_path(spark, "test-cumulative")
    frame = ratings(data).withColumn("n", F.col("key").cast("int"))
    for lo, hi in ((0, 11), (11, 19), (19, 30)):
        part = frame.where((F.col("n") >= lo) & (F.col("n") < hi)).coalesce(1)
        publish_files(to_messages(part), f"{root}/topic")
        source = jobs.ratings_of(file_messages(spark, f"{root}/topic"))
        jobs.start_task("batch", source, movies, None, f"{root}/totals", NOW).awaitTermination()
    for batch, n in ((None, 30), (0, 11), (1, 19)):
        got = metrics_long(jobs.totals(spark, f"{root}/totals", batch))
        want = expected_metrics([(u, m, float(r)) for u, m, r, _ in data[:n]])
        assert {tuple(r)[:3]: r["value"] for r in got.collect()} == want
    twin = metrics_long(cumulative_metrics(ratings(data), movies))
    assert rows(metrics_long(jobs.totals(spark, f"{root}/totals"))) == rows(twin)
    with pytest.raises(ValueError):
        jobs.start_task("both", source, movies, None, f"{root}/other", NOW)


def appended(spark, n, rows_of=3):
    frame = spark.range(n, n + rows_of).selectExpr("id % 7 AS key", "id AS value")
    newest = lambda rows: rows.groupBy("key").agg(F.max("value").alias("value"))
    return Append(frame.coalesce(1), newest)


def test_a_rerun_of_a_batch_changes_nothing(spark):
    tables = LiveTables(spark, new_path(spark, "test-rerun"))
    assert tables.read("t") is None and tables.commit("a", 0, {"t": appended(spark, 0)})
    before = tables.pointer()
    assert not tables.commit("a", 0, {"t": appended(spark, 50)})
    assert tables.pointer() == before and tables.has("a", 0) and not tables.has("b", 0)
    # Another run counts its batches from 0 again.
    assert tables.commit("b", 0, {"t": appended(spark, 3)})
    reopened = LiveTables(spark, tables.root)
    assert sorted(r["value"] for r in reopened.read("t").collect()) == list(range(6))


def test_files_stay_few_over_many_batches(spark):
    tables = LiveTables(spark, new_path(spark, "test-many"), fold=4)
    held = Replace(lambda old: appended(spark, 0).rows if old is None else old.limit(3).coalesce(1))
    for n in range(100):
        tables.commit("a", n, {"t": appended(spark, n), "list": held})
        parts = tables.pointer().tables["t"]["parts"]
        assert len(parts) <= 3 * 4 and [p[1] for p in parts] == sorted(p[1] for p in parts)
    # Two pointers, and the parts that they name.
    assert len(tables.pointers.names("[0-9]*")) == 2
    assert len(tables.data.names("t/part=*")) <= len(parts) + 8
    assert len(tables.data.names("list/part=*")) <= 3
    got = tables.read("t").groupBy("key").agg(F.max("value").alias("value"))
    assert {r["key"]: r["value"] for r in got.collect()} == {k % 7: k for k in range(95, 102)}
    commits = {r["_commit"] for r in tables.read("t", seq=True).collect()}
    assert max(commits) == 100


def test_a_reader_keeps_its_state_while_parts_are_folded(spark):
    tables = LiveTables(spark, new_path(spark, "test-reader"), fold=3)
    for n in range(2):
        tables.commit("a", n, {"t": appended(spark, n)})
    seen = tables.read("t", tables.pointer())
    want = rows(seen)
    tables.commit("a", 2, {"t": appended(spark, 2)})
    assert len(tables.pointer().tables["t"]["parts"]) == 1
    assert rows(seen) == want


def test_the_loser_of_two_writers_starts_over(spark):
    tables = LiveTables(spark, new_path(spark, "test-race"))
    other = LiveTables(spark, tables.root)
    seen = []

    def fold(old):
        seen.append(None if old is None else old.count())
        if len(seen) == 1:
            # The other writer commits while this one still works.
            other.commit("b", 0, {"t": Replace(lambda before: appended(spark, 0).rows)})
        return appended(spark, 10).rows if old is None else old.union(appended(spark, 10).rows)

    assert tables.commit("a", 0, {"t": Replace(fold)})
    assert seen == [None, 3] and tables.read("t").count() == 6
    assert tables.pointer().runs == {"a": 0, "b": 0}


def test_messages_balance_and_malformed_ones_are_kept(spark, movies, ratings):
    root = new_path(spark, "test-bad")
    broken = [("x", "{broken"), (None, None), ("y", "")]
    messages = to_messages(ratings([(1, 1, 1)])).union(
        spark.createDataFrame(broken, "key string, value string")
    )
    publish_files(messages.repartition(3), f"{root}/topic")
    tables = LiveTables(spark, f"{root}/tables")
    source = jobs.ratings_of(file_messages(spark, f"{root}/topic"))
    kept = {"features": outputs.newest_features(movies)}
    query = jobs.start(source, kept, tables, f"{root}/checkpoint", NOW)
    query.awaitTermination()
    got = outputs.last_metrics_of(tables.read("features"))
    assert rows(got, "entity", "id") == [("movie", 1), ("user", 1)]
    assert rows(tables.read(jobs.BAD), "key", "value") == sorted(broken, key=repr)
    assert jobs.balance(query) == {"n_in": 4, "n_good": 1, "n_bad": 3}


def test_a_large_file_is_read_by_several_tasks(spark):
    """F1: a micro-batch of one large file is not left to a single task."""
    path = new_path(spark, "test-groups")
    messages = spark.range(200_000, numPartitions=1).selectExpr(
        "CAST(id AS STRING) AS key", "concat(sha2(CAST(id AS STRING), 256), id, 'x') AS value"
    )
    publish_files(messages, path)
    (file,) = glob.glob(f"{path}/*.parquet")
    found = pq.ParquetFile(file).metadata
    assert found.num_rows == 200_000 and found.num_row_groups > 1
    sizes = [found.row_group(n).total_byte_size for n in range(found.num_row_groups)]
    assert max(sizes) < 16 << 20


def test_timestamps_of_any_notation(spark):
    """Texts, numbers and what is neither; a text with a colon is never cast to a number."""
    noon = "2024-01-02 12:00:00"
    second = "1970-01-01 00:00:05"
    epoch = "1970-01-01 00:00:00"
    cases = {
        noon: noon, "2024-01-02": "2024-01-02 00:00:00", "5": second, " 5 ": second, "+5": second,
        "-5": "1969-12-31 23:59:55", "5:": epoch, "": epoch, "x": epoch,
        "1704196800": noon, "1704196800000": noon, f" {noon}": noon,
    }
    messages = spark.createDataFrame(
        [(k, f'{{"userId": "1", "movieId": "2", "rating": "1", "timestamp": "{k}"}}') for k in cases],
        "key string, value string",
    )
    found = jobs.ratings_of(messages).selectExpr("key", "CAST(ts AS STRING) AS ts")
    assert {r["key"]: r["ts"] for r in found.collect()} == cases


def test_keyed_upsert_over_batches(spark, ratings):
    tables = LiveTables(spark, new_path(spark, "test-keyed-stream"))
    keep = outputs.keyed_ratings(order=("timestamp",))
    for n, data in enumerate([[(1, 1, 0, "a"), (2, 2, 0, "a")], [(1, 5, 1, "b")]]):
        tables.commit("a", n, {"ratings": keep(ratings(data))})
    got = outputs.newest_ratings(tables.read("ratings"), ["timestamp"])
    assert rows(got, "key", "movieId", "rating") == [("0", 5, 1.0), ("1", 2, 0.0)]
