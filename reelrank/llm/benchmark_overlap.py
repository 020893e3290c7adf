"""Benchmark decontamination by winnowing: passages of benchmark items inside documents.

Texts are compared as words, by windows of SPAN consecutive ones; an item of fewer words is one window of
its own length. The fingerprint of a window is the smallest hash of the GRAM-word runs in it, so a shared
span of SPAN words or more has a fingerprint in common wherever it stands. Fingerprints of the items make a
bit filter; windows of documents whose fingerprint passes it are joined with the items' windows on
the fingerprint, and a hit is extended to the window around it, which must be equal word for word. Hashes never decide: a
collision costs a comparison. Windows that overlap are merged into spans.

The filter has FILTER_RATE bits for a fingerprint, MOST_BITS at most; it saves shuffling windows
that no item has, and with more fingerprints than it can hold only that saving shrinks. Documents of a hot
passage meet one row per window; their sets of windows are reduced to distinct sets before items are looked up.

Defined cases: A-Z are lower-cased; words are runs of ASCII digits and letters and of anything beyond ASCII. Null and empty
texts have no words. Every row of the documents has a result of its own, also with repeated or null ids. Items
of equal id are one item, a null id is the empty id; items without words occur nowhere. Empty tables give
an empty result or documents without hits. Further columns, of any name, are not touched.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelrank.session import stage

#: Words of a window, and of the runs whose smallest hash is its fingerprint.
SPAN, GRAM = 10, 5

#: Bits of the filter for each fingerprint, and in all (16 MB).
FILTER_RATE, MOST_BITS = 1024, 1 << 27

#: Bytes of text that are hashed together, and candidate windows in an output batch.
STEP, ROWS = 1 << 20, 1 << 14

_BASE = 0x9E3779B97F4A7C15
_WORD_BYTES = b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(128, 256))
#: Lower-cases A-Z and turns what is in no word into zero.
_FOLD = bytes(b if b in _WORD_BYTES else 0 for b in bytes(range(256)).lower())
_LETTERS = np.random.default_rng(5).integers(1, 1 << 63, 256, np.uint64) * (
    np.arange(256, dtype=np.uint64) > 0
)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return h ^ (h >> np.uint64(29))


@lru_cache(maxsize=4)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base from 0 to ``size`` - 1 modulo 2**64, and their inverses."""
    bases = [_BASE, pow(_BASE, -1, 1 << 64)]
    powers = [np.cumprod(np.full(size, b, np.uint64)) for b in bases]
    return powers[0], powers[1]


class Words:
    """The words of texts: their hashes, and where they stand."""

    def __init__(self, texts: list[bytes]):
        self.joined = b"\0".join([*texts, b""]).translate(_FOLD)
        edges, hashes, at = [], [], 0
        while at < len(self.joined):
            # Parts end between words.
            end = self.joined.find(b"\0", at + STEP)
            end = len(self.joined) if end < 0 else end
            low = np.frombuffer(self.joined, np.uint8, end - at, at)
            turns = np.flatnonzero(np.diff((low != 0).view(np.int8), prepend=0, append=0))
            if len(turns):
                powers, inverses = _powers(1 << int(end - at).bit_length())
                sums = np.add.reduceat(_LETTERS[low] * powers[: len(low)], turns[::2])
                hashes.append(_mixed(sums * inverses[turns[::2]]))
                edges.append(turns + at)
            at = end
        edges = np.concatenate(edges) if edges else np.empty(0, np.int64)
        self.starts, self.ends = edges[::2], edges[1::2]
        self.hashes = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
        offsets = np.cumsum([0, *(len(t) + 1 for t in texts)])
        #: The first word of each text, and the number of words in each.
        self.firsts = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.firsts)

    def fingerprints(self, span: int) -> tuple[np.ndarray, np.ndarray]:
        """Of every window of ``span`` words in one text: its first word, and its fingerprint."""
        gram, n = min(GRAM, span), len(self.hashes) - span + 1
        if n <= 0:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        runs = np.full(len(self.hashes) - gram + 1, span, np.uint64)
        for k in range(gram):
            runs = (runs ^ (runs >> np.uint64(31))) * np.uint64(_BASE)
            runs += self.hashes[k : k + len(runs)]
        runs = _mixed(runs)
        least = runs[:n].copy()
        for k in range(1, span - gram + 1):
            np.minimum(least, runs[k : k + n], out=least)
        # The smallest of several hashes has small leading bits; the filter needs even ones.
        least *= np.uint64(_BASE)
        text = np.repeat(np.arange(len(self.counts)), self.counts)
        inside = np.flatnonzero(text[:n] == text[span - 1 :])
        return inside, least[inside]

    def window(self, first: int, span: int) -> bytes:
        places = range(first, first + span)
        return b" ".join([self.joined[self.starts[k] : self.ends[k]] for k in places])


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Words]]:
    """Some rows at a time, about STEP bytes of text or one longer text, and their words."""
    for batch in batches:
        texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
        sizes = np.cumsum([len(t) + 1 for t in texts])
        at = 0
        while at < len(texts):
            full = np.searchsorted(sizes, (sizes[at - 1] if at else 0) + STEP)
            end = max(at + 1, min(int(full), len(texts)))
            yield batch.slice(at, end - at), Words(texts[at:end])
            at = end


def item_windows(items: DataFrame) -> DataFrame:
    """(item, span, fp, window) of every window of ``items`` (item, text), written once."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, words in _chunks(batches):
            text = np.repeat(np.arange(len(words.counts)), words.counts)
            spans = np.minimum(words.counts, SPAN)
            for span in np.unique(spans[spans > 0]).tolist():
                first, fp = words.fingerprints(span)
                own = spans[text[first]] == span
                first, fp = first[own], fp[own]
                for lo in range(0, len(first), ROWS):
                    part = slice(lo, lo + ROWS)
                    yield pa.RecordBatch.from_arrays(
                        [
                            rows.column("item").take(pa.array(text[first[part]])),
                            pa.array(np.full(len(first[part]), span, np.int32)),
                            pa.array(fp[part].view(np.int64)),
                            pa.array([words.window(k, span) for k in first[part]], pa.binary()),
                        ],
                        names=["item", "span", "fp", "window"],
                    )

    schema = "item string, span int, fp long, window binary"
    return stage(items.mapInArrow(build, schema), "benchmark-windows")


@dataclass
class Filter:
    """A set bit for the leading bits of every fingerprint."""

    width: int
    bits: np.ndarray

    @classmethod
    def of(cls, prints: DataFrame) -> Filter:
        """From a table (fp); one row for 64 bits comes to the driver, MOST_BITS / 64 at most."""
        prints = prints.distinct()
        wanted = min(MOST_BITS, max(64, prints.count() * FILTER_RATE))
        width = (wanted - 1).bit_length()
        slot = F.shiftrightunsigned("fp", 64 - width)
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), (slot % 64).cast("int"))
        words = (
            prints.groupBy(F.shiftright(slot, 6).alias("at")).agg(F.bit_or(bit).alias("bits"))
        ).toArrow()
        bits = np.zeros((1 << width) // 64, np.int64)
        bits[words.column("at").to_numpy()] = words.column("bits").to_numpy()
        return cls(width, bits.view(np.uint64))

    def passed(self, prints: np.ndarray) -> np.ndarray:
        slot = prints >> np.uint64(64 - self.width)
        word = self.bits[(slot >> np.uint64(6)).view(np.int64)]
        return (word >> (slot & np.uint64(63))) & np.uint64(1) > 0


@dataclass
class Overlaps:
    """``docs`` (row, id, n_words): every document; ``hits`` (row, start, span, window_id): every
    occurrence of a window of an item; ``items`` (window_id, item): the items of the windows."""

    docs: DataFrame
    hits: DataFrame
    items: DataFrame

    def spans(self) -> DataFrame:
        """(row, start, stop): runs of words inside occurrences, overlapping or adjacent ones merged."""
        places = self.hits.select(
            "row", "start", (F.col("start") + F.col("span")).alias("stop")
        ).distinct()
        order = Window.partitionBy("row").orderBy("start", "stop")
        reach = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
        begins = places.withColumn(
            "_new", F.when(F.col("start") <= reach, F.lit(0)).otherwise(F.lit(1))
        )
        return (
            begins.withColumn("_island", F.sum("_new").over(order))
            .groupBy("row", "_island")
            .agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
            .drop("_island")
        )

    def item_lists(self) -> DataFrame:
        """(row, items): the sorted items that occur in a document, for those that have any."""
        sets = stage(
            self.hits.groupBy("row")
            .agg(F.sort_array(F.collect_set("window_id")).alias("ids"))
            .withColumn("key", F.md5(F.array_join(F.transform("ids", _text), ","))),
            "benchmark-sets",
        )
        distinct = sets.select("key", "ids").dropDuplicates(["key"])
        lists = (
            distinct.select("key", F.explode("ids").alias("window_id"))
            .join(self.items, "window_id")
            .groupBy("key")
            .agg(F.sort_array(F.collect_set("item")).alias("items"))
        )
        return sets.select("row", "key").join(lists, "key").drop("key")


def _text(value):
    return value.cast("string")


def overlaps(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> Overlaps:
    """All occurrences of the windows of ``items`` in ``docs``."""
    named = F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item")
    windows = item_windows(items.select(named, F.col(item_text_col).alias("text")))
    known = stage(
        windows.select("span", "fp", "window")
        .distinct()
        .withColumn("window_id", F.monotonically_increasing_id()),
        "benchmark-known",
    )
    # SPAN rows at most.
    spans = sorted(r["span"] for r in known.select("span").distinct().collect())
    context = docs.sparkSession.sparkContext
    shared = context.broadcast({s: Filter.of(known.where(f"span = {s}").select("fp")) for s in spans})
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("id"),
        F.col(text_col).alias("text"),
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, words in _chunks(batches):
            yield _records(rows, n_words=words.counts.astype(np.int64))
            for span, bits in shared.value.items():
                first, fp = words.fingerprints(span)
                found = bits.passed(fp)
                first, fp = first[found], fp[found]
                text = np.searchsorted(words.firsts, first, "right") - 1
                for lo in range(0, len(first), ROWS):
                    part = slice(lo, lo + ROWS)
                    yield _records(
                        rows.take(pa.array(text[part])),
                        start=(first[part] - words.firsts[text[part]]).astype(np.int32),
                        span=np.full(len(first[part]), span, np.int32),
                        fp=fp[part].view(np.int64),
                        window=[words.window(k, span) for k in first[part]],
                    )

    kind = rows.schema["id"].dataType.simpleString()
    found = stage(
        rows.mapInArrow(
            scan, f"row long, id {kind}, n_words long, start int, span int, fp long, window binary"
        ),
        "benchmark-scan",
    )
    hits = stage(
        found.where("start IS NOT NULL")
        .join(known.drop("span"), ["fp", "window"])
        .select("row", "start", "span", "window_id"),
        "benchmark-hits",
    )
    links = windows.join(known, ["span", "fp", "window"]).select("window_id", "item").distinct()
    return Overlaps(
        found.where("n_words IS NOT NULL").select("row", "id", "n_words"), hits, links
    )


_FIELDS = {
    "n_words": pa.int64(),
    "start": pa.int32(),
    "span": pa.int32(),
    "fp": pa.int64(),
    "window": pa.binary(),
}


def _records(rows: pa.RecordBatch, **values) -> pa.RecordBatch:
    columns = [rows.column("row"), rows.column("id")]
    for name, kind in _FIELDS.items():
        given = name in values
        columns.append(pa.array(values[name], kind) if given else pa.nulls(len(rows), kind))
    return pa.RecordBatch.from_arrays(columns, names=["row", "id", *_FIELDS])


def contamination(found: Overlaps) -> DataFrame:
    """(id, n_words, n_hit, items) of every document; ``items`` is empty where nothing occurs."""
    hit = found.spans().groupBy("row").agg(F.sum(F.expr("stop - start")).alias("n_hit"))
    return (
        found.docs.join(hit, "row", "left")
        .join(found.item_lists(), "row", "left")
        .select(
            "id",
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        )
    )
