"""Line dedup: windows of three consecutive lines, kept where they occur first.

Every three consecutive lines that hold words are hashed. A window that occurs again, in
a later document or further down in the same one, marks its three lines there; the marked
positions of overlapping windows are merged and the lines removed. The first
occurrence, by document id and position, stays, so each removed line is still there in an
earlier place. Lines of more than WRAP words are wrapped into units of UNIT to 2 * UNIT - 1 words
at places that hashes of the neighbouring words decide, wherever the line starts; so 50 words that
occur again hold three whole units that are cut alike, and a long passage on one line is found, also
inside a longer line. Every window counts, however short its lines.

Only one number per window is shuffled and grouped, with partial counts before the shuffle, so
a passage that a third of all documents share is no hot spot.

Defined cases: null and empty texts, and texts of fewer than three lines, stay as they are.
A null id comes after all others. Different texts of equal id go by a hash of the text, and of rows of equal
id and text one, not said which, counts as the first. An empty table gives an empty result. Further columns pass
through, whatever their names; one called ``n_removed`` is replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelrank.llm.common import beside
from reelrank.session import stage

#: Longer lines are wrapped, and a unit of a wrapped line has UNIT to 2 * UNIT - 1 words.
LINES, WRAP, UNIT = 3, 8, 4

#: Words that a window needs: each of its lines holds one, so every window counts.
LEAST_WORDS = LINES

#: Rounds after which what is undecided (long runs of one word) is decided place by place.
ROUNDS = 12

#: Scripts without spaces between words: a character of theirs counts as a word.
SPACELESS = (
    (0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3040, 0x30FF), (0x31F0, 0x31FF),
    (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF),
)

_DECIDED = np.uint64(2**64 - 1)
_SPACE = np.array([chr(c).isspace() for c in range(0x3002)])
_SINGLE = np.zeros(0x40001, bool)
for _first, _last in SPACELESS:
    _SINGLE[_first : _last + 1] = True


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _hashed(values: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Hashes of the runs of ``values`` that start at ``firsts``, the first of them at 0."""
    sizes = np.diff(np.append(firsts, len(values)))
    place = np.arange(len(values)) - np.repeat(firsts, sizes)
    powers = np.cumprod(np.full(int(sizes.max()), 0x9E3779B97F4A7C15, np.uint64))
    return _mixed(np.add.reduceat(values * powers[place], firsts))


def cuts_of(order: np.ndarray) -> np.ndarray:
    """Where units start: places of small ``order``, the smallest first, UNIT or more apart.

    Of equal neighbours the left one comes first. Whether a place is cut depends on the few places
    around it only; every undecided place lies within UNIT of a cut, so units are under 2 * UNIT.
    """
    reach = UNIT - 1
    left = np.full(len(order) + 2 * reach, _DECIDED)
    left[reach : reach + len(order)] = order
    cut = np.zeros(len(left), bool)
    steps = np.arange(1, UNIT)
    at = np.flatnonzero(left < _DECIDED)
    for _ in range(ROUNDS):
        if not len(at):
            break
        own, before, after = left[at], left[at - 1], left[at + 1]
        for k in steps[1:]:
            before, after = np.minimum(before, left[at - k]), np.minimum(after, left[at + k])
        chosen = at[(own < before) & (own <= after)]
        cut[chosen] = True
        for k in range(-reach, reach + 1):
            left[chosen + k] = _DECIDED
        at = at[left[at] < _DECIDED]
    for k in at[np.lexsort((at, left[at]))].tolist():
        if left[k] < _DECIDED:
            cut[k] = True
            left[k - reach : k + UNIT] = _DECIDED
    return cut[reach : reach + len(order)]


class Units:
    """The units of texts: their short lines, and the pieces of their long ones."""

    def __init__(self, texts: list[str]):
        ends = np.cumsum([len(t) + 1 for t in texts])
        self.texts, self.offsets = texts, ends - [len(t) + 1 for t in texts]
        whole = "\n".join([*texts, ""])
        codes = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
        space = _SPACE[np.minimum(codes, len(_SPACE) - 1)]
        begin = ~space
        begin[1:] &= space[:-1]
        single = None
        if codes.max() >= SPACELESS[0][0]:
            single = _SINGLE[np.minimum(codes, len(_SINGLE) - 1)]
            begin[1:] |= ~space[1:] & (single[1:] | single[:-1])
        starts = np.flatnonzero(begin)
        line_ends = np.flatnonzero(codes == 10) + 1
        lines = np.r_[0, line_ends[:-1]]
        words = np.empty(0, np.uint64)
        if len(starts):
            letters = _mixed(codes[starts[0] :].astype(np.uint64) + np.uint64(1))
            letters[space[starts[0] :]] = 0
            words = _hashed(letters, starts - starts[0])
        cut = cuts_of(self._order(words, np.searchsorted(starts, lines)))
        #: Where units begin in the joined texts, and which of them hold words.
        self.begins = np.sort(np.r_[lines, starts[cut]])
        firsts = np.searchsorted(starts, self.begins)
        counts = np.diff(np.append(firsts, len(starts)))
        self.holds = counts > 0
        self.hashes = words
        if len(words):
            firsts = firsts[self.holds]
            if single is not None:
                glued = ~space[np.maximum(starts - 1, 0)]
                glued[firsts] = False
                words = words + glued.astype(np.uint64)
            self.hashes = _hashed(words, firsts)

    @staticmethod
    def _order(words: np.ndarray, firsts: np.ndarray) -> np.ndarray:
        """Hashes of the words where a long line may be cut, leaving UNIT words at its ends."""
        sizes = np.diff(np.append(firsts, len(words)))
        place = np.arange(len(words)) - np.repeat(firsts, sizes)
        size = np.repeat(sizes, sizes)
        may = (size > WRAP) & (place >= UNIT) & (size - place >= UNIT)
        return np.where(may, words >> np.uint64(1), _DECIDED)

    def of(self, k: int) -> list[str]:
        """The units of a text; joined, they are the text again."""
        at = self.offsets[k]
        lo, hi = np.searchsorted(self.begins, [at, at + len(self.texts[k]) + 1])
        bounds = [*(self.begins[lo:hi] - at).tolist(), len(self.texts[k])]
        return [self.texts[k][a:b] for a, b in zip(bounds, bounds[1:], strict=False)]

    def windows(self) -> Iterator[np.ndarray]:
        """For each text the hashes of the windows of its units."""
        n = max(0, len(self.hashes) - LINES + 1)
        mixed = np.full(n, LINES, np.uint64)
        for k in range(LINES if n else 0):
            mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
            mixed += self.hashes[k : n + k]
            mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        places = np.searchsorted(self.begins[self.holds], [*self.offsets, self.begins[-1] + 1])
        for lo, hi in zip(places.tolist(), places[1:].tolist(), strict=False):
            hi = max(lo, hi - LINES + 1)
            yield mixed[lo:hi].view(np.int64)


def lines_of(text: str) -> list[str]:
    """The text in lines, long ones wrapped; joined, they are the text again."""
    return Units([text]).of(0)


def without(text: str, starts: set[int] | None) -> tuple[str, int]:
    """The text without the lines of the windows that start at ``starts``, or of all windows."""
    lines = lines_of(text)
    places = [k for k, line in enumerate(lines) if not line.isspace() and line]
    if starts is None:
        starts = range(len(places) - LINES + 1)
    gone = {places[s + k] for s in starts for k in range(LINES)}
    return "".join([x for k, x in enumerate(lines) if k not in gone]), len(gone)


def window_table(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text_hash, windows, starts, again): a row per text with windows, written once.

    ``windows`` are those that are new within the text, at ``starts``; ``again`` are the
    starts of windows that the text itself had before.
    """

    def work() -> Callable:
        def build(texts: pa.Array) -> tuple[list[int], list]:
            rows, columns = [], ([], [], [])
            found = Units([t or "" for t in texts.to_pylist()]).windows()
            for k, windows in enumerate(found):
                if len(windows):
                    _, first = np.unique(windows, return_index=True)
                    new = np.sort(first)
                    again = np.setdiff1d(np.arange(len(windows)), new, assume_unique=True)
                    rows.append(k)
                    for column, value in zip(columns, (windows[new], new, again), strict=True):
                        column.append(value)
            return rows, columns

        return build

    texts = docs.select(
        F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("_text")
    )
    fields = {"windows": "array<long>", "starts": "array<int>", "again": "array<int>"}
    return stage(beside(texts, ["id", "text_hash"], "_text", fields, work), "line-windows")


def _exploded(found: DataFrame) -> DataFrame:
    zipped = F.explode(F.arrays_zip("windows", "starts")).alias("_w")
    return found.select("id", "text_hash", zipped).select(
        "id", "text_hash", F.col("_w.windows").alias("window"), F.col("_w.starts").alias("at")
    )


def repeats(found: DataFrame) -> DataFrame:
    """(id, text_hash, starts) of the windows to remove, one row per text that has any."""
    rows = _exploded(found)
    shared = stage(
        rows.groupBy("window")
        .agg(F.min("id").alias("_first"), F.count("*").alias("_n"))
        .where("_n > 1")
        .drop("_n"),
        "line-repeats",
    )
    # A null id counts as the last one.
    later = F.coalesce(F.col("id") > F.col("_first"), F.col("_first").isNotNull())
    across = rows.join(shared, "window").where(later).select("id", "text_hash", "at")
    inside = found.select("id", "text_hash", F.explode("again").alias("at"))
    marks = across.union(inside)
    several = stage(
        found.select("id", "text_hash")
        .distinct()
        .groupBy(F.col("id").alias("_several"))
        .agg(F.count("*").alias("_n"))
        .where("_n > 1"),
        "line-equal-ids",
    )
    if not several.isEmpty():
        marks = marks.union(_among_equal_ids(found, shared, several))
    return marks.groupBy("id", "text_hash").agg(F.collect_set("at").alias("starts"))


def _among_equal_ids(found: DataFrame, shared: DataFrame, several: DataFrame) -> DataFrame:
    """(id, text_hash, at): of different texts of the first id, those of larger hashes."""
    own = _exploded(found.join(several, F.col("id").eqNullSafe(F.col("_several")), "left_semi"))
    own = own.join(shared, "window").where(F.col("id").eqNullSafe(F.col("_first")))
    first = own.groupBy("window").agg(F.min("text_hash").alias("_least"))
    return own.join(first, "window").where("text_hash > _least").select("id", "text_hash", "at")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without repeated windows, and ``n_removed`` lines per row."""
    docs = docs.drop("n_removed")
    found = window_table(docs, id_col, text_col)
    marks = repeats(found)
    copies = stage(
        found.groupBy("id", "text_hash").count().where("count > 1").drop("count"), "line-copies"
    )
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    rows = docs.select(
        F.struct(*rest).alias("row"),
        F.col(text_col).alias("text"),
        F.col(id_col).alias("id"),
        F.xxhash64(text_col).alias("text_hash"),
    )
    here = F.col("id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
    joined = rows.join(marks.toDF("_id", "_hash", "starts"), here, "left").drop("_id", "_hash")
    if copies.isEmpty():
        numbered = joined.withColumn("copy", F.lit(1))
    else:
        # Rows of equal id and text: each but one has every window again.
        equal = copies.toDF("_id", "_hash")
        order = Window.partitionBy("id", "text_hash").orderBy("text_hash")
        again = joined.join(equal, here, "left_semi").withColumn("copy", F.row_number().over(order))
        numbered = joined.join(equal, here, "left_anti").withColumn("copy", F.lit(1)).union(again)

    def work() -> Callable:
        def remove(texts: pa.Array, starts: pa.Array, copy: pa.Array) -> tuple[None, list]:
            out, removed = [], []
            lists = (c.to_pylist() for c in (texts, starts, copy))
            for text, own, number in zip(*lists, strict=True):
                n = 0
                if number > 1 and text:
                    text, n = without(text, None)
                elif own is not None:
                    text, n = without(text, set(own))
                out.append(text)
                removed.append(n)
            return None, [out, removed]

        return remove

    fields = {"cut": "string", "n_removed": "int"}
    cut = beside(numbered, ["row"], "text", fields, work, ["starts", "copy"])
    own = [F.col("cut").alias(c) if c == text_col else F.col(f"row.`{c}`") for c in docs.columns]
    return cut.select(*own, "n_removed")
