"""N-gram Jaccard join: size-banded tiles, bitmap bounds, exact intersection.

A document's set holds the 48-bit hashes of its distinct five-word shingles. Sets are put
in one order, by hash with frequent shingles last; two sets of similarity t share a hash
within their first n - ceil(t n) + 1 ones. A tile is such a hash and a size band (a power of two); sets at the
lower end of a band also visit the band below, so no pair across bands is lost.

1. Equal sets are one set. In each tile a set looks to the first set of another component, in an order of
   the round's own, and is compared with the one that it meets in most tiles. After ROUNDS rounds most
   copies are joined, with as many comparisons as sets, not pairs.
2. Tiles that still hold several components are dealt into blocks of bounded size; pairs of
   different components are tested block against block. The number of differing bits of two parity
   bitmaps (four to eight bits an element) never exceeds the number of differing elements, which
   bounds the overlap from above; only pairs within the bound are intersected. Of a component's pairs a
   block first gives the nearest one, so near copies grow together with as many pairs as components; blocks that
   held more are tested again after the components were joined, with more pairs each time, until none is left.

Every pair within the bound whose documents are not in one component yet is intersected exactly, so no
link that could join two components is lost, and no limit is set on partners or candidates.

Defined cases: documents without words, or null texts, have an empty set and no links;
with fewer than five words the sequence is one shingle. Equal rows, and rows of equal id,
are linked by their texts alike. Rows with a null id take part and get the smallest id
of their component (null if there is none). An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelrank.llm.common import beside
from reelrank.llm.components import components
from reelrank.session import new_path, stage

WORDS = 5

#: Links need an intersection of at least NUMERATOR / DENOMINATOR of the union.
NUMERATOR, DENOMINATOR = 3, 4

#: Rounds of single comparisons, sets in a block of a tile, digests that a worker keeps.
ROUNDS, BLOCK, REMEMBERED = 2, 256, 300_000

#: Factor by which the pairs that a run gives of a component grow from round to round, and pairs whose
#: bitmaps are compared together.
MORE, STEP = 16, 1 << 14


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers (a finaliser of two rounds)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: ASCII white space.
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[32, 9, 10, 11, 12, 13]] = True

#: A number for each byte, and the odd base (with its inverse) of the words' polynomials.
_BYTE_VALUES = _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = 0x5851F42D4C957F2D
_INVERSE = pow(_BASE, -1, 1 << 64)


class Shingler:
    """Shingle hashes of several texts at once, in array operations over all their bytes."""

    def __init__(self, words: int = WORDS):
        self.words = words
        self.powers = self.inverses = np.empty(0, np.uint64)

    def _reach(self, size: int) -> None:
        if len(self.powers) < size:
            size = max(size, 1 << 20)
            step = np.full(size, _BASE, np.uint64), np.full(size, _INVERSE, np.uint64)
            for powers in step:
                powers[0] = 1
            self.powers, self.inverses = (np.multiply.accumulate(x) for x in step)

    def word_hashes(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Hash of each word, A-Z lower-cased, and the text it is in."""
        raw = [(t or "").encode("utf-8").lower() for t in texts]
        sizes = np.fromiter((len(r) + 1 for r in raw), np.int64, len(raw))
        data = np.frombuffer(b" ".join([*raw, b""]), np.uint8)
        blank = _IS_SPACE[data]
        before = np.r_[True, blank[:-1]]
        start, end = np.flatnonzero(~blank & before), np.flatnonzero(blank & ~before)
        self._reach(len(data))
        sums = np.cumsum(_BYTE_VALUES[data] * self.powers[: len(data)])
        # A word is followed by a blank, so its sum ends where the blank's begins.
        upto = np.r_[np.zeros(1, np.uint64), sums]
        hashes = (upto[end] - upto[start]) * self.inverses[start]
        owner = np.searchsorted(np.cumsum(sizes), start, "right")
        return _mixed(hashes ^ (end - start).astype(np.uint64)), owner

    def shingles(self, texts: list[str | None]) -> list[np.ndarray]:
        """Sorted 48-bit hashes of the distinct shingles of each text."""
        h, owner = self.word_hashes(texts)
        counts = np.bincount(owner, minlength=len(texts))
        starts = np.cumsum(counts) - counts
        size = max(0, len(h) - self.words + 1)
        mixed = self._mix(h, size, self.words)
        whole = owner[:size] == owner[self.words - 1 :] if size else np.empty(0, bool)
        out = []
        for lo, n in zip(starts, counts, strict=True):
            if n >= self.words:
                own = mixed[lo : lo + n - self.words + 1]
                assert whole[lo] and whole[lo + n - self.words]
            else:
                own = self._mix(h[lo : lo + n], 1, n) if n else np.empty(0, np.uint64)
            out.append(np.unique(own >> np.uint64(16)).astype(np.int64))
        return out

    @staticmethod
    def _mix(h: np.ndarray, size: int, width: int) -> np.ndarray:
        mixed = np.full(size, width, np.uint64)
        for k in range(width):
            mixed = _mixed(mixed * np.uint64(0x9E3779B97F4A7C15) + h[k : size + k])
        return mixed

    def batches(self, texts: list[str | None], most: int = 500_000) -> Iterator[np.ndarray]:
        """The shingles of each text, in groups of about ``most`` characters."""
        group, size = [], 0
        for text in texts:
            group.append(text)
            size += len(text or "")
            if size >= most:
                yield from self.shingles(group)
                group, size = [], 0
        if group:
            yield from self.shingles(group)


def bitmap_width(band: int) -> int:
    """Bits for sets of 2 ** band elements and more: four to eight an element."""
    return max(64, 8 << max(0, band))


def small_width(band: int) -> int:
    return max(64, bitmap_width(band) // 4)


def quarter(bits: bytes) -> bytes:
    return folded(bits, max(8, len(bits) // 4)).tobytes()


def bitmap(tokens: np.ndarray) -> bytes:
    """Parity bitmap: each element flips one bit. Widths are powers of two."""
    width = bitmap_width(len(tokens).bit_length() - 1)
    odd = np.bincount(tokens & (width - 1), minlength=width) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def folded(bits: bytes, size: int) -> np.ndarray:
    """The bitmap of ``size`` bytes, by laying the halves of a wider one over each other."""
    out = np.frombuffer(bits, np.uint8)
    while len(out) > size:
        out = out[: len(out) // 2] ^ out[len(out) // 2 :]
    return out.view(np.uint64)


def most_differing(n_a, n_b):
    """Elements that two linked sets of these sizes have apart, at most."""
    whole = n_a + n_b
    overlap = -(-whole * NUMERATOR // (NUMERATOR + DENOMINATOR))
    return whole - 2 * overlap


def _digest(tokens: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(tokens.tobytes()) - (1 << 63)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(text_col).alias("_text"),
        F.xxhash64(text_col).alias("text_hash"),
    )


#: Bits of a filter for each number in it, and the least and most bits that one has (16 MB).
FILTER_RATE, LEAST_BITS, MOST_BITS = 32, 1 << 16, 1 << 27

#: A shingle is frequent if so many of a task's texts, or of CHUNK shingles' texts, have it.
FREQUENT, CHUNK = 4, 2_000_000


def filter_of(values: DataFrame) -> np.ndarray:
    """A bitmap over the numbers in the one column of ``values``; its size follows their count."""
    values = stage(values.toDF("_at").where("_at IS NOT NULL").distinct(), "ngram-filter")
    wanted_bits = min(MOST_BITS, max(LEAST_BITS, values.count() * FILTER_RATE))
    size = 1 << (wanted_bits - 1).bit_length()
    parts = (
        values.withColumn("_at", F.pmod("_at", F.lit(size)))
        .groupBy(F.bitmap_bucket_number("_at").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_at")).alias("bits"))
    )
    wanted = np.zeros(size, np.uint8)
    for bucket, bits in parts.collect():
        own = np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little")
        # Place 0 has a bucket of its own; the others run from 1.
        if bucket == 0:
            wanted[0] |= own[0]
        else:
            lo = (bucket - 1) * len(own) + 1
            wanted[lo : lo + len(own)] |= own[: size - lo]
    return np.packbits(wanted, bitorder="little")


def passed(values: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Which numbers a filter may hold."""
    at = values & (8 * len(bits) - 1)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def frequent_shingles(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """A filter over shingles that many texts share, from all texts, counted task by task.

    It only decides which shingles come last in the order that heads are taken in. Any fixed
    order gives the same links; with common passages last, few sets meet that are not alike.
    """

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler, kept, size = Shingler(), [], 0
        for batch in batches:
            for tokens in shingler.batches(list(batch["_text"])):
                kept.append(tokens)
                size += len(tokens)
                if size >= CHUNK:
                    yield _often(kept)
                    kept, size = [], 0
        if kept:
            yield _often(kept)

    found = docs.select(F.col(text_col).alias("_text")).mapInPandas(build, "token long")
    return filter_of(found)


def _often(kept: list[np.ndarray]) -> pd.DataFrame:
    tokens, counts = np.unique(np.concatenate(kept), return_counts=True)
    return pd.DataFrame({"token": tokens[counts >= FREQUENT]})


def in_order(tokens: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """The hashes of a set, frequent ones last."""
    last = passed(tokens, frequent)
    return np.concatenate([tokens[~last], tokens[last]]) if last.any() else tokens


def set_heads(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, n, sid, head, bits) of all documents, written once.

    ``sid`` is a digest of the set; equal sets share it, and it is null for empty ones.
    ``head`` holds the first n - ceil(t n) + 1 hashes in the order that puts frequent ones
    last, ``bits`` the bitmap. Of equal sets a task writes both once, so a large group of copies
    brings no more rows than there are tasks.
    """
    shared = docs.sparkSession.sparkContext.broadcast(frequent_shingles(docs, text_col))

    def work() -> Callable:
        shingler, seen, frequent = Shingler(), set(), shared.value

        def build(texts: pa.Array) -> tuple[None, list]:
            sizes, digests, heads, bits = [], [], [], []
            for tokens in shingler.shingles(texts.to_pylist()):
                n = len(tokens)
                sid = _digest(tokens) if n else None
                new = n > 0 and sid not in seen
                if new:
                    if len(seen) >= REMEMBERED:
                        seen.clear()
                    seen.add(sid)
                sizes.append(n)
                digests.append(sid)
                head = n - -(-n * NUMERATOR // DENOMINATOR) + 1
                heads.append(in_order(tokens, frequent)[:head] if new else None)
                bits.append(bitmap(tokens) if new else None)
            return None, [sizes, digests, heads, bits]

        return build

    fields = {"n": "long", "sid": "long", "head": "array<long>", "bits": "binary"}
    texts = _texts(docs, id_col, text_col)
    return _written(beside(texts, ["doc_id", "text_hash"], "_text", fields, work), "ngram-heads")


def signatures(heads: DataFrame, tiled: DataFrame) -> DataFrame:
    """(sid, n, bits, small) of the sets in tiles, one row each; ``small`` is a quarter of ``bits``."""
    wanted = tiled.select("sid").distinct()
    own = heads.where("head IS NOT NULL").select("sid", "n", "bits")
    own = own.join(wanted, "sid", "left_semi").dropDuplicates(["sid"])

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(small=[quarter(b) for b in batch["bits"]])

    return _written(
        own.mapInPandas(fold, "sid long, n long, bits binary, small binary"), "ngram-signatures"
    )


def _written(frame: DataFrame, name: str) -> DataFrame:
    spark = frame.sparkSession
    path = new_path(spark, name)
    frame.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def tiles(heads: DataFrame) -> DataFrame:
    """(band, token, sid) of the tiles that hold more than one set."""
    token = Window.partitionBy("token")
    shared = (
        heads.where("head IS NOT NULL")
        .select("sid", F.col("n").cast("int").alias("n"), F.explode("head").alias("token"))
        .withColumn("_first", F.min("sid").over(token))
        .withColumn("_last", F.max("sid").over(token))
        .where("_first < _last")
        .select("token", "sid", F.col("n").cast("long").alias("n"))
        .distinct()
    )
    band = F.floor(F.log2(F.col("n") + F.lit(0.5))).cast("int")
    # The sets that a smaller one in the band below can be linked with.
    visits = F.expr(f"n * {NUMERATOR} <= shiftleft(1L, band) * {DENOMINATOR}")
    bands = F.when(visits, F.array("band", F.col("band") - 1)).otherwise(F.array("band"))
    tile = Window.partitionBy("band", "token")
    return (
        shared.withColumn("band", band)
        .withColumn("band", F.explode(bands))
        .withColumn("_first", F.min("sid").over(tile))
        .withColumn("_last", F.max("sid").over(tile))
        .where("_first < _last")
        .select("band", "token", "sid")
    )


def rooted(tiled: DataFrame, roots: DataFrame | None) -> DataFrame:
    """``tiled`` with the component ``root`` of each set; at first every set is its own."""
    if roots is None:
        return tiled.withColumn("root", F.col("sid"))
    known = tiled.join(roots.toDF("sid", "root"), "sid", "left")
    return known.withColumn("root", F.coalesce("root", "sid"))


def stars(members: DataFrame, salt: int) -> DataFrame:
    """(a, b): for each set the one of another component that most of its tiles name.

    A tile names its first set of another component, in an order that ``salt`` decides, so that a pair
    which was no link isn't all that the next round tries. Sets that share a passage meet in a
    few tiles, copies in most.
    """
    tile = Window.partitionBy("band", "token")
    place = F.xxhash64("sid", F.lit(salt)).alias("place")
    lowest = F.min(F.struct(place, "sid", "root")).over(tile)
    apart = F.col("root") != F.col("_low.root")
    other = F.min(F.when(apart, F.struct(place, "sid"))).over(tile)
    named = members.withColumn("_low", lowest).withColumn("_other", other).select(
        "sid", F.when(apart, F.col("_low.sid")).otherwise(F.col("_other.sid")).alias("named")
    )
    votes = named.where("named IS NOT NULL").groupBy("sid", "named").count()
    most = votes.groupBy("sid").agg(F.max(F.struct("count", "named")).alias("_most"))
    return most.select(
        F.least("sid", "_most.named").alias("a"), F.greatest("sid", "_most.named").alias("b")
    ).distinct()


def paired_sets(
    docs: DataFrame,
    heads: DataFrame,
    pairs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(sid, tokens) of the sets in ``pairs``, one row each.

    The sets are built from the texts again instead of being kept, as most are in no pair. A filter over
    the hashes of the wanted texts leaves the others out before they are cut into words; what it
    lets through besides is harmless.
    """
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("sid")).distinct()
    known = heads.where("head IS NOT NULL").select("sid", "text_hash")
    shared = docs.sparkSession.sparkContext.broadcast(
        filter_of(known.join(wanted, "sid").select("text_hash"))
    )

    def work() -> Callable:
        shingler, seen, bits = Shingler(), set(), shared.value

        def build(texts: pa.Array, hashes: pa.Array) -> tuple[list[int], list]:
            at = np.flatnonzero(passed(hashes.to_numpy(zero_copy_only=False), bits))
            sids, sets = [], []
            own = texts.take(pa.array(at)).to_pylist() if len(at) else []
            for tokens in shingler.shingles(own) if own else ():
                sid = _digest(tokens) if len(tokens) else None
                if sid is not None and sid not in seen:
                    if len(seen) >= REMEMBERED:
                        seen.clear()
                    seen.add(sid)
                    sids.append(sid)
                    sets.append(tokens)
            # Any row will do, as no column is kept.
            return [0] * len(sids), [sids, sets]

        return build

    fields = {"sid": "long", "tokens": "array<long>"}
    texts = _texts(docs, id_col, text_col)
    sets = beside(texts, [], "_text", fields, work, ["text_hash"])
    sets = sets.dropDuplicates(["sid"]).join(wanted, "sid", "left_semi")
    return _written(sets, "ngram-sets")


def within_bound(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sizes and bitmaps allow a link."""
    both = pairs
    known = known.select("sid", "n", "bits")
    for side in "ab":
        both = both.join(known.toDF(side, f"n_{side}", f"bits_{side}"), side)
    both = both.where(
        (F.col("n_a") * NUMERATOR <= F.col("n_b") * DENOMINATOR)
        & (F.col("n_b") * NUMERATOR <= F.col("n_a") * DENOMINATOR)
    )

    def bound(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            apart = np.fromiter(
                (
                    int(np.bitwise_count(folded(x, m) ^ folded(y, m)).sum())
                    for x, y in zip(batch["bits_a"], batch["bits_b"], strict=True)
                    for m in (min(len(x), len(y)),)
                ),
                np.int64,
                len(batch),
            )
            limit = most_differing(batch["n_a"].to_numpy(), batch["n_b"].to_numpy())
            yield batch.loc[apart <= limit, ["a", "b"]]

    return both.mapInPandas(bound, "a long, b long")


def linked(pairs: DataFrame, unique: DataFrame) -> DataFrame:
    """The pairs (a, b) that are links, by exact intersection of their sorted hashes."""
    both = pairs
    for side in "ab":
        both = both.join(unique.toDF(side, f"tokens_{side}"), side)

    def intersect(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = []
            for x, y in zip(batch["tokens_a"], batch["tokens_b"], strict=True):
                merged = np.concatenate([x, y])
                merged.sort(kind="stable")
                common = int((merged[1:] == merged[:-1]).sum())
                keep.append(common * DENOMINATOR >= NUMERATOR * (len(merged) - common))
            yield batch.loc[np.array(keep, bool), ["a", "b"]]

    return both.mapInPandas(intersect, "a long, b long")


#: Columns that name a run: a tile, and the two blocks of it that meet.
RUN = ["band", "token", "i", "j"]


def open_rows(members: DataFrame) -> DataFrame:
    """The rows of tiles that hold several components, dealt into runs."""
    tile = Window.partitionBy("band", "token")
    several = (
        members.withColumn("_low", F.min("root").over(tile))
        .withColumn("_high", F.max("root").over(tile))
        .withColumn("_blocks", F.ceil(F.count("*").over(tile) / BLOCK).cast("int"))
        .where("_low < _high")
    )
    own = F.pmod(F.xxhash64("sid"), F.col("_blocks")).cast("int")
    return (
        several.withColumn("own", own)
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
        .select(
            "band",
            "token",
            F.least("own", "_other").alias("i"),
            F.greatest("own", "_other").alias("j"),
            "own",
            "sid",
            "root",
        )
    )


def tested(rows: DataFrame, known: DataFrame, most: int, whole: bool) -> DataFrame:
    """(a, b) pairs of different components within the bound, and (band, token, i, j) of cut runs.

    Of each component a run gives the ``most`` pairs that are nearest by their bitmaps, ``whole`` or small
    ones. A run that had more pairs is named, with a and b null, and has to come again.
    """
    bits = F.col("bits" if whole else "small").alias("bits")
    return stage(
        rows.join(known.select("sid", "n", bits), "sid")
        .repartition(*RUN)
        .sortWithinPartitions(*RUN)
        .mapInPandas(
            lambda batches: _test_blocks(batches, most, bitmap_width if whole else small_width),
            "a long, b long, band int, token long, i int, j int",
        )
        .distinct(),
        "ngram-open",
    )


def _test_blocks(
    batches: Iterator[pd.DataFrame], most: int, width_of: Callable[[int], int]
) -> Iterator[pd.DataFrame]:
    """Runs of equal keys, block against block; a run is at most two blocks long."""
    rest = None
    for batch in batches:
        rows = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
        if not len(rows):
            continue
        marks = rows[RUN].to_numpy()
        starts = np.flatnonzero(np.r_[True, (marks[1:] != marks[:-1]).any(axis=1)])
        rest = rows.iloc[starts[-1] :]
        yield from _pairs_of_runs(rows.iloc[: starts[-1]], starts, most, width_of)
    if rest is not None and len(rest):
        one = np.array([0, len(rest)])
        yield from _pairs_of_runs(rest.reset_index(drop=True), one, most, width_of)


def _pairs_of_runs(
    rows: pd.DataFrame, starts: np.ndarray, most: int, width_of: Callable[[int], int]
) -> Iterator[pd.DataFrame]:
    run = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    sid, root, n, own = (rows[c].to_numpy() for c in ("sid", "root", "n", "own"))
    across = rows["i"].to_numpy() != rows["j"].to_numpy()
    band, bits, found = rows["band"].to_numpy(), rows["bits"].to_numpy(), []
    for value in np.unique(band).tolist():
        lo, hi = np.searchsorted(band, [value, value + 1])
        width = width_of(value) // 8
        block = np.stack([folded(b, width) for b in bits[lo:hi]])
        home = n[lo:hi] < 2 << value
        # Rows that are so far apart, in all runs at once.
        for apart in range(1, hi - lo):
            x = np.flatnonzero(run[lo : hi - apart] == run[lo + apart : hi])
            if not len(x):
                break
            y = x + apart
            n_x, n_y = n[lo + x], n[lo + y]
            good = (root[lo + x] != root[lo + y]) & (home[x] | home[y])
            good &= (n_x * NUMERATOR <= n_y * DENOMINATOR) & (n_y * NUMERATOR <= n_x * DENOMINATOR)
            good &= ~across[lo + x] | (own[lo + x] != own[lo + y])
            x, y = x[good], y[good]
            for k in range(0, len(x), STEP):
                a, b = x[k : k + STEP], y[k : k + STEP]
                differ = np.bitwise_count(block[a] ^ block[b]).sum(axis=1, dtype=np.int64)
                near = differ <= most_differing(n[lo + a], n[lo + b])
                found.append(np.stack([lo + a[near], lo + b[near], differ[near]]))
    if not any(part.shape[1] for part in found):
        return
    x, y, differ = np.concatenate(found, axis=1)
    # Each pair counts for both of its components.
    ends = np.concatenate([root[x], root[y]])
    runs, near = np.tile(run[x], 2), np.tile(differ, 2)
    order = np.lexsort((near, ends, runs))
    runs, ends = runs[order], ends[order]
    first = np.flatnonzero(np.r_[True, (runs[1:] != runs[:-1]) | (ends[1:] != ends[:-1])])
    rank = np.arange(len(order)) - np.repeat(first, np.diff(np.r_[first, len(order)]))
    kept = np.zeros(len(x), bool)
    kept[order[rank < most] % len(x)] = True
    pairs = np.stack([np.minimum(sid[x], sid[y]), np.maximum(sid[x], sid[y])])[:, kept]
    nothing = pd.array([None], "Int64").repeat(pairs.shape[1])
    named = {c: nothing for c in RUN}
    yield pd.DataFrame({"a": pairs[0], "b": pairs[1], **named})
    cut = rows.iloc[starts[np.unique(run[x[~kept]])]]
    nothing = pd.array([None], "Int64").repeat(len(cut))
    yield pd.DataFrame({"a": nothing, "b": nothing, **{c: cut[c].to_numpy() for c in RUN}})


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) for every document."""
    sets = set_heads(docs, id_col, text_col)
    tiled = stage(tiles(sets), "ngram-tiles")
    known = signatures(sets, tiled)

    def links_of(pairs: DataFrame) -> DataFrame:
        pairs = stage(within_bound(pairs, known), "ngram-pairs")
        if pairs.isEmpty():
            return pairs
        arrays = paired_sets(docs, sets, pairs, id_col, text_col)
        return stage(linked(pairs, arrays), "ngram-links")

    # Each components() call reads the new links and the earlier components, not all links again.
    roots = None
    for salt in range(ROUNDS):
        more = links_of(stars(rooted(tiled, roots), salt))
        roots = components(more, roots)
    # What is left: all pairs of different components, a few of each component at a time.
    waiting, most = None, 1
    while True:
        rows = open_rows(rooted(tiled, roots))
        if waiting is not None:
            # Few runs come again, so their rows may carry the whole bitmaps, which leave little to try.
            rows = rows.join(waiting, RUN, "left_semi")
        found = tested(rows, known, most, waiting is not None)
        more = links_of(found.where("a IS NOT NULL").select("a", "b"))
        if not more.isEmpty():
            roots = components(more, roots)
        waiting, most = found.where("a IS NULL").select(RUN), most * MORE
        if waiting.isEmpty():
            break
    return _component_ids(sets, roots)


def _component_ids(sets: DataFrame, roots: DataFrame) -> DataFrame:
    """The smallest id of every document's component: found per set, then per component."""
    least = sets.where("sid IS NOT NULL").groupBy("sid").agg(F.min("doc_id").alias("least"))
    rooted_sets = least.join(roots.toDF("sid", "root"), "sid", "left")
    rooted_sets = rooted_sets.withColumn("root", F.coalesce("root", "sid"))
    smallest = rooted_sets.groupBy("root").agg(F.min("least").alias("_least"))
    of_set = rooted_sets.join(smallest, "root").select("sid", "_least")
    return (
        sets.select("doc_id", "n", "sid")
        .join(of_set, "sid", "left")
        .select(
            "doc_id",
            F.col("n").alias("n_shingles"),
            F.coalesce("_least", "doc_id").alias("component_id"),
        )
    )
