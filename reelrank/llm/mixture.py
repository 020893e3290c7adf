"""Mixing sources to target weights with hash-threshold histograms.

Every document has a hash; a budget of a source is met by the documents whose
hash lies below a threshold. The threshold is found from sums of tokens by
source and hash bucket: the bucket in which the running sum passes the budget
is split again by the next hash bits, all others are settled. Documents are
never sorted, and a larger budget keeps all that a smaller one takes.

Defined cases: a null text has no words; a null source is a source of its own,
ordered last; a null id hashes as the empty text. Rows of equal id share their
hash and are taken or left together. A source without words has target 0 and
takes nothing. An empty table gives an empty result; further columns, of any name but those of the
result, pass through.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelrank.llm.common import WORD
from reelrank.session import stage

#: Hash bits of a level and the number of levels; nine hexadecimal digits in all.
LEVEL_BITS, LEVELS = 12, 3
HASH_DIGITS = LEVEL_BITS * LEVELS // 4


def mix_hash(id_col: str) -> Column:
    """36 bits of the id's md5."""
    key = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    return F.conv(F.substring(key, 1, HASH_DIGITS), 16, 10).cast("long")


def sizes(
    docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text"
) -> DataFrame:
    """(doc_id, source, size, hash); one narrow row per document, written once."""
    words = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    return stage(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.col(source_col).alias("source"),
            words.alias("size"),
            mix_hash(id_col).alias("hash"),
        ),
        "mixture-sizes",
    )


def targets(
    sized: DataFrame, weights: Sequence[int] = (1, 2, 3), share: float = 1.0, most: int = 3
) -> DataFrame:
    """(source, source_size, target) with one row per source.

    Sources in code-point order weigh ``weights`` in turn and share ``share`` of
    all words. No target exceeds ``most`` times its source; what is cut goes to the
    others by weight. Ordered by the cap per weight, the sources that are cut are
    a prefix, and the price of a unit of weight is the largest one over all
    prefixes, so no iteration is needed. The windows run over sources, not rows.
    """
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    nth = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    by_cap = Window.orderBy("_ratio", F.col("source").asc_nulls_last())
    cut_before = F.coalesce(
        F.sum("_cap").over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    weight_left = F.sum("_weight").over(by_cap.rowsBetween(0, Window.unboundedFollowing))
    price = (F.lit(share) * F.col("_total") - cut_before) / weight_left
    weight = F.element_at(
        F.array(*[F.lit(w) for w in weights]), (nth % len(weights) + 1).cast("int")
    )
    return (
        sized.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("_weight", weight)
        .withColumn("_cap", F.col("source_size") * most)
        .withColumn("_ratio", F.col("_cap") / F.col("_weight"))
        .withColumn("_total", F.sum("source_size").over(everything))
        .withColumn("_price", price)
        .withColumn("_price", F.max("_price").over(everything))
        .select(
            "source",
            "source_size",
            F.least(F.col("_cap").cast("double"), F.col("_price") * F.col("_weight")).alias(
                "target"
            ),
        )
    )


def cuts(sized: DataFrame, wanted: DataFrame, most: int = 3) -> DataFrame:
    """(source, source_size, target, passes, cut): whole passes and the threshold of the rest.

    ``wanted`` is a table of ``targets``. Below the first level rows meet their source's open bucket, one row a
    source, before they are grouped; those in no open bucket go no further.
    """
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
    whole = F.least(F.coalesce(whole, F.lit(0)), F.lit(most)).cast("int")
    open_bucket = wanted.withColumn("passes", whole).select(
        "source",
        "source_size",
        "target",
        "passes",
        (F.col("target") - F.col("passes") * F.col("source_size")).alias("rest"),
        F.lit(0).cast("long").alias("prefix"),
    )
    carried = ["source", "source_size", "target", "passes"]
    for level in range(1, LEVELS + 1):
        above = LEVEL_BITS * (LEVELS - level + 1)
        rows = sized.select(
            F.col("source").alias("_source"),
            "size",
            F.expr(f"shiftright(hash, {above})").alias("_above"),
            F.expr(f"shiftright(hash, {above - LEVEL_BITS})").alias("_bucket"),
        )
        same = F.col("source").eqNullSafe(F.col("_source"))
        if level > 1:
            # Written, so its size is known: Spark broadcasts it if it is small.
            open_bucket = stage(open_bucket, "mixture-open")
            here = same & (F.col("prefix") == F.col("_above"))
            rows = rows.join(open_bucket.select("source", "prefix"), here, "left_semi")
        sums = rows.groupBy("_source", "_bucket").agg(F.sum("size").alias("_sum"))
        within = Window.partitionBy("source").orderBy("_bucket")
        running = open_bucket.drop("last").join(sums, same).withColumn("_upto", F.sum("_sum").over(within))
        # The first bucket whose running sum passes the rest; the one before it if none does.
        passed = F.struct((F.col("_upto") <= F.col("rest")).alias("under"), "_bucket")
        open_bucket = (
            running.withColumn("_first", F.min(passed).over(Window.partitionBy("source")))
            .where(F.col("_bucket") == F.col("_first._bucket"))
            .select(
                *carried,
                (F.col("rest") - F.col("_upto") + F.col("_sum")).alias("rest"),
                F.col("_bucket").alias("prefix"),
                F.col("_sum").alias("last"),
            )
        )
    # The last bucket is one hash: it goes in if that comes nearer to the target.
    nearer = (F.col("rest") * 2 >= F.col("last")).cast("long")
    return open_bucket.select(*carried, (F.col("prefix") + nearer).alias("cut"))


def mix(
    docs: DataFrame, cut_table: DataFrame, id_col: str = "doc_id", source_col: str = "source"
) -> DataFrame:
    """``docs`` with ``source_size``, ``target`` and ``repeats``, how often the mix takes the row.

    The table of cuts has one row per source. It is read from files, so its size is
    known and Spark broadcasts it if it is small; else the join is by source, and
    Spark splits a hot one.
    """
    added = ["source_size", "target", "repeats"]
    kept = [c for c in docs.columns if c not in added]
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"),
        F.col(source_col).alias("row_source"),
        mix_hash(id_col).alias("hash"),
    )
    joined = rows.join(cut_table, F.col("row_source").eqNullSafe(F.col("source")), "left")
    extra = (F.col("hash") < F.col("cut")).cast("int")
    return joined.select(
        *[F.col(f"row.`{c}`") for c in kept],
        "source_size",
        "target",
        (F.col("passes") + extra).alias("repeats"),
    )


def plan(docs: DataFrame, **options) -> tuple[DataFrame, DataFrame]:
    """The sized rows and the staged cuts of ``docs``; ``options`` go to ``targets``."""
    sized = sizes(docs)
    most = options.get("most", 3)
    return sized, stage(cuts(sized, targets(sized, **options), most), "mixture-cuts")
