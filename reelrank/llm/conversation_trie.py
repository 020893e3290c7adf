"""Prefix trie of conversations, with subtree totals by centroid decomposition.

A node is a distinct sequence of first turns. Its key is the 128-bit exclusive or of hashes of (place, turn),
so keys of all prefixes of a conversation are one running aggregate.

Totals over subtrees come from splitting the parent-edge forest at centroids. The weight of a node is
the number of conversations that pass it, so the weight below a node, the sum of its members' remaining
lengths, is known from the grouping that makes the nodes. The centroid of a component is the lightest node
with half of the component's weight below it. Taking it out leaves its children's subtrees and the part
above it, each of at most half the weight. What stood below the centroid is aggregated per component, and that total
is added along the path from the centroid to the component's top; then the parts are split in turn. A node's total is
what reached it this way, after at most log2(weight) rounds, however deep or lopsided the trie is.

Components of more than ``most`` weight are split by joins and groupings, all of them in one round;
each round is written. The others are dealt out whole, and a task splits many of them at a time in arrays.

Defined cases: turns go by ``turn``, null first, then by a digest of role and text, so ties and repeated rows
have a place each. Null role and text are empty. Rows without a conversation id are in no conversation. An empty
table has no members and so no root: the result is empty. Further columns, of any name, are not touched.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelrank.session import stage

#: Weight up to which a component is split inside a task, and rows that a task splits together.
MOST, TOGETHER = 1 << 16, 1 << 16

#: Ids of a node's ends go to the digest in texts of this many consecutive numbers at most.
RUN_BITS = 13

#: Fixed value: the digest of a node where no conversation ends.
NO_ENDS = hashlib.sha256(b"").hexdigest()


def turns_of(
    table: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """(conv, place, mark, bytes): numbered turns; ``mark`` is a digest of role and text."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role_col, text_col))
    framed = F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)
    turns = table.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv"),
        F.col(turn_col).alias("turn"),
        F.md5(framed).alias("mark"),
        F.octet_length(text).cast("long").alias("bytes"),
    )
    order = Window.partitionBy("conv").orderBy(F.asc_nulls_first("turn"), "mark")
    return turns.withColumn("place", F.row_number().over(order).cast("long")).drop("turn")


def spliced(turns: DataFrame, base: Column, head: Column, longest_head: int) -> DataFrame:
    """(conv, depth, mark, bytes, length): conversations that begin with another one's head.

    Conversation ``conv`` becomes the first ``head`` turns of ``base`` and its own turns after its
    first ``head``; both are expressions of ``conv``, and no head is over ``longest_head``. A row of
    depth 0 stands for the start of every conversation, also of one without turns.
    """
    turns = stage(turns, "trie-turns")
    sizes = turns.groupBy("conv").agg(F.count("*").alias("n"))
    known = sizes.select(F.col("conv").alias("base"), F.col("n").alias("n_base"))
    convs = (
        sizes.select("conv", "n", base.alias("base"), head.cast("long").alias("head"))
        .join(known, "base", "left")
        .withColumn("kept", F.least("head", F.coalesce("n_base", F.lit(0))))
        .withColumn("length", F.col("kept") + F.greatest(F.col("n") - F.col("head"), F.lit(0)))
    )
    convs = stage(convs.select("conv", "base", "head", "kept", "length"), "trie-conversations")
    heads = turns.where(F.col("place") <= longest_head).withColumnRenamed("conv", "base")
    first = convs.join(heads, "base").where("place <= head")
    rest = convs.join(turns, "conv").where("place > head")
    columns = ["conv", "depth", "mark", "bytes", "length"]
    return (
        first.withColumn("depth", F.col("place"))
        .select(columns)
        .union(rest.withColumn("depth", F.expr("kept + place - head")).select(columns))
        .union(convs.selectExpr("conv", "0L", "''", "0L", "length"))
    )


def prefixes(rows: DataFrame) -> DataFrame:
    """(conv, depth, length, bytes, node, parent): the trie node of every first part, written once."""
    order = Window.partitionBy("conv").orderBy("depth")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    start = F.col("depth") == 0
    for k in (1, 2):
        own = F.when(start, F.lit(0).cast("long")).otherwise(F.xxhash64(F.lit(k), "depth", "mark"))
        rows = rows.withColumn(f"own{k}", own)
    rows = rows.withColumns({f"key{k}": F.bit_xor(f"own{k}").over(upto) for k in (1, 2)})
    above = [F.col(f"key{k}").bitwiseXOR(F.col(f"own{k}")) for k in (1, 2)]
    return stage(
        rows.select(
            "conv",
            "depth",
            "length",
            "bytes",
            F.concat_ws(".", "depth", "key1", "key2").alias("node"),
            F.when(~start, F.concat_ws(".", F.col("depth") - 1, *above)).alias("parent"),
        ),
        "trie-prefixes",
    )


def nodes_of(paths: DataFrame) -> DataFrame:
    """The trie's nodes with their members, children and own values, written once.

    (node, parent, conv, depth, weight, n_convs, n_children, leaves, saved): ``conv`` is the smallest
    member, ``weight`` the number of rows of ``paths`` in the node's subtree.
    """
    nodes = stage(
        paths.groupBy("node", "parent", "depth").agg(
            F.min("conv").alias("conv"),
            F.count("*").alias("n_convs"),
            F.min("bytes").alias("bytes"),
            F.sum(F.expr("length - depth + 1")).alias("weight"),
        ),
        "trie-groups",
    )
    children = (
        nodes.where("parent IS NOT NULL")
        .groupBy(F.col("parent").alias("node"))
        .agg(F.count("*").alias("n_children"))
    )
    return stage(
        nodes.join(children, "node", "left")
        .withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
        .withColumn("leaves", (F.col("n_children") == 0).cast("long"))
        .withColumn("saved", F.expr("(n_convs - 1) * bytes"))
        .drop("bytes"),
        "trie-nodes",
    )


def subtree_sums(
    nodes: DataFrame, paths: DataFrame, values: list[str], most: int = MOST
) -> DataFrame:
    """(node, *values): sums of ``values`` over every node's subtree.

    ``nodes`` (node, parent, conv, depth, weight, *values) are one tree, and ``paths`` (conv, depth,
    node, parent) hold the way from the top to each node along its ``conv``.
    """
    columns = ["comp", "node", "parent", "conv", "depth", "weight", *values]
    top = nodes.where("parent IS NULL").select("node", "weight").limit(1).collect()
    whole, total = top[0] if top else ("", 0)
    sized = nodes.withColumn("comp", F.lit(whole)).select(columns)
    sized = stage(sized.withColumn("total", F.lit(total)), "trie-components")
    small, added = [], []
    while True:
        small.append(sized.where(F.col("total") <= most).select(columns))
        large = sized.where(F.col("total") > most)
        if large.isEmpty():
            break
        state, sums = _split(large, paths, values)
        totals = state.groupBy("comp").agg(F.max("weight").alias("total"))
        sized = stage(state.select(columns).join(totals, "comp"), "trie-components")
        added.append(sums)
    inside = _split_inside(reduce(DataFrame.union, small), values)
    if not added:
        return inside
    every = reduce(DataFrame.union, added, inside)
    return every.groupBy("node").agg(*(F.sum(v).alias(v) for v in values))


def _split(large: DataFrame, paths: DataFrame, values: list[str]) -> tuple[DataFrame, DataFrame]:
    """Takes the centroid out of every component: the parts, and (node, *values) to be added."""
    lightest = F.min(F.struct("weight", "node", "conv", "depth"))
    centres = stage(
        large.where("2 * weight >= total")
        .groupBy("comp")
        .agg(lightest.alias("_c"), F.min("depth").alias("top_depth"))
        .select(
            "comp",
            "top_depth",
            F.col("_c.node").alias("centre"),
            F.col("_c.conv").alias("centre_conv"),
            F.col("_c.depth").alias("centre_depth"),
            F.col("_c.weight").alias("taken"),
        ),
        "trie-centroids",
    )
    # The part that a row below the centroid belongs to: the centroid's child on the row's path.
    child = paths.select(
        F.col("conv"),
        (F.col("depth") - 1).alias("centre_depth"),
        F.col("node").alias("child"),
        F.col("parent").alias("centre"),
        F.lit(True).alias("below"),
    )
    here = large.join(centres, "comp").join(child, ["conv", "centre_depth", "centre"], "left")
    below = F.coalesce(F.col("below") & (F.col("depth") > F.col("centre_depth")), F.lit(False))
    here = stage(here.withColumn("below", below), "trie-split")
    totals = (
        here.where("below OR node = centre")
        .groupBy("comp")
        .agg(*(F.sum(v).alias(v) for v in values))
    )
    ways = (
        centres.join(totals, "comp")
        .join(paths.select(F.col("conv").alias("centre_conv"), "depth", "node"), "centre_conv")
        .where("depth BETWEEN top_depth AND centre_depth")
    )
    ways = stage(ways.select("node", "centre", "taken", *values), "trie-ways")
    lighter = ways.where("node != centre").select("node", "taken")
    parts = (
        here.where("node != centre")
        .drop("taken")
        .join(lighter, "node", "left")
        .withColumn("weight", F.col("weight") - F.coalesce("taken", F.lit(0)))
        .withColumn("comp", F.when(F.col("below"), F.col("child")).otherwise(F.col("comp")))
    )
    return parts, ways.select("node", *values)


def _split_inside(parts: DataFrame, values: list[str]) -> DataFrame:
    """(node, *values): the sums within components, each split by one task."""

    def solve(table: pa.Table) -> pa.RecordBatch:
        keys = table.column("node").combine_chunks()
        up = pa.compute.index_in(table.column("parent"), value_set=keys).combine_chunks()
        comp = table.column("comp").combine_chunks().dictionary_encode().indices.to_numpy()
        up = np.where(up.is_null(), np.arange(len(keys)), up.fill_null(0).to_numpy())
        # A parent in another component is cut off.
        up = np.where(comp[up] == comp, up, np.arange(len(keys)))
        own = np.stack([table.column(v).to_numpy() for v in values], axis=1)
        sums = decompose(comp, up, table.column("weight").to_numpy(), own)
        return pa.RecordBatch.from_arrays(
            [keys, *(pa.array(sums[:, k]) for k in range(len(values)))], names=["node", *values]
        )

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, n = [], 0
        for batch in batches:
            waiting.append(batch)
            n += len(batch)
            if n < TOGETHER:
                continue
            table = pa.Table.from_batches(waiting)
            comp = table.column("comp")
            # The last component may go on in the next batch.
            whole = pa.compute.index(comp, comp[n - 1]).as_py()
            if whole:
                yield solve(table.slice(0, whole))
            waiting = table.slice(whole).to_batches()
            n -= whole
        if n:
            yield solve(pa.Table.from_batches(waiting))

    fields = ", ".join(["node string", *(f"{v} long" for v in values)])
    rows = parts.select("comp", "node", "parent", "weight", *values)
    return rows.repartition("comp").sortWithinPartitions("comp").mapInArrow(split, fields)


def decompose(
    comp: np.ndarray, up: np.ndarray, weight: np.ndarray, values: np.ndarray
) -> np.ndarray:
    """Sums of ``values`` over the subtrees of trees, which are split at their centroids together.

    ``comp`` numbers the tree of each row, ``up`` is the row of its parent (its own at the top), and
    ``weight`` the weight of its subtree.
    """
    n = len(comp)
    up, weight, label = up.copy(), weight.astype(np.int64), comp.astype(np.int64)
    sums, live = np.zeros_like(values), np.arange(n)
    while len(live):
        total = np.zeros(n, np.int64)
        np.maximum.at(total, label[live], weight[live])
        heavy = live[2 * weight[live] >= total[label[live]]]
        heavy = heavy[np.lexsort((weight[heavy], label[heavy]))]
        centre = heavy[np.r_[True, label[heavy[1:]] != label[heavy[:-1]]]]
        centre_of = np.zeros(n, np.int64)
        centre_of[label[centre]] = centre
        own_centre = centre_of[label[live]]
        # Children of a centroid become tops; every row then finds its top by doubled steps.
        cut = live[(up[live] == own_centre) & (live != own_centre)]
        up[cut] = cut
        is_cut = np.zeros(n, bool)
        is_cut[cut] = True
        tops = up.copy()
        while True:
            further = tops[tops[live]]
            if np.array_equal(further, tops[live]):
                break
            tops[live] = further
        below = live[is_cut[tops[live]]]
        found = np.zeros_like(values)
        found[centre] = values[centre]
        np.add.at(found, centre_of[label[below]], values[below])
        # Along the paths to the tops, a step of all components at a time.
        sums[centre] += found[centre]
        at, of = up[centre], centre
        going = at != of
        while going.any():
            at, of = at[going], of[going]
            sums[at] += found[of]
            weight[at] -= weight[of]
            going = up[at] != at
            at = np.where(going, up[at], at)
        gone = np.zeros(n, bool)
        gone[centre] = True
        live = live[~gone[live]]
        label[live] = tops[live]
    return sums


def end_digests(paths: DataFrame) -> DataFrame:
    """(node, ends_sha256): the digest of the ascending ids of the conversations that end at a node.

    Ids are first joined in runs of neighbouring numbers; a task then feeds a node's runs to its
    digest one after the other, so many ends at one node need no memory.
    """
    ids = F.transform(F.sort_array(F.collect_list("conv")), lambda c: c.cast("string"))
    runs = (
        paths.where("depth = length")
        .groupBy("node", F.shiftright("conv", RUN_BITS).alias("run"))
        .agg(F.array_join(ids, ",").alias("ids"))
    )

    def feed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        present, digest = None, None
        for batch in batches:
            done = []
            nodes, texts = (batch.column(c).to_pylist() for c in ("node", "ids"))
            for node, text in zip(nodes, texts, strict=True):
                if node == present:
                    digest.update(b",")
                else:
                    if present is not None:
                        done.append((present, digest.hexdigest()))
                    present, digest = node, hashlib.sha256()
                digest.update(text.encode())
            yield _digests(done)
        if present is not None:
            yield _digests([(present, digest.hexdigest())])

    return (
        runs.repartition("node")
        .sortWithinPartitions("node", "run")
        .select("node", "ids")
        .mapInArrow(feed, "node string, ends_sha256 string")
    )


def _digests(rows: list[tuple[str, str]]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [(), ()]
    arrays = [pa.array(c, pa.string()) for c in columns]
    return pa.RecordBatch.from_arrays(arrays, names=["node", "ends_sha256"])


def trie(rows: DataFrame, most: int = MOST) -> DataFrame:
    """A row for every node of the trie of conversations ``rows`` (conv, depth, mark, bytes, length).

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)
    """
    paths = prefixes(rows)
    nodes = nodes_of(paths)
    sums = subtree_sums(nodes, paths, ["leaves", "saved"], most)
    parents = nodes.select(F.col("node").alias("parent"), F.col("conv").alias("parent_conv_id"))
    return (
        nodes.drop("leaves", "saved")
        .join(sums, "node")
        .join(end_digests(paths), "node", "left")
        .join(parents, "parent", "left")
        .select(
            F.col("conv").alias("conv_id"),
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            F.col("leaves").alias("n_leaves"),
            F.col("saved").alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"),
        )
    )
