"""Conversation tries, benchmark overlaps and centroid clusters against brute force."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelrank.llm import benchmark_overlap, centroid_clusters, conversation_trie

TURNS = "conv_id long, turn long, role string, text string"


def plain_trie(rows):
    """Nodes as the query's contract describes them, from (conv, turn, role, text)."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            mark = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[conv].append((turn is not None, turn or 0, mark, role, text))
    own = {c: [t[3:] for t in sorted(turns)] for c, turns in own.items()}
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        built[c] = own.get(base, [])[:h] + own[c][h:]
    members = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for key in members:
        if key:
            children[key[:-1]].append(key)
    sums = {}
    for key in sorted(members, key=len, reverse=True):
        saved = (len(members[key]) - 1) * len(key[-1][1].encode()) if key else 0
        leaves = int(not children[key])
        for child in children[key]:
            saved, leaves = saved + sums[child][0], leaves + sums[child][1]
        sums[key] = saved, leaves
    for key, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if len(built[c]) == len(key))
        yield (
            min(convs), len(key), min(members[key[:-1]]) if key else None, len(convs),
            len(children[key]), sums[key][1], sums[key][0], hashlib.sha256(ends.encode()).hexdigest(),
        )


def trie_of(df, most=conversation_trie.MOST):
    rows = conversation_trie.spliced(
        conversation_trie.turns_of(df),
        F.col("conv") - F.col("conv") % 5,
        F.crc32(F.col("conv").cast("string")) % 9,
        8,
    )
    return sorted(map(tuple, conversation_trie.trie(rows, most).collect()), key=repr)


def conversations(seed, n, hot=0.4):
    """Conversations that share turns, a hot first turn, copies, one long chain and odd rows."""
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-5, 3 * n), n):
        for t in range(rng.choice((1, 2, 3, 6, 12))):
            common = rng.random() < hot
            rows.append((c, t, "user", "same" if common else f"é{rng.randrange(4)} " * (t % 3)))
    rows += [(10**6, t, "user", "long") for t in range(70)]
    rows += [(10**6 + 5, t, "user", "long") for t in range(50)]
    rows += [(2**53 + 1, 0, None, None), (2**53 + 1, None, "", "x"), (None, 1, "user", "lost")]
    rows += [(7, 0, "a", "tie"), (7, 0, "b", "tie"), (7, 0, "a", "tie")]
    return rows


@pytest.mark.parametrize("most", [4, 40, conversation_trie.MOST])
def test_trie_equals_plain_version(spark, most):
    rows = conversations(most, 60)
    df = spark.createDataFrame(rows, TURNS).repartition(5)
    extra = df.withColumns({"node": F.lit(1), "conv": F.lit(2), "place": F.lit("p")})
    assert trie_of(extra, most) == sorted(plain_trie(rows), key=repr)


def test_trie_of_nothing_and_of_turnless_conversations(spark):
    assert trie_of(spark.createDataFrame([], TURNS)) == []
    # Conversation 1 begins with five turns of conversation 0, which is not there.
    h = zlib.crc32(b"1") % 9
    rows = [(1, t, "user", "x") for t in range(h)]
    got = trie_of(spark.createDataFrame(rows, TURNS))
    assert got == [(1, 0, None, 1, 0, 1, 0, hashlib.sha256(b"1").hexdigest())]


@pytest.mark.parametrize("shape", ["chain", "star", "random", "broom"])
def test_decomposition_sums_subtrees(shape):
    rng = np.random.default_rng(3)
    n = 400
    pick = {
        "chain": lambda k: k - 1,
        "star": lambda k: 0,
        "random": lambda k: rng.integers(k),
        "broom": lambda k: k - 1 if k < n // 2 else n // 2 - 1,
    }[shape]
    up = np.array([0] + [int(pick(k)) for k in range(1, n)])
    # Two such trees, whose rows are mixed.
    up = np.concatenate([up, up + n])
    order = rng.permutation(2 * n)
    place = np.argsort(order)
    up, comp = place[up][order], (order >= n).astype(np.int64)
    values = rng.integers(0, 100, (2 * n, 2))
    weight, want = np.ones(2 * n, np.int64), values.copy()
    for k in sorted(range(2 * n), key=lambda k: order[k], reverse=True):
        if up[k] != k:
            weight[up[k]] += weight[k]
            want[up[k]] += want[k]
    assert (conversation_trie.decompose(comp, up, weight, values) == want).all()


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(low)


def plain_overlap(docs, items):
    windows = defaultdict(set)
    for item, text in items:
        words = plain_words(text)
        size = min(10, len(words))
        for k in range(len(words) - size + 1 if words else 0):
            windows[tuple(words[k : k + size])].add("" if item is None else str(item))
    for doc, text in docs:
        words, hit, found = plain_words(text), set(), set()
        for size in {len(w) for w in windows}:
            for k in range(len(words) - size + 1):
                if tuple(words[k : k + size]) in windows:
                    hit.update(range(k, k + size))
                    found |= windows[tuple(words[k : k + size])]
        yield doc, len(words), len(hit), sorted(found)


def overlaps(docs, items):
    found = benchmark_overlap.overlaps(docs, items)
    got = benchmark_overlap.contamination(found).collect()
    return sorted(((r["id"], r["n_words"], r["n_hit"], r["items"]) for r in got), key=repr)


def test_overlaps_equal_plain_version(spark):
    rng = random.Random(4)
    vocabulary = [f"W{k}" for k in range(40)] + ["été", "ÉTÉ", "日本", "a", "it's", "x-y"]

    def words(n):
        return rng.choices(vocabulary, k=n)

    items = [(k, " ".join(words(n))) for k, n in enumerate((10, 30, 9, 5, 3, 1, 11, 60, 25, 0))]
    items += [(1, "another row of item one with " + " ".join(words(12))), (None, " ".join(words(15)))]
    items += [(100, None), (101, "..."), (102, items[1][1]), (103, "same same " * 8)]
    docs = []
    for k in range(120):
        parts = words(rng.choice((0, 3, 40, 200)))
        for _ in range(rng.randrange(3)):
            passage = (rng.choice(items)[1] or "").split()
            cut = rng.randint(0, max(0, len(passage) - 10))
            parts += passage[cut : cut + rng.choice((8, 9, 10, 14, 100))] + words(rng.randrange(4))
        docs.append((k, rng.choice((" ", ", ", " -\n")).join(parts)))
    docs += [(None, items[1][1]), (None, items[1][1]), (2**53 + 1, items[7][1]), (5, None), (5, "")]
    docs += [(2**63 - 1, " ".join(words(300_000)) + " " + items[7][1]), (6, "same " * 500)]
    docs += [(7, "x" * 3_000_000 + " " + items[1][1])]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    frame = frame.withColumns({"row": F.lit("r"), "id": F.lit(0), "start": F.lit(1)})
    given = spark.createDataFrame(items, "item_id int, text string").withColumn("item", F.lit(0))
    assert overlaps(frame, given) == sorted(plain_overlap(docs, items), key=repr)


def test_overlaps_of_nothing(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert overlaps(docs.limit(0), items) == []
    assert overlaps(docs, items.limit(0)) == [(1, 3, 0, [])]
    assert overlaps(docs, items) == [(1, 3, 2, ["1"])]


def test_any_shared_span_has_a_fingerprint_in_common():
    rng = random.Random(5)
    for _ in range(50):
        shared = [f"s{rng.randrange(6)}".encode() for _ in range(10)]
        around = [[f"o{rng.random()}".encode() for _ in range(rng.randrange(20))] for _ in range(4)]
        one = benchmark_overlap.Words([b" ".join(around[0] + shared + around[1])])
        two = benchmark_overlap.Words([b" ".join(around[2] + shared + around[3])])
        assert set(one.fingerprints(10)[1].tolist()) & set(two.fingerprints(10)[1].tolist())


def plain_clusters(rows, k=8, rounds=10):
    kept = [
        (i, [int(np.floor(1024 * float(x))) for x in v])
        for i, v in rows
        if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v)
    ]
    first = sorted(
        kept,
        key=lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]),
    )
    centroids = [v for _, v in first[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        groups = defaultdict(list)
        for _, v in kept:
            groups[nearest(v)[1]].append(v)
        for n, members in groups.items():
            centroids[n] = [sum(column) // len(members) for column in zip(*members, strict=True)]
    found = [(i, *nearest(v)[::-1]) for i, v in kept]
    inertia = defaultdict(int)
    for _, n, d in found:
        inertia[n] += d
    for i, n, d in found:
        text = ",".join(map(str, centroids[n]))
        yield i, n, d, inertia[n], sum(inertia.values()), hashlib.sha256(text.encode()).hexdigest()


def test_clusters_equal_plain_version(spark):
    rng = random.Random(6)

    def vector(scale):
        return [rng.choice((-1.0, 0.0, 0.5, rng.random())) * scale for _ in range(64)]

    rows = [(k, vector(1.0)) for k in range(60)]
    # Ties, repeated rows and ids, large values, and vectors that take no part.
    rows += [(100, [0.0] * 64)] * 9 + [(100, [0.5] * 64), (None, [0.25] * 64), (None, vector(2.0))]
    rows += [(2**53 + 1, vector(1000.0)), (2**63 - 1, vector(-300.0))]
    rows += [(200, None), (201, []), (202, [1.0] * 63), (203, [1.0] * 65), (204, [None] * 64)]
    rows += [(205, [float("nan")] + [0.0] * 63), (206, [float("-inf")] + [0.0] * 63)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    df = df.withColumns({"id": F.lit("x"), "parts": F.lit(1), "cluster": F.lit(2)})
    members, centroids = centroid_clusters.cluster(df)
    got = centroid_clusters.with_inertia(members, centroids).select(
        "id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(plain_clusters(rows), key=repr)


@pytest.mark.parametrize("n", [0, 1, 3])
def test_clusters_of_few_vectors(spark, n):
    rows = [(k, [float(k)] * 64) for k in range(n)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    members, centroids = centroid_clusters.cluster(df)
    got = centroid_clusters.with_inertia(members, centroids)
    assert len(centroids) == n and got.count() == n
    assert all(r["distance"] == 0 and r["inertia"] == 0 for r in got.collect())


def test_tree_search_is_exact_and_prunes():
    rng = np.random.default_rng(7)
    centres = rng.integers(-2000, 2000, (6, 16))
    points = np.concatenate([centres[k % 6] + rng.integers(-40, 40, (1, 16)) for k in range(200)])
    # Equal centroids, and vectors half way between two.
    points = np.concatenate([points, points[:20]])
    vectors = np.concatenate([points, (points[:50] + points[50:100]) // 2, rng.integers(-3000, 3000, (300, 16))])
    apart = ((vectors[:, None, :] - points[None]) ** 2).sum(axis=2)
    tree = centroid_clusters.VantageTree(points)
    number, distance = tree.nearest(vectors)
    assert (number == apart.argmin(axis=1)).all() and (distance == apart.min(axis=1)).all()
    seen = 0
    original = centroid_clusters.squared

    def counted(rows, point):
        nonlocal seen
        seen += len(rows)
        return original(rows, point)

    centroid_clusters.squared = counted
    try:
        tree.nearest(points)
    finally:
        centroid_clusters.squared = original
    assert seen < 0.7 * len(points) * len(points)
