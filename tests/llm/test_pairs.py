"""Near duplicates, line dedup and vector search against brute force on small inputs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelrank.llm import line_dedup, ngram_join, vector_search
from reelrank.llm.components import components

SF = "/root/testdata/sf0.001"


def shingle_set(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def roots(ids, links):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def brute_components(texts):
    sets = {i: shingle_set(t) for i, t in texts.items()}
    links = [
        (a, b)
        for a in sets
        for b in sets
        if a < b and sets[a] and 4 * len(sets[a] & sets[b]) >= 3 * len(sets[a] | sets[b])
    ]
    least = roots(list(texts), links)
    return {i: (len(sets[i]), least[i]) for i in texts}


def found_components(df):
    return {r[0]: (r[1], r[2]) for r in ngram_join.near_duplicates(df).collect()}


def test_near_duplicates_equal_all_pairs(spark):
    rng = random.Random(5)
    words = [f"w{k}" for k in range(300)]
    texts = {}
    for group in range(12):
        base = [rng.choice(words) for _ in range(rng.choice([6, 30, 63, 64, 90, 130]))]
        for _ in range(12):
            copy = list(base)
            for _ in range(rng.randint(0, 8)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            cut = rng.choice([0, 0, len(copy) // 5, len(copy) // 4])
            texts[len(texts)] = " ".join(copy[cut:])
    texts.update({200: "", 201: None, 202: " \n\t", 203: "a b", 204: "A  B", 205: "b a"})
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert found_components(df) == brute_components(texts)


def test_near_duplicates_on_documents(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in df.collect()}
    assert found_components(df) == brute_components(texts)


def test_shared_passage_and_chain(spark):
    # A passage shared by many links nothing; a chain of similar texts is one component.
    rng = random.Random(9)
    passage = " ".join(f"p{k}" for k in range(40))
    texts = {
        k: passage + " " + " ".join(f"x{rng.random()}" for _ in range(60)) for k in range(600)
    }
    chain = [f"c{k}" for k in range(200)]
    for k in range(8):
        texts[1000 + k] = " ".join(chain[k * 12 : k * 12 + 110])
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = found_components(df)
    assert all(got[k][1] == k for k in range(600))
    assert {got[1000 + k][1] for k in range(8)} == {1000}


def test_near_duplicates_edge_rows(spark):
    rows = [(None, "a b c d e f"), (7, "A b c d e f"), (7, "A b c d e f"), (3, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit("x"))
    got = sorted(ngram_join.near_duplicates(df).collect(), key=repr)
    assert [tuple(r) for r in got] == [(3, 0, 3), (7, 2, 7), (7, 2, 7), (None, 2, 7)]
    assert ngram_join.near_duplicates(df.limit(0)).count() == 0


def test_bitmap_bound_never_below_the_difference():
    rng = np.random.default_rng(1)
    for _ in range(300):
        common = rng.integers(0, 1 << 48, rng.integers(1, 80))
        a = np.unique(np.r_[common, rng.integers(0, 1 << 48, rng.integers(0, 40))])
        b = np.unique(np.r_[common, rng.integers(0, 1 << 48, rng.integers(0, 40))])
        x, y = ngram_join.bitmap(a), ngram_join.bitmap(b)
        size = min(len(x), len(y))
        bits = np.bitwise_count(ngram_join.folded(x, size) ^ ngram_join.folded(y, size)).sum()
        assert bits <= len(np.setxor1d(a, b))


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)]
    links += [(k, k + 1) for k in range(300, 340)]
    links = [(a, b) for a, b in links if a != b]
    got = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == roots(list(got), links)


def test_components_after_known(spark):
    """Earlier components stand for their links; a dense group is not read again link by link."""
    old = [(a, b) for a in range(12) for b in range(a + 1, 12)] + [(40, 41), (41, 42)]
    new = [(11, 50), (50, 51), (42, 60), (70, 71)]
    frame = "a long, b long"
    known = components(spark.createDataFrame(old, frame))
    got = dict(components(spark.createDataFrame(new, frame), known).collect())
    assert got == roots(list(got), old + new)
    assert set(got) == {n for link in old + new for n in link}


def brute_lines(docs):
    seen, out = set(), {}
    for key, text in sorted(docs.items()):
        lines = line_dedup.lines_of(text or "")
        places = [k for k, line in enumerate(lines) if line.split()]
        gone, own = set(), set()
        for s in range(len(places) - 2):
            window = tuple(" ".join(lines[p].split()) for p in places[s : s + 3])
            if sum(len(x.split()) for x in window) < line_dedup.LEAST_WORDS:
                continue
            if window in seen or window in own:
                gone.update(places[s : s + 3])
            own.add(window)
        seen |= own
        kept = "".join(x for k, x in enumerate(lines) if k not in gone)
        out[key] = (text if text is None else kept, len(gone))
    return out


def found_lines(df):
    return {r["doc_id"]: (r["text"], r["n_removed"]) for r in line_dedup.dedup_lines(df).collect()}


def test_line_dedup_equals_plain_version(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    docs = {r["doc_id"]: r["text"] for r in df.collect()}
    assert found_lines(df) == brute_lines(docs)


def test_line_dedup_finds_passages_inside_long_lines(spark):
    passage = " ".join(f"This is sentence {k} of a shared passage." for k in range(8))
    docs = {
        1: f"First words here. {passage} An end of its own kind.",
        2: f"Other words there, and more.\n{passage}\nDone.",
        3: "Nothing to see.\n\nShort lines.\nOnly.",
        4: None,
        5: "",
        6: "one two three four\nfive six seven eight\nnine ten eleven twelve\n" * 3,
    }
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    got = found_lines(df.withColumn("n_removed", F.lit(5)).withColumn("id", F.lit("x")))
    assert got == brute_lines(docs)
    assert got[1][0] == docs[1] and passage not in got[2][0] and got[2][1] >= 7
    assert got[6][0] == docs[6][: len(docs[6]) // 3]
    assert line_dedup.dedup_lines(df.limit(0)).count() == 0


def test_lines_join_to_the_text():
    rng = random.Random(3)
    for _ in range(500):
        parts = ["a ", "b. ", "c! ", "\n", "\r\n", "  ", "word " * 17, "x" * 50]
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 30)))
        assert "".join(line_dedup.lines_of(text)) == text


def brute_nearest(rows, k, every):
    good = {}
    for key, vector in rows:
        if key is None or not vector or any(v is None or not np.isfinite(v) for v in vector):
            continue
        if any(vector):
            good[key] = np.array(vector, float)
    out = {}
    for q in good:
        if q % every == 0:
            scored = [
                (-float(good[q] @ v), i) for i, v in good.items() if i != q and len(v) == len(good[q])
            ]
            out[q] = [(i, -s) for s, i in sorted(scored)[:k]]
    return out


@pytest.mark.parametrize("k", [3, 20])
def test_vector_search_recall(spark, k):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    want = brute_nearest(rows, k, 5)
    got = {}
    for r in vector_search.nearest(df, k, 5).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    assert set(got) == set(want)
    hits = sum(len({v for v, _ in got[q].values()} & {v for v, _ in want[q]}) for q in want)
    assert hits >= 0.99 * sum(map(len, want.values()))
    exact = dict(rows)
    for q, found in got.items():
        assert sorted(found) == list(range(1, len(found) + 1))
        for v, score in found.values():
            assert v != q and abs(score - np.dot(np.float64(exact[q]), np.float64(exact[v]))) < 1e-12


def test_vector_search_edge_rows(spark):
    nan = float("nan")
    rows = [(0, [1.0, 0.0]), (1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [None, 1.0])]
    rows += [(6 + k, [1.0, 0.5]) for k in range(9)] + [(20, [1.0, 0.5]), (40, [2.0, 1.0, 3.0])]
    rows += [(0, [1.0, 0.0]), (None, [1.0, 1.0]), (60, [float("inf"), 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = vector_search.nearest(df.withColumn("key", F.lit(1)), 4, 20).collect()
    found = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got)
    first = [(0, k + 1, 6 + k, 1.0) for k in range(4)]
    assert found == first + [(20, k + 1, 6 + k, 1.25) for k in range(4)]
    assert vector_search.nearest(df.limit(0), 4, 20).count() == 0


def test_dense_groups_are_joined_by_few_pairs(spark, monkeypatch):
    """Many near copies, of which some pairs link and others don't, in blocks of few sets."""
    monkeypatch.setattr(ngram_join, "ROUNDS", 1)
    monkeypatch.setattr(ngram_join, "BLOCK", 8)
    monkeypatch.setattr(ngram_join, "MORE", 2)
    rng = random.Random(21)
    docs, k = [], 0
    for group in range(3):
        base = [f"g{group}w{rng.randrange(400)}" for _ in range(120)]
        for _ in range(45):
            own = list(base)
            for _ in range(rng.randrange(1, 9)):
                own[rng.randrange(len(own))] = f"x{rng.random()}"
            docs.append((k, " ".join(own)))
            k += 1
            if rng.random() < 0.3:
                # The group drifts, so its ends are only linked by what lies between.
                base = own
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got, want = found_components(df), brute_components(dict(docs))
    assert got == want
    assert 3 < len({c for _, c in want.values()}) < len(docs)
