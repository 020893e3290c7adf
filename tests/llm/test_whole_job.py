"""Cases that an operator left out before: each test fails on the version that cut them off."""

import random

from pyspark.sql import functions as F

from reelrank.llm import language_id, line_dedup, url_filters


def spans(text, size):
    words = text.split()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def test_line_dedup_leaves_no_passage_of_over_50_words(spark):
    rng = random.Random(11)

    def own(n):
        return [f"o{rng.random()}" for _ in range(n)]

    docs, shared = {}, []
    for k in range(60):
        passage = [rng.choice("abcdefghij") + str(rng.randrange(90)) for _ in range(51 + k % 50)]
        if k % 3 == 0:
            # Two sentences, and no whole one of a third.
            passage[25], passage[-1] = passage[25] + ".", passage[-1] + "."
        shared.append(passage)
        for copy in range(3):
            words = [*own(rng.randint(0, 40)), *passage, *own(rng.randint(0, 40))]
            if k % 3 == 1:
                words = [w + "\n" * (rng.random() < 0.05) for w in words]
            docs[10 * k + copy] = " ".join(words)
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(df).collect()}
    for k, passage in enumerate(shared):
        assert got[10 * k] == docs[10 * k]
        if k % 3 != 1:
            for copy in (1, 2):
                assert not spans(got[10 * k + copy], 51) & spans(docs[10 * k], 51), k
                assert len(got[10 * k + copy].split()) <= len(docs[10 * k + copy].split()) - 12
    assert set().union(*(d.split() for d in docs.values())) == set().union(
        *(d.split() for d in got.values())
    )


def test_line_dedup_counts_windows_of_short_lines(spark):
    menu = "".join(f"dish {k}\n" for k in range(20))
    chinese = "".join(f"第{k}行的文字\n" for k in "一二三四五六七")
    inside = "春眠不覺曉處處聞啼鳥夜來風雨聲花落知多少床前明月光疑是地上霜舉頭望明月低頭思故鄉"
    docs = {
        1: "One\n" + menu + "end",
        2: "Two\n" + menu,
        3: chinese,
        4: "别的\n" + chinese,
        5: "甲乙丙丁戊己庚辛壬癸" + inside,
        6: "子丑寅卯辰巳午未" + inside,
    }
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(df).collect()}
    assert [got[k] for k in (1, 3, 5)] == [docs[k] for k in (1, 3, 5)]
    assert (got[2], got[4]) == ("Two\n", "别的\n")
    assert len(got[6]) <= len(docs[6]) - 12


def test_url_section_stays_however_large_its_host(spark):
    rows = [(f"http://h.test/main/p{'abc'[k % 3]}", 0) for k in range(5000)]
    rows += [(f"http://h.test/small/p{'abc'[k % 3]}", 1 if k % 2 else None) for k in range(75)]
    df = spark.createDataFrame(rows, "url string, bad int")
    got = url_filters.judge(df, (), label=F.col("bad"))
    found = {(r["path"].split("/")[1], r["verdict"]) for r in got.collect()}
    assert found == {("main", "allow"), ("small", "block")}


def test_url_templates_differ_at_any_depth(spark):
    rows = [
        (f"http://h.test/a/b/c/d/e/f/{name}/p{'abc'[k % 3]}", bad if k % 2 else None)
        for k in range(60)
        for name, bad in (("spam", 1), ("news", 0), ("blog", 0))
    ]
    df = spark.createDataFrame(rows, "url string, bad int")
    got = url_filters.judge(df, (), label=F.col("bad")).collect()
    found = {(r["path"].split("/")[7], r["verdict"]) for r in got}
    assert found == {("spam", "block"), ("news", "allow"), ("blog", "allow")}


def test_language_model_keeps_every_gram(spark):
    rng = random.Random(12)
    letters = [chr(0x4E00 + k) for k in range(3000)]
    words = {"".join(rng.choices(letters, k=4)) for _ in range(20_000)}
    rows = [("zz", " ".join(words)), ("aa", "alpha beta gamma")]
    models = language_id.learn(spark.createDataFrame(rows, "lang string, text string"))
    framed = [f" {w} " for w in words]
    grams = {w[k : k + 4] for w in framed for k in range(3)}
    assert len(models["zz"].grams[3][0]) == len(grams)
    assert len(set(models["zz"].grams[3][0].tolist())) == len(grams)


def test_languages_by_joins_equal_those_by_broadcast(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "lang", "text")
    more = [(-1, "en", None), (-2, "en", ""), (-2, "en", "12 !"), (None, "en", "word \u00e9t\u00e9 \U0001f600")]
    docs = docs.union(spark.createDataFrame(more, docs.schema))
    models = language_id.learn(docs.where("doc_id >= 0 AND doc_id % 2 = 0"))
    wanted = sorted(map(tuple, language_id.identify(docs, models).collect()), key=repr)
    joined = sorted(map(tuple, language_id.identify(docs, models, entries=0).collect()), key=repr)
    assert len(wanted) == len(joined)
    for a, b in zip(wanted, joined, strict=True):
        assert a[:2] == b[:2] and abs(a[2] - b[2]) < 1e-9 and abs(a[3] - b[3]) < 1e-9
