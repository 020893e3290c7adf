"""Ids of 64 bits beside null ones, and columns of any name, through every operator that carries them."""

import zlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from reelrank.llm import language_id, line_dedup, ngram_join, piece_encoder, quality_classifier, toxicity
from reelrank.llm.catalog import piece_vocabulary
from reelrank.llm.common import DOCUMENT_COLUMNS, fold

IDS = [2**53, 2**53 + 1, 2**63 - 1, -(2**53) - 1, None, None, 3]
TEXTS = [f"word{k} " * 8 + "and the rest of it\n" for k in range(len(IDS))]


@pytest.fixture
def docs(spark):
    rows = [(i, t, "en", "s", len(t)) for i, t in zip(IDS, TEXTS, strict=True)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    return spark.createDataFrame(rows, schema).repartition(1)


def ids_of(df, name="doc_id"):
    return sorted((r[name] for r in df.collect()), key=repr)


WANTED = sorted(IDS, key=repr)


def test_ids_come_back(spark, docs):
    labels = spark.createDataFrame([(3, 1, 1), (2**53, 0, 0)], "doc_id long, quality int, toxic int")
    scored = toxicity.score_texts(docs, toxicity.learn(docs, labels))
    assert ids_of(scored) == WANTED
    machine = quality_classifier.learn(docs, labels)
    scored = quality_classifier.score_texts(docs, machine).withColumn("f", fold("doc_id", 4))
    assert ids_of(scored) == WANTED
    for r in scored.collect():
        text = "" if r["doc_id"] is None else str(r["doc_id"])
        assert r["f"] == zlib.crc32(text.encode()) % 4
    assert ids_of(piece_encoder.encode_texts(docs, piece_vocabulary())) == WANTED
    models = language_id.learn(docs)
    assert ids_of(language_id.identify(docs, models)) == WANTED
    assert ids_of(language_id.identify(docs, models, entries=0)) == WANTED
    assert ids_of(line_dedup.dedup_lines(docs)) == WANTED
    groups = ngram_join.near_duplicates(docs)
    assert ids_of(groups) == ids_of(groups, "component_id") == WANTED


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_ids_come_back_from_the_stages(spark, docs, name, stage):
    got = stage(spark, docs, "/root/testdata/sf0.001")
    assert set(ids_of(got)) <= set(IDS)
    if name != "mixing":
        assert ids_of(got) == WANTED
    if name != "encoding":
        assert got.columns == DOCUMENT_COLUMNS


def test_near_duplicates_stage_tells_rows_of_equal_id_apart(spark):
    long = "one two three four five six seven eight nine ten"
    rows = [(1, long), (1, "another clean text of its own which nobody else has at all"), (2, long)]
    rows += [(None, long), (None, "unlike all others, this text has no id but stays"), (None, None)]
    rows += [(None, "twice there, without an id"), (None, "twice there, without an id")]
    docs = spark.createDataFrame(
        [(i, t, None, None, 0) for i, t in rows],
        "doc_id long, text string, lang string, source string, n_chars long",
    ).repartition(3)
    got = corpus_pipeline.one_of_each(spark, docs, "")
    kept = sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=repr)
    assert kept == sorted([rows[0], rows[1], *rows[4:7]], key=repr)


def test_line_dedup_with_null_and_equal_ids_and_any_columns(spark):
    lines = "alpha one\nbeta two\ngamma three\n"
    rows = [(None, lines), (None, lines), (None, lines + "own end\n"), (9, "other text\n"), (5, "x\ny\nz\n")]
    rows += [(7, "d e\nf g\nh i\n")] * 3 + [(5, "first\nx\ny\nz\n"), (4, "p\nq\nr\n"), (4, "p\nq\nr\ns\n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    names = ["_id", "_hash", "_starts", "_text_hash", "row", "id", "cut", "copy", "text_hash", "n_removed"]
    wide = docs.withColumns({n: F.col("doc_id") + k for k, n in enumerate(names)})
    got = line_dedup.dedup_lines(wide).collect()
    assert all(r["copy"] is None or r["copy"] == r["doc_id"] + 7 for r in got)
    texts = sorted(((r["doc_id"], r["text"]) for r in got), key=repr)
    # Of the three rows without an id one keeps the common lines, and so on.
    for i, whole, n in ((None, lines, 1), (7, "d e\nf g\nh i\n", 1)):
        kept = [t for d, t in texts if d == i and t.startswith(whole)]
        assert len(kept) == n
    assert sum("p\nq\nr\n" in t for d, t in texts if d == 4) == 1
    assert sum("x\ny\nz\n" in t for d, t in texts if d == 5) == 1
    assert (9, "other text\n") in texts


def test_misspelling_is_never_worth_more_than_its_term(spark):
    rows = [(k, f"badword {k} x{k} y{k} z{k}", 1) for k in range(40)]
    rows += [(100 + k, f"fine {k} a{k} b{k} badwurd" if k < 5 else f"fine {k} c{k}", 0) for k in range(60)]
    rows += [(200 + k, f"halfy v{k} u{k}", int(k % 10 < 8)) for k in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.learn(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"))
    assert "badword" in model.terms
    for term in model.terms:
        exact, swapped = term, term[:-2] + term[-1] + term[-2]
        one = toxicity.score(toxicity.hits(exact, toxicity.Matcher(model.terms)), model)
        other = toxicity.score(toxicity.hits(swapped, toxicity.Matcher(model.terms)), model)
        assert one >= other
