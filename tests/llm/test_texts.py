"""Encoder, language models, classifier and toxicity: round trips, accuracy, plain versions."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from reelrank.llm import language_id, piece_encoder, quality_classifier, toxicity
from reelrank.llm.catalog import QUERIES
from reelrank.llm.common import fold

SF = "/root/testdata/sf0.001"
LARGER = "/root/testdata/sf0.01"
MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def pieces():
    vocabulary = piece_encoder.Vocabulary.load(MODEL)
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    return piece_encoder.PieceEncoder(vocabulary), library


def coded(encoder, text):
    units = encoder.encode(text)
    ids = [int(i) for u in units for i in u[1].split(",")]
    assert len(ids) == sum(u[0] for u in units)
    return ids, piece_encoder.without_first_space("".join(u[2] for u in units))


def test_encoder_equals_library(pieces):
    encoder, library = pieces
    assert encoder.by_units
    rng = random.Random(1)
    texts = ["", " ", "  a  b ", "a\nb", "▁a", "é́ﬁ Ａ", "<s> <0x0A>\x00x", "日本", " " * 40 + "x"]
    texts += ["x" + " " * 40 + "日 " + " " * 33, "a" * 300, "ab" * 200, " ▁ ▁▁", "\n\n \n"]
    letters = "abcdeéß ▁  \n.日本の😀thing12"
    texts += ["".join(rng.choices(letters, k=rng.randint(1, 40))) for _ in range(2000)]
    known = [p for p in encoder.vocabulary.pieces[259:]]
    texts += ["".join(rng.choices(known, k=5)).replace("▁", " ") for _ in range(2000)]
    for text in texts:
        ids = library.encode(text)
        assert coded(encoder, text) == (ids, library.decode(ids)), repr(text)


def test_encoder_without_units_and_bytes(pieces):
    pieces_of = ("<unk>", "a", "b", "ab", "a▁b", "▁", "▁a")
    scores = (0.0, -5.0, -6.0, -1.0, -2.0, -7.0, -3.0)
    plain = (False, *[True] * 6)
    encoder = piece_encoder.PieceEncoder(
        piece_encoder.Vocabulary(pieces_of, scores, (), plain, 0)
    )
    assert not encoder.by_units
    for text in ("ab a b", "ba ab", "xa", "a b a b"):
        ids, _ = coded(encoder, text)
        marked = piece_encoder.MARK + text.replace(" ", piece_encoder.MARK)
        assert ids == encoder.to_ids(encoder.merge(marked))


def test_encode_query(spark, pieces):
    _, library = pieces
    got = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op5_piece_encoder"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    for r in docs:
        ids = library.encode(r["text"] or "")
        digest = [",".join(map(str, ids)), library.decode(ids)]
        want = (len(ids), *[hashlib.sha256(x.encode()).hexdigest() for x in digest])
        assert got[r["doc_id"]] == want


def test_encode_edge_rows(spark, pieces):
    encoder, _ = pieces
    rows = [(1, None), (1, None), (2, ""), (None, "word")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit(0))
    got = piece_encoder.encode_texts(df, encoder.vocabulary).collect()
    assert sorted(r["n_tokens"] for r in got)[:3] == [0, 0, 0] and len(got) == 4
    assert piece_encoder.encode_texts(df.limit(0), encoder.vocabulary).count() == 0


def accuracy(spark, name, table, label, sf=LARGER):
    got = QUERIES[name](spark, sf)
    known = spark.read.parquet(f"{sf}/{table}.parquet").select("doc_id", label)
    rows = got.join(known, "doc_id").where("held_out").collect()
    return [(r[label], r) for r in rows]


def test_language_of_held_out_texts(spark):
    rows = accuracy(spark, "op6_language_id", "documents", "lang")
    assert sum(lang == r["lang_pred"] for lang, r in rows) >= 0.98 * len(rows)
    assert all(0.0 <= r["score"] <= 1.0 for _, r in rows)


def test_language_model_is_a_distribution(spark):
    rows = [("xx", "banana bandana cabana"), ("yy", "kiki koko kukuku ikk")]
    models = language_id.learn(spark.createDataFrame(rows, "lang string, text string"))
    assert list(models) == ["xx", "yy"]
    letters = "abcdnkiou zqx"
    codes, place = language_id.codes_of(["ban" + c for c in letters if c != " "])
    cost = models["xx"].cost(codes, place)
    # After "ban": all letters and the end of a word; unseen ones share the floor.
    total = (2.0 ** -cost[place == 4]).sum()
    assert 0.9 < total <= 1.0 + 1e-9


def test_language_edge_rows(spark):
    train = spark.createDataFrame(
        [("aa", "alpha alfa"), ("bb", "omega omicron"), (None, "zz"), ("cc", None)],
        "lang string, text string",
    )
    models = language_id.learn(train)
    rows = [(1, None), (2, ""), (3, "12 ?!"), (4, "alpha"), (4, "alpha"), (5, "omega " * 9000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("cost", F.lit(1))
    found = language_id.identify(df, models)
    got = sorted((r["doc_id"], r["lang_pred"]) for r in found.collect())
    assert got == [(1, "und"), (2, "und"), (3, "und"), (4, "aa"), (4, "aa"), (5, "bb")]
    verdict = language_id.calibrated(found, found).collect()
    assert {r["doc_id"] for r in verdict if r["rejected"]} == {1, 2, 3}
    none = language_id.learn(train.limit(0))
    assert {r["lang_pred"] for r in language_id.identify(df, none).collect()} == {"und"}


def test_quality_of_held_out_texts(spark):
    rows = accuracy(spark, "op4_quality_classifier", "labels", "quality")
    assert sum(label == r["predicted"] for label, r in rows) >= 0.9 * len(rows)


def test_machine_equals_all_pairs():
    rng = np.random.default_rng(4)
    size, rank = quality_classifier.SIZE, quality_classifier.RANK
    machine = quality_classifier.Machine(0.3, rng.normal(size=size), rng.normal(size=(size, rank)))
    at = quality_classifier.features("Some words, some more!\nA line 12", 31, quality_classifier.Places())
    x = quality_classifier.values(at)
    want = machine.bias + machine.weights[at] @ x
    for i in range(len(at)):
        for j in range(i):
            want += machine.factors[at[i]] @ machine.factors[at[j]] * x[i] * x[j]
    assert abs(machine.margin(at) - want) < 1e-9


def test_quality_edge_rows(spark):
    rows = [(1, None, None), (2, "", 0), (3, "a b " * 30_000, 120_000), (3, "x", -1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    machine = quality_classifier.learn(df, labels, folds=1, held_out=5)
    got = quality_classifier.score_texts(df.withColumn("score", F.lit("x")), machine).collect()
    assert len(got) == 4 and all(0.9 < r["score"] <= 1.0 for r in got)
    empty = quality_classifier.learn(df, labels.limit(0))
    assert {r["score"] for r in quality_classifier.score_texts(df, empty).collect()} == {0.5}


def edits(a, b):
    table = [[i + j for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            table[i][j] = min(
                table[i - 1][j] + 1, table[i][j - 1] + 1, table[i - 1][j - 1] + (a[i - 1] != b[j - 1])
            )
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                table[i][j] = min(table[i][j], table[i - 2][j - 2] + 1)
    return table[-1][-1]


def test_automaton_equals_distance():
    terms = ["idiot", "stupid", "pathetic", "worthless", "abcab", "scum"]
    trie, rng = toxicity.Trie(terms), random.Random(6)
    for _ in range(4000):
        word = list(rng.choice(terms))
        for _ in range(rng.randint(0, 2)):
            k = rng.randrange(len(word))
            how = rng.random()
            if how < 0.25 and k:
                word[k - 1], word[k] = word[k], word[k - 1]
            elif how < 0.5:
                word[k] = rng.choice("abcdeiost")
            elif how < 0.75:
                word.insert(k, rng.choice("abcdeiost"))
            elif len(word) > 2:
                del word[k]
        word = "".join(word)
        near = [t for t in terms if len(t) >= 4 and edits(t, word) <= 1]
        assert trie.nearest(word) == (min(near) if near else None), word


def test_toxicity_of_larger_sample(spark):
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi pi rho".split()
    rng, rows, labels = random.Random(8), [], []
    for k in range(400):
        text = rng.choices(words, k=20)
        toxic = k % 4 == 0
        if toxic:
            text[rng.randrange(20)] = rng.choice(["moronic", "scumbag"])
        rows.append((k, " ".join(text)))
        labels.append((k, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.learn(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert {"moronic", "scumbag"} <= set(model.terms)
    cases = [
        (1, "you are a moronc thing", 1), (2, "a scumbga you are", 1), (3, "clean words", 0),
        (4, None, 0), (5, "", 0), (6, 'they said "you moronic thing" to us', 0), (7, "MORONIC!", 1),
    ]
    df = spark.createDataFrame([c[:2] for c in cases], "doc_id long, text string")
    scored = toxicity.score_texts(df.withColumn("terms", F.lit(1)), model).collect()
    assert {r["doc_id"]: int(r["score"] >= 0.5) for r in scored} == {c[0]: c[2] for c in cases}
    kept = toxicity.keep_clean(df, model).collect()
    assert {r["doc_id"] for r in kept} == {3, 4, 5, 6}
    assert toxicity.score_texts(df.limit(0), model).count() == 0
    blank = toxicity.learn(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert all(r["score"] == 0 for r in toxicity.score_texts(df, blank).collect())


def test_toxicity_of_held_out_texts(spark):
    rows = accuracy(spark, "op9_toxicity", "labels", "toxic")
    assert sum(label == r["predicted"] for label, r in rows) >= 0.9 * len(rows)
    assert all(label or not r["predicted"] for label, r in rows)


def test_fold_matches_sql(spark):
    df = spark.range(50).withColumnRenamed("id", "doc_id")
    got = {r[0]: r[1] for r in df.select("doc_id", fold("doc_id", 5)).collect()}
    assert got == {k: zlib.crc32(str(k).encode()) % 5 for k in got}
