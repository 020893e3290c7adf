"""Mixing, quality rules, url filters and the pipeline on small inputs."""

import os
import re
import shutil
import subprocess
import sys
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from reelrank.llm import mixture, quality_rules, toxicity, url_filters
from reelrank.llm.catalog import URL_RULES
from reelrank.llm.common import DOCUMENT_COLUMNS

SF = "/root/testdata/sf0.001"
LARGER = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def water_filled(sizes, weights=(1, 2, 3), most=3):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    left, open_sources, out = float(sum(sizes.values())), set(order), {}
    while True:
        unit = left / sum(weight[s] for s in open_sources) if open_sources else 0
        capped = [s for s in open_sources if unit * weight[s] > most * sizes[s]]
        if not capped:
            return {**out, **{s: unit * weight[s] for s in open_sources}}
        for s in capped:
            out[s] = float(most * sizes[s])
            left -= out[s]
            open_sources.discard(s)


def mixed(df):
    sized, cuts = mixture.plan(df)
    return mixture.mix(sized, cuts)


def test_mixture_targets_and_nearness(spark):
    rows = [(k, f"s{k % 4}", "w " * (1 + k % 9)) for k in range(4000)]
    rows += [(5000 + k, "tiny", "w w") for k in range(5)] + [(6000, None, "a b c"), (6001, "void", None)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = mixed(df.withColumn("size", F.lit(9)).withColumn("target", F.lit(1))).collect()
    sizes = defaultdict(int)
    for r in got:
        sizes[r["source"]] += r["size"]
    want = water_filled(sizes)
    taken, largest = Counter(), Counter()
    for r in got:
        assert abs(r["target"] - want[r["source"]]) < 1e-6 and 0 <= r["repeats"] <= 3
        taken[r["source"]] += r["size"] * r["repeats"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    for source, target in want.items():
        assert abs(taken[source] - target) <= largest[source] / 2 + 1e-6
    assert want["tiny"] == 30.0 and want["void"] == 0.0


def test_mixture_budgets_are_nested_and_reruns_agree(spark):
    df = spark.read.parquet(f"{LARGER}/documents.parquet")
    sized = mixture.sizes(df)
    picks = []
    for share in (0.2, 0.5, 0.9, 0.9):
        cuts = mixture.cuts(sized, mixture.targets(sized, share=share))
        rows = mixture.mix(sized, cuts).select("doc_id", "repeats").collect()
        picks.append({r["doc_id"]: r["repeats"] for r in rows})
    assert picks[2] == picks[3]
    for small, large in zip(picks, picks[1:], strict=False):
        assert all(small[k] <= large[k] for k in small)


def test_mixture_edge_rows(spark):
    rows = [(1, "a", "x y"), (1, "a", "x y"), (None, "a", "z"), (2, "b", None), (3, None, "")]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = mixed(df).collect()
    assert len(got) == 5 and len({r["repeats"] for r in got if r["doc_id"] == 1}) == 1
    assert mixed(df.limit(0)).count() == 0


def plain_measures(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = {w for w, n in Counter(windows).items() if n > 1}
    covered = {i + k for i, w in enumerate(windows) if w in often for k in range(5)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    ink = sum(map(len, words))
    return len(words), ink, symbols, len(lines) - len(set(lines)), len(covered)


def test_quality_rules_equal_plain_version(spark):
    texts = {
        1: None, 2: "", 3: " \n\t ", 4: "a b c d e f g a b c d e", 5: "x " * 40, 6: "é ß 😀 # * |",
        7: "one\ntwo\none\n\n \none", 8: "a b c d e a b c d e f g h i j k l m n o p q r s t u v w",
    }
    texts.update((100 + r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = quality_rules.judge(df.withColumn("n_words", F.lit("x"))).collect()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    for r in got:
        want = plain_measures(texts[r["doc_id"]])
        assert tuple(r[c] for c in names) == want, r
        assert r["base_failed"] == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert r["kept"] == (not r["base_failed"] and not r["failed_rules"])
    assert quality_rules.judge(df.limit(0)).count() == 0


def test_quality_rules_agree_with_labels(spark):
    docs = spark.read.parquet(f"{LARGER}/documents.parquet")
    labels = spark.read.parquet(f"{LARGER}/labels.parquet")
    rows = quality_rules.judge(docs).join(labels, "doc_id").select("kept", "quality").collect()
    right = sum(r["kept"] == bool(r["quality"]) for r in rows)
    assert right >= 0.97 * len(rows)


def test_quality_rules_run_no_python(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plan = quality_rules.judge(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def plain_rule(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [
        r for r in URL_RULES
        if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    best = max(fits, key=lambda r: len(r.pattern), default=None)
    return host, path, best and best.pattern, best and best.verdict


def test_url_rules_equal_plain_version(spark):
    urls = [
        None, "", "example.net/en/1", "http://EXAMPLE.net/en/1?x=/de/", "https://a.example.net/en",
        "https://notexample.net/en/1", "x://net/", "x://net", "ftp://a.b.org/fr/#/de", "a://b://c/d",
        "http://example.com/de/x#y", "http://é.Org/fr/", "http:///path", "http://h?a/b", "http://h#/c",
        "http://org/fr/" + "s/" * 5000,
    ]
    urls += [r["url"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = url_filters.judge(df.withColumn("verdict", F.lit(1)), URL_RULES).collect()
    assert len(got) == len(urls)
    for r in got:
        host, path, rule, verdict = plain_rule(urls[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule), r
        assert r["verdict"] == (verdict or ("block" if r["purity"] >= 0.5 else "allow"))
    assert url_filters.judge(df.limit(0), URL_RULES).count() == 0


def test_url_templates_learn_from_labels(spark):
    rows = []
    for k in range(300):
        for section, bad in (("shop", 1), ("news", 0), ("blog", 0)):
            rows.append((f"http://h.test/{section}/item-{k}.html", bad if k % 3 else None))
    rows += [(f"http://h.test/slug{chr(97 + k % 26)}{chr(97 + k // 26)}/x", 0) for k in range(300)]
    df = spark.createDataFrame(rows, "url string, bad int")
    got = url_filters.judge(df, (), label=F.col("bad")).collect()
    verdicts = defaultdict(set)
    for r in got:
        verdicts[r["url"].split("/")[3]].add((r["template"], r["verdict"]))
    assert verdicts["shop"] == {("/shop/*", "block")}
    # Harmless branches are alike and merged, the many rare ones into one wildcard.
    assert verdicts["news"] | verdicts["blog"] == {("/*/*", "allow")} or all(
        v == "allow" for name in ("news", "blog") for _, v in verdicts[name]
    )
    assert {t for name, found in verdicts.items() if name.startswith("slug") for t, _ in found} == {
        "/*/*"
    }


@pytest.fixture(scope="module")
def staged(spark):
    docs = spark.read.parquet(f"{LARGER}/documents.parquet")
    results = [docs]
    for _, stage in corpus_pipeline.STAGES:
        results.append(stage(spark, results[-1], LARGER).cache())
    yield results
    for df in results[1:]:
        df.unpersist()


def test_pipeline_stages(spark, staged):
    docs, clean, fresh, single, mix, coded = staged
    for df in staged[:-1]:
        assert set(df.columns) == set(DOCUMENT_COLUMNS)
    model = toxicity.learn(docs, spark.read.parquet(f"{LARGER}/labels.parquet"))
    scores = {r[0]: r[1] for r in toxicity.score_texts(docs, model).select("doc_id", "score").collect()}
    assert {r["doc_id"] for r in clean.collect()} == {k for k, s in scores.items() if s < 0.5}
    assert clean.count() == fresh.count() < docs.count()
    ids = [r["doc_id"] for r in single.collect()]
    assert len(ids) == len(set(ids)) < fresh.count()
    times = Counter(r["doc_id"] for r in mix.collect())
    assert set(times) <= set(ids) and max(times.values()) <= 3
    assert coded.count() == mix.count() and "ids" in coded.columns


def test_pipeline_leaves_no_near_duplicates(spark, staged):
    from reelrank.llm import ngram_join

    groups = ngram_join.near_duplicates(staged[3])
    assert groups.where("doc_id != component_id").count() == 0
    lost = staged[2].join(staged[3].select("doc_id"), "doc_id", "left_anti").select("doc_id")
    copies = ngram_join.near_duplicates(staged[2]).where("doc_id != component_id").select("doc_id")
    assert sorted(lost.collect()) == sorted(copies.collect())


def test_pipeline_stages_accept_edge_rows(spark):
    rows = [(None, None, None, None, None), (1, None, "en", None, 0), (2, "", None, "s", None)]
    rows += [(3, "word " * 30_000, "en", "s", 150_000), (4, "a b", "en", "s", 3)] * 2
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame(rows, schema).withColumn("size", F.lit("x"))
    for docs_in in (docs, docs.limit(0)):
        df = docs_in
        for _, stage in corpus_pipeline.STAGES:
            df = stage(spark, df, SF)
        assert df.count() <= 3 * docs_in.count()


def test_entry_works_without_the_subpackage(tmp_path):
    """The rest imports when the training-data folders and the pipeline are gone."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    shutil.copytree(f"{root}/reelrank", tmp_path / "reelrank", ignore=shutil.ignore_patterns("llm"))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    env = {**os.environ, "PYTHONPATH": str(tmp_path)}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True)
    assert out.returncode == 0, out.stderr
    assert int(out.stdout.split()[0]) > 80


def test_mixture_refines_only_open_buckets(spark):
    rows = [(k, f"s{k % 3}", "w " * (1 + k % 5)) for k in range(500)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    sized = mixture.sizes(df)
    plan = mixture.cuts(sized, mixture.targets(sized))._jdf.queryExecution().toString()
    plan = plan.split("== Physical Plan ==")[1]
    # The rows of the last level meet the open buckets below the grouping.
    assert "LeftSemi" in plan and plan.index("LeftSemi") > plan.index("HashAggregate")
    wide = df.withColumns({n: F.lit(7) for n in ("_mix_hash", "hash", "row", "cut", "passes")})
    _, cut_table = mixture.plan(wide)
    got = {r["doc_id"]: r["repeats"] for r in mixture.mix(wide, cut_table).collect()}
    assert got == {r["doc_id"]: r["repeats"] for r in mixed(df).collect()}
    assert all(r["_mix_hash"] == r["cut"] == 7 for r in mixture.mix(wide, cut_table).collect())
