"""The path-template tree against a plain version, and what it makes of the given pages."""

import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from reelrank.llm import url_filters
from reelrank.llm.catalog import URL_RULES


def shape(path):
    return tuple(s for s in re.sub(r"[0-9A-Fa-f-]*[0-9][0-9A-Fa-f-]*", "#", path).split("/") if s)


def share_class(part, n):
    return min(15, math.floor(math.asin(math.sqrt(part / n)) * 32 / math.pi))


def apart(a, b, n, m):
    pooled = (a + b) / (n + m)
    return abs(a / n - b / m) > 1.96 * math.sqrt(pooled * (1 - pooled) * (1 / n + 1 / m))


def plain_templates(pages):
    """{(host, shape): template} from pages (host, path, label)."""
    found, waiting = {}, defaultdict(list)
    for host, path, label in pages:
        waiting[host, ""].append((shape(path), label))
    depth = 0
    while waiting:
        following = defaultdict(list)
        for (host, template), rows in waiting.items():
            inner = [(s, label) for s, label in rows if len(s) > depth]
            kinds = Counter(label for _, label in inner)
            if len(inner) < url_filters.LEAST_PAGES or len(kinds) < 2:
                inner = []
            for s, _ in rows:
                if len(s) <= depth or not inner:
                    found[host, s] = template + "/*" * (len(s) - depth)
            uses = Counter(s[depth] for s, _ in inner)
            names = {x: x if "#" not in x and uses[x] >= url_filters.LEAST_PAGES else "*" for x in uses}
            children = defaultdict(Counter)
            for s, label in inner:
                children[names[s[depth]]][label] += 1
            classes = defaultdict(list)
            for name, c in children.items():
                n = sum(c.values())
                classes[share_class(c[1], n), share_class(c[0], n)].append(name)
            groups, before = [], None
            for key in sorted(classes):
                c = sum((children[name] for name in classes[key]), Counter())
                n = sum(c.values())
                if before is None or any(apart(c[k], before[0][k], n, before[1]) for k in (0, 1)):
                    groups.append([])
                groups[-1] += classes[key]
                before = c, n
            label_of = {}
            for group in groups:
                label = min(group) if len(group) == 1 else f"{{{min(group)}+{len(group) - 1}}}"
                label_of.update(dict.fromkeys(group, "*" if "*" in group else label))
            for s, label in inner:
                following[host, f"{template}/{label_of[names[s[depth]]]}"].append((s, label))
        waiting, depth = following, depth + 1
    return found


def test_templates_equal_plain_version(spark):
    rng = random.Random(9)
    pages = []
    for _ in range(3000):
        host = rng.choice(("a.test", "b.test", "c.test"))
        top = rng.choice(("news", "shop", "spam", "blog", f"u{rng.randrange(400)}"))
        below = [rng.choice(("x", "y", "cheap", f"p{rng.randrange(50)}")) for _ in range(rng.randrange(4))]
        bad = 0.9 if top == "spam" or "cheap" in below and host == "b.test" else 0.05
        label = int(rng.random() < bad) if rng.random() < 0.5 and top != "blog" else None
        pages.append((host, "/" + "/".join([top, *below]), label))
    pages += [("few.test", "/a/b", 1), ("few.test", "/c", 0), ("", "", None), ("d.test", "", 1)]
    df = spark.createDataFrame(pages, "host string, path string, label int").repartition(3)
    tree = url_filters.templates(df).collect()
    want = plain_templates(pages)
    assert {(r["host"], tuple(r["shape"])): r["template"] for r in tree} == want
    counts = defaultdict(Counter)
    for host, path, label in pages:
        counts[host, want[host, shape(path)]][label] += 1
    share = sum(label == 1 for *_, label in pages) / len(pages)
    for r in tree:
        c = counts[r["host"], r["template"]]
        assert abs(r["purity"] - (c[1] + 5 * share) / (c[0] + c[1] + 5)) < 1e-9
    assert any("{" in t for t in want.values()) and any("cheap" in t for t in want.values())


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_sections_are_judged_apart(spark, sf):
    pages = spark.read.parquet(f"/root/testdata/{sf}/pages.parquet").select("page_id", "url")
    got = url_filters.judge(pages, URL_RULES).where("rule IS NULL").collect()
    # ``example.com/de/`` blocks that section and no other one of its hosts.
    assert got and all(r["verdict"] == "allow" for r in got if r["host"].endswith("example.com"))
    if sf == "sf0.1":
        named = [r for r in got if r["template"] and r["template"].replace("/*", "")]
        assert len(named) > 100


def test_pages_may_have_columns_of_any_name(spark):
    df = spark.createDataFrame([(1, "http://x.net/a")], "page_id long, url string")
    for name in ("row", "shape", "label", "_host", "_path", "_rule", "_shape", "n"):
        df = df.withColumn(name, F.lit(name))
    got = url_filters.judge(df, URL_RULES).first()
    assert (got["row"], got["_rule"], got["rule"], got["verdict"]) == ("row", "_rule", "net/", "block")
