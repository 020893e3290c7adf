"""URL filters: rules, and a path-template tree whose templates are judged by their labels.

1. Urls are cut into host and path. Rules name a domain and a path prefix; the longest that
   fits decides, and what rules decide serves as labels unless others are given.
2. Per host, paths become templates, level by level. Variable segments become one wildcard: those with digits,
   and those on fewer than LEAST_PAGES pages of their branch. The others are branches of their own.
3. A page is blocked, allowed or unlabelled, and branches of one parent are compared by their shares of blocked and
   of allowed pages. Ordered by these shares, neighbours that two tests of proportions can't tell apart
   are merged; a section with labels so parts from one without. Levels go on as deep as a branch has
   segments, LEAST_PAGES pages and pages of more than one kind.
4. A template is rejected if the share of blocked pages among its labelled ones, smoothed towards the share of
   blocked pages among all, reaches LIMIT. So a template without labels is allowed unless half of all pages are
   known to be bad.

Everything is joins, groupings and expressions. Pages are grouped to their shapes first,
so the tree sees each shape once, however many pages a host has. Before neighbours are compared, branches whose
shares lie in the same of CLASSES classes are one, so a host with very many sections brings a bounded number of rows to
that comparison.

Defined cases: null urls and urls without ``://`` have an empty host and path and are judged like any template.
Repeated rows count as often as they occur and are judged alike. Without labels
every template is allowed. An empty table gives an empty result; further columns, of any name, pass
through, but for those of the result's own names.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelrank.session import stage

#: A segment stays only if it has at least so many pages, however many its branch has.
LEAST_PAGES = 2

#: Classes of a share, of equal width on the arcsine scale, where its spread is the same everywhere.
CLASSES = 16

#: Standard errors up to which branches count as alike, the smoothing weight, the limit.
ALIKE, WEIGHT, LIMIT = 1.96, 5.0, 0.5

ALLOW, BLOCK = "allow", "block"


class Rule(NamedTuple):
    """A verdict for a domain and all its subdomains, below a path, like ``net/en/``."""

    pattern: str
    verdict: str

    @property
    def host(self) -> str:
        return self.pattern.partition("/")[0]

    @property
    def path(self) -> str:
        return self.pattern[len(self.host) :]


def parts_of(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path; both empty if there is no ``://``."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    at = F.locate("://", F.coalesce(url, F.lit("")))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), upper, lower)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(rules: Sequence[Rule], host: Column, path: Column) -> Column:
    """(pattern, verdict) of the longest rule that fits; null if none does."""
    chosen = F.lit(None).cast("struct<pattern:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (len(r.pattern), r.pattern)):
        fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        value = F.struct(F.lit(rule.pattern).alias("pattern"), F.lit(rule.verdict).alias("verdict"))
        chosen = F.when(fits, value).otherwise(chosen)
    return chosen


def shapes(path: Column) -> Column:
    """The segments of a path; runs of digits, and what holds them, are reduced to a shape."""
    shaped = F.regexp_replace(path, r"[0-9A-Fa-f-]*[0-9][0-9A-Fa-f-]*", "#")
    return F.filter(F.split(shaped, "/"), lambda s: s != "")


COUNTS = ("n", "labelled", "blocked")


def _sums() -> list[Column]:
    return [F.sum(c).alias(c) for c in COUNTS]


def _class(part: Column) -> Column:
    """The class of the share of ``part`` among the pages, from 0 to CLASSES - 1."""
    angle = F.asin(F.sqrt(part / F.col("n"))) * (2 * CLASSES / math.pi)
    return F.least(F.floor(angle), F.lit(CLASSES - 1)).cast("int")


def _apart(part: str, other: str, n: str, other_n: str) -> Column:
    """Whether two shares differ by more than ALIKE standard errors of their pooled share."""
    pooled = (F.col(part) + F.col(other)) / (F.col(n) + F.col(other_n))
    error = F.sqrt(pooled * (1 - pooled) * (1 / F.col(n) + 1 / F.col(other_n)))
    return F.abs(F.col(part) / F.col(n) - F.col(other) / F.col(other_n)) > ALIKE * error


def merged_branches(children: DataFrame) -> DataFrame:
    """(host, template, name, label) for children (host, template, name, n, labelled, blocked).

    Children with one label are one branch from here on: ``*`` if variable segments are among them,
    the segment if it stands alone, and else the first of them with the number of the others.
    """
    branch = ["host", "template"]
    allowed = F.col("labelled") - F.col("blocked")
    placed = children.withColumns({"_x": _class(F.col("blocked")), "_y": _class(allowed)})
    classes = (
        placed.groupBy(*branch, "_x", "_y")
        .agg(
            *_sums(),
            F.min("name").alias("first"),
            F.count("*").alias("size"),
            F.bool_or(F.col("name") == "*").alias("variable"),
        )
        .withColumn("allowed", allowed)
    )
    # CLASSES ** 2 rows for a branch at most.
    order = Window.partitionBy(*branch).orderBy("_x", "_y")
    before = {f"_{c}": F.lag(c).over(order) for c in ("n", "blocked", "allowed")}
    differs = _apart("blocked", "_blocked", "n", "_n") | _apart("allowed", "_allowed", "n", "_n")
    numbered = classes.withColumns(before).withColumn(
        "_step", F.coalesce(differs.cast("int"), F.lit(0))
    )
    grouped = numbered.withColumn("_group", F.sum("_step").over(order))
    whole = Window.partitionBy(*branch, "_group")
    first, others = F.min("first").over(whole), F.sum("size").over(whole) - 1
    label = (
        F.when(F.bool_or("variable").over(whole), F.lit("*"))
        .when(others == 0, first)
        .otherwise(F.concat(F.lit("{"), first, F.lit("+"), others.cast("string"), F.lit("}")))
    )
    labels = grouped.select(*branch, "_x", "_y", label.alias("label"))
    return placed.join(labels, [*branch, "_x", "_y"]).select(*branch, "name", "label")


def template_table(grouped: DataFrame) -> DataFrame:
    """(host, shape, n, labelled, blocked, template) for ``grouped``, which has all but the last.

    Level by level: a branch is a host and the template so far. Where a branch can't be split, as its
    pages are few or all of a kind, the rest of every path becomes wildcards at once.
    """
    rows, parts, depth = grouped.withColumn("template", F.lit("")), [], 0
    most_of_a_kind = F.greatest(
        "blocked", F.col("labelled") - F.col("blocked"), F.col("n") - F.col("labelled")
    )
    while True:
        segment = F.get("shape", F.lit(depth))
        open_branches = (
            rows.where(segment.isNotNull())
            .groupBy("host", "template")
            .agg(*_sums())
            .where((F.col("n") >= LEAST_PAGES) & (most_of_a_kind < F.col("n")))
            .select("host", "template", F.lit(True).alias("open"))
        )
        # Written, as it is read several times by the next level, so the plans don't multiply.
        found = stage(rows.join(open_branches, ["host", "template"], "left"), "url-branches")
        splits = F.col("open").isNotNull() & segment.isNotNull()
        rest = F.repeat(F.lit("/*"), F.size("shape") - depth)
        parts.append(
            found.where(~splits).select(
                "host", "shape", *COUNTS, F.concat("template", rest).alias("template")
            )
        )
        rows = found.where(splits).drop("open").withColumn("segment", segment)
        if rows.isEmpty():
            break
        segments = rows.groupBy("host", "template", "segment").agg(*_sums())
        constant = ~F.col("segment").contains("#") & (F.col("n") >= LEAST_PAGES)
        named = stage(
            segments.withColumn("name", F.when(constant, F.col("segment")).otherwise(F.lit("*"))),
            "url-segments",
        )
        children = named.groupBy("host", "template", "name").agg(*_sums())
        labels = named.select("host", "template", "segment", "name").join(
            merged_branches(children), ["host", "template", "name"]
        )
        rows = stage(
            rows.join(labels, ["host", "template", "segment"]).select(
                "host", "shape", *COUNTS, F.concat("template", F.lit("/"), "label").alias("template")
            ),
            "url-level",
        )
        depth += 1
    return reduce(DataFrame.union, parts)


def templates(pages: DataFrame) -> DataFrame:
    """(host, shape, template, purity) from pages (host, path, label: 1 blocked, 0 allowed)."""
    grouped = stage(
        pages.groupBy("host", shapes(F.col("path")).alias("shape")).agg(
            F.count("*").alias("n"),
            F.count("label").alias("labelled"),
            F.coalesce(F.sum("label"), F.lit(0)).alias("blocked"),
        ),
        "url-shapes",
    )
    tree = template_table(grouped)
    # One row of totals.
    blocked, n = grouped.agg(F.sum("blocked"), F.sum("n")).first()
    share = (blocked or 0) / (n or 1)
    purity = (F.col("blocked") + WEIGHT * F.lit(share)) / (F.col("labelled") + WEIGHT)
    judged = tree.groupBy("host", "template").agg(*_sums()).select(
        "host", "template", purity.alias("purity")
    )
    return tree.select("host", "shape", "template").join(judged, ["host", "template"])


def judge(
    pages: DataFrame, rules: Sequence[Rule], url_col: str = "url", label: Column | None = None
) -> DataFrame:
    """``pages`` with host, path, rule, template, purity and verdict.

    ``label`` is 1 for pages that are known to be bad, 0 for good ones and null for others;
    by default it is what the rules say.
    """
    own = ["host", "path", "rule", "template", "purity", "verdict"]
    host, path = parts_of(F.col(url_col))
    base = pages.drop(*[c for c in own if c != url_col])
    bad = F.lit(None).cast("int") if label is None else label
    known = base.select(
        F.struct("*").alias("row"), host.alias("host"), path.alias("path"), bad.alias("label")
    ).withColumn("rule", rule_of(rules, F.col("host"), F.col("path")))
    if label is None:
        known = known.withColumn("label", (F.col("rule.verdict") == BLOCK).cast("int"))
    tree = stage(templates(known.select("host", "path", "label")), "url-verdicts")
    found = known.withColumn("shape", shapes(F.col("path"))).join(
        tree.select("host", "shape", "template", "purity"), ["host", "shape"], "left"
    )
    by_template = F.when(F.col("purity") >= LIMIT, F.lit(BLOCK)).otherwise(F.lit(ALLOW))
    return found.select(
        *[F.col(f"row.`{c}`") for c in base.columns],
        "host",
        "path",
        F.col("rule.pattern").alias("rule"),
        "template",
        "purity",
        F.coalesce("rule.verdict", by_template).alias("verdict"),
    )
