"""Quality rules: a threshold table compiled into one projection.

Each rule is a row (name, measure, lowest, highest); the measures are ratios of
counts that built-in functions take from the text. A document is kept if no rule
and no base limit is broken.

Repeated windows are found by sorting 64-bit hashes of five consecutive words with
their positions, only in texts that have any; the covered words are the gaps
between consecutive positions, five at most.

Defined cases: a null or empty text has no words and fails the base limit; ratios
over no words or lines are 0 and a rule never fails on a null. Repeated rows are
judged alike, and further columns, of any name, pass through beside the result
only where a caller joins them.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelrank.llm.common import WORD

WINDOW = 5


class Rule(NamedTuple):
    """Keeps values from ``lowest`` to ``highest``; None is open."""

    name: str
    measure: str
    lowest: float | None
    highest: float | None


#: The thresholds, in the order in which a failure is named.
RULES = (
    Rule("word_length", "mean_word_chars", 1.5, 16.0),
    Rule("symbols", "symbols_per_word", None, 0.2),
    Rule("shouting", "shouts_per_word", None, 0.2),
    Rule("repeated_lines", "dup_line_share", None, 0.5),
    Rule("stop_words", "stop_word_share", 0.02, None),
)

#: Frequent function words of the four languages.
STOP_WORDS = (
    "the of and to in a is was for on that by with as it at from are be this an or "
    "der die und den von zu das mit sich des auf für ist im dem nicht ein eine als auch "
    "de la le et les des en un une du que est pour qui dans par sur au plus avec "
    "el los las y se por con una su para es al lo como o no"
).split()


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document with the counts and ratios that rules refer to."""
    text = F.coalesce(F.col("_text"), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(text_col).alias("_text"),
        F.regexp_extract_all(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD), F.lit(0)).alias(
            "_words"
        ),
    )
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD))
    lowered = F.transform("_words", lambda w: F.lower(w))
    rows = rows.select(
        "doc_id",
        F.size("_words").cast("long").alias("n_words"),
        F.char_length(F.regexp_replace(text, r"[\x20\x09-\x0D]+", "")).cast("long").alias(
            "word_chars"
        ),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count(text, F.lit(r"!")).cast("long").alias("_shouts"),
        F.size(F.filter(lowered, lambda w: w.isin(STOP_WORDS))).alias("_stops"),
        lines.alias("_lines"),
        F.transform("_words", lambda w: F.xxhash64(w)).alias("_hashes"),
    )
    at = lambda i, k: F.get("_hashes", (i + k).cast("int"))
    starts = F.when(
        F.size("_hashes") >= WINDOW, F.sequence(F.lit(0), F.size("_hashes") - WINDOW)
    ).otherwise(F.array().cast("array<int>"))
    rows = rows.select(
        *[c for c in rows.columns if c not in ("_hashes", "_lines")],
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.transform(starts, lambda i: F.xxhash64(*[at(i, k) for k in range(WINDOW)])).alias(
            "_windows"
        ),
    )
    return rows.select(
        *[c for c in rows.columns if c != "_windows"],
        F.when(F.size(F.array_distinct("_windows")) == F.size("_windows"), F.lit(0))
        .otherwise(_covered(F.col("_windows")))
        .cast("long")
        .alias("n_repeat_words"),
    ).select(
        "*",
        _ratio("word_chars", "n_words").alias("mean_word_chars"),
        _ratio("n_symbols", "n_words").alias("symbols_per_word"),
        _ratio("_shouts", "n_words").alias("shouts_per_word"),
        _ratio("n_dup_lines", "n_lines").alias("dup_line_share"),
        _ratio("_stops", "n_words").alias("stop_word_share"),
    ).drop("_shouts", "_stops")


def _ratio(part: str, whole: str) -> Column:
    return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(F.lit(0.0))


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, although ``use`` names it in a lambda."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _covered(windows: Column) -> Column:
    """Words that lie in windows which occur at least twice."""
    placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def repeated(sorted_windows: Column) -> Column:
        def twin(e: Column, i: Column) -> Column:
            before, after = F.get(sorted_windows, i - 1), F.get(sorted_windows, i + 1)
            return F.coalesce(e["h"] == before["h"], F.lit(False)) | F.coalesce(
                e["h"] == after["h"], F.lit(False)
            )

        return F.sort_array(F.transform(F.filter(sorted_windows, twin), lambda e: e["i"]))

    def reach(starts: Column) -> Column:
        gaps = F.transform(
            starts,
            lambda s, i: F.least(
                F.lit(WINDOW), F.coalesce(F.get(starts, i + 1) - s, F.lit(WINDOW))
            ),
        )
        return F.aggregate(gaps, F.lit(0), lambda total, gap: total + gap)

    return _let(_let(placed, repeated), reach)


def failures(rules: Sequence[Rule] = RULES) -> Column:
    """Names of the broken rules, as one array expression."""
    broken = []
    for rule in rules:
        value, fails = F.col(rule.measure), F.lit(False)
        if rule.lowest is not None:
            fails = fails | (value < rule.lowest)
        if rule.highest is not None:
            fails = fails | (value > rule.highest)
        broken.append(F.when(F.coalesce(fails, F.lit(False)), F.lit(rule.name)))
    return F.array_compact(F.array(*broken))


def judge(
    docs: DataFrame,
    rules: Sequence[Rule] = RULES,
    least_words: int = 10,
    repeat_percent: int = 20,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Measures, ``base_failed``, ``failed_rules`` and ``kept`` for every document."""
    base = (F.col("n_words") < least_words) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * repeat_percent
    )
    return (
        measures(docs, id_col, text_col)
        .withColumn("base_failed", base)
        .withColumn("failed_rules", failures(rules))
        .withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
    )
