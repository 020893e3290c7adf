"""Toxicity: a learnt lexicon, fuzzy matching, and windows that tell quotation from abuse.

1. A term enters the lexicon if it occurs in too many different contexts of toxic
   documents to be chance (Chernoff bound over all words seen). Contexts are
   neighbouring words, so copies of one document count once. Stems that several
   words share are tested in the same way and match any ending.
2. The lexicon is a trie. A Levenshtein automaton of one edit (or swap of neighbours)
   walks it for each distinct word, so misspelled terms are found.
3. Around every hit a window of words is searched for quotation marks. How much a
   hit is worth, exact or misspelled, quoted or not, is estimated from labelled
   texts; a document's score is the chance that at least one of its hits is abuse.

Learning uses a bounded, documented sample of labelled rows; scoring covers all
rows and whole texts, in place, without a shuffle.

Defined cases: null and empty texts score 0. Rows are scored one by one, so repeated
rows, ties and further columns, of any name, change nothing. Without toxic labels
the lexicon is empty and every score is 0.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelrank.llm.common import beside, fold, labelled_sample
from reelrank.session import stage

#: Labelled rows that learning looks at, at most.
SAMPLE_ROWS = 20_000

#: Words on either side of a hit that are searched for quotation marks.
CONTEXT = 12

#: Shortest term that is matched with an edit, and words that a worker keeps.
FUZZY_LENGTH, REMEMBERED = 4, 300_000

#: Lengths of stems, longest first, and the toxic words that a stem needs.
STEMS, STEM_WORDS = (6, 5, 4), 3

#: Terms that are toxic in a smaller share of their documents are weak.
LEAST_WORTH = 0.8

#: Chance that any word of the sample enters the lexicon without being toxic.
ERROR_RATE = 0.01

#: Opening and closing quotation marks.
OPENING, CLOSING = "\"“„«‹‘'", "\"”“»›’'"


class Trie:
    """Terms as nested dictionaries; the empty key holds a term at its end."""

    def __init__(self, terms):
        self.root: dict = {}
        self.heads: set[str] = set()
        self.tails: set[str] = set()
        for term in terms:
            node = self.root
            for letter in term:
                node = node.setdefault(letter, {})
            node[""] = term
            if len(term) >= FUZZY_LENGTH:
                self._add_halves(term)
        self.head_sizes = sorted({len(h) for h in self.heads})
        self.tail_sizes = sorted({len(t) for t in self.tails})

    def _add_halves(self, term: str) -> None:
        """One edit leaves the first or the last half of a term as it is."""
        m = len(term) // 2
        swapped = term[: m - 1] + term[m] + term[m - 1] + term[m + 1 :]
        for form in (term, swapped):
            self.heads.add(form[:m])
            self.tails.add(form[m:])

    def exact(self, word: str) -> str | None:
        node = self.root
        for letter in word:
            node = node.get(letter)
            if node is None:
                return None
        return node.get("")

    def nearest(self, word: str) -> str | None:
        """The first term, in alphabetical order, that one edit or swap turns into ``word``."""
        if len(word) < FUZZY_LENGTH - 1 or not (
            any(word[:k] in self.heads for k in self.head_sizes)
            or any(word[-k:] in self.tails for k in self.tail_sizes)
        ):
            return None
        found: list[str] = []
        # States of the automaton: how far each prefix of the word is from the trie's path.
        first = list(range(len(word) + 1))
        for letter, node in self.root.items():
            self._walk(node, letter, "", word, first, None, found)
        return min(found) if found else None

    def _walk(self, node, letter, before, word, row, row_before, found) -> None:
        here = [row[0] + 1]
        for k, other in enumerate(word, 1):
            cost = min(here[k - 1] + 1, row[k] + 1, row[k - 1] + (letter != other))
            swap = row_before is not None and k > 1 and letter == word[k - 2]
            if swap and before == other:
                cost = min(cost, row_before[k - 2] + 1)
            here.append(cost)
        term = node.get("")
        if term is not None and here[-1] <= 1 and len(term) >= FUZZY_LENGTH:
            found.append(term)
        if min(here) <= 1:
            for following, child in node.items():
                if following:
                    self._walk(child, following, letter, word, here, row, found)


@dataclass
class Model:
    """Terms and the chance that a hit of each kind is abuse."""

    terms: list[str] = field(default_factory=list)
    exact: dict[str, float] = field(default_factory=dict)
    fuzzy: dict[str, float] = field(default_factory=dict)
    quoted: float = 0.3


def cleaned(raw: bytes) -> str:
    """A word in lower case without what surrounds its letters and digits."""
    word = raw.decode("utf-8", "replace").lower()
    lo, hi = 0, len(word)
    while lo < hi and not word[lo].isalnum():
        lo += 1
    while hi > lo and not word[hi - 1].isalnum():
        hi -= 1
    return word[lo:hi]


class Matcher(dict):
    """Raw word to (term, is exact) or None; computed once while remembered."""

    def __init__(self, terms):
        super().__init__()
        self.trie = Trie([t for t in terms if not t.endswith("*")])
        self.stems = {t for t in terms if t.endswith("*")}

    def find(self, word: str):
        term = self.trie.exact(word)
        if term is None:
            term = next((s for k in STEMS if (s := word[:k] + "*") in self.stems), None)
        if term is not None:
            return term, True
        term = self.trie.nearest(word)
        return None if term is None else (term, False)

    def __missing__(self, raw: bytes):
        if len(self) >= REMEMBERED:
            self.clear()
        word = cleaned(raw)
        match = self[raw] = self.find(word) if word else None
        return match


def is_quoted(words: list[bytes], at: int) -> bool:
    """Whether marks open before a word and close after it, within the window."""
    own = words[at].decode("utf-8", "replace")
    opens = own[:1] in OPENING or any(
        w.decode("utf-8", "replace")[:1] in OPENING for w in words[max(0, at - CONTEXT) : at]
    )
    if not opens:
        return False
    before = [w.decode("utf-8", "replace") for w in words[max(0, at - CONTEXT) : at]]
    depth = 0
    for word in [*before, own]:
        depth += bool(word) and word[0] in OPENING
        if word is not own:
            depth -= bool(word) and len(word) > 1 and word.rstrip(".,;:!?")[-1:] in CLOSING
    after = [own, *(w.decode("utf-8", "replace") for w in words[at + 1 : at + 1 + CONTEXT])]
    return depth > 0 and any(w.rstrip(".,;:!?")[-1:] in CLOSING for w in after if w)


def hits(text: str | None, matcher: Matcher) -> list[tuple[str, bool, bool]]:
    """(term, is exact, is quoted) of every matching word of a text."""
    words = (text or "").encode("utf-8").split()
    matching = {w for w in set(words) if matcher[w] is not None}
    if not matching:
        return []
    return [(*matcher[w], is_quoted(words, k)) for k, w in enumerate(words) if w in matching]


def score(found: list[tuple[str, bool, bool]], model: Model) -> float:
    """Chance that one of the hits is abuse; repeats of a hit count once.

    Weak terms often come together in clean texts, so of their hits the best one counts, by half.
    """
    clean, weak = 1.0, 0.0
    for term, exact, quoted in set(found):
        worth = (model.exact if exact else model.fuzzy).get(term, 0.0)
        worth *= model.quoted if quoted else 1.0
        if model.exact.get(term, 0.0) >= LEAST_WORTH:
            clean *= 1.0 - worth
        else:
            weak = max(weak, worth / 2)
    return max(1.0 - clean, weak)


def learn(
    docs: DataFrame,
    labels: DataFrame,
    rows: int = SAMPLE_ROWS,
    folds: int = 5,
    held_out: int = 0,
) -> Model:
    """Fits a model to labelled documents outside the held-out fold."""
    known = labels.where(fold("doc_id", folds) != held_out)
    sample = labelled_sample(docs, known, "toxic", rows).select("label", "text")
    model = Model()
    counted = stage(_word_contexts(sample), "toxicity-words")
    totals = counted.agg(F.sum("toxic"), F.sum("clean"), F.count("*")).first()
    if not totals[0] or not totals[1]:
        return model
    base, words = totals[0] / (totals[0] + totals[1]), totals[2]
    evidence = math.log(words / ERROR_RATE)
    stems = counted.select(
        F.explode(F.array(*[F.substring("word", 1, k) for k in STEMS])).alias("stem"),
        "word",
        "toxic",
        "clean",
    ).where(F.length("word") > F.length("stem"))
    stems = (
        stems.where(F.length("stem") >= STEMS[-1])
        .distinct()
        .groupBy(F.concat("stem", F.lit("*")).alias("word"))
        .agg(
            F.sum("toxic").alias("toxic"),
            F.sum("clean").alias("clean"),
            F.count_if(F.col("toxic") > F.col("clean")).alias("_words"),
        )
        .where(F.col("_words") >= STEM_WORDS)
        .drop("_words")
    )
    # At most a few rows per word of the bounded sample.
    for r in counted.union(stems).where("toxic >= 3 AND toxic >= 4 * clean").collect():
        n, share = r["toxic"] + r["clean"], min(0.999, r["toxic"] / (r["toxic"] + r["clean"]))
        if share <= base:
            continue
        apart = share * math.log(share / base) + (1 - share) * math.log((1 - share) / (1 - base))
        if n * apart >= evidence:
            model.terms.append(r["word"])
    model.terms.sort()
    _weigh(sample, model)
    return model


def _word_contexts(sample: DataFrame) -> DataFrame:
    """(word, toxic, clean): contexts in toxic texts and in others."""

    def contexts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = set()
            for label, text in zip(batch["label"], batch["text"], strict=True):
                words = [cleaned(w) for w in (text or "").encode("utf-8").split()]
                padded = ["", *words, ""]
                for k, word in enumerate(words):
                    if word:
                        near = f"{padded[k]} {padded[k + 2]}"
                        found.add((word, label, xxhash.xxh64_intdigest(near) >> 1))
            yield pd.DataFrame(list(found), columns=["word", "label", "near"])

    return (
        sample.mapInPandas(contexts, "word string, label int, near long")
        .distinct()
        .groupBy("word")
        .agg(F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("clean"))
    )


def _weigh(sample: DataFrame, model: Model) -> None:
    """Estimates from the sample what hits are worth; each document counts once a kind."""
    terms = model.terms

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matcher = Matcher(terms)
        for batch in batches:
            rows = [
                (term, exact, quoted, label)
                for label, text in zip(batch["label"], batch["text"], strict=True)
                for term, exact, quoted in set(hits(text, matcher))
            ]
            yield pd.DataFrame(rows, columns=["term", "exact", "quoted", "label"])

    kinds = (
        sample.mapInPandas(find, "term string, exact boolean, quoted boolean, label int")
        .groupBy("term", "exact", "quoted")
        .agg(F.sum("label").alias("toxic"), F.count("*").alias("n"))
        .collect()
    )
    plain: dict[tuple[str, bool], list[int]] = {}
    quoted_toxic = quoted_n = 0
    for r in kinds:
        if r["quoted"]:
            quoted_toxic, quoted_n = quoted_toxic + r["toxic"], quoted_n + r["n"]
        else:
            seen = plain.setdefault((r["term"], r["exact"]), [0, 0])
            seen[0], seen[1] = seen[0] + r["toxic"], seen[1] + r["n"]
    for term in terms:
        toxic, n = plain.get((term, True), (0, 0))
        worth = (toxic + 1) / (n + 1.5)
        model.exact[term] = worth
        toxic, n = plain.get((term, False), (0, 0))
        # A misspelling is never worth more than the term itself.
        model.fuzzy[term] = min(worth, (toxic + 1.8) / (n + 3))
    model.quoted = (quoted_toxic + 3) / (quoted_n + 10)


def score_texts(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, score, n_hits, terms) for every row of ``docs``."""

    def work() -> Callable:
        matcher = Matcher(model.terms)

        def judge(texts: pa.Array) -> tuple[None, list]:
            found = [hits(text, matcher) for text in texts.to_pylist()]
            terms = [sorted({term for term, _, _ in f}) for f in found]
            return None, [[score(f, model) for f in found], [len(f) for f in found], terms]

        return judge

    named = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"))
    fields = {"score": "double", "n_hits": "long", "terms": "array<string>"}
    return beside(named, ["doc_id"], "_text", fields, work)


def keep_clean(docs: DataFrame, model: Model, limit: float = 0.5, text_col: str = "text"):
    """The rows of ``docs`` that score below ``limit``, with their own columns."""

    def work() -> Callable:
        matcher = Matcher(model.terms)

        def keep(texts: pa.Array) -> tuple[list[int], list]:
            scores = [score(hits(t, matcher), model) for t in texts.to_pylist()]
            return [k for k, s in enumerate(scores) if s < limit], []

        return keep

    return beside(docs, docs.columns, text_col, {}, work)
