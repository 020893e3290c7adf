"""Language identification with interpolated Kneser-Ney character models.

Words are framed by spaces; a character's context is up to ORDER - 1 characters before it in
its word. Counts come from all training texts: words are counted by language first, and
n-grams from the counted words, so the heavy part is one grouping of words. Lower orders
count the distinct characters in front of an n-gram. Each language's model is a sorted array
of n-gram hashes with discounted probabilities, and one of context hashes with back-off
weights, looked up by binary search.

A text's cost is its mean cross-entropy per character, so long and short texts compare. The
language of least cost wins. Its confidence is calibrated: costs are standardised by the mean and
deviation of the language's training texts; ``rejected`` marks texts that cost far more than those.

Models hold every n-gram of the corpus under a hash of HASH_BITS bits and are written as one table.
One of up to BROADCAST_ENTRIES entries goes to all workers. A larger one stays with Spark: the n-grams
of the distinct words of the texts are joined to it, and their costs to the words of each text.

Defined cases: null texts and texts without a letter are ``und`` with score 0. Rows are judged one
by one: ties go to the first language in code-point order, repeated rows are judged alike, and
further columns, of any name, change nothing. Training rows without text or lang are left out;
without any every text is ``und``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelrank.llm.common import beside, parts
from reelrank.session import stage

ORDER, HASH_BITS, DISCOUNT = 4, 63, 0.75

#: Entries of all models together up to which they are sent to the workers, 16 bytes each; it decides
#: where costs are computed, not what they are.
BROADCAST_ENTRIES = 4_000_000

#: Characters that the lowest order takes as equally likely, and those that count as evidence.
UNIFORM, EVIDENCE = 2000, 30

#: Words that are costed or handed on together.
PART_WORDS = 20_000

#: Words whose costs a worker keeps, and standard deviations beyond which a text is rejected.
REMEMBERED, REJECT_AT = 300_000, 6.0

UNDETERMINED = "und"


#: What mostly surrounds words; stripping it is quicker than looking at every character.
_MARKS = ".,;:!?()\"'0123456789"


def cleaned(word: str) -> str:
    """The letters of a word in lower case; other characters are left out."""
    word = word.lower()
    if word.isalpha():
        return word
    bare = word.strip(_MARKS)
    return bare if bare.isalpha() else "".join(filter(str.isalpha, bare))


def split_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Where each text's words begin and the last ends, the number of each word, and the words."""
    lists = pa.compute.ascii_split_whitespace(pa.compute.fill_null(texts, ""))
    coded = lists.values.dictionary_encode()
    return lists.offsets.to_numpy(), coded.indices.to_numpy(), coded.dictionary.to_pylist()


def hash_codes(codes: np.ndarray, length: int) -> np.ndarray:
    """HASH_BITS-bit hashes of the ``length`` code points that end at each place."""
    h = np.full(len(codes) - length + 1, length, np.uint64)
    for k in range(length):
        h = (h ^ codes[k : k + len(h)]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return (h * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - HASH_BITS)


def codes_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the framed words one after the other, and the place of each in its word."""
    text = "".join([f" {w} " for w in words])
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    sizes = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    place = np.arange(len(codes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return codes, place


def word_counts(train: DataFrame) -> DataFrame:
    """(lang, word, n) over all rows of ``train`` (lang, text)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, dict[str, int]] = {}
        for batch in batches:
            for part in parts(batch, "text"):
                langs = part.column("lang")
                for lang in langs.unique().to_pylist():
                    own = part.column("text").filter(pa.compute.equal(langs, lang))
                    _, at, words = split_words(own)
                    uses = np.bincount(at, minlength=len(words)).tolist()
                    known = counts.setdefault(lang, {})
                    for word, n in zip(words, uses, strict=True):
                        known[word] = known.get(word, 0) + n
                if sum(map(len, counts.values())) >= REMEMBERED:
                    yield from counted(counts)
                    counts = {}
        yield from counted(counts)

    def counted(counts: dict[str, dict[str, int]]) -> Iterator[pa.RecordBatch]:
        for lang, known in counts.items():
            while known:
                rows = [known.popitem() for _ in range(min(len(known), PART_WORDS))]
                clean = [(c, n) for word, n in rows for c in (cleaned(word),) if c]
                words, uses = zip(*clean, strict=True) if clean else ((), ())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(clean), pa.string()),
                        pa.array(words, pa.string()),
                        pa.array(uses, pa.int64()),
                    ],
                    names=["lang", "word", "n"],
                )

    return (
        train.where("lang IS NOT NULL AND text IS NOT NULL")
        .select("lang", "text")
        .mapInArrow(count, "lang string, word string, n long")
        .groupBy("lang", "word")
        .agg(F.sum("n").alias("n"))
    )


def gram_counts(words: DataFrame) -> DataFrame:
    """(lang, gram, n): the longest n-grams, and shorter ones at the start of a word."""
    framed = words.select("lang", "n", F.concat(F.lit(" "), "word", F.lit(" ")).alias("w"))
    longest = F.when(
        F.length("w") >= ORDER,
        F.transform(
            F.sequence(F.lit(1), F.length("w") - ORDER + 1),
            lambda i: F.substring("w", i, F.lit(ORDER)),
        ),
    ).otherwise(F.array().cast("array<string>"))
    starts = F.array(*[F.substring("w", 1, k) for k in range(2, ORDER)])
    grams = framed.select("lang", "n", F.explode(F.concat(longest, starts)).alias("gram"))
    return grams.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def estimates(counted: DataFrame) -> DataFrame:
    """(lang, size, kind, key, value): discounted probabilities ("p") and back-offs ("b").

    Below the longest order an n-gram counts the distinct characters in front of it, and its uses
    where it starts a word, as nothing is in front of it there.
    """
    counted = stage(counted, "language-grams")
    here = counted.where(F.length("gram") == ORDER)
    parts = []
    for size in range(ORDER, 0, -1):
        here = here.withColumn("_h", F.substring("gram", 1, size - 1))
        contexts = here.groupBy("lang", "_h").agg(
            F.sum("n").alias("_sum"), F.count("*").alias("_types")
        )
        p = F.greatest(F.col("n") - DISCOUNT, F.lit(0.0)) / F.col("_sum")
        parts.append(
            here.join(contexts, ["lang", "_h"]).select(
                "lang", F.lit(size).alias("size"), F.lit("p").alias("kind"), "gram", p.alias("value")
            )
        )
        back = F.col("_types") * DISCOUNT / F.col("_sum")
        parts.append(
            contexts.select("lang", F.lit(size), F.lit("b"), F.col("_h"), back.alias("value"))
        )
        lower = here.groupBy("lang", F.expr("substring(gram, 2)").alias("gram")).agg(
            F.count("*").alias("n")
        )
        at_start = counted.where(F.length("gram") == size - 1) if size > 2 else None
        here = lower.where(~F.startswith("gram", F.lit(" "))) if size > 2 else lower
        here = here.union(at_start) if at_start is not None else here
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)

    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["key"] = [_key(g) for g in batch["gram"]]
            yield batch[["lang", "size", "kind", "key", "value"]]

    return out.mapInPandas(keyed, "lang string, size int, kind string, key long, value double")


def _key(gram: str) -> int:
    if not gram:
        return 0
    codes = np.frombuffer(gram.encode("utf-32-le"), np.uint32).astype(np.uint64)
    return int(hash_codes(codes, len(codes))[0])


@dataclass
class LanguageModel:
    """Sorted hashes with values, by order: n-gram probabilities and context back-offs."""

    grams: list[tuple[np.ndarray, np.ndarray]]
    contexts: list[tuple[np.ndarray, np.ndarray]]
    floor: float

    def cost(self, codes: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Negative log2 probability of each character; 0 for the first of a word."""
        p = np.full(len(codes), self.floor)
        for size in range(1, ORDER + 1):
            has = np.flatnonzero(place >= size - 1) if size > 1 else np.arange(len(codes))
            if not len(has):
                break
            start = has - size + 1
            seen = _lookup(self.grams[size - 1], hash_codes(codes, size)[start], 0.0)
            back = self.contexts[size - 1]
            if size > 1:
                weight = _lookup(back, hash_codes(codes, size - 1)[start], 1.0)
            else:
                weight = back[1]
            p[has] = seen + weight * p[has]
        out = -np.log2(np.maximum(p, 1e-12))
        out[place == 0] = 0.0
        return out


def _lookup(table: tuple[np.ndarray, np.ndarray], keys: np.ndarray, missing: float) -> np.ndarray:
    hashes, values = table
    if not len(hashes):
        return np.full(len(keys), missing)
    at = np.minimum(np.searchsorted(hashes, keys), len(hashes) - 1)
    return np.where(hashes[at] == keys, values[at], missing)


class Models(Mapping):
    """The models of all languages: a written table, and a language's arrays when asked for."""

    def __init__(self, entries: DataFrame):
        self.entries = entries
        sizes = entries.groupBy("lang").count().collect()
        self.sizes = {r["lang"]: r["count"] for r in sorted(sizes, key=lambda r: r["lang"])}
        self._loaded: dict[str, LanguageModel] = {}

    def __iter__(self) -> Iterator[str]:
        return iter(self.sizes)

    def __len__(self) -> int:
        return len(self.sizes)

    def __getitem__(self, lang: str) -> LanguageModel:
        if lang not in self.sizes:
            raise KeyError(lang)
        if lang not in self._loaded:
            own = self.entries.where(F.col("lang") == lang).drop("lang")
            own = own.toArrow().to_pandas().sort_values("key")
            tables = {
                kind: [
                    (part["key"].to_numpy(np.uint64), part["value"].to_numpy(np.float64))
                    for size in range(1, ORDER + 1)
                    for part in (own[(own["kind"] == kind) & (own["size"] == size)],)
                ]
                for kind in "pb"
            }
            self._loaded[lang] = LanguageModel(tables["p"], tables["b"], 1.0 / UNIFORM)
        return self._loaded[lang]


def learn(train: DataFrame) -> Models:
    """A model per language from all rows of ``train`` (lang, text)."""
    return Models(stage(estimates(gram_counts(word_counts(train))), "language-models"))


class HashRows:
    """Rows of distinct 63-bit hashes, found through their leading bits."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.append(keys, np.uint64(1 << HASH_BITS))
        self.shift = np.uint64(max(0, HASH_BITS - max(1, (2 * len(keys)).bit_length())))
        buckets = np.arange(1 << (HASH_BITS - int(self.shift)), dtype=np.uint64) << self.shift
        self.first = np.searchsorted(keys, buckets)

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """The row of each key, or the number of rows where there is none."""
        rows = np.full(len(wanted), len(self.keys) - 1)
        at, open_ = self.first[wanted >> self.shift], np.arange(len(wanted))
        while len(open_):
            here = self.keys[at]
            same = here == wanted
            rows[open_[same]] = at[same]
            on = here < wanted
            open_, at, wanted = open_[on], at[on] + 1, wanted[on]
        return rows


class JointModel:
    """The models of all languages side by side: one search finds an n-gram in all of them.

    For each length the rows hold the n-gram's probabilities and, as it is the context of the next
    order, its back-offs; the last row stands for n-grams that are in no model.
    """

    def __init__(self, models: list[LanguageModel]):
        self.floor = np.array([m.floor for m in models])
        # The empty context.
        self.back = np.array([m.contexts[0][1][0] for m in models])
        self.orders = []
        for size in range(1, ORDER + 1):
            own = [m.grams[size - 1] for m in models]
            context = [m.contexts[size] if size < ORDER else None for m in models]
            every = [t[0] for t in (*own, *context) if t is not None]
            keys = np.unique(np.concatenate(every))
            p = np.zeros((len(keys) + 1, len(models)))
            b = np.ones((len(keys) + 1, len(models)))
            for k, (grams, contexts) in enumerate(zip(own, context, strict=True)):
                p[np.searchsorted(keys, grams[0]), k] = grams[1]
                if contexts is not None:
                    b[np.searchsorted(keys, contexts[0]), k] = contexts[1]
            self.orders.append((HashRows(keys), p, b))

    def cost(self, codes: np.ndarray, place: np.ndarray) -> np.ndarray:
        """``LanguageModel.cost`` of every model, a column for each."""
        p = np.repeat(self.floor[None, :], len(codes), axis=0)
        weight = self.back
        for size, (rows, own, back) in enumerate(self.orders, 1):
            last = np.flatnonzero(place >= size - 1)
            if not len(last):
                break
            found = rows.find(hash_codes(codes, size)[last - size + 1])
            p[last] = own[found] + (weight[last - 1] if size > 1 else weight) * p[last]
            weight = np.ones_like(p)
            weight[last] = back[found]
        out = -np.log2(np.maximum(p, 1e-12))
        out[place == 0] = 0.0
        return out


class Scorer:
    """Costs of words under every model; words are costed once while remembered."""

    def __init__(self, models: dict[str, LanguageModel]):
        self.models = list(models.values())
        self.joint = JointModel(self.models) if self.models else None
        self.forget()

    def forget(self) -> None:
        # The first row is for what has no letters.
        self.place: dict[str, int] = {"": 0}
        self.costs = np.zeros((1, len(self.models)))
        self.sizes = np.zeros(1, np.int64)
        self.uses = np.zeros(1, np.int64)

    def forget_rare(self) -> None:
        """Keeps the words that came in more than one part, if they are few enough."""
        often = [w for w, k in self.place.items() if self.uses[k] > 1]
        rows = np.array([self.place[w] for w in often], np.int64)
        costs, sizes = self.costs, self.sizes
        self.forget()
        if len(often) <= REMEMBERED // 2:
            self.place.update((w, k) for k, w in enumerate(often, 1) if w)
            self.costs = np.concatenate([self.costs, costs[rows]])
            self.sizes = np.concatenate([self.sizes, sizes[rows]])
            self.uses = np.zeros(len(self.costs), np.int64)

    def learn_words(self, words: list[str]) -> None:
        unknown = [w for w in words if w not in self.place]
        clean = list(map(cleaned, unknown))
        new = [(w, c) for w, c in zip(unknown, clean, strict=True) if c]
        if len(new) < len(unknown):
            self.place.update((w, 0) for w, c in zip(unknown, clean, strict=True) if not c)
        for lo in range(0, len(new), PART_WORDS):
            part = new[lo : lo + PART_WORDS]
            codes, place = codes_of([c for _, c in part])
            starts = np.flatnonzero(place == 0)
            costs = np.zeros((len(part), len(self.models)))
            if self.joint is not None:
                costs = np.add.reduceat(self.joint.cost(codes, place), starts, axis=0)
            self.place.update((w, len(self.costs) + k) for k, (w, _) in enumerate(part))
            self.costs = np.concatenate([self.costs, costs])
            self.sizes = np.concatenate([self.sizes, [len(c) + 1 for _, c in part]])
            self.uses = np.concatenate([self.uses, np.zeros(len(part), np.int64)])

    def score(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Bits of each text under each model, and its characters."""
        bounds, at, words = split_words(texts)
        if len(self.place) > REMEMBERED:
            self.forget_rare()
        self.learn_words(words)
        rows = np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))
        self.uses[rows] += 1
        rows = rows[at]
        # A text without words has no sum of its own.
        some = np.flatnonzero(np.diff(bounds))
        bits, sizes = np.zeros((len(texts), len(self.models))), np.zeros(len(texts), np.int64)
        if len(some):
            bits[some] = np.add.reduceat(self.costs[rows], bounds[some], axis=0)
            sizes[some] = np.add.reduceat(self.sizes[rows], bounds[some])
        return bits, sizes


def identify(
    docs: DataFrame,
    models: Models,
    id_col: str = "doc_id",
    text_col: str = "text",
    entries: int = BROADCAST_ENTRIES,
) -> DataFrame:
    """(doc_id, lang_pred, cost, score) of every text, before rejection.

    ``score`` is the winner's posterior over at most EVIDENCE characters at the text's mean costs.
    Models of more than ``entries`` entries are joined instead of sent to the workers.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"))
    if sum(models.sizes.values()) > entries:
        return _identify_joined(texts, models)
    shared = docs.sparkSession.sparkContext.broadcast(dict(models))

    def work() -> Callable:
        scorer, names = Scorer(shared.value), np.array([*shared.value, UNDETERMINED], object)
        return lambda part: (None, _verdicts(*scorer.score(part), names))

    return beside(texts, ["doc_id"], "_text", VERDICT, work)


def gram_costs(grams: DataFrame, models: Models) -> DataFrame:
    """(gram, bits): the cost of the last character of each n-gram under every model.

    ``grams`` (gram) are distinct and have the longest context that there is. Endings of one
    character are costed first, then those of two, each from its own ending: a row meets at most
    as many others as there are characters, so no ending or context is a hot key.
    """
    names = list(models)
    # One row of values for an n-gram, in the order of the languages.
    by_lang = [F.max(F.when(F.col("lang") == n, F.col("value"))) for n in names]
    entries = stage(
        models.entries.groupBy("size", "kind", "key").agg(F.array(*by_lang).alias("values")),
        "language-rows",
    )
    empty = entries.where("size = 1 AND kind = 'b'").first()["values"]

    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["_p"] = [_key(g) for g in batch["gram"]]
            batch["_b"] = [_key(g[:-1]) for g in batch["gram"]]
            yield batch

    before, found = None, []
    for size in range(1, ORDER + 1):
        ends = grams.where(F.length("gram") >= size).select(F.right("gram", F.lit(size)).alias("gram"))
        rows = ends.distinct().mapInPandas(keyed, "gram string, _p long, _b long")
        for kind in "pb" if size > 1 else "p":
            own = entries.where((F.col("size") == size) & (F.col("kind") == kind))
            own = own.select(F.col("key").alias(f"_{kind}"), F.col("values").alias(kind))
            rows = rows.join(own, f"_{kind}", "left")
        if size > 1:
            shorter = before.select(F.col("gram").alias("_end"), F.col("p").alias("_before"))
            rows = rows.withColumn("_end", F.expr("substring(gram, 2)")).join(shorter, "_end")
        p = [
            F.coalesce(F.col("p")[k], F.lit(0.0))
            + (F.coalesce(F.col("b")[k], F.lit(1.0)) if size > 1 else F.lit(empty[k]))
            * (F.col("_before")[k] if size > 1 else F.lit(1.0 / UNIFORM))
            for k in range(len(names))
        ]
        before = stage(rows.select("gram", F.array(*p).alias("p")), "language-endings")
        found.append(before.join(grams.where(F.length("gram") == size), "gram"))
    every = reduce(DataFrame.union, found)
    bits = F.transform("p", lambda v: -F.log2(F.greatest(v, F.lit(1e-12))))
    return every.select("gram", bits.alias("bits"))


def _identify_joined(texts: DataFrame, models: Models) -> DataFrame:
    """``identify`` by joins: texts to words, words to n-grams, n-grams to the models."""
    names = list(models)
    rows = stage(texts.withColumn("_row", F.monotonically_increasing_id()), "language-texts")

    def words_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch, "_text"):
                bounds, at, words = split_words(part.column("_text"))
                row = np.repeat(np.arange(len(part)), np.diff(bounds))
                clean = [cleaned(w) for w in words]
                own, n = np.unique(row * len(words) + at, return_counts=True)
                has = np.array([bool(c) for c in clean], bool)[own % max(1, len(words))]
                own, n = own[has], n[has]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("_row").take(pa.array(own // max(1, len(words)))),
                        pa.array(clean, pa.string()).take(pa.array(own % max(1, len(words)))),
                        pa.array(n),
                    ],
                    names=["_row", "word", "n"],
                )

    used = stage(
        rows.select("_row", "_text")
        .mapInArrow(words_of, "_row long, word string, n long")
        .groupBy("_row", "word")
        .agg(F.sum("n").alias("n")),
        "language-words",
    )
    framed = F.concat(F.lit(" "), "word", F.lit(" "))
    grams = F.transform(
        F.sequence(F.lit(2), F.length("word") + 2),
        lambda i: F.substring(framed, F.greatest(i - (ORDER - 1), F.lit(1)), F.least(i, F.lit(ORDER))),
    )
    uses = stage(
        used.select("word").distinct().select("word", F.explode(grams).alias("gram")),
        "language-uses",
    )

    def added(weight: Column) -> Column:
        return F.array(*[F.sum(F.col("bits")[k] * weight) for k in range(len(names))])

    costs = uses.join(gram_costs(uses.select("gram").distinct(), models), "gram")
    costs = costs.groupBy("word").agg(added(F.lit(1.0)).alias("bits"))
    totals = (
        used.join(costs, "word")
        .groupBy("_row")
        .agg(
            added(F.col("n")).alias("bits"),
            F.sum(F.col("n") * (F.length("word") + 1)).alias("size"),
        )
    )

    def work() -> Callable:
        known, none = np.array([*names, UNDETERMINED], object), [0.0] * len(names)

        def judge(_: pa.Array, found: pa.Array, sizes: pa.Array) -> tuple[None, list]:
            bits = np.array([none if b is None else b for b in found.to_pylist()], float)
            whole = pa.compute.fill_null(sizes, 0).to_numpy(zero_copy_only=False)
            return None, _verdicts(bits, whole, known)

        return judge

    found = rows.select("_row", "doc_id").join(totals, "_row", "left")
    found = found.withColumn("_text", F.lit(None).cast("string"))
    return beside(found, ["doc_id"], "_text", VERDICT, work, ["bits", "size"])


#: What is found about a text.
VERDICT = {"lang_pred": "string", "cost": "double", "score": "double"}


def _verdicts(bits: np.ndarray, sizes: np.ndarray, names: np.ndarray) -> list:
    """The columns of VERDICT."""
    if bits.shape[1] == 0:
        nothing = np.zeros(len(bits))
        return [[UNDETERMINED] * len(bits), nothing, nothing]
    costs = bits / np.maximum(sizes, 1)[:, None]
    best = costs.argmin(axis=1)
    least = costs.min(axis=1)
    weight = np.minimum(sizes, EVIDENCE)[:, None]
    posterior = 1.0 / np.exp2((least[:, None] - costs) * weight).sum(axis=1)
    known = sizes > 0
    return [
        names[np.where(known, best, len(names) - 1)],
        np.where(known, least, 0.0),
        np.where(known, posterior, 0.0),
    ]


def calibrated(found: DataFrame, training: DataFrame) -> DataFrame:
    """``found`` with ``rejected``: costs far above those of the language's training texts.

    ``training`` holds (lang_pred, cost) of training texts; its summary has a row per language.
    """
    usual = training.where(F.col("lang_pred") != UNDETERMINED).groupBy("lang_pred").agg(
        F.avg("cost").alias("_mean"), F.stddev_pop("cost").alias("_deviation")
    )
    far = F.col("cost") > F.col("_mean") + REJECT_AT * F.greatest("_deviation", F.lit(0.05))
    return (
        found.join(usual, "lang_pred", "left")
        .withColumn("rejected", F.coalesce(far, F.col("lang_pred") == UNDETERMINED))
        .drop("_mean", "_deviation")
    )
