"""Quality classifier: a factorisation machine over hashed words, structure and metadata.

A document is a sparse vector: its distinct words, hashed to WORD_SLOTS places and scaled to
unit length, and one place for the bin of each structure statistic and of the length in the
metadata. The score is the logistic function of

    w0 + sum_i w_i x_i + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)

whose last part weighs all pairs of features by products of low-rank factors in time linear in the
features. It is fitted with AdaGrad to a bounded, documented sample of labelled rows; scoring covers
all rows and whole texts in place, without a shuffle. The model has a fixed size.

Defined cases: null texts count as empty; empty texts have a score from their structure alone, and
a null or missing length has no feature. Rows are scored one by one, so repeated rows, ties and
further columns, of any name, change nothing. Without labels of both kinds all scores are the share of
label 1 (0.5 if there are none).
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelrank.llm.common import beside, fold, labelled_sample

#: Labelled rows that fitting looks at, at most.
SAMPLE_ROWS = 8_000

WORD_SLOTS, BINS, RANK = 1 << 14, 8, 6
EPOCHS, BATCH, RATE, DECAY, SEED = 8, 128, 0.1, 1e-4, 7

#: Word places that a worker keeps.
REMEMBERED = 600_000

#: The structure statistics, in order, and the metadata; each has BINS places after the words.
STATISTICS = (
    "words", "word_length", "upper", "symbols", "exclamations", "digits", "stops",
    "distinct_words", "repeats_next", "lines", "distinct_lines", "meta_length",
)
SIZE = WORD_SLOTS + BINS * len(STATISTICS)

_CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "symbols": b"#*$%&|<>",
    "exclamations": b"!",
    "digits": b"0123456789",
    "stops": b".,;:?",
}
_MEMBERS = {name: np.frombuffer(chars, np.uint8) for name, chars in _CLASSES.items()}


def _share_bin(part: float, whole: float) -> int:
    """Bins of a share, finer near 0: 0, up to 1/64, 1/32, ... and above 1/2."""
    if part <= 0 or whole <= 0:
        return 0
    return min(BINS - 1, max(1, 7 + math.floor(math.log2(min(1.0, part / whole)) + 1e-9)))


def _size_bin(size: float) -> int:
    return min(BINS - 1, int(math.log2(size + 1) / 2))


class Places(dict):
    """Words to hashed places, computed once while remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word) % WORD_SLOTS
        return value


def features(text: str | None, length: float | None, places: Places) -> np.ndarray:
    """Places of a document's features: its word places, each once, then its statistics."""
    raw = (text or "").encode("utf-8")
    words = raw.lower().split()
    chars = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    counts = {name: int(chars[members].sum()) for name, members in _MEMBERS.items()}
    lines = [line for line in raw.split(b"\n") if line]
    distinct = set(words)
    same = sum([a == b for a, b in zip(words, words[1:], strict=False)])
    ink = sum(map(len, words))
    bins = [
        _size_bin(len(words)),
        min(BINS - 1, int(ink / len(words) / 2)) if words else 0,
        _share_bin(counts["upper"], counts["upper"] + counts["lower"]),
        _share_bin(counts["symbols"], ink),
        _share_bin(counts["exclamations"], ink),
        _share_bin(counts["digits"], ink),
        _share_bin(counts["stops"], ink),
        _share_bin(len(distinct), len(words)),
        _share_bin(same, len(words)),
        _size_bin(len(lines)),
        _share_bin(len(set(lines)), len(lines)),
    ]
    if length is not None and length == length and length >= 0:
        bins.append(_size_bin(length))
    own = np.unique(np.fromiter((places[w] for w in distinct), np.int32, len(distinct)))
    at = np.array([WORD_SLOTS + BINS * k + b for k, b in enumerate(bins)], np.int32)
    return np.concatenate([own, at])


def values(at: np.ndarray) -> np.ndarray:
    """Words share a length of one; statistics count one each."""
    is_word = at < WORD_SLOTS
    return np.where(is_word, 1.0 / math.sqrt(max(1, int(is_word.sum()))), 1.0)


@dataclass
class Machine:
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def margin(self, at: np.ndarray) -> float:
        x = values(at)
        v = self.factors[at] * x[:, None]
        pairs = 0.5 * float((v.sum(axis=0) ** 2).sum() - (v**2).sum())
        return self.bias + float(self.weights[at] @ x) + pairs

    def score(self, at: np.ndarray) -> float:
        return 1.0 / (1.0 + math.exp(-max(-35.0, min(35.0, self.margin(at)))))


def fit(rows: list[np.ndarray], labels: np.ndarray) -> Machine:
    """AdaGrad over shuffled batches with a fixed seed; rows in any fixed order."""
    share = float(labels.mean()) if len(labels) else 0.5
    rng = np.random.default_rng(SEED)
    machine = Machine(
        math.log((share + 1e-3) / (1 - share + 1e-3)),
        np.zeros(SIZE),
        rng.normal(0.0, 0.05, (SIZE, RANK)),
    )
    if not len(labels) or not 0.0 < share < 1.0:
        machine.factors[:] = 0.0
        return machine
    w_seen, v_seen, b_seen = np.full(SIZE, 1e-6), np.full((SIZE, RANK), 1e-6), 1e-6
    xs = [values(at) for at in rows]
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for lo in range(0, len(order), BATCH):
            chosen = order[lo : lo + BATCH]
            at = np.concatenate([rows[k] for k in chosen])
            x = np.concatenate([xs[k] for k in chosen])
            sizes = np.array([len(rows[k]) for k in chosen])
            starts, owner = np.cumsum(sizes) - sizes, np.repeat(np.arange(len(chosen)), sizes)
            vx = machine.factors[at] * x[:, None]
            sums = np.add.reduceat(vx, starts)
            linear = np.add.reduceat(machine.weights[at] * x, starts)
            squares = np.add.reduceat((vx**2).sum(axis=1), starts)
            margin = machine.bias + linear + 0.5 * ((sums**2).sum(axis=1) - squares)
            off = (1 / (1 + np.exp(-np.clip(margin, -35, 35))) - labels[chosen]) / len(chosen)
            slope = off[owner] * x
            places, index = np.unique(at, return_inverse=True)
            w_grad = np.bincount(index, slope, len(places)) + DECAY * machine.weights[places]
            v_slope = slope[:, None] * (sums[owner] - vx)
            v_grad = np.stack(
                [np.bincount(index, v_slope[:, f], len(places)) for f in range(RANK)], axis=1
            )
            v_grad += DECAY * machine.factors[places]
            w_seen[places] += w_grad**2
            v_seen[places] += v_grad**2
            b_seen += off.sum() ** 2
            machine.weights[places] -= RATE * w_grad / np.sqrt(w_seen[places])
            machine.factors[places] -= RATE / 2 * v_grad / np.sqrt(v_seen[places])
            machine.bias -= RATE * off.sum() / math.sqrt(b_seen)
    return machine


def learn(
    docs: DataFrame,
    labels: DataFrame,
    rows: int = SAMPLE_ROWS,
    folds: int = 4,
    held_out: int = 2,
    meta_col: str | None = "n_chars",
) -> Machine:
    """Fits a machine to labelled documents outside the held-out fold."""
    known = labels.where(fold("doc_id", folds) != held_out)
    meta = F.col(meta_col) if meta_col else F.lit(None)
    texts = docs.select("doc_id", F.struct(F.col("text"), meta.cast("double").alias("m")).alias("t"))
    sample = labelled_sample(texts, known, "quality", rows, "t")

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        places = Places()
        for batch in batches:
            found = [
                features(t, m, places) for t, m in zip(batch["text"], batch["m"], strict=True)
            ]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "label": batch["label"], "at": found})

    id_type = docs.schema["doc_id"].dataType.simpleString()
    known_rows = (
        sample.select("doc_id", "label", "text.text", "text.m")
        .mapInPandas(extract, f"doc_id {id_type}, label int, at array<int>")
        .toArrow()
        .to_pandas()
    )
    # A fixed order, so that reruns agree.
    known_rows["key"] = [len(at) for at in known_rows["at"]]
    known_rows = known_rows.sort_values(["doc_id", "key", "label"])
    rows_at = [np.asarray(at, np.int32) for at in known_rows["at"]]
    return fit(rows_at, known_rows["label"].to_numpy(np.float64))


def score_texts(
    docs: DataFrame,
    machine: Machine,
    id_col: str = "doc_id",
    text_col: str = "text",
    meta_col: str | None = "n_chars",
) -> DataFrame:
    """(doc_id, score) for every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def work() -> Callable:
        own, places = shared.value, Places()

        def judge(texts: pa.Array, metas: pa.Array) -> tuple[None, list]:
            rows = zip(texts.to_pylist(), metas.to_pylist(), strict=True)
            return None, [[own.score(features(t, m, places)) for t, m in rows]]

        return judge

    meta = F.col(meta_col) if meta_col else F.lit(None)
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(text_col).alias("_text"),
        meta.cast("double").alias("_meta"),
    )
    return beside(rows, ["doc_id"], "_text", {"score": "double"}, work, ["_meta"])
