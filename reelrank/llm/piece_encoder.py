"""SentencePiece merge-type (BPE) encoding by backtracking, and decoding.

The encoder never replays the merges of a text. It takes the longest piece at a
position (all matches come from one Aho-Corasick pass), accepts it if merging the
two neighbours' characters again gives exactly these two pieces, else tries the
next shorter piece, and steps back when none is left. A bitfield marks positions
from which the rest can't be encoded, so every position fails at most once.

Two facts of the vocabulary keep the units short: a space mark occurs only at the
start of a piece or in runs of marks, and characters that no piece holds next to each
other are never merged. Texts are cut there, and a worker remembers recent units.
Vocabularies without the first property are encoded in one unit per text.

Defined cases: a null text is encoded as the empty text, without ids. Characters
outside the vocabulary become byte pieces, or the unknown id if there are none.
Very long units need memory in proportion to their length. Repeated rows give
repeated results, and further columns, of any name, are not touched.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Sequence
from copy import copy
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelrank.llm.common import beside

#: Fixed value: the character that stands for a space.
MARK = "▁"

#: Encoded units, each of under LONG characters, and pairs of pieces that a task keeps; it starts anew
#: when there are more. Together they take some 300 MB at most.
REMEMBERED, REMEMBERED_PAIRS = 600_000, 300_000

#: Parts of so many characters are cut further and not remembered.
LONG = 100


class Vocabulary(NamedTuple):
    """What encoding and decoding need of a model: pieces, scores, and special ids."""

    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    byte_ids: tuple[int, ...]
    plain: tuple[bool, ...]
    unknown: int

    @classmethod
    def load(cls, model_file: str) -> Vocabulary:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        ids = range(model.get_piece_size())
        pieces = tuple(model.id_to_piece(i) for i in ids)
        place = {p: i for i, p in enumerate(pieces)}
        byte_ids = tuple(place.get(f"<0x{b:02X}>", -1) for b in range(256))
        plain = tuple(
            not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i)) for i in ids
        )
        scores = tuple(model.get_score(i) for i in ids)
        bytes_known = all(i >= 0 for i in byte_ids)
        return cls(pieces, scores, byte_ids if bytes_known else (), plain, model.unk_id())


#: An encoded part of a text: the number of its ids, the ids with commas, the decoded text.
#: A plain tuple of plain values, which Python's garbage collector need not walk.
Unit = tuple[int, str, str]


class PieceEncoder:
    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        plain = [(p, i) for i, p in enumerate(vocabulary.pieces) if vocabulary.plain[i]]
        self.ids = dict(plain)
        self.score = {p: vocabulary.scores[i] for p, i in plain}
        lowest = min(self.score.values(), default=0.0)
        words = [p for p in self.ids if p.strip(MARK)]
        self.run_lengths = {len(p) for p in self.ids if not p.strip(MARK)}
        # Runs of marks are then merged after all else, as their score is the lowest.
        self.by_units = (
            all(self.score[MARK * n] == lowest for n in self.run_lengths if n > 1)
            and all(self.score[p] > lowest for p in words if len(p) > 1)
            and all(MARK not in p[1:] for p in words)
        )
        line_ends_merge = any("\n" in p for p in self.ids)
        self.parts = _PARTS if line_ends_merge else _LINE_PARTS
        self.mergeable = {p[k : k + 2] for p in self.ids for k in range(len(p) - 1)}
        self.byte_of = {i: b for b, i in enumerate(vocabulary.byte_ids)}
        # What each id decodes to; None for bytes, which are joined first.
        self.texts = [
            None if i in self.byte_of else p.replace(MARK, " ") if vocabulary.plain[i] else ""
            for i, p in enumerate(vocabulary.pieces)
        ]
        self.texts[vocabulary.unknown] = " ⁇ "
        self.compatible: dict[tuple[str, str], bool] = {}
        self.units: dict[str, Unit] = {}
        self.matcher = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for piece in self.ids:
            whole_runs = self.by_units and len(piece) > 1 and not piece.strip(MARK)
            if len(piece) > 1 and not whole_runs and self.merge(piece) == [piece]:
                self.matcher.add_word(piece, len(piece))
        self.has_matcher = len(self.matcher) > 0
        if self.has_matcher:
            self.matcher.make_automaton()

    def forgetful(self) -> PieceEncoder:
        """The same encoder with nothing remembered; its memory goes with it."""
        fresh = copy(self)
        fresh.compatible, fresh.units = {}, {}
        return fresh

    def merge(self, text: str) -> list[str]:
        """The pieces of a short text by the merges themselves: best score, then leftmost."""
        parts, score, none = list(text), self.score.get, float("-inf")
        pairs = [score(a + b, none) for a, b in zip(parts, parts[1:], strict=False)]
        while pairs and (best := max(pairs)) > none:
            k = pairs.index(best)
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
            del pairs[k]
            if k:
                pairs[k - 1] = score(parts[k - 1] + parts[k], none)
            if k < len(pairs):
                pairs[k] = score(parts[k] + parts[k + 1], none)
        return parts

    def fits(self, left: str, right: str) -> bool:
        """Whether merging the characters of both again leaves exactly these two pieces."""
        if left[-1] + right[0] not in self.mergeable:
            return True
        known = self.compatible.get((left, right))
        if known is None:
            if len(self.compatible) > REMEMBERED_PAIRS:
                self.compatible.clear()
            known = self.compatible[left, right] = self.merge(left + right) == [left, right]
        return known

    def backtrack(self, text: str) -> list[str]:
        """Pieces of ``text``, each the longest that fits its left neighbour and the rest."""
        end = len(text)
        if end == 1:
            return [text]
        # Lengths of the pieces at each position, ascending; single characters always match.
        lengths: list[list[int]] = [[1] for _ in range(end)]
        if self.has_matcher:
            for last, n in self.matcher.iter(text):
                lengths[last - n + 1].append(n)
        failed = bytearray(end // 8 + 1)
        path: list[tuple[int, list[int]]] = []
        at, before, options = 0, "", lengths[0][:]
        while at < end:
            while options:
                after = at + options.pop()
                piece = text[at:after]
                if failed[after >> 3] >> (after & 7) & 1:
                    continue
                if not before or self.fits(before, piece):
                    path.append((at, options))
                    at, before = after, piece
                    options = lengths[at][:] if at < end else []
                    break
            else:
                if not path:
                    return self.merge(text)
                failed[at >> 3] |= 1 << (at & 7)
                at, options = path.pop()
                before = text[path[-1][0] : at] if path else ""
        starts = [start for start, _ in path] + [end]
        return [text[a:b] for a, b in zip(starts, starts[1:], strict=False)]

    def cut(self, text: str) -> list[str]:
        """``text`` in parts between which nothing merges."""
        parts, start = [], 0
        for k in range(1, len(text)):
            if text[k - 1 : k + 1] not in self.mergeable:
                parts.append(text[start:k])
                start = k
        parts.append(text[start:])
        return parts

    def to_ids(self, pieces: list[str]) -> list[int]:
        out: list[int] = []
        for piece in pieces:
            known = self.ids.get(piece)
            if known is not None:
                out.append(known)
            elif self.vocabulary.byte_ids:
                out.extend(self.vocabulary.byte_ids[b] for b in piece.encode("utf-8"))
            else:
                out.append(self.vocabulary.unknown)
        return out

    def spaces(self, run: int) -> list[str]:
        """A run of marks; as all its merges score the same, the leftmost comes first."""
        stack: list[int] = []
        for _ in range(run):
            stack.append(1)
            while len(stack) > 1 and stack[-2] + stack[-1] in self.run_lengths:
                last = stack.pop()
                stack[-1] += last
        return [MARK * n for n in stack]

    def pieces_of(self, text: str) -> list[str]:
        parts = [text] if len(text) < LONG else self.cut(text)
        return [p for part in parts for p in self.backtrack(part)]

    def unit(self, marked: str) -> Unit:
        """Encodes a run of marks and what follows it up to the next mark."""
        word = marked.lstrip(MARK)
        run = len(marked) - len(word)
        pieces: list[str] = []
        if word:
            pieces = self.pieces_of(MARK + word if run else word)
            if run and pieces[0] == MARK:
                pieces = pieces[1:]
            elif run:
                run -= 1
        return self.packed(self.spaces(run) + pieces if run else pieces)

    def packed(self, pieces: list[str]) -> Unit:
        ids = self.to_ids(pieces)
        return len(ids), ",".join(map(str, ids)), self.decode(ids)

    def encode(self, text: str | None) -> list[Unit]:
        if not text:
            return []
        marked = MARK + text.replace(" ", MARK)
        if not self.by_units:
            return [self.packed(self.pieces_of(marked))]
        units, known = [], self.units
        for part in self.parts.findall(marked):
            unit = known.get(part)
            if unit is None:
                if len(known) >= REMEMBERED:
                    known.clear()
                unit = self.unit(part)
                if len(part) < LONG:
                    known[part] = unit
            units.append(unit)
        return units

    def decode(self, ids: Sequence[int]) -> str:
        """The text of some ids, its leading mark still a space."""
        texts = [self.texts[i] for i in ids]
        if None not in texts:
            return "".join(texts)
        out, raw = [], bytearray()
        for i, text in zip(ids, texts, strict=True):
            if text is None:
                raw.append(self.byte_of[i])
                continue
            if raw:
                out.append(raw.decode("utf-8", "replace"))
                raw.clear()
            out.append(text)
        if raw:
            out.append(raw.decode("utf-8", "replace"))
        return "".join(out)


#: Marks and what follows them; where no piece holds a line end, texts are cut there too.
_PARTS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
_LINE_PARTS = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n+")

_ENCODERS: dict[int, PieceEncoder] = {}


def encoder(vocabulary: Vocabulary) -> PieceEncoder:
    """This worker's encoder."""
    key = hash(vocabulary)
    if key not in _ENCODERS:
        _ENCODERS[key] = PieceEncoder(vocabulary)
    return _ENCODERS[key]


def without_first_space(text: str) -> str:
    return text[1:] if text.startswith(" ") else text


def encode_texts(
    docs: DataFrame,
    vocabulary: Vocabulary,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = True,
    with_text: bool = True,
) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, ids, decoded) of every whole text.

    ``with_ids`` and ``with_text`` ask for the last two where digests don't do. The vocabulary, of fixed
    size, is broadcast; rows are encoded where they are, without a shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    fields = {"n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string"}
    fields |= {"ids": "array<int>"} if with_ids else {}
    fields |= {"decoded": "string"} if with_text else {}

    def work() -> Callable:
        coder = encoder(shared.value).forgetful()

        def encode(texts: pa.Array) -> tuple[None, list]:
            rows: list[list] = [[] for _ in fields]
            for text in texts.to_pylist():
                units = coder.encode(text)
                ids = ",".join([u[1] for u in units])
                decoded = without_first_space("".join([u[2] for u in units]))
                row = [
                    sum([u[0] for u in units]),
                    hashlib.sha256(ids.encode()).hexdigest(),
                    hashlib.sha256(decoded.encode("utf-8")).hexdigest(),
                ]
                if with_ids:
                    row.append(np.array(ids.split(","), np.int32) if ids else [])
                if with_text:
                    row.append(decoded)
                for column, value in zip(rows, row, strict=True):
                    column.append(value)
            return None, rows

        return encode

    named = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"))
    return beside(named, ["doc_id"], "_text", fields, work)
