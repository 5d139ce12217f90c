"""Language by cross-parsing: the language whose text spells a document in the fewest phrases.

Each language keeps a bounded text and its suffix automaton. A document is read as the greedy sequence of the
longest phrases that occur in that text; with the text's length as the cost of naming a place in it, phrases times
log2(length) per letter estimates the cross entropy, and the cheapest language wins.

Automata of all languages are one table of transitions. A document is cut into pieces of SEGMENT letters, each a
parse of its own, and thousands of pieces of many documents take a step together for all languages at once.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import labelled_sample, small_batches
from .textbatch import slices

UNDETERMINED = "und"
SEGMENT = 256
#: Letters of a language that have a code of their own, its most frequent ones; its others share one.
LETTERS = 240
#: The bounded sample: so many distinct texts of a language, so many characters of each.
TEXTS, CHARS = 64, 400
#: Lanes of one step.
_LANES = 4096


@dataclass(frozen=True)
class LanguageModel:
    """Labelled text per language, ``texts[i]`` for ``languages[i]``."""

    languages: tuple[str, ...]
    texts: tuple[str, ...]


def fit(docs: DataFrame, label: str = "lang", text: str = "text", texts: int = TEXTS, chars: int = CHARS) -> LanguageModel:
    """Learn from ``texts`` texts of ``chars`` characters per label, chosen by hash; labels without letters go."""
    sample = labelled_sample(docs, label, text, texts, chars)
    known = {name: " ".join(parts) for name, parts in sorted(sample.items()) if any(map(str.isalpha, "".join(parts)))}
    return LanguageModel(tuple(known), tuple(known.values()))


@lru_cache(maxsize=1)
def _is_letter() -> np.ndarray:
    return np.fromiter((c.isalpha() for c in map(chr, range(0x110000))), bool, 0x110000)


def _suffix_automaton(codes: list[int], width: int) -> np.ndarray:
    """Transitions (states x width, -1 for none) of the automaton of all substrings; state 0 is the start."""
    moves = np.full((2 * len(codes) + 1, width), -1, np.int32)
    link, size, last = [-1], [0], 0
    for c in codes:
        new = len(link)
        size.append(size[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and moves[p, c] < 0:
            moves[p, c] = new
            p = link[p]
        if p >= 0:
            q = int(moves[p, c])
            if size[p] + 1 == size[q]:
                link[new] = q
            else:
                clone = len(link)
                moves[clone] = moves[q]
                size.append(size[p] + 1)
                link.append(link[q])
                while p >= 0 and moves[p, c] == q:
                    moves[p, c] = clone
                    p = link[p]
                link[q] = link[new] = clone
        last = new
    return moves[: len(link)]


# Codes of a language: a run without letters, a letter of its text beyond its alphabet, a letter that its text lacks; the
# letters of its alphabet follow, and last comes padding.
_GAP, _RARE, _ABSENT, _FIRST = range(4)


class _Parser:
    """Automata of all languages in one table, each over its own alphabet.

    A text is first coded by the letters of all languages together: 0 any run without letters, 1 a letter that none
    has; ``own`` turns that into a language's code. A cell holds the next state's row, or its complement if the phrase
    ends before this letter, which then begins the next one. A letter that the language's text lacks is a phrase of its
    own: the state after it has no moves.
    """

    def __init__(self, model: LanguageModel):
        texts = [text.lower() for text in model.texts]
        held = [Counter(filter(str.isalpha, text)) for text in texts]
        letters = sorted(set().union(*held))
        self.code = np.zeros(0x110000, np.uint32)
        self.code[_is_letter()] = 1
        self.code[[ord(c) for c in letters]] = np.arange(len(letters)) + 2
        self.padding = len(letters) + 2
        self.own = np.full((len(texts), len(letters) + 3), _ABSENT, np.int32)
        self.own[:, 0] = _GAP
        starts, tables, base, bits = [], [], 0, []
        for k, (text, found) in enumerate(zip(texts, held)):
            alphabet = sorted(found, key=lambda c: (-found[c], c))
            for n, c in enumerate(alphabet):
                self.own[k, self.code[ord(c)]] = n + _FIRST if n < LETTERS else _RARE
            width = min(len(alphabet), LETTERS) + _FIRST + 1
            self.own[k, -1] = width - 1
            codes = self.own[k, self._codes([text])[0]]
            moves = _suffix_automaton(codes.tolist(), width)
            moves = np.vstack([moves, np.full((1, width), -1, np.int32)])
            first = np.where(moves[0] >= 0, moves[0], len(moves) - 1) * width + base
            rows = np.where(moves >= 0, moves * width + base, ~first)
            rows[0] = first  # only a piece begins here, and no phrase ends
            rows[:, -1] = np.arange(len(moves)) * width + base
            tables.append(rows.ravel())
            starts.append(base)
            bits.append(math.log2(len(codes) + 1))
            base += rows.size
        if base >= 1 << 31:
            raise ValueError("the automata of all languages hold over two billion transitions: take fewer texts or characters")
        self.table = np.concatenate(tables).astype(np.int32)
        self.starts, self.bits = np.array(starts, np.int32), np.array(bits)

    def _codes(self, low: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Common codes of all texts, runs without letters as one, and where each text begins."""
        ends = np.concatenate(([0], np.cumsum([len(t) for t in low])))
        codes = self.code[np.frombuffer("".join(low).encode("utf-32-le"), np.uint32)]
        keep = codes > 0
        if len(codes):
            keep[1:] |= codes[:-1] > 0
            keep[0] = True
            keep[ends[:-1][ends[:-1] < len(codes)]] = True
        return codes[keep], np.concatenate(([0], np.cumsum(keep)))[ends]

    def phrases(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Phrases (languages x texts), codes and letters of each text."""
        codes, at = self._codes([t.lower() for t in texts])
        n = np.diff(at)
        pieces = -(-n // SEGMENT)
        owner = np.repeat(np.arange(len(texts)), pieces)
        begin = at[owner] + (np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * SEGMENT
        length = np.minimum(begin + SEGMENT, at[owner + 1]) - begin
        order = np.argsort(-length, kind="stable")
        total = np.zeros((len(self.starts), len(texts)))
        for k in range(0, len(order), _LANES):
            lanes = order[k : k + _LANES]
            counted = self._run(codes, begin[lanes], length[lanes])
            for i, row in enumerate(counted):
                total[i] += np.bincount(owner[lanes], row, minlength=len(texts))
        letters = np.concatenate(([0], np.cumsum(codes > 0)))
        return total, n, letters[at[1:]] - letters[at[:-1]]

    def _run(self, codes: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
        steps = int(length.max())
        places = begin[None, :] + np.arange(steps)[:, None]
        letter = np.where(np.arange(steps)[:, None] < length, codes[np.minimum(places, len(codes) - 1)], self.padding).astype(np.intp)
        state = np.repeat(self.starts[:, None], len(begin), axis=1)
        ended = np.ones_like(state)  # the phrase that the piece ends in
        cell, sign = np.empty_like(state), np.empty_like(state)
        own = np.empty_like(state)
        for row in letter:
            np.take(self.own, row, axis=1, out=own, mode="clip")
            np.add(state, own, out=state)
            np.take(self.table, state, out=cell, mode="clip")
            np.right_shift(cell, 31, out=sign)
            np.subtract(ended, sign, out=ended)
            np.bitwise_xor(cell, sign, out=state)
        return ended


@lru_cache(maxsize=2)
def _parser(model: LanguageModel) -> _Parser:
    return _Parser(model)


def predict(model: LanguageModel, texts: list[str]) -> tuple[list[str], np.ndarray]:
    """The language of every text and its share of the likelihood, 2 to the minus bits, of all languages."""
    if not model.languages:
        return [UNDETERMINED] * len(texts), np.zeros(len(texts))
    parser = _parser(model)
    phrases, _, letters = parser.phrases(texts)
    bits = phrases * parser.bits[:, None]
    best = bits.argmin(axis=0)
    share = 1 / np.exp2(np.maximum(bits.min(axis=0) - bits, -1000)).sum(axis=0)
    names = [model.languages[b] if n else UNDETERMINED for b, n in zip(best, letters)]
    return names, np.where(letters > 0, share, 0.0)


def identify(docs: DataFrame, model: LanguageModel, text: str = "text", language: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` with the predicted language and its score from 0 to 1; columns of these names are replaced.

    Null texts and texts without a letter are ``und`` with score 0. Equally cheap languages go to the first by name.
    The whole text is parsed.
    """

    small_batches(docs.sparkSession)

    @F.arrow_udf("struct<language:string,score:double>")
    def named(texts: pa.Array) -> pa.Array:
        names, shares = [], []
        for _, part in slices(texts):
            a, b = predict(model, part.to_pylist())
            names += a
            shares.append(b)
        values = [pa.array(names, pa.string()), pa.array(np.concatenate(shares) if shares else np.empty(0), pa.float64())]
        return pa.StructArray.from_arrays(values, names=["language", "score"])

    # a filter on the result must not evaluate the function once more
    found = docs.select("*", named.asNondeterministic()(F.col(text).cast("string")).alias("__language"))
    return found.withColumns({language: F.col("__language.language"), score: F.col("__language.score")}).drop("__language")
