"""Toxicity by a weighted finite-state grammar over clauses.

A clause is read as a string of symbols: insult, threat, target (who is addressed or spoken of), negation, reported
speech, other. Four transducers each rewrite the insults and threats they see: a target makes a match *aimed*, a
negation within reach *denied*, a verb of speaking before it *reported*. Their composition is one machine, built once;
what it emits for a clause is its matches with their readings. The lexicon of insults, stems as well as whole words,
and the weight of each reading are learned from a bounded sample of labelled rows.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import product

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import small_batches
from .textbatch import slices

#: Fixed word lists of the grammar.
THREAT = "kill hurt destroy burn stab shoot strangle beat murder töten umbringen schlagen tuer frapper matar golpear".split()
TARGET = "you your yours youre u he she him her they them his du dich dir dein ihr euch sie ihn tu toi te vous vos il elle tú usted vosotros él ella ellos".split()
NEGATION = "not no never dont isnt arent without nicht kein keine nie pas jamais aucun nunca ni sin".split()
REPORTED = "said says say quote quoted wrote claimed told according sagte sagt laut dit selon dijo dice según".split()

#: Bounded sample: so many labelled rows of each class.
ROWS = 2000
STEMS = range(3, 10)
ENTRIES = 400
#: Toxic rows an entry is in at least, and the natural logarithm of how much likelier it is there.
SUPPORT, ODDS = 6, 2.5
THRESHOLD = 0.3

_WORD = re.compile(r"[^\W\d_]+")
# A colon goes on to what is said.
_CLAUSE = re.compile(r"[^.!?;\n]+")


@dataclass(frozen=True)
class Transducer:
    """Deterministic, from (state, symbol) to (state, emitted symbol); symbols without an arc pass and keep the state."""

    arcs: dict
    start: object = 0

    def step(self, state, symbol):
        return self.arcs.get((state, symbol), (state, symbol))

    def states(self) -> set:
        return {self.start, *(s for s, _ in self.arcs), *(t for t, _ in self.arcs.values())}


def compose(first: Transducer, second: Transducer, symbols: set[str]) -> Transducer:
    """The machine that feeds what ``first`` emits to ``second``."""
    arcs = {}
    for (a, b), s in product(product(first.states(), second.states()), symbols):
        to_a, mid = first.step(a, s)
        to_b, out = second.step(b, mid)
        if ((to_a, to_b), out) != ((a, b), s):
            arcs[(a, b), s] = ((to_a, to_b), out)
    return Transducer(arcs, (first.start, second.start))


#: Insult and threat, then the readings a match may get: a(imed), d(enied), r(eported).
_MATCH = ("I", "T")
_INPUT = {*_MATCH, "Y", "N", "R", "."}
_MARKED = {m + "".join(k) for m in _MATCH for k in product(("", "a"), ("", "d"), ("", "r"))}
#: Words a negation reaches.
REACH = 3


def _matches(mark: str) -> set[str]:
    return {m for m in _MARKED if mark not in m}


def _marked(symbol: str, mark: str) -> str:
    return symbol[0] + "".join(k for k in "adr" if k in symbol[1:] or k == mark)


@lru_cache(maxsize=1)
def grammar() -> Transducer:
    """target, negation and reported speech, composed."""
    target = Transducer({(0, "Y"): (1, "Y")} | {(1, m): (1, _marked(m, "a")) for m in _matches("a")})
    negation = {(0, "N"): (REACH, "N")}
    for left in range(1, REACH + 1):
        negation |= {(left, s): (left - 1, s) for s in ("Y", "R", ".")} | {(left, "N"): (REACH, "N")}
        negation |= {(left, m): (left - 1, _marked(m, "d")) for m in _matches("d")}
    reported = Transducer({(0, "R"): (1, "R")} | {(1, m): (1, _marked(m, "r")) for m in _matches("r")})
    symbols = _INPUT | _MARKED
    return compose(compose(target, Transducer(negation), symbols), reported, symbols)


#: Features of a document: the weight of all matches of each reading, then :meth:`_Reader.features` of the whole.
READINGS = tuple(sorted(_MARKED))


def _sense(reading: str) -> float:
    """What a match counts by its reading: a threat denied or told of, or without a target, not at all.

    Words of the learned lexicon insult wherever they stand; a denial or a report takes less from them.
    """
    if reading[0] == "I":
        return 1.0 * (0.6 if "d" in reading else 1) * (0.6 if "r" in reading else 1)
    return float(reading == "Ta")


SENSES = {reading: _sense(reading) for reading in READINGS}


@dataclass(frozen=True)
class ToxicityModel:
    """Weights of lexicon entries (a stem, or a whole word marked with a closing ``$``) and of the features."""

    lexicon: tuple[tuple[str, float], ...]
    weights: tuple[float, ...] = field(default=())


class _Reader:
    def __init__(self, lexicon):
        self.entries = dict(lexicon)
        self.longest = max(map(len, self.entries), default=0)
        self.classes = {w: s for words, s in ((TARGET, "Y"), (NEGATION, "N"), (REPORTED, "R"), (THREAT, "T")) for w in words}
        self.spots = ahocorasick.Automaton()
        for entry in [*(e.rstrip("$") for e in self.entries), *THREAT]:
            self.spots.add_word(entry, len(entry))
        if len(self.spots):
            self.spots.make_automaton()
        self.machine = grammar()

    def weight(self, word: str) -> float:
        """The heaviest entry the word is, or begins with."""
        found = self.entries.get(word + "$", 0.0)
        for n in range(min(len(word), self.longest), 0, -1):
            found = max(found, self.entries.get(word[:n], 0.0))
        return found

    def features(self, text: str) -> np.ndarray:
        """Weights of all matched clauses by reading; then what the readings count a thousand words, the heaviest insult,
        and if there is one."""
        out = np.zeros(len(READINGS) + 3)
        low = text.lower()
        if not len(self.spots):
            return out
        hits = []
        for end, n in self.spots.iter(low):
            begin = end - n + 1
            if begin == 0 or not low[begin - 1].isalpha():
                hits.append(begin)
        if not hits:
            return out
        clauses = [(m.start(), m.end()) for m in _CLAUSE.finditer(low)]
        starts = [a for a, _ in clauses]
        for k in sorted({bisect_right(starts, h) - 1 for h in hits}):
            self._read(low[clauses[k][0] : clauses[k][1]], out)
        out[-3] *= 1000 / (len(low) / 6 + 20)
        out[-1] = float(out[-2] > 0)
        return out

    def _read(self, clause: str, out: np.ndarray) -> None:
        words = _WORD.findall(clause)
        weights = [self.weight(w) for w in words]
        symbols = ["I" if x > 0 else self.classes.get(w, ".") for w, x in zip(words, weights)]
        ahead, behind = self._emitted(symbols), self._emitted(symbols[::-1])[::-1]
        for a, b, x in zip(ahead, behind, weights):
            if a[0] in _MATCH:
                # a target counts on either side; negation and reported speech come before
                reading = _marked(a, "a") if "a" in b[1:] else a
                out[READINGS.index(reading)] += x if x > 0 else 1.0
                out[-3] += SENSES[reading]
                out[-2] = max(out[-2], x)

    def _emitted(self, symbols: list[str]) -> list[str]:
        state, out = self.machine.start, []
        for s in symbols:
            state, emitted = self.machine.step(state, s)
            out.append(emitted)
        return out


@lru_cache(maxsize=2)
def _reader(lexicon) -> _Reader:
    return _Reader(lexicon)


def _scores(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(np.log1p(x) @ weights[1:] + weights[0], -30, 30)))


def _features(lexicon, text):
    @F.arrow_udf("array<double>")
    def read(texts: pa.Array) -> pa.Array:
        reader = _reader(lexicon)
        return pa.array([reader.features(t) for _, part in slices(texts) for t in part.to_pylist()], pa.list_(pa.float64()))

    return read(text.cast("string"))


def _prior() -> np.ndarray:
    """Weights before any label: readings the sample hardly shows keep the sense the grammar gives them."""
    def of(reading: str) -> float:
        weight = 1.0 if reading[0] == "I" else 3.0 if "a" in reading else 0.5
        return weight * (1.6 if "a" in reading else 1) * (0.4 if "d" in reading else 1) * (0.5 if "r" in reading else 1)

    return np.array([-3.0, *map(of, READINGS), 0.0, 0.0, 0.0])


def _logistic(x: np.ndarray, y: np.ndarray, rounds: int = 25, ridge: float = 0.05) -> np.ndarray:
    """Newton's method on the log-likelihood, held to the prior by ``ridge``."""
    x = np.column_stack([np.ones(len(x)), np.log1p(x)])
    prior = _prior()
    w = prior.copy()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        w = w + np.linalg.solve(hessian, x.T @ (y - p) - ridge * (w - prior))
    return w


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", rows: int = ROWS) -> ToxicityModel:
    """Learn from whole texts of ``rows`` rows per class, chosen by hash of the id; without both classes, nothing is.

    ``labels`` (doc_id, label 0 or 1). The driver gets ids and labels of the sample, its candidate entries and features.
    """
    small_batches(docs.sparkSession)
    known = labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("y")).where("id is not null and y in (0, 1)").distinct()
    known = known.withColumn("h", F.xxhash64("id"))
    chosen = known.where("y = 0").orderBy("h").limit(rows).union(known.where("y = 1").orderBy("h").limit(rows)).collect()
    total = [sum(r["y"] == k for r in chosen) for k in (0, 1)]
    if not min(total):
        return ToxicityModel(())
    ids = docs.sparkSession.createDataFrame([(r["id"], r["y"]) for r in chosen], "id long, y int")
    sample = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("t")).join(F.broadcast(ids), "id")
    words = sample.select("id", "y", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("t"), F.lit(r"(\p{L}+)")))).alias("w"))
    lengths = F.filter(F.array(*map(F.lit, STEMS)), lambda n: n <= F.length("w"))
    stems = F.concat(F.array(F.concat("w", F.lit("$"))), F.transform(lengths, lambda n: F.substring(F.col("w"), F.lit(1), n)))
    entries = words.where(F.length("w") >= STEMS.start).select("id", "y", F.explode(stems).alias("e")).distinct()
    counts = entries.groupBy("e").agg(F.sum("y").alias("bad"), F.count("*").alias("n")).where(F.col("bad") >= SUPPORT)
    odds = F.log((F.col("bad") + 0.5) / (total[1] + 1)) - F.log((F.col("n") - F.col("bad") + 0.5) / (total[0] + 1))
    best = counts.select("e", odds.alias("odds"), "bad").where(F.col("odds") >= ODDS).orderBy(F.desc("bad"), F.length("e"), "e").limit(ENTRIES)
    lexicon = tuple(sorted((r["e"], float(r["odds"])) for r in best.collect()))
    read = sample.select("y", _features(lexicon, F.col("t")).alias("x")).collect()
    x, y = np.array([r["x"] for r in read]), np.array([r["y"] for r in read], float)
    return ToxicityModel(lexicon, tuple(_logistic(x, y)))


def score(docs: DataFrame, model: ToxicityModel, text: str = "text", column: str = "score") -> DataFrame:
    """``docs`` with the probability of toxicity of the whole text; a column of that name is replaced.

    Null, empty and clean texts get the probability of a text without matches; an unfitted model gives 0.
    """

    small_batches(docs.sparkSession)

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        if not model.weights:
            return pa.array(np.zeros(len(texts)))
        reader, weights, out = _reader(model.lexicon), np.array(model.weights), []
        for _, part in slices(texts):
            out.append(_scores(np.array([reader.features(t) for t in part.to_pylist()]), weights))
        return pa.array(np.concatenate(out) if out else np.empty(0))

    return docs.withColumn(column, scored(F.col(text).cast("string")))
