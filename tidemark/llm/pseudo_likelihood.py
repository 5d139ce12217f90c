"""Masked pseudo-likelihood of documents under a bidirectional window network trained on the corpus itself.

Words are hashed to VOCABULARY tokens. The network sees the two tokens on either side, adds an embedding for each
place, and predicts the token between: first its class, then the token within the class. Training is data-parallel:
in a round every shard takes the current weights through its documents by Adagrad, and the weights are averaged over
all shards, by tokens seen. Each document is trained on in exactly one round. A document's shard, and its place in it,
follow from a hash of its text and id, and the number of shards from the bytes of all texts, so the weights do not
depend on how the documents are laid out in files or partitions.

The words of the corpus are counted in Spark, each on its own. A word has the probability of its token given both
sides, times its share of the token: n / (N + 1) if it was counted n times and the words of the token N times. The rest,
1 / (N + 1), is that of words not counted. A document's score is the sum over its words of the log-probability.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import Scratch, bounded, small_batches
from .textbatch import slices, word_hashes

VOCABULARY, CLASSES = 1024, 32
WITHIN = VOCABULARY // CLASSES
HIDDEN = 12
OFFSETS = (-2, -1, 1, 2)
ROUNDS, RATE, BATCH = 2, 0.08, 8192
#: Bytes of text in a shard, on average.
SHARD_BYTES = 8 << 20
_PAD = VOCABULARY
#: Words of one in so many of all tokens, or more, are looked up by the workers; rarer ones, most of them, by a join.
COMMON = 100_000

#: Shapes of the weights: embeddings by place, class layer and layer within each class, the last row of both their bias.
SHAPES = ((len(OFFSETS), VOCABULARY + 1, HIDDEN), (HIDDEN + 1, CLASSES), (CLASSES, HIDDEN + 1, WITHIN))
SIZE = sum(int(np.prod(s)) for s in SHAPES)


def unpacked(flat: np.ndarray) -> list[np.ndarray]:
    """The weights as views of one array."""
    out, at = [], 0
    for shape in SHAPES:
        out.append(flat[at : at + int(np.prod(shape))].reshape(shape))
        at += int(np.prod(shape))
    return out


def initial(seed: int = 11) -> np.ndarray:
    flat = np.random.default_rng(seed).normal(0, 0.1, SIZE).astype(np.float32)
    _, classes, within = unpacked(flat)
    classes[-1], within[:, -1] = 0, 0
    return flat


def tokens_of(words: np.ndarray) -> np.ndarray:
    return (words >> np.uint64(40)).astype(np.int64) % VOCABULARY


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    words, at = word_hashes(texts)
    return tokens_of(words), at


def contexts(ids: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The tokens at OFFSETS of each token (offsets x tokens); padding beyond the document."""
    n, owner = len(ids), np.repeat(np.arange(len(at) - 1), np.diff(at))
    place = np.arange(n)
    out = np.full((len(OFFSETS), n), _PAD, np.int64)
    for k, step in enumerate(OFFSETS):
        to = place + step
        inside = (to >= at[owner]) & (to < at[owner + 1])
        out[k, inside] = ids[to[inside]]
    return out


def _log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(axis=1, keepdims=True)
    return x - np.log(np.exp(x).sum(axis=1, keepdims=True))


def _hidden(weights: list[np.ndarray], around: np.ndarray) -> np.ndarray:
    total = weights[0][0][around[0]]
    for k in range(1, len(OFFSETS)):
        total = total + weights[0][k][around[k]]
    return np.tanh(total)


def _by_class(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort((ids // WITHIN).astype(np.uint8), kind="stable")
    return order, np.concatenate(([0], np.cumsum(np.bincount(ids // WITHIN, minlength=CLASSES))))


def log_probabilities(flat: np.ndarray, ids: np.ndarray, around: np.ndarray) -> np.ndarray:
    """log p(token | both sides) of every token."""
    weights, out = unpacked(flat), np.empty(len(ids))
    for a in range(0, len(ids), BATCH):
        own = ids[a : a + BATCH]
        hidden = _hidden(weights, around[:, a : a + BATCH])
        row = np.arange(len(own))
        got = _log_softmax(hidden @ weights[1][:-1] + weights[1][-1])[row, own // WITHIN]
        order, edge = _by_class(own)
        for c in range(CLASSES):
            part = order[edge[c] : edge[c + 1]]
            if len(part):
                inner = _log_softmax(hidden[part] @ weights[2][c, :-1] + weights[2][c, -1])
                got[part] += inner[np.arange(len(part)), own[part] % WITHIN]
        out[a : a + BATCH] = got
    return out


class Trainer:
    """Adagrad over minibatches, from ``flat`` on; :attr:`flat` moves."""

    def __init__(self, flat: np.ndarray, rate: float = RATE):
        self.flat, self.seen, self.rate = flat.astype(np.float32).copy(), 0, rate
        self.squares = np.full(SIZE, 1e-7, np.float32)

    def learn(self, ids: np.ndarray, around: np.ndarray) -> None:
        for a in range(0, len(ids), BATCH):
            self._step(ids[a : a + BATCH], around[:, a : a + BATCH])
        self.seen += len(ids)

    def _step(self, ids: np.ndarray, around: np.ndarray) -> None:
        weights, slope = unpacked(self.flat), np.zeros(SIZE, np.float32)
        d_embed, d_class, d_within = unpacked(slope)
        n = len(ids)
        hidden = _hidden(weights, around)
        error = np.exp(_log_softmax(hidden @ weights[1][:-1] + weights[1][-1]))
        error[np.arange(n), ids // WITHIN] -= 1
        d_class[:-1], d_class[-1] = hidden.T @ error, error.sum(axis=0)
        back = error @ weights[1][:-1].T
        order, edge = _by_class(ids)
        for c in range(CLASSES):
            part = order[edge[c] : edge[c + 1]]
            if len(part):
                h = hidden[part]
                inner = np.exp(_log_softmax(h @ weights[2][c, :-1] + weights[2][c, -1]))
                inner[np.arange(len(part)), ids[part] % WITHIN] -= 1
                d_within[c, :-1], d_within[c, -1] = h.T @ inner, inner.sum(axis=0)
                back[part] += inner @ weights[2][c, :-1].T
        back *= 1 - hidden * hidden
        for k in range(len(OFFSETS)):
            for j in range(HIDDEN):
                d_embed[k, :, j] = np.bincount(around[k], back[:, j], minlength=VOCABULARY + 1)
        slope /= n
        self.squares += slope * slope
        self.flat -= self.rate * slope / np.sqrt(self.squares)


def _trained(flat: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer = Trainer(flat)
        for batch in batches:
            for _, texts in slices(batch.column(0)):
                ids, at = tokens(texts)
                trainer.learn(ids, contexts(ids, at))
        if trainer.seen:
            yield pa.RecordBatch.from_arrays(
                [pa.array([float(trainer.seen)]), pa.array([trainer.flat.astype(np.float64)], pa.list_(pa.float64()))], names=["seen", "weights"]
            )

    return train


def fit(docs: DataFrame, text: str = "text", rounds: int = ROUNDS, seed: int = 11, doc_id: str = "doc_id", shard_bytes: int = SHARD_BYTES) -> np.ndarray:
    """Weights trained on all of ``docs``: round i takes the documents whose text hash is i modulo ``rounds``.

    Averages are taken by Spark, one row per weight; the driver gets the average alone. Without words, the initial
    weights are returned. Copies of a text are spread over shards by their ids.
    """
    small_batches(docs.sparkSession)
    flat = initial(seed)
    rows = docs.select(F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"), F.col(doc_id).cast("long").alias("id")).where("text <> ''")
    rows = rows.withColumn("h", F.xxhash64("text"))
    held = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    shards = max(1, -(-held // (rounds * shard_bytes)))
    for i in range(rounds):
        share = rows.where(F.pmod("h", F.lit(rounds)) == i).withColumn("at", F.xxhash64("h", "id"))
        share = share.repartition(shards, "at").sortWithinPartitions("at", "h").select("text")
        parts = share.mapInArrow(_trained(flat), "seen double, weights array<double>")
        each = parts.select("seen", F.posexplode("weights").alias("place", "weight"))
        mean = each.groupBy("place").agg((F.sum(F.col("seen") * F.col("weight")) / F.sum("seen")).alias("weight")).collect()
        if mean:
            flat = np.empty(SIZE, np.float32)
            flat[[r["place"] for r in mean]] = [r["weight"] for r in mean]
    return flat


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, n): the hash of every word of ``docs`` and how often it occurs."""
    small_batches(docs.sparkSession)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in slices(batch.column(0)):
                words, n = np.unique(word_hashes(texts)[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n.astype(np.int64))], names=["word", "n"])

    parts = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(counted, "word long, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


def score(docs: DataFrame, flat: np.ndarray, doc_id: str = "doc_id", text: str = "text", words: DataFrame | None = None) -> DataFrame:
    """(doc_id, n_tokens, log_likelihood, mean_log_probability) of every row of ``docs``.

    ``words`` are the :func:`word_counts` of the corpus, by default those of ``docs``. Null and blank texts have no
    tokens, log-likelihood 0 and no mean. Repeated rows are scored each; other columns are not looked at.
    """
    spark = docs.sparkSession
    small_batches(spark)
    scratch = Scratch(spark, "pseudo-likelihood")
    words = scratch.keep(word_counts(docs, text) if words is None else words)
    totals = np.zeros(VOCABULARY)
    for r in words.groupBy(F.expr(f"cast(shiftrightunsigned(word, 40) % {VOCABULARY} as int)").alias("token")).agg(F.sum("n").alias("n")).collect():
        totals[r["token"]] = r["n"]
    often = F.col("n") * COMMON >= F.lit(int(totals.sum()))
    common = sorted((r["word"], r["n"]) for r in words.where(often).collect())
    known, gain = np.array([w for w, _ in common], np.int64), np.log(np.array([n for _, n in common], float))
    less = np.log(totals + 1)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in slices(batch.column(1)):
                own, at = word_hashes(texts)
                ids, own = tokens_of(own), own.view(np.int64)
                logs, rest = log_probabilities(flat, ids, contexts(ids, at)) - less[ids], np.ones(len(own), bool)
                if len(known):
                    place = np.minimum(np.searchsorted(known, own), len(known) - 1)
                    rest = known[place] != own
                    logs += np.where(rest, 0, gain[place])
                logs, left = np.concatenate(([0.0], np.cumsum(logs))), np.concatenate(([0], np.cumsum(rest)))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, len(texts)),
                        pa.array(np.diff(at).astype(np.int64)),
                        pa.array(logs[at[1:]] - logs[at[:-1]]),
                        pa.ListArray.from_arrays(pa.array(left[at].astype(np.int32)), pa.array(own[rest])),
                    ],
                    names=["doc_id", "n_tokens", "log_likelihood", "rest"],
                )

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    rows = rows.mapInArrow(scored, "doc_id long, n_tokens long, log_likelihood double, rest array<long>")
    rows = scratch.keep(rows.withColumn("row", F.monotonically_increasing_id()))
    # words counted once gain nothing, like those not counted
    rare = bounded(words.where(~often & (F.col("n") > 1)).select("word", F.log("n").alias("gain")))
    more = rows.select("row", F.explode("rest").alias("word")).join(rare, "word").groupBy("row").agg(F.sum("gain").alias("gain"))
    out = rows.join(more, "row", "left").select("doc_id", "n_tokens", (F.col("log_likelihood") + F.coalesce("gain", F.lit(0.0))).alias("log_likelihood"))
    return out.withColumn("mean_log_probability", F.when(F.col("n_tokens") > 0, F.col("log_likelihood") / F.col("n_tokens")))
