"""Mixtures of sources by temperature, laid out as budgeted block permutations.

A source with share s of all tokens gets weight s^a / sum s^a. The exponent a is bisected: towards a target entropy
of the weights, and up to where no source is repeated more than a limit. Weights become token budgets, budgets become
whole passes over a source and one partial pass, and every pass visits the source's blocks, and the documents of a
block, in an order of its own. The partial pass ends at a document inside one block, so only that block of a source is
ever ranked row by row.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.skew import balanced_left_join

from .tables import BROADCAST_ROWS, Scratch

#: Rows a block has on average.
BLOCK_ROWS = 1024
#: Leading binary digits of a source's tokens by which sources are put together to find the exponent: the driver
#: holds at most 2^DIGITS sums for each binary length, however many sources there are.
DIGITS = 12
_SHARPEST = 16.0


@dataclass(frozen=True)
class Mixture:
    exponent: float
    #: source key -> tokens to draw
    budgets: dict


def weights(tokens: list[float], exponent: float, counts: list[int] | None = None) -> list[float]:
    """Normalised s^a; sources without tokens get none. ``counts``: how many sources have that many tokens."""
    counts = counts or [1] * len(tokens)
    total = sum(t * n for t, n in zip(tokens, counts))
    logs = [exponent * math.log(t / total) if t else -math.inf for t in tokens]
    top = max(logs, default=0.0)
    raw = [math.exp(x - top) for x in logs]
    norm = math.fsum(x * n for x, n in zip(raw, counts))
    return [x / norm for x in raw]


def entropy(shares: list[float], counts: list[int] | None = None) -> float:
    return -math.fsum(n * w * math.log(w) for w, n in zip(shares, counts or [1] * len(shares)) if w > 0)


def _bisect(holds, low: float, high: float) -> float:
    """The smallest exponent for which ``holds``, which must hold from some point of [low, high] on."""
    if holds(low):
        return low
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (low, middle) if holds(middle) else (middle, high)
    return high


def exponent_of(tokens: list[float], counts: list[int], budget: float, target_entropy: float | None, max_repeats: float | None) -> float:
    """The exponent for ``counts`` sources of so many ``tokens`` each; see :func:`solve`."""
    exponent = 1.0
    if target_entropy is not None:
        goal = target_entropy * math.log(sum(counts))
        exponent = _bisect(lambda a: entropy(weights(tokens, a, counts), counts) <= goal, 0.0, _SHARPEST)
    if max_repeats is not None:
        total = sum(t * n for t, n in zip(tokens, counts))
        if budget > max_repeats * total:
            raise ValueError(f"{budget} tokens need more than {max_repeats} repeats")

        def within(a: float) -> bool:
            return all(w * budget <= max_repeats * t * (1 + 1e-12) for w, t in zip(weights(tokens, a, counts), tokens))

        if not within(exponent):
            # repeats fall towards the source's own shares from either side
            exponent = _bisect(within, exponent, 1.0) if exponent < 1 else 1 + (exponent - 1) * _last(lambda x: within(1 + (exponent - 1) * x))
    return exponent


def solve(totals: dict, budget: int | None = None, target_entropy: float | None = None, max_repeats: float | None = None) -> Mixture:
    """The flattest mixture of entropy at most ``target_entropy`` (a share of the largest possible) within the limit.

    Without a budget, as many tokens are drawn as there are. The repetition limit goes before the entropy, and a
    budget that no mixture can fill within the limit raises ValueError.
    """
    keys = sorted(k for k, t in totals.items() if t > 0)
    tokens = [totals[k] for k in keys]
    if not keys:
        return Mixture(1.0, {})
    budget = sum(tokens) if budget is None else budget
    exponent = exponent_of(tokens, [1] * len(keys), budget, target_entropy, max_repeats)
    return Mixture(exponent, {k: round(w * budget) for k, w in zip(keys, weights(tokens, exponent))})


def _last(holds) -> float:
    low, high = 0.0, 1.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if holds(middle) else (low, middle)
    return low


def token_count(text):
    """Words between white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def budgets(totals: DataFrame, budget: int | None, target_entropy: float | None, max_repeats: float | None) -> DataFrame:
    """``totals`` (k, t, n) of sources with tokens, and ``drawn``, the tokens to draw from each.

    The exponent and the norm of the weights are found from sums over sources whose tokens agree in their first DIGITS
    binary digits, each counted with their mean; a source alone in its sum counts exactly. The weights are each source's own.
    """
    length = F.ceil(F.log2((F.col("t") + 1).cast("double"))).cast("int")
    alike = F.expr(f"shiftright(t, greatest(0, {DIGITS * -1} + cast(ceil(log2(cast(t + 1 as double))) as int)))")
    sums = totals.where("t > 0").groupBy(length.alias("length"), alike.alias("digits")).agg(F.sum("t").alias("t"), F.count("*").alias("n"))
    sums = sorted((r["t"] / r["n"], r["n"]) for r in sums.collect())
    if not sums:
        return totals.limit(0).withColumn("drawn", F.lit(0).cast("long"))
    tokens, counts = [t for t, _ in sums], [n for _, n in sums]
    total = sum(t * n for t, n in sums)
    budget = round(total) if budget is None else budget
    exponent = exponent_of(tokens, counts, budget, target_entropy, max_repeats)
    # of the largest source, to which the others' weights stand as a power of their tokens
    largest, share = tokens[-1], weights(tokens, exponent, counts)[-1]
    drawn = F.round(F.lit(share * budget) * F.pow(F.col("t") / F.lit(largest), F.lit(exponent)))
    return totals.where("t > 0").withColumn("drawn", drawn.cast("long"))


def _planned(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``rows`` with the plan of their source: by broadcast if the sources are few, else the heavy ones that way alone."""
    if plan.count() <= BROADCAST_ROWS:
        return rows.join(F.broadcast(plan), "k")
    groups = plan.select("k", F.col("n").alias("_n"), F.struct("passes", "rest", "blocks").alias("plan"))
    joined = balanced_left_join(rows, groups, "k", "plan", F.lit(True), ["key"])
    return joined.where("plan is not null").select(*rows.columns, "plan.*")


def _started(sums: DataFrame) -> DataFrame:
    """``sums`` (k, turn, block, t, ...) with ``start``, the tokens of the blocks of a source that come before.

    Blocks are added up in 4,096 stretches of their turns, then the stretches, then the blocks within each: no task
    orders all blocks of a source.
    """
    cut = sums.withColumn("stretch", F.shiftright("turn", 52))
    earlier = Window.partitionBy("k").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    stretches = cut.groupBy("k", "stretch").agg(F.sum("t").alias("t"))
    stretches = stretches.select("k", "stretch", F.coalesce(F.sum("t").over(earlier), F.lit(0)).alias("ahead"))
    inside = Window.partitionBy("k", "stretch").orderBy("turn", "block").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("t").over(inside), F.lit(0))
    return cut.withColumn("before", before).join(stretches, ["k", "stretch"]).withColumn("start", F.col("ahead") + F.col("before"))


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    budget: int | None = None,
    target_entropy: float | None = 0.95,
    max_repeats: float | None = 4.0,
    seed: int = 0,
    block_rows: int = BLOCK_ROWS,
    carry: Sequence[str] = (),
    parts: Sequence[str] = (),
) -> DataFrame:
    """One row per drawn document: (doc_id, source, pass, turn, block, place, tokens) and the columns to ``carry``.

    Sorted by (source, pass, block, place) the rows of a source are its permuted blocks. A document is drawn once per
    whole pass, and in the partial pass while the documents before it fall short of the budget, so a budget is exceeded
    by less than one document. Null sources are one source. Documents without words cost nothing and go along with
    their block; a source of nothing else is not drawn. Repeated rows are drawn each. An empty table gives no rows.
    There may be any number of sources; see :func:`budgets` for what the driver holds of them. Rows of a source that differ
    in the columns ``parts`` are sources of their own, told apart by these columns if they are carried.
    """
    scratch = Scratch(docs.sparkSession, "mixing")

    def named(column: str):
        """The value after its length, so that names of several columns can be told apart when joined."""
        value = F.col(column).cast("string")
        return F.coalesce(F.concat(F.lit("s"), F.length(value), F.lit(":"), value), F.lit("n"))

    # a row without an id is placed by its text
    rows = docs.select(
        F.concat(*map(named, (source, *parts))).alias("k"),
        F.col(source).cast("string").alias("source"),
        F.col(doc_id).alias("doc_id"),
        token_count(F.col(text)).alias("tokens"),
        F.coalesce(F.col(doc_id).cast("string"), F.concat(F.lit("#"), F.xxhash64(text))).alias("key"),
        *(F.col(c).alias(f"__{c}") for c in carry),
    )
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    rows = scratch.keep(rows)
    totals = scratch.keep(rows.groupBy("k").agg(F.sum("tokens").alias("t"), F.count("*").alias("n")))
    plan = budgets(totals, budget, target_entropy, max_repeats)
    plan = plan.select("k", "n", F.expr("drawn div t").alias("passes"), F.expr("drawn % t").alias("rest"), F.ceil(F.col("n") / F.lit(block_rows)).alias("blocks"))
    placed = _planned(rows, scratch.keep(plan))
    placed = placed.withColumn("block", F.pmod(F.xxhash64("key", F.lit(seed)), F.col("blocks")))
    order = F.xxhash64("key", "pass", F.lit(seed))

    def visit(n):
        """The block's turn in a pass: a hash of the block, followed by its number."""
        return F.xxhash64("block", n, F.lit(seed + 1))

    whole = placed.where("passes > 0").select("*", F.explode(F.sequence(F.lit(1).cast("long"), "passes")).alias("pass"))
    last = placed.where("rest > 0").withColumn("pass", F.col("passes") + 1)
    sums = last.groupBy("k", "block", "pass", "rest").agg(F.sum("tokens").alias("t"))
    sums = _started(sums.withColumn("turn", visit("pass")))
    taken = sums.where("start < rest").select("k", "block", (F.col("start") + F.col("t") > F.col("rest")).alias("cut"), "start")
    partial = last.join(taken, ["k", "block"]).withColumn("place", order)
    full = partial.where("not cut")
    inside = Window.partitionBy("k").orderBy("place", "key", "row").rowsBetween(Window.unboundedPreceding, -1)
    ended = partial.where("cut").withColumn("ahead", F.coalesce(F.sum("tokens").over(inside), F.lit(0))).where("start + ahead < rest")
    columns = ["doc_id", "source", "pass", visit("pass").alias("turn"), "block", "place", "tokens", *(f"__{c}" for c in carry)]
    drawn = whole.withColumn("place", order).select(columns).unionByName(full.select(columns)).unionByName(ended.select(columns))
    return drawn.select("doc_id", "source", "pass", "turn", "block", "place", "tokens", *(F.col(f"__{c}").alias(c) for c in carry))
