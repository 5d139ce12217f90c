"""Preference pairs: two conversations with their common turns rendered once, and a masked completion each.

Everything stays one row per turn: the common prefix of a pair is found from one small aggregate per turn, so a
conversation of any length is never gathered in one row or task. :func:`joined` makes strings of the segments where
conversations are known to be short enough.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PROMPT, CHOSEN, REJECTED = "prompt", "chosen", "rejected"


def rendered(role: Column, text: Column) -> Column:
    """The turn in chat markup."""
    return F.concat(F.lit("<|im_start|>"), role, F.lit("\n"), text, F.lit("<|im_end|>\n"))


def _content(side: str) -> list[Column]:
    """Aggregates equal for equal bags of rows of a side, without gathering them: count, two hash sums and an xor."""
    mine = F.col("side") == side
    one, two = F.xxhash64("role", "text"), F.xxhash64("text", F.lit(1), "role")
    low = F.lit((1 << 32) - 1).cast("long")
    return [
        F.count(F.when(mine, 1)).alias(f"{side}_n"),
        F.sum(F.when(mine, one.bitwiseAND(low))).alias(f"{side}_a"),
        F.sum(F.when(mine, two.bitwiseAND(low))).alias(f"{side}_b"),
        F.bit_xor(F.when(mine, one)).alias(f"{side}_c"),
    ]


def preference_turns(turns: DataFrame, trained: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """(pair_id, segment, turn, role, rendered, train) from ``turns`` (pair_id, side, turn, role, text).

    ``side`` is chosen or rejected; ``text`` is the rows' own. Turns up to the first one where the two sides differ in
    role or text are the prompt, listed once and never trained on; the later turns of each side are its completion, in
    which turns of a ``trained`` role have ``train`` true, the others are masked. Rows of the same turn are one turn
    together, equal on both sides if they hold the same rows as often. A pair with one side has no prompt. A null turn
    comes before all others, null roles and texts are empty. Rows without a pair or of another side belong to no pair
    and go. Other columns are not looked at.
    """
    rows = turns.select(
        F.col("pair_id").alias("pair_id"),
        F.col("side").alias("side"),
        F.coalesce(F.col("turn").cast("long"), F.lit(-1)).alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).where(F.col("pair_id").isNotNull() & F.col("side").isin(CHOSEN, REJECTED))
    cells = rows.groupBy("pair_id", "turn").agg(*_content(CHOSEN), *_content(REJECTED))
    same = F.lit(True)
    for part in "nabc":
        same &= F.col(f"{CHOSEN}_{part}").eqNullSafe(F.col(f"{REJECTED}_{part}"))
    parted = cells.where(~same).groupBy("pair_id").agg(F.min("turn").alias("parted"))
    marked = rows.join(parted, "pair_id", "left")
    common = F.coalesce(F.col("turn") < F.col("parted"), F.lit(True))
    marked = marked.withColumn("segment", F.when(common, PROMPT).otherwise(F.col("side"))).where(~common | (F.col("side") == CHOSEN))
    train = ~common & F.col("role").isin(*trained)
    return marked.select("pair_id", "segment", "turn", "role", rendered(F.col("role"), F.col("text")).alias("rendered"), train.alias("train"))


def answers_swapped(turns: DataFrame, conversation: str = "conv_id", answering: str = "assistant") -> DataFrame:
    """Preference rows from plain ``turns`` (conversation, turn, role, text), one pair per conversation.

    Chosen is the conversation as it is; rejected has the last answer of its neighbour, the conversation whose number
    differs in the last bit, in place of its own. Without an answer or a neighbour both sides are the same.
    """
    rows = turns.select(F.col(conversation).cast("long").alias("pair_id"), "turn", "role", "text")
    last = rows.where(F.col("role") == answering).groupBy("pair_id")
    last = last.agg(F.max("turn").alias("last"), F.max(F.struct("turn", "text"))["text"].alias("answer"))
    other = last.select(F.col("pair_id").bitwiseXOR(F.lit(1).cast("long")).alias("pair_id"), F.col("answer").alias("other"))
    rows = rows.join(last.select("pair_id", "last"), "pair_id", "left").join(other, "pair_id", "left")
    swap = (F.col("role") == answering) & F.col("turn").eqNullSafe(F.col("last"))
    swapped = F.when(swap, F.coalesce("other", "text")).otherwise(F.col("text"))
    sides = F.array(F.struct(F.lit(CHOSEN).alias("side"), F.col("text").alias("text")), F.struct(F.lit(REJECTED).alias("side"), swapped.alias("text")))
    return rows.select("pair_id", "turn", "role", F.explode(sides).alias("s")).select("pair_id", "s.side", "turn", "role", "s.text")


def joined(parts: DataFrame) -> DataFrame:
    """(pair_id, prompt, chosen, rejected, chosen_train, rejected_train): strings, and the spans trained on.

    For conversations that fit in a row; spans are (start, end) in characters of their completion.
    """
    rows = parts.groupBy("pair_id", "segment").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "rendered", "train"))).alias("t"))
    text = F.concat_ws("", F.transform("t", lambda x: x["rendered"]))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def grown(a, x):
        end = a["at"] + F.length(x["rendered"])
        span = F.array(F.struct(a["at"].alias("start"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(x["train"], F.concat(a["spans"], span)).otherwise(a["spans"]).alias("spans"))

    rows = rows.select("pair_id", "segment", text.alias("text"), F.aggregate("t", zero, grown, lambda a: a["spans"]).alias("spans"))

    def of(segment, column):
        return F.max(F.when(F.col("segment") == segment, F.col(column)))

    return rows.groupBy("pair_id").agg(
        *(F.coalesce(of(s, "text"), F.lit("")).alias(s) for s in (PROMPT, CHOSEN, REJECTED)),
        *(of(s, "spans").alias(f"{s}_train") for s in (CHOSEN, REJECTED)),
    )
