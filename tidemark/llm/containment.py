"""Benchmark items inside documents: MinHash sketches partitioned by size, then exact containment.

An item of a few shingles is a vanishing share of a long document, so signatures of one length for all cannot show
it. Documents are partitioned by size, and a document of size class 2^k is sketched by the minimum of each of 2^k bins
of the hash range: one hash function, one permutation, a share of at least 0.63 of its shingles kept at any size. An
item is looked up by all of its shingles. With sixteen or more, the chance that an item contained to THRESHOLD meets no
minimum is 0.37^13, some two in a million. An item of fewer shingles could miss them all: such items, and no others, are
looked up in all shingles of the documents, in the same pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import Scratch, bounded

WIDTH = 5
#: Percent of an item's distinct shingles that the document holds.
THRESHOLD = 80
_FEW = 16


def words(text: Column) -> Column:
    """Lower-cased words between white space; none for null."""
    return F.array_remove(F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), r"[\x20\x09-\x0D]+"), "")


def _windows(w: str, width: int, make) -> Column:
    """``make`` of each ``width`` words in a row of the array column ``w``."""
    last = F.size(w) - F.lit(width - 1)
    at = F.when(last > 0, F.sequence(F.lit(0), last - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: make(*(F.get(F.col(w), i + k) for k in range(width))))


def _marks(hashes: DataFrame, short: bool, long: bool) -> DataFrame:
    """(d, x, minimum) from (d, h): for long items the least hash of every bin, for short ones all hashes."""
    if not long:
        return hashes.select("d", F.explode("h").alias("x"), F.lit(False).alias("minimum"))
    ordered = hashes.select("d", F.sort_array("h").alias("h"))
    bits = F.least(F.lit(60), F.ceil(F.log2(F.size("h").cast("double"))).cast("int"))
    ordered = ordered.select("d", "h", (F.lit(64) - bits).alias("cut"))
    first = "k = 0 or shiftright(x, cut) <> shiftright(get(h, k - 1), cut)"
    if short:
        return ordered.select("d", F.expr(f"inline(transform(h, (x, k) -> struct(x as x, {first} as minimum)))"))
    return ordered.select("d", F.explode(F.expr(f"filter(h, (x, k) -> {first})")).alias("x"), F.lit(True).alias("minimum"))


def contained(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text", threshold: int = THRESHOLD, width: int = WIDTH
) -> DataFrame:
    """(doc_id, item_id, matched, item_shingles, containment) of items contained to ``threshold`` percent or more.

    Containment is the share of an item's distinct shingles of ``width`` words that the document holds, counted on the
    shingles themselves. An item of fewer words is one shingle of all its words. Blank and null texts, and rows without
    an id, contain nothing and are contained in nothing. Rows that repeat an id are one document or item with the
    shingles of all of them. Other columns are not looked at.
    """
    scratch = Scratch(docs.sparkSession, "containment")
    left = docs.select(F.col(doc_id).alias("d"), F.col(text).alias("t")).where("d is not null")
    goal = items.select(F.col(item_id).alias("i"), words(F.col(text)).alias("w")).where("i is not null and size(w) > 0")
    goal = goal.withColumn("v", F.least(F.size("w"), F.lit(width)))
    widths = sorted(r["v"] for r in goal.select("v").distinct().collect())
    strings = None
    for v in widths:
        one = goal.where(F.col("v") == v).select("i", F.lit(v).alias("v"), F.explode(_windows("w", v, lambda *x: F.concat_ws(" ", *x))).alias("s"))
        strings = one if strings is None else strings.unionByName(one)
    if strings is None:
        kind = T.StructType([T.StructField("doc_id", left.schema["d"].dataType), T.StructField("item_id", goal.schema["i"].dataType)])
        kind = kind.add("matched", "long").add("item_shingles", "long").add("containment", "double")
        return docs.sparkSession.createDataFrame([], kind)
    strings = strings.distinct()
    sizes = strings.groupBy("i").agg(F.count("*").alias("q"))
    strings = scratch.keep(strings.join(sizes, "i"))
    spans = {r["v"]: (r["least"], r["most"]) for r in strings.groupBy("v").agg(F.min("q").alias("least"), F.max("q").alias("most")).collect()}
    hashed = F.xxhash64(*(F.get(F.split("s", " "), F.lit(k)) for k in range(width)))
    lookup = bounded(strings.select("i", "q", "v", hashed.alias("x")))

    found = None
    for v in widths:
        least, most = spans[v]
        marks = left.select("d", words(F.col("t")).alias("w")).where(F.size("w") >= v)
        pad = [F.lit(None).cast("string")] * (width - v)
        marks = marks.select("d", _windows("w", v, lambda *x: F.xxhash64(*x, *pad)).alias("h"))
        marks = _marks(marks, short=least < _FEW, long=most >= _FEW)
        hits = marks.join(lookup, "x").where((F.col("v") == v) & (F.col("minimum") | (F.col("q") < _FEW))).select("d", "i", "q", "x")
        found = hits if found is None else found.unionByName(hits)
    # enough minima met: one, or a tenth of a longer item, where half is expected at the threshold
    met = found.groupBy("d", "i", "q").agg(F.count_distinct("x").alias("m")).where("m >= greatest(1, floor(q / 10))")
    candidates = scratch.keep(met.select("d", "i", "q"))
    texts = left.join(bounded(candidates.select("d").distinct()), "d", "left_semi")
    held = None
    for v in widths:
        part = texts.select("d", words(F.col("t")).alias("w")).where(F.size("w") >= v)
        part = part.select("d", F.lit(v).alias("v"), F.explode(F.array_distinct(_windows("w", v, lambda *x: F.concat_ws(" ", *x)))).alias("s"))
        held = part if held is None else held.unionByName(part)
    matched = held.join(bounded(strings.select("i", "v", "s")), ["v", "s"]).join(candidates, ["d", "i"])
    matched = matched.groupBy("d", "i", "q").agg(F.count_distinct("s").alias("matched")).where(F.col("matched") * 100 >= F.col("q") * threshold)
    return matched.select(
        F.col("d").alias("doc_id"),
        F.col("i").alias("item_id"),
        "matched",
        F.col("q").alias("item_shingles"),
        (F.col("matched") / F.col("q")).alias("containment"),
    )
