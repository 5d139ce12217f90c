"""Secrets in documents, and how widely each is held across the corpus.

Every match is a candidate with a hash of its value. Hashes are counted by distinct repositories and distinct owners
over all documents: a value that many owners or repositories hold is an example copied from documentation, one that a
few hold looks like a live credential of theirs. Long mixed tokens without a telling name are added as ``opaque``
spans only where the counts show them to be specific to few owners.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import Scratch, small_batches
from .textbatch import buffers, slices

KINDS = ("assign", "access", "hex", "opaque")
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
OPAQUE = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}(?![A-Za-z0-9+/_-])")
_DIGIT, _SMALL, _LARGE = re.compile(r"[0-9]"), re.compile(r"[a-z]"), re.compile(r"[A-Z]")
#: Bits a character an opaque token has at least.
ENTROPY = 3.0
#: A value that so many owners or repositories hold is an example.
EXAMPLE_OWNERS, EXAMPLE_REPOSITORIES = 5, 50

_HEX_BYTE = np.zeros(256, bool)
_HEX_BYTE[list(b"0123456789abcdef")] = True

Span = tuple[int, int, int, str]


def _entropy(token: str) -> float:
    return -sum(n / len(token) * math.log2(n / len(token)) for n in Counter(token).values())


def base_spans(text: str, hexadecimal: bool = True) -> list[Span]:
    """(kind, start, end, value) of the three fixed patterns, by start and kind; the span is the whole match."""
    found: list[Span] = []
    if ":" in text or "=" in text:
        found += [(0, m.start(), m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(1, m.start(), m.end(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    if hexadecimal:
        found += [(2, m.start(), m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], s[0]))


def opaque_spans(text: str, base: list[Span]) -> list[Span]:
    """Long tokens of digits and letters of high entropy that no base span touches."""
    if not _DIGIT.search(text):
        return []
    out = []
    for m in OPAQUE.finditer(text):
        token = m[0]
        if _DIGIT.search(token) and (_SMALL.search(token) or _LARGE.search(token)) and _entropy(token) >= ENTROPY:
            if not any(a < m.end() and m.start() < b for _, a, b, _ in base):
                out.append((3, m.start(), m.end(), token))
    return out


def _may_have_hex(texts: pa.Array) -> np.ndarray:
    """Rows that may hold 24 hexadecimal digits in a row."""
    data, offsets = buffers(texts)
    edge = np.diff(np.concatenate(([False], _HEX_BYTE[data], [False])).astype(np.int8))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    long = end - begin >= 24
    touched = np.zeros(len(offsets) + 1, np.int64)
    np.add.at(touched, np.searchsorted(offsets, begin[long], "right") - 1, 1)
    np.add.at(touched, np.searchsorted(offsets, end[long] - 1, "right"), -1)
    return np.cumsum(touched)[: len(texts)] > 0


def _hash(value: str) -> int:
    return int.from_bytes(hashlib.blake2b(value.encode(), digest_size=8).digest(), "big", signed=True)


_SPANS = "array<struct<kind:int,start:int,end:int,value:long>>"
_SPAN_TYPE = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("value", pa.int64())]))


def candidates(text):
    """Column of the candidate spans of a text, with value hashes; none for a null text."""

    @F.arrow_udf(_SPANS)
    def found(texts: pa.Array) -> pa.Array:
        out = []
        for _, part in slices(texts):
            for value, hexadecimal in zip(part.to_pylist(), _may_have_hex(part)):
                base = base_spans(value, bool(hexadecimal))
                spans = sorted(base + opaque_spans(value, base), key=lambda s: (s[1], s[0]))
                out.append([{"kind": k, "start": a, "end": b, "value": _hash(v)} for k, a, b, v in spans])
        return pa.array(out, _SPAN_TYPE)

    return found(text.cast("string"))


def holders(spans: DataFrame) -> DataFrame:
    """(value, owners, repositories) of ``spans`` (value, owner, repository): distinct holders of every value.

    Copies are merged before the shuffle, and counts are partial per task, so a value that a third of the rows hold
    is no heavier than its distinct holders. Nulls are no holders.
    """
    return spans.groupBy("value").agg(F.countDistinct("owner").alias("owners"), F.countDistinct("repository").alias("repositories"))


def find_secrets(
    docs: DataFrame,
    text: str = "text",
    owner: str = "source",
    repository: str = "doc_id",
    example_owners: int = EXAMPLE_OWNERS,
    example_repositories: int = EXAMPLE_REPOSITORIES,
    carry: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """``carry`` columns and ``secrets``, one row per row of ``docs``, whatever its ids.

    ``secrets``: array of (kind, start, end, value, owners, repositories, example) by start and kind, in code points,
    end exclusive; empty for texts without any and for null. Base spans always stay; ``opaque`` ones only if they are
    no example. Repeated rows are listed each, and count once as a holder.
    """
    small_batches(docs.sparkSession)
    scratch = Scratch(docs.sparkSession, "secrets")
    kept = [F.col(c).alias(f"c{i}") for i, c in enumerate(carry)]
    rows = docs.select(*kept, F.col(owner).alias("owner"), F.col(repository).alias("repository"), candidates(F.col(text)).alias("spans"))
    rows = scratch.keep(rows.withColumn("row", F.monotonically_increasing_id()))
    spans = rows.where(F.size("spans") > 0).select("row", "owner", "repository", F.explode("spans").alias("s"))
    spans = spans.select("row", "owner", "repository", "s.*")
    verdict = holders(spans).withColumn("example", (F.col("owners") >= example_owners) | (F.col("repositories") >= example_repositories))
    judged = spans.drop("owner", "repository").join(verdict, "value").where("kind < 3 or not example")
    entry = F.struct("start", "kind", "end", "value", "owners", "repositories", "example")
    listed = judged.groupBy("row").agg(F.array_sort(F.collect_list(entry)).alias("secrets"))
    empty = F.array().cast(listed.schema["secrets"].dataType)
    out = rows.join(listed, "row", "left").withColumn("secrets", F.coalesce("secrets", empty))
    return out.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(carry)), "secrets")


def listing(secrets):
    """kind:start:end of every span, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.concat_ws(",", F.transform(secrets, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])))


def redact(docs: DataFrame, text: str = "text", owner: str = "source", repository: str = "doc_id", key: str = "doc_id", mark: str = "[secret]") -> DataFrame:
    """``docs`` with every span that is no example replaced by ``mark``; touching spans become one mark.

    Rows are matched by ``key`` and text. A row without a key is cut at its own base spans, whatever the counts say.
    """
    found = find_secrets(docs.withColumn("__hash", F.xxhash64(text)).where(F.col(key).isNotNull()), text, owner, repository, carry=(key, "__hash"))
    cuts = found.select(F.col(key).alias("__key"), "__hash", F.filter("secrets", lambda s: ~s["example"]).alias("live")).where(F.size("live") > 0)
    cuts = cuts.groupBy("__key", "__hash").agg(F.max(F.transform("live", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))).alias("__cuts"))
    joined = docs.where(F.col(key).isNotNull()).join(cuts, (F.col(key) == F.col("__key")) & (F.xxhash64(text) == F.col("__hash")), "left").drop("__key", "__hash")
    alone = F.filter(candidates(F.col(text)), lambda s: s["kind"] < 3)
    alone = docs.where(F.col(key).isNull()).withColumn("__cuts", F.transform(alone, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))
    joined = joined.unionByName(alone)
    # one character after another span's end begins a new piece; spans are sorted by start
    pieces = F.aggregate(
        "__cuts",
        F.struct(F.lit("").alias("out"), F.lit(0).alias("at")),
        lambda a, s: F.struct(
            F.when(
                s["start"] >= a["at"],
                F.concat(a["out"], F.substring(F.col(text), a["at"] + 1, s["start"] - a["at"]), F.lit(mark)),
            ).otherwise(a["out"]).alias("out"),
            F.greatest(a["at"], s["end"]).alias("at"),
        ),
        lambda a: F.concat(a["out"], F.substring(F.col(text), a["at"] + 1, F.length(F.col(text)))),
    )
    return joined.withColumn(text, F.when(F.col("__cuts").isNotNull(), pieces).otherwise(F.col(text))).drop("__cuts").select(*docs.columns)
