"""Best-two-fit packing: documents as tokens, placed into sequences of a fixed size.

A document is its tokens and a closing token; only one longer than a sequence is cut. All pieces of one length are
alike to the packer, so it works on how many pieces there are of each length: at most as many numbers as a sequence has
tokens, whatever the corpus holds. A sequence is filled greedily with the longest pieces that fit; then its shortest
piece is taken out again as long as two pieces left over fill the widened gap more tightly. The same filling is used as
often as there are pieces for it. The rows learn their places from the count of their length before them: a count
in their own task, and one per task and length before it. No row is ever ordered among all the others.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from functools import cache, cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import Scratch, bounded, small_batches

SIZE, CLOSING = 2048, 0
TOKENIZER = "byte_bpe_50k.json"

def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


# Fixed value: the splitter of byte-level tokenizers.
_SPLITTER = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _alphabet() -> dict[str, int]:
    """The characters that stand for the 256 bytes in a byte-level vocabulary: visible ones for themselves."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(others)}


def _ranked(path: str):
    """The file's tokenizer for the merger that takes ids as ranks, if that gives the same ids, else None.

    It does for byte-level BPE without a normalizer, a prefix or a dropout, whose merges are in the order of their ids.
    """
    with open(path, encoding="utf-8") as file:
        told = json.load(file)
    model, splitter = told["model"], told["pre_tokenizer"] or {}
    plain = model["type"] == "BPE" and splitter.get("type") == "ByteLevel" and splitter.get("use_regex") and not splitter["add_prefix_space"]
    if not plain or told["normalizer"] or told["post_processor"] or any(model.get(k) for k in ("dropout", "byte_fallback", "ignore_merges", "end_of_word_suffix")):
        return None
    merges = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
    ids = [model["vocab"][m] for m in merges]
    byte = _alphabet()
    if ids != sorted(set(ids)) or len(model["vocab"]) != len(merges) + 256 or any(c not in model["vocab"] for c in byte):
        return None
    import tiktoken

    ranks = {bytes(byte[c] for c in token): i for token, i in model["vocab"].items()}
    return tiktoken.Encoding("ranked", pat_str=_SPLITTER, mergeable_ranks=ranks, special_tokens={})


class Encoder:
    """Texts to the ids of a tokenizer file, as little-endian 32-bit bytes. Names of special tokens are plain text.

    Files of the common byte-level form are merged by ``tiktoken``, which takes a third of the time; all others, and
    what it gives up on, by ``tokenizers``. The ids are the same.
    """

    def __init__(self, path: str):
        self.path, self.ranked = path, _ranked(path)

    @cached_property
    def tokenizer(self):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has its core, and no more
        from tokenizers import Tokenizer

        found = Tokenizer.from_file(self.path)
        found.encode_special_tokens = True
        return found

    def encode(self, text: str) -> bytes:
        if self.ranked is not None:
            try:
                return self.ranked.encode_to_numpy(text).astype("<u4", copy=False).tobytes()
            except ValueError:  # a splitter's limit on what it tries
                pass
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


@cache
def encoder(path: str) -> Encoder:
    """One for each file and worker process."""
    return Encoder(path)


PIECE = T.StructType(
    [
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("ids", T.BinaryType()),
        T.StructField("length", T.IntegerType()),
        T.StructField("part", T.IntegerType()),
        T.StructField("nth", T.LongType()),
    ]
)


def _cutter(path: str, size: int, closing: int):
    """Arrow batches (doc_id, text) to pieces; ``nth`` counts the pieces of a length in this task."""
    end = np.array([closing], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = encoder(path).encode, TaskContext.get().partitionId()
        seen = np.zeros(size + 1, np.int64)
        for batch in batches:
            rows: list[int] = []
            pieces, starts, ids, lengths, nths = [], [], [], [], []
            for row, text in enumerate(batch.column(1)):
                tokens = encode(text.as_py() or "") + end
                n = len(tokens) // 4
                start, to = 0, n % size or size
                for piece in range(-(-n // size)):
                    rows.append(row)
                    pieces.append(piece)
                    starts.append(start)
                    ids.append(tokens[4 * start : 4 * to])
                    lengths.append(to - start)
                    nths.append(seen[to - start])
                    seen[to - start] += 1
                    start, to = to, to + size
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows, pa.int64())),
                    pa.array(pieces, pa.int32()),
                    pa.array(starts, pa.int64()),
                    pa.array(ids, pa.binary()),
                    pa.array(lengths, pa.int32()),
                    pa.array([part] * len(rows), pa.int32()),
                    pa.array(nths, pa.int64()),
                ],
                names=["doc_id", *PIECE.names],
            )

    return cut


@dataclass(frozen=True)
class Filling:
    """``times`` sequences from number ``first`` on, each holding so many pieces of each length."""

    first: int
    times: int
    uses: dict[int, int]


def _fits(left: np.ndarray) -> np.ndarray:
    """For every gap the longest piece left that fits, 0 for none."""
    return np.maximum.accumulate(np.where(left > 0, np.arange(len(left)), 0))


def _two(left: np.ndarray, gap: int) -> tuple[int, int]:
    """Two of the pieces left that together fill ``gap`` best, the longer first; (0, 0) for none."""
    fits = _fits(left)
    a = np.flatnonzero(left[: gap + 1])
    b = fits[np.minimum(a, gap - a)]
    alone = (b == a) & (left[a] < 2)
    b[alone] = fits[a[alone] - 1]
    a, b = a[b > 0], b[b > 0]
    if not len(a):
        return 0, 0
    best = len(a) - 1 - int(np.argmax((a + b)[::-1]))
    return int(a[best]), int(b[best])


def solve(counts: Mapping[int, int], size: int = SIZE) -> list[Filling]:
    """Fillings that place ``counts`` pieces of each length, of 1 to ``size``.

    Every filling leaves too few pieces of some length for one more, so there are at most some eight fillings for each
    length, and work does not depend on the number of pieces.
    """
    left = np.zeros(size + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    out, first = [], 0
    while left.any():
        uses: dict[int, int] = {}
        gap, fits = size, _fits(left)
        length = int(fits[gap])
        while length:
            n = min(gap // length, int(left[length]))
            uses[length] = n
            gap -= n * length
            length = int(fits[min(gap, length - 1)])
        while len(uses) > 1 or sum(uses.values()) > 1:
            shortest = min(uses)
            free = left.copy()
            for length, n in uses.items():
                free[length] -= n
            free[shortest] += 1
            a, b = _two(free, gap + shortest)
            if a + b <= shortest:
                break
            gap -= a + b - shortest
            uses[shortest] -= 1
            uses = {k: n for k, n in uses.items() if n}
            for length in (a, b):
                uses[length] = uses.get(length, 0) + 1
        times = min(int(left[length]) // n for length, n in uses.items())
        for length, n in uses.items():
            left[length] -= n * times
        out.append(Filling(first, times, uses))
        first += times
    return out


_NTH_BITS = np.int64(48)


class Places:
    """Where the nth piece of a length goes: sequence and offset, for whole columns."""

    def __init__(self, fillings: list[Filling]):
        rows, used = [], {}
        for f in fillings:
            offset = 0
            for length in sorted(f.uses, reverse=True):
                n = f.uses[length]
                rows.append((length, used.get(length, 0), f.first, n, offset))
                used[length] = used.get(length, 0) + n * f.times
                offset += n * length
        table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)
        self.keys, self.rows = (table[:, 0] << _NTH_BITS) + table[:, 1], table

    def of(self, length: np.ndarray, nth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        found = self.rows[np.searchsorted(self.keys, (length << _NTH_BITS) + nth, "right") - 1]
        along = nth - found[:, 1]
        return found[:, 2] + along // found[:, 3], found[:, 4] + along % found[:, 3] * length


def _placed(places: Places, length: Column, nth: Column) -> Column:
    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, nth: pd.Series) -> pd.DataFrame:
        sequence, offset = places.of(length.to_numpy(np.int64), nth.to_numpy(np.int64))
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    return place(length, nth)


def cut(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", size: int = SIZE, closing: int = CLOSING) -> DataFrame:
    """(doc_id, piece, start, ids, length, part, nth) of every document's pieces; see :func:`pack`."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(_cutter(path, size, closing), T.StructType([rows.schema["doc_id"], *PIECE.fields]))


def pack(
    docs: DataFrame, path: str | None = None, doc_id: str = "doc_id", text: str = "text", size: int = SIZE, closing: int = CLOSING
) -> DataFrame:
    """(doc_id, piece, start, ids, length, sequence_id, offset): all documents in sequences of at most ``size`` tokens.

    ``ids`` are a piece's tokens as little-endian unsigned 32-bit numbers, ``start`` the tokens of its document before
    it, ``offset`` the tokens before it in its sequence, without gaps. A document has one piece unless it is longer than
    ``size``; then all but the first piece have ``size`` tokens. ``path`` is the tokenizer's file. A null or empty text
    is its closing token alone. Rows that repeat an id, or lack one, are documents of their own. No documents give no
    rows. Other columns are not looked at. Which of several pieces of one length goes where follows the order of rows
    in their files; the number of sequences and their fillings depend on the lengths alone.
    """
    scratch = Scratch(docs.sparkSession, "packing")
    pieces = scratch.keep(cut(docs, path or tokenizer_path(), doc_id, text, size, closing))
    held = scratch.keep(pieces.groupBy("part", "length").agg(F.count("*").alias("n")))
    counts = {r["length"]: r["n"] for r in held.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = held.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    told = pieces.join(bounded(scratch.keep(before)), ["part", "length"])
    place = _placed(Places(solve(counts, size)), F.col("length"), F.col("nth") + F.col("before"))
    told = told.withColumn("place", place)
    return told.select("doc_id", "piece", "start", "ids", "length", "place.sequence_id", "place.offset")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids, documents): each sequence's tokens in a row, at most the packing size of them."""
    rows = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "doc_id", "piece", "ids"))).alias("p"))
    joined = F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"]))
    return rows.select("sequence_id", joined.alias("ids"), F.transform("p", lambda x: F.struct(x["doc_id"], x["piece"], x["offset"])).alias("documents"))
