"""Fill-in-middle over seekable texts: independent zstandard frames with the units and characters up to each.

A text is stored as a row of frames of a bounded size, each of which decompresses on its own. The place behind so many
lines is found from the counts, so selecting a span opens the frames in which it begins and ends and takes the others as
they are. An example is again a row of frames: those of its parts in another order, with the marks between them. Its
frames one after the other are one zstandard stream of the example. Digests stream frames in order; whatever is done,
one frame is open at a time.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import small_batches

# The marks of prefix, suffix and middle, and the two orders of an example's parts.
P, S, M = b"<P>", b"<S>", b"<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"

#: Bytes of text in a frame.
FRAME_BYTES = 1 << 16

FRAMES = T.ArrayType(
    T.StructType([T.StructField("data", T.BinaryType()), T.StructField("units", T.LongType()), T.StructField("chars", T.LongType())])
)
EXAMPLE = T.StructType(
    [
        T.StructField("n", T.LongType()),
        T.StructField("form", T.StringType()),
        T.StructField("prefix_chars", T.LongType()),
        T.StructField("middle_chars", T.LongType()),
        T.StructField("frames", T.ArrayType(T.BinaryType())),
    ]
)
_FRAME_TYPE = pa.struct([("data", pa.binary()), ("units", pa.int64()), ("chars", pa.int64())])


def _chars(data: bytes) -> int:
    return int(np.count_nonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80))


def split(text: bytes, size: int = FRAME_BYTES) -> Iterator[bytes]:
    """Parts of at most ``size`` bytes, cut between characters."""
    start = 0
    while start < len(text):
        end = min(start + max(size, 4), len(text))
        while end < len(text) and text[end] & 0xC0 == 0x80:
            end -= 1
        yield text[start:end]
        start = end


class Codec:
    def __init__(self, level: int = 3):
        self.pack = zstandard.ZstdCompressor(level=level).compress
        self.open = zstandard.ZstdDecompressor().decompress


class Text:
    """One stored text: compressed frames, and the units (line ends) and characters up to the end of each."""

    def __init__(self, codec: Codec, n: int, data: Sequence[bytes], units: Sequence[int], chars: Sequence[int]):
        self.codec, self.n, self.data, self.units, self.chars = codec, n, data, units, chars

    def place(self, unit: int) -> tuple[int, int]:
        """Frame and byte in it at which the first ``unit`` units end."""
        if unit == 0:
            return 0, 0
        frame = bisect_left(self.units, unit)
        if frame == len(self.data):  # the last line has no end of its own
            return frame, 0
        ends = np.flatnonzero(np.frombuffer(self.codec.open(self.data[frame]), np.uint8) == 10)
        return frame, int(ends[unit - 1 - (self.units[frame - 1] if frame else 0)]) + 1

    def chars_before(self, place: tuple[int, int]) -> int:
        frame, byte = place
        before = self.chars[frame - 1] if frame else 0
        return before + (_chars(self.codec.open(self.data[frame])[:byte]) if byte else 0)

    def span(self, start: tuple[int, int], end: tuple[int, int]) -> Iterator[bytes]:
        """The frames from one place to another; only those cut by a place are opened and made anew."""
        for frame in range(start[0], min(end[0] + 1, len(self.data))):
            a = start[1] if frame == start[0] else 0
            b = end[1] if frame == end[0] else None
            if a == 0 and b is None:
                yield self.data[frame]
            elif b is None or a < b:
                yield self.codec.pack(self.codec.open(self.data[frame])[a:b])

    def holds(self, *marks: bytes) -> bool:
        tail = b""
        for frame in self.data:
            tail += self.codec.open(frame)
            if any(mark in tail for mark in marks):
                return True
            tail = tail[-max(map(len, marks)) + 1 :]
        return False


def example(text: Text, h: Sequence[int], fim_rate: int, spm_rate: int) -> tuple[str, int | None, int | None, list[bytes]]:
    """Form, characters of prefix and middle, and the frames of one text's example."""
    if not text.data or h[2] % 100 >= fim_rate or text.holds(P, S, M):
        return PLAIN, None, None, list(text.data)
    first, last = sorted(x % (text.n + 1) for x in h[:2])
    start, a, b, end = (0, 0), text.place(first), text.place(last), (len(text.data), 0)
    prefix, middle, suffix = text.span(start, a), text.span(a, b), text.span(b, end)
    p, s, m = map(text.codec.pack, (P, S, M))
    chars = text.chars_before(a)
    middle_chars = text.chars_before(b) - chars
    if h[3] % 100 < spm_rate:
        return SPM, chars, middle_chars, [s, *suffix, p, *prefix, m, *middle]
    return PSM, chars, middle_chars, [p, *prefix, s, *suffix, m, *middle]


def _stretch(codec: Codec, frames: Sequence[bytes], begins: Sequence[int], start: int, end: int) -> Iterator[bytes]:
    """Bytes ``start`` to ``end`` of a stream whose frames begin at ``begins``."""
    frame = bisect_right(begins, start) - 1
    while start < end:
        yield codec.open(frames[frame])[start - begins[frame] : end - begins[frame]]
        frame += 1
        start = begins[frame]


def restored(codec: Codec, frames: Sequence[bytes], form: str) -> Iterator[bytes]:
    """The text that an example was made of, part by part, from the example's frames and form alone."""
    if form == PLAIN:
        yield from map(codec.open, frames)
        return
    marks, found, begins, tail = (S, P, M) if form == SPM else (P, S, M), [], [0], b""
    for frame in frames:
        data = codec.open(frame)
        seen, start = tail + data, 0
        while len(found) < len(marks):
            at = seen.find(marks[len(found)], start)
            if at < 0:
                break
            found.append(begins[-1] - len(tail) + at)
            start = at + len(marks[0])
        tail = seen[max(start, len(seen) - len(marks[0]) + 1) :]
        begins.append(begins[-1] + len(data))
    ends = [*found[1:], begins[-1]]
    one, two, middle = [(a + len(m), b) for a, b, m in zip(found, ends, marks)]
    for start, end in ((two, middle, one) if form == SPM else (one, middle, two)):
        yield from _stretch(codec, frames, begins, start, end)


def _lists(values: pa.Array, sizes: Sequence[int]) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)), values)


def _rows(frames: pa.ListArray) -> list[tuple[int, int]]:
    offsets = frames.offsets.to_pylist()
    return list(zip(offsets, offsets[1:]))


def _storer(size: int):
    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec()
        for batch in batches:
            n, sizes, data, units, chars = [], [], [], [], []
            for text in batch.column(1):
                text = (text.as_py() or "").encode()
                parts = list(split(text, size))
                ends = np.cumsum([part.count(b"\n") for part in parts], dtype=np.int64).tolist()
                n.append((ends[-1] if ends else 0) + (text[-1:] not in (b"", b"\n")))
                sizes.append(len(parts))
                data += map(codec.pack, parts)
                units += ends
                chars += np.cumsum([_chars(part) for part in parts], dtype=np.int64).tolist()
            values = [pa.array(data, pa.binary()), pa.array(units, pa.int64()), pa.array(chars, pa.int64())]
            frames = _lists(pa.StructArray.from_arrays(values, fields=list(_FRAME_TYPE)), sizes)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), frames], names=["doc_id", "n", "frames"])

    return store


def store(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """(doc_id, n, frames): every text as independent zstandard frames, with the lines and characters up to each one's end.

    A unit is a line with its end, or what follows the last line end; ``n`` counts them. Null and empty texts have no
    unit and no frame. Rows are stored as they come, repeated ids and rows without an id too.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = T.StructType([rows.schema["doc_id"], T.StructField("n", T.LongType()), T.StructField("frames", FRAMES)])
    return rows.mapInArrow(_storer(frame_bytes), kind)


def _draws(doc_id: Column, seed: int) -> Column:
    """Four numbers of 32 bits from the sha256 of seed and id; a null id counts as an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return F.array(*(F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)))


def _maker(fim_rate: int, spm_rate: int):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec()
        for batch in batches:
            frames = batch.column("frames")
            data, units, chars = (frames.values.field(k).to_pylist() for k in range(3))
            n, draws = batch.column("n"), batch.column("h").to_pylist()
            out, sizes, parts = [], [], []
            for (a, b), count, h in zip(_rows(frames), n.to_pylist(), draws):
                *told, made = example(Text(codec, count, data[a:b], units[a:b], chars[a:b]), h, fim_rate, spm_rate)
                out.append(told)
                sizes.append(len(made))
                parts += made
            form, prefix, middle = zip(*out) if out else ((), (), ())
            columns = [batch.column(0), n, pa.array(form, pa.string()), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64())]
            yield pa.RecordBatch.from_arrays([*columns, _lists(pa.array(parts, pa.binary()), sizes)], names=["doc_id", *EXAMPLE.names])

    return make


def fill_in_middle(stored: DataFrame, seed: int = 7, fim_rate: int = 100, spm_rate: int = 50) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, frames): an example from every text that :func:`store` wrote.

    With h1 to h4 the first four numbers of 32 bits of the sha256 of ``seed:doc_id``, the prefix ends behind the smaller
    of h1 and h2 modulo n+1 units, the middle behind the larger. A text is left plain if it is empty, if it holds a
    mark, or if h3 % 100 is ``fim_rate`` or more; of the others, those with h4 % 100 below ``spm_rate`` have the suffix
    first. The counts are characters, null for plain texts. ``frames`` make up the example, one after the other.
    Rows without an id draw as one empty id; rows that repeat an id draw alike.
    """
    small_batches(stored.sparkSession)
    rows = stored.select("doc_id", "n", "frames", _draws(F.col("doc_id"), seed).alias("h"))
    return rows.mapInArrow(_maker(fim_rate, spm_rate), T.StructType([stored.schema["doc_id"], *EXAMPLE.fields]))


DIGESTS = T.StructType([T.StructField(f"{name}_sha256", T.StringType()) for name in ("output", "restored")])


def _hashed(parts: Iterable[bytes]) -> str:
    digest = hashlib.sha256()
    for part in parts:
        digest.update(part)
    return digest.hexdigest()


@F.pandas_udf(DIGESTS)
def digests(frames: pd.Series, form: pd.Series) -> pd.DataFrame:
    """Digests of an example and of the text that is rebuilt from it, frame by frame."""
    codec = Codec()
    rows = [(_hashed(map(codec.open, f)), _hashed(restored(codec, f, kind))) for f, kind in zip(frames, form)]
    return pd.DataFrame(rows, columns=DIGESTS.names)


@F.pandas_udf(T.StringType())
def text_of(frames: pd.Series) -> pd.Series:
    """The example as text, for those short enough to be held whole."""
    codec = Codec()
    return frames.map(lambda f: b"".join(map(codec.open, f)).decode())
