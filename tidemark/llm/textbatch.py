"""Words and word shingles of Arrow text columns as hash arrays, whole batches at a time.

Text is cut at ``[\\x20\\x09-\\x0D]+`` after A-Z have been lower-cased; nothing else is changed. A word
is the 64-bit hash of its UTF-8 bytes, a shingle the hash of five words in a row. Work goes in slices of a
few megabytes (one document at least), so memory follows the longest document, not the batch.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WIDTH = 5
SLICE_BYTES = 1 << 20

_ODD = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_PLACES = mixed(np.arange(1, WIDTH + 1, dtype=np.uint64) * _STEP) | np.uint64(1)
#: Words of at most so many blocks of eight bytes are hashed side by side.
_BLOCKS = 4


def _hashed(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words of ``sizes`` bytes at ``starts``, block by block of eight bytes.

    Each block is mixed into what came before it, so the hash is no polynomial in the bytes, of which some words
    of simple make share the value. Long words are hashed one by one.
    """
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eights = np.lib.stride_tricks.as_strided(padded, (len(data) + 1, 8), (1, 1))
    out = mixed(sizes.astype(np.uint64) * _ODD)
    for k in range(_BLOCKS):
        on = np.flatnonzero(sizes > 8 * k)
        if not len(on):
            break
        block = np.ascontiguousarray(eights[starts[on] + 8 * k]).view("<u8").ravel().astype(np.uint64)
        spare = np.maximum(0, 8 - (sizes[on] - 8 * k)).astype(np.uint64) * np.uint64(8)
        block = (block << spare) >> spare
        out[on] = mixed((out[on] ^ block) + _ODD)
    for k in np.flatnonzero(sizes > 8 * _BLOCKS):
        word = data[starts[k] : starts[k] + sizes[k]].tobytes()
        out[k] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
    return out


def as_large(texts: pa.Array) -> pa.Array:
    """The column with 64-bit offsets and empty text for null."""
    return texts.cast(pa.large_string()).fill_null("")


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in a row, and the n+1 places where they begin and end."""
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if not len(offsets):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    data = texts.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """Runs of rows of at most ``limit`` bytes, or of one longer row, with the row each begins at."""
    texts = as_large(texts)
    _, offsets = buffers(texts)
    start = 0
    while start < len(texts):
        end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1)
        yield start, texts.slice(start, end - start)
        start = end


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in a row, and the n+1 places where each text's words begin."""
    data, offsets = buffers(texts)
    if not len(data):
        return np.empty(0, np.uint64), np.zeros(len(offsets), np.int64)
    inside = ~_SPACE[data]
    edges = np.zeros(len(data) + 1, bool)
    at = offsets[offsets < len(data)]
    edges[at] = True
    first = inside & edges[:-1]
    first[1:] |= inside[1:] & ~inside[:-1]
    starts = np.flatnonzero(first)
    last = inside.copy()
    last[:-1] &= ~inside[1:] | edges[1:-1]
    sizes = np.flatnonzero(last) + 1 - starts
    return _hashed(_LOWER[data], starts, sizes), np.searchsorted(starts, offsets)


def shingle_hashes(texts: pa.Array, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of all texts in order of place, and where each text's begin; fewer words make one shingle."""
    words, at = word_hashes(texts)
    counts = np.diff(at)
    sizes = np.where(counts >= width, counts - width + 1, counts > 0)
    begin = np.concatenate(([0], np.cumsum(sizes)))
    out = np.empty(begin[-1], np.uint64)
    full = np.flatnonzero(counts >= width)
    if len(full):
        rolled = words[: len(words) - width + 1] * _PLACES[0]
        for k in range(1, width):
            rolled += words[k : len(words) - width + 1 + k] * _PLACES[k]
        n = sizes[full]
        inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        out[np.repeat(begin[full], n) + inner] = rolled[np.repeat(at[full], n) + inner]
    for d in np.flatnonzero((counts > 0) & (counts < width)):
        out[begin[d]] = (words[at[d] : at[d + 1]] * _PLACES[: counts[d]]).sum(dtype=np.uint64) + np.uint64(counts[d])
    return mixed(out), begin


def shingle_sets(texts: pa.Array, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """As :func:`shingle_hashes`, each text's shingles once and in ascending order."""
    shingles, at = shingle_hashes(texts, width)
    keep = np.empty(len(shingles), bool)
    for a, b in zip(at[:-1], at[1:]):
        if a < b:
            shingles[a:b].sort()
            keep[a] = True
            np.not_equal(shingles[a + 1 : b], shingles[a : b - 1], out=keep[a + 1 : b])
    return shingles[keep], np.concatenate(([0], np.cumsum(keep)))[at]
