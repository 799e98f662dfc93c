"""Words and word shingles of Arrow text columns as 64-bit hashes, computed on whole batches in numpy.

Words are runs of bytes other than space and U+0009 to U+000D, with A-Z in lower case. All separators
are single bytes in UTF-8, so the work is on bytes. A null text has no words.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

CHUNK = 2_000_000
_ODD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_CODES = mix(np.arange(1, 257, dtype=np.uint64) * _ODD)
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Words(NamedTuple):
    """Hashes of the words of a batch, their byte spans within its text bytes, the first word of each document
    (one more entry than documents), and the first byte of each document."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    offsets: np.ndarray
    data: np.ndarray


def text_bytes(column: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column, in lower case of A-Z if asked for, and the offset of each document; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n, skip = len(column), column.offset
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, np.int64, n + 1 + skip)[skip:] if places else np.zeros(n + 1, np.int64)
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    found = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    return _LOWER[found] if lower else found, offsets - offsets[0]


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _ODD, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def words(column: pa.Array, separator: np.ndarray = _SEPARATOR) -> Words:
    """The words of each text, between bytes that ``separator`` marks."""
    data, offsets = text_bytes(column)
    codes = np.where(separator, np.uint64(0), _CODES)
    begins = np.zeros(len(data) + 1, bool)
    begins[offsets] = True
    all_hashes, all_starts, all_ends = [], [], []
    at = 0
    while at < len(data):
        end = min(len(data), at + CHUNK)
        while end < len(data) and not (separator[data[end]] or begins[end]):  # cut where no word is cut
            ahead = data[end : end + 4096]
            stop = np.flatnonzero(separator[ahead] | begins[end : end + len(ahead)])
            end += int(stop[0]) if len(stop) else len(ahead)
        b = data[at:end]
        inside = ~separator[b]
        new = begins[at:end]
        before = np.concatenate(([False], inside[:-1]))
        starts = np.flatnonzero(inside & (~before | new))
        after = np.concatenate((inside[1:] & ~new[1:], [False]))
        ends = np.flatnonzero(inside & ~after) + 1
        if len(starts):
            place = np.arange(starts[0], len(b)) - np.repeat(starts, np.diff(np.append(starts, len(b))))
            power = _powers(int((ends - starts).max()))
            terms = codes[b[starts[0] :]] * power[np.minimum(place, len(power) - 1)]
            all_hashes.append(mix(np.add.reduceat(terms, starts - starts[0])))
            all_starts.append(starts + at)
            all_ends.append(ends + at)
        at = end
    whole = [np.concatenate(x) if x else np.zeros(0, t) for x, t in ((all_hashes, np.uint64), (all_starts, np.int64), (all_ends, np.int64))]
    return Words(*whole, np.searchsorted(whole[1], offsets), offsets, data)


def shingles(hashes: np.ndarray, first: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every run of ``size`` words, and the first of each document. A document with fewer words
    has its whole sequence as one; a document without words has none."""
    n_words = np.diff(first)
    rolled = np.zeros(max(0, len(hashes) - size + 1), np.uint64)
    for k in range(size):
        rolled = rolled * _ODD + hashes[k : k + len(rolled)]
    counts = np.where(n_words >= size, n_words - size + 1, np.minimum(n_words, 1))
    start = np.concatenate(([0], np.cumsum(counts)))
    out = np.zeros(start[-1], np.uint64)
    place = np.repeat(first[:-1] - start[:-1], counts) + np.arange(start[-1])
    full = np.repeat(n_words >= size, counts)
    out[full] = rolled[place[full]]
    for d in np.flatnonzero((n_words > 0) & (n_words < size)):
        h = np.uint64(n_words[d])
        for w in hashes[first[d] : first[d + 1]]:
            h = np.uint64((int(h) * int(_ODD) + int(w)) & 0xFFFFFFFFFFFFFFFF)
        out[start[d]] = h
    return mix(out), start


def give_back() -> None:
    """Return freed memory to the system: a worker lives on through the stages of other operators."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim:
        trim(0)


def slices(batch: pa.RecordBatch, column: str, most: int = 3_000_000) -> Iterator[pa.RecordBatch]:
    """The batch in parts of some MB of a text or binary column each; one row at least."""
    lengths = np.array(pc.binary_length(batch.column(column)).fill_null(0))
    at, held = 0, 0
    for i, n in enumerate(lengths):
        if i > at and held + n > most:
            yield batch.slice(at, i - at)
            at, held = i, 0
        held += n
    if at < len(lengths):
        yield batch.slice(at)
    give_back()


def schema_of(df: DataFrame, columns: list[str], more: str = "") -> T.StructType:
    """The schema of some columns, and of ``more`` in DDL."""
    fields = {f.name: f for f in df.schema.fields}
    return T.StructType([*(fields[c] for c in columns), *(T.StructType.fromDDL(more).fields if more else [])])
