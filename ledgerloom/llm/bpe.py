"""Byte-level BPE: encoding of texts in overlapping chunks, and decoding to bytes.

A text longer than ``chunk`` characters is cut into chunks that overlap. Each chunk is split into pre-tokens
and encoded on its own, in any task. Chunks of one text are then stitched: where a boundary of the next
chunk is also a boundary of the one before, both split the rest alike (the pattern looks ahead only), so the
ids of the next chunk hold from there on. Where an overlap has no common boundary (one pre-token longer than
the overlap), the two chunks are joined and split again. Ids are kept as little-endian 32-bit integers in
one binary value.

Null and empty texts have no ids. Rows are never merged: repeated rows and null ids give a row each. The
input must give the same rows when read again, as files do.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.text import schema_of, slices

CHUNK = 32_768
OVERLAP = 1_024
#: A boundary this near to a cut may come from the cut.
UNSURE = 8
#: Distinct pre-tokens that a worker remembers.
REMEMBERED = 50_000

_LOADED: dict[tuple[str, str], Vocabulary] = {}


class Vocabulary:
    """Ranks of byte strings, and the pattern that splits text into pre-tokens."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.split = regex.compile(pattern).findall
        whole = tiktoken.Encoding("whole", pat_str=r"(?s:.+)", mergeable_ranks=ranks, special_tokens={})
        known: dict[str, bytes] = {}

        def ids_of(piece: str) -> bytes:
            ids = known.get(piece)
            if ids is None:
                ids = np.array(whole.encode_ordinary(piece), "<u4").tobytes()
                if len(known) >= REMEMBERED:
                    known.clear()
                if len(piece) < 64:
                    known[piece] = ids
            return ids

        self.ids_of: Callable[[str], bytes] = ids_of
        self.bytes_of = {rank: token for token, rank in ranks.items()}

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.ids_of, self.split(text)))

    def pieces(self, text: str) -> tuple[np.ndarray, list[bytes]]:
        """Ends of the pre-tokens and the ids of each."""
        found = self.split(text)
        return np.cumsum(np.fromiter(map(len, found), np.int64, len(found))), list(map(self.ids_of, found))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def vocabulary(path: str, pattern: str) -> Vocabulary:
    if (path, pattern) not in _LOADED:
        _LOADED[path, pattern] = Vocabulary(path, pattern)
    return _LOADED[path, pattern]


def stitch(texts: list[str], starts: list[int], vocab: Vocabulary, parts=None) -> bytes:
    """Ids of the text of which ``texts`` are overlapping chunks in order. ``parts``: ends and ids of their pieces."""
    parts = parts or [vocab.pieces(t) for t in texts]
    out: list[bytes] = []
    text, start, (ends, ids) = texts[0], starts[0], parts[0]
    begun = 0  # pieces of the current chunk that come before its first true boundary
    for k in range(1, len(texts)):
        ours = np.concatenate(([0], ends)) + start
        theirs = np.concatenate(([0], parts[k][0])) + starts[k]
        sure = ours[begun:]
        common = np.intersect1d(sure[sure <= start + len(text) - UNSURE], theirs)
        if len(common):
            out += ids[begun : np.searchsorted(ours, common[0])]
            begun = int(np.searchsorted(theirs, common[0]))
            text, start, (ends, ids) = texts[k], starts[k], parts[k]
        else:
            cut = int(ours[begun])
            text = text[cut - start :] + texts[k][start + len(text) - starts[k] :]
            start, begun = cut, 0
            ends, ids = vocab.pieces(text)
    return b"".join(out + ids[begun:])


def encode(
    documents: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids",
    chunk: int = CHUNK, overlap: int = OVERLAP,
) -> DataFrame:
    """``documents`` with a binary column ``ids`` in place of ``text`` (and of a column of that name). Short texts are encoded where they
    are; only chunks of long ones are shuffled."""
    if not 2 * UNSURE < overlap < chunk:
        raise ValueError("the overlap must be shorter than the chunk, and longer than what a cut may change")
    others = [c for c in documents.columns if c not in (text, ids)]
    rows = documents.withColumn(text, F.coalesce(F.col(text), F.lit("")))
    length = F.char_length(text)
    kept = schema_of(documents, others, f"`{ids}` binary")

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path, pattern)
        for batch in batches:
            for part in slices(batch, text):
                found = pa.array([vocab.encode(t.as_py()) for t in part.column(text)], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(c) for c in others] + [found], others + [ids])

    short = rows.where(length <= chunk).select(*others, text).mapInArrow(whole, kept)
    cut = (
        rows.where(length > chunk)
        .select(F.struct(*others).alias("row"), text, F.monotonically_increasing_id().alias("key"))
        .select(
            "key", "row", text,
            F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil((length - overlap) / (chunk - overlap)) - 1).cast("int"))).alias("k"),
        )
        .select(
            "key", F.when(F.col("k") == 0, F.col("row")).alias("row"),
            (F.col("k") * (chunk - overlap)).alias("start"),
            F.substring(F.col(text), F.col("k") * (chunk - overlap) + 1, F.lit(chunk)).alias("part"),
        )
        .repartition("key", "start")
    )

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path, pattern)
        for batch in batches:
            ends, found, sizes = [], [], []
            for part in batch.column("part"):
                places, encoded = vocab.pieces(part.as_py())
                ends.append(places.astype("<i4").tobytes())
                found.append(b"".join(encoded))
                sizes.append(np.fromiter(map(len, encoded), "<i4", len(encoded)).tobytes())
            more = [pa.array(x, pa.binary()) for x in (ends, found, sizes)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*batch.schema.names, "ends", "found", "sizes"])

    def join(group: pa.Table) -> pa.Table:
        group = group.sort_by("start")
        vocab = vocabulary(path, pattern)
        parts = []
        for e, f, s in zip(*(group.column(c).to_pylist() for c in ("ends", "found", "sizes"))):
            at = np.concatenate(([0], np.cumsum(np.frombuffer(s, "<i4"))))
            parts.append((np.frombuffer(e, "<i4").astype(np.int64), [f[a:b] for a, b in zip(at[:-1], at[1:])]))
        joined = stitch(group.column("part").to_pylist(), group.column("start").to_pylist(), vocab, parts)
        row = group.column("row").slice(0, 1).combine_chunks()
        return pa.table([*row.flatten(), pa.array([joined], pa.binary())], [*others, ids])

    encoded = schema_of(cut, cut.columns, "ends binary, found binary, sizes binary")
    return short.unionByName(cut.mapInArrow(each, encoded).groupBy("key").applyInArrow(join, kept))


def decode(encoded: DataFrame, path: str, pattern: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``encoded`` with the bytes of its ids as a binary column ``out``; null ids decode to no bytes."""
    names = [c for c in encoded.columns if c != out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path, pattern)
        for batch in batches:
            for part in slices(batch, ids):
                found = pa.array([vocab.decode(x.as_py() or b"") for x in part.column(ids)], pa.binary())
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), found], [*names, out])

    return encoded.mapInArrow(run, schema_of(encoded, names, f"`{out}` binary"))
