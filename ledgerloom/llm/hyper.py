"""Language identification with hyperdimensional profiles.

Every letter has a random vector of ``WIDTH`` signs, drawn from a hash of its code point. An n-gram is bound into one vector: the
letter vectors, each rotated by its place, multiplied sign by sign. A text bundles (adds) the vectors of all its n-grams; a language bundles those of
all its training texts. A text has the language whose prototype makes the largest cosine with it; the score is that cosine, and 0 at least.
Ties go to the smaller language value. All sums are whole numbers, so neither the order of rows nor their partitions matter.

Letters are those of Unicode, in lower case; what lies between them counts as one space, also at both ends of a text. Null texts and texts without
letters have no n-gram: they are ``und`` with score 0, as is every text where nothing was learned, and teach nothing. Rows whose language is null teach
nothing. Repeated rows count each. More than ``LANGUAGES`` languages are an error: prototypes of all of them go to every task.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.text import mix, schema_of, slices
from ledgerloom.sinks import stage

WIDTH = 1_024
GRAM = 3
LANGUAGES = 2_000
UNKNOWN = "und"
_SPACE = 32
_TEXTS = 1_024  # texts bundled at a time
_TOGETHER = 2_048  # n-grams bound at a time
_COUNTED = 1 << 22  # codes below this are counted in a table, others are sorted
_PIECE = 1 << 22  # letters bundled at a time: counts stay exact in 32-bit floats
_SPREAD = 128  # n-grams in more than one of this many texts are bundled by a matrix product


@lru_cache(1)
def _letters() -> np.ndarray:
    """The lower-case letter of each code point, or a space."""
    out = np.full(0x110000, _SPACE, np.uint32)
    for i in range(0x110000):
        if chr(i).isalpha():
            low = chr(i).lower()
            out[i] = ord(low) if len(low) == 1 else i
    return out


def symbols(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Letters and single spaces of the texts one after another, a space before and after each text, and the text of each symbol."""
    size = np.array([len(t) if t else 0 for t in texts], np.int64)
    points = np.frombuffer("".join(t or "" for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(texts)), size + 2)
    s = np.full(len(owner), _SPACE, np.uint32)
    s[np.arange(len(points)) + np.repeat(2 * np.arange(len(texts)) + 1, size)] = _letters()[points]
    again = np.concatenate(([False], (s[1:] == _SPACE) & (s[:-1] == _SPACE) & (owner[1:] == owner[:-1])))
    return s[~again], owner[~again]


def _signs(points: np.ndarray, width: int) -> np.ndarray:
    """The vector of each code point, of -1 and 1."""
    blocks = np.arange(-(-width // 64), dtype=np.uint64)
    bits = mix(mix(points.astype(np.uint64) + np.uint64(1))[:, None] + blocks * np.uint64(0x9E3779B97F4A7C15))
    flat = np.unpackbits(bits.view(np.uint8).reshape(len(points), -1), axis=1)[:, :width]
    return flat.astype(np.int8) * 2 - 1


def _numbered(codes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct codes below ``size``, and the place of each code among them."""
    if size > _COUNTED:
        return np.unique(codes, return_inverse=True)
    there = np.bincount(codes, minlength=1) > 0
    return np.flatnonzero(there), (np.cumsum(there) - 1)[codes]


def _counted(codes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct codes below ``size`` in order, and how often each occurs."""
    if size > 4 * _COUNTED:
        return np.unique(codes, return_counts=True)
    times = np.bincount(codes, minlength=1)
    there = np.flatnonzero(times)
    return there, times[there]


def _bound(grams: np.ndarray, n_letters: int, rotated: list[np.ndarray]) -> np.ndarray:
    """The vectors of n-grams, which are packed numbers of letters; ``rotated``: the letters' vectors for each place."""
    out = np.ones((len(grams), rotated[0].shape[1]), np.int8)
    for place, vectors in enumerate(rotated):
        out *= vectors[grams // n_letters ** (len(rotated) - 1 - place) % n_letters]
    return out


def bundles(texts: list[str | None], width: int = WIDTH, gram: int = GRAM) -> np.ndarray:
    """The bundled n-grams of each text; zeros where there is none."""
    total = np.zeros((len(texts), width), np.int64)
    s, owner = symbols(texts)
    letters, place = _numbered(s.astype(np.int64), 0x110000)
    if len(letters) ** gram >= 1 << 62:
        raise ValueError("too many letters for n-grams of this length")
    vectors = _signs(letters, width)
    rotated = [np.roll(vectors, gram - 1 - k, axis=1) for k in range(gram)]
    for at in range(0, max(0, len(s) - gram + 1), _PIECE):
        end = min(len(s), at + _PIECE + gram - 1)
        n = end - at - gram + 1
        code = np.zeros(n, np.int64)
        for k in range(gram):
            code = code * len(letters) + place[at + k : at + k + n]
        mine = owner[at : at + n]
        whole = mine == owner[at + gram - 1 : end]
        grams, which = _numbered(code[whole], len(letters) ** gram)
        if not len(grams):
            continue
        pairs, times = _counted(mine[whole] * len(grams) + which, len(texts) * len(grams))
        text, which = pairs // len(grams), pairs % len(grams)
        common = np.bincount(which, minlength=len(grams)) * _SPREAD > len(texts)
        chosen, number = grams[common], np.cumsum(common) - 1
        for low in range(0, len(chosen), _TOGETHER):  # common n-grams: a matrix of counts by their vectors
            take = np.flatnonzero(common[which] & (number[which] >= low) & (number[which] < low + _TOGETHER))
            some = chosen[low : low + _TOGETHER]
            counts = np.zeros((len(texts), len(some)), np.float32)
            counts[text[take], number[which[take]] - low] = times[take]
            total += np.rint(counts @ _bound(some, len(letters), rotated).astype(np.float32)).astype(np.int64)
        rare = np.flatnonzero(~common[which])  # pairs are in the order of texts
        for low in range(0, len(rare), _TOGETHER):
            part = rare[low : low + _TOGETHER]
            terms = _bound(grams[which[part]], len(letters), rotated) * times[part, None].astype(np.int32)
            starts = np.flatnonzero(np.concatenate(([True], np.diff(text[part]) != 0)))
            total[text[part[starts]]] += np.add.reduceat(terms, starts, axis=0, dtype=np.int64)
    return total


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in parts of some MB and some hundred texts."""
    for part in slices(batch, "text"):
        for at in range(0, part.num_rows, _TEXTS):
            yield part.slice(at, _TEXTS)


def prototypes(documents: DataFrame, text: str, lang: str, width: int = WIDTH, gram: int = GRAM) -> tuple[list[str], np.ndarray]:
    """The languages in order, and the bundle of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}

        def give() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.list_(pa.int64()))], ["lang", "sums"])
            held.clear()
            return out

        for batch in batches:
            for part in _parts(batch):
                found = bundles(part.column("text").to_pylist(), width, gram)
                names = np.array(part.column("lang").to_pylist(), object)
                for name in set(names):
                    held[name] = held.get(name, 0) + found[names == name].sum(0)
                if len(held) > LANGUAGES:
                    yield give()
        yield give()

    known = documents.select(F.col(f"`{text}`").cast("string").alias("text"), F.col(f"`{lang}`").cast("string").alias("lang")).where("lang IS NOT NULL AND text IS NOT NULL")
    each = known.mapInArrow(run, "lang string, sums array<bigint>").select("lang", F.posexplode("sums").alias("place", "value"))
    sums = stage(each.groupBy("lang", "place").agg(F.sum("value").alias("value")), "prototypes")
    learned = sums.where("value <> 0").select("lang").distinct()
    if len(learned.limit(LANGUAGES + 1).collect()) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    rows = sums.collect()  # LANGUAGES * WIDTH values at most
    names = sorted({r["lang"] for r in rows if r["value"]}, key=lambda n: n.encode())
    number = {n: i for i, n in enumerate(names)}
    out = np.zeros((len(names), width), np.float64)
    for r in rows:
        if r["lang"] in number:
            out[number[r["lang"]], r["place"]] = r["value"]
    return names, out


def identify(
    documents: DataFrame, teaches: Column, text: str = "text", lang: str = "lang", keep: list[str] | None = None,
    out: str = "lang_pred", score: str = "score", width: int = WIDTH, gram: int = GRAM,
) -> DataFrame:
    """The columns ``keep`` of ``documents`` (all, unless given) with the language and its cosine. Rows where ``teaches`` holds are learned
    from. A column of ``documents`` named like a result is left out."""
    keep = [c for c in (keep if keep is not None else documents.columns) if c not in (out, score)]
    names, books = prototypes(documents.where(teaches), text, lang, width, gram)
    unit = books / np.maximum(np.sqrt((books**2).sum(1)), 1e-300)[:, None]
    row = F.struct(*[F.col(f"`{c}`") for c in keep]) if keep else F.struct(F.lit(0).alias("none"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch):
                found = bundles(part.column("text").to_pylist(), width, gram).astype(np.float64)
                n = len(found)
                if names:
                    size = np.sqrt((found**2).sum(1))
                    cosine = found @ unit.T / np.maximum(size, 1e-300)[:, None]
                    best = cosine.argmax(1)
                    value = np.where(size > 0, np.clip(cosine[np.arange(n), best], 0.0, 1.0), 0.0)
                    which = [names[b] if z > 0 else UNKNOWN for b, z in zip(best, size)]
                else:
                    value, which = np.zeros(n), [UNKNOWN] * n
                yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(which, pa.string()), pa.array(value)], ["row", "lang", "score"])

    asked = documents.select(row.alias("row"), F.col(f"`{text}`").cast("string").alias("text"))
    found = asked.mapInArrow(run, schema_of(asked, ["row"], "lang string, score double"))
    return found.select(*[F.col(f"row.`{c}`") for c in keep], F.col("lang").alias(out), F.col("score").alias(score))
