"""Secrets in text: three fixed patterns, and strings in a sensitive context that zstandard cannot compress.

A candidate is a run of 12 or more characters of keys and tokens, with a digit or of both cases, that begins
within ``REACH`` characters after a sensitive word; the value of an unquoted ``NAME=value`` begins after the sign. Its marginal
bytes are what it adds to the compressed size of the text around it less equal copies of it there, with a dictionary of common
code and identifiers: ordinary words and parts of identifiers are found in the dictionary or around, random strings are not. A candidate of ``NOVEL`` marginal bytes a character or more
(``LETTERS`` without a digit or without a letter) is reported, unless a pattern has its place already.

Positions are code points, the end exclusive. Null and empty texts have no spans; whole texts are searched.
Repeated rows give a row each.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.text import schema_of, slices

# The patterns that define the base kinds.
ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "novel")

SENSITIVE = re.compile(r"(?ai:passw|passphrase|pwd|secret|token|api[ _-]?key|access[ _-]?key|private[ _-]?key|signing[ _-]?key|credential|authorization|bearer)")
HINTS = ("pass", "secret", "token", "api", "pwd", "key", "credential", "authorization", "bearer")
# '=' ends a run as padding; elsewhere it stands between a name and a value, and the value is a run of its own.
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_-])(?:[A-Za-z0-9+/_-]{12,}(?:={1,2}(?![A-Za-z0-9+/_=-]))?|(?:[A-Za-z0-9+/_-]{11}=|[A-Za-z0-9+/_-]{10,11}==)(?![A-Za-z0-9+/_=-]))")
REACH = 48
AROUND = 256
NOVEL = 0.62
#: The same for strings of letters alone, or of digits alone.
LETTERS = 0.85

DICTIONARY = """
import from def return class self none true false null undefined const let var function async await public private
protected static final void string integer boolean float double struct enum interface extends implements package
export default require module include define ifdef endif namespace template typename virtual override lambda yield
try except finally raise catch throw throws if else elif for while switch case break continue with as in not and or
username user_name password passwd secret token api_key apikey access_key secret_key private_key public_key
client_id client_secret session_id request_id user_id account_id customer_id device_id correlation_id authorization
bearer basic credential credentials authentication connection_string database_url hostname localhost endpoint
configuration settings environment production development staging testing example placeholder changeme your_token_here
getElementById addEventListener querySelector createElement innerHTML toString valueOf hasOwnProperty prototype
System.out.println printf sprintf format encode decode base64 sha256 md5 hmac digest signature certificate
http https www com org net index html json xml yaml toml ini env docker kubernetes aws azure gcloud github gitlab
abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 0000000000000000 1111111111111111 xxxxxxxxxxxxxxxx
00000000-0000-0000-0000-000000000000 1234567890 deadbeef aaaaaaaaaaaaaaaa ................ ---------------- ================
"""


def around(text: str, start: int, end: int) -> tuple[str, str]:
    """AROUND characters before and after text[start:end], less what belongs to equal copies of it (padding aside)."""
    copy = text[start:end].rstrip("=")
    n = len(copy)
    before, after = text[max(0, start - AROUND - n + 1) : start], text[end : end + AROUND + n - 1]
    if copy in before:
        before = before.replace(copy, "\0" * n)
    if copy in after:
        after = after.replace(copy, "\0" * n)
    return before[-AROUND:].replace("\0", ""), after[:AROUND].replace("\0", "")


class Novelty:
    """Compressed sizes with the dictionary as a prefix."""

    def __init__(self, dictionary: str = DICTIONARY, level: int = 6):
        primed = zstandard.ZstdCompressionDict(dictionary.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self.squeeze = zstandard.ZstdCompressor(
            level=level, dict_data=primed, write_content_size=False, write_checksum=False, write_dict_id=False
        ).compress

    def marginal(self, text: str, start: int, end: int) -> int:
        """Bytes that text[start:end] adds to its surroundings without its own copies there."""
        before, after = around(text, start, end)
        without = len(self.squeeze((before + after).encode("utf-8", "replace")))
        return len(self.squeeze((before + after + text[start:end]).encode("utf-8", "replace"))) - without


def base_spans(text: str) -> list[tuple[str, int, int]]:
    found = [("hex", *m.span()) for m in HEX.finditer(text)]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    lower = text.lower()
    if "token" in lower or "secret" in lower or "passw" in lower or "api" in lower:
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    return found


def _covered(spans: list[tuple[str, int, int]]) -> list[list[int]]:
    """What the spans cover, as disjoint [start, end] in order."""
    out: list[list[int]] = []
    for _, start, end in sorted(spans, key=lambda s: s[1:]):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


def novel_spans(text: str, taken: list[tuple[str, int, int]], novelty: Novelty, novel: float = NOVEL) -> list[tuple[str, int, int]]:
    """One pass over words, candidates and ``taken``, each by position: no stretch of the text is searched twice."""
    lower = text.lower()
    if not any(h in lower for h in HINTS):
        return []
    found, done, place = [], 0, 0
    covered = _covered(taken)
    ahead = None  # the next candidate, if it was searched for already
    for word in SENSITIVE.finditer(text):
        at = max(done, word.end())
        while True:
            if ahead is None or ahead.start() < at:
                ahead = CANDIDATE.search(text, at)
                if ahead is None:
                    return found
            start, end = ahead.span()
            if start > word.end() + REACH:
                break
            at = done = end
            while place < len(covered) and covered[place][1] <= start:
                place += 1
            if place < len(covered) and covered[place][0] < end:
                continue
            s = ahead.group()
            digits = any(map(str.isdigit, s))
            least = novel if digits and any(map(str.isalpha, s)) else LETTERS
            varied = digits or s[1:] != s[1:].lower() and s != s.upper()
            if varied and novelty.marginal(text, start, end) >= least * (end - start):
                found.append(("novel", start, end))
    return found


def all_spans(text: str, novelty: Novelty) -> list[tuple[str, int, int]]:
    """By start, then by kind as listed."""
    base = base_spans(text)
    return sorted(base + novel_spans(text, base, novelty), key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def scan(documents: DataFrame, text: str = "text", out: str = "secrets") -> DataFrame:
    """``documents`` with an array of (kind, start, end_) of every secret in its whole text, in place of the text."""
    others = [c for c in documents.columns if c not in (text, out)]
    shape = "array<struct<kind:string,start:bigint,end_:bigint>>"
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end_", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = Novelty()
        for batch in batches:
            for part in slices(batch, text):
                spans = [[{"kind": k, "start": a, "end_": b} for k, a, b in all_spans(t.as_py() or "", novelty)] for t in part.column(text)]
                yield pa.RecordBatch.from_arrays([part.column(c) for c in others] + [pa.array(spans, kind)], others + [out])

    return documents.select(*others, text).mapInArrow(run, schema_of(documents, others, f"`{out}` {shape}"))


def redact(documents: DataFrame, text: str = "text", mark: str = "[secret]") -> DataFrame:
    """``documents`` with each secret replaced by ``mark``; spans that overlap are replaced together. Null stays null."""
    names = documents.columns

    def clean(value: str | None, novelty: Novelty) -> str | None:
        out, at = [], 0
        for _, start, end in all_spans(value, novelty) if value else []:
            if start >= at:
                out += [value[at:start], mark]
            at = max(at, end)
        return "".join(out) + value[at:] if out else value

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = Novelty()
        for batch in batches:
            for part in slices(batch, text):
                new = pa.array([clean(t.as_py(), novelty) for t in part.column(text)], pa.string())
                yield pa.RecordBatch.from_arrays([new if c == text else part.column(c) for c in names], names)

    return documents.mapInArrow(run, documents.schema)


def joined(spans: str) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end_.cast("string"))), ",")
