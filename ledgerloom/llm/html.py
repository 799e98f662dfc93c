"""Main text of web pages by the distribution of text over lines and blocks of lines.

Markup is stripped to one line for each block element. Lines in menus, headers, footers, sidebars, forms,
notices, adverts and reader comments (by element, role, or a class or id that is a hint as a whole) have no length, nor has text in links, and
where a page marks its ``main`` or ``article``, nor have lines outside. Not boilerplate are elements that wrap the article or most of an unmarked
page's text, hinted ones (other than comments) that hold most of the article's, and headings in the article's own header. An ``article`` of a
comment, or among comments, is a comment. Lengths are summed over sliding windows of ``WINDOW`` lines.

On pages that mark their article, each window of it without a length lies between a dive and a surge, and its lines (a menu or list of
links without a hint) are left out; other lines stay, however short. Elsewhere a surge point is where the sum rises over ``SURGE`` (on pages without such a
window, over half the largest), a dive point where it falls to nothing. At both ends of what lies between, lines go that read like labels and have no sibling that reads like
prose, and so do copyright lines; prose next to kept siblings stays, whatever stands between.

A page that is null, empty or without text gives an empty text. Unclosed elements end with their parent; an
advert or sidebar that is never closed is not one. Whole pages are read, nothing is capped. Repeated rows give a row each.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerloom.llm.text import schema_of, slices

WINDOW = 3
SURGE = 86

# Element names and hints.
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<[!?/][^>]*(?:>|\Z)|<(/?)([A-Za-z][A-Za-z0-9:-]*)([^>]*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
RAW = {"script", "style", "noscript", "template", "textarea", "iframe", "svg", "annotation", "annotation-xml", "canvas", "object", "select", "title"}
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody tfoot thead tr ul".split()
)
SPACED = {"br", "td", "th", "img", "input", "button"}
DROPPED = set("nav header footer aside form head button dialog menu".split())
CLOSED_BY_PARENT = set("p li dd dt td th tr option nav header footer aside head".split())
ROLES = set("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
HINTS = set(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner menu navbar navigation nav breadcrumb"
    " breadcrumbs sidebar aside footer masthead cookie cookies consent gdpr notice notices notification popup modal overlay subscribe"
    " newsletter signup login share sharing social related recommended pagination pager skip widget toolbar".split()
)
COMMENTS = set("comment comments commentlist disqus replies".split())
#: What a class may say beside a hint and still be one: places and kinds of boxes. Any other word names something else.
BESIDE = set(
    "box block bar button buttons link links list lists container wrapper wrap section area slot unit item items inner outer panel module group icon icons"
    " media count tools site page main top bottom left right global primary secondary post posts article articles google".split()
)
#: The same beside a word for comments.
BESIDE_COMMENTS = BESIDE | set("body text author content meta thread entry reply form title header user reader".split())
SIZE = re.compile(r"\d+(?:x\d+)?")
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
COPYRIGHT = re.compile(r"(?:©|\(c\)|copyright\b|all rights reserved)", re.I)
SENTENCE_END = tuple(".!?…:;。！？\"'”’»)")
#: An element with more of the text outside links is a wrapper, whatever its hints.
WRAPPER = 0.75
OPEN_P = set("address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
SPACE = re.compile(r"\s+")


def _hinted(name: str, hints: set[str], beside: set[str]) -> bool:
    parts = [x for x in re.split(r"[_-]+", name) if x and not SIZE.fullmatch(x)]
    return not hints.isdisjoint(parts) and all(x in hints or x in beside for x in parts)


def _boilerplate(name: str, attributes: str) -> str:
    """Why an element is boilerplate: "element" (or role, or hidden), "comment", "hint" by class or id; empty if it is not."""
    if name in DROPPED:
        return "element"
    if not attributes or name in ("html", "body", "main"):
        return ""
    why = ""
    for m in ATTRIBUTE.finditer(attributes):
        key, value = m.group(1).lower(), (m.group(2) or "").strip("\"'").lower()
        if key in ("class", "id") and any(_hinted(x, COMMENTS, BESIDE_COMMENTS) for x in value.split()):
            return "comment"
        if name == "article":
            continue
        if key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and re.search(r"display\s*:\s*none", value) or key == "role" and value in ROLES:
            why = "element"
        elif not why and key in ("class", "id") and any(_hinted(x, HINTS, BESIDE) for x in value.split()):
            why = "hint"
    return why


def _events(page: str) -> list[tuple]:
    """(text,), (name, attributes, closing) in order; comments and raw elements are left out."""
    out: list[tuple] = []
    at = 0
    while m := TOKEN.search(page, at):
        if m.start() > at:
            out.append((page[at : m.start()],))
        at = m.end()
        name = (m.group(2) or m.group(5) or "").lower()
        if not name:
            continue
        closing = bool(m.group(1) or m.group(4))
        if name in RAW and not closing:
            if not (m.group(3) or m.group(6) or "").endswith("/"):
                end = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(page, at)
                at = end.end() if end else len(page)
            continue
        out.append((name, m.group(3) or m.group(6) or "", closing))
    if at < len(page):
        out.append((page[at:],))
    return out


def _spans(events: list[tuple]) -> dict[int, tuple[int, bool]]:
    """The event at which each opened element ends, and whether by its own end tag."""
    ends: dict[int, tuple[int, bool]] = {}
    stack: list[tuple[str, int]] = []
    count: dict[str, int] = {}

    def pop(i: int, own: bool) -> None:
        name, k = stack.pop()
        count[name] -= 1
        ends[k] = i, own

    for i, e in enumerate(events):
        if len(e) == 1 or e[0] in VOID:
            continue
        name, _, closing = e
        if closing:
            if count.get(name):
                while stack[-1][0] != name:
                    pop(i, False)
                pop(i, True)
            continue
        if name in OPEN_P and stack and stack[-1][0] == "p" or name == "li" and stack and stack[-1][0] == "li":
            pop(i, False)
        stack.append((name, i))
        count[name] = count.get(name, 0) + 1
    while stack:
        pop(len(events), False)
    return ends


class Line(NamedTuple):
    """The text of a block, its length that counts, whether it is boilerplate, its element's (parent, name), and whether it is a heading."""

    text: str
    length: int
    bad: bool
    place: tuple[int, str]
    heading: bool


def _marks(events: list[tuple], opened: list[tuple]) -> tuple[bytearray, bytearray, bytearray]:
    """For each event, whether it is in the article, in boilerplate, in a link."""
    inside, dropped, linked, headed = (bytearray(len(events)) for _ in range(4))
    ones = lambda i, end: b"\1" * (end - i)
    why, titles, comments = {}, [i for i, name, *_ in opened if name == "h1"], bytearray(len(events))
    for i, name, attributes, end, own in opened:
        if name == "a":
            linked[i:end] = ones(i, end)
        reason = _boilerplate(name, attributes) if own or name in CLOSED_BY_PARENT or name == "article" else ""
        if reason == "comment" and not comments[i]:
            title = bisect_left(titles, i)
            if title < len(titles) and titles[title] < end:  # the page's own title is no comment
                reason = ""
            else:
                comments[i:end] = ones(i, end)
        if reason:
            why[i] = reason
    main = [x for x in opened if x[1] == "main"] or [x for x in opened if x[1] == "article" and not comments[x[0]]]
    for i, _, _, end, _ in main:
        inside[i:end] = ones(i, end)
    lengths = [len(e[0].strip()) if len(e) == 1 and not linked[i] else 0 for i, e in enumerate(events)]
    so_far = [0, *accumulate(lengths)]
    of_main = sum(n for i, n in enumerate(lengths) if inside[i])

    def wraps(i: int, name: str, end: int) -> bool:
        held = so_far[end] - so_far[i]
        if main and not inside[i]:
            return i < main[0][0] and main[-1][3] <= end
        if main:
            return why[i] == "hint" and held > WRAPPER * of_main
        return why[i] != "comment" and (name == "form" or name not in DROPPED) and held > WRAPPER * so_far[-1]

    for i, name, _, end, _ in opened:
        if name == "header" and inside[i]:
            headed[i:end] = ones(i, end)
        elif name in HEADINGS and headed[i]:
            headed[i:end] = bytes(end - i)
        elif i in why and not dropped[i] and not wraps(i, name, end):
            dropped[i:end] = ones(i, end)
    for i, x in enumerate(headed):
        if x:
            dropped[i] = 1
    return inside, dropped, linked


def lines(page: str) -> tuple[list[Line], bool]:
    """The lines in page order; whether the page marks its article."""
    events = _events(page)
    ends = _spans(events)
    inside, dropped, linked = _marks(events, [(i, e[0], e[1], *ends[i]) for i, e in enumerate(events) if i in ends])
    marked = any(len(e) == 1 and inside[i] and not dropped[i] and e[0].strip() for i, e in enumerate(events))
    out: list[Line] = []
    good: list[str] = []
    links: list[str] = []
    bad: list[str] = []
    blocks: list[int] = []  # the block elements that are open

    def plain(parts: list[str]) -> str:
        text = SPACE.sub(" ", html.unescape("".join(parts))).strip()
        parts.clear()
        return text

    def flush() -> None:
        text, link, left = plain(good), plain(links), plain(bad)
        name = events[blocks[-1]][0] if blocks else ""
        place = (blocks[-2] if len(blocks) > 1 else -1, name)
        if left:
            out.append(Line(left, 0, True, place, False))
        if text:
            heading = name in HEADINGS
            out.append(Line(text, len(text) if heading else max(0, len(text) - len(link)), False, place, heading))

    for i, e in enumerate(events):
        out_of_text = dropped[i] or marked and not inside[i]
        if len(e) == 1:
            (bad if out_of_text else good).append(e[0])
            if linked[i] and not out_of_text:
                links.append(e[0])
        elif e[0] in BLOCK:
            flush()
            while blocks and ends[blocks[-1]][0] <= i:
                blocks.pop()
            if i in ends:
                blocks.append(i)
        elif e[0] in SPACED:
            (bad if out_of_text else good).append(" ")
    flush()
    return out, marked


def _of_article(found: list[Line], window: int) -> list[Line]:
    """The lines of a marked article that are in no window without a length."""
    found = [x for x in found if not x.bad]
    if not any(x.length for x in found):
        return found  # links are all it has
    empty, kept = 0, []
    for x in found:
        empty = 0 if x.length else empty + 1
        kept.append(x)
        if empty == window:
            del kept[-window:]
        elif empty > window:
            kept.pop()
    return kept


def _of_page(found: list[Line], window: int, surge: int) -> list[Line]:
    """The lines between surge and dive points, less labels at the ends; and prose beside them."""
    so_far = [0, *accumulate(x.length for x in found)]
    sums = [so_far[min(len(found), i + window)] - so_far[i] for i in range(len(found))]
    threshold = min(surge, max(sums, default=0) / 2)
    runs: list[list[int]] = []
    open_ = False
    for i, (x, total) in enumerate(zip(found, sums)):
        if not open_ and total > threshold and x.length:
            open_ = True
            runs.append([])
        elif total == 0:
            open_ = False
        if open_ and not x.bad:
            runs[-1].append(i)

    def copyright(x: Line) -> bool:
        return not x.heading and len(x.text) < surge and bool(COPYRIGHT.match(x.text))

    prose = [not x.bad and x.length > 0 and not copyright(x) and (x.heading or x.length >= surge // 2 or x.text.endswith(SENTENCE_END)) for x in found]
    beside = {found[i].place for run in runs for i in run if prose[i]}
    reads = [prose[i] or x.place in beside and not copyright(x) for i, x in enumerate(found)]
    kept: set[int] = set()
    for run in runs:
        text = [i for i in run if reads[i]]
        kept.update(i for i in run if not text or text[0] <= i <= text[-1])
    first = min(kept, default=0)
    kept.update(i for i, x in enumerate(found) if i > first and prose[i] and x.place in beside)
    return [found[i] for i in sorted(kept)]


def main_text(page: str, window: int = WINDOW, surge: int = SURGE) -> str:
    found, marked = lines(page)
    return "\n".join(x.text for x in (_of_article(found, window) if marked else _of_page(found, window, surge)))


def extract(pages: DataFrame, column: str = "html", out: str = "text") -> DataFrame:
    """``pages`` with the main text of each page in place of its markup."""
    others = [c for c in pages.columns if c not in (column, out)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, column):
                texts = pa.array([main_text(p.as_py() or "") for p in part.column(column)], pa.string())
                yield pa.RecordBatch.from_arrays([part.column(c) for c in others] + [texts], others + [out])

    return pages.select(*others, column).mapInArrow(run, schema_of(pages, others, f"`{out}` string"))
