"""Main text of web pages by line-block distribution.

Markup is stripped into lines, one per block element. The text lengths of a few neighbouring lines are summed; where
these sums surge an article begins and where they dive it ends, and all lines from the first surge to the last dive
are kept. Tags and names only weigh: lines of boilerplate elements weigh nothing, and where an article element
holds most of the text, so do the lines outside of it.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW, SURGE, DIVE = 3, 0.3, 0.02
#: A line counts as this many characters at most, so one long block does not raise the limits for the others.
LONG = 100
#: What a line inside an <article> weighs at least.
MARKED = 4
#: A name alone makes an element boilerplate only while the lines without such names hold at least this share of its text.
NAMED = 0.25
# Possessive, so each tag is read once: attributes end at the first > outside of quotes, and < starts a new tag.
TAG = re.compile(r"<(/?)([a-zA-Z][^\s/><]*+)((?:[^<>\"'=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+|[\"'])*+)>")
ATTRIBUTE = re.compile(r"([^\s=\"'/]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"']++)))?+")
# Elements of HTML by what they do here.
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset("script style textarea title noscript iframe noembed noframes xmp nav footer aside form template button select datalist dialog menu head svg math object canvas audio video map".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rb rp rt ruby s samp small span strike strong sub sup time tt u var wbr img".split())
OUTSIDE = frozenset("ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist consent contentinfo cookie cookies disqus dialog foot footer form gdpr header login masthead menu modal nav navbar navigation newsletter notice notices outbrain overlay pager pagination popup promo promos promotion recommended related replies reply respond search share sharing sidebar sidebars signup skip social sponsor sponsored subscribe subscription taboola tags toc toolbar widget widgets complementary".split())
#: Elements whose end tag may be left out, and the elements in whose midst the next one of its kind does not end it.
ENDED_BY_NEXT = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table", "tr"), "th": ("table", "tr"), "option": ("select",)}
BLOCKS = ("div", "td", "th", "li", "section", "article", "main", "blockquote", "table", "button", "object")
ALSO_ENDS = {"dt": ("dd",), "dd": ("dt",), "td": ("th",), "th": ("td",)}


@dataclass
class Element:
    """An open element. One that is boilerplate knows the next such element around it.

    dropped by what it is, named by a class or the like; either counts only if the element has an end of its own.
    """

    name: str
    named: bool = False
    dropped: bool = False
    outer: Element | None = None
    ended: bool = False
    split: bool = False
    plain: int = 0
    article: bool = False
    gone: bool = False
    doubted: bool = False


@dataclass
class Line:
    text: str
    plain: int
    article: bool
    inside: Element | None


def tags(page: str) -> Iterator[tuple[str, str, bool, str]]:
    """(text before it, name, whether an end tag, attributes) of each tag, and the last text with no name."""
    at = start = 0
    last = page.rfind(">")
    pieces: list[str] = []
    endless: set[str] = set()
    while (at := page.find("<", at)) >= 0:
        if page.startswith("<!--", at):
            pieces.append(page[start:at])
            end = page.find("-->", at + 4)
            at = start = len(page) if end < 0 else end + 3
        elif page.startswith(("<!", "<?"), at):
            pieces.append(page[start:at])
            end = page.find(">", at)
            at = start = len(page) if end < 0 else end + 1
        elif at < last and (m := TAG.match(page, at)):
            pieces.append(page[start:at])
            name = m[2].lower()
            at = start = m.end()
            yield "".join(pieces), name, bool(m[1]), m[3]
            pieces = []
            if name in RAW and not m[1] and name not in endless:
                end = re.compile(rf"</{re.escape(name)}(?![a-z0-9-])[^>]*+>", re.I).search(page, at)
                if end:
                    at = start = end.end()
                    yield "", name, True, ""
                elif name in ("script", "style"):
                    at = start = len(page)
                else:
                    endless.add(name)
        else:
            at += 1
    yield "".join(pieces) + page[start:], "", False, ""


def hints(attributes: str) -> tuple[bool, bool]:
    """Whether the names in the attributes are those of boilerplate, and whether the element is hidden."""
    if not attributes:
        return False, False
    named = hidden = False
    for key, *values in ATTRIBUTE.findall(attributes):
        key, value = key.lower(), "".join(values)
        if key in ("class", "id", "role", "aria-label"):
            named = named or not OUTSIDE.isdisjoint(re.split(r"[^a-z]+", value.lower()))
        elif key == "hidden":
            hidden = value.lower() != "false"
        elif key == "style" and re.search(r"(?:^|;)\s*display\s*:\s*none", value, re.I):
            hidden = True
    return named, hidden


def lines(page: str) -> tuple[list[Line], list[Element]]:
    """The blocks in page order, and the boilerplate elements in the order in which they begin."""
    out: list[Line] = []
    around: list[Element] = []
    parts: list[str] = []
    open_: list[Element] = []
    many: Counter = Counter()
    inner: Element | None = None
    plain = anchors = 0

    def flush() -> None:
        nonlocal plain
        if text := " ".join(entities.unescape("".join(parts)).split()):
            out.append(Line(text, plain, many["article"] > 0, inner))
        parts.clear()
        plain = 0

    def close(to: int) -> None:
        nonlocal inner
        flush()
        open_[to].ended = True
        for e in open_[to:]:
            many[e.name] -= 1
        inner = next((e.outer for e in open_[to:] if e.named or e.dropped), inner)
        del open_[to:]

    def begin(name: str, named: bool, dropped: bool, outer: Element | None) -> Element:
        e = Element(name, named, dropped, outer, article=many["article"] > 0)
        if named or dropped:
            around.append(e)
        return e

    for text, name, closing, attributes in tags(page):
        if text:
            parts.append(text)
            plain += 0 if anchors else len(text.strip())
        if not name:
            continue
        if name == "a":
            anchors = max(0, anchors + (-1 if closing else 1))
        inline = name in INLINE
        if not inline:
            flush()
            anchors = 0 if name == "body" else anchors
        if closing:
            if many[name]:
                k = len(open_) - 1
                while open_[k].name != name and not (inline and open_[k].name not in INLINE):
                    k -= 1
                if open_[k].name == name:  # an inline element ends only within its block
                    close(k)
            continue
        if name in VOID or name in ("html", "body"):
            continue
        if not inline:  # an open paragraph, item or cell ends where the next block begins
            ends = (name, *ALSO_ENDS.get(name, ())) if name in ENDED_BY_NEXT else ("p",)
            if any(many[x] for x in ends):
                k = len(open_) - 1
                while open_[k].name not in ends and open_[k].name not in ENDED_BY_NEXT.get(name, BLOCKS):
                    k -= 1
                    if k < 0:
                        break
                if k >= 0 and open_[k].name in ends:
                    close(k)
        named, hidden = hints(attributes)
        dropped = hidden or name in DROPPED or (name == "header" and not many["article"])
        if attributes.rstrip().endswith("/") and name in ("svg", "math", "object", "canvas", "iframe"):
            continue
        if inline and not (named or dropped or many[name]):
            continue  # plain inline elements need no place among the open ones
        if name in ("article", "main") and inner and not inner.split:
            # boilerplate that was never closed does not swallow an article: what comes before it stands alone
            inner = None
            for k, e in enumerate(open_):
                if e.named or e.dropped:
                    e.ended = True
                    open_[k] = inner = begin(e.name, e.named, e.dropped, inner)
                    inner.split = True
        if named or dropped:
            flush()
        e = begin(name, named, dropped, inner)
        if named or dropped:
            e.split = bool(inner and inner.split)
            inner = e
        open_.append(e)
        many[name] += 1
    flush()
    return out, around


def between(weights: list[int], window: int = WINDOW, surge: float = SURGE, dive: float = DIVE) -> tuple[int, int]:
    """First line and end of the text between the first surge and the last dive of the sums over window lines.

    A surge is where the sums of the weights (LONG at most) reach `surge` of their maximum. From the first one the
    text reaches back, and from the last one on, while the sums stay above `dive` of it; what lies between two
    surges belongs to it whatever it weighs. Lines without weight at its ends do not.
    """
    capped = [min(w, LONG) for w in weights]
    n = len(capped)
    sums = [sum(capped[max(0, i - window // 2) : i + window // 2 + 1]) for i in range(n)]
    top = max(sums, default=0)
    if not top:
        return 0, 0
    surges = [i for i, s in enumerate(sums) if s >= surge * top]
    a, b = surges[0], surges[-1]
    while a and sums[a - 1] > dive * top and capped[a - 1]:
        a -= 1
    while b < n and sums[b] > dive * top:
        b += 1
    while not capped[a]:
        a += 1
    while not capped[b - 1]:
        b -= 1
    return a, b


def article_lines(found: list[Line], around: list[Element]) -> list[Line]:
    """The lines outside of boilerplate.

    Elements that never hold an article are left out. Those whose name says so are left out too, but where the lines
    without such names hold nearly nothing, the elements that hold most of the rest are kept: their name misleads.
    Where an article element holds lines without such names, only elements within one can be kept so.
    """
    for e in around:
        e.gone = (e.dropped and e.ended) or bool(e.outer and e.outer.gone)
    found = [x for x in found if not (x.inside and x.inside.gone)]
    for e in around:
        e.doubted = (e.named and e.ended) or bool(e.outer and e.outer.doubted)
        e.plain = 0
    apart = total = 0
    clear = False
    for x in found:
        doubted = x.inside is not None and x.inside.doubted
        total += x.plain
        apart += x.plain if doubted else 0
        clear = clear or (x.article and not doubted)
        if x.inside:
            x.inside.plain += x.plain
    for e in reversed(around):
        if e.outer:
            e.outer.plain += e.plain
    misleading = total - apart < NAMED * apart
    for e in around:
        own = e.named and e.ended and not (misleading and 2 * e.plain >= apart and (e.article or not clear))
        e.gone = own or bool(e.outer and e.outer.gone)
    return [x for x in found if not (x.inside and x.inside.gone)]


def main_text(page: str) -> str:
    """The text between surge and dive, by the lines' lengths and by what surrounds them.

    If lines inside article elements hold most of the text, the others weigh nothing and are left out.
    """
    found = article_lines(*lines(page))
    within = sum(x.plain for x in found if x.article)
    marked = within > 0 and 2 * within >= sum(x.plain for x in found)
    weights = [x.plain if not marked else max(MARKED, x.plain) if x.article else 0 for x in found]
    a, b = between(weights)
    return " ".join(x.text for x, weight in zip(found[a:b], weights[a:b], strict=True) if weight or not marked)


def extract_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars: one row per row of pages.

    A null or empty html, and a page without any text, gives the empty text. Every run of white space (that of Unicode,
    so also no-break spaces) becomes one space. Null page_ids and urls stay null;
    repeated rows give equal rows; an empty table gives none. Columns other than page_id, url and html are ignored.
    """

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h or "") for h in batch["html"].to_pylist()]
            yield pa.RecordBatch.from_pydict({"page_id": batch["page_id"], "url": batch["url"], "text": pa.array(texts, pa.string()), "n_chars": pa.array([len(t) for t in texts], pa.int64())})

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    return rows.mapInArrow(extract, "page_id long, url string, text string, n_chars long")
