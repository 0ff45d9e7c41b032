"""Main text of web pages by line-block distribution.

Markup is stripped into lines, one per block element; removed elements within a line leave a space. What is no part of an
article by its element, role or class (menus, page headers, footers, sidebars, notices, adverts, forms, scripts, styles,
reader comments) leaves nothing, so that text before and after it stays together, and so do
lines outside articles that are mostly links.

Every line of an article or main element stays, where a page has one with most of its text. On other
pages the lengths of lines are summed over a sliding window of WINDOW lines, where a line counts that reads as text: a
paragraph, an item, a heading, or another line that is long or ends like a sentence. Text dives where the sum falls to nothing and surges where it
rises from nothing to SURGE; what lies between a surge and its dive is kept, without lines at its ends that don't
count (a date, a place name, a heading with nothing behind it) and without notices of copyright. If no sum reaches SURGE, the lines between two dives with most
text are kept.

Two rules are taken back where they would cost a
page its text: a class or id removes nothing that holds more than half of the page's text, unless it
names replies and what is left reaches SURGE; and articles (a main element always counts) with less
text than lies outside them, links aside, are lines like all others. Ids remove nothing inside articles, and
headings go by no class or id: these are names to link to.

A null or empty html gives an empty text. Unclosed and crossed tags, unfinished comments and tags,
and markup of any length are read as far as they go. Repeated rows and null ids each give a row. An
empty table gives none. Other columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

WINDOW = 3
SURGE = 80
#: A line of which links make up more than this is a menu's, outside articles, unless it is an item as long as a reference.
LINKS = 0.5
REFERENCE = 40
#: A line of this length reads as text, whatever its element and its end.
TEXT = 40

_TOKEN = re.compile(
    r"<!--(?:(?!-->).)*+(?:-->|\Z)"
    r"|<[!?][^>]*+(?:>|\Z)"
    r"""|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attributes>(?:[^>"']|"[^"]*+"|'[^']*+')*+)>"""
    r"|<(?P<close2>/?)(?P<name2>[a-zA-Z][^\s/>]*+)(?P<attributes2>[^>]*+)(?:>|\Z)"
    r"|(?P<text>[^<]++|<)", re.S)
_ATTRIBUTE = re.compile(r"""(?i)(?<![^\s"'/])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")

#: Fixed sets of HTML's elements.
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_RAW = frozenset("script style textarea title noscript template iframe noembed noframes xmp".split())
_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section select summary "
    "table tbody td tfoot th thead tr ul".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements whose lines read as text however short they are.
_TEXT = frozenset("p li dd dt pre blockquote figcaption summary".split())
_ENDS = tuple(".!?:;\u2026\u201d\u00bb\"'\u3002\uff01\uff1f")
_RIGHTS = re.compile(r"(?i)(?:\u00a9|\(c\)|copyright)\s*(?:\(c\)|\u00a9)?\s*(?:19|20)\d\d|all rights reserved")
_CLOSES_P = _BLOCK - frozenset("body head html option td th tr tbody thead tfoot".split())
#: Not part of an article, whatever their class.
_NO_TEXT = frozenset(
    "nav footer aside form menu dialog button select datalist svg canvas object video audio map head".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
#: Words of a class or id: of these one is enough,
_ALWAYS = frozenset(
    "ad ads adv advert advertisement advertising sponsor sponsored promo promotion sidebar cookie cookies consent gdpr "
    "popup modal newsletter subscribe signup share sharing social comment comments disqus respond reply replies related "
    "discussion commentlist commentarea recommended recommendations pagination pager breadcrumb breadcrumbs toolbar login widget navbar".split())
#: these need to stand without a word of an article's own parts.
_UNLESS = frozenset("header footer nav navigation menu masthead topbar notice banner alert search skip".split())
_OWN = frozenset("article entry post content story title headline main".split())
#: What readers wrote may be more than the article.
_REPLIES = frozenset("comment comments discussion commentlist commentarea disqus respond reply replies".split())
_HUMP = re.compile(r"(?<=[a-z])(?=[A-Z])")
#: Why an element is no part of an article.
_SURE, _NAMED, _REPLY = 1, 2, 3


def _is_other(name: str, attributes: str, in_article: bool) -> int:
    """Why an element is no part of an article; 0 if it may be one."""
    if name in _NO_TEXT or name == "header" and not in_article:
        return _SURE
    if name in ("body", "html", "article", "main") or not attributes.strip():
        return 0
    why = 0
    for key, value in _ATTRIBUTE.findall(attributes):
        key, words_in = key.lower(), value.strip("\"'")
        value = words_in.lower()
        if key == "hidden" or key == "aria-hidden" and value == "true":
            return _SURE
        if key == "role" and value in _ROLES:
            return _SURE
        if key == "style" and "display:none" in value.replace(" ", ""):
            return _SURE
        if name not in _HEADINGS and (key == "class" or key == "id" and not in_article and name != "p"):
            words = set(re.split(r"[^a-z]+", _HUMP.sub(" ", words_in).lower()))
            if words & _ALWAYS or words & _UNLESS and not words & _OWN:
                why = _REPLY if why == _REPLY or words & _REPLIES else _NAMED
    return why


class _Lines:
    """Lines of a page: text, whether it lies in an article, how much of it is links, and the element it lies in."""

    def __init__(self):
        self.lines: list[tuple[str, int, int, str]] = []
        self.parts: list[str] = []
        self.links = 0
        self.within = ""

    def text(self, text: str, linked: bool) -> None:
        self.parts.append(text)
        if linked:
            self.links += len(text.strip())

    def end(self, in_article: int) -> None:
        if self.parts:
            line = " ".join(html.unescape("".join(self.parts)).split())
            if line:
                self.lines.append((line, in_article, self.links, self.within))
        self.parts, self.links = [], 0


def lines_of(page: str, spared: frozenset[int] = frozenset()) -> tuple[list[tuple[str, int, int, str]], list[tuple[int, int, int]], int]:
    """The page's lines, without what is no article's; place, why and length of what a class or id names; the length of all.

    What begins at a place in ``spared`` stays, whatever its class or id.
    """
    out = _Lines()
    stack: list[tuple[str, int, int, bool]] = []  # name, other, in article or (2) main, in link
    open_names: Counter[str] = Counter()
    named: list[tuple[int, int, int, int]] = []  # depth, place, why, text before
    sizes: list[tuple[int, int, int]] = []
    seen = 0

    def pop_from(place: int) -> tuple[int, int, bool]:
        open_names.subtract(x[0] for x in stack[place:])
        del stack[place:]
        while named and named[-1][0] >= place:
            _, begin, why, before = named.pop()
            sizes.append((begin, why, seen - before))
        return stack[-1][1:] if stack else (0, 0, False)

    other, article, linked = 0, 0, False
    at = 0
    while at < len(page):
        m = _TOKEN.match(page, at)
        at = m.end()
        text = m["text"]
        if text is not None:
            if other != _SURE:
                seen += len(text.strip())
            if not other:
                if not out.parts:
                    out.within = next((x[0] for x in reversed(stack) if x[0] in _BLOCK), "")
                out.text(text, linked)
            continue
        name = m["name"] or m["name2"]
        if name is None:
            continue
        name = name.lower()
        if m["close"] or m["close2"]:
            if name in _BLOCK and not other:
                out.end(article)
            if open_names[name] > 0:
                was = other
                other, article, linked = pop_from(next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name))
                if was and not other:
                    out.end(article) if name in _BLOCK else out.text(" ", False)
            continue
        attributes = m["attributes"] if m["attributes"] is not None else m["attributes2"] or ""
        if name in _CLOSES_P:
            place = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == "p" or stack[i][0] in _BLOCK), None)
            if place is not None and stack[place][0] == "p" and not stack[place][1]:
                other, article, linked = pop_from(place)
        if name in _BLOCK and not other:
            out.end(article)
        elif name == "br" and not other:
            out.text(" ", False)
        if name in _VOID:
            continue
        if name in _RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        now_article = max(article, 2 if name == "main" else int(name == "article"))
        why = 0 if other == _SURE else _is_other(name, attributes, article > 0)
        if why > _SURE:
            named.append((len(stack), m.start(), why, seen))
            if m.start() in spared:
                why = 0
        now_other = _SURE if why == _SURE else other or why
        if now_other and not other and name not in _BLOCK:
            out.text(" ", False)
        open_names[name] += 1
        stack.append((name, now_other, now_article, linked or name == "a"))
        other, article, linked = stack[-1][1:]
    out.end(article)
    pop_from(0)
    return out.lines, sizes, seen


def main_text(page: str | None) -> str:
    """The article's blocks, one to a line."""
    page = page or ""
    lines, sizes, total = lines_of(page)
    spared: frozenset[int] = frozenset()
    for why in (_NAMED, _REPLY):
        large = {place for place, w, n in sizes if w == why and n >= SURGE and 2 * n > total}
        if large and (why == _NAMED or sum(len(text) for text, *_ in lines) < SURGE):
            spared |= large
            lines = lines_of(page, spared)[0]
    lines = [line for line in lines if line[1] or not _is_menu(line)]
    within = sum(len(text) for text, inside, *_ in lines if inside)
    beside = sum(len(text) for text, inside, *_ in lines if not inside)
    if any(inside == 2 for _, inside, *_ in lines) or within and beside < max(SURGE, within + 1):
        return "\n".join(text for text, inside, *_ in lines if inside)
    return "\n".join(_dense([line for line in lines if line[1] or not _RIGHTS.search(line[0])]))


def _is_menu(line: tuple[str, int, int, str]) -> bool:
    text, _, links, within = line
    return links > LINKS * len(text) and not (within == "li" and len(text) >= REFERENCE)


def _weight(line: tuple[str, int, int, str]) -> int:
    """A line's length, if it reads as text."""
    text, inside, _, within = line
    reads = inside or within in _TEXT or within in _HEADINGS or len(text) >= TEXT or text.endswith(_ENDS)
    return len(text) if reads else 0


def _dense(lines: list[tuple[str, int, int, str]]) -> list[str]:
    """Texts of the lines between surges and dives of the windowed sums."""
    weights = [_weight(line) for line in lines]
    if not any(weights):
        weights = [len(text) for text, *_ in lines]
    sums = [sum(weights[max(0, i - WINDOW + 1) : i + 1]) for i in range(len(weights))]
    found: list[tuple[int, int, int]] = []  # highest sum, first and end of the lines
    surge = None
    for i, s in enumerate([*sums, 0]):
        if s and surge is None:
            surge = i
        elif not s and surge is not None:
            found.append((max(sums[surge:i]), surge, i))
            surge = None
    kept = [f for f in found if f[0] >= SURGE]
    if not kept and found:
        kept = [max(found, key=lambda f: (sum(weights[f[1] : f[2]]), -f[1]))]
    out = []
    for _, a, b in kept:
        while b > a and (not weights[b - 1] or lines[b - 1][3] in _HEADINGS and b - 1 > a and not lines[b - 1][1]):
            b -= 1
        out += [text for text, *_ in lines[a:b]]
    return out


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(page) for page in batch.column(2).to_pylist()]
        yield pa.record_batch([
            batch.column(0), batch.column(1), pa.array(texts, pa.string()),
            pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", markup: str = "html") -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    rows = pages.select(
        pages[page_id].cast("long").alias("page_id"), pages[url].cast("string").alias("url"), pages[markup].alias("html"))
    return rows.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")


def op1_line_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
