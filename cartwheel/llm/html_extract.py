"""Main text of web pages by text-to-tag ratio.

Each page is fed to the standard library's streaming ``HTMLParser``; its events
build *lines*, one per run of text between block boundaries, that know their
number of tags and their place in the open elements. The text-to-tag ratio of
each line is smoothed with a Gaussian, and the smoothed ratios are clustered by
a threshold (their standard deviation, at most their mean): the lines above it
are content. These lines vote with their length for the containers that hold
them; from the body the walk goes down while one child holds most of the votes,
and stops at an article or main element. It never enters a quotation, a cell, a
section, or one of several articles. The text has every content line of the page
and all other lines of the region found, short ones included, less boilerplate
elements: by tag, role or hidden state, or by a word of their class or id - inside
an article or main element only if the rest of that name is layout vocabulary.

Character references are decoded by the parser, white space inside a line
becomes one space, lines are trimmed, empty lines vanish, the rest are joined
by a newline. Pages are independent: extraction is one Arrow-batched column
expression without a shuffle.

Defined results: null, empty or text-free pages give the empty string; a page
that ends inside a tag, a reference or an open element gives what was read;
repeated pages are treated row by row; input columns named like an added
column are replaced; an empty table gives an empty table. Elements may be open
to any depth.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.llm.common import without

SIGMA, RADIUS = 1.0, 2
MOST = 0.7

# HTML element classes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search "
    "section summary table tbody td tfoot th thead tr ul title".split())
CONTAINER = frozenset("body article main section div td blockquote".split())
ENTERED = frozenset("body article main div".split())
BOILERPLATE_TAGS = frozenset(
    "head script style noscript template nav footer aside form button select textarea input iframe object "
    "svg canvas menu dialog audio video map applet embed search datalist".split())
BOILERPLATE_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar "
    "status tablist".split())
BOILERPLATE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adslot banner sponsor sponsors sponsored promo "
    "promos promotion promoted sidebar sidebars rail menu menus nav navs navbar navigation breadcrumb breadcrumbs "
    "footer foot header masthead topbar cookie cookies consent gdpr notice notices popup modal overlay newsletter "
    "subscribe subscription signup share sharing social related recommended recommendations comment comments "
    "commentlist discussion disqus respond replies reply widget widgets toolbar login pagination pager copyright "
    "colophon skip hidden paywall".split())
LAYOUT_WORDS = frozenset(
    "area aside bar block body bottom box btn button card cards center close column container content cta entry "
    "first form fixed footer global group head heading header inline inner items item label large last layer left "
    "link links list main middle mobile desktop module more outer page panel placeholder post posts primary right "
    "row secondary section site slot small sticky strip tag tags text title top unit view wrap wrapper zone".split())
STATE_WORDS = frozenset("has with without no not".split())
# An element of these kinds ends the open element of the kind above it, up to its list or table.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
          "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
PARAGRAPH_BOUND = frozenset("div article section main td th li blockquote body aside nav footer header form".split())
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def _names_boilerplate(name: str, tag: str, inside: bool) -> bool:
    """Whether one class or id says boilerplate; states such as
    ``has-sidebar`` don't, and an article must be called so first of all.
    ``inside`` an article a name such as ``social-history`` doesn't either."""
    words = [w.lower() for w in _WORD.findall(name)]
    if STATE_WORDS.intersection(words):
        return False
    if inside and not all(w in BOILERPLATE_WORDS or w in LAYOUT_WORDS for w in words):
        return False
    return any(w in BOILERPLATE_WORDS for w in (words[:1] if tag == "article" else words))


class PageLines(HTMLParser):
    """Collects lines as [text parts, tags, container, is boilerplate, tag]."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        # open elements: (tag, container number, is boilerplate)
        self.open: list[tuple[str, int, bool]] = []
        self.count: dict[str, int] = {}  # open elements by tag
        self.parents: list[int] = [-1]
        self.kinds: list[str] = ["page"]
        self.lines: list[list] = []
        self.line: list = [[], 0, 0, False, ""]

    def _break(self) -> None:
        if self.line[0]:
            self.lines.append(self.line)
        _, container, boiler = self.open[-1] if self.open else ("", 0, False)
        self.line = [[], 0, container, boiler, self.open[-1][0] if self.open else ""]

    def _is_boilerplate(self, tag: str, attrs: list) -> bool:
        if tag in BOILERPLATE_TAGS:
            return True
        inside = bool(self.count.get("article") or self.count.get("main"))
        if tag == "header":
            return not inside
        if tag in ("html", "body", "main"):
            return False
        for name, value in attrs:
            if name == "hidden" or (name == "aria-hidden" and value == "true"):
                return True
            if not value:
                continue
            if name == "role" and value.strip().lower() in BOILERPLATE_ROLES:
                return True
            if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                return True
            if name in ("class", "id") and any(_names_boilerplate(w, tag, inside) for w in value.split()):
                return True
        return False

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self.line[1] += 1
        if tag in VOID:
            if tag in BLOCK:
                self._break()
            elif tag == "br":
                self.line[0].append(" ")
            return
        if tag in CLOSES:
            self._close(*CLOSES[tag])
        elif tag in BLOCK:
            self._close({"p"}, PARAGRAPH_BOUND)
        _, container, boiler = self.open[-1] if self.open else ("", 0, False)
        boiler = boiler or self._is_boilerplate(tag, attrs)
        if tag in CONTAINER:
            self.parents.append(container)
            self.kinds.append(tag)
            container = len(self.kinds) - 1
        self.open.append((tag, container, boiler))
        self.count[tag] = self.count.get(tag, 0) + 1
        if tag in BLOCK or boiler != self.line[3]:
            self._break()
            self.line[1] = 1

    def _end(self, at: int) -> None:
        for tag, _, _ in self.open[at:]:
            self.count[tag] -= 1
        del self.open[at:]

    def _close(self, kinds: set, bound: frozenset | set) -> None:
        if not any(self.count.get(k) for k in kinds):
            return
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] in kinds:
                self._end(i)
                return
            if self.open[i][0] in bound:
                return

    def handle_endtag(self, tag: str) -> None:
        self.line[1] += 1
        if self.count.get(tag):
            for i in range(len(self.open) - 1, -1, -1):
                if self.open[i][0] == tag:
                    self._end(i)
                    break
        boiler = self.open[-1][2] if self.open else False
        if tag in BLOCK or boiler != self.line[3]:
            self._break()

    def handle_data(self, data: str) -> None:
        self.line[0].append(data)


def smoothed(ratios: list[float]) -> list[float]:
    kernel = [math.exp(-d * d / (2 * SIGMA * SIGMA)) for d in range(-RADIUS, RADIUS + 1)]
    out = []
    for i in range(len(ratios)):
        total = weight = 0.0
        for d, k in zip(range(-RADIUS, RADIUS + 1), kernel):
            if 0 <= i + d < len(ratios):
                total, weight = total + k * ratios[i + d], weight + k
        out.append(total / weight)
    return out


def content_region(parser: PageLines, lines: list[tuple]) -> tuple[int, list[bool]]:
    """Container of the main text, and which lines are content by their ratio.
    ``lines``: (text, tags, container, boilerplate, tag)."""
    ratios = smoothed([len(t) / max(1, tags) for t, tags, _, _, _ in lines])
    mean = sum(ratios) / len(ratios)
    threshold = min(mean, math.sqrt(sum((r - mean) ** 2 for r in ratios) / len(ratios)))
    content = [not boiler and ratio >= threshold for (_, _, _, boiler, _), ratio in zip(lines, ratios)]
    votes = [0] * len(parser.kinds)
    total = 0
    for (text, _, container, _, _), high in zip(lines, content):
        if high:
            total += len(text)
            while container >= 0:
                votes[container] += len(text)
                container = parser.parents[container]
    children: dict[int, list[int]] = {}
    for c, parent in enumerate(parser.parents):
        children.setdefault(parent, []).append(c)
    at = 0
    while parser.kinds[at] not in ("article", "main") and children.get(at):
        best = max(children[at], key=lambda c: (votes[c], -c))
        several = sum(parser.kinds[c] == "article" and votes[c] > 0 for c in children[at]) > 1
        if votes[best] < MOST * total or not total or parser.kinds[best] not in ENTERED or \
                (several and parser.kinds[best] == "article"):
            break
        at = best
    return at, content


def main_text(html: str | None) -> str:
    if not html:
        return ""
    parser = PageLines()
    parser.feed(html)
    parser.close()
    parser._break()
    lines = []
    for parts, tags, container, boiler, tag in parser.lines:
        text = " ".join("".join(parts).split())
        if text:
            lines.append((text, tags, container, boiler, tag))
    if not any(not boiler for _, _, _, boiler, _ in lines):
        return ""
    region, content = content_region(parser, lines)
    inside = [False] * len(parser.kinds)
    for c in range(len(parser.kinds)):  # parents come first
        inside[c] = c == region or (parser.parents[c] >= 0 and inside[parser.parents[c]])
    kept = [i for i, (_, _, c, boiler, _) in enumerate(lines) if content[i] or (inside[c] and not boiler)]
    if kept and not any(lines[i][4] == "h1" for i in kept):  # a title just outside the region
        title = [i for i in range(kept[0]) if lines[i][4] == "h1" and not lines[i][3]]
        kept = title[-1:] + kept
    return "\n".join(lines[i][0] for i in kept)


def extract_main_text(pages: DataFrame, html_col: str = "html", out_col: str = "text") -> DataFrame:
    """All rows and columns of ``pages`` plus the main text."""
    @F.pandas_udf(T.StringType())
    def extract(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for html in series:
            yield pd.Series([main_text(h) for h in html], dtype="object")

    return pages.select(*without(pages, (out_col,)), extract(F.col(html_col).cast("string")).alias(out_col))
