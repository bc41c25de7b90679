"""Operator 9: main text of web pages by the line-block distribution of their text.

Markup is stripped into lines, one per block; a tag that opens or ends a part of the page (a division, a section)
leaves an empty line. A line weighs its characters outside links, a heading all of its characters; lines of menus,
notices and the like weigh nothing. A line's block weight is the sum over a window that starts there. Text starts at
a surge (a block weight over the threshold after silence) and ends at the dive (the weights fall to nothing); all that
lies between and is no boilerplate is kept, and so are headings right before a surge and the other lines of a part of
the page (a division, a section) whose own text surges. The threshold sinks to the
page's own peak where a page is short, so a short article is still found.

A page that marks its article (`article`, `main`, or those roles) is judged article by article: one that surges is
kept from its first line to its last, one that does not (a teaser, a card of links) goes. Other pages are judged by
the distribution over all lines.

Words of class, id and role attributes tell boilerplate by whole layout tokens ("site-footer", "ad", "cookie-banner",
not "with-sidebar"); they never silence main, body or a heading, and of articles only those marked as comments. Inside an
article, words that it may use of itself (related, share, header, ...) count only for parts that are mostly links.
Where the marks would leave next to nothing, the page is read again without them.

Defined cases: null or empty html, and pages without a line of text, give empty text; unclosed comments, scripts and
styles run to the end of the page, other unclosed elements end with the element around them; an attribute without a
closing quote ends at white space; repeated rows keep their rows; older columns of the output's name are replaced and
all others kept; an empty table gives an empty table; pages of any length and depth are read whole, in one pass.
"""

from __future__ import annotations

import html as entities
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import add_columns

#: Lines in a window, and the block weight that counts as a surge.
WINDOW, SURGE = 3, 86
#: Share of a page's text that must be left by class marks, where less than a surge is left.
LEFT = 0.05

#: HTML elements by role.
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark meter nobr output progress q rb rp rt rtc ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
SILENT = set("nav header footer aside form head select option button object embed svg math canvas audio video map dialog menu datalist fieldset legend template".split())
RAW = set("script style textarea title iframe noscript".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
PARTS = set("div section article main nav header footer aside form table center blockquote".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
MAIN = {"article", "main"}
MAIN_ROLES = {"main", "article", "articlebody"}

#: Words of class, id and role attributes that mark boilerplate; those that mark it inside an article
#: only where links prevail; words of reader comments; words for a part of such a thing; and words that name a
#: relation to one ("has-sidebar").
NOISE = set(
    """ad ads advert adverts advertisement advertisements advertising adsense banner sponsor sponsored sponsors promo promos promotion cookie cookies consent gdpr notice notices
    popup modal overlay comment comments commentlist disqus replies reply respond sidebar sidebars widget widgets menu menus nav navbar navigation breadcrumb breadcrumbs pagination
    pager footer contentinfo complementary""".split()
)
WEAK = set("alert foot header masthead topbar toolbar related recommended recommendations recommend share sharing social subscribe newsletter signup login search disclaimer".split())
COMMENTS = set("comment comments commentlist disqus replies reply respond".split())
PIECE = set("area bar block body bottom box button buttons card container content form inner item items label left link links list main outer panel right row section slot text thread title top unit wrap wrapper".split())
RELATION = set("has with no without is not hide hides show shows".split())

TAG = re.compile(
    r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|[^\s/>=][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>]*+))?+|=)*+)(?:>|\Z)"""
)
ATTRIBUTE = re.compile(r"""(?:^|(?<=[\s/"']))([^\s/>="'][^\s/>=]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]*+)))?+""")
TELLING = re.compile(r"class|id|role|label|hidden|itemprop", re.I)
RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*+>?", re.I) for name in RAW}
SPACE = re.compile(r"\s+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


def marks(attributes: str) -> tuple[bool, bool, bool, bool]:
    """Whether attributes mark boilerplate, perhaps boilerplate, reader comments, and a main element."""
    noise = weak = comments = main = False
    if not TELLING.search(attributes):
        return noise, weak, comments, main
    for name, *values in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values)
        if name == "hidden":
            noise = True
        elif name == "itemprop" and value.strip().lower() == "comment":
            noise = comments = True
        elif name in ("role", "itemprop") and value.strip().lower() in MAIN_ROLES:
            main = True
        elif name in ("class", "id", "role", "aria-label"):
            for token in value.split():
                words = [w for w in re.split(r"[\W_\d]+", CAMEL.sub("-", token).lower()) if w]
                if not words or words[0] in RELATION:
                    continue
                if token.lower() == "hidden":
                    noise = True
                # the last word says what it is; a word for a piece says it is one of the first
                named = {words[-1], words[0] if words[-1] in PIECE else words[-1], "sidebar" if words[:2] == ["side", "bar"] else words[-1]}
                noise |= not named.isdisjoint(NOISE)
                weak |= not named.isdisjoint(WEAK)
                comments |= not named.isdisjoint(COMMENTS)
    return noise, weak, comments, main


class Element:
    """An open element that can enclose lines, by what it says of them."""

    __slots__ = ("name", "silent", "comments", "main", "heading", "header", "weak", "hushed", "closed")

    def __init__(self, name: str, silent: bool, comments: bool, main: bool, header: bool, weak: bool):
        self.name, self.silent, self.comments, self.main, self.header, self.weak = name, silent, comments, main, header, weak
        self.heading = name in HEADINGS
        #: the silence that a main element suspends, and whether the element's own end tag came
        self.hushed, self.closed = 0, False


class Lines:
    """The lines of a page: text ("" for the edge of a part and for boilerplate), weight, whether it is a heading, and
    the number of the main element around (0: none)."""

    def __init__(self, page: str, by_marks: bool = True):
        self.by_marks = by_marks
        self.text: list[str] = []
        self.weight: list[int] = []
        self.heading: list[bool] = []
        self.zone: list[int] = []
        self.part: list[int] = []  # the number of the innermost part around
        #: characters outside links that boilerplate has
        self.silenced = 0
        self._weak_of: list[int] = []  # by line: the part whose links decide, 0: none
        self._weak_size: list[list[int]] = [[0, 0]]  # by such part: characters, and those in links
        self._owner: list[Element | None] = [None]  # by main element: the boilerplate that it stands in
        self._parts: list[str] = []
        self._linked: list[str] = []
        self._in_link = 0
        self._hushed: tuple[str, int] | None = None  # an inline element that marks silence, and its depth
        self._quiet_p = False
        self._open: list[Element] = []
        self._at: dict[str, list[int]] = {}  # places in _open by name
        self._parts_open, self._n_parts = [0], 0
        self._mains: list[int] = []  # places of main elements in _open
        self._outer: Element | None = None  # the outermost boilerplate
        self._silent = self._comments = self._headings = self._headers = self._weak = 0  # open elements of the kind
        self._read(page)
        for i, (zone, weak) in enumerate(zip(self.zone, self._weak_of, strict=True)):
            owner, (size, linked) = self._owner[zone], self._weak_size[weak]
            if owner is not None and owner.closed or weak and 2 * linked >= size:
                self.silenced += self.weight[i]
                self.text[i], self.weight[i] = "", 0

    def _line(self, text: str, weight: int, heading: bool) -> None:
        self.text.append(text)
        self.weight.append(weight)
        self.heading.append(heading)
        self.zone.append(len(self._owner) - 1 if self._mains else 0)
        self.part.append(self._parts_open[-1])
        self._weak_of.append(len(self._weak_size) - 1 if self._weak else 0)

    def _end_line(self) -> None:
        text = SPACE.sub(" ", entities.unescape("".join(self._parts))).strip() if self._parts else ""
        if text:
            linked = len(SPACE.sub(" ", entities.unescape("".join(self._linked))).strip()) if self._linked else 0
            heading, free = self._headings > 0, max(0, len(text) - linked)
            if self._silent or self._quiet_p or self._headers and not heading:
                self.silenced += free
                self._line("", 0, False)
            else:
                self._line(text, len(text) if heading else free, heading)
                if self._weak:
                    self._weak_size[-1][0] += len(text)
                    self._weak_size[-1][1] += linked
        self._parts, self._linked, self._hushed, self._quiet_p = [], [], None, False

    def _start(self, name: str, attributes: str) -> None:
        noise, weak, comments, main = marks(attributes) if attributes else (False,) * 4
        if not self.by_marks:
            noise = weak = comments = False
        if name in INLINE:
            if self._hushed:
                if self._hushed[0] == name:
                    self._hushed = (name, self._hushed[1] + 1)
            elif noise and name not in VOID:
                self._hushed = (name, 1)
            if name == "a":
                self._in_link += 1
            return
        self._end_line()
        self._in_link = 0
        if name in VOID:
            return
        if name == "p":
            self._quiet_p = noise
            return
        # an article that is marked as a reader's comment is one, wherever it stands
        main = (main or name in MAIN) and not self._comments and not (comments and name == "article")
        inside = bool(self._mains)
        header = name == "header" and inside
        mute = main or name in HEADINGS or name in ("html", "body")
        silent = not main and not header and (name in SILENT or not mute and (noise or weak and not inside))
        e = Element(name, silent, comments and silent, main, header, weak and inside and not silent and not mute)
        if main:
            if not inside:
                self._owner.append(self._outer if self._silent else None)
            e.hushed, self._silent = self._silent, 0
            self._mains.append(len(self._open))
        if silent and not self._silent and not inside:
            self._outer = e
        if e.weak and not self._weak:
            self._weak_size.append([0, 0])
        if name in PARTS:
            self._line("", 0, False)
            self._n_parts += 1
            self._parts_open.append(self._n_parts)
        self._count(e, 1)
        self._at.setdefault(name, []).append(len(self._open))
        self._open.append(e)

    def _count(self, e: Element, by: int) -> None:
        self._silent += by * e.silent
        self._comments += by * e.comments
        self._headings += by * e.heading
        self._headers += by * e.header
        self._weak += by * e.weak

    def _end(self, name: str) -> None:
        if name in INLINE:
            if name == "a":
                self._in_link = max(0, self._in_link - 1)
            if self._hushed and self._hushed[0] == name:
                self._hushed = (name, self._hushed[1] - 1) if self._hushed[1] > 1 else None
            return
        self._end_line()
        places = self._at.get(name)
        # a stray end tag does not close the article around it
        if not places or self._mains and places[-1] < self._mains[-1] and name not in MAIN and name not in ("body", "html"):
            return
        last = places[-1]
        self._open[last].closed = True
        while len(self._open) > last:
            e = self._open.pop()
            self._at[e.name].pop()
            self._count(e, -1)
            if e.name in PARTS:
                self._parts_open.pop()
            if e.main:
                self._mains.pop()
                self._silent = e.hushed
        if name in PARTS:
            self._line("", 0, False)

    def _read(self, page: str) -> None:
        at, n = 0, len(page)
        while at < n:
            mark = page.find("<", at)
            if mark < 0:
                break
            found = TAG.match(page, mark)
            if found:
                self._text(page[at:mark])
                at, name = found.end(), found[2].lower()
                if found[1]:
                    self._end(name)
                elif name in RAW:
                    if name not in ("script", "style"):
                        self._end_line()
                    end = RAW_END[name].search(page, at)
                    at = end.end() if end else n
                else:
                    self._start(name, found[3])
                continue
            ends = next((e for s, e in (("<!--", "-->"), ("<![CDATA[", "]]>"), ("<!", ">"), ("<?", ">"), ("</", ">")) if page.startswith(s, mark)), None)
            if ends is None:  # a sign, not markup
                self._text(page[at : mark + 1])
                at = mark + 1
                continue
            self._text(page[at:mark])
            end = page.find(ends, mark + 2)
            at = end + len(ends) if end >= 0 else n
        self._text(page[at:])
        self._end_line()

    def _text(self, text: str) -> None:
        if self._hushed:
            self.silenced += len(text.strip())
        elif text:
            self._parts.append(text)
            if self._in_link:
                self._linked.append(text)


def surges(weights: list[int], window: int = WINDOW, surge: int = SURGE) -> list[tuple[int, int]]:
    """Spans [start, end) of lines between a surge and the dive that follows."""
    n = len(weights)
    block = [sum(weights[i : i + window]) for i in range(n)]
    limit = min(surge, max(block, default=0))
    spans, at = [], 0
    while at < n:
        if weights[at] == 0:
            at += 1
            continue
        end = at
        while end < n and block[end] > 0:
            end += 1
        if limit and max(block[at:end]) >= limit:
            spans.append((at, end))
        at = end
    return spans


def chosen(weights: list[int], lines: Lines, window: int, surge: int) -> list[int]:
    """Lines that the distribution keeps: whole main elements that surge, or else what lies between surges and dives."""
    by_zone: dict[int, list[int]] = {}
    for i, zone in enumerate(lines.zone):
        if zone:
            by_zone.setdefault(zone, []).append(i)
    peaks = {zone: max(sum(weights[i] for i in at[k : k + window]) for k in range(len(at))) for zone, at in by_zone.items()}
    limit = min(surge, max(peaks.values(), default=0))
    if limit:
        return [i for zone, at in by_zone.items() if peaks[zone] >= limit for i in at]
    kept, done, text_of = set(), 0, dict.fromkeys(lines.part, 0)
    for start, end in surges(weights, window, surge):
        for i in range(start, end):
            text_of[lines.part[i]] += weights[i]
        while start > done and (lines.heading[start - 1] or not lines.text[start - 1]):
            start -= 1
        kept.update(range(start, end))
        done = end
    # a part of the page that holds a surge by itself is kept beyond a break in it (an advert, a list of links)
    limit = min(surge, max(text_of.values(), default=0))
    return [i for i, part in enumerate(lines.part) if i in kept or weights[i] and limit and text_of[part] >= limit]


def main_text(page: str | None, window: int = WINDOW, surge: int = SURGE) -> str:
    """Main text of one page: blocks in page order, joined by one space."""
    if not page:
        return ""
    lines = Lines(page)
    left = sum(lines.weight)
    if left < surge and lines.silenced >= surge and left < LEFT * lines.silenced and not any(z and w for z, w in zip(lines.zone, lines.weight, strict=True)):
        lines = Lines(page, by_marks=False)
    weights = lines.weight
    if not any(weights):  # nothing but links
        weights = [len(t) for t in lines.text]
    return " ".join(lines.text[i] for i in chosen(weights, lines, window, surge) if lines.text[i])


def extract(df: DataFrame, html: Column | str = "html", out: str = "text", window: int = WINDOW, surge: int = SURGE) -> DataFrame:
    """df plus out string: the main text of each page."""
    html = F.col(html) if isinstance(html, str) else html
    return add_columns(df, [html], [T.StructField(out, T.StringType(), False)], lambda: lambda pages: [[main_text(p, window, surge) for p in pages]])


def op9_line_blocks(spark, sf_dir: str) -> DataFrame:
    """Contract query: main text and its code points for every page."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return extract(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
