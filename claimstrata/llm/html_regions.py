"""Main text of web pages from text-to-tag ratios.

The standard library's parser streams events.  Block tags end a line; for each
line its text, its tags and its link text are counted, and lines inside menus,
headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader
comments have no ratio.  The ratios (characters per tag) are smoothed along the
page with a Gaussian and clustered by a threshold, one standard deviation's share
of the page.  The main text is the outermost article or main, else the outermost
element named so, that holds nearly all text of the cluster; a main or a named
element gives way to one inside it only where all else in it is boilerplate or
lines that are mostly links, headings apart.  All of its own lines are content,
short ones included.  Without such a container it is the body: all lines, but
before and after the cluster's text none that are mostly links, headings apart.

Names are those of containers (div, section, list, table and the like), never of a
paragraph or a heading, whose ids are slugs of titles.  A name of class or id counts
as a whole: a word of boilerplate (`comments`), or one together with words of layout
(`reader-comments`, `ad-slot`; not `ad-free`, `social-policy`).  The id of a section
counts only if it names comments.  Scripts, styles, buttons and other elements
without running text end no line, so a paragraph around them stays whole.

Each line is one block of the result: white space runs become one space, blocks
are joined by an empty line.  Nothing is cut: pages are parsed whole.

Cases: NULL and empty pages, and pages without content, give the empty text;
unclosed and stray tags are mended as they come; a comment without end reaches to
the end of the page, as in a browser; text outside any block is a
line of its own; repeated rows are read alike; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser
from itertools import takewhile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark meter output q rp rt ruby s "
    "samp small span strike strong sub sup time tt u var".split()
)
BOILERPLATE = frozenset(
    "script style noscript template head title nav header footer aside form button select option textarea iframe "
    "object svg canvas audio video dialog menu".split()
)
# Elements whose content is no running text; within a paragraph they do not end it.
SILENT = frozenset("script style noscript template button select textarea iframe object svg canvas audio video".split())
# Elements whose names of class and id say what they hold.
NAMED = frozenset("div section ul ol dl table tbody tr td center details figure fieldset address".split())
# Words of boilerplate in names.
BOILERPLATE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments cookie cookies "
    "consent disqus footer header masthead menu modal nav navbar navigation newsletter notice notices pager "
    "pagination popup promo promoted reactions related replies responses share sharing sidebar social sponsor sponsored "
    "subscribe toolbar widget".split()
)
# Words of layout that may stand beside them.
LAYOUT_NAMES = frozenset(
    "area article articles bar block bottom box btn button buttons cell col column container content crumb fixed flex "
    "form global grid group hidden holder icons inline inner item items js left layout links list main media mobile "
    "module news outer page panel placeholder post posts primary reader readers region respond right row secondary "
    "section sign signup site slot small stack sticky stories text thread title top unit up user view wrap wrapper "
    "zone".split()
)
COMMENT_NAMES = frozenset("comment comments disqus reactions replies responses".split())
BOILERPLATE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu".split())
ROOT_TAGS = frozenset(("article", "main"))
ROOT_NAMES = frozenset("article content entry main post story".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Share of the cluster's text that a container must hold, in percent.
NEARLY_ALL = 90
SIGMA = 1.5
CHUNK = 1 << 16
# Words of a name: runs of letters, an upper-case one starts anew.
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_SPACES = re.compile(r"\s+")
_CLOSED_BY_ITEM = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}


def is_boilerplate_name(name: str, words: frozenset[str] = BOILERPLATE_NAMES) -> bool:
    """All words of the name are of boilerplate or layout, and one at least of `words`."""
    parts = {w.lower() for w in _WORD.findall(name)}
    return not parts.isdisjoint(words) and parts <= BOILERPLATE_NAMES | LAYOUT_NAMES


@dataclass
class Line:
    """One block of the page and the containers (by number) it stands in."""

    text: str
    n_tags: int
    n_link: int
    roots: tuple[int, ...]
    boilerplate: bool
    heading: bool

    @property
    def mostly_links(self) -> bool:
        return 2 * self.n_link > len(self.text) and not self.heading

    @property
    def ratio(self) -> float:
        return 0.0 if self.boilerplate else len(self.text) / max(1, self.n_tags)


class LineReader(HTMLParser):
    """Turns parser events into lines."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.stack: list[tuple[str, bool, tuple[int, ...]]] = []
        self.parts: list[str] = []
        self.n_tags = self.n_link = self.links = self.silent = 0
        # Tag of each container in page order, None where only its name says so.
        self.roots: list[str | None] = []

    @property
    def boilerplate(self) -> bool:
        return bool(self.stack) and self.stack[-1][1]

    def flush(self) -> None:
        text = _SPACES.sub(" ", "".join(self.parts)).strip()
        if text:
            roots = self.stack[-1][2] if self.stack else ()
            heading = any(tag in HEADINGS for tag, _, _ in self.stack)
            self.lines.append(Line(text, self.n_tags, self.n_link, roots, self.boilerplate, heading))
        self.parts = []
        self.n_tags = self.n_link = 0

    def pop_to(self, depth: int) -> None:
        closed = [tag for tag, _, _ in self.stack[depth:]]
        self.links -= closed.count("a")
        self.silent -= sum(tag in SILENT for tag in closed)
        if not self.silent:
            # What stands inside a silent element is no block of its own.
            spoken = list(takewhile(lambda tag: tag not in SILENT, closed))
            del self.stack[depth + len(spoken) :]
            if any(tag not in INLINE for tag in spoken):
                self.flush()
        del self.stack[depth:]

    def close(self) -> None:
        if self.rawdata.startswith("<!--"):
            self.rawdata = ""
        super().close()
        self.flush()

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.n_tags += 1
        if tag in VOID:
            if tag == "hr":
                self.flush()
            elif tag == "br":
                self.parts.append(" ")
            return
        if tag in SILENT or self.silent:
            self.silent += tag in SILENT
            self.stack.append((tag, True, ()))
            self.links += tag == "a"
            return
        if tag not in INLINE:
            self.flush()
            self.close_implied(tag)
            self.n_tags += 1
        boilerplate, roots = (self.stack[-1][1], self.stack[-1][2]) if self.stack else (False, ())
        if not boilerplate:
            root = tag if tag in ROOT_TAGS else None
            is_root = root is not None
            boilerplate = tag in BOILERPLATE
            if attrs and not boilerplate and tag not in ("html", "body"):
                named, words = False, set()
                for key, value in attrs:
                    if key in ("class", "id"):
                        names = (value or "").split()
                        words.update(w.lower() for name in names for w in _WORD.findall(name))
                        slug = key == "id" and tag == "section"
                        named |= any(is_boilerplate_name(n, COMMENT_NAMES if slug else BOILERPLATE_NAMES) for n in names)
                    elif key == "role":
                        role = (value or "").strip().lower()
                        boilerplate |= role in BOILERPLATE_ROLES
                        root = root or (role if role in ROOT_TAGS else None)
                        is_root = root is not None
                    elif key == "hidden" or key == "aria-hidden" and value == "true":
                        boilerplate = True
                    elif key == "style" and re.search(r"display\s*:\s*none", value or "", re.I):
                        boilerplate = True
                if not is_root:
                    boilerplate |= named and tag in NAMED
                    is_root = tag in ("div", "section", "td") and not words.isdisjoint(ROOT_NAMES)
            if is_root and not boilerplate:
                roots = (*roots, len(self.roots))
                self.roots.append(root)
        self.links += tag == "a"
        self.stack.append((tag, boilerplate, roots))

    def close_implied(self, tag: str) -> None:
        """A block ends an open paragraph; an item ends the item before it."""
        ends = _CLOSED_BY_ITEM.get(tag, ())
        for depth in range(len(self.stack) - 1, -1, -1):
            name = self.stack[depth][0]
            if name == "p" or name in ends:
                self.pop_to(depth)
                return
            if name not in INLINE:
                return

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self.n_tags += 1
        for depth in range(len(self.stack) - 1, -1, -1):
            name = self.stack[depth][0]
            if name == tag:
                self.pop_to(depth)
                return
            if name not in INLINE and name not in SILENT and tag in INLINE:
                return
            if name in ("article", "main", "td") and tag in ("p", "li"):
                return
        if tag == "p":
            self.flush()

    def handle_data(self, data: str) -> None:
        if self.silent:
            return
        self.parts.append(data)
        if self.links:
            self.n_link += len(data)


def read_lines(html: str) -> tuple[list[Line], list[str | None]]:
    """The page's lines and its containers."""
    reader = LineReader()
    for at in range(0, len(html), CHUNK):
        reader.feed(html[at : at + CHUNK])
    reader.close()
    return reader.lines, reader.roots


def smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian mean along the page; weights at the ends add up to one as well."""
    reach = int(np.ceil(2 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    weight = np.convolve(np.ones(len(ratios)), kernel)[reach : reach + len(ratios)]
    return np.convolve(ratios, kernel)[reach : reach + len(ratios)] / weight


def main_text(html: str | None) -> str:
    """Blocks of the main text, joined by an empty line."""
    lines, roots = read_lines(html or "")
    ratios = np.array([line.ratio for line in lines])
    if not ratios.any():
        return ""
    smooth = smoothed(ratios)
    cluster = (smooth >= min(smooth.std(), smooth.max())) & (ratios > 0)
    mass: dict[int, float] = {}
    for i in np.flatnonzero(cluster):
        for root in lines[i].roots:
            mass[root] = mass.get(root, 0.0) + len(lines[i].text)
    whole = sum(len(lines[i].text) for i in np.flatnonzero(cluster))
    # Roots are numbered in page order, inner ones after outer ones; those that hold
    # nearly all stand within each other.
    holding = sorted(root for root, held in mass.items() if 100 * held >= NEARLY_ALL * whole)
    if holding:
        root = next((r for r in holding if roots[r]), holding[0])
        for inner in holding:
            outside = (line for line in lines if root in line.roots and inner not in line.roots)
            if inner > root and roots[root] != "article" and all(x.boilerplate or x.mostly_links for x in outside):
                root = inner
        chosen = [line.text for line in lines if root in line.roots and not line.boilerplate]
    else:
        texts = [i for i in np.flatnonzero(cluster) if not lines[i].mostly_links] or np.flatnonzero(cluster)
        first, last = texts[0], texts[-1]
        chosen = [
            line.text
            for i, line in enumerate(lines)
            if not line.boilerplate and (first <= i <= last or not line.mostly_links)
        ]
    return "\n\n".join(chosen)


def extract_pages(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    id_type = pages.schema["page_id"].dataType.simpleString()

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(html.as_py()) for html in batch["html"]]
            yield pa.RecordBatch.from_arrays(
                [batch["page_id"], batch["url"], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    return pages.select("page_id", "url", "html").mapInArrow(
        extract, f"page_id {id_type}, url string, text string, n_chars bigint"
    )
