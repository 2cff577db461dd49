"""Main text of HTML pages by line-block distribution.

Markup is stripped: what never is article text (scripts, styles, menus, headers,
footers, sidebars, notices, adverts, forms, reader comments) goes with its
element, and every block element becomes a line of its own. Over these lines the
text lengths of sliding windows of WINDOW lines are summed. Text starts where the
sums surge from nothing past a threshold and ends where they dive to nothing;
what stands between such points is kept. A removed element leaves a gap of empty
lines. The gap of a menu, a header or a footer outside a marked section is deep
enough to make a dive point; that of an advert, a notice or anything else is too
shallow, so that it does not end the text. A short stretch of unlinked text that
only removed elements, none of them a header or footer, part from a kept one
stays with it.

The distribution over the whole body chooses the text on every page; text of
links weighs nothing. Where a page marks sections (`article`, `main`), the mark
is a weight: lines of a kind of section gain MARK times the share of the page's
text that the largest section of the kind holds, links included. So an article
with most of the text stays whole and outweighs what stands beside it, and
teaser cards in `article` beside the text gain next to nothing.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 3
SURGE = 80  # characters in a window
MARK = 8  # weight that a section with all of the page's text gains
PEAK_SHARE = 0.15  # a stretch of text needs this share of the largest window's length
BATCH_ROWS = 500

RAW = "script|style|template|noscript|textarea|title|iframe|svg|math|object"
DROPPED = frozenset("head nav header footer aside form button select fieldset dialog menu canvas video audio".split())
BLOCKS = frozenset(
    "address article blockquote body caption center dd details div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 hr "
    "html li main ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ARTICLE = frozenset(("article", "main"))
EDGES = frozenset(("head", "header", "footer"))
SECTIONS = ARTICLE | {"body", "html"}
UNWANTED = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|notice|alert|popup|modal|overlay|"
    r"nav\w*|menu|breadcrumbs?|pagination|pager|sidebar|side-?bar|widget|footer|header|masthead|topbar|"
    r"comments?|reply|replies|disqus|respond|related|recommend\w*|share|sharing|social|subscribe|newsletter|signup|"
    r"login|search|toolbar|skip)(?:$|[\s_-])",
    re.IGNORECASE,
)
OWN_HEADER = re.compile(r"(?:^|\s)(?:entry|post|article|story|page|content|section)[_-]?header(?=$|\s)", re.IGNORECASE)
# Classes and ids that name, as a whole, what is never article text
STRICT_CLASS = re.compile(
    r"(?:^|\s)(?:ads?|adsbygoogle|ads?[_-](?:slot|box|container|unit|wrapper|banner|block|break|label)|advert|advertisement|"
    r"sponsor|sponsored|promo|banner|cookies?|cookie[_-](?:notice|banner|bar|consent)|consent|popup|modal|overlay|"
    r"nav|navbar|menu|breadcrumbs?|pagination|pager|sidebar|side-bar|widget|footer|masthead|topbar|toolbar|"
    r"comments?|comments?[_-](?:list|section|area|form|body|respond)|reply|replies|disqus|respond|"
    r"related|related[_-](?:posts|articles|stories|links)|recommended|share|sharing|share[_-](?:buttons|bar|links)|"
    r"social|social[_-](?:share|buttons|icons|links)|subscribe|newsletter|newsletter[_-](?:signup|form|box)|signup|login)(?=$|\s)",
    re.IGNORECASE,
)
READERS = re.compile(r"comment|repl(?:y|ies)|respond|disqus|related|recommend", re.IGNORECASE)
LAYOUT = re.compile(r"overlay|nav|navbar|menu|sidebar|side-bar|widget|footer|masthead|topbar|toolbar|banner", re.IGNORECASE)
WRAPPERS = frozenset("div section center table tbody tr td ul ol".split())
# Outside marked sections: removed elements that stand around the text, and those among them that end it for good
AROUND = re.compile(
    r"(?:^|[\s_\-\"'=])(?:nav\w*|menu|breadcrumbs?|pagination|pager|sidebar|side-?bar|toolbar|header|footer|masthead|topbar|"
    r"contentinfo|complementary)(?=$|[\s_\-\"'/])",
    re.IGNORECASE,
)
EDGE = re.compile(r"(?:^|[\s_\-\"'=])(?:header|footer|masthead|topbar|contentinfo)(?=$|[\s_\-\"'/])", re.IGNORECASE)
STRICT_ID = re.compile(r"(?:div-gpt-|google_)?ads?(?:[_-]?\d+)*|comments|comment-\d+|disqus_thread|respond", re.IGNORECASE)
# Short lines that end a page after its text
LEGAL = re.compile(r"(?:©|\(c\)\s|copyright\b|all rights reserved|imprint\b|impressum\b|privacy policy|terms of (?:use|service)|legal notice)", re.IGNORECASE)
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
LINKED = 0.5  # a block whose name leaves doubt is dropped if links are this share of its text
ROLES = re.compile(r"\brole\s*=\s*[\"']?(?:navigation|banner|contentinfo|complementary|search|form|alert|dialog|menu)", re.IGNORECASE)
NAMES = re.compile(r"(?<![\w-])(class|id)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
HIDDEN = re.compile(r"(?:^|\s)hidden(?=$|[\s=/])|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.IGNORECASE)
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<![^>]*>?|<\?[^>]*>?"
    rf"|<(?P<raw>{RAW})\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+|[^>]*)>",
    re.DOTALL | re.IGNORECASE,
)


class Judged(NamedTuple):
    """Lines of an element that goes unless it holds more than `share` of the page's unlinked text, and the gap it would leave."""

    first: int
    last: int
    share: float
    lines: int
    ends: bool


class Lines:
    """Lines of a page, each with its text, its unlinked length, and the marked section it stands in."""

    def __init__(self) -> None:
        self.text: list[str] = []
        self.weight: list[int] = []
        self.marked: list[int] = []  # 2 in an article, 1 in the main part only, else 0
        self.section: list[int] = []  # which marked section, counted from 1; 0 outside, END in a gap no text reaches over
        self.judged: list[Judged] = []
        self._parts: list[str] = []
        self._linked = 0

    def add(self, part: str, linked: bool) -> None:
        """One piece of text between two tags; a reference never reaches over a tag."""
        part = html.unescape(part)
        self._parts.append(part)
        if linked:
            self._linked += len(" ".join(part.split()))

    def end(self, marked: int, section: int) -> None:
        text = " ".join("".join(self._parts).split())
        if text:
            self.text.append(text)
            self.weight.append(max(0, len(text) - self._linked))
            self.marked.append(marked)
            self.section.append(section)
        self._parts, self._linked = [], 0

    def gap(self, lines: int, ends: bool = False) -> None:
        """Leave at least so many empty lines here; gaps in a row do not add up."""
        for text in reversed(self.text[-lines:]):
            if text:
                break
            lines -= 1
        self.text += [""] * lines
        self.weight += [0] * lines
        self.marked += [0] * lines
        self.section += [0] * lines
        if ends:
            self.section[-1] = END

    def drop_linked(self, start: int) -> None:
        """Drop the lines from `start` on if most of their text is links."""
        total = sum(map(len, self.text[start:]))
        if total and total - sum(self.weight[start:]) >= LINKED * total:
            del self.text[start:], self.weight[start:], self.marked[start:], self.section[start:]
            self.judged = [j for j in self.judged if j.first < start]
            self.gap(1)

    def drop_small(self) -> Lines:
        """The lines without the elements whose names leave doubt and that hold too little of the page's unlinked text."""
        total = sum(self.weight)
        kept, at = Lines(), 0
        for judged in sorted(self.judged, key=lambda j: (j.first, -j.last)):
            if judged.first < at or sum(self.weight[judged.first : judged.last]) > judged.share * total:
                continue
            kept._copy(self, at, judged.first)
            kept.gap(judged.lines, judged.ends)
            at = judged.last
        kept._copy(self, at, len(self.text))
        return kept

    def _copy(self, other: Lines, first: int, last: int) -> None:
        self.text += other.text[first:last]
        self.weight += other.weight[first:last]
        self.marked += other.marked[first:last]
        self.section += other.section[first:last]

    def weights(self) -> np.ndarray:
        """Unlinked lengths, and in marked sections what the mark adds."""
        length = np.array([len(t) for t in self.text], dtype=np.float64)
        weight, marked, section = np.array(self.weight, dtype=np.float64), np.array(self.marked), np.array(self.section)
        counted = np.where(marked > 0, length, weight)
        total = max(1.0, counted.sum())
        for kind in (1, 2):
            here = marked == kind
            if here.any():
                weight[here] += MARK * np.bincount(section[here], weights=length[here]).max() / total * length[here]
        return weight


KEPT, DOUBTED, SMALL, MOST, GONE = range(5)
LEAST_SHARE = {SMALL: 0.15, MOST: 0.5}  # of the page's unlinked text that an element must hold to stay
END = -1


def _unwanted(name: str, rest: str, inside: bool, nested: bool) -> int:
    """Whether an element goes by its name; what is doubted is judged by its links when it ends, or by its share of the page.

    Inside a marked section only whole names are trusted. Ids of headings and
    sections are made from their words and are never trusted. Outside, a
    wrapper may be named after what stands in it (`has-sidebar`, `menu-open`):
    it goes only if it holds a small part of the page's text. A whole name of a
    part of the layout is trusted unless the element holds most of that text;
    one of adverts, notices, forms or reader comments always is.
    """
    if name in DROPPED:
        return DOUBTED if name == "header" and inside else GONE
    if not rest or (name in SECTIONS and not (name == "article" and nested)):
        return KEPT
    if HIDDEN.search(rest) or ROLES.search(rest):
        return GONE
    names = {"class": "", "id": ""}
    for kind, *found in NAMES.findall(rest):
        names[kind.lower()] = "".join(found)
    classes, label = OWN_HEADER.sub(" ", names["class"]), OWN_HEADER.sub(" ", names["id"])
    wrapper = name in WRAPPERS and not inside
    if STRICT_CLASS.search(classes):
        return MOST if wrapper and all(LAYOUT.fullmatch(found.strip()) for found in STRICT_CLASS.findall(classes)) else GONE
    titled = name == "section" or "section" in classes.split()
    if name in HEADINGS:
        return GONE if not inside and UNWANTED.search(classes) else KEPT
    if not titled and STRICT_ID.fullmatch(label):
        return GONE
    if not inside and (UNWANTED.search(classes) or (not titled and UNWANTED.search(label))):
        if not wrapper:
            return GONE
        return MOST if READERS.search(classes) or READERS.search(label) else SMALL
    return DOUBTED if UNWANTED.search(classes) or UNWANTED.search(label) else KEPT


def page_lines(page: str) -> Lines:
    """Strip the markup of a page.

    A dropped element that is not closed ends at the next article or at the end
    of the body, a dropped paragraph at the next block.
    """
    lines = Lines()
    at = links = articles = mains = depth = 0
    begun = [0, 0, 0]  # sections of each kind so far
    skipped = ""
    opened: dict[str, int] = {}  # open blocks by tag
    # of those that are doubted: how many were open, the first line, and how their share of the page is judged, if it is
    doubted: dict[str, list[tuple[int, int, tuple[float, int, bool] | None]]] = {}

    def text(part: str) -> None:
        if not skipped and part:
            lines.add(part, links > 0)

    def end() -> None:
        kind = 2 if articles else 1 if mains else 0
        lines.end(kind, begun[kind])

    def gap_of(name: str, rest: str) -> tuple[int, bool]:
        """How many empty lines a removed element leaves, and whether the text ends there for good."""
        ends = name in EDGES or EDGE.search(rest) is not None
        deep = not articles and not mains and (ends or name in ("nav", "menu", "aside") or AROUND.search(rest) is not None)
        return WINDOW + 1 if deep else 1, deep and ends

    for token in TOKEN.finditer(page):
        text(page[at : token.start()])
        at = token.end()
        name = (token["name"] or "").lower()
        if not name:
            continue
        closes, rest = bool(token["close"]), token["rest"] or ""
        if skipped:
            ends_paragraph = skipped == "p" and name in BLOCKS and not (closes and name == "p")
            if name == skipped and not ends_paragraph:
                depth += -1 if closes else 0 if rest.rstrip().endswith("/") else 1
                if depth <= 0:
                    skipped = ""
                continue
            opens_article = name in ARTICLE and not closes and not articles
            if not (ends_paragraph or opens_article or (closes and name in SECTIONS)):
                continue
            skipped = ""
        fate = KEPT if closes or name in VOID else _unwanted(name, rest, articles + mains > 0, articles > 0)
        if fate == GONE:
            if name in BLOCKS or name in DROPPED:
                end()
                lines.gap(*gap_of(name, rest))
            if not rest.rstrip().endswith("/"):
                skipped, depth = name, 1
            continue
        if name == "a":
            links = max(0, links + (-1 if closes else 1))
        elif name == "br":
            text(" ")
        elif name in BLOCKS or name == "header":
            end()
            links = 0
            if closes:
                opened[name] = max(0, opened.get(name, 0) - 1)
                if doubted.get(name) and doubted[name][-1][0] > opened[name]:
                    _, first, judged = doubted[name].pop()
                    if judged is None:
                        lines.drop_linked(first)
                    else:
                        lines.judged.append(Judged(first, len(lines.text), *judged))
            elif name not in VOID:
                opened[name] = opened.get(name, 0) + 1
                if fate != KEPT:
                    judged = (LEAST_SHARE[fate], *gap_of(name, rest)) if fate in LEAST_SHARE else None
                    doubted.setdefault(name, []).append((opened[name], len(lines.text), judged))
            if name in ARTICLE:
                was = articles, mains
                change = -1 if closes else 1
                articles, mains = max(0, articles + change * (name == "article")), max(0, mains + change * (name == "main"))
                begun[2] += articles > was[0] == 0
                begun[1] += mains > was[1] == 0
                inner = articles and was[0]
                lines.gap(1 if inner else WINDOW + 1, not inner)
    text(page[at:])
    end()
    return lines.drop_small()


def stretches(weight: np.ndarray) -> list[tuple[int, int, float]]:
    """Line ranges whose window sums are above zero, with the largest sum of each; a range begins and ends with a line of weight."""
    if not len(weight):
        return []
    sums = np.convolve(weight, np.ones(WINDOW), "full")[WINDOW - 1 :]  # of WINDOW lines from each line on
    held = np.concatenate(([False], sums > 0, [False]))
    starts, ends = np.flatnonzero(held[1:] & ~held[:-1]), np.flatnonzero(~held[1:] & held[:-1])
    heavy = np.flatnonzero(weight > 0)
    return [
        (int(heavy[np.searchsorted(heavy, a)]), int(heavy[np.searchsorted(heavy, b) - 1]) + 1, float(sums[a:b].max()))
        for a, b in zip(starts.tolist(), ends.tolist(), strict=True)
    ]


def _open_between(lines: Lines, first: int, last: int) -> bool:
    """Whether the text may go on over these lines: no header, footer or other end stands there."""
    return END not in lines.section[first:last]


def _no_text(lines: Lines, first: int, last: int) -> bool:
    return not any(lines.text[first:last])


def _unlinked(lines: Lines, a: int, b: int) -> bool:
    return 2 * sum(lines.weight[a:b]) >= sum(map(len, lines.text[a:b]))


def _list_between(lines: Lines, first: int, last: int) -> bool:
    """Whether only lines of links stand there, without a gap: a list inside the text."""
    return first < last and all(lines.text[first:last])


def chosen_lines(lines: Lines) -> list[tuple[int, int]]:
    """Ranges of the lines of the main text, in order.

    Stretches that surge past the threshold are kept. A stretch of little text
    stays with a kept neighbour if nothing but removed elements stands between
    them, and links between two kept stretches stay with them. Legal lines at
    the end of a page are no text.
    """
    weight = lines.weights()
    found = stretches(weight)
    peak = max((top for _, _, top in found), default=0)
    surge = max(1, min(peak, max(SURGE, PEAK_SHARE * peak)))
    kept = [top >= surge for _, _, top in found]
    forth = [(k - 1, k) for k in range(1, len(found))]
    for near, k in forth + [(k, near) for near, k in reversed(forth)]:
        a, b = found[min(near, k)], found[max(near, k)]
        if kept[near] and not kept[k] and _unlinked(lines, *found[k][:2]):
            kept[k] = _open_between(lines, a[1], b[0]) and _no_text(lines, a[1], b[0])
    ranges: list[tuple[int, int]] = []
    for (a, b, _), stays in zip(found, kept, strict=True):
        if not stays:
            continue
        if ranges and _list_between(lines, ranges[-1][1], a):
            ranges[-1] = ranges[-1][0], b
        else:
            ranges.append((a, b))
    while ranges:
        a, b = ranges[-1]
        if lines.marked[b - 1] or not (lines.text[b - 1] == "" or LEGAL.match(lines.text[b - 1])) or len(lines.text[b - 1]) > SURGE:
            break
        ranges[-1:] = [(a, b - 1)] if b - 1 > a else []
    return ranges


def main_text(page: str) -> str:
    """The article's blocks in page order, one line each; empty if there is none."""
    lines = page_lines(page)
    return "\n".join(t for a, b in chosen_lines(lines) for t in lines.text[a:b] if t)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per input row: page_id, url, text, n_chars.

    A null or empty page has empty text. Broken markup never fails: a tag that
    is not closed ends with the page. Repeated rows and null ids stay as they
    are; an empty table gives an empty result; other columns are not read.
    """
    rows = pages.select(F.struct(F.col(id_col).alias("page_id"), F.col(url_col).alias("url")).alias("row"),
                        F.coalesce(F.col(html_col), F.lit("")).alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH_ROWS):
                batch = whole.slice(at, BATCH_ROWS)
                texts = [main_text(page.as_py()) for page in batch.column("html")]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    names=["row", "text", "n_chars"],
                )

    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(run, f"row {kind}, text string, n_chars long").select("row.*", "text", "n_chars")
