"""Main text of web pages.

The standard library's parser streams events; they become blocks (the "lines" of the method): the text between two
block-level tags, with the number of tags around and inside it. A block's text-to-tag ratio is its length by its tags.
The ratios are smoothed with a Gaussian and clustered by a threshold into content and the rest.

This is done for every page. What the page says about its parts is evidence beside it. Blocks inside navigation, headers and
footers of the page, forms, comments, scripts and styles, told by element, role, class or id, never count; nor do those in elements
named like sidebars, notices or adverts, unless such an element has several blocks above the threshold
and half of the page's text there or more: then it is a wrapper. A form, or an element with a form's role or named after comments, is a wrapper
only where it holds an article or first heading and nine tenths of the page's text above the threshold: a page inside one form, or a
page's frame that says whether comments are open.
A marked article (`article`, `main` or `itemprop=articleBody`) is content, also its short blocks, where articles hold as much of the
text above the threshold as all else; of several, those without any such text (teasers) go. Elsewhere marks don't count, and content
reaches from the first to the last block above the threshold, and on over neighbouring paragraphs, headings and items; blocks of
which links make up half the text or more, and teasers, are left out.

Null and empty pages, and pages without content, give an empty text. Unclosed and crossed tags are closed as browsers would, roughly:
a block-level tag ends an open paragraph, and one that can't stand in the head ends the head. Very long pages and many unclosed tags cost time in
proportion. Ties between clusters go to content. Rows that repeat get equal results. Other columns are ignored. Empty tables give
empty results.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from html.parser import HTMLParser

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .registry import query, ship, table

# fixed values: elements of the HTML standard
SILENT = frozenset("script style noscript template head title svg math iframe object canvas audio video select option textarea button datalist".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
                  "header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption".split())
ASIDE = frozenset("nav aside footer form menu dialog fieldset".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar".split())
NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notice|notification|popup|modal|newsletter|subscribe|signup|alert|"
    r"nav\w*|menu|breadcrumbs?|sidebar|side|aside|footer|header|masthead|topbar|toolbar|pagination|pager|share|sharing|social|related|recommended|"
    r"comments?|disqus|replies|respond|form|login|search|widget|skip)(?:$|[\s_-])", re.I)
LAYOUT = re.compile(r"(?:^|(?<=\s))(?:has|no|with|without)[_-]\S+", re.I)  # says what an element has, not what it is
CONTENT = re.compile(r"(?:^|[\s_-])(?:content|article|main|post|entry|story|text|body)(?:$|[\s_-])", re.I)
HEADING = re.compile(r"(?:^|[\s_-])(?:header|masthead|footer)(?:$|[\s_-])", re.I)
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 li blockquote pre dd dt td figcaption".split())
ENDS_P = BLOCK - {"html", "body"}
IN_HEAD = frozenset("base link meta noscript script style template title head html".split())
REMARKS = re.compile(r"(?:^|[\s_-])(?:comments?|replies|respond|disqus)(?:$|[\s_-])", re.I)


class Blocks(HTMLParser):
    """blocks: (text, letters in links, tags, numbers of the articles around it, numbers of the elements around it that don't count (0: never
    one), in an element of prose, numbers of the elements around it that are named like an aside). `holds` has the numbers of elements around
    an article or a first heading."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.blocks: list[tuple[str, int, int, tuple[int, ...], bool, bool, tuple[int, ...]]] = []
        self.open: list[tuple[str, bool, int | None, bool, bool]] = []  # element, silent, number as an aside, article, named like an aside
        self.names: Counter = Counter()  # of the open elements
        self.frames: list[str] = []  # open block-level elements
        self.holds: set[int] = set()
        self.text: list[str] = []
        self.tags = self.linked = self.links = 0
        self.silent = self.count = 0
        self.aside: list[int] = []
        self.article: list[int] = []
        self.named: list[int] = []

    def flush(self) -> None:
        text = " ".join("".join(self.text).split())
        if text:
            self.blocks.append((text, self.linked, self.tags, tuple(self.article), tuple(self.aside), bool(self.frames) and self.frames[-1] in PROSE, tuple(self.named)))
        self.text, self.tags, self.linked = [], 0, 0

    def handle_starttag(self, tag, attrs) -> None:
        if self.open and self.open[-1][0] == "head" and tag not in IN_HEAD:
            self._pop()
        if tag in BLOCK:
            self.flush()
            if tag in ENDS_P and self.names["p"]:
                self._end_paragraph()
        self.tags += 1
        if tag in VOID:
            if tag in ("br", "hr"):
                self.text.append(" ")
            return
        if (tag == "p" or tag == "li") and self.names[tag]:
            self._close_same(tag)
        given = {k: v or "" for k, v in attrs if k in ("class", "id", "role", "itemprop", "aria-hidden", "hidden")} if attrs else {}
        silent = tag in SILENT or "hidden" in given or given.get("aria-hidden") == "true"
        article = tag in ("article", "main") or given.get("role") in ("main", "article") or given.get("itemprop") == "articleBody"
        if tag in ("html", "body"):
            aside = told = frame = False
        else:
            named = [LAYOUT.sub("", given.get(c, "")) for c in ("class", "id")]
            told = any(NAMES.search(n) and not CONTENT.search(n) and not (self.article and HEADING.search(n)) for n in named)
            remark = any(REMARKS.search(n) for n in named)
            aside = (tag in ASIDE or (tag == "header" and not self.article) or given.get("role") in ROLES or remark)
            frame = tag in ("form", "fieldset") or tag not in ASIDE and (given.get("role") == "form" or remark and given.get("role") not in ROLES)
            told = told and not article and not aside
        self.count += 1
        number = (self.count if frame else 0) if aside else None
        self.open.append((tag, silent, number, article, told))
        self.names[tag] += 1
        if tag in BLOCK:
            self.frames.append(tag)
        self.silent += silent
        if number is not None:
            self.aside.append(number)
        if article or tag == "h1":
            self.holds.update(self.aside)
        if article:
            self.article.append(self.count)
        if told:
            self.named.append(self.count)
        self.links += tag == "a"

    def handle_startendtag(self, tag, attrs) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def _pop(self) -> None:
        tag, silent, aside, article, told = self.open.pop()
        self.names[tag] -= 1
        if tag in BLOCK:
            self.frames.pop()
        self.silent -= silent
        if aside is not None:
            self.aside.pop()
        if article:
            self.article.pop()
        if told:
            self.named.pop()
        self.links -= tag == "a"

    def _end_paragraph(self) -> None:
        """Close an open p that no block-level element stands in, with what is open in it."""
        for i in range(len(self.open) - 1, -1, -1):
            tag = self.open[i][0]
            if tag == "p":
                while len(self.open) > i:
                    self._pop()
                return
            if tag in BLOCK or tag == "button":
                return

    def _close_same(self, tag) -> None:
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                while len(self.open) > i:
                    self._pop()
                return
            if self.open[i][0] in BLOCK:
                return

    def handle_endtag(self, tag) -> None:
        if tag in BLOCK:
            self.flush()
        self.tags += 1
        for i in range(len(self.open) - 1 if self.names[tag] else -1, -1, -1):
            if self.open[i][0] == tag:
                while len(self.open) > i:
                    self._pop()
                return
            if tag not in BLOCK and self.open[i][0] in BLOCK:
                return

    def handle_data(self, data) -> None:
        if not self.silent:
            self.text.append(data)
            if self.links:
                self.linked += len(data)


def smoothed(values: list[float], sigma: float) -> list[float]:
    """Gaussian smoothing; at the ends with the weights that lie inside."""
    reach = max(1, math.ceil(3 * sigma))
    weights = [math.exp(-d * d / (2 * sigma * sigma)) for d in range(reach + 1)]
    out = []
    for i in range(len(values)):
        low, high = max(0, i - reach), min(len(values), i + reach + 1)
        w = [weights[abs(i - j)] for j in range(low, high)]
        out.append(sum(x * y for x, y in zip(w, values[low:high])) / sum(w))
    return out


def threshold(values: list[float]) -> float:
    """Border between two clusters of numbers: halfway between their means, moved until it stays."""
    cut = sum(values) / len(values)
    for _ in range(50):
        low, high = [v for v in values if v <= cut], [v for v in values if v > cut]
        if not high:
            return cut
        new = (sum(low) / len(low) + sum(high) / len(high)) / 2
        if abs(new - cut) < 1e-9:
            break
        cut = new
    return cut


def main_text(html: str | None, sigma: float = 1.0) -> str:
    """The page's main text, blocks joined by newlines."""
    parser = Blocks()
    parser.feed(html or "")
    parser.close()
    parser.flush()
    if not parser.blocks:
        return ""
    blocks = parser.blocks
    smooth = smoothed([len(b[0]) / max(1, b[2]) for b in blocks], sigma)
    cut = threshold(smooth)
    mass = [len(b[0]) if s >= cut and 2 * b[1] < len(b[0]) else 0 for b, s in zip(blocks, smooth)]
    frames: Counter = Counter()
    for b, m in zip(blocks, mass):
        for element in b[4] if m and 0 not in b[4] else ():
            frames[element] += m
    total = sum(m for b, m in zip(blocks, mass) if 0 not in b[4])
    around = {element for element, m in frames.items() if element in parser.holds and 10 * m >= 9 * total}
    never = [not around.issuperset(b[4]) for b in blocks]
    mass = [0 if n else m for m, n in zip(mass, never)]
    inside: dict[int, list[int]] = defaultdict(list)
    for b, m in zip(blocks, mass):
        for element in b[6] if m else ():
            inside[element].append(m)
    wrappers = {element for element, m in inside.items() if len(m) > 1 and 2 * sum(m) >= sum(mass)}
    counts = [not n and wrappers.issuperset(b[6]) for b, n in zip(blocks, never)]
    usable = [c and 2 * b[1] < len(b[0]) for b, c in zip(blocks, counts)]
    mass = [m if u else 0 for m, u in zip(mass, usable)]
    held = {element for b, m in zip(blocks, mass) if m for element in b[3]}
    marked = [c and bool(b[3]) for b, c in zip(blocks, counts)]
    if any(marked) and 2 * sum(m for b, m in zip(blocks, mass) if b[3]) >= sum(mass):
        return "\n".join(b[0] for b, m in zip(blocks, marked) if m and (not held or b[3][-1] in held))
    usable = [u and (not b[3] or b[3][-1] in held) for b, u in zip(blocks, usable)]
    chosen = [i for i, m in enumerate(mass) if m]
    if not chosen:
        return ""
    low, high = chosen[0], chosen[-1]
    while low > 0 and usable[low - 1] and blocks[low - 1][5]:
        low -= 1
    while high + 1 < len(blocks) and usable[high + 1] and blocks[high + 1][5]:
        high += 1
    return "\n".join(blocks[i][0] for i in range(low, high + 1) if usable[i])


def extract(pages: DataFrame, sigma: float = 1.0) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of pages (page_id, url, html)."""
    ship(pages.sparkSession)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts = [main_text(h, sigma) for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")).mapInArrow(
        run, "page_id long, url string, text string, n_chars long")


@query("op6_main_text")
def op6_main_text(spark, sf_dir):
    """Main text of every page."""
    return extract(table(spark, sf_dir, "pages"))
