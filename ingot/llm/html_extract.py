"""Main text of web pages from streaming parser events.

The standard library's parser sends tags and text; nothing is built of the
page but its lines: a line is the text of one block element, with the number
of tags met in it.  Elements that are never part of an article (menus, form
controls, scripts, asides) are left out as they stream by.

Forms and elements that class, id or role name as something else than the
article are regions, judged when the page is read (`judged`): how much of the
text they hold, and whether an article stands in them, decides what goes.

For the other lines the ratio of text (outside links) to tags is smoothed with
a Gaussian over neighbouring lines; lines above the threshold between the two
clusters of ratios are content.  Whole containers are taken or left, with their
short lines and headings: the article (or main) elements that hold content
lines, or else the innermost container that holds more than half of all content.

Within it the ratios decide on containers once more (`pruned`): one without any
line of content goes if links are most of its text (menus, lists of links,
footers), and, on a page without article elements, if it stands before or
behind all content and has no heading.

A null page has no text.  Character references are decoded, white space inside
a block becomes one space, blocks are joined by a line feed.  Repeated rows
each get their result; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ingot.llm.common import col, field, texts

#: Standard deviation of the smoothing, in lines.
SIGMA = 1.0

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup "
    "option p pre section summary table caption tbody td tfoot th thead title tr ul".split())
_SKIP = frozenset("head title script style noscript template iframe object svg math canvas audio video nav header footer aside button select textarea menu dialog".split())
#: Elements that a start tag of the same group ends.
_ENDS = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_SCOPE = frozenset("article section main div ul ol dl table body td th blockquote nav aside header footer form".split())
_ARTICLE = frozenset(("article", "main"))
_HEADING = frozenset(("h1", "h2", "h3"))
#: Containers whose short lines are as much of an article as its paragraphs.
_LISTS = frozenset("ul ol dl table body td th blockquote".split())
_NAMES = (
    r"(?:ad|ads|advert\w*|adbox|sponsor\w*|promo\w*|banner|sidebar|side|aside|nav|navbar|navigation|menu|breadcrumbs?|header|masthead|footer|foot|cookies?|consent|gdpr|notices?|alert|disclaimer|"
    r"popup|modal|overlay|share|sharing|social|related|recommend\w*|newsletter|subscribe|subscription|signup|login|search|pagination|pager|comments?|commentlist|respond|responses?|replies|reply|disqus|widget|toolbar|copyright|legal)")
#: A name that is a part of a class or id, and one that is all of it.
_BOILER = re.compile(r"(?:^|[\s_-])" + _NAMES + r"(?:$|[\s_-])")
_BOILER_TOKEN = re.compile(r"(?:^|\s)" + _NAMES + r"(?:$|\s)")
_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())


class Lines(HTMLParser):
    """Collects `lines`: (text, tags, container number, article number or -1,
    region number, characters in links, whether it is a heading)."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, int, int, int, int, bool]] = []
        self.open: list[tuple[str, int, int, int]] = []  # tag, container, article, region
        self.regions = [(-1, False, False)]  # parent, named in full, an article; 0 is the page
        self.within = {}  # of the articles that are no region: their region
        self.skipped = 0  # depth of `open` from which everything is left out
        self.parts: list[str] = []
        self.tags = 0
        self.linked = 0  # characters of the line that stand in links
        self.links = 0  # open link elements
        self.heading = 0  # depth of the open heading element
        self.top = 0  # depth of an article's header, of which only headings count
        self.parents = [-1]  # of the containers, by number; 0 is the page
        self.kinds = [""]  # their tags

    def _end_line(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            self.parts.clear()
            if text and (self.heading or not self.top):
                self.lines.append((text, self.tags, *self._where(), min(self.linked, len(text)), self.heading > 0))
        self.tags = self.linked = 0

    def _where(self) -> tuple[int, int, int]:
        return self.open[-1][1:] if self.open else (0, -1, 0)

    def handle_starttag(self, tag, attrs):
        if tag in _ENDS:
            for i in range(len(self.open) - 1, -1, -1):
                if self.open[i][0] in _ENDS[tag]:
                    self._pop(i)
                    break
                if self.open[i][0] in _SCOPE:
                    break
        if tag in _BLOCK and not self.skipped:
            self._end_line()
        self.tags += 1
        if tag == "br":
            self.parts.append(" ")
        if tag in _VOID:
            return
        container, article, region = self._where()
        if tag in _SCOPE or tag in _ARTICLE:
            self.parents.append(container)
            self.kinds.append(tag)
            container = len(self.parents) - 1
        names = dict(attrs)
        is_article = tag in _ARTICLE or names.get("role") in _ARTICLE
        if is_article:
            article = container if article < 0 else article
        named = 0 if self.skipped or tag in ("html", "body") else self._named(tag, names, is_article)
        if named:
            self._end_line()
            self.tags = 0
            self.regions.append((region, named == 2, is_article))
            region = len(self.regions) - 1
        elif article == container and is_article:
            self.within[article] = region
        self.open.append((tag, container, article, region))
        self.links += tag == "a"
        if not self.skipped and tag in _HEADING and not self.heading:
            self.heading = len(self.open)
        if not self.skipped and tag == "header" and article >= 0 and not named:
            self._end_line()
            self.top = self.top or len(self.open)
        elif not self.skipped and tag in _SKIP:
            self._end_line()
            self.skipped = len(self.open)

    def handle_startendtag(self, tag, attrs):
        if tag in _VOID:
            self.handle_starttag(tag, attrs)
        else:  # as browsers do, the slash of other elements is ignored
            self.handle_starttag(tag, attrs)

    def _named(self, tag: str, names: dict, is_article: bool) -> int:
        """Whether an element is a region: 2 if named in full, 1 if in part."""
        if tag in _SKIP or tag in ("main", "h1"):
            return 0
        if "hidden" in names or names.get("aria-hidden") == "true" or (names.get("role") or "").lower() in _ROLES:
            return 2
        name = f"{names.get('class') or ''} {names.get('id') or ''}".lower()
        if tag == "form":
            return 1
        if _BOILER_TOKEN.search(name):
            return 2
        return 1 if not is_article and _BOILER.search(name) else 0

    def handle_endtag(self, tag):
        self.tags += 1
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                self._pop(i)
                return
        if tag in _BLOCK and not self.skipped:
            self._end_line()

    def _pop(self, i: int) -> None:
        """Close the open elements from number `i` on."""
        left = self._where()[2]
        if not self.skipped and (any(t[0] in _BLOCK for t in self.open[i:]) or left != (self.open[i - 1][3] if i else 0)):
            self._end_line()
        self.links -= sum(t[0] == "a" for t in self.open[i:])
        del self.open[i:]
        if self.heading > len(self.open):
            self.heading = 0
        if self.top > len(self.open):
            self.top = 0
        if left != self._where()[2]:
            self.tags = 0
        if self.skipped > len(self.open):
            self.skipped = 0
            self.tags = 0

    def handle_data(self, data):
        if not self.skipped:
            self.parts.append(data)
            self.linked += len(data.strip()) * (self.links > 0)


def lines_of(html: str) -> tuple[list[tuple], list[int], list[str]]:
    """Lines of a page outside the regions that go, and the parents and tags of
    its containers."""
    parser = Lines()
    parser.feed(html)
    parser.close()
    parser._end_line()
    return judged(parser.lines, parser.regions, parser.within), parser.parents, parser.kinds


def judged(lines: list[tuple], regions: list[tuple[int, bool, bool]], within: dict[int, int]) -> list[tuple]:
    """Lines outside the regions that go.  A region stays, as if it were not
    named, if it holds the page's only articles or, unless it is named in full,
    most of the text.  Where a tenth of the text or less would be left, and no
    article, all regions stay."""
    size, holds, outside = [0] * len(regions), [False] * len(regions), False
    for text, _, _, article, region, *_ in lines:
        size[region] += len(text)
        at = within.get(article, -1)
        outside |= at == 0
        if at >= 0:
            holds[at] = True
    for r in range(len(regions) - 1, 0, -1):  # a region comes after its parent
        size[regions[r][0]] += size[r]
        holds[regions[r][0]] |= holds[r]
    stays = [True] * len(regions)
    for r, (parent, full, is_article) in enumerate(regions[1:], 1):
        most = 2 * size[r] > size[0] and (not outside if is_article else not full)
        stays[r] = stays[parent] and (most or holds[r] and not outside)
    left = [x for x in lines if stays[x[4]]]
    if 10 * sum(len(x[0]) for x in left) <= size[0] and not any(x[3] >= 0 for x in left):
        return lines
    return left


def smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian smoothing over neighbouring lines."""
    reach = int(np.ceil(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    weight = np.convolve(np.ones(len(ratios)), kernel, "full")[reach : reach + len(ratios)]
    return np.convolve(ratios, kernel, "full")[reach : reach + len(ratios)] / weight


def threshold(values: np.ndarray) -> float:
    """Border between two clusters of the values (two means on a log scale)."""
    v = np.log1p(values)
    low, high = v.min(), v.max()
    for _ in range(30):
        border = (low + high) / 2
        under, over = v[v < border], v[v >= border]
        new = (under.mean() if len(under) else low, over.mean() if len(over) else high)
        if new == (low, high):
            break
        low, high = new
    return min(float(np.expm1((low + high) / 2)), float(values.max()))  # the largest is content, rounding or not


def pruned(lines: list[tuple], chosen: list[int], own: np.ndarray, border: float, parents: list[int], kinds: list[str], roots: set[int], edges: bool) -> list[int]:
    """Of the `chosen` lines those outside the containers that go (see above);
    `roots` are the containers that were chosen, which stay.  `own` are the
    lines' ratios before smoothing.  With `edges`, containers at either end go,
    too, if no line in them has half the usual ratio of content, unless the
    content itself stands in containers of a line each."""
    content = {i for i in chosen if own[i] >= border}
    if not content:
        return chosen
    usual = float(np.median(own[sorted(content)]))
    strong = {i for i in content if 2 * own[i] >= usual}
    size, linked, good, best, heads = ([0] * len(parents) for _ in range(5))
    for i in chosen:
        c = lines[i][2]
        size[c] += len(lines[i][0])
        linked[c] += lines[i][5]
        good[c] += i in content
        best[c] += i in strong
        heads[c] += lines[i][6]
    direct = sum(best[c] for c in range(len(parents)) if c in roots or kinds[c] in _LISTS)
    for c in range(len(parents) - 1, 0, -1):  # a container comes after its parent
        if c not in roots:
            for n in (size, linked, good, best, heads):
                n[parents[c]] += n[c]
    edges = edges and 2 * direct >= len(strong)
    first, last = min(strong), max(strong)
    outer = {lines[i][2] for i in chosen if i < first or i > last}
    gone: dict[int, bool] = {}

    def goes(c: int) -> bool:
        path = []
        while c not in gone:
            if c <= 0 or c in roots:
                gone[c] = False
            elif not good[c] and 2 * linked[c] >= size[c] or edges and not best[c] and c in outer and not heads[c] and kinds[c] not in _LISTS:
                gone[c] = True
            else:
                path.append(c)
                c = parents[c]
        for p in path:
            gone[p] = gone[c]
        return gone[c]

    return [i for i in chosen if not goes(lines[i][2])]


def main_text(html: str | None) -> str:
    """Blocks of the article, joined by line feeds."""
    lines, parents, kinds = lines_of(html or "")
    if not lines:
        return ""
    if 10 * sum(x[5] for x in lines) > 9 * sum(len(x[0]) for x in lines):  # a link that was never closed, or nothing but links
        lines = [(*x[:5], 0, x[6]) for x in lines]
    own = np.array([(len(x[0]) - x[5]) / max(1, x[1]) for x in lines], np.float64)
    ratio = smoothed(own)
    border = threshold(ratio)
    content, alone = np.flatnonzero(ratio >= border), min(border, threshold(own))
    articles = {lines[i][3] for i in content} - {-1} or {x[3] for x in lines} - {-1}
    if articles:
        chosen = [i for i, x in enumerate(lines) if x[3] in articles]
        return "\n".join(lines[i][0] for i in pruned(lines, chosen, own, alone, parents, kinds, articles, False))
    weight, size, count = ([0] * len(parents) for _ in range(3))
    for i in content:
        weight[lines[i][2]] += len(lines[i][0])
    for x in lines:
        size[x[2]] += len(x[0])
        count[x[2]] += 1
    total = sum(weight)
    for c in range(len(parents) - 1, 0, -1):  # a container comes after its parent
        for n in (weight, size, count):
            n[parents[c]] += n[c]
    best, inside = 0, {0}
    for c in range(1, len(parents)):
        # a container of one line is a paragraph, unless the line is most of all text there
        if parents[c] == best and 2 * weight[c] > total and (count[c] > 1 or 2 * size[c] > size[best]):
            best, inside = c, {c}
        elif parents[c] in inside:
            inside.add(c)
    chosen = [i for i, x in enumerate(lines) if x[2] in inside]
    return "\n".join(lines[i][0] for i in pruned(lines, chosen, own, alone, parents, kinds, {best}, True))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per row: `page_id`, `url`, `text`, `n_chars` (code points)."""

    def run(batches):
        for b in batches:
            done = [main_text(h) for h in texts(b.column(2))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(done, pa.string()), pa.array([len(t) for t in done], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    schema = T.StructType([field(pages, id_col, "page_id"), field(pages, url_col, "url"), T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    return pages.select(col(id_col).alias("page_id"), col(url_col).alias("url"), col(html_col).cast("string").alias("html")).mapInArrow(run, schema)
