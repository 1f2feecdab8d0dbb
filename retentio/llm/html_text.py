"""HTML extraction: parser events, text-to-tag ratio per line, smoothing, threshold clustering.

The standard library's parser streams the page's events. Block elements cut the
page into lines; each has its text, the number of tags in it, and the containers
that it lies in. Elements that name themselves as something other than the
article (menus, headers, footers, sidebars, notices, adverts, forms, scripts,
styles, comments) are left out as they are met. The name of a wrapper (a div or
section called "widget", say) is only a hint: it holds unless all content, by the
ratios below, lies in such wrappers.

The text-to-tag ratios of the lines are smoothed with a Gaussian and split into
two clusters at the threshold between their means. Lines of the upper cluster
mark the content; the region holds all of it: the article and main elements if no
content lies outside them, else the innermost container that holds every content
line, or the page, beside the articles. All lines of the region are returned,
short ones too.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import ship

SIGMA, RADIUS = 1.0, 2
#: Fewer characters than this outside the articles are a remark, not content.
REMARK = 40

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer
form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section select summary table tbody td textarea
tfoot th thead title tr ul""".split())
CONTAINER = frozenset("article main section div td body blockquote center".split())
REGION = frozenset(("article", "main"))
OUT_TAGS = frozenset("""aside audio button canvas dialog fieldset footer form head header iframe input label math menu nav noscript object
option script select style svg template textarea title video""".split())
OUT_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
OUT_NAMES = frozenset("""ad ads adbox adsense advert adverts advertisement advertisements advertising banner breadcrumb breadcrumbs comment
comments commentlist consent cookie cookies disclaimer discussion disqus footer gdpr header login masthead menu menus modal nav navbar
navigation newsletter notice notices notification outbrain overlay pager pagination popup promo promos promotion recommended related
replies respond search share sharing sidebar sidebars signup skyscraper social sponsor sponsored sponsors subscribe subscription taboola
toolbar topbar widget widgets""".split())
#: Readers' remarks are long texts too: their containers are left out whatever their ratio.
REMARK_NAMES = frozenset("comment comments commentlist discussion disqus replies respond".split())
LAYOUT = frozenset("has with no without".split())
#: Elements that a new block of the same kind, or any block for p, closes.
_CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_NAME = re.compile("[a-z0-9]+")
_CAMEL = re.compile("(?<=[a-z0-9])(?=[A-Z])")


def _named_out(attrs) -> bool:
    for key, value in attrs:
        if not value:
            continue
        if key == "role" and value.strip().lower() in OUT_ROLES:
            return True
        if key in ("class", "id"):
            for name in value.split():
                parts = _NAME.findall(_CAMEL.sub(" ", name).lower())
                if not OUT_NAMES.isdisjoint(parts) and LAYOUT.isdisjoint(parts):  # has-sidebar names the page, not the sidebar
                    return True
    return False


def _remarks(attrs) -> bool:
    return any(key in ("class", "id") and value and not REMARK_NAMES.isdisjoint(_NAME.findall(_CAMEL.sub(" ", value).lower())) for key, value in attrs)


class PageLines(HTMLParser):
    """Lines of a page: (text, tags, innermost container or -1). ``out`` counts open elements that are left out.

    Containers are numbered as they open and know their parent, so a line costs the
    same however deep it lies.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, int]] = []
        self.kinds: list[str] = []  # of the containers, by number
        self.parents: list[int] = []
        self.doubtful: list[bool] = []  # containers left out by their name only
        self.path: list[int] = []  # open containers
        self.open: list[tuple[str, int, bool]] = []  # tag, container number or -1, left out
        self.names: Counter[str] = Counter()  # open elements by tag
        self.text: list[str] = []
        self.tags = 0
        self.out = 0

    def flush(self):
        text = " ".join("".join(self.text).split())
        if text:
            self.lines.append((text, self.tags, self.path[-1] if self.path else -1))
        self.text, self.tags = [], 0

    def handle_starttag(self, tag, attrs):
        if tag in BLOCK:
            self.flush()
            if self.open and self.open[-1][0] == "p" or tag in _CLOSES:
                self._imply_end(tag)
        elif tag == "br" and not self.out:
            self.text.append(" ")
        self.tags += 1
        if tag in VOID:
            return
        named = tag not in ("html", "body") and _named_out(attrs)
        # a name alone does not decide for a wrapper, unless it is one of readers' remarks
        doubtful = named and tag in ("div", "section") and not _remarks(attrs)
        out = tag in OUT_TAGS or named and not doubtful
        if tag in REGION and not named and any(self.doubtful[c] for c in self.path):
            # a wrapper named after its sidebar or menu does not hide the article itself
            for c in self.path:
                self.doubtful[c] = False
        number = -1
        if tag in CONTAINER:
            number = len(self.kinds)
            self.kinds.append(tag)
            self.parents.append(self.path[-1] if self.path else -1)
            self.doubtful.append(doubtful)
            self.path.append(number)
        self.open.append((tag, number, out))
        self.names[tag] += 1
        self.out += out

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in ("p", "div", "b", "i", "a", "span"):
            self.handle_endtag(tag)

    def _imply_end(self, tag):
        """A new block closes an open p, a new item the one before it in the same list."""
        closes = _CLOSES.get(tag, ())
        for i in range(len(self.open) - 1, -1, -1):
            name = self.open[i][0]
            if name == "p" and tag not in _CLOSES or name in closes:
                self._close(i)
                return
            if name in BLOCK:
                return

    def _close(self, i):
        for tag, number, out in self.open[i:]:
            self.out -= out
            self.names[tag] -= 1
            if number >= 0:
                self.path.pop()
        del self.open[i:]

    def handle_endtag(self, tag):
        if tag in BLOCK:
            self.flush()
        self.tags += 1
        if not self.names[tag]:
            return
        for i in range(len(self.open) - 1, -1, -1):
            name = self.open[i][0]
            if name == tag:
                self._close(i)
                return
            if name in REGION and tag not in ("body", "html"):
                return  # a stray end tag does not reach out of the article

    def handle_data(self, data):
        if not self.out:
            self.text.append(data)


def smooth(values: list[float], sigma: float = SIGMA, radius: int = RADIUS) -> list[float]:
    """Gaussian smoothing; at the ends the kernel is cut and rescaled."""
    kernel = [math.exp(-d * d / (2 * sigma * sigma)) for d in range(-radius, radius + 1)]
    out = []
    for i in range(len(values)):
        total = weight = 0.0
        for d, k in enumerate(kernel, i - radius):
            if 0 <= d < len(values):
                total += k * values[d]
                weight += k
        out.append(total / weight)
    return out


def threshold(values: list[float]) -> float:
    """Middle between the means of two clusters (two-means on a line)."""
    cut = sum(values) / len(values)
    for _ in range(20):
        low, high = [v for v in values if v < cut], [v for v in values if v >= cut]
        if not low or not high:
            break
        new = (sum(low) / len(low) + sum(high) / len(high)) / 2
        if abs(new - cut) < 1e-9:
            break
        cut = new
    return cut


def _content(lines) -> list[bool]:
    """The lines whose smoothed text-to-tag ratio falls into the upper cluster."""
    ratio = smooth([len(text) / max(1, tags) for text, tags, _ in lines])
    cut = threshold(ratio)
    return [r >= cut for r in ratio]


def _down(parents: list[int], flags) -> list[bool]:
    """Flags of the containers, handed down to all that lie in them (the last entry: in none)."""
    out = [False] * (len(parents) + 1)
    for c, (parent, flag) in enumerate(zip(parents, flags)):
        out[c] = flag or out[parent]
    return out


def _innermost(parents: list[int], containers) -> int:
    """The innermost container that holds all of ``containers``; -1 if none does."""
    held = [0] * (len(parents) + 1)
    for c in containers:
        held[c] += 1
    for c in range(len(parents) - 1, -1, -1):  # a container opens after its parent
        held[parents[c]] += held[c]
    return max((c for c, n in enumerate(held[:-1]) if n == len(containers)), default=-1)


def _believed(page: PageLines) -> list[tuple[str, int, int]]:
    """The lines outside doubtful containers. If there is neither an article nor a line of
    some length outside them, and all content lies in them, their names say nothing about
    it, and the lines of the containers with content count too."""
    hidden = _down(page.parents, page.doubtful)
    plain = [line for line in page.lines if not hidden[line[2]]]
    if len(plain) == len(page.lines) or not REGION.isdisjoint(page.kinds) or any(len(text) >= REMARK for text, _, _ in plain):
        return plain
    content = [line for line, ok in zip(page.lines, _content(page.lines)) if ok]
    if not all(hidden[c] for _, _, c in content) or max(len(text) for text, _, _ in content) < REMARK:
        return plain
    trusted = set()
    for _, _, c in content:
        while c >= 0 and c not in trusted:
            trusted.add(c)
            c = page.parents[c]
    hidden = _down(page.parents, [d and c not in trusted for c, d in enumerate(page.doubtful)])
    return [line for line in page.lines if not hidden[line[2]]]


def main_text(html: str | None) -> str:
    """The article's blocks, joined by newlines; empty if there are none."""
    if not html:
        return ""
    page = PageLines()
    page.feed(html)
    page.close()
    page.flush()
    lines = _believed(page) if page.lines else []
    if not lines:
        return ""
    content = _content(lines)
    kept = in_article = _down(page.parents, [kind in REGION for kind in page.kinds])
    articles = any(in_article[c] for _, _, c in lines)
    outside = sum(len(text) for (text, _, c), ok in zip(lines, content) if ok and not in_article[c])
    if not articles or outside >= REMARK:
        common = _innermost(page.parents, [c for (_, _, c), ok in zip(lines, content) if ok])
        within = _down(page.parents, [c == common for c in range(len(page.kinds))])
        kept = [a or b or common < 0 for a, b in zip(in_article, within)]
    return "\n".join(text for text, _, c in lines if kept[c])


def _rows(batches):
    for batch in batches:
        texts = [main_text(h) for h in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
                                         names=["page_id", "url", "text", "n_chars"])


def extract_text(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars (code points).

    A null or empty page has an empty text. Repeated rows are extracted alike,
    null ids and urls are passed on, an empty table gives an empty result. A page
    without lines of content above the threshold is returned as one region.
    Other columns are ignored.
    """
    ship(pages.sparkSession)
    kind = {f.name: f.dataType.simpleString() for f in pages.schema}
    return pages.select("page_id", "url", "html").mapInArrow(_rows, f"page_id {kind['page_id']}, url {kind['url']}, text string, n_chars long")


def op9_html_text(spark, sf_dir: str) -> DataFrame:
    return extract_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))
