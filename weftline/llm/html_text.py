"""HTML extraction by text-to-tag ratio.

The standard library's parser streams events; block-level tags cut the page into lines, each with its text, its number
of tags, its text in links and the element it stands in.  The lines' text-to-tag ratios (text in links counts a quarter)
are smoothed with a Gaussian, among the lines that bear no sign and among those of each box that bears one, and clustered
in two by a threshold; clusters whose means are less than APART_BY apart are one.  The high cluster selects the content:

* Signs are features of the ratio, not rules: what stands in an article or main element weighs BOOST times as much,
  what stands under a name of boilerplate or in a form a fraction (STRONG; for names that mean other things too, WEAK,
  and nothing inside of an article).
* If articles hold most of the high cluster's text, the regions are those articles that it covers, and their siblings
  of the same kind that are text rather than links; beside them, lines of the high cluster stay that bear no sign.
* Else the region is the smallest container of all the high cluster's lines, widened while that adds text rather than links,
  to the whole body if it adds lines without a sign and hardly any links.
* A box of at least REPEATED like boxes (of one tag and class, without headings), that hold nearly all its text, is taken for
  reader comments behind an article of more text than one of them has on average, or, without articles, behind more text
  than they have in all.
* All of a region's lines stay, short ones too, but boxes with a sign that lie mostly in the low cluster, and, where no
  article bounds the region, boxes of links without a line of the high cluster.  A title outside is added if there is none
  inside.

Elements that are menus, sidebars, headers and footers by their tag, and those whose text is never shown, give no lines;
if nothing else is on the page, the former do.

Defined results: null and empty html give the empty text; so does a page without text; malformed markup is read as far
as the parser goes, with unclosed elements closed by their parents, and what never ends passed over; repeated rows each get a row; extra columns are
ignored; an empty table gives no rows.  Time and memory grow with the page, however deep it nests.
"""

from __future__ import annotations

import re
from html import unescape
from html.parser import HTMLParser

import numpy as np
from pyspark.sql import DataFrame

from .common import map_rows

#: Elements whose text is never shown as text.
UNSEEN = frozenset("script style template noscript svg math canvas object embed iframe head title button select textarea dialog menu datalist audio video map".split())
#: Elements that are no content by their tag; header only outside of an article.
APART = frozenset("nav footer aside".split())
#: Elements that end a line.
BLOCKS = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that hold several lines.
BOXES = frozenset("html body div section center blockquote table tbody tr td fieldset details form article main".split())
#: What an opening tag closes, if open in the same container.
LOOSE = frozenset("p li td th tr dd dt".split())
CLOSES = {"p": ("p",), "li": ("li",), "dt": ("dd", "dt"), "dd": ("dd", "dt"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)} | dict.fromkeys(BLOCKS - LOOSE - {"option", "html", "body"}, ("p",))
ARTICLES = ("article", "main")
#: Names in class, id, role and aria-label that mark boilerplate, whole tokens only: alone, joined to each other or with a part that names a box.
_STRONG = r"ads?|advert\w*|adsense|sponsor(?:ed|s)?|promo\w*|banner|side-?bar|(?:nav|menu)(?:bar|igation)?|bread-?crumbs?|footer|(?:site|page)-?(?:footer|header)|masthead|cookies?|consent|gdpr|comments?|replies|disqus|respond|newsletter|subscribe|subscription|popup|modal|overlay|login|signup|toolbar|pagination|pager|skip-?link|complementary|contentinfo"
_WEAK = r"notices?|alert|share|sharing|social|related|recommended|copyright|widget|search|header"
_PART = r"list|area|section|box|wrap(?:per)?|container|inner|block|item|slot|thread|form|bar|links?|top|bottom|left|right|[0-9]+"
STRONG_NAMES, WEAK_NAMES = (re.compile(rf"(?:^|(?<=\s))(?:{first})(?:[_-]+(?:{_STRONG}|{_WEAK}|{_PART}))*(?=\s|$)", re.IGNORECASE) for first in (_STRONG, _WEAK))
SIGMA, BOOST, STRONG, WEAK = 1.5, 3.0, 1 / 32, 1 / 4
#: How far the means of two clusters of log ratios must be apart, and how many like boxes make a thread.
APART_BY, REPEATED = 1.4, 3
_UNSHOWN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)\b", re.IGNORECASE)
_SPACE = re.compile(r"\s+")
_TAG = re.compile(r"<[A-Za-z/][^<>]*>")


class _Lines(HTMLParser):
    """Cuts a page into lines (text, tags, element, text in links) of the elements it numbers in page order."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, int, int]] = []
        self.tag: list[str] = ["#page"]
        self.parent: list[int] = [-1]
        self.last: list[int] = [0]  # the last element inside
        self.hidden: list[int] = [0]  # 1 apart, 2 unseen, here or above
        self.article: list[int] = [-1]  # the innermost article
        self.sign: list[int] = [-1]  # the outermost element with a sign, here or above
        self.weight: list[float] = [1.0]
        self.shape: list[str] = [""]  # tag and class, empty without a class
        self.open: list[int] = [0]
        self.places: dict[str, list[int]] = {}  # where tags stand in `open`
        self.walls: list[int] = [0]  # where containers stand in `open`
        self.text: list[str] = []
        self.tags = self.linked = 0

    def cut(self) -> None:
        text = _SPACE.sub(" ", "".join(self.text)).strip()
        if text:
            self.lines.append((text, max(1, self.tags), self.open[-1], min(self.linked, len(text))))
        self.text, self.tags, self.linked = [], 0, 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in BLOCKS:
            self.cut()
        self.tags += 1
        if tag in VOID:
            if tag == "br":
                self.text.append(" ")
            return
        if tag in CLOSES:
            at = max((self.places[t][-1] for t in CLOSES[tag] if self.places.get(t)), default=0)
            if at > self.walls[-1]:
                self._close(at)
        above, me = self.open[-1], len(self.tag)
        sign, weight, article = self.sign[above], self.weight[above], self.article[above]
        given = dict(attrs)
        unseen = tag in UNSEEN or "hidden" in given or _UNSHOWN.search(given.get("style") or "")
        hidden = 2 if unseen else 1 if tag in APART or tag == "header" and article < 0 else 0
        if tag in ARTICLES:
            if self.hidden[above] == 1:
                hidden = max(hidden, 0)  # a header or menu that was never closed
            else:
                hidden = max(hidden, self.hidden[above])
            if article < 0 and sign < 0:
                weight *= BOOST
            article = me
        else:
            hidden = max(hidden, self.hidden[above])
            named = " ".join(v for k, v in attrs if k in ("class", "id", "role", "aria-label") and v) if tag not in ("html", "body") else ""
            strong = tag == "form" or bool(named and STRONG_NAMES.search(named))
            if sign < 0 and (strong or named and WEAK_NAMES.search(named)):
                sign = me
                weight *= STRONG if strong else WEAK if article < 0 else 1
        self.tag.append(tag)
        self.parent.append(above)
        self.last.append(me)
        self.hidden.append(hidden)
        self.article.append(article)
        self.sign.append(sign)
        self.weight.append(weight)
        self.shape.append(f"{tag} {given['class']}" if given.get("class") else "")
        self.places.setdefault(tag, []).append(len(self.open))
        if tag in BLOCKS and tag not in LOOSE:
            self.walls.append(len(self.open))
        self.open.append(me)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def _close(self, at: int) -> None:
        """Closes the open elements from that place on."""
        newest = len(self.tag) - 1
        while len(self.open) > at:
            tag = self.tag[self.open[-1]]
            self.last[self.open.pop()] = newest
            self.places[tag].pop()
            if self.walls[-1] == len(self.open):
                self.walls.pop()

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self.cut()
        self.tags += 1
        if self.places.get(tag):
            self._close(self.places[tag][-1])

    def handle_data(self, data: str) -> None:
        if self.hidden[self.open[-1]] == 2:
            return
        self.text.append(data)
        if self.places.get("a"):
            self.linked += len(data.strip())

    def end(self) -> None:
        self.cut()
        self._close(1)
        self.last[0] = len(self.tag) - 1


def _read(page: _Lines, html: str) -> None:
    """Feeds a page; of markup that never ends, its beginning is passed over and the rest is read on, all of a kind at once."""
    page.feed(html)
    while (rest := page.rawdata).startswith("<") and not page.cdata_elem:
        if rest[:4] == "<!--" or rest[:3] == "<![":
            on = rest.replace(rest[:4] if rest[:4] == "<!--" else "<![", "")
        elif ">" in rest:  # a quote that is never closed
            on = _TAG.sub(lambda m: m[0].replace('"', "").replace("'", ""), rest)
        else:
            on = rest
        if on == rest:
            page.handle_data(unescape(rest))
            page.rawdata = ""
            return
        page.rawdata = ""
        page.feed(on)
    page.close()


def smoothed(x: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """x under a Gaussian of its neighbours, weights renormalised at the ends."""
    r = int(3 * sigma)
    k = np.exp(-0.5 * (np.arange(-r, r + 1) / sigma) ** 2)
    return np.convolve(x, k)[r : r + len(x)] / np.convolve(np.ones(len(x)), k)[r : r + len(x)]


def high_cluster(x: np.ndarray) -> np.ndarray:
    """Which values lie in the upper of two clusters; all, if the clusters' means are not apart."""
    if len(x) < 2 or np.ptp(x) < APART_BY:
        return np.ones(len(x), bool)
    cut = (x.min() + x.max()) / 2
    for _ in range(20):
        hi = x > cut
        new = (x[hi].mean() + x[~hi].mean()) / 2 if hi.any() and not hi.all() else cut
        if abs(new - cut) < 1e-9:
            break
        cut = new
    hi = x > cut
    return hi if x[hi].mean() - x[~hi].mean() >= APART_BY else np.ones(len(x), bool)


def smoothed_by_sign(ratio: np.ndarray, sign: np.ndarray) -> np.ndarray:
    """The ratios smoothed among the lines of each sign, so that text beside a box does not lift it, nor a box lower the text."""
    out = np.empty_like(ratio)
    order = np.argsort(sign, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(sign[order])) + 1):
        out[part] = smoothed(ratio[part])
    return out


def _threads(page: _Lines, text: np.ndarray) -> np.ndarray:
    """Which elements are boxes of like boxes that hold nearly all their text."""
    held: dict[tuple[int, str], list[int]] = {}
    for e, shape in enumerate(page.shape):
        if shape and text[e]:
            held.setdefault((page.parent[e], shape), []).append(e)
    out = np.zeros(len(page.tag), bool)
    for (above, _), like in held.items():
        if len(like) >= REPEATED and above > 0 and page.tag[above] not in ("html", "body", *ARTICLES):
            out[above] = 10 * sum(int(text[e]) for e in like) >= 9 * text[above]
    headings = np.cumsum([bool(re.fullmatch("h[1-6]", t)) for t in page.tag])
    return out & (headings[np.array(page.last)] == headings)


def _sums(page: _Lines, at: np.ndarray, values: np.ndarray) -> np.ndarray:
    """What the lines at those elements amount to in every element with all that is inside it."""
    own = np.bincount(at, weights=values, minlength=len(page.tag))
    upto = np.r_[0, np.cumsum(own)]
    return upto[np.array(page.last) + 1] - upto[:-1]


def _behind_article(page: _Lines, text: np.ndarray) -> np.ndarray:
    """Which boxes begin behind the end of an article that holds more text than one of the box's children does on average."""
    children = np.bincount(np.maximum(page.parent, 0), weights=(text > 0), minlength=len(page.tag))
    size = np.zeros(len(page.tag))
    for e, t in enumerate(page.tag):
        if t in ARTICLES and page.hidden[e] == 0:
            size[page.last[e]] = max(size[page.last[e]], text[e])
    longest = np.r_[0, np.maximum.accumulate(size)][:-1]  # of the articles that ended before
    return longest * np.maximum(children, 1) > text


def _articles(page: _Lines, high: np.ndarray, chars: np.ndarray, links: np.ndarray) -> list[int]:
    """The articles that the high cluster covers, innermost where these hold all of it; none if most of it is elsewhere."""
    inner: dict[int, list[int]] = {}
    for e, t in enumerate(page.tag):
        if t in ARTICLES and page.hidden[e] == 0:
            inner.setdefault(page.article[page.parent[e]], []).append(e)
    out, todo = [], [inner.get(-1, [])]
    if 2 * sum(high[e] for e in todo[0]) <= high[0]:
        return []
    while todo:
        level = todo.pop()
        for e in level:
            nested = inner.get(e, [])
            if high[e] and nested and sum(high[n] for n in nested) >= high[e]:
                todo.append(nested)
            elif high[e] or page.sign[e] < 0 and 2 * links[e] <= chars[e]:
                out.append(e)
    return out


def main_text(html: str | None) -> str:
    """The main text of a page, its blocks joined by two line feeds."""
    if not html:
        return ""
    page = _Lines()
    try:
        _read(page, html)
    except (AssertionError, ValueError):
        pass  # what the parser cannot read on from: the lines so far stand
    page.end()
    lines = [x for x in page.lines if not page.hidden[x[2]]] or [x for x in page.lines if page.hidden[x[2]] == 1]
    if not lines:
        return ""
    at = np.array([e for _, _, e, _ in lines])
    size, linked = np.array([len(t) for t, *_ in lines]), np.array([n for *_, n in lines])
    sign, weight, article = (np.array(x)[at] for x in (page.sign, page.weight, page.article))
    ratio = np.log1p((size - 0.75 * linked) / np.array([n for _, n, *_ in lines]) * weight)
    alone, high = high_cluster(ratio), high_cluster(smoothed_by_sign(ratio, sign))
    text, links, held = (_sums(page, at, x) for x in (size, linked, size * high))
    plain, plain_links = (_sums(page, at, x * (sign < 0)) for x in (size, linked))

    low_box = 2 * held[sign] <= text[sign]  # of lines with a sign: their box lies mostly in the low cluster
    wanted = (sign < 0) | ~low_box
    thread, last = _threads(page, text), np.array(page.last)
    replies = _under(page, thread & _behind_article(page, text))[at]
    regions = _articles(page, _sums(page, at, size * high * ~replies), text, links)
    if regions:
        within = np.zeros(len(lines), bool)
        for e in regions:
            lo, hi = np.searchsorted(at, [e, last[e] + 1]) if (np.diff(at) >= 0).all() else (0, len(lines))
            within[lo:hi] |= (at[lo:hi] >= e) & (at[lo:hi] <= last[e])
        stay = within & wanted | ~within & high & alone & (sign < 0) & (2 * linked <= size) & ~replies
    else:
        before = np.r_[0, np.cumsum(size * high * (sign < 0))][np.searchsorted(at, np.arange(len(page.tag)))] if (np.diff(at) >= 0).all() else np.zeros(len(page.tag))
        behind = _under(page, thread & (before > text))[at]
        region = _box(page, at[core] if (core := high & ~behind & (2 * linked <= size)).any() else at[high], text, links, plain, plain_links)
        within = (at >= region) & (at <= last[region])
        menu = (links * 2 > text) & (held == 0) & np.isin(page.tag, (*BOXES, "ul", "ol", "dl"))
        stay = within & wanted & ~behind & ((article >= 0) | ~_under(page, menu)[at])
    title = _under(page, np.array(page.tag) == "h1")[at]
    if not (title & stay).any():
        stay |= title & (sign < 0)
    return "\n\n".join(x[0] for x, s in zip(lines, stay, strict=True) if s)


def _under(page: _Lines, mark: np.ndarray) -> np.ndarray:
    """Which elements are marked, or stand in one that is."""
    n = len(mark) + 1
    ends = np.array(page.last)[mark] + 1
    return np.cumsum(np.bincount(np.flatnonzero(mark), minlength=n) - np.bincount(ends, minlength=n))[:-1] > 0


def _box(page: _Lines, at: np.ndarray, text: np.ndarray, links: np.ndarray, plain: np.ndarray, plain_links: np.ndarray) -> int:
    """The smallest container of those lines, widened while what is added is text rather than links; plain: of lines without a sign."""
    if not len(at):
        return 0
    box, last = int(at.min()), int(at.max())
    while box and (page.last[box] < last or page.tag[box] not in BOXES):
        box = page.parent[box]
    wide = page.parent[box]
    while box and wide > 0:
        if page.tag[wide] in ("html", "body"):
            more = plain[wide] - plain[box]
            if not more or 10 * (plain_links[wide] - plain_links[box]) > more:
                break
        elif 2 * (links[wide] - links[box]) > text[wide] - text[box]:
            break
        box, wide = wide, page.parent[wide]
    return box


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""

    def start():
        def make(htmls: list[str | None]) -> dict:
            texts = [main_text(h) for h in htmls]
            return {"text": texts, "n_chars": [len(t) for t in texts]}

        return make

    return map_rows(pages.select("page_id", "url", "html"), "html", start, "text string, n_chars long", 200)
