"""Main text of web pages by tag-path ratios.

A page becomes a list of text blocks, each with the path of block tags from
the root to it.  Elements that are no article by their kind (menus, footers,
scripts, hidden parts, reader comments) give no blocks.  Those that only their
name, role or being a form tells from an article (sidebars, notices, adverts)
are left aside, unless one of them holds most of the text and punctuation of a
page and no article stands beside it: then its name has misled.

Per path the characters and the punctuation per block are added up; both
ratios are fused, less the share of link text, smoothed along the page and
held against a share of their spread.  The blocks above it are content nodes.
The element that holds most of their text is the article; its blocks are the
result, short paragraphs and headings included, but for lists of links.

Elements are numbered in page order and point to their parents, so a block
costs the same however deep it is.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import prepare

# fixed values: HTML element kinds
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
                  "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol "
                  "p pre section summary table tbody tfoot thead tr ul".split())
LEAF = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre tr caption figcaption summary legend".split())
DROPPED = frozenset("script style noscript template svg math iframe object canvas audio video head title nav footer aside "
                    "menu dialog button select option textarea datalist".split())
ASIDE = frozenset(["form"])
NO_BLOCK = frozenset("html body main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# what an opening tag ends, if it is the innermost open block of that kind
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "option": ("option",)}
SCOPES = frozenset("ul ol menu dl table".split())
# names of elements that hold no article text
NAMES = frozenset("""
    ad ads advert adverts advertisement advertising advertorial banner sponsor sponsored sponsors promo promotion promoted
    nav navbar navigation menu breadcrumb breadcrumbs pagination pager paging toolbar topbar masthead sidebar sidenav rail
    footer foot colophon copyright legal disclaimer cookie cookies consent gdpr notice notices notification alert popup modal
    overlay newsletter subscribe subscription signup login signin register search share sharing social follow related
    recommended recommendations recirculation trending comment comments commentlist disqus respond replies reply
    discussion feedback widget widgets tagcloud""".split())
WHOLE = frozenset("hidden print skip".split())  # only as a whole name: parts of layout names as well
SPOKEN = frozenset("comment comments commentlist disqus replies discussion".split())
STATES = frozenset("has with without no is show hide open enable disable".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar "
                  "tablist status".split())
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")
_TAG_START = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ/!?")
_SPACE = re.compile(r"\s+")
_PUNCT = re.compile(r"[.,;:!?。，、；：！？…]")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def is_gone(tag: str, attrs: dict[str, str | None]) -> bool:
    """Whether an element is hidden, or holds what readers say."""
    if "hidden" in attrs or attrs.get("aria-hidden") == "true" or _HIDDEN.search(attrs.get("style") or ""):
        return True
    return tag not in NO_BLOCK and any(SPOKEN.intersection(words) for words in _names(attrs))


def is_noise(tag: str, attrs: dict[str, str | None]) -> bool:
    """Whether an element by its names holds no article text."""
    if tag in NO_BLOCK:
        return False
    if (attrs.get("role") or "").lower() in ROLES:
        return True
    if any(n.lower() in WHOLE for n in f"{attrs.get('class') or ''} {attrs.get('id') or ''}".split()):
        return True
    return any(words[0] in NAMES or words[-1] in NAMES or words[-1] == "header" and tag != "article" for words in _names(attrs))


def _names(attrs: dict[str, str | None]) -> Iterator[list[str]]:
    """The words of each class and id, but for those that name a state."""
    for name in f"{attrs.get('class') or ''} {attrs.get('id') or ''}".split():
        words = [w.lower() for w in _WORDS.findall(name)]
        if words and words[0] not in STATES and words[-1] not in STATES:
            yield words


class Block:
    __slots__ = ("owner", "parts", "linked")

    def __init__(self, owner: int):
        self.owner = owner
        self.parts: list[str] = []
        self.linked = 0


class PageParser(HTMLParser):
    """Blocks of a page in page order, and the tree of their elements.

    Element 0 is the page.  ``path`` numbers the distinct paths of tags;
    ``last`` is the last element inside an element; ``aside`` the innermost
    element around (or it) that is left aside by its name."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.tags, self.parent, self.path, self.last, self.aside, self.holder = [""], [0], [0], [0], [-1], [-1]
        self.paths: dict[tuple[int, str], int] = {}
        self.stack: list[tuple[str, int, bool]] = []  # tag, element, gone
        self.open: Counter = Counter()
        self.blocks: list[Block] = []
        self.current: Block | None = None
        self.links = 0  # 1 inside a link, which ends with the block it began in
        self.link_depth = 0

    def parse_marked_section(self, i, report=1):
        """A marked section is no HTML: up to the next ``>`` it is a comment."""
        j = self.rawdata.find(">", i + 3)
        return j + 1 if j >= 0 else -1

    def _open(self, tag: str, gone: bool, aside: bool) -> None:
        up = self.stack[-1][1] if self.stack else 0
        n = len(self.tags)
        self.tags.append(tag)
        self.parent.append(up)
        self.path.append(self.paths.setdefault((self.path[up], tag), len(self.paths) + 1))
        self.last.append(n)
        self.aside.append(n if aside else self.aside[up])
        self.holder.append(n if tag not in LEAF and tag not in SCOPES else self.holder[up])
        self.stack.append((tag, n, gone or bool(self.stack and self.stack[-1][2])))
        self.open[tag] += 1

    def _close_to(self, i: int) -> None:
        end = len(self.tags) - 1
        for tag, n, _ in self.stack[i:]:
            self.last[n] = end
            self.open[tag] -= 1
        del self.stack[i:]
        if i < self.link_depth:
            self.links = 0

    def handle_starttag(self, tag, attrs):
        if tag == "br":
            self._space()
            return
        if tag in ("td", "th"):
            self._space()
        attrs = dict(attrs)
        if tag == "a":  # an anchor is no link
            self.links = int("href" in attrs or not ("name" in attrs or "id" in attrs))
            self.link_depth = len(self.stack)
        block = tag in BLOCK
        gone = tag in DROPPED or is_gone(tag, attrs) or not block and is_noise(tag, attrs)
        aside = block and (tag in ASIDE or is_noise(tag, attrs))
        if tag == "header" and not self.open["article"] and not self.open["main"]:
            gone = True
        if tag in VOID:
            if tag == "hr":
                self.current = None
            return
        if not block and not gone and not (self.stack and self.stack[-1][2]):
            return  # inline markup; inside a dropped element it is kept count of
        if block:
            for i in range(len(self.stack) - 1, -1, -1):
                t = self.stack[i][0]
                if t == "p" or t in ENDS.get(tag, ()):
                    self._close_to(i)
                    break
                if t in SCOPES or t in ("div", "article", "section", "td", "body"):
                    break
            self.current = None
        self._open(tag, gone, aside)

    def handle_startendtag(self, tag, attrs):
        if tag in VOID:
            self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if tag == "a":
            self.links = 0
        if tag in ("td", "th"):
            self._space()
        if not self.open[tag]:
            return
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                self._close_to(i)
                if tag in BLOCK:
                    self.current = None
                return

    def close(self):
        super().close()
        self._close_to(0)
        self.last[0] = len(self.tags) - 1

    def _space(self):
        if self.current is not None:
            self.current.parts.append(" ")

    def handle_data(self, data):
        if self.stack and self.stack[-1][2]:
            return
        if self.current is None:
            if not data.strip():
                return
            self.current = Block(self.stack[-1][1] if self.stack else 0)
            self.blocks.append(self.current)
        self.current.parts.append(data)
        if self.links:
            self.current.linked += len(data.strip())

    def inside(self, n: int, around: int) -> bool:
        return around <= n <= self.last[around]

    def sums(self, weight: dict[int, float]) -> list[float]:
        """Weight of the blocks in each element, added up the tree once."""
        out = [0.0] * len(self.tags)
        for n, w in weight.items():
            out[n] += w
        for n in range(len(out) - 1, 0, -1):
            out[self.parent[n]] += out[n]
        return out


def _smooth(x: np.ndarray) -> np.ndarray:
    kernel = np.exp(-np.arange(-2, 3) ** 2 / 2.0)
    pad = np.pad(x, 2)
    weight = np.convolve(np.pad(np.ones(len(x)), 2), kernel, "valid")
    return np.convolve(pad, kernel, "valid") / weight


def content_scores(texts: list[str], paths: list[int], linked: list[int]) -> np.ndarray:
    """Smoothed fusion of text and punctuation ratios of the blocks' paths."""
    total = defaultdict(lambda: [0, 0, 0, 0])
    for t, p, k in zip(texts, paths, linked):
        sums = total[p]
        for i, v in enumerate((1, len(t), len(_PUNCT.findall(t)), min(k, len(t)))):
            sums[i] += v
    fused = {p: (chars / n) * (1 + punct / n) * (1 - link / max(1, chars)) for p, (n, chars, punct, link) in total.items()}
    return _smooth(np.array([fused[p] for p in paths]))


def _not_aside(page: PageParser, found: list[tuple[Block, str]], share: float) -> list[tuple[Block, str]]:
    """The blocks outside elements left aside by name.  Such an element is
    taken back if it holds ``share`` of the text and punctuation of the page
    (links count nothing) in three blocks or more, no article stands outside,
    and beside a headline outside it holds nearly all."""
    if all(page.aside[b.owner] < 0 for b, _ in found):
        return found
    weight, heads, titles, count = (defaultdict(float) for _ in range(4))
    inside = [False] * len(page.tags)
    for n in range(1, len(inside)):
        inside[n] = page.tags[n] in ("article", "main") or inside[page.parent[n]]
    for b, t in found:
        weight[b.owner] += (len(t) - min(b.linked, len(t))) * len(_PUNCT.findall(t))
        count[b.owner] += 1
        if page.aside[b.owner] < 0:
            heads[b.owner] += inside[b.owner]
            titles[b.owner] += page.tags[b.owner] == "h1"
    weight, heads, titles, count = (page.sums(x) for x in (weight, heads, titles, count))
    back = {n for n in set(page.aside) if n >= 0 and count[n] >= 3 and weight[n] >= share * weight[0] > 0 and heads[n] == heads[0]
            and (titles[n] == titles[0] or weight[n] >= 0.95 * weight[0])}

    def shown(n: int) -> bool:
        n = page.aside[n]
        while n in back:
            n = page.aside[page.parent[n]]
        return n < 0
    return [(b, t) for b, t in found if shown(b.owner)]


def _link_lists(page: PageParser, found: list[tuple[Block, str]], limit: float) -> set[int]:
    """Indices of blocks of mostly link text that are navigation: all items
    of a list of links, runs of such blocks, and any that is no paragraph."""
    full = [page.tags[b.owner] not in HEADINGS and min(b.linked, len(t)) > limit * len(t) for b, t in found]
    lists: dict[int, list[int]] = defaultdict(list)
    for i, (b, _) in enumerate(found):
        if page.tags[b.owner] in ("li", "dd", "dt"):
            lists[page.parent[b.owner]].append(i)
    out = {i for items in lists.values() if 2 * sum(full[j] for j in items) > len(items) for i in items if full[i]}
    listed = {i for items in lists.values() for i in items}
    for i, f in enumerate(full):
        if f and i not in listed:
            run = i and full[i - 1] or i + 1 < len(full) and full[i + 1]
            if run or page.tags[found[i][0].owner] != "p":
                out.add(i)
    return out


def main_text(html: str | None, share: float = 0.5, most: float = 0.7, link_limit: float = 0.6) -> tuple[str, int]:
    """Article text of a page and its number of blocks."""
    if not html:
        return "", 0
    page = PageParser()
    last = html.rfind("<")  # a tag that the page breaks off in is no text
    if last >= 0 and html[last + 1:last + 2] in _TAG_START and ">" not in html[last:]:
        html = html[:last]
    page.feed(html)
    page.close()
    found = [(b, _SPACE.sub(" ", "".join(b.parts)).strip()) for b in page.blocks]
    found = _not_aside(page, [(b, t) for b, t in found if t], 0.8)
    if not found:
        return "", 0
    tags, texts = page.tags, [t for _, t in found]
    score = content_scores(texts, [page.path[b.owner] for b, _ in found], [b.linked for b, _ in found])
    content = score >= share * score.std()
    weigh = np.array([len(t) for t in texts], float) * np.minimum(1.0, score / max(score.max(), 1e-9))
    weight: dict[int, float] = defaultdict(float)
    for (b, _), w, c in zip(found, weigh, content):
        if c:
            weight[b.owner] += w
    mass = page.sums(weight)
    everything = weigh[content].sum()
    # the deepest element with most of the content; an article that has half of it wins
    root = None
    held = [n for n in range(1, len(tags)) if mass[n] > 0]
    named = [n for n in held if tags[n] in ("article", "main") and mass[n] >= 0.5 * everything]
    deep = [n for n in held if tags[n] not in LEAF and mass[n] >= most * everything]
    if named or deep:
        root = max(named or deep)
    paths = defaultdict(list)
    for (b, _), c in zip(found, content):
        paths[page.path[b.owner]].append(c)
    chosen = {p for p, cs in paths.items() if 2 * sum(cs) >= len(cs)}
    holders = {page.holder[b.owner] for b, _ in found if page.path[b.owner] in chosen}
    links = _link_lists(page, found, link_limit)
    out, title, begun = [], None, False
    for i, (b, t) in enumerate(found):
        if i in links:
            continue
        tag, holder = tags[b.owner], page.holder[b.owner]
        if root is not None and not page.inside(b.owner, root):
            if tag == "h1" and not begun and 0 <= holder < root and page.inside(root, holder):
                title = t  # the headline stands beside the element of the text
            continue
        begun = True
        if named or page.path[b.owner] in chosen or tag in LEAF and holder in holders:
            if tag == "h1":
                title = None
            out.append(t)
    if title and out:
        out.insert(0, title)
    return "\n\n".join(out), len(out)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = [main_text(x.as_py()) for x in b.column(2)]
        texts = [t for t, _ in rows]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()),
             pa.array([n for _, n in rows], pa.int64())], names=["page_id", "url", "text", "n_chars", "n_blocks"])


def extract(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text``, ``n_chars`` (code points) and
    ``n_blocks`` of every row of ``pages``.

    A null or empty html, or a page without article text, gives the empty
    text.  Equal rows give equal results; further columns are not read."""
    prepare(pages.sparkSession)
    return pages.select("page_id", "url", "html").mapInArrow(
        _extract, "page_id bigint, url string, text string, n_chars bigint, n_blocks bigint")
