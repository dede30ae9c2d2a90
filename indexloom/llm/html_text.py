"""Main text of web pages by a tree-structured graphical model of their elements.

Each element is content or not. Its own evidence (tag, words of class, id and role, text length, share of text in
links) gives a unary potential, and each edge a parent-child potential; both are counted from labelled pages with
smoothing. Sum-product messages go up from the leaves and down from the root, which gives each element's exact
marginal. Text whose element is more likely content than not is kept.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from indexloom.llm.common import append, held, packed
from indexloom.llm.html_training import PAGES

# Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul".split())
#: An opening tag ends an open element of these, up to the nearest of the limits.
SIBLINGS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}
#: Elements that part no words, as they are shown in a line or not at all.
PHRASING = INLINE | RAW - {"xmp"} | frozenset("area audio button canvas embed input label link map meta meter object output param picture progress select source svg track video".split())
#: Text that no reader sees or that is a control; it is never content.
HIDDEN = RAW | frozenset("head button select option input".split())

#: Elements that running text is made of, and those that mark an article.
FLOW = INLINE - {"a"} | frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre".split())
MARKED = frozenset({"article", "main"})

SHARED = 0.4

#: Attributes as the standard reads them: a quote opens a value only directly after "="; any other is a character of a name or value.
_NAME = r"[^ \t\n\f\r/>][^ \t\n\f\r/>=]*+"
_VALUE = r"[ \t\n\f\r]*+=[ \t\n\f\r]*+(?:\"([^\"]*+)\"?+|'([^']*+)'?+|([^ \t\n\f\r>\"'][^ \t\n\f\r>]*+))?+"
_ATTRIBUTE = re.compile(rf"({_NAME})(?:{_VALUE})?+")
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</?([a-zA-Z][^ \t\n\f\r/>]*+)"
    rf"((?:[ \t\n\f\r/]++|{_NAME}(?:{re.sub(r'[(](?=[^?])', '(?:', _VALUE)})?+)*+)(?:>|\Z)",
    re.S,
)
#: Searched in the page itself: lower-casing moves places, as U+0130 becomes two characters.
_RAW_END = {tag: re.compile(rf"</{tag}(?=[ \t\n\f\r/>])", re.I | re.A) for tag in RAW}
_PART = re.compile(r"[a-z]+")


@dataclass
class Page:
    """Elements in page order, with their parents, and runs of text with the element that holds them."""

    tags: list[str] = field(default_factory=lambda: ["#root"])
    words: list[str] = field(default_factory=lambda: [""])
    attributes: list[str] = field(default_factory=lambda: [""])
    parents: list[int] = field(default_factory=lambda: [-1])
    #: (element, block, text)
    runs: list[tuple[int, int, str]] = field(default_factory=list)


def parse(html: str) -> Page:
    """The elements of a page; unclosed and stray tags are mended as the standard says, in one pass."""
    page, stack, block, at = Page(), [0], 0, 0
    depths: dict[str, list[int]] = {}  # places in the stack of the open elements of each name

    def text(s: str) -> None:
        if s:
            page.runs.append((stack[-1], block, unescape(s)))

    def pop_to(names, limits=frozenset()) -> None:
        depth = max((depths[n][-1] for n in names if depths.get(n)), default=0)
        if depth > max((depths[n][-1] for n in limits if depths.get(n)), default=0):
            while len(stack) > depth:
                depths[page.tags[stack.pop()]].pop()

    while (start := html.find("<", at)) >= 0:
        m = _TOKEN.match(html, start)
        if not m:
            text(html[at : start + 1])
            at = start + 1
            continue
        text(html[at:start])
        at = m.end()
        if m[1] is None:
            continue
        tag = m[1].lower()
        if tag not in PHRASING:
            block += 1
        if html[start + 1] == "/":
            pop_to({tag})
            continue
        if tag in CLOSES_P:
            pop_to({"p"}, {"table", "td", "th", "button", "object"})
        if tag in SIBLINGS:
            pop_to(*SIBLINGS[tag])
        page.tags.append(tag)
        page.parents.append(stack[-1])
        page.attributes.append(m[2])
        page.words.append(" ".join((a or b or c).lower() for name, a, b, c in _ATTRIBUTE.findall(m[2]) if name.lower() in ("class", "id", "role")) if m[2] else "")
        if tag in VOID:
            continue
        depths.setdefault(tag, []).append(len(stack))
        stack.append(len(page.tags) - 1)
        if tag in RAW:
            closed = _RAW_END[tag].search(html, at)
            end = closed.start() if closed else len(html)
            text(html[at:end])
            at = end
    text(html[at:])
    return page


def with_body(page: Page) -> Page:
    """A page without a body gets the one that the standard implies: below ``html`` or the root, around all but the head."""
    if "body" in page.tags:
        return page
    top = page.tags.index("html") if "html" in page.tags else 0
    body = top + 1
    moved = lambda i, own: body if i == top and own else i + (i > top)
    parents = [moved(p, tag not in ("head", "html")) for p, tag in zip(page.parents, page.tags, strict=True)]
    for column, value in ((page.tags, "body"), (page.words, ""), (page.attributes, ""), (parents, top)):
        column.insert(body, value)
    page.parents, page.runs = parents, [(moved(e, True), block, text) for e, block, text in page.runs]
    return page


def features(page: Page) -> list[list[str]]:
    """The evidence of each element: its own names, what its own and inner text looks like, and its place in the page.

    ``flow`` is the share of a body's text that it holds itself or in paragraphs, headings and the like directly below.
    ``place`` tells what lies outside the articles of a page that marks them.
    """
    n = len(page.tags)
    own, inner, linked, stops, direct = [0] * n, [0] * n, [0] * n, [0] * n, [0] * n
    for element, _, text in page.runs:
        if page.tags[element] not in HIDDEN:
            size = len(text.strip())
            own[element] += size
            inner[element] += size
            stops[element] += text.count(". ") + text.count(", ")
            if page.tags[element] == "a":
                linked[element] += size
    holds = [False] * n
    for i in range(n - 1, 0, -1):
        p = page.parents[i]
        inner[p] += inner[i]
        stops[p] += stops[i]
        linked[p] += inner[i] if page.tags[i] == "a" else linked[i]
        direct[p] += inner[i] if page.tags[i] in FLOW else 0
        holds[p] |= holds[i] or page.tags[i] in MARKED
    share = [linked[i] / inner[i] if inner[i] else 0.0 for i in range(n)]
    out, within = [], [False] * n
    for i in range(n):
        within[i] = page.tags[i] in MARKED or i > 0 and within[page.parents[i]]
        tag = re.sub(r"^h[1-6]$", "heading", page.tags[i])
        if tag in ("a", "li", "ul", "ol"):
            # A link in running text is not one of a menu, and a list of sentences is not a menu.
            tag += ":text" if share[page.parents[i] if tag == "a" else i] < 0.5 else ":menu"
        size = inner[i]
        found = [f"tag:{tag}", f"size:{min(4, len(str(size // 20)) if size >= 20 else 0)}", f"links:{0 if share[i] < 0.1 else 1 if share[i] < 0.5 else 2}", f"prose:{min(2, stops[i])}"]
        if tag == "body":
            flow = (own[i] + direct[i]) / size if size else 0.0
            found.append(f"flow:{0 if flow < 0.02 else 1 if flow < 0.3 else 2}")
        if holds[0] and not within[i] and not holds[i]:
            found.append("place:out")
        found += [f"word:{w}" for w in set(_PART.findall(page.words[i]))]
        out.append(found)
    return out


@dataclass(frozen=True)
class Model:
    """Log potentials: of each feature for content against not, of each (parent, child) pair, and of the root."""

    evidence: dict[str, float]
    edges: tuple[float, float, float, float]
    root: float


def train(pages: tuple[str, ...] = PAGES, smoothing: float = 0.1) -> Model:
    """Count potentials in pages whose content elements are marked ``data-main`` and whose other ones inside them ``data-not``."""
    seen, edges, totals = (Counter(), Counter()), Counter(), [0, 0]
    for html in pages:
        page, labels = parse(html), [0]
        for i in range(1, len(page.tags)):
            mark = page.attributes[i]
            labels.append(0 if "data-not" in mark or page.tags[i] in HIDDEN else 1 if "data-main" in mark else labels[page.parents[i]])
            edges[labels[page.parents[i]], labels[i]] += 1
        for label, found in zip(labels, features(page), strict=True):
            totals[label] += 1
            seen[label].update(found)
    names = seen[0].keys() | seen[1].keys()
    rate = lambda y, f: (seen[y][f] + smoothing) / (totals[y] + 2 * smoothing)
    # An element's text is its ancestors' text as well, so what it looks like counts for less than names do.
    evidence = {f: math.log(rate(1, f) / rate(0, f)) * (1.0 if f.startswith(("tag:", "flow:", "word:")) else SHARED) for f in names}
    pair = lambda p, c: math.log((edges[p, c] + smoothing) / (edges[p, 0] + edges[p, 1] + 2 * smoothing))
    return Model(evidence, (pair(0, 0), pair(0, 1), pair(1, 0), pair(1, 1)), -4.0)


def _log_sum(a: float, b: float) -> float:
    high, low = (a, b) if a > b else (b, a)
    return high + math.log1p(math.exp(low - high)) if low - high > -40 else high


def marginals(page: Page, model: Model) -> list[float]:
    """The probability that each element is content, by messages to the root and back."""
    n, parents = len(page.tags), page.parents
    e00, e01, e10, e11 = model.edges
    # Up: log of what an element and all below it say for each of its labels.
    zero, one, up = [0.0] * n, [0.0] * n, [(0.0, 0.0)] * n
    for i, found in enumerate(features(page)):
        one[i] = sum(model.evidence.get(f, 0.0) for f in found)
        if page.tags[i] in HIDDEN:
            one[i] = -60.0
    one[0] = model.root
    for i in range(n - 1, 0, -1):
        up[i] = (_log_sum(e00 + zero[i], e01 + one[i]), _log_sum(e10 + zero[i], e11 + one[i]))
        zero[parents[i]] += up[i][0]
        one[parents[i]] += up[i][1]
    # Down: the same of all else, given the parent's label; the parent's sum less what came from below.
    down_zero, down_one, out = [0.0] * n, [0.0] * n, [0.0] * n
    for i in range(n):
        if i:
            p = parents[i]
            rest_zero, rest_one = zero[p] + down_zero[p] - up[i][0], one[p] + down_one[p] - up[i][1]
            down_zero[i], down_one[i] = _log_sum(rest_zero + e00, rest_one + e10), _log_sum(rest_zero + e01, rest_one + e11)
        odds = one[i] + down_one[i] - zero[i] - down_zero[i]
        out[i] = 1 / (1 + math.exp(-odds)) if odds > -60 else 0.0
    return out


def main_text(html: str, model: Model, threshold: float = 0.5) -> str:
    """The content text: white space inside a block is one space, blocks are joined by one."""
    page = with_body(parse(html))
    likely = marginals(page, model)
    blocks: list[str] = []
    last = None
    for element, block, text in page.runs:
        if likely[element] > threshold:
            if block == last:
                blocks[-1] += text
            else:
                blocks.append(text)
            last = block
    return " ".join(" ".join(blocks).split())


def with_main_text(pages: DataFrame, html: str = "html", model: Model | None = None) -> DataFrame:
    """``row`` (all columns of ``pages``) and ``text``.

    Null and empty pages have an empty text, as have pages without content. Repeated pages have equal texts. Pages of
    any length are read whole in one pass. Empty tables give no rows; extra columns stay inside ``row``.
    """
    own = model or train()
    potentials = (own.evidence, own.edges, own.root)

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        known = Model(*potentials)
        return [pa.array([main_text(x, known) if x else "" for x in held(batch, html).to_pylist()], pa.string())]

    return append(packed(pages), run, "text string").select("row", "text")
