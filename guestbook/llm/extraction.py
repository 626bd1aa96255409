"""Main text of web pages by a tree-structured graphical model.

Block elements and runs of text are the nodes of a tree, each main text or not. A node's own potential comes from its
tag, class names and the text under it, by logistic regression on labelled nodes; a potential for each pair of parent and
child says how often labels go together. On a tree, sum-product messages passed up from the leaves and down from
the root give exact marginals, and runs of text whose marginal favours main text are put out.

Pages are independent: they are read, scored and written where they lie.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from guestbook.llm.common import rows_of
from guestbook.llm.html_pages import labelled_pages

#: Pages of the corpus that are labelled by their own <article> or <main> and trained on, at most.
SAMPLE = 400
STEPS = 30
RIDGE = 1.0

_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))"
    r"|<(?P<raw>script|style|textarea|title|iframe)(?=[\s/>])[^>]*+>.*?(?:</(?P=raw)(?=[\s/>])[^>]*+>|\Z)"
    r"""|<(?P<end>/?)(?P<tag>[a-zA-Z][\w:-]*+)(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][\w:-]*+)(?P<attrs2>[^>]*+)>"
    r"|<[!?/][^>]*+>"
    r"|(?P<text>[^<]++|<)",
    re.S | re.I,
)
#: Elements left out up to their end tags; without one only the tag is left out, so that no text is lost.
_APART = {
    tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*+>", re.I) for tag in ("noscript", "template", "svg", "select", "object")
}
_ATTRIBUTE = re.compile(r"""([\w-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_SPACE = re.compile(r"\s+")

GROUPS = {
    "main": "article main",
    "para": "p blockquote pre figure figcaption dl dt dd address",
    "heading": "h1 h2 h3 h4 h5 h6 hgroup",
    "list": "ul ol menu",
    "item": "li",
    "table": "table thead tbody tfoot tr caption",
    "cell": "td th",
    "box": "div section center details summary",
    "nav": "nav",
    "header": "header",
    "footer": "footer",
    "aside": "aside dialog",
    "form": "form fieldset button label legend",
    "body": "html body head",
}
_GROUP = {tag: i for i, tags in enumerate(GROUPS.values()) for tag in tags.split()}
_TEXT = len(GROUPS)
_BREAKS = {"br", "hr", "img", "input", "video", "audio", "canvas", "embed"}
#: An opening tag ends an open element of these, up to the container that holds them.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
}
_AWAY = [_GROUP[tag] for tag in ("nav", "header", "footer", "aside", "form")]
#: Parts of class names, ids and roles, by what they speak for.
NAMES = {
    "text": "article content post entry main story body text",
    "menu": "nav navbar topnav navigation menu menus breadcrumb breadcrumbs header topbar footer bottom links toolbar pagination pager skip tabs",
    "side": "sidebar aside related recommended widget widgets promo more trending popular tags tag share social",
    "advert": "ad ads advert adverts advertisement sponsor sponsored banner promoted",
    "comment": "comment comments reply replies disqus discussion respond feedback",
    "notice": "cookie cookies consent gdpr notice popup modal alert overlay subscribe newsletter signup login search form copyright legal disclaimer",
}
_NAME = {word: i for i, words in enumerate(NAMES.values()) for word in words.split()}
_HIDDEN = re.compile(r"\bhidden\b|display\s*:\s*none|aria-hidden\s*=\s*.?true", re.I)
_PART = re.compile(r"[a-z]+")
#: Tag and names of a node, names of the nodes above it, and what stands under it.
N_FEATURES = _TEXT + 1 + 2 * len(NAMES) + 10


@dataclass
class Page:
    """Nodes of a page in page order: a parent stands before its children."""

    parent: list[int] = field(default_factory=list)
    group: list[int] = field(default_factory=list)
    names: list[tuple[int, ...]] = field(default_factory=list)
    hidden: list[bool] = field(default_factory=list)
    words: list[int] = field(default_factory=list)
    linked: list[int] = field(default_factory=list)
    stops: list[int] = field(default_factory=list)
    runs: list[tuple[int, str]] = field(default_factory=list)
    marks: list[str | None] = field(default_factory=list)

    def add(self, parent: int, group: int, attrs: str = "", words: int = 0, linked: int = 0, stops: int = 0) -> int:
        names: set[int] = set()
        mark = None
        if attrs and "=" in attrs:
            for name, *values in _ATTRIBUTE.findall(attrs):
                name = name.lower()
                if name in ("class", "id", "role"):
                    names.update(_NAME[x] for x in _PART.findall("".join(values).lower()) if x in _NAME)
                elif name == "main":
                    mark = "".join(values)
        self.parent.append(parent)
        self.group.append(group)
        self.names.append(tuple(names))
        self.hidden.append(bool(attrs) and _HIDDEN.search(attrs) is not None)
        self.words.append(words)
        self.linked.append(linked)
        self.stops.append(stops)
        self.marks.append(mark)
        return len(self.parent) - 1


def _tokens(source: str) -> Iterator[re.Match[str]]:
    at = 0
    unclosed: set[str] = set()  # names without an end tag in what is left
    last = source.rfind(">")  # behind it nothing is markup but a comment that isn't closed
    while at < len(source):
        alone = at > last and source[at] == "<" and not source.startswith("<!--", at)
        token = _TOKEN.match(source, at, at + 1 if alone else len(source))
        at = token.end()
        tag = (token["tag"] or token["tag2"] or "").lower()
        if tag not in _APART or token["end"] or token["end2"] or tag in unclosed:
            yield token
        elif tag == "svg" and (token["attrs"] or token["attrs2"] or "").endswith("/"):
            yield token
        elif close := _APART[tag].search(source, at):
            at = close.end()
        else:
            unclosed.add(tag)
            yield token


def parse(source: str | None) -> Page:
    """Scripts, styles, form choices and markup are left out; character references are decoded, white space is one space."""
    page = Page()
    stack = [page.add(-1, _GROUP["body"])]
    names: list[str] = ["html"]
    places: dict[str, list[int]] = {}  # where elements of a name are open
    texts: list[tuple[str, bool]] = []
    anchors = 0

    def nearest(tags: Iterable[str]) -> int:
        return max((places[t][-1] for t in tags if places.get(t)), default=0)

    def close(at: int) -> None:
        while len(stack) > at:
            stack.pop()
            places[names.pop()].pop()

    def flush() -> None:
        if not texts:
            return
        text = _SPACE.sub(" ", "".join(t for t, _ in texts)).strip()
        if text:
            words = text.count(" ") + 1
            linked = min(words, sum(len(t.split()) for t, a in texts if a))
            stops = text.count(".") + text.count(",")
            page.runs.append((page.add(stack[-1], _TEXT, "", words, linked, stops), text))
        texts.clear()

    for token in _tokens(source or ""):
        text = token["text"]
        if text is not None:
            texts.append((html.unescape(text), anchors > 0))
            continue
        tag = token["tag"] or token["tag2"]
        if tag is None:
            continue
        tag, ends = tag.lower(), token["end"] or token["end2"]
        if tag == "a":
            anchors = 0 if ends else 1
        elif tag in _BREAKS:
            texts.append((" ", False))
        elif tag in _GROUP:
            flush()
            if ends:
                if at := nearest([tag]):
                    close(at)
                    anchors = 0
                continue
            if tag in ("html", "body", "head"):
                continue
            if names[-1] == "p":
                close(len(stack) - 1)
            if tag in _ENDS:
                same, within = map(nearest, _ENDS[tag])
                if same > within:
                    close(same)
            places.setdefault(tag, []).append(len(stack))
            stack.append(page.add(stack[-1], _GROUP[tag], token["attrs"] or token["attrs2"] or ""))
            names.append(tag)
    flush()
    return page


def features(page: Page) -> np.ndarray:
    n = len(page.parent)
    words, linked, stops = page.words[:], page.linked[:], page.stops[:]
    for i in range(n - 1, 0, -1):
        p = page.parent[i]
        words[p] += words[i]
        linked[p] += linked[i]
        stops[p] += stops[i]
    x = np.zeros((n, N_FEATURES))
    x[np.arange(n), page.group] = 1
    above: list[tuple[int, ...]] = []
    for i, names in enumerate(page.names):
        p = page.parent[i]
        above.append(tuple({*above[p], *page.names[p]}) if i and (above[p] or page.names[p]) else ())
        for name in names:
            x[i, _TEXT + 1 + name] = 1
        for name in above[i]:
            x[i, _TEXT + 1 + len(NAMES) + name] = 1
    at = _TEXT + 1 + 2 * len(NAMES)
    x[:, at] = page.hidden
    w = np.array(words, float)
    share = np.array(linked) / np.maximum(w, 1)
    parent = np.maximum(page.parent, 0)
    leaf = np.array(page.group) == _TEXT
    x[:, at + 1] = np.log1p(w) / 3
    x[:, at + 2] = share
    x[:, at + 3] = np.minimum(1, 4 * np.array(stops) / np.maximum(w, 1))
    x[:, at + 4] = w >= 12
    x[:, at + 5] = w <= 3
    x[:, at + 6] = w / max(1, words[0])
    x[:, at + 7] = leaf * (np.array(page.group)[parent] == _GROUP["p"])
    x[:, at + 8] = leaf * (np.array(page.group)[parent] == _GROUP["h1"])
    away = np.isin(page.group, _AWAY)
    for i in range(1, n):
        away[i] |= away[parent[i]]
    x[:, at + 9] = away
    return x


def labels(page: Page, corpus: bool = False) -> np.ndarray:
    """By the nearest mark above; on pages of the corpus by <article> and <main>. Elements go with most words under them."""
    n = len(page.parent)
    own = np.zeros(n)
    for i in range(1, n):
        if corpus:
            group = page.group[i]
            own[i] = 1 if group == _GROUP["article"] else 0 if group in _AWAY else own[page.parent[i]]
        else:
            mark = page.marks[i]
            own[i] = own[page.parent[i]] if mark is None else float(mark == "1")
    words, kept = np.array(page.words, float), np.array(page.words) * own
    for i in range(n - 1, 0, -1):
        words[page.parent[i]] += words[i]
        kept[page.parent[i]] += kept[i]
    out = np.where(words > 0, kept * 2 > words, own > 0).astype(float)
    out[0] = 1.0 if kept[0] > 0 else 0.0
    return out


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    #: Logarithms for labels (parent, child): 00, 01, 10, 11.
    edges: tuple[float, float, float, float]

    def marginals(self, page: Page) -> list[float]:
        """Log odds of main text for every node."""
        own = (np.hstack([features(page), np.ones((len(page.parent), 1))]) @ self.weights).clip(-30, 30).tolist()
        e00, e01, e10, e11 = map(math.exp, self.edges)
        exp, log, parent, n = math.exp, math.log, page.parent, len(own)
        belief, up = own[:], [0.0] * n
        for i in range(n - 1, 0, -1):  # from the leaves to the root
            odds = exp(min(belief[i], 500.0))
            up[i] = log((e10 + e11 * odds) / (e00 + e01 * odds))
            belief[parent[i]] += up[i]
        for i in range(1, n):  # and back
            odds = exp(max(-500.0, min(500.0, belief[parent[i]] - up[i])))
            belief[i] += log((e01 + e11 * odds) / (e00 + e10 * odds))
        return belief

    def text(self, source: str | None) -> str:
        page = parse(source)
        if not page.runs:
            return ""
        belief = self.marginals(page)
        return "\n\n".join(text for node, text in page.runs if belief[node] > 0)


def train(pages: list[tuple[Page, np.ndarray]]) -> Model:
    """Node potentials by penalised logistic regression, pair potentials from the labels' joint counts."""
    x = np.vstack([np.hstack([features(p), np.ones((len(p.parent), 1))]) for p, _ in pages])
    y = np.concatenate([label for _, label in pages])
    weights = np.zeros(x.shape[1])
    for _ in range(STEPS):
        chance = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (y - chance) - RIDGE * weights
        curve = (x * (chance * (1 - chance))[:, None]).T @ x + RIDGE * np.eye(x.shape[1])
        step = np.linalg.solve(curve, slope)
        weights += step
        if np.abs(step).max() < 1e-6:
            break
    counts = np.ones((2, 2))
    for page, label in pages:
        child = np.arange(1, len(page.parent))
        np.add.at(counts, (label[np.array(page.parent)[1:]].astype(int), label[child].astype(int)), 1)
    joint = counts / counts.sum()
    edges = np.log(joint / np.outer(joint.sum(1), joint.sum(0)))
    return Model(weights, tuple(edges.ravel().tolist()))


def fit(pages: DataFrame, sample: int = SAMPLE) -> Model:
    """From the layouts of :mod:`guestbook.llm.html_pages`, and at most ``sample`` pages of the corpus that mark their article."""
    trained = [(page, labels(page)) for page in map(parse, labelled_pages())]
    if sample:
        marked = pages.where(F.col("html").rlike("(?i)<(article|main)[ >]") & (F.length("html") < 100_000))
        rows = marked.select("html").orderBy(F.xxhash64("html")).limit(sample).collect()
        trained += [(page, labels(page, corpus=True)) for page in (parse(r["html"]) for r in rows)]
    return train(trained)


def extract(pages: DataFrame, model: Model | None = None) -> DataFrame:
    """``page_id, url, text``: the main text of every page, its blocks in page order with an empty line between.

    Null and empty pages, and pages without main text, have an empty text. Rows that repeat are put out as often;
    an empty table gives no rows.
    """
    model = model or fit(pages)

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [model.text(source) for (source,) in rows_of([batch], "html")]
            yield pd.DataFrame({"page_id": batch["page_id"], "url": batch["url"], "text": texts})

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInPandas(rows, f"page_id {kind}, url string, text string")
