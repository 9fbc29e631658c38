"""Main text of web pages by a graphical model on the DOM tree.

Every element is a node that is main text or not; what a node looks like gives its own potential, and parent and child
share a potential that depends on the kind of child. Sum-product messages, upward and then downward, give each node's
exact marginal; text of nodes whose marginal is a half or more is kept. All trees of a batch are passed at once, level
by level. Potentials are trained from marked pages by gradient ascent on the exact log likelihood: counts in the marked
trees minus the counts the marginals expect.

Text: character references are decoded, white space within a block is one space, blocks are trimmed and joined in page
order by two line ends. Scripts, styles, templates, frames, titles and the head are no text. A head without an end tag
ends before the first element or text that cannot stand in it. Formulas, drawings and what stands in for an object, a
canvas, a medium or a script that does not run are text like any other: what is inside math or svg goes with the element
around it and breaks no block, also the annotations of a formula.

Defined results: null and empty pages, and pages without main text, give an empty text and 0 characters; broken and cut
off markup is read as far as it goes; repeated rows give equal results; other columns pass through, one that has the name
of a result column is replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from kpiloom.llm.html_pages import marked_pages

TRAIN_PAGES, TRAIN_STEPS, SEED = 1000, 200, 1
MARK = "data-boilerplate"

# Elements of HTML by their role.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
NO_TEXT = set("script style template head title iframe".split())
#: What can stand in a head; anything else ends it.
HEAD_ONLY = set("title meta link base style script noscript template".split())
#: Content of another language, and elements around a text that stands in for something; they stand within a line.
FOREIGN, FALLBACK = {"math", "svg"}, set("object canvas audio video noscript".split())
#: Foreign elements that are set apart from the text before them.
APART = {"text", "mtd"}
INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
CLOSED_BY_BLOCK = {"p"}
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"tr", "td", "th", "thead"}, "tfoot": {"tr", "td", "th", "tbody"}}
SCOPES = {"ul", "ol", "dl", "table", "td", "th", "div", "article", "section", "main", "body", "html", "nav", "aside", "header", "footer", "form", "select", "blockquote", "object"}
TAGS = "html body article main section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table tbody tr td th blockquote pre figure figcaption nav header footer aside form fieldset button textarea select option a span label details summary address hr dialog".split()
WORDS = {
    "content": "article content post entry story main text prose blog body",
    "ad": "ad ads advert advertisement advertising adsbox adslot banner sponsor sponsored promo promotion promoted",
    "menu": "nav navbar menu navigation breadcrumb breadcrumbs pagination pager toolbar topnav skip links",
    "header": "header masthead topbar branding logo",
    "footer": "footer copyright colophon bottom legal",
    "side": "sidebar side widget widgets rail aside related recommended popular trending more",
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe signup disclaimer privacy",
    "comments": "comment comments discussion responses replies reply disqus respond reader",
    "share": "share social sharing follow",
    "form": "search login form feedback contact",
}
_CATEGORY = {w: k for k, ws in WORDS.items() for w in ws.split()}
#: A tag that the page's end cuts off.
_CUT_TAG = re.compile(r"<[a-zA-Z/!?][^<>]*\Z")
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
KINDS = ("container", "text", "heading", "item", "inline", "other")
_KIND = {**dict.fromkeys("div section article main body html header footer nav aside form table tbody ul ol dl".split(), 0), **dict.fromkeys("p blockquote pre td figcaption".split(), 1), **dict.fromkeys("h1 h2 h3 h4 h5 h6".split(), 2), **dict.fromkeys("li dt dd tr th option".split(), 3), **dict.fromkeys(INLINE, 4)}


class Tree(HTMLParser):
    """Elements with parent, depth, tag, names, mark and lengths of their own text; and the pieces of text by block."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.parent, self.tag, self.names, self.marked, self.text, self.linked, self.hidden = [], [], [], [], [], [], []
        self.pieces: list[tuple[int, int, str]] = []
        self.stack: list[tuple[str, int, bool]] = []  # tag, node, whether it stands within a line
        self.block, self.mute, self.link, self.foreign = 0, 0, 0, 0
        self._node("html", [])
        self.feed(_CUT_TAG.sub("", html))
        self.close()

    def _node(self, tag: str, attrs, within: bool = False) -> int:
        at = {k: v or "" for k, v in attrs}
        above = self.stack[-1][1] if self.stack else -1
        self.parent.append(above)
        self.tag.append(tag)
        self.names.append({_CATEGORY[t] for t in (w.lower() for w in _TOKEN.findall(f"{at.get('class', '')} {at.get('id', '')} {at.get('role', '')}")) if t in _CATEGORY})
        self.marked.append(MARK in at or (above >= 0 and self.marked[above]))
        self.hidden.append("hidden" in at or at.get("aria-hidden") == "true" or "display:none" in at.get("style", "").replace(" ", "").lower())
        self.text.append(0)
        self.linked.append(0)
        self.stack.append((tag, len(self.parent) - 1, within))
        return len(self.parent) - 1

    def _pop(self, to: int) -> None:
        for tag, _, within in self.stack[to:]:
            self.link -= tag == "a"
            self.mute -= tag in NO_TEXT
            self.foreign -= tag in FOREIGN
            if not within:
                self.block += 1
        del self.stack[to:]

    def handle_starttag(self, tag, attrs):
        if tag == "html":
            return
        if tag == "body" and self.mute:
            self._pop(1)
        if tag not in HEAD_ONLY:
            self._end_head()
        if self.foreign and tag in TAGS and tag not in INLINE:
            self._leave_foreign()
        part = self.foreign > 0 and tag not in TAGS
        within = part or tag in INLINE or tag in FOREIGN or tag in FALLBACK
        if not within:
            self.block += 1
            if tag not in NO_TEXT and tag not in VOID:
                self._close_nearest(CLOSED_BY_BLOCK)
        if tag in CLOSES:
            self._close_nearest(CLOSES[tag])
        if tag in VOID:
            if tag == "br":
                self.handle_data(" ")
            return
        if part or (within and not any(k in ("class", "id", "role", "hidden", "style", MARK) for k, _ in attrs)):
            # a plain inline element belongs to the element around it
            self.stack.append((tag, self.stack[-1][1], True))
        else:
            self._node(tag, attrs, within)
        if part and tag in APART:
            self.handle_data(" ")
        self.link += tag == "a"
        self.mute += tag in NO_TEXT
        self.foreign += tag in FOREIGN

    def _end_head(self) -> None:
        """Ends a head that is the innermost open element."""
        if self.stack[-1][0] == "head":
            self._pop(len(self.stack) - 1)

    def _leave_foreign(self) -> None:
        """Ends foreign content at an element of HTML, unless that stands where HTML may stand in it."""
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i][0] in ("foreignobject", "annotation-xml", "desc", "mtext") or not self.stack[i][2]:
                return
            if self.stack[i][0] in FOREIGN:
                self._pop(i)
                return

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def _close_nearest(self, tags: set[str]) -> None:
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i][0] in tags:
                self._pop(i)
                if tags is CLOSED_BY_BLOCK:
                    return
            elif self.stack[i][0] in SCOPES and self.stack[i][0] not in tags:
                return

    def handle_endtag(self, tag):
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i][0] == tag:
                self._pop(i)
                return
            if tag in INLINE and not self.stack[i][2]:
                return
        if tag not in INLINE:
            self.block += 1

    def handle_data(self, data):
        if self.mute and data.strip():
            self._end_head()
        if self.mute or not data:
            return
        owner = self.stack[-1][1]
        self.pieces.append((self.block, owner, data))
        n = len(data.strip())
        self.text[owner] += n
        self.linked[owner] += n if self.link else 0

    def depths(self) -> np.ndarray:
        depth = np.zeros(len(self.parent), np.int64)
        for i, p in enumerate(self.parent):
            depth[i] = depth[p] + 1 if p >= 0 else 0
        return depth

    def extracted(self, keep: np.ndarray) -> str:
        blocks, last, parts = [], None, []
        for block, owner, data in self.pieces:
            if block != last and parts:
                blocks.append("".join(parts))
                parts = []
            last = block
            if keep[owner]:
                parts.append(data)
        blocks.append("".join(parts))
        return "\n\n".join(b for b in (" ".join(b.split()) for b in blocks) if b)


def _vocabulary() -> dict[str, int]:
    names = [f"tag:{t}" for t in TAGS] + ["tag:?", "bias", "hidden", "inside", "outside", "no article", "linked", "half linked", "unlinked"]
    names += [f"name:{k}" for k in WORDS] + [f"name:{k} inside" for k in WORDS] + [f"tag:{t} inside" for t in ("header", "footer", "aside", "nav", "form", "div", "section", "article")]
    names += [f"length:{i}" for i in range(5)] + [f"{t} around" for t in ("nav", "aside", "footer", "header", "form", "comments", "ad")]
    return {n: i for i, n in enumerate(names)}


FEATURES = _vocabulary()


def features(tree: Tree) -> list[list[int]]:
    """The features of every node, by number."""
    f, out = FEATURES, []
    main = [t in ("article", "main") or "content" in n for t, n in zip(tree.tag, tree.names, strict=True)]
    any_main = any(t in ("article", "main") for t in tree.tag)
    inside: list[bool] = []
    for i, (tag, names) in enumerate(zip(tree.tag, tree.names, strict=True)):
        above = tree.parent[i]
        within = above >= 0 and (inside[above] or main[above])
        inside.append(within)
        own = [f["bias"], f.get(f"tag:{tag}", f["tag:?"])]
        own.append(f["inside"] if within or main[i] else f["outside"] if any_main else f["no article"])
        own += [f[f"name:{k}"] for k in names]
        if within:
            own += [f[f"name:{k} inside"] for k in names]
            if f"tag:{tag} inside" in f:
                own.append(f[f"tag:{tag} inside"])
        if tree.hidden[i]:
            own.append(f["hidden"])
        n, linked = tree.text[i], tree.linked[i]
        own.append(f[f"length:{0 if n == 0 else 1 if n < 25 else 2 if n < 100 else 3 if n < 300 else 4}"])
        if n:
            own.append(f["linked"] if linked > 0.8 * n else f["half linked"] if linked > 0.3 * n else f["unlinked"])
        if above >= 0:
            if tree.tag[above] in ("nav", "aside", "footer", "header", "form"):
                own.append(f[f"{tree.tag[above]} around"])
            own += [f[f"{k} around"] for k in ("comments", "ad") if k in tree.names[above]]
        out.append(own)
    return out


class Forest:
    """Trees side by side: nodes in one numbering, parents, levels and sparse features."""

    def __init__(self, trees: list[Tree]):
        sizes = [len(t.parent) for t in trees]
        self.first = np.cumsum([0, *sizes])
        shift = np.repeat(self.first[:-1], sizes)
        parent = np.concatenate([np.array(t.parent, np.int64) for t in trees])
        self.parent = np.where(parent >= 0, parent + shift, -1)
        depth = np.concatenate([t.depths() for t in trees])
        self.kind = np.array([_KIND.get(tag, 5) for t in trees for tag in t.tag])
        active = [own for t in trees for own in features(t)]
        self.row = np.repeat(np.arange(len(active)), [len(a) for a in active])
        self.column = np.array([c for a in active for c in a], np.int64)
        self.label = np.array([not m for t in trees for m in t.marked], np.int64)
        self.levels = [np.flatnonzero(depth == d) for d in range(int(depth.max()) + 1)]


@dataclass
class TreeModel:
    """own: a weight per feature for being main text; pair: log potentials by kind of child, parent's and child's state."""

    own: np.ndarray
    pair: np.ndarray

    def passed(self, forest: Forest) -> tuple[np.ndarray, np.ndarray, float]:
        """Marginals of nodes, of (parent, child) pairs, and the log of the partition functions, by two sweeps."""
        n = forest.parent.size
        unary = np.zeros((n, 2))
        unary[:, 1] = np.bincount(forest.row, self.own[forest.column], n)
        below, up = unary.copy(), np.zeros((n, 2))
        pair = self.pair[forest.kind]
        for level in reversed(forest.levels[1:]):
            up[level] = np.logaddexp.reduce(below[level][:, None, :] + pair[level], axis=2)
            np.add.at(below, forest.parent[level], up[level])
        whole = below.copy()
        total = float(np.logaddexp.reduce(below[forest.levels[0]], axis=1).sum())
        both = np.zeros((n, 2, 2))
        for level in forest.levels[1:]:
            rest = whole[forest.parent[level]] - up[level]
            joint = rest[:, :, None] + pair[level]
            whole[level] = below[level] + np.logaddexp.reduce(joint, axis=1)
            joint = joint + below[level][:, None, :]
            joint -= joint.max(axis=(1, 2), keepdims=True)
            np.exp(joint, out=joint)
            both[level] = joint / joint.sum(axis=(1, 2), keepdims=True)
        whole -= whole.max(axis=1, keepdims=True)
        single = np.exp(whole)
        return single / single.sum(axis=1, keepdims=True), both, total

    def score(self, forest: Forest) -> float:
        """Log score of the marked states."""
        child = np.flatnonzero(forest.parent >= 0)
        y = forest.label
        unary = np.bincount(forest.row, self.own[forest.column], y.size)
        return float((unary * y).sum() + self.pair[forest.kind[child], y[forest.parent[child]], y[child]].sum())


def fit(pages: list[str], steps: int = TRAIN_STEPS, rate: float = 0.1, penalty: float = 2e-4) -> TreeModel:
    """Potentials from marked pages."""
    forest = Forest([Tree(p) for p in pages])
    model = TreeModel(np.zeros(len(FEATURES)), np.zeros((len(KINDS), 2, 2)))
    child = np.flatnonzero(forest.parent >= 0)
    y, scale = forest.label, 1.0 / forest.label.size
    seen_pair = np.zeros_like(model.pair)
    np.add.at(seen_pair, (forest.kind[child], y[forest.parent[child]], y[child]), 1.0)
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in (model.own, model.pair)]
    for t in range(1, steps + 1):
        single, both, _ = model.passed(forest)
        own = np.bincount(forest.column, (y - single[:, 1])[forest.row], len(FEATURES)) * scale - penalty * model.own
        expected = np.zeros_like(model.pair)
        np.add.at(expected, forest.kind[child], both[child])
        gradients = (own, (seen_pair - expected) * scale - penalty * model.pair)
        for p, g, m in zip((model.own, model.pair), gradients, moments, strict=True):
            m[0] += 0.1 * (g - m[0])
            m[1] += 0.01 * (g * g - m[1])
            p += rate * (m[0] / (1 - 0.9**t)) / (np.sqrt(m[1] / (1 - 0.99**t)) + 1e-8)
    return model


def default_model() -> TreeModel:
    return fit(marked_pages(TRAIN_PAGES, SEED))


def main_texts(model: TreeModel, pages: list[str | None]) -> list[str]:
    trees = [Tree(p) if p else None for p in pages]
    there = [t for t in trees if t is not None]
    if not there:
        return [""] * len(pages)
    forest = Forest(there)
    keep = model.passed(forest)[0][:, 1] >= 0.5
    found = iter([t.extracted(keep[a:b]) for t, a, b in zip(there, forest.first[:-1], forest.first[1:], strict=True)])
    return [next(found) if t is not None else "" for t in trees]


def extracted(pages: DataFrame, model: TreeModel) -> DataFrame:
    """Each row with text and n_chars. Pages are read from the column html, which is left out of the result."""
    kept = [c for c in pages.columns if c not in ("html", "text", "n_chars")]
    rows = pages.select(*kept, "html")
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "html"), "text string", "n_chars long"])

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = main_texts(model, part.column("html").to_pylist())
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], [*kept, "text", "n_chars"])

    return rows.mapInArrow(extract, schema)
