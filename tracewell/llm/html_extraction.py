"""Main text of web pages by a tree-structured graphical model.

Each block element and text leaf of a page is a binary variable: does it hold main text?  Its evidence (tag, words of
class and id, lengths, links) gives a unary potential; each child and its parent share a potential by the child's kind.
Sum-product messages upward and downward give every node's exact marginal.  The weights maximise the likelihood of
labelled pages, whose gradient needs the same marginals.  Messages of all pages of a batch go level by level in numpy.

Siblings of one tag are alike for reasons that the tree doesn't show, so scores of short paragraphs aren't scores of
independent witnesses.  Beyond _ALIKE of them under one parent their messages upward are weakened, so that together
they count as _ALIKE; what comes down to each is whole.  Up to that number marginals are exact.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewell.llm import dom, labelled_pages
from tracewell.llm.common import annotate, strings

# Words in class, id and role that tell what an element holds.
_HINTS = {
    "ad": "ad ads adv advert adverts advertisement advertising sponsor sponsored sponsors promo promoted promotion promotions adsense adslot banner dfp",
    "comment": "comment comments commentlist reply replies respond response responses discussion disqus reader thread",
    "nav": "nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager topnav subnav toc skip",
    "side": "side sidebar aside widget widgets related recommended recommendations popular trending more complementary rail",
    "foot": "foot footer copyright legal bottom contentinfo colophon",
    "head": "head header masthead logo brand topbar top banner",
    "notice": "cookie cookies consent notice notices alert alerts gdpr popup modal newsletter subscribe subscription paywall warning overlay dialog message disclaimer announcement",
    "form": "form login signup signin search register",
    "share": "share sharing social follow tags tag",
    "main": "article content main post entry story body text lead paragraph",
}
_HINT = {w: sorted(k for k, v in _HINTS.items() if w in v.split()) for w in sorted({w for v in _HINTS.values() for w in v.split()})}
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
#: Siblings of one tag that speak for themselves.
_ALIKE = 6
_KINDS = ("leaf", "heading", "p", "list", "cell", "section", "main", "around", "other")
_KIND = {t: k for k, ts in {"heading": dom.HEADINGS, "p": {"p", "blockquote", "pre", "figcaption", "figure"}, "list": {"ul", "ol", "li", "dl", "dt", "dd"}, "cell": {"table", "tbody", "tr", "td", "th"}, "section": {"div", "section"}, "main": {"article", "main"}, "around": {"nav", "aside", "footer", "header", "form", "menu", "dialog", "button", "address"}, "leaf": {"#text"}}.items() for t in ts}


def _bin(x: float, *edges: float) -> int:
    return sum(x >= e for e in edges)


def evidence(tree: dom.Tree) -> list[list[str]]:
    """Names of what holds of each node."""
    n = len(tree.parent)
    chars, linked, sentences = [0] * n, [0] * n, [0] * n
    for i in range(n - 1, -1, -1):
        if tree.text[i] is not None:
            chars[i] += len(tree.text[i])
            linked[i] += tree.linked[i]
            sentences[i] += sum(tree.text[i].count(c) for c in ".!?")
        if i:
            p = tree.parent[i]
            chars[p] += chars[i]
            linked[p] += linked[i]
            sentences[p] += sentences[i]
    all_ = max(chars[0], 1)
    out = []
    for i in range(n):
        tag, size = tree.tag[i], chars[i]
        links = _bin(linked[i] / max(size, 1), 0.05, 0.3, 0.6, 0.9)
        if tree.text[i] is not None:
            up = tree.tag[tree.parent[i]]
            f = ["leaf", f"leaf in {up}", f"leaf size {_bin(size, 10, 25, 60, 140, 400)}", f"leaf links {links}", f"leaf ends {tree.text[i][-1] in '.!?:'}", f"leaf ©{'©' in tree.text[i]}"]
        else:
            f = [tag, f"links {links} size {_bin(size, 40, 200, 800)}", f"share {_bin(size / all_, 0.1, 0.3, 0.5, 0.8)}", f"sentences {_bin(sentences[i], 1, 3, 8)}", f"kind {_KIND.get(tag, 'other')} share {_bin(size / all_, 0.15, 0.5)}"]
            raw = tree.attributes[i]
            if raw:
                a = dom.attribute_map(raw)
                hints = {h for k in ("class", "id", "role") if k in a for w in _WORD.findall(a[k]) for h in _HINT.get(w.lower(), ())}
                f += [f"hint {h}" for h in hints]
                if len(hints) > 1 and "main" in hints:
                    f.append("hint main and another")
                if any(k in a for k in ("class", "id", "role")) and not hints:
                    f.append("no hint")
                if "hidden" in a or a.get("aria-hidden") == "true" or "display:none" in a.get("style", "").replace(" ", "").lower():
                    f.append("hidden")
        out.append(f)
    return out


@dataclass
class Forest:
    """Nodes of many pages; level by level, since messages go that way."""

    parent: np.ndarray
    kind: np.ndarray
    feature_node: np.ndarray
    feature: np.ndarray
    levels: list[np.ndarray]
    weight: np.ndarray  # of a node's message to its parent

    @classmethod
    def of(cls, trees: Iterable[dom.Tree], known: dict[str, int], grow: bool = False) -> Forest:
        parent, kind, where, what, depth, alike = [], [], [], [], [], []
        for t in trees:
            base = len(parent)
            siblings = Counter(zip(t.parent, t.tag, strict=True))
            alike += [siblings[x] for x in zip(t.parent, t.tag, strict=True)]
            for i, names in enumerate(evidence(t)):
                p = t.parent[i]
                parent.append(base + p if p >= 0 else -1)
                depth.append(depth[base + p] + 1 if p >= 0 else 0)
                kind.append(_KINDS.index(_KIND.get(t.tag[i], "other")))
                for name in names:
                    at = known.setdefault(name, len(known)) if grow else known.get(name)
                    if at is not None:
                        where.append(base + i)
                        what.append(at)
        d = np.array(depth, np.int64)
        order = np.argsort(d, kind="stable")
        levels = np.split(order, np.flatnonzero(np.diff(d[order])) + 1) if len(d) else []
        return cls(np.array(parent, np.int64), np.array(kind, np.int64), np.array(where, np.int64), np.array(what, np.int64), levels, np.minimum(1, _ALIKE / np.array(alike, np.float64)))


@dataclass
class Model:
    known: dict[str, int]
    unary: np.ndarray
    pair: np.ndarray  # by the child's kind, the parent's label, the child's label


def _log_sum(a: np.ndarray, axis: int) -> np.ndarray:
    m = a.max(axis, keepdims=True)
    return (m + np.log(np.exp(a - m).sum(axis, keepdims=True))).squeeze(axis)


def sum_product(f: Forest, unary: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Marginals of nodes (n x 2), of child and parent (n x 2 x 2, parent first; roots' unused), and log Z."""
    n = len(f.parent)
    score = np.zeros((n, 2))
    score[:, 1] = np.bincount(f.feature_node, weights=unary[f.feature], minlength=n)
    edge = pair[f.kind]  # n x 2 x 2
    up = score.copy()  # own score and all messages from below
    message = np.zeros((n, 2))
    for level in reversed(f.levels[1:]):
        message[level] = f.weight[level, None] * _log_sum(edge[level] + up[level][:, None, :], 2)
        np.add.at(up, f.parent[level], message[level])
    belief = up.copy()
    for level in f.levels[1:]:
        above = belief[f.parent[level]] - message[level]  # what the parent knows without this child
        belief[level] = up[level] + _log_sum(edge[level] + above[:, :, None], 1)
    z = _log_sum(belief, 1)
    marginal = np.exp(belief - z[:, None])
    joint = np.zeros((n, 2, 2))
    for level in f.levels[1:]:
        above = belief[f.parent[level]] - message[level]
        joint[level] = np.exp(edge[level] + above[:, :, None] + up[level][:, None, :] - z[level][:, None, None])
    roots = f.levels[0] if f.levels else np.zeros(0, np.int64)
    return marginal, joint, float(z[roots].sum())


_LABEL = re.compile(r"""data-content\s*=\s*["']([01])["']""")


def labels_of(tree: dom.Tree) -> np.ndarray:
    """Labels of a labelled page: a leaf's is that of the nearest labelled element; an element's is 1 over any 1."""
    n = len(tree.parent)
    said, out = [0] * n, np.zeros(n, np.int64)
    for i in range(n):
        m = _LABEL.search(tree.attributes[i])
        said[i] = int(m[1]) if m else (said[tree.parent[i]] if i else 0)
    for i in range(n - 1, -1, -1):
        if tree.text[i] is not None:
            out[i] = said[i]
        if i and out[i]:
            out[tree.parent[i]] = 1
    return out


def fit(pages: list[str], *, steps: int = 120, rate: float = 0.15, ridge: float = 2e-4) -> Model:
    """Weights of greatest penalised likelihood of labelled pages, by Adam on the exact gradient."""
    trees = [dom.read(p) for p in pages]
    known: dict[str, int] = {}
    f = Forest.of(trees, known, grow=True)
    f.weight[:] = 1  # the likelihood is of the exact model
    y = np.concatenate([labels_of(t) for t in trees])
    inner = np.flatnonzero(f.parent >= 0)
    unary, pair = np.zeros(len(known)), np.zeros((len(_KINDS), 2, 2))
    seen_unary = np.bincount(f.feature, weights=y[f.feature_node], minlength=len(known))
    seen_pair = np.zeros_like(pair)
    np.add.at(seen_pair, (f.kind[inner], y[f.parent[inner]], y[inner]), 1)
    state = [np.zeros_like(x) for x in (unary, unary, pair, pair)]
    for step in range(1, steps + 1):
        marginal, joint, _ = sum_product(f, unary, pair)
        g = [np.bincount(f.feature, weights=marginal[f.feature_node, 1], minlength=len(known)) - seen_unary, np.zeros_like(pair)]
        np.add.at(g[1], f.kind[inner], joint[inner])
        g[1] -= seen_pair
        for k, w in enumerate((unary, pair)):
            d = g[k] / len(pages) + ridge * w
            m, v = state[2 * k], state[2 * k + 1]
            m += 0.1 * (d - m)
            v += 0.001 * (d * d - v)
            w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Model(known, unary, pair)


@cache
def made_up_model(pages: int) -> Model:
    """The model of that many made-up pages, fitted once a process; it's always the same."""
    return fit(labelled_pages.pages(pages))


def main_texts(trees: list[dom.Tree], model: Model, least: float = 0.5) -> list[str]:
    """The blocks of each page that more likely than not are main text, one to a line."""
    f = Forest.of(trees, model.known)
    marginal, _, _ = sum_product(f, model.unary, model.pair)
    out, base = [], 0
    for t in trees:
        keep = marginal[base : base + len(t.parent), 1] >= least
        out.append("\n".join(x for x, k in zip(t.text, keep, strict=True) if k and x is not None))
        base += len(t.parent)
    return out


def extract(pages: DataFrame, *, html_col: str = "html", keep: list[str] | None = None, labelled: list[str] | None = None, training_pages: int = 200, model: Model | None = None) -> tuple[DataFrame, str]:
    """The columns `keep` of pages with a struct column of `text`, the main text, and `n_chars`.

    model: one fitted before; else labelled, pages with data-content marks to learn from; else training_pages made-up
    ones, always the same.
    A null or empty page, and a page without main text, gives an empty text.  White space inside a block becomes one
    space; blocks go in page order, a line each.  Repeated rows are read each; other columns stay as they are.
    """
    if model is None:
        model = fit(labelled) if labelled is not None else made_up_model(training_pages)
    sent = pages.sparkSession.sparkContext.broadcast(model)

    def run(html):
        texts, some, n = [], [], 0
        for page in strings(html).to_pylist():
            some.append(dom.read(page))
            n += len(some[-1].parent)
            if n > 20_000:
                texts += main_texts(some, sent.value)
                some, n = [], 0
        texts += main_texts(some, sent.value) if some else []
        return [pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())]

    return annotate(pages, [html_col], run, "text string, n_chars long", list(pages.columns if keep is None else keep))


def digest(pages: DataFrame) -> DataFrame:
    """What op1 returns."""
    df, r = extract(pages, keep=["page_id", "url"])
    return df.select("page_id", "url", F.col(r)["text"].alias("text"), F.col(r)["n_chars"].alias("n_chars"))
