"""Main text of web pages: boosted trees over the nodes of the page, decoded along the tree.

Each structural element and each text block of a page is a node with features of its
subtree (text, density, links, paragraphs), its tag, the words of its naming
attributes, its depth, its siblings and its ancestors. Gradient-boosted trees give
each node the probability that it holds main text. Decoding chooses for every node to
keep or drop it so that the product of probabilities is largest and nothing is kept
below a dropped node.

The trees are fitted on a bounded sample: the ``SAMPLE`` pages with the smallest
hashes, of a page over ``SAMPLE_BYTES`` bytes the beginning of its body, without scripts,
styles and comments, of at most so many bytes. Their own marked-up parts (article or main,
against navigation, footers and the like) are labels, and their texts are set anew in
random page designs whose parts are known.

Blocks are the texts between structural tags; line breaks and inline markup don't end
a block. Cases: null or empty html, and pages without visible text, give an empty text;
broken or cut-off markup is read as far as it goes; repeated pages and null ids are
read like any other; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import html
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import boosting
from .common import smallest, table, text_blocks
from .html_dom import LEAF, Dom, parse

SAMPLE = 150
SAMPLE_BYTES = 64 << 10
DESIGNS = 700
#: Private mark of main text in designed pages.
MARK = "\ue000"
OUT = "page_id long, url string, text string, n_chars long"

TAGS = (("article", "main"), ("nav",), ("header",), ("footer",), ("aside",), ("form", "fieldset", "button", "dialog"),
        ("section",), ("div",), ("p",), ("h1", "h2", "h3", "h4", "h5", "h6"), ("ul", "ol", "dl", "menu"),
        ("li", "dt", "dd"), ("table", "tbody", "thead", "tr"), ("td", "th"), ("blockquote", "pre"),
        ("figure", "figcaption"), ("#root", "html", "body"), (LEAF,))
TAG_GROUP = {t: k for k, group in enumerate(TAGS) for t in group}
#: Words of class, id and role attributes, by what they usually name.
GROUPS = (
    "content article post entry story main body text prose page maincontent",
    "nav menu navbar navigation breadcrumb breadcrumbs toc pagination pager tabs skip",
    "header masthead banner top logo branding hero",
    "footer bottom copyright legal colophon contentinfo imprint",
    "sidebar aside widget rail complementary related recommended popular trending more tags categories archive",
    "ad ads advert advertisement advertising sponsor sponsored promo promotion commercial outbrain taboola",
    "cookie consent notice alert gdpr banner popup modal overlay warning privacy message",
    "form login signup search subscribe newsletter register contact input",
    "comment comments reply replies respond discussion disqus reader thread feedback",
    "share social follow facebook twitter like print email tools author byline meta date",
)
GROUP_OF: dict[str, list[int]] = {}
for _k, _words in enumerate(GROUPS):
    for _w in _words.split():
        GROUP_OF.setdefault(_w, []).append(_k)
STRONG = {"article", "main", "nav", "header", "footer", "aside", "form"}
ABOVE = sorted(STRONG)


def node_features(dom: Dom) -> np.ndarray:
    n = len(dom.tag)
    parent = np.array(dom.parent)
    chars = np.array([len(t) for t in dom.text], np.float64)
    linked = np.array(dom.links, np.float64)
    stops = np.array([t.count(".") + t.count(",") + t.count("!") + t.count("?") if t else 0 for t in dom.text], np.float64)
    marks = np.array([("©" in t) or ("copyright" in t[:80].lower()) if t else False for t in dom.text], np.float64)
    leaf = np.array([t == LEAF for t in dom.tag])
    para = np.array([t == "p" for t in dom.tag], np.float64)
    depth = np.zeros(n)
    groups = np.zeros((n, len(GROUPS)))
    above = np.zeros((n, len(ABOVE)))
    index = {t: k for k, t in enumerate(ABOVE)}
    hidden = np.array(dom.hidden, np.float64)
    start = np.concatenate([[0], np.cumsum(chars)[:-1]])
    for k in range(n):
        for w in dom.names[k]:
            for g in GROUP_OF.get(w, ()):
                groups[k, g] = 1
    group_above = np.zeros_like(groups)
    for k in range(1, n):
        p = parent[k]
        depth[k] = depth[p] + 1
        above[k] = above[p]
        group_above[k] = np.maximum(group_above[p], groups[p])
        hidden[k] = max(hidden[k], hidden[p])
        j = index.get(dom.tag[p])
        if j is not None:
            above[k, j] = 1
    # sums over subtrees, from the last node up
    total = np.stack([chars, linked, stops, para, leaf.astype(float), np.ones(n), marks], 1)
    for k in range(n - 1, 0, -1):
        total[parent[k]] += total[k]
    page = max(total[0, 0], 1)
    # siblings
    order = np.argsort(parent, kind="stable")
    first = np.searchsorted(parent[order], parent[order], "left")
    last = np.searchsorted(parent[order], parent[order], "right")
    place, siblings, before, after = (np.zeros(n) for _ in range(4))
    size = np.log1p(total[:, 0])
    pos = np.arange(n)
    place[order] = pos - first
    siblings[order] = last - first
    before[order] = np.where(pos > first, size[order][np.maximum(pos - 1, 0)], -1)
    after[order] = np.where(pos + 1 < last, size[order][np.minimum(pos + 1, n - 1)], -1)
    tag = np.array([TAG_GROUP.get(t, len(TAGS)) for t in dom.tag])
    same = np.zeros(n)
    key = parent * 32 + tag
    _, of, count = np.unique(key, return_inverse=True, return_counts=True)
    same = count[of] / np.maximum(siblings, 1)
    kinds = np.eye(len(TAGS) + 1)[tag]
    parent_kind = kinds[np.maximum(parent, 0)]
    parent_groups = groups[np.maximum(parent, 0)]
    t = np.maximum(total[:, 0], 1)
    numbers = np.stack([
        depth, hidden, size, np.log1p(chars), total[:, 1] / t, total[:, 2] / t, np.log1p(total[:, 3]),
        np.log1p(total[:, 4]), np.log1p(t / total[:, 5]), total[:, 0] / page, start / page, place,
        np.log1p(siblings), same, before, after, size[np.maximum(parent, 0)], total[:, 6]], 1)
    return np.concatenate([numbers, kinds, parent_kind, groups, parent_groups, group_above, above], 1)


def decode(dom: Dom, p: np.ndarray) -> np.ndarray:
    """The most probable choice of kept nodes in which no kept node has a dropped ancestor."""
    p = np.clip(p, 1e-6, 1 - 1e-6)
    keep, drop = np.log(p), np.log(1 - p)
    below_keep = keep.copy()  # the best of the subtree if the node is kept
    below_drop = drop.copy()  # all of it dropped
    parent = dom.parent
    for k in range(len(p) - 1, 0, -1):
        below_keep[parent[k]] += max(below_keep[k], below_drop[k])
        below_drop[parent[k]] += below_drop[k]
    kept = np.zeros(len(p), bool)
    kept[0] = True
    for k in range(1, len(p)):
        kept[k] = kept[parent[k]] and below_keep[k] > below_drop[k]
    return kept


def main_text(dom: Dom, kept: np.ndarray) -> str:
    return "\n\n".join(dom.text[k] for k in np.flatnonzero(kept).tolist() if dom.text[k])


def _up(dom: Dom, leaves: np.ndarray) -> np.ndarray:
    """Labels of all nodes from those of the leaves: a node holds main text if a leaf below does."""
    out = leaves.astype(float)
    for k in range(len(out) - 1, 0, -1):
        out[dom.parent[k]] = max(out[dom.parent[k]], out[k])
    return out


def own_labels(dom: Dom) -> np.ndarray | None:
    """Leaf labels from the page's own marks, if it has an article or main part."""
    good, bad = np.zeros(len(dom.tag), bool), np.zeros(len(dom.tag), bool)
    for k in range(1, len(dom.tag)):
        p = dom.parent[k]
        good[k] = good[p] or dom.tag[k] in ("article", "main")
        bad[k] = bad[p] or dom.tag[k] in ("nav", "aside", "footer", "form") or dom.hidden[k] \
            or any(g in (1, 4, 5, 6, 7, 8) for w in dom.names[k] for g in GROUP_OF.get(w, ()))
    if not good.any():
        return None
    return good & ~bad & np.array([t == LEAF for t in dom.tag])


class Design:
    """Random pages with known parts, made of given texts."""

    def __init__(self, seed: int, prose: list[str], short: list[str]) -> None:
        self.rng = np.random.default_rng(seed)
        self.prose, self.short = prose, short

    def one(self, items):
        return items[int(self.rng.integers(len(items)))]

    def chance(self, p: float) -> bool:
        return bool(self.rng.random() < p)

    def words(self, n: int) -> str:
        return " ".join((self.one(self.short) + " " + self.one(self.prose)).split()[:n])

    def attr(self, group: int, more: str = "") -> str:
        names = [w for w in GROUPS[group].split()]
        value = self.one(names) + (self.one(["", "", "-inner", "-box", "_1", " wrap", " clearfix"]) if not more else more)
        return f' {self.one(["class", "class", "id"])}="{value}"'

    def link_list(self) -> str:
        items = [f'<a href="/{k}">{html.escape(self.words(int(self.rng.integers(1, 5))))}</a>'
                 for k in range(int(self.rng.integers(2, 9)))]
        if self.chance(0.7):
            return "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>"
        return self.one([" | ", " ", "<br>"]).join(items)

    def text(self, long: bool = True) -> str:
        t = self.one(self.prose) if long else self.one(self.short)
        return html.escape(t if self.chance(0.6) else " ".join(t.split()[:int(self.rng.integers(1, 40))]) or "x", quote=False)

    def main(self) -> str:
        h = self.one(["h1", "h1", "h2"])
        out = [f"<{h}>{MARK}{self.text(False)}</{h}>"] if self.chance(0.85) else []
        for _ in range(int(self.rng.integers(1, 12))):
            kind = self.rng.random()
            body = MARK + self.text(self.chance(0.8))
            if kind < 0.6:
                out.append(f"<p>{body}" + ("</p>" if self.chance(0.8) else ""))
            elif kind < 0.68:
                out.append(f"<p><b>{body}<br>")
            elif kind < 0.76:
                out.append(f"<div>{body}</div>")
            elif kind < 0.82:
                out.append(f"<{self.one(['h2', 'h3'])}>{body}</h2>")
            elif kind < 0.9:
                out.append("<ul>" + "".join(f"<li>{MARK}{self.text(False)}</li>" for _ in range(3)) + "</ul>")
            elif kind < 0.95:
                out.append(f"<blockquote>{body}</blockquote>")
            else:
                out.append(f"<table><tr><td>{body}</td><td>{MARK}{self.text(False)}</td></tr></table>")
            if self.chance(0.05):
                out.append(f"<div{self.attr(5)}>{self.text()}</div>")
        inner = "".join(out)
        if self.chance(0.12):
            inner += f"<div{self.attr(9)}>{self.link_list()}</div>"
        if self.chance(0.6):
            return f"<{self.one(['article', 'article', 'main'])}{self.attr(0) if self.chance(0.4) else ''}>{inner}</article>"
        return f"<div{self.attr(0) if self.chance(0.85) else ''}>{inner}</div>"

    def rest(self, kind: str) -> str:
        r = self.rng
        if kind == "nav":
            return f"<nav>{self.link_list()}</nav>" if self.chance(0.5) else f"<div{self.attr(1)}>{self.link_list()}</div>"
        if kind == "header":
            inner = f"<{self.one(['h1', 'div', 'p'])}>{self.text(False)}</div>" + (self.link_list() if self.chance(0.5) else "")
            return f"<header>{inner}</header>" if self.chance(0.6) else f"<div{self.attr(2)}>{inner}</div>"
        if kind == "footer":
            inner = self.one(["&copy; ", "Copyright ", ""]) + self.text(self.chance(0.5)) + (self.link_list() if self.chance(0.4) else "")
            return f"<footer>{inner}</footer>" if self.chance(0.6) else f"<div{self.attr(3)}>{inner}</div>"
        if kind == "aside":
            inner = "".join(f"<h3>{self.text(False)}</h3><p>{self.text()}</p>" for _ in range(int(r.integers(1, 4)))) \
                + (self.link_list() if self.chance(0.6) else "")
            return f"<aside>{inner}</aside>" if self.chance(0.5) else f"<div{self.attr(4)}>{inner}</div>"
        if kind == "comments":
            inner = "".join(f"<div{self.attr(8) if self.chance(0.5) else ''}><p>{self.text()}</p></div>" for _ in range(int(r.integers(1, 7))))
            return f"<{self.one(['section', 'div', 'ol'])}{self.attr(8)}><h3>{self.text(False)}</h3>{inner}</div>"
        if kind == "form":
            inner = f"<label>{self.text(False)}</label><input name='q'><button>{self.text(False)}</button>"
            return f"<form{self.attr(7) if self.chance(0.5) else ''}>{inner}</form>" if self.chance(0.7) else f"<div{self.attr(7)}>{inner}</div>"
        group = {"ad": 5, "notice": 6, "share": 9}[kind]
        inner = self.text(self.chance(0.7))
        return f"<div{self.attr(group)}>{f'<p>{inner}</p>' if self.chance(0.4) else inner}</div>"

    def page(self) -> str:
        top = [self.rest(k) for k in ("header", "nav", "notice", "ad", "form") if self.chance(0.45)]
        low = [self.rest(k) for k in ("comments", "aside", "ad", "share", "form", "notice") if self.chance(0.35)]
        middle = self.main()
        if self.chance(0.4):
            side = self.rest("aside")
            middle = f"<div>{middle + side if self.chance(0.6) else side + middle}</div>"
        foot = [self.rest("footer")] if self.chance(0.8) else []
        body = "".join(top) + middle + "".join(low) + "".join(foot)
        if self.chance(0.3):
            body = f'<div id="{self.one(["wrapper", "page", "container", "root"])}">{body}</div>'
        return f"<html><body>{body}</body></html>"


def beginning(page: Column) -> Column:
    """The page, or of a page over SAMPLE_BYTES bytes the beginning of what is shown."""
    shown = F.regexp_replace(page, r"(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>", "")
    body = F.regexp_extract(shown, rf"(?i)<body\b[\s\S]{{0,{SAMPLE_BYTES // 4 - 5}}}", 0)
    cut = F.when(body != "", body).otherwise(shown.substr(1, SAMPLE_BYTES // 4))
    return F.when(F.octet_length(page) <= SAMPLE_BYTES, page).otherwise(cut)


def train(pages: DataFrame, sample: int = SAMPLE, designs: int = DESIGNS) -> boosting.Trees | None:
    """Fit the trees on the sample's own marks and on designed pages of its texts."""
    rows = pages.select("html").filter(F.col("html").isNotNull()).withColumn("h", F.xxhash64("html"))
    chosen = [r.h for r in smallest(rows.select("h").distinct(), sample, "h").collect()]
    found = sorted((r.h, r.html) for r in rows.filter(F.col("h").isin(chosen)).withColumn("html", beginning(F.col("html")))
                   .groupBy("h").agg(F.min("html").alias("html")).collect())
    doms = [parse(page) for _, page in found]
    prose = sorted({t for d in doms for t in d.text if len(t) > 80})
    short = sorted({t for d in doms for t in d.text if 0 < len(t) <= 80})
    if not prose and not short:
        return None
    design = Design(1, prose or short, short or [" ".join(t.split()[:5]) for t in prose])
    xs, ys = [], []
    for dom in doms:
        label = own_labels(dom)
        if label is not None:
            xs.append(node_features(dom))
            ys.append(_up(dom, label))
    for _ in range(designs):
        dom = parse(design.page())
        label = np.array([MARK in t for t in dom.text])
        dom.text = [t.replace(MARK, "") for t in dom.text]
        xs.append(node_features(dom))
        ys.append(_up(dom, label))
    x, y = np.concatenate(xs), np.concatenate(ys)
    return boosting.fit(x, y) if 0 < y.mean() < 1 else None


def extract(pages: DataFrame, model: boosting.Trees | None) -> DataFrame:
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in text_blocks(batches, "html", max_bytes=1 << 20):
            doms = [parse(page or "") for page in batch.column("html").to_pylist()]
            texts = [""] * len(doms)
            some = [k for k, d in enumerate(doms) if any(d.text)]
            if model is not None and some:
                p = model.probability(np.concatenate([node_features(doms[k]) for k in some]))
                at = 0
                for k in some:
                    n = len(doms[k].tag)
                    texts[k] = main_text(doms[k], decode(doms[k], p[at:at + n]))
                    at += n
            yield pa.RecordBatch.from_arrays([
                batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long"), "url", "html").mapInArrow(run, OUT)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return extract(pages, train(pages))
