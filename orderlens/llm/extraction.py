"""Main text of web pages by a tree-structured graphical model.

Every element of a page is content or not. Potentials of single elements (tag, class, text, links)
and of parent and child hold on the page's tree; sum-product messages up and down the tree give
each element's exact marginal, and text of elements that are likelier content is kept. Potentials
are trained by likelihood on labelled pages: texts of the corpus set in many page layouts.
"""

from __future__ import annotations

import html
import math
import random
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrowtext import documents, slices
from .page_tree import GROUPS, N_FEATURES, N_GROUPS, Node, blocks, features, parse

#: Documents that the training reads at most, and the longest it takes.
SAMPLE_TEXTS = 400
SAMPLE_CHARS = 6000
TRAINING_PAGES = 900
_MARK = "\ue000"

# Usual names of page parts.
BOILERPLATE = {
    "nav": "nav navigation navbar menu menubar topnav breadcrumb breadcrumbs pagination pager toc",
    "header": "header masthead banner topbar branding logo site",
    "footer": "footer bottom copyright colophon legal imprint foot",
    "aside": "sidebar aside rail widget related recommended trending popular more teaser teasers "
             "secondary tags",
    "ad": "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion dfp "
          "adsense affiliate",
    "notice": "notice cookie cookies consent gdpr modal popup overlay alert paywall disclaimer "
              "subscribe newsletter signup toast",
    "form": "form search login comment respond contact",
    "comments": "comments comment disqus discussion replies reply respond commentlist thread",
    "share": "share sharing social buttons toolbar follow",
}
CONTENT = ("article content post entry story main body text page prose maincontent postbody "
           "articlebody primary column reader blog news document")
_PHRASES = {
    "nav": "Home|About|News|Contact|Archive|Sport|Start|Products|Blog|Help",
    "header": "The Daily Page|Our site|Welcome|Your portal for everything",
    "footer": "&copy; 2024 example.org|Imprint|Privacy|Terms of use|All rights reserved",
    "aside": "Related stories|Most read|See also|Tags|Latest posts",
    "ad": "Advertisement|Sponsored|Buy now and save|Limited offer",
    "notice": "We use cookies to improve this site. Accept|Please enable scripts|"
              "Sign up for our newsletter",
    "form": "Search|Your e-mail|Send|Log in",
    "comments": "Comments (3)|Reply|Leave a comment|said:",
    "share": "Share|Tweet|Print|Follow us",
}
_NATIVE = {"nav": "nav", "header": "header", "footer": "footer", "aside": "aside",
           "form": "form"}


class _Layout:
    """Writes one labelled page; content text carries a mark."""

    def __init__(self, rng: random.Random, texts: list[str]):
        self.rng, self.texts = rng, texts

    def lines(self, most: int) -> list[str]:
        rows = [x.strip() for x in self.rng.choice(self.texts).split("\n") if x.strip()]
        return [html.escape(x, quote=False) for x in rows[:most]] or ["Text."]

    def part(self, kind: str) -> str:
        """A part of the page that isn't content."""
        rng = self.rng
        own = kind in _NATIVE and rng.random() < 0.5
        tag = _NATIVE[kind] if own else rng.choice(["div", "div", "section", "ul", "aside"][
            :5 if kind in ("aside", "ad") else 3])
        named = not own or rng.random() < 0.3
        names = rng.sample(BOILERPLATE[kind].split(), 1 + (rng.random() < 0.2))
        where = rng.choice(["class", "class", "id"])
        said = [rng.choice(_PHRASES[kind].split("|")) for _ in range(rng.randint(1, 4))]
        if kind in ("nav", "aside", "share", "footer") and rng.random() < 0.7:
            words = " ".join(self.lines(2)).split()[:8]
            said = [f'<a href="/x">{w}</a>' for w in [*said, *words]]
            if rng.random() < 0.6:
                inner = "".join(f"<li>{x}</li>" for x in said)
                inner = inner if tag == "ul" else f"<ul>{inner}</ul>"
            else:
                inner = " ".join(said)
        elif kind in ("comments", "ad", "aside", "notice", "footer", "header") \
                and rng.random() < 0.75:
            p = rng.choice(["p", "p", "div", ""])
            said = [*said[:1], *self.lines(rng.randint(1, 4))]
            inner = "".join(f"<{p}>{x}</{p}>" for x in said) if p else " ".join(said)
            if kind == "comments" and rng.random() < 0.5:
                inner = f"<h3>Comments</h3><ol><li>{inner}</li></ol>"
        elif kind == "form":
            inner = "".join(f"<label>{x}</label><input><button>{x}</button>" for x in said)
        else:
            inner = "".join(f"<span>{x}</span> " for x in said)
        attribute = f' {where}="{rng.choice(["-", " ", "_"]).join(names)}"' if named else ""
        return f"<{tag}{attribute}>{inner}</{tag}>"

    def marked(self, text: str) -> str:
        words = text.split(" ")
        if len(words) > 6 and self.rng.random() < 0.25:
            k = self.rng.randrange(len(words) - 2)
            tag = self.rng.choice(['a href="/y"', "b", "em", "strong", "span"])
            words[k] = f"<{tag}>{words[k]}</{tag.split()[0]}>"
        return _MARK + " ".join(words)

    def content(self) -> str:
        rng, out = self.rng, []
        rows = self.lines(rng.choice([1, 2, 4, 8, 20, 40]))
        while rng.random() < (0.2 if len(rows) < 20 else 0.9) and len(rows) < 200:
            rows += self.lines(40)
        if rng.random() < 0.8:
            title = f"<h1>{self.marked(rows[0][:60])}</h1>"
            out.append(f"<header>{title}</header>" if rng.random() < 0.15 else title)
        for row in rows:
            style = rng.random()
            if style < 0.08:
                items = "".join(f"<li>{self.marked(x)}</li>" for x in row.split(". ") if x)
                out.append(f"<ul>{items}</ul>")
            elif style < 0.14:
                out.append(f"<h2>{self.marked(row[:50])}</h2>")
            elif style < 0.19:
                out.append(f"<blockquote><p>{self.marked(row)}</p></blockquote>")
            elif style < 0.22:
                cells = "".join(f"<td>{self.marked(x)}</td>" for x in row.split()[:6])
                out.append(f"<table><tr>{cells}</tr></table>")
            elif style < 0.25:
                out.append(f"<figure><figcaption>{self.marked(row[:80])}</figcaption></figure>")
            else:
                out.append(f"<p>{self.marked(row)}</p>")
            if rng.random() < 0.05:
                out.append(self.part(rng.choice(["ad", "share", "aside", "notice"])))
        return "".join(out)

    def page(self) -> str:
        rng = self.rng
        kind = rng.random()
        inner = self.content()
        if rng.random() < 0.2:
            inner += self.part(rng.choice(["share", "comments", "form", "aside"]))
        if kind < 0.4:
            inner = f"<article>{inner}</article>"
        elif kind < 0.9:
            tag = rng.choice(["div", "div", "section", "main", "article"])
            names = rng.choice(["-", " "]).join(rng.sample(CONTENT.split(), rng.randint(1, 2)))
            named = f' {rng.choice(["class", "id"])}="{names}"' if rng.random() < 0.8 else ""
            inner = f"<{tag}{named}>{inner}</{tag}>"
        if rng.random() < 0.25:
            inner = rng.choice([f"<main>{inner}</main>", f'<div class="container">{inner}</div>',
                                f'<div id="wrapper">{inner}{self.part("aside")}</div>'])
        before = [k for k in ("header", "nav", "notice", "ad", "form", "aside")
                  if rng.random() < 0.4]
        after = [k for k in ("aside", "comments", "share", "ad", "form", "notice", "footer")
                 if rng.random() < 0.4]
        return (f"<html><body>{''.join(map(self.part, before))}{inner}"
                f"{''.join(map(self.part, after))}</body></html>")


def labelled_pages(texts: list[str], number: int = TRAINING_PAGES,
                   seed: int = 5) -> Iterator[tuple[list[Node], np.ndarray]]:
    """Trees of pages with a label for each element: 1 if its own text is content; without text
    of its own, if a paragraph or list right in it is content, or most text below it."""
    rng = random.Random(seed)
    layout = _Layout(rng, [t for t in texts if t.strip()] or ["A line of text.\nAnother line."])
    for _ in range(number):
        nodes = parse(layout.page())
        inside, all_text = np.zeros(len(nodes)), np.full(len(nodes), 1e-9)
        for k, node in enumerate(nodes):
            for _, text in node.runs:
                all_text[k] += len(text.strip())
            if any(_MARK in text for _, text in node.runs):
                inside[k] = all_text[k]
            node.runs = [(b, t.replace(_MARK, "")) for b, t in node.runs]
        own = all_text > 1e-6
        label = (inside > 0).astype(float)
        for k in range(len(nodes) - 1, -1, -1):
            if not own[k] and inside[k] > 0.6 * all_text[k]:
                label[k] = 1
            if k:
                parent = nodes[k].parent
                inside[parent] += inside[k]
                all_text[parent] += all_text[k]
                if label[k] and nodes[k].tag in GROUPS and not own[parent]:
                    label[parent] = 1
        yield nodes, label


@dataclass
class Model:
    """Log potentials: per feature of an element, and of agreeing with the parent by group."""
    names: dict[str, int]
    weights: np.ndarray
    coupling: np.ndarray

    def marginals(self, nodes: list[Node]) -> list[float]:
        """Log odds of content for each element, by messages up and down its page's tree.

        Elements stand before those inside them, so one pass from the last to the first sends
        all messages up, and one from the first to the last all messages down."""
        weight = self.weights
        odds = [float(weight[f].sum()) for f in features(nodes, self.names)]
        factor = [math.tanh(self.coupling[GROUPS.get(x.tag, 2)]) for x in nodes]
        up = [0.0] * len(nodes)
        for k in range(len(nodes) - 1, 0, -1):
            up[k] = _message(odds[k], factor[k])
            odds[nodes[k].parent] += up[k]
        for k in range(1, len(nodes)):
            odds[k] += _message(odds[nodes[k].parent] - up[k], factor[k])
        return odds


def _message(odds: float, factor: float) -> float:
    """Log odds that one end of an edge sends to the other."""
    return 2 * math.atanh(factor * math.tanh(max(min(odds, 60.0), -60.0) / 2) * (1 - 1e-12))


def train(pages: list[tuple[list[Node], np.ndarray]], ridge: float = 0.3,
          steps: int = 300) -> Model:
    """Potentials of greatest likelihood on labelled pages. The gradient compares labels with the
    marginals of elements and of pairs that messages over all pages' trees give; the trees are
    worked on together, one depth at a time."""
    names: dict[str, int] = {}
    for nodes, _ in pages:
        for node in nodes:
            for name in node.names:
                names.setdefault(name, len(names))
    width = N_FEATURES + len(names)
    parent, depth, group, rows, base = [], [], [], [], 0
    for nodes, _ in pages:
        deep = [0] * len(nodes)
        for k in range(1, len(nodes)):
            deep[k] = deep[nodes[k].parent] + 1
        x = np.zeros((len(nodes), width), np.float32)
        for k, f in enumerate(features(nodes, names)):
            x[k, f] = 1
        parent += [base + n.parent if n.parent >= 0 else -1 for n in nodes]
        group += [GROUPS.get(n.tag, 2) for n in nodes]
        depth += deep
        rows.append(x)
        base += len(nodes)
    x, y = np.concatenate(rows), np.concatenate([labels for _, labels in pages])
    parent, depth, group = np.array(parent), np.array(depth), np.array(group)
    levels = [np.flatnonzero(depth == d) for d in range(1, depth.max() + 1)]
    child = np.concatenate(levels)
    sign = 2 * y - 1
    w = np.zeros(width + N_GROUPS)
    w[width:] = 1.0
    mean, square = np.zeros(len(w)), np.zeros(len(w))
    for step in range(1, steps + 1):
        factor = np.tanh(w[width:])[group]
        odds, up = (x @ w[:width].astype(np.float32)).astype(float), np.zeros(len(y))
        for level in reversed(levels):
            up[level] = _messages(odds[level], factor[level])
            np.add.at(odds, parent[level], up[level])
        below = odds.copy()
        for level in levels:
            odds[level] += _messages(odds[parent[level]] - up[level], factor[level])
        one = np.tanh(np.clip((odds[parent[child]] - up[child]) / 2, -30, 30))
        two = np.tanh(np.clip(below[child] / 2, -30, 30))
        both = one * two
        agree = (factor[child] + both) / (1 + factor[child] * both)
        error = y - 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        gradient = np.concatenate([error.astype(np.float32) @ x, np.bincount(
            group[child], sign[child] * sign[parent[child]] - agree, N_GROUPS)])
        gradient[:width] -= ridge * w[:width]
        # Steps of adaptive size per potential.
        mean += 0.1 * (gradient - mean)
        square += 0.01 * (gradient * gradient - square)
        rate = 0.2 * (1 - step / (steps + 1))
        w += rate * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.99 ** step)) + 1e-8)
        w[width:] = np.clip(w[width:], 0.0, 6.0)
    return Model(names, w[:width], w[width:])


def _messages(odds: np.ndarray, factor: np.ndarray) -> np.ndarray:
    return 2 * np.arctanh(factor * np.tanh(np.clip(odds, -60, 60) / 2) * (1 - 1e-12))


def fit(docs: DataFrame, texts: int = SAMPLE_TEXTS) -> Model:
    """A model from labelled pages made of the ``texts`` documents first by a hash of the doc_id,
    among those of up to :data:`SAMPLE_CHARS` characters. Only these texts come to the driver."""
    rows = documents(docs).where(F.length("text").between(1, SAMPLE_CHARS)).orderBy(
        F.xxhash64("doc_id"), "doc_id", "text").limit(texts).collect()
    return train(list(labelled_pages([r["text"] for r in rows])))


def main_text(page: str, model: Model) -> str:
    nodes = parse(page)
    return blocks(nodes, [odds > 0 for odds in model.marginals(nodes)])


def _extract(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, "html"):
        texts = [main_text(page, model) for page in part.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()),
             pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])


def extracted_pages(pages: DataFrame, model: Model) -> DataFrame:
    """One row per page: page_id, url, text (main text: blocks in page order, one line each),
    n_chars. White space inside a block is one space; character references are decoded. Null and
    empty pages, and pages without content, give an empty text; a page of plain text without
    markup is judged as one element. Broken markup never fails. Repeated rows give equal rows;
    empty input gives no rows; other columns are ignored."""
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html")).mapInArrow(
        lambda it: _extract(it, model), "page_id long, url string, text string, n_chars long")
