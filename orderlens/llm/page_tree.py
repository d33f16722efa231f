"""Pages as trees: tags, features of elements, and the text each element holds."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

import numpy as np

# Fixed values of the markup language.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg select option".split())
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp "
                   "small span strike strong sub sup time tt u var label".split())
#: An opening tag here ends an open paragraph.
ENDS_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure "
                   "footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section "
                   "table ul".split())
#: Same-kind elements that end each other, and what bounds the search for one.
ENDS_EACH_OTHER = {"li": ("li", ("ul", "ol", "menu")), "dt": ("dt dd", ("dl",)),
                   "dd": ("dt dd", ("dl",)), "tr": ("tr td th", ("table",)),
                   "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table"))}

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<([/!?]?)([A-Za-z][^\s/>]*)?"
                  r"((?:[^<>\"'=]|=\s*\"[^\"]*\"|=\s*'[^']*'|[=\"'])*+)>", re.S)
_ATTRIBUTE = re.compile(r"(class|id|role|hidden|aria-label)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'"
                        r"|([^\s>]+)))?", re.I)
_NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_SPACE = re.compile(r"\s+")


@dataclass
class Node:
    tag: str
    names: list[str]
    parent: int
    #: Runs of text held directly (or by inline elements): block number, text.
    runs: list[tuple[int, str]] = field(default_factory=list)
    link_chars: int = 0


def _names(attributes: str) -> list[str]:
    found = []
    for kind, *values in _ATTRIBUTE.findall(attributes):
        if kind.lower() == "hidden":
            found.append("hidden")
        else:
            found += [w.lower() for w in _NAME_PART.findall(next(filter(None, values), ""))]
    return found


def parse(page: str) -> list[Node]:
    """Elements in page order; the first is the page itself. Inline elements without a class or
    role belong to the element around them. Texts of scripts, styles and other elements that
    show none are left out. Broken markup never fails: unknown ends are ignored."""
    nodes = [Node("page", [], -1)]
    # Open elements: tag, node that holds their text, whether they are an element of their own.
    stack: list[tuple[str, int, bool]] = [("page", 0, True)]
    at, block, links = 0, 0, 0
    lowered = None

    def put(text: str) -> None:
        if text and not text.isspace():
            node = nodes[stack[-1][1]]
            text = html.unescape(text)
            node.runs.append((block, text))
            if links:
                node.link_chars += len(text)
        elif text and nodes[stack[-1][1]].runs:
            nodes[stack[-1][1]].runs.append((block, " "))

    for m in _TAG.finditer(page):
        if m.start() < at:
            continue
        put(page[at:m.start()])
        at = m.end()
        mark, tag = m.group(1), (m.group(2) or "").lower()
        if not tag or mark in ("!", "?"):
            if mark == "":
                put(m.group(0))   # a sign "<" in the text
            continue
        if mark == "/":
            place = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == tag), 0)
            if not place or (tag in INLINE and any(
                    stack[i][2] and stack[i][0] not in INLINE
                    for i in range(place + 1, len(stack)))):
                continue
            links -= sum(t == "a" for t, _, _ in stack[place:])
            if any(t not in INLINE for t, _, _ in stack[place:]):
                block += 1
            del stack[place:]
            continue
        if tag in RAW:
            if lowered is None:
                lowered = page.lower()
                if len(lowered) != len(page):
                    lowered = re.sub("[A-Z]", lambda c: c.group().lower(), page)
            end = lowered.find(f"</{tag}", at)
            close = -1 if end < 0 else page.find(">", end)
            at = len(page) if close < 0 else close + 1
            continue
        if tag in VOID:
            if tag == "br":
                put(" ")
            elif tag == "hr":
                block += 1
            continue
        if tag in ENDS_P:
            place = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == "p"), 0)
            if place:
                links -= sum(t == "a" for t, _, _ in stack[place:])
                del stack[place:]
        if tag in ENDS_EACH_OTHER:
            same, bounds = ENDS_EACH_OTHER[tag]
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] in bounds:
                    break
                if stack[i][0] in same.split():
                    links -= sum(t == "a" for t, _, _ in stack[i:])
                    del stack[i:]
                    break
        names = _names(m.group(3)) if m.group(3) else []
        inline = tag in INLINE
        own = not inline or (bool(names) and tag != "a")
        if own:
            nodes.append(Node(tag, names, stack[-1][1]))
            stack.append((tag, len(nodes) - 1, True))
        else:
            stack.append((tag, stack[-1][1], False))
        links += tag == "a"
        block += not inline
    put(page[at:])
    return nodes


def blocks(nodes: list[Node], keep) -> str:
    """Texts of the kept nodes: blocks in page order, one line each."""
    parts: dict[int, list[tuple[int, str]]] = {}
    for k, node in enumerate(nodes):
        if keep[k]:
            for number, text in node.runs:
                parts.setdefault(number, []).append((k, text))
    lines = (_SPACE.sub(" ", "".join(t for _, t in parts[n])).strip() for n in sorted(parts))
    return "\n".join(line for line in lines if line)


TAGS = ("page html body main article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table tr "
        "td th blockquote pre figure figcaption header footer nav aside form button fieldset "
        "menu details address span dialog").split()
_TAG_PLACE = {t: i for i, t in enumerate(TAGS)}
#: Groups of couplings between an element and its parent.
GROUPS = {"p": 0, "h1": 0, "h2": 0, "h3": 0, "h4": 0, "h5": 0, "h6": 0, "blockquote": 0, "pre": 0,
          "ul": 1, "ol": 1, "li": 1, "dl": 1, "dt": 1, "dd": 1, "table": 1, "tr": 1, "td": 1,
          "th": 1, "tbody": 1, "thead": 1}
N_GROUPS = 3
N_SHAPE = 12
N_FEATURES = len(TAGS) + 1 + N_SHAPE + 1


def features(nodes: list[Node], names: dict[str, int]) -> list[list[int]]:
    """Numbers of the binary features that each element has: its tag, the size of its own text
    and of all text below it, the share of links, and those of its class's ``names``.

    Paragraphs and lists follow what holds them, so their sizes don't tell; a paragraph without a
    class tells nothing, however many there are."""
    n = len(nodes)
    own = [sum(len(t) for _, t in x.runs) for x in nodes]
    links = [x.link_chars for x in nodes]
    below = own[:]
    below_links = links[:]
    for k in range(n - 1, 0, -1):
        below[nodes[k].parent] += below[k]
        below_links[nodes[k].parent] += below_links[k]
    total = max(below[0], 1)
    base = len(TAGS) + 1
    result = []
    for k, x in enumerate(nodes):
        linked = below_links[k] / max(below[k], 1)
        mine = sorted({N_FEATURES + names[w] for w in x.names if w in names})
        if x.tag != "p":
            mine += [_TAG_PLACE.get(x.tag, len(TAGS)), N_FEATURES - 1,
                     base + 7 + (0 if linked < 0.2 else 1 if linked < 0.6 else 2)]
        if x.tag not in GROUPS:
            mine += [base + (0 if own[k] == 0 else 1 if own[k] < 40 else 2 if own[k] < 160 else 3),
                     base + 4 + (0 if below[k] < 60 else 1 if below[k] < 400 else 2),
                     base + 10 + (below[k] > 0.4 * total)]
        result.append(mine)
    return result


def groups(nodes: list[Node]) -> np.ndarray:
    return np.array([GROUPS.get(x.tag, 2) for x in nodes], np.int64)
