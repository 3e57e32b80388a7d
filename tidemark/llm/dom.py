"""A small forgiving HTML reader: elements that hold text, and runs of text in page order."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?>[^'\">]+|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(
    r"([a-zA-Z][\w:-]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.S
)
_BLANKS = re.compile(r"\s+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements whose text is no text of the page.
SILENT = frozenset(
    "script style title noscript template svg math iframe object select option textarea button "
    "head datalist canvas audio video".split()
)
RAW = frozenset(("script", "style", "title", "textarea", "iframe", "noscript", "template"))
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby "
    "s samp small span strike strong sub sup time tt u var td th wbr br img nobr".split()
)
_CLOSED_BY = {
    "li": frozenset(("li",)),
    "dt": frozenset(("dt", "dd")),
    "dd": frozenset(("dt", "dd")),
    "tr": frozenset(("tr", "td", "th")),
    "td": frozenset(("td", "th")),
    "th": frozenset(("td", "th")),
}
_SCOPE = {
    "li": frozenset(("ul", "ol")),
    "dt": frozenset(("dl",)),
    "dd": frozenset(("dl",)),
    "tr": frozenset(("table",)),
    "td": frozenset(("table",)),
    "th": frozenset(("table",)),
}


@dataclass
class Node:
    tag: str
    parent: int
    attributes: dict[str, str]
    words: int = 0
    linked: int = 0
    stops: int = 0
    """Of all text below: words, words in links, sentence ends."""


@dataclass
class Page:
    nodes: list[Node] = field(default_factory=list)
    """Elements, parents first: blocks, and inline elements that have a class, id or role."""
    runs: list[tuple[int, str]] = field(default_factory=list)
    """Text by element; neighbouring runs of one block are one run."""
    blocks: list[int] = field(default_factory=list)
    """For each run the number of its block in page order."""


def _attributes(text: str) -> dict[str, str]:
    out: dict[str, str] = {}
    if text.strip("/ \n\t"):
        for name, *values in _ATTRIBUTE.findall(text):
            out.setdefault(name.lower(), unescape("".join(values)))
    return out


def read(html: str) -> Page:
    page = Page([Node("#root", -1, {})])
    stack: list[tuple[str, int, bool]] = [("#root", 0, False)]  # tag, node, silent
    links = block = at = 0
    fresh = True  # the next text begins a new block

    def text(raw: str):
        nonlocal fresh, block
        if stack[-1][2] or not raw:
            return
        words = unescape(raw) if "&" in raw else raw
        if not words.strip():
            # Blanks between words of one block still count as one.
            if not fresh and page.runs:
                page.runs[-1] = (page.runs[-1][0], page.runs[-1][1] + " ")
            return
        if fresh:
            block += 1
            fresh = False
        node = stack[-1][1]
        page.runs.append((node, words))
        page.blocks.append(block)
        own = page.nodes[node]
        n = len(words.split())
        own.words += n
        own.linked += n if links else 0
        own.stops += sum(words.count(c) for c in ".!?;:")

    def close(depth: int):
        nonlocal links, fresh
        while len(stack) > depth:
            tag = stack.pop()[0]
            links -= tag == "a"
            fresh = fresh or tag not in INLINE

    def space():
        if not fresh and page.runs:
            page.runs[-1] = (page.runs[-1][0], page.runs[-1][1] + " ")

    size = len(html)
    while at < size:
        sign = html.find("<", at)
        if sign < 0:
            text(html[at:])
            break
        found = _TOKEN.match(html, sign)
        if not found:
            text(html[at : sign + 1])
            at = sign + 1
            continue
        text(html[at:sign])
        at = found.end()
        if not (tag := found["tag"]):
            continue
        tag = tag.lower()
        if found["end"]:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == tag:
                    close(depth)
                    break
            if tag in ("td", "th"):
                space()
            continue
        if tag not in INLINE:
            # A block ends an open paragraph, and an open head.
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == "p" or (stack[depth][0] == "head" and tag not in SILENT | VOID):
                    close(depth)
                    break
                if stack[depth][0] not in INLINE:
                    break
            fresh = True
        if tag in ("br", "td", "th"):
            space()
        if tag in _CLOSED_BY:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] in _CLOSED_BY[tag]:
                    close(depth)
                    break
                if stack[depth][0] in _SCOPE[tag]:
                    break
        if tag in VOID:
            continue
        own = stack[-1][1]
        silent = stack[-1][2] or tag in SILENT
        if not silent:
            attributes = _attributes(found["rest"])
            if tag not in INLINE or attributes.keys() & {"class", "id", "role"}:
                page.nodes.append(Node(tag, own, attributes))
                own = len(page.nodes) - 1
        if found["rest"].endswith("/") and tag in SILENT:
            continue
        stack.append((tag, own, silent))
        links += tag == "a"
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(html, at)
            at = end.end() if end else size
            close(len(stack) - 1)
    for k in range(len(page.nodes) - 1, 0, -1):
        own, up = page.nodes[k], page.nodes[page.nodes[k].parent]
        up.words += own.words
        up.linked += own.linked
        up.stops += own.stops
    return page


def join_runs(page: Page, keep: list[bool]) -> str:
    """Text of the kept elements: blanks made one inside a block, blocks two line ends apart."""
    blocks: dict[int, str] = {}
    for (node, words), block in zip(page.runs, page.blocks, strict=True):
        if keep[node]:
            blocks[block] = blocks.get(block, "") + words
    lines = (_BLANKS.sub(" ", b).strip() for b in blocks.values())
    return "\n\n".join(line for line in lines if line)
