"""Main text of web pages by a tree-structured graphical model over the DOM.

Every element that holds text is a variable: content or not. Its unary potential comes from what
the element is (tag, words in class, id and role, length, share of links, sentence ends); a
potential on each parent-child edge, by the child's tag, says how labels carry over. One sweep of
messages up the tree and one down give the exact marginals. Text is content if the marginal of
its element is above one half.

The model is counted from labelled pages: pages whose elements carry ``data-label="content"`` or
``data-label="other"``, valid for all below until another label. ``labelled_pages`` makes such
pages by rule, with invented words, over many layouts; any others can be given to ``fit``. The
number used for training is the parameter ``TRAINING_PAGES``. The model is a few hundred numbers.

Rows: a null or empty page has the empty text. Repeated rows are kept. Other columns are ignored.
"""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import dom
from tidemark.llm.common import map_batches

TRAINING_PAGES = 400
SEED = 11
TEXT_WEIGHT = 0.5
"""Weight of what an element's text is like; a parent's parts say that again, one by one."""
_WORD = re.compile(r"[a-z]+")
_STRONGEST = 12.0


def features(node: dom.Node) -> list[str]:
    tokens = set()
    for name in ("class", "id", "role", "itemprop"):
        value = re.sub(r"([a-z])([A-Z])", r"\1 \2", node.attributes.get(name, ""))
        tokens.update(_WORD.findall(value.lower()))
    size = min(7, node.words.bit_length())
    linked = 0 if not node.words else math.ceil(4 * node.linked / node.words)
    ends = "ends" if node.stops * 25 >= node.words and node.stops else "none"
    return [
        f"tag {node.tag}",
        *(f"is {t}" for t in sorted(tokens)),
        f"links {linked}",
        f"size {size} links {min(linked, 2)} {ends}",
    ]


def _gold(page: dom.Page) -> list[bool]:
    """Label of each element: its own words' for most of them, as labelled."""
    said: list[bool | None] = []
    for node in page.nodes:
        own = node.attributes.get("data-label")
        said.append(own == "content" if own else (said[node.parent] if said else None))
    good, all_ = [0] * len(said), [0] * len(said)
    for node, words in page.runs:
        good[node] += len(words.split()) * bool(said[node])
        all_[node] += len(words.split())
    for k in range(len(said) - 1, 0, -1):
        up = page.nodes[k].parent
        good[up] += good[k]
        all_[up] += all_[k]
    return [2 * g > a for g, a in zip(good, all_, strict=True)]


@dataclass
class TreeModel:
    weights: dict[str, float]
    """By feature: log odds of content."""
    edges: dict[str, tuple[tuple[float, float], tuple[float, float]]]
    """By the child's tag: log P(child's label | parent's label)."""
    default: tuple[tuple[float, float], tuple[float, float]]

    def marginals(self, page: dom.Page) -> list[float]:
        """Probability of content for every element, by sum-product on the tree."""
        nodes = page.nodes
        n = len(nodes)
        up0, up1 = [0.0] * n, [0.0] * n  # unary potential and all messages from below
        edge = [self.edges.get(node.tag, self.default) for node in nodes]
        to0, to1 = [0.0] * n, [0.0] * n  # message to the parent
        for k in range(n - 1, -1, -1):
            if not nodes[k].words:
                continue
            odds = sum(self.weights.get(f, 0.0) for f in features(nodes[k]))
            up1[k] += max(-_STRONGEST, min(_STRONGEST, odds))
            if k:
                (a00, a01), (a10, a11) = edge[k]
                to0[k] = _log_sum(a00 + up0[k], a01 + up1[k])
                to1[k] = _log_sum(a10 + up0[k], a11 + up1[k])
                up0[nodes[k].parent] += to0[k]
                up1[nodes[k].parent] += to1[k]
        out = [0.0] * n
        down0, down1 = [0.0] * n, [0.0] * n
        for k in range(n):
            if not nodes[k].words:
                continue
            if k:
                p = nodes[k].parent
                rest0 = up0[p] + down0[p] - to0[k]
                rest1 = up1[p] + down1[p] - to1[k]
                (a00, a01), (a10, a11) = edge[k]
                down0[k] = _log_sum(rest0 + a00, rest1 + a10)
                down1[k] = _log_sum(rest0 + a01, rest1 + a11)
                level = max(down0[k], down1[k])
                down0[k] -= level
                down1[k] -= level
            odds = up0[k] + down0[k] - up1[k] - down1[k]
            out[k] = 1 / (1 + math.exp(max(-700.0, min(700.0, odds))))
        return out

    def extract(self, html: str | None) -> str:
        if not html:
            return ""
        page = dom.read(html)
        return dom.join_runs(page, [m > 0.5 for m in self.marginals(page)])


def _log_sum(a: float, b: float) -> float:
    return a + math.log1p(math.exp(b - a)) if a > b else b + math.log1p(math.exp(a - b))


def fit(pages: Iterable[str]) -> TreeModel:
    """Counts potentials over labelled pages."""
    seen = (Counter(), Counter())
    total = [0, 0]
    moves: dict[str, list[list[float]]] = defaultdict(lambda: [[0.5, 0.5], [0.5, 0.5]])
    for html in pages:
        page = dom.read(html)
        gold = _gold(page)
        for k, node in enumerate(page.nodes):
            if not node.words:
                continue
            total[gold[k]] += 1
            seen[gold[k]].update(features(node))
            if k:
                for name in (node.tag, ""):
                    moves[name][gold[node.parent]][gold[k]] += 1
    weights = {
        f: math.log((seen[1][f] + 0.5) / (total[1] + 1)) - math.log((seen[0][f] + 0.5) / (total[0] + 1))
        for f in seen[0].keys() | seen[1].keys()
    }
    for f in weights:
        if f.startswith(("size ", "links ")):
            weights[f] *= TEXT_WEIGHT
    edges = {
        name: tuple(tuple(math.log(x / sum(row)) for x in row) for row in table)
        for name, table in moves.items()
    }
    default = edges.pop("", ((math.log(0.5),) * 2,) * 2)
    return TreeModel(weights, edges, default)


# Names under which layouts hold their parts; fixed values of the page generator.
CONTENT = (
    "article body content entry main post story text page copy section blog news columns"
).split()
PARTS = {
    "menu": ("nav", "menu nav navbar navigation topnav links breadcrumb breadcrumbs toolbar tabs"),
    "header": ("header", "header masthead top banner branding logo site title tagline"),
    "footer": ("footer", "footer bottom colophon copyright legal contentinfo imprint"),
    "sidebar": ("aside", "sidebar side secondary complementary widget rail related recommended "
                "trending popular aside teaser more tags"),
    "notice": ("div", "notice cookie cookies consent alert gdpr warning message popup modal "
               "overlay dialog privacy announcement disclaimer"),
    "advert": ("div", "ad ads adv advert advertisement advertising sponsor sponsored promo "
               "promotion banner adsense commercial"),
    "form": ("form", "form search login subscribe newsletter signup contact subscription register"),
    "comments": ("section", "comments comment discussion responses replies reply disqus respond "
                 "reviews feedback commentlist"),
    "share": ("div", "share social sharing follow buttons meta"),
}


def labelled_pages(n: int = TRAINING_PAGES, seed: int = SEED) -> Iterator[str]:
    """Pages of many layouts with invented words, labelled."""
    r = random.Random(seed)

    def words(low: int, high: int) -> str:
        out = ["".join(r.choices("etaoinshrdlu", k=r.randint(1, 9))) for _ in range(r.randint(low, high))]
        for k in range(len(out)):
            if r.random() < 0.08:
                out[k] += r.choice(".,.")
        return " ".join(out).capitalize()

    def sentence(low: int = 1, high: int = 90) -> str:
        return words(low, high) + r.choice(("." if r.random() < 0.9 else "", ".", "!", "?"))

    def links(low: int, high: int) -> str:
        return "".join(f"<li><a href=/>{words(1, 4)}</a></li>" for _ in range(r.randint(low, high)))

    def name(own: str) -> str:
        value = r.choice(own.split() if isinstance(own, str) else own)
        if r.random() < 0.4:
            value += r.choice(("-box", "-wrap", "-1", " block", "_area", "-inner", " clearfix"))
        return f' {r.choice(("class", "class", "class", "id"))}="{value}"'

    def paragraph() -> str:
        kind = r.random()
        if kind < 0.70:
            text = sentence(1, r.choice((6, 30, 90, 160)))
            if r.random() < 0.15:
                text += f" <a href=/>{words(1, 4)}</a> {sentence(1, 20)}"
            if r.random() < 0.1:
                text = f"<b>{text}</b>" if r.random() < 0.5 else f"<b>{text}<br>"
            return f"<p>{text}" + ("</p>" if r.random() < 0.9 else "")
        if kind < 0.80:
            return f"<h{(h := r.randint(2, 4))}>{words(1, 9)}</h{h}>"
        if kind < 0.87:
            items = "".join(f"<li>{sentence(1, 25)}</li>" for _ in range(r.randint(2, 5)))
            return f"<ul>{items}</ul>"
        if kind < 0.91:
            return f"<blockquote><p>{sentence(4, 40)}</p></blockquote>"
        if kind < 0.94:
            return f"<figure><img src=x><figcaption>{sentence(2, 15)}</figcaption></figure>"
        if kind < 0.97:
            cells = "".join(f"<td>{words(1, 3)}</td>" for _ in range(3))
            return f"<table><tr>{cells}</tr><tr>{cells}</tr></table>"
        return f"<pre>{words(3, 30)}</pre>"

    def part(kind: str) -> str:
        tag, names = PARTS[kind]
        tag = tag if r.random() < 0.5 else "div"
        attributes = name(names) if tag == "div" or r.random() < 0.4 else ""
        if kind == "menu":
            inner = f"<ul>{links(2, 9)}</ul>" if r.random() < 0.8 else words(1, 3)
        elif kind == "header":
            inner = r.choice((f"<h2>{words(1, 4)}</h2><p>{words(2, 9)}</p>", words(1, 5),
                              f"<div>{words(1, 4)}</div><ul>{links(2, 5)}</ul>"))
        elif kind == "footer":
            inner = r.choice((f"&copy; {words(2, 14)}", f"<p>&copy; {sentence(2, 20)}</p><ul>{links(1, 5)}</ul>",
                              f"<p>{sentence(4, 30)}</p>"))
        elif kind == "form":
            inner = f"<p>{sentence(1, 15)}</p><label>{words(1, 3)}</label><input><button>go</button>"
        elif kind == "comments":
            inner = f"<h3>{words(1, 3)}</h3>" + "".join(
                r.choice((f"<p>{sentence(2, 60)}</p>", f"<div class=comment><p>{sentence(2, 60)}</p></div>",
                          f"<ul><li>{sentence(2, 60)}</li></ul>"))
                for _ in range(r.randint(1, 6))
            )
        elif kind == "sidebar":
            inner = r.choice((f"<h3>{words(1, 4)}</h3><ul>{links(2, 7)}</ul>",
                              f"<h4>{words(1, 4)}</h4><p>{sentence(3, 40)}</p>", f"<p>{sentence(2, 30)}</p>"))
        elif kind == "share":
            inner = f"<ul>{links(1, 4)}</ul>" if r.random() < 0.6 else words(1, 6)
        else:
            inner = r.choice((sentence(1, 20), f"<p>{sentence(1, 40)}</p>",
                              f"<p>{sentence(1, 15)}</p><a href=/>{words(1, 3)}</a>"))
        return f'<{tag}{attributes} data-label="other">{inner}</{tag}>'

    def some(kinds: Iterable[str], chance: float) -> str:
        return "".join(part(k) for k in kinds if r.random() < chance)

    for _ in range(n):
        blocks = [paragraph() for _ in range(r.choice((1, 2, 4, 8, 16)))]
        for kind in ("advert", "share", "sidebar", "form", "notice"):
            if r.random() < 0.15:
                blocks.insert(r.randint(0, len(blocks)), part(kind))
        if r.random() < 0.85:
            blocks.insert(0, f"<h1>{words(1, 12)}</h1>")
        tag = r.choice(("article", "article", "main", "section", "div", "div"))
        own = name(CONTENT) if r.random() < (0.8 if tag == "div" else 0.4) else ""
        inner = "".join(blocks)
        if r.random() < 0.25:
            inner = f"<div{name(CONTENT) if r.random() < 0.5 else ''}>{inner}</div>"
        late = some(("comments",), 0.35)
        body = f'<{tag}{own} data-label="content">{inner}{late}</{tag}>'
        body += some(("comments", "share", "sidebar"), 0.25)
        if r.random() < 0.5:
            holder = r.choice(("main", "div", "div"))
            body = some(("sidebar", "advert"), 0.3) + body + some(("sidebar", "form"), 0.3)
            wrap = r.choice(("wrapper", "container", "page", "layout", "row", "content", "main"))
            body = f'<{holder} class="{wrap}">{body}</{holder}>'
        before = some(("notice", "header", "menu", "advert", "form"), 0.5)
        after = some(("advert", "notice", "menu", "footer"), 0.55)
        yield (
            f'<!DOCTYPE html><html><head><title>{words(1, 9)}</title></head>'
            f'<body data-label="other">{before}{body}{after}</body></html>'
        )


def extract_pages(pages: DataFrame, model: TreeModel | None = None) -> DataFrame:
    """Rows (page_id, url, text, n_chars) for pages (page_id, url, html)."""
    model = model or fit(labelled_pages())
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 200):
                part = batch.slice(start, 200)
                texts = [shared.value.extract(h) for h in part.column("html").to_pylist()]
                yield pa.record_batch(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())],
                    names=["page_id", "url", "text", "n_chars"],
                )

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    return map_batches(rows, work, "page_id long, url string, text string, n_chars long")
