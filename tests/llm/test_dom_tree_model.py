import itertools
import math
import re

import pytest
from brute import table_rows

from tidemark.llm import dom
from tidemark.llm import dom_tree_model as op

MODEL = op.fit(op.labelled_pages())


def plain_article(html):
    """Text of <article> for the simple pages of the source table."""
    import html as H

    body = re.search(r"<article>(.*?)(</article>|$)", html, re.S).group(1)
    body = re.sub(r"<(/?)(p|h1)>", "\0", body.replace("<br>", " ").replace("<b>", ""))
    lines = (" ".join(H.unescape(b).split()) for b in body.split("\0"))
    return "\n\n".join(x for x in lines if x)


def test_source_table(spark):
    sf = "/root/testdata/sf0.01"
    html = {r.page_id: r.html for r in table_rows(spark, "pages", sf)}
    out = op.extract_pages(spark.read.parquet(f"{sf}/pages.parquet")).collect()
    assert {r.page_id: r.text for r in out} == {i: plain_article(h) for i, h in html.items()}
    assert all(r.n_chars == len(r.text) for r in out)


def wanted(html):
    page = dom.read(html)
    said = []
    for node in page.nodes:
        own = node.attributes.get("data-label")
        said.append(own == "content" if own else bool(said and said[node.parent]))
    return dom.join_runs(page, said)


def test_held_out_layouts():
    """Word-level precision and recall on pages that were not trained on."""
    right = found = there = 0
    for html in op.labelled_pages(150, seed=987):
        want = wanted(html).split()
        got = MODEL.extract(re.sub(r' data-label="\w+"', "", html)).split()
        from collections import Counter

        right += sum((Counter(want) & Counter(got)).values())
        found += len(got)
        there += len(want)
    assert right / found > 0.95 and right / there > 0.95


@pytest.mark.parametrize("html", [
    "<div class=post><h1>one two</h1><p>some words here.</p><div class=ad>buy</div></div><footer>x y</footer>",
    "<nav><a href=/>a</a></nav><p>text, text. more text.</p>",
    "plain words",
])
def test_marginals_equal_summing_over_all_labellings(html):
    page = dom.read(html)
    nodes = [k for k, n in enumerate(page.nodes) if n.words]
    total, on = 0.0, dict.fromkeys(nodes, 0.0)
    for labels in itertools.product((0, 1), repeat=len(nodes)):
        y = dict(zip(nodes, labels, strict=True))
        log = 0.0
        for k in nodes:
            odds = sum(MODEL.weights.get(f, 0.0) for f in op.features(page.nodes[k]))
            log += y[k] * max(-12.0, min(12.0, odds))
            if k:
                edge = MODEL.edges.get(page.nodes[k].tag, MODEL.default)
                log += edge[y[page.nodes[k].parent]][y[k]]
        total += math.exp(log)
        for k in nodes:
            on[k] += y[k] * math.exp(log)
    got = MODEL.marginals(page)
    for k in nodes:
        assert abs(got[k] - on[k] / total) < 1e-9


ARTICLE = "".join(f"<p>Sentence number {k}, with some more words in it. And another.</p>" for k in range(5))
TEXT = "\n\n".join(f"Sentence number {k}, with some more words in it. And another." for k in range(5))


@pytest.mark.parametrize("around", [
    "<header><h2>Site name</h2></header><article>{}</article>",
    "<article>{}<section id=comments><p>I think this is a fine piece, thanks for it.</p></section></article>",
    "<div class='cookie-notice'><p>We use cookies, and so on.</p></div><main>{}</main>",
    "<div id=sidebar><p>Read this too.</p></div><div class=content>{}</div><div class=footer>End</div>",
    "<article><script>var a='<p>no</p>';</script><style>p{{}}</style>{}<form><p>Mail us.</p><input></form></article>",
    "<nav><ul><li><a href=/>Home</a></li></ul></nav><article>{}</article><aside><p>Related things.</p></aside>",
    "<div class=post><div class='ad'>Buy this now, it is cheap.</div>{}</div>",
])
def test_other_parts_are_left_out(around):
    assert MODEL.extract(f"<html><body>{around.format(ARTICLE)}</body></html>") == TEXT


def test_white_space_and_references():
    html = "<article><p>a &amp; b&nbsp;&nbsp;c\n\t d<br>e &#233;&#x41; <i>f</i>g</p>\n<p> </p><p>1 &lt; 2"
    assert MODEL.extract(html) == "a & b c d e éA fg\n\n1 < 2"


def test_odd_rows(spark):
    rows = [(1, None, None), (2, "u", ""), (None, "v", "<article><p>Some words.</p></article>"),
            (4, "w", "<p>" * 3000 + "deep"), (4, "w", "<<>><a <b"), (5, "x", "<div>" * 2000 + "words" + "</p>" * 9)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    out = op.extract_pages(frame.selectExpr("*", "1 AS text", "2 AS n_chars"), MODEL).collect()
    assert len(out) == 6
    by = {r.url: r.text for r in out}
    assert by[None] == by["u"] == "" and by["v"] == "Some words."
    assert op.extract_pages(frame.limit(0), MODEL).count() == 0


def test_very_long_page():
    html = "<article>" + "<p>Word after word, and so on.</p>" * 30_000 + "</article>"
    assert MODEL.extract(html).count("\n\n") == 29_999
