import gzip
import html
import html.parser
import zlib

from brute import table_rows

from tidemark.llm import warc_derivatives as op


def response(payload, http=("Content-Type: text/html; charset=utf-8",), warc=(), kind="response"):
    block = b"\r\n".join([b"HTTP/1.1 200 OK", *(h.encode() for h in http)]) + b"\r\n\r\n" + payload
    headers = [("WARC-Type", kind), ("WARC-Record-ID", "<urn:uuid:1>"), ("WARC-Target-URI", "http://a/"),
               ("WARC-Date", "2020-01-01T00:00:00Z"), *warc, ("Content-Length", str(len(block)))]
    return op.write_record(headers, block)


def test_source_table(spark):
    pages = {r.page_id: r for r in table_rows(spark, "pages")}
    source = op.page_responses(spark.read.parquet("/root/testdata/sf0.001/pages.parquet"))
    records = {r.page_id: r.record for r in source.collect()}
    out = op.derivatives(source, ("page_id",)).collect()
    assert sorted((r.page_id, r.warc_type) for r in out) == sorted(
        (i, kind) for i in pages for kind in ("conversion", "metadata"))
    for r in out:
        given, made = op.read_record(records[r.page_id]), op.read_record(bytes(r.record))
        payload = op.read_response(given.block).payload
        assert payload.decode() == pages[r.page_id].html
        assert made.get("WARC-Refers-To") == given.get("WARC-Record-ID") == r.refers_to
        assert made.get("WARC-Record-ID") == r.record_id != r.refers_to
        assert made.get("WARC-Target-URI") == pages[r.page_id].url
        assert made.get("WARC-Refers-To-Payload-Digest") == op.digest(payload) == r.source_digest
        assert made.get("WARC-Block-Digest") == op.digest(made.block)
        assert made.block.decode() == r.block and r.verified
        if r.warc_type == "metadata":
            lines = dict(line.split(": ", 1) for line in r.block.split("\r\n") if line)
            for name, value in given.headers:
                assert lines[f"warc-header-{name.lower()}"] == value
        else:
            assert "<p>" not in r.block and "track(" not in r.block
    assert len({r.record_id for r in out}) == len(out)


def test_plain_text():
    html = "<head><title>t</title></head><p>a &amp; b<br>c</p><script>x</script><!-- no --><li>1<li>2 <b>3</b>"
    assert op.plain_text(html) == "a & b\nc\n1\n2 3"
    assert op.plain_text("") == "" and op.plain_text("1 < 2") == "1 < 2"


def text_of(record):
    return {kind: block for kind, *_, block, _ in op.derive(record)}


def test_encodings():
    chunks = b"3\r\nabc\r\n2;x=y\r\nde\r\n0\r\n\r\n"
    plain = ("Content-Type: text/plain; charset=latin-1",)
    assert text_of(response("é".encode("latin-1"), plain))["conversion"] == "é"
    assert text_of(response(chunks, (*plain, "Transfer-Encoding: chunked")))["conversion"] == "abcde"
    packed = gzip.compress(b"<p>zipped")
    assert text_of(response(packed, ("Content-Type: text/html", "Content-Encoding: gzip")))["conversion"] == "zipped"
    assert text_of(response(b"raw", (*plain, "Content-Encoding: gzip")))["conversion"] == "raw"
    assert text_of(response(b"x", ("Content-Type: text/plain; charset=nonsense",)))["conversion"] == "x"
    assert set(text_of(response(b"\x89PNG", ("Content-Type: image/png",)))) == {"metadata"}


def test_packed_bodies_that_do_and_do_not_unpack(monkeypatch):
    kind = "Content-Type: text/html"
    page = b"<p>" + b"some words " * 500
    want = " ".join(["some words"] * 500)
    raw = zlib.compressobj(wbits=-15)
    for coding, body in (
        ("gzip", gzip.compress(page)), ("x-gzip", gzip.compress(page[:9]) + gzip.compress(page[9:])),
        ("deflate", zlib.compress(page)), ("deflate", raw.compress(page) + raw.flush()), ("identity", page),
        ("deflate, gzip", gzip.compress(zlib.compress(page))),
    ):
        assert text_of(response(body, (kind, f"Content-Encoding: {coding}")))["conversion"] == want
    for coding, body, why in (
        ("br", b"\x0b\x02\x80", "unknown coding br"), ("gzip", gzip.compress(page)[:60], "broken"),
        ("deflate", b"\xff\xfe\xfd", "broken"), ("gzip", b"\x1f\x8bjunk", "broken"),
    ):
        made = text_of(response(body, (kind, f"Content-Encoding: {coding}")))
        assert set(made) == {"metadata"} and f"body-not-decoded: {why}\r\n" in made["metadata"]
    monkeypatch.setattr(op, "MOST_BYTES", 4000)
    made = text_of(response(gzip.compress(page), (kind, "Content-Encoding: gzip")))
    assert set(made) == {"metadata"} and "body-not-decoded: too large" in made["metadata"]


def test_characters():
    page = "<meta charset='{}'><p>é</p>"
    kind = ("Content-Type: text/html",)
    assert text_of(response(page.format("latin-1").encode("latin-1"), kind))["conversion"] == "é"
    assert text_of(response(page.format("latin-1").encode(), ("Content-Type: text/html; charset=utf-8",)))["conversion"] == "é"
    assert text_of(response("<?xml version='1.0' encoding='cp1252'?><p>é".encode("cp1252"), ("Content-Type: text/xml",)))["conversion"] == "é"
    for codec in ("utf-8-sig", "utf-16"):
        assert text_of(response(page.format("latin-1").encode(codec), kind))["conversion"] == "é"


def test_tags_end_outside_quotes():
    assert op.plain_text('<p title="a > b">x</p>') == "x"
    assert op.plain_text("<a href='>' class=b>y</a><DIV data-x=\"1>2\"/>z") == "y\nz"
    assert op.plain_text('<p title="never ends>text<b>more</b>') == "textmore"
    assert op.plain_text("a <b c") == "a" and op.plain_text("2 < 3 <!x> </> &lt;p&gt;") == "2 < 3 <p>"


class Reader(html.parser.HTMLParser):
    """Another reading of the same rule, by the parser of the standard library."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.silent = [], 0

    def handle_starttag(self, tag, attrs):
        self.silent += tag in ("script", "style", "title", "template", "noscript")
        self.out.append("\n" if tag in op._BREAKING else "")

    def handle_endtag(self, tag):
        self.silent -= tag in ("script", "style", "title", "template", "noscript")
        self.out.append("\n" if tag in op._BREAKING else "")

    def handle_data(self, data):
        self.out.append(" " if self.silent else data.replace("\n", " "))


def test_conversions_of_source_pages_equal_another_reading(spark):
    for r in table_rows(spark, "pages"):
        reader = Reader()
        reader.feed(r.html)
        reader.close()
        lines = (" ".join(x.split()) for x in "".join(reader.out).split("\n"))
        assert op.plain_text(r.html) == "\n".join(x for x in lines if x)


def test_digests_are_preserved_and_compared():
    right = op.digest(b"x")
    for stated, verified in ((right, True), (right.lower(), True), ("sha1:AAAA", False), (None, None)):
        warc = [("WARC-Payload-Digest", stated)] if stated else []
        for row in op.derive(response(b"x", warc=warc)):
            assert row[5] == (stated or right) and row[6] is verified


def test_odd_rows(spark):
    rows = [(1, None), (2, b""), (3, b"junk"), (4, b"WARC/1.1\r\n"), (5, response(b"x", kind="request")),
            (6, response(b"")), (6, response(b"")), (None, response(b"<p>long " + b"word " * 200_000))]
    frame = spark.createDataFrame([(i, bytearray(b) if b is not None else None) for i, b in rows], "n long, record binary")
    frame = frame.selectExpr("n", "record", "1 AS record_id", "'x' AS block")
    out = op.derivatives(frame, ("n",)).collect()
    assert sorted((r.n or 0, r.warc_type) for r in out) == [
        (0, "conversion"), (0, "metadata"), *[(6, "conversion")] * 2, *[(6, "metadata")] * 2]
    assert {r.block for r in out if r.n == 6 and r.warc_type == "conversion"} == {""}
    assert op.derivatives(frame.limit(0), ("n",)).count() == 0
    pages = spark.createDataFrame([(1, None, None), (2, "u", "")], "page_id long, url string, html string")
    assert op.derivatives(op.page_responses(pages), ("page_id",)).count() == 4
