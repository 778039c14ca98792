"""Archives and rendering of pages."""

import base64
import collections
import hashlib
import io
import time

import pytest
import zstandard
from pyspark.sql import functions as F

from kelpline.llm import html_text, warc
from kelpline.session import scratch_folder

PAGES = [
    (1, "http://a/", "<p>same</p>"),
    (2, "http://b/\r\nX: y", "<p>same</p>"),
    (5, None, "<p>same</p>"),
    (3, "http://c/", None),
    (4, "http://d/", ""),
    (6, "http://e/", "é" * 200_000),
    (None, "http://f/", "no id"),
    (7, "http://g/", "twice"),
    (7, "http://g/", "twice"),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*p, "x", "y") for p in PAGES], "page_id long, url string, html string, frame string, _id string").repartition(2)


def digest(text):
    return base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()


def expected_records(pages, least=0):
    groups = collections.defaultdict(list)
    for i, _, html in pages:
        groups[html or ""].append(i)
    out = []
    for html, ids in groups.items():
        known = [i for i in ids if i is not None]
        for i in ids:
            last = max(known) if known and len(html.encode()) >= least else None
            other = last is not None and i != last
            out.append((i, len(html.encode()), digest(html), "revisit" if other else "response", last if other else None))
    return collections.Counter(out)


@pytest.mark.parametrize("least", [0, 6])
def test_records(pages, least):
    assert collections.Counter(map(tuple, warc.page_records(pages, least).collect())) == expected_records(PAGES, least)


def test_given_pages(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    rows = [(r.page_id, r.url, r.html) for r in pages.select("page_id", "url", "html").collect()]
    assert collections.Counter(map(tuple, warc.page_records(pages).collect())) == expected_records(rows)


def test_no_pages(pages):
    assert warc.page_records(pages.where("false")).count() == 0


def test_bundles_are_seekable(spark, pages):
    """Any reader reads a whole bundle; a selection of the index opens only its frames."""
    folder = scratch_folder(spark)
    index = warc.write_bundles(pages, folder, frame_bytes=300, bundle_bytes=500)
    rows = index.collect()
    assert len({r.bundle for r in rows}) > 1
    for bundle in {r.bundle for r in rows}:
        with open(f"{folder.removeprefix('file:')}/{bundle}", "rb") as file:
            data = file.read()
        whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
        assert whole.count(b"WARC/1.1\r\n") == sum(r.bundle == bundle for r in rows)
        reader = warc.BundleReader(folder, bundle)
        assert b"".join(reader.frame(i) for i in range(len(reader.places))) == whole
    one = warc.read_records(index.where(F.col("record_id") == "urn:kelp:6"), folder).collect()
    assert len(one) == 1 and bytes(one[0].payload).decode() == "é" * 200_000 and one[0].uri == "http://e/"
    lines = {r.record_id: r.uri for r in warc.read_records(index, folder).collect()}
    assert lines["urn:kelp:2"] == "http://b/  X: y" and lines["urn:kelp:null"] == "http://f/"


def test_damaged_bundles_are_told(tmp_path):
    writer = warc.BundleWriter(str(tmp_path), "x", 100, 1000)
    place = writer.add(warc.write_record("urn:kelp:1", "u", b"body", warc.payload_digest(b"body"), 4, None))
    writer.close()
    reader = warc.BundleReader(str(tmp_path), place[0])
    fields, body = warc.parse_record(reader.frame(0))
    assert body == b"body" and fields["WARC-Type"] == "response"
    with pytest.raises(ValueError):
        warc.parse_record(reader.frame(0)[:-1])
    (tmp_path / "y").write_bytes(b"no bundle, and long enough")
    with pytest.raises(ValueError):
        warc.BundleReader(str(tmp_path), "y")


RENDERED = [
    ("<p>a<p>b", "a\n\nb"),
    ("<ul><li>x<li>y<ul><li>z</ul><li>w</ul>after", "* x\n* y\n  * z\n* w\n\nafter"),
    ("<ol start=3><li>x<li value=7>y<li>z</ol>", "3. x\n7. y\n8. z"),
    ("<table><tr><th>Name<th>N<tr><td>a long name<td>1<tr><td>b<td>22</table>", "Name         N\na long name  1\nb            22"),
    ("<table><caption>C</caption><tr><td colspan=2>wide cell here<td>e<tr><td>a<td>b<td>c</table>", "C\nwide cell here  e\na  b            c"),
    ("<table><tr><td rowspan=2>r<td>1<tr><td>2</table>", "r  1\n   2"),
    ("<table><thead><tr><td>h<tbody><tr><td>b<tfoot><tr><td>f</table>", "h\nb\nf"),
    ("<table><td>no row</table>", "no row"),
    ("<table>foster<tr><td>x</table>", "foster\n\nx"),
    ("<table><tr><td><table><tr><td>i<td>j</table><td>k</table>", "i  j  k"),
    ("<div>a<div>b</div>c</div>d", "a\nb\nc\nd"),
    ("<head><title>t</title></head><body>x<script>var a='</p>';</script>y<style>p{}</style><!-- c -->z", "xyz"),
    ("x<span hidden>no</span><i style='display: none'>no<b>no</b></i><template>no</template>y", "xy"),
    ("<div style='visibility:hidden'>no<b style='visibility:visible'>yes</b></div>", "yes"),
    ("a &amp; b &lt;c&gt; &copy;", "a & b <c> ©"),
    ("<pre>a\n  b\n\nc</pre>d", "a\n  b\n\nc\n\nd"),
    ("<textarea>a\n b</textarea>", "a\n b"),
    ("a<br>b<br><br>c", "a\nb\n\nc"),
    ("1 < 2 and <b>bold", "1 < 2 and bold"),
    ('<a href="x>y">t</a>', "t"),
    ("</p>x</i></div>y", "xy"),
    ("<dl><dt>t<dd>d<dt>u<dd>e</dl>", "t\n  d\nu\n  e"),
    ("<blockquote><p>q<p>r</blockquote>s", "  q\n\n  r\n\ns"),
    ("<ul><li><p>one<p>two<li>three</ul>", "* one\n\n  two\n\n* three"),
    ("<select><option>a<option>b</select>", "a\nb"),
    ("<input type=submit value=Go><input type=hidden value=no>", "Go"),
    ("x <b> y </b> z", "x y z"),
    ("", ""),
    ("<p", ""),
    ("<!-- never ends", ""),
    ("a<script>never ends", "a"),
]


@pytest.mark.parametrize("page, text", RENDERED)
def test_render(page, text):
    assert html_text.render(page) == text


def test_text_of_drawings_and_maps():
    drawn = "<svg><title>no</title><defs><text>no</text></defs><defs/><g>no<text>one <tspan>two</tspan><title>no</title></text><text>three</text><desc>no</desc></g></svg>"
    assert html_text.render(f"a{drawn}b<map name=m>c<area>d</map>").split() == "a one two three bcd".split()
    assert html_text.render("<svg style='display:none'><text>no</text></svg><svg><text hidden>no</text></svg>x").split() == ["x"]
    assert html_text.render("<svg><foreignObject><p>shown</p></foreignObject></svg>").split() == ["shown"]


def test_deep_and_broken_pages_take_linear_time():
    for page in ("<b>" * 50_000 + "</i>" * 50_000 + "x", "<div>" * 50_000 + "x", '<a href="' * 20_000):
        html_text.render(page)
    assert html_text.render("<table><tr><td>" * 500 + "x").strip() == "x"


@pytest.mark.parametrize(
    "page, text",
    [
        ("<p style='backface-visibility:hidden'>a", "a"),
        ("<p style='--x:display:none'>a", "a"),
        ("<p style='display:none;display:block'>a", "a"),
        ("<p style='display:none!important;display:block'>a</p>b", "b"),
        ("<p style='display:block;display:none'>a</p>b", "b"),
        ("<p style='display:none;display:nonsense'>a</p>b", "b"),
        ("<p style='/* display:none */ visibility:hidden;visibility:visible'>a", "a"),
        ("<p hidden style='display:block'>a", "a"),
        ("<input type=text value='a'><input type=hidden value=b><input type=password value=c>", "a"),
        ("<dialog>a</dialog><dialog open>b</dialog>", "b"),
        ("<details>a<summary>b</summary>c<summary>d</summary></details>e", "b\ne"),
        ("<details open>a<summary>b</summary>c</details>", "a\nb\nc"),
        ("<details><div><summary>a</summary></div><details><summary>b</summary></details></details>c", "c"),
        ("<ruby>a<rp>(</rp><rt>b</rt><rp>)</rp></ruby>", "ab"),
        ("<table><tr><td rowspan=2>a<td colspan=2>bb<tr><td>c<td>d</table>", "a  bb\n   c  d"),
    ],
)
def test_what_browsers_show(page, text):
    assert html_text.render(page) == text


def test_time_and_size_of_spans_and_nesting():
    def seconds(page):
        begin = time.perf_counter()
        size = len(html_text.render(page))
        assert size < 40 * len(page)
        return time.perf_counter() - begin

    for piece in ("<tr><td rowspan=1000 colspan=1000>x", "<ul><li>x", "<td>x", "<td rowspan=1000>x<br>y", "<blockquote>x"):
        small, large = (seconds("<table><tr>" * (piece[1] == "t") + piece * n) for n in (1000, 8000))
        assert large < 24 * small + 0.5, piece


def test_visible_text(spark, pages, sf_dir):
    found = {r.page_id: r.text for r in html_text.visible_text(pages).collect()}
    assert found[1] == "same" and found[3] == found[4] == "" and found[None] == "no id"
    assert html_text.visible_text(pages).count() == len(PAGES)
    assert html_text.visible_text(pages.where("false")).count() == 0


def test_given_pages_keep_every_visible_word(spark, sf_dir):
    """Against a plain reader: all text outside the head, scripts and styles, in order."""
    from html.parser import HTMLParser

    class Plain(HTMLParser):
        def __init__(self):
            super().__init__()
            self.out, self.off = [], 0

        def handle_starttag(self, tag, attrs):
            self.off += tag in ("script", "style", "title")

        def handle_endtag(self, tag):
            self.off -= tag in ("script", "style", "title")

        def handle_data(self, data):
            if not self.off:
                self.out.append(data)

    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    pages_by_id = {r.page_id: r.html for r in pages.collect()}
    for r in html_text.visible_text(pages).collect():
        plain = Plain()
        plain.feed(pages_by_id[r.page_id])
        plain.close()
        bare = lambda t: "".join(t.split()).replace("*", "")
        assert bare(r.text) == bare("".join(plain.out))
