import html
from html.parser import HTMLParser

from pyspark.sql import functions as F

from postmill.functions.html import decode_references, html_to_text


PAGES = [
    ("<p>a</p><p>b</p>", "a b"),
    ("<b>a</b>\n<i>b</i>", "a \n b"),
    ("<title>t</title><body>x<br>y</body>", "t x y"),
    ("a<!-- <p>no</p> -->b", "a b"),
    ("a<script>var s = '<!--</p>';</script>b", "a b"),
    ("<STYLE type='x'>p{}</STYLE >a", "a"),
    ("a<script src='x'>", "a"),
    ("<template><p>no</p></template>a", "a"),
    ("<a title='x>y' href=\"a>b\">c</a>", "c"),
    ("<p title=it's>a</p>", "a"),
    ("1 < 2 and 3 > 2", "1 < 2 and 3 > 2"),
    ("<!DOCTYPE html><?xml x?>a", "a"),
    ("a<p class=", "a"),
    ("&lt;b&gt; &amp;lt; &eacute;&#233;&#xE9;&#x1F600;", "<b> &lt; \u00e9\u00e9\u00e9\U0001f600"),
    ("a &unknown; b & c &amp", "a &unknown; b & c &amp"),
    ("x&#0;y&#xD800;z&#99999999999;", "xyz"),
    ("plain", "plain"),
    ("", ""),
]


def test_html_to_text(apply):
    pages, expected = zip(*PAGES, strict=True)
    assert apply(html_to_text, pages) == list(expected)


def test_references_match_the_standard_table(apply):
    texts = ["&nbsp;&copy;&Alpha;&hellip;&euro;", "a&amp;amp;b", "&&;&#;&#x;", "&#65;&#066;&#x43;"]
    assert apply(decode_references, texts) == [html.unescape(t) for t in texts]


class _Text(HTMLParser):
    def __init__(self):
        super().__init__()
        self.parts, self.skipped = [], 0

    def handle_starttag(self, tag, attrs):
        self.skipped += tag in ("script", "style")

    def handle_endtag(self, tag):
        self.skipped -= tag in ("script", "style") and self.skipped > 0

    def handle_data(self, data):
        if not self.skipped:
            self.parts.append(data)


def test_pages_match_a_parser(spark):
    """All pages against the standard library's parser, up to whitespace."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = pages.select("html", html_to_text(F.col("html")).alias("text")).collect()
    for row in rows:
        parser = _Text()
        parser.feed(row.html)
        parser.close()
        assert row.text.split() == " ".join(parser.parts).split()


def test_ruby_and_western_numbers(apply):
    pages = [
        ("<ruby>a<rp>(</rp><rt>b</rt><rp>)</rp></ruby> c", "a  c"),
        ("<ruby>a<rp>(<rt>b<b>x</b><rp>)</ruby>c<p>rt", "a c rt"),
        ("a<rt>b", "a"),
        ("a<rtx>b", "a b"),
        ("&#128;&#x92;&#129;&#159;", "\u20ac\u2019\x81\u0178"),
        ("a<rt>" + "<b" * 50_000, "a"),
    ]
    markup, expected = zip(*pages, strict=True)
    assert apply(html_to_text, markup) == list(expected)


def test_sql_walks_the_same_pages(apply, tmp_path):
    """The check's own walk through a page, on odd markup."""
    import random

    import duckdb
    import pyarrow as pa

    from postmill.plans.oracle import ORACLE

    rng = random.Random(2)
    parts = ["<p>", "</p", "<!--", "-->", "<script", "</script>", "<STYLE>", "</style ", "<rt>", "</rt>", "<rp", "</ruby>"]
    parts += ["=", "'", '"', ">", "<", " ", "x", "\n", "&lt;", "&#150;", "&amp", "<!D", "<?", "/", "<a b= 'c>d'>", "</scripts>"]
    pages = [p for p, _ in PAGES] + ["".join(rng.choices(parts, k=rng.randint(1, 14))) for _ in range(400)]
    db = duckdb.connect()
    db.register("pages", pa.table({"page_id": range(len(pages)), "url": [""] * len(pages), "html": pages}))
    found = dict(db.sql(ORACLE["html_to_text"]).fetchall())
    for i, text in enumerate(apply(html_to_text, pages)):
        assert found[i] == text, pages[i]


def test_long_markup(apply):
    """Long tags, comments and tag runs must not overflow the matcher's stack."""
    pages = [
        "<p>" * 50_000 + "a",
        "<p " + "x=1 " * 50_000 + ">a",
        "<!--" + "x-" * 100_000 + "-->a",
        "<p " + 'x="1" ' * 50_000,
        "<script>" + "</script" * 50_000,
        "<script>" * 50_000,
        "<" * 100_000 + " a",
    ]
    assert apply(html_to_text, pages) == ["a", "a", "a", "", "", "", pages[-1]]
