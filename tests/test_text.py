from __future__ import annotations

from html.entities import html5
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from folioforge.functions import dates as D
from folioforge.functions import text as X
from folioforge.functions.html import html_to_text
from folioforge.schema import ACTIVE_TYPES, SearchSpec, normalize_type_codes, recorded_scope, scope_types


def one(spark, column, **values):
    frame = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]) if values else spark.range(1)
    return frame.select(column.alias("x")).first()["x"]


def test_identifiers(spark):
    assert one(spark, X.document_id(F.lit(" \tIP/26/301\n"))) == "ip_26_301"
    assert one(spark, X.normalize_ref(F.lit(" ip/26/301\t"))) == "IP/26/301"


def test_white_space_is_the_unicode_set():
    assert set(X.WHITESPACE) == {chr(c) for c in range(0x110000) if chr(c).isspace()}


def test_lists(spark):
    values = F.array(F.lit(" a "), F.lit(None), F.lit(" \t"), F.lit("b"))
    assert one(spark, X.join_nonempty(values)) == "a; b"
    assert one(spark, X.join_nonempty(F.array(F.lit(" ")))) is None
    assert one(spark, X.join_nonempty(F.lit(None).cast("array<string>"))) is None
    assert one(spark, X.split_list(F.lit("a; b"))) == ["a", "b"]
    assert one(spark, X.split_list(F.lit(None).cast("string"))) == []


@pytest.mark.parametrize(
    ("first", "last", "title", "want"),
    [
        ("Lee", "Wharf", "Press", "Lee Wharf (Press)"),
        (" Ben ", None, "", "Ben"),
        (None, " ", "Desk", "Desk"),
        ("", None, None, ""),
    ],
)
def test_contacts(spark, first, last, title, want):
    parts = [F.lit(p).cast("string") for p in (first, last, title)]
    assert one(spark, X.contact_label(*parts)) == want


@pytest.mark.parametrize(("code", "want"), [("fr", "fr"), (" fr ", "fr"), ("", "en"), ("  ", "en"), (None, "en")])
def test_language(spark, code, want):
    assert one(spark, X.record_language(F.lit(code).cast("string"), F.lit("en"))) == want


@pytest.mark.parametrize(
    ("value", "want"), [("2020-01-31", "31012020"), ("31012020", "31012020"), ("soon", None)]
)
def test_api_dates(spark, value, want):
    assert one(spark, D.format_api_date(F.lit(value))) == want


def test_type_codes():
    assert normalize_type_codes(["ip ", "Speech"]) == ("IP", "SPEECH")
    assert normalize_type_codes("active") == ACTIVE_TYPES
    assert normalize_type_codes(["Active"]) == ACTIVE_TYPES
    assert normalize_type_codes(None) == ()
    with pytest.raises(ValueError):
        normalize_type_codes(["active", "IP"])


def test_scopes():
    assert scope_types("all") == ()
    assert recorded_scope(scope_types("active")) == "active"
    assert recorded_scope(tuple(reversed(ACTIVE_TYPES))) == "all"
    with pytest.raises(ValueError):
        scope_types("some")


def test_spec_dates_are_checked():
    from datetime import date

    with pytest.raises(ValueError):
        SearchSpec(start=date(2020, 2, 1), end=date(2020, 1, 1))


class Reader(HTMLParser):
    """Brute force: an event-driven reading of the same document."""

    SILENT = {"script", "style", "template", "rt", "rp"}

    def __init__(self):
        super().__init__(convert_charrefs=False)
        self.nodes, self.current, self.open = [], "", []

    def flush(self):
        if not self.open and self.current.strip():
            self.nodes.append(self.current.strip())
        self.current = ""

    def handle_starttag(self, tag, attrs):
        self.flush()
        if tag in self.SILENT:
            self.open.append(tag)

    def handle_startendtag(self, tag, attrs):
        self.flush()

    def handle_endtag(self, tag):
        self.flush()
        if self.open and self.open[-1] == tag:
            self.open.pop()

    def handle_comment(self, data):
        self.flush()

    def handle_decl(self, decl):
        self.flush()

    def handle_pi(self, data):
        self.flush()

    def handle_data(self, data):
        self.current += data

    def handle_entityref(self, name):
        self.current += html5.get(f"{name};", f"&{name}")

    def handle_charref(self, name):
        code = int(name[1:], 16) if name[0] in "xX" else int(name)
        try:
            text = bytes([code]).decode("cp1252") if code < 256 else chr(code)
        except (UnicodeDecodeError, ValueError, OverflowError):
            text = chr(code) if 0 < code < 0x110000 else "�"
        self.current += text


def read(html: str) -> str:
    reader = Reader()
    reader.feed(html)
    reader.close()
    reader.flush()
    return "\n".join(reader.nodes)


SNIPPETS = [
    "<h1>Heading</h1><p>First <b>paragraph</b>.</p>",
    "plain text",
    "",
    "  <p>   </p>\n<p>a&nbsp;</p>",
    "a<br>b<br/>c<hr />d",
    "<p class=\"x>y\" data-a='1>2' hidden>shown</p>after",
    "x &lt;b&gt; &amp;lt; &amp;amp; y",
    "caf&eacute; &#233; &#xE9; &#146;quoted&#148; &euro;5 &#8364;",
    "AT&T, a & b, &unknown; done &copy 2020 &hellip;",
    "<!-- a > b --><p>one<!-- split -->two</p>",
    "<script>if (a < b) { x = '<p>no</p>'; }</script>yes<STYLE>p > b {}</STYLE >end",
    "<template><p>hidden</p></template>seen<ruby>kan<rt>ji</rt></ruby>",
    "1 < 2 and 3 > 2",
    "<!DOCTYPE html><?php echo 1 ?><title>T</title>",
    "<p>it's</p><p title=it's>it's two</p>",
    "emoji &#x1F600; done",
    "<textarea>kept</textarea><noscript>kept too</noscript>",
]


@pytest.mark.parametrize("html", SNIPPETS)
def test_html_equals_an_event_reader(spark, html):
    assert one(spark, html_to_text(F.lit(html))) == read(html)


@pytest.mark.parametrize(
    ("html", "want"),
    [
        ("<p>a<![CDATA[b]]>c</p>", "a\nb\nc"),
        ("<p><![CDATA[ 1 < 2 &amp; <b>x</b> ]]></p>", "1 < 2 &amp; <b>x</b>"),
        ("<![CDATA[one]]><![CDATA[]]>two ]]> three", "one\ntwo ]]> three"),
        ("<script>//<![CDATA[\nif (a < b) {}\n//]]></script>seen", "seen"),
        ("<!-- <![CDATA[ x --> seen", "seen"),
        ("open <![CDATA[to the end", "open\nto the end"),
    ],
)
def test_cdata_is_text(spark, html, want):
    assert one(spark, html_to_text(F.lit(html))) == want


def test_null_html_is_empty_text(spark):
    assert one(spark, html_to_text(F.lit(None).cast("string"))) == ""


def test_long_documents_do_not_overflow_the_matcher(spark):
    attributes = " ".join(f'a{i}="{i}>{i}"' for i in range(20_000))
    html = f"<p {attributes}>text</p>" + "<b>&amp;x</b>" * 20_000 + "<script>" + "x<y " * 100_000 + "</script>end"
    got = one(spark, html_to_text(F.lit(html)))
    assert got == "text\n" + "&x\n" * 20_000 + "end"


def test_pages_equal_an_event_reader(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select(
        "html", html_to_text(F.col("html")).alias("text")
    )
    assert all(read(row.html) == row.text for row in rows.collect())


def test_zero_padded_references_keep_their_character(spark):
    from folioforge.functions.html import html_to_text

    row = spark.createDataFrame([("a&#0000000065;b&#x00000041;c&#0;",)], "h string").select(html_to_text(F.col("h"))).first()
    assert row[0] == "aAbAc�"
