import re

from conftest import values
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clickfolk.functions import html as X
from clickfolk.functions import text as E

EDGE = [
    "", " ", "\x1c a \x1f", "A;;;\n\nB", "a ;\nb", "https://www.Site.com/path?q=1 end", "(http://a.b.co:80/x)", "ЁЖ-1 ёж",
    "café — naïve", "https://пример.рф/x", "http://example.comдом", "tab\there", "x‚y", "a\r\nb\rc", "--", "don't; stop",
    "https://a.com/дом x", "X;Y; Z", "end;\n", " nbsp ", "İstanbul", "ΣΑΣ", "a b",
]
_URL = re.compile(E.URL_PATTERN)


def tokens(s):
    s = re.sub(f"[^{E.TOKEN_LETTERS[:-1]}\\- \n]", " ", _URL.sub(r"\2", s.lower())).replace("\n", " ")
    return re.sub("([ \n;])+", r"\1", s).strip()


def prose(s):
    s = _URL.sub(r"\2", s.lower()).replace("\t", " ").replace("\r\n", "\n").replace("\r", "\n").replace("‚", ",")
    return re.sub("([ \n;])+", r"\1", s).strip()


def results(spark, texts, function):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, s string")
    return [r["t"] for r in df.select("i", function(F.col("s")).alias("t")).orderBy("i").collect()]


def test_edge_strings(spark):
    assert results(spark, EDGE, E.normalise_tokens) == [tokens(s) for s in EDGE]
    assert results(spark, EDGE, E.normalise_prose) == [prose(s) for s in EDGE]
    assert results(spark, [None], E.normalise_prose) == [E.MISSING_TEXT]
    assert results(spark, [None], E.normalise_tokens) == [None]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="aЯé -;\n\t.:/hтps'1", max_size=40), min_size=50, max_size=50))
def test_random_strings(spark, texts):
    once = results(spark, texts, E.normalise_tokens)
    assert once == [tokens(s) for s in texts]
    assert results(spark, once, E.normalise_tokens) == once
    runs = results(spark, texts, E.collapse_runs)
    assert runs == [re.sub("([ \n;])+", r"\1", s) for s in texts]
    assert results(spark, runs, E.collapse_runs) == runs


def test_depunycode(spark):
    hosts = ["xn--e1afmkfd.xn--p1ai", "xn--", "xn--\x80", "a.xn--p1ai", None, "plain.com"]
    assert results(spark, hosts, E.depunycode) == ["пример.рф", *[E._idna_or_same(h) for h in hosts[1:3]], "a.xn--p1ai", None, "plain.com"]


def test_compose_text(spark):
    df = spark.createDataFrame([("h.com", "T", None, "Some  Text"), ("h", None, "d", None)], "h string, t string, d string, b string")
    got = values(df.select(E.compose_text(F.col("h"), F.col("t"), F.col("d"), F.col("b"), "|", 7).alias("x")))
    assert got == [("h | !пусто! | d | ",), ("h.com | t | !пусто! | some",)]


PAGE = (
    '<!DOCTYPE html><html><head><title>T&amp;t</title><meta name="description" content="about"><style>p{}</style>'
    '<script>var t="</p>";</script></head><body> <p>One &amp; two<!-- no --> three</p><script>x()</script>'
    "<div>four<br>five <b>six</div></body></html>"
)


def test_visible_text():
    assert X.visible_text_of(PAGE) == " One & two three four five six"
    assert X.visible_text_of("bare &lt;text&gt;") == "bare <text>"
    assert X.visible_text_of("") == ""
    assert X.visible_text_of(None) is None
    assert X.visible_text_of("<head><title>x</title><p>body starts</p>") == "body starts"


def test_body_text():
    assert X.body_text_of(PAGE) == " One & two threefourfive six"
    assert X.body_text_of("<html><head><title>x</title></head></html>") is None
    assert X.body_text_of(None) is None


def test_meta_description(spark):
    pages = [PAGE, "<p>no description</p>", '<meta name="description"><meta name="description" content="b">', None]
    assert results(spark, pages, X.meta_description) == ["about", None, None, None]
    assert X.meta_description_of(PAGE) == "about"


def test_entities_without_semicolon():
    assert X.visible_text_of("<title>a &am</title><h1>b &amp</h1>&copy c &am") == "b & © c &am"
