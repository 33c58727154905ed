"""Pages of hosts as extract_articles reads them: nothing but boilerplate goes."""

from clickfolk.llm import html_wrapper as wrapper


def texts_of(spark, hosts):
    """Host -> texts of its pages, by page number."""
    rows = [(i, f"http://{host}/{i}", html) for host, pages in hosts.items() for i, html in enumerate(pages)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)
    out = {}
    for r in sorted(wrapper.extract_articles(df).collect(), key=lambda r: r.page_id):
        out.setdefault(r.url.split("/")[2], []).append(r.text)
    return out


def content(*blocks, foot=""):
    return f"<html><body><div class=content><h1>{blocks[0]}</h1>{''.join(f'<p>{b}</p>' for b in blocks[1:])}</div>{foot}</body></html>"


def test_constant_texts_need_pages_to_compare(spark):
    foot = "<div class=copy>All rights</div>"
    got = texts_of(spark, {
        "one.example": [content("T", "a")], "two.example": [content("T", "a", "b")], "copies.example": [content("T", "a")] * 4,
        "nonce.example": [f"<!-- {i} -->" + content("T", "a") for i in range(3)],
        "half.example": [content("T1", "a"), "<html><body><hr></body></html>", content("T1", "a", "z")],
        "many.example": [content(f"T{i}", f"a{i}", foot=foot) for i in range(5)]})
    assert got["one.example"] == ["T\n\na"] and got["two.example"] == ["T\n\na\n\nb"]
    assert got["copies.example"] == ["T\n\na"] * 4 and got["nonce.example"] == ["T\n\na"] * 3
    assert got["half.example"] == ["T1\n\na", "", "T1\n\na\n\nz"]
    assert got["many.example"] == [f"T{i}\n\na{i}" for i in range(5)]


def test_layout_words_do_not_lose_the_article(spark):
    article = "<article><h1>T{0}</h1><p>text {0}</p></article>"
    layouts = ["layout has-sidebar", "no-sidebar", "comments-open", "sidebar", "widget", "header"]
    hosts = {f"h{k}.example": [f"<body><nav>n</nav><div class='{words}'>{article.format(i)}</div><div class=related><p>else {i}</p></div></body>"
                               for i in range(3)] for k, words in enumerate(layouts)}
    got = texts_of(spark, hosts)
    assert all(texts == [f"T{i}\n\ntext {i}" for i in range(3)] for texts in got.values()), got


def test_elements_in_doubt():
    def read(html):
        return wrapper.main_text(html, None)

    assert read("<article><div class='article-header'><h1>T</h1></div><p>a</article>") == "T\n\na"
    assert read("<div class=header><h1>T</h1><p>by</div><p>a longer text") == "T\n\na longer text"
    assert read("<div class=widget><p>nearly all of the text</div>") == "nearly all of the text"
    assert read("<form id=f><main><p>a</main></form>") == "a" and read("<form><h1>T</h1><p>a</form>") == "T\n\na"
    assert read("<article><p>a</article><div class=comments><p>much longer than the article</div>") == "a"
    assert read("<article><p>a<div id=comments><article><p>longer than the rest</article></div></article>") == "a"
    assert read("<p>long text of its own<div class=related><article>x</article><article>y</article></div>") == "long text of its own"
    assert read("<main><div class=widget><article><p>a</article></div></main>") == "a"


def test_no_sibling_with_text_is_lost(spark):
    def lead(i):
        return f"<body><h1>T{i}</h1><p>lead {i}</p><div class=content>{f'<p>long text {i} and so on</p>' * 5}</div><div class=copy>All rights</div></body>"

    def rows(i):
        return f"<body><div class=row><article>a{i}</article></div><hr><div class=row><article>longer b{i}</article></div></body>"

    got = texts_of(spark, {
        "lead.example": [lead(i) for i in range(3)], "single.example": [lead(0)], "rows.example": [rows(i) for i in range(3)],
        "main.example": [f"<main>{rows(i)}</main>" for i in range(3)],
        "header.example": [f"<header><h1>T{i}</h1></header><div class=content><p>a{i}</div>" for i in range(3)]})
    whole = ["\n\n".join([f"T{i}", f"lead {i}", *[f"long text {i} and so on"] * 5]) for i in range(3)]
    assert got["lead.example"] == whole and got["single.example"] == [whole[0] + "\n\nAll rights"]
    assert got["rows.example"] == got["main.example"] == [f"a{i}\n\nlonger b{i}" for i in range(3)]
    assert got["header.example"] == [f"T{i}\n\na{i}" for i in range(3)]
    assert wrapper.main_text("<div class=widget><p>nearly all of the text</div><p>rest", None) == "nearly all of the text\n\nrest"
