"""What stands on every page of a host: the article's own headings stay, boilerplate goes in any spelling."""

import time

from test_html_hosts import texts_of

from clickfolk.llm import html_wrapper as wrapper


def pages(n, foot="", body="<body>", head="Ingredients"):
    return [f"<html>{body.format(i)}<div class=content><h1>T{i}</h1><h2>{head}</h2><p>flour {i}</p><ul><li>salt</li><li>{i} eggs</li></ul>"
            f"</div>{foot}</body></html>" for i in range(n)]


def test_headings_on_every_page_stay(spark):
    want = [f"T{i}\n\nIngredients\n\nflour {i}\n\nsalt\n\n{i} eggs" for i in range(4)]
    feet = {"entity": "<div class=copy>&copy; 2024</div>", "inline": "<div class=copy>All ri<b>gh</b>ts</div>",
            "equal": "<div class=copy>a</div><div class=copy>b</div>", "list": "<ul class=foot><li>Home<li>About</ul>"}
    got = texts_of(spark, {f"{k}.example": pages(4, foot) for k, foot in feet.items()})
    assert all(texts == want for texts in got.values()), got
    # here the foot lies in the least element that holds all that varies
    lead = {f"{k}.example": [f"<body><p>lead {i}</p><div class=content><p>text {i}</p></div>{foot}</body>" for i in range(4)]
            for k, foot in feet.items()}
    got = texts_of(spark, lead)
    assert all(texts == [f"lead {i}\n\ntext {i}" for i in range(4)] for texts in got.values()), got


def test_classes_that_number_pages_align(spark):
    got = texts_of(spark, {"post.example": pages(4, "<div class=copy>(c)</div>", "<body class='post-{0} single kind{0}'>")})
    assert got["post.example"][2] == "T2\n\nIngredients\n\nflour 2\n\nsalt\n\n2 eggs"

    def numbered(i):
        return f"<body><div class='post post-{i}'><p>text {i}</p></div><div class='copy'>(c)</div></body>"

    assert texts_of(spark, {"n.example": [numbered(i) for i in range(4)]})["n.example"] == [f"text {i}" for i in range(4)]
    sizes = []
    for n in (50, 400):
        whole = wrapper._shape(wrapper.parse(numbered(0)))
        for i in range(1, n):
            whole = wrapper.align(whole, wrapper._shape(wrapper.parse(numbered(i))))
        sizes.append(len(str(whole)))
    assert sizes[1] < sizes[0] + 50


def test_any_depth():
    deep = "<div>" * 130 + "<nav>menu</nav><form>ask</form><p>text</p>" + "</div>" * 130 + "<p>after</p>"
    assert wrapper.main_text(deep, None) == "text\n\nafter"
    assert wrapper.main_text(f"<article>{deep}</article>", None) == "text\n\nafter"
    begin = time.time()
    for tag in ("div", "b", "p", "li"):
        very = f"<{tag}>" * 50_000 + "text</i></em>" * 2 + "</span>" * 50_000
        assert "text" in wrapper.main_text(very, None)
    assert time.time() - begin < 60


def plain_blocks_of_all(pages_of_host):
    """Naive: blocks of each page between the first and the last text that some other page lacks."""
    blocks = [wrapper.blocks_of(wrapper.parse(p)) for p in pages_of_host]
    everywhere = set.intersection(*map(set, blocks))
    out = []
    for own in blocks:
        varies = [k for k, b in enumerate(own) if b not in everywhere]
        out.append("\n\n".join(own[varies[0] : varies[-1] + 1]) if varies else "")
    return out


def test_against_a_naive_aligner(spark):
    """Hosts without marked articles, menu before and foot after: what lies between the pages' own texts, no more, no less."""
    hosts = {}
    for h in range(6):
        parts = ["<h2>Method</h2>", "<p>same note</p>", "<h3>More &amp; less</h3>"][: h % 4]
        hosts[f"h{h}.example"] = [
            f"<body class='p{i}'><div class=top>Site {h}</div><div class='content c-{i}'><h1>Title {i}</h1>{''.join(parts)}<p>own <i>text</i> {i}"
            f"</p>{'<p>only here</p>' if i % 2 else ''}<p>end {i}</div><div class=copy>&copy; {h}</div></body>" for i in range(5)]
    got = texts_of(spark, hosts)
    assert got == {host: plain_blocks_of_all(p) for host, p in hosts.items()}
