"""Conversations, vectors and pages."""

import math

import numpy as np
import pytest

from clickfolk.llm import ann, chat
from clickfolk.llm import html_wrapper as wrapper


def test_template_reads_back_anything():
    texts = ["", "\\", "</s>", "<\\/s>", "</s>[INST] ok [/INST]", "a\\\\<s>[ROLE]", "<</s>s>", "[", " ", "[/INST", "</", "\n"]
    turns = [(role, text) for role in ("user", "assistant", "system", "", "[ROLE]") for text in texts]
    for k in range(0, len(turns), 3):
        formatted, spans, rewrites = chat.locate(turns[k : k + 7], chat.render)
        assert chat.read_back(formatted) == turns[k : k + 7] and not rewrites
        assert [chat.unescape(formatted[s[2] : s[3]]) for s in spans] == [t for _, t in turns[k : k + 7]]
        assert [formatted[s[0] : s[1]] for s in spans] == [chat.render([t]) for t in turns[k : k + 7]]


def test_rewriting_templates_are_found():
    def last_only(turns):  # drops what the assistant said before
        return "".join(f"<{r}>{t if r == 'user' or k == len(turns) - 1 else ''}</{r}>" for k, (r, t) in enumerate(turns))

    turns = [("user", "hi"), ("assistant", "hello"), ("user", "more"), ("assistant", "end")]
    formatted, spans, rewrites = chat.locate(turns, last_only)
    assert rewrites and spans[1] is None and formatted[spans[3][2] : spans[3][3]] == "end"
    assert not chat.locate(turns, chat.render)[2]


def test_chats_odd_rows(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", "a"), (2, 0, None, None), (None, None, "user", "x"), (3, 0, "user", "t"),
            (3, 0, "user", "t"), (4, 5, "assistant", "z" * 100000)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").selectExpr("*", "1 AS spans")
    got = {r.conv_id: r for r in chat.format_chats(df).collect()}
    assert [t.text for t in got[1].turns] == ["a", "b"] and got[1].loss_texts == ["b"] and got[3].n_turns == 2
    assert got[2].turns[0].role == "" and got[None].n_turns == 1 and len(got[4].loss_texts[0]) == 100000
    assert chat.format_chats(df.limit(0)).count() == 0


@pytest.fixture(scope="module")
def vectors(spark):
    random = np.random.default_rng(1)
    centres = random.normal(size=(30, 16))
    points = [centres[i % 30] + 0.3 * random.normal(size=16) for i in range(3000)]
    rows = [(i, [float(x) for x in p]) for i, p in enumerate(points)]
    rows += [(5000 + i, rows[7][1]) for i in range(40)]  # copies
    rows += [(6000, None), (6050, [0.0] * 16), (6100, [math.nan] * 16), (6150, [None] * 16), (6200, [math.inf] * 16), (7, rows[7][1])]
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").selectExpr("*", "'x' AS id", "3 AS part")


def exact(rows, queries, k):
    fine = {i: v for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    ids = sorted(fine)
    unit = np.array([fine[i] for i in ids])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    out = {}
    for q in queries:
        score = unit @ unit[ids.index(q)]
        order = sorted((-round(float(s), 12), i) for s, i in zip(score, ids) if i != q)[:k]
        out[q] = [i for _, i in order]
    return out


@pytest.mark.parametrize("block", [20000, 500])
def test_search_recall_and_ties(vectors, block):
    rows = [(r.vec_id, r.embedding) for r in vectors.collect()]
    router = ann.fit(ann.usable(vectors, "vec_id", "embedding"), sample=2000, parts=12)
    assert router is not None and router.probes <= 12
    got = {}
    for r in ann.search(vectors, vectors.where("vec_id % 50 = 0 or vec_id = 7"), router=router, block=block).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    want = exact(rows, list(got), 5)
    assert set(got) == {i for i, v in rows if (i % 50 == 0 or i == 7) and i < 6000}
    found = [len({v for _, v, _ in got[q]} & set(want[q])) for q in got]
    assert sum(found) >= 0.9 * 5 * len(got) and [v for _, v, _ in sorted(got[7])] == want[7]
    assert all([x[0] for x in sorted(v)] == [1, 2, 3, 4, 5] for v in got.values())


def test_search_small_tables(vectors):
    few = vectors.where("vec_id in (0, 1, 2, 6000, 6050)")
    assert ann.fit(ann.usable(few, "vec_id", "embedding")) is None
    got = ann.search(few, few).collect()
    assert sorted((r.query_id, r.rank) for r in got) == [(q, k) for q in (0, 1, 2) for k in (1, 2)]
    assert ann.search(few.limit(0), few.limit(0)).count() == 0


def test_parts_are_balanced():
    unit = ann._unit(np.random.default_rng(2).normal(size=(1000, 8)))
    part = ann.balanced_parts(unit, ann.neighbour_graph(unit, 5), 10)
    assert np.bincount(part, minlength=10).max() <= math.ceil(110)


def page(body, extra=""):
    return f"<html><head><title>t</title><style>p{{}}</style></head><body><nav><ul><li>a<li>b</ul></nav>{extra}{body}<footer>f</footer></body></html>"


def test_wrapper_from_alignment(spark):
    pages = [(i, f"http://h.example/{i}", page(f"<div class='wrap'><h2>Title {i}</h2>" + "".join(f"<p>text {i} {k} &amp; more" for k in range(i + 1)) +
              "</div>", "<div class=notice>cookies</div>" if i % 2 else "")) for i in range(6)]
    pages += [(10, None, "<p>alone</p>"), (11, "http://e.example/", None), (12, "http://e.example/", ""), (13, "not a url", "a &lt; b<br>c"),
              (1, "http://h.example/1", pages[1][2])]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string").selectExpr("*", "'x' AS host", "1 AS page", "'y' AS path")
    got = {r.page_id: r.text for r in wrapper.extract_articles(df).collect()}
    for i in range(6):
        assert got[i] == "\n\n".join([f"Title {i}", *[f"text {i} {k} & more" for k in range(i + 1)]])
    assert got[10] == "alone" and got[11] == got[12] == "" and got[13] == "a < b c"
    spread = {r.page_id: r.text for r in wrapper.extract_articles(df, large=1).collect()}  # no host is large
    assert spread == got and wrapper.extract_articles(df).count() == 11 and wrapper.extract_articles(df.limit(0)).count() == 0
    found = {r.host: r for r in wrapper.infer_wrappers(df).collect()}
    assert found["h.example"].path[-1].startswith("div.wrap")


def test_groups_optional_and_repeated():
    a, b = wrapper._shape(wrapper.parse("<ul><li>x<li>y</ul>")), wrapper._shape(wrapper.parse("<ul><li>z</ul><hr><p>k"))
    merged = wrapper.align(a, b)
    assert [c[0] for c in merged[4]] == ["ul", "hr", "p"] and merged[4][1][2] and merged[4][0][4][0][3]
    assert merged[4][0][4][0][5] is True


@pytest.mark.parametrize("html,text", [
    ("<article><header><h1>T</h1>by</header><p>One<br>two<p>&eacute;&nbsp;x</article><div id=comments><p>no</div>", "T\n\nOne two\n\né x"),
    ("<main><script>if (a<b) x('</p>')</script><!-- <p>c</p> --><p>a<b>b</b> c</p><aside>n</aside></main>", "ab c"),
    ("<div>" * 3000 + "deep", "deep"), ("<", "<"), ("<p", "<p"), ("a<p>b</div></p>c", "a\n\nb\n\nc"),
    ("<article><p>1</article><article><p>2</article>", "1\n\n2"), ("<form><p>x</form>", ""),
])
def test_main_text_of_single_pages(html, text):
    assert wrapper.main_text(html, None) == text
