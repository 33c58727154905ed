"""HTML to text. The parser is a small helper run on Arrow batches of the stored pages."""

from __future__ import annotations

import sys
from html.parser import HTMLParser

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# the Python helpers travel with the job, executors need no installed package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# fixed values: elements whose own text is never visible
HIDDEN_PARENTS = {"style", "script", "head", "title", "meta", "[document]"}
_CODE = {"script", "style", "template"}
_VOID = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track",
    "wbr",
}
_HEAD_ONLY = {"title", "meta", "link", "style", "script", "base", "noscript", "template"}


class _Page(HTMLParser):
    """Collects text nodes with their open elements, the title and the meta description."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[str] = []
        self.nodes: list[tuple[str, str, bool]] = []  # text, parent, inside body
        self.pending: list[str] = []
        self.body_seen = False
        self.description: str | None = None
        self.described = False

    def _end_text(self) -> None:
        text = "".join(self.pending)
        self.pending = []
        if not text:
            return
        inside = "head" not in self.open and "title" not in self.open
        if not self.open or self.open == ["html"]:
            if not text.strip():
                return  # layout between the top elements is no text node
            self.body_seen = True
        self.nodes.append((text, self.open[-1] if self.open else "body", inside))

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self._end_text()
        if "head" in self.open and tag not in _HEAD_ONLY and tag != "head":
            del self.open[self.open.index("head"):]
        if tag == "meta" and not self.described and dict(attrs).get("name") == "description":
            self.described = True
            self.description = dict(attrs).get("content")
        if tag == "body" or ("head" not in self.open and tag not in ("html", "head", *_HEAD_ONLY)):
            self.body_seen = True
        if tag not in _VOID:
            self.open.append(tag)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in _VOID and self.open and self.open[-1] == tag:
            self.open.pop()

    def handle_endtag(self, tag: str) -> None:
        self._end_text()
        if tag in self.open:
            while self.open.pop() != tag:
                pass

    def handle_data(self, data: str) -> None:
        self.pending.append(data)

    def handle_comment(self, data: str) -> None:
        self._end_text()

    def handle_decl(self, decl: str) -> None:
        self._end_text()

    def handle_pi(self, data: str) -> None:
        self._end_text()


def parse_page(html: str) -> _Page:
    page = _Page()
    page.feed(html)
    page.close()
    page._end_text()
    return page


def visible_text_of(html: str | None) -> str | None:
    try:
        nodes = parse_page(html).nodes
    except Exception:  # a page that cannot be parsed has no text
        return None
    return " ".join(text.strip() for text, parent, _ in nodes if parent not in HIDDEN_PARENTS)


def body_text_of(html: str | None) -> str | None:
    try:
        page = parse_page(html)
    except Exception:
        return None
    if not page.body_seen:
        return None
    return "".join(text for text, parent, inside in page.nodes if inside and parent not in _CODE)


def meta_description_of(html: str | None) -> str | None:
    try:
        return parse_page(html).description
    except Exception:
        return None


def title_of(html: str | None) -> str | None:
    """Text of the first title element as a browser shows it: decoded, blanks collapsed; '' if there is none."""
    if html is None:
        return None
    try:
        nodes = parse_page(html).nodes
    except Exception:
        return None
    return next((" ".join(text.split()) for text, parent, _ in nodes if parent == "title"), "")


@F.pandas_udf(T.StructType([T.StructField(n, T.StringType()) for n in ("title", "description")]))
def _head(html: pd.Series) -> pd.DataFrame:
    return pd.DataFrame({"title": html.map(title_of), "description": html.map(meta_description_of)}, dtype=object)


def page_head(html: Column) -> Column:
    """``title, description`` of a page, from one batch to the parser."""
    return _head(html)


@F.pandas_udf(T.StringType())
def _visible_text(html: pd.Series) -> pd.Series:
    return html.map(visible_text_of)


@F.pandas_udf(T.StringType())
def _body_text(html: pd.Series) -> pd.Series:
    return html.map(body_text_of)


@F.pandas_udf(T.StringType())
def _meta_description(html: pd.Series) -> pd.Series:
    return html.map(meta_description_of)


def visible_text(html: Column) -> Column:
    return _visible_text(html)


def body_text(html: Column) -> Column:
    return _body_text(html)


def meta_description(html: Column) -> Column:
    """Content of the first ``meta[name=description]``; pages without the word skip the parser."""
    return _meta_description(F.when(html.ilike("%description%"), html))
