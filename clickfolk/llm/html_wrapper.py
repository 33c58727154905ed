"""Main text of web pages by wrappers inferred per host.

A wrapper is a union-free regular expression over a host's markup: nested sequences in which an element may be optional
or repeated and a text is either the same on every page or a slot. It is inferred by aligning the token streams of the
host's pages one after another: neighbours of one shape fold into a repeated group, elements that one side lacks turn
optional, texts that differ turn into slots. Each task folds its pages into one wrapper a host, then the partial
wrappers of a host are aligned in the same way, so no host is gathered and no page is left out.

The wrapper tells where the article is: the element all pages mark as article or main, or else the least one that holds
all text in slots. A page's text is then read from the elements the wrapper points at.
"""

from __future__ import annotations

import html
import json
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickfolk.llm.texts import slices, travels
from clickfolk.session import materialise

travels(__name__)

# fixed values: roles of elements
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = set("a abbr acronym b bdi bdo big cite code data dfn em font i img ins kbd label mark q s samp small span strike "
              "strong sub sup time tt u var wbr br".split())
_APART = set("nav header footer aside form head noscript iframe button select option textarea dialog object svg canvas "
             "template menu".split())
_WORDS_APART = set("ad ads advert adverts advertisement advertisements advertising banner banners breadcrumb breadcrumbs comment "
                   "comments cookie cookies consent disqus footer form header login masthead menu menubar nav navbar navigation "
                   "newsletter notice notices pagination popup promo promotion related share sharing sidebar signup social "
                   "sponsor sponsored subscribe subscription widget respond reactions discussion replies".split())
_ROLES_APART = set("navigation banner contentinfo complementary search form alert dialog menu".split())
_CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
           "th": {"td", "th"}, "option": {"option"}}
_ENDS_P = set("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
              "hr main nav ol p pre section table ul".split())
_SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}}

DEPTH = 120  # levels of a wrapper; elements below count as text of the last level there, pages are read at any depth
_TEXT_TAGS = set("p h1 h2 h3 h4 h5 h6 li dt dd td th blockquote pre figcaption caption summary".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|textarea|title|xmp)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<[!?][^>]*+>", re.DOTALL | re.IGNORECASE)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_NUMBER = re.compile(r"[0-9]+")


class Node:
    """An element of a page: name with classes, whether it stands apart from the article, children and texts in order.

    ``doubt``: it is apart by a class or id, or a form, and the page decides; ``heads``: its headings stay.
    """

    __slots__ = ("label", "tag", "apart", "children", "doubt", "heads")

    def __init__(self, label: str, tag: str, apart: bool) -> None:
        self.label, self.tag, self.apart = label, tag, apart
        self.children: list[Node | str] = []
        self.doubt, self.heads = False, tag == "header"


def _element(tag: str, attributes: str) -> Node:
    names, apart, doubt, heads = [], tag in _APART, False, tag == "header"
    if "=" in attributes:
        for name, *values in _ATTRIBUTE.findall(attributes):
            value = next((v for v in values if v), "").lower()
            words = set(value.split())
            if name.lower() == "role":
                apart = apart or value in _ROLES_APART
            elif tag not in ("html", "body", "article", "main"):
                doubt = doubt or bool(words & _WORDS_APART)
                heads = heads or "header" in words
            if name.lower() == "class":
                names += value.split()
    # numbers in classes count pages, classes of the outermost elements tell kinds of pages: neither says where text stands
    kept = [] if tag in ("html", "body", "main") else sorted({_NUMBER.sub("#", n.replace(".", "")) for n in names})
    node = Node(".".join([tag, *kept]), tag, apart or doubt)
    node.doubt, node.heads = not apart and doubt or tag == "form", heads
    return node


def parse(page: str) -> Node:
    """Elements and texts of a page; ends that are missing are implied, stray ones ignored."""
    root = Node("", "", False)
    stack = [root]
    opened: Counter = Counter()
    at = 0
    for token in _TOKEN.finditer(page):
        if token.start() > at:
            stack[-1].children.append(page[at : token.start()])
        at = token.end()
        tag = token[3]
        if not tag:
            continue
        tag = tag.lower()
        if token[2]:
            if opened[tag]:
                while _close(stack, opened) != tag:
                    pass
            continue
        if tag in _ENDS_P:
            _imply(stack, opened, {"p"}, _ENDS_P - {"p"})
        if tag in _CLOSES and tag != "p":
            _imply(stack, opened, _CLOSES[tag], _SCOPE.get(tag, set()))
        node = _element(tag, token[4])
        stack[-1].children.append(node)
        if tag not in _VOID and not token[4].endswith("/"):
            stack.append(node)
            opened[tag] += 1
    if at < len(page):
        stack[-1].children.append(page[at:])
    _decide(root)
    return root


def _decide(root: Node) -> None:
    """Elements in doubt are not apart if they hold the article's element, or most of the text where nothing is marked."""
    doubtful: list[tuple[Node, int, list[Node]]] = []  # element, its characters, article and main elements inside
    outside: list[Node] = []
    in_marked = 0

    # characters and topmost article and main elements below, without what is apart beyond doubt; children before parents
    total = 0
    stack: list[list] = [[root, iter(root.children), False, False, 0, []]]
    while stack:
        node, left, in_doubt, marked, chars, inside = frame = stack[-1]
        for child in left:
            if isinstance(child, str):
                own = len(" ".join(child.split()))
                frame[4] += own
                in_marked += own if marked and not in_doubt else 0
            elif child.doubt or not child.apart:
                is_marked = child.tag in ("article", "main")
                if is_marked and not in_doubt:
                    outside.append(child)
                stack.append([child, iter(child.children), in_doubt or child.doubt, marked or is_marked, 0, []])
                break
        else:
            stack.pop()
            if not stack:
                total = frame[4]
                break
            stack[-1][4] += frame[4]
            stack[-1][5] += [node] if node.tag in ("article", "main") else inside
            if node.doubt:
                doubtful.append((node, frame[4], inside))

    for node, chars, inside in doubtful:
        most = 2 * chars > total
        if node.tag == "form" and not inside:
            most = most and _heading_below(node)
        holds = any(m.tag == "main" for m in inside) or (inside and (len(inside) == 1 or most))
        if not in_marked and (most or holds) or holds and not any(m.tag == inside[0].tag for m in outside):
            node.apart = node.doubt = False


def _heading_below(node: Node) -> bool:
    left = [node]
    while left:
        for child in left.pop().children:
            if isinstance(child, Node):
                if child.tag == "h1":
                    return True
                left.append(child)
    return False


def _close(stack: list[Node], opened: Counter) -> str:
    tag = stack.pop().tag
    opened[tag] -= 1
    return tag


def _imply(stack: list[Node], opened: Counter, tags: set[str], limits: set[str]) -> None:
    if not any(opened[t] for t in tags):
        return
    for depth in range(len(stack) - 1, 0, -1):
        if stack[depth].tag in limits:
            return
        if stack[depth].tag in tags:
            while len(stack) > depth:
                _close(stack, opened)
            return


# ---------------------------------------------------------------- wrappers
# [label, apart, optional, repeated, children, text, chars, pages]: text is None, a digest all that have one agree on, or
# True for a slot; chars counts the characters held, pages the pages with a text. Kept as plain lists: stored as JSON.

def _shape(node: Node, level: int = 0) -> list:
    """The wrapper of one page; texts are compared as the blocks that are read."""
    children, blocks, pending = [], [], []

    def close() -> None:
        plain = " ".join(html.unescape("".join(pending)).split())
        pending.clear()
        if plain:
            blocks.append(plain)

    left: list[Node | str | None] = list(reversed(node.children))
    while left:
        child = left.pop()
        if child is None:
            close()
        elif isinstance(child, str):
            pending.append(child)
        elif child.tag == "br":
            pending.append(" ")
        elif child.tag in _INLINE and not child.apart:
            left += reversed(child.children)
        elif level < DEPTH:
            close()
            children.append(_shape(child, level + 1))
        elif not child.apart:
            close()
            left += [None, *reversed(child.children)]
    close()
    text = hash_text("\n".join(blocks)) if blocks else None
    return [node.label, node.apart, False, False, _folded(children), text, sum(map(len, blocks)), int(bool(blocks))]


def hash_text(text: str) -> str:
    import xxhash

    return xxhash.xxh64_hexdigest(text.encode("utf-8", "surrogatepass"))


def _folded(items: list[list]) -> list[list]:
    """Neighbouring groups of up to four elements of one shape fold into repeated ones."""
    for period in (1, 2, 3, 4):
        out: list[list] = []
        for item in items:
            out.append(item)
            while len(out) >= 2 * period and all(
                    out[-period + i][0] == out[-2 * period + i][0] for i in range(period)):
                tail = out[-period:]
                del out[-period:]
                for i in range(period):
                    merged = align(out[-period + i], tail[i])
                    merged[3] = True
                    out[-period + i] = merged
        items = out
    return items


def align(a: list, b: list) -> list:
    """The wrapper both match: what only one side has is optional, what repeats on one side repeats."""
    text = b[5] if a[5] is None else a[5] if b[5] is None or a[5] == b[5] else True
    return [a[0], a[1] and b[1], a[2] or b[2], a[3] or b[3], _aligned(a[4], b[4]), text, a[6] + b[6], a[7] + b[7]]


def _aligned(a: list[list], b: list[list]) -> list[list]:
    if [x[0] for x in a] == [x[0] for x in b]:
        return [align(x, y) for x, y in zip(a, b)]
    # longest common subsequence of labels; the rest turns optional
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = max(best[i + 1][j], best[i][j + 1], best[i + 1][j + 1] + 1 if a[i][0] == b[j][0] else 0)
    out, i, j = [], 0, 0
    while i < len(a) or j < len(b):
        if i < len(a) and j < len(b) and a[i][0] == b[j][0] and best[i][j] == best[i + 1][j + 1] + 1:
            out.append(align(a[i], b[j]))
            i, j = i + 1, j + 1
        elif j == len(b) or (i < len(a) and best[i + 1][j] >= best[i][j + 1]):
            out.append([*a[i][:2], True, *a[i][3:]])
            i += 1
        else:
            out.append([*b[j][:2], True, *b[j][3:]])
            j += 1
    return _folded(out)


def main_labels(wrapper: list, constant: frozenset[str] = frozenset()) -> list[str]:
    """Path of labels from the top to the article's element; empty if it is the whole page."""
    def paths(node: list, path: list[str]) -> Iterator[tuple[list[str], list]]:
        if node[1]:
            return
        yield path, node
        for child in node[4]:
            yield from paths(child, [*path, child[0]])

    sums: dict[int, int] = {}

    def held(node: list) -> int:
        if id(node) not in sums:
            parts = node[0].split(".")
            if node[1]:  # of what stands apart only the headings of a header are read
                inner = [c for c in node[4] if c[0].split(".")[0] in ("h1", "h2")] if "header" in parts else []
                own = 0
            else:
                inner, own = node[4], node[6] if node[5] is not None and node[5] not in constant else 0
            sums[id(node)] = own + sum(held(c) for c in inner)
        return sums[id(node)]

    all_paths = list(paths(wrapper, []))
    marked = [(held(node), path) for path, node in all_paths if path and path[-1].split(".")[0] in ("article", "main")]
    if marked and max(marked, key=lambda m: m[0])[0]:
        return max(marked, key=lambda m: (m[0], -len(m[1])))[1]
    node, path = wrapper, []
    while True:  # go down while one child holds all the text that varies
        inner = [c for c in node[4] if held(c)]
        if len(inner) != 1 or held(inner[0]) < held(node) or inner[0][1] or inner[0][3] or inner[0][0].split(".")[0] in (
                "p", "h1", "h2", "h3", "ul", "ol", "table", "li", "blockquote", "pre"):
            return path
        node, path = inner[0], [*path, inner[0][0]]


def constant_texts(wrapper: list, n_pages: int, n_texts: int) -> list[str]:
    """Digests of texts outside article elements that stand in one place on every page: boilerplate.

    Of a host whose pages all say the same (``n_texts`` below two) nothing was compared: it has none.
    """
    out: list[str] = []

    def visit(node: list) -> None:
        if node[3] or node[7] < n_pages and not node[4] or node[0].split(".")[0] in ("article", "main"):
            return
        if isinstance(node[5], str) and node[7] == n_pages:
            out.append(node[5])
        for child in node[4]:
            visit(child)

    if n_texts > 1:
        visit(wrapper)
    return out


# ---------------------------------------------------------------- reading a page

def blocks_of(node: Node, constant: frozenset[str] = frozenset()) -> list[str]:
    """Texts of the blocks below an element in page order, without what stands apart.

    Of ``constant`` texts, those on every page of the host, the ones among a page's own texts stay (see ``_is_content``).
    """
    out: list[str] = []
    pending: list[str] = []
    within = [[node.tag, 0, -1]]  # open elements: name, blocks before it, blocks up to its end
    places: list[tuple[list, list]] = []  # of each block its element and the one around it

    def close() -> None:
        plain = " ".join(html.unescape("".join(pending)).split())
        pending.clear()
        if plain:
            out.append(plain)
            places.append((within[-1], within[-2] if len(within) > 1 else within[-1]))

    stack: list[tuple[Node | str, bool]] = [(c, False) for c in reversed(node.children)]
    while stack:
        item, end = stack.pop()
        if end:
            close()
            within.pop()[2] = len(out)
        elif isinstance(item, str):
            pending.append(item)
        elif item.tag == "br":
            pending.append(" ")
        elif item.apart and not (item.heads and _has_heading(item)):
            if item.tag not in _INLINE:
                close()
        elif item.tag in _INLINE:
            stack += [(c, False) for c in reversed(item.children)]
        else:
            close()
            within.append([item.tag, len(out), -1])
            stack.append((item, True))
            children = [c for c in item.children if isinstance(c, Node) and c.tag in ("h1", "h2")] if item.apart else item.children
            stack += [(c, False) for c in reversed(children)]
    close()
    within[0][2] = len(out)
    if not constant:
        return out
    varies = [hash_text(text) not in constant for text in out]
    before = [0, *accumulate(varies)]
    return [text for k, text in enumerate(out) if varies[k] or _is_content(
        places[k][0][0], places[k][1][0], before[k] > before[places[k][1][1]], before[places[k][1][2]] > before[k + 1])]


def _is_content(tag: str, around: str, after_own: bool, before_own: bool) -> bool:
    """Whether a text on every page of a host is part of the article, by the page's own texts in the element around it.

    Between two of them it is, but for a container of its own at the top of the page. A heading is if one follows, an entry of
    a list or table if one is beside it.
    """
    if after_own and before_own:
        return tag in _TEXT_TAGS or around not in ("", "html", "body")
    if tag in ("h2", "h3", "h4", "h5", "h6"):
        return before_own
    return tag in ("li", "dt", "dd", "td", "th") and (after_own or before_own)


def _has_heading(node: Node) -> bool:
    return any(isinstance(c, Node) and c.tag in ("h1", "h2") for c in node.children)


def _followed(node: Node, path: list[str]) -> Node | None:
    """All elements the path leads to, in page order, below one node."""
    nodes = [node]
    for label in path:
        nodes = [c for n in nodes for c in _elements(n) if c.label == label and not c.apart]
        if not nodes:
            return None
    if len(nodes) == 1:
        return nodes[0]
    together = Node("", "", False)
    together.children = list(nodes)
    return together


def _elements(node: Node) -> Iterator[Node]:
    left = list(reversed(node.children))
    while left:
        child = left.pop()
        if isinstance(child, Node):
            if child.tag in _INLINE:
                left += reversed(child.children)
            else:
                yield child


def main_text(page: str | None, path: list[str] | None, constant: frozenset[str] = frozenset()) -> str:
    """The article's blocks, joined by blank lines; a page the wrapper does not fit is its own wrapper."""
    if not page:
        return ""
    root = parse(page)
    node = None if path is None else _followed(root, path)
    if node is None:
        own = main_labels(_shape(root))
        node, constant = (_followed(root, own) if own else root) or root, frozenset()
    return "\n\n".join(blocks_of(node, constant))


# ---------------------------------------------------------------- Spark

def host_of(url: str) -> F.Column:
    return F.coalesce(F.regexp_extract(F.lower(F.col(url)), r"^[a-z][a-z0-9+.-]*://([^/?#:]+)", 1), F.lit(""))


def _partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    wrappers: dict[str, list] = {}
    counts: Counter = Counter()
    said: dict[str, list[str]] = {}  # least and greatest digest of a page's text: equal if all pages say the same
    common: dict[str, set[str]] = {}  # digests of blocks on every page so far
    for batch in slices(batches, "html", 4 << 20):
        for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
            if page:
                root = parse(page)
                shape, blocks = _shape(root), blocks_of(root)
                text, digests = hash_text("\n".join(blocks)), set(map(hash_text, blocks))
                wrappers[host] = align(wrappers[host], shape) if host in wrappers else shape
                common[host] = common[host] & digests if host in common else digests
                counts[host] += 1
                least, most = said.get(host, (text, text))
                said[host] = [min(least, text), max(most, text)]
        if len(wrappers) > 5000:
            yield _as_rows(wrappers, counts, said, common)
            wrappers, counts, said, common = {}, Counter(), {}, {}
    if wrappers:
        yield _as_rows(wrappers, counts, said, common)


_PARTIAL = "host string, wrapper string, n_pages bigint, least string, most string, common array<string>"


def _as_rows(wrappers: dict[str, list], counts: Counter, said: dict[str, list[str]],
             common: dict[str, set[str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(wrappers)), pa.array([json.dumps(w) for w in wrappers.values()]),
         pa.array([counts[h] for h in wrappers], pa.int64()), pa.array([said[h][0] for h in wrappers]),
         pa.array([said[h][1] for h in wrappers]), pa.array([sorted(common[h]) for h in wrappers], pa.list_(pa.string()))],
        ["host", "wrapper", "n_pages", "least", "most", "common"])


def _whole(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by host: one wrapper a host, with what reading a page needs."""
    host, wrapper, pages, least, most, common, out = None, None, 0, "", "", set(), []

    def done() -> dict:
        # of a host whose pages all say the same nothing was compared: no text is known as boilerplate
        constant = sorted(common) if least != most else []
        path = main_labels(wrapper, frozenset([*constant, *constant_texts(wrapper, pages, 1 if least == most else 2)]))
        marked = any(label.split(".")[0] in ("article", "main") for label in path)
        return {"host": host, "wrapper": json.dumps(wrapper), "path": path, "constant": [] if marked else constant,
                "n_pages": pages}

    for batch in batches:
        for h, w, n, low, high, everywhere in zip(*[batch.column(c).to_pylist() for c in (
                "host", "wrapper", "n_pages", "least", "most", "common")]):
            shape = json.loads(w)
            if wrapper is not None and h == host:
                wrapper, pages, least, most = align(wrapper, shape), pages + n, min(least, low), max(most, high)
                common &= set(everywhere)
                continue
            if wrapper is not None:
                out.append(done())
            host, wrapper, pages, least, most, common = h, shape, n, low, high, set(everywhere)
    if wrapper is not None:
        out.append(done())
    if out:
        yield pa.RecordBatch.from_pylist(out, schema=pa.schema([
            ("host", pa.string()), ("wrapper", pa.string()), ("path", pa.list_(pa.string())),
            ("constant", pa.list_(pa.string())), ("n_pages", pa.int64())]))


def infer_wrappers(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``host, wrapper, path, constant, n_pages`` of every host with a page that is not empty; a null url is host ''."""
    partial = pages.select(host_of(url_col).alias("host"), F.col(html_col).alias("html")).mapInArrow(
        _partial, _PARTIAL)
    return partial.repartition("host").sortWithinPartitions("host", "wrapper").mapInArrow(
        _whole, "host string, wrapper string, path array<string>, constant array<string>, n_pages bigint")


def _reading(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "html", 4 << 20):
        texts = [main_text(page, path, frozenset(constant or ())) for page, path, constant in zip(
            *[batch.column(n).to_pylist() for n in ("html", "path", "constant")])]
        yield pa.RecordBatch.from_arrays([batch.column("page"), batch.column("url"), pa.array(texts, pa.string())],
                                         ["page", "url", "text"])


def extract_articles(pages: DataFrame, wrappers: DataFrame | None = None, *, id_col: str = "page_id", url_col: str = "url",
                     html_col: str = "html", large: int = 1000) -> DataFrame:
    """``id_col, url_col, text`` of every page: the article's blocks joined by a blank line, '' if there is none.

    Character references are decoded, white space inside a block becomes one blank. A null or empty page has no text;
    equal rows give equal texts; a host with one page is its own wrapper. An empty table gives an empty result.
    """
    wrappers = materialise(infer_wrappers(pages, url_col, html_col), "wrappers") if wrappers is None else wrappers
    narrow = pages.select(F.col(id_col).cast("bigint").alias("page"), F.col(url_col).alias("url"),
                          F.col(html_col).alias("html"), host_of(url_col).alias("host"))
    needed = wrappers.select("host", "path", "constant", "n_pages")
    total = needed.agg(F.coalesce(F.sum("n_pages"), F.lit(0))).first()[0]
    # fewer than ``large`` hosts can have more than that part of all pages: they are broadcast, and their pages are spread
    # over keys of their own instead of meeting in one task
    top = needed.where(F.col("n_pages") * large > total).select("host", F.struct("path", "constant").alias("_large"))
    rest = needed.where(F.col("n_pages") * large <= total).select(
        F.col("host").alias("_key"), F.struct("path", "constant").alias("_rest"))
    spread = F.concat(F.lit("\n"), F.pmod(F.xxhash64("page", "url"), F.lit(100_000)).cast("string"))
    keyed = narrow.join(F.broadcast(top), "host", "left").withColumn(
        "_key", F.when(F.col("_large").isNull(), F.col("host")).otherwise(spread))
    joined = keyed.join(rest, "_key", "left").select("page", "url", "html", F.coalesce("_large", "_rest").alias("w"))
    return joined.select("page", "url", "html", "w.path", "w.constant").mapInArrow(_reading, "page bigint, url string, text string").withColumnsRenamed(
        {"page": id_col, "url": url_col})
