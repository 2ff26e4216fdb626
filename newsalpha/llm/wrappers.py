"""Main text of web pages by wrappers: union-free regular expressions inferred from pages of one template of a host."""

import hashlib
import html as entities
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsalpha.llm.common import columns_added, rows_mapped

# Parts that the shapes of one template are aligned in, before the parts are aligned with each other.
PARTS = 64
# Characters of a text that a wrapper keeps; a longer one stands as its digest.
SHORT = 48
# Elements that are open at once; what is nested deeper is read as if it stood side by side.
DEPTH = 150
# Items of one element in a wrapper.
LONGEST = 300

# Element names of HTML by what they mean for the text of a page.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "xmp", "noframes"}
SILENT = RAW | {"head", "form", "button", "select", "option", "input", "label", "object", "canvas", "audio", "video", "map", "dialog"}
ASIDE = {"nav", "aside", "footer", "menu"}
MAIN = {"article", "main"}
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "center", "caption", "dd", "details", "dialog", "div", "dl", "dt",
    "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "html", "li",
    "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
CONTAINERS = {"body", "center", "details", "div", "section", "table", "tbody", "td", "tr", "#page"}
# An opening tag ends these open elements, up to the nearest one of the second set.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
# Words in classes, ids and roles that say an element is not the article.
FOREIGN = {
    "ad", "ads", "advert", "advertisement", "adverts", "advertising", "sponsor", "sponsored", "promo", "promotion", "banner",
    "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "pagination", "sidebar", "aside", "widget", "related",
    "footer", "masthead", "contentinfo", "complementary", "search", "cookie", "cookies", "consent", "gdpr", "notice", "alert",
    "popup", "modal", "overlay", "newsletter", "subscribe", "subscription", "signup", "login", "share", "sharing", "social",
    "comment", "comments", "respond", "reply", "replies", "disqus", "toolbar", "skip",
}

_token = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|(?P<text>[^<]+|<)",
    re.DOTALL,
)
_attribute = re.compile(r"""(class|id|role|hidden|aria-hidden|style|itemprop)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?(?=[\s/>]|$)""", re.I)
_part = re.compile(r"[a-z]+|[A-Z][a-z]*|[A-Z]+")


class Element:
    """An element of a page: name, whether its marks say it is no part of the article, and children."""

    __slots__ = ("name", "foreign", "worded", "marks", "children")

    def __init__(self, name: str, rest: str = ""):
        self.name, self.children = name, []
        found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _attribute.finditer(rest)} if rest else {}
        words = {w.lower() for key in ("class", "id", "role") for w in _part.findall(found.get(key, ""))}
        hidden = "hidden" in found or found.get("aria-hidden", "").lower() == "true" or "display:none" in found.get("style", "").replace(" ", "").lower()
        # Foreign by its words alone: a container of the article may carry such a word as well.
        self.worded = bool(words & FOREIGN) and name not in ("html", "body")
        self.foreign = name in SILENT or name in ASIDE or hidden or self.worded
        self.worded = self.worded and not (name in SILENT or name in ASIDE or hidden)
        self.marks = "main" if name in MAIN or "main" in words and found.get("role", "").lower() == "main" or found.get("itemprop") == "articleBody" else ""

    @property
    def symbol(self) -> str:
        return self.name + ("!" if self.foreign else "") + ("*" if self.marks else "")


def parse(html: str) -> Element:
    """Tree of a page. Missing end tags are supplied, stray ones dropped; comments and raw elements have no text."""
    root = Element("#page")
    open_ = [root]
    at, end = 0, len(html)
    while at < end:
        m = _token.match(html, at)
        at = m.end()
        if m["text"] is not None:
            children = open_[-1].children
            if children and isinstance(children[-1], str):
                children[-1] += m["text"]
            else:
                children.append(m["text"])
            continue
        if m["name"] is None:
            continue
        name = m["name"].lower()
        if m["close"]:
            for depth in range(len(open_) - 1, 0, -1):
                if open_[depth].name == name:
                    del open_[depth:]
                    break
                if name not in BLOCKS and open_[depth].name in BLOCKS:
                    break
            continue
        if name in BLOCKS:
            # A block ends an open paragraph, and the inline elements left open in it.
            for depth in range(len(open_) - 1, 0, -1):
                if open_[depth].name == "p":
                    del open_[depth:]
                    break
                if open_[depth].name in BLOCKS:
                    break
        ends, within = ENDS.get(name, ((), ()))
        for depth in range(len(open_) - 1, 0, -1):
            if open_[depth].name in ends:
                del open_[depth:]
                break
            if open_[depth].name in within or not ends:
                break
        element = Element(name, m["rest"])
        open_[-1].children.append(element)
        if name in RAW:
            close = re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(html, at)
            at = close.end() if close else end
        elif name not in VOID and not m["rest"].endswith("/") and len(open_) < DEPTH:
            open_.append(element)
    _keep_containers(root)
    return root


def _keep_containers(element: Element) -> bool:
    """Whether the article is in the element; one that holds it is not foreign for its words."""
    inside = any([_keep_containers(child) for child in element.children if isinstance(child, Element)])
    if inside and element.worded:
        element.foreign = False
    return not element.foreign and bool(inside or element.marks)


# A wrapper is a list of items: ["=", text], ["#"] for a slot, and [symbol, items, quantifier] for an element,
# where the quantifier is "1", "?" for an optional, "+" for a repeated and "*" for an optional repeated group.

def wrap(element: Element) -> list:
    """Wrapper of one page: its tokens, runs of like siblings folded into repeated groups."""
    items = []
    for child in element.children:
        if isinstance(child, str):
            text = " ".join(entities.unescape(child).split())
            if text:
                items.append(["=", text if len(text) <= SHORT else _digest(text)])
        else:
            items.append([child.symbol, wrap(child), "1"])
    return fold(items)


def _digest(text: str) -> str:
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()


def _key(item: list) -> str:
    return "#" if item[0] in ("#", "=") else item[0]


def fold(items: list) -> list:
    """Resolve repetition: neighbours with the same symbol become one repeated group, and what is still long is grouped by symbol."""
    folded: list = []
    for item in items:
        if folded and _key(folded[-1]) == _key(item):
            folded[-1] = unite(folded[-1], item, repeated=True)
        else:
            folded.append(item)
    if len(folded) <= LONGEST:
        return folded
    # Groups that alternate: each symbol becomes one optional repeated group, in order of first appearance.
    groups: dict[str, list] = {}
    for item in folded:
        groups[_key(item)] = unite(groups[_key(item)], item, repeated=True) if _key(item) in groups else item
    return [_optional(item) for item in groups.values()]


def unite(a: list, b: list, repeated: bool = False) -> list:
    """One item for two with the same symbol: unequal texts become a slot, elements are aligned inside."""
    if _key(a) == "#":
        return a if a == b and not repeated else ["#"]
    optional = "?" in (a[2], b[2]) or "*" in (a[2], b[2])
    many = repeated or a[2] in "+*" or b[2] in "+*"
    return [a[0], align(a[1], b[1]), ("*" if optional else "+") if many else ("?" if optional else "1")]


def align(a: list, b: list) -> list:
    """Align two token streams; what only one of them has becomes optional."""
    if a == b:
        return a
    if list(map(_key, a)) == list(map(_key, b)):
        return [unite(x, y) for x, y in zip(a, b)]
    n, m = len(a), len(b)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best[i][j] = 1 + best[i + 1][j + 1] if _key(a[i]) == _key(b[j]) else max(best[i + 1][j], best[i][j + 1])
    made, i, j = [], 0, 0
    while i < n or j < m:
        if i < n and j < m and _key(a[i]) == _key(b[j]):
            made.append(unite(a[i], b[j]))
            i, j = i + 1, j + 1
        elif j == m or i < n and best[i + 1][j] >= best[i][j + 1]:
            made.append(_optional(a[i]))
            i += 1
        else:
            made.append(_optional(b[j]))
            j += 1
    return fold(made)


def _optional(item: list) -> list:
    return ["#"] if _key(item) == "#" else [item[0], item[1], {"1": "?", "+": "*"}.get(item[2], item[2])]


def infer(pages: list[str]) -> list:
    """Wrapper of some pages of a host, aligned one after the other."""
    made: list | None = None
    for page in pages:
        own = wrap(parse(page))
        made = own if made is None else align(made, own)
    return made or []


def main_path(wrapper: list, pages: int) -> list[str]:
    """Symbols from the page down to the element that holds the article.

    That is the first element marked as article or main part, the innermost one if all marked ones are
    nested. Without one it is the innermost container of all slots that are not in foreign elements; a text
    that not all pages have counts as a slot. In the wrapper of a single page, and in one without any slot,
    every text counts as one.
    """
    marked: list[list[str]] = []
    slots: list[list[str]] = []
    texts: list[list[str]] = []

    def walk(items: list, path: list[str], optional: bool) -> None:
        for item in items:
            if _key(item) == "#":
                texts.append(path)
                if item[0] == "#" or optional:
                    slots.append(path)
            elif "!" not in item[0]:
                if item[0].endswith("*"):
                    marked.append([*path, item[0]])
                walk(item[1], [*path, item[0]], optional or item[2] in "?*")

    walk(wrapper, [], False)
    if marked:
        nested = all(path[: len(marked[0])] == marked[0] for path in marked)
        return max(marked, key=len) if nested else marked[0]
    if pages == 1 or not slots:
        slots = texts
    shared = slots[0] if slots else []
    for path in slots:
        shared = shared[: next((k for k, (x, y) in enumerate(zip(shared, path)) if x != y), min(len(shared), len(path)))]
    while shared and shared[-1] not in CONTAINERS:
        shared = shared[:-1]
    return shared


def template(page: Element, own: list) -> str:
    """Digest of what pages of one template share: where the page's own wrapper finds the article, and all its
    containers that are not foreign, each named by the way to it, however often it occurs."""
    ways: set[str] = set()

    def walk(element: Element, way: str) -> None:
        for child in element.children:
            if not isinstance(child, str) and not child.foreign:
                to = f"{way}/{child.symbol}"
                if child.name in CONTAINERS or child.marks:
                    ways.add(to)
                walk(child, to)

    walk(page, "")
    return _digest("\n".join([" ".join(main_path(own, 1)), *sorted(ways)]))


def _shape(items: list) -> list:
    """A wrapper without its texts."""
    return ["#" if _key(item) == "#" else [item[0], _shape(item[1]), item[2]] for item in items]


def article(page: Element, path: list[str]) -> list[Element]:
    """Elements of the page at the end of the path; further elements on it may be skipped. Outermost ones only."""
    found: list[Element] = []

    def walk(element: Element, rest: list[str]) -> None:
        for child in element.children:
            if isinstance(child, str) or child.foreign:
                continue
            left = rest[1:] if rest and child.symbol == rest[0] else rest
            if not left:
                found.append(child)
            else:
                walk(child, left)

    if not path:
        return [page]
    walk(page, path)
    return found


def blocks(elements: list[Element]) -> list[str]:
    """Texts of the blocks below the elements, in order: references decoded, white space turned into one space."""
    made: list[str] = []
    held: list[str] = []

    def close() -> None:
        text = " ".join("".join(held).split())
        held.clear()
        if text:
            made.append(text)

    def walk(element: Element, top: bool) -> None:
        if element.foreign and not top:
            return
        block = element.name in BLOCKS
        if block:
            close()
        for child in element.children:
            if isinstance(child, str):
                held.append(entities.unescape(child))
            elif child.name == "br":
                held.append(" ")
            else:
                walk(child, False)
        if block:
            close()

    for element in elements:
        walk(element, True)
        close()
    return made


def extract(html: str | None, path: list[str] | None) -> str:
    """Main text of a page, by the path of its template's wrapper; by the page's own wrapper where that finds nothing."""
    if not html:
        return ""
    page = parse(html)
    found = blocks(article(page, path)) if path is not None else []
    if not found:
        found = blocks(article(page, main_path(wrap(page), 1)))
    return "\n".join(found)


def wrappers(df: DataFrame, url_column: str = "url", html_column: str = "html") -> DataFrame:
    """Wrapper and path of the article for every template of every host, as JSON: ``host, template, wrapper, path``.

    Inferred from all pages. Wrappers of one shape differ in texts only, so they are united in any order, first
    those of a batch; the shapes of a template are then aligned in order of their digests, in parts and across
    parts. A task holds one wrapper at a time, however many pages a host has.
    """
    pages = df.select(host(url_column).alias("host"), F.col(html_column).alias("html")).where("html <> ''")

    def shapes(columns: dict[str, list]) -> dict[str, list]:
        met: dict[tuple[str, str, str], tuple[list, str | None]] = {}
        for name, html in zip(columns["host"], columns["html"]):
            page = parse(html)
            made, seen = wrap(page), _digest(html)
            key = (name, template(page, made), _digest(json.dumps(_shape(made))))
            met[key] = _united(met[key], (made, seen)) if key in met else (made, seen)
        return {
            "host": [k[0] for k in met], "template": [k[1] for k in met], "shape": [k[2] for k in met],
            "wrapper": [json.dumps(made) for made, _ in met.values()], "page": [seen for _, seen in met.values()],
        }

    found = rows_mapped(pages, shapes, _PARTIAL).withColumn("part", F.pmod(F.xxhash64("shape"), F.lit(PARTS)))
    parts = _aligned(found, ["host", "template", "part"])
    whole = _aligned(parts, ["host", "template"])

    def work(columns: dict[str, list]) -> dict[str, list]:
        # A template of one page, however often it is there, has no texts to compare.
        paths = [main_path(json.loads(made), 1 if page else 2) for made, page in zip(columns["wrapper"], columns["page"])]
        return {**{c: columns[c] for c in ("host", "template", "wrapper")}, "path": list(map(json.dumps, paths))}

    return rows_mapped(whole, work, "host string, template string, wrapper string, path string")


# A wrapper of some pages: ``shape`` orders those of a template, ``page`` is the digest of the only page, or null.
_PARTIAL = "host string, template string, shape string, wrapper string, page string"


def _united(a: tuple[list, str | None], b: tuple[list, str | None]) -> tuple[list, str | None]:
    return align(a[0], b[0]), a[1] if a[1] == b[1] else None


def _aligned(found: DataFrame, keys: list[str]) -> DataFrame:
    """One wrapper per key: those of one shape are united, then the shapes aligned in their order."""
    names = [field.split()[0] for field in _PARTIAL.split(", ")]

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in source for row in zip(*(batch.column(c).to_pylist() for c in [*names, *keys])))
        key = shape = first = held = same = None
        for name, kind, own, made, page, *at in rows:
            if at != key:
                if key is not None:
                    yield _row(*first, _united(held, same) if held else same)
                key, shape, first, held, same = at, own, (name, kind, own), None, (json.loads(made), page)
            elif own == shape:
                same = _united(same, (json.loads(made), page))
            else:
                held = _united(held, same) if held else same
                shape, same = own, (json.loads(made), page)
        if key is not None:
            yield _row(*first, _united(held, same) if held else same)

    def _row(name: str, kind: str, own: str, made: tuple[list, str | None]) -> pa.RecordBatch:
        values = (name, kind, own, json.dumps(made[0]), made[1])
        return pa.RecordBatch.from_arrays([pa.array([v], pa.string()) for v in values], names=names)

    return found.repartition(*keys).sortWithinPartitions(*keys, "shape").mapInArrow(batches, _PARTIAL)


def host(url_column: str):
    """Lowered host of an address without its port; empty where there is none."""
    found = F.regexp_extract(F.col(url_column), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.coalesce(F.lower(found), F.lit(""))


def main_text(df: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """Main text of every page.

    Pages of one template of a host are aligned as token streams into a wrapper, a regular expression without
    alternatives: unequal texts become slots, tokens that only some pages have become optional groups, like
    neighbours repeated groups. All pages take part. Pages are of one template if they have the same containers
    and the article in the same one by their own wrappers, so a page of another template is not read by a path
    that misses its article. The wrapper tells which element holds the article; its blocks are returned but for
    elements that by name, class, id or role are menus, headers, notices, adverts, forms, comments and the
    like. No text is dropped for being the same on several pages. The wrappers are joined to all pages by
    host and template; adaptive execution splits a template that holds many.

    A null or empty page, or one without text, has an empty text. Null urls and urls without a host count as
    one host. Broken markup is read as far as it goes. Repeated rows give repeated rows; other columns are
    ignored. Returns ``page_id, url, text``.
    """
    known = wrappers(df, url_column, html_column).select("host", "template", "path")
    pages = df.select(F.col(id_column).alias("page_id"), F.col(url_column).alias("url"), host(url_column).alias("host"), F.col(html_column).alias("html"))
    types = dict(pages.dtypes)

    def named(htmls: list) -> dict[str, list]:
        trees = [parse(html) if html else None for html in htmls]
        return {"template": [template(tree, wrap(tree)) if tree else None for tree in trees]}

    joined = columns_added(pages, "html", named, "template string").join(known, ["host", "template"], "left")

    def work(columns: dict[str, list]) -> dict[str, list]:
        paths = {path: json.loads(path) if path else None for path in set(columns["path"])}
        text = [extract(html, paths[path]) for html, path in zip(columns["html"], columns["path"])]
        return {"page_id": columns["page_id"], "url": columns["url"], "text": text}

    return rows_mapped(joined.select("page_id", "url", "html", "path"), work, f"page_id {types['page_id']}, url string, text string")
