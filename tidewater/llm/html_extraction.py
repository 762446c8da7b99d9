"""The main text of web pages by tree scoring."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Elements whose content is not markup.
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "xmp", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: Elements that are never part of an article.
DROPPED = RAW | {
    "head", "nav", "aside", "footer", "form", "button", "select", "option", "label", "fieldset", "input", "menu", "dialog",
    "object", "embed", "applet", "canvas", "audio", "video", "svg", "map", "datalist", "output", "progress", "annotation", "annotation-xml",
}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins",
    "kbd", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u",
    "var", "wbr", "label", "math", "menclose", "merror", "mfrac", "mi", "mmultiscripts", "mn", "mo", "mover", "mpadded", "mphantom",
    "mroot", "mrow", "ms", "mspace", "msqrt", "mstyle", "msub", "msubsup", "msup", "mtable", "mtd", "mtext", "mtr", "munder",
    "munderover", "semantics",
}
#: Elements that may stand within a paragraph, though their content is no part of it.
WITHIN = {"annotation", "annotation-xml", "audio", "button", "canvas", "datalist", "embed", "iframe", "input", "map", "noembed", "noscript",
          "object", "output", "progress", "script", "select", "style", "svg", "template", "textarea", "video"}
#: Where looking for an open paragraph stops.
STOPS = WITHIN | {"td", "th", "li", "div", "article", "section", "table"}
#: What a start tag ends if it is still open, and where looking for it stops.
ENDS = {"li": ({"li"}, {"ul", "ol"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}
WHOLE = {"article", "main"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Last parts of class names and ids that name something beside the article.
BESIDE = {
    "ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "adsense", "banner", "sponsor", "sponsored", "promo",
    "promotion", "sidebar", "aside", "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "crumbs", "footer", "foot",
    "header", "masthead", "topbar", "comment", "comments", "commentlist", "discussion", "disqus", "replies", "respond", "cookie",
    "cookies", "consent", "gdpr", "notice", "notices", "notification", "alert", "popup", "modal", "overlay", "newsletter",
    "subscribe", "subscription", "signup", "login", "register", "share", "sharing", "social", "related", "recommended",
    "recommendations", "widget", "widgets", "search", "searchbox", "pagination", "pager", "toolbar", "copyright", "legal",
    "disclaimer", "skip", "hidden", "paywall", "form",
}
#: Parts that only say what kind of box it is.
BOX = {
    "area", "block", "body", "bottom", "box", "bar", "button", "buttons", "col", "column", "container", "content", "group", "holder",
    "inner", "item", "items", "left", "link", "links", "list", "outer", "panel", "posts", "right", "row", "section", "slot", "text",
    "thread", "top", "unit", "wrap", "wrapper", "zone",
}
#: Of those, what an article element may be.
BESIDE_ARTICLES = {"ad", "ads", "advert", "advertisement", "comment", "comments", "promo", "related", "replies", "sponsored"}
#: Last parts that make a list of links within an article a menu.
MENUS = {"archives", "blogroll", "categories", "pages", "tabs", "tagcloud", "tags", "toc"}
SPARING = {"no", "has", "with", "without", "non"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "alertdialog", "form", "menu", "menubar", "toolbar"}
#: A sibling of the best container belongs to it if less of its text is in links.
LINKED = 0.25
#: Paragraphs shorter than this don't score; they are kept like others if their container is.
SCORED = 25

#: A quote opens a string only after an equals sign, and only if what follows its end can follow a string.
_STRING = r"=\s*(?:\"[^\"]*\"|'[^']*')(?=[\s/>]|\Z)"
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attributes>(?:[^>=]++|{_STRING}|=)*+)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)", re.DOTALL
)
_ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


class Node:
    __slots__ = ("beside", "children", "linked", "menu", "name", "parent", "score", "size")

    def __init__(self, name: str, parent: Node | None, beside: bool = False, menu: bool = False):
        self.name, self.parent, self.beside, self.menu = name, parent, beside, menu
        self.children: list[Node | str] = []
        self.score, self.size, self.linked = 0.0, 0, 0

    def link_density(self) -> float:
        return self.linked / self.size if self.size else 0.0


def _attributes(attributes: str) -> dict[str, str]:
    return {k.lower(): a or b or c for k, a, b, c in _ATTRIBUTE.findall(attributes)}


def _titles(found: dict[str, str]) -> Iterator[list[str]]:
    """The parts of each class name and id, without those last ones that say what kind of box it is."""
    for title in f"{found.get('class', '')} {found.get('id', '')}".split():
        parts = [p.lower() for p in _PART.findall(title)]
        while len(parts) > 1 and parts[-1] in BOX:
            parts.pop()
        yield parts


def _is_menu(attributes: str) -> bool:
    """Whether an element's classes or id say that its links are a menu."""
    return bool(attributes.strip()) and any(parts[-1:] and parts[-1] in MENUS for parts in _titles(_attributes(attributes)))


def _is_beside(name: str, attributes: str) -> bool:
    """Whether an element's name or attributes say that it is not part of the article."""
    if name in DROPPED and name != "label":
        return True
    if not attributes.strip():
        return False
    found = _attributes(attributes)
    if "hidden" in found or found.get("aria-hidden", "").lower() == "true" or found.get("role", "").lower() in ROLES:
        return True
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", found.get("style", "")):
        return True
    if name in ("main", "html", "body"):
        return False
    beside = BESIDE_ARTICLES if name == "article" else BESIDE
    for parts in _titles(found):
        own_header = parts[-1:] == ["header"] and {"article", "entry", "post", "story"} & set(parts)
        if parts and parts[-1] in beside and not SPARING & set(parts[:-1]) and not own_header:
            return True
    return False


def parse(html: str, by_name: bool = True) -> Node:
    """A tree of the page; what is left open is closed by what can't stand inside it, or by the end.

    ``by_name``: classes, ids and roles count.
    """
    root = node = Node("html", None)
    at, end, first = 0, len(html), True
    while at < end:
        token = _TOKEN.search(html, at)
        if token is None:
            node.children.append(unescape(html[at:]))
            break
        if token.start() > at:
            node.children.append(unescape(html[at : token.start()]))
        at = token.end()
        name = (token["name"] or "").lower()
        if not name or name in ("html", "body"):
            continue
        if token["end"]:
            above = node
            while above.parent is not None and above.name != name:
                above = above.parent
            if above.parent is not None:
                node = above.parent
            continue
        if name not in INLINE and name not in WITHIN:  # a block ends an open paragraph
            node = _close(node, {"p", *HEADINGS} if name == "p" or name in HEADINGS else {"p"}, STOPS)
        if name in ENDS:
            node = _close(node, *ENDS[name])
        attributes = token["attributes"] if by_name else ""
        new = Node(name, node, _is_beside(name, attributes) or (name == "label" and not _in_paragraph(node)), _is_menu(attributes))
        if name in WHOLE or name == "header":
            above = node
            while above is not None and above.name not in WHOLE:
                if first and name in WHOLE and not new.beside and above.name not in DROPPED:
                    above.beside = False  # a box around the article isn't beside it
                above = above.parent
            first &= name not in WHOLE
            new.beside |= name == "header" and above is None  # the page's header, not an article's
        node.children.append(new)
        if name in RAW:
            closing = re.compile(rf"</{re.escape(name)}[^>]*(?:>|\Z)", re.IGNORECASE).search(html, at)
            at = closing.end() if closing else end
        elif name not in VOID and not token["attributes"].endswith("/"):
            node = new
    return root


def _close(node: Node, names: set[str], stops: set[str]) -> Node:
    above = node
    while above.parent is not None and above.name not in stops:
        if above.name in names:
            return above.parent
        above = above.parent
    return node


def _in_paragraph(node: Node | None) -> bool:
    while node is not None and node.name in INLINE:
        node = node.parent
    return node is not None and node.name in {"p", *HEADINGS}


def _page_forms(root: Node) -> None:
    """A form around the page is a box: outside articles, with more text in scored paragraphs than there is elsewhere."""
    outside = -1
    stack = [root]
    while stack:
        node = stack.pop()
        if node.name == "form" and node.beside:
            if outside < 0:
                outside = sum(len(text) for _, text, _ in paragraphs(root))
            if sum(len(text) for _, text, _ in paragraphs(node) if len(text) >= SCORED) > outside:
                node.beside = False
                return
        elif not node.beside and node.name not in WHOLE:
            stack.extend(c for c in node.children if isinstance(c, Node) and (c.name == "form" or not c.beside))


def walk(root: Node, out: set[int] | None = None) -> Iterator[tuple[Node, Node | str, bool]]:
    """Texts and ends of elements in page order: (element, text or the element again, inside a link)."""
    stack: list[tuple[Node, int, bool]] = [(root, 0, root.name == "a")]
    while stack:
        node, i, linked = stack.pop()
        if i == len(node.children):
            yield node, node, linked
            continue
        stack.append((node, i + 1, linked))
        child = node.children[i]
        if isinstance(child, str):
            yield node, child, linked
        elif not child.beside and not (out and id(child) in out):
            yield child, "" if child.name in INLINE else child, linked
            stack.append((child, 0, linked or child.name == "a"))


def paragraphs(root: Node, out: set[int] | None = None) -> Iterator[tuple[Node, str, int]]:
    """The blocks of text in page order: (the element of the first text, the text, characters in links)."""
    texts: list[str] = []
    owner, linked, begun = root, 0, False
    for node, what, in_link in walk(root, out):
        if isinstance(what, str):
            if node.name == "br" and not what:
                texts.append(" ")
            elif what:
                if not begun and what.strip():
                    owner, begun = node, True
                texts.append(what)
                linked += len(what.strip()) if in_link else 0
        elif node.name not in INLINE:
            if text := " ".join("".join(texts).split()):
                yield owner, text, linked
            texts, linked, begun = [], 0, False
    if text := " ".join("".join(texts).split()):
        yield owner, text, linked


def score(root: Node) -> list[Node]:
    """Gives points to the containers of paragraphs; returns those that have any."""
    scored: dict[int, Node] = {}
    for owner, text, linked in paragraphs(root):
        while owner.name in INLINE and owner.parent is not None:
            owner = owner.parent
        own = owner
        while own is not None:
            own.size += len(text)
            own.linked += min(linked, len(text))
            own = own.parent
        if len(text) < SCORED:
            continue
        points = 1 + text.count(",") + min(len(text) // 100, 3)
        # text that stands directly in a container scores for it
        above = owner.parent if owner.name in {"p", "pre", "blockquote", "td", "li", "dd", *HEADINGS} else owner
        for share in (1, 2, 6, 9, 12):
            if above is None:
                break
            above.score += points / share
            scored[id(above)] = above
            above = above.parent
    for node in scored.values():
        node.score *= 1 - node.link_density()
    return list(scored.values())


def _menus(root: Node) -> set[int]:
    """Lists, tables and the like that are links for the most part; in an article or main, those that are menus by name."""
    links: dict[int, int] = {}
    found = set()
    for node, what, _ in walk(root):
        if what is node and node.name not in INLINE:
            n = sum(links.pop(id(c), 0) for c in node.children if isinstance(c, Node)) + sum(isinstance(c, Node) and c.name == "a" for c in node.children)
            links[id(node)] = n
            if n > 1 and node.name in ("ul", "ol", "dl", "table", "div", "section") and node.link_density() > 0.6 and (node.menu or not _in_whole(node)):
                found.add(id(node))
    return found


def _in_whole(node: Node | None) -> bool:
    while node is not None and node.name not in WHOLE:
        node = node.parent
    return node is not None


def main_text(html: str | None) -> str:
    """The text of the best container and of those siblings that belong to it."""
    return _best_text(html or "") or _best_text(html or "", by_name=False)


def _best_text(html: str, by_name: bool = True) -> str:
    root = parse(html, by_name)
    _page_forms(root)
    candidates = score(root)
    best = max(candidates, key=lambda n: n.score, default=None)
    top = best
    while top is not None and top.name not in WHOLE:
        top = top.parent
    if best is None:  # nothing scores: the article if there is one, else all that is left
        top = next((c for n, c, _ in walk(root) if isinstance(c, Node) and c is not n and c.name in WHOLE), None)
        top = top or next((c for _, c, _ in walk(root) if isinstance(c, Node) and c.name in WHOLE), root)
    out = _menus(root)
    if top is not None:
        return "\n".join(text for text in (_text(whole, out - {id(whole)}) for whole in _alongside(top)) if text)
    while best.parent is not None and best.parent.size == best.size:
        best = best.parent  # a box around the container alone
    if best.parent is None:
        return _text(best, out)
    return _text(best.parent, (out | _strangers(best)) - {id(best), id(best.parent)}, best.parent)


def _alongside(top: Node) -> list[Node]:
    """An article and those beside it that are not links for the most part, in page order."""
    if top.name != "article" or top.parent is None:
        return [top]
    others = (n for n in top.parent.children if isinstance(n, Node))
    return [n for n in others if n is top or (n.name == "article" and not n.beside and n.link_density() < LINKED)]


def _text(root: Node, out: set[int], above: Node | None = None) -> str:
    """The blocks of text, one a line; those that stand directly in ``above`` only if few of them are links."""
    return "\n".join(text for node, text, linked in paragraphs(root, out) if linked < LINKED * len(text) or not _directly(node, above))


def _directly(node: Node, above: Node | None) -> bool:
    while node is not above and node.name in INLINE and node.parent is not None:
        node = node.parent
    return node is above


def _strangers(best: Node) -> set[int]:
    """The siblings that don't belong to the best container: those with many links that don't score well."""
    least = max(10.0, best.score / 5)
    blocks = [n for n in best.parent.children if isinstance(n, Node) and n.name not in INLINE]
    return {id(n) for n in blocks if n is not best and n.score < least and n.link_density() >= LINKED}


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(html) for html in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
            ["page_id", "url", "text", "n_chars"],
        )


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` for each row of ``pages``.

    Each paragraph passes points for its length and commas to its container, and fewer to those
    above; links among their text take points from containers. The best container, or the article
    or main element it stands in, and its siblings that score well or have few links give the text:
    their blocks in page order, one a line. Elements that are menus, headers, footers and so on by
    name, role, class or id are left out first, lists of links last; in an article or main element
    only those lists that are menus by class or id.

    Rows are worked on where they are read. A null or empty page gives an empty text. Ids and
    addresses are passed on, null or repeated. Other columns are not read. Broken markup is read as
    far as it can be. An empty table gives an empty one.
    """
    read = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").alias("url"), F.col(f"`{html_col}`").alias("html"))
    return read.mapInArrow(_extracted, "page_id long, url string, text string, n_chars long")
