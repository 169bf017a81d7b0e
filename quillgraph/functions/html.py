"""HTML functions. The DOM ones parse with the standard library in Arrow UDFs: there is no built-in HTML parser."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from .udf import arrow_udf, plain_arrow_udf

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Elements whose text makes the body, in document order.
BLOCKS = frozenset("h2 h3 h4 p blockquote li".split())
#: Elements that an opening block ends implicitly.
_CLOSES = {"p": {"p"}, "li": {"p", "li"}, "h2": {"p"}, "h3": {"p"}, "h4": {"p"}, "blockquote": {"p"}, "div": {"p"}, "ul": {"p"}, "ol": {"p"}}


class Node:
    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag: str, attrs: dict[str, str | None], parent: Node | None):
        self.tag, self.attrs, self.parent, self.children = tag, attrs, parent, []

    @property
    def classes(self) -> set[str]:
        return set((self.attrs.get("class") or "").split())

    def walk(self) -> Iterator[Node]:
        stack = [self]
        while stack:
            node = stack.pop()
            yield node
            stack.extend(c for c in reversed(node.children) if isinstance(c, Node))

    def text(self) -> str:
        out, stack = [], [self]
        while stack:
            node = stack.pop()
            if isinstance(node, str):
                out.append(node)
            else:
                stack.extend(reversed(node.children))
        return "".join(out)


class _Builder(HTMLParser):
    """A forgiving tree: unknown end tags are ignored, open elements end with their parent."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("#root", {}, None)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        while self.at.tag in _CLOSES.get(tag, ()) and self.at.parent:
            self.at = self.at.parent
        node = Node(tag, dict(attrs), self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.at.children.append(Node(tag, dict(attrs), self.at))

    def handle_endtag(self, tag: str) -> None:
        node = self.at
        while node is not None and node.tag != tag:
            node = node.parent
        if node is not None and node.parent is not None:
            self.at = node.parent

    def handle_data(self, data: str) -> None:
        self.at.children.append(data)


def parse(html: str | None) -> Node:
    builder = _Builder()
    builder.feed(html or "")
    builder.close()
    return builder.root


#: What is no content, as tag and class (either may be any).
BOILERPLATE = (("nav", "navbar"), ("footer", "footer"), ("", "cta-section"), ("", "sticky-cta-bar"), ("script", ""), ("style", ""), ("", "graph-block"))


def _boilerplate(node: Node) -> bool:
    return any(node.tag == (tag or node.tag) and (not name or name in node.classes) for tag, name in BOILERPLATE)


def strip_boilerplate(root: Node) -> Node:
    for node in list(root.walk()):
        node.children = [c for c in node.children if not (isinstance(c, Node) and _boilerplate(c))]
    return root


def squeeze(text: str) -> str:
    return re.sub(r"\s+", " ", text).strip()


def _below(root: Node, name: str) -> set[int]:
    """Identities of the nodes of class ``name`` and of all below them."""
    return {id(n) for top in root.walk() if top is not root and name in top.classes for n in top.walk()}


def text_blocks(root: Node) -> list[str]:
    """Texts of block elements in document order, without bylines (class article-meta); a block inside a block counts twice."""
    bylines = _below(root, "article-meta")

    def text(node: Node) -> str:
        if not bylines:
            return node.text()
        return "".join(c if isinstance(c, str) else "" if id(c) in bylines else text(c) for c in node.children)

    return [t for t in (squeeze(text(n)) for n in root.walk() if n.tag in BLOCKS and id(n) not in bylines) if t]


def find(root: Node, test) -> Node | None:
    return next((n for n in root.walk() if test(n)), None)


def english(root: Node, inside: str, direct: bool) -> Node | None:
    """The data-lang="en" element inside (or directly below) the element of class ``inside``."""
    outer = find(root, lambda n: inside in n.classes)
    if outer is None:
        return None
    pool = [c for c in outer.children if isinstance(c, Node)] if direct else list(outer.walk())[1:]
    return next((n for n in pool if n.attrs.get("data-lang") == "en"), None)


def _inside(node: Node, root: Node, tags: list[str]) -> bool:
    """Whether ``node`` has, from inner to outer, these ancestors below ``root``."""
    left, at = list(tags), node.parent
    while left and at is not None and at is not root:
        if at.tag == left[0]:
            left.pop(0)
        at = at.parent
    return not left


_LINK = re.compile(r"^([a-z0-9][a-z0-9-]*)\.html$", re.IGNORECASE)


def internal_links(root: Node) -> list[dict[str, str]]:
    """First link to each page of the site in the lists of the related articles: target_slug, link_text."""
    found: dict[str, str] = {}
    for box in (n for n in root.walk() if "article-related" in n.classes):
        for a in (n for n in box.walk() if n.tag == "a" and _inside(n, box, ["li", "ul"])):
            m = _LINK.match(a.attrs.get("href") or "")
            if m and m[1] not in found:
                shown = find(a, lambda n: n.attrs.get("data-lang") == "en") or a
                found[m[1]] = squeeze(shown.text())
    return [{"target_slug": k, "link_text": v} for k, v in found.items()]


#: Elements whose text is not translated; so are figures of class graph-block.
_SKIP = frozenset("script style".split())


def text_nodes(root: Node) -> list[dict[str, str]]:
    """Non-blank text outside skipped subtrees, numbered from "1"."""
    out: list[dict[str, str]] = []

    def visit(node: Node) -> None:
        for child in node.children:
            if isinstance(child, str):
                if child.strip():
                    out.append({"id": str(len(out) + 1), "text": child})
            elif child.tag not in _SKIP and not (child.tag == "figure" and "graph-block" in child.classes):
                visit(child)

    visit(root)
    return out


#: Pages whose texts and results are Python objects at once; the others of a batch are in Arrow's buffers.
PIECE = 64


def _of_pages(pages: Iterator[pa.Array], of: Callable[[Node], list], kind: pa.DataType) -> Iterator[pa.Array]:
    """``of`` the tree of each page. A tree is taken apart at once, as its parents and children hold each other."""

    def one(html: str | None) -> list:
        root = parse(html)
        nodes = list(root.walk())
        try:
            return of(root)
        finally:
            for node in nodes:
                node.parent = None

    for batch in pages:
        parts = [pa.array([one(h.as_py()) for h in batch.slice(a, PIECE)], kind) for a in range(0, len(batch), PIECE)]
        yield pa.concat_arrays(parts) if parts else pa.array([], kind)


@plain_arrow_udf("array<string>")
def html_blocks(pages: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Text blocks of each page without boilerplate."""
    yield from _of_pages(pages, lambda root: text_blocks(strip_boilerplate(root)), pa.list_(pa.string()))


@plain_arrow_udf("array<struct<id:string,text:string>>")
def translatable_nodes(pages: Iterator[pa.Array]) -> Iterator[pa.Array]:
    yield from _of_pages(pages, text_nodes, pa.list_(pa.struct([("id", pa.string()), ("text", pa.string())])))


def strip_markup(c: Column) -> Column:
    """Text without script, style, nav and footer elements and without tags, by patterns alone."""
    out = F.coalesce(c, F.lit(""))
    for tag in ("script", "style", "nav", "footer"):
        out = F.regexp_replace(out, f"(?is)<{tag}\\b[^>]*>.*?</{tag}>", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(out, "<[^>]*>", " "), r"[ \t\n\r]+", " "))


def opening_tags(c: Column) -> Column:
    """Names of opening tags in order, lower case."""
    return F.transform(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit("<([A-Za-z][A-Za-z0-9]*)"), F.lit(1)), F.lower)


def hrefs(c: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit('href="([^"]*)"'), F.lit(1))


def same_structure(a: Column, b: Column) -> Column:
    """Whether two fragments have the same tags and the same links, in order."""
    return (opening_tags(a) == opening_tags(b)) & (hrefs(a) == hrefs(b))


_GRAPH = re.compile(r"""class\s*=\s*["']?[^"'>]*(?<![\w-])graph-block(?![\w-])""", re.IGNORECASE)
_PIECE = re.compile(r"(<!--.*?-->|<[^>]+>)", re.DOTALL)
_NAME = re.compile(r"<(/?)([A-Za-z][A-Za-z0-9]*)")


def with_texts(html: str, texts: dict[str, str]) -> str:
    """``html`` with the text nodes that ``text_nodes`` numbers replaced; outer blanks stay, markup is untouched.

    A node without a text is an error.
    """
    out, skipped, number = [], [], 0
    for piece in _PIECE.split(html):
        tag = _NAME.match(piece) if piece.startswith("<") else None
        if tag:
            name = tag[2].lower()
            if skipped and tag[1] and name == skipped[-1]:
                skipped.pop()
            elif not tag[1] and name not in VOID and (name in _SKIP or (name == "figure" and _GRAPH.search(piece)) or (skipped and name == skipped[-1])):
                skipped.append(name)
        elif not piece.startswith("<") and piece.strip() and not skipped:
            number += 1
            new = texts.get(str(number))
            if new is None:
                raise ValueError(f"no translation of text node {number}: {piece.strip()[:40]}")
            lead = len(piece) - len(piece.lstrip())
            piece = piece[:lead] + new.strip().replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;") + piece[len(piece.rstrip()) :]
        out.append(piece)
    return "".join(out)


@arrow_udf("string")
def apply_translations(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """Pages with translated text nodes put back (html, map from node id to text)."""
    for pages, texts in parts:
        yield pd.Series([None if p is None else with_texts(p, dict(t) if t is not None else {}) for p, t in zip(pages, texts)])
