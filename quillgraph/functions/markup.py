"""Markup functions: escaping, fragments, listing and sitemap edits, whole pages."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .html import VOID
from .text import month_year, reading_time_text, truncate_chars
from .udf import arrow_udf

#: Parts of the documents' format.
GRID = '<div class="article-grid">'
GRAPH_MARK = "<!-- graph block: hand-authored, do not edit via admin WYSIWYG -->"
MIN_STEPS, MAX_STEPS = 2, 5
_SAFE = r'<a href="[a-z0-9-]+\.html">[^<]*</a>|</?(?:strong|em|u)>'


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def escape_html(c: Column | str) -> Column:
    out = F.coalesce(_col(c), F.lit(""))
    for sign, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        out = F.replace(out, F.lit(sign), F.lit(entity))
    return out


def escape_attr(c: Column | str) -> Column:
    return F.replace(escape_html(c), F.lit('"'), F.lit("&quot;"))


def unescape_html(c: Column | str) -> Column:
    """What ``escape_attr`` and ``escape_html`` were given."""
    out = _col(c)
    for sign, entity in (('"', "&quot;"), (">", "&gt;"), ("<", "&lt;"), ("&", "&amp;")):
        out = F.replace(out, F.lit(entity), F.lit(sign))
    return out


def json_ld_script(value: Column) -> Column:
    """JSON that cannot close a script element."""
    return F.replace(F.to_json(value), F.lit("<"), F.lit("\\u003c"))


def valid_steps(steps: Column | str) -> Column:
    """Two to five labels, none of them blank."""
    s = _col(steps)
    return F.coalesce(F.size(s).between(MIN_STEPS, MAX_STEPS) & F.forall(s, lambda x: F.coalesce(F.trim(x) != "", F.lit(False))), F.lit(False))


def flow_graph_html(title: Column | str, steps: Column | str) -> Column:
    items = F.array_join(F.transform(_col(steps), lambda s: F.concat(F.lit('<li class="graph-flow__step">'), escape_html(s), F.lit("</li>"))), "")
    return F.concat(
        F.lit(f'{GRAPH_MARK}<figure class="graph-block graph-block--flow"><figcaption class="graph-block__title">'),
        escape_html(title),
        F.lit('</figcaption><ol class="graph-flow graph-flow--steps">'),
        items,
        F.lit("</ol></figure>"),
    )


def body_to_html(c: Column | str) -> Column:
    """Blank-line separated blocks to h2 and p elements; safe inline tags pass, all else is escaped.

    Safe tags are set apart by two control characters before the text between them is
    escaped; these characters are dropped from the input.
    """
    raw = F.regexp_replace(F.coalesce(_col(c), F.lit("")), "[\x01\x02]", "")
    blocks = F.filter(F.transform(F.split(raw, r"\n\s*\n"), lambda b: F.regexp_replace(b, r"^\s+|\s+$", "")), lambda b: b != "")

    def paragraph(block: Column) -> Column:
        parts = F.split(F.regexp_replace(block, f"(?i)({_SAFE})", "\x01\x02$1\x01"), "\x01")
        shown = F.transform(parts, lambda p: F.when(p.startswith("\x02"), F.substring(p, 2, 1 << 30)).otherwise(F.replace(escape_html(p), F.lit("\n"), F.lit("<br>"))))
        return F.concat(F.lit("<p>"), F.array_join(shown, ""), F.lit("</p>"))

    def one(block: Column) -> Column:
        heading = F.regexp_extract(block, r"^##\s+([^\n]+)$", 1)
        return F.when((heading != "") & ~block.contains("\n"), F.concat(F.lit("<h2>"), escape_html(F.trim(heading)), F.lit("</h2>"))).otherwise(paragraph(block))

    return F.array_join(F.transform(blocks, one), "")


def _insert(text: Column, at: Column, piece: Column) -> Column:
    return F.concat(F.substring(text, F.lit(1), (at - 1).cast("int")), piece, F.substring(text, at.cast("int"), F.length(text)))


def insert_card(html: Column, card: Column) -> Column:
    """Listing with ``card`` behind the opening of its first article grid; an error where there is none."""
    at = F.instr(html, GRID)
    missing = F.raise_error(F.lit("the listing has no article grid")).cast("string")
    return F.when(at > 0, _insert(html, at + len(GRID), card)).otherwise(missing)


def insert_url(xml: Column, url: Column) -> Column:
    """Sitemap with ``url`` before its end; an error where it has no end."""
    at = F.instr(xml, "</urlset>")
    missing = F.raise_error(F.lit("the sitemap has no </urlset>")).cast("string")
    return F.when(at > 0, _insert(xml, at, url)).otherwise(missing)


def replace_graph_figure(html: Column, figure: Column) -> Column:
    """Body with its only graph figure, and the mark before it, replaced; an error unless there is exactly one."""
    pattern = r"(?s)(?:<!-- graph block:[^>]*-->\s*)?<figure class=\"graph-block[^>]*>.*?</figure>"
    count = F.regexp_count(html, F.lit(pattern))
    wrong = F.raise_error(F.lit("expected exactly one graph figure")).cast("string")
    literal = F.replace(F.replace(figure, F.lit("\\"), F.lit("\\\\")), F.lit("$"), F.lit("\\$"))
    return F.when(count == 1, F.regexp_replace(html, F.lit(pattern), literal)).otherwise(wrong)


class _TopLevel(HTMLParser):
    """Top-level nodes of a fragment: tag (empty for text), text length, and the end offset in the source."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.html = html
        self.nodes: list[list] = []
        self.open: list[str] = []
        self.lines = [0, *(m.end() for m in re.finditer("\n", html))]
        self.feed(html)
        self.close()
        self._end(len(html))

    def _offset(self) -> int:
        line, column = self.getpos()
        return self.lines[line - 1] + column

    def _end(self, at: int) -> None:
        if self.nodes and self.nodes[-1][2] is None:
            self.nodes[-1][2] = at

    def _begin(self, tag: str) -> None:
        if not self.open:
            self._end(self._offset())
            self.nodes.append([tag, 0, None])

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self._begin(tag)
        if tag not in VOID:
            self.open.append(tag)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self._begin(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in self.open:
            while self.open.pop() != tag:
                pass
            if not self.open:
                self.nodes[-1][2] = self.html.index(">", self._offset()) + 1

    def handle_data(self, data: str) -> None:
        if not self.open:
            if not self.nodes or self.nodes[-1][0]:
                self._begin("")
        if self.nodes:
            self.nodes[-1][1] += len(data)


def _with_figure(html: str, figure: str) -> str:
    nodes = _TopLevel(html).nodes
    total, before, last = sum(n[1] for n in nodes), 0, None
    for tag, length, end in nodes if total else []:
        if tag == "h2":
            last = end
            if before * 2 >= total:
                break
        before += length
    return html + figure if last is None else html[:last] + figure + html[last:]


@arrow_udf("string")
def insert_figure(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """Bodies (flat HTML) with a figure behind the first h2 that begins at or behind half of the text.

    Without such an h2 it goes behind the last one, and without any, or without text, to the end.
    """
    for bodies, figures in parts:
        yield pd.Series([_with_figure(b or "", f or "") for b, f in zip(bodies, figures)])


def article_card(slug: Column, title: Column, summary: Column, category: Column, published: Column, minutes: Column) -> Column:
    return F.concat(
        F.lit('<a class="article-card" href="'), escape_attr(slug), F.lit('.html"><span class="tag">'), escape_html(category), F.lit("</span><h3>"), escape_html(title),
        F.lit("</h3><p>"), escape_html(truncate_chars(summary, 160)), F.lit("</p><span>"), month_year(published), F.lit(" · "), reading_time_text(minutes), F.lit("</span></a>"),
    )


def sitemap_url(location: Column, modified: Column) -> Column:
    return F.concat(F.lit("<url><loc>"), escape_html(location), F.lit("</loc><lastmod>"), modified, F.lit("</lastmod><changefreq>monthly</changefreq><priority>0.8</priority></url>"))


def article_document(
    site: str, slug: Column, title: Column, summary: Column, body_html: Column, author: Column, published: Column,
    title_zh: Column | None = None, body_zh_html: Column | None = None, presets: dict[str, str] | None = None, preset: Column | None = None,
) -> Column:
    """A whole page: head with Article and BreadcrumbList data, hero and body, as ``sources.html_pages`` reads it.

    With a Chinese title and body the page has both languages side by side. ``presets`` are closing sections
    by name; ``preset`` names that of a page, and an unknown or null name means the first.
    """
    zh = lambda opening, inner, closing: F.lit("") if inner is None else F.concat(F.lit(opening), inner, F.lit(closing))
    closing = F.lit("")
    if presets:
        known = F.create_map(*(F.lit(x) for pair in presets.items() for x in pair))
        closing = F.coalesce(F.try_element_at(known, preset if preset is not None else F.lit(None).cast("string")), F.lit(next(iter(presets.values()))))
    address = F.concat(F.lit(f"{site}/"), slug, F.lit(".html"))
    article = F.struct(
        F.lit("https://schema.org").alias("@context"), F.lit("Article").alias("@type"), title.alias("headline"), summary.alias("description"),
        published.alias("datePublished"), published.alias("dateModified"), F.struct(F.lit("Person").alias("@type"), author.alias("name")).alias("author"), address.alias("mainEntityOfPage"),
    )
    crumbs = F.struct(
        F.lit("https://schema.org").alias("@context"), F.lit("BreadcrumbList").alias("@type"),
        F.array(
            F.struct(F.lit("ListItem").alias("@type"), F.lit(1).alias("position"), F.lit("Home").alias("name"), F.lit(f"{site}/").alias("item")),
            F.struct(F.lit("ListItem").alias("@type"), F.lit(2).alias("position"), title.alias("name"), address.alias("item")),
        ).alias("itemListElement"),
    )
    script = lambda value: F.concat(F.lit('<script type="application/ld+json">'), json_ld_script(value), F.lit("</script>"))
    return F.concat(
        F.lit('<!DOCTYPE html><html lang="en"><head><meta charset="utf-8"><title>'), escape_html(title), F.lit('</title><meta name="description" content="'), escape_attr(summary),
        F.lit('"><link rel="canonical" href="'), escape_attr(address), F.lit('">'), script(article), script(crumbs),
        F.lit('</head><body><section class="course-hero"><div data-lang="en"><h1>'), escape_html(title),
        F.lit("</h1></div>"), zh('<div data-lang="zh"><h1>', None if title_zh is None else escape_html(title_zh), "</h1></div>"),
        F.lit('</section><article class="article-body"><div data-lang="en">'), body_html, F.lit("</div>"), zh('<div data-lang="zh">', body_zh_html, "</div>"),
        F.lit("</article>"), closing, F.lit("</body></html>"),
    )


def _link(body: str, links: list[dict]) -> dict:
    """Anchors at first mentions, in order of the suggestions; spans keep their places as anchors grow."""
    inserted, skipped, spans = [], [], []
    for link in links:
        found = re.search(rf"(?<![A-Za-z0-9]){re.escape(link['entity'])}(?![A-Za-z0-9])", body, re.IGNORECASE)
        if found is None or any(found.start() < end and found.end() > start for start, end in spans):
            skipped.append(link["entity"])
            continue
        anchor = f'<a href="{link["target_slug"]}.html">{found[0]}</a>'
        grown = len(anchor) - len(found[0])
        body = body[: found.start()] + anchor + body[found.end() :]
        spans = [(s + grown, e + grown) if s >= found.start() else (s, e) for s, e in spans]
        spans.append((found.start(), found.start() + len(anchor)))
        inserted.append(link["entity"])
    return {"body": body, "inserted": inserted, "skipped": skipped}


@arrow_udf("body string, inserted array<string>, skipped array<string>")
def _insert_links(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    for bodies, links in parts:
        yield pd.DataFrame([_link(b or "", list(k) if k is not None else []) for b, k in zip(bodies, links)], columns=["body", "inserted", "skipped"])


def insert_links(body: Column, links: Column) -> Column:
    """struct(body, inserted, skipped) after ``links`` (array of entity, target_slug) in order.

    Each insertion moves what follows it and may cover a later mention, so this is a
    sequential edit of one text and runs as an Arrow UDF.
    """
    return _insert_links(body, links)
