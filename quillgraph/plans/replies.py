"""Model replies, headings and listings made of whole tables, with their SQL.

Replies are JSON made of a row's own values, so what is wrong with one follows from the row and
SQL can say it without any JSON; some are cut off in the middle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import markup
from ..operators import contracts, retrieval
from ..sources import ingest
from .kg import Tables
from .registry import query

_BAD = "not the expected JSON"
_FIRST_LINE = "split_part(text, chr(10), 1)"
#: Words of small plain letters between single spaces.
_WORD = r"^[a-z]{3,}\z"
_WORDS = rf"list_filter(string_split(text, ' '), lambda w: regexp_matches(w, '{_WORD}'))"


def _words(text: Column) -> Column:
    return F.filter(F.split(text, " "), lambda w: F.rlike(w, F.lit(_WORD)))


def _first_line() -> Column:
    return F.split_part("text", F.lit("\n"), F.lit(1))


def _struct(**parts: Column) -> Column:
    return F.struct(*(c.alias(name) for name, c in parts.items()))


def _cut(reply: Column, cut: Column) -> Column:
    """The reply, or its first half."""
    return F.when(cut, F.left(reply, F.floor(F.length(reply) / 2).cast("int"))).otherwise(reply)


def _blank(*sql: str) -> str:
    return "(" + " or ".join(f"trim(coalesce({c}, '')) = ''" for c in sql) + ")"


@query("drafts_of_documents", rf"""
  with d as (select *, {_FIRST_LINE} as title, {_FIRST_LINE} || chr(10) || '## ' || ltrim(substring(text, length({_FIRST_LINE}) + 2), chr(10) || ' ') as body, string_split({_FIRST_LINE}, ' ')[:6] as steps from documents)
  select doc_id::varchar as key, case when n_chars % 11 = 0 then '{_BAD}' when {_blank("title", "source", "body")} then 'title, summary or body is blank'
    when not regexp_matches(body, '(?m)^##\s+\S') then 'the body has no section heading'
    when not (len(steps) between 2 and 5 and len(list_filter(steps, lambda s: trim(s) = '')) = 0) then 'two to five steps are needed' end as error from d""")  # fmt: skip
def _(t: Tables) -> DataFrame:
    """Every document as a draft: its first line as title, the rest as a section, the first words as steps."""
    title = _first_line()
    rest = F.ltrim(F.substring("text", F.length(title) + 2, F.length("text")), F.lit("\n "))
    body = F.concat(title, F.lit("\n## "), rest)
    reply = F.to_json(_struct(title=title, summary=F.col("source"), body_text=body, graph_steps=F.slice(F.split(title, " "), 1, 6)))
    asked = t.documents.select(F.col("doc_id").cast("string").alias("key"), _cut(reply, F.col("n_chars") % 11 == 0).alias("response"))
    return contracts.draft(asked).select("key", "error")


@query("search_metadata_of_documents", f"""
  select doc_id::varchar as key, case when n_chars % 13 = 0 then '{_BAD}' when {_blank(_FIRST_LINE, "left(text, 150)", "source", "lang")} then 'a text is blank'
    when len({_WORDS}) = 0 then 'a list is empty' when n_chars % 4 = 0 then 'heading levels are 2 to 4' end as error from documents""")  # fmt: skip
def _(t: Tables) -> DataFrame:
    line, words = _first_line(), F.slice(F.array_distinct(_words(F.col("text"))), 1, 5)
    reply = F.to_json(
        _struct(
            title=line, meta_description=F.left("text", F.lit(150)), canonical_slug=F.col("source"), og_title=F.col("lang"), og_description=line,
            primary_keywords=words, secondary_keywords=words, internal_anchor_texts=words,
            headings=F.array(_struct(level=F.col("n_chars") % 4 + 1, text=line)), faq=F.array(_struct(question=line, answer=F.col("lang"))),
        )
    )
    asked = t.documents.select(F.col("doc_id").cast("string").alias("key"), _cut(reply, F.col("n_chars") % 13 == 0).alias("response"))
    return contracts.seo(asked).select("key", "error")


def _replies_of_orders(t: Tables, **entity: Column) -> DataFrame:
    """key, response: for every order its lines as entities and edges; an order without lines says nothing of them."""
    line = t.lineitem.join(t.part.select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_brand", "p_type"), "l_partkey")
    edge = _struct(source=F.col("p_name"), relation=F.when(F.col("l_returnflag") == "N", F.lit(" ")).otherwise("part_of"), target=F.col("p_brand"), status=F.when(F.col("l_suppkey") % 7 == 0, "lost").otherwise("altered"))
    lines = line.groupBy("l_orderkey").agg(F.collect_list(_struct(name=F.col("p_name"), **entity)).alias("entities"), F.collect_list(edge).alias("edges"))
    return t.orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(F.col("o_orderkey").cast("string").alias("key"), F.to_json(_struct(entities=F.col("entities"), edges=F.col("edges"))).alias("response"))


@query("extractions_of_orders", """
  select o_orderkey::varchar as key, case when n is null then 'entities or edges are missing' when bare then 'an entity lacks name or type' when loose then 'an edge lacks a part' end as error
  from orders left join (select l_orderkey, count(*) as n, bool_or(l_quantity > 45) as bare, bool_or(l_returnflag = 'N') as loose from lineitem join part on p_partkey = l_partkey group by 1) l on l_orderkey = o_orderkey""")  # fmt: skip
def _(t: Tables) -> DataFrame:
    return contracts.extraction(_replies_of_orders(t, type=F.when(F.col("l_quantity") <= 45, F.col("p_type")))).select("key", "error")


@query("judgements_of_orders", """
  select o_orderkey::varchar as key, case when n is null then 'entities or edges are missing' when odd then 'unknown status' end as error
  from orders left join (select l_orderkey, count(*) as n, bool_or(l_linenumber > 6 or l_suppkey % 7 = 0) as odd from lineitem join part on p_partkey = l_partkey group by 1) l on l_orderkey = o_orderkey""")  # fmt: skip
def _(t: Tables) -> DataFrame:
    status = F.when(F.col("l_linenumber") > 6, "unsure").when(F.col("l_returnflag") == "N", "dropped").otherwise("retained")
    return contracts.judgement(_replies_of_orders(t, status=status)).select("key", "error")


@query("reviews_of_conversations", f"""
  select conv_id::varchar as key, case when bool_or(role not in ('user', 'assistant') or {_blank("split_part(text, ' ', 1)")}) then 'an item lacks its name or status' end as error from conversations group by conv_id""")  # fmt: skip
def _(t: Tables) -> DataFrame:
    status = F.when(F.col("role") == "user", "covered").when(F.col("role") == "assistant", "missing").otherwise(F.col("role"))
    item = _struct(name=F.split_part("text", F.lit(" "), F.lit(1)), status=status, evidence=F.col("text"))
    return contracts.review(t.conversations.groupBy(F.col("conv_id").cast("string").alias("key")).agg(F.to_json(F.collect_list(item)).alias("response"))).select("key", "error")


@query("translations_of_conversations", """
  select conv_id::varchar as key, case when bool_or(role = 'system') then 'an id is missing' when conv_id % 9 = 0 then 'an id is unknown' when bool_or(length(text) < 60) then 'a text is blank' end as error
  from conversations group by conv_id""")  # fmt: skip
def _(t: Tables) -> DataFrame:
    """Turns translated to capitals: none of the system's, short ones to nothing, and sometimes one that nobody said."""
    turn = F.struct(F.col("turn").cast("string").alias("id"), "role", "text")
    every = t.conversations.groupBy("conv_id").agg(F.collect_list(turn).alias("turns"))
    told = F.transform(F.filter("turns", lambda x: x["role"] != "system"), lambda x: F.struct(x["id"].alias("id"), F.when(F.length(x["text"]) < 60, "").otherwise(F.upper(x["text"])).alias("text")))
    extra = F.when(F.col("conv_id") % 9 == 0, F.array(F.struct(F.lit("none").alias("id"), F.lit("x").alias("text")))).otherwise(F.slice(told, 1, 0))
    key = F.col("conv_id").cast("string").alias("key")
    sources = every.select(key, F.map_from_entries(F.transform("turns", lambda x: F.struct(x["id"], x["text"]))).alias("texts"))
    return contracts.translation(every.select(key, F.to_json(F.map_from_entries(F.concat(told, extra))).alias("response")), sources).select("key", "error")


@query("offtopic_headings_of_documents", rf"""
  with d as (select doc_id as doc, list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '^[A-Za-z]')) as lines, {_WORDS} as words from documents),
  h as (select doc, words, unnest(lines) as heading, generate_subscripts(lines, 1) - 1 as pos from d),
  i as (select doc, pos, trim(heading) as heading, ord, words[k] as entity, relation from h cross join (values (0, 2, 'contradicts'), (1, 1, 'prerequisite_of'), (2, 5, 'distinguished_from')) v(ord, k, relation)),
  hit as (select *, row_number() over (partition by doc, pos order by ord) as nth from i where relation <> 'prerequisite_of' and regexp_matches(heading, '(?i)(^|[^a-z0-9])' || entity || '(''s|s)?($|[^a-z0-9])'))
  select doc, pos, heading, entity, relation from hit where nth = 1""")  # fmt: skip
def _(t: Tables) -> DataFrame:
    """Every line of a document as a heading, three of its own words as checklist items."""
    lines = F.filter(F.split("text", "\n"), lambda line: F.rlike(line, F.lit("^[A-Za-z]")))
    bodies = t.documents.select(F.col("doc_id").alias("doc"), F.array_join(F.transform(lines, lambda line: F.concat(F.lit("## "), line)), "\n").alias("body"))
    words = _words(F.col("text"))
    item = lambda order, place, relation: F.struct(F.lit(order).alias("item_ord"), F.get(words, F.lit(place)).alias("name"), F.lit(relation).alias("relation"))
    items = t.documents.select(F.col("doc_id").alias("doc"), F.inline(F.array(item(0, 1, "contradicts"), item(1, 0, "prerequisite_of"), item(2, 4, "distinguished_from"))))
    return retrieval.off_topic_headings(bodies, items.filter("name is not null"))


@query("listing_of_pages", """
  select page_id, 0 as pos, 'p-' || page_id as slug, coalesce(nullif(regexp_extract(html, '<html lang="([a-z]+)"', 1), ''), 'none') as category, regexp_extract(html, '<title>([^<]*)</title>', 1) as title,
    case when length(trim(url)) <= 160 then trim(url) else left(trim(url), 160) || '…' end as summary, strftime(date '2024-01-01' + (page_id % 700)::int, '%B %Y') as month from pages""")  # fmt: skip
def _(t: Tables) -> DataFrame:
    """A card of each page, put into a listing behind the page's own html and read back."""
    language = F.regexp_extract("html", '<html lang="([a-z]+)"', 1)
    slug, published = F.concat(F.lit("p-"), F.col("page_id").cast("string")), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") % 700).cast("int")).cast("string")
    card = markup.article_card(slug, F.regexp_extract("html", "<title>([^<]*)</title>", 1), F.col("url"), F.when(language != "", language).otherwise("none"), published, F.lit(3))
    listing = markup.insert_card(F.concat("html", F.lit('<div class="article-grid"></div>')), card)
    return ingest.listing_cards(t.pages.select("page_id", listing.alias("html"))).drop("reading_time")
