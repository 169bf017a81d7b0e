"""Prompts for the injected model operators, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import ENTITY_TYPES, RELATIONS
from .quality import format_items


def _prompt(role: str, answer: str, **parts: Column) -> Column:
    """Role, then titled sections, then the form of the answer."""
    sections = [F.concat(F.lit(f"\n\n# {title.replace('_', ' ')}\n"), F.coalesce(body, F.lit("(none)"))) for title, body in parts.items()]
    return F.concat(F.lit(role), *sections, F.lit(f"\n\nAnswer with JSON only: {answer}"))


def extract_prompt(title: Column, body: Column, known_names: Column) -> Column:
    answer = '{"entities":[{"name","type","relevance_score"}],"edges":[{"source","relation","target"}]}'
    role = f"List the entities of this article and how they relate. Types: {', '.join(ENTITY_TYPES)}. Relations: {', '.join(RELATIONS)}. Use a known name where one fits."
    return _prompt(role, answer, title=title, known_names=F.array_join(known_names, ", "), article=body)


def judge_prompt(old_state: Column, new_state: Column) -> Column:
    answer = '{"entities":[{"name","status","note"}],"edges":[{"source","relation","target","status","note"}]}'
    return _prompt("Say of every old fact whether the new state retained, altered or dropped it. A mere rewording is retained.", answer, old_state=old_state, new_state=new_state)


def writer_prompt(topic: Column, checklist: Column, facts: Column, summaries: Column, sources: Column) -> Column:
    answer = '{"title","summary","body_text","graph_steps"}; body_text has "## " headings, graph_steps two to five labels'
    return _prompt("Write an article on the topic that covers every item of the checklist.", answer, topic=topic, checklist=format_items(checklist), facts=F.array_join(facts, "\n"), existing_articles=F.array_join(summaries, "\n"), sources=F.array_join(sources, "\n"))


def repair_prompt(topic: Column, draft: Column, open_items: Column, off_topic: Column, words: Column, target: int) -> Column:
    answer = '{"title","summary","body_text","graph_steps"}'
    return _prompt(f"Repair this draft once: cover the open items, fold off-topic sections into others, reach {target} words.", answer, topic=topic, draft=draft, open_items=format_items(open_items), off_topic_sections=F.array_join(off_topic, "\n"), words=words.cast("string"))


def review_prompt(checklist: Column, draft: Column) -> Column:
    return _prompt("Say of every checklist item whether the draft has it covered, partial or missing.", '[{"name","status","evidence"}]', checklist=format_items(checklist), draft=draft)


def seo_prompt(title: Column, body: Column) -> Column:
    answer = '{"title","meta_description","canonical_slug","og_title","og_description","primary_keywords","secondary_keywords","internal_anchor_texts","headings","faq"}'
    return _prompt("Give search metadata for this article.", answer, title=title, article=body)


def translate_prompt(texts: Column, language: str) -> Column:
    return _prompt(f"Translate every value to {language} and keep the keys.", '{"id":"text"}', texts=F.to_json(texts))
