"""Schemas of the content store."""

from __future__ import annotations

ARTICLES = "id long, slug string, filepath string, title string, summary string, body_text string, published_at string, last_updated string, status string"
ENTITIES = "id long, name string, type string"
ARTICLE_ENTITIES = "article_id long, entity_id long, relevance_score double"
EDGES = "edge_ord long, source_entity_id long, relation string, target_entity_id long"
LINKS = "source_article_id long, target_article_id long, link_text string"
SOURCE_ARTICLES = (
    "id long, title string, slug string, original_url string, published_at string, author string, category string, "
    "keywords string, original_content string, featured_image string, import_date string, status string, notes string"
)
META = "key string, value string"

TABLES = {
    "articles": ARTICLES,
    "entities": ENTITIES,
    "article_entities": ARTICLE_ENTITIES,
    "edges": EDGES,
    "links": LINKS,
    "source_articles": SOURCE_ARTICLES,
    "meta": META,
}

# The vocabularies of the store. Other values are kept and reported.
ENTITY_TYPES = ["topic", "product", "organization", "concept", "strategy", "person"]
RELATIONS = ["related_to", "prerequisite_of", "part_of", "contradicts", "updates", "distinguished_from"]
SOURCE_STATUSES = ["pending", "imported", "reviewed", "ready", "generated", "published", "ignored"]
WEAK_RELATIONS = ["related_to"]
CONTRAST_RELATIONS = ["distinguished_from", "contradicts"]
