"""Maintenance of the graph: extraction results, induced subgraphs, diffs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .dedup import numbered


def dedupe_extraction(entities: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(entities, edges) of extraction responses, clean.

    entities (doc, pos, name, type, relevance): first of each name without regard to case
    stays; relevance that is missing, no number or outside 0 to 1 becomes 0.5. edges (doc, pos,
    source, relation, target): endpoints take the kept spelling (they are not trimmed), edges with
    an unknown endpoint and repeated triples go.
    """
    score = F.expr("try_cast(relevance as double)")
    valid = F.when(score.between(0, 1) & ~F.isnan(score), score).otherwise(0.5)
    named = entities.select("doc", "pos", F.trim("name").alias("name"), "type", valid.alias("relevance_score")).filter("name <> ''").withColumn("low", F.lower("name"))
    first = named.groupBy("doc", "low").agg(F.min_by(F.struct("pos", "name", "type", "relevance_score"), "pos").alias("e")).select("doc", "low", "e.*")
    names = first.select("doc", "low", "name")
    ends = (
        edges.withColumn("s_low", F.lower("source")).withColumn("t_low", F.lower("target"))
        .join(names.select("doc", F.col("low").alias("s_low"), F.col("name").alias("s_name")), ["doc", "s_low"])
        .join(names.select("doc", F.col("low").alias("t_low"), F.col("name").alias("t_name")), ["doc", "t_low"])
    )
    kept = ends.select("doc", F.col("s_name").alias("source"), "relation", F.col("t_name").alias("target")).distinct()
    return first.select("doc", "pos", "name", "type", "relevance_score"), kept


def induced_edges(edges: DataFrame, entities: DataFrame, article_entities: DataFrame) -> DataFrame:
    """article_id, source, relation, target of the edges whose both ends belong to the article."""
    mine = article_entities.select("article_id", "entity_id").distinct()
    names = entities.select("id", "name")
    ends = edges.join(mine.withColumnRenamed("entity_id", "source_entity_id"), "source_entity_id").join(mine.select("article_id", F.col("entity_id").alias("target_entity_id")), ["article_id", "target_entity_id"])
    return (
        ends.join(names.select(F.col("id").alias("source_entity_id"), F.col("name").alias("source")), "source_entity_id")
        .join(names.select(F.col("id").alias("target_entity_id"), F.col("name").alias("target")), "target_entity_id")
        .select("article_id", "source", "relation", "target")
    )


def graph_diff(old: DataFrame, new: DataFrame, renames: DataFrame | None = None) -> DataFrame:
    """source, relation, target, status of every old edge: retained, altered (other relation) or dropped.

    New-only edges are ignored. ``renames`` (old_name, new_name) maps old names first.
    """
    left = old.select("source", "relation", "target", F.col("source").alias("s"), F.col("target").alias("t"))
    if renames is not None:
        for side in ("s", "t"):
            left = left.join(renames.select(F.col("old_name").alias(side), F.col("new_name").alias("renamed")), side, "left").withColumn(side, F.coalesce("renamed", side)).drop("renamed")
    pairs = new.groupBy(F.col("source").alias("s"), F.col("target").alias("t")).agg(F.collect_set("relation").alias("relations"))
    status = F.when(F.array_contains("relations", F.col("relation")), "retained").when(F.col("relations").isNotNull(), "altered").otherwise("dropped")
    return left.join(pairs, ["s", "t"], "left").select("source", "relation", "target", status.alias("status"))


def entity_diff(old: DataFrame, new: DataFrame, renames: DataFrame | None = None) -> DataFrame:
    """name, status (retained or dropped) of every old entity, without regard to case."""
    left = old.select("name", F.col("name").alias("now"))
    if renames is not None:
        left = left.join(renames.select(F.col("old_name").alias("now"), "new_name"), "now", "left").select("name", F.coalesce("new_name", "now").alias("now"))
    there = new.select(F.lower("name").alias("low"), F.lit(True).alias("there")).distinct()
    return left.join(there, F.lower("now") == F.col("low"), "left").select("name", F.when(F.col("there"), "retained").otherwise("dropped").alias("status"))


def diff_counts(diff: DataFrame) -> DataFrame:
    return diff.agg(*(F.count_if(F.col("status") == s).alias(s) for s in ("retained", "altered", "dropped")))


def article_regressions(old_named: DataFrame, new_named: DataFrame, old_edges: DataFrame, new_edges: DataFrame) -> DataFrame:
    """article_id, dropped, altered: entities and edges of each article (article_id, name; article_id, source, relation, target) that it lost or changed."""
    there = new_named.select("article_id", F.lower("name").alias("low"), F.lit(True).alias("there")).distinct()
    names = old_named.select("article_id", F.lower("name").alias("low")).distinct().join(there, ["article_id", "low"], "left")
    lost = names.select("article_id", F.when(F.col("there"), "retained").otherwise("dropped").alias("status"))
    pairs = new_edges.groupBy("article_id", "source", "target").agg(F.collect_set("relation").alias("relations"))
    status = F.when(F.array_contains("relations", F.col("relation")), "retained").when(F.col("relations").isNotNull(), "altered").otherwise("dropped")
    changed = old_edges.join(pairs, ["article_id", "source", "target"], "left").select("article_id", status.alias("status"))
    return lost.unionByName(changed).groupBy("article_id").agg(F.count_if(F.col("status") == "dropped").alias("dropped"), F.count_if(F.col("status") == "altered").alias("altered"))


def write_extraction(entities: DataFrame, article_entities: DataFrame, edges: DataFrame, found: DataFrame, found_edges: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(entities, article_entities, edges) after articles' subgraphs are replaced.

    found: article_id, pos, name, type, relevance_score; found_edges: article_id, source, relation,
    target. For each article, edges with both ends in its old entities go, as do its old links to
    entities; names known (in any case) keep their id and take the new type, new ones get the next
    ids by (article_id, pos). In bulk, of several articles that name one entity the last gives its type.
    """
    touched = found.select("article_id").distinct()
    mine = article_entities.join(touched, "article_id", "left_semi")
    inside = edges.join(mine.select("article_id", F.col("entity_id").alias("source_entity_id")), "source_entity_id").join(mine.select("article_id", F.col("entity_id").alias("target_entity_id")), ["article_id", "target_entity_id"])
    left_edges = edges.join(inside.select("edge_ord").distinct(), "edge_ord", "left_anti")

    found = found.withColumn("low", F.lower("name"))
    known = entities.select(F.col("id"), F.lower("name").alias("low"), "name")
    per_name = found.groupBy("low").agg(F.min_by("name", F.struct("article_id", "pos")).alias("new_name"), F.max_by("type", F.struct("article_id", "pos")).alias("new_type"), F.min(F.struct("article_id", "pos")).alias("first")).select("low", "new_name", "new_type", F.col("first.article_id").alias("first_article"), F.col("first.pos").alias("first_pos"))
    matched = per_name.join(known.groupBy("low").agg(F.min_by("id", "id").alias("id"), F.min_by("name", "id").alias("name")), "low", "left")
    base = F.lit(entities.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0])
    fresh = numbered(matched.filter("id is null").drop("id", "name"), "nth", "first_article", "first_pos").select("low", F.col("new_name").alias("name"), F.col("new_type").alias("type"), (base + F.col("nth")).cast("long").alias("id"))
    old = matched.filter("id is not null").select("low", "name", F.col("new_type").alias("type"), "id")
    named = old.unionByName(fresh.select("low", "name", "type", "id"))
    all_entities = entities.join(named.select("id"), "id", "left_anti").select("id", "name", "type").unionByName(named.select("id", "name", "type"))

    ids = named.select("low", F.col("id").alias("entity_id"))
    links = found.join(ids, "low").groupBy("article_id", "entity_id").agg(F.max_by("relevance_score", "pos").alias("relevance_score"))
    all_links = article_entities.join(touched, "article_id", "left_anti").select("article_id", "entity_id", "relevance_score").unionByName(links)

    top = edges.agg(F.coalesce(F.max("edge_ord"), F.lit(0)).alias("top"))
    resolved = (
        found_edges.select("article_id", "source", "relation", "target").distinct()
        .join(ids.select(F.col("low").alias("sl"), F.col("entity_id").alias("source_entity_id")), F.lower("source") == F.col("sl"))
        .join(ids.select(F.col("low").alias("tl"), F.col("entity_id").alias("target_entity_id")), F.lower("target") == F.col("tl"))
    )
    counted = numbered(resolved.select("article_id", "source", "relation", "target", "source_entity_id", "target_entity_id"), "nth", "article_id", "source", "relation", "target")
    added = counted.crossJoin(F.broadcast(top)).select((F.col("top") + F.col("nth")).cast("long").alias("edge_ord"), "source_entity_id", "relation", "target_entity_id")
    return all_entities, all_links, left_edges.select("edge_ord", "source_entity_id", "relation", "target_entity_id").unionByName(added)
