"""Topic retrieval over the knowledge graph.

The topic is a column: every operator works for all rows of ``topics`` (topic_id, topic)
at once, and per-topic orders and limits are windows over topic_id.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import jaccard, parse_keywords, round_half_up, tokens
from ..schema import WEAK_RELATIONS
from ..storage import new_path, stored
from .containment import contained, first_hits, first_per
from .dedup import ranked

#: Rows of a user-given side (topics, candidates) that are broadcast at most.
BROADCAST_ROWS = 10_000
#: Tasks that share the edges of one entity.
SALTS = 8
#: Slots in which tokens are counted for the order of the prefix filter.
TOKEN_SLOTS = 1 << 16
#: Topics that one task matches at most; more are dealt over further tasks.
TOPIC_ROWS = 50_000
#: Fixed value: what is said of a topic without a seed.
NO_SEED = "No entity in the graph matched this topic — treat it as a genuinely new subject; nothing to flag or link yet."


def against_all(rows: DataFrame, asked: DataFrame, key: str) -> DataFrame:
    """Every row beside every row of ``asked``, a stated set with a unique ``key``, in broadcast blocks.

    The set is counted; beyond BROADCAST_ROWS it is cut by a hash of its key into blocks of about half of that.
    """
    n = asked.count()
    if n <= BROADCAST_ROWS:
        return rows.crossJoin(F.broadcast(asked))
    blocks = -(-2 * n // BROADCAST_ROWS)
    block = F.pmod(F.xxhash64(key), F.lit(blocks))
    return reduce(DataFrame.unionByName, (rows.crossJoin(F.broadcast(asked.filter(block == k))) for k in range(blocks)))


def similar_candidates(left: DataFrame, right: DataFrame, least: float) -> DataFrame:
    """Pairs (a_id, b_id) of left (a_id, a_tokens) and right (b_id, b_tokens) that may reach a Jaccard similarity of ``least``.

    Prefix filter: such sets share one of the first n - ceil(least * n) + 1 tokens in any common order. Tokens are
    ordered by how often their slot (a hash) occurs, so frequent ones rarely bring sets together.
    """
    slot = lambda c: F.pmod(F.xxhash64(c), F.lit(TOKEN_SLOTS))
    every = left.select(F.explode("a_tokens").alias("token")).unionByName(right.select(F.explode("b_tokens").alias("token")))
    counts = every.groupBy(slot("token").alias("slot")).agg(F.count("*").alias("seen"))  # TOKEN_SLOTS rows at most

    def prefix(side: DataFrame, key: str, tokens: str) -> DataFrame:
        one = side.select(key, F.explode(tokens).alias("token")).withColumn("slot", slot("token")).join(F.broadcast(counts), "slot")
        ranked = one.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("seen", "token"))).alias("t"))
        size = F.size("t")
        return ranked.select(key, F.explode(F.slice("t", F.lit(1), (size - F.ceil(size * F.lit(least) - F.lit(1e-9)) + 1).cast("int"))).alias("t")).select(key, F.col("t.token").alias("token"))

    return prefix(left, "a_id", "a_tokens").join(prefix(right, "b_id", "b_tokens"), "token").select("a_id", "b_id").distinct()


def _topics(topics: DataFrame) -> DataFrame:
    low = F.lower(F.trim("topic"))
    return topics.select("topic_id", low.alias("topic_low"), tokens(low).alias("topic_tokens")).filter("topic_low <> ''")


def top_per_topic(df: DataFrame, limit: int, *order: Column) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(Window.partitionBy("topic_id").orderBy(*order))).filter(F.col("rank") <= limit)


def seed_entities(entities: DataFrame, topics: DataFrame, limit: int = 8) -> DataFrame:
    """topic_id, id, name, type, score, reason, rank of the best matching entities.

    1.0 equal, 0.9 one contains the other, 0.6 a topic token lies in the name. Names and topics meet
    through an index of their rarest grams, so topics may be as many as entities. Blank names match nothing.
    Topics of the same text are matched once, under the smallest of their ids.
    """
    names = entities.select("id", F.lower("name").alias("low"))
    every = _topics(topics)
    texts = stored(every.groupBy("topic_low").agg(F.min("topic_id").alias("first_id")), "topic-texts")
    parts = -(-texts.count() // TOPIC_ROWS)
    asked = (texts if parts <= 1 else texts.repartition(parts)).select(F.col("first_id").alias("topic_id"), "topic_low", tokens("topic_low").alias("topic_tokens"))
    exact = names.join(asked, F.col("low") == F.col("topic_low")).select("topic_id", "id", F.lit(1.0).alias("score"))
    topic = asked.select(F.col("topic_id").alias("hay_id"), F.col("topic_low").alias("hay"))
    in_topic = contained(names.select(F.col("id").alias("needle_id"), F.col("low").alias("needle")), topic).select(F.col("hay_id").alias("topic_id"), F.col("needle_id").alias("id"), F.lit(0.9).alias("score"))
    # Equal scores are in the order of ids, so of what one topic or one token finds the first ``limit`` are enough.
    name = names.select(F.col("id").alias("hay_id"), F.col("low").alias("hay"))
    in_name = first_per(contained(topic.select(F.col("hay_id").alias("needle_id"), F.col("hay").alias("needle")), name), "needle_id", "hay_id", limit)
    in_name = in_name.select(F.col("needle_id").alias("topic_id"), F.col("hay_id").alias("id"), F.lit(0.9).alias("score"))
    token = asked.select("topic_id", F.explode(F.array_distinct("topic_tokens")).alias("needle_id"))
    by_token = first_per(contained(token.select("needle_id", F.col("needle_id").alias("needle")).distinct(), name), "needle_id", "hay_id", limit)
    by_token = by_token.join(token, "needle_id").select("topic_id", F.col("hay_id").alias("id"), F.lit(0.6).alias("score"))
    found = reduce(DataFrame.unionByName, [exact, in_topic, in_name, by_token]).groupBy("topic_id", "id").agg(F.max("score").alias("score"))
    named = F.concat(F.lit('entity name "'), F.col("name"), F.lit('" '))
    reason = (
        F.when(F.col("score") == 1.0, "exact match with topic")
        .when(F.col("score") == 0.9, F.concat(named, F.lit("overlaps with the topic text")))
        .otherwise(F.concat(named, F.lit("shares a keyword with the topic")))
    )
    best = top_per_topic(found, limit, F.col("score").desc(), F.col("id")).join(entities.select("id", "name", "type"), "id")
    # Of known size, so that where texts repeat the many topics are not shuffled to get their few seeds.
    best = stored(best.select(F.col("topic_id").alias("first_id"), "id", "name", "type", "score", "rank").withColumn("reason", reason), "text-seeds")
    return every.select("topic_id", "topic_low").join(texts, "topic_low").join(best, "first_id").select("topic_id", "id", "name", "type", "score", "rank", "reason")


def expand_related(entities: DataFrame, edges: DataFrame, seeds: DataFrame, max_hops: int = 1, include_weak: bool = False) -> tuple[DataFrame, DataFrame]:
    """(related, weak): everything within ``max_hops`` of the seeds, and the weak edges met.

    related: topic_id, id, name, type, hop, via, relation, visit. An entity is visited once;
    the first edge (edge_ord, source to target first) to reach it gives via and relation.
    weak: topic_id, source, relation, target, hop, edge_ord. Each hop is written, so the plan does
    not grow by hops and small frontiers are broadcast by their known size; the loop ends with an
    empty frontier. The edges of one entity are dealt over SALTS tasks.
    """
    ids = edges.select("edge_ord", "relation", F.col("source_entity_id").alias("s_id"), F.col("target_entity_id").alias("t_id"))
    forth = ids.select("*", F.lit(0).alias("way"), F.col("s_id").alias("from"), F.col("t_id").alias("id"))
    steps = forth.unionByName(ids.select("*", F.lit(1).alias("way"), F.col("t_id").alias("from"), F.col("s_id").alias("id")))
    steps = steps.withColumn("salt", F.pmod("edge_ord", F.lit(SALTS)).cast("int"))
    is_weak = F.col("relation").isin(WEAK_RELATIONS)

    # Ids alone meet the frontier; names are joined to what was reached.
    spark, reached_path = seeds.sparkSession, new_path(seeds.sparkSession, "reached")
    seeds = stored(seeds, "seeds")
    nothing = F.lit(None).cast("long")
    begun = seeds.select("topic_id", "id", F.lit(0).alias("hop"), nothing.alias("s_id"), F.lit(None).cast("string").alias("relation"), nothing.alias("t_id"), F.col("rank").cast("long").alias("visit"))
    begun.write.parquet(reached_path)
    visited = spark.read.schema(begun.schema).parquet(reached_path)
    frontier, mets = seeds.select("topic_id", F.col("id").alias("from")), []
    for hop in range(1, max_hops + 1):
        spread = frontier.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        met = stored(steps.join(spread, ["from", "salt"]).select("topic_id", "edge_ord", "way", "relation", "s_id", "t_id", "id", F.lit(hop).alias("hop")), "met")
        mets.append(met)
        strong = met if include_weak else met.filter(~is_weak)
        new = strong.join(visited.select("topic_id", "id"), ["topic_id", "id"], "left_anti")
        # A minimum per entity instead of a window: it is pre-aggregated before the shuffle.
        first = new.groupBy("topic_id", "id").agg(F.min(F.struct("edge_ord", "way", "relation", "s_id", "t_id")).alias("e"))
        reached = stored(first.select("topic_id", "id", F.lit(hop).alias("hop"), "e.s_id", "e.relation", "e.t_id", (F.col("e.edge_ord") * 2 + F.col("e.way")).alias("visit")), "frontier")
        if reached.isEmpty():
            break
        reached.write.mode("append").parquet(reached_path)
        visited = spark.read.schema(begun.schema).parquet(reached_path)
        frontier = reached.select("topic_id", F.col("id").alias("from"))
    weak = None
    if mets and not include_weak:
        weak = reduce(DataFrame.unionByName, mets).filter(is_weak).select("topic_id", "s_id", "relation", "t_id", "hop", "edge_ord").distinct()

    names = entities.select("id", "name", "type")
    named = lambda df, how: df.join(names.select(F.col("id").alias("s_id"), F.col("name").alias("s_name")), "s_id", how).join(names.select(F.col("id").alias("t_id"), F.col("name").alias("t_name")), "t_id", how)
    met = named(visited.filter("hop > 0"), "inner").join(names, "id")
    phrase = F.concat("s_name", F.lit(" --["), "relation", F.lit("]--> "), "t_name")
    begun = seeds.select("topic_id", "id", "name", "type", F.lit(0).alias("hop"), F.col("reason").alias("via"), F.lit(None).cast("string").alias("relation"), F.col("rank").cast("long").alias("visit"))
    related = begun.unionByName(met.select("topic_id", "id", "name", "type", "hop", phrase.alias("via"), "relation", "visit"))
    if weak is None:
        weak = seeds.sparkSession.createDataFrame([], "topic_id long, source string, relation string, target string, hop int, edge_ord long")
    else:
        weak = named(weak, "inner").select("topic_id", F.col("s_name").alias("source"), "relation", F.col("t_name").alias("target"), "hop", "edge_ord")
    return related, weak


def article_summaries(articles: DataFrame, article_entities: DataFrame, related: DataFrame) -> DataFrame:
    """topic_id, article_id, slug, title, matched (array of relevance_score, name, id, best first), max_relevance, coverage_ratio."""
    wanted = related.select("topic_id", F.col("id").alias("entity_id"), "name")
    sizes = wanted.groupBy("topic_id").agg(F.count("*").alias("n_related"))
    hits = article_entities.join(wanted, "entity_id").groupBy("topic_id", "article_id").agg(
        F.sort_array(F.collect_list(F.struct((-F.col("relevance_score")).alias("neg"), F.col("entity_id").alias("id"), "name", "relevance_score"))).alias("matched"),
        F.max("relevance_score").alias("max_relevance"),
        F.count("*").alias("n_matched"),
    )
    ratio = round_half_up(F.col("n_matched") / F.col("n_related"), 2)
    return (
        hits.join(sizes, "topic_id")
        .join(articles.select(F.col("id").alias("article_id"), "slug", "title"), "article_id")
        .select("topic_id", "article_id", "slug", "title", F.transform("matched", lambda m: F.struct(m["relevance_score"].alias("relevance_score"), m["name"].alias("name"), m["id"].alias("id"))).alias("matched"), "max_relevance", ratio.alias("coverage_ratio"))
    )


def ranked_summaries(summaries: DataFrame) -> DataFrame:
    """Summaries with ``rank`` in their topic: most relevant first, then best covered, then the smallest article."""
    return ranked(summaries, "rank", "topic_id", -F.col("max_relevance"), -F.col("coverage_ratio"), F.col("article_id"))


def near_duplicates(summaries: DataFrame, seeds: DataFrame, high: float = 0.6, medium: float = 0.3) -> DataFrame:
    """topic_id, article_id, slug, title, level, overlap_ratio, n_overlapping by relevance-weighted overlap with the seeds.

    Relevance is summed exactly (as a decimal); levels compare the unrounded ratio.
    """
    names = seeds.select("topic_id", "name").distinct()
    counts = names.groupBy("topic_id").agg(F.count("*").alias("n_seeds"))
    matched = summaries.select("topic_id", "article_id", "slug", "title", F.explode("matched").alias("m")).select("topic_id", "article_id", "slug", "title", F.col("m.name").alias("name"), F.col("m.relevance_score").alias("r"))
    overlap = matched.join(names, ["topic_id", "name"]).groupBy("topic_id", "article_id", "slug", "title").agg(F.sum(F.col("r").cast("decimal(12,4)")).cast("double").alias("total"), F.count("*").alias("n_overlapping"))
    ratio = F.col("total") / F.col("n_seeds")
    level = F.when(ratio >= high, "high").when(ratio >= medium, "medium")
    return overlap.join(counts, "topic_id").select("topic_id", "article_id", "slug", "title", level.alias("level"), round_half_up(ratio, 2).alias("overlap_ratio"), "n_overlapping").filter("level is not null")


def seed_overlaps(articles: DataFrame, article_entities: DataFrame, related: DataFrame, seeds: DataFrame, high: float = 0.6, medium: float = 0.3) -> DataFrame:
    """What ``near_duplicates`` finds, without summaries: entities that are named as a seed are summed, and only articles with a level are looked up."""
    names = seeds.select("topic_id", "name").distinct()
    counts = names.groupBy("topic_id").agg(F.count("*").alias("n_seeds"))
    wanted = related.join(names, ["topic_id", "name"], "left_semi").select("topic_id", F.col("id").alias("entity_id"))
    total = F.sum(F.col("relevance_score").cast("decimal(12,4)")).cast("double").alias("total")
    overlap = article_entities.join(wanted, "entity_id").groupBy("topic_id", "article_id").agg(total, F.count("*").alias("n_overlapping"))
    ratio = F.col("total") / F.col("n_seeds")
    level = F.when(ratio >= high, "high").when(ratio >= medium, "medium")
    levels = overlap.join(counts, "topic_id").select("topic_id", "article_id", level.alias("level"), round_half_up(ratio, 2).alias("overlap_ratio"), "n_overlapping").filter("level is not null")
    return levels.join(articles.select(F.col("id").alias("article_id"), "slug", "title"), "article_id").select("topic_id", "article_id", "slug", "title", "level", "overlap_ratio", "n_overlapping")


def title_slug_similarity(articles: DataFrame, candidates: DataFrame, title_least: float = 0.3, slug_above: float = 0.0) -> DataFrame:
    """Pairs (candidate_id, article_id) with title_similarity (Jaccard of tokens) and slug_similarity (1, 0.7, 0).

    Equal titles are one class; classes meet candidates through an inverted index of their rarest tokens (a
    prefix filter), slugs by containment in both directions. Slugs and tokens are computed once and written; where
    no candidate has a slug, articles are only looked up by the titles that match.
    """
    titled = articles.select(F.col("id").alias("a_id"), F.coalesce("title", F.lit("")).alias("a_title"), F.lower(F.coalesce("slug", F.lit(""))).alias("a_slug"))
    classes = titled.select("a_title").distinct().select("a_title", F.array_distinct(tokens("a_title")).alias("a_tokens"))
    c = candidates.select(F.col("candidate_id").alias("b_id"), F.lower(F.trim(F.coalesce("candidate_slug", F.lit("")))).alias("c_slug"), F.array_distinct(tokens(F.coalesce("candidate_title", F.lit("")))).alias("b_tokens"))
    classes, c = stored(classes, "title-classes"), stored(c, "titles")
    both = F.size(F.array_intersect("a_tokens", "b_tokens"))
    union = F.size("a_tokens") + F.size("b_tokens") - both
    similarity = F.when(both == 0, 0.0).otherwise(F.floor((200 * both + union) / (2 * union)).cast("double") / 100)
    # Two digits are compared, so what rounds up to the threshold counts.
    near = similar_candidates(classes.select(F.col("a_title").alias("a_id"), "a_tokens"), c, max(title_least - 0.005, 1e-6)).withColumnRenamed("a_id", "a_title")
    near = near.join(classes, "a_title").join(c.select("b_id", "b_tokens"), "b_id").select("a_title", "b_id", similarity.alias("title_similarity"))
    near = stored(near.filter(F.col("title_similarity") >= title_least), "title-matches")
    by_title = titled.select("a_id", "a_title").join(near, "a_title")
    ours = c.filter("c_slug <> ''").select(F.col("b_id").alias("hay_id"), F.col("c_slug").alias("hay"))
    if slug_above >= 0 and ours.isEmpty():
        return by_title.select(F.col("b_id").alias("candidate_id"), F.col("a_id").alias("article_id"), "title_similarity", F.lit(0.0).alias("slug_similarity"))
    a = stored(titled.join(classes, "a_title").select("a_id", "a_slug", "a_tokens"), "titles")
    theirs = a.filter("a_slug <> ''").select(F.col("a_id").alias("hay_id"), F.col("a_slug").alias("hay"))
    needle = lambda side: side.select(F.col("hay_id").alias("needle_id"), F.col("hay").alias("needle"))
    equal = ours.withColumnRenamed("hay_id", "b_id").join(theirs.withColumnRenamed("hay_id", "a_id"), "hay").select("a_id", "b_id", F.lit(1.0).alias("slug_similarity"))
    inside = contained(needle(ours), theirs).select(F.col("hay_id").alias("a_id"), F.col("needle_id").alias("b_id"))
    around = contained(needle(theirs), ours).select(F.col("needle_id").alias("a_id"), F.col("hay_id").alias("b_id"))
    by_slug = equal.unionByName(inside.unionByName(around).withColumn("slug_similarity", F.lit(0.7)))
    pairs = by_slug.unionByName(by_title.select("a_id", "b_id", F.lit(0.0).alias("slug_similarity"))).groupBy("a_id", "b_id").agg(F.max("slug_similarity").alias("slug_similarity"))
    full = pairs.join(a.select("a_id", "a_tokens"), "a_id").join(c.select("b_id", "b_tokens"), "b_id")
    found = full.select(F.col("b_id").alias("candidate_id"), F.col("a_id").alias("article_id"), similarity.alias("title_similarity"), "slug_similarity")
    return found.filter((F.col("title_similarity") >= title_least) | (F.col("slug_similarity") > slug_above))


def ranked_matches(matches: DataFrame) -> DataFrame:
    """Title and slug matches with ``rank`` for their candidate, by the greater of both similarities, then the smallest article."""
    return ranked(matches, "rank", "candidate_id", -F.greatest("title_similarity", "slug_similarity"), F.col("article_id"))


def candidate_sources(sources: DataFrame, topics: DataFrame, keyword: str | None = None, category: str | None = None, limit: int = 5) -> DataFrame:
    """topic_id, id, title, slug, category, score, reason, rank of source articles; ``ignored`` ones are left out.

    Facets filter first. 1.0 topic in the title, 0.8 a token in a keyword, 0.6 in the category,
    0.4 in the text, 0.5 for what passed a facet without any of these.
    """
    keyword, category = ((f or "").strip().lower() for f in (keyword, category))
    rows = sources.filter(~F.col("status").eqNullSafe("ignored")).withColumn("keys", F.transform(parse_keywords("keywords"), F.lower)).withColumn("cat", F.lower(F.coalesce("category", F.lit(""))))
    rows = filter_facets(rows, keyword, category)
    blank = topics.select("topic_id", F.lower(F.trim(F.coalesce("topic", F.lit("")))).alias("topic_low"))
    asked = blank.withColumn("topic_tokens", tokens("topic_low"))
    if keyword or category:
        scored = _facet_scores(rows, asked)
    else:
        scored = _source_scores(rows, asked, limit)
    reason = (
        F.when(F.col("score") == 1.0, "topic appears in the title")
        .when(F.col("score") == 0.8, "shares a keyword tag with the topic")
        .when(F.col("score") == 0.6, "shares a keyword with the category")
        .when(F.col("score") == 0.4, "topic keyword appears in the body text")
        .otherwise("matches the facet")
    )
    return top_per_topic(scored, limit, F.col("score").desc(), F.col("id")).withColumn("reason", reason)


def _source_scores(rows: DataFrame, asked: DataFrame, limit: int) -> DataFrame:
    """The sources that may be among the first ``limit`` of a topic: every text is read once for all topics' words."""
    texts = rows.select("id", F.lower("title").alias("title"), F.array_join("keys", "\0").alias("keys"), "cat", F.lower("original_content").alias("body"))
    whole = asked.select("topic_id", F.col("topic_low").alias("pattern"), F.lit(1.0).alias("score"), F.lit(0).alias("search"))
    token = asked.select("topic_id", F.explode(F.array_distinct("topic_tokens")).alias("pattern"))
    levels = F.explode(F.array(*(F.struct(F.lit(k).alias("search"), F.lit(x).alias("score")) for k, x in ((1, 0.8), (2, 0.6), (3, 0.4)))))
    wanted = whole.unionByName(token.withColumn("l", levels).select("topic_id", "pattern", "l.score", "l.search"))
    words = token.select("pattern").distinct()
    hits = first_hits(texts, [("title", whole.select("pattern")), ("keys", words), ("cat", words), ("body", words)], limit)
    found = hits.join(wanted, ["search", "pattern"]).groupBy("topic_id", "id").agg(F.max("score").alias("score"))
    # Only what can be shown meets the table again.
    few = top_per_topic(found, limit, F.col("score").desc(), F.col("id")).drop("rank")
    return rows.select("id", "title", "slug", "category").join(few, "id").select("topic_id", "id", "title", "slug", "category", "score")


def _facet_scores(rows: DataFrame, asked: DataFrame) -> DataFrame:
    """Every row that passed a facet beside every topic, at least with the facet's score."""
    title, body = F.lower(F.coalesce("title", F.lit(""))), F.lower(F.coalesce("original_content", F.lit("")))
    some = lambda text: F.exists("topic_tokens", lambda t: F.contains(text, t))
    score = (
        F.when((F.col("topic_low") != "") & F.contains(title, F.col("topic_low")), 1.0)
        .when(F.exists("keys", lambda k: F.exists("topic_tokens", lambda t: F.contains(k, t))), 0.8)
        .when(some(F.col("cat")), 0.6)
        .when(some(body), 0.4)
        .otherwise(0.5)
    )
    return against_all(rows, asked, "topic_id").select("topic_id", "id", "title", "slug", "category", score.alias("score"))


def filter_facets(rows: DataFrame, keyword: str = "", category: str = "") -> DataFrame:
    """Rows whose lower-case ``keys`` (any) and ``cat`` contain the facets; a blank facet filters nothing."""
    if keyword.strip():
        rows = rows.filter(F.exists("keys", lambda k: F.contains(k, F.lit(keyword.strip().lower()))))
    if category.strip():
        rows = rows.filter(F.contains("cat", F.lit(category.strip().lower())))
    return rows


def content_hierarchy(topics: DataFrame, duplicates: DataFrame) -> DataFrame:
    """topic_id, overlaps_specialised, slug (of the strongest ``high`` duplicate; ties to the smallest article)."""
    top = duplicates.filter("level = 'high'").groupBy("topic_id").agg(F.max_by("slug", F.struct("overlap_ratio", -F.col("article_id"))).alias("slug"))
    return topics.select("topic_id").join(top, "topic_id", "left").select("topic_id", F.col("slug").isNotNull().alias("overlaps_specialised"), "slug")


def duplicate_risk(candidates: DataFrame, matches: DataFrame, duplicates: DataFrame) -> DataFrame:
    """candidate_id, verdict: high, medium or none from title, slug and entity overlap (topic_id = candidate_id)."""
    a = matches.groupBy("candidate_id").agg(F.bool_or((F.col("slug_similarity") >= 1) | (F.col("title_similarity") >= 0.6)).alias("strong"))
    b = duplicates.groupBy(F.col("topic_id").alias("candidate_id")).agg(F.bool_or(F.col("level") == "high").alias("high"))
    verdict = F.when(F.coalesce("strong", F.lit(False)) | F.coalesce("high", F.lit(False)), "high").when(F.col("strong").isNotNull() | F.col("high").isNotNull(), "medium").otherwise("none")
    return candidates.select("candidate_id").join(a, "candidate_id", "left").join(b, "candidate_id", "left").select("candidate_id", verdict.alias("verdict"))


def suggested_links(summaries: DataFrame, seeds: DataFrame, limit: int = 3, least: float = 0.6) -> DataFrame:
    """topic_id, pick, entity, slug, relevance_score: seeds in order each take their best unused article.

    Earlier choices bar later ones, so this is a fold over each topic's few seeds. With at
    most ``limit`` picks a seed needs its best ``limit`` articles only: fewer are barred before it.
    """
    matched = summaries.select("topic_id", "article_id", "slug", "max_relevance", "coverage_ratio", F.explode("matched").alias("m")).filter(F.col("m.relevance_score") >= least)
    ranked = matched.join(seeds.select("topic_id", F.col("name").alias("seed"), F.col("rank").alias("seed_rank")), (matched.topic_id == seeds.topic_id) & (F.col("m.name") == F.col("seed"))).drop(seeds.topic_id)
    w = Window.partitionBy("topic_id", "seed_rank").orderBy(F.col("m.relevance_score").desc(), F.col("max_relevance").desc(), F.col("coverage_ratio").desc(), F.col("article_id"))
    few = ranked.withColumn("k", F.row_number().over(w)).filter(F.col("k") <= limit)
    offers = few.groupBy("topic_id", "seed_rank", "seed").agg(F.sort_array(F.collect_list(F.struct("k", "article_id", "slug", F.col("m.relevance_score").alias("r")))).alias("offers"))
    per_topic = offers.groupBy("topic_id").agg(F.sort_array(F.collect_list(F.struct("seed_rank", "seed", "offers"))).alias("seeds"))
    none = F.expr("cast(array() as array<struct<entity:string,article_id:bigint,slug:string,relevance_score:double>>)")

    def take(acc: Column, s: Column) -> Column:
        free = F.filter(s["offers"], lambda o: ~F.exists(acc, lambda used: used["article_id"] == o["article_id"]))
        best = F.get(free, F.lit(0))
        pick = F.struct(s["seed"].alias("entity"), best["article_id"].alias("article_id"), best["slug"].alias("slug"), best["r"].alias("relevance_score"))
        return F.when((F.size(acc) >= limit) | (F.size(free) == 0), acc).otherwise(F.concat(acc, F.array(pick)))

    picks = per_topic.select("topic_id", F.posexplode(F.aggregate("seeds", none, take)).alias("pos", "p"))
    return picks.select("topic_id", (F.col("pos") + 1).alias("pick"), "p.entity", "p.slug", "p.relevance_score")


def checklist(related: DataFrame) -> DataFrame:
    """topic_id, id, name, type, why, relation of every related entity."""
    why = F.when(F.col("hop") == 0, F.coalesce("via", F.lit("directly matches the topic"))).otherwise(F.concat(F.lit("related to the topic via: "), "via"))
    return related.select("topic_id", "id", "name", "type", why.alias("why"), "relation")


def off_topic_headings(bodies: DataFrame, items: DataFrame) -> DataFrame:
    """doc, pos, heading, entity, relation: headings built around a contrast item; the first item per heading."""
    from ..functions.text import heading_mentions, headings
    from ..schema import CONTRAST_RELATIONS

    lines = bodies.select("doc", F.posexplode(headings("body")).alias("pos", "heading"))
    contrast = items.filter(F.col("relation").isin(CONTRAST_RELATIONS)).select("doc", "item_ord", F.col("name").alias("entity"), "relation")
    hits = lines.join(contrast, "doc").filter(heading_mentions(F.col("heading"), F.col("entity")))
    return hits.groupBy("doc", "pos", "heading").agg(F.min_by(F.struct("entity", "relation"), "item_ord").alias("i")).select("doc", "pos", "heading", "i.entity", "i.relation")


def fact_similarity(facts: DataFrame, others: DataFrame, least: float = 0.8) -> DataFrame:
    """(a_id, b_id, similarity) of facts whose token sets reach ``least``, through an inverted index of their rarest tokens."""
    from ..functions.text import fact_tokens

    a = facts.select(F.col("id").alias("a_id"), fact_tokens("text").alias("a_tokens"))
    b = others.select(F.col("id").alias("b_id"), fact_tokens("text").alias("b_tokens"))
    pairs = similar_candidates(a, b, least).join(a, "a_id").join(b, "b_id")
    both = F.size(F.array_intersect("a_tokens", "b_tokens"))
    score = both / (F.size("a_tokens") + F.size("b_tokens") - both)
    return pairs.select("a_id", "b_id", score.alias("similarity")).filter(F.col("similarity") >= least)


def full_checklist(items: DataFrame, facts: DataFrame) -> DataFrame:
    """key, name, type, why, relation: checklist items and then the must-include facts (key, facts: array), near repeats of a fact once."""
    kept = dedupe_facts(facts.select(F.col("key").alias("doc"), "facts"))
    extra = kept.select(F.col("doc").alias("key"), F.col("fact").alias("name"), F.lit("fact").alias("type"), F.lit("a must-include fact of this article").alias("why"), F.lit(None).cast("string").alias("relation"))
    return items.select("key", "name", "type", "why", "relation").unionByName(extra)


def retrieval_context(
    topics: DataFrame, entities: DataFrame, edges: DataFrame, articles: DataFrame, article_entities: DataFrame, sources: DataFrame, candidates: DataFrame | None = None,
    seed_limit: int = 8, max_hops: int = 1, include_weak: bool = False, max_links: int = 3, high: float = 0.6, medium: float = 0.3, max_sources: int = 5, keyword: str | None = None, category: str | None = None,
) -> dict[str, DataFrame]:
    """The composed retrieval for all topics: seeds, related, weak, summaries, duplicates, links, checklist, hierarchy, sources, note, and verdict where candidates are given.

    Topics without a seed have no rows in the parts that follow from one, and a note. What several parts
    use is written once to the shared folder (``storage.clear`` deletes it).
    """
    seeds = stored(seed_entities(entities, topics, seed_limit), "seeds")
    related, weak = expand_related(entities, edges, seeds, max_hops, include_weak)
    related = stored(related, "related")
    summaries = stored(article_summaries(articles, article_entities, related), "summaries")
    duplicates = near_duplicates(summaries, seeds, high, medium)
    out = {
        "seeds": seeds,
        "related": related,
        "weak": weak,
        "summaries": summaries,
        "duplicates": duplicates,
        "links": suggested_links(summaries, seeds, max_links),
        "checklist": checklist(related),
        "hierarchy": content_hierarchy(topics, duplicates),
        "sources": candidate_sources(sources, topics, keyword, category, max_sources),
        "note": topics.select("topic_id").join(seeds.select("topic_id").distinct(), "topic_id", "left_anti").withColumn("note", F.lit(NO_SEED)),
    }
    if candidates is not None:
        out["verdict"] = duplicate_risk(candidates, title_slug_similarity(articles, candidates), duplicates)
    return out


def dedupe_facts(docs: DataFrame, least: float = 0.8) -> DataFrame:
    """doc, pos, fact: of ``facts`` (array) those that near-repeat no fact kept before them.

    Whether a fact stays depends on those kept before it, so it is a fold over one document's few facts.
    """
    from ..functions.text import fact_tokens

    none = F.expr("cast(array() as array<struct<pos:int,fact:string,low:string,tokens:array<string>>>)")
    indexed = F.transform("facts", lambda f, i: F.struct(i.alias("pos"), f.alias("fact"), F.lower(F.trim(f)).alias("low"), fact_tokens(f).alias("tokens")))

    def keep(acc: Column, f: Column) -> Column:
        repeats = F.exists(acc, lambda k: (k["low"] == f["low"]) | (jaccard(k["tokens"], f["tokens"]) >= least))
        return F.when(repeats, acc).otherwise(F.concat(acc, F.array(f)))

    return docs.select("doc", F.explode(F.aggregate(indexed, none, keep)).alias("k")).select("doc", F.col("k.pos").alias("pos"), F.col("k.fact").alias("fact"))
