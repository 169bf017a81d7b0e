from pyspark.sql import functions as F

from quillgraph.operators import dedup, retrieval, selection
from quillgraph.schema import ARTICLE_ENTITIES, EDGES, ENTITIES


def graph(spark):
    entities = spark.createDataFrame(
        [(1, "Stock Trading Course", "topic"), (2, "Gap Trading", "strategy"), (3, "Course Selection Criteria", "concept"), (4, "Index Warrants", "product"), (5, "Call Warrant", "product")], ENTITIES
    )
    edges = spark.createDataFrame([(1, 1, "related_to", 2), (2, 1, "part_of", 3), (3, 2, "related_to", 4), (4, 1, "distinguished_from", 5)], EDGES)
    articles = spark.createDataFrame([(1, "index-warrants", "Index Warrants"), (2, "picking-a-course", "Picking a Course")], "id long, slug string, title string")
    links = spark.createDataFrame([(1, 4, 0.95), (1, 2, 0.3), (2, 1, 0.9), (2, 3, 0.8)], ARTICLE_ENTITIES)
    return entities, edges, articles, links, spark.createDataFrame([(1, "Stock Trading Course")], "topic_id long, topic string")


def test_composed_retrieval(spark):
    entities, edges, articles, links, topics = graph(spark)
    seeds = retrieval.seed_entities(entities, topics)
    assert [(r.id, r.score, r.reason) for r in seeds.collect()] == [(1, 1.0, "exact match with topic")]
    related, weak = retrieval.expand_related(entities, edges, seeds)
    assert sorted((r.id, r.hop, r.relation) for r in related.collect()) == [(1, 0, None), (3, 1, "part_of"), (5, 1, "distinguished_from")]
    assert [(r.source, r.target, r.hop) for r in weak.collect()] == [("Stock Trading Course", "Gap Trading", 1)]
    summaries = retrieval.article_summaries(articles, links, related)
    assert [(r.article_id, r.max_relevance, r.coverage_ratio) for r in summaries.collect()] == [(2, 0.9, 0.67)]
    duplicates = retrieval.near_duplicates(summaries, seeds)
    assert [(r.article_id, r.level, r.overlap_ratio) for r in duplicates.collect()] == [(2, "high", 0.9)]
    assert [(r.pick, r.entity, r.slug) for r in retrieval.suggested_links(summaries, seeds).collect()] == [(1, "Stock Trading Course", "picking-a-course")]
    assert retrieval.content_hierarchy(topics, duplicates).first().overlaps_specialised
    wide, _ = retrieval.expand_related(entities, edges, seeds, include_weak=True)
    assert 2 in {r.id for r in wide.collect()}


def test_links_are_one_to_one_and_relevant(spark):
    seeds = spark.createDataFrame([(1, i, n, i) for i, n in enumerate("abc", 1)], "topic_id long, id long, name string, rank int")
    schema = "topic_id long, article_id long, slug string, title string, matched array<struct<relevance_score:double,name:string,id:long>>, max_relevance double, coverage_ratio double"
    summaries = spark.createDataFrame([(1, 1, "one", "One", [(0.9, "a", 1), (0.9, "b", 2), (0.5, "c", 3)], 0.9, 1.0), (1, 2, "two", "Two", [(0.8, "b", 2), (0.3, "c", 3)], 0.8, 0.5)], schema)
    assert [(r.entity, r.slug) for r in retrieval.suggested_links(summaries, seeds).orderBy("pick").collect()] == [("a", "one"), ("b", "two")]


def test_blank_topic_and_empty_graph(spark):
    entities, edges, _, _, _ = graph(spark)
    blank = spark.createDataFrame([(1, "  "), (2, None)], "topic_id long, topic string")
    assert retrieval.seed_entities(entities, blank).count() == 0
    assert retrieval.seed_entities(entities.limit(0), blank).count() == 0


def test_fact_dedupe(spark):
    fact = "warrants lose value as expiry comes near every day"
    docs = spark.createDataFrame([("a", [fact, fact.upper()]), ("b", [fact, fact + " indeed"]), ("c", [fact, "leverage works both ways"]), ("d", [])], "doc string, facts array<string>")
    kept = {r.doc: r.n for r in retrieval.dedupe_facts(docs).groupBy("doc").agg(F.count("*").alias("n")).collect()}
    assert kept == {"a": 1, "b": 1, "c": 2}


def test_keep_first_leaves_keyless_rows(spark):
    rows = spark.createDataFrame([("A", "u/1", 1), ("B", "u/2", 2), ("A", "u/1", 3), ("C", None, 4), ("D", "", 5)], "title string, url string, ord long")
    assert sorted(r.ord for r in dedup.keep_first(rows, "url", "ord").collect()) == [1, 2, 4, 5]


def test_select_topic(spark):
    scored = spark.createDataFrame([(1, "2024-01-01", 0.9, False), (2, "2024-02-01", 0.9, False), (3, "2024-03-01", 1.0, True)], "topic_id long, date string, gap double, has_high boolean")
    assert [r.topic_id for r in selection.select_topic(scored).collect()] == [2]
    assert selection.no_topic_reason(scored.limit(0), scored, scored) == "the catalog is empty"
    assert selection.no_topic_reason(scored, scored, scored.filter("has_high")) == "every open entry duplicates an article"


def test_whole_context(spark):
    entities, edges, articles, links, _ = graph(spark)
    topics = spark.createDataFrame([(1, "Stock Trading Course"), (2, "nothing known")], "topic_id long, topic string")
    sources = spark.createDataFrame([(1, "On nothing known", "s-1", "c", None, "text", None)], "id long, title string, slug string, category string, keywords string, original_content string, status string")
    candidates = spark.createDataFrame([(1, "Picking a Course", ""), (2, "", "index")], "candidate_id long, candidate_title string, candidate_slug string")
    found = retrieval.retrieval_context(topics, entities, edges, articles, links, sources, candidates)
    assert [(r.topic_id, r.note) for r in found["note"].collect()] == [(2, retrieval.NO_SEED)]
    assert [(r.topic_id, r.slug) for r in found["sources"].collect()] == [(2, "s-1")]
    assert {r.candidate_id: r.verdict for r in found["verdict"].collect()} == {1: "high", 2: "medium"}
    assert {(r.topic_id, r.overlaps_specialised) for r in found["hierarchy"].collect()} == {(1, True), (2, False)}
    assert "verdict" not in retrieval.retrieval_context(topics, entities, edges, articles, links, sources)


def test_prefix_filter_loses_nothing(spark):
    import random

    rng = random.Random(4)
    words = [f"w{i}" for i in range(12)] + ["common"]
    rows = [(i, sorted({rng.choice(words) for _ in range(rng.randint(0, 8))})) for i in range(80)]
    a, b = (spark.createDataFrame(rows, f"{k}_id long, {k}_tokens array<string>") for k in "ab")
    for least in (0.3, 0.5, 0.8, 1.0):
        pairs = {tuple(r) for r in retrieval.similar_candidates(a, b, least).collect()}
        assert {(i, j) for i, x in rows for j, y in rows if x and y and len(set(x) & set(y)) >= least * len(set(x) | set(y))} <= pairs


def test_stated_sets_go_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(retrieval, "BROADCAST_ROWS", 3)
    asked = spark.range(10).withColumnRenamed("id", "key")
    found = retrieval.against_all(spark.range(4), asked, "key")
    assert found.distinct().count() == found.count() == 40 and "CartesianProduct" not in found._jdf.queryExecution().toString()


def test_selection_gives_a_row_or_a_reason(spark):
    scored = spark.createDataFrame([(1, "a", "2024-01-01", 0.9, False), (2, "b", "2024-02-01", 0.9, False), (3, "c", "2024-03-01", 1.0, True)], "topic_id long, title string, date string, gap double, has_high boolean")
    none = scored.limit(0)
    pick = lambda *tables: tuple(selection.selection(*tables).first())
    assert pick(scored, scored, scored) == (2, "b", "2024-02-01", 0.9, None)
    assert pick(none, none, none)[-1] == selection.EMPTY and pick(scored, none, none)[-1] == selection.USED and pick(scored, scored, scored.filter("has_high"))[-1] == selection.COVERED


def test_numbering_needs_no_single_partition(spark):
    rows = spark.range(1000).selectExpr("id * 7 % 1000 as k")
    found = dedup.numbered(rows, "nth", "k")
    assert [r.nth - r.k for r in found.collect()] == [1] * 1000


def test_topics_of_one_text_are_matched_once(spark, monkeypatch):
    """As many tasks as topics ask for, and of topics that repeat a text one is matched."""
    monkeypatch.setattr(retrieval, "TOPIC_ROWS", 2)
    asked, plain = [], retrieval.contained
    monkeypatch.setattr(retrieval, "contained", lambda needles, hays: (asked.append((needles.count(), hays.count(), hays.rdd.getNumPartitions())), plain(needles, hays))[1])
    entities = spark.createDataFrame([(1, "large gear", "product"), (2, "Gear", "topic"), (3, "gear box", "product")], ENTITIES)
    texts = ["Large Gear", "gear", " large gear ", "nothing", "GEAR", "boxes", None, " "]
    topics = spark.createDataFrame([(40 - i, t) for i, t in enumerate(texts)], "topic_id long, topic string")
    found = sorted((r.topic_id, r["rank"], r.id, r.score) for r in retrieval.seed_entities(entities, topics).collect())
    large, gear = [(1, 1, 1.0), (2, 2, 0.9), (3, 3, 0.6)], [(1, 2, 1.0), (2, 1, 0.9), (3, 3, 0.9)]
    assert found == sorted((t, *s) for t, some in ((40, large), (38, large), (39, gear), (36, gear)) for s in some)
    assert asked[0] == (3, 4, 2)  # three names in four texts, dealt over two tasks


def test_equal_titles_meet_candidates_once(spark, monkeypatch):
    """With and without slugs; without them no article is written or searched."""
    met, plain = [], retrieval.similar_candidates
    monkeypatch.setattr(retrieval, "similar_candidates", lambda left, right, least: (met.append(left.count()), plain(left, right, least))[1])
    searched, inside = [], retrieval.contained
    monkeypatch.setattr(retrieval, "contained", lambda needles, hays: (searched.append(1), inside(needles, hays))[1])
    titles = ["urgent open order", "plain order", None, "urgent review"]
    articles = spark.createDataFrame([(i, f"order-{i}", titles[i % 4]) for i in range(40)], "id long, slug string, title string")
    candidates = lambda slug: spark.createDataFrame([(1, "Urgent order review", slug), (2, None, None), (3, "bolt", " ")], "candidate_id long, candidate_title string, candidate_slug string")
    found = lambda slug: sorted((r.candidate_id, r.article_id, r.title_similarity, r.slug_similarity) for r in retrieval.title_slug_similarity(articles, candidates(slug)).collect())
    near = {0: 0.5, 3: 0.67}
    assert found("") == [(1, i, near[i % 4], 0.0) for i in range(40) if i % 4 in near] and not searched
    slugged = {5: (0.25, 1.0)}
    assert found("Order-5") == sorted([(1, i, near[i % 4], 0.0) for i in range(40) if i % 4 in near] + [(1, i, *s) for i, s in slugged.items()]) and searched
    assert met == [4, 4]


def test_seed_overlaps_equal_duplicates_of_summaries(spark):
    entities, edges, articles, links, topics = graph(spark)
    topics = topics.unionByName(spark.createDataFrame([(2, "warrant"), (3, "none")], topics.schema))
    links = links.unionByName(spark.createDataFrame([(2, 4, 0.7), (2, 5, 0.55), (1, 5, 0.2), (9, 4, 1.0)], links.schema))
    seeds = retrieval.seed_entities(entities, topics)
    related = retrieval.expand_related(entities, edges, seeds, 1)[0]
    expected = retrieval.near_duplicates(retrieval.article_summaries(articles, links, related), seeds)
    made = retrieval.seed_overlaps(articles, links, related, seeds)
    assert made.columns == expected.columns and sorted(map(tuple, made.collect())) == sorted(map(tuple, expected.collect())) and made.count() > 1
    assert "collect_list" not in made._jdf.queryExecution().toString()
