import json

from quillgraph.plans import pipelines


def page(headline, body):
    return f'<script type="application/ld+json">{json.dumps({"@type": "NewsArticle", "headline": headline, "articleBody": body})}</script>'


def test_scrape_outcomes(spark):
    rows = spark.createDataFrame([("https://h/n/1", "One"), ("https://h/n/2", "Two"), ("https://h/n/3", "Three"), ("https://h/n/4?x=1", "Four")], "url string, title string")
    fetched = spark.createDataFrame([("https://h/n/1", 200, page("First | e南洋", "text")), ("https://h/n/2", 200, "<p>none</p>"), ("https://h/n/3", 500, None), ("https://h/n/4?x=1", 200, page("Fourth", "b"))], "url string, status int, html string")
    known = spark.createDataFrame([("old-slug", "https://h/n/4/")], "slug string, original_url string")
    found = {r.url: (r.status, r.slug) for r in pipelines.scrape_outcomes(rows, fetched, known).collect()}
    assert found == {"https://h/n/1": ("ok", "first-1"), "https://h/n/2": ("no-article-body", "two-2"), "https://h/n/3": ("fetch-error", "three-3"), "https://h/n/4?x=1": ("ok", "old-slug")}


def test_write_review_publish(spark):
    def writer(prompt):  # inside the test, so that workers get it by value
        body = "## H\n\n" + "word " * (30 if prompt.startswith("Repair") else 10)
        return json.dumps({"title": "A Title", "summary": "s", "body_text": body, "graph_steps": ["a", "b"]})

    def reviewer(prompt):
        return json.dumps([{"name": "x", "status": "covered" if prompt.count("word") > 20 else "partial", "evidence": ""}])

    topics = spark.createDataFrame([("k", "topic")], "key string, topic string")
    items = spark.createDataFrame([("k", "x", "topic", "why")], "key string, name string, type string, why string")
    done = pipelines.write_with_review(topics, items, writer, reviewer, target=25)
    row = done.first()
    assert (row.covered, row.repaired, row.error, row.words) == (True, True, None, 31)
    gate = pipelines.publish_gate
    assert (row.off_topic, row.missing, row.inserted) == ([], [], [])
    assert gate(False, "t", False, "none", row) == "not-due" and gate(True, None, False, "none", row) == "no-topic" and gate(True, "t", True, "none", row) == "slug-collision"
    assert gate(True, "t", False, "high", row) == "duplicate-risk-high" and gate(True, "t", False, "none", row) == "ok"
    out = pipelines.assemble(done, "https://s", "W", "2024-05-06").first()
    assert out.slug == "a-title" and "<h2>H</h2>" in out.html and "a-title.html" in out.card and "2024-05-06" in out.sitemap_url
    broken = pipelines.write_with_review(topics, items, lambda p: "oops", reviewer, target=25).first()
    assert gate(True, "t", False, "none", broken) == gate(True, "t", False, "none", None) == "coverage-review-failed"


def test_repair_of_off_topic_sections_facts_and_links(spark):
    def writer(prompt):
        heading = "## Real\n\n" if prompt.startswith("Repair") and "The Role of Call Warrants" in prompt else "## The Role of Call Warrants\n\n"
        return json.dumps({"title": "T", "summary": "s", "body_text": heading + "time decay matters", "graph_steps": ["a", "b"]})

    def reviewer(prompt):
        return json.dumps([{"name": "x", "status": "covered", "evidence": ""}, {"name": "A fact", "status": "missing" if "A fact" in prompt else "covered", "evidence": ""}])

    topics = spark.createDataFrame([("k", "topic")], "key string, topic string")
    items = spark.createDataFrame([("k", "x", "topic", "why", None), ("k", "Call Warrant", "product", "why", "distinguished_from")], "key string, name string, type string, why string, relation string")
    facts = spark.createDataFrame([("k", ["A fact", "a fact"])], "key string, facts array<string>")
    links = spark.createDataFrame([("k", [("Time Decay", "theta"), ("absent", "y")])], "key string, links array<struct<entity:string,target_slug:string>>")
    row = pipelines.write_with_review(topics, items, writer, reviewer, target=0, facts=facts, links=links).first()
    assert row.repaired and row.off_topic == [] and row.missing == ["A fact"] and row.inserted == ["Time Decay"] and row.skipped == ["absent"]
    assert '<a href="theta.html">time decay</a>' in row.body
    assert pipelines.publish_gate(True, "t", False, "none", row) == "coverage-gap"
    kept = pipelines.write_with_review(topics, items, writer, lambda p: "oops", target=0).first()
    assert kept.draft.title == "T" and kept.error == "not the expected JSON"


def graph_tables(spark):
    entities = spark.createDataFrame([(1, "Old", "topic"), (2, "Gone", "topic"), (3, "Else", "topic")], "id long, name string, type string")
    links = spark.createDataFrame([(10, 1, 0.5), (10, 2, 0.5), (20, 3, 0.5)], "article_id long, entity_id long, relevance_score double")
    edges = spark.createDataFrame([(1, 1, "part_of", 2)], "edge_ord long, source_entity_id long, relation string, target_entity_id long")
    return {"entities": entities, "article_entities": links, "edges": edges}


def test_extract_write_diff(spark):
    one = lambda slug, *names: {"slug": slug, "entities": [{"name": n, "type": "topic", "relevance_score": "0.5"} for n in names], "edges": [{"source": names[0], "relation": "updates", "target": names[-1]}]}

    def extractor(prompt):
        if "## ten" in prompt:
            return json.dumps([one("ten", "OLD", "Gone"), one("twenty", "Else", "New")])
        return json.dumps([one("thirty", "a")]) if "## thirty" in prompt else "oops"

    articles = spark.createDataFrame([(1, 10, "ten", "t", "b"), (1, 20, "twenty", "t", "b"), (2, 30, "thirty", "t", "b"), (2, 40, "forty", "t", "b"), (3, 50, "fifty", "t", "b")], "batch int, id long, slug string, title string, body_text string")
    tables, outcomes, totals = pipelines.extract_batches(graph_tables(spark), articles, extractor)
    found = {r.slug: (r.status, r.dropped, r.altered, r.error) for r in outcomes.collect()}
    assert found == {"ten": ("regression", 0, 1, None), "twenty": ("ok", 0, 0, None), "thirty": ("error", 0, 0, "a slug is missing"), "forty": ("error", 0, 0, "a slug is missing"), "fifty": ("error", 0, 0, "not the expected JSON")}
    assert [(r.batch, r.n_entities, r.n_edges) for r in totals.collect()] == [("1", 4, 2)]
    assert {r.name for r in tables["entities"].collect()} == {"Old", "Gone", "Else", "New"}
    same, dry, _ = pipelines.extract_batches(graph_tables(spark), articles, extractor, dry_run=True)
    assert same["edges"].count() == 1 and {r.status for r in dry.collect()} == {"dry-run", "error"}


def test_publishing_rolls_back(spark, tmp_path):
    from quillgraph.operators import store

    kept = store.Store(spark, str(tmp_path / "store"))
    record = "slug string, filepath string, title string, summary string, body_text string, published_at string, last_updated string, status string"
    article = lambda slug: spark.createDataFrame([(slug, "f", "T", "", "", None, None, "published")], record)

    def fail(_):
        raise RuntimeError("no")

    def extract(target):
        target.commit({"meta": spark.createDataFrame([("k", "v")], "key string, value string")})

    slugs = lambda: sorted(r.slug for r in kept.read("articles").collect())
    assert pipelines.publish(kept, article("a"), fail, extract) == "translation-failed" and kept.version == 0
    assert pipelines.publish(kept, article("a"), lambda x: x, fail) == "graph-extraction-failed" and slugs() == []
    assert pipelines.publish(kept, article("b"), lambda x: x, extract) == "ok" and slugs() == ["b"]
    assert pipelines.publish(kept, article("c"), lambda x: x, fail) == "graph-extraction-failed" and slugs() == ["b"] and kept.read("meta").count() == 1


def test_stream_of_hits(spark, tmp_path):
    from quillgraph.streaming import hits

    rows = spark.createDataFrame([("2024-01-01 00:00:00", 1, "view"), ("2024-01-01 00:10:00", 1, "view"), ("2024-01-01 01:00:00", 2, "view")], "ts string, user_id long, event_type string")
    rows.selectExpr("cast(ts as timestamp) ts", "user_id", "event_type").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("ts timestamp, user_id long, event_type string").parquet(str(tmp_path / "in"))
    seen = []
    query = hits.run_batches(hits.distinct_hits(stream), lambda df, _: seen.extend(r.user_id for r in df.collect()), str(tmp_path / "cp"))
    query.awaitTermination(60)
    assert sorted(seen) == [1, 2]
