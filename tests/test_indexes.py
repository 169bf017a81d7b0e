"""Containment, pattern search, graph expansion, URLs, sessions and read-back against plain definitions."""

import random

import pytest
from pyspark.sql import functions as F

from quillgraph.functions import markup, urls, weburl
from quillgraph.operators import containment, dedup, retrieval
from quillgraph.plans import pipelines
from quillgraph.schema import EDGES, ENTITIES
from quillgraph.sources import ingest
from quillgraph.streaming import hits


def words(rng, n):
    return ["".join(rng.choice("abcé") for _ in range(rng.choice([0, 1, 2, 3, 4, 7, 12]))) for _ in range(n)]


@pytest.mark.parametrize("limit_bytes", [1 << 20, 20])
@pytest.mark.parametrize("kind", [int, str])
def test_containment_equals_every_pair(spark, monkeypatch, limit_bytes, kind):
    """By one automaton, and by grams where the needles are more than its bound; ids of either type."""
    monkeypatch.setattr(containment, "PATTERN_BYTES", limit_bytes)
    rng = random.Random(1)
    needles, hays = words(rng, 60) + [None, "abc" * 31, "abc" * 30], words(rng, 80) + ["abc" * 30, None]
    ids = {int: "long", str: "string"}[kind]
    rows = lambda values: [(kind(i), v) for i, v in enumerate(values)]
    found = containment.contained(spark.createDataFrame(rows(needles), f"needle_id {ids}, needle string"), spark.createDataFrame(rows(hays), f"hay_id {ids}, hay string"))
    assert sorted(map(tuple, found.collect())) == sorted((kind(i), kind(j)) for i, n in enumerate(needles) for j, h in enumerate(hays) if n and h and n in h)
    assert "NestedLoop" not in found._jdf.queryExecution().toString() and "Cartesian" not in found._jdf.queryExecution().toString()


def test_strings_that_share_beginnings_meet_by_long_grams(spark, monkeypatch):
    monkeypatch.setattr(containment, "PATTERN_BYTES", 0)
    monkeypatch.setattr(containment, "HOT_GRAM", 5)
    sizes, plain = set(), containment._grams
    monkeypatch.setattr(containment, "_grams", lambda c, size: (sizes.add(size), plain(c, size))[1])
    needles, hays = [f"order-{k}" for k in range(0, 300, 7)], [f"order-{k}" for k in range(900)]
    found = containment.contained(spark.createDataFrame(enumerate(needles), "needle_id long, needle string"), spark.createDataFrame(enumerate(hays), "hay_id long, hay string"))
    assert sorted(map(tuple, found.collect())) == sorted((i, j) for i, n in enumerate(needles) for j, h in enumerate(hays) if n in h)
    assert sizes == {4, 8}


def test_long_needles_meet_by_grams(spark, monkeypatch):
    """A gram of 256 characters once had as many nested steps, for which the analyzer gave up."""
    monkeypatch.setattr(containment, "PATTERN_BYTES", 0)
    rng = random.Random(3)
    text = "".join(rng.choice("aéb😀c ") for _ in range(1200))
    needles = [text[a : a + n] for a, n in ((0, 256), (3, 300), (700, 500), (40, 511), (1, 1))] + ["x" + text[9:290], text[5:300] + "x"]
    hays = [text, text[:600], text[3:303], "", None, text[650:]]
    found = containment.contained(spark.createDataFrame(enumerate(needles), "needle_id long, needle string"), spark.createDataFrame(enumerate(hays), "hay_id long, hay string"))
    assert sorted(map(tuple, found.collect())) == sorted((i, j) for i, n in enumerate(needles) for j, h in enumerate(hays) if h and n in h)


def test_without_needles_no_hay_is_read(spark):
    none, hay = spark.createDataFrame([], "needle_id long, needle string"), spark.createDataFrame([(1, "ba")], "hay_id long, hay string")
    found = containment.contained(none, hay)
    assert found.columns == ["needle_id", "hay_id"] and "MapInArrow" not in found._jdf.queryExecution().toString()


def test_containment_without_needles_or_hays(spark, monkeypatch):
    none, one = spark.createDataFrame([], "needle_id long, needle string"), spark.createDataFrame([(1, "a")], "needle_id long, needle string")
    empty, hay = spark.createDataFrame([], "hay_id long, hay string"), spark.createDataFrame([(1, "ba")], "hay_id long, hay string")
    for limit_bytes in (1 << 20, 0):
        monkeypatch.setattr(containment, "PATTERN_BYTES", limit_bytes)
        assert [containment.contained(n, h).count() for n, h in ((none, hay), (one, empty), (none, empty), (one, hay))] == [0, 0, 0, 1]


@pytest.mark.parametrize("limit_bytes", [1 << 20, 20])
def test_first_hits_and_found_in(spark, monkeypatch, limit_bytes):
    monkeypatch.setattr(containment, "PATTERN_BYTES", limit_bytes)
    rng = random.Random(2)
    texts = [(i, " ".join(words(rng, 9)), " ".join(words(rng, 3))) for i in range(50)] + [(50, None, "ab")]
    patterns = sorted({w for w in words(rng, 30) if w}) + [""]
    frame, asked = spark.createDataFrame(texts, "id long, a string, b string"), spark.createDataFrame([(p,) for p in patterns], "pattern string")
    found = containment.first_hits(frame, [("a", asked), ("b", asked), ("a", asked.limit(1))], 3)
    expected = []
    for k, (column, mine) in enumerate([(1, patterns), (2, patterns), (1, [asked.limit(1).first().pattern])]):
        expected += [(k, p, i) for p in mine if p for i in sorted(t[0] for t in texts if t[column] and p in t[column])[:3]]
    assert sorted((r.search, r.pattern, r.id) for r in found.collect()) == sorted(expected)
    every = containment.found_in(frame.select("id", F.col("a").alias("text")), asked)
    assert sorted(map(tuple, every.collect())) == sorted((t[0], p) for t in texts for p in patterns if p and t[1] and p in t[1])


def breadth_first(edges, seeds, hops):
    seen, frontier = {s: 0 for s in seeds}, list(seeds)
    for hop in range(1, hops + 1):
        new = {}
        for _, s, relation, t in sorted(edges):
            if relation != "related_to":
                for a, b in ((s, t), (t, s)):
                    if a in frontier and b not in seen:
                        new.setdefault(b, hop)
        seen.update(new)
        frontier = list(new)
    return seen


def test_five_hops_and_a_plan_that_does_not_grow(spark):
    rng = random.Random(3)
    edges = [(k, rng.randrange(1, 121), rng.choice(["part_of", "related_to", "updates"]), rng.randrange(1, 121)) for k in range(1, 130)] + [(200 + k, 1, "part_of", 121 + k) for k in range(60)]
    entities = spark.createDataFrame([(i, f"e{i}", "topic") for i in range(1, 182)], ENTITIES)
    seeds = spark.createDataFrame([(1, 1, "e1", "topic", "r", 1), (2, 5, "e5", "topic", "r", 1), (2, 9, "e9", "topic", "r", 2)], "topic_id long, id long, name string, type string, reason string, rank int")
    frame, sizes = spark.createDataFrame(edges, EDGES), []
    for hops in (2, 5, 40):
        related, weak = retrieval.expand_related(entities, frame, seeds, hops)
        expected = {(t, i, h) for t, start in ((1, [1]), (2, [5, 9])) for i, h in breadth_first(edges, start, hops).items()}
        assert {(r.topic_id, r.id, r.hop) for r in related.collect()} == expected
        sizes.append(len(related._jdf.queryExecution().optimizedPlan().toString().splitlines()))
    assert len(set(sizes)) == 1


def test_numbers_follow_the_order_whatever_the_partitions(spark):
    rows = [(i, random.Random(i).choice("abc"), None if i % 50 == 0 else i % 7) for i in range(5000)]
    frame = spark.createDataFrame(rows, "id long, k string, v long").repartition(7)
    expected = sorted(rows, key=lambda r: (r[1], r[2] is not None, r[2] or 0, r[0]))
    numbered = dedup.numbered(frame, "n", "k", "v", "id")
    assert numbered.columns == ["id", "k", "v", "n"]
    assert [tuple(r)[:3] for r in numbered.orderBy("n").collect()] == expected
    assert [r.n for r in numbered.orderBy("n").collect()] == list(range(1, 5001)) and dedup.numbered(frame.limit(0), "n", "k").count() == 0


#: Golden cases of the standard: input, and scheme://host/path without trailing slashes.
GOLDEN = {
    "http://ex.com/a/../b": "http://ex.com/b", "http://ex.com/a b": "http://ex.com/a%20b", "http://ex.com\\a": "http://ex.com/a", "HTTP://EX.com:80/./x/%2E%2e/y/": "http://ex.com/y",
    "http://192.168.0.1.:8080/": "http://192.168.0.1:8080", "http://0x7f.1/": "http://127.0.0.1", "http://[::1]:80/a": "http://[::1]/a", "http://[::ffff:1.2.3.4]/": "http://[::ffff:102:304]",
    "mailto:a@b": "mailto://a@b", "http://a b/": None, "http://": None, "https:example.org": "https://example.org", "https:///example.org//x": "https://example.org//x", "http://u:p@h/p?q#f": "http://h/p",
    "http://münchen.de/ä": "http://xn--mnchen-3ya.de/%C3%A4", "file:///C|/a/../b": "file:///C:/b", "file://localhost/x": "file:///x", "http://h:99999/": None, "http://h:x/": None, "http://a%00b/": None,
    "non-special://H/%2e/a": "non-special://H/a", "http://1.2.3.999/": None, "  http://h/ \n": "http://h", "http://h:/": "http://h", "ht\ntp://h/a\tb": "http://h/ab", "http://h/a%2fb": "http://h/a%2fb",
    "http://h/..": "http://h", "http://h/a/.": "http://h/a", "https://h:443/x": "https://h/x", "https://h:80/x": "https://h:80/x", "http://%65x.com/": "http://ex.com", "//h/x": None, "x": None, "": None,
    "http://ex.com/a?b=/../c": "http://ex.com/a", "http://ex.com/.../x": "http://ex.com/.../x", "http://ex.com/a;b=1/,x": "http://ex.com/a;b=1/,x", "http://h.com:080/": "http://h.com", "\u3000http://h/x\ufeff": "http://h/x",
}


def test_urls_by_the_standard(spark):
    found = spark.createDataFrame([(u,) for u in [*GOLDEN, None]], "u string").select("u", urls.canonical_url("u").alias("c")).collect()
    assert {r.u: r.c for r in found if r.c != GOLDEN.get(r.u)} == {}
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("url", urls.canonical_url("url").alias("c")).collect()
    assert len(pages) >= 50 and all(r.c == (r.url and weburl.canonical(r.url)) for r in pages)


def test_sessions_of_a_stream_equal_those_of_a_batch(spark, tmp_path):
    loads = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select(F.col("ts").cast("timestamp").alias("ts"), "user_id", F.col("event_type").alias("page"))
    loads = loads.unionByName(loads.filter("user_id % 3 = 0").withColumn("ts", F.expr("ts + interval 1 minute")))
    batch = {tuple(r) for r in hits.session_hits(loads).collect()}
    per_page = loads.filter("user_id is not null").groupBy("page").count().count()
    assert len(batch) < loads.count() and per_page > 1
    # A last load far behind closes all sessions; files come in the order of time.
    end = spark.sql("select timestamp'2030-01-01' as ts, cast(-1 as bigint) as user_id, 'end' as page")
    for k, part in enumerate([*(loads.filter(F.dayofyear("ts") == d) for d in sorted({r[0] for r in loads.select(F.dayofyear("ts")).distinct().collect()})), end]):
        part.coalesce(1).write.parquet(str(tmp_path / f"in/{k:03d}"))
    stream = spark.readStream.schema(loads.schema).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 10).parquet(str(tmp_path / "in"))
    query = hits.session_hits(stream).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination(120)
    streamed = [tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).filter("user_id >= 0").collect()]
    assert len(streamed) == len(set(streamed)) and set(streamed) == batch


def test_listing_and_sitemap_read_back(spark, tmp_path):
    rows = [(f"slug-{i}", f'T & "{i}" <b>', f"sum > {i}", f"2024-0{i}-02", 200 * i) for i in range(1, 6)]
    frame = spark.createDataFrame(rows, "slug string, title string, summary string, day string, words int")
    card = markup.article_card(F.col("slug"), F.col("title"), F.col("summary"), F.lit("Tag & more"), F.col("day"), F.lit(3))
    made = frame.select("slug", card.alias("card"), markup.sitemap_url(F.concat(F.lit("https://site/a?x=1&y="), "slug"), F.col("day")).alias("url")).orderBy("slug").collect()
    listing, sitemap = f"<html><body>{markup.GRID}</div></body></html>", '<?xml version="1.0"?>\n<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"></urlset>'
    for r in made:
        edited = spark.range(1).select(markup.insert_card(F.lit(listing), F.lit(r.card)), markup.insert_url(F.lit(sitemap), F.lit(r.url))).first()
        listing, sitemap = edited
    cards = ingest.listing_cards(spark.createDataFrame([(1, listing), (2, "<p>none</p>")], "page_id long, html string"))
    assert [(r.slug, r.category, r.title, r.summary) for r in cards.orderBy(F.desc("pos")).collect()] == [(s, "Tag & more", t, u) for s, t, u, *_ in rows]
    (tmp_path / "sitemap.xml").write_text(sitemap)
    found = ingest.sitemap_rows(spark, str(tmp_path / "sitemap.xml")).collect()
    assert sorted((r["loc"], r["lastmod"], r["priority"]) for r in found) == sorted((f"https://site/a?x=1&y={s}", d, 0.8) for s, _, _, d, _ in rows)


def test_all_statuses_of_scraped_rows(spark):
    page = lambda body: f'<script type="application/ld+json">{body}</script>'
    fetched = [
        ("u1", 200, page('{"@type":"NewsArticle","headline":"H","articleBody":"text"}'), "ok"), ("u2", 404, None, "fetch-error"), ("u3", 200, page('{"@type":"NewsArticle",'), "ok"),
        ("u4", 200, page('{"@type":"NewsArticle","headline":"H","articleBody":" "}'), "ok"), ("u5", None, None, "stopped"),
    ]
    frame = spark.createDataFrame(fetched, "url string, status int, html string, outcome string")
    rows, known = spark.createDataFrame([(u, "t") for u in ("u1", "u2", "u3", "u4", "u5", "u6", None)], "url string, title string"), spark.createDataFrame([], "slug string, original_url string")
    outcome = lambda **more: {r.url: r.status for r in pipelines.scrape_outcomes(rows, frame, known, **more).collect()}
    expected = {"u1": "ok", "u2": "fetch-error", "u3": "parse-error", "u4": "no-article-body", "u5": "stopped", "u6": "fetch-error", None: "error"}
    assert outcome() == expected and outcome(dry_run=True) == {**expected, "u1": "dry-run"}


def test_extraction_sees_known_names_and_isolates_failures(spark):
    import json

    tables = {
        "entities": spark.createDataFrame([(1, "Alpha Fund", "topic"), (2, "Nowhere", "topic")], ENTITIES),
        "article_entities": spark.createDataFrame([], "article_id long, entity_id long, relevance_score double"),
        "edges": spark.createDataFrame([], EDGES),
    }
    articles = spark.createDataFrame([(1, 10, "one", "On alpha fund", "b"), (1, None, "two", "t", "b"), (2, 30, "three", "t", "b"), (3, 40, "four", "t", "b")], "batch int, id long, slug string, title string, body_text string")

    def extractor(prompt):
        if "## four" in prompt:
            raise RuntimeError("out of tokens")
        known = prompt.rsplit("# known names\n", 1)[1]
        entity = lambda slug: {"slug": slug, "entities": [{"name": f"{slug} of {known}", "type": "topic", "relevance_score": "0.5"}], "edges": []}
        return json.dumps([entity("one"), entity("two")] if "## one" in prompt else [entity("three")])

    after, outcomes, _ = pipelines.extract_batches(tables, articles, extractor, skip_checker=True)
    assert {r.slug: (r.status, r.error) for r in outcomes.collect()} == {"one": ("written-unchecked", None), "two": ("error", "the article has no id"), "three": ("written-unchecked", None), "four": ("error", "RuntimeError: out of tokens")}
    assert {r.name for r in after["entities"].collect()} == {"Alpha Fund", "Nowhere", "one of Alpha Fund", "three of"}

    def naming(prompt):
        known = prompt.rsplit("# known names\n", 1)[1]
        slug = next(x for x in ("one", "three", "four") if f"## {x}\n" in prompt)
        name = known.upper() if "Beta Bond" in known else "Beta Bond"
        return json.dumps([{"slug": slug, "entities": [{"name": name, "type": "topic", "relevance_score": "0.5"}], "edges": []}])

    rounds = spark.createDataFrame([(1, 1, 10, "one", "t", "about the beta bond"), (2, 2, 30, "three", "Beta bond", "b"), (2, 3, 40, "four", "t", "no name")], "round int, batch int, id long, slug string, title string, body_text string")
    after, outcomes, totals = pipelines.extract_rounds(tables, rounds, naming)
    assert {r.status for r in outcomes.collect()} == {"ok"} and totals.count() == 3
    names = {r.id: r.name for r in after["entities"].collect()}
    assert names == {1: "Alpha Fund", 2: "Nowhere", 3: "Beta Bond"}  # the later article was shown the name, in capitals it is the same entity
    assert sorted((r.article_id, r.entity_id) for r in after["article_entities"].collect()) == [(10, 3), (30, 3), (40, 3)]
    assert pipelines.extract_rounds(tables, rounds.limit(0), naming)[1].count() == 0


def test_search_metadata_and_translated_bodies(spark):
    import json

    bodies = spark.createDataFrame([("1", '<p class="x">One <b>two</b></p><figure class="graph-block"><b>keep</b></figure>'), ("2", "<hr>"), ("3", "<p>drop</p>"), ("4", "<p>bad</p>")], "key string, html string")

    def model(prompt):
        if "bad" in prompt:
            raise RuntimeError("no answer")
        texts = json.loads(next(line for line in prompt.splitlines() if line.startswith("{") and '"1"' in line))
        return json.dumps({k: v.upper() for k, v in texts.items() if v != "drop"})

    rows = {r.key: (r.html, r.error) for r in pipelines.translate_bodies(bodies, model, "Chinese").collect()}
    assert rows == {
        "1": ('<p class="x">ONE <b>TWO</b></p><figure class="graph-block"><b>keep</b></figure>', None),
        "2": ("<hr>", None), "3": (None, "an id is missing"), "4": (None, "RuntimeError: no answer"),
    }
    drafts = spark.createDataFrame([("1", "T", "b"), ("2", "U", "b")], "key string, title string, body_text string")
    full = {k: "x" for k in ("title", "meta_description", "canonical_slug", "og_title", "og_description")} | {k: ["x"] for k in ("primary_keywords", "secondary_keywords", "internal_anchor_texts")}
    full |= {"headings": [{"level": 2, "text": "h"}], "faq": [{"question": "q", "answer": "a"}]}
    found = {r.key: (r.metadata and r.metadata.title, r.error) for r in pipelines.seo_metadata(drafts, lambda p: json.dumps(full) if "# title\nT" in p else "{}").collect()}
    assert found == {"1": ("x", None), "2": (None, "a text is blank")}
