"""Commits of several writers, buckets that keep their files, small files with a commit, and whole publishing runs."""

import json
import os
import threading

import pytest

from quillgraph.operators import store
from quillgraph.plans import pipelines

ARTICLE = "slug string, filepath string, title string, summary string, body_text string, published_at string, last_updated string, status string"


def articles(spark, slugs, title="T"):
    return spark.createDataFrame([(s, f"{s}.html", title, "", "", None, None, "published") for s in slugs], ARTICLE).withColumn("ord", store.F.col("slug"))


def files_of(tx, table):
    out = {}
    for bucket, place in tx.tables[table]["paths"].items():
        folder = f"{tx.store.root}/{place}".removeprefix("file://")
        out[bucket] = {(f, os.path.getmtime(f"{folder}/{f}")) for f in os.listdir(folder)}, place
    return out


def test_upserts_touch_only_buckets_of_their_keys(spark, tmp_path):
    kept = store.Store(spark, f"file://{tmp_path}/s", buckets=16)
    slugs = [f"slug-{i}" for i in range(60)]
    kept.transact(lambda tx: tx.upsert("articles", articles(spark, slugs), "slug", "ord"))
    before = files_of(kept.begin(), "articles")
    first = {r.slug: r.id for r in kept.read("articles").collect()}
    assert sorted(first.values()) == list(range(1, 61)) and len(before) > 8
    kept.transact(lambda tx: tx.upsert("articles", articles(spark, ["slug-3", "new"], "U"), "slug", "ord"))
    after = files_of(kept.begin(), "articles")
    changed = {b for b in after if after[b] != before.get(b)}
    assert 1 <= len(changed) <= 2
    rows = {r.slug: (r.id, r.title) for r in kept.read("articles").collect()}
    assert rows == {**{s: (i, "T") for s, i in first.items()}, "slug-3": (first["slug-3"], "U"), "new": (61, "U")}
    plain = store.upsert(kept.read("articles", 1), articles(spark, ["slug-3", "new"], "U"), "slug", "ord")
    assert {r.slug: (r.id, r.title) for r in plain.collect()} == rows
    assert kept.rollback(1) == 3 and files_of(kept.begin(), "articles") == before


def test_only_one_writer_puts_a_version(spark, tmp_path):
    path = f"file://{tmp_path}/v/1.json"
    wins = []
    threads = [threading.Thread(target=lambda i=i: wins.append(i) if store.put_if_absent(spark, path, str(i)) else None) for i in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(wins) == 1 and store.read_text(spark, path) == str(wins[0])
    assert os.listdir(f"{tmp_path}/v") == ["1.json"]


def test_writers_at_once_lose_nothing(spark, tmp_path):
    kept = store.Store(spark, f"file://{tmp_path}/s", buckets=4)
    kept.transact(lambda tx: tx.upsert("articles", articles(spark, ["base"]), "slug", "ord"))
    barrier, tries = threading.Barrier(2), []

    def write(slug):
        def change(tx):
            tx.upsert("articles", articles(spark, [slug]), "slug", "ord")
            tx.put_file(f"{slug}.html", slug)
            tries.append(slug)
            if tries.count(slug) == 1:
                barrier.wait(60)  # both have read the same version

        store.Store(spark, kept.root, buckets=4).transact(change)

    threads = [threading.Thread(target=write, args=(s,)) for s in ("left", "right")]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    rows = {r.slug: r.id for r in kept.read("articles").collect()}
    assert rows.keys() == {"base", "left", "right"} and sorted(rows.values()) == [1, 2, 3]
    assert kept.version == 3 and len(tries) == 3
    assert {kept.file("left.html"), kept.file("right.html")} == {"left", "right"}


def test_conflicts_and_other_tables(spark, tmp_path):
    kept = store.Store(spark, f"file://{tmp_path}/s")
    meta = lambda v: spark.createDataFrame([("k", v)], "key string, value string")
    one, two = kept.begin(), kept.begin()
    one.write("meta", meta("1"))
    two.put_file("x", "other")
    kept._put(one)
    assert kept._put(two) == 2 and kept.read("meta").first().value == "1"  # they do not meet
    late = kept.begin(1)
    late.write("meta", meta("2"))
    assert kept._put(late) == 3  # meta is as it was at version 1
    stale = kept.begin(2)
    stale.write("meta", meta("3"))
    with pytest.raises(store.Conflict):
        kept._put(stale)
    assert kept.read("meta").first().value == "2" and kept.file("x") == "other"


def test_exported_files_follow_the_version(spark, tmp_path):
    kept, site = store.Store(spark, f"file://{tmp_path}/s"), f"{tmp_path}/site"
    kept.transact(lambda tx: [tx.put_file("index.html", "one"), tx.put_file("map.xml", "<urlset></urlset>")])
    assert kept.export_files(f"file://{site}") == ["index.html", "map.xml"]
    kept.transact(lambda tx: [tx.put_file("index.html", "two"), tx.put_file("a/b.html", "page")])
    assert kept.export_files(f"file://{site}") == ["a/b.html", "index.html"]
    assert open(f"{site}/a/b.html").read() == "page"
    kept.rollback(1)
    assert kept.export_files(f"file://{site}") == ["a/b.html", "index.html"] and not os.path.exists(f"{site}/a/b.html")
    assert open(f"{site}/index.html").read() == "one" and kept.export_files(f"file://{site}") == []
    kept.transact(lambda tx: tx.put_file("map.xml", None))
    assert kept.file("map.xml") is None and kept.export_files(f"file://{site}") == ["map.xml"]


LISTING = '<html><body><div class="articles-grid" id="articlesGrid">\n<!-- cards --></div></body></html>'
SITEMAP = "<urlset></urlset>"


def test_a_publishing_run_has_one_of_nine_statuses(spark, tmp_path):
    from quillgraph.functions import markup

    listing = LISTING if markup.GRID in LISTING else f"<html><body>{markup.GRID}</div></body></html>"
    kept = store.Store(spark, f"file://{tmp_path}/s", buckets=4)
    kept.transact(lambda tx: [tx.put_file("articles.html", listing), tx.put_file("sitemap.xml", SITEMAP), tx.upsert("articles", articles(spark, ["taken", "market-depth-guide"], "Market Depth Guide"), "slug", "ord")])
    topics = spark.createDataFrame([("1", "Gamma Ray Basics", 0.9), ("2", "Other", 0.2)], "key string, topic string, gap double")
    items = spark.createDataFrame([("1", "Gamma", "concept", "w")], "key string, name string, type string, why string")
    body = "## Gamma\n\n" + " ".join(["word"] * 60)
    write = lambda prompt: json.dumps({"title": "Gamma Ray Basics", "summary": "sum", "body_text": body, "graph_steps": ["a", "b"]})
    review = lambda status: lambda prompt: json.dumps([{"name": "Gamma", "status": status, "evidence": "e"}])
    graph = lambda tx: tx.write("meta", spark.createDataFrame([("graph", "done")], "key string, value string"))

    def fail(_):
        raise RuntimeError("no answer")

    def run(candidates=topics, writer=write, reviewer=review("covered"), translate=lambda a: a, extract=graph, **more):
        return pipelines.publishing_run(kept, candidates, items, writer, reviewer, translate, extract, "https://site", "me", "2024-01-02", target=20, **more)

    named = lambda topic: spark.createDataFrame([("1", topic, 0.5)], "key string, topic string, gap double")
    closed = {
        "not-due": dict(due=False),
        "no-topic": dict(candidates=topics.limit(0)),
        "slug-collision": dict(candidates=named("Taken")),
        "duplicate-risk-high": dict(candidates=named("Market Depth Guide!"), force=True),
        "coverage-review-failed": dict(writer=lambda prompt: "no json"),
        "coverage-gap": dict(reviewer=review("missing")),
        "translation-failed": dict(translate=fail),
        "graph-extraction-failed": dict(extract=fail),
    }
    kept_files = kept.begin().files
    for status, options in closed.items():
        if status == "duplicate-risk-high":
            kept_titles = spark.createDataFrame([("1", "Depth Guide Market", 0.5)], "key string, topic string, gap double")
            options["candidates"] = kept_titles
        done = run(**options)
        assert (done.status, kept.version) == (status, 1), (status, done)
        assert kept.begin().files == kept_files
    assert "no answer" in run(translate=fail).reason
    done = run(due=False, force=True)
    assert (done.status, done.slug, done.version) == ("ok", "gamma-ray-basics", 2)
    assert "gamma-ray-basics" in kept.file("articles.html") and "gamma-ray-basics.html" in kept.file("sitemap.xml")
    assert "<h2>Gamma</h2>" in kept.file("articles/gamma-ray-basics.html") and kept.read("meta").count() == 1
    kept.rollback(1)
    assert kept.file("articles.html") == listing and kept.file("articles/gamma-ray-basics.html") is None
