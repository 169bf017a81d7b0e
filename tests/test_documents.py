import json

import pytest
from pyspark.sql import functions as F

from quillgraph.functions import markup, text, urls
from quillgraph.functions import html as H
from quillgraph.operators import contracts, graph, quality, store
from quillgraph.sources import ingest


def one(spark, column, **values):
    return spark.range(1).select(*(F.lit(v).alias(k) for k, v in values.items())).select(column.alias("x")).first().x


def test_urls(spark):
    for url, expected in [("https://h/news/x/1?utm_source=fb#top", "https://h/news/x/1"), ("https://H/news/x/1/", "https://h/news/x/1"), ("http://h:80/a", "http://h/a"), ("http://h:8080/a", "http://h:8080/a"), ("not a url", None), (None, None)]:
        assert one(spark, urls.canonical_url("u"), u=url) == expected
    assert one(spark, urls.article_id("u"), u="https://h/news/1234567") == "1234567"
    assert one(spark, urls.article_id("u"), u="https://h/news/not-a-number") is None


def test_text(spark):
    assert one(spark, text.clean_headline("h"), h="测试标题/麦传球 | e南洋") == "测试标题"
    assert one(spark, text.derive_category("c"), c="A > B") == "B"
    assert one(spark, text.derive_category("c"), c=None) == "Trading Strategy"
    assert one(spark, text.slugify("s"), s="Été à Köln!") == "ete-a-koln"
    assert one(spark, text.slugify_topic("s"), s="漢字") == "topic"
    assert one(spark, text.reading_minutes("t"), t="") == 1
    assert one(spark, text.parse_keywords("k"), k="[oops") == []


def test_body_to_html(spark):
    cases = {
        "one\n\ntwo": "<p>one</p><p>two</p>",
        "## A & B": "<h2>A &amp; B</h2>",
        "## H\ntext": "<p>## H<br>text</p>",
        'see <a href="x-1.html">x</a> <b>no</b> <em>y</em>': '<p>see <a href="x-1.html">x</a> &lt;b&gt;no&lt;/b&gt; <em>y</em></p>',
        None: "",
    }
    for source, expected in cases.items():
        assert one(spark, markup.body_to_html("b"), b=source) == expected


def test_markup_edits(spark):
    assert one(spark, markup.insert_card(F.col("h"), F.lit("<c>")), h='a<div class="article-grid">b') == 'a<div class="article-grid"><c>b'
    assert one(spark, markup.insert_url(F.col("h"), F.lit("<url/>")), h="<urlset></urlset>") == "<urlset><url/></urlset>"
    with pytest.raises(Exception, match="no article grid"):
        one(spark, markup.insert_card(F.col("h"), F.lit("<c>")), h="nothing")
    figure = one(spark, markup.flow_graph_html(F.lit("T"), F.array(F.lit("a"), F.lit("b"))), h=1)
    assert one(spark, markup.replace_graph_figure(F.col("h"), F.lit("<new $1>")), h="x" + figure + "y") == "x<new $1>y"
    for steps, good in (([], False), (["a"], False), (["a", "b"], True), (["a"] * 5, True), (["a"] * 6, False), (["a", " "], False)):
        assert spark.createDataFrame([(steps,)], "s array<string>").select(markup.valid_steps("s").alias("x")).first().x is good


def test_link_insertion(spark):
    links = F.array(*(F.struct(F.lit(e).alias("entity"), F.lit(s).alias("target_slug")) for e, s in (("Time Decay (Theta)", "theta"), ("decay", "decay"), ("absent", "x"))))
    out = one(spark, markup.insert_links(F.col("b"), links), b="On Time Decayed and time decay (theta) here; decay.")
    assert '<a href="theta.html">time decay (theta)</a>' in out.body
    assert out.inserted == ["Time Decay (Theta)"] and out.skipped == ["decay", "absent"]


def test_page_round_trip(spark, tmp_path):
    page = markup.article_document("https://s", F.lit("a-1"), F.lit("T <1>"), F.lit("sum"), F.lit("<h2>H</h2><p>body</p><ul><li><p>x</p></li></ul>"), F.lit("W"), F.lit("2024-05-06"))
    html = one(spark, page, k=1)
    (tmp_path / "a-1.html").write_text(html)
    (tmp_path / "bad.html").write_text("<p>no body</p>")
    (tmp_path / "other.txt").write_text("x")
    good, bad = ingest.articles_from_html(ingest.html_files(spark, str(tmp_path)))
    row = good.first()
    assert (row.slug, row.title, row.summary, row.published_at) == ("a-1", "T <1>", "sum", "2024-05-06")
    assert row.body_text == "H\n\nbody\n\nx\n\nx"
    assert [r.file for r in bad.collect()] == ["bad.html"]
    assert H.same_structure is not None


def test_pending_and_ledger(spark, tmp_path):
    pending = tmp_path / "pending"
    pending.mkdir()
    (pending / "1.json").write_text(json.dumps({"title": " A b ", "originalContent": "c"}))
    (pending / "2.json").write_text(json.dumps({"title": "x", "originalContent": " "}))
    (pending / "3.json").write_text("{oops")
    rows = {r.file: r for r in ingest.pending_imports(spark, str(pending)).collect()}
    assert (rows["1.json"].error, rows["1.json"].slug, rows["1.json"].title) == (None, "a-b", "A b")
    assert rows["2.json"].error == "originalContent is missing" and rows["3.json"].error == "malformed JSON"
    path = str(tmp_path / "ledger")
    assert ingest.ledger(spark, path).count() == 0
    ingest.append_ledger(spark, path, spark.createDataFrame([(" T ", "s", "2024-01-01")], ingest.LEDGER))
    assert ingest.ledger(spark, path).first().nanyangTitle == "T"


def test_catalog(spark):
    lines = """## S
### Sub
- **2024-01-01 — [Guess]**
  - Topic: x
  - URL: https://h/1
  - URL: https://h/2
1. **2024-01-02 -- Real**

- URL: https://h/stray
## T
| Date | Title | Topic |
|---|---|---|
| 2024-01-02 | 再 | t |
| 2024-01-03 | (placeholder) | t |
| 2024-01-04 | 新 | t |""".split("\n")
    df = spark.createDataFrame([("d", i, x) for i, x in enumerate(lines)], "doc string, n int, line string")
    found = [(r.date, r.title, r.inferred, r.url, r.section, r.source) for r in ingest.catalog_entries(df).orderBy("n").collect()]
    assert found == [("2024-01-01", "Guess", True, "https://h/1", "S > Sub", "list"), ("2024-01-02", "Real", False, None, "S > Sub", "list"), ("2024-01-04", "新", False, None, "T", "table")]


def test_catalog_is_read_once_and_lines_are_not_shuffled(spark):
    """Two documents whose lines come in any order; of one date the first entry stays, with its own URL only."""
    lines = {
        "a": ["### Lone", "- **2024-01-01 — A**", "- note", "- URL: https://h/1", "## S", "- URL: https://h/none", "- **2024-01-01 — B**", "- URL: https://h/2", "| 2024-01-05 | T | x |", "- **2024-01-05 — C**", "- URL: https://h/3"],
        "b": ["## S", "### U", "## V", "- **2024-01-01 — [D]**", "-URL: https://h/4", "- URL: https://h/5"],
    }
    rows = [(d, i, x) for d, some in lines.items() for i, x in enumerate(some)][::-1]
    made = ingest.catalog_entries(spark.createDataFrame(rows, "doc string, n int, line string"))
    found = sorted((r.doc, r.date, r.title, r.inferred, r.url, r.section, r.source) for r in made.collect())
    assert found == [("a", "2024-01-01", "A", False, "https://h/1", "Lone", "list"), ("a", "2024-01-05", "T", False, None, "S", "table"), ("b", "2024-01-01", "D", True, None, "V", "list")]
    texts = ingest.dealt(spark.createDataFrame([("d", "- **2024-01-01 — A**\n- URL: u")], "doc string, text string"), "doc", "text")
    exploded = texts.select("doc", F.posexplode(F.split("text", "\n")).alias("n", "line"))
    plan = ingest.catalog_entries(exploded)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Generate") == 1 and plan.count("Exchange") == 1


def test_store_versions(spark, tmp_path):
    kept = store.Store(spark, str(tmp_path / "store"))
    record = "slug string, filepath string, title string, summary string, body_text string, published_at string, last_updated string, status string, internal_links array<struct<target_slug:string,link_text:string>>"
    first = spark.createDataFrame([("a", "a.html", "A", "", "", None, None, "published", [("b", "to b"), ("zz", "gone")]), ("b", "b.html", "B", "", "", None, None, "published", [])], record)
    counts = store.ingest(kept, first, "now").first()
    assert (counts.inserted, counts.skipped_dangling) == (1, 1)
    second = spark.createDataFrame([("a", "a.html", "A2", "", "", None, None, "published", [])], record)
    store.ingest(kept, second, "later")
    assert {(r.slug, r.title) for r in kept.read("articles").collect()} == {("a", "A2"), ("b", "B")}
    assert kept.read("links").count() == 0 and kept.read("links", 1).count() == 1
    assert kept.rollback(1) == 3 and kept.read("links").count() == 1
    assert kept.read("meta", 2).first().value == "later"


def test_write_extraction(spark):
    entities = spark.createDataFrame([(1, "Put Warrant", "product"), (2, "Leverage", "concept"), (3, "Other", "topic")], "id long, name string, type string")
    links = spark.createDataFrame([(1, 1, 0.5), (1, 2, 0.5), (2, 3, 0.9)], "article_id long, entity_id long, relevance_score double")
    edges = spark.createDataFrame([(1, 1, "part_of", 2), (2, 2, "updates", 3)], "edge_ord long, source_entity_id long, relation string, target_entity_id long")
    found = spark.createDataFrame([(1, 0, "put warrant", "strategy", 0.8), (1, 1, "Theta", "concept", 0.4)], "article_id long, pos int, name string, type string, relevance_score double")
    found_edges = spark.createDataFrame([(1, "Theta", "part_of", "Put Warrant"), (1, "Theta", "part_of", "Put Warrant")], "article_id long, source string, relation string, target string")
    e, ae, ed = graph.write_extraction(entities, links, edges, found, found_edges)
    assert {(r.id, r.name, r.type) for r in e.collect()} == {(1, "Put Warrant", "strategy"), (2, "Leverage", "concept"), (3, "Other", "topic"), (4, "Theta", "concept")}
    assert {(r.article_id, r.entity_id) for r in ae.collect()} == {(1, 1), (1, 4), (2, 3)}
    assert {(r.source_entity_id, r.relation, r.target_entity_id) for r in ed.collect()} == {(2, "updates", 3), (4, "part_of", 1)}


def test_contracts(spark):
    def errors(check, *responses):
        df = spark.createDataFrame([(str(i), r) for i, r in enumerate(responses)], "key string, response string")
        return [r.error for r in check(df).orderBy("key").collect()]

    assert errors(contracts.review, '[{"name":"a","status":"covered"}]', '[{"name":"a","status":"odd"}]', "oops") == [None, "an item lacks its name or status", "not the expected JSON"]
    assert errors(contracts.draft, json.dumps({"title": "t", "summary": "s", "body_text": "x\n## H\ny", "graph_steps": ["a", "b"]}), json.dumps({"title": "t", "summary": "s", "body_text": "x", "graph_steps": ["a", "b"]})) == [None, "the body has no section heading"]
    sources = spark.createDataFrame([("0", {"1": "a", "2": "b"})], "key string, texts map<string,string>")
    for response, error in (('{"1":"x","2":"y"}', None), ('{"1":"x"}', "an id is missing"), ('{"1":"x","2":"y","3":"z"}', "an id is unknown"), ('{"1":" ","2":"y"}', "a text is blank")):
        df = spark.createDataFrame([("0", response)], "key string, response string")
        assert contracts.translation(df, sources).first().error == error
    asked = contracts.ask(spark.createDataFrame([("k", "p")], "key string, prompt string"), lambda p: p.upper())
    assert asked.first().response == "P"


def test_midpoint(spark):
    shapes = {"c": [("h2", 1), ("p", 300), ("h2", 1), ("p", 10), ("h2", 1), ("p", 10), ("h2", 1), ("p", 300)], "early": [("h2", 1), ("p", 50)], "none": [("p", 5)]}
    rows = [(d, i, t, n) for d, blocks in shapes.items() for i, (t, n) in enumerate(blocks)]
    found = {r.doc: r.place for r in quality.midpoint_place(spark.createDataFrame(rows, "doc string, pos int, tag string, length int")).collect()}
    assert found == {"c": 4, "early": 0, "none": None}


def test_translation_of_text_nodes(spark):
    html = '<p>One <b>two</b></p><pre>code</pre><script>no</script><figure class="graph-block x"><p>keep</p></figure>\n<div class="graph-block">five</div><p> three &amp; four</p>'
    row = spark.createDataFrame([(html,)], "html string").select(H.translatable_nodes("html").alias("n")).first()
    assert [(n.id, n.text.strip()) for n in row.n] == [("1", "One"), ("2", "two"), ("3", "code"), ("4", "five"), ("5", "three & four")]
    put = lambda texts: spark.createDataFrame([(html, texts)], "html string, t map<string,string>").select(H.apply_translations("html", "t").alias("x")).first().x
    done = put({"1": "Un", "2": "deux", "3": "code", "4": "cinq", "5": "trois & quatre"})
    assert done == html.replace("One", "Un").replace("two", "deux").replace("five", "cinq").replace("three &amp; four", "trois &amp; quatre")
    with pytest.raises(Exception, match="no translation of text node 2"):
        put({"1": "Un", "3": "code", "4": "cinq", "5": "trois"})
    same = lambda a, b: spark.createDataFrame([(a, b)], "a string, b string").select(H.same_structure(F.col("a"), F.col("b")).alias("x")).first().x
    assert same(html, done) and not same(html, html.replace("<b>", "<i>"))


def test_article_extraction_follows_the_selectors():
    page = """<nav>menu</nav><nav class="navbar"><p>bar</p></nav><article class="article-body"><div data-lang="en"><div class="article-meta"><p>By me</p></div><h2>H</h2><p>one</p>
      <div class="cta-section"><p>call</p></div><figure class="graph-block"><p>g</p></figure><footer><p>note</p></footer></div></article>
      <div class="article-related"><a href="out-1.html">outside a list</a><ul><li><a href="in-1.html"><span data-lang="en">Inside</span><span>x</span></a></li><li><a href="in-1.html">again</a></li></ul></div>"""
    record = ingest._article(page)
    assert record["body_text"] == "H\n\none\n\nnote"
    assert record["internal_links"] == [{"target_slug": "in-1", "link_text": "Inside"}]
    assert H.text_blocks(H.strip_boilerplate(H.parse("<nav><p>kept</p></nav><footer class='footer'><p>x</p></footer>"))) == ["kept"]


def test_payload_rows(spark):
    row = '{"id":1,"title":" T \\"]) ","url":"u","publishedAt":"d","category":"c","keywords":["k"]}'
    good = "self.__next_f.push([1, " + json.dumps('5:{"data":[' + row + '],"x":[1]}') + "])"
    pages = spark.createDataFrame([("<script>self.__next_f.push([1,\"oops\\q\"])</script>" + good,), (good.replace("[1, ", "[1,"),)], "html string")
    assert [(r.id, r.title) for r in ingest.payload_rows(pages, strict=True).collect()] == [(1, 'T "])')] * 2
    none = spark.createDataFrame([("<p>nothing</p>",)], "html string")
    assert ingest.payload_rows(none).count() == 0
    with pytest.raises(Exception, match="no chunk of the page holds rows"):
        ingest.payload_rows(none, strict=True).collect()


def test_fetching(spark, tmp_path):
    log = tmp_path / "log"

    def fetcher(url):
        with open(log, "a") as file:
            file.write(url + "\n")
        tries = open(log).read().split().count(url)
        if url == "slow" and tries < 3:
            raise TimeoutError("slow")
        return {"gone": 404, "broken": 500, "blocked": 429}.get(url, 200), "body"

    ask = lambda *urls: {r.url: (r.status, r.html, r.error) for r in ingest.fetch_pages(spark.createDataFrame([(u,) for u in urls], "url string"), fetcher, delay=0.01).collect()}
    assert ask("fine", "slow", "gone", "broken") == {"fine": (200, "body", None), "slow": (200, "body", None), "gone": (404, None, "HTTP 404"), "broken": (500, None, "HTTP 500")}
    seen = log.read_text().split()
    assert [seen.count(u) for u in ("fine", "slow", "gone", "broken")] == [1, 3, 1, 3]
    with pytest.raises(Exception, match="stopped by the server"):
        ask("blocked")


def test_only_slug(spark):
    rows = spark.createDataFrame([("a",), ("b",)], "slug string")
    assert ingest.only_slug(rows, "a").count() == 1
    with pytest.raises(LookupError):
        ingest.only_slug(rows, "c")


def test_insert_figure(spark):
    put = lambda html: one(spark, markup.insert_figure(F.col("h"), F.lit("<f>")), h=html)
    assert put("") == "<f>" and put("<p>only text</p>") == "<p>only text</p><f>" and put("<h2></h2>") == "<h2></h2><f>"
    assert put("<h2>Early</h2><p>" + "long " * 20 + "</p>") == "<h2>Early</h2><f><p>" + "long " * 20 + "</p>"
    assert put("<h2>a</h2>\n<p>0123456789 &amp; <b>x</b></p>\n<h2 class='y'>b</h2><p>c</p><h2>d</h2>") == "<h2>a</h2>\n<p>0123456789 &amp; <b>x</b></p>\n<h2 class='y'>b</h2><f><p>c</p><h2>d</h2>"


def test_closing_section_falls_back_to_the_first(spark):
    page = lambda name: one(spark, markup.article_document("https://s", F.lit("a"), F.lit("T"), F.lit("s"), F.lit("<p>b</p>"), F.lit("W"), F.lit("2024-05-06"), F.lit("题"), F.lit("<p>文</p>"), {"x": "<i>X</i>", "y": "<i>Y</i>"}, F.lit(name).cast("string")), k=1)
    assert "<i>Y</i>" in page("y") and "<i>X</i>" in page("unknown") and "<i>X</i>" in page(None) and '<div data-lang="zh"><p>文</p></div>' in page("y")


def test_mirror(spark, tmp_path):
    kept = store.Store(spark, str(tmp_path / "store"))
    record = "slug string, filepath string, title string, summary string, body_text string, published_at string, last_updated string, status string, internal_links array<struct<target_slug:string,link_text:string>>"
    store.ingest(kept, spark.createDataFrame([("a", "a.html", "A", "", "", None, None, "published", [])], record), "2024-01-01", str(tmp_path / "mirror"))
    assert spark.read.json(str(tmp_path / "mirror" / "articles")).first().slug == "a"
    assert spark.read.json(str(tmp_path / "mirror" / "meta")).first().article_count == 1


def test_a_page_is_parsed_once_and_pages_are_spread(spark, monkeypatch):
    calls, plain = [], ingest.H.parse
    monkeypatch.setattr(ingest.H, "parse", lambda h: (calls.append(h), plain(h))[1])
    assert ingest._article('<script type="application/ld+json">{"@type":"Article","datePublished":"2024-01-02"}</script>')["published_at"] == "2024-01-02"
    assert len(calls) == 1
    from quillgraph.plans import registry

    assert registry.queries()["page_round_trip"](spark, "/root/testdata/sf0.001").rdd.getNumPartitions() == 4 * spark.sparkContext.defaultParallelism


def test_trees_of_pages_do_not_wait_for_the_collector():
    import gc

    import pyarrow as pa

    from quillgraph.functions import html

    pages = pa.array(['<nav class="navbar"><p>x</p></nav><div><p>a<b>c</b></p><li>d</li></div>', None] * 50)
    gc.collect()
    gc.disable()
    try:
        found = list(html._of_pages(iter([pages, pages.slice(0, 0)]), lambda root: html.text_blocks(html.strip_boilerplate(root)), pa.list_(pa.string())))
        assert sum(isinstance(x, html.Node) for x in gc.get_objects()) == 0
    finally:
        gc.enable()
    assert [f.to_pylist() for f in found] == [[["ac", "d"], []] * 50, []]
