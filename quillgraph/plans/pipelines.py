"""Composed flows: scraping rows into the store, writing with review, publishing behind gates.

Models and fetchers are injected; each gate is a column or an aggregate, and only verdicts of
single articles come to the driver.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from ..functions import html as H
from ..functions import markup as M
from ..functions import text as T
from ..functions.urls import canonical_url, source_slug
from ..operators import contracts, extraction, graph, prompts, quality, retrieval, store
from ..operators.containment import found_in
from ..operators.dedup import numbered
from ..sources.ingest import ld_json_items, news_articles
from ..storage import stored

TARGET_WORDS = 2200


def scrape_outcomes(rows: DataFrame, fetched: DataFrame, known: DataFrame, dry_run: bool = False) -> DataFrame:
    """url, slug, status, title, original_content of index rows (url, title) after their pages were fetched.

    fetched: url, status (HTTP), html and, as ``fetch_paced`` gives it, outcome. known: slug, original_url; a row
    whose canonical URL is known keeps that slug. status: stopped, fetch-error, parse-error (a page whose JSON-LD
    is broken and gives no article), no-article-body, error (no URL to store it under), and else ok or, with ``dry_run``, dry-run.
    """
    halted = F.col("outcome") == "stopped" if "outcome" in fetched.columns else F.lit(False)
    broken = F.exists(ld_json_items(F.col("html")), lambda t: F.try_parse_json(t).isNull())
    pages = fetched.select("url", F.col("status").alias("http"), "html", halted.alias("halted"), broken.alias("broken"))
    articles = news_articles(pages.filter("http = 200"), "url")
    slugs = known.select(canonical_url("original_url").alias("canonical"), "slug").filter("canonical is not null").groupBy("canonical").agg(F.min("slug").alias("known_slug"))
    joined = rows.join(pages, "url", "left").join(articles, "url", "left").withColumn("canonical", canonical_url("url")).join(slugs, "canonical", "left")
    empty = F.coalesce(F.trim("body"), F.lit("")) == ""
    status = (
        F.when(F.coalesce("halted", F.lit(False)), "stopped")
        .when(F.col("url").isNull(), "error")
        .when(F.coalesce("http", F.lit(0)) != 200, "fetch-error")
        .when(empty & F.coalesce("broken", F.lit(False)) & F.col("body").isNull(), "parse-error")
        .when(empty, "no-article-body")
        .otherwise("dry-run" if dry_run else "ok")
    )
    title = F.coalesce(T.clean_headline("headline"), F.col("title"))
    slug = F.coalesce("known_slug", source_slug(T.slugify(title), "url"))
    return joined.select("url", slug.alias("slug"), status.alias("status"), title.alias("title"), F.col("body").alias("original_content"))


def write_with_review(
    topics: DataFrame, checklists: DataFrame, writer: Callable[[str], str], reviewer: Callable[[str], str], target: int = TARGET_WORDS, facts: DataFrame | None = None, links: DataFrame | None = None
) -> DataFrame:
    """key, draft (struct), covered, open, off_topic, words, repaired, body (with links), inserted, skipped, error: one draft per topic (key, topic).

    checklists: key, name, type, why and, where sections off the topic are to be found, relation; ``facts``
    (key, facts) join them. A draft is reviewed, and repaired at most once, if an item is not covered, a section
    is off the topic or it is too short. A draft that breaks its contract gives an ``error``, as does a review,
    whose draft is kept. links: key, links (array of entity, target_slug), put into the final body.
    """
    if "relation" not in checklists.columns:
        checklists = checklists.withColumn("relation", F.lit(None).cast("string"))
    if facts is not None:
        checklists = retrieval.full_checklist(checklists, facts)
    items = checklists.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("name", "type", "why", "relation"))).alias("items"))
    none = F.expr("cast(array() as array<struct<name:string,type:string,why:string,relation:string>>)")
    empty = F.array().cast("array<string>")
    asked = topics.join(items, "key", "left").withColumn("items", F.coalesce("items", none))
    must = facts.select("key", "facts") if facts is not None else topics.select("key", empty.alias("facts"))
    asked = asked.join(must, "key", "left").withColumn("facts", F.coalesce("facts", empty))

    def drafted(prompted: DataFrame) -> DataFrame:
        checked = contracts.draft(contracts.ask(prompted.select("key", "prompt"), writer))
        return checked.select("key", F.col("value").alias("draft"), F.col("error").alias("draft_error"))

    def reviewed(drafts: DataFrame) -> DataFrame:
        prompted = drafts.select("key", prompts.review_prompt(F.col("items"), F.col("draft.body_text")).alias("prompt"))
        found = contracts.review(contracts.ask(prompted, reviewer)).select("key", F.col("value").alias("review"), F.col("error").alias("review_error"))
        bodies = drafts.select(F.col("key").alias("doc"), F.col("draft.body_text").alias("body"))
        contrast = drafts.select(F.col("key").alias("doc"), F.posexplode("items").alias("item_ord", "i")).select("doc", "item_ord", "i.name", "i.relation")
        off = retrieval.off_topic_headings(bodies, contrast).groupBy(F.col("doc").alias("key")).agg(F.sort_array(F.collect_list("heading")).alias("off_topic"))
        return drafts.join(found, "key").join(off, "key", "left").withColumn("off_topic", F.coalesce("off_topic", empty))

    first = drafted(asked.withColumn("prompt", prompts.writer_prompt(F.col("topic"), F.col("items"), F.col("facts"), empty, empty)))
    rated = reviewed(asked.join(first, "key"))
    words = T.count_body_words("draft.body_text")
    open_names = F.coalesce(F.transform(F.filter("review", lambda r: r["status"] != "covered"), lambda r: r["name"]), empty)
    open_items = F.filter("items", lambda i: F.array_contains(open_names, i["name"]))
    gaps = (F.size("items") > 0) & ((F.size(open_items) > 0) | (F.size("off_topic") > 0))
    needs = F.col("draft_error").isNull() & F.col("review_error").isNull() & (gaps | (words < target))
    marked = rated.withColumn("needs", needs)
    again = drafted(marked.filter("needs").withColumn("prompt", prompts.repair_prompt(F.col("topic"), F.col("draft.body_text"), open_items, F.col("off_topic"), words, target)))
    repaired = reviewed(asked.join(again.filter("draft_error is null"), "key"))
    columns = ["key", "draft", "draft_error", "review", "review_error", "off_topic"]
    kept = marked.join(repaired.select("key"), "key", "left_anti").select(*columns, F.lit(False).alias("repaired"))
    both = kept.unionByName(repaired.select(*columns, F.lit(True).alias("repaired")))
    wanted = F.expr("cast(array() as array<struct<entity:string,target_slug:string>>)")
    both = both.join(links.select("key", "links"), "key", "left").withColumn("links", F.coalesce("links", wanted)) if links is not None else both.withColumn("links", wanted)
    both = both.withColumn("linked", M.insert_links(F.col("draft.body_text"), F.col("links")))
    named = lambda status: F.transform(F.filter("review", lambda r: r["status"] == status), lambda r: r["name"])
    return both.select(
        "key",
        "draft",
        F.forall("review", lambda r: r["status"] == "covered").alias("covered"),
        F.coalesce(named("missing"), empty).alias("missing"),
        "off_topic",
        T.count_body_words("draft.body_text").alias("words"),
        "repaired",
        "linked.body",
        "linked.inserted",
        "linked.skipped",
        F.coalesce("draft_error", "review_error").alias("error"),
    )


EXTRACTIONS = "array<struct<slug:string,entities:array<struct<name:string,type:string,relevance_score:string>>,edges:array<struct<source:string,relation:string,target:string>>>>"


def extract_batches(tables: dict[str, DataFrame], articles: DataFrame, extractor: Callable[[str], str], dry_run: bool = False, skip_checker: bool = False) -> tuple[dict[str, DataFrame], DataFrame, DataFrame]:
    """(tables, outcomes, totals) after extraction of articles (batch, id, slug, title, body_text), one response a batch.

    tables: entities, article_entities, edges. A prompt lists the known entities that the batch's texts name.
    A response that is no JSON, repeats a slug or lacks one fails its whole batch; an article without an id fails
    alone; others are written as if one after another, by (batch, slug). outcomes: batch, slug, status (ok,
    regression, error, dry-run, or written-unchecked with ``skip_checker``), error, dropped, altered, against the
    state before the batch. totals: batch, n_entities, n_edges as extracted.
    """
    entities, links, edges = (tables[k] for k in ("entities", "article_entities", "edges"))
    articles = articles.withColumn("batch_no", F.col("batch").cast("long")).withColumn("batch", F.col("batch").cast("string"))
    names = entities.select("name", F.lower("name").alias("pattern"))
    texts = articles.select("batch", F.monotonically_increasing_id().alias("id"), F.lower(F.concat_ws("\n", "title", "body_text")).alias("text"))
    texts = stored(texts, "texts")
    known = found_in(texts, names.select("pattern")).join(texts.select("id", "batch"), "id").join(names, "pattern").groupBy("batch").agg(F.sort_array(F.collect_set("name")).alias("known"))
    nothing_known = F.array().cast("array<string>")
    one = prompts.extract_prompt(F.col("title"), F.col("body_text"), nothing_known)
    asked = articles.groupBy("batch").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("slug", one.alias("p")))), lambda a: F.concat(F.lit("## "), a["slug"], F.lit("\n"), a["p"])), "\n\n").alias("body"))
    asked = asked.join(known, "batch", "left").select(F.col("batch").alias("key"), F.concat("body", F.lit("\n\n# known names\n"), F.array_join(F.coalesce("known", nothing_known), ", ")).alias("prompt"))
    answers = contracts.ask(asked, extractor).select(F.col("key").alias("batch"), "failure", F.from_json("response", EXTRACTIONS).alias("value"))
    blocks = answers.filter("value is not null").select("batch", F.explode("value").alias("x")).select("batch", "x.slug", "x.entities", "x.edges")
    wanted = articles.select("batch", "batch_no", F.col("id").alias("article_id"), "slug")
    broken = contracts.batch_extraction(blocks, wanted.join(answers.filter("value is not null").select("batch"), "batch"))
    broken = broken.unionByName(answers.filter("value is null").select("batch", F.coalesce("failure", F.lit("not the expected JSON")).alias("error")))
    read = stored(blocks.join(wanted, ["batch", "slug"]).join(broken.select("batch"), "batch", "left_anti"), "extracted")
    totals = read.groupBy("batch").agg(F.sum(F.size("entities")).alias("n_entities"), F.sum(F.size("edges")).alias("n_edges"))
    zero, nothing = F.lit(0).cast("long"), F.lit(None).cast("string")
    alone = read.filter("article_id is null").select("batch", "slug", F.lit("the article has no id").alias("error"))
    errors = wanted.join(broken, "batch").select("batch", "slug", "error").unionByName(alone)
    errors = errors.select("batch", "slug", F.lit("error").alias("status"), "error", zero.alias("dropped"), zero.alias("altered"))
    good = read.filter("article_id is not null")
    if dry_run:
        return tables, errors.unionByName(good.select("batch", "slug", F.lit("dry-run").alias("status"), nothing.alias("error"), zero.alias("dropped"), zero.alias("altered"))), totals

    good = numbered(good, "seq", "batch_no", "batch", "slug", "article_id")
    named = good.select(F.col("seq").alias("doc"), F.posexplode("entities").alias("pos", "e")).select("doc", "pos", "e.name", "e.type", F.col("e.relevance_score").alias("relevance"))
    drawn = good.select(F.col("seq").alias("doc"), F.posexplode("edges").alias("pos", "e")).select("doc", "pos", "e.source", "e.relation", "e.target")
    found, found_edges = graph.dedupe_extraction(named, drawn)
    runs = good.select("seq", "batch", "article_id")
    after = extraction.fold_extractions(entities, links, edges, runs, found.withColumnRenamed("doc", "seq"), found_edges.withColumnRenamed("doc", "seq").withColumn("pos", F.lit(0)))
    judged = good.select("seq", "slug").join(after.pop("checks"), "seq")
    status = F.lit("written-unchecked") if skip_checker else F.when((F.col("dropped") > 0) | (F.col("altered") > 0), "regression").otherwise("ok")
    counts = [zero.alias(c) if skip_checker else F.col(c) for c in ("dropped", "altered")]
    return {**tables, **after}, errors.unionByName(judged.select("batch", "slug", status.alias("status"), nothing.alias("error"), *counts)), totals


def extract_rounds(tables: dict[str, DataFrame], articles: DataFrame, extractor: Callable[[str], str], dry_run: bool = False, skip_checker: bool = False) -> tuple[dict[str, DataFrame], DataFrame, DataFrame]:
    """``extract_batches`` for articles with a ``round``: a round's prompts list what all earlier rounds have found.

    With one batch a round every batch sees all before it, as if they ran one after another; batches that
    share a round run at the same time. Rounds follow their numbers; each one's tables are written.
    """
    outcomes, totals = [], []
    for number in sorted(r["round"] for r in articles.select("round").distinct().collect()):
        tables, outcome, total = extract_batches(tables, articles.filter(F.col("round") == number).drop("round"), extractor, dry_run, skip_checker)
        tables = {name: stored(frame, name) for name, frame in tables.items()}
        outcomes.append(stored(outcome, "outcomes"))
        totals.append(total)
    if not outcomes:
        return extract_batches(tables, articles.drop("round"), extractor, dry_run, skip_checker)
    return tables, reduce(DataFrame.unionByName, outcomes), reduce(DataFrame.unionByName, totals)


def seo_metadata(drafts: DataFrame, model: Callable[[str], str]) -> DataFrame:
    """key, metadata, error: search metadata of each draft (key, title, body_text) that keeps its contract, or why there is none."""
    asked = drafts.select("key", prompts.seo_prompt(F.col("title"), F.col("body_text")).alias("prompt"))
    checked = contracts.seo(contracts.ask(asked, model))
    return checked.select("key", F.when(F.col("error").isNull(), F.col("value")).alias("metadata"), "error")


def translate_bodies(bodies: DataFrame, model: Callable[[str], str], language: str) -> DataFrame:
    """key, html, error: bodies (key, html) with every text node translated, markup untouched; a null html where a contract is broken.

    One request a body; a body without text needs none. Graph figures, scripts and styles keep their text.
    """
    nodes = F.map_from_entries(F.transform(H.translatable_nodes("html"), lambda n: F.struct(n["id"], n["text"])))
    read = stored(bodies.select(F.col("key").cast("string").alias("key"), "html", nodes.alias("texts")), "texts")
    some = read.filter(F.size("texts") > 0)
    answers = contracts.translation(contracts.ask(some.select("key", prompts.translate_prompt(F.col("texts"), language).alias("prompt")), model), some.select("key", "texts"))
    told = read.join(answers.select("key", "value", "error"), "key", "left")
    good = F.col("error").isNull() & F.col("value").isNotNull()
    put_back = H.apply_translations(F.when(good, F.col("html")), F.when(good, F.col("value")))
    return told.select("key", F.when(F.coalesce(F.size("texts"), F.lit(0)) <= 0, F.col("html")).otherwise(put_back).alias("html"), "error")


def coverage_verdict(review: DataFrame, key: str = "key") -> DataFrame:
    return quality.coverage_buckets(review, key)


def assemble(drafts: DataFrame, site: str, author: str, published: str) -> DataFrame:
    """slug, html, card, sitemap_url of drafts (key, draft): the documents that publishing writes."""
    title, summary, body = F.col("draft.title"), F.col("draft.summary"), F.col("draft.body_text")
    slug = T.slugify(title)
    day = F.lit(published)
    html = M.article_document(site, slug, title, summary, M.body_to_html(body), F.lit(author), day)
    return drafts.select(
        "key",
        slug.alias("slug"),
        html.alias("html"),
        M.article_card(slug, title, summary, T.derive_category(F.lit(None).cast("string")), day, T.reading_minutes(body)).alias("card"),
        M.sitemap_url(F.concat(F.lit(f"{site}/"), slug, F.lit(".html")), day).alias("sitemap_url"),
    )


def publish_gate(due: bool, topic: str | None, slug_taken: bool, duplicate: str, draft: Row | None) -> str:
    """Status of one publishing run up to its draft: the first gate that closes, or ok."""
    if not due:
        return "not-due"
    if topic is None:
        return "no-topic"
    if slug_taken:
        return "slug-collision"
    if duplicate == "high":
        return "duplicate-risk-high"
    if draft is None or draft["error"] is not None:
        return "coverage-review-failed"
    return "coverage-gap" if draft["missing"] else "ok"


class GateClosed(Exception):
    """A gate of a publishing run that closed: its status and why."""

    def __init__(self, status: str, reason: str):
        super().__init__(reason)
        self.status, self.reason = status, reason


def publish_article(kept: store.Store, article: DataFrame, translate: Callable[[DataFrame], DataFrame], extract: Callable[[store.Transaction], None], files: Callable[[store.Transaction, DataFrame], dict[str, str]] | None = None) -> Row:
    """Row(status, reason, version) of an article's publication: translation, store, graph and files in one commit.

    status: ok, translation-failed or graph-extraction-failed, with the error's text. ``translate``
    gives the row to be stored; ``files`` the page, listing and sitemap by name, seen together with
    it; ``extract`` changes the graph in the same transaction. Nothing is visible before all of it
    is committed, so a failure leaves tables and files as they were. Errors of the commit itself are raised.
    """

    def change(tx: store.Transaction) -> None:
        try:
            translated = stored(translate(article), "translated")
        except Exception as error:
            raise GateClosed("translation-failed", f"{type(error).__name__}: {error}") from error
        tx.upsert("articles", translated.withColumn("ord", F.col("slug")), "slug", "ord")
        for name, text in (files(tx, translated) if files else {}).items():
            tx.put_file(name, text)
        try:
            extract(tx)
        except Exception as error:
            raise GateClosed("graph-extraction-failed", f"{type(error).__name__}: {error}") from error

    try:
        return Row(status="ok", reason=None, version=kept.transact(change))
    except GateClosed as closed:
        return Row(status=closed.status, reason=closed.reason, version=kept.version)


def publish(kept: store.Store, article: DataFrame, translate: Callable[[DataFrame], DataFrame], extract: Callable[[store.Transaction], None]) -> str:
    """The status of ``publish_article`` without files."""
    return publish_article(kept, article, translate, extract)["status"]


def site_files(tx: store.Transaction, document: Row, listing: str = "articles.html", sitemap: str = "sitemap.xml") -> dict[str, str]:
    """The files that publishing one assembled document (slug, html, card, sitemap_url) changes.

    The card goes to the head of the listing's grid and the URL to the end of the sitemap; a
    missing listing or sitemap, or one without its frame, is an error.
    """
    changed = {f"articles/{document['slug']}.html": document["html"]}
    for name, part in ((listing, document["card"]), (sitemap, document["sitemap_url"])):
        text = tx.file(name)
        if text is None:
            raise LookupError(f"{name} is not among the store's files")
        edit = M.insert_card if name == listing else M.insert_url
        changed[name] = tx.spark.createDataFrame([(text, part)], "text string, part string").select(edit(F.col("text"), F.col("part"))).first()[0]
    return changed


def publishing_run(
    kept: store.Store, candidates: DataFrame, checklists: DataFrame, writer: Callable[[str], str], reviewer: Callable[[str], str], translate: Callable[[DataFrame], DataFrame],
    extract: Callable[[store.Transaction], None], site: str, author: str, published: str, due: bool = True, force: bool = False, target: int = TARGET_WORDS,
) -> Row:
    """Row(status, reason, slug, version) of one whole run, one of the nine statuses; only ``ok`` changes the store.

    candidates: key, topic, gap of selectable topics (the best one is taken; none closes the run).
    The gates are: due, topic, slug, duplicate risk, review of the draft, open items, translation, extraction.
    """
    chosen = None if not (due or force) else candidates.orderBy(F.desc("gap"), "key").select("key", "topic", T.slugify_topic("topic").alias("slug")).first()
    slug = chosen["slug"] if chosen else None
    taken, duplicate, draft = False, "none", None
    if chosen:
        articles = kept.read("articles")
        taken = not articles.filter(F.col("slug") == slug).isEmpty()
        asked = kept.spark.createDataFrame([(1, chosen["topic"], slug)], "candidate_id long, candidate_title string, candidate_slug string")
        duplicate = "none" if taken else duplicate_verdict(asked, articles).first()["verdict"]
    status = publish_gate(due or force, chosen and chosen["topic"], taken, duplicate, Row(error=None, missing=[]))
    if status != "ok":
        return Row(status=status, reason=None, slug=slug, version=kept.version)
    topic = kept.spark.createDataFrame([(chosen["key"], chosen["topic"])], "key string, topic string")
    drafts = stored(write_with_review(topic, checklists.filter(F.col("key") == chosen["key"]), writer, reviewer, target), "drafts")
    draft = drafts.first()
    status = publish_gate(True, chosen["topic"], False, duplicate, draft)
    if status != "ok":
        reason = draft["error"] if status == "coverage-review-failed" else ", ".join(draft["missing"])
        return Row(status=status, reason=reason, slug=slug, version=kept.version)
    document = assemble(drafts.select("key", "draft"), site, author, published).first()
    row = drafts.select(F.lit(document["slug"]).alias("slug"), F.lit(f"articles/{document['slug']}.html").alias("filepath"), "draft.title", "draft.summary", F.col("body").alias("body_text"), F.lit(published).alias("published_at"), F.lit(published).alias("last_updated"), F.lit("published").alias("status"))
    done = publish_article(kept, row, translate, extract, lambda tx, _: site_files(tx, document))
    return Row(status=done["status"], reason=done["reason"], slug=document["slug"], version=done["version"])


def duplicate_verdict(candidates: DataFrame, articles: DataFrame) -> DataFrame:
    """candidate_id, verdict from titles and slugs alone, for a last check before publishing."""
    matches = retrieval.title_slug_similarity(articles, candidates)
    none = matches.sparkSession.createDataFrame([], "topic_id long, level string")
    return retrieval.duplicate_risk(candidates, matches, none)
