"""The content store: upserts, link replacement, schema evolution, nested export, versions.

Plain Parquet has no MERGE. A write puts the changed tables, or the changed buckets of them, into
a directory of its own and then adds one version file; readers follow the greatest version, so
a failed write is never seen and an earlier version is the rollback.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable, Mapping

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.text import parse_keywords
from ..schema import TABLES
from .dedup import numbered


def last_of_batch(batch: DataFrame, key: str, order: str) -> DataFrame:
    """Of several records with one key the last counts."""
    columns = [c for c in batch.columns if c != key]
    return batch.groupBy(key).agg(F.max_by(F.struct(*columns), order).alias("r")).select(key, *(F.col(f"r.{c}").alias(c) for c in columns if c != order))


def upsert(table: DataFrame, batch: DataFrame, key: str, order: str, id_col: str = "id", top: DataFrame | None = None) -> DataFrame:
    """``table`` after an upsert by ``key``: known keys keep their id and take all other columns of the batch, new ones get the next ids.

    ``table`` may be the part of a table that can hold the batch's keys; then ``top`` has the greatest id of all of it.
    """
    records = last_of_batch(batch, key, order)
    others = [c for c in table.columns if c not in (id_col, key)]
    missing = [c for c in others if c not in records.columns]
    records = records.withColumns({c: F.lit(None).cast(table.schema[c].dataType) for c in missing}) if missing else records
    known = table.select(F.col(id_col), F.col(key).alias("known_key"))
    matched = records.join(known, records[key] == F.col("known_key"), "left")
    top = table.agg(F.coalesce(F.max(id_col), F.lit(0)).alias("top")) if top is None else top
    fresh = numbered(matched.filter(F.col(id_col).isNull()).drop(id_col, "known_key"), "_new", key).crossJoin(F.broadcast(top)).withColumn(id_col, (F.col("top") + F.col("_new")).cast("long"))
    written = matched.filter(F.col(id_col).isNotNull()).select(id_col, key, *others).unionByName(fresh.select(id_col, key, *others))
    untouched = table.join(records.select(F.col(key)), key, "left_anti")
    return untouched.select(table.columns).unionByName(written.select(table.columns))


def upsert_sources(table: DataFrame, batch: DataFrame, import_date: str, order: str = "ord") -> DataFrame:
    """Upsert by slug; status becomes 'imported' and import_date the given one; missing keywords become null."""
    ready = batch.withColumns({"status": F.lit("imported"), "import_date": F.lit(import_date)})
    return upsert(table, ready, "slug", order)


def upsert_meta(meta: DataFrame, batch: DataFrame, stale: str | None = None) -> DataFrame:
    """Key and value pairs after an upsert, without the stale key."""
    rest = meta.join(batch.select("key"), "key", "left_anti")
    out = rest.select("key", "value").unionByName(batch.select("key", "value"))
    return out.filter(F.col("key") != stale) if stale else out


def replace_links(links: DataFrame, articles: DataFrame, records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(links, counts) after all links of the records' sources are replaced.

    records: slug, internal_links (array of target_slug, link_text). Links to unknown slugs are
    dangling; records of unknown sources are skipped. counts: inserted, skipped_dangling.
    """
    ids = articles.select("id", "slug")
    sources = records.join(ids, "slug").select(F.col("id").alias("source_article_id"), "internal_links")
    wanted = sources.select("source_article_id", F.explode("internal_links").alias("l")).select("source_article_id", F.col("l.target_slug").alias("target_slug"), F.col("l.link_text").alias("link_text"))
    resolved = wanted.join(ids.select(F.col("id").alias("target_article_id"), F.col("slug").alias("target_slug")), "target_slug", "left")
    fresh = resolved.filter("target_article_id is not null").select("source_article_id", "target_article_id", "link_text")
    counts = resolved.agg(F.count_if(F.col("target_article_id").isNotNull()).alias("inserted"), F.count_if(F.col("target_article_id").isNull()).alias("skipped_dangling"))
    kept = links.join(sources.select("source_article_id").distinct(), "source_article_id", "left_anti")
    return kept.select("source_article_id", "target_article_id", "link_text").unionByName(fresh), counts


def dangling_links(records: DataFrame, articles: DataFrame) -> DataFrame:
    """slug, target_slug of links whose target is no article."""
    wanted = records.select("slug", F.explode("internal_links").alias("l")).select("slug", F.col("l.target_slug").alias("target_slug"))
    return wanted.join(articles.select(F.col("slug").alias("target_slug")), "target_slug", "left_anti").select("slug", "target_slug")


def backfill(table: DataFrame, updates: DataFrame, key: str, column: str) -> tuple[DataFrame, DataFrame]:
    """(table, counts by status) after one column is set where it differs: updated, unchanged or unmatched."""
    new = updates.select(F.col(key).alias("u_key"), F.col(column).alias("u_value"), F.lit(True).alias("u_known"))
    joined = table.join(new, table[key] == F.col("u_key"), "left")
    status = F.when(F.col("u_known").isNull(), "unmatched").when(F.col(column).eqNullSafe(F.col("u_value")), "unchanged").otherwise("updated")
    marked = joined.withColumn("status_of_update", status)
    value = F.when(F.col("status_of_update") == "updated", F.col("u_value")).otherwise(F.col(column))
    return marked.withColumn(column, value).select(table.columns), marked.groupBy(F.col("status_of_update").alias("status")).agg(F.count("*").alias("n"))


def add_missing_columns(table: DataFrame, ddl: str) -> DataFrame:
    """Additive schema evolution: columns of ``ddl`` that the table lacks are added as nulls."""
    want = table.sparkSession.createDataFrame([], ddl).schema
    return table.withColumns({f.name: F.lit(None).cast(f.dataType) for f in want if f.name not in table.columns})


def nested_export(articles: DataFrame, entities: DataFrame, article_entities: DataFrame, links: DataFrame) -> DataFrame:
    """One nested row per article: entities (by id) and internal_links (by target); missing references become nulls."""
    named = article_entities.join(entities.select(F.col("id").alias("entity_id"), "name", "type"), "entity_id", "left")
    mine = named.groupBy("article_id").agg(F.sort_array(F.collect_list(F.struct("entity_id", "name", "type", "relevance_score"))).alias("entities"))
    target = links.join(articles.select(F.col("id").alias("target_article_id"), F.col("slug").alias("target_slug")), "target_article_id", "left")
    out = target.groupBy(F.col("source_article_id").alias("article_id")).agg(F.sort_array(F.collect_list(F.struct("target_article_id", "target_slug", "link_text"))).alias("internal_links"))
    return articles.withColumnRenamed("id", "article_id").join(mine, "article_id", "left").join(out, "article_id", "left")


def named_edges(edges: DataFrame, entities: DataFrame) -> DataFrame:
    """edge_ord, source, relation, target by names; a missing entity gives a null name."""
    names = entities.select("id", "name")
    return (
        edges.join(names.select(F.col("id").alias("source_entity_id"), F.col("name").alias("source")), "source_entity_id", "left")
        .join(names.select(F.col("id").alias("target_entity_id"), F.col("name").alias("target")), "target_entity_id", "left")
        .select("edge_ord", "source", "relation", "target")
    )


def mirror(tables: Mapping[str, DataFrame], generated: str) -> dict[str, DataFrame]:
    """The parts of a readable copy of the whole store: meta, articles (nested), entities, edges by name, sources."""
    articles, entities, sources = tables["articles"], tables["entities"], tables["sources"]
    counts = articles.agg(F.count("*").alias("article_count")).crossJoin(sources.agg(F.count("*").alias("source_article_count")))
    return {
        "meta": counts.select(F.lit(generated).alias("generated_at"), "article_count", "source_article_count"),
        "articles": nested_export(articles, entities, tables["article_entities"], tables["links"]),
        "entities": entities,
        "edges": named_edges(tables["edges"], entities),
        "sources": export_sources(sources),
    }


def write_mirror(store: Store, path: str, generated: str) -> None:
    """One JSON folder for each part of the mirror of the store's current version."""
    tables = {name: store.read(name) for name in ("articles", "entities", "article_entities", "links", "edges")}
    parts = mirror({**tables, "sources": store.read("source_articles")}, generated)
    for name, part in parts.items():
        write_json(part, f"{path}/{name}")


def export_sources(sources: DataFrame) -> DataFrame:
    return sources.withColumn("keywords", parse_keywords("keywords"))


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


class Conflict(RuntimeError):
    """Another writer has changed what a transaction read or wrote."""


def _place(spark: SparkSession, path: str) -> tuple[object, object]:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file unless it exists; of several writers exactly one gets True.

    The text goes to a file beside it, which is then linked or renamed without overwriting, so
    nobody sees half of it.
    """
    place, files = _place(spark, path)
    if files.getScheme() == "file":
        local = place.toUri().getPath()
        os.makedirs(os.path.dirname(local), exist_ok=True)
        beside = f"{os.path.dirname(local)}/.{uuid.uuid4().hex}"
        with open(beside, "w", encoding="utf-8") as out:
            out.write(text)
        try:
            os.link(beside, local)
            return True
        except FileExistsError:
            return False
        finally:
            os.unlink(beside)
    jvm = spark._jvm
    beside = jvm.org.apache.hadoop.fs.Path(place.getParent(), f".{uuid.uuid4().hex}")
    out = files.create(beside)
    out.write(bytearray(text.encode()))
    out.close()
    none = getattr(jvm.org.apache.hadoop.fs, "Options$Rename").NONE
    options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 1)
    options[0] = none
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri(), spark._jsc.hadoopConfiguration()).rename(beside, place, options)
        return True
    except Py4JJavaError as error:
        if "FileAlreadyExists" not in str(error):
            raise
        return False


def write_text(spark: SparkSession, path: str, text: str) -> None:
    place, files = _place(spark, path)
    out = files.create(place, True)
    out.write(bytearray(text.encode()))
    out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    place, files = _place(spark, path)
    if not files.exists(place):
        return None
    stream = files.open(place)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def delete(spark: SparkSession, path: str) -> None:
    place, files = _place(spark, path)
    files.delete(place, True)


#: Name of the only part of a table that is not cut into buckets.
WHOLE = "whole"


class Transaction:
    """Changes on top of one version: staged tables, buckets of tables, and small files. Reads see what was staged."""

    def __init__(self, store: Store, version: int, state: dict):
        self.store, self.spark, self.version, self.base = store, store.spark, version, state
        self.tables, self.files = dict(state["tables"]), dict(state["files"])
        self.used: dict[str, set[str] | None] = {}  # buckets of each table that were read or written, None for all
        self.used_files: set[str] = set()

    def _use(self, table: str, buckets: set[str] | None) -> None:
        had = self.used.get(table, set())
        self.used[table] = None if had is None or buckets is None else had | buckets

    def _frame(self, table: str, buckets: set[str] | None = None) -> DataFrame:
        layout = self.tables.get(table)
        if layout is None:
            return self.spark.createDataFrame([], TABLES[table])
        schema = StructType.fromJson(layout["schema"])
        paths = [f"{self.store.root}/{p}" for b, p in sorted(layout["paths"].items()) if buckets is None or b in buckets]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def read(self, table: str) -> DataFrame:
        self._use(table, None)
        return self._frame(table)

    def write(self, table: str, df: DataFrame) -> None:
        """Replace a whole table; it is no longer cut into buckets."""
        self._use(table, None)
        place = f"{table}/{uuid.uuid4().hex}"
        df.write.parquet(f"{self.store.root}/{place}")
        self.tables[table] = {"key": None, "schema": df.schema.jsonValue(), "paths": {WHOLE: place}}

    def rewrite(self, table: str, key: str, keys: DataFrame, change: Callable[[DataFrame], DataFrame]) -> None:
        """Replace the buckets of ``table`` that hold ``keys`` (one column) by ``change`` of their rows; others keep their files.

        ``change`` may only make rows whose key lies in those buckets. A table that is not yet cut by ``key``
        is cut now, which writes all of it once.
        """
        layout = self.tables.get(table)
        bucket = F.pmod(F.xxhash64(key), F.lit(self.store.buckets))
        asked = keys.select(bucket.cast("string").alias("b")).distinct()
        touched = {r["b"] for r in asked.collect()}  # as many as there are buckets, at most
        if not touched:
            return
        cut = layout is not None and layout["key"] == [key, self.store.buckets]
        self._use(table, touched if cut else None)
        after = change(self._frame(table, touched if cut else None))
        place = f"{table}/{uuid.uuid4().hex}"
        after.withColumn("_bucket", bucket).repartition(self.store.buckets, "_bucket").write.partitionBy("_bucket").parquet(f"{self.store.root}/{place}")
        folder, files = _place(self.spark, f"{self.store.root}/{place}")
        written = [f.getPath().getName() for f in files.listStatus(folder)]
        kept = {b: p for b, p in layout["paths"].items() if b not in touched} if cut else {}
        fresh = {n.removeprefix("_bucket="): f"{place}/{n}" for n in written if n.startswith("_bucket=")}
        self.tables[table] = {"key": [key, self.store.buckets], "schema": after.schema.jsonValue(), "paths": kept | fresh}

    def upsert(self, table: str, batch: DataFrame, key: str, order: str, id_col: str = "id") -> None:
        """``upsert`` on the buckets of the batch's keys. New ids follow the greatest of the whole table, so its ids count as read."""
        self._use(table, None)
        top = self._frame(table).agg(F.coalesce(F.max(id_col), F.lit(0)).alias("top"))
        self.rewrite(table, key, batch.select(key), lambda rows: upsert(rows, batch, key, order, id_col, top))

    def commit(self, changed: dict[str, DataFrame]) -> None:
        """Stage whole tables, as ``Store.commit`` commits them; they are seen with the rest of this transaction."""
        for name, df in changed.items():
            self.write(name, df)

    def put_file(self, name: str, text: str | None) -> None:
        """Stage a small file (a page, a listing, a sitemap), or with None its deletion."""
        self.used_files.add(name)
        self.files.pop(name, None)
        if text is not None:
            place = f"_files/{uuid.uuid4().hex}"
            write_text(self.spark, f"{self.store.root}/{place}", text)
            self.files[name] = place

    def file(self, name: str) -> str | None:
        self.used_files.add(name)
        return read_text(self.spark, f"{self.store.root}/{self.files[name]}") if name in self.files else None

    def onto(self, latest: dict) -> dict:
        """The state that results on top of ``latest``; Conflict if it differs in what was used here."""
        tables, files = dict(latest["tables"]), dict(latest["files"])
        for table, buckets in self.used.items():
            old, now = (state["tables"].get(table) or {"key": None, "paths": {}} for state in (self.base, latest))
            if buckets is None:
                changed = old != now
            else:
                changed = old["key"] != now["key"] or any(old["paths"].get(b) != now["paths"].get(b) for b in buckets)
            if changed:
                raise Conflict(f"another writer has changed {table}")
            mine = self.tables.get(table)
            if mine is not None and mine != old:
                tables[table] = mine if buckets is None else {**mine, "paths": {b: p for b, p in now["paths"].items() if b not in buckets} | {b: p for b, p in mine["paths"].items() if b in buckets}}
        for name in self.used_files:
            if self.base["files"].get(name) != latest["files"].get(name):
                raise Conflict(f"another writer has changed the file {name}")
            files.pop(name, None)
            if name in self.files:
                files[name] = self.files[name]
        return {"tables": tables, "files": files}


class Store:
    """Versioned tables and small files below a root directory that any Spark file system may hold.

    A version is one file that names the parts of all tables. A transaction stages what it
    changes in new directories and then puts the next version's file if it is absent, so a
    failed write is never seen and of two writers one comes second: what it used is compared
    with what came between, and where that differs it is done again. Tables may be cut into
    ``buckets`` by a hash of their key (fix the number by the size that the table will have);
    then an upsert writes only the buckets of its keys.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets

    def _path(self, version: int) -> str:
        return f"{self.root}/_versions/{version:012d}.json"

    @property
    def version(self) -> int:
        folder, files = _place(self.spark, f"{self.root}/_versions")
        if not files.exists(folder):
            return 0
        names = [f.getPath().getName() for f in files.listStatus(folder)]
        return max((int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith(".")), default=0)

    def _state(self, version: int) -> dict:
        return json.loads(read_text(self.spark, self._path(version)) or "null") or {"tables": {}, "files": {}}

    def begin(self, version: int | None = None) -> Transaction:
        version = self.version if version is None else version
        return Transaction(self, version, self._state(version))

    def read(self, table: str, version: int | None = None) -> DataFrame:
        return self.begin(version).read(table)

    def file(self, name: str, version: int | None = None) -> str | None:
        return self.begin(version).file(name)

    def _put(self, tx: Transaction) -> int:
        while True:
            latest = self.version
            state = tx.onto(self._state(latest))
            if put_if_absent(self.spark, self._path(latest + 1), json.dumps(state)):
                return latest + 1

    def transact(self, change: Callable[[Transaction], object], attempts: int = 10) -> int:
        """Apply ``change`` to the current version and commit it; done again where another writer was faster."""
        for left in range(attempts, 0, -1):
            tx = self.begin()
            change(tx)
            try:
                return self._put(tx)
            except Conflict:
                if left == 1:
                    raise
        raise ValueError("attempts must be positive")

    def commit(self, changed: dict[str, DataFrame]) -> int:
        """Replace whole tables; the frames were made from the version that is current now."""
        tx = self.begin()
        for name, df in changed.items():
            tx.write(name, df)
        return self._put(tx)

    def rollback(self, version: int) -> int:
        """Make an earlier version, with its files, current again as a new version."""
        state = self._state(version)
        while True:
            latest = self.version
            if put_if_absent(self.spark, self._path(latest + 1), json.dumps(state)):
                return latest + 1

    def export_files(self, site: str) -> list[str]:
        """Bring the files below ``site`` to the current version: changed ones are written, gone ones deleted; returns their names."""
        marker = f"{site.rstrip('/')}/.exported.json"
        before, now = json.loads(read_text(self.spark, marker) or "{}"), self._state(self.version)["files"]
        changed = sorted(n for n in before.keys() | now.keys() if before.get(n) != now.get(n))
        for name in changed:
            target = f"{site.rstrip('/')}/{name}"
            if name in now:
                write_text(self.spark, target, read_text(self.spark, f"{self.root}/{now[name]}") or "")
            else:
                delete(self.spark, target)
        write_text(self.spark, marker, json.dumps(now))
        return changed


def ingest(store: Store, records: DataFrame, extracted: str, mirror_path: str | None = None) -> DataFrame:
    """Articles, links and meta of one run, committed together; returns link counts. records as ``articles_from_html`` gives them.

    Only buckets of the records' slugs and of their links' sources are written. With ``mirror_path`` the
    readable copy is written anew behind the commit.
    """
    flat = records.withColumn("ord", F.col("slug")).drop("internal_links")
    seen = {}

    def change(tx: Transaction) -> None:
        tx.upsert("articles", flat, "slug", "ord")
        articles = tx.read("articles")
        sources = records.select("slug").join(articles.select(F.col("id").alias("source_article_id"), "slug"), "slug").select("source_article_id")
        seen["counts"] = replace_links(tx._frame("links"), articles, records)[1]
        tx.rewrite("links", "source_article_id", sources, lambda rows: replace_links(rows, articles, records)[0])
        stamp = store.spark.createDataFrame([("lastExtracted", extracted)], "key string, value string")
        tx.write("meta", upsert_meta(tx.read("meta"), stamp, stale="note"))

    store.transact(change)
    if mirror_path:
        write_mirror(store, mirror_path, extracted)
    return seen["counts"]
