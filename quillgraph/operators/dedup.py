"""Keep-first deduplication, chunking, resuming, matching by URL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.urls import article_id, canonical_url
from ..storage import new_path, write


def keep_first(rows: DataFrame, key: str, order: str) -> DataFrame:
    """First row of each key by ``order``; null and empty keys all stay."""
    keyed = F.col(key).isNotNull() & (F.col(key) != "")
    first = rows.filter(keyed).withColumn("k", F.row_number().over(Window.partitionBy(key).orderBy(order))).filter("k = 1").drop("k")
    return first.unionByName(rows.filter(~F.coalesce(keyed, F.lit(False))))


def numbered(rows: DataFrame, name: str, *order: str) -> DataFrame:
    """``rows`` with ``name``: 1, 2, 3 ... (long) in ``order``, which is unique.

    The rows are sorted and written once; a row's number is its place in its file behind the
    rows of the files before it. So no task sees all rows, and a number stays whatever is computed again.
    """
    spark, path = rows.sparkSession, new_path(rows.sparkSession, "numbered")
    write(rows.orderBy(*order), path)
    kept = spark.read.schema(rows.schema).parquet(path).select(*(F.col(f"`{c}`") for c in rows.columns), F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    part = [F.regexp_extract("_file", p, 1).cast("int") for p in (r"part-(\d+)", r"-c(\d+)")]
    # One row for each file.
    sizes = kept.groupBy("_file").agg(F.count("*").alias("_n"))
    before = sizes.select("_file", F.coalesce(F.sum("_n").over(Window.orderBy(*part).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    return kept.join(F.broadcast(before), "_file").select(*(F.col(f"`{c}`") for c in rows.columns), (F.col("_before") + F.col("_row") + 1).cast("long").alias(name))


def ranked(rows: DataFrame, name: str, group: str, *order: Column) -> DataFrame:
    """``rows`` with ``name``: 1, 2, 3 ... within each ``group`` in an ``order`` that is unique there.

    Ranks are differences of numbers over all rows, so a group of any size is spread over tasks.
    """
    keys = [f"_o{k}" for k in range(len(order))]
    numbers = numbered(rows.withColumns(dict(zip(keys, order))), "_n", group, *keys)
    first = numbers.groupBy(group).agg(F.min("_n").alias("_first"))
    return numbers.join(first, group).select(*rows.columns, (F.col("_n") - F.col("_first") + 1).alias(name))


def chunk(rows: DataFrame, order: str, size: int) -> DataFrame:
    """``rows`` with batch and place: consecutive batches of ``size`` by a unique ``order`` (size 1 or less: one row each)."""
    size = max(size, 1)
    ordinal = F.col("_ordinal") - 1
    return numbered(rows, "_ordinal", order).select(*rows.columns, F.floor(ordinal / size).alias("batch"), (ordinal % size).alias("place"))


def resume_after(rows: DataFrame, key: str, order: str, after: str) -> DataFrame:
    """Rows behind the (first) row with ``key`` = ``after``; all rows where there is none."""
    cursor = rows.filter(F.col(key) == after).agg(F.min(order).alias("cursor"))
    return rows.crossJoin(F.broadcast(cursor)).filter(F.col("cursor").isNull() | (F.col(order) > F.col("cursor"))).drop("cursor")


def first_n(rows: DataFrame, n: int, *order: str) -> DataFrame:
    return rows.orderBy(*order).limit(n)


def two_tier_match(rows: DataFrame, known: DataFrame) -> DataFrame:
    """id, known_id, tier of rows (id, url) against known (known_id, known_url): canonical URL, else numeric article id.

    Of several known rows the one with the smallest id counts; tier is null without a match.
    """
    left = rows.select("id", canonical_url("url").alias("canonical"), article_id("url").alias("number"))
    by_url = known.select(canonical_url("known_url").alias("canonical"), "known_id").filter("canonical is not null").groupBy("canonical").agg(F.min("known_id").alias("url_match"))
    by_number = known.select(article_id("known_url").alias("number"), "known_id").filter("number is not null").groupBy("number").agg(F.min("known_id").alias("number_match"))
    joined = left.join(by_url, "canonical", "left").join(by_number, "number", "left")
    tier = F.when(F.col("url_match").isNotNull(), "canonical_url").when(F.col("number_match").isNotNull(), "article_id")
    return joined.select("id", F.coalesce("url_match", "number_match").alias("known_id"), tier.alias("tier"))
