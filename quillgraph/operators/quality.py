"""Quality gates: coverage buckets, outcome counts, structural checks, id sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FAILURES = ["error", "regression"]


def coverage_buckets(items: DataFrame, key: str) -> DataFrame:
    """key, covered, partial, missing (counts), all_covered of reviewed items (status)."""
    count = lambda s: F.count_if(F.col("status") == s).alias(s)
    return items.groupBy(key).agg(count("covered"), count("partial"), count("missing"), F.bool_and(F.col("status") == "covered").alias("all_covered"))


def outcome_counts(rows: DataFrame, status: str = "status") -> DataFrame:
    return rows.groupBy(F.col(status).alias("status")).agg(F.count("*").alias("n"))


def has_failures(counts: DataFrame) -> bool:
    return not counts.filter(F.col("status").isin(FAILURES) & (F.col("n") > 0)).isEmpty()


def id_difference(expected: DataFrame, got: DataFrame, key: str = "id") -> DataFrame:
    """id, side of ids that are missing from ``got`` or are extra in it."""
    missing = expected.select(key).join(got.select(key), key, "left_anti").distinct().withColumn("side", F.lit("missing"))
    extra = got.select(key).join(expected.select(key), key, "left_anti").distinct().withColumn("side", F.lit("extra"))
    return missing.unionByName(extra)


def repeated_keys(rows: DataFrame, key: str) -> DataFrame:
    return rows.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1")


def regression_items(dropped: DataFrame, altered: DataFrame) -> DataFrame:
    """Dropped and altered items together."""
    return dropped.unionByName(altered)


def format_items(items: Column, empty: str = "(none)") -> Column:
    """Lines '- name (type): why' of an array of structs, or the fallback."""
    line = lambda i: F.concat(F.lit("- "), i["name"], F.lit(" ("), i["type"], F.lit("): "), i["why"])
    return F.when(F.size(items) > 0, F.array_join(F.transform(items, line), "\n")).otherwise(F.lit(empty))


def format_state(entities: Column, edges: Column) -> Column:
    """Lines of a graph state, arrays of (name, type) and of (source, relation, target); '(empty)' for none."""
    named = F.transform(F.coalesce(entities, F.array().cast("array<struct<name:string,type:string>>")), lambda e: F.concat(F.lit('- entity: "'), e["name"], F.lit('" (type: '), e["type"], F.lit(")")))
    none = F.array().cast("array<struct<source:string,relation:string,target:string>>")
    drawn = F.transform(F.coalesce(edges, none), lambda e: F.concat(F.lit('- edge: "'), e["source"], F.lit('" --['), e["relation"], F.lit(']--> "'), e["target"], F.lit('"')))
    lines = F.concat(named, drawn)
    return F.when(F.size(lines) > 0, F.array_join(lines, "\n")).otherwise(F.lit("(empty)"))


def midpoint_place(blocks: DataFrame, doc: str = "doc") -> DataFrame:
    """doc, place: the block (doc, pos, tag, length) behind which a figure goes.

    The first h2 that starts at or behind half of the text, else the last h2; null (the end)
    without an h2 or without text.
    """
    from pyspark.sql import Window

    w = Window.partitionBy(doc).orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    placed = blocks.withColumn("before", F.coalesce(F.sum("length").over(w), F.lit(0))).withColumn("total", F.sum("length").over(Window.partitionBy(doc)))
    h2 = F.col("tag") == "h2"
    first = F.min(F.when(h2 & (F.col("before") * 2 >= F.col("total")), F.col("pos")))
    last = F.max(F.when(h2, F.col("pos")))
    return placed.groupBy(doc).agg(F.when(F.max("total") > 0, F.coalesce(first, last)).alias("place"))
