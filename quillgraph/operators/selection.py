"""Topic selection and cadence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import round_half_up

INFERRED_PENALTY = 0.8
#: Why nothing was selected.
EMPTY, USED, COVERED = "the catalog is empty", "every entry has been published", "every open entry duplicates an article"


def not_in_ledger(catalog: DataFrame, ledger: DataFrame, title: str = "title", published: str = "nanyangTitle") -> DataFrame:
    """Catalog entries whose title, without regard to case and outer blanks, is not in the ledger."""
    done = ledger.select(F.lower(F.trim(published)).alias("done")).distinct()
    return catalog.join(done, F.lower(F.trim(title)) == F.col("done"), "left_anti")


def gap_scores(catalog: DataFrame, matches: DataFrame, duplicates: DataFrame) -> DataFrame:
    """``catalog`` (topic_id, title, date, inferred) with gap and has_high.

    gap = 1 - the greatest title similarity or entity overlap, times 0.8 for inferred titles, 3 digits.
    """
    a = matches.groupBy(F.col("candidate_id").alias("topic_id")).agg(F.max("title_similarity").alias("t"), F.bool_or((F.col("slug_similarity") >= 1) | (F.col("title_similarity") >= 0.6)).alias("strong"))
    b = duplicates.groupBy("topic_id").agg(F.max("overlap_ratio").alias("o"), F.bool_or(F.col("level") == "high").alias("high"))
    zero = F.lit(0.0)
    gap = round_half_up(1 - F.greatest(F.coalesce("t", zero), F.coalesce("o", zero)), 3)
    scored = catalog.join(a, "topic_id", "left").join(b, "topic_id", "left")
    penalised = F.when(F.col("inferred"), round_half_up(gap * INFERRED_PENALTY, 3)).otherwise(gap)
    high = F.coalesce("strong", F.lit(False)) | F.coalesce("high", F.lit(False))
    return scored.select(*catalog.columns, penalised.alias("gap"), high.alias("has_high"))


def select_topic(scored: DataFrame) -> DataFrame:
    """The best entry that duplicates nothing: greatest gap, then latest date, then smallest id; at most one row."""
    return scored.filter(~F.col("has_high")).orderBy(F.col("gap").desc(), F.col("date").desc(), F.col("topic_id")).limit(1)


def no_topic_reason(catalog: DataFrame, open_entries: DataFrame, scored: DataFrame) -> str | None:
    """Why nothing was selected, or None."""
    if catalog.isEmpty():
        return EMPTY
    if open_entries.isEmpty():
        return USED
    return COVERED if scored.filter(~F.col("has_high")).isEmpty() else None


def selection(catalog: DataFrame, open_entries: DataFrame, scored: DataFrame) -> DataFrame:
    """One row: topic_id, title, date, gap of the entry that is selected, or nulls and the reason why there is none."""
    best = scored.filter(~F.col("has_high")).agg(F.max_by(F.struct("topic_id", "title", "date", "gap"), F.struct("gap", "date", -F.col("topic_id"))).alias("best"))
    counted = catalog.agg(F.count("*").alias("n")).crossJoin(open_entries.agg(F.count("*").alias("n_open"))).crossJoin(best)
    reason = F.when(F.col("n") == 0, EMPTY).when(F.col("n_open") == 0, USED).when(F.col("best").isNull(), COVERED)
    return counted.select(F.when(reason.isNull(), F.col("best")).alias("best"), reason.alias("reason")).select("best.*", "reason")


def cadence_due(history: DataFrame, now: Column, target_days: Column, key: str = "key", at: str = "at") -> DataFrame:
    """key, last, days (one digit), due: whether ``target_days`` have passed since the latest entry.

    ``target_days`` is injected (uniform in 14 to 21 in use), so results repeat.
    """
    last = history.groupBy(key).agg(F.max(at).alias("last"))
    days = (F.unix_micros(now) - F.unix_micros(F.col("last"))) / F.lit(86_400_000_000.0)
    return last.select(key, "last", round_half_up(days, 1).alias("days"), (days >= target_days).alias("due"))
