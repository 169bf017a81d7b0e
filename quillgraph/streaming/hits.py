"""An extension: the per-page hit counter as a structured stream, and upserts per micro-batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def distinct_hits(events: DataFrame, delay: str = "1 day") -> DataFrame:
    """events (ts, user_id, event_type): one hit per user and type within the watermark's delay.

    State is bounded by the watermark; on a batch frame it is a plain deduplication.
    """
    marked = events.withWatermark("ts", delay)
    return marked.dropDuplicatesWithinWatermark(["user_id", "event_type"]) if events.isStreaming else marked.dropDuplicates(["user_id", "event_type"])


def session_hits(loads: DataFrame, gap: str = "30 minutes", delay: str = "1 hour") -> DataFrame:
    """session_start, session_end, user_id, page: one hit per session and page; loads (ts, user_id, page).

    A session is a user's loads of any pages without a pause of ``gap``. Its first load of a page hits,
    later ones only read the counter. The same expression serves batches and streams. In a stream a
    session is given once, when the watermark (``delay`` behind the newest load) has passed its end, so
    counts equal the batch's as long as no load is later than ``delay``; state holds open sessions with
    their distinct pages only. A load without a user or time takes no part.
    """
    usable = loads.filter("user_id is not null and ts is not null and page is not null").withWatermark("ts", delay)
    sessions = usable.groupBy(F.session_window("ts", gap).alias("session"), "user_id").agg(F.collect_set("page").alias("pages"))
    return sessions.select(F.col("session.start").alias("session_start"), F.col("session.end").alias("session_end"), "user_id", F.explode("pages").alias("page"))


def windowed_hits(events: DataFrame, size: str = "1 hour", delay: str = "1 day") -> DataFrame:
    """window_start, event_type, hits."""
    grouped = events.withWatermark("ts", delay).groupBy(F.window("ts", size), "event_type").agg(F.count("*").alias("hits"))
    return grouped.select(F.col("window.start").alias("window_start"), "event_type", "hits")


def run_batches(stream: DataFrame, apply: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Apply ``apply`` (an idempotent upsert) to each micro-batch until the input is used up."""
    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
