"""Pages fetched politely: one task for each host, a pause between its requests, a stop for all."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import new_path, stored
from .answers import Answers, ServiceError, retried

#: Statuses by which a server says that it wants no more requests.
STOPPING = (403, 429)
_SCHEMA = "url string, status int, html string, error string, outcome string"


def fetch_paced(urls: DataFrame, fetcher: Callable[[str], tuple[int, str]], folder: str | None = None, attempts: int = 3, delay: float = 1.2, backoff: float = 1.0) -> DataFrame:
    """url, status, html, error, outcome (ok, fetch-error or stopped) of each distinct url, by an injected fetcher.

    The URLs of a host are fetched one after another by one task, ``delay`` seconds apart. Exceptions
    and statuses of 500 or more are tried again. A 403 or 429 ends the run: a mark in ``folder`` is
    seen by every task before its next request, and what is left becomes rows of outcome ``stopped``;
    the job itself does not fail, so no task is tried again. Every answer is kept in ``folder``, by
    default one of this call: a task that is run again, or a later call with the same folder, asks only
    for what has no answer yet (the mark counts for its own call only).

    Null URLs are left out; the result is stored, so no action fetches anew.
    """
    spark = urls.sparkSession
    place, run_id = folder or new_path(spark, "answers"), new_path(spark, "run").rsplit("/", 1)[1]
    host = F.coalesce(F.lower(F.try_parse_url("url", F.lit("HOST"))), F.lit(""))
    asked = urls.select("url").filter("url is not null").distinct().withColumn("host", host)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        answers, last = Answers(place), {}

        def ask(url: str, host: str) -> dict:
            def once() -> tuple[int, str]:
                wait = last.get(host, float("-inf")) + delay - time.monotonic()
                if wait > 0:
                    time.sleep(wait)
                try:
                    status, body = fetcher(url)
                finally:
                    last[host] = time.monotonic()
                if status >= 500:
                    raise ServiceError(status)
                return status, body

            try:
                status, body = retried(once, attempts, backoff)
            except ServiceError as problem:
                return {"status": problem.status, "html": None, "error": str(problem), "outcome": "fetch-error"}
            except Exception as problem:
                return {"status": 0, "html": None, "error": f"{type(problem).__name__}: {problem}", "outcome": "fetch-error"}
            if status == 200:
                return {"status": status, "html": body, "error": None, "outcome": "ok"}
            return {"status": status, "html": None, "error": f"HTTP {status}", "outcome": "stopped" if status in STOPPING else "fetch-error"}

        for batch in batches:
            for url, at in zip(batch.column("url").to_pylist(), batch.column("host").to_pylist()):
                known = answers.get(url)
                if known is None and answers.marked(run_id):
                    known = {"status": None, "html": None, "error": "the run was stopped by a server", "outcome": "stopped"}
                elif known is None:
                    known = ask(url, at)
                    if known["outcome"] == "stopped":
                        answers.mark(run_id)
                    elif known["outcome"] == "ok" or 400 <= known["status"] < 500:
                        answers.put(url, known)  # what may be better next time is not kept
                row = {"url": url, **known}
                yield pa.RecordBatch.from_arrays([pa.array([row["url"]]), pa.array([row["status"]], pa.int32()), *(pa.array([row[c]], pa.string()) for c in ("html", "error", "outcome"))], ["url", "status", "html", "error", "outcome"])

    dealt = asked.repartition(tasks, "host").sortWithinPartitions("host", "url")
    return stored(dealt.mapInArrow(run, _SCHEMA), "fetched")
