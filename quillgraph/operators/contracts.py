"""Injected model operators: prompts go out by a callable, responses are checked by fixed contracts.

No model is part of this library. ``ask`` takes any picklable callable of one prompt
string; ``from_fixture`` is its offline twin, a join with recorded responses.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.answers import Answers, retried
from ..storage import new_path, stored
from .quality import id_difference

EXTRACTION = "struct<entities:array<struct<name:string,type:string,relevance_score:string>>,edges:array<struct<source:string,relation:string,target:string>>>"
JUDGEMENT = "struct<entities:array<struct<name:string,status:string,note:string>>,edges:array<struct<source:string,relation:string,target:string,status:string,note:string>>>"
DRAFT = "struct<title:string,summary:string,body_text:string,graph_steps:array<string>>"
REVIEW = "array<struct<name:string,status:string,evidence:string>>"
SEO = (
    "struct<title:string,meta_description:string,canonical_slug:string,og_title:string,og_description:string,primary_keywords:array<string>,secondary_keywords:array<string>,"
    "internal_anchor_texts:array<string>,headings:array<struct<level:int,text:string>>,faq:array<struct<question:string,answer:string>>>"
)
TRANSLATION = "map<string,string>"
JUDGE_STATUSES, REVIEW_STATUSES = ["retained", "altered", "dropped"], ["covered", "partial", "missing"]


def ask(prompts: DataFrame, model: Callable[[str], str], folder: str | None = None, attempts: int = 3, delay: float = 1.0) -> DataFrame:
    """key, response, failure of every row (key, prompt); each distinct prompt is asked once.

    Answers are kept by the prompt's hash in ``folder``, by default one of this call, as soon as they are there,
    and the result is stored: neither a lost executor nor a later action asks again. A model may raise
    ``ServiceError`` with a status and seconds to wait; 429, 5xx and other exceptions are tried again. What
    still fails is a row without a response, with its failure, and stops no other row.
    """
    place = folder or new_path(prompts.sparkSession, "answers")
    once = prompts.select("prompt").filter("prompt is not null").distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        answers = Answers(place)
        for batch in batches:
            out = []
            for prompt in batch.column("prompt").to_pylist():
                found = answers.get(prompt)
                if found is None:
                    try:
                        found = {"response": retried(lambda p=prompt: model(p), attempts, delay)}
                        answers.put(prompt, found)
                    except Exception as problem:
                        found = {"response": None, "failure": f"{type(problem).__name__}: {problem}"}
                out.append((prompt, found["response"], found.get("failure")))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.string()) for k in range(3)], ["prompt", "response", "failure"])

    tasks = int(prompts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    told = stored(once.repartition(tasks, "prompt").mapInArrow(run, "prompt string, response string, failure string"), "responses")
    return prompts.select("key", "prompt").join(told, "prompt", "left").select(F.col("key").cast("string").alias("key"), "response", F.when(F.col("prompt").isNull(), "no prompt").otherwise(F.col("failure")).alias("failure"))


def from_fixture(prompts: DataFrame, recorded: DataFrame) -> DataFrame:
    return prompts.select("key").join(recorded.select("key", "response"), "key")


def _blank(c: Column) -> Column:
    return F.coalesce(F.trim(c), F.lit("")) == ""


def _checked(responses: DataFrame, schema: str, error: Callable[[Column], Column]) -> DataFrame:
    parsed = responses.withColumn("value", F.from_json("response", schema))
    broken = F.col("value").isNull() | F.try_parse_json("response").isNull()
    checked = F.when(broken, "not the expected JSON").otherwise(error(F.col("value")))
    # A call that failed says why instead.
    return parsed.withColumn("error", F.coalesce("failure", checked) if "failure" in responses.columns else checked)


def extraction(responses: DataFrame) -> DataFrame:
    def error(v: Column) -> Column:
        return (
            F.when(v["entities"].isNull() | v["edges"].isNull(), "entities or edges are missing")
            .when(F.exists(v["entities"], lambda e: _blank(e["name"]) | _blank(e["type"])), "an entity lacks name or type")
            .when(F.exists(v["edges"], lambda e: _blank(e["source"]) | _blank(e["relation"]) | _blank(e["target"])), "an edge lacks a part")
        )

    return _checked(responses, EXTRACTION, error)


def judgement(responses: DataFrame) -> DataFrame:
    def bad(items: Column) -> Column:
        return F.exists(items, lambda i: F.coalesce(~i["status"].isin(JUDGE_STATUSES), F.lit(True)))

    return _checked(responses, JUDGEMENT, lambda v: F.when(v["entities"].isNull() | v["edges"].isNull(), "entities or edges are missing").when(bad(v["entities"]) | bad(v["edges"]), "unknown status"))


def draft(responses: DataFrame) -> DataFrame:
    def error(v: Column) -> Column:
        steps = v["graph_steps"]
        return (
            F.when(_blank(v["title"]) | _blank(v["summary"]) | _blank(v["body_text"]), "title, summary or body is blank")
            .when(~F.regexp_like(v["body_text"], F.lit(r"(?m)^##\s+\S")), "the body has no section heading")
            .when(~F.coalesce(F.size(steps).between(2, 5) & F.forall(steps, lambda s: ~_blank(s)), F.lit(False)), "two to five steps are needed")
        )

    return _checked(responses, DRAFT, error)


def review(responses: DataFrame) -> DataFrame:
    return _checked(responses, REVIEW, lambda v: F.when(F.exists(v, lambda i: _blank(i["name"]) | F.coalesce(~i["status"].isin(REVIEW_STATUSES), F.lit(True))), "an item lacks its name or status"))


def seo(responses: DataFrame) -> DataFrame:
    def error(v: Column) -> Column:
        texts = [v[k] for k in ("title", "meta_description", "canonical_slug", "og_title", "og_description")]
        lists = [v[k] for k in ("primary_keywords", "secondary_keywords", "internal_anchor_texts", "headings", "faq")]
        blank, empty = F.lit(False), F.lit(False)
        for t in texts:
            blank = blank | _blank(t)
        for items in lists:
            empty = empty | (F.coalesce(F.size(items), F.lit(0)) < 1)
        levels = F.exists(v["headings"], lambda h: F.coalesce(~h["level"].between(2, 4), F.lit(True)) | _blank(h["text"]))
        return F.when(blank, "a text is blank").when(empty, "a list is empty").when(levels, "heading levels are 2 to 4")

    return _checked(responses, SEO, error)


def translation(responses: DataFrame, sources: DataFrame) -> DataFrame:
    """Responses must translate exactly the ids of sources (key, texts: map id to text), none of them blank."""
    joined = responses.join(sources.select("key", F.map_keys("texts").alias("ids")), "key")
    parsed = joined.withColumn("value", F.from_json("response", TRANSLATION))
    keys = F.map_keys("value")
    failed = F.col("failure") if "failure" in responses.columns else F.lit(None).cast("string")
    error = (
        F.when(failed.isNotNull(), failed)
        .when(F.col("value").isNull() | F.try_parse_json("response").isNull(), "not the expected JSON")
        .when(F.size(F.array_except("ids", keys)) > 0, "an id is missing")
        .when(F.size(F.array_except(keys, "ids")) > 0, "an id is unknown")
        .when(F.exists(F.map_values("value"), _blank), "a text is blank")
    )
    return parsed.withColumn("error", error).drop("ids")


def batch_extraction(blocks: DataFrame, expected: DataFrame) -> DataFrame:
    """batch, error of batched responses as rows (batch, slug): a repeated or missing slug fails the whole batch."""
    repeated = blocks.groupBy("batch", "slug").agg(F.count("*").alias("n")).filter("n > 1").select("batch", F.lit("a slug is repeated").alias("error"))
    missing = expected.select("batch", "slug").join(blocks.select("batch", "slug"), ["batch", "slug"], "left_anti").select("batch", F.lit("a slug is missing").alias("error"))
    return repeated.unionByName(missing).groupBy("batch").agg(F.max("error").alias("error"))


def missing_ids(expected: DataFrame, got: DataFrame) -> DataFrame:
    return id_difference(expected, got).filter("side = 'missing'")
