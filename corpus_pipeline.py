"""A pipeline over ``documents``: toxicity, near duplicates, benchmark passages, secrets, tokens.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; its
result is written and read again. All but the last return the columns of ``documents``.

Defined results of every stage: an empty table gives no rows; whole texts are read, however
long; columns beyond those of ``documents`` may have any name and are left out. Rows with a
null doc_id are never duplicates nor contaminated, but are scored, redacted and tokenized like
others; a null text is an empty one and stays null where texts are returned.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quillgraph.llm import bpe, decontam, secret_ledger, setsketch, toxicity
from quillgraph.llm.common import scratch

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go; each row, also of a repeated doc_id, is judged by its own text."""
    return toxicity.reject_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).select(COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked at a similarity of 0.8 the document of smallest doc_id stays, with all its repeated rows."""
    return setsketch.keep_first(docs, 80, 100).select(COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, also with other values in its slots, go, with all rows of that doc_id."""
    return decontam.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(COLUMNS)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are replaced by a mark; no document goes; copies are scanned once."""
    return secret_ledger.redact(docs).select(COLUMNS)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text (little-endian unsigned 32-bit) and digests of ids and decoded bytes; each row by itself."""
    return bpe.digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("bpe", tokenize),
]

#: A learned classifier and near duplicates have no form in SQL; tests/llm holds the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        with scratch(spark) as keep:  # what a stage writes on its way goes with it
            docs = keep(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
