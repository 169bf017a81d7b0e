"""Secret scans over an incremental blob ledger.

The ledger is a folder of three tables that only grow:

* ``versions`` (path, version, blob): every version of every path that was ever handed in,
  content-addressed by the SHA-256 of its text;
* ``blobs`` (blob, packed): each distinct text once, compressed, by the run that brought it;
* ``findings`` (blob, rule, spans): one row for each (blob, rule version) that was scanned.

A run adds what is new to the first two, scans only the (blob, rule version) pairs that the
third lacks (also old blobs, when a rule's version changes) and joins the findings back to
every path that has, or had, a blob. A run that broke off is made good by the next: what it
left unscanned is still unseen.

Defined results: a null text is the empty blob; repeated rows and copies share one scan and
each get its findings; a (path, version, blob) that the ledger has is not added again, but
rows that repeat within one run are each kept; rows with a null path are scanned and returned
like others; a rule whose version changes is scanned anew over all blobs, others are not;
whole texts are scanned, however long; an empty table adds nothing; other columns may have
any name.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from .common import scratch_path, lean_workers, materialize, packed_rows, sub_batches


@dataclass(frozen=True)
class Rule:
    """A pattern whose leftmost non-overlapping matches count if ``group`` has ``least`` characters."""

    kind: str
    version: int
    pattern: str
    group: int
    least: int

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"

    def spans(self, text: str) -> list[tuple[int, int]]:
        found = re.finditer(self.pattern, text)
        return [m.span() for m in found if len(m[self.group]) >= self.least]


#: The contract's rules, in the order that breaks ties between spans.
RULES = (
    Rule("assign", 1, r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", 1, r"[0-9a-f]{32,}", 0, 32),  # a maximal run of fewer characters fails in any case
)

#: Bytes of findings that are broadcast at most.
BROADCAST_BYTES = 32 << 20

#: New texts whose addresses (8 bytes each) are broadcast at most.
NEW_BLOBS = 1 << 22

#: Tasks that share the rows of one blob where findings are not broadcast.
SALTS = 16

BLOBS = "blob string, packed binary, run string"
FINDINGS = "blob string, rule string, kind string, kind_no int, spans array<struct<start:long,end:long>>"
SPANS = "array<struct<start:long,kind_no:int,kind:string,end:long>>"


def _read(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame | None:
    """A table of the ledger, None where there is none yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return None


def _blob(text: Column) -> Column:
    return F.sha2(F.coalesce(text.cast("string"), F.lit("")).cast("binary"), 256)


def _head(blob: str) -> int:
    return int(blob[:16], 16)


def _pack(batches: Iterator[pa.RecordBatch], wanted: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """The texts compressed; only those whose address begins like one in ``wanted``, if given."""
    packer = zstandard.ZstdCompressor(level=6)
    for batch in batches:
        if wanted is not None and batch.num_rows:
            heads = np.array([_head(b) for b in batch.column("blob").to_pylist()], np.uint64)
            spot = np.minimum(np.searchsorted(wanted, heads), max(len(wanted) - 1, 0))
            batch = batch.filter(pa.array(wanted[spot] == heads if len(wanted) else np.zeros(len(heads), bool)))
        for part in sub_batches([batch], "text"):
            packed = [packer.compress((t or "").encode()) for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("blob"), pa.array(packed, pa.binary())], ["blob", "packed"])


def new_texts(rows: DataFrame, known: DataFrame | None) -> DataFrame:
    """blob, packed of the rows (blob, text) whose address ``known`` (blob) lacks; copies are still there.

    Addresses are compared first, so a known text is neither compressed nor shuffled. New ones
    are broadcast by their first 8 bytes up to ``NEW_BLOBS``; beyond that all texts are
    compressed before they are compared, with the same result.
    """
    spark = rows.sparkSession
    if known is None:
        return rows.mapInArrow(lambda batches: _pack(batches, None), "blob string, packed binary")
    fresh = materialize(rows.select("blob").distinct().join(known.select("blob"), "blob", "left_anti"), "new-blobs", narrow=True)
    wanted = None
    if fresh.count() <= NEW_BLOBS:
        heads = fresh.select(F.conv(F.substring("blob", 1, 16), 16, -10).cast("long").alias("head")).toArrow()["head"]
        wanted = np.sort(heads.to_numpy().view(np.uint64))
    shared = spark.sparkContext.broadcast(wanted)
    packed = rows.mapInArrow(lambda batches: _pack(batches, shared.value), "blob string, packed binary")
    return packed.join(known.select("blob"), "blob", "left_anti") if wanted is None else packed


def _scan(texts: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """FINDINGS of texts (blob, packed, todo: keys of rules)."""
    by_key = {r.key: (i, r) for i, r in enumerate(rules)}
    span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    types = [pa.string(), pa.string(), pa.string(), pa.int32(), span_type]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opener = zstandard.ZstdDecompressor()
        for batch in sub_batches(batches, "packed"):
            out = []
            for blob, todo, packed in zip(*(batch.column(k).to_pylist() for k in ("blob", "todo", "packed"))):
                text = opener.decompress(packed).decode() if packed else ""
                for key in todo:
                    number, rule = by_key[key]
                    out.append((blob, key, rule.kind, number, [{"start": a, "end": b} for a, b in rule.spans(text)]))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 5, types)], ["blob", "rule", "kind", "kind_no", "spans"])

    return texts.mapInArrow(run, FINDINGS)


def update(versions: DataFrame, ledger_path: str, rules: tuple[Rule, ...] = RULES, path_col: str = "doc_id", text_col: str = "text", version_col: str | None = None) -> StructType:
    """Bring the ledger up to date with rows of paths and texts; returns the schema of its versions."""
    spark = versions.sparkSession
    lean_workers(spark)
    version = F.col(version_col).cast("string") if version_col else F.lit(None).cast("string")
    rows = versions.select(F.col(path_col).alias("path"), version.alias("version"), _blob(F.col(text_col)).alias("blob"), F.col(text_col).cast("string").alias("text"))
    addressed = rows.select("path", "version", "blob")
    schema = StructType([StructField(f.name, f.dataType, True) for f in addressed.schema])

    run = uuid.uuid4().hex
    known = _read(spark, f"{ledger_path}/blobs", BLOBS)
    # Copies collapse before the shuffle, which moves compressed texts.
    fresh = new_texts(rows.select("blob", "text"), known).groupBy("blob").agg(F.first("packed").alias("packed"))
    fresh.write.parquet(f"{ledger_path}/blobs/run={run}")

    held = _read(spark, f"{ledger_path}/versions", schema)
    if held is not None:
        same = F.struct("path", "version", "blob")
        held = held.select(same.alias("held")).distinct()
        addressed = addressed.join(held, same.eqNullSafe(F.col("held")), "left_anti")
    addressed.write.mode("append").parquet(f"{ledger_path}/versions")

    keys = F.array(*(F.lit(r.key) for r in rules))
    scanned = _read(spark, f"{ledger_path}/findings", FINDINGS)
    todo = _read(spark, f"{ledger_path}/blobs", BLOBS).filter(F.col("run") == run).select("blob", "packed", keys.alias("todo"))
    if known is not None:
        # Blobs of earlier runs: only their keys are compared, and only texts that lack a rule are read.
        done = scanned.groupBy("blob").agg(F.collect_set("rule").alias("done")) if scanned is not None else spark.createDataFrame([], "blob string, done array<string>")
        none = F.array().cast("array<string>")
        lacking = known.select("blob").join(done, "blob", "left").select("blob", F.array_except(keys, F.coalesce("done", none)).alias("todo")).filter(F.size("todo") > 0)
        lacking = materialize(lacking, "unscanned-blobs", narrow=True)
        if not lacking.isEmpty():
            todo = todo.unionByName(known.join(lacking, "blob").select("blob", "packed", "todo"))
    _scan(todo, rules).write.mode("append").parquet(f"{ledger_path}/findings")
    return schema


def findings(spark: SparkSession, ledger_path: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """blob, ``findings`` of every blob in which these rules found something.

    ``findings`` is an array of (start, kind_no, kind, end) in code points, end exclusive,
    sorted by start, then by the rule's place in ``rules``.
    """
    number = F.create_map(*(F.lit(x) for i, r in enumerate(rules) for x in (r.key, i)))
    spans = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), F.element_at(number, F.col("rule")).alias("kind_no"), F.col("kind"), s["end"].alias("end")))
    return (
        _read(spark, f"{ledger_path}/findings", FINDINGS)
        .filter(F.col("rule").isin([r.key for r in rules]) & (F.size("spans") > 0))
        .dropDuplicates(["blob", "rule"])  # runs at the same time may both have scanned a blob
        .groupBy("blob")
        .agg(F.array_sort(F.flatten(F.collect_list(spans))).alias("findings"))
    )


def _with_findings(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``rows`` (blob and others) with ``findings``, an empty array where there are none.

    Few blobs hold secrets; where their findings are counted to be small they are broadcast.
    Beyond that the rows of one blob are dealt over SALTS tasks.
    """
    found = materialize(found, "findings", narrow=True)
    blobs, spans = found.agg(F.count("*"), F.coalesce(F.sum(F.size("findings")), F.lit(0))).first()
    if blobs * 100 + spans * 50 <= BROADCAST_BYTES:
        joined = rows.join(F.broadcast(found), "blob", "left")
    else:
        salted = found.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = rows.withColumn("salt", F.spark_partition_id() % SALTS).join(salted, ["blob", "salt"], "left").drop("salt")
    return joined.withColumn("findings", F.coalesce("findings", F.array().cast(SPANS)))


def scan_versions(versions: DataFrame, ledger_path: str, rules: tuple[Rule, ...] = RULES, path_col: str = "doc_id", text_col: str = "text", version_col: str | None = None) -> DataFrame:
    """Bring the ledger up to date and return path, version, blob and findings of every version that it holds, old ones too."""
    schema = update(versions, ledger_path, rules, path_col, text_col, version_col)
    spark = versions.sparkSession
    return _with_findings(_read(spark, f"{ledger_path}/versions", schema), findings(spark, ledger_path, rules))


def joined(findings: Column) -> Column:
    """kind:start:end of each finding, comma-joined."""
    return F.array_join(F.transform(findings, lambda f: F.concat_ws(":", f["kind"], f["start"], f["end"])), ",")


def report(docs: DataFrame, ledger_path: str | None = None) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans (and blob) of every document of the ledger.

    Without ``ledger_path`` a ledger is begun, which holds these documents alone.
    """
    path = ledger_path or scratch_path(docs.sparkSession, "secret-ledger")
    scanned = scan_versions(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), path)

    def count(kind: str) -> Column:
        return F.size(F.filter("findings", lambda f: f["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return scanned.select(
        F.col("path").alias("doc_id"),
        *(count(r.kind) for r in RULES),
        F.sha2(joined(F.col("findings")).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("findings")).alias("spans"),
        "blob",
    )


def redact(docs: DataFrame, mark: str = "<secret>", ledger_path: str | None = None) -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by ``mark``; n_chars follows; no row goes.

    Overlapping spans are replaced as one. Texts without a finding, null ones too, stay as they are.
    """
    path = ledger_path or scratch_path(docs.sparkSession, "secret-ledger")
    update(docs.select(F.col("doc_id"), "text"), path)
    rows = packed_rows(docs, _blob(F.col("text")).alias("blob"))
    hit = _with_findings(rows, findings(docs.sparkSession, path))
    text = F.col("row.text")
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))

    def fold(acc: Column, f: Column) -> Column:
        fresh = f["start"] >= acc["at"]
        return F.struct(
            F.when(fresh, F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), (f["start"] - acc["at"]).cast("int")), F.lit(mark))).otherwise(acc["out"]).alias("out"),
            F.greatest(acc["at"], f["end"]).alias("at"),
        )

    cleaned = F.aggregate("findings", start, fold, lambda acc: F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), F.length(text))))
    some = F.size("findings") > 0
    out = hit.select("row", F.when(some, cleaned).otherwise(text).alias("clean"), some.alias("some"))
    replaced = {"text": F.col("clean"), "n_chars": F.when(F.col("some"), F.length("clean").cast("long")).otherwise(F.col("row.n_chars")) if "n_chars" in docs.columns else None}
    return out.select(*((replaced[c] if c in replaced else F.col("row").getField(c)).alias(c) for c in docs.columns))
