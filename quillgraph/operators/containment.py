"""Which strings contain which others: an index of character n-grams, and one automaton for long texts."""

from __future__ import annotations

import bisect
import uuid
from collections.abc import Iterator
from functools import reduce

import ahocorasick
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import stored

#: Slots in which grams are counted, and the count from which a gram's haystacks are dealt over SALTS tasks.
GRAM_SLOTS, HOT_GRAM, SALTS = 1 << 16, 100_000, 8
#: More than the places of one needle: 2 ** 31.
PLACES = 1 << 31
#: Bytes of patterns in one automaton; more patterns are searched for in several passes. As many bytes of random
#: words took 270 MB and 9 seconds to build.
PATTERN_BYTES = 8 << 20
_BUILT: dict[str, ahocorasick.Automaton] = {}
#: Pairs found after which a task sends them on.
HITS = 20_000


def _joined(hashes: Column, k: int) -> Column:
    """Hashes of twice as long runs: each hash with that ``k`` places behind it."""

    def pairs(o: Column) -> Column:
        n = F.greatest(F.size(o) - k, F.lit(0))
        return F.zip_with(F.slice(o, F.lit(1), n), F.slice(o, F.lit(k + 1), n), lambda a, b: F.xxhash64(a, b))

    return F.transform(F.array(hashes), pairs)[0]  # named several times and made once


def _grams(c: Column, size: int) -> Column:
    """Distinct hashes of the runs of ``size`` characters, a power of two, in time that follows the length of the string.

    A run's hash is made of those of its halves, so the expression has a step for each doubling, not for each character.
    """
    out = F.transform(F.split(c, ""), lambda x: F.xxhash64(x))
    for i in range(size.bit_length() - 1):
        out = _joined(out, 1 << i)
    return F.array_distinct(out)


def contained(needles: DataFrame, hays: DataFrame) -> DataFrame:
    """needle_id, hay_id of needles (needle_id, needle) that occur in hays (hay_id, hay); empty and null ones occur in none.

    Needles longer than every hay are left out. The others are counted: up to PATTERN_BYTES, ids included,
    one automaton reads each hay once and nothing of the hays is shuffled. Beyond that a needle is
    looked up by the one of its grams that the fewest hays have, so frequent grams bring no pairs
    together unless a needle has nothing else; what meets is compared whole.
    """
    longest = hays.agg(F.coalesce(F.max(F.length("hay")), F.lit(0))).first()[0]
    fit = needles.filter("needle <> ''").filter(F.length("needle") <= longest)
    size = fit.agg(F.coalesce(F.sum(F.octet_length("needle") + F.octet_length(F.col("needle_id").cast("string"))), F.lit(0))).first()[0]
    if not size:
        return needles.sparkSession.createDataFrame([], needles.select("needle_id").schema.add(hays.schema["hay_id"]))
    if size > PATTERN_BYTES:
        return _by_grams(fit, hays)
    known = fit.select("needle_id", F.col("needle").alias("pattern"))
    found = _searched(hays.select(F.col("hay_id").alias("id"), F.col("hay").alias("text")), known.select("pattern"))
    return found.join(F.broadcast(known), "pattern").select("needle_id", F.col("id").alias("hay_id"))


def _by_grams(needles: DataFrame, hays: DataFrame) -> DataFrame:
    """Needles meet hays through the rarest of their grams, which are as long as a power of two allows.

    Short grams are frequent where strings share beginnings or digits. How rare a gram is, is told by
    counts in GRAM_SLOTS slots, so no gram is shuffled to be counted; only grams of full slots are dealt over SALTS tasks.
    Grams are told by hashes, and what meets is compared whole.
    """
    size = reduce(lambda rest, k: F.when(F.length("needle") >= k, k).otherwise(rest), (1 << k for k in range(1, 31)), F.lit(1))
    wanted = needles.select("needle_id", "needle", size.alias("size"))
    slot = F.pmod(F.xxhash64("gram"), F.lit(GRAM_SLOTS)).alias("slot")
    found = []
    for size in sorted(r["size"] for r in wanted.select("size").distinct().collect()):
        grams = hays.select("hay_id", "hay", F.explode(_grams(F.col("hay"), size)).alias("gram")).select("*", slot)
        counts = stored(grams.groupBy("slot").agg(F.count("*").alias("n")), "gram-counts")  # GRAM_SLOTS rows at most
        hot = counts.filter(F.col("n") > HOT_GRAM).select("slot", F.lit(True).alias("hot"))
        asked = wanted.filter(F.col("size") == size).select("needle_id", "needle", F.posexplode(_grams(F.col("needle"), size)).alias("pos", "gram")).select("*", slot)
        # A needle with a gram of an empty slot occurs nowhere. Count and place make one number, so that nothing is sorted to find the least.
        met = asked.join(F.broadcast(counts), "slot", "left").select("needle_id", "needle", (F.coalesce("n", F.lit(0)) * PLACES + F.col("pos")).alias("at"))
        least = met.groupBy("needle_id", "needle").agg(F.min("at").alias("at")).filter(F.col("at") >= PLACES)
        place = (F.col("at") % PLACES).cast("int") + 1
        rarest = least.select("needle_id", "needle", F.shiftright("at", 31).alias("n"), F.element_at(_grams(F.col("needle"), size), place).alias("gram"))
        everywhere = F.when(F.col("n") > HOT_GRAM, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
        keyed = rarest.select("needle_id", "needle", "gram", F.explode(everywhere).alias("salt"))
        salt = F.when(F.col("hot"), F.pmod(F.xxhash64("hay_id"), F.lit(SALTS)).cast("int")).otherwise(0)
        salted = grams.join(F.broadcast(hot), "slot", "left").select("hay_id", "hay", "gram", salt.alias("salt"))
        found.append(salted.join(keyed, ["gram", "salt"]).filter(F.contains("hay", F.col("needle"))).select("needle_id", "hay_id"))
    return reduce(DataFrame.unionByName, found)


def first_per(pairs: DataFrame, key: str, order: str, limit: int) -> DataFrame:
    """The first ``limit`` rows of each key by ``order``."""
    return pairs.withColumn("_k", F.row_number().over(Window.partitionBy(key).orderBy(order))).filter(F.col("_k") <= limit).drop("_k")


def first_hits(rows: DataFrame, searches: list[tuple[str, DataFrame]], limit: int) -> DataFrame:
    """search, pattern, id: the ``limit`` smallest ids of rows (id and text columns) whose column holds the pattern.

    searches: (column, patterns (pattern)); ``search`` is the place in that list. Each text is read
    once for all patterns; a task keeps no more than ``limit`` ids for each pattern and search. Patterns
    are counted, and beyond PATTERN_BYTES they are cut into blocks of about half of that, one pass each.
    """
    parts = [patterns.filter("pattern <> ''").select(F.lit(k).alias("search"), "pattern").distinct() for k, (_, patterns) in enumerate(searches)]
    wanted = reduce(DataFrame.unionByName, parts)
    size = wanted.agg(F.coalesce(F.sum(F.octet_length("pattern")), F.lit(0))).first()[0]
    blocks = 1 if size <= PATTERN_BYTES else -(-2 * size // PATTERN_BYTES)
    block = F.pmod(F.xxhash64("pattern"), F.lit(blocks))
    columns = [c for c, _ in searches]
    texts = rows.select(F.col("id").cast("long").alias("id"), *(F.coalesce(c, F.lit("")).alias(f"c{k}") for k, c in enumerate(dict.fromkeys(columns))))
    at = [list(dict.fromkeys(columns)).index(c) for c in columns]
    found = [_hits(texts, wanted.filter(block == b), at, limit) for b in range(blocks)]
    best = Window.partitionBy("search", "pattern").orderBy("id")
    return reduce(DataFrame.unionByName, found).withColumn("_k", F.row_number().over(best)).filter(F.col("_k") <= limit).drop("_k")


def _hits(texts: DataFrame, wanted: DataFrame, at: list[int], limit: int) -> DataFrame:
    patterns: list[list[str]] = [[] for _ in at]
    for r in wanted.collect():
        patterns[r["search"]].append(r["pattern"])
    shared = texts.sparkSession.sparkContext.broadcast(patterns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automata = []
        for words in shared.value:
            automaton = ahocorasick.Automaton()
            for word in words:
                automaton.add_word(word, word)
            automaton.make_automaton()
            automata.append(automaton if words else None)
        kept: dict[tuple[int, str], list[int]] = {}
        for batch in batches:
            ids = batch.column("id").to_pylist()
            for k, automaton in enumerate(automata):
                if automaton is None:
                    continue
                for i, text in zip(ids, batch.column(f"c{at[k]}").to_pylist()):
                    if i is None:
                        continue
                    for word in {w for _, w in automaton.iter(text)}:
                        best = kept.setdefault((k, word), [])
                        if len(best) < limit or i < best[-1]:
                            bisect.insort(best, i)
                            del best[limit:]
        rows = [(k, word, i) for (k, word), best in kept.items() for i in best]
        for a in range(0, len(rows), 10_000):
            part = rows[a : a + 10_000]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in part], pa.int32()), pa.array([r[1] for r in part], pa.string()), pa.array([r[2] for r in part], pa.int64())], ["search", "pattern", "id"])

    return texts.mapInArrow(run, "search int, pattern string, id long")


def found_in(texts: DataFrame, patterns: DataFrame) -> DataFrame:
    """id, pattern of texts (id, text) and the patterns (pattern) that they hold, each once; every text is read once a block of patterns."""
    wanted = patterns.filter("pattern <> ''").distinct()
    size = wanted.agg(F.coalesce(F.sum(F.octet_length("pattern")), F.lit(0))).first()[0]
    blocks = 1 if size <= PATTERN_BYTES else -(-2 * size // PATTERN_BYTES)
    block = F.pmod(F.xxhash64("pattern"), F.lit(blocks))
    return reduce(DataFrame.unionByName, [_searched(texts, wanted.filter(block == b)) for b in range(blocks)])


def _automaton(token: str, words: Broadcast) -> ahocorasick.Automaton:
    """The automaton of one search, built once by each worker process, which keeps the last one."""
    if token not in _BUILT:
        made = ahocorasick.Automaton()
        for word in words.value:
            made.add_word(word, word)
        made.make_automaton()
        _BUILT.clear()
        _BUILT[token] = made
    return _BUILT[token]


def _searched(texts: DataFrame, patterns: DataFrame) -> DataFrame:
    """id, pattern by one automaton over patterns of counted size."""
    rows = texts.select("id", F.coalesce("text", F.lit("")).alias("text"))
    shared, token = texts.sparkSession.sparkContext.broadcast(sorted({r["pattern"] for r in patterns.collect()})), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(token, shared)
        if not len(automaton):
            return
        for batch in batches:
            at, found = [], []
            for i, text in enumerate(batch.column("text")):
                hits = {w for _, w in automaton.iter(text.as_py())}
                at += [i] * len(hits)
                found += hits
                if len(found) >= HITS:
                    yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(at)), pa.array(found, pa.string())], ["id", "pattern"])
                    at, found = [], []
            if found:
                yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(at)), pa.array(found, pa.string())], ["id", "pattern"])

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, pattern string")
