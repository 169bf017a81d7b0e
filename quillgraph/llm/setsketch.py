"""Near duplicates by SetSketch registers.

A text's set is its distinct 5-word shingles. Its sketch has ``REGISTERS`` registers, each
the truncated exponent (base ``BASE``) of the minimum of exponentially distributed hash
values over the set. Values of one element come in ascending order, one register after
another, so elements stop as soon as they cannot lower any register. Sketches of two
parts merge by the register-wise maximum (``merge``).

Equal sets collapse into one class. Classes meet in buckets of equal register bands;
bands only propose pairs. A pair is estimated jointly by maximum likelihood from how
many registers are greater, equal and smaller, and what can reach the threshold is
confirmed on the full sets. Buckets are never expanded into all pairs: each class is
first compared with its best pivot, then with the pivots of buckets that still hold
several components; linked classes contract to components at each step.

Classes that then still share a bucket across components may be many and unrelated, as when
they share a long passage. They meet anew by their rarest shingles: two sets of the wanted
similarity always share one of the first n - ceil(threshold * n) + 1 in any common order
(prefix filter), and in the order of frequency what many sets share comes last. Where such a
group still holds several components, registers are compared in blocks, and a class that comes
near many members of the largest component is searched in blocks of their full sets.

Rows of hot buckets are salted wherever they are joined.

Defined results: null and empty texts have no shingles, link with nothing, are kept and are
their own component; a null doc_id links with nothing and is its own (null) component; repeated
rows get the same component; texts that repeat one doc_id are one node, so what either links to
is linked; ties do not arise, as a component is its smallest doc_id; whole texts are read, however
long; an empty table gives no rows; columns other than doc_id and text may have any name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import binary_array, dealt, materialize, mix64, opened_rows, packed_rows, sub_batches, text_rows, union_all, utf8_buffers
from .components import components
from .shingles import shingle_sets

REGISTERS = 256
BASE = 1.001
#: Bands of registers that propose pairs: of two sets with similarity 0.85 they miss 4 in 10**8.
BANDS, ROWS = 36, 6
#: Standard errors by which an estimate may fall short of the threshold and still be confirmed.
SLACK = 4.5
#: Classes in one block of a group when pairs between components are compared.
BLOCK = 256
#: Members of the largest component near a class that are confirmed one by one; for more the component is searched.
FEW = 8
#: Rows of a bucket beyond which it is salted, at least, and buckets that are salted (and broadcast) at most.
HOT_ROWS, HOT_BUCKETS = 1024, 1 << 18
#: Slots in which shingles are counted for the order of the prefix filter.
FREQUENCY_BITS = 20
#: Ids that are broadcast at most (8 bytes each); beyond that the same join is shuffled.
BROADCAST_IDS = 1 << 20

_STEP = np.uint64(0x9E3779B97F4A7C15)


def sketches(elements: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Registers (n x REGISTERS, unsigned 16-bit) of n sets of 64-bit elements; an empty set has zeros."""
    n, m = len(offsets) - 1, REGISTERS
    smallest = np.full(n * m, np.inf)
    owner = np.repeat(np.arange(n), np.diff(offsets))
    key = mix64(elements ^ _STEP)
    place = (key & np.uint64(m - 1)).astype(np.int64)
    stride = ((key >> np.uint64(20)) & np.uint64(m - 1)).astype(np.int64) | 1
    value = np.zeros(len(key))
    state = key
    for j in range(m):
        if not len(owner):
            break
        state = state + _STEP
        uniform = ((mix64(state) >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
        value = value - np.log(uniform) / (m - j)
        np.minimum.at(smallest, owner * m + ((place + j * stride) & (m - 1)), value)
        alive = value < smallest.reshape(n, m).max(axis=1)[owner]
        if not alive.all():
            owner, place, stride, value, state = owner[alive], place[alive], stride[alive], value[alive], state[alive]
    with np.errstate(divide="ignore"):
        exponent = np.floor(1 - np.log(smallest / 16.0) / math.log(BASE))
    return np.clip(exponent, 0, 65535).astype(np.uint16).reshape(n, m)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union of two sets."""
    return np.maximum(a, b)


def estimate(above: np.ndarray, below: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Joint maximum-likelihood similarity from counts of greater and smaller registers and the set sizes."""
    total = np.maximum(size_a + size_b, 1).astype(np.float64)
    u, v = size_a / total, size_b / total
    equal = REGISTERS - above - below
    shrink = (BASE - 1) / BASE

    def p(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.clip(x, 1e-12, 1) * shrink) / math.log(BASE)

    def likelihood(j: np.ndarray) -> np.ndarray:
        greater, smaller = p(u - v * j), p(v - u * j)
        return above * np.log(greater) + below * np.log(smaller) + equal * np.log(np.maximum(1 - greater - smaller, 1e-12))

    low = np.zeros(len(total))
    high = np.minimum(np.divide(u, v, out=np.ones_like(u), where=v > 0), np.divide(v, u, out=np.ones_like(u), where=u > 0))
    for _ in range(24):
        a, b = low + (high - low) / 3, high - (high - low) / 3
        right = likelihood(a) < likelihood(b)
        low, high = np.where(right, a, low), np.where(right, high, b)
    return (low + high) / 2


def sketch_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, set_key (128 bits of the set, as two longs) and regs of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sub_batches(batches, "text"):
            elements, offsets = shingle_sets(*utf8_buffers(batch.column("text")))
            n = np.diff(offsets)
            first = np.concatenate([[np.uint64(0)], np.cumsum(mix64(elements ^ np.uint64(0x5BD1E995)))])
            second = np.concatenate([[np.uint64(0)], np.cumsum(mix64(elements * _STEP + np.uint64(1)))])
            keys = [pa.array((c[offsets[1:]] - c[offsets[:-1]]).view(np.int64)) for c in (first, second)]
            regs = sketches(elements, offsets)
            columns = [batch.column("doc_id"), pa.array(n.astype(np.int64)), *keys, binary_array(regs, np.arange(len(n) + 1) * (2 * REGISTERS))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "key1", "key2", "regs"])

    rows = text_rows(docs, id_col, text_col)
    return rows.mapInArrow(run, "doc_id long, n_shingles long, key1 long, key2 long, regs binary")


def _registers(column: pa.Array) -> np.ndarray:
    data, _ = utf8_buffers(column)
    return data.view(np.uint16).reshape(-1, REGISTERS)


def _band_keys(regs: np.ndarray) -> np.ndarray:
    """n x BANDS bucket keys."""
    out = np.empty((len(regs), BANDS), np.uint64)
    for band in range(BANDS):
        key = np.full(len(regs), band + 1, np.uint64)
        for value in regs[:, band * ROWS : (band + 1) * ROWS].T:
            key = mix64(key * _STEP + value)
        out[:, band] = key
    return out


def _buckets(classes: DataFrame) -> DataFrame:
    """bucket, rep: each class in each of its band buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                keys = _band_keys(_registers(batch.column("regs")))
                reps = np.repeat(batch.column("rep").to_numpy(), BANDS)
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), pa.array(reps)], ["bucket", "rep"])

    return classes.select("rep", "regs").mapInArrow(run, "bucket long, rep long")


class _Linker:
    """Confirms proposed pairs on registers, then on full sets."""

    def __init__(self, docs: DataFrame, classes: DataFrame, live_ids: DataFrame, num: int, den: int):
        self.num, self.den = num, den
        threshold = num / den
        self.least = threshold - SLACK * math.sqrt(threshold * (1 - threshold) / REGISTERS)
        self.classes = classes
        n = live_ids.count()
        ids = F.broadcast(live_ids) if n <= BROADCAST_IDS else live_ids
        self.sets = materialize(self._sets(docs.join(ids, docs.doc_id == live_ids.rep, "left_semi")), "shingle-sets")

    @staticmethod
    def _sets(docs: DataFrame) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in sub_batches(batches, "text"):
                elements, offsets = shingle_sets(*utf8_buffers(batch.column("text")))
                keep = np.flatnonzero(np.diff(offsets))
                out = pa.RecordBatch.from_arrays([batch.column("doc_id"), binary_array(elements, offsets * 8)], ["rep", "shingles"])
                yield out.take(pa.array(keep))

        return docs.select("doc_id", "text").mapInArrow(run, "rep long, shingles binary")

    def _side(self, table: DataFrame, name: str, *columns: str) -> DataFrame:
        return table.select(F.col("rep").alias(name), *(F.col(c).alias(f"{c}_{name}") for c in columns))

    def estimated(self, pairs: DataFrame) -> DataFrame:
        """Of pairs (a, b) those whose estimate can reach the threshold."""
        least, num, den = self.least, self.num, self.den

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    x, y = _registers(batch.column("regs_a")), _registers(batch.column("regs_b"))
                    p, q = batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy()
                    j = estimate((x > y).sum(axis=1), (x < y).sum(axis=1), p, q)
                    keep = (j >= least) & (np.minimum(p, q) * den >= np.maximum(p, q) * num)
                    yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep))

        both = pairs.join(self._side(self.classes, "a", "regs", "n"), "a").join(self._side(self.classes, "b", "regs", "n"), "b")
        return both.select("a", "b", "regs_a", "regs_b", "n_a", "n_b").mapInArrow(run, "a long, b long")

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) with ``linked``, judged on their full sets."""
        num, den = self.num, self.den

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                linked = np.zeros(batch.num_rows, bool)
                sides = [utf8_buffers(batch.column(c)) for c in ("shingles_a", "shingles_b")]
                for i in range(batch.num_rows):
                    x, y = (data[at[i] : at[i + 1]].view(np.uint64) for data, at in sides)
                    both = np.sort(np.concatenate([x, y]), kind="stable")
                    common = int((both[1:] == both[:-1]).sum())
                    linked[i] = den * common >= num * (len(both) - common)
                yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(linked)], ["a", "b", "linked"])

        both = pairs.join(self._side(self.sets, "b", "shingles"), "b").join(self._side(self.sets, "a", "shingles"), "a")
        return materialize(both.select("a", "b", "shingles_a", "shingles_b").mapInArrow(run, "a long, b long, linked boolean"), "judged", narrow=True)


def _with_salts(counts: DataFrame, total: int) -> DataFrame:
    """``counts`` (bucket, n) of ``total`` rows with ``salts``: 1, or more for a hot bucket.

    Fewer than HOT_BUCKETS buckets can hold more than a HOT_BUCKETS-th of all rows, so the list of hot ones is bounded.
    """
    limit = max(HOT_ROWS, total // HOT_BUCKETS)
    return counts.withColumn("salts", F.when(F.col("n") > limit, F.ceil(F.col("n") / limit)).otherwise(1).cast("int"))


def _salted(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """``rows`` with their own ``salt`` among the ``salts`` that ``counts`` gives their bucket."""
    hot = counts.filter("salts > 1").select("bucket", "salts")
    return rows.join(F.broadcast(hot), "bucket", "left").withColumn("salt", F.pmod(F.xxhash64("rep"), F.coalesce("salts", F.lit(1))).cast("int")).drop("salts")


def _spread(per_bucket: DataFrame) -> DataFrame:
    """One row of each bucket (with ``salts``) for each of its salts."""
    return per_bucket.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))


def _mixed(live: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows (bucket, salts, salt, rep, comp) of the buckets that still hold more than one component."""
    joined = live.join(labels.withColumnRenamed("node", "rep"), "rep", "left").withColumn("comp", F.coalesce("label", "rep")).drop("label")
    several = joined.groupBy("bucket", "salts").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1")).filter("c0 <> c1")
    return joined.join(_spread(several.select("bucket", "salts")).drop("salts"), ["bucket", "salt"], "left_semi")


def _pivot_pairs(rows: DataFrame) -> DataFrame:
    """Pairs of each class with the smallest of its bucket, where their components differ."""
    pivot = rows.groupBy("bucket", "salts").agg(F.min(F.struct(F.col("rep").alias("pivot"), F.col("comp").alias("pivot_comp"))).alias("p"))
    pairs = rows.join(_spread(pivot).drop("salts"), ["bucket", "salt"]).filter("rep <> p.pivot and comp <> p.pivot_comp")
    return pairs.select(F.least("rep", "p.pivot").alias("a"), F.greatest("rep", "p.pivot").alias("b"))


def frequencies(sets: DataFrame) -> np.ndarray:
    """How often shingles fall in each of 2**FREQUENCY_BITS slots, over ``sets`` (shingles)."""
    slots, shift = 1 << FREQUENCY_BITS, np.uint64(64 - FREQUENCY_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(slots, np.int64)
        for batch in batches:
            if batch.num_rows:
                data, _ = utf8_buffers(batch.column("shingles"))
                total += np.bincount((data.view(np.uint64) >> shift).astype(np.int64), minlength=slots)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], ["slot", "n"])

    found = sets.select("shingles").mapInArrow(run, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(slots, np.int64)
    out[found.column("slot").to_numpy()] = found.column("n").to_numpy()
    return out


def prefix_rows(sets: DataFrame, num: int, den: int) -> DataFrame:
    """bucket (a shingle), rep, comp: each set (rep, comp, shingles) under its rarest shingles.

    Two sets whose similarity is num / den or more share at least one of these.
    """
    shared, shift = sets.sparkSession.sparkContext.broadcast(frequencies(sets)), np.uint64(64 - FREQUENCY_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sub_batches(batches, "shingles"):
            data, at = utf8_buffers(batch.column("shingles"))
            elements, sizes = data.view(np.uint64), np.diff(at) // 8
            owner = np.repeat(np.arange(len(sizes)), sizes)
            order = np.lexsort((elements, shared.value[(elements >> shift).astype(np.int64)], owner))
            place = np.arange(len(order)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            keep = place < (sizes + (-num * sizes) // den + 1)[owner]
            whose = pa.array(owner[keep])
            yield pa.RecordBatch.from_arrays([pa.array(elements[order[keep]].view(np.int64)), batch.column("rep").take(whose), batch.column("comp").take(whose)], ["bucket", "rep", "comp"])

    return sets.select("rep", "comp", "shingles").mapInArrow(run, "bucket long, rep long, comp long")


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Sorted rows again, cut so that no run of equal keys is torn, with the n + 1 bounds of the runs."""
    rest: list[pa.RecordBatch] = []

    def bounds(batch: pa.RecordBatch) -> np.ndarray:
        new = np.zeros(batch.num_rows, bool)
        for k in keys:
            column = batch.column(k).to_numpy()
            new[1:] |= column[1:] != column[:-1]
        return np.concatenate([[0], np.flatnonzero(new), [batch.num_rows]])

    for batch in batches:
        if not batch.num_rows:
            continue
        whole = pa.concat_batches([*rest, batch])
        at = bounds(whole)
        rest = [whole.slice(int(at[-2]))]
        if len(at) > 2:
            yield whole.slice(0, int(at[-2])), at[:-1]
    if rest:
        yield rest[0], np.array([0, rest[0].num_rows])


def _cross_links(rest: DataFrame, classes: DataFrame, linker: _Linker, nodes: DataFrame, known: DataFrame) -> list[DataFrame]:
    """All links between different components among the classes of ``rest``: frames of (a, b, linked).

    Classes are grouped by their rarest shingles. A group's largest component is never
    compared with itself; the others meet all of the group in blocks of BLOCK rows, so no
    task holds a group. Pairs of others are confirmed one by one, as are few members of the
    largest component near a class; for more of them that component's full sets are searched.
    """
    members = materialize(rest.groupBy("rep").agg(F.first("comp").alias("comp")), "members", narrow=True)
    # The sets are read twice, so they are not shuffled where the members can be broadcast.
    sets = linker.sets.join(F.broadcast(members), "rep") if members.count() <= BROADCAST_IDS else materialize(linker.sets.join(members, "rep"), "member-sets")
    rows = materialize(prefix_rows(sets, linker.num, linker.den), "prefixes")
    several = rows.groupBy("bucket").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1"), F.count("*").alias("n")).filter("c0 <> c1").select("bucket", "n")
    several = materialize(_with_salts(several, rows.count()), "prefix-groups", narrow=True)
    salted = _salted(rows, several).join(_spread(several.drop("n")), ["bucket", "salt"])

    sizes = salted.groupBy("bucket", "salts", "comp").agg(F.count("*").alias("n"))
    main = sizes.groupBy("bucket", "salts").agg(F.max(F.struct("n", "comp")).alias("top"), F.sum("n").alias("total"))
    blocks = lambda n: F.ceil(n / BLOCK).cast("int")
    placed = salted.join(_spread(main).drop("salts"), ["bucket", "salt"]).select(
        "bucket", "rep", "comp", (F.col("comp") != F.col("top.comp")).alias("other"), blocks(F.col("total")).alias("home_blocks"), blocks(F.col("total") - F.col("top.n")).alias("guest_blocks")
    )
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = lambda n: F.pmod(F.xxhash64("rep"), F.col(n)).cast("int")
    homes = placed.withColumn("home", own("home_blocks")).withColumn("guest", every("guest_blocks")).withColumn("is_guest", F.lit(False))
    guests = placed.filter("other").withColumn("guest", own("guest_blocks")).withColumn("home", every("home_blocks")).withColumn("is_guest", F.lit(True))
    columns = ["bucket", "home", "guest", "rep", "comp", "other", "is_guest"]
    met = homes.select(columns).unionByName(guests.select(columns)).join(classes.select("rep", "regs", "n"), "rep")
    least, num, den = linker.least, linker.num, linker.den
    keys = ["bucket", "home", "guest"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, at in _groups(batches, keys):
            is_guest, other = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("is_guest", "other"))
            rep, comp, n = (batch.column(c).to_numpy() for c in ("rep", "comp", "n"))
            regs = _registers(batch.column("regs"))

            def judged(left: list[np.ndarray], right: list[np.ndarray]) -> pa.RecordBatch:
                g, h = np.concatenate(left), np.concatenate(right)
                x, y = regs[h], regs[g]
                near = estimate((x > y).sum(axis=1), (x < y).sum(axis=1), n[h], n[g]) >= least
                g, h = g[near], h[near]
                main = ~other[h]
                many = np.bincount(g[main], minlength=len(rep)) > FEW
                single = (main & ~many[g]) | (other[h] & (rep[h] > rep[g]))
                asked = np.flatnonzero(many)
                a = np.concatenate([np.minimum(rep[g[single]], rep[h[single]]), rep[asked]])
                b = pa.array(np.concatenate([np.maximum(rep[g[single]], rep[h[single]]), rep[asked]]), mask=np.arange(len(a)) >= single.sum())
                of_main = {int(i): int(comp[j]) for i, j in zip(g[main], h[main])}
                return pa.RecordBatch.from_arrays([pa.array(a), b, pa.array([None] * int(single.sum()) + [of_main[i] for i in asked.tolist()], pa.int64())], ["a", "b", "comp"])

            left, right, held = [], [], 0
            for first, last in zip(at[:-1].tolist(), at[1:].tolist()):
                g, h = first + np.flatnonzero(is_guest[first:last]), first + np.flatnonzero(~is_guest[first:last])
                g, h = np.repeat(g, h.size), np.tile(h, g.size)
                fit = (comp[g] != comp[h]) & (np.minimum(n[g], n[h]) * den >= np.maximum(n[g], n[h]) * num)
                left.append(g[fit])
                right.append(h[fit])
                held += int(fit.sum())
                if held > 20_000:
                    yield judged(left, right)
                    left, right, held = [], [], 0
            if held:
                yield judged(left, right)

    found = materialize(dealt(met, *keys).sortWithinPartitions(*keys).mapInArrow(compare, "a long, b long, comp long"), "cross", narrow=True)
    pairs = found.filter("b is not null").select("a", "b").distinct().join(known, ["a", "b"], "left_anti")

    # Classes against whole components, on full sets.
    asked = found.filter("comp is not null").select("a", "comp").distinct()
    labelled = classes.select("rep").distinct().join(nodes.withColumnRenamed("node", "rep"), "rep", "left").select("rep", F.coalesce("label", "rep").alias("comp"))
    members = labelled.join(asked.select("comp").distinct(), "comp", "left_semi")
    home_blocks = members.groupBy("comp").agg(blocks(F.count("*")).alias("home_blocks"))
    planned = home_blocks.join(asked.groupBy("comp").agg(blocks(F.count("*")).alias("guest_blocks")), "comp")
    inside = members.join(planned, "comp").withColumn("home", own("home_blocks")).withColumn("guest", every("guest_blocks")).withColumn("is_guest", F.lit(False))
    outside = asked.withColumnRenamed("a", "rep").join(planned, "comp").withColumn("guest", own("guest_blocks")).withColumn("home", every("home_blocks")).withColumn("is_guest", F.lit(True))
    columns = ["comp", "home", "guest", "rep", "is_guest"]

    def search(table: pa.Table) -> pa.Table:
        guest, rep = table.column("is_guest").to_numpy(), table.column("rep").to_numpy()
        data, at = utf8_buffers(table.column("shingles"))
        sets = [data[i:j].view(np.uint64) for i, j in zip(at[:-1].tolist(), at[1:].tolist())]
        home = np.flatnonzero(~guest)
        a, b = [], []
        if home.size:
            n = np.array([len(sets[k]) for k in home])
            keys = np.concatenate([sets[k] for k in home])
            order = np.argsort(keys, kind="stable")
            keys, owners = keys[order], np.repeat(np.arange(home.size), n)[order]
            for g in np.flatnonzero(guest).tolist():
                low, high = np.searchsorted(keys, sets[g], "left"), np.searchsorted(keys, sets[g], "right")
                runs = high - low
                spots = np.repeat(low - (np.cumsum(runs) - runs), runs) + np.arange(int(runs.sum()))
                common = np.bincount(owners[spots], minlength=home.size)
                hit = np.flatnonzero(den * common >= num * (n + len(sets[g]) - common))
                if hit.size:  # one link joins the class to the whole component
                    a.append(int(min(rep[g], rep[home[hit[0]]])))
                    b.append(int(max(rep[g], rep[home[hit[0]]])))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "linked": pa.array([True] * len(a), pa.bool_())})

    searched = dealt(inside.select(columns).unionByName(outside.select(columns)).join(linker.sets, "rep"), "comp", "home", "guest").groupBy("comp", "home", "guest").applyInArrow(search, "a long, b long, linked boolean")
    return [linker.confirmed(pairs), materialize(searched, "searched", narrow=True)]


def _same_document(usable: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (a, b) between the classes of documents whose id several different texts share."""
    keys = F.struct("key1", "key2")
    several = usable.groupBy("doc_id").agg(F.min(keys).alias("k0"), F.max(keys).alias("k1")).filter("k0 <> k1").select("doc_id")
    several = materialize(several, "repeated-ids", narrow=True)
    if several.isEmpty():
        return several.select(F.col("doc_id").alias("a"), F.col("doc_id").alias("b"))
    mine = usable.select("doc_id", "key1", "key2").join(several, "doc_id").distinct().join(classes.select("key1", "key2", "rep"), ["key1", "key2"])
    return mine.select(F.col("rep").alias("a"), F.col("doc_id").alias("b")).filter("a <> b").distinct()


def near_duplicates(docs: DataFrame, num: int = 85, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row, linked where den * common >= num * union.

    A hot text is one class; its rows meet their class through a join that AQE may split.
    """
    docs = text_rows(docs, id_col, text_col)
    rows = materialize(sketch_documents(docs), "sketches")
    usable = rows.filter("n_shingles > 0 and doc_id is not null")
    classes = usable.groupBy("key1", "key2").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("regs").alias("regs"))
    classes = materialize(classes, "classes")
    buckets = _buckets(classes)
    shared = buckets.groupBy("bucket").agg(F.min("rep").alias("pivot"), F.max("rep").alias("top"), F.count("*").alias("n")).filter("pivot <> top").select("bucket", "pivot", "n")
    shared = materialize(_with_salts(shared, classes.count() * BANDS).drop("n"), "shared-buckets")
    live = _salted(buckets, shared).join(_spread(shared), ["bucket", "salt"]).select("bucket", "salts", "salt", "rep", "pivot")
    live = materialize(live, "live-buckets")
    linker = _Linker(docs, classes, live.select("rep").distinct(), num, den)

    # Round one: each class and the pivot that most of its buckets name.
    votes = live.filter("rep <> pivot").groupBy("rep", "pivot").agg(F.count("*").alias("votes"))
    best = votes.groupBy("rep").agg(F.max(F.struct("votes", -F.col("pivot"))).alias("v")).select((-F.col("v.col2")).alias("a"), F.col("rep").alias("b"))
    live = live.drop("pivot")
    judged = [linker.confirmed(linker.estimated(best))]
    nodes = components(judged[0].filter("linked").select("a", "b").unionByName(_same_document(usable, classes)))
    # Then each bucket's pivot, between components only; then all that is left.
    for by_pivot in (True, False):
        rest = materialize(_mixed(live, nodes), "mixed-buckets", narrow=True)
        if rest.isEmpty():
            break
        known = union_all(judged)
        if by_pivot:
            judged.append(linker.confirmed(linker.estimated(_pivot_pairs(rest).distinct().join(known, ["a", "b"], "left_anti"))))
            links = judged[-1]
        else:
            links = union_all(_cross_links(rest, classes, linker, nodes, known))
        links = links.filter("linked").select("a", "b")
        if not links.isEmpty():
            nodes = components(links.unionByName(nodes.select(F.col("node").alias("a"), F.col("label").alias("b"))))

    labelled = classes.join(nodes, classes.rep == nodes.node, "left").select("key1", "key2", F.coalesce("label", "rep").alias("class_component"))
    joined = rows.join(labelled, ["key1", "key2"], "left")
    component = F.when(F.col("n_shingles") > 0, F.coalesce("class_component", "doc_id")).otherwise(F.col("doc_id"))
    component = F.when(F.col("doc_id").isNotNull(), component)
    return joined.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_first(docs: DataFrame, num: int = 80, den: int = 100) -> DataFrame:
    """``docs`` with one document of each group of near duplicates, that of the smallest doc_id.

    Of repeated rows of that doc_id all stay; rows with a null doc_id stay.
    """
    found = near_duplicates(docs, num, den).filter("not kept").select(F.col("doc_id").alias("gone")).distinct()
    rows = packed_rows(docs, F.col("doc_id").cast("long").alias("key")).join(found, F.col("key") == F.col("gone"), "left_anti")
    return opened_rows(rows, docs.columns)
