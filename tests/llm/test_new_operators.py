"""Filter audit, rule ensemble and hard negatives against brute force and SQL; scores and scratch tables that must not vary."""

import glob
import itertools
import os
import random
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quillgraph.llm import common, filter_audit, hard_negatives, queries, rule_ensemble, scan, secret_ledger, toxicity
from tests.llm.test_odd_rows import CLASHING, SCHEMA, plain_and_toxic

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LABELS = "doc_id long, quality int, toxic int"


def by_sql(name, **tables):
    connection = duckdb.connect()
    for table in ("documents", "labels", "embeddings"):
        if table in tables:
            connection.register(table, tables[table])
        else:
            connection.sql(f"create view {table} as select * from '{SF}/{table}.parquet'")
    relation = connection.sql(queries.oracle_sql()[name])
    at = sorted(range(len(relation.columns)), key=lambda i: relation.columns[i])
    return sorted(tuple(r[i] for i in at) for r in relation.fetchall())


def rows_of(frame):
    names = sorted(frame.columns)
    return sorted(tuple(r[c] for c in names) for r in frame.collect())


@pytest.mark.parametrize("name", ["op11_filter_audit", "op13_hard_negatives"])
def test_equals_sql(spark, name):
    assert rows_of(queries.queries()[name](spark, SF)) == by_sql(name)


def random_texts(rng, n):
    pieces = ["a", "b", "ab", "ba", "é", "B", "XY", "漢", "#", "a|b", " ", "  ", "\n", "\t", "\x0b", "\x00", " ", "x" * 40]
    return ["".join(rng.choice(pieces) + rng.choice(["", " "]) for _ in range(rng.randrange(0, 160))) for _ in range(n)]


def plain_mask(text):
    words = WORD.findall(text)
    fails = [len(words) < 50, 100 * len(set(words)) < 65 * len(words), 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text), any(c in "#$%&*|" for c in text)]
    return sum(f << k for k, f in enumerate(fails))


def test_masks_equal_plain_filters(monkeypatch):
    texts = [*random_texts(random.Random(4), 300), "", None, "w " * 70, " ".join(f"w{i}" for i in range(60))]
    expected = [plain_mask(t or "") for t in texts]
    assert filter_audit.failures(pa.array(texts)).tolist() == expected
    # Words longer than a piece, and hashes that all collide, are counted by the words themselves.
    long = ["q" * 40 + " " + "r" * 40 + " " + "q" * 40] * 2 + texts
    monkeypatch.setattr(scan, "PIECE", 32)
    assert filter_audit.failures(pa.array(long)).tolist() == [plain_mask(t or "") for t in long]
    monkeypatch.setattr(filter_audit, "span_hashes", lambda data, start, end: np.zeros(len(start), np.uint64))
    assert filter_audit.failures(pa.array(texts)).tolist() == expected


def test_audit_of_odd_rows_equals_filtering_in_every_order(spark):
    rng = random.Random(5)
    texts = random_texts(rng, 25)
    docs = [(i, rng.choice(texts), rng.choice(["s", "t", "", None])) for i in range(120)] + [(3, texts[0], "s"), (3, texts[0], "s"), (None, texts[1], "s"), (None, texts[1], None), (500, None, "t"), (501, None, "t")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 120, 2)] + [(4, 1, 0), (None, 1, 1)]
    marks = {}
    for i, quality, toxic in labels:
        if i is not None:
            good, bad = marks.get(i, (0, 0))
            marks[i] = (max(good, quality or 0), max(bad, toxic or 0))
    first = {}
    for i, text, _ in docs:
        if i is not None:
            first[text or ""] = min(first.get(text or "", i), i)
    kinds = [(part or "", plain_mask(text or "") + 16 * (i is not None and i > first[text or ""]), *marks.get(i, (0, 0))) for i, text, part in docs]
    expected = set()
    for part in {k[0] for k in kinds}:
        here, shapley, steps = [k for k in kinds if k[0] == part], dict.fromkeys("ABCDE", 0), []
        for order in itertools.permutations("ABCDE"):
            kept = here
            for step, letter in enumerate(order, 1):
                bit = 1 << "ABCDE".index(letter)
                gone = [k for k in kept if k[1] & bit]
                redundant = sum(k[1] & bit > 0 for k in here) - len(gone)
                kept = [k for k in kept if not k[1] & bit]
                shapley[letter] += len(gone)
                steps.append((part, "".join(order), step, letter, len(kept), len(gone), redundant, sum(k[1] == bit for k in here), sum(k[2] for k in gone), sum(k[3] for k in gone)))
        expected |= {(*s[:3], *s[4:], shapley[s[3]]) for s in steps}
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string").withColumns({c: F.lit(7) for c in [*CLASHING, "part", "mask", "digest"]})
    known = spark.createDataFrame(labels, LABELS).withColumn("part", F.lit(1))
    found = filter_audit.audit(frame, known)
    assert {tuple(r) for r in found.collect()} == expected
    assert filter_audit.audit(frame.limit(0), known).count() == 0
    assert all(r.kept == 0 or r.good_lost == 0 for r in filter_audit.audit(frame, known.limit(0)).filter("step = 1").collect())
    kept = filter_audit.remove_failing(frame, "AD").select("doc_id", "text").collect()
    assert sorted(map(repr, kept)) == sorted(repr(r) for r in frame.select("doc_id", "text").collect() if not plain_mask(r.text or "") & 9)


def test_rules_and_their_column_agree_with_plain_statistics(spark):
    rng = random.Random(9)
    texts = [*random_texts(rng, 40), "", None, "w w w w x", "one\ntwo\none\n"]
    x = rule_ensemble.statistics(pa.array(texts))
    for row, text in zip(x, texts):
        words, lines = WORD.findall(text or ""), [line for line in (text or "").split("\n") if line]
        n = max(len(words), 1)
        pairs = list(zip(words, words[1:]))
        plain = {
            "log_words": np.log1p(len(words)),
            "log_lines": np.log1p(len(lines)),
            "mean_word": sum(len(w.encode()) for w in words) / n,
            "distinct_words": 1 - (len(words) - len(set(words))) / n,
            "distinct_pairs": 1 - (len(pairs) - len(set(pairs))) / max(len(pairs), 1),
            "distinct_lines": 1 - (len(lines) - len(set(lines))) / max(len(lines), 1),
            "same_as_before": sum(a == b for a, b in pairs) / n,
            "capitals": sum("A" <= c <= "Z" for c in text or "") / max(len(text or ""), 1),
        }
        assert {k: pytest.approx(v) for k, v in plain.items()} == {k: row[rule_ensemble.STATISTICS.index(k)] for k in plain}
    y = np.array([i % 3 > 0 for i in range(len(x))], np.int64)
    x = np.concatenate([x] * 6)
    ensemble = rule_ensemble.Ensemble.fit(x, np.concatenate([y] * 6), np.arange(len(x)) % 3, 0.6)
    frame = spark.createDataFrame([tuple(map(float, r)) for r in x[: len(texts)]], ", ".join(f"{s} double" for s in rule_ensemble.STATISTICS))
    assert [r.score for r in frame.select(ensemble.column().alias("score")).collect()] == pytest.approx(ensemble.score(x[: len(texts)]).tolist())
    assert ensemble.rules and all(any(rule.holds(x)) for rule, _ in ensemble.rules)


def test_lasso_leaves_few_weights():
    rng = np.random.default_rng(2)
    x = rng.standard_normal((600, 30))
    y = (x[:, 3] - x[:, 7] + 0.3 * rng.standard_normal(600) > 0).astype(np.int64)
    weights = rule_ensemble.lasso(x, y, np.ones(600), 0.05)
    assert set(np.flatnonzero(weights[:-1])) == {3, 7}


def good_and_bad(n):
    rng = random.Random(12)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) for _ in range(800)]

    def text(good):
        if good:
            return " ".join(rng.choice(words) for _ in range(80)) + "."
        return rng.choice([lambda: " ".join(rng.choice(words) + "###" for _ in range(60)), lambda: " ".join([rng.choice(words)] * 90)])()

    return [(i, text(i % 4 > 0)) for i in range(n)], [(i, int(i % 4 > 0), 0) for i in range(n)]


def test_quality_on_held_out_and_odd_rows(spark):
    rows, labels = good_and_bad(600)
    odd = [(None, rows[1][1]), (None, None), (9000, ""), (9001, rows[2][1]), (9001, rows[0][1]), (9002, "x" * 300_000), (1, rows[1][1])]
    docs = spark.createDataFrame([*rows, *odd], "doc_id long, text string").withColumns({c: F.lit(7) for c in [*CLASHING, "quality", "good", "log_words"]})
    known = spark.createDataFrame([*labels, (None, 0, 0), (2, None, 0), (5, 0, 0)], LABELS)
    found = rule_ensemble.score_held_out(docs, known).collect()
    assert len(found) == len(rows) + len(odd)
    for r in found:
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
    held = [r for r in found if r.held_out and r.doc_id < 600]
    assert len(held) > 100 and all(r.predicted == (r.doc_id % 4 > 0) for r in held)
    assert {r.predicted for r in found if r.doc_id is None and r.score > 0.9} == {1}
    assert rule_ensemble.score_documents(docs.limit(0), known).count() == 0
    shares = {r.score for r in rule_ensemble.score_documents(docs, known.filter("quality = 1")).collect()}
    assert shares == {1.0}
    assert {r.score for r in rule_ensemble.score_documents(docs, known.limit(0)).collect()} == {0.0}


@pytest.mark.parametrize("score", ["toxicity", "rules"])
def test_scores_do_not_depend_on_partitions(spark, score):
    rows, labels, say = plain_and_toxic(300)
    # Near copies: groups that share their smallest shingle, with different texts.
    rows += [(1000 + i, rows[i][1] + f" zounder tail{i % 7}", "en", "s", 1) for i in range(300) if i % 3 == 0]
    labels = [(i, t, t) for i, t in labels] + [(1000 + i, t, t) for i, t in labels if i % 3 == 0]
    docs, known = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, LABELS)
    found = []
    for n in ("4", "13"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        shuffled = docs.repartition(int(n)).orderBy(F.xxhash64("doc_id", F.lit(n)))
        model = toxicity.score_documents(shuffled, known) if score == "toxicity" else rule_ensemble.score_documents(shuffled, known)
        found.append(rows_of(model))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert found[0] == found[1]


def brute_negatives(rows, every, positives, negatives):
    kept = {}
    for i, label, vector in rows:
        if i is None or label is None or vector is None or any(v is None or not np.isfinite(v) for v in vector):
            continue
        key = (label, vector)
        kept[i] = min(kept.get(i, key), key)
    whole = {i: (label, [int(np.floor(256 * v)) for v in vector]) for i, (label, vector) in kept.items()}
    out = []
    for a, (label, v) in whole.items():
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, other) for i, (other, w) in whole.items() if i != a)
        for ps, p, _ in [s for s in scored if s[2] == label][:positives]:
            fit = [(s, i) for s, i, other in scored if other != label and 50 * -ps <= 100 * -s <= 95 * -ps][:negatives]
            out += [(a, p, rank, i, -ps, -s) for rank, (s, i) in enumerate(fit, 1)]
    return sorted(out)


@pytest.mark.parametrize("tree, leaf, lane, block", [(4096, 64, 2048, 1 << 15), (64, 4, 7, 6)])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, tree, leaf, lane, block):
    rng = random.Random(21)
    some = [[round(rng.gauss(0, 0.5), 2) for _ in range(6)] for _ in range(60)]
    rows = [(i, rng.randrange(3), rng.choice(some) if rng.random() < 0.5 else [rng.gauss(0, 0.5) for _ in range(rng.choice([6, 6, 6, 5]))]) for i in range(400)]
    rows += [(400 + i, i % 2, some[0]) for i in range(200)]  # one hot vector
    rows += [(i, rng.randrange(3), some[3]) for i in range(0, 40, 5)]  # repeated ids
    rows += [(700, 1, None), (701, None, some[0]), (None, 1, some[0]), (702, 1, [1.0, None]), (703, 1, [float("nan")]), (704, 1, [float("inf"), 1.0]), (705, 1, []), (710, 2, [])]
    monkeypatch.setattr(hard_negatives, "TREE", tree)
    monkeypatch.setattr(hard_negatives, "LANE", lane)
    monkeypatch.setattr(hard_negatives, "LEAF", leaf)
    frame = spark.createDataFrame(rows, "vec_id long, label int, vector array<double>").withColumns({c: F.lit(7) for c in CLASHING if c != "label"})
    found = hard_negatives.mine(frame, every=10, block=block)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, found.collect())) == brute_negatives(rows, 10, 5, 3)
    assert hard_negatives.mine(frame.limit(0)).count() == 0


def test_trees_leave_out_nodes_and_stay_exact():
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((20, 8)) * 900
    vectors = np.floor(centres[np.repeat(np.arange(20), 200)] + rng.standard_normal((4000, 8)) * 20).astype(np.int32)
    ids, labels = np.arange(4000), np.repeat(np.arange(20), 200) % 5
    at = np.arange(0, 4000, 50)
    asked = hard_negatives.Queries(ids[at], labels[at], vectors[at], np.arange(len(at)), np.full(len(at), -(1 << 60)), np.full(len(at), 1 << 60), True, 5)
    visited = []
    merge = asked._merge
    asked._merge = lambda lane, score, *rest: (visited.append(score.size), merge(lane, score, *rest))[1]
    asked.visit(hard_negatives.BallTree.build(ids, labels, vectors))
    full = vectors[at].astype(np.int64) @ vectors.T.astype(np.int64)
    full[labels[at][:, None] != labels] = np.iinfo(np.int64).min
    full[np.arange(len(at)), at] = np.iinfo(np.int64).min
    assert (asked.found == np.lexsort((np.broadcast_to(ids, full.shape), -np.maximum(full, -(1 << 62))), axis=1)[:, :5]).all()
    assert sum(visited) < 0.5 * len(at) * 4000


def test_known_texts_are_not_packed_again(spark, tmp_path):
    texts = [(i, f"password: hunter2hunter{i % 40} in text {i % 40}") for i in range(200)]
    docs, more = spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame([*texts, (900, "token=abcdefghij")], "doc_id long, text string")
    path = f"file://{tmp_path}/ledger"
    first = secret_ledger.report(docs, path).count()
    rows = more.select(secret_ledger._blob(F.col("text")).alias("blob"), "text")
    known = secret_ledger._read(spark, f"{path}/blobs", secret_ledger.BLOBS)
    assert first == 200 and known.count() == 40
    assert secret_ledger.new_texts(rows.filter("text not like 'token%'"), known).count() == 0
    assert secret_ledger.new_texts(rows, known).count() == 1
    assert secret_ledger.new_texts(rows, None).count() == 201
    again = secret_ledger.report(more, path)
    assert again.count() == 201 and again.filter("n_assign = 1").count() == 201


def test_nothing_is_left_after_clear_scratch(spark):
    common.clear_scratch(spark)
    folder = common.shared_dir(spark).removeprefix("file://")
    before = set(glob.glob(f"{folder}/*"))
    for name in ("op5_secrets", "op8_token_store", "op10_warc", "op12_rule_ensemble", "op13_hard_negatives"):
        assert queries.queries()[name](spark, SF).count() > 0
    docs = spark.createDataFrame([(1, "token=abcdefghij")], "doc_id long, text string")
    assert secret_ledger.redact(docs).first().text == "<secret>"
    assert any("secret-ledger" in p for p in set(glob.glob(f"{folder}/*")) - before)
    common.clear_scratch(spark)
    assert set(glob.glob(f"{folder}/*")) <= before
    assert not any("secret-ledger" in p or "token-shards" in p or "warc-" in p for p in glob.glob(f"{folder}/*") if os.path.isdir(p) and p not in before)
