"""Odd rows for every corpus operator and pipeline stage: null and repeated ids, clashing names, ties, empty tables."""

import random

import pytest
from pyspark.sql import functions as F

from quillgraph.llm import common, decontam, langid, secret_ledger, setsketch, toxicity
from quillgraph.llm.common import fresh_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside themselves.
CLASHING = """rep bucket batch node label h pos blob comp shard path score kept findings toxic group id ids media row salt key gone clean some
    secret_blob secret_spans bad_id predicted feats version run todo packed spans rank run k component_id n_shingles regs""".split()


def plain_and_toxic(n=400):
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(200)]
    say = lambda toxic: " ".join([rng.choice(words) for _ in range(55)] + ["zounder"] * (5 if toxic else 0))
    return [(i, say(i % 5 == 0), "en", "s", 1) for i in range(n)], [(i, int(i % 5 == 0)) for i in range(n)], say


def test_shared_folder_on_a_cluster():
    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        common.shared_dir(Session())


def test_scratch_tables_go(spark):
    with common.scratch(spark) as keep:
        passing = common.materialize(spark.range(3), "passing")
        kept = keep(passing, "kept")
    assert kept.count() == 3
    with pytest.raises(Exception, match="PATH_NOT_FOUND|FILE_NOT_EXIST|does not exist"):
        spark.read.parquet(passing._scratch_path).count()


def test_toxicity_judges_each_row_by_its_own_text(spark):
    rows, labels, say = plain_and_toxic()
    odd = [(None, say(True), "x", "bad", 1), (None, say(False), "x", "good", 1), (None, None, "x", "none", 1), (7000, say(True), "x", "bad", 1), (7000, say(False), "x", "good", 1), (7001, say(False), "x", "twice", 1), (7001, say(False), "x", "twice", 1)]
    docs = spark.createDataFrame([*rows, *odd], SCHEMA).withColumns({c: F.lit(7) for c in CLASHING})
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    found = toxicity.reject_toxic(docs, known)
    assert found.columns == docs.columns
    assert sorted(r.source for r in found.filter("lang = 'x'").collect()) == ["good", "good", "none", "twice", "twice"]
    assert {r.doc_id for r in found.filter("lang = 'en'").collect()} == {i for i in range(400) if i % 5}
    assert toxicity.reject_toxic(docs.limit(0), known).count() == 0


def test_language_of_copies_alone_is_learned(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(["the", "thing", "with", "other", "thought"]) for _ in range(30)), "en") for i in range(300)]
    rows += [(1000 + i, "der nicht über schön ich der nicht", "de") for i in range(3000)]
    rows += [(5000 + i, "123 456", "no letters") for i in range(20)] + [(6000, "漢字 文字 語", "ja"), (6001, "漢字 文字 語", "ja"), (6005, "x" * 300_000, "long")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumns({c: F.lit(7) for c in CLASHING})
    found = {(r.doc_id >= 1000, r.lang_pred) for r in langid.identify(docs).filter("doc_id < 5000").collect()}
    assert found == {(False, "en"), (True, "de")}
    model = langid.fit(docs.select("text", "lang"))
    assert model.langs == ["de", "en", "ja", "long"]


def test_language_ties_go_to_the_first(spark):
    docs = spark.createDataFrame([(i, "same words in both", k) for i, k in enumerate(["b", "a"] * 30)], "doc_id long, text string, lang string")
    assert {r.lang_pred for r in langid.identify(docs).collect()} == {"a"}


SECRETS = ["a password: hunter2hunter2 here", "AKIA" + "A" * 16, "token=" + "z9" * 10]


def test_ledger_returns_all_paths_of_all_runs(spark):
    path = fresh_path(spark, "ledger")
    make = lambda rows: spark.createDataFrame(rows, "doc_id long, text string, v string")
    scan = lambda rows, rules=secret_ledger.RULES: {(r.path, r.version): len(r.findings) for r in secret_ledger.scan_versions(make(rows), path, rules, version_col="v").collect()}
    first = [(1, SECRETS[0], "v1"), (1, "clean now", "v2"), (2, "plain", "v1"), (None, SECRETS[1], None)]
    assert scan(first) == {(1, "v1"): 1, (1, "v2"): 0, (2, "v1"): 0, (None, None): 1}
    second = [(3, SECRETS[0], "v1"), (2, SECRETS[2], "v2"), (2, "plain", "v1")]
    assert scan(second) == {(1, "v1"): 1, (1, "v2"): 0, (2, "v1"): 0, (None, None): 1, (3, "v1"): 1, (2, "v2"): 1}
    # A raised rule version reaches texts of earlier runs, which are not handed in again.
    newer = (secret_ledger.Rule("assign", 2, "clean", 0, 1), *secret_ledger.RULES[1:])
    assert scan([], newer) == {(1, "v1"): 0, (1, "v2"): 1, (2, "v1"): 0, (None, None): 1, (3, "v1"): 0, (2, "v2"): 0}
    assert spark.read.parquet(path + "/findings").filter("rule = 'assign@2'").count() == 5


def test_ledger_makes_good_a_run_that_broke_off(spark, monkeypatch):
    path = fresh_path(spark, "ledger")
    docs = spark.createDataFrame([(1, SECRETS[0])], "doc_id long, text string")

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(secret_ledger, "_scan", fail)
        with pytest.raises(RuntimeError):
            secret_ledger.update(docs, path)
    assert [len(r.findings) for r in secret_ledger.scan_versions(docs.limit(0), path).collect()] == [1]


@pytest.mark.parametrize("limit", [32 << 20, 0])
def test_redaction_of_odd_rows(spark, monkeypatch, limit):
    monkeypatch.setattr(secret_ledger, "BROADCAST_BYTES", limit)
    rows = [(1, SECRETS[0], "en", "s", 9), (1, "clean", "en", "s", 5), (None, SECRETS[0], "en", "s", 9), (None, None, None, None, None), (2, "", "en", "", 0), (3, SECRETS[0], "en", "s", 9), (3, SECRETS[0], "en", "s", 9), (4, "é" * 200_000 + " " + SECRETS[1], "en", "s", 9)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(7) for c in CLASHING})
    found = secret_ledger.redact(docs)
    assert found.columns == docs.columns and found.count() == len(rows)
    texts = sorted((r.text or "") for r in found.collect())
    assert texts == sorted(["", "", "clean", *["a <secret> here"] * 4, "é" * 200_000 + " <secret>"])
    assert {(r.text is None, r.n_chars) for r in found.filter("doc_id is null").collect()} == {(True, None), (False, 15)}
    assert secret_ledger.redact(docs.limit(0)).count() == 0


def test_filters_of_odd_rows(spark):
    """keep_first and remove_contaminated: rows of a rejected doc_id all go, null ids stay, names may clash."""
    item = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(1, item, "en", "s", 1), (2, item, "en", "s", 1), (2, "another text of that id altogether here", "en", "s", 1), (None, item, "en", "s", 1), (None, None, None, None, None), (3, "", "en", "", 0)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(7) for c in [*CLASHING, "item_id", "items", "diagonal"]})
    kept = setsketch.keep_first(docs)
    assert kept.columns == docs.columns and sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [(False, 1), (False, 3), (True, 0), (True, 0)]
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    left = decontam.remove_contaminated(docs, benchmark)
    assert left.columns == docs.columns and sorted((r.doc_id is None, r.doc_id or 0) for r in left.collect()) == [(False, 3), (True, 0), (True, 0)]


def test_pipeline_stages_on_odd_rows(spark, tmp_path):
    import corpus_pipeline

    rows, labels, say = plain_and_toxic(100)
    rows += [(None, say(False), None, None, None), (None, None, None, None, None), (500, "", "en", "", 0), (501, SECRETS[0], "en", "s", 1), (501, SECRETS[0], "en", "s", 1), (502, "w" * 100_000, "en", "s", 1)]
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, "a b c d e f g h i j")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(7) for c in CLASHING})
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, str(tmp_path)).count() >= 86  # but for 20 toxic rows
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0
    spark.createDataFrame(rows, SCHEMA).limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def near(found):
    return sorted((r.doc_id, r.component_id, r.kept) for r in found.collect())


def test_texts_that_share_an_id_are_one_node(spark):
    a, b = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    rows = [(1, a), (2, a), (2, b), (3, b + " more"), (4, "something else"), (4, ""), (5, "x y z"), (6, "x y z"), (5, "p q r"), (9, "p q r")]
    found = setsketch.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert near(found) == [(1, 1, True), (2, 1, False), (2, 1, False), (3, 1, False), (4, 4, True), (4, 4, True), (5, 5, True), (5, 5, True), (6, 5, False), (9, 5, False)]


@pytest.mark.parametrize("salt_at", [1024, 8])
def test_many_unrelated_classes_in_one_bucket(spark, monkeypatch, salt_at):
    """5,000 texts that share a long passage: no pair is close, so few may be compared."""
    monkeypatch.setattr(setsketch, "HOT_ROWS", salt_at)
    rng = random.Random(6)
    shared = [f"s{i}" for i in range(120)]
    rows = [(i, " ".join(shared + [f"w{rng.randrange(10**9)}" for _ in range(60)])) for i in range(5000)]
    for k in range(20):  # some close pairs among them
        words = rows[100 * k][1].split()
        words[170] = "edit"
        rows.append((5000 + k, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    compared = []
    confirmed = setsketch._Linker.confirmed

    def counted(self, pairs):
        out = confirmed(self, pairs)
        compared.append(out.count())
        return out

    monkeypatch.setattr(setsketch._Linker, "confirmed", counted)
    sketched = setsketch.sketch_documents(docs.limit(1000))
    top = setsketch._buckets(sketched.select(F.col("doc_id").alias("rep"), "regs")).groupBy("bucket").count().agg(F.max("count")).first()[0]
    assert top > 200  # one bucket holds a good part of all
    found = setsketch.near_duplicates(docs)
    assert near(found) == [(i, 100 * (i - 5000) if i >= 5000 else i, i < 5000) for i in range(5020)]
    assert sum(compared) < 3 * len(rows)


def test_classes_near_a_large_component(spark, monkeypatch):
    """Leftover steps in small blocks: pairs of others, few members, and a search of the whole component."""
    for name, value in (("BLOCK", 4), ("FEW", 1), ("HOT_ROWS", 2), ("BROADCAST_IDS", 0)):
        monkeypatch.setattr(setsketch, name, value)
    rng = random.Random(12)
    base = [f"w{i}" for i in range(100)]
    rows = []
    for i in range(150):
        words = list(base)
        for _ in range(rng.randint(0, 6)):
            words[rng.randrange(100)] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    sets = [{tuple(t.split()[k : k + 5]) for k in range(96)} for _, t in rows]
    label = list(range(150))
    for i in range(150):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]) and label[i] != label[j]:
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    found = setsketch.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert near(found) == [(i, c, i == c) for i, c in enumerate(label)]
