"""The language and toxicity models against plain scorers in Python loops."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest

from quillgraph.llm import langid, toxicity


def test_nearest_centroid_by_plain_cosines(spark):
    rng = random.Random(4)
    alphabets = {"aa": "abcde", "bb": "cdefg", "cc": "xyzab"}
    rows = [(" ".join("".join(rng.choice(alphabets[k]) for _ in range(rng.randrange(2, 7))) for _ in range(20)), k) for _ in range(60) for k in alphabets]
    model = langid.fit(spark.createDataFrame(rows, "text string, lang string"))
    texts = [t for t, _ in rows[:50]] + ["", None, "12 34", "x", "漢字", "abc " * 5000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r for r in langid.predict(docs, model).collect()}
    for i, (buckets, counts) in enumerate(langid.Vectors.counts(texts)):
        if not len(buckets):
            assert (found[i].lang_pred, found[i].score) == ("und", 0.0)
            continue
        weights = langid._weighted(buckets, counts, model.idf)
        vector = {int(b): float(w) for b, w in zip(buckets, weights)}
        assert math.sqrt(sum(v * v for v in vector.values())) == pytest.approx(1, abs=1e-5)
        cosines = [sum(v * float(c[b]) for b, v in vector.items()) for c in model.centroids]
        best = max(range(len(cosines)), key=lambda k: cosines[k])
        assert found[i].score == pytest.approx(min(max(cosines[best], 0), 1), abs=1e-5)
        close = {model.langs[model.owner[k]] for k, c in enumerate(cosines) if c > cosines[best] - 1e-6}
        assert found[i].lang_pred in close
    right = sum(found[i].lang_pred == rows[i][1] for i in range(50))
    assert right >= 45


def plain_tree(tree, row):
    feature, cut, value = tree
    node = 0
    while node < len(feature) and feature[node] >= 0:
        node = 2 * node + 1 + int(row[feature[node]] > cut[node])
    return value[node]


def test_trees_by_a_plain_walk_and_isotonic_by_its_definition():
    rng = np.random.default_rng(5)
    x = rng.standard_normal((300, len(toxicity.FEATURES))).astype(np.float32)
    x[:, 2] = np.maximum(x[:, 2], 0)
    y = ((x[:, 0] + x[:, 2] > 0.5) ^ (rng.random(300) < 0.1)).astype(np.int64)
    w = rng.random(300) + 0.5
    trees = toxicity.Trees.fit(x, y, w)
    plain = [trees.base + sum(plain_tree(t, row) for t in trees.trees) for row in x]
    assert trees.raw(x) == pytest.approx(plain)
    score = np.round(rng.standard_normal(40), 1)
    label, weight = (score + rng.standard_normal(40) > 0).astype(float), rng.random(40) + 0.1
    xs, ys = toxicity.isotonic(score, label, weight)
    levels = sorted(set(score))
    mass = [weight[score == s].sum() for s in levels]
    total = [(weight * label)[score == s].sum() for s in levels]
    for i, s in enumerate(levels):  # the greatest of the least averages of the ranges around it
        fitted = max(min(sum(total[a : b + 1]) / sum(mass[a : b + 1]) for b in range(i, len(levels))) for a in range(i + 1))
        assert np.interp(s, xs, ys) == pytest.approx(fitted)


def test_features_by_plain_counts():
    texts = ["You are an IDIOT!! really, 1d1ot", "plain words here", "", None, "ß É ?!", "STUPID fool you you"]
    weights = toxicity._Weights(dict.fromkeys(["idiot", "stupid", "fool"], 2.0))
    got = toxicity.features(pa.array(texts), weights)
    at = toxicity.FEATURES.index
    for row, text in zip(got, texts):
        raw, words = (text or "").encode(), toxicity.WORD.findall(text or "")
        n, hits = max(len(words), 1), [k for k, w in enumerate(words) if weights[w][0] > 0]
        you = [k for k, w in enumerate(words) if w in toxicity.SECOND_PERSON] if hits else []
        near = sum(any(abs(h - y) <= toxicity.NEAR for y in you) for h in hits)
        plain = {
            "log_words": math.log1p(len(words)), "density": len(hits) / n, "near_second_person": near / n, "second_person": len(you) / n,
            "capitals": sum(65 <= b <= 90 for b in raw) / max(len(raw), 1), "digits": sum(48 <= b <= 57 for b in raw) / max(len(raw), 1), "other_bytes": sum(b > 127 for b in raw) / max(len(raw), 1),
            "exclaim": sum(b in b"!?" for b in raw) / max(len(raw), 1), "repeated": 1 - len(set(words)) / n, "hidden_hits": sum(weights[w][1] for w in words) / n,
        }
        assert {k: row[at(k)] for k in plain} == pytest.approx(plain, abs=1e-6)
    assert got[0][at("hidden_hits")] > 0
