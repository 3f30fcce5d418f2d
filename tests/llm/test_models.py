"""The quality classifier and the toxicity model: held-out accuracy, gradients and odd rows."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from fathomseq.llm import quality, toxicity

DATA = "/root/testdata/sf0.1"
ODD = "doc_id long, text string, quality int, toxic int, score string, label string"


@pytest.fixture(scope="module")
def tables(spark):
    return (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))


def held_out(rows, column, folds, fold):
    own = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == fold) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    return np.array([r[column] for r in own]), np.array([r.predicted for r in own])


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.score_quality(docs, quality.train(docs, labels, per_class=600)).join(labels, "doc_id").collect()
    truth, said = held_out(rows, "quality", 3, 1)
    assert (truth == said).mean() > 0.98
    rows = toxicity.score_toxicity(docs, toxicity.train(docs, labels)).join(labels, "doc_id").collect()
    truth, said = held_out(rows, "toxic", 5, 0)
    assert (truth == said).mean() > 0.93


def test_located_sentences(spark):
    rows = [(i, f"Fine words here. {'You utter blockhead number %d! ' % i if i % 2 else ''}More of the day.\nThe end.", 0, i % 2, "", "") for i in range(200)]
    docs = spark.createDataFrame(rows, ODD)
    scored = toxicity.score_toxicity(docs, toxicity.train(docs, docs)).collect()
    assert all(r.predicted == r.doc_id % 2 for r in scored)
    for r in scored:
        text = rows[r.doc_id][1].encode()
        assert [b"blockhead" in text[x.begin : x.end] for x in r.offending] == [True] * (r.doc_id % 2)


def test_odd_rows(spark):
    rows = [(1, "good plain words", 1, 0, "s", "l"), (1, "good plain words", 0, 1, "s", "l"), (2, None, None, None, None, None), (3, "", 1, 1, "", ""), (None, "bad !!! words", 0, 1, "", ""), (4, "word " * 200_000, 0, 0, "", "")]
    docs = spark.createDataFrame(rows, ODD)
    for train, score in ((quality.train, quality.score_quality), (toxicity.train, toxicity.score_toxicity)):
        for labels in (docs, docs.limit(0)):
            out = score(docs, train(docs, labels)).collect()
            assert sorted((r.doc_id or 0) for r in out) == [0, 1, 1, 2, 3, 4]
            assert all(0 <= r.score <= 1 for r in out)
        assert score(docs.limit(0), train(docs, docs)).count() == 0
    assert quality.keep_good(docs, quality.train(docs, docs)).columns == docs.columns


def test_features_do_not_depend_on_neighbours():
    r = random.Random(1)
    texts = [" ".join(r.choice(["Ab", "cd!!", "É", "|", "x"]) for _ in range(r.randrange(9))) for _ in range(50)] + [None, "", "  "]
    found, at = quality.features(pa.array(texts))
    for i, t in enumerate(texts):
        alone, _ = quality.features(pa.array([t], pa.string()))
        assert np.array_equal(found[at[i] : at[i + 1]], alone)
    whole = toxicity.Sentences.of(pa.array(texts))
    for i, t in enumerate(texts):
        alone = toxicity.Sentences.of(pa.array([t], pa.string()))
        a, b = whole.first[i], whole.first[i + 1]
        assert np.array_equal(whole.features[whole.at[a] : whole.at[b]], alone.features)
        assert np.array_equal(whole.begin[a:b], alone.begin) and np.array_equal(whole.end[a:b], alone.end)


def test_dual_coordinate_descent_reaches_the_optimum():
    """Against plain gradient descent on the squared hinge loss over the same scaled rows."""
    r = np.random.default_rng(3)
    y = r.integers(0, 2, 80)
    rows = [np.unique(np.concatenate([r.integers(0, 40, 6), [50 + v] * (r.random() < 0.8)])).astype(int) for v in y]
    model = quality.fit(rows, y, mixed=1.0, rounds=2000)
    size = 1 << quality.FEATURE_BITS
    counts = [1 + np.bincount(np.concatenate([x for x, v in zip(rows, y, strict=True) if v == c]), minlength=size) for c in (1, 0)]
    ratio = np.log(counts[0] / counts[0].sum()) - np.log(counts[1] / counts[1].sum())
    x = np.zeros((80, 60))
    for i, own in enumerate(rows):
        x[i, own] = ratio[own]
    x = np.column_stack([x, np.ones(80)]) / np.sqrt((x**2).sum(1) + 1)[:, None]
    sign = np.where(y == 1, 1.0, -1.0)
    cost = 1 / (np.where(y == 1, y.mean(), 1 - y.mean()) * 2)
    w = np.zeros(61)
    for _ in range(20_000):
        slack = np.maximum(0, 1 - sign * (x @ w))
        w -= 0.003 * (w - 2 * (cost * slack * sign) @ x)
    assert np.allclose(model.weights[:60], w[:60] * ratio[:60], atol=1e-2)
