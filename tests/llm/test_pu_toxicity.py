"""The non-negative PU risk: its gradient step, planted words, and held-out labels."""

import random
import zlib

import numpy as np
import pytest
from common_rows import frame, ids
from pyspark.sql import functions as F

from envlake.llm.pu_toxicity import Model, nnpu_fit, nnpu_risks, nnpu_step, score_toxicity, select_features, text_features, train, word_features, words_of
from envlake.llm.queries import fold, op5_toxicity

SF = "/root/testdata/sf0.1"


def test_words_and_features():
    assert words_of("You IDIOT### a1b ñandú".encode()) == {b"you", b"idiot", b"a", b"b", "ñandú".encode()}
    assert words_of(None) == set() and len(text_features(b"")) == 0
    assert set(word_features(b"loser")) & set(word_features(b"losers"))


def test_unlabelled_positives_do_not_hide_the_signal():
    """U holds a third hidden positives; plain P-against-U would score them down."""
    rnd = np.random.default_rng(0)

    def draw(n, p):
        y = rnd.random(n) < p
        x = (rnd.random((n, 6)) < np.where(y[:, None], [0.9, 0.8, 0.5, 0.5, 0.3, 0.1], [0.05, 0.1, 0.5, 0.5, 0.3, 0.1])).astype(np.float32)
        return x, y
    pos, _ = draw(800, 1.0)
    unl, _ = draw(3000, 0.33)
    w, b = nnpu_fit(pos, unl, 0.33)
    x, y = draw(4000, 0.33)
    score = 1 / (1 + np.exp(-(x @ w + b)))
    assert ((score > 0.5) == y).mean() > 0.9 and score[y].mean() > 0.8


def test_step_is_the_gradient_of_the_risk():
    """By finite differences, and on both sides of zero."""
    rnd = np.random.default_rng(6)
    pos, unl = rnd.normal(1, 1, (40, 3)), rnd.normal(0, 1, (90, 3))
    sides = set()
    for _ in range(30):
        w, prior = rnd.normal(0, 2.5, 4), rnd.uniform(.1, .9)
        below = nnpu_risks(pos, unl, prior, w)[1] < 0
        sides.add(bool(below))

        def risk(v):
            p, n = nnpu_risks(pos, unl, prior, v)
            return -n if below else p + n
        eye = np.eye(4) * 1e-6
        want = [(risk(w + e) - risk(w - e)) / 2e-6 for e in eye]
        assert np.allclose(nnpu_step(pos, unl, prior, w), want, atol=1e-6)
    assert sides == {True, False}


def test_feature_choice_needs_evidence():
    rnd = np.random.default_rng(1)
    noise = lambda n: [np.sort(rnd.choice(5000, 60, replace=False)).astype(np.int32) for _ in range(n)]
    pos = [np.append(x, 9000 + i % 2).astype(np.int32).tobytes() for i, x in enumerate(noise(300))]
    unl = [np.append(x, [9000] if i % 20 == 0 else []).astype(np.int32).tobytes() for i, x in enumerate(noise(1000))]
    assert select_features(pos, unl, 0.1, 300).tolist() == [9000, 9001]


@pytest.fixture(scope="module")
def held_out(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = op5_toxicity(spark, SF).collect()
    assert len(rows) == 10000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    return [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]


def test_held_out_labels(held_out):
    toxic = [p for y, p in held_out if y]
    clean = [p for y, p in held_out if not y]
    assert np.mean(toxic) > 0.75 and np.mean(clean) < 0.01  # few of the table's 450 labels are left for training


def test_held_out_labels_are_never_read(spark):
    """Changing every held-out label changes no score."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lab = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    flipped = lab.withColumn("toxic", F.when(fold(3) == 1, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert train(docs, lab, fold(3) != 1) == train(docs, flipped, fold(3) != 1)


def test_awkward_rows(spark):
    rnd = random.Random(1)
    docs = spark.createDataFrame([(i, " ".join(rnd.choice(["aa", "bb", "cc"]) for _ in range(9)) + (" vilest" if i % 5 == 0 else "")) for i in range(400)],
                                 "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(0, 300, 5)] + [(i, 0) for i in range(1, 300, 5)] * 5 + [(None, 1), (3, None), (0, 0)], "doc_id long, toxic int")
    model = train(docs, labels, prior=0.2)
    got = {r.doc_id: r.predicted for r in score_toxicity(docs, model).collect()}
    assert all(got[i] == (i % 5 == 0) for i in range(400))
    out = score_toxicity(frame(spark), model)
    assert ids(out) == ids(frame(spark)) and out.where("score is null").count() == 0
    assert score_toxicity(frame(spark, []), model).count() == 0
    none = train(docs, labels.where("false"))
    assert none == Model((), (), -40.0) and {r.predicted for r in score_toxicity(docs, none).collect()} == {0}
    assert train(frame(spark, []), labels).features == ()
