"""The CRF against enumeration of all labellings, and held-out labels."""

import itertools
import zlib

import numpy as np
from common_rows import frame, ids

from envlake.llm.crf_quality import WIDTH, _padded, _scores, fit, forward_backward, keep_good, loss_and_gradient, score_quality, text_matrix, train
from envlake.llm.queries import op10_quality

SF = "/root/testdata/sf0.1"


def enumerated(emit, trans):
    """Marginals, pair marginals and log partition from every labelling."""
    n = len(emit)
    total, single, pairs = 0.0, np.zeros((n, 2)), np.zeros((2, 2))
    for y in itertools.product((0, 1), repeat=n):
        p = np.exp(sum(emit[i, c] for i, c in enumerate(y)) + sum(trans[a, b] for a, b in zip(y, y[1:])))
        total += p
        for i, c in enumerate(y):
            single[i, c] += p
        for a, b in zip(y, y[1:]):
            pairs[a, b] += p
    return single / total, pairs / total, np.log(total)


def test_forward_backward_matches_enumeration():
    rnd = np.random.default_rng(0)
    lengths = np.array([1, 2, 5, 8])
    emit, trans = rnd.normal(0, 3, (4, 8, 2)), rnd.normal(0, 2, (2, 2))
    gamma, pairs, logz = forward_backward(emit, trans, lengths)
    want = [enumerated(emit[k, :n], trans) for k, n in enumerate(lengths)]
    for k, n in enumerate(lengths):
        assert np.allclose(gamma[k, :n], want[k][0]) and np.allclose(gamma[k, n:], 0) and np.isclose(logz[k], want[k][2])
    assert np.allclose(pairs, sum(w[1] for w in want))


def test_gradient_by_finite_differences():
    rnd = np.random.default_rng(8)
    batches = []
    for t in (1, 4, 7):
        n = np.minimum(rnd.integers(1, t + 1, 6), t)
        batches.append((rnd.normal(0, 1, (6, t, 3)), n, rnd.integers(0, 2, 6), rnd.uniform(.5, 2, 6)))
    w, tr = rnd.normal(0, 1, (3, 2)), rnd.normal(0, 1, (2, 2))
    _, gw, gt = loss_and_gradient(batches, w, tr, 0.01)
    for p, g in ((w, gw), (tr, gt)):
        for i in np.ndindex(p.shape):
            step = np.zeros_like(p)
            step[i] = 1e-6
            at = lambda s: loss_and_gradient(batches, w + s if p is w else w, tr + s if p is tr else tr, 0.01)[0]  # noqa: B023,E731
            assert np.isclose(g[i], (at(step) - at(-step)) / 2e-6, atol=1e-6)
    # The likelihood itself, from every labelling.
    x, n, y, weight = batches[1]
    want = sum(k * (enumerated(x[d, :m] @ w, tr)[2] - (x[d, :m] @ w)[:, c].sum() - (m - 1) * tr[c, c]) / m
               for d, (m, c, k) in enumerate(zip(n, y, weight))) / len(n)
    assert np.isclose(loss_and_gradient(batches[1:2], w, tr, 0.0)[0], want)


def test_long_sequences_do_not_underflow():
    gamma, _, logz = forward_backward(np.full((1, 50_000, 2), -40.0), np.zeros((2, 2)), np.array([50_000]))
    assert np.allclose(gamma, 0.5) and np.isfinite(logz).all()


def test_padding_covers_every_document_once():
    mats = [np.ones((n, 3), np.float32) for n in (0, 4, 1, 900, 2, 0, 30)]
    seen = [(i, int(n)) for ids_, _, ns in _padded(mats, 50) for i, n in zip(ids_, ns)]
    assert sorted(seen) == [(1, 4), (2, 1), (3, 900), (4, 2), (6, 30)]


def test_lines_see_their_neighbours():
    m, size = text_matrix(b"First line here.\n\n \nSECOND!!\nthird | line")
    assert m.shape == (3, WIDTH) and size.tolist() == [16, 8, 12]
    k = (WIDTH - 3) // 3
    assert (m[0, k:2 * k] == 0).all() and (m[1, k:2 * k] == m[0, :k]).all() and (m[1, 2 * k:3 * k] == m[2, :k]).all() and (m[2, 2 * k:3 * k] == 0).all()
    assert text_matrix(None)[0].shape == (0, WIDTH)


def test_score_is_the_length_weighted_mean():
    rnd = np.random.default_rng(1)
    good, bad = b"plain words stand in a row here.", b"| %% $$ && ## %%"
    mats = [text_matrix(b"\n".join([(good if y else bad)] * int(rnd.integers(1, 6))))[0] for y in (0, 1) * 40]
    model = fit(mats, np.array([0, 1] * 40), steps=60)
    text = b"\n".join([good, bad, good * 3])
    m, size = text_matrix(text)
    p = model.line_marginals([m])[0]
    assert np.isclose(_scores(model, [text])[0], (p * size).sum() / size.sum())
    assert _scores(model, [good, bad])[0] > 0.9 and _scores(model, [good, bad])[1] < 0.1


def test_held_out_labels(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = op10_quality(spark, SF).collect()
    assert len(rows) == 10000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    pairs = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean([p for y, p in pairs if y]) > 0.98 and np.mean([p for y, p in pairs if not y]) < 0.05


def test_awkward_rows(spark):
    docs = spark.createDataFrame([(i, "plain words stand in a row here.\nand more." if i % 2 else "| %% $$ && ##\n%% ||") for i in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(1, 0), (None, 1), (2, None)], "doc_id long, quality int")
    model = train(docs, labels)
    assert {r.doc_id: r.predicted for r in score_quality(docs, model).collect()} == {i: i % 2 for i in range(60)}
    out = score_quality(frame(spark), model)
    assert ids(out) == ids(frame(spark)) and {r.score for r in out.where("doc_id in (2, 3, 4)").collect()} == {0.0}
    kept = keep_good(frame(spark), model)
    assert kept.columns == frame(spark).columns and ids(kept) == ids(out.where("predicted = 1"))
    assert score_quality(frame(spark, []), model).count() == 0 and keep_good(frame(spark, []), model).count() == 0
    assert train(docs, labels.where("quality = 1 and doc_id <> 1")) is None
    assert {r.score for r in score_quality(docs, None).collect()} == {1.0}
