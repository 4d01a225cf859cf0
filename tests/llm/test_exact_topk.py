"""Exact top-k against all inner products; the index against its own proof."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from envlake.llm.exact_topk import ImpactIndex, _best, matrix, top_k

SCHEMA = "vec_id long, embedding array<float>, row int, q string, score double"


def slow(rows, k, every):
    """Sorted (query id, rank, id, score) of all rows."""
    ok = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v, *_r in rows
          if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (qi, qv) in enumerate(ok):
        if qi is None or qi % every:
            continue
        s = sorted((-sum(x * y for x, y in zip(qv, v)), i is None, i or 0) for b, (i, v) in enumerate(ok) if b != a)
        out += [(qi, r, None if none else i, -sc) for r, (sc, none, i) in enumerate(s[:k], 1)]
    return sorted(out, key=str)


def got(df):
    return sorted(((r.query_id, r["rank"], r.vec_id, r.score) for r in df.collect()), key=str)


def clustered(n, d, seed):
    rnd = np.random.default_rng(seed)
    centres = rnd.normal(0, .2, (6, d))
    x = centres[rnd.integers(0, 6, n)] + rnd.normal(0, .05, (n, d))
    x[n // 2: n // 2 + 20] = x[0]  # ties
    return [(i, [float(v) for v in r], 1, "x", .5) for i, r in enumerate(x.astype(np.float32))]


@pytest.mark.parametrize("components", [1 << 19, 40 * 16])
def test_all_blocks_and_ties(spark, components):
    rows = clustered(400, 16, 3)
    df = spark.createDataFrame(rows, SCHEMA)
    out = top_k(df, F.col("vec_id") % 10 == 0, block_components=components)
    assert out.columns == ["query_id", "rank", "vec_id", "score"]
    assert got(out) == slow(rows, 5, 10)


def test_awkward_vectors(spark):
    rest = (1, "x", .5)
    rows = [(0, [1.0, -2.0, .5], *rest), (0, [1.0, -2.0, .5], *rest), (1, None, *rest), (2, [1.0, None], *rest), (4, [float("nan"), 1.0], *rest),
            (5, [float("inf")], *rest), (6, [], *rest), (7, [3.0], *rest), (8, [-.001, .001, 0.0, 9.0], *rest), (None, [1.0, -2.0, .5], *rest),
            (10, [0.0, 0.0], *rest), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    for every in (1, 2):
        assert got(top_k(df, F.col("vec_id") % every == 0, k=4)) == slow(rows, 4, every)
    assert top_k(df.limit(0), F.lit(True)).count() == 0
    assert top_k(df, F.lit(None).cast("boolean")).count() == 0
    assert top_k(spark.createDataFrame(rows[:1], SCHEMA), F.lit(True)).count() == 0  # no other row
    with pytest.raises(Exception, match="not summed exactly"):
        top_k(spark.createDataFrame([(1, [1e9], *rest), (2, [1e9], *rest)], SCHEMA), F.lit(True)).collect()


def test_index_takes_segments_by_impact_and_stops_early():
    rows = clustered(3000, 32, 9)
    x = matrix([np.floor(256 * np.array(r[1])) for r in rows])
    index = ImpactIndex(x)
    assert (np.diff(index.level) <= 0).all() and len(index.doc) == np.count_nonzero(x)
    planes = list(index.bands())
    # All segments together are the vectors, but for half a level; the norms are what is left.
    assert np.abs(sum(p for p, _t in planes) - x).max() <= (index.width - 1) / 2
    assert planes[-1][1].max() < 1e-3
    q, own = x[:40], np.arange(40)
    found = index.search(q, own, 5)
    for j, (cand, scores) in enumerate(found):
        exact = x @ q[j]
        assert (scores == exact[cand]).all() and j not in cand
        exact[j] = -np.inf
        best = sorted(range(len(x)), key=lambda i: (-exact[i], i))[:5]
        assert [int(cand[i]) for i in _best(cand, scores, list(range(len(x))), np.arange(len(x)), 5)] == best
    assert np.mean([len(c) for c, _s in found]) < len(x) / 8
