"""Base counts against plain Python; the robust estimate against planted outliers
and an exhaustive small case."""

import itertools
import random
import re

import numpy as np
from common_rows import frame, ids
from pyspark.sql import functions as F

from envlake.llm.mcd_quality import (
    FEATURES, SUPPORT, TAIL_Z, Z, _COUNTS, _chi2_cdf, _normal_quantile, _up_to_rank, chi2_quantile, mcd, robust_quality, text_stats)


def slow_counts(text):
    t = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    inside = set()
    for i, w in enumerate(windows):
        if windows.count(w) > 1:
            inside |= set(range(i, i + 5))
    lines = t.split("\n")
    dup = sum(1 for i, x in enumerate(lines) if re.search(r"[^\x20\x09-\x0D]", x) and x in lines[:i])
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(inside)


def test_counts_match_plain_python():
    rnd = random.Random(1)
    texts = ["", None, " ", "a\x85b c", "é ñ # * $", "a\n\nb\na\n \n \na", "x " * 12, "\x0b\x0c\x1cq"]
    for _ in range(200):
        texts.append("".join(rnd.choice(["a ", "b ", "cc ", "\n", "#", "é ", "a b a b a b "]) for _ in range(rnd.randrange(60))))
    for t in texts:
        assert text_stats(None if t is None else t.encode())[:5] == slow_counts(t), repr(t)


def test_planted_outliers_are_rejected_and_clean_ones_kept(spark):
    rnd = random.Random(7)
    vocab = [a + b + c for a in "abcdefgh" for b in "aeiou" for c in ("", "n", "rs", "tion")]

    def prose(n):
        return ". ".join(" ".join(rnd.choice(vocab) for _ in range(12)).capitalize() for _ in range(n)) + "."

    rows = [(i, prose(rnd.randrange(3, 40)), rnd.choice(["en", "de"]), rnd.choice(["a", "b"])) for i in range(800)]
    bad = [(1000 + i, " | ".join(rnd.choice(vocab) + "%%%" for _ in range(80)), "en", "a") for i in range(40)]
    few = [(2000 + i, prose(5), "xx", f"s{i}") for i in range(6)]
    df = spark.createDataFrame(rows + bad + few + [(3000, "too short", "en", "a"), (3001, "same five words come again " * 20, "en", "a")],
                               "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in robust_quality(df).collect()}
    assert len(got) == 848
    assert not any(got[1000 + i].kept for i in range(40))
    assert sum(not got[i].kept for i in range(800)) <= 4
    assert all(got[2000 + i].kept and got[2000 + i].distance is None for i in range(6))
    assert got[3000].base_failed and got[3001].base_failed and not got[3000].kept and not got[3001].kept


def test_estimate_is_not_moved_by_outliers(spark):
    """The steps end near the moments of the regular rows; classical moments do not."""
    rnd = np.random.default_rng(0)
    good = rnd.normal(0, 1, (600, len(Z)))
    bad = rnd.normal(12, 1, (150, len(Z)))
    rows = [("=en", "=a", *map(float, x)) for x in np.vstack([good, bad])]
    est = mcd(spark.createDataFrame(rows, "g_lang string, g_source string, " + ", ".join(f"{z} double" for z in Z))).collect()
    assert len(est) == 1
    mean = np.array([est[0][f"m{i}"] for i in range(len(Z))])
    assert np.abs(mean - good.mean(axis=0)).max() < 0.3 < np.vstack([good, bad]).mean(axis=0).min()
    inv = np.array([[est[0][f"v{min(i, j)}_{max(i, j)}"] for j in range(len(Z))] for i in range(len(Z))])
    cov = np.linalg.inv(inv) - np.diag([s * s for s in FEATURES.values()])
    assert 0.6 < np.diag(cov).min() and np.diag(cov).max() < 1.6


def vectors(spark, x, parts=3, group="=a"):
    return spark.createDataFrame([("=en", group, *map(float, r)) for r in x], "g_lang string, g_source string, " + ", ".join(f"{z} double" for z in Z)).repartition(parts)


def central():
    return SUPPORT / _chi2_cdf(chi2_quantile(len(Z), _normal_quantile(SUPPORT)), len(Z) + 2)


def of_subset(x):
    c = np.cov(x.T, bias=True) * central() + np.diag([s * s for s in FEATURES.values()])
    return x.mean(axis=0), c, np.linalg.slogdet(c)[1]


def test_estimate_equals_the_best_of_all_subsets(spark):
    """Every support set of a small group is tried."""
    rnd = np.random.default_rng(3)
    for seed, bad in enumerate((0, 3)):
        x = rnd.normal(0, 1, (12, len(Z)))
        x[:bad] += rnd.choice([-9, 9], (bad, len(Z)))
        best = min((of_subset(x[list(c)]) for c in itertools.combinations(range(12), 9)), key=lambda e: e[2])
        est = mcd(vectors(spark, x, 1 + seed)).first()
        if bad == 3:
            assert abs(est.logdet - best[2]) < 1e-9
            assert np.allclose([est[f"m{i}"] for i in range(len(Z))], best[0])
        assert est.logdet > best[2] - 1e-9


def test_steps_end_at_a_standstill(spark):
    """A further step by plain numpy, with the exact rank, changes nothing; ties and copies count each."""
    rnd = np.random.default_rng(5)
    x = np.vstack([rnd.standard_t(3, (700, len(Z))), np.repeat(rnd.normal(2, 0.3, (6, len(Z))), 60, axis=0)])
    for parts in (1, 7):
        est = mcd(vectors(spark, x, parts)).first()
        inv = np.array([[est[f"v{min(i, j)}_{max(i, j)}"] for j in range(len(Z))] for i in range(len(Z))])
        d = x - np.array([est[f"m{i}"] for i in range(len(Z))])
        d2 = np.einsum("ni,ij,nj->n", d, inv, d)
        cut = np.sort(d2)[int(np.ceil(SUPPORT * len(x))) - 1]
        assert abs(of_subset(x[d2 <= cut * (1 + 1e-12)])[2] - est.logdet) < 1e-6


def test_ranks_are_exact_beyond_the_sketch(spark):
    """Groups larger than the sketch, with ties: the cut is the value of the very rank."""
    df = spark.range(300000).selectExpr("id % 3 g", "cast(case when id % 3 = 0 then pmod(hash(id), 7) else pmod(xxhash64(id), 1000003) / 7 end as double) d2")
    x = df.repartition(13).toPandas()
    for share in (0.5, 0.75, 1.0):
        got = {r.g: (r.cut, r.n) for r in _up_to_rank(df, ["g"], share, {"n": F.lit(1)}).collect()}
        for g, f in x.groupby("g"):
            cut = np.sort(f.d2.values)[int(np.ceil(share * len(f))) - 1]
            assert got[g] == (cut, int((f.d2 <= cut).sum()))


def test_verdicts_follow_the_distances(spark):
    """``distance`` and ``kept`` from the estimates by plain numpy."""
    rnd = random.Random(11)
    docs = [(i, " ".join(rnd.choice(["ab", "cde", "f?", "Gh", "#"]) + str(rnd.randrange(9)) for _ in range(rnd.randrange(20, 200)))
             + "".join(f" %&|{k}%%%%!!!!" for k in range(150 if i % 40 == 0 else 0)), "en", "a") for i in range(400)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")
    x = np.array([text_stats(t.encode())[5:] for _, t, _, _ in docs])
    ok = {r.doc_id: r for r in robust_quality(df).collect()}
    keep = np.array([not ok[i].base_failed for i in range(400)])
    est = mcd(vectors(spark, x[keep])).first()
    inv = np.array([[est[f"v{min(i, j)}_{max(i, j)}"] for j in range(len(Z))] for i in range(len(Z))])
    d = x - np.array([est[f"m{i}"] for i in range(len(Z))])
    d2 = np.einsum("ni,ij,nj->n", d, inv, d)
    middle = np.sort(d2[keep])[int(np.ceil(keep.sum() / 2)) - 1]
    dist = d2 / max(middle / chi2_quantile(len(Z), 0.0), 1.0)
    for i in np.flatnonzero(keep):
        assert abs(ok[i].distance - dist[i]) < 1e-6 * (1 + dist[i]) and ok[i].kept == (dist[i] <= chi2_quantile(len(Z), TAIL_Z))
    assert 0 < sum(not ok[i].kept for i in np.flatnonzero(keep)) < 30


def test_awkward_rows(spark):
    got = robust_quality(frame(spark))
    assert ids(got) == ids(frame(spark)) and set(_COUNTS) <= set(got.columns)
    assert all(r.base_failed and not r.kept for r in got.where("doc_id in (2, 3, 4)").collect())
    assert robust_quality(frame(spark, [])).count() == 0
