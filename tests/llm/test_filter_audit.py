"""The audit against applying the filters one after the other, and the subset walk
against direct sums."""

import random
import re
from collections import Counter
from itertools import permutations

import numpy as np
from common_rows import LONG, frame, row

from envlake.llm.filter_audit import COUNTS, FILTERS, filter_audit, subset_states, text_failures


def fails(rows):
    """doc place -> letters failed, by the definitions."""
    out = []
    for i, (doc, text, *_r) in enumerate(rows):
        t = text or ""
        ws = re.findall(r"[^\x20\x09-\x0D]+", t)
        f = {"A": len(ws) < 50, "B": 100 * len(set(ws)) < 65 * len(ws), "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
             "D": re.search(r"[#$%&*|]", t) is not None,
             "E": doc is not None and any(o is not None and o < doc and (u or "") == t for o, u, *_x in rows)}
        out.append({k for k, v in f.items() if v})
    return out


def slow(rows, labels):
    lost = fails(rows)
    good, toxic = ({d for d, *v in labels if d is not None and v[k] == 1} for k in (0, 1))
    out, shapley = {}, Counter()
    parts = {r[3] or "" for r in rows}
    for part in parts:
        mine = [i for i, r in enumerate(rows) if (r[3] or "") == part]
        for order in permutations(FILTERS):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [i for i in left if f in lost[i]]
                left = [i for i in left if f not in lost[i]]
                n_fail = sum(f in lost[i] for i in mine)
                out[part, "".join(order), step] = [len(left), len(gone), n_fail - len(gone), sum(lost[i] == {f} for i in mine),
                                                   sum(rows[i][0] in good for i in gone), sum(rows[i][0] in toxic for i in gone)]
                shapley[part, f] += len(gone)
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def got(df):
    return {(r.part, r.filter_order, r.step): tuple(r[c] for c in COUNTS) for r in df.collect()}


def test_against_applying_the_filters(spark):
    rnd = random.Random(7)
    words = [f"w{i}" for i in range(90)]
    texts = [" ".join(rnd.sample(words, rnd.randrange(30, 90))) for _ in range(12)] + ["A B C " * 30, "same " * 60, "x y # z", "", None]
    rows = [row(rnd.randrange(60), rnd.choice(texts) if rnd.random() < .7 else rnd.choice(texts[:12]) + rnd.choice((" #", " AB" * 9, "")), source=rnd.choice(("a", "b", None)))
            for _ in range(120)]
    labels = [(rnd.choice((*range(60), None)), rnd.choice((0, 1, None)), rnd.choice((0, 1, None))) for _ in range(50)]
    df = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert got(filter_audit(frame(spark, rows), df)) == slow(rows, labels)


def test_awkward_rows(spark):
    from common_rows import awkward
    labels = spark.createDataFrame([(5, 1, 0), (8, 0, 1), (8, None, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    rows = awkward()
    rows = rows + [row(None, "no id here", None, None), row(99, LONG)]
    out = filter_audit(frame(spark, rows), labels)
    assert got(out) == slow(rows, [(5, 1, 0), (8, 0, 1), (8, None, 1), (None, 1, 1)])
    assert out.columns == ["part", "filter_order", "step", *COUNTS]
    assert filter_audit(frame(spark, []), labels).count() == 0
    assert filter_audit(frame(spark), labels.limit(0)).where("good_lost + toxic_lost > 0").count() == 0


def test_walk_equals_direct_sums():
    rnd = np.random.default_rng(5)
    for k in (1, 3, 5):
        masks = np.arange(1 << k)[rnd.random(1 << k) < .8]
        cells = rnd.integers(0, 50, (len(masks), 3))
        states = subset_states(masks, cells, k)
        for s in range(1 << k):
            assert (states[s] == cells[(masks & s) == 0].sum(axis=0)).all()


def test_word_and_case_rules():
    assert text_failures(b"", 0) == 1
    assert text_failures("é".encode() * 3, 3) == 1
    sixty = " ".join(f"a{i}" for i in range(60)).encode()
    assert text_failures(sixty, len(sixty)) == 0
    assert text_failures(sixty + b" |", len(sixty) + 2) == 8
