"""Pfair schedules: windows, deviation, and the distributed places against a
slot-by-slot simulation."""

import math
import random

import numpy as np
import pytest
from common_rows import frame, ids

from envlake.llm.mixing import Flow, exact_slots, mix, mixed, period_slots, plan, quotas


def test_quotas_are_whole_and_complete():
    rnd = random.Random(1)
    for n in (1, 2, 7, 40):
        w = {f"s{i}": rnd.random() ** 4 + 1e-6 for i in range(n)}
        q = quotas(w, 1000)
        assert sum(q.values()) == 1000 and min(q.values()) >= 1
        total = sum(w.values())
        if n < 8:
            assert all(abs(q[s] - max(1, w[s] / total * 1000)) <= 2 for s in w)


def test_every_block_is_in_its_window_and_shares_hold():
    rnd = random.Random(2)
    for _ in range(30):
        n = rnd.randrange(1, 9)
        cuts = sorted(rnd.sample(range(1, 200), n - 1))
        quota = {f"s{i}": b - a for i, (a, b) in enumerate(zip([0, *cuts], [*cuts, 200]))}
        slots = period_slots(quota, 200)
        assert sorted(x for v in slots.values() for x in v) == list(range(200))
        for s, q in quota.items():
            for i, x in enumerate(slots[s]):
                assert i * 200 // q <= x < math.ceil((i + 1) * 200 / q)
            for t in range(201):
                assert abs(sum(x < t for x in slots[s]) - t * q / 200) < 1


def simulate(blocks, weights, period):
    """Slot by slot: the released block due earliest; a source that ran out starts a new phase."""
    left, out, slot = dict(blocks), {}, 0
    done = {s: 0 for s in blocks if blocks[s]}
    while done:
        p = max(period, 10 * len(done))
        q = quotas({s: weights[s] for s in done}, p)
        base, taken, begin = dict(done), dict.fromkeys(done, 0), slot
        while all(done[s] < left[s] for s in done):
            t = slot - begin
            ready = [s for s in sorted(done) if taken[s] * p // q[s] <= t]
            s = min(ready, key=lambda s: (-(-(taken[s] + 1) * p // q[s]), sorted(q).index(s)))
            out[s, base[s] + taken[s]] = slot
            taken[s] += 1
            done[s] += 1
            slot += 1
        done = {s: n for s, n in done.items() if n < left[s]}
    return out


def test_phases_match_the_simulation():
    rnd = random.Random(3)
    for _ in range(15):
        blocks = {f"s{i}": rnd.randrange(1, 120) for i in range(rnd.randrange(1, 6))}
        weights = {s: rnd.random() + 0.05 for s in blocks}
        want = simulate(blocks, weights, 50)
        got = {}
        phases = plan(blocks, weights, 50)
        for k, ph in enumerate(phases):
            for s, first in ph.first.items():
                last = phases[k + 1].first.get(s, blocks[s]) if k + 1 < len(phases) else blocks[s]
                total = sum(ph.quota.values())
                for b in range(first, last):
                    i = b - first
                    got[s, b] = ph.slot + i // ph.quota[s] * total + ph.slots[s][i % ph.quota[s]]
        assert got == want and sorted(got.values()) == list(range(sum(blocks.values())))


def docs(spark, n=900, seed=4):
    rnd = random.Random(seed)
    rows = [(i, "x" * rnd.choice([0, 5, 40, 300]), "en", rnd.choice(["a"] * 6 + ["b"] * 3 + ["c"]), None) for i in range(n)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def test_places_follow_the_schedule(spark):
    rows, df = docs(spark)
    weights = {"a": 0.2, "b": 0.5, "c": 0.3}
    got = mix(df, weights, block_chars=100, period=50, bucket_rows=40).collect()
    assert sorted(r.doc_id for r in got) == list(range(900))
    size = {i: max(1, len(t)) for i, t, *_ in rows}
    totals, at = {}, {}
    for s in "abc":
        own = sorted((r for r in got if r.source == s), key=lambda r: (r.block, r.place))
        pos = 0
        for r in own:  # running sizes, so each block is a stretch of the source
            assert (r.block, r.place) == divmod(pos, 100)
            pos += size[r.doc_id]
            at[s, r.block] = r.slot
        totals[s] = -(-pos // 100)
    want = simulate(totals, weights, 50)
    assert all(at[k] == want[k] for k in at)
    for s in "abc":  # shares hold while every source lasts
        ends = min(want[k, totals[k] - 1] for k in "abc")
        for t in range(50, ends, 37):
            assert abs(sum(v < t for (k, _), v in want.items() if k == s) - weights[s] * t) < 1.5
    assert min(at.values()) == 0


def test_same_places_for_any_partitioning(spark):
    _, df = docs(spark)
    one = sorted(map(tuple, mix(df.repartition(1), block_chars=100).collect()))
    many = sorted(map(tuple, mix(df.repartition(9), block_chars=100, bucket_rows=10).collect()))
    assert one == many


def test_rows_come_in_mixed_order(spark):
    _, df = docs(spark, 300)
    place = {r.doc_id: (r.slot, r.place) for r in mix(df, block_chars=100).collect()}
    out = mixed(df, block_chars=100)
    assert out.columns == df.columns
    order = [place[r.doc_id] for r in out.collect()]
    assert len(order) == 300 and [o[0] for o in order] == sorted(o[0] for o in order)


def test_weights_must_cover_the_sources(spark):
    _, df = docs(spark, 50)
    with pytest.raises(ValueError):
        mix(df, {"a": 1.0})


def test_awkward_rows(spark):
    got = mix(frame(spark), block_chars=50)
    assert ids(got) == ids(frame(spark)) and {r.source for r in got.collect()} == {"", "s0", "s1"}
    out = mixed(frame(spark), block_chars=50)
    assert out.columns == frame(spark).columns and ids(out) == ids(frame(spark))
    assert mix(frame(spark, [])).count() == 0 and mixed(frame(spark, [])).count() == 0


def odd_weights(n, seed):
    rnd = random.Random(seed)
    return {f"s{i:05}": rnd.random() ** 3 + 1e-5 for i in range(n)}


def test_unrounded_weights_keep_under_a_block_over_thousands_of_periods():
    weights = list(odd_weights(20, 6).values())
    share, total = np.array(weights) / sum(weights), 2_100_000
    blocks = [max(1, round(x * total)) for x in share]
    blocks[3] //= 2  # runs out half-way; the flow is then shared by the others
    flow, seen = Flow(blocks, weights), np.zeros(20)
    for at, i, slot, release, due in exact_slots(blocks, weights, batch=1000):
        assert (release <= slot).all() and (slot < due).all()
        count = seen + np.cumsum(at[:, None] == np.arange(20), axis=0)
        clock = np.interp(slot + 1, flow.time, flow.clock)
        ideal = np.minimum(clock[:, None] * np.array(weights), blocks)
        assert np.abs(count - ideal).max() < 1 + 1e-5
        seen = count[-1]
    assert seen.tolist() == blocks and slot[-1] + 1 == sum(blocks)


def test_mix_does_not_drift_from_the_weights(spark):
    weights = odd_weights(20, 7)
    total = sum(weights.values())
    rows = [(k, "x", s) for k, s in enumerate(s for s, w in weights.items() for _ in range(round(w / total * 30_000) + 1))]
    got = mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), weights, block_chars=1).collect()
    assert sorted(r.slot for r in got) == list(range(len(rows)))
    assert all(r.release <= r.slot < r.due for r in got)
    seen = dict.fromkeys(weights, 0)
    for t, s in sorted((r.slot, r.source) for r in got)[:29_000]:
        seen[s] += 1
        assert abs(seen[s] - (t + 1) * weights[s] / total) < 1 + 1e-5


def test_more_sources_than_a_period_takes(spark):
    rows = [(i, "x" * (1 + i % 37), f"site{i % 1300}.example") for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for weights in (None, {f"site{i}.example": 1 + i % 5 for i in range(1300)}):
        got = mix(df, weights, block_chars=20).collect()
        assert sorted(r.doc_id for r in got) == list(range(4000)) and len({r.source for r in got}) == 1300
        slot = {(r.source, r.block): r.slot for r in got}
        assert len(set(slot.values())) == len(slot) and all(r.release <= r.slot < r.due for r in got)
    assert ids(mixed(df)) == ids(df)
    with pytest.raises(ValueError):
        mix(df, period=1000)
