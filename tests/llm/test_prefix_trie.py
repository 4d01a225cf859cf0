"""The trie against plain Python on nested prefixes, and the rollup on random forests."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from envlake.llm.prefix_trie import centroid_rollup, conversation_trie

SCHEMA = "conv_id long, turn long, role string, text string, d string, c int, len double, __span string"
COLS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def slow(rows):
    convs = {}
    for c, turn, role, text, *_r in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
            convs.setdefault(c, []).append((turn is not None, turn or 0, digest, role, text))
    own = {c: [(r, t) for *_k, r, t in sorted(v)] for c, v in convs.items()}
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        rest = abs(c) % 100 * (1 if c > 0 else -1)
        built[c] = own.get(c - rest, [])[:h] + own[c][h:]
    members = {}
    for c, v in built.items():
        for d in range(len(v) + 1):
            members.setdefault(tuple(v[:d]), []).append(c)
    leaves, saved, kids = ({k: 0 for k in members} for _ in range(3))
    for k in members:
        if k:
            kids[k[:-1]] += 1
    for k, m in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += not kids[k]
            saved[k[:d]] += (len(m) - 1) * len(k[-1][1]) if k else 0
    return sorted((min(m), len(k), min(members[k[:-1]]) if k else -1, len(m), kids[k], leaves[k], saved[k],
                   hashlib.sha256(",".join(str(c) for c in sorted(m) if len(built[c]) == len(k)).encode()).hexdigest()) for k, m in members.items())


def got(df):
    assert df.columns == COLS
    return sorted(tuple(-1 if v is None else v for v in r) for r in df.collect())


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, .5, "y") for r in rows], SCHEMA)


def talk(rnd, ids, n):
    rows = []
    for _ in range(n):
        c = rnd.choice(ids)
        for t in range(rnd.randrange(1, 9)):
            rows.append((c, t if rnd.random() < .95 else None, rnd.choice(("user", "bot", None)), rnd.choice(("a", "bb", "ü", None))))
    return rows


@pytest.mark.parametrize("piece", [None, 1, 4, 30])
def test_against_plain_python(spark, piece):
    rnd = random.Random(2)
    rows = talk(rnd, [*range(0, 40), *range(100, 130), 201, 399, -7, -100, 5000], 110) + [(None, 0, "user", "no id")]
    # a long conversation, a shorter copy of its beginning, and many equal ones
    rows += [(700, i, "user", f"t{i % 7}") for i in range(45)] + [(800, i, "user", f"t{i % 7}") for i in range(31)]
    rows += [(c, i, "user", "same") for c in (0, *range(9000, 9040)) for i in range(3)]
    assert got(conversation_trie(frame(spark, rows), piece=piece)) == slow(rows)


def test_spans_carry_places_and_digests(spark):
    rows = [(c, i, "user", str(i % 5)) for c in (100, 200) for i in range(1500 if c == 100 else 1300)]
    assert got(conversation_trie(frame(spark, rows), piece=64)) == slow(rows)


def test_awkward_rows(spark):
    rows = [(1, None, None, None), (1, None, None, None), (2, 0, "", "x" * 200_000), (2, 0, "", "x" * 200_000), (3, 1, "a", "b:c"), (4, 1, "ab", ":c"), (None, None, None, None)]
    assert got(conversation_trie(frame(spark, rows))) == slow(rows)
    assert conversation_trie(frame(spark, [])).count() == 0
    assert conversation_trie(frame(spark, rows[-1:])).count() == 0


def test_one_hash_of_many_ids(spark):
    rows = [(100 * i, 0, "user", "same") for i in range(300)]  # ids in several chunks end at one node
    assert got(conversation_trie(frame(spark, rows))) == slow(rows)


@pytest.mark.parametrize("shape", ["random", "chain", "star", "deep"])
def test_centroid_rollup(shape):
    rnd = np.random.default_rng(4)
    for n in (1, 2, 3, 10, 257):
        up = {"random": [-1 if rnd.random() < .1 else int(rnd.integers(0, i)) if i else -1 for i in range(n)], "chain": list(range(-1, n - 1)),
              "star": [-1] + [0] * (n - 1), "deep": [max(-1, i - int(rnd.integers(1, 4))) for i in range(n)]}[shape]
        new = rnd.permutation(n)
        parent = np.full(n, -1)
        for i, u in enumerate(up):
            parent[new[i]] = new[u] if u >= 0 else -1
        values = rnd.integers(-5, 100, (n, 2))
        want = values.copy()
        for i in range(n - 1, -1, -1):
            if up[i] >= 0:
                want[new[up[i]]] += want[new[i]]
        assert (centroid_rollup(parent, values) == want).all()
    with pytest.raises(ValueError):
        centroid_rollup(np.array([1, 0, -1]), np.ones((3, 1), np.int64))
