"""SimHash groups against brute force."""

import itertools
import random

import pytest
import xxhash

from envlake.llm.simhash import drop_near_duplicates, fingerprint, simhash_groups

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, __id string, __fp string"


def slow_fingerprint(text, k):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in low.replace("\t", " ").replace("\n", " ").replace("\v", " ").replace("\f", " ")
             .replace("\r", " ").split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def slow_classes(fps, bits):
    """Row index -> component, by comparing every pair."""
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(len(fps)), 2):
        if bin(fps[a] ^ fps[b]).count("1") <= bits:
            ra, rb = sorted((find(a), find(b)))
            root[rb] = ra
    return [find(i) for i in range(len(fps))]


def rows(texts):
    return [(i, t, "en", None, None, "x", "y") for i, t in enumerate(texts)]


def make_texts():
    rnd = random.Random(5)
    vocab = [a + b for a in "ab cd ef gh ij".split() for b in "klmnop"]
    out = [None, "", " \n\t", "one", "one two", "One  two", "a b c d", "\x85 x"]
    for _ in range(25):
        base = [rnd.choice(vocab) for _ in range(rnd.choice([4, 30, 150]))]
        out.append(" ".join(base))
        for _ in range(4):
            near = list(base)
            near[rnd.randrange(len(near))] = "Changed"
            out.append(" ".join(near))
    return out + out[8:14]


def test_fingerprint_is_the_defined_one():
    for t in make_texts() + ["w" + str(i) for i in range(3)] + [" ".join(map(str, range(1000)))]:
        for k in (1, 3):
            assert fingerprint(t.encode() if t is not None else None, k) == slow_fingerprint(t, k)


@pytest.mark.parametrize("bits", [0, 1, 2, 3])
def test_groups_match_all_pairs(spark, bits):
    texts = make_texts()
    got = {r.doc_id: r for r in simhash_groups(spark.createDataFrame(rows(texts), SCHEMA), max_bits=bits).collect()}
    fps = [slow_fingerprint(t, 3) for t in texts]
    want = slow_classes(fps, bits)
    assert len(got) == len(texts)
    assert [got[i].fingerprint for i in range(len(texts))] == [f"{f:016x}" for f in fps]
    assert [got[i].component_id for i in range(len(texts))] == want


def test_dense_ball_of_fingerprints(spark):
    """Planted fingerprints: chains and dense balls around a few centres."""
    from envlake.llm.simhash import _classes

    rnd = random.Random(3)
    fps = set()
    for _ in range(6):
        centre = rnd.getrandbits(64)
        for _ in range(120):
            x = centre
            for _ in range(rnd.randrange(9)):
                x ^= 1 << rnd.randrange(64)
            fps.add(x)
        for a in (0, 32):  # three bits in one half
            fps.add(centre ^ (0b111 << a))
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    for bits in (1, 2, 3):
        nodes = spark.createDataFrame(list(zip(signed, range(len(fps)))), "fp long, least long")
        got = {r.fp: r.component for r in _classes(nodes, bits).collect()}
        assert [got[s] for s in signed] == slow_classes(fps, bits)


def test_one_of_each_group_stays(spark):
    texts = make_texts()
    data = rows(texts) + [(9, texts[9], "en", None, None, "x", "y"), (None, "one", None, None, None, None, None)]
    df = spark.createDataFrame(data, SCHEMA)
    kept = drop_near_duplicates(df)
    assert kept.columns == df.columns
    comp = slow_classes([slow_fingerprint(t, 3) for t in texts], 3)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(comp))


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert simhash_groups(df).count() == 0
    assert drop_near_duplicates(df).count() == 0
