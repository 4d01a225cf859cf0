"""Q-gram lemma search against full alignment of every item with every text."""

import random

import numpy as np
from common_rows import frame, ids

from envlake.llm.decontam import ItemIndex, align, budget, drop_contaminated, find_contamination, item_blocks, normalise


def plain(text):
    return "".join(map(chr, normalise(text)[0]))


def best_edits(item, text):
    """Least edits of the item against any piece of the text."""
    prev = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        cur = [i]
        for j, b in enumerate(text, 1):
            cur.append(min(prev[j - 1] + (a != b), prev[j] + 1, cur[j - 1] + 1))
        prev = cur
    return min(prev)


def edited(rnd, s, n):
    s = list(s)
    for _ in range(n):
        i = rnd.randrange(len(s))
        kind = rnd.randrange(3)
        if kind == 0:
            s[i] = rnd.choice("xyz")
        elif kind == 1:
            s.insert(i, rnd.choice("xyz"))
        else:
            del s[i]
    return "".join(s)


def test_normalise():
    assert plain("  The  Quick,\n(brown) FOX! ") == "the quick brown fox"
    assert plain("Ñandú—日本İ x") == "ñandú—日本İ x" and plain("") == "" and plain(" .,") == ""
    x, at = normalise("A -- b")
    assert [chr(c) for c in x] == ["a", " ", "b"] and at.tolist() == [0, 1, 5]


def test_search_finds_exactly_what_alignment_finds():
    rnd = random.Random(6)
    word = lambda: "".join(rnd.choice("abcdef") for _ in range(rnd.randrange(2, 6)))
    items = [(i, " ".join(word() for _ in range(rnd.choice([1, 3, 12, 30])))) for i in range(12)]
    index = ItemIndex(items, 5, 0.15)
    norm = {i: plain(t) for i, t in items}
    found = missed = 0
    for _ in range(120):
        body = " ".join(word() for _ in range(rnd.randrange(30)))
        i, t = rnd.choice(items)
        n = rnd.randrange(0, max(1, len(t) // 5))
        if len(t) < 6:
            n = 0
        planted = edited(rnd, norm[i], n) if rnd.random() < 0.8 else ""
        text = f"{body} {planted.upper()}. {body[::-1]}"
        hits = {h[0] for h in index.search(text)}
        x = plain(text)
        for j, _ in items:
            if len(norm[j]) < 5:
                want = f" {norm[j]} " in f" {x} "
            else:
                want = best_edits(norm[j], x) <= budget(len(norm[j]), 5, 0.15)
            assert (j in hits) == want, (j, norm[j], x)
            found += want
            missed += not want
    assert found > 60 and missed > 500


def test_spans_and_edits(spark):
    docs = [(1, "Intro.  The quick brown fox jumps over the lazy dog near the river bank! End."),
            (2, "the quikc brown fox jumps over the lazy dog near the river bank"), (3, "the quick brown fox"), (4, None)]
    items = [(7, "The quick, brown fox jumps over the lazy dog near the river bank."), (8, None), (9, ""), (7, "The quick, brown fox jumps over the lazy dog near the river bank.")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    it = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((r.doc_id, r.item_id, docs[r.doc_id - 1][1][r.start:r.end], r.edits) for r in find_contamination(d, it).collect())
    assert got == [(1, 7, "The quick brown fox jumps over the lazy dog near the river bank", 0),
                   (2, 7, "the quikc brown fox jumps over the lazy dog near the river bank", 2)]
    assert ids(drop_contaminated(d, it)) == [3, 4]


def test_long_texts_and_item_blocks(spark, monkeypatch):
    import envlake.llm.decontam as D
    monkeypatch.setattr(D, "STRIDE", 100)
    rnd = random.Random(1)
    filler = lambda n: " ".join("".join(rnd.choice("ghijkl") for _ in range(5)) for _ in range(n))
    items = [(i, " ".join("".join(rnd.choice("abcdef") for _ in range(4)) for _ in range(12))) for i in range(9)]
    index = ItemIndex(items, 8, 0.1)
    for k in range(60):
        text = f"{filler(k)} {items[k % 9][1]} {filler(40)} {items[(k + 4) % 9][1]}"
        assert {h[0] for h in index.search(text)} == {k % 9, (k + 4) % 9}
        assert all(text[h[1]:h[2]] == items[h[0]][1] for h in index.search(text))
    it = spark.createDataFrame(items, "item_id long, text string")
    blocks = list(item_blocks(it, "item_id", "text", 120))
    assert len(blocks) > 3 and sorted(i for b in blocks for i, _ in b) == list(range(9))
    docs = spark.createDataFrame([(i, f"{filler(5)} {t}") for i, t in items] + [(50, filler(30))], "doc_id long, text string")
    assert ids(find_contamination(docs, it, block_chars=120)) == list(range(9))
    assert ids(drop_contaminated(docs, it, block_chars=120)) == [50]


def test_align_band():
    item, x = (np.frombuffer(s.encode("utf-32-le"), "<u4") for s in ("kitten sitting", "xx kitten sittting yy"))
    assert align(item, x, 0, 6, 2) == (3, 18, 1)
    assert align(item, x[:4], 0, 6, 2) is None


def test_awkward_rows(spark):
    items = spark.createDataFrame([("k", "A first plain text, of some words."), (None, "lorem ipsum dolor sit amet lorem ipsum dolor")], "item_id string, text string")
    hits = find_contamination(frame(spark), items)
    assert sorted(r.doc_id for r in hits.select("doc_id").distinct().collect()) == [1, 5]
    out = drop_contaminated(frame(spark), items)
    assert out.columns == frame(spark).columns and ids(out) == [i for i in ids(frame(spark)) if i not in (1, 5)]
    none = spark.createDataFrame([], "item_id long, text string")
    assert find_contamination(frame(spark), none).count() == 0 and ids(drop_contaminated(frame(spark), none)) == ids(frame(spark))
    assert find_contamination(frame(spark, []), items).count() == 0 and drop_contaminated(frame(spark, []), items).count() == 0


def test_copies_of_an_item_travel_once(spark, monkeypatch):
    import envlake.llm.decontam as D
    text = "the quick brown fox jumps over the lazy dog near the river bank"
    other = "a second passage of some length that stands in one document only"
    items = spark.createDataFrame([(i, text) for i in range(400)] + [(i, "") for i in range(400, 500)] + [(500, other)], "item_id long, text string")
    docs = spark.createDataFrame([(1, f"So {text}."), (1, f"So {text}."), (2, f"And {other}!"), (3, "clean")], "doc_id long, text string")
    sizes, blocks = [], D.item_blocks
    monkeypatch.setattr(D, "item_blocks", lambda *a: (sizes.append(len(b)) or b for b in blocks(*a)))
    got = sorted((r.doc_id, r.item_id) for r in find_contamination(docs, items, block_chars=200).collect())
    assert got == sorted([(1, i) for i in range(400)] * 2 + [(2, 500)])
    assert ids(drop_contaminated(docs, items, block_chars=200)) == [3]
    assert sum(sizes) == 4  # two texts for each of the two calls


def test_an_item_of_several_texts_reports_a_place_once(spark):
    text = "the quick brown fox jumps over the lazy dog near the river bank"
    items = spark.createDataFrame([(1, text), (1, text.replace("quick", "quirk")), (2, text.replace("lazy", "lady"))], "item_id long, text string")
    docs = spark.createDataFrame([(1, f"So {text}."), (1, f"So {text}.")], "doc_id long, text string")
    got = sorted((r.item_id, r.start, r.end, r.edits) for r in find_contamination(docs, items).collect())
    assert got == [(1, 3, 66, 0)] * 2 + [(2, 3, 66, 1)] * 2
