"""Unit dedup against plain Python."""

import random
import re

import pytest
from common_rows import frame, ids

from envlake.llm.line_dedup import dedup_units, repeated_lines_and_paragraphs, repeated_passages, repeated_units, units_of


def slow(rows, unit, min_words):
    """(removed (id, start, end) -> kept place, kept text) by walking the ranked corpus."""
    seen, lost, texts = {}, {}, {}
    for i, t in sorted(rows):
        left, pos = [], 0
        for s, e, norm in units_of(t or "", unit, min_words):
            if norm in seen:
                lost[i, s, e] = seen[norm]
                left.append(t[pos:s])
                pos = e + (1 if unit == "line" and e < len(t) else 0)
            else:
                seen[norm] = (i, s)
        texts[i] = None if t is None else "".join(left) + t[pos:]
    return lost, texts


def test_lines_match_plain_python(spark):
    rnd = random.Random(3)
    lines = [" ".join(rnd.choice("alpha Beta gamma delta".split()) for _ in range(rnd.randrange(1, 7))) for _ in range(12)]
    rows = [(i, "\n".join(rnd.choice(lines).upper() if rnd.random() < 0.3 else rnd.choice(lines) for _ in range(rnd.randrange(8))))
            for i in range(60)] + [(100, None), (101, ""), (102, "alpha\n\n\n")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    lost, texts = slow(rows, "line", 3)
    got = {(r.doc_id, r.start, r.end): (r.kept_doc_id, r.kept_start) for r in repeated_units(df, min_words=3).collect()}
    assert got == lost and lost
    out = {r.doc_id: r for r in dedup_units(df, min_words=3).collect()}
    original = dict(rows)
    for i, t in texts.items():
        assert out[i].text == t
        assert "".join(original[i][s.start:s.end] for s in out[i].kept_spans) == (t or "")


def test_paragraphs_and_threshold(spark):
    p = " ".join(f"word{i}" for i in range(60))
    rows = [(1, f"intro\n\n{p}\nmore\n\nend"), (2, f"other\n \n{p}\nmore\n\n\ntail"), (3, "short line\n\nshort line")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert [(r.doc_id, r.kept_doc_id, r.occurrences) for r in repeated_units(df, "paragraph").collect()] == [(2, 1, 2)]
    out = {r.doc_id: r.text for r in dedup_units(df, "paragraph").collect()}
    assert out == {1: rows[0][1], 2: "other\n \ntail", 3: rows[2][1]}
    assert len(repeated_units(df, "line").collect()) == 1
    with pytest.raises(ValueError):
        repeated_units(df, "word")


def test_awkward_rows(spark):
    long_line = " ".join(f"w{i}" for i in range(30))
    rows = [*[(i, long_line, None, None, None, None, None, None, None, None, None, None) for i in (5, 5, 5, None, 4)]]
    df = frame(spark).unionByName(frame(spark, rows))
    out = dedup_units(df)
    assert out.columns == [*df.columns, "kept_spans"] and ids(out) == ids(df)
    kept = [r.doc_id for r in out.where(f"text = '{long_line}'").collect()]
    assert kept == [4]  # one occurrence in all, repeated rows included
    assert {r.text for r in out.where("doc_id = 2").collect()} == {None}
    assert repeated_units(frame(spark, [])).count() == 0 and dedup_units(frame(spark, [])).count() == 0


def test_lines_and_paragraphs_of_awkward_rows(spark):
    df = frame(spark).unionByName(frame(spark, [(20, "Second LINE", "en", "s9", 1, "", "", "", 1.0, 1, "", 1)]))
    got = {(r.unit, r.doc_id, r.start, r.end, r.kept_doc_id) for r in repeated_lines_and_paragraphs(df).collect()}
    # "nulls" and "tie" stand once; the repeated row 8 is one row to this function.
    assert got == {("line", 20, 0, 11, 9)}
    assert repeated_lines_and_paragraphs(frame(spark, [])).count() == 0


def test_output_batches_are_bounded(spark, monkeypatch):
    from envlake.llm import line_dedup
    monkeypatch.setattr(line_dedup, "OUT_ROWS", 3)
    df = spark.createDataFrame([(i, "\n".join(f"w{j}" for j in range(i % 5))) for i in range(40)], "doc_id long, text string")
    lost, _texts = slow([(r.doc_id, r.text) for r in df.collect()], "line", 1)
    got = {(r.doc_id, r.start, r.end): (r.kept_doc_id, r.kept_start) for r in repeated_lines_and_paragraphs(df).where("unit = 'line'").collect()}
    assert got == lost


def test_short_lines_and_wrapped_passages(spark):
    rows = [(1, "Read on\n\nalpha beta gamma\ndelta epsilon\n\n-"), (2, "read  ON\nown words here"), (3, "alpha beta\ngamma delta epsilon\n\n\n-"), (4, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.unit, r.doc_id, r.start, r.end): (r.kept_doc_id, r.kept_start, r.kept_end, r.occurrences) for r in repeated_lines_and_paragraphs(df).collect()}
    assert got == {("line", 2, 0, 8): (1, 0, 7, 2), ("line", 3, 33, 34): (1, 41, 42, 2),
                   ("paragraph", 3, 0, 30): (1, 9, 39, 2), ("paragraph", 3, 33, 34): (1, 41, 42, 2)}


def windows(text, n):
    """``{words in lower case: [(start, end)]}`` of every ``n`` words of a text."""
    at = [(m.start(), m.end(), m.group().lower()) for m in re.finditer(r"[^\x20\x09-\x0D]+", text or "")]
    out = {}
    for i in range(len(at) - n + 1):
        out.setdefault(tuple(w for _s, _e, w in at[i:i + n]), []).append((at[i][0], at[i + n - 1][1]))
    return out


def test_passages_inside_longer_lines(spark):
    rnd = random.Random(7)

    def words(n):
        return [f"{rnd.choice('abcdefgh')}{rnd.randrange(400)}" for _ in range(n)]
    passage = words(60)
    rows = [(1, "Read on\n" + " ".join(words(40) + passage + words(40))), (2, " ".join(words(25) + passage) + " own\n\nRead on"),
            (3, "\t" + "\n".join(" ".join(passage[i:i + 7]).upper() for i in range(0, 56, 7)) + "\n" + " ".join(words(90))), (4, "Read on\n" + " ".join(words(120))),
            (5, " ".join(passage[:29] + words(70))), (6, None), (7, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    text = dict(rows)
    # The passage is no whole line or paragraph anywhere, and a short common line marks a document without it.
    assert {r.doc_id for r in repeated_lines_and_paragraphs(df).collect()} == {2, 4}
    got = repeated_passages(df).collect()
    assert sorted((r.doc_id, r.kept_doc_id) for r in got) == [(2, 1), (3, 1)]
    for r in got:
        here, there = text[r.doc_id][r.start:r.end].lower().split(), text[1][r.kept_start:r.kept_end].lower().split()
        assert here == there and len(here) >= 30
    with pytest.raises(ValueError):
        repeated_passages(df, 20, 30)


def test_passages_match_plain_python(spark):
    rnd = random.Random(11)
    shared = [[rnd.choice("alpha Beta gamma delta eta Zeta".split()) for _ in range(rnd.randrange(6, 30))] for _ in range(6)]
    rows = [(i, rnd.choice(["", " ", "\n\u00e9 "]) + rnd.choice([" ", "\n", " \t\n"]).join(
        w for _ in range(rnd.randrange(4)) for w in [*(f"own{rnd.randrange(9)}" for _ in range(rnd.randrange(8))), *rnd.choice(shared)]))
            for i in range(50)] + [(90, None), (91, "  \n")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    text, got = dict(rows), {}
    for r in repeated_passages(df, 12, 7).collect():
        got.setdefault(r.doc_id, []).append(r)
    seen_long, seen_short = set(), set()
    for i, t in sorted(rows):
        long, short = windows(t, 12), windows(t, 7)
        for span in [x for w, spans in long.items() if w in seen_long for x in spans]:
            assert any(max(r.start, span[0]) < min(r.end, span[1]) for r in got.get(i, []))
        for r in got.get(i, []):
            assert r.kept_doc_id < i and all(w in seen_short for w in windows(t[r.start:r.end], 7))
            assert len(t[r.start:r.end].split()) >= 7 <= len(text[r.kept_doc_id][r.kept_start:r.kept_end].split())
        seen_long |= set(long)
        seen_short |= set(short)
    assert len(got) > 20


def test_passages_of_awkward_rows(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rest = [None] * 10
    df = frame(spark).unionByName(frame(spark, [(i, text, *rest) for i in (5, 5, None, 4)] + [(30, "x " * 400, *rest), (31, f"{text} {text}", *rest)]))
    got = sorted((r.doc_id is None, r.doc_id, r.kept_doc_id) for r in repeated_passages(df).select("doc_id", "kept_doc_id").distinct().collect())
    # A text that only repeats itself is left alone; equal rows count as one, but both stand below row 4.
    assert got == [(False, 5, 4), (False, 31, 4), (True, None, 4)]
    assert repeated_passages(frame(spark, [])).count() == 0
    assert repeated_passages(df).columns == ["__row1", "__row2", "doc_id", "start", "end", "kept_doc_id", "kept_start", "kept_end"]


def test_a_very_common_line_is_split_over_tasks(spark):
    rows = spark.range(60_000).selectExpr("id doc_id", "if(id % 2 = 0, 'Read on', concat('line ', id % 9000)) text")
    conf = {"spark.sql.shuffle.partitions": "8", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50k",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        lost = repeated_units(rows.repartition(8), min_words=1)
        lost.collect()
        assert "SortMergeJoin(skew=true)" in lost._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
