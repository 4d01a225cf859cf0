"""Substring dedup by line or paragraph hashing.

Texts are cut into units; each unit is normalised and hashed to 128 bits; equal
digests are grouped over the whole corpus; the occurrence with the smallest rank
(document id, then place in the document) stays and all others are removed.
What is left keeps its offsets in the original text.

A passage that stands inside longer lines is no such unit. For those,
:func:`repeated_passages` cuts its own units from the words, at places that the
words themselves decide, and groups them in the same way.

Texts never travel with the digests. A line that stands in a third of all
documents is first counted on the map side, and only digests found twice are
joined back to their occurrences, a join that adaptive execution splits. They are
stored first: it splits no join whose input comes out of an aggregate.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from envlake.llm.common import row_key, small_batches, staged, whole_rows

UNITS = {"line": re.compile(r"\n"), "paragraph": re.compile(r"\n[ \t\r]*(?:\n[ \t\r]*)+")}
#: Shorter units are left alone: license lines, headings and other common short
#: wording say nothing about copying.
MIN_WORDS = 20


def units_of(text: str, unit: str = "line", min_words: int = MIN_WORDS) -> list[tuple[int, int, str]]:
    """``(start, end, normalised)`` of every unit of ``min_words`` words or more.
    Normalised: lower case, white space runs to one blank, ends trimmed."""
    out, at = [], 0
    for m in [*UNITS[unit].finditer(text), None]:
        end = m.start() if m else len(text)
        words = text[at:end].lower().split()
        if len(words) >= max(1, min_words):
            out.append((at, end, " ".join(words)))
        at = m.end() if m else at
    return out


WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Every passage of this many words that repeats is found, by runs of ``RUN_WORDS`` words in it.
PASSAGE_WORDS, RUN_WORDS = 50, 30
#: Words whose codes are kept at a time.
KNOWN_WORDS = 500_000


def word_codes(words: list[str], known: dict[str, int]) -> np.ndarray:
    """The first 64 bits of the MD5 of every word in lower case; ``known`` saves repeats."""
    if len(known) > KNOWN_WORDS:
        known.clear()
    for w in set(words).difference(known):
        known[w] = int.from_bytes(hashlib.md5(w.lower().encode("utf-8", "surrogatepass")).digest()[:8], "big")
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def runs_of(text: str, known: dict[str, int], passage_words: int = PASSAGE_WORDS,
            run_words: int = RUN_WORDS) -> Iterator[tuple[int, int, bytes]]:
    """``(start, end, codes)`` of the runs of ``run_words`` words that stand for a text. Of the runs
    inside any ``passage_words`` words, the one whose first word has the smallest code is
    taken (the last of equal ones), so two texts that share such a passage share a run."""
    words = WORD.findall(text)
    if len(words) < passage_words:
        return
    codes = word_codes(words, known)
    near = np.lib.stride_tricks.sliding_window_view(codes[:len(codes) - run_words + 1], passage_words - run_words + 1)
    first = np.unique(np.arange(len(near)) + near.shape[1] - 1 - near[:, ::-1].argmin(axis=1))
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    blank = np.concatenate([[True], (points == 0x20) | ((points >= 0x09) & (points <= 0x0D)), [True]])
    starts, ends = np.flatnonzero(blank[:-1] & ~blank[1:]), np.flatnonzero(~blank[:-1] & blank[1:])
    for i in first.tolist():
        yield int(starts[i]), int(ends[i + run_words - 1]), codes[i:i + run_words].tobytes()


#: Units of one Arrow batch that goes back to Spark.
OUT_ROWS = 20_000


def unit_digests(docs: DataFrame, unit: str | tuple[str, ...] = "line", min_words: int = MIN_WORDS, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row a unit: ``__id``, the row's key, ``unit``, ``start, end`` and the digest ``h1, h2``.
    Several kinds of ``unit`` are cut and hashed in one pass over the texts."""
    units = (unit,) if isinstance(unit, str) else tuple(unit)
    if not set(units) <= set(UNITS):
        raise ValueError(f"unit must be one of {sorted(UNITS)}")
    return _digests(docs, lambda text: ((kind, s, e, norm.encode("utf-8", "surrogatepass"))
                                        for kind in units for s, e, norm in units_of(text, kind, min_words)), id_col, text_col)


def _digests(docs: DataFrame, cut: Callable[[str], Iterable[tuple[str, int, int, bytes]]], id_col: str, text_col: str) -> DataFrame:
    """One row for each ``(unit, start, end, content)`` that ``cut`` finds in a text, the content hashed."""
    small_batches(docs.sparkSession)
    src = docs.select(F.col(f"`{id_col}`").alias("__id"), *row_key(docs), F.col(f"`{text_col}`").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        def out(b: pa.RecordBatch, cols: list[list]) -> pa.RecordBatch:
            at = pa.array(cols[0], pa.int64())
            return pa.RecordBatch.from_arrays(
                [b.column(i).take(at) for i in range(3)] + [pa.array(cols[1], pa.string())] + [pa.array(x, pa.int64()) for x in cols[2:]],
                names=["__id", "__row1", "__row2", "unit", "start", "end", "h1", "h2"])

        for b in batches:
            cols: list[list] = [[] for _ in range(6)]
            for i, text in enumerate(b.column("__text")):
                text = text.as_py() or ""  # one text at a time, however long
                for kind, s, e, content in cut(text):
                    digest = xxhash.xxh3_128_digest(content)
                    for c, v in zip(cols, (i, kind, s, e, int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True))):
                        c.append(v)
                if len(cols[0]) >= OUT_ROWS:
                    yield out(b, cols)
                    cols = [[] for _ in range(6)]
            yield out(b, cols)

    return src.mapInArrow(run, f"__id {src.schema['__id'].dataType.simpleString()}, __row1 bigint, __row2 bigint, "
                               "unit string, start bigint, end bigint, h1 bigint, h2 bigint")


def _repeated(units: DataFrame, id_col: str) -> DataFrame:
    rank = F.struct(F.col("__id").isNull().alias("last"), "__id", "__row1", "__row2", "start", "end")
    groups = (units.groupBy("unit", "h1", "h2").agg(F.min(rank).alias("first"), F.count("*").alias("occurrences"))
              .where("occurrences > 1"))
    lost = units.join(staged(groups, "groups"), ["unit", "h1", "h2"]).where(
        "not (__row1 = first.__row1 and __row2 = first.__row2 and start = first.start)")
    return lost.select("unit", F.col("__id").alias(id_col), "start", "end", F.col("first.__id").alias(f"kept_{id_col}"),
                       F.col("first.start").alias("kept_start"), F.col("first.end").alias("kept_end"),
                       "occurrences", "__row1", "__row2")


def repeated_units(docs: DataFrame, unit: str = "line", min_words: int = MIN_WORDS, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """The units to remove, one row each: ``id_col, start, end`` (code points of the
    original text, end exclusive), ``kept_<id_col>, kept_start, kept_end`` (where the
    occurrence that stays is) and ``occurrences`` (how often the unit stands in all).

    The smallest id keeps a unit (null ids last), then the row's digest, then the
    start. Identical rows count as one, as nothing tells their units apart, and
    only :func:`dedup_units` treats them (one keeps, the others lose their units).
    A null text has no units; an empty table gives no rows; other columns only
    enter the row's digest.
    """
    return _repeated(staged(unit_digests(docs, unit, min_words, id_col, text_col), "units"), id_col).drop("unit")


def repeated_lines_and_paragraphs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """:func:`repeated_units` of every line and of every paragraph that holds a word, however
    short, with ``unit`` in front, from one pass over the texts. A passage wrapped
    differently is equal as a paragraph. A place can stand in both units; removing the union
    loses no wording, as what stays always has the smaller rank.

    Null ids rank last; a null or empty text, or one of white space, has no units; identical rows count
    as one, as nothing tells their units apart; an empty table gives no rows; texts may
    be of any length, and other columns, whatever their names, only enter the row's digest."""
    return _repeated(staged(unit_digests(docs, ("line", "paragraph"), 1, id_col, text_col), "units"), id_col)


def repeated_passages(docs: DataFrame, passage_words: int = PASSAGE_WORDS, run_words: int = RUN_WORDS,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The passages of every row that stand in a row of smaller rank (id, null ids last, then
    the row's digest), wherever in its lines: ``id_col, start, end`` (code points, end
    exclusive) and ``kept_<id_col>, kept_start, kept_end``, where the passage stands first.

    Words are split at blanks, tabs and line ends and compared in lower case, so wrapping does not
    matter. Every shared passage of ``passage_words`` words gives a row, every row has
    ``run_words`` at least: runs of that many words are compared, chosen by :func:`runs_of`,
    and those that overlap here and at the kept place are one row. The shared wording
    may go on for up to ``passage_words - run_words`` words at either end.

    What a text repeats of itself only is left alone. Identical rows count as one, as nothing tells
    them apart. A null text or one of fewer words has no passage; an empty table gives no
    rows; other columns only enter the row's digest."""
    if not 1 <= run_words <= passage_words:
        raise ValueError("run_words must lie between 1 and passage_words")
    known: dict[str, int] = {}  # each task fills its own
    runs = staged(_digests(docs, lambda text: (("run", *r) for r in runs_of(text, known, passage_words, run_words)), id_col, text_col), "runs")
    rank = F.struct(F.col("__id").isNull().alias("last"), "__id", "__row1", "__row2", "start", "end")
    groups = runs.groupBy("h1", "h2").agg(F.min(rank).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    lost = (runs.join(groups, ["h1", "h2"]).where("not (__row1 = first.__row1 and __row2 = first.__row2)")
            .select("__id", "__row1", "__row2", "start", "end", "first"))
    # One row's own runs, bounded by its text.
    own = Window.partitionBy("__row1", "__row2").orderBy("start")
    before = F.lag(F.struct("end", "first")).over(own)
    goes_on = F.expr("first.__row1 = before.first.__row1 and first.__row2 = before.first.__row2 and start <= before.end "
                     "and first.start > before.first.start and first.start <= before.first.end")
    marked = (lost.withColumn("before", before).withColumn("new", F.when(goes_on, 0).otherwise(1))
              .withColumn("passage", F.sum("new").over(own)))
    return (marked.groupBy("__row1", "__row2", "passage")
            .agg(F.min("__id").alias(id_col), F.min("start").alias("start"), F.max("end").alias("end"),
                 F.min("first.__id").alias(f"kept_{id_col}"), F.min("first.start").alias("kept_start"),
                 F.max("first.end").alias("kept_end")).drop("passage"))


def dedup_units(docs: DataFrame, unit: str = "line", min_words: int = MIN_WORDS, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """All rows of ``docs`` with their columns, repeated units taken out of the text
    (with the separator that follows), and ``kept_spans``: ``array<struct<start,
    end>>`` of the original text that is left, in order.

    Of rows identical in every column one keeps its units and the others lose
    those that are long enough. A null text stays null, without spans.
    """
    spark = docs.sparkSession
    small_batches(spark)
    lost = repeated_units(docs, unit, min_words, id_col, text_col)
    # One document's own spans, bounded by its text.
    per = lost.groupBy("__row1", "__row2").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("__cut"))
    keyed = whole_rows(docs)
    copies = keyed.groupBy("__row1", "__row2").count().where("count > 1").select("__row1", "__row2")
    joined = keyed.join(per, ["__row1", "__row2"], "left")
    if copies.isEmpty():
        joined = joined.withColumn("__copy", F.lit(False))
    else:
        # A repeated row: any but one loses all its units.
        again = joined.join(copies, ["__row1", "__row2"], "left_semi")
        one = again.dropDuplicates(["__row1", "__row2"]).withColumn("__copy", F.lit(False))
        n = copies.join(keyed.select("__row1", "__row2"), ["__row1", "__row2"]).groupBy("__row1", "__row2").count()
        rest = (one.join(n, ["__row1", "__row2"]).withColumn("__n", F.explode(F.sequence(F.lit(2), F.col("count").cast("int"))))
                .drop("count", "__n").withColumn("__copy", F.lit(True)))
        joined = (joined.join(copies, ["__row1", "__row2"], "left_anti").withColumn("__copy", F.lit(False))
                  .unionByName(one).unionByName(rest))
    names = docs.columns
    at = names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, spans = [], []
            for text, cut, copy in zip(b.column(at).to_pylist(), b.column(len(names)).to_pylist(), b.column(len(names) + 1).to_pylist()):
                if text is None:
                    texts.append(None)
                    spans.append([])
                    continue
                cuts = [(u[0], u[1]) for u in units_of(text, unit, min_words)] if copy else [(c["start"], c["end"]) for c in cut or ()]
                left, pos = [], 0
                for s, e in cuts:
                    m = UNITS[unit].match(text, e)
                    left.append((pos, s))
                    pos = m.end() if m else e
                left = [x for x in [*left, (pos, len(text))] if x[0] < x[1]]
                texts.append("".join(text[s:e] for s, e in left))
                spans.append([{"start": s, "end": e} for s, e in left])
            cols = [b.column(i) for i in range(len(names))]
            cols[at] = pa.array(texts, b.schema.field(at).type)
            kept = pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
            yield pa.RecordBatch.from_arrays([*cols, kept], names=[*names, "kept_spans"])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema]
                       + ["kept_spans array<struct<start:bigint,end:bigint>>"])
    return joined.select("__doc.*", "__cut", "__copy").mapInArrow(run, schema)


#: :func:`repeated_lines_and_paragraphs` of the documents table in DuckDB.
ORACLE = """WITH l AS (
  SELECT 'line' AS unit, doc_id, string_split(text, chr(10)) AS us, regexp_extract_all(text, '\\n') AS gaps FROM documents
  UNION ALL
  SELECT 'paragraph', doc_id, string_split_regex(text, '\\n[ \\t\\r]*(?:\\n[ \\t\\r]*)+'),
         regexp_extract_all(text, '\\n[ \\t\\r]*(?:\\n[ \\t\\r]*)+') FROM documents),
n AS (SELECT unit, doc_id, us, gaps, UNNEST(generate_series(1, len(us))) AS i FROM l),
u AS (SELECT unit, doc_id, CAST(coalesce(list_sum(list_transform(us[1:i - 1], lambda x: length(x))), 0)
             + coalesce(list_sum(list_transform(gaps[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS s, us[i] AS raw,
             trim(regexp_replace(lower(us[i]), '\\s+', ' ', 'g')) AS norm FROM n),
w AS (SELECT unit, doc_id, s, s + length(raw) AS e, row_number() OVER p AS rn, count(*) OVER (PARTITION BY unit, norm) AS n,
             first_value(doc_id) OVER p AS kd, first_value(s) OVER p AS ks, first_value(s + length(raw)) OVER p AS ke
      FROM u WHERE norm <> '' WINDOW p AS (PARTITION BY unit, norm ORDER BY doc_id, s))
SELECT unit, doc_id, s AS start, e AS "end", kd AS kept_doc_id, ks AS kept_start, ke AS kept_end, n AS occurrences FROM w WHERE rn > 1"""

#: :func:`repeated_passages` of the documents table in DuckDB.
PASSAGE_ORACLE = """WITH d AS (
  SELECT doc_id, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS ws, regexp_extract_all(text, '[\\x20\\x09-\\x0D]+') AS gaps,
         regexp_matches(text, '^[\\x20\\x09-\\x0D]') AS blank_first FROM documents),
x AS (SELECT doc_id, blank_first, len(ws) AS n, UNNEST(ws) AS word, UNNEST(gaps) AS gap, UNNEST(generate_series(1, len(ws))) AS i
      FROM d WHERE len(ws) >= 50),
y AS (SELECT doc_id, i, n, md5(lower(word)) AS code, lower(word) AS word, length(word) AS c,
             sum(length(word)) OVER p - length(word)
             + coalesce(sum(length(gap)) OVER p, 0) - CASE WHEN blank_first THEN 0 ELSE coalesce(length(gap), 0) END AS s
      FROM x WHERE word IS NOT NULL WINDOW p AS (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING)),
m AS (SELECT doc_id, i, n, min(code || lpad(CAST(1000000000 - i AS VARCHAR), 10, '0')) OVER (
             PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 20 FOLLOWING) AS pick FROM y),
a AS (SELECT DISTINCT doc_id, 1000000000 - CAST(pick[33:42] AS BIGINT) AS i FROM m WHERE i <= n - 49),
l AS (SELECT doc_id, list(word ORDER BY i) AS words, list(s ORDER BY i) AS starts, list(s + c ORDER BY i) AS ends FROM y GROUP BY doc_id),
u AS (SELECT doc_id, CAST(starts[i] AS BIGINT) AS s, CAST(ends[i + 29] AS BIGINT) AS e, array_to_string(words[i:i + 29], ' ') AS run
      FROM a JOIN l USING (doc_id)),
f AS (SELECT doc_id, s, e, first_value(doc_id) OVER r AS kd, first_value(s) OVER r AS ks, first_value(e) OVER r AS ke
      FROM u WINDOW r AS (PARTITION BY run ORDER BY doc_id, s)),
g AS (SELECT *, CASE WHEN kd = lag(kd) OVER o AND s <= lag(e) OVER o AND ks > lag(ks) OVER o AND ks <= lag(ke) OVER o THEN 0 ELSE 1 END AS new
      FROM f WHERE kd <> doc_id WINDOW o AS (PARTITION BY doc_id ORDER BY s)),
h AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY s) AS passage FROM g)
SELECT doc_id, min(s) AS start, max(e) AS "end", min(kd) AS kept_doc_id, min(ks) AS kept_start, max(ke) AS kept_end
FROM h GROUP BY doc_id, passage"""
