"""Filter interaction audit: what each of five filters removes in every order.

Each document gets a mask with one bit a filter that it fails. A part (a source) is
then 32 cells, one a mask, with counts; all 120 orders follow from the survivors
of the 32 subsets of filters. These are found by a Gray-code walk that toggles one
filter at a time: every cell keeps the number of active filters it fails, and the
running survivors change only by cells whose number leaves or reaches zero.

Texts are read once. A text's copies are told by a 128-bit digest: the smallest id
of a digest is an aggregate, and documents meet it by a join on digest *and* id, so
a text held by a third of all documents is no hot key.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from envlake.llm.common import small_batches, staged

FILTERS = "ABCDE"
UPPER, SYMBOLS = bytes(range(65, 91)), b"#$%&*|"
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def text_failures(text: bytes, code_points: int) -> int:
    """Bits 0 to 3: filters A to D that the UTF-8 text fails."""
    words = text.split()  # bytes split at \x20 and \x09-\x0D only
    n = len(words)
    return ((n < 50) | (100 * len(set(words)) < 65 * n) << 1
            | (100 * (len(text) - len(text.translate(None, UPPER))) > 5 * code_points) << 2
            | (len(text.translate(None, SYMBOLS)) < len(text)) << 3)


def failure_masks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """``__id, part, mask`` of every row of ``docs``; bit 4 is filter E, a text equal
    to that of a smaller id. A null text is empty, a null part the empty string. A row
    without an id is never smaller or larger than another, so it does not fail E, and
    rows with equal ids are not smaller than one another."""
    import pyarrow.compute as pc

    small_batches(docs.sparkSession)
    src = docs.select(F.col(f"`{id_col}`").alias("__id"), F.coalesce(F.col(f"`{part_col}`"), F.lit("")).alias("part"),
                      F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for b in batches:
            texts = b.column(2).cast(pa.binary()).to_pylist()
            masks = [text_failures(t, n) for t, n in zip(texts, pc.utf8_length(b.column(2)).to_pylist())]
            digests = np.frombuffer(b"".join(xxhash.xxh3_128_digest(t) for t in texts), "<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(masks, pa.int32()), pa.array(digests[:, 0]), pa.array(digests[:, 1])],
                names=["__id", "part", "__mask", "__h1", "__h2"])

    id_type = src.schema["__id"].dataType.simpleString()
    flags = staged(src.mapInArrow(run, f"__id {id_type}, part string, __mask int, __h1 bigint, __h2 bigint"), "flags")
    first = (flags.where("__id is not null").groupBy("__h1", "__h2").agg(F.min("__id").alias("__id"))
             .withColumn("__first", F.lit(True)))
    copy = (F.col("__id").isNotNull() & F.col("__first").isNull()).cast("int")
    return (flags.join(first, ["__id", "__h1", "__h2"], "left")
            .select("__id", "part", F.col("__mask").bitwiseOR(copy * 16).alias("mask")))


def subset_states(masks: np.ndarray, cells: np.ndarray, k: int) -> np.ndarray:
    """Survivors of every subset of ``k`` filters: row ``s`` sums the rows of ``cells``
    whose mask shares no bit with ``s``. One filter is toggled a step."""
    active = np.zeros(len(masks), np.int64)
    running = cells.sum(axis=0)
    states = np.empty((1 << k, cells.shape[1]), np.int64)
    states[0] = running
    for step in range(1, 1 << k):
        f, subset = (step & -step).bit_length() - 1, step ^ step >> 1
        fails = (masks >> f & 1).astype(bool)
        if subset >> f & 1:
            running = running - cells[fails & (active == 0)].sum(axis=0)
            active += fails
        else:
            active -= fails
            running = running + cells[fails & (active == 0)].sum(axis=0)
        states[subset] = running
    return states


def audit_rows(masks: np.ndarray, cells: np.ndarray, filters: str = FILTERS) -> dict[str, list]:
    """One entry an order and step, from the differences of the subsets' survivors.
    ``cells``: documents, good and toxic documents of each mask."""
    k = len(filters)
    states = subset_states(masks, cells, k)
    fails = [int(cells[masks >> f & 1 == 1, 0].sum()) for f in range(k)]
    alone = [int(cells[masks == 1 << f, 0].sum()) for f in range(k)]
    out: dict[str, list] = {c: [] for c in ("filter_order", "step", *COUNTS[:-1])}
    by_filter, total = [], [0] * k
    for order in permutations(range(k)):
        subset = 0
        for step, f in enumerate(order, 1):
            lost = states[subset] - states[subset | 1 << f]
            subset |= 1 << f
            total[f] += int(lost[0])
            by_filter.append(f)
            row = ("".join(filters[x] for x in order), step, int(states[subset][0]), int(lost[0]), fails[f] - int(lost[0]),
                   alone[f], int(lost[1]), int(lost[2]))
            for c, v in zip(out, row):
                out[c].append(v)
    out["shapley"] = [total[f] for f in by_filter]
    return out


def filter_audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 part_col: str = "source") -> DataFrame:
    """``part, filter_order, step`` and the counts of :data:`COUNTS` for every part,
    order of the five filters and step.

    ``labels`` (``id_col, quality, toxic``) may hold an id more than once: a document is
    good (toxic) if any of its rows says 1; null labels and ids say nothing. Identical
    rows of ``docs`` count each. A table without rows has no parts and gives no rows;
    other columns are ignored.
    """
    said = (labels.where(F.col(f"`{id_col}`").isNotNull()).groupBy(F.col(f"`{id_col}`").alias("__id"))
            .agg(*[F.max(F.coalesce((F.col(c) == 1).cast("long"), F.lit(0))).alias(f"__{c}") for c in ("quality", "toxic")]))
    cells = (failure_masks(docs, id_col, text_col, part_col).join(said, "__id", "left").groupBy("part", "mask")
             .agg(F.count("*").alias("n"), *[F.sum(F.coalesce(F.col(f"__{c}"), F.lit(0))).alias(c) for c in ("quality", "toxic")]))
    # A part has 32 cells at most.
    parts = cells.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "quality", "toxic")).alias("cells"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, held in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                masks = np.array([c["mask"] for c in held], np.int64)
                counts = np.array([[c["n"], c["quality"], c["toxic"]] for c in held], np.int64)
                rows = audit_rows(masks, counts)
                yield pa.RecordBatch.from_pydict(
                    {"part": pa.array([part] * len(rows["step"])), "filter_order": pa.array(rows["filter_order"]),
                     "step": pa.array(rows["step"], pa.int32()), **{c: pa.array(rows[c], pa.int64()) for c in COUNTS}})

    return parts.mapInArrow(run, "part string, filter_order string, step int, " + ", ".join(f"{c} bigint" for c in COUNTS))


#: :func:`filter_audit` of documents and labels in DuckDB.
ORACLE = """WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(string_split_regex(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws,
             row_number() OVER () AS rid, min(doc_id) OVER (PARTITION BY t) AS first_id FROM d),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
      FROM labels GROUP BY doc_id),
m AS (SELECT part, (CASE WHEN len(ws) < 50 THEN 1 ELSE 0 END) + (CASE WHEN 100 * len(list_distinct(ws)) < 65 * len(ws) THEN 2 ELSE 0 END)
        + (CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) THEN 4 ELSE 0 END)
        + (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END) + (CASE WHEN doc_id > first_id THEN 16 ELSE 0 END) AS mask,
        coalesce(good, 0) AS good, coalesce(l.toxic, 0) AS toxic FROM w LEFT JOIN l USING (doc_id)),
c AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY ALL),
f AS (SELECT UNNEST(['A', 'B', 'C', 'D', 'E']) AS f),
o AS (SELECT a.f || b.f || x.f || y.f || z.f AS filter_order FROM f a, f b, f x, f y, f z
      WHERE len(list_distinct([a.f, b.f, x.f, y.f, z.f])) = 5),
s AS (SELECT filter_order, step, CAST(1 << (ascii(filter_order[step]) - 65) AS INTEGER) AS bit,
             CAST(list_sum([1 << (ascii(k) - 65) for k in string_split(filter_order[1:step - 1], '') if k <> '']) AS INTEGER) AS before
      FROM o, (SELECT UNNEST([1, 2, 3, 4, 5]) AS step)),
r AS (SELECT part, filter_order, step, bit,
        sum(CASE WHEN mask & (coalesce(before, 0) | bit) = 0 THEN n ELSE 0 END) AS kept,
        sum(CASE WHEN mask & coalesce(before, 0) = 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS removed,
        sum(CASE WHEN mask & coalesce(before, 0) <> 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS redundant,
        sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
        sum(CASE WHEN mask & coalesce(before, 0) = 0 AND mask & bit <> 0 THEN good ELSE 0 END) AS good_lost,
        sum(CASE WHEN mask & coalesce(before, 0) = 0 AND mask & bit <> 0 THEN toxic ELSE 0 END) AS toxic_lost
      FROM s, c GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley FROM r"""
