"""Exact top-k by inner product over an impact-ordered index, score at a time.

Rows are dealt to blocks of bounded size, each an index of its own: every non-zero
component of a vector is a posting, its impact the component's magnitude quantised
to 16 levels, and postings of one level and dimension form a segment. A block
takes its segments in descending impact for many queries at once and adds each
posting's quantised impact, with its sign and the query's weight, to the scores.

What segments not yet taken can add to a row is bounded by Cauchy and Schwarz: the
query's norm times the norm of the row's own remaining postings. What quantising
loses is bounded by half a level for every posting. A query stops when few rows
can still reach its k-th best score, which is exact: it is that of the k leading
rows. All rows that can reach it are then scored exactly. Nothing is dropped without that
proof; where it never comes, all segments are taken and all that may belong are scored.

Queries meet blocks by a shuffle: a block's vectors are followed by the queries in
one sorted partition, so a task holds one block and streams the queries.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from envlake.llm.common import small_batches, staged

#: Components of one block (8,192 vectors of 64) and levels of impact.
BLOCK_COMPONENTS = 1 << 19
LEVELS = 16
#: Queries scored together in a block.
QUERY_ROWS = 256
#: Scores are summed as doubles, which hold every integer up to this.
EXACT = 1 << 52


def matrix(rows: list[np.ndarray], width: int | None = None) -> np.ndarray:
    """Vectors as rows; missing components are 0, those beyond ``width`` are left out."""
    width = max((len(r) for r in rows), default=0) if width is None else width
    out = np.zeros((len(rows), width), np.float64)
    for i, r in enumerate(rows):
        out[i, :min(len(r), width)] = r[:width]
    return out


class ImpactIndex:
    """The postings of one block of integer vectors, in descending impact."""

    def __init__(self, x: np.ndarray, levels: int = LEVELS):
        self.x = x
        size = np.abs(x)
        self.top = size.max(axis=0, initial=0)
        self.width = max(1, -(-int(size.max(initial=0) + 1) // levels))
        doc, dim = np.nonzero(x)
        level = (size[doc, dim] // self.width).astype(np.int64)
        order = np.lexsort((doc, dim, -level))
        self.doc, self.dim, self.level = doc[order], dim[order], level[order]
        self.sign = np.sign(x[self.doc, self.dim])
        #: Where the segments of each level end.
        self.ends = [int(np.searchsorted(-self.level, -lv, side="right")) for lv in range(levels - 1, -1, -1)]

    def bands(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Segments in descending impact, some levels at a time: signed impacts (the middle
        of the level) as a matrix of rows and dimensions, and the norms of what is left."""
        left = (self.x ** 2).sum(axis=1)
        at, n = 0, len(self.doc)
        for end in self.ends:
            # A proof is looked for when another eighth of the postings has been taken.
            if end - at < n / 8 and end < n or end == at:
                continue
            doc, dim = self.doc[at:end], self.dim[at:end]
            plane = np.zeros_like(self.x)
            plane[doc, dim] = self.sign[at:end] * (self.level[at:end] * self.width + (self.width - 1) / 2)
            left = left - np.bincount(doc, self.x[doc, dim] ** 2, len(left))
            at = end
            yield plane, np.sqrt(left)

    def search(self, q: np.ndarray, own: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """``(rows, scores)`` for each query row of ``q``: all rows that can be among the ``k``
        best with ties, but for the query's own (``own``, -1 if elsewhere)."""
        n, m = len(self.x), len(q)
        if m and float((np.abs(q).max(axis=0) * self.top).sum()) >= EXACT:
            raise ValueError(f"scores of {EXACT} or more are not summed exactly")
        score = np.zeros((n, m))
        mine = np.flatnonzero(own >= 0)
        norm = np.sqrt((q ** 2).sum(axis=1)) * (1 + 1e-9)
        lost = np.abs(q).sum(axis=1) * (self.width - 1) / 2
        out: list = [None] * m
        open_ = np.arange(m)
        few = max(4 * k, n // 32)
        for plane, tail in self.bands():
            score[:, open_] += plane @ q[open_].T
            now = score[:, open_]
            here = np.isin(open_, mine)
            now[own[open_[here]], np.flatnonzero(here)] = -np.inf
            floor = np.full(len(open_), -np.inf)
            if n > k:
                lead = np.argpartition(-now, k - 1, axis=0)[:k]
                floor = np.einsum("kqd,qd->qk", self.x[lead], q[open_]).min(axis=1)
                floor[np.isneginf(np.take_along_axis(now, lead, 0)).any(axis=0)] = -np.inf
            can = now + tail[:, None] * norm[open_] + (lost[open_] + 1e-6) >= floor
            can[own[open_[here]], np.flatnonzero(here)] = False
            done = (can.sum(axis=0) <= few) | (tail.max(initial=0) < 1e-3)
            for j in np.flatnonzero(done):
                rows = np.flatnonzero(can[:, j])
                out[open_[j]] = rows, self.x[rows] @ q[open_[j]]
            open_ = open_[~done]
            if not len(open_):
                break
        for j in open_:  # no postings at all, or rounding left a trace of the norm
            rows = np.flatnonzero(np.arange(n) != own[j])
            out[j] = rows, self.x[rows] @ q[j]
        return out


def _best(rows: np.ndarray, scores: np.ndarray, ids: list, at: np.ndarray, k: int) -> list[int]:
    """Places in ``rows`` of the ``k`` best: highest score, then smallest id (null last), then row."""
    if len(rows) > k:
        floor = -np.partition(-scores, k - 1)[k - 1]
        keep = np.flatnonzero(scores >= floor)
    else:
        keep = np.arange(len(rows))
    return sorted(keep, key=lambda i: (-scores[i], ids[rows[i]] is None, ids[rows[i]] or 0, at[rows[i]]))[:k]


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding",
          scale: int = 256, block_components: int = BLOCK_COMPONENTS) -> DataFrame:
    """``query_id, rank, <id_col>, score``: for every row of ``vectors`` that is a query, the
    ``k`` other rows of highest score (all, if fewer); ties go to the smaller id.

    A component is ``floor(scale * x)`` with x as double; the score is the integer inner
    product, missing components of the shorter vector being 0. A vector that is null or
    holds a null or non-finite component takes no part. A row is told from others by its place,
    so a repeated row finds its copies and a repeated query is answered once a row; a
    null id is no query, and as a candidate comes last in ties. An empty table gives no
    rows; other columns only enter ``is_query``. Scores of 2^52 or more raise.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    e = F.col(f"`{vec_col}`").cast("array<double>")
    fit = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    base = vectors.where(F.coalesce(fit, F.lit(False))).select(
        F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").alias("id"),
        F.coalesce(is_query & F.col(f"`{id_col}`").isNotNull(), F.lit(False)).alias("asks"),
        F.transform(e, lambda x: F.floor(x * scale)).alias("v"))
    base = staged(base, "vectors")  # rows keep their numbers from here on
    components = base.agg(F.sum(F.greatest(F.size("v"), F.lit(1)))).first()[0] or 0
    blocks = max(1, -(-components // block_components))
    block = F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")
    dealt = base.select(block.alias("block"), F.lit(0).alias("kind"), "row", "id", "v")
    asked = base.where("asks").select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(1).alias("kind"), "row", "id", "v")
    both = dealt.unionByName(asked).repartition(blocks, "block").sortWithinPartitions("block", "kind", "row")
    id_type = base.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, index, asking = None, [], None, []

        def answer() -> Iterator[pa.RecordBatch]:
            nonlocal index, at, ids
            if index is None:
                at, ids = np.array([r for r, _i, _v in held], np.int64), [i for _r, i, _v in held]
                index = ImpactIndex(matrix([v for _r, _i, v in held]))
                held.clear()
            rows = np.array([r for r, _i, _v in asking], np.int64)
            place = np.searchsorted(at, rows)
            own = np.where((place < len(at)) & (at[np.minimum(place, max(0, len(at) - 1))] == rows), place, -1) if len(at) else np.full(len(rows), -1)
            found = index.search(matrix([v for _r, _i, v in asking], index.x.shape[1]), own, k) if len(at) else []
            cols: list[list] = [[], [], [], [], []]
            for (row, query, _v), (cand, scores) in zip(asking, found):
                for i in _best(cand, scores, ids, at, k):
                    for c, v in zip(cols, (row, query, int(at[cand[i]]), ids[cand[i]], int(scores[i]))):
                        c.append(v)
            asking.clear()
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["q", "query_id", "row", "id", "score"])

        at, ids, types = np.zeros(0, np.int64), [], None
        for b in batches:
            types = [pa.int64(), b.schema.field("id").type, pa.int64(), b.schema.field("id").type, pa.int64()]
            values, offsets = b.column(4).values.to_numpy(zero_copy_only=False), b.column(4).offsets.to_numpy()
            blocks_, kinds, rows, row_ids = (b.column(i).to_pylist() for i in range(4))
            for i in range(b.num_rows):
                if blocks_[i] != block:
                    if asking:
                        yield from answer()
                    block, index = blocks_[i], None
                    held.clear()
                one = (rows[i], row_ids[i], values[offsets[i]:offsets[i + 1]])
                if kinds[i] == 0:
                    held.append(one)
                    continue
                asking.append(one)
                if len(asking) == QUERY_ROWS:
                    yield from answer()
        if asking:
            yield from answer()

    near = both.mapInArrow(run, f"q bigint, query_id {id_type}, row bigint, id {id_type}, score bigint")
    place = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row"))
    return (near.withColumn("rank", place).where(F.col("rank") <= k)
            .select("query_id", "rank", F.col("id").alias(id_col), "score"))


#: :func:`top_k` of the embeddings table, queries being ids divisible by 50, in DuckDB.
ORACLE = """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
      FROM v q, v c WHERE q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""
