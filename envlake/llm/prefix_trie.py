"""Conversation prefix trie, rolled up by centroid decomposition.

Two conversations share a node for every sequence of first turns they share. A
node is known by its depth and two running digests of 64 bits, each the XOR of the
digests of (place, turn); XOR can be carried from one window to the next, so no
conversation has to fit one window.

The trie is a forest of parent edges. Sums over subtrees are made in pieces: a
subtree of small *weight* (turns its members still have, which bounds its nodes) is a
piece, and the nodes above them are cut along their owners' paths. Pieces' totals are
summed, the small tree of pieces is rolled up, each piece's total is handed to the
node it hangs on, and every piece is rolled up by itself, many pieces a task. Each
of these rollups is a centroid decomposition: a component is split at its centroid,
the total below the centroid is added along the path from there to the component's top,
and the parts, each at most half as large, are split in turn.
With pieces of about the square root of the rows no task holds more than that order.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from envlake.llm.common import staged

#: Turn numbers, or places, that share a window (as a power of two).
SPAN_BITS = 10
#: Nodes of a piece, at least; with many rows four times their square root.
LEAST_PIECE = 20_000
#: Conversation ids whose decimal text is joined in one go, as a power of two.
IDS_BITS = 12


def _running(df: DataFrame, key: str, order: list[Column], values: dict[str, Column], f: Callable, both: Callable) -> DataFrame:
    """``df`` with running ``f`` of ``values`` in ``order``, for every ``key``; ``__span``
    cuts a key into windows in that order, and ``both`` joins a window's value with
    that of the windows before."""
    inside = Window.partitionBy(key, "__span").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy(key).orderBy("__span").rowsBetween(Window.unboundedPreceding, -1)
    per = df.groupBy(key, "__span").agg(*[f(v).alias(f"__{n}") for n, v in values.items()])
    carry = per.select(key, "__span", *[F.coalesce(f(F.col(f"__{n}")).over(before), F.lit(0).cast("long")).alias(f"__{n}") for n in values])
    run = df.select("*", *[f(v).over(inside).alias(n) for n, v in values.items()]).join(carry, [key, "__span"])
    return run.select(*df.columns, *[both(F.col(n), F.col(f"__{n}")).alias(n) for n in values]).drop("__span")


def numbered_turns(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                   text_col: str = "text") -> DataFrame:
    """``c, pos, k, chars``: every turn's conversation, place from 1, digest of role and
    text (16 bytes) and code points. Turns are in the order of their number, null first,
    then of that digest. A null role or text is empty; rows without a conversation are left out."""
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role_col, text_col))
    turns = conversations.where(F.col(f"`{conv_col}`").isNotNull()).select(
        F.col(f"`{conv_col}`").cast("long").alias("c"), F.col(f"`{turn_col}`").cast("long").alias("t"),
        F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))).alias("k"), F.length(text).cast("long").alias("chars"))
    turns = turns.withColumn("__span", F.coalesce(F.shiftright("t", SPAN_BITS), F.lit(-1 << 63)))
    return _running(turns, "c", [F.asc_nulls_first("t"), F.col("k")], {"pos": F.lit(1).cast("long")}, F.sum, lambda a, b: a + b).drop("t")


def with_shared_heads(turns: DataFrame, group: int = 100, heads: int = 6) -> tuple[DataFrame, DataFrame]:
    """Rebuild every conversation ``c`` of ``turns`` (:func:`numbered_turns`): the first ``h``
    turns of the first of its ``group`` ids (fewer where it has fewer, none where it is
    absent), then its own after its first ``h``; ``h`` is the CRC-32 of the id mod ``heads``.

    Returns ``c, len`` of every conversation, turnless ones included, and the turns
    ``c, len, d, k, chars``."""
    convs = turns.groupBy("c").agg(F.max("pos").alias("own")).select(
        "c", "own", (F.col("c") - F.col("c") % group).alias("c0"),
        (F.crc32(F.col("c").cast("string").cast("binary")) % heads).alias("h"))
    base = convs.select(F.col("c").alias("c0"), F.col("own").alias("there"))
    took = F.least("h", F.coalesce("there", F.lit(0)))
    convs = staged(convs.join(base, "c0", "left").select(
        "c", "c0", "h", took.alias("took"), (took + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("len")), "convs")
    head = turns.where(F.col("pos") < heads).select(F.col("c").alias("c0"), F.col("pos").alias("d"), "k", "chars")
    first = convs.join(head, "c0").where("d <= h").select("c", "len", "d", "k", "chars")
    rest = turns.join(convs, "c").where("pos > h").select("c", "len", (F.col("pos") - F.col("h") + F.col("took")).alias("d"), "k", "chars")
    return convs.select("c", "len"), first.unionByName(rest)


def centroid_rollup(parent: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums of the rows of ``values`` over each node's subtree; ``parent`` is a place, -1
    at a top. All components are split at their centroids at once, round by round."""
    n = len(parent)
    out = np.zeros_like(values)
    if not n:
        return out
    # Preorder, in which a subtree is a range.
    by_parent = np.argsort(parent, kind="stable")
    starts = np.searchsorted(parent[by_parent], np.arange(n + 1)).tolist()
    kids, stack = by_parent.tolist(), by_parent[:np.searchsorted(parent[by_parent], 0)].tolist()[::-1]
    node = []
    while stack:
        node.append(v := stack.pop())
        stack.extend(kids[starts[v]:starts[v + 1]])
    node = np.array(node, np.int64)
    if len(node) < n:
        raise ValueError("parent edges hold a cycle")
    place = np.empty(n, np.int64)
    place[node] = np.arange(n)
    up = np.where(parent[node] < 0, -1, place[parent[node]])
    ends, ups = list(range(1, n + 1)), up.tolist()
    for i in range(n - 1, -1, -1):
        if ups[i] >= 0 and ends[ups[i]] < ends[i]:
            ends[ups[i]] = ends[i]
    end, val, total = np.array(ends, np.int64), values[node], np.zeros_like(values)
    # A component is named by its top.
    top = np.maximum.accumulate(np.where(up < 0, np.arange(n), -1))
    live = np.arange(n)
    while len(live):
        a = live[np.argsort(top[live], kind="stable")]
        name, at = top[a], np.arange(len(a))
        stop = np.searchsorted(name * n + a, name * n + end[a])  # its subtree within the component
        begin = np.flatnonzero(np.r_[True, name[1:] != name[:-1]])
        comp = np.cumsum(np.r_[0, name[1:] != name[:-1]])
        size = np.diff(np.r_[begin, len(a)])[comp]
        # Nodes with more than half of a component form a path; the last is the centroid.
        centre = np.maximum.reduceat(np.where(2 * (stop - at) > size, at, -1), begin)
        sums = np.vstack([np.zeros((1, val.shape[1]), val.dtype), np.cumsum(val[a], axis=0)])
        below = sums[stop[centre]] - sums[centre]
        c = centre[comp]
        path = (at <= c) & (stop > c)
        total[a[path]] += below[comp[path]]
        part = (at > c) & (at < stop[c])
        new = np.maximum.accumulate(np.where(part & (up[a] == a[c]), at, -1))
        top[a[part]] = a[new[part]]
        live = np.delete(live, np.searchsorted(live, a[centre]))
    out[node] = total
    return out


def _rolled(df: DataFrame, group: Column, schema: str, values: list[str], extra: str | None = None) -> DataFrame:
    """Each ``group``'s forest rolled up: nodes ``(a, b)`` with parents ``(pa, pb)``, null at a
    top. ``values`` become sums over subtrees; ``extra`` grows by the number of children."""
    def run(t: pa.Table) -> pa.Table:
        cols = {c: t.column(c).to_numpy() for c in ("a", "b", *values)}
        inner = t.column("pa").is_valid().to_numpy()
        names, code = np.unique(cols["a"], return_inverse=True)
        low = cols["b"].min()
        width = int(cols["b"].max() - low) + 2
        key = code * width + (cols["b"] - low)
        order = np.argsort(key)
        parent = np.full(len(key), -1, np.int64)
        pa_, pb_ = (t.column(c).filter(pa.array(inner)).to_numpy() for c in ("pa", "pb"))
        parent[inner] = order[np.searchsorted(key[order], np.searchsorted(names, pa_) * width + (pb_ - low))]
        sums = centroid_rollup(parent, np.column_stack([cols[v] for v in values]).astype(np.int64))
        for i, v in enumerate(values):
            t = t.set_column(t.schema.get_field_index(v), v, pa.array(sums[:, i]))
        if extra:
            more = t.column(extra).to_numpy() + np.bincount(parent[inner], minlength=len(key))
            t = t.set_column(t.schema.get_field_index(extra), extra, pa.array(more))
        return t
    return df.groupBy(group.alias("__group")).applyInArrow(run, schema)


def _digests(chunks: DataFrame, key: list[str]) -> DataFrame:
    """SHA-256 of each key's texts joined by commas in the order of ``chunk``. A key of one
    chunk, which nearly all are, is hashed in place; another's are streamed in order."""
    per = chunks.groupBy(*key).agg(F.count("*").alias("__n"), F.max("ids").alias("__ids"))
    one = per.where("__n = 1").select(*key, F.sha2(F.col("__ids").cast("binary"), 256).alias("ends_sha256"))
    many = (chunks.join(per.where("__n > 1").select(*key), key, "left_semi").repartition(*key)
            .sortWithinPartitions(*key, "chunk").select(*key, "ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        at, sha = None, None

        def done(types):
            return pa.RecordBatch.from_arrays([*[pa.array([v], t) for v, t in zip(at, types)], pa.array([sha.hexdigest()])],
                                              names=[*key, "ends_sha256"])
        types = [pa.int64()] * len(key)
        for b in batches:
            for *k, ids in zip(*[b.column(i).to_pylist() for i in range(len(key) + 1)]):
                if k != at:
                    if at is not None:
                        yield done(types)
                    at, sha = k, hashlib.sha256(ids.encode())
                else:
                    sha.update(b"," + ids.encode())
        if at is not None:
            yield done(types)

    return one.unionByName(many.mapInArrow(run, ", ".join(f"{c} bigint" for c in key) + ", ends_sha256 string"))


def prefix_trie(convs: DataFrame, turns: DataFrame, piece: int | None = None) -> DataFrame:
    """The nodes of the trie of all conversations: ``conv_id`` (the smallest member),
    ``depth, parent_conv_id`` (null at the root), ``n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256``.

    ``convs``: ``c, len``; ``turns``: ``c, len, d, k, chars`` with places ``d`` from 1 to ``len``.
    ``piece`` bounds the nodes of one piece; by default it follows the rows.
    Without conversations there is no node. Equal conversations share all their nodes."""
    node = ["d", "p1", "p2"]
    zero = F.lit(0).cast("long")
    one, two = (F.xxhash64(F.lit(s), "d", "k") for s in (1, 2))
    root = convs.select("c", "len", zero.alias("d"), zero.alias("chars"), zero.alias("x1"), zero.alias("x2"))
    steps = root.unionByName(turns.select("c", "len", "d", "chars", one.alias("x1"), two.alias("x2")))
    xor = lambda a, b: a.bitwiseXOR(b)
    path = _running(steps.withColumn("__span", F.shiftright("d", SPAN_BITS)), "c", [F.col("d")],
                    {"p1": F.col("x1"), "p2": F.col("x2")}, F.bit_xor, xor)
    path = staged(path.select("c", "len", "chars", *node, xor(F.col("p1"), F.col("x1")).alias("q1"), xor(F.col("p2"), F.col("x2")).alias("q2")), "path")
    nodes = staged(path.groupBy(*node).agg(
        F.min("c").alias("conv_id"), F.count("*").alias("n_convs"), (F.max("len") == F.col("d")).cast("long").alias("leaf"),
        F.sum(F.col("len") - F.col("d") + 1).alias("weight"), F.max("chars").alias("chars"), F.max("q1").alias("q1"), F.max("q2").alias("q2")), "nodes")
    piece = piece or max(LEAST_PIECE, 4 * math.isqrt(path.count()))
    heavy = F.col("weight") > piece

    # Weights only fall along a path: a conversation's own nodes are first heavy, then light.
    is_heavy = nodes.where(heavy).select(*node, F.lit(True).alias("heavy"))
    here = F.struct(*node)
    tops = path.join(is_heavy, node, "left").groupBy(F.col("c").alias("conv_id")).agg(
        F.min(F.when(F.col("heavy").isNull(), here)).alias("light"), F.max(F.when(F.col("heavy"), here)).alias("hook"))
    parents = nodes.select((F.col("d") + 1).alias("d"), F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("conv_id").alias("parent_conv_id"))
    cut = F.when(heavy, F.coalesce(F.col("parent_conv_id") != F.col("conv_id"), F.lit(True)) | (F.col("d") % piece == 0)).otherwise(F.col("d") == F.col("light.d"))
    no = F.lit(0).cast("long")
    home = F.when(heavy, F.struct(F.lit(1).alias("kind"), F.col("conv_id").alias("x"), F.floor(F.col("d") / piece).alias("y"), no.alias("z"))).otherwise(
        F.struct(F.lit(0).alias("kind"), F.col("light.d").alias("x"), F.col("light.p1").alias("y"), F.col("light.p2").alias("z")))
    forest = staged(nodes.join(parents, ["d", "q1", "q2"], "left").join(tops, "conv_id").select(
        *node, "conv_id", "parent_conv_id", "n_convs", heavy.alias("heavy"), cut.alias("cut"), home.alias("home"), "hook", "leaf",
        ((F.col("n_convs") - 1) * F.col("chars")).alias("saved")), "forest")

    # Light pieces hang on heavy nodes: their totals need no rollup.
    sums = [F.sum(c).alias(f"{c}_in") for c in ("leaf", "saved")]
    hung = (forest.where("not heavy and hook is not null").groupBy(*[F.col(f"hook.{c}").alias(c) for c in node])
            .agg(*sums, F.sum(F.col("cut").cast("long")).alias("kids")))
    plus = lambda c, m: (F.col(c) + F.coalesce(F.col(m), zero)).alias(c)
    above = staged(forest.where("heavy").join(hung, node, "left").select(
        *[c for c in forest.columns if c not in ("leaf", "saved")], plus("leaf", "leaf_in"), plus("saved", "saved_in"),
        F.coalesce("kids", zero).alias("kids")), "heavy")
    # The tree of heavy pieces, of which there are few.
    first = F.min(F.struct("d", "parent_conv_id"))
    pieces = above.groupBy("home").agg(F.sum("leaf").alias("leaf"), F.sum("saved").alias("saved"), first.alias("top")).select(
        F.col("home.x").alias("a"), F.col("home.y").alias("b"), F.col("top.parent_conv_id").alias("pa"),
        F.floor((F.col("top.d") - 1) / piece).alias("pb"), F.col("top.d").alias("d"), "leaf", "saved")
    pieces = _rolled(pieces, F.lit(0), "a bigint, b bigint, pa bigint, pb bigint, d bigint, leaf bigint, saved bigint", ["leaf", "saved"])
    below = (pieces.where("pa is not null").groupBy(F.col("pa").alias("conv_id"), (F.col("d") - 1).alias("d"))
             .agg(*sums, F.count("*").alias("more")))
    above = above.join(below, ["conv_id", "d"], "left").select(
        *[c for c in forest.columns if c not in ("leaf", "saved")], plus("leaf", "leaf_in"), plus("saved", "saved_in"), plus("kids", "more"))

    # Every piece by itself, many in a task.
    cols = ["p1", "p2", F.col("conv_id").alias("a"), F.col("d").alias("b"), F.when(~F.col("cut"), F.col("parent_conv_id")).alias("pa"),
            (F.col("d") - 1).alias("pb"), "parent_conv_id", "n_convs", "leaf", "saved", "kids", "home"]
    every = forest.where("not heavy").withColumn("kids", zero).select(*cols).unionByName(above.select(*cols))
    tasks = max(1, -(-nodes.count() // piece))
    every = every.withColumn("task", F.pmod(F.xxhash64("home"), F.lit(tasks))).drop("home")
    schema = ", ".join(f"{c} bigint" for c in every.columns if c != "task")
    rolled = _rolled(every.select(*[c for c in every.columns if c != "task"], "task"), F.col("task"), schema + ", task bigint", ["leaf", "saved"], "kids")

    ids = F.array_join(F.transform(F.array_sort(F.collect_list("c")), lambda x: x.cast("string")), ",")
    ends = _digests(path.where("d = len").groupBy(*node, F.shiftright("c", IDS_BITS).alias("chunk")).agg(ids.alias("ids")), node)
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    return rolled.withColumn("d", F.col("b")).join(ends, node, "left").select(
        F.col("a").alias("conv_id"), F.col("b").alias("depth"), "parent_conv_id", "n_convs", F.col("kids").alias("n_children"),
        F.col("leaf").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", nothing).alias("ends_sha256"))


def conversation_trie(conversations: DataFrame, group: int = 100, heads: int = 6, piece: int | None = None,
                      conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """:func:`prefix_trie` of all conversations, rebuilt by :func:`with_shared_heads`.

    Rows without a conversation id are left out; a null role or text is empty, a null
    turn comes first, and turns of one number are taken in the order of their digest, so
    repeated rows are repeated turns. Other columns are ignored, and a table without
    rows gives none. Nothing depends on how long a conversation is or how many are equal."""
    turns = staged(numbered_turns(conversations, conv_col, turn_col, role_col, text_col), "turns")
    return prefix_trie(*with_shared_heads(turns, group, heads), piece)


#: :func:`conversation_trie` of the conversations table in DuckDB.
ORACLE = """WITH t AS (SELECT conv_id AS c, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k, length(coalesce(text, '')) AS x,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
h AS (SELECT c, c - c % 100 AS c0, max(pos) AS own, xor(list_reduce(list_concat([4294967295::BIGINT],
        flatten(list_transform(string_split(c::VARCHAR, ''), lambda ch: [ascii(ch)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
        lambda a, b: xor(xor(a, b) >> 1, CASE WHEN xor(a, b) & 1 = 1 THEN 3988292384 ELSE 0 END)), 4294967295) % 6 AS h FROM t GROUP BY c),
g AS (SELECT a.*, least(a.h, coalesce(b.own, 0)) AS took FROM h a LEFT JOIN h b ON b.c = a.c0),
p AS (SELECT g.c, pos AS d, k, x FROM g JOIN t ON t.c = g.c0 WHERE pos <= h
      UNION ALL SELECT g.c, pos - h + took, k, x FROM g JOIN t ON t.c = g.c WHERE pos > h),
q AS (SELECT c, d, x, string_agg(k, '') OVER (PARTITION BY c ORDER BY d) AS k FROM p UNION ALL SELECT c, 0, 0, '' FROM g),
m AS (SELECT *, max(d) OVER (PARTITION BY c) AS len FROM q),
n AS (SELECT d, k, min(c) AS c, count(*) AS n, (count(*) - 1) * max(x) AS own, CASE WHEN max(len) = d THEN 1 ELSE 0 END AS leaf,
        sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (len = d), '')) AS ends FROM m GROUP BY d, k),
s AS (SELECT a.d, a.k, sum(b.leaf) AS leaves, sum(b.own) AS saved, sum(CASE WHEN b.d = a.d + 1 THEN 1 ELSE 0 END) AS kids
      FROM n a JOIN n b ON b.d >= a.d AND starts_with(b.k, a.k) GROUP BY a.d, a.k)
SELECT n.c AS conv_id, n.d AS depth, u.c AS parent_conv_id, n.n AS n_convs, CAST(kids AS BIGINT) AS n_children, CAST(leaves AS BIGINT) AS n_leaves,
  CAST(saved AS BIGINT) AS saved_tokens, n.ends AS ends_sha256
FROM n JOIN s USING (d, k) LEFT JOIN n u ON u.d = n.d - 1 AND starts_with(n.k, u.k)"""
