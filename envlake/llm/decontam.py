"""Benchmark decontamination by the q-gram lemma.

A text region within ``k`` edits of an item of ``m`` characters shares at least
``m + 1 - q (k + 1)`` of the item's q-grams with it, and the diagonals (place in
the text minus place in the item) of those differ by ``k`` at most. So shared
q-grams are counted in overlapping diagonal bands, regions that reach the bound
are retained, and each is verified by an alignment inside its band.

The items are the small side: they travel to the tasks in blocks of a bounded
number of characters, checked before anything is gathered; more items mean more
passes. Copies of a text travel once, however many items have it; the items' ids are
joined to the matches. Documents are only read and not shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from envlake.llm.common import row_key, small_batches, staged

#: Characters of a q-gram, and edits allowed as a share of the item's characters.
Q = 8
MAX_ERROR = 0.1
#: Characters of the items that one pass takes along (their index is about 30 times that in bytes).
BLOCK_CHARS = 2_000_000
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_TABLE_BITS = 22
#: Characters of a text that are searched at a time.
STRIDE = 1 << 20
_BLANK = 32
_SEPARATOR = np.array([not chr(c).isalnum() for c in range(128)])


def normalise(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the case-folded words with one blank between them, and the
    place of each in ``text``. ASCII other than letters and digits separates."""
    low = text.lower()
    if len(low) != len(text):  # a few letters grow when lowered
        low = "".join(x if len(x := c.lower()) == 1 else c for c in text)
    x = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), "<u4")
    sep = (x < 128) & _SEPARATOR[np.minimum(x, 127)]
    seen = np.flatnonzero(~sep)
    if not len(seen):
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    first = sep.copy()
    first[1:] &= ~sep[:-1]
    first[:seen[0]] = first[seen[-1] + 1:] = False  # no blank at either end
    at = np.flatnonzero(~sep | first)
    return np.where(sep[at], _BLANK, x[at]).astype(np.uint32), at


def _grams(x: np.ndarray, q: int) -> np.ndarray:
    """A hash of every q-gram; its upper bits are the well mixed ones."""
    n = max(0, len(x) - q + 1)
    h = np.zeros(n, np.uint64)
    for j in range(q):
        h *= _FACTOR
        h += x[j:j + n]
    return h * _FACTOR


def budget(m: int, q: int, max_error: float) -> int:
    """Edits allowed for an item of ``m`` characters: the share, or fewer if the
    lemma would otherwise ask for no shared q-gram at all."""
    return max(0, min(int(max_error * m), (m - q) // q))


class ItemIndex:
    """The q-grams of a block of items."""

    def __init__(self, items: list[tuple[int, str]], q: int, max_error: float):
        self.q = q
        self.items = [(i, normalise(t)[0]) for i, t in items]
        self.items = [(i, x) for i, x in self.items if len(x)]
        self.edits = np.array([budget(len(x), q, max_error) for _, x in self.items], np.int64)
        self.need = np.array([max(1, len(x) + 1 - q * (k + 1)) for (_, x), k in zip(self.items, self.edits)], np.int64)
        self.short = [j for j, (_, x) in enumerate(self.items) if len(x) < q]
        grams = [_grams(x, q) for _, x in self.items]
        code = np.concatenate([*grams, np.zeros(0, np.uint64)])
        item = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        place = np.concatenate([*[np.arange(len(g)) for g in grams], np.zeros(0, np.int64)])
        order = np.argsort(code, kind="stable")
        self.item, self.place = item[order], place[order].astype(np.int64)
        self.code, self.first, self.times = np.unique(code[order], return_index=True, return_counts=True)
        self.reach = int(max([0, *[len(x) + int(k) for (_, x), k in zip(self.items, self.edits)]]))
        self.table = np.zeros(1 << _TABLE_BITS, bool)
        self.table[self.code >> np.uint64(64 - _TABLE_BITS)] = True

    def regions(self, x: np.ndarray) -> list[tuple[int, int, int]]:
        """``(item, lowest, highest diagonal)`` that share enough q-grams with ``x``."""
        h = _grams(x, self.q)
        at = np.flatnonzero(self.table[h >> np.uint64(64 - _TABLE_BITS)])
        if not len(at) or not len(self.code):
            return []
        i = np.minimum(np.searchsorted(self.code, h[at]), len(self.code) - 1)
        hit = self.code[i] == h[at]
        at, i = at[hit], i[hit]
        n = self.times[i]
        post = np.repeat(self.first[i] - np.cumsum(n) + n, n) + np.arange(n.sum())
        item, place = self.item[post], self.place[post]
        if not len(item):
            return []
        # Enough in all is cheap to ask first.
        often = np.bincount(item, minlength=len(self.items)) >= self.need
        keep = often[item]
        item, place, diag = item[keep], place[keep], np.repeat(at, n)[keep] - place[keep]
        if not len(item):
            return []
        step = self.edits[item] + 1
        out = []
        shift = int(-diag.min()) + 1
        longest = int(place.max()) + 1
        for half in (0, 1):  # bands of 2 (k + 1) diagonals, each overlapping the next by half
            band = (diag + shift + half * step) // (2 * step)
            bands = int(band.max()) + 1
            # A q-gram of the item counts once a band, however often the text has it.
            key = np.unique((item * bands + band) * longest + place) // longest
            where, count = np.unique(key, return_counts=True)
            for c in where[count >= self.need[where // bands]].tolist():
                j, b = divmod(c, bands)
                w = int(self.edits[j]) + 1
                low = b * 2 * w - half * w - shift
                out.append((j, low, low + 2 * w - 1))
        return out

    def search(self, text: str) -> list[tuple[int, int, int, int]]:
        """``(item id, start, end, edits)`` of matches, offsets in ``text``; of
        matches of one item that overlap, the one with the fewest edits."""
        x, at = normalise(text)
        found = set()
        for s in range(0, len(x), STRIDE):  # bounded memory for a text of any length
            for j, low, high in self.regions(x[s:s + STRIDE + self.reach]):
                hit = align(self.items[j][1], x, low + s, high + s, int(self.edits[j]))
                if hit:
                    found.add((self.items[j][0], hit[2], int(at[hit[0]]), int(at[hit[1] - 1]) + 1))
        if self.short and len(x):
            line = " " + "".join(map(chr, x)) + " "
            for j in self.short:
                item = " " + "".join(map(chr, self.items[j][1])) + " "
                s = line.find(item)
                while s >= 0:
                    found.add((self.items[j][0], 0, int(at[s]), int(at[s + len(item) - 3]) + 1))
                    s = line.find(item, s + 1)
        out: list[tuple[int, int, int, int]] = []
        for i, d, s, e in sorted(found):
            if not any(o[0] == i and o[1] < e and s < o[2] for o in out):
                out.append((i, s, e, d))
        return sorted(out)


def _ends(item: np.ndarray, x: np.ndarray, low: int, width: int, anchored: bool = False) -> tuple[int, int]:
    """Least edits of ``item`` against a piece of ``x`` whose path stays on
    ``width`` diagonals from ``low`` up, and the first end that reaches it. The
    piece begins anywhere, or at 0 if ``anchored``."""
    far = 1 << 30
    ramp = np.arange(width)
    place = low + ramp
    begin = np.maximum(place, 0) if anchored else 0
    cost = np.where((place >= 0) & (place <= len(x)), begin, far)
    at = low + np.arange(len(item) + width)
    inside = (at >= 0) & (at < len(x))
    line = np.where(inside, x[np.clip(at, 0, max(0, len(x) - 1))], 0xFFFFFFFF) if len(x) else np.full(len(at), 0xFFFFFFFF)
    for i, c in enumerate(item.tolist()):
        new = cost + (line[i:i + width] != c)
        new[:-1] = np.minimum(new[:-1], cost[1:] + 1)  # the text lacks the item's character
        new = np.minimum.accumulate(new - ramp) + ramp  # the text has characters more
        place += 1
        new[(place < 0) | (place > len(x))] = far
        cost = new
    best = int(np.argmin(cost))
    return int(cost[best]), low + len(item) + best


def align(item: np.ndarray, x: np.ndarray, low: int, high: int, k: int) -> tuple[int, int, int] | None:
    """``(start, end, edits)`` of the best match on diagonals within ``k`` of the
    band, or None beyond ``k`` edits."""
    edits, end = _ends(item, x, low - k, high - low + 1 + 2 * k)
    if edits > k:
        return None
    # The start is the end of the mirrored item's match from the end backwards.
    back = x[max(0, end - len(item) - k - 1):end][::-1]
    _, length = _ends(item[::-1], back, -k, 2 * k + 1, anchored=True)
    return end - length, end, edits


def _item_texts(items: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """``key, t``: each text that holds anything, once; and ``key, i``: whose it is."""
    src = items.select(F.col(f"`{id_col}`").alias("i"), F.col(f"`{text_col}`").alias("t")).where("t <> ''")
    src = src.withColumn("key", F.sha2(F.col("t").cast("binary"), 256))
    return staged(src.select("key", "t").distinct(), "texts"), staged(src.select("key", "i").distinct(), "items")


def _apart(hits: DataFrame) -> DataFrame:
    """Where an item has several texts: of its matches that overlap in a row, the one
    with the fewest edits, as often as the row is repeated."""
    rows = [F.col(c) for c in ("__id", "__row1", "__row2", "__item")]
    each = hits.groupBy(*rows, "key", "start", "end", "edits").agg(F.count("*").alias("n"))
    per = each.groupBy(*rows).agg(F.array_sort(F.collect_set(F.struct("edits", "start", "end"))).alias("all"), F.max("n").alias("n"))
    left = F.expr("aggregate(all, slice(all, 1, 0), (o, x) -> "
                  "if(exists(o, y -> y.start < x.end and x.start < y.end), o, concat(o, array(x))))")
    return (per.select(*rows, "n", F.explode(left).alias("m")).withColumn("n", F.explode(F.expr("sequence(1L, n)")))
            .select(*rows, "m.start", "m.end", "m.edits"))


def item_blocks(items: DataFrame, id_col: str, text_col: str, block_chars: int) -> Iterator[list[tuple]]:
    """The items in blocks of about ``block_chars`` characters; the size is asked
    before anything is gathered, and one block at a time is on the driver."""
    src = items.select(F.col(f"`{id_col}`").alias("i"), F.col(f"`{text_col}`").alias("t")).where("t is not null")
    chars = src.agg(F.sum(F.length("t"))).first()[0] or 0
    n = max(1, -(-chars // block_chars))
    for b in range(n):
        part = src.where(F.pmod(F.xxhash64("t"), F.lit(n)) == b) if n > 1 else src
        yield [(r.i, r.t) for r in part.distinct().collect()]


def find_contamination(docs: DataFrame, items: DataFrame, q: int = Q, max_error: float = MAX_ERROR,
                       block_chars: int = BLOCK_CHARS, id_col: str = "doc_id", text_col: str = "text",
                       item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row a match: ``id_col, item_col, start, end`` (code points of the text),
    ``edits``, and the row's key ``__row1, __row2``.

    A match is a region within ``max_error`` edits a character of a whole item,
    both lowered and with one blank between words. Items too short for the bound
    get the most edits it can still see; items under ``q`` characters must stand
    exactly, between blanks. Null or wordless items and texts never match;
    repeated items match once; repeated rows each report. Empty tables give no rows.
    """
    small_batches(docs.sparkSession)
    src = docs.select(F.col(f"`{id_col}`").alias("__id"), *row_key(docs), F.col(f"`{text_col}`").alias("__text"))
    id_type = src.schema["__id"].dataType.simpleString()
    schema = (f"__id {id_type}, __row1 bigint, __row2 bigint, key string, start bigint, end bigint, edits bigint")

    def matcher(block: list[tuple]):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = ItemIndex(shared.value, q, max_error)
            for b in batches:
                row, got = [], []
                for i, text in enumerate(b.column("__text").to_pylist()):
                    for hit in index.search(text) if text else ():
                        row.append(i)
                        got.append(hit)
                at = pa.array(row, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [b.column(i).take(at) for i in range(3)] + [pa.array([g[0] for g in got], pa.string())]
                    + [pa.array([g[i] for g in got], pa.int64()) for i in (1, 2, 3)],
                    names=["__id", "__row1", "__row2", "key", "start", "end", "edits"])
        return run

    texts, owners = _item_texts(items, item_col, item_text_col)
    parts = [src.mapInArrow(matcher(block), schema) for block in item_blocks(texts, "key", "t", block_chars)]
    hits = reduce(DataFrame.unionAll, parts).join(owners.withColumnRenamed("i", "__item"), "key")
    if not owners.groupBy("i").count().where("count > 1").isEmpty():
        hits = _apart(hits)
    return (hits.select(F.col("__id").alias(id_col), F.col("__item").alias(item_col), "start", "end", "edits", "__row1", "__row2"))


def drop_contaminated(docs: DataFrame, items: DataFrame, q: int = Q, max_error: float = MAX_ERROR,
                      block_chars: int = BLOCK_CHARS, text_col: str = "text", item_col: str = "item_id",
                      item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns. Null and
    empty texts stay; repeated rows are judged alike. One pass over the texts for
    each block of items, each pass on what the last one kept."""
    small_batches(docs.sparkSession)
    names, out = docs.columns, docs
    at = names.index(text_col)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    texts, _ = _item_texts(items, item_col, item_text_col)
    for block in item_blocks(texts, "key", "t", block_chars):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = ItemIndex(shared.value, q, max_error)
            for b in batches:
                clean = [not (t and index.search(t)) for t in b.column(at).to_pylist()]
                yield b.filter(pa.array(clean, pa.bool_()))

        out = out.mapInArrow(run, schema)
    return out
