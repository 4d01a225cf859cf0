"""Mixing sources to target weights by Pfair scheduling.

Each source's documents, in a fixed shuffled order, are cut into blocks of equal
size. In the ideal mix every source flows at its weight's share of the weights of
the sources that last; block ``i`` is released in the slot in which the flow begins
it and due when the flow has ended it. One block goes to each slot, and of those
released the one due earliest goes first. Then after any number of slots each
source is less than one block away from its share, whatever the weights are, and
every document is placed, exactly once.

Weights are not rounded, so no period repeats: the slots are laid out one after
another, in one task that holds a few numbers a source and hands the slots on as it
goes (one a block of ``BLOCK_CHARS`` characters). The number of sources has no bound
but that task's memory (under 1 kB a source). Documents are joined to them by
(source, block).

A caller who gives a ``period`` gets weights in whole quotas of it instead: the
schedule repeats, the driver lays out one period a phase (a phase ends where a
source runs out), shares hold against the rounded weights only, and more than
``MAX_SOURCES`` sources raise an error.

Running sizes are not summed over a whole source in one task: a source is dealt
into buckets of about ``BUCKET_ROWS`` documents by a digest of the id, buckets
are summed first, and only then each bucket's documents.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from envlake.llm.common import row_key, staged, whole_rows

PERIOD = 1000
BLOCK_CHARS = 20_000
BUCKET_ROWS = 2000
#: Most sources with a given period; the driver then holds a few numbers of each and a
#: period's slots of each phase.
MAX_SOURCES = 500
#: Without given weights a source weighs its characters to this power.
TEMPER = 0.7
#: Parts of a slot that count as a rounding error.
NEAR = 1e-6


def quotas(weights: Mapping, period: int) -> dict:
    """Whole quotas of the positive weights: at least one each, ``period`` together."""
    total = sum(weights.values())
    order = sorted(weights)
    out = {s: max(1, int(weights[s] / total * period)) for s in order}
    rest = sorted(order, key=lambda s: (int(weights[s] / total * period) - weights[s] / total * period, order.index(s)))
    i = 0
    while (gap := period - sum(out.values())) != 0:
        s = rest[i % len(rest)] if gap > 0 else max(order, key=lambda x: out[x])
        out[s] += 1 if gap > 0 else -1
        i += 1
    return out


def period_slots(quota: Mapping, period: int) -> dict[object, list[int]]:
    """Earliest deadline first over one period: the slots of each source's blocks."""
    order = {s: n for n, s in enumerate(sorted(quota))}
    by_release = sorted((i * period // q, -(-(i + 1) * period // q), order[s], i, s) for s, q in quota.items() for i in range(q))
    slots: dict[object, list[int]] = {s: [] for s in quota}
    ready: list = []
    at = 0
    for slot in range(period):
        while at < len(by_release) and by_release[at][0] <= slot:
            heapq.heappush(ready, by_release[at][1:])
            at += 1
        due, _, _, s = heapq.heappop(ready)
        if due <= slot:
            raise AssertionError("a block missed its deadline")
        slots[s].append(slot)
    return slots


@dataclass(frozen=True)
class Phase:
    """From ``slot`` on: each live source's first block, quota and slots in a period."""

    slot: int
    first: dict
    quota: dict
    slots: dict


def plan(blocks: Mapping, weights: Mapping, period: int = PERIOD) -> list[Phase]:
    """The phases in which ``blocks`` (whole blocks of each source) are placed."""
    done = dict.fromkeys((s for s in blocks if blocks[s] > 0), 0)
    phases, slot = [], 0
    while done:
        period_ = max(period, 10 * len(done))
        quota = quotas({s: weights[s] for s in done}, period_)
        slots = period_slots(quota, period_)
        phases.append(Phase(slot, dict(done), quota, slots))

        def place(s: object, i: int) -> int:
            return i // quota[s] * period_ + slots[s][i % quota[s]]

        end = min(place(s, blocks[s] - done[s] - 1) for s in done) + 1
        for s in list(done):
            whole, part = divmod(end, period_)
            done[s] += whole * quota[s] + sum(x < part for x in slots[s])
            if done[s] >= blocks[s]:
                del done[s]
        slot += end
    return phases


class Flow:
    """The ideal mix. Its clock is the flow of a source by unit of its weight: block ``i``
    of a source of weight ``w`` begins at ``i / w``. ``slots`` turns that into slots, at a
    rate that falls where a source runs out."""

    def __init__(self, blocks: Sequence[int], weights: Sequence[float]) -> None:
        w = np.array(weights, dtype=float)
        ends = np.array(blocks, dtype=float) / w
        order = np.argsort(ends, kind="stable")
        self.clock = np.concatenate([[0.0], ends[order]])
        self.rate = np.cumsum(w[order][::-1])[::-1]
        self.time = np.concatenate([[0.0], np.cumsum(self.rate * np.diff(self.clock))])

    def slots(self, clock: np.ndarray) -> np.ndarray:
        k = np.clip(np.searchsorted(self.clock, clock, "right") - 1, 0, len(self.rate) - 1)
        return self.time[k] + self.rate[k] * (clock - self.clock[k])


def exact_slots(blocks: Sequence[int], weights: Sequence[float], batch: int = 1 << 16) -> Iterator[tuple[np.ndarray, ...]]:
    """``source`` (its index), ``block, slot, release, due`` of all blocks in the order
    of the slots, by batches. ``blocks`` and ``weights`` are positive."""
    if not len(blocks):
        return
    flow = Flow(blocks, weights)
    clock, rate, time = flow.clock.tolist(), flow.rate.tolist(), flow.time.tolist()
    w, total = np.array(weights, dtype=float), sum(blocks)
    weight, number, done = w.tolist(), list(blocks), [0] * len(blocks)
    ready = [(1 / x, s) for s, x in enumerate(weight)]
    heapq.heapify(ready)
    waiting: list = []
    k, last = 0, len(rate) - 1
    for begin in range(0, total, batch):
        source, block = [], []
        for slot in range(begin, min(total, begin + batch)):
            end = slot + 1 - NEAR
            while k < last and time[k + 1] <= end:
                k += 1
            now = clock[k] + (end - time[k]) / rate[k]
            while waiting and waiting[0][0] < now:
                s = heapq.heappop(waiting)[1]
                heapq.heappush(ready, ((done[s] + 1) / weight[s], s))
            # Some block is always released; a rounding error may hide it for a slot.
            s = heapq.heappop(ready or waiting)[1]
            source.append(s)
            block.append(done[s])
            done[s] += 1
            if done[s] < number[s]:
                heapq.heappush(waiting, (done[s] / weight[s], s))
        at, i = np.array(source), np.array(block)
        release, due = flow.slots(i / w[at]), flow.slots((i + 1) / w[at])
        yield (at, i, np.arange(begin, begin + len(i)), np.floor(release + NEAR).astype("int64"),
               np.ceil(due - NEAR).astype("int64"))


def laid_out(sources: DataFrame) -> DataFrame:
    """``source, block, slot, release, due`` of ``source, blocks, weight``, by :func:`exact_slots`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted(r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
        names = pa.array([r[0] for r in rows], pa.string())
        for at, *numbers in exact_slots([r[1] for r in rows], [r[2] for r in rows]):
            yield pa.RecordBatch.from_arrays([names.take(pa.array(at)), *(pa.array(x, pa.int64()) for x in numbers)],
                                             names=["source", "block", "slot", "release", "due"])

    return staged(sources.select("source", "blocks", "weight").repartition(1).mapInArrow(
        run, "source string, block long, slot long, release long, due long"), "slots")


def _in_periods(at: DataFrame, sources: DataFrame, period: int) -> DataFrame:
    """``at`` with ``release, due, slot`` of the schedule that repeats its period."""
    spark = at.sparkSession
    rows = sources.limit(MAX_SOURCES + 1).collect()
    if len(rows) > MAX_SOURCES:
        raise ValueError(f"a period takes at most {MAX_SOURCES} sources; without one there is no bound")
    phases = plan({r.source: r.blocks for r in rows}, {r.source: r.weight for r in rows}, period)
    begins = spark.createDataFrame(
        [(s, k, p.slot, p.first[s], p.quota[s], sum(p.quota.values()), p.slots[s]) for k, p in enumerate(phases) for s in p.first],
        "source string, phase int, begin long, first long, quota long, period long, slots array<int>")
    begins = begins.withColumn("next", F.lead("first").over(Window.partitionBy("source").orderBy("phase")))
    # One row a source: its phases, so that a document row meets one row, not each phase.
    begins = begins.groupBy("source").agg(F.array_sort(F.collect_list(F.struct("first", "next", "begin", "quota", "period", "slots"))).alias("phases"))
    # Bounded: MAX_SOURCES phases of at most 10 * MAX_SOURCES or PERIOD slots.
    at = at.join(F.broadcast(begins), "source").withColumn("p", F.expr("filter(phases, p -> p.first <= block and (p.next is null or block < p.next))[0]"))
    i = "(block - p.first)"
    return at.select(
        "*", F.expr(f"{i} * p.period div p.quota").alias("release"),
        F.expr(f"(({i} + 1) * p.period + p.quota - 1) div p.quota").alias("due"),
        F.expr(f"p.begin + {i} div p.quota * p.period + p.slots[cast({i} % p.quota as int)]").alias("slot"))


def mix(docs: DataFrame, weights: Mapping | None = None, block_chars: int = BLOCK_CHARS, period: int | None = None,
        bucket_rows: int = BUCKET_ROWS, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source") -> DataFrame:
    """Where each row goes: ``id_col, source, block`` (the source's block in which
    the row begins), ``release, due`` (slots; with a ``period``, counted from the start
    of its phase), ``slot`` (the block's slot) and ``place`` (the row's order among a block's
    rows), with the row's key ``__row1, __row2``. Order by ``slot, place``.

    ``weights`` maps sources to positive numbers and must name every source found;
    without it a source weighs its characters to the power ``TEMPER``. A null source
    is the source ``''``. A row's size is its characters, at least 1 (null and empty
    texts too); a row larger than a block uses up the slots of those it covers, so
    long texts do not buy a source more than its share. Any number of sources is
    taken, unless a ``period`` is given (at most ``MAX_SOURCES``). Repeated rows get places of
    their own. An empty table gives an empty result; other columns only enter the
    row's digest.
    """
    spark = docs.sparkSession
    size = F.greatest(F.length(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))), F.lit(1)).cast("long")
    one, two = row_key(docs)
    rows = staged(docs.select(F.col(f"`{id_col}`").alias("__id"), F.coalesce(F.col(f"`{source_col}`").cast("string"), F.lit("")).alias("source"),
                              one, two, size.alias("size")), "sizes")
    # Identical rows keep one place each: they are numbered apart.
    same = rows.groupBy("source", "__row1", "__row2").agg(F.first("__id").alias("__id"), F.first("size").alias("size"), F.count("*").alias("n"))
    n = rows.count()
    bits = max(1, (-(-n // bucket_rows) - 1).bit_length())
    # The order in a source is that of the row's digest taken as unsigned; a bucket is
    # a range of it (and holds one sign, so signed order serves within it).
    bucket = F.expr(f"shiftrightunsigned(__row1, {64 - bits})")
    same = staged(same.withColumn("bucket", bucket), "rows")
    sums = same.groupBy("source", "bucket").agg(F.sum(F.col("size") * F.col("n")).alias("sum"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = staged(sums.withColumn("before", F.coalesce(F.sum("sum").over(before), F.lit(0))), "buckets")
    sources = sums.groupBy("source").agg(F.sum("sum").alias("total"))
    if weights is None:
        sources = sources.withColumn("weight", F.pow(F.col("total").cast("double"), F.lit(TEMPER)))
    else:
        given = spark.createDataFrame([(s, float(w)) for s, w in weights.items()], "source string, weight double")
        sources = sources.join(given, "source", "left")
    sources = staged(sources.withColumn("blocks", F.expr(f"(total + {block_chars} - 1) div {block_chars}")), "sources")
    # NaN counts as larger than any number.
    if missing := sources.where("not coalesce(weight > 0 and weight < double('inf'), false)").limit(5).collect():
        raise ValueError(f"no positive weight for {[r.source for r in missing]}")
    running = Window.partitionBy("source", "bucket").orderBy("__row1", "__row2").rowsBetween(Window.unboundedPreceding, -1)
    at = (same.join(sums.select("source", "bucket", "before"), ["source", "bucket"])
          .withColumn("start", F.col("before") + F.coalesce(F.sum(F.col("size") * F.col("n")).over(running), F.lit(0))))
    # Of identical rows the k-th begins k sizes later.
    at = at.withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    at = at.withColumn("start", F.col("start") + F.col("k") * F.col("size")).withColumn("block", F.expr(f"start div {block_chars}"))
    at = at.join(laid_out(sources), ["source", "block"]) if period is None else _in_periods(at, sources, period)
    return at.select(F.col("__id").alias(id_col), "source", "block", "release", "due", "slot",
                     F.expr(f"start % {block_chars}").alias("place"), "__row1", "__row2", "n")


def mixed(docs: DataFrame, weights: Mapping | None = None, block_chars: int = BLOCK_CHARS, period: int | None = None,
          id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Every row of ``docs`` with its columns, in mixed order: partitions are ranges
    of the order and sorted, so files written from it follow each other."""
    at = mix(docs, weights, block_chars, period, id_col=id_col, text_col=text_col, source_col=source_col)
    # Identical rows stay side by side: the first one's place counts.
    first = at.groupBy("__row1", "__row2").agg(F.min(F.struct("slot", "place", "source")).alias("__at"))
    placed = whole_rows(docs).join(first, ["__row1", "__row2"])
    return placed.repartitionByRange("__at", "__row1").sortWithinPartitions("__at", "__row1").select("__doc.*")
