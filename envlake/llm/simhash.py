"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two 64-bit fingerprints at distance 3 or less are found without comparing
pairs: every fingerprint emits the variants within half the radius (one flipped
bit), variants are the shuffle key, and fingerprints that meet are checked.

An odd radius has no integer half. So the fingerprint is cut into two 32-bit
halves and one is left out of the key: of three differing bits, some half holds
one (both sides flip one bit of the other half at most, and meet), or one half
holds all of them (the other half meets without a flip). That is 2 * 33 rows
for each distinct fingerprint instead of the 2,081 of a ball of radius 2.

Work within a key is linear in its members and never lists pairs:

* members with the same left-out half are within 2 bits of one another: a star;
* members whose left-out halves differ in one bit are within 3 bits: one edge
  between the two stars;
* members whose key half is equal without a flip are joined through the balls
  of radius 1 of their left-out halves, probed with every flip of two bits.

Each edge is a true link (3 bits or fewer) and every linked pair is connected
by such edges, so the components are exact. Copies share a fingerprint and are
collapsed before anything is emitted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from envlake.llm.common import connected_components, row_key, small_batches, staged, whole_rows

SEED = 42
_LOW = np.uint64(0xFFFFFFFF)
_HALF = np.uint64(32)
_BITS = [np.uint64(1 << i) for i in range(32)]
_PAIRS = [np.uint64((1 << i) | (1 << j)) for i in range(32) for j in range(i)]


def fingerprint(text: bytes | None, shingle: int) -> int:
    """SimHash of a UTF-8 text: A-Z lowered, words between ASCII white space,
    ``shingle`` words to a shingle with repeats; fewer words: one shingle; none: 0."""
    import xxhash

    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    ends = ends[min(shingle, len(words)) - 1:]
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, n, 65_280):  # bounded memory for a text of any length
        spans = zip(starts[at:min(n, at + 65_280)].tolist(), ends[at:at + 65_280].tolist())
        hashes = np.fromiter((digest(joined[s:e], SEED) for s, e in spans), np.uint64)
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        full = len(bits) // 255 * 255  # sums of 255 rows fit a byte
        counts += bits[:full].reshape(-1, 255, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
        counts += bits[full:].sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int, keep: list, text_col: str = "text") -> DataFrame:
    """The columns ``keep`` of every row, with ``__fp`` (the fingerprint as a signed long)."""
    small_batches(docs.sparkSession)
    src = docs.select(*keep, F.col(f"`{text_col}`").cast("binary").alias("__text"))
    kept = src.drop("__text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t, shingle) for t in b.column("__text").to_pylist()], np.uint64)
            cols = [b.column(i) for i in range(b.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(fps.view(np.int64))],
                                             names=[*b.schema.names[:-1], "__fp"])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema] + ["__fp bigint"])
    return src.mapInArrow(run, schema)


def _variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``key, fp``: for either half, that half with no bit or one bit flipped."""
    flips = np.array([0, *_BITS], np.uint64)
    for b in batches:
        fp = np.asarray(b.column("fp")).view(np.uint64)
        for at in range(0, len(fp), 4096):
            x = fp[at:at + 4096, None]
            low = (x & _LOW) ^ flips
            high = ((x >> _HALF) ^ flips) | np.uint64(1 << 32)
            key = np.concatenate([low, high], axis=1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.ravel().view(np.int64)),
                 pa.array(np.broadcast_to(x, key.shape).ravel().view(np.int64))], names=["key", "fp"])


def _spanning(src: np.ndarray, dst: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A star for each component of these edges: as many rows as nodes at most."""
    nodes, flat = np.unique(np.concatenate([src, dst]), return_inverse=True)
    a, b = flat[:len(src)], flat[len(src):]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    at = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[at], nodes[root[at]]


def links_of_groups(key: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges among the fingerprints of each key (3 bits); arrays sorted by key."""
    key, fp = key.view(np.uint64), fp.view(np.uint64)
    same = np.zeros(len(key) + 1, bool)
    same[1:-1] = key[1:] == key[:-1]
    at = np.flatnonzero(same[1:] | same[:-1])  # members of groups of two or more
    if not len(at):
        return (np.zeros(0, np.uint64),) * 2
    key, fp = key[at], fp[at]
    upper = key >> _HALF == 1  # the upper half is the key, the lower one left out
    kept = np.where(upper, fp >> _HALF, fp & _LOW)
    out = np.where(upper, fp & _LOW, fp >> _HALF)
    group = np.cumsum(np.concatenate(([True], key[1:] != key[:-1]))).astype(np.uint64)
    edges = []

    def stars(code: np.ndarray, who: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.lexsort((who, code))
        code, who = code[order], who[order]
        first = np.concatenate(([True], code[1:] != code[:-1]))
        reps = who[first]
        edges.append((who, reps[np.cumsum(first) - 1]))
        return code[first], reps

    def probe(codes: np.ndarray, reps: np.ndarray, wanted: np.ndarray, who: np.ndarray) -> None:
        i = np.minimum(np.searchsorted(codes, wanted), len(codes) - 1)
        hit = codes[i] == wanted
        edges.append((who[hit], reps[i[hit]]))

    codes, reps = stars(group << _HALF | out, fp)
    for bit in _BITS:
        probe(codes, reps, codes ^ bit, reps)
    # Equal key halves: up to three bits may differ in the half left out.
    plain = kept == key & _LOW
    code, who = (group << _HALF | out)[plain], fp[plain]
    same = np.zeros(len(code) + 1, bool)
    g = code >> _HALF
    same[1:-1] = g[1:] == g[:-1]
    several = np.flatnonzero(same[1:] | same[:-1])
    code, who = code[several], who[several]
    if len(code):
        ball = np.concatenate([code, *[code ^ b for b in _BITS]])
        codes, reps = stars(ball, np.tile(who, 33))
        for two in _PAIRS:
            probe(codes, reps, code ^ two, who)
    src, dst = (np.concatenate(x) for x in zip(*edges))
    differ = src != dst
    return _spanning(src[differ], dst[differ])


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of a partition sorted by key; the last, open group is carried on."""
    key = fp = np.zeros(0, np.int64)

    def made(k: np.ndarray, f: np.ndarray) -> pa.RecordBatch:
        src, dst = links_of_groups(k, f)
        return pa.RecordBatch.from_arrays([pa.array(src.view(np.int64)), pa.array(dst.view(np.int64))],
                                          names=["src", "dst"])

    for b in batches:
        key = np.concatenate([key, np.asarray(b.column("key"))])
        fp = np.concatenate([fp, np.asarray(b.column("fp"))])
        if len(key) < 1 << 18:
            continue
        cut = np.searchsorted(key, key[-1])
        if cut:
            yield made(key[:cut], fp[:cut])
            key, fp = key[cut:], fp[cut:]
    if len(key):
        yield made(key, fp)


def _near(nodes: DataFrame, max_bits: int) -> DataFrame:
    """Edges ``src, dst`` between distinct fingerprints ``fp`` of 3, 2, 1 or 0 bits."""
    spark = nodes.sparkSession
    if max_bits == 0:
        return nodes.select(F.col("fp").alias("src"), F.col("fp").alias("dst")).limit(0)
    if max_bits < 3:
        # Whole 64 bits as key. Two that meet differ in 2 bits at most; for one
        # bit, only the fingerprint that is the variant itself takes the others.
        flips = F.expr("transform(sequence(0, 63), i -> fp ^ shiftleft(1L, i))")
        v = nodes.select("fp", F.explode(F.concat(F.array("fp"), flips)).alias("key"))
        rep = F.min("fp") if max_bits == 2 else F.min(F.when(F.col("key") == F.col("fp"), F.col("fp")))
        hubs = v.groupBy("key").agg(rep.alias("dst"), F.count("*").alias("n")).where("n > 1 and dst is not null")
        return v.join(hubs, "key").select(F.col("fp").alias("src"), "dst").where("src <> dst").distinct()
    big = 1 << 16
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(big))
    # The nodes are small but each emits 66 rows: deal them out again.
    parts = max(spark.sparkContext.defaultParallelism, nodes.count() // 200_000)
    v = nodes.select("fp").repartition(parts).mapInArrow(_variants, "key bigint, fp bigint")
    return (v.repartition("key").sortWithinPartitions("key")
            .mapInArrow(_links, "src bigint, dst bigint").distinct())


def _classes(nodes: DataFrame, max_bits: int) -> DataFrame:
    """``fp, least`` of distinct fingerprints -> ``fp, component`` (smallest ``least``)."""
    if max_bits not in (0, 1, 2, 3):
        raise ValueError("max_bits must be 0, 1, 2 or 3")
    spark = nodes.sparkSession
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    try:
        edges = staged(_near(nodes, max_bits), "links")
    finally:
        spark.conf.set(key, before)
    roots = connected_components(edges)
    member = staged(nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
                    .withColumn("root", F.coalesce("root", "fp")), "members")
    least = member.groupBy("root").agg(F.min("least").alias("component"))
    return member.join(least, "root").select("fp", "component")


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """Near-duplicate groups: ``id_col, fingerprint, component_id`` for every row.

    Documents link where fingerprints differ in ``max_bits`` (0 to 3) bits or
    fewer; ``component_id`` is the smallest id reachable over links. Null and
    empty texts have fingerprint 0 and link like any other. Repeated rows and
    repeated ids each keep their own row; a null id never becomes a
    ``component_id`` unless its whole component has null ids. An empty table
    gives an empty result. Further columns are ignored whatever their names.
    """
    fps = staged(fingerprints(docs, shingle, [F.col(f"`{id_col}`").alias("__id")], text_col), "fingerprints")
    nodes = staged(fps.groupBy(F.col("__fp").alias("fp")).agg(F.min("__id").alias("least")), "nodes")
    classes = _classes(nodes, max_bits).withColumnRenamed("fp", "__fp")
    return (fps.join(classes, "__fp")
            .select(F.col("__id").alias(id_col), F.lpad(F.lower(F.hex("__fp")), 16, "0").alias("fingerprint"),
                    F.col("component").alias("component_id")))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """One document of each near-duplicate group, with all its columns.

    The smallest id stays (null ids last); among rows with that id the one with
    the smallest digest of the whole row, and of identical rows one.
    """
    one, two = row_key(docs)
    fps = staged(fingerprints(docs, shingle, [F.col(f"`{id_col}`").alias("__id"), one, two], text_col), "fingerprints")
    order = F.struct(F.col("__id").isNull().alias("last"), "__id", "__row1", "__row2")
    nodes = staged(fps.groupBy(F.col("__fp").alias("fp"))
                   .agg(F.min(F.col("__id")).alias("least"), F.min(order).alias("first")), "nodes")
    # Components are labelled by a fingerprint here, as ids may be null or repeat.
    classes = _classes(nodes.select("fp", F.col("fp").alias("least")), max_bits)
    first = nodes.join(classes, "fp").groupBy("component").agg(F.min("first").alias("first"))
    kept = first.select("first.__row1", "first.__row2")
    copies = (fps.join(kept, ["__row1", "__row2"]).groupBy("__row1", "__row2").count().where("count > 1"))
    stay = whole_rows(docs).join(kept, ["__row1", "__row2"], "left_semi")
    if not copies.isEmpty():
        stay = stay.dropDuplicates(["__row1", "__row2"])
    return stay.select("__doc.*")
