"""Token ids in fixed-width bit-packed files.

Every id takes the fewest bits that hold the vocabulary. A file holds one run of
documents in order:

    magic ``TKBITS01``; then little-endian unsigned 64-bit numbers: shard,
    bits, tokens, documents, tokens in a block, blocks;
    the start of every block in bytes from the payload (blocks + 1 numbers);
    the start of every document in tokens from the file (documents + 1 numbers);
    the payload: each block begins on a byte boundary.

A block is unpacked by one ``numpy.unpackbits`` and one product; any id or
document is reached by its block's offset alone (:class:`TokenFile`).

Shards are range partitions of the order, so no task holds more than one part of
the corpus, and a repeated task writes the same bytes under the same name.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from envlake.llm.common import row_key, scratch, small_batches, staged

MAGIC = b"TKBITS01"
BLOCK = 4096
#: Tokens after which a task starts its next file: bounds its memory and a file's size.
FILE_TOKENS = 8_000_000
#: A file's number is its range partition times this, plus its place in the partition.
FILES = 1 << 20
#: Distinct pieces whose ids a Python worker keeps; rarer ones are encoded anew.
MEMO = 500_000
#: Characters encoded at a time: bounds memory for texts of any length.
STRETCH = 1 << 20
#: Latin letters; all of them are letters to any pre-tokeniser.
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
#: What a plain text lacks: other characters, and apostrophes and runs of white space.
_ODD = re.compile(rf"[^\x20-\x7e\n{_LETTERS}]")
_ODD_PARTS = ("'", "  ", "\n\n", " \n", "\n ")
_CUT = re.compile(r" (?=\S)")
#: The pieces of a plain text, each with the blank before it.
_PLAIN = re.compile(rf" ?[{_LETTERS}]+| ?[0-9]+| ?[^\s0-9{_LETTERS}]+|\s")


def width(vocab: int) -> int:
    """Bits that hold the ids 0 .. vocab - 1."""
    return max(1, int(vocab - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """``ids`` in ``bits`` bits each, least significant bit first."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    raw = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    return np.packbits(np.unpackbits(raw, axis=1, bitorder="little")[:, :bits], bitorder="little").tobytes()


def unpack(data: bytes, n: int, bits: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", n).astype(np.uint32)
    flat = np.unpackbits(np.frombuffer(data, np.uint8), count=n * bits, bitorder="little").reshape(n, bits)
    return np.packbits(np.pad(flat, ((0, 0), (0, 32 - bits))), axis=1, bitorder="little").view("<u4").ravel()


def encode_file(docs: list[np.ndarray], bits: int, shard: int, block: int = BLOCK) -> bytes:
    ids = np.concatenate(docs) if docs else np.zeros(0, np.uint32)
    starts = np.concatenate(([0], np.cumsum([len(d) for d in docs], dtype=np.int64))).astype("<u8")
    packed = [pack(ids[at:at + block], bits) for at in range(0, len(ids), block)]
    blocks = np.concatenate(([0], np.cumsum([len(p) for p in packed], dtype=np.int64))).astype("<u8")
    head = np.array([shard, bits, len(ids), len(docs), block, len(packed)], "<u8")
    return b"".join([MAGIC, head.tobytes(), blocks.tobytes(), starts.tobytes(), *packed])


class TokenFile:
    """Random access to one file's content."""

    def __init__(self, content: bytes):
        if content[:8] != MAGIC:
            raise ValueError("not a token file")
        self.content = content
        head = np.frombuffer(content, "<u8", 6, 8).astype(np.int64)
        self.shard, self.bits, self.n_tokens, self.n_docs, self.block, n = map(int, head)
        self.blocks = np.frombuffer(content, "<u8", n + 1, 56).astype(np.int64)
        self.starts = np.frombuffer(content, "<u8", self.n_docs + 1, 64 + 8 * n).astype(np.int64)
        self.payload = 64 + 8 * n + 8 * (self.n_docs + 1)

    def ids(self, start: int, end: int) -> np.ndarray:
        """The ids of positions ``start`` to ``end`` (exclusive)."""
        if end <= start:
            return np.zeros(0, np.uint32)
        first, last = start // self.block, (end - 1) // self.block
        out = []
        for b in range(first, last + 1):
            n = min(self.block, self.n_tokens - b * self.block)
            data = self.content[self.payload + self.blocks[b]:self.payload + self.blocks[b + 1]]
            out.append(unpack(data, n, self.bits))
        return np.concatenate(out)[start - first * self.block:end - first * self.block]

    def document(self, i: int) -> np.ndarray:
        return self.ids(int(self.starts[i]), int(self.starts[i + 1]))


_LOADED: dict[str, Callable[[list[str]], list[np.ndarray]]] = {}


@dataclass(frozen=True)
class HfTokenizer:
    """Encodes with a tokenizer file of the ``tokenizers`` library.

    Byte-level pre-tokenisation cuts a text into pieces (words, numbers, runs of
    punctuation, each with the blank before it) that are encoded apart. Pieces
    repeat far more than texts, so each distinct one is encoded once by the library
    and looked up afterwards. Plain texts are cut at every piece, others only before
    a single blank that a visible character follows, where a cut always is. Files
    with another pre-tokeniser get whole texts.
    """

    path: str

    def load(self) -> Callable[[list[str]], list[np.ndarray]]:
        """The encoder, kept by the Python worker for its next tasks."""
        if self.path not in _LOADED:
            _LOADED[self.path] = self._load()
        return _LOADED[self.path]

    def _load(self) -> Callable[[list[str]], list[np.ndarray]]:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark deals out the work
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(self.path)
        made = json.loads(tok.to_str())
        special = [a["content"] for a in made.get("added_tokens") or () if a["content"]]
        pre = made.get("pre_tokenizer") or {}
        cuts = not made.get("normalizer") and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space", True)
        if not cuts:  # no promise about pieces: whole texts
            def whole(texts: list[str]) -> list[np.ndarray]:
                return [np.array(e.ids, np.uint32) for e in tok.encode_batch(texts, add_special_tokens=False)]
            return whole

        vocab = [t for t, _ in sorted(tok.get_vocab().items(), key=lambda x: x[1])]
        begins = np.array([t.startswith("\u0120") for t in vocab])  # a blank, in byte-level notation
        line_end = vocab.index("\u010a")
        memo = _Memo()
        flat = np.zeros(0, np.uint32)  # the ids of the memo's pieces, where each one's begin, and how many
        begin, count = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def bulk(text: str) -> np.ndarray:
            return np.array(tok.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

        def encode(new: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            """The ids of the pieces, and where each piece's begin and how many they are."""
            # Pieces that begin with their only blank can be strung together: the text is
            # cut at those blanks again, and so are the ids. Bare words get a line each.
            words, bare, rest = [], [], []
            for i, p in enumerate(new):
                if p.rfind(" ") == 0 and len(p) > 1 and not p[1].isspace():
                    words.append(i)
                else:
                    (bare if p.isalpha() else rest).append(i)
            ids, sizes = [], []
            for at in range(0, len(words), 400):
                got = bulk("".join([new[i] for i in words[at:at + 400]]))
                ids.append(got)
                sizes.append(np.diff(np.append(np.flatnonzero(begins[got]), len(got))))
            for at in range(0, len(bare), 400):
                got = bulk("\n".join([new[i] for i in bare[at:at + 400]]))
                ends = np.append(np.flatnonzero(got == line_end), len(got))
                ids.append(got[got != line_end])
                sizes.append(np.diff(ends, prepend=-1) - 1)
            for e in tok.encode_batch([new[i] for i in rest], add_special_tokens=False):
                ids.append(np.array(e.ids, np.uint32))
                sizes.append([len(e.ids)])
            place = np.array(words + bare + rest, np.int64)
            n = np.concatenate(sizes).astype(np.int64)
            starts, counts = np.empty(len(new), np.int64), np.empty(len(new), np.int64)
            starts[place], counts[place] = np.cumsum(n) - n, n
            return np.concatenate(ids), starts, counts

        def some(texts: list[str]) -> list[np.ndarray]:
            nonlocal flat, begin, count
            pieces = [_pieces(t) for t in texts]
            every = list(chain.from_iterable(pieces))
            if not every:
                return [np.zeros(0, np.uint32)] * len(texts)
            memo.new = []
            got = itemgetter(*every)(memo)  # registers the pieces it does not know
            which = np.array(got if len(every) > 1 else [got], np.int64)
            ids, first, n = flat, begin, count
            if memo.new:
                more, starts, counts = encode(memo.new)
                ids = np.concatenate([flat, more])
                first, n = np.concatenate([begin, starts + len(flat)]), np.concatenate([count, counts])
                if len(memo) <= MEMO:
                    flat, begin, count = ids, first, n
                else:  # full: these serve this batch only
                    for p in memo.new:
                        del memo[p]
            first, n = first[which], n[which]
            ends = np.cumsum(n)
            out = ids[np.arange(ends[-1]) + np.repeat(first - ends + n, n)]
            last = np.cumsum([len(p) for p in pieces])
            cuts = np.concatenate(([0], ends))[last]
            return np.split(out, cuts[:-1])

        def run(texts: list[str]) -> list[np.ndarray]:
            """Every text's ids. The name of an added token in a text is that token; such
            a text is not cut into pieces."""
            whole = {i: np.array(tok.encode(t, add_special_tokens=False).ids, np.uint32)
                     for i, t in enumerate(texts) if any(a in t for a in special)}
            rest = iter(in_stretches([t for i, t in enumerate(texts) if i not in whole]))
            return [whole[i] if i in whole else next(rest) for i in range(len(texts))]

        def in_stretches(texts: list[str]) -> list[np.ndarray]:
            """Encodes bounded stretches at a time, whatever the texts' lengths."""
            parts = [_stretches(t) for t in texts]
            line, out, at, size = [x for p in parts for x in p], [], 0, 0
            for i, x in enumerate(line):
                size += len(x)
                if size >= STRETCH or i == len(line) - 1:
                    out += some(line[at:i + 1])
                    at, size = i + 1, 0
            it = iter(out)
            return [np.concatenate([next(it) for _ in p]) if len(p) > 1 else next(it) for p in parts]

        return run

    def vocab(self) -> int:
        from tokenizers import Tokenizer
        return Tokenizer.from_file(self.path).get_vocab_size()


class _Memo(dict):
    """Piece -> number; a piece asked for the first time gets the next number and is noted."""

    __slots__ = ("new",)

    def __missing__(self, piece: str) -> int:
        i = self[piece] = len(self)
        self.new.append(piece)
        return i


def _stretches(text: str) -> list[str]:
    """``text`` in stretches of about ``STRETCH`` characters, cut before a single blank
    that a visible character follows."""
    out, at = [], 0
    while len(text) - at > STRETCH:
        cut = _CUT.search(text, at + STRETCH)
        if not cut:
            break
        out.append(text[at:cut.start()])
        at = cut.start()
    return [*out, text[at:]]


def _pieces(text: str) -> list[str]:
    """``text`` cut where pre-tokenisation cuts it too."""
    if not _ODD.search(text) and not any(x in text for x in _ODD_PARTS):
        return _PLAIN.findall(text)
    parts = text.split(" ")
    out = [parts[0]]
    for p in parts[1:]:
        if p and not p[0].isspace():
            out.append(" " + p)
        else:
            out[-1] += " " + p
    return out if out[0] else out[1:]


def _write(path: str, content: bytes, attempt: str) -> None:
    """One file in any store that Arrow reaches, visible only when whole."""
    from pyarrow import fs

    store, at = fs.FileSystem.from_uri(path)
    folder, _, name = at.rpartition("/")
    store.create_dir(folder, recursive=True)
    part = f"{folder}/.{name}.{attempt}"
    with store.open_output_stream(part) as f:
        f.write(content)
    store.move(part, at)


def write_token_files(docs: DataFrame, folder: str, encode: HfTokenizer, vocab: int | None = None,
                      end_id: int = 0, order: list[Column] | None = None, id_col: str = "doc_id",
                      text_col: str = "text", partitions: int | None = None,
                      file_tokens: int = FILE_TOKENS) -> DataFrame:
    """Write the ids of every text, each followed by ``end_id``, to files under
    ``folder`` and return one row a document: ``shard, place, id_col`` (staged).

    Order: ``order``, by default ascending id (null ids first), ties by the row's
    digest. A null text is an empty one (only ``end_id``). Shards without
    documents have no file. ``folder`` is a URI in a store all executors share.
    """
    spark = docs.sparkSession
    small_batches(spark, 300)
    vocab = vocab or encode.vocab()
    bits = width(max(vocab, end_id + 1))
    src = docs.select(F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("__text"),
                      F.col(f"`{id_col}`").alias("__id"), *row_key(docs),
                      *[c.alias(f"__o{i}") for i, c in enumerate(order or [])])
    keys = [*[f"__o{i}" for i in range(len(order or []))], "__id", "__row1", "__row2"]
    by = [partitions] if partitions else []
    ranged = src.repartitionByRange(*by, *keys).sortWithinPartitions(*keys).select("__id", "__text")
    id_type = docs.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        ctx, encoder = TaskContext.get(), encode.load()
        shard, held, ids, tokens = ctx.partitionId() * FILES, [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal shard, held, ids, tokens
            _write(f"{folder}/shard-{shard:013d}.tkb", encode_file(held, bits, shard), str(ctx.taskAttemptId()))
            place = 0
            for c in ids:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(c), shard, np.int64)), pa.array(np.arange(place, place + len(c))), c],
                    names=["shard", "place", "__id"])
                place += len(c)
            shard, held, ids, tokens = shard + 1, [], [], 0

        for b in batches:
            taken = 0
            for i, got in enumerate(encoder(b.column("__text").to_pylist())):
                held.append(np.append(got, np.uint32(end_id)).astype(np.uint16 if bits <= 16 else np.uint32))
                tokens += len(held[-1])
                if tokens >= file_tokens:
                    ids.append(b.column("__id").slice(taken, i + 1 - taken))
                    taken = i + 1
                    yield from flush()
            ids.append(b.column("__id").slice(taken))
        if held:
            yield from flush()

    return staged(ranged.mapInArrow(run, f"shard bigint, place bigint, __id {id_type.simpleString()}"), "written")


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """``shard, place, first, n_tokens, ids_crc32`` of every document of the files:
    its tokens start at ``first`` in the file; the checksum is over its ids as
    little-endian unsigned 32-bit numbers."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "shard-*.tkb").load(folder).select("content"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                f = TokenFile(b.column(0)[i].as_py())
                n = np.diff(f.starts)
                crc = np.zeros(f.n_docs, np.int64)
                at = 0
                while at < f.n_docs:  # some blocks at a time, whole documents
                    to = max(at + 1, int(np.searchsorted(f.starts, f.starts[at] + (1 << 20), "right")) - 1)
                    ids = f.ids(int(f.starts[at]), int(f.starts[to])).astype("<u4")
                    cut = f.starts[at:to + 1] - f.starts[at]
                    for k in range(at, to):
                        crc[k] = zlib.crc32(ids[cut[k - at]:cut[k - at + 1]].data)
                    at = to
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(f.n_docs, f.shard, np.int64)), pa.array(np.arange(f.n_docs)),
                     pa.array(f.starts[:-1].copy()), pa.array(n), pa.array(crc)],
                    names=["shard", "place", "first", "n_tokens", "ids_crc32"])

    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "1")  # one file at a time in memory
    try:
        return staged(files.mapInArrow(run, "shard bigint, place bigint, first bigint, n_tokens bigint, ids_crc32 bigint"),
                      "read-back")
    finally:
        spark.conf.set(key, before)


def token_index(docs: DataFrame, encode: HfTokenizer, folder: str | None = None, end_id: int = 0,
                order: list[Column] | None = None, id_col: str = "doc_id", text_col: str = "text",
                partitions: int | None = None, file_tokens: int = FILE_TOKENS) -> DataFrame:
    """Write the files, read them back, and return per document ``id_col, start``
    (ids of all documents before it), ``n_tokens, ids_crc32, shard, place``.

    Repeated rows and ids each keep a row; an empty table gives no file and an
    empty result; columns other than id and text only break ties.
    """
    spark = docs.sparkSession
    folder = folder or scratch(spark, "tokens")
    if "://" not in folder and not folder.startswith("file:"):
        folder = f"file://{folder}"
    written = write_token_files(docs, folder, encode, None, end_id, order, id_col, text_col, partitions, file_tokens)
    if written.isEmpty():
        return written.select(F.col("__id").alias(id_col), F.lit(0).cast("long").alias("start"),
                              F.lit(0).cast("long").alias("n_tokens"), F.lit(0).cast("long").alias("ids_crc32"),
                              "shard", "place")
    back = read_token_files(spark, folder)
    # Files are numbered in order: running sums within each range partition, and
    # the driver adds up one number for each range partition.
    files = back.groupBy("shard").agg(F.sum("n_tokens").alias("n")).withColumn("part", F.expr(f"shard div {FILES}"))
    w = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    files = staged(files.withColumn("within", F.coalesce(F.sum("n").over(w), F.lit(0))), "files")
    totals = files.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect()
    ends = np.cumsum([r.n for r in totals]).tolist()
    parts = spark.createDataFrame([(r.part, e - r.n) for r, e in zip(totals, ends)], "part long, before long")
    bases = files.join(parts, "part").select("shard", (F.col("before") + F.col("within")).alias("base"))
    return (written.join(back, ["shard", "place"]).join(bases, "shard")
            .select(F.col("__id").alias(id_col), (F.col("base") + F.col("first")).alias("start"),
                    "n_tokens", "ids_crc32", "shard", "place"))
