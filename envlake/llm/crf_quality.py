"""Document quality from a linear-chain conditional random field over lines.

Each line of a text is labelled good or bad. Emissions see the line's own
features and those of its neighbours, transitions tie adjacent labels, and
forward-backward gives every line its probability of being good. A document's
quality is the mean of these, weighted by the lines' lengths.

Training labels lines like their document. It uses a bounded sample of labelled
documents, in numpy: the likelihood's exact gradient, all documents of similar
length at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from envlake.llm.common import small_batches, smallest_digests

#: Most documents of each label in the training sample.
MAX_DOCS = 1500
_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_DIGIT = b"0123456789"
_SYMBOL = b"#*$%&|<>"
_STOP = b".,;:"
_OTHER = bytes(c for c in range(33, 127) if not chr(c).isalnum() and c not in _SYMBOL + _STOP)
N_OWN = 14


def line_features(line: bytes, seen: set[bytes]) -> tuple:
    """Own features of one line; ``seen`` holds the document's earlier lines."""
    words = line.split()
    n, size = len(words), max(1, len(line))

    def share(chars: bytes) -> float:
        return (len(line) - len(line.translate(None, chars))) / size

    lengths = list(map(len, words))
    again = line in seen
    seen.add(line)
    return (np.log1p(n), np.log1p(sum(lengths) / max(1, n)), np.log1p(max(lengths, default=0)),
            share(_SYMBOL), share(_UPPER), share(_DIGIT), share(_STOP), share(_OTHER),
            len(set(words)) / max(1, n) ** 0.9,
            sum(a == b for a, b in zip(words, words[1:])) / max(1, n - 1),
            sum(x <= 3 for x in lengths) / max(1, n),
            float(line.endswith((b".", b"!", b"?"))), float(again), float(n == 0))


def text_matrix(text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """Features of the lines that have a word, with their neighbours' and a
    constant (lines x (3 * N_OWN + 3)), and the lines' lengths."""
    lines = [x for x in (text or b"").split(b"\n") if x.strip()]
    seen: set[bytes] = set()
    own = np.array([line_features(x, seen) for x in lines], np.float32).reshape(-1, N_OWN)
    edge = np.zeros((1, N_OWN), np.float32)
    before, after = np.vstack([edge, own[:-1]])[:len(own)], np.vstack([own[1:], edge])[-len(own):] if len(own) else own
    flags = np.zeros((len(own), 3), np.float32)
    if len(own):
        flags[0, 0] = flags[-1, 1] = 1
        flags[:, 2] = 1
    return np.hstack([own, before, after, flags]), np.array([len(x) for x in lines], np.float64)


WIDTH = 3 * N_OWN + 3


def forward_backward(emit: np.ndarray, trans: np.ndarray, lengths: np.ndarray,
                     weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Marginals ``(docs, lines, 2)``, pair marginals ``(2, 2)`` summed over lines and
    documents (times the document's ``weight``) and log partition of each padded sequence of
    log potentials ``emit (docs, lines, 2)``."""
    n, t, _ = emit.shape
    top = emit.max(axis=2, keepdims=True)
    e, m = np.exp(emit - top), np.exp(trans)
    real = np.arange(t)[None, :] < lengths[:, None]
    alpha, scale = np.zeros((n, t, 2)), np.ones((n, t))
    for i in range(t):
        a = e[:, i] * (alpha[:, i - 1] @ m if i else 1.0)
        s = a.sum(axis=1)
        scale[:, i] = s
        alpha[:, i] = a / s[:, None]
    beta = np.ones((n, t, 2))
    for i in range(t - 2, -1, -1):
        b = (beta[:, i + 1] * e[:, i + 1]) @ m.T / scale[:, i + 1, None]
        beta[:, i] = np.where(real[:, i + 1, None], b, 1.0)
    gamma = alpha * beta
    gamma /= gamma.sum(axis=2, keepdims=True)
    gamma *= real[:, :, None]
    pairs = np.zeros((2, 2))
    if t > 1:
        xi = alpha[:, :-1, :, None] * m[None, None] * (beta[:, 1:] * e[:, 1:] / scale[:, 1:, None])[:, :, None, :]
        each = (xi * real[:, 1:, None, None]).sum(axis=1)
        pairs = each.sum(axis=0) if weight is None else np.tensordot(weight, each, 1)
    logz = ((np.log(scale) + top[:, :, 0]) * real).sum(axis=1)
    return gamma, pairs, logz


def _padded(mats: list[np.ndarray], cells: int = 20_000) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
    """Sequences of similar length together: ``(positions, padded, lengths)``."""
    order = sorted((i for i in range(len(mats)) if len(mats[i])), key=lambda i: len(mats[i]))
    at = 0
    while at < len(order):
        to = at + 1
        while to < len(order) and (to + 1 - at) * len(mats[order[to]]) <= cells:
            to += 1
        ids = order[at:to]
        t = len(mats[ids[-1]])
        x = np.zeros((len(ids), t, mats[ids[0]].shape[1]), np.float32)
        for k, i in enumerate(ids):
            x[k, :len(mats[i])] = mats[i]
        yield ids, x, np.array([len(mats[i]) for i in ids])
        at = to


@dataclass(frozen=True)
class Crf:
    """``weights`` (features x 2), ``trans`` (2 x 2), and the features' mean and scale."""

    weights: np.ndarray
    trans: np.ndarray
    mean: np.ndarray
    scale: np.ndarray

    def line_marginals(self, mats: list[np.ndarray]) -> list[np.ndarray]:
        """The probability of being good of every line of every document."""
        out = [np.zeros(0)] * len(mats)
        for ids, x, n in _padded(mats):
            gamma, _, _ = forward_backward(((x - self.mean) / self.scale) @ self.weights, self.trans, n)
            for k, i in enumerate(ids):
                out[i] = gamma[k, :n[k], 1]
        return out


def loss_and_gradient(batches: list[tuple], w: np.ndarray, tr: np.ndarray, l2: float) -> tuple[float, np.ndarray, np.ndarray]:
    """Minus the weighted mean log likelihood of labelling all of a document's lines as
    it is labelled, each document's by its number of lines, plus the penalty; and its exact
    gradient. ``batches``: padded features, lengths, labels and weights."""
    total = sum(len(n) for _, n, _, _ in batches)
    loss, gw, gt = l2 / 2 * ((w ** 2).sum() + (tr ** 2).sum()), l2 * w, l2 * tr
    for x, n, y, weight in batches:
        # Long documents must not outweigh short ones: the mean over lines.
        per = weight / n / total
        emit = x @ w
        gamma, pairs, logz = forward_backward(emit, tr, n, per)
        real = np.arange(x.shape[1])[None, :] < n[:, None]
        at = np.arange(len(n))
        own = np.where(real, emit[at, :, y], 0.0).sum(axis=1) + (n - 1) * tr[y, y]
        loss += float((per * (logz - own)).sum())
        gamma[at, :, y] -= real
        gw = gw + np.einsum("dtf,dtc->fc", x, gamma * per[:, None, None], optimize=True)
        pairs = pairs - np.diag(np.bincount(y, per * (n - 1), 2))
        gt = gt + pairs
    return loss, gw, gt


def fit(mats: list[np.ndarray], good: np.ndarray, steps: int = 150, rate: float = 0.05, l2: float = 1e-3) -> Crf:
    """Maximum likelihood of the documents' label on all their lines, each label
    given the same total weight (Adam, all documents a step)."""
    flat = np.vstack(mats)
    mean, scale = flat.mean(axis=0), flat.std(axis=0)
    mean[-1], scale[-1] = 0, 1  # the constant
    scale[scale < 1e-6] = 1
    share = np.bincount(good, minlength=2) / len(good)
    batches = [(((x - mean) / scale).astype(np.float64), n, good[ids], 0.5 / share[good[ids]]) for ids, x, n in _padded(mats)]
    w, tr = np.zeros((flat.shape[1], 2)), np.zeros((2, 2))
    state = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(tr), np.zeros_like(tr)]
    for step in range(1, steps + 1):
        _, gw, gt = loss_and_gradient(batches, w, tr, l2)
        for j, (p, g) in enumerate(((w, gw), (tr, gt))):
            state[2 * j] = 0.9 * state[2 * j] + 0.1 * g
            state[2 * j + 1] = 0.999 * state[2 * j + 1] + 0.001 * g * g
            p -= rate * (state[2 * j] / (1 - 0.9 ** step)) / (np.sqrt(state[2 * j + 1] / (1 - 0.999 ** step)) + 1e-8)
    return Crf(w, tr, mean, scale)


def train(docs: DataFrame, labels: DataFrame, fold: Column | None = None, label_col: str = "quality",
          id_col: str = "doc_id", text_col: str = "text", max_docs: int = MAX_DOCS) -> Crf | None:
    """Fit on labelled documents where ``fold`` (a condition on the id) holds: of
    each label the ``max_docs`` smallest digests of the id, with all their lines. Of
    conflicting labels the lowest counts. Without documents of both labels there is no
    model (None)."""
    spark = docs.sparkSession
    small_batches(spark)
    lab = labels.select(F.col(f"`{id_col}`"), F.col(f"`{label_col}`").alias("y")).where("y in (0, 1)")
    lab = (lab if fold is None else lab.where(fold)).select(F.col(f"`{id_col}`").alias("__id"), "y").where("__id is not null")
    lab = lab.groupBy("__id").agg(F.min("y").cast("int").alias("y"))
    parts = [smallest_digests(lab.where(F.col("y") == c).select("__id"), max_docs).withColumn("y", F.lit(c)) for c in (0, 1)]
    sample = F.broadcast(parts[0].unionByName(parts[1]))  # 2 * max_docs rows at most
    src = (docs.select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{text_col}`").cast("binary").alias("__text"))
           .join(sample, "__id").select("__id", "y", "__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            blobs = [text_matrix(t)[0].astype(np.float32).tobytes() for t in b.column("__text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("y"), pa.array(blobs, pa.binary())], names=["y", "f"])

    got = sorted((r.y, bytes(r.f)) for r in src.mapInArrow(run, "y int, f binary").collect() if r.f)
    good = np.array([y for y, _ in got], np.int64)
    if len(set(good.tolist())) < 2:
        return None
    return fit([np.frombuffer(f, np.float32).reshape(-1, WIDTH) for _, f in got], good)


def _scores(model: Crf | None, texts: list[bytes | None]) -> list[float]:
    got = [text_matrix(t) for t in texts]
    if model is None:
        return [float(len(size) > 0) for _, size in got]
    marginals = model.line_marginals([m for m, _ in got])
    return [float(np.clip((p * size).sum() / size.sum(), 0, 1)) if len(size) else 0.0 for p, (_, size) in zip(marginals, got)]


def score_quality(docs: DataFrame, model: Crf | None, threshold: float = 0.3, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """``id_col, score, predicted`` for every row: the length-weighted mean of the
    lines' probabilities of being good, and 1 where it reaches ``threshold``.

    Texts without a word (null and empty ones) score 0. Without a model every other
    text scores 1. Null or repeated ids and repeated rows keep a row each; other
    columns are ignored; an empty table gives an empty result.
    """
    small_batches(docs.sparkSession)
    src = docs.select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{text_col}`").cast("binary").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = _scores(model, b.column("__text").to_pylist())
            yield pa.RecordBatch.from_arrays([b.column("__id"), pa.array(s, pa.float64())], names=["__id", "score"])

    out = src.mapInArrow(run, f"__id {src.schema['__id'].dataType.simpleString()}, score double")
    return out.select(F.col("__id").alias(id_col), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: Crf | None, threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that reach ``threshold``, with all their columns."""
    small_batches(docs.sparkSession)
    at = docs.columns.index(text_col)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [None if t is None else t.encode("utf-8", "surrogatepass") for t in b.column(at).to_pylist()]
            yield b.filter(pa.array([s >= threshold for s in _scores(model, texts)], pa.bool_()))

    return docs.mapInArrow(run, schema)
