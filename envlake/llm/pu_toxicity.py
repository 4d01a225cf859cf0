"""Toxicity by non-negative positive-unlabelled learning.

A linear classifier is trained in numpy from confirmed toxic documents (P) and
documents of any kind (U). With the class prior ``pi`` the risk is

    pi * E_P[l(f)] + max(0, E_U[l(-f)] - pi * E_P[l(-f)]),

where ``l`` is the logistic loss: the negative part takes out of U's loss what
its hidden toxic share causes, and never falls below zero. Where it would, the
step goes the other way for that part, as the method's authors advise.

Features are the presence of words and of their beginnings and ends. A bounded
sample is gathered for training; counts behind the prior are over all labels.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from envlake.llm.common import small_batches, smallest_digests

#: Bounds of the training sample (documents) and of the model (features).
MAX_POSITIVE = 3000
MAX_UNLABELLED = 6000
MAX_FEATURES = 300
MIN_Z = 6.0
MIN_POSTERIOR = 0.5
_SPACE = 1 << 20
_BREAKS = bytes.maketrans(bytes(c for c in range(128) if not chr(c).isalpha()), b" " * (128 - 52))
#: Words whose features a Python worker remembers.
_MEMO = 400_000


def word_features(word: bytes) -> tuple[int, ...]:
    """Hashed features of one lowered word: itself, beginnings of 4 to 6 and the end of 5 letters."""
    w = word.decode("utf-8", "replace")
    names = ["=" + w] + ["<" + w[:n] for n in (4, 5, 6) if len(w) >= n] + ([">" + w[-5:]] if len(w) >= 5 else [])
    return tuple(zlib.crc32(x.encode()) & (_SPACE - 1) for x in names)


def words_of(text: bytes | None) -> set[bytes]:
    return set((text or b"").lower().translate(_BREAKS).split())


def text_features(text: bytes | None) -> np.ndarray:
    found: set[int] = set()
    for w in words_of(text):
        found.update(word_features(w))
    return np.array(sorted(found), np.int32)


@dataclass(frozen=True)
class Model:
    features: tuple[int, ...]
    weights: tuple[float, ...]
    bias: float

    def scorer(self):
        weight = dict(zip(self.features, self.weights))
        memo: dict[bytes, tuple[int, ...]] = {}

        def score(text: bytes | None) -> float:
            if len(memo) > _MEMO:
                memo.clear()
            found: set[int] = set()
            for w in words_of(text):
                f = memo.get(w)
                if f is None:
                    f = memo[w] = tuple(x for x in word_features(w) if x in weight)
                found.update(f)
            z = self.bias + sum(weight[x] for x in sorted(found))
            return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))

        return score


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def nnpu_risks(pos: np.ndarray, unl: np.ndarray, prior: float, w: np.ndarray) -> tuple[float, float]:
    """The risk on positives, and the class-prior-corrected risk on negatives, with
    logistic loss; ``w`` ends with the bias."""
    fp, fu = pos @ w[:-1] + w[-1], unl @ w[:-1] + w[-1]
    return prior * np.logaddexp(0, -fp).mean(), np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()


def nnpu_step(pos: np.ndarray, unl: np.ndarray, prior: float, w: np.ndarray) -> np.ndarray:
    """The direction to descend: the gradient of both risks, or where the negative one is
    below zero, minus its gradient alone, which raises it again."""
    def grad(x: np.ndarray, d: np.ndarray) -> np.ndarray:
        return np.append(d @ x, d.sum()) / len(x)

    sp, su = _sigmoid(pos @ w[:-1] + w[-1]), _sigmoid(unl @ w[:-1] + w[-1])
    negative = grad(unl, su) - prior * grad(pos, sp)
    return prior * grad(pos, sp - 1) + negative if nnpu_risks(pos, unl, prior, w)[1] >= 0 else -negative


def nnpu_fit(pos: np.ndarray, unl: np.ndarray, prior: float, steps: int = 800, rate: float = 0.05,
             l2: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and bias of the non-negative risk's minimiser (Adam, all rows a step)."""
    w = np.zeros(pos.shape[1] + 1, np.float64)
    w[-1] = np.log(prior / (1 - prior))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        g = nnpu_step(pos, unl, prior, w)
        g[:-1] += l2 * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return w[:-1], float(w[-1])


def _dense(blobs: list[bytes], features: np.ndarray) -> np.ndarray:
    out = np.zeros((len(blobs), len(features)), np.float32)
    for i, b in enumerate(blobs):
        x = np.frombuffer(b, np.int32)
        at = np.minimum(np.searchsorted(features, x), len(features) - 1)
        out[i, at[features[at] == x]] = 1
    return out


def select_features(pos: list[bytes], unl: list[bytes], prior: float, most: int, least_z: float = MIN_Z,
                    least_posterior: float = MIN_POSTERIOR) -> np.ndarray:
    """The features most over-represented in P, sorted: found in five positives or
    more, ``least_z`` deviations beyond chance (among a million hashed features three
    would be chance), and with a share of toxic texts among the texts that have it,
    ``prior * p / u``, of ``least_posterior`` or more even if ``p`` and ``u`` are a
    standard error off. Weak features would add up in long texts."""
    share = []
    for blobs in (pos, unl):
        n = np.zeros(_SPACE, np.float64)
        for b in blobs:
            n[np.frombuffer(b, np.int32)] += 1
        share.append(n)
    (np_, nu), (cp, cu) = (len(pos), len(unl)), share
    p, u = cp / np_, (cu + 1) / (nu + 2)
    both = (cp + cu + 1) / (np_ + nu + 2)
    z = (p - u) / np.sqrt(both * (1 - both) * (1 / np_ + 1 / nu))
    low = p - np.sqrt(p * (1 - p) / np_)
    high = u + np.sqrt(u * (1 - u) / nu)
    z[(cp < 5) | (prior * low < least_posterior * high) | (z < least_z)] = 0
    best = np.argsort(-z, kind="stable")[:most]
    return np.sort(best[z[best] > 0]).astype(np.int32)


def train(docs: DataFrame, labels: DataFrame, fold: Column | None = None, label_col: str = "toxic",
          prior: float | None = None, id_col: str = "doc_id", text_col: str = "text",
          max_positive: int = MAX_POSITIVE, max_unlabelled: int = MAX_UNLABELLED,
          max_features: int = MAX_FEATURES) -> Model:
    """Fit on the documents where ``fold`` (a condition on the id) holds: those
    confirmed as ``label_col`` 1 in any label row are P, all of them are U. Samples
    are the smallest digests of the id, at most the given numbers.

    ``prior`` is by default the share of 1 among the fold's labels. Without any
    confirmed document the model scores everything with the prior (0 if no label).
    """
    spark = docs.sparkSession
    small_batches(spark)
    cond = F.lit(True) if fold is None else fold
    lab = labels.select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{label_col}`").alias("y")).where("y is not null and __id is not null")
    lab = lab.withColumnRenamed("__id", id_col).where(cond).withColumnRenamed(id_col, "__id")
    lab = lab.groupBy("__id").agg(F.max("y").alias("y"))
    total, ones = lab.agg(F.count("*"), F.coalesce(F.sum(F.when(F.col("y") == 1, 1).otherwise(0)), F.lit(0))).first()
    if not ones:
        return Model((), (), -40.0)
    pi = min(0.95, max(0.001, prior if prior is not None else ones / total))
    chosen = smallest_digests(lab.where("y = 1").select("__id"), max_positive).withColumn("p", F.lit(1))
    ids = docs.where(cond).select(F.col(f"`{id_col}`").alias("__id")).where("__id is not null")
    some = smallest_digests(ids, max_unlabelled).withColumn("p", F.lit(0))
    # Both samples are bounded above.
    sample = F.broadcast(chosen.unionByName(some))
    src = (docs.select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{text_col}`").cast("binary").alias("__text"))
           .join(sample, "__id").select("p", "__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            blobs = [text_features(t).tobytes() for t in b.column("__text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("p"), pa.array(blobs, pa.binary())], names=["p", "f"])

    got = sorted((r.p, bytes(r.f)) for r in src.mapInArrow(run, "p int, f binary").collect())
    pos, unl = [f for p, f in got if p], [f for p, f in got if not p]
    if not pos or not unl:
        return Model((), (), float(np.log(pi / (1 - pi))))
    features = select_features(pos, unl, pi, max_features)
    if not len(features):
        return Model((), (), float(np.log(pi / (1 - pi))))
    w, bias = nnpu_fit(_dense(pos, features), _dense(unl, features), pi)
    return Model(tuple(features.tolist()), tuple(w.tolist()), bias)


def score_toxicity(docs: DataFrame, model: Model, threshold: float = 0.7, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """``id_col, score, predicted`` for every row: the probability of label 1 and 1
    where it reaches ``threshold``. A null or empty text scores like one without
    any feature. Null or repeated ids and repeated rows keep a row each; other
    columns are ignored; an empty table gives an empty result."""
    small_batches(docs.sparkSession)
    src = docs.select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{text_col}`").cast("binary").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = model.scorer()
        for b in batches:
            s = [score(t) for t in b.column("__text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("__id"), pa.array(s, pa.float64())], names=["__id", "score"])

    out = src.mapInArrow(run, f"__id {src.schema['__id'].dataType.simpleString()}, score double")
    return out.select(F.col("__id").alias(id_col), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
