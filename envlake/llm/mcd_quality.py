"""Quality rules with robust multivariate outliers.

Every text becomes a vector of transformed statistics. For each language and
source the minimum-covariance-determinant estimate - mean and covariance of the
``support`` share of rows whose covariance has the smallest determinant - is
found by concentration steps, and rows whose Mahalanobis distance to it is too
large are rejected. Two deterministic starts are tried (medians with scaled
quartile ranges, and classical moments); the one that ends with the smaller
determinant wins.

A step lowers the determinant (of the covariance with its floor) or leaves it;
steps go on until every start of every group stands still. Both starts go in one
pass. A step is two aggregations over the stored vectors: a sketch of the distances
brackets the rank, then the moments of the rows below the bracket and of each
distance inside it give those up to the exact rank. Both combine on the map side, so
a source with a third of all rows costs each task a few rows; one task orders the
distances inside a group's bracket, some thousandths of its rows. All rows count;
nothing is sampled.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from envlake.llm.common import small_batches, staged

#: Statistics and the least standard deviation they are credited with: where most
#: rows share one value (no symbols at all), its spread would be zero.
FEATURES = {"z_len": 0.5, "z_word": 0.05, "z_symbol": 0.4, "z_upper": 0.05, "z_distinct": 0.1, "z_repeat": 0.05,
            "z_lines": 0.5, "z_mark": 0.05}
Z = tuple(FEATURES)
SUPPORT = 0.75
#: A start stands still when a step lowers the determinant's logarithm by less.
LEAST_GAIN = 1e-6
#: Least rows of a group with estimates of its own; smaller ones of a language are pooled.
MIN_ROWS = 50
#: Share of regular rows whose distance exceeds the limit, if vectors were normal.
#: Real statistics have longer tails, so the limit is far out.
TAIL_Z = 6.0
_SYMBOLS = b"#*$%&|<>"
_WHITE = b" \t\n\v\f\r"


def chi2_quantile(p: int, z: float) -> float:
    """The chi-square quantile at the normal deviate ``z`` (Wilson and Hilferty)."""
    return p * (1 - 2 / (9 * p) + z * (2 / (9 * p)) ** 0.5) ** 3


def repeated_words(words: list[bytes], window: int = 5) -> int:
    """Words that lie in a window of ``window`` words found twice or more in the text."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    if len(number) == len(words):
        return 0
    # Exact codes: the code of a window is the rank of (code of all but its last word, last word).
    code = ids[:n]
    for k in range(1, window):
        _, code = np.unique(code * len(number) + ids[k:k + n], return_inverse=True)
    twice = np.bincount(code)[code] > 1
    if not twice.any():
        return 0
    edge = np.zeros(len(words) + 1, np.int64)
    edge[:n] += twice
    edge[window:] -= twice
    return int((np.cumsum(edge) > 0).sum())


def text_stats(text: bytes | None) -> tuple:
    """Counts of one UTF-8 text (null: empty): words, code points in words, symbols,
    repeated lines, words in repeated 5-word windows; then the vector of ``FEATURES``."""
    t = text or b""
    words = t.split()
    n = len(words)
    white = sum(t.count(c) for c in (b" ", b"\t", b"\n", b"\v", b"\f", b"\r"))
    points = int((np.frombuffer(t, np.uint8) & 0xC0 != 0x80).sum()) - white if t else 0
    symbols = sum(t.count(bytes([c])) for c in _SYMBOLS)
    lines = [x for x in t.split(b"\n") if x and x.strip(_WHITE)]
    dup = len(lines) - len(set(lines))
    repeat = repeated_words(words)
    upper = sum(map(t.count, _UPPER)) if n else 0
    marks = t.count(b"!") + t.count(b"?") + t.count(b"=") + t.count(b"{") + t.count(b"}")
    some = max(n, 1)
    vector = (np.log1p(n), np.log1p(points / some), np.log1p(100.0 * symbols / some), upper / max(points, 1),
              len(set(words)) / some ** 0.9, repeat / some, np.log1p(n / max(len(lines), 1)), np.log1p(10.0 * marks / some))
    return (n, points, symbols, dup, repeat, *map(float, vector))


_UPPER = [bytes([c]) for c in range(ord("A"), ord("Z") + 1)]
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def document_stats(docs: DataFrame, id_col: str, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    """``__id, __lang, __source``, the counts, the vector and ``base_failed``."""
    small_batches(docs.sparkSession)
    src = docs.select(F.col(f"`{id_col}`").alias("__id"), F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("")).alias("__lang"),
                      F.coalesce(F.col(f"`{source_col}`").cast("string"), F.lit("")).alias("__source"),
                      F.col(f"`{text_col}`").cast("binary").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [text_stats(t) for t in b.column("__text").to_pylist()]
            cols = list(zip(*rows)) if rows else [[]] * (len(_COUNTS) + len(Z))
            arrays = [pa.array(c, pa.int64() if i < len(_COUNTS) else pa.float64()) for i, c in enumerate(cols)]
            yield pa.RecordBatch.from_arrays([b.column(i) for i in range(3)] + arrays,
                                             names=["__id", "__lang", "__source", *_COUNTS, *Z])

    schema = ", ".join([f"__id {src.schema['__id'].dataType.simpleString()}", "__lang string", "__source string",
                        *[f"{c} bigint" for c in _COUNTS], *[f"{z} double" for z in Z]])
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return src.mapInArrow(run, schema).withColumn("base_failed", failed)


def _distance() -> Column:
    """Squared Mahalanobis distance to the group's ``m*`` under the inverse ``v*_*``."""
    total = F.lit(0.0)
    for i, a in enumerate(Z):
        for j in range(i, len(Z)):
            twice = 1.0 if i == j else 2.0
            total = total + F.lit(twice) * F.col(f"v{i}_{j}") * (F.col(a) - F.col(f"m{i}")) * (F.col(Z[j]) - F.col(f"m{j}"))
    return total


def _estimates(moments: DataFrame, consistency: float) -> DataFrame:
    """Mean, inverse covariance and log determinant of each group and start from its moment
    sums; one row each. A floor keeps every covariance invertible."""
    p = len(Z)
    floor = np.diag([s * s for s in FEATURES.values()])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = {k: f[k] for k in _START}
            got = []
            for r in f.itertuples(index=False):
                mean = np.array([getattr(r, f"s{i}") for i in range(p)]) / r.n
                cov = np.array([[getattr(r, f"q{min(i, j)}_{max(i, j)}") for j in range(p)] for i in range(p)]) / r.n
                cov = (cov - np.outer(mean, mean)) * consistency + floor
                inv = np.linalg.inv(cov)
                got.append([*mean, *[inv[i, j] for i in range(p) for j in range(i, p)], np.linalg.slogdet(cov)[1]])
            names = [*[f"m{i}" for i in range(p)], *[f"v{i}_{j}" for i in range(p) for j in range(i, p)], "logdet"]
            yield pd.DataFrame(out | {n: [g[k] for g in got] for k, n in enumerate(names)})

    names = ["g_lang string", "g_source string", "start int", *[f"m{i} double" for i in range(p)],
             *[f"v{i}_{j} double" for i in range(p) for j in range(i, p)], "logdet double"]
    return moments.mapInPandas(run, ", ".join(names))


_GROUP = ["g_lang", "g_source"]
_START = [*_GROUP, "start"]


def _moments() -> dict[str, Column]:
    """What a row adds to its group's moments."""
    return ({"n": F.lit(1.0)} | {f"s{i}": F.col(z) for i, z in enumerate(Z)}
            | {f"q{i}_{j}": F.col(Z[i]) * F.col(Z[j]) for i in range(len(Z)) for j in range(i, len(Z))})


def _up_to_rank(rows: DataFrame, keys: list[str], share: float, sums: dict[str, Column]) -> DataFrame:
    """``sums`` and the largest ``d2`` (``cut``) of each group's rows up to the exact rank
    ``ceil(share * rows)`` by ``d2``; rows that tie with the last one are in."""
    at = F.array(F.lit(max(0.0, share - 2 * _SKETCH)), F.lit(min(1.0, share + 2 * _SKETCH)))
    bounds = staged(rows.groupBy(*keys).agg(F.percentile_approx("d2", at, int(2 / _SKETCH)).alias("b"), F.count("*").alias("of"))
                    .select(*keys, F.col("b")[0].alias("low"), F.col("b")[1].alias("high"), F.ceil(F.col("of") * F.lit(share) - F.lit(1e-9)).alias("rank")), "bounds")
    cells = (rows.join(_sendable(bounds), keys).where("d2 <= high")
             .groupBy(*keys, "rank", F.when(F.col("d2") >= F.col("low"), F.col("d2")).otherwise(F.lit(-1.0)).alias("cell"))
             .agg(F.count("*").alias("c"), *[F.sum(v).alias(k) for k, v in sums.items()]))
    upto = F.sum("c").over(Window.partitionBy(*keys).orderBy("cell"))
    return (cells.withColumn("before", upto - F.col("c")).where("before < rank")
            .groupBy(*keys).agg(F.max("cell").alias("cut"), *[F.sum(k).alias(k) for k in sums]))


def mcd(rows: DataFrame, support: float = SUPPORT, least_gain: float = LEAST_GAIN) -> DataFrame:
    """The estimate of every group ``g_lang, g_source`` of stored vectors: ``m*``,
    ``v*_*`` (inverse covariance) and ``logdet``."""
    p = len(Z)
    # Covariance of the central share of a normal sample, made consistent.
    central = support / _chi2_cdf(chi2_quantile(p, _normal_quantile(support)), p + 2)
    spread = rows.groupBy(*_GROUP).agg(*[F.percentile_approx(z, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), 2000).alias(z) for z in Z])
    var = [((F.col(z)[2] - F.col(z)[0]) / 1.349) ** 2 + s * s for z, s in FEATURES.items()]
    robust = spread.select(
        *_GROUP, F.lit(0).alias("start"), *[F.col(z)[1].alias(f"m{i}") for i, z in enumerate(Z)],
        *[(1 / var[i] if i == j else F.lit(0.0)).alias(f"v{i}_{j}") for i in range(p) for j in range(i, p)])
    plain = rows.withColumn("start", F.lit(1)).groupBy(*_START).agg(*[F.sum(v).alias(k) for k, v in _moments().items()])
    # The first step counts as a gain: a start is no estimate of a support set.
    moving = staged(robust.unionByName(_estimates(plain, 1.0).drop("logdet")).withColumn("logdet", F.lit(float("inf"))), "estimates")
    ended = []
    while not moving.isEmpty():
        at = rows.join(_sendable(moving), _GROUP).withColumn("d2", _distance()).select(*_START, *Z, "d2")
        step = _estimates(_up_to_rank(at, _START, support, _moments()), central)
        step = staged(step.join(moving.select(*_START, F.col("logdet").alias("was")), _START), "estimates")
        ended.append(step.where(F.col("was") - F.col("logdet") < least_gain).drop("was"))
        moving = step.where(F.col("was") - F.col("logdet") >= least_gain).drop("was")
    if not ended:
        return moving.drop("start")
    best = reduce(DataFrame.unionByName, ended)
    return staged(best.groupBy(*_GROUP).agg(F.min_by(F.struct(*[c for c in best.columns if c not in _START]), F.struct("logdet", "start")).alias("e"))
                  .select(*_GROUP, "e.*"), "estimates")


#: Share of a group's rows by which the sketch may miss a rank, at most half of it.
_SKETCH = 1e-3
#: Groups whose estimates are sent to every task; more are joined by a shuffle.
MAX_SENT = 10_000


def _sendable(groups: DataFrame) -> DataFrame:
    """One row a group: broadcast if counted as few (some 400 bytes each)."""
    return F.broadcast(groups) if groups.limit(MAX_SENT + 1).count() <= MAX_SENT else groups


def _normal_quantile(q: float) -> float:
    from statistics import NormalDist
    return NormalDist().inv_cdf(q)


def _chi2_cdf(x: float, p: int) -> float:
    from statistics import NormalDist
    return NormalDist().cdf(((x / p) ** (1 / 3) - (1 - 2 / (9 * p))) / (2 / (9 * p)) ** 0.5)


def _grouped(stats: DataFrame, min_rows: int) -> DataFrame:
    """Adds ``g_lang, g_source``: the row's own group, or the pool of its language's
    small groups, or the pool of all that are still too small."""
    sizes = stats.groupBy("__lang", "__source").agg(F.count("*").alias("n"))
    small = sizes.where(F.col("n") < min_rows)
    pools = small.groupBy("__lang").agg(F.sum("n").alias("pool"))
    key = (sizes.join(pools, "__lang", "left")
           .withColumn("g_source", F.when(F.col("n") >= min_rows, F.concat(F.lit("="), "__source")).otherwise(""))
           .withColumn("g_lang", F.when((F.col("n") >= min_rows) | (F.col("pool") >= min_rows), F.concat(F.lit("="), "__lang")).otherwise(""))
           .select("__lang", "__source", *_GROUP))
    return stats.join(_sendable(staged(key, "groups")), ["__lang", "__source"])


def robust_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                   source_col: str = "source", support: float = SUPPORT, least_gain: float = LEAST_GAIN,
                   min_rows: int = MIN_ROWS, tail_z: float = TAIL_Z) -> DataFrame:
    """Verdict for every row: ``id_col``, the counts, ``base_failed``, ``distance``
    (squared, scaled so that the group's median is the normal one) and ``kept``.

    ``base_failed``: under 10 words, or over a fifth of the words in repeated
    5-word windows. ``kept`` is false if so, else whether the distance is within
    the limit of ``tail_z`` normal deviates.

    A null text is empty; a null language or source is the group ``''``. Groups of
    fewer than ``min_rows`` rows are pooled by language, then over all; if even
    that pool has fewer, the distance is null and only the base rule decides.
    Estimates are over rows that pass the base rule. Null or repeated ids and
    repeated rows keep a row each; other columns are ignored; an empty table gives
    an empty result.
    """
    p = len(Z)
    stats = staged(document_stats(docs, id_col, text_col, lang_col, source_col), "stats")
    passed = staged(_grouped(stats.where("not base_failed"), min_rows), "passed")
    enough = staged(passed.groupBy(*_GROUP).count().where(F.col("count") >= min_rows).select(*_GROUP), "enough")
    rows = staged(passed.join(_sendable(enough), _GROUP, "left_semi").select(*_GROUP, *Z), "vectors")
    est = mcd(rows, support, least_gain)
    far = passed.join(_sendable(est), _GROUP, "left").withColumn("d2", _distance())
    far = staged(far.select("__id", *_COUNTS, *_GROUP, "d2"), "distances")
    middle = staged(_up_to_rank(far.where("d2 is not null").select(*_GROUP, "d2"), _GROUP, 0.5, {}).withColumnRenamed("cut", "middle"), "medians")
    # Medians below the normal one come from floors, not from a narrow group.
    scale = F.greatest(F.col("middle") / chi2_quantile(p, 0.0), F.lit(1.0))
    limit = chi2_quantile(p, tail_z)
    judged = (far.join(_sendable(middle), _GROUP, "left").withColumn("distance", F.col("d2") / scale)
              .select("__id", *_COUNTS, F.lit(False).alias("base_failed"), "distance",
                      (F.col("distance").isNull() | (F.col("distance") <= limit)).alias("kept")))
    out = stats.where("base_failed").select("__id", *_COUNTS, "base_failed", F.lit(None).cast("double").alias("distance"),
                                            F.lit(False).alias("kept"))
    return judged.unionByName(out).withColumnRenamed("__id", id_col)
