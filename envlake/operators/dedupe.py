"""First/last row per key (H2, G5, C10) without sorting whole groups.

``DISTINCT ON (k) ... ORDER BY k, o`` becomes ``min_by(struct(row), struct(o))``
per key: an aggregate with a map-side partial step, so a skewed key costs one
small buffer per task after it. (Spark runs it as a sort aggregate, because the
buffer is a struct: each task sorts its own rows by key before the partial step.)
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _order_struct(order: Sequence[tuple[str, str]]) -> Column:
    """Ascending ordering key as a struct: each column is preceded by a null
    flag so NULLs sort first or last as requested. Specs are
    'asc_nulls_last' / 'asc_nulls_first' (``first_per_key`` maps desc specs
    onto these and takes the maximum instead of the minimum)."""
    parts = []
    for c, spec in order:
        col = F.col(c)
        parts.append(col.isNull() if spec.endswith("nulls_last") else col.isNotNull())
        parts.append(col)
    return F.struct(*parts)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[tuple[str, str]],
                  keep: str = "first") -> DataFrame:
    """One row per ``keys``: the first (``keep='first'``) or last (``'last'``) row
    under ``order``. All order specs must share a direction (asc or desc); add a
    unique column last in ``order`` for a deterministic tie-break."""
    keys = list(keys)
    dirs = {spec.split("_")[0] for _, spec in order}
    if len(dirs) != 1:
        raise ValueError("mixed asc/desc order specs are not supported")
    desc = dirs.pop() == "desc"
    # For desc order the first row is the maximum, with nulls placement flipped.
    if desc:
        flipped = [(c, ("asc_nulls_first" if s.endswith("nulls_last") else "asc_nulls_last"))
                   for c, s in order]
        okey = _order_struct(flipped)
    else:
        okey = _order_struct(order)
    pick_min = (keep == "first") != desc
    cols = df.columns
    row = F.struct(*[F.col(c) for c in cols])
    agg = F.min_by(row, okey) if pick_min else F.max_by(row, okey)
    return df.groupBy(*keys).agg(agg.alias("__r")).select("__r.*")


def last_wins(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """Last row per key in ``order_cols`` ascending (dict-update semantics)."""
    return first_per_key(df, keys, [(c, "asc_nulls_first") for c in order_cols], keep="last")
