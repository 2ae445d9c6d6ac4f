"""The rolling rank share for many long series: one pass of array comparisons per security, instead of a list per row."""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Comparisons held at a time.
CELLS = 1 << 21


def shares(codes: np.ndarray, null: int, n: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Rank share of each place among the last n ones, and where there is none; codes are in the values' order, ``null`` above all."""
    n = max(1, min(n, len(codes)))
    seen = np.concatenate([[0], np.cumsum(codes != null)])
    ends = np.arange(1, len(codes) + 1)
    size = seen[ends] - seen[np.maximum(ends - n, 0)]
    frames = np.lib.stride_tricks.sliding_window_view(np.concatenate([np.full(n - 1, null, codes.dtype), codes]), n)
    out, step = np.zeros(len(codes)), max(1, CELLS // n)
    for i in range(0, len(codes), step):
        own = codes[i : i + step, None]
        below, same = (np.count_nonzero(f(frames[i : i + step], own), axis=1) for f in (np.less, np.equal))
        out[i : i + step] = (below + (same + 1) / 2) / np.maximum(size[i : i + step], 1)
    return out, (codes == null) | (size < least)


def _ranked(t: pa.Table, date: str, value: str, n: int, least: int) -> pa.Table:
    t = t.sort_by(date)
    x = t[value].combine_chunks()
    missing = x.is_null().to_numpy(zero_copy_only=False)
    kinds, codes = np.unique(x.fill_null(0.0).to_numpy(zero_copy_only=False), return_inverse=True)  # NaN is one value above all, as in Spark
    codes = np.where(missing, len(kinds), codes).astype(np.int32)
    out, none = shares(codes, len(kinds), n, least)
    return t.drop([value]).append_column("share", pa.array(out, mask=none))


def rolling_rank_share(d: DataFrame, key: str, date: str, value: str, n: int, least: int) -> DataFrame:
    """key, date, share: the same as ``windows.rolling_rank_share`` over a key's rows by date (each date once)."""
    ranked = functools.partial(_ranked, date=date, value=value, n=n, least=least)

    def run(t: pa.Table) -> pa.Table:
        return ranked(t)

    d = d.select(key, date, value)
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in d.schema.fields[:2])
    return d.groupBy(key).applyInArrow(run, f"{kinds}, share double")
