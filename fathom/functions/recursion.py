"""Recursive smoothers. A window frame can't refer to its own result, so each series goes through numpy once.

Conventions, frozen here: a smoother starts at the n-th non-null value, with the mean of the first n as
its seed; earlier rows are null; a null input keeps the last state and gives null.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

Series = np.ndarray


def smooth(x: Series, n: int, alpha: float) -> Series:
    """y = alpha x + (1 - alpha) y before it, seeded with the mean of the first ``n`` values."""
    out = np.full(len(x), np.nan)
    there = np.flatnonzero(~np.isnan(x))
    if len(there) < n:
        return out
    state = float(np.mean(x[there[:n]]))
    out[there[n - 1]] = state
    for i in there[n:]:
        state = alpha * x[i] + (1 - alpha) * state
        out[i] = state
    return out


def ema(x: Series, n: int) -> Series:
    return smooth(x, n, 2 / (n + 1))


def rma(x: Series, n: int) -> Series:
    return smooth(x, n, 1 / n)


def lag(x: Series, k: int = 1) -> Series:
    return np.concatenate((np.full(min(k, len(x)), np.nan), x[: max(0, len(x) - k)]))


def per_series(df: DataFrame, by: Sequence[str], order: Sequence[str], inputs: Sequence[str], outputs: Sequence[str], fn: Callable[[dict[str, Series]], dict[str, Series]]) -> DataFrame:
    """``df`` with the columns ``outputs`` that ``fn`` computes from each series' ordered ``inputs``.

    A series is one group: its rows must fit a worker, as those of one instrument's bars do. Columns pass unchanged; NaN results become null.
    """
    schema = T.StructType([*(f for f in df.schema if f.name not in outputs), *(T.StructField(o, T.DoubleType()) for o in outputs)])
    order, inputs = list(order), list(inputs)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(order, kind="stable").reset_index(drop=True)
        made = fn({c: rows[c].to_numpy(np.float64) for c in inputs})
        for name in outputs:
            rows[name] = pd.array(made[name], dtype="Float64")
            rows.loc[np.isnan(made[name]), name] = pd.NA
        return rows[schema.names]

    return df.groupBy(*by).applyInPandas(run, schema)
