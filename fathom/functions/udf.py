"""User functions: a registry of column builders, Arrow UDFs, grouped UDAFs and table functions."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUILDERS: dict[str, Callable[..., Column]] = {}


def column(name: str):
    """Registers a column builder by name; see :func:`apply`."""

    def add(fn: Callable[..., Column]):
        BUILDERS[name] = fn
        return fn

    return add


def apply(df: DataFrame, name: str, alias: str | None = None, **arguments) -> DataFrame:
    if name not in BUILDERS:
        raise KeyError(f"no function {name!r}; there are {', '.join(sorted(BUILDERS))}")
    return df.withColumn(alias or name, BUILDERS[name](**arguments))


@column("typical_price")
def typical_price() -> Column:
    return (F.col("high") + F.col("low") + F.col("close")) / 3


@column("mid")
def mid(bid: str = "bid", ask: str = "ask") -> Column:
    return (F.col(bid) + F.col(ask)) / 2


@F.pandas_udf(T.DoubleType())
def trimmed_mean(x: pd.Series) -> float:
    """Mean without the tenth at either end: a UDAF that no built-in gives."""
    v = np.sort(x.dropna().to_numpy(float))
    k = len(v) // 10
    return float(v[k : len(v) - k].mean()) if len(v) else float("nan")


@F.udtf(returnType=T.StructType([T.StructField("n", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())]))
class Chunks:
    """``[start, stop)`` pieces of at most ``size``."""

    def eval(self, start: int, stop: int, size: int):
        for n, at in enumerate(range(start, stop, size)):
            yield n, at, min(stop, at + size)


def register(spark: SparkSession) -> None:
    """Makes the UDAF and the table function known to SQL."""
    spark.udf.register("trimmed_mean", trimmed_mean)
    spark.udtf.register("chunks", Chunks)
