"""Catalogs of evidence: marks from small tables, views of what may be used, contract masters, snapshot revisions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fathom.operators.aggregates import content_digest
from fathom.operators.evidence import classified, flags
from fathom.sources.sinks import replace_partitions

#: Columns of an instrument's history that are left out where they say nothing.
ACTIONS = ("dividends", "capital_gains", "stock_splits")


def marked(df: DataFrame, sides: Mapping[str, DataFrame], on: Sequence[str]) -> DataFrame:
    """Adds a boolean per side: whether it has the row's key. Rows never multiply, as a side's keys are made distinct; a null key is on no side."""
    for name, side in sides.items():
        df = df.join(side.select(*on).distinct().withColumn(name, F.lit(True)), list(on), "left").withColumn(name, F.coalesce(name, F.lit(False)))
    return df


def consumable(pointers: DataFrame, events: DataFrame, admissions: DataFrame, snapshots: DataFrame, bars: DataFrame, literals: DataFrame) -> DataFrame:
    """Bars that a pointer shows: its event is known, its basis admitted, its snapshot ready and the bar's literal clean."""
    basis = ["snapshot_id", "adjustment_basis"]
    shown = pointers.join(events.select("event_id", "known_at"), "event_id").join(admissions.select(*basis), basis)
    shown = shown.join(snapshots.where("state = 'ready'").select("snapshot_id", "source_available_at"), "snapshot_id")
    clean = literals.where("disposition = 'clean'").drop("disposition")
    return bars.join(shown.drop("event_id"), basis).join(clean, ["snapshot_id", "value_id"])


def admission(lineage: DataFrame) -> DataFrame:
    """Per value: has it a clean and complete source, a confirmed partial one, either. A failed origin is no veto on the others."""
    clean, partial = F.bool_or(F.col("complete") & F.col("source_ok")), F.bool_or("confirmed_partial")
    out = lineage.groupBy("value_id").agg(F.coalesce(clean, F.lit(False)).alias("clean_source"), F.coalesce(partial, F.lit(False)).alias("partial_source"))
    return out.withColumn("admissible", F.col("clean_source") | F.col("partial_source"))


def catalog_views(variants: DataFrame, faults: Sequence[str], bases: Mapping[str, str], numbers: Sequence[str]) -> dict[str, DataFrame]:
    """Views of the variants: ``conflicts``, ``quarantine``, and one for each basis (requested flag -> name) with its ``numbers`` as doubles.

    A variant has ``variant_count``, ``requested``, ``given``, ``admissible`` and the boolean ``faults``; an unknown fault
    is none, an unknown admission is a refusal.
    """
    several = F.col("variant_count") > 1
    faulty = reduce(Column.__or__, (F.coalesce(F.col(c), F.lit(False)) for c in faults), F.lit(False))
    refused = several | faulty | ~F.coalesce("admissible", F.lit(False)) | ~F.col("requested").eqNullSafe(F.col("given"))
    views = {"conflicts": variants.where(several), "quarantine": variants.where(refused)}
    for flag, name in bases.items():
        usable = variants.where((F.col("requested") == flag) & ~refused)
        views[name] = usable.withColumns({n: F.col(n).try_cast("double") for n in numbers}).withColumn("base_adjustment", F.lit(name))
    return views


def publish(views: Mapping[str, DataFrame], prefix: str = "") -> list[str]:
    """Temporary views of these names, for SQL."""
    for name, df in views.items():
        df.createOrReplaceTempView(prefix + name)
    return [prefix + name for name in views]


def contract_master(df: DataFrame, day: Column, exchange: str, source: str, underlyings: Sequence[str] | None = None) -> DataFrame:
    """Adds ``reason`` (first rule broken), ``disposition`` and ``quality_flags`` to option contracts.

    All rows of a repeated symbol are duplicates. An unknown unit or source date is a flag, but an official source has a date.
    """
    strike, unit, known = F.col("strike"), F.col("contract_unit"), F.col("source_date").isNotNull()
    rules = [
        ("invalid_code", ~F.col("symbol").rlike("^[0-9]{8}$") | ~F.col("underlying").rlike("^[0-9]{6}$")),
        ("duplicate_contract", F.count("*").over(Window.partitionBy("symbol")) > 1),
        ("exchange_mismatch", F.col("exchange") != exchange),
        ("underlying_scope_mismatch", F.lit(False) if underlyings is None else ~F.col("underlying").isin(list(underlyings))),
        ("metadata_source_mismatch", F.col("metadata_source") != source),
        ("invalid_option_type", ~F.col("option_type").isin("call", "put")),
        ("invalid_strike", F.isnan(strike) | (strike <= 0)),
        ("expired_contract", F.col("expiration") < day),
        ("metadata_date_mismatch", known & (F.col("source_date") != day)),
        ("missing_metadata_date", ~known & F.lit(source == "official")),
        ("invalid_contract_unit", unit.isNotNull() & (F.isnan(unit) | (unit <= 0))),
    ]
    noted = flags(unknown_contract_unit=unit.isNull(), metadata_source_date_unavailable=~known)
    return classified(df.withColumn("quality_flags", noted), rules)


def stacked_tickers(wide: DataFrame, symbols: Sequence[str], fields: Sequence[str], date: str = "date", sep: str = "_", start=None, end=None) -> DataFrame:
    """One row per date and symbol of a table with a column for each symbol and field, where the open is above zero.

    ``end`` counts only with an earlier ``start``. Action columns that add up to zero are left out, which one aggregation tells.
    """
    rows = [F.struct(F.lit(s).alias("symbol"), *(F.col(f"`{s}{sep}{f}`").alias(f.lower().replace(" ", "_")) for f in fields)) for s in symbols]
    out = wide.select(date, F.inline(F.array(*rows))).where("open > 0")
    if start is not None:
        out = out.where(F.col(date) >= F.lit(start))
        if end is not None and end > start:
            out = out.where(F.col(date) <= F.lit(end))
    there = [c for c in ACTIONS if c in out.columns]
    sums = out.agg(*(F.sum(c).alias(c) for c in there)).first() if there else {}
    return out.drop(*(c for c in there if not sums[c]))


def _there(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


class Snapshots:
    """Revisions of the rows of each key, by content, and a pointer to the current one.

    ``data`` has every revision once, partitioned by key and digest; ``pointers`` is replaced last, key by key. A commit
    that dies before that leaves the old pointers, and running it again completes it.
    """

    def __init__(self, spark: SparkSession, path: str, key: Sequence[str], schema: T.StructType):
        self.spark, self.path, self.key, self.schema = spark, path, list(key), schema
        self.names = [*self.key, "digest"]

    def _read(self, part: str, fields: T.StructType) -> DataFrame:
        path = f"{self.path}/{part}"
        return self.spark.read.schema(fields).parquet(path) if _there(self.spark, path) else self.spark.createDataFrame([], fields)

    def _fields(self, *more: T.StructField) -> T.StructType:
        return T.StructType([*(self.schema[k] for k in self.key), T.StructField("digest", T.StringType()), *more])

    def pointers(self) -> DataFrame:
        return self._read("pointers", self._fields(T.StructField("rows", T.LongType())))

    def revisions(self) -> DataFrame:
        """(key, ``digest``, ``rows``) of each revision ever committed."""
        return self.data().groupBy(*self.names).agg(F.count("*").alias("rows"))

    def data(self) -> DataFrame:
        return self._read("data", T.StructType([*self.schema, T.StructField("digest", T.StringType())]))

    def current(self) -> DataFrame:
        return self.data().join(self.pointers().select(*self.names), self.names, "left_semi").select(*self.schema.names)

    def commit(self, rows: DataFrame) -> DataFrame:
        """Makes ``rows`` the current ones of their keys, other keys stay; returns (key, ``digest``, ``rows``) of the keys that changed.

        Content that a key had before is pointed to again, not written again. A null in the key can't be a folder's name: it is an error.
        """
        rows = rows.select(*self.schema.names)
        for k in self.key:
            rows = rows.withColumn(k, F.when(F.col(k).isNull(), F.raise_error(F.lit(f"null in {k}"))).otherwise(F.col(k)))
        found = content_digest(rows, self.schema.names, by=self.key)
        changed = found.join(self.pointers().select(*self.names), self.names, "left_anti").select(*self.names, "rows").checkpoint()
        new = changed.join(self.data().select(*self.names).distinct(), self.names, "left_anti").select(*self.names).checkpoint()
        replace_partitions(rows.join(new, self.key), f"{self.path}/data", self.names)
        replace_partitions(changed, f"{self.path}/pointers", self.key)
        return changed
