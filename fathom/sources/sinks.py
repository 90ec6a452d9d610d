"""Writers: plain files, partitions replaced or upserted, content-addressed artifacts, small exports."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fathom.operators.aggregates import content_digest
from fathom.operators.reshape import upsert


#: Text files keep microseconds; Spark's own formats end at milliseconds.
TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def jsonl(df: DataFrame, path: str, mode: str = "append") -> None:
    df.write.mode(mode).options(**TIMES).json(path)


def flattened(df: DataFrame, prefix: str = "data_") -> DataFrame:
    """Structs spread into columns, their fields prefixed; maps and arrays as JSON text."""
    out = []
    for f in df.schema:
        if isinstance(f.dataType, T.StructType):
            out += [F.col(f"`{f.name}`.`{x}`").alias(f"{prefix}{x}") for x in f.dataType.names]
        elif isinstance(f.dataType, (T.MapType, T.ArrayType)):
            out.append(F.to_json(f"`{f.name}`").alias(f.name))
        else:
            out.append(F.col(f"`{f.name}`"))
    return df.select(*out)


def csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    flattened(df).write.mode(mode).options(header=True, **TIMES).csv(path)


def parquet(df: DataFrame, path: str, schema: T.StructType | None = None, partitions: Sequence[str] = (), mode: str = "overwrite") -> None:
    """Zstandard Parquet; with a schema, columns are cast to it and all-null ones stay."""
    if schema:
        df = df.select(*(F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema))
    writer = df.write.mode(mode).option("compression", "zstd")
    (writer.partitionBy(*partitions) if partitions else writer).parquet(path)


def replace_partitions(df: DataFrame, path: str, partitions: Sequence[str]) -> None:
    """Only the partitions that ``df`` has are replaced; running it again gives the same."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
    writer.partitionBy(*partitions).parquet(path)


def upsert_partitions(changes: DataFrame, path: str, key: Sequence[str], partition: str) -> None:
    """Changes applied by key to the partitions they touch; the others aren't read.

    The merged rows are checkpointed before the partitions they were read from are replaced.
    """
    spark = changes.sparkSession
    touched = changes.select(partition).distinct()
    current = spark.read.parquet(path).join(touched, partition, "left_semi").select(*changes.columns)
    replace_partitions(upsert(current, changes, key).checkpoint(), path, [partition])


def append_new(df: DataFrame, path: str, key: Sequence[str]) -> None:
    """Appends the rows whose key the table lacks: a batch that is sent again adds nothing, and of a key's rows in a batch one is taken."""
    there = df.sparkSession.read.parquet(path).select(*key)
    df.dropDuplicates(list(key)).join(there, list(key), "left_anti").select(*df.columns).write.mode("append").parquet(path)


def content_addressed(df: DataFrame, folder: str) -> str:
    """Writes the table below a name that is its digest, and returns the path; what is there already is kept.

    The table is written under another name and then renamed, so that a name is only ever that of a whole table.
    """
    spark, digest = df.sparkSession, content_digest(df, df.columns).first()
    path = f"{folder}/{digest['digest'] if digest['rows'] else 'empty'}"
    target, aside = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (path, f"{path}.{uuid.uuid4().hex}.tmp"))
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(target):
        df.write.option("compression", "zstd").parquet(aside.toString())
        if fs.exists(target) or not fs.rename(aside, target):  # another writer was first, with the same rows
            fs.delete(aside, True)
    return path


def xlsx(df: DataFrame, path: str, most_rows: int = 100_000) -> None:
    """A small table as an Excel file (needs an engine for pandas); larger ones are an error."""
    if df.limit(most_rows + 1).count() > most_rows:
        raise ValueError(f"more than {most_rows} rows")
    df.toPandas().to_excel(path, index=False)
