"""What the operators share: the shared scratch folder, written tables and Arrow slicing."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from urllib.parse import urlparse

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where it is unset, a temporary folder serves a session whose executors are threads of the driver; on a cluster that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        context = spark.sparkContext
        if not context._jsc.sc().getCheckpointDir().isDefined():
            if not context._jsc.sc().isLocal():
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            context.setCheckpointDir(tempfile.mkdtemp(prefix="fathom-"))
        base = context._jsc.sc().getCheckpointDir().get()
    return base.rstrip("/")


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A new path below the shared folder; no two calls give the same."""
    return f"{shared_dir(spark)}/fathom-{tag}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, tag: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: cuts the lineage, and lost executors cost no recomputation."""
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.scratch = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete tables that :func:`written` made, once nothing that is still to be computed reads them."""
    for t in tables:
        jvm, hadoop = t.sparkSession._jvm, t.sparkSession._jsc.hadoopConfiguration()
        folder = jvm.org.apache.hadoop.fs.Path(t.scratch)
        folder.getFileSystem(hadoop).delete(folder, True)


def local_path(path: str) -> str | None:
    """The path if plain file calls reach it on every machine (``file:`` or no scheme), else None."""
    parts = urlparse(path)
    return parts.path if parts.scheme in ("", "file") else None


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else. Spark's fast ``lower`` does the same where every character is one byte."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def byte_slices(batches: Iterator[pa.RecordBatch], column: int, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Slices whose texts in ``column`` hold about ``most`` bytes, so that few become Python objects at a time; a longer text comes alone."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start = total = 0
        for i, size in enumerate(sizes):
            if total and total + size > most:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += size
        if start < batch.num_rows:
            yield batch.slice(start)


def as_batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
