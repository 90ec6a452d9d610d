"""Session settings and the driver's tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings above; the cluster's own (``spark.checkpoint.dir``, memory) stay as they are."""
    builder = SparkSession.builder.appName("fathom").config(map=SETTINGS | settings)
    return (builder.master(master) if master else builder).getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, tag: str) -> str:
    """A new path in the folder that driver and executors share; a temporary one only where none is set and executors are the driver's threads."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        context = spark.sparkContext
        if not context._jsc.sc().getCheckpointDir().isDefined():
            if not context._jsc.sc().isLocal():
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            context.setCheckpointDir(tempfile.mkdtemp(prefix="fathom-"))
        base = context._jsc.sc().getCheckpointDir().get()
    return f"{base.rstrip('/')}/fathom-{tag}-{uuid.uuid4().hex[:12]}"
