"""Session helpers: the shared scratch folder and tables written into it."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_folder(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only where none is set and everything runs on one machine, as in tests, a folder
    is made; executors elsewhere could not read each other's files there.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    in_use = spark.sparkContext.getCheckpointDir()
    if named:
        if in_use is None:
            spark.sparkContext.setCheckpointDir(named)
        return named
    if in_use is None:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="netdays-"))
        in_use = spark.sparkContext.getCheckpointDir()
    return in_use


def new_scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_folder(spark)}/{label}-{uuid.uuid4().hex}"


def written(rows: DataFrame, label: str) -> DataFrame:
    """The rows as a written table: read many times, computed once.

    It outlives lost executors, and its file sizes tell the optimizer whether a
    later join may broadcast it.
    """
    spark = rows.sparkSession
    path = new_scratch_path(spark, label)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def checkpointed(rows: DataFrame) -> DataFrame:
    """The rows with fixed partitions and no lineage, kept in the scratch folder."""
    scratch_folder(rows.sparkSession)
    return rows.checkpoint()


# Settings the plans count on; all may be changed while a session runs.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even if the aggregate above it then needs a shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# The optimizer takes the bytes of files, which are compressed, and divides them among the columns
# by their types. Hashed, the key of a large table took 40 times such an estimate and more, all of
# it in the driver, so tables above this size are not broadcast.
BROADCAST = "spark.sql.autoBroadcastJoinThreshold"
BROADCAST_BYTES = 256 << 10


def configure(spark: SparkSession) -> SparkSession:
    """Switch adaptive execution and its skew handling on, and broadcasts of large tables off."""
    for key, value in ADAPTIVE.items():
        spark.conf.set(key, value)
    if spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold() > BROADCAST_BYTES:
        spark.conf.set(BROADCAST, str(BROADCAST_BYTES))
    return spark
