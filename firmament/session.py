"""Session settings the jobs rely on and the shared folder they may write to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# All of these can be set on a running session.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    # Whole pages travel through Arrow in the card stage: keep batches small.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "256",
}

# Worth setting where a session is built: no call-site lookup per column function, so
# that large expressions such as the card rules are put together several times faster.
BUILD_SETTINGS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def tune(spark: SparkSession) -> SparkSession:
    """Adaptive execution with skew-join splitting, and UTC dates."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def checkpoint_folder(spark: SparkSession) -> str:
    """Shared folder for checkpoints: the cluster's, or a fresh one in local mode."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current is None:
        current = context.getConf().get("spark.checkpoint.dir")
        if current is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            current = tempfile.mkdtemp(prefix="firmament-")
        context.setCheckpointDir(current)
        current = context.getCheckpointDir()
    return current


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A path below the shared folder that nothing else uses."""
    return f"{checkpoint_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Materialise and cut lineage with a reliable checkpoint, which survives lost executors."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """``cut`` for what one round of a loop hands to the next: narrow rows as Parquet, whose size is known.

    A checkpoint keeps the size that was estimated for its plan, a product of all sizes joined.  Carried
    from round to round its digits multiply, and after five rounds planning takes a minute.
    """
    folder = new_folder(df.sparkSession, "round")
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
