"""Cutting the lineage of an intermediate result that several later steps read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Most that is sent to every executor on request, as text length plus eight bytes per value.
BROADCAST_BYTES = 32 * 1024 * 1024


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate results: the one the cluster names in ``spark.checkpoint.dir``. On
    one machine, where it may be unset, one in the warehouse; a cluster without it is refused, as its
    executors would not find each other's files."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors see")
    return folder or f"{spark.conf.get('spark.sql.warehouse.dir')}/_staging"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder of intermediate results from whatever store it is in."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and continue from the written copy.

    The copy survives lost executors. Checkpoints rather than tables, as Spark removes a checkpoint
    once nothing refers to it any more (``spark.cleaner.referenceTracking.cleanCheckpoints``).
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def measured_size(df: DataFrame) -> int:
    """Text length plus eight bytes per value, of all rows."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    size = F.lit(8 * len(df.columns))
    for name in texts:
        size = size + F.coalesce(F.octet_length(name), F.lit(0))
    return df.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Stage ``df``, measure it, and mark it for broadcast only when it is within ``limit``.

    Beyond the limit the join that uses it shuffles both sides, and adaptive execution splits the
    partitions of very frequent keys.
    """
    df = stage(df)
    return F.broadcast(df) if measured_size(df) <= limit else df


def is_broadcast(df: DataFrame) -> bool:
    """Whether ``broadcast_if_small`` has marked ``df``."""
    return df._jdf.queryExecution().analyzed().nodeName() == "ResolvedHint"
