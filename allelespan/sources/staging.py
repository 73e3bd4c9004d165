"""Tables between jobs, in the folder that the cluster names."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: Tables that this driver has staged.
_written: list[str] = []


def clear(spark: SparkSession) -> int:
    """Deletes all that was staged so far; for when the results that read it have been written. Returns the number of tables."""
    n = 0
    while _written:
        path = spark._jvm.org.apache.hadoop.fs.Path(_written.pop())
        n += bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True))
    return n


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, else the context's checkpoint folder. A temporary one only where neither is set and
    all tasks run on this machine: elsewhere executors could not read what others wrote."""
    context = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if found is None and not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if found is None:
        found = getattr(spark, "_allelespan_dir", None)
        if found is None:
            found = spark._allelespan_dir = tempfile.mkdtemp(prefix="allelespan-")
    return found


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; clear() deletes what is written there."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def staged(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet in the shared folder and read back: computed once, lineage cut, safe if executors are lost."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """df dealt out to all cores where its files give fewer partitions than there are cores; large inputs stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
