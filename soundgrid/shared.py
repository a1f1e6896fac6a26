"""The cluster's shared folder: reliable checkpoints, and folders for what is written and read back."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (spark.checkpoint.dir, or that of the context).

    A machine-local folder of our own only where none is set and the master is local, as in tests; a cluster without one is an error, since lost executors would lose data.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir")
    current = sc._jsc.sc().getCheckpointDir()
    if current.isEmpty():
        if not named and not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir names no shared folder")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="soundgrid-"))
        current = sc._jsc.sc().getCheckpointDir()
    return named or current.get()


_SCRATCH: list[str] = []


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder of ours in the shared one, for what an operator writes and reads back; `release` removes them all."""
    _SCRATCH.append(f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}")
    return _SCRATCH[-1]


def remove(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Remove the folders of `scratch`, once no result that reads them is wanted any more."""
    while _SCRATCH:
        remove(spark, _SCRATCH.pop())


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: a lost executor does not lose it, and later reads do not recompute.

    Shuffle files go when the driver has collected what held them (superseded checkpoints too, where the cluster sets
    spark.cleaner.referenceTracking.cleanCheckpoints); an iteration would otherwise pile them up, so the driver is asked to collect here.
    """
    shared_dir(df.sparkSession)
    done = df.checkpoint(eager=True)
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()
    return done


def unclashing(df: DataFrame, *names: str) -> None:
    """An operator's own column names must not be the table's: they would be overwritten or dropped."""
    if found := sorted(set(names) & set(df.columns)):
        raise ValueError(f"columns {', '.join(found)} are reserved for this operator; rename them first")
