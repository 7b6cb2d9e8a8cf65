"""Where intermediate tables go."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


_folders: list[str] = []


def scratch_folder(spark: SparkSession) -> str:
    """A new folder under ``spark.checkpoint.dir``, the cluster's shared folder."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    _folders.append(f"{root.rstrip('/')}/bugtide-{uuid.uuid4().hex}")
    return _folders[-1]


def stored() -> int:
    """How many tables have been stored and not released."""
    return len(_folders)


def release(spark: SparkSession, since: int = 0, keep: int = 0) -> None:
    """Delete the stored tables but the first ``since`` and the last ``keep``.

    Results that still read them must be done.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    end = len(_folders) - keep
    for folder in _folders[since:end]:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)
    del _folders[since:end]


def written(df: DataFrame, compression: str = "snappy") -> DataFrame:
    """The same rows, read back from Parquet.

    Used before an operator that reads its input more than once: the input is
    computed once, later passes read only the columns they need, and a lost
    executor costs a re-read rather than the whole lineage. Tables of long texts take less
    disk with ``compression="zstd"``, and more CPU.
    """
    spark = df.sparkSession
    folder = scratch_folder(spark)
    df.write.parquet(folder, compression=compression)
    return spark.read.schema(df.schema).parquet(folder)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Give every core a share of a table that comes in too few scan tasks.

    A single file with one row group is read by one task, and all the work on its
    rows would stay there. A table of many files is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(2 * cores, key)


def dealt_by(df: DataFrame, key: str) -> DataFrame:
    """Deal out narrow rows by the key at which wide ones will be joined to them.

    The join needs no other shuffle of them. As the number of tasks is given, the adaptive
    planner keeps it; it would merge tasks by the bytes they read, and one that reads little
    can still have many long texts to work on.
    """
    spark = df.sparkSession
    tasks = max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(tasks, key)
