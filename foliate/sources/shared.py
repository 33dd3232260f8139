"""Tables in the folder that driver and executors share."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Only where that is unset, as in tests on one machine, a temporary folder is used.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "file://" + os.path.join(tempfile.gettempdir(), "foliate-checkpoints")
    return folder.rstrip("/")


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write df as Parquet into the shared folder and read it back.

    This cuts the lineage, so a lost executor costs a reread and not a recomputation.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/foliate/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Remove a table that materialize wrote, once nothing that is still to run reads it."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/foliate/" in folder:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def spread(df: DataFrame) -> DataFrame:
    """df in as many partitions as there are cores where a scan has fewer, as that of a small file has.

    It moves a table only if all of it fits fewer scan tasks than there are cores; others are left alone.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
