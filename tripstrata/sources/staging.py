"""Staged tables: cut lineage, reuse a costly result and give the optimizer real sizes."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_dir(spark: SparkSession) -> str:
    """Shared scratch folder named by the cluster in ``spark.checkpoint.dir``.

    A folder on this machine is used only in local mode, where driver and executors
    are one process. On a cluster without the setting this fails instead of writing
    where other executors cannot read.
    """
    folder = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tripstrata-"))
        folder = spark.sparkContext.getCheckpointDir()
    return folder.rstrip("/")


def stage_table(df: DataFrame, name: str = "stage", partition_by: str | list[str] | None = None) -> DataFrame:
    """Write ``df`` once to a new scratch table and return a scan of it.

    Lost executors only cost the re-read of files. Unlike an estimated plan, the scan
    has a known size, so joins broadcast it only when it really is below the limit.
    """
    path = f"{scratch_dir(df.sparkSession)}/stages/{name}-{uuid.uuid4().hex}"
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_stage(df: DataFrame) -> None:
    """Delete the files of a frame returned by :func:`stage_table`."""
    spark = df.sparkSession
    roots = {f.split("/stages/")[1].split("/")[0] for f in df.inputFiles() if "/stages/" in f}
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for root in roots:
        path = jvm.org.apache.hadoop.fs.Path(f"{scratch_dir(spark)}/stages/{root}")
        path.getFileSystem(conf).delete(path, True)
