"""Session settings and the shared folder for stored intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_stored: dict[str, list[str]] = {}


def scratch_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``.

    Without that setting a folder in the warehouse is used, which driver and
    executors share as well.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return (folder or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_intermediate").rstrip("/")


def store(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back.

    Cuts lineage, survives the loss of executors, keeps column pruning and
    gives later joins real file sizes to plan with. ``release`` deletes what was stored.
    """
    spark = df.sparkSession
    path = f"{scratch_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _stored.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Delete the tables this session has stored; results that read them are over."""
    jvm = spark.sparkContext._jvm
    for path in _stored.pop(spark.sparkContext.applicationId, []):
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
