"""Session settings the jobs rely on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Wide rows carry many null columns and aliases; inferring constraints over them makes planning
    # time grow exponentially, so filters are written where they are needed instead.
    "spark.sql.constraintPropagation.enabled": "false",
    # Hash aggregation over arrays and structs falls back to sorting after this many keys per task.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "20000",
    # The JVM never compiles a method beyond 8,000 bytes of code; a wide stage that would need one runs operator by operator.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "parquet.dictionary.page.size": "1048576",
}


def write_long_texts_once(spark: SparkSession) -> None:
    """Texts of megabytes that many rows share are written once a row group, not once a row, until the session is configured again.

    A column's dictionary must hold them; with Parquet's 1 MB, rows of longer texts are written out in full.
    """
    spark.conf.set("parquet.dictionary.page.size", str(64 << 20))


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared folder from ``spark.checkpoint.dir``; a private one only where none is set."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="tidewatch-")
        spark.conf.set("spark.checkpoint.dir", shared)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(os.path.join(shared, "rdd"))
    return shared


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: cuts the lineage, survives lost executors."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, folder: str) -> None:
    """Remove tables stored below ``folder`` of the shared folder, once nothing reads them any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{ensure_checkpoint_dir(spark)}/{folder}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
