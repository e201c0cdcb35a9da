"""A fresh path in the folder that the cluster shares."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch(spark: SparkSession, name: str) -> str:
    """Under ``spark.checkpoint.dir``; only where that is unset (single-machine tests) under a temporary folder."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        own = tempfile.mkdtemp(prefix="tidemark-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        root = f"file://{own}"
    path = f"{root}/{name}-{uuid.uuid4().hex}"
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(jpath)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to a new scratch path and reread it."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
