"""Shared helpers: the cluster's shared folder, materialised tables and text normalisation."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir`` of the session.

    Only where that is unset (single-machine tests) is a temporary folder made and set.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir")
    if named:
        return named
    if not getattr(sc, "_tidemark_shared", None):
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        own = tempfile.mkdtemp(prefix="tidemark-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        sc._tidemark_shared = f"file://{own}"
        sc.setCheckpointDir(sc._tidemark_shared)
    return sc._tidemark_shared


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, removed by Spark's file system layer when the session ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(jpath)
    return path


def materialise(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and reread it: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files behind a table of :func:`materialise` that no later plan reads."""
    spark = df.sparkSession
    for file in {f.rpartition("/")[0] for f in df.inputFiles()}:
        jpath = spark._jvm.org.apache.hadoop.fs.Path(file)
        jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(jpath, True)


def prepare(spark: SparkSession, rows: int = 512) -> None:
    """Get a session ready for Python workers.

    Bounds the rows of an Arrow batch, beside Spark's own bound of 64 MB (``spark.sql.execution.arrow.maxBytesPerBatch``;
    a longer text is a batch of its own), and lets workers on this machine import the package from where the driver has
    it (a cluster gets it by ``--py-files``). The bound is a setting of the session and stays: plans read it when they run.
    """
    home = str(Path(__file__).parents[2])
    path = spark.sparkContext.environment.get("PYTHONPATH", "")
    if home not in path.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [home, path]))
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key, "10000")) > rows:
        spark.conf.set(key, str(rows))


def join_uneven(rows: DataFrame, groups: DataFrame, key: str, sizes: DataFrame) -> DataFrame:
    """Left join of ``rows`` with a table of unique text keys, spread evenly whatever the keys.

    ``sizes`` is a stored table ``key, n``: how many of the ``rows`` have a key, for all keys that more than one has, whether
    ``groups`` has them or not. At most ``4 * shuffle partitions`` keys can have such a share of these rows that they fill a
    partition: those are looked up by broadcast and their rows dealt out by a running number, as are rows without a key,
    which have no partner. The others join by a shuffle.
    """
    most = 4 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = sizes.agg(F.sum("n")).first()[0] or 0
    values = [c for c in groups.columns if c != key]
    hot = sizes.where(F.col("n") * most > total).select(key)
    hot = F.broadcast(hot.join(groups, key, "left").select(key, F.struct(F.lit(True).alias("is"), *values).alias("_hot")))
    dealt = F.concat(F.lit("#"), F.monotonically_increasing_id().cast("string"))
    spread = F.when(F.col("_hot").isNull() & F.col(key).isNotNull(), F.col(key)).otherwise(dealt)
    cold = groups.select(F.col(key).alias("_key"), F.struct(*values).alias("_cold"))
    joined = rows.join(hot, key, "left").withColumn("_key", spread).join(cold, "_key", "left")
    return joined.select(*rows.columns, *[F.coalesce(F.col(f"_hot.{v}"), F.col(f"_cold.{v}")).alias(v) for v in values])


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only. ``lower`` does the same to texts of ASCII letters alone, several times faster."""
    return F.when(F.octet_length(col) == F.length(col), F.lower(col)).otherwise(F.translate(col, UPPER, UPPER.lower()))


def held_out(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5, is 0. A null id is never held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def labelled_sample(labels: DataFrame, id_col: str, label_col: str, size: int) -> DataFrame:
    """``id, gold``: at most ``size`` labelled training documents of each class, picked by the hash of the id.

    A hash threshold leaves about twice as many before the exact ranking, so that no partition sends more than its share.
    """
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
    known = known.groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("gold"))
    totals = {r.gold: r["count"] for r in known.groupBy("gold").count().collect()}
    parts = []
    for y in (0, 1):
        near = F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < (2 * size << 20) // max(1, totals.get(y, 0)) + 64
        parts.append(known.where((F.col("gold") == y) & near).orderBy(F.xxhash64("id"), "id").limit(size))
    return parts[0].unionByName(parts[1])
