"""Readers and normalisers of source payloads."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.timeutils import ensure_utc

DAY_PRICES = T.StructType([T.StructField(n, T.DoubleType() if n.endswith(("kWh", "EXR")) else T.StringType()) for n in ("SEK_per_kWh", "EUR_per_kWh", "EXR", "time_start", "time_end")])


def read_day_prices(spark: SparkSession, path: str) -> DataFrame:
    """One JSON array per zone and local day, named ``<day>_<zone>.json``; EUR per kWh becomes EUR per MWh."""
    raw = spark.read.schema(DAY_PRICES).option("multiLine", True).json(path).withColumn("file", F.col("_metadata.file_name"))
    return raw.select(
        F.regexp_extract("file", r"_([A-Z]{2}\d)\.json$", 1).alias("zone"),
        F.to_timestamp("time_start").alias("timestamp"),
        F.round(F.col("EUR_per_kWh") * 1000, 2).alias("price_eur_mwh"),
        F.concat(F.lit("PT"), ((F.unix_timestamp(F.to_timestamp("time_end")) - F.unix_timestamp(F.to_timestamp("time_start"))) / 60).cast("int").cast("string"), F.lit("M")).alias("resolution"),
        F.col("SEK_per_kWh").alias("sek_per_kwh"),
        F.col("EUR_per_kWh").alias("eur_per_kwh"),
        F.col("EXR").alias("exr"),
        F.col("time_start").alias("time_start_local"),
        F.col("time_end").alias("time_end_local"),
    )


def read_hourly_arrays(spark: SparkSession, path: str, variables: list[str]) -> DataFrame:
    """Parallel arrays ``hourly.time[]``, ``hourly.<variable>[]`` as rows."""
    fields = [T.StructField("time", T.ArrayType(T.LongType()))] + [T.StructField(v, T.ArrayType(T.StringType())) for v in variables]
    schema = T.StructType([T.StructField("latitude", T.DoubleType()), T.StructField("longitude", T.DoubleType()), T.StructField("hourly", T.StructType(fields))])
    raw = spark.read.schema(schema).option("multiLine", True).json(path)
    return explode_arrays(raw, "hourly", variables, keys=["latitude", "longitude"])


def explode_arrays(df: DataFrame, col: str, variables: list[str], keys: list[str]) -> DataFrame:
    """Rows of parallel arrays (``time`` in unix seconds); what isn't a number becomes null; a missing variable is an error."""
    there = df.schema[col].dataType.fieldNames()
    if missing := [v for v in ["time", *variables] if v not in there]:
        raise ValueError(f"the payload lacks {missing}")
    zipped = F.arrays_zip(*[F.col(f"{col}.{v}").alias(v) for v in ["time", *variables]])
    rows = df.select(*keys, F.inline(zipped))
    return rows.select(*keys, F.timestamp_seconds("time").alias("timestamp"), *[F.col(v).try_cast("double").alias(v) for v in variables])


def parse_props(df: DataFrame, col: str = "props") -> DataFrame:
    return df.withColumn("k", F.from_json(col, "k int")["k"])


def snake(name: str) -> str:
    return re.sub(r"[^a-z0-9]+", "_", name.lower()).strip("_")


def normalise_series(df: DataFrame, value_name: str | None = None, ts: str = "timestamp") -> DataFrame:
    """Snake-case names, a UTC timestamp, doubles; a single value column can be renamed. Times without a zone are refused."""
    out = df.toDF(*[snake(c) for c in df.columns])
    ensure_utc(out, *[c for c, kind in out.dtypes if kind == "timestamp_ntz"])
    values = [c for c in out.columns if c != ts]
    names = {values[0]: value_name} if value_name and len(values) == 1 else {}
    return out.select(F.col(ts).cast("timestamp").alias(ts), *[F.col(c).try_cast("double").alias(names.get(c, c)) for c in values])


def normalise_events(df: DataFrame) -> DataFrame:
    """``start`` becomes ``timestamp`` and comes first; other times become UTC timestamps; sorted by time."""
    out = df.toDF(*[snake(c) for c in df.columns]).withColumnRenamed("start", "timestamp")
    ensure_utc(out, *[c for c, kind in out.dtypes if kind == "timestamp_ntz"])
    times = {c for c, kind in out.dtypes if kind.startswith("timestamp")}
    rest = [c for c in out.columns if c != "timestamp"]
    return out.select(*[F.col(c).cast("timestamp").alias(c) if c in times else F.col(c) for c in ["timestamp", *rest]]).orderBy("timestamp")
