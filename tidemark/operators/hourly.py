"""Aggregation of sub-hourly series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def to_hourly(df: DataFrame, col: str, keys: tuple[str, ...] = ("zone",), ts: str = "timestamp", resolution: str | None = None) -> DataFrame:
    """Mean per UTC hour with the number of periods; with ``resolution`` its single value in the hour, or ``mixed``."""
    extra = []
    if resolution:
        extra = [F.when(F.min(resolution) == F.max(resolution), F.min(resolution)).otherwise("mixed").alias("source_resolution")]
    return df.groupBy(*keys, F.date_trunc("hour", ts).alias(ts)).agg(F.avg(col).alias(col), F.count(F.lit(1)).alias("n_periods"), *extra)


def incomplete_hours(hourly: DataFrame, expected: int) -> DataFrame:
    """Hours whose number of periods isn't the expected one (1 for hourly, 4 for quarter-hourly data)."""
    return hourly.where(F.col("n_periods") != expected)
