"""Streaming queries: the table as a stream of files, run to its end."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.plans.feeds import PULLS_SQL, ev_sql, ntz, pulls, r6, series
from tidemark.plans.lake import CHANGES_SQL
from tidemark.plans.registry import query
from tidemark.sources.scratch import scratch
from tidemark.streaming import streams


@query(
    "stream_hourly",
    f"with {ev_sql()} select zone, date_trunc('hour', timestamp) as timestamp, round(avg(price), 6) as price, count(*) as n_periods from ev where date_trunc('hour', timestamp) + interval 1 hour <= (select max(timestamp) - interval 2 hour from ev) group by 1, 2",
)
def stream_hourly(spark, sf_dir):
    """Hours that the watermark has closed by the end of the input."""
    src = scratch(spark, "stream-in")
    series(spark, sf_dir).write.parquet(src)
    stream = spark.readStream.schema(spark.read.parquet(src).schema).parquet(src)
    out = scratch(spark, "stream-out")
    streams.run_to_table(streams.stream_hourly(stream), out, scratch(spark, "stream-state"))
    return spark.read.parquet(out).select("zone", ntz("timestamp").alias("timestamp"), r6("price").alias("price"), "n_periods")


#: Days of pull from which the second, third and fourth refresh of the silver queries get their rows.
REFRESHES = ("1994-01-01", "1996-01-01", "1997-06-01")


def refreshed(spark, sf_dir):
    """Four refreshes, each of the pulls that have arrived since the one before; the folder of the table."""
    src, out, state = (scratch(spark, f"silver-{n}") for n in ("in", "out", "state"))
    rows = pulls(spark, sf_dir)
    nth = sum((F.col("pulled_at") >= F.lit(d).cast("timestamp")).cast("int") for d in REFRESHES)
    for i in range(len(REFRESHES) + 1):
        rows.where(nth == i).write.mode("append").parquet(src)
        streams.stream_silver(spark, spark.readStream.schema(rows.schema).parquet(src), ["part"], out, state, values=["quantity", "discount"])
    return out


@query(
    "stream_silver",
    f"with {PULLS_SQL}, r as (select *, row_number() over (partition by part order by pulled_at desc, seq desc) as rn from pulls where valid) select part, pulled_at, snapshot, seq, quantity, price from r where rn = 1",
)
def stream_silver(spark, sf_dir):
    found = streams.silver_table(spark, refreshed(spark, sf_dir), ["part"])
    return found.select("part", ntz("pulled_at").alias("pulled_at"), "snapshot", "seq", "quantity", "price")


@query("stream_changes", CHANGES_SQL)
def stream_changes(spark, sf_dir):
    """The changes that the refreshes have logged are those of one pass over all pulls."""
    log = streams.silver_changes(spark, refreshed(spark, sf_dir))
    return log.withColumn("old_pulled_at", ntz("old_pulled_at")).withColumn("new_pulled_at", ntz("new_pulled_at"))
