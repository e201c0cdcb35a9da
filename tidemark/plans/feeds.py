"""How the engine's inputs derive from the given tables, in Spark and as SQL fragments.

``events`` gives sub-hourly series: the zone is the event type, the price its value; 75 days later they span
the spring change of clocks (2024-03-16 to 2024-04-14), 285 days later the autumn one. ``lineitem`` gives
overlapping pulls (key: part, pull: ship date) and wide readings; ``orders`` long daily series.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.timeutils import hour_occurrence

QS = (0.05, 0.10, 0.25, 0.50, 0.75, 0.90, 0.95)
QCOLS = tuple(f"q{round(q * 100):02d}" for q in QS)
SPRING, AUTUMN = 75, 285
#: Last target day that forecasts of the metric queries learn from.
SPLIT = "2024-04-04"
#: Shifts and last days of learning by which forecasts have days of 23 and of 25 hours.
CLOCK_CHANGES = ((SPRING, "2024-03-27"), (AUTUMN, "2024-10-24"))


def ntz(col: str | Column) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("timestamp_ntz")


def r6(col: str | Column) -> Column:
    return F.round((F.col(col) if isinstance(col, str) else col) + 1e-9, 6)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def series(spark: SparkSession, sf_dir: str, shift: int = SPRING) -> DataFrame:
    """``zone, event_id, timestamp, price``: NaN becomes null."""
    ev = read(spark, sf_dir, "events")
    return ev.select(
        F.col("event_type").alias("zone"),
        "event_id",
        (F.col("ts").cast("timestamp") + F.expr(f"interval {shift} days")).alias("timestamp"),
        F.nanvl("value", F.lit(None).cast("double")).alias("price"),
    )


def ev_sql(shift: int = SPRING) -> str:
    return f"ev as (select event_type as zone, event_id, ts + interval {shift} day as timestamp, value as price from events)"


def hourly(spark: SparkSession, sf_dir: str, shift: int = SPRING) -> DataFrame:
    from tidemark.operators.hourly import to_hourly

    return to_hourly(series(spark, sf_dir, shift), "price").select("zone", "timestamp", "price", "n_periods")


def hourly_sql(shift: int = SPRING) -> str:
    return ev_sql(shift) + ", hourly as (select zone, date_trunc('hour', timestamp) as timestamp, avg(price) as price, count(*) as n_periods from ev group by 1, 2)"


def loc(ts: str) -> str:
    return f"timezone('Europe/Stockholm', timezone('UTC', {ts}))"


def keyed(spark: SparkSession, sf_dir: str, shift: int = SPRING) -> DataFrame:
    return hour_occurrence(hourly(spark, sf_dir, shift), ["zone"])


def keyed_sql(shift: int = SPRING) -> str:
    return hourly_sql(shift) + f""", keyed as (
  select *, row_number() over (partition by zone, local_date, local_hour order by timestamp) as occurrence from (
    select *, cast({loc('timestamp')} as date) as local_date, hour({loc('timestamp')}) as local_hour from hourly))"""


#: Days back of the two models that most queries compare.
LAGS = (1, 7)


def lagged(spark: SparkSession, sf_dir: str, shift: int = SPRING, lags: tuple[int, ...] = LAGS) -> DataFrame:
    """``zone, target_time, target_date, local_hour, y`` and ``p_lag1d, p_lag7d``, or the lags that are asked for."""
    from tidemark.operators.features import same_local_hour

    rows = base = keyed(spark, sf_dir, shift)
    for k in lags:
        rows = same_local_hour(rows, base, k, f"p_lag{k}d")
    return rows.select("zone", F.col("timestamp").alias("target_time"), F.col("local_date").alias("target_date"), "local_hour", F.col("price").alias("y"), *[f"p_lag{k}d" for k in lags])


def lagged_sql(shift: int = SPRING, lags: tuple[int, ...] = LAGS) -> str:
    joins = "\n".join(f"  left join keyed l{k} on l{k}.zone = k.zone and l{k}.local_date = k.local_date - {k} and l{k}.local_hour = k.local_hour and l{k}.occurrence = 1" for k in lags)
    return keyed_sql(shift) + f""", lagged as (
  select k.zone, k.timestamp as target_time, k.local_date as target_date, k.local_hour, k.price as y, {', '.join(f'l{k}.price as p_lag{k}d' for k in lags)}
  from keyed k
{joins})"""


def points(spark: SparkSession, sf_dir: str, lags: tuple[int, ...] = LAGS, shift: int = SPRING) -> DataFrame:
    """A model per lag on the same series: the prices of the same clock hour that many days before."""
    models = F.array(*[F.struct(F.lit(f"naive_{k}d").alias("model"), F.col(f"p_lag{k}d").alias("point")) for k in lags])
    return lagged(spark, sf_dir, shift, lags).select("zone", "target_time", "target_date", "local_hour", "y", F.inline(models)).where("point is not null")


def forecasts(spark: SparkSession, sf_dir: str, lags: tuple[int, ...] = LAGS, shift: int = SPRING, split: str = SPLIT) -> DataFrame:
    """``model, zone, origin_date, target_time, target_date, local_hour, y, q05 .. q95`` after the split."""
    from tidemark.operators.forecast import residual_quantiles, with_quantiles

    rows = points(spark, sf_dir, lags, shift)
    offsets = residual_quantiles(rows.where(F.col("target_date") <= split), ["model", "zone", "local_hour"], QS)
    out = with_quantiles(rows.where(F.col("target_date") > split), offsets, ["model", "zone", "local_hour"], QS)
    return out.select("model", "zone", F.date_sub("target_date", 1).alias("origin_date"), "target_time", "target_date", "local_hour", "y", *QCOLS)


def forecasts_sql(lags: tuple[int, ...] = LAGS, shift: int = SPRING, split: str = SPLIT) -> str:
    offsets = ", ".join(f"quantile_cont(y - point, {q}) as o{c[1:]}" for q, c in zip(QS, QCOLS))
    models = "\n  union all ".join(f"select 'naive_{k}d' as model, zone, target_time, target_date, local_hour, y, p_lag{k}d as point from lagged where p_lag{k}d is not null" for k in lags)
    return lagged_sql(shift, lags) + f""", points as (
  {models}),
offs as (select model, zone, local_hour, {offsets} from points where target_date <= date '{split}' group by all),
fc as (select model, zone, target_date - 1 as origin_date, target_time, target_date, local_hour, y, {', '.join(f'point + o{c[1:]} as {c}' for c in QCOLS)}
  from points join offs using (model, zone, local_hour) where target_date > date '{split}')"""


def pulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlapping pulls of the same keys: ``part, pulled_at, snapshot, seq, quantity, price, discount, tax, valid``."""
    return read(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("part"),
        F.col("l_shipdate").cast("timestamp").alias("pulled_at"),
        F.date_format(F.col("l_shipdate").cast("timestamp"), "yyyyMMdd").alias("snapshot"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("seq"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_discount").alias("discount"),
        F.col("l_tax").alias("tax"),
        (F.col("l_returnflag") != "R").alias("valid"),
    )


PULLS_SQL = """pulls as (select l_partkey as part, l_shipdate as pulled_at, strftime(l_shipdate, '%Y%m%d') as snapshot, l_orderkey * 8 + l_linenumber as seq,
  l_quantity as quantity, l_extendedprice as price, l_discount as discount, l_tax as tax, l_returnflag <> 'R' as valid from lineitem)"""


def zoned_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``zone, day, value``: long daily series, mean order value by the customer's region."""
    nations = read(spark, sf_dir, "nation").join(read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", F.col("r_name").alias("zone"))
    customers = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    orders = read(spark, sf_dir, "orders").select("o_custkey", F.to_date("o_orderdate").alias("day"), "o_totalprice")
    rows = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    return rows.groupBy("zone", "day").agg(F.avg("o_totalprice").alias("value"), F.count(F.lit(1)).alias("n"))


ZONED_SQL = """zoned as (select r_name as zone, cast(o_orderdate as date) as day, avg(o_totalprice) as value, count(*) as n
  from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey group by 1, 2)"""


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide readings of many locations: ``zone, location, day, temperature, wind, cloud``; some values are missing."""
    line = read(spark, sf_dir, "lineitem").join(read(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    rows = line.select(F.col("s_nationkey").alias("zone"), F.col("l_suppkey").alias("location"), F.to_date("l_shipdate").alias("day"), "l_quantity", "l_tax", "l_discount")
    # Nearly every row is a group of its own: grouped before the shuffle they would fill a task's memory and be no fewer. A given number isn't coalesced.
    dealt = rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "zone", "location", "day")
    return dealt.groupBy("zone", "location", "day").agg(F.avg("l_quantity").alias("temperature"), F.max(F.when(F.col("l_tax") > 0.02, F.col("l_tax"))).alias("wind"), F.min("l_discount").alias("cloud"))


READINGS_SQL = """readings as (select s_nationkey as zone, l_suppkey as location, cast(l_shipdate as date) as day, avg(l_quantity) as temperature,
  max(case when l_tax > 0.02 then l_tax end) as wind, min(l_discount) as cloud from lineitem join supplier on l_suppkey = s_suppkey group by 1, 2, 3)"""
