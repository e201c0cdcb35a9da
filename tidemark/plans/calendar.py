"""Calendar, time and name queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import timeutils as t
from tidemark.operators.hourly import incomplete_hours, to_hourly
from tidemark.plans.feeds import AUTUMN, SPRING, ev_sql, hourly, hourly_sql, keyed, keyed_sql, lagged_sql, loc, ntz, r6, read, series
from tidemark.plans.registry import query


def local_days(spark, sf_dir, shift=SPRING):
    return series(spark, sf_dir, shift).select(t.local_date("timestamp").alias("day")).distinct()


def days_sql(shift: int = SPRING) -> str:
    return ev_sql(shift) + f", days as (select distinct cast({loc('timestamp')} as date) as day from ev)"


#: UTC instant of local midnight: unambiguous, so DuckDB's inverse conversion is safe here.
def midnight(day: str) -> str:
    return f"timezone('UTC', timezone('Europe/Stockholm', cast({day} as timestamp)))"


@query("local_day_bounds", f"with {days_sql()} select day, {midnight('day')} as day_start, {midnight('day + 1')} as day_end from days")
def local_day_bounds(spark, sf_dir):
    return t.local_day_bounds(local_days(spark, sf_dir)).select("day", ntz("day_start").alias("day_start"), ntz("day_end").alias("day_end"))


@query(
    "expected_periods",
    f"with {days_sql(AUTUMN)}, h as (select day, cast((epoch({midnight('day + 1')}) - epoch({midnight('day')})) / 3600 as integer) as n from days) select day, n as n_pt60m, n * 4 as n_pt15m from h",
)
def expected_periods(spark, sf_dir):
    return t.expected_periods(local_days(spark, sf_dir, AUTUMN))


@query(
    "infer_resolution",
    f"""with {ev_sql()}, s as (select distinct zone, case when timestamp < timestamp '2024-04-01' then date_trunc('hour', timestamp) else time_bucket(interval 15 minute, timestamp) end as timestamp from ev),
    d as (select *, lead(timestamp) over w - timestamp as ahead, timestamp - lag(timestamp) over w as back from s window w as (partition by zone order by timestamp))
    select zone, timestamp, case when ahead = interval 15 minute then 'PT15M' when ahead = interval 60 minute then 'PT60M' when back = interval 15 minute then 'PT15M' when back = interval 60 minute then 'PT60M' end as resolution from d""",
)
def infer_resolution(spark, sf_dir):
    """A series that goes from hours to quarter hours, with gaps."""
    step = F.when(F.col("timestamp") < F.lit("2024-04-01").cast("timestamp"), 3600).otherwise(900)
    rows = series(spark, sf_dir).select("zone", F.timestamp_seconds(F.floor(F.unix_timestamp("timestamp") / step) * step).alias("timestamp")).distinct()
    return t.infer_resolution(t.ensure_utc(rows, "timestamp"), ["zone"]).select("zone", ntz("timestamp").alias("timestamp"), "resolution")


TARGETS_SQL = days_sql() + f""", targets as (
  select day as origin_date, {midnight('day')} + interval 9 hour as origin_naive, day + 1 as target_date, unnest(generate_series({midnight('day + 1')}, {midnight('day + 2')} - interval 1 hour, interval 1 hour)) as target_time from days)"""


@query("target_hours", f"with {TARGETS_SQL} select origin_date, target_date, target_time from targets")
def target_hours(spark, sf_dir):
    return t.target_hours(local_days(spark, sf_dir).withColumnRenamed("day", "origin_date")).select("origin_date", "target_date", ntz("target_time").alias("target_time"))


@query(
    "same_local_hour_lag",
    f"with {keyed_sql()} select k.zone, k.timestamp, round(k.price, 6) as price, round(l.price, 6) as lag_price from keyed k left join keyed l on l.zone = k.zone and l.local_date = k.local_date - 1 and l.local_hour = k.local_hour and l.occurrence = 1",
)
def same_local_hour_lag(spark, sf_dir):
    from tidemark.operators.features import same_local_hour

    rows = keyed(spark, sf_dir)
    return same_local_hour(rows, rows, 1, "lag_price").select("zone", ntz("timestamp").alias("timestamp"), r6("price").alias("price"), r6("lag_price").alias("lag_price"))


@query("fixed_lead_run", f"with {hourly_sql()} select zone, timestamp, to_timestamp(floor((epoch(timestamp) - 48 * 3600) / 21600) * 21600)::timestamp as run_init from hourly")
def fixed_lead_run(spark, sf_dir):
    return hourly(spark, sf_dir).select("zone", ntz("timestamp").alias("timestamp"), ntz(t.lead_run(F.col("timestamp"), 48)).alias("run_init"))


@query("hour_occurrence", f"with {keyed_sql(AUTUMN)} select zone, timestamp, local_date, cast(local_hour as integer) as local_hour, cast(occurrence as integer) as occurrence from keyed")
def hour_occurrence(spark, sf_dir):
    return keyed(spark, sf_dir, AUTUMN).select("zone", ntz("timestamp").alias("timestamp"), "local_date", "local_hour", "occurrence")


@query(
    "cyclic_features",
    f"""with {hourly_sql()}, l as (select zone, timestamp, {loc('timestamp')} as lt, price from hourly)
    select zone, timestamp, round(sin(hour(lt) * (2 * pi() / 24)), 6) as hour_sin, round(cos(hour(lt) * (2 * pi() / 24)), 6) as hour_cos,
    round(sin(dayofyear(lt) * (2 * pi() / 365.25)), 6) as doy_sin, round(cos(dayofyear(lt) * (2 * pi() / 365.25)), 6) as doy_cos,
    round(sin(radians(price)), 6) as dir_sin, round(cos(radians(price)), 6) as dir_cos from l""",
)
def cyclic_features(spark, sf_dir):
    at = t.local("timestamp")
    (hs, hc), (ds, dc) = t.cyclic(F.hour(at), 24), t.cyclic(F.dayofyear(at), 365.25)
    return hourly(spark, sf_dir).select(
        "zone", ntz("timestamp").alias("timestamp"), r6(hs).alias("hour_sin"), r6(hc).alias("hour_cos"), r6(ds).alias("doy_sin"), r6(dc).alias("doy_cos"),
        r6(F.sin(F.radians("price"))).alias("dir_sin"), r6(F.cos(F.radians("price"))).alias("dir_cos"),
    )


@query(
    "calendar_features",
    f"""with {days_sql()}, t as (select day as origin_date, timezone('UTC', timezone('Europe/Stockholm', cast(day as timestamp) + interval 9 hour)) as origin,
      unnest(generate_series({midnight('day + 1')}, {midnight('day + 2')} - interval 1 hour, interval 1 hour)) as target_time from days),
    l as (select *, {loc('target_time')} as lt from t)
    select origin_date, target_time, cast(hour(lt) as integer) as cal_hour, cast(isodow(lt) - 1 as integer) as cal_dow, cast(isodow(lt) >= 6 as integer) as cal_weekend,
      cast(month(lt) as integer) as cal_month, cast((epoch({midnight('cast(lt as date) + 1')}) - epoch({midnight('cast(lt as date)')})) / 3600 as integer) as cal_hours_in_day,
      cast(epoch(lt) - epoch(target_time) <> 3600 as integer) as cal_dst, cast((epoch(target_time) - epoch(origin)) / 3600 as integer) as lead_hours from l""",
)
def calendar_features(spark, sf_dir):
    origins = local_days(spark, sf_dir).withColumnRenamed("day", "origin_date").withColumn("origin", t.origin_timestamp(F.col("origin_date")))
    out = t.calendar_features(t.target_hours(origins))
    return out.select("origin_date", ntz("target_time").alias("target_time"), *[c for c in out.columns if c.startswith("cal_")], "lead_hours")


# The Gregorian computus in its usual anonymous form, for the years around the orders.
HOLIDAY_DAYS_SQL = """y as (select unnest(generate_series(year(lo) - 1, year(hi) + 1)) as y from od),
a as (select y, y % 19 as a, y // 100 as b, y % 100 as c from y),
b as (select *, b // 4 as d, b % 4 as e, (b + 8) // 25 as f, c // 4 as i, c % 4 as k from a),
c as (select *, (19 * a + b - d - (b - f + 1) // 3 + 15) % 30 as h from b),
d as (select *, (32 + 2 * e + 2 * i - h - k) % 7 as l from c),
e as (select *, (a + 11 * h + 22 * l) // 451 as m from d),
easter as (select make_date(y, (h + l - 7 * m + 114) // 31, (h + l - 7 * m + 114) % 31 + 1) as e from e),
days as (select cast(unnest(generate_series(lo - interval 60 day, hi + interval 60 day, interval 1 day)) as date) as day from od),
f as (select day, isodow(day) as w, month(day) * 100 + day(day) as md, month(day + 1) * 100 + day(day + 1) as md1 from days),
p as (select day, w, md in (101, 106, 501, 606, 1225, 1226) or (w = 6 and (md between 620 and 626 or md between 1031 and 1106))
    or exists (select 1 from easter where day - e in (-2, 0, 1, 39, 49)) as is_public,
    md in (1224, 1231) or (w = 5 and md1 between 620 and 626) as is_custom, md = 430 as is_half from f),
h as (select *, is_public or is_custom as hol, is_public or is_custom or w >= 6 as is_off from p),
n as (select *, lag(hol) over o as lh, lead(hol) over o as nh, lag(is_off) over o as lo, lead(is_off) over o as no,
    max(case when hol then day end) over (order by day rows between unbounded preceding and 1 preceding) as prev,
    min(case when hol then day end) over (order by day rows between 1 following and unbounded following) as next from h window o as (order by day))
select day, is_public, is_custom, is_half, hol as is_holiday, not is_off and ((lh and no) or (lo and nh)) as is_bridge,
    cast(least(day - prev, 14) as integer) as days_since, cast(least(next - day, 14) as integer) as days_to from n"""
HOLIDAY_SQL = f"with od as (select min(cast(o_orderdate as date)) as lo, max(cast(o_orderdate as date)) as hi from orders), {HOLIDAY_DAYS_SQL} where day in (select cast(o_orderdate as date) from orders)"


@query("holiday_calendar", HOLIDAY_SQL)
def holiday_calendar(spark, sf_dir):
    days = read(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("day")).distinct()
    first, last = days.agg(F.min("day"), F.max("day")).first()
    if first is None:
        first = last = "2000-01-01"
    calendar = t.holiday_calendar(spark, str(first), str(last))  # one row per day of the span
    return days.join(F.broadcast(calendar), "day").select("day", "is_public", "is_custom", "is_half", "is_holiday", "is_bridge", "days_since", "days_to")


@query(
    "normalise_names",
    """select p_partkey, trim(regexp_replace(lower(p_name || ' / ' || p_type), '[^a-z0-9]+', '_', 'g'), '_') as snake,
    regexp_replace('SE' || (p_partkey % 9), '^([A-Z]{2})([0-9])$', '\\1_\\2') as code, replace(replace(p_brand || '@size=' || p_size, '@', '__'), '=', '-') as metric from part""",
)
def normalise_names(spark, sf_dir):
    part = read(spark, sf_dir, "part")
    return part.select(
        "p_partkey",
        t.snake_case(F.concat("p_name", F.lit(" / "), "p_type")).alias("snake"),
        t.area_code(F.concat(F.lit("SE"), (F.col("p_partkey") % 9).cast("string"))).alias("code"),
        t.metric_name(F.concat("p_brand", F.lit("@size="), F.col("p_size").cast("string"))).alias("metric"),
    )


@query(
    "hourly_aggregate",
    f"""with {ev_sql()}, r as (select *, case when event_id % 3 = 0 then 'PT15M' else 'PT60M' end as res from ev)
    select zone, date_trunc('hour', timestamp) as timestamp, round(avg(price), 6) as price, count(*) as n_periods,
    case when count(distinct res) = 1 then min(res) else 'mixed' end as source_resolution from r group by 1, 2""",
)
def hourly_aggregate(spark, sf_dir):
    rows = series(spark, sf_dir).withColumn("res", F.when(F.col("event_id") % 3 == 0, "PT15M").otherwise("PT60M"))
    return to_hourly(rows, "price", resolution="res").select("zone", ntz("timestamp").alias("timestamp"), r6("price").alias("price"), "n_periods", "source_resolution")


@query("incomplete_hours", f"with {hourly_sql()} select zone, timestamp, n_periods from hourly where n_periods <> 4")
def incomplete(spark, sf_dir):
    return incomplete_hours(hourly(spark, sf_dir), 4).select("zone", ntz("timestamp").alias("timestamp"), "n_periods")


@query(
    "parse_json_props",
    """select event_id, event_type as zone, ts as timestamp, cast(json_extract(props, '$.k') as integer) as k, round(cast(json_extract(props, '$.k') as double) / 1000 * 1000, 2) as price_eur_mwh from events""",
)
def parse_json_props(spark, sf_dir):
    from tidemark.sources.readers import parse_props

    return parse_props(read(spark, sf_dir, "events")).select("event_id", F.col("event_type").alias("zone"), ntz("ts").alias("timestamp"), "k", F.round(F.col("k") / 1000 * 1000, 2).alias("price_eur_mwh"))


@query(
    "explode_parallel_arrays",
    f"with {hourly_sql()} select zone, timestamp, round(price, 6) as price, n_periods from hourly where price is not null",
)
def explode_parallel_arrays(spark, sf_dir):
    from tidemark.sources.readers import explode_arrays

    rows = hourly(spark, sf_dir)
    packed = rows.groupBy("zone", F.to_date("timestamp").alias("day")).agg(F.sort_array(F.collect_list(F.struct(F.unix_timestamp("timestamp").alias("time"), "price", "n_periods"))).alias("x"))
    arrays = packed.select("zone", F.struct(*[F.col(f"x.{c}").alias(c) for c in ("time", "price", "n_periods")]).alias("hourly"))
    out = explode_arrays(arrays, "hourly", ["price", "n_periods"], keys=["zone"])
    return out.select("zone", ntz("timestamp").alias("timestamp"), r6("price").alias("price"), F.col("n_periods").cast("long").alias("n_periods"))
