"""Feature and dataset queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.timeutils import local_date, origin_timestamp
from tidemark.operators import features as op
from tidemark.plans.calendar import HOLIDAY_DAYS_SQL
from tidemark.plans.feeds import AUTUMN, ev_sql, hourly, hourly_sql, keyed, keyed_sql, lagged, lagged_sql, loc, ntz, r6, series
from tidemark.plans.registry import query


def at_local(day: str, hour: int) -> str:
    return f"timezone('UTC', timezone('Europe/Stockholm', cast({day} as timestamp) + interval {hour} hour))"


@query("price_availability", f"with {hourly_sql()} select zone, timestamp, {at_local(f'cast({loc('timestamp')} as date) - 1', 13)} as available_at from hourly")
def price_availability(spark, sf_dir):
    return hourly(spark, sf_dir).select("zone", ntz("timestamp").alias("timestamp"), ntz(op.auction_availability()).alias("available_at"))


@query("fixed_lead_availability", f"with {hourly_sql()} select zone, timestamp, timestamp - interval 42 hour as available_at from hourly")
def fixed_lead_availability(spark, sf_dir):
    return hourly(spark, sf_dir).select("zone", ntz("timestamp").alias("timestamp"), ntz(op.fixed_lead_availability("timestamp", 48, 6)).alias("available_at"))


@query(
    "as_of_view",
    f"""with {hourly_sql()}, a as (select *, {at_local(f'cast({loc('timestamp')} as date) - 1', 13)} as available_at from hourly),
    o as (select distinct zone, {at_local(f'cast({loc('timestamp')} as date)', 9)} as origin from hourly)
    select o.zone, o.origin, count(*) as n_rows, max(a.timestamp) as last_time, round(avg(price), 6) as mean_price from o join a on a.zone = o.zone and a.available_at <= o.origin group by 1, 2""",
)
def as_of_view(spark, sf_dir):
    rows = hourly(spark, sf_dir).withColumn("available_at", op.auction_availability())
    origins = rows.select("zone", origin_timestamp(local_date("timestamp")).alias("origin")).distinct()
    seen = op.as_of_totals(rows, origins).where("n_rows > 0")
    return seen.select("zone", ntz("origin").alias("origin"), "n_rows", ntz("last_time").alias("last_time"), r6(F.col("total") / F.col("n_values")).alias("mean_price"))


@query("price_lags", f"with {lagged_sql()} select zone, target_time, round(y, 6) as y, round(p_lag1d, 6) as p_lag1d, round(p_lag7d, 6) as p_lag7d from lagged")
def price_lags(spark, sf_dir):
    return lagged(spark, sf_dir).select("zone", ntz("target_time").alias("target_time"), r6("y").alias("y"), r6("p_lag1d").alias("p_lag1d"), r6("p_lag7d").alias("p_lag7d"))


def samehour_sql(targets: str = "keyed") -> str:
    return f"""sh as (select k.zone, k.local_date, k.local_hour, avg(l.price) as m from (select distinct zone, local_date, local_hour from {targets}) k
  left join keyed l on l.zone = k.zone and l.local_hour = k.local_hour and l.occurrence = 1 and l.local_date between k.local_date - 7 and k.local_date - 1 group by 1, 2, 3)"""


@query("samehour_mean", f"with {keyed_sql()}, {samehour_sql()} select k.zone, k.timestamp, round(sh.m, 6) as samehour_mean7d from keyed k left join sh using (zone, local_date, local_hour)")
def samehour_mean(spark, sf_dir):
    rows = keyed(spark, sf_dir)
    return op.samehour_mean(rows, rows, 7).select("zone", ntz("timestamp").alias("timestamp"), r6("samehour_mean7d").alias("samehour_mean7d"))


DAYS_SQL = """ds as (select zone, local_date as day, avg(price) as day_mean, count(*) filter (where price < 0) as neg_hours from keyed group by 1, 2),
dst as (select a.*, a.day_mean - b.day_mean as trend from ds a left join ds b on b.zone = a.zone and b.day = a.day - 1)"""


@query("day_stats", f"with {keyed_sql()}, {DAYS_SQL} select zone, day, round(day_mean, 6) as day_mean, neg_hours, round(trend, 6) as trend from dst")
def day_stats(spark, sf_dir):
    return op.day_stats(hourly(spark, sf_dir)).select("zone", "day", r6("day_mean").alias("day_mean"), "neg_hours", r6("trend").alias("trend"))


def rolls_sql(hours: int, days: str = "select distinct zone, local_date as day from keyed") -> str:
    """The hours up to the last price by the end of each day, whenever that was."""
    return f"""last{hours} as (select d.zone, d.day, max(k.timestamp) as t from ({days}) d join keyed k on k.zone = d.zone and k.local_date <= d.day and k.price is not null group by 1, 2),
roll{hours} as (select e.zone, e.day, avg(k.price) as mean, min(k.price) as min, max(k.price) as max, stddev_samp(k.price) as std from last{hours} e
  join keyed k on k.zone = e.zone and k.timestamp <= e.t and k.timestamp > e.t - interval {hours} hour group by 1, 2)"""


#: Days whose prices the statistics queries take away in two of the zones: a single one, and more than the window is long.
UNPRICED = (("click", "2024-03-27", "2024-03-27"), ("view", "2024-03-22", "2024-04-01"))
UNPRICED_SQL = "(" + " or ".join(f"(zone = '{z}' and local_date between date '{a}' and date '{b}')" for z, a, b in UNPRICED) + ")"


@query("rolling_stats", f"with {keyed_sql().replace('keyed as', 'whole as')}, keyed as (select * replace (case when not {UNPRICED_SQL} then price end as price) from whole), {rolls_sql(24)}, {rolls_sql(168)} select a.zone, a.day, {', '.join(f'round({t}.{n}, 6) as p_roll{h}h_{n}' for t, h in (('a', 24), ('b', 168)) for n in ('mean', 'min', 'max', 'std'))} from roll24 a join roll168 b using (zone, day)")
def rolling_stats(spark, sf_dir):
    gaps = [(F.col("zone") == z) & local_date("timestamp").between(F.lit(a).cast("date"), F.lit(b).cast("date")) for z, a, b in UNPRICED]
    rows = hourly(spark, sf_dir).withColumn("price", F.when(~(gaps[0] | gaps[1]), F.col("price")))
    both = op.rolling_stats(rows, 24).join(op.rolling_stats(rows, 168), ["zone", "day"])
    return both.select("zone", "day", *[r6(c).alias(c) for c in both.columns[2:]])


NEIGHBOURS = (("click", "view"), ("click", "error"), ("view", "purchase"), ("signup", "click"))


@query(
    "neighbour_spread",
    f"""with {lagged_sql()}, {DAYS_SQL}, n(zone, neighbour) as (values {', '.join(map(str, NEIGHBOURS))})
    select l.zone, n.neighbour, l.target_time, round(o.p_lag1d, 6) as nb_lag1d, round(ds.day_mean, 6) as "nb_dayD_mean", round(l.p_lag1d - o.p_lag1d, 6) as nb_spread from lagged l join n using (zone)
      left join lagged o on o.zone = n.neighbour and o.target_time = l.target_time left join ds on ds.zone = n.neighbour and ds.day = l.target_date - 1""",
)
def neighbour_spread(spark, sf_dir):
    pairs = spark.createDataFrame(NEIGHBOURS, "zone string, neighbour string")
    out = op.neighbour_spread(lagged(spark, sf_dir), pairs, hourly(spark, sf_dir))
    return out.select("zone", "neighbour", ntz("target_time").alias("target_time"), *[r6(c).alias(c) for c in ("nb_lag1d", "nb_dayD_mean", "nb_spread")])


def dataset_sql(more: str = "", targets: str = "(select * from keyed where price is not null)") -> str:
    lags = "\n".join(f"left join keyed l{k} on l{k}.zone = k.zone and l{k}.local_date = k.local_date - {k} and l{k}.local_hour = k.local_hour and l{k}.occurrence = 1" for k in (1, 2, 7, 8))
    days = f"select distinct zone, local_date - 1 as day from {targets}"
    return f"""{keyed_sql()}, {more} {samehour_sql(targets)}, {DAYS_SQL}, {rolls_sql(24, days)}, {rolls_sql(168, days)},
    dataset as (select k.zone, {at_local('k.local_date - 1', 9)} as origin, k.local_date - 1 as origin_date, k.timestamp as target_time, k.local_date as target_date, k.price as y,
      cast(k.local_hour as integer) as cal_hour, cast(isodow(k.local_date) - 1 as integer) as cal_dow, cast(isodow(k.local_date) >= 6 as integer) as cal_weekend, cast(month(k.local_date) as integer) as cal_month,
      cast((epoch({at_local('k.local_date + 1', 0)}) - epoch({at_local('k.local_date', 0)})) / 3600 as integer) as cal_hours_in_day,
      cast(epoch({loc('k.timestamp')}) - epoch(k.timestamp) <> 3600 as integer) as cal_dst, cast((epoch(k.timestamp) - epoch({at_local('k.local_date - 1', 9)})) / 3600 as integer) as lead_hours,
      l1.price as p_lag1d, l2.price as p_lag2d, l7.price as p_lag7d, l8.price as p_lag8d, sh.m as p_samehour_mean7d, dst.day_mean as "p_dayD_mean", dst.trend as "p_dayD_trend", dst.neg_hours as "p_dayD_neg_hours",
      {', '.join(f'r{h}.{n} as p_roll{h}h_{n}' for h in (24, 168) for n in ('mean', 'min', 'max', 'std'))}
    from {targets} k {lags} left join sh on sh.zone = k.zone and sh.local_date = k.local_date and sh.local_hour = k.local_hour
    left join dst on dst.zone = k.zone and dst.day = k.local_date - 1 left join roll24 r24 on r24.zone = k.zone and r24.day = k.local_date - 1 left join roll168 r168 on r168.zone = k.zone and r168.day = k.local_date - 1)"""


ROLLS = (24, 168)
MEASURES = ("y", "p_lag1d", "p_lag2d", "p_lag7d", "p_lag8d", "p_samehour_mean7d", "p_dayD_mean", "p_dayD_trend", *(f"p_roll{h}h_{n}" for h in ROLLS for n in ("mean", "min", "max", "std")))
CALENDAR = ("cal_hour", "cal_dow", "cal_weekend", "cal_month", "cal_hours_in_day", "cal_dst", "lead_hours")
PLAIN = ("zone", "origin_date", "target_date", *CALENDAR, "p_dayD_neg_hours")
TIMES = ("origin", "target_time")


def rounded(df):
    return df.select(*PLAIN, *[ntz(c).alias(c) for c in TIMES], *[r6(c).alias(c) for c in MEASURES])


ROUNDED_SQL = ", ".join([*(f'"{c}"' for c in (*PLAIN, *TIMES)), *(f'round("{c}", 6) as "{c}"' for c in MEASURES)])


@query("origin_dataset", f"with {dataset_sql()} select {ROUNDED_SQL} from dataset")
def origin_dataset(spark, sf_dir):
    return rounded(op.origin_dataset(keyed(spark, sf_dir), rolls=ROLLS))


# Readings at two places of a zone, from its prices: the south has none in hours of a single period.
LOCATIONS, SCALARS, DIRECTIONS = ("north", "south"), ("temperature", "wind"), ("wind_direction",)
WEATHER_SQL = """weather as (select zone, 'north' as location, timestamp, price / 10 as temperature, cast(n_periods as double) as wind, price * 7 as wind_direction from hourly
  union all select zone, 'south', timestamp, price / 9 - 1, case when n_periods > 2 then n_periods * 2.0 end, price * 3 from hourly where n_periods > 1)"""
CYCLIC = {"cal_hour_sin": "sin(2 * pi() * cal_hour / 24)", "cal_hour_cos": "cos(2 * pi() * cal_hour / 24)", "cal_doy_sin": "sin(2 * pi() * dayofyear(target_date) / 365.25)", "cal_doy_cos": "cos(2 * pi() * dayofyear(target_date) / 365.25)"}
HOLIDAYS = {"cal_is_public_holiday": "is_public", "cal_is_de_facto_holiday": "is_custom", "cal_is_half_day": "is_half", "cal_is_bridge_day": "is_bridge", "cal_days_to_holiday": "days_to", "cal_days_since_holiday": "days_since"}


def weather(spark, sf_dir):
    rows = hourly(spark, sf_dir)
    north = rows.select("zone", F.lit("north").alias("location"), "timestamp", (F.col("price") / 10).alias("temperature"), F.col("n_periods").cast("double").alias("wind"), (F.col("price") * 7).alias("wind_direction"))
    south = rows.where("n_periods > 1").select("zone", F.lit("south"), "timestamp", F.col("price") / 9 - 1, F.when(F.col("n_periods") > 2, F.col("n_periods") * 2.0), F.col("price") * 3)
    return north.union(south)


def _groups():
    """Every column of the groups with the SQL that gives it, from ``dataset d``, the joins below and the hours ``x`` of the weather."""
    own = {f"w_{loc}_{v}": f"max(case when location = '{loc}' then {v} end)" for loc in LOCATIONS for v in SCALARS}
    own |= {f"w_{loc}_{v}_{f}": f"max(case when location = '{loc}' then {f}(radians({v})) end)" for loc in LOCATIONS for v in DIRECTIONS for f in ("sin", "cos")}
    over = {f"wz_{v}_{n}": f"{f}({v})" for v in SCALARS for n, f in (("mean", "avg"), ("min", "min"), ("max", "max"))}
    hours = f"x as (select zone, timestamp, {', '.join(f'{e} as {c}' for c, e in (own | over).items())} from weather group by 1, 2), xd as (select zone, cast({loc('timestamp')} as date) as day, avg(wz_temperature_mean) as m from x group by 1, 2)"
    names = sorted({n for _, n in NEIGHBOURS})
    joins = "left join x on x.zone = d.zone and x.timestamp = d.target_time left join x b on b.zone = d.zone and b.timestamp = d.target_time - interval 24 hour left join xd on xd.zone = d.zone and xd.day = d.target_date left join holi on holi.day = d.target_date"
    columns = {c: f"{e}" for c, e in CYCLIC.items()} | {c: f"cast(holi.{h} as integer)" for c, h in HOLIDAYS.items()}
    for n in names:
        joins += f" left join n as n_{n} on n_{n}.zone = d.zone and n_{n}.neighbour = '{n}' left join keyed k_{n} on k_{n}.zone = n_{n}.neighbour and k_{n}.local_date = d.origin_date and k_{n}.local_hour = d.cal_hour and k_{n}.occurrence = 1 left join ds d_{n} on d_{n}.zone = n_{n}.neighbour and d_{n}.day = d.origin_date"
        columns |= {f"nb_{n}_lag1d": f"k_{n}.price", f"nb_{n}_dayD_mean": f"d_{n}.day_mean", f"nb_{n}_spread_lag1d": f"d.p_lag1d - k_{n}.price"}
    missing = " + ".join(f"(x.{c} is null)::integer" for c in own)
    columns |= {c: f"x.{c}" for c in own | over} | {"wz_temperature_d24": "x.wz_temperature_mean - b.wz_temperature_mean", "wz_temperature_daymean": "xd.m", "weather_missing_frac": f"({missing}) / {len(own)}.0"}
    return hours, joins, columns


GROUP_HOURS, GROUP_JOINS, GROUP_COLUMNS = _groups()
COUNTED = tuple(HOLIDAYS)
#: The last hours of the zones' prices that the groups' query takes away, so that rows are dropped.
CUT = "2024-04-10"


def dataset_groups(spark, sf_dir, rows):
    from tidemark.functions.timeutils import holiday_calendar

    days = rows.agg(F.min("local_date"), F.date_add(F.max("local_date"), 1)).first()  # the calendar is one row per day of the span
    holidays = holiday_calendar(spark, *[str(d or "2024-01-01") for d in days])
    return (op.calendar_group(holidays), op.neighbour_group(rows, NEIGHBOURS), op.weather_group(weather(spark, sf_dir), list(LOCATIONS), list(SCALARS), list(DIRECTIONS), "temperature"))


@query(
    "dataset_features",
    f"""with {dataset_sql()}, {WEATHER_SQL}, {GROUP_HOURS}, n(zone, neighbour) as (values {', '.join(map(str, NEIGHBOURS))}),
    holi as (with od as (select min(local_date) as lo, max(local_date) as hi from keyed), {HOLIDAY_DAYS_SQL})
    select d.zone, d.target_time, {', '.join(f'{e} as "{c}"' if c in COUNTED else f'round({e}, 6) as "{c}"' for c, e in GROUP_COLUMNS.items())} from dataset d {GROUP_JOINS}""",
)
def dataset_features(spark, sf_dir):
    """Calendar, neighbour and weather groups of the dataset's rows."""
    rows = keyed(spark, sf_dir)
    out = op.origin_dataset(rows, dataset_groups(spark, sf_dir, rows), rolls=ROLLS)
    return out.select("zone", ntz("target_time").alias("target_time"), *[F.col(c) if c in COUNTED else r6(c).alias(c) for c in GROUP_COLUMNS])


@query(
    "dropped_targets",
    f"""with {keyed_sql()}, o as (select distinct zone, local_date as origin_date from keyed),
    h as (select zone, origin_date, unnest(generate_series({at_local('origin_date + 1', 0)}, {at_local('origin_date + 2', 0)} - interval 1 hour, interval 1 hour)) as timestamp from o)
    select zone, origin_date, count(*) as n_dropped from h where not exists (select 1 from keyed k where k.zone = h.zone and k.timestamp = h.timestamp and k.price is not null) group by 1, 2""",
)
def dropped_targets(spark, sf_dir):
    rows = keyed(spark, sf_dir)
    return op.dropped_targets(rows, rows.select("zone", F.col("local_date").alias("origin_date")).distinct())


@query(
    "stored_live_rows",
    f"""with {dataset_sql()} select zone, target_time, round(p_lag1d, 6) as p_lag1d, round("p_dayD_mean", 6) as "p_dayD_mean", round("p_roll24h_mean", 6) as "p_roll24h_mean" from dataset where origin_date = date '{CUT}'""",
)
def stored_live_rows(spark, sf_dir):
    """Rows of one origin, checked against the dataset of the origins before it and committed; a second run replaces the first."""
    from tidemark.sources.versions import VersionedTable
    from tidemark.sources.scratch import scratch

    rows, root = keyed(spark, sf_dir), scratch(spark, "live")
    reference = op.origin_dataset(rows.where(F.col("local_date") <= CUT))
    live = op.live_rows(rows, rows.select("zone", F.lit(CUT).cast("date").alias("origin_date")).distinct()).where("y is not null")
    for _ in range(2):
        stored = op.store_live_rows(live, reference, root)
    found = VersionedTable(spark, root).read(stored)
    return found.select("zone", ntz("target_time").alias("target_time"), *[r6(c).alias(c) for c in ("p_lag1d", "p_dayD_mean", "p_roll24h_mean")])


# The origin of a day in the past, and that of each zone's last day: its target hours have no prices yet.
LIVE_SQL = f"""lo as (select distinct zone, date '2024-04-10' as origin_date from keyed union select zone, max(local_date) from keyed group by 1),
lh as (select zone, unnest(generate_series({at_local('origin_date + 1', 0)}, {at_local('origin_date + 2', 0)} - interval 1 hour, interval 1 hour)) as timestamp from lo),
lk as (select zone, timestamp, cast({loc('timestamp')} as date) as local_date, hour({loc('timestamp')}) as local_hour from lh),
live as (select lk.*, h.price from lk left join hourly h using (zone, timestamp)),"""


@query("live_rows", f"with {dataset_sql(LIVE_SQL, 'live')} select {ROUNDED_SQL} from dataset")
def live_rows(spark, sf_dir):
    rows = keyed(spark, sf_dir)
    origins = rows.select("zone", F.lit("2024-04-10").cast("date").alias("origin_date")).union(rows.groupBy("zone").agg(F.max("local_date"))).distinct()
    return rounded(op.live_rows(rows, origins, rolls=ROLLS))


AUDIT_ORIGIN = "2024-03-29 08:00:00"  # 09:00 local time; the target day after it isn't a day of 23 hours
NOISE_SQL = """pb as (select zone, timestamp, price, u, available_at > timestamp '{o}' as unknown from (
  select *, ((((({s} * 48271 + (epoch(timestamp)::bigint % 2147483647) + 11) % 2147483647) * 48271) % 2147483647) / 2147483647.0)::double as u, {av} as available_at from hourly))"""


@query(
    "perturb_unavailable",
    f"""with {hourly_sql()}, {NOISE_SQL.format(o=AUDIT_ORIGIN, s=7, av=at_local(f'cast({loc('timestamp')} as date) - 1', 13))}
    select zone, timestamp, round(case when unknown then case when u < 0.1 then null else u * 1000 end else price end, 6) as price from pb""",
)
def perturb_unavailable(spark, sf_dir):
    rows = hourly(spark, sf_dir).withColumn("available_at", op.auction_availability())
    return op.perturb_unavailable(rows, F.lit(AUDIT_ORIGIN).cast("timestamp"), 7).select("zone", ntz("timestamp").alias("timestamp"), r6("price").alias("price"))


AUDIT_SQL = f"""ad as (select distinct cast({loc('timestamp')} as date) as day from hourly),
    ah as (select day, ((datediff('day', date '1970-01-01', day) * 48271 + 5 * 1000003) % 2147483647) * 48271 % 2147483647 as u, min(day) over () as a, max(day) over () as b,
      cast((epoch({at_local('day + 2', 0)}) - epoch({at_local('day + 1', 0)})) / 3600 as integer) as hours from ad),
    ar as (select *, row_number() over (order by u, day) as i from ah),
    au as (select day, day in (a, b) as is_end, hours <> 24 as is_clock_change from ar where day in (a, b) or hours <> 24 or i <= 5)"""


@query(
    "leakage_audit",
    f"""with {dataset_sql()}, {AUDIT_SQL}, n as (select count(*) as n_rows from dataset where origin_date in (select day from au)),
    c(c) as (values {', '.join(f"('{c}')" for c in (*CALENDAR, 'p_dayD_neg_hours', *MEASURES))})
    select c as "column", n_rows, case when c = 'y' then n_rows else 0 end as n_changed, false as leaks from c, n where n_rows > 0""",
)
def leakage_audit(spark, sf_dir):
    from tidemark.operators.backtest import audit_sample

    rows = keyed(spark, sf_dir)
    near = op.audit_copies(rows, audit_sample(rows.select(F.col("local_date").alias("day")).distinct(), 5, 5), ROLLS).withColumn("available_at", op.auction_availability())
    origin = origin_timestamp(F.col("audit_date"))
    # A target that the noise made null is kept as a changed one.
    noisy = op.perturb_unavailable(near, origin, 7).withColumn("price", F.when(F.col("available_at") > origin, F.coalesce("price", F.lit(-1.0))).otherwise(F.col("price")))
    build = lambda df: op.audited(op.origin_dataset(df.drop("available_at", "audit_date"), rolls=ROLLS))
    return op.leakage_audit(build(near), build(noisy))


@query("audit_origins", f"with {hourly_sql()}, {AUDIT_SQL} select day, is_end, is_clock_change from au")
def audit_origins(spark, sf_dir):
    from tidemark.operators.backtest import audit_sample

    return audit_sample(hourly(spark, sf_dir).select(local_date("timestamp").alias("day")).distinct(), 5, 5)


@query(
    "new_nulls",
    f"""with {keyed_sql()}, live as (select * from keyed where local_date = date '2024-04-10'), ref as (select * from keyed where local_date = date '2024-04-09')
    select r.zone, cast(r.local_hour as integer) as local_hour, cast(r.occurrence as integer) as occurrence, 'price' as "column" from ref r left join live l on l.zone = r.zone and l.local_hour = r.local_hour and l.occurrence = r.occurrence where r.price is not null and l.price is null""",
)
def new_nulls(spark, sf_dir):
    from tidemark.operators.backtest import new_nulls as found

    rows = keyed(spark, sf_dir)
    return found(rows.where(F.col("local_date") == "2024-04-10"), rows.where(F.col("local_date") == "2024-04-09"), ["zone", "local_hour", "occurrence"], ["price"])


@query(
    "gap_fill_linear",
    f"""with {hourly_sql()}, g as (select zone, unnest(generate_series(a, b, interval 1 hour)) as timestamp from (select zone, min(timestamp) as a, max(timestamp) as b from hourly group by 1)),
    j as (select g.zone, g.timestamp, h.price from g left join hourly h using (zone, timestamp)),
    w as (select *, last_value(price ignore nulls) over p as p0, last_value(case when price is not null then timestamp end ignore nulls) over p as t0,
      first_value(price ignore nulls) over n as p1, first_value(case when price is not null then timestamp end ignore nulls) over n as t1 from j
      window p as (partition by zone order by timestamp rows between unbounded preceding and current row), n as (partition by zone order by timestamp rows between current row and unbounded following))
    select zone, timestamp, round(coalesce(price, case when p0 is null then p1 when p1 is null then p0 else p0 + (p1 - p0) * (epoch(timestamp) - epoch(t0)) / (epoch(t1) - epoch(t0)) end), 6) as price, price is null as filled from w""",
)
def gap_fill_linear(spark, sf_dir):
    from tidemark.operators.backtest import gap_fill_linear as fill

    return fill(hourly(spark, sf_dir), "price", ["zone"]).select("zone", ntz("timestamp").alias("timestamp"), r6("price").alias("price"), "filled")


@query(
    "gap_fill_context",
    f"""with {ev_sql(AUTUMN)}, l as (select zone, date_trunc('hour', max(timestamp)) as b from ev group by 1),
    g as (select zone, unnest(generate_series(b - interval 239 hour, b, interval 1 hour)) as timestamp from l),
    o as (select zone, date_trunc('hour', timestamp) as timestamp, arg_min(case when price < 60 then price end, event_id) as price, min_by(price < 60, event_id) as low from ev group by 1, 2),
    j as (select g.zone, g.timestamp, case when low then price end as price from g left join o using (zone, timestamp)),
    w as (select *, last_value(price ignore nulls) over p as p0, last_value(case when price is not null then timestamp end ignore nulls) over p as t0,
      first_value(price ignore nulls) over n as p1, first_value(case when price is not null then timestamp end ignore nulls) over n as t1 from j
      window p as (partition by zone order by timestamp rows between unbounded preceding and current row), n as (partition by zone order by timestamp rows between current row and unbounded following)),
    f as (select zone, coalesce(price, case when p0 is null then p1 when p1 is null then p0 else p0 + (p1 - p0) * (epoch(timestamp) - epoch(t0)) / (epoch(t1) - epoch(t0)) end) as price, price is null as filled from w)
    select zone, count(*) as n_hours, count(*) filter (where filled) as n_filled, round(sum(price), 6) as total from f group by 1""",
)
def gap_fill_context(spark, sf_dir):
    """The last ten days of each series: the first row of an hour counts (high ones are taken for missing), gaps are filled and counted."""
    from tidemark.operators import backtest as bt

    rows = series(spark, sf_dir, AUTUMN).select("zone", F.date_trunc("hour", "timestamp").alias("timestamp"), "event_id", F.when(F.col("price") < 60, F.col("price")).alias("price"))
    filled = bt.gap_fill_linear(rows, "price", ["zone"], context_hours=240, arrival="event_id", pad=True)
    return bt.count_fills(filled, ["zone"]).join(filled.groupBy("zone").agg(F.sum("price").alias("total")), "zone").select("zone", "n_hours", "n_filled", r6("total").alias("total"))


RANGES = (("prices", "price is not null", 7, 1), ("neighbour", "zone = 'view'", 0, 0), ("weather", "n_periods > 2", 0, 1))


@query(
    "origin_range",
    f"""with {keyed_sql()}, s as ({' union all '.join(f"select zone, {back} as back, {ahead} as ahead, min(timestamp) as a, max(timestamp) + interval 1 hour as b from keyed where {rows} and price is not null group by 1" for _, rows, back, ahead in RANGES)}),
    d as (select distinct local_date as day from keyed), ok as (select day from d where not exists (select 1 from s where s.a > {at_local('day - back', 0)} or s.b < {at_local('day + ahead + 1', 0)}))
    select min(day) as first_origin, max(day) as last_origin from ok having count(*) > 0""",
)
def origin_range(spark, sf_dir):
    """Every zone's prices, a neighbour's, and readings with gaps at both ends, each with the days that origins need of it."""
    from tidemark.operators import backtest as bt

    rows = keyed(spark, sf_dir)
    return bt.origin_range([bt.Source(rows.where(which), ("price",), back, ahead, ("zone",)) for _, which, back, ahead in RANGES])
