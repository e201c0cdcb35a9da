"""Calendar and time columns. Timestamps are UTC (session time zone UTC); local time is derived only here.

Only UTC to local is ever converted row by row: the inverse is ambiguous in autumn and undefined in spring,
so lookups by local clock hour go through joins on (local date, local hour, occurrence).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

TZ = "Europe/Stockholm"


def local(ts: Column | str, tz: str = TZ) -> Column:
    return F.from_utc_timestamp(ts, tz)


def local_date(ts: Column | str, tz: str = TZ) -> Column:
    return F.to_date(local(ts, tz))


def day_start(day: Column | str, tz: str = TZ) -> Column:
    """UTC instant at which a local day begins."""
    return F.to_utc_timestamp(F.col(day).cast("timestamp") if isinstance(day, str) else day.cast("timestamp"), tz)


def plus_hours(ts: Column, hours: int | Column) -> Column:
    return F.timestamp_seconds(F.unix_timestamp(ts) + hours * 3600)


def local_day_bounds(days: DataFrame, day: str = "day", tz: str = TZ) -> DataFrame:
    """Adds ``day_start`` and ``day_end``: the UTC interval [start, end) of each local day."""
    return days.withColumn("day_start", day_start(day, tz)).withColumn("day_end", day_start(F.date_add(day, 1), tz))


def hours_in_local_day(day: Column, tz: str = TZ) -> Column:
    return ((F.unix_timestamp(day_start(F.date_add(day, 1), tz)) - F.unix_timestamp(day_start(day, tz))) / 3600).cast("int")


def expected_periods(days: DataFrame, day: str = "day", tz: str = TZ) -> DataFrame:
    """Adds the number of hourly and quarter-hourly periods of each local day (23, 24 or 25 hours)."""
    hours = hours_in_local_day(F.col(day), tz)
    return days.withColumn("n_pt60m", hours).withColumn("n_pt15m", hours * 4)


def ensure_utc(df: DataFrame, *columns: str) -> DataFrame:
    """The frame itself if all the columns are instants; times without a zone are refused, since their offset is unknown."""
    types = dict(df.dtypes)
    wrong = {c: types.get(c, "missing") for c in columns if types.get(c) != "timestamp"}
    if wrong:
        raise ValueError(f"not timestamps with a zone: {wrong}")
    return df


def neighbouring_times(df: DataFrame, keys: list[str], ts: str = "timestamp") -> DataFrame:
    """Adds ``prev_time`` and ``next_time`` in the series.

    Rows are ordered within a UTC day of a series; one row per day tells its neighbours, so that no task holds a whole series.
    """
    day = F.to_date(ts)
    ends = df.groupBy(*keys, day.alias("_day")).agg(F.min(ts).alias("_first"), F.max(ts).alias("_last"))
    days = Window.partitionBy(*keys).orderBy("_day")
    ends = ends.select(*keys, "_day", F.lead("_first").over(days).alias("_after"), F.lag("_last").over(days).alias("_before"))
    order = Window.partitionBy(*keys, "_day").orderBy(ts)
    out = df.withColumn("_day", day).join(ends, [*keys, "_day"], "left")
    out = out.withColumn("prev_time", F.coalesce(F.lag(ts).over(order), "_before")).withColumn("next_time", F.coalesce(F.lead(ts).over(order), "_after"))
    return out.select(*df.columns, "prev_time", "next_time")


#: Resolutions and their steps in seconds.
RESOLUTIONS = {"PT15M": 900, "PT60M": 3600}


def infer_resolution(df: DataFrame, keys: list[str], ts: str = "timestamp") -> DataFrame:
    """Adds ``resolution``: by the spacing to the next row (for the last row, from the one before); a spacing that is none,
    as before a gap, leaves it to the spacing from the row before; else null."""
    both = neighbouring_times(df, keys, ts)
    label = lambda step: F.when(step == 900, "PT15M").when(step == 3600, "PT60M")
    ahead, back = ((F.unix_micros(b) - F.unix_micros(a)) / 1e6 for a, b in ((ts, "next_time"), ("prev_time", ts)))
    return both.withColumn("resolution", F.coalesce(label(ahead), label(back))).drop("prev_time", "next_time")


def origin_timestamp(day: Column, hour: int = 9, tz: str = TZ) -> Column:
    """UTC instant of a local clock hour (no hour of a change of clocks) on each day."""
    return F.to_utc_timestamp(F.timestamp_seconds(F.unix_timestamp(day.cast("timestamp")) + hour * 3600), tz)


def target_hours(origins: DataFrame, day: str = "origin_date", tz: str = TZ) -> DataFrame:
    """One row per UTC hour of the local day after each origin day: ``target_time`` and ``target_date``."""
    nxt = F.date_add(day, 1)
    hours = F.sequence(day_start(nxt, tz), plus_hours(day_start(F.date_add(day, 2), tz), -1), F.expr("interval 1 hour"))
    return origins.withColumn("target_date", nxt).withColumn("target_time", F.explode(hours))


def hour_occurrence(df: DataFrame, keys: list[str], ts: str = "timestamp", tz: str = TZ) -> DataFrame:
    """Adds ``local_date, local_hour, occurrence``: the n-th time that clock hour occurs on the local day (hourly rows)."""
    out = df.withColumn("local_date", local_date(ts, tz)).withColumn("local_hour", F.hour(local(ts, tz)))
    order = Window.partitionBy(*keys, "local_date", "local_hour").orderBy(ts)
    return out.withColumn("occurrence", F.row_number().over(order))


def lead_run(ts: Column, lead_hours: int, interval_hours: int = 6) -> Column:
    """Start of the forecast run that is ``lead_hours`` before ``ts``, on the grid of runs."""
    step = interval_hours * 3600
    return F.timestamp_seconds((F.floor((F.unix_timestamp(ts) - lead_hours * 3600) / step) * step).cast("long"))


def cyclic(value: Column, period: float) -> tuple[Column, Column]:
    angle = value * (2 * 3.141592653589793 / period)
    return F.sin(angle), F.cos(angle)


def calendar_features(df: DataFrame, ts: str = "target_time", origin: str = "origin", tz: str = TZ) -> DataFrame:
    """Adds hour, dow (Monday 0), weekend, month, hours in day, summer-time flag and lead hours."""
    at = local(ts, tz)
    offset = F.unix_timestamp(at) - F.unix_timestamp(ts)
    winter = F.unix_timestamp(local(F.date_trunc("year", F.col(ts)), tz)) - F.unix_timestamp(F.date_trunc("year", F.col(ts)))
    return df.select(
        "*",
        F.hour(at).alias("cal_hour"),
        F.weekday(at).alias("cal_dow"),
        (F.weekday(at) >= 5).cast("int").alias("cal_weekend"),
        F.month(at).alias("cal_month"),
        hours_in_local_day(F.to_date(at), tz).alias("cal_hours_in_day"),
        (offset != winter).cast("int").alias("cal_dst"),
        ((F.unix_timestamp(ts) - F.unix_timestamp(origin)) / 3600).cast("int").alias("lead_hours"),
    )


# ---- holidays --------------------------------------------------------------------------------------

#: Fixed values: (month, day) of public holidays, of days off by custom, and of half days.
PUBLIC = ((1, 1), (1, 6), (5, 1), (6, 6), (12, 25), (12, 26))
CUSTOM = ((12, 24), (12, 31))
HALF = ((4, 30),)
#: Days from Easter Sunday that are public holidays.
FROM_EASTER = (-2, 0, 1, 39, 49)
FAR = 14


def easter(year: Column) -> Column:
    """Easter Sunday of the Gregorian calendar (Gauss's rule with the century corrections)."""
    century = F.floor(year / 100)
    gold = year % 19
    moon = (century - F.floor(century / 4) - F.floor((8 * century + 13) / 25) + 19 * gold + 15) % 30
    moon = moon - F.when((moon == 29) | ((moon == 28) & (gold > 10)), 1).otherwise(0)
    weekday = (year + F.floor(year / 4) + moon + 2 - century + F.floor(century / 4)) % 7
    return F.date_add(F.make_date(year.cast("int"), F.lit(3), F.lit(28)), (moon - weekday).cast("int"))


def holiday_calendar(spark: SparkSession, first: str, last: str, half_days: tuple = HALF) -> DataFrame:
    """One row per day: public, custom and half holidays, bridge days, days to the next and since the last holiday (1 to 14).

    A bridge day is a working day between a holiday and a day off, in either order.
    """
    span = F.sequence(F.date_sub(F.lit(first).cast("date"), 40), F.date_add(F.lit(last).cast("date"), 40))
    days = spark.range(1).select(F.explode(span).alias("day"))
    fixed = lambda pairs: F.coalesce(*[F.when((F.month("day") == m) & (F.dayofmonth("day") == d), True) for m, d in pairs], F.lit(False))
    since_easter = F.datediff("day", easter(F.year("day")))
    saturday = F.weekday("day") == 5
    month_day = F.month("day") * 100 + F.dayofmonth("day")
    midsummer, saints = saturday & month_day.between(620, 626), saturday & month_day.between(1031, 1106)
    eve = (F.weekday("day") == 4) & (F.month(F.date_add("day", 1)) * 100 + F.dayofmonth(F.date_add("day", 1))).between(620, 626)
    days = days.select("day", (fixed(PUBLIC) | since_easter.isin(*FROM_EASTER) | midsummer | saints).alias("is_public"), (fixed(CUSTOM) | eve).alias("is_custom"), fixed(half_days).alias("is_half"))
    holiday = F.col("is_public") | F.col("is_custom")
    off = holiday | (F.weekday("day") >= 5)
    order = Window.orderBy("day")  # one row per calendar day: a bounded dimension
    near = lambda c, n: F.coalesce(F.lag(c, n).over(order) if n > 0 else F.lead(c, -n).over(order), F.lit(False))
    days = days.withColumn("is_holiday", holiday).withColumn("is_off", off)
    days = days.withColumn("is_bridge", ~F.col("is_off") & ((near("is_holiday", 1) & near("is_off", -1)) | (near("is_off", 1) & near("is_holiday", -1))))
    last_one = F.max(F.when(F.col("is_holiday"), F.col("day"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    next_one = F.min(F.when(F.col("is_holiday"), F.col("day"))).over(order.rowsBetween(1, Window.unboundedFollowing))
    days = days.withColumn("days_since", F.coalesce(F.least(F.datediff("day", last_one), F.lit(FAR)), F.lit(FAR)))
    days = days.withColumn("days_to", F.coalesce(F.least(F.datediff(next_one, "day"), F.lit(FAR)), F.lit(FAR)))
    return days.where(F.col("day").between(F.lit(first).cast("date"), F.lit(last).cast("date"))).drop("is_off")


# ---- names -----------------------------------------------------------------------------------------


def quantile_label(q: float) -> str:
    """0.05 becomes ``q05``; levels that aren't whole per cents are refused."""
    percent = round(q * 100)
    if abs(percent - q * 100) > 1e-9 or not 0 < percent < 100:
        raise ValueError(f"{q} is no whole per cent between 1 and 99")
    return f"q{percent:02d}"


def snake_case(name: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(name), r"[^a-z0-9]+", "_"), r"^_+|_+$", "")


def area_code(zone: Column) -> Column:
    """SE3 becomes SE_3; other names stay."""
    return F.regexp_replace(zone, r"^([A-Z]{2})(\d)$", "$1_$2")


def zone_name(code: Column) -> Column:
    """SE_3 becomes SE3; other codes stay."""
    return F.regexp_replace(code, r"^([A-Z]{2})_(\d)$", "$1$2")


def metric_name(spec: Column) -> Column:
    """A model specification without the characters that metric names may not have."""
    return F.replace(F.replace(spec, F.lit("@"), F.lit("__")), F.lit("="), F.lit("-"))


def daypart(hour: Column) -> Column:
    return F.when(hour < 6, "night").when(hour < 10, "morning").when(hour < 17, "day").when(hour < 22, "evening").otherwise("late")


def season(ts: Column) -> Column:
    month = F.month(ts)
    return F.when(month.isin(12, 1, 2), "winter").when(month <= 5, "spring").when(month <= 8, "summer").otherwise("autumn")
