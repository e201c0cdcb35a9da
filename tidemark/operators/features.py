"""Leakage-safe features of rows known at a forecast origin, for all zones and origins in one plan."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.timeutils import TZ, calendar_features, cyclic, hour_occurrence, local_date, origin_timestamp, plus_hours, target_hours

from tidemark.operators.lake import commit_checked
from tidemark.operators.quality import assert_contract
from tidemark.sources.versions import VersionedTable


def same_local_hour(rows: DataFrame, keyed: DataFrame, days: int, name: str, keys: tuple[str, ...] = ("zone",), value: str = "price") -> DataFrame:
    """Adds the value of the same local clock hour ``days`` before: the first occurrence; null if there is none."""
    past = keyed.where(F.col("occurrence") == 1).select(*keys, F.date_add("local_date", days).alias("local_date"), "local_hour", F.col(value).alias(name))
    return rows.join(past, [*keys, "local_date", "local_hour"], "left")


# ---- availability ----------------------------------------------------------------------------------


def auction_availability(ts: Column | str = "timestamp", tz: str = TZ) -> Column:
    """Prices of local day X are known from 13:00 local time on day X - 1."""
    return origin_timestamp(F.date_sub(local_date(ts, tz), 1), 13, tz)


def fixed_lead_availability(ts: Column | str, lead_hours: int, delay_hours: int) -> Column:
    return plus_hours(F.col(ts) if isinstance(ts, str) else ts, -(lead_hours - delay_hours))


def as_of(df: DataFrame, origins: DataFrame, keys: tuple[str, ...] = ("zone",), back_days: int | None = None) -> DataFrame:
    """For each origin the rows with ``available_at <= origin``; with ``back_days`` only those of that many days before it.

    A bounded range is bucketed by day: an equi-join per (key, day) with a residual condition. Without a bound the result
    has all history for each origin.
    """
    if back_days is None:
        return df.join(origins, list(keys)).where("available_at <= origin")
    by_day = origins.withColumn("_day", F.explode(F.sequence(F.date_sub(F.to_date("origin"), back_days), F.date_add(F.to_date("origin"), 2))))
    return df.withColumn("_day", F.to_date("timestamp")).join(by_day, [*keys, "_day"]).where("available_at <= origin").drop("_day")


def as_of_totals(df: DataFrame, origins: DataFrame, value: str = "price", keys: tuple[str, ...] = ("zone",), ts: str = "timestamp") -> DataFrame:
    """Per origin what the as-of view adds up to: ``n_rows, last_time, n_values, total, least, most`` of the rows known by then.

    Rows and origins are merged in order of availability within a day of it; of the days before one row of running totals per
    day is carried in. Work is linear in rows plus origins, and no task holds more than a key's day. Origins by which
    nothing is known have zero rows.
    """
    keys, nothing = list(keys), F.lit(None)
    event = lambda at, kind, t, v: [*keys, F.col(at).alias("_at"), F.lit(kind).alias("_kind"), t.alias("_t"), v.cast("double").alias("_v")]
    rows = df.select(*event("available_at", 0, F.col(ts), F.col(value))).where(F.col("_at").isNotNull())
    asked = origins.select(*keys, "origin").distinct().select(*event("origin", 1, nothing.cast(dict(df.dtypes)[ts]), nothing))
    merged = rows.unionByName(asked).withColumn("_day", F.to_date("_at"))
    totals = {"n_rows": F.count_if(F.col("_kind") == 0), "last_time": F.max("_t"), "n_values": F.count("_v"), "total": F.sum("_v"), "least": F.min("_v"), "most": F.max("_v")}
    before = Window.partitionBy(*keys).orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    again = {"n_rows": F.sum, "last_time": F.max, "n_values": F.sum, "total": F.sum, "least": F.min, "most": F.max}
    by_day = merged.groupBy(*keys, "_day").agg(*[c.alias(n) for n, c in totals.items()])
    carried = by_day.select(*keys, "_day", *[again[n](n).over(before).alias(f"_c_{n}") for n in totals])
    inside = Window.partitionBy(*keys, "_day").orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    known = merged.select(*keys, "_day", "_at", "_kind", *[c.over(inside).alias(n) for n, c in totals.items()]).where("_kind = 1").join(carried, [*keys, "_day"])
    both = {n: F.coalesce(F.col(n) + F.col(f"_c_{n}"), n, f"_c_{n}") for n in ("n_rows", "n_values", "total")} | {n: F.greatest(n, f"_c_{n}") for n in ("last_time", "most")} | {"least": F.least("least", "_c_least")}
    return known.select(*keys, F.col("_at").alias("origin"), *[both[n].alias(n) for n in totals])


# ---- price features --------------------------------------------------------------------------------


def day_stats(hourly: DataFrame, keys: tuple[str, ...] = ("zone",), ts: str = "timestamp", tz: str = TZ) -> DataFrame:
    """Per local day: mean, trend against the day before (null if that day is missing), hours below zero."""
    days = hourly.groupBy(*keys, local_date(ts, tz).alias("day")).agg(F.avg("price").alias("day_mean"), F.count_if(F.col("price") < 0).alias("neg_hours"))
    order = Window.partitionBy(*keys).orderBy("day")
    before = F.when(F.lag("day").over(order) == F.date_sub("day", 1), F.lag("day_mean").over(order))
    return days.withColumn("trend", F.col("day_mean") - before)


def carried(marks: DataFrame, wanted: DataFrame, keys: tuple[str, ...] | list[str], day: str, value: str) -> DataFrame:
    """``wanted`` days (``keys, day``) with the ``value`` of the last mark on or before each; one row per day is ordered, no more."""
    both = marks.select(*keys, day, value, F.lit(0).alias("_w")).unionByName(wanted.select(*keys, day, F.lit(None).cast(dict(marks.dtypes)[value]).alias(value), F.lit(1).alias("_w")).distinct())
    order = Window.partitionBy(*keys).orderBy(day, "_w").rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumn(value, F.last(value, ignorenulls=True).over(order)).where("_w = 1").drop("_w")


def rolling_stats(hourly: DataFrame, hours: int, keys: tuple[str, ...] = ("zone",), ts: str = "timestamp", tz: str = TZ, days: DataFrame | None = None) -> DataFrame:
    """Mean, min, max and sample deviation of the ``hours`` up to the last non-null price by the end of each local day.

    ``days`` (``keys, day``) are the days asked for, else those of the rows. A day without prices has the statistics up to
    the last price before it; only days before the first price have no row.

    Hours are cut into blocks of ``hours``: a window is the beginning of one block and the end of the block before, so two
    running aggregates within blocks give every window, each row is read once, and no task holds more than a block.
    """
    keys = list(keys)
    known = hourly.where(F.col("price").isNotNull()).select(*keys, F.floor(F.unix_timestamp(ts) / 3600).alias("_h"), "price", local_date(ts, tz).alias("day"))
    asked = hourly.select(*keys, local_date(ts, tz).alias("day")).distinct() if days is None else days
    anchors = carried(known.groupBy(*keys, "day").agg(F.max("_h").alias("_a")), asked, keys, "day", "_a").where(F.col("_a").isNotNull())
    start = F.col("_a") - (hours - 1)
    split = F.floor(start / hours) < F.floor(F.col("_a") / hours)  # else the window is a whole block
    ends = anchors.select(*keys, "_a").distinct()
    probe = lambda h, kind: [*keys, h.alias("_h"), F.lit(None).cast("double").alias("price"), F.lit(kind).alias("_kind"), "_a"]
    merged = known.select(*keys, "_h", F.col("price").cast("double"), F.lit(0).alias("_kind"), F.lit(None).cast("long").alias("_a"))
    merged = merged.unionByName(ends.select(*probe(F.col("_a"), 1))).unionByName(ends.where(split).select(*probe(start, -1))).withColumn("_block", F.floor(F.col("_h") / hours))
    block = Window.partitionBy(*keys, "_block")
    head = block.orderBy("_h", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    tail = block.orderBy(F.desc("_h"), F.desc("_kind")).rowsBetween(Window.unboundedPreceding, 0)
    parts = {"n": F.count, "mean": F.avg, "var": F.var_pop, "min": F.min, "max": F.max}
    merged = merged.select(*keys, "_kind", "_a", *[f("price").over(w).alias(f"_{s}_{n}") for s, w in (("h", head), ("t", tail)) for n, f in parts.items()]).where("_kind <> 0")
    both = merged.groupBy(*keys, "_a").agg(*[F.max(F.when(F.col("_kind") == kind, F.col(f"_{s}_{n}"))).alias(f"_{s}_{n}") for s, kind in (("h", 1), ("t", -1)) for n in parts])
    h, t = ({n: F.coalesce(f"_{s}_{n}", F.lit(0)) for n in ("n", "mean", "var")} for s in ("h", "t"))
    n = h["n"] + t["n"]
    apart = h["mean"] - t["mean"]
    squares = h["var"] * h["n"] + t["var"] * t["n"] + apart * apart * h["n"] * t["n"] / n
    found = {"mean": (h["mean"] * h["n"] + t["mean"] * t["n"]) / n, "min": F.least("_h_min", "_t_min"), "max": F.greatest("_h_max", "_t_max"), "std": F.when(n > 1, F.sqrt(squares / (n - 1)))}
    stats = both.select(*keys, "_a", *[c.alias(f"p_roll{hours}h_{k}") for k, c in found.items()])
    return anchors.join(stats, [*keys, "_a"]).drop("_a")


def samehour_mean(rows: DataFrame, keyed: DataFrame, days: int, keys: tuple[str, ...] = ("zone",)) -> DataFrame:
    """Adds the mean of the same clock hour over the ``days`` days before, skipping missing ones.

    One range window over day numbers in place of ``days`` joins.
    """
    first = keyed.where(F.col("occurrence") == 1).select(*keys, "local_date", "local_hour", "price").withColumn("_d", F.datediff("local_date", F.lit("1970-01-01")))
    wanted = rows.select(*keys, "local_date", "local_hour").distinct().withColumn("_d", F.datediff("local_date", F.lit("1970-01-01"))).withColumn("price", F.lit(None).cast("double"))
    frame = Window.partitionBy(*keys, "local_hour").orderBy("_d").rangeBetween(-days, -1)
    mean = first.unionByName(wanted).withColumn(f"samehour_mean{days}d", F.avg("price").over(frame)).groupBy(*keys, "local_date", "local_hour").agg(F.first(f"samehour_mean{days}d").alias(f"samehour_mean{days}d"))
    return rows.join(mean, [*keys, "local_date", "local_hour"], "left")


def neighbour_spread(lagged: DataFrame, pairs: DataFrame, hourly: DataFrame | None = None) -> DataFrame:
    """Own lag less the neighbour's at the same hour; ``pairs`` has ``zone, neighbour`` (a map of fixed size).

    With ``hourly`` prices the neighbour's mean of the day before too.
    """
    other = lagged.select(F.col("zone").alias("neighbour"), "target_time", F.col("p_lag1d").alias("nb_lag1d"))
    joined = lagged.join(F.broadcast(pairs), "zone").join(other, ["neighbour", "target_time"], "left")
    if hourly is not None:
        means = day_stats(hourly).select(F.col("zone").alias("neighbour"), F.date_add("day", 1).alias("target_date"), F.col("day_mean").alias("nb_dayD_mean"))
        joined = joined.join(means, ["neighbour", "target_date"], "left")
    return joined.withColumn("nb_spread", F.col("p_lag1d") - F.col("nb_lag1d"))


def zone_aggregates(readings: DataFrame, variables: list[str], keys: tuple[str, ...] = ("zone", "day")) -> DataFrame:
    """Mean, min and max over the locations of a zone, and the share of missing values."""
    aggs = [f(v).alias(f"{v}_{n}") for v in variables for n, f in (("mean", F.avg), ("min", F.min), ("max", F.max))]
    missing = sum((F.sum(F.col(v).isNull().cast("int")) for v in variables), F.lit(0)) / (F.count(F.lit(1)) * len(variables))
    return readings.groupBy(*keys).agg(*aggs, missing.alias("missing_frac"))


# ---- groups of features ------------------------------------------------------------------------------


def calendar_group(holidays: DataFrame, tz: str = TZ) -> FeatureGroup:
    """Cyclic hour and day of year, holidays of each kind, bridge days, days to and since a holiday.

    ``holidays`` is a ``holiday_calendar``: one row per day of the span.
    """

    def add(rows: DataFrame) -> DataFrame:
        hour, year = cyclic(F.col("cal_hour"), 24), cyclic(F.dayofyear("target_date"), 365.25)
        flags = {"public_holiday": "is_public", "de_facto_holiday": "is_custom", "half_day": "is_half", "bridge_day": "is_bridge"}
        days = holidays.select(F.col("day").alias("target_date"), *[F.col(c).cast("int").alias(f"cal_is_{n}") for n, c in flags.items()], F.col("days_to").alias("cal_days_to_holiday"), F.col("days_since").alias("cal_days_since_holiday"))
        rows = rows.withColumns({"cal_hour_sin": hour[0], "cal_hour_cos": hour[1], "cal_doy_sin": year[0], "cal_doy_cos": year[1]})
        return rows.join(F.broadcast(days), "target_date", "left")

    return add


def neighbour_group(keyed: DataFrame, pairs: tuple[tuple[str, str], ...]) -> FeatureGroup:
    """Per neighbour of the map ``pairs`` (zone, neighbour): price of the same clock hour on the origin day, mean of that day, own lag less its.

    Two joins whatever the number of neighbours, by local hour and by day; null where the zone has no such neighbour.
    """
    names = sorted({n for _, n in pairs})

    def add(rows: DataFrame) -> DataFrame:
        of = lambda n, value: F.max(F.when(F.col("zone") == n, value))
        known = keyed.where(F.col("zone").isin(names))
        hours = known.where("occurrence = 1").groupBy(F.date_add("local_date", 1).alias("target_date"), F.col("local_hour").alias("cal_hour")).agg(*[of(n, F.col("price")).alias(f"_lag_{n}") for n in names])
        days = day_stats(known).groupBy(F.col("day").alias("origin_date")).agg(*[of(n, F.col("day_mean")).alias(f"_mean_{n}") for n in names])
        rows = rows.join(hours, ["target_date", "cal_hour"], "left").join(days, "origin_date", "left")
        for n in names:
            mine = F.col("zone").isin([z for z, other in pairs if other == n])
            lag = F.when(mine, F.col(f"_lag_{n}"))
            rows = rows.withColumns({f"nb_{n}_lag1d": lag, f"nb_{n}_dayD_mean": F.when(mine, F.col(f"_mean_{n}")), f"nb_{n}_spread_lag1d": F.col("p_lag1d") - lag})
        return rows.drop(*[f"_{k}_{n}" for n in names for k in ("lag", "mean")])

    return add


def weather_group(readings: DataFrame, locations: list[str], scalars: list[str], directions: list[str], day_of: str | None = None, tz: str = TZ) -> FeatureGroup:
    """Readings of the target hour: by location, and mean, min and max over the locations of a zone.

    ``readings`` has ``zone, location, timestamp`` and the variables; directions (degrees) become sine and cosine. For the
    variable ``day_of`` there are the change of its mean over 24 hours and its mean over the target day. The share of missing
    location values is 1 where an hour has no readings. One aggregation of the readings, then joins by hour.
    """

    def add(rows: DataFrame) -> DataFrame:
        at = lambda loc, c: F.max(F.when(F.col("location") == loc, c))
        own = {f"w_{loc}_{v}": at(loc, F.col(v)) for loc in locations for v in scalars}
        own |= {f"w_{loc}_{v}_{n}": at(loc, f(F.radians(v))) for loc in locations for v in directions for n, f in (("sin", F.sin), ("cos", F.cos))}
        over = {f"wz_{v}_{n}": f(v) for v in scalars for n, f in (("mean", F.avg), ("min", F.min), ("max", F.max))}
        hours = readings.where(F.col("location").isin(locations)).groupBy("zone", F.col("timestamp").alias("target_time")).agg(*[c.alias(n) for n, c in (own | over).items()])
        missing = sum((F.col(c).isNull().cast("int") for c in own), F.lit(0)) / len(own)
        rows = rows.join(hours.withColumn("weather_missing_frac", missing), ["zone", "target_time"], "left")
        if day_of:
            mean = f"wz_{day_of}_mean"
            before = hours.select("zone", plus_hours(F.col("target_time"), 24).alias("target_time"), F.col(mean).alias("_before"))
            days = hours.groupBy("zone", local_date("target_time", tz).alias("target_date")).agg(F.avg(mean).alias(f"wz_{day_of}_daymean"))
            rows = rows.join(before, ["zone", "target_time"], "left").join(days, ["zone", "target_date"], "left")
            rows = rows.withColumn(f"wz_{day_of}_d24", F.col(mean) - F.col("_before")).drop("_before")
        return rows.withColumn("weather_missing_frac", F.coalesce("weather_missing_frac", F.lit(1.0)))

    return add


# ---- dataset ---------------------------------------------------------------------------------------

FeatureGroup = Callable[[DataFrame], DataFrame]


def origin_dataset(keyed: DataFrame, groups: tuple[FeatureGroup, ...] = (), tz: str = TZ, rolls: tuple[int, ...] = (24,), targets: DataFrame | None = None) -> DataFrame:
    """Rows of all origins: the origin day D at 09:00 local, one row per hour of D + 1 that has a price.

    Only prices known at the origin are used: all of local day D, nothing of D + 1. ``rolls`` are the hours of the trailing
    statistics; ``groups`` are functions from rows to rows that add feature columns. ``targets`` (rows like ``keyed``) gives
    the target hours in place of those with a price: a null price stays as a null ``y``.
    """
    rows = (keyed.where(F.col("price").isNotNull()) if targets is None else targets).withColumn("origin_date", F.date_sub("local_date", 1))
    for k in (1, 2, 7, 8):
        rows = same_local_hour(rows, keyed, k, f"p_lag{k}d")
    rows = samehour_mean(rows, keyed, 7)
    days = day_stats(keyed).withColumnRenamed("day", "origin_date")
    rows = rows.join(days, ["zone", "origin_date"], "left")
    origin_days = rows.select("zone", F.col("origin_date").alias("day")).distinct()
    for hours in rolls:
        rows = rows.join(rolling_stats(keyed, hours, days=origin_days, tz=tz).withColumnRenamed("day", "origin_date"), ["zone", "origin_date"], "left")
    rows = calendar_features(rows.withColumn("origin", origin_timestamp(F.col("origin_date"), 9, tz)), "timestamp", "origin", tz)
    rows = rows.select(
        "zone", "origin", "origin_date", F.col("timestamp").alias("target_time"), F.col("local_date").alias("target_date"), F.col("price").alias("y"),
        "cal_hour", "cal_dow", "cal_weekend", "cal_month", "cal_hours_in_day", "cal_dst", "lead_hours",
        "p_lag1d", "p_lag2d", "p_lag7d", "p_lag8d", F.col("samehour_mean7d").alias("p_samehour_mean7d"), F.col("day_mean").alias("p_dayD_mean"), F.col("trend").alias("p_dayD_trend"), F.col("neg_hours").alias("p_dayD_neg_hours"),
        *[f"p_roll{h}h_{n}" for h in rolls for n in ("mean", "min", "max", "std")],
    )
    for group in groups:
        rows = group(rows)
    return rows


#: Days before an origin day that lags, means and day statistics look back on.
LOOK_BACK = 9


def days_to_read(keyed: DataFrame, origins: DataFrame, rolls: tuple[int, ...]) -> DataFrame:
    """``zone, origin_date, local_date``: the days that features of the origins read.

    Those of :data:`LOOK_BACK`, and those of the trailing statistics, which end at the last price by the origin day, however
    long before that was.
    """
    priced = keyed.where(F.col("price").isNotNull()).select("zone", F.col("local_date").alias("origin_date"), F.col("local_date").alias("_last")).distinct()
    last = carried(priced, origins, ["zone"], "origin_date", "_last")
    near = lambda end, back: F.sequence(F.date_sub(end, back), end)
    rolled = F.when(F.col("_last").isNotNull(), near(F.col("_last"), max(rolls, default=0) // 24 + 1)).otherwise(F.array().cast("array<date>"))
    return last.select("zone", "origin_date", F.explode(F.array_union(near(F.date_add("origin_date", 1), LOOK_BACK + 1), rolled)).alias("local_date"))


def live_rows(keyed: DataFrame, origins: DataFrame, groups: tuple[FeatureGroup, ...] = (), tz: str = TZ, rolls: tuple[int, ...] = (24,)) -> DataFrame:
    """Rows of the given origins (distinct ``zone, origin_date``): every hour of the day after, whether it has a price yet or not.

    Only the days that the features look back on are read.
    """
    keyed = keyed.join(days_to_read(keyed, origins, rolls), ["zone", "local_date"], "left_semi")
    hours = hour_occurrence(target_hours(origins, tz=tz).select("zone", F.col("target_time").alias("timestamp")), ["zone"], tz=tz)
    return origin_dataset(keyed, groups, tz, rolls, hours.join(keyed.select("zone", "timestamp", "price"), ["zone", "timestamp"], "left"))


def dropped_targets(keyed: DataFrame, origins: DataFrame, tz: str = TZ) -> DataFrame:
    """``zone, origin_date, n_dropped``: how many target hours of the origins have no price, where any; a dataset has no rows of them."""
    hours = target_hours(origins.select("zone", "origin_date").distinct(), tz=tz).select("zone", "origin_date", F.col("target_time").alias("timestamp"))
    priced = keyed.where(F.col("price").isNotNull()).select("zone", "timestamp").distinct()
    return hours.join(priced, ["zone", "timestamp"], "left_anti").groupBy("zone", "origin_date").agg(F.count(F.lit(1)).alias("n_dropped"))


META = ("zone", "origin", "origin_date", "target_time", "target_date")


def store_live_rows(live: DataFrame, reference: DataFrame, root: str, nullable: tuple[str, ...] = ()) -> dict:
    """Commit live rows to a versioned table, or refuse them: the manifest of the new version.

    Columns and types must be those of ``reference`` (the dataset that the model was fitted on). A feature that the
    reference always has, by local hour, may not be missing: its nulls are counted while the rows are written, and nothing
    is committed if there are any. ``y`` and the columns named ``nullable`` may be missing. Rows of an origin that is stored
    already replace it.
    """
    assert_contract(live, reference.schema)
    checked = [c for c in reference.columns if c not in (*META, "y", "cal_hour", *nullable)]
    seen = reference.groupBy("cal_hour").agg(*[(F.count(c) == F.count(F.lit(1))).alias(c) for c in checked])  # 24 rows
    always = F.broadcast(seen.select(F.col("cal_hour").alias("_hour"), F.struct(*checked).alias("_always")))
    rows = live.join(always, F.col("cal_hour") == F.col("_hour"), "left")
    wrong = {c: F.col(c).isNull() & F.coalesce(F.col(f"_always.{c}"), F.lit(True)) for c in checked}
    part_of = lambda p: (p["first_origin"], p["last_origin"], p["zones"])
    span = live.agg(F.min("origin_date").cast("string"), F.max("origin_date").cast("string"), F.array_sort(F.collect_set("zone"))).first()  # zones of one run
    table = VersionedTable(live.sparkSession, root)

    def place(manifest: dict, part: dict) -> list[dict]:
        new = part | dict(zip(("first_origin", "last_origin", "zones"), (span[0], span[1], list(span[2]))))
        return [p for p in manifest["parts"] if part_of(p) != part_of(new)] + [new]

    return commit_checked(rows, table, wrong, place, only=live.columns)


def noise(seed: int, *keys: str) -> Column:
    """A number in [0, 1) from integer arithmetic on the key columns (numbers): the same in every engine."""
    x = F.lit(seed).cast("long")
    for k in keys:
        x = F.pmod(x * 48271 + F.col(k).cast("long") % 2147483647 + 11, F.lit(2147483647))
    return F.pmod(x * 48271, F.lit(2147483647)) / 2147483647.0


def perturb_unavailable(df: DataFrame, origin: Column, seed: int, value: str = "price", ts: str = "timestamp") -> DataFrame:
    """Values not yet known at the origin become noise, about a tenth of them null."""
    u = noise(seed, "_s")
    new = F.when(u < 0.1, None).otherwise(u * 1000)
    return df.withColumn("_s", F.unix_timestamp(ts)).withColumn(value, F.when(F.col("available_at") > origin, new).otherwise(F.col(value))).drop("_s")


def audit_copies(keyed: DataFrame, days: DataFrame, rolls: tuple[int, ...] = (24,)) -> DataFrame:
    """The rows around each audited origin day, with ``audit_date`` and the day appended to the zone: one plan builds them all.

    ``days`` is a sample of a fixed size (``audit_sample``) with the column ``day``.
    """
    origins = keyed.select("zone", F.explode(F.array("local_date", F.date_sub("local_date", 1))).alias("origin_date")).distinct()
    origins = origins.join(F.broadcast(days.select(F.col("day").alias("origin_date"))), "origin_date", "left_semi")
    near = days_to_read(keyed, origins, rolls).withColumnRenamed("origin_date", "audit_date")
    return keyed.join(near, ["zone", "local_date"]).withColumn("zone", F.concat_ws("@", "zone", F.col("audit_date").cast("string")))


def audited(dataset: DataFrame) -> DataFrame:
    """Of a dataset built from ``audit_copies`` the rows of the audited origins."""
    return dataset.where(F.col("zone").endswith(F.concat(F.lit("@"), F.col("origin_date").cast("string"))))


def leakage_audit(clean: DataFrame, perturbed: DataFrame, target: str = "y") -> DataFrame:
    """Per column, how many rows of the audited origins changed when everything unknown at the origin did.

    A changed feature is a leak; an unchanged target would mean that the audit tests nothing.
    """
    features = [c for c in clean.columns if c not in META]
    keys = ["zone", "target_time"]
    tall = lambda df: df.select(*keys, *[F.col(c).cast("double").alias(c) for c in features]).unpivot(keys, features, "column", "value")
    both = tall(clean).alias("a").join(tall(perturbed).withColumnRenamed("value", "other"), [*keys, "column"])
    changed = F.count_if(~F.col("value").eqNullSafe(F.col("other")))
    return both.groupBy("column").agg(F.count(F.lit(1)).alias("n_rows"), changed.alias("n_changed")).withColumn("leaks", (F.col("column") != target) & (F.col("n_changed") > 0))
