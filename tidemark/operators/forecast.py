"""Quantile forecasters and their combination, for all series and origins in set-based plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.timeutils import quantile_label
from tidemark.operators.features import carried


def residual_quantiles(rows: DataFrame, keys: list[str], qs: tuple[float, ...]) -> DataFrame:
    """``keys, offsets``: exact quantiles of y - point (skipping nulls)."""
    return rows.groupBy(*keys).agg(F.percentile(F.col("y") - F.col("point"), F.array(*map(F.lit, qs))).alias("offsets"))


def with_quantiles(rows: DataFrame, offsets: DataFrame, keys: list[str], qs: tuple[float, ...]) -> DataFrame:
    """Adds q05 .. q95 = point + offset."""
    return rows.join(offsets, keys).select("*", *[(F.col("point") + F.col("offsets")[i]).alias(quantile_label(q)) for i, q in enumerate(qs)]).drop("offsets")


def naive_point(lag: int | str, rows: DataFrame) -> Column:
    """The lagged price, else the mean of the same hour over 7 days, else the mean of the origin day.

    ``weekday``: one week back for Saturday to Monday, else one day.
    """
    own = F.when(F.col("cal_dow").isin(0, 5, 6), F.col("p_lag7d")).otherwise(F.col("p_lag1d")) if lag == "weekday" else F.col(f"p_lag{lag}d")
    return F.coalesce(own, "p_samehour_mean7d", "p_dayD_mean")


def sorted_quantile(values: Column, q: float) -> Column:
    """The quantile of a sorted array, linear between its members; null if it is empty."""
    at = (F.size(values) - 1) * F.lit(q)
    low = F.floor(at).cast("int")
    below, above = F.get(values, low), F.get(values, F.least(low + 1, F.size(values) - 1))
    return F.when(F.size(values) > 0, below + (above - below) * (at - low))


def rolling_quantiles(errors: DataFrame, wanted: DataFrame, keys: list[str], day: str, window_days: int, levels: list[tuple[str, str, float]]) -> DataFrame:
    """``keys, day, n_days`` and exact quantiles of the errors of the ``window_days`` days up to each wanted day.

    ``levels`` has (name, error column, level). The errors of a day are gathered once, as one array; a window joins the
    arrays of its days. So no error is copied for each window that it is in, and a task orders one row per day.
    """
    columns = sorted({c for _, c, _ in levels})
    per_day = errors.groupBy(*keys, day).agg(*[F.collect_list(c).alias(c) for c in columns], F.lit(0).alias("_w"))
    both = per_day.unionByName(wanted.select(*keys, day, F.lit(1).alias("_w")).distinct(), allowMissingColumns=True)
    frame = Window.partitionBy(*keys).orderBy(F.datediff(day, F.lit("1970-01-01"))).rangeBetween(-(window_days - 1), 0)
    joined = both.select(*keys, day, "_w", F.count(columns[0]).over(frame).alias("n_days"), *[F.collect_list(c).over(frame).alias(c) for c in columns]).where("_w = 1")
    ordered = joined.select(*keys, day, "n_days", *[F.array_sort(F.flatten(c)).alias(c) for c in columns])
    return ordered.select(*keys, day, "n_days", *[sorted_quantile(F.col(c), q).alias(name) for name, c, q in levels])


def seasonal_naive(rows: DataFrame, schedule: DataFrame, lag: int | str, qs: tuple[float, ...], residual_days: int = 56, by_hour: bool = True) -> DataFrame:
    """Forecasts of all origins: quantiles of the method's own errors over the ``residual_days`` days up to the last training day of each fit.

    ``rows`` is an origin dataset; ``schedule`` gives ``zone, origin_date, fit_origin``. The last training day is the last one
    with rows by the day of the fit, however long before. A fit without errors at an hour gives no forecast there.
    """
    rows = rows.withColumn("point", naive_point(lag, rows))
    hour = ["cal_hour"] if by_hour else []
    fits = schedule.select("zone", "fit_origin").distinct()
    trained = rows.where(F.col("y").isNotNull()).select("zone", F.col("target_date").alias("fit_origin"), F.col("target_date").alias("_last")).distinct()
    last = carried(trained, fits, ["zone"], "fit_origin", "_last").where(F.col("_last").isNotNull())
    errors = rows.select("zone", *hour, F.col("target_date").alias("_last"), (F.col("y") - F.col("point")).alias("_e")).where(F.col("_e").isNotNull())
    wanted = last.select("zone", "_last").distinct()
    if by_hour:
        wanted = wanted.join(rows.select("zone", "cal_hour").distinct(), "zone")
    names = [f"_o{i}" for i in range(len(qs))]
    offsets = rolling_quantiles(errors, wanted, ["zone", *hour], "_last", residual_days, [(n, "_e", q) for n, q in zip(names, qs)]).where("n_days > 0")
    offsets = last.join(offsets.select("zone", *hour, "_last", F.array(*names).alias("offsets")), ["zone", "_last"]).drop("_last")
    return with_quantiles(rows.join(schedule, ["zone", "origin_date"]), offsets, ["zone", "fit_origin", *hour], qs)


#: Standard normal quantiles of the seven levels.
NORMAL = {0.05: -1.6448536269514722, 0.10: -1.2815515655446004, 0.25: -0.6744897501960817, 0.50: 0.0, 0.75: 0.6744897501960817, 0.90: 1.2815515655446004, 0.95: 1.6448536269514722}


def seasonal_decomposition(rows: DataFrame, keyed: DataFrame, qs: tuple[float, ...], context_days: int = 56) -> DataFrame:
    """Trend, hour-of-week effects and Gaussian intervals from the last ``context_days`` days known at each origin.

    The trend of a day is the mean of the daily means of the seven days up to it, carried on to the target day by a seventh of
    its change over a week (no change known: level). The effects are mean deviations from the trend by hour and weekday, by the
    hour alone where that weekday has none yet; the width is the deviation that the effects leave at that hour.
    """
    number = F.datediff("day", F.lit("1970-01-01"))
    prices = keyed.where(F.col("price").isNotNull()).select("zone", F.col("local_date").alias("day"), F.col("local_hour").alias("hour"), "price")
    of_zone = Window.partitionBy("zone").orderBy(number)
    trend = prices.groupBy("zone", "day").agg(F.avg("price").alias("mean")).select("zone", "day", F.avg("mean").over(of_zone.rangeBetween(-6, 0)).alias("trend"))
    change = F.coalesce(F.col("trend") - F.max("trend").over(of_zone.rangeBetween(-7, -7)), F.lit(0.0))
    level = trend.select("zone", F.col("day").alias("origin_date"), (F.col("trend") + change / 7).alias("level"))
    dev = prices.join(trend, ["zone", "day"]).select("zone", "hour", "day", (F.col("price") - F.col("trend")).alias("dev"))
    per_day = dev.groupBy("zone", "hour", "day").agg(F.sum("dev").alias("s"), F.count(F.lit(1)).alias("n"), F.sum(F.col("dev") * F.col("dev")).alias("ss"))
    # Rows without values, so that an hour that the origin day lacks still has effects.
    wanted = rows.select("zone", F.col("cal_hour").alias("hour"), F.col("origin_date").alias("day")).distinct()
    context = Window.partitionBy("zone", "hour").orderBy(number).rangeBetween(-(context_days - 1), 0)
    sums = [F.sum(F.when(F.weekday("day") == d, F.col(c))).over(context).alias(f"{c}{d}") for d in range(7) for c in ("s", "n", "ss")]
    known = per_day.unionByName(wanted, allowMissingColumns=True).select("zone", "hour", "day", *sums).dropDuplicates(["zone", "hour", "day"])
    total = lambda part: sum((F.coalesce(part(d), F.lit(0)) for d in range(1, 7)), F.coalesce(part(0), F.lit(0)))
    s, n, ss = (lambda d, c=c: F.col(f"{c}{d}") for c in ("s", "n", "ss"))
    n_all, groups, left = total(n), total(lambda d: n(d).isNotNull().cast("int")), total(lambda d: ss(d) - s(d) * s(d) / n(d))
    mean = F.array(*[s(d) / n(d) for d in range(7)])
    of_hour = (total(ss) - total(s) * total(s) / n_all) / (n_all - 1)
    effects = known.select(
        "zone",
        F.col("hour").alias("cal_hour"),
        F.col("day").alias("origin_date"),
        F.coalesce(mean[F.weekday(F.date_add("day", 1))], F.when(n_all > 0, total(s) / n_all)).alias("effect"),
        F.sqrt(F.greatest(F.when(n_all > groups, left / (n_all - groups)).when(n_all > 1, of_hour), F.lit(0.0) * n_all)).alias("_sigma"),
        (n_all > 1).alias("_wide"),
    )
    effects = effects.withColumn("sigma", F.when(F.col("_wide"), F.col("_sigma"))).drop("_sigma", "_wide")
    out = rows.join(level, ["zone", "origin_date"]).join(effects, ["zone", "origin_date", "cal_hour"])
    return out.select("*", *[(F.col("level") + F.col("effect") + F.col("sigma") * NORMAL[q]).alias(quantile_label(q)) for q in qs])


def sort_quantiles(fc: DataFrame, columns: list[str]) -> DataFrame:
    """Quantiles in order, and whether sorting changed the row."""
    before = F.array(*columns)
    rest = [c for c in fc.columns if c not in columns]
    out = fc.withColumn("_b", before).withColumn("_a", F.array_sort(before))
    return out.select(*rest, *[F.col("_a")[i].alias(c) for i, c in enumerate(columns)], (F.col("_a") != F.col("_b")).alias("was_crossing"))


def recalibrate(fc: DataFrame, columns: list[str], qs: tuple[float, ...], window_days: int = 28, min_days: int = 7, keys: tuple[str, ...] = ("model", "zone")) -> DataFrame:
    """Adds to every quantile the same quantile of its own errors over the target days in the window up to the origin.

    Fewer than ``min_days`` days: the offset of the origin before, zero at the start. Null actuals are no errors.
    """
    keys = list(keys)
    errors = fc.where(F.col("y").isNotNull()).select(*keys, F.col("target_date").alias("_day"), *[(F.col("y") - F.col(c)).alias(f"_e_{c}") for c in columns])
    origins = fc.select(*keys, "origin_date").distinct()
    offsets = rolling_quantiles(errors, origins.withColumnRenamed("origin_date", "_day"), keys, "_day", window_days, [(f"_o_{c}", f"_e_{c}", q) for c, q in zip(columns, qs)])
    order = Window.partitionBy(*keys).orderBy("_day").rowsBetween(Window.unboundedPreceding, 0)
    kept = [F.coalesce(F.last(F.when(F.col("n_days") >= min_days, F.col(f"_o_{c}")), ignorenulls=True).over(order), F.lit(0.0)).alias(f"_o_{c}") for c in columns]
    offsets = offsets.select(*keys, F.col("_day").alias("origin_date"), *kept)
    rest = [c for c in fc.columns if c not in columns]
    return fc.join(offsets, [*keys, "origin_date"]).select(*rest, *[(F.col(c) + F.col(f"_o_{c}")).alias(c) for c in columns])


def simplex_grid(spark: SparkSession, k: int, steps: int) -> DataFrame:
    """All weights of ``k`` members in multiples of 1/steps that add up to 1, the most balanced first."""
    grid = spark.range(1).select(F.array().cast("array<int>").alias("parts"))
    for _ in range(k - 1):
        left = F.lit(steps) - F.aggregate("parts", F.lit(0), lambda a, x: a + x)
        grid = grid.select("parts", F.explode(F.sequence(F.lit(0), left)).alias("x")).select(F.concat("parts", F.array("x")).alias("parts"))
    grid = grid.select(F.concat("parts", F.array(F.lit(steps) - F.aggregate("parts", F.lit(0), lambda a, x: a + x))).alias("parts"))
    spread = F.aggregate("parts", F.lit(0), lambda a, x: a + x * x)
    ranked = grid.withColumn("rank", F.row_number().over(Window.orderBy(spread, F.desc("parts"))))  # a grid of fixed size
    return ranked.select("rank", *[(F.col("parts")[i] / steps).alias(f"w{i + 1}") for i in range(k)])


def mixed(weights: list[str], i: int, members: str = "members") -> Column:
    """The ``i``-th quantile of the members, weighted."""
    first, *others = [F.col(w) * F.col(members)[k][i] for k, w in enumerate(weights)]
    return sum(others, first)


def ensemble_weights(
    members: DataFrame, grid: DataFrame, columns: list[str], qs: tuple[float, ...], weighting: str = "hourly", window_days: int | None = None, min_days: int = 14
) -> DataFrame:
    """Per zone, group (hour, or -1 for global and equal) and origin the weights ``w1 .. wK`` of K members with least pinball loss.

    ``members`` has ``zone, target_date, target_time, cal_hour, y`` and ``members``, an array of the members' arrays of
    sorted quantiles; ``grid`` has ``rank, w1 .. wK``. Losses add up per day and grid point once; origins read them from
    running sums, so history isn't scored again for each origin. Too short a history carries the weights of the origin
    before (equal at the start); ties after rounding go to the more balanced point. ``equal`` learns nothing.
    """
    names = [c for c in grid.columns if c != "rank"]
    equal = F.lit(1.0 / len(names))
    group = F.col("cal_hour") if weighting == "hourly" else F.lit(-1)
    number = F.datediff("target_date", F.lit("1970-01-01"))
    back = Window.unboundedPreceding if window_days is None else -(window_days - 1)
    days = members.where(F.col("y").isNotNull()).select("zone", "target_date").distinct()
    history = days.select("zone", F.col("target_date").alias("origin_date"), F.count(F.lit(1)).over(Window.partitionBy("zone").orderBy(number).rangeBetween(back, 0)).alias("days"))
    if weighting == "equal":
        return history.select("zone", F.lit(-1).alias("grp"), "origin_date", *[equal.alias(w) for w in names])
    losses = members.where(F.col("y").isNotNull()).withColumn("grp", group).crossJoin(F.broadcast(grid))  # the grid has a fixed number of points
    loss = sum((pinball(F.col("y"), mixed(names, i), q) for i, q in enumerate(qs)), F.lit(0.0)) / len(qs)
    per_day = losses.groupBy("zone", "grp", "rank", *names, "target_date").agg(F.sum(loss).alias("s"), F.count(F.lit(1)).alias("n"))
    frame = Window.partitionBy("zone", "grp", "rank").orderBy(number).rangeBetween(back, 0)
    running = per_day.select("zone", "grp", "rank", *names, "target_date", (F.sum("s").over(frame) / F.sum("n").over(frame)).alias("loss"))
    best = running.groupBy("zone", "grp", F.col("target_date").alias("origin_date")).agg(F.min_by(F.struct(*names), F.struct(F.round("loss", 12), "rank")).alias("w"))
    every = members.select("zone", group.alias("grp")).distinct().join(history, "zone")
    order = Window.partitionBy("zone", "grp").orderBy("origin_date").rowsBetween(Window.unboundedPreceding, 0)
    chosen = every.join(best, ["zone", "grp", "origin_date"], "left").select("zone", "grp", "origin_date", F.last(F.when(F.col("days") >= min_days, F.col("w")), ignorenulls=True).over(order).alias("w"))
    return chosen.select("zone", "grp", "origin_date", *[F.coalesce(F.col("w")[w], equal).alias(w) for w in names])


def ensemble_combine(members: DataFrame, weights: DataFrame, columns: list[str], weighting: str = "hourly") -> DataFrame:
    """Weighted mean of the members' sorted quantiles; equal weights where none are learned yet."""
    names = [c for c in weights.columns if c not in ("zone", "grp", "origin_date")]
    rows = members.withColumn("grp", F.col("cal_hour") if weighting == "hourly" else F.lit(-1)).join(weights, ["zone", "grp", "origin_date"], "left")
    rows = rows.withColumns({w: F.coalesce(w, F.lit(1.0 / len(names))) for w in names})
    return rows.select("zone", "origin_date", "target_time", "target_date", "cal_hour", "y", *[mixed(names, i).alias(c) for i, c in enumerate(columns)])


def pinball(y: Column, q: Column, tau: float) -> Column:
    d = y - q
    return F.greatest(d * tau, d * (tau - 1))


def decile_to_quantile(df: DataFrame, deciles: str, qs: tuple[float, ...]) -> DataFrame:
    """Quantiles from an array of the nine deciles: linear between them, tails scaled like a normal's."""
    d = lambda i: F.col(deciles)[i - 1]
    z90 = NORMAL[0.90]

    def at(q: float) -> Column:
        if q < 0.1:
            return d(5) + (d(1) - d(5)) * (NORMAL[q] / -z90)
        if q > 0.9:
            return d(5) + (d(9) - d(5)) * (NORMAL[q] / z90)
        low = min(8, int(q * 10 + 1e-9))
        return d(low) + (d(low + 1) - d(low)) * round(q * 10 - low, 9)

    return df.select("*", *[at(q).alias(quantile_label(q)) for q in qs])
