"""Origins: their ranges, samples, schedules and gaps."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_
from typing import Protocol

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.timeutils import TZ, day_start, hours_in_local_day, local_date, plus_hours
from tidemark.operators.forecast import sort_quantiles
from tidemark.sources.scratch import stored


class Forecaster(Protocol):
    """What users plug into :func:`backtest`: training rows and rows to predict in, the latter with quantiles out."""

    def __call__(self, train: DataFrame, rows: DataFrame) -> DataFrame: ...


def backtest(forecaster: Forecaster, rows: DataFrame, schedule: DataFrame, columns: list[str], keys: tuple[str, ...] = ("zone",)) -> DataFrame:
    """Rolling-origin forecasts of a model that has to be fitted: one fit per refit origin, never per origin.

    A fit sees target days up to its origin only and predicts the origins that the schedule gives it; the
    target isn't among the columns that it predicts from. Null quantiles are an error when the rows are read;
    crossing ones are sorted and flagged. The loop is over refit origins (months), since a fit is a job.
    """
    keys = list(keys)
    rows = stored(rows, "backtest")  # read by every fit
    parts = []
    for fit in [r.fit_origin for r in schedule.select("fit_origin").distinct().orderBy("fit_origin").collect()]:
        todo = rows.join(schedule.where(F.col("fit_origin") == fit).select(*keys, "origin_date"), [*keys, "origin_date"], "left_semi")
        found = forecaster(rows.where(F.col("target_date") <= fit), todo.drop("y")).withColumn("fit_origin", F.lit(fit))
        parts.append(found.join(todo.select(*keys, "target_time", "origin_date", "y"), [*keys, "target_time", "origin_date"]))
    out = reduce(DataFrame.unionByName, parts)
    whole = [F.when(F.col(c).isNull(), F.raise_error(F.lit(f"null {c}")).cast("double")).otherwise(F.col(c)).alias(c) for c in columns]
    return sort_quantiles(out.select(*[c for c in out.columns if c not in columns], *whole), columns)


def audit_sample(days: DataFrame, n: int, seed: int, tz: str = TZ) -> DataFrame:
    """Both ends, ``n`` days in the order of an arithmetic hash, and every day before a change of clocks."""
    number = F.datediff("day", F.lit("1970-01-01")).cast("long")
    u = F.pmod(F.pmod(number * 48271 + seed * 1000003, F.lit(2147483647)) * 48271, F.lit(2147483647))
    change = hours_in_local_day(F.date_add("day", 1), tz) != 24
    ends = days.agg(F.min("day").alias("_a"), F.max("day").alias("_b"))
    picked = days.orderBy(u, "day").limit(n).withColumn("_picked", F.lit(True))
    rows = days.join(F.broadcast(ends)).join(F.broadcast(picked), "day", "left").withColumn("is_end", F.col("day").isin(F.col("_a"), F.col("_b"))).withColumn("is_clock_change", change)
    return rows.where("is_end or is_clock_change or _picked").select("day", "is_end", "is_clock_change")


def new_nulls(live: DataFrame, reference: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Keys and columns that have a value in the reference and none in the live rows."""
    both = reference.select(*keys, *columns).join(live.select(*keys, *[F.col(c).alias(f"_live_{c}") for c in columns]), keys, "left")
    lost = F.filter(F.array(*[F.when(F.col(c).isNotNull() & F.col(f"_live_{c}").isNull(), F.lit(c)) for c in columns]), lambda x: x.isNotNull())
    return both.select(*keys, F.explode(lost).alias("column"))


def gap_fill_linear(df: DataFrame, col: str, keys: list[str], ts: str = "timestamp", context_hours: int | None = None, arrival: str | None = None, pad: bool = False) -> DataFrame:
    """The series on its full hourly grid; gaps filled linearly in time, the ends with the nearest value: ``keys, ts, col, filled``.

    ``context_hours`` keeps the hours up to the last one only; with ``pad`` the grid has all of them, also those before the
    first row. Of rows of the same hour the first by ``arrival`` counts, null or not (without ``arrival``: the least value).
    A series without any value stays null. Rows are ordered within UTC days; one row per day carries the nearest values
    of other days in, so that no task holds a series.
    """
    last = df.groupBy(*keys).agg(F.max(ts).alias("_b"))
    rows = df.select(*keys, ts, col, *([arrival] if arrival else []))
    if context_hours is not None:
        start = F.col("_b") - F.make_dt_interval(hours=F.lit(context_hours - 1))
        rows = rows.join(last.select(*keys, start.alias("_a")), keys).where(F.col(ts) >= F.col("_a")).drop("_a")
    first = F.min_by(F.struct(col), F.struct(arrival)) if arrival else F.min(F.struct(col))
    once = rows.groupBy(*keys, ts).agg(first.alias("_v")).select(*keys, ts, F.col(f"_v.{col}").alias(col))
    span = once.groupBy(*keys).agg(F.min(ts).alias("_a"), F.max(ts).alias("_b"))
    if pad and context_hours is not None:
        span = span.withColumn("_a", F.col("_b") - F.make_dt_interval(hours=F.lit(context_hours - 1)))
    grid = span.select(*keys, F.explode(F.sequence("_a", "_b", F.expr("interval 1 hour"))).alias(ts)).join(once, [*keys, ts], "left").withColumn("_day", F.to_date(ts))
    known = F.when(F.col(col).isNotNull(), F.struct(F.unix_timestamp(ts).alias("t"), F.col(col).alias("v")))
    ends = grid.groupBy(*keys, "_day").agg(F.min(known).alias("_first"), F.max(known).alias("_last"))
    days = Window.partitionBy(*keys).orderBy("_day")
    before = F.last("_last", ignorenulls=True).over(days.rowsBetween(Window.unboundedPreceding, -1))
    after = F.first("_first", ignorenulls=True).over(days.rowsBetween(1, Window.unboundedFollowing))
    order = Window.partitionBy(*keys, "_day").orderBy(ts)
    near = grid.withColumn("_p", F.last(known, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    near = near.withColumn("_n", F.first(known, ignorenulls=True).over(order.rowsBetween(0, Window.unboundedFollowing)))
    near = near.join(ends.select(*keys, "_day", before.alias("_c"), after.alias("_d")), [*keys, "_day"]).withColumns({"_p": F.coalesce("_p", "_c"), "_n": F.coalesce("_n", "_d")})
    line = F.col("_p.v") + (F.col("_n.v") - F.col("_p.v")) * (F.unix_timestamp(ts) - F.col("_p.t")) / (F.col("_n.t") - F.col("_p.t"))
    value = F.when(F.col(col).isNotNull(), F.col(col)).when(F.col("_p").isNull(), F.col("_n.v")).when(F.col("_n").isNull(), F.col("_p.v")).otherwise(line)
    return near.select(*keys, ts, value.alias(col), F.col(col).isNull().alias("filled"))


def count_fills(filled: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, n_hours, n_filled`` of a filled series."""
    return filled.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_hours"), F.count_if("filled").alias("n_filled"))


def evaluation_rows(dataset: DataFrame, live: DataFrame, origin_date: str) -> DataFrame:
    """What a live run fits on and predicts: the dataset's rows of earlier origins, and the live rows."""
    return dataset.where(F.col("origin_date") < F.lit(origin_date).cast("date")).unionByName(live)


def variant(model: str, **spec: object) -> str:
    """The name of a model variant, ``model@key=value@...`` by key; a key without a value doesn't count.

    Names are keys of stored forecasts: equal specifications give equal names, and the separators can't be part of one.
    """
    parts = [model, *(f"{k}={v}" for k, v in sorted(spec.items()) if v is not None)]
    if any("@" in p or p.count("=") != (i > 0) for i, p in enumerate(parts)):
        raise ValueError(f"separator in a variant: {parts}")
    return "@".join(parts)


@dataclass(frozen=True)
class Source:
    """Hourly rows that origins need: from ``back_days`` before an origin day to ``ahead_days`` behind it.

    Each series of ``keys`` must cover them by itself; hours without any of the ``values`` don't count.
    """

    rows: DataFrame
    values: tuple[str, ...]
    back_days: int
    ahead_days: int
    keys: tuple[str, ...] = ()


def origin_range(sources: list[Source], ts: str = "timestamp", tz: str = TZ) -> DataFrame:
    """``first_origin, last_origin``: the days whose needs all series of all sources cover; no row if there is none.

    A series covers a local day if it begins by the day's first instant and its last hour ends no sooner than the day.
    """
    spans = None
    for source in sources:
        any_value = reduce(or_, [F.col(v).isNotNull() for v in source.values])
        span = source.rows.where(any_value).groupBy(*source.keys).agg(F.min(ts).alias("a"), F.max(ts).alias("b"))
        whole = F.when(day_start(local_date("a", tz), tz) < F.col("a"), F.date_add(local_date("a", tz), 1)).otherwise(local_date("a", tz))
        span = span.where("a is not null").select(F.date_add(whole, source.back_days).alias("first"), F.date_sub(local_date(plus_hours(F.col("b"), 1), tz), 1 + source.ahead_days).alias("last"))
        spans = span if spans is None else spans.unionByName(span)
    return spans.agg(F.max("first").alias("first_origin"), F.min("last").alias("last_origin")).where("first_origin <= last_origin")


def select_origins(days: DataFrame, start: str, end: str, every: int, day: str = "origin_date") -> DataFrame:
    """Every n-th origin of the range; a multiple of 7 would always hit the same weekday and is refused."""
    if every % 7 == 0:
        raise ValueError("every must not be a multiple of 7")
    ranked = days.where(F.col(day).between(start, end)).withColumn("_n", F.row_number().over(Window.orderBy(day)))  # one row per calendar day
    return ranked.where((F.col("_n") - 1) % every == 0).drop("_n")


def refit_schedule(origins: DataFrame, keys: list[str], cadence: str = "monthly", day: str = "origin_date") -> DataFrame:
    """Adds ``fit_origin``: the origin itself, or the first origin of its month."""
    if cadence == "every_origin":
        return origins.withColumn("fit_origin", F.col(day))
    return origins.withColumn("fit_origin", F.min(day).over(Window.partitionBy(*keys, F.trunc(day, "month"))))


def fit_log(rows: DataFrame, schedule: DataFrame, keys: list[str], train_start: str | None = None) -> DataFrame:
    """Per fit the number of training rows and their first and last target day.

    Counts per day are added up over the range, so rows are read once however many fits there are.
    """
    per_day = rows.where(F.col("target_date") >= train_start) if train_start else rows
    per_day = per_day.groupBy(*keys, "target_date").agg(F.count(F.lit(1)).alias("n"))
    fits = schedule.select(*keys, "fit_origin").distinct()
    joined = fits.join(per_day, keys).where("target_date <= fit_origin")
    return joined.groupBy(*keys, "fit_origin").agg(F.sum("n").alias("train_rows"), F.min("target_date").alias("train_first_target_date"), F.max("target_date").alias("train_last_target_date"))


def time_folds(spark, eval_start: str, n: int, val_days: int, gap_days: int) -> DataFrame:
    """Expanding folds that end before the evaluation window, the latest last."""
    k = F.lit(n) - F.col("id").cast("int")
    end = F.date_sub(F.lit(eval_start).cast("date"), (k - 1) * val_days + gap_days + 1)
    folds = spark.range(n).select((F.col("id").cast("int") + 1).alias("fold"), F.date_sub(end, val_days - 1).alias("val_start"), end.alias("val_end"))
    return folds.withColumn("train_end", F.date_sub("val_start", gap_days + 1))


def origin_gaps(expected: DataFrame, present: DataFrame, dropped: DataFrame, keys: list[str]) -> DataFrame:
    """Expected origins that are neither there nor reported as dropped."""
    return expected.join(present, keys, "left_anti").join(dropped, keys, "left_anti")


def common_days(losses: DataFrame, day: str = "target_date", keys: tuple[str, ...] = ("zone",)) -> DataFrame:
    """Days that all models of a zone have."""
    models = losses.groupBy(*keys).agg(F.count_distinct("model").alias("_k"))
    per_day = losses.groupBy(*keys, day).agg(F.count_distinct("model").alias("n_models"))
    return per_day.join(models, list(keys)).where("n_models = _k").drop("_k")


def pending_origins(origins: DataFrame, served: DataFrame, until: str, keys: list[str], day: str = "origin_date") -> DataFrame:
    """Origins after the last served one, up to ``until``, in order."""
    last = served.groupBy(*keys).agg(F.max(day).alias("_last"))
    rows = origins.join(last, keys, "left").where((F.col("_last").isNull() | (F.col(day) > F.col("_last"))) & (F.col(day) <= until)).drop("_last")
    return rows.withColumn("position", F.row_number().over(Window.partitionBy(*keys).orderBy(day)))
