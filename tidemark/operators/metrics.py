"""Scores of quantile forecasts: one aggregation per table, whatever the slices."""

from __future__ import annotations

from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tidemark.functions.timeutils import TZ, local, quantile_label, season
from tidemark.operators.forecast import pinball


def metric_columns(qs: tuple[float, ...]) -> list[Column]:
    """n, MAE, RMSE, bias, sMAPE (denominator at least 1), pinball per level and mean, CRPS as twice that, coverage and width of 80 and 90 %."""
    y, m = F.col("y"), F.col("q50")
    losses = {q: pinball(y, F.col(quantile_label(q)), q) for q in qs}
    mean = sum(losses.values(), F.lit(0.0)) / len(qs)
    out = [
        F.count("y").alias("n"),
        F.avg(F.abs(m - y)).alias("mae"),
        F.sqrt(F.avg((m - y) * (m - y))).alias("rmse"),
        F.avg(m - y).alias("bias"),
        F.avg(F.abs(m - y) / F.greatest((F.abs(m) + F.abs(y)) / 2, F.lit(1.0))).alias("smape"),
        *[F.avg(x).alias(f"pinball_{quantile_label(q)}") for q, x in losses.items()],
        F.avg(mean).alias("pinball_mean"),
        (2 * F.avg(mean)).alias("crps_approx"),
    ]
    for name, low, high in (("80", "q10", "q90"), ("90", "q05", "q95")):
        out += [F.avg(((y >= F.col(low)) & (y <= F.col(high))).cast("double")).alias(f"coverage_{name}"), F.avg(F.when(y.isNotNull(), F.col(high) - F.col(low))).alias(f"width_{name}")]
    return out


def forecast_metrics(fc: DataFrame, qs: tuple[float, ...], by: list[str]) -> DataFrame:
    return fc.where(F.col("y").isNotNull()).groupBy(*by).agg(*metric_columns(qs))


def daily_losses(fc: DataFrame, qs: tuple[float, ...], by: tuple[str, ...] = ("model", "zone")) -> DataFrame:
    mean = sum((pinball(F.col("y"), F.col(quantile_label(q)), q) for q in qs), F.lit(0.0)) / len(qs)
    return fc.where(F.col("y").isNotNull()).groupBy(*by, "target_date").agg(F.avg(mean).alias("pinball"), F.avg(F.abs(F.col("y") - F.col("q50"))).alias("ae"))


def spike_days(fc: DataFrame, q: float = 0.95, by: tuple[str, ...] = ("model", "zone")) -> DataFrame:
    """Mean per target day and whether it reaches the exact quantile of the day means."""
    days = fc.groupBy(*by, "target_date").agg(F.avg("y").alias("day_mean"))
    limit = days.groupBy(*by).agg(F.percentile("day_mean", F.lit(q)).alias("threshold"))
    return days.join(limit, list(by)).withColumn("is_spike", F.col("day_mean") >= F.col("threshold"))


def slice_metrics(fc: DataFrame, qs: tuple[float, ...], tz: str = TZ, by: tuple[str, ...] = ("model", "zone")) -> DataFrame:
    """All metrics by hour, day type, season, spike day and sign, in one pass with grouping sets."""
    at = local("target_time", tz)
    spikes = spike_days(fc, by=by).select(*by, "target_date", F.when(F.col("is_spike"), "spike").otherwise("normal").alias("spike_day"))
    rows = fc.where(F.col("y").isNotNull()).join(spikes, [*by, "target_date"]).select(
        *fc.columns,
        F.hour(at).cast("string").alias("hour"),
        F.when(F.weekday(at) >= 5, "weekend").otherwise("weekday").alias("daytype"),
        season(at).alias("season"),
        "spike_day",
        F.when(F.col("y") < 0, "negative").otherwise("non_negative").alias("negative"),
    )
    names = ["hour", "daytype", "season", "spike_day", "negative"]
    out = rows.groupingSets([[F.col(b) for b in by] + [F.col(n)] for n in names], *[F.col(c) for c in [*by, *names]]).agg(*metric_columns(qs))
    kind = F.coalesce(*[F.when(F.col(n).isNotNull(), F.lit(n)) for n in names])
    return out.select(*by, kind.alias("slice"), F.coalesce(*names).alias("group"), *[c for c in out.columns if c not in (*by, *names)])


def reliability(fc: DataFrame, columns: list[str], by: tuple[str, ...] = ("model", "zone")) -> DataFrame:
    """Share of actuals at or below each quantile."""
    wide = fc.where(F.col("y").isNotNull()).groupBy(*by).agg(*[F.avg((F.col("y") <= F.col(c)).cast("double")).alias(c) for c in columns])
    return wide.unpivot(list(by), columns, "quantile", "observed")


def importance_groups(importance: DataFrame, prefixes: dict[str, str], n: int) -> DataFrame:
    """Share of importance by group of feature names (first matching prefix), the largest first."""
    group = F.coalesce(*[F.when(F.col("feature").startswith(p), F.lit(g)) for p, g in prefixes.items()], F.lit("other"))
    sums = importance.groupBy(group.alias("group")).agg(F.sum("importance").alias("importance"))
    return sums.withColumn("share", F.col("importance") / F.sum("importance").over(Window.partitionBy())).orderBy(F.desc("importance"), "group").limit(n)


def rolling_mean(df: DataFrame, col: str, rows: int, keys: list[str], order: str) -> DataFrame:
    """Mean of the last ``rows`` rows; null until there are as many."""
    frame = Window.partitionBy(*keys).orderBy(order).rowsBetween(-(rows - 1), 0)
    return df.withColumn(f"{col}_mean", F.when(F.count(F.lit(1)).over(frame) == rows, F.avg(col).over(frame)))


def running_min(df: DataFrame, col: str, keys: list[str], order: list[str]) -> DataFrame:
    return df.withColumn("best", F.min(col).over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)))


def earlier_quantiles(values: list[float | None], q: float, warmup: int) -> list[float | None]:
    """For each value the quantile of those before it, from ``warmup`` of them on; nulls don't count.

    Two heaps split the values at the quantile's rank, which never moves back: each value costs a logarithm.
    """
    low, high, out = [], [], []  # the lesser ones (negated), and the others
    for v in values:
        n = len(low) + len(high)
        if n < max(1, warmup):
            out.append(None)
        else:
            at = q * (n - 1) - (len(low) - 1)
            out.append(-low[0] + ((high[0] + low[0]) * at if high else 0.0))
        if v is None:
            continue
        if low and v < -low[0]:
            heappush(low, -v)
        else:
            heappush(high, v)
        share = int(q * n) + 1  # of the n + 1 values now, those up to the quantile's rank
        while len(low) < share:
            heappush(low, -heappop(high))
        while len(low) > share:
            heappush(high, -heappop(low))
    return out


def regime_days(daily: DataFrame, score: str, keys: list[str], q: float = 0.9, warmup: int = 28, day: str = "day") -> DataFrame:
    """Days whose score exceeds the quantile of strictly earlier days, after ``warmup`` of them.

    A group is a key's days: one row per calendar day, so its size is bounded by the calendar.
    """
    schema = StructType([*[StructField(f.name, f.dataType) for f in daily.schema], StructField("threshold", DoubleType())])

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by(day)
        scores = rows.column(score).cast(pa.float64()).to_pylist()
        return rows.append_column("threshold", pa.array(earlier_quantiles(scores, q, warmup), pa.float64()))

    return daily.groupBy(*keys).applyInArrow(run, schema).withColumn("is_regime", F.coalesce(F.col(score) > F.col("threshold"), F.lit(False)))


def day_over_day_change(daily: DataFrame, col: str, keys: list[str], day: str = "day") -> DataFrame:
    return daily.withColumn("change", F.abs(F.col(col) - F.lag(col).over(Window.partitionBy(*keys).orderBy(day))))
