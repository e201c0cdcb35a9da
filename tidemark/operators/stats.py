"""Uncertainty of mean losses and comparison of models."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.backtest import common_days
from tidemark.sources.scratch import stored

MODULUS = 2147483647
MULTIPLIER = 48271


def indexed(losses: DataFrame, keys: list[str], day: str) -> DataFrame:
    """Adds the day's position (from 0) in its series and the length of the series."""
    return losses.withColumn("pos", F.row_number().over(Window.partitionBy(*keys).orderBy(day)) - 1).withColumn("n", F.count(F.lit(1)).over(Window.partitionBy(*keys)))


def block_bootstrap(losses: DataFrame, col: str, keys: list[str], day: str = "target_date", block: int = 7, resamples: int = 2000, seed: int = 1, level: float = 0.95) -> DataFrame:
    """Mean and percentile interval from a circular bootstrap of blocks of consecutive days.

    A block's mean comes from its prefix sums, so a resample costs one row per block, not one per day. Block
    starts come from a linear congruential rule on (seed, resample, block), the same in every engine.
    """
    rows = indexed(losses, keys, day)
    order = Window.partitionBy(*keys).orderBy("pos")
    whole = Window.partitionBy(*keys)
    sums = rows.select(*keys, "pos", "n", F.sum(col).over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("upto"), F.sum(col).over(whole).alias("total"), F.col(col).alias("x"))
    length = F.least(F.lit(block), F.col("n"))
    series = sums.groupBy(*keys, "n", "total").agg(F.lit(1).alias("_one")).drop("_one").withColumn("length", length)
    blocks = series.withColumn("blocks", F.ceil(F.col("n") / F.col("length")).cast("int"))
    draws = blocks.withColumn("resample", F.explode(F.sequence(F.lit(0), F.lit(resamples - 1)))).withColumn("block", F.explode(F.expr("sequence(0, blocks - 1)")))
    draw = F.pmod(F.pmod(F.lit(seed).cast("long") * 1000003 + F.col("resample").cast("long") * 7919 + F.col("block").cast("long") * 104729 + 12345, F.lit(MODULUS)) * MULTIPLIER, F.lit(MODULUS))
    draw = F.pmod(draw * MULTIPLIER, F.lit(MODULUS))
    start = F.floor(draw * F.col("n") / F.lit(float(MODULUS))).cast("int")
    # The last block is cut so that a resample has n days.
    draws = draws.withColumn("start", start).withColumn("take", F.least(F.col("length"), F.col("n") - F.col("block") * F.col("length")).cast("int")).withColumn("stop", (F.col("start") + F.col("take")).cast("int"))
    first = sums.select(*keys, F.col("pos").alias("start"), (F.col("upto") - F.col("x")).alias("_before"))
    last = sums.select(*keys, F.col("pos").alias("_last"), F.col("upto").alias("_upto"))
    placed = draws.withColumn("_last", F.expr("cast(pmod(stop - 1, n) as int)")).join(first, [*keys, "start"]).join(last, [*keys, "_last"])
    part = F.col("_upto") - F.col("_before") + F.when(F.col("stop") > F.col("n"), F.col("total")).otherwise(0.0)
    means = placed.groupBy(*keys, "resample").agg((F.sum(part) / F.first("n")).alias("mean"))
    alpha = (1 - level) / 2
    spread = means.groupBy(*keys).agg(F.percentile("mean", F.lit(alpha)).alias("low"), F.percentile("mean", F.lit(1 - alpha)).alias("high"))
    return series.select(*keys, "n", (F.col("total") / F.col("n")).alias("mean")).join(spread, keys)


@F.pandas_udf(T.DoubleType())
def student_p(stat: pd.Series, df: pd.Series) -> pd.Series:
    """Two-sided p-value of Student's t (continued fraction of the incomplete beta function); a few rows per call."""

    def fraction(a: float, b: float, x: float) -> float:
        c, d = 1.0, 1 - (a + b) * x / (a + 1)
        d = 1 / (d or 1e-300)
        h = d
        for m in range(1, 300):
            for num in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
                d = 1 / ((1 + num * d) or 1e-300)
                c = (1 + num / c) or 1e-300
                h *= d * c
            if abs(d * c - 1) < 1e-14:
                break
        return h

    def p(t: float, n: float) -> float:
        if t is None or math.isnan(t):
            return float("nan")
        x, a, b = n / (n + t * t), n / 2, 0.5
        if x >= 1:
            return 1.0
        front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
        return front * fraction(a, b, x) / a if x < (a + 1) / (a + b + 2) else 1 - front * fraction(b, a, 1 - x) / b

    return pd.Series([p(t, n) for t, n in zip(stat, df)])


def diebold_mariano(pairs: DataFrame, keys: list[str], day: str = "target_date", horizon: int = 1) -> DataFrame:
    """Test of equal loss of ``loss_a`` and ``loss_b`` with the small-sample correction.

    Autocovariances up to ``horizon - 1`` days; null statistic where the variance isn't positive; series of
    fewer than three days are left out.
    """
    of_key = Window.partitionBy(*keys)
    d = pairs.withColumn("d", F.col("loss_a") - F.col("loss_b"))
    d = d.withColumn("c", F.col("d") - F.avg("d").over(of_key))
    lags = [F.coalesce(F.col("c") * F.lag("c", k).over(of_key.orderBy(day)), F.lit(0.0)) for k in range(1, horizon)]
    d = d.withColumn("v", F.col("c") * F.col("c") + 2 * sum(lags, F.lit(0.0)))
    out = d.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.avg("d").alias("mean_diff"), (F.sum("v") / F.count(F.lit(1))).alias("_var")).where("n >= 3")
    n, h = F.col("n"), horizon
    stat = F.when(F.col("_var") > 1e-18, F.col("mean_diff") / F.sqrt(F.col("_var") / n) * F.sqrt((n + 1 - 2 * h + h * (h - 1) / n) / n))
    return out.withColumn("statistic", stat).drop("_var")


def with_p_value(tests: DataFrame) -> DataFrame:
    return tests.withColumn("p_value", F.when(F.col("statistic").isNotNull(), student_p("statistic", (F.col("n") - 1).cast("double"))))


def compare_models(losses: DataFrame, reference: str, block: int = 7, resamples: int = 2000, seed: int = 1, horizon: int = 1) -> DataFrame:
    """Per zone and model on the days that all models have: mean loss with interval, difference from the
    reference with interval, Diebold-Mariano statistic and skill.

    The daily losses and those of the common days are stored once, as every part of the comparison reads them.
    """
    losses = stored(losses, "losses")
    rows = stored(losses.join(common_days(losses).select("zone", "target_date"), ["zone", "target_date"]), "common-losses")
    means = block_bootstrap(rows, "pinball", ["zone", "model"], block=block, resamples=resamples, seed=seed)
    base = rows.where(F.col("model") == reference).select("zone", "target_date", F.col("pinball").alias("loss_b"))
    pairs = rows.where(F.col("model") != reference).join(base, ["zone", "target_date"]).withColumnRenamed("pinball", "loss_a").withColumn("diff", F.col("loss_a") - F.col("loss_b"))
    diffs = block_bootstrap(pairs, "diff", ["zone", "model"], block=block, resamples=resamples, seed=seed).select("zone", "model", F.col("mean").alias("diff"), F.col("low").alias("diff_low"), F.col("high").alias("diff_high"))
    tests = diebold_mariano(pairs, ["zone", "model"], horizon=horizon).select("zone", "model", "statistic")
    ref = means.where(F.col("model") == reference).select("zone", F.col("mean").alias("_ref"))
    out = means.join(diffs, ["zone", "model"], "left").join(tests, ["zone", "model"], "left").join(ref, "zone")
    return out.withColumn("skill", 1 - F.try_divide("mean", "_ref")).drop("_ref").orderBy("zone", "mean")
