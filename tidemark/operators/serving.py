"""Daily serving, scoring and monitoring tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.timeutils import TZ, daypart, hours_in_local_day, local, quantile_label
from tidemark.operators.backtest import common_days
from tidemark.operators.forecast import pinball


def daypart_bias(fc: DataFrame, tz: str = TZ, by: tuple[str, ...] = ("model", "zone")) -> DataFrame:
    """Bias of the median by part of the day, the part with the largest one, counts outside the 90 % interval."""
    part = daypart(F.hour(local("target_time", tz)))
    rows = fc.where(F.col("y").isNotNull()).groupBy(*by, part.alias("part")).agg(
        F.avg(F.col("q50") - F.col("y")).alias("bias"), F.count(F.lit(1)).alias("hours"), F.count_if(F.col("y") > F.col("q95")).alias("above_q95"), F.count_if(F.col("y") < F.col("q05")).alias("below_q05")
    )
    largest = F.max_by("part", F.abs("bias")).over(Window.partitionBy(*by))
    return rows.withColumn("is_largest", F.col("part") == largest)


def day_summary(fc: DataFrame, by: tuple[str, ...] = ("model", "zone"), tz: str = TZ) -> DataFrame:
    """Mean median, peak and trough hour, mean 90 % width, and the actual mean only of complete days."""
    complete = F.count("y") == F.first(hours_in_local_day(F.col("target_date"), tz))
    return fc.groupBy(*by, "target_date").agg(
        F.count(F.lit(1)).alias("n_hours"),
        F.avg("q50").alias("mean_median"),
        F.max_by("target_time", F.struct("q50", "target_time")).alias("peak_time"),
        F.min_by("target_time", F.struct("q50", "target_time")).alias("trough_time"),
        F.avg(F.col("q95") - F.col("q05")).alias("width_90"),
        F.when(complete, F.avg("y")).alias("actual_mean"),
    )


def enrich_actual_naive(fc: DataFrame, keyed: DataFrame) -> DataFrame:
    """Adds the actual of the same hour and the price of the same clock hour a week before.

    Of two occurrences of the clock hour, the one with the target's UTC offset is preferred, then the first.
    """
    actual = keyed.select("zone", F.col("timestamp").alias("target_time"), F.col("price").alias("actual"), F.col("local_date").alias("_d"), F.col("local_hour").alias("_h"))
    at = local("target_time")
    rows = fc.withColumn("_d", F.to_date(at)).withColumn("_h", F.hour(at)).withColumn("_o", F.unix_timestamp(at) - F.unix_timestamp("target_time"))
    rows = rows.join(actual.drop("_d", "_h"), ["zone", "target_time"], "left")
    past = keyed.select("zone", F.date_add("local_date", 7).alias("_d"), F.col("local_hour").alias("_h"), (F.unix_timestamp(local("timestamp")) - F.unix_timestamp("timestamp")).alias("_po"), "occurrence", F.col("price").alias("naive_7d"))
    best = past.groupBy("zone", "_d", "_h").agg(F.map_from_entries(F.collect_list(F.struct("_po", "naive_7d"))).alias("_by"), F.min_by("naive_7d", "occurrence").alias("_first"))  # at most two occurrences
    out = rows.join(best, ["zone", "_d", "_h"], "left")
    return out.withColumn("naive_7d", F.coalesce(F.try_element_at("_by", F.col("_o")), "_first")).drop("_by", "_first", "_d", "_h", "_o")


def paired_skill(rows: DataFrame, qs: tuple[float, ...], by: list[str]) -> DataFrame:
    """Pinball on hours with all quantiles and an actual; the naive's and the skill only on hours that have a naive too."""
    columns = [quantile_label(q) for q in qs]
    complete = F.col("actual").isNotNull()
    for c in columns:
        complete = complete & F.col(c).isNotNull()
    own = sum((pinball(F.col("actual"), F.col(c), q) for c, q in zip(columns, qs)), F.lit(0.0)) / len(qs)
    base = sum((pinball(F.col("actual"), F.col("naive_7d"), q) for q in qs), F.lit(0.0)) / len(qs)
    paired = F.col("naive_7d").isNotNull()
    inside = lambda a, b: F.avg(((F.col("actual") >= F.col(a)) & (F.col("actual") <= F.col(b))).cast("double"))
    naive, model = F.avg(F.when(paired, base)), F.avg(F.when(paired, own))
    return rows.where(complete).groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_hours"),
        F.avg(own).alias("pinball"),
        naive.alias("naive_7d_pinball"),
        (1 - F.try_divide(model, naive)).alias("skill"),
        inside("q25", "q75").alias("coverage_50"),
        inside("q05", "q95").alias("coverage_90"),
        F.avg(F.abs(F.col("q50") - F.col("actual"))).alias("mae_median"),
    )


def daily_score(rows: DataFrame, qs: tuple[float, ...], tz: str = TZ) -> DataFrame:
    """Scores of origins whose rows are exactly the hours of the target day, all with quantiles and actuals."""
    columns = [quantile_label(q) for q in qs]
    whole = F.every(F.col("actual").isNotNull())
    for c in columns:
        whole = whole & F.every(F.col(c).isNotNull())
    keys = ["zone", "role", "origin_date"]
    fits = F.every(F.to_date(local("target_time", tz)) == F.date_add("origin_date", 1))
    days = rows.groupBy(*keys).agg(F.count_distinct("target_time").alias("_n"), F.count(F.lit(1)).alias("_rows"), whole.alias("_whole"), fits.alias("_fits"))
    good = days.where((F.col("_n") == hours_in_local_day(F.date_add("origin_date", 1), tz)) & (F.col("_rows") == F.col("_n")) & F.col("_whole") & F.col("_fits"))
    return paired_skill(rows.join(good.select(*keys), keys, "left_semi"), qs, keys)


def incremental_scoring(scores: DataFrame, existing: DataFrame, today: str, days_back: int, force: bool = False) -> DataFrame:
    """The stored scores with those of the last ``days_back`` origins that aren't scored yet (``force``: replaced)."""
    keys = ["zone", "role", "origin_date"]
    recent = scores.where((F.col("origin_date") > F.date_sub(F.lit(today).cast("date"), days_back)) & (F.col("origin_date") <= F.lit(today).cast("date")))
    if force:
        return existing.join(recent.select(*keys), keys, "left_anti").unionByName(recent)
    return existing.unionByName(recent.join(existing.select(*keys), keys, "left_anti"))


def performance_window(rows: DataFrame, qs: tuple[float, ...], days: int, today: str, least: int = 7) -> DataFrame:
    """Pooled and per-origin scores of the last ``days`` origins up to today, in one pass; pooled rows have no origin."""
    columns = [quantile_label(q) for q in qs]
    loss = sum((pinball(F.col("actual"), F.col(c), q) for c, q in zip(columns, qs)), F.lit(0.0)) / len(qs)
    recent = rows.where((F.col("origin_date") > F.date_sub(F.lit(today).cast("date"), days)) & (F.col("origin_date") <= F.lit(today).cast("date")) & F.col("actual").isNotNull())
    sets = [[F.col("zone"), F.col("role")], [F.col("zone"), F.col("role"), F.col("origin_date")]]
    out = recent.groupingSets(sets, F.col("zone"), F.col("role"), F.col("origin_date")).agg(
        F.count(F.lit(1)).alias("n_hours"), F.count_distinct("target_date").alias("n_days"), F.avg(loss).alias("pinball"), F.avg(F.abs(F.col("q50") - F.col("actual"))).alias("mae")
    )
    return out.withColumn("few_days", F.col("origin_date").isNull() & (F.col("n_days") < least))


def quality_windows(rows: DataFrame, qs: tuple[float, ...], windows: list[int], today: str) -> DataFrame:
    """Skill table and number of scored days for several windows at once."""
    sizes = F.array(*[F.when(F.col("origin_date") > F.date_sub(F.lit(today).cast("date"), w), F.lit(w)) for w in windows])
    tall = rows.where(F.col("origin_date") <= F.lit(today).cast("date")).withColumn("window_days", F.explode(F.filter(sizes, lambda x: x.isNotNull())))
    days = tall.where(F.col("actual").isNotNull()).groupBy("zone", "role", "window_days").agg(F.count_distinct("target_date").alias("scored_days"))
    return paired_skill(tall, qs, ["zone", "role", "window_days"]).join(days, ["zone", "role", "window_days"])


def zone_summary(rows: DataFrame, today: str) -> DataFrame:
    """Newest forecast per zone and role, its size and mean, and whether it is older than today's."""
    newest = rows.groupBy("zone", "role").agg(F.max("origin_date").alias("origin_date"))
    out = rows.join(newest, ["zone", "role", "origin_date"]).groupBy("zone", "role", "origin_date").agg(F.count(F.lit(1)).alias("n_hours"), F.avg("q50").alias("mean_median"), F.max("q95").alias("top"))
    return out.withColumn("is_stale", F.col("origin_date") < F.lit(today).cast("date"))


def raw_freshness(manifest: DataFrame, now: str, by: list[str]) -> DataFrame:
    """Latest pull, latest valid pull, validity of the newest pull, and its age in hours."""
    out = manifest.groupBy(*by).agg(F.max("pulled_at").alias("last_pull"), F.max(F.when(F.col("passed"), F.col("pulled_at"))).alias("last_valid_pull"), F.max_by("passed", F.struct("pulled_at", "snapshot")).alias("newest_passed"))
    return out.withColumn("age_h", (F.unix_timestamp(F.lit(now).cast("timestamp")) - F.unix_timestamp("last_valid_pull")) / 3600)


def data_alerts(forecasts: DataFrame, scores: DataFrame, freshness: DataFrame, today: str, levels: dict[str, float], by: str = "zone") -> DataFrame:
    """``alert, subject, value`` of every rule that fires: missing, incomplete and drifting forecasts, stale scores and raw data, invalid pulls.

    Each input is aggregated once, to a row per subject; its rules are tried on that row.
    """
    day = F.lit(today).cast("date")

    def fired(df: DataFrame, subject: Column, rules: dict[str, tuple[Column, Column]]) -> DataFrame:
        found = [F.when(when, F.struct(F.lit(name).alias("alert"), subject.cast("string").alias("subject"), value.cast("double").alias("value"))) for name, (when, value) in rules.items()]
        return df.select(F.inline(F.filter(F.array(*found), lambda x: x.isNotNull())))

    newest = forecasts.groupBy("zone").agg(F.max("origin_date").alias("o"), F.count_if(F.col("origin_date") == day).alias("n"))
    about_forecasts = {"forecast_missing": (F.col("n") == 0, F.datediff(day, "o")), "forecast_incomplete": ((F.col("n") > 0) & (F.col("n") < 23), F.col("n"))}
    level = F.coalesce(*[F.when(F.col("zone") == z, F.lit(v)) for z, v in levels.items()])
    recent = F.when(F.col("origin_date") > F.date_sub(day, 14), F.col("pinball"))
    scored = scores.groupBy("zone").agg(F.max("origin_date").alias("o"), F.avg(recent).alias("p"), F.count_if(F.col("origin_date") > F.date_sub(day, 14)).alias("d"))
    about_scores = {"drift": ((F.col("d") >= 7) & (F.col("p") > 1.3 * level), F.col("p") / level), "score_stale": (F.datediff(day, "o") > 3, F.datediff(day, "o"))}
    about_pulls = {"raw_stale": (F.col("age_h") > 30, F.col("age_h")), "newest_pull_invalid": (~F.col("newest_passed"), F.lit(1.0))}
    parts = [fired(newest, F.col("zone"), about_forecasts), fired(scored, F.col("zone"), about_scores), fired(freshness, F.col(by), about_pulls)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def champion_challenger(scores: DataFrame, champion: str, challenger: str) -> DataFrame:
    """Challenger's loss over the champion's less 1, on origins that both have."""
    wide = scores.where(F.col("role").isin(champion, challenger)).groupBy("zone", "origin_date").pivot("role", [champion, challenger]).agg(F.first("pinball"))
    both = wide.where(F.col(champion).isNotNull() & F.col(challenger).isNotNull())
    return both.groupBy("zone").agg(F.count(F.lit(1)).alias("n_days"), (F.try_divide(F.sum(challenger), F.sum(champion)) - 1).alias("ratio"))


def stored_losses(losses: DataFrame) -> DataFrame:
    """Mean losses of stored runs on their common days.

    A run that is stored twice is refused, and so are runs of a zone on different evaluation datasets (``dataset_version``).
    """
    if "dataset_version" in losses.columns:
        mixed = losses.groupBy("zone").agg(F.min("dataset_version").alias("a"), F.max("dataset_version").alias("b")).where("a <> b").limit(1)
        if not mixed.isEmpty():
            raise ValueError("the runs of a zone mix evaluation datasets")
    twice = losses.groupBy("zone", "model", "target_date").count().where("count > 1").limit(1)
    if not twice.isEmpty():
        raise ValueError("a model has several losses for a day")
    return losses.join(common_days(losses).select("zone", "target_date"), ["zone", "target_date"]).groupBy("zone", "model").agg(F.count(F.lit(1)).alias("n_days"), F.avg("pinball").alias("pinball"))
