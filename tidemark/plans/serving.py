"""Serving, scoring and monitoring queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import lake
from tidemark.operators import serving as op
from tidemark.plans.feeds import CLOCK_CHANGES, PULLS_SQL, QCOLS, QS, forecasts, forecasts_sql, keyed, ntz, pulls, r6
from tidemark.plans.features import at_local
from tidemark.plans.forecasts import loss_sql
from tidemark.plans.lake import MANIFEST_SQL
from tidemark.plans.registry import query

TODAY = "2024-04-13"
ROLES = {"naive_1d": "champion", "naive_7d": "challenger"}


def served(spark, sf_dir):
    """The two models as champion and challenger, with actual and naive prices."""
    fc = forecasts(spark, sf_dir).withColumn("role", F.when(F.col("model") == "naive_1d", "champion").otherwise("challenger")).drop("y", "model")
    return op.enrich_actual_naive(fc, keyed(spark, sf_dir))


SERVED_SQL = f"""srv as (select fc.zone, case when model = 'naive_1d' then 'champion' else 'challenger' end as role, fc.origin_date, fc.target_time, fc.target_date, {', '.join('fc.' + c for c in QCOLS)}, fc.y as actual, b.price as naive_7d
  from fc left join keyed b on b.zone = fc.zone and b.local_date = fc.target_date - 7 and b.local_hour = fc.local_hour and b.occurrence = 1)"""
OWN = "(" + " + ".join(loss_sql(q, c, "actual") for q, c in zip(QS, QCOLS)) + f") / {len(QS)}"
BASE = "(" + " + ".join(loss_sql(q, "naive_7d", "actual") for q in QS) + f") / {len(QS)}"


def skill_sql(by: str, source: str) -> str:
    return f"""select {by}, count(*) as n_hours, avg({OWN}) as pinball, avg(case when naive_7d is not null then {BASE} end) as naive_7d_pinball,
      1 - avg(case when naive_7d is not null then {OWN} end) / nullif(avg(case when naive_7d is not null then {BASE} end), 0) as skill,
      avg(case when actual >= q25 and actual <= q75 then 1.0 else 0.0 end) as coverage_50, avg(case when actual >= q05 and actual <= q95 then 1.0 else 0.0 end) as coverage_90, avg(abs(q50 - actual)) as mae_median
      from {source} where actual is not null and q05 is not null group by {by}"""


MEASURES = ("pinball", "naive_7d_pinball", "skill", "coverage_50", "coverage_90", "mae_median")
ROUNDED = ", ".join(f"round({c}, 6) as {c}" for c in MEASURES)


def scored(df, *by):
    return df.select(*by, "n_hours", *[r6(c).alias(c) for c in MEASURES])


@query("enrich_actual_naive", f"with {forecasts_sql()}, {SERVED_SQL} select zone, role, target_time, round(q50, 6) as q50, round(actual, 6) as actual, round(naive_7d, 6) as naive_7d from srv")
def enrich_actual_naive(spark, sf_dir):
    return served(spark, sf_dir).select("zone", "role", ntz("target_time").alias("target_time"), r6("q50").alias("q50"), r6("actual").alias("actual"), r6("naive_7d").alias("naive_7d"))


@query("paired_skill", f"with {forecasts_sql()}, {SERVED_SQL}, k as ({skill_sql('zone, role', 'srv')}) select zone, role, n_hours, {ROUNDED} from k")
def paired_skill(spark, sf_dir):
    return scored(op.paired_skill(served(spark, sf_dir), QS, ["zone", "role"]), "zone", "role")


DAILY_SQL = f"""good as (select zone, role, origin_date from srv group by 1, 2, 3 having count(*) = 24 and count(distinct target_time) = 24 and bool_and(actual is not null)),
dsc as ({skill_sql('zone, role, origin_date', 'srv join good using (zone, role, origin_date)')})"""


@query("daily_score", f"with {forecasts_sql()}, {SERVED_SQL}, {DAILY_SQL} select zone, role, origin_date, n_hours, {ROUNDED} from dsc")
def daily_score(spark, sf_dir):
    return scored(op.daily_score(served(spark, sf_dir), QS), "zone", "role", "origin_date")


def changes_sql(columns: str, ctes: str, source: str) -> str:
    """A query over the forecasts around both changes of clocks."""
    parts = [f"select {columns} from (with {forecasts_sql(shift=shift, split=split)}, {CHANGED_SQL}{ctes} select * from {source})" for shift, split in CLOCK_CHANGES]
    return " union all ".join(parts)


HOURS_OF = f"cast((epoch({at_local('{d} + 1', 0)}) - epoch({at_local('{d}', 0)})) / 3600 as integer)"
# With the price of the same clock hour a week before, of two the one with the same offset from UTC, that is just a week before.
CHANGED_SQL = SERVED_SQL.replace("b.price as naive_7d", "coalesce(same.price, b.price) as naive_7d").replace("left join keyed b on", "left join keyed same on same.zone = fc.zone and same.timestamp = fc.target_time - interval 7 day and same.local_hour = fc.local_hour left join keyed b on")
GOOD_SQL = f""", good as (select zone, role, origin_date from srv group by 1, 2, 3 having count(*) = {HOURS_OF.format(d='(origin_date + 1)')} and count(distinct target_time) = count(*) and bool_and(actual is not null)),
dsc as ({skill_sql('zone, role, origin_date', 'srv join good using (zone, role, origin_date)')})"""
SUMMARY_SQL = f""", sm as (select zone, role, target_date, count(*) as n_hours, avg(q50) as mean_median, arg_max(target_time, {{'v': q50, 't': target_time}}) as peak_time, avg(q95 - q05) as width_90,
  case when count(actual) = {HOURS_OF.format(d='target_date')} then avg(actual) end as actual_mean from srv group by 1, 2, 3)"""


def around_changes(spark, sf_dir, build):
    from functools import reduce

    parts = []
    for shift, split in CLOCK_CHANGES:
        fc = forecasts(spark, sf_dir, shift=shift, split=split).withColumn("role", F.when(F.col("model") == "naive_1d", "champion").otherwise("challenger")).drop("y", "model")
        parts.append(build(op.enrich_actual_naive(fc, keyed(spark, sf_dir, shift))))
    return reduce(lambda a, b: a.unionByName(b), parts)


@query("daily_score_clock_changes", changes_sql(f"zone, role, origin_date, n_hours, {ROUNDED}", GOOD_SQL, "dsc"))
def daily_score_clock_changes(spark, sf_dir):
    """Scores of whole days around both changes of clocks: those days count with 23 and 25 hours."""
    return scored(around_changes(spark, sf_dir, lambda rows: op.daily_score(rows, QS)), "zone", "role", "origin_date")


@query("day_summary_clock_changes", changes_sql("zone, role, target_date, n_hours, round(mean_median, 6) as mean_median, peak_time, round(width_90, 6) as width_90, round(actual_mean, 6) as actual_mean", SUMMARY_SQL, "sm"))
def day_summary_clock_changes(spark, sf_dir):
    out = around_changes(spark, sf_dir, lambda rows: op.day_summary(rows.withColumnRenamed("actual", "y"), ("zone", "role")))
    return out.select("zone", "role", "target_date", "n_hours", r6("mean_median").alias("mean_median"), ntz("peak_time").alias("peak_time"), r6("width_90").alias("width_90"), r6("actual_mean").alias("actual_mean"))


ALL_SQL = f"osc as ({skill_sql('zone, role, origin_date', 'srv')})"


@query(
    "incremental_scoring",
    f"""with {forecasts_sql()}, {SERVED_SQL}, {ALL_SQL}, ex as (select * from osc where origin_date <= date '2024-04-08' and day(origin_date) % 2 = 0),
    nw as (select * from osc o where origin_date > date '{TODAY}' - 7 and origin_date <= date '{TODAY}' and not exists (select 1 from ex where ex.zone = o.zone and ex.role = o.role and ex.origin_date = o.origin_date))
    select zone, role, origin_date, n_hours, {ROUNDED} from (select * from ex union all select * from nw)""",
)
def incremental_scoring(spark, sf_dir):
    scores = op.paired_skill(served(spark, sf_dir), QS, ["zone", "role", "origin_date"])
    existing = scores.where("origin_date <= '2024-04-08' and dayofmonth(origin_date) % 2 = 0")
    return scored(op.incremental_scoring(scores, existing, TODAY, 7), "zone", "role", "origin_date")


@query(
    "performance_window",
    f"""with {forecasts_sql()}, {SERVED_SQL} select zone, role, origin_date, count(*) as n_hours, count(distinct target_date) as n_days, round(avg({OWN}), 6) as pinball, round(avg(abs(q50 - actual)), 6) as mae,
    origin_date is null and count(distinct target_date) < 7 as few_days from srv where origin_date > date '{TODAY}' - 5 and origin_date <= date '{TODAY}' and actual is not null group by grouping sets ((zone, role), (zone, role, origin_date))""",
)
def performance_window(spark, sf_dir):
    out = op.performance_window(served(spark, sf_dir), QS, 5, TODAY)
    return out.select("zone", "role", "origin_date", "n_hours", "n_days", r6("pinball").alias("pinball"), r6("mae").alias("mae"), "few_days")


@query(
    "quality_windows",
    f"""with {forecasts_sql()}, {SERVED_SQL}, w as (select srv.*, w.window_days from srv, (values (3), (7)) w(window_days) where origin_date <= date '{TODAY}' and origin_date > date '{TODAY}' - window_days), k as ({skill_sql('zone, role, window_days', 'w')}),
    d as (select zone, role, window_days, count(distinct target_date) as scored_days from w where actual is not null group by 1, 2, 3) select zone, role, window_days, n_hours, {ROUNDED}, scored_days from k join d using (zone, role, window_days)""",
)
def quality_windows(spark, sf_dir):
    out = op.quality_windows(served(spark, sf_dir), QS, [3, 7], TODAY)
    return out.select("zone", "role", "window_days", "n_hours", *[r6(c).alias(c) for c in MEASURES], "scored_days")


@query(
    "forecast_view",
    f"with {forecasts_sql()}, {SERVED_SQL} select zone, role, target_time, timezone('Europe/Stockholm', timezone('UTC', target_time)) as local_time, round(q05, 6) as q05, round(q50, 6) as q50, round(q95, 6) as q95, round(actual, 6) as actual, round(naive_7d, 6) as naive_7d from srv where target_date = date '2024-04-12'",
)
def forecast_view(spark, sf_dir):
    from tidemark.functions.timeutils import local

    rows = served(spark, sf_dir).where("target_date = '2024-04-12'")
    return rows.select("zone", "role", ntz("target_time").alias("target_time"), ntz(local("target_time")).alias("local_time"), *[r6(c).alias(c) for c in ("q05", "q50", "q95", "actual", "naive_7d")])


@query(
    "zone_summary",
    f"""with {forecasts_sql()}, {SERVED_SQL}, m as (select zone, role, max(origin_date) as o from srv where zone <> 'view' or origin_date < date '2024-04-10' group by 1, 2)
    select m.zone, m.role, m.o as origin_date, count(*) as n_hours, round(avg(q50), 6) as mean_median, round(max(q95), 6) as top, m.o < date '{TODAY}' as is_stale from m join srv on srv.zone = m.zone and srv.role = m.role and srv.origin_date = m.o group by 1, 2, 3, 7""",
)
def zone_summary(spark, sf_dir):
    rows = served(spark, sf_dir).where("zone <> 'view' or origin_date < '2024-04-10'")
    return op.zone_summary(rows, TODAY).select("zone", "role", "origin_date", "n_hours", r6("mean_median").alias("mean_median"), r6("top").alias("top"), "is_stale")


NOW = "2001-11-01 00:00:00"


def freshness(spark, sf_dir):
    rows = pulls(spark, sf_dir).withColumn("snapshot", F.concat((F.col("part") % 7).cast("string"), F.lit("-"), F.col("snapshot")))
    manifest = lake.manifest_of(rows).withColumn("source", F.substring("snapshot", 1, 1))
    return op.raw_freshness(manifest, NOW, ["source"])


FRESH_SQL = f"""tagged as (select (part % 7) || '-' || snapshot as snapshot, pulled_at, part, valid from pulls), {MANIFEST_SQL.replace('from pulls', 'from tagged')},
fresh as (select left(snapshot, 1) as source, max(pulled_at) as last_pull, max(case when passed then pulled_at end) as last_valid_pull, arg_max(passed, {{'p': pulled_at, 's': snapshot}}) as newest_passed from manifest group by 1),
fr as (select *, (epoch(timestamp '{NOW}') - epoch(last_valid_pull)) / 3600 as age_h from fresh)"""


@query("raw_freshness", f"with {PULLS_SQL}, {FRESH_SQL} select source, last_pull, last_valid_pull, newest_passed, round(age_h, 6) as age_h from fr")
def raw_freshness(spark, sf_dir):
    return freshness(spark, sf_dir).select("source", ntz("last_pull").alias("last_pull"), ntz("last_valid_pull").alias("last_valid_pull"), "newest_passed", r6("age_h").alias("age_h"))


LEVELS = {"click": 6.0, "view": 9.0, "error": 30.0, "signup": 5.0, "purchase": 8.0}


@query(
    "data_alerts",
    f"""with {forecasts_sql()}, {SERVED_SQL}, {ALL_SQL}, {PULLS_SQL}, {FRESH_SQL}, f as (select * from srv where zone not in ('view', 'error') or origin_date < date '2024-04-10'),
    nw as (select zone, max(origin_date) as o, count(*) filter (where origin_date = date '{TODAY}') as n from f where role = 'champion' group by 1), ch as (select * from osc where role = 'champion' and (zone <> 'error' or origin_date < date '2024-04-10')),
    lv(zone, l) as (values {', '.join(f"('{z}', {v}::double)" for z, v in LEVELS.items())}),
    rc as (select zone, avg(pinball) as p, count(*) as d from ch where origin_date > date '{TODAY}' - 14 group by 1), ls as (select zone, max(origin_date) as o from ch group by 1),
    al as (select 'forecast_missing' as alert, zone as subject, cast(date '{TODAY}' - o as double) as v from nw where n = 0 union all select 'forecast_incomplete', zone, n from nw where n > 0 and n < 23
      union all select 'drift', zone, p / l from rc join lv using (zone) where d >= 7 and p > 1.3 * l union all select 'score_stale', zone, date '{TODAY}' - o from ls where date '{TODAY}' - o > 3
      union all select 'raw_stale', source, age_h from fr where age_h > 30 union all select 'newest_pull_invalid', source, 1 from fr where not newest_passed)
    select alert, subject, round(v, 6) as value from al""",
)
def data_alerts(spark, sf_dir):
    rows = served(spark, sf_dir)
    scores = op.paired_skill(rows, QS, ["zone", "role", "origin_date"]).where("role = 'champion' and (zone <> 'error' or origin_date < '2024-04-10')")
    live = rows.where("role = 'champion' and (zone not in ('view', 'error') or origin_date < '2024-04-10')")
    return op.data_alerts(live, scores, freshness(spark, sf_dir), TODAY, LEVELS, "source").withColumn("value", r6("value"))


@query(
    "champion_challenger",
    f"""with {forecasts_sql()}, {SERVED_SQL}, {ALL_SQL} select a.zone, count(*) as n_days, round(sum(b.pinball) / sum(a.pinball) - 1, 6) as ratio from osc a join osc b on a.role = 'champion' and b.role = 'challenger' and a.zone = b.zone and a.origin_date = b.origin_date group by 1""",
)
def champion_challenger(spark, sf_dir):
    scores = op.paired_skill(served(spark, sf_dir), QS, ["zone", "role", "origin_date"])
    return op.champion_challenger(scores, "champion", "challenger").withColumn("ratio", r6("ratio"))


