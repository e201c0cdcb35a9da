"""Validation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.timeutils import infer_resolution, local_date
from tidemark.operators import quality as op
from tidemark.operators.quality import Rule
from tidemark.plans.feeds import AUTUMN, PULLS_SQL, READINGS_SQL, ZONED_SQL, ev_sql, forecasts, forecasts_sql, hourly, hourly_sql, loc, ntz, pulls, r6, readings, series, zoned_orders
from tidemark.plans.registry import query

RULES = [Rule("temperature", 1, 49.5, 3, 48), Rule("wind", 0, 0.0795, None, 0.075, 0.3), Rule("cloud", 0, 0.2, 0.0, 0.095)]


ROW_NAME = "location || '@' || day"
DIGEST = f"('0x' || substr(md5({ROW_NAME}), 1, 8))::bigint"


def _rules_sql() -> str:
    parts = []
    for r in RULES:
        for name, severity, low, high in (("range", "error", r.low, r.high), ("soft_range", "warning", r.soft_low, r.soft_high)):
            conds = [c for c in (f"{r.column} < {low}" if low is not None else "", f"{r.column} > {high}" if high is not None else "") if c]
            if conds:
                parts.append((r.column, name, severity, " or ".join(conds), "0"))
        parts.append((r.column, "null_fraction", "error", f"{r.column} is null", f"{r.max_null} * any_value(n_zone)"))
    bad = " union all ".join(f"select zone, '{c}' as col, '{n}' as rule, '{s}' as severity, {ROW_NAME} as name, {DIGEST} as h, {limit.replace('any_value(n_zone)', 'n_zone')} as lim from readings join sizes using (zone) where {where}" for c, n, s, where, limit in parts)
    return f"""with {READINGS_SQL}, sizes as (select zone, count(*) as n_zone from readings group by 1), bad as ({bad}),
    counts as (select zone, col, rule, severity, count(*) as n_bad from bad group by all having count(*) > any_value(lim)),
    least as (select zone, col, rule, h % 3 as place, min(h) as h, arg_min(name, {{'h': h, 'n': name}}) as name from bad group by 1, 2, 3, 4),
    names as (select zone, col, rule, string_agg(name, ' ' order by h, name) as examples from least group by 1, 2, 3)
    select zone, col as "column", rule, severity, n_bad, examples from counts join names using (zone, col, rule)"""


@query("range_violations", _rules_sql())
def range_violations(spark, sf_dir):
    name = F.concat_ws("@", F.col("location").cast("string"), F.col("day").cast("string"))
    out = op.range_violations(readings(spark, sf_dir), RULES, ["zone"], name)
    return out.withColumn("examples", F.array_join("examples", " "))


@query("duplicate_timestamps", f"with {PULLS_SQL} select part, pulled_at, count(*) as n from pulls group by 1, 2 having n > 1")
def duplicate_timestamps(spark, sf_dir):
    return op.duplicate_timestamps(pulls(spark, sf_dir), ["part"], "pulled_at").withColumn("pulled_at", ntz("pulled_at"))


@query(
    "not_monotone",
    f"with {PULLS_SQL}, w as (select part, pulled_at, lag(pulled_at) over (partition by part order by seq, price, pulled_at) as before from pulls) select part, count(*) filter (where pulled_at < before) as n_back, count(*) filter (where pulled_at is null) as n_null from w group by 1",
)
def not_monotone(spark, sf_dir):
    return op.not_monotone(pulls(spark, sf_dir), ["part"], ["seq", "price", "pulled_at"], "pulled_at", F.floor(F.col("seq") / 16384))


@query(
    "merge_intervals",
    f"""with {ZONED_SQL}, i as (select zone, day as a, day + cast(n % 4 as integer) as b from zoned where n >= 2),
    w as (select *, max(b) over (partition by zone order by a, b rows between unbounded preceding and 1 preceding) as reach from i),
    g as (select *, sum(case when a <= reach then 0 else 1 end) over (partition by zone order by a, b rows between unbounded preceding and current row) as g from w)
    select zone, min(a) as start_day, max(b) as end_day from g group by zone, g""",
)
def merge_intervals(spark, sf_dir):
    rows = zoned_orders(spark, sf_dir).where("n >= 2").select("zone", F.col("day").alias("start_day"), F.date_add("day", (F.col("n") % 4).cast("int")).alias("end_day"))
    return op.merge_intervals(rows, ["zone"], "start_day", "end_day")


GAPS_SQL = "gaps as (select * from (select zone, lag(timestamp) over (partition by zone order by timestamp) as gap_start, timestamp as gap_end from ev) where epoch_us(gap_end) - epoch_us(gap_start) > {s} * 1e6)"


@query(
    "max_gap_errors",
    f"""with {ev_sql()}, {GAPS_SQL.format(s=5400)}, ex as (select zone, gap_start, gap_end from gaps where minute(gap_start) < 10)
    select zone, gap_start, gap_end, round((epoch_us(gap_end) - epoch_us(gap_start)) / 1e6, 6) as gap_s from gaps g where not exists (select 1 from ex where ex.zone = g.zone and ex.gap_start = g.gap_start and ex.gap_end = g.gap_end)""",
)
def max_gap_errors(spark, sf_dir):
    rows = series(spark, sf_dir)
    excluded = op.max_gap_errors(rows, ["zone"], 5400).where(F.minute("gap_start") < 10).select("zone", "gap_start", "gap_end")
    out = op.max_gap_errors(rows, ["zone"], 5400, excluded)
    return out.select("zone", ntz("gap_start").alias("gap_start"), ntz("gap_end").alias("gap_end"), r6("gap_s").alias("gap_s"))


def mid(day: str) -> str:
    return f"epoch(timezone('UTC', timezone('Europe/Stockholm', cast({day} as timestamp))))"


def day_errors_sql(shift: int) -> str:
    return hourly_sql(shift) + f""", c as (select zone, cast({loc('timestamp')} as date) as day, count(*) as n_rows from hourly group by 1, 2),
    s as (select zone, min(day) as a, max(day) as b from c group by 1),
    g as (select zone, cast(unnest(generate_series(cast(a + 1 as timestamp), cast(b - 1 as timestamp), interval 1 day)) as date) as day from s),
    e as (select g.zone, g.day, coalesce(c.n_rows, 0) as n_rows, case when day(g.day) = 5 then 0 else cast(({mid('g.day + 1')} - {mid('g.day')}) / 3600 as bigint) end as expected from g left join c using (zone, day)),
    day_errors as (select * from e where n_rows <> expected)"""


def day_errors(spark, sf_dir, shift):
    rows = hourly(spark, sf_dir, shift)
    excluded = rows.select("zone", local_date("timestamp").alias("day")).distinct().where(F.dayofmonth("day") == 5)
    return op.day_count_errors(rows, ["zone"], excluded=excluded)


@query("day_count_errors", f"with {day_errors_sql(AUTUMN)} select zone, day, n_rows, expected from day_errors")
def day_count_errors(spark, sf_dir):
    return day_errors(spark, sf_dir, AUTUMN)


MISSING_SQL = """grid as (select zone, unnest(generate_series(a, b, interval 1 hour)) as timestamp from (select zone, min(timestamp) as a, max(timestamp) as b from hourly group by 1)),
missing as (select zone, timestamp from grid g where not exists (select 1 from hourly h where h.zone = g.zone and h.timestamp = g.timestamp and h.price is not null))"""


@query("missing_hours", f"with {hourly_sql()}, {MISSING_SQL} select * from missing")
def missing_hours(spark, sf_dir):
    return op.missing_hours(hourly(spark, sf_dir), ["zone"], value="price").select("zone", ntz("timestamp").alias("timestamp"))


RUNS_SQL = """runs as (select zone, min(timestamp) as run_start, max(timestamp) as run_end, count(*) as n_hours from (
  select *, epoch(timestamp) - row_number() over (partition by zone order by timestamp) * 3600 as g from missing) group by zone, g)"""


@query("gap_runs", f"with {hourly_sql()}, {MISSING_SQL}, {RUNS_SQL} select zone, run_start, run_end, n_hours, cast(row_number() over (partition by zone order by run_start) as integer) as run_no from runs")
def gap_runs(spark, sf_dir):
    out = op.gap_runs(op.missing_hours(hourly(spark, sf_dir), ["zone"], value="price"), ["zone"])
    return out.withColumn("run_start", ntz("run_start")).withColumn("run_end", ntz("run_end"))


@query(
    "gap_summary",
    f"""with {hourly_sql()}, {MISSING_SQL}, {RUNS_SQL}, n as (select *, row_number() over (partition by zone order by run_start) as i from runs)
    select zone, count(*) as n_runs, cast(sum(n_hours) as bigint) as n_hours, string_agg(strftime(run_start, '%Y-%m-%d %H:00') || ' x' || n_hours, '; ' order by i) filter (where i <= 5) as first_runs from n group by 1""",
)
def gap_summary(spark, sf_dir):
    runs = op.gap_runs(op.missing_hours(hourly(spark, sf_dir), ["zone"], value="price"), ["zone"])
    text = F.concat(F.date_format("run_start", "yyyy-MM-dd HH:00"), F.lit(" x"), F.col("n_hours").cast("string"))
    first = F.array_join(F.sort_array(F.collect_list(F.when(F.col("run_no") <= 5, text))), "; ")
    return runs.groupBy("zone").agg(F.count(F.lit(1)).alias("n_runs"), F.sum("n_hours").alias("n_hours"), first.alias("first_runs"))


@query(
    "consecutive_runs",
    f"""with {ZONED_SQL}, d as (select zone, day from zoned where n >= 2), g as (select *, day - cast(row_number() over (partition by zone order by day) as integer) as g from d)
    select zone, min(day) as first_day, max(day) as last_day, count(*) as n_days from g group by zone, g""",
)
def consecutive_runs(spark, sf_dir):
    return op.consecutive_runs(zoned_orders(spark, sf_dir).where("n >= 2").select("zone", "day"), ["zone"])


@query(
    "profile_nulls",
    f"""with {hourly_sql()}, s as (select *, epoch(lead(timestamp) over w) - epoch(timestamp) as ahead, epoch(timestamp) - epoch(lag(timestamp) over w) as back from hourly window w as (partition by zone order by timestamp)),
    l as (select *, case when ahead = 900 or (ahead is distinct from 3600 and back = 900) then 'PT15M' when ahead = 3600 or back = 3600 then 'PT60M' end as resolution from s)
    select zone, count(*) as n_rows, count(*) filter (where price is null) as price_nulls, count(*) filter (where resolution = 'PT15M') as n_pt15m, count(*) filter (where resolution = 'PT60M') as n_pt60m, count(*) filter (where resolution is null) as n_other from l group by 1""",
)
def profile_nulls(spark, sf_dir):
    rows = infer_resolution(hourly(spark, sf_dir), ["zone"])
    return op.profile_nulls(rows, ["zone"], ["price"], "resolution")


@query(
    "validation_report",
    f"""with {day_errors_sql(75)}, {GAPS_SQL.format(s=7200)}, dup as (select zone, timestamp from ev where zone = 'view' group by 1, 2),
    st as (select zone, count(*) as structure_errors from dup group by 1),
    l as (select zone, 'gap ' || strftime(gap_start, '%Y-%m-%d %H:%M') as what from gaps union all select zone, 'day ' || day from day_errors),
    r as (select *, row_number() over (partition by zone order by what) as i from l),
    sm as (select zone, count(*) as other_errors, string_agg(what, '; ' order by what) filter (where i <= 20) as summary from r group by 1)
    select coalesce(st.zone, sm.zone) as zone, coalesce(structure_errors, 0) as structure_errors, case when structure_errors is null then other_errors else 0 end as other_errors, case when structure_errors is null then summary end as summary
    from st full join sm on st.zone = sm.zone""",
)
def validation_report(spark, sf_dir):
    rows = series(spark, sf_dir)
    structure = rows.where("zone = 'view'").select("zone", "timestamp").distinct()
    return op.validation_report(structure, op.max_gap_errors(rows, ["zone"], 7200), day_errors(spark, sf_dir, 75), ["zone"])


@query(
    "time_end_anomalies",
    f"""with {hourly_sql()}, e as (select zone, timestamp, cast({loc('timestamp')} as date) as day, timestamp + interval 1 hour as time_end, lead(timestamp) over (partition by zone, cast({loc('timestamp')} as date) order by timestamp) as next_start from hourly)
    select zone, timestamp, time_end, next_start from e where next_start is not null and time_end <> next_start""",
)
def time_end_anomalies(spark, sf_dir):
    rows = hourly(spark, sf_dir).select("zone", "timestamp", local_date("timestamp").alias("day"), (F.col("timestamp") + F.expr("interval 1 hour")).alias("time_end"))
    out = op.time_end_anomalies(rows, ["zone", "day"], "timestamp", "time_end")
    return out.select("zone", *[ntz(c).alias(c) for c in ("timestamp", "time_end", "next_start")])


@query("null_quantiles", f"with {forecasts_sql()} select model, zone, count(*) as n_rows, count(*) filter (where nullif(round(q05), 0) is null or q95 is null) as n_null from fc group by 1, 2")
def null_quantiles(spark, sf_dir):
    fc = forecasts(spark, sf_dir).withColumn("q05", F.nullif(F.round("q05"), F.lit(0.0)))
    return op.null_quantiles(fc, ["q05", "q95"], ["model", "zone"])
