"""Forecast, metric and comparison queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import backtest as bt
from tidemark.operators import features as ft
from tidemark.operators import forecast as op
from tidemark.operators import lake
from tidemark.operators import metrics as mt
from tidemark.operators import stats as st
from tidemark.plans.feeds import QCOLS, QS, ZONED_SQL, forecasts, forecasts_sql, keyed, loc, ntz, r6, read, zoned_orders
from tidemark.plans.features import dataset_sql
from tidemark.plans.registry import query
from tidemark.sources.scratch import scratch


def loss_sql(q: float, col: str, y: str = "y") -> str:
    return f"greatest(({y} - {col}) * {q}, ({y} - {col}) * ({q} - 1))"


MEAN_LOSS = "(" + " + ".join(loss_sql(q, c) for q, c in zip(QS, QCOLS)) + f") / {len(QS)}"


def metrics_sql() -> list[tuple[str, str]]:
    out = [("mae", "avg(abs(q50 - y))"), ("rmse", "sqrt(avg((q50 - y) * (q50 - y)))"), ("bias", "avg(q50 - y)"), ("smape", "avg(abs(q50 - y) / greatest((abs(q50) + abs(y)) / 2, 1.0))")]
    out += [(f"pinball_{c}", f"avg({loss_sql(q, c)})") for q, c in zip(QS, QCOLS)]
    out += [("pinball_mean", f"avg({MEAN_LOSS})"), ("crps_approx", f"2 * avg({MEAN_LOSS})")]
    for n, a, b in (("80", "q10", "q90"), ("90", "q05", "q95")):
        out += [(f"coverage_{n}", f"avg(case when y >= {a} and y <= {b} then 1.0 else 0.0 end)"), (f"width_{n}", f"avg({b} - {a})")]
    return out


def pick_sql(names: list[str] | None = None) -> str:
    return ", ".join(f"round({e}, 6) as {n}" for n, e in metrics_sql() if not names or n in names)


def pick(df, by: list[str], names: list[str] | None = None):
    return df.select(*by, "n", *[r6(n).alias(n) for n, _ in metrics_sql() if not names or n in names])


@query("flagship", f"with {forecasts_sql()} select model, zone, count(*) as n_hours, round(avg({MEAN_LOSS}), 6) as pinball from fc group by 1, 2")
def flagship(spark, sf_dir):
    """Hourly aggregation, lags by local hour, seasonal-naive quantiles, pinball loss per zone."""
    return mt.forecast_metrics(forecasts(spark, sf_dir), QS, ["model", "zone"]).select("model", "zone", F.col("n").alias("n_hours"), r6("pinball_mean").alias("pinball"))


@query("pinball", f"with {forecasts_sql()} select model, zone, target_time, {', '.join(f'round({loss_sql(q, c)}, 6) as l_{c}' for q, c in zip(QS, QCOLS))} from fc")
def pinball(spark, sf_dir):
    fc = forecasts(spark, sf_dir)
    return fc.select("model", "zone", ntz("target_time").alias("target_time"), *[r6(op.pinball(F.col("y"), F.col(c), q)).alias(f"l_{c}") for q, c in zip(QS, QCOLS)])


def _metrics(name: str, columns: list[str] | None):
    @query(name, f"with {forecasts_sql()} select model, zone, count(y) as n, {pick_sql(columns)} from fc group by 1, 2")
    def build(spark, sf_dir):
        return pick(mt.forecast_metrics(forecasts(spark, sf_dir), QS, ["model", "zone"]), ["model", "zone"], columns)

    return build


_metrics("forecast_metrics", None)
_metrics("point_metrics", ["mae", "rmse", "bias", "smape"])
_metrics("interval_metrics", ["coverage_80", "width_80", "coverage_90", "width_90"])

LOSSES_SQL = f"losses as (select model, zone, target_date, avg({MEAN_LOSS}) as pinball, avg(abs(y - q50)) as ae from fc where y is not null group by 1, 2, 3)"


@query("daily_losses", f"with {forecasts_sql()}, {LOSSES_SQL} select model, zone, target_date, round(pinball, 6) as pinball, round(ae, 6) as ae from losses")
def daily_losses(spark, sf_dir):
    return mt.daily_losses(forecasts(spark, sf_dir), QS).select("model", "zone", "target_date", r6("pinball").alias("pinball"), r6("ae").alias("ae"))


SPIKE_SQL = """dm as (select model, zone, target_date, avg(y) as day_mean from fc group by 1, 2, 3), lim as (select model, zone, quantile_cont(day_mean, 0.95) as threshold from dm group by 1, 2),
spk as (select dm.*, threshold, day_mean >= threshold as is_spike from dm join lim using (model, zone))"""


@query("spike_days", f"with {forecasts_sql()}, {SPIKE_SQL} select model, zone, target_date, round(day_mean, 6) as day_mean, round(threshold, 6) as threshold, is_spike from spk")
def spike_days(spark, sf_dir):
    return mt.spike_days(forecasts(spark, sf_dir)).select("model", "zone", "target_date", r6("day_mean").alias("day_mean"), r6("threshold").alias("threshold"), "is_spike")


SLICE_MEASURES = ["mae", "bias", "pinball_mean", "coverage_90"]


def slices_sql() -> str:
    rows = f"""rows as (select fc.*, cast(hour({loc('target_time')}) as varchar) as s_hour, case when isodow({loc('target_time')}) >= 6 then 'weekend' else 'weekday' end as s_daytype,
      case when month({loc('target_time')}) in (12, 1, 2) then 'winter' when month({loc('target_time')}) <= 5 then 'spring' when month({loc('target_time')}) <= 8 then 'summer' else 'autumn' end as s_season,
      case when is_spike then 'spike' else 'normal' end as s_spike_day, case when y < 0 then 'negative' else 'non_negative' end as s_negative from fc join spk using (model, zone, target_date) where y is not null)"""
    parts = [f"""select model, zone, '{n}' as slice, s_{n} as "group", count(y) as n, {pick_sql(SLICE_MEASURES)} from rows group by model, zone, s_{n}""" for n in ("hour", "daytype", "season", "spike_day", "negative")]
    return f"with {forecasts_sql()}, {SPIKE_SQL}, {rows} " + " union all ".join(parts)


@query("slice_metrics", slices_sql())
def slice_metrics(spark, sf_dir):
    return pick(mt.slice_metrics(forecasts(spark, sf_dir), QS), ["model", "zone", "slice", "group"], SLICE_MEASURES)


@query("reliability", f"with {forecasts_sql()} " + " union all ".join(f"select model, zone, '{c}' as quantile, round(avg(case when y <= {c} then 1.0 else 0.0 end), 6) as observed from fc group by 1, 2" for c in QCOLS))
def reliability(spark, sf_dir):
    return mt.reliability(forecasts(spark, sf_dir), list(QCOLS)).select("model", "zone", "quantile", r6("observed").alias("observed"))


GROUPS = {"ECON": "price", "STAN": "calendar", "PROMO": "weather"}


@query(
    "importance_groups",
    """with s as (select case when p_type like 'ECON%' then 'price' when p_type like 'STAN%' then 'calendar' when p_type like 'PROMO%' then 'weather' else 'other' end as "group", sum(p_retailprice) as importance from part group by 1)
    select "group", round(importance, 6) as importance, round(importance / sum(importance) over (), 6) as share from s order by importance desc, "group" limit 3""",
)
def importance_groups(spark, sf_dir):
    rows = read(spark, sf_dir, "part").select(F.col("p_type").alias("feature"), F.col("p_retailprice").alias("importance"))
    return mt.importance_groups(rows, GROUPS, 3).select("group", r6("importance").alias("importance"), r6("share").alias("share"))


@query(
    "rolling_mean_7d",
    f"with {ZONED_SQL} select zone, day, round(case when count(*) over w = 7 then avg(value) over w end, 6) as value_mean from zoned window w as (partition by zone order by day rows between 6 preceding and current row)",
)
def rolling_mean_7d(spark, sf_dir):
    return mt.rolling_mean(zoned_orders(spark, sf_dir), "value", 7, ["zone"], "day").select("zone", "day", r6("value_mean").alias("value_mean"))


@query("running_min", f"with {ZONED_SQL} select zone, day, round(min(value) over (partition by zone order by day), 6) as best from zoned")
def running_min(spark, sf_dir):
    return mt.running_min(zoned_orders(spark, sf_dir), "value", ["zone"], ["day"]).select("zone", "day", r6("best").alias("best"))


@query("day_over_day_change", f"with {ZONED_SQL} select zone, day, round(abs(value - lag(value) over (partition by zone order by day)), 6) as change from zoned")
def day_over_day_change(spark, sf_dir):
    return mt.day_over_day_change(zoned_orders(spark, sf_dir), "value", ["zone"]).select("zone", "day", r6("change").alias("change"))


@query(
    "regime_days",
    f"""with {ZONED_SQL}, w as (select *, case when count(*) over p >= 28 then quantile_cont(value, 0.9) over p end as threshold from zoned window p as (partition by zone order by day rows between unbounded preceding and 1 preceding))
    select zone, day, round(threshold, 6) as threshold, coalesce(value > threshold, false) as is_regime from w""",
)
def regime_days(spark, sf_dir):
    return mt.regime_days(zoned_orders(spark, sf_dir), "value", ["zone"]).select("zone", "day", r6("threshold").alias("threshold"), "is_regime")


@query(
    "sort_quantiles",
    f"""with {forecasts_sql()}, s as (select model, zone, target_time, list_sort([q95, q05, q50]) as s, [q95, q05, q50] as b from fc)
    select model, zone, target_time, round(s[1], 6) as lo, round(s[2], 6) as mid, round(s[3], 6) as hi, s <> b as was_crossing from s""",
)
def sort_quantiles(spark, sf_dir):
    fc = forecasts(spark, sf_dir).select("model", "zone", ntz("target_time").alias("target_time"), F.col("q95").alias("lo"), F.col("q05").alias("mid"), F.col("q50").alias("hi"))
    return op.sort_quantiles(fc, ["lo", "mid", "hi"]).select("model", "zone", "target_time", *[r6(c).alias(c) for c in ("lo", "mid", "hi")], "was_crossing")


DAYPART_SQL = f"case when hour({loc('target_time')}) < 6 then 'night' when hour({loc('target_time')}) < 10 then 'morning' when hour({loc('target_time')}) < 17 then 'day' when hour({loc('target_time')}) < 22 then 'evening' else 'late' end"


@query(
    "daypart_bias",
    f"""with {forecasts_sql()}, p as (select model, zone, {DAYPART_SQL} as part, avg(q50 - y) as bias, count(*) as hours, count(*) filter (where y > q95) as above, count(*) filter (where y < q05) as below from fc where y is not null group by 1, 2, 3)
    select model, zone, part, round(bias, 6) as bias, hours, above as above_q95, below as below_q05, part = arg_max(part, abs(bias)) over (partition by model, zone) as is_largest from p""",
)
def daypart_bias(spark, sf_dir):
    from tidemark.operators.serving import daypart_bias as build

    return build(forecasts(spark, sf_dir)).withColumn("bias", r6("bias"))


@query(
    "day_summary",
    f"""with {forecasts_sql()} select model, zone, target_date, count(*) as n_hours, round(avg(q50), 6) as mean_median, arg_max(target_time, {{'v': q50, 't': target_time}}) as peak_time, arg_min(target_time, {{'v': q50, 't': target_time}}) as trough_time,
    round(avg(q95 - q05), 6) as width_90, round(case when count(y) = 24 then avg(y) end, 6) as actual_mean from fc where target_date <> date '2024-03-31' group by 1, 2, 3""",
)
def day_summary(spark, sf_dir):
    from tidemark.operators.serving import day_summary as build

    out = build(forecasts(spark, sf_dir).where("target_date <> '2024-03-31'"))
    return out.select("model", "zone", "target_date", "n_hours", r6("mean_median").alias("mean_median"), ntz("peak_time").alias("peak_time"), ntz("trough_time").alias("trough_time"), r6("width_90").alias("width_90"), r6("actual_mean").alias("actual_mean"))


# ---- forecasters -----------------------------------------------------------------------------------

RESIDUAL_DAYS = 14


def schedule(spark, sf_dir, rows):
    origins = rows.select("zone", "origin_date").distinct()
    return bt.refit_schedule(origins, ["zone"])


SCHEDULE_SQL = "sched as (select zone, origin_date, min(origin_date) over (partition by zone, date_trunc('month', origin_date)) as fit_origin from (select distinct zone, origin_date from dataset))"


def naive_sql(own: str) -> str:
    offs = ", ".join(f"quantile_cont(y - point, {q}) as o{c}" for q, c in zip(QS, QCOLS))
    return f"""{dataset_sql()}, {SCHEDULE_SQL}, pt as (select *, coalesce({own}, p_samehour_mean7d, "p_dayD_mean") as point from dataset),
    fits as (select distinct zone, fit_origin from sched),
    past as (select p.*, f.fit_origin, max(p.target_date) over (partition by p.zone, f.fit_origin) as last from pt p join fits f on f.zone = p.zone and p.target_date <= f.fit_origin),
    offs as (select zone, fit_origin, cal_hour, {offs} from past where target_date > last - {RESIDUAL_DAYS} group by 1, 2, 3),
    naive as (select p.zone, p.origin_date, s.fit_origin, p.target_time, p.target_date, p.cal_hour, p.y, {', '.join(f'point + o{c} as {c}' for c in QCOLS)} from pt p join sched s using (zone, origin_date) join offs o on o.zone = p.zone and o.fit_origin = s.fit_origin and o.cal_hour = p.cal_hour)"""


def naive(spark, sf_dir, lag):
    rows = ft.origin_dataset(keyed(spark, sf_dir))
    return op.seasonal_naive(rows, schedule(spark, sf_dir, rows), lag, QS, RESIDUAL_DAYS)


FC_SQL = "zone, origin_date, target_time, " + ", ".join(f"round({c}, 6) as {c}" for c in QCOLS)


def fc_columns(df):
    return df.select("zone", "origin_date", ntz("target_time").alias("target_time"), *[r6(c).alias(c) for c in QCOLS])


@query("seasonal_naive", f"with {naive_sql('p_lag7d')} select {FC_SQL} from naive")
def seasonal_naive(spark, sf_dir):
    return fc_columns(naive(spark, sf_dir, 7))


WEEKDAY_SQL = naive_sql("case when cal_dow in (6, 5, 0) then p_lag7d else p_lag1d end")


@query("naive_weekday", f"with {WEEKDAY_SQL} select {FC_SQL} from naive")
def naive_weekday(spark, sf_dir):
    return fc_columns(naive(spark, sf_dir, "weekday"))


@query("backtest", f"with {WEEKDAY_SQL} select zone, fit_origin, count(distinct origin_date) as n_origins, count(*) as n_rows, round(avg({MEAN_LOSS}), 6) as pinball from naive group by 1, 2")
def backtest(spark, sf_dir):
    fc = op.sort_quantiles(naive(spark, sf_dir, "weekday"), list(QCOLS))
    loss = sum((op.pinball(F.col("y"), F.col(c), q) for q, c in zip(QS, QCOLS)), F.lit(0.0)) / len(QS)
    return fc.groupBy("zone", "fit_origin").agg(F.count_distinct("origin_date").alias("n_origins"), F.count(F.lit(1)).alias("n_rows"), r6(F.avg(loss)).alias("pinball"))


CLIMATE_SQL = ", ".join(f"quantile_cont(y, {q}) as {c}" for q, c in zip(QS, QCOLS))


@query(
    "backtest_stepwise",
    f"""with {dataset_sql()}, {SCHEDULE_SQL}, fits as (select distinct zone, fit_origin from sched),
    cl as (select f.zone, f.fit_origin, d.cal_hour, {CLIMATE_SQL} from fits f join dataset d on d.zone = f.zone and d.target_date <= f.fit_origin group by all)
    select d.zone, d.origin_date, s.fit_origin, d.target_time, {', '.join(f'round({c}, 6) as {c}' for c in QCOLS)} from dataset d join sched s using (zone, origin_date) join cl using (zone, fit_origin, cal_hour)""",
)
def backtest_stepwise(spark, sf_dir):
    """A plug-in forecaster, the training slice's quantiles by hour, fitted once a month."""

    def climate(train, rows):
        levels = train.groupBy("zone", "cal_hour").agg(F.percentile("y", F.array(*[F.lit(q) for q in QS])).alias("_q"))
        return rows.join(levels, ["zone", "cal_hour"]).withColumns({c: F.col("_q")[i] for i, c in enumerate(QCOLS)}).drop("_q")

    rows = ft.origin_dataset(keyed(spark, sf_dir))
    out = bt.backtest(climate, rows, schedule(spark, sf_dir, rows), list(QCOLS))
    return out.select("zone", "origin_date", "fit_origin", ntz("target_time").alias("target_time"), *[r6(c).alias(c) for c in QCOLS])


Z = ", ".join(f"round(level + effect + sigma * {op.NORMAL[q]}, 6) as {c}" for q, c in zip(QS, QCOLS))


@query(
    "seasonal_decomposition",
    f"""with {dataset_sql()}, pr as (select zone, local_date as day, local_hour as hour, price from keyed where price is not null),
    dl as (select zone, day, avg(price) as mean from pr group by 1, 2), tr as (select zone, day, avg(mean) over (partition by zone order by day range between interval 6 day preceding and current row) as trend from dl),
    lv as (select a.zone, a.day, a.trend + coalesce(a.trend - b.trend, 0) / 7 as level from tr a left join tr b on b.zone = a.zone and b.day = a.day - 7),
    dv as (select zone, day, hour, isodow(day) as dow, price - trend as dev from pr join tr using (zone, day)),
    gr as (select d.zone, d.origin_date, d.cal_hour, v.dow, sum(dev) as s, count(*) as n, sum(dev * dev) as ss from (select distinct zone, origin_date, cal_hour from dataset) d
      join dv v on v.zone = d.zone and v.hour = d.cal_hour and v.day between d.origin_date - 55 and d.origin_date group by 1, 2, 3, 4),
    eff as (select zone, origin_date, cal_hour, coalesce(max(s / n) filter (where dow = isodow(origin_date + 1)), sum(s) / sum(n)) as effect,
      sqrt(case when sum(n) > count(*) then greatest(sum(ss - s * s / n) / (sum(n) - count(*)), 0) when sum(n) > 1 then greatest((sum(ss) - sum(s) * sum(s) / sum(n)) / (sum(n) - 1), 0) end) as sigma from gr group by 1, 2, 3)
    select d.zone, d.origin_date, d.target_time, {Z} from dataset d join lv l on l.zone = d.zone and l.day = d.origin_date left join eff e on e.zone = d.zone and e.origin_date = d.origin_date and e.cal_hour = d.cal_hour""",
)
def seasonal_decomposition(spark, sf_dir):
    rows = keyed(spark, sf_dir)
    return fc_columns(op.seasonal_decomposition(ft.origin_dataset(rows), rows, QS))


RECAL_SQL = f"""recal_o as (select model, zone, origin_date from fc group by 1, 2, 3),
recal_w as (select o.model, o.zone, o.origin_date, count(distinct e.target_date) as n, {', '.join(f'quantile_cont(e.y - e.{c}, {q}) as e_{c}' for q, c in zip(QS, QCOLS))}
  from recal_o o left join fc e on e.model = o.model and e.zone = o.zone and e.target_date <= o.origin_date and e.target_date > o.origin_date - 7 group by 1, 2, 3),
recal_c as (select model, zone, origin_date, {', '.join(f'coalesce(last_value(case when n >= 3 then e_{c} end ignore nulls) over (partition by model, zone order by origin_date), 0) as o_{c}' for c in QCOLS)} from recal_w)"""


@query("recalibrate", f"with {forecasts_sql()}, {RECAL_SQL} select model, zone, origin_date, target_time, {', '.join(f'round({c} + o_{c}, 6) as {c}' for c in QCOLS)} from fc join recal_c using (model, zone, origin_date)")
def recalibrate(spark, sf_dir):
    out = op.recalibrate(forecasts(spark, sf_dir), list(QCOLS), QS, window_days=7, min_days=3)
    return out.select("model", "zone", "origin_date", ntz("target_time").alias("target_time"), *[r6(c).alias(c) for c in QCOLS])


GRID_SQL = """grid as (select cast(row_number() over (order by a * a + (20 - a) * (20 - a), a desc) as integer) as rank, a / 20.0::double as w1, (20 - a) / 20.0::double as w2 from (select unnest(generate_series(0, 20)) as a))"""


@query("simplex_grid", f"with {forecasts_sql()}, {GRID_SQL}, n as (select count(distinct model) as members from fc) select rank, w1, w2 from grid, n where members = 2")
def simplex_grid(spark, sf_dir):
    """The grid for as many members as there are models with forecasts."""
    return op.simplex_grid(spark, forecasts(spark, sf_dir).agg(F.count_distinct("model")).first()[0], 20)


#: The ensemble's three members, and the steps of their weights.
MEMBER_LAGS, STEPS = (1, 2, 7), 10
WEIGHTS = [f"w{i + 1}" for i in range(len(MEMBER_LAGS))]


def members(spark, sf_dir):
    """Forecasts of the three models on the hours that all have, as sorted arrays."""
    fc = forecasts(spark, sf_dir, MEMBER_LAGS).withColumn("q", F.array_sort(F.array(*QCOLS)))
    own = [F.max(F.when(F.col("model") == f"naive_{k}d", F.col("q"))) for k in MEMBER_LAGS]
    rows = fc.groupBy("zone", "origin_date", "target_time", "target_date", F.col("local_hour").alias("cal_hour"), "y").agg(F.array(*own).alias("members"))
    return rows.where(~F.exists("members", lambda m: m.isNull()))


def mix(i: int) -> str:
    return "(" + " + ".join(f"{w} * m{k}[{i + 1}]" for w, k in zip(WEIGHTS, MEMBER_LAGS)) + ")"


GRID3_SQL = f"""grid as (select cast(row_number() over (order by a * a + b * b + c * c, a desc, b desc, c desc) as integer) as rank, a / {STEPS}.0::double as w1, b / {STEPS}.0::double as w2, c / {STEPS}.0::double as w3
  from (select a, b, {STEPS} - a - b as c from (select unnest(generate_series(0, {STEPS})) as a), (select unnest(generate_series(0, {STEPS})) as b) where a + b <= {STEPS}))"""
MIX_LOSS = "(" + " + ".join(loss_sql(q, mix(i)) for i, q in enumerate(QS)) + f") / {len(QS)}"
SORTED_SQL = {k: f"list_sort([{', '.join(f't{k}.{c}' for c in QCOLS)}]) as m{k}" for k in MEMBER_LAGS}
MEMBERS_SQL = f"""mem as (select t1.zone, t1.origin_date, t1.target_time, t1.target_date, t1.local_hour as cal_hour, t1.y, {', '.join(SORTED_SQL.values())}
  from fc t1 {' '.join(f"join fc t{k} on t{k}.model = 'naive_{k}d' and t{k}.zone = t1.zone and t{k}.target_time = t1.target_time" for k in MEMBER_LAGS[1:])} where t1.model = 'naive_1d')"""
EQUAL_SQL = f"1.0::double / {len(WEIGHTS)}"
WEIGHTS_SQL = f"""{GRID3_SQL}, {MEMBERS_SQL}, pd as (select zone, cal_hour as grp, rank, {', '.join(WEIGHTS)}, target_date, sum({MIX_LOSS}) as s, count(*) as n from mem, grid where y is not null group by all),
rl as (select zone, grp, rank, {', '.join(WEIGHTS)}, target_date, sum(s) over w / sum(n) over w as loss from pd window w as (partition by zone, grp, rank order by target_date)),
bs as (select zone, grp, target_date, {', '.join(f"arg_min({w}, {{'l': round(loss, 12), 'r': rank}}) as b{w}" for w in WEIGHTS)} from rl group by 1, 2, 3),
hd as (select zone, target_date as origin_date, row_number() over (partition by zone order by target_date) as days from (select distinct zone, target_date from mem where y is not null)),
ev2 as (select distinct zone, cal_hour as grp from mem),
wt as (select e.zone, e.grp, h.origin_date, {', '.join(f'coalesce(last_value(case when days >= 3 then b{w} end ignore nulls) over o, {EQUAL_SQL}) as {w}' for w in WEIGHTS)}
  from ev2 e join hd h using (zone) left join bs on bs.zone = e.zone and bs.grp = e.grp and bs.target_date = h.origin_date window o as (partition by e.zone, e.grp order by h.origin_date))"""


@query("ensemble_weights", f"with {forecasts_sql(MEMBER_LAGS)}, {WEIGHTS_SQL} select zone, cast(grp as integer) as grp, origin_date, {', '.join(WEIGHTS)} from wt")
def ensemble_weights(spark, sf_dir):
    return op.ensemble_weights(members(spark, sf_dir), op.simplex_grid(spark, len(WEIGHTS), STEPS), list(QCOLS), QS, min_days=3)


@query(
    "ensemble_combine",
    f"""with {forecasts_sql(MEMBER_LAGS)}, {WEIGHTS_SQL}, mw as (select m.* , {', '.join(f'coalesce({w}, {EQUAL_SQL}) as {w}' for w in WEIGHTS)} from mem m left join wt on wt.zone = m.zone and wt.grp = m.cal_hour and wt.origin_date = m.origin_date)
    select zone, origin_date, target_time, {', '.join(f'round({mix(i)}, 6) as {c}' for i, c in enumerate(QCOLS))} from mw""",
)
def ensemble_combine(spark, sf_dir):
    rows = members(spark, sf_dir)
    weights = op.ensemble_weights(rows, op.simplex_grid(spark, len(WEIGHTS), STEPS), list(QCOLS), QS, min_days=3)
    return fc_columns(op.ensemble_combine(rows, weights, list(QCOLS)))


@query(
    "decile_to_quantile",
    f"""with d as (select l_suppkey, {', '.join(f'quantile_cont(l_extendedprice, {k / 10}) as d{k}' for k in range(1, 10))} from lineitem group by 1)
    select l_suppkey, round(d5 + (d1 - d5) * ({op.NORMAL[0.05]} / -{op.NORMAL[0.90]}), 6) as q05, round(d1, 6) as q10, round(d2 + (d3 - d2) * 0.5, 6) as q25, round(d5, 6) as q50,
    round(d7 + (d8 - d7) * 0.5, 6) as q75, round(d9, 6) as q90, round(d5 + (d9 - d5) * ({op.NORMAL[0.95]} / {op.NORMAL[0.90]}), 6) as q95 from d""",
)
def decile_to_quantile(spark, sf_dir):
    deciles = read(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.percentile("l_extendedprice", F.array(*[F.lit(k / 10) for k in range(1, 10)])).alias("deciles"))
    return op.decile_to_quantile(deciles, "deciles", QS).select("l_suppkey", *[r6(c).alias(c) for c in QCOLS])


# ---- schedules -------------------------------------------------------------------------------------


@query("refit_schedule", f"with {dataset_sql()}, {SCHEDULE_SQL} select zone, origin_date, fit_origin from sched")
def refit_schedule(spark, sf_dir):
    return schedule(spark, sf_dir, ft.origin_dataset(keyed(spark, sf_dir)))


@query(
    "fit_log",
    f"""with {dataset_sql()}, {SCHEDULE_SQL}, f as (select distinct zone, fit_origin from sched)
    select f.zone, f.fit_origin, count(*) as train_rows, min(target_date) as train_first_target_date, max(target_date) as train_last_target_date from f join dataset d on d.zone = f.zone and d.target_date <= f.fit_origin and d.target_date >= date '2024-03-20' group by 1, 2""",
)
def fit_log(spark, sf_dir):
    rows = ft.origin_dataset(keyed(spark, sf_dir))
    out = bt.fit_log(rows, schedule(spark, sf_dir, rows), ["zone"], "2024-03-20")
    return out


@query("select_origins", f"with {ZONED_SQL}, d as (select distinct day as origin_date from zoned where day between date '1996-01-01' and date '1997-12-31'), r as (select *, row_number() over (order by origin_date) as i from d) select origin_date from r where (i - 1) % 5 = 0")
def select_origins(spark, sf_dir):
    return bt.select_origins(zoned_orders(spark, sf_dir).select(F.col("day").alias("origin_date")).distinct(), "1996-01-01", "1997-12-31", 5)


FOLDS_SQL = "folds as (select k as fold, date '2001-01-01' - cast((4 - k) * 91 + 3 as integer) as val_end from (select unnest(generate_series(1, 4)) as k)), fl as (select fold, val_end - 90 as val_start, val_end, val_end - 90 - 3 as train_end from folds)"


@query("time_folds", f"with {ZONED_SQL}, {FOLDS_SQL} select zone, cast(fold as integer) as fold, count(*) filter (where day <= train_end) as train_days, count(*) filter (where day between val_start and val_end) as val_days from zoned, fl group by 1, 2")
def time_folds(spark, sf_dir):
    folds = bt.time_folds(spark, "2001-01-01", 4, 91, 2)
    rows = zoned_orders(spark, sf_dir).join(F.broadcast(folds), F.col("day") <= F.col("val_end"))  # a few folds
    return rows.groupBy("zone", "fold").agg(F.count_if(F.col("day") <= F.col("train_end")).alias("train_days"), F.count_if(F.col("day").between(F.col("val_start"), F.col("val_end"))).alias("val_days"))


@query(
    "origin_gaps",
    f"""with {ZONED_SQL}, e as (select zone, day from zoned), p as (select zone, day from zoned where n >= 2), d as (select zone, day from zoned where n = 1 and day(day) < 15)
    select * from e where not exists (select 1 from p where p.zone = e.zone and p.day = e.day) and not exists (select 1 from d where d.zone = e.zone and d.day = e.day)""",
)
def origin_gaps(spark, sf_dir):
    rows = zoned_orders(spark, sf_dir)
    return bt.origin_gaps(rows.select("zone", "day"), rows.where("n >= 2").select("zone", "day"), rows.where("n = 1 and dayofmonth(day) < 15").select("zone", "day"), ["zone", "day"])


@query(
    "pending_origins",
    f"""with {ZONED_SQL}, l as (select zone, max(day) as last from zoned where n >= 4 group by 1)
    select z.zone, z.day, cast(row_number() over (partition by z.zone order by z.day) as integer) as position from zoned z left join l using (zone) where (last is null or z.day > last) and z.day <= date '2001-07-25'""",
)
def pending_origins(spark, sf_dir):
    rows = zoned_orders(spark, sf_dir)
    return bt.pending_origins(rows.select("zone", "day"), rows.where("n >= 4"), "2001-07-25", ["zone"], "day")


# ---- comparison ------------------------------------------------------------------------------------

TWO_MODELS_SQL = f"""{ZONED_SQL}, two as (select zone, 'a' as model, day as target_date, abs(value - lag(value) over (partition by zone order by day)) / 1000 as pinball from zoned
union all select zone, 'b', day, abs(value - lag(value, 7) over (partition by zone order by day)) / 1000 from zoned), ls as (select * from two where pinball is not null)"""


def two_models(spark, sf_dir):
    """Daily losses of two naive models of a long series."""
    from pyspark.sql import Window

    rows, order = zoned_orders(spark, sf_dir), Window.partitionBy("zone").orderBy("day")
    parts = [rows.select("zone", F.lit(m).alias("model"), F.col("day").alias("target_date"), (F.abs(F.col("value") - F.lag("value", k).over(order)) / 1000).alias("pinball")) for m, k in (("a", 1), ("b", 7))]
    return parts[0].unionByName(parts[1]).where("pinball is not null")


COMMON_SQL = "cd as (select zone, target_date from ls group by 1, 2 having count(distinct model) = 2)"


@query("common_days", f"with {TWO_MODELS_SQL}, {COMMON_SQL} select zone, target_date, cast(2 as bigint) as n_models from cd")
def common_days(spark, sf_dir):
    return bt.common_days(two_models(spark, sf_dir))


def bootstrap_sql(source: str, col: str, resamples: int, name: str) -> str:
    """Sums of the days of every block that can be drawn, then of the blocks of every resample."""
    draw = "((((1 * 1000003 + r * 7919 + b * 104729 + 12345) % 2147483647) * 48271 % 2147483647) * 48271 % 2147483647)"
    return f"""{name}_i as materialized (select zone, model, {col} as x, row_number() over (partition by zone, model order by target_date) - 1 as pos, count(*) over (partition by zone, model) as n from {source}),
    {name}_s as (select zone, model, n, avg(x) as mean, least(7, n) as len, cast(ceil(n / least(7, n)::double) as bigint) as blocks from {name}_i group by 1, 2, 3),
    {name}_t as (select distinct zone, model, n, unnest([len, n - (blocks - 1) * len]) as take from {name}_s),
    {name}_b as materialized (select t.zone, t.model, t.take, p.pos as start, sum(i.x) as s from {name}_t t join {name}_i p on p.zone = t.zone and p.model = t.model, (select unnest(generate_series(0, 7 - 1)) as k), {name}_i i
      where k < t.take and i.zone = t.zone and i.model = t.model and i.pos = (p.pos + k) % t.n group by 1, 2, 3, 4),
    {name}_d as (select zone, model, n, r, cast(floor({draw} * n / 2147483647.0::double) as bigint) as start, least(len, n - b * len) as take
      from (select s.*, unnest(generate_series(0, blocks - 1)) as b from {name}_s s), (select unnest(generate_series(0, {resamples - 1})) as r)),
    {name}_m as (select d.zone, d.model, d.r, sum(b.s) / any_value(d.n) as m from {name}_d d join {name}_b b on b.zone = d.zone and b.model = d.model and b.take = d.take and b.start = d.start group by 1, 2, 3),
    {name} as (select s.zone, s.model, s.n, s.mean, q.low, q.high from {name}_s s join (select zone, model, quantile_cont(m, 0.025) as low, quantile_cont(m, 0.975) as high from {name}_m group by 1, 2) q using (zone, model))"""


@query("block_bootstrap", f"with {TWO_MODELS_SQL}, {bootstrap_sql('ls', 'pinball', 2000, 'bs')} select zone, model, n, round(mean, 6) as mean, round(low, 6) as low, round(high, 6) as high from bs")
def block_bootstrap(spark, sf_dir):
    out = st.block_bootstrap(two_models(spark, sf_dir), "pinball", ["zone", "model"], resamples=2000)
    return out.select("zone", "model", "n", r6("mean").alias("mean"), r6("low").alias("low"), r6("high").alias("high"))


DM_SQL = """pr as (select a.zone, a.target_date, a.pinball as la, b.pinball as lb from ls a join ls b on a.model = 'a' and b.model = 'b' and a.zone = b.zone and a.target_date = b.target_date),
dd as (select zone, target_date, la - lb as d, la - lb - avg(la - lb) over (partition by zone) as c from pr), dl as (select *, lag(c) over (partition by zone order by target_date) as c1 from dd),
dm as (select zone, count(*) as n, avg(d) as mean_diff, sum(c * c{lags}) / count(*) as v from dl group by 1)"""


@query(
    "diebold_mariano",
    f"with {TWO_MODELS_SQL}, {DM_SQL.format(lags=' + 2 * coalesce(c * c1, 0)')} select zone, n, round(mean_diff, 6) as mean_diff, round(case when v > 0 then mean_diff / sqrt(v / n) * sqrt((n + 1 - 4 + 2 / n) / n) end, 6) as statistic from dm where n >= 3",
)
def diebold_mariano(spark, sf_dir):
    rows = two_models(spark, sf_dir)
    a = rows.where("model = 'a'").select("zone", "target_date", F.col("pinball").alias("loss_a"))
    b = rows.where("model = 'b'").select("zone", "target_date", F.col("pinball").alias("loss_b"))
    out = st.diebold_mariano(a.join(b, ["zone", "target_date"]), ["zone"], horizon=2)
    return out.select("zone", "n", r6("mean_diff").alias("mean_diff"), r6("statistic").alias("statistic"))


@query("diebold_mariano_p")
def diebold_mariano_p(spark, sf_dir):
    rows = two_models(spark, sf_dir)
    a = rows.where("model = 'a'").select("zone", "target_date", F.col("pinball").alias("loss_a"))
    b = rows.where("model = 'b'").select("zone", "target_date", F.col("pinball").alias("loss_b"))
    return st.with_p_value(st.diebold_mariano(a.join(b, ["zone", "target_date"]), ["zone"])).select("zone", "n", "statistic", "p_value")


COMPARE_SQL = f"""{COMMON_SQL}, cl as (select ls.* from ls join cd using (zone, target_date)), df as (select a.zone, a.model, a.target_date, a.pinball - b.pinball as diff from cl a join cl b on b.model = 'b' and a.model <> 'b' and a.zone = b.zone and a.target_date = b.target_date),
{bootstrap_sql('cl', 'pinball', 2000, 'mb')}, {bootstrap_sql('df', 'diff', 2000, 'db')},
dz as (select zone, model, diff - avg(diff) over (partition by zone, model) as c, diff from df), dt as (select zone, model, count(*) as n, avg(diff) as m, sum(c * c) / count(*) as v from dz group by 1, 2)"""


@query(
    "compare_models",
    f"""with {TWO_MODELS_SQL}, {COMPARE_SQL}
    select mb.zone, mb.model, mb.n, round(mb.mean, 6) as mean, round(mb.low, 6) as low, round(mb.high, 6) as high, round(db.mean, 6) as diff, round(db.low, 6) as diff_low, round(db.high, 6) as diff_high,
    round(dt.m / sqrt(dt.v / dt.n) * sqrt((dt.n - 1) / dt.n::double), 6) as statistic, round(1 - mb.mean / r.mean, 6) as skill
    from mb left join db using (zone, model) left join dt using (zone, model) join mb r on r.zone = mb.zone and r.model = 'b'""",
)
def compare_models(spark, sf_dir):
    out = st.compare_models(two_models(spark, sf_dir), "b", resamples=2000)
    return out.select("zone", "model", "n", *[r6(c).alias(c) for c in ("mean", "low", "high", "diff", "diff_low", "diff_high", "statistic", "skill")])


@query(
    "compare_stored",
    f"with {TWO_MODELS_SQL}, {COMMON_SQL} select zone, model, count(*) as n_days, round(avg(pinball), 6) as pinball from ls join cd using (zone, target_date) group by 1, 2",
)
def compare_stored(spark, sf_dir):
    from tidemark.operators.serving import stored_losses

    losses = two_models(spark, sf_dir).withColumn("dataset_version", F.concat("zone", F.lit("-stitched")))
    path = scratch(spark, "losses")
    losses.repartition("zone", "model").write.partitionBy("zone", "model").parquet(path)
    return stored_losses(spark.read.schema(losses.schema).parquet(path)).withColumn("pinball", r6("pinball"))


STORE_SQL = """mid as (select date_add(min(origin_date), cast(date_diff('day', min(origin_date), max(origin_date)) // 2 as integer)) as d from fc),
served as (select f.*, row_number() over (partition by zone, origin_date order by model) as rn, count(*) filter (where model = 'naive_7d') over (partition by zone, origin_date) as later from (select distinct zone, origin_date, model from fc, mid where model = 'naive_7d' or origin_date < d) f)"""


@query(
    "forecast_store",
    f"with {forecasts_sql((1, 7))}, {STORE_SQL} select fc.zone, 'champion' as role, fc.origin_date, fc.model, count(*) as n_rows, round(avg(q50), 6) as q50 from fc join served s on s.zone = fc.zone and s.origin_date = fc.origin_date and s.model = fc.model where s.rn = 1 and s.later > 0 group by all",
)
def forecast_store(spark, sf_dir):
    """A model serves the first half of the origins; a later one is run on all of them and finds those stored."""
    fc = forecasts(spark, sf_dir, (1, 7)).withColumn("role", F.lit("champion")).select("zone", "role", "origin_date", "model", "target_time", "q50")
    span = fc.agg(F.min("origin_date").alias("a"), F.max("origin_date").alias("b"))
    mid = span.select(F.expr("date_add(a, cast(floor(datediff(b, a) / 2) as int))")).first()[0]
    root = scratch(spark, "forecasts")
    lake.store_new(fc.where((F.col("model") == "naive_1d") & (F.col("origin_date") < F.lit(mid))), root, ["zone", "role", "origin_date"])
    found = lake.store_new(fc.where("model = 'naive_7d'"), root, ["zone", "role", "origin_date"])
    return found.groupBy("zone", "role", "origin_date", "model").agg(F.count(F.lit(1)).alias("n_rows"), r6(F.avg("q50")).alias("q50"))


@query("quantile_forest")
def quantile_forest(spark, sf_dir):
    from tidemark.operators.ml import FEATURES, quantile_forest as fit

    rows = ft.origin_dataset(keyed(spark, sf_dir))
    out, _ = fit(rows.where("target_date <= '2024-04-04'"), rows.where("target_date > '2024-04-04'"), FEATURES, QS)
    return fc_columns(out)


#: Ends of training, first and last day of validation of the search's folds, and its points.
FOLDS = tuple((f"2024-04-{d:02d}", f"2024-04-{d + 1:02d}", f"2024-04-{d + 3:02d}") for d in (1, 4, 7, 10))
GRID = tuple({"depth": d, "trees": t, "min_rows": m} for d in (3, 5) for t in (4, 8) for m in (5, 20))


@query("grid_search")
def grid_search(spark, sf_dir):
    from tidemark.operators.ml import FEATURES, grid_search as search

    rows = ft.origin_dataset(keyed(spark, sf_dir))
    return search(rows, list(FOLDS), list(GRID), FEATURES, QS)
