"""Queries over overlapping pulls: latest views, revision logs, stores."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.timeutils import lead_run
from tidemark.operators import lake as op
from tidemark.plans.feeds import PULLS_SQL, READINGS_SQL, ZONED_SQL, ev_sql, hourly, hourly_sql, loc, ntz, pulls, r6, read, readings, series, zoned_orders
from tidemark.plans.registry import query

AS_OF = "1998-06-30 00:00:00"
LATEST_SQL = """latest as (select * from (select *, row_number() over (partition by part order by pulled_at desc, seq desc) as rn from pulls where valid{and_}) where rn = 1)"""


@query("latest_per_key", f"with {PULLS_SQL}, {LATEST_SQL.format(and_='')} select part, pulled_at, snapshot, seq, quantity, price, discount, tax from latest")
def latest_per_key(spark, sf_dir):
    return op.latest_per_key(pulls(spark, sf_dir), ["part"]).select("part", ntz("pulled_at").alias("pulled_at"), "snapshot", "seq", "quantity", "price", "discount", "tax")


@query("vintage_as_of", f"with {PULLS_SQL}, {LATEST_SQL.format(and_=f' and pulled_at <= timestamp {AS_OF!r}')} select part, pulled_at, snapshot, seq, quantity, price from latest")
def vintage_as_of(spark, sf_dir):
    return op.latest_per_key(pulls(spark, sf_dir), ["part"], AS_OF).select("part", ntz("pulled_at").alias("pulled_at"), "snapshot", "seq", "quantity", "price")


@query("contributing_snapshots", f"with {PULLS_SQL}, {LATEST_SQL.format(and_='')} select distinct snapshot from latest")
def contributing_snapshots(spark, sf_dir):
    return op.contributing_snapshots(op.latest_per_key(pulls(spark, sf_dir), ["part"]))


CHANGES_SQL = f"""with {PULLS_SQL}, once as (select * from (select *, row_number() over (partition by part, snapshot order by pulled_at desc, seq desc) as rn from pulls where valid) where rn = 1),
    w as (select part, pulled_at, snapshot, quantity, discount, lag(quantity) over o as oq, lag(discount) over o as od, lag(pulled_at) over o as op, lag(snapshot) over o as os, row_number() over o as n
      from once window o as (partition by part order by pulled_at, seq)),
    t as (select part, 'quantity' as "column", oq as old, quantity as new, op, pulled_at, os, snapshot from w where n > 1 union all
      select part, 'discount', od, discount, op, pulled_at, os, snapshot from w where n > 1)
    select part, "column", old, new, op as old_pulled_at, pulled_at as new_pulled_at, os as old_snapshot, snapshot as new_snapshot from t where old is distinct from new"""


@query("change_log", CHANGES_SQL)
def change_log(spark, sf_dir):
    log = op.change_log(pulls(spark, sf_dir).where("valid"), ["part"], ["quantity", "discount"])
    return log.withColumn("old_pulled_at", ntz("old_pulled_at")).withColumn("new_pulled_at", ntz("new_pulled_at"))


@query(
    "dedup_keep_last",
    f"""with {PULLS_SQL}, b as (select min(part) as lo, max(part) - min(part) + 1 as n from pulls), q as (select pulls.*, lo, n, (part - lo) * 4 // n as home from pulls, b),
    c as (select *, least(home + case when seq % 3 = 0 then 1 else 0 end, 3) as chunk from q),
    i as (select *, row_number() over (partition by pulled_at, part order by chunk desc, seq desc) as rn from c where part >= lo + n * chunk // 4 - 20 and part < lo + n * (chunk + 1) // 4 + 20)
    select part, pulled_at, chunk, seq, price from i where rn = 1""",
)
def dedup_keep_last(spark, sf_dir):
    """Four overlapping ranges over all parts; a part is pulled by its own range and, partly, by the next one."""
    rows = pulls(spark, sf_dir)
    bounds = rows.agg(F.min("part").alias("lo"), (F.max("part") - F.min("part") + 1).alias("n")).first()  # one row
    lo, n = bounds.lo or 0, bounds.n or 1
    chunks = spark.createDataFrame([(k, lo + n * k // 4 - 20, lo + n * (k + 1) // 4 + 20) for k in range(4)], "chunk long, start long, end long")
    home = F.floor((F.col("part") - lo) * 4 / n)
    rows = rows.withColumn("chunk", F.least(home + (F.col("seq") % 3 == 0).cast("long"), F.lit(3)))
    return op.clip_and_dedup_chunks(rows, chunks, ["pulled_at"], ts="part", arrival="seq").select("part", ntz("pulled_at").alias("pulled_at"), "chunk", "seq", "price")


@query("dedup_keep_first", f"with {PULLS_SQL}, r as (select *, row_number() over (partition by part order by pulled_at, seq) as rn from pulls) select part, seq, price from r where rn = 1")
def dedup_keep_first(spark, sf_dir):
    return op.keep_one(pulls(spark, sf_dir), ["part"], [F.asc("pulled_at"), F.asc("seq")]).select("part", "seq", "price")


HALVES_SQL = "a as (select part, max(price) as price, max(tax) as tax from pulls where valid group by 1), b as (select part, min(price) as price, min(discount) as tax from pulls group by 1)"


@query(
    "combine_first",
    f"""with {PULLS_SQL}, {HALVES_SQL}, c as (select part, nullif(price, 0) as price, case when tax > 0.04 then tax end as tax from a)
    select coalesce(c.part, b.part) as part, coalesce(c.price, b.price) as price, coalesce(c.tax, b.tax) as tax from c full join b on c.part = b.part""",
)
def combine_first(spark, sf_dir):
    rows = pulls(spark, sf_dir)
    live = rows.where("valid").groupBy("part").agg(F.max("price").alias("price"), F.max("tax").alias("tax"))
    live = live.select("part", F.nullif("price", F.lit(0.0)).alias("price"), F.when(F.col("tax") > 0.04, F.col("tax")).alias("tax"))
    archive = rows.groupBy("part").agg(F.min("price").alias("price"), F.min("discount").alias("tax"))
    return op.combine_first(live, archive, ["part"])


@query(
    "realign_preceding_hour",
    f"""with {hourly_sql()} select coalesce(a.zone, b.zone) as zone, coalesce(a.timestamp, b.timestamp - interval 1 hour) as timestamp, a.n_periods, round(b.price, 6) as price
    from hourly a full join hourly b on a.zone = b.zone and a.timestamp = b.timestamp - interval 1 hour""",
)
def realign_preceding_hour(spark, sf_dir):
    out = op.realign_preceding_hour(hourly(spark, sf_dir), ["price"], ["zone"])
    return out.select("zone", ntz("timestamp").alias("timestamp"), "n_periods", r6("price").alias("price"))


RUN_SQL = "to_timestamp(floor((epoch(timestamp) - {lead} * 3600) / 21600) * 21600)::timestamp"


@query(
    "fixed_lead_assembly",
    f"""with {hourly_sql()}, v as (select zone, timestamp, {RUN_SQL.format(lead=48)} as run_init, price as value from hourly where n_periods >= 2),
    g as (select zone, timestamp, {RUN_SQL.format(lead=48)} as run_init from hourly)
    select g.zone, g.timestamp, g.run_init, round(v.value, 6) as value from g left join v using (zone, timestamp, run_init)""",
)
def fixed_lead_assembly(spark, sf_dir):
    rows, run = hourly(spark, sf_dir), lead_run(F.col("timestamp"), 48)
    vintages = rows.where("n_periods >= 2").select("zone", "timestamp", run.alias("run_init"), F.col("price").alias("value"))
    out = op.fixed_lead_assembly(vintages, rows.select("zone", "timestamp"), ["zone"], run)
    return out.select("zone", ntz("timestamp").alias("timestamp"), ntz("run_init").alias("run_init"), r6("value").alias("value"))


BAD_DAYS = (("click", "2024-03-31"), ("view", "2024-04-02"), ("error", "2024-03-20"))
BAD_SQL = "bad(zone, day) as (values " + ", ".join(f"('{z}', date '{d}')" for z, d in BAD_DAYS) + ")"


def bad_days(spark):
    return spark.createDataFrame(BAD_DAYS, "zone string, day string").withColumn("day", F.to_date("day"))


@query("drop_known_bad_days", f"with {hourly_sql()}, {BAD_SQL} select zone, timestamp, round(price, 6) as price from hourly h where not exists (select 1 from bad b where b.zone = h.zone and b.day = cast({loc('timestamp')} as date))")
def drop_known_bad_days(spark, sf_dir):
    return op.drop_known_bad_days(hourly(spark, sf_dir), bad_days(spark), ["zone"]).select("zone", ntz("timestamp").alias("timestamp"), r6("price").alias("price"))


@query("content_digest")
def content_digest(spark, sf_dir):
    return op.content_digest(pulls(spark, sf_dir))


MANIFEST_SQL = "manifest as (select snapshot, count(*) as row_count, min(pulled_at) as pulled_at, min(part) as data_start, max(part) as data_end, bool_and(valid) as passed from pulls group by 1)"


@query("snapshot_inventory", f"with {PULLS_SQL}, {MANIFEST_SQL} select snapshot, row_count, pulled_at, data_start, data_end from manifest where passed")
def snapshot_inventory(spark, sf_dir):
    out = op.list_snapshots(op.manifest_of(pulls(spark, sf_dir)))
    return out.select("snapshot", "row_count", ntz("pulled_at").alias("pulled_at"), "data_start", "data_end")


@query(
    "table_inventory",
    f"""with {PULLS_SQL}, log as ({CHANGES_SQL}), t as (select part % 50 as tab, count(*) as n_rows, min(pulled_at) as first_time, max(pulled_at) as last_time from pulls group by 1),
    c as (select part % 50 as tab, count(*) as n_conflicts from log group by 1) select t.*, coalesce(n_conflicts, 0) as n_conflicts from t left join c using (tab)""",
)
def table_inventory(spark, sf_dir):
    rows, tab = pulls(spark, sf_dir), F.col("part") % 50
    log = op.change_log(rows.where("valid"), ["part"], ["quantity", "discount"]).withColumn("tab", tab)
    out = op.table_inventory(rows.withColumn("tab", tab), "tab", "pulled_at", log)
    return out.withColumn("first_time", ntz("first_time")).withColumn("last_time", ntz("last_time"))


@query(
    "incremental_skip",
    f"""with {PULLS_SQL}, n as (select part % 50 as tab, string_agg(distinct snapshot, ',' order by snapshot) as s from pulls where valid group by 1),
    b as (select part % 50 as tab, string_agg(distinct snapshot, ',' order by snapshot) as s from pulls where valid and (part % 50 < 20 or pulled_at < timestamp '2001-01-01') group by 1)
    select tab, md5(s) as signature from n where not exists (select 1 from b where b.tab = n.tab and b.s = n.s)""",
)
def incremental_skip(spark, sf_dir):
    rows = pulls(spark, sf_dir).withColumn("tab", F.col("part") % 50)
    before = rows.where((F.col("tab") < 20) | (F.col("pulled_at") < F.lit("2001-01-01").cast("timestamp")))
    return op.incremental_skip(op.input_signatures(rows, "tab"), op.input_signatures(before, "tab"), "tab")


@query(
    "backfill_gaps",
    f"""with {ZONED_SQL}, cov as (select zone, date_trunc('month', day)::date as month from zoned group by 1, 2 having count(*) >= 25),
    g as (select zone, m::date as month from (select distinct zone from zoned), unnest(generate_series(timestamp '1995-01-01', timestamp '2001-12-01', interval 1 month)) t(m))
    select zone, month from g where not exists (select 1 from cov where cov.zone = g.zone and cov.month = g.month)""",
)
def backfill_gaps(spark, sf_dir):
    rows = zoned_orders(spark, sf_dir)
    covered = rows.groupBy("zone", F.trunc("day", "month").alias("month")).agg(F.count(F.lit(1)).alias("n")).where("n >= 25").drop("n")
    return op.backfill_gaps(covered, rows.select("zone").distinct(), "1995-01-01", "2001-12-01")


@query(
    "latest_version",
    "select o_orderpriority as kind, o_orderstatus as zone, arg_max(o_orderkey, {'t': o_orderdate, 'k': o_orderkey}) as version, max(o_orderdate) as built_at from orders group by 1, 2",
)
def latest_version(spark, sf_dir):
    manifest = read(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("kind"), F.col("o_orderstatus").alias("zone"), F.col("o_orderkey").alias("version"), F.col("o_orderdate").alias("built_at"))
    return op.latest_version(manifest, ["kind", "zone"]).withColumn("built_at", ntz("built_at"))


STORE_SQL = """stored as (select part, snapshot, max(price) as price from pulls where pulled_at < timestamp '2000-01-01' group by 1, 2), fresh as (select part, snapshot, min(price) as price from pulls where pulled_at >= timestamp '1998-01-01' group by 1, 2)"""


def stores(spark, sf_dir):
    rows = pulls(spark, sf_dir)
    return (rows.where("pulled_at < timestamp '2000-01-01'").groupBy("part", "snapshot").agg(F.max("price").alias("price")), rows.where("pulled_at >= timestamp '1998-01-01'").groupBy("part", "snapshot").agg(F.min("price").alias("price")))


@query("idempotent_append", f"with {PULLS_SQL}, {STORE_SQL} select part, snapshot, price from stored union all select * from fresh f where not exists (select 1 from stored s where s.part = f.part and s.snapshot = f.snapshot)")
def idempotent_append(spark, sf_dir):
    stored, fresh = stores(spark, sf_dir)
    return op.append_new(stored, fresh, ["part", "snapshot"])


@query("score_upsert", f"with {PULLS_SQL}, {STORE_SQL} select part, snapshot, price from fresh union all select * from stored s where not exists (select 1 from fresh f where s.part = f.part and s.snapshot = f.snapshot)")
def score_upsert(spark, sf_dir):
    stored, fresh = stores(spark, sf_dir)
    return op.upsert(stored, fresh, ["part", "snapshot"])


@query(
    "prices_union",
    f"""with {hourly_sql()} select zone, timestamp, round(price, 6) as price, n_periods, cast(null as varchar) as resolution, 'hourly' as source from hourly
    union all select event_type, ts, round(value, 6), null, 'PT15M', 'raw' from events""",
)
def prices_union(spark, sf_dir):
    raw = read(spark, sf_dir, "events").select(F.col("event_type").alias("zone"), F.col("ts").cast("timestamp").alias("timestamp"), F.col("value").alias("price"), F.lit("PT15M").alias("resolution"))
    op.register_views(spark, {"hourly": hourly(spark, sf_dir), "raw": raw})
    return spark.table("prices").select("zone", ntz("timestamp").alias("timestamp"), r6("price").alias("price"), "n_periods", "resolution", "source")


@query(
    "source_agreement",
    f"""with {hourly_sql()}, p as (select a.zone, a.price as x, b.price as y from hourly a join hourly b on b.zone = a.zone and b.timestamp = a.timestamp + interval 1 hour)
    select zone, count(*) as n, round(corr(x, y), 6) as correlation, round(avg(abs(x - y)), 6) as mae from p group by 1""",
)
def source_agreement(spark, sf_dir):
    a = hourly(spark, sf_dir).select("zone", "timestamp", F.col("price").alias("x"))
    b = hourly(spark, sf_dir).select("zone", (F.col("timestamp") - F.expr("interval 1 hour")).alias("timestamp"), F.col("price").alias("y"))
    both = a.join(b, ["zone", "timestamp"])
    return both.groupBy("zone").agg(F.count(F.lit(1)).alias("n"), r6(F.corr("x", "y")).alias("correlation"), r6(F.avg(F.abs(F.col("x") - F.col("y")))).alias("mae"))


@query(
    "weather_zone_aggs",
    f"""with {READINGS_SQL}, z as (select zone, day, avg(temperature) as temperature_mean, min(temperature) as temperature_min, max(temperature) as temperature_max,
      avg(wind) as wind_mean, max(wind) as wind_max from readings group by 1, 2)
    select z.zone, z.day, round(z.temperature_mean, 6) as temperature_mean, round(z.temperature_min, 6) as temperature_min, round(z.temperature_max, 6) as temperature_max, round(z.wind_mean, 6) as wind_mean,
      round(z.wind_max, 6) as wind_max, round(z.temperature_mean - y.temperature_mean, 6) as delta from z left join z y on y.zone = z.zone and y.day = z.day - 1""",
)
def weather_zone_aggs(spark, sf_dir):
    from tidemark.operators.features import zone_aggregates

    z = zone_aggregates(readings(spark, sf_dir), ["temperature", "wind"])
    before = z.select("zone", F.date_add("day", 1).alias("day"), F.col("temperature_mean").alias("before"))
    names = ("temperature_mean", "temperature_min", "temperature_max", "wind_mean", "wind_max")
    return z.join(before, ["zone", "day"], "left").select("zone", "day", *[r6(c).alias(c) for c in names], r6(F.col("temperature_mean") - F.col("before")).alias("delta"))


@query("missing_fraction", f"with {READINGS_SQL} select zone, day, round(sum((temperature is null)::int + (wind is null)::int + (cloud is null)::int) / (count(*) * 3), 6) as missing_frac from readings group by 1, 2")
def missing_fraction(spark, sf_dir):
    from tidemark.operators.features import zone_aggregates

    return zone_aggregates(readings(spark, sf_dir), ["temperature", "wind", "cloud"]).select("zone", "day", r6("missing_frac").alias("missing_frac"))
