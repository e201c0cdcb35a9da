"""Known answers, injected faults and invariants."""

from __future__ import annotations

import datetime as dt
import json
import statistics
from hashlib import md5

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions import timeutils as t
from tidemark.operators import backtest, features, forecast, lake, metrics, ml, quality, serving, stats
from tidemark.plans.feeds import QCOLS, QS, readings
from tidemark.sources import readers
from tidemark.sources.versions import Conflict, VersionedTable
from tidemark.streaming import streams


def hours(spark, first: str, n: int, zone: str = "a"):
    return spark.range(n).select(F.lit(zone).alias("zone"), (F.lit(first).cast("timestamp") + F.make_dt_interval(hours=F.col("id").cast("int"))).alias("timestamp"), F.col("id").cast("double").alias("price"))


@pytest.mark.parametrize(("day", "n"), [("2025-03-30", 23), ("2025-10-26", 25), ("2024-06-01", 24)])
def test_expected_periods(spark, day, n):
    row = t.expected_periods(spark.sql(f"select date '{day}' as day")).first()
    assert (row.n_pt60m, row.n_pt15m) == (n, 4 * n)


def test_target_hours_on_clock_changes(spark):
    days = spark.sql("select explode(array(date '2025-03-29', date '2025-10-25')) as origin_date")
    counts = {r.origin_date.isoformat(): r["count"] for r in t.target_hours(days).groupBy("origin_date").count().collect()}
    assert counts == {"2025-03-29": 23, "2025-10-25": 25}


def test_same_local_hour_over_autumn_change(spark):
    rows = t.hour_occurrence(hours(spark, "2025-10-25 00:00:00", 72), ["zone"])
    out = features.same_local_hour(rows, rows, 1, "lag").where("local_date = '2025-10-27' and local_hour = 2").first()
    # 02:00 on the 26th occurs twice (00:00 and 01:00 UTC): the first one is taken.
    assert out.lag == 24.0


def test_spring_hour_that_does_not_exist(spark):
    rows = t.hour_occurrence(hours(spark, "2025-03-29 00:00:00", 72), ["zone"])
    out = features.same_local_hour(rows, rows, 1, "lag").where("local_date = '2025-03-31' and local_hour = 2").first()
    assert out.lag is None


def test_holidays(spark):
    days = {r.day.isoformat(): r for r in t.holiday_calendar(spark, "2024-01-01", "2024-12-31").collect()}
    assert all(days[d].is_public for d in ("2024-01-01", "2024-03-29", "2024-03-31", "2024-05-09", "2024-06-22", "2024-11-02"))
    assert days["2024-06-21"].is_custom and days["2024-04-30"].is_half and days["2024-05-10"].is_bridge
    assert not days["2024-03-28"].is_holiday and days["2024-03-28"].days_to == 1


@given(st.integers(1900, 2200))
@settings(max_examples=5, deadline=None)
def test_easter_is_a_sunday_in_range(spark, year):
    day = spark.range(1).select(t.easter(F.lit(year)).alias("d")).first().d
    assert day.weekday() == 6 and dt.date(year, 3, 22) <= day <= dt.date(year, 4, 25)


def test_availability(spark):
    row = hours(spark, "2025-03-30 22:00:00", 1).select(features.auction_availability().alias("a"), features.fixed_lead_availability("timestamp", 48, 6).alias("f")).first()
    assert row.a == dt.datetime(2025, 3, 30, 11)  # local 31 March: 13:00 on the 30th, summer time
    assert row.f == dt.datetime(2025, 3, 29, 4)


def test_injected_leak_is_caught(spark):
    keyed = t.hour_occurrence(hours(spark, "2025-03-01 00:00:00", 24 * 20), ["zone"]).withColumn("available_at", features.auction_availability())
    origin = F.lit("2025-03-15 08:00:00").cast("timestamp")
    noisy = features.perturb_unavailable(keyed, origin, 3).withColumn("price", F.coalesce("price", F.lit(-1.0)))

    def leaky(df):
        rows = features.origin_dataset(df.drop("available_at")).where(F.col("origin") == origin)
        return rows.withColumn("tomorrow", F.col("y") * 2)

    found = {r.column: r.leaks for r in features.leakage_audit(leaky(keyed), leaky(noisy)).collect()}
    assert found["tomorrow"] and not any(v for c, v in found.items() if c != "tomorrow")


def test_latest_per_key_and_change_log(spark):
    rows = [(1, 1, "s1", 1, 10.0, True), (1, 2, "s2", 2, 11.0, True), (1, 3, "s3", 3, 99.0, False), (2, 1, "s1", 4, None, True), (2, 2, "s2", 5, None, True)]
    pulls = spark.createDataFrame(rows, "k int, p int, snapshot string, seq int, v double, valid boolean").withColumn("pulled_at", F.timestamp_seconds("p")).drop("p")
    assert {r.k: r.v for r in lake.latest_per_key(pulls, ["k"]).collect()} == {1: 11.0, 2: None}
    log = lake.change_log(pulls.where("valid"), ["k"], ["v"]).collect()
    assert [(r.k, r.old, r.new, r.old_snapshot, r.new_snapshot) for r in log] == [(1, 10.0, 11.0, "s1", "s2")]


def test_stores(spark, tmp_path):
    df = hours(spark, "2024-12-31 20:00:00", 8)
    root = f"file://{tmp_path}/silver"
    lake.write_silver(df, root)
    lake.write_silver(df.where("year(timestamp) = 2025").withColumn("price", F.lit(1.0)), root)
    assert {r.year: r.p for r in lake.read_silver(spark, root).groupBy("year").agg(F.max("price").alias("p")).collect()} == {2024: 3.0, 2025: 1.0}
    assert lake.write_dataset(df, f"file://{tmp_path}/ds", "a", "k", "t1") == lake.write_dataset(df.orderBy(F.rand()), f"file://{tmp_path}/ds", "a", "k", "t2")
    manifest = lake.write_snapshot(df, f"file://{tmp_path}/raw", "s", "d", "k", "1", True).first()
    assert manifest.row_count == 8
    assert (str(manifest.data_start), str(manifest.data_end)) == ("2024-12-31 20:00:00", "2025-01-01 03:00:00")
    with pytest.raises(lake.Refused, match="stored already"):
        lake.write_snapshot(df, f"file://{tmp_path}/raw", "s", "d", "k", "1", True)
    other = lake.write_dataset(df.withColumn("extra", F.lit(1)), f"file://{tmp_path}/ds", "a", "k", "t3")
    assert [(r.version, r.built_at) for r in lake.dataset_manifest(spark, f"file://{tmp_path}/ds").orderBy("built_at").collect()][1] == (other, "t3")
    assert lake.read_dataset(spark, f"file://{tmp_path}/ds", other).columns == [*df.columns, "extra"]


def test_a_reader_sees_the_old_or_the_new_version(spark, tmp_path):
    root = f"file://{tmp_path}/silver"
    df = hours(spark, "2024-12-31 20:00:00", 8)
    lake.write_silver(df.limit(0), root)
    empty = lake.read_silver(spark, root)
    assert empty.count() == 0 and empty.columns == [*df.columns, "year"]
    lake.write_silver(df, root)
    held = lake.read_silver(spark, root)  # planned before the replace, run after it
    lake.write_silver(df.withColumn("price", F.lit(-1.0)), root)
    assert held.agg(F.min("price")).first()[0] == 0.0 and lake.read_silver(spark, root).agg(F.max("price")).first()[0] == -1.0
    assert lake.read_silver(spark, root, 2).agg(F.min("price")).first()[0] == 0.0
    # A write that is killed half-way leaves files that no version names.
    table = VersionedTable(spark, root)
    before = table.manifest()

    @F.udf("double")
    def fail(x):
        raise RuntimeError("killed")

    with pytest.raises(Exception, match="killed"):
        lake.write_silver(df.withColumn("price", fail("price")), root)
    assert table.manifest() == before and lake.read_silver(spark, root).count() == 8
    table.vacuum(keep=1)
    assert table.versions() == [before["version"]] and lake.read_silver(spark, root).count() == 8
    assert {p.name for p in (tmp_path / "silver" / "data").iterdir()} == {p["path"].split("/")[1] for p in before["parts"]}


def test_of_two_writers_one_gets_a_conflict(spark, tmp_path):
    table = VersionedTable(spark, f"file://{tmp_path}/t")
    df = spark.range(3)
    first, second = table.manifest(), table.manifest()
    table.commit(first, [table.write(df)], df.schema)
    with pytest.raises(Conflict):
        table.commit(second, [table.write(df)], df.schema)
    assert table.update(lambda m: [*m["parts"], table.write(df)], df.schema)["version"] == 2
    assert table.read(table.manifest()).count() == 6 and not list((tmp_path / "t" / "commits").glob(".*json"))


def test_refused_rows_are_not_committed(spark, tmp_path):
    table = VersionedTable(spark, f"file://{tmp_path}/t")
    df, limits = spark.range(5), {"negative": F.col("id") < 0, "large": F.col("id") > 3, "null": F.col("id").isNull()}
    with pytest.raises(lake.Refused, match="'large': 1"):
        lake.commit_checked(df, table, limits, lambda m, part: [part])
    assert table.versions() == [] and not list((tmp_path / "t" / "data").iterdir())
    lake.commit_checked(df.where("id < 4"), table, limits, lambda m, part: [part])
    assert table.read(table.manifest()).count() == 4


def test_readers(spark, tmp_path):
    (tmp_path / "2025-10-26_SE3.json").write_text(json.dumps([{"SEK_per_kWh": 0.5, "EUR_per_kWh": 0.04567, "EXR": 11.0, "time_start": f"2025-10-26T02:00:00+0{o}:00", "time_end": f"2025-10-26T03:00:00+0{o}:00"} for o in (2, 1)]))
    rows = readers.read_day_prices(spark, f"file://{tmp_path}/2025-10-26_SE3.json").orderBy("timestamp").collect()
    assert [(r.zone, r.timestamp.hour, r.price_eur_mwh, r.resolution) for r in rows] == [("SE3", 0, 45.67, "PT60M"), ("SE3", 1, 45.67, "PT60M")]
    (tmp_path / "w.json").write_text(json.dumps({"latitude": 59.0, "longitude": 18.0, "hourly": {"time": [0, 3600], "t": [1.5, "x"]}}))
    rows = readers.read_hourly_arrays(spark, f"file://{tmp_path}/w.json", ["t"]).orderBy("timestamp").collect()
    assert [r.t for r in rows] == [1.5, None]
    with pytest.raises(ValueError, match="lacks"):
        readers.explode_arrays(spark.sql("select struct(array(1L) as time) as hourly"), "hourly", ["t"], [])
    out = readers.normalise_series(spark.sql("select timestamp '2024-01-01' as timestamp, '1.5' as `Wind Speed`"))
    assert out.columns == ["timestamp", "wind_speed"] and out.first().wind_speed == 1.5


def test_contracts(spark):
    df = spark.sql("select 1 as a, 'x' as b")
    quality.assert_contract(df, df.schema)
    with pytest.raises(ValueError, match="b: missing"):
        quality.assert_contract(df.drop("b"), df.schema)
    with pytest.raises(ValueError, match="no rule"):
        quality.rule_for("snow", {"wind_": quality.Rule("wind_", 0, 90)})
    with pytest.raises(ValueError):
        t.quantile_label(0.333)
    with pytest.raises(ValueError):
        backtest.select_origins(spark.sql("select date '2024-01-01' as origin_date"), "2024-01-01", "2024-02-01", 14)


def test_day_counts(spark):
    rows = hours(spark, "2025-03-28 23:00:00", 95)  # the spring change is inside, nothing is missing
    assert quality.day_count_errors(rows, ["zone"]).count() == 0
    found = quality.day_count_errors(rows.where("price <> 30"), ["zone"]).collect()
    assert [(r.day.isoformat(), r.n_rows, r.expected) for r in found] == [("2025-03-30", 22, 23)]
    assert [r.n_hours for r in quality.gap_runs(quality.missing_hours(rows.where("price not in (5, 6, 9)"), ["zone"]), ["zone"]).orderBy("run_no").collect()] == [2, 1]


def test_day_counts_by_resolution(spark):
    per_day = {"2025-03-29": ("PT60M", 24), "2025-03-30": ("PT60M", 23), "2025-03-31": ("PT15M", 24), "2025-04-01": (None, 24), "2025-04-02": ("PT30M", 24)}
    rows = hours(spark, "2025-03-27 23:00:00", 24 * 9).withColumn("day", t.local_date("timestamp"))
    named = F.create_map(*[F.lit(x) for d, (r, _) in per_day.items() for x in (d, r)])
    rows = rows.withColumn("resolution", F.coalesce(named[F.col("day").cast("string")], F.when(F.col("day") > "2025-04-01", "PT60M")))
    mixed = rows.withColumn("resolution", F.when((F.col("day") == "2025-04-04") & (F.hour("timestamp") < 5), "PT15M").otherwise(F.col("resolution")))
    found = {str(r.day): (r.n_rows, r.expected) for r in quality.day_count_errors(mixed, ["zone"], resolution="resolution").collect()}
    assert found == {"2025-03-31": (24, 96), "2025-04-02": (24, None), "2025-04-04": (24, None)}
    gap = quality.day_count_errors(mixed.where("day <> '2025-03-29'"), ["zone"], resolution="resolution", quarter_hours_since="2025-03-29").where("day = '2025-03-29'").first()
    assert (gap.n_rows, gap.expected) == (0, 96)


@given(st.lists(st.floats(-100, 100), min_size=3, max_size=3), st.floats(-100, 100))
@settings(max_examples=10, deadline=None)
def test_pinball_is_not_negative_and_quantiles_sort(spark, qs, y):
    df = spark.createDataFrame([(y, *qs)], "y double, q05 double, q50 double, q95 double")
    loss = df.select(*[forecast.pinball(F.col("y"), F.col(c), q).alias(c) for c, q in (("q05", 0.05), ("q50", 0.5), ("q95", 0.95))]).first()
    assert min(loss) >= 0
    out = forecast.sort_quantiles(df, ["q05", "q50", "q95"]).first()
    assert out.q05 <= out.q50 <= out.q95 and out.was_crossing == (sorted(qs) != qs)


def test_known_pinball(spark):
    row = spark.range(1).select(forecast.pinball(F.lit(20.0), F.lit(10.0), 0.9).alias("a"), forecast.pinball(F.lit(10.0), F.lit(20.0), 0.9).alias("b")).first()
    assert (round(row.a, 9), round(row.b, 9)) == (9.0, 1.0)


def test_gaussian_coverage(spark):
    z = [forecast.NORMAL[q] for q in QS]
    df = spark.range(20_000).select(F.lit("m").alias("model"), F.lit("a").alias("zone"), (50 + 10 * F.randn(5)).alias("y"), *[F.lit(50 + 10 * x).alias(c) for x, c in zip(z, QCOLS)])
    row = metrics.forecast_metrics(df, QS, ["model"]).first()
    assert abs(row.coverage_80 - 0.8) < 0.015 and abs(row.coverage_90 - 0.9) < 0.015


def test_recalibration_removes_bias(spark):
    base = spark.range(24 * 30).select(F.lit("m").alias("model"), F.lit("a").alias("zone"), F.date_add(F.lit("2024-01-01"), (F.col("id") / 24).cast("int")).alias("target_date"), F.lit(10.0).alias("y"), *[F.lit(7.0).alias(c) for c in QCOLS])
    out = forecast.recalibrate(base.withColumn("origin_date", F.date_sub("target_date", 1)), list(QCOLS), QS)
    by_day = {r.target_date.isoformat(): r.q50 for r in out.select("target_date", "q50").distinct().collect()}
    assert by_day["2024-01-05"] == 7.0 and by_day["2024-01-30"] == 10.0


def test_weights_follow_the_better_member(spark):
    rows = spark.range(24 * 20).select(F.lit("a").alias("zone"), F.date_add(F.lit("2024-01-01"), (F.col("id") / 24).cast("int")).alias("target_date"), F.col("id").alias("target_time"), (F.col("id") % 24).alias("cal_hour"), F.lit(10.0).alias("y"))
    rows = rows.withColumn("origin_date", F.date_sub("target_date", 1)).withColumn("members", F.array(*[F.array(*[F.lit(v)] * 7) for v in (30.0, 10.0, 40.0)]))
    grid = forecast.simplex_grid(spark, 3, 10)
    for weighting, grp in (("hourly", 3), ("global", -1)):
        weights = forecast.ensemble_weights(rows, grid, list(QCOLS), QS, weighting)
        found = {r.origin_date.isoformat(): (r.w1, r.w2, r.w3) for r in weights.where(F.col("grp") == grp).collect()}
        assert found["2024-01-05"] == (1 / 3,) * 3 and found["2024-01-20"] == (0.0, 1.0, 0.0)
    equal = forecast.ensemble_weights(rows, grid, list(QCOLS), QS, "equal")
    assert {(r.grp, r.w1, r.w2, r.w3) for r in equal.collect()} == {(-1, *(1 / 3,) * 3)}
    mixed = forecast.ensemble_combine(rows, equal, list(QCOLS), "equal").select("q50").distinct().collect()
    assert [round(r.q50, 9) for r in mixed] == [round(80 / 3, 9)]


def test_decomposition_knows_the_weekday_and_the_trend(spark):
    keyed = t.hour_occurrence(hours(spark, "2025-01-05 23:00:00", 24 * 70), ["zone"])
    day = F.datediff("local_date", F.lit("2025-01-06"))
    keyed = keyed.withColumn("price", 100 + 2.0 * day + F.when(F.weekday("local_date") >= 5, -30.0).otherwise(0.0) + F.col("local_hour"))
    out = forecast.seasonal_decomposition(features.origin_dataset(keyed), keyed, QS).where("origin_date = '2025-03-14'").select("target_date", "y", "q05", "q50", "q95").collect()
    # The effects of a context of whole weeks are exact; the deviation of the first days from their short trend is long past.
    assert len(out) == 24 and all(abs(r.q50 - r.y) < 1e-6 for r in out) and all(abs(r.q95 - r.q05) < 1e-3 for r in out)


def test_live_rows_have_no_prices_yet(spark):
    keyed = t.hour_occurrence(hours(spark, "2025-03-09 23:00:00", 24 * 20), ["zone"])
    last = keyed.groupBy("zone").agg(F.max("local_date").alias("origin_date"))
    rows = features.live_rows(keyed, last).collect()  # the target day is one of 23 hours
    assert len(rows) == 23 and all(r.y is None and r.p_lag7d is not None and r.cal_hours_in_day == 23 for r in rows)
    past = last.select("zone", F.date_sub("origin_date", 3).alias("origin_date"))
    live = features.live_rows(keyed, past)
    whole = features.origin_dataset(keyed).join(past, ["zone", "origin_date"], "left_semi").select(live.columns)
    assert live.count() == 24 and live.exceptAll(whole).count() == 0


def test_bootstrap_and_dm(spark):
    rows = spark.range(60).select(F.lit("a").alias("zone"), F.date_add(F.lit("2024-01-01"), F.col("id").cast("int")).alias("target_date"), (5 + F.sin("id")).alias("loss_a"), (5.2 + F.cos("id")).alias("loss_b"))
    b = stats.block_bootstrap(rows, "loss_a", ["zone"], resamples=300).first()
    assert 4 < b.low <= b.mean <= b.high < 6
    one, two = stats.diebold_mariano(rows, ["zone"]).first(), stats.diebold_mariano(rows.select("zone", "target_date", F.col("loss_b").alias("loss_a"), F.col("loss_a").alias("loss_b")), ["zone"]).first()
    assert abs(one.statistic + two.statistic) < 1e-12
    p = spark.createDataFrame([(2.0, 10.0), (0.0, 5.0)], "t double, n double").select(stats.student_p("t", "n").alias("p")).collect()
    assert abs(p[0].p - 0.07338803) < 1e-7 and abs(p[1].p - 1) < 1e-12  # table values of Student's t


def test_quantile_forest(spark):
    rows = spark.range(2000).select(F.lit("a").alias("zone"), F.lit("2024-01-01").cast("date").alias("origin_date"), F.col("id").alias("target_time"), (F.col("id") % 24).cast("double").alias("x"), F.randn(3).alias("e")).withColumn("y", F.col("x") * 10 + F.col("e"))
    out, importance = ml.quantile_forest(rows.where("target_time < 1500"), rows.where("target_time >= 1500"), ["x", "e"], QS, trees=8, depth=5)
    scored = out.agg(F.avg((F.abs(F.col("q50") - F.col("y")) < 15).cast("double")).alias("near"), F.avg((F.col("q05") <= F.col("q95")).cast("double")).alias("sorted")).first()
    assert scored.near > 0.9 and scored.sorted == 1.0
    assert ml.mean_importance([importance, importance]).count() == 2


def test_quantiles_of_pooled_leaves(spark):
    """Against a plain forest: training rows weighted by 1 / leaf size, over the same trees."""
    rows = spark.range(3000).select(F.lit("a").alias("zone"), F.lit("2024-01-01").cast("date").alias("origin_date"), F.col("id").alias("target_time"), (F.col("id") * 7919 % 1000 / 100).alias("x"), (F.col("id") * 31 % 17).cast("double").alias("z"))
    rows = rows.withColumn("y", F.col("x") * F.col("x") + F.col("z") * (F.col("target_time") * 13 % 29 / 10))
    train, new = rows.where("target_time < 2900"), rows.where("target_time >= 2900")
    params = {"depth": 5, "trees": 6, "min_rows": 5, "seed": 3}
    fitted = ml.fit_forest(train, ["x", "z"], **params)
    leaf = {}
    for r in fitted.leaves(train).collect():
        leaf.setdefault((r._tree, r._node), []).append(r.y)
    near = {}
    for r in fitted.leaves(new).collect():
        near.setdefault(r.target_time, []).append(sorted(leaf[r._tree, r._node]))
    found, _ = ml.quantile_forest(train, new, ["x", "z"], (0.05, 0.5, 0.9), **params)
    for r in found.collect():
        leaves = near[r.target_time]
        for q, name in ((0.05, "q05"), (0.5, "q50"), (0.9, "q90")):
            below = sum(sum(v < r[name] - 1e-9 for v in vs) / len(vs) for vs in leaves) / len(leaves)
            up_to = sum(sum(v <= r[name] + 1e-9 for v in vs) / len(vs) for vs in leaves) / len(leaves)
            assert below - 0.03 <= q <= up_to + 0.03


def search_rows(spark):
    rows = spark.range(1500).selectExpr("if(id % 2 = 0, 'a', 'b') as zone", "timestamp_seconds(id * 3600) as target_time", "date_add(date'2024-01-01', cast(id / 50 as int)) as target_date", "cast(id * 7919 % 1000 as double) / 100 as x", "cast(id * 31 % 17 as double) as z", "if(id % 40 = 0, null, cast(id % 7 as double)) as w", "id")
    return rows.withColumn("y", F.col("x") * F.col("x") + F.col("z") * (F.col("id") * 13 % 29 / 10)).drop("id")


FOLDS = [(f"2024-01-{d:02d}", f"2024-01-{d + 1:02d}", f"2024-01-{d + 2:02d}") for d in (12, 16, 20, 24)]
POINTS = [{"depth": d, "trees": n, "min_rows": m} for d in (1, 4) for n in (2, 5) for m in (5, 40)]


def test_grid_search_equals_single_fits(spark):
    """All points and folds at once give what each point gives by itself, and each fold adds its own rows."""
    rows = search_rows(spark)
    found = {r.point: r for r in ml.grid_search(rows, FOLDS, POINTS, ["x", "z", "w"], QS).collect()}
    assert sorted(found) == list(range(8)) and {r.n for r in found.values()} == {400}
    for i in (0, 5, 7):
        alone = ml.grid_search(rows, FOLDS, [POINTS[i]], ["x", "z", "w"], QS).first()
        assert alone.pinball == pytest.approx(found[i].pinball) and (alone.depth, alone.trees, alone.min_rows) == tuple(POINTS[i].values())
    per_fold = [ml.grid_search(rows, [f], [POINTS[6]], ["x", "z", "w"], QS).first() for f in FOLDS]
    assert sum(r.pinball * r.n for r in per_fold) / 400 == pytest.approx(found[6].pinball)
    # Deeper trees do better here; the future has no part in it.
    assert min(r.pinball for r in found.values() if r.depth == 4) < min(r.pinball for r in found.values() if r.depth == 1)
    changed = rows.withColumn("y", F.when(F.col("target_date") > "2024-01-26", -1e6).otherwise(F.col("y"))).withColumn("x", F.when(F.col("target_date") > "2024-01-26", 0.0).otherwise(F.col("x")))
    assert ml.grid_search(changed, FOLDS, [POINTS[6]], ["x", "z", "w"], QS).first().pinball == pytest.approx(found[6].pinball)


def test_splits_against_a_scan(spark):
    """The split of a root by histograms is the one that trying all of them finds."""
    base = ml.binned_folds(search_rows(spark), FOLDS[:1], ["x", "z", "w"]).where("train")
    root = base.select("fold", F.lit(20).alias("min_rows"), F.lit(0).alias("tree"), F.lit(1).cast("long").alias("node"), "y", "bins")
    plain, drawn = [(r.y, r.bins) for r in root.collect()], {r.f for r in spark.range(3).select(F.col("id").cast("int").alias("f")).where(F.pmod(F.xxhash64(F.lit(4), F.lit(0), F.lit(1).cast("long"), "f"), F.lit(3)) < 2).collect()}
    best = None
    for f in sorted(drawn):
        for b in range(ml.BINS):
            left, right = [y for y, bins in plain if bins[f] <= b], [y for y, bins in plain if bins[f] > b]
            if min(len(left), len(right)) >= 20:
                gain = round(sum(left) ** 2 / len(left) + sum(right) ** 2 / len(right) - sum(left + right) ** 2 / len(plain), 6)
                best = max(best, (gain, -f, -b)) if best else (gain, -f, -b)
    row = ml.best_splits(root, 4).first()
    gain = lambda f, b: sum(sum(s) ** 2 / len(s) for s in ([y for y, bins in plain if bins[f] <= b], [y for y, bins in plain if bins[f] > b]))
    assert gain(row.feature, row.bin) == pytest.approx(gain(-best[1], -best[2]))


def test_backtest_trains_on_the_past_only(spark):
    rows = features.origin_dataset(t.hour_occurrence(hours(spark, "2025-01-20 00:00:00", 24 * 30), ["zone"]))
    schedule = backtest.refit_schedule(rows.select("zone", "origin_date").distinct(), ["zone"])
    seen = []

    def last_price(train, todo):
        assert "y" not in todo.columns
        level = train.agg(F.max("y")).first()[0]
        seen.append((train.agg(F.max("target_date")).first()[0], level))
        return todo.withColumn("q05", F.lit(level) + 1).withColumn("q95", F.lit(level) - 1)

    first = rows.agg(F.min("target_date")).first()[0]
    later = schedule.where(F.col("fit_origin") >= first)
    out = backtest.backtest(last_price, rows, later, ["q05", "q95"])
    assert out.where("was_crossing and q05 < q95").count() == out.count() > 0
    fits = [r.fit_origin for r in later.select("fit_origin").distinct().orderBy("fit_origin").collect()]
    assert all(day <= fit for (day, _), fit in zip(seen, fits))
    with pytest.raises(Exception, match="null q05"):
        backtest.backtest(lambda train, todo: todo.withColumn("q05", F.lit(None).cast("double")), rows, later, ["q05"]).collect()


def test_empty_tables(spark):
    none = hours(spark, "2024-01-01 00:00:00", 0)
    keyed = t.hour_occurrence(none, ["zone"])
    assert features.origin_dataset(keyed).count() == 0
    assert quality.day_count_errors(none, ["zone"]).count() == 0
    assert backtest.gap_fill_linear(none, "price", ["zone"]).count() == 0


def test_times_without_a_zone_are_refused(spark):
    rows = hours(spark, "2025-01-01 00:00:00", 2)
    assert t.ensure_utc(rows, "timestamp") is rows
    for column in ("naive", "zone", "absent"):
        with pytest.raises(ValueError):
            t.ensure_utc(rows.withColumn("naive", F.col("timestamp").cast("timestamp_ntz")), column)


def test_variants_and_evaluation_rows(spark):
    assert backtest.variant("forest", train_start="2024-01-01", seed=3, calibration=None) == "forest@seed=3@train_start=2024-01-01"
    for spec in ({"seed": "1@x"}, {"seed": "a=b"}):
        with pytest.raises(ValueError):
            backtest.variant("forest", **spec)
    rows = spark.sql("select explode(sequence(date '2025-01-01', date '2025-01-05')) as origin_date, 1 as y")
    live = spark.sql("select cast(null as int) as y, date '2025-01-04' as origin_date")
    found = backtest.evaluation_rows(rows, live, "2025-01-04").orderBy("origin_date").collect()
    assert [(r.origin_date.day, r.y) for r in found] == [(1, 1), (2, 1), (3, 1), (4, None)]


def test_digest_depends_on_rows_and_names_alone(spark):
    rows = spark.createDataFrame([(1, "x"), (2, None), (2, None)], "a int, b string")
    digest = lambda df: lake.content_digest(df).first()
    assert digest(rows) == digest(rows.orderBy(F.desc("a")).select("b", "a").repartition(3))
    others = [rows.distinct(), rows.withColumnRenamed("b", "c"), rows.withColumn("a", F.col("a") + 1), rows.fillna("x")]
    assert len({tuple(digest(df)) for df in [rows, *others]}) == 5


def test_order_of_arrival_across_chunks(spark):
    rows = spark.sql("select 'a' as zone, id as seq, timestamp_seconds(case when id in (4, 7) then 0 else id * 60 end) as timestamp from range(10) union all select 'b', 1, null")
    for chunk in (None, F.floor(F.col("seq") / 2), F.floor(F.col("seq") / 4), F.col("seq")):
        found = {r.zone: (r.n_back, r.n_null) for r in quality.not_monotone(rows, ["zone"], ["seq"], chunk=chunk).collect()}
        assert found == {"a": (2, 0), "b": (0, 1)}


def test_forecast_store_keeps_what_was_written(spark, tmp_path):
    first = spark.createDataFrame([("a", 1, 1.0), ("a", 2, 2.0)], "zone string, origin int, q50 double")
    again = spark.createDataFrame([("a", 2, 9.0), ("a", 3, 3.0)], "zone string, origin int, q50 double")
    root = str(tmp_path / "forecasts")
    assert lake.store_new(first, root, ["zone", "origin"]).count() == 2
    for _ in range(2):
        found = lake.store_new(again, root, ["zone", "origin"])
        assert found.dtypes == again.dtypes
        assert sorted(map(tuple, found.collect())) == [("a", 2, 2.0), ("a", 3, 3.0)]
    with pytest.raises(ValueError, match="mix"):
        serving.stored_losses(spark.createDataFrame([("a", "m", 1, 1.0, "v1"), ("a", "n", 1, 1.0, "v2")], "zone string, model string, target_date int, pinball double, dataset_version string"))


def test_silver_stream_logs_changes_and_repeats_batches(spark, tmp_path):
    schema = "part int, pulled_at timestamp, snapshot string, seq int, price double, valid boolean"
    source, out, state = (str(tmp_path / d) for d in ("in", "out", "state"))

    def arrive(*rows):
        lines = [f"({p}, timestamp'2024-01-0{d} 00:00:00', 's{d}', {d}, {price}D, {str(ok).lower()})" for p, d, price, ok in rows]
        spark.sql(f"select * from values {', '.join(lines)} as t(part, pulled_at, snapshot, seq, price, valid)").coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
        table = streams.stream_silver(spark, stream, ["part"], out, state, values=["price"])
        return {r.part: (r.seq, r.price) for r in table.collect()}

    table = VersionedTable(spark, out)
    rows = lambda kind: [p["rows"] for p in streams.parts_of(table.manifest(), kind)]
    assert arrive(*[(p, 1, float(p), True) for p in range(100)]) == {p: (1, float(p)) for p in range(100)}
    assert arrive((3, 2, 30.0, True), (3, 3, 31.0, True), (4, 2, 40.0, False))[3] == (3, 31.0)
    assert rows("run") == [100, 1]  # a batch of one key writes one row
    found = arrive((3, 2, 30.0, True), (5, 4, 5.0, True))
    assert (found[3], found[4], found[5]) == ((3, 31.0), (1, 4.0), (4, 5.0)) and len(found) == 100
    changes = streams.silver_changes(spark, out).orderBy("new_pulled_at").collect()
    assert [(r.part, r.old, r.new) for r in changes if r.old_snapshot < r.new_snapshot][:2] == [(3, 3.0, 30.0), (3, 30.0, 31.0)]
    assert rows("run") == [100, 2]  # the run of one row was merged with that of two
    # A batch whose commit was lost runs again and changes nothing.
    before = table.manifest()
    for log in (tmp_path / "state" / "commits").glob("*2*"):
        log.unlink()
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    assert {r.part: (r.seq, r.price) for r in streams.stream_silver(spark, stream, ["part"], out, state, values=["price"]).collect()} == found
    assert table.manifest() == before


def test_runs_fold_by_size():
    sizes, written = [], 0
    for _ in range(1000):
        sizes.append(1)
        written += 1
        at = streams.foldable(sizes)
        if len(sizes) - at > 1:
            written += sum(sizes[at:])
            sizes[at:] = [sum(sizes[at:])]
    assert len(sizes) <= 11 and written < 1000 * 11 and streams.foldable([]) <= 0


def test_mixed_types_are_logged_as_json(spark):
    rows = [("s1", 1, 1.5, "a"), ("s2", 2, None, 'q"'), ("s3", 3, None, None)]
    pulls = spark.createDataFrame([(1, *r) for r in rows], "k int, snapshot string, seq int, x double, y string").withColumn("pulled_at", F.timestamp_seconds("seq"))
    log = lake.change_log(pulls, ["k"], ["x", "y"]).collect()
    assert sorted((r.column, r.old, r.new) for r in log) == [("x", "1.5", "null"), ("y", '"a"', '"q\\""'), ("y", '"q\\""', "null")]


def test_statistics_up_to_the_last_price(spark):
    """Days without prices, a gap longer than the window, and the windows' borders, against the plain definition."""
    rows = hours(spark, "2025-03-20 00:00:00", 24 * 25).withColumn("price", F.when(F.col("price").between(100, 130) | F.col("price").between(260, 480) | (F.col("price") % 7 == 3), None).otherwise((F.col("price") * 37) % 101))
    rows = rows.unionByName(hours(spark, "2025-03-29 05:00:00", 30, "b").withColumn("price", F.lit(3.7)))
    plain = sorted(((r.zone, r.timestamp, r.day, r.price) for r in rows.withColumn("day", t.local_date("timestamp")).collect()), key=str)
    for size in (24, 168):
        found = {(r[0], r[1]): r[2:] for r in features.rolling_stats(rows, size).collect()}
        for zone, day in {(z, d) for z, _, d, _ in plain}:
            known = [(ts, p) for z, ts, d, p in plain if z == zone and d <= day and p is not None]
            if not known:
                assert (zone, day) not in found
                continue
            last = max(known)[0]
            window = [p for ts, p in known if ts > last - dt.timedelta(hours=size)]
            want = [sum(window) / len(window), min(window), max(window)]
            assert list(found[zone, day][:3]) == pytest.approx(want)
            assert found[zone, day][3] == (pytest.approx(statistics.stdev(window), abs=1e-9) if len(window) > 1 else None)
    wanted = spark.sql("select 'a' as zone, date'2025-06-01' as day union all select 'c', date'2025-06-01' union all select 'a', date'2025-03-01'")
    assert [(r.zone, r.day.month) for r in features.rolling_stats(rows, 24, days=wanted).collect()] == [("a", 6)]


def test_features_after_a_long_gap(spark):
    """Live rows read as far back as the last price is; a dataset has the same statistics."""
    rows = hours(spark, "2025-01-01 00:00:00", 24 * 40).withColumn("price", F.when(F.col("price") < 24 * 10, F.col("price")))
    rows = t.hour_occurrence(rows, ["zone"])
    live = features.live_rows(rows, spark.sql("select 'a' as zone, date'2025-02-05' as origin_date")).select("p_roll24h_mean", "p_lag1d", "y").distinct().collect()
    assert [tuple(r) for r in live] == [(227.5, None, None)]


@pytest.mark.parametrize("gap", [0, 10, 70])
def test_naive_errors_up_to_the_last_training_day(spark, gap):
    """However long ago the last training day is, a fit reads the ``residual_days`` up to it."""
    n = 150
    rows = spark.range(n).where((F.col("id") < 100 - gap) | (F.col("id") >= 101)).selectExpr("'a' as zone", "date_add(date'2025-01-01', cast(id as int)) as target_date", "date_add(date'2024-12-31', cast(id as int)) as origin_date", "7 as cal_hour", "cast(id * id % 13 as double) as y", "0D as p_lag1d", "1D as p_samehour_mean7d", "1D as p_dayD_mean", "timestamp_seconds(id * 86400) as target_time")
    fit = dt.date(2025, 1, 1) + dt.timedelta(days=100)
    schedule = rows.where(F.col("target_date") > F.lit(fit)).select("zone", "origin_date", F.lit(fit).alias("fit_origin"))
    found = forecast.seasonal_naive(rows, schedule, 1, (0.5,), 56).select("q50").distinct().collect()
    past = [i * i % 13 for i in range(100 - gap)][-56:]
    assert [r.q50 for r in found] == [statistics.median(past)]


def test_rolling_quantiles_read_an_error_once(spark):
    plan = forecast.rolling_quantiles(spark.range(10).selectExpr("1 as k", "current_date() as d", "1D as e"), spark.sql("select 1 as k, current_date() as d"), ["k"], "d", 28, [("q", "e", 0.5)])
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in text and "Join" not in text


def test_as_of_totals(spark):
    rows = spark.range(300).selectExpr("if(id % 3 = 0, 'a', 'b') as zone", "timestamp_seconds(1700000000 + id * 3600) as timestamp", "timestamp_seconds(1700000000 + (id * 7919 % 300) * 5000) as available_at", "if(id % 11 = 0, null, cast(id * 31 % 17 as double)) as price")
    origins = spark.range(60).selectExpr("if(id % 2 = 0, 'a', 'c') as zone", "timestamp_seconds(1699990000 + id * 25000) as origin")
    plain = [tuple(r) for r in rows.collect()]
    for r in features.as_of_totals(rows, origins).collect():
        seen = [(ts, p) for z, ts, at, p in plain if z == r.zone and at <= r.origin]
        prices = [p for _, p in seen if p is not None]
        assert (r.n_rows, r.last_time, r.n_values, r.least, r.most) == (len(seen), max((ts for ts, _ in seen), default=None), len(prices), min(prices, default=None), max(prices, default=None))
        assert r.total == (pytest.approx(sum(prices)) if prices else None)
    assert features.as_of_totals(rows, origins).count() == 60


@given(st.lists(st.one_of(st.none(), st.integers(-9, 9).map(float)), max_size=60), st.sampled_from([0.0, 0.1, 0.5, 0.9, 1.0]), st.integers(0, 5))
@settings(max_examples=200, deadline=None)
def test_quantiles_of_earlier_values(values, q, warmup):
    for i, found in enumerate(metrics.earlier_quantiles(values, q, warmup)):
        past = sorted(v for v in values[:i] if v is not None)
        if len(past) < max(1, warmup):
            assert found is None
            continue
        at = q * (len(past) - 1)
        low = past[int(at)]
        assert found == pytest.approx(low + (past[min(int(at) + 1, len(past) - 1)] - low) * (at - int(at)))


def test_live_rows_with_new_nulls_or_columns_are_refused(spark, tmp_path):
    keyed = t.hour_occurrence(hours(spark, "2025-03-01 00:00:00", 24 * 30), ["zone"])
    reference = features.origin_dataset(keyed.where("local_date < '2025-03-28'"))
    reference = reference.where("p_lag8d is not null and p_dayD_trend is not null")
    live = features.live_rows(keyed, spark.sql("select 'a' as zone, date'2025-03-26' as origin_date"))
    root = f"file://{tmp_path}/live"
    with pytest.raises(ValueError, match="extra"):
        features.store_live_rows(live.withColumn("extra", F.lit(1)), reference, root)
    with pytest.raises(lake.Refused, match="'p_lag2d': 1"):
        features.store_live_rows(live.withColumn("p_lag2d", F.when(F.col("cal_hour") != 5, F.col("p_lag2d"))), reference, root)
    table = VersionedTable(spark, root)
    assert table.versions() == []
    # What the reference lacks at that hour may be missing, and so may columns that are named.
    some = reference.withColumn("p_lag2d", F.when((F.col("cal_hour") != 5) | (F.dayofmonth("target_date") != 20), F.col("p_lag2d")))
    features.store_live_rows(live.withColumns({"p_lag2d": F.when(F.col("cal_hour") != 5, F.col("p_lag2d")), "p_lag7d": F.lit(None).cast("double")}), some, root, nullable=("p_lag7d",))
    features.store_live_rows(live, reference, root)  # replaces the rows of the same origin
    stored = table.read(table.manifest())
    assert stored.count() == 24 and stored.columns == live.columns and stored.where("p_lag7d is null").count() == 0


def test_gaps_are_filled_across_days(spark):
    """Against a plain interpolation: carries over several days, both ends, double rows, the trailing context."""
    values = {h: float(h * h % 50) for h in [3, 4, 90, 91, 100, 160]}
    rows = [("a", h, 0, v) for h, v in values.items()] + [("a", 4, 1, 999.0), ("a", 95, 0, None), ("a", 95, 1, 7.0), ("a", 170, 0, None), ("b", 5, 0, None), ("b", 60, 0, None)]
    df = spark.createDataFrame(rows, "zone string, h int, seq int, price double").withColumn("timestamp", F.timestamp_seconds(F.col("h") * 3600))
    for context, pad, first in ((None, False, 3), (100, False, 90), (100, True, 71)):
        found = {(r.zone, int(r.timestamp.timestamp()) // 3600): (r.price, r.filled) for r in backtest.gap_fill_linear(df, "price", ["zone"], context_hours=context, arrival="seq", pad=pad).collect()}
        known = sorted(h for h in values if h >= first)
        for h in range(first, 171):
            below, above = [k for k in known if k <= h], [k for k in known if k >= h]
            want = values[below[-1]] if not above else values[above[0]] if not below else values[below[-1]] if below[-1] == above[0] else values[below[-1]] + (values[above[0]] - values[below[-1]]) * (h - below[-1]) / (above[0] - below[-1])
            assert found["a", h] == (pytest.approx(want), h not in known)
        assert min(h for z, h in found if z == "a") == first and {v for (z, _), v in found.items() if z == "b"} == {(None, True)}
    counts = backtest.count_fills(backtest.gap_fill_linear(df, "price", ["zone"], arrival="seq"), ["zone"])
    assert {r.zone: (r.n_hours, r.n_filled) for r in counts.collect()} == {"a": (168, 162), "b": (56, 56)}


def test_origin_range_of_several_sources(spark):
    def source(first, n, back, ahead, **kw):
        return backtest.Source(hours(spark, first, n).withColumn("other", F.lit(None).cast("double")), ("other", "price"), back, ahead, **kw)

    prices = source("2025-03-09 23:00:00", 24 * 40, 7, 1)  # whole local days from the 10th; the clocks change on the 30th
    weather = source("2025-03-20 00:00:00", 24 * 20 + 5, 0, 1)  # misses the first hour of the 20th
    row = backtest.origin_range([prices, weather]).first()
    assert (str(row.first_origin), str(row.last_origin)) == ("2025-03-21", "2025-04-07")
    row = backtest.origin_range([prices]).first()
    assert (str(row.first_origin), str(row.last_origin)) == ("2025-03-17", "2025-04-17")
    assert backtest.origin_range([source("2025-03-09 23:00:00", 24 * 8, 7, 1)]).count() == 0


def test_examples_of_violations_are_bounded(spark):
    rows = spark.range(1000).selectExpr("id % 2 as k", "cast(id as double) as v", "cast(id as string) as name")
    found = quality.range_violations(rows, [quality.Rule("v", 0, 500, None, 998)], ["k"], F.col("name"), 3).collect()
    for r in found:
        assert 1 <= len(r.examples) <= 3 and all(int(e) > (500 if r.rule == "range" else 998) and int(e) % 2 == r.k for e in r.examples)
    assert {(r.k, r.rule, r.n_bad) for r in found} == {(0, "range", 249), (1, "range", 250), (1, "soft_range", 1)}


def test_signatures_digest_whole_sets(spark):
    """The digest of the whole sorted set, however often and in what order snapshots come, also where one has several pull times."""
    rows = [(k, f"{i * 37 % 500:04d}", i) for k in (1, 2) for i in range(1500)] + [(3, None, 0), (3, "b", 0), (3, "a", 0), (4, None, 0), (None, "a", 0)]
    pulls = spark.createDataFrame(rows, "tab int, snapshot string, pulled_at int").withColumn("valid", F.lit(True))
    pulls = pulls.unionByName(spark.createDataFrame([(1, "x", 0, False), (5, "x", 0, False)], pulls.schema)).repartition(7)
    found = {r.tab: r.signature for r in lake.input_signatures(pulls, "tab").collect()}
    whole = md5(",".join(f"{i:04d}" for i in range(500)).encode()).hexdigest()
    assert found == {1: whole, 2: whole, 3: md5(b"a,b").hexdigest(), 4: None, None: md5(b"a").hexdigest()}
    before = lake.input_signatures(pulls.where("tab is null or tab <> 2 or snapshot <> '0007'"), "tab")
    assert {r.tab for r in lake.incremental_skip(lake.input_signatures(pulls, "tab"), before, "tab").collect()} == {2, 4, None}


def test_violations_are_found_without_sorting_rows(spark, tmp_path):
    """Rows are neither sorted nor grouped ahead of their shuffle; names by brute force, with null keys, names and repeated names."""
    rows = spark.range(3000).selectExpr("nullif(id % 3, 2) as k", "nullif(id % 7, 3) * 1.0 as v", "id % 11 * 1.0 as w", "nullif(concat('n', id % 400), 'n5') as name").localCheckpoint()
    rules = [quality.Rule("v", 1, 5, None, 4, 0.5), quality.Rule("w", 11, None, 0, 9), quality.Rule("v", None, None, None, None, 0.1)]
    found = quality.range_violations(rows, rules, ["k"], F.col("name"), 3)
    assert not [x for x in found._jdf.queryExecution().executedPlan().toString().splitlines() if "SortAggregate" in x and "count" in x]
    kinds = {("v", "range", "error"): lambda r: r.v is not None and not 1 <= r.v <= 5, ("v", "soft_range", "warning"): lambda r: (r.v or 0) > 4, ("v", "null_fraction", "error"): lambda r: r.v is None, ("w", "range", "error"): lambda r: r.w < 11, ("w", "soft_range", "warning"): lambda r: r.w > 9}
    want = set()
    for key in (0, 1, None):
        for kind, bad in kinds.items():
            hits = [r for r in rows.collect() if r.k == key and bad(r)]
            named = sorted({(int(md5(r.name.encode()).hexdigest()[:8], 16), r.name) for r in hits if r.name})
            least = sorted(min(x for x in named if x[0] % 3 == p) for p in {x[0] % 3 for x in named})
            want.add((key, *kind, len(hits), tuple(n for _, n in least)))
    assert {(r.k, r.column, r.rule, r.severity, r.n_bad, tuple(r.examples)) for r in found.collect()} == want
    spark.createDataFrame([(1, 2, dt.datetime(2024, 1, 1), 3.0, 0.01, 0.1)], "l_orderkey int, l_suppkey int, l_shipdate timestamp, l_quantity double, l_tax double, l_discount double").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(2, 5)], "s_suppkey int, s_nationkey int").write.parquet(f"{tmp_path}/supplier.parquet")
    plan = readings(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_avg") < plan.index("Exchange")


def test_groups_of_a_clock_change(spark):
    """Neighbour and weather columns beside plain look-ups, over the day of 23 hours."""
    rows = hours(spark, "2025-03-20 00:00:00", 24 * 15).unionByName(hours(spark, "2025-03-20 00:00:00", 24 * 15, "b").withColumn("price", F.col("price") * 2))
    keyed = t.hour_occurrence(rows, ["zone"])
    readings = rows.selectExpr("zone", "explode(array('n', 's')) as location", "timestamp", "price / 10 as temp", "price as wind_dir").where("not (location = 's' and hour(timestamp) = 3)")
    groups = (features.neighbour_group(keyed, (("a", "b"),)), features.weather_group(readings, ["n", "s"], ["temp"], ["wind_dir"], "temp"), features.calendar_group(t.holiday_calendar(spark, "2025-03-01", "2025-05-01")))
    out = {(r.zone, r.target_time): r for r in features.origin_dataset(keyed, groups).collect()}
    price = {(r.zone, r.timestamp): r.price for r in rows.collect()}
    for (zone, at), r in out.items():
        if zone == "b":
            assert r.nb_b_lag1d is None and r.nb_b_dayD_mean is None
        elif r.p_lag1d is not None:
            assert r.nb_b_lag1d == 2 * r.p_lag1d and r.nb_b_spread_lag1d == -r.p_lag1d and r.nb_b_dayD_mean == pytest.approx(2 * r.p_dayD_mean)
        south = at.hour != 3
        assert r.w_n_temp == price[zone, at] / 10 and (r.w_s_temp is not None) == south and r.weather_missing_frac == pytest.approx(0 if south else 0.5)
        if (zone, at - dt.timedelta(hours=24)) in price:
            assert r.wz_temp_d24 == pytest.approx((price[zone, at] - price[zone, at - dt.timedelta(hours=24)]) / 10)
        assert r.cal_is_public_holiday == 0 and r.cal_days_to_holiday is not None
    assert len(out) == len({(z, ts) for z, ts in price if (z, ts) in out})
    lost = features.dropped_targets(keyed.withColumn("price", F.when(F.hour("timestamp") != 3, F.col("price"))), spark.sql("select 'a' as zone, explode(array(date'2025-03-29', date'2025-03-30')) as origin_date")).collect()
    assert sorted(r.n_dropped for r in lost) == [1, 1]


def test_days_of_23_and_25_hours_are_scored_whole(spark):
    for day, n in (("2025-03-30", 23), ("2025-10-26", 25), ("2025-06-01", 24)):
        rows = t.target_hours(spark.sql(f"select 'a' as zone, 'champion' as role, date_sub(date'{day}', 1) as origin_date")).select("*", *[F.lit(float(q)).alias(c) for q, c in enumerate(QCOLS)], F.lit(3.0).alias("actual"), F.lit(4.0).alias("naive_7d"))
        assert [r.n_hours for r in serving.daily_score(rows, QS).collect()] == [n]
        assert serving.daily_score(rows.where(F.hour("target_time") != 5), QS).count() == 0
        summary = serving.day_summary(rows.withColumnRenamed("actual", "y"), ("zone", "role")).first()
        assert (summary.n_hours, summary.actual_mean) == (n, 3.0)
        assert serving.day_summary(rows.withColumn("y", F.when(F.hour("target_time") != 5, F.col("actual"))), ("zone", "role")).first().actual_mean is None
