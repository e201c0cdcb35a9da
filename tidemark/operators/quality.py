"""Validation of series with rules that know about changes of clocks, missing hours and gaps."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.timeutils import RESOLUTIONS, TZ, hours_in_local_day, local_date, neighbouring_times


@dataclass(frozen=True)
class Rule:
    """Bounds of a column: ``low``/``high`` fail, ``soft_low``/``soft_high`` warn, nulls pass them; ``max_null`` bounds the null share."""

    column: str
    low: float | None = None
    high: float | None = None
    soft_low: float | None = None
    soft_high: float | None = None
    max_null: float = 1.0


def rule_for(column: str, by_prefix: dict[str, Rule]) -> Rule:
    """The rule of the longest matching prefix; a column without one is refused."""
    found = [p for p in by_prefix if column.startswith(p)]
    if not found:
        raise ValueError(f"no rule for column {column}")
    rule = by_prefix[max(found, key=len)]
    return Rule(column, rule.low, rule.high, rule.soft_low, rule.soft_high, rule.max_null)


def range_violations(df: DataFrame, rules: list[Rule], keys: list[str], name: Column | None = None, examples: int = 3) -> DataFrame:
    """One row per key, column and violated rule: ``column, rule, severity, n_bad``. Counts add up before the shuffle.

    With a text ``name`` of a row there are up to ``examples`` of the bad rows too: names are dealt to that many places by
    their digest and the least of each place stays. The first pass finds the least digests as numbers, a second one
    the names that have them, so that no rows are sorted. Keys are few: their digests are broadcast, at most ``examples``
    of each key and rule.
    """
    h = F.conv(F.substring(F.md5(F.col("_name")), 1, 8), 16, 10).cast("long")
    rows = df if name is None else df.withColumn("_name", name).withColumn("_h", h)

    def outside(c: str, low: float | None, high: float | None) -> Column:
        bad = F.lit(False)
        if low is not None:
            bad = bad | (F.col(c) < low)
        if high is not None:
            bad = bad | (F.col(c) > high)
        return bad

    aggs, checks, bad = [], [], []
    for r in rules:
        kinds = (
            ("range", "error", outside(r.column, r.low, r.high), 0),
            ("soft_range", "warning", outside(r.column, r.soft_low, r.soft_high), 0),
            ("null_fraction", "error", F.col(r.column).isNull(), r.max_null * F.col("n_rows")),
        )
        for rule, severity, violated, most in kinds:
            i = len(bad)
            bad.append(violated)
            aggs.append(F.count_if(violated).alias(f"bad{i}"))
            fields = [F.lit(r.column).alias("column"), F.lit(rule).alias("rule"), F.lit(severity).alias("severity"), F.col(f"bad{i}").alias("n_bad")]
            if name is not None:
                places = [f"least{i}_{k}" for k in range(examples)]
                aggs += [F.min(F.when(violated & (F.pmod("_h", F.lit(examples)) == k), F.col("_h"))).alias(c) for k, c in enumerate(places)]
                fields += [F.lit(i).alias("_rule"), F.array_compact(F.array(*places)).alias("_least")]
            checks.append(F.when(F.col(f"bad{i}") > most, F.struct(*fields)))
    totals = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), *aggs)
    out = totals.select(*keys, F.inline(F.array_compact(F.array(*checks))))
    if name is None:
        return out
    of = [F.col(k).alias(f"_of{i}") for i, k in enumerate(keys)]
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_of{i}")) for i, k in enumerate(keys)])
    least = out.select(*of, F.col("_rule").alias("_of_rule"), F.explode("_least").alias("_of_h"))
    found = rows.join(F.broadcast(least), same & F.col("_h").eqNullSafe(F.col("_of_h")) & F.get(F.array(*bad), F.col("_of_rule")))
    named = found.groupBy(*[f"_of{i}" for i in range(len(keys))], "_of_rule", "_h").agg(F.min("_name").alias("_name"))
    named = named.groupBy(*[f"_of{i}" for i in range(len(keys))], "_of_rule").agg(F.array_sort(F.collect_list(F.struct("_h", "_name"))).alias("_named"))
    out = out.join(named, same & (F.col("_rule") == F.col("_of_rule")), "left")
    texts = F.transform("_named", lambda x: x["_name"])
    return out.select(*keys, "column", "rule", "severity", "n_bad", F.coalesce(texts, F.array().cast("array<string>")).alias("examples"))


def duplicate_timestamps(df: DataFrame, keys: list[str], ts: str = "timestamp") -> DataFrame:
    return df.groupBy(*keys, ts).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def not_monotone(df: DataFrame, keys: list[str], arrival: list[str], ts: str = "timestamp", chunk: Column | None = None) -> DataFrame:
    """Per key the rows that arrive right after a row with a later time (so that the series falls there), and rows without a time.

    ``chunk`` never falls in order of arrival (a day of arrival, say): rows are ordered within a chunk, and one row per chunk tells
    the next one where it left off, so that no task holds a whole series. ``arrival`` orders the rows of a key in full.
    """
    rows = df.withColumn("_chunk", chunk if chunk is not None else F.lit(0))
    ends = rows.groupBy(*keys, "_chunk").agg(F.max_by(ts, F.struct(*arrival)).alias("_last"))
    ends = ends.select(*keys, "_chunk", F.lag("_last").over(Window.partitionBy(*keys).orderBy("_chunk")).alias("_before"))
    order = Window.partitionBy(*keys, "_chunk").orderBy(*arrival)
    before = F.when(F.row_number().over(order) == 1, F.col("_before")).otherwise(F.lag(ts).over(order))
    return rows.join(ends, [*keys, "_chunk"], "left").withColumn("_back", F.col(ts) < before).groupBy(*keys).agg(F.count_if("_back").alias("n_back"), F.count_if(F.col(ts).isNull()).alias("n_null"))


def merge_intervals(df: DataFrame, keys: list[str], start: str = "start", end: str = "end") -> DataFrame:
    """Intervals that touch or overlap become one."""
    order = Window.partitionBy(*keys).orderBy(start, end)
    reach = F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1))
    flagged = df.withColumn("_new", F.when(F.col(start) <= reach, 0).otherwise(1))
    grouped = flagged.withColumn("_g", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return grouped.groupBy(*keys, "_g").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("_g")


def max_gap_errors(df: DataFrame, keys: list[str], max_gap_s: float, excluded: DataFrame | None = None, ts: str = "timestamp") -> DataFrame:
    """Gaps longer than allowed, except those that exactly span an excluded interval (``keys, gap_start, gap_end``)."""
    gaps = neighbouring_times(df, keys, ts).select(*keys, F.col("prev_time").alias("gap_start"), F.col(ts).alias("gap_end"))
    gaps = gaps.withColumn("gap_s", (F.unix_micros("gap_end") - F.unix_micros("gap_start")) / 1e6).where(F.col("gap_s") > max_gap_s)
    return gaps.join(excluded, [*keys, "gap_start", "gap_end"], "left_anti") if excluded is not None else gaps


#: Fixed value: the first delivery day of the quarter-hourly market.
QUARTER_HOURS_SINCE = "2025-10-01"


def day_count_errors(
    hourly: DataFrame, keys: list[str], step_hours: float = 1, excluded: DataFrame | None = None, ts: str = "timestamp", tz: str = TZ, resolution: str | None = None, quarter_hours_since: str = QUARTER_HOURS_SINCE
) -> DataFrame:
    """Local days inside the data whose row count isn't that of the day (23, 24 or 25 hours); excluded days must be empty.

    With a column ``resolution`` (PT15M or PT60M by row) each day is counted in its own steps, one without any in the market's
    by the day; a day of several resolutions is an error without an expected count, as is one of an unknown resolution.
    """
    own = [F.min(resolution).alias("_low"), F.max(resolution).alias("_high")] if resolution else []
    counts = hourly.groupBy(*keys, local_date(ts, tz).alias("day")).agg(F.count(F.lit(1)).alias("n_rows"), *own)
    span = counts.groupBy(*keys).agg(F.min("day").alias("_a"), F.max("day").alias("_b"))
    inner = F.explode(F.sequence(F.date_add("_a", 1), F.date_sub("_b", 1)))
    grid = span.where(F.datediff("_b", "_a") > 1).select(*keys, inner.alias("day"))
    out = grid.join(counts, [*keys, "day"], "left").withColumn("n_rows", F.coalesce("n_rows", F.lit(0)))
    hours = hours_in_local_day(F.col("day"), tz)
    want = (hours / step_hours).cast("long")
    if resolution:
        default = F.when(F.col("day") >= F.lit(quarter_hours_since).cast("date"), "PT15M").otherwise("PT60M")
        step = F.when(F.col("_low").eqNullSafe(F.col("_high")), F.coalesce("_low", default))
        want = F.coalesce(*[F.when(step == name, (hours * 3600 / s).cast("long")) for name, s in RESOLUTIONS.items()])
    if excluded is not None:
        out = out.join(excluded.withColumn("_excluded", F.lit(True)), [*keys, "day"], "left")
        want = F.when(F.col("_excluded"), F.lit(0).cast("long")).otherwise(want)
    return out.withColumn("expected", want).where("not (n_rows <=> expected)").select(*keys, "day", "n_rows", "expected")


def missing_hours(hourly: DataFrame, keys: list[str], ts: str = "timestamp", value: str | None = None) -> DataFrame:
    """Hours between the first and last row of a series that have no row, or with ``value`` no row with a value."""
    span = hourly.groupBy(*keys).agg(F.min(ts).alias("_a"), F.max(ts).alias("_b"))
    grid = span.select(*keys, F.explode(F.sequence("_a", "_b", F.expr("interval 1 hour"))).alias(ts))
    return grid.join(hourly.where(F.col(value).isNotNull() if value else F.lit(True)).select(*keys, ts), [*keys, ts], "left_anti")


def gap_runs(missing: DataFrame, keys: list[str], ts: str = "timestamp", step_s: int = 3600) -> DataFrame:
    """Missing hours as runs, numbered by start."""
    order = Window.partitionBy(*keys).orderBy(ts)
    island = F.unix_timestamp(ts) - F.row_number().over(order) * step_s
    runs = missing.withColumn("_g", island).groupBy(*keys, "_g").agg(F.min(ts).alias("run_start"), F.max(ts).alias("run_end"), F.count(F.lit(1)).alias("n_hours")).drop("_g")
    return runs.withColumn("run_no", F.row_number().over(Window.partitionBy(*keys).orderBy("run_start")))


def consecutive_runs(days: DataFrame, keys: list[str], day: str = "day") -> DataFrame:
    """Runs of consecutive days."""
    island = F.date_sub(day, F.row_number().over(Window.partitionBy(*keys).orderBy(day)))
    return days.withColumn("_g", island).groupBy(*keys, "_g").agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"), F.count(F.lit(1)).alias("n_days")).drop("_g")


def profile_nulls(df: DataFrame, by: list[str], columns: list[str], resolution: str | None = None, known: tuple[str, ...] = tuple(RESOLUTIONS)) -> DataFrame:
    """Null counts per table, and with a ``resolution`` column the rows of each known resolution and of none, in one aggregation."""
    aggs = [F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in columns]
    if resolution:
        aggs += [F.count_if(F.col(resolution) == r).alias(f"n_{r.lower()}") for r in known]
        aggs.append(F.count_if(F.coalesce(~F.col(resolution).isin(*known), F.lit(True))).alias("n_other"))
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), *aggs)


def validation_report(structure: DataFrame, gaps: DataFrame, days: DataFrame, keys: list[str], most: int = 20) -> DataFrame:
    """Errors per key; gap and day checks count only where the structure is sound; the summary names at most ``most``."""
    structural = structure.groupBy(*keys).agg(F.count(F.lit(1)).alias("structure_errors"))
    later = gaps.select(*keys, F.concat(F.lit("gap "), F.date_format("gap_start", "yyyy-MM-dd HH:mm")).alias("what")).unionByName(days.select(*keys, F.concat(F.lit("day "), F.col("day").cast("string")).alias("what")))
    order = Window.partitionBy(*keys).orderBy("what")
    ranked = later.withColumn("_n", F.row_number().over(order))
    summary = ranked.groupBy(*keys).agg(F.count(F.lit(1)).alias("other_errors"), F.array_join(F.sort_array(F.collect_list(F.when(F.col("_n") <= most, F.col("what")))), "; ").alias("summary"))
    both = structural.join(summary, keys, "full_outer")
    sound = F.col("structure_errors").isNull()
    return both.select(*keys, F.coalesce("structure_errors", F.lit(0)).alias("structure_errors"), F.when(sound, F.col("other_errors")).otherwise(0).alias("other_errors"), F.when(sound, F.col("summary")).alias("summary"))


def time_end_anomalies(df: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """Rows whose reported end isn't the start of the next row of the same local day."""
    order = Window.partitionBy(*keys).orderBy(start)
    return df.withColumn("next_start", F.lead(start).over(order)).where(F.col("next_start").isNotNull() & (F.col(end) != F.col("next_start")))


def null_quantiles(fc: DataFrame, columns: list[str], keys: list[str]) -> DataFrame:
    bad = F.greatest(*[F.col(c).isNull().cast("int") for c in columns]) if len(columns) > 1 else F.col(columns[0]).isNull().cast("int")
    return fc.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), F.sum(bad).alias("n_null"))


def assert_contract(df: DataFrame, schema) -> None:
    """Column names and types must be as expected; extra or missing ones are an error."""
    have, want = dict(df.dtypes), {f.name: f.dataType.simpleString() for f in schema}
    wrong = [f"{c}: {have.get(c, 'missing')} in place of {want.get(c, 'nothing')}" for c in sorted(have.keys() | want.keys()) if have.get(c) != want.get(c)]
    if wrong:
        raise ValueError("; ".join(wrong))
