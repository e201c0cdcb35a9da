"""Snapshots, latest-per-key views, revision logs and stores over overlapping pulls."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import reduce
from operator import and_

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions.timeutils import TZ, local_date
from tidemark.sources.versions import VersionedTable


def keep_one(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the given order."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def clip_and_dedup_chunks(df: DataFrame, chunks: DataFrame, keys: list[str], ts: str = "timestamp", keep: str = "last", arrival: str | None = None) -> DataFrame:
    """Rows inside the [start, end) of their chunk; of rows with equal keys and time the last (or first) chunk's, within a chunk the last (or first) by ``arrival``."""
    inside = df.join(F.broadcast(chunks), "chunk").where((F.col(ts) >= F.col("start")) & (F.col(ts) < F.col("end")))
    order = [(F.desc if keep == "last" else F.asc)(c) for c in ("chunk", arrival) if c]
    return keep_one(inside, [*keys, ts], order).drop("start", "end")


def latest_per_key(pulls: DataFrame, keys: list[str], as_of: str | None = None, tie: str = "seq") -> DataFrame:
    """Over valid pulls (until ``as_of``) the newest row of each key, with its lineage columns.

    ``max_by`` on a struct combines before the shuffle: a key with many pulls isn't gathered in one place.
    """
    valid = pulls.where("valid")
    if as_of:
        valid = valid.where(F.col("pulled_at") <= F.lit(as_of).cast("timestamp"))
    values = [c for c in pulls.columns if c not in keys]
    newest = valid.groupBy(*keys).agg(F.max_by(F.struct(*values), F.struct("pulled_at", tie)).alias("_row"))
    return newest.select(*keys, "_row.*")


def contributing_snapshots(latest: DataFrame) -> DataFrame:
    return latest.select("snapshot").distinct()


def as_json(value: Column) -> Column:
    """A value as JSON text; null, and what JSON has no number for, as ``null``."""
    inside = F.to_json(F.array(value))
    return F.when(value.isNull() | (value.cast("string").isin("NaN", "Infinity", "-Infinity")), "null").otherwise(F.substring(inside, F.lit(2), F.length(inside) - 2))


def change_log(pulls: DataFrame, keys: list[str], values: list[str], tie: str = "seq") -> DataFrame:
    """Per key and value column the consecutive pulls whose value changed (nulls compare equal), old and new.

    Within one snapshot the last row of a key counts. Value columns of different types are logged as JSON text (null as
    ``null``, text in quotes).
    """
    types = dict(pulls.dtypes)
    logged = as_json if len({types[c] for c in values}) > 1 else (lambda c: c)
    once = keep_one(pulls, [*keys, "snapshot"], [F.desc("pulled_at"), F.desc(tie)])
    order = Window.partitionBy(*keys).orderBy("pulled_at", tie)
    before = {c: F.lag(c).over(order) for c in [*values, "pulled_at", "snapshot"]}
    rows = once.select(*keys, *values, "pulled_at", "snapshot", *[b.alias(f"_old_{c}") for c, b in before.items()], F.row_number().over(order).alias("_n")).where("_n > 1")
    changes = F.array(*[F.struct(F.lit(c).alias("column"), logged(F.col(f"_old_{c}")).alias("old"), logged(F.col(c)).alias("new")) for c in values])
    tall = rows.select(*keys, F.inline(changes), F.col("_old_pulled_at").alias("old_pulled_at"), F.col("pulled_at").alias("new_pulled_at"), F.col("_old_snapshot").alias("old_snapshot"), F.col("snapshot").alias("new_snapshot"))
    return tall.where(~F.col("old").eqNullSafe(F.col("new")))


def combine_first(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Cell-wise the left value, else the right one, on the union of keys."""
    values = [c for c in left.columns if c not in keys]
    other = right.select(*keys, *[F.col(c).alias(f"_r_{c}") for c in values])
    return left.join(other, keys, "full_outer").select(*keys, *[F.coalesce(c, f"_r_{c}").alias(c) for c in values])


def realign_preceding_hour(df: DataFrame, columns: list[str], keys: list[str], ts: str = "timestamp") -> DataFrame:
    """Values that describe the hour before their time stamp move to that hour; an outer join keeps both ends."""
    moved = df.select(*keys, (F.col(ts) - F.expr("interval 1 hour")).alias(ts), *columns)
    return df.drop(*columns).join(moved, [*keys, ts], "full_outer")


def fixed_lead_assembly(vintages: DataFrame, hours: DataFrame, keys: list[str], run: Column) -> DataFrame:
    """For each hour the value of its own run; null if that run or hour is missing."""
    wanted = hours.withColumn("run_init", run)
    return wanted.join(vintages, [*keys, "run_init", "timestamp"], "left")


def drop_known_bad_days(df: DataFrame, days: DataFrame, keys: list[str], ts: str = "timestamp", tz: str = TZ) -> DataFrame:
    """Without the rows on listed local days (a short, hand-kept list)."""
    return df.withColumn("day", local_date(ts, tz)).join(F.broadcast(days), [*keys, "day"], "left_anti").drop("day")


def content_digest(df: DataFrame) -> DataFrame:
    """One row that depends on column names and rows, not on their order."""
    row = F.xxhash64(*[F.col(c) for c in sorted(df.columns)])
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(row.cast("decimal(38,0)")).alias("row_sum"), F.bit_xor(row).alias("row_xor")).withColumn("columns", F.lit(",".join(sorted(df.columns))))


def table_inventory(df: DataFrame, by: str, ts: str, conflicts: DataFrame | None = None) -> DataFrame:
    """Rows and time range per table, and with a change log (that has ``by``) the number of its entries."""
    out = df.groupBy(by).agg(F.count(F.lit(1)).alias("n_rows"), F.min(ts).alias("first_time"), F.max(ts).alias("last_time"))
    if conflicts is None:
        return out
    found = conflicts.groupBy(by).agg(F.count(F.lit(1)).alias("n_conflicts"))
    return out.join(found, by, "left").na.fill(0, ["n_conflicts"])


def manifest_of(pulls: DataFrame) -> DataFrame:
    """A manifest row per snapshot."""
    return pulls.groupBy("snapshot").agg(F.count(F.lit(1)).alias("row_count"), F.min("pulled_at").alias("pulled_at"), F.min("part").alias("data_start"), F.max("part").alias("data_end"), F.every("valid").alias("passed"))


def list_snapshots(manifest: DataFrame, only_valid: bool = True) -> DataFrame:
    return manifest.where("passed") if only_valid else manifest


def input_signatures(pulls: DataFrame, by: str) -> DataFrame:
    """Of each table the MD5 of its whole set of valid snapshots, sorted and joined by commas; null if it has none that isn't null.

    Snapshots are made distinct and sorted by Spark and digested one after the other; no set or text of a table is held.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest, begun = None, None, False

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([key], type_), pa.array([digest and digest.hexdigest()], pa.string())], [by, "signature"])

        for batch in batches:
            type_ = batch.column(by).type
            for k, snapshot in zip(batch.column(by).to_pylist(), batch.column("snapshot").to_pylist()):
                if begun and k != key:
                    yield row()
                    digest = None
                key, begun = k, True
                if snapshot is not None:
                    text = snapshot.encode()
                    if digest is None:
                        digest = hashlib.md5(text, usedforsecurity=False)
                    else:
                        digest.update(b"," + text)
        if begun:
            yield row()

    each = pulls.where("valid").select(by, F.col("snapshot").cast("string").alias("snapshot")).distinct()
    return each.repartition(by).sortWithinPartitions(by, "snapshot").mapInArrow(run, f"{by} {dict(each.dtypes)[by]}, signature string")


def incremental_skip(now: DataFrame, before: DataFrame, by: str) -> DataFrame:
    """Tables whose signature is new or has changed."""
    return now.join(before, [by, "signature"], "left_anti")


def backfill_gaps(covered: DataFrame, zones: DataFrame, first: str, last: str) -> DataFrame:
    """(zone, month) of the expected grid that no valid snapshot covers."""
    months = zones.withColumn("month", F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"), F.expr("interval 1 month"))))
    return months.join(covered, ["zone", "month"], "left_anti")


def latest_version(manifest: DataFrame, by: list[str]) -> DataFrame:
    return manifest.groupBy(*by).agg(F.max_by("version", F.struct("built_at", "version")).alias("version"), F.max("built_at").alias("built_at"))


def append_new(existing: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Idempotent append: keys that are already stored keep what was written."""
    return existing.unionByName(new.join(existing.select(*keys).distinct(), keys, "left_anti"))


def store_new(df: DataFrame, root: str, by: list[str]) -> DataFrame:
    """Append to a versioned store what has a new value of ``by``; returns the stored rows of ``df``'s values.

    A partition (a forecast's zone, role and origin) is written once: a run that is repeated, or made again by another
    model, gets what was written. Which partitions there are is read from the manifest, not from the rows. Of two runs
    that store the same partition at once the first to commit keeps it.
    """
    spark, table = df.sparkSession, VersionedTable(df.sparkSession, root)
    names = [f"_k{i}" for i in range(len(by))]
    as_text = [F.col(c).cast("string").alias(n) for c, n in zip(by, names)]
    same = lambda a, b: reduce(and_, [a[n].eqNullSafe(b[n]) for n in names])
    stored = lambda m: spark.createDataFrame([tuple(p["key"]) for p in m["parts"]], ", ".join(f"{n} string" for n in names))

    before, keyed = table.manifest(), df.select("*", *as_text)
    known = stored(before)
    fresh = keyed.join(known, same(keyed, known), "left_anti").select(df.columns)
    made = table.write_by(fresh, by)

    def add(manifest: dict) -> list[dict] | None:
        taken = {tuple(p["key"]) for p in manifest["parts"]}
        new = [p for p in made if tuple(p["key"]) not in taken]
        return manifest["parts"] + new if new else None

    now = table.update(add, df.schema)
    asked = {tuple(r) for r in keyed.select(*names).distinct().collect()}  # one row per partition of the run
    return table.read(now, [p for p in now["parts"] if tuple(p["key"]) in asked], df.schema)


def upsert(existing: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of ``new`` replace the stored ones."""
    return existing.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new)


def prices_union(tables: dict[str, DataFrame]) -> DataFrame:
    """All price tables by column name, missing columns null, with the source as a literal."""
    parts = [df.withColumn("source", F.lit(name)) for name, df in tables.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def register_views(spark: SparkSession, tables: dict[str, DataFrame], conflicts: DataFrame | None = None) -> None:
    """One view per table, ``<table>_conflicts`` beside it, and ``prices`` over all that have a price."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
        if conflicts is not None:
            conflicts.where(F.col("table") == name).createOrReplaceTempView(f"{name}_conflicts")
    priced = {n: df for n, df in tables.items() if "price" in df.columns}
    if priced:
        prices_union(priced).createOrReplaceTempView("prices")


class Refused(ValueError):
    """Rows that a gate has turned away; nothing was committed."""


def commit_checked(df: DataFrame, table: VersionedTable, limits: dict[str, Column], place: Callable[[dict, dict], list[dict]], only: list[str] | None = None, **info) -> dict:
    """Write ``df`` once, counting violations of ``limits`` on the way, and commit only if all counts are zero.

    ``place`` makes the new list of parts from the manifest and the new part; ``only`` names the columns to store, if the
    limits need more. Refused rows are removed.
    """
    counts = {f"bad_{i}": F.count_if(F.coalesce(wrong, F.lit(False))) for i, wrong in enumerate(limits.values())}
    part = table.write(df, only, **counts)
    bad = {name: n for name, n in zip(limits, [part.pop(c) for c in counts]) if n}
    if bad:
        table.discard(part)
        raise Refused(f"{bad} of {part['rows']} rows")
    return table.update(lambda manifest: place(manifest, part), df.select(*(only or df.columns)).schema, **info)


def write_snapshot(df: DataFrame, root: str, source: str, dataset: str, key: str, pulled_at: str, passed: bool) -> DataFrame:
    """Write a snapshot once (an existing one is an error) and return its manifest row, counted while it was written."""
    spark, table = df.sparkSession, VersionedTable(df.sparkSession, root)
    name = [source, dataset, key, pulled_at]

    def refuse(manifest: dict) -> None:
        if any(p["key"] == name for p in manifest["parts"]):
            raise Refused(f"snapshot {name} is stored already")

    refuse(table.manifest())
    part = table.write(df, data_start=F.min("timestamp"), data_end=F.max("timestamp"))
    part |= {"key": name, "passed": passed, "columns": ",".join(df.columns)}

    def add(manifest: dict) -> list[dict]:
        refuse(manifest)
        return [*manifest["parts"], part]

    table.update(add, df.schema)
    literals = {"source": source, "dataset": dataset, "key": key, "pulled_at": pulled_at, "passed": passed, "columns": part["columns"], "row_count": part["rows"]}
    times = {n: F.lit(part[n]).cast(dict(df.dtypes)["timestamp"]) for n in ("data_start", "data_end")}
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in literals.items()], *[c.alias(n) for n, c in times.items()])


def write_silver(df: DataFrame, root: str, ts: str = "timestamp") -> dict:
    """Replace the UTC years (and zones) that ``df`` has rows of, in one step; the manifest of the new version.

    Readers see all years as they were or all as they are now. A table without rows is written as such.
    """
    table = VersionedTable(df.sparkSession, root)
    out = df.withColumn("year", F.year(ts))
    made = table.write_by(out, ["zone", "year"])
    new = {tuple(p["key"]) for p in made}
    return table.update(lambda m: [p for p in m["parts"] if tuple(p["key"]) not in new] + made, out.schema)


def read_silver(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The newest version of a silver table, or a pinned one."""
    table = VersionedTable(spark, root)
    return table.read(table.manifest(version))


def write_dataset(df: DataFrame, root: str, zone: str, kind: str, built_at: str) -> str:
    """Write a version named by its content, once; returns the version (the stored one if the content is the same)."""
    digest = content_digest(df).select(F.substring(F.sha2(F.concat_ws("|", "columns", "n_rows", "row_sum", "row_xor"), 256), 1, 12)).first()[0]
    version = f"{zone}-{kind}-{digest}"
    table = VersionedTable(df.sparkSession, root)
    known = lambda m: any(p["dataset_version"] == version for p in m["parts"])
    if not known(table.manifest()):
        part = table.write(df) | {"zone": zone, "kind": kind, "dataset_version": version, "built_at": built_at, "schema": df.schema.jsonValue()}
        table.update(lambda m: None if known(m) else [*m["parts"], part], df.schema)
    return version


def dataset_manifest(spark: SparkSession, root: str) -> DataFrame:
    """``zone, kind, version, built_at`` of the stored datasets."""
    parts = VersionedTable(spark, root).manifest()["parts"]
    return spark.createDataFrame([(p["zone"], p["kind"], p["dataset_version"], p["built_at"]) for p in parts], "zone string, kind string, version string, built_at string")


def read_dataset(spark: SparkSession, root: str, version: str) -> DataFrame:
    """The rows of a stored dataset."""
    table = VersionedTable(spark, root)
    manifest = table.manifest()
    parts = [p for p in manifest["parts"] if p["dataset_version"] == version]
    if not parts:
        raise ValueError(f"{root} has no dataset {version}")
    return table.read(manifest, parts, StructType.fromJson(parts[0]["schema"]))
