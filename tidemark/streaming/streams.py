"""Incremental refreshes as Structured Streaming jobs that run until their input is used up."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidemark.operators.lake import change_log, latest_per_key
from tidemark.sources.versions import Conflict, VersionedTable


def stream_hourly(stream: DataFrame, watermark: str = "2 hours", keys: tuple[str, ...] = ("zone",), ts: str = "timestamp", value: str = "price") -> DataFrame:
    """Mean per UTC hour of a stream of sub-hourly rows; an hour closes when the watermark passes its end."""
    hours = stream.withWatermark(ts, watermark).groupBy(*keys, F.window(ts, "1 hour").alias("_w")).agg(F.avg(value).alias(value), F.count(F.lit(1)).alias("n_periods"))
    return hours.select(*keys, F.col("_w.start").alias(ts), value, "n_periods")


def run_to_table(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Write what a stream gives to Parquet files, exactly once, until the input available now is used up."""
    started = df.writeStream.format("parquet").outputMode(mode).option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    started.awaitTermination()
    return started


# ---- silver ----------------------------------------------------------------------------------------


def parts_of(manifest: dict, kind: str) -> list[dict]:
    return [p for p in manifest["parts"] if p["kind"] == kind]


def silver_table(spark: SparkSession, out: str, keys: list[str], schema: StructType | None = None, manifest: dict | None = None) -> DataFrame:
    """The newest row of every key over the runs of a silver table (of a pinned version, if its manifest is given)."""
    table = VersionedTable(spark, out)
    manifest = manifest or table.manifest()
    runs = table.read(manifest, parts_of(manifest, "run"), schema)
    return latest_per_key(runs, keys).select(runs.columns)


def silver_changes(spark: SparkSession, out: str) -> DataFrame:
    """The log of changes that :func:`stream_silver` committed together with its runs."""
    table = VersionedTable(spark, out)
    manifest = table.manifest()
    return table.read(manifest, parts_of(manifest, "changes"), StructType.fromJson(manifest["info"]["changes"]))


def foldable(rows: list[int], ratio: int = 2) -> int:
    """Of runs by age the first of the youngest ones to merge: each older one has at least ``ratio`` times all rows behind it."""
    at, behind = len(rows) - 1, rows[-1] if rows else 0
    while at > 0 and rows[at - 1] < ratio * behind:
        at -= 1
        behind += rows[at]
    return at


def compact(spark: SparkSession, out: str, keys: list[str], schema: StructType, ratio: int = 2) -> bool:
    """Merge the youngest runs of a silver table into one until the runs' sizes fall by ``ratio`` at least; its changes alike.

    A row is written again only when what was added since has grown to a share of its run: a logarithm of the table's size
    times altogether. Says whether there was anything to merge; a version committed in between leaves it to the next time.
    """
    table = VersionedTable(spark, out)
    before = table.manifest()
    parts, made = before["parts"], []
    for kind in ("run", "changes"):
        same = parts_of(before, kind)
        young = same[foldable([p["rows"] for p in same], ratio) :]
        if len(young) < 2:
            continue
        if kind == "run":
            merged = silver_table(spark, out, keys, schema, before | {"parts": young}).sortWithinPartitions(*keys)
        else:
            merged = table.read(before, young, StructType.fromJson(before["info"]["changes"]))
        made.append(table.write(merged) | {"kind": kind})
        folded = {p["path"] for p in young}
        parts = [p for p in parts if p["path"] not in folded] + made[-1:]
    if made:
        try:
            table.commit(before, parts, schema)
        except Conflict:
            for part in made:
                table.discard(part)
            return False
    return bool(made)


def stream_silver(
    spark: SparkSession, pulls: DataFrame, keys: list[str], out: str, checkpoint: str, values: list[str] | None = None, ratio: int = 2, keep: int = 4, trigger: dict | None = None
) -> DataFrame:
    """Latest valid row per key over a stream of pulls; with ``values`` their changes too, in :func:`silver_changes`.

    The table is log-structured: a micro-batch appends a run, sorted by key, of the rows of its own keys and nothing else;
    readers take the newest row of a key over all runs, and small runs are merged by :func:`compact`. Run, changes and the
    number of the batch are committed by one manifest, so a batch that is repeated after a lost job changes nothing and a
    reader sees whole batches only. The last ``keep`` versions stay readable.

    Changes are those from the stored row of a key through the pulls of the batch, by time of pull; a pull older than the
    stored row is logged as followed by it. The stored rows of the batch's keys come by a semi-join on the sorted runs.
    ``checkpoint`` and ``out`` belong together: numbers of batches go on from one run of the job to the next.
    """
    schema, table = pulls.schema, VersionedTable(spark, out)

    def merge(batch: DataFrame, epoch: int) -> None:
        before = table.manifest()
        if before["info"].get("epoch", -1) >= epoch:
            return
        batch = batch.where("valid").persist()
        try:
            new, info = [], {}
            if values:
                runs = table.read(before, parts_of(before, "run"), schema)
                held = latest_per_key(runs.join(batch.select(*keys).distinct(), keys, "left_semi"), keys).select(schema.names)
                changes = change_log(batch.unionByName(held), keys, values)
                new.append(table.write(changes) | {"kind": "changes", "epoch": epoch})
                info = {"changes": changes.schema.jsonValue()}
            run = latest_per_key(batch, keys).select(schema.names).sortWithinPartitions(*keys)
            new.append(table.write(run) | {"kind": "run", "epoch": epoch})
            kept = [p for p in new if p["rows"]]
            table.commit(before, before["parts"] + kept, schema, epoch=epoch, **info)
        finally:
            batch.unpersist()
        compact(spark, out, keys, schema, ratio)
        table.vacuum(keep)

    started = pulls.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
    started.awaitTermination()
    return silver_table(spark, out, keys, schema)
