"""SimHash near-duplicates by the generalised pigeonhole principle.

A fingerprint is the majority of the XXH64 hashes of a text's word shingles. Fingerprints link at
``radius`` or fewer differing bits. The search cuts the 64 bits into ``m`` partitions of correlated bits
and gives partition i a threshold t_i (-1: not probed) with sum(t_i) = radius - m + 1: any two linked
fingerprints then agree within t_i bits in some partition i. A dynamic programme picks the thresholds,
for several m, by the number of candidates that the value counts of all fingerprints predict. Distinct
fingerprints probe those partitions, and candidates are verified on all 64 bits.

A crowded bucket is never expanded into pairs. Its members instead link through the fingerprints at
distance at most ``radius / 2`` around them: two fingerprints differ in at most 2 bits exactly if some
64-bit value lies within 1 bit of both, so 65 rows per member replace the pairs, with no link lost.

Equal fingerprints are one node of the link graph, so copies are never paired. Components come from
alternating large-star and small-star rounds, each a join and an aggregation, materialised in the shared
folder between rounds.

Very long texts are read whole, in Arrow batches bounded by rows and bytes. Nulls and ties: a null text counts as empty; a text without words has fingerprint zero and links like any
other; repeated rows share their component; a null id never names a component (unless all ids of it are
null). An empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import UPPER, discard, join_uneven, materialise, prepare, table

BITS = 64
#: Largest bucket whose members are compared pairwise.
CROWD = 32
LOWER = bytes.maketrans(UPPER.encode(), UPPER.lower().encode())


def fingerprint(text: str | None, size: int = 3, seed: int = 42) -> int:
    words = (text or "").encode().translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - size + 1)
    if n == 1:
        hashes = [xxhash.xxh64_intdigest(joined, seed)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], seed) for a, b in zip(starts[:n].tolist(), ends[size - 1 :].tolist())]
    ones = np.zeros(BITS, np.int64)
    whole = np.array(hashes, "<u8").view(np.uint8).reshape(n, 8)
    for at in range(0, n, 4096):
        ones += np.unpackbits(whole[at : at + 4096], axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3, seed: int = 42) -> DataFrame:
    """``id, fp`` with the fingerprint as a signed 64-bit integer."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), size, seed) for t in batch.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps)], ["id", "fp"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {dict(docs.dtypes)[id_col]}, fp long")


def correlations(fps: DataFrame) -> np.ndarray:
    """Correlation of the 64 bits over all fingerprints, from 64 x 64 counts that Spark adds up."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = np.zeros((BITS, BITS))
        for batch in batches:
            bits = np.unpackbits(batch.column(0).to_numpy().view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            both += bits.T @ bits
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BITS * BITS)), pa.array(both.ravel())], ["cell", "n"])

    counts = np.zeros(BITS * BITS)
    for row in fps.select("fp").mapInArrow(count, "cell long, n double").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        counts[row.cell] = row.n
    n, both = max(1, fps.count()), counts.reshape(BITS, BITS)
    p = np.diag(both) / n
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    return np.abs((both / n - np.outer(p, p)) / np.outer(spread, spread))


def correlated_parts(corr: np.ndarray, m: int) -> list[list[int]]:
    """The bits in m partitions of nearly equal size, each grown by the bit most correlated with it."""
    left, parts = set(range(BITS)), []
    for k in range(m):
        want = BITS // m + (k < BITS % m)
        part: list[int] = []
        while len(part) < want:
            best = max(sorted(left), key=lambda b: corr[b, part].sum() if part else corr[b, sorted(left)].sum())
            part.append(best)
            left.remove(best)
        parts.append(sorted(part))
    return parts


def masked(fp: Column, part: list[int]) -> Column:
    return fp.bitwiseAND(F.lit(signed(sum(1 << b for b in part))))


def signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def allocate(costs: list[dict[int, float]], total: int) -> tuple[float, list[int]]:
    """Thresholds, one per partition, with the given sum and the least cost (dynamic programming)."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for options in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, chosen) in best.items():
            for t, more in options.items():
                if used + t not in step or cost + more < step[used + t][0]:
                    step[used + t] = (cost + more, [*chosen, t])
        best = step
    return best.get(total, (float("inf"), []))


def plan_search(fps: DataFrame, radius: int, choices: tuple[int, ...] = (2, 3, 4)) -> list[tuple[list[int], int]]:
    """The partitions to probe with their thresholds, for the least expected work."""
    corr, n = correlations(fps), fps.count()
    parts = {m: correlated_parts(corr, m) for m in choices}
    values = F.array(*[F.struct(F.lit(f"{m}.{k}").alias("part"), masked(F.col("fp"), p).alias("v")) for m, ps in parts.items() for k, p in enumerate(ps)])
    sizes = fps.select(F.explode(values).alias("x")).groupBy("x.part", "x.v").count()
    # Pairs in ordinary buckets; crowded ones cost a fixed number of rows per member.
    pairs = F.when(F.col("count") <= CROWD, F.col("count") * (F.col("count") - 1) / 2).otherwise(F.col("count") * (BITS + 1))
    same = {r.part: r.pairs for r in sizes.groupBy("part").agg(F.sum(pairs).alias("pairs")).collect()}
    best: tuple[float, list[tuple[list[int], int]]] = (float("inf"), [])
    for m, ps in parts.items():
        costs = []
        for k, p in enumerate(ps):
            found = same.get(f"{m}.{k}", 0.0)
            options, ball = {-1: 0.0}, 1
            for t in range(min(radius, 1) + 1):
                ball += t * len(p)
                options[t] = n * (1 + ball) + found * ball + n * (n / 2.0 ** len(p)) * ball / 2
            costs.append(options)
        cost, chosen = allocate(costs, radius - m + 1)
        if cost < best[0]:
            best = (cost, [(p, t) for p, t in zip(ps, chosen) if t >= 0])
    return best[1]


def links(fps: DataFrame, radius: int = 2) -> DataFrame:
    """``a, b``: pairs of distinct fingerprints at ``radius`` or fewer differing bits, enough to connect all that link."""
    if radius not in (1, 2):
        raise ValueError("radius must be 1 or 2")
    plan = plan_search(fps, radius)
    index, probes = [], []
    for k, (part, t) in enumerate(plan):
        value = masked(F.col("fp"), part)
        index.append(F.struct(F.lit(k).alias("part"), value.alias("v")))
        probes += [F.struct(F.lit(k).alias("part"), value.bitwiseXOR(F.lit(signed(flip))).alias("v")) for flip in [0, *([1 << b for b in part] if t else [])]]
    wide = any(t for _, t in plan)
    indexed = fps.select("fp", F.explode(F.array(*index)).alias("x")).select("fp", "x.part", "x.v")
    probing = fps.select("fp", F.explode(F.array(*probes)).alias("x")).select("fp", "x.part", "x.v") if wide else indexed
    crowded = indexed.groupBy("part", "v").count().where(F.col("count") > CROWD).select("part", "v")
    crowded = materialise(crowded, "simhash-crowded")

    left = probing.join(crowded, ["part", "v"], "left_anti").withColumnRenamed("fp", "a")
    right = indexed.join(crowded, ["part", "v"], "left_anti").withColumnRenamed("fp", "b") if not wide else indexed.withColumnRenamed("fp", "b")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius
    found = left.join(right, ["part", "v"]).where((F.col("a") < F.col("b") if not wide else F.col("a") != F.col("b")) & near)
    found = found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    if crowded.isEmpty():
        return found.distinct()

    # All that probe a crowded bucket: each links to the least one around every centre within radius / 2 bits.
    dense = probing.join(crowded, ["part", "v"], "left_semi").select("fp").distinct()
    centres = [F.col("fp").alias("c")] + [F.col("fp").bitwiseXOR(F.lit(signed(1 << b))).alias(f"c{b}") for b in range(BITS)]
    around = dense.select("fp", *centres).unpivot("fp", None, "bit", "centre")
    least = around.groupBy("centre").agg(F.min("fp").alias("a"), F.max("fp").alias("top")).where("a < top")
    starred = around.join(least, "centre").where((F.col("a") < F.col("fp")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("fp"))) <= radius))
    return found.unionByName(starred.select("a", F.col("fp").alias("b"))).distinct()


def components(edges: DataFrame, rounds: int = 64) -> DataFrame:
    """``node, root`` for every node of the links ``a, b``: the least node of its component."""
    edges = materialise(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "links")
    known = None
    for _ in range(rounds):
        # Large star: larger neighbours of a node move to the least node it sees.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # Small star: a node and its smaller neighbours move to the least of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        after = materialise(moved.where("u <> v").distinct(), "links")
        discard(edges)
        edges = after
        state = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if state == known:
            break
        known = state
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3, radius: int = 2) -> DataFrame:
    """One row per input row: ``id_col, fingerprint, component_id`` (the smallest id reachable over links)."""
    marked = materialise(fingerprints(docs, id_col, text_col, size), "simhash")
    nodes = materialise(marked.groupBy("fp").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")), "simhash-nodes")  # read by every job of the planner
    roots = components(links(nodes.select("fp"), radius))
    grouped = nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    named = grouped.groupBy("root").agg(F.min("first").alias("component_id"))
    fingerprint = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    names = grouped.join(named, "root").select(fingerprint, "component_id")
    # A third of all rows can have one fingerprint, as all texts without words do.
    found = join_uneven(marked.select(F.col("id").alias(id_col), fingerprint), names, "fingerprint", nodes.where("n > 1").select(fingerprint, "n"))
    return found.select(id_col, "fingerprint", "component_id")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
