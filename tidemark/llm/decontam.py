"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Words are the symbols. A pattern is a window of ``window`` consecutive words of a benchmark item, or all
words of a shorter item. For every pattern length there is a shift table over blocks of two words: it
tells how far the search may move on without missing a pattern. Where the shift is 0, the bucket of that
suffix block is narrowed by the patterns' first word and each remaining pattern is compared directly.

The patterns are built from blocks of the benchmark of about ``block_bytes`` of text, so what goes to the
tasks is bounded; a larger benchmark takes several passes over the documents. All but the last leave only the
hits, one row per text with any, which join the last pass by the text's digest. Texts are never shuffled or rewritten.

Nulls and ties: a null or wordless document has no words and is clean; a null or wordless item has no
windows; repeated document rows are each scanned; repeated items (same id) count once; a null item id is
written as ``null``. Very long texts are scanned whole, in Arrow batches bounded by rows and bytes. Extra columns are ignored, empty tables give empty or clean results.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import join_uneven, materialise, prepare, table

#: Bytes outside words become spaces, A-Z become a-z; bytes of non-ASCII characters stay.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
BLOCK_BYTES = 16 << 20


def words_of(text: str | bytes | None) -> list[bytes]:
    if text is None:
        return []
    return (text.encode() if isinstance(text, str) else text).translate(FOLD).split()


class WuManber:
    """Search for patterns of one length in a list of words."""

    def __init__(self, patterns: list[tuple[bytes, ...]], length: int) -> None:
        self.length, self.block = length, min(2, length)
        self.default = length - self.block + 1
        self.shift: dict = {}
        self.buckets: dict = {}
        for p in patterns:
            for end in range(self.block, length + 1):
                key = self._key(p, end)
                self.shift[key] = min(self.shift.get(key, self.default), length - end)
            self.buckets.setdefault(self._key(p, length), {}).setdefault(p[0], []).append(p)

    def _key(self, words, end: int):
        return words[end - 1] if self.block == 1 else (words[end - 2], words[end - 1])

    def search(self, words: list[bytes]) -> Iterator[tuple[int, tuple[bytes, ...]]]:
        """(start, pattern) of every occurrence, from left to right."""
        end, n, length, default, get = self.length, len(words), self.length, self.default, self.shift.get
        pairs = self.block == 2
        while end <= n:
            key = (words[end - 2], words[end - 1]) if pairs else words[end - 1]
            jump = get(key, default)
            if jump:
                end += jump
                continue
            start = end - length
            for p in self.buckets[key].get(words[start], ()):
                if tuple(words[start:end]) == p:
                    yield start, p
            end += 1


class Benchmark:
    """The search tables of one block of items."""

    def __init__(self, items: list[tuple[str, str | None]], window: int) -> None:
        self.owners: dict[tuple[bytes, ...], set[str]] = {}
        for item, text in items:
            words = words_of(text)
            for i in range(max(1, len(words) - window + 1) if words else 0):
                self.owners.setdefault(tuple(words[i : i + window]), set()).add(item)
        by_length: dict[int, list] = {}
        for p in self.owners:
            by_length.setdefault(len(p), []).append(p)
        self.searches = [WuManber(ps, n) for n, ps in sorted(by_length.items())]

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        spans, items = [], set()
        for s in self.searches:
            for start, p in s.search(words):
                spans.append((start, start + s.length))
                items |= self.owners[p]
        return spans, items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


_tables: dict[str, Benchmark] = {}
SPANS = pa.list_(pa.list_(pa.int64()))
FOUND = "n_words long, spans array<array<long>>, items array<string>"


def _scanner(items: list[tuple[str, str | None]], window: int, found_only: bool):
    """A pass over the texts with one block's tables: all rows, or those with a hit only."""
    name = uuid.uuid4().hex  # of the search tables that a Python worker keeps for its next tasks

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _tables:
            _tables.clear()
            _tables[name] = Benchmark(items, window)
        tables = _tables[name]
        for batch in batches:
            counts, hits, found = [], [], []
            for text in batch.column("text"):
                words = words_of(text.as_py())
                spans, own = tables.hits(words)
                counts.append(len(words))
                hits.append(merged(spans))
                found.append(sorted(own))
            rows = [pa.array(counts, pa.int64()), pa.array(hits, SPANS), pa.array(found, pa.list_(pa.string()))]
            out = pa.RecordBatch.from_arrays([*(batch.column(c) for c in batch.schema.names if c != "text"), *rows], [*(c for c in batch.schema.names if c != "text"), "n_words", "spans", "items"])
            yield out.filter(pa.array([bool(h) for h in hits])) if found_only else out

    return scan


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the hits of the earlier blocks to those of the last one."""
    for batch in batches:
        spans, items = [], []
        for own, earlier, known, more in zip(*(batch.column(c).to_pylist() for c in ("spans", "earlier", "items", "more"))):
            spans.append(merged([tuple(s) for s in [*own, *(earlier or [])]]))
            items.append(sorted({*known, *(more or [])}))
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("n_words"), pa.array(spans, SPANS), pa.array(items, pa.list_(pa.string()))], ["id", "n_words", "spans", "items"])


def block(items: DataFrame, k: int, blocks: int) -> list[tuple[str, str | None]]:
    """The ``k``-th of the benchmark's blocks by hash, about as large as the others."""
    return [(r.item, r.text) for r in items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k).collect()]


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = 10, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """One row per document: ``id_col, n_words, n_hit, n_items, items, items_sha256, spans, contaminated``.

    ``spans`` are the hit words as [first, end) positions; ``items`` the matching item ids, sorted as strings.
    """
    spark = docs.sparkSession
    prepare(spark)
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("null")).alias("item"), F.col(item_text_col).alias("text")).distinct()
    size = items.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    blocks = -(-size // block_bytes) or 1
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = f"id {dict(docs.dtypes)[id_col]}, {FOUND}"
    if blocks == 1:
        found = rows.mapInArrow(_scanner(block(items, 0, 1), window, False), schema)
    else:
        # What is found depends on the text alone: hits of equal texts are one row, named by the text's digest.
        keyed = rows.withColumn("key", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256))
        earlier = None
        for k in range(blocks - 1):
            hit = keyed.select("key", "text").mapInArrow(_scanner(block(items, k, blocks), window, True), f"key string, {FOUND}")
            hit = materialise(hit.groupBy("key").agg(F.any_value("spans").alias("spans"), F.any_value("items").alias("items")), "decontam")
            earlier = hit if earlier is None else earlier.unionByName(hit)
        earlier = earlier.groupBy("key").agg(F.flatten(F.collect_list("spans")).alias("earlier"), F.flatten(F.collect_list("items")).alias("more"))
        own = materialise(keyed.mapInArrow(_scanner(block(items, blocks - 1, blocks), window, False), f"id {dict(docs.dtypes)[id_col]}, key string, {FOUND}"), "decontam")
        sizes = materialise(own.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "decontam")
        both = join_uneven(own, materialise(earlier, "decontam"), "key", sizes)
        found = both.select("id", "n_words", "spans", "items", "earlier", "more").mapInArrow(_joined, schema)
    lengths = F.transform("spans", lambda s: s[1] - s[0])
    return found.select(
        F.col("id").alias(id_col),
        "n_words",
        F.aggregate(lengths, F.lit(0).cast("long"), lambda a, x: a + x).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        "items",
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        "spans",
        (F.size("spans") > 0).alias("contaminated"),
    )


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
