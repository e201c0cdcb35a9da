"""Keys that hold a large part of all rows: results stay whole and no task gets them all."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.llm.test_llm import plain_pages
from tidemark.llm import decontam, exact_dedup, lm_scoring, simhash, warc
from tidemark.llm.common import join_uneven, materialise


@pytest.fixture()
def sixteen(spark):
    """Sixteen partitions as they are: no broadcast of unproven sides, no coalescing, no splitting by Spark."""
    conf = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def fullest(df):
    """Rows of the fullest partition, as a share of the mean."""
    counts = [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    return max(counts) / (sum(counts) / 16)


@pytest.mark.parametrize("with_group", [False, True])
def test_join_spreads_hot_keys(sixteen, with_group):
    rows = sixteen.range(100_000).select("id", F.when(F.col("id") % 10 < 4, "hot").when(F.col("id") % 10 < 6, None).otherwise(F.concat(F.lit("k"), F.col("id"))).alias("key"))
    groups = sixteen.range(100_000).where("id % 20 = 7").select(F.concat(F.lit("k"), F.col("id")).alias("key"), (F.col("id") * 2).alias("v"))
    if with_group:
        groups = groups.unionByName(sixteen.sql("select 'hot' as key, -1L as v"))
    sizes = materialise(rows.where("key is not null").groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "sizes")
    found = join_uneven(rows, groups, "key", sizes)
    assert fullest(found) < 1.5
    wrong = F.when(F.col("key") == "hot", ~F.col("v").eqNullSafe(F.lit(-1 if with_group else None).cast("long"))).when(F.col("id") % 20 == 7, F.col("v") != F.col("id") * 2).otherwise(F.col("v").isNotNull())
    assert found.count() == 100_000 and found.where(wrong).count() == 0


def test_archives_of_many_empty_pages(sixteen):
    pages = sixteen.range(20_000).selectExpr("id as page_id", "concat('http://h', id % 50, '/', id) as url", "case when id % 10 < 4 then null when id % 10 < 6 then repeat('same ', 40) else concat(repeat('x', 100), id) end as html")
    found = sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, str(r.refers_to)) for r in warc.archive_and_read(pages).collect())
    assert found == plain_pages([(r.page_id, r.url, r.html) for r in pages.collect()])


def test_archive_sizes_of_many_empty_pages(sixteen, tmp_path):
    pages = sixteen.range(20_000).selectExpr("id as page_id", "concat('http://h', id % 50, '/', id) as url", "case when id % 10 < 4 then null else concat(repeat('x', 100), id) end as html")
    manifest = warc.write_archives(pages, f"file://{tmp_path}/warc")
    per_file = [r["count"] for r in manifest.groupBy("file").count().collect()]
    assert sum(per_file) == 20_000 and max(per_file) < 2 * 20_000 / 16


def test_exact_copies_of_one_id(sixteen):
    rows = sixteen.range(20_000).selectExpr("case when id % 2 = 0 then 7L else id end as doc_id", "case when id % 2 = 0 then 'The same' when id % 4 = 1 then 'THE SAME' else concat('t', id) end as text", "id as n")
    found = exact_dedup.exact_dedup(rows, keep="smallest", carry=True)
    kept = found.where("kept")
    assert kept.count() == 1 + 5000 and kept.where("text_sha256 = sha2('the same', 256)").select("doc_id", "group_size").collect() == [(1, 15000)]
    one = sixteen.range(20_000).selectExpr("7L as doc_id", "'Same' as text")
    assert exact_dedup.drop_exact_copies(one).collect() == [(7, "Same")]


def test_near_copies_without_words(sixteen):
    docs = sixteen.range(4000).selectExpr("id as doc_id", "case when id % 2 = 0 then null else concat('word', id, ' other', id * 7, ' third', id * 3) end as text")
    found = simhash.near_duplicates(docs)
    assert fullest(found) < 2
    assert found.where("doc_id % 2 = 0").select("component_id").distinct().count() == 1 and found.count() == 4000


def test_contamination_of_many_clean_texts(sixteen):
    docs = sixteen.range(3000).selectExpr("id as doc_id", "case when id % 3 < 2 then '' else concat('a b c d e f g h i j ', id) end as text")
    items = sixteen.createDataFrame([(i, f"a b c d e f g h i j {i * 30 + 2}") for i in range(40)], "item_id long, text string")
    one, many = (sorted(map(tuple, decontam.find_contamination(docs, items, block_bytes=b).collect())) for b in (1 << 24, 400))
    assert one == many and sum(r[-1] for r in one) == 1000


def test_long_words_and_equal_rows_of_the_language_model(sixteen):
    """Texts without spaces leave digests only; equal rows are dealt to all shards, on any layout."""
    text = F.when(F.col("id") % 2 == 0, F.lit("a b c d")).otherwise(F.concat(F.lit("x y "), F.repeat(F.lit("long"), F.lit(25_000)), F.col("id") % 500))
    docs = sixteen.range(4000).select(F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id")).alias("doc_id"), text.alias("text"))
    words, counts, total = lm_scoring.corpus_words(docs, "text")
    assert sorted(words) == sorted([(b"a", 2000), (b"b", 2000), (b"c", 2000), (b"d", 2000), (b"x", 2000), (b"y", 2000)]) and total == 2000 * 4 + 2000 * 3
    assert counts.agg(F.max(F.octet_length("word"))).first()[0] <= lm_scoring.LONGEST and counts.count() == 6 + 250
    tokens = lm_scoring.tokenise(docs, [w for w, _ in words], "doc_id", "text")
    dealt = lm_scoring.training_rows(tokens)
    per_shard = {r.s: r["count"] for r in dealt.groupBy(F.pmod(F.shiftright("h", 20), F.lit(8)).alias("s")).count().collect()}
    assert sum(per_shard.values()) == 4000 and max(per_shard.values()) < 1.3 * 4000 / 8
    again = lm_scoring.training_rows(lm_scoring.tokenise(docs.repartition(7), [w for w, _ in words], "doc_id", "text"))
    assert sorted(r.h for r in dealt.select("h").collect()) == sorted(r.h for r in again.select("h").collect())
