"""The pipeline on odd rows and empty tables: each stage by itself, and all in a row."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_llm import LOWER, SMALL, no_docs, odd_docs


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Labels as they are; a benchmark with a null, an empty and a short item; nothing else."""
    at = tmp_path_factory.mktemp("odd")
    spark.read.parquet(f"{SMALL}/labels.parquet").write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame([(1, "other words"), (2, None), (3, ""), (None, "nothing that occurs")], "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    return str(at)


def bag(df):
    return Counter((r.doc_id, r.text) for r in df.collect())


def test_stages_on_odd_rows(spark, folder):
    docs = odd_docs(spark)
    stages = dict(corpus_pipeline.STAGES)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).columns == docs.columns, name
    before = bag(docs)
    assert bag(stages["toxicity"](spark, docs, folder)) == before  # nothing of it is toxic
    # Of equal texts the row with the largest id stays, a named one rather than one without a name.
    exact = bag(stages["exact_dedup"](spark, docs, folder))
    best = {}
    for i, t in before:
        key = (t or "").translate(LOWER)
        best[key] = max(best.get(key, -1), -1 if i is None else i)
    assert Counter((-1 if i is None else i, (t or "").translate(LOWER)) for i, t in exact.elements()) == Counter((i, t) for t, i in best.items())
    # Rows without an id can't be named as another's copy; all rows of an id leave together.
    near = bag(stages["simhash"](spark, docs, folder))
    assert {i for i, _ in near} == {None, 0, 5, 8, 10, 11, 13, 20} and near[None, "other words"] == 1 and near[None, "hello world again and again"] == 1
    # The item of two words occurs in the text of a row without an id: it is hit, but can't be named and stays.
    assert bag(stages["decontaminate"](spark, docs, folder)) == before
    named = docs.withColumn("doc_id", F.coalesce("doc_id", F.lit(77)))
    assert set(bag(named)) - set(bag(stages["decontaminate"](spark, named, folder))) == {(77, "other words"), (77, "hello world again and again")}
    assert stages["byte_bpe"](spark, docs, folder).count() == docs.count()


def test_all_stages_in_a_row(spark, folder):
    odd_docs(spark).write.parquet(f"{folder}/documents.parquet")
    found = Counter(r.doc_id for r in corpus_pipeline.run(spark, folder).collect())
    assert found == Counter([None, 2, 7, 9, 10, 11, 13, 20])


def test_empty_tables(spark, tmp_path):
    no_docs(spark).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_docs(spark), str(tmp_path)).count() == 0
