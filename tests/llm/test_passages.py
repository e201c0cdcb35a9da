"""Spans and documents of repeated passages, exactly, on any layout, also where ids repeat."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.test_llm import LOWER, SMALL, documents
from tidemark.llm import suffix_dedup


def plain_spans(docs, n=50):
    """``id, first word, end word, least other id`` of every text of an id."""
    seen, texts = defaultdict(set), {(i, tuple((t or "").translate(LOWER).split())) for i, t in docs if i is not None}
    for i, words in texts:
        for k in range(len(words) - n + 1):
            seen[words[k : k + n]].add(i)
    out = []
    for i, words in texts:
        spans = []
        for k in range(len(words) - n + 1):
            if others := seen[words[k : k + n]] - {i}:
                if spans and k <= spans[-1][1]:
                    spans[-1] = (spans[-1][0], k + n, min(spans[-1][2], *others))
                else:
                    spans.append((k, k + n, min(others)))
        out += [(i, *s) for s in spans]
    return sorted(out)


def spans(df, **kw):
    return sorted((r.doc_id, r.first_word, r.end_word, r.other_id) for r in suffix_dedup.repeated_passages(df, **kw).collect())


@pytest.fixture()
def plain_plans(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark
    spark.conf.unset("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "4")


@pytest.mark.parametrize(("partitions", "held"), [(2, suffix_dedup.HELD), (97, suffix_dedup.HELD), (5, 8), (3, 0)])
def test_spans_and_least_documents_on_any_layout(plain_plans, partitions, held):
    spark, rng = plain_plans, random.Random(3)
    rows = [(r.doc_id, r.text) for r in documents(spark, SMALL).collect()]
    rows += [(10**6 + i, " ".join(f"q{j}" for j in range(i, i + 70))) for i in range(40)]
    shared = [" ".join(f"s{k}x{i}" for i in range(80)) for k in range(5)]
    for i in rng.sample(range(2000, 4000), 60):
        words = rng.choice(shared).split()
        at = rng.randrange(20)
        rows.append((i, " ".join([f"n{i}"] * rng.randrange(3) + words[at : at + rng.randrange(50, 61)] + rng.choice(shared).split())))
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    found = spans(spark.createDataFrame(rows, "doc_id long, text string").repartition(7), held=held)
    assert found == plain_spans(rows) and len(found) > 100


@pytest.mark.parametrize("held", [suffix_dedup.HELD, 0])
def test_texts_that_share_an_id(plain_plans, held):
    spark, p, q = plain_plans, [f"p{i}" for i in range(60)], [f"q{i}" for i in range(60)]
    noise = lambda k: [f"x{k}y{i}" for i in range(40)]
    rows = [(1, " ".join(p + noise(1))), (1, " ".join(noise(2) + q)), (1, " ".join(noise(2) + q)), (2, " ".join(p)), (3, " ".join(q)), (None, " ".join(q))]
    only = [f"o{i}" for i in range(70)]
    rows += [(7, " ".join(only)), (7, " ".join(["b", *only]))]  # two texts of one id have only each other
    found = spans(spark.createDataFrame(rows, "doc_id long, text string"), held=held)
    assert found == plain_spans(rows) == [(1, 0, 60, 2), (1, 40, 100, 3), (2, 0, 60, 1), (3, 0, 60, 1)]


@pytest.mark.parametrize("n", [30, 60])
def test_equal_contexts_are_one_row_and_a_span_for_each_place(n):
    """Spans grow with the places, not with their pairs; every document names the least other one."""
    context = [np.arange(1, 43, dtype=">u4").tobytes(), np.arange(50, 92, dtype=">u4").tobytes()]
    columns = [pa.array([f"{i:03d}" for i in range(n)]), pa.array(range(n), pa.int64()), pa.array([7] * n, pa.int64()), *(pa.array([c] * n, pa.binary()) for c in context), pa.array([[100, 900]] * n, pa.list_(pa.int32()))]
    rows = pa.RecordBatch.from_arrays(columns, suffix_dedup.COLUMNS)
    (found,) = suffix_dedup.spans_of([rows], 50)
    assert found.num_rows == 1
    (spans,) = suffix_dedup.class_spans(iter([found]))
    assert spans.num_rows == 2 * n
    assert {(r["id"], r["start"], r["stop"], r["other"]) for r in spans.to_pylist()} == {(f"{i:03d}", p - 42, p + 50, "000" if i else "001") for i in range(n) for p in (100, 900)}


def edited(rng, n):
    """Copies of a passage, each with two words of its own."""
    out = []
    for i in range(n):
        words = [f"e{k}" for k in range(150)]
        for k in rng.sample(range(150), 2):
            words[k] = f"own{i}x{k}"
        out.append(words)
    return out


@pytest.mark.parametrize("n", [150, 300])
def test_windows_of_open_classes_are_those_that_another_can_share(n):
    """Of near copies, few windows that occur once are made (at most those of border rows), and all that occur twice."""
    copies = [w[45:137] for w in edited(random.Random(5), n)]  # 42 words, a k-gram that all have, 42 words
    contexts = sorted({(tuple(w[50:]), tuple(w[:42][::-1])) for w in copies if w[42:50] == [f"e{k}" for k in range(87, 95)]})
    code = {w: i for i, w in enumerate(sorted({w for c in contexts for side in c for w in side}), 1)}
    coded = [tuple(np.array([code[w] for w in side], ">u4").tobytes() for side in c) for c in contexts]
    m = len(coded)
    columns = [pa.array(range(m), pa.int64()), pa.array([7] * m, pa.int64()), pa.array([7] * m, pa.int64()), *(pa.array(side, pa.binary()) for side in zip(*sorted(coded))), pa.array([[42]] * m, pa.list_(pa.int32()))]
    heads, _ = suffix_dedup.open_rows([pa.RecordBatch.from_arrays(columns, suffix_dedup.COLUMNS)], 50)
    classes = pa.Table.from_batches([heads]).rename_columns({"id": "lo"}).append_column("next_lo", pa.nulls(m, pa.int64()))
    classes = classes.sort_by([("gram", "ascending"), ("before", "ascending"), ("suffix", "ascending")]).combine_chunks()
    made = [(r["j"], r["h"]) for b in suffix_dedup.window_hashes(50)(iter(classes.to_batches())) for r in b.to_pylist()]
    every = Counter((j, before[:j], after[: 42 - j]) for after, before in contexts for j in range(43))
    shared = sorted(k for k in every.values() if k > 1)
    assert sorted(k for k in Counter(made).values() if k > 1) == shared
    assert len(made) - sum(shared) <= m + 4 * 43 < sum(every.values()) - sum(shared)


@pytest.mark.parametrize(("partitions", "held"), [(5, suffix_dedup.HELD), (7, 8), (3, 0)])
def test_near_copies_behind_borders(plain_plans, partitions, held):
    spark, rng = plain_plans, random.Random(6)
    rows = [(i // 2 if i % 7 == 0 else i, " ".join(w)) for i, w in enumerate(edited(rng, 120))]
    rows += [(i + 500, t) for i, t in rows[:5]]
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    found = spans(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), held=held)
    assert found == plain_spans(rows) and len(found) > 100
