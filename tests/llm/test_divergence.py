"""The divergence of sources against plain counting and against its SQL."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import pyarrow as pa
import pytest

from tests.llm.test_llm import LOWER, MEDIUM, SMALL, documents, no_docs, odd_docs
from tidemark.llm import divergence


def plain(docs, min_docs=30, top=50):
    """docs: (text, lang, source) of every row."""
    occ, df, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in docs:
        lang, source = lang or "", source or ""
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
        groups[lang].add(source)
        occ[lang, source].update(terms)
        df[lang].update(set(terms))
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in df[lang].items() if n >= min_docs]

        def shares(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 5) // (total + 5 * len(kept)) for t in kept}

        p = {s: shares(occ[lang, s]) for s in sources}
        q = shares(sum((occ[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in sources if o != s]
            over = [(p[s][t] - q[t], t) for t in kept if occ[lang, s][t] and p[s][t] > q[t]]
            for part, items, limit in (("pair", pairs, None), ("term", over, top)):
                for rank, (value, item) in enumerate(sorted(items, key=lambda x: (-x[0], x[1].encode()))[:limit], 1):
                    out.append((lang, s, part, item, value, rank))
    return sorted(out)


def rows(df):
    assert df.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(tuple(r) for r in df.collect())


def triples(df):
    return [(r.text, r.lang, r.source) for r in df.collect()]


@pytest.mark.parametrize("block_bytes", [divergence.BLOCK_BYTES, 1 << 14])
def test_documents(spark, block_bytes):
    found = rows(divergence.source_divergence(documents(spark), min_docs=8, block_bytes=block_bytes))
    assert found == plain(triples(documents(spark)), min_docs=8) and len(found) > 1000


def test_equals_sql(spark):
    con = duckdb.connect()
    for sf in (SMALL, MEDIUM):
        con.execute(f"create or replace view documents as select * from '{Path(sf)}/documents.parquet'")
        cur = con.execute(divergence.OP11_SQL)
        assert [d[0] for d in cur.description] == ["lang", "source", "part", "item", "value", "rank"]
        assert rows(divergence.op11_source_divergence(spark, sf)) == sorted(cur.fetchall())


def test_more_sources_than_a_tile(spark):
    rng, words = random.Random(3), [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(8) for j in range(5)]
    docs = [(" ".join(rng.choices(words, k=rng.randrange(12))), "aa" if i % 9 else "bb", f"s{i % 301}") for i in range(1500)]
    df = spark.createDataFrame(docs, "text string, lang string, source string")
    assert rows(divergence.source_divergence(df, min_docs=5, top=3)) == plain(docs, 5, 3)


def test_odd_rows(spark):
    text = "Ünï—code a-B a_b x y  z\x00q don't 12ab34 ſtrange İ " + "long" * 50_000
    docs = [*triples(odd_docs(spark)), (text, None, "s"), (text, "", None), (None, None, None), ("a\x0bb\x1cc\x85d", "en", "t"), ("", "zz", "only"), ("once", "yy", "u"), (None, "yy", "v")]
    df = spark.createDataFrame([(*d, 1, 2) for d in docs], "text string, lang string, source string, block int, term int")
    for least in (1, 2, 30):
        assert rows(divergence.source_divergence(df, min_docs=least)) == plain(docs, least)
    assert divergence.source_divergence(no_docs(spark)).count() == 0


def test_each_chunk_is_tokenized_once(monkeypatch):
    """Runs of equal chunks, also over the borders of batches, meet the tokenizer once."""
    seen, chunks = [], [f"chunk-{i // 7:03d}{'!' * (i // 7 % 3)}" for i in range(400)] + ["123"]

    class Spy:
        def sub(self, by, text):
            seen.extend(text.split(b"\n"))
            return re.sub(rb"[\x00-\x09\x0B-\x60\x7B-\x7F]+", by, text)

    monkeypatch.setattr(divergence, "OTHERS", Spy())
    monkeypatch.setattr(divergence, "SORTED_ROWS", 10)
    batches = [pa.RecordBatch.from_arrays([pa.array([i % 5 for i in part], pa.int64()), pa.array(part, pa.int32()), pa.array([chunks[i] for i in part])], ["block", "code", "chunk"]) for part in (range(at, min(at + 9, 401)) for at in range(0, 401, 9))]
    found = [(r["of_block"], c, line) for b in divergence._tokenized(iter(batches)) for r in b.to_pylist() for c, line in zip(divergence._unpacked(r["codes"]), r["terms"].split(b"\n"))]
    assert len(seen) == len(set(seen)) == len(set(chunks))
    assert sorted(found) == sorted((i % 5, i, b"chunk") for i in range(400))
