"""The training-data operators against brute force, round trips and held-out labels, and on odd inputs."""

from __future__ import annotations

import base64
import hashlib
import importlib
import random
import re
import sys
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import bpe, decontam, exact_dedup, language_id, lm_scoring, quality, simhash, suffix_dedup, toxicity, warc
from tidemark.llm.common import materialise

SMALL, MEDIUM, LARGE = "/root/testdata/sf0.001", "/root/testdata/sf0.01", "/root/testdata/sf0.1"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, id string, score int, row string, norm string, fp string"
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def odd_docs(spark):
    """Nulls, empty and very long texts, ties, repeated rows, extra columns with names that operators use."""
    long = " ".join(f"word{i % 997}" for i in range(60_000))
    rows = [(0, "Hello World again and again"), (1, "hello world again and again"), (1, "hello world again and again"), (2, "HELLO WORLD AGAIN AND AGAIN"), (None, "other words"), (None, "hello world again and again")]
    rows += [(5, None), (6, ""), (7, None), (8, long), (9, long), (10, "Ünïcode Straße ÀÉ"), (11, "ünïcode straße àé"), (12, " \t\n"), (13, "!!! 123"), (20, "x" * 300_000)]
    return spark.createDataFrame([(i, t, "en" if t else None, None, None, "a", 1, "r", None, "f") for i, t in rows], DOCS)


def no_docs(spark):
    return odd_docs(spark).limit(0)


def documents(spark, sf=SMALL):
    return spark.read.parquet(f"{sf}/documents.parquet")


# ---- exact dedup -----------------------------------------------------------------------------------


@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_exact_dedup_on_odd_rows(spark, keep):
    rows = [(r.doc_id, (r.text or "").translate(LOWER)) for r in odd_docs(spark).collect()]
    groups = defaultdict(list)
    for i, t in rows:
        groups[t].append(i)
    best = max if keep == "largest" else min
    want = sorted((str(i), str(best((x for x in groups[t] if x is not None), default=None)), len(groups[t]), hashlib.sha256(t.encode()).hexdigest()) for i, t in rows)
    found = exact_dedup.exact_dedup(odd_docs(spark), keep=keep).collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.text_sha256) for r in found) == want
    assert sum(r.kept for r in found) == sum(any(i is not None for i in g) or len(g) == 1 for g in groups.values())


def test_exact_dedup_of_a_hot_text(spark):
    df = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "The Same").otherwise(F.concat(F.lit("t"), F.col("id") % 500)).alias("text"), F.lit(1).alias("extra"))
    found = exact_dedup.exact_dedup(df, keep="largest")
    row = found.where("doc_id = 0").first()
    assert (row.keep_id, row.group_size, row.kept) == (3999, 1334, False)
    kept = exact_dedup.drop_exact_copies(df)
    assert kept.columns == df.columns and kept.count() == df.select(F.lower("text")).distinct().count()
    assert exact_dedup.exact_dedup(no_docs(spark)).count() == 0


# ---- BPE -------------------------------------------------------------------------------------------

PATH = public_tokenizers.path(bpe.VOCABULARY)


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@given(st.text(max_size=200))
@settings(max_examples=300, deadline=None)
def test_bpe_equals_the_library(reference, text):
    text = text.encode("utf-8", "ignore").decode()
    ids = bpe.encode(text, PATH)
    assert np.frombuffer(ids, "<u4").tolist() == reference.encode_ordinary(text)
    assert bpe.decode(ids, PATH).decode() == text


@given(st.binary(min_size=1, max_size=40), st.binary(max_size=20), st.data())
@settings(max_examples=200, deadline=None)
def test_appends_and_edits_equal_a_fresh_start(piece, more, data):
    v = bpe._worker(PATH, public_tokenizers.PATTERN)[0]
    grown = bpe.PrefixEncoder(v, piece)
    grown.append(more)
    assert grown.ids() == bpe.PrefixEncoder(v, piece + more).ids()
    a = data.draw(st.integers(0, len(piece + more)))
    b = data.draw(st.integers(a, len(piece + more)))
    grown.replace(a, b, b"new")
    assert grown.ids() == bpe.PrefixEncoder(v, (piece + more)[:a] + b"new" + (piece + more)[b:]).ids()


def test_bpe_of_documents(spark, reference):
    for docs in (odd_docs(spark), documents(spark)):
        want = sorted((str(r.doc_id), len(ids := reference.encode_ordinary(r.text or "")), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()) for r in docs.collect())
        assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.round_trip(docs).collect()) == want
    assert bpe.round_trip(no_docs(spark)).count() == 0
    two = bpe.decode_documents(bpe.encode_documents(documents(spark), PATH), PATH)
    assert two.join(documents(spark), "doc_id").where(F.col("decoded") != F.col("text").cast("binary")).count() == 0


# ---- decontamination -------------------------------------------------------------------------------

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_contamination(docs, items, window=10):
    windows = defaultdict(set)
    for i, t in items:
        words = WORD.findall((t or "").translate(LOWER))
        for k in range(max(1, len(words) - window + 1) if words else 0):
            windows[tuple(words[k : k + window])].add("null" if i is None else str(i))
    out = []
    for i, t in docs:
        words = WORD.findall((t or "").translate(LOWER))
        hit, found = set(), set()
        for n in {len(w) for w in windows}:
            for k in range(len(words) - n + 1):
                if owners := windows.get(tuple(words[k : k + n])):
                    hit |= set(range(k, k + n))
                    found |= owners
        out.append((str(i), len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out)


@pytest.mark.parametrize("block", [1 << 24, 4000])
def test_decontamination(spark, block):
    docs, items = documents(spark), spark.read.parquet(f"{SMALL}/benchmark.parquet")
    assert _contamination(docs, items, block) == brute_contamination([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])


def _contamination(docs, items, block=1 << 24):
    found = decontam.find_contamination(docs, items, block_bytes=block).collect()
    return sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in found)


@pytest.mark.parametrize("block", [1 << 24, 40])
def test_decontamination_on_odd_rows(spark, block):
    items = spark.createDataFrame([(1, "Hello world"), (2, "AGAIN"), (2, "again"), (3, None), (4, ""), (None, "other, words!"), (6, "word1 word2 word3 word4 word5 word6 word7 word8 word9 word10 word11 word12"), (7, "àé")], "item_id long, text string")
    docs = odd_docs(spark).select("doc_id", "text")
    docs = docs.unionAll(docs).unionAll(spark.createDataFrame([(99, "hello world, again")], "doc_id long, text string").withColumn("doc_id", F.col("doc_id").cast(dict(docs.dtypes)["doc_id"])))
    assert _contamination(docs, items, block) == brute_contamination([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert not any(r[-1] for r in _contamination(docs, items.limit(0), block))
    assert _contamination(no_docs(spark), items, block) == []


def test_wu_manber_against_scanning():
    rng = random.Random(1)
    words = [b"abc"[i : i + 1] for i in rng.choices(range(3), k=3000)]
    for n in (1, 2, 3, 5):
        patterns = list({tuple(rng.choices([b"a", b"b", b"c"], k=n)) for _ in range(4)})
        want = [(i, tuple(words[i : i + n])) for i in range(len(words) - n + 1) if tuple(words[i : i + n]) in patterns]
        assert list(decontam.WuManber(patterns, n).search(words)) == want


# ---- SimHash ---------------------------------------------------------------------------------------


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def plain_components(fps):
    names = sorted(set(fps))
    parent = {f: f for f in names}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(names):
        for b in names[i + 1 :]:
            if (a ^ b).bit_count() <= 2:
                parent[max(find(a), find(b))] = min(find(a), find(b))
    return {f: find(f) for f in names}


def check_simhash(docs):
    rows = [(r.doc_id, plain_fingerprint(r.text)) for r in docs.collect()]
    roots, least = plain_components([f for _, f in rows]), {}
    for i, f in rows:
        if i is not None:
            least[roots[f]] = min(least.get(roots[f], i), i)
    want = sorted((str(i), f"{f:016x}", str(least.get(roots[f]))) for i, f in rows)
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in simhash.near_duplicates(docs).collect()) == want


def test_simhash(spark):
    check_simhash(odd_docs(spark))
    check_simhash(documents(spark))
    assert simhash.near_duplicates(no_docs(spark)).count() == 0


def test_links_in_crowded_buckets(spark, monkeypatch):
    rng = random.Random(3)
    centre = rng.getrandbits(64)
    fps = {centre}
    while len(fps) < 120:
        fps.add(rng.choice(sorted(fps)) ^ (1 << rng.randrange(64)) ^ rng.choice([0, 1 << rng.randrange(64)]))
    fps |= {rng.getrandbits(64) for _ in range(80)}
    df = spark.createDataFrame([(simhash.signed(f),) for f in fps], "fp long")
    want = plain_components(fps)
    for crowd in (1000, 4):
        monkeypatch.setattr(simhash, "CROWD", crowd)
        roots = {r.node % 2**64: r.root for r in simhash.components(simhash.links(df)).collect()}
        got = defaultdict(set)
        for f in fps:
            got[roots.get(f, simhash.signed(f))].add(f)
        expected = defaultdict(set)
        for f in fps:
            expected[want[f]].add(f)
        assert sorted(map(sorted, got.values())) == sorted(map(sorted, expected.values()))


def test_thresholds_add_up():
    cost, chosen = simhash.allocate([{-1: 0.0, 0: 5.0, 1: 50.0}, {-1: 0.0, 0: 1.0, 1: 2.0}], 1)
    assert (cost, chosen) == (7.0, [0, 1])


# ---- repeated passages -----------------------------------------------------------------------------


def plain_repeats(docs, n=50):
    seen, words = defaultdict(set), {}
    for i, t in docs:
        words[i] = (t or "").translate(LOWER).encode().split()
        for k in range(len(words[i]) - n + 1):
            seen[tuple(words[i][k : k + n])].add(i)
    return {i: {j for k in range(len(w) - n + 1) if len(seen[tuple(w[k : k + n])]) > 1 for j in range(k, k + n)} for i, w in words.items()}


def test_repeated_passages(spark):
    docs = documents(spark, MEDIUM)
    want = plain_repeats([(r.doc_id, r.text) for r in docs.collect()])
    got = defaultdict(set)
    for r in suffix_dedup.repeated_passages(docs).collect():
        assert r.doc_id != r.other_id and r.n_words >= 50
        got[r.doc_id] |= set(range(r.first_word, r.end_word))
    total, hit = sum(map(len, want.values())), sum(len(want[i] & got[i]) for i in want)
    assert hit >= 0.99 * total and sum(len(got[i] - want[i]) for i in want) <= 0.001 * total
    assert {i for i in want if want[i]} == {i for i in got if got[i]}


def test_repeats_in_many_documents_and_odd_rows(spark):
    rng = random.Random(2)
    passage = [f"p{i}" for i in range(60)]
    text = lambda: [f"w{rng.randrange(10**6)}" for _ in range(80)]
    rows = [(i, " ".join(text() + passage + text())) for i in range(200)] + [(1000 + i, " ".join(text())) for i in range(50)] + [(2000, "of " * 400), (2001, None), (2002, "")]
    found = suffix_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id for r in found} == set(range(200)) and all(r.first_word == 80 and r.end_word == 140 for r in found)
    assert {r.doc_id for r in suffix_dedup.repeated_passages(odd_docs(spark)).collect()} == {8, 9}
    assert suffix_dedup.repeated_passages(no_docs(spark)).count() == 0


@pytest.fixture()
def fixed_partitions(spark):
    """Small inputs stay in several partitions."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.enabled")


def found_words(spark, rows):
    got = defaultdict(set)
    for r in suffix_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        got[r.doc_id] |= set(range(r.first_word, r.end_word))
    return got


@pytest.mark.parametrize("line", [24, 70])
def test_copies_of_a_long_text_of_one_line(spark, fixed_partitions, line):
    text = " ".join([f"w{i}" for i in range(line)] * (100_000 // line))
    rows = [(1, text), (2, text), (3, " ".join(f"x{i}" for i in range(3000)))]
    got, n = found_words(spark, rows), len(text.split())
    assert (len(got[1]), len(got[2]), len(got[3])) == (n, n, 0)


def test_shifted_passages_of_templated_lines(spark):
    rng, rows = random.Random(7), []
    for k in range(60):
        phrase, size = [f"c{k}x{i}" for i in range(10)], rng.randrange(1, 7)
        lines = lambda n, phrase=phrase, size=size: [w for _ in range(n) for w in [*phrase, *(f"f{rng.randrange(10**9)}" for _ in range(size))]]
        passage = lines(6)
        for side in range(2):
            rows.append((2 * k + side, " ".join(lines(rng.randrange(2, 9)) + passage[: 10 + 5 * (10 + size)] + lines(rng.randrange(2, 9)))))
    want, got = plain_repeats(rows), found_words(spark, rows)
    assert {i: sorted(w) for i, w in want.items()} == {i: sorted(got[i]) for i in want}


def test_passages_behind_boilerplate(spark, fixed_partitions):
    """Two documents share 60 words; sixty others share only 45 of them, and stand between the two in any order."""
    rng, rows = random.Random(5), []
    for k in range(30):
        passage = [f"b{k}x{i}" for i in range(60)]
        for n in range(62):
            shared = passage if n < 2 else passage[(at := rng.randrange(16)) : at + 45]
            noise = lambda k=k, n=n: [f"n{k}x{n}x{rng.randrange(10**9)}" for _ in range(30)]
            rows.append((100 * k + n, " ".join(noise() + shared + noise())))
    want, got = plain_repeats(rows), found_words(spark, rows)
    assert {i for i in want if want[i]} == {100 * k + n for k in range(30) for n in range(2)}
    assert {i: sorted(w) for i, w in want.items()} == {i: sorted(got[i]) for i in want}


def plain_others(docs, n=50):
    seen = defaultdict(set)
    grams = lambda t: zip(*((t or "").translate(LOWER).split()[i:] for i in range(n)))
    for i, t in docs:
        for g in grams(t):
            seen[g].add(i)
    return {(i, j) for owners in seen.values() if len(owners) > 1 for i in owners for j in owners - {i}}


@pytest.mark.parametrize("held", [suffix_dedup.HELD, 8, 0])
def test_crowded_kgrams_take_another_way_to_the_same_result(spark, fixed_partitions, held):
    rows = [(r.doc_id, r.text) for r in documents(spark).collect()] + [(10**6 + i, " ".join(f"q{j}" for j in range(i, i + 70))) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    found = suffix_dedup.repeated_passages(docs, held=held).collect()
    want, got = plain_repeats(rows), defaultdict(set)
    for r in found:
        got[r.doc_id] |= set(range(r.first_word, r.end_word))
    assert {i: w for i, w in want.items() if w} == {i: w for i, w in got.items() if w}
    assert {(r.doc_id, r.other_id) for r in found} <= plain_others(rows)


def test_passages_of_text_ids(spark):
    passage = " ".join(f"w{i}" for i in range(55))
    docs = spark.createDataFrame([("b", passage, 1), ("ä", "x " + passage, 2), (None, passage, 3), ("c", passage[:-4], 4), ("c", passage, 5)], "doc_id string, text string, id int")
    assert {(r.doc_id, r.first_word, r.end_word) for r in suffix_dedup.repeated_passages(docs).collect()} == {("b", 0, 55), ("c", 0, 54), ("c", 0, 55), ("ä", 1, 56)}


# ---- WARC ------------------------------------------------------------------------------------------


def plain_pages(rows):
    first = {}
    for i, _, h in rows:
        p = (h or "").encode()
        if len(p) >= 100 and i is not None:
            first[p] = min(first.get(p, i), i)
    out = []
    for i, _, h in rows:
        p = (h or "").encode()
        refers = first.get(p) if i is not None and len(p) >= 100 and i > first[p] else None
        out.append((str(i), len(p), hashlib.sha256(p).hexdigest(), "response" if refers is None else "revisit", str(refers)))
    return sorted(out)


def test_warc(spark):
    same, odd = "ä" * 80, "a\r\n\r\nWARC/1.1\r\nb" * 20
    rows = [(1, "http://b.example.com/x?q=1", same), (2, "http://b.example.com/x?q=1", same), (2, "http://b.example.com/x?q=1", same), (1, "http://a.org/", same), (None, None, same), (None, "http://a.org/", None)]
    rows += [(12, "http://[a\tb", "tab"), (13, "http://[a!b", "mark"), (14, "http://[a\nb", "line")]
    rows += [(5, None, None), (6, "", ""), (7, "not a url \n\t[", odd), (8, "http://[bad", odd), (9, "http://x.org/" + "p" * 5000, "short"), (10, "HTTP://X.org:8080/A", "short"), (11, "http://y.org/ä ö", "z" * 2_000_000)]
    df = spark.createDataFrame([(*r, "v", 1) for r in rows], "page_id long, url string, html string, id string, payload int")
    assert sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, str(r.refers_to)) for r in warc.archive_and_read(df).collect()) == plain_pages(rows)
    pages = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()]
    assert sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, str(r.refers_to)) for r in warc.op3_warc(spark, SMALL).collect()) == plain_pages(pages)
    assert warc.archive_and_read(df.limit(0)).count() == 0


def test_warc_of_many_equal_pages_and_text_ids(spark):
    html = F.when(F.col("id") % 3 > 0, F.lit("same " * 40)).otherwise(F.concat(F.lit("own " * 40), F.col("id") % 700))
    pages = spark.range(10_000).select(F.concat(F.lit("p-"), F.col("id")).alias("page_id"), F.concat(F.lit("http://h.org/"), F.col("id") % 97).alias("url"), html.alias("html"))
    rows = [(r.page_id, r.url, r.html) for r in pages.collect()]
    assert sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, str(r.refers_to)) for r in warc.archive_and_read(pages).collect()) == plain_pages(rows)


def test_a_capture_that_is_not_there_is_an_error(spark, tmp_path):
    pages = spark.range(20).selectExpr("id as page_id", "concat('http://h.org/', id) as url", "'x' as html")
    manifest = warc.write_archives(pages, f"file://{tmp_path}")
    shards = warc.build_index(manifest, f"file://{tmp_path}")
    with pytest.raises(Exception, match="no capture of page 99"):
        warc.read_captures(manifest.limit(1).withColumn("id", F.lit("=99")), f"file://{tmp_path}", shards).collect()


def test_index_lookup_returns_payloads(spark, tmp_path):
    pages = spark.range(500).select(F.col("id").alias("page_id"), F.concat(F.lit("http://h"), F.col("id") % 7, F.lit(".org/"), F.col("id") % 11).alias("url"), F.concat(F.lit("page "), F.col("id")).alias("html"))
    folder = f"file://{tmp_path}"
    manifest = warc.write_archives(pages, folder)
    shards = warc.build_index(manifest, folder, block_lines=8)
    wanted = manifest.where("cast(substr(id, 2) as int) % 50 = 3").unionByName(manifest.limit(1).withColumn("id", F.lit("=1000000000")))  # one that isn't there
    found = {r.id: bytes(r.payload).decode() for r in warc.read_captures(wanted, folder, shards, missing="skip").collect()}
    assert found == {str(i): f"page {i}" for i in range(3, 500, 50)}


# ---- language model --------------------------------------------------------------------------------


def plain_log_probability(model, near, token):
    """One token at a time, branch by branch."""
    net, tree = model.network, model.tree
    hidden = np.tanh(net.shared[-1] + sum(net.shared[k] * net.embed[x] for k, x in enumerate(near)))
    total = 0.0
    for level in range(tree.size[token]):
        node, upper = divmod(int(tree.levels[level, token]), 2)
        z = float(net.node[node] @ hidden + net.bias[node, 0])
        total -= np.log1p(np.exp(-z if upper else z))
    return total


def test_lm_scores_equal_a_plain_loop(spark):
    docs = documents(spark)
    model = lm_scoring.fit(docs, own=200)
    vocabulary, counts = lm_scoring.Vocabulary(model.words), defaultdict(int)
    words = lambda t: (t or "").translate(LOWER).encode().split()
    for r in docs.collect():
        for w in words(r.text):
            counts[w] += 1
    others = sum(n for w, n in counts.items() if w not in vocabulary)
    assert len(model.words) == 200 and others == model.others > 0
    rows = {r.doc_id: r for r in lm_scoring.score(docs, model).collect()}
    for r in docs.limit(10).collect():
        own = words(r.text)
        tokens = [vocabulary.get(w, vocabulary.other) for w in own]
        total = 0.0
        for i, (w, token) in enumerate(zip(own, tokens)):
            near = [tokens[i + o] if 0 <= i + o < len(tokens) else vocabulary.outside for o in lm_scoring.OFFSETS]
            total += plain_log_probability(model, near, token) + (np.log(counts[w] / others) if token == vocabulary.other else 0)
        assert rows[r.doc_id].n_tokens == len(tokens) and abs(rows[r.doc_id].pseudo_log_likelihood - total) < 1e-2 + 1e-4 * abs(total)


def test_lm_probabilities_add_up_to_one(spark):
    docs = documents(spark)
    model = lm_scoring.fit(docs, own=300)
    for near in ([0, 1, 2, 3], [301, 301, 5, 300], [7, 7, 7, 301]):
        assert abs(sum(np.exp(plain_log_probability(model, near, t)) for t in range(301)) - 1) < 1e-4
    # The words that share a code have all of its probability among them.
    counts = model.counts.collect()
    rare = [r.n / model.others for r in counts if bytes(r.word) not in set(model.words)]
    assert abs(sum(rare) - 1) < 1e-9 and {r.h for r in counts} == {xxhash.xxh64_intdigest(bytes(r.word), 42) - (1 << 64) * (xxhash.xxh64_intdigest(bytes(r.word), 42) >> 63) for r in counts}


def test_lm_gradients_equal_finite_differences():
    rng = np.random.default_rng(8)
    tree = lm_scoring.Tree.of(rng.integers(1, 50, 12).tolist())
    net = lm_scoring.Network.start(tree, dim=5)
    net = lm_scoring.Network(*(p.astype(float) + rng.normal(0, 0.3, p.shape) for p in net.parts()))
    tokens, at = lm_scoring.padded([rng.integers(0, 12, n).astype(np.uint16) for n in (7, 1, 12)], 12)
    at = at[::2]
    loss = lambda: -lm_scoring.log_probabilities(net, tree, tokens, at).sum()
    for part, (rows, grad, uses) in zip(net.parts(), lm_scoring.gradients(net, tree, tokens, at)):
        full = np.zeros(part.shape)
        full[rows] = grad
        assert (uses > 0).all()
        for i in np.ndindex(part.shape):
            before = part[i]
            part[i] = before + 1e-5
            up = loss()
            part[i] = before - 1e-5
            down = loss()
            part[i] = before
            assert abs((up - down) / 2e-5 - full[i]) < 1e-3


def test_lm_network_in_columns_equals_single_positions():
    rng = np.random.default_rng(4)
    tree = lm_scoring.Tree.of(rng.integers(1, 50, 30).tolist())
    net = lm_scoring.Network(*(p + rng.normal(0, 0.3, p.shape) for p in lm_scoring.Network.start(tree, dim=6).parts()))
    tokens, at = lm_scoring.padded([rng.integers(0, 30, n).astype(np.uint16) for n in (1, 40, 3)], 30)
    batch = lm_scoring.Batch.of(tree, tokens, at[1:])
    hidden = net.hidden(lm_scoring.columns_of(net.embed, batch.context), batch.at)
    for i, p in enumerate(at[1:][batch.order]):
        plain = np.tanh(net.shared[-1] + sum(net.shared[k] * net.embed[tokens[p + off]] for k, off in enumerate(lm_scoring.OFFSETS)))
        assert np.allclose(hidden[:, i], plain)
        logits = [m[i] for _, _, _, m in batch.branches(net, tree, hidden) if i < len(m)]
        branches = tree.levels[: tree.size[tokens[p]], tokens[p]]
        assert np.allclose(logits, [((b & 1) * 2 - 1) * (net.node[b >> 1] @ plain + net.bias[b >> 1, 0]) for b in branches])


def test_lm_step_is_adagrad_on_the_gradients():
    rng = np.random.default_rng(9)
    tree = lm_scoring.Tree.of([5, 4, 3, 2, 1])
    net = lm_scoring.Network.start(tree, dim=3)
    tokens, at = lm_scoring.padded([rng.integers(0, 5, 9).astype(np.uint16)], 5)
    trainer, seen, plain = lm_scoring.Trainer(net, tree), [np.full_like(p, 0.1) for p in net.parts()], net.copy()
    for _ in range(3):
        grads = lm_scoring.gradients(plain, tree, tokens, at)
        trainer.step(tokens, at)
        for value, total, (rows, grad, _) in zip(plain.parts(), seen, grads):
            for r, g in zip(rows, grad):
                total[r] += g * g
                value[r] -= 0.1 * g / np.sqrt(total[r])
    assert all(np.allclose(a, b, atol=1e-5) for a, b in zip(trainer.net.parts(), plain.parts()))


def test_lm_scores_do_not_depend_on_partitions(spark):
    docs = documents(spark, MEDIUM).limit(600)
    few, many = ({r.doc_id: r.pseudo_log_likelihood for r in lm_scoring.score_corpus(docs.repartition(n), own=500, shard_tokens=40_000).collect()} for n in (2, 24))
    assert len(few) == 600 and all(abs(few[i] - many[i]) <= 1e-9 * (1 + abs(few[i])) for i in few)


def test_lm_learns_and_handles_odd_rows(spark):
    docs = documents(spark, MEDIUM)
    mean = lambda rounds: lm_scoring.score_corpus(docs, rounds=rounds, shard_tokens=100_000).agg(F.sum("pseudo_log_likelihood") / F.sum("n_tokens")).first()[0]
    assert mean(2) > mean(0) + 0.3
    odd = odd_docs(spark)
    found = lm_scoring.score_corpus(odd).collect()
    assert len(found) == odd.count() and all(r.pseudo_log_likelihood == 0 for r in found if not r.n_tokens)
    assert lm_scoring.score_corpus(no_docs(spark)).count() == 0
    unseen = spark.createDataFrame([(1, "never seen"), (2, None)], "doc_id long, text string")
    assert [r.n_tokens for r in lm_scoring.score(unseen, lm_scoring.fit(docs, own=50)).orderBy("doc_id").collect()] == [2, 0]


def test_lm_trains_on_every_token(spark):
    docs = spark.range(60_000).selectExpr("id as doc_id", "'a b c d e' as text")
    model = lm_scoring.fit(docs)
    tokens, at = lm_scoring.padded([lm_scoring.Vocabulary(model.words).tokens(list(map(str.encode, "abcde")))], lm_scoring.Vocabulary(model.words).outside)
    assert lm_scoring.log_probabilities(model.network, model.tree, tokens, at).min() > np.log(0.5)
    tokens = lm_scoring.tokenise(docs, model.words, "doc_id", "text").limit(900)
    seen, start = [], model.network.copy()
    for turn in range(3):  # a fresh network trains on the documents of one round; all rounds together use every token
        trained = lm_scoring.train_round(tokens, 2, start, model.tree, turn, 3)
        seen.append(not np.array_equal(trained.embed, start.embed))
    assert all(seen) and sum(tokens.where(F.pmod(F.xxhash64("id", "tokens"), F.lit(3)) == t).count() for t in range(3)) == 900


def test_frequent_words_of_each_level(spark):
    df = spark.createDataFrame([(f"w{i}".encode(), 1000 // (i + 1) + 1) for i in range(2000)], "word binary, n long").withColumn("h", F.xxhash64("word"))
    for most in (1, 10, 700, 1999, 5000):
        found = lm_scoring.frequent_words(df, most)
        assert len(found) == min(most, 2000) and found[0][1] == 1001
        assert min(n for _, n in found) >= max([r.n for r in df.collect() if bytes(r.word) not in dict(found)], default=0) * 0.98


# ---- classifiers -----------------------------------------------------------------------------------


def test_language_of_held_out_documents(spark):
    docs = documents(spark, MEDIUM)
    rows = language_id.identify_languages(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(rows) > 100 and sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows) and all(0 <= r.score <= 1 for r in rows)


def test_string_kernel_equals_plain_ridge_regression():
    """Kernel values from sets of n-grams, the regression in landmark coordinates solved as a plain least-squares problem."""
    rng, letters = random.Random(6), language_id.letter_table()
    alphabets = {"a": "abcdefg ", "b": "fghijkl ", "zh": "的一是不了人我在 "}
    texts = [("".join(rng.choices(alphabets[k], k=60)), k) for k in alphabets for _ in range(12)]
    grams = [np.flatnonzero(language_id.present(t, letters)) for t, _ in texts]
    model = language_id.KernelClassifier(grams, [k for _, k in texts], landmarks=4)
    sets = [set(g.tolist()) for g in grams]
    kernel = lambda x, y: len(x & y) / np.sqrt(len(x) * len(y))
    marks = [sets[i] for k in range(3) for i in range(12 * k, 12 * k + 4)]
    k_nm = np.array([[kernel(x, m) for m in marks] for x in sets])
    values, vectors = np.linalg.eigh(np.array([[kernel(x, m) for m in marks] for x in marks]) + 1e-6 * np.eye(12))
    phi = np.hstack([k_nm @ (vectors / np.sqrt(np.maximum(values, 1e-6)) @ vectors.T), np.ones((36, 1))])
    target = np.array([[1.0 if k == c else -1.0 for c in "a b zh".split()] for _, k in texts])
    ridge = np.sqrt(1e-3 * 36 / 100) * np.eye(13)
    beta = np.linalg.lstsq(np.vstack([phi, ridge]), np.vstack([target, np.zeros((13, 3))]), rcond=None)[0]
    langs, odds = model.predict([t for t, _ in texts], letters)
    want = np.exp(4 * (phi @ beta))
    assert langs == [k for _, k in texts] == ["a b zh".split()[i] for i in want.argmax(axis=1)]
    assert np.allclose(odds, want.max(axis=1) / want.sum(axis=1), atol=1e-2)


def test_every_label_is_learned(spark):
    """More labels than landmarks and texts in all, and ids that repeat."""
    rows = [(i, chr(0x4E00 + 40 * (i % 90)) * 3 + chr(0x4E01 + 40 * (i % 90)) * 4, f"l{i % 90}") for i in range(2000)]
    docs = spark.createDataFrame(rows + rows[:300], "doc_id long, text string, lang string")
    found = language_id.identify_languages(docs, texts=180, most_landmarks=90).join(docs.distinct(), "doc_id").collect()
    assert sum(r.lang == r.lang_pred for r in found) >= 0.95 * len(found)


def test_quality_training_equals_a_plain_loop():
    docs = [quality.document_weights(t) for t in ("good words here", "bad bad words", "good good", "bad here")]
    labels, epochs = [1, 0, 1, 0], 2
    model = quality.SubwordClassifier(docs, labels, (0.5, 0.5), epochs=epochs)
    rng = np.random.default_rng(7)
    vectors = rng.uniform(-1 / quality.DIM, 1 / quality.DIM, (quality.BUCKETS, quality.DIM)).astype(np.float32).astype(float)
    out, bias, done = np.zeros((2, quality.DIM)), np.zeros(2), 0
    for _ in range(epochs):
        for i in rng.permutation(4):
            step, (at, weight) = 1 - done / (4 * epochs), docs[i]
            done += 1
            hidden = sum(w * vectors[b] for b, w in zip(at, weight))
            z = np.exp(out @ hidden + bias)
            error = z / z.sum() - np.eye(2)[labels[i]]
            back = error @ out
            out, bias = out - step * np.outer(error, hidden), bias - 0.1 * step * error
            for b, w in zip(at, weight):
                vectors[b] -= step * w / (weight @ weight) * 0.05 * back
    used = np.unique(np.concatenate([at for at, _ in docs]))
    assert np.allclose(model.gain[used], vectors[used] @ (out[1] - out[0]), atol=1e-5) and abs(model.bias - (bias[1] - bias[0])) < 1e-5


def test_language_of_odd_rows(spark):
    docs = documents(spark)
    odd = docs.unionByName(odd_docs(spark).select("doc_id", "text", F.lit(None).cast("string").alias("lang"), "source", "n_chars"))
    found = {(r.doc_id, r.text): r for r in language_id.identify_languages(odd).join(odd_docs(spark).select("doc_id", "text"), "doc_id").collect()}
    assert all(found[(i, t)].lang_pred == "und" for i, t in ((5, None), (7, None)))
    assert {r.lang_pred for r in language_id.identify_languages(odd_docs(spark).withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert language_id.identify_languages(no_docs(spark)).count() == 0


def held_out_confusion(found, labels, column):
    return {(r[column], r.predicted): r["count"] for r in found.where("held_out").join(labels, "doc_id").groupBy(column, "predicted").count().collect()}


def test_quality_of_held_out_documents(spark):
    labels = spark.read.parquet(f"{MEDIUM}/labels.parquet")
    n = held_out_confusion(quality.score_quality(documents(spark, MEDIUM), labels), labels, "quality")
    assert n.get((1, 0), 0) + n.get((0, 1), 0) <= 0.06 * sum(n.values()) and n.get((0, 0), 0) > 0


def test_toxicity_of_held_out_documents(spark):
    labels = spark.read.parquet(f"{LARGE}/labels.parquet")
    found = materialise(toxicity.score_toxicity(documents(spark, LARGE), labels), "test-toxicity")
    n = held_out_confusion(found, labels, "toxic")
    toxic, clean = n.get((1, 1), 0) + n.get((1, 0), 0), n.get((0, 1), 0) + n.get((0, 0), 0)
    assert n.get((0, 1), 0) <= 0.01 * clean and n.get((1, 1), 0) >= 0.9 * toxic
    assert found.where("score < 0 or score > 1").count() == 0


@pytest.mark.parametrize(("score", "column"), [(quality.score_quality, "quality"), (toxicity.score_toxicity, "toxic")])
def test_classifiers_on_odd_rows(spark, score, column):
    labels = spark.createDataFrame([(0, 1, 1), (1, 0, 0), (1, 0, 0), (2, None, None), (None, 1, 1), (8, 0, 1), (10, 1, 0), (11, 1, 0)], "doc_id long, quality int, toxic int")
    for known in (labels, labels.limit(0), labels.where(f"{column} = 1")):
        rows = score(odd_docs(spark), known).collect()
        assert len(rows) == odd_docs(spark).count() and all(0 <= r.score <= 1 and r.predicted in (0, 1) and r.held_out is not None for r in rows)
    assert score(no_docs(spark), labels).count() == 0


def test_label_model_finds_the_better_voter():
    rng = np.random.default_rng(0)
    y = rng.random(4000) < 0.3
    good, bad = np.where(rng.random(4000) < 0.95, y, ~y), np.where(rng.random(4000) < 0.6, y, ~y)
    gold = rng.random(4000) < 0.1
    rows, at, counts = np.unique(np.stack([2 * good - 1, 2 * bad - 1, 2 * bad - 1]).T, axis=0, return_inverse=True, return_counts=True)
    known = np.zeros((len(rows), 2))
    np.add.at(known, (at[gold], y[gold].astype(int)), 1)
    # The second and third voter always agree: counted as two witnesses they would outvote the better one.
    model = toxicity.LabelModel(rows, counts.astype(float), known)
    post = {tuple(map(int, r)): p for r, p in zip(rows, model.posterior(rows))}
    assert post[(1, -1, -1)] > 0.5 > post[(-1, 1, 1)]


def test_label_model_equals_plain_expectation_maximisation():
    """Rows one by one and without a tree (fewer rounds than it takes to grow one)."""
    rng = np.random.default_rng(4)
    y = rng.random(300) < 0.4
    votes = np.stack([np.where(rng.random(300) < 0.2, 0, np.where(rng.random(300) < right, y, ~y) * 2 - 1) for right in (0.9, 0.8, 0.7)]).T
    rows, counts = np.unique(votes, axis=0, return_counts=True)
    got = toxicity.LabelModel(rows, counts.astype(float), rounds=5).posterior(rows)
    post = [0.9 if max(v) > 0 else 0.02 for v in votes.tolist()]
    for _ in range(5):
        share = [(sum(1 - p for p in post) + 1) / (len(post) + 2), (sum(post) + 1) / (len(post) + 2)]
        given = {}
        for j in range(3):
            for label in (0, 1):
                weight = {x: 0.5 + sum((p if label else 1 - p) for p, v in zip(post, votes) if v[j] == x) for x in (-1, 0, 1)}
                given |= {(j, label, x): w / sum(weight.values()) for x, w in weight.items()}
        odds = [[share[label] * np.prod([given[j, label, int(v[j])] for j in range(3)]) for label in (0, 1)] for v in votes]
        post = [b / (a + b) for a, b in odds]
    want = {tuple(v): p for v, p in zip(votes.tolist(), post)}
    assert all(abs(want[tuple(r)] - p) < 1e-9 for r, p in zip(rows.tolist(), got))


def test_newton_over_partitions_minimises_the_loss(spark):
    docs, labels = documents(spark, MEDIUM), spark.read.parquet(f"{MEDIUM}/labels.parquet")
    rng = np.random.default_rng(2)
    x, y, w = rng.normal(size=(500, 4)), rng.random(500), np.zeros(5)
    for _ in range(20):
        parts = [toxicity.newton_sums(x[i : i + 90], y[i : i + 90], w) for i in range(0, 500, 90)]
        w = toxicity.newton_step(sum(parts), w)
    loss = lambda w: np.logaddexp(0, -(z := np.hstack([x, np.ones((500, 1))]) @ w)) @ y + np.logaddexp(0, z) @ (1 - y) + w[:-1] @ w[:-1] / 2
    assert all(loss(w) <= loss(w + d) for d in rng.normal(0, 0.01, (50, 5)))
    few, many = (toxicity.score_toxicity(docs.repartition(n), labels).orderBy("doc_id").collect() for n in (2, 11))
    assert max(abs(a.score - b.score) for a, b in zip(few, many)) < 1e-3


@pytest.mark.parametrize("score", [quality.score_quality, toxicity.score_toxicity])
def test_samples_stay_bounded_when_ids_repeat(spark, score):
    docs = spark.range(3000).selectExpr("id % 3 as doc_id", "concat('text ', id) as text")
    labels = spark.createDataFrame([(0, 1, 1), (1, 0, 0), (2, 1, 0)], "doc_id long, quality int, toxic int")
    assert score(docs, labels).count() == 3000


# ---- pipeline --------------------------------------------------------------------------------------


def test_pipeline_equals_brute_force(spark, reference):
    import corpus_pipeline

    rejected = {r.doc_id for r in toxicity.op9_toxicity(spark, SMALL).where("predicted = 1").collect()}
    docs = {r.doc_id: r.text for r in documents(spark).collect() if r.doc_id not in rejected}
    by_text = {}
    for i, t in docs.items():
        by_text[(t or "").translate(LOWER)] = max(i, by_text.get((t or "").translate(LOWER), -1))
    docs = {i: docs[i] for i in by_text.values()}
    fps = {i: plain_fingerprint(t) for i, t in docs.items()}
    roots, least = plain_components(fps.values()), {}
    for i, f in fps.items():
        least[roots[f]] = min(i, least.get(roots[f], i))
    docs = {i: docs[i] for i in least.values()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    clean = {int(r[0]) for r in brute_contamination(docs.items(), items) if not r[-1]}
    want = sorted((i, len(ids := reference.encode_ordinary(docs[i] or "")), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()) for i in clean)
    assert sorted((r.doc_id, r.n_tokens, r.ids_sha256) for r in corpus_pipeline.run(spark, SMALL).collect()) == want
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, documents(spark), SMALL).columns == documents(spark).columns


def test_entry_without_the_operators(monkeypatch):
    import __spark_entry__

    for name in [m for m in sys.modules if m.startswith("tidemark.llm") or m == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    try:
        alone = importlib.reload(__spark_entry__)
        assert "flagship" in alone.queries() and not any(q.startswith("op") and q[2].isdigit() for q in alone.queries())
    finally:
        monkeypatch.undo()
        importlib.reload(__spark_entry__)
