"""Spelling variants against counting and editing by hand."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tests.llm.test_llm import LOWER, MEDIUM, SMALL, documents, no_docs, odd_docs
from tidemark.llm import spelling

LETTERS = [chr(c) for c in spelling.LETTERS]


def plain_words(docs, min_count=3, every=97):
    n = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", (text or "").translate(LOWER)):
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += len(run) >= 5
    return {w: c for w, c in n.items() if c >= min_count}


def plain_near(words):
    out = {}
    for w in words:
        found = {w[:i] + w[i + 1 :] for i in range(len(w))}
        found |= {w[:i] + c + w[i + 1 :] for i in range(len(w)) for c in LETTERS}
        found |= {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in LETTERS}
        out[w] = {v for v in found if v != w and v in words}
    return out


def plain_variants(n):
    near = plain_near(n)
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return sorted(out, key=str)


def rows(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted((tuple(r) for r in df.collect()), key=str)


def pairs(df):
    return [(r.doc_id, r.text) for r in df.collect()]


@pytest.mark.parametrize("sf", [SMALL, MEDIUM])
def test_documents(spark, sf):
    found = rows(spelling.op12_spelling(spark, sf))
    assert found == plain_variants(plain_words(pairs(documents(spark, sf))))
    assert sum(r[1] is not None for r in found) > 10


@pytest.mark.parametrize("block_chars", [1 << 21, 300])
def test_chains_and_blocks_that_meet(spark, monkeypatch, block_chars):
    """Crowded beginnings and endings, cut into many blocks; forms of forms."""
    monkeypatch.setattr(spelling, "LEAST_CHARS", min(block_chars, spelling.LEAST_CHARS))
    rng, n = random.Random(1), {}
    for _ in range(600):
        w = "ab" + "".join(rng.choices("abcÀÿé", k=rng.randrange(3, 7))) + rng.choice(["yz", "éé", ""])
        n[w if len(w) >= 5 else w + "abc"] = rng.randrange(3, 400)
    words = spark.createDataFrame([(w, c, 1) for w, c in n.items()], "word string, n long, side int").select("word", "n")
    found = spelling.near_words(words, block_chars)
    want = sorted((w, v, n[v]) for w, near in plain_near(n).items() for v in near)
    assert sorted(tuple(r) for r in found.collect()) == want and len(want) > 500


@pytest.mark.parametrize("seed", range(4))
def test_index_against_editing(seed):
    rng = random.Random(seed)
    words = sorted({"".join(rng.choices("ab" + "cé" * (seed % 2), k=rng.randrange(5, 10))) for _ in range(300)})
    index, near = spelling.Index(words), plain_near(set(words))
    for side in ("first", "second"):
        mine, other = index.near(words, side, own=True)
        got = {(words[a], words[b]) for a, b in zip(mine, other)} - {(w, w) for w in words}
        half = lambda w, v: v.startswith(w[: len(w) // 2]) if side == "first" else v.endswith(w[len(w) // 2 :])
        assert got == {(w, v) for w in words for v in near[w] if half(w, v)}
    sought = sorted({"".join(rng.choices("abc", k=rng.randrange(5, 10))) for _ in range(200)})
    mine, other = index.near(sought, "first", own=False)
    far = {(sought[a], words[b]) for a, b in zip(mine, other)}
    assert {p for p in far if p[0] != p[1]} == {(w, v) for w in sought for v in plain_near({w, *words})[w] if v in set(words) and v.startswith(w[: len(w) // 2])}


def test_both_transforms_keep_in_step():
    """Growing on either side gives the interval of the pattern in the text and, reversed, in its reverse."""
    words = ["banana", "bandana", "cabana", "anana"]
    text, _ = spelling._letters(words)
    ring = "".join(" abcdefghijklmnopqrstuvwxyz"[c] for c in text)
    ring2 = ring + ring
    index = spelling.Index(words)
    one = lambda x: np.array([x])
    for pattern, grow in (("ana", "LLL"), ("ana", "RLR"), ("band", "RRRR"), (" ba", "LRL"), ("na b", "LLRL")):
        left = right = (grow.count("L"))
        state, forward = spelling.Intervals(one(0), one(0), one(len(ring))), True
        for g in grow:
            if g == "L":
                left -= 1
            letter = " abcdefghijklmnopqrstuvwxyz".index(pattern[left] if g == "L" else pattern[right])
            right += g == "R"
            if forward != (g == "L"):
                state, forward = state.turned(), not forward
            state = state.grown(index.forward if forward else index.backward, one(letter))
        state = state if forward else state.turned()
        count = sum(ring2[i : i + len(pattern)] == pattern for i in range(len(ring)))
        assert state.size[0] == count
        assert {ring2[index.forward.order[state.near[0] + i] :][: len(pattern)] for i in range(count)} <= {pattern}


def test_odd_rows(spark):
    long = "Straße " * 3 + "strasse " * 8 + "ÉCOLE Ecole ecole ecole " * 3 + "x" * 100_000 + " "
    docs = [*pairs(odd_docs(spark)), (100, long), (101, long + "y" + "x" * 99_999 + "!"), (None, long), (102, "×÷×÷× " * 4 + "×÷×÷ " * 9 + "a\x00bcdef " * 3)]
    df = spark.createDataFrame([(*d, 1, "r") for d in docs], "doc_id long, text string, n int, word string")
    for every in (97, 2):
        words = spelling.count_words(df, every=every)
        assert {r.word: r.n for r in words.collect()} == plain_words(docs, every=every)
    assert rows(spelling.spelling_variants(df)) == [(w, *rest) for w, *rest in plain_variants_of_long(plain_words(docs))]
    assert spelling.spelling_variants(no_docs(spark)).count() == 0


def plain_variants_of_long(n):
    """As :func:`plain_variants`; the words of 100,000 letters are near each other only, which editing by hand can't afford."""
    short = {w: c for w, c in n.items() if len(w) < 1000}
    assert all(set(w) <= {"x", "y"} for w in n if len(w) >= 1000)
    rest = sorted(w for w in n if len(w) >= 1000)
    found = plain_variants(short)
    for w in rest:
        close = [v for v in rest if v != w and abs(len(v) - len(w)) <= 1]
        assert not close
        found.append((w, None, w, n[w], 0, None))
    return sorted(found, key=str)
