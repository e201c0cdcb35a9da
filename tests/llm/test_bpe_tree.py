"""BPE by a segment tree against the tokenizer library."""

from __future__ import annotations

import hashlib
import json

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm.test_llm import SMALL, documents, no_docs, odd_docs
from tidemark.llm import bpe_tree

PATH = public_tokenizers.path(bpe_tree.TOKENIZER)


@pytest.fixture(scope="module")
def library():
    found = Tokenizer.from_file(PATH)
    found.no_truncation()
    found.no_padding()
    return found


def ids_of(text):
    return np.frombuffer(bpe_tree.encoder(PATH).encode(text), "<u4").tolist()


def want(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    back = library.decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()


@given(st.text(max_size=200))
@settings(max_examples=300, deadline=None)
def test_equals_the_library(library, text):
    assert ids_of(text) == library.encode(text, add_special_tokens=False).ids
    assert bpe_tree.encoder(PATH).decode(bpe_tree.encoder(PATH).encode(text)) == text


@given(st.lists(st.sampled_from(["<|endoftext|>", "<|endof", "text|>", " ", "\n", "a", "'s", "1", "é", "՘", "<"]), max_size=12))
@settings(max_examples=200, deadline=None)
def test_added_tokens_are_cut_out(library, parts):
    text = "".join(parts)
    ids = library.encode(text, add_special_tokens=False).ids
    assert ids_of(text) == ids
    assert bpe_tree.encoder(PATH).decode(np.array(ids, "<u4").tobytes()) == library.decode(ids, skip_special_tokens=False)


@given(st.binary(min_size=1, max_size=60))
@settings(max_examples=200, deadline=None)
def test_root_is_the_leftmost_lowest_merge(piece):
    """The tree's root after every merge, held against a scan of all pairs."""
    merges = bpe_tree.encoder(PATH).merges
    tree, parts = bpe_tree.PairTree(merges, piece), [merges.bytes[b] for b in piece]
    while True:
        found = min(((merges.ranks.get(a << 32 | b, 1 << 40), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))), default=(1 << 40, 0))
        if found[0] == 1 << 40:
            break
        tree.merge_all(1)
        parts[found[1] : found[1] + 2] = [merges.made[found[0]]]
        assert [t for t in tree.tokens if t >= 0] == parts
    assert tree.merge_all(1) == parts


def test_every_character_of_the_fast_split(library):
    bpe = bpe_tree.encoder(PATH)
    for c in map(chr, range(bpe_tree.AGREED)):
        text = f"a{c}b1 {c} {c}x{c}{c}  {c}"
        assert [len(p.encode()) for p in bpe.split(text)] == [len(p) for p, _ in bpe.library(text)]


def test_invalid_bytes_decode_as_in_the_library(library):
    rng = np.random.default_rng(5)
    for _ in range(300):
        ids = rng.integers(0, 50257, 6)
        assert bpe_tree.encoder(PATH).decode(ids.astype("<u4").tobytes()) == library.decode(ids.tolist(), skip_special_tokens=False)


def test_long_pieces(library):
    for text in ("x" * 300_000, "ab" * 100_000, "".join(map(chr, np.random.default_rng(1).integers(97, 123, 100_000)))):
        assert ids_of(text) == library.encode(text, add_special_tokens=False).ids


def test_other_files_are_refused(tmp_path):
    spec = json.load(open(PATH))
    for change in ({"normalizer": {"type": "NFC"}}, {"pre_tokenizer": None}, {"model": spec["model"] | {"ignore_merges": True}}):
        (tmp_path / "t.json").write_text(json.dumps(spec | change))
        with pytest.raises(ValueError):
            bpe_tree.Merges(str(tmp_path / "t.json"))


def test_documents(spark, library):
    texts = {r.doc_id: r.text for r in documents(spark).collect()}
    found = bpe_tree.op13_bpe_tree(spark, SMALL).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in found} == {i: want(library, t) for i, t in texts.items()}


def test_odd_rows(spark, library):
    found = bpe_tree.encode_documents(odd_docs(spark), PATH)
    assert found.columns == ["doc_id", "ids"]
    key = lambda p: (str(p[0]), p[1])
    got = sorted(((r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in found.collect()), key=key)
    assert got == sorted(((r.doc_id, library.encode(r.text or "", add_special_tokens=False).ids) for r in odd_docs(spark).collect()), key=key)
    back = bpe_tree.decode_documents(found, PATH).collect()
    assert sorted((str(r.doc_id), r.decoded) for r in back) == sorted((str(r.doc_id), r.text or "") for r in odd_docs(spark).collect())
    assert bpe_tree.encode_documents(no_docs(spark), PATH, decoded=True).count() == 0
