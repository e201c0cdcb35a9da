"""BPE encoding and decoding with a segment tree over adjacent pair ranks.

A piece starts as its bytes' tokens. Leaf i of the tree holds the rank of the pair that begins at token i, with i behind
it; every inner node the lesser of its two children. So the root is the leftmost of the lowest-ranked merges. A merge
changes three leaves (the pair itself, the one before it, the one that vanishes) and their paths to the root; the piece is
done when no pair at the root can merge. A piece of n bytes takes O(n log n), also one of a megabyte.

The tokenizer file is a parameter (a path that every executor can read); it is never copied or trained. Of such files,
those with byte-level BPE and plain added tokens are read; a file that asks for more (a normaliser, dropout, a prefix
space, other splits) is an error rather than another result. Added tokens are cut out of a text before it is split.

Nulls and ties: a null text is encoded as empty (no ids); every row is encoded, repeated or not; null ids stay. Very long
texts are encoded whole, piece by piece, in Arrow batches bounded by rows and bytes. Only the two columns named are read,
whatever else there is. An empty table gives an empty result.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import pre_tokenizers

from tidemark.llm.common import prepare, table

TOKENIZER = "byte_bpe_50k.json"
#: Pieces that a Python worker remembers (twice as many for a while), and the longest of them.
PIECES, LONGEST = 250_000, 64
#: Stands for the rank of a pair that doesn't merge.
NO_RANK = 1 << 24
#: Below this code point the regex library and the tokenizer library know the same letters, digits and white space.
AGREED = 0x558


def byte_characters() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level files: itself where it is printable and no space."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Merges:
    """Vocabulary and merges of a tokenizer file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, split, added = spec["model"], spec["pre_tokenizer"] or {}, spec["added_tokens"]
        plain = model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        plain &= spec["normalizer"] is None and split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
        plain &= (spec["decoder"] or {}).get("type") == "ByteLevel"
        plain &= not any(t[k] for t in added for k in ("single_word", "lstrip", "rstrip", "normalized"))
        if not plain:
            raise ValueError(f"{path} is not plain byte-level BPE")
        vocab, of = model["vocab"], byte_characters()
        self.raw = {i: bytes(of[c] for c in token) for token, i in vocab.items()} | {t["id"]: t["content"].encode() for t in added}
        self.bytes = [vocab[c] for c in sorted(of, key=of.get)]
        self.added = {t["content"]: t["id"] for t in added}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        #: The token that a merge makes, by rank, and the rank of a pair of tokens.
        self.made = [vocab[a + b] for a, b in pairs]
        self.ranks: dict[int, int] = {}
        for rank, (a, b) in enumerate(pairs):
            self.ranks[vocab[a] << 32 | vocab[b]] = rank  # of equal pairs the last holds, as in the library
        #: The ranks of two bytes.
        self.byte_pairs = [self.ranks.get(a << 32 | b, NO_RANK) for a in self.bytes for b in self.bytes]

    def encode(self, piece: bytes) -> list[int]:
        return PairTree(self, piece).merge_all() if len(piece) > 1 else [self.bytes[b] for b in piece]


class PairTree:
    """The tokens of a piece, and the segment tree over the ranks of their adjacent pairs.

    A leaf is rank and place in one number (``NO_RANK`` and place for a pair that can't merge); the tree is a list with
    the root at 1 and the children of a node at twice its number and one behind.
    """

    def __init__(self, merges: Merges, piece: bytes) -> None:
        n = len(piece)
        self.merges, self.places = merges, n.bit_length()
        of, first, places = merges.bytes, merges.byte_pairs, self.places
        self.tokens = [of[b] for b in piece]
        self.before, self.after = list(range(-1, n - 1)), list(range(1, n + 1))
        self.leaves = leaves = 1 << (n - 1).bit_length()
        level = [first[a << 8 | b] << places | i for i, (a, b) in enumerate(zip(piece, piece[1:]))]
        level += [NO_RANK << places] * (leaves - len(level))
        tree = level
        while len(level) > 1:
            level = [x if x < y else y for x, y in zip(level[::2], level[1::2])]
            tree = level + tree
        self.tree = [0, *tree]

    def merge_all(self, most: int = -1) -> list[int]:
        """Do the merge at the root until there is none (or ``most`` times); the tokens that are left."""
        tree, leaves, places, tokens, before, after = self.tree, self.leaves, self.places, self.tokens, self.before, self.after
        made, rank, n, place, never = self.merges.made, self.merges.ranks.get, len(self.tokens), (1 << self.places) - 1, NO_RANK << self.places
        while (key := tree[1]) < never and most:
            most -= 1
            at = key & place
            gone = after[at]
            tokens[at] = token = made[key >> places]
            tokens[gone] = -1
            after[at] = follows = after[gone]
            tree[leaves + gone] = never
            if follows < n:
                before[follows] = at
                tree[leaves + at] = rank(token << 32 | tokens[follows], NO_RANK) << places | at
            else:
                tree[leaves + at] = never
            left = before[at]
            if left >= 0:
                tree[leaves + left] = rank(tokens[left] << 32 | token, NO_RANK) << places | left
                changed = (gone, at, left)
            else:
                changed = (gone, at)
            for node in changed:  # what stands above an unchanged node is right already
                node = (leaves + node) >> 1
                while node:
                    x, y = tree[2 * node], tree[2 * node + 1]
                    if y < x:
                        x = y
                    if tree[node] == x:
                        break
                    tree[node] = x
                    node >>= 1
        return [t for t in tokens if t >= 0]


class Encoder:
    def __init__(self, path: str) -> None:
        self.merges = Merges(path)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.split = regex.compile(public_tokenizers.PATTERN).findall
        self.unusual = re.compile(f"[^\\x00-{chr(AGREED - 1)}]").search
        self.library = pre_tokenizers.ByteLevel(add_prefix_space=False).pre_tokenize_str
        named = sorted(map(regex.escape, self.merges.added), key=len, reverse=True)
        self.cut = regex.compile(f"({'|'.join(named)})").split if named else lambda text: [text]

    def pieces(self, part: str) -> list[str]:
        """The pieces of a text without added tokens. Newer letters are left to the library's own splitter."""
        return self.split(part) if part.isascii() or not self.unusual(part) else [part[a:b] for _, (a, b) in self.library(part)]

    def _ids(self, piece: str) -> bytes:
        ids = self.older.get(piece) or np.array(self.merges.encode(piece.encode()), "<u4").tobytes()
        if len(piece) <= LONGEST:
            if len(self.known) >= PIECES:
                self.older, self.known = self.known, {}
            self.known[piece] = ids
        return ids

    def encode(self, text: str | None) -> bytes:
        """The token ids as little-endian unsigned 32-bit integers."""
        out, make = [], self._ids
        for i, part in enumerate(self.cut(text or "")):
            if i % 2:
                out.append(self.merges.added[part].to_bytes(4, "little"))
            else:
                known = self.known.get
                out += [known(p) or make(p) for p in self.pieces(part)]
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.merges.raw.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


@lru_cache(2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False) -> DataFrame:
    """``id_col, ids`` with the ids as little-endian unsigned 32-bit integers, and with ``decoded`` the text they stand for."""
    prepare(docs.sparkSession)
    names = ["id", "ids", *(["decoded"] if decoded else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for batch in batches:
            ids = [bpe.encode(t.as_py()) for t in batch.column(1)]
            texts = [pa.array(map(bpe.decode, ids), pa.string())] if decoded else []
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary()), *texts], names)

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = f"id {dict(docs.dtypes)[id_col]}, ids binary{', decoded string' if decoded else ''}"
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def decode_documents(encoded: DataFrame, path: str, id_col: str = "doc_id") -> DataFrame:
    """``id_col, decoded`` from ``ids``; bytes that are no UTF-8 become the replacement character, null ids an empty text."""
    prepare(encoded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([bpe.decode(i.as_py() or b"") for i in batch.column(1)], pa.string())], ["id", "decoded"])

    rows = encoded.select(F.col(id_col).alias("id"), "ids")
    return rows.mapInArrow(run, f"id {dict(encoded.dtypes)[id_col]}, decoded string").withColumnRenamed("id", id_col)


def op13_bpe_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), decoded=True)
    n = F.expr("octet_length(ids) div 4").cast("long")
    return found.select("doc_id", n.alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
