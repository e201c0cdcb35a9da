"""Byte-level BPE encoding and decoding by prefix dynamic programming.

For every prefix of a piece the encoder stores the one token that can end that prefix's encoding: a token
``t`` can follow the last token ``p`` of the prefix before it only if BPE leaves the bytes of ``p`` and
``t`` as just these two tokens, and exactly one candidate passes. The token ids are read off backwards.
Because the table is kept by prefix, appending bytes only adds entries, and an edit re-encodes from the
last entry before it.

The vocabulary file is a parameter (a path that every executor can read); it is never copied or trained.

Nulls and ties: a null text is encoded as empty (no ids); every row is encoded, repeated or not. Very long texts are
encoded whole, piece by piece, in Arrow batches bounded by rows and bytes; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import prepare, table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Pieces and token pairs that a Python worker remembers.
PIECES, PAIRS = 250_000, 250_000
NEVER = 1 << 40


class Vocabulary:
    def __init__(self, path: str) -> None:
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.tokens = {v: k for k, v in self.ranks.items()}
        #: Every ending of a token, with the token that it is itself or -1: tells how far back to look.
        self.tails = {raw[i:]: -1 for raw in self.ranks for i in range(len(raw))} | self.ranks
        self._edges: dict[int, tuple | None] = {}
        self._pairs: dict[int, bool] = {}

    def merged(self, piece: bytes, until: int = 1) -> list[bytes]:
        """Plain BPE: join the neighbours of the lowest rank until none can be joined, or ``until`` parts are left."""
        parts, ranks = [piece[i : i + 1] for i in range(len(piece))], self.ranks
        while len(parts) > until:
            best, at = min((ranks.get(parts[i] + parts[i + 1], NEVER), i) for i in range(len(parts) - 1))
            if best == NEVER:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def edges(self, token: int) -> tuple | None:
        """What stands at the left and at the right edge of the token's bytes while BPE builds it.

        Two lists of (bytes, rank of the merge that takes them up), the finished token first. None if BPE
        never builds the token.
        """
        if token not in self._edges:
            raw = self.tokens[token]
            sides = None
            if len(raw) == 1:
                sides = ([(raw, NEVER)], [(raw, NEVER)])
            elif len(parts := self.merged(raw, 2)) == 2:
                left, right = (self.edges(self.ranks[p]) for p in parts)
                if left and right:
                    sides = tuple([(raw, NEVER), (side[0][0], token), *side[1:]] for side in (left[0], right[1]))
            self._edges[token] = sides
        return self._edges[token]

    def neighbours(self, left: int, right: int) -> bool:
        """Whether BPE leaves these two tokens side by side: no merge across the border comes first."""
        key = left << 32 | right
        known = self._pairs.get(key)
        if known is None:
            if len(self._pairs) >= PAIRS:
                self._pairs.clear()
            known = self._pairs[key] = self._stays(left, right)
        return known

    def _stays(self, left: int, right: int) -> bool:
        a, b, get = self.edges(left), self.edges(right), self.ranks.get
        if not a or not b:
            return False
        a, b, i, j = a[1], b[0], 0, 0
        while True:
            (x, x_goes), (y, y_goes) = a[i], b[j]
            across = get(x + y)
            if across is not None and across < x_goes and across <= y_goes:
                return False
            # Go back in time: undo the later of the two merges that made x and y.
            x_made = a[i + 1][1] if i + 1 < len(a) else -1
            y_made = b[j + 1][1] if j + 1 < len(b) else -1
            if x_made < 0 and y_made < 0:
                return True
            if x_made > y_made:
                i += 1
            else:
                j += 1


class PrefixEncoder:
    """The encoding of one piece, which can grow and change: ``last[i]`` ends the encoding of the first i bytes."""

    def __init__(self, vocabulary: Vocabulary, piece: bytes = b"") -> None:
        self.vocabulary, self.piece, self.last = vocabulary, b"", [-1]
        self.append(piece)

    def append(self, more: bytes) -> None:
        v, last = self.vocabulary, self.last
        tails, neighbours = v.tails.get, v.neighbours
        self.piece = piece = self.piece + more
        for end in range(len(last), len(piece) + 1):
            start = end - 1
            while start >= 0 and (token := tails(piece[start:end])) is not None:
                if token >= 0 and (neighbours(last[start], token) if start else v.edges(token)):
                    break
                start -= 1
            else:
                raise ValueError(f"no token ends at byte {end} of {piece[:50]!r}")
            last.append(token)

    def replace(self, start: int, end: int, new: bytes) -> None:
        """Put ``new`` in the place of bytes [start, end): entries before ``start`` stay."""
        rest = new + self.piece[end:]
        self.piece, self.last = self.piece[:start], self.last[: start + 1]
        self.append(rest)

    def ids(self) -> list[int]:
        out, at = [], len(self.piece)
        while at:
            out.append(self.last[at])
            at -= len(self.vocabulary.tokens[self.last[at]])
        return out[::-1]


class _Pieces(dict):
    """The ids of pieces as little-endian 32-bit integers, made when first asked for."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary

    def __missing__(self, piece: str) -> bytes:
        raw, v = piece.encode(), self.vocabulary
        whole = v.ranks.get(raw)
        ids = np.array([whole] if whole is not None else PrefixEncoder(v, raw).ids(), "<u4").tobytes()
        if len(self) >= PIECES:
            self.clear()
        if len(piece) <= 64:
            self[piece] = ids
        return ids


@lru_cache(2)
def _worker(path: str, pattern: str):
    v = Vocabulary(path)
    return v, _Pieces(v), regex.compile(pattern)


def encode(text: str | None, path: str, pattern: str = public_tokenizers.PATTERN) -> bytes:
    """The token ids of a text as little-endian unsigned 32-bit integers."""
    _, pieces, split = _worker(path, pattern)
    return b"".join(map(pieces.__getitem__, split.findall(text or "")))


def decode(ids: bytes, path: str, pattern: str = public_tokenizers.PATTERN) -> bytes:
    return b"".join(map(_worker(path, pattern)[0].tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def encode_documents(docs: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, ids`` with the ids as bytes (little-endian unsigned 32-bit integers)."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([encode(t.as_py(), path, pattern) for t in batch.column(1)], pa.binary())], ["id", "ids"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {dict(docs.dtypes)[id_col]}, ids binary").withColumnRenamed("id", id_col)


def decode_documents(encoded: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN, id_col: str = "doc_id") -> DataFrame:
    """``id_col, ids, decoded`` with the decoded bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([decode(i.as_py(), path, pattern) for i in batch.column(1)], pa.binary())], ["id", "ids", "decoded"])

    rows = encoded.select(F.col(id_col).alias("id"), "ids")
    return rows.mapInArrow(run, f"id {dict(encoded.dtypes)[id_col]}, ids binary, decoded binary").withColumnRenamed("id", id_col)


def encode_and_decode(docs: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, ids, decoded`` in one pass: a task needs one Python worker, with one vocabulary, in place of two."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [encode(t.as_py(), path, pattern) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary()), pa.array([decode(i, path, pattern) for i in ids], pa.binary())], ["id", "ids", "decoded"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {dict(docs.dtypes)[id_col]}, ids binary, decoded binary").withColumnRenamed("id", id_col)


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_tokens, ids_sha256, decoded_sha256`` of every document."""
    decoded = encode_and_decode(docs, public_tokenizers.path(VOCABULARY), id_col=id_col, text_col=text_col)
    return decoded.select(
        id_col, F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"))
