"""Language-model scoring by masked pseudo-likelihood.

A window network predicts every token from the tokens on both sides: the embeddings of the words at offsets -2, -1, 1
and 2, each scaled by its offset's weights, add up and pass through tanh; a binary code tree over the vocabulary (Huffman,
by word counts) turns the result into a normalised probability: the product of the logistic decisions on the way to a
word. A document's score is the sum over its tokens of log P(token | the tokens around it).

*Vocabulary.* Word counts cover all documents. The ``own`` most frequent words (within a hundredth, by hash; of 64 bytes at
most, digests are counted for longer ones) have codes of their own; the other words share one, and P(word) then is that code's probability times the word's share of their
counts, joined from the counts in Spark. So every distinct word of the corpus has a probability of its own.

*Training* (numpy) covers all tokens of all documents. Documents are dealt to shards by the hash of their id and text, as
many as the corpus needs; a shard runs Adagrad over its documents in hash order from the parameters that all share.
Each round has its share of the documents, by hash, so that every token is predicted in one of them; Spark then averages
each parameter row over the shards, weighted by how often they trained it. Nothing depends on how the input is
partitioned. Equal rows that are so many that they would fill a shard are counted, and their copies dealt one by one. The
driver holds the frequent words, of 64 bytes at most, and one parameter set; counts, tokens and shards grow with the input.

Nulls, ties, odd inputs: a null or wordless text has no tokens and score 0; very long texts are read whole; every row is
scored, repeated or not; an empty table gives an empty result; extra columns are ignored. Words are taken between
white space, A-Z lower-cased. A word that the counted corpus lacks counts as if it had occurred once.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import UPPER, materialise, prepare, table

LOWER = bytes.maketrans(UPPER.encode(), UPPER.lower().encode())
OFFSETS = (-2, -1, 1, 2)
PAD = 2
OWN, DIM = 65_000, 8
BATCH = 4096
SHARD_TOKENS = 5_000_000
BLOCK = 1024
FAN_IN = 64
#: Distinct words, and bytes of text, that a task counts at a time.
COUNTED, COUNTED_BYTES = 200_000, 128 << 20
LONGEST = 64


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(LOWER).split()


def name_of(word: bytes) -> bytes:
    """The word, or a digest behind a zero byte for one of more than ``LONGEST`` bytes, as texts without spaces are."""
    return word if len(word) <= LONGEST else b"\0" + xxhash.xxh3_128_digest(word)


# ---- vocabulary ------------------------------------------------------------------------------------


def count_words(texts: DataFrame) -> DataFrame:
    """``h, n``: hash and count of every word over all documents, and its ``word`` (name); each task adds up before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        size = 0

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(map(name_of, seen)), pa.binary()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for text in batch.column("text").to_pylist():
                seen.update(words_of(text))
            size += batch.nbytes
            if len(seen) >= COUNTED or size >= COUNTED_BYTES:
                yield rows()
                seen.clear()
                size = 0
        yield rows()

    return texts.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")).withColumn("h", F.xxhash64("word"))


def frequent_words(counts: DataFrame, most: int) -> list[tuple[bytes, int]]:
    """At most ``most`` words, by frequency level (steps of a hundredth) and then by hash; the levels come first, so that no partition sends more than its share."""
    leveled = counts.withColumn("level", F.floor(F.log2("n") * 64))
    sizes = sorted(((r.level, r["count"]) for r in leveled.groupBy("level").count().collect()), reverse=True)  # a few thousand rows
    left, whole, last = most, None, None
    for level, n in sizes:
        if n > left:
            last = (level, n)
            break
        left, whole = left - n, level
    found = leveled.where(F.col("level") >= whole).select("word", "n").collect() if whole is not None else []
    if last and left:
        near = F.pmod("h", F.lit(1 << 20)) < (2 * left << 20) // last[1] + 64
        found += leveled.where((F.col("level") == last[0]) & near).orderBy("h", "word").limit(left).select("word", "n").collect()
    return sorted(((bytes(r.word), r.n) for r in found), key=lambda x: (-x[1], x[0]))


@dataclass
class Tree:
    """Huffman codes. At each level from the root, of every token still on its way: twice the node, plus 1 for the upper branch."""

    size: np.ndarray  # levels of each token
    levels: np.ndarray  # levels x tokens
    bias: np.ndarray  # of each node: log odds of its two branches by the counts

    @classmethod
    def of(cls, counts: list[int]) -> Tree:
        heap = [(max(1, c), i) for i, c in enumerate(counts)]
        heapq.heapify(heap)
        n = len(counts)
        above = np.zeros(2 * n, np.int64)  # of every token and node: the branch that leads to it
        bias = np.zeros(max(1, n - 1), np.float32)
        for k in range(n - 1):
            (a, x), (b, y) = heapq.heappop(heap), heapq.heappop(heap)
            above[x], above[y] = 2 * k, 2 * k + 1
            bias[k] = math.log(b / a)
            heapq.heappush(heap, (a + b, n + k))
        at, ways = np.arange(n), []
        while n > 1 and (at < 2 * n - 2).any():
            on = at < 2 * n - 2  # not yet at the root
            ways.append(np.where(on, above[at], -1))
            at = np.where(on, n + (above[at] >> 1), at)
        up = np.array(ways, np.int64).reshape(-1, n)  # from the token
        size = (up >= 0).sum(axis=0)
        down = size - 1 - np.arange(len(up))[:, None]
        return cls(size, np.where(down >= 0, np.take_along_axis(up, np.maximum(down, 0), axis=0), 0).astype(np.int32) if len(up) else up.astype(np.int32), bias)


class Vocabulary(dict):
    """Token of a word: its own, or the one that all other words share; one more stands for outside the text."""

    def __init__(self, words: list[bytes]) -> None:
        super().__init__((w, i) for i, w in enumerate(words))
        self.other, self.outside = len(words), len(words) + 1

    def tokens(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.get, words, repeat(self.other)), np.uint16, len(words))


# ---- network ---------------------------------------------------------------------------------------


@dataclass
class Network:
    embed: np.ndarray  # tokens and outside x dim
    node: np.ndarray  # tree nodes x dim
    bias: np.ndarray  # tree nodes x 1
    shared: np.ndarray  # (offsets + 1) x dim: weights of the offsets, and what is added to all

    @classmethod
    def start(cls, tree: Tree, dim: int = DIM, seed: int = 3) -> Network:
        """Small random embeddings and nodes that give the words' own frequencies."""
        embed = np.random.default_rng(seed).normal(0, 0.1, (len(tree.size) + 1, dim)).astype(np.float32)
        return cls(embed, np.zeros((len(tree.bias), dim), np.float32), tree.bias[:, None].copy(), np.vstack([np.ones((len(OFFSETS), dim)), np.zeros((1, dim))]).astype(np.float32))

    def copy(self) -> Network:
        return Network(*(p.copy() for p in self.parts()))

    def parts(self) -> list[np.ndarray]:
        return [self.embed, self.node, self.bias, self.shared]

    def hidden(self, near: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Of the positions ``at`` (in columns); ``near`` has the embeddings of all tokens, in columns too."""
        n = near.shape[1] - 2 * PAD
        total = self.shared[-1][:, None] + self.shared[0][:, None] * near[:, PAD + OFFSETS[0] :][:, :n]
        for k, off in enumerate(OFFSETS[1:], 1):
            total += self.shared[k][:, None] * near[:, PAD + off :][:, :n]
        return np.tanh(np.take(total, at - PAD, axis=1, mode="clip"))


@dataclass
class Batch:
    """Some positions of a padded token sequence, those with the longest ways to their tokens first."""

    order: np.ndarray  # of the positions given
    context: np.ndarray  # tokens of the stretch around them
    at: np.ndarray  # positions in it
    tokens: np.ndarray
    on: list[int]  # how many of them have a branch at each level

    @classmethod
    def of(cls, tree: Tree, tokens: np.ndarray, at: np.ndarray) -> Batch:
        first = at[0] - PAD
        context, size = tokens[first : at[-1] + PAD + 1], tree.size[tokens[at]]
        order = np.argsort((255 - size).astype(np.uint8), kind="stable")
        on = len(at) - np.cumsum(np.bincount(size, minlength=1))[:-1]
        return cls(order, context, at[order] - first, tokens[at][order], on.tolist())

    def branches(self, net: Network, tree: Tree, hidden: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """Level by level: nodes, their weights (in columns, as ``hidden``), signs, signed logits."""
        for level, k in enumerate(self.on):
            branch = np.take(tree.levels[level], self.tokens[:k], mode="clip")
            nodes, signs = branch >> 1, ((branch & 1) * 2 - 1).astype(np.float32)
            weights = np.ascontiguousarray(np.take(net.node, nodes, axis=0, mode="clip").T)
            yield nodes, weights, signs, signs * ((weights * hidden[:, :k]).sum(axis=0) + np.take(net.bias[:, 0], nodes, mode="clip"))


def columns_of(rows: np.ndarray, index: np.ndarray) -> np.ndarray:
    """Rows of a matrix as columns: what numpy then does along them it does for many tokens at a time."""
    return np.ascontiguousarray(np.take(rows, index, axis=0, mode="clip").T)


def log_probabilities(net: Network, tree: Tree, tokens: np.ndarray, at: np.ndarray) -> np.ndarray:
    """log P(tokens[i] | neighbours) for the positions ``at`` of a padded token sequence."""
    found = np.zeros(len(at), np.float64)
    for i in range(0, len(at), BATCH):
        batch = Batch.of(tree, tokens, at[i : i + BATCH])
        inverse = np.ones(len(batch.at), np.float64)
        for _, _, _, m in batch.branches(net, tree, net.hidden(columns_of(net.embed, batch.context), batch.at)):
            inverse[: len(m)] *= 1 + np.exp(np.minimum(-m, 30))
        found[i : i + BATCH][batch.order] = -np.log(inverse)
    return found


def row_sums(index: np.ndarray, columns: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values of ``index``, the sums of their entries in every column, and how many there are. One column after the other."""
    uses = np.bincount(index, minlength=rows)
    found = np.flatnonzero(uses > 0)
    place = np.empty(rows, np.int64)
    place[found] = np.arange(len(found))
    at = place[index]
    return found, np.stack([np.bincount(at, c, len(found)) for c in columns], axis=1).astype(np.float32), uses[found]


def gradients(net: Network, tree: Tree, tokens: np.ndarray, at: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Of the summed negative log-probability of the positions ``at``: rows, gradients and uses, for each part of the network."""
    batch = Batch.of(tree, tokens, at)
    near, at = columns_of(net.embed, batch.context), batch.at
    hidden = net.hidden(near, at)
    back = np.zeros_like(hidden)
    total, dim = sum(batch.on), len(hidden)
    nodes_all, of_nodes, done = np.empty(total, np.int64), np.empty((dim + 1, total), np.float32), 0
    for nodes, weights, signs, m in batch.branches(net, tree, hidden):
        k = len(m)
        slope = -signs / (1 + np.exp(np.minimum(m, 80)))
        weights *= slope
        back[:, :k] += weights
        nodes_all[done : done + k] = nodes
        np.multiply(hidden[:, :k], slope, out=of_nodes[:-1, done : done + k])
        of_nodes[-1, done : done + k] = slope
        done += k
    back *= 1 - hidden * hidden
    n = near.shape[1] - 2 * PAD
    placed = np.zeros((n, dim), back.dtype)  # as the tokens stand, zero where none is
    placed[at - PAD] = back.T
    placed = np.ascontiguousarray(placed.T)
    of_near, of_shared = np.zeros_like(near), np.empty_like(net.shared)
    for k, off in enumerate(OFFSETS):
        of_near[:, PAD + off :][:, :n] += placed * net.shared[k][:, None]
        of_shared[k] = (placed * near[:, PAD + off :][:, :n]).sum(axis=1)
    of_shared[-1] = back.sum(axis=1)
    rows, sums, uses = row_sums(nodes_all, of_nodes, len(net.node))
    return [row_sums(batch.context, of_near, len(net.embed)), (rows, sums[:, :-1], uses), (rows, sums[:, -1:], uses), (np.arange(len(of_shared)), of_shared, np.full(len(of_shared), len(at)))]


class Trainer:
    """Adagrad on rows of parameters."""

    def __init__(self, net: Network, tree: Tree, rate: float = 0.1) -> None:
        self.net, self.tree, self.rate = net.copy(), tree, rate
        self.seen = [np.full_like(p, 0.1) for p in net.parts()]
        self.uses = [np.zeros(len(p), np.int64) for p in net.parts()]

    def step(self, tokens: np.ndarray, at: np.ndarray) -> None:
        for value, seen, uses, (rows, grad, n) in zip(self.net.parts(), self.seen, self.uses, gradients(self.net, self.tree, tokens, at)):
            now = np.take(seen, rows, axis=0, mode="clip")
            now += grad * grad
            seen[rows] = now
            grad *= np.float32(self.rate)
            grad /= np.sqrt(now, out=now)
            value[rows] = np.subtract(np.take(value, rows, axis=0, mode="clip"), grad, out=now)
            uses[rows] += n


def padded(parts: list[np.ndarray], outside: int) -> tuple[np.ndarray, np.ndarray]:
    """Token sequences in a row with ``outside`` around each, and the positions of their tokens."""
    gap = np.full(PAD, outside, np.uint16)
    joined = np.concatenate([x for p in parts for x in (gap, p)] + [gap])
    return joined, np.flatnonzero(joined != outside)


# ---- training --------------------------------------------------------------------------------------

ROWS = "shard long, block int, value binary, uses binary"


def blocks(shard: int, parts: list[np.ndarray], uses: list[np.ndarray]) -> pa.Table:
    """Parameter rows of a shard by blocks; blocks without uses are left out."""
    out = []
    for k, (p, u) in enumerate(zip(parts, uses)):
        for i in range(0, len(p), BLOCK):
            if u[i : i + BLOCK].any():
                out.append((shard, (k << 20) + i // BLOCK, p[i : i + BLOCK].astype("<f4").tobytes(), u[i : i + BLOCK].astype("<i8").tobytes()))
    return pa.table({c: pa.array([r[j] for r in out], t) for j, (c, t) in enumerate((("shard", pa.int64()), ("block", pa.int32()), ("value", pa.binary()), ("uses", pa.binary())))})


def add_blocks(rows: pa.Table) -> pa.Table:
    """Average of some shards' versions of a block, each row weighted by its uses."""
    rows = rows.sort_by("from")
    uses = [np.frombuffer(u, "<i8") for u in rows.column("uses").to_pylist()]
    values = [np.frombuffer(v, "<f4").reshape(len(u), -1) for v, u in zip(rows.column("value").to_pylist(), uses)]
    total = sum(uses)
    mean = sum(v.astype(float) * u[:, None] for v, u in zip(values, uses)) / np.maximum(total, 1)[:, None]
    first = rows.slice(0, 1)
    return pa.table({"shard": first.column("shard"), "block": first.column("block"), "value": pa.array([mean.astype("<f4").tobytes()], pa.binary()), "uses": pa.array([total.astype("<i8").tobytes()], pa.binary())})


def training_rows(tokens: DataFrame) -> DataFrame:
    """``h, tokens`` of the documents with words: the hash decides about round, shard and order.

    At most ``4 * shuffle partitions`` hashes can have a share of the rows that fills a shard: such equal rows are counted
    before the shuffle, and each copy has a hash of its own.
    """
    rows = tokens.where("n > 0").select(F.xxhash64("id", "tokens").alias("h"), "tokens")
    most = 4 * int(tokens.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = tokens.count()
    hot = [r.h for r in rows.groupBy("h").count().where((F.col("count") > 1) & (F.col("count") * most > total)).collect()]
    if not hot:
        return rows
    groups = rows.where(F.col("h").isin(hot)).groupBy("h").agg(F.count(F.lit(1)).alias("copies"), F.any_value("tokens").alias("tokens"))
    copies = groups.select("h", "tokens", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"))
    return rows.where(~F.col("h").isin(hot)).unionByName(copies.select(F.xxhash64("h", "copy").alias("h"), "tokens"))


def train_round(tokens: DataFrame, shards: int, net: Network, tree: Tree, turn: int, rounds: int, rows: DataFrame | None = None) -> Network:
    """Local training in every shard, then the average of their parameters; ``rows`` are those of :func:`training_rows`, if known."""
    outside = len(tree.size)

    def run(rows: pa.Table) -> pa.Table:
        trainer, held, waiting = Trainer(net, tree), [], 0

        def train() -> None:
            joined, at = padded(held, outside)
            for i in range(0, len(at), BATCH):
                trainer.step(joined, at[i : i + BATCH])

        rows = rows.sort_by([("h", "ascending"), ("tokens", "ascending")])
        for value in rows.column("tokens").to_pylist():
            held.append(np.frombuffer(value, "<u2"))
            waiting += len(held[-1])
            if waiting >= BATCH * 8:
                train()
                held, waiting = [], 0
        if waiting:
            train()
        return blocks(rows.column("shard")[0].as_py(), trainer.net.parts(), trainer.uses)

    rows = training_rows(tokens) if rows is None else rows
    dealt = rows.where(F.pmod("h", F.lit(rounds)) == turn).withColumn("shard", F.pmod(F.shiftright("h", 20), F.lit(shards)))
    sums, n = dealt.groupBy("shard").applyInArrow(run, ROWS), shards
    while n > 1:
        sums, n = sums.withColumn("from", F.col("shard")).withColumn("shard", F.floor(F.col("shard") / FAN_IN)).groupBy("shard", "block").applyInArrow(add_blocks, ROWS), -(-n // FAN_IN)
    after = net.copy()
    parts = after.parts()
    for r in sums.collect():  # one parameter set
        part, i = parts[r.block >> 20], (r.block & (1 << 20) - 1) * BLOCK
        uses = np.frombuffer(bytes(r.uses), "<i8")
        value = np.frombuffer(bytes(r.value), "<f4").reshape(len(uses), -1)
        part[i : i + len(uses)][uses > 0] = value[uses > 0]
    return after


@dataclass
class MaskedModel:
    words: list[bytes]
    tree: Tree
    network: Network
    counts: DataFrame  # stored: h, n of every word of the corpus
    others: int  # tokens of words without a code of their own


def tokenise(docs: DataFrame, words: list[bytes], id_col: str, text_col: str) -> DataFrame:
    """``row, id, n, tokens, others``: the tokens and the hashes of the words without one of their own (stored)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(words)
        for batch in batches:
            sizes, tokens, others = [], [], []
            for text in batch.column("text").to_pylist():
                own = words_of(text)
                t = vocabulary.tokens(own)
                sizes.append(len(own))
                tokens.append(t.astype("<u2").tobytes())
                others.append(np.fromiter((xxhash.xxh64_intdigest(name_of(own[i]), 42) for i in np.flatnonzero(t == vocabulary.other)), np.uint64).view(np.int64))
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, others)]).astype(np.int32)), pa.array(np.concatenate([np.zeros(0, np.int64), *others])))
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("id"), pa.array(sizes, pa.int64()), pa.array(tokens, pa.binary()), lists], ["row", "id", "n", "tokens", "others"])

    numbered = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return materialise(numbered.mapInArrow(run, f"row long, id {dict(docs.dtypes)[id_col]}, n long, tokens binary, others array<long>"), "lm-tokens")


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", own: int = OWN, rounds: int = 2, shard_tokens: int = SHARD_TOKENS, tokens: DataFrame | None = None, vocabulary: tuple | None = None) -> MaskedModel:
    prepare(docs.sparkSession)
    words, counts, total = vocabulary or corpus_words(docs, text_col, own)
    others = total - sum(n for _, n in words)
    names = [w for w, _ in words]
    tree = Tree.of([*(n for _, n in words), others])
    network = Network.start(tree)
    if rounds and total:
        tokens = tokenise(docs, names, id_col, text_col) if tokens is None else tokens
        shards = -(-total // (rounds * shard_tokens))
        dealt = training_rows(tokens)
        for turn in range(rounds):
            network = train_round(tokens, shards, network, tree, turn, rounds, dealt)
    return MaskedModel(names, tree, network, counts, others)


def corpus_words(docs: DataFrame, text_col: str, own: int = OWN) -> tuple[list[tuple[bytes, int]], DataFrame, int]:
    """The frequent words with their counts, the stored counts of all, and the number of tokens."""
    if own > 65_000:
        raise ValueError("tokens have 16 bits")
    counts = materialise(count_words(docs.select(F.col(text_col).alias("text"))), "word-counts")
    short = counts.where(F.substring("word", 1, 1) != F.lit(b"\0"))  # digests have no code of their own
    return frequent_words(short, own), counts, counts.agg(F.sum("n")).first()[0] or 0


def score(docs: DataFrame, model: MaskedModel, id_col: str = "doc_id", text_col: str = "text", tokens: DataFrame | None = None) -> DataFrame:
    """``id_col, n_tokens, pseudo_log_likelihood, mean_log_probability``."""
    prepare(docs.sparkSession)
    tokens = tokenise(docs, model.words, id_col, text_col) if tokens is None else tokens
    net, tree, id_type = model.network, model.tree, dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [np.frombuffer(t, "<u2") for t in batch.column("tokens").to_pylist()]
            joined, at = padded(parts, len(tree.size))
            found = log_probabilities(net, tree, joined, at)
            sizes = np.array([len(p) for p in parts], np.int64)
            sums, some = np.zeros(len(parts)), sizes > 0
            if some.any():
                sums[some] = np.add.reduceat(found, (np.cumsum(sizes) - sizes)[some])
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("id"), batch.column("n"), pa.array(sums)], ["row", "id", "n", "pll"])

    scored = tokens.select("row", "id", "n", "tokens").mapInArrow(run, f"row long, id {id_type}, n long, pll double")
    # Words without a code of their own: each with its share of their counts.
    rare = tokens.select("row", F.explode("others").alias("h")).join(model.counts.groupBy("h").agg(F.sum("n").alias("n")), "h", "left")
    rare = rare.groupBy("row").agg(F.sum(F.log(F.coalesce("n", F.lit(1)) / float(max(1, model.others)))).alias("rare"))
    pll = F.col("pll") + F.coalesce("rare", F.lit(0.0))
    rows = scored.join(rare, "row", "left").select(F.col("id").alias(id_col), F.col("n").alias("n_tokens"), pll.alias("pseudo_log_likelihood"))
    return rows.withColumn("mean_log_probability", F.coalesce(F.try_divide("pseudo_log_likelihood", "n_tokens"), F.lit(0.0)))


def score_corpus(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", own: int = OWN, rounds: int = 2, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Train on ``docs`` and score them; texts are tokenised once."""
    prepare(docs.sparkSession)
    vocabulary = corpus_words(docs, text_col, own)
    tokens = tokenise(docs, [w for w, _ in vocabulary[0]], id_col, text_col)
    return score(docs, fit(docs, id_col, text_col, own, rounds, shard_tokens, tokens, vocabulary), id_col, text_col, tokens)


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_corpus(table(spark, sf_dir, "documents"))
