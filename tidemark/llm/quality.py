"""Quality classifier with supervised subword embeddings.

A word (text between white space) has a hashed vector of its own and one for each of its character
n-grams; they are averaged, the words of a document are averaged, and a softmax layer gives the class.
Numpy stochastic gradient descent trains vectors and output on a bounded sample of labelled rows. Because
the averages are linear, a trained vector enters the score only by its product with the output layer, so
scoring adds one number per word.

Bound (parameter): ``sample`` labelled documents of each class. The intercept is then moved from the
sample's class shares to those of all labels that aren't held out.

Nulls, ties, odd inputs: a null or wordless text gets the class shares as its score; very long texts are read whole;
null labels teach nothing; of repeated labels of a document the larger counts; of the texts of a labelled id that
repeats the least one is learned from. With labels of one class or none the score is the share of label 1 (0.5 without
labels). Every row is scored, repeated or not; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import held_out, labelled_sample, materialise, prepare, table

BUCKETS, DIM = 1 << 17, 16
GRAMS = (3, 4)
KNOWN_WORDS = 300_000


def features(word: bytes) -> list[int]:
    """Buckets of the word and of its character n-grams; the first is the word's own."""
    framed, mask = b"<" + word + b">", BUCKETS - 1
    out = [crc32(word, 1) & mask]
    for n in GRAMS:
        out += [crc32(framed[i : i + n]) & mask for i in range(len(framed) - n + 1)]
    return out


def document_weights(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The document vector is the sum of these buckets' vectors with these weights."""
    words = (text or "").encode().split()
    total = np.zeros(BUCKETS, np.float64)
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    for w, k in counts.items():
        own = features(w)
        np.add.at(total, own, k / len(own) / len(words))
    at = np.flatnonzero(total)
    return at.astype("<u4"), total[at].astype("<f4")


class SubwordClassifier:
    """``gain[bucket]`` is the bucket's vector times the difference of the two output vectors."""

    def __init__(self, docs: list[tuple[np.ndarray, np.ndarray]], labels: list[int], shares: tuple[float, float], epochs: int = 12, rate: float = 1.0, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        vectors = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
        out, bias = np.zeros((2, DIM), np.float32), np.zeros(2, np.float32)
        steps, done = epochs * len(docs), 0
        for _ in range(epochs if len(set(labels)) == 2 else 0):
            for i in rng.permutation(len(docs)):
                at, weight = docs[i]
                step = rate * (1 - done / steps)
                done += 1
                hidden = weight @ vectors[at]
                odds = np.exp(z := out @ hidden + bias - (out @ hidden + bias).max())
                error = odds / odds.sum()
                error[labels[i]] -= 1
                back = error @ out
                out -= step * np.outer(error, hidden)
                bias -= 0.1 * step * error
                # Scaled by the document's weight norm: long documents would otherwise hardly move their words.
                vectors[at] -= np.outer(step * weight / max(1e-6, float(weight @ weight)) * 0.05, back)
        self.gain = (vectors @ (out[1] - out[0])).astype(np.float32) if done else np.zeros(BUCKETS, np.float32)
        log_odds = float(np.log(max(shares[1], 1e-3) / max(shares[0], 1e-3)))
        ones = sum(labels)
        sampled = float(np.log(ones / (len(labels) - ones))) if done else 0.0
        self.bias, self.empty = float(bias[1] - bias[0]) + log_odds - sampled if done else log_odds, log_odds


class _Gains(dict):
    def __init__(self, model: SubwordClassifier) -> None:
        self.gain = model.gain.tolist()

    def __missing__(self, word: bytes) -> float:
        own = features(word)
        out = sum(map(self.gain.__getitem__, own)) / len(own)
        if len(self) >= KNOWN_WORDS:
            self.clear()
        if len(word) <= 64:
            self[word] = out
        return out


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = 1200, threshold: float = 0.3) -> DataFrame:
    """One row per document: ``id_col, held_out, score, predicted``."""
    prepare(docs.sparkSession)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    known = labels.where(F.col(label_col).isNotNull() & ~held_out(id_col)).groupBy(F.col(label_col).cast("int").alias("y")).count()
    sizes = {r.y: r["count"] for r in known.collect()}
    shares = tuple((sizes.get(y, 0) + 0.0) / max(1, sum(sizes.values())) if sizes else 0.5 for y in (0, 1))
    picked = F.broadcast(labelled_sample(labels, id_col, label_col, sample))  # at most 2 * sample rows
    chosen = materialise(texts.join(picked, "id").groupBy("id", "gold").agg(F.min("text").alias("text")), "quality-sample")

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [document_weights(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("gold"), *(pa.array([x[i].tobytes() for x in out], pa.binary()) for i in (0, 1))], ["id", "gold", "buckets", "weights"]
            )

    rows = chosen.mapInArrow(weigh, f"id {dict(docs.dtypes)[id_col]}, gold int, buckets binary, weights binary").collect()
    rows = sorted((r for r in rows if r.buckets), key=lambda r: (str(r.id), r.buckets))
    model = SubwordClassifier([(np.frombuffer(r.buckets, "<u4").astype(np.int64), np.frombuffer(r.weights, "<f4")) for r in rows], [r.gold for r in rows], shares)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gains = _Gains(model)
        for batch in batches:
            logits = []
            for text in batch.column("text").to_pylist():
                words = (text or "").encode().split()
                logits.append(sum(map(gains.__getitem__, words)) / len(words) + model.bias if words else model.empty)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(1 / (1 + np.exp(-np.clip(np.array(logits, float), -30, 30))))], ["id", "score"])

    found = texts.mapInArrow(run, f"id {dict(docs.dtypes)[id_col]}, score double")
    return found.select(F.col("id").alias(id_col), held_out("id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
