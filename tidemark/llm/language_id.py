"""Language identification with string kernels.

The kernel of two texts counts the character n-grams (1 to 3, a blended spectrum) present in both, over
the root of the product of their numbers of distinct n-grams. Texts are lower-cased, everything but letters becomes one
sign, and an n-gram of code points is hashed to one of ``SPACE`` slots: every script keeps its letters.
Nyström: a few training texts of each language are landmarks; with K_mm among landmarks and K_nm to them,
one-versus-rest kernel ridge regression is solved in the space K_nm K_mm^(-1/2). Scoring is two matrix
products for a batch of documents: presence x landmarks, then kernel values x coefficients.

Bounds (parameters): every label is learned, from up to ``per_language`` texts, ``landmarks`` of them landmarks; with
so many labels that this exceeds ``texts`` texts or ``most_landmarks`` landmarks in all, each label gets its share of
those, at least two texts and one landmark. Only texts and labels of rows that aren't held out are learned from.

Nulls, ties, odd inputs: a null text, or one without letters, is ``und`` with score 0; very long texts are read whole;
null labels teach nothing; equal decision values give the label that sorts first; of a training id that repeats the
least label and text are learned from; every row is scored, repeated or not. Without labelled rows all are ``und``. An
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import held_out, materialise, prepare, table

SPACE = 1 << 18
BATCH = 128


def has_letters(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def letter_table() -> np.ndarray:
    """Of every code point, itself if it is a letter, else 0."""
    return np.fromiter((c if chr(c).isalpha() else 0 for c in range(0x110000)), np.uint32, 0x110000)


def slot(h: np.ndarray) -> np.ndarray:
    h = h ^ h >> np.uint64(31)
    return (h * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(46)).astype(np.int64)


def present(text: str, letters: np.ndarray) -> np.ndarray:
    """Flags of the slots of the n-grams (1 to 3) of the text."""
    c = letters[np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)].astype(np.uint64) + np.uint64(1)
    flags = np.zeros(SPACE, bool)
    two = c[:-1] << np.uint64(21) | c[1:]
    for h in (c, two, two[:-1] << np.uint64(21) | c[2:]):
        flags[slot(h)] = True
    return flags


class KernelClassifier:
    def __init__(self, grams: list[np.ndarray], labels: list[str], landmarks: int, ridge: float = 1e-3) -> None:
        """grams: the n-grams present in each training text; the first texts of a label are its landmarks."""
        self.classes = sorted(set(labels))
        y = np.array([self.classes.index(x) for x in labels])
        marks = np.sort(np.concatenate([np.flatnonzero(y == k)[:landmarks] for k in range(len(self.classes))]))
        self.grams = np.unique(np.concatenate([grams[i] for i in marks]))
        sizes = np.sqrt([max(1, len(g)) for g in grams]).astype(np.float32)
        self.landmarks = np.concatenate([self.rows([grams[i]]) / sizes[i] for i in marks]).T.copy()
        blocks = [self.rows(grams[i : i + BATCH]) @ self.landmarks for i in range(0, len(grams), BATCH)]  # a block of texts at a time
        k_nm = (np.concatenate(blocks) / sizes[:, None]).astype(float)
        values, vectors = np.linalg.eigh(k_nm[marks] + 1e-6 * np.eye(len(marks)))
        root = vectors / np.sqrt(np.maximum(values, 1e-6)) @ vectors.T
        phi, n = np.hstack([k_nm @ root, np.ones((len(y), 1))]), len(y)
        weight = (n / len(self.classes) / np.bincount(y))[y]  # each language counts the same
        target = np.where(y[:, None] == np.arange(len(self.classes)), 1.0, -1.0)
        beta = np.linalg.solve(phi.T @ (weight[:, None] * phi) + ridge * n * np.eye(phi.shape[1]) / 100, phi.T @ (weight[:, None] * target))
        self.alpha, self.offset = root @ beta[:-1], beta[-1]

    def rows(self, grams: list[np.ndarray]) -> np.ndarray:
        out = np.zeros((len(grams), len(self.grams)), np.float32)
        for row, g in zip(out, grams):
            at = np.searchsorted(self.grams, g)
            row[at[(at < len(self.grams)) & (self.grams[np.minimum(at, len(self.grams) - 1)] == g)]] = 1
        return out

    def predict(self, texts: list[str], codes: np.ndarray) -> tuple[list[str], np.ndarray]:
        rows, sizes = np.zeros((len(texts), len(self.grams)), np.float32), np.ones(len(texts), np.float32)
        for i, text in enumerate(texts):
            flags = present(text, codes)
            rows[i], sizes[i] = flags[self.grams], np.sqrt(max(1, np.count_nonzero(flags)))
        values = (rows @ self.landmarks / sizes[:, None]) @ self.alpha + self.offset
        odds = np.exp(4 * (values - values.max(axis=1, keepdims=True)))
        odds /= odds.sum(axis=1, keepdims=True)
        best = values.argmax(axis=1)
        return [self.classes[k] for k in best], odds[np.arange(len(texts)), best]


def training_ids(docs: DataFrame, id_col: str, lang_col: str, per_language: int, texts: int) -> DataFrame:
    """``id, lang``: up to ``per_language`` labelled training documents of each language, picked by hash of the id."""
    known = docs.where(F.col(lang_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col)).groupBy(F.col(id_col).alias("id")).agg(F.min(lang_col).alias("lang"))
    sizes = materialise(known.groupBy("lang").count(), "langid-labels")
    each = min(per_language, max(2, texts // max(1, sizes.count())))
    # A hash threshold leaves about twice as many as wanted, before the exact ranking.
    near = F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < F.lit(2 * each << 20) / F.col("count") + 64
    order = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
    return known.join(sizes, "lang").where(near).withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= each).select("id", "lang")


def fit(docs: DataFrame, id_col: str, text_col: str, lang_col: str, per_language: int, landmarks: int, texts: int, most_landmarks: int) -> KernelClassifier | None:
    picked = F.broadcast(materialise(training_ids(docs, id_col, lang_col, per_language, texts), "langid-ids"))  # at most ``texts`` rows, or two for each label
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(picked, "id").groupBy("id", "lang").agg(F.min("text").alias("text"))

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = letter_table()
        for batch in batches:
            out = [np.flatnonzero(present(t, letters)).astype("<u4").tobytes() if has_letters(t) else None for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(out, pa.binary())], ["lang", "grams"])

    found = rows.orderBy(F.xxhash64("id"), "id").select("text", "lang").mapInArrow(grams, "lang string, grams binary").where("grams is not null").collect()
    if not found:
        return None
    marks = min(landmarks, max(1, most_landmarks // len({r.lang for r in found})))
    return KernelClassifier([np.frombuffer(r.grams, "<u4").astype(np.int64) for r in found], [r.lang for r in found], marks)


def identify_languages(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = 300, landmarks: int = 32, texts: int = 12_000, most_landmarks: int = 384
) -> DataFrame:
    """One row per document: ``id_col, held_out, lang_pred, score``."""
    prepare(docs.sparkSession)
    model = fit(docs, id_col, text_col, lang_col, per_language, landmarks, texts, most_landmarks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = letter_table() if model else None
        for batch in batches:
            texts = batch.column("text").to_pylist()
            langs, scores = ["und"] * len(texts), np.zeros(len(texts))
            known = [i for i, t in enumerate(texts) if model and has_letters(t)]
            for at in range(0, len(known), BATCH):
                part = known[at : at + BATCH]
                found, odds = model.predict([texts[i] for i in part], codes)
                for i, lang, x in zip(part, found, odds):
                    langs[i], scores[i] = lang, x
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(langs), pa.array(scores)], ["id", "lang_pred", "score"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    found = rows.mapInArrow(run, f"id {dict(docs.dtypes)[id_col]}, lang_pred string, score double")
    return found.select(F.col("id").alias(id_col), held_out("id").alias("held_out"), "lang_pred", "score")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(table(spark, sf_dir, "documents"))
