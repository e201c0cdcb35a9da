"""Toxicity by weak supervision.

1. *Lexicons.* Seed lists of insults in four languages, and words and word beginnings that a bounded sample of labelled
   documents ties to the toxic label (document counts summed by Spark; near copies in the sample count
   once, so that no single copied text makes its words look toxic).
2. *Voters.* Thirteen lexicon and pattern voters say toxic (1), clean (-1) or nothing (0) about every document.
3. *Label model.* A generative model of the votes: the hidden label, each voter's accuracy, and for
   correlated voters a tree of dependencies (each voter may also depend on one other). Expectation
   maximisation over the counts of vote patterns of all training documents, labelled or not; labels give the first
   estimates and a prior of ``PRIOR`` of the weight, and no document's posterior is set by its label.
4. *Classifier.* Logistic regression on hit counts and rates, trained on the posterior labels of all training
   documents: every Newton step adds up gradient and curvature in Spark. Its score is a Spark expression.

Bounds (parameters): ``sample`` labelled documents per class teach the lexicons and the first estimates, ``lexicon``
learned entries of a kind. Eight voters have two answers and five have three: at most 62,208 vote patterns.

Nulls, ties, odd inputs: null or empty texts have no hits and get the score of a text without any; very long texts are
read whole; null labels are no labels; of repeated labels of a document the larger counts; a null id is in no fold and
has no label; of the texts of a labelled id that repeats the least one is learned from. Without labels the seed lists
alone vote. An empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import held_out, labelled_sample, materialise, prepare, table

#: Mild insults, by language.
SEEDS_BY_LANGUAGE = {
    "en": "idiot idiots moron morons stupid loser losers scum trash clown worthless pathetic disgusting dumb fool imbecile".split(),
    "fr": "idiote imbécile crétin ordure pourriture minable connard débile".split(),
    "de": "dumm trottel abschaum wertlos erbärmlich widerlich schwachkopf vollidiot".split(),
    "es": "estúpido imbécil basura escoria inútil patético asqueroso payaso".split(),
}
SEEDS = frozenset(w for words in SEEDS_BY_LANGUAGE.values() for w in words)
WORD = re.compile(r"\w+")
AT_YOU = re.compile(r"\b(?:you(?: are|'re)|tu es|vous êtes|du bist|eres)\b(?:\s+\w+){0,2}?\s+(?:" + "|".join(sorted(SEEDS)) + r")\b")
#: Lengths of the word beginnings that are learned beside whole words (0).
KINDS = (0, 4, 5, 6)
SAMPLE, LEXICON = 6000, 4000
PRIOR = 0.1
KNOWN_WORDS = 200_000


def feature_of(word: str, kind: int) -> str | None:
    if not kind:
        return f"0{word}"
    return f"{kind}{word[:kind]}" if len(word) > kind else None


@dataclass
class Lexicons:
    """Learned entries with their log odds, and the strength from which one is strong."""

    odds: dict[str, float] = field(default_factory=dict)
    strong: float = 3.0

    def mask(self, word: str) -> int:
        """Bit 0: seed; then for each kind a bit for any entry and a bit for a strong one."""
        out = int(word in SEEDS)
        for i, kind in enumerate(KINDS):
            odds = self.odds.get(feature_of(word, kind) or "")
            if odds is not None:
                out |= 1 << (1 + 2 * i)
                out |= (odds >= self.strong) << (2 + 2 * i)
        return out


N_COUNTS = 1 + 2 * len(KINDS)


class _Masks(dict):
    def __init__(self, lexicons: Lexicons) -> None:
        self.lexicons = lexicons

    def __missing__(self, word: str) -> int:
        out = self.lexicons.mask(word)
        if len(self) >= KNOWN_WORDS:
            self.clear()
        if len(word) <= 64:
            self[word] = out
        return out


def votes_and_features(text: str | None, masks: _Masks) -> tuple[list[int], list[float]]:
    text = text or ""
    words = WORD.findall(text.lower())
    n = max(1, len(words))
    counts = np.zeros(N_COUNTS)
    distinct = np.zeros(N_COUNTS)
    by_mask = Counter(map(masks.__getitem__, words))
    if len(by_mask) > (0 in by_mask):
        for m, k in by_mask.items():
            for bit in range(N_COUNTS):
                counts[bit] += k * (m >> bit & 1)
        for word in {w for w in words if masks[w]}:
            for bit in range(N_COUNTS):
                distinct[bit] += masks[word] >> bit & 1
    letters = sum(map(text.count, "ETAOINRS")) / max(1, len(text))
    shouts = text.count("!") / n
    seeds = {w for w in words if w in SEEDS} if counts[0] else set()
    # Two answers: toxic or nothing.
    votes = [int(not seeds.isdisjoint(of_language)) for of_language in SEEDS_BY_LANGUAGE.values()]
    votes += [int(len(seeds) >= 2), int(bool(seeds) and AT_YOU.search(text.lower()) is not None), int(letters > 0.3 and bool(seeds)), int(shouts > 0.1 and counts[2] > 0)]
    # Three answers: also clean.
    for i in range(len(KINDS)):
        strong = distinct[2 + 2 * i]
        votes.append(1 if strong >= 2 or counts[2 + 2 * i] >= 3 else 0 if strong else -1)
    rate = counts[2] / n
    votes.append(1 if rate > 0.004 else -1 if rate == 0 else 0)
    features = [*np.log1p(counts), *np.minimum(distinct, 5), *np.minimum(50 * counts / n, 5), letters, min(shouts, 2.0)]
    return votes, [float(x) for x in features]


N_VOTERS = len(SEEDS_BY_LANGUAGE) + 4 + len(KINDS) + 1
N_FEATURES = 3 * N_COUNTS + 2


# ---- lexicons --------------------------------------------------------------------------------------


def _copy_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Two minima of shingle hashes: near copies share at least one of them almost surely."""
    for batch in batches:
        keys = []
        for text in batch.column("text").to_pylist():
            words = WORD.findall((text or "").lower())
            shingles = {zlib.crc32(" ".join(words[i : i + 3]).encode()) for i in range(max(1, len(words) - 2))}
            keys.append((min(shingles), min(s * 0x9E3779B1 & 0xFFFFFFFF for s in shingles)))
        yield pa.RecordBatch.from_arrays([batch.column("id"), *(pa.array([k[i] for k in keys], pa.int64()) for i in (0, 1))], ["id", "k1", "k2"])


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        seen = (Counter(), Counter())
        for text, gold in zip(batch.column("text").to_pylist(), batch.column("gold").to_pylist()):
            words = set(WORD.findall((text or "").lower()))
            seen[gold].update({f for w in words for kind in KINDS if (f := feature_of(w, kind))})
        names = list(seen[0] | seen[1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), *(pa.array([c[f] for f in names], pa.int64()) for c in seen)], ["feature", "clean", "toxic"]
        )


def learn_lexicons(sample: DataFrame, id_type: str, most: int = LEXICON) -> Lexicons:
    """From ``id, gold, text`` of the labelled sample."""
    keys = sample.mapInArrow(_copy_keys, f"id {id_type}, k1 long, k2 long")
    for k in ("k1", "k2"):
        keys = keys.join(keys.groupBy(k).agg(F.min("id").alias("first")), k).where("id = first").drop("first")
    once = materialise(sample.join(keys.select("id"), "id", "left_semi"), "toxic-once")
    sizes = {r.gold: r["count"] for r in once.groupBy("gold").count().collect()}
    clean, toxic = sizes.get(0, 0), sizes.get(1, 0)
    if not toxic or not clean:
        return Lexicons()
    counts = once.select("text", "gold").mapInArrow(_document_counts, "feature string, clean long, toxic long").groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    # Log odds less one standard error, so that a few chance documents don't make an entry.
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1))
    odds = odds - F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5))
    found = counts.where(F.col("toxic") >= max(3.0, 0.008 * toxic)).withColumn("odds", odds).where("odds > 1.5")
    kinds = [found.where(F.col("feature").startswith(str(k))).orderBy(F.desc("odds"), "feature").limit(most) for k in KINDS]
    return Lexicons({r.feature: r.odds for part in kinds for r in part.select("feature", "odds").collect()})


# ---- label model -----------------------------------------------------------------------------------


class LabelModel:
    """P(label) and P(vote of voter j | label, vote of its parent), fitted to counts of vote patterns."""

    def __init__(self, votes: np.ndarray, counts: np.ndarray, known: np.ndarray | None = None, rounds: int = 30, strength: float = PRIOR) -> None:
        """votes: patterns x voters in {-1, 0, 1}; counts: rows of a pattern; known: its labelled rows, clean and toxic (patterns x 2)."""
        v = votes + 1
        self.parents = [-1] * v.shape[1]
        labelled = known if known is not None and (known.sum(axis=0) > 0).all() else np.zeros((len(v), 2))
        if labelled.any():  # the first estimates come from the labels; afterwards they are a prior of a bounded weight
            self._estimate(v, labelled.T)
            labelled = labelled * min(1.0, strength * counts.sum() / labelled.sum())
            post = self.posterior(votes)
        else:
            post = np.where(votes.max(axis=1, initial=0) > 0, 0.9, 0.02)
        for step in range(rounds):
            if step == 5:
                self.parents = self._tree(v, counts, post)
            self._estimate(v, np.stack([counts * (1 - post), counts * post]) + labelled.T)
            post = self.posterior(votes)

    def _estimate(self, v: np.ndarray, weight: np.ndarray) -> None:
        self.prior = (weight.sum(axis=1) + 1) / (weight.sum() + 2)
        self.given = []
        for j, parent in enumerate(self.parents):
            of_parent = v[:, parent] if parent >= 0 else np.zeros(len(v), int)
            t = np.full((2, 3, 3), 0.5)
            for y in (0, 1):
                np.add.at(t[y], (of_parent, v[:, j]), weight[y])
            self.given.append(t / t.sum(axis=2, keepdims=True))

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """P(toxic) of each row of votes."""
        v = votes + 1
        logs = np.tile(np.log(self.prior)[:, None], len(v))
        for j, parent in enumerate(self.parents):
            of_parent = v[:, parent] if parent >= 0 else np.zeros(len(v), int)
            logs += np.log(self.given[j])[:, of_parent, v[:, j]]
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500)))

    @staticmethod
    def _tree(v: np.ndarray, counts: np.ndarray, post: np.ndarray, least: float = 0.01) -> list[int]:
        """Parents by a maximum spanning tree over the voters' correlation that the label doesn't explain."""
        n = v.shape[1]
        info = np.zeros((n, n))
        for i in range(n):
            for j in range(i):
                for w in (counts * (1 - post), counts * post):
                    joint = np.full((3, 3), 1e-9)
                    np.add.at(joint, (v[:, i], v[:, j]), w)
                    p = joint / joint.sum()
                    info[i, j] += w.sum() / counts.sum() * (p * np.log(p / np.outer(p.sum(1), p.sum(0)))).sum()
        info += info.T
        parents, inside = [-1] * n, {0}
        while len(inside) < n:
            i, j = max(((i, j) for i in range(n) if i not in inside for j in inside), key=lambda e: info[e])
            parents[i] = j if info[i, j] > least else -1
            inside.add(i)
        return parents


def newton_sums(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Gradient and curvature of the logistic loss on soft labels, added up over rows: one row of the matrix each feature (the last is the intercept)."""
    x = np.hstack([x, np.ones((len(x), 1))])
    p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
    return np.hstack([(x.T @ (p - y))[:, None], (x * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ x])


def newton_step(sums: np.ndarray, w: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    penalty = np.r_[np.full(len(w) - 1, ridge), 1e-6]
    step = np.linalg.solve(sums[:, 1:] + np.diag(penalty), sums[:, 0] + penalty * w)
    return w - step * min(1.0, 10 / max(1e-9, np.abs(step).max()))


# ---- the operator ----------------------------------------------------------------------------------


def decoded(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Votes and features of stored rows."""
    votes = np.frombuffer(b"".join(batch.column("votes").to_pylist()), np.int8).reshape(-1, N_VOTERS).astype(np.int64)
    return votes, np.stack([c.to_numpy(zero_copy_only=False) for c in batch.column("x").flatten()], axis=1) if batch.num_rows else np.zeros((0, N_FEATURES))


def fit_classifier(train: DataFrame, model: LabelModel, rounds: int = 10) -> np.ndarray:
    """Newton's method over all training rows; the driver gets one matrix of fixed size, added up by Spark, for each step."""
    n = N_FEATURES + 1
    w = np.zeros(n)
    for _ in range(rounds):

        def run(batches: Iterator[pa.RecordBatch], w: np.ndarray = w) -> Iterator[pa.RecordBatch]:
            total = np.zeros((n, n + 1))
            for batch in batches:
                votes, x = decoded(batch)
                total += newton_sums(x, model.posterior(votes), w)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size, dtype=np.int32)), pa.array(total.ravel())], ["slot", "value"])

        sums = np.zeros(n * (n + 1))
        for r in train.select("votes", "x").mapInArrow(run, "slot int, value double").groupBy("slot").agg(F.sum("value").alias("value")).collect():
            sums[r.slot] = r.value
        before, w = w, newton_step(sums.reshape(n, n + 1), w)
        if np.abs(w - before).max() < 1e-4:
            break
    return w


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE, lexicon: int = LEXICON, threshold: float = 0.5) -> DataFrame:
    """One row per document: ``id_col, held_out, score, predicted``; learns from rows that aren't held out."""
    spark = docs.sparkSession
    prepare(spark)
    id_type = dict(docs.dtypes)[id_col]
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    picked = F.broadcast(labelled_sample(labels, id_col, label_col, sample))  # at most 2 * sample rows
    chosen = materialise(picked.join(texts, "id").groupBy("id", "gold").agg(F.min("text").alias("text")), "toxic-sample")
    lexicons = learn_lexicons(chosen, id_type, lexicon)

    def votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masks = _Masks(lexicons)
        for batch in batches:
            out = [votes_and_features(t, masks) for t in batch.column("text").to_pylist()]
            x = np.array([f for _, f in out], float).reshape(-1, N_FEATURES)
            columns = pa.StructArray.from_arrays([pa.array(x[:, i]) for i in range(N_FEATURES)], [f"f{i}" for i in range(N_FEATURES)])
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([np.array(v, np.int8).tobytes() for v, _ in out], pa.binary()), columns], ["id", "votes", "x"])

    fields = ", ".join(f"f{i}: double" for i in range(N_FEATURES))
    voted = materialise(texts.mapInArrow(votes, f"id {id_type}, votes binary, x struct<{fields}>").withColumn("held_out", held_out("id")), "toxic-votes")
    train = voted.where(~F.col("held_out"))
    patterns = train.groupBy("votes").count().collect()  # at most 62,208 rows
    if not patterns:  # nothing to learn from: the seed lists decide
        weights = np.zeros(N_FEATURES + 1)
        weights[N_COUNTS], weights[-1] = 4.0, -5.0
        return _scored(voted, weights, id_col, threshold)
    golds = {bytes(r.votes): (r.clean, r.toxic) for r in train.join(picked, "id").groupBy("votes").agg(F.count_if(F.col("gold") == 0).alias("clean"), F.count_if(F.col("gold") == 1).alias("toxic")).collect()}
    rows = np.array([np.frombuffer(bytes(r.votes), np.int8) for r in patterns], np.int64)
    model = LabelModel(rows, np.array([r["count"] for r in patterns], float), np.array([golds.get(bytes(r.votes), (0, 0)) for r in patterns], float))
    return _scored(voted, fit_classifier(train, model), id_col, threshold)


def _scored(voted: DataFrame, weights: np.ndarray, id_col: str, threshold: float) -> DataFrame:
    total: Column = F.lit(float(weights[-1]))
    for i, w in enumerate(weights[:-1]):
        total = total + F.col(f"x.f{i}") * float(w)
    found = voted.select("id", "held_out", (1 / (1 + F.exp(-total))).alias("score"))
    return found.select(F.col("id").alias(id_col), "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
