"""Spelling variants of a corpus vocabulary by search schemes over bidirectional FM-indexes.

*Vocabulary.* Words are counted over all whole texts in one aggregation; which occurrences lose a letter (a planted
misspelling) hangs on the document and the word alone.

*Index.* A block of words stands in one text ``$word$word...$word``, read as a ring. Its Burrows-Wheeler transform and that
of its reverse hold, per 64 positions and letter, how many lesser letters came before; so the suffixes that begin with a
pattern are an interval of ranks that grows by a letter on either side, both transforms kept in step.

*Search scheme.* One wrong letter lies in one half of a word. Either half is matched exactly with its delimiter, and the
interval is extended across the other half letter by letter; at every place a branch may spend its one error (another
letter, one more, one less) and must then reach the far delimiter exactly. A branch that holds but the word itself ends.

*Blocks.* Words whose first halves agree share their first two letters, words whose second halves agree the last two. So
words are dealt by these, rare beginnings gathered up to ``block_chars`` letters, frequent ones cut into blocks of which
each meets each: a task holds two blocks, however many words begin alike. The blocks of a side come from sums over at
most 90 x 90 pairs of letters. No neighbour is capped: a word of n letters has at most 180 n + 90 of them.

*Forms.* A word's form is its most frequent near word, if twice as frequent. Forms have at least doubled counts at each
step, so roots come from a few rounds of pointer doubling.

Nulls and ties: null texts have no words, a null id counts as an empty one; every row counts, repeated or not; of equally
frequent near words the least in code-point order is the form. Very long texts and words are read whole. Other columns are
ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, materialise, prepare, table

RUN = "[A-Za-z\\u00C0-\\u00FF]+"
#: Letters of a word in order, behind the delimiter 0.
LETTERS = [*range(0x61, 0x7B), *range(0xC0, 0x100)]
SIGMA = len(LETTERS) + 1
#: Letters of a block at most (one longer word is a block of its own), and at least where a corpus is small.
BLOCK_CHARS, LEAST_CHARS = 1 << 21, 1 << 15
#: Words that are searched for at once.
AT_ONCE = 4096


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_letters: int = 5, min_count: int = 3, every: int = 97) -> DataFrame:
    """``word, n``: the runs of letters, every ``every``-th by checksum of document and run with one letter missing."""
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all(ascii_lower(F.col(text_col)), F.lit(RUN), F.lit(0))).alias("run"))
    h = F.crc32(F.concat_ws(":", "id", "run").cast("binary"))
    at = F.pmod("h", F.length("run")).cast("int")
    less = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    word = F.when(F.col("h") % every == 0, less).otherwise(F.col("run"))
    words = runs.withColumn("h", h).select(word.alias("word")).where(F.length("word") >= min_letters)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


class Transform:
    """The Burrows-Wheeler transform of a ring of letters, with the counts of lesser letters at any place."""

    def __init__(self, text: np.ndarray, with_places: bool = False) -> None:
        n = len(text)
        rank, step = np.zeros(n, np.int64), 8
        for i in range(step):  # eight letters of seven bits at once, then twice as many each round
            rank = rank << 7 | np.roll(text, -i)
        while True:
            _, rank = np.unique(rank, return_inverse=True)
            if rank.max(initial=0) == n - 1:
                break
            rank = rank * n + np.roll(rank, -step)
            step *= 2
        order = np.empty(n, np.int64)
        order[rank] = np.arange(n)
        self.order = order if with_places else None
        last = text[(order - 1) % n]
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=SIGMA))])
        blocks = n // 64 + 1
        padded = np.full(blocks * 64, SIGMA, np.uint8)
        padded[:n] = last
        padded = padded.reshape(blocks, 64)
        self.bits, self.sums = np.zeros((blocks, SIGMA + 1), np.uint64), np.zeros((blocks, SIGMA + 1), np.int64)
        weights = np.uint64(1) << np.arange(64, dtype=np.uint64)
        for c in range(1, SIGMA + 1):
            self.bits[:, c] = ((padded < c) * weights).sum(1, dtype=np.uint64)
        counts = np.bitwise_count(self.bits).astype(np.int64)
        np.cumsum(counts[:-1], 0, out=self.sums[1:])

    def _inside(self, place: np.ndarray) -> np.ndarray:
        return (np.uint64(1) << (place & 63).astype(np.uint64)) - np.uint64(1)

    def lesser(self, place: np.ndarray, letter: np.ndarray) -> np.ndarray:
        """How many letters less than ``letter`` stand before ``place``."""
        block = place >> 6
        return self.sums[block, letter] + np.bitwise_count(self.bits[block, letter] & self._inside(place))

    def all_lesser(self, place: np.ndarray) -> np.ndarray:
        block = place >> 6
        return self.sums[block] + np.bitwise_count(self.bits[block] & self._inside(place)[:, None])


class Intervals:
    """Intervals of a bidirectional index: beginning in one transform and in the other, and size.

    ``near`` is the beginning in the transform that the side of growth needs, ``far`` that in the other one.
    """

    def __init__(self, near: np.ndarray, far: np.ndarray, size: np.ndarray) -> None:
        self.near, self.far, self.size = near, far, size

    def turned(self) -> Intervals:
        return Intervals(self.far, self.near, self.size)

    def take(self, at: np.ndarray) -> Intervals:
        return Intervals(self.near[at], self.far[at], self.size[at])

    def grown(self, t: Transform, letter: np.ndarray) -> Intervals:
        a, a1 = t.lesser(self.near, letter), t.lesser(self.near, letter + 1)
        b, b1 = t.lesser(self.near + self.size, letter), t.lesser(self.near + self.size, letter + 1)
        return Intervals(t.first[letter] + a1 - a, self.far + b - a, b1 - b - a1 + a)

    def grown_by_all(self, t: Transform) -> tuple[np.ndarray, np.ndarray, Intervals]:
        """Which interval and which letter, and what they grow to: all of size one or more, the delimiter left out."""
        a, b = t.all_lesser(self.near), t.all_lesser(self.near + self.size)
        sizes = np.diff(b - a, axis=1)
        sizes[:, 0] = 0
        i, c = np.nonzero(sizes)
        return i, c, Intervals(t.first[c] + (a[i, c + 1] - a[i, c]), self.far[i] + b[i, c] - a[i, c], sizes[i, c])


def _letters(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All letters of the words one behind the other, a delimiter in front of each, and where the words begin."""
    code = np.zeros(256, np.uint8)
    code[LETTERS] = np.arange(1, SIGMA)
    text = code[np.frombuffer(("\0" + "\0".join(words)).encode("latin-1"), np.uint8)]
    return text, np.flatnonzero(text == 0)


class Index:
    """A bidirectional FM-index over distinct words between delimiters."""

    def __init__(self, words: list[str]) -> None:
        text, self.starts = _letters(words)
        self.forward, self.backward = Transform(text, True), Transform(text[::-1].copy())
        self.n = len(text)

    def near(self, words: list[str], side: str, own: bool) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (number of a word in ``words``, number of an indexed word) that differ by one letter in the half away from ``side``.

        ``side`` is the half that is matched exactly, ``first`` or ``second``; ``own`` says that the words are the indexed ones.
        """
        found = [self._near(words[at : at + AT_ONCE], side, own, at) for at in range(0, len(words), AT_ONCE)]
        mine, other = (np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64) for i in (0, 1))
        pairs = np.unique(mine * len(self.starts) + other)
        return pairs // len(self.starts), pairs % len(self.starts)

    def _near(self, words: list[str], side: str, own: bool, offset: int) -> tuple[np.ndarray, np.ndarray]:
        text, starts = _letters(words)
        text, starts = np.append(text, 0).astype(np.int64), starts.astype(np.int64)
        size = np.diff(np.append(starts, len(text) - 1)) - 1
        half = size // 2
        ids = np.arange(len(words))
        # The exact half is grown towards its delimiter, then the interval turns and grows the other way.
        if side == "first":
            inward, outward, at, until, step = self.forward, self.backward, starts + half, starts, 1
        else:
            inward, outward, at, until, step = self.backward, self.forward, starts + half + 1, starts + size + 1, -1
        exact = Intervals(np.zeros(len(words), np.int64), np.zeros(len(words), np.int64), np.full(len(words), self.n))
        place, moving = at.copy(), ids
        while len(moving):
            grown = exact.take(moving).grown(inward, text[place[moving]])
            exact.near[moving], exact.far[moving], exact.size[moving] = grown.near, grown.far, grown.size
            moving = moving[place[moving] != until[moving]]
            place[moving] -= step
        exact, place = exact.turned(), at + step if side == "first" else at - 1
        end = starts + size + 1 if side == "first" else starts
        #: Branches that have spent their error: word, place of the next letter, interval.
        b_id, b_place, branch = np.zeros(0, np.int64), np.zeros(0, np.int64), exact.take(np.zeros(0, np.int64))
        hits_word, hits_at = [], []
        while True:
            live = exact.size > (1 if own else 0)  # of its own block, an interval of one holds the word itself
            ids, place, exact = ids[live], place[live], exact.take(live)
            if not len(ids) and not len(b_id):
                break
            last = place == end[ids]
            i, c, more = exact.grown_by_all(outward)
            swap = (c != text[place[i]]) & ~last[i]
            skip = np.flatnonzero(~last)
            parts = [(b_id, b_place, branch), (ids[i], place[i], more), (ids[i[swap]], place[i[swap]] + step, more.take(swap)), (ids[skip], place[skip] + step, exact.take(skip))]
            b_id, b_place = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
            branch = Intervals(*[np.concatenate([getattr(p[2], k) for p in parts]) for k in ("near", "far", "size")])
            # All branches take their next letter; those that took the delimiter have found a word.
            done = b_place == end[b_id]
            branch = branch.grown(outward, text[b_place])
            there = branch.size > 0
            whole = done & there
            hits_word.append(b_id[whole])
            hits_at.append((branch.far if side == "first" else branch.near)[whole])
            on = there & ~done
            b_id, b_place, branch = b_id[on], b_place[on] + step, branch.take(on)
            going = ~last
            exact = exact.take(going).grown(outward, text[place[going]])
            ids, place = ids[going], place[going] + step
        word = np.concatenate(hits_word) if hits_word else np.zeros(0, np.int64)
        ranks = np.concatenate(hits_at) if hits_at else word
        return word + offset, np.searchsorted(self.starts, self.forward.order[ranks])


def _block_pairs(key: tuple, rows: pa.Table) -> pa.Table:
    side, part, other = key[0].as_py(), key[2].as_py(), key[3].as_py()
    own = part == other
    text = rows if own else rows.filter(pc.equal(rows.column("role"), "text"))
    pattern = rows if own else rows.filter(pc.equal(rows.column("role"), "pattern"))
    indexed, sought = text.column("word").to_pylist(), pattern.column("word").to_pylist()
    if not indexed or not sought:
        mine = found = np.zeros(0, np.int64)
    else:
        mine, found = Index(indexed).near(sought, side, own)
    word, near = pattern.column("word").take(pa.array(mine)), text.column("word").take(pa.array(found))
    if side == "second":  # what has the first half in common was found from that side
        new = [w != v and not v.startswith(w[: len(w) // 2]) for w, v in zip(word.to_pylist(), near.to_pylist())]
    else:
        new = [w != v for w, v in zip(word.to_pylist(), near.to_pylist())]
    return pa.table({"word": word, "near": near, "near_n": text.column("n").take(pa.array(found))}).filter(pa.array(new, pa.bool_()))


def near_words(vocabulary: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``word, near, near_n``: all pairs of words of a stored ``word, n`` table that differ by one letter, both ways round."""
    prepare(vocabulary.sparkSession)
    ends = F.array(*[F.struct(F.lit(s).alias("side"), F.substring("word", at, 2).alias("ends")) for s, at in (("first", 1), ("second", -2))])
    sided = vocabulary.select("word", "n", F.inline(ends))
    sums = sided.groupBy("side", "ends").agg(F.sum(F.length("word") + 1).alias("chars"))
    # At most 2 x 90 x 90 rows.
    in_side = Window.partitionBy("side")
    spread = 4 * vocabulary.sparkSession.sparkContext.defaultParallelism
    room = F.greatest(F.lit(LEAST_CHARS), F.least(F.lit(block_chars), F.sum("chars").over(in_side) / spread))
    before = F.sum("chars").over(in_side.orderBy("ends")) - F.col("chars")
    bins = sums.withColumn("room", room).withColumn("parts", F.ceil(F.col("chars") / F.col("room")).cast("int"))
    alone = F.col("parts") > 1
    bins = bins.select("side", "ends", "parts", F.when(alone, F.col("ends")).otherwise((before / F.col("room")).cast("long").cast("string")).alias("bin"))
    placed = sided.join(F.broadcast(bins), ["side", "ends"]).withColumn("part", F.pmod(F.xxhash64("word"), F.col("parts")).cast("int"))
    meet = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    roles = F.when(F.col("part") == F.col("other"), F.array(F.struct(F.lit("both").alias("role"), F.col("part").alias("p"), F.col("part").alias("o"))))
    roles = roles.otherwise(F.array(F.struct(F.lit("pattern").alias("role"), F.col("part").alias("p"), F.col("other").alias("o")), F.struct(F.lit("text").alias("role"), F.col("other").alias("p"), F.col("part").alias("o"))))
    meet = meet.select("side", "bin", "word", "n", F.inline(roles))
    return meet.groupBy("side", "bin", "p", "o").applyInArrow(_block_pairs, "word string, near string, near_n long")


def with_roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of a stored ``word, form`` table (only words that have a form; no circles), by pointer doubling."""
    ends = forms.select("word", F.col("form").alias("root"))
    while True:
        step = ends.select(F.col("word").alias("root"), F.col("root").alias("next"))
        ends = materialise(ends.join(step, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if not ends.where("moved").limit(1).count():
            return ends.select("word", "root")
        ends = ends.drop("moved")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_letters: int = 5, min_count: int = 3, ratio: int = 2, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of the corpus."""
    words = materialise(count_words(docs, id_col, text_col, min_letters, min_count), "words")
    near = near_words(words, block_chars).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus_n"), "near")).alias("best"))
    found = words.join(near, "word", "left")
    takes = -F.col("best.minus_n") >= ratio * F.col("n")
    found = found.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(takes, F.col("best.near")).alias("form"), F.when(takes, -F.col("best.minus_n")).alias("form_n"))
    found = materialise(found, "forms")
    roots = with_roots(found.where("form is not null").select("word", "form"))
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.col("n_near").cast("long").alias("n_near"), "form_n")


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))
