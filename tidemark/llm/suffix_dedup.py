"""Repeated passages by sparse suffix arrays.

*Sparse suffixes.* In every window of ``min_words`` words the word k-gram with the least hash is a minimiser. Only the
suffixes that begin at minimisers are kept. The choice depends on the window's words alone, so a window that occurs
twice has its minimiser at the same place in both occurrences. A kept suffix carries the codes of the words after it
and, reversed, of those before it: as many as the windows reach that it is the minimiser of.

*Sort and compare.* Spark range-partitions and sorts the suffixes by content (hash of the k-gram, words after it, words
before it, document). Neighbouring rows give longest common prefixes to the right; sorting the same rows by the words
before them gives those to the left. Two occurrences share a window that begins j words before the minimiser exactly
if they lie in one interval of common prefixes of ``min_words - j`` words on the right and of j words on the left. So
the rows of an interval on both sides form a class, a class with two documents is a match, and its rows extend by the
longest such windows on either side. Classes stand in for pairs: nothing is lost however many rows share a passage.

*Borders and crowds.* The first and last k-gram of a partition can go on in the next one, and a k-gram of more than
``HELD`` rows isn't held in memory. Of their classes of equal contexts the two least documents go on with the context. Of
sorted rows, the neighbours have the longest common prefixes: in the first order they bound what a class shares to the right,
in an order of the classes by the words before, to the left (where a neighbour stands elsewhere, nothing is bounded). Windows
within both bounds, few of which occur once, are hashed to 64 bits and aggregated by hash, and what that gives returns by a
salted join.

*Spans.* All rows with equal contexts have the same extension. A class of them goes on as one row with its documents, texts and
places, wherever its match was found; one step then gives the spans, one per place.

Words are lower-cased (A-Z) and stand between white space; they are compared by CRC32. Two different windows can only
be taken for the same if all differing words collide in 32 bits at once, or in the hash of a k-gram, class or window.

Nulls, ties, odd inputs: a null text or one of fewer than ``min_words`` words has no passages. Very long texts are read
whole. Repeats inside one document alone don't count. Rows with equal ids are one document, so a passage that only they
have isn't repeated; each of their different texts has spans of its own, rows that repeat id and text count once. Rows with
a null id are skipped. Ids may have any type that Spark can order; of several other documents with a window of a passage
the least is named, whatever the partitions. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tidemark.llm.common import UPPER, materialise, prepare, table

K = 8
HELD = 1 << 16
CHUNK = 1 << 13
SALT = 16
LOWER = bytes.maketrans(UPPER.encode(), UPPER.lower().encode())
COLUMNS = ["id", "text_tag", "gram", "suffix", "before", "places"]


# ---- sparse suffixes -------------------------------------------------------------------------------


def kgram_hashes(codes: np.ndarray, k: int) -> np.ndarray:
    n = len(codes) - k + 1
    h = np.zeros(n, np.uint64)
    for j in range(k):
        h = h * np.uint64(0x9E3779B97F4A7C15) + codes[j : j + n]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ h >> np.uint64(32)


def minimisers(h: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions of the least hash in every window, and for each the first and last window that it is the least of."""
    views = np.lib.stride_tricks.sliding_window_view(h, window)
    at, first, count = np.unique(views.argmin(axis=1) + np.arange(len(views)), return_index=True, return_counts=True)
    return at, first, first + count - 1


def slices(codes: np.ndarray, start: np.ndarray, size: np.ndarray, step: int) -> pa.Array:
    """Of each start the bytes of ``size`` codes, going by ``step``."""
    ends = np.cumsum(size)
    within = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - size, size)
    data = codes[np.repeat(start, size) + step * within].astype(">u4")
    return pa.BinaryArray.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(np.concatenate(([0], 4 * ends)).astype(np.int32)), pa.py_buffer(data)])


def document_rows(text: str | None, min_words: int) -> Iterator[list[pa.Array]]:
    """``gram, suffix, before, places`` of a document's kept suffixes; equal ones of a chunk are one row."""
    words = (text or "").encode().translate(LOWER).split()
    if len(words) < min_words:
        return
    codes = np.maximum(np.fromiter(map(crc32, words), np.uint64, len(words)), np.uint64(1))
    h = kgram_hashes(codes, K)
    at, first, last = minimisers(h, min_words - K + 1)
    for k in range(0, len(at), 4096):
        p, a, b = at[k : k + 4096], first[k : k + 4096], last[k : k + 4096]
        gram, suffix, before = h[p].view(np.int64), slices(codes, p + K, b + min_words - p - K, 1), slices(codes, p - 1, p - a, -1)
        places = p.astype(np.int32)
        order, sizes = np.arange(len(p)), np.ones(len(p), np.int64)
        if len(np.unique(gram)) < len(gram):
            groups: dict[tuple, list[int]] = {}
            for i, key in enumerate(zip(gram.tolist(), suffix.to_pylist(), before.to_pylist())):
                groups.setdefault(key, []).append(i)
            order = np.array([g[0] for g in groups.values()])
            sizes = np.array([len(g) for g in groups.values()])
            places = places[np.concatenate([np.array(g) for g in groups.values()])]
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)), pa.array(places))
        yield [pa.array(gram[order]), suffix.take(pa.array(order)), before.take(pa.array(order)), lists]


def sparse_suffixes(docs: DataFrame, id_col: str, text_col: str, min_words: int) -> DataFrame:
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, text in enumerate(batch.column("text").to_pylist()):
                for columns in document_rows(text, min_words):
                    at = pa.array(np.full(len(columns[0]), i))
                    yield pa.RecordBatch.from_arrays([batch.column("id").take(at), batch.column("text_tag").take(at), *columns], COLUMNS)

    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("text_tag"))
    return rows.mapInArrow(run, row_type(dict(docs.dtypes)[id_col]))


def row_type(id_type: str) -> str:
    return f"id {id_type}, text_tag long, gram long, suffix binary, before binary, places array<int>"


# ---- sorted rows -----------------------------------------------------------------------------------


def matrix(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of each row, padded with 0, and their numbers."""
    column = column.cast(pa.large_binary())
    _, starts, data = column.buffers()
    offsets = np.frombuffer(starts, np.int64)[column.offset : column.offset + len(column) + 1]
    codes = np.frombuffer(data, ">u4", count=(offsets[-1] - offsets[0]) // 4, offset=offsets[0]) if offsets[-1] > offsets[0] else np.zeros(0, ">u4")
    lengths = np.diff(offsets) // 4
    out = np.zeros((len(column), width), ">u4")
    out[np.arange(width) < lengths[:, None]] = codes
    return out, lengths


def common_with_previous(rows: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Length of the common beginning of each row and the one before it (0 for the first)."""
    out = np.zeros(len(rows), np.int64)
    if rows.shape[1] and len(rows) > 1:
        differ = rows[1:] != rows[:-1]
        first = differ.argmax(axis=1)
        same = np.where(differ[np.arange(len(differ)), first], first, rows.shape[1])
        out[1:] = np.minimum(same, np.minimum(lengths[1:], lengths[:-1]))
    return out


def longest_shared(rows: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Length of the longest beginning that each of sorted rows shares with any other row, here or before or behind them.

    That is one with a neighbour; the neighbours of the first and last row may stand elsewhere, so for these it's their length.
    """
    shared = np.r_[common_with_previous(rows, lengths), 0]
    out = np.maximum(shared[:-1], shared[1:])
    out[[0, -1]] = lengths[[0, -1]]
    return out


def matches(gram: np.ndarray, suffix: tuple, before: tuple, owner: np.ndarray, min_words: int) -> tuple[np.ndarray, ...]:
    """Of each row of sorted, complete k-grams: words of its matches to the left and right, and the least other owner (or -1).

    ``owner`` ranks the documents. Every level j is the window that begins j words before the minimiser.
    """
    (after, n_after), (back, n_back) = suffix, before
    size = len(gram)
    left, right = np.zeros(size, np.int64), np.zeros(size, np.int64)
    new_gram = np.ones(size, bool)
    new_gram[1:] = gram[1:] != gram[:-1]
    shared = np.where(new_gram, 0, K + common_with_previous(after, n_after))
    by_left = np.argsort(np.ascontiguousarray(back).view(np.dtype((np.void, back.shape[1] * 4))).ravel(), kind="stable")
    shared_left = common_with_previous(back[by_left], n_back[by_left])
    owners = int(owner.max(initial=0)) + 1
    other = np.full(size, owners, np.int64)
    left_class = np.empty(size, np.int64)
    for j in range(min_words - K + 1):
        at = np.flatnonzero((n_back >= j) & (n_after + K >= min_words - j))
        if not len(at):
            continue
        left_class[by_left] = np.cumsum(shared_left < j)
        key = (np.cumsum(shared < min_words - j) * (size + 1) + left_class)[at] * owners + owner[at]
        order = np.argsort(key)
        at, key = at[order], key[order]
        one = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])  # each document of a class once, the least first
        key = key // owners
        begins = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        counts = np.diff(np.r_[begins, len(key)])
        heads = np.searchsorted(one, begins)
        hit = np.diff(np.r_[heads, len(one)]) > 1
        low, next_low = owner[at[begins[hit]]], owner[at[one[heads[hit] + 1]]]
        rows = at[np.repeat(hit, counts)]
        left[rows] = j
        right[rows] = np.maximum(right[rows], min_words - j)
        low, next_low = np.repeat(low, counts[hit]), np.repeat(next_low, counts[hit])
        other[rows] = np.minimum(other[rows], np.where(low == owner[rows], next_low, low))
    other[right == 0] = -1
    return left, right, other


def ranks(ids: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Rank of each id, and the distinct ids in order."""
    coded = ids.dictionary_encode()
    values = coded.dictionary.to_pylist()
    order = np.array(sorted(range(len(values)), key=values.__getitem__), np.int64)
    rank = np.empty(len(values), np.int64)
    rank[order] = np.arange(len(values))
    return rank[coded.indices.to_numpy()], coded.dictionary.take(pa.array(order))


FOUND = ["left", "right", "a", "b", *COLUMNS, "cls", "ids", "tags"]


def found_type(id_type: str) -> str:
    return f"left int, right int, a {id_type}, b {id_type}, {row_type(id_type)}, cls long, ids array<{id_type}>, tags array<long>"


def local_matches(rows: pa.Table, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array, np.ndarray]:
    """Of the rows of some k-grams, each standing together: extension to the left and right, the other document's rank (or -1), documents by rank, and ranks."""
    gram, get = rows.column("gram").to_numpy(), lambda c: rows.column(c).chunk(0)
    owner, names = ranks(get("id"))
    width = min_words - K
    return (*matches(gram, matrix(get("suffix"), width), matrix(get("before"), width), owner, min_words), names, owner)


def gathered(rows: pa.Table, order: np.ndarray, begins: np.ndarray) -> tuple[list[pa.Array], list[pa.Array]]:
    """Of classes, whose rows stand together in ``order``: the columns of rows with nothing but places, and lists of documents and texts, place by place."""
    lists = rows.column("places").chunk(0).take(pa.array(order))
    counts = lists.value_lengths().to_numpy()
    row = pa.array(np.repeat(order, counts))
    ends = pa.array(np.r_[0, np.cumsum(counts)][np.r_[begins, len(order)]].astype(np.int32))
    places, ids, tags = lists.flatten(), *(rows.column(c).chunk(0).take(row) for c in COLUMNS[:2])
    nothing = [pa.nulls(len(begins), rows.schema.field(c).type) for c in COLUMNS[:-1]]
    return [*nothing, pa.ListArray.from_arrays(ends, places)], [pa.ListArray.from_arrays(ends, ids), pa.ListArray.from_arrays(ends, tags)]


def marked(rows: pa.Table, left: np.ndarray, right: np.ndarray, other: np.ndarray, names: pa.Array) -> pa.RecordBatch:
    """The classes of equal contexts that have a match: one row each, with what :func:`class_spans` needs.

    Equal contexts have the same extension and stand next to each other. Of a class all rows name the least document of its
    windows but that document's own, which name the next one: ``a`` and ``b`` are the least and the greatest of the names.
    """
    hit = np.flatnonzero(other >= 0)
    new = np.arange(len(hit)) == 0
    for c in COLUMNS[2:5]:
        values = rows.column(c).chunk(0).take(pa.array(hit))
        new[1:] |= pc.not_equal(values[1:], values[:-1]).to_numpy(zero_copy_only=False)
    begins = np.flatnonzero(new)
    own, whose = gathered(rows, hit, begins)
    reach = [pa.array(x[hit[begins]].astype(np.int32)) for x in (left, right)]
    of = [names.take(pa.array(f.reduceat(other[hit], begins) if len(begins) else begins)) for f in (np.minimum, np.maximum)]
    return pa.RecordBatch.from_arrays([*reach, *of, *own, pa.nulls(len(begins), pa.int64()), *whose], FOUND)


def spans_of(parts: list[pa.RecordBatch], min_words: int) -> Iterator[pa.RecordBatch]:
    """Matched classes of complete k-grams."""
    rows = pa.Table.from_batches(parts)
    gram = rows.column("gram").to_numpy()
    codes = rows.column("id").combine_chunks().dictionary_encode().indices.to_numpy()
    begins = np.flatnonzero(np.r_[True, gram[1:] != gram[:-1]])
    several = np.minimum.reduceat(codes, begins) < np.maximum.reduceat(codes, begins)
    keep = np.flatnonzero(np.repeat(several, np.diff(np.r_[begins, len(gram)])))
    if len(keep):
        rows = rows.take(pa.array(keep)).combine_chunks()
        left, right, other, names, _ = local_matches(rows, min_words)
        yield marked(rows, left, right, other, names)


def open_rows(parts: list[pa.RecordBatch], min_words: int) -> Iterator[pa.RecordBatch]:
    """The classes of equal contexts of a k-gram that has more rows elsewhere.

    A class is one row with the documents, texts and places of its rows, and up to two rows with its context, of its least
    documents. ``right`` of these is the number of words from the minimiser on that they can share with other rows.
    """
    rows = pa.Table.from_batches(parts).combine_chunks()
    if not rows.num_rows:
        return
    column = {c: rows.column(c).chunk(0) for c in COLUMNS}
    owner, _ = ranks(column["id"])
    keys = zip(column["gram"].to_pylist(), column["suffix"].to_pylist(), column["before"].to_pylist())
    cls = np.array([xxh64_intdigest(g.to_bytes(8, "little", signed=True) + len(b).to_bytes(4, "little") + b + s) for g, s, b in keys], np.uint64).view(np.int64)
    order = np.lexsort((owner, cls))
    one_class = np.r_[True, cls[order][1:] != cls[order][:-1]]
    once = order[one_class | np.r_[True, owner[order][1:] != owner[order][:-1]]]  # a row of each document of each class
    heads = once[np.arange(len(once)) - np.searchsorted(cls[once], cls[once]) < 2]
    right = (K + longest_shared(*matrix(column["suffix"], min_words - K))).astype(np.int32)
    begins, ids = np.flatnonzero(one_class), rows.schema.field("id").type
    nothing = lambda n, *types: [pa.nulls(n, t) for t in types]
    n, m = len(heads), len(begins)
    whole = [column[c].take(pa.array(heads)) for c in COLUMNS[:-1]]
    yield pa.RecordBatch.from_arrays([*nothing(n, pa.int32()), pa.array(right[heads]), *nothing(n, ids, ids), *whole, *nothing(n, rows.schema.field("places").type), pa.array(cls[heads]), *nothing(n, pa.list_(ids), pa.list_(pa.int64()))], FOUND)
    own, whose = gathered(rows, order, begins)
    yield pa.RecordBatch.from_arrays([*nothing(m, pa.int32(), pa.int32(), ids, ids), *own, pa.array(cls[order[begins]]), *whose], FOUND)


def compare_sorted(min_words: int, held: int):
    """Over a sorted partition: matched classes of its k-grams, and of its first and last k-gram and crowded ones what :func:`open_rows` leaves open."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        tail: list[pa.RecordBatch] = []  # of the k-gram that may go on
        tail_gram, goes_on_elsewhere = None, True  # the first k-gram can have begun in another partition
        for batch in batches:
            if not batch.num_rows:
                continue
            gram = batch.column("gram").to_numpy()
            begins = np.flatnonzero(np.r_[True, gram[1:] != gram[:-1]]).tolist()
            cuts = sorted({0, *begins[1:2], begins[-1], len(gram)})  # its first k-gram, those between, its last one
            for a, b in zip(cuts[:-1], cuts[1:]):
                if tail_gram is not None and gram[a] != tail_gram:  # the one before is complete
                    if goes_on_elsewhere:
                        yield from open_rows(tail, min_words)
                    else:
                        waiting += tail
                    tail, goes_on_elsewhere = [], False
                tail_gram = gram[b - 1]
                tail.append(batch.slice(a, b - a))
            if sum(p.num_rows for p in tail) > held:
                yield from open_rows(tail, min_words)
                tail, goes_on_elsewhere = [batch.slice(0, 0)], True
            if sum(p.num_rows for p in waiting) >= CHUNK:
                yield from spans_of(waiting, min_words)
                waiting = []
        if waiting:
            yield from spans_of(waiting, min_words)
        if tail:
            yield from open_rows(tail, min_words)

    return run


# ---- borders and crowds ----------------------------------------------------------------------------


def window_hashes(min_words: int):
    """``cls, j, h, lo, next_lo`` of the windows of classes of equal contexts, sorted by the words before.

    A class of one document has only those that another class can share, by ``right`` and the neighbours in a batch.
    """
    width = min_words - K
    draw = np.random.default_rng(11).integers(1, 1 << 63, (2, width + 1), np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            (after, n_after), (back, n_back) = matrix(batch.column("suffix"), width), matrix(batch.column("before"), width)
            sums = [np.cumsum(np.hstack([np.zeros((len(m), 1), np.uint64), m.astype(np.uint64) * d[:-1]]), axis=1, dtype=np.uint64) for m, d in ((after, draw[0]), (back, draw[1]))]
            gram, right = batch.column("gram").to_numpy().view(np.uint64), batch.column("right").to_numpy()
            one_document = batch.column("next_lo").is_null().to_numpy(zero_copy_only=False)
            left, right = np.where(one_document, longest_shared(back, n_back), n_back), np.where(one_document, right, n_after + K)
            for j in range(width + 1):
                at = np.flatnonzero((left >= j) & (right >= min_words - j))
                if not len(at):
                    continue
                h = (gram[at] + np.uint64(j)) * draw[0, -1] + sums[0][at, width - j] * draw[1, -1] + sums[1][at, j]
                h ^= h >> np.uint64(31)
                h *= np.uint64(0x94D049BB133111EB)
                h ^= h >> np.uint64(29)
                pick = pa.array(at)
                yield pa.RecordBatch.from_arrays([batch.column("cls").take(pick), pa.array(np.full(len(at), j, np.int32)), pa.array(h.view(np.int64)), batch.column("lo").take(pick), batch.column("next_lo").take(pick)], ["cls", "j", "h", "lo", "next_lo"])

    return run


MATCHED = ["ids", "tags", "places", "left", "right", "a", "b"]


def matched_across(rows: DataFrame, id_type: str, min_words: int) -> DataFrame:
    """The matched ones of the classes of :func:`open_rows`, by hashes of their windows."""
    # A partition leaves at most two documents of a class for each ``HELD`` of its rows.
    docs = F.array_sort(F.collect_set("id"))
    classes = rows.where(F.col("gram").isNotNull()).groupBy("cls", "gram", "suffix", "before").agg(F.max("right").alias("right"), docs.alias("ids"))
    classes = classes.select("cls", "gram", "suffix", "before", "right", F.get("ids", F.lit(0)).alias("lo"), F.get("ids", F.lit(1)).alias("next_lo"))
    order = ("gram", "before", "suffix")
    classes = classes.repartitionByRange(*order).sortWithinPartitions(*order)
    windows = materialise(classes.mapInArrow(window_hashes(min_words), f"cls long, j int, h long, lo {id_type}, next_lo {id_type}"), "suffix-windows")
    salts = F.explode(F.array(*map(F.lit, range(SALT)))).alias("salt")
    salted = windows.withColumn("salt", F.pmod("cls", F.lit(SALT)).cast("int"))
    first = windows.groupBy("h").agg(F.min("lo").alias("first"), F.max(F.coalesce("next_lo", "lo")).alias("some")).where("first < some").select("h", "first", salts)
    # The least document of a window that isn't its first.
    seconds = salted.join(first, ["h", "salt"]).groupBy("h", "first").agg(F.min(F.when(F.col("lo") > F.col("first"), F.col("lo")).otherwise(F.col("next_lo"))).alias("second")).select("h", "first", "second", salts)
    matched = salted.join(seconds, ["h", "salt"]).groupBy("cls").agg(F.max("j").alias("left"), F.min("j").alias("least"), F.collect_list(F.struct("first", "second")).alias("docs"))  # of at most ``min_words`` windows
    least = F.array_min(F.transform("docs", lambda d: d["first"]))
    matched = matched.select("cls", "left", (F.lit(min_words) - F.col("least")).alias("right"), "docs", least.alias("a"))
    others = F.transform("docs", lambda d: F.when(d["first"] > F.col("a"), d["first"]).otherwise(d["second"]))
    spread = matched.select("cls", "left", "right", "a", F.array_min(others).alias("b"), salts)
    members = rows.where(F.col("ids").isNotNull()).select("cls", "ids", "tags", "places", F.pmod(F.xxhash64(F.col("ids")[0]), F.lit(SALT)).cast("int").alias("salt"))
    return members.join(spread, ["cls", "salt"]).select(*MATCHED)


def class_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The spans of the members of classes, each with the least document that isn't its own."""
    for batch in batches:
        lists = batch.column("ids")
        row = pa.array(np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy()))
        ids, place = lists.flatten(), batch.column("places").flatten()
        of = {c: batch.column(c).take(row) for c in ("left", "right", "a", "b")}
        other = pc.if_else(pc.equal(ids, of["a"]), of["b"], of["a"])
        yield pa.RecordBatch.from_arrays([ids, batch.column("tags").flatten(), pc.subtract(place, of["left"]), pc.add(place, of["right"]), other], ["id", "text_tag", "start", "stop", "other"])


# ---- the operator ----------------------------------------------------------------------------------


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 50, held: int = HELD) -> DataFrame:
    """``id_col, first_word, end_word, n_words, other_id``: the passages (word positions) that another document has too.

    ``other_id`` is the least other document with a window of the passage.
    """
    if min_words < 2 * K:
        raise ValueError(f"min_words must be at least {2 * K}")
    id_type, order = dict(docs.dtypes)[id_col], ("gram", "suffix", "before", "id")
    rows = sparse_suffixes(docs, id_col, text_col, min_words).repartitionByRange(*order).sortWithinPartitions(*order)
    found = materialise(rows.mapInArrow(compare_sorted(min_words, held), found_type(id_type)), "suffix-spans")
    across = matched_across(found.where("left is null").drop("left", "a", "b"), id_type, min_words)
    classes = found.where("left is not null").select(*MATCHED).unionByName(across)
    spans = classes.mapInArrow(class_spans, f"id {id_type}, text_tag long, start int, stop int, other {id_type}")

    by_doc = Window.partitionBy("id", "text_tag").orderBy("start", "stop")
    reach = F.max("stop").over(by_doc.rowsBetween(Window.unboundedPreceding, -1))
    islands = spans.withColumn("new", F.when(F.col("start") <= reach, 0).otherwise(1)).withColumn("island", F.sum("new").over(by_doc.rowsBetween(Window.unboundedPreceding, 0)))
    merged = islands.groupBy("id", "text_tag", "island").agg(F.min("start").alias("first_word"), F.max("stop").alias("end_word"), F.min("other").alias("other_id"))
    return merged.select(F.col("id").alias(id_col), "first_word", "end_word", (F.col("end_word") - F.col("first_word")).alias("n_words"), "other_id")


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"))
