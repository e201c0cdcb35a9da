"""How far the sources of a language differ in their words, by chunk factorization.

*Chunks, not words, are counted per document.* Every task gathers its texts into blocks of some 16 MB and counts the
chunks between ASCII white space of each document; a block stores its distinct chunks once, and per document the numbers
and counts of its chunks. No term spans white space, so nothing is lost.

*Each distinct chunk is tokenized once.* The chunks of all blocks are sorted into their places, so that equal ones are
neighbours: the first is tokenized, the others take over its terms, and all go back to the chunk numbers of their block.
However frequent a chunk is, a block has it once, so no key is hot. A block then turns its documents' chunk counts into term
counts: distinct documents by language, occurrences by language and source.

*Divergence.* Shares are integers (parts per thousand million), so results are exact. Pairs of sources are compared by tiles
of 256 sources and blocks of about 1,024 terms: a task holds one small matrix, and sums of tiles add up.

Nulls and ties: null text, language and source count as empty; every row is a document of its own, repeated or not; texts
are read whole, a very long one in a block of its own; equal values rank by item. Other columns are ignored. An empty table
gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import discard, materialise, prepare, table

#: Runs of the bytes of a lower-cased text that no term has (line ends divide chunks here).
OTHERS = re.compile(rb"[\x00-\x09\x0B-\x60\x7B-\x7F]+")
BLOCK_BYTES = 16 << 20
#: Rows and bytes of sorted chunks that are tokenized at a time.
SORTED_ROWS, SORTED_BYTES = 1 << 16, 16 << 20
#: Sources of a tile, and terms (on average) of a block, of the pairwise comparison.
TILE, TERMS = 256, 1024

BLOCKS = "block long, chunks array<string>, langs array<string>, sources array<string>, doc_group binary, doc_size binary, codes binary, counts binary"


def _packed(numbers: np.ndarray) -> bytes:
    """32-bit numbers by planes of their bytes: the upper ones are mostly zero and compress away."""
    return numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


class _Block:
    """Documents of a task until they fill a block."""

    def __init__(self) -> None:
        self.size = 0
        self.known: dict[bytes, int] = defaultdict(count().__next__)
        self.groups: dict[tuple[str, str], int] = defaultdict(count().__next__)
        self.doc_group, self.doc_size, self.codes, self.counts = [], [], [], []

    def add(self, lang: str, source: str, text: bytes) -> None:
        chunks = Counter(text.split())  # bytes split at ASCII white space only
        self.size += len(text) + 64
        self.doc_group.append(self.groups[lang, source])
        self.doc_size.append(len(chunks))
        self.codes.append(np.fromiter(map(self.known.__getitem__, chunks), "<u4", len(chunks)))
        self.counts.append(np.fromiter(chunks.values(), "<u4", len(chunks)))

    def row(self, number: int) -> pa.RecordBatch:
        chunks = pa.array(list(self.known), pa.binary()).cast(pa.string())
        one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
        langs, sources = (pa.array([g[i] for g in self.groups], pa.string()) for i in (0, 1))
        raw = [np.array(self.doc_group, "<u4"), np.array(self.doc_size, "<u4"), np.concatenate(self.codes), np.concatenate(self.counts)]
        columns = [pa.array([number], pa.int64()), one(chunks), one(langs), one(sources), *[pa.array([_packed(r)], pa.binary()) for r in raw]]
        return pa.RecordBatch.from_arrays(columns, ["block", "chunks", "langs", "sources", "doc_group", "doc_size", "codes", "counts"])


def chunk_blocks(docs: DataFrame, text_col: str, lang_col: str, source_col: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per block of documents: its distinct chunks, and per document the numbers and counts of its chunks."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, block = TaskContext.get().partitionId() << 32, _Block()
        for batch in batches:
            texts = batch.column(2).cast(pa.binary())
            for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts):
                block.add(lang, source, text.as_py())
                if block.size >= block_bytes:
                    yield block.row(number)
                    number, block = number + 1, _Block()
        if block.doc_size:
            yield block.row(number)

    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for c, a in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    return rows.mapInArrow(run, BLOCKS)


def _gathered(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The positions of ranges one behind the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)


def _block_terms(blocks: pa.Table, found: pa.Table) -> pa.Table:
    """``lang, term, docs, sources`` of a block, from its documents' chunk counts and its chunks' terms."""
    schema = pa.schema([("lang", pa.string()), ("term", pa.string()), ("docs", pa.int64()), ("sources", pa.list_(pa.struct([("source", pa.string()), ("n", pa.int64())])))])
    if not blocks.num_rows or not found.num_rows:
        return schema.empty_table()
    block = blocks.to_pylist()[0]
    doc_group, doc_size, codes, counts = (_unpacked(block[c]) for c in ("doc_group", "doc_size", "codes", "counts"))
    langs, lang_of = np.unique(np.array(block["langs"], object), return_inverse=True)

    lines = b"\n".join(found.column("terms").to_pylist())
    sizes = np.fromiter((line.count(b" ") for line in lines.split(b"\n")), np.int64) + 1
    words = pa.array(lines.replace(b"\n", b" ").split(b" "), pa.binary()).cast(pa.string()).dictionary_encode()
    term_of, n_terms = words.indices.to_numpy(), len(words.dictionary)
    first, size = (np.zeros(int(codes.max(initial=0)) + 1, np.int64) for _ in range(2))
    at = np.concatenate([_unpacked(c) for c in found.column("codes").to_pylist()])
    first[at], size[at] = np.cumsum(sizes) - sizes, sizes

    # every chunk of every document, written out as its terms; then each (document, term) once
    many = size[codes]
    term = term_of[_gathered(first[codes], many)]
    doc = np.repeat(np.repeat(np.arange(len(doc_size)), doc_size), many)
    pair, which = np.unique(doc * n_terms + term, return_inverse=True)
    n = np.bincount(which, np.repeat(counts, many)).astype(np.int64)
    group, term = doc_group[pair // n_terms], pair % n_terms

    key, which = np.unique((lang_of[group] * n_terms + term) * len(lang_of) + group, return_inverse=True)
    n = np.bincount(which, n).astype(np.int64)
    docs = np.bincount(which)
    rows, starts = np.unique(key // len(lang_of), return_index=True)
    ends = np.append(starts[1:], len(key))
    by_source = pa.StructArray.from_arrays([pa.array(block["sources"], pa.string()).take(pa.array(key % len(lang_of))), pa.array(n)], ["source", "n"])
    return pa.table(
        [
            pa.array(langs[rows // n_terms], pa.string()),
            words.dictionary.take(pa.array(rows % n_terms)),
            pa.array(np.add.reduceat(docs, starts)),
            pa.ListArray.from_arrays(pa.array(np.append(starts, ends[-1]), pa.int32()), by_source),
        ],
        schema=schema,
    )


def _tokenized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``block, codes, terms`` from chunks in order: the chunk numbers of a block, and a line of terms for each.

    Chunks without terms are left out. The last chunk is remembered, so that its run may go on in the next batch.
    """
    last, line = None, b""
    for rows in _gather(batches):
        chunks = rows.column("chunk").cast(pa.binary()).combine_chunks().dictionary_encode()
        distinct = chunks.dictionary.to_pylist()
        known = int(bool(distinct) and distinct[0] == last)
        if distinct[known:]:
            # Chunks hold no line ends; of the bytes of the others, those of terms stay and runs of the rest become a space.
            fresh = [x.strip() for x in OTHERS.sub(b" ", b"\n".join(distinct[known:]).lower()).split(b"\n")]
            lines = [line] * known + fresh
        else:
            lines = [line] * known
        last, line = distinct[-1], lines[-1]
        which, blocks, codes = chunks.indices.to_numpy(), rows.column("block").to_numpy(), rows.column("code").to_numpy()
        some = np.fromiter(map(bool, lines), bool)[which]
        order = np.flatnonzero(some)[np.argsort(blocks[some], kind="stable")]
        named, starts = np.unique(blocks[order], return_index=True)
        parts = np.split(order, starts[1:]) if len(named) else []
        texts = [b"\n".join([lines[i] for i in which[p].tolist()]) for p in parts]
        yield pa.RecordBatch.from_arrays([pa.array(named, pa.int64()), pa.array([_packed(codes[p]) for p in parts], pa.binary()), pa.array(texts, pa.binary())], ["of_block", "codes", "terms"])


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held, rows, size = [], 0, 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            rows, size = rows + batch.num_rows, size + batch.nbytes
        if rows >= SORTED_ROWS or size >= SORTED_BYTES:
            yield pa.Table.from_batches(held)
            held, rows, size = [], 0, 0
    if held:
        yield pa.Table.from_batches(held)


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``lang, term, docs, sources`` by block of documents (stored): ``docs`` and the ``n`` in ``sources`` add up over rows."""
    blocks = materialise(chunk_blocks(docs, text_col, lang_col, source_col, block_bytes), "chunk-blocks", "zstd")
    chunks = blocks.select("block", F.posexplode("chunks").alias("code", "chunk")).repartition("chunk").sortWithinPartitions("chunk")
    found = chunks.mapInArrow(_tokenized, "of_block long, codes binary, terms binary")
    counts = blocks.drop("chunks").groupBy("block").cogroup(found.groupBy("of_block")).applyInArrow(_block_terms, "lang string, term string, docs long, sources array<struct<source:string,n:long>>")
    counts = materialise(counts, "term-counts", "zstd")
    discard(blocks)
    return counts


def share(n: Column | str, total: Column | str, terms: Column | str) -> Column:
    """1 + floor(10^9 (n + 5) / (total + 5 terms)) in whole numbers of 38 digits; null without terms."""
    n, total, terms = (F.col(c) if isinstance(c, str) else c for c in (n, total, terms))
    whole = lambda c: c.cast("decimal(19,0)")
    above, below = F.lit(10**9).cast("decimal(10,0)") * whole(n + 5), whole(total) + 5 * whole(terms)
    return F.when(terms > 0, F.call_function("div", above, below) + 1)


def _tile_distances(key: tuple, rows: pa.Table) -> pa.Table:
    """Sums of absolute differences of shares between the sources of two tiles, less what sources without terms would give."""
    lang, a_tile, b_tile, _ = (k.as_py() for k in key)
    idx, p = rows.column("idx").to_numpy().astype(np.int64), rows.column("p").to_numpy().astype(np.int64)
    term = rows.column("term").combine_chunks().dictionary_encode()
    bare = term.is_null().to_numpy(zero_copy_only=False)
    order = np.argsort(idx[bare])
    ids, base = idx[bare][order], p[bare][order]
    shares = np.tile(base, (len(term.dictionary), 1))
    where = term.indices.drop_null().to_numpy()
    shares[where, np.searchsorted(ids, idx[~bare])] = p[~bare]
    left, right = np.flatnonzero(ids // TILE == a_tile), np.flatnonzero(ids // TILE == b_tile)
    out = np.array([np.abs(shares[:, [i]] - shares[:, right]).sum(0) - len(shares) * np.abs(base[i] - base[right]) for i in left])
    a, b = (m.ravel() for m in np.meshgrid(ids[left], ids[right], indexing="ij"))
    part, other = out.ravel(), a != b
    a, b, part = a[other], b[other], part[other]
    if a_tile != b_tile:
        a, b, part = np.append(a, b), np.append(b, a), np.append(part, part)
    return pa.table({"lang": pa.array([lang] * len(a), pa.string()), "a": pa.array(a), "b": pa.array(b), "part": pa.array(part)})


def source_divergence(docs: DataFrame, min_docs: int = 30, top: int = 50, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``lang, source, part, item, value, rank``: distances to the language's other sources, and its overused terms.

    A language keeps the terms of at least ``min_docs`` of its documents. Part ``pair`` has the summed differences of shares
    to each other source, part ``term`` the ``top`` terms whose share lies most above the language's.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    found = term_counts(docs, text_col, lang_col, source_col, block_bytes)
    kept = found.groupBy("lang", "term").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs).drop("docs")
    tall = found.join(kept, ["lang", "term"], "left_semi").select("lang", "term", F.inline("sources"))
    counts = materialise(tall.groupBy("lang", "source", "term").agg(F.sum("n").alias("n")), "kept-counts")

    of_lang = counts.groupBy("lang", "term").agg(F.sum("n").alias("n_lang"))
    langs = of_lang.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("n_lang").alias("lang_total"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = docs.select(text(lang_col).alias("lang"), text(source_col).alias("source")).distinct()
    groups = groups.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0, ["total", "terms", "lang_total"])
    in_lang = Window.partitionBy("lang")
    groups = groups.withColumn("idx", F.row_number().over(in_lang.orderBy("source")) - 1).withColumn("n_sources", F.count(F.lit(1)).over(in_lang))
    groups = materialise(groups.withColumn("bare", share(F.lit(0), "total", "terms")), "groups")

    shares = counts.join(groups, ["lang", "source"]).withColumn("p", share("n", "total", "terms"))
    tiles = F.sequence(F.lit(0), ((F.col("n_sources") - 1) / TILE).cast("int"))
    blocks = F.ceil(F.col("terms") / TERMS).cast("int")
    own = (F.col("idx") / TILE).cast("int")
    placed = shares.select("lang", "idx", "term", "p", F.pmod(F.xxhash64("term"), blocks).cast("int").alias("salt"), own.alias("own"), F.explode(tiles).alias("other"))
    bare = groups.where("terms > 0").select("lang", "idx", "bare", "n_sources", "terms", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("salt"))
    bare = bare.select("lang", "idx", F.lit(None).cast("string").alias("term"), F.col("bare").alias("p"), "salt", own.alias("own"), F.explode(tiles).alias("other"))
    meet = placed.unionByName(bare).select("lang", F.least("own", "other").alias("a_tile"), F.greatest("own", "other").alias("b_tile"), "salt", "idx", "term", "p")
    parts = meet.groupBy("lang", "a_tile", "b_tile", "salt").applyInArrow(_tile_distances, "lang string, a long, b long, part long").groupBy("lang", "a", "b").agg(F.sum("part").alias("part"))

    others = groups.select("lang", F.col("source").alias("item"), F.col("idx").alias("b"), F.col("bare").alias("other_bare"))
    pairs = groups.select("lang", "source", F.col("idx").alias("a"), "bare", "terms").join(others, "lang").where("a <> b").join(parts, ["lang", "a", "b"], "left")
    value = F.coalesce(F.col("part"), F.lit(0)) + F.coalesce(F.col("terms") * F.abs(F.col("bare") - F.col("other_bare")), F.lit(0))
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", value.cast("long").alias("value")).withColumn("rank", F.row_number().over(ranked))

    overused = shares.join(of_lang, ["lang", "term"]).withColumn("value", F.col("p") - share("n_lang", "lang_total", "terms")).where("value > 0")
    terms = overused.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.col("value").cast("long").alias("value"))
    terms = terms.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top)
    return pairs.unionByName(terms)


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents"))


OP11_SQL = r"""
with d as (
  select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as terms
  from documents
), t as (select r, lang, source, unnest(terms) as term from d),
kept as (select lang, term from t group by 1, 2 having count(distinct r) >= 30),
counts as (select lang, source, term, count(*) as n from t join kept using (lang, term) group by 1, 2, 3),
langs as (select lang, count(*) as v from kept group by 1),
groups as (
  select lang, source, coalesce(v, 0) as v, coalesce(total, 0) as total
  from (select distinct lang, source from d) left join langs using (lang) left join (select lang, source, sum(n) as total from counts group by 1, 2) using (lang, source)
), full_p as (
  select g.lang, g.source, k.term, coalesce(c.n, 0) as n, 1 + (1000000000::hugeint * (coalesce(c.n, 0) + 5)) // (g.total + 5 * g.v)::hugeint as p
  from groups g join kept k using (lang) left join counts c on c.lang = g.lang and c.source = g.source and c.term = k.term
), lang_p as (
  select lang, term, 1 + (1000000000::hugeint * (n + 5)) // (total + 5 * v)::hugeint as q
  from (select lang, term, sum(n) as n from full_p group by 1, 2) join (select lang, sum(total) as total, any_value(v) as v from groups group by 1) using (lang)
), sums as (
  select a.lang, a.source, b.source as item, sum(abs(a.p - b.p)) as value from full_p a join full_p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by 1, 2, 3
), pairs as (
  select a.lang, a.source, 'pair' as part, b.source as item, cast(coalesce(value, 0) as bigint) as value
  from groups a join groups b on a.lang = b.lang and a.source <> b.source left join sums s on s.lang = a.lang and s.source = a.source and s.item = b.source
), terms as (select lang, source, 'term' as part, term as item, cast(p - q as bigint) as value from full_p join lang_p using (lang, term) where n > 0 and p > q)
select *, cast(row_number() over (partition by lang, source order by value desc, item) as int) as rank from pairs
union all
select * from (select *, cast(row_number() over (partition by lang, source order by value desc, item) as int) as rank from terms) where rank <= 50
"""
