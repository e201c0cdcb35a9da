"""WARC archives with a two-level capture index.

Writing: each task appends gzip members, one per record, to archive files of its own in the shared folder
and returns where every record lies; those rows are stored before anything reads the archives, so a retried
task only leaves an unreferenced file behind. Pages with equal payloads (at least ``least`` bytes) become
one ``response``, that of the smallest id, and ``revisit`` records that refer to it.

Index: lines "reversed-host key, page id, file, offset, length" are range-partitioned and sorted by Spark.
Every partition becomes a shard of compressed blocks with a sparse directory (the first key of each block) at
its end. A lookup finds the shard and the block by binary search, reads that byte range alone, finds the
lines in it by binary search again, and reads the records' byte ranges in the archives. Lookups are sorted
the same way, so a task stays within few shards.

File access goes through Arrow's file systems, by the URI of the shared folder.

Digests so frequent that their copies would fill a partition (a bounded number of them can be) join by broadcast, all
others by a shuffle.

Nulls, ties, odd inputs: a null payload counts as empty; a null url has an empty key; a page with a null id is always
a response; rows that repeat the smallest id of equal payloads are all responses. Ids may have any type that casts to
text and back. Tabs and line breaks of a URL are escaped in its key. Very long payloads are written whole. An empty
table gives an empty result; extra columns are ignored. A capture that the index doesn't find is an error.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from urllib.parse import quote, unquote, urlsplit

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import fresh_path, join_uneven, materialise, prepare, table

LEAST = 100
ARCHIVE_BYTES = 256 << 20
BLOCK_LINES = 512
DATE = "2024-01-01T00:00:00Z"
#: ``id`` is the page id as :func:`id_text` writes it.
LOCATED = "key string, id string, file string, offset long, length long"


def url_key(url: str | None) -> str:
    """The URL with its host reversed: ``com,example,www)/path?query``."""
    if not url:
        return ""
    try:
        parts = urlsplit(url.strip())
        host, port = parts.hostname or "", parts.port
    except ValueError:  # not a URL by the grammar
        return escaped(url)
    key = ",".join(reversed(host.split("."))) + (f":{port}" if port else "") + ")" + (parts.path or "/")
    return escaped(key + (f"?{parts.query}" if parts.query else ""))


def escaped(key: str) -> str:
    """The one form in which a key is sorted, stored and searched: an index line has no other tabs or line breaks."""
    return key.replace("\t", "%09").replace("\n", "%0A")


def id_text(page_id: str | None) -> str:
    """A page id (as text) in records and index lines."""
    return "-" if page_id is None else "=" + quote(page_id, safe="")


def page_name(text: str) -> str | None:
    return None if text == "-" else unquote(text[1:])


def open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


# ---- records ---------------------------------------------------------------------------------------


def record(page_id: str | None, url: str | None, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{id_text(page_id)}>", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {quote(url, safe=chr(37) + '!#$&()*+,/:;=?@[]~' + chr(39))}")
    lines.append(f"WARC-Payload-Digest: sha256:{digest}")
    if refers_to is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{id_text(refers_to)}>"]
        payload = b""
    lines += ["Content-Type: text/html", f"Content-Length: {len(payload)}", "", ""]
    return "\r\n".join(lines).encode() + payload + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and payload of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError(f"not a WARC record: {first[:40]!r}")
    fields = dict(line.split(": ", 1) for line in lines)
    payload, end = rest[: (n := int(fields["Content-Length"]))], rest[n:]
    if len(payload) != n or end != b"\r\n\r\n":
        raise ValueError("truncated WARC record")
    return fields, payload


def page_of(urn: str) -> str | None:
    return page_name(urn.removeprefix("<urn:page:").removesuffix(">"))


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least: int = LEAST) -> DataFrame:
    """Write all pages; ``key, id, file, offset, length`` of every record (stored)."""
    prepare(pages.sparkSession)
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    long = F.octet_length("payload") >= least
    equal = materialise(rows.groupBy("digest").agg(F.min(F.when(long, F.col("id"))).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1"), "warc-equal")
    rows = join_uneven(rows, equal.where(F.col("first").isNotNull()).select("digest", "first"), "digest", equal.select("digest", "n"))
    rows = rows.select(F.col("id").cast("string").alias("id"), "url", "payload", "digest", F.when(F.col("id") > F.col("first"), F.col("first").cast("string")).alias("refers_to"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, at = open_folder(folder)
        fs.create_dir(at, recursive=True)
        out = name = None
        try:
            for batch in batches:
                found = []
                for i, url, payload, digest, refers in zip(*(c.to_pylist() for c in batch.columns)):
                    if out is None:
                        name, offset = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = fs.open_output_stream(f"{at}/{name}", compression=None)
                    raw = gzip.compress(record(i, url, payload, digest, refers), 4, mtime=0)
                    out.write(raw)
                    found.append((url_key(url), id_text(i), name, offset, len(raw)))
                    offset += len(raw)
                    if offset >= ARCHIVE_BYTES:
                        out.close()
                        out = None
                if found:
                    yield located(found)
        finally:
            if out is not None:
                out.close()

    return materialise(rows.mapInArrow(write, LOCATED), "warc-manifest")


def located(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["key", "id", "file", "offset", "length"])


# ---- index -----------------------------------------------------------------------------------------


def entry(line: bytes) -> tuple[bytes, bytes]:
    """Sort key of an index line: the bytes of the key, then those of the page id."""
    key, i, _ = line.split(b"\t", 2)
    return key, i


def build_index(manifest: DataFrame, folder: str, block_lines: int = BLOCK_LINES) -> list[tuple[bytes, bytes, str, int, int]]:
    """Write the shards; first key, first id, file, and place of the directory of each, in order.

    There are as many shards as shuffle partitions at most, so the list that the driver gets has that bound.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, at = open_folder(folder)
        fs.create_dir(at, recursive=True)
        name, offset, directory, block = f"{uuid.uuid4().hex}.idx", 0, [], []
        out = None

        def flush() -> None:
            nonlocal offset, out
            if block:
                out = out or fs.open_output_stream(f"{at}/{name}", compression=None)
                raw = zlib.compress(b"\n".join(block), 4)
                out.write(raw)
                directory.append(b"\t".join([*map(lambda x: x if isinstance(x, bytes) else str(x).encode(), (*entry(block[0]), offset, len(raw)))]))
                offset += len(raw)
                block.clear()

        for batch in batches:
            for key, i, file, start, length in zip(*(c.to_pylist() for c in batch.columns)):
                block.append(f"{key}\t{i}\t{file}\t{start}\t{length}".encode())
                if len(block) == block_lines:
                    flush()
        flush()
        if out is not None:
            raw = zlib.compress(b"\n".join(directory), 4)
            out.write(raw)
            out.close()
            key, i = entry(directory[0])
            yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in ((key, pa.binary()), (i, pa.binary()), (name, pa.string()), (offset, pa.int64()), (len(raw), pa.int64()))], ["key", "id", "file", "offset", "length"])

    lines = manifest.repartitionByRange("key", "id").sortWithinPartitions("key", "id")
    shards = materialise(lines.mapInArrow(write, "key binary, id binary, file string, offset long, length long"), "warc-shards")
    return sorted((bytes(r.key), bytes(r.id), r.file, r.offset, r.length) for r in shards.collect())


class IndexReader:
    """Two binary searches, then range reads; remembers the last directory and block."""

    def __init__(self, folder: str, shards: list[tuple[bytes, bytes, str, int, int]]) -> None:
        self.fs, self.at = open_folder(folder)
        self.shards, self.firsts = shards, [s[:2] for s in shards]
        self.files: dict[str, pa.NativeFile] = {}
        self.directory: tuple = (None, [], [])
        self.block: tuple = (None, [], [])

    def read(self, file: str, offset: int, length: int) -> bytes:
        if file not in self.files:
            if len(self.files) >= 64:
                self.files.pop(next(iter(self.files))).close()
            self.files[file] = self.fs.open_input_file(f"{self.at}/{file}")
        return self.files[file].read_at(length, offset)

    def find(self, key: bytes, i: bytes) -> list[tuple[str, int, int]]:
        """(file, offset, length) of all captures with this key and id."""
        want, found = (key, i), []
        shard = max(0, bisect_left(self.firsts, want) - 1)
        while shard < len(self.shards) and self.firsts[shard] <= want:
            if self.directory[0] != shard:
                lines = zlib.decompress(self.read(*self.shards[shard][2:])).split(b"\n")
                self.directory = (shard, lines, [entry(x) for x in lines])
            _, lines, firsts = self.directory
            at = max(0, bisect_left(firsts, want) - 1)
            while at < len(lines) and firsts[at] <= want:
                if self.block[0] != (shard, at):
                    _, _, offset, length = lines[at].rsplit(b"\t", 3)
                    own = zlib.decompress(self.read(self.shards[shard][2], int(offset), int(length))).split(b"\n")
                    self.block = ((shard, at), own, [entry(x) for x in own])
                _, own, keys = self.block
                for line in own[bisect_left(keys, want) : bisect_right(keys, want)]:
                    _, _, file, offset, length = line.rsplit(b"\t", 4)
                    found.append((file.decode(), int(offset), int(length)))
                at += 1
            shard += 1
        return found

    def close(self) -> None:
        for f in self.files.values():
            f.close()


READ = "id string, record_type string, refers_to string, payload_bytes long, payload_digest string, payload binary"


def read_captures(wanted: DataFrame, folder: str, shards: list[tuple[bytes, bytes, str, int, int]], with_payload: bool = True, missing: str = "error") -> DataFrame:
    """The records of every ``key, id``: ``id, record_type, refers_to, payload_bytes, payload_digest, payload``.

    The digest is computed from the payload read and must be the one in the header; a revisit has the header's
    digest and no payload of its own. Ids and references are text. A capture that isn't found raises an error, unless
    ``missing`` is ``skip``.
    """
    prepare(wanted.sparkSession)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = IndexReader(folder, shards)
        for batch in batches:
            out = []
            for key, i in zip(*(c.to_pylist() for c in batch.columns)):
                places = index.find(key.encode(), i.encode())
                if not places and missing == "error":
                    raise LookupError(f"no capture of page {page_name(i)} under {key[:200]!r}")
                for place in places:
                    fields, payload = parse(gzip.decompress(index.read(*place)))
                    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
                    refers = fields.get("WARC-Refers-To")
                    if refers is None and hashlib.sha256(payload).hexdigest() != digest:
                        raise ValueError(f"payload of page {i} doesn't have its digest")
                    out.append((page_of(fields["WARC-Record-ID"]), fields["WARC-Type"], refers and page_of(refers), None if refers else len(payload), digest, payload if with_payload and not refers else None))
            columns = zip(*out) if out else [()] * 6
            kinds = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], ["id", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"])
        index.close()

    ordered = wanted.select("key", "id").distinct().repartitionByRange("key", "id").sortWithinPartitions("key", "id")
    return ordered.mapInArrow(read, READ)


def archive_and_read(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Archive the pages, index the captures, look every one of them up again."""
    folder = fresh_path(pages.sparkSession, "warc")
    manifest = write_archives(pages, folder, id_col, url_col, payload_col)
    shards = build_index(manifest, folder)
    captures = materialise(read_captures(manifest, folder, shards, with_payload=False).drop("payload"), "warc-captures")
    # The full sizes of the pages that others refer to, by the digest and the page.
    target = F.concat_ws(" ", "payload_digest", "refers_to")
    referring = captures.where("record_type = 'revisit'").groupBy(target.alias("target")).agg(F.count(F.lit(1)).alias("n"))
    full = captures.where("record_type = 'response'").groupBy(F.concat_ws(" ", "payload_digest", "id").alias("target")).agg(F.max("payload_bytes").alias("full"))
    sizes = materialise(full.join(referring, "target"), "warc-sizes")
    own = F.when(F.col("refers_to").isNotNull(), target)  # a response has no target
    found = join_uneven(captures.withColumn("target", own), sizes.drop("n"), "target", sizes.select("target", "n"))
    id_type = dict(pages.dtypes)[id_col]
    return found.select(F.col("id").cast(id_type).alias(id_col), F.coalesce("payload_bytes", "full").alias("payload_bytes"), "payload_digest", "record_type", F.col("refers_to").cast(id_type).alias("refers_to"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_and_read(table(spark, sf_dir, "pages"))


OP3_SQL = """
with p as (select page_id, sha256(coalesce(html, '')) as s, octet_length(encode(coalesce(html, ''))) as b from pages),
f as (select *, case when b >= 100 then min(page_id) over (partition by s) end as first from p)
select page_id, cast(b as bigint) as payload_bytes, s as payload_digest,
       case when page_id > first then 'revisit' else 'response' end as record_type,
       case when page_id > first then first end as refers_to
from f
"""
