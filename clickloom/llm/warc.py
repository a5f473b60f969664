"""WARC archives of web pages: a deterministic sharded writer, and a reader.

Pages are ordered by id; a shard is what lies between two multiples of `shard` payload bytes in that order. The
running sum behind this is exact (range-sorted rows, sums inside a range and over ranges), so shards hang on the
data alone, not on how Spark cuts its tasks. A task writes the records of a shard in order, each a gzip member, and rolls
to a new file once a file has `roll` compressed bytes. Of records with equal payloads that with the smallest page_id is a
response, the others are revisits without payload; payloads shorter than `least` are all responses. Headers are regenerated:
record ids from the page's id, digests over block and payload, lengths, and one date for the whole archive.

Commit: a file is written under a temporary name of its attempt, read back to verify its size, and renamed; its name says shard and number, its
content is the same in every attempt, so a lost executor's work is simply done again. The files' names, sizes and
digests are the rows of the manifest, a Spark table that is complete or not there; readers open only what a manifest names.
Files go to the shared folder by a filesystem that pyarrow knows (file, hdfs, s3, gs and others); elsewhere `write` raises.

A null html is empty, a null url an empty target. Null ids come first and count as smallest, with refers_to null. Rows that repeat an id are records of their own,
told apart by payload and number; of equal ones the first is the response. A row is in one task, however long, and very long payloads are
compressed and read in one piece; a shard is never held. An empty table gives an archive without files and an empty result. Only
page_id, url and html are read, so other columns can't clash.
"""

from __future__ import annotations

import base64
import hashlib
import posixpath
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import dropped, filesystem, settled, shared_dir

MANIFEST = "name string, shard long, number int, records long, bytes long, sha256 string"
RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary, block_ok boolean, payload_ok boolean"


@dataclass(frozen=True)
class Archive:
    """shard: payload bytes of a shard, more if there would be over `shards`; roll: compressed bytes at which a file ends; least: bytes of
    payload from which on equal ones are revisits; date: of all records; level: of the compression."""

    shard: int = 32 << 20
    shards: int = 65_536
    roll: int = 128 << 20
    least: int = 0
    date: str = "2020-01-01T00:00:00Z"
    level: int = 6


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def _payload(html: str = "html") -> Column:
    return F.coalesce(F.col(html).cast("binary"), F.lit("").cast("binary"))


def _shares(narrow: DataFrame, how: Archive) -> tuple[list[int], int]:
    """First page_id of each shard but the first, and their number. An id is in one shard, however many rows repeat it."""
    order = [F.col("page_id"), F.col("key")]
    total = narrow.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    size = max(how.shard, -(-total // how.shards), 1)
    ranged = settled(
        narrow.repartitionByRange(*order).sortWithinPartitions(*order)
        .select("page_id", "n", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("i"))
    )
    parts = ranged.groupBy("part").agg(F.sum("n").alias("n"))  # a row a task
    before = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    upto = Window.partitionBy("part").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.withColumn("own", F.coalesce(F.sum("n").over(upto), F.lit(0))).join(F.broadcast(before), "part")  # a row a task
    first = placed.where("page_id is not null").groupBy(F.floor((F.col("own") + F.col("before")) / size).alias("shard")).agg(F.min("page_id").alias("at"))
    starts = sorted({r["at"] for r in first.collect()})[1:]  # at most how.shards numbers
    dropped(ranged)
    return starts, len(starts) + 1


def _shard_of(starts: list[int]) -> Column:
    cuts = np.array(starts, np.int64)

    @F.pandas_udf("long")
    def run(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, ids.to_numpy(np.int64), "right"))

    return run(F.coalesce("page_id", F.lit(-(1 << 63)))) if starts else F.lit(0).cast("long")


def _firsts(narrow: DataFrame, how: Archive) -> DataFrame:
    """(page_id, key, first): of each page whose payload another row has, too, the smallest id that has it.

    Payloads are equal if their SHA-256 and length are. Counts are summed up before the shuffle; no payload is moved.
    """
    each = narrow.where(F.col("n") >= how.least).groupBy("key", "n", "page_id").agg(F.count(F.lit(1)).alias("rows"))
    least = each.groupBy("key", "n").agg(F.min(F.struct("page_id")).getField("page_id").alias("first"), F.sum("rows").alias("all")).where(F.col("all") > 1)
    return each.join(least, ["key", "n"]).select("page_id", "key", "first")


# ---------------------------------------------------------------- records


def record_id(page_id: int | None, key: str, number: int) -> str:
    """Names a page, the start of its payload's SHA-256 and which one of equal rows it is."""
    return f"<urn:page:{'' if page_id is None else page_id}:{key[:16]}:{number}>"


def page_of(record: str) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d*):[0-9a-f]+:\d+>", record)
    if not found:
        raise ValueError(f"no record of a page: {record}")
    return int(found[1]) if found[1] else None


def record(page_id: int | None, key: str, number: int, url: str | None, payload: bytes, refers_to: tuple | None, how: Archive) -> bytes:
    """One record, uncompressed. key: the payload's SHA-256; refers_to: (id,) of the response for a revisit."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to else http + payload
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")
    lines = [
        "WARC/1.1", f"WARC-Type: {'revisit' if refers_to else 'response'}", f"WARC-Record-ID: {record_id(page_id, key, number)}", f"WARC-Date: {how.date}", f"WARC-Target-URI: {target}",
        "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{base32(hashlib.sha1(payload).digest())}", f"WARC-Block-Digest: sha1:{base32(hashlib.sha1(block).digest())}",
    ]
    if refers_to:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {record_id(refers_to[0], key, 0)}"]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes, level: int) -> bytes:
    """A gzip member without name or time."""
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


class _Roller:
    """Writes the files of one shard after another."""

    def __init__(self, folder: str, how: Archive):
        self.fs, self.root = filesystem(folder)
        self.how, self.out, self.done = how, None, []
        self.shard, self.number = -1, 0

    def write(self, shard: int, data: bytes) -> None:
        if shard != self.shard:
            self.close()
            self.shard, self.number = shard, 0
        if self.out is None:
            self.name = f"pages-{shard:06d}-{self.number:05d}.warc.gz"
            self.temporary = posixpath.join(self.root, f"_temporary-{uuid.uuid4().hex}-{self.name}")
            self.out, self.digest, self.bytes, self.records = self.fs.open_output_stream(self.temporary, compression=None), hashlib.sha256(), 0, 0
        packed = member(data, self.how.level)
        self.out.write(packed)
        self.digest.update(packed)
        self.bytes += len(packed)
        self.records += 1
        if self.bytes >= self.how.roll:
            self.close()

    def close(self) -> None:
        if self.out is None:
            return
        self.out.close()
        self.out = None
        if self.fs.get_file_info(self.temporary).size != self.bytes:
            raise OSError(f"{self.temporary} isn't whole")
        self.fs.move(self.temporary, posixpath.join(self.root, self.name))  # over the same bytes, if another attempt was here
        self.done.append((self.name, self.shard, self.number, self.records, self.bytes, self.digest.hexdigest()))
        self.number += 1

    def rows(self) -> pa.RecordBatch:
        out, self.done = self.done, []
        types = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [[]] * 6, types, strict=True)], names=[c.split()[0] for c in MANIFEST.split(", ")])


def write(pages: DataFrame, folder: str, how: Archive = Archive()) -> DataFrame:
    """Writes the archive of `pages` under `folder`; returns its manifest, which is `folder`/manifest.

    Payloads are shuffled once: pages and the small rows that mark equal payloads are dealt to shards and sorted together.
    """
    spark = pages.sparkSession
    ours = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", _payload().alias("payload"))
    narrow = settled(ours.select("page_id", F.octet_length("payload").cast("long").alias("n"), F.sha2("payload", 256).alias("key")))
    starts, n = _shares(narrow, how)
    marks = _firsts(narrow, how).select(
        "page_id", "key", F.lit(0).alias("kind"), F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("payload"), "first"
    )
    rows = ours.select("page_id", F.sha2("payload", 256).alias("key"), F.lit(1).alias("kind"), "url", "payload", F.lit(None).cast("long").alias("first"))
    dealt = rows.unionByName(marks).withColumn("shard", _shard_of(starts)).repartitionById(n, F.col("shard").cast("int")).sortWithinPartitions("shard", "page_id", "key", "kind", "url")
    fs, root = filesystem(folder)
    fs.create_dir(root, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller = _Roller(folder, how)
        last, mark, number, seen = None, None, 0, False
        for batch in batches:
            for at in range(batch.num_rows):
                shard, page_id, key, kind, url, payload, first = (batch.column(c)[at] for c in range(7))
                page_id, key = page_id.as_py(), key.as_py()
                if (page_id, key) != last:
                    last, number, mark, seen = (page_id, key), 0, None, False
                if kind.as_py() == 0:  # a mark comes right before the pages that it is about
                    mark, seen = (first.as_py(),), first.as_py() != page_id
                    continue
                revisit = mark if seen else None
                seen = mark is not None
                roller.write(shard.as_py(), record(page_id, key, number, url.as_py(), payload.as_py(), revisit, how))
                number += 1
            if roller.done:
                yield roller.rows()
        roller.close()
        yield roller.rows()

    dealt.select("shard", "page_id", "key", "kind", "url", "payload", "first").mapInArrow(run, MANIFEST).write.parquet(f"{folder}/manifest")
    dropped(narrow)
    return manifest(spark, folder)


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


# ---------------------------------------------------------------- reading


def members(source: pyarrow.NativeFile, step: int = 1 << 20) -> Iterator[bytes]:
    """The members of a gzip file, one after another."""
    z, parts, rest = zlib.decompressobj(31), [], b""
    while True:
        data = rest or source.read(step)
        if not data:
            if parts:
                raise EOFError("the last member isn't whole")
            return
        parts.append(z.decompress(data))
        rest = z.unused_data
        if z.eof:
            yield b"".join(parts)
            z, parts = zlib.decompressobj(31), []


def parsed(data: bytes) -> tuple:
    """The fields of RECORD of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not first.startswith("WARC/1."):
        raise ValueError(f"no WARC record: {first[:20]}")
    h = {k.lower(): v for k, v in (x.split(": ", 1) for x in lines)}
    length = int(h["content-length"])
    block = rest[:length]
    if rest[length:] != b"\r\n\r\n":
        raise ValueError("a record of another length")
    http, _, payload = block.partition(b"\r\n\r\n")
    declared = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    digest = h["warc-payload-digest"].removeprefix("sha1:")
    revisit = h["warc-type"] == "revisit"
    return (
        page_of(h["warc-record-id"]), declared, digest, h["warc-type"], page_of(h["warc-refers-to"]) if revisit else None, h["warc-target-uri"], None if revisit else payload,
        h["warc-block-digest"] == f"sha1:{base32(hashlib.sha1(block).digest())}", revisit or (len(payload) == declared and digest == base32(hashlib.sha1(payload).digest())),
    )


def read(files: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """RECORD of every record of the manifest's files. A task reads a file after another; digests are computed anew."""
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary(), pa.bool_(), pa.bool_()]
    names = [c.split()[0] for c in RECORD.split(", ")]

    def table(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = filesystem(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                held, size = [], 0
                with fs.open_input_stream(posixpath.join(root, name), compression=None) as source:
                    for data in members(source):
                        row = parsed(data)
                        held.append(row if payloads else (*row[:6], None, *row[7:]))
                        size += len(data) if payloads else 200
                        if size > 4 << 20:
                            yield table(held)
                            held, size = [], 0
                if held:
                    yield table(held)

    spark = files.sparkSession
    tasks = max(1, min(files.count(), 16 * spark.sparkContext.defaultParallelism))
    return files.select("name").repartition(tasks, "name").mapInArrow(run, RECORD)


def archived(pages: DataFrame, how: Archive = Archive(), folder: str | None = None) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of each page, from the archive that is written for it."""
    folder = folder or f"{shared_dir(pages.sparkSession)}/clickloom-warc-{uuid.uuid4().hex}"
    rows = read(write(pages, folder, how), folder, payloads=False)
    whole = F.when(F.col("block_ok") & F.col("payload_ok"), F.col("page_id")).otherwise(F.raise_error(F.lit("a digest differs")).cast("long"))
    return rows.select(whole.alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")
