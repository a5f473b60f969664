"""Append-only NDJSON logs, one file a site: batch and streaming scans by byte range.

A line counts when its newline is there; the tail after the last newline waits for the next run.
`seq` is the line's byte offset, a total order within a site that doesn't hang on how files are cut. Files are listed and read
over any file system that pyarrow knows (local, hdfs, s3, gs), named by path or URI; lines leave a task as Arrow batches.
"""

from __future__ import annotations

import hashlib
import json
import os
import posixpath
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from .files import place

SITE_FILE = re.compile(r"1_\d+\.json\Z")
SCHEMA = "site_id string, seq long, line string"
#: Bytes that a task reads at once.
CHUNK = 4 << 20


def sites(path: str, allow: list[str] | None = None) -> dict[str, str]:
    """{site id: file} of the logs in a folder, in order; ids may be given with or without `.json`."""
    named = None if allow is None else {x.removesuffix(".json") for x in allow}
    fs, root = place(path)
    files = sorted(f.base_name for f in fs.get_file_info(pyarrow.fs.FileSelector(root, allow_not_found=True)) if f.is_file and SITE_FILE.match(f.base_name))
    found = {f.removesuffix(".json"): posixpath.join(path, f) for f in files}
    return {k: v for k, v in found.items() if named is None or k in named}


def stat(file: str) -> tuple[int, int, int]:
    """Size, time in ns and inode of a file; file systems without inodes have 0."""
    fs, path = place(file)
    info = fs.get_file_info(path)
    if not info.is_file:
        raise FileNotFoundError(file)
    return info.size, info.mtime_ns or 0, os.stat(path).st_ino if isinstance(fs, pyarrow.fs.LocalFileSystem) else 0


def head(file: str, n: int) -> str:
    """Digest of the first n bytes: a log that was replaced begins otherwise, whatever its inode."""
    fs, path = place(file)
    with fs.open_input_file(path) as f:
        return hashlib.sha256(f.read_at(n, 0)).hexdigest()


def first_line(file: str, most: int = 4096) -> str:
    """Digest of the first line, or of its first bytes if it is long."""
    fs, path = place(file)
    with fs.open_input_file(path) as f:
        return hashlib.sha256(f.read_at(most, 0).split(b"\n", 1)[0]).hexdigest()


def last_line_end(file: str, start: int, size: int, step: int = 1 << 16) -> int:
    """Offset after the last newline in [start, size), or start; looks backwards from the end."""
    fs, path = place(file)
    with fs.open_input_file(path) as f:
        at = size
        while at > start:
            begin = max(start, at - step)
            k = f.read_at(at - begin, begin).rfind(b"\n")
            if k >= 0:
                return begin + k + 1
            at = begin
    return start


@dataclass
class Range(InputPartition):
    """Bytes of a log; `first` is added to the offsets of its lines."""

    site: str
    file: str
    start: int
    end: int
    aligned: bool = True
    first: int = 0


@dataclass
class Ranges(InputPartition):
    """Ranges of one task: small logs share it."""

    parts: list[Range]


def packed(ranges: list[Range], step: int, most: int = 256) -> list[Ranges]:
    """Tasks of about `step` bytes."""
    out: list[Ranges] = []
    room = 0
    for r in ranges:
        if not out or room + r.end - r.start > step or len(out[-1].parts) >= most:
            out.append(Ranges([]))
            room = 0
        out[-1].parts.append(r)
        room += r.end - r.start
    return out or [Ranges([])]


#: In a stream the offsets of a log's lines carry its generation above so many bits.
OFFSET_BITS = 48


def generation_of(seq):
    """The generation in a number or column of offsets of a stream."""
    return seq // (1 << OFFSET_BITS) if isinstance(seq, int) else F.shiftright(seq, OFFSET_BITS).cast("int")


def generation(inode: int, first: str) -> int:
    """A number of 14 bits for a log by its inode and its first line."""
    return int.from_bytes(hashlib.sha256(f"{inode}:{first}".encode()).digest()[:2], "big") >> 2


def _batch(site: str, at: int, data: bytes) -> tuple[pa.RecordBatch, int]:
    """The lines of `data`, which begins at `at`, up to its last newline, and how many bytes that are; blank lines are left out."""
    ends = np.flatnonzero(np.frombuffer(data, np.uint8) == 10)
    used = int(ends[-1]) + 1 if len(ends) else 0
    text = data[:used].decode("utf-8", "replace")
    lines = pc.utf8_rtrim(pc.list_flatten(pc.split_pattern(pa.array([text], pa.large_string()), "\n")), "\r\n")[: len(ends)]
    starts = np.concatenate(([0], ends[:-1] + 1)) + at if len(ends) else np.zeros(0, np.int64)
    some = pc.not_equal(pc.utf8_trim_whitespace(lines), "")
    lines, starts = lines.filter(some).cast(pa.string()), pa.array(starts, pa.int64()).filter(some)
    return pa.RecordBatch.from_arrays([pa.array([site] * len(lines), pa.string()), starts, lines], names=["site_id", "seq", "line"]), used


def lines(part: Range, chunk: int = CHUNK) -> Iterator[pa.RecordBatch]:
    """Lines that begin in the range and are terminated; a range that isn't aligned begins after its first newline."""
    fs, path = place(part.file)
    with fs.open_input_file(path) as f:
        size, at = f.size(), part.start
        data = b""
        if not part.aligned and at > 0:
            at -= 1  # a line begins here if a newline stands right before
            while at < size:
                data = f.read_at(chunk, at)
                k = data.find(b"\n")
                at += k + 1 if k >= 0 else len(data)
                if k >= 0:
                    break
            data = b""
        read = at
        while at < part.end:
            data += (more := f.read_at(min(chunk, size - read), read))
            read += len(more)
            if read > part.end:  # of the last line in the range the end is behind it
                inside = data.find(b"\n", max(0, part.end - at - 1))
                if inside >= 0:
                    yield _batch(part.site, part.first + at, data[: inside + 1])[0]
                    return
            if not more:
                break
            batch, used = _batch(part.site, part.first + at, data)
            if batch.num_rows:
                yield batch
            at, data = at + used, data[used:]
        if at < part.end and b"\n" in data:
            yield _batch(part.site, part.first + at, data)[0]


class _Batch(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options

    def partitions(self) -> list[InputPartition]:
        step = int(self.options.get("rangeBytes", 64 << 20))
        if "ranges" in self.options:
            wanted = json.loads(self.options["ranges"])
        else:
            wanted = {site: (file, 0, stat(file)[0]) for site, file in sites(self.options["path"], _allow(self.options)).items()}
        return packed([Range(site, file, a, min(a + step, end), aligned=a == start) for site, (file, start, end) in wanted.items() for a in range(start, end, step)], step)

    def read(self, partition: Ranges) -> Iterator[pa.RecordBatch]:
        for part in partition.parts:
            yield from lines(part)


class _Stream(DataSourceStreamReader):
    """Offsets are {site: {offset, inode, generation}}; `onReplace` says what a new inode or a shorter file means.

    rebuild (default): the file is read again from its start; continue: only a shorter file is, or one that begins with another line.
    `seq` has the generation of the log (`generation`) in its high bits, so that readers can tell its records from those of the log before.
    """

    def __init__(self, options: dict):
        self.options = options

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        out = {}
        for site, file in sites(self.options["path"], _allow(self.options)).items():
            size, _, inode = stat(file)
            end = last_line_end(file, 0, size)
            out[site] = {"offset": end, "inode": inode, "generation": generation(inode if self.options.get("onReplace", "rebuild") == "rebuild" else 0, first_line(file)) if end else 0}
        return out

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        files = sites(self.options["path"], _allow(self.options))
        step = int(self.options.get("rangeBytes", 64 << 20))
        out = []
        for site, to in end.items():
            had = start.get(site) or {"offset": 0, "inode": to["inode"], "generation": to["generation"]}
            begin = 0 if self.again(had, to) else had["offset"]
            out += [Range(site, files[site], a, min(a + step, to["offset"]), a == begin, to["generation"] << OFFSET_BITS) for a in range(begin, to["offset"], step)]
        return packed(out, step)

    def again(self, had: dict, now: dict) -> bool:
        other = had["offset"] > 0 and had["generation"] != now["generation"]
        return other or rebuild_needed(had["offset"], had["inode"], now["offset"], now["inode"], self.options.get("onReplace", "rebuild"))

    def read(self, partition: Ranges) -> Iterator[pa.RecordBatch]:
        for part in partition.parts:
            yield from lines(part)

    def commit(self, end: dict) -> None:
        """The offsets are kept in the query's checkpoint."""


def rebuild_needed(offset: int, inode: int, size: int, now_inode: int, on_replace: str = "rebuild", force: bool = False) -> bool:
    """Whether a log is read from its start: forced, shorter than what was read, or replaced under the policy `rebuild`."""
    return force or size < offset or (inode != now_inode and on_replace == "rebuild")


def _allow(options: dict) -> list[str] | None:
    named = options.get("sites")
    return [x.strip() for x in named.split(",") if x.strip()] if named else None


class SiteLogs(DataSource):
    """Format `sitelogs`; options path, sites (comma-separated allow-list), rangeBytes, onReplace; or ranges, JSON of
    {site: [file, start, end]} where lines begin at start."""

    @classmethod
    def name(cls) -> str:
        return "sitelogs"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Batch(dict(self.options))

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return _Stream(dict(self.options))


def read_logs(spark: SparkSession, path: str, allow: list[str] | None = None, **options: str) -> DataFrame:
    """site_id, seq, line of all terminated, non-blank lines."""
    spark.dataSource.register(SiteLogs)
    named = {"sites": ",".join(allow)} if allow else {}
    return spark.read.format("sitelogs").options(path=path, **named, **options).load()


def read_ranges(spark: SparkSession, ranges: dict[str, tuple[str, int, int]], **options: str) -> DataFrame:
    """The lines of {site: (file, start, end)}; a line begins at each start."""
    spark.dataSource.register(SiteLogs)
    return spark.read.format("sitelogs").options(ranges=json.dumps(ranges), **options).load()


def stream_logs(spark: SparkSession, path: str, allow: list[str] | None = None, **options: str) -> DataFrame:
    spark.dataSource.register(SiteLogs)
    named = {"sites": ",".join(allow)} if allow else {}
    return spark.readStream.format("sitelogs").options(path=path, **named, **options).load()
