"""WARC archives: round trips, rolling, determinism and what a half-written archive shows."""

from __future__ import annotations

import base64
import gzip
import hashlib
import os
import random
from collections import defaultdict

import pyarrow as pa
import pytest

from clickloom.llm import warc

COLUMNS = "page_id long, url string, html string, shard string, key int"


def plain(rows, least=0):
    by = defaultdict(list)
    for page_id, _, html in rows:
        by[html or ""].append(page_id)
    out = []
    for html, ids in by.items():
        body = html.encode()
        first = min(ids, key=lambda x: (x is not None, x or 0))
        for k, page_id in enumerate(sorted(ids, key=lambda x: (x is not None, x or 0))):
            again = k > 0 and len(body) >= least
            out.append((page_id, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "revisit" if again else "response", first if again else None))
    return sorted(out, key=str)


def some_rows(r, n):
    texts = ["", "<p>same</p>", "<p>ünï \U0001f600</p>", "\r\n\r\nWARC/1.1\r\n", "x" * 200_000]
    rows = [(i, r.choice([None, "http://a/b c?\r\nX: y", f"https://h/{i}"]), r.choice([*texts, None, f"<p>{i}</p>"])) for i in r.sample(range(-50, 3 * n), n)]
    return rows + rows[:7] + [(rows[0][0], "u", "<p>other</p>"), (None, "u", "<p>same</p>"), (None, None, None)]


@pytest.mark.parametrize("how", [warc.Archive(), warc.Archive(shard=300_000, roll=600), warc.Archive(shard=1000, roll=1 << 20, least=12)])
def test_archive_gives_every_page_back(spark, tmp_path, how):
    rows = some_rows(random.Random(7), 150)
    pages = spark.createDataFrame([(*x, "clash", 1) for x in rows], COLUMNS)
    folder = f"file://{tmp_path}/a"
    files = warc.write(pages.repartition(5), folder, how)
    got = warc.read(files, folder).collect()
    fields = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(x[c] for c in fields) for x in got), key=str) == plain(rows, how.least)
    assert all(x["block_ok"] and x["payload_ok"] for x in got)
    payloads = {x["payload_digest"]: bytes(x["payload"]) for x in got if x["record_type"] == "response"}
    assert {p.decode() for p in payloads.values()} == {x[2] or "" for x in rows}
    on_disk = {f for f in os.listdir(tmp_path / "a") if f.endswith(".gz")}
    listed = files.collect()
    assert on_disk == {x["name"] for x in listed} and sum(x["records"] for x in listed) == len(rows)
    for x in listed:
        data = (tmp_path / "a" / x["name"]).read_bytes()
        assert hashlib.sha256(data).hexdigest() == x["sha256"] and len(data) == x["bytes"] and gzip.decompress(data).startswith(b"WARC/1.1\r\n")
    if how.roll == 600:
        assert max(x["number"] for x in listed) > 0
    # other tasks write the same files
    again = warc.write(pages.repartition(2), f"file://{tmp_path}/b", how).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, listed))


def test_archive_of_nothing(spark, tmp_path):
    pages = spark.createDataFrame([], COLUMNS)
    assert warc.archived(pages, folder=f"file://{tmp_path}/none").collect() == []


def test_readers_see_only_what_the_manifest_names(spark, tmp_path):
    """A lost attempt leaves a temporary file, or a file without its line: neither is read."""
    folder = f"file://{tmp_path}/c"
    files = warc.write(spark.createDataFrame([(1, "u", "a", "", 0)], COLUMNS), folder)
    (tmp_path / "c" / "_temporary-1-pages-000000-00000.warc.gz").write_bytes(b"half")
    (tmp_path / "c" / "pages-000009-00000.warc.gz").write_bytes(warc.member(b"no record", 6))
    assert [x["page_id"] for x in warc.read(warc.manifest(spark, folder), folder).collect()] == [1]
    assert files.count() == 1


def test_a_changed_payload_is_noticed(spark, tmp_path):
    folder = f"file://{tmp_path}/d"
    files = warc.write(spark.createDataFrame([(1, "u", "<p>one</p>", "", 0)], COLUMNS), folder)
    path = tmp_path / "d" / files.first()["name"]
    path.write_bytes(warc.member(gzip.decompress(path.read_bytes()).replace(b"one", b"two"), 6))
    (x,) = warc.read(files, folder).collect()
    assert not x["block_ok"] and not x["payload_ok"]


def test_members_across_reads():
    parts = [b"a" * 100, b"", os.urandom(5000), b"z"]
    data = b"".join(warc.member(p, 6) for p in parts)
    for step in (1, 7, 1 << 20):
        assert list(warc.members(pa.BufferReader(data), step)) == parts
    with pytest.raises(EOFError):
        list(warc.members(pa.BufferReader(data[:-3])))
