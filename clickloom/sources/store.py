"""What has been read of each log, and its typed records: the command reads tails only.

The ledger has for each site the log's inode and a digest of its first bytes, the offset up to which it is read, the generation and `since`, the offset up to
which its sessions are scored. A run reads the lines between the offset and the last newline, and adds their records as
one more batch. A log that was replaced (another inode or other first bytes), or is shorter than what was read, begins a new generation, and the records of earlier
ones no longer count. The ledger is saved last, so what a stopped run has added isn't read; it is written over.

Records are dealt to buckets by session, so that the sessions that a run changed are fetched from theirs alone. After
`MERGE` batches they become one.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import versions
from .events import parse
from .ndjson import generation_of, head, last_line_end, read_ranges, rebuild_needed, stat

KEY = ["site_id", "session_id"]
MERGE = 32
#: Bytes at the start of a log by which a replaced one is told.
HEAD = 4096


@dataclass(frozen=True)
class Tail:
    """start, end: the bytes to read; since: the first byte whose sessions aren't scored."""

    file: str
    inode: int
    start: int
    end: int
    generation: int
    since: int


@dataclass(frozen=True)
class Ledger:
    """sites: {site: {inode, head, offset, generation, since, at}}; batches: the names of those that count; read: bytes of
    the last batch; streamed: micro-batches of a stream that are worked off."""

    sites: dict[str, dict] = field(default_factory=dict)
    batches: tuple[str, ...] = ()
    runs: int = 0
    read: int = 0
    streamed: int = 0

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Ledger:
        doc = versions.document(spark, path)
        return cls(doc["sites"], tuple(doc["batches"]), doc["runs"], doc["read"], doc["streamed"]) if doc else cls()

    def save(self, spark: SparkSession, path: str) -> None:
        versions.replace_document(spark, {"sites": self.sites, "batches": list(self.batches), "runs": self.runs, "read": self.read, "streamed": self.streamed}, path)

    def tails(self, files: dict[str, str], force: bool = False, on_replace: str = "rebuild") -> dict[str, Tail]:
        """What is to be read of each log; a tail without its newline waits."""
        out = {}
        for site, file in files.items():
            size, _, inode = stat(file)
            had = self.sites.get(site)
            if had is None:
                out[site] = Tail(file, inode, 0, last_line_end(file, 0, size), 0, 0)
            elif rebuild_needed(had["offset"], had["inode"], size, inode, on_replace, force) or head(file, had["head"][0]) != had["head"][1]:
                out[site] = Tail(file, inode, 0, last_line_end(file, 0, size), had["generation"] + 1, 0)
            else:
                out[site] = Tail(file, inode, had["offset"], last_line_end(file, had["offset"], size), had["generation"], had["since"])
        return out

    def scored(self, sites: list[str], at: str) -> Ledger:
        """The sessions of these sites are scored up to what is read."""
        return replace(self, sites={**self.sites, **{s: {**self.sites[s], "since": self.sites[s]["offset"], "at": at} for s in sites}})

    def table(self, spark: SparkSession, sites: list[str] | None = None) -> DataFrame:
        """(site_id, generation, since, at): a row a site."""
        rows = [(s, v["generation"], v["since"], v.get("at")) for s, v in self.sites.items() if sites is None or s in sites]
        return spark.createDataFrame(rows, "site_id string, generation int, since long, at string")


def append(spark: SparkSession, place: str, ledger: Ledger, tails: dict[str, Tail]) -> Ledger:
    """Adds the tails' records under `place`; the ledger that says so is still to be saved."""
    now = {s: {"inode": t.inode, "head": (n := min(HEAD, t.end), head(t.file, n)), "offset": t.end, "generation": t.generation, "since": t.since, "at": ledger.sites.get(s, {}).get("at")} for s, t in tails.items()}
    after = replace(ledger, sites={**ledger.sites, **now}, runs=ledger.runs + 1, read=sum(t.end - t.start for t in tails.values()))
    batches = merged(spark, place, ledger, after.runs)
    ranges = {s: (t.file, t.start, t.end) for s, t in tails.items() if t.end > t.start}
    if ranges:
        batches = (*batches, f"batch-{after.runs:08d}")
        read = parse(read_ranges(spark, ranges)).where("session_id is not null")
        _write(read.join(F.broadcast(after.table(spark, list(ranges)).select("site_id", "generation")), "site_id"), f"{place}/{batches[-1]}")
    return replace(after, batches=batches)


def merged(spark: SparkSession, place: str, ledger: Ledger, run: int) -> tuple[str, ...]:
    """The ledger's batches, or one that holds them all, if they are many."""
    if len(ledger.batches) < MERGE:
        return ledger.batches
    name = f"batch-{run:08d}-all"
    _write(records(spark, place, ledger), f"{place}/{name}")
    return (name,)


def append_stream(spark: SparkSession, place: str, ledger: Ledger, lines: DataFrame, n: int) -> Ledger:
    """Adds the records of micro-batch n of a stream, whose `seq` has the log's generation; the ledger that says so is still to be saved.

    A log that was replaced brings another generation, and records of the one before no longer count.
    """
    name = f"batch-{n:08d}-stream"
    _write(parse(lines).where("session_id is not null").withColumn("generation", generation_of(F.col("seq"))), f"{place}/{name}")
    after = replace(ledger, runs=ledger.runs + 1, streamed=n + 1, batches=(*merged(spark, place, ledger, ledger.runs + 1), name))
    if not [x for x in versions.names(spark, f"{place}/{name}") if x.startswith("bucket=")]:
        return replace(after, batches=after.batches[:-1])
    seen = spark.read.parquet(f"{place}/{name}").groupBy("site_id").agg(F.max(F.struct("seq", "generation")).alias("last"), F.min("seq").alias("first")).collect()  # a row a site
    now = {r["site_id"]: {**ledger.sites.get(r["site_id"], {}), "generation": r["last"]["generation"], "offset": r["last"]["seq"] + 1, "since": r["first"]} for r in seen}
    return replace(after, sites={**ledger.sites, **now})


def _write(rows: DataFrame, path: str) -> None:
    dealt = rows.withColumn("bucket", F.pmod(F.xxhash64(*KEY), F.lit(versions.BUCKETS)).cast("int"))
    dealt.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(path)


def records(spark: SparkSession, place: str, ledger: Ledger, sites: list[str] | None = None, buckets: list[int] | None = None) -> DataFrame:
    """The records of each log's last generation, with `generation`; of some sites and buckets only."""
    paths = [f"{place}/{b}" for b in ledger.batches]
    all_rows = None
    for path in paths:
        if not [n for n in versions.names(spark, path) if n.startswith("bucket=")]:
            continue  # no line of the batch was a record
        df = spark.read.parquet(path)
        all_rows = df if all_rows is None else all_rows.unionByName(df)
    if all_rows is None:
        empty = spark.createDataFrame([], "site_id string, seq long, line string")
        return parse(empty).withColumn("generation", F.lit(0))
    if buckets is not None:
        all_rows = all_rows.where(F.col("bucket").isin(buckets))
    now = ledger.table(spark, sites).select("site_id", "generation")  # a row a site
    return all_rows.drop("bucket").join(F.broadcast(now), ["site_id", "generation"])


def new_keys(rows: DataFrame, sites: DataFrame) -> DataFrame:
    """(site_id, session_id) of the rows at or behind their site's `since`. sites: a row a site."""
    return rows.join(F.broadcast(sites.select("site_id", "since")), "site_id").where(F.col("seq") >= F.col("since")).select(*KEY).distinct()


def touched(spark: SparkSession, place: str, ledger: Ledger, sites: list[str], everything: bool = False) -> DataFrame:
    """(site_id, session_id) with a record since the last run that scored the site; with `everything` of all sessions of the sites."""
    rows = records(spark, place, ledger, sites).select(*KEY, "seq")
    return rows.select(*KEY).distinct() if everything else new_keys(rows, ledger.table(spark, sites))


def of_sessions(spark: SparkSession, place: str, ledger: Ledger, sites: list[str], keys: DataFrame) -> DataFrame:
    """All records of the sessions `keys`, read from their buckets."""
    wanted = [r[0] for r in keys.select(F.pmod(F.xxhash64(*KEY), F.lit(versions.BUCKETS)).cast("int")).distinct().collect()]  # at most BUCKETS
    return records(spark, place, ledger, sites, wanted).join(keys, KEY, "left_semi")


def sweep(spark: SparkSession, place: str, ledger: Ledger) -> None:
    """Deletes batches that no longer count."""
    for name in versions.names(spark, place):
        if name.startswith("batch-") and name not in ledger.batches:
            versions.delete(spark, f"{place}/{name}")

