"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import uuid
from urllib.parse import urlparse

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The separators of the contracts' words: space and U+0009 to U+000D.
SPACES = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; a temporary one only where none is set and all run on this machine."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    kept = sc._jsc.sc().getCheckpointDir()
    if kept.isEmpty():
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="clickloom-"))
        kept = sc._jsc.sc().getCheckpointDir()
    return kept.get().rstrip("/")


def filesystem(folder: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """How tasks reach a shared folder by themselves, and its path there; raises where pyarrow doesn't know its kind."""
    if not urlparse(folder).scheme:
        folder = f"file://{folder}"
    elif folder.startswith("file:/") and not folder.startswith("file://"):
        folder = "file://" + folder.removeprefix("file:")
    return pyarrow.fs.FileSystem.from_uri(folder)


def lean() -> None:
    """Gives memory that this Python worker holds but doesn't use back to the system: workers live on from stage to stage."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not the GNU C library
        ctypes.CDLL(None).malloc_trim(0)


def settled(df: DataFrame) -> DataFrame:
    """`df` written once to the shared folder and read again.

    It cuts the lineage like a checkpoint and survives lost executors, but runs the plan once
    and keeps column pruning for its readers.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/clickloom-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Deletes the files of a `settled` table that nothing reads any more."""
    jvm = df.sparkSession.sparkContext._jvm
    conf = df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    for name in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/clickloom-" in name:
            path = jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(conf).delete(path, True)


#: Bits of the map that `marked` broadcasts: at most 2**18 rows of two numbers, whatever the data.
PLACES = 1 << 24


def marked(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """`df` with `maybe`: false only where no row of `keys` has its values of the columns `on`.

    A bitmap of the hashed keys goes to every task, so that rows which can't join need not be shuffled by the exact
    join that follows. Where the map fills up, more rows are marked; nothing else changes.
    """
    place = F.pmod(F.xxhash64(*on), F.lit(PLACES))
    words = keys.select(place.alias("place")).groupBy(F.expr("place div 64").alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(place % 64 as int)))").alias("bits"))
    found = df.withColumn("place", place).join(F.broadcast(words), F.expr("place div 64 = word"), "left")  # bounded by PLACES
    return found.withColumn("maybe", F.expr("coalesce(getbit(bits, cast(place % 64 as int)) = 1, false)")).drop("place", "word", "bits")


def in_fold(doc_id: Column | str) -> Column:
    """crc32 of the id as text, mod 5, is 0: such rows are held out. A null id counts as ''."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def labelled_sample(labels: DataFrame, label: str, most: int) -> DataFrame:
    """At most `most` training rows (doc_id, y), the same on every run.

    Held-out rows, null ids and null labels take no part; of repeated ids the largest label
    counts. The rows are those whose hashed id is smallest, which is independent of the label.
    """
    return (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~in_fold("doc_id"))
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most)
    )


def sizes(text: str = "text") -> Column:
    """Number of words of the contracts in a text; 0 for null."""
    t = F.coalesce(F.col(text), F.lit(""))
    n = F.size(F.split(t, SPACES)) - t.rlike(rf"^{SPACES}").cast("int") - t.rlike(rf"{SPACES}\z").cast("int")
    return F.when(F.length(t) == 0, 0).otherwise(n).cast("long")
