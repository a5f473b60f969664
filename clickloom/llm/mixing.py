"""Mixing sources to target weights by a low-discrepancy schedule, with DataFrame operations only.

A document's words follow one another in its source's stream, whose documents are shuffled by a
hash. The stream is cut into blocks of equally many words. Slots of the mix take the points of a
golden-ratio sequence, which fall through the cumulative shares of the sources; the r-th slot of
a source takes its block r mod (number of blocks), so that a stream starts again when it has ended.

Positions in a stream are running sums over hash ranges (`RANGES` for each source, more for a large
table, so that a range stays a small share of it) and then inside each range, ranks of slots likewise
over runs of slots, so that no source is ever in one task. Only windows over one row a source, and over
one row a range of one source, stand in one task.

Documents of equal hash go by id and size, which changes no sum. Very long texts are only counted, and may span many blocks.
A null text has size 0, a null source is a source of its own and comes last; repeated rows count
as often as they stand; a source without words has target 0; an empty table gives an empty result.
Of the input, doc_id, text and source are read; other columns can't clash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import settled, sizes

#: Least hash ranges of each source, a power of two; the golden ratio's share of 2**31, odd, so that it runs through all points.
RANGES, PERIOD, GOLDEN = 1024, 2**31, 1_327_217_885
#: Documents of a range, if all were of one source.
ROWS = 65_536
#: Copies of one row that a task emits in one go.
RUN = 1_000
#: No document is taken more often than this.
MOST = 3


def targets(by_source: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = MOST) -> DataFrame:
    """by_source (source, source_size) with `target` and the source's rank `k`.

    Shares go by weight; none exceeds `most` times its source's size, and the excess is shared
    again. The fixed point is min(weight * level, cap): sources in the order of cap / weight are
    capped until the level that the others reach lies below the next one's. One row a source.
    """
    cap = F.col("source_size") * F.lit(float(most))
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    by_cap = Window.orderBy(F.col("cap") / F.col("w"), "k")
    ranked = by_source.withColumn("k", F.row_number().over(by_name) - 1).withColumns(
        {"w": F.element_at(F.array(*map(F.lit, weights)), (F.col("k") % len(weights) + 1).cast("int")).cast("double"), "cap": cap}
    )
    before = F.coalesce(F.sum("cap").over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    after = F.sum("w").over(by_cap.rowsBetween(0, Window.unboundedFollowing))
    total = F.sum("source_size").over(Window.partitionBy())
    # the level if all sources before this one are capped and no other is
    leveled = ranked.withColumn("level", (total - before) / after)
    # levels fall from the first that fits on, so that one is the largest of those that fit
    fits = F.max(F.when(F.col("level") * F.col("w") <= F.col("cap"), F.col("level"))).over(Window.partitionBy())
    return leveled.withColumn("target", F.least(F.col("cap"), F.coalesce(fits * F.col("w"), F.col("cap")))).select("source", "source_size", "k", "target")


def _streams(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents with their place in the source's stream, and the size of each source.

    Texts are read once; what is kept of them (five numbers a document) is written and reread.
    """
    ranges = max(RANGES, 1 << (docs.count() // ROWS).bit_length())
    sized = settled(
        docs.select("doc_id", "source", sizes().alias("size"), F.xxhash64(F.lit("mix"), "doc_id", "text").alias("h")).withColumn(
            "bin", F.shiftrightunsigned("h", 64 - ranges.bit_length() + 1)
        )
    )
    bins = sized.groupBy("source", "bin").agg(F.sum("size").alias("in_bin"))
    starts = bins.select("source", "bin", (F.sum("in_bin").over(Window.partitionBy("source").orderBy("bin")) - F.col("in_bin")).alias("bin_start"))
    inside = Window.partitionBy("source", "bin").orderBy("h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = sized.withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    d, s = placed.alias("d"), starts.alias("s")
    placed = d.join(s, F.col("d.source").eqNullSafe(F.col("s.source")) & (F.col("d.bin") == F.col("s.bin"))).select(
        "d.doc_id", "d.source", "d.size", "d.h", (F.col("s.bin_start") + F.col("d.before")).alias("start")
    )
    return placed, bins.groupBy("source").agg(F.sum("in_bin").alias("source_size"))


def plan(by_source: DataFrame, block: int = 2048, least_slots: int = 1024, weights: tuple[int, ...] = (1, 2, 3), most: int = MOST) -> DataFrame:
    """Targets with each source's block size `b`, number of blocks `blocks` and its interval [lo, hi) of the points.

    A block has at most `block` words, and so few that a source gets about `least_slots` slots.
    """
    sized = targets(by_source, weights, most).withColumn("b", F.greatest(F.lit(1), F.least(F.lit(block), F.floor(F.col("target") / least_slots))).cast("long"))
    slots = sized.withColumns({"blocks": F.ceil(F.col("source_size") / F.col("b")), "slots": F.col("target") / F.col("b")})
    upto = F.sum("slots").over(Window.orderBy("k")) / F.nullif(F.sum("slots").over(Window.partitionBy()), F.lit(0.0))
    with_hi = slots.withColumn("hi", F.coalesce(upto, F.lit(0.0)) * PERIOD)
    return with_hi.withColumn("lo", F.coalesce(F.lag("hi").over(Window.orderBy("k")), F.lit(0.0)))


def schedule(planned: DataFrame, n_slots: int, run: int = 4096, most: int = MOST) -> DataFrame:
    """slot, k (the source), rank (of the slot in its source) and block, for each of the mix's slots.

    A point finds its interval by an equality join on cells of equal width, each of which lists the
    intervals that reach into it. Slots beyond `most` rounds of a stream aren't used.
    """
    spark = planned.sparkSession
    n_sources = max(1, planned.count())
    width = max(1, PERIOD // (4 * n_sources))
    cells = planned.where("hi > lo").select("k", "lo", "hi", "blocks", F.explode(F.expr(f"sequence(cast(floor(lo / {width}) as bigint), cast(floor(hi / {width}) as bigint))")).alias("cell"))
    points = (
        spark.range(n_slots)
        .select(F.col("id").alias("slot"), F.expr(f"((id % {PERIOD}) * {GOLDEN}) % {PERIOD}").alias("u"))
        .withColumn("cell", F.floor(F.col("u") / width))
    )
    hit = points.join(cells, "cell").where("u >= lo and u < hi").select("slot", "k", "blocks", F.floor(F.col("slot") / run).alias("run"))
    in_run = hit.groupBy("k", "run").agg(F.count(F.lit(1)).alias("n"))
    offsets = in_run.select("k", "run", (F.sum("n").over(Window.partitionBy("k").orderBy("run")) - F.col("n")).alias("offset"))
    local = hit.withColumn("i", F.row_number().over(Window.partitionBy("k", "run").orderBy("slot")) - 1)
    ranked = local.join(offsets, ["k", "run"]).withColumn("rank", F.col("offset") + F.col("i"))
    return ranked.where(F.col("rank") < F.col("blocks") * most).select("slot", "k", "rank", (F.col("rank") % F.col("blocks")).alias("block"))


def mix(docs: DataFrame, block: int = 2048, weights: tuple[int, ...] = (1, 2, 3), most: int = MOST, keys: bool = False) -> DataFrame:
    """doc_id, size, source, source_size, target, taken for each row of `docs`; with `keys` the hash h of id and text too.

    taken: the words of the document that lie in the blocks that the schedule takes, each as often
    as it is taken. Driver-side only the number of slots and of sources is read.
    """
    placed, by_source = _streams(docs)
    planned = settled(plan(by_source, block, weights=weights, most=most))
    n_slots = planned.agg(F.coalesce(F.ceil(F.sum("slots")), F.lit(0)).alias("n")).first()["n"]
    times = schedule(planned, int(n_slots), most=most).groupBy("k", "block").agg(F.count(F.lit(1)).alias("times"))
    p, s = placed.alias("p"), planned.alias("s")
    known = p.join(s, F.col("p.source").eqNullSafe(F.col("s.source"))).select(
        "p.doc_id", "p.size", "p.source", "p.h", "p.start", "s.source_size", "s.target", "s.k", "s.b"
    )
    known = known.withColumns({"first": F.floor(F.col("start") / F.col("b")), "last": F.floor((F.col("start") + F.col("size") - 1) / F.col("b"))})
    # the parts of a document carry their number only; what the document takes is joined by (k, start)
    parts = known.where("size > 0").select("k", "start", "size", "b", F.explode(F.expr("sequence(first, last)")).alias("block"))
    taken = (
        parts.join(times, ["k", "block"])
        .withColumn("words", (F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * F.col("b")) - F.greatest("start", F.col("block") * F.col("b"))) * F.col("times"))
        .groupBy("k", "start")
        .agg(F.sum("words").alias("taken"))
    )
    return (
        known.join(taken.withColumn("some", F.lit(True)), (known["k"] == taken["k"]) & (known["start"] == taken["start"]) & (known["size"] > 0), "left")
        .select("doc_id", "size", "source", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), *["h"] * keys)
    )


def repeated(docs: DataFrame, block: int = 2048, weights: tuple[int, ...] = (1, 2, 3), most: int = MOST) -> DataFrame:
    """Rows of `docs`, with all their columns, each as often as the mix takes its words (0 to `most` times).

    A document that the end of the schedule cuts stands once more if at least half of it is taken.
    Rows that repeat an id and a text share their copies evenly.
    """
    copies = settled(
        mix(docs, block, weights, most, keys=True)
        .where("size > 0")
        .groupBy("h", "doc_id")
        .agg(F.sum(F.floor(F.col("taken") / F.col("size") + 0.5)).cast("long").alias("copies"), F.count(F.lit(1)).alias("rows"))
        .where("copies > 0")
        .select(F.col("h").alias("ch"), F.col("doc_id").alias("cid"), "copies", "rows")
    )
    each = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), F.xxhash64(F.lit("mix"), "doc_id", "text").alias("h"))
    same = (F.col("h") == F.col("ch")) & F.col("id").eqNullSafe(F.col("cid"))
    once = each.join(copies.where("rows = 1"), same).select("row", "copies")
    # equal rows are counted, not ranked; different rows of one id and text share by running sums over their counts. A row is
    # known by the digest of its JSON text, as columns may be of types that can't be compared
    told = F.sha2(F.to_json("row", {"ignoreNullFields": "false"}), 256)
    several = each.join(copies.where("rows > 1"), same).withColumn("told", told).groupBy("told", "h", "id", "copies", "rows").agg(F.first("row").alias("row"), F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.partitionBy("h", "id").orderBy("told").rowsBetween(Window.unboundedPreceding, 0))
    share = F.floor(upto * F.col("copies") / F.col("rows")) - F.floor((upto - F.col("n")) * F.col("copies") / F.col("rows"))
    # many copies of one row leave in runs, which are dealt to all tasks
    runs = several.select("row", "told", share.alias("copies")).where("copies > 0").select("row", "told", "copies", F.explode(F.expr(f"sequence(0L, copies - 1, {RUN}L)")).alias("at"))
    dealt = runs.repartition(F.xxhash64("told", "at")).select("row", F.least(F.lit(RUN), F.col("copies") - F.col("at")).alias("copies"))
    return once.unionByName(dealt).select("row", F.explode(F.expr("array_repeat(1, cast(copies as int))"))).select("row.*")
