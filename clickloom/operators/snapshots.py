"""Snapshots: page-ready, click and session-end summaries over the last K records of each kind.

Records of a kind are numbered in arrival order. A snapshot lists the numbers that its history can
hold, at most K of each kind, and finds the records by an equality join on session and number: no
range join, and no list grows with the session.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .decode import track
from .trajectory import track_stats

KEY = ["site_id", "device_type", "session_id"]
HISTORY = {"mobile": 10, "desktop": 5}
POINTS = "array<struct<x:double,y:double,tm:double>>"


@dataclass(frozen=True)
class Policy:
    """mobile, desktop: records of each kind that count; synthetic: emit session-end snapshots; two_phase: the rules of
    the extract-and-process mode (clicks take scrolls of the ten seconds before; no session ends on mobile, on a desktop
    only after the last page-ready record)."""

    mobile: int = HISTORY["mobile"]
    desktop: int = HISTORY["desktop"]
    synthetic: bool = True
    two_phase: bool = False

    def history(self) -> Column:
        return F.when(F.col("device_type") == "mobile", self.mobile).otherwise(self.desktop)


#: Bytes of the log, as a power of two, whose records are numbered in one task.
BLOCK_BITS = 24


def numbered(records: DataFrame, bits: int = BLOCK_BITS) -> DataFrame:
    """Records with a session and an event time, with the numbers so far of pointer and scroll records.

    A session is numbered in blocks of the log: inside each by a window, and from block to block by what the blocks before
    have, a row a block. So a session that never ends is spread over tasks.
    """
    pointer = F.when(F.col("device_type") == "mobile", F.col("tmv")).otherwise(F.col("mmv"))
    own = records.where("session_id is not null and tm != 0").withColumns({"pointer": pointer, "_block": F.shiftright("seq", bits)})
    counts = {"n_pointer": F.count("pointer"), "n_scroll": F.count("scl")}
    inside = Window.partitionBy(*KEY, "_block").orderBy("seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy(*KEY).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = own.groupBy(*KEY, "_block").agg(*(c.alias(f"_{n}") for n, c in counts.items()))
    offsets = blocks.select(*KEY, "_block", *(F.coalesce(F.sum(f"_{n}").over(before), F.lit(0)).alias(f"_{n}") for n in counts))
    plus = {n: F.col(n) + F.coalesce(f"_{n}", F.lit(0)) for n in counts}
    later = offsets.where(" + ".join(f"_{n}" for n in counts) + " > 0")
    return own.withColumns({n: c.over(inside) for n, c in counts.items()}).join(later, [*KEY, "_block"], "left").withColumns(plus).drop("_block", *(f"_{n}" for n in counts))


LOOKBACK_MS = 10_000


def session_ends(own: DataFrame, two_phase: bool = False) -> DataFrame:
    """One row a session: cutoff, reason and numbers of its last record.

    A desktop session that began with `qml` and never was ready counts its last record too; in two phases any with `qml` does.
    """
    ends = own.groupBy(*KEY).agg(
        F.max_by(F.struct("tm", "n_pointer", "n_scroll"), "seq").alias("last"),
        F.bool_or(F.coalesce(F.col("act") == "qml.ready", F.lit(False))).alias("was_ready"),
        F.min_by(F.when(F.col("act") == "qml", F.col("tm")), F.when(F.col("act") == "qml", F.col("seq"))).alias("first_qml"),
        F.max("seq").alias("seq"),
        F.max_by(F.when(F.col("act") == "qml.ready", F.col("tm")), F.when(F.col("act") == "qml.ready", F.col("seq"))).alias("last_ready"),
    )
    if two_phase:
        ends = ends.where((F.col("device_type") == "desktop") & (F.col("last_ready").isNull() | (F.col("last_ready") < F.col("last.tm"))))
        ends = ends.withColumn("was_ready", F.lit(False))
    first = (F.col("device_type") == "desktop") & ~F.col("was_ready") & F.col("first_qml").isNotNull()
    return ends.select(
        *KEY, "seq", (F.col("last.tm") + first.cast("int")).alias("tm"), F.lit(None).cast("double").alias("ts"), F.lit(None).cast("string").alias("ip"), F.lit("").alias("ua"),
        F.lit("qml_ready").alias("type"), F.lit(True).alias("synthetic"),
        F.when(first, "first_qml_session_end").otherwise("session_end_or_no_next_ready").alias("synthetic_reason"),
        F.when(first, F.col("first_qml")).alias("first_qml_tm"), "last.n_pointer", "last.n_scroll",
    )


def wanted(own: DataFrame, policy: Policy) -> DataFrame:
    """A row for each snapshot to be tried: clicks on a desktop, page-ready records, and session ends."""
    click = (F.col("device_type") == "desktop") & F.col("clk") & F.col("pointer").isNotNull()
    ready = F.coalesce(F.col("act") == "qml.ready", F.lit(False))
    kinds = F.array_compact(F.array(F.when(click, "mmv_clk"), F.when(ready, "qml_ready")))
    plain = own.where(click | ready).select(
        *KEY, "seq", "tm", "ts", "ip", "ua", F.explode(kinds).alias("type"), F.lit(False).alias("synthetic"), F.lit(None).cast("string").alias("synthetic_reason"),
        F.lit(None).cast("double").alias("first_qml_tm"), "n_pointer", "n_scroll",
    )
    return plain.unionByName(session_ends(own, policy.two_phase)) if policy.synthetic else plain


def _histories(snaps: DataFrame, records: DataFrame, policy: Policy) -> DataFrame:
    """(KEY, seq, type, synthetic, p, c): the last K pointer and scroll records, each as an array ordered by number.

    records: KEY, kind (p or c), i and r, the record. Both kinds are found by one join.
    """
    ident = [*KEY, "seq", "type", "synthetic"]
    k = policy.history()

    def last(n: str, kind: str) -> Column:
        numbers = F.sequence(F.greatest(F.lit(1), F.col(n) - k + 1).cast("long"), F.greatest(F.lit(1), F.col(n)))
        return F.transform(numbers, lambda i: F.struct(F.lit(kind).alias("kind"), i.alias("i")))

    either = F.explode(F.concat(last("n_pointer", "p"), last("n_scroll", "c"))).alias("h")
    listed = snaps.select(*ident, "n_pointer", "n_scroll", either).where("h.i <= if(h.kind = 'p', n_pointer, n_scroll)").select(*ident, "h.kind", "h.i")
    found = listed.join(records, [*KEY, "kind", "i"])
    return found.groupBy(*ident).agg(*(F.array_sort(F.collect_list(F.when(F.col("kind") == x, F.col("r")))).alias(x) for x in ("p", "c")))


# Positions are from 0; `p` is the pointer history, which holds the current record if it has a track.
_PREVIOUS = "array_max(transform(p, (r, j) -> case when r.clk and r.tm < tm then j end))"
#: The records of an earlier click's track: those up to the nearest earlier click, but first those after it that stand
#: at position 0 or right after a click, from the latest to the earliest.
_BEFORE_CLICK = f"""transform(array({_PREVIOUS}), c -> concat(
    reverse(filter(transform(p, (r, j) -> case when not r.clk and r.tm < tm and j > coalesce(c, -1) and (j = 0 or get(p, j - 1).clk) then r end), r -> r is not null)),
    case when c is null then slice(p, 1, 0) else slice(p, 1, c + 1) end))[0]"""


def snapshots(records: DataFrame, policy: Policy = Policy()) -> DataFrame:
    """One row for each snapshot whose trajectory has three points or more.

    Columns: KEY, seq, tm, ts, ip, ua, type, synthetic, synthetic_reason, first_qml_tm, scl_count, scroll_data, s (struct
    of trajectory statistics). A click whose trajectory is too short counts as page-ready record if it is one.
    """
    own = numbered(records)
    snaps = wanted(own, policy)
    layout = F.when(F.col("device_type") == "mobile", track("pointer", "tm", "touch")).otherwise(track("pointer", "tm", "pointer"))
    kinds = {"p": ("pointer", "n_pointer", layout), "c": ("scl", "n_scroll", track("scl", "tm", "scroll"))}
    tracks = F.array(*(F.when(F.col(has).isNotNull(), F.struct(F.lit(kind).alias("kind"), F.col(n).alias("i"), points.alias("points"))) for kind, (has, n, points) in kinds.items()))
    each = own.where("pointer is not null or scl is not null").select(*KEY, "tm", "clk", F.explode(F.array_compact(tracks)).alias("t"))
    records = each.select(*KEY, "t.kind", "t.i", F.struct("t.i", "tm", "clk", "t.points").alias("r"))
    ident = [*KEY, "seq", "type", "synthetic"]
    full = snaps.join(_histories(snaps, records, policy), ident, "left")
    none = "cast(array() as array<struct<i:bigint,tm:double,clk:boolean,points:array<struct<x:double,y:double,tm:double>>>>)"
    full = full.withColumns({"p": F.expr(f"coalesce(p, {none})"), "c": F.expr(f"coalesce(c, {none})")})
    is_click = F.col("type") == "mmv_clk"
    before = F.when(is_click, F.expr(_BEFORE_CLICK)).otherwise(F.expr("filter(p, r -> r.tm < tm)"))
    since = F.when(is_click, F.expr("coalesce(array_max(transform(filter(p, r -> r.clk and r.tm < tm), r -> r.i)), -1)"))
    full = full.withColumns({"before": before, "since_i": since})
    full = full.withColumn("since", F.expr("case when type = 'mmv_clk' then coalesce(get(transform(filter(p, r -> r.i = since_i), r -> r.tm), 0), 0D) end"))
    if policy.two_phase:
        full = full.withColumn("since", F.when(is_click, F.col("tm") - LOOKBACK_MS))
    full = full.withColumn("scrolled", F.expr("filter(c, r -> r.tm < tm and (since is null or r.tm > since))"))
    current = F.when(is_click, F.expr("element_at(p, -1).points")).otherwise(F.expr(f"cast(array() as {POINTS})"))
    full = full.withColumn("current", current)
    full = full.withColumn("points", F.expr("concat(flatten(transform(before, r -> r.points)), flatten(transform(scrolled, r -> r.points)), current)"))
    groups = F.expr("filter(concat(transform(before, r -> size(r.points)), case when type = 'mmv_clk' then array(size(current)) else cast(array() as array<int>) end), n -> n > 0)")
    groups = F.when(F.col("synthetic"), F.expr("cast(array() as array<int>)")).otherwise(groups)
    out = full.withColumn("s", track_stats(F.expr("transform(points, q -> q.x)"), F.expr("transform(points, q -> q.y)"), F.expr("transform(points, q -> q.tm)"), groups, F.col("device_type")))
    out = out.where("s.n is not null").select(
        *KEY, "seq", "tm", "ts", "ip", "ua", "type", "synthetic", "synthetic_reason", "first_qml_tm",
        F.expr("size(flatten(transform(scrolled, r -> r.points)))").alias("scl_count"),
        F.expr("filter(transform(scrolled, r -> case when size(r.points) > 1 then element_at(r.points, -1).y - r.points[0].y end), v -> v is not null)").alias("scroll_data"), "s",
    )
    # of one record, the click snapshot comes before the page-ready one
    rank = F.row_number().over(Window.partitionBy(*KEY, "seq", "synthetic").orderBy(F.col("type") != "mmv_clk"))
    return out.withColumn("_r", rank).where("_r = 1").drop("_r")
