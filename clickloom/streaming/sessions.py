"""Streaming shell: the same snapshots, and the same scores, from a log that grows.

One stateful operator, keyed by site and session, keeps what the batch plan gets from windows: the
device map and the last K records of each kind. Rows of a key are folded in the order of `seq`.
What comes out has whole trajectories; statistics and features are those of the batch plan.
State needs the RocksDB store (`spark.sql.streaming.stateStore.providerClass`).
"""

from __future__ import annotations

import datetime
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from clickloom.operators.decode import track
from clickloom.operators.features import upsert
from clickloom.operators.snapshots import Policy
from clickloom.operators.trajectory import track_stats
from clickloom.plans.config import Run
from clickloom.sources.ndjson import OFFSET_BITS, generation_of

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
OUT = """site_id string, device_type string, session_id string, seq long, tm double, ts double, ip string, ua string, type string, synthetic boolean,
  x array<double>, y array<double>, t array<double>, `groups` array<int>, scl_count int, scroll_data array<double>, generation int"""


#: State of a session: what routing and session ends need, and of each device the last records of each kind, a row each.
MARKS = "generation int, has_mb boolean, mapped boolean, desktop_ready boolean, desktop_qml double, mobile_ready boolean, mobile_qml double"
HISTORY = "tm double, clk boolean, x array<double>, y array<double>, t array<double>"
DEVICES = ("mobile", "desktop")


class Sessions(StatefulProcessor):
    """The last K records of each kind and the marks of a session. They are read once and written once for each batch of its rows.

    A session whose log was replaced begins anew: its rows carry another generation. ttl: ms after which the state of a session without rows is gone.
    """

    def __init__(self, policy: Policy, ttl: int | None = None):
        self.policy, self.ttl = policy, ttl

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.marks = handle.getValueState("marks", MARKS, self.ttl)
        self.lists = {(d, k): handle.getListState(f"{d}_{k}", HISTORY, self.ttl) for d in DEVICES for k in "pc"}

    def close(self) -> None:
        """Nothing is held outside the state."""

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows)).sort_values("seq")
        batch = [dict(zip(batch.columns, r, strict=True)) for r in zip(*(batch[c].tolist() for c in batch.columns), strict=True)]
        at = generation_of(int(batch[-1]["seq"]))
        batch = [r for r in batch if generation_of(int(r["seq"])) == at]
        got = self.marks.get() if self.marks.exists() else None
        if got is not None and got[0] != at:
            got = None
            for state in self.lists.values():
                state.clear()
        s = {"has_mb": bool(got and got[1]), "mapped": got[2] if got else None}
        for i, d in enumerate(DEVICES[::-1]):
            s[d] = {"p": self._held(d, "p"), "c": self._held(d, "c")}
            if got and got[3 + 2 * i]:
                s[d]["ready"] = True
            if got and got[4 + 2 * i] is not None:
                s[d]["first_qml"] = got[4 + 2 * i]
        self._map(s, batch)
        out, touched = [], {}
        for r in batch:
            if not r["tm"] or r["tm"] != r["tm"]:
                continue
            device = self._device(s, r)
            touched[device] = r
            out += [self._row(key, device, r, *made) for made in self._fold(s[device], device, r)]
        if self.policy.synthetic:
            for device, r in touched.items():
                h = s[device]
                first = device == "desktop" and not h.get("ready") and "first_qml" in h
                cutoff = r["tm"] + first
                made = self._made(h["p"], [x for x in h["c"] if x["tm"] < cutoff], cutoff)
                out.append(self._row(key, device, r | {"tm": cutoff, "ts": None, "ip": None, "ua": ""}, "qml_ready", *made, True))
        marks = [x for d in DEVICES[::-1] for x in (bool(s[d].get("ready")), s[d].get("first_qml"))]
        self.marks.update((at, s["has_mb"], s["mapped"], *marks))
        for d in touched:
            for k in "pc":
                if s[d][k]:
                    self.lists[d, k].put([(x["tm"], x["clk"], *(list(c) for c in zip(*x["points"]))) if x["points"] else (x["tm"], x["clk"], [], [], []) for x in s[d][k]])
        if out:
            yield pd.DataFrame(out)

    def _held(self, device: str, kind: str) -> list[dict]:
        state = self.lists[device, kind]
        return [{"tm": tm, "clk": clk, "points": [list(q) for q in zip(x, y, t)]} for tm, clk, x, y, t in state.get()] if state.exists() else []

    def _map(self, s: dict, batch: list[dict]) -> None:
        touch = False
        for r in batch:
            known = r["mb"] is not None and r["mb"] == r["mb"]
            s["has_mb"] |= known
            touch |= bool(r["touch"])
            if known and r["act"] == "qml.ready":
                s["mapped"] = bool(r["mb"])
        if touch and not s["has_mb"]:
            s["mapped"] = True

    def _device(self, s: dict, r: dict) -> str:
        known = r["mb"] is not None and r["mb"] == r["mb"]
        mobile = s["mapped"] if s["mapped"] is not None else bool(r["mb"]) if known else (not s["has_mb"] and bool(r["touch"]))
        return "mobile" if mobile else "desktop"

    def _fold(self, h: dict, device: str, r: dict) -> Iterator[tuple]:
        most = getattr(self.policy, device)
        pointer = r["touch_points"] if device == "mobile" else r["pointer_points"]
        if r["scroll_points"] is not None:
            h["c"] = (h["c"] + [{"tm": r["tm"], "clk": False, "points": _list(r["scroll_points"])}])[-most:]
        if pointer is not None:
            h["p"] = (h["p"] + [{"tm": r["tm"], "clk": bool(r["clk"]), "points": _list(pointer)}])[-most:]
        if r["act"] == "qml.ready":
            h["ready"] = True
        elif r["act"] == "qml":
            h.setdefault("first_qml", r["tm"])
        if device == "desktop" and r["clk"] and pointer is not None:
            p, tm = h["p"], r["tm"]
            at = max((j for j, x in enumerate(p) if x["clk"] and x["tm"] < tm), default=-1)
            loose = [x for j, x in enumerate(p) if j > at and not x["clk"] and x["tm"] < tm and (j == 0 or p[j - 1]["clk"])]
            since = p[at]["tm"] if at >= 0 else 0
            scrolls = [x for x in h["c"] if since < x["tm"] < tm]
            before = loose[::-1] + p[: at + 1]
            points = [q for x in before + scrolls for q in x["points"]] + _list(pointer)
            groups = [len(x["points"]) for x in before if x["points"]] + [len(pointer)]
            yield ("mmv_clk", points, groups, scrolls)
        if r["act"] == "qml.ready":
            yield ("qml_ready", *self._made(h["p"], [x for x in h["c"] if x["tm"] < r["tm"]], r["tm"]))

    def _made(self, pointers: list[dict], scrolls: list[dict], cutoff: float) -> tuple[list, list, list]:
        before = [x for x in pointers if x["tm"] < cutoff]
        return [q for x in before + scrolls for q in x["points"]], [len(x["points"]) for x in before if x["points"]], scrolls

    def _row(self, key: tuple, device: str, r: dict, kind: str, points: list, groups: list, scrolls: list, synthetic: bool = False) -> dict:
        x, y, t = ([q[i] for q in points] for i in range(3))
        deltas = [s["points"][-1][1] - s["points"][0][1] for s in scrolls if len(s["points"]) > 1 and None not in (s["points"][-1][1], s["points"][0][1])]
        return {
            "site_id": key[0], "device_type": device, "session_id": key[1], "seq": int(r["seq"]) % (1 << OFFSET_BITS), "tm": r["tm"], "ts": r["ts"], "ip": r["ip"], "ua": r["ua"], "type": kind,
            "synthetic": synthetic, "x": x, "y": y, "t": t, "groups": [] if synthetic else groups, "scl_count": sum(len(s["points"]) for s in scrolls), "scroll_data": deltas,
            "generation": generation_of(int(r["seq"])),
        }


def _list(points: object) -> list[list[float | None]]:
    """Points as [x, y, tm]; unknown numbers are None."""
    out = []
    for q in points:
        q = q if isinstance(q, dict) else q.asDict()
        out.append([None if v is None or v != v else float(v) for v in (q["x"], q["y"], q["tm"])])
    return out


def trajectories(records: DataFrame, policy: Policy = Policy(), ttl: int | None = None) -> DataFrame:
    """Snapshots with their trajectories from a stream of typed records; of a record's click and page-ready one `with_statistics` chooses.

    ttl: ms of processing time after which the state of a session without records is dropped; None keeps it.
    """
    rows = records.where("session_id is not null").select(
        "site_id", "session_id", "seq", "act", "tm", "ts", "ip", "ua", "clk", "touch", "mb",
        track("mmv", "tm", "pointer").alias("pointer_points"), track("tmv", "tm", "touch").alias("touch_points"), track("scl", "tm", "scroll").alias("scroll_points"),
    )
    return rows.groupBy("site_id", "session_id").transformWithStateInPandas(Sessions(policy, ttl), OUT, outputMode="Update", timeMode="None" if ttl is None else "ProcessingTime")


def with_statistics(rows: DataFrame) -> DataFrame:
    """The batch plan's snapshot columns from `trajectories`' rows; those of fewer than three points go.

    A click counts as page-ready record if it is one and its own trajectory is too short.
    """
    s = track_stats(F.col("x"), F.col("y"), F.col("t"), F.col("groups"), F.col("device_type"))
    whole = rows.withColumn("s", s).where("s.n is not null").drop("x", "y", "t", "groups")
    rank = F.row_number().over(Window.partitionBy("site_id", "device_type", "session_id", "seq", "synthetic").orderBy(F.col("type") != "mmv_clk"))
    return whole.withColumn("_r", rank).where("_r = 1").drop("_r")


def latest_synthetic(snaps: DataFrame) -> DataFrame:
    """Of a session's session-end snapshots only the last counts; others all do."""
    key = ["site_id", "device_type", "session_id"]
    last = snaps.where("synthetic").groupBy(*key).agg(F.max("seq").alias("_last"))
    return snaps.join(last, key, "left").where("not synthetic or seq = _last").drop("_last")


def started(writer: DataStreamWriter, every: str | None) -> StreamingQuery:
    """every: a processing-time trigger such as '45 seconds'; else what is there now is worked off and the query ends."""
    return writer.trigger(processingTime=every).start() if every else writer.trigger(availableNow=True).start()


def publish_stream(rows: DataFrame, checkpoint: str, sink: Callable[[DataFrame, int], None], every: str | None = None) -> StreamingQuery:
    """Starts the query: each micro-batch of trajectories goes to `sink` once its statistics are there."""
    writer = rows.writeStream.option("checkpointLocation", checkpoint).outputMode("update").foreachBatch(lambda df, n: sink(with_statistics(df), n))
    return started(writer, every)


def publish_sites(lines: DataFrame, out: str, models: dict, run: Run = Run(), own: dict | None = None, every: str | None = None, now: Callable[[], datetime.datetime] = datetime.datetime.now) -> StreamingQuery:
    """From a stream of log lines to scores: each micro-batch adds its records, and the sessions that it touched are scored and published.

    The tables under `out` are those of `plans.pipeline.run_sites`, and a batch is worked off exactly once: its records, change log and
    ledger are named by its number, and a batch that the ledger knows is left out. The checkpoint is under `out`, too.
    """
    from clickloom.plans.pipeline import publish_batch

    def sink(df: DataFrame, n: int) -> None:
        at = now()
        publish_batch(df.sparkSession, df, n, out, models, f"{at:%Y-%m-%d}", f"{at:%Y-%m-%d %H:%M:%S}", run, own)

    return started(lines.writeStream.option("checkpointLocation", f"{out}/checkpoint").outputMode("append").foreachBatch(sink), every)


def upsert_features(existing: DataFrame, snaps: DataFrame, features: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Features of the sessions that a micro-batch touched replace their old rows."""
    return upsert(existing, features(latest_synthetic(snaps)), ["site_id", "device_type", "session_id"])
