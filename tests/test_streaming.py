from __future__ import annotations

import json


from clickloom.operators.snapshots import Policy, snapshots
from clickloom.plans.pipeline import log_records
from clickloom.sources.events import parse
from clickloom.sources.ndjson import read_logs, stream_logs
from clickloom.streaming.sessions import latest_synthetic, publish_stream, trajectories

from test_pipeline import DESKTOP, TOUCH, record


def test_stream_in_two_runs_equals_batch(spark, tmp_path):
    recs = []
    for i in range(30):
        s, tm = f"s{i % 3}", 1000 + 100 * i
        kind = i // 3 % 5
        e = {0: {"mmv": {"l": DESKTOP}}, 1: {"scl": {"l": "0,0,0;a,0,9"}}, 2: {"mmv": {"l": DESKTOP}, "clk": 1}, 3: {"tmv": {"l": TOUCH}} if s == "s2" else {}, 4: {}}[kind]
        recs.append(record(s, tm, "qml.ready" if kind == 4 else "track", e))
    # a click with too few points of its own counts as the page-ready record that it is
    recs += [record("s7", 5000, e={"mmv": {"l": "0,a,a"}}), record("s7", 5100, e={"mmv": {"l": DESKTOP}}), record("s7", 5200, "qml.ready", {"mmv": {"l": "0,5,5"}, "clk": 1})]
    logs, seen = tmp_path / "logs", tmp_path / "seen"
    logs.mkdir()
    policy = Policy(synthetic=False)
    data = [json.dumps(r) + "\n" for r in recs]

    def sink(df, _):
        df.write.mode("append").parquet(str(seen))

    for part in (data[:17] + [data[17][:9]], [data[17][9:], *data[18:]]):
        with (logs / "1_1.json").open("a") as f:
            f.write("".join(part))
        q = publish_stream(trajectories(parse(stream_logs(spark, str(logs))), policy), str(tmp_path / "cp"), sink)
        q.awaitTermination(120)
        assert q.exception() is None
    key = lambda df: sorted((r["session_id"], r["device_type"], r["seq"], r["type"], r["scl_count"], round(r["s"]["bot_score"], 9), r["s"]["n"]) for r in df.collect())
    want = [r for r in key(snapshots(log_records(read_logs(spark, str(logs))), policy)) if r[0] != "s2"]
    got = [r for r in key(spark.read.parquet(str(seen))) if r[0] != "s2"]  # s2 turns mobile late: a stream doesn't move what is written
    assert got == want and len(want) > 3 and ("s7", "qml_ready") in {(r[0], r[3]) for r in got}


def test_latest_synthetic(spark):
    df = spark.createDataFrame([("x", "d", "s", 1, True), ("x", "d", "s", 2, True), ("x", "d", "s", 0, False)], "site_id string, device_type string, session_id string, seq long, synthetic boolean")
    assert sorted(r["seq"] for r in latest_synthetic(df).collect()) == [0, 2]


def drained(query):
    query.awaitTermination(120)
    assert query.exception() is None
    return query


def test_state_stays_flat_and_a_replaced_log_begins_anew(spark, tmp_path):
    """Ten thousand records of a session leave K rows of each kind and one of marks; after the log is replaced the old ones are forgotten."""
    logs, seen = tmp_path / "logs", tmp_path / "seen"
    logs.mkdir()
    log, policy = logs / "1_1.json", Policy(synthetic=False)

    def run(recs):
        with log.open("a") as f:
            f.write("".join(json.dumps(r) + "\n" for r in recs))
        return drained(publish_stream(trajectories(parse(stream_logs(spark, str(logs))), policy), str(tmp_path / "cp"), lambda df, _: df.write.mode("append").parquet(str(seen))))

    kinds = ({"mmv": {"l": DESKTOP}}, {"scl": {"l": "0,0,0;a,0,9"}})
    sizes = []
    for part in range(2):
        q = run([record("s", 1000 + 10 * i, e=kinds[i % 2]) for i in range(5000 * part, 5000 * part + 5000)])
        sizes.append(sum(x["numRowsTotal"] for x in q.lastProgress["stateOperators"]))
    assert sizes[0] == sizes[1] <= 2 * policy.desktop + 5
    log.unlink()
    run([record("s", 1_000_000, e={"mmv": {"l": "0,1,1;a,9,9;a,z,1"}}), record("s", 1_000_100, "qml.ready")])
    (got,) = spark.read.parquet(str(seen)).where("type = 'qml_ready'").collect()
    assert got["s"]["n"] == 3 and got["scl_count"] == 0


def test_sessions_without_rows_expire(spark, tmp_path):
    import time

    logs = tmp_path / "logs"
    logs.mkdir()
    log = logs / "1_1.json"

    def run(recs, ttl, name):
        with log.open("a") as f:
            f.write("".join(json.dumps(r) + "\n" for r in recs))
        drained(publish_stream(trajectories(parse(stream_logs(spark, str(logs))), Policy(synthetic=False), ttl), str(tmp_path / f"cp{name}"), lambda df, _: df.write.mode("append").parquet(str(tmp_path / f"seen{name}"))))

    first, second = [record("s", 1000, e={"mmv": {"l": DESKTOP}})], [record("s", 2000, e={"mmv": {"l": "0,z,z;a,1,1;a,9,9"}}), record("s", 3000, "qml.ready")]
    run(first, 1000, "short")
    run([], 3_600_000, "long")
    time.sleep(2.5)
    with log.open("a") as f:
        f.write("".join(json.dumps(r) + "\n" for r in second))
    run([], 1000, "short")
    run([], 3_600_000, "long")
    n = {name: spark.read.parquet(str(tmp_path / f"seen{name}")).where("type = 'qml_ready'").first()["s"]["n"] for name in ("short", "long")}
    assert n == {"short": 3, "long": 8}


def test_a_stopped_stream_ends_with_the_tables_of_a_batch_run(spark, tmp_path, monkeypatch):
    import datetime

    from clickloom.plans import pipeline
    from clickloom.sources import store
    from clickloom.sources.versions import upserted
    from clickloom.streaming.sessions import publish_sites

    from test_pipeline import linear_models

    logs, out, batch = tmp_path / "logs", tmp_path / "out", tmp_path / "batch"
    for d in (logs, out, batch):
        d.mkdir()
    parts = [
        [record(x, 1000 + i, "qml", {"mmv": {"l": DESKTOP}}, ip=f"1.1.1.{i}") for i, x in enumerate("abc")],
        [record("b", 2000, e={"mmv": {"l": "0,0,0;a,5,5;a,z,z;a,9,1"}}), record("b", 3000, "qml.ready"), record("d", 3500, "qml", {"mmv": {"l": DESKTOP}})],
        [record("a", 4000, "qml.ready", {"scl": {"l": "0,0,0;a,0,9"}})],
    ]
    models, at = {"desktop": linear_models()}, datetime.datetime(2024, 1, 1)

    def stream():
        return publish_sites(stream_logs(spark, str(logs)), str(out), models, now=lambda: at)

    save = store.Ledger.save
    for i, recs in enumerate(parts):
        with (logs / "1_1.json").open("a") as f:
            f.write("".join(json.dumps(r) + "\n" for r in recs))
        if i == 1:  # stops after everything but the ledger is written
            monkeypatch.setattr(store.Ledger, "save", lambda *a: (_ for _ in ()).throw(OSError("stopped")))
            q = stream()
            try:
                q.awaitTermination(120)
            except Exception:  # noqa: BLE001
                pass
            assert q.exception() is not None
            monkeypatch.setattr(store.Ledger, "save", save)
        drained(stream())
    pipeline.run_sites(spark, str(logs), str(batch), models, "2024-01-01", "2024-01-01 00:00:00")
    rows = lambda p, *columns: sorted(map(tuple, upserted(spark, p).select(*columns).collect()), key=str)
    key = ("site_id", "session_id")
    assert rows(f"{out}/desktop/predictions", *key, *pipeline.scoring.SCORES) == rows(f"{batch}/desktop/predictions", *key, *pipeline.scoring.SCORES)
    assert rows(f"{out}/desktop/history", *key, "ip", "date", "probability_bot_umap") == rows(f"{batch}/desktop/history", *key, "ip", "date", "probability_bot_umap")
    log = [tuple(r) for r in spark.read.parquet(f"{out}/desktop/log").select("session_id", "probability_bot_umap").collect()]
    assert len(log) == len(set(log)) and {x[0] for x in log} == set("abcd")  # nothing stands twice
    assert pipeline.publish_batch(spark, spark.createDataFrame([], "site_id string, seq long, line string"), 0, str(out), models, "2024-01-01", "x") is None
