"""Runs one after another: what they read, what they write, and what a failure leaves."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from clickloom.operators import scaling, scoring
from clickloom.plans import config, pipeline, run
from clickloom.plans.pipeline import Models, run_sites
from clickloom.sources import ndjson, store, versions

from test_pipeline import COLS, DESKTOP, linear_models, record

OTHER = "0,0,0;a,5,5;a,z,z;a,9,1"


def lines(*recs):
    return "".join(json.dumps(r) + "\n" for r in recs)


def predictions(spark, out, device="desktop"):
    df = versions.upserted(spark, f"{out}/{device}/predictions")
    return {} if df is None else {(r["site_id"], r["session_id"]): r["probability_bot_umap"] for r in df.collect()}


@pytest.fixture
def place(tmp_path):
    (tmp_path / "logs").mkdir()
    (tmp_path / "out").mkdir()
    return tmp_path / "logs", tmp_path / "out"


def test_a_second_run_reads_the_new_bytes_only(spark, place, monkeypatch):
    logs, out = place
    log = logs / "1_1.json"
    log.write_text(lines(*(record(f"s{i}", 1000 + i, "qml", {"mmv": {"l": DESKTOP}}) for i in range(40))) + '{"half')
    read = []
    ranges = ndjson.read_ranges
    monkeypatch.setattr(store, "read_ranges", lambda spark, wanted, **o: (read.append(wanted), ranges(spark, wanted, **o))[1])
    one = run_sites(spark, str(logs), str(out), {"desktop": linear_models()}, "2024-01-01", "2024-01-01 00:00:00")
    whole = log.stat().st_size - len('{"half')
    assert one == {"desktop": 40} and one.read == whole and read.pop() == {"1_1": (str(log), 0, whole)}
    new = lines(record("s3", 2000, e={"mmv": {"l": OTHER}}), record("s3", 3000, "qml.ready"), record("new", 1, "qml", {"mmv": {"l": DESKTOP}}))
    log.write_text(log.read_text().removesuffix('{"half') + new)
    two = run_sites(spark, str(logs), str(out), {"desktop": linear_models()}, "2024-01-01", "2024-01-01 01:00:00")
    assert two == {"desktop": 2} and two.read == len(new) and read.pop() == {"1_1": (str(log), whole, whole + len(new))}
    three = run_sites(spark, str(logs), str(out), {"desktop": linear_models()}, "2024-01-01", "2024-01-01 02:00:00")
    assert three == {"desktop": 0} and three.read == 0 and not read
    full = place[1].parent / "full"
    run_sites(spark, str(logs), str(full), {"desktop": linear_models()}, "2024-01-01", "2024-01-01 00:00:00")
    assert predictions(spark, out) == predictions(spark, full) and len(predictions(spark, out)) == 41
    # every session carries the last run over its site in the history, scored by it or not
    assert {r["date"] for r in pipeline.device_history(spark, str(out), "desktop").collect()} == {"2024-01-01 02:00:00"}


def test_a_replaced_log_begins_anew(spark, place):
    logs, out = place
    log, args = logs / "1_1.json", (spark, str(logs), str(out), {"desktop": linear_models()})
    log.write_text(lines(record("a", 1000, "qml", {"mmv": {"l": DESKTOP}}), record("b", 1000, "qml", {"mmv": {"l": OTHER}})))
    run_sites(*args, "2024-01-01", "2024-01-01 00:00:00")
    before = predictions(spark, out)
    log.unlink()
    log.write_text(lines(record("a", 1000, "qml", {"mmv": {"l": OTHER}})) + " " * 300 + "\n")
    got = run_sites(*args, "2024-01-02", "2024-01-02 00:00:00")
    after = predictions(spark, out)
    assert got == {"desktop": 1} and got.read == log.stat().st_size
    assert after["1_1", "b"] == before["1_1", "b"] and after["1_1", "a"] == before["1_1", "b"] != before["1_1", "a"]  # none of a's old records counts
    assert store.Ledger.load(spark, f"{out}/ledger").sites["1_1"]["generation"] == 1


def test_a_run_that_stops_is_made_up_for(spark, place, monkeypatch):
    logs, out = place
    (logs / "1_1.json").write_text(lines(record("a", 1000, "qml", {"mmv": {"l": DESKTOP}})))
    args = (spark, str(logs), str(out), {"desktop": linear_models()}, "2024-01-01")
    save = store.Ledger.save
    monkeypatch.setattr(store.Ledger, "save", lambda *a: (_ for _ in ()).throw(OSError("stopped")))
    with pytest.raises(OSError):
        run_sites(*args, "2024-01-01 00:00:00")
    monkeypatch.setattr(store.Ledger, "save", save)
    assert run_sites(*args, "2024-01-01 01:00:00") == {"desktop": 0}  # its scores were published already
    assert spark.read.parquet(f"{out}/desktop/log").count() == 1 and store.records(spark, f"{out}/records", store.Ledger.load(spark, f"{out}/ledger")).count() == 1


def test_batches_are_merged(spark, place, monkeypatch):
    logs, out = place
    monkeypatch.setattr(store, "MERGE", 3)
    log = logs / "1_1.json"
    for i in range(4):
        with log.open("a") as f:
            f.write(lines(record("a", 1000 + i, e={"mmv": {"l": DESKTOP}}), record(f"s{i}", 1, "qml", {"mmv": {"l": DESKTOP}})))
        run_sites(spark, str(logs), str(out), {"desktop": linear_models()}, "2024-01-01", f"2024-01-01 0{i}:00:00")
    ledger = store.Ledger.load(spark, f"{out}/ledger")
    assert len(ledger.batches) == 2 and sorted(ledger.batches) == [n for n in versions.names(spark, f"{out}/records") if n.startswith("batch")]
    rows = store.records(spark, f"{out}/records", ledger).groupBy("session_id").count().collect()
    assert {r[0]: r[1] for r in rows} == {"a": 4, **{f"s{i}": 1 for i in range(4)}}


def test_500_sites_with_models_of_their_own_in_one_stage(spark, place):
    """One site's models fail: the others are published, and its sessions are scored once they work."""
    logs, out = place
    n = 500
    for i in range(n):
        (logs / f"1_{i}.json").write_text(lines(record("s", 1000, "qml", {"mmv": {"l": DESKTOP}})))
    own = {f"1_{i}": {"desktop": linear_models(0.05 + i / 10_000)} for i in range(n)}
    m = own["1_7"]["desktop"]
    own["1_7"] = {"desktop": Models(m.scaler | {"gone": {"scale": 1.0, "min": 0.0}}, m.projection, m.centroid)}
    got = run_sites(spark, str(logs), str(out), {}, "2024-01-01", "2024-01-01 00:00:00", own=own)
    assert got == {"desktop": n - 1} and list(got.failed) == ["1_7"] and "gone" in got.failed["1_7"] and not got.left_out
    scores = predictions(spark, out)
    assert len(scores) == n - 1 and len(set(scores.values())) > n / 2
    own["1_7"] = {"desktop": m}
    again = run_sites(spark, str(logs), str(out), {}, "2024-01-01", "2024-01-01 01:00:00", own=own)
    assert again == {"desktop": 1} and again.read == 0 and len(predictions(spark, out)) == n


def test_registry_scores_like_each_model_alone(spark):
    rows = [(f"1_{i % 3}", f"s{i}", i / 10, 5.0 - i, None) for i in range(30)]
    feats = spark.createDataFrame(rows, f"site_id string, session_id string, {COLS[0]} double, {COLS[1]} double, other double")
    trees = scoring.Trees(COLS, ({"feature": [0], "threshold": [1.4], "left": [-1], "right": [-2], "leaf": [1.0, -1.0]},), embedding=2)
    base = linear_models(0.3)
    sets = {"1_0": linear_models(0.01), "1_1": Models(base.scaler, base.projection, base.centroid, trees)}
    shared = linear_models(0.5)
    none = feats.limit(0)
    got = {(r[0], r[1]): tuple(r)[2:] for r in pipeline.score_sites(none, feats, pipeline.Registry(shared, sets)).collect()}
    for site in ("1_0", "1_1", "1_2"):
        m, here = sets.get(site, shared), feats.where(F.col("site_id") == site)
        scaled = scaling.scale(here, m.scaler, pipeline.KEY)
        bots = scoring.score_projection(scaled, m.projection, list(COLS), m.centroid, None, pipeline.KEY)
        for r in bots.collect():
            assert got[r["site_id"], r["session_id"]][0] == pytest.approx(r["probability_bot_umap"])
        want = {r["session_id"]: r["probability_lgbm"] for r in scoring.score_trees(scoring.tree_matrix(scaled, spark.createDataFrame([], "site_id string, session_id string, embedding array<float>"), trees, pipeline.KEY), trees, pipeline.KEY).collect()} if m.trees else {}
        for k, v in got.items():
            if k[0] == site:
                assert v[1] == (pytest.approx(want[k[1]]) if want else None) and v[2] is None


def test_own_models_without_shared_ones_and_sites_without_any(spark, place):
    logs, out = place
    for site in ("1_1", "1_2"):
        (logs / f"{site}.json").write_text(lines(record("s", 1000, "qml", {"mmv": {"l": DESKTOP}})))
    got = run_sites(spark, str(logs), str(out), {}, "2024-01-01", "2024-01-01 00:00:00", own={"1_2": {"desktop": linear_models()}})
    assert got == {"desktop": 1} and got.left_out == ["1_1"] and set(predictions(spark, out)) == {("1_2", "s")}
    later = run_sites(spark, str(logs), str(out), {"desktop": linear_models()}, "2024-01-01", "2024-01-01 01:00:00")
    assert later == {"desktop": 1} and set(predictions(spark, out)) == {("1_1", "s"), ("1_2", "s")}


def save_models(folder, slope=0.1):
    (folder / "desktop").mkdir(parents=True)
    m = linear_models(slope)
    (folder / "desktop" / "scaler.json").write_text(json.dumps(m.scaler))
    (folder / "desktop" / "centroid.json").write_text(json.dumps(m.centroid))
    (folder / "desktop" / "projection.json").write_text(json.dumps({"columns": COLS, "weights": m.projection.weights}))


def test_the_command_and_its_exit_code(spark, place, monkeypatch):
    logs, out = place
    models = logs.parent / "models"
    save_models(models)
    save_models(models / "1_2", 0.01)
    good = (models / "1_2" / "desktop" / "centroid.json").read_text()
    (models / "1_2" / "desktop" / "centroid.json").write_text("{")
    for site in ("1_1", "1_2", "1_3"):
        (logs / f"{site}.json").write_text(lines(record("s", 1000, "qml", {"mmv": {"l": DESKTOP}})))
    args = [str(logs), str(out), "--models", str(models), "--env", str(out / "none")]
    assert run.main([*args, "--exports", str(out / "text")]) == 1
    assert set(json.loads((out / "state.json").read_text())) == {"1_1", "1_3"} and set(predictions(spark, out)) == {("1_1", "s"), ("1_3", "s")}
    text = next((out / "text" / "desktop" / "delta.csv").glob("part*")).read_text().splitlines()
    assert text[0].startswith("site_id,session_id,") and len(text) == 3 and (out / "text" / "desktop" / "summary.csv").exists()
    (models / "1_2" / "desktop" / "centroid.json").write_text(good)
    with (logs / "1_3.json").open("a") as f:
        f.write(lines(record("t", 1000, "qml", {"mmv": {"l": DESKTOP}})))
    assert run.main([*args, "--sites", "1_2"]) == 0
    assert set(predictions(spark, out)) == {("1_1", "s"), ("1_2", "s"), ("1_3", "s")}
    assert run.changed_sites(run.log_state(str(logs)), str(out / "state.json")) == ["1_3"]  # the others' state stays
    assert run.main(args) == 0 and ("1_3", "t") in predictions(spark, out)


def test_a_run_whose_tables_are_on_another_file_system(spark, place):
    """OUT is in a mount table of Hadoop's, which no local path names; only lock and state are local."""
    logs, out = place
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.elsewhere.link./tables", f"file://{out}")
    save_models(logs.parent / "models")
    (logs / "1_1.json").write_text(lines(record("s", 1000, "qml", {"mmv": {"l": DESKTOP}})))
    args = [str(logs), "viewfs://elsewhere/tables/run", "--models", f"file://{logs.parent}/models", "--env", str(out / "none")]
    with pytest.raises(ValueError):
        run.main(args)
    args += ["--keep", str(logs.parent / "keep")]
    assert run.main(args) == 0
    assert set(predictions(spark, "viewfs://elsewhere/tables/run")) == {("1_1", "s")} == set(predictions(spark, str(out / "run")))
    with (logs / "1_1.json").open("a") as f:
        f.write(lines(record("t", 2000, "qml", {"mmv": {"l": DESKTOP}})))
    assert run.main(args) == 0 and set(predictions(spark, str(out / "run"))) == {("1_1", "s"), ("1_1", "t")}
    assert {x.name for x in (logs.parent / "keep").iterdir()} == {"state.json", "lock"}


def test_an_upsert_writes_the_buckets_it_touches(spark, tmp_path):
    path, key = str(tmp_path / "t"), ["k"]
    versions.upsert(spark, spark.range(2000).selectExpr("id as k", "0 as v"), path, key)
    size = lambda: {f: f.stat().st_size for f in (tmp_path / "t" / "data").rglob("*.parquet")}
    before = size()
    touched = versions.upsert(spark, spark.createDataFrame([(5, 1), (9999, 1)], "k long, v int").selectExpr("k", "v", "'new' as more"), path, key)
    written = {f: n for f, n in size().items() if f not in before}
    assert 1 <= len(touched) <= 2 and sum(written.values()) < 0.1 * sum(before.values())
    rows = {r["k"]: (r["v"], r["more"]) for r in versions.upserted(spark, path).collect()}
    assert len(rows) == 2001 and rows[5] == rows[9999] == (1, "new") and rows[6] == (0, None)
    near = versions.upserted(spark, path, spark.createDataFrame([(5,)], "k long"))
    assert 1 <= near.count() < 200 and near.where("k = 5").count() == 1
    assert versions.upserted(spark, str(tmp_path / "none")) is None
    # what a stopped upsert leaves isn't read
    (tmp_path / "t" / "data" / "at=9" / "bucket=0").mkdir(parents=True)
    assert versions.upserted(spark, path).count() == 2001


def test_debounce_by_site():
    d = run.Debounce(quiet=45, longest=120)
    d.changed("a", 0)
    d.changed("b", 30)
    assert d.due(44) == [] and d.due(45) == ["a"]
    d.changed("b", 70)  # each change begins the quiet time anew
    assert d.due(80) == []
    d.changed("b", 110)
    d.changed("b", 149)
    assert d.due(150) == ["b"]  # but not for longer than 120 s
    d.changed("a", 151)  # while it runs
    assert d.due(400) == []
    d.done(["a", "b"], 410)
    assert d.due(454) == [] and d.due(455) == ["a"] and d.running == {"a"}


def test_watching_with_a_clock_of_its_own():
    """Changes at given times, steps that take time and one that fails."""
    changes = {"a": [0, 100, 130], "b": [20]}
    now, ran = [0.0], []

    def step(sites):
        ran.append((now[0], sites))
        now[0] += 30
        if len(ran) == 2:
            raise ValueError("once")

    run.watch(
        lambda: {s: [sum(t <= now[0] for t in ts)] for s, ts in changes.items()}, step, run.Debounce(45, 120), every=5, rescan=10_000,
        rounds=60, sleep=lambda s: now.__setitem__(0, now[0] + s), clock=lambda: now[0],
    )
    assert [s for _, s in ran[:2]] == [["a"], ["b"]] and ran[0][0] == 45 and ran[1][0] == 80
    rest = [s for _, sites in ran[2:] for s in sites]
    assert sorted(set(rest)) == ["a", "b"]  # b again as its step failed, a as its log changed
    assert all(b[0] - a[0] >= 30 for a, b in zip(ran, ran[1:]))


def test_modes_leave_the_ledger_alone(spark, place):
    """A full run scores every session again, but reads no byte twice; a forced one reads the log again."""
    logs, out = place
    (logs / "1_1.json").write_text(lines(*(record(x, 1000, "qml", {"mmv": {"l": DESKTOP}}) for x in "ab")))
    args = (spark, str(logs), str(out), {"desktop": linear_models()}, "2024-01-01", "2024-01-01 00:00:00")
    assert run_sites(*args) == {"desktop": 2}
    full = run_sites(*args[:-1], "2024-01-01 01:00:00", config.Run(mode="full"))
    assert full == {"desktop": 2} and full.read == 0
    forced = run_sites(*args[:-1], "2024-01-01 02:00:00", config.Run(force=True))
    assert forced == {"desktop": 2} and forced.read == (logs / "1_1.json").stat().st_size
