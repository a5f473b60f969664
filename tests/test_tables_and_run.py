from __future__ import annotations

import json

import pytest

from clickloom.operators.snapshots import Policy, snapshots
from clickloom.plans import run
from clickloom.plans.pipeline import log_records
from clickloom.sources import tables

from test_pipeline import DESKTOP, logs, record


def test_predictions_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("007", 1 / 3, None), ("b", 1.0, 0.25)], "session_id string, probability_bot_umap double, probability_lgbm double")
    tables.write_csv(df, str(tmp_path / "p.csv"))
    text = next((tmp_path / "p.csv").glob("part*")).read_text().split()
    assert text == ["session_id,probability_bot_umap,probability_lgbm", "007,0.3333333333,", "b,1,0.25"]
    got = sorted(map(tuple, tables.read_predictions(spark, str(tmp_path / "p.csv")).collect()))
    assert got == [("007", 0.3333333333, None), ("b", 1.0, 0.25)]
    (tmp_path / "q.csv").write_text("session_id,probability_bot_umap\na,nan\nb,<NA>\nc,0.5\n")
    assert [r[1] for r in tables.read_predictions(spark, str(tmp_path / "q.csv")).orderBy("session_id").collect()] == [None, None, 0.5]
    assert tables.read_predictions(spark, str(tmp_path / "none")).collect() == []
    with pytest.raises(FileNotFoundError):
        tables.read_predictions(spark, str(tmp_path / "none"), required=True)


def test_changed_sets(spark, tmp_path):
    path = str(tmp_path / "c.json")
    assert tables.read_changed(spark, path) == (None, True)
    tables.write_changed(spark.createDataFrame([("b",), ("a",), ("a",)], "session_id string"), path)
    assert json.loads(open(path).read()) == {"full_rebuild": False, "session_ids": ["a", "b"]}
    df, full = tables.read_changed(spark, path)
    assert not full and sorted(r[0] for r in df.collect()) == ["a", "b"]
    (tmp_path / "l.json").write_text("[1]")
    assert tables.read_changed(spark, str(tmp_path / "l.json"))[0].first()[0] == "1"
    (tmp_path / "x.json").write_text("{")
    assert tables.read_changed(spark, str(tmp_path / "x.json")) == (None, True)


def test_other_tables(spark, tmp_path):
    (tmp_path / "a.json").write_text('[\n{"x": 1},\n{"x": 2}]')
    assert [r[0] for r in tables.read_json_array(spark, str(tmp_path / "a.json"), "x int").orderBy("x").collect()] == [1, 2]
    assert tables.read_json_array(spark, str(tmp_path / "n.json"), "x int").collect() == []
    (tmp_path / "f.csv").write_text("session_id,a\n01,2\n02,x\n")
    assert sorted(map(tuple, tables.read_features(spark, str(tmp_path / "f.csv"), ["a", "b"]).collect())) == [("01", 2.0, None), ("02", None, None)]
    for day in ("1", "2"):
        (tmp_path / f"predictions_{day}.csv").write_text(f"session_id,ip\ns,{day}\n")
    assert [(r["file"], r["ip"]) for r in tables.read_history(spark, str(tmp_path)).orderBy("file").collect()] == [("predictions_1.csv", "1"), ("predictions_2.csv", "2")]
    df = spark.createDataFrame([("s", 0.5)], "session_id string, v double")
    assert tables.write_delta(df, str(tmp_path / "d")) and (tmp_path / "d").exists()
    assert not tables.write_delta(df.limit(0), str(tmp_path / "d")) and not (tmp_path / "d").exists()
    assert tables.write_summary(df.selectExpr("count(*) as n"), str(tmp_path / "s.json")) == {"n": 1} == json.loads((tmp_path / "s.json").read_text())


def test_tables_on_a_mounted_file_system(spark, tmp_path):
    """Everything of `tables` works where paths are no local ones: a mount table of Hadoop's stands for another file system."""
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.made-up.link./data", f"file://{tmp_path}")
    at = "viewfs://made-up/data"
    assert tables.read_changed(spark, f"{at}/c.json") == (None, True) and tables.read_history(spark, f"{at}/none").collect() == []
    for ids in ("ba", "c"):  # written over
        tables.write_changed(spark.createDataFrame([(x,) for x in ids], "session_id string"), f"{at}/c.json", full=ids == "c")
    df, full = tables.read_changed(spark, f"{at}/c.json")
    assert full and [r[0] for r in df.collect()] == ["c"] and [f.name for f in tmp_path.iterdir() if f.name.endswith(".tmp")] == []
    scores = spark.createDataFrame([("s", 0.5, None)], "session_id string, probability_bot_umap double, probability_lgbm double")
    tables.write_csv(scores, f"{at}/p.csv")
    assert [tuple(r) for r in tables.read_predictions(spark, f"{at}/p.csv", required=True).collect()] == [("s", 0.5, None)]
    (tmp_path / "a.json").write_text('[{"x": 1}, {"x": 2}]')
    assert tables.read_json_array(spark, f"{at}/a.json", "x int").count() == 2
    (tmp_path / "f.csv").write_text("session_id,a\n01,2\n")
    assert [tuple(r) for r in tables.read_features(spark, f"{at}/f.csv", ["a"]).collect()] == [("01", 2.0)]
    (tmp_path / "predictions_1.csv").write_text("session_id,ip\ns,1\n")
    assert [r["file"] for r in tables.read_history(spark, at).collect()] == ["predictions_1.csv"]
    assert tables.write_summary(scores.selectExpr("count(*) as n"), f"{at}/deep/s.json") == {"n": 1} == json.loads((tmp_path / "deep" / "s.json").read_text())
    assert tables.write_delta(scores, f"{at}/d") and (tmp_path / "d").exists()
    assert not tables.write_delta(scores.limit(0), f"{at}/d") and not (tmp_path / "d").exists()


def test_a_changed_set_with_odd_items(spark, tmp_path):
    for text, want in [('["a", null, 7, 2.5]', (["2.5", "7", "a"], False)), ('{"session_ids": [], "full_rebuild": true}', ([], True)), ('{"full_rebuild": true}', None), ("3", None), ("", None)]:
        (tmp_path / "c.json").write_text(text)
        df, full = tables.read_changed(spark, str(tmp_path / "c.json"))
        assert (df, full) == (None, True) if want is None else (sorted(r[0] for r in df.collect()), full) == want, text


def test_models_are_found_by_uri(tmp_path):
    from clickloom.plans import config
    from clickloom.plans.pipeline import Models
    from clickloom.sources import files

    folder = tmp_path / "with space" / "desktop"
    folder.mkdir(parents=True)
    (folder / "projection.json").write_text(json.dumps({"columns": ["a"], "weights": [[1.0, 0.0]]}))
    (folder / "scaler.json").write_text(json.dumps({"a": {"scale": 1.0, "min": 0.0}}))
    (folder / "centroid.json").write_text(json.dumps({"centroid_x": 0.0, "centroid_y": 0.0, "bot_distance_p95": 9.0}))
    (tmp_path / "plain").symlink_to(tmp_path / "with space")
    for root in (str(tmp_path / "with space"), f"file://{tmp_path}/plain", f"file:{tmp_path}/plain"):
        assert Models.load(config.Site("1_1", "f", (f"{tmp_path}/none", root)), "desktop").projection.columns == ("a",)
    assert files.is_uri("hdfs://a/b") and files.is_uri("s3a://b/c") and not files.is_uri("file:///a") and not files.is_uri("/a") and not files.is_uri("a/b")
    with pytest.raises(ValueError):
        run.once(str(tmp_path), "hdfs://none/out", (), config.Run())


def test_run_state(tmp_path):
    (tmp_path / "1_1.json").write_text("{}\n")
    now, state = run.log_state(str(tmp_path)), str(tmp_path / "state")
    assert run.changed_sites(now, state) == ["1_1"]
    run.save_state(now, state)
    assert run.changed_sites(run.log_state(str(tmp_path)), state) == []
    (tmp_path / "1_1.json").write_text("{}\n{}\n")
    assert run.changed_sites(run.log_state(str(tmp_path)), state) == ["1_1"]
    with run.only_writer(str(tmp_path / "lock")) as a, run.only_writer(str(tmp_path / "lock")) as b:
        assert a and not b


def test_two_phase_rules(spark):
    recs = [record("s", 1000, "qml", {"mmv": {"l": DESKTOP}}), record("s", 2000, e={"scl": {"l": "0,0,0;a,0,z"}}), record("s", 15000, e={"scl": {"l": "0,0,0;a,0,9"}}), record("s", 20000, e={"mmv": {"l": DESKTOP}, "clk": 1}), record("s", 21000, "qml.ready")]
    got = {r["type"]: r["scroll_data"] for r in snapshots(log_records(logs(spark, recs)), Policy(two_phase=True)).collect()}
    assert got == {"mmv_clk": [9.0], "qml_ready": [35.0, 9.0]}  # the session ends with its page-ready record
    usual = {r["type"]: r["scroll_data"] for r in snapshots(log_records(logs(spark, recs))).where("not synthetic").collect()}
    assert usual["mmv_clk"] == [35.0, 9.0]


def test_rebuild_predicate_and_feature_upsert(spark):
    from clickloom.operators.scoring import needs_rebuild
    from clickloom.streaming.sessions import upsert_features

    scores = spark.createDataFrame([("a", 0.5, None)], "session_id string, probability_bot_umap double, probability_lgbm double")
    changed = scores.select("session_id")
    assert not needs_rebuild(changed, False, scores)
    assert needs_rebuild(None, False, scores) and needs_rebuild(changed, True, scores) and needs_rebuild(changed, False, None) and needs_rebuild(changed, False, scores, force=True)
    assert needs_rebuild(changed, False, scores.selectExpr("session_id", "cast(null as double) as probability_bot_umap", "probability_lgbm"))
    key = "site_id string, device_type string, session_id string"
    old = spark.createDataFrame([("x", "d", "a", 1), ("x", "d", "b", 1)], f"{key}, v int")
    snaps = spark.createDataFrame([("x", "d", "b", 1, True), ("x", "d", "b", 2, True), ("x", "d", "c", 1, False)], f"{key}, seq long, synthetic boolean")
    got = upsert_features(old, snaps, lambda s: s.groupBy("site_id", "device_type", "session_id").agg({"*": "count"}).withColumnRenamed("count(1)", "v"))
    assert sorted((r["session_id"], r["v"]) for r in got.collect()) == [("a", 1), ("b", 1), ("c", 1)]
