from __future__ import annotations

import json
import math
import re

import pytest
from pyspark.sql import functions as F

from clickloom.operators import features, publish, scaling, scoring
from clickloom.operators.decode import track
from clickloom.operators.snapshots import Policy, snapshots
from clickloom.plans import config
from clickloom.plans.pipeline import Models, log_records, run_sites
from clickloom.sources import ndjson
from clickloom.sources.events import first_mb

DESKTOP, TOUCH = "0,0,0;a,a,0;k,a,a;a,k,a;k,k,k", "0,0,0,0;a,0,a,0;k,0,a,a;a,0,k,a;k,0,k,k"


def record(a, tm, act="track", e=None, **more):
    return {"sess": {"a": a, "c": "p"}, "act": act, "ts": tm, "prm": {"tm": tm, "data": {"e": e or {}}}, **more}


def logs(spark, records):
    rows = [("1_1", i, r if isinstance(r, str) else json.dumps(r)) for i, r in enumerate(records)]
    return spark.createDataFrame(rows, "site_id string, seq long, line string")


def test_decode(spark):
    df = spark.createDataFrame([(DESKTOP, TOUCH, 1000.0)], "d string, t string, tm double").select(track("d", "tm").alias("d"), track("t", "tm", "touch").alias("t"))
    r = df.first()
    want = [(0, 0, 1000), (10, 0, 1010), (10, 10, 1030), (20, 10, 1040), (20, 20, 1060)]
    assert [tuple(p) for p in r["d"]] == want == [tuple(p) for p in r["t"]]
    odd = spark.createDataFrame([("!,+a,-a; zz,1.5,", 0.0)], "d string, tm double").select(track("d", "tm").alias("d")).first()["d"]
    assert [tuple(p) for p in odd] == [(10, -10, None), (1, None, None)]


def test_base36_of_any_length(spark):
    """Against a plain reading by parts of five digits, from the first digit that isn't 0."""
    import random

    from clickloom.functions.expressions import base36

    def plain(text):
        m = re.match(r"\s*(?:\+(?!-))?(-?)([0-9a-z]+)", text, re.I)
        if not m:
            return None
        digits, v = m[2].lstrip("0") or "0", 0.0
        for k in range(0, len(digits), 5):
            v = v * float(36 ** len(digits[k : k + 5])) + int(digits[k : k + 5], 36)
        return -v if m[1] else v

    r = random.Random(1)
    texts = ["".join(r.choice("0123456789azAZ") for _ in range(n)) for n in range(1, 60) for _ in range(3)]
    texts += ["z" * 12, "z" * 13, "-" + "z" * 13, "0" * 30 + "1a", "0" * 15, " +zz", "+-a", "", "!", "-", "a.5", "1" * 20 + "!!", "-0"]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", F.expr(base36("t")).alias("v")).orderBy("i").collect()
    assert [x["v"] for x in got] == [plain(t) for t in texts] and got[texts.index("z" * 12)]["v"] != got[texts.index("z" * 13)]["v"]


def test_first_mb():
    assert first_mb({"x": {"mb": 0}, "mb": 1}) is True
    assert first_mb({"x": [{"y": {"mb": 0}}], "z": {"mb": 1}}) is False
    assert first_mb({"mb": "0"}) is True and first_mb({"mb": None}) is True and first_mb({"a": 1}) is None


def test_routing(spark):
    rec = log_records(logs(spark, [
        record("s1", 1, "qml.ready", {"tst": 1}, mb=0), record("s2", 1, e={"tcl": 1}), record("s3", 1, "qml.ready", x={"y": {"mb": "0"}}),
        record("s4", 1, mb=1), record("s4", 2), {"act": "x"}, record("s6", 1, "qml.ready", mb=0), record("s6", 2, "qml.ready", mb=1), "{broken", "[1]", "  ",
    ]))
    got = [(r["session_id"], r["device_type"]) for r in rec.orderBy("seq").collect()]
    assert got == [("s1", "desktop"), ("s2", "mobile"), ("s3", "mobile"), ("s4", "mobile"), ("s4", "desktop"), (None, "desktop"), ("s6", "mobile"), ("s6", "mobile")]


def test_session_end_cutoff(spark):
    for device, want in (("desktop", [(1001.0, "first_qml_session_end")]), ("mobile", [])):
        rec = log_records(logs(spark, [record("s", 1000, "qml", {"mmv": {"l": DESKTOP}, "tmv": {"l": TOUCH}}, mb=int(device == "mobile"))])).where(F.col("device_type") == device)
        got = snapshots(rec).collect()
        assert [(r["tm"], r["synthetic_reason"]) for r in got] == want
        assert all(r["s"]["mmv_points_per_group"] == 0 and r["s"]["n"] == 5 for r in got)


@pytest.mark.parametrize(("k", "order"), [(10, "dabcf"), (5, "dbcf")])
def test_previous_click(spark, k, order):
    """The groups of a click are told apart by their sizes: letter i has i + 3 points."""
    recs = [record("s", tm, e={"mmv": {"l": ";".join(f"1,{10 * (i + 1) + j},{(j * j) % 36}" for j in range(i + 3))}, **({"clk": 1} if c else {})}) for i, (tm, c) in enumerate([(100, 0), (200, 0), (300, 1), (400, 0), (500, 0), (600, 1)])]
    got = snapshots(log_records(logs(spark, recs)), Policy(desktop=k, synthetic=False)).where("tm = 600").first()
    sizes = ["abcdef".index(c) + 3 for c in order]
    assert got["s"]["mmv_points_per_group"] == pytest.approx(sum(sizes) / len(sizes))


def test_aggregates(spark):
    df = spark.createDataFrame([(1, -3.0), (1, None), (1, 4.0), (2, None)], "k long, v double")
    v = F.col("v")
    got = {r["k"]: r for r in df.groupBy("k").agg(*features.family("v", v, False), features.total(v).alias("v_sum")).collect()}
    assert [got[1][f"v_{n}"] for n in ("mean", "min", "max", "std", "sum")] == [3.5, 3.0, 4.0, 3.5, 0.0]
    assert [got[2][f"v_{n}"] for n in ("mean", "min", "max", "std", "sum")] == [0.0] * 5
    assert features.mean_deviation(df, ["k"], "v", "m").collect()[0]["m"] == 3.5


def test_probability(spark):
    df = spark.createDataFrame([(float(d),) for d in (0, 1, 2, 3, 4, 10)], "d double")
    c = {"centroid_x": 0, "centroid_y": 0, "bot_distance_p95": 2, "all_distance_p99": 4}
    rows = df.select("d", scoring.probability(F.col("d"), c).alias("decay"), scoring.probability(F.col("d"), c, "linear").alias("linear")).orderBy("d").collect()
    assert [r["decay"] for r in rows] == pytest.approx([1.0, 0.5, 0.01, 0.003162277660168379, 0.001, 0.001])
    assert [r["linear"] for r in rows] == pytest.approx([1.0, 0.5, 0.01, 0.01, 0.01, 0.01])
    with pytest.raises(KeyError):
        scoring.probability(F.col("d"), {})


def test_pages(spark):
    uris = ["/personal/order/make/", "/x/personal/cart/", "/catalog/x/filter/y", "/catalog/a/b/", "/catalog/", "/?q=1", "/about"]
    df = spark.createDataFrame([(u,) for u in uris], "u string").select(scoring.page_type(F.col("u")).alias("t"))
    assert [r["t"] for r in df.collect()] == ["order_make", "cart", "catalog_filter", "catalog_2_levels", "catalog", "home", None]
    seq = spark.createDataFrame([("s", "p2", "/store", 3.0, 0), ("s", "p1", "/", 1.0, 1), ("s", "p1", "/search", 2.0, 2)], "session_id string, page_id string, uri string, ts double, seq long")
    assert scoring.page_sequences(seq).first()["tokens"] == ["home", "store"]


def test_merge_diff_upsert(spark):
    bots = spark.createDataFrame([("A", 0.1), ("B", 0.3)], "session_id string, probability_bot_umap double")
    trees = spark.createDataFrame([("B", 0.5), ("C", 0.4)], "session_id string, probability_lgbm double")
    merged = scoring.merge_scores(bots, trees)
    assert sorted(map(tuple, merged.collect()), key=str) == [("A", 0.1, None), ("B", 0.3, 0.5), ("C", None, 0.4)]
    old = spark.createDataFrame([("A", 0.1, None), ("B", 0.2, 0.5)], merged.schema)
    assert sorted(r[0] for r in publish.changed_scores(old, merged, ["session_id"]).collect()) == ["B", "C"]
    up = features.upsert(spark.createDataFrame([("A", 1), ("B", 1)], "session_id string, v int"), spark.createDataFrame([("B", 2), ("C", 2)], "session_id string, v int"), ["session_id"])
    assert sorted(map(tuple, up.collect())) == [("A", 1), ("B", 2), ("C", 2)]
    assert [r[0] for r in merged.select(publish.score_text(F.col("probability_lgbm")).alias("t")).orderBy("t").collect()] == ["", "0.4", "0.5"]


def test_scaling_and_trees(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.0, 5.0), ("b", 3.0, None), ("c", float("nan"), float("inf"))], "session_id string, x double, y double")
    al = {r["session_id"]: (r["y"], r["x"]) for r in scaling.aligned(df, ["y", "x"], ["session_id"]).collect()}
    assert al == {"a": (5.0, 1.0), "b": (0.0, 3.0), "c": (1e10, 0.0)}
    with pytest.raises(ValueError):
        scaling.aligned(df, ["z"], [])
    path = str(tmp_path / "s.json")
    s = scaling.load_or_fit(df.where("session_id < 'c'"), ["x"], path)
    assert s == scaling.load_or_fit(df, ["x"], path)
    assert [r["x"] for r in scaling.scale(df.where("session_id < 'c'"), s, ["session_id"]).orderBy("session_id").collect()] == [0.0, 1.0]
    t = scoring.Trees(("x",), ({"feature": [0], "threshold": [2.0], "left": [-1], "right": [-2], "leaf": [1.0, -1.0]},), embedding=2)
    t.save(str(tmp_path / "t.json"))
    t = scoring.Trees.load(str(tmp_path / "t.json"))
    emb = spark.createDataFrame([], "session_id string, embedding array<float>")
    m = scoring.tree_matrix(scoring.aligned(df, ["x"], ["session_id"]), emb, scoring.Trees(t.columns, t.trees, embedding=2))
    got = {r[0]: r[1] for r in scoring.score_trees(m, t).collect()}
    sql = {r[0]: r[1] for r in m.select("session_id", t.column().alias("p")).collect()}
    assert got == pytest.approx(sql)


def test_encoder_masks_padding():
    import numpy as np

    rng = np.random.default_rng(0)
    d, shapes = 8, {"embed": (5, 8), "position": (9, 8), "cls": (8,), "norm.g": (8,), "norm.b": (8,)}
    for i in range(2):
        shapes |= {f"{i}.norm1.g": (d,), f"{i}.norm1.b": (d,), f"{i}.qkv.w": (d, 3 * d), f"{i}.qkv.b": (3 * d,), f"{i}.out.w": (d, d), f"{i}.out.b": (d,), f"{i}.norm2.g": (d,), f"{i}.norm2.b": (d,),
                   f"{i}.ff1.w": (d, 16), f"{i}.ff1.b": (16,), f"{i}.ff2.w": (16, d), f"{i}.ff2.b": (d,)}
    e = scoring.Encoder({k: rng.normal(size=v) for k, v in shapes.items()}, heads=2)
    alone, together = e([[1, 2]]), e([[1, 2], [1, 2, 3, 4]])
    assert np.allclose(alone[0], together[0], atol=1e-5) and together.shape == (2, 8)
    for got, ids in zip(together, ([1, 2], [1, 2, 3, 4])):
        assert got.tolist() == pytest.approx(plain_encoder(e, ids), rel=1e-4, abs=1e-5)
    assert e([[]])[0].tolist() == pytest.approx(plain_encoder(e, []), rel=1e-4, abs=1e-5)


def plain_encoder(e, ids):
    """One sequence, number by number."""
    p = {k: v.tolist() for k, v in e.weights.items()}
    d, size = e.width, e.width // e.heads
    times = lambda v, w, b: [sum(v[i] * w[i][j] for i in range(len(v))) + b[j] for j in range(len(b))]

    def norm(v, g, b):
        mean = sum(v) / len(v)
        spread = sum((x - mean) ** 2 for x in v) / len(v)
        return [(x - mean) / math.sqrt(spread + 1e-5) * g[i] + b[i] for i, x in enumerate(v)]

    rows = [[p["cls"][j] + p["position"][0][j] for j in range(d)]]
    rows += [[p["embed"][t][j] * math.sqrt(d) + p["position"][k][j] for j in range(d)] for k, t in enumerate(ids, 1)]
    for i in range(e.layers):
        packed = [times(norm(v, p[f"{i}.norm1.g"], p[f"{i}.norm1.b"]), p[f"{i}.qkv.w"], p[f"{i}.qkv.b"]) for v in rows]
        heads = [[] for _ in rows]
        for h in range(e.heads):
            q, k, v = ([x[c * d + h * size : c * d + (h + 1) * size] for x in packed] for c in range(3))
            for r, mine in enumerate(q):
                a = [math.exp(sum(x * y for x, y in zip(mine, other)) / math.sqrt(size)) for other in k]
                heads[r] += [sum(w * x[c] for w, x in zip(a, v)) / sum(a) for c in range(size)]
        rows = [[x + y for x, y in zip(r, times(h, p[f"{i}.out.w"], p[f"{i}.out.b"]))] for r, h in zip(rows, heads)]
        inner = [[max(0.0, x) for x in times(norm(r, p[f"{i}.norm2.g"], p[f"{i}.norm2.b"]), p[f"{i}.ff1.w"], p[f"{i}.ff1.b"])] for r in rows]
        rows = [[x + y for x, y in zip(r, times(h, p[f"{i}.ff2.w"], p[f"{i}.ff2.b"]))] for r, h in zip(rows, inner)]
    return norm(rows[0], p["norm.g"], p["norm.b"])


def test_sites_and_config(tmp_path):
    for name in ("1_7.json", "1_x.json", "2_1.json", "1_12.json"):
        (tmp_path / name).write_text("")
    assert list(ndjson.sites(str(tmp_path))) == ["1_12", "1_7"] and list(ndjson.sites(str(tmp_path), ["1_7.json"])) == ["1_7"]
    assert ndjson.rebuild_needed(10, 1, 5, 1) and ndjson.rebuild_needed(1, 1, 5, 2) and not ndjson.rebuild_needed(1, 1, 5, 2, "continue") and ndjson.rebuild_needed(1, 1, 5, 1, force=True)
    (tmp_path / ".env").write_text("A='x y'\nexport B=2\n# c\nC = 3\n")
    assert config.load_env(str(tmp_path / ".env"), {"C": "0"}) == {"A": "x y", "B": "2", "C": "0"}
    site = config.Site("1_7", "f", (str(tmp_path / "own"), str(tmp_path / "base")))
    assert site.projection("mobile") is None and site.trees("mobile") == ("missing", None)
    (tmp_path / "base" / "mobile").mkdir(parents=True)
    for f in (*config.PROJECTION_FILES, config.TREE_FILE):
        (tmp_path / "base" / "mobile" / f).write_text("{}")
    assert site.projection("mobile") == str(tmp_path / "base" / "mobile") and site.trees("mobile")[0] == "base"
    assert config.site_name("a/b c") == "a_b_c"


def test_log_scan_ranges(spark, tmp_path):
    lines = [json.dumps(record(f"s{i}", i)) for i in range(40)]
    (tmp_path / "1_1.json").write_bytes(("\n".join(lines[:20]) + "\r\n\n" + "\n".join(lines[20:])).encode())
    for step in ("64", "1000000"):
        for path in (str(tmp_path), f"file://{tmp_path}"):
            got = [r["line"] for r in ndjson.read_logs(spark, path, rangeBytes=step).orderBy("seq").collect()]
            assert got == lines[:39]  # the last line isn't ended


def test_ranges_by_plain_splitting(tmp_path):
    """Ranges of any size and chunks of any size together give each line once, at its offset."""
    import random

    r = random.Random(3)
    for k in range(60):
        data = b"".join(r.choice([b"a", b"\n", b"\r\n", "é".encode(), b"\xff", b" ", b"bcd"]) for _ in range(r.randrange(0, 60)))
        (tmp_path / f"1_{k}.json").write_bytes(data)
        want, at = [], 0
        while (e := data.find(b"\n", at)) >= 0:
            text = data[at:e].decode("utf-8", "replace").rstrip("\r\n")
            want += [(at, text)] if text.strip() else []
            at = e + 1
        file = str(tmp_path / f"1_{k}.json")
        for step in (1, 3, 7, 1000):
            for chunk in (1, 2, 5, 1000):
                got = [x for a in range(0, len(data), step) for b in ndjson.lines(ndjson.Range("s", file, a, min(a + step, len(data)), a == 0), chunk) for x in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
                assert got == want, (data, step, chunk)
        assert ndjson.last_line_end(file, 0, len(data), 3) == data.rfind(b"\n") + 1


def test_run_sites_publishes_changes_only(spark, tmp_path):
    log, out = tmp_path / "logs", tmp_path / "out"
    log.mkdir(), out.mkdir()
    write = lambda recs: (log / "1_1.json").write_text("".join(json.dumps(r) + "\n" for r in recs))
    base = [record("a", 1000, "qml", {"mmv": {"l": DESKTOP}}, ip="1.1.1.1"), record("b", 1000, "qml", {"mmv": {"l": DESKTOP}})]
    write(base)
    cols = ("bot_score_mean", "mousemove_prm_data_b_l_mean")
    m = Models({c: {"scale": 1.0, "min": 0.0} for c in cols}, scoring.Projection(cols, ((1.0, 0.0), (0.0, 0.1))), {"centroid_x": 0.0, "centroid_y": 0.0, "bot_distance_p95": 9.0})
    assert run_sites(spark, str(log), str(out), {"desktop": m}, "2024-01-01", "2024-01-01 00:00:00") == {"desktop": 2}
    assert run_sites(spark, str(log), str(out), {"desktop": m}, "2024-01-01", "2024-01-01 01:00:00") == {"desktop": 0}
    write([*base, record("b", 2000, e={"mmv": {"l": "0,0,0;a,5,5;a,z,z;a,9,1"}}), record("b", 3000, "qml.ready")])
    assert run_sites(spark, str(log), str(out), {"desktop": m}, "2024-01-02", "2024-01-02 00:00:00") == {"desktop": 1}
    rows = spark.read.parquet(str(out / "desktop" / "log")).orderBy("day", "session_id").collect()
    assert [(str(r["day"]), r["session_id"], r["ip"]) for r in rows] == [("2024-01-01", "a", "1.1.1.1"), ("2024-01-01", "b", ""), ("2024-01-02", "b", "")]
    assert publish.owns_day(spark, str(out / "desktop" / "log"), "2024-01-02")
    publish.reset_day(spark, str(out / "desktop" / "log"), "2024-01-02")
    assert not publish.owns_day(spark, str(out / "desktop" / "log"), "2024-01-02")


COLS = ("bot_score_mean", "mousemove_prm_data_b_l_mean")


def linear_models(slope=0.1):
    return Models({c: {"scale": 1.0, "min": 0.0} for c in COLS}, scoring.Projection(COLS, ((1.0, 0.0), (0.0, slope))), {"centroid_x": 0.0, "centroid_y": 0.0, "bot_distance_p95": 9.0})


def test_sites_are_kept_apart(spark, tmp_path):
    """The same session id on two sites is two sessions, with their own scores, models, addresses and history."""
    log, out = tmp_path / "logs", tmp_path / "out"
    log.mkdir(), out.mkdir()
    tracks = {"1_1": DESKTOP, "1_2": "0,0,0;a,5,5;a,z,z;a,9,1"}
    for site, ip in (("1_1", "1.1.1.1"), ("1_2", "2.2.2.2")):
        (log / f"{site}.json").write_text(json.dumps(record("s", 1000, "qml", {"mmv": {"l": tracks[site]}}, ip=ip)) + "\n")
    args = (spark, str(log), str(out), {"desktop": linear_models()})
    assert run_sites(*args, "2024-01-01", "2024-01-01 00:00:00") == {"desktop": 2}
    rows = {r["site_id"]: r for r in spark.read.parquet(str(out / "desktop" / "log")).collect()}
    assert {k: r["ip"] for k, r in rows.items()} == {"1_1": "1.1.1.1", "1_2": "2.2.2.2"} and rows["1_1"]["probability_bot_umap"] != rows["1_2"]["probability_bot_umap"]
    assert run_sites(*args, "2024-01-01", "2024-01-01 00:10:00") == {"desktop": 0}
    # one site has models of its own, and only its log is read
    assert run_sites(*args, "2024-01-02", "2024-01-02 00:00:00", config.Run(mode="full"), {"1_2": {"desktop": linear_models(0.01)}}, ["1_2"]) == {"desktop": 1}
    from clickloom.plans.pipeline import current, device_history, upserted

    scores = {r["site_id"]: r["probability_bot_umap"] for r in upserted(spark, str(out / "desktop" / "predictions")).collect()}
    assert scores["1_1"] == rows["1_1"]["probability_bot_umap"] and scores["1_2"] != rows["1_2"]["probability_bot_umap"]
    history = device_history(spark, str(out), "desktop").collect()
    assert sorted((r["site_id"], r["ip"], r["date"][:10]) for r in history) == [("1_1", "1.1.1.1", "2024-01-01"), ("1_2", "2.2.2.2", "2024-01-02")]
    assert [(r["site_id"], r["device_type"]) for r in current(spark, str(out / "history")).collect()] == [("1_2", "desktop")]  # keys of the day


def test_an_incremental_run_equals_a_full_one(spark, tmp_path):
    """Two runs, of which the second scores the changed session only, end with the predictions of one run over everything."""
    from clickloom.plans import pipeline

    first = [record(x, 1000 + i, "qml", {"mmv": {"l": DESKTOP}}) for i, x in enumerate("abc")]
    more = [record("b", 2000, e={"mmv": {"l": "0,0,0;a,5,5;a,z,z;a,9,1"}}), record("b", 3000, "qml.ready"), record("d", 3500, "qml", {"mmv": {"l": DESKTOP}})]
    got = {}
    for name, runs in (("two", ([*first], [*first, *more])), ("one", ([*first, *more],))):
        log, out = tmp_path / name / "logs", tmp_path / name / "out"
        log.mkdir(parents=True), out.mkdir()
        for i, recs in enumerate(runs):
            (log / "1_1.json").write_text("".join(json.dumps(r) + "\n" for r in recs))
            n = run_sites(spark, str(log), str(out), {"desktop": linear_models()}, "2024-01-01", f"2024-01-01 0{i}:00:00")
        got[name] = sorted(map(tuple, pipeline.upserted(spark, str(out / "desktop" / "predictions")).collect()))
        assert n == {"desktop": 2 if name == "two" else 4}
    assert got["one"] == got["two"]
    # a write that stopped leaves the version before it, and the run's part of the log is written again
    from clickloom.sources.versions import versions

    place = tmp_path / "two" / "out" / "desktop" / "predictions" / "manifest"
    kept = versions(spark, str(place))
    (place / "v00000099").mkdir()
    assert versions(spark, str(place)) == kept and len(kept) == 2


def test_keys_above_two_to_53(spark):
    """Numbers as keys pass the models unchanged, beside a null one."""
    big = 2**53 + 1
    df = spark.createDataFrame([(big, 1.0), (None, 2.0)], "session_id long, x double").coalesce(1)
    got = scoring.score_projection(df, scoring.Projection(("x",), ((1.0, 0.0),)), ["x"], {"centroid_x": 0, "centroid_y": 0, "bot_distance_p95": 9})
    assert {r["session_id"] for r in got.collect()} == {big, None}
    t = scoring.Trees(("x",), ({"feature": [0], "threshold": [1.5], "left": [-1], "right": [-2], "leaf": [1.0, -1.0]},))
    assert {r["session_id"] for r in scoring.score_trees(df, t).collect()} == {big, None}


def test_quantiles_by_sorting(spark):
    import math
    import random

    from clickloom.operators.quantiles import quantiles

    r = random.Random(6)
    columns = {
        "ties": [float(r.randrange(3)) for _ in range(500)], "wide": [r.choice([-1, 1]) * 10 ** r.uniform(-300, 300) for _ in range(500)], "near": [1e15 + r.randrange(4) / 8 for _ in range(500)],
        "some": [r.gauss(0, 1) if r.random() < 0.3 else None for _ in range(500)], "odd": [r.choice([math.nan, math.inf, 1.0, 2.0, None]) for _ in range(500)], "none": [None] * 500, "one": [7.0] + [None] * 499,
    }
    shares = [0.0, 0.25, 0.5, 0.9, 1.0]
    df = spark.createDataFrame(list(zip(*columns.values())), ", ".join(f"{c} double" for c in columns)).repartition(5)
    got = quantiles(df, list(columns), shares)
    for c, v in columns.items():
        v = sorted(x for x in v if x is not None and math.isfinite(x))
        at = [q * (len(v) - 1) for q in shares]
        assert got[c] == ([v[int(p)] + (v[math.ceil(p)] - v[int(p)]) * (p - int(p)) for p in at] if v else [None] * 5), c
    assert "percentile" not in features.profile(df, ["some"])._jdf.queryExecution().toString()


def test_numbers_in_blocks_equal_a_window(spark):
    """Records of a session in many blocks of the log; its numbering is spread over as many tasks."""
    from pyspark.sql import Window

    from clickloom.operators.snapshots import KEY, numbered

    rows = [("1_1", "desktop", f"s{i % 3}" if i % 7 else "one", 37 * i, 1.0, None, "m" if i % 2 else None, "c" if i % 5 == 0 else None) for i in range(900)]
    df = spark.createDataFrame(rows, "site_id string, device_type string, session_id string, seq long, tm double, tmv string, mmv string, scl string")
    w = Window.partitionBy(*KEY).orderBy("seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    want = sorted(map(tuple, df.select("seq", F.count("mmv").over(w), F.count("scl").over(w)).collect()))
    for bits in (5, 10, 24):
        assert sorted(map(tuple, numbered(df, bits).select("seq", "n_pointer", "n_scroll").collect())) == want
