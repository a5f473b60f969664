"""Registered queries over the driver's tables, each with its oracle SQL where SQL can say it."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickloom.functions.expressions import base36, ratio, round6
from clickloom.operators import asof, features, neighbours, publish, scaling, scoring, trajectory

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    """Registers a function under its name, with its oracle."""

    def put(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return put


def read(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def points(spark: SparkSession, d: str) -> DataFrame:
    """Events as pointer tracks: user as session, k as x, value as y."""
    return read(spark, d, "events").select(
        F.col("user_id").alias("session_id"), F.col("event_id").alias("seq"), F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', cast(ts as timestamp_ntz)) / 1000D").alias("tm"),
        F.get_json_object("props", "$.k").cast("double").alias("x"), F.col("value").alias("y"), "event_type",
    )


_P = """p AS (SELECT user_id AS session_id, event_id AS seq, epoch_us(ts) / CAST(1000 AS DOUBLE) AS tm,
  CAST(json_extract_string(props, '$.k') AS DOUBLE) AS x, value AS y, event_type FROM events)"""
_S = f"""WITH {_P}, s0 AS (SELECT *, x - lag(x) OVER w AS dx, y - lag(y) OVER w AS dy, tm - lag(tm) OVER w AS dtm, row_number() OVER w AS i
  FROM p WINDOW w AS (PARTITION BY session_id ORDER BY tm, seq)),
s1 AS (SELECT *, sqrt(dx * dx + dy * dy) AS dist FROM s0),
s2 AS (SELECT *, lag(dx) OVER w AS dx_1, lag(dy) OVER w AS dy_1, lag(dtm) OVER w AS dtm_1, lag(dist) OVER w AS dist_1,
  lag(dx, 2) OVER w AS dx_2, lag(dy, 2) OVER w AS dy_2, lag(dtm, 2) OVER w AS dtm_2
  FROM s1 WINDOW w AS (PARTITION BY session_id ORDER BY tm, seq)),
s AS (SELECT *, dx_1 * dy - dy_1 * dx AS crs, dx_1 * dx + dy_1 * dy AS dt,
  CASE WHEN dx_1 * dy - dy_1 * dx <> 0 OR dx_1 * dx + dy_1 * dy <> 0 THEN abs(atan2(dx_1 * dy - dy_1 * dx, dx_1 * dx + dy_1 * dy) * 180 / pi()) END AS angle FROM s2)"""
_ENTROPY = """, {t}c AS (SELECT session_id, {bin} AS bin, count(*) AS n FROM s WHERE {bin} IS NOT NULL GROUP BY ALL),
{t} AS (SELECT session_id, -sum(n / t * log2(n / t)) + 0.0 AS {name} FROM (SELECT *, CAST(sum(n) OVER (PARTITION BY session_id) AS DOUBLE) AS t FROM {t}c) GROUP BY session_id)"""
_DIR = _ENTROPY.format(t="de", bin="CAST(floor((atan2(dy, dx) + pi()) / (2 * pi() / 16)) AS BIGINT) % 16", name="direction_entropy")
_ANG = _ENTROPY.format(t="ae", bin="CAST(floor(angle / 10) AS BIGINT)", name="angle_entropy")
_RUNS = """, isl AS (SELECT session_id, angle < 5 AS straight, sum(CASE WHEN angle < 5 THEN 0 ELSE 1 END) OVER (PARTITION BY session_id ORDER BY i) AS island FROM s WHERE angle IS NOT NULL),
runs AS (SELECT session_id, island, count(*) FILTER (straight) AS run, count(*) AS n FROM isl GROUP BY ALL),
sr AS (SELECT session_id, sum(CASE WHEN run >= 5 THEN run ELSE 0 END) / CAST(sum(n) AS DOUBLE) AS long_straight_run_share FROM runs GROUP BY session_id)"""
_A = "sqrt(((dx / dtm - dx_1 / dtm_1) / dtm) ** 2 + ((dy / dtm - dy_1 / dtm_1) / dtm) ** 2)"
_J = """sqrt((((dx / dtm - dx_1 / dtm_1) / dtm - (dx_1 / dtm_1 - dx_2 / dtm_2) / dtm_1) / dtm) ** 2
  + (((dy / dtm - dy_1 / dtm_1) / dtm - (dy_1 / dtm_1 - dy_2 / dtm_2) / dtm_1) / dtm) ** 2)"""
_FLAT = f"""SELECT session_id, count(*) AS n, max(tm) - min(tm) AS ms, coalesce(sum(dist), 0) AS l,
  coalesce(avg({_J}) FILTER (dtm > 0 AND dtm_1 > 0 AND dtm_2 > 0), 0) AS jerk,
  sqrt((arg_max(x, i) - arg_min(x, i)) ** 2 + (arg_max(y, i) - arg_min(y, i)) ** 2) AS chord,
  coalesce(avg(CASE WHEN dist < 3 THEN 1.0 WHEN dist IS NOT NULL THEN 0.0 END), 0) AS jitter,
  coalesce(avg(CASE WHEN dist < 2 THEN 1.0 WHEN dist IS NOT NULL THEN 0.0 END), 0) AS micro_jitter_2px,
  CASE WHEN count(*) FILTER (dtm > 0) < 2 THEN 0 ELSE stddev_pop(dist / dtm) FILTER (dtm > 0) / nullif(avg(dist / dtm) FILTER (dtm > 0), 0) END AS speed_variability,
  coalesce(avg(abs(crs) / (dist * dist_1)) FILTER (dist * dist_1 > 0), 0) AS curvature,
  CASE WHEN count(dtm) < 1 THEN 0 ELSE stddev_pop(dtm) / nullif(avg(dtm), 0) END AS time_irregularity,
  CASE WHEN count(*) FILTER (dtm > 0 AND dtm_1 > 0) < 2 THEN 0 ELSE stddev_pop({_A}) FILTER (dtm > 0 AND dtm_1 > 0) / nullif(avg({_A}) FILTER (dtm > 0 AND dtm_1 > 0), 0) END AS acceleration_variability,
  coalesce(100 * avg(CASE WHEN angle > 45 THEN 1.0 WHEN angle IS NOT NULL THEN 0.0 END), 0) AS turn_rate_45_per_100,
  coalesce(avg(angle), 0) AS mean_abs_angle_deg, coalesce(quantile_cont(angle, 0.9), 0) AS p90_abs_angle_deg,
  coalesce(100 * sum(angle) * pi() / 180 / nullif(sum(dist), 0), 0) AS curvature_per_100px
  FROM s GROUP BY session_id"""


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.select("session_id", *(round6(F.col(c)).alias(c) for c in columns))


def _flat_sql(*columns: str) -> str:
    return _S + f" SELECT session_id, {', '.join(f'round({c}, 6) + 0.0 AS {c}' for c in columns)} FROM ({_FLAT})"


@query(_S + _DIR + " SELECT session_id, round(direction_entropy, 6) + 0.0 AS direction_entropy FROM de")
def trajectory_entropy(spark: SparkSession, d: str) -> DataFrame:
    s = trajectory.steps(points(spark, d)).where("dx is not null")
    return _rounded(trajectory.entropy(s, "session_id", trajectory.direction_bin(), "direction_entropy"), "direction_entropy")


@query(_flat_sql("jitter", "micro_jitter_2px", "speed_variability", "p90_abs_angle_deg"))
def trajectory_jitter_cv_p90(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(trajectory.point_features(points(spark, d)), "jitter", "micro_jitter_2px", "speed_variability", "p90_abs_angle_deg")


@query(_S + _ANG + f""" SELECT session_id, round(turn_rate_45_per_100, 6) + 0.0 AS turn_rate_45_per_100, round(mean_abs_angle_deg, 6) + 0.0 AS mean_abs_angle_deg,
  round(curvature, 6) + 0.0 AS curvature, round(curvature_per_100px, 6) + 0.0 AS curvature_per_100px, round(coalesce(angle_entropy, 0), 6) + 0.0 AS angle_entropy
  FROM ({_FLAT}) LEFT JOIN ae USING (session_id)""")
def trajectory_turns(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(trajectory.point_features(points(spark, d)), "turn_rate_45_per_100", "mean_abs_angle_deg", "curvature", "curvature_per_100px", "angle_entropy")


_SCALED = ("jerk", "time_irregularity", "acceleration_variability")


@query(_S + f" SELECT session_id, round(jerk * 1e12, 3) + 0.0 AS jerk_e12, round(time_irregularity, 6) + 0.0 AS time_irregularity, round(acceleration_variability, 6) + 0.0 AS acceleration_variability FROM ({_FLAT})")
def trajectory_kinematics(spark: SparkSession, d: str) -> DataFrame:
    f = trajectory.point_features(points(spark, d))
    return f.select("session_id", (F.round(F.col("jerk") * 1e12, 3) + 0.0).alias("jerk_e12"), *(round6(F.col(c)).alias(c) for c in _SCALED[1:]))


@query(_S + f" SELECT session_id, CAST(n AS BIGINT) AS n, round(CASE WHEN chord = 0 OR l = 0 THEN 1 ELSE chord / l END, 6) + 0.0 AS linearity, round(l, 6) + 0.0 AS l, round(ms, 3) AS ms FROM ({_FLAT})")
def linearity_path(spark: SparkSession, d: str) -> DataFrame:
    f = trajectory.point_features(points(spark, d))
    return f.select("session_id", "n", round6(F.col("linearity")).alias("linearity"), round6(F.col("l")).alias("l"), F.round("ms", 3).alias("ms"))


@query(_S + _RUNS + " SELECT session_id, round(long_straight_run_share, 6) + 0.0 AS long_straight_run_share FROM sr")
def straight_runs(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(trajectory.straight_runs(trajectory.steps(points(spark, d))), "long_straight_run_share")


def _score_sql() -> str:
    names = {"repetition_patterns", "mmv_points_per_group"}
    terms = []
    for name, _, cases in trajectory.SCORE_TERMS:
        if name not in names:
            terms.append("CASE " + " ".join(f"WHEN {name} {op} {limit} THEN CAST({p} AS DOUBLE)" for op, limit, p in cases) + " ELSE 0 END")
    score = f"least(1.0, {' + '.join(terms)})"
    return _S + _DIR + _ANG + _RUNS + f""", f AS (SELECT b.*, CASE WHEN chord = 0 OR l = 0 THEN 1 ELSE chord / l END AS linearity, coalesce(direction_entropy, 0) AS direction_entropy,
  coalesce(angle_entropy, 0) AS angle_entropy, coalesce(long_straight_run_share, 0) AS long_straight_run_share
  FROM ({_FLAT}) b LEFT JOIN de USING (session_id) LEFT JOIN ae USING (session_id) LEFT JOIN sr USING (session_id))
  SELECT session_id, round({score}, 6) + 0.0 AS bot_score, {score} > 0.5 AS is_likely_bot FROM f"""


def _scored(spark: SparkSession, d: str) -> DataFrame:
    f = trajectory.point_features(points(spark, d))
    names = {n for n, _, _ in trajectory.SCORE_TERMS} - {"repetition_patterns", "mmv_points_per_group"}
    return f.withColumn("bot_score", trajectory.bot_score(True, names)).withColumn("is_likely_bot", F.col("bot_score") > trajectory.LIKELY)


@query(_score_sql())
def bot_score(spark: SparkSession, d: str) -> DataFrame:
    return _scored(spark, d).select("session_id", round6(F.col("bot_score")).alias("bot_score"), "is_likely_bot")


@query()
def track_statistics(spark: SparkSession, d: str) -> DataFrame:
    """The full intake and all features, segments included, of each session's track."""
    p = points(spark, d).groupBy("session_id").agg(F.array_sort(F.collect_list(F.struct("tm", "seq", "x", "y"))).alias("p"))
    ms = F.transform("p", lambda q: q["tm"] / 1_000_000)  # days as minutes, so that pauses don't cut every track
    s = trajectory.track_stats(F.col("p.x"), F.col("p.y"), ms, F.array(F.size("p")), F.lit("desktop"))
    return p.select("session_id", s.alias("s")).where("s.n is not null").select("session_id", "s.*")


_SIGNED = "CASE WHEN CAST(json_extract_string(props, '$.k') AS BIGINT) % 97 <> 0 THEN value - 20 END"


def _signed(spark: SparkSession, d: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("long")
    return read(spark, d, "events").select(F.col("user_id").alias("session_id"), F.when(k % 97 != 0, F.col("value") - 20).alias("v"))


@query(f"SELECT user_id AS session_id, round(coalesce(avg(abs({_SIGNED})), 0), 6) + 0.0 AS v_mean FROM events GROUP BY user_id")
def session_agg_mean(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(_signed(spark, d).groupBy("session_id").agg(*features.family("v", F.col("v"), True)), "v_mean")


@query(f"""WITH e AS (SELECT user_id AS session_id, {_SIGNED} AS v FROM events), m AS (SELECT session_id, avg(v) AS m FROM e GROUP BY 1),
  a AS (SELECT session_id, coalesce(min(abs(v)), 0) AS v_min, coalesce(max(abs(v)), 0) AS v_max, coalesce(avg(abs(v)), 0) AS v_mean, coalesce(stddev_pop(v), 0) AS v_std,
    CASE WHEN bool_or(v IS NULL) THEN 0 ELSE coalesce(sum(abs(v)), 0) END AS v_sum FROM e GROUP BY 1),
  d AS (SELECT session_id, avg(abs(v - m)) AS v_mad FROM e JOIN m USING (session_id) GROUP BY 1)
  SELECT session_id, {', '.join(f'round(coalesce(v_{x}, 0), 9) + 0.0 AS v_{x}' for x in ('min', 'max', 'mean', 'std', 'sum', 'mad'))} FROM a LEFT JOIN d USING (session_id)""")
def session_agg_full(spark: SparkSession, d: str) -> DataFrame:
    e = _signed(spark, d)
    flat = e.groupBy("session_id").agg(*features.family("v", F.col("v"), False), features.total(F.col("v")).alias("v_sum"))
    full = flat.join(features.mean_deviation(e, ["session_id"], "v", "v_mad"), "session_id", "left").fillna(0.0, ["v_mad"])
    # nine digits: amounts have two, so that means often lie just between two numbers of six
    return full.select("session_id", *((F.round(f"v_{x}", 9) + 0.0).alias(f"v_{x}") for x in ("min", "max", "mean", "std", "sum", "mad")))


@query("""WITH m AS (SELECT l_returnflag, l_linestatus, avg(l_quantity) AS m FROM lineitem GROUP BY ALL)
  SELECT l_returnflag, l_linestatus, round(avg(abs(l_quantity - m)), 6) AS mad FROM lineitem JOIN m USING (l_returnflag, l_linestatus) GROUP BY ALL""")
def mad_by_key(spark: SparkSession, d: str) -> DataFrame:
    out = features.mean_deviation(read(spark, d, "lineitem"), ["l_returnflag", "l_linestatus"], "l_quantity", "mad")
    return out.withColumn("mad", F.round("mad", 6))


def _as_features(spark: SparkSession, d: str) -> DataFrame:
    """A table shaped like session features, from the order lines of each supplier."""
    score = F.col("l_discount") * 10 - F.floor(F.col("l_quantity") / 25) * 0.1
    g = read(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("session_id")).agg(F.avg(score).alias("bot_score_mean"), F.avg((score > 0.5).cast("double")).alias("bot_is_likely_bot_ratio"), F.avg("l_tax").alias("bot_jitter_mean"), F.count_if(score > 0.8).alias("bot_detection_features_count"))
    return g


_AS = """f AS (SELECT l_suppkey AS session_id, avg(l_discount * 10 - floor(l_quantity / 25) * 0.1) AS bot_score_mean,
  avg(CASE WHEN l_discount * 10 - floor(l_quantity / 25) * 0.1 > 0.5 THEN 1.0 ELSE 0.0 END) AS bot_is_likely_bot_ratio, avg(l_tax) AS bot_jitter_mean,
  count(*) FILTER (l_discount * 10 - floor(l_quantity / 25) * 0.1 > 0.8) AS bot_detection_features_count FROM lineitem GROUP BY 1)"""


@query(f"""WITH {_AS} SELECT count(*) AS total_sessions, count(*) FILTER (bot_detection_features_count > 0) AS sessions_with_features, round(avg(bot_score_mean), 6) AS avg_bot_score,
  count(*) FILTER (bot_score_mean > 0.5) AS high_score_sessions, count(*) FILTER (bot_score_mean > 0.8) AS very_high_score_sessions, round(avg(bot_is_likely_bot_ratio), 6) AS avg_likely_bot_ratio,
  count(*) FILTER (bot_is_likely_bot_ratio > 0.5) AS classified_as_bot FROM f""")
def bot_summary(spark: SparkSession, d: str) -> DataFrame:
    s = features.summary(_as_features(spark, d))
    return s.withColumns({c: F.round(c, 6) for c in ("avg_bot_score", "avg_likely_bot_ratio")})


_COLS = ["bot_score_mean", "bot_is_likely_bot_ratio", "bot_jitter_mean"]


@query(f"WITH {_AS} " + " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM f" for i, a in enumerate(_COLS) for b in _COLS[i:]))
def corr_matrix(spark: SparkSession, d: str) -> DataFrame:
    return features.correlations(_as_features(spark, d), _COLS).withColumn("r", F.round("r", 6))


@query(f"WITH {_AS} " + " UNION ALL ".join(f"""SELECT '{c}' AS "column", count({c}) AS "count", round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, round(min({c}), 6) AS min,
  round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50, round(quantile_cont({c}, 0.75), 6) AS q75, round(max({c}), 6) AS max FROM f""" for c in _COLS))
def feature_profile(spark: SparkSession, d: str) -> DataFrame:
    p = features.profile(_as_features(spark, d), _COLS)
    return p.withColumns({c: F.round(c, 6) for c in p.columns if c not in ("column", "count")})


# ---------------------------------------------------------------- histories and joins along sessions

_KINDS = {"click": "event_type = 'click'", "view": "event_type = 'view'"}
_READY = "event_type = 'purchase'"


def _numbered(spark: SparkSession, d: str) -> DataFrame:
    return asof.number_kinds(points(spark, d), "session_id", ["seq"], {k: F.expr(c) for k, c in _KINDS.items()})


_LASTK = f"""WITH {_P}, c AS (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY seq) AS i FROM p WHERE event_type = 'click'),
  r AS (SELECT p.*, (SELECT count(*) FROM c WHERE c.session_id = p.session_id AND c.seq <= p.seq) AS n FROM p WHERE event_type = 'purchase'),
  h AS (SELECT r.session_id, r.seq, r.tm, c.seq AS h_seq, c.tm AS h_tm, c.y AS h_y FROM r JOIN c ON c.session_id = r.session_id AND c.i > r.n - 5 AND c.i <= r.n)"""


@query(_LASTK + " SELECT session_id, seq, h_seq FROM h")
def last_k_history(spark: SparkSession, d: str) -> DataFrame:
    return asof.last_k(_numbered(spark, d), "session_id", F.expr(_READY), "click", F.expr(_KINDS["click"]), 5, ["seq"], ["seq"])


@query(_LASTK + " SELECT session_id, seq, count(*) AS n_history, round(sum(h_y), 6) AS sum_history FROM h WHERE h_tm < tm GROUP BY ALL")
def page_ready_snapshot(spark: SparkSession, d: str) -> DataFrame:
    h = asof.last_k(_numbered(spark, d), "session_id", F.expr(_READY), "click", F.expr(_KINDS["click"]), 5, ["tm", "y"], ["seq", "tm"])
    return h.where("h_tm < tm").groupBy("session_id", "seq").agg(F.count(F.lit(1)).alias("n_history"), F.round(F.sum("h_y"), 6).alias("sum_history"))


@query(f"""WITH {_P} SELECT session_id, seq, prev_seq, prev_tm FROM (SELECT *, last_value(CASE WHEN event_type = 'click' THEN seq END IGNORE NULLS) OVER w AS prev_seq,
  last_value(CASE WHEN event_type = 'click' THEN tm END IGNORE NULLS) OVER w AS prev_tm FROM p
  WINDOW w AS (PARTITION BY session_id ORDER BY tm, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) WHERE event_type = 'purchase'""")
def asof_prev_click(spark: SparkSession, d: str) -> DataFrame:
    out = asof.nearest_before(points(spark, d), "session_id", ["tm", "seq"], F.expr(_KINDS["click"]), ["seq", "tm"])
    return out.where(_READY).select("session_id", "seq", "prev_seq", "prev_tm")


@query(f"""WITH {_P}, c AS (SELECT session_id, seq, lag(seq) OVER (PARTITION BY session_id ORDER BY seq) AS before FROM p WHERE event_type = 'click')
  SELECT c.session_id, c.seq, count(v.seq) AS n_between, round(coalesce(sum(v.y), 0), 6) + 0.0 AS sum_between
  FROM c LEFT JOIN (SELECT * FROM p WHERE event_type = 'view') v ON v.session_id = c.session_id AND v.seq < c.seq AND v.seq > coalesce(c.before, -1) GROUP BY ALL""")
def scroll_between_clicks(spark: SparkSession, d: str) -> DataFrame:
    out = asof.between(points(spark, d), "session_id", ["seq"], F.expr(_KINDS["click"]), F.expr(_KINDS["view"]), F.col("y"))
    return out.select("session_id", "seq", "n_between", round6(F.col("sum_between")).alias("sum_between"))


@query(f"""WITH {_P} SELECT session_id, max(seq) AS seq, arg_max(tm, seq) + CASE WHEN NOT bool_or(event_type = 'purchase') AND bool_or(event_type = 'signup') THEN 1 ELSE 0 END AS cutoff,
  CASE WHEN NOT bool_or(event_type = 'purchase') AND bool_or(event_type = 'signup') THEN 'first_qml_session_end' ELSE 'session_end_or_no_next_ready' END AS reason FROM p GROUP BY session_id""")
def synthetic_session_end(spark: SparkSession, d: str) -> DataFrame:
    from clickloom.operators.snapshots import session_ends

    act = F.when(F.col("event_type") == "purchase", "qml.ready").when(F.col("event_type") == "signup", "qml")
    own = points(spark, d).withColumns({"act": act, "site_id": F.lit("s"), "device_type": F.lit("desktop"), "n_pointer": F.lit(0).cast("long"), "n_scroll": F.lit(0).cast("long")})
    return session_ends(own).select("session_id", "seq", F.col("tm").alias("cutoff"), F.col("synthetic_reason").alias("reason"))


@query(f"""WITH {_P}, q AS (SELECT *, CASE WHEN CAST(x AS BIGINT) % 7 = 0 AND session_id % 3 <> 0 THEN CAST(x AS BIGINT) % 2 <> 0 END AS mb, event_type = 'view' AND CAST(x AS BIGINT) % 5 = 0 AS touch FROM p),
  m AS (SELECT session_id, bool_or(mb IS NOT NULL) AS has_mb, bool_or(touch) AS touched, arg_max(mb, seq) FILTER (event_type = 'purchase' AND mb IS NOT NULL) AS last_mb FROM q GROUP BY 1)
  SELECT q.session_id, q.seq, CASE WHEN coalesce(CASE WHEN touched AND NOT has_mb THEN true ELSE last_mb END, q.mb, NOT has_mb AND q.touch) THEN 'mobile' ELSE 'desktop' END AS device_type
  FROM q JOIN m USING (session_id)""")
def route_sessions(spark: SparkSession, d: str) -> DataFrame:
    from clickloom.operators.routing import route

    k = F.col("x").cast("long")
    r = points(spark, d).withColumns({
        "site_id": F.lit("s"), "act": F.when(F.col("event_type") == "purchase", "qml.ready"),
        "mb": F.when((k % 7 == 0) & (F.col("session_id") % 3 != 0), k % 2 != 0), "touch": (F.col("event_type") == "view") & (k % 5 == 0),
    })
    return route(r).select("session_id", "seq", "device_type")


@query(f"""WITH {_P} SELECT session_id, seq, CAST(sum(gap) OVER (PARTITION BY session_id ORDER BY tm, seq) AS BIGINT) AS pauses FROM (SELECT *, CASE WHEN tm - lag(tm) OVER (PARTITION BY session_id ORDER BY tm, seq) > 15000000 THEN 1 ELSE 0 END AS gap FROM p)""")
def pause_reset_groups(spark: SparkSession, d: str) -> DataFrame:
    return asof.pause_groups(points(spark, d), "session_id", ["tm", "seq"], "tm", 15_000_000).select("session_id", "seq", "pauses")


# ---------------------------------------------------------------- metadata, upserts, diffs

_META = "CASE WHEN o_orderstatus = 'O' THEN '' ELSE o_orderpriority END"


def _meta(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "orders").select("o_custkey", "o_orderkey", F.when(F.col("o_orderstatus") == "O", "").otherwise(F.col("o_orderpriority")).alias("ip"))


@query(f"SELECT o_custkey, arg_min({_META}, o_orderkey) FILTER ({_META} <> '') AS ip FROM orders GROUP BY 1")
def first_non_empty_meta(spark: SparkSession, d: str) -> DataFrame:
    return publish.first_known(_meta(spark, d), ["o_custkey"], ("ip",), "o_orderkey")


@query(f"SELECT o_custkey, arg_min({_META}, o_orderkey) AS ip FROM orders GROUP BY 1")
def first_record_meta(spark: SparkSession, d: str) -> DataFrame:
    return publish.first_known(_meta(spark, d), ["o_custkey"], ("ip",), "o_orderkey", even_empty=True)


@query(f"SELECT o_custkey, arg_max({_META}, o_orderkey) FILTER ({_META} <> '') AS ip FROM orders GROUP BY 1")
def last_non_empty_meta(spark: SparkSession, d: str) -> DataFrame:
    return publish.last_known(_meta(spark, d), ["o_custkey"], ("ip",), F.col("o_orderkey"))


@query(f"""WITH f AS (SELECT o_custkey, arg_min({_META}, o_orderkey) AS ip FROM orders GROUP BY 1), l AS (SELECT o_custkey, arg_max({_META}, o_orderkey) FILTER ({_META} <> '') AS ip FROM orders GROUP BY 1)
  SELECT c_custkey, coalesce(nullif(f.ip, ''), nullif(l.ip, ''), '') AS ip FROM customer LEFT JOIN f ON f.o_custkey = c_custkey LEFT JOIN l ON l.o_custkey = c_custkey""")
def metadata_fallback(spark: SparkSession, d: str) -> DataFrame:
    m = _meta(spark, d).withColumnRenamed("o_custkey", "c_custkey")
    now, before = publish.first_known(m, ["c_custkey"], ("ip",), "o_orderkey", even_empty=True), publish.last_known(m, ["c_custkey"], ("ip",), F.col("o_orderkey"))
    return publish.with_metadata(read(spark, d, "customer").select("c_custkey"), now, before, ["c_custkey"], ("ip",))


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def changed_sessions_semi(spark: SparkSession, d: str) -> DataFrame:
    changed = read(spark, d, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return features.restrict(read(spark, d, "orders").select("o_orderkey", "o_custkey"), changed, "o_custkey")


_UPD = "SELECT o_custkey AS k, arg_max(o_totalprice, o_orderkey) AS v FROM orders WHERE o_orderstatus = 'F' GROUP BY 1"


@query(f"WITH u AS ({_UPD}) SELECT k, round(v, 2) AS v FROM u UNION ALL SELECT c_custkey, round(c_acctbal, 2) FROM customer WHERE c_custkey NOT IN (SELECT k FROM u)")
def upsert_keep_last(spark: SparkSession, d: str) -> DataFrame:
    old = read(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("v"))
    new = read(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("k"), F.col("o_totalprice").alias("v"), F.col("o_orderkey").alias("_order"))
    return features.upsert(old, new, ["k"]).select("k", F.round("v", 2).alias("v"))


_SC = """a AS (SELECT doc_id AS session_id, quality * 0.5 AS probability_bot_umap FROM labels WHERE doc_id % 3 <> 0), b AS (SELECT doc_id AS session_id, toxic * 0.25 AS probability_lgbm FROM labels WHERE doc_id % 2 = 0)"""


def _scores(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    lab = read(spark, d, "labels")
    return (
        lab.where("doc_id % 3 <> 0").select(F.col("doc_id").alias("session_id"), (F.col("quality") * 0.5).alias("probability_bot_umap")),
        lab.where("doc_id % 2 = 0").select(F.col("doc_id").alias("session_id"), (F.col("toxic") * 0.25).alias("probability_lgbm")),
    )


@query(f"WITH {_SC} SELECT coalesce(a.session_id, b.session_id) AS session_id, CAST(probability_bot_umap AS DOUBLE) AS probability_bot_umap, CAST(probability_lgbm AS DOUBLE) AS probability_lgbm FROM a FULL JOIN b ON a.session_id = b.session_id")
def score_merge_full_outer(spark: SparkSession, d: str) -> DataFrame:
    return scoring.merge_scores(*_scores(spark, d))


_OLD = "o AS (SELECT doc_id AS session_id, CASE WHEN doc_id % 4 = 0 THEN 0.5 END AS pu, CAST(0.0 AS DOUBLE) AS pl FROM labels WHERE doc_id % 5 <> 0)"
_NEW = f"n AS (SELECT coalesce(a.session_id, b.session_id) AS session_id, CAST(probability_bot_umap AS DOUBLE) AS pu, CAST(probability_lgbm AS DOUBLE) AS pl FROM a FULL JOIN b ON a.session_id = b.session_id)"


def _old(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "labels").where("doc_id % 5 <> 0").select(F.col("doc_id").alias("session_id"), F.when(F.col("doc_id") % 4 == 0, 0.5).alias("probability_bot_umap"), F.lit(0.0).alias("probability_lgbm"))


@query(f"WITH {_SC}, {_NEW}, {_OLD} SELECT coalesce(o.session_id, n.session_id) AS session_id, CAST(coalesce(n.pu, o.pu) AS DOUBLE) AS probability_bot_umap, CAST(coalesce(n.pl, o.pl) AS DOUBLE) AS probability_lgbm FROM o FULL JOIN n ON o.session_id = n.session_id")
def score_merge_incremental(spark: SparkSession, d: str) -> DataFrame:
    return scoring.merge_scores(*_scores(spark, d), existing=_old(spark, d))


@query(f"WITH {_SC}, {_NEW}, {_OLD} SELECT n.session_id, n.pu AS probability_bot_umap, n.pl AS probability_lgbm FROM n LEFT JOIN o ON o.session_id = n.session_id WHERE o.session_id IS NULL OR o.pu IS DISTINCT FROM n.pu OR o.pl IS DISTINCT FROM n.pl")
def score_diff(spark: SparkSession, d: str) -> DataFrame:
    return publish.changed_scores(_old(spark, d), scoring.merge_scores(*_scores(spark, d)), ["session_id"])


@query("""SELECT o_custkey AS session_id, o_orderkey AS v FROM orders WHERE o_orderstatus = 'F' UNION ALL
  SELECT o_custkey, o_orderkey FROM orders WHERE o_orderstatus = 'O' AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')""")
def history_upsert(spark: SparkSession, d: str) -> DataFrame:
    o = read(spark, d, "orders").select(F.col("o_custkey").alias("session_id"), F.col("o_orderkey").alias("v"), "o_orderstatus")
    return publish.history_upsert(o.where("o_orderstatus = 'O'").drop("o_orderstatus"), o.where("o_orderstatus = 'F'").drop("o_orderstatus"), ["session_id"])


_DAY = "2024-01-15"


@query(f"SELECT DISTINCT event_type AS device_type, user_id AS session_id FROM events WHERE strftime(ts, '%Y-%m-%d %H:%M:%S') LIKE '{_DAY}%'")
def today_keys(spark: SparkSession, d: str) -> DataFrame:
    log = read(spark, d, "events").select(F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("date"), F.col("user_id").alias("session_id"), F.col("event_type").alias("device_type"))
    return publish.today_keys(log, _DAY, ["device_type", "session_id"])


@query(f"""WITH t AS (SELECT DISTINCT event_type, user_id FROM events WHERE strftime(ts, '%Y-%m-%d') = '{_DAY}')
  SELECT event_type AS device_type, user_id AS session_id, max(event_id) AS last_event FROM events JOIN t USING (event_type, user_id) GROUP BY ALL""")
def pruned_history(spark: SparkSession, d: str) -> DataFrame:
    e = read(spark, d, "events")
    key = ["device_type", "session_id"]
    log = e.select(F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("date"), F.col("user_id").alias("session_id"), F.col("event_type").alias("device_type"))
    rows = e.groupBy(F.col("event_type").alias("device_type"), F.col("user_id").alias("session_id")).agg(F.max("event_id").alias("last_event"))
    return publish.pruned_history(rows.where("session_id % 2 = 0"), rows.where("session_id % 2 = 1"), log, _DAY, key)


@query("SELECT 'desktop' AS device_type, o_orderkey AS session_id, o_totalprice AS score FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT 'mobile', o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'O'")
def union_devices_sorted(spark: SparkSession, d: str) -> DataFrame:
    o = read(spark, d, "orders").select(F.col("o_orderkey").alias("session_id"), F.col("o_totalprice").alias("score"), "o_orderstatus")
    parts = {k: o.where(F.col("o_orderstatus") == s).drop("o_orderstatus") for k, s in (("mobile", "O"), ("desktop", "F"))}
    return publish.combined(parts).orderBy("device_type", "session_id")


# ---------------------------------------------------------------- scaling and scores


@query("""WITH r AS (SELECT min(p_size) AS s0, max(p_size) AS s1, min(p_retailprice) AS r0, max(p_retailprice) AS r1 FROM part)
  SELECT p_partkey, round(p_size * (1.0 / (s1 - s0)) + (-s0 * (1.0 / (s1 - s0))), 6) + 0.0 AS p_size, round(p_retailprice * (1.0 / (r1 - r0)) + (-r0 * (1.0 / (r1 - r0))), 6) + 0.0 AS p_retailprice FROM part, r""")
def minmax_scale(spark: SparkSession, d: str) -> DataFrame:
    p = read(spark, d, "part")
    s = scaling.scale(p, scaling.fit(p, ["p_size", "p_retailprice"]), ["p_partkey"])
    return s.withColumns({c: round6(F.col(c)) for c in ("p_size", "p_retailprice")})


_CENTROID = {"centroid_x": 0.05, "centroid_y": -0.1, "bot_distance_p95": 1.5, "all_distance_p99": 2.5}
_DIST = "sqrt((CAST(embedding[1] AS DOUBLE) - 0.05) ** 2 + (CAST(embedding[2] AS DOUBLE) + 0.1) ** 2)"


def _distances(spark: SparkSession, d: str) -> DataFrame:
    x = [F.get("embedding", F.lit(i)).cast("double") for i in (0, 1)]
    return read(spark, d, "embeddings").select("vec_id", scoring.distance(x[0], x[1], _CENTROID).alias("distance"))


@query(f"SELECT vec_id, round({_DIST}, 6) AS distance FROM embeddings")
def centroid_distance(spark: SparkSession, d: str) -> DataFrame:
    return _distances(spark, d).withColumn("distance", F.round("distance", 6))


@query(f"SELECT vec_id, round(greatest(least(greatest(1 - {_DIST} * 4 / 1.5, 0), 1), 0.01), 6) AS probability FROM embeddings")
def prob_linear(spark: SparkSession, d: str) -> DataFrame:
    return _distances(spark, d).select("vec_id", F.round(scoring.probability(F.col("distance") * 4, _CENTROID, "linear"), 6).alias("probability"))


@query(f"SELECT vec_id, round(greatest(CASE WHEN {_DIST} * 4 <= 1.5 THEN greatest(1 - {_DIST} * 4 / 1.5, 0.01) ELSE 0.01 * exp(-({_DIST} * 4 - 1.5) / (1.0 / ln(10))) END, 0.001), 6) AS probability FROM embeddings")
def prob_decay(spark: SparkSession, d: str) -> DataFrame:
    return _distances(spark, d).select("vec_id", F.round(scoring.probability(F.col("distance") * 4, _CENTROID), 6).alias("probability"))


_STORED = 8  # neighbours of each vector among the stored points
_SIGMA = f"""list_reduce(list_transform(range(65), lambda i: {{'lo': CAST(0 AS DOUBLE), 'hi': CAST('inf' AS DOUBLE), 'mid': CAST(1 AS DOUBLE)}}), lambda s, x:
  CASE WHEN abs(list_sum(list_transform(ds[2:], lambda v: CASE WHEN v > 0 THEN exp(-v / s.mid) ELSE 1 END)) - log2({_STORED})) < 1e-5 THEN s
    WHEN list_sum(list_transform(ds[2:], lambda v: CASE WHEN v > 0 THEN exp(-v / s.mid) ELSE 1 END)) > log2({_STORED}) THEN {{'lo': s.lo, 'hi': s.mid, 'mid': (s.lo + s.mid) / 2}}
    ELSE {{'lo': s.mid, 'hi': s.hi, 'mid': CASE WHEN isinf(s.hi) THEN 2 * s.mid ELSE (s.mid + s.hi) / 2 END}} END).mid"""


@query(f"""WITH c AS (SELECT label, embedding[1] >= 0 AS side, i, avg(CAST(embedding[i] AS DOUBLE)) AS v FROM embeddings, range(1, 65) r(i) WHERE label IS NOT NULL GROUP BY ALL),
  p AS (SELECT label, side, list(v ORDER BY i) AS v, row_number() OVER (ORDER BY label, side) - 1 AS n FROM c GROUP BY label, side),
  d AS (SELECT vec_id, n, p.v, sqrt(list_sum(list_transform(range(1, 65), lambda i: (CAST(embedding[i] AS DOUBLE) - p.v[i]) ** 2))) AS d FROM embeddings, p),
  k AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, n) AS rank FROM d) WHERE rank <= {_STORED}),
  s AS (SELECT vec_id, ds, greatest({_SIGMA}, 0.001 * list_avg(ds)) AS sigma FROM (SELECT vec_id, list(d ORDER BY rank) AS ds FROM k GROUP BY 1)),
  w AS (SELECT k.*, CASE WHEN d <= 0 THEN 1 ELSE exp(-d / sigma) END AS w FROM k JOIN s USING (vec_id))
  SELECT vec_id, CAST(rank AS INTEGER) AS rank, CAST(n AS INTEGER) AS neighbour, round(d, 6) AS distance, round(w, 6) AS weight,
    round(sum(w * v[1]) OVER (PARTITION BY vec_id) / sum(w) OVER (PARTITION BY vec_id), 6) + 0.0 AS start_x, round(sum(w * v[2]) OVER (PARTITION BY vec_id) / sum(w) OVER (PARTITION BY vec_id), 6) + 0.0 AS start_y FROM w""")
def neighbour_graph(spark: SparkSession, d: str) -> DataFrame:
    """Nearest stored points of every vector, their weights and the place where its projection starts. Stored: two mean vectors a label."""
    import numpy as np
    import pyarrow as pa

    e = read(spark, d, "embeddings")
    parts = e.where("label is not null").select("label", (F.get("embedding", F.lit(0)) >= 0).alias("side"), F.posexplode("embedding").alias("i", "x"))
    means = parts.groupBy("label", "side", "i").agg(F.avg(F.col("x").cast("double")).alias("v"))
    rows = means.groupBy("label", "side").agg(F.array_sort(F.collect_list(F.struct("i", "v"))).alias("v")).orderBy("label", "side").select(F.col("v.v").alias("v")).collect()  # two a label
    points = np.array([r["v"] for r in rows], float)
    model = neighbours.NeighbourProjection(tuple(f"e{i}" for i in range(points.shape[1])), points, points[:, :2], k=_STORED)

    def run(batches):
        for b in batches:
            x = np.asarray(b.column("embedding").flatten(), float).reshape(b.num_rows, -1)
            at, far = model.nearest(x)
            w = model.weights(far)
            z = model.start(at, w)
            k = at.shape[1]
            columns = [np.tile(np.arange(1, k + 1, dtype=np.int32), len(x)), at.ravel().astype(np.int32), far.ravel(), w.ravel(), np.repeat(z[:, 0], k), np.repeat(z[:, 1], k)]
            ids = b.column("vec_id").take(pa.array(np.repeat(np.arange(len(x)), k)))
            yield pa.RecordBatch.from_arrays([ids, *map(pa.array, columns)], names=["vec_id", "rank", "neighbour", "distance", "weight", "start_x", "start_y"])

    out = e.select("vec_id", "embedding").mapInArrow(run, "vec_id long, rank int, neighbour int, distance double, weight double, start_x double, start_y double")
    return out.select("vec_id", "rank", "neighbour", *(round6(F.col(c)).alias(c) for c in ("distance", "weight", "start_x", "start_y")))


@query("SELECT min(p) AS min, round(median(p), 6) AS median, max(p) AS max FROM (SELECT round(value / 100, 6) AS p FROM events)")
def score_distribution(spark: SparkSession, d: str) -> DataFrame:
    return scoring.distribution(read(spark, d, "events").select(F.round(F.col("value") / 100, 6).alias("p")), "p").withColumn("median", F.round("median", 6))


_TREES = scoring.Trees(
    ("l_quantity", "l_discount", "l_tax"),
    ({"feature": [0, 1], "threshold": [24.5, 0.05], "left": [1, -3], "right": [-1, -2], "leaf": [0.4, -0.3, 0.1]}, {"feature": [2], "threshold": [0.04], "left": [-1], "right": [-2], "leaf": [0.2, -0.1]}),
    base=-0.1,
)


@query("""SELECT l_orderkey, l_linenumber, round(1 / (1 + exp(-(-0.1 + CASE WHEN l_quantity <= 24.5 THEN CASE WHEN l_discount <= 0.05 THEN 0.1 ELSE -0.3 END ELSE 0.4 END
  + CASE WHEN l_tax <= 0.04 THEN 0.2 ELSE -0.1 END))), 6) AS probability_lgbm FROM lineitem""")
def tree_scores(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.round(_TREES.column(), 6).alias("probability_lgbm"))


# ---------------------------------------------------------------- pages, tokens, text fields

_SITE_PATTERNS = ((r"^/en/[0-9]+/?$", "en_item"), (r"^/en/", "en"), (r"^/(fr|de|es)/[0-9]+/?$", "other_item"), (r"\.html$", "page"))
_PATHSQL = "split_part(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '?', 1)"


def _type_sql(path: str) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches({path}, '{p}') THEN '{t}'" for p, t in _SITE_PATTERNS) + " END"


@query(f"SELECT page_id, {_type_sql(_PATHSQL)} AS token FROM pages")
def url_tokens(spark: SparkSession, d: str) -> DataFrame:
    path = F.regexp_extract("url", r"://[^/?#]*([^?#]*)", 1)
    return read(spark, d, "pages").select("page_id", scoring.page_type(path, _SITE_PATTERNS).alias("token"))


@query(f"""WITH v AS (SELECT page_id % 40 AS session_id, page_id % 7 AS c, page_id, {_PATHSQL} AS path FROM pages),
  f AS (SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY session_id, c ORDER BY page_id % 13, page_id) = 1)
  SELECT session_id, coalesce(string_agg({_type_sql('path')}, ' ' ORDER BY page_id % 13, page_id), '') AS tokens FROM f GROUP BY session_id""")
def first_page_sequence(spark: SparkSession, d: str) -> DataFrame:
    v = read(spark, d, "pages").select((F.col("page_id") % 40).alias("session_id"), (F.col("page_id") % 7).alias("page_id_"), F.col("page_id").alias("seq"), (F.col("page_id") % 13).cast("double").alias("ts"), F.regexp_extract("url", r"://[^/?#]*([^?#]*)", 1).alias("uri"))
    s = scoring.page_sequences(v.withColumnRenamed("page_id_", "page_id"), patterns=_SITE_PATTERNS)
    return s.select("session_id", F.array_join("tokens", " ").alias("tokens"))


@query("SELECT conv_id, arg_min(role, turn) AS first_role, arg_min(text, turn) AS first_text, count(*) AS turns FROM conversations GROUP BY conv_id")
def first_turn(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("conv_id").orderBy("turn")
    c = read(spark, d, "conversations").withColumns({"rn": F.row_number().over(w), "turns": F.count(F.lit(1)).over(Window.partitionBy("conv_id"))})
    return c.where("rn = 1").select("conv_id", F.col("role").alias("first_role"), F.col("text").alias("first_text"), "turns")


_VOCAB = {"user": 0, "assistant": 1}


@query("""SELECT conv_id, array_to_string(list_transform(list_filter(r[1:4], lambda x: x IN ('user', 'assistant')), lambda x: CASE x WHEN 'user' THEN 0 ELSE 1 END), ' ') AS ids
  FROM (SELECT conv_id, list(role ORDER BY turn) AS r FROM conversations GROUP BY conv_id)""")
def token_encode(spark: SparkSession, d: str) -> DataFrame:
    c = read(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role"))).alias("r")).withColumn("tokens", F.col("r.role"))
    return c.select("conv_id", F.array_join(scoring.token_ids("tokens", _VOCAB, 4).cast("array<string>"), " ").alias("ids"))


@query("SELECT event_id, list_has_any(json_keys(props), ['tmv', 'k']) AS touched FROM events")
def json_keys_touch(spark: SparkSession, d: str) -> DataFrame:
    keys = F.json_object_keys("props")
    return read(spark, d, "events").select("event_id", F.coalesce(F.arrays_overlap(keys, F.array(F.lit("tmv"), F.lit("k"))), F.lit(False)).alias("touched"))


_LONG36 = "substr(repeat(to_base(event_id * 7919 + 35, 36), 14), 1, 13 + CAST(event_id % 28 AS INTEGER))"
_VALUE36 = "list_reduce(list_transform(string_split(substr(w, 5 * k + 1, 5), ''), lambda c: CAST(instr('0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ', c) - 1 AS BIGINT)), lambda v, c: v * 36 + c)"


@query(f"""WITH t AS (SELECT event_id, user_id, {_LONG36} AS w FROM events), l AS (SELECT *, list_transform(range((length(w) + 4) // 5), lambda k: {{'v': CAST({_VALUE36} AS DOUBLE), 'n': length(substr(w, 5 * k + 1, 5))}}) AS parts FROM t)
  SELECT event_id, CAST(user_id AS DOUBLE) AS u, CAST(-event_id AS DOUBLE) AS e, list_reduce(parts, lambda a, x: {{'v': a.v * CAST(pow(36, x.n) AS DOUBLE) + x.v, 'n': x.n}}).v AS w FROM l""")
def base36_decode(spark: SparkSession, d: str) -> DataFrame:
    """Numbers of few digits, negative ones, and ones of 13 to 40 digits."""
    to36 = lambda c: F.conv(c.cast("string"), 10, 36)
    long = F.substring(F.repeat(to36(F.col("event_id") * 7919 + 35), 14), F.lit(1), (13 + F.col("event_id") % 28).cast("int"))
    e = read(spark, d, "events").select("event_id", F.lower(to36(F.col("user_id"))).alias("a"), F.concat(F.lit("-"), to36(F.col("event_id"))).alias("b"), long.alias("c"))
    return e.select("event_id", F.expr(base36("a")).alias("u"), (F.expr(base36("b")) + 0.0).alias("e"), F.expr(base36("c")).alias("w"))


@query("""SELECT c_custkey, CASE WHEN lower(trim(c_mktsegment)) IN ('', 'nan', 'none', 'null', '<na>', 'building') THEN NULL ELSE c_mktsegment END AS segment, round(c_acctbal / nullif(c_nationkey, 0), 6) AS share FROM customer""")
def null_cleanup(spark: SparkSession, d: str) -> DataFrame:
    from clickloom.functions.expressions import text_or_null

    seg = text_or_null(F.when(F.col("c_mktsegment") == "BUILDING", "NaN").otherwise(F.col("c_mktsegment")))
    return read(spark, d, "customer").select("c_custkey", seg.alias("segment"), F.round(ratio(F.col("c_acctbal"), F.col("c_nationkey")), 6).alias("share"))


@query("SELECT p_partkey, CAST(p_retailprice AS DOUBLE) AS p_retailprice, CASE WHEN p_size % 5 = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(p_size AS DOUBLE) END AS p_size FROM part")
def column_alignment(spark: SparkSession, d: str) -> DataFrame:
    p = read(spark, d, "part").withColumn("p_size", F.when(F.col("p_size") % 5 != 0, F.col("p_size")))
    return scaling.aligned(p, ["p_retailprice", "p_size"], ["p_partkey"])


@query()
def session_pipeline(spark: SparkSession, d: str) -> DataFrame:
    """Events written as log lines, then parsed, routed, decoded, summed up as snapshots and as session features."""
    from clickloom.plans.pipeline import device_features, log_records

    return device_features(log_records(event_logs(spark, d)), "desktop")


def event_logs(spark: SparkSession, d: str) -> DataFrame:
    """site_id, seq, line: a log in which clicks carry pointer tracks, views scrolls, and purchases are page-ready."""
    e = points(spark, d).withColumns({"a": F.lower(F.conv(F.col("x").cast("long").cast("string"), 10, 36)), "b": F.lower(F.conv(F.col("y").cast("long").cast("string"), 10, 36))})
    step = F.concat_ws(",", F.lit("5"), "a", "b")
    track = F.concat_ws(";", step, F.concat_ws(",", F.lit("a"), "b", "a"), F.concat_ws(",", F.lit("3"), "a", "a"))
    body = F.when(F.col("event_type") == "click", F.struct(F.struct(track.alias("l")).alias("mmv"), F.lit(None).cast("struct<l:string>").alias("scl"), F.lit(1).alias("clk")))
    body = body.when(F.col("event_type") == "view", F.struct(F.lit(None).cast("struct<l:string>").alias("mmv"), F.struct(track.alias("l")).alias("scl"), F.lit(None).cast("int").alias("clk")))
    act = F.when(F.col("event_type") == "purchase", "qml.ready").when(F.col("event_type") == "signup", "qml").otherwise("track")
    record = F.struct(F.struct(F.col("session_id").cast("string").alias("a"), (F.col("seq") % 3).cast("string").alias("c")).alias("sess"), act.alias("act"), F.col("tm").alias("ts"), F.struct(F.col("tm"), F.struct(body.alias("e")).alias("data")).alias("prm"))
    return e.select(F.lit("1_1").alias("site_id"), "seq", F.to_json(record).alias("line"))


# ---------------------------------------------------------------- the engine's own functions

#: Points a step of 1.5 apart, none of them noise, and without pauses, so that plain SQL sees the same trajectory.
_MOVED = (
    _P.replace("p AS (", "p0 AS (", 1)
    + """, p AS (SELECT session_id, seq, tm / 1000000 AS tm, 1.5 * row_number() OVER (PARTITION BY session_id ORDER BY tm, seq) AS x, y * 1.0007391 AS y, event_type FROM p0)"""
)
_S2 = _S.replace(_P, _MOVED)
_REPEATED = """, seg AS (SELECT session_id, i, x, y, lead(x) OVER w AS x1, lead(y) OVER w AS y1, lead(x, 2) OVER w AS x2, lead(y, 2) OVER w AS y2 FROM s WINDOW w AS (PARTITION BY session_id ORDER BY i)),
rep AS (SELECT a.session_id, avg(CASE WHEN greatest(0, 1 - (sqrt(((b.x1 - b.x) - (a.x1 - a.x)) ** 2 + ((b.y1 - b.y) - (a.y1 - a.y)) ** 2) + sqrt(((b.x2 - b.x) - (a.x2 - a.x)) ** 2 + ((b.y2 - b.y) - (a.y2 - a.y)) ** 2)) / 3 / 50) > 0.8
  THEN 1.0 ELSE 0.0 END) AS repetition_patterns FROM seg a JOIN seg b ON a.session_id = b.session_id AND b.i >= a.i + 3 WHERE a.x2 IS NOT NULL AND b.x2 IS NOT NULL GROUP BY 1)"""
_ALL = (*trajectory.COMMON, *trajectory.DESKTOP_ONLY)


def _engine_sql(points: str = _S2, group: str = "CAST(n AS DOUBLE)") -> str:
    """All features and the score over the points that `points` names; group: the size of a session's one group of points."""
    terms = ["CASE " + " ".join(f"WHEN {name} {op} {limit} THEN CAST({p} AS DOUBLE)" for op, limit, p in cases) + " ELSE 0 END" for name, _, cases in trajectory.SCORE_TERMS]
    score = f"least(1.0, {' + '.join(terms)})"
    shown = ", ".join(f"round({'ln(1 + jerk)' if c == 'jerk' else c}, 6) + 0.0 AS {c}" for c in (*_ALL, "l", "ms"))
    return points + _DIR + _ANG + _RUNS + _REPEATED + f""", f AS (SELECT b.*, CASE WHEN chord = 0 OR l = 0 THEN 1 ELSE chord / l END AS linearity, coalesce(direction_entropy, 0) AS direction_entropy,
  coalesce(angle_entropy, 0) AS angle_entropy, coalesce(long_straight_run_share, 0) AS long_straight_run_share, coalesce(repetition_patterns, 0) AS repetition_patterns, {group} AS mmv_points_per_group
  FROM ({_FLAT}) b LEFT JOIN de USING (session_id) LEFT JOIN ae USING (session_id) LEFT JOIN sr USING (session_id) LEFT JOIN rep USING (session_id))
  SELECT session_id, CAST(n AS INTEGER) AS n, {shown}, round({score}, 6) + 0.0 AS bot_score, {score} > 0.5 AS is_likely_bot FROM f WHERE n >= 3"""


def _tracks(p: DataFrame) -> DataFrame:
    return p.groupBy("session_id").agg(F.array_sort(F.collect_list(F.struct("tm", "seq", "x", "y"))).alias("p"))


@query(_engine_sql())
def engine_trajectory(spark: SparkSession, d: str) -> DataFrame:
    """All features and the full score of each session's track, by the function that the snapshots use."""
    order = Window.partitionBy("session_id").orderBy("tm", "seq")
    p = points(spark, d).withColumn("x", F.lit(1.5) * F.row_number().over(order)).withColumns({"y": F.col("y") * 1.0007391, "tm": F.col("tm") / 1_000_000})
    t = _tracks(p)
    s = trajectory.track_stats(F.col("p.x"), F.col("p.y"), F.col("p.tm"), F.array(F.size("p")), F.lit("desktop"))
    full = t.select("session_id", s.alias("s")).where("s.n is not null").select("session_id", "s.*")
    rounded = [round6(F.log1p(c) if c == "jerk" else F.col(c)).alias(c) for c in (*_ALL, "l", "ms", "bot_score")]
    return full.select("session_id", "n", *rounded, "is_likely_bot")


@query(f"""WITH RECURSIVE {_P}, q AS (SELECT session_id, tm / 10000 AS tm, CAST(x AS BIGINT) % 3 AS x, y / 20 AS y, CAST(row_number() OVER (PARTITION BY session_id ORDER BY tm, seq) AS BIGINT) AS i FROM p),
  r(session_id, i, px, py, pt, kept, run) AS (SELECT session_id, i, CAST(x AS DOUBLE), y, tm, true, 0 FROM q WHERE i = 1 UNION ALL
    SELECT session_id, i, CASE WHEN noise THEN px ELSE x END, CASE WHEN noise THEN py ELSE y END, CASE WHEN noise THEN pt ELSE tm END, NOT noise, CASE WHEN NOT noise AND tm - pt > 15000 THEN run + 1 ELSE run END
    FROM (SELECT q.*, r.px, r.py, r.pt, r.run, sqrt((q.x - r.px) ** 2 + (q.y - r.py) ** 2) < 1 AS noise FROM r JOIN q ON q.session_id = r.session_id AND q.i = r.i + 1)),
  k AS (SELECT *, max(run) OVER (PARTITION BY session_id) AS last_run, row_number() OVER (PARTITION BY session_id, run, kept ORDER BY i DESC) AS back FROM r),
  t AS (SELECT *, sqrt((px - lag(px) OVER w) ** 2 + (py - lag(py) OVER w) ** 2) AS dist FROM k WHERE kept AND run = last_run AND back <= 1000 WINDOW w AS (PARTITION BY session_id ORDER BY i)),
  size AS (SELECT session_id, count(*) AS all_points FROM q GROUP BY 1)
  SELECT session_id, CAST(count(*) AS INTEGER) AS n, round(max(pt) - min(pt), 3) AS ms, round(sum(dist), 6) AS l, arg_min(px, i) AS x0, round(arg_max(py, i), 6) AS y1,
    CASE WHEN max(run) > 0 THEN 0 ELSE CAST(max(all_points) AS DOUBLE) END AS mmv_points_per_group FROM t JOIN size USING (session_id) GROUP BY session_id HAVING count(*) >= 3""")
def engine_intake(spark: SparkSession, d: str) -> DataFrame:
    """Which points of a track stay: noise goes, a pause starts it anew, the last thousand count; after a pause no group size is known."""
    p = points(spark, d).withColumns({"x": F.pmod(F.col("x").cast("long"), F.lit(3)).cast("double"), "y": F.col("y") / 20})
    t = _tracks(p)
    s = trajectory.track_stats(F.col("p.x"), F.col("p.y"), F.transform("p.tm", lambda v: v / 10_000), F.array(F.size("p")), F.lit("desktop"))
    full = t.select("session_id", s.alias("s")).where("s.n is not null").select("session_id", "s.*")
    return full.select("session_id", "n", F.round("ms", 3).alias("ms"), F.round("l", 6).alias("l"), "x0", F.round("y1", 6).alias("y1"), "mmv_points_per_group")


#: The points that stay of each session's track, by one step a point: noise goes, a pause starts it anew, the last thousand count.
_STAYING = f"""WITH RECURSIVE {_P.replace("p AS (", "p0 AS (", 1)}, q AS (SELECT session_id, tm / 1000000 AS tm, x, y, CAST(row_number() OVER (PARTITION BY session_id ORDER BY tm, seq) AS BIGINT) AS i FROM p0),
  r(session_id, i, px, py, pt, kept, run) AS (SELECT session_id, i, x, y, tm, true, 0 FROM q WHERE i = 1 UNION ALL
    SELECT session_id, i, CASE WHEN noise THEN px ELSE x END, CASE WHEN noise THEN py ELSE y END, CASE WHEN noise THEN pt ELSE tm END, NOT noise, CASE WHEN NOT noise AND tm - pt > 15000 THEN run + 1 ELSE run END
    FROM (SELECT q.*, r.px, r.py, r.pt, r.run, sqrt((q.x - r.px) ** 2 + (q.y - r.py) ** 2) < 1 AS noise FROM r JOIN q ON q.session_id = r.session_id AND q.i = r.i + 1)),
  lasts AS (SELECT *, max(run) OVER (PARTITION BY session_id) AS last_run, row_number() OVER (PARTITION BY session_id, run, kept ORDER BY i DESC) AS back FROM r),
  grp AS (SELECT session_id, CASE WHEN max(run) > 0 THEN 0 ELSE CAST(count(*) AS DOUBLE) END AS group_size FROM r GROUP BY 1),
  p AS (SELECT session_id, i AS seq, pt AS tm, px AS x, py AS y FROM lasts WHERE kept AND run = last_run AND back <= 1000)"""


@query(_engine_sql(_S.replace(f"WITH {_P}", _STAYING), "(SELECT group_size FROM grp WHERE grp.session_id = b.session_id)"))
def track_features(spark: SparkSession, d: str) -> DataFrame:
    """`track_statistics`, rounded: the intake and all features of each session's track as it is."""
    full = track_statistics(spark, d)
    rounded = [round6(F.log1p(c) if c == "jerk" else F.col(c)).alias(c) for c in (*_ALL, "l", "ms", "bot_score")]
    return full.select("session_id", "n", *rounded, "is_likely_bot")


_LINE_ACT = "CASE event_type WHEN 'purchase' THEN 'qml.ready' WHEN 'signup' THEN 'qml' ELSE 'track' END"


@query(f"""WITH {_P}, q AS (SELECT *, CAST(x AS BIGINT) AS k FROM p WHERE seq % 13 <> 0)
  SELECT seq, CASE WHEN k % 5 <> 0 THEN 'u' || session_id END AS session_id, 'p' || (seq % 3) AS page_id, {_LINE_ACT} AS act, CAST(CASE WHEN k % 11 = 0 THEN 0 ELSE seq * 10 END AS DOUBLE) AS tm,
    CAST(seq AS DOUBLE) AS ts, '1.2.3.' || (k % 200) AS ip, CASE WHEN k % 2 = 0 THEN 'agent ' || (k % 9) ELSE '' END AS ua, CASE WHEN event_type = 'click' AND k % 6 <> 0 THEN '0,a,b;5,' || k || ',c' END AS mmv,
    event_type = 'click' AND k % 7 <> 0 AS clk, k % 4 = 0 AS touch, CASE k % 3 WHEN 0 THEN false WHEN 1 THEN true END AS mb FROM q""")
def parsed_records(spark: SparkSession, d: str) -> DataFrame:
    """Log lines of all kinds (broken ones, falsy sessions, times and clicks, `mb` at some depth) as typed records."""
    from clickloom.sources.events import parse

    k = "cast(x as bigint)"
    line = F.expr(f"""case when seq % 13 = 0 then concat('{{"sess":', seq) else concat('{{"sess":{{"a":"', case when {k} % 5 = 0 then '' else concat('u', session_id) end, '","c":"p', seq % 3, '"}},"act":"', {_LINE_ACT},
      '","ts":', seq, ',"ip":"1.2.3.', {k} % 200, '","prm":{{"tm":', case when {k} % 11 = 0 then 0 else seq * 10 end, ',"data":{{"e":{{', case when {k} % 4 = 0 then '"tst":1,' else '' end,
      '"mmv":{{"l":"', case when event_type = 'click' and {k} % 6 <> 0 then concat('0,a,b;5,', {k}, ',c') else '' end, '"}},"clk":', case when event_type = 'click' and {k} % 7 <> 0 then '{{"n":1}}' else '0' end, '}}}}}}',
      case when {k} % 2 = 0 then concat(',"ua":{{"v":"agent ', {k} % 9, '"}}') else '' end,
      case {k} % 3 when 0 then ',"z":[{{"y":{{"mb":0}}}}],"zz":{{"mb":1}}' when 1 then ',"mb":1,"z":{{"mb":0}}' else '' end, '}}') end""")
    logs = points(spark, d).select(F.lit("1_1").alias("site_id"), "seq", line.alias("line"))
    return parse(logs).select("seq", "session_id", "page_id", "act", "tm", "ts", "ip", "ua", "mmv", "clk", "touch", "mb")


@query("""WITH o AS (SELECT CASE WHEN o_custkey % 2 = 0 THEN '1_1' ELSE '1_2' END AS site_id, CAST(o_custkey % 50 AS VARCHAR) AS session_id, o_orderkey, o_totalprice FROM orders),
  now AS (SELECT site_id, session_id, count(*) AS n, max(o_orderkey) AS last FROM o GROUP BY ALL),
  old AS (SELECT site_id, session_id, count(*) AS n, max(o_orderkey) AS last FROM o WHERE o_orderkey % 40 <> 7 GROUP BY ALL)
  SELECT now.* FROM now LEFT JOIN old USING (site_id, session_id, n, last) WHERE NOT EXISTS (SELECT 1 FROM old o2 WHERE o2.site_id = now.site_id AND o2.session_id = now.session_id AND o2.n = now.n AND o2.last = now.last)""")
def sessions_to_score(spark: SparkSession, d: str) -> DataFrame:
    """Sessions, told apart by site, with records that the run before hadn't seen."""
    from clickloom.sources.store import KEY, Ledger, new_keys

    behind = 10**9  # what the run before had read lies before this offset
    o = read(spark, d, "orders").select(F.when(F.col("o_custkey") % 2 == 0, "1_1").otherwise("1_2").alias("site_id"), (F.col("o_custkey") % 50).cast("string").alias("session_id"), "o_orderkey")
    rows = o.withColumn("seq", F.col("o_orderkey") + F.when(F.col("o_orderkey") % 40 == 7, behind).otherwise(0))
    ledger = Ledger({s: {"inode": 0, "offset": 2 * behind, "generation": 0, "since": behind} for s in ("1_1", "1_2")})
    return rows.join(new_keys(rows, ledger.table(spark)), KEY, "left_semi").groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"), F.max("o_orderkey").alias("last"))


@query("""WITH o AS (SELECT CASE WHEN o_custkey % 2 = 0 THEN '1_1' ELSE '1_2' END AS site_id, CAST(o_custkey % 50 AS VARCHAR) AS session_id, CAST(o_totalprice AS DOUBLE) / 100000 AS x FROM orders),
  f AS (SELECT site_id, session_id, avg(x) AS x FROM o GROUP BY ALL), g AS (SELECT *, sqrt((0.5 * x - 0.2) ** 2 + (0.25 * x) ** 2) AS dist FROM (SELECT site_id, session_id, x * 2.0 - 1.0 AS x FROM f))
  SELECT site_id, session_id, round(greatest(CASE WHEN dist <= 0.9 THEN greatest(1 - dist / 0.9, 0.01) ELSE 0.01 * exp(-(dist - 0.9) / (0.5 / ln(0.01 / 0.001))) END, 0.001), 6) AS probability_bot_umap,
    round(1 / (1 + exp(-(CASE WHEN CAST(x AS FLOAT) <= CAST(1.9 AS FLOAT) THEN 0.75 ELSE -0.5 END + 0.25))), 6) AS probability_lgbm FROM g""")
def site_scores(spark: SparkSession, d: str) -> DataFrame:
    """Scaling, projection, probability and trees over sessions of two sites that share their ids."""
    from clickloom.plans.pipeline import Models, score

    o = read(spark, d, "orders").select(F.when(F.col("o_custkey") % 2 == 0, "1_1").otherwise("1_2").alias("site_id"), (F.col("o_custkey") % 50).cast("string").alias("session_id"), (F.col("o_totalprice").cast("double") / 100_000).alias("x"))
    feats = o.groupBy("site_id", "session_id").agg(F.avg("x").alias("x"))
    none = feats.select("site_id", "session_id", *(F.lit(None).cast(t).alias(c) for c, t in (("page_id", "string"), ("uri", "string"), ("ts", "double"), ("seq", "long"))))
    trees = scoring.Trees(("x",), ({"feature": [0], "threshold": [1.9], "left": [-1], "right": [-2], "leaf": [0.75, -0.5]},), base=0.25, embedding=2)
    m = Models({"x": {"scale": 2.0, "min": -1.0}}, scoring.Projection(("x",), ((0.5, 0.25),)), {"centroid_x": 0.2, "centroid_y": 0.0, "bot_distance_p95": 0.9, "all_distance_p99": 1.4}, trees)
    return score(none, feats, m).withColumns({c: F.round(c, 6) for c in scoring.SCORES})


_FEATURES = trajectory.features_of("desktop")
_STAT = lambda i: f"CASE WHEN (event_id + {i}) % 7 <> 0 THEN (value - 20) * {i + 1} / 10.0D END"
_KEPT = {"n": "CAST(1 + event_id % 90 AS INTEGER)", "ms": "value * 3.0D", "l": "value * 2.5D", "bot_score": "CAST(event_id % 100 AS DOUBLE) / 100.0D", "is_likely_bot": "event_id % 3 = 0"}
_TYPE = "CASE event_type WHEN 'click' THEN 'mmv_clk' WHEN 'purchase' THEN 'qml_ready' ELSE 'other' END"


def _feature_sql() -> str:
    """Every statistic of every feature, the ratios and the scroll statistics, over snapshots made of events."""
    plain = lambda x: re.sub(r"(?<=\d)D\b", "", x)
    made = ", ".join([*(f"CASE WHEN ok THEN {plain(_STAT(i))} END AS {c}" for i, c in enumerate(_FEATURES)), *(f"CASE WHEN ok THEN CAST({plain(_KEPT[c])} AS DOUBLE) END AS {c}" for c in ("n", "ms", "l", "bot_score"))])
    family = lambda name, x: [f"round(coalesce({f}, 0), 9) + 0.0 AS {name}_{n}" for n, f in (("min", f"min(abs({x}))"), ("max", f"max(abs({x}))"), ("mean", f"avg(abs({x}))"), ("std", f"stddev_pop({x})"))]
    columns = [c for n in ("n", "ms", "l") for c in family(f"mousemove_prm_data_b_{n}", n)] + [c for n in (*_FEATURES, "bot_score") for c in family(n if n.startswith("bot_") else f"bot_{n}", n)]
    share = lambda c: f"round(coalesce(avg(CASE WHEN ok THEN CASE WHEN {c} THEN 1.0 ELSE 0.0 END END), 0), 9) + 0.0"
    return f"""WITH e AS (SELECT user_id AS session_id, event_type IN ('click', 'purchase') AS ok, event_id, value FROM events),
  x AS (SELECT session_id, ok, event_id % 3 = 0 AS likely, {made}, CASE WHEN ok THEN list_filter([value - 20, CASE WHEN event_id % 5 <> 0 THEN 20 - 2 * value END], lambda v: true)[1:event_id % 3] END AS d FROM e),
  s AS (SELECT session_id, unnest(d) AS v FROM x WHERE ok), m AS (SELECT session_id, avg(v) AS m FROM s GROUP BY 1),
  sc AS (SELECT session_id, count(*) AS n, min(abs(v)) AS lo, max(abs(v)) AS hi, avg(abs(v)) AS mean, CASE WHEN bool_or(v IS NULL) THEN 0 ELSE sum(abs(v)) END AS total, stddev_pop(v) AS sd, avg(abs(v - m)) AS mad FROM s JOIN m USING (session_id) GROUP BY 1),
  f AS (SELECT session_id, {", ".join(columns)}, {share("likely")} AS bot_is_likely_bot_ratio, count(*) FILTER (ok) AS mousemove_count, count(*) FILTER (ok) AS bot_detection_features_count,
    {share("bot_score > 0.5")} AS bot_score_above_threshold_ratio, {share("bot_score > 0.8")} AS bot_score_above_high_threshold_ratio FROM x GROUP BY 1)
  SELECT f.*, coalesce(sc.n, 0) AS scroll_count, round(coalesce(mean, 0), 9) + 0.0 AS scroll_prm_data_mean, round(coalesce(lo, 0), 9) + 0.0 AS scroll_prm_data_min, round(coalesce(hi, 0), 9) + 0.0 AS scroll_prm_data_max,
    round(coalesce(total, 0), 9) + 0.0 AS scroll_prm_data_sum, round(coalesce(sd, 0), 9) + 0.0 AS scroll_prm_data_std, round(coalesce(mad, 0), 9) + 0.0 AS scroll_prm_data_mad,
    round(coalesce(CAST(sc.n AS DOUBLE) / nullif(mousemove_count, 0), 0), 9) + 0.0 AS ratio_scroll_count_on_mousemove_count FROM f LEFT JOIN sc USING (session_id)"""


@query(_feature_sql())
def session_feature_table(spark: SparkSession, d: str) -> DataFrame:
    """All features of a session, every statistic of them, from snapshots of which some have unknown values, no scrolls or a type that doesn't count."""
    e = read(spark, d, "events")
    stats = [F.expr(_STAT(i)).alias(c) for i, c in enumerate(_FEATURES)] + [F.expr(x).alias(c) for c, x in _KEPT.items()]
    scrolls = F.expr("slice(array(value - 20, case when event_id % 5 <> 0 then 20 - 2 * value end), 1, cast(event_id % 3 as int))")
    snaps = e.select(F.lit("1_1").alias("site_id"), F.lit("desktop").alias("device_type"), F.col("user_id").alias("session_id"), F.expr(_TYPE).alias("type"), scrolls.alias("scroll_data"), F.struct(*stats).alias("s"))
    out = features.session_features(snaps, "desktop", mean_only=False).drop("site_id", "device_type")
    # nine digits, as means of amounts with three often lie just between two numbers of six
    return out.select(*((F.round(c, 9) + 0.0).alias(c) if t == "double" else c for c, t in out.dtypes))


# What each event becomes in the log of `engine_snapshots`, in words that both Spark and the oracle know.
_BECOMES = {
    "ptr": "event_type = 'click' OR (event_type IN ('purchase', 'signup') AND seq % 2 = 0)",
    "clk": "(event_type = 'click' AND seq % 3 <> 0) OR (event_type = 'purchase' AND seq % 2 = 0)",
    "ready": "event_type = 'purchase' AND session_id % 4 <> 0",
    "qml": "event_type = 'signup'",
    "scl": "event_type = 'view'",
}


_SNAPSHOTS = f"""WITH {_P}, r AS (SELECT *, {', '.join(f'{c} AS {k}' for k, c in _BECOMES.items())}
    FROM (SELECT session_id, seq, event_type, CAST(STEP_MS * (row_number() OVER (PARTITION BY session_id ORDER BY seq) // 2) AS DOUBLE) AS tm FROM p) WHERE tm <> 0 AND session_id <> 0),
  own AS (SELECT *, count(*) FILTER (ptr) OVER w AS np, count(*) FILTER (scl) OVER w AS ns FROM r WINDOW w AS (PARTITION BY session_id ORDER BY seq)),
  snap AS (SELECT session_id AS sid, seq AS shot, tm AS until, 'mmv_clk' AS type, false AS synthetic, np AS sp, ns AS ss FROM own WHERE clk AND ptr
    UNION ALL SELECT session_id, seq, tm, 'qml_ready', false, np, ns FROM own WHERE ready
    UNION ALL SELECT session_id, max(seq), arg_max(tm, seq) + CASE WHEN NOT bool_or(ready) AND bool_or(qml) THEN 1 ELSE 0 END, 'qml_ready', true, arg_max(np, seq), arg_max(ns, seq) FROM own GROUP BY session_id),
  -- the last five pointer records of each snapshot by position, and the position of the click before
  h AS (SELECT *, lag(clk) OVER (PARTITION BY sid, shot, type, synthetic ORDER BY j) AS after_click, max(j) FILTER (clk AND tm < until) OVER (PARTITION BY sid, shot, type, synthetic) AS c
    FROM (SELECT snap.*, own.seq AS g, own.tm, own.clk, row_number() OVER (PARTITION BY sid, shot, type, synthetic ORDER BY own.np) - 1 AS j
      FROM snap JOIN own ON own.session_id = sid AND own.ptr AND own.np > sp - 5 AND own.np <= sp)),
  since AS (SELECT sid, shot, type, synthetic, CASE WHEN type = 'mmv_clk' THEN coalesce(max(tm) FILTER (j = c), 0) ELSE -1 END AS since FROM h GROUP BY sid, shot, type, synthetic),
  part AS (SELECT sid, shot, type, synthetic, 0 AS block, -j AS place, g, tm FROM h WHERE type = 'mmv_clk' AND NOT clk AND tm < until AND j > coalesce(c, -1) AND (j = 0 OR after_click)
    UNION ALL SELECT sid, shot, type, synthetic, 1, j, g, tm FROM h WHERE CASE WHEN type = 'mmv_clk' THEN j <= c ELSE tm < until END
    UNION ALL SELECT snap.sid, snap.shot, snap.type, snap.synthetic, 2, own.ns, own.seq, own.tm FROM snap LEFT JOIN since USING (sid, shot, type, synthetic)
      JOIN own ON own.session_id = snap.sid AND own.scl AND own.ns > ss - 5 AND own.ns <= ss AND own.tm < until AND own.tm > coalesce(since, -1)
    UNION ALL SELECT sid, shot, type, synthetic, 3, 0, shot, until FROM snap WHERE type = 'mmv_clk'),
  k AS (SELECT unnest([0, 1, 2]) AS k),
  pt AS (SELECT sid, shot, type, synthetic, block, place, k, tm + [5, 15, 18][k + 1] AS t, 40 * g + CASE WHEN block = 2 THEN [20, 26][k + 1] ELSE [0, 7, 13][k + 1] END AS x,
    CASE WHEN block = 2 THEN g % 30 + [0, 5 + g % 3][k + 1] ELSE g % 50 + [0, 3, 0][k + 1] END AS y FROM part, k WHERE block <> 2 OR k < 2),
  step AS (SELECT *, run = max(run) OVER (PARTITION BY sid, shot, type, synthetic) AS stays FROM (SELECT *, sum(pause) OVER (PARTITION BY sid, shot, type, synthetic ORDER BY i) AS run
    FROM (SELECT *, row_number() OVER w AS i, CASE WHEN t - lag(t) OVER w > 15000 THEN 1 ELSE 0 END AS pause, sqrt((x - lag(x) OVER w) ** 2 + (y - lag(y) OVER w) ** 2) AS dist
      FROM pt WINDOW w AS (PARTITION BY sid, shot, type, synthetic ORDER BY block, place, k)))),
  made AS (SELECT sid AS session_id, shot AS seq, type, synthetic, CAST(count(*) FILTER (block = 2) AS INTEGER) AS scl_count, CAST(coalesce(sum(CASE WHEN block = 2 THEN CASE k WHEN 0 THEN -y ELSE y END END), 0) AS DOUBLE) AS scrolled,
    CAST(count(*) FILTER (stays) AS INTEGER) AS n, round(sum(dist) FILTER (stays AND pause = 0), 6) AS l, CAST(arg_max(t, i) - arg_min(t, i) FILTER (stays) AS DOUBLE) AS ms, CAST(arg_min(x, i) FILTER (stays) AS DOUBLE) AS x0, CAST(arg_max(y, i) AS DOUBLE) AS y1,
    CASE WHEN NOT synthetic AND bool_or(block <> 2) AND max(run) = 0 THEN 3.0 ELSE 0.0 END AS mmv_points_per_group FROM step GROUP BY sid, shot, type, synthetic HAVING count(*) FILTER (stays) >= 3)
  SELECT * EXCLUDE (r) FROM (SELECT *, row_number() OVER (PARTITION BY session_id, seq, synthetic ORDER BY type) AS r FROM made) WHERE r = 1"""
#: The same by the rules of the two-phase mode: a click takes the scrolls of ten seconds, a session ends after its last page-ready record only.
_TWO_PHASE = (
    _SNAPSHOTS.replace("CASE WHEN NOT bool_or(ready) AND bool_or(qml) THEN 1 ELSE 0 END", "CASE WHEN bool_or(qml) THEN 1 ELSE 0 END")
    .replace("arg_max(ns, seq) FROM own GROUP BY session_id)", "arg_max(ns, seq) FROM own GROUP BY session_id HAVING coalesce(arg_max(tm, seq) FILTER (ready) < arg_max(tm, seq), true))")
    .replace("own.tm > coalesce(since, -1)", "own.tm > CASE WHEN snap.type = 'mmv_clk' THEN snap.until - 10000 ELSE -1 END")
)


@query(_SNAPSHOTS.replace("STEP_MS", "30"))
def engine_snapshots(spark: SparkSession, d: str) -> DataFrame:
    """Click, page-ready and session-end snapshots of a log, from its lines to the trajectory that each is given."""
    return _desktop_snapshots(spark, d, 30, False)


@query(_TWO_PHASE.replace("STEP_MS", "3000"))
def two_phase_snapshots(spark: SparkSession, d: str) -> DataFrame:
    """The same by the rules of the two-phase mode, over a log with pauses."""
    return _desktop_snapshots(spark, d, 3000, True)


def _desktop_snapshots(spark: SparkSession, d: str, step_ms: int, two_phase: bool) -> DataFrame:
    from clickloom.operators.snapshots import Policy, snapshots
    from clickloom.plans.pipeline import log_records

    order = Window.partitionBy("session_id").orderBy("seq")
    e = points(spark, d).select("session_id", "seq", "event_type", (step_ms * F.floor(F.row_number().over(order) / 2)).cast("double").alias("tm"))
    e = e.withColumns({k: F.expr(c) for k, c in _BECOMES.items()})
    to36 = lambda c: F.lower(F.conv(c.cast("string"), 10, 36))
    step = lambda delta, x, y: F.concat_ws(",", F.lit(delta), to36(40 * F.col("seq") + x), to36(y))
    low, high = F.col("seq") % 50, F.col("seq") % 30
    pointer = F.concat_ws(";", step("5", 0, low), step("a", 7, low + 3), step("3", 13, low))
    scroll = F.concat_ws(";", step("5", 20, high), step("a", 26, high + 5 + F.col("seq") % 3))
    part = lambda has, text: F.when(F.col(has), F.struct(text.alias("l")))
    body = F.struct(part("ptr", pointer).alias("mmv"), part("scl", scroll).alias("scl"), F.when(F.col("clk"), 1).alias("clk"))
    act = F.when(F.col("ready"), "qml.ready").when(F.col("qml"), "qml").otherwise("track")
    record = F.struct(F.struct(F.col("session_id").cast("string").alias("a")).alias("sess"), act.alias("act"), F.struct("tm", F.struct(body.alias("e")).alias("data")).alias("prm"))
    made = snapshots(log_records(e.select(F.lit("1_1").alias("site_id"), "seq", F.to_json(record).alias("line"))), Policy(two_phase=two_phase))
    scrolled = F.expr("aggregate(scroll_data, 0D, (a, v) -> a + v)").alias("scrolled")
    return made.select(F.col("session_id").cast("long").alias("session_id"), "seq", "type", "synthetic", "scl_count", scrolled, "s.n", F.round("s.l", 6).alias("l"), "s.ms", "s.x0", "s.y1", "s.mmv_points_per_group")


@query(f"""WITH {_P}, own AS (SELECT *, count(*) FILTER (event_type = 'click') OVER w AS np, count(*) FILTER (event_type = 'view') OVER w AS ns
    FROM (SELECT session_id, seq, event_type, CAST(30 * (row_number() OVER (PARTITION BY session_id ORDER BY seq) // 2) AS DOUBLE) AS tm FROM p) WHERE tm <> 0 AND session_id <> 0 WINDOW w AS (PARTITION BY session_id ORDER BY seq)),
  snap AS (SELECT session_id AS sid, seq AS shot, tm AS until, false AS synthetic, np AS sp, ns AS ss FROM own WHERE event_type = 'purchase'
    UNION ALL SELECT session_id, max(seq), arg_max(tm, seq), true, arg_max(np, seq), arg_max(ns, seq) FROM own GROUP BY session_id),
  part AS (SELECT sid, shot, synthetic, 1 AS block, own.np AS place, own.seq AS g, own.tm FROM snap JOIN own ON own.session_id = sid AND event_type = 'click' AND np > sp - 10 AND np <= sp AND tm < until
    UNION ALL SELECT sid, shot, synthetic, 2, own.ns, own.seq, own.tm FROM snap JOIN own ON own.session_id = sid AND event_type = 'view' AND ns > ss - 10 AND ns <= ss AND tm < until),
  k AS (SELECT unnest([0, 1, 2]) AS k),
  pt AS (SELECT sid, shot, synthetic, block, place, k, tm + [5, 15, 18][k + 1] AS t, CASE WHEN block = 2 THEN 40 * g + [20, 26][k + 1] ELSE [40 * g, 40 * g + 7, 40 * g + 13][k + 1] END AS x,
    CASE WHEN block = 2 THEN g % 30 + [0, 5 + g % 3][k + 1] ELSE [g % 50, g % 50 + 3, 0][k + 1] END AS y FROM part, k WHERE block <> 2 OR k < 2),
  step AS (SELECT *, row_number() OVER w AS i, sqrt((x - lag(x) OVER w) ** 2 + (y - lag(y) OVER w) ** 2) AS dist FROM pt WINDOW w AS (PARTITION BY sid, shot, synthetic ORDER BY block, place, k))
  SELECT sid AS session_id, shot AS seq, synthetic, CAST(count(*) FILTER (block = 2) AS INTEGER) AS scl_count, CAST(count(*) AS INTEGER) AS n, round(sum(dist), 6) AS l, CAST(arg_max(t, i) - arg_min(t, i) AS DOUBLE) AS ms,
    CAST(arg_min(x, i) AS DOUBLE) AS x0, CAST(arg_max(y, i) AS DOUBLE) AS y1 FROM step GROUP BY sid, shot, synthetic HAVING count(*) >= 3""")
def mobile_snapshots(spark: SparkSession, d: str) -> DataFrame:
    """Page-ready and session-end snapshots of touch tracks: other fields, ten records of each kind, and a missing coordinate that is 0."""
    from clickloom.operators.snapshots import snapshots
    from clickloom.plans.pipeline import log_records

    order = Window.partitionBy("session_id").orderBy("seq")
    e = points(spark, d).select("session_id", "seq", "event_type", (30 * F.floor(F.row_number().over(order) / 2)).cast("double").alias("tm"))
    to36 = lambda c: F.lower(F.conv(c.cast("string"), 10, 36))
    step = lambda delta, *fields: F.concat_ws(",", F.lit(delta), *map(to36, fields))
    at, low, high, none = 40 * F.col("seq"), F.col("seq") % 50, F.col("seq") % 30, F.lit(0)
    touch = F.concat_ws(";", step("5", none, at, low), step("a", none, at + 7, low + 3), step("3", none, at + 13))
    scroll = F.concat_ws(";", step("5", at + 20, high), step("a", at + 26, high + 5 + F.col("seq") % 3))
    body = F.struct(F.when(F.col("event_type") == "click", F.struct(touch.alias("l"))).alias("tmv"), F.when(F.col("event_type") == "view", F.struct(scroll.alias("l"))).alias("scl"))
    act = F.when(F.col("event_type") == "purchase", "qml.ready").otherwise("track")
    record = F.struct(F.struct(F.col("session_id").cast("string").alias("a")).alias("sess"), act.alias("act"), F.lit(1).alias("mb"), F.struct("tm", F.struct(body.alias("e")).alias("data")).alias("prm"))
    made = snapshots(log_records(e.select(F.lit("1_1").alias("site_id"), "seq", F.to_json(record).alias("line"))))
    return made.select(F.col("session_id").cast("long").alias("session_id"), "seq", "synthetic", "scl_count", "s.n", F.round("s.l", 6).alias("l"), "s.ms", "s.x0", "s.y1")
