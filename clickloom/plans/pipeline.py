"""The whole pipeline as one plan: logs, records, snapshots, features, scores, change log.

Sites and devices are columns, so many sites are one job. Change logs are partitioned by day and run.
"""

from __future__ import annotations

import json
import pickle
import posixpath
import re
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.operators import features, neighbours, publish, routing, scoring
from clickloom.operators.snapshots import Policy, snapshots
from clickloom.sources import files, ndjson, store, tables
from clickloom.sources.events import parse
from clickloom.sources.versions import current, delete, names, next_version, replace, upsert, upserted

from .config import DEVICES, Run, Site

KEY = ["site_id", "session_id"]
META = ("ip", "user_agent")


def log_records(logs: DataFrame) -> DataFrame:
    """Typed records of log lines, with their device."""
    return routing.route(parse(logs))


def device_snapshots(records: DataFrame, device: str, policy: Policy = Policy()) -> DataFrame:
    return snapshots(records.where(F.col("device_type") == device), policy)


def device_features(records: DataFrame, device: str, policy: Policy = Policy(), mean_only: bool = True) -> DataFrame:
    return features.session_features(device_snapshots(records, device, policy), device, mean_only)


@dataclass(frozen=True)
class Models:
    """What scores a device: a scaler, a projection with its centroid and, optionally, trees with an encoder."""

    scaler: dict
    projection: scoring.Projection | neighbours.NeighbourProjection
    centroid: dict
    trees: scoring.Trees | None = None
    encoder: scoring.Encoder | None = None
    vocabulary: dict[str, int] = field(default_factory=dict)

    @classmethod
    def load(cls, site: Site, device: str, named: str | None = None) -> Models:
        """The site's model set of a device; `named` is a file of trees that goes first."""
        folder = site.projection(device)
        if folder is None:
            raise FileNotFoundError(f"no complete projection model for {site.site_id}, {device}")
        at = lambda f: posixpath.join(folder, f)
        read = lambda f: json.loads(files.read(at(f)))
        _, trees = site.trees(device, named)
        complete = trees is not None and files.is_file(at("encoder.npz")) and files.is_file(at("vocabulary.json"))
        return cls(
            read("scaler.json"), neighbours.load(at("projection.json")), read("centroid.json"), scoring.Trees.load(trees) if trees else None,
            scoring.Encoder.load(at("encoder.npz")) if complete else None, read("vocabulary.json") if complete else {},
        )


class Registry:
    """The model sets of a device: the shared one, and those of sites with their own. It is sent to each task once."""

    #: Bytes of the pickled models above which nothing is sent.
    MOST = 1 << 30

    def __init__(self, shared: Models | None, own: dict[str, Models] | None = None):
        self.shared, self.own = shared, own or {}

    @property
    def all(self) -> list[Models]:
        return [m for m in (self.shared, *self.own.values()) if m is not None]

    def of(self, site: str) -> Models:
        m = self.own.get(site, self.shared)
        if m is None:
            raise LookupError(f"no model for {site}")
        return m

    def sent(self, spark: SparkSession) -> Broadcast:
        if (size := len(pickle.dumps(self))) > self.MOST:
            raise ValueError(f"{size} bytes of models are too many to send")
        return spark.sparkContext.broadcast(self)


def _numbers(batch: pa.RecordBatch, columns: Iterable[str]) -> dict[str, np.ndarray]:
    """The columns as doubles; NULL is NaN."""
    return {c: batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in columns if c in batch.schema.names}


def _scores(m: Models, x: dict[str, np.ndarray], tokens: list[list[str]], mode: str) -> tuple[np.ndarray, np.ndarray | None]:
    """Both scores of the sessions of one model set: scaling, projection, distance and probability; embedding and trees."""
    if missing := [c for c in m.scaler if c not in x]:
        raise ValueError(f"the scaler needs columns that aren't there: {missing}")
    scaled = {c: np.nan_to_num(x[c], nan=0.0, posinf=np.inf, neginf=-np.inf) * float(p["scale"]) + float(p["min"]) for c, p in m.scaler.items()}
    if missing := [c for c in m.projection.columns if c not in scaled]:
        raise ValueError(f"the model needs columns that aren't there: {missing}")
    at = lambda z: np.nan_to_num(np.asarray(z, float), nan=0.0, posinf=1e10, neginf=-1e10)
    z = at(m.projection(np.stack([at(scaled[c]) for c in m.projection.columns], 1)))
    d = np.hypot(z[:, 0] - float(m.centroid["centroid_x"]), z[:, 1] - float(m.centroid["centroid_y"]))
    bots = scoring.probabilities(d, m.centroid, mode)
    if m.trees is None:
        return bots, None
    embedding = np.zeros((len(d), m.trees.embedding), np.float32)
    if m.encoder is not None:
        ids = [[m.vocabulary[t] for t in ts[: m.encoder.most] if t in m.vocabulary] for ts in tokens]
        some = [i for i, v in enumerate(ids) if v]
        if some:
            found = m.encoder([ids[i] for i in some])
            if found.shape[1] != m.trees.embedding:
                raise ValueError("embedding of another width")
            embedding[some] = found
    named = re.compile(r"transformer_embedding_(\d+)\Z")
    columns = [embedding[:, int(k[1])] if (k := named.match(c)) else scaled[c].astype(np.float32) for c in m.trees.columns]
    return bots, m.trees(np.stack(columns, 1).astype(float) if columns else np.zeros((len(d), 0)))


SCORED = "site_id string, session_id string, probability_bot_umap double, probability_lgbm double, error string"


def score_sites(records: DataFrame, feats: DataFrame, registry: Registry, mode: str = "decay") -> DataFrame:
    """SCORED for each session of `feats`: every site by its own models, in one stage.

    Rows of a batch are taken site by site. A site whose models fail has the failure in `error` and no scores; the others aren't touched by it.
    """
    names = sorted({c for m in registry.all for c in m.scaler} & set(feats.columns))
    rows = feats.select(*(F.col(k).cast("string").alias(k) for k in KEY), *(F.col(c).cast("double").alias(c) for c in names))
    if any(m.trees is not None and m.encoder is not None for m in registry.all):
        pages = records.where("session_id is not null and uri is not null").select(*KEY, "page_id", "uri", "ts", "seq")
        rows = rows.join(scoring.page_sequences(pages, KEY).withColumnRenamed("tokens", "_tokens"), KEY, "left")
    sent = registry.sent(feats.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value  # what can't be sent at all fails the run
        for batch in batches:
            sites = np.array(batch.column("site_id").to_pylist(), object)
            bots, trees, errors = np.full(len(sites), np.nan), np.full(len(sites), np.nan), np.full(len(sites), None, object)
            x, tokens = _numbers(batch, names), batch.column("_tokens").to_pylist() if "_tokens" in batch.schema.names else None
            for site in set(sites.tolist()):
                here = np.flatnonzero(sites == site)
                try:
                    b, t = _scores(known.of(site), {c: v[here] for c, v in x.items()}, [(tokens[i] if tokens else None) or [] for i in here], mode)
                except Exception as e:  # noqa: BLE001 - a site's models fail for that site
                    errors[here] = f"{type(e).__name__}: {e}"
                    continue
                bots[here] = b
                if t is not None:
                    trees[here] = t
            score = lambda v: pa.array(v, from_pandas=True)
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in KEY), score(bots), score(trees), pa.array(errors.tolist(), pa.string())], names=[*KEY, *scoring.SCORES, "error"])

    return rows.mapInArrow(run, SCORED)


def score(records: DataFrame, feats: DataFrame, models: Models, mode: str = "decay", existing: DataFrame | None = None) -> DataFrame:
    """site_id, session_id and both scores by one model set; trees are left out without a model. A failure is raised."""
    new = score_sites(records, feats, Registry(models), mode)
    raised = F.when(F.col("error").isNull(), F.col("probability_bot_umap")).otherwise(F.raise_error("error").cast("double"))
    new = new.select(*KEY, raised.alias("probability_bot_umap"), "probability_lgbm")
    return new if existing is None else _merged(existing, new)


def _merged(existing: DataFrame, fresh: DataFrame) -> DataFrame:
    """Rows of either, column by column what is new where it is known."""
    return scoring.merge_scores(fresh.drop(scoring.SCORES[1]), fresh.drop(scoring.SCORES[0]), existing, KEY)


class Report(dict):
    """Changed rows by device; failed: {site: why}; left_out: sites without a complete model set; read: bytes
    of logs that were read; scores: of each device the least, median and largest of this run's bot scores."""

    def __init__(self):
        super().__init__()
        self.failed: dict[str, str] = {}
        self.left_out: list[str] = []
        self.read = 0
        self.scores: dict[str, tuple[float | None, ...]] = {}


def run_sites(
    spark: SparkSession, logs: str, out: str, models: dict[str, Models], day: str, at: str, run: Run = Run(), own: dict[str, dict[str, Models]] | None = None, sites: list[str] | None = None
) -> Report:
    """One run over all sites, or those given: predictions, change log and history by device under `out`.

    own: {site: {device: models}} of sites with models of their own; models: those of all others, if there are any. A site without
    either is left out; one whose models fail is reported, and its sessions are tried again by the next run. Of each log only the bytes
    behind the last run's are read (see `sources.store`), and only sessions with new records are scored, unless the scores have to be
    rebuilt. Tables change in the buckets of those sessions alone (see `sources.versions`), and the ledger of what is read is
    saved last, so a run may stop anywhere. The combined log is the union of the devices'; the combined history has the day's keys.
    """
    own, report = own or {}, Report()
    found = ndjson.sites(logs, sites if sites is not None else list(run.allow) if run.allow else None)
    report.left_out = [s for s in found if not models and not own.get(s)]
    found = {s: f for s, f in found.items() if s not in report.left_out}
    place = f"{out}/records"
    ledger = store.Ledger.load(spark, f"{out}/ledger")
    ledger = store.append(spark, place, ledger, ledger.tails(found, run.force))
    report.read, todo = ledger.read, list(found)
    _score_and_publish(spark, out, ledger, todo, models, own, day, at, run, report)
    return report


def publish_batch(
    spark: SparkSession, lines: DataFrame, n: int, out: str, models: dict[str, Models], day: str, at: str, run: Run = Run(), own: dict[str, dict[str, Models]] | None = None
) -> Report | None:
    """Micro-batch n of a stream of log lines: its records are added, and the sessions that it touched are scored and published.

    None if the batch was worked off before: the ledger is saved last, and a batch that was stopped is worked off again. A
    site whose models fail keeps its records, and its sessions are scored with the next batch that touches the site.
    """
    own, report = own or {}, Report()
    ledger = store.Ledger.load(spark, f"{out}/ledger")
    if n < ledger.streamed:
        return None
    since = {s: v["since"] for s, v in ledger.sites.items() if v["since"] < v["offset"]}
    ledger = store.append_stream(spark, f"{out}/records", ledger, lines, n)
    for site, seq in since.items():  # not scored yet
        if ndjson.generation_of(seq) == ledger.sites[site]["generation"]:
            ledger.sites[site]["since"] = min(seq, ledger.sites[site]["since"])
    report.left_out = [s for s in ledger.sites if not models and not own.get(s)]
    _score_and_publish(spark, out, ledger, [s for s in ledger.sites if s not in report.left_out], models, own, day, at, run, report)
    return report


def _score_and_publish(
    spark: SparkSession, out: str, ledger: store.Ledger, todo: list[str], models: dict[str, Models], own: dict[str, dict[str, Models]], day: str, at: str, run: Run, report: Report
) -> None:
    """Scores the sessions with records that no run has scored, publishes them and saves the ledger."""
    place = f"{out}/records"
    registries = {d: Registry(models.get(d), {s: m[d] for s, m in own.items() if d in m}) for d in DEVICES}
    registries = {d: r for d, r in registries.items() if r.all}
    rebuild = run.rebuild or any(_unscored(spark, f"{out}/{d}/predictions") for d in registries)
    work = f"{out}/work-{uuid.uuid4().hex}"
    keys = _kept(store.touched(spark, place, ledger, todo, rebuild), f"{work}/keys")
    routing.route(store.of_sessions(spark, place, ledger, todo, keys)).write.partitionBy("device_type").parquet(f"{work}/records")
    records = spark.read.parquet(f"{work}/records") if not keys.isEmpty() else None
    policy = Policy(run.mobile_history, run.desktop_history, two_phase=run.two_phase)
    made = {}
    for device, registry in registries.items() if records is not None else ():
        mine = records.where(F.col("device_type") == device)
        if registry.shared is None:
            mine = mine.where(F.col("site_id").isin(list(registry.own)))
        feats = _kept(device_features(mine, device, policy), f"{work}/{device}-features")
        made[device] = mine, feats, _kept(score_sites(mine, feats, registry, run.probability), f"{work}/{device}-scores")
        failures = made[device][2].where("error is not null").groupBy("site_id").agg(F.min("error").alias("error"))  # a row a site
        report.failed |= {r["site_id"]: r["error"] for r in failures.collect()}
    for device, (mine, feats, fresh) in made.items():
        good = ~F.col("site_id").isin(list(report.failed)) if report.failed else F.lit(True)
        report[device] = _publish(spark, f"{out}/{device}", device, mine.where(good), feats.where(good), fresh.where(good).drop("error"), ledger, day, at, run, rebuild, f"{work}/{device}")
        report.scores[device] = tuple(scoring.distribution(fresh.where(good)).first())
    for device in registries.keys() - made.keys():
        report[device] = 0
    if made:
        _combine(spark, out, day, [d for d in DEVICES if "log" in names(spark, f"{out}/{d}")])
    ledger.scored([s for s in todo if s not in report.failed], at).save(spark, f"{out}/ledger")
    store.sweep(spark, place, ledger)
    delete(spark, work)


def _unscored(spark: SparkSession, path: str) -> bool:
    """Whether there are scores, but not one of them is known."""
    had = upserted(spark, path)
    return had is not None and not had.isEmpty() and scoring.needs_rebuild(had, False, had)


def _publish(
    spark: SparkSession, place: str, device: str, mine: DataFrame, feats: DataFrame, fresh: DataFrame, ledger: store.Ledger, day: str, at: str, run: Run, rebuild: bool, work: str
) -> int:
    """The scored sessions' rows in the predictions, the change log and the history of a device; how many changed."""
    keys = fresh.select(*KEY)
    existing = upserted(spark, f"{place}/predictions", keys)
    before = None if existing is None else existing.join(keys, KEY, "left_semi")
    now = fresh if before is None or rebuild else _merged(before, fresh)
    old = now.limit(0) if before is None or run.rebuild else before
    meta = publish.first_known(mine.select(*KEY, "seq", "ip", F.col("ua").alias("user_agent")), KEY, META, "seq")
    past = upserted(spark, f"{place}/history", keys)
    was = publish.last_known(past, KEY, META, F.col("date")) if past is not None else meta.limit(0)
    rows = _kept(publish.with_metadata(now, meta, was, KEY).withColumns({"date": F.lit(at), "device_type": F.lit(device)}), f"{work}-rows")
    delta = _kept(publish.changed_scores(old, rows, KEY), f"{work}-delta")
    n = delta.count()
    publish.append_log(delta, f"{place}/log", day, next_version(spark, f"{place}/predictions/manifest"))
    generations = F.broadcast(ledger.table(spark).select("site_id", "generation"))  # a row a site
    upsert(spark, _kept(rows.join(generations, "site_id"), f"{work}-history"), f"{place}/history", KEY)
    replace(spark, features.summary(feats).withColumn("date", F.lit(at)), f"{place}/summary")
    upsert(spark, rows.select(*KEY, *scoring.SCORES), f"{place}/predictions", KEY)  # last: these needn't be scored again
    if run.exports:
        _export(spark, f"{run.exports}/{device}", delta, upserted(spark, f"{place}/predictions"), current(spark, f"{place}/summary"))
    return n


def _export(spark: SparkSession, path: str, delta: DataFrame, predictions: DataFrame | None, summary: DataFrame) -> None:
    """Text files for other programs: the changed rows, all predictions, the summary."""
    tables.write_delta(delta, f"{path}/delta.csv")
    if predictions is not None:
        tables.write_csv(predictions, f"{path}/predictions.csv")
    tables.write_csv(summary, f"{path}/summary.csv", "date")


def device_history(spark: SparkSession, out: str, device: str) -> DataFrame | None:
    """The history of a device: every session of a log carries the date of the last run over its site, whether that run scored it or not;
    sessions that only an earlier generation of a log had keep their own."""
    rows = upserted(spark, f"{out}/{device}/history")
    if rows is None:
        return None
    runs = F.broadcast(store.Ledger.load(spark, f"{out}/ledger").table(spark).select("site_id", "generation", F.col("at").alias("_at")))  # a row a site
    return rows.join(runs, ["site_id", "generation"], "left").withColumn("date", F.coalesce("_at", "date")).drop("_at", "generation")


def _combine(spark: SparkSession, out: str, day: str, devices: list[str]) -> None:
    """The day's keys of all devices with their last row."""
    logs = {d: spark.read.parquet(f"{out}/{d}/log").where(F.col("day").cast("string") == day).drop("day", "run", "device_type") for d in devices}
    key = ["device_type", *KEY]
    log = publish.combined(logs)
    last = features.last_by_key(log, key, "date")
    before = current(spark, f"{out}/history")
    replace(spark, publish.pruned_history(last.limit(0) if before is None else before, last, log, day, key), f"{out}/history")


def _kept(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
