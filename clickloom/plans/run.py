"""Command line: one batch run over the sites whose logs changed, or one after another as they change.

    python -m clickloom.plans.run LOGS OUT --models DIR [--force] [--sites 1_1,1_2] [--follow 45] [--exports DIR] [--keep DIR]

The exit code is 1 if a site failed; the others are published.
"""

from __future__ import annotations

import argparse
import datetime
import fcntl
import json
import sys
import time
import traceback
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from dataclasses import replace
from pathlib import Path

from clickloom.sources.files import is_folder, is_uri, place
from clickloom.sources.ndjson import sites, stat

from .config import DEVICES, Run, Site, load_env, site_name


def local(path: str) -> str:
    """The path on this machine of a path or `file:` URI."""
    return place(path)[1]


def log_state(path: str, allow: list[str] | None = None) -> dict[str, list[int]]:
    """{site: size, mtime in ns, inode} of each log."""
    return {s: list(stat(f)) for s, f in sites(path, allow).items()}


def changed_sites(now: dict[str, list[int]], state: str) -> list[str]:
    """Sites whose log's size, time or inode differs from the state that the last good run left."""
    had = saved_state(state)
    return [s for s, v in now.items() if had.get(s) != v]


def saved_state(state: str) -> dict[str, list[int]]:
    try:
        return json.loads(Path(state).read_text())
    except (OSError, ValueError):
        return {}


def save_state(now: dict[str, list[int]], state: str) -> None:
    tmp = Path(f"{state}.tmp")
    tmp.write_text(json.dumps(now))
    tmp.replace(state)


@contextmanager
def only_writer(path: str) -> Iterator[bool]:
    """False if another run holds the lock."""
    with open(path, "w") as f:
        try:
            fcntl.flock(f, fcntl.LOCK_EX | fcntl.LOCK_NB)
        except BlockingIOError:
            yield False
            return
        yield True


def models_of(site: Site, run: Run) -> dict:
    from .pipeline import Models

    return {d: Models.load(site, d, run.trees.get(d)) for d in DEVICES if site.projection(d)}


def own_models(sites: list[str], logs: str, roots: tuple[str, ...], run: Run) -> tuple[dict[str, dict], dict[str, str]]:
    """{site: models by device} of the sites with a folder of their name under the first root, and {site: why} of those that can't be read."""
    own, failed = {}, {}
    for s in sites:
        if roots and is_folder(folder := f"{roots[0]}/{site_name(s)}"):
            try:
                own[s] = models_of(Site(s, logs, (folder, *roots)), run)
            except Exception as e:  # noqa: BLE001 - a site's models fail for that site
                failed[s] = f"{type(e).__name__}: {e}"
    return own, failed


def once(logs: str, out: str, roots: tuple[str, ...], run: Run, only: list[str] | None = None, keep: str | None = None):
    """One run over the sites whose logs changed, of `only` if given; its Report, or None if another run is at work or nothing changed.

    A site's own models are in the folder of its name under the first of `roots`. The state of a site is kept once its run went well.
    Lock and state are files on the driver's machine, in the folder `keep`, or in `out` if that is local; all others are on any file system.
    """
    if keep is None and is_uri(out):
        raise ValueError("tables on another file system need a local folder for lock and state")
    keep = local(keep or out)
    Path(keep).mkdir(parents=True, exist_ok=True)
    state = f"{keep}/state.json"
    with only_writer(f"{keep}/lock") as free:
        if not free:
            print("another run is at work")
            return None
        now = log_state(logs, list(run.allow) if run.allow else None)
        changed = [s for s in (list(now) if run.force else changed_sites(now, state)) if only is None or s in only]
        if not changed:
            print("nothing changed")
            return None
        from pyspark.sql import SparkSession

        from .pipeline import run_sites

        spark = SparkSession.builder.appName("clickloom").getOrCreate()
        shared = models_of(Site("all", logs, roots), run)
        own, failed = own_models(changed, logs, roots, run)
        at = datetime.datetime.now()
        report = run_sites(spark, logs, out, shared, f"{at:%Y-%m-%d}", f"{at:%Y-%m-%d %H:%M:%S}", run, own, [s for s in changed if s not in failed])
        report.failed |= failed
        for site, why in report.failed.items():
            print(f"{site}: {why}", file=sys.stderr)
        for site in report.left_out:
            print(f"{site}: no complete model set, left out", file=sys.stderr)
        for device, (least, median, most) in report.scores.items():
            print(f"{device}: scores from {least} over {median} to {most}", file=sys.stderr)
        done = {s: now[s] for s in changed if s not in report.failed and s not in report.left_out}
        save_state({**saved_state(state), **done}, state)  # only after success
        return report


class Debounce:
    """Sites whose logs change, and when it is time to run: after `quiet` seconds without a further change, or `longest`
    after the first. What changes while a site's run is on waits for its end, and then as if it came just then."""

    def __init__(self, quiet: float = 45.0, longest: float = 120.0):
        self.quiet, self.longest = quiet, longest
        self.waiting: dict[str, tuple[float, float]] = {}
        self.running: set[str] = set()
        self.dirty: set[str] = set()

    def changed(self, site: str, now: float) -> None:
        if site in self.running:
            self.dirty.add(site)
        else:
            self.waiting[site] = (self.waiting.get(site, (now,))[0], now)

    def due(self, now: float) -> list[str]:
        """Sites to run now; they count as running until `done`."""
        ready = sorted(s for s, (first, last) in self.waiting.items() if now - last >= self.quiet or now - first >= self.longest)
        for s in ready:
            del self.waiting[s]
        self.running.update(ready)
        return ready

    def done(self, sites: Iterable[str], now: float) -> None:
        for s in sites:
            self.running.discard(s)
            if s in self.dirty:
                self.dirty.discard(s)
                self.changed(s, now)


def watch(
    look: Callable[[], dict[str, list[int]]], step: Callable[[list[str]], object], debounce: Debounce, every: float = 5.0, rescan: float = 3600.0,
    rounds: int | None = None, sleep: Callable[[float], None] = time.sleep, clock: Callable[[], float] = time.monotonic,
) -> None:
    """Looks at the logs every few seconds and runs `step` with the sites that are due, each by its own quiet time.

    look: the logs' states; every `rescan` seconds all of them count as changed, and `step` knows which are. A failed step is tried again.
    """
    seen: dict[str, list[int]] = {}
    scanned, done = None, 0
    while rounds is None or done < rounds:
        now, states = clock(), look()
        again = scanned is None or now - scanned >= rescan
        scanned = now if again else scanned
        for site, state in states.items():
            if again or seen.get(site) != state:
                debounce.changed(site, now)
        seen = states
        ready = debounce.due(now)
        if ready:
            try:
                step(ready)
            except Exception:  # noqa: BLE001 - what fails now may work with the next look at the logs
                traceback.print_exc()
                debounce.dirty.update(ready)
            after = look()
            for site in ready:
                if after.get(site) != states.get(site):
                    debounce.changed(site, clock())
            seen |= {s: after[s] for s in ready if s in after}
            debounce.done(ready, clock())
        done += 1
        if rounds is None or done < rounds:
            sleep(every)


def main(args: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("logs")
    p.add_argument("out")
    p.add_argument("--models", action="append", default=[], help="folders with model sets, own ones first")
    p.add_argument("--sites")
    p.add_argument("--force", action="store_true")
    p.add_argument("--env", default=".env", help="file of settings that aren't set yet")
    p.add_argument("--follow", type=float, metavar="SECONDS", help="go on, and run a site so many seconds after its log's last change")
    p.add_argument("--longest", type=float, default=120.0, metavar="SECONDS", help="or so many after the first one")
    p.add_argument("--keep", help="local folder for lock and state; OUT without it")
    p.add_argument("--exports", help="folder for text files of each run")
    a = p.parse_args(args)
    run = Run.from_env(load_env(a.env))
    run = replace(run, force=run.force or a.force, allow=tuple(a.sites.split(",")) if a.sites else run.allow, exports=a.exports or run.exports)
    if a.follow:
        look = lambda: log_state(a.logs, list(run.allow) if run.allow else None)
        watch(look, lambda sites: print(json.dumps(once(a.logs, a.out, tuple(a.models), run, sites, a.keep))), Debounce(a.follow, a.longest))
        return 0
    report = once(a.logs, a.out, tuple(a.models), run, keep=a.keep)
    print(json.dumps(report))
    return 1 if report is not None and report.failed else 0


if __name__ == "__main__":
    raise SystemExit(main())
