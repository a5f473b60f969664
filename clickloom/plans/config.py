"""Sites, model resolution and run settings."""

from __future__ import annotations

import os
import posixpath
import re
from dataclasses import dataclass, field

from clickloom.sources import files

DEVICES = ("mobile", "desktop")
#: Files of a complete projection model.
PROJECTION_FILES = ("projection.json", "centroid.json", "scaler.json")
TREE_FILE = "trees.json"


def load_env(path: str, environ: dict[str, str] | None = None) -> dict[str, str]:
    """Settings of a `key=value` file; quotes are stripped, lines with # skipped, and what is set already stays."""
    environ = os.environ if environ is None else environ
    try:
        lines = files.read(path).decode().splitlines()
    except FileNotFoundError:
        return environ
    for line in lines:
        if m := re.match(r"\s*(?:export\s+)?([A-Za-z_]\w*)\s*=\s*(.*?)\s*\Z", line):
            value = m[2][1:-1] if len(m[2]) > 1 and m[2][0] == m[2][-1] and m[2][0] in "'\"" else m[2]
            environ.setdefault(m[1], value)
    return environ


def site_name(text: str) -> str:
    return re.sub(r"[^\w.-]", "_", text)


@dataclass(frozen=True)
class Site:
    """models: where its own model sets are (custom), then the base's, then older places; paths or URIs."""

    site_id: str
    file: str
    models: tuple[str, ...] = ()

    def projection(self, device: str) -> str | None:
        """The first folder with a complete projection model of the device."""
        for root in self.models:
            folder = posixpath.join(root, device)
            if all(files.is_file(posixpath.join(folder, f)) for f in PROJECTION_FILES):
                return folder
        return None

    def trees(self, device: str, named: str | None = None) -> tuple[str, str | None]:
        """(where from, file) of the tree model: a named file, else the first folder's, else missing; never raises."""
        if named and files.is_file(named):
            return "env", named
        for kind, root in zip(("custom", "base", "legacy"), self.models, strict=False):
            if files.is_file(file := posixpath.join(root, device, TREE_FILE)):
                return kind, file
        return "missing", None


@dataclass(frozen=True)
class Run:
    """Settings of one run. mode: incremental; full scores all sessions again; extract and process are the two phases, whose
    rules for snapshots differ. exports: a folder for text files of each run. The others are named in `plans.pipeline`."""

    mode: str = "incremental"
    probability: str = "decay"
    mobile_history: int = 10
    desktop_history: int = 5
    force: bool = False
    allow: tuple[str, ...] | None = None
    trees: dict[str, str] = field(default_factory=dict)
    exports: str | None = None

    @property
    def rebuild(self) -> bool:
        return self.force or self.mode != "incremental"

    @property
    def two_phase(self) -> bool:
        return self.mode in ("extract", "process")

    @classmethod
    def from_env(cls, environ: dict[str, str] | None = None) -> Run:
        e = os.environ if environ is None else environ
        names = e.get("ALLOWED_SITES")
        return cls(
            e.get("MODE", "incremental"), e.get("PROBABILITY_MODE", "decay"), int(e.get("MAX_TMV_RECORDS", 10)), int(e.get("MAX_MMV_RECORDS", 5)),
            e.get("FORCE_FULL_REBUILD", "") in ("1", "true"), tuple(x.strip() for x in names.split(",") if x.strip()) if names else None,
            {d: e[name] for d in DEVICES if (name := f"TREES_{d.upper()}") in e},
            e.get("EXPORTS") or None,
        )
