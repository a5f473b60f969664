"""Secret scan: base patterns, then assignment-aware lexing.

The lexer reads source and configuration syntax into name-literal pairs (`name = "x"`, `"name": "x"`,
`NAME=x`, `name := 'x'`, `name => "x"`, with `+` between literals, triple-quoted strings and indented
`name: |` blocks), propagates constants (a name that is assigned another name stands for that name's
literals, through any number of names) and scores each literal by how sensitive the names are that it reaches. A literal that scores `threshold` or more becomes a span of kind
`literal`; base spans stay as they are.

Whole texts are scanned; a null text counts as empty and has no spans. Repeated rows are scanned
alike, an empty table gives an empty result, and columns other than doc_id and text take no part.
Work is linear in the text: lines without an assignment sign are never lexed.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

KINDS = ("assign", "access", "hex", "literal")


def _either(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_ASSIGN = re.compile(
    "(?:" + "|".join(map(_either, ("password", "passwd", "secret", "token", "api_?key"))) + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")  # the greedy run decides the length, so a shorter run has no later match
_HEX = re.compile(r"[0-9a-f]{24,}")
_LINE = re.compile(r"[^\n]*[=:][^\n]*")
_STRING = r"\"(?:[^\"\\\n]|\\.)*+\"|'(?:[^'\\\n]|\\.)*+'"
_PAIR = re.compile(
    r"""(?<![A-Za-z0-9_$.-])["']?([A-Za-z_$][A-Za-z0-9_$.-]*+)["']?[\x20\t]*+(?::=|=>|[:=](?![=:]))[\x20\t]*+((?:STRING)(?:[\x20\t]*+\+[\x20\t]*+(?:STRING))*+|[^\s"'`,;(){}\[\]<>]++)""".replace("STRING", _STRING)
)
_STRINGS = re.compile(_STRING)
_NAMED = r"(?<![A-Za-z0-9_$.-])[\"']?([A-Za-z_$][A-Za-z0-9_$.-]*+)[\"']?[\x20\t]*+"
_TRIPLE = re.compile(_NAMED + r"""(?::=|=>|[:=])[\x20\t]*+(\"{3}|'{3})(?s:(.*?))\2""")
_BLOCK = re.compile(r"(?m)^([\x20]*)(?:-\x20)?" + _NAMED + r":[\x20\t]*[|>][+-]?[\x20\t]*\n((?:\1\x20+\S[^\n]*(?:\n|\Z))+)")
_NAME = re.compile(r"[A-Za-z_$][A-Za-z0-9_$.]*+\Z")
_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")

# What the parts of a name add to its sensitivity, and what takes from it.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 0.9, "pass": 0.6, "secret": 1.0, "token": 0.9, "apikey": 1.0,
    "credential": 0.9, "credentials": 0.9, "bearer": 0.8, "private": 0.5, "access": 0.4, "auth": 0.6, "authorization": 0.7,
    "api": 0.4, "key": 0.5, "client": 0.2, "signing": 0.4, "encryption": 0.4, "connection": 0.2, "salt": 0.4,
}
HARMLESS = {
    "name": -0.6, "id": -0.3, "url": -0.5, "uri": -0.5, "path": -0.5, "file": -0.5, "type": -0.7, "count": -0.8, "length": -0.8,
    "len": -0.8, "size": -0.8, "limit": -0.8, "max": -0.8, "min": -0.8, "num": -0.8, "expiry": -0.7, "expires": -0.7, "policy": -0.8,
    "field": -0.6, "label": -0.7, "hint": -0.7, "public": -0.8, "enabled": -1.0, "header": -0.4,
}
_PLACEHOLDER = re.compile(r"(?i)^(?:x+|\*+|\.+|-+|none|null|true|false|nil|undefined|changeme|example|placeholder|todo|<.*>|\$\{.*\}|\{\{.*\}\}|%\(.*\)s|os\.environ.*|process\.env.*)$")


@dataclass(frozen=True)
class Scan:
    """`threshold`: least score of a literal; `shortest`: of its characters; `names`: what the parts of a name weigh."""

    threshold: float = 0.8
    shortest: int = 6
    names: dict = field(default_factory=lambda: SENSITIVE | HARMLESS)

    def of_name(self, name: str) -> float:
        return sum(self.names.get(p.lower(), 0.0) for p in set(_PARTS.findall(name)))

    def of_literal(self, value: str) -> float:
        """-1 for what can't be a secret, else up to 0.3 by the entropy of its characters."""
        if len(value) < self.shortest or _PLACEHOLDER.match(value) or " " in value.strip():
            return -1.0
        n = len(value)
        entropy = -sum(c / n * math.log2(c / n) for c in Counter(value).values())
        return min(0.3, entropy / 15)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    found = []
    if "=" in text or ":" in text:
        found += [(*m.span(), "assign") for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 6]
    if "AKIA" in text:
        found += [(*m.span(), "access") for m in _ACCESS.finditer(text)]
    found += [(*m.span(), "hex") for m in _HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def pairs(text: str) -> Iterator[tuple[str, list[tuple[int, int, str]]]]:
    """(name, its literals as start, end, value) in the order of the text; one bare word is a literal too.

    What stands in a triple-quoted string or a block is read as the lines of one literal, and as pairs of its own.
    """
    if "=" not in text and ":" not in text:
        return
    found = []
    if '"""' in text or "'''" in text:
        found += [(m.start(), m.group(1), _lines(text, *m.span(3))) for m in _TRIPLE.finditer(text)]
    if "|" in text or ">" in text:
        found += [(m.start(), m.group(2), _lines(text, *m.span(3))) for m in _BLOCK.finditer(text)]
    for line in _LINE.finditer(text):
        for m in _PAIR.finditer(text, line.start(), line.end()):
            at, value = m.start(2), m.group(2)
            if value[0] in "\"'":
                if value[:2] not in ('""', "''") or text[at : at + 3] not in ('"""', "'''"):
                    found.append((m.start(), m.group(1), [(at + s.start() + 1, at + s.end() - 1, s.group()[1:-1]) for s in _STRINGS.finditer(value)]))
            elif value not in ("|", ">", "|-", ">-", "|+", ">+"):
                value = value.rstrip(".")
                found.append((m.start(), m.group(1), [(at, at + len(value), value)]))
    for _, name, literals in sorted(found, key=lambda x: x[0]):
        yield name, literals


def _lines(text: str, start: int, end: int) -> list[tuple[int, int, str]]:
    """The lines between two places, without the spaces around them."""
    return [(start + m.start(), start + m.end(), m.group()) for m in re.finditer(r"\S(?:[^\n]*\S)?", text[start:end])]


def lexed_spans(text: str, scan: Scan) -> list[tuple[int, int, str]]:
    """Literals that reach a sensitive name, directly or through constants."""
    bound: dict[str, list[tuple[int, int, str]]] = {}
    wanted: list[tuple[float, list[tuple[int, int, str]]]] = []
    for name, literals in pairs(text):
        score, passed = scan.of_name(name), {name}
        while len(literals) == 1 and text[literals[0][0] - 1] not in "\"'" and _NAME.match(literals[0][2]) and literals[0][2] in bound and literals[0][2] not in passed:
            passed.add(literals[0][2])
            literals = bound[literals[0][2]]
        bound.update(dict.fromkeys(passed, literals))  # so that no chain is followed twice
        if score > 0:
            wanted.append((score, literals))
    found = set()
    for score, literals in wanted:
        worth = scan.of_literal("".join(x[2] for x in literals))
        if worth >= 0 and score + worth >= scan.threshold:
            found.update((s, e, "literal") for s, e, v in literals if v)
    return sorted(found)


def all_spans(text: str, scan: Scan) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    base = base_spans(text)
    return base, sorted({*base, *lexed_spans(text, scan)}, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def redacted(text: str, spans: list[tuple[int, int, str]], mark: str = "<secret>") -> str:
    out, at = [], 0
    for start, end, _ in spans:
        if end > at:
            if start >= at:
                out += [text[at:start], mark]
            at = end
    return "".join(out) + text[at:]


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in spans)


def find_secrets(docs: DataFrame, scan: Scan = Scan()) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_literal for each row of `docs`."""
    kept = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(1):
                base, found = all_spans(text.as_py() or "", scan)
                n = Counter(k for _, _, k in base)
                rows.append((n["assign"], n["access"], n["hex"], hashlib.sha256(joined(base).encode()).hexdigest(), joined(found), len(found) - len(base)))
            columns = list(zip(*rows, strict=True)) or [()] * len(types)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], names=names)

    names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_literal"]
    types = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()]
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kept}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_literal long")


def redact_secrets(docs: DataFrame, scan: Scan = Scan()) -> DataFrame:
    """`docs` with each secret in `text` replaced by a mark; all rows and other columns stay. A null text stays null."""
    from pyspark.sql import functions as F

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: redacted(t, all_spans(t, scan)[1]) if t else t)

    return docs.withColumn("text", clean("text"))
