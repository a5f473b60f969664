"""Decoding of pointer, touch and scroll tracks: `;` between points, `,` between base-36 fields, times as deltas."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clickloom.functions.expressions import base36

POINT = "struct<x:double,y:double,tm:double>"
#: Fields of x and y, and what a missing one is.
LAYOUTS = {"pointer": (1, 2, "NULL"), "scroll": (1, 2, "NULL"), "touch": (2, 3, "0D")}

BLOCK = 64


def track(text: str, tm: str, layout: str = "pointer") -> Column:
    """array<struct<x, y, tm>> of the points, in order; a point's time is `tm` plus all deltas up to it.

    Times are running sums in blocks, so that a long track isn't copied once a point.
    An unreadable delta leaves its point and all later ones without a time.
    """
    x, y, missing = LAYOUTS[layout]
    field = lambda k, other: f"case when size(f) > {k} then {base36(f'f[{k}]')} else {other} end"
    points = f"""transform(transform(split({text}, ';'), p -> split(p, ',')),
        f -> struct({base36('f[0]')} as dt, {field(x, missing)} as x, {field(y, missing)} as y))"""
    block = f"slice(ps, b * {BLOCK} + 1, {BLOCK})"
    blocks = f"sequence(0, (size(ps) - 1) div {BLOCK})"
    starts = f"aggregate({blocks}, array(cast({tm} as double)), (o, b) -> concat(o, array(aggregate({block}, element_at(o, -1), (at, p) -> at + p.dt))))"
    timed = f"""aggregate({block}, struct(cast(array() as array<{POINT}>) as done, os[b] as at),
        (a, p) -> struct(concat(a.done, array(struct(p.x as x, p.y as y, a.at + p.dt as tm))) as done, a.at + p.dt as at), a -> a.done)"""
    return F.expr(f"""case when {text} is null then null else
      transform(array({points}), ps -> transform(array({starts}), os -> flatten(transform({blocks}, b -> {timed})))[0])[0] end""")
