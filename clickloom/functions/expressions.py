"""Column expressions that the whole engine shares.

Scripts that write the logs count in IEEE doubles and drop what isn't a number; here such values
are NULL throughout, so that comparisons are never true and aggregates leave them out.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def known(x: Column) -> Column:
    """NULL for NaN and infinities."""
    return F.when(~F.isnan(x) & (F.abs(x) != float("inf")), x)


def ratio(a: Column, b: Column) -> Column:
    """a / b; NULL where b is 0 or either is unknown."""
    return F.try_divide(a.cast("double"), b.cast("double"))


#: Digits that fit a whole double each, and those that scripts read in one go where there are more.
EXACT_DIGITS, PART = 10, 5


def base36(text: str) -> str:
    """SQL for the number at the start of `text`, written to base 36, as a double; NULL where there is none.

    Up to ten digits are whole numbers. Of more digits, however many, parts of five are folded from the left in double
    arithmetic, each step rounded, as scripts do that write and read the logs.
    """
    digits = f"nullif(regexp_extract({text}, r'^\\s*(?:[+](?!-))?(-?[0-9a-zA-Z]+)', 1), '')"
    part = f"substring(d, {PART} * k + 1, {PART})"
    folded = f"aggregate(sequence(0, (length(d) - 1) div {PART}), 0D, (v, k) -> v * pow(36D, length({part})) + cast(conv({part}, 36, 10) as double))"
    long = f"transform(array({digits}), n -> transform(array(regexp_replace(n, '^-?0*(?=.)', '')), d -> if(startswith(n, '-'), -1D, 1D) * {folded})[0])[0]"
    return f"case when length({text}) <= {EXACT_DIGITS} then cast(conv({digits}, 36, -10) as double) else {long} end"


def text_or_null(x: Column) -> Column:
    """Empty text, and the spellings of nothing that tables of text hold, are NULL."""
    return F.when(~F.lower(F.trim(x)).isin("", "nan", "none", "null", "<na>"), x)


def round6(x: Column) -> Column:
    """Rounded for comparisons; never minus zero."""
    return F.round(x, 6) + F.lit(0.0)
