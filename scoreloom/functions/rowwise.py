"""NULL-skipping statistics across the columns of one row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_count(cols: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, [F.when(c.isNotNull(), 1).otherwise(0) for c in cols])


def row_sum(cols: list[Column]) -> Column:
    """Sum with NULL as 0; a row of NULLs sums to 0."""
    return reduce(lambda a, b: a + b, [F.coalesce(c.cast("double"), F.lit(0.0)) for c in cols])


def row_mean(cols: list[Column]) -> Column:
    n = row_count(cols)
    return F.when(n > 0, row_sum(cols) / n)


def row_min(cols: list[Column]) -> Column:
    return F.least(*cols) if len(cols) > 1 else cols[0]


def row_max(cols: list[Column]) -> Column:
    return F.greatest(*cols) if len(cols) > 1 else cols[0]


def row_std(cols: list[Column], ddof: int = 1) -> Column:
    """Standard deviation of the non-NULL entries; NULL when at most ``ddof`` of them exist."""
    n = row_count(cols)
    m = row_mean(cols)
    squares = reduce(
        lambda a, b: a + b,
        [F.coalesce((c.cast("double") - m) * (c.cast("double") - m), F.lit(0.0)) for c in cols],
    )
    return F.when(n > ddof, F.sqrt(squares / (n - ddof)))


def clip(x: Column, lower=None, upper=None) -> Column:
    """Bound a column and keep NULL as NULL (``greatest``/``least`` alone would skip it)."""
    out = x
    if lower is not None:
        out = F.greatest(out, F.lit(lower))
    if upper is not None:
        out = F.least(out, F.lit(upper))
    return F.when(x.isNotNull(), out)
