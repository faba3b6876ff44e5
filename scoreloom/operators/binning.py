"""Quantile, fixed and equal-width bins as generated expressions over literal edges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.sqltext import number, sql_double
from .ranking import exact_quantiles

QUINTILE_LABELS = ("Very Low", "Low", "Medium", "High", "Very High")


def _search(x: str, cuts: list[float], outputs: list[str], right_closed: bool) -> str:
    """Balanced tree of comparisons: outputs[i] where i cuts lie below x (or at x, for left-closed bins)."""
    if not cuts:
        return outputs[0]
    m = len(cuts) // 2
    left = _search(x, cuts[:m], outputs[: m + 1], right_closed)
    right = _search(x, cuts[m + 1:], outputs[m + 1:], right_closed)
    return f"CASE WHEN {x} {'<=' if right_closed else '<'} {sql_double(cuts[m])} THEN {left} ELSE {right} END"


def right_closed_pick(x: str, edges: list[float], outputs: list[str], kind: str, include_lowest: bool = True) -> Column:
    """outputs[i] (SQL literals) for the interval (edge[i], edge[i+1]] holding x; NULL outside the edges."""
    if len(edges) < 2:
        return F.lit(None).cast(kind)
    inside = f"{x} {'>=' if include_lowest else '>'} {sql_double(edges[0])} AND {x} <= {sql_double(edges[-1])}"
    return F.expr(f"CASE WHEN {inside} THEN {_search(x, edges[1:-1], outputs[: len(edges) - 1], True)} END").cast(kind)


def right_closed_bin(x: str, edges: list[float], include_lowest: bool = True) -> Column:
    """0-based index of the interval (edge[i], edge[i+1]] holding x; NULL outside the edges."""
    return right_closed_pick(x, edges, [str(i) for i in range(len(edges))], "int", include_lowest)


def interval_labels(x: str, edges: list[float], labels, include_lowest: bool = False) -> Column:
    """Label of the right-closed interval holding x, NULL outside."""
    return right_closed_pick(x, edges, [f"'{v}'" for v in labels], "string", include_lowest)


def linspace(lo: float, hi: float, bins: int) -> list[float]:
    step = (hi - lo) / bins
    return [lo + i * step for i in range(bins)] + [hi]


def equal_width_sql(x: str, lo: float, hi: float, bins: int) -> str:
    cuts = linspace(float(lo), float(hi), bins)[1:-1]
    return f"CASE WHEN {x} IS NOT NULL THEN {_search(x, cuts, [str(i) for i in range(bins)], False)} END"


def equal_width_bin(x: str, lo: float, hi: float, bins: int) -> Column:
    """0-based bin over ``bins`` equal steps of [lo, hi], left-closed, the last bin closed.

    lo = hi puts every row in the last bin.
    """
    return F.expr(equal_width_sql(x, lo, hi, bins))


def unique_edges(edges: list[float]) -> list[float]:
    out: list[float] = []
    for e in sorted(float(v) for v in edges):
        if not out or e != out[-1]:
            out.append(e)
    return out


def quantile_edges(df: DataFrame, features: list[str], q: int) -> dict[str, list[float]]:
    """Merged quantile edges of every feature; (q + 1) numbers per feature reach the driver.

    Features without a value are absent.
    """
    rows = exact_quantiles(df, features, [i / q for i in range(q + 1)]).collect()
    return {r["feature"]: unique_edges(r["edges"]) for r in rows}


def quantile_bins(df: DataFrame, features: list[str], q: int, suffix: str = "_bin") -> DataFrame:
    """``<feature><suffix>``: 0-based quantile bin with merged duplicate edges."""
    edges = quantile_edges(df, features, q)
    return df.withColumns({
        f"{f}{suffix}": right_closed_bin(number(f), edges.get(f, [])) for f in features
    })


def quintile_bands(df: DataFrame, features: dict[str, str]) -> DataFrame:
    """Five labelled bands per feature: {feature: output name}."""
    edges = quantile_edges(df, list(features), 5)
    return df.withColumns({
        out: interval_labels(number(f), edges.get(f, []), QUINTILE_LABELS, include_lowest=True)
        for f, out in features.items()
    })
