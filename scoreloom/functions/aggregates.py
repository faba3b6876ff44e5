"""Aggregate shapes shared by the history features, written as SQL expression text.

``Rollup`` splits an aggregate into a partial per applicant and number of copies of the parent row, which sums a child
table as it is, and a merge per applicant, which weighs the few partials by their copies.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dbl(x: Column) -> Column:
    return x.cast("double")


def ratio(num: Column, den: Column, otherwise: Column | None = None) -> Column:
    """num / den where den > 0, else ``otherwise`` (NULL by default)."""
    out = F.when(den > 0, dbl(num) / dbl(den))
    return out if otherwise is None else out.otherwise(otherwise)


def double(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def share(num: str, den: str, otherwise: str = "NULL") -> str:
    """num / den where den > 0, else ``otherwise``."""
    return f"CASE WHEN {den} > 0 THEN {double(num)} / {double(den)} ELSE {otherwise} END"


def mean_of(total: str, n: str) -> str:
    """Mean from an (exact when the input is exact) sum and a count; NULL for no rows."""
    return f"CASE WHEN {n} <> 0 THEN {double(total)} / {double(n)} END"


def avg(x: str) -> str:
    return mean_of(f"sum({x})", f"count({x})")


def avg_if(p: str, x: str) -> str:
    return avg(f"CASE WHEN {p} THEN {x} END")


def sum0_if(p: str, x: str) -> str:
    """Conditional sum with ELSE 0: NULL only when every matching value is NULL and none fails p."""
    return f"sum(CASE WHEN {p} THEN {x} ELSE 0 END)"


def recent_minus_older(recent_hits: str, recent: str, older_hits: str, older: str) -> str:
    """Hit ratio of recent rows minus that of older rows; NULL when either side has no rows."""
    return f"({share(recent_hits, recent)}) - ({share(older_hits, older)})"


def std(x: str) -> str:
    return f"stddev_samp({double(x)})"


def latest(value: str, *order: str) -> str:
    """Value of the last row by ``order``; later entries of ``order`` break ties."""
    return f"max_by({value}, struct({', '.join(order)}))"


def named(outputs: dict[str, str]) -> list[Column]:
    return [F.expr(f"{expr} AS `{name}`") for name, expr in outputs.items()]


class Rollup:
    """Collects partials; each method returns the applicant-level merged expression.

    Sums are weighted by ``p_copies``, the number of times the parent lists the loan for the applicant. ``prefix`` keeps
    the partials of several child tables apart when their rows are merged together.
    """

    def __init__(self, prefix: str = "") -> None:
        self.p = f"p_{prefix}"
        self._partials: dict[str, str] = {f"{self.p}here": "max(1)"}
        self.counts_loans = False

    def loans(self) -> str:
        """Number of distinct child keys, which ``counts_loans`` asks the rows to carry as ``<prefix>loans``."""
        self.counts_loans = True
        return f"sum({self.p}loans)"

    def partials(self) -> list[Column]:
        return named(self._partials)

    def _keep(self, name: str, partial: str, merge: str) -> str:
        self._partials.setdefault(name, partial)
        return f"sum({name} * p_copies)" if merge == "sum" else f"{merge}({name})"

    def rows(self) -> str:
        return self._keep(f"{self.p}rows", "count(1)", "sum")

    def count_if(self, name: str, p: str) -> str:
        return self._keep(f"{self.p}{name}_hits", f"count_if({p})", "sum")

    def count(self, name: str, x: str) -> str:
        return self._keep(f"{self.p}{name}_n", f"count({x})", "sum")

    def sum(self, name: str, x: str) -> str:
        return self._keep(f"{self.p}{name}_sum", f"sum({x})", "sum")

    def min(self, name: str, x: str) -> str:
        return self._keep(f"{self.p}{name}_min", f"min({x})", "min")

    def max(self, name: str, x: str) -> str:
        return self._keep(f"{self.p}{name}_max", f"max({x})", "max")

    def avg(self, name: str, x: str) -> str:
        return mean_of(self.sum(name, x), self.count(name, x))

    def std(self, name: str, x: str) -> str:
        """Sample deviation over all rows from count, mean and centred square sum of each partial.

        The part between partials is a sum over (mean - centre) squared. Each mean is split exactly into whole steps
        of 2**-20 and the rest of a step in units of 2**-60; sums of their products are exact decimals, and the centre,
        a whole step, is taken off before anything becomes a double. So nothing cancels however far the values lie from
        zero, and spreads down to 1e-14 are kept. Means beyond 6e10 do not fit and fall back to doubles. A single partial
        has no part between.
        """
        n = self.count(name, x)
        mean, inner, hi, lo = (f"{self.p}{name}_{part}" for part in ("mean", "m2", "hi", "lo"))
        average = avg(x)
        steps = f"({average}) * 1048576D"
        fits = f"abs({average}) < 6e10D"
        self._partials.setdefault(mean, average)
        self._partials.setdefault(inner, f"var_pop({double(x)}) * count({x})")
        self._partials.setdefault(hi, f"CASE WHEN {fits} THEN CAST(floor({steps}) AS DECIMAL(17, 0)) END")
        self._partials.setdefault(lo, f"CASE WHEN {fits} THEN CAST(floor(({steps} - floor({steps})) * 1099511627776D) AS DECIMAL(13, 0)) END")
        rows = f"CAST({self.p}{name}_n * p_copies AS DECIMAL(18, 0))"
        total = lambda *factors: f"try_sum({_product(*factors, rows)})"
        count, whole = f"CAST({n} AS DECIMAL(18, 0))", "DECIMAL(20, 0)"
        s, rest = total(hi), f"CAST({total(lo)} AS DOUBLE) * {_UNIT}"
        centre = f"try_cast(round(CAST({s} AS DOUBLE) / CAST({n} AS DOUBLE)) AS {whole})"
        twice = _product(centre, s, "CAST(2 AS DECIMAL(1, 0))")
        around = f"CAST(try_add(try_subtract({total(hi, hi)}, {twice}), {_product(centre, centre, count)}) AS DOUBLE)"
        cross = f"CAST(try_subtract({total(hi, lo)}, {_product(centre, total(lo))}) AS DOUBLE) * 2 * {_UNIT}"
        small = f"CAST({total(lo, lo)} AS DOUBLE) * {_UNIT} * {_UNIT}"
        off = f"(CAST(try_subtract({s}, {_product(centre, count)}) AS DOUBLE) + {rest})"
        exact = f"({around} + {cross} + {small} - {off} * {off} / {double(n)}) / 1099511627776D"
        weighted = f"sum({mean} * {self.p}{name}_n * p_copies)"
        rough = f"sum({mean} * {mean} * {self.p}{name}_n * p_copies) - {weighted} * {weighted} / {double(n)}"
        fit = f"count({mean}) = count({hi})"
        between = f"CASE WHEN count({mean}) < 2 THEN 0.0D ELSE greatest(0.0D, coalesce(CASE WHEN {fit} THEN {exact} END, {rough})) END"
        return f"CASE WHEN {n} > 1 THEN sqrt((coalesce(sum({inner} * p_copies), 0.0D) + {between}) / ({double(n)} - 1)) END"


_UNIT = "9.094947017729282e-13D"  # 2 ** -40


def _product(*factors: str) -> str:
    """Exact product of decimals, NULL where it does not fit."""
    out = factors[0]
    for f in factors[1:]:
        out = f"try_multiply({out}, {f})"
    return out
