"""Size-checked lookups of a per-category value."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sqltext import literal

BROADCAST_ROWS = 100_000
EXPRESSION_ROWS = 128


def local_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """A broadcast-hinted local frame when ``df`` has at most ``max_rows`` rows, else ``df`` itself.

    At most ``max_rows`` + 1 rows reach the driver. A larger lookup stays distributed and is joined
    by shuffle, where adaptive execution splits skewed partitions.
    """
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, schema=df.schema))


class CategoryLookup:
    """Values of a (feature, category, ...) table, by generated expression, broadcast or shuffle join.

    Each column is decided by itself, smallest first: one wide column is joined by shuffle and leaves the others alone.

    ``by`` names a further key column, equal on both sides.
    """

    def __init__(self, table: DataFrame, value: str, by: str | None = None):
        self.value, self.by = value, by
        self.frame = table.select("feature", "category", *([by] if by else []), value)
        size = self.frame.groupBy("feature").count().collect()  # a row per column
        small, left = [], BROADCAST_ROWS
        for feature, n in sorted(((r[0], r[1]) for r in size), key=lambda x: x[1]):
            if n <= left:
                small.append(feature)
                left -= n
        self.small = set(small)
        self.sizes = {r[0]: r[1] for r in size}
        self.rows = self.frame.where(F.col("feature").isin(small)).collect() if small else []
        self.local = F.broadcast(table.sparkSession.createDataFrame(self.rows, schema=self.frame.schema)) if self.rows else None

    def _expression(self, column: str) -> str | None:
        mine = [r for r in self.rows if r["feature"] == column]
        if len(mine) > EXPRESSION_ROWS or not mine and column not in self.small and column in self.sizes:
            return None
        if not mine:
            return "NULL"

        def chain(rows) -> str:
            branches = " ".join(f"WHEN {literal(r['category'])} THEN {literal(r[self.value])}" for r in rows)
            return f"CASE `{column}` {branches} END"

        if self.by is None:
            return chain(mine)
        groups: dict = {}
        for r in mine:
            groups.setdefault(r[self.by], []).append(r)
        return f"CASE `{self.by}` " + " ".join(f"WHEN {literal(k)} THEN {chain(v)}" for k, v in groups.items()) + " END"

    def attach(self, df: DataFrame, columns: dict[str, str], default: str = "NULL") -> DataFrame:
        """Add {column: output}; NULL and unknown categories give ``default`` (SQL text)."""
        kind = dict(self.frame.dtypes)[self.value]
        ready, joined = {}, {}
        for column, out in columns.items():
            text = self._expression(column)
            if text is None:
                joined[column] = out
            else:
                ready[out] = F.expr(f"CAST(coalesce({text}, {default}) AS {kind})")
        for i, (column, out) in enumerate(joined.items()):
            source = self.local if column in self.small else self.frame
            part = source.where(F.col("feature") == column).select(
                F.col("category").alias("_cat"), *([F.col(self.by).alias("_by")] if self.by else []),
                F.col(self.value).alias(f"_hit_{i}"),
            )
            match = df[column] == part["_cat"]
            if self.by:
                match = match & (df[self.by] == part["_by"])
            df = df.join(part, match, "left").drop("_cat", "_by")
            ready[out] = F.expr(f"CAST(coalesce(_hit_{i}, {default}) AS {kind})")
        return df.withColumns(ready).drop(*[f"_hit_{i}" for i in range(len(joined))])
