"""``AVG(x) OVER (PARTITION BY k)`` followed by ``DISTINCT``.

The original computes per-group means with a window over the whole group and
removes the repeated rows with DISTINCT. Catalyst does not turn that into an
aggregate: the window sorts and holds every group in one task, and DISTINCT
shuffles again. The result is exactly one row per group with its means, which
is what a two-phase hash aggregate gives in one shuffle and without holding a
group; so that is how it is computed here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.functions import broadcast

from starmart.functions.columns import ColumnLike, col_of
from starmart.operators.aggregates import group_avg
from starmart.operators.joins import fits_broadcast, salted_join


def window_avg_distinct(df: DataFrame, keys: Sequence[ColumnLike], measures: dict[str, ColumnLike],
                        digits: int | None = None, decimals: int | None = None) -> DataFrame:
    """``SELECT DISTINCT keys, AVG(m) OVER (PARTITION BY keys) ...``, as an aggregate."""
    return group_avg(df, keys, measures, digits=digits, decimals=decimals)


def with_group_avg(df: DataFrame, keys: Sequence[str], measures: dict[str, ColumnLike],
                   digits: int | None = None, decimals: int | None = None) -> DataFrame:
    """Every row with its group's means (the window without DISTINCT).

    The means are aggregated first (one row per key) and joined back on the
    keys: broadcast when rows and bytes of the means are within the bounds,
    else by a salted join, so a hot key's rows never meet in one task.
    """
    names = {k: f"__k{i}" for i, k in enumerate(keys)}
    means = group_avg(df, [col_of(k).alias(n) for k, n in names.items()], measures, digits=digits, decimals=decimals)
    if not fits_broadcast(means):
        return salted_join(df, means, names, "left", null_safe=True).drop(*names.values())
    means = broadcast(means)
    cond = None
    for k, n in names.items():
        eq = df[k].eqNullSafe(means[n])  # NULL keys form a group, as in a window
        cond = eq if cond is None else cond & eq
    return df.join(means, cond, "left").drop(*names.values())
