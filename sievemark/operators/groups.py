"""Joining a per-group value back to the rows of its group, hot groups included."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_HEAVY_GROUPS = 50_000
MIN_HEAVY_ROWS = 100_000


def heavy_limit(total_rows: int) -> int:
    """Rows above which a group counts as heavy.

    Groups larger than total / MAX_HEAVY_GROUPS number fewer than
    MAX_HEAVY_GROUPS, so the table of heavy groups has a fixed upper size.
    """
    return max(MIN_HEAVY_ROWS, -(-total_rows // MAX_HEAVY_GROUPS))


def join_groups(
    rows: DataFrame, groups: DataFrame, keys: Sequence[str], total_rows: int, limit: int | None = None
) -> DataFrame:
    """Inner join of ``rows`` with ``groups``, whose ``keys`` are unique.

    ``groups`` carries ``n_rows``, the number of rows per key. Ordinary groups
    meet in a shuffle join. Heavy ones, one of which may hold a third of all
    rows, never enter that shuffle: their few group rows are broadcast and
    joined where the rows already are. Both ways run at every size.
    """
    limit = heavy_limit(total_rows) if limit is None else limit
    keys = list(keys)
    heavy = F.broadcast(groups.where(F.col("n_rows") > limit).drop("n_rows"))
    light = groups.where(F.col("n_rows") <= limit).drop("n_rows")
    return (
        rows.join(heavy.select(*keys), keys, "left_anti")
        .join(light, keys)
        .unionByName(rows.join(heavy, keys))
    )
