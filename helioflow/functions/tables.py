"""Small helpers on whole tables: guards, and broadcasts behind a check of the size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of a few numbers that may go to every task.
MOST_ROWS = 100_000


def small(table: DataFrame, most: int = MOST_ROWS) -> DataFrame:
    """A configuration table to be broadcast if it has no more than ``most`` rows; else Spark chooses the join.

    Counting stops at the limit.
    """
    return F.broadcast(table) if table.limit(most + 1).count() <= most else table


def require_none(rows: DataFrame, what: str, shown: int = 20) -> None:
    """Fail if there is any row, naming the first ones: for rows that a run must not go on with."""
    found = rows.limit(shown).collect()
    if found:
        raise ValueError(f"{what}: " + "; ".join(", ".join(map(str, r)) for r in found))

