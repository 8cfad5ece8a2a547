"""Look-ups against dimension tables whose size is checked before they are broadcast.

The planner's own estimate of a derived table (a join of small tables, say) can be off by
orders of magnitude in both directions: it then shuffles the fact table for nothing. So a
dimension is counted once, a small distributed job, and hinted only below a row bound.
Above the bound nothing is hinted: the join is a shuffle join, and adaptive execution
splits the partitions of busy keys.
"""

from __future__ import annotations

from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, functions as F

# Narrow rows (a code or two and a name, about 100 bytes): 50 MB at most.
MAX_ROWS = 500_000

_counted: WeakKeyDictionary[DataFrame, int] = WeakKeyDictionary()


def row_count(dim: DataFrame) -> int:
    """Rows of a table (or a recorded bound), counted once per DataFrame object."""
    if dim not in _counted:
        _counted[dim] = dim.count()
    return _counted[dim]


def at_most(dim: DataFrame, source: DataFrame) -> DataFrame:
    """Record that `dim` cannot have more rows than `source`, which is cheaper to count.

    True for a source that was filtered or met tables with one row per key.
    """
    _counted[dim] = row_count(source)
    return dim


def same_rows(dim: DataFrame, source: DataFrame) -> DataFrame:
    """Carry a count that is already known over to a row-by-row projection; never counts."""
    if source in _counted:
        _counted[dim] = _counted[source]
    return dim


def small(dim: DataFrame, columns: list[str] | None = None, max_rows: int = MAX_ROWS) -> DataFrame:
    """The table (or some of its columns) with a broadcast hint if it is within the bound."""
    narrow = dim.select(*columns) if columns else dim
    return F.broadcast(narrow) if row_count(dim) <= max_rows else narrow
