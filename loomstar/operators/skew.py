"""Size-checked broadcasts, and joins whose hot keys can be split."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 << 20
_ROW_OVERHEAD = 64  # bytes per row of a hash relation beside its values


def measured_bytes(df: DataFrame) -> int:
    """The in-memory size of `df`, measured by one aggregate over its rows."""
    def width(name: str, kind: str) -> Column:
        if kind in ("string", "binary"):
            return F.coalesce(F.octet_length(f"`{name}`"), F.lit(0)) + 8
        return F.lit(16)

    row = reduce(lambda a, b: a + b, [width(*c) for c in df.dtypes]) + _ROW_OVERHEAD
    return df.agg(F.coalesce(F.sum(row), F.lit(0)).cast("bigint")).first()[0]


def sized(df: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """`df` for the side of a join that Spark may broadcast, only if it measures under `broadcast_bytes`.

    Spark guesses a table's size from its files, whose columns can be packed a hundred times
    tighter than the rows that a broadcast gathers; a load that joins the same table day
    after day would send it through the driver each time.
    """
    return df if measured_bytes(df) <= broadcast_bytes else df.hint("merge")


def equal_nulls(columns: Sequence[str]) -> Column:
    """Equality of `c` and `_c` for all columns, null equal to null."""
    return reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in columns])


def prefixed(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns alone, each `c` renamed to `_c`."""
    return df.select(*[F.col(c).alias(f"_{c}") for c in columns])


def lookup_join(
    facts: DataFrame,
    unique: DataFrame,
    keys: Sequence[str],
    broadcast_bytes: int = BROADCAST_BYTES,
    at_most: DataFrame | None = None,
) -> DataFrame:
    """Left join of `facts` to `unique`, which has at most one row per key.

    Null keys match nothing.  `at_most` is a cheaper relation that `unique` cannot
    outgrow, such as the one it was deduplicated from; without it `unique` itself
    is measured.  Under `broadcast_bytes` it is broadcast and no fact row moves.

    Beyond that both sides shuffle.  The keys are compared null-safely, which an
    aggregate's partitioning does not satisfy, so each side gets an exchange of
    its own and AQE can split the partitions of any number of hot keys, null ones
    among them.
    """
    keys = list(keys)
    if measured_bytes(unique if at_most is None else at_most) <= broadcast_bytes:
        return facts.join(F.broadcast(unique), keys, "left")
    known = prefixed(unique.dropna(subset=keys), unique.columns)
    new = [F.col(f"_{c}").alias(c) for c in unique.columns if c not in keys]
    rest = [c for c in facts.columns if c not in keys]
    return facts.join(known, equal_nulls(keys), "left").select(*keys, *rest, *new)
